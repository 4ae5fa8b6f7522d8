"""Filling containers of several fixed sizes with whole documents.

Method: hierarchical multi-length packing. Each document is routed to the
smallest container size that holds it; a document longer than the largest size
is cut into full containers and a rest, which is routed like any other. Each
tier is packed best-fit decreasing, from the largest to the smallest; gaps left
in long containers are filled from the shorter tiers first; containers are then
dealt into step groups of even load.

Only (id, size) pairs are shuffled. They are packed in shards of about
``SHARD_TOKENS`` tokens, chosen by a hash of the id and salted by nothing else,
so a shard's size does not depend on any column's skew, and the number of
shards grows with the corpus. A shard is packed in one task with memory for its
own pairs only. The room that is lost by packing shards apart is at most one
part-filled container per size and shard.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from voxloom.runtime import durable

COPIES = 10_000  # of one document that are numbered at once
SHARD_TOKENS = 20_000_000
STEP_CONTAINERS = 8

_PLACED = "shard int, pack_name string, capacity_tokens int, container_no int, step_group int, doc_id bigint, piece_no int, first_token bigint, n_tokens int, position int"


class _Room:
    """Open items by size: takes the largest that fits."""

    def __init__(self, items: list[tuple[int, int, int, int]]) -> None:
        self.by: dict[int, list[tuple[int, int, int, int]]] = {}
        for x in sorted(items, reverse=True):  # pops the smallest id first
            self.by.setdefault(x[0], []).append(x)
        self.sizes = sorted(self.by)

    def take(self, room: int) -> tuple[int, int, int, int] | None:
        i = bisect.bisect_right(self.sizes, room) - 1
        if i < 0:
            return None
        stack = self.by[size := self.sizes[i]]
        x = stack.pop()
        if not stack:
            del self.by[size]
            self.sizes.pop(i)
        return x


def pack_shard(items: list[tuple[int, int]], tiers: list[tuple[str, int]], step: int = STEP_CONTAINERS) -> list[tuple]:
    """Containers for ``items`` (doc_id, n_tokens > 0); ``tiers`` (name, capacity) in any order.

    Rows (pack_name, capacity, container_no, step_group, doc_id, piece_no, first_token, n_tokens, position).
    Deterministic: ties go to the smaller id and piece.
    """
    tiers = sorted(tiers, key=lambda x: (x[1], x[0]))
    largest = tiers[-1][1]
    pieces: list[list[tuple[int, int, int, int]]] = [[] for _ in tiers]
    caps = [c for _, c in tiers]
    for doc, n in items:
        for k in range(math.ceil(n / largest)):
            size = min(largest, n - k * largest)
            pieces[bisect.bisect_left(caps, size)].append((size, doc, k, k * largest))
    rooms = [_Room(p) for p in pieces]
    out = []
    for t in range(len(tiers) - 1, -1, -1):
        name, cap = tiers[t]
        full: list[tuple[int, list]] = []
        while (x := rooms[t].take(cap)) is not None:
            inside, room = [x], cap - x[0]
            # the gap is filled with the largest piece that fits, of the own tier first, then of shorter ones
            while room:
                y = None
                for u in range(t, -1, -1):
                    if (y := rooms[u].take(room)) is not None:
                        break
                if y is None:
                    break
                inside.append(y)
                room -= y[0]
            full.append((cap - room, inside))
        # even steps: containers in order of load, dealt back and forth
        full.sort(key=lambda f: (-f[0], f[1][0][1:3]))
        groups = max(1, math.ceil(len(full) / step))
        for no, (_, inside) in enumerate(full):
            lap, at = divmod(no, groups)
            group = at if lap % 2 == 0 else groups - 1 - at
            out += [(name, cap, no, group, doc, k, first, size, pos) for pos, (size, doc, k, first) in enumerate(inside)]
    return out


def pack(sizes: DataFrame, tiers: list[tuple[str, int]], shard_tokens: int = SHARD_TOKENS, step: int = STEP_CONTAINERS) -> DataFrame:
    """Where every piece of every document lies: one row per piece (see _PLACED).

    ``sizes``: (doc_id, n_tokens). Documents without tokens (null, empty) need
    no room and have no row. A repeated doc_id is packed as often as it occurs,
    its copies spread over all shards; a null doc_id is a document too.
    ``tiers`` is a fixed short table; without one, or without documents, there are no rows.
    """
    spark = sizes.sparkSession
    # equal rows are counted, and numbered in blocks: copies are no more in one shard than other documents
    counted = sizes.select(F.col("doc_id"), F.col("n_tokens")).where("n_tokens > 0").groupBy("doc_id", "n_tokens").agg(F.count(F.lit(1)).alias("copies"))
    blocks = counted.withColumn("b", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / COPIES))))
    copy = F.explode(F.sequence(F.col("b") * COPIES, F.least((F.col("b") + 1) * COPIES, F.col("copies")) - 1))
    sized = durable(blocks.select("doc_id", "n_tokens", copy.alias("copy")), "sizes")
    total = sized.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    if not tiers or not total:
        return spark.createDataFrame([], _PLACED)
    shards = max(1, round(total / shard_tokens))
    tasks = max(1, min(shards, 20_000))
    by_shard = sized.withColumn("shard", F.pmod(F.xxhash64("doc_id", "copy"), F.lit(shards)).cast("int")).drop("copy").repartition(tasks, "shard").sortWithinPartitions("shard", "doc_id", "n_tokens")
    schema = pa.schema([("shard", pa.int32()), ("pack_name", pa.string()), ("capacity_tokens", pa.int32()), ("container_no", pa.int32()), ("step_group", pa.int32()), ("doc_id", pa.int64()), ("piece_no", pa.int32()), ("first_token", pa.int64()), ("n_tokens", pa.int32()), ("position", pa.int32())])

    def emit(shard: int, ids: list, ns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        # documents go by their place in the sorted shard, so an id may be null
        rows = [(*r[:4], ids[r[4]], *r[5:]) for r in pack_shard(list(enumerate(np.concatenate(ns).tolist())), tiers, step)]
        for i in range(0, len(rows), 50_000):
            cols = list(zip(*rows[i : i + 50_000]))
            arrays = [pa.array([shard] * len(cols[0]), pa.int32()), *(pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:]))]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, ns = None, [], []
        for b in batches:
            shard, n = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("shard", "n_tokens"))
            doc = b.column(b.schema.get_field_index("doc_id")).to_pylist()
            for part in np.split(np.arange(len(shard)), np.flatnonzero(np.diff(shard)) + 1):
                if not len(part):
                    continue
                if now is not None and shard[part[0]] != now:
                    yield from emit(now, ids, ns)
                    ids, ns = [], []
                now = int(shard[part[0]])
                ids.extend(doc[part[0] : part[-1] + 1])
                ns.append(n[part])
        if now is not None:
            yield from emit(now, ids, ns)

    return by_shard.mapInArrow(run, _PLACED)


def containers(placed: DataFrame) -> DataFrame:
    """One row per container: its load, gap, number of pieces and step group."""
    return placed.groupBy("pack_name", "shard", "container_no", "capacity_tokens", "step_group").agg(
        F.count(F.lit(1)).alias("n_pieces"), F.sum("n_tokens").alias("used_tokens")
    ).withColumn("unused_tokens", F.col("capacity_tokens") - F.col("used_tokens"))


def report(placed: DataFrame) -> DataFrame:
    """One row per container size: containers, pieces, tokens, and the share of room left unused."""
    c = containers(placed).groupBy("pack_name", "capacity_tokens").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("n_pieces").alias("n_pieces"), F.sum("used_tokens").alias("used_tokens"))
    return c.withColumn("unused_share", F.round(1 - F.col("used_tokens") / (F.col("n_containers") * F.col("capacity_tokens")), 6))
