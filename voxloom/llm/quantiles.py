"""Percentiles per group with bounded error that combine over days: dyadic Count-sketches.

Method: each value is encoded as an integer that keeps its order, each binary
resolution of the encoded universe has its own signed Count-sketch, sketches of
the same shape merge by adding their counters and take deletions as negative
counts, and a percentile is found by descending the resolutions from the top.

Value error: a value is represented by a code that keeps the sign, the exponent
and ``BITS - 9`` bits of the mantissa of its 32-bit form, so an answer is within
2^-(BITS - 9) of a true value, relatively (values below 1e-37 count as 0).

Rank error: a node's count is the median of DEPTH estimates, each with a
standard deviation of at most |f| / sqrt(WIDTH), |f| being the root of the sum
of squared node counts of its level, so less than n. At most one node a level
enters a rank, and levels are hashed independently: the rank of an answer is
off by about sqrt(LEVELS / WIDTH) * |f| or less, 0.15 n in the worst case and,
since values spread over many nodes at the lower levels and the upper levels
are exact, below 0.02 n on metrics like these (tests hold them to that). A
wider sketch lowers it as 1 / sqrt(WIDTH).

A sketch has the same size however many values it holds. Sketches are built
where the rows are read, one per group and partition, and added up in sorted
streams, in two levels: first within blocks of partitions, then the blocks, so
no task takes a sketch of every partition. A sketch of few different codes
travels as those codes with their counts and is unfolded where its counters are
needed; unfolding is exact, so how it travelled makes no difference.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BITS = 20  # of the code
TOP = 8  # the resolution of 2^TOP nodes and all above it are exact
LEVELS = BITS - TOP
DEPTH = 5
WIDTH = 512
CELLS = LEVELS * DEPTH * WIDTH + (1 << TOP)
#: Groups that are open at the same time while rows are read, of those with counters (248 kB each), and codes (16 bytes).
OPEN_GROUPS, OPEN_COUNTERS, OPEN_CODES = 4096, 200, 4_000_000
#: A sketch of fewer different codes travels as its codes. Only affects its size on the way, never the result.
FEW = 4096
#: Partitions whose sketches are added up together first.
BLOCK = 16
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)

_RNG = np.random.Generator(np.random.PCG64(20250301))
_MUL = _RNG.integers(1, 2**63, size=(LEVELS, DEPTH), dtype=np.uint64) | np.uint64(1)
_ADD = _RNG.integers(0, 2**63, size=(LEVELS, DEPTH), dtype=np.uint64)


def encode(x: np.ndarray) -> np.ndarray:
    """Codes in [0, 2^BITS) in the order of the finite values ``x``."""
    x = np.clip(x, -3e38, 3e38).astype(np.float32)
    u = np.where(x == 0, np.float32(0), x).view(np.uint32)  # -0.0 is 0.0
    u = np.where(u >> 31, ~u, u | np.uint32(0x80000000))
    return (u >> np.uint32(32 - BITS)).astype(np.int64)


def decode(code: np.ndarray) -> np.ndarray:
    """The middle of the values that share a code; 0 for the codes around 0."""
    u = (np.asarray(code, np.uint64).astype(np.uint32) << np.uint32(32 - BITS)) | np.uint32(1 << (31 - BITS))
    v = np.where(u >> np.uint32(31), u & np.uint32(0x7FFFFFFF), ~u).astype(np.uint32).view(np.float32).astype(np.float64)
    return np.where(np.abs(v) < 1e-37, 0.0, v)


def _hash(node: np.ndarray, level: int, row: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, sign) of nodes in one row of one level."""
    with np.errstate(over="ignore"):
        h = (node.astype(np.uint64) + np.uint64(1)) * _MUL[level, row] + _ADD[level, row]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return (h % np.uint64(WIDTH)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def add(counters: np.ndarray, group: np.ndarray, code: np.ndarray, weight: np.ndarray) -> None:
    """Add weighted codes to ``counters[group]`` (groups x CELLS); negative weights delete."""
    g = counters.shape[0]
    for level in range(LEVELS):
        node = code >> level
        for row in range(DEPTH):
            bucket, sign = _hash(node, level, row)
            at = (level * DEPTH + row) * WIDTH
            counters[:, at : at + WIDTH] += np.bincount(group * WIDTH + bucket, sign * weight, g * WIDTH).reshape(g, WIDTH).astype(np.int64)
    counters[:, -(1 << TOP) :] += np.bincount((group << TOP) + (code >> LEVELS), weight, g << TOP).reshape(g, 1 << TOP).astype(np.int64)


def estimate(counters: np.ndarray, node: np.ndarray, level: int) -> np.ndarray:
    """Counts of one node per sketch at a level."""
    if level == LEVELS:
        return np.take_along_axis(counters[:, -(1 << TOP) :], node[:, None], 1)[:, 0]
    rows = []
    for row in range(DEPTH):
        bucket, sign = _hash(node, level, row)
        rows.append(np.take_along_axis(counters, ((level * DEPTH + row) * WIDTH + bucket)[:, None], 1)[:, 0] * sign)
    return np.median(rows, axis=0)


def quantiles(counters: np.ndarray, qs: tuple[float, ...] = QUANTILES) -> np.ndarray:
    """Values at ``qs`` for each sketch (sketches x qs); NaN for an empty sketch. The rank sought is the nearest one, from 1 to n."""
    top = counters[:, -(1 << TOP) :]
    n = top.sum(1)
    upto = np.cumsum(top, 1)
    out = np.full((len(counters), len(qs)), np.nan)
    for k, q in enumerate(qs):
        rank = np.maximum(1, np.ceil(q * n))
        node = np.minimum((upto < rank[:, None]).sum(1), (1 << TOP) - 1)
        here = np.take_along_axis(top, node[:, None], 1)[:, 0].astype(float)
        rank = rank - (np.take_along_axis(upto, node[:, None], 1)[:, 0] - here)
        for level in range(LEVELS - 1, -1, -1):
            left, right = node * 2, node * 2 + 1
            a, b = np.maximum(estimate(counters, left, level), 0), np.maximum(estimate(counters, right, level), 0)
            # the parent's count is better known than the children's: share it out
            both = a + b
            a = np.where(both > 0, a * here / np.where(both > 0, both, 1), here / 2)
            go = rank > a + 1e-9
            go &= here - a > 1e-9
            rank, here, node = np.where(go, rank - a, rank), np.where(go, here - a, a), np.where(go, right, left)
        out[:, k] = decode(node)
    out[n <= 0] = np.nan
    return out


def to_bytes(counters: np.ndarray) -> bytes:
    """A sketch for the way over the network: the narrowest integers that hold it, compressed."""
    m = np.abs(counters).max(initial=0)
    kind = 1 if m < 127 else 2 if m < 32767 else 4 if m < 2**31 - 1 else 8
    return bytes([kind]) + zlib.compress(counters.astype(f"<i{kind}").tobytes(), 1)


def from_bytes(b: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b[1:]), f"<i{b[0]}").astype(np.int64)


def _codes_to_bytes(codes: np.ndarray, weights: np.ndarray) -> bytes:
    """Sorted different codes and their counts."""
    step = np.diff(codes, prepend=0)
    m = np.abs(weights).max(initial=0)
    kind = 1 if m < 127 else 2 if m < 32767 else 4 if m < 2**31 - 1 else 8
    return b"\0" + bytes([kind]) + zlib.compress(step.astype("<i4").tobytes() + weights.astype(f"<i{kind}").tobytes(), 1)


def _codes_from_bytes(b: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(b[2:])
    n = len(raw) // (4 + b[1])
    return np.cumsum(np.frombuffer(raw, "<i4", n)).astype(np.int64), np.frombuffer(raw, f"<i{b[1]}", n, 4 * n).astype(np.int64)


def _packed(codes: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The different codes and the sums of their counts, without those of count 0."""
    code, at = np.unique(np.concatenate(codes), return_inverse=True)
    w = np.bincount(at, np.concatenate(weights), len(code)).round().astype(np.int64)
    return code[w != 0], w[w != 0]


def counters_of(parts: list[bytes]) -> np.ndarray:
    """The counters of each sketch (sketches x CELLS), however it travelled."""
    out = np.zeros((len(parts), CELLS), np.int64)
    few = [(i, *_codes_from_bytes(b)) for i, b in enumerate(parts) if not b[0]]
    for i, b in enumerate(parts):
        if b[0]:
            out[i] = from_bytes(b)
    if few:
        add(out, np.concatenate([np.full(len(c), i) for i, c, _ in few]), np.concatenate([c for _, c, _ in few]), np.concatenate([w for _, _, w in few]).astype(float))
    return out


# --- on tables --------------------------------------------------------------------------------------------------



def sketches(values: DataFrame, keys: list[str], metrics: list[str], weight: str | None = None) -> DataFrame:
    """Partial sketches (keys..., metric, n, sketch, block) of numeric columns: one per group and metric for each run of a partition.

    Null, NaN and infinite values are left out; a row with only those adds
    nothing. ``weight``: a column of whole counts, negative to delete. A null
    key is a key. Memory is bounded by OPEN_GROUPS groups: when more come up,
    the open ones are sent on and added up later like all partial sketches.
    """
    src = values.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics], *([F.col(weight).cast("bigint").alias("_w")] if weight else []))
    nk = len(keys)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:nk]] + ["metric string", "n bigint", "sketch binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(OPEN_GROUPS)
        kt: list[pa.Field] = []

        def out() -> Iterator[pa.RecordBatch]:
            yield from held.batches([*(f.name for f in kt), "metric", "n", "sketch"], [*(f.type for f in kt), pa.string()])

        for b in batches:
            kt = [b.schema.field(i) for i in range(nk)]
            table = pa.Table.from_batches([b])
            frame = list(zip(*(b.column(i).to_pylist() for i in range(nk)))) if nk else [()] * len(b)
            ids: dict[tuple, int] = {}
            row_group = np.fromiter((ids.setdefault(k, len(ids)) for k in frame), np.int64, len(frame))
            tuples = list(ids)
            w = table.column("_w").to_numpy().astype(float) if weight else None
            for m in metrics:
                x = table.column(m).to_numpy().astype(float)
                ok = np.flatnonzero(np.isfinite(x))
                # one number a group and code: both are sorted at once
                both = (row_group[ok] << BITS) | encode(x[ok])
                if w is None:
                    both, counts = np.unique(both, return_counts=True)
                else:
                    both, at = np.unique(both, return_inverse=True)
                    counts = np.bincount(at, w[ok], len(both)).round().astype(np.int64)
                groups, codes = both >> BITS, both & ((1 << BITS) - 1)
                present, first = np.unique(groups, return_index=True)
                for p, lo, hi in zip(present.tolist(), first.tolist(), [*first.tolist()[1:], len(groups)]):
                    if held.full((*tuples[p], m)):
                        yield from out()
                    held.codes((*tuples[p], m), codes[lo:hi], counts[lo:hi], int(counts[lo:hi].sum()))
        yield from out()

    return src.mapInArrow(run, schema).withColumn("block", F.floor(F.spark_partition_id() / BLOCK).cast("int"))


class _Held:
    """Sketches that are being added up: as codes, or as counters once they have many."""

    def __init__(self, most: int) -> None:
        self.most = most
        self.n: dict[tuple, int] = {}
        self.few: dict[tuple, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.size: dict[tuple, int] = {}
        self.held = 0
        self.many: dict[tuple, np.ndarray] = {}

    def full(self, key: tuple) -> bool:
        return key not in self.n and (len(self.n) >= self.most or len(self.many) >= OPEN_COUNTERS or self.held >= OPEN_CODES)

    def codes(self, key: tuple, code: np.ndarray, weight: np.ndarray, n: int) -> None:
        self.n[key] = self.n.get(key, 0) + n
        if key in self.many:
            add(self.many[key], np.zeros(len(code), np.int64), code, weight.astype(float))
            return
        own = self.few.setdefault(key, [])
        own.append((code, weight))
        self.size[key] = self.size.get(key, 0) + len(code)
        self.held += len(code)
        if self.size[key] > 2 * FEW:
            c, w = _packed(*map(list, zip(*own)))
            self.held += len(c) - self.size[key]
            self.few[key], self.size[key] = [(c, w)], len(c)
            if len(c) > FEW:
                self.many[key] = np.zeros((1, CELLS), np.int64)
                add(self.many[key], np.zeros(len(c), np.int64), c, w.astype(float))
                self.held -= len(c)
                del self.few[key], self.size[key]

    def sketch(self, key: tuple, b: bytes, n: int) -> None:
        if not b[0]:
            self.codes(key, *_codes_from_bytes(b), n)
            return
        self.n[key] = self.n.get(key, 0) + n
        if key not in self.many:
            self.many[key] = np.zeros((1, CELLS), np.int64)
            for c, w in self.few.pop(key, []):
                add(self.many[key], np.zeros(len(c), np.int64), c, w.astype(float))
            self.held -= self.size.pop(key, 0)
        self.many[key][0] += from_bytes(b)

    def batches(self, names: list[str], key_types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
        keys = list(self.n)
        for at in range(0, len(keys), 128):
            part = keys[at : at + 128]
            out = []
            for k in part:
                if k in self.many:
                    out.append(to_bytes(self.many[k][0]))
                    continue
                c, w = _packed(*map(list, zip(*self.few[k])))
                out.append(_codes_to_bytes(c, w))
            cols = [pa.array([k[i] for k in part], t) for i, t in enumerate(key_types)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([self.n[k] for k in part], pa.int64()), pa.array(out, pa.binary())], names=names)
        for d in (self.n, self.few, self.size, self.many):
            d.clear()
        self.held = 0


def _added(parts: DataFrame, group: list[str]) -> DataFrame:
    """Sketches added up to one per ``group``, as a stream over sorted partial sketches."""
    src = parts.select(*group, "n", "sketch").repartition(*group).sortWithinPartitions(*group)
    nk = len(group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held(OPEN_GROUPS)
        types: list[pa.DataType] = []
        for b in batches:
            types = [b.schema.field(i).type for i in range(nk)]
            for *k, m, s in zip(*(b.column(i).to_pylist() for i in range(nk + 2))):
                # sorted: a new group means that all groups held are whole
                if held.full(tuple(k)):
                    yield from held.batches([*group, "n", "sketch"], types)
                held.sketch(tuple(k), s, m)
        if types:
            yield from held.batches([*group, "n", "sketch"], types)

    return src.mapInArrow(run, src.schema)


def merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches added up to one per (keys..., metric); those of a ``block``, if there is such a column, first."""
    group = [*keys, "metric"]
    return _added(_added(parts, [*group, "block"]) if "block" in parts.columns else parts, group)


def answers(sk: DataFrame, qs: tuple[float, ...] = QUANTILES) -> DataFrame:
    """Each sketch's percentiles as columns p05, p25, ... in place of the sketch."""
    names = [f"p{round(q * 100):02d}" for q in qs]
    rest = [f for f in sk.schema.fields if f.name != "sketch"]
    src = sk.select(*[f.name for f in rest], "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, len(b), 128):
                part = b.slice(at, 128)
                v = quantiles(counters_of(part.column(len(rest)).to_pylist()), qs)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(pa.array(c, pa.float64(), mask=np.isnan(c)) for c in v.T)], names=[*(f.name for f in rest), *names])

    return src.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rest] + [f"{n} double" for n in names]))
