"""Sizes of documents in tokens of a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: A rank file (token in base64, rank) that every executor can read. A parameter everywhere; never copied.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The published split pattern of this family of vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


@functools.lru_cache(2)
def encoding(path: str):  # noqa: ANN201
    """The encoding of a rank file; built once per Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("voxloom", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def n_tokens(text: str | None, path: str) -> int:
    """Tokens of the whole text; 0 for null. Text that no UTF-8 can hold counts with its bad characters replaced."""
    if not text:
        return 0
    return len(encoding(path).encode_ordinary(text))


def sizes(docs: DataFrame, keep: list[str], text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """``keep`` and ``n_tokens`` (bigint), one row for each row; 0 for a null or empty text.

    Only the columns ``keep`` go through Python beside the text, only the size
    comes back: no text is shuffled after this.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [n_tokens(t, path) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*b.schema.names[:-1], "n_tokens"])

    src = docs.select(*keep, F.col(text).alias("_text_to_count"))
    return src.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]] + ["n_tokens bigint"]))
