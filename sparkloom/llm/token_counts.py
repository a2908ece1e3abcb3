"""Token counts with a whole-token shortcut.

Offline, every vocabulary string is encoded alone; those that come out as one
token are proved whole. A text is cut into pre-tokens at points that no piece
crosses, so its count is the sum over its pre-tokens: those in the proved set
count one each, and only the rest are merged, once per distinct pre-token in a
bounded memo.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); special strings
are ordinary text, as the library's default has it; repeated rows are counted
each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm import pieces

MEMO = 400_000
#: Texts cut into pre-tokens at once.
CHUNK = 32


@lru_cache(maxsize=4)
def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings, proved by encoding each, that are one token when they stand alone as a pre-token."""
    strings = list(pieces.vocabulary(path))
    return frozenset(s for s, n in zip(strings, merged(path, strings), strict=True) if n == 1)


def merged(path: str, segments: list[str]) -> list[int]:
    """Tokens of each pre-token, merged by the library.

    The library puts a space mark in front of what it encodes. A pre-token that
    begins with one is given without it; another is shielded by a line feed,
    and that feed and the mark before it are two tokens of their own.
    """
    asked = [s[1:].replace(pieces.SPACE, " ") if s[0] == pieces.SPACE and len(s) > 1 else "\n" + s for s in segments]
    found = pieces.processor(path).encode(asked, num_threads=1)
    return [len(f) - 2 * (a[0] == "\n") for a, f in zip(asked, found, strict=True)]


class Counts:
    """Tokens by pre-token: the proved set, and a bounded memo of what was merged."""

    def __init__(self, path: str):
        self.path, self.known = path, dict.fromkeys(whole_tokens(path), 1)
        self.proved = len(self.known)

    def texts(self, texts: list[str | None]) -> list[int]:
        """Tokens of whole texts."""
        find = pieces.splitter(self.path).findall
        cut = [find(pieces.normalize(self.path, t)) if t else [] for t in texts]
        if len(self.known) > self.proved + MEMO:
            self.known = dict.fromkeys(whole_tokens(self.path), 1)
        rest = list(set().union(*cut) - self.known.keys())
        self.known.update(zip(rest, merged(self.path, rest), strict=True))
        return [sum(map(self.known.__getitem__, c)) for c in cut]


@lru_cache(maxsize=2)
def shared(path: str) -> Counts:
    """Kept for the life of a worker process, so that its tasks share one memo."""
    return Counts(path)


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row."""
    path = path or pieces.model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared(path)
        for b in batches:
            n = [k for i in range(0, len(b), CHUNK) for k in counts.texts(b.column(2)[i : i + CHUNK].to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long")
    counted = docs.select(F.col(id_col).alias("doc_id"), size.alias("n_bytes"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
