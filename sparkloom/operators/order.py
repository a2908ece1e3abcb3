"""Seeded orders and greedy admission."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.scratch import cut

MASK = 0xFFFFFFFF


def _quarter(s: list[int], a: int, b: int, c: int, d: int) -> None:
    for x, y, z, turn in ((a, b, d, 16), (c, d, b, 12), (a, b, d, 8), (c, d, b, 7)):
        s[x] = (s[x] + s[y]) & MASK
        v = s[z] ^ s[x]
        s[z] = ((v << turn) | (v >> (32 - turn))) & MASK


def chacha_words(seed: bytes, rounds: int = 12) -> Iterator[int]:
    """The ChaCha key stream of a 32-byte seed as 32-bit words: 64-bit block counter, zero nonce."""
    key, block = struct.unpack("<8I", seed), 0
    while True:
        start = [*struct.unpack("<4I", b"expand 32-byte k"), *key, block & MASK, block >> 32, 0, 0]
        s = list(start)
        for _ in range(rounds // 2):
            for i in range(4):
                _quarter(s, i, 4 + i, 8 + i, 12 + i)
            for i in range(4):
                _quarter(s, i, 4 + (i + 1) % 4, 8 + (i + 2) % 4, 12 + (i + 3) % 4)
        yield from ((x + y) & MASK for x, y in zip(s, start, strict=True))
        block += 1


def chacha_u64(seed: bytes, rounds: int = 12) -> Iterator[int]:
    words = chacha_words(seed, rounds)
    for low in words:
        yield low | next(words) << 32


def shuffled(n: int, seed: bytes) -> list[int]:
    """0 to n-1 in a uniform order: exchanges from the end, positions drawn without bias."""
    out, draw = list(range(n)), chacha_u64(seed)
    for last in range(n - 1, 0, -1):
        size = last + 1
        floor = (1 << 64) % size
        x = next(v for v in draw if v >= floor)
        out[last], out[x % size] = out[x % size], out[last]
    return out


def span_order(spark: SparkSession, prefix_ids: int, seed: bytes, span: int = 2048) -> DataFrame:
    """``ord, first_target, targets`` of all spans of a prefix; a partial span comes last.

    The exact order is a sequential exchange over span numbers, one per ``span``
    ids, so the driver makes it; its memory is 8 bytes per span.
    """
    targets = prefix_ids - 1
    if targets < 1:
        raise ValueError("a prefix needs two ids at least")
    rows = [(i, k * span, span) for i, k in enumerate(shuffled(targets // span, seed))]
    if targets % span:
        rows.append((len(rows), targets // span * span, targets % span))
    return spark.createDataFrame(pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("ord", "first_target", "targets"), zip(*rows, strict=True), strict=True)}))


def span_seed(domain: str, *digests: str) -> bytes:
    return hashlib.sha256(domain.encode() + b"".join(bytes.fromhex(d) for d in digests)).digest()


def span_order_valid(spans: DataFrame, targets: int, span: int = 2048) -> DataFrame:
    """One row: whether ``ord`` is dense, every complete span comes once and aligned, a partial one is last, and all targets are covered."""
    full, last = targets // span, F.max("ord")
    part = F.col("targets") < span
    return spans.agg(
        (F.min("ord") == 0).alias("from_zero"), ((last + 1 == F.count(F.lit(1))) & (F.count_distinct("ord") == F.count(F.lit(1)))).alias("dense"),
        ((F.count_if(~part) == full) & (F.count_distinct(F.when(~part, F.col("first_target"))) == full)).alias("complete"),
        (F.count_if(~part & (F.col("first_target") % span != 0)) == 0).alias("aligned"),
        ((F.count_if(part) == int(targets % span > 0)) & (F.coalesce(F.max(F.when(part, F.col("ord"))), last) == last)).alias("partial_last"),
        (F.sum("targets") == targets).alias("covered"),
    )


def spans_in_order(spans: DataFrame, span: int = 2048) -> Iterator:
    """Rows ``first_id, valid_targets`` in order, fetched a partition at a time; a gap, an overlap or a short span before the last fails."""
    at, whole = 0, True
    for row in spans.orderBy("first_id").toLocalIterator(prefetchPartitions=True):
        if row["first_id"] != at or not whole or not 0 < row["valid_targets"] <= span:
            raise ValueError(f"the spans are not contiguous at {at}")
        at, whole = at + row["valid_targets"], row["valid_targets"] == span
        yield row


def load_spans(spans: DataFrame) -> tuple[int, int, int]:
    """Spans, targets and the last start of what :func:`spans_in_order` hands out."""
    n, targets, last = 0, 0, 0
    for row in spans_in_order(spans):
        n, targets, last = n + 1, targets + row["valid_targets"], row["first_id"]
    return n, targets, last


def greedy_admission(rows: DataFrame, order: list[Column], key: str, group: str, size: str, group_cap: int, cap: int) -> DataFrame:
    """``key, admitted``: rows in ``order`` are admitted while their group's and the whole sum stay within the caps; a row that doesn't fit is passed over.

    Which rows are admitted depends on all rows before, so this is one ordered
    stream over narrow rows. Its state is one sum per group; the sort spills.
    """
    kind = rows.schema[key].dataType

    def run(batches):
        total, sums = 0, {}
        for batch in batches:
            flags = []
            for g, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                fits = sums.get(g, 0) + n <= group_cap and total + n <= cap
                flags.append(fits)
                if fits:
                    sums[g] = sums.get(g, 0) + n
                    total += n
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(flags, pa.bool_())], names=[key, "admitted"])

    # written first, so that what computes the sizes runs in parallel and only narrow rows meet in one task
    ordered = cut(rows.select(key, group, F.col(size).cast("long").alias(size), *[c.alias(f"_o{i}") for i, c in enumerate(order)]), "ordered").coalesce(1)
    ordered = ordered.sortWithinPartitions(*[f"_o{i}" for i in range(len(order))]).select(key, group, size)
    return ordered.mapInArrow(run, f"{key} {kind.simpleString()}, admitted boolean")
