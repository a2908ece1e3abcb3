"""Byte-pair merges: counting, learning rules, encoding and decoding.

Ids 0 to 3 are reserved, 4 to 259 are the bytes, later ones the merges.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.scratch import cut

FIRST_BYTE, FIRST_MERGE = 4, 260
Rules = list[tuple[int, int]]


def encode_bytes(raw: bytes, rules: Rules) -> list[int]:
    """Ids of a byte string: the lowest rule applies first, leftmost first."""
    rank = {p: i for i, p in enumerate(rules)}
    ids = [FIRST_BYTE + b for b in raw]
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    heap = [(rank[p], i, p) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in rank]
    heapq.heapify(heap)
    while heap:
        r, i, pair = heapq.heappop(heap)
        j = after[i] if ids[i] is not None else len(ids)
        if j >= len(ids) or (ids[i], ids[j]) != pair:
            continue
        ids[i], ids[j], after[i] = FIRST_MERGE + r, None, after[j]
        if after[i] < len(ids):
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < len(ids) and (p := (ids[k], ids[after[k]])) in rank:
                heapq.heappush(heap, (rank[p], k, p))
    return [x for x in ids if x is not None]


def pieces(rules: Rules) -> list[bytes | None]:
    """The bytes of every id; None for the reserved ones."""
    out: list[bytes | None] = [None] * FIRST_BYTE + [bytes([b]) for b in range(256)]
    for a, b in rules:
        out.append(out[a] + out[b])
    return out


def decode_ids(ids: list[int], rules: Rules) -> bytes:
    """The bytes of ids; reserved and unknown ids are refused."""
    table = pieces(rules)
    if any(not FIRST_BYTE <= i < len(table) for i in ids):
        raise ValueError("reserved or unknown id")
    return b"".join(table[i] for i in ids)


def encode(docs: DataFrame, rules: Rules, key: str = "doc_id", content: str = "text") -> DataFrame:
    """``key, ids`` of each row; a null text has none."""

    def run(batches):
        for batch in batches:
            ids = [encode_bytes(x or b"", rules) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=[key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, F.col(content).cast("binary").alias("raw")).mapInArrow(run, f"{key} {kind}, ids array<int>")


def decode(encoded: DataFrame, rules: Rules, key: str = "doc_id") -> DataFrame:
    """``key, raw`` of each row of ids: the bytes they stand for; reserved and unknown ids fail the run."""
    table = pieces(rules)

    def run(batches):
        for batch in batches:
            raw = []
            for ids in batch.column(1).to_pylist():
                if any(not FIRST_BYTE <= i < len(table) for i in ids):
                    raise ValueError("reserved or unknown id")
                raw.append(b"".join(map(table.__getitem__, ids)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=[key, "raw"])

    return encoded.select(key, "ids").mapInArrow(run, f"{key} {encoded.schema[key].dataType.simpleString()}, raw binary")


def pair_counts(words: DataFrame) -> DataFrame:
    """``l, r, n`` over ``ids, n`` rows: adjacent pairs, weighted; partial sums come before the shuffle."""
    zipped = F.transform(F.sequence(F.lit(1), F.size("ids") - 1), lambda i: F.struct(F.get("ids", i - 1).alias("l"), F.get("ids", i).alias("r")))
    pairs = words.where(F.size("ids") > 1).select(F.explode(zipped).alias("p"), "n")
    return pairs.groupBy("p.l", "p.r").agg(F.sum("n").alias("n"))


def merged(ids, a: int, b: int, new: int):
    """The array with each (a, b) joined, leftmost first."""
    put = lambda s, x: F.when((F.size(s) > 0) & (F.element_at(s, -1) == a) & (x == b), F.concat(F.slice(s, 1, F.size(s) - 1), F.array(F.lit(new)))).otherwise(F.concat(s, F.array(x)))
    return F.aggregate(ids, F.array().cast("array<int>"), put)


def train(docs: DataFrame, merges: int, least: int = 2, content: str = "text", cut_every: int = 8) -> Rules:
    """Learn ``merges`` rules over whole texts: most frequent pair first, ties to the lowest ids.

    Pairs may cross spaces, as the rules are over documents. Equal texts are
    counted once with their number. Each round aggregates pairs on the cluster
    and takes one row to the driver; the lineage is cut every few rounds.
    """
    hexes = F.hex(F.col(content).cast("binary"))
    ids = F.transform(F.sequence(F.lit(1), F.length(hexes) - 1, F.lit(2)), lambda i: FIRST_BYTE + F.conv(F.substr(hexes, i, F.lit(2)), 16, 10).cast("int"))
    words = cut(docs.where(F.octet_length(F.col(content)) > 1).select(ids.alias("ids")).groupBy("ids").agg(F.count(F.lit(1)).alias("n")), "words")
    rules: Rules = []
    while len(rules) < merges:
        best = pair_counts(words).orderBy(F.desc("n"), "l", "r").limit(1).collect()
        if not best or best[0]["n"] < least:
            raise ValueError("the texts have no further pair of the least frequency")
        a, b = best[0]["l"], best[0]["r"]
        hit = F.exists(F.arrays_zip(F.col("ids").alias("x"), F.slice("ids", 2, F.greatest(F.size("ids") - 1, F.lit(1))).alias("y")), lambda p: (p["x"] == a) & (p["y"] == b))
        words = words.withColumn("ids", F.when(hit, merged(F.col("ids"), a, b, FIRST_MERGE + len(rules))).otherwise(F.col("ids")))
        rules.append((a, b))
        if len(rules) % cut_every == 0:
            words = cut(words, "words")
    return rules
