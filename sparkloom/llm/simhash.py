"""SimHash near-duplicates by tiled exact comparison.

Fingerprints of equal value are one class. By the pigeonhole principle two
fingerprints at ``radius`` or fewer differing bits agree on at least
``blocks - radius`` of ``blocks`` bit blocks, so classes meet in the cells of
those blocks' values; in a cell, tiles sorted by population count are compared
by numpy exclusive-or and bit counts, and tile pairs whose population counts
differ beyond the radius are skipped. A cell returns a spanning forest, never
all its pairs. The number of key bits follows the number of classes, so a cell
keeps its size as the table grows; a cell that is still large (many near
copies) is cut into tiles whose pairs go to separate tasks.

Defined cases: null, empty and blank texts have fingerprint zero and link like
any other; a text of fewer words than a shingle is one shingle; very long texts
are hashed whole; a bit that exactly half of the shingles have is 0; repeated
rows share a class; rows with a null id are members but never name a component
unless all are null; an empty table gives an empty result; extra columns,
whatever their names, are ignored by ``near_duplicates`` and kept by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.components import connected_components
from sparkloom.llm.names import fresh
from sparkloom.scratch import cut, drop, small_side

CELL = 2048
TILE = 256


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of the word shingles of a whole text."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) < words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(found), seed)]
    else:
        joined, ends, at = b" ".join(found), [], -1
        for w in found:
            at += len(w) + 1
            ends.append(at)
        starts = [0] + [e + 1 for e in ends[: len(found) - words]]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], seed) for a, b in zip(starts, ends[words - 1 :], strict=True)]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        part = np.array(hashes[i : i + 65536], dtype=np.uint64)
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, words: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` of every row, fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), words, seed) for t in b.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def scheme(n: int, radius: int) -> list[list[tuple[int, int]]]:
    """Bit ranges (shift, width) of each table's key: as few blocks as keep a uniform cell near CELL classes."""
    need = max(0, int(n / CELL).bit_length())
    for blocks in range(radius + 1, 65):
        edges = [64 * i // blocks for i in range(blocks + 1)]
        ranges = [(edges[i], edges[i + 1] - edges[i]) for i in range(blocks)]
        keep = blocks - radius
        if keep * (64 // blocks) >= need or blocks == 2 * radius + 6:
            break
    tables = []
    for chosen in combinations(ranges, keep):
        left, key = need, []
        for i, (shift, width) in enumerate(chosen):
            w = min(width, -(-left // (keep - i)))
            left -= w
            key.append((shift, w))
        tables.append(key)
    return tables


def near_links(fps: DataFrame, n: int, radius: int = 3, cell: int = 2 * CELL) -> DataFrame:
    """``u, v`` links between distinct fingerprints ``fp``: a spanning forest of the links in each cell."""
    tables = []
    for t, key in enumerate(scheme(n, radius)):
        value = F.lit(0).cast("long")
        for shift, width in key:
            value = F.shiftleft(value, width).bitwiseOR(F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1)))
        tables.append(F.struct(F.lit(t).alias("t"), value.alias("k")))
    keyed = cut(fps.select("fp", F.inline(F.array(*tables))), "cells")
    sizes = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell)
    hot = cut(sizes.withColumn("parts", F.ceil(F.col("n") / cell).cast("int")).drop("n"), "hot")
    joined = keyed.join(hot, ["t", "k"], "left")
    calm = joined.where("parts is null").select("t", "k", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp")
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    busy = joined.where("parts is not null").withColumn("p", part).select("t", "k", "p", "fp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("q"))
    busy = busy.where("p <> q").select("t", "k", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), "fp")
    rows = calm.unionByName(busy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by cell; one cell at a time is held."""
        held, at = [], None
        for b in batches:
            keys = np.stack([np.asarray(b.column(c)) for c in range(4)], axis=1)
            fp = np.asarray(b.column(4)).view(np.uint64)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(fp)]
            out = []
            for a, z in zip(cuts, cuts[1:], strict=False):
                if a == z:
                    continue
                if at is not None and tuple(keys[a]) != at:
                    out.append(forest(np.concatenate(held), radius))
                    held = []
                at = tuple(keys[a])
                held.append(fp[a:z])
            yield from _links(out)
        if held:
            yield from _links([forest(np.concatenate(held), radius)])

    spread = rows.repartition("t", "k", "i", "j").sortWithinPartitions("t", "k", "i", "j")
    return spread.select("t", "k", "i", "j", "fp").mapInArrow(run, "u long, v long")


def _links(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    if found:
        uv = np.concatenate(found).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(uv[:, 0]), pa.array(uv[:, 1])], names=["u", "v"])


def forest(fp: np.ndarray, radius: int) -> np.ndarray:
    """(member, root) rows of the linked classes of one cell, compared tile by tile."""
    if len(fp) < 2:
        return np.empty((0, 2), np.uint64)
    bits = np.bitwise_count(fp)
    order = np.lexsort((fp, bits))
    fp, bits = fp[order], bits[order].astype(np.int64)
    up = np.arange(len(fp))

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a in range(0, len(fp), TILE):
        for b in range(a, len(fp), TILE):
            if bits[b] - bits[min(a + TILE, len(fp)) - 1] > radius:
                break  # this tile and all later ones have too many ones
            near = np.bitwise_count(fp[a : a + TILE, None] ^ fp[None, b : b + TILE]) <= radius
            xs, ys = np.nonzero(np.triu(near, 1) if a == b else near)
            for x, y in zip((xs + a).tolist(), (ys + b).tolist(), strict=True):
                x, y = find(x), find(y)
                if x != y:
                    up[max(x, y)] = min(x, y)
    roots = np.array([find(i) for i in range(len(fp))])
    own = roots != np.arange(len(fp))
    return np.stack([fp[own], fp[roots[own]]], axis=1)


def labelled(marked: DataFrame, radius: int) -> DataFrame:
    """``fp, first, label`` of every fingerprint: its smallest id, and one label for all it is linked to."""
    classes = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    labels = connected_components(near_links(classes.select("fp"), classes.count(), radius))
    return classes.join(labels, F.col("fp") == F.col("id"), "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row; component_id is the smallest id reachable over links."""
    marked = cut(with_fingerprints(docs, words, seed, id_col, text_col), "fingerprints")
    joined = labelled(marked, radius)
    names = joined.groupBy("label").agg(F.min("first").alias("component_id"))
    named = cut(joined.select("fp", "label").join(names, "label").select("fp", "component_id"), "named")
    return marked.join(named, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = 3, radius: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id (null only if all are) and, among equal ids, the smallest text hash; of rows equal in both, one."""
    marked = cut(_hashed(docs, words, seed, id_col, text_col), "fingerprints")
    labels = labelled(marked, radius)
    rows = marked.join(labels, "fp").groupBy("label", "doc_id", "th").agg(F.count(F.lit(1)).alias("n"))
    rows = cut(rows, "components")
    kept = rows.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "th")).alias("first"))
    judged = cut(rows.join(kept, "label").withColumn("keep", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th"))).select("doc_id", "th", "n", "keep"), "judged")
    text, at_id, at_th = F.col(text_col), fresh("at_id", docs.columns), fresh("at_th", docs.columns)
    same = F.col(id_col).eqNullSafe(F.col(at_id)) & (_text_hash(text) == F.col(at_th))
    at = [F.col("doc_id").alias(at_id), F.col("th").alias(at_th)]
    gone = small_side(cut(judged.where("not keep").select(*at), "gone"))
    left = docs.join(gone, same, "left_anti")
    again = small_side(cut(judged.where("keep and n > 1").select(*at), "again"))
    drop(marked)
    drop(rows)
    drop(judged)
    if again.isEmpty():
        return left
    return left.join(again, same, "left_anti").unionByName(left.join(again, same, "left_semi").dropDuplicates([id_col, text_col]))


def _text_hash(text: Column) -> Column:
    """Equal for equal texts only: a null text is not an empty one."""
    return F.xxhash64(text, text.isNull())


def _hashed(docs: DataFrame, words: int, seed: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, th, fp`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), words, seed) for t in b.column(2)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps)], names=["doc_id", "th", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), _text_hash(F.col(text_col)).alias("th"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, th long, fp long")
