"""Writing: generations that are published once, parts bound by digests, token shards."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_boundary(target: str, inputs: list[str]) -> None:
    """Refuse a target that exists, overlaps an input, or lies in a repository's own folder."""
    full = os.path.abspath(target)
    inside = lambda a, b: a == b or a.startswith(b.rstrip("/") + "/")
    if os.path.lexists(full) or ".git" in full.split("/"):
        raise ValueError("the target exists or is not allowed")
    if any(inside(full, os.path.abspath(i)) or inside(os.path.abspath(i), full) for i in inputs):
        raise ValueError("the target overlaps an input")


def publish(df: DataFrame, path: str) -> None:
    """Write a generation to a sibling folder and rename it; an existing target is never replaced, a failed one leaves nothing."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target, partial = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + ".partial")
    fs = target.getFileSystem(conf)
    if fs.exists(target):
        raise FileExistsError(path)
    try:
        df.write.mode("errorifexists").parquet(partial.toString())
        if not fs.rename(partial, target):
            raise FileExistsError(path)
    except BaseException:
        fs.delete(partial, True)
        raise


def content_tree(df: DataFrame, path: str, key: str = "source_id", content: str = "content") -> None:
    """The content tree as a table, 256 folders by the key's first digits; one file per document doesn't scale on object stores."""
    publish(df.select(key, content, F.substring(key, 1, 2).alias("prefix")).repartition("prefix"), path)


def sharded_manifest(rows: DataFrame, size: int = 50_000) -> DataFrame:
    """Index of parts of ``rows`` (part, ordinal, line): ``part, rows, bytes, sha256`` of the lines in order."""
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "line"))), lambda x: x["line"]), "\n")
    out = rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), lines.alias("body"))
    return out.select("part", "rows", F.octet_length("body").cast("long").alias("bytes"), F.sha2("body", 256).alias("sha256"))


@F.pandas_udf(T.BinaryType())
def u16le(ids: pd.Series) -> pd.Series:
    """Token ids as 16-bit little-endian words."""
    return ids.map(lambda x: np.asarray(x, "<u2").tobytes())


def token_shards(docs: DataFrame, size: int = 4_194_304) -> DataFrame:
    """``split, shard, first, ids`` pieces of documents (split, first_id, ids): a document is cut where a shard ends, so a shard is the pieces in order."""
    n = F.size("ids").cast("long")
    rows = docs.where(n > 0).withColumn("shard", F.explode(F.sequence(F.floor(F.col("first_id") / size), F.floor((F.col("first_id") + n - 1) / size))))
    low = F.greatest(F.col("shard") * size, F.col("first_id"))
    high = F.least((F.col("shard") + 1) * size, F.col("first_id") + n)
    return rows.select("split", "shard", low.alias("first"), F.slice("ids", (low - F.col("first_id") + 1).cast("int"), (high - low).cast("int")).alias("ids"))


def write_token_shards(docs: DataFrame, path: str, size: int = 4_194_304) -> None:
    """Shards as a table by split and shard; a range read prunes to the shards it meets."""
    token_shards(docs, size).repartition("split", "shard").sortWithinPartitions("split", "shard", "first").write.mode("errorifexists").partitionBy("split", "shard").parquet(path)


def read_range(shards: DataFrame, split: str, first: int, n: int, size: int = 4_194_304) -> DataFrame:
    """``pos, id`` of a range of a split, from its own shards only."""
    near = shards.where((F.col("split") == split) & F.col("shard").between(first // size, (first + n - 1) // size))
    return near.select("first", F.posexplode("ids").alias("i", "id")).select((F.col("first") + F.col("i")).alias("pos"), "id").where(F.col("pos").between(first, first + n - 1))


def single_file(text: str, path: str) -> None:
    """One small file, made new and whole."""
    partial = f"{path}.partial"
    with open(partial, "x") as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    try:
        os.link(partial, path)
    finally:
        os.unlink(partial)
