"""How the library's operators are applied to the driver's tables.

``documents`` plays the source documents, ``benchmark`` the protected records;
a repository group is (source, doc_id div 10).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.ship import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def repo() -> Column:
    return F.concat(F.col("source"), F.lit("/"), F.floor(F.col("doc_id") / 10).cast("string"))


def protected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item_id, text``: the benchmark, and every fiftieth document as a record that must not recur."""
    held = table(spark, sf_dir, "documents").where("doc_id % 50 = 0").select((F.col("doc_id") + 1_000_000).alias("item_id"), "text")
    return table(spark, sf_dir, "benchmark").select("item_id", "text").unionByName(held)


PROTECTED = "(select item_id, text from benchmark union all select doc_id + 1000000, text from documents where doc_id % 50 = 0)"
REPO = "(source || '/' || (doc_id // 10)::varchar)"
TOKENS = r"regexp_extract_all(replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]')"
SHINGLES = "case when len(tk) < 5 then ['short ' || array_to_string(tk, ' ')] else list_distinct(list_transform(range(len(tk) - 4), lambda i: array_to_string(tk[i + 1:i + 5], ' '))) end"
U64LE = "unhex(array_to_string(list_transform(range(8), lambda i: substr(printf('%016x', {0}), (15 - 2 * i)::int, 2)), ''))"
