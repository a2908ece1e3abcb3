"""The thin queries of the operators, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import balltree, decontaminate, langid, line_dedup, nbest, shard_lp, simhash, token_counts, toxicity, warc
from sparkloom.ship import ship

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_lp.assign_shards(table(spark, sf_dir, "documents"))


def op2_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("th").distinct()


def op3_nbest_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.encode(table(spark, sf_dir, "documents"), keep_ids=False)


def op4_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_string_kernel_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_whole_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op7_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read(warc.archive_pages(table(spark, sf_dir, "pages")))


def op8_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs.select("doc_id", "text"), model).select("doc_id", "toxic_score", "toxic_pred")
    return scored.select("doc_id", langid.held_out().alias("held_out"), F.col("toxic_score").alias("score"), F.col("toxic_pred").alias("predicted"))


def op9_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(table(spark, sf_dir, "embeddings"))


def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def queries() -> dict[str, Query]:
    found = [
        op1_label_propagation, op2_template_decontamination, op3_nbest_segmentation, op4_simhash_tiles, op5_string_kernel_language,
        op6_whole_token_counts, op7_seekable_warc, op8_nnpu_toxicity, op9_ball_tree_top_k, op10_line_runs,
    ]
    return {f.__name__: f for f in found}


WARC_SQL = """
with p as (select page_id, coalesce(html, '') t from pages),
d as (select page_id, strlen(t)::bigint payload_bytes, sha1(t) h from p),
b as (select h, array_to_string(list_transform(string_split(h, ''), lambda x: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * strpos('0123456789abcdef', x) - 3, 4)), '') bits from d group by h),
e as (select h, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (16 * substr(bits, 5 * i + 1, 1)::int + 8 * substr(bits, 5 * i + 2, 1)::int + 4 * substr(bits, 5 * i + 3, 1)::int + 2 * substr(bits, 5 * i + 4, 1)::int + substr(bits, 5 * i + 5, 1)::int)::int, 1)), '') payload_digest from b),
k as (select h, max(page_id) kept from d group by h)
select page_id, payload_bytes, payload_digest, case when page_id = kept then 'response' else 'revisit' end record_type, case when page_id <> kept then kept end refers_to
from d join e using (h) join k using (h)
"""

TOP_K_SQL = """
with v as (select row_number() over () rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) v from embeddings
           where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.rid, q.vec_id query_id, c.rid cid, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::bigint score
      from v q join v c on q.vec_id % 20 = 0 and q.rid <> c.rid and len(q.v) = len(c.v)),
r as (select query_id, row_number() over (partition by rid order by score desc, vec_id, cid) as rank, vec_id, score from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_seekable_warc": WARC_SQL, "op9_ball_tree_top_k": TOP_K_SQL, "op10_line_runs": line_dedup.ORACLE}
