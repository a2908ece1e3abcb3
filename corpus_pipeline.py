"""A training-corpus pipeline of five stages, each applying one operator of ``sparkloom.llm``.

Defined cases: extra columns, whatever their names, pass through all stages but the
last, which returns the operator's own columns; null and empty texts are scored as
texts without features, have no lines to lose, are one group in the near-dedup
(so one of them stays), match no benchmark item, and have null or no pieces; rows
with null or repeated ids are decided by id and text; of rows equal in both, the
near-dedup keeps one; very long texts are processed whole; an empty table passes
through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import decontaminate, line_dedup, nbest, simhash, toxicity
from sparkloom.llm.names import fresh, quoted
from sparkloom.scratch import cut
from sparkloom.ship import ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic; it learns from the labels beside the documents."""
    model = toxicity.fit(docs, ship(spark).read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).where(F.col(fresh("toxic_pred", docs.columns)) == 0).select(*map(quoted, docs.columns))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, later copies of repeated line runs cut out; n_chars follows the text."""
    removed = F.col(fresh("n_removed", docs.columns)) > 0
    size = F.when(removed, F.length("text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    return line_dedup.dedup_lines(docs).select(*[size if c == "n_chars" else F.col(quoted(c)) for c in docs.columns])


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    ship(spark)
    return simhash.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, ship(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids and the N best segmentations' scores of every document."""
    ship(spark)
    return nbest.encode(docs)


STAGES = [("toxicity", drop_toxic), ("line dedup", dedup_lines), ("simhash near-dedup", dedup_near), ("benchmark decontamination", decontaminated), ("sentencepiece", encoded)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again."""
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The stages are not expressible in SQL; tests hold them against brute force.
ORACLE_SQL = None
