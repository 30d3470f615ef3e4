"""A corpus from raw documents: rules, near duplicates, secrets, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as the next one's
docs. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lantern.llm import bpe, mixing, quality_rules, queries, secret_scan, setjoin
from lantern.llm.common import small, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, judged row by row: the verdict is computed beside the row itself."""
    return quality_rules.kept_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates, one row: of the least id (null ids last), and one of its rows if it has several.
    Rows without an id or a text are judged like others; those that link with nothing stay."""
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")  # so that a row keeps its number
    name = F.struct(F.col("doc_id").isNull().alias("last"), F.coalesce("doc_id", F.lit(0)).alias("id"), "_row")
    chosen = setjoin.join(rows.withColumn("_name", name), id_col="_name").filter("doc_id = component_id")
    chosen = written(chosen.select("doc_id._row"), "chosen")
    return rows.join(small(chosen), "_row", "left_semi").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked, and n_chars follows."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, in the order of the mix of sources."""
    return mixing.ordered(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes, with each row's slot and position in the mix: the schedule
    depends on the rows alone, so they are the places in which the stage before wrote the rows."""
    placed = mixing.mix(docs, whole=True).select(F.struct("doc_id", "slot", "position").alias("place"), F.col("row.text").alias("text"))
    counted = bpe.round_trip(placed, *queries.tokenizer(), id_col="place")  # doc_id, of a type of its own, is the place
    return counted.select("doc_id.doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "doc_id.slot", "doc_id.position")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mix", mix), ("tokens", tokens)]

#: Components of similar sets, the schedule and the merges aren't expressed in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
