"""Queries of the text problems (p8 to p10) on the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import abuse, leakage, packing


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    """The container of every text, or of every piece of a text larger than one, and the share filled."""
    return packing.pack_texts(table(spark, d, "documents"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """How well containers are used: their number, tokens and mean share filled."""
    each = p8_containers(spark, d).groupBy("container_id").agg(F.sum("tokens").alias("tokens"), F.first("filled").alias("filled"))
    return each.agg(F.count(F.lit(1)).alias("containers"), F.sum("tokens").alias("tokens"), F.avg("filled").alias("mean_filled"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold a passage of a test item, and the item."""
    return leakage.leaked(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id")


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    """Per leaked test item, how many documents hold it and the longest passage."""
    hits = leakage.leaked(table(spark, d, "documents"), table(spark, d, "eval_items"))
    return hits.groupBy("item_id").agg(F.count_distinct("doc_id").alias("n_documents"), F.max("n_words").alias("longest"))


def p9_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Every document without the passages of test items it holds."""
    return leakage.cleaned(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    """Score of every document and its worst passage."""
    return abuse.score_documents(table(spark, d, "documents"), table(spark, d, "content_labels"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents with at least one abusive, hateful or sexual passage."""
    return p10_scores(spark, d).where(F.col("score") >= 1).select("doc_id")


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    """Share of such documents per source."""
    bad = (F.col("score") >= 1).cast("double")
    return p10_scores(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum(bad).cast("long").alias("flagged"), F.avg(bad).alias("rate"))


def queries() -> dict:
    return {f.__name__: f for f in (p8_containers, p8_fill, p9_found, p9_items, p9_cleaned, p10_found, p10_scores, p10_rates)}


def oracle_sql() -> dict[str, str]:
    return {}
