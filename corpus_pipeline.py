"""Corpus preparation: quality, near duplicates, repeated passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, of the columns of docs except the last. A
stage's docs are what its predecessor wrote, so nothing is computed twice and a lost executor repeats
one stage at most. Rows without doc_id and repeated rows pass as the operators define it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import decontaminate, jaccard_join, packing, quality_rules, substring_dedup
from pulsegrid.llm.tables import cut_lineage, table, written

#: Rows up to this many (16 bytes each) are broadcast, more are joined by a shuffle.
BROADCAST_ROWS = 2_000_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labels that are not held out.

    Null and empty texts are judged by statistics that are all 0, rows without id and repeated rows like others.
    """
    return quality_rules.keep_good(docs, quality_rules.fit_quality(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates: that with the least doc_id, ids before null, then by the text's hash.

    It is decided by row, so rows of one id are no copies of each other for that alone, and a group always keeps
    a row. Of equal rows one stays. Null, empty and blank texts have no group and all stay.
    """
    found = cut_lineage(jaccard_join.jaccard_rows(docs).where("n_shingles > 0").select("doc_id", "row_key", "component"))
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias("first"))
    kept = first.select(F.col("first.doc_id").alias("doc_id"), F.col("first.row_key").alias("row_key"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (jaccard_join.row_key() == F.col("__key"))
    named = lambda rows: rows.select(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key"))
    sized = lambda rows: F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows
    counted = found.groupBy("doc_id", "row_key").agg(F.count("*").alias("n"))
    gone = cut_lineage(counted.join(kept.withColumn("kept", F.lit(True)), [counted.doc_id.eqNullSafe(kept.doc_id), counted.row_key == kept.row_key], "left").where("kept is null or n > 1").select(counted.doc_id, counted.row_key, "n", "kept"))
    out = docs.join(sized(named(gone)), same, "left_anti")
    again = gone.where("kept")
    if again.isEmpty():
        return out
    once = docs.join(sized(named(again)), same).drop("__id", "__key").withColumn("__row", jaccard_join.row_key())
    return out.unionByName(once.dropDuplicates(["doc_id", "__row"]).drop("__row"))


def _others(docs: DataFrame) -> tuple[str, ...]:
    return tuple(c for c in docs.columns if c != "text")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without words that repeat earlier passages; documents of which nothing is left go.

    Null and empty texts stay as they are. Rows equal in id and text do not cut each other; rows without id come last.
    """
    cut = substring_dedup.dedup_substrings(docs, as_is=True, carry=_others(docs))
    left = cut.where((F.col("n_removed") == 0) | (F.col("kept") != "")).withColumn("text", F.col("kept"))
    size = F.when(F.col("n_removed") > 0, F.char_length("kept")).otherwise(F.col("carried.n_chars")).cast("long")
    return left.select(*[F.col(c) if c == "text" else size.alias(c) if c == "n_chars" else F.col(f"carried.`{c}`") for c in docs.columns])


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item; null and empty texts have none and stay, as do rows without id."""
    spans = decontaminate.benchmark_spans(docs, table(spark, sf_dir, "benchmark"), keep_text=True, carry=_others(docs))
    return spans.where("n_hit = 0").select(*[F.col(c) if c == "text" else F.col(f"carried.`{c}`") for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens, with their ids and the ids' digest.

    Null and empty texts are a piece of the end token alone; each row is packed for itself, repeated or without id.
    """
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("benchmark_passages", benchmark_passages),
    ("packing", pack),
]

#: Fitted rules and near-duplicate groups are beyond SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
