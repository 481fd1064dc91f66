"""From raw documents to training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages it is written as Parquet and
read again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.llm import jaccard, packing, quality, substrings, tables, toxicity


def _with_row(docs: DataFrame) -> DataFrame:
    """Only what operators read, and the whole row apart, so its columns clash with none of theirs."""
    return docs.select(F.struct("*").alias("row"), "doc_id", "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the classifier, fitted to their labels, calls toxic."""
    model = toxicity.fit(docs, tables.read_table(spark, sf_dir, "labels"))
    scored = toxicity.score(_with_row(docs), model)
    return scored.filter(F.col("score") < toxicity.THRESHOLD).select("row.*")


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that fail the base rules or the log-likelihood ratio."""
    judged = quality.judge(_with_row(docs), tables.read_table(spark, sf_dir, "labels"))
    return judged.filter("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the least doc_id. Rows of one doc_id are
    documents of their own, the first of them that with the least text hash; rows without a doc_id are
    compared with nothing and stay.

    Rows get any number of their own, stored with them, and only numbers and hashes are ordered: no text
    is sorted, and each is stored once."""
    rows = tables.stage(
        docs.filter(F.col("doc_id").isNotNull()).select(
            F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")
        ),
        "pipeline-rows",
    )
    text = F.col("row.text").cast("string")
    found = jaccard.near_documents(rows.select(F.col("number").alias("doc_id"), text.alias("text")))
    keys = rows.select(
        F.col("row.doc_id").alias("own"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g"), "number"
    )
    least = (
        found.select(F.col("doc_id").alias("number"), "component_id")
        .join(keys, "number")
        .groupBy("component_id")
        .agg(F.min(F.struct("own", "h", "g", "number")).alias("least"))
    )
    kept = tables.stage(least.select("least.number"), "pipeline-kept")
    one = rows.join(kept, "number", "left_semi").select("row.*")
    return one.unionAll(docs.filter(F.col("doc_id").isNull()))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the words under a window of twenty that stands earlier. A text that loses words is
    the rest joined by single spaces; it may be empty, and its document stays."""
    cut = substrings.remove_repeats(_with_row(docs))
    row = F.col("row").withField(
        "text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("row.text"))
    )
    if "n_chars" in docs.columns:
        length = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
        row = row.withField(
            "n_chars", F.when(F.col("n_removed") > 0, length).otherwise(F.col("row.n_chars"))
        )
    return cut.select(row.alias("row")).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("ngram_jaccard", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("packing", pack),
]

# Fitting a classifier and encoding tokens are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = tables.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
