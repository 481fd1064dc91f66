"""Quality rules: word statistics, and a log-likelihood ratio of hashed n-grams.

Words, pairs of words and the last three letters of words are hashed into ``BUCKETS`` buckets. Two
multinomials are counted over them: one of all documents, one of the trusted ones (labelled good).
A document's verdict is the mean over its n-grams of ln(trusted / all), compared with a
threshold; there is no sampling, so the same tables give the same verdicts. Column functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.llm import tables

BUCKETS = 16_384
SMOOTHING = 1.0
THRESHOLD = -0.25
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
ADDED = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept",
]
_TAIL = "\x01"  # keeps a word's end apart from a word


def _bucket(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")


def word_rows(docs: DataFrame) -> DataFrame:
    """The rows with their words and the words' 64-bit hashes."""
    rows = docs.withColumn("_words", tables.words(F.col("text").cast("string")))
    return rows.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))


def _grams(at: Column, use) -> tuple[Column, Column, Column]:
    """``use`` of the buckets of the n-grams that end at a word: the word, its last three letters,
    and the pair with the word before it, which is null at the first."""
    own, before = F.get("_hashes", at), F.get("_hashes", at - 1)
    tail = F.xxhash64(F.lit(_TAIL), F.right(F.get("_words", at), F.lit(3)))
    return (
        use(F.pmod(own, F.lit(BUCKETS)).cast("int")),
        use(F.pmod(tail, F.lit(BUCKETS)).cast("int")),
        F.when(at > 0, use(_bucket(before, own))),
    )


def bucket_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per bucket the n-grams of all documents and of the trusted ones: at most ``BUCKETS`` rows."""
    trusted = (
        labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("long").alias("doc_id"))
        .distinct()
        .withColumn("_trusted", F.lit(1))
    )
    marked = docs.select(F.col("doc_id").cast("long"), "text").join(
        trusted.hint("shuffle_hash"), "doc_id", "left"
    )
    placed = word_rows(marked).select("_trusted", "_words", "_hashes", F.posexplode("_hashes"))
    buckets = F.array(*_grams(F.col("pos"), lambda bucket: bucket))
    grams = placed.select("_trusted", F.explode(buckets).alias("bucket"))
    return (
        grams.filter(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(F.count("*").alias("n_all"), F.count("_trusted").alias("n_trusted"))
    )


def log_ratios(counts: DataFrame) -> list[float]:
    """ln(trusted / all) by bucket, smoothed; all zero where nothing is trusted."""
    found = {r.bucket: (r.n_all, r.n_trusted) for r in counts.collect()}
    everything = sum(a for a, _ in found.values())
    trusted = sum(t for _, t in found.values())
    if not trusted:
        return [0.0] * BUCKETS
    extra = SMOOTHING * BUCKETS
    out = []
    for b in range(BUCKETS):
        a, t = found.get(b, (0, 0))
        out.append(
            math.log((t + SMOOTHING) / (trusted + extra))
            - math.log((a + SMOOTHING) / (everything + extra))
        )
    return out


def ratio_score(ratios: list[float]) -> Column:
    """Mean log ratio of a text's n-grams; 0 for a text without words."""
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")

    def worth(_, at: Column) -> Column:
        one, tail, pair = _grams(at, lambda bucket: F.get(table, bucket))
        return one + tail + F.coalesce(pair, F.lit(0.0))

    total = F.aggregate(F.transform("_hashes", worth), F.lit(0.0), lambda acc, x: acc + x)
    n = F.size("_hashes")
    return F.when(n > 0, total / (3 * n - 1)).otherwise(F.lit(0.0))


def _windows() -> Column:
    """64-bit hashes of the three-word windows, in order."""
    n = F.size("_hashes")
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        starts,
        lambda i: F.xxhash64(F.get("_hashes", i), F.get("_hashes", i + 1), F.get("_hashes", i + 2)),
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """The rows with their words (``_words``, ``_hashes``) and n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and base_failed."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\\n"), lambda x: F.ltrim(x, F.lit(tables.SPACES)) != "")
    plain = text
    for symbol in SYMBOLS:
        plain = F.replace(plain, F.lit(symbol), F.lit(""))
    rows = (
        word_rows(docs)
        .withColumn("n_words", F.size("_words").cast("long"))
        .withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
        .withColumn(
            "n_symbols",
            (F.length(text) - F.length(plain)).cast("long"),
        )
        .withColumn("_lines", lines)
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .drop("_lines")
    )
    # Sorted with their places, equal windows are neighbours; the places of the repeated ones, sorted
    # again, each cover three words or those up to the next.
    rows = rows.withColumn("_windows", _windows())
    placed = F.sort_array(
        F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    rows = rows.withColumn(
        "_placed",
        F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), placed),
    ).drop("_windows")
    again = F.filter(
        F.transform(
            "_placed",
            lambda p, k: F.when(
                (p["h"] == F.get(F.col("_placed"), k - 1)["h"])
                | (p["h"] == F.get(F.col("_placed"), k + 1)["h"]),
                p["i"],
            ),
        ),
        lambda i: i.isNotNull(),
    )
    rows = rows.withColumn("_again", F.sort_array(again)).drop("_placed")
    covered = F.aggregate(
        F.transform(
            "_again",
            lambda p, k: F.least(
                F.lit(3), F.coalesce(F.get(F.col("_again"), k + 1) - p, F.lit(3))
            ),
        ),
        F.lit(0),
        lambda acc, x: acc + x,
    )
    rows = rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return rows.withColumn("base_failed", failed).drop("_again")


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows with their statistics, ``llr`` and ``kept``.

    A null text has no words and fails the base rules; labels that are null, or of no document, say
    nothing; without trusted documents every ratio is 0 and the base rules decide alone. Repeated
    rows are judged each. Columns of the names this adds are replaced."""
    # Stored, since the count deals out the texts: its shuffle files go as soon as it is done.
    ratios = log_ratios(tables.stage(bucket_counts(docs, labels), "quality-counts"))
    rows = with_statistics(docs).withColumn("llr", ratio_score(ratios))
    kept = ~F.col("base_failed") & (F.col("llr") >= threshold)
    found = F.struct(*[kept.alias("kept") if c == "kept" else F.col(c) for c in ADDED])
    # Made by a generator, the columns are computed once: a filter on them cannot be pushed below,
    # where it would repeat their expressions inside each other.
    return rows.select(*[c for c in docs.columns if c not in ADDED], F.inline(F.array(found)))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = tables.read_table(spark, folder, "documents").select("doc_id", "text")
    return judge(docs, tables.read_table(spark, folder, "labels")).drop("text")


QUERIES = {"op5_quality": op5_quality}
ORACLES: dict[str, str] = {}
