"""A toxicity classifier that does not lean on who a sentence is about.

Features are the presence of lower-cased words and of five-letter word beginnings, chosen by how
much more or less often toxic documents have them, and the length of the text. A
logistic regression is fitted to them with one more term: in every labelled sentence that names
a group, the name is swapped for the others of its kind, and the squared change of the score's
logit is penalised. What a model could learn from the mere mention of a group is held down.

The fit uses at most ``sample`` labelled documents, chosen by a hash of their id, one text of each, so the
driver holds a bounded number of short rows. Swaps that change the same features are one row with a
count, so their number is bounded by the terms and not by the texts. Scoring reads every whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgemeter.llm import tables

SAMPLE = 24_000
FEATURES = 3_000
MIN_DOCUMENTS = 5
MIN_Z = 6.0
RIDGE = 0.1
SWAP_PENALTY = 20.0
THRESHOLD = 0.7
BEGINNING = 5

# Terms that name groups; those of one line take each other's place.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("black", "white", "asian", "african", "european", "latino", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "citizens", "natives"),
    ("disabled", "blind", "deaf", "elderly", "young"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)

_TOKEN = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[.!?\n]+")


def features(tokens: set[str]) -> set[str]:
    """Words, and the beginnings of longer words marked by ``^``."""
    return tokens | {"^" + w[:BEGINNING] for w in tokens if len(w) > BEGINNING}


def swaps(groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> dict[str, list[str]]:
    return {term: [o for o in group if o != term] for group in groups for term in group}


def read_groups(table: DataFrame) -> tuple[tuple[str, ...], ...]:
    """Groups of terms from a table of ``group_id`` and ``term``, a short list that the driver holds; rows with
    a null are passed over, terms are lower-cased and repeated ones count once."""
    terms = (
        table.dropna(subset=["group_id", "term"])
        .groupBy("group_id")
        .agg(F.sort_array(F.collect_set(F.lower("term"))).alias("terms"))
        .orderBy("group_id")
    )
    return tuple(tuple(r.terms) for r in terms.collect())


@dataclass
class Model:
    """Weights of the chosen features; what is not chosen weighs nothing. ``swap_pairs`` is the number of
    swapped sentences that the fit has seen: where it is 0, the penalty had nothing to act on."""

    bias: float = 0.0
    length: float = 0.0
    mean: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)
    swap_pairs: int = 0

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        """The scores of a batch; the weights a text has are added up in the order of their names."""
        at, weights, sizes = [], [], np.zeros(len(texts))
        for i, text in enumerate(texts):
            words = set(_TOKEN.findall((text or "").lower()))
            hits = sorted(features(words) & self.weights.keys())
            at += [i] * len(hits)
            weights += [self.weights[f] for f in hits]
            sizes[i] = len(text or "")
        total = self.bias + self.length * (np.log1p(sizes) - self.mean)
        total += np.bincount(np.array(at, int), np.array(weights, float), len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))

    def score(self, text: str | None) -> float:
        return float(self.scores([text])[0])


def held_out(doc_id: Column) -> Column:
    """Whether a row's label may not be learned from; a null id has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` labelled documents that are not held out. Of several labels the highest
    counts, of several texts the first in order; null labels, null ids and labels without a document are
    passed over."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    # At most ``sample`` rows of two numbers.
    found = texts.join(F.broadcast(known), "doc_id")
    return found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def chosen_features(rows: DataFrame, keep: int, least: int, min_z: float) -> list[str]:
    """The features whose share of toxic documents is farthest from that of all, at most ``keep``."""

    def present(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                found = sorted(features(set(_TOKEN.findall(text.lower()))))
                yield pd.DataFrame({"feature": found, "toxic": np.int32(toxic)})

    toxic, total = rows.agg(F.sum("toxic"), F.count("*")).first()
    if not toxic or toxic == total:
        return []
    found = rows.select("text", "toxic").mapInPandas(present, "feature string, toxic int")
    counts = found.groupBy("feature").agg(F.sum("toxic").alias("a"), F.count("*").alias("n"))
    # How many toxic documents have it, against as many drawn at random, in standard deviations.
    n, share = F.col("n"), toxic / total
    spread = F.sqrt(n * share * (1 - share) * (1 - n / (total + 1)))
    z = (F.col("a") - n * share) / spread
    top = (
        counts.filter(F.col("n") >= least)
        .select("feature", z.alias("z"))
        .filter(F.abs("z") >= min_z)
        .orderBy(F.abs("z").desc(), "feature")
        .limit(keep)
    )
    return sorted(r.feature for r in top.collect())


def _encoded(rows: DataFrame, names: list[str]) -> pd.DataFrame:
    """Per document its label, length and features by number."""
    number = {f: i for i, f in enumerate(names)}

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [set(_TOKEN.findall(t.lower())) for t in batch["text"]]
            has = [sorted(number[f] for f in features(w) & number.keys()) for w in words]
            yield batch[["doc_id", "toxic"]].assign(length=batch["text"].map(len), has=has)

    schema = "doc_id long, toxic int, length long, has array<int>"
    found = rows.select("doc_id", "text", "toxic").mapInPandas(encode, schema).toPandas()
    return found.sort_values("doc_id", ignore_index=True)


def _swapped(rows: DataFrame, names: list[str], swap: dict[str, list[str]]) -> pd.DataFrame:
    """The features that swaps bring and take, with how many swapped sentences do so."""
    number = {f: i for i, f in enumerate(names)}

    def exchange(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def of(tokens: set[str]) -> set[int]:
            return {number[f] for f in features(tokens) & number.keys()}

        for batch in batches:
            out = []
            for text in batch["text"]:
                for sentence in _SENTENCE.split(text.lower()):
                    named = set(_TOKEN.findall(sentence))
                    for term in sorted(named & swap.keys()):
                        before = of(named)
                        for other in swap[term]:
                            after = of((named - {term}) | {other})
                            if before != after:
                                out.append((sorted(after - before), sorted(before - after)))
            yield pd.DataFrame(out, columns=["gained", "lost"])

    found = rows.select("text").mapInPandas(exchange, "gained array<int>, lost array<int>")
    counts = found.groupBy("gained", "lost").agg(F.count("*").alias("times"))
    return counts.orderBy("gained", "lost").toPandas()


def fit(
    docs: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    keep: int = FEATURES,
    least: int = MIN_DOCUMENTS,
    min_z: float = MIN_Z,
    swap_penalty: float = SWAP_PENALTY,
    groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
) -> Model:
    """The classifier; without labels of both kinds it gives every text the share of toxic ones."""
    rows = tables.stage(training_rows(docs, labels, sample), "toxicity-rows")
    names = chosen_features(rows, keep, least, min_z)
    if not names:
        toxic, total = rows.agg(F.sum("toxic"), F.count("*")).first()
        share = ((toxic or 0) + 0.5) / (total + 1)
        return Model(bias=float(np.log(share / (1 - share))))
    data, swapped = _encoded(rows, names), _swapped(rows, names, swaps(groups))
    logs = np.log1p(data["length"].to_numpy(float))
    mean = float(logs.mean())
    width = len(names) + 2

    def matrix(lists) -> tuple[np.ndarray, np.ndarray]:
        at = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        return at, np.concatenate([np.asarray(x, int) for x in lists] or [[]]).astype(int) + 2

    doc_at, doc_feature = matrix(list(data["has"]))
    gain_at, gain_feature = matrix(list(swapped["gained"]))
    loss_at, loss_feature = matrix(list(swapped["lost"]))
    times = swapped["times"].to_numpy(float)
    y = data["toxic"].to_numpy(float)
    n, m, pairs = len(y), len(times), int(times.sum())

    def apply(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        logit = w[0] + w[1] * (logs - mean) + np.bincount(doc_at, w[doc_feature], n)
        change = np.bincount(gain_at, w[gain_feature], m) - np.bincount(loss_at, w[loss_feature], m)
        return logit, change

    def back(r: np.ndarray, c: np.ndarray) -> np.ndarray:
        out = np.bincount(doc_feature, r[doc_at], width)
        out += np.bincount(gain_feature, c[gain_at], width)
        out -= np.bincount(loss_feature, c[loss_at], width)
        out[0], out[1] = r.sum(), (r * (logs - mean)).sum()
        return out

    ridge = np.full(width, RIDGE)
    ridge[0] = 1e-6
    tie = swap_penalty * n / max(pairs, 1) * times
    w = np.zeros(width)
    for _ in range(12):  # Newton steps, each solved by conjugate gradients
        logit, change = apply(w)
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        gradient = back(p - y, tie * change) + ridge * w
        curve = np.maximum(p * (1 - p), 1e-4)
        step, residual = np.zeros(width), -gradient
        direction, size = residual.copy(), residual @ residual
        for _ in range(60):
            if size < 1e-10:
                break
            a, b = apply(direction)
            product = back(curve * a, tie * b) + ridge * direction
            alpha = size / (direction @ product)
            step += alpha * direction
            residual -= alpha * product
            size, old = residual @ residual, size
            direction = residual + size / old * direction
        w += step
        if np.abs(step).max() < 1e-6:
            break
    weights = {f: float(x) for f, x in zip(names, w[2:])}
    return Model(float(w[0]), float(w[1]), mean, weights, pairs)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The rows with a ``score`` of 0 to 1; a null text scores as an empty one."""

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()))

    return docs.withColumn("score", scored(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def op9_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = tables.read_table(spark, folder, "documents").select("doc_id", "text")
    model = fit(docs, tables.read_table(spark, folder, "labels"))
    return score(docs, model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


QUERIES = {"op9_toxicity": op9_toxicity}
ORACLES: dict[str, str] = {}
