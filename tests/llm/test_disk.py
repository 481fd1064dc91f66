"""What steps leave on disk."""

import os
import random

import corpus_pipeline
from forgemeter.llm import collocations, jaccard, quality, tables


def recorded(monkeypatch):
    """Steps by purpose, as they are stored."""
    found, stage = [], tables.stage

    def keep(df, purpose):
        step = stage(df, purpose)
        found.append((purpose, step.staged_at.removeprefix("file:")))
        return step

    monkeypatch.setattr(tables, "stage", keep)
    return found


def size(path):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, names in os.walk(path) for f in names)


def random_texts(n, words):
    rng = random.Random(5)
    return [" ".join(f"{rng.getrandbits(60):x}" for _ in range(words)) for _ in range(n)]


def test_near_copies_are_found_with_one_copy_of_the_texts(spark, monkeypatch):
    texts = random_texts(300, 200)
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, t + " end") for i, t in enumerate(texts[:50])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    steps = recorded(monkeypatch)
    kept = corpus_pipeline.drop_near_copies(spark, frame, "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(300))
    stored = sum(size(path) for purpose, path in steps if purpose == "pipeline-rows")
    assert stored < 1.3 * size(tables.stage(frame, "once").staged_at.removeprefix("file:"))


def test_sets_are_deleted_once_the_links_are_stored(spark, monkeypatch):
    texts = random_texts(40, 100)
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t + " end") for i, t in enumerate(texts)]
    steps = recorded(monkeypatch)
    found = jaccard.near_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    left = {purpose for purpose, path in steps if os.path.exists(path)}
    assert not left & {
        "jaccard-sets", "jaccard-survivors", "jaccard-whole", "jaccard-ordered", "jaccard-star",
        "jaccard-families", "jaccard-blocks",
    }
    assert {r.component_id for r in found.collect()} == set(range(40))


def test_counts_of_the_quality_model_are_stored(spark, monkeypatch):
    steps = recorded(monkeypatch)
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    quality.judge(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert [purpose for purpose, _ in steps] == ["quality-counts"]


def test_phrases_are_dealt_once_and_blocks_deleted(spark, monkeypatch):
    """However many phrases are frequent, no length is numbered, joined to the blocks and stored anew."""
    steps = recorded(monkeypatch)
    rows = [("en", "a b c d e f g " * 30)] * 4
    found = collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), least=100, most=50)
    stored = [purpose for purpose, _ in steps]
    left = {purpose for purpose, path in steps if os.path.exists(path)}
    assert stored.count("phrases-stretches") == 1 and stored.count("phrases-ranked") == 1
    assert not left & {"phrases-blocks", "phrases-stretches"}
    assert {r.phrase for r in found.collect()} >= {"a b c d e", "g a b c d"}


def test_blocks_and_stretches_are_stored_packed(spark, monkeypatch):
    """A word took four bytes in a block and in a stretch."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    rows = [("en", " ".join(rng.choice(words) for _ in range(2_000)) + ".") for _ in range(20)]
    steps = recorded(monkeypatch)
    monkeypatch.setattr(tables, "release", lambda step: None)
    collocations.collocations(spark.createDataFrame(rows, "lang string, text string")).collect()
    for purpose, column in (("phrases-blocks", "codes"), ("phrases-stretches", "words")):
        (path,) = [path for found, path in steps if found == purpose]
        parts = [r[0] for r in spark.read.parquet(path).select(column).collect() if r[0]]
        assert 0 < sum(map(len, parts)) < 2 * 40_000
