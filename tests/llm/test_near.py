"""Near-duplicate operators against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from forgemeter.llm import jaccard, lattice, substrings
from forgemeter.llm.components import components
from forgemeter.llm.tables import WORD


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)]
    pairs += [(100 + i, 101 + i) for i in range(30)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    want = roots({x for p in pairs for x in p}, pairs)
    assert got == {n: want[n] for n in got}
    assert set(got) == {x for a, b in pairs if a != b for x in (a, b)}
    assert components(frame.filter("false")).isEmpty()


def edited(rng, words, share):
    return [rng.choice(["alpha", "beta", "gamma"]) if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    base = [rng.choice(vocabulary) for _ in range(90)]
    out = {}
    for i in range(90):  # one large family of near copies, some too far from each other
        out[i] = " ".join(edited(rng, base, rng.choice([0, 0.01, 0.03, 0.06])))
    for i in range(90, 150):  # a passage that many otherwise different documents share
        own = [rng.choice(vocabulary) for _ in range(rng.randint(20, 120))]
        out[i] = " ".join(own[:10] + passage + own[10:])
    for i in range(150, 180):
        out[i] = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 9)))
    for i in range(180, 190):
        out[i] = out[rng.randint(0, 179)].upper().replace(" ", "\n ")
    return out


def brute_jaccard(rows):
    sets = {}
    for i, t in rows.items():
        w = WORD.findall((t or "").lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(sets)
    pairs = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    found = roots(ids, pairs)
    return {i: (len(sets[i]), found[i]) for i in ids}


@pytest.mark.parametrize("large", [8, 64])
def test_jaccard_equals_brute_force(spark, texts, monkeypatch, large):
    monkeypatch.setattr(jaccard, "LARGE", large)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_documents(frame).collect()}
    assert got == brute_jaccard(texts)


def test_jaccard_of_odd_documents(odd_documents, no_documents):
    rows = jaccard.near_documents(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    assert by[None] == {(1, None)} and by[0] == by[0] and by[0] == {(0, 0)} and by[2] == {(0, 2)}
    assert {c for _, c in by[20]} == {5} and {c for _, c in by[23]} == {5}
    assert {c for _, c in by[22]} == {21} and by[25] == {(1, 24)}
    assert jaccard.near_documents(no_documents).isEmpty()


def test_jaccard_of_a_set_that_a_row_without_doc_id_has_too(spark):
    words = [f"w{i}" for i in range(90)]
    text, near = " ".join(words), " ".join([*words[:40], "other", *words[41:]])
    rows = [(None, text), (24, text), (25, near), (None, near), (26, "far from both of these")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = jaccard.near_documents(frame).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None}
    assert got == brute_jaccard({i: t for i, t in rows if i is not None})
    assert got[25][1] == 24 and {r.component_id for r in found if r.doc_id is None} == {None}
    kept = corpus_pipeline.drop_near_copies(spark, frame, "").collect()
    assert sorted(r.doc_id or -1 for r in kept) == [-1, -1, 24, 26]


def brute_repeats(rows, target):
    seen, out = set(), {}
    for i in sorted(rows):
        w = WORD.findall(rows[i] or "")
        gone = [False] * len(w)
        for s in range(len(w) - target + 1):
            key = tuple(w[s : s + target])
            if key in seen:
                gone[s : s + target] = [True] * target
            seen.add(key)
        kept = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


@pytest.mark.parametrize(("target", "chunk"), [(20, 1_000_000), (20, 100), (7, 100)])
def test_repeats_equal_brute_force(spark, texts, monkeypatch, target, chunk):
    monkeypatch.setattr(substrings, "CHUNK_WORDS", chunk)
    loop = {500: "a b c d e f g " * 40, 501: "x " + "a b c d e f g " * 9}
    rows = texts | loop
    frame = spark.createDataFrame(list(rows.items()), "doc_id long, text string").repartition(5)
    found = substrings.remove_repeats(frame, first=3, target=target).collect()
    got = {
        r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in found
    }
    assert got == brute_repeats(rows, target)


def test_repeats_of_odd_documents(odd_documents, no_documents):
    found = substrings.remove_repeats(odd_documents).collect()
    assert len(found) == odd_documents.count()
    by = {r.doc_id: r for r in found}
    assert by[0].n_words == 0 and by[5].n_removed == 0 and by[20].n_removed == by[20].n_words
    assert by[21].n_removed == 30_000 - 977 and by[22].kept_text.endswith("end")
    assert substrings.remove_repeats(no_documents).isEmpty()


def test_repeats_of_texts_with_one_32_bit_hash(spark):
    passage = " ".join(f"p{i}" for i in range(25))
    texts = spark.range(400_000).select(F.concat(F.lit("own"), "id", F.lit(" " + passage)).alias("text"))
    clash = texts.groupBy(F.hash("text")).agg(F.collect_list("text").alias("t")).filter("size(t) > 1").first().t
    frame = spark.createDataFrame([(None, t) for t in clash[:2]], "doc_id long, text string").coalesce(1)
    found = substrings.remove_repeats(frame).collect()
    assert sorted((r.n_removed, len(r.kept_text.split())) for r in found) == [(0, 26), (25, 1)]


def test_lattice_points_are_nearest():
    x = np.random.default_rng(1).standard_normal((300, 8)) * 2
    points = lattice.decode(x)
    around = ((x[:, None] - (points[:, None] + lattice.NEIGHBOURS)) ** 2).sum(axis=2).min(axis=1)
    assert (((x - points) ** 2).sum(axis=1) <= around + 1e-9).all()
    doubled = np.rint(2 * points).astype(int)
    assert ((doubled % 2 == doubled[:, :1] % 2).all(axis=1) & (points.sum(axis=1) % 2 == 0)).all()


@pytest.mark.parametrize("block", [16, 512])
def test_embeddings_equal_brute_force(spark, block):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((40, 24))
    vectors = np.vstack([base, base[:10] * 3, base[:1] + 0.04 * rng.standard_normal((80, 24)),
                         base[1:2] + 0.2 * rng.standard_normal((60, 24))])
    rows = [(i, v.tolist(), int(i % 2)) for i, v in enumerate(vectors)]
    odd = [(900, None, 1), (901, [0.0] * 24, 1), (902, [float("nan")] * 24, 1), (903, rows[0][1], None),
           (904, [1.0, None], 0), (905, [], 0), (906, rows[0][1][:5], 0)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    label = np.arange(len(vectors)) % 2
    linked = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(linked, False)
    want = roots(range(len(vectors)), [(int(a), int(b)) for a, b in zip(*np.nonzero(linked))])
    got = {r.vec_id: r for r in lattice.near_embeddings(frame, block=block).collect()}
    assert len(got) == len(rows) + len(odd)
    assert [got[i].n_links for i in range(len(vectors))] == linked.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(len(vectors))] == [want[i] for i in range(len(vectors))]
    assert all(got[i].kept == (got[i].component_id == i) for i in got)
    assert all(got[i].n_links == 0 and got[i].component_id == i for i, *_ in odd)
    assert lattice.near_embeddings(frame.filter("false")).isEmpty()
