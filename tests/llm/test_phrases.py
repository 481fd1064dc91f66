"""Collocations and licence notices against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from forgemeter.llm import collocations as phrases
from forgemeter.llm import licenses

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_phrases(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, 6) for i in range(len(words) - k + 1))
    out = {}
    frequent = {key: a for key, a in f.items() if a >= least}
    for (lang, words), a in frequent.items():
        if len(words) < 2:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, words[:c]] * f[lang, words[c:]]), c) for c in range(1, len(words))]
        score, c = min(cuts)
        inside = any(
            other == lang and len(longer) > len(words) and b >= a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), b in frequent.items()
        )
        if not inside:
            row = (" ".join(words), a, f[lang, words[:c]], f[lang, words[c:]], n[lang], score)
            out.setdefault(lang, []).append(row)
    found = set()
    for lang, rows in out.items():
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        found |= {(lang, i + 1, *row) for i, row in enumerate(rows[:top])}
    return found


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(25)] + ["Émile", "x\x00y", "日本"]
    rows = []
    for i in range(120):
        text = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            text[5:5] = ["New", "YORK", "city", "hall", "steps", "down"][: rng.randint(2, 6)]
        rows.append((rng.choice(["en", "de", None, "und"]), "".join(w + rng.choice("  \t.,\n") for w in text)))
    rows += [("en", None), ("en", ""), ("fr", "a a a a a a"), rows[0], rows[0], ("en", "no stop " * 3000)]
    frame = spark.createDataFrame(rows, "lang string, text string").withColumn("n", F.lit(1))
    return rows, frame.withColumn("code", F.lit("clash")).repartition(3)


@pytest.mark.parametrize(("most", "piece"), [(1 << 20, 1 << 16), (300, 40)])
def test_collocations_equal_brute_force(mixed, most, piece):
    rows, frame = mixed
    got = {tuple(r) for r in phrases.collocations(frame, least=4, top=60, most=most, piece=piece).collect()}
    assert got == brute_phrases(rows, 4, 60) and len(got) > 60


@pytest.mark.parametrize("group", [7, 200])
def test_collocations_of_many_groups_equal_brute_force(mixed, group):
    rows, frame = mixed
    got = {tuple(r) for r in phrases.collocations(frame, least=4, top=60, most=300, piece=40, group=group).collect()}
    assert got == brute_phrases(rows, 4, 60)


def test_runs_come_back_as_they_were_dealt():
    words = np.array([5, 1 << 30, 0, 7, 9, 2, -1, 3, 4, -1, 1, 1, 1, -1], np.int32)
    runs = phrases._runs(words, 5)
    assert runs.T.tolist() == [
        [5, 1 << 30, 0, 7, 9], [1 << 30, 0, 7, 9, 2], [0, 7, 9, 2, -1], [7, 9, 2, -1, -1], [1, 1, 1, -1, -1]
    ]
    halves = [phrases._packed(runs[:, :2]), phrases._packed(runs[:, 2:])]
    assert (phrases._unpacked(halves, 5) == runs).all()


def test_blocks_of_a_language_are_dealt_together(spark, monkeypatch):
    """Between those of another language, however small: a row for each language, width and group."""
    rng = np.random.default_rng(8)
    texts = rng.integers(-1, 6, (40, 50)).astype(np.int32)
    rows = [("de" if i % 3 else "en", 1, phrases._packed_words(text)) for i, text in enumerate(texts)]
    frame = spark.createDataFrame(rows, "lang string, buckets long, words binary").coalesce(1)
    want = Counter()
    for i, text in enumerate(texts):
        for piece in " ".join(map(str, text)).split("-1"):
            ids = piece.split()
            want.update(
                ("de" if i % 3 else "en", *map(int, ids[j : j + k])) for k in range(2, 6) for j in range(len(ids) - k + 1)
            )
    counts = {}
    for part, parts in ((1 << 20, 16), (120, 16), (500, 1)):
        monkeypatch.setattr(phrases, "PART", part)
        monkeypatch.setattr(phrases, "PARTS", parts)
        dealt = phrases.deal(frame, 5)
        counts[part] = dealt.count()
        assert {(r.lang, *r.ids): r.a for r in phrases.count_dealt(dealt, 1).collect()} == want
    assert counts[1 << 20] == 4 and counts[120] > 8 and counts[500] > 4


@pytest.mark.parametrize("steps", [True, False])
def test_any_32_bit_numbers_come_back_as_they_were_packed(steps):
    rng = np.random.default_rng(4)
    columns = rng.integers(-(1 << 31), 1 << 31, (3, 400)).astype(np.int32)
    columns[0, :4] = (1 << 31) - 1, -(1 << 31), -1, 0
    parts = [phrases._packed(x, steps) for x in (columns[:, :0], columns[:, :1], columns[:, 1:][:, ::-1], columns)]
    got = phrases._unpacked(parts, 3, steps)
    assert (got == np.concatenate([columns[:, :1], columns[:, 1:][:, ::-1], columns], axis=1)).all()


@pytest.mark.parametrize("places", [50, 1 << 20])
def test_a_block_is_sent_its_dictionary_packed(spark, monkeypatch, places):
    monkeypatch.setattr(phrases, "PLACES", places)
    rng = random.Random(6)
    rows = [(i, rng.choice([3, 1 << 40]), rng.randrange(1 << 31)) for i in range(500)]
    frame = spark.createDataFrame(rows, "id long, of long, code int").repartition(2)
    sent = phrases.by_block(frame).collect()
    back = [(i, r.of, code) for r in sent for code, i in phrases._unpacked([r.known], 2).T.tolist()]
    assert sorted(back) == sorted(rows) and (places == 50 or len(sent) == 4)
    assert phrases.by_block(frame.filter("false")).isEmpty()


def test_collocations_of_no_documents(mixed):
    assert phrases.collocations(mixed[1].filter("false")).isEmpty()


@pytest.mark.parametrize("cells", [1, 10**9])
def test_tiles_count_as_a_counter_does(monkeypatch, cells):
    monkeypatch.setattr(phrases, "CELLS_A_PAIR", cells)
    rng = np.random.default_rng(2)
    left, right = rng.integers(0, 3000, 20_000) ** 2 // 3000, rng.integers(0, 600, 20_000)
    left[:5] = 1 << 31
    pair, n = phrases.tile_counts(left, right)
    assert dict(zip(pair.tolist(), n.tolist())) == Counter(((a << 31) | b for a, b in zip(left.tolist(), right.tolist())))


@pytest.mark.parametrize("cells", [1, 10**9])
def test_tiles_count_with_weights(monkeypatch, cells):
    monkeypatch.setattr(phrases, "CELLS_A_PAIR", cells)
    rng = np.random.default_rng(3)
    left, right, times = rng.integers(0, 900, 5_000), rng.integers(0, 900, 5_000), rng.integers(1, 9, 5_000)
    pair, n = phrases.tile_counts(left, right, times)
    want = Counter()
    for a, b, t in zip(left.tolist(), right.tolist(), times.tolist()):
        want[(a << 31) | b] += t
    assert dict(zip(pair.tolist(), n.tolist())) == want and n.dtype == np.int64


def test_words_of_a_long_text_are_those_of_its_parts(monkeypatch):
    text = "Ab, c\td.E\nf  g" * 50
    whole = [w for part in phrases.word_lists(text) for w in part]
    monkeypatch.setattr(phrases, "CHUNK", 7)
    assert [w for part in phrases.word_lists(text) for w in part] == whole


def test_licenses_of_odd_documents(spark, odd_documents, no_documents):
    found = licenses.scan(odd_documents).collect()
    assert len(found) == odd_documents.count()
    assert all((r.n_base, r.first_word, r.base_labels, r.labels, r.score) == (0, None, "", "", 0) for r in found)
    by = {r.doc_id: r for r in found}
    assert by[0].n_words == by[1].n_words == by[2].n_words == 0 and by[21].n_words == 30_000
    assert licenses.scan(no_documents).isEmpty()


BODY = licenses.TEMPLATES[1][1]


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        (BODY, "mit"),
        (BODY.upper().replace(" ", "\n* "), "mit"),
        (BODY.replace("free of charge", "at no charge whatsoever").replace("merge, ", ""), "mit"),
        ("x " * 400 + BODY + " y" * 400, "mit"),
        (" ".join(BODY.split()[:30]), ""),
        ("licensed under cc by-nc 4.0. " * 3 + "MIT License", "cc-by,cc-by-nc-4.0,mit"),
        ("mit licenses and apache, license. mit-license", "apache,mit"),
        ("the rights to use of this software is a long story that nobody here has told", ""),
    ],
)
def test_licenses_are_found(spark, text, labels):
    rows = [(1, text), (1, text), (None, text), (2, "nothing here")]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id or 0), r.labels) for r in found) == sorted([(0, labels), (1, labels), (1, labels), (2, "")])


def test_license_places_equal_brute_force(spark):
    rng = random.Random(3)
    words = ["gnu", "general", "public", "license", "apache", "cc", "by", "mit", "and", "ÉCC"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(80))) for i in range(60)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in found:
        w = rows[r.doc_id][1].split()
        at = [(i, label) for i in range(len(w)) for p, label in licenses.PHRASES if w[i : i + len(p.split())] == p.split()]
        want = (len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at})))
        assert (r.n_base, r.first_word, r.last_word, r.base_labels) == want
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and r.score == bool(at) or not at


def test_a_span_over_two_diagonals_is_one(spark):
    words = BODY.split()
    text = " ".join([*words[:40], "added", *words[40:70], *words[72:]])
    found = licenses.scan(spark.createDataFrame([(1, "pre " * 9 + text)], "doc_id long, text string")).first()
    assert [s.label for s in found.spans] == ["mit"] and found.spans[0]["first"] == 9 and 0.9 < found.score < 1
