"""Quality rules, HTML text, toxicity, N-best segmentation and the pipeline."""

import itertools
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from forgemeter.llm import htmltext, nbest, packing, quality, tokens, toxicity
from forgemeter.llm.tables import WORD
from tests.llm.test_near import brute_jaccard, brute_repeats  # noqa: F401


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def of_text(w, seed=42):
    return xxhash.xxh64_intdigest(w.encode(), seed=seed)


def grams(words):
    hashes, out = [of_text(w) for w in words], []
    for i, w in enumerate(words):
        out.append(signed(hashes[i]) % quality.BUCKETS)
        out.append(signed(of_text(w[-3:], seed=of_text("\x01"))) % quality.BUCKETS)
        if i:
            before = xxhash.xxh64_intdigest(struct.pack("<Q", hashes[i - 1]), seed=42)
            pair = xxhash.xxh64_intdigest(struct.pack("<Q", hashes[i]), seed=before)
            out.append(signed(pair) % quality.BUCKETS)
    return out


def brute_quality(rows, good, threshold=quality.THRESHOLD):
    everything, trusted, own = Counter(), Counter(), []
    for doc_id, text in rows:
        own.append(grams(WORD.findall(text or "")))
        everything.update(own[-1])
        if doc_id in good:
            trusted.update(own[-1])
    n_all, n_good, b = sum(everything.values()), sum(trusted.values()), quality.BUCKETS

    def ratio(g):
        return math.log((trusted[g] + 1) / (n_good + b)) - math.log((everything[g] + 1) / (n_all + b))

    out = []
    for (doc_id, text), found in zip(rows, own):
        words = WORD.findall(text or "")
        windows = Counter(zip(words, words[1:], words[2:]))
        covered = {
            j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1
            for j in range(k, k + 3)
        }
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        llr = sum(map(ratio, found)) / max(1, len(found)) if n_good else 0
        out.append(
            (doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
             len(lines) - len(set(lines)), len(covered), failed, not failed and llr >= threshold)
        )
    return out


def test_quality_equals_brute_force(spark, odd_documents, no_documents):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(200)]
    more = [(100 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(40, 90)))) for i in range(30)]
    more += [(200 + i, " ".join(rng.choice(vocabulary) + "%%%" for _ in range(80))) for i in range(10)]
    more += [(300, "a b c d\n\n a b c d\na b c d\n" * 20), (301, "x " * 100)]
    docs = odd_documents.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string"))
    labels = [(100 + i, 1) for i in range(30)] + [(200 + i, 0) for i in range(10)] + [(None, 1), (7, None)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    columns = ["doc_id", *[c for c in quality.ADDED if c != "llr"]]
    got = sorted(map(tuple, quality.judge(docs, frame).select(*columns).collect()), key=repr)
    assert got == sorted(brute_quality(rows, {d for d, q in labels if q == 1}), key=repr)
    assert not any(kept for d, *_, kept in got if d and 200 <= d < 210)
    assert quality.judge(no_documents, frame).isEmpty()
    assert quality.judge(odd_documents, frame.filter("false")).count() == odd_documents.count()


PAGE = """<html><body class="x"><header><h1>Site</h1></header><nav>menu</nav><div id=main>
<div class="post-{n} entry"><h1>T&eacute;st {n}</h1><p>One <b>tw</b>o<br>three &lt;x&gt; a < b
<script>var a="</p>";</script></p><ul><li>i<li>j</ul><p>{text}</p><form><p>no</p></form>
<div class="comments"><p>bad comment</p></div></div></div>
<div class="side-bar sidebar">{text}{text}</div><footer>f"""


def test_html(spark):
    filler = "Some running text, long enough to win. " * 5
    pages = [(i, f"https://a.example/{i}", PAGE.format(n=i, text=filler)) for i in range(6)]
    short = '<html><body class="x"><div id=main><div class="post-9 entry"><p>tiny</p></div></div>' + (
        '<div class="promo2"><p>' + filler + "</p></div>"
    )
    odd = [(10, None, None), (11, "", ""), (12, "x", "plain &amp; simple"), (13, "http://b.example", short),
           (14, "https://A.example:80/9", short), (None, "u", "<p>x"), (15, "u", "<div " * 2000)]
    frame = spark.createDataFrame(pages + odd, "page_id long, url string, html string")
    frame = frame.withColumn("host", F.lit("clash")).withColumn("text", F.lit(1))
    got = {r.page_id: r for r in htmltext.extract(frame).collect()}
    body = " ".join(filler.split())
    assert got[3].text == f"Tést 3 One two three <x> a < b i j {body}"
    assert got[10].text == got[11].text == "" and got[12].text == "plain & simple" and got[None].text == "x"
    assert got[13].text == body  # no consensus on that host
    assert got[14].text == "tiny" and got[14].host == "a.example"  # the host's path wins
    assert htmltext.extract(frame.filter("false")).isEmpty()


def said(mark, size):
    """So many characters of running text that begin with a mark."""
    return (mark + " " + "some running text " * size)[: size - 1] + "."


def own_text(page):
    found = htmltext.blocks(page)
    return htmltext.text_of(found, [])


SPREAD = {
    "lead": "<div class=post><div class=lead>{0:200}</div><div class=body>{1:1000}</div></div>",
    "table": "<div class=post><p>{0:500}</p><table><tr><td>{1:600}</td><td>{2:600}</td></tr></table></div>",
    "quote": "<div class=post><p>{0:300}</p><blockquote>{1:1000}</blockquote></div>",
    "heading": "<article><h1>{0:60}</h1><div class=wrap><div class=text>{1:1000}</div></div></article>",
    "short heading": "<div class=post><h1>{0:12}</h1><div class=wrap><div class=text>{1:3000}</div></div></div>",
    "sections": "<article>{0:200}<section><div>{1:900}</div></section><section><div>{2:400}</div></section></article>",
    "deep": "<div class=a><div class=b><p>{0:300}</p><div class=c><p>{1:300}</p><div>{2:900}</div></div></div></div>",
}


class Said:
    def __init__(self, mark):
        self.mark = mark

    def __format__(self, size):
        return said(self.mark, int(size))


@pytest.mark.parametrize("name", SPREAD)
def test_html_spread_over_containers_is_whole(name):
    marks = ["one", "two", "three"]
    nav = '<nav><a href="/">nav</a></nav><div class="links"><a href="/x">more about it</a></div>'
    page = "<html><body>" + nav + SPREAD[name].format(*map(Said, marks)) + "<footer>foot</footer>"
    if "{2:" not in SPREAD[name]:
        marks = marks[:2]
    assert [m for m in marks if m in own_text(page)] == marks
    assert not any(x in own_text(page) for x in ("nav", "more about", "foot"))


def test_html_of_links_only_is_whole():
    assert own_text("<body><a href=x>a</a><div><a href=y>b</a></div><div><p><a href=z>c</a></div>") == "a b c"


def test_html_of_a_host_whose_pages_differ(spark):
    """Pages without a lead vote for the inner container; those with one lose nothing by it."""
    body = "<html><body><div class=post>{}<div class=body><p>{}</p></div></div>{}"
    rows = [(i, body.format("", said("own", 900), "")) for i in range(9)]
    rows += [(9, body.format(f"<div class=lead>{said('lead', 200)}</div>", said("own", 900), ""))]
    rows += [(10, body.format("", said("own", 900), f"<div class=odd>{said('odd', 600)}</div>"))]
    frame = spark.createDataFrame(rows, "page_id long, html string").withColumn("url", F.lit("http://h.example/"))
    got = {r.page_id: r.text for r in htmltext.extract(frame).collect()}
    assert got[9] == said("lead", 200) + " " + said("own", 900)
    assert all(text == said("own", 900) for i, text in got.items() if i != 9)


@pytest.mark.parametrize(
    "names",
    ["content has-sidebar", "post no-comments", "entry share-enabled", "related-work", "md:hidden",
     "content-sidebar", "sidebar", "layout sidebar-left", "widget"],
)
def test_html_keeps_an_article_whatever_its_wrapper_is_named(names):
    article = f"<p>{said('one', 400)}</p><p>{said('two', 300)}</p>"
    page = f'<body><p>Top</p><div class="{names}">{article}<div class="comments">bad</div></div>'
    got = own_text(page)
    assert "one" in got and "two" in got and "bad" not in got


@pytest.mark.parametrize(
    "names",
    ["sidebar", "site-footer", "sidebar-left", "related-posts", "share-buttons", "ad-300x250", "sideBar",
     "post-comments", "x comment-list", "cookie-consent-banner"],
)
def test_html_drops_elements_named_as_boilerplate(names):
    page = f'<body><div class="post"><p>{said("one", 400)}</p><div class="{names}">{said("bad", 300)}</div></div>'
    assert own_text(page) == said("one", 400)


def test_html_of_many_hosts_is_joined_by_salt(spark, monkeypatch):
    rows = [(i, f"https://h{i % 3}.example/", f"<main><p>text {i}</p></main>") for i in range(30)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(htmltext, "BROADCAST_HOSTS", 0)
    assert {r.page_id: r.text for r in htmltext.extract(frame).collect()} == {i: f"text {i}" for i in range(30)}


@pytest.fixture(scope="module")
def biased(spark):
    """Toxic texts name one group more often than others do."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(900):
        toxic = int(rng.random() < 0.3)
        text = [rng.choice(words) for _ in range(30)]
        if toxic:
            text[3:3] = rng.sample(["idiot", "scum", "moron", "trash"], 2)
        if rng.random() < (0.7 if toxic else 0.1):
            text.insert(10, "muslims")
        docs.append((i, " ".join(text)))
        labels.append((i, toxic))
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_toxicity_is_held_out_and_counterfactual(spark, biased):
    docs, labels = biased
    model = toxicity.fit(docs, labels, min_z=3.0)
    plain = toxicity.fit(docs, labels, min_z=3.0, swap_penalty=0.0)
    rows = toxicity.score(docs, model).join(labels, "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    right = sum((r.score >= toxicity.THRESHOLD) == bool(r.toxic) for r in held)
    assert right / len(held) > 0.97
    named = ("muslims", "^musli")  # the weight, in logits, of naming the group
    assert sum(plain.weights.get(f, 0) for f in named) > 1
    assert abs(sum(model.weights.get(f, 0) for f in named)) < 0.1
    assert model.score("w1 idiot scum muslims") > toxicity.THRESHOLD
    assert model.swap_pairs > 100  # one a swapped sentence, however few rows they are told in
    table = [(1, "Muslims"), (1, "christians"), (1, "muslims"), (None, "x"), (2, None)]
    groups = toxicity.read_groups(spark.createDataFrame(table, "group_id long, term string"))
    assert groups == (("christians", "muslims"),)
    other = toxicity.fit(docs, labels, min_z=3.0, groups=groups)
    assert 0 < other.swap_pairs < model.swap_pairs


def test_scores_equal_sums_one_by_one(spark, biased, odd_documents):
    """Each text by a plain loop over the weights, and repeated documents fit as one."""
    docs, labels = biased
    model = toxicity.fit(docs, labels, min_z=3.0)
    assert toxicity.fit(docs.unionAll(docs), labels, min_z=3.0) == model
    texts = odd_documents.select("doc_id", "text").unionAll(docs.select("doc_id", "text"))
    for r in toxicity.score(texts, model).collect():
        text = r.text or ""
        found = set(re.findall(r"[^\W\d_]+", text.lower()))
        logit = model.bias + model.length * (math.log(1 + len(text)) - model.mean)
        for name, weight in model.weights.items():
            if name in found or any("^" + w[:5] == name and len(w) > 5 for w in found):
                logit += weight
        assert abs(r.score - 1 / (1 + math.exp(-max(-30, min(30, logit))))) < 1e-9


def test_toxicity_of_odd_documents(spark, biased, odd_documents, no_documents):
    docs, labels = biased
    none = labels.filter("false")
    model = toxicity.fit(docs, none)
    scores = [r.score for r in toxicity.score(odd_documents.drop("score"), model).collect()]
    assert len(scores) == odd_documents.count() and all(0 <= s <= 1 for s in scores)
    odd = labels.unionAll(spark.createDataFrame([(None, 1), (3, None), (99999, 1)], labels.schema))
    assert toxicity.fit(docs, odd, min_z=3.0).weights.keys() >= {"idiot", "scum"}
    assert toxicity.score(no_documents, model).isEmpty()


def brute_paths(lattice, text):
    arcs = lattice.arcs(lattice.normal(text))[0]

    def paths(stop):
        if not stop:
            yield 0.0
        for _, start, _, score in arcs[stop] if stop else []:
            for before in paths(start):
                yield before + score

    arcs = [list(x) for x in arcs]
    return sorted(paths(len(arcs) - 1), reverse=True)


def test_n_best_equals_enumeration():
    lattice = nbest.Lattice(tokens.tokenizer_path(nbest.MODEL), n_best=5, keep_units=20)
    rng = random.Random(1)
    parts = ["a", "th", "e", " ", "\n", "the", "日", "ing", "  ", ",", "x;", "é"]
    for _ in range(150):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 5)))
        (score, best, deviations), = lattice.encode([text])
        want = brute_paths(lattice, text)[:5]
        assert [round(score - loss, 2) for loss, _ in best] == [round(x, 2) for x in want]
        assert len({ids for _, ids in best}) == len(best)
        assert all(lattice.decode(ids) == text for _, ids in best)
        assert all(map(lattice.same_text, deviations))


def test_segmentations_and_decoding(odd_documents, no_documents):
    path = tokens.tokenizer_path(nbest.MODEL)
    rows = nbest.summaries(odd_documents, path).collect()
    assert len(rows) == odd_documents.count() and all(r.round_trip for r in rows)
    assert {(r.n_pieces, r.n_found) for r in rows if r.doc_id in (0, 1)} == {(0, 1)}
    found = nbest.segmentations(odd_documents, path, n_best=3)
    texts = found.withColumn("decoded", nbest.decoded(F.col("ids"), path)).collect()
    want = {(r.doc_id, r.text or "") for r in odd_documents.collect()}
    assert {(r.doc_id, r.decoded) for r in texts} == want
    assert nbest.summaries(no_documents, path).isEmpty()


def test_pipeline_equals_brute_force(spark, biased, folder):
    toxic_docs, labels = biased
    rng = random.Random(9)
    rows = [(i, t) for i, t in ((r.doc_id, r.text) for r in toxic_docs.collect()) if i < 200]
    base = [f"v{i}" for i in range(80)]
    passage = " ".join(f"p{i}" for i in range(30))
    for i in range(1000, 1030):
        rows.append((i, " ".join(w if rng.random() > 0.01 else "z" for w in base)))
    for i in range(1030, 1060):
        own = " ".join(f"u{rng.randint(0, 5000)}" for _ in range(60))
        rows.append((i, f"{own} {passage} end{i}"))
    rows += [(1060, None), (1061, ""), (None, rows[-1][1] + " more"), (1062, rows[-3][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'en' lang", "'s' source", "length(text) n_chars", "1 kept", "2 score", "3 tag"
    )
    more = spark.createDataFrame([(i, 0) for i in range(1000, 1060)], labels.schema)
    marks = labels.unionAll(more).withColumn("quality", F.lit(1)).select("doc_id", "quality", "toxic")
    frame.write.parquet(f"{folder}/documents.parquet")
    marks.write.parquet(f"{folder}/labels.parquet")
    docs, names = frame, frame.columns
    model = toxicity.fit(frame, marks)
    left = [(d, t) for d, t in rows if model.score(t) < toxicity.THRESHOLD]
    verdict = brute_quality(left, {r.doc_id for r in marks.collect()})
    left = [row for row, found in zip(left, verdict) if found[-1]]
    groups = brute_jaccard({d: t for d, t in left if d is not None})
    left = [(d, t) for d, t in left if d is None or groups[d][1] == d]
    cut = brute_repeats({-1 if d is None else d: t for d, t in left}, 20)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == names, name
        want = {d for d, _ in left} if name not in ("toxicity", "quality") else None
        assert want is None or {r.doc_id for r in docs.collect()} == want
    words = {r.doc_id: len(WORD.findall(r.text)) for r in docs.collect()}
    assert words == {None if d == -1 else d: n - gone for d, (n, gone, _) in cut.items()}
    pieces = corpus_pipeline.run(spark, folder)
    total = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert {r.doc_id for r in total.collect()} == set(words) and total.filter("n <> m").isEmpty()
    places = sorted((r.sequence_id, r.offset, r.length) for r in pieces.collect())
    ends = list(itertools.accumulate(n for *_, n in places))
    assert [s * packing.WINDOW + o for s, o, _ in places] == [0, *ends[:-1]]
    assert len(words) > 20 and np.all(np.diff(ends) > 0)
