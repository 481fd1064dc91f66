from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forgemeter.functions import cells, labels
from forgemeter.sources import dimensions
from tests.conftest import rows


def compact(n):
    if n >= 1_000_000:
        return f"{n // 1_000_000}.{n % 1_000_000 // 100_000}M"
    if n >= 1_000:
        return f"{n // 1_000}.{n % 1_000 // 100}K"
    return str(n)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 2**62) | st.integers(0, 2_000_000), min_size=50, max_size=200))
def test_compact_number(spark, numbers):
    df = spark.createDataFrame([(n,) for n in numbers], "n BIGINT")
    for n, text in df.select("n", labels.compact_number(F.col("n"))).collect():
        assert text == compact(n)


def test_compact_number_cuts_off(spark):
    df = spark.createDataFrame([(999,), (1999,), (999999,), (1000000,), (-5,)], "n BIGINT")
    got = dict(df.select("n", labels.compact_number(F.col("n"))).collect())
    assert got == {999: "999", 1999: "1.9K", 999999: "999.9K", 1000000: "1.0M", -5: "-5"}


HEADERS = {
    '<https://h/e?page=2>; rel="next", <https://h/e?page=9>; rel="last"': "https://h/e?page=2",
    '<https://h/e?page=1>; rel="prev", <https://h/e?page=3>; rel="next"': "https://h/e?page=3",
    ' <https://h/e?page=4> ;  rel="next" ': "https://h/e?page=4",
    '<https://h/e?page=9>; rel="last"': None,
    'https://h/e; rel="next"': None,
    '<https://h/e>; rel="next"; title="x"': None,
    "": None,
    None: None,
}


def test_next_page_link(spark):
    df = spark.createDataFrame([(h,) for h in HEADERS], "h STRING")
    got = dict(df.select("h", labels.next_page_link(F.col("h"))).collect())
    assert got == HEADERS


def test_labels(spark):
    df = spark.createDataFrame(
        [("1", "functional", 1), ("2", "systems", 2), ("3", "object-oriented", 3),
         ("", "concurrent", 4), (None, None, None)],
        "t STRING, p STRING, r INT",
    )
    got = df.select(
        labels.tier_label(F.col("t")),
        labels.paradigm_class(F.col("p")),
        labels.rank_class(F.col("r")),
    )
    assert [tuple(r) for r in got.collect()] == [
        ("Tier 1", "badge-secondary", "badge-warning"),
        ("Tier 2", "badge-error", "badge-neutral"),
        ("Tier 3", "badge-primary", "badge-accent"),
        ("Tier 3", "badge-accent", "badge-ghost"),
        ("Tier 3", "badge-ghost", "badge-ghost"),
    ]


def test_clock_label(spark):
    df = spark.createDataFrame([(1704067200000,)], "ms BIGINT")
    ms = F.col("ms")
    row = df.select(
        labels.clock_label(ms), labels.clock_label(ms, "UTC"), labels.clock_label(ms, "Asia/Kolkata")
    ).first()
    assert tuple(row) == ("00:00", "00:00", "05:30")


def test_window_key_order(spark):
    df = spark.createDataFrame([(5,), (1704067200000,), (40,)], "ms BIGINT")
    keys = df.select(cells.window_key(F.col("ms")).alias("k"), "ms").orderBy("k").collect()
    assert [r.ms for r in keys] == [5, 40, 1704067200000]
    assert keys[0].k == "0000000000000005" == cells.window_key_literal(5)


def test_cells(spark):
    df = spark.createDataFrame([("a", 5, None), ("b", None, "t")], "k STRING, n BIGINT, s STRING")
    text = cells.encode_cells(df, ["n"])
    assert dict(text.dtypes)["n"] == "string"
    back = cells.decode_cells(text, numbers=["n"], texts=["s"])
    assert rows(back) == [("a", 5, ""), ("b", 0, "t")]
    strict = cells.decode_cells(text, required_numbers=["n"])
    assert rows(strict, "k", "n") == [("a", 5), ("b", None)]


def test_weights(spark):
    df = spark.createDataFrame([("WatchEvent",), ("GollumEvent",), ("Nope",), (None,)], "t STRING")
    got = [r[0] for r in df.select(dimensions.trend_weight(F.col("t"))).collect()]
    assert got == [3, 0, 0, 0]
    own = df.select(dimensions.trend_weight(F.col("t"), {"Nope": 9})).collect()
    assert [r[0] for r in own] == [0, 0, 9, 0]


def test_rankings(spark, folder):
    path = f"{folder}/rankings.csv"
    with open(path, "w") as out:
        out.write(dimensions.LANGUAGE_RANKINGS_CSV)
    from_file = dimensions.read_language_rankings(spark, path)
    assert from_file.count() == 50
    assert rows(from_file) == rows(dimensions.language_rankings(spark))
    assert {t for _, t in from_file.dtypes} == {"string"}
