"""Pages parsed once: whole arrays of objects, and element by element where that fails."""

from forgemeter.sources import landing

GOOD = '{"id":"1","type":"PushEvent","repo":{"id":1,"name":"r"}}'
BODIES = {
    f"[{GOOD}]": ["1"],
    f"[{GOOD},5]": ["1"],
    f"[null,{GOOD}]": ["1"],
    f'["x",{GOOD},true]': ["1"],
    f"[[{GOOD}]]": [],
    f"[{GOOD},[{GOOD}]]": ["1"],
    f"[{GOOD},{{}}]": ["1", None],
    f'[{GOOD},{{"id":2,"repo":"text"}}]': ["1", "2"],
    f'[{GOOD},{{"id":"3","payload":[1]}}]': ["1", "3"],
    f" [{GOOD}]": ["1"],
    GOOD: [],
    "[]": [],
    "[null]": [],
    "5": [],
    "": [],
}


def test_odd_elements_are_left_out_alone(spark):
    pages = spark.createDataFrame([(b,) for b in BODIES] + [(None,)], "body string")
    for body, want in BODIES.items():
        got = [r.id for r in landing.explode_pages(pages.where(pages.body == body)).collect()]
        assert got == want, body
    assert landing.explode_pages(pages.where("body is null")).count() == 0


def test_no_filter_reads_the_body(spark):
    pages = spark.createDataFrame([("[]",)], "body string")
    plan = landing.explode_pages(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert "StartsWith" in plan and not [line for line in plan.splitlines() if "Filter" in line and "StartsWith" in line]
