"""Generated inputs: Spark operators against plain Python on the same rows.

Each example is one small Spark job, so example counts are kept low; the
alphabets are chosen to hit the edge cases (Unicode spaces, commas, case,
repeated titles and links).
"""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mailsift.functions import normalise_terms, ustrip
from mailsift.operators.items import ITEM_ORDER, dedupe_first, drop_tail, keyword_filter

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

SPACEY = st.text(alphabet=st.sampled_from(list("ab ,\t\n  　\x85XY")), max_size=12)


@SETTINGS
@given(st.lists(SPACEY, min_size=1, max_size=8))
def test_ustrip_and_terms(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", ustrip("v").alias("s"),
                     F.array_join(normalise_terms("v"), "|").alias("t")).collect()
    got = {r.i: (r.s, r.t) for r in rows}
    want = {i: (v.strip(), "|".join(k.strip().lower() for k in v.split(",") if k.strip()))
            for i, v in enumerate(values)}
    assert got == want


ITEM = st.tuples(st.integers(0, 5), st.sampled_from(["A", "B", "c d"]),
                 st.sampled_from(["/1", "/2"]), st.sampled_from([None, "", "x lithium", "Ion"]))


def py_pipeline(rows, terms, k=2):
    ordered = sorted(rows, key=lambda r: (-r[0], r[1]))  # uid desc, pos asc
    seen, uniq = set(), []
    for r in ordered:
        if (r[2], r[3]) not in seen:
            seen.add((r[2], r[3]))
            uniq.append(r)
    saved = uniq[:-k] if len(uniq) >= k else uniq
    return [r for r in saved
            if not terms or any(t in (r[2] + " " + (r[4] or "")).lower() for t in terms)]


@SETTINGS
@given(st.lists(ITEM, max_size=25), st.sampled_from([[], ["lithium"], ["a", "ion"]]))
def test_dedupe_tail_keyword_pipeline(spark, items, terms):
    rows = [(uid, pos, title, link, abstract)
            for pos, (uid, title, link, abstract) in enumerate(items)]
    df = spark.createDataFrame(rows, "uid long, pos int, title string, link string, abstract string")
    out = keyword_filter(drop_tail(dedupe_first(df), ITEM_ORDER, 2), terms)
    got = sorted(tuple(r) for r in out.collect())
    assert got == sorted(py_pipeline(rows, terms))
