from hypothesis import given, settings
from hypothesis import strategies as st

from factloom.operators.diff import inventory_differences, latest_per_key, merge_copies

FIELDS = ["category", "pipeline_stage", "source_pages", "message", "local_rows", "gt_rows"]
SCHEMA = "infocode string, category string, pipeline_stage string, source_pages string, message string, local_rows string, gt_rows string, loaded_at timestamp_ntz"
CODE = "AN202301010000000001"


def _inventory(spark, rows):
    from datetime import datetime

    return spark.createDataFrame([(*r[:-1], datetime(2024, 1, r[-1])) for r in rows], SCHEMA)


def _diff(spark, a, b):
    return sorted((r.infocode, r.diff_field) for r in inventory_differences(_inventory(spark, a), _inventory(spark, b)).collect())


def test_not_differences(spark):
    a = [(CODE, "Empty", " ok", "1|2|10", None, "7", None, 1)]
    b = [(" ａn20230101-0000000001\t", "empty ", "OK", "10, 1;2", "  ", "007.0", "", 1)]
    assert _diff(spark, a, b) == []


def test_differences_and_latest(spark):
    a = [(CODE, "x", "s", "1", "m", "1", "1", 1), (CODE, "y", "s", "1", "m", "1", "1", 2), ("AN202301010000000002", "x", None, None, None, None, None, 1), (None, "x", None, None, None, None, None, 1), ("  ", "x", None, None, None, None, None, 1)]
    b = [(CODE, "y", "s", "1|2", "m2", "1,000", None, 1), ("AN202301010000000003", "x", None, None, None, None, None, 1), ("bad", "x", None, None, None, None, None, 1)]
    assert _diff(spark, a, b) == [(CODE, "gt_rows"), (CODE, "local_rows"), (CODE, "message"), (CODE, "source_pages"), ("AN202301010000000002", "only_a"), ("AN202301010000000003", "only_b")]


def test_empty_sides(spark):
    one = [(CODE, "x", None, None, None, None, None, 1)]
    assert _diff(spark, [], []) == []
    assert _diff(spark, one, []) == [(CODE, "only_a")]
    assert _diff(spark, [], one) == [(CODE, "only_b")]


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.integers(0, 60), st.tuples(st.sampled_from([None, "a", "b"]), st.sampled_from([None, "c"]))), st.dictionaries(st.integers(0, 60), st.tuples(st.sampled_from([None, "a", "b"]), st.sampled_from([None, "c"]))))
def test_against_brute_force(spark, a, b):
    frame = lambda d: spark.createDataFrame([(f"k{k:03d}", *v) for k, v in d.items()], "k string, x string, y string")
    got = sorted((r.k, r.diff_field) for r in merge_copies(frame(a), frame(b), "k", ["x", "y"]).collect())
    want = [(f"k{k:03d}", "only_a") for k in a.keys() - b.keys()] + [(f"k{k:03d}", "only_b") for k in b.keys() - a.keys()]
    want += [(f"k{k:03d}", f) for k in a.keys() & b.keys() for i, f in enumerate("xy") if a[k][i] != b[k][i]]
    assert got == sorted(want)


def test_partners_split_by_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        a = spark.range(50).selectExpr("concat('k', lpad(id, 3, '0')) AS k", "'1' AS x")
        b = spark.range(25, 75).selectExpr("concat('k', lpad(id, 3, '0')) AS k", "if(id % 2 = 0, '1', '2') AS x")
        got = merge_copies(a, b, "k", ["x"]).groupBy("diff_field").count().collect()
        assert {r.diff_field: r["count"] for r in got} == {"only_a": 25, "only_b": 25, "x": 13}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_latest_ties(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 1, "b"), ("k", None, "z")], "k string, at int, v string")
    assert [r.v for r in latest_per_key(df, "k", "at").collect()] == ["b"]
