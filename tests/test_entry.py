"""The entry file's contract, with the text operators and without them."""

import subprocess
import sys

import __spark_entry__ as entry


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.columns and df.count() > 0


def test_core_never_imports_llm():
    code = "import sys; sys.modules['factloom.llm'] = None\nimport __spark_entry__ as e, pkgutil, importlib, factloom\nfor m in pkgutil.walk_packages(factloom.__path__, 'factloom.'):\n    if '.llm' not in m.name and '__main__' not in m.name: importlib.import_module(m.name)\nprint(sorted(q for q in e.queries() if q.startswith('p')))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert out.stdout.strip().endswith("['p2_found', 'p3_found', 'p5_found']"), out.stderr


def test_page_ranges(spark):
    from factloom.functions.text import html_text, page_range, percent_text
    from pyspark.sql import functions as F

    df = spark.createDataFrame([([3, 1, 2, 7, 7],), ([],), (None,)], "p array<int>")
    assert [r.x for r in df.select(page_range(F.col("p")).alias("x")).collect()] == ["1-3, 7", "", None]
    r = spark.range(1).select(percent_text(F.lit(0.1234)).alias("a"), percent_text(F.lit(None).cast("double")).alias("b"), html_text(F.lit("<a&'>")).alias("c")).first()
    assert tuple(r) == ("12.3%", "-", "&lt;a&amp;&#x27;&gt;")


def test_simple_compare_with_containment(spark):
    from factloom.operators.quality import simple_compare

    s = "doc string, id long, name string, amount double"
    exp = spark.createDataFrame([("d", 1, "酒店", 5.0), ("d", 2, "酒店", 6.0), ("d", 3, "物流服務", None), ("d", 4, "", 1.0), ("d", 5, "甲", 1.0)], s)
    pred = spark.createDataFrame([("d", 11, "酒店", 6.005), ("d", 12, "物流", None), ("d", 13, "乙", 1.0)], s)
    got = sorted(tuple(r) for r in simple_compare(exp, pred, containment=True).collect())
    assert got == [("d", "乙", "extra"), ("d", "物流服務", "match"), ("d", "甲", "missing"), ("d", "酒店", "match")]
