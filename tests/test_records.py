import random
from datetime import date

import pytest

from factloom.operators import facts as fa
from factloom.operators import records as rc
from factloom.plans import delivery
from pyspark.sql import functions as F

DOC = "AN202503010000000001"
Y24, Y23 = (date(2024, 1, 1), date(2024, 12, 31)), (date(2023, 1, 1), date(2023, 12, 31))


def _page(page, rows, first=1):
    """Lines of a page, three points a character, those from the third on well below. ``rows``: [(text, left)]."""
    return [(DOC, page, first + k, text, float(left), float(left + 3 * len(text)), 100.0 + 14 * k + 60 * (k > 1), 110.0 + 14 * k + 60 * (k > 1)) for k, (text, left) in enumerate(rows)]


def _lines(spark, rows):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "infocode string, page_number int, line_no long, text string, x0 double, x1 double, top double, bottom double, line_id long")
    return df.selectExpr("*", "1 AS table_no", "'x' AS title", "2 AS kind")


REVENUE = [("收入明細", 60), ("截至2024年12月31日止年度 千港元", 60), ("2024年 2023年", 75), ("酒店 1,000 900", 60), ("物流 2,000 1,100", 60), ("合計 3,000 2,000", 60)]
MARGIN = [("分部業績", 60), ("千港元(7)", 60), ("毛利率a", 40), ("2024年 2023年", 66), ("酒店 400 300", 60), ("物流服務 700 600", 60)]
PRIOR = [(DOC, "酒店", "1", ""), (DOC, "物流", None, None), (DOC, "合計", None, None), (None, "x", None, None)]


def _prior(spark, rows=PRIOR):
    return spark.createDataFrame(rows, "infocode string, productname string, mbcost string, gross_profit string")


def test_from_lines_to_records(spark):
    rows = _page(1, REVENUE) + _page(2, MARGIN, first=100)
    done = rc.extract(_lines(spark, rows), _prior(spark))
    main = done.main.first()
    assert (main.title, main.all_names) == ("收入明細", True)
    got = sorted((r.PRODUCTNAME, r.REPORTDATE[:10], r.MBREVENUE, r.GROSS_PROFIT, r.CURRENCY, r.UNIT) for r in done.records.collect())
    assert got == sorted([
        ("酒店", "2024-12-31", "1000", "400", "港元", "002"), ("酒店", "2023-12-31", "900", "300", "港元", "002"), ("物流", "2024-12-31", "2000", "700", "港元", "002"), ("物流", "2023-12-31", "1100", "600", "港元", "002"),
        ("合计", "2024-12-31", "3000", "", "港元", "002"), ("合计", "2023-12-31", "2000", "", "港元", "002"),
    ])
    out = rc.outcomes(_lines(spark, rows), done).first()
    assert (out.doc, out.status, out.stage, out.message, out.records, out.tables, out.pages) == (DOC, "success", "success", "6 条", 6, 1, "1")


def test_statement_of_profit_or_loss(spark):
    rows = [("綜合損益表", 60), ("千元(7)", 60), ("2024年 2023年", 75), ("收入 1,100 1,900", 60), ("成本 (300) (200)", 60), ("毛利 0,800 1,700", 60)]
    done = rc.extract(_lines(spark, _page(1, rows)), _prior(spark, [(DOC, "酒店", None, None)]))
    assert sorted((r.product_name, r.amount, r.end_date) for r in done.facts.collect()) == [("合计", 1100.0, Y24[1]), ("合计", 1900.0, Y23[1])]


@pytest.mark.parametrize(("rows", "stage", "message"), [([("AN1", "nothing in Chinese")], "locate_fail", "无法识别"), ([("AN1", "董事會")], "locate_fail", "未定位到目标表")])
def test_outcomes_without_records(spark, rows, stage, message):
    lines = _lines(spark, [(c, 1, i, x, 60.0, 100.0, 100.0, 110.0) for i, (c, x) in enumerate(rows)])
    done = rc.extract(lines, _prior(spark, PRIOR[:0]))
    assert [(r.stage, r.message, r.records) for r in rc.outcomes(lines, done).collect()] == [(stage, message, 0)]


def test_no_lines(spark):
    done = rc.extract(_lines(spark, []), _prior(spark))
    assert done.records.count() == done.metrics.count() == rc.outcomes(_lines(spark, []), done).count() == 0
    nulls = _lines(spark, [(None, 1, 1, "收入", 1.0, 2.0, 3.0, 4.0), (DOC, None, None, None, None, None, None, None)])
    assert rc.extract(nulls, _prior(spark)).records.count() == 0


def _metrics(spark, grid, marks=(True, True), required=(), facts=None):
    g = spark.createDataFrame([(DOC, 1, 1, 7, "t", grid)], "infocode string, section_id int, page_number int, table_no long, table_id string, grid array<array<string>>")
    m = spark.createDataFrame([(DOC, 1, *marks)], "infocode string, section_id int, tells_gross boolean, tells_cost boolean")
    facts = facts or [("酒店", *Y24), ("酒店", *Y23), ("物流服務", *Y24), ("物流服務", *Y23), ("合计", *Y24), ("合计", *Y23)]
    r = spark.createDataFrame([(DOC, k, *f) for k, f in enumerate(facts)], "infocode string, fact_no long, product_name string, start_date date, end_date date")
    need = spark.createDataFrame([(DOC, x) for x in required], "infocode string, metric string")
    found = rc.metrics_of_tables(g, m, r).unionByName(rc.metrics_of_headers(g, r, need))
    got = fa.first_facts(found, ["infocode", "name", "start_date", "end_date", "metric"], ["place"])
    return sorted((x.name, x.end_date.year, x.metric, x.amount) for x in got.collect())


def test_metrics_by_section(spark):
    grid = [["", "2024年", "附註", "2023年", "毛利率"], ["合計", "1", "", "1", ""], ["酒店", "40", "9", "30", "5"], ["物流", "(7)", "", "", ""], ["小計", "3", "", "3", ""], ["", "50", "", "60", ""], ["飲食", "8", "", "8", ""]]
    # the total above any product isn't read; the label 物流 is part of 物流服務
    assert _metrics(spark, grid) == [("合计", 2023, "GROSS_PROFIT", 60.0), ("合计", 2024, "GROSS_PROFIT", 50.0), ("物流服務", 2024, "GROSS_PROFIT", -7.0), ("酒店", 2023, "GROSS_PROFIT", 30.0), ("酒店", 2024, "GROSS_PROFIT", 40.0)]
    # years go by their place, the latest first, whatever the header says
    assert _metrics(spark, [["成本", "2020年"], ["酒店", "5"]], (False, True)) == [("酒店", 2024, "MBCOST", 5.0)]
    assert _metrics(spark, [["", "2024年"], ["酒店", "5"]]) == []
    assert _metrics(spark, grid, (False, False)) == []


def test_metrics_by_header(spark):
    grid = [["", "2024年成本", "2023年毛利", "2022年成本"], ["酒店", "5", "6", "7"], ["x", "8", "9", "9"]]
    assert _metrics(spark, grid, (False, False), ["MBCOST"]) == [("酒店", 2024, "MBCOST", 5.0)]
    assert _metrics(spark, grid, (False, False), ["MBCOST", "GROSS_PROFIT"]) == [("酒店", 2023, "GROSS_PROFIT", 6.0), ("酒店", 2024, "MBCOST", 5.0)]
    assert _metrics(spark, grid, (False, False)) == []


def test_merging_against_a_loop(spark):
    rng = random.Random(9)
    facts = []
    for d in range(40):
        for no in range(rng.randint(1, 5)):
            for k in range(rng.randint(1, 4)):
                total = rng.random() < 0.35
                facts.append((f"d{d}", no, k, "合计" if total else rng.choice(["甲", "甲 ", "乙", "丙", "A", "a"]), total, *rng.choice([Y24, Y23]), "MBREVENUE", rng.choice([100.0, 100.5, 102.0, 0.0, None])))
    df = spark.createDataFrame(facts, "doc string, table_no long, fact_no int, name string, is_total boolean, start_date date, end_date date, metric string, amount double").withColumn("kept", F.lit(1))
    got = sorted(((r.doc, r.table_no, r.fact_no) for r in fa.merge_tables(df).collect()))
    key = lambda f: (f[3].replace(" ", "").lower(), f[5], f[6])
    want = []
    for d in {f[0] for f in facts}:
        merged = {}
        for no in sorted({f[1] for f in facts if f[0] == d}):
            extra = [f for f in facts if f[0] == d and f[1] == no]
            names = [{key(f)[0] for f in x if not f[4]} for x in (merged.values(), extra)]
            if merged and names[0] and names[1]:
                before = {f[5:7]: f[8] or 0 for f in merged.values() if f[4]}
                after = {f[5:7]: f[8] or 0 for f in extra if f[4]}
                if not names[0] & names[1] or any(abs(before[p] - after[p]) > abs(before[p]) * 0.01 for p in before.keys() & after.keys()):
                    continue
            for f in extra:
                merged.setdefault(key(f), f)
        want += [(d, f[1], f[2]) for f in merged.values()]
    assert got == sorted(want)
    assert fa.merge_tables(df.limit(0)).count() == 0


def test_queries_agree_with_each_other(spark):
    data = "/root/testdata/sf0.001"
    records = delivery.extracted_records(spark, data).groupBy("doc").count()
    outcomes = delivery.extraction_outcomes(spark, data)
    assert {r.doc: r["count"] for r in records.collect()} == {r.doc: r.records for r in outcomes.where("stage = 'success'").collect()}
