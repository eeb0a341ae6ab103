import random
import re
from datetime import date

import pytest

from factloom.operators import grids as gr
from factloom.operators.selection import best_sections, name_hits, usable_name
from factloom.plans import registry
from pyspark.sql import functions as F

from .oracle import DATA

PERIOD = "截至2024年12月31日止年度"
Y24, Y23 = (date(2024, 1, 1), date(2024, 12, 31)), (date(2023, 1, 1), date(2023, 12, 31))


def _read(strategy, rows, names=(), end=date(2024, 12, 31), months=12, text=PERIOD):
    forms = {x.replace(" ", "") for r in rows for c in r for x in (c.strip(), gr.plain_name(c), gr.plain_header(c))}
    known = frozenset(f for f in forms if f and any(f in n.replace(" ", "") or n.replace(" ", "") in f for n in names))
    years = tuple(sorted({gr.read_year(y) for y in re.findall(gr.YEAR, text)}))
    return strategy(gr.Reading([list(r) for r in rows], known, bool(names), gr.read_year(text), years, end, months))


def test_columns():
    rows = [["", "附註", "2024年", "2023年"], ["收入", "3", "980", "910"], ["酒店", "", "1,000", "900"], ["物流", "", "(20)", "10"], ["", "", "980", "910"]]
    assert _read(gr.facts_by_columns, rows, ["酒店"]) == [("酒店", 1000.0, *Y24), ("酒店", 900.0, *Y23), ("物流", -20.0, *Y24), ("物流", 10.0, *Y23), ("合计", 980.0, *Y24), ("合计", 910.0, *Y23)]


def test_columns_sum_without_total():
    rows = [["甲乙", "2024年"], ["酒店甲", "5"], ["物流乙", "6"], ["毛利", "2"]]
    assert _read(gr.facts_by_columns, rows, ["酒店甲", "物流乙"]) == [("酒店甲", 5.0, *Y24), ("物流乙", 6.0, *Y24), ("合计", 11.0, *Y24)]


def test_short_header_is_right_aligned():
    assert gr.Reading([["2024年", "2023年"], ["酒店", "1", "2"]], frozenset(), False, None, (), None, 12).header(2) == "2023年 2"


def test_section_break():
    rows = [["", "2024年"], ["酒店", "5"], ["按地區", ""], ["香港", "9"]]
    assert [f[0] for f in _read(gr.facts_by_columns, rows, ["酒店"])] == ["酒店", "合计"]


def test_rows():
    rows = [["2024年", "", "", ""], ["", "酒店", "物流", "總計"], ["外部收入", "5", "6", "11"]]
    assert _read(gr.facts_by_rows, rows) == [("酒店", 5.0, *Y24), ("物流", 6.0, *Y24), ("合计", 11.0, *Y24)]


def test_statement():
    rows = [["", "2024年", "2023年"], ["收入", "11", "9"], ["-酒店", "5", "4"], ["-物流", "6", "5"], ["", "12", "9"], ["銷售成本", "(3)", "(2)"]]
    assert _read(gr.facts_by_statement, rows)[-2:] == [("合计", 12.0, *Y24), ("合计", 9.0, *Y23)]
    assert _read(gr.facts_by_statement, [["", "2024年"], ["收入", "11"], ["銷售成本", "(3)"]]) == [("合计", 11.0, *Y24)]


def test_statement_takes_years_from_the_text():
    rows = [["", "本集團"], ["收入", "11", "9"], ["銷售成本", "(3)", "(2)"]]
    grid = gr.Reading(rows, frozenset(), False, None, (2023, 2024), date(2024, 12, 31), 12)
    assert gr.facts_by_statement(grid) == [("合计", 11.0, *Y23), ("合计", 9.0, *Y24)]


@pytest.mark.parametrize("strategy", gr.STRATEGIES.values())
def test_nothing_to_read(strategy):
    for rows in ([], [[]], [["", ""]], [["甲"]], [["x" * 10_000]]):
        assert _read(strategy, rows) == []


def test_half_year():
    rows = [["酒店甲", "2024年6月"], ["酒店甲", "5"]]
    got = _read(gr.facts_by_columns, rows, ["酒店甲"], end=date(2024, 6, 30), months=6)
    assert got[0][2:] == (date(2023, 12, 31), date(2024, 6, 30))


def test_html(spark):
    html = "<table><tr class=a><th colspan='2'>A</th>\n<td> <b>x</b>\n y </td></tr><tr><td rowspan=2 colspan=3>1</td></tr><tr></tr></table>"
    df = spark.createDataFrame([(html,), ("",), (None,)], "h string").select(gr.html_grid(F.col("h")).alias("g"))
    assert [r.g for r in df.collect()] == [[["A", "A", "x\n y"], ["1", "1", "1"], []], [], None]


def _named(spark, grids, names):
    """Grids (one a document) with their names, as ``with_names`` gives them."""
    g = spark.createDataFrame([(f"d{i}", f"t{i}", x) for i, x in enumerate(grids)], "infocode string, table_id string, grid array<array<string>>")
    n = spark.createDataFrame([(f"d{i}", x) for i, own in enumerate(names) for x in dict.fromkeys(own)], "infocode string, name string")
    return gr.with_names(g, n)


CLASSES = [
    ([["甲", "1"]], "綜合損益表", [], "profit_loss"), ([], "", [], "unsupported"), (None, "", [], "unsupported"),
    ([["酒店", "物流"], ["5", "6"]], "", ["酒店", "物流"], "product_in_rows"), ([["酒店", "5"], ["物流", "6"]], "", ["酒店", "物流"], "product_in_columns"),
    ([["按產品", "甲"], ["5", "6"]], "", [], "product_in_rows"), ([["", "2024"], ["甲", "1"], ["乙", "2"]], "", [], "product_in_columns"), ([["5", "6"], ["7", "8"]], "", [], "unsupported"),
    # a text with brackets counts as a number, so one cell of text is left
    ([["銷售(附註)", "甲"], ["5", "6"]], "", [], "unsupported"),
    # two words of timing in a row vote twice, the second column's once
    ([["隨時間", "時間點"], ["甲", "1"]], "", [], "product_in_rows"),
    ([["隨時間", "1"], ["時間點", "2"], ["甲", "3"]], "", [], "product_in_columns"),
    # a name in capitals isn't in a cell, whose letters are made small
    ([["HOTEL", "5"], ["x", "6"]], "", ["HOTEL"], "product_in_columns"), ([["", "Hotel", "x"], ["", "6", "7"]], "", ["hotel"], "product_in_rows"),
    # a long dashed name by its letters
    ([["abcdefghijk-", "5", ""], ["", "", ""]], "", ["cab-defghijk"], "product_in_rows"),
]


def test_classes(spark):
    grids, titles, names, want = zip(*CLASSES, strict=True)
    with_title = spark.createDataFrame([(f"t{i}", x) for i, x in enumerate(titles)], "table_id string, title string")
    got = _named(spark, grids, names).join(with_title, "table_id").select("table_id", gr.classify(F.col("grid"), F.col("title"), F.col("named")).alias("c"))
    assert {r.table_id: r.c for r in got.collect()} == {f"t{i}": w for i, w in enumerate(want)}


def test_names_of_cells_against_a_loop(spark):
    rng = random.Random(4)
    word = lambda n: "".join(rng.choice("甲乙丙之 -:A") for _ in range(rng.randint(1, n)))
    grids = [[[word(6) for _ in range(rng.randint(1, 3))] for _ in range(3)] for _ in range(25)]
    names = [[x for x in (word(4) for _ in range(3)) if x.strip()] for _ in range(25)]
    got = {r.table_id: r for r in _named(spark, grids, names).collect()}
    for i, (grid, own) in enumerate(zip(grids, names, strict=True)):
        cells = {c for r in grid for c in r}
        bare = {c.replace(" ", "").lower().replace("之", "") for c in cells}
        part = {n.strip().replace("之", "").split("-")[-1].split(":")[0] for n in own}
        tight = {n.replace(" ", "") for n in own}
        forms = {x.replace(" ", "") for c in cells for x in (c.strip(), gr.plain_name(c), gr.plain_header(c))} - {""}
        r = got[f"t{i}"]
        assert set(r.named) == {b for b in bare if any(p and p in b for p in part)}
        assert set(r.known) == {f for f in forms if any(n and (f in n or n in f) for n in tight)}
        assert r.has_names == bool(own)


@pytest.mark.parametrize("few", [0, 2, 64])
def test_named_cells_for_few_names_and_many(spark, few):
    """Both ways of ``with_named`` against ``with_names``; neither repeats a grid or loses one."""
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("甲乙丙之 -:Ab") for _ in range(rng.randint(0, n)))
    grids = [(f"d{rng.randrange(6)}", f"t{i}", [[word(14), None, "x"], [word(6)], []]) for i in range(60)] + [("d0", "empty", []), ("d0", "null", None), (None, "no code", [["甲"]]), ("d9", "no names", [["甲"]])]
    g = spark.createDataFrame(grids, "infocode string, table_id string, grid array<array<string>>")
    names = {(f"d{d}", x) for d in range(6) for x in (word(rng.choice((3, 14))) for _ in range(d)) if x.strip()} | {("d1", "甲乙丙-bbbbbbb"), ("d5", "乙甲-bbbbbbbbb"), ("d5", "-")}
    n = spark.createDataFrame(sorted(names), "infocode string, name string")
    cells = lambda df: {r.table_id: sorted(r.named) for r in df.collect()}
    got = gr.with_named(g, n, few)
    assert got.columns == [*g.columns, "named"] and got.count() == len(grids)
    want = cells(gr.with_names(g, n))
    assert cells(got) == want and any(want.values())


@pytest.mark.parametrize("query, most", [("t_html_classified", 24), ("t_grids_classified", 24)])
def test_classifying_keeps_a_short_plan(spark, query, most):
    """The driver holds the plan with its stages: what classifying doesn't ask for isn't in it."""
    plan = registry.queries()[query](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= most


def test_grid_facts_survive_bad_rows(spark):
    grid, year = [["", "2024年"], ["酒店甲", "5"]], (2024, [2024], date(2024, 12, 31))
    rows = [("a", grid, "product_in_columns", ["酒店甲"], True, *year, None, "港元", "千元"), ("e", grid, "product_in_columns", [], False, *year, 100_000, "", ""), ("b", None, "product_in_columns", None, None, None, None, None, 12, None, None), ("c", [[None]], "nothing", [], False, None, None, None, 12, "", "")]
    df = spark.createDataFrame(rows, "table_id string, grid array<array<string>>, classification string, known array<string>, has_names boolean, period_year int, period_years array<int>, period_end date, period_months int, currency string, unit string")
    got = gr.grid_facts(df).collect()
    assert {(r.table_id, r.currency, r.unit, r.metric) for r in got if r.error is None} == {("a", "港元", "千元", "MBREVENUE")}
    assert [(r.table_id, r.product_name) for r in got if r.error] == [("e", None)]
    assert gr.grid_facts(df.limit(0)).count() == 0


def test_usable_names(spark):
    df = spark.createDataFrame([(x,) for x in ("酒店╱餐飲", "合計", "Ａ", "A / B", "某公司")], "n string")
    assert [r.u for r in df.select(usable_name(F.col("n")).alias("u")).collect()] == ["酒店", None, "A", "A", None]


def test_hits_against_a_loop(spark):
    rng = random.Random(6)
    word = lambda n: "".join(rng.choice("甲乙丙丁-:/") for _ in range(rng.randint(1, n)))
    words = {(d, s): [word(6) for _ in range(rng.randint(1, 4))] for d in "pq" for s in range(8)}
    names = {d: sorted({word(4) for _ in range(12)} | {"甲乙丙丁甲乙丙丁甲乙-"}) for d in "pq"}
    w = spark.createDataFrame([(d, s, x) for (d, s), own in words.items() for x in own], "infocode string, section_id long, text string")
    n = spark.createDataFrame([(d, x) for d, own in names.items() for x in own], "infocode string, name string")
    got = {(r.infocode, r.section_id): (r.hits, r.exact_hits) for r in name_hits(w, n).collect()}
    for (d, s), own in words.items():
        letters = set("".join(own))
        part = lambda x: x.split("-")[-1].split(":")[0]
        a = sum(bool(part(x)) and any(part(x) in y for y in own) or len(x) > 10 and "-" in x and set(x) <= letters for x in names[d])
        b = sum(bool(part(x).split("/")[0]) and part(x).split("/")[0] in own for x in names[d])
        c = sum(set(x) <= letters for x in names[d])
        assert got.get((d, s), (0, 0)) == (max(a, b, c), b)


def test_best_section_rules(spark):
    s = "infocode string, section_id long, title string, has_revenue boolean, has_cost boolean, has_gross boolean, n_names int, hits int, exact_hits int"
    no, yes = (False, False, False), (True, True, True)
    rows = [
        ("one_full", 1, "收入明細", *no, 2, 1, 0), ("one_full", 2, "附註", *no, 2, 2, 0),
        ("statement", 1, "收入", *no, 2, 2, 0), ("statement", 2, "綜合損益表", *yes, 2, 2, 0), ("not_whole", 1, "收入", *no, 2, 2, 0), ("not_whole", 2, "綜合損益表", True, False, True, 2, 2, 0),
        ("tier", 1, "損益表", *no, 0, 0, 0), ("tier", 2, "收入明細", *no, 0, 0, 0), ("single", 1, "收入明細", *no, 1, 0, 0), ("single", 2, "損益表", *no, 1, 0, 0),
        ("first", 1, "甲", *no, 3, 1, 0), ("first", 2, "乙", *no, 3, 1, 3), ("alone", 1, "甲", *no, 3, 2, 3), ("alone", 2, "收入明細", *no, 3, 1, 0),
    ]
    got = {r.infocode: (r.section_id, r.rule, r.all_names) for r in best_sections(spark.createDataFrame(rows, s)).collect()}
    assert got == {"one_full": (2, 1, True), "statement": (2, 2, True), "not_whole": (2, 4, True), "tier": (2, 4, False), "single": (2, 3, False), "first": (1, 5, False), "alone": (1, 5, True)}
