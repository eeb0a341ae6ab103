import random

import pytest

from factloom.functions.text import label_kind, line_text, number_pieces
from factloom.operators import lines as ln
from factloom.operators.layout import cluster_edges, row_blocks, text_edges
from pyspark.sql import functions as F


def _one(spark, value, f):
    return spark.createDataFrame([(value,)], "c string").select(f(F.col("c")).alias("x")).first().x


@pytest.mark.parametrize(("text", "want"), [("收收收收入入入入", "收入"), ("① Ａ戶 ２", "1、A户2"), (None, None), ("", ""), ("㈱10", "(株)10")])
def test_line_text(spark, text, want):
    assert _one(spark, text, line_text) == want


@pytest.mark.parametrize(("text", "want"), [("合計：", "final"), ("分部總計", "subtotal"), ("小計", "subtotal"), ("本集團截至2024年止年度", "final"), ("酒店", None), (None, None), ("TOTAL", "final")])
def test_label_kind(spark, text, want):
    assert _one(spark, text, label_kind) == want


@pytest.mark.parametrize(("text", "want"), [("開發與授權105.5 9.2%", ["開發與授權", "105.5", "9.2%"]), ("12%34%", ["12%", "34%"]), ("酒店", ["酒店"]), ("", [""]), (None, None)])
def test_number_pieces(spark, text, want):
    assert _one(spark, text, number_pieces) == want


def _merge_in_sequence(sections, word, most):
    """The plain way: walk the sections, handing titles on."""
    import copy

    s, out = copy.deepcopy(sections), []
    for i, x in enumerate(s):
        if word in x["title"] and x["n"] <= most and i + 1 < len(s):
            s[i + 1] |= {"title": x["title"], "n": s[i + 1]["n"] + 1, "carried": x["title"]}
        else:
            out.append((i, x.get("carried")))
    return out


def test_merge_headings_against_sequence(spark):
    rng = random.Random(3)
    docs = {f"d{d}": [{"title": f"{rng.choice(['收入', '其他'])}{d}-{i}", "n": rng.choice([1, 2, 3, 4, 4, 5, 9])} for i in range(rng.randint(1, 25))] for d in range(40)}
    rows = [(d, i, i, x["title"], x["n"], False, 1, 1) for d, s in docs.items() for i, x in enumerate(s)]
    df = spark.createDataFrame(rows, "infocode string, section_id long, first_line long, title string, n_lines int, has_grouped boolean, page_from int, page_to int")
    got = {d: [] for d in docs}
    for r in ln.merge_headings(df, "收入").orderBy("infocode", "section_id").collect():
        got[r.infocode].append((r.section_id, r.carried_title))
    assert got == {d: _merge_in_sequence(s, "收入", 4) for d, s in docs.items()}


def _blocks_in_sequence(rows, g):
    """The plain way: a state machine over the rows of a page."""
    out, block, current, pending, active = {}, 0, [], [], False
    for i, r in enumerate(rows):
        if r["numeric"]:
            if not active:
                block += 1
                take = []
                for j in reversed(pending):
                    if rows[j]["narrative"] or take and rows[take[0]]["gap"] > g.gap:
                        break
                    take.insert(0, j)
                current = take
            current.append(i)
            active, pending = True, []
        elif active and r["gap"] <= g.gap and not r["narrative"]:
            current.append(i)
        else:
            active = False
            pending = [*pending, i][-g.pending :]
        for j in current:
            out[j] = block
        if not active:
            current = []
    return out


def test_row_blocks_against_sequence(spark):
    from factloom.operators.layout import Geometry

    g, rng = Geometry(), random.Random(5)
    pages = {p: [{"gap": rng.choice([0.0, 10.0, 44.0, 46.0, 80.0]), "numeric": rng.random() < 0.4, "narrative": rng.random() < 0.2} for _ in range(rng.randint(1, 40))] for p in range(60)}
    rows = [("d", p, i, r["gap"], r["numeric"], r["narrative"]) for p, s in pages.items() for i, r in enumerate(s)]
    df = spark.createDataFrame(rows, "infocode string, page_number int, row_no int, gap double, numeric boolean, narrative boolean")
    got = {p: {} for p in pages}
    for r in row_blocks(df, g).collect():
        got[r.page_number][r.row_no] = r.block_no
    assert got == {p: _blocks_in_sequence(s, g) for p, s in pages.items()}


def test_edges(spark):
    df = spark.createDataFrame([([307.0, 300.0, 340.0],), ([],)], "v array<double>")
    assert [r.c for r in df.select(cluster_edges(F.col("v"), 8).alias("c")).collect()] == [[303.5, 340.0], []]
    df = spark.createDataFrame([([70.0, 90.0, 131.0, 150.0, 300.0],), ([],)], "v array<double>")
    assert [r.c for r in df.select(text_edges(F.col("v")).alias("c")).collect()] == [[131.0, 300.0], []]


def test_running_total_over_stretches(spark):
    df = spark.range(100).selectExpr("'a' AS g", "id AS k", "id % 3 AS v")
    got = [r.s for r in ln.running_total(df, "g", "k", F.col("v"), "s", stretch=7).orderBy("k").collect()]
    want, total = [], 0
    for k in range(100):
        total += k % 3
        want.append(total)
    assert got == want


def test_pages_and_headers(spark):
    rows = [(1, "d", 1, 1, "附註", 0.0, 9.0, 50.0, 60.0), (2, "d", 1, 2, "收入", 0.0, 9.0, 200.0, 210.0), (3, "d", 2, 3, "收入", 0.0, 9.0, 200.0, 210.0), (4, "d", 2, 4, "17", 0.0, 9.0, 770.0, 780.0), (5, "d", 3, 5, None, 0.0, 9.0, None, None), (6, "d", 3, 6, "1 指某事", 0.0, 9.0, 731.0, 740.0)]
    df = spark.createDataFrame(rows, "line_id int, infocode string, page_number int, line_no int, text string, x0 double, x1 double, top double, bottom double")
    assert sorted(r.line_id for r in ln.content_lines(df).collect()) == [3, 5]
    assert ln.content_lines(df.limit(0)).count() == 0
