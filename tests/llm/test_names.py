import random

import pytest

from factloom.llm import names
from factloom.llm.names import agreement, best_of, best_possible, clean, distance, map_names, names_found, ranked_tokens, recombinations, reference_forms, signature, similar_pairs, token_ranks, tokens

REF = [(1, "Marine pumps", "船用水泵"), (2, "酒店租賃", "Hotel leasing"), (3, "Precision valves", None), (4, "Hotel logistics", "酒店物流"), (5, "Marine valves", "船用閥門"), (6, "Precision pumps", None), (7, "學校租賃", None)]


def _map(spark, names, ref=REF):
    flat = spark.createDataFrame(list(enumerate(names)), "row_id long, productname string").selectExpr("*", "1 AS ref_id", "'n' AS name", "'p' AS part")
    listed = spark.createDataFrame(ref, "ref_id long, canon_name string, alt_name string")
    return {names[r.row_id]: r.ref_id for r in names_found(flat, listed).collect()}


def test_wordings(spark):
    want = {
        "marine PUMPS": 1, "Ｍarine pumps": 1, "Sales of Marine pumps (note 5)": 1, "pumps, Marine": 1, "Mraine pumps": 1, "Marine pmups – PRC": 1, "船用水泵": 1, "船用 水泵*": 1, "水泵（船用）": 1, "Marine pumps 船用水泵": 1,
        "来自酒店租赁": 2, "酒租賃店": 2, "Hotel leasing": 2, "其中：酒店之租賃業務（附註3）": 2, "Hotel leas.": 2, "Precisoin valves": 3, "Provision of Precision valves": 3, "學校租賃及其他": 7, "酒店物流": 4,
        "租賃酒": 2, "Hotel pumps": -1, "學校物流": -1, "學校水泵": -1, "Pest control": -1, "合計": -1, "Sub-total": -1, "本集團": -1, "#": -1, "​": -1, "酒": -1,
    }
    assert _map(spark, list(want)) == want


def test_left_out(spark):
    assert _map(spark, [None, "", "  ", "　", "Marine pumps", "酒店租賃"]) == {}


def test_rows_repeat_and_empty(spark):
    assert _map(spark, []) == {}
    assert _map(spark, ["Marine pumps x", "y"], ref=[]) == {"Marine pumps x": -1, "y": -1}
    flat = spark.createDataFrame([(1, "marine pumps"), (1, "marine pumps")], "row_id long, productname string")
    assert names_found(flat, spark.createDataFrame(REF, "ref_id long, canon_name string, alt_name string")).count() == 2


def test_very_long(spark):
    assert _map(spark, ["Marine pumps " + "x" * 50_000]) == {"Marine pumps " + "x" * 50_000: -1}


@pytest.mark.parametrize(("a", "b", "d"), [("ab", "ba", 1), ("abc", "abc", 0), ("", "abc", 3), ("abcd", "acbd", 1), ("kitten", "sitting", 3)])
def test_distance(a, b, d):
    assert distance(a, b) == d


def test_agreement_in_any_order():
    assert agreement("pumps marine", "marine pumps") == 1
    assert agreement("水泵船用", "船用水泵") == 1
    assert agreement("marine pum.", "marine pumps") > 0.9


def test_clean():
    assert clean("（2）提供船用的水泵收入（附註8）") == ("船用水泵", "")
    assert clean("of which: Marine pumps (continuing) *") == ("", "marine pumps")


def test_recombinations():
    assert recombinations({"a x", "a y", "b x", "b y", "c z"}) == set()
    assert recombinations({"a x", "a y", "b x", "b z"}) == {"a z", "b y"}


def test_join_against_brute_force(spark):
    rng = random.Random(8)
    forms, _ = reference_forms(REF)
    parts = ["".join(rng.choice("船用水泵酒店租賃物流甲乙") for _ in range(rng.randint(1, 8))) for _ in range(60)] + [" ".join(rng.sample(["marine", "pumps", "hotel", "leasing", "valvse", "precision", "zq"], 2)) for _ in range(40)]
    parts = sorted(set(parts))
    ranks = token_ranks([f for _, f in forms])
    a = spark.createDataFrame([(p, r, signature(r)) for p in parts for r in [ranked_tokens(p, ranks)]], "part string, tokens array<int>, signature array<long>")
    b = spark.createDataFrame([(k, r, signature(r)) for k, (_, f) in enumerate(forms) for r in [ranked_tokens(f, ranks)]], "form_id int, tokens array<int>, signature array<long>")
    for threshold in (0.3, 0.4, 0.6, 0.8):
        got = sorted((r.part, r.form_id, round(r.jaccard, 9)) for r in similar_pairs(a, b, threshold, small=threshold != 0.6).collect())
        want = []
        for p in parts:
            for k, (_, f) in enumerate(forms):
                x, y = set(tokens(p)), set(tokens(f))
                if x & y and (j := len(x & y) / len(x | y)) >= threshold - 1e-9:
                    want.append((p, k, round(j, 9)))
        assert got == sorted(want)


def test_lower_jaccard_may_win(spark):
    """The candidate with the same letters in another order loses to one whose letters are in order."""
    assert _map(spark, ["工租服理售件電"], ref=[(1, "理工件服租電售", None), (2, "工租服理售", None)]) == {"工租服理售件電": 2}
    assert best_of("工租服理售件电", [(1, "理工件服租电售", 1.0), (2, "工租服理售", 5 / 7)])[0] == 2


def test_nothing_is_passed_over_that_could_win():
    rng = random.Random(3)
    words = ["marine", "pump", "valves", "hotel"]
    for _ in range(3000):
        a, b = ("".join(rng.choices("船用水泵酒店租", k=rng.randint(1, 7))) for _ in range(2))
        c, d = (" ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(2))
        for x, y in ((a, b), (c, d), (c[:-1] + ".", d)):
            s, t = set(tokens(x)), set(tokens(y))
            if s & t:
                assert agreement(x, y) <= best_possible(x, y, len(s & t) / len(s | t)) + 1e-9


def test_product_of_one_character(spark):
    assert _map(spark, ["鞋（附註2）", "提供鞋", "帽"], ref=[(7, "鞋", None), (8, "X", None)]) == {"鞋（附註2）": 7, "提供鞋": 7, "帽": -1}


def test_list_beyond_the_bounds(spark, monkeypatch):
    flat = spark.createDataFrame([("marine pumps",)], "name string")
    listed = spark.createDataFrame(REF, "ref_id long, canon_name string, alt_name string")
    monkeypatch.setattr(names, "RECOMBINATIONS", 1)
    with pytest.raises(ValueError, match="recombine"):
        map_names(flat, "name", listed)
    assert [tuple(r) for r in map_names(flat, "name", listed, recombine=False).collect()] == [("marine pumps", 1)]
    monkeypatch.setattr(names, "BROADCAST_FORMS", 0)
    assert [tuple(r) for r in map_names(flat, "name", listed, recombine=False).collect()] == [("marine pumps", 1)]
    monkeypatch.setattr(names, "LIST_ENTRIES", 3)
    with pytest.raises(ValueError, match="entries"):
        map_names(flat, "name", listed)
