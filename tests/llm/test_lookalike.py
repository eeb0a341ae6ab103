import random
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from factloom.llm.lookalike import alike_found, alike_pairs, build_joins, build_mapping, check_mapping, transducer

rewrite = transducer()
TABLE = str.maketrans(build_mapping())


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Ｐreсision pumps", "Precision pumps"), ("Café", "Café"), ("a​́", "á"), ("⼀⾷", "一食"), (" x　", " x "), ("Ё", "Ë"),
        ("\u0958", "\u0915\u093c"), ("\u0915\u093c", "\u0915\u093c"), ("\u09c7\u09be", "\u09cb"), ("\u1112\u1161\u11ab", "\ud55c"), ("\u1112\u1161\u200b\u11ab", "\ud55c"), ("\U0001d400\U0001d7d7", "A9"), ("ᏴꓐⲂ", "BBB"),
        ("e\u0323\u0302", "\u1ec7"), ("e\u0302\u0323", "\u1ec7"), ("е\u0302\u0323", "\u1ec7"), ("a\u0301\u0302", "\u00e1\u0302"), ("\u0301a", "\u0301a"), ("a­b⁠c﻿", "abc"), ("cross‑border", "cross-border"), ("ｶﾞ", "ガ"), ("金", "金"), ("", ""),
    ],
)
def test_same_look(text, want):
    assert rewrite(text) == want


@pytest.mark.parametrize("text", ["a  b", "a b", "A", "a\tb", "a_b", "–", "-", "’", "'", "Cafe", "體", "体", "0", "O", "1", "l", "①"])
def test_visible_differences_stay(text):
    assert rewrite(text) == text


@settings(max_examples=500, deadline=None)
@given(st.text())
def test_idempotent(text):
    assert rewrite(rewrite(text)) == rewrite(text)


@settings(max_examples=500, deadline=None)
@given(st.text())
def test_composition_makes_no_difference(text):
    assert rewrite(unicodedata.normalize("NFC", text)) == rewrite(unicodedata.normalize("NFD", text))


def test_wide_letters_with_marks_compose():
    assert rewrite("\uff30\uff52\uff45\u0301\uff47\u200b\u0301x") == "Pr\u00e9\u01f5x"


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from(list("aeo\uff45\u0435\u0301\u200b\u00a0 \u3000\u2f00\uff76\uff9e\u0323\u0344\u0958\u093c\u09c7\u09be\u1112\u1161\u11ab\u0ddc\u0dcf\u302a"))))
def test_same_as_character_by_character(text):
    """One pass over clusters gives what mapping, decomposing and composing the whole text gives."""
    assert rewrite(text) == unicodedata.normalize("NFC", unicodedata.normalize("NFD", text.translate(TABLE)).translate(TABLE))


def test_conflicts_are_found():
    with pytest.raises(ValueError):
        check_mapping({"a": "b", "b": "a"})
    assert check_mapping({"a": "b", "b": "c"}) == {"a": "c", "b": "c"}
    with pytest.raises(ValueError, match="gives"):
        build_joins({"e": "a"})
    mapping = build_mapping()
    assert len(build_joins(mapping)) > 11_172 + 800
    assert not any(c in mapping for v in mapping.values() for c in v)


def test_long_text():
    text = "測試​" * 200_000
    assert rewrite(text) == "測試" * 200_000


def test_pairs_against_brute_force(spark):
    rng = random.Random(2)
    spellings = ["ab", "a​b", "ａb", "cd", "c⁠d", "", "​", None]
    rows = [(i, rng.choice(["g", "h", None]), rng.choice(spellings)) for i in range(80)]
    df = spark.createDataFrame(rows, "id long, grp string, txt string").selectExpr("*", "'x' AS look", "'y' AS t", "1 AS k")
    got = sorted(tuple(r) for r in alike_pairs(df, "grp", "id", "txt").collect())
    ok = [r for r in rows if r[1] is not None and r[2] is not None]
    want = sorted((a[0], b[0]) for a in ok for b in ok if a[0] < b[0] and a[1] == b[1] and a[2] != b[2] and rewrite(a[2]) == rewrite(b[2]))
    assert got == want and len(set(got)) == len(got)


def test_found_with_empty_tables(spark):
    lines = spark.createDataFrame([], "line_id long, infocode string, text string")
    flat = spark.createDataFrame([(1, "A​b"), (2, "Ab"), (3, None)], "row_id long, productname string")
    ref = spark.createDataFrame([(7, "Ab", None)], "ref_id long, canon_name string, alt_name string")
    assert [tuple(r) for r in alike_found(lines, flat, ref).collect()] == [("name", 7, 1)]
    assert alike_found(lines, flat.limit(0), ref.limit(0)).count() == 0


def test_selectors_and_tags_of_the_last_plane_show_nothing():
    mapping = build_mapping()
    assert all(mapping.get(chr(cp)) == "" for cp in (0xE0001, 0xE0020, 0xE007F, 0xE0100, 0xE01EF))
