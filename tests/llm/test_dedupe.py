import random
import re

import pytest

from factloom.llm import dedupe
from factloom.llm.dedupe import canonical, collapse, copies_found
from factloom.llm.queries import ORACLES, QUERIES
from pyspark.sql import functions as F

from ..oracle import agree


def _rows(spark, payloads):
    return spark.createDataFrame(list(enumerate(payloads, 1)), "rec_id long, payload string").selectExpr("*", "1 AS n", "'c' AS canonical", "2 AS first_id", "3 AS keep_id")


SAME = ['{"A": "x y", "B": "1,234"}', '{\n "b":"1 234",\n "a":"X-Y"}', "A=x y; B=1234", "b: 1.234 | a: (XY)", "A=x y; B=1234", "B=1234\nA=xy"]


def test_one_record_in_many_notations(spark):
    assert sorted(tuple(r) for r in copies_found(_rows(spark, SAME)).collect()) == [(1, k) for k in range(2, 7)]
    r = collapse(_rows(spark, SAME), "rec_id", "payload").collect()
    assert [(x.keep_id, x.n_copies, x.canonical) for x in r] == [(1, 6, "a=xy\nb=1234")]


def test_differing_values_stay_apart(spark):
    rows = ['{"A":"x","B":"1"}', '{"A":"x","B":"2"}', '{"A":"x"}', '{"A":"xB","C":"1"}', '{"A":"x","B":"1","C":"二"}', "plain text", "", None, None]
    assert copies_found(_rows(spark, rows)).count() == 0
    assert collapse(_rows(spark, rows), "rec_id", "payload").count() == 7


@pytest.mark.parametrize(
    ("payload", "want"),
    [('{"A": null, "B": ""}', ""), ("{broken", "broken"), ("", ""), (None, None), ("A=1;A=1", "a=1\na=1"), ("A=b=c; D=e", "a=bc\nd=e"), ("just words", "just words".replace(" ", "")), ("A\u0001=1", "a=1"), ("N" * 60 + "=1\r\n" + "long name of a field with many words and more=2", "longnameofafieldwithmanywordsandmore=2\n" + "n" * 60 + "=1"), ('{"a":"' + "z" * 100_000 + '"}', "a=" + "z" * 100_000)],
)
def test_canonical(spark, payload, want):
    df = spark.createDataFrame([(payload,)], "p string")
    assert df.select(canonical(F.col("p")).alias("c")).first().c == want


def test_empty(spark):
    assert copies_found(_rows(spark, SAME).limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    agree(spark, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("gap", [" ", "\n", " \n"])
def test_long_blanks_take_no_time(spark, gap):
    text = "a=1" + gap * 200_000 + "b c" + gap * 200_000 + "d"
    assert spark.createDataFrame([(text,)], "p string").select(canonical(F.col("p")).alias("c")).first().c == "a=1bcd"


def test_shared_digest_stops_the_query(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "digest", lambda c, name: [F.lit(1).alias(f"{name}0"), F.lit(1).alias(f"{name}1")])
    with pytest.raises(Exception, match="share a digest"):
        copies_found(_rows(spark, SAME[:1] + ["X=1"])).collect()


def test_groups_against_a_loop(spark):
    rng = random.Random(5)
    rows = [rng.choice(["A={};B={}", '{{"a":"{}","b":"{}"}}', "b: {1} | a: {0}"]).format(rng.choice("xyz"), rng.randint(1, 4)) for _ in range(300)]
    groups = {}
    for k, r in enumerate(rows, 1):
        groups.setdefault(tuple(sorted(re.findall(r"[xyz1-4]", r))), []).append(k)
    want = sorted((g[0], k) for g in groups.values() for k in g[1:])
    assert sorted(tuple(r) for r in copies_found(_rows(spark, rows)).collect()) == want
