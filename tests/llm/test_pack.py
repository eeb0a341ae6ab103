import random
from collections import Counter
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st

from factloom.llm.pack import Complements, pack, plan, slots


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_plan_uses_every_item_once(counts):
    made = plan(counts, 64)
    used = Counter()
    for held, times in made:
        assert sum(held) <= 64 and times > 0
        for x in held:
            used[x] += times
    assert used == Counter(counts)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), min_size=1, max_size=20))
def test_slots_hold_every_rank(counts):
    table = slots(plan(counts, 64))
    fill: Counter = Counter()
    for length, n in counts.items():
        own = table[table.length == length].sort_values("start")
        assert own.start.iloc[0] == 0 and own.end.iloc[-1] == n and list(own.start[1:]) == list(own.end[:-1])
        for r in own.itertuples():
            for rank in range(r.start, r.end):
                fill[r.base + (rank - r.start) // r.k] += length
    assert max(fill.values()) <= 64


def test_complements():
    s = Complements({3: 1, 5: 2, 7: 1}, 20)
    assert s.single(5) == (5,) and s.single(4) is None
    assert s.pair(10) in {(5, 5), (7, 3)} and s.pair(6) is None
    assert sorted(s.triple(15)) in ([3, 5, 7], [5, 5, 5]) and s.triple(19) is None


def test_plan_closes_gaps_exactly():
    assert plan({60: 3, 40: 3}, 100) == [((60, 40), 3)]
    assert plan({50: 1, 30: 1, 20: 1}, 100) == [((50, 30, 20), 1)]
    assert sum(t for _, t in plan({1: 1000}, 100)) == 10


def _pack(spark, sizes, capacity=100):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id long, n int").selectExpr("*", "1 AS container", "2 AS piece", "'x' AS key", "0 AS bucket", "5 AS length")
    return pack(df, "doc_id", "n", capacity).collect()


def test_items_whole_or_cut(spark):
    rng = random.Random(6)
    sizes = [rng.choice([0, 1, 7, 33, 50, 99, 100, 101, 250, 33]) for _ in range(500)] + [None, -3]
    rows = _pack(spark, sizes)
    fill, pieces = Counter(), {}
    for r in rows:
        fill[r.container] += r.n
        pieces.setdefault(r.doc_id, []).append((r.piece, r.n))
    assert max(fill.values()) <= 100
    assert sorted(fill) == list(range(len(fill)))
    for i, n in enumerate(sizes):
        own = sorted(pieces.get(i, []))
        assert [p for p, _ in own] == list(range(len(own)))
        assert sum(x for _, x in own) == max(0, n or 0)
        assert all(x == 100 for _, x in own[:-1])
    total = sum(n for n in sizes if n and n > 0)
    assert len(fill) <= 1.05 * total / 100 + 1


def test_a_third_in_one_length(spark):
    rows = _pack(spark, [50] * 300 + list(range(1, 50)) * 4)
    fill = Counter()
    for r in rows:
        fill[r.container] += r.n
    assert max(fill.values()) <= 100 and len(fill) <= -(-sum(fill.values()) // 100) + 1


def test_empty_and_repeats(spark):
    assert _pack(spark, []) == []
    assert _pack(spark, [None, 0]) == []
    df = spark.createDataFrame([(1, 60), (1, 60)], "doc_id long, n int")
    assert len({r.container for r in pack(df, "doc_id", "n", 100).collect()}) == 2


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 3), min_size=1, max_size=10), st.lists(st.integers(1, 40), max_size=30))
def test_index_against_all_combinations(counts, gaps):
    """While copies are used up, a gap is filled exactly if and only if one, two or three of them add up to it."""
    stock = Complements(counts, 40)
    for gap in gaps:
        left = [x for x in range(1, 41) for _ in range(min(3, int(stock.free[x])))]
        possible = any(sum(c) == gap for k in (1, 2, 3) for c in combinations(left, k))
        found = stock.exact(gap)
        assert (found is not None) == possible
        assert stock.largest(gap) == max((x for x in left if x <= gap), default=None)
        for x in found or ():
            stock.free[x] -= 1
        assert (stock.free >= 0).all() and (found is None or sum(found) == gap)


def test_plan_at_a_large_capacity_takes_seconds():
    rng = random.Random(1)
    counts = Counter(min(131_072, max(1, int(rng.lognormvariate(6, 1.5)))) for _ in range(100_000))
    made = plan(counts, 131_072)
    assert sum(t for _, t in made) <= 1.02 * sum(x * n for x, n in counts.items()) / 131_072 + 1
