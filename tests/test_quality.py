"""Quality queries against plain loops, on a small export made up for it."""

import random
from collections import defaultdict

from factloom.operators.linkage import similarity
from factloom.plans import registry

VALUES = ("currency", "mbrevenue", "mbcost", "gross_profit", "unit")
COLUMNS = ("row_id", "source_code", "infocode", "productname", "startdate", "reportdate", *VALUES)


def _export(spark, path, rows):
    kinds = ", ".join(f"{c} {'long' if c == 'row_id' else 'string'}" for c in COLUMNS)
    spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], kinds).write.parquet(f"{path}/flat_export.parquet")
    return str(path)


def _made_up(seed, n=160):
    rng = random.Random(seed)
    name = lambda: rng.choice(["", "-"]) if rng.random() < 0.1 else rng.choice(["", "", "- "]) + "".join(rng.choice("甲乙丙丁") for _ in range(rng.randint(1, 4)))
    return [
        {"row_id": i, "source_code": rng.choice(["HKF", "SHD", "LDN"]), "infocode": rng.choice("abc"), "productname": name(), "startdate": "2024-01-01", "reportdate": rng.choice(["2024-12-31", "2023-12-31", "2022-12-31"]),
         "currency": rng.choice(["港元", None]), "mbrevenue": rng.choice([None, "1", "2", "3"]), "mbcost": rng.choice([None, "1"]), "gross_profit": None, "unit": "千元"}
        for i in range(n)
    ]


def _key(name):
    return "".join(name.lstrip("-").split())


def _same(a, b):
    a, b = _key(a), _key(b)
    return a == b if not a or not b else a in b or b in a


def _score(a, b):
    a, b = _key(a), _key(b)
    if not a or not b:
        return 200 if a == b else -1
    return 300 if a == b else 100 + min(len(a), len(b)) if a in b or b in a else -1


def _paired(exp, pred):
    """Pairs of one document and period, in the reference's order."""
    edges = sorted((-s, i, j) for i, a in enumerate(exp) for j, b in enumerate(pred) if (s := _score(a["productname"], b["productname"])) >= 0)
    left, right, out = set(), set(), []
    for _, i, j in edges:
        if i not in left and j not in right:
            out.append((exp[i], pred[j]))
            left.add(i)
            right.add(j)
    for i, a in enumerate(exp):
        for j, b in enumerate(pred):
            if i not in left and j not in right and any(a[f] for f in VALUES[1:4]) and all(a[f] == b[f] for f in VALUES):
                out.append((a, b))
                left.add(i)
                right.add(j)
    return out


def _compared(rows):
    """By document: missing and extra ids, counts, and what the fields differ in."""
    docs = {}
    for doc in {r["infocode"] for r in rows}:
        exp, pred = ([r for r in rows if r["infocode"] == doc and r["source_code"] == s] for s in ("HKF", "SHD"))
        at = lambda side, end: [r for r in side if r["reportdate"] == end]
        pairs = [p for end in sorted({r["reportdate"] for r in exp + pred}) for p in _paired(at(exp, end), at(pred, end))]
        bad = {f: sum(a[f] is not None and a[f] != b[f] for a, b in pairs) for f in VALUES}
        wrong = sum(any(a[f] is not None and a[f] != b[f] for f in VALUES) for a, b in pairs)
        missing = {r["row_id"] for r in exp} - {a["row_id"] for a, _ in pairs}
        extra = {r["row_id"] for r in pred} - {b["row_id"] for _, b in pairs}
        norm = lambda r: " ".join(r["productname"].split())
        periods, aliases = defaultdict(set), defaultdict(set)
        for r in exp:
            if norm(r):
                periods[norm(r)].add(r["reportdate"])
        for a, b in pairs:
            if norm(a) and norm(b):
                aliases[norm(b)].add(norm(a))
        forgiven = 0
        for r in pred:
            if r["row_id"] in extra and norm(r):
                known = {g for g in periods for x in (norm(r), *aliases[norm(r)]) if _same(x, g)}
                forgiven += bool(known) and not any(r["reportdate"] in periods[g] for g in known)
        docs[doc] = {"expected": len(exp), "predicted": len(pred), "matched": len(pairs) - wrong, "wrong": wrong, "missing": missing, "extra": extra, "forgiven": forgiven, "bad": bad}
    return docs


def test_compared_by_contained_names(spark, tmp_path):
    q = registry.queries()
    some_forgiven = 0
    for seed in range(3):
        rows = _made_up(seed)
        data, want = _export(spark, tmp_path / str(seed), rows), _compared(rows)
        assert {(r.kind, r.id) for r in q["c_unpaired_contained"](spark, data).collect()} == {(k, i) for d in want.values() for k in ("missing", "extra") for i in d[k]}
        got = {r.doc: r for r in q["c_compare_docs_contained"](spark, data).collect()}
        assert got.keys() == want.keys()
        for doc, w in want.items():
            r = got[doc]
            assert (r.expected, r.predicted, r.matched, r.wrong, r.missing, r.extra, r.forgiven) == (w["expected"], w["predicted"], w["matched"], w["wrong"], len(w["missing"]), len(w["extra"]) - w["forgiven"], w["forgiven"])
            assert {f: r[f"bad_{f}"] for f in VALUES} == w["bad"]
        some_forgiven += sum(w["forgiven"] for w in want.values())
        total = q["c_compare_corpus_contained"](spark, data).first()
        for k in ("matched", "wrong", "forgiven"):
            assert total[k] == sum(w[k] for w in want.values())
        assert {r.field: r.bad for r in q["c_compare_fields_contained"](spark, data).collect()} == {f: sum(w["bad"][f] for w in want.values()) for f in VALUES}
    assert some_forgiven


def _largest(left, right):
    """Size of a largest matching of names at least 0.7 alike, by trying all."""
    if not left:
        return 0
    rest = _largest(left[1:], right)
    return max([rest, *(1 + _largest(left[1:], right[:j] + right[j + 1 :]) for j, r in enumerate(right) if similarity(left[0], r) >= 0.7)])


def _commonest(values):
    kept = [v for v in values if v]
    return max(kept, key=lambda v: (kept.count(v), -kept.index(v)), default="")


def test_continuity_and_strategies_by_matching(spark, tmp_path):
    rng = random.Random(5)
    days = {"2024-06-30T16:00:00.000Z": (7, 1), "2024-07-01": (7, 1), "2024/7/1": (7, 1), "2024-06-30": (6, 30), "": None, "2024-06-30T16:00:00": (6, 30)}
    base = ["酒店服務業務甲乙丙", "物流服務", "電池材料收入", "Total", "合計"]
    rows = [
        {"row_id": i, "source_code": rng.choice(["HKF", "SHD", "LDN", "ASH"]), "infocode": f"d{rng.randint(0, 9)}", "productname": rng.choice(base)[: rng.randint(2, 9)] + rng.choice(["", "丁", "（附註3）"]), "startdate": None,
         "reportdate": rng.choice(list(days)), "currency": rng.choice(["港元", "人民币", None]), "mbrevenue": "1", "mbcost": None, "gross_profit": None, "unit": rng.choice(["千元", "", "元"])}
        for i in range(110)
    ] + [dict.fromkeys(COLUMNS) | {"row_id": 200 + k, "source_code": s, "infocode": "totals", "productname": "合計"} for k, s in enumerate(("HKF", "SHD"))]
    data, q = _export(spark, tmp_path, rows), registry.queries()
    names = lambda doc, s: sorted({n for r in rows if (r["infocode"], r["source_code"]) == (doc, s) and (n := r["productname"].replace("（附註3）", "").lower().translate(str.maketrans("務業電", "务业电"))) not in ("total", "合計")})
    docs = sorted({r["infocode"] for r in rows})
    of = lambda doc, s, f: [r[f] for r in rows if (r["infocode"], r["source_code"]) == (doc, s)]
    both = [d for d in docs if of(d, "HKF", "row_id") and of(d, "SHD", "row_id")]
    at = [(names(d, "HKF"), names(d, "SHD"), d) for d in both]
    sizes = [_largest(b, a) for a, b, _ in at]
    got = q["c_continuity_matched"](spark, data).first()
    assert (got.documents, got.prior_names, got.names, got.matched_names) == (len(at), sum(len(a) for a, _, _ in at), sum(len(b) for _, b, _ in at), sum(sizes))
    assert got.identity_recall == round(sum(sizes) / got.names, 6)
    assert (got.same_sets, got.same_counts) == (sum(a == b for a, b, _ in at), sum(len(a) == len(b) for a, b, _ in at))
    zipped = list(zip(sizes, at, strict=True))
    assert (got.all_matched, got.bijections) == (sum(m == len(b) for m, (_, b, _) in zipped), sum(m == len(a) == len(b) for m, (a, b, _) in zipped))
    assert (got.with_additions, got.with_removals) == (sum(m < len(b) for m, (_, b, _) in zipped), sum(m < len(a) for m, (a, _, _) in zipped))
    assert (got.currency_stable, got.unit_stable) == tuple(sum(_commonest(of(d, "HKF", f)) == _commonest(of(d, "SHD", f)) for d in both) for f in ("currency", "unit"))
    month_day = lambda d, s: _commonest([days.get(x) for x in of(d, s, "reportdate")])
    assert got.month_day_stable == sum(bool(month_day(d, "HKF")) and month_day(d, "HKF") == month_day(d, "SHD") for d in both)

    want = {k: [0, 0, 0, 0] for k in ("prior_recall", "prior_f1", "guarded_f1_0.5", "guarded_f1_0.6", "guarded_f1_0.7", "guarded_f1_0.8")}
    conflicts = [0, 0, 0, 0, 0]
    for prior, truth, d in at:
        candidates = []
        for s in ("LDN", "ASH", "HKF", "SHD"):
            if (v := names(d, s)) and v not in [c for _, c in candidates]:
                candidates.append((s, v))
        if len(candidates) < 2 or not prior or not truth:
            continue
        scored = []
        for s, v in candidates:
            m = _largest(prior, v)
            r, pr = m / len(prior), m / len(v)
            g = _largest(truth, v)
            scored.append({"s": s == "LDN", "prior_recall": r, "prior_f1": 2 * r * pr / (r + pr) if r + pr else 0.0, "gt": g / len(truth), "is": g == len(truth) == len(v)})
        now = max((c["gt"] for c in scored if c["s"]), default=0.0)
        top = [c for c in scored if c["prior_recall"] == max(x["prior_recall"] for x in scored)]
        best = max(c["gt"] for c in top)
        for k, hit in enumerate((True, any(c["s"] and c["is"] for c in scored), any(c["is"] for c in top), best > now, best < now)):
            conflicts[k] += hit
        for k, w in want.items():
            by = "prior_f1" if k.startswith("guarded") else k
            chosen = max(scored, key=lambda c: (c[by], c["s"]))
            guarded, held = k.startswith("guarded"), k.startswith("guarded") and chosen["prior_f1"] < float(k[-3:])
            after = now if held else chosen["gt"]
            w[0] += after > now
            w[1] += after < now
            w[2] += after == now
            w[3] += guarded and not held and not chosen["s"]
    assert {r.strategy: [r.improves, r.regresses, r.unchanged, r.takeovers] for r in q["c_strategies_matched"](spark, data).collect()} == want
    assert list(q["c_conflicts_matched"](spark, data).first()) == conflicts
    assert conflicts[0]


def test_simple_compare_by_contained_names(spark, tmp_path):
    rows = _made_up(9, 60)
    data, want = _export(spark, tmp_path, rows), set()
    for doc in {r["infocode"] for r in rows}:
        sides = []
        for s in ("HKF", "SHD"):
            side = {}
            for r in rows:
                if (r["infocode"], r["source_code"]) == (doc, s) and (k := "".join(r["productname"].split())):
                    side[k] = [r[f] and float(r[f]) for f in VALUES[1:4]]
            sides.append(side)
        exp, pred = sides
        used = set()
        for k, x in exp.items():
            near = None if k in pred else next((p for p in pred if k in p or p in k), None)
            hit = k if k in pred else near
            used.add(hit)
            bad = [hit is not None and v is not None and (w is None or abs(v - w) > 0.01) for v, w in zip(x, pred.get(hit, x), strict=True)]
            want.add((doc, k, "missing" if hit is None else "wrong" if any(bad) else "match", near, *bad))
        want |= {(doc, k, "extra", None, False, False, False) for k in pred if k not in used}
    assert {tuple(r) for r in registry.queries()["c_simple_compare_contained"](spark, data).collect()} == want
    assert {"missing", "wrong", "match", "extra"} >= {w[2] for w in want} and any(w[3] for w in want)
