import numpy as np
import pytest

from factloom.llm.subjects import Sentences, composition, gradient, score, start_parameters, subjects_found, train
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.1"


def test_sentences():
    s = Sentences(["甲乙。丙丁！fragment\n ok it's. 3.5 percent up. 12\t34", None, "", "One.", "。。"])
    assert list(s.document) == [0, 0, 0, 0, 3]
    feature, offsets = s.features()
    assert offsets[-1] == len(feature) and (np.diff(offsets) >= 1).all()


def test_features_do_not_depend_on_the_batch():
    texts = ["船用水泵上升。The pumps rose. ", "酒店。", "Hotel revenue fell, it's said. "]
    whole, offsets = Sentences(texts).features()
    alone = [Sentences([t]).features()[0] for t in texts]
    assert [sorted(whole[a:b]) for a, b in zip(offsets, offsets[1:])] == [sorted(x[a:b]) for t, x in zip(texts, alone) for o in [Sentences([t]).features()[1]] for a, b in zip(o, o[1:])]


def test_gradient_against_differences():
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in start_parameters(3).items()}
    p["e"] = p["e"][:50]
    feature, offsets = rng.integers(0, 50, 40).astype(np.int32), np.array([0, 10, 10, 25, 40])
    target = rng.integers(0, 2, (4, 3)).astype(np.float64)
    g, _ = gradient(p, feature, offsets, target)
    for name, at in (("w", (2, 1)), ("b", (0,)), ("e", (int(feature[3]), 4))):
        q = {k: v.copy() for k, v in p.items()}
        q[name][at] += 1e-4
        up = gradient(q, feature, offsets, target)[1]
        q[name][at] -= 2e-4
        down = gradient(q, feature, offsets, target)[1]
        assert g[name][at] == pytest.approx((up - down) / 2e-4, rel=0.02, abs=1e-3)


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "doc_labels", "subject_areas")]


def test_held_out_accuracy(spark, tables):
    """Trained on two thirds of the labelled documents, the others' labels are found; some labels are wrong."""
    documents, labels, areas = tables
    held = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    codes = sorted(r[0] for r in areas.select("subject_code").collect())
    found = {tuple(r) for r in score(documents, train(documents, labels.where(~held), codes)).select("doc_id", "subject_code").join(labels.where(held).select("doc_id").distinct(), "doc_id", "left_semi").collect()}
    true = {tuple(r) for r in labels.where(held).select("doc_id", "subject_code").distinct().collect()}
    assert len(found & true) / len(true) > 0.94
    assert len(found & true) / len(found) > 0.94


def test_edge_cases(spark, tables):
    _, _, areas = tables
    d = "doc_id long, text string"
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "no end"), (5, "x." * 50_000)], d).selectExpr("*", "'s' AS subject_code", "1 AS areas", "0 AS n")
    none = spark.createDataFrame([], "doc_id long, subject_code string, rater_no int")
    odd = spark.createDataFrame([(1, "law", 1), (99, "law", 1), (None, "law", 1), (4, "unknown", 1), (4, None, 1)], "doc_id long, subject_code string, rater_no int")
    assert subjects_found(docs, none, areas).count() == 0
    assert subjects_found(docs, odd, areas).count() == 0
    assert subjects_found(docs.limit(0), odd, areas).count() == 0
    assert subjects_found(docs, odd, areas.limit(0)).count() == 0


def test_small_training_and_labelled_left_out(spark):
    rows = [(i, "船舶航行碼頭。" if i % 2 else "法院聆訊原告。") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "ship" if i % 2 else "law", 1) for i in range(20)], "doc_id long, subject_code string, rater_no int")
    areas = spark.createDataFrame([("ship", ""), ("law", ""), ("other", "")], "subject_code string, title string")
    got = sorted(tuple(r) for r in subjects_found(docs, labels, areas).collect())
    assert got == [(i, "ship" if i % 2 else "law") for i in range(20, 40)]
    shares = {r.subject_code: r.n_documents for r in composition(docs, labels, areas).collect()}
    assert shares == {"ship": 20, "law": 20, "none": 0}
