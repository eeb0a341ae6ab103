"""Quality of predicted rows against expected ones, by document and over the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import shared_dir
from .linkage import contained_names, greedy_pairs, matched_names, signature


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def forgiven_extras(exp: DataFrame, pred: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, doc) of predicted rows without a pair whose product is expected, but in other periods only.

    A product is expected under any name that contains its own or is contained in it, and under the names (and
    those that contain them or are contained in them) of the expected rows that rows of its name are paired with.
    Both sides have product, the name as written but for white space, besides the columns of ``pair_rows``.
    """
    shared_dir(exp.sparkSession)
    # names of dashes alone match each other; the mark stands for them since no other name contains it
    key = F.when(F.length("name") == 0, "\u0001").otherwise(F.col("name"))
    named = lambda df: df.where(F.length("product") > 0).select("id", "doc", "product", key.alias("name"), "start_date", "end_date")
    e, p = named(exp), named(pred)
    extra = p.join(pairs, p["id"] == pairs["pred_id"], "left_anti").checkpoint()
    products = extra.select("doc", "product").distinct()
    aliases = pairs.join(e.select(F.col("id").alias("exp_id"), F.col("name").alias("term")), "exp_id").join(p.select(F.col("id").alias("pred_id"), "doc", "product"), "pred_id").select("doc", "product", "term")
    terms = extra.select("doc", "product", F.col("name").alias("term")).union(aliases.join(products, ["doc", "product"], "left_semi")).distinct()
    whole = lambda df, c: df.select("doc", F.lit("").alias("start_date"), F.lit("").alias("end_date"), F.col(c).alias("name"), F.struct("doc", F.col(c).alias("name")).alias("id")).distinct()
    near = contained_names(whole(e, "name"), whole(terms, "term")).select("exp_id.doc", F.col("exp_id.name").alias("known"), F.col("pred_id.name").alias("term"))
    known = terms.join(near, ["doc", "term"]).select("doc", "product", "known").distinct().checkpoint()
    told = known.join(e.select("doc", F.col("name").alias("known"), "start_date", "end_date").distinct(), ["doc", "known"]).select("doc", "product", "start_date", "end_date").distinct()
    return extra.join(known.select("doc", "product"), ["doc", "product"], "left_semi").join(told, ["doc", "product", "start_date", "end_date"], "left_anti").select("id", "doc")


# Root causes and stages of a run, and what they mean.
CAUSES = {
    "locate_fail": "no section or table found", "parse_fail": "found but not read", "select_fail": "read but nothing chosen", "format_fail": "chosen but all rows left out", "empty_output": "no rows", "exception": "failed", "unknown": "unknown",
    "missing": "some expected rows absent", "value_wrong": "product found, values differ", "extra": "not expected", "forgiven_amounts": "one table, all expected amounts among its rows", "forgiven_history": "the chosen section names all earlier products",
}


def compare_documents(exp: DataFrame, pred: DataFrame, pairs: DataFrame, fields: list[str], tolerance: float = 1e-4, containment: bool = False, runs: DataFrame | None = None) -> DataFrame:
    """Counts, field agreement, rates, category and causes of each document on either side.

    A field differs when the expected value isn't null (F20) and its signature isn't the predicted one's. A
    pair without a difference is matched, else wrong; expected rows without a pair are missing, predicted ones
    extra. An extra row is forgiven (J15) when its product is among the expected ones of its document but not
    in its period: a period the expectation left out. Products are the same when their names are equal, with
    ``containment`` as in ``forgiven_extras``.

    ``runs`` (doc, stage, tables, all_names, totals_agree, covered) says how the predicted rows came about. With it a
    document with problems is forgiven as a whole when a single table was read and all expected amounts are among the
    predicted (its extra rows then count as forgiven), or when the chosen section names all earlier products, rows were
    predicted and totals agree; and missing rows of a document without predicted ones have its stage for their cause.

    Each side is read once: expected rows with their partners and extra rows are added up in one aggregate.
    """
    e = exp.select(F.col("id").alias("exp_id"), "doc", *[F.col(f).alias(f"e_{f}") for f in fields])
    p = pred.select(F.col("id").alias("pred_id"), *[F.col(f).alias(f"p_{f}") for f in fields])
    both = e.join(pairs.select("exp_id", "pred_id"), "exp_id", "left").join(p, "pred_id", "left")
    found = F.col("pred_id").isNotNull()
    wrong = {f: found & F.col(f"e_{f}").isNotNull() & (signature(F.col(f"e_{f}"), tolerance) != signature(F.col(f"p_{f}"), tolerance)) for f in fields}
    both = both.select("doc", found.alias("found"), *[w.cast("int").alias(f"bad_{f}") for f, w in wrong.items()])
    n_bad = sum((F.col(f"bad_{f}") for f in fields), F.lit(0))
    one = lambda c: c.cast("int")
    rows = both.select(
        "doc", F.lit(1).alias("expected"), one(F.col("found")).alias("predicted"), one(F.col("found") & (n_bad == 0)).alias("matched"), one(F.col("found") & (n_bad > 0)).alias("wrong"), *[f"bad_{f}" for f in fields],
        one(~F.col("found")).alias("missing"), F.lit(0).alias("extra"), F.lit(0).alias("forgiven"),
    )
    extra = pred.join(pairs, pred["id"] == pairs["pred_id"], "left_anti")
    if containment:
        extra = extra.select("id", "doc").join(forgiven_extras(exp, pred, pairs).select("id").withColumn("told", F.lit(1)), "id", "left")
    else:
        periods = exp.groupBy("doc", "name").agg(F.collect_set(F.struct("start_date", "end_date")).alias("periods"))
        of = F.struct("start_date", "end_date")
        told = (F.length("name") > 0) & F.col("periods").isNotNull() & ~F.coalesce(F.array_contains("periods", of), F.lit(False))
        extra = extra.select("doc", "name", "start_date", "end_date").join(periods, ["doc", "name"], "left").withColumn("told", one(told))
    told = F.coalesce("told", F.lit(0))
    extra = extra.select("doc", F.lit(0).alias("expected"), F.lit(1).alias("predicted"), F.lit(0).alias("matched"), F.lit(0).alias("wrong"), *[F.lit(0).alias(f"bad_{f}") for f in fields], F.lit(0).alias("missing"), (1 - told).alias("extra"), told.alias("forgiven"))
    counts = ("expected", "predicted", "matched", "wrong", *[f"bad_{f}" for f in fields], "missing", "extra", "forgiven")
    docs = rows.unionByName(extra).groupBy("doc").agg(*[F.sum(c).alias(c) for c in counts])
    return _rated(docs if runs is None else _forgiven(docs, runs, fields), runs is not None)


def _forgiven(docs: DataFrame, runs: DataFrame, fields: list[str]) -> DataFrame:
    """Documents forgiven as a whole have no problems left; ``whole`` says why, ``stage`` how they were read."""
    d = docs.join(runs.select("doc", "stage", "tables", "all_names", "totals_agree", "covered"), "doc", "left")
    problem = (F.col("missing") > 0) | (F.col("extra") > 0) | (F.col("wrong") > 0)
    yes = lambda c: F.coalesce(c, F.lit(False))
    amounts = problem & yes(F.col("tables") == 1) & yes(F.col("covered"))
    history = problem & yes(F.col("all_names")) & (F.col("predicted") > 0) & yes(F.col("totals_agree"))
    d = d.withColumn("whole", F.when(amounts, "forgiven_amounts").when(history, "forgiven_history"))
    d = d.withColumn("forgiven", F.col("forgiven") + F.when(F.col("whole") == "forgiven_amounts", F.col("extra")).otherwise(0))
    reset = {c: F.when(F.col("whole").isNotNull(), 0).otherwise(F.col(c)) for c in ("missing", "extra", "wrong", *[f"bad_{f}" for f in fields])}
    d = d.withColumn("matched", F.when(F.col("whole").isNotNull(), F.col("expected")).otherwise(F.col("matched"))).withColumns(reset)
    return d.select(*docs.columns, F.coalesce("stage", F.lit("unknown")).alias("stage"), "whole")


def _rated(docs: DataFrame, told: bool) -> DataFrame:
    """Rates and category of documents, and with ``told`` their cause and the kind of their problem."""
    whole = F.col("whole").isNotNull() if told else F.lit(False)
    scored = F.when(whole, F.col("expected")).otherwise(F.greatest(F.col("predicted") - F.col("forgiven"), F.lit(0)))
    clean = (F.col("missing") == 0) & (F.col("extra") == 0) & (F.col("wrong") == 0)
    out = docs.select(
        "*",
        F.round(_ratio(F.col("matched"), F.col("expected")), 6).alias("recall"),
        F.round(_ratio(F.col("matched"), scored), 6).alias("precision"),
        F.round(_ratio(F.col("matched"), F.col("matched") + F.col("wrong")), 6).alias("field_accuracy"),
        F.round(F.col("matched") / F.greatest(F.col("expected"), scored, F.lit(1)), 6).alias("comprehensive_hit"),
        F.when(clean, F.when((F.col("forgiven") == 0) & ~whole, "match").otherwise("forgiven")).otherwise("differs").alias("category"),
    )
    if not told:
        return out
    empty = (F.col("predicted") == 0) | (F.col("stage") == "empty_output")
    only = lambda c: (F.col("missing") + F.col("extra") + F.col("wrong") == F.col(c)) & (F.col(c) > 0)
    problem = F.when(clean, F.lit(None)).when(empty, "empty").when(only("missing"), "missing").when(only("extra"), "extra").when(only("wrong"), "wrong").otherwise("mixed")
    lost = F.when(F.col("predicted") > 0, "missing").when(F.col("stage") == "success", "empty_output").otherwise(F.col("stage"))
    return out.withColumn("problem", problem).withColumn("missing_cause", F.when(F.col("missing") > 0, lost))


def corpus_quality(docs: DataFrame) -> DataFrame:
    """One row over all documents: sums, categories and micro-averaged rates; with runs also kinds of problems."""
    counts = ("expected", "predicted", "matched", "wrong", "missing", "extra", "forgiven")
    more = []
    if "problem" in docs.columns:
        more = [F.count_if(F.col("problem") == k).alias(f"docs_{k}") for k in ("empty", "missing", "extra", "wrong", "mixed")] + [F.count_if(F.col("whole") == k).alias(f"docs_{k}") for k in ("forgiven_amounts", "forgiven_history")]
    total = docs.agg(F.count("*").alias("documents"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts], *[F.count_if(F.col("category") == k).alias(f"docs_{k}") for k in ("match", "forgiven", "differs")], *more)
    scored = F.greatest(F.col("predicted") - F.col("forgiven"), F.lit(0))
    return total.select(
        "*",
        F.round(_ratio(F.col("matched"), F.col("expected")), 6).alias("recall"),
        F.round(_ratio(F.col("matched"), scored), 6).alias("precision"),
        F.round(_ratio(F.col("matched"), F.col("matched") + F.col("wrong")), 6).alias("field_accuracy"),
        F.round(F.col("matched") / F.greatest(F.col("expected"), scored, F.lit(1)), 6).alias("comprehensive_hit"),
        F.round(_ratio(F.col("matched") + F.col("wrong"), F.col("expected")), 6).alias("biz_hit"),
    )


def causes(docs: DataFrame) -> DataFrame:
    """(kind, cause, documents, rows): root causes of problems by rows, and stages of runs by documents."""
    c = docs.select(F.explode(F.array(
        F.struct(F.lit("cause").alias("kind"), F.col("missing_cause").alias("cause"), F.col("missing").alias("rows")), F.struct(F.lit("cause").alias("kind"), F.lit("value_wrong").alias("cause"), F.col("wrong").alias("rows")),
        F.struct(F.lit("cause").alias("kind"), F.lit("extra").alias("cause"), F.col("extra").alias("rows")), F.struct(F.lit("forgiven").alias("kind"), F.col("whole").alias("cause"), F.col("expected").alias("rows")),
        F.struct(F.lit("stage").alias("kind"), F.col("stage").alias("cause"), F.col("predicted").alias("rows")))).alias("x")).select("x.*")
    return c.where(F.col("cause").isNotNull() & ((F.col("kind") != "cause") | (F.col("rows") > 0))).groupBy("kind", "cause").agg(F.count("*").alias("documents"), F.sum("rows").alias("rows"))


def field_quality(docs: DataFrame, fields: list[str]) -> DataFrame:
    """(field, ok, bad, accuracy) over all documents, one row a field."""
    pairs = F.col("matched") + F.col("wrong")
    long = docs.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"bad_{f}").alias("bad"), pairs.alias("pairs")) for f in fields])).alias("x")).select("x.*")
    sums = long.groupBy("field").agg(F.sum(F.col("pairs") - F.col("bad")).alias("ok"), F.sum("bad").alias("bad"))
    return sums.withColumn("accuracy", F.round(_ratio(F.col("ok"), F.col("ok") + F.col("bad")), 6))


def number_tokens(lines: DataFrame, doc: str) -> DataFrame:
    """(doc, token) of the numbers written in the lines of a document, as written and without brackets."""
    found = F.regexp_extract_all("text", F.lit(r"\(?-?\d[\d,]*(?:\.\d+)?\)?"), 0)
    bare = F.transform(found, lambda t: F.regexp_replace(t, "[()]", ""))
    return lines.select(doc, F.explode(F.array_union(found, bare)).alias("token")).distinct()


def values_located(values: DataFrame, tokens: DataFrame, doc: str) -> DataFrame:
    """(doc, n_values, n_found, located): expected numbers one of whose forms a document has.

    ``values``: doc, value_id, forms. Forms meet tokens by equality, so that no document's whole text is
    gathered. Located means none is missing, or of more than four at least seven in ten are found.
    """
    forms = values.where(F.size("forms") > 0).select(doc, "value_id", F.explode("forms").alias("token"))
    hits = forms.join(tokens, [doc, "token"], "left_semi").select("value_id").distinct().withColumn("hit", F.lit(1))
    n = values.where(F.size("forms") > 0).select(doc, "value_id").join(hits, "value_id", "left").groupBy(doc).agg(F.count("*").alias("n_values"), F.count("hit").alias("n_found"))
    return n.withColumn("located", (F.col("n_found") == F.col("n_values")) | ((F.col("n_values") > 4) & (F.col("n_found") * 10 >= F.col("n_values") * 7)))


def dominant(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """(key, value) the commonest value that is neither null nor blank; ties go to the first by ``order``."""
    counts = df.where(F.trim(F.col(value)) != "").groupBy(key, value).agg(F.count("*").alias("n"), F.min(order).alias("at"))
    return counts.groupBy(key).agg(F.max_by(value, F.struct("n", -F.col("at"))).alias(value))


def strategy_choices(candidates: DataFrame, doc: str, guards: tuple[float, ...] = (0.5, 0.6, 0.7, 0.8)) -> DataFrame:
    """(strategy, improves, regresses, unchanged, takeovers) of choosing among candidate sets.

    ``candidates`` has, for each document and source, n_names, n_prior, matched_prior, n_gt, matched_gt and
    selected (the source in use). A strategy takes the candidate with the best recall or F1 of prior names,
    the selected one on a tie; a guarded one keeps the selected unless the best F1 reaches its bound.
    """
    recall = _ratio(F.col("matched_prior"), F.col("n_prior"))
    precision = _ratio(F.col("matched_prior"), F.col("n_names"))
    f1 = F.when(recall + precision > 0, 2 * recall * precision / (recall + precision)).otherwise(F.lit(0.0))
    c = candidates.select(doc, "source", "selected", recall.alias("prior_recall"), f1.alias("prior_f1"), _ratio(F.col("matched_gt"), F.col("n_gt")).alias("gt"))
    now = F.max(F.when(F.col("selected"), F.col("gt"))).alias("now")
    best = lambda by: F.max_by(F.struct("source", "selected", "prior_f1", "gt"), F.struct(by, "selected", "source"))
    per_doc = c.groupBy(doc).agg(F.coalesce(now, F.lit(0.0)).alias("now"), best("prior_recall").alias("by_recall"), best("prior_f1").alias("by_f1"))
    options = [F.struct(F.lit("prior_recall").alias("strategy"), F.lit(-1.0).alias("bound"), F.col("by_recall").alias("b")), F.struct(F.lit("prior_f1").alias("strategy"), F.lit(-1.0).alias("bound"), F.col("by_f1").alias("b"))]
    options += [F.struct(F.lit(f"guarded_f1_{g:.1f}").alias("strategy"), F.lit(g).alias("bound"), F.col("by_f1").alias("b")) for g in guards]
    chosen = per_doc.select("now", F.explode(F.array(*options)).alias("o")).select("now", "o.strategy", "o.bound", "o.b.*")
    held = F.col("prior_f1") < F.col("bound")
    chosen = chosen.withColumn("after", F.when(held, F.col("now")).otherwise(F.col("gt"))).withColumn("takeover", ~held & ~F.col("selected") & (F.col("bound") >= 0))
    return chosen.groupBy("strategy").agg(
        F.count_if(F.col("after") > F.col("now")).alias("improves"), F.count_if(F.col("after") < F.col("now")).alias("regresses"),
        F.count_if(F.col("after") == F.col("now")).alias("unchanged"), F.count_if("takeover").alias("takeovers"),
    )


def simple_compare(exp: DataFrame, pred: DataFrame, tolerance: float = 0.01, containment: bool = False) -> DataFrame:
    """(doc, name, state) of products by name alone, whatever the period: 'match', 'wrong', 'missing', 'extra'.

    Of several rows of a name the last by id counts. Amounts agree within ``tolerance``; two nulls agree. With
    ``containment`` a name without an equal one may stand for a name that contains it or that it contains, the
    longest first. Rows: doc, id, name, amount; an empty name is none.
    """
    last = lambda df: df.where(F.length("name") > 0).groupBy("doc", "name").agg(F.max_by("amount", "id").alias("amount"), F.max("id").alias("id"))
    a, b = last(exp), last(pred)
    pairs = a.select("doc", "name", F.col("id").alias("exp_id")).join(b.select("doc", "name", F.col("id").alias("pred_id")), ["doc", "name"]).select("exp_id", "pred_id")
    if containment:
        rest = lambda df, side: df.join(pairs, df["id"] == pairs[side], "left_anti").withColumn("start_date", F.lit("")).withColumn("end_date", F.lit(""))
        pairs = pairs.union(greedy_pairs(contained_names(rest(a, "exp_id"), rest(b, "pred_id"))))
    left = a.select("doc", "name", F.col("amount").alias("x"), F.col("id").alias("exp_id")).join(pairs, "exp_id", "left")
    left = left.join(b.select(F.col("id").alias("pred_id"), F.col("amount").alias("y")), "pred_id", "left")
    agrees = (F.abs(F.col("x") - F.col("y")) <= tolerance) | (F.col("x").isNull() & F.col("y").isNull())
    state = F.when(F.col("pred_id").isNull(), "missing").when(F.coalesce(agrees, F.lit(False)), "match").otherwise("wrong")
    extra = b.join(pairs.select(F.col("pred_id").alias("id")), "id", "left_anti").select("doc", "name", F.lit("extra").alias("state"))
    return left.select("doc", "name", state.alias("state")).unionByName(extra)


def compare_products(exp: DataFrame, pred: DataFrame, amounts: list[str], tolerance: float = 0.01) -> DataFrame:
    """(doc, name, state, near, bad_…) of products by name alone, whatever the period, on several amounts.

    Of several rows of a name the last by id counts, in the place of the first. An expected name without an equal
    one is given the first predicted name that contains it or that it contains; ``near`` is that name, and a
    predicted name may serve several. An amount is bad when it is expected and the other is null or further away
    than ``tolerance``; an expected amount of up to 0.01 is bad only against a null. Predicted names that serve
    none are 'extra'. Rows: doc, id, name and the amounts; an empty name is none.
    """
    last = lambda df: df.where(F.length("name") > 0).groupBy("doc", "name").agg(*[F.max_by(a, "id").alias(a) for a in amounts], F.min("id").alias("id"))
    a, b = last(exp), last(pred)
    equal = a.select("doc", "name", F.col("id").alias("exp_id")).join(b.select("doc", "name", F.col("id").alias("pred_id")), ["doc", "name"]).select("exp_id", "pred_id")
    at = lambda df: df.select("doc", F.lit("").alias("start_date"), F.lit("").alias("end_date"), "name", "id")
    left = a.join(equal, a["id"] == equal["exp_id"], "left_anti")
    near = contained_names(at(left), at(b)).groupBy("exp_id").agg(F.min("pred_id").alias("pred_id"))
    pairs = equal.withColumn("by", F.lit("equal")).unionByName(near.withColumn("by", F.lit("near")))
    e = a.select("doc", "name", F.col("id").alias("exp_id"), *[F.col(x).alias(f"e_{x}") for x in amounts]).join(pairs, "exp_id", "left")
    e = e.join(b.select(F.col("id").alias("pred_id"), F.col("name").alias("p_name"), *[F.col(x).alias(f"p_{x}") for x in amounts]), "pred_id", "left")
    off = lambda x, y: F.coalesce(x.isNotNull() & (y.isNull() | ((F.abs(x - y) > tolerance) & (F.abs(x) > 0.01))), F.lit(False))
    bad = {x: F.col("pred_id").isNotNull() & off(F.col(f"e_{x}"), F.col(f"p_{x}")) for x in amounts}
    e = e.select("doc", "name", "pred_id", F.when(F.col("by") == "near", F.col("p_name")).alias("near"), *[w.alias(f"bad_{x}") for x, w in bad.items()])
    wrong = F.greatest(*[F.col(f"bad_{x}").cast("int") for x in amounts]) == 1
    state = F.when(F.col("pred_id").isNull(), "missing").when(wrong, "wrong").otherwise("match")
    out = e.select("doc", "name", state.alias("state"), "near", *[f"bad_{x}" for x in amounts])
    extra = b.join(pairs.select(F.col("pred_id").alias("id")), "id", "left_anti")
    return out.unionByName(extra.select("doc", "name", F.lit("extra").alias("state"), F.lit(None).cast("string").alias("near"), *[F.lit(False).alias(f"bad_{x}") for x in amounts]))


def continuity(prior: DataFrame, now: DataFrame) -> DataFrame:
    """One row on how stable the names of documents are from one side to the other.

    Both sides: doc, name (normalised, empty and totals left out), currency, unit, month_day. Documents on
    both sides count. Values that are equally common go to the smallest.
    """
    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.groupBy("doc").agg(
            F.countDistinct("name").alias(f"{tag}_n"), *[F.mode(F.nullif(F.trim(c), F.lit("")), deterministic=True).alias(f"{tag}_{c}") for c in ("currency", "unit", "month_day")],
        )

    names = lambda df: df.where(F.length("name") > 0).select("doc", "name").distinct()
    common = names(prior).join(names(now), ["doc", "name"]).groupBy("doc").agg(F.count("*").alias("common"))
    both = side(prior.where(F.length("name") > 0), "a").join(side(now.where(F.length("name") > 0), "b"), "doc").join(common, "doc", "left").fillna(0, ["common"])
    same = lambda c: F.count_if(F.coalesce(F.col(f"a_{c}"), F.lit("")) == F.coalesce(F.col(f"b_{c}"), F.lit(""))).alias(f"{c}_stable")
    return both.agg(
        F.count("*").alias("documents"), F.coalesce(F.sum("a_n"), F.lit(0)).alias("prior_names"), F.coalesce(F.sum("b_n"), F.lit(0)).alias("names"), F.coalesce(F.sum("common"), F.lit(0)).alias("common_names"),
        F.count_if((F.col("common") == F.col("a_n")) & (F.col("common") == F.col("b_n"))).alias("same_sets"), F.count_if(F.col("a_n") == F.col("b_n")).alias("same_counts"),
        F.count_if(F.col("common") < F.col("b_n")).alias("with_additions"), F.count_if(F.col("common") < F.col("a_n")).alias("with_removals"), same("currency"), same("unit"),
        F.count_if(F.col("a_month_day").isNotNull() & (F.col("a_month_day") == F.col("b_month_day"))).alias("month_day_stable"),
    )


def _identities(rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, names): the distinct names, null and empty ones left out; a key with none has an empty array."""
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_set(F.nullif(F.col("name"), F.lit("")))).alias("names"))


def continuity_matched(prior: DataFrame, now: DataFrame, threshold: float = 0.7) -> DataFrame:
    """One row on how stable documents are from one side to the other, names matched by likeness.

    Both sides: doc, at (order of rows), name (normalised; null or empty where a row names no product),
    currency, unit, month_day. All documents on both sides count, named products or not. Of values equally
    common the first counts.
    """
    values = ("currency", "unit", "month_day")

    def side(df: DataFrame, tag: str) -> DataFrame:
        out = _identities(df, "doc").withColumnRenamed("names", tag)
        for c in values:
            counts = df.where(F.col(c).cast("string") != "").groupBy("doc", c).agg(F.count("*").alias("n"), F.min("at").alias("at"))
            out = out.join(counts.groupBy("doc").agg(F.max_by(c, F.struct("n", -F.col("at"))).alias(f"{tag}_{c}")), "doc", "left")
        return out

    both = side(prior, "a").join(side(now, "b"), "doc")
    both = both.withColumn("matched", matched_names(F.col("b"), F.col("a"), threshold)).withColumn("n_a", F.size("a").cast("long")).withColumn("n_b", F.size("b").cast("long"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    whole = F.col("matched") == F.col("n_b")
    return both.agg(
        F.count("*").alias("documents"), total("n_a").alias("prior_names"), total("n_b").alias("names"), F.count_if(F.col("a") == F.col("b")).alias("same_sets"), F.count_if(F.col("n_a") == F.col("n_b")).alias("same_counts"),
        total("matched").alias("matched_names"), F.round(_ratio(total("matched"), total("n_b")), 6).alias("identity_recall"), F.count_if(whole).alias("all_matched"), F.count_if(whole & (F.col("n_a") == F.col("n_b"))).alias("bijections"),
        F.count_if(F.col("matched") < F.col("n_b")).alias("with_additions"), F.count_if(F.col("matched") < F.col("n_a")).alias("with_removals"),
        *[F.count_if(F.coalesce(F.col(f"a_{c}"), F.lit("")) == F.coalesce(F.col(f"b_{c}"), F.lit(""))).alias(f"{c}_stable") for c in ("currency", "unit")], F.count_if(F.col("a_month_day") == F.col("b_month_day")).alias("month_day_stable"),
    )


def matched_candidates(rows: DataFrame, prior: DataFrame, truth: DataFrame, selected: str, threshold: float = 0.7) -> DataFrame:
    """The candidates of ``strategy_choices`` from names (doc, source, name) matched by likeness.

    A document counts when prior, truth and at least two different candidates name products. Of sources with
    equal names one counts: the selected, else the first. ``source`` is the rank from the last, so that the
    greatest is the first.
    """
    c = _identities(rows, "doc", "source").where(F.size("names") > 0)
    first = F.min(F.struct((F.col("source") != selected).alias("other"), "source")).alias("s")
    c = c.groupBy("doc", "names").agg(first).select("doc", "names", "s.source", (~F.col("s.other")).alias("selected"))
    named = lambda df, tag: _identities(df, "doc").where(F.size("names") > 0).withColumnRenamed("names", tag)
    c = c.join(named(prior, "p"), "doc").join(named(truth, "g"), "doc")
    w = Window.partitionBy("doc")
    c = c.withColumn("n", F.count("*").over(w)).withColumn("source", -F.row_number().over(w.orderBy("source"))).where("n > 1")
    size = lambda x: F.size(x).cast("long")
    return c.select("doc", "source", "selected", size("names").alias("n_names"), size("p").alias("n_prior"), size("g").alias("n_gt"), matched_names(F.col("p"), F.col("names"), threshold).alias("matched_prior"), matched_names(F.col("g"), F.col("names"), threshold).alias("matched_gt"))


def conflicts(candidates: DataFrame, doc: str) -> DataFrame:
    """One row on the documents with several candidates, the best by recall of prior names taken together.

    Counted are documents whose selected candidate is the truth, those where one of the best is, and those
    where the best of these covers more or less of the truth than the selected.
    """
    truth = (F.col("matched_gt") == F.col("n_gt")) & (F.col("n_gt") == F.col("n_names"))
    c = candidates.select(doc, "selected", _ratio(F.col("matched_prior"), F.col("n_prior")).alias("recall"), _ratio(F.col("matched_gt"), F.col("n_gt")).alias("gt"), truth.alias("truth"))
    c = c.withColumn("top", F.col("recall") == F.max("recall").over(Window.partitionBy(doc)))
    d = c.groupBy(doc).agg(
        F.coalesce(F.max(F.when(F.col("selected"), F.col("gt"))), F.lit(0.0)).alias("now"), F.max(F.when(F.col("top"), F.col("gt"))).alias("best"), F.max(F.col("selected") & F.col("truth")).alias("selected_true"), F.max(F.col("top") & F.col("truth")).alias("top_true"),
    )
    return d.agg(F.count("*").alias("documents"), F.count_if("selected_true").alias("selected_true"), F.count_if("top_true").alias("top_true"), F.count_if(F.col("best") > F.col("now")).alias("improves"), F.count_if(F.col("best") < F.col("now")).alias("regresses"))
