"""Queries of linkage, quality and facts, comparing what two source systems delivered, with their reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import numbers as n
from ..functions import periods as p
from ..functions import text as t
from ..operators import facts as fa
from ..operators import linkage as li
from ..operators import quality as qu
from ..operators import records as rc
from ..sources.tables import shared_dir, table
from . import scalars as sc

FIELDS = ("currency", "mbrevenue", "mbcost", "gross_profit", "unit")
EXPECTED, PREDICTED = "HKF", "SHD"


def _rows(spark: SparkSession, data_dir: str, source: str) -> DataFrame:
    """Rows of one source in the form that linkage wants."""
    flat = table(spark, data_dir, "flat_export").where((F.col("source_code") == source) & (F.trim("infocode") != ""))
    anchored = F.coalesce(*[n.to_double(F.col(f)) for f in ("mbrevenue", "mbcost", "gross_profit")]).isNotNull()
    day = lambda c: F.coalesce(p.business_date(F.col(c)).cast("string"), F.lit(""))
    return flat.select(
        F.col("row_id").alias("id"), F.col("infocode").alias("doc"), day("startdate").alias("start_date"), day("reportdate").alias("end_date"), F.coalesce(t.match_key(F.col("productname")), F.lit("")).alias("name"), F.coalesce(t.squeeze(F.col("productname")), F.lit("")).alias("product"),
        anchored.alias("anchored"), F.concat_ws("|", *[li.signature(F.col(f)) for f in FIELDS]).alias("values"), *FIELDS,
    )


def _sides(spark: SparkSession, data_dir: str, expected: str = EXPECTED, predicted: str = PREDICTED) -> tuple[DataFrame, DataFrame]:
    """The rows of two sources; which, is up to the caller."""
    return _rows(spark, data_dir, expected), _rows(spark, data_dir, predicted)


def _kept_sides(spark: SparkSession, data_dir: str, **sides: str) -> tuple[DataFrame, DataFrame]:
    """Both sides, kept for the many steps that use them."""
    shared_dir(spark)
    exp, pred = _sides(spark, data_dir, **sides)
    return exp.checkpoint(), pred.checkpoint()


def signatures(spark: SparkSession, data_dir: str) -> DataFrame:
    """X22 of all value fields of the whole flat export."""
    return table(spark, data_dir, "flat_export").select("row_id", *[li.signature(F.col(f)).alias(f) for f in FIELDS])


def pairs_exact(spark: SparkSession, data_dir: str, **sides: str) -> DataFrame:
    """Rows paired by name, the rest by values."""
    return li.pair_rows(*_sides(spark, data_dir, **sides), containment=False)


def pairs(spark: SparkSession, data_dir: str, **sides: str) -> DataFrame:
    """J10 with J11: also by names that contain each other, greedily."""
    return li.pair_rows(*_sides(spark, data_dir, **sides))


def _unpaired(exp: DataFrame, pred: DataFrame, made: DataFrame) -> DataFrame:
    missing = exp.join(made, exp["id"] == made["exp_id"], "left_anti").select(F.lit("missing").alias("kind"), "id")
    return missing.union(pred.join(made, pred["id"] == made["pred_id"], "left_anti").select(F.lit("extra").alias("kind"), "id"))


def unpaired(spark: SparkSession, data_dir: str, **sides: str) -> DataFrame:
    """J13 after pairs by equal names and values only: expected rows without a predicted one and the other way round."""
    exp, pred = _sides(spark, data_dir, **sides)
    return _unpaired(exp, pred, li.pair_rows(exp, pred, containment=False))


def compare_docs(spark: SparkSession, data_dir: str, **sides: str) -> DataFrame:
    """A11, J15 on equal names only: quality of each document."""
    exp, pred = _sides(spark, data_dir, **sides)
    return qu.compare_documents(exp, pred, li.pair_rows(exp, pred, containment=False), list(FIELDS))


def compare_corpus(spark: SparkSession, data_dir: str, **sides: str) -> DataFrame:
    """A12 on equal names only: quality over all documents."""
    return qu.corpus_quality(compare_docs(spark, data_dir, **sides))


def compare_fields(spark: SparkSession, data_dir: str, **sides: str) -> DataFrame:
    """A12 on equal names only: agreement by field."""
    return qu.field_quality(compare_docs(spark, data_dir, **sides), list(FIELDS))


def unpaired_contained(spark: SparkSession, data_dir: str, **sides: str) -> DataFrame:
    """J13 after J10 to J12: expected rows without a predicted one and the other way round."""
    exp, pred = _kept_sides(spark, data_dir, **sides)
    return _unpaired(exp, pred, li.pair_rows(exp, pred))


def compare_docs_contained(spark: SparkSession, data_dir: str, **sides: str) -> DataFrame:
    """A11, J15 after J10 to J12: quality of each document, names that contain each other counting as one product."""
    exp, pred = _kept_sides(spark, data_dir, **sides)
    # several steps use the pairs
    return qu.compare_documents(exp, pred, li.pair_rows(exp, pred).checkpoint(), list(FIELDS), containment=True)


def compare_corpus_contained(spark: SparkSession, data_dir: str, **sides: str) -> DataFrame:
    """A12 after J10 to J12: quality over all documents."""
    return qu.corpus_quality(compare_docs_contained(spark, data_dir, **sides))


def compare_fields_contained(spark: SparkSession, data_dir: str, **sides: str) -> DataFrame:
    """A12 after J10 to J12: agreement by field."""
    return qu.field_quality(compare_docs_contained(spark, data_dir, **sides), list(FIELDS))


def _backtest(spark: SparkSession, data_dir: str) -> DataFrame:
    """Records read from the lines of all filings against all rows that any source delivered for them."""
    lines, flat = table(spark, data_dir, "doc_lines"), table(spark, data_dir, "flat_export").where(F.trim("infocode") != "")
    shared_dir(spark)
    done = rc.extract(lines, flat.select("infocode", "productname", "mbcost", "gross_profit"))
    day = lambda c: F.coalesce(p.business_date(F.col(c)).cast("string"), F.lit(""))
    low = {f: F.nullif(F.col(f.upper()), F.lit("")).alias(f) for f in FIELDS}
    read = done.records.select("doc", F.col("PRODUCTNAME").alias("productname"), F.col("STARTDATE").alias("startdate"), F.col("REPORTDATE").alias("reportdate"), *low.values())
    # the same record from several sources, or twice from one, is expected once
    one = lambda df: df.select("doc", day("startdate").alias("start_date"), day("reportdate").alias("end_date"), F.coalesce(t.match_key(F.col("productname")), F.lit("")).alias("name"), F.coalesce(t.squeeze(F.col("productname")), F.lit("")).alias("product"), *FIELDS).distinct()
    anchored = F.coalesce(*[n.to_double(F.col(f)) for f in ("mbrevenue", "mbcost", "gross_profit")]).isNotNull()
    side = lambda df: one(df).withColumn("id", F.struct("doc", "name", "start_date", "end_date", "product", *FIELDS)).withColumn("anchored", anchored).withColumn("values", F.concat_ws("|", *[li.signature(F.col(f)) for f in FIELDS]))
    with_lines = lines.where("infocode is not null").select(F.col("infocode").alias("doc")).distinct()
    exp = side(flat.withColumnRenamed("infocode", "doc").join(with_lines, "doc", "left_semi")).checkpoint()
    pred = side(read).checkpoint()
    covered = li.multiset_covered(exp, pred, "doc", ["mbrevenue", "mbcost", "gross_profit"])
    totals = fa.sums_against_totals(done.facts.withColumn("kind", F.when(F.col("is_total"), "final")), ["doc", "start_date", "end_date"]).groupBy("doc").agg(F.min(F.coalesce("agrees", F.lit(True))).alias("totals_agree"))
    runs = rc.outcomes(lines, done).join(covered, "doc", "left").join(totals, "doc", "left").checkpoint()
    return qu.compare_documents(exp, pred, li.pair_rows(exp, pred).checkpoint(), list(FIELDS), containment=True, runs=runs)


def backtest_docs(spark: SparkSession, data_dir: str) -> DataFrame:
    """What the extraction of each filing read against what is expected of it."""
    return _backtest(spark, data_dir)


def backtest_corpus(spark: SparkSession, data_dir: str) -> DataFrame:
    """Quality of the extraction over all filings, with kinds of problems."""
    return qu.corpus_quality(_backtest(spark, data_dir))


def backtest_causes(spark: SparkSession, data_dir: str) -> DataFrame:
    """Root causes and stages over all filings."""
    return qu.causes(_backtest(spark, data_dir))


def amounts_covered(spark: SparkSession, data_dir: str, **sides: str) -> DataFrame:
    """Documents whose expected amounts are all among the predicted."""
    exp, pred = _sides(spark, data_dir, **sides)
    return li.multiset_covered(exp, pred, "doc", ["mbrevenue", "mbcost", "gross_profit"])


def values_located(spark: SparkSession, data_dir: str) -> DataFrame:
    """Amounts of the flat export found in the lines of their filing."""
    flat = table(spark, data_dir, "flat_export").where(F.trim("infocode") != "")
    values = flat.select("infocode", F.col("row_id").alias("value_id"), n.number_variants(n.to_double(F.col("mbrevenue"))).alias("forms"))
    lines = table(spark, data_dir, "doc_lines").where("infocode is not null")
    return qu.values_located(values, qu.number_tokens(lines, "infocode"), "infocode")


def dominant_currency(spark: SparkSession, data_dir: str) -> DataFrame:
    """The commonest currency text of each filing."""
    return qu.dominant(table(spark, data_dir, "flat_export").where("infocode is not null"), "infocode", "currency", "row_id")


def matching_sizes(spark: SparkSession, data_dir: str) -> DataFrame:
    """How many names of one source have a partner among another's, by largest matching."""
    names = table(spark, data_dir, "flat_export").where(F.trim("infocode") != "").select("infocode", "source_code", t.strong_name(F.col("productname")).alias("name"))
    return li.matching_sizes(names.where(F.col("source_code") == EXPECTED), names.where(F.col("source_code") == PREDICTED), "infocode", "name")


def strategies(spark: SparkSession, data_dir: str) -> DataFrame:
    """A16, C10 on equal names only: which source's names would stand for a filing, by agreement with a prior source's."""
    names = table(spark, data_dir, "flat_export").where(F.trim("infocode") != "").select(F.col("infocode").alias("doc"), F.col("source_code").alias("source"), t.name_key(F.col("productname")).alias("name")).where(F.length("name") > 0).distinct()
    of = lambda s, c: names.where(F.col("source") == s).select("doc", "name").withColumn(c, F.lit(1))
    count = lambda s, c: names.where(F.col("source") == s).groupBy("doc").agg(F.count("*").alias(c))
    c = names.join(of(EXPECTED, "prior"), ["doc", "name"], "left").join(of(PREDICTED, "gt"), ["doc", "name"], "left")
    c = c.groupBy("doc", "source").agg(F.count("*").alias("n_names"), F.count("prior").alias("matched_prior"), F.count("gt").alias("matched_gt"))
    c = c.join(count(EXPECTED, "n_prior"), "doc").join(count(PREDICTED, "n_gt"), "doc").withColumn("selected", F.col("source") == "LDN")
    return qu.strategy_choices(c, "doc")


def _facts(spark: SparkSession, data_dir: str) -> DataFrame:
    flat = table(spark, data_dir, "flat_export").where(F.trim("infocode") != "")
    kind = t.label_kind(F.col("productname"))
    return flat.select(
        F.col("infocode").alias("doc"), "source_code", F.col("row_id").alias("fact_no"), F.coalesce("productname", F.lit("")).alias("name"), kind.alias("kind"), F.trim("productname").isin("合计", "合計").alias("is_total"), F.lit("MBREVENUE").alias("metric"),
        n.to_double(F.col("mbrevenue")).alias("amount"), p.business_date(F.col("startdate")).alias("start_date"), p.business_date(F.col("reportdate")).alias("end_date"), "currency", "unit", "mbcost", "gross_profit",
    ).where("amount is not null and start_date is not null and end_date is not null")


def sums_totals(spark: SparkSession, data_dir: str) -> DataFrame:
    """A4, A5: sums of products against stated totals, by filing, source and period."""
    return fa.sums_against_totals(_facts(spark, data_dir), ["doc", "source_code", "start_date", "end_date"])


def first_facts(spark: SparkSession, data_dir: str) -> DataFrame:
    """The first delivered fact of each product and period of a filing."""
    f = _facts(spark, data_dir).select("doc", t.name_key(F.col("name")).alias("name_key"), "start_date", "end_date", "fact_no", "source_code", "amount")
    return fa.first_facts(f, ["doc", "name_key", "start_date", "end_date"], ["fact_no"])


def merged_tables(spark: SparkSession, data_dir: str) -> DataFrame:
    """The facts of all sources, each a table in the order of codes, merged under the guards."""
    order = table(spark, data_dir, "source_systems").select("source_code", F.row_number().over(Window.orderBy("source_code")).alias("table_no"))  # a dozen rows
    f = _facts(spark, data_dir).join(F.broadcast(order), "source_code").withColumn("is_total", F.coalesce("is_total", F.lit(False)))
    return fa.merge_tables(f.select("doc", "table_no", "fact_no", "name", "is_total", "start_date", "end_date", "metric", "amount"))


def records(spark: SparkSession, data_dir: str) -> DataFrame:
    """Final records of one source with the metrics of another."""
    f = _facts(spark, data_dir)
    revenue = f.where(F.col("source_code") == EXPECTED).select("doc", "fact_no", "name", "start_date", "end_date", "currency", "unit", "amount")
    other = f.where(F.col("source_code") == PREDICTED)
    metric = lambda c, k: other.select("doc", "fact_no", "name", "start_date", "end_date", F.lit(k).alias("metric"), n.to_double(F.col(c)).alias("amount")).where("amount is not null")
    return fa.records(fa.with_metrics(revenue, metric("mbcost", "MBCOST").union(metric("gross_profit", "GROSS_PROFIT"))))


def enriched(spark: SparkSession, data_dir: str) -> DataFrame:
    """Costs of one source given the periods of another's revenue by product and year."""
    f = _facts(spark, data_dir)
    costs = f.where(F.col("source_code") == PREDICTED).select("doc", "name", F.year("end_date").alias("year"), F.lit("MBCOST").alias("metric"), n.to_double(F.col("mbcost")).alias("amount"), F.col("fact_no").alias("table_no")).where("amount is not null")
    return fa.enrich_by_year(f.where(F.col("source_code") == EXPECTED), costs)


def prior_context(spark: SparkSession, data_dir: str) -> DataFrame:
    """A2, A3: what earlier rows of a filing say about names, metrics and fiscal year."""
    return fa.prior_context(table(spark, data_dir, "flat_export").where(F.trim("infocode") != ""), "infocode")


def simple_compare(spark: SparkSession, data_dir: str) -> DataFrame:
    """J16 on equal names and revenue only: products of two sources compared by name alone."""
    side = lambda source: _rows(spark, data_dir, source).select("doc", "id", "name", n.to_double(F.col("mbrevenue")).alias("amount"))
    return qu.simple_compare(side(EXPECTED), side(PREDICTED))


def simple_compare_contained(spark: SparkSession, data_dir: str) -> DataFrame:
    """Products of two sources compared by name alone, else by contained names, on revenue, cost and gross profit."""
    amounts = ("mbrevenue", "mbcost", "gross_profit")
    flat = table(spark, data_dir, "flat_export").where(F.trim("infocode") != "")
    rows = flat.select("source_code", F.col("infocode").alias("doc"), F.col("row_id").alias("id"), F.coalesce(t.name_key(F.col("productname")), F.lit("")).alias("name"), *[n.to_double(F.col(a)).alias(a) for a in amounts])
    exp = rows.where((F.col("source_code") == EXPECTED) & ~F.col("name").isin("合计", "合計"))
    return qu.compare_products(exp, rows.where(F.col("source_code") == PREDICTED), list(amounts))


def continuity(spark: SparkSession, data_dir: str) -> DataFrame:
    """A15, A23, J17 on equal names and month-days as written: how stable two sources are."""
    flat = table(spark, data_dir, "flat_export").where(F.trim("infocode") != "")
    month_day = F.nullif(F.regexp_extract("reportdate", r"\d{4}[-/](\d{1,2}[-/]\d{1,2})", 1), F.lit(""))
    rows = flat.select("source_code", F.col("infocode").alias("doc"), t.strong_name(F.col("productname")).alias("name"), "currency", "unit", month_day.alias("month_day")).where(~F.col("name").isin("合计", "合計", "总计", "總計", "总额", "總額", "total"))
    return qu.continuity(rows.where(F.col("source_code") == EXPECTED), rows.where(F.col("source_code") == PREDICTED))


TOTAL_NAMES = ("合计", "合計", "总计", "總計", "总额", "總額", "total")


def _identity_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    """Rows of the flat export with their normalised name, null for totals, and the local month and day as a number."""
    name = t.strong_name(F.col("productname"))
    day = F.when(F.col("reportdate").rlike(r"^\S*T\S*$"), p.business_date(F.col("reportdate"), "+08:00"))
    written = lambda k: F.nullif(F.regexp_extract("reportdate", r"\d{4}[-/](\d{1,2})[-/](\d{1,2})", k), F.lit("")).cast("int")
    month_day = F.coalesce(F.month(day) * 100 + F.dayofmonth(day), written(1) * 100 + written(2))
    flat = table(spark, data_dir, "flat_export").where(F.trim("infocode") != "")
    return flat.select("source_code", F.col("source_code").alias("source"), F.col("infocode").alias("doc"), F.col("row_id").alias("at"), F.when(~name.isin(*TOTAL_NAMES), name).alias("name"), "currency", "unit", month_day.alias("month_day"))


def continuity_matched(spark: SparkSession, data_dir: str) -> DataFrame:
    """How stable names, currencies, units and local fiscal days are between two sources."""
    rows = _identity_rows(spark, data_dir)
    return qu.continuity_matched(rows.where(F.col("source_code") == EXPECTED), rows.where(F.col("source_code") == PREDICTED))


def _candidates(spark: SparkSession, data_dir: str) -> DataFrame:
    rows = _identity_rows(spark, data_dir).select("doc", "source", "name")
    return qu.matched_candidates(rows, rows.where(F.col("source") == EXPECTED), rows.where(F.col("source") == PREDICTED), "LDN")


def strategies_matched(spark: SparkSession, data_dir: str) -> DataFrame:
    """Which source's names would stand for a filing, by likeness to a prior source's."""
    return qu.strategy_choices(_candidates(spark, data_dir), "doc")


def conflicts_matched(spark: SparkSession, data_dir: str) -> DataFrame:
    """Filings that several sources name differently, and how the likest to the prior source do."""
    return qu.conflicts(_candidates(spark, data_dir), "doc")


def first_per_product(spark: SparkSession, data_dir: str) -> DataFrame:
    """The first row of each product of a filing."""
    f = table(spark, data_dir, "flat_export").where(F.trim("infocode") != "").select("infocode", t.name_key(F.col("productname")).alias("name_key"), "row_id", "mbrevenue").where(F.length("name_key") > 0)
    return fa.first_facts(f, ["infocode", "name_key"], ["row_id"])


QUERIES = {
    "c_simple_compare": simple_compare, "c_continuity": continuity, "c_first_per_product": first_per_product,
    "c_signatures": signatures, "c_pairs_exact": pairs_exact, "c_pairs": pairs, "c_unpaired": unpaired, "c_compare_docs": compare_docs, "c_compare_corpus": compare_corpus, "c_compare_fields": compare_fields,
    "c_backtest_docs": backtest_docs, "c_backtest_corpus": backtest_corpus, "c_backtest_causes": backtest_causes, "c_unpaired_contained": unpaired_contained, "c_compare_docs_contained": compare_docs_contained, "c_compare_corpus_contained": compare_corpus_contained, "c_compare_fields_contained": compare_fields_contained,
    "c_simple_compare_contained": simple_compare_contained, "c_continuity_matched": continuity_matched, "c_strategies_matched": strategies_matched, "c_conflicts_matched": conflicts_matched,
    "c_amounts_covered": amounts_covered, "c_values_located": values_located, "c_dominant_currency": dominant_currency, "c_matching_sizes": matching_sizes, "c_strategies": strategies,
    "f_sums_totals": sums_totals, "f_first_facts": first_facts, "f_merged_tables": merged_tables, "f_records": records, "f_enriched": enriched, "f_prior_context": prior_context,
}


def _strip(c: str) -> str:
    return sc._fill(sc._STRIP, c)


def _squeeze(c: str) -> str:
    return sc._fill(sc._SQUEEZE, c)


def _double(c: str) -> str:
    s = f"replace({_strip(c)}, ',', '')"
    return f"CASE WHEN regexp_matches({s}, {sc._PLAIN}) THEN try_cast({s} AS double) END"


def _sig(c: str) -> str:
    d = _double(c)
    return f"CASE WHEN {d} IS NOT NULL THEN 'n:' || cast(cast(round_even({d} / 1e-4, 0) AS decimal(38, 0)) AS varchar) WHEN coalesce({_squeeze(c)}, '') = '' THEN 'e' ELSE 's:' || {_squeeze(c)} END"


def _day(c: str) -> str:
    s = _strip(c)
    return rf"""coalesce(try_cast(nullif(regexp_extract({s}, '^(\d{{4}}-\d{{2}}-\d{{2}})$', 1), '') AS date),
    try_cast(nullif(regexp_extract({s}, '^(\d{{4}}-\d{{2}}-\d{{2}})[T ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d{{1,9}})?)?$', 1), '') AS date),
    CASE WHEN regexp_matches({s}, {sc._ZONED}) THEN cast(try_cast(regexp_extract({s}, '^(.*?)(Z|[+-]\d{{2}}:?\d{{2}})$', 1) AS timestamp) + INTERVAL 8 HOUR
      - to_minutes(CASE WHEN {s} LIKE '%Z' THEN 0 ELSE (cast(regexp_extract({s}, '(\d{{2}}):?\d{{2}}$', 1) AS int) * 60 + cast({s}[-2:] AS int)) * CASE WHEN regexp_matches({s}, '-\d{{2}}:?\d{{2}}$') THEN -1 ELSE 1 END END) AS date) END)"""


_NAME = rf"coalesce(regexp_replace(regexp_replace(regexp_replace({_squeeze('productname')}, '[—–−－]', '-', 'g'), '^-+', ''), '\s+', '', 'g'), '')"
_VALUES = " || '|' || ".join(_sig(f) for f in FIELDS)


def _side(source: str) -> str:
    return f"""(SELECT row_id AS id, infocode AS doc, coalesce(cast({_day("startdate")} AS varchar), '') AS s, coalesce(cast({_day("reportdate")} AS varchar), '') AS e, {_NAME} AS name,
    coalesce({", ".join(_double(f) for f in ("mbrevenue", "mbcost", "gross_profit"))}) IS NOT NULL AS anchored, {_VALUES} AS vals, {", ".join(FIELDS)}
  FROM flat_export WHERE source_code = '{source}' AND trim(infocode) <> '')"""


_PAIRED = f"""
exp AS {_side(EXPECTED)}, pred AS {_side(PREDICTED)},
named AS (SELECT a.id AS exp_id, b.id AS pred_id FROM (SELECT *, row_number() OVER (PARTITION BY doc, s, e, name ORDER BY id) AS rn FROM exp) a
  JOIN (SELECT *, row_number() OVER (PARTITION BY doc, s, e, name ORDER BY id) AS rn FROM pred) b USING (doc, s, e, name, rn)),
pairs AS (SELECT exp_id, pred_id, 'name' AS how FROM named UNION ALL
  SELECT a.id, b.id, 'values' FROM (SELECT *, row_number() OVER (PARTITION BY doc, s, e, vals ORDER BY id) AS rn FROM exp WHERE anchored AND id NOT IN (SELECT exp_id FROM named)) a
  JOIN (SELECT *, row_number() OVER (PARTITION BY doc, s, e, vals ORDER BY id) AS rn FROM pred WHERE anchored AND id NOT IN (SELECT pred_id FROM named)) b USING (doc, s, e, vals, rn))"""
_BAD = ", ".join(f"CASE WHEN x.{f} IS NOT NULL AND {_sig('x.' + f)} <> {_sig('y.' + f)} THEN 1 ELSE 0 END AS bad_{f}" for f in FIELDS)
_ANY_BAD = " + ".join(f"bad_{f}" for f in FIELDS)
_DOCS = f"""{_PAIRED},
diffs AS (SELECT x.doc, {_BAD} FROM pairs JOIN exp x ON x.id = exp_id JOIN pred y ON y.id = pred_id),
paired AS (SELECT doc, count(*) FILTER ({_ANY_BAD} = 0) AS matched, count(*) FILTER ({_ANY_BAD} > 0) AS wrong, {", ".join(f"sum(bad_{f}) AS bad_{f}" for f in FIELDS)} FROM diffs GROUP BY doc),
missing AS (SELECT doc, count(*) AS missing FROM exp WHERE id NOT IN (SELECT exp_id FROM pairs) GROUP BY doc),
extras AS (SELECT * FROM pred WHERE id NOT IN (SELECT pred_id FROM pairs)),
extra AS (SELECT doc, count(*) AS extra FROM extras GROUP BY doc),
forgiven AS (SELECT doc, count(*) AS forgiven FROM extras WHERE name <> '' AND (doc, name) IN (SELECT doc, name FROM exp) AND (doc, name, s, e) NOT IN (SELECT doc, name, s, e FROM exp) GROUP BY doc),
joined AS (SELECT doc, coalesce(expected, 0) AS expected, coalesce(predicted, 0) AS predicted, coalesce(matched, 0) AS matched, coalesce(wrong, 0) AS wrong, {", ".join(f"cast(coalesce(bad_{f}, 0) AS bigint) AS bad_{f}" for f in FIELDS)},
    coalesce(missing, 0) AS missing, coalesce(extra, 0) - coalesce(forgiven, 0) AS extra, coalesce(forgiven, 0) AS forgiven
  FROM (SELECT doc, count(*) AS expected FROM exp GROUP BY doc) FULL JOIN (SELECT doc, count(*) AS predicted FROM pred GROUP BY doc) USING (doc)
  LEFT JOIN paired USING (doc) LEFT JOIN missing USING (doc) LEFT JOIN extra USING (doc) LEFT JOIN forgiven USING (doc)),
docs AS (SELECT *, round(CASE WHEN expected > 0 THEN matched / expected ELSE 0 END, 6) AS recall,
    round(CASE WHEN predicted - forgiven > 0 THEN matched / (predicted - forgiven) ELSE 0 END, 6) AS precision,
    round(CASE WHEN matched + wrong > 0 THEN matched / (matched + wrong) ELSE 0 END, 6) AS field_accuracy,
    round(matched / greatest(expected, predicted - forgiven, 1), 6) AS comprehensive_hit,
    CASE WHEN missing = 0 AND extra = 0 AND wrong = 0 THEN CASE WHEN forgiven = 0 THEN 'match' ELSE 'forgiven' END ELSE 'differs' END AS category FROM joined)"""
_FACTS = f"""(SELECT * FROM (SELECT infocode AS doc, source_code, row_id AS fact_no, coalesce(productname, '') AS name,
    CASE WHEN regexp_matches(coalesce(replace({sc._LABEL.replace("text", "productname")}, '凈', '淨'), ''), '{sc._any(t.SUBTOTALS)}') THEN 'subtotal' WHEN regexp_matches(coalesce(replace({sc._LABEL.replace("text", "productname")}, '凈', '淨'), ''), '{sc._any(t.FINAL_TOTALS)}') THEN 'final' END AS kind,
    'MBREVENUE' AS metric, {_double("mbrevenue")} AS amount, {_day("startdate")} AS start_date, {_day("reportdate")} AS end_date, currency, unit, mbcost, gross_profit FROM flat_export WHERE trim(infocode) <> '')
  WHERE amount IS NOT NULL AND start_date IS NOT NULL AND end_date IS NOT NULL)"""
_KEY = r"lower(regexp_replace(name, '\s+', '', 'g'))"
_TRIPLE = ("mbrevenue", "mbcost", "gross_profit")
_TRIPLE_SIG = " || '|' || ".join(_sig(f) for f in _TRIPLE)
_TRIPLE_WHOLE = " AND ".join(f"({_double(f)}) IS NOT NULL" for f in _TRIPLE)
_WRITTEN = sc._WRITTEN
_FORMS = "list_distinct(CASE WHEN v < 0 THEN [plain, grouped, '-' || plain, '-' || grouped, '(' || plain || ')', '(' || grouped || ')'] ELSE [plain, grouped] END)"

_STRONG = rf"""regexp_replace(regexp_replace(lower(translate({sc._fill(sc._NFKC, "productname")}, '{t.STRONG_FOLD[0]}', '{t.STRONG_FOLD[1]}')),
  '\([^)]*(附註|附注|note|[ivx\d]+)[^)]*\)|（[^）]*(附註|附注|note|[ivx\d]+)[^）]*）', '', 'g'), '[\s:：,，。;；、()（）\[\]【】/\\_\-–—]+', '', 'g')"""
_SIDE_NAMES = rf"""(SELECT infocode AS doc, {_STRONG} AS name, nullif(trim(currency, ' '), '') AS currency, nullif(trim(unit, ' '), '') AS unit, nullif(regexp_extract(reportdate, '\d{{4}}[-/](\d{{1,2}}[-/]\d{{1,2}})', 1), '') AS month_day
  FROM flat_export WHERE source_code = '{{0}}' AND trim(infocode) <> '' AND {_STRONG} NOT IN ('', '合计', '合計', '总计', '總計', '总额', '總額', 'total'))"""
_MODE = lambda c: f"(SELECT doc, {c} AS {c}_mode FROM (SELECT doc, {c}, count(*) AS k FROM {{0}} WHERE {c} IS NOT NULL GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY doc ORDER BY k DESC, {c}) = 1)"
_STABLE = lambda c: f"count(*) FILTER (coalesce(a.{c}_mode, '') = coalesce(b.{c}_mode, '')) AS {c}_stable"


def _continuity_side(source: str) -> str:
    rows = _SIDE_NAMES.replace("{0}", source)
    modes = " ".join(f"LEFT JOIN {_MODE(c).replace('{0}', rows)} USING (doc)" for c in ("currency", "unit", "month_day"))
    return f"(SELECT * FROM (SELECT doc, count(DISTINCT name) AS n FROM {rows} GROUP BY doc) {modes})"


ORACLES = {
    "c_simple_compare": f"""
WITH a AS (SELECT doc, name, last(v ORDER BY id) AS x FROM (SELECT doc, id, name, {_double("mbrevenue")} AS v FROM {_side(EXPECTED)}) WHERE name <> '' GROUP BY 1, 2),
b AS (SELECT doc, name, last(v ORDER BY id) AS y FROM (SELECT doc, id, name, {_double("mbrevenue")} AS v FROM {_side(PREDICTED)}) WHERE name <> '' GROUP BY 1, 2)
SELECT a.doc, a.name, CASE WHEN b.doc IS NULL THEN 'missing' WHEN coalesce(abs(x - y) <= 0.01, x IS NULL AND y IS NULL) THEN 'match' ELSE 'wrong' END AS state FROM a LEFT JOIN b ON a.doc = b.doc AND a.name = b.name
UNION ALL SELECT doc, name, 'extra' FROM b WHERE (doc, name) NOT IN (SELECT doc, name FROM a)""",
    "c_continuity": f"""
WITH a AS {_continuity_side(EXPECTED)}, b AS {_continuity_side(PREDICTED)},
c AS (SELECT x.doc, count(*) AS common FROM (SELECT DISTINCT doc, name FROM {_SIDE_NAMES.replace("{0}", EXPECTED)}) x JOIN (SELECT DISTINCT doc, name FROM {_SIDE_NAMES.replace("{0}", PREDICTED)}) y ON x.doc = y.doc AND x.name = y.name GROUP BY 1)
SELECT count(*) AS documents, cast(sum(a.n) AS bigint) AS prior_names, cast(sum(b.n) AS bigint) AS names, cast(sum(coalesce(common, 0)) AS bigint) AS common_names, count(*) FILTER (common = a.n AND common = b.n) AS same_sets,
  count(*) FILTER (a.n = b.n) AS same_counts, count(*) FILTER (coalesce(common, 0) < b.n) AS with_additions, count(*) FILTER (coalesce(common, 0) < a.n) AS with_removals, {_STABLE("currency")}, {_STABLE("unit")},
  count(*) FILTER (a.month_day_mode = b.month_day_mode) AS month_day_stable
FROM a JOIN b ON a.doc = b.doc LEFT JOIN c ON a.doc = c.doc""",
    "c_first_per_product": r"""
SELECT infocode, lower(regexp_replace(productname, '\s+', '', 'g')) AS name_key, row_id, mbrevenue FROM flat_export WHERE trim(infocode) <> '' AND regexp_replace(productname, '\s+', '', 'g') <> ''
QUALIFY row_number() OVER (PARTITION BY infocode, lower(regexp_replace(productname, '\s+', '', 'g')) ORDER BY row_id) = 1""",
    "c_signatures": f"SELECT row_id, {', '.join(f'{_sig(f)} AS {f}' for f in FIELDS)} FROM flat_export",
    "c_pairs_exact": f"WITH {_PAIRED} SELECT exp_id, pred_id, how FROM pairs",
    "c_unpaired": f"WITH {_PAIRED} SELECT 'missing' AS kind, id FROM exp WHERE id NOT IN (SELECT exp_id FROM pairs) UNION ALL SELECT 'extra', id FROM pred WHERE id NOT IN (SELECT pred_id FROM pairs)",
    "c_compare_docs": f"WITH {_DOCS} SELECT * FROM docs",
    "c_compare_corpus": f"""WITH {_DOCS}, total AS (SELECT count(*) AS documents, {", ".join(f"cast(sum({c}) AS bigint) AS {c}" for c in ("expected", "predicted", "matched", "wrong", "missing", "extra", "forgiven"))},
    {", ".join(f"count(*) FILTER (category = '{k}') AS docs_{k}" for k in ("match", "forgiven", "differs"))} FROM docs)
SELECT *, round(matched / greatest(expected, 1), 6) AS recall, round(matched / greatest(predicted - forgiven, 1), 6) AS precision, round(matched / greatest(matched + wrong, 1), 6) AS field_accuracy,
  round(matched / greatest(expected, predicted - forgiven, 1), 6) AS comprehensive_hit, round((matched + wrong) / greatest(expected, 1), 6) AS biz_hit FROM total""",
    "c_compare_fields": f"""WITH {_DOCS} SELECT field, ok, bad, round(ok / greatest(ok + bad, 1), 6) AS accuracy FROM ({" UNION ALL ".join(f"SELECT '{f}' AS field, cast(sum(matched + wrong - bad_{f}) AS bigint) AS ok, cast(sum(bad_{f}) AS bigint) AS bad FROM docs" for f in FIELDS)})""",
    "c_amounts_covered": f"""
WITH need AS (SELECT infocode AS doc, CASE WHEN {_TRIPLE_WHOLE} THEN {_TRIPLE_SIG} END AS sig, count(*) AS need FROM flat_export WHERE source_code = '{EXPECTED}' AND trim(infocode) <> '' GROUP BY 1, 2),
have AS (SELECT infocode AS doc, {_TRIPLE_SIG} AS sig, count(*) AS have FROM flat_export WHERE source_code = '{PREDICTED}' AND trim(infocode) <> '' AND {_TRIPLE_WHOLE} GROUP BY 1, 2)
SELECT doc, bool_and(coalesce(have >= need, false)) AS covered FROM need LEFT JOIN have USING (doc, sig) GROUP BY doc""",
    "c_values_located": rf"""
WITH v AS (SELECT infocode, value_id, {_FORMS} AS forms FROM (SELECT *, format('{{:,}}', cast(string_split(plain, '.')[1] AS bigint)) || CASE WHEN contains(plain, '.') THEN '.' || string_split(plain, '.')[2] ELSE '' END AS grouped
    FROM (SELECT *, {_WRITTEN.replace("{0}", "abs(v)")} AS plain FROM (SELECT infocode, row_id AS value_id, {_double("mbrevenue")} AS v FROM flat_export WHERE trim(infocode) <> '')) WHERE v IS NOT NULL)),
raw AS (SELECT infocode, unnest(regexp_extract_all(text, '\(?-?\d[\d,]*(?:\.\d+)?\)?')) AS token FROM doc_lines WHERE infocode IS NOT NULL),
tokens AS (SELECT infocode, token FROM raw UNION SELECT infocode, regexp_replace(token, '[()]', '', 'g') FROM raw),
hit AS (SELECT DISTINCT value_id FROM (SELECT infocode, value_id, unnest(forms) AS token FROM v) JOIN tokens USING (infocode, token))
SELECT infocode, count(*) AS n_values, count(h.value_id) AS n_found, count(h.value_id) = count(*) OR (count(*) > 4 AND count(h.value_id) * 10 >= count(*) * 7) AS located FROM v LEFT JOIN hit h ON v.value_id = h.value_id GROUP BY infocode""",
    "c_dominant_currency": """
SELECT infocode, arg_max(currency, [n, -first_id]) AS currency FROM (SELECT infocode, currency, count(*) AS n, min(row_id) AS first_id FROM flat_export WHERE infocode IS NOT NULL AND trim(currency) <> '' GROUP BY 1, 2) GROUP BY 1""",
    "c_strategies": rf"""
WITH names AS (SELECT DISTINCT infocode AS doc, source_code AS source, lower(regexp_replace(productname, '\s+', '', 'g')) AS name FROM flat_export WHERE trim(infocode) <> '' AND length(regexp_replace(productname, '\s+', '', 'g')) > 0),
c AS (SELECT n.doc, n.source, count(*) AS n_names, count(p.name) AS mp, count(g.name) AS mg FROM names n LEFT JOIN (SELECT * FROM names WHERE source = '{EXPECTED}') p ON n.doc = p.doc AND n.name = p.name
  LEFT JOIN (SELECT * FROM names WHERE source = '{PREDICTED}') g ON n.doc = g.doc AND n.name = g.name GROUP BY 1, 2),
d AS (SELECT c.*, mp / np AS r, mp / n_names AS q, mg / ng AS gt, source = 'LDN' AS selected FROM c JOIN (SELECT doc, count(*) AS np FROM names WHERE source = '{EXPECTED}' GROUP BY 1) USING (doc) JOIN (SELECT doc, count(*) AS ng FROM names WHERE source = '{PREDICTED}' GROUP BY 1) USING (doc)),
s AS (SELECT *, CASE WHEN r + q > 0 THEN 2 * r * q / (r + q) ELSE 0 END AS f1 FROM d),
now AS (SELECT doc, coalesce(max(gt) FILTER (selected), 0) AS now FROM s GROUP BY doc),
br AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY doc ORDER BY r DESC, selected DESC, source DESC) = 1),
bf AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY doc ORDER BY f1 DESC, selected DESC, source DESC) = 1),
o AS (SELECT 'prior_recall' AS strategy, -1.0 AS bound, doc, selected, f1, gt FROM br UNION ALL SELECT 'prior_f1', -1.0, doc, selected, f1, gt FROM bf
  {" ".join(f"UNION ALL SELECT 'guarded_f1_{g:.1f}', {g}, doc, selected, f1, gt FROM bf" for g in (0.5, 0.6, 0.7, 0.8))}),
a AS (SELECT *, CASE WHEN f1 < bound THEN now ELSE gt END AS after FROM o JOIN now USING (doc))
SELECT strategy, count(*) FILTER (after > now) AS improves, count(*) FILTER (after < now) AS regresses, count(*) FILTER (after = now) AS unchanged, count(*) FILTER (f1 >= bound AND NOT selected AND bound >= 0) AS takeovers FROM a GROUP BY 1""",
    "f_sums_totals": f"""
SELECT doc, source_code, start_date, end_date, n_products, cast(round(summed, 2) AS double) AS summed, cast(round(stated, 2) AS double) AS stated, cast(round(coalesce(stated, summed), 2) AS double) AS total,
  abs(summed - stated) <= greatest(0.01 * greatest(abs(summed), abs(stated)), 1) AS agrees
FROM (SELECT doc, source_code, start_date, end_date, sum(x) FILTER (kind IS NULL) AS summed, coalesce(max(x) FILTER (kind = 'final'), max(x) FILTER (kind = 'subtotal')) AS stated, count(*) FILTER (kind IS NULL) AS n_products
  FROM (SELECT *, cast(amount AS decimal(28, 6)) AS x FROM {_FACTS}) GROUP BY 1, 2, 3, 4)""",
    "f_first_facts": f"SELECT doc, {_KEY} AS name_key, start_date, end_date, fact_no, source_code, amount FROM {_FACTS} QUALIFY row_number() OVER (PARTITION BY doc, {_KEY}, start_date, end_date ORDER BY fact_no) = 1",
    "f_records": f"""
WITH f AS {_FACTS}, m AS (SELECT doc, lower(trim(name)) AS k, start_date, end_date, arg_max(c, fact_no) FILTER (c IS NOT NULL) AS cost, arg_max(g, fact_no) FILTER (g IS NOT NULL) AS gp
  FROM (SELECT *, {_double("mbcost")} AS c, {_double("gross_profit")} AS g FROM f WHERE source_code = '{PREDICTED}') WHERE c IS NOT NULL OR g IS NOT NULL GROUP BY 1, 2, 3, 4)
SELECT f.doc, cast(f.start_date AS varchar) || 'T00:00:00.000Z' AS STARTDATE, cast(f.end_date AS varchar) || 'T00:00:00.000Z' AS REPORTDATE, coalesce(currency, '') AS CURRENCY, name AS PRODUCTNAME,
  {_WRITTEN.replace("{0}", "amount")} AS MBREVENUE, {_WRITTEN.replace("{0}", "cost")} AS MBCOST, {_WRITTEN.replace("{0}", "gp")} AS GROSS_PROFIT,
  CASE WHEN coalesce({_strip("unit")}, '') = '' THEN '' WHEN regexp_matches(unit, '百万|百萬') THEN '004' WHEN contains(unit, '千') THEN '002' ELSE '001' END AS UNIT
FROM f LEFT JOIN m ON f.doc = m.doc AND lower(trim(f.name)) = m.k AND f.start_date = m.start_date AND f.end_date = m.end_date WHERE f.source_code = '{EXPECTED}'""",
    "f_enriched": rf"""
WITH f AS (SELECT *, {_KEY} AS k, year(end_date) AS y FROM {_FACTS}), base AS (SELECT DISTINCT doc, k AS base_key, y, start_date, end_date FROM f WHERE source_code = '{EXPECTED}'),
m AS (SELECT doc, k, y, {_double("mbcost")} AS amount, fact_no FROM f WHERE source_code = '{PREDICTED}'), n AS (SELECT * FROM m WHERE amount IS NOT NULL),
e AS (SELECT b.doc, base_key, b.start_date, b.end_date, amount, fact_no, 0 AS r FROM n JOIN base b ON n.doc = b.doc AND n.y = b.y AND n.k = b.base_key),
c AS (SELECT b.doc, base_key, b.start_date, b.end_date, amount, fact_no, 1 AS r FROM (SELECT * FROM n WHERE (doc, k, y) NOT IN (SELECT doc, base_key, y FROM base)) n JOIN base b ON n.doc = b.doc AND n.y = b.y WHERE n.k <> '' AND (contains(base_key, n.k) OR contains(n.k, base_key)))
SELECT doc, base_key, start_date, end_date, 'MBCOST' AS metric, arg_min(amount, [r, fact_no]) AS amount FROM (SELECT * FROM e UNION ALL SELECT * FROM c) GROUP BY 1, 2, 3, 4""",
    "f_prior_context": r"""
WITH c AS (SELECT infocode, trim(productname, ' ') AS n, trim(mbcost, ' ') AS c, trim(gross_profit, ' ') AS g, nullif(replace(regexp_extract(reportdate, '20\d{2}[/-](\d{1,2}[/-]\d{1,2})', 1), '/', '-'), '') AS md FROM flat_export WHERE trim(infocode) <> '')
SELECT infocode, bool_or(coalesce(c <> '', false)) AS has_cost, bool_or(coalesce(g <> '', false)) AS has_gross_profit,
  count(DISTINCT n) FILTER (n <> '' AND lower(n) NOT IN ('合计', '合計', '總計', '总计', '總額', '总额', 'total')) AS n_names, any_value(b.md) AS fiscal_month_day
FROM c LEFT JOIN (SELECT infocode, md FROM (SELECT infocode, md, count(*) AS k FROM c WHERE md IS NOT NULL GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY infocode ORDER BY k DESC, md) = 1) b USING (infocode) GROUP BY infocode""",
}
