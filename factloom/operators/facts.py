"""Facts of tables: totals, merging of tables, metrics joined to revenue, final records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import number_text, unit_code
from ..functions.text import name_key

PERIOD = ("start_date", "end_date")


def sums_against_totals(facts: DataFrame, keys: list[str], kind: str = "kind", amount: str = "amount") -> DataFrame:
    """A4, A5: by ``keys`` the sum of products, the stated total and whether they agree.

    ``kind`` is 'final' or 'subtotal' for totals, null for products. The greatest final total is the stated one, the
    greatest subtotal where there is none; without either the sum stands for it. They agree within one per cent of the
    greater, or 1.
    """
    exact = F.col(amount).cast("decimal(28,6)")  # sums don't depend on the order of rows
    product, of = F.col(kind).isNull(), lambda k: F.max(F.when(F.col(kind) == k, exact))
    a = facts.groupBy(*keys).agg(F.sum(F.when(product, exact)).alias("summed"), F.coalesce(of("final"), of("subtotal")).alias("stated"), F.count_if(product).alias("n_products"))
    money = lambda c: F.round(c, 2).cast("double")
    near = F.abs(F.col("summed") - F.col("stated")) <= F.greatest(F.greatest(F.abs("summed"), F.abs("stated")) / 100, F.lit(1))
    return a.select(*keys, "n_products", money(F.col("summed")).alias("summed"), money(F.col("stated")).alias("stated"), money(F.coalesce("stated", "summed")).alias("total"), near.alias("agrees"))


def first_facts(facts: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first fact of each key by ``order``; a plain aggregate, so a hot key is folded before the shuffle."""
    rest = [c for c in facts.columns if c not in keys]
    picked = facts.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_f"))
    return picked.select(*keys, *[F.col(f"_f.{c}").alias(c) for c in rest])


def merge_tables(facts: DataFrame) -> DataFrame:
    """The tables of each document merged in order, a table kept out when it tells of other things.

    Kept out is a table that has no product in common with what is merged so far, or whose total of a common period
    differs by more than one per cent; nulls count as nought. Of facts with equal product, period and metric the first
    stays, so of the totals merged so far the first counts, of the table's own the last. ``facts``: doc, table_no,
    fact_no, name, is_total, start_date, end_date, metric, amount. Any number of tables; which of them share a product
    is worked out by a join on the product, and the order of merging is folded over these few numbers of a document.
    """
    f = facts.withColumn("name_key", F.lower(F.replace("name", F.lit(" "), F.lit(""))))
    key = ["doc", "name_key", *PERIOD, "metric"]
    names = f.where(~F.col("is_total")).select("doc", "name_key", "table_no").distinct()
    shared = names.join(names.select("doc", "name_key", F.col("table_no").alias("earlier")), ["doc", "name_key"]).where("earlier < table_no")
    shared = shared.groupBy("doc", "table_no").agg(F.collect_set("earlier").alias("shares"))
    amount = F.coalesce("amount", F.lit(0.0))
    totals = f.where("is_total").groupBy("doc", "table_no", *PERIOD).agg(F.min_by(amount, "fact_no").alias("first"), F.max_by(amount, "fact_no").alias("last"))
    totals = totals.groupBy("doc", "table_no").agg(F.collect_list(F.struct(F.struct(*PERIOD).alias("of"), "first", "last")).alias("totals"))
    tables = f.groupBy("doc", "table_no").agg(F.max(~F.col("is_total")).alias("named")).join(shared, ["doc", "table_no"], "left").join(totals, ["doc", "table_no"], "left")
    one = F.struct("table_no", "named", F.coalesce("shares", F.array().cast("array<bigint>")).alias("shares"), "totals")
    docs = tables.withColumn("table_no", F.col("table_no").cast("bigint")).groupBy("doc").agg(F.array_sort(F.collect_list(one)).alias("tables"))

    def step(kept, t):
        both = F.exists(kept, lambda k: k["named"]) & t["named"]
        apart = F.size(F.array_intersect(t["shares"], F.transform(kept, lambda k: k["table_no"]))) == 0
        before = F.flatten(F.filter(F.transform(kept, lambda k: k["totals"]), lambda x: x.isNotNull()))  # in order of tables: the first of a period counts
        base = lambda x: F.get(F.filter(before, lambda b: b["of"] == x["of"]), F.lit(0))["first"]
        other = F.exists(t["totals"], lambda x: F.coalesce(F.abs(base(x) - x["last"]) > 0.01 * F.abs(base(x)), F.lit(False)))
        return F.when(both & (apart | F.coalesce(other, F.lit(False))), kept).otherwise(F.concat(kept, F.array(t)))

    empty = F.filter("tables", lambda t: F.lit(False))
    kept = docs.select("doc", F.explode(F.transform(F.aggregate("tables", empty, step), lambda k: k["table_no"])).alias("table_no"))
    return first_facts(f.withColumn("table_no", F.col("table_no").cast("bigint")).join(kept, ["doc", "table_no"]), key, ["table_no", "fact_no"]).drop("name_key")


def with_metrics(revenue: DataFrame, metrics: DataFrame) -> DataFrame:
    """Revenue facts with cost and gross profit of the same product and period; the last by fact_no wins."""
    key = ["doc", "name_key", *PERIOD]
    m = metrics.withColumn("name_key", F.lower(F.trim("name"))).groupBy(*key).agg(
        *[F.max_by(F.when(F.col("metric") == k, F.col("amount")), F.when(F.col("metric") == k, F.col("fact_no"))).alias(c) for k, c in (("MBCOST", "cost"), ("GROSS_PROFIT", "gross_profit"))],
    )
    return revenue.withColumn("name_key", F.lower(F.trim("name"))).join(m, key, "left").drop("name_key")


def records(facts: DataFrame) -> DataFrame:
    """The eight text fields of a record, amounts without needless decimals, dates as instants."""
    at = lambda c: F.concat(F.date_format(c, "yyyy-MM-dd"), F.lit("T00:00:00.000Z"))
    return facts.select(
        "doc", at("start_date").alias("STARTDATE"), at("end_date").alias("REPORTDATE"), F.coalesce("currency", F.lit("")).alias("CURRENCY"), F.col("name").alias("PRODUCTNAME"),
        number_text(F.col("amount")).alias("MBREVENUE"), number_text(F.col("cost")).alias("MBCOST"), number_text(F.col("gross_profit")).alias("GROSS_PROFIT"), unit_code(F.col("unit")).alias("UNIT"),
    )


def enrich_by_year(revenue: DataFrame, metrics: DataFrame) -> DataFrame:
    """Metric facts of other tables given the period of the revenue fact of the same product and year.

    ``metrics``: doc, name, year, metric, amount, table_no. Products match by their key, else by containment of
    keys within the document; of several the first by table_no, then the longest name. Nothing new is added:
    a metric without a revenue fact is left out.
    """
    base = revenue.select("doc", name_key(F.col("name")).alias("base_key"), F.year("end_date").alias("year"), *PERIOD).distinct()
    m = metrics.withColumn("key", name_key(F.col("name")))
    exact = m.join(base, (m["doc"] == base["doc"]) & (m["year"] == base["year"]) & (m["key"] == base["base_key"])).drop(base["doc"]).drop(base["year"]).withColumn("rank", F.lit(0))
    left = m.join(exact.select("doc", "key", "year").distinct(), ["doc", "key", "year"], "left_anti")
    near = left.join(base, ["doc", "year"]).where((F.length("key") > 0) & (F.col("base_key").contains(F.col("key")) | F.col("key").contains(F.col("base_key")))).withColumn("rank", F.lit(1))
    cols = ["doc", "base_key", *PERIOD, "metric", "amount", "table_no", "rank"]
    both = exact.select(*cols).unionByName(near.select(*cols))
    return both.groupBy("doc", "base_key", *PERIOD, "metric").agg(F.min_by("amount", F.struct("rank", "table_no", "amount")).alias("amount"))


def prior_context(rows: DataFrame, doc: str) -> DataFrame:
    """A2, A3: by document the distinct prior names, the metrics present and the commonest fiscal month and day.

    Names of totals are left out; of month-days equally common the smallest is taken.
    """
    totals = ("合计", "合計", "總計", "总计", "總額", "总额", "total")
    month_day = F.regexp_extract("reportdate", r"20\d{2}[/-](\d{1,2}[/-]\d{1,2})", 1)
    clean = rows.select(doc, F.trim("productname").alias("n"), F.trim("mbcost").alias("c"), F.trim("gross_profit").alias("g"), F.nullif(F.regexp_replace(month_day, "/", "-"), F.lit("")).alias("md"))
    flags = clean.groupBy(doc).agg(F.max(F.coalesce(F.col("c") != "", F.lit(False))).alias("has_cost"), F.max(F.coalesce(F.col("g") != "", F.lit(False))).alias("has_gross_profit"))
    names = clean.where((F.col("n") != "") & ~F.lower("n").isin(*totals)).select(doc, "n").distinct().groupBy(doc).agg(F.count("*").alias("n_names"))
    counts = clean.where("md is not null").groupBy(doc, "md").agg(F.count("*").alias("k"))
    best = counts.withColumn("_r", F.row_number().over(Window.partitionBy(doc).orderBy(F.desc("k"), "md"))).where("_r = 1").select(doc, F.col("md").alias("fiscal_month_day"))
    return flags.join(names, doc, "left").join(best, doc, "left").fillna(0, ["n_names"])
