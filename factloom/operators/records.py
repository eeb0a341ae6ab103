"""From the lines of documents to their records: sections, the chosen section, its tables, facts, metrics, records.

Each step is a DataFrame of the one before; nothing of a document is gathered but what is bounded by a page, a
table or the alphabet. Steps that several later ones use are kept in the shared folder, which also cuts the plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import numbers as n
from ..functions import periods as p
from ..functions import text as t
from ..sources.tables import shared_dir
from . import facts as fa
from . import grids as gr
from . import layout as la
from . import lines as ln
from . import selection as se
from .linkage import containing

SECTION = ["infocode", "section_id"]
_LINE = ("infocode", "page_number", "line_id", "line_no", "text", "x0", "x1", "top", "bottom")
_PART = ("infocode", "section_id", "page_number")
# Names of totals that are no prior names.
TOTALS = ("合计", "合計")


def prior_names(rows: DataFrame) -> DataFrame:
    """A2, A3: (infocode, name): the distinct usable names of earlier rows (infocode, productname)."""
    name = F.regexp_replace("productname", r"^\s+|\s+$", "")
    named = rows.where(F.col("infocode").isNotNull()).select("infocode", name.alias("name")).where((F.col("name") != "") & ~F.col("name").isin(*TOTALS)).distinct()
    return named.select("infocode", se.usable_name(F.col("name")).alias("name")).where("name is not null").distinct()


def required_metrics(rows: DataFrame) -> DataFrame:
    """A2: (infocode, metric): the metrics that earlier rows (infocode, mbcost, gross_profit) have."""
    filled = lambda c, m: F.when(F.trim(F.col(c)) != "", m)
    return rows.where(F.col("infocode").isNotNull()).select("infocode", F.explode(F.array(filled("mbcost", "MBCOST"), filled("gross_profit", "GROSS_PROFIT"))).alias("metric")).where("metric is not null").distinct()


def sectioned_lines(lines: DataFrame) -> DataFrame:
    """Lines with section_id and the title of their section.

    ``text`` is cleaned, ``raw`` as delivered. Lines of a heading that went to the next section have left.
    """
    kept = ln.content_lines(lines.select(*_LINE)).withColumn("raw", F.col("text")).withColumn("text", t.line_text(F.col("text")))
    cut = ln.sectionize(kept)
    merged = ln.merged_sections(ln.section_table(cut)).select(*SECTION, F.coalesce("carried_title", "title").alias("title"))
    return cut.join(merged, SECTION)


def section_words(sectioned: DataFrame) -> DataFrame:
    """The words of each line with its section."""
    return la.words_of_lines(sectioned.select(*la.PAGE, "section_id", "line_id", "line_no", F.col("raw").alias("text"), "x0", "x1", "top", "bottom"))


def related(sectioned: DataFrame, words: DataFrame) -> DataFrame:
    """The marks of sections that may hold a table of revenue and look like tables."""
    return la.table_like(words, se.related_sections(se.section_marks(sectioned))).where("is_table")


def chosen(marks: DataFrame, words: DataFrame, names: DataFrame) -> DataFrame:
    """The section chosen for each document among the related ones, by hits of its prior names."""
    some = words.join(marks.select(*SECTION), SECTION, "left_semi")
    counts = names.groupBy("infocode").agg(F.count("*").cast("int").alias("n_names"))
    none = F.lit(0)
    return se.best_sections(marks.join(se.name_hits(some, names), SECTION, "left").join(counts, "infocode", "left").fillna(0, ["hits", "exact_hits", "n_names"]))


def section_grids(words: DataFrame, sections: DataFrame) -> DataFrame:
    """The tables of ``sections``: infocode, section_id, page_number, table_no (in order), table_id, grid."""
    own = words.join(sections.select(*SECTION), SECTION, "left_semi")
    made = la.assemble_grids(la.row_blocks(la.row_table(la.word_rows(own, within=_PART), within=_PART), within=_PART), within=_PART)
    number = F.col("page_number").cast("long") * 1_000_000 + F.col("block_no")
    return made.select(*_PART, number.alias("table_no"), F.concat_ws(":", "infocode", "section_id", "page_number", "block_no").alias("table_id"), "grid")


def surroundings(sectioned: DataFrame, marks: DataFrame, main: DataFrame) -> DataFrame:
    """What the text around a document's table says of its period and money.

    The text is the chosen section, then the related ones, then the period that the document's code stands for. What
    is tried by rank is taken by the best rank anywhere in it, and of equals the first. Notations are looked for in a
    line at a time. Rows: infocode, period_year, period_years, period_end, period_months, currency, unit.
    """
    own = main.select(*SECTION, F.lit(0).alias("_after"))
    l = sectioned.join(marks.select(*SECTION), SECTION, "left_semi").join(own, SECTION, "left").withColumn("_after", F.coalesce("_after", F.lit(1)))
    hint = p.year_hint(F.col("infocode"))
    hints = l.select("infocode").distinct().select("infocode", F.lit(2).alias("_after"), F.lit(0).cast("long").alias("section_id"), F.lit(0).cast("long").alias("line_no"), hint.alias("text"))
    l = l.select("infocode", "_after", F.col("section_id").cast("long").alias("section_id"), F.col("line_no").cast("long").alias("line_no"), "text").unionByName(hints)
    at = ("_after", "section_id", "line_no")
    every = F.transform(F.regexp_extract_all("text", F.lit(t.YEAR), 0), lambda y: p.year_of(y))
    l = l.select("infocode", *at, p.ranked_period_end(F.col("text")).alias("e"), every.alias("ys"), p.months_rank(F.col("text")).alias("m"), n.currency_rank(F.col("text")).alias("c"), n.unit_rank(F.col("text")).alias("u"))
    said = l.groupBy("infocode").agg(
        F.min_by("e.end", F.when(F.col("e").isNotNull(), F.struct("e.rank", *at))).alias("period_end"), F.min_by(F.get("ys", F.lit(0)), F.when(F.size("ys") > 0, F.struct(*at))).alias("period_year"),
        F.array_distinct(F.flatten(F.collect_set("ys"))).alias("period_years"), p.months_of(F.min("m")).alias("period_months"), n.currency_name(F.min("c")).alias("currency"), n.unit_name(F.min("u")).alias("unit"),
    )
    return said.select("infocode", "period_year", F.array_sort("period_years").alias("period_years"), "period_end", "period_months", "currency", "unit")


def metric_columns(grids: DataFrame) -> DataFrame:
    """(table_id, col_no, place, year): year columns without notes, per cents and margins, their places counted from 0."""
    width = F.array_max(F.transform("grid", lambda r: F.size(r)))
    heads = grids.where(width > 0).select("table_id", "grid", F.explode(F.sequence(F.lit(0), width - 1)).alias("col_no"))
    heads = heads.select("table_id", "col_no", gr.column_header(F.col("grid"), F.col("col_no")).alias("head"))
    years = heads.where(~F.col("head").rlike("(?i)附註|附注|%|毛利率|百分比|note")).select("table_id", "col_no", p.year_of(F.col("head")).alias("year")).where("year is not null")
    return years.withColumn("place", F.row_number().over(Window.partitionBy("table_id").orderBy("col_no")) - 1)


def metrics_of_tables(grids: DataFrame, marks: DataFrame, revenue: DataFrame) -> DataFrame:
    """Gross profit, or else cost, of the products in ``revenue`` from other tables of the related sections.

    A section tells of gross profit where its lines do, else of cost; a table counts if it names the margin or the
    cost. Its year columns stand for the years of the revenue facts, the latest first. Rows are read in the column
    with most products; a row is the product of its label, else the first that contains it or is contained in it. A
    total is read only below a product. ``revenue``: infocode, fact_no, product_name, start_date, end_date, unique by
    product and period. Rows: infocode, place (order of finding), name, start_date, end_date, metric, amount.
    """
    kind = F.when(F.col("tells_gross"), "GROSS_PROFIT").when(F.col("tells_cost"), "MBCOST")
    g = grids.join(marks.select(*SECTION, kind.alias("metric")).where("metric is not null"), SECTION)
    whole = F.array_join(F.flatten("grid"), " ")
    g = g.where(F.when(F.col("metric") == "GROSS_PROFIT", whole.contains("毛利率")).otherwise(whole.contains("成本")))
    r = revenue.withColumn("product", t.name_key(F.col("product_name"))).withColumn("year", F.year("end_date"))
    years = r.select("infocode", "year").distinct().withColumn("place", F.row_number().over(Window.partitionBy("infocode").orderBy(F.desc("year"))) - 1)
    products = r.groupBy("infocode", "product").agg(F.min("fact_no").alias("first"))

    cells = gr.cells_long(g, "table_id").join(g.select("table_id", "infocode", "section_id", "table_no", "metric"), "table_id").withColumn("label", t.strip(F.coalesce("text", F.lit(""))))
    keyed = cells.where("label <> ''").withColumn("product", t.name_key(F.col("label"))).join(products.select("infocode", "product"), ["infocode", "product"], "left_semi")
    score = keyed.groupBy("table_id", "col_no").agg(F.count("*").alias("k"))
    naming = score.groupBy("table_id").agg(F.max_by("col_no", F.struct("k", -F.col("col_no"))).alias("naming"))
    labelled = cells.join(naming, "table_id", "left").where(F.col("col_no") == F.coalesce("naming", F.lit(0)))
    # a row too short for the naming column has no label
    rows = g.select("infocode", "section_id", "table_no", "metric", "table_id", F.posexplode("grid").alias("row_no", "row")).join(labelled.select("table_id", "row_no", "label"), ["table_id", "row_no"], "left")
    kind = t.label_kind(F.col("label"))
    total = (kind == "final") | (F.coalesce("label", F.lit("")) == "")
    rows = rows.where(F.coalesce(kind != "subtotal", F.lit(True))).withColumn("key", F.when(F.coalesce(total, F.lit(False)), "合计").otherwise(t.name_key(F.col("label"))))
    # the product of a label: the equal one, else the first by fact_no that contains it or is contained in it
    keys = rows.select("infocode", F.col("key").alias("text")).distinct()
    listed = products.select("infocode", F.col("product").alias("text"))
    near = containing(keys, listed, ["infocode"]).select("infocode", F.col("inner").alias("key"), F.col("outer").alias("product"))
    near = near.union(containing(listed, keys, ["infocode"]).select("infocode", F.col("outer").alias("key"), F.col("inner").alias("product"))).distinct()
    of = near.join(products, ["infocode", "product"]).groupBy("infocode", "key").agg(F.min_by("product", F.struct(F.col("key") != F.col("product"), "first")).alias("product"))
    rows = rows.join(of, ["infocode", "key"])
    above = Window.partitionBy("table_id").orderBy("row_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("begun", F.max(F.col("key") != "合计").over(above)).where("begun or key <> '合计'")
    read = rows.join(metric_columns(g), "table_id").select("infocode", "section_id", "table_no", "row_no", "col_no", "place", "metric", "product", n.cell_number(F.get("row", F.col("col_no"))).alias("amount")).where("amount is not null")
    dated = read.join(years, ["infocode", "place"]).join(r.select("infocode", "product", "year", "product_name", "start_date", "end_date", "fact_no"), ["infocode", "product", "year"])
    # of several periods of a year the first fact's
    one = dated.groupBy("infocode", "section_id", "table_no", "row_no", "col_no", "metric", "amount").agg(F.min_by(F.struct("product_name", "start_date", "end_date"), "fact_no").alias("f"))
    return one.select("infocode", F.struct(F.lit(0).alias("pass"), "section_id", "table_no", "row_no", "col_no").alias("place"), F.col("f.product_name").alias("name"), "f.start_date", "f.end_date", "metric", "amount")


def metrics_of_headers(grids: DataFrame, revenue: DataFrame, required: DataFrame) -> DataFrame:
    """The metrics that a document's earlier rows have, from columns whose header names metric and year.

    A row counts for the first of its cells that is a product. Rows as in ``metrics_of_tables``.
    """
    need = required.groupBy("infocode").agg(F.array_contains(F.collect_set("metric"), "MBCOST").alias("cost"), F.array_contains(F.collect_set("metric"), "GROSS_PROFIT").alias("gross"))
    g = grids.join(need, "infocode")
    width = F.array_max(F.transform("grid", lambda r: F.size(r)))
    heads = g.where(width > 0).select("infocode", "section_id", "table_no", "table_id", "grid", "cost", "gross", F.explode(F.sequence(F.lit(0), width - 1)).alias("col_no"))
    head = F.array_join(F.array_compact(F.transform(F.slice("grid", 1, 5), lambda r: F.get(r, F.col("col_no")))), " ")
    heads = heads.withColumn("head", head).select("infocode", "section_id", "table_no", "table_id", "col_no", F.when(F.col("cost") & F.col("head").rlike(COST), "MBCOST").when(F.col("gross") & F.col("head").rlike(GROSS), "GROSS_PROFIT").alias("metric"), p.year_of(F.col("head")).alias("year")).where("metric is not null and year is not null")
    r = revenue.select("infocode", F.lower(t.strip(F.col("product_name"))).alias("product"), F.year("end_date").alias("year"), "product_name", "start_date", "end_date", "fact_no")
    cells = gr.cells_long(g, "table_id").join(g.select("table_id", "infocode"), "table_id").where("row_no > 0").withColumn("product", F.lower(t.strip(F.col("text"))))
    named = cells.join(r.select("infocode", "product").distinct(), ["infocode", "product"]).groupBy("infocode", "table_id", "row_no").agg(F.min_by("product", "col_no").alias("product"))
    amounts = cells.select("table_id", "row_no", "col_no", n.cell_number(F.col("text")).alias("amount")).where("amount is not null")
    read = heads.join(amounts, ["table_id", "col_no"]).join(named.drop("infocode"), ["table_id", "row_no"]).join(r, ["infocode", "product", "year"])
    one = read.groupBy("infocode", "section_id", "table_no", "row_no", "col_no", "metric", "amount").agg(F.min_by(F.struct("product_name", "start_date", "end_date"), "fact_no").alias("f"))
    return one.select("infocode", F.struct(F.lit(1).alias("pass"), "section_id", "table_no", "row_no", "col_no").alias("place"), F.col("f.product_name").alias("name"), "f.start_date", "f.end_date", "metric", "amount")


# Headers that name the cost and the gross profit.
COST = "(?i)成本|cost"
GROSS = "(?i)毛利|gross profit"


@dataclass
class Extraction:
    """What becomes of the lines of documents, step by step."""

    sectioned: DataFrame
    words: DataFrame
    marks: DataFrame
    main: DataFrame
    grids: DataFrame
    facts: DataFrame
    metrics: DataFrame
    records: DataFrame


def extract(lines: DataFrame, prior: DataFrame) -> Extraction:
    """The records of all documents from their lines.

    ``lines``: infocode, page_number, line_id, line_no, text, x0, x1, top, bottom; lines without an infocode are
    left out. ``prior``: earlier rows (infocode, productname, mbcost, gross_profit). Records: doc and the eight
    fields of a record. Documents without a related section, table or fact have no records.
    """
    shared_dir(lines.sparkSession)
    names = prior_names(prior)
    sectioned = sectioned_lines(lines.where("infocode is not null")).checkpoint()
    words = section_words(sectioned).checkpoint()
    marks = related(sectioned, words).checkpoint()
    main = chosen(marks, words, names).checkpoint()
    grids = section_grids(words, marks).checkpoint()
    own = grids.join(main.select(*SECTION, "title"), SECTION)
    first = own.groupBy("infocode").agg(F.min("table_no").alias("table_no"))
    kind = gr.classify(F.col("grid"), F.col("title"), F.col("named"))
    read = gr.with_names(own, names).withColumn("classification", kind).join(surroundings(sectioned, marks, main), "infocode", "left")
    facts = gr.grid_facts(read).where("error is null").join(own.select("table_id", F.col("infocode").alias("doc"), "table_no"), "table_id").checkpoint()
    merged = fa.merge_tables(facts.withColumn("name", F.col("product_name")).withColumn("is_total", F.col("product_name") == gr.TOTAL)).checkpoint()
    revenue = merged.select(F.col("doc").alias("infocode"), (F.col("table_no") * 100_000 + F.col("fact_no")).alias("fact_no"), "product_name", "start_date", "end_date")
    others = grids.join(first.join(main.select(*SECTION), "infocode"), [*SECTION, "table_no"], "left_anti")
    others = others.checkpoint()
    found = metrics_of_tables(others, marks, revenue).checkpoint().unionByName(metrics_of_headers(others, revenue, required_metrics(prior)))
    metrics = fa.first_facts(found.withColumnRenamed("infocode", "doc"), ["doc", "name", "start_date", "end_date", "metric"], ["place"]).checkpoint()
    made = fa.records(fa.with_metrics(merged, metrics.withColumn("fact_no", F.lit(0))))
    return Extraction(sectioned, words, marks, main, grids, merged, metrics, made)


def outcomes(lines: DataFrame, done: Extraction) -> DataFrame:
    """(doc, status, stage, message, records, tables, pages, all_names): how the extraction of each document went.

    In order: no Chinese text, no table found, a table without facts, success.
    """
    readable = ln.readable_documents(lines.where("infocode is not null"))
    tables = done.grids.join(done.main.select(*SECTION), SECTION).groupBy("infocode").agg(F.count("*").alias("tables"), F.array_sort(F.collect_set("page_number")).alias("pages"))
    counts = done.records.groupBy(F.col("doc").alias("infocode")).agg(F.count("*").alias("records"))
    d = readable.join(done.main.select("infocode", F.col("section_id"), "all_names"), "infocode", "left").join(tables, "infocode", "left").join(counts, "infocode", "left").fillna(0, ["records", "tables"])
    unread, lost, empty = ~F.col("readable"), F.col("section_id").isNull(), F.col("records") == 0
    stage = F.when(unread | lost, "locate_fail").when(empty, "empty_output").otherwise("success")
    message = F.when(unread, "无法识别").when(lost, "未定位到目标表").when(empty, "主表抽取为空").otherwise(F.concat(F.col("records").cast("string"), F.lit(" 条")))
    return d.select(F.col("infocode").alias("doc"), F.when(stage == "success", "success").otherwise("no_data").alias("status"), stage.alias("stage"), message.alias("message"), "records", "tables", t.page_range(F.col("pages")).alias("pages"), F.coalesce("all_names", F.lit(False)).alias("all_names"))
