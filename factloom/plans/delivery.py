"""Queries of exports, runs, tables in HTML, selection of sections, and sets, with their reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import grids as gr
from ..operators import layout as la
from ..operators import lines as ln
from ..operators import records as rc
from ..operators import selection as se
from ..sources import exports as ex
from ..sources.tables import shared_dir, table
from ..streaming.ingest import sessions
from . import documents as doc
from . import layout as lap
from . import scalars as sc


def export_groups(spark: SparkSession, data_dir: str) -> DataFrame:
    """Rows of the export by filing, those without a code counted apart."""
    return ex.export_groups(table(spark, data_dir, "flat_export"), "infocode", "row_id")


def latest_runs(spark: SparkSession, data_dir: str) -> DataFrame:
    """The latest delivery of each filing in the failure inventory."""
    return ex.latest_runs(table(spark, data_dir, "no_gt_hit_codes"), "infocode", "loaded_at").select("infocode", "loaded_at", "category", "local_rows", "gt_rows")


def inventory_roll_up(spark: SparkSession, data_dir: str) -> DataFrame:
    """The failure inventory by category and stage, largest first."""
    i = table(spark, data_dir, "no_gt_hit_codes").groupBy(F.lower("category").alias("category"), "pipeline_stage").agg(F.countDistinct("infocode").alias("n_documents"), F.sum("local_rows").alias("extracted"), F.sum("gt_rows").alias("expected"))
    return i.orderBy(F.desc("n_documents"), "category")


def accepted(spark: SparkSession, data_dir: str) -> DataFrame:
    """K8: the inventory with the filings of the copy put in their place."""
    cols = ["infocode", "category", "message"]
    return ex.accept_rows(table(spark, data_dir, "no_gt_hit_codes").select(*cols), table(spark, data_dir, "no_gt_hit_codes_copy").select(*cols), "infocode")


def status_ladder(spark: SparkSession, data_dir: str) -> DataFrame:
    """How a filing's extraction went, by the rows extracted and expected."""
    i = table(spark, data_dir, "no_gt_hit_codes")
    a, b = F.coalesce("local_rows", F.lit(0)), F.coalesce("gt_rows", F.lit(0))
    return i.select("infocode", "loaded_at", F.when((a == 0) & (b == 0), "none").when(a == 0, "empty").when(a < b, "missing").when(a > b, "extra").otherwise("even").alias("status"))


def json_fields(spark: SparkSession, data_dir: str) -> DataFrame:
    """Fields of the JSON payloads, whatever the case of their names."""
    r = table(spark, data_dir, "raw_export").where(F.ltrim("payload").startswith("{"))
    m = F.transform_keys(F.from_json("payload", "map<string,string>"), lambda k, v: F.upper(k))
    return r.select("rec_id", m["INFOCODE"].alias("infocode"), m["PRODUCTNAME"].alias("productname"), m["MBREVENUE"].alias("mbrevenue"))


def event_property(spark: SparkSession, data_dir: str) -> DataFrame:
    """A property of the events' JSON."""
    return table(spark, data_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


def html_cells(spark: SparkSession, data_dir: str) -> DataFrame:
    """The export rendered as HTML tables, read back as cells with their columns spread."""
    esc = lambda c: F.coalesce(c, F.lit(""))
    flat = table(spark, data_dir, "flat_export").select("row_id", F.concat(
        F.lit('<table class="t"><tr><th colspan="2">'), esc(F.col("currency")), F.lit("</th><th>"), esc(F.col("unit")), F.lit("</th></tr>\n<tr>\n<td><b> "), F.regexp_replace(esc(F.col("productname")), "[<>]", ""),
        F.lit(" </b></td><td colspan=1>"), esc(F.col("mbrevenue")), F.lit("</td><td>"), esc(F.col("mbcost")), F.lit("</td></tr></table>")).alias("html"))
    return gr.cells_long(flat.select("row_id", gr.html_grid(F.col("html")).alias("grid")), "row_id")


def _lines(spark: SparkSession, data_dir: str) -> DataFrame:
    return table(spark, data_dir, "doc_lines").where("infocode is not null")


def _names(spark: SparkSession, data_dir: str) -> DataFrame:
    return rc.prior_names(table(spark, data_dir, "flat_export").select("infocode", "productname"))


def html_classified(spark: SparkSession, data_dir: str) -> DataFrame:
    """E2, A9 over grids read from HTML: the headings, first cells and amounts of the export by filing's names."""
    flat = table(spark, data_dir, "flat_export").where("infocode is not null")
    esc = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), "[<>]", "")
    row = lambda *cells: F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>"))
    # laid out by the row's number: down, across, with words of timing, with words of a split, or bare
    words = F.get(F.array(F.lit("隨時間"), F.lit("按產品"), F.lit("時間點(註)"), F.lit("附註"), F.lit("")), (F.col("row_id") % 5).cast("int"))
    down = F.concat(row(words, F.lit("2024")), row(esc(F.col("productname")), esc(F.col("mbrevenue"))), row(esc(F.col("currency")), esc(F.col("mbcost"))))
    across = F.concat(row(words, esc(F.col("productname")), esc(F.col("currency"))), row(F.lit("隨時間"), esc(F.col("mbrevenue")), esc(F.col("mbcost"))))
    made = flat.select("infocode", F.col("row_id").cast("string").alias("table_id"), gr.html_grid(F.when(F.col("row_id") % 2 == 0, down).otherwise(across)).alias("grid"))
    named = gr.with_named(made, _names(spark, data_dir))
    return named.select("table_id", gr.classify(F.col("grid"), F.lit(""), F.col("named")).alias("classification"))


def grids_classified(spark: SparkSession, data_dir: str) -> DataFrame:
    """How each table of each section holds products, by the section's title and the filing's names."""
    shared_dir(spark)
    sectioned = rc.sectioned_lines(_lines(spark, data_dir)).drop("text").checkpoint()  # used twice; cuts the plan
    titles = sectioned.select(*rc.SECTION, "title").distinct()
    made = rc.section_grids(rc.section_words(sectioned), titles).join(titles, rc.SECTION).select("infocode", "table_id", "grid", "title").checkpoint()
    g = gr.with_named(made, _names(spark, data_dir))
    return g.select("table_id", F.size("grid").alias("n_rows"), gr.classify(F.col("grid"), F.col("title"), F.col("named")).alias("classification"))


def _extracted(spark: SparkSession, data_dir: str) -> rc.Extraction:
    shared_dir(spark)
    return rc.extract(table(spark, data_dir, "doc_lines"), table(spark, data_dir, "flat_export").select("infocode", "productname", "mbcost", "gross_profit"))


def grid_facts(spark: SparkSession, data_dir: str) -> DataFrame:
    """The merged facts of the chosen section of each filing."""
    return _extracted(spark, data_dir).facts.select("doc", "table_id", "fact_no", "metric", "product_name", "amount", "start_date", "end_date", "currency", "unit")


def grid_metrics(spark: SparkSession, data_dir: str) -> DataFrame:
    """Cost and gross profit of the facts' products from other tables of the filing."""
    return _extracted(spark, data_dir).metrics.drop("place")


def extracted_records(spark: SparkSession, data_dir: str) -> DataFrame:
    """From the lines of all filings to their records."""
    return _extracted(spark, data_dir).records


def extraction_outcomes(spark: SparkSession, data_dir: str) -> DataFrame:
    """How the extraction of each filing went."""
    return rc.outcomes(table(spark, data_dir, "doc_lines"), _extracted(spark, data_dir))


def related_sections(spark: SparkSession, data_dir: str) -> DataFrame:
    """Sections that may hold the table of revenue."""
    return se.related_sections(se.section_marks(ln.sectionize(_lines(spark, data_dir)))).select("infocode", "section_id", "title")


def _hits(spark: SparkSession, data_dir: str) -> DataFrame:
    sectioned = ln.sectionize(_lines(spark, data_dir))
    words = la.words_of_lines(sectioned)
    marks = la.table_like(words, se.related_sections(se.section_marks(sectioned))).where("is_table")
    names = _names(spark, data_dir)
    hits = se.name_hits(words.join(marks.select(*rc.SECTION), rc.SECTION, "left_semi"), names)
    counts = names.groupBy("infocode").agg(F.count("*").cast("int").alias("n_names"))
    return marks.join(hits, rc.SECTION, "left").join(counts, "infocode", "left").fillna(0, ["hits", "exact_hits", "n_names"])


def section_hits(spark: SparkSession, data_dir: str) -> DataFrame:
    """Hits of the filing's names in its related sections that look like tables."""
    return _hits(spark, data_dir).select("infocode", "section_id", "title", "n_names", "hits", "exact_hits")


def best_sections(spark: SparkSession, data_dir: str) -> DataFrame:
    """The section chosen for each filing."""
    return se.best_sections(_hits(spark, data_dir))


def set_operations(spark: SparkSession, data_dir: str) -> DataFrame:
    """Codes in either, both and one of two tables, and the multiset difference."""
    a, b = (table(spark, data_dir, x).select("infocode") for x in ("no_gt_hit_codes", "flat_export"))
    b = b.where("infocode is not null")
    one = lambda df, k: df.agg(F.count("*").alias("n")).select(F.lit(k).alias("operation"), "n")
    return one(a.union(b).distinct(), "union").union(one(a.intersect(b), "intersect")).union(one(a.subtract(b), "except")).union(one(b.exceptAll(a), "except_all"))


def top_amounts(spark: SparkSession, data_dir: str) -> DataFrame:
    """O2, O3: the three largest orders of each customer, a top-k report."""
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, data_dir, "orders").withColumn("rank", F.row_number().over(w)).where("rank <= 3").select("o_custkey", "rank", "o_orderkey", "o_totalprice")


def year_columns(spark: SparkSession, data_dir: str) -> DataFrame:
    """Revenue by product type pivoted to years and unpivoted again, the last year of each marked."""
    o = table(spark, data_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    li = table(spark, data_dir, "lineitem").select("l_orderkey", "l_partkey", (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("rev"))
    part = table(spark, data_dir, "part").select("p_partkey", "p_type")
    long = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(part, li["l_partkey"] == part["p_partkey"]).groupBy("p_type", "year").agg(F.sum("rev").alias("revenue"))
    last = F.max("year").over(Window.partitionBy("p_type"))
    return long.select("p_type", "year", F.round("revenue", 2).alias("revenue"), (F.col("year") == last).alias("is_last"))


def user_sessions(spark: SparkSession, data_dir: str) -> DataFrame:
    """Extension: sessions of users by gaps of half an hour, as the streaming ingest makes them."""
    return sessions(table(spark, data_dir, "events"))


def gap_groups(spark: SparkSession, data_dir: str) -> DataFrame:
    """The same grouping by gaps as rows and cells use, over the events of users."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ts = F.unix_micros(F.col("ts").cast("timestamp"))
    e = table(spark, data_dir, "events").withColumn("_new", F.coalesce((ts - F.lag(ts).over(w) > 1_800_000_000).cast("int"), F.lit(0)))
    return e.select("event_id", "user_id", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("group_no"))


QUERIES = {
    "e_export_groups": export_groups, "e_latest_runs": latest_runs, "e_inventory_roll_up": inventory_roll_up, "e_accepted": accepted, "e_status_ladder": status_ladder, "e_json_fields": json_fields,
    "e_event_property": event_property, "e_html_cells": html_cells, "t_grids_classified": grids_classified, "t_grid_facts": grid_facts, "t_related_sections": related_sections, "t_section_hits": section_hits,
    "t_best_sections": best_sections, "t_html_classified": html_classified, "t_grid_metrics": grid_metrics, "r_records": extracted_records, "r_outcomes": extraction_outcomes, "o_set_operations": set_operations, "o_top_amounts": top_amounts, "o_year_columns": year_columns, "o_user_sessions": user_sessions, "o_gap_groups": gap_groups,
}

_SECTION_TEXTS = f"""(SELECT infocode, section_id, arg_min([coalesce(text, '')], line_no)[1] AS title, string_agg(coalesce(text, ''), '/' ORDER BY line_no) AS text FROM {doc._SECTIONED} GROUP BY 1, 2)"""
_m = lambda c, words: f"regexp_matches({c}, '{'|'.join(words)}')"
_RELATED = f"""(SELECT * FROM {_SECTION_TEXTS} WHERE NOT {_m("title", se.NEVER)} AND NOT ({_m("title", se.BALANCE)} AND NOT contains(title, '分部') AND NOT contains(text, '分部'))
  AND NOT ({_m("title", se.REVIEW)} AND NOT {_m("text", se.REVIEWED)}) AND {_m("title", se.NEEDED)} AND NOT {_m("title", se.REGIONS)})"""
_BLANK = r"'^\s+|\s+$', '', 'g'"
_NARROW = sc._fill(sc._FOLD, "name")
_PART = lambda c: f"string_split(string_split({c}, '-')[-1], ':')[1]"
_PRIOR = f"""(SELECT *, replace(regexp_replace(name, {_BLANK}), '之', '') AS whole, {_PART(f"replace(regexp_replace(name, {_BLANK}), '之', '')")} AS part, string_split_regex({_PART(f"regexp_replace(name, {_BLANK})")}, '[╱/]')[1] AS exact,
    string_split(replace({sc._fill(sc._FOLD, f"regexp_replace(name, {_BLANK})")}, ' ', ''), '') AS letters FROM (
  SELECT DISTINCT infocode, CASE WHEN regexp_matches({_NARROW}, '[╱/]') THEN regexp_replace(string_split_regex({_NARROW}, '[╱/]')[1], {_BLANK}) ELSE {_NARROW} END AS name FROM (
    SELECT infocode, regexp_replace(productname, {_BLANK}) AS name FROM flat_export WHERE infocode IS NOT NULL AND productname IS NOT NULL)
  WHERE name NOT IN ('', '合计', '合計') AND NOT regexp_matches(name, '合計|合计|總計|总计|總額|总额|total|公司')))"""
_HITS = f"""
w AS (SELECT s.infocode, s.section_id, w.text, replace(replace(replace(w.text, ' ', ''), chr(10), ''), '之', '') AS bare FROM {lap._WORDS} w JOIN {doc._SECTIONED} s ON w.line_id = s.line_id),
x AS (SELECT infocode, section_id, count(*) FILTER (length(regexp_replace(text, '[\\(（]\\d[\\)）]', '', 'g')) >= 3 AND {lap._NUMERIC.replace("{0}", "regexp_replace(text, '[\\(（]\\d[\\)）]', '', 'g')")} AND NOT regexp_matches(text, '[一-鿿]')) AS n_numbers FROM w GROUP BY 1, 2),
m AS (SELECT r.* FROM {_RELATED} r LEFT JOIN x ON r.infocode = x.infocode AND r.section_id = x.section_id WHERE coalesce(n_numbers, 0) > 3 OR regexp_matches(text, '千港元|万港元')),
l AS (SELECT infocode, section_id, list(DISTINCT w.text) AS words, list(DISTINCT bare) AS bares, list_distinct(flatten(list(string_split(w.text, '')))) AS letters FROM w JOIN m USING (infocode, section_id) GROUP BY 1, 2),
p AS {_PRIOR},
h AS (SELECT l.infocode, l.section_id,
    count(*) FILTER (part <> '' AND len(list_filter(bares, lambda b: contains(b, part))) > 0 OR length(whole) > 10 AND contains(whole, '-') AND list_has_all(l.letters, string_split(whole, ''))) AS a,
    count(*) FILTER (exact <> '' AND list_contains(words, exact)) AS b, count(*) FILTER (p.letters[1] <> '' AND list_has_all(l.letters, p.letters)) AS c
  FROM l JOIN p ON l.infocode = p.infocode GROUP BY 1, 2),
hits AS (SELECT m.infocode, m.section_id, title, text, cast(coalesce(n_names, 0) AS int) AS n_names, cast(coalesce(greatest(a, b, c), 0) AS int) AS hits, cast(coalesce(b, 0) AS int) AS exact_hits
  FROM m LEFT JOIN h ON m.infocode = h.infocode AND m.section_id = h.section_id LEFT JOIN (SELECT infocode, count(*) AS n_names FROM p GROUP BY 1) k ON m.infocode = k.infocode)"""
_TIER = "CASE " + " ".join(f"WHEN regexp_matches(title, '{x.replace(chr(92) + '（', '（')}') THEN {k}" for k, x in enumerate(se.TIERS)) + f" ELSE {len(se.TIERS)} END"
_SAID = """(regexp_replace(x, '^\\s+|\\s+$', '', 'g') <> '' AND (x IN ('-', '——') OR regexp_replace(CASE WHEN NOT contains(x, '-') AND contains(x, '(') AND contains(x, ')') THEN '-' || x ELSE x END, '[^\\d.-]', '', 'g') = ''))"""
_CELLS = """(SELECT infocode, cast(row_id AS varchar) AS table_id, row_no, col_no, regexp_replace(x, '^\\s+|\\s+$', '', 'g') AS x FROM (
  SELECT infocode, row_id, unnest([0, 0, 1, 1, 2, 2]) AS row_no, unnest([0, 1, 0, 1, 0, 1]) AS col_no, unnest([w, '2024', n, r, c, k]) AS x FROM f WHERE row_id % 2 = 0
  UNION ALL SELECT infocode, row_id, unnest([0, 0, 0, 1, 1, 1]), unnest([0, 1, 2, 0, 1, 2]), unnest([w, n, c, '隨時間', r, k]) FROM f WHERE row_id % 2 = 1))"""
_SESSION = """(SELECT *, sum(CASE WHEN ts - prev > INTERVAL 30 MINUTE THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS g
  FROM (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events))"""

ORACLES = {
    "e_export_groups": "SELECT CASE WHEN trim(infocode, ' ') <> '' THEN trim(infocode, ' ') END AS infocode, count(*) AS n_rows, min(row_id) AS first_id, max(row_id) AS last_id FROM flat_export GROUP BY 1",
    "e_latest_runs": "SELECT infocode, loaded_at, category, local_rows, gt_rows FROM no_gt_hit_codes QUALIFY row_number() OVER (PARTITION BY infocode ORDER BY loaded_at DESC) = 1",
    "e_inventory_roll_up": "SELECT lower(category) AS category, pipeline_stage, count(DISTINCT infocode) AS n_documents, cast(sum(local_rows) AS bigint) AS extracted, cast(sum(gt_rows) AS bigint) AS expected FROM no_gt_hit_codes GROUP BY 1, 2",
    "e_accepted": """
WITH n AS (SELECT infocode, category, message FROM no_gt_hit_codes_copy WHERE infocode IS NOT NULL AND (coalesce(trim(category, ' ') <> '', false) OR coalesce(trim(message, ' ') <> '', false)))
SELECT infocode, category, message FROM no_gt_hit_codes WHERE infocode NOT IN (SELECT infocode FROM n) UNION ALL SELECT * FROM n""",
    "e_status_ladder": """
SELECT infocode, loaded_at, CASE WHEN a = 0 AND b = 0 THEN 'none' WHEN a = 0 THEN 'empty' WHEN a < b THEN 'missing' WHEN a > b THEN 'extra' ELSE 'even' END AS status
FROM (SELECT *, coalesce(local_rows, 0) AS a, coalesce(gt_rows, 0) AS b FROM no_gt_hit_codes)""",
    "e_json_fields": "SELECT rec_id, "
    + ", ".join(f"coalesce(json_extract_string(payload, '$.{f.upper()}'), json_extract_string(payload, '$.{f}'), json_extract_string(payload, '$.{f.capitalize()}')) AS {f}" for f in ("infocode", "productname", "mbrevenue"))
    + " FROM raw_export WHERE ltrim(payload) LIKE '{%'",
    "e_event_property": "SELECT event_id, cast(json_extract_string(props, '$.k') AS int) AS k FROM events",
    "e_html_cells": r"""
SELECT row_id, row_no, col_no, regexp_replace(regexp_replace(text, '<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g') AS text FROM (
  SELECT row_id, 0 AS row_no, unnest([0, 1, 2]) AS col_no, unnest([coalesce(currency, ''), coalesce(currency, ''), coalesce(unit, '')]) AS text FROM flat_export
  UNION ALL SELECT row_id, 1, unnest([0, 1, 2]), unnest([regexp_replace(coalesce(productname, ''), '[<>]', '', 'g'), coalesce(mbrevenue, ''), coalesce(mbcost, '')]) FROM flat_export)""",
    "t_related_sections": f"SELECT infocode, section_id, title FROM {_RELATED}",
    "t_section_hits": f"WITH {_HITS} SELECT infocode, section_id, title, n_names, hits, exact_hits FROM hits",
    "t_best_sections": f"""
WITH {_HITS}, s AS (SELECT *, n_names > 0 AND hits >= n_names AS whole_list FROM hits), t AS (SELECT *, count(*) FILTER (whole_list) OVER (PARTITION BY infocode) AS n_full, max(hits) OVER (PARTITION BY infocode) AS most FROM s),
u AS (SELECT *, CASE WHEN n_full > 0 THEN whole_list ELSE hits = most END AS candidate FROM t), v AS (SELECT *, count(*) FILTER (candidate) OVER (PARTITION BY infocode) AS n, {_TIER} AS tier, {_m("title", se.PROFIT_TITLES)} AS pl FROM u),
y AS (SELECT *, CASE WHEN n_full = 1 AND whole_list THEN 1 WHEN n_full > 1 AND whole_list AND pl AND {_m("text", se.REVENUE_WORDS)} AND {_m("text", se.COST_WORDS)} AND {_m("text", se.GROSS_WORDS)} THEN 2
  WHEN n_names = 1 AND n > 1 AND pl THEN 3 WHEN candidate AND n > 1 AND tier < {len(se.TIERS)} THEN 4 WHEN candidate THEN 5 END AS rule FROM v)
SELECT infocode, section_id, title, hits, rule, whole_list OR (n_names > 0 AND exact_hits >= n_names) AS all_names FROM y WHERE rule IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY infocode ORDER BY rule, CASE WHEN rule = 4 THEN tier ELSE 0 END, section_id) = 1""",
    "t_html_classified": f"""
WITH f AS (SELECT infocode, row_id, {", ".join(f"regexp_replace(coalesce({c}, ''), '[<>]', '', 'g') AS {a}" for c, a in (("productname", "n"), ("mbrevenue", "r"), ("currency", "c"), ("mbcost", "k")))},
  ['隨時間', '按產品', '時間點(註)', '附註', ''][row_id % 5 + 1] AS w FROM flat_export WHERE infocode IS NOT NULL),
c AS (SELECT *, replace(lower(replace(replace(replace(x, ' ', ''), '\\n', ''), chr(10), '')), '之', '') AS bare, {_SAID} AS said, {_m("x", gr.TIMING_WORDS)} AS timing FROM {_CELLS}), p AS {_PRIOR},
d AS (SELECT DISTINCT infocode, bare FROM c), h AS (SELECT DISTINCT d.infocode, d.bare FROM d JOIN p ON d.infocode = p.infocode WHERE (part <> '' AND contains(bare, part)) OR (length(whole) > 10 AND contains(whole, '-') AND list_has_all(string_split(bare, ''), string_split(whole, '')))),
m AS (SELECT c.*, h.bare IS NOT NULL AS hit FROM c LEFT JOIN h ON c.infocode = h.infocode AND c.bare = h.bare),
v AS (SELECT table_id, count(DISTINCT [a.row_no, a.col_no]) FILTER (a.row_no = b.row_no) AS rv, count(DISTINCT [a.row_no, a.col_no]) FILTER (a.col_no = b.col_no) AS cv
  FROM m a JOIN m b USING (table_id) WHERE a.timing AND b.said AND a.x <> b.x AND (a.row_no = b.row_no OR a.col_no = b.col_no) GROUP BY 1),
t AS (SELECT table_id, count(*) FILTER (said AND row_no = 0) AS rt, count(*) FILTER (said AND col_no = 0) AS ct, bool_or({_m("x", gr.SPLIT_WORDS)}) AS split FROM m GROUP BY 1),
k AS (SELECT t.*, coalesce(rv, 0) AS rv, coalesce(cv, 0) AS cv, r, c FROM t LEFT JOIN v USING (table_id) JOIN (SELECT table_id, max(n) AS r FROM (SELECT table_id, row_no, count(*) FILTER (hit) AS n FROM m GROUP BY 1, 2) GROUP BY 1) USING (table_id)
  JOIN (SELECT table_id, max(n) AS c FROM (SELECT table_id, col_no, count(*) FILTER (hit) AS n FROM m GROUP BY 1, 2) GROUP BY 1) USING (table_id))
SELECT table_id, CASE WHEN r + c > 0 THEN CASE WHEN r = c AND ct >= 6 AND ct >= 3 * rt THEN 'product_in_columns' WHEN r >= c THEN 'product_in_rows' ELSE 'product_in_columns' END
  WHEN rv + cv > 0 THEN CASE WHEN rv >= cv THEN 'product_in_rows' ELSE 'product_in_columns' END WHEN split AND (rt >= 2 OR ct >= 2) THEN CASE WHEN rt >= ct THEN 'product_in_rows' ELSE 'product_in_columns' END
  WHEN rt >= 2 AND rt > ct THEN 'product_in_rows' WHEN ct >= 2 AND ct > rt THEN 'product_in_columns' ELSE 'unsupported' END AS classification FROM k""",
    "o_set_operations": """
WITH a AS (SELECT infocode FROM no_gt_hit_codes), b AS (SELECT infocode FROM flat_export WHERE infocode IS NOT NULL)
SELECT 'union' AS operation, (SELECT count(*) FROM (SELECT * FROM a UNION SELECT * FROM b)) AS n UNION ALL SELECT 'intersect', (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b))
UNION ALL SELECT 'except', (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) UNION ALL SELECT 'except_all', (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a))""",
    "o_top_amounts": "SELECT o_custkey, cast(rank AS int) AS rank, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3",
    "o_year_columns": """
SELECT p_type, cast(year AS int) AS year, round(revenue, 2) AS revenue, year = max(year) OVER (PARTITION BY p_type) AS is_last FROM (
  SELECT p_type, year(o_orderdate) AS year, sum(l_extendedprice * (1 - l_discount)) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)""",
    "o_user_sessions": f"SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 30 MINUTE AS ended, count(*) AS n_events, round(sum(value), 2) AS total FROM {_SESSION} GROUP BY user_id, g",
    "o_gap_groups": f"SELECT event_id, user_id, cast(g AS bigint) AS group_no FROM {_SESSION}",
}
