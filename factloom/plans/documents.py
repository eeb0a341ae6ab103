"""Queries of lines, sections and page layout, with their reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import lines as ln
from ..sources.tables import table


def _lines(spark: SparkSession, data_dir: str) -> DataFrame:
    return table(spark, data_dir, "doc_lines").where("infocode is not null")


def content_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    """F1 to F4 over all lines."""
    return ln.content_lines(_lines(spark, data_dir)).select("line_id", "infocode", "page_number", "line_no")


def title_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    """F6 over all lines."""
    return _lines(spark, data_dir).select("line_id", ln.title_flag(F.col("text"), F.col("x0")).alias("is_title"))


def sections(spark: SparkSession, data_dir: str) -> DataFrame:
    """W1 over all lines: the section of each."""
    return ln.sectionize(_lines(spark, data_dir)).select("line_id", "section_id")


def section_list(spark: SparkSession, data_dir: str) -> DataFrame:
    """The sections of all documents."""
    return ln.section_table(ln.sectionize(_lines(spark, data_dir)))


def sections_merged(spark: SparkSession, data_dir: str) -> DataFrame:
    """The sections after short headings went to the next."""
    return ln.merged_sections(section_list(spark, data_dir))


def readable_documents(spark: SparkSession, data_dir: str) -> DataFrame:
    """F5 over all documents."""
    return ln.readable_documents(_lines(spark, data_dir))


def title_kinds(spark: SparkSession, data_dir: str) -> DataFrame:
    """Kinds of headings and how many sections have each, with the pages they are on."""
    kinds = section_list(spark, data_dir).select("infocode", t.title_kind(F.col("title")).alias("kind"), "n_lines", "page_from")
    return kinds.groupBy("infocode", "kind").agg(F.count("*").alias("n_sections"), F.sum("n_lines").alias("n_lines"), t.page_range(F.collect_set("page_from")).alias("pages"))


QUERIES = {
    "d_title_kinds": title_kinds, "d_content_lines": content_lines, "d_title_lines": title_lines, "d_sections": sections, "d_section_list": section_list, "d_sections_merged": sections_merged,
    "d_readable_documents": readable_documents,
}

_R = ln.PageRules()


def _q(text: str) -> str:
    return text.replace("'", "''")


def _count(ch: str) -> str:
    return f"(length(t) - length(replace(t, '{ch}', '')))"


_HAN = "regexp_matches(t, '[一-鿿]')"
_TITLE = rf"""CASE WHEN t = '' OR length(regexp_replace(t, '[^\d]', '', 'g')) > 5
    OR regexp_matches(regexp_replace(regexp_replace(t, '^\s+|\s+$', '', 'g'), '[ ()]', '', 'g'), '^[+-]?(\d{{1,3}}(,\d{{3}})*|\d+)(\.\d+)?$') THEN false
  WHEN NOT {_HAN} AND NOT contains(t, 'revenue') THEN false
  WHEN regexp_matches(t, '\d{{3,}}$') THEN false
  WHEN NOT regexp_matches(t, '[\dA-Za-z,.。]') AND {_HAN} AND length(t) <= {ln.TITLES.short} AND x0 < {ln.TITLES.short_left_of} THEN true
  WHEN regexp_matches(t, '{_q(ln._one_of(ln.TITLES.sure))}') THEN true
  WHEN x0 > {ln.TITLES.left_of} THEN false
  WHEN regexp_matches(t, '{_q(ln._one_of(ln.TITLES.never))}') THEN false
  WHEN regexp_matches(t, '^[一二三四五六七八九十][一-鿿]+') AND length(t) > 5 AND NOT regexp_matches(t[1:5], '[!-/:-@\[-`{{-~]') THEN false
  WHEN {_count(",")} >= 3 OR {_count("、")} >= 3 OR {_count(".")} >= 3 OR ({_count(".")} >= 2 AND length(regexp_replace(t, '[^\d]', '', 'g')) >= 5) THEN false
  ELSE regexp_matches(t, '{_q(ln._one_of(ln.TITLES.likely))}') END"""
_FLAGGED = f"(SELECT *, {_TITLE} AS is_title FROM (SELECT *, coalesce(text, '') AS t FROM doc_lines WHERE infocode IS NOT NULL))"
_SECTIONED = f"(SELECT *, cast(sum(CASE WHEN is_title THEN 1 ELSE 0 END) OVER (PARTITION BY infocode ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS bigint) AS section_id FROM {_FLAGGED})"

_PAGE_RUNS = """(SELECT infocode, kind, CASE WHEN min(p) = max(p) THEN cast(min(p) AS varchar) ELSE min(p) || '-' || max(p) END AS r, min(p) AS lo FROM (
  SELECT *, p - row_number() OVER (PARTITION BY infocode, kind ORDER BY p) AS g FROM (SELECT DISTINCT infocode, kind, page_from AS p FROM k)) GROUP BY infocode, kind, g)"""

ORACLES = {
    "d_title_kinds": f"""
WITH s AS (SELECT infocode, section_id, arg_min([text], line_no)[1] AS title, count(*) AS n_lines, min(page_number) AS page_from FROM {_SECTIONED} GROUP BY 1, 2),
k AS (SELECT infocode, n_lines, page_from, CASE WHEN title IS NULL THEN NULL WHEN regexp_matches(title, '損益表|损益表|收益表|綜合損益|综合损益|全面收益|全面收入|虧損表|亏损表') THEN 'profit_loss' WHEN contains(title, '分部') THEN 'segment'
  WHEN regexp_matches(title, '產品|产品') THEN 'product' WHEN regexp_matches(title, '收入|收益|營業額|营业额') THEN 'revenue' WHEN regexp_matches(title, '附註|附注') THEN 'note' ELSE 'other' END AS kind FROM s)
SELECT a.infocode, a.kind, n_sections, n_lines, pages FROM (SELECT infocode, kind, count(*) AS n_sections, cast(sum(n_lines) AS bigint) AS n_lines FROM k GROUP BY 1, 2) a
JOIN (SELECT infocode, kind, string_agg(r, ', ' ORDER BY lo) AS pages FROM {_PAGE_RUNS} GROUP BY 1, 2) b ON a.infocode = b.infocode AND a.kind IS NOT DISTINCT FROM b.kind""",
    "d_content_lines": rf"""
WITH a AS (SELECT *, coalesce(text, '') AS t FROM doc_lines WHERE infocode IS NOT NULL),
b AS (SELECT *, bool_or(coalesce(top < {_R.page_mark_above} AND contains(t, '{_R.page_mark}'), false)) OVER (PARTITION BY infocode, page_number) AS gone FROM a),
c AS (SELECT *, row_number() OVER (PARTITION BY infocode, page_number ORDER BY line_no DESC) AS last_no FROM b WHERE NOT gone AND NOT coalesce(regexp_matches(t, '^\d')
  AND (bottom > {_R.footnote_below} AND regexp_matches(t, '{"|".join(_R.footnote_marks)}') OR bottom > {_R.low_footnote_below} AND regexp_matches(t, '{"|".join(_R.low_footnote_marks)}')), false)),
d AS (SELECT *, row_number() OVER (PARTITION BY infocode, page_number ORDER BY line_no) AS first_no FROM c WHERE NOT (last_no = 1 AND bottom > {_R.number_below} AND regexp_matches(t, '^\d+$')))
SELECT line_id, infocode, page_number, line_no FROM d WHERE NOT (first_no = 1 AND top < {_R.header_above} AND contains(t, '{_R.header_mark}'))""",
    "d_title_lines": f"SELECT line_id, is_title FROM {_FLAGGED}",
    "d_sections": f"SELECT line_id, section_id FROM {_SECTIONED}",
    "d_section_list": rf"""
SELECT infocode, section_id, min(line_no) AS first_line, arg_min(t0, line_no)[1] AS title, count(*) AS n_lines, bool_or(coalesce(regexp_matches(text, '\d{{1,3}}(,\d{{3}})+'), false)) AS has_grouped,
  min(page_number) AS page_from, max(page_number) AS page_to
FROM (SELECT *, [text] AS t0 FROM {_SECTIONED}) GROUP BY infocode, section_id""",
    "d_readable_documents": "SELECT infocode, bool_or(coalesce(regexp_matches(text, '[一-鿿]'), false)) AS readable FROM doc_lines WHERE infocode IS NOT NULL GROUP BY infocode",
}
