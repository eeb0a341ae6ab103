"""Queries of page layout over the words of all lines, with their reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import layout as la
from ..operators import lines as ln
from ..sources.tables import table
from . import documents as doc

_G = la.Geometry()


def _lines(spark: SparkSession, data_dir: str) -> DataFrame:
    return table(spark, data_dir, "doc_lines").where("infocode is not null")


def words(spark: SparkSession, data_dir: str) -> DataFrame:
    """Words of all lines with their boxes."""
    return la.words_of_lines(_lines(spark, data_dir))


def boxed_words(spark: SparkSession, data_dir: str) -> DataFrame:
    """Words inside the boxes of the sections of their page."""
    boxes = la.section_boxes(ln.sectionize(_lines(spark, data_dir)))
    return la.words_in_boxes(words(spark, data_dir), boxes).select("line_id", "word_no", "section_id")


def rows_of_words(spark: SparkSession, data_dir: str) -> DataFrame:
    """The row of each word on its page."""
    return la.word_rows(words(spark, data_dir)).select("line_id", "word_no", F.col("row_no").cast("bigint").alias("row_no"))


def row_marks(spark: SparkSession, data_dir: str) -> DataFrame:
    """Gaps and marks of rows of words."""
    rows = la.row_table(la.word_rows(words(spark, data_dir)))
    return rows.select(*la.PAGE, F.col("row_no").cast("bigint").alias("row_no"), F.round("gap", 2).alias("gap"), "numeric", "narrative")


def blocks(spark: SparkSession, data_dir: str) -> DataFrame:
    """The block of each row."""
    return la.row_blocks(la.row_table(la.word_rows(words(spark, data_dir)))).select(*la.PAGE, F.col("row_no").cast("bigint").alias("row_no"), F.col("block_no").cast("bigint").alias("block_no"))


def grids(spark: SparkSession, data_dir: str) -> DataFrame:
    """The grids of all pages."""
    made = la.assemble_grids(la.row_blocks(la.row_table(la.word_rows(words(spark, data_dir)))))
    return made.select(*la.PAGE, "block_no", "n_rows", "n_cols", "n_numbers", F.to_json("grid").alias("grid"))


def edge_clusters(spark: SparkSession, data_dir: str) -> DataFrame:
    """Clusters of the right edges of numbers on each page."""
    numbers = words(spark, data_dir).where(la.is_number(F.col("text")))
    return numbers.groupBy(*la.PAGE).agg(F.to_json(F.transform(la.cluster_edges(F.collect_list("x1"), _G.anchor), lambda v: F.round(v, 3))).alias("anchors"))


def left_edges(spark: SparkSession, data_dir: str) -> DataFrame:
    """Steps between the left edges of Chinese words on each page."""
    texts = words(spark, data_dir).where(la.has_han(F.col("text")))
    return texts.groupBy(*la.PAGE).agg(la.text_edges(F.collect_set("x0")).alias("e")).select(*la.PAGE, F.explode("e").alias("edge"))


def tables_of_sections(spark: SparkSession, data_dir: str) -> DataFrame:
    """Which sections look like tables, and their numbers."""
    lines = ln.sectionize(_lines(spark, data_dir))
    named = F.max(F.coalesce(F.col("text").rlike("千港元|万港元"), F.lit(False))).alias("names_unit")
    sections = lines.groupBy("infocode", "section_id").agg(named)
    own = words(spark, data_dir).join(lines.select("line_id", "section_id"), "line_id")
    return la.table_like(own, sections)


QUERIES = {
    "g_words": words, "g_boxed_words": boxed_words, "g_rows_of_words": rows_of_words, "g_row_marks": row_marks, "g_blocks": blocks, "g_grids": grids,
    "g_edge_clusters": edge_clusters, "g_left_edges": left_edges, "g_tables_of_sections": tables_of_sections,
}

_WORDS = r"""(SELECT infocode, page_number, line_id, word_no, word AS text, round(x0 + start * step, 2) AS x0, round(x0 + (start + length(word)) * step, 2) AS x1, top, bottom
  FROM (SELECT *, coalesce(cast(sum(length(word) + 1) OVER (PARTITION BY infocode, page_number, line_id ORDER BY word_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS int), 0) AS start
    FROM (SELECT infocode, page_number, line_id, x0, top, bottom, (x1 - x0) / length(text) AS step, unnest(parts) AS word, cast(generate_subscripts(parts, 1) - 1 AS int) AS word_no
      FROM (SELECT *, regexp_split_to_array(text, '\s+') AS parts FROM doc_lines WHERE infocode IS NOT NULL AND length(text) > 0)))
  WHERE length(word) > 0)"""
_ROWED = f"""(SELECT *, cast(sum(new) OVER (PARTITION BY infocode, page_number ORDER BY top, x0, line_id, word_no ROWS UNBOUNDED PRECEDING) AS bigint) AS row_no
  FROM (SELECT *, CASE WHEN abs(top - lag(top) OVER (PARTITION BY infocode, page_number ORDER BY top, x0, line_id, word_no)) > {_G.row} THEN 1 ELSE 0 END AS new FROM {_WORDS}))"""
_NUMERIC = r"regexp_matches(regexp_replace(regexp_replace({0}, '^\s+|\s+$', '', 'g'), '[ ()]', '', 'g'), '^[+-]?(\d{1,3}(,\d{3})*|\d+)(\.\d+)?$')"


def _fold(c: str) -> str:
    from .scalars import _FOLD

    return _FOLD.replace("{0}", c)


_ROWS = f"""(SELECT infocode, page_number, row_no, numeric, length(t) > {_G.narrative} OR (length(t) > {_G.sentence} AND regexp_matches(t, '[。；：，]')) AS narrative,
    coalesce(greatest(0.0, first_top - lag(last_bottom) OVER (PARTITION BY infocode, page_number ORDER BY row_no)), 0.0) AS gap
  FROM (SELECT infocode, page_number, row_no, bool_or({_NUMERIC.replace("{0}", "f")}) AS numeric, string_agg(f, '' ORDER BY x0, word_no) AS t,
      arg_min(top, [x0, word_no]) AS first_top, arg_max(bottom, [x0, word_no]) AS last_bottom
    FROM (SELECT *, {_fold("text")} AS f FROM {_ROWED}) GROUP BY 1, 2, 3)
  WHERE NOT regexp_matches(t, '^[–\\-—\\s]*\\d+[–\\-—\\s]*$'))"""

ORACLES = {
    "g_words": f"SELECT * FROM {_WORDS}",
    "g_rows_of_words": f"SELECT line_id, word_no, row_no FROM {_ROWED}",
    "g_row_marks": f"SELECT infocode, page_number, row_no, round(gap, 2) AS gap, numeric, narrative FROM {_ROWS}",
    "g_boxed_words": f"""
SELECT w.line_id, w.word_no, b.section_id FROM {_WORDS} w JOIN (
  SELECT infocode, page_number, section_id, min(x0) AS bx0, min(top) AS btop, max(x1) AS bx1, max(bottom) AS bbottom FROM {doc._SECTIONED} GROUP BY 1, 2, 3) b
  ON w.infocode = b.infocode AND w.page_number = b.page_number AND w.x0 >= bx0 - 1e-6 AND w.x1 <= bx1 + 1e-6 AND w.top >= btop - 1e-6 AND w.bottom <= bbottom + 1e-6""",
    "g_left_edges": f"""
SELECT infocode, page_number, x0 AS edge FROM (
  SELECT *, x0 - lag(x0) OVER (PARTITION BY infocode, page_number ORDER BY x0) AS step FROM (SELECT DISTINCT infocode, page_number, x0 FROM {_WORDS} WHERE regexp_matches(text, '[一-鿿]') AND x0 > {_G.text_left}))
WHERE step > {_G.text_step}""",
    "g_tables_of_sections": f"""
SELECT s.infocode, s.section_id, names_unit, coalesce(n, 0) AS n_numbers, coalesce(n, 0) > 3 OR names_unit AS is_table
FROM (SELECT infocode, section_id, bool_or(coalesce(regexp_matches(text, '千港元|万港元'), false)) AS names_unit FROM {doc._SECTIONED} GROUP BY 1, 2) s
LEFT JOIN (SELECT x.infocode, x.section_id, count(*) FILTER (length(w.t) >= 3 AND {_NUMERIC.replace("{0}", "w.t")} AND NOT regexp_matches(w.t, '[一-鿿]')) AS n
  FROM (SELECT line_id, regexp_replace(text, '[\\(（]\\d[\\)）]', '', 'g') AS t FROM {_WORDS}) w JOIN {doc._SECTIONED} x ON w.line_id = x.line_id GROUP BY 1, 2) c
ON s.infocode = c.infocode AND s.section_id = c.section_id""",
}
