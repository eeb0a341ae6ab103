"""Queries of the text-preparation operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from .dedupe import collapse, copies_found
from .encode import count_tokens, encode_texts
from .lookalike import alike_found, build_mapping
from .names import names_found
from .pack import pack
from .subjects import composition, subjects_found


def p1_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """The listed product that each free-entered name means."""
    return names_found(table(spark, data_dir, "flat_export"), table(spark, data_dir, "product_ref"))


def p4_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """Lines of a filing, and names of products, that look the same but differ in characters."""
    return alike_found(*(table(spark, data_dir, t) for t in ("doc_lines", "flat_export", "product_ref")))


def p6_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """Export records that are copies of an earlier one in other notations."""
    return copies_found(table(spark, data_dir, "raw_export"))


def p6_collapsed(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row for each distinct export record with its number of copies."""
    return collapse(table(spark, data_dir, "raw_export"), "rec_id", "payload")


def p7_ids(spark: SparkSession, data_dir: str) -> DataFrame:
    """Token ids of every document."""
    return encode_texts(table(spark, data_dir, "documents"), "doc_id", "text")


def p8_packed(spark: SparkSession, data_dir: str) -> DataFrame:
    """Documents placed into containers of 2,048 tokens."""
    return pack(count_tokens(table(spark, data_dir, "documents"), "doc_id", "text"), "doc_id", "n_tokens", 2048)


def p9_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """Subject areas of the documents without labels."""
    return subjects_found(*(table(spark, data_dir, t) for t in ("documents", "doc_labels", "subject_areas")))


def p9_composition(spark: SparkSession, data_dir: str) -> DataFrame:
    """How many documents each subject area has."""
    return composition(*(table(spark, data_dir, t) for t in ("documents", "doc_labels", "subject_areas")))


QUERIES = {
    "p1_found": p1_found, "p4_found": p4_found, "p6_found": p6_found, "p6_collapsed": p6_collapsed,
    "p7_ids": p7_ids, "p8_packed": p8_packed, "p9_found": p9_found, "p9_composition": p9_composition,
}
_NOISE = r"[\s\p{P}\p{S}\p{Z}\p{C}]+"
_JSON_FIELDS = """SELECT rec_id, k, json_extract_string(payload, '$."' || k || '"') AS v FROM (SELECT rec_id, payload, unnest(json_keys(payload)) AS k FROM raw_export WHERE ltrim(payload) LIKE '{%')"""
_PAIR_FIELDS = r"""SELECT rec_id, regexp_extract(p, '^\s*([\p{L}_][\p{L}\p{N}_ ]*?)\s*[=:]', 1), regexp_replace(p, '^\s*[\p{L}_][\p{L}\p{N}_ ]*?\s*[=:]', '')
  FROM (SELECT rec_id, unnest(regexp_split_to_array(payload, '[;|]')) AS p FROM raw_export WHERE ltrim(payload) NOT LIKE '{%')"""
_CANONICAL = f"""(SELECT rec_id, string_agg(f, chr(10) ORDER BY f) AS canonical FROM (
  SELECT rec_id, regexp_replace(lower(k), '{_NOISE}', '', 'g') || '=' || regexp_replace(lower(v), '{_NOISE}', '', 'g') AS f, regexp_replace(lower(v), '{_NOISE}', '', 'g') AS w FROM ({_JSON_FIELDS} UNION ALL {_PAIR_FIELDS}))
  WHERE w <> '' GROUP BY rec_id)"""



def _look(c: str) -> str:
    """The one form of a text in SQL: single characters by translate, expansions by replace, then composition."""
    mapping = build_mapping()
    quote = lambda x: x.replace("'", "''")
    single = [(a, b) for a, b in mapping.items() if len(b) == 1]
    gone = [a for a, b in mapping.items() if not b]
    out = f"translate({c}, '{quote(''.join(a for a, _ in single) + ''.join(gone))}', '{quote(''.join(b for _, b in single))}')"
    for a, b in mapping.items():
        if len(b) > 1:
            out = f"replace({out}, '{a}', '{quote(b)}')"
    return f"nfc_normalize({out})"


ORACLES: dict[str, str] = {
    "p4_found": f"""
WITH l AS (SELECT line_id, infocode, text, {_look("text")} AS look FROM doc_lines WHERE infocode IS NOT NULL AND text IS NOT NULL), n AS (SELECT row_id, productname, {_look("productname")} AS look FROM flat_export WHERE productname IS NOT NULL)
SELECT 'line' AS kind, a.line_id AS key_a, b.line_id AS key_b FROM l a JOIN l b ON a.infocode = b.infocode AND a.look = b.look AND a.line_id < b.line_id AND a.text <> b.text
UNION ALL SELECT 'name', ref_id, row_id FROM n JOIN (SELECT ref_id, canon_name, {_look("canon_name")} AS look FROM product_ref) r ON n.look = r.look AND productname <> canon_name""",
    "p6_found": f"SELECT keep_id, rec_id FROM (SELECT rec_id, min(rec_id) OVER (PARTITION BY canonical) AS keep_id FROM {_CANONICAL}) WHERE rec_id <> keep_id",
    "p6_collapsed": f"SELECT min(rec_id) AS keep_id, count(*) AS n_copies, canonical FROM {_CANONICAL} GROUP BY canonical",
}
