"""Rows that a language model gave as text: read out of it, checked, and made facts.

The service itself isn't part of this package; its answers come as a column of text.
"""

from __future__ import annotations

import ast
import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import numbers as n
from ..functions import periods as p
from ..functions import text as t
from .facts import first_facts
from .grids import METRIC, REVENUE_LABEL, TOTAL
from .linkage import containing

FIELDS = ("product_name", "period", "amount", "unit", "currency")
_ROW = T.StructType([T.StructField("is_object", T.BooleanType()), *[T.StructField(f, T.StringType()) for f in FIELDS]])


def first_list(text: str) -> list:
    """The first bracketed list in a text, as JSON or as a Python literal; empty when there is none.

    Fences of code are dropped. Brackets are counted wherever they stand, so a list with one inside a quoted text
    may end too early and then gives nothing.
    """
    bare = re.sub(r"(?i)```(?:json)?", "", text)
    start, depth = bare.find("["), 0
    if start < 0:
        return []
    for m in re.finditer(r"[\[\]]", bare[start:]):
        depth += 1 if m[0] == "[" else -1
        if depth == 0:
            piece = bare[start : start + m.end()]
            for read in (json.loads, ast.literal_eval):
                try:
                    found = read(piece)
                except (ValueError, SyntaxError, RecursionError, MemoryError):
                    continue
                return found if isinstance(found, list) else []
            return []
    return []


@F.pandas_udf(T.ArrayType(_ROW))
def answer_rows(text: pd.Series) -> pd.Series:
    """The rows of each answer; a row that is no object has is_object false. Null and answers without a list: none."""

    def plain(v: object) -> str | None:
        return None if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)

    def row(x: object) -> dict:
        held = x if isinstance(x, dict) else {}
        return {"is_object": isinstance(x, dict), **{f: plain(held.get(f)) for f in FIELDS}}

    return pd.Series([[row(x) for x in first_list(s)] if isinstance(s, str) else [] for s in text])


def _or_blank(c: Column) -> Column:
    return t.strip(F.coalesce(c, F.lit("")))


def checked_rows(answers: DataFrame, names: DataFrame) -> DataFrame:
    """Every row of ``answers`` (infocode, table_id, table_text, answer) with its facts, or the reason why it is none.

    Reasons in order: not_object, amount_invalid, empty_product_name, metric_or_revenue_label (unless an earlier
    product overlaps), no_report_date. Totals are named alike. A period is read from the row, else from the table's
    text; currency and unit too. ``names``: infocode, name. Rows: infocode, table_id, fact_no, product_name, amount,
    start_date, end_date, currency, unit, metric, reason.
    """
    rows = answers.select("infocode", "table_id", F.coalesce("table_text", F.lit("")).alias("around"), F.posexplode(answer_rows("answer")).alias("fact_no", "r")).select("infocode", "table_id", "around", "fact_no", "r.*")
    kind = t.label_kind(_or_blank(F.col("product_name")))
    rows = rows.withColumn("name", F.when(kind.isNotNull(), TOTAL).otherwise(_or_blank(F.col("product_name")))).withColumn("key", F.replace("name", F.lit(" "), F.lit("")))
    keys, known = rows.select("infocode", F.col("key").alias("text")), names.select("infocode", F.col("name").alias("text"))
    over = containing(known, keys, ["infocode"]).select("infocode", F.col("outer").alias("key"))
    met = over.union(containing(keys, known, ["infocode"]).select("infocode", F.col("inner").alias("key"))).distinct().withColumn("known", F.lit(True))
    rows = rows.join(met, ["infocode", "key"], "left")
    period = F.when(_or_blank(F.col("period")) != "", _or_blank(F.col("period"))).otherwise(F.col("around"))
    year = F.coalesce(p.year_of(period), p.year_of(F.col("around")))
    end = F.coalesce(p.period_end(period), p.period_end(F.col("around")), F.make_date(p.year_of(F.col("around")), F.lit(12), F.lit(31)))
    rows = rows.withColumns({"end_date": end, "of_year": year, "value": n.cell_number(F.col("amount"))})
    label = F.replace("name", F.lit("凈"), F.lit("淨")).rlike(f"(?i)^(?:{METRIC}|{REVENUE_LABEL})$") & ~F.coalesce("known", F.lit(False)) & (F.col("name") != TOTAL)
    reason = (
        F.when(~F.col("is_object"), "not_object").when(F.col("value").isNull(), "amount_invalid").when(F.col("name") == "", "empty_product_name")
        .when(label, "metric_or_revenue_label").when(F.col("end_date").isNull(), "no_report_date").when(F.col("of_year").isNull(), "no_start_date")
    )
    said = F.concat_ws(" ", F.concat(F.col("of_year").cast("string"), F.lit("年")), "around")
    or_around = lambda c, of: F.when(_or_blank(F.col(c)) != "", _or_blank(F.col(c))).otherwise(of(F.col("around")))
    return rows.select(
        "infocode", "table_id", "fact_no", F.col("name").alias("product_name"), F.col("value").alias("amount"), p.period_start(F.col("end_date"), said).alias("start_date"), "end_date",
        or_around("currency", n.currency_of).alias("currency"), or_around("unit", n.unit_of).alias("unit"), F.lit("MBREVENUE").alias("metric"), reason.alias("reason"),
    )


def model_facts(checked: DataFrame) -> DataFrame:
    """The facts among ``checked_rows``, the first of each product, period and metric of a table."""
    good = checked.where("reason is null").withColumn("_key", F.lower(F.replace("product_name", F.lit(" "), F.lit(""))))
    return first_facts(good, ["infocode", "table_id", "_key", "start_date", "end_date", "metric"], ["fact_no"]).drop("_key", "reason")
