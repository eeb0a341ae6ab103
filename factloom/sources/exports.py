"""Exports, runs and files: readers and writers around the facts tables."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fold_width
from ..operators.grids import html_grid

RECORD = T.StructType([T.StructField(f, T.StringType()) for f in ("STARTDATE", "REPORTDATE", "CURRENCY", "PRODUCTNAME", "MBREVENUE", "MBCOST", "GROSS_PROFIT", "UNIT")])
INVENTORY_SCHEMA = "infocode string, category string, pipeline_stage string, source_pages string, message string, local_rows long, gt_rows long"


@dataclass(frozen=True)
class TaskSchema:
    """A task's settings; unknown key fields are refused."""

    fields: tuple[str, ...]
    match_key_fields: tuple[str, ...] = ("STARTDATE", "REPORTDATE", "PRODUCTNAME")
    num_tol: float = 1e-4
    data_path: str = "data.records"
    exclude_infocodes: tuple[str, ...] = ()
    options: dict = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> TaskSchema:
        """From a JSON file; ``fields`` is required, and match_key_fields must be among them."""
        with open(path, encoding="utf-8") as f:
            raw = json.load(f)
        if not raw.get("fields"):
            raise ValueError("a task schema needs fields")
        known = {k: tuple(v) if isinstance(v, list) else v for k, v in raw.items() if k in cls.__dataclass_fields__ and k != "options"}
        made = cls(**known, options={k: v for k, v in raw.items() if k not in cls.__dataclass_fields__})
        if bad := [k for k in made.match_key_fields if k not in made.fields]:
            raise ValueError(f"match_key_fields not among fields: {bad}")
        return made

    @property
    def value_fields(self) -> tuple[str, ...]:
        """The fields that aren't keys."""
        return tuple(f for f in self.fields if f not in self.match_key_fields)


def project(df: DataFrame, fields: list[str]) -> DataFrame:
    """The fields in order; one that is missing is null."""
    have = set(df.columns)
    return df.select(*[F.col(f) if f in have else F.lit(None).cast("string").alias(f) for f in fields])


def at_path(df: DataFrame, path: str, name: str = "value") -> DataFrame:
    """``df`` with the column at a dotted path into structs and maps.

    An array on the way, or at the end, comes as a row for each of its elements; an empty or null one, as a null,
    keeps its row with null. A name that a struct doesn't have is refused by the analysis, a missing key of a map null.
    """
    first, *rest = path.split(".")
    out = df.withColumn("_at", F.col(f"`{first}`"))
    for step in [*rest, None]:
        while isinstance(out.schema["_at"].dataType, T.ArrayType):
            out = out.withColumn("_at", F.explode_outer("_at"))
        if step is not None:
            out = out.withColumn("_at", F.try_element_at("_at", F.lit(step)) if isinstance(out.schema["_at"].dataType, T.MapType) else F.col("_at").getField(step))
    return out.withColumn(name, F.col("_at")).drop("_at")


def read_keyed_json(spark: SparkSession, path: str, record: T.StructType = RECORD) -> DataFrame:
    """Rows of files holding {code: [rows]} or [rows with INFOCODE], one such text a file; a row's own code wins.

    Keys are trimmed, a blank key is kept as null. Reading a file of another shape fails the query.
    """
    return _keyed_rows(spark.read.text(path, wholetext=True), record)


def _keyed_rows(texts: DataFrame, record: T.StructType) -> DataFrame:
    with_code = T.StructType([*record.fields, T.StructField("INFOCODE", T.StringType())])
    text = texts.select(F.trim("value").alias("value")).where("value <> ''")
    # schemas are given, so what doesn't parse is null
    keyed = F.from_json("value", T.MapType(T.StringType(), T.ArrayType(with_code)))
    listed = F.map_from_arrays(F.array(F.lit("")), F.array(F.from_json("value", T.ArrayType(with_code))))
    either = F.when(F.col("value").startswith("{"), keyed).when(F.col("value").startswith("["), listed)
    read = F.coalesce(either, F.raise_error(F.lit("neither {code: [rows]} nor [rows]")).cast(T.MapType(T.StringType(), T.ArrayType(with_code))))
    both = text.select(F.explode(read).alias("key", "rows")).select("key", F.explode("rows").alias("r"))
    code = F.coalesce(F.nullif(F.trim("r.INFOCODE"), F.lit("")), F.nullif(F.trim("key"), F.lit("")))
    return both.select(code.alias("INFOCODE"), *[F.col(f"r.{f.name}") for f in record.fields])


def write_keyed(df: DataFrame, path: str, key: str = "INFOCODE") -> None:
    """K1: rows as JSON lines, ordered by key within files, rows without a key left out.

    A key's rows lie together in one stretch of one file, or several files where a key is huge: no group is
    gathered in memory. Written by Spark's commit protocol, so a reader never sees half a file.
    """
    df.where(F.trim(F.col(key)) != "").repartitionByRange(key, F.xxhash64(*[c for c in df.columns if c != key])).sortWithinPartitions(key).write.mode("overwrite").json(path)


def write_grouped(df: DataFrame, path: str, fields: list[str], key: str = "INFOCODE", most: int = 10_000) -> dict[str, int]:
    """K9: rows grouped as {code: [rows of ``fields``]}, one such object a line, codes in order within files; gives the counts.

    Codes are trimmed, rows without one are counted as skipped, fields that are missing are null. A code of more
    than ``most`` rows has several lines, so that no task gathers a whole group; ``read_grouped`` puts them together.
    """
    if not fields:
        raise ValueError("fields are needed")
    code = F.nullif(F.trim(F.col(key)), F.lit(""))
    rows = project(df.withColumn("_code", code), ["_code", *fields])
    sizes = rows.groupBy("_code").agg(F.count("*").alias("n"))
    total = sizes.agg(F.count("_code").alias("groups"), F.coalesce(F.sum(F.when(F.col("_code").isNotNull(), F.col("n"))), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(F.col("_code").isNull(), F.col("n"))), F.lit(0)).alias("skipped")).first()
    large = sizes.where((F.col("n") > most) & F.col("_code").isNotNull()).select("_code", F.ceil(F.col("n") / most).cast("int").alias("parts"))
    part = F.coalesce((F.rand(7) * F.col("parts")).cast("int"), F.lit(0))
    salted = rows.where("_code is not null").join(large, "_code", "left").withColumn("_part", part)
    grouped = salted.groupBy("_code", "_part").agg(F.collect_list(F.struct(*[F.col(f"`{f}`") for f in fields])).alias("rows"))
    line = F.to_json(F.create_map("_code", "rows"), {"ignoreNullFields": "false"})
    grouped.repartitionByRange("_code").sortWithinPartitions("_code", "_part").select(line.alias("value")).write.mode("overwrite").text(path)
    return total.asDict()


def read_grouped(spark: SparkSession, path: str, record: T.StructType = RECORD) -> DataFrame:
    """Rows of files that hold a {code: [rows]} object in each line."""
    return _keyed_rows(spark.read.text(path), record)


def export_groups(df: DataFrame, key: str, order: str) -> DataFrame:
    """A1, K9: (key, n_rows, first_id, last_id) of the keys that aren't blank, and one row of key null for the rest."""
    k = F.when(F.trim(F.col(key)) != "", F.trim(F.col(key)))
    return df.groupBy(k.alias(key)).agg(F.count("*").alias("n_rows"), F.min(order).alias("first_id"), F.max(order).alias("last_id"))


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """A tab-separated failure inventory with its header; malformed counts become null."""
    return spark.read.csv(path, sep="\t", header=True, schema=INVENTORY_SCHEMA, mode="PERMISSIVE")


def write_tsv(df: DataFrame, path: str) -> None:
    """K6: tab-separated with a header."""
    df.write.mode("overwrite").csv(path, sep="\t", header=True)


def latest_runs(runs: DataFrame, key: str, stamp: str) -> DataFrame:
    """Of each key the row of the latest run; ties: the greatest row. A plain aggregate."""
    rest = [c for c in runs.columns if c != key]
    return runs.groupBy(key).agg(F.max(F.struct(stamp, *[c for c in rest if c != stamp])).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def accept_rows(kept: DataFrame, accepted: DataFrame, key: str) -> DataFrame:
    """K8: ``kept`` with all rows of the accepted keys replaced; keys whose rows are all blank aren't accepted."""
    values = [c for c in accepted.columns if c != key]
    filled = F.lit(False)
    for c in values:
        filled = filled | F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))
    good = accepted.where(filled & F.col(key).isNotNull())
    return kept.join(good.select(key).distinct(), key, "left_anti").unionByName(good)


def discover_jobs(jobs: DataFrame, files: DataFrame, exclude: list[str]) -> DataFrame:
    """(infocode, path, state): 'ready', 'missing', 'not_pdf' or 'excluded'.

    ``files`` is a binaryFile listing cut to (path, head), head being the first five bytes.
    """
    code = F.regexp_extract("path", r"(AN\d{18})[^/]*$", 1)
    found = files.select(code.alias("infocode"), "path", "head").where("infocode <> ''").groupBy("infocode").agg(F.min(F.struct("path", "head")).alias("f")).select("infocode", "f.*")
    joined = jobs.select("infocode").distinct().join(found, "infocode", "left")
    state = F.when(F.col("infocode").isin(exclude), "excluded").when(F.col("path").isNull(), "missing").when(F.col("head") != "%PDF-", "not_pdf").otherwise("ready")
    return joined.select("infocode", "path", state.alias("state"))


def read_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Paths with their first five bytes as text, and their fingerprint (S7: length and time).

    Contents stay unread: files are listed, and each is opened for its first five bytes alone. ``pattern`` may
    name a folder, files by a glob, or several of these parted by '##'.
    """
    listed = spark.read.format("binaryFile").load(pattern.split("##")).select("path", "length", "modificationTime")

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            head = []
            for path in b["path"]:
                source, at = fs.FileSystem.from_uri(path if not path.startswith("file:/") else "file:///" + path.removeprefix("file:").lstrip("/"))
                with source.open_input_file(at) as f:
                    head.append(f.read(5).decode("ISO-8859-1"))
            yield b.assign(head=head)[["path", "head", "length", "modificationTime"]]

    return listed.mapInPandas(heads, "path string, head string, length long, modificationTime timestamp")


def fresh_cache(files: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cached rows whose file is unchanged, files to read again).

    ``cache`` carries path, length and modificationTime of the file it was made from; a file of another length
    or time counts as changed, a cache without its file as stale.
    """
    key = ["path", "length", "modificationTime"]
    return cache.join(files.select(*key), key, "left_semi"), files.join(cache.select(*key).distinct(), key, "left_anti")


_OCR = T.ArrayType(T.StructType([T.StructField("type", T.StringType()), T.StructField("content", T.StringType()), T.StructField("bbox", T.ArrayType(T.DoubleType()))]))


def read_page_json(spark: SparkSession, pattern: str) -> DataFrame:
    """Blocks of page files named '<code>_<page>.json': content kinds that are text or tables.

    Page numbers, asides and images are dropped, footers kept only when they speak of an attached part, empty
    content too; files with "over" in their name are skipped. Rows: infocode, page_number, block_no, type, content
    as delivered, text (narrow, without blanks), x0, grid (of a table, else null). Order by page_number and block_no.
    """
    pages = spark.read.text(pattern, wholetext=True).select(F.input_file_name().alias("path"), "value")
    name = F.element_at(F.split("path", "/"), -1)
    named = pages.where(~name.contains("over")).select(F.regexp_extract(name, r"(AN\d{18})_\d+\.json$", 1).alias("infocode"), F.regexp_extract(name, r"AN\d{18}_(\d+)\.json$", 1).try_cast("int").alias("page_number"), F.posexplode(F.from_json("value", _OCR)).alias("block_no", "b"))
    t, c = F.coalesce("b.type", F.lit("")), F.coalesce("b.content", F.lit(""))
    wanted = ~t.isin("page_number", "aside_text", "image") & ((t != "footer") | c.rlike("后附.*部分")) & (c != "")
    text = F.replace(fold_width(c), F.lit(" "), F.lit(""))
    return named.where((F.col("infocode") != "") & wanted).select("infocode", "page_number", "block_no", t.alias("type"), c.alias("content"), text.alias("text"), F.get("b.bbox", F.lit(0)).alias("x0"), F.when(t == "table", html_grid(fold_width(c))).alias("grid"))


def html_report(totals: dict, fields: list[dict], path: str, more: dict[str, list[dict]] | None = None) -> None:
    """K4: the corpus figures as a page: tiles, agreement by field, and ``more`` tables by title (causes, stages, documents
    side by side). Takes the few rows of aggregates and a top list, never all documents."""
    esc = lambda v: str("" if v is None else v).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")

    def as_table(title: str, rows: list[dict]) -> str:
        head = "".join(f"<th>{esc(k)}</th>" for k in (rows[0] if rows else {}))
        body = "".join("<tr>" + "".join(f"<td>{esc(v)}</td>" for v in r.values()) + "</tr>" for r in rows)
        return f"<h2>{esc(title)}</h2><table><tr>{head}</tr>{body}</table>"

    tiles = "".join(f"<div class=k><b>{esc(v)}</b><span>{esc(k)}</span></div>" for k, v in totals.items())
    tables = "".join(as_table(title, rows) for title, rows in {"Fields": fields, **(more or {})}.items())
    page = f"<!doctype html><meta charset=utf-8><title>Quality</title><style>.k{{display:inline-block;margin:8px}}.k b{{display:block}}</style>{tiles}{tables}"
    with open(path + ".tmp", "w", encoding="utf-8") as f:
        f.write(page)
    os.replace(path + ".tmp", path)
