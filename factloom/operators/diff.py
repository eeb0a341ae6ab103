"""Differences between two copies of a keyed dataset, field by field.

Both copies are range-partitioned with shared split points, sorted within partitions, and merged with two
pointers in a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import shuffle_partitions

ONLY_A, ONLY_B = "only_a", "only_b"


def latest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the greatest ``order`` of each key, as (key, _row struct); ties: the greatest row.

    A plain aggregate, so each task sends one row a key and a hot key is folded before the shuffle.
    Rows with a null key are left out. A null ``order`` is older than any other.
    """
    rest = [c for c in df.columns if c not in (key, order)]
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(F.col(order).alias("_at"), *[F.col(c) for c in rest])).alias("_row"))
        .select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])
    )


def merge_copies(a: DataFrame, b: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, diff_field) for each key held by one side only and each field whose values differ.

    ``a`` and ``b`` hold a key at most once each (see ``latest_per_key``) and texts as fields; a null equals
    a null only. One shuffle: the union of both sides is range-partitioned, which gives both the same split
    points, and sorted by key and side; each task then merges its two runs as a stream, holding one row over
    from batch to batch. Empty inputs give no rows.
    """
    side = lambda df, s: df.select(F.col(key).cast("string").alias("_key"), F.lit(s).alias("_side"), *[F.col(f).cast("string").alias(f) for f in fields])
    both = side(a, 0).unionByName(side(b, 1))
    n = shuffle_partitions(both.sparkSession)
    runs = both.repartitionByRange(n, "_key").sortWithinPartitions("_key", "_side")

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for batch in batches:
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            # a row at the end of a batch waits: its partner may come next
            held = rows.tail(1) if len(rows) else None
            last_pairs = len(rows) > 1 and rows["_key"].iloc[-1] == rows["_key"].iloc[-2]
            if last_pairs:
                held = None
            yield _compare(rows if last_pairs else rows.iloc[:-1], fields)
        if held is not None:
            yield _compare(held, fields)

    out = runs.mapInPandas(merge, "_key string, diff_field string")
    return out.withColumnRenamed("_key", key)


def _compare(rows: pd.DataFrame, fields: list[str]) -> pd.DataFrame:
    """Differences within rows sorted by key and side, all partners present."""
    key = rows["_key"].to_numpy(dtype=object)
    same_next = np.zeros(len(key), bool)
    if len(key) > 1:
        same_next[:-1] = key[1:] == key[:-1]
    paired = same_next.copy()
    paired[1:] |= same_next[:-1]
    alone = ~paired
    keys = [key[alone]]
    names = [np.where(rows["_side"].to_numpy()[alone] == 0, ONLY_A, ONLY_B)]
    at = np.flatnonzero(same_next)
    for f in fields:
        v = rows[f].to_numpy(dtype=object)
        x, y = v[at], v[at + 1]
        differ = np.fromiter(((p is not None or q is not None) and p != q for p, q in zip(x, y, strict=True)), bool, len(at))
        keys.append(key[at[differ]])
        names.append(np.full(int(differ.sum()), f, dtype=object))
    return pd.DataFrame({"_key": np.concatenate(keys), "diff_field": np.concatenate(names)})


_SPACE = r"[\s\u00a0\u2000-\u200b\u2028\u2029\u202f\u3000\ufeff]"
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_NARROW = "".join(chr(c) for c in range(0x21, 0x7F)) + " "


def plain_text(c: Column) -> Column:
    """Lower case without surrounding white space; blank is null."""
    s = F.lower(F.regexp_replace(c, f"^{_SPACE}+|{_SPACE}+$", ""))
    return F.nullif(s, F.lit(""))


def plain_number(c: Column) -> Column:
    """A number's one notation ("007", "7.0", " 7 ", "7,0"-grouped alike); other texts as plain_text; blank is null."""
    s = plain_text(F.translate(c.cast("string"), _WIDE, _NARROW))
    bare = F.regexp_replace(s, r"^\+|(?<=\d)[, ](?=\d{3}(\D|$))", "")
    plain = F.regexp_replace(F.regexp_replace(bare, r"^(-?)0+(?=\d)", "$1"), r"(\.\d*?)0+$", "$1")
    plain = F.regexp_replace(F.regexp_replace(plain, r"\.$", ""), r"^-0$", "0")
    scientific = bare.rlike(r"^-?(\d+\.?\d*|\.\d+)e[+-]?\d+$")
    expanded = F.regexp_replace(F.regexp_replace(bare.try_cast("double").cast("decimal(38,6)").cast("string"), r"0+$", ""), r"\.$", "")
    return F.when(bare.rlike(r"^-?\d+(\.\d*)?$"), plain).when(scientific, expanded).otherwise(s)


def plain_pages(c: Column) -> Column:
    """Page numbers in ascending order, whatever their order and separators; a text without digits as plain_text."""
    s = F.translate(c, _WIDE, _NARROW)
    pages = F.transform(F.regexp_extract_all(s, F.lit(r"(\d{1,18})"), 1), lambda x: x.cast("bigint"))
    return F.when(F.size(pages) > 0, F.array_join(F.transform(F.array_sort(pages), lambda x: x.cast("string")), "|")).otherwise(plain_text(c))


def plain_code(c: Column) -> Column:
    """An infocode in its one form: narrow, upper case, letters and digits only; blank is null."""
    s = F.upper(F.regexp_replace(F.translate(c, _WIDE, _NARROW), r"[^\p{L}\p{N}]", ""))
    return F.nullif(s, F.lit(""))


INVENTORY: dict[str, Callable[[Column], Column]] = {
    "category": plain_text,
    "pipeline_stage": plain_text,
    "source_pages": plain_pages,
    "message": plain_text,
    "local_rows": plain_number,
    "gt_rows": plain_number,
}


def inventory_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """(infocode, diff_field) between two failure inventories, after bringing every field to its one form.

    On each side only the row with the latest loaded_at of an infocode counts (ties: the greatest row). Rows
    whose infocode is null, blank or not 'AN' and 18 digits belong to no infocode and are left out.
    """
    norm = lambda df: df.select(plain_code(F.col("infocode")).alias("infocode"), "loaded_at", *[f(F.col(c)).alias(c) for c, f in INVENTORY.items()]).where(F.col("infocode").rlike(r"^AN\d{18}$"))
    sides = [latest_per_key(norm(df), "infocode", "loaded_at") for df in (a, b)]
    return merge_copies(*sides, key="infocode", fields=list(INVENTORY))
