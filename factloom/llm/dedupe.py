"""Records that are identical but for white space, letter case, punctuation, field order or outer notation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import shared_dir

# Between name and value, and between fields, while a record is rewritten; payloads are freed of them first.
_IS, _AND = "\u0001", "\u0002"
# Everything that never tells two values apart: white space, punctuation, symbols, invisible characters.
_NOISE = r"[\s\p{P}\p{S}\p{Z}\p{C}&&[^\u0001\u0002]]+"
# A field of a delimited record begins after ';', '|' or a line break, with a name of any length and '=' or ':'.
# Nothing is given back once matched, so that long blanks and names are read in one go.
_FIELD_START = r"(?:^|[;|\n])\s*+([\p{L}_][\p{L}\p{N}_]*+(?: ++[\p{L}\p{N}_]++)*+)\s*+[=:]"


def canonical(payload: Column) -> Column:
    """The one text of a record, whatever notation it came in: its fields sorted, without noise.

    A JSON object or delimited name=value pairs give 'name=value' of every field in lower case, sorted by
    name then value and parted by line feeds, which no value can hold. A payload in no known notation is
    taken whole. A field that is empty or missing is left out; an empty payload gives ''; null gives null.
    The whole record is lowered and freed of noise in one pass.
    """
    plain = F.translate(payload, _IS + _AND, "")
    parsed = F.map_entries(F.from_json(plain, "map<string,string>"))
    from_json = F.array_join(F.transform(parsed, lambda e: F.concat(e["key"], F.lit(_IS), F.coalesce(e["value"], F.lit("")))), _AND)
    from_pairs = F.regexp_replace(F.regexp_replace(plain, r"\n\s++", "\n"), _FIELD_START, f"{_AND}$1{_IS}")
    marked = F.when(F.ltrim(plain).startswith("{"), F.coalesce(from_json, plain)).otherwise(from_pairs)
    fields = F.split(F.regexp_replace(F.lower(marked), _NOISE, ""), _AND)
    kept = F.array_sort(F.filter(fields, lambda f: (f != "") & ~f.endswith(_IS)))
    return F.replace(F.array_join(kept, "\n"), F.lit(_IS), F.lit("="))


def _survivors(df: DataFrame, key: str, payload: str) -> DataFrame:
    verbatim = df.where(F.col(payload).isNotNull()).groupBy(F.col(payload).alias("payload")).agg(F.min(key).alias("first_id"), F.count("*").alias("n"))
    return verbatim.select("payload", "first_id", "n", canonical(F.col("payload")).alias("canonical"))


def collapse(df: DataFrame, key: str, payload: str) -> DataFrame:
    """One row for each distinct record: keep_id (smallest key), n_copies, canonical.

    Byte-identical payloads are collapsed first with their counts; only the distinct survivors are brought
    to canonical text, and grouped again on the whole of it, summing the counts. Rows with a null payload
    are no records and are left out.
    """
    survivors = _survivors(df, key, payload)
    return survivors.groupBy("canonical").agg(F.min("first_id").alias("keep_id"), F.sum("n").alias("n_copies")).select("keep_id", "n_copies", "canonical")


def digest(c: Column, name: str) -> list[Column]:
    """128 bits of a text as two columns, ``name`` with 0 and 1: two hashes with different seeds."""
    return [F.xxhash64(c).alias(f"{name}0"), F.xxhash64(F.lit(7), c).alias(f"{name}1")]


def _or_fail(good: Column, value: Column) -> Column:
    return F.when(good, value).otherwise(F.raise_error(F.lit("two texts share a digest of 128 bits")))


def copies_found(df: DataFrame, key: str = "rec_id", payload: str = "payload") -> DataFrame:
    """(keep_id, rec_id): each copy with the smallest key of its group.

    Survivors are worked out once and kept in the shared folder. They are grouped on their canonical text, which
    travels under its digest: a group whose least and greatest text differ stops the query, as does a digest that
    two payloads share, so nothing rests on digests being unique. The raw rows look up their group by the digest
    of their payload; a group that holds a third of all rows is never gathered in one task (aggregates fold it
    before the shuffle, and AQE splits the joins).
    """
    shared_dir(df.sparkSession)
    raw, group = ["raw0", "raw1"], ["group0", "group1"]
    survivors = _survivors(df, key, payload).select(*digest(F.col("payload"), "raw"), *digest(F.col("canonical"), "group"), "canonical", "first_id", "n").checkpoint()
    groups = survivors.groupBy(*group).agg(F.min("first_id").alias("keep_id"), F.sum("n").alias("n"), F.min("canonical").alias("lo"), F.max("canonical").alias("hi"))
    groups = groups.select(*group, _or_fail(F.col("lo") == F.col("hi"), F.when(F.col("n") > 1, F.col("keep_id"))).alias("keep_id"))
    keeps = survivors.select(*raw, *group).join(groups, group).groupBy(*raw).agg(F.count("*").alias("n"), F.min("keep_id").alias("keep_id"))
    keeps = keeps.select(*raw, _or_fail(F.col("n") == 1, F.col("keep_id")).alias("keep_id")).where("keep_id is not null")
    rows = df.where(F.col(payload).isNotNull()).select(F.col(key).alias("rec_id"), *digest(F.col(payload), "raw"))
    return rows.join(keeps, raw).where(F.col("rec_id") != F.col("keep_id")).select("keep_id", "rec_id")
