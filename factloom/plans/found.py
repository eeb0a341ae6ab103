"""Queries pN_found of the general problems: timestamps, copies, units."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import diff
from ..operators.diff import inventory_differences
from ..operators.timestamps import instants_found
from ..operators.units import to_common_currency
from ..sources.tables import table


def p2_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """Instants of startdate and reportdate of the whole flat export."""
    return instants_found(table(spark, data_dir, "flat_export"), table(spark, data_dir, "source_systems"))


def p3_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """Differences between the two failure inventories."""
    return inventory_differences(table(spark, data_dir, "no_gt_hit_codes"), table(spark, data_dir, "no_gt_hit_codes_copy"))


def p5_found(spark: SparkSession, data_dir: str) -> DataFrame:
    """Revenue of the whole flat export in whole Hong Kong dollars."""
    return to_common_currency(*(table(spark, data_dir, t) for t in ("flat_export", "source_systems", "currency_ref")))


QUERIES = {"p2_found": p2_found, "p3_found": p3_found, "p5_found": p5_found}
_WS = r"[\s\x{a0}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{3000}\x{feff}]"
_NARROW = "translate({0}, '" + diff._WIDE + "', '" + diff._NARROW.replace("'", "''") + "')"


def _plain(c: str) -> str:
    return f"nullif(lower(regexp_replace({c}, '^{_WS}+|{_WS}+$', '', 'g')), '')"


def _number(c: str) -> str:
    bare = rf"regexp_replace({_plain(_NARROW.replace('{0}', f'cast({c} AS varchar)'))}, '(\d)[, ](\d{{3}})', '\1\2', 'g')"
    return rf"CASE WHEN regexp_matches({bare}, '^-?\d+(\.\d*)?$') THEN cast(cast({bare} AS decimal(38, 6)) AS varchar) ELSE {bare} END"


def _pages(c: str) -> str:
    found = rf"regexp_extract_all({_NARROW.replace('{0}', c)}, '\d{{1,18}}')"
    return f"CASE WHEN len({found}) > 0 THEN array_to_string(list_sort(list_transform({found}, lambda x: cast(x AS bigint))), '|') ELSE {_plain(c)} END"


_FORMS = {"category": _plain, "pipeline_stage": _plain, "source_pages": _pages, "message": _plain, "local_rows": _number, "gt_rows": _number}
_LATEST = (
    "(SELECT code, "
    + ", ".join(f"{form(f)} AS {f}" for f, form in _FORMS.items())
    + r" FROM (SELECT *, upper(regexp_replace(" + _NARROW.replace("{0}", "infocode") + r", '[^\p{L}\p{N}]', '', 'g')) AS code FROM {0}) WHERE regexp_matches(code, '^AN\d{18}$') QUALIFY row_number() OVER (PARTITION BY code ORDER BY loaded_at DESC) = 1)"
)

ORACLES: dict[str, str] = {
    "p3_found": "WITH a AS " + _LATEST.replace("{0}", "no_gt_hit_codes") + ", b AS " + _LATEST.replace("{0}", "no_gt_hit_codes_copy")
    + " SELECT code AS infocode, 'only_a' AS diff_field FROM a WHERE code NOT IN (SELECT code FROM b) UNION ALL SELECT code, 'only_b' FROM b WHERE code NOT IN (SELECT code FROM a) "
    + " ".join(f"UNION ALL SELECT a.code, '{f}' FROM a JOIN b ON a.code = b.code WHERE a.{f} IS DISTINCT FROM b.{f}" for f in _FORMS),
}
