"""Queries of the scalar functions, over whole tables, with their reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numbers as n
from ..functions import periods as p
from ..functions import text as t
from ..sources.tables import table


def text_keys(spark: SparkSession, data_dir: str) -> DataFrame:
    """Forms of a name for comparison."""
    c = F.col("productname")
    return table(spark, data_dir, "flat_export").select(
        "row_id", t.squeeze(c).alias("squeezed"), t.match_key(c).alias("match_key"), t.name_key(c).alias("name_key"),
        t.clean_name(c).alias("cleaned"), t.clean_header(c).alias("header"),
    )


def text_predicates(spark: SparkSession, data_dir: str) -> DataFrame:
    """Chinese text, numbers, kinds of labels among lines and names."""
    flat = table(spark, data_dir, "flat_export").select(F.col("row_id").alias("id"), F.col("productname").alias("text"))
    lines = table(spark, data_dir, "doc_lines").select(F.col("line_id").alias("id"), "text")
    both = flat.withColumn("origin", F.lit("name")).unionByName(lines.withColumn("origin", F.lit("line")))
    c = F.col("text")
    return both.select("origin", "id", t.has_han(c).alias("has_han"), t.is_number(c).alias("is_number"), t.label_kind(c).alias("label_kind"))


def width_folded(spark: SparkSession, data_dir: str) -> DataFrame:
    """Wide and full-width characters in their compatibility form."""
    return table(spark, data_dir, "doc_lines").select("line_id", t.fold_width(F.col("text")).alias("folded"))


def line_texts(spark: SparkSession, data_dir: str) -> DataFrame:
    """Cleaned line texts."""
    return table(spark, data_dir, "doc_lines").select("line_id", t.line_text(F.col("text")).alias("cleaned"))


def strong_names(spark: SparkSession, data_dir: str) -> DataFrame:
    """Names normalised for linkage between periods."""
    return table(spark, data_dir, "flat_export").select("row_id", t.strong_name(F.col("productname")).alias("strong"))


def amounts_read(spark: SparkSession, data_dir: str) -> DataFrame:
    """Amounts read by the permissive, the cell and the stripping parser, and written again."""
    c = F.col("mbrevenue")
    return table(spark, data_dir, "flat_export").select(
        "row_id", n.to_double(c).alias("permissive"), n.cell_number(c).alias("cell"), n.numeric_text(c).alias("stripped"), n.number_text(n.cell_number(c)).alias("written"),
    )


def units_named(spark: SparkSession, data_dir: str) -> DataFrame:
    """Unit codes, currencies and units that texts name."""
    u = F.coalesce("unit", F.lit(""))
    return table(spark, data_dir, "flat_export").select(
        "row_id", n.unit_code(F.col("unit")).alias("unit_code"), n.unit_of(u).alias("unit_word"), n.currency_of(F.concat_ws(" ", "currency", "unit")).alias("currency_word"),
    )


def number_forms(spark: SparkSession, data_dir: str) -> DataFrame:
    """The texts an amount may appear as."""
    return table(spark, data_dir, "flat_export").select("row_id", F.array_join(F.array_sort(n.number_variants(n.cell_number(F.col("mbrevenue")))), "|").alias("forms"))


def numbers_split(spark: SparkSession, data_dir: str) -> DataFrame:
    """Numbers glued to labels or to each other, split."""
    return table(spark, data_dir, "doc_lines").select("line_id", F.array_join(t.number_pieces(F.col("text")), "|").alias("pieces"))


def period_ends(spark: SparkSession, data_dir: str) -> DataFrame:
    """Year, end and start of the period a line names, and that end in the year before."""
    lines = table(spark, data_dir, "doc_lines").select("line_id", "text", p.year_of(F.col("text")).alias("year"), p.period_end(F.col("text")).alias("period_end"))
    return lines.select("line_id", "year", "period_end", p.period_start(F.col("period_end"), F.col("text")).alias("period_start"), F.when(F.col("year").isNotNull(), p.aligned_end(F.col("period_end"), F.col("year") - 1)).alias("prior_end"))


def business_dates(spark: SparkSession, data_dir: str) -> DataFrame:
    """Business calendar dates and their month and day."""
    d = table(spark, data_dir, "flat_export").select("row_id", p.business_date(F.col("reportdate")).alias("business_date"), p.clamped_date(F.col("startdate")).alias("clamped"))
    return d.select("row_id", "business_date", "clamped", F.month("business_date").alias("month"), F.dayofmonth("business_date").alias("day"))


def year_hints(spark: SparkSession, data_dir: str) -> DataFrame:
    """Period texts derived from codes of filings."""
    return table(spark, data_dir, "flat_export").select("row_id", p.year_hint(F.col("infocode")).alias("hint"))


QUERIES = {
    "x_text_keys": text_keys, "x_text_predicates": text_predicates, "x_width_folded": width_folded, "x_line_texts": line_texts, "x_strong_names": strong_names,
    "x_amounts_read": amounts_read, "x_units_named": units_named, "x_number_forms": number_forms, "x_numbers_split": numbers_split,
    "x_period_ends": period_ends, "x_business_dates": business_dates, "x_year_hints": year_hints,
}

_SQUEEZE = r"regexp_replace(regexp_replace({0}, '\s+', ' ', 'g'), '^ | $', '', 'g')"
_STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"
# Apart from the tables of the code under test: full-width forms by their place, and the wide characters of other blocks
# that occur in the test tables, with what they stand for.
_WIDE = ("".join(chr(0xFF01 + k) for k in range(94)) + "\u3000", "".join(chr(0x21 + k) for k in range(94)) + " ")
_RADICALS = ("\u2f00\u2f06\u2f0a\u2f17\u2f1d\u2f2f\u2f3f\u2f40\u2f47\u2f49\u2f4a\u2f54\u2f63\u2f64\u2f6f\u2fa6\u2fa8\u2fb7\u2fbc", "一二入十口工手支日月木水生用石金門食高")
_COMPATIBLE = ("\uf90a\uf967\uf969\uf98e\uf9be\uf9d0", "金不數年料類")
_OTHER = ("①②\u2011\u2007\u2009\u00a0\u202f", "12\u2010    ")


def _translate(*tables: tuple[str, str]) -> str:
    quote = lambda x: x.replace("'", "''")
    return f"translate({{0}}, '{quote(''.join(a for a, _ in tables))}', '{quote(''.join(b for _, b in tables))}')"


_FOLD = _translate(_WIDE, _RADICALS, _COMPATIBLE, ("戶", "户"))
_NFKC = f"nfc_normalize({_translate(_WIDE, _RADICALS, _COMPATIBLE, _OTHER)})"
_HAN = "[一-鿿]"
_PLAIN = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"
_NUMBER = r"'^\(?-?[\d,]+(\.\d+)?\)?$'"


def _fill(template: str, value: str) -> str:
    return template.replace("{0}", value)


def _any(words: tuple[str, ...]) -> str:
    return "(?i)^(" + "|".join(words) + ")$"


_LABEL = _STRIP.replace("{0}", "regexp_replace(regexp_replace(" + _fill(_STRIP, "text") + ", '[:：]+$', ''), '截至.*止(六個月|六个月|九個月|九个月|年度|年).*$', '')")
_CELL = f"""CASE WHEN regexp_matches(mbrevenue, {_NUMBER}) THEN
    CASE WHEN mbrevenue LIKE '(%' AND mbrevenue LIKE '%)' THEN -1 ELSE 1 END * try_cast(replace(regexp_replace(mbrevenue, '^[( ]+|[) ]+$', '', 'g'), ',', '') AS double) END"""
_WRITTEN = "coalesce(rtrim(rtrim(cast(cast({0} AS decimal(38, 6)) AS varchar), '0'), '.'), '')"


def _ladder(column: str, pairs: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN contains({column}, '{a}') THEN '{b}'" for a, b in pairs) + " ELSE '' END"


_DIGITS = "translate({0}, '二〇○零一三四五六七八九', '200013456789')"
_HAN_MONTH = """CASE WHEN m LIKE '%十%' THEN
      CASE WHEN m LIKE '十%' THEN 10 ELSE 10 * cast(translate(m[1:1], '〇○零一二三四五六七八九', '000123456789') AS int) END
      + CASE WHEN m LIKE '%十' THEN 0 ELSE cast(translate(m[-1:], '〇○零一二三四五六七八九', '000123456789') AS int) END
    ELSE try_cast(translate(m, '〇○零一二三四五六七八九', '000123456789') AS int) END"""
_SEASONS = " ".join(f"WHEN regexp_matches({{0}}, '[{a}]季度') THEN {m}" for a, m in (("一1", 3), ("二2", 6), ("三3", 9), ("四4", 12)))


def _end(year: str, month: str) -> str:
    return f"(SELECT CASE WHEN mm BETWEEN 1 AND 12 AND yy BETWEEN 1 AND 9999 THEN last_day(make_date(yy, mm, 1)) END FROM (SELECT try_cast({year} AS int) AS yy, try_cast({month} AS int) AS mm))"


def _x(pattern: str, group: int) -> str:
    return f"nullif(regexp_extract(s, '{pattern}', {group}), '')"


_ENDS = ",\n    ".join(
    [
        "han_end",
        *(_end(_x(q, 1), _x(q, 2)) for q in (r"(\d{4})年(\d{1,2})月", r"(\d{4})年(\d{1,2})末")),
        *(_end(_x(q, 1), "CASE " + _SEASONS.replace("{0}", _x(q, 2)) + " END") for q in (r"(\d{4})年(第[一二三四1234]季度)", r"(\d{4})年([一二三四1234]季度)", r"(\d{4})年\d{1,2}-(\d{1,2}季度)", r"(\d{4})年(前[一二三四1234]季度)")),
        _end(_x(r"(\d{4})年(半年度|上半年)", 1), "6"),
        _end(_x(r"(\d{4})(年度|年部分经营数据|年公司境内|年经营)", 1), "12"),
        _end(_x(r"(\d{4})年\d{1,2}-(\d{1,2})月", 1), _x(r"(\d{4})年\d{1,2}-(\d{1,2})月", 2)),
        _end(_x(r"(\d{4})年(年度|年末|末)", 1), "12"),
        _end(_x(r"(\d{4})年(共同|发行)", 1), "12"),
    ]
)
_HAN_DATE = "(二[零〇][〇零一二三四五六七八九]{2})年([〇零一二三四五六七八九十]{1,3})月[〇零一二三四五六七八九十]{1,3}日"
_SIX = r"'(?i)六個月|六个月|6\s*個月|6\s*个月|six months'"
_NINE = r"'(?i)九個月|九个月|9\s*個月|9\s*个月|nine months'"
_ZONED = r"'^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})$'"



def _SEQUENCE(c: str) -> str:  # noqa: N802
    parts = rf"regexp_split_to_array({_fill(_STRIP, c)}, '\s+')"
    found = f"regexp_extract_all(q, '{t._NUMBERS}')"
    return f"flatten(list_transform({parts}, lambda q: CASE WHEN len({found}) > 1 THEN {found} ELSE [q] END))"


ORACLES = {
    "x_text_keys": rf"""
SELECT row_id, {_fill(_SQUEEZE, "productname")} AS squeezed,
  regexp_replace(regexp_replace(regexp_replace({_fill(_SQUEEZE, "productname")}, '[—–−－]', '-', 'g'), '^-+', ''), '\s+', '', 'g') AS match_key,
  lower(regexp_replace(productname, '\s+', '', 'g')) AS name_key,
  regexp_replace({_fill(_STRIP, "coalesce(productname, '')")}, '^(其中[:：]?\s*|[-–—·•]{{1,3}}\s*)', '') AS cleaned,
  regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(productname, ''), '{t.YEAR}', '', 'g'),
    '人民幣|人民币|港幣|港币|港元|美元|歐元|欧元|日圓|日元', '', 'g'), '(?i)百萬|百万|萬|万|千|元|million|thousand', '', 'g'),
    '(?i)未經審核|未审核|未經審計|未审计|unaudited', '', 'g'), '[()（）\s]+', '', 'g') AS header
FROM flat_export""",
    "x_text_predicates": rf"""
SELECT origin, id, coalesce(regexp_matches(text, '{_HAN}'), false) AS has_han,
  coalesce(regexp_matches(regexp_replace({_fill(_STRIP, "text")}, '[ ()]', '', 'g'), '^[+-]?(\d{{1,3}}(,\d{{3}})*|\d+)(\.\d+)?$'), false) AS is_number,
  CASE WHEN regexp_matches(replace({_LABEL}, '凈', '淨'), '{_any(t.SUBTOTALS)}') THEN 'subtotal' WHEN regexp_matches(replace({_LABEL}, '凈', '淨'), '{_any(t.FINAL_TOTALS)}') THEN 'final' END AS label_kind
FROM (SELECT 'name' AS origin, row_id AS id, productname AS text FROM flat_export UNION ALL SELECT 'line', line_id, text FROM doc_lines)""",
    "x_line_texts": f"""
WITH n AS (SELECT line_id, {"".join("replace(" for _ in t.CIRCLED)}replace({_fill(_FOLD, 'text')}, ' ', ''){"".join(f", '{ch}', '{k}、')" for k, ch in enumerate(t.CIRCLED, 1))} AS s FROM doc_lines),
c AS (SELECT line_id, unnest(string_split(s, '')) AS ch, generate_subscripts(string_split(s, ''), 1) AS i FROM n WHERE s <> ''),
r AS (SELECT *, i - row_number() OVER (PARTITION BY line_id, ch ORDER BY i) AS g FROM c),
k AS (SELECT *, count(*) OVER (PARTITION BY line_id, ch, g) AS n, row_number() OVER (PARTITION BY line_id, ch, g ORDER BY i) AS p FROM r)
SELECT n.line_id, coalesce(x, s) AS cleaned FROM n LEFT JOIN (SELECT line_id, coalesce(string_agg(ch, '' ORDER BY i) FILTER (NOT (regexp_matches(ch, '{_HAN}') AND n >= 4 AND p > 1)), '') AS x FROM k GROUP BY 1) y ON n.line_id = y.line_id""",
    "x_width_folded": f"SELECT line_id, {_fill(_FOLD, 'text')} AS folded FROM doc_lines",
    "x_strong_names": rf"""
SELECT row_id, regexp_replace(regexp_replace(lower(translate({_fill(_NFKC, "productname")}, '{t.STRONG_FOLD[0]}', '{t.STRONG_FOLD[1]}')),
  '\([^)]*(附註|附注|note|[ivx\d]+)[^)]*\)|（[^）]*(附註|附注|note|[ivx\d]+)[^）]*）', '', 'g'), '[\s:：,，。;；、()（）\[\]【】/\\_\-–—]+', '', 'g') AS strong
FROM flat_export""",
    "x_amounts_read": rf"""
SELECT row_id, CASE WHEN regexp_matches(s, {_PLAIN}) THEN try_cast(s AS double) END AS permissive, cell,
  CASE WHEN mbrevenue IS NULL OR mbrevenue IN ('', '-', '——') THEN ''
    ELSE regexp_replace(CASE WHEN NOT contains(mbrevenue, '-') AND contains(mbrevenue, '(') AND contains(mbrevenue, ')') THEN '-' || mbrevenue ELSE mbrevenue END, '[^\d.-]', '', 'g') END AS stripped,
  {_fill(_WRITTEN, "cell")} AS written
FROM (SELECT row_id, mbrevenue, replace({_fill(_STRIP, "mbrevenue")}, ',', '') AS s, {_CELL} AS cell FROM flat_export)""",
    "x_units_named": rf"""
SELECT row_id, CASE WHEN coalesce({_fill(_STRIP, "unit")}, '') = '' THEN '' WHEN regexp_matches(unit, '百万|百萬') THEN '004' WHEN contains(unit, '千') THEN '002' ELSE '001' END AS unit_code,
  CASE WHEN regexp_matches(u, '\$\s*''?000|''000') THEN '千元' {" ".join(f"WHEN contains(u, '{w}') THEN '{w}'" for w in n.UNIT_WORDS)} ELSE '' END AS unit_word,
  {_ladder("c", [*n.CURRENCY_MARKS, *n.CURRENCY_WORDS, ("$", "港元"), ("＄", "港元")])} AS currency_word
FROM (SELECT row_id, unit, coalesce(unit, '') AS u, concat_ws(' ', currency, unit) AS c FROM flat_export)""",
    "x_number_forms": rf"""
SELECT row_id, CASE WHEN cell IS NULL THEN '' ELSE array_to_string(list_sort(list_distinct(CASE WHEN cell < 0
    THEN [plain, grouped, '-' || plain, '-' || grouped, '(' || plain || ')', '(' || grouped || ')'] ELSE [plain, grouped] END)), '|') END AS forms
FROM (SELECT *, format('{{:,}}', cast(string_split(plain, '.')[1] AS bigint)) || CASE WHEN contains(plain, '.') THEN '.' || string_split(plain, '.')[2] ELSE '' END AS grouped
  FROM (SELECT row_id, cell, {_fill(_WRITTEN, "abs(cell)")} AS plain FROM (SELECT row_id, {_CELL} AS cell FROM flat_export)) WHERE cell IS NOT NULL
  UNION ALL SELECT row_id, NULL, NULL, NULL FROM (SELECT row_id, {_CELL} AS cell FROM flat_export) WHERE cell IS NULL)""",
    "x_numbers_split": rf"""
SELECT line_id, array_to_string(CASE WHEN regexp_matches(text, '{t._LABELLED}') THEN list_concat([{_fill(_STRIP, "regexp_extract(text, '" + t._LABELLED + "', 1)")}], {_SEQUENCE("regexp_extract(text, '" + t._LABELLED + "', 2)")})
  WHEN len({_SEQUENCE("text")}) > 1 THEN {_SEQUENCE("text")} ELSE [text] END, '|') AS pieces
FROM doc_lines""",
    "x_period_ends": rf"""
SELECT line_id, year, period_end,
  cast(period_end - CASE WHEN regexp_matches(text, {_SIX}) THEN INTERVAL 6 MONTH WHEN regexp_matches(text, {_NINE}) THEN INTERVAL 9 MONTH WHEN contains(text, '季度') THEN INTERVAL 3 MONTH ELSE INTERVAL 12 MONTH END + INTERVAL 1 DAY AS date) AS period_start,
  CASE WHEN year IS NOT NULL THEN CASE WHEN period_end IS NULL THEN make_date(year - 1, 12, 31)
    ELSE make_date(year - 1, month(period_end), least(day(period_end), day(last_day(make_date(year - 1, month(period_end), 1))))) END END AS prior_end
FROM (SELECT line_id, text, cast({_fill(_DIGITS, f"nullif(regexp_extract(text, '{t.YEAR}', 1), '')")} AS int) AS year, coalesce({_ENDS}) AS period_end
  FROM (SELECT line_id, text, s, {_end(_fill(_DIGITS, "y"), _HAN_MONTH)} AS han_end
    FROM (SELECT line_id, text, s, nullif(regexp_extract(s, '{_HAN_DATE}', 1), '') AS y, nullif(regexp_extract(s, '{_HAN_DATE}', 2), '') AS m
      FROM (SELECT line_id, text, regexp_replace(text, '[ \n\t]', '', 'g') AS s FROM doc_lines))))""",
    "x_business_dates": rf"""
SELECT row_id, business_date, clamped, cast(month(business_date) AS int) AS month, cast(day(business_date) AS int) AS day
FROM (SELECT row_id, coalesce(try_cast(nullif(regexp_extract(s, '^(\d{{4}}-\d{{2}}-\d{{2}})$', 1), '') AS date),
    try_cast(nullif(regexp_extract(s, '^(\d{{4}}-\d{{2}}-\d{{2}})[T ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d{{1,9}})?)?$', 1), '') AS date),
    CASE WHEN regexp_matches(s, {_ZONED}) THEN cast(try_cast(regexp_extract(s, '^(.*?)(Z|[+-]\d{{2}}:?\d{{2}})$', 1) AS timestamp) + INTERVAL 8 HOUR
      - to_minutes(CASE WHEN s LIKE '%Z' THEN 0 ELSE (cast(regexp_extract(s, '(\d{{2}}):?\d{{2}}$', 1) AS int) * 60 + cast(s[-2:] AS int)) * CASE WHEN regexp_matches(s, '-\d{{2}}:?\d{{2}}$') THEN -1 ELSE 1 END END) AS date) END) AS business_date,
  CASE WHEN cast(d AS int) >= 1 AND cast(m AS int) BETWEEN 1 AND 12 THEN make_date(cast(y AS int), cast(m AS int), least(cast(d AS int), day(last_day(make_date(cast(y AS int), cast(m AS int), 1))))) END AS clamped
  FROM (SELECT row_id, {_fill(_STRIP, "reportdate")} AS s, nullif(regexp_extract(startdate, '^\s*(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})\s*$', 1), '') AS y,
    nullif(regexp_extract(startdate, '^\s*(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})\s*$', 2), '') AS m, nullif(regexp_extract(startdate, '^\s*(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})\s*$', 3), '') AS d FROM flat_export))""",
    "x_year_hints": r"""
SELECT row_id, CASE WHEN regexp_matches(infocode, '^AN\d{4}') THEN '截至' || infocode[3:6] || '年12月31日止年度 截至' || cast(cast(infocode[3:6] AS int) - 1 AS varchar) || '年12月31日止年度' ELSE '' END AS hint
FROM flat_export""",
}
