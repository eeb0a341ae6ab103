"""Grids of cells: HTML tables, classification by orientation, and facts read from them.

A grid is an ARRAY<ARRAY<STRING>> in one row, whose rows may differ in width. Classification is done with
higher-order functions inside the row; the three ways of reading facts follow several rows at once with state
and run as an Arrow function over whole grids. Neither moves a row between tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import numeric_text
from ..functions.text import FINAL_TOTALS, SUBTOTALS, YEAR, clean_header, clean_name, strip
from ..sources.tables import shared_dir
from .linkage import containing

# Words that tell what a cell or a row is about.
REVENUE = "收入|收益|營業額|营业额|銷售額|销售额|銷售|销售|revenue|turnover|sales"
REVENUE_LABEL = "收入|收益|營業額|營業收入|銷售收入|銷售額|revenue|turnover|sales"
PROFIT_LINE = "成本|毛利|溢利|虧損|損失|開支|費用|profit|loss"
METRIC = "分部業績|分部收益|毛利|成本|溢利|虧損|開支|費用|折舊|利息收入|profit|loss|expense|subtotal|total"
METRIC_WITHIN = "分部業績|分部收益|毛利|成本|溢利|虧損|損失|開支|費用|折舊|利息收入|EBITDA|EBIT|非流動資產|流動資產|股東應佔|第三方|關聯方|銷售產品|提供服務|profit|loss|expense|subtotal|total"
EXTERNAL = "外部|對外|对外|external"
HEADER = YEAR + "|千元|千港元|百萬|百万|期間|期间|附註|附注|年度|止年度|止六個月|止六个月"
RECOGNITION = "時間點|時點|时间点|隨時間|随时间|一段時間|一段时间|某一時點|某一时点|某個時點|某个时点"
NOTE = "^(?:附註|附注|註|注|note)"
TIMING_WORDS = ("按時間段", "按时间段", "於某一時點", "于某一时点", "按某個時點", "按某个时点", "隨時間", "随时间", "時間點", "时间点", "確認收益時間", "确认收益时间", "收入確認時間", "收入确认时间", "收益確認時間", "收益确认时间")
SPLIT_WORDS = (
    "客戶合約收益", "客户合约收益", "客戶合約收入", "客户合约收入", "貨品類型", "货品类型", "產品類型", "产品类型", "服務類型", "服务类型", "商品和服務的類型", "商品和服务的类型",
    "收入明細", "收入明细", "收益明細", "收益明细", "按主要產品", "按主要产品", "按產品", "按产品", "按客戶", "按客户", "按業務", "按业务", "銷售產品", "销售产品", "提供服務", "提供服务",
    "分部收益", "分部收入", "分部業績", "分部业绩", "來自客戶合約", "来自客户合约", "來自客戶合同", "来自客户合同", "按商品類型", "按商品类型",
)
PROFIT_TITLE = "損益表|损益表|收益表|綜合損益|综合损益|全面收益|全面收入|虧損表|亏损表|income statement|profit or loss|profit and loss"

_ROW = r"(?s)<tr[^>]*>(.*?)</tr>"
_CELL = r"(?s)<(?:td|th)([^>]*)>(.*?)</(?:td|th)>"


def html_grid(html: Column) -> Column:
    """The grid of an HTML table: tags stripped, colspan repeated, rowspan ignored; null for null."""

    def cells(row: Column) -> Column:
        attrs, bodies = F.regexp_extract_all(row, F.lit(_CELL), 1), F.regexp_extract_all(row, F.lit(_CELL), 2)
        text = lambda b: F.regexp_replace(F.regexp_replace(b, "<[^>]+>", ""), r"^\s+|\s+$", "")
        span = lambda a: F.coalesce(F.nullif(F.regexp_extract(a, r"colspan=[\"']?(\d{1,4})", 1), F.lit("")).cast("int"), F.lit(1))
        return F.flatten(F.zip_with(attrs, bodies, lambda a, b: F.array_repeat(text(b), span(a))))

    return F.transform(F.regexp_extract_all(html, F.lit(_ROW), 1), cells)


def cells_long(grids: DataFrame, key: str, grid: str = "grid") -> DataFrame:
    """A grid's cells as rows: (key, row_no, col_no, text)."""
    rows = grids.select(key, F.posexplode(grid).alias("row_no", "row"))
    return rows.select(key, "row_no", F.posexplode("row").alias("col_no", "text"))


def column_header(grid: Column, column: int | Column, rows: int = 5) -> Column:
    """The first rows' texts above a column, short rows aligned to the right."""
    width = F.array_max(F.transform(grid, lambda r: F.size(r)))
    column = F.lit(column) if isinstance(column, int) else column
    return F.array_join(F.array_compact(F.transform(F.slice(grid, 1, rows), lambda r: F.get(r, column - F.greatest(F.lit(0), width - F.size(r))))), " ")


def _said(cell: Column) -> Column:
    """A cell with text that isn't a number (X7); an amount in brackets counts as one whatever stands in them."""
    s = F.coalesce(cell, F.lit(""))
    return (strip(s) != "") & (numeric_text(s) == "")


def bare_text(text: Column) -> Column:
    """A cell as names are looked for in it: small letters, no blanks, no 之."""
    return F.replace(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), r" |\\n|\n", "")), F.lit("之"), F.lit(""))


def label_keys(text: Column) -> Column:
    """The forms without blanks in which a cell may name a product: as it is, as a row's label, as a column's header."""
    return F.array_distinct(F.transform(F.array(strip(F.coalesce(text, F.lit(""))), clean_name(text), clean_header(F.replace(text, F.lit("\n"), F.lit(" ")))), lambda x: F.replace(x, F.lit(" "), F.lit(""))))


def with_names(grids: DataFrame, names: DataFrame) -> DataFrame:
    """``grids`` with what prior names say of their cells.

    ``grids``: infocode, table_id, grid; ``names``: infocode, name, distinct. Added: has_names (the document has prior
    names), named (the ``bare_text`` of cells that a name is in) and known (those ``label_keys`` that contain a name
    or are contained in one). Names and cells meet by grams within their document; what a grid is given is bounded by
    its cells, not by the names of its document.
    """
    shared_dir(grids.sparkSession)
    key = ["infocode"]
    cells = grids.select("infocode", "table_id", F.explode(F.array_distinct(F.flatten("grid"))).alias("cell")).where("cell is not null")
    forms = F.array_union(F.array(F.concat(F.lit("b"), bare_text(F.col("cell")))), F.transform(label_keys(F.col("cell")), lambda x: F.concat(F.lit("l"), x)))
    # one text with its kind before it, so that cells and labels are told apart and met together
    every = cells.select("infocode", "table_id", F.explode(forms).alias("form")).where(F.length("form") > 1).distinct().checkpoint()  # used three times
    texts = every.select("infocode", "form").distinct().select("infocode", F.substring("form", 1, 1).alias("kind"), F.substring("form", 2, 1 << 30).alias("text"))
    whole = F.replace(strip("name"), F.lit("之"), F.lit(""))
    part = F.element_at(F.split(F.element_at(F.split(whole, "-"), -1), ":"), 1)
    looked = names.select("infocode", F.explode(F.array(F.struct(F.lit("b").alias("kind"), part.alias("text")), F.struct(F.lit("l").alias("kind"), F.replace("name", F.lit(" "), F.lit("")).alias("text")))).alias("n")).select("infocode", "n.kind", "n.text").distinct()
    hits = containing(looked, texts, [*key, "kind"]).select("infocode", "kind", F.col("outer").alias("text"))
    under = containing(texts.where("kind = 'l'"), looked.where("kind = 'l'"), [*key, "kind"]).select("infocode", "kind", F.col("inner").alias("text"))
    # a long dashed name is in a text that has all its letters, the dash among them
    long = names.select("infocode", whole.alias("whole")).where((F.length("whole") > 10) & F.col("whole").contains("-")).select("infocode", F.split("whole", "").alias("letters")).distinct()
    spelled = texts.where((F.col("kind") == "b") & F.col("text").contains("-")).join(long, key).where(F.forall("letters", lambda x: F.col("text").contains(x))).select("infocode", "kind", "text")
    found = hits.union(under).union(spelled).select("infocode", F.concat("kind", "text").alias("form")).distinct()
    met = every.join(found, ["infocode", "form"])
    of = lambda kind: F.collect_set(F.when(F.col("form").startswith(kind), F.substring("form", 2, 1 << 30)))
    per_table = met.groupBy("table_id").agg(of("b").alias("named"), of("l").alias("known"))
    none = F.array().cast("array<string>")
    out = grids.join(per_table, "table_id", "left").join(names.select("infocode").distinct().withColumn("has_names", F.lit(True)), "infocode", "left")
    return out.withColumns({"named": F.coalesce("named", none), "known": F.coalesce("known", none), "has_names": F.coalesce("has_names", F.lit(False))})


def with_named(grids: DataFrame, names: DataFrame, few: int = 64) -> DataFrame:
    """``grids`` with ``named`` as ``with_names`` gives it, where only the class of a grid is asked for.

    Names of a document with up to ``few`` are carried to its grids; those of one with more meet its cells by grams,
    so what a row holds is bounded in both. Columns: those of ``grids`` and named.
    """
    shared_dir(grids.sparkSession)
    whole = F.replace(strip("name"), F.lit("之"), F.lit(""))
    part = F.element_at(F.split(F.element_at(F.split(whole, "-"), -1), ":"), 1)
    long = F.when((F.length(whole) > 10) & whole.contains("-"), whole)
    looked = names.select("infocode", part.alias("text"), long.alias("long")).where("infocode is not null and (text <> '' or long is not null)").distinct().checkpoint()
    counts = looked.groupBy("infocode").agg(F.count("*").alias("_k"))
    counted = looked.join(counts, "infocode")
    carried = F.when(F.col("_k") <= few, F.struct(F.col("text"), F.array_distinct(F.split("long", "")).alias("letters")))
    own = counted.groupBy("infocode", "_k").agg(F.collect_list(carried).alias("_own"))
    cells = F.array_distinct(F.transform(F.flatten("grid"), bare_text))
    spelled = lambda letters, text: F.forall(letters, lambda x: text.contains(x))
    within = lambda text: F.exists("_own", lambda o: ((o["text"] != "") & text.contains(o["text"])) | F.coalesce(spelled(o["letters"], text), F.lit(False)))
    none = F.array().cast("array<string>")
    small = grids.join(own, "infocode", "left").where(F.col("_k").isNull() | (F.col("_k") <= few))
    small = small.select(*grids.columns, F.coalesce(F.when(F.size("_own") > 0, F.filter(cells, within)), none).alias("named"))

    large = grids.join(counts.where(F.col("_k") > few).select("infocode"), "infocode", "left_semi")
    every = large.select("infocode", "table_id", F.explode(cells).alias("text")).where("text <> ''")
    texts = every.select("infocode", "text").distinct()
    many = counted.where(F.col("_k") > few)
    hits = containing(many.select("infocode", "text"), texts, ["infocode"]).select("infocode", F.col("outer").alias("text"))
    letters = many.where("long is not null").select("infocode", F.array_distinct(F.split("long", "")).alias("letters")).distinct()
    by_letters = texts.where(F.col("text").contains("-")).join(letters, "infocode").where((F.size("letters") <= F.length("text")) & spelled(F.col("letters"), F.col("text"))).select("infocode", "text")
    met = every.join(hits.union(by_letters).distinct().checkpoint(), ["infocode", "text"])  # cuts the plan
    per_table = met.groupBy("table_id").agg(F.collect_list("text").alias("named"))
    return small.unionByName(large.join(per_table, "table_id", "left").select(*grids.columns, F.coalesce("named", none).alias("named")))


def classify(grid: Column, title: Column, named: Column) -> Column:
    """How a grid holds products: 'profit_loss', 'product_in_rows', 'product_in_columns' or 'unsupported'.

    In order: a title of profit and loss; cells that prior names are in, the most in a row against the most in a
    column; words on the timing of recognition, each cell with one voting for rows and columns where other text
    stands; words of a split by product; density of text. ``named`` has the ``bare_text`` of the cells with names.
    """
    # Lambdas over one-element arrays bind a value once, where a nested expression would be worked out again.
    bound = F.array(F.struct(grid.alias("grid"), named.alias("named")))
    return F.coalesce(F.when(F.coalesce(title.rlike(PROFIT_TITLE), F.lit(False)), "profit_loss"), F.get(F.transform(bound, lambda b: _orientation(b["grid"], b["named"])), F.lit(0)))


def _orientation(grid: Column, named: Column) -> Column:
    width = F.array_max(F.transform(grid, lambda r: F.size(r)))
    columns = F.transform(F.sequence(F.lit(0), F.greatest(width - 1, F.lit(0))), lambda c: F.transform(grid, lambda r: F.get(r, c)))
    hits = lambda cells: F.size(F.filter(cells, lambda x: F.coalesce(F.array_contains(named, bare_text(x)), F.lit(False))))
    most = lambda lines: F.when(F.size(named) > 0, F.array_max(F.transform(lines, hits))).otherwise(0)
    row_text, col_text = F.size(F.filter(F.get(grid, F.lit(0)), _said)), F.size(F.filter(F.get(columns, F.lit(0)), lambda x: F.coalesce(_said(x), F.lit(False))))
    timing = "|".join(TIMING_WORDS)

    def votes(cells: Column) -> Column:
        """Cells with a word of timing that have another text beside them: one that isn't the least or isn't the greatest."""
        said = F.filter(cells, lambda x: F.coalesce(_said(x), F.lit(False)))
        ends = F.array(F.struct(F.array_min(said).alias("lo"), F.array_max(said).alias("hi")))
        return F.get(F.transform(ends, lambda e: F.size(F.filter(cells, lambda x: F.coalesce(x.rlike(timing) & ((e["lo"] != x) | (e["hi"] != x)), F.lit(False))))), F.lit(0))

    has = lambda words: F.exists(F.flatten(grid), lambda x: F.coalesce(x.rlike("|".join(words)), F.lit(False)))
    timed = has(TIMING_WORDS)
    total = lambda lines: F.when(timed, F.aggregate(F.transform(lines, votes), F.lit(0), lambda acc, x: acc + x)).otherwise(0)
    rows, cols = F.lit("product_in_rows"), F.lit("product_in_columns")
    # each rung is worked out only where those above don't decide
    by_name = F.array(F.struct(most(grid).alias("r"), most(columns).alias("c")))
    by_timing = F.array(F.struct(total(grid).alias("r"), total(columns).alias("c")))
    by_text = F.array(F.struct(row_text.alias("r"), col_text.alias("c")))

    def named_more(k: Column) -> Column:
        dense = F.get(F.transform(by_text, lambda t: (t["c"] >= 6) & (t["c"] >= 3 * t["r"])), F.lit(0))
        return F.when(k["r"] + k["c"] > 0, F.when(k["r"] > k["c"], rows).when(k["r"] < k["c"], cols).when(dense, cols).otherwise(rows))

    timed_more = lambda k: F.when(k["r"] + k["c"] > 0, F.when(k["r"] >= k["c"], rows).otherwise(cols))

    def said_more(k: Column) -> Column:
        block = (F.size(grid) >= 2) & (width >= 2)
        return (
            F.when(((k["r"] >= 2) | (k["c"] >= 2)) & has(SPLIT_WORDS), F.when(k["r"] >= k["c"], rows).otherwise(cols))
            .when(block & (k["r"] >= 2) & (k["r"] > k["c"]), rows)
            .when(block & (k["c"] >= 2) & (k["c"] > k["r"]), cols)
            .otherwise("unsupported")
        )

    rungs = [F.get(F.transform(k, f), F.lit(0)) for k, f in ((by_name, named_more), (by_timing, timed_more), (by_text, said_more))]
    return F.when(F.coalesce(F.size(grid), F.lit(0)) <= 0, "unsupported").otherwise(F.coalesce(*rungs))


# ---- facts, one grid at a time ----

_NUMBER = re.compile(r"^\(?-?[\d,]+(?:\.\d+)?\)?$")
_HAN_DIGITS = str.maketrans("〇○零一二三四五六七八九", "000123456789")
_DASHES = {"-", "–", "—"}


def _has(pattern: str, text: str) -> bool:
    return re.search(pattern, text.replace("凈", "淨"), re.I) is not None


def read_number(cell: str | None) -> float | None:
    """X5 on the Python side: a whole cell as a number."""
    if not cell or not _NUMBER.match(cell):
        return None
    bare = cell.strip("() ").replace(",", "")
    if not bare or bare == "-":
        return None
    return -float(bare) if cell[0] == "(" and cell[-1] == ")" else float(bare)


def read_year(text: str | None) -> int | None:
    m = re.search(YEAR, text or "")
    return int("20" + m[0].translate(_HAN_DIGITS)[2:]) if m else None


def label_of(text: str) -> str | None:
    """F16 on the Python side."""
    s = re.sub(r"截至.*止(?:六個月|六个月|九個月|九个月|年度|年).*$", "", text.strip().rstrip(":：")).strip().lower().replace("凈", "淨")
    return "subtotal" if s in SUBTOTALS else "final" if s in FINAL_TOTALS else None


def plain_name(text: str | None) -> str:
    return re.sub(r"^(?:其中[:：]?\s*|[-–—·•]{1,3}\s*)", "", (text or "").strip())


def plain_header(text: str | None) -> str:
    s = re.sub(YEAR + "|人民幣|人民币|港幣|港币|港元|美元|歐元|欧元|日圓|日元", "", (text or "").replace("\n", " "))
    s = re.sub("百萬|百万|萬|万|千|元|million|thousand|未經審核|未审核|未經審計|未审计|unaudited", "", s, flags=re.I)
    return re.sub(r"[()（）\s]+", "", s)


@dataclass
class Reading:
    """A grid with the lookups that the three ways of reading share."""

    rows: list[list[str]]
    labels: frozenset[str]  # the label keys that overlap a prior name
    has_names: bool
    year: int | None  # of the text around the grid
    years_said: tuple[int, ...]  # all of that text, in order
    end: date | None
    months: int

    def __post_init__(self) -> None:
        self.width = max(map(len, self.rows), default=0)

    def cell(self, row: int, col: int) -> str:
        return self.rows[row][col] if 0 <= col < len(self.rows[row]) else ""

    def number(self, row: int, col: int) -> float | None:
        return read_number(self.cell(row, col))

    def numbers(self, row: int) -> int:
        return sum(read_number(c) is not None for c in self.rows[row])

    def joined(self, row: int) -> str:
        return " ".join(self.rows[row])

    def known(self, name: str) -> bool:
        """A name contains a prior name or is contained in one."""
        return name.replace(" ", "") in self.labels

    def header(self, col: int, width: int | None = None) -> str:
        """P9 on the Python side."""
        w = self.width if width is None else width
        at = ((r, col - max(0, w - len(r))) for r in self.rows[:5])
        return " ".join(r[c] for r, c in at if 0 <= c < len(r))

    def cut_at_break(self) -> None:
        """Rows from the first label without numbers that no prior name explains, once data has begun."""
        if not self.has_names:
            return
        begun = False
        for i, r in enumerate(self.rows):
            name = plain_name(r[0]) if r else ""
            filled = any(read_number(c) is not None for c in r[1:])
            if begun and name and not filled and not self.known(name) and r[0].strip()[:1] not in _DASHES and not _has(REVENUE, name) and not _has(PROFIT_LINE, name):
                self.rows = self.rows[:i]
                return
            begun = begun or bool(name) and filled

    def period(self, year: int) -> tuple[date, date]:
        """Start and end of the period in a year."""
        if self.end is None:
            end = date(year, 12, 31)
        else:
            end = _day(year, self.end.month, self.end.day)
        m = end.year * 12 + end.month - 1 - self.months
        return _day(m // 12, m % 12 + 1, end.day) + timedelta(days=1), end

    def years(self, implicit: bool) -> list[tuple[int, int]]:
        """Columns with numbers and their years: by header, by this and last year in the first rows, by the text."""
        said = {w: {c for r in self.rows[:3] for c, x in enumerate(r) if any(k in x for k in ks)} for w, ks in (("this", ("本年", "本期")), ("prior", ("上年", "上期")))}
        out = []
        for c in range(self.width):
            head = self.header(c)
            if _has(NOTE, head):
                continue
            y = read_year(head)
            if y is None and implicit and self.year:
                y = self.year if c in said["this"] else self.year - 1 if c in said["prior"] else None
            y = y or self.year
            if y and any(self.number(i, c) is not None for i in range(len(self.rows))):
                out.append((c, y))
        return out


def _day(year: int, month: int, day: int) -> date:
    last = (date(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)).day
    return date(year, month, min(day, last))


Fact = tuple[str, float, date, date]
TOTAL = "合计"


def _totals(facts: list[Fact]) -> list[Fact]:
    """A4: sums by period, where a grid states no total."""
    sums: dict[tuple[date, date], float] = {}
    for _, amount, a, b in facts:
        sums[a, b] = sums.get((a, b), 0.0) + amount
    return [(TOTAL, v, a, b) for (a, b), v in sums.items()]


def facts_by_columns(g: Reading) -> list[Fact]:
    """Products down one column, a period in each of the others."""
    g.cut_at_break()
    years = g.years(implicit=True)
    years = [x for x in years if _has(REVENUE, g.header(x[0]))] or years
    years = list({y: (c, y) for c, y in years}.values())  # A6: the last column of a year
    if not years:
        return []

    def weight(c: int) -> tuple[int, int, int]:
        labels = [n for r in g.rows if c < len(r) and (n := plain_name(r[c]))]
        return sum(map(g.known, labels)), len(labels), sum(_has("[一-鿿]", x) for x in labels)

    names = max(range(g.width), key=lambda c: (*weight(c), -c))  # A10
    last = max((i for i in range(len(g.rows)) if any(g.number(i, c) is not None for c, _ in years)), default=-1)
    facts: list[Fact] = []
    stated: dict[str, list[int]] = {"final": [], "subtotal": []}

    def read(i: int, name: str) -> list[Fact]:
        return [(name, v, *g.period(y)) for c, y in years if (v := g.number(i, c)) is not None]

    for i, r in enumerate(g.rows):
        if not r or _has(HEADER, g.joined(i)):
            continue
        name = plain_name(g.cell(i, names))
        if not name:
            if i == last and any(read_number(x) is not None for x in r[1:3]):  # W10
                stated["final"].append(i)
        elif kind := label_of(name):
            stated[kind].append(i)
        elif not _has(f"^(?:{METRIC})$", name) and (g.known(name) or not _has(RECOGNITION, name) and (_has(REVENUE, name) or not _has(METRIC_WITHIN, name))):  # F18
            facts += read(i, name)
    totals = [t for i in (stated["final"] or stated["subtotal"]) for t in read(i, TOTAL)]  # A5
    if not totals and not stated["final"] and not stated["subtotal"]:
        return facts + _totals(facts)
    of = {(a, b): v for _, v, a, b in totals}

    def is_caption(f: Fact) -> bool:
        """a revenue caption, no prior name, whose amount is the total."""
        total = of.get(f[2:])
        wide = _has(REVENUE, f[0]) and (_has(METRIC_WITHIN, f[0]) or _has(f"^(?:{REVENUE_LABEL})$", f[0]))
        return wide and not g.known(f[0]) and total is not None and abs(f[1] - total) <= max(0.01 * max(abs(f[1]), abs(total)), 1)

    return [f for f in facts if not is_caption(f)] + totals


def facts_by_rows(g: Reading) -> list[Fact]:
    """E5: products across a header row, their revenue in a row below."""
    g.cut_at_break()
    n = range(len(g.rows))
    named = [i for i in n if _has(REVENUE, g.joined(i))]
    metric = min((i for i in named if g.numbers(i) and not _has(PROFIT_LINE, g.joined(i))), key=lambda i: (not _has(EXTERNAL, g.joined(i)), i), default=None)  # W11
    if metric is None and named:  # W12
        near = [i for i in range(named[0], min(len(g.rows), named[0] + 8)) if g.numbers(i) > 1 and not _has(PROFIT_LINE, g.joined(i))]
        metric = max(near, key=lambda i: (g.numbers(i), -i), default=None)
    if metric is None and g.rows:
        filled = sum(any(g.number(i, c) is not None for i in n) for c in range(len(g.rows[0])))
        if filled >= 2 or filled and any(read_year(x) for x in g.rows[0]):
            free = [i for i in n if g.numbers(i) and not _has(HEADER, g.joined(i)) and not _has(PROFIT_LINE, g.joined(i))]
            metric = max(free, key=lambda i: (g.numbers(i), -i), default=None)
    if metric is None:
        return []
    above = {i: [h for x in g.rows[i] if (h := plain_header(x)) and read_year(x) is None and read_number(x) is None and x.strip() not in _DASHES] for i in range(metric)}
    label = max((i for i in above if len(above[i]) >= 2), key=lambda i: (sum(map(g.known, above[i])), -i), default=None)  # W13
    if label is None:
        first = g.cell(metric, 0).strip()
        if not first or read_number(first) is not None or read_year(first) or first in _DASHES or _has(f"^(?:{REVENUE_LABEL}|{METRIC})$", first):
            return []
        label = metric
    width = len(g.rows[metric])
    data = next((c for c in range(width) if g.number(metric, c) is not None), 0)
    shift = data - next((c for c, x in enumerate(g.rows[label]) if x), 0)  # W14
    body = " ".join(g.joined(i) for i in n)
    relative = g.year if "本年" in body or "上年" in body else None
    facts: list[Fact] = []
    stated: dict[str, list[Fact]] = {"final": [], "subtotal": []}
    for c, x in enumerate(g.rows[label]):
        name, amount = plain_header(x), g.number(metric, c + shift)
        head = g.header(c + shift, width)
        year = read_year(head)
        if year is None and relative:
            year = relative if re.search("本年|本期", head) else relative - 1 if re.search("上年|上期", head) else None
        year = year or g.year
        if not name or amount is None or year is None:
            continue
        kind = label_of(name)
        (stated[kind] if kind else facts).append((TOTAL if kind else name, amount, *g.period(year)))
    return facts + (stated["final"] or stated["subtotal"] or _totals(facts))


def facts_by_statement(g: Reading) -> list[Fact]:
    """Products next to the revenue line of a statement of profit or loss."""
    n = len(g.rows)
    years = g.years(implicit=False)
    if not years and g.years_said:  # the years of the text, given to the columns of numbers in order
        filled_columns = [c for c in range(1, g.width) if any(g.number(i, c) is not None for i in range(len(g.rows)))]
        years = [(c, g.years_said[min(k, len(g.years_said) - 1)]) for k, c in enumerate(filled_columns)]
    if not years:
        return []
    first = [g.cell(i, 0).strip() for i in range(n)]
    filled = [g.numbers(i) > 0 for i in range(n)]
    heads = [[g.cell(i, c).strip() for c in (0, 1)] for i in range(n)]
    searches = (  # W16
        (i for i in range(n) if any(_has(f"^(?:{REVENUE_LABEL})$", h) for h in heads[i])),
        (i for i in range(n) if filled[i] and any(_has(REVENUE, h) for h in heads[i])),
        (i for i in range(n) if first[i] and (first[i].startswith("-") or g.known(first[i])) and any(read_number(x) is not None for x in g.rows[i][1:])),
    )
    revenue = next((i for s in searches for i in s), None)
    if revenue is None:
        return []

    def run(order: range) -> tuple[list[int], int | None]:
        """Rows with numbers until a total, a nameless row or another line of the statement."""
        found: list[int] = []
        for i in order:
            if label_of(first[i]) or not first[i] or _has(PROFIT_LINE, first[i]) and not g.known(first[i]):
                return found, i if not first[i] and filled[i] else None
            if filled[i]:
                found.append(i)
        return found, None

    products = [(i, plain_name(first[i])) for i in reversed(run(range(revenue - 1, max(-1, revenue - 9), -1))[0])]
    total = revenue
    if not products:
        below, nameless = run(range(revenue + 1, min(n, revenue + 9)))
        products = [(i, plain_name(first[i])) for i in below]
        total = revenue if nameless is None else nameless
    if not products:
        for i in range(revenue + 1, min(n, revenue + 30)):
            if first[i].startswith("-") and not filled[i]:
                if i + 1 < n and filled[i + 1]:
                    products.append((i + 1, plain_name(first[i])))
            elif label_of(first[i]):
                break

    def read(i: int, name: str) -> list[Fact]:
        return [(name, v, *g.period(y)) for c, y in years if (v := g.number(i, c)) is not None]

    facts = [f for i, name in products for f in read(i, name)]
    return facts + (read(total, TOTAL) or _totals(facts))


STRATEGIES = {"product_in_columns": facts_by_columns, "product_in_rows": facts_by_rows, "profit_loss": facts_by_statement}


FACT = "table_id string, fact_no int, metric string, product_name string, amount double, start_date date, end_date date, currency string, unit string, error string"


def grid_facts(grids: DataFrame) -> DataFrame:
    """Facts of all grids: (table_id, fact_no, metric, product_name, amount, start_date, end_date, currency, unit, error).

    ``grids`` has table_id, grid, classification, known and has_names (``with_names``), and of the text around it
    period_year, period_years, period_end, period_months (12 for null), currency, unit. A grid of no known class and
    a null grid give no row; one that can't be read gives a row with the error alone, and fails no other (C5).
    """
    columns = [x.split(" ")[0] for x in FACT.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                rows = [[str(x) if x is not None else "" for x in row] for row in r.grid if row is not None]
                known = frozenset(r.known if r.known is not None else ())
                said = tuple(sorted(set(map(int, r.period_years)))) if r.period_years is not None else ()
                months = 12 if pd.isna(r.period_months) else int(r.period_months)
                year = None if pd.isna(r.period_year) else int(r.period_year)
                try:
                    facts = STRATEGIES[r.classification](Reading(rows, known, bool(r.has_names), year, said, r.period_end if isinstance(r.period_end, date) else None, months))
                except (ValueError, OverflowError, IndexError, TypeError, AttributeError) as e:
                    out.append((r.table_id, 0, "MBREVENUE", None, None, None, None, None, None, f"{type(e).__name__}: {e}"))
                    continue
                out += [(r.table_id, k, "MBREVENUE", *f, r.currency, r.unit, None) for k, f in enumerate(facts)]
            yield pd.DataFrame(out, columns=columns)

    known_class = grids.where(F.col("classification").isin(*STRATEGIES) & F.col("grid").isNotNull())
    return known_class.select("table_id", "grid", "classification", "known", "has_names", "period_year", "period_years", "period_end", "period_months", "currency", "unit").mapInPandas(read, FACT)
