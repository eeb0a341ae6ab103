"""Lines of documents: cleaning, headings, sections.

Lines come as (infocode, page_number, line_no, text, x0, x1, top, bottom), ordered by line_no within an
infocode. Every window is over a page, or over a stretch of line numbers with totals of earlier stretches
added, so that a document of any length is spread over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import has_han, is_number

#: Line numbers of one stretch.
STRETCH = 4096


@dataclass(frozen=True)
class PageRules:
    """Where on a page what kind of line is no content. Distances in points from the top."""

    footnote_below: float = 730
    footnote_marks: tuple[str, ...] = ("指", "此处披露的是")
    low_footnote_below: float = 750
    low_footnote_marks: tuple[str, ...] = ("上述",)
    page_mark_above: float = 120
    page_mark: str = "附註"
    number_below: float = 750
    header_above: float = 50
    header_mark: str = "募集说明书"


@dataclass(frozen=True)
class TitleRules:
    """What makes a line a heading: patterns that settle it, patterns that rule it out, patterns that suggest it."""

    sure: tuple[str, ...] = field(default=())
    never: tuple[str, ...] = field(default=())
    likely: tuple[str, ...] = field(default=())
    short: int = 6
    short_left_of: float = 90
    left_of: float = 200


# Patterns of headings in Hong Kong announcements.
_ENUMERATOR = r"^[\(（]*[、\)）.．。]*"
TITLES = TitleRules(
    sure=(
        r"^(近[一二三四五六七八九])年", r"(按.*(地區|地区|地域|區域|区域|所在地).*劃分)", r"按.*(收入|收益|業績)", r"^(其他分部資料:｜綜合全面收益表)$", r"(分部.*如下:|董事|概要)$",
        _ENUMERATOR + r"[1234567890一二三四五六七八九十①②③④⑤⑥⑦⑧⑨A-Da-di]+[、\)）.．。]*.*(來自|分部資料|財務信息|分部報告|Disaggregationofrevenue)",
        r"截至.*分部資料", r"^下表.*(明細|:)", r"^註釋", r"^未經.*(表)", r"^(下表|本集團).*(:)$",
    ),
    never=(
        r"^(一般)", r"^[一二三四五六七八九十0123456789]+(室|期|级|类|个|家|致)", r"^[一二三四五六七八九十0123456789]+個月$", r"^(\d{4}年|\d{2}月|202\d)", r"^\d+(个月|年)", r"^\(\d+(个月|年)",
        r"^\d+\-\d+(个月|年)", r"[。%;；《》]", r"^(四川|十堰|三峡|三一|一大|九江|五矿)", r"(元|位于|注册资本为|100|合計|小計|準則|董事)", r"^(披露)$", r"^(截).*(月|年度)$",
        r"^(於|于)\s*\d{4}年\d{1,2}月\d{1,2}日", r"^[一二三四五六七八九十零]{4}年$",
    ),
    likely=(
        _ENUMERATOR + r"[一二三四五六七八九十①②③④⑤⑥⑦⑧⑨A-Da-di]+[、\)）.．。]*",
        _ENUMERATOR + r"[1234567890]+[、\)）.．。]*.*(表|收入|收益|附註|資產|事項|分部|業績|融資成本|股息|盈利|應付|賬款|概要|會計)",
        r"(表|附註|各項:|如下:|劃分|董事|收益分類:)$", r"按.*(劃分|分)",
        r"^(地域資料|分部.*業績|有關.*資料|可呈報.*對賬|管理層.*分析|分部資料|下表.*業績:|財務摘要|摘要|業績分析|分部資產及負債|國際財務報告準則|股息|致謝|主要市場指標|附註:|董事|董事會報告書|主要風險及不確定性|環境政策及表現|流動資金及財務資源|分列.*資料|資本架構|資產抵押|業務回顧|分類資料|物業租賃|金融服務|分部報告|可呈報.*業績|財務業績|銷售數量|財務回顧|主要策略性投資|按.*資產|收入及其構成|資源投資|地區資料|公司亮點|年度業績概覽|企業戰略|獎項及殊榮)$",
    ),
)


def _one_of(patterns: tuple[str, ...]) -> str:
    return "|".join(f"(?:{p})" for p in patterns) if patterns else "(?!)"


def content_lines(lines: DataFrame, rules: PageRules = PageRules()) -> DataFrame:
    """Lines without footnotes, marked pages, a last page number and a first running header.

    A page with the mark near its top goes whole. Null texts are kept as no pattern fits them; a null
    position fits no rule.
    """
    t = F.coalesce("text", F.lit(""))
    digit_first = t.rlike(r"^\d")
    footnote = digit_first & ((F.col("bottom") > rules.footnote_below) & t.rlike(_one_of(rules.footnote_marks)) | (F.col("bottom") > rules.low_footnote_below) & t.rlike(_one_of(rules.low_footnote_marks)))
    marked = F.coalesce((F.col("top") < rules.page_mark_above) & t.contains(rules.page_mark), F.lit(False))
    page = Window.partitionBy("infocode", "page_number")
    first, last = page.orderBy("line_no"), page.orderBy(F.desc("line_no"))
    kept = lines.withColumn("_drop", F.max(marked).over(page)).where(~F.col("_drop") & ~F.coalesce(footnote, F.lit(False))).drop("_drop")
    kept = kept.withColumn("_last", F.row_number().over(last))
    kept = kept.where(~F.coalesce((F.col("_last") == 1) & (F.col("bottom") > rules.number_below) & t.rlike(r"^\d+$"), F.lit(False))).drop("_last")
    kept = kept.withColumn("_first", F.row_number().over(first))
    return kept.where(~F.coalesce((F.col("_first") == 1) & (F.col("top") < rules.header_above) & t.contains(rules.header_mark), F.lit(False))).drop("_first")


def title_flag(text: Column, x0: Column, rules: TitleRules = TITLES) -> Column:
    """a line is a heading. The first condition that holds decides; null and empty lines are none."""
    t = F.coalesce(text, F.lit(""))
    digits = F.length(F.regexp_replace(t, r"[^\d]", ""))
    count = lambda ch: F.length(t) - F.length(F.replace(t, F.lit(ch), F.lit("")))
    plain_short = ~t.rlike(r"[\dA-Za-z,.。]") & has_han(t) & (F.length(t) <= rules.short) & (x0 < rules.short_left_of)
    return (
        F.when((t == "") | (digits > 5) | is_number(t), False)
        .when(~has_han(t) & ~t.contains("revenue"), False)
        .when(t.rlike(r"\d{3,}$"), False)
        .when(plain_short, True)
        .when(t.rlike(_one_of(rules.sure)), True)
        .when(x0 > rules.left_of, False)
        .when(t.rlike(_one_of(rules.never)), False)
        .when(t.rlike(r"^[一二三四五六七八九十][一-鿿]+") & (F.length(t) > 5) & ~F.substring(t, 1, 5).rlike(r"[!-/:-@\[-`{-~]"), False)
        .when((count(",") >= 3) | (count("、") >= 3) | (count(".") >= 3) | ((count(".") >= 2) & (digits >= 5)), False)
        .otherwise(t.rlike(_one_of(rules.likely)))
    )


def running_total(df: DataFrame, group: str, order: str, value: Column, out: str, stretch: int = STRETCH) -> DataFrame:
    """``df`` with the running sum of ``value`` by ``order`` within ``group``, in two levels.

    Sums run within stretches of ``order`` (a dense integer); the totals of earlier stretches, one row each,
    are added. So no task holds a whole group.
    """
    keep = df.columns
    df = df.withColumn("_stretch", F.floor(F.col(order) / stretch)).withColumn("_value", value)
    within = Window.partitionBy(group, "_stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(group).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(group, "_stretch").agg(F.sum("_value").alias("_total"))
    totals = totals.select(F.col(group).alias("_g"), F.col("_stretch").alias("_s"), F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    run = df.withColumn("_run", F.sum("_value").over(within)).join(totals, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_stretch") == F.col("_s")))
    return run.select(*keep, (F.col("_run") + F.col("_before")).alias(out))


def sectionize(lines: DataFrame, is_title: Column | None = None) -> DataFrame:
    """Lines with ``section_id``: a heading opens a section; lines before the first are section 0."""
    flag = title_flag(F.col("text"), F.col("x0")) if is_title is None else is_title
    return running_total(lines, "infocode", "line_no", F.coalesce(flag, F.lit(False)).cast("int"), "section_id")


def section_table(lines: DataFrame) -> DataFrame:
    """One row for each section: first line, its text, number of lines, thousands-grouped numbers in it."""
    first = F.min_by(F.struct("line_no", "text"), "line_no")
    grouped = F.coalesce(F.col("text").rlike(r"\d{1,3}(,\d{3})+"), F.lit(False))
    return lines.groupBy("infocode", "section_id").agg(
        first.alias("f"), F.count("*").alias("n_lines"), F.max(grouped).alias("has_grouped"), F.min("page_number").alias("page_from"), F.max("page_number").alias("page_to"),
    ).select("infocode", "section_id", F.col("f.line_no").alias("first_line"), F.col("f.text").alias("title"), "n_lines", "has_grouped", "page_from", "page_to")


def merge_headings(sections: DataFrame, word: str, most: int = 4, only_without_numbers: bool = False) -> DataFrame:
    """A short section whose title has ``word`` gives its title to the next section and goes.

    The next section then begins with that title and may itself be short, so merges cascade. Whether a
    section receives a title depends on the one before only through one bit; each section is a function of
    that bit: constant, passing it on, or turning it. The bit is therefore the value of the last constant
    before, turned as often as turning sections follow it: windows instead of a loop.

    Returns the sections that stay, with ``carried_line`` and ``carried_title`` where one was received.
    """
    order = Window.partitionBy("infocode").orderBy("section_id")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fits = (lambda extra: (F.col("n_lines") + extra <= most) & (~F.col("has_grouped") if only_without_numbers else F.lit(True)))
    has_next = F.lead("section_id").over(order).isNotNull()
    s = sections.withColumn("_next", has_next)
    s = s.withColumn("_f0", F.col("_next") & F.coalesce(F.col("title").rlike(word), F.lit(False)) & fits(0)).withColumn("_f1", F.col("_next") & fits(1))
    s = s.withColumn("_turns", (F.col("_f0") & ~F.col("_f1")).cast("int"))
    s = s.withColumn("_turned", F.coalesce(F.sum("_turns").over(before), F.lit(0)))
    fixed = F.when(F.col("_f0") == F.col("_f1"), F.struct(F.col("_f0").alias("bit"), (F.col("_turned") + F.col("_turns")).alias("turned")))
    s = s.withColumn("_last", F.last(fixed, ignorenulls=True).over(before))
    parity = (F.col("_turned") - F.coalesce("_last.turned", F.lit(0))) % 2
    s = s.withColumn("_bit", F.coalesce("_last.bit", F.lit(False)) != (parity == 1))
    s = s.withColumn("_gone", F.when(F.col("_bit"), F.col("_f1")).otherwise(F.col("_f0")))
    origin = F.last(F.when(~F.col("_bit"), F.struct("first_line", "title")), ignorenulls=True).over(before)
    s = s.withColumn("_from", F.when(F.col("_bit"), origin))
    return s.where(~F.col("_gone")).select(*sections.columns, F.col("_from.first_line").alias("carried_line"), F.col("_from.title").alias("carried_title"))


def merged_sections(sections: DataFrame) -> DataFrame:
    """W2 then W3: lone headings of revenue, then descriptions of segments without numbers."""
    once = merge_headings(sections, "收入|收益")
    titled = once.select(
        "infocode", "section_id", F.coalesce("carried_line", "first_line").alias("first_line"), F.coalesce("carried_title", "title").alias("title"),
        (F.col("n_lines") + F.col("carried_line").isNotNull().cast("int")).alias("n_lines"),
        (F.col("has_grouped") | F.coalesce(F.col("carried_title").rlike(r"\d{1,3}(,\d{3})+"), F.lit(False))).alias("has_grouped"), "page_from", "page_to",
    )
    return merge_headings(titled, "分部", only_without_numbers=True)


def readable_documents(lines: DataFrame) -> DataFrame:
    """(infocode, readable): whether any line of a document has Chinese text."""
    return lines.groupBy("infocode").agg(F.max(has_han(F.col("text"))).alias("readable"))
