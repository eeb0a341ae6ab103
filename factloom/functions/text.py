"""Text functions: widths, white space, names, labels. Nulls give null unless a docstring says otherwise."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Circled digits and the enumerators they stand for.
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩"
# Labels of totals and subtotals in tables of revenue.
FINAL_TOTALS = (
    "合計", "合计", "總計", "总计", "總額", "总额", "總收入", "总收入", "總收益", "总收益", "淨收益總額", "净收益总额", "收益總額", "收入總額", "銷售淨額", "销售净额",
    "總營業額", "总营业额", "集團總額", "集团总额", "綜合", "综合", "本集團", "本集团", "集團", "集团", "合併", "合并", "total",
)
SUBTOTALS = (
    "可報告分部總計", "可報告分部总计", "可呈報分部總計", "可呈報分部总计", "須予報告分部小計", "应予报告分部小计", "應呈報分類總計", "應呈報分類总计", "持續經營分類總計", "持续经营分类总计",
    "報告分部總計", "报告分部总计", "分部總計", "分部总计", "分部總額", "分部总额", "分部小計", "分部小计", "擔保費收益總額", "担保费收益总额", "擔保費收益淨額", "担保费收益净额",
    "收益總額", "收益淨額", "收益净额", "收入總額", "收入总额", "銷售產品", "销售产品", "提供服務", "提供服务", "主要地區收益總額", "主要地区收益总额", "來自客户合約的收益", "來自客戶合約的收益",
    "來自客户合約的收入", "來自客戶合約的收入", "來自客户合約之總收入", "來自客戶合約之總收入", "按客户類型劃分的收益總額", "按客戶類型劃分的收益總額", "第三方", "關聯方", "可呈報分部", "可報告分部",
    "小計", "小计", "subtotal", "sub-total",
)
# Traditional characters that the strong name normalisation folds, and their simplified forms.
STRONG_FOLD = ("臺裡裏為於與業務產銷售開發網據聯車醫藥護兒電纜風險資產物業項類體國華萬億圓號", "台里里为于与业务产销售开发网据联车医药护儿电缆风险资产物业项类体国华万亿圆号")
YEAR = r"(20\d{2}|二零[〇零一二三四五六七八九]{2}|二〇[〇零一二三四五六七八九]{2})"
NUMBER = r"^\(?-?[\d,]+(\.\d+)?\)?$"


@lru_cache(maxsize=1)
def width_tables() -> tuple[str, str, dict[str, str]]:
    """Characters of wide or full width with another compatibility form: one-to-one pairs and expansions."""
    src, dst, more = ["戶"], ["户"], {}
    for cp in range(0x1100, 0x30000):
        ch = chr(cp)
        if unicodedata.east_asian_width(ch) in "FW" and (to := unicodedata.normalize("NFKC", ch)) != ch:
            if len(to) == 1:
                src.append(ch)
                dst.append(to)
            else:
                more[ch] = to
    return "".join(src), "".join(dst), more


def _class_of(chars: str) -> str:
    """A class of regular expressions of characters, neighbours as ranges: far faster than one by one."""
    points = sorted(set(map(ord, chars)))
    starts = [p for p, before in zip(points, [-1, *points], strict=False) if p != before + 1]
    ends = [p for p, after in zip(points, [*points[1:], -1], strict=True) if after != p + 1]
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{e:x}}}" for a, e in zip(starts, ends, strict=True)) + "]"


def fold_width(c: Column) -> Column:
    """Every wide or full-width character in its compatibility form, and 戶 as 户; others stay."""
    src, dst, more = width_tables()
    one = F.translate(c, src, dst)
    expand = F.str_to_map(F.lit("\u0001".join(f"{a}\u0002{b}" for a, b in more.items())), F.lit("\u0001"), F.lit("\u0002"))  # folded to one constant
    spelled = F.array_join(F.transform(F.split(one, ""), lambda x: F.coalesce(expand[x], x)), "")
    return F.when(c.rlike(_class_of("".join(more))), spelled).otherwise(one)


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none outside."""
    return F.regexp_replace(F.regexp_replace(c, r"\s+", " "), r"^ | $", "")


def strip(c: Column) -> Column:
    """White space of any kind off both ends."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def match_key(c: Column) -> Column:
    """Dashes alike, none leading, no white space."""
    s = F.regexp_replace(squeeze(c), "[—–−－]", "-")
    return F.regexp_replace(F.regexp_replace(s, "^-+", ""), r"\s+", "")


def name_key(c: Column) -> Column:
    """Lower case without white space."""
    return F.lower(F.regexp_replace(c, r"\s+", ""))


@F.pandas_udf(StringType())
def compatible(text: pd.Series) -> pd.Series:
    """The compatibility form (NFKC) of whole texts; no built-in expression composes characters."""
    return pd.Series([unicodedata.normalize("NFKC", t) if isinstance(t, str) else None for t in text], dtype=object)


def strong_name(c: Column) -> Column:
    """In compatibility form, simplified, lower case, without note brackets, punctuation and white space."""
    s = F.lower(F.translate(compatible(c), *STRONG_FOLD))
    s = F.regexp_replace(s, r"\([^)]*(附註|附注|note|[ivx\d]+)[^)]*\)|（[^）]*(附註|附注|note|[ivx\d]+)[^）]*）", "")
    return F.regexp_replace(s, r"[\s:：,，。;；、()（）\[\]【】/\\_\-–—]+", "")


def clean_name(c: Column) -> Column:
    """Without leading bullets or 其中."""
    return F.regexp_replace(strip(F.coalesce(c, F.lit(""))), r"^(其中[:：]?\s*|[-–—·•]{1,3}\s*)", "")


def clean_header(c: Column) -> Column:
    """A column header without years, currencies, units, audit marks, brackets and white space."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), YEAR, "")
    s = F.regexp_replace(s, "人民幣|人民币|港幣|港币|港元|美元|歐元|欧元|日圓|日元", "")
    s = F.regexp_replace(s, "(?i)百萬|百万|萬|万|千|元|million|thousand", "")
    s = F.regexp_replace(s, "(?i)未經審核|未审核|未經審計|未审计|unaudited", "")
    return F.regexp_replace(s, r"[()（）\s]+", "")


def is_number(c: Column) -> Column:
    """a plain or grouped number, brackets and blanks aside; false for null."""
    bare = F.regexp_replace(strip(c), r"[ ()]", "")
    return F.coalesce(bare.rlike(r"^[+-]?(\d{1,3}(,\d{3})*|\d+)(\.\d+)?$"), F.lit(False))


def has_han(c: Column) -> Column:
    """a Chinese character occurs."""
    return F.coalesce(c.rlike("[一-鿿]"), F.lit(False))


def line_text(c: Column) -> Column:
    """Narrow text without blanks, circled digits as enumerators, runs of four or more of one Chinese character as one."""
    s = F.regexp_replace(fold_width(c), " ", "")
    for i, ch in enumerate(CIRCLED, 1):
        s = F.replace(s, F.lit(ch), F.lit(f"{i}、"))
    return F.regexp_replace(s, r"([一-鿿])\1{3,}", "$1")


def _alternatives(words: tuple[str, ...]) -> str:
    return "(?i)^(" + "|".join(words) + ")$"


def label_kind(c: Column) -> Column:
    """F16: 'subtotal', 'final', or null for any other label; a trailing colon and period don't count."""
    s = F.regexp_replace(strip(c), "[:：]+$", "")
    s = strip(F.regexp_replace(s, "截至.*止(六個月|六个月|九個月|九个月|年度|年).*$", ""))
    s = F.replace(s, F.lit("凈"), F.lit("淨"))
    return F.when(s.rlike(_alternatives(SUBTOTALS)), "subtotal").when(s.rlike(_alternatives(FINAL_TOTALS)), "final")


_NUMBERS = r"\(?-?[\d,]+(?:\.\d+)?[%％]?\)?"
_LABELLED = r"^([一-鿿][一-鿿\s\-–—]+?)([\d,.\-\(\)%\s]+)$"


def _number_sequence(c: Column) -> Column:
    """Parts between white space; a part that holds several numbers as those."""
    parts = F.split(strip(c), r"\s+")
    return F.flatten(F.transform(parts, lambda p: F.when(F.size(F.regexp_extract_all(p, F.lit(_NUMBERS), 0)) > 1, F.regexp_extract_all(p, F.lit(_NUMBERS), 0)).otherwise(F.array(p))))


def number_pieces(c: Column) -> Column:
    """A label glued to numbers, and numbers glued to each other, each on its own; other texts stay whole."""
    label, rest = F.regexp_extract(c, _LABELLED, 1), F.regexp_extract(c, _LABELLED, 2)
    numbers = _number_sequence(c)
    return F.when(c.isNull(), None).when(c.rlike(_LABELLED), F.concat(F.array(strip(label)), _number_sequence(rest))).when(F.size(numbers) > 1, numbers).otherwise(F.array(c))


def page_range(pages: Column) -> Column:
    """Sorted page numbers as ranges: 1, 2, 3, 7 as '1-3, 7'; '' for none, null for null."""
    p = F.array_sort(F.array_distinct(pages))
    # a page starts a range when the one before it isn't there, and ends it when the next isn't
    starts, ends = F.filter(p, lambda x: ~F.array_contains(p, x - 1)), F.filter(p, lambda x: ~F.array_contains(p, x + 1))
    return F.array_join(F.zip_with(starts, ends, lambda a, b: F.when(a == b, a.cast("string")).otherwise(F.concat(a.cast("string"), F.lit("-"), b.cast("string")))), ", ")


def percent_text(c: Column) -> Column:
    """A share as a percentage with one decimal; '-' for null."""
    return F.coalesce(F.concat(F.format_number(c * 100, 1), F.lit("%")), F.lit("-"))


def html_text(c: Column) -> Column:
    """A text fit for HTML; '' for null."""
    s = F.coalesce(c, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        s = F.replace(s, F.lit(a), F.lit(b))
    return s


def title_kind(c: Column) -> Column:
    """What kind of section a title announces; 'other' for none, null for null."""
    return (
        F.when(c.isNull(), None)
        .when(c.rlike("損益表|损益表|收益表|綜合損益|综合损益|全面收益|全面收入|虧損表|亏损表"), "profit_loss")
        .when(c.contains("分部"), "segment")
        .when(c.rlike("產品|产品"), "product")
        .when(c.rlike("收入|收益|營業額|营业额"), "revenue")
        .when(c.rlike("附註|附注"), "note")
        .otherwise("other")
    )
