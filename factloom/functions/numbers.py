"""Numbers read from text and written to it, units and currencies named in it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import NUMBER, strip

_PLAIN = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
# Currency marks in the order they are looked for, and the name each stands for.
CURRENCY_MARKS = (("HK$", "港元"), ("HK＄", "港元"), ("RMB", "人民币"), ("CNY", "人民币"), ("US$", "美元"), ("USD", "美元"), ("US＄", "美元"))
CURRENCY_WORDS = (
    ("人民币", "人民币"), ("人民幣", "人民币"), ("港元", "港元"), ("港幣", "港元"), ("美元", "美元"), ("欧元", "欧元"), ("歐元", "欧元"), ("日元", "日元"), ("日圓", "日元"),
    ("新加坡元", "新加坡元"), ("新元", "新加坡元"), ("加拿大元", "加拿大元"), ("马来西亚林吉特", "马来西亚林吉特"), ("馬來西亞林吉特", "马来西亚林吉特"), ("澳门元", "澳门元"), ("澳門元", "澳门元"),
)
# Unit words in the order they are looked for.
UNIT_WORDS = ("千港元", "千新元", "千新加坡元", "千元", "千美元", "千人民币", "百萬", "百万", "亿元", "億元", "万元", "萬元", "萬", "万", "元", "million", "thousand")


def to_double(c: Column) -> Column:
    """A permissive reading: null for blank, dashes, 'none', 'nan', 'null' and anything unreadable."""
    s = F.replace(strip(c), F.lit(","), F.lit(""))
    return F.when(s.rlike(_PLAIN), s.try_cast("double"))


def cell_number(c: Column) -> Column:
    """A whole cell as a number, in brackets negative; '(-5)' is 5; null for percentages and words."""
    negative = c.startswith("(") & c.endswith(")")
    bare = F.replace(F.regexp_replace(c, "^[( ]+|[) ]+$", ""), F.lit(","), F.lit(""))
    return F.when(c.rlike(NUMBER), F.when(negative, -bare.try_cast("double")).otherwise(bare.try_cast("double")))


def numeric_text(c: Column) -> Column:
    """The digits, points and minus signs of a text; empty for none. Brackets make it negative."""
    s = F.when(c.isin("", "-", "——") | c.isNull(), F.lit("")).when(~c.contains("-") & c.contains("(") & c.contains(")"), F.concat(F.lit("-"), c)).otherwise(c)
    return F.regexp_replace(s, r"[^\d.-]", "")


def number_text(c: Column) -> Column:
    """Whole numbers without decimals, others without trailing zeros; null gives ''."""
    s = F.regexp_replace(F.regexp_replace(c.cast("decimal(38,6)").cast("string"), r"0+$", ""), r"\.$", "")
    return F.coalesce(s, F.lit(""))


def unit_code(c: Column) -> Column:
    """004 for millions, 002 for thousands, 001 for any other unit, '' for none."""
    return F.when(F.coalesce(strip(c), F.lit("")) == "", "").when(c.rlike("百万|百萬"), "004").when(c.contains("千"), "002").otherwise("001")


_CURRENCIES = (*CURRENCY_MARKS, *CURRENCY_WORDS, ("$", "港元"), ("＄", "港元"))


def _first_rank(c: Column, tests: list[Column]) -> Column:
    """The place of the first test that holds; null for none."""
    out = F.when(tests[0], 0)
    for k, t in enumerate(tests[1:], 1):
        out = out.when(t, k)
    return out


def currency_rank(c: Column) -> Column:
    """The rank of the currency a text names first by rank; null for none. ``currency_name`` gives its name."""
    return _first_rank(c, [c.contains(mark) for mark, _ in _CURRENCIES])


def currency_name(rank: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(name) for _, name in _CURRENCIES]), rank), F.lit(""))


def currency_of(c: Column) -> Column:
    """The currency a text names first by rank; a bare $ is the Hong Kong dollar; '' for none."""
    return currency_name(currency_rank(c))


def unit_rank(c: Column) -> Column:
    """X11: the rank of the unit a text names first by rank; null for none. ``unit_name`` gives its name."""
    return _first_rank(c, [c.rlike(r"\$\s*'?000|'000"), *[c.contains(word) for word in UNIT_WORDS]])


def unit_name(rank: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(word) for word in ("千元", *UNIT_WORDS)]), rank), F.lit(""))


def unit_of(c: Column) -> Column:
    """X11: the unit a text names first by rank; '' for none."""
    return unit_name(unit_rank(c))


def number_variants(c: Column) -> Column:
    """The texts a number may appear as: plain and grouped, and for negatives signed and in brackets; none for null."""

    def grouped(plain: Column) -> Column:
        whole, part = F.substring_index(plain, ".", 1), F.regexp_extract(plain, r"(\..*)$", 1)
        return F.array(plain, F.concat(F.format_number(whole.cast("decimal(38,0)"), 0), part))

    # A lambda over a one-element array binds the value once, where a nested expression would be repeated in code.
    both = F.transform(F.array(number_text(F.abs(c))), grouped)
    signs = F.when(c < 0, F.array(F.lit("%s"), F.lit("-%s"), F.lit("(%s)"))).otherwise(F.array(F.lit("%s")))
    forms = F.flatten(F.transform(F.flatten(both), lambda x: F.transform(signs, lambda s: F.replace(s, F.lit("%s"), x))))
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(F.array_distinct(forms))
