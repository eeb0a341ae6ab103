"""Amounts recorded in different units, scales and currencies, stated in one currency.

A unit text ("HK$'000", "人民幣百萬元", "US$ mn") is segmented by dynamic programming over tries of
prefixes (scale words), roots (currency words and counting words) and exponents ("'000", "10^6"). Ambiguous
decompositions are scored with the dimension the field is known to have: in a money field "m" is a million,
not a metre, and "RM" the ringgit, not a root after a prefix.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Scale words and their powers of ten.
PREFIXES = {
    "十": 1, "百": 2, "佰": 2, "千": 3, "仟": 3, "萬": 4, "万": 4, "億": 8, "亿": 8, "兆": 12,
    "hundred": 2, "hundreds": 2, "thousand": 3, "thousands": 3, "k": 3, "th": 3, "tsd": 3,
    "million": 6, "millions": 6, "mn": 6, "mln": 6, "mio": 6, "mm": 6, "m": 6,
    "billion": 9, "billions": 9, "bn": 9, "bln": 9, "b": 9, "mrd": 9, "trillion": 12, "trillions": 12, "tn": 12, "lakh": 5, "crore": 7,
}
# Exponents written with digits.
EXPONENTS = {"'000": 3, "000": 3, "'000,000": 6, "000,000": 6, "'000'000": 6, "'000000": 6, "10^3": 3, "10^6": 6, "10^9": 9, "1000": 3, "1000000": 6, "1,000": 3, "1,000,000": 6}
# Codes of the delivery format.
CODES = {"001": 0, "002": 3, "004": 6}
# Currency words; None is money of no stated currency.
MONEY = {
    "hkd": "HKD", "hk$": "HKD", "hk dollar": "HKD", "hk dollars": "HKD", "hong kong dollar": "HKD", "hong kong dollars": "HKD", "港元": "HKD", "港幣": "HKD", "港币": "HKD", "港紙": "HKD", "港圓": "HKD",
    "cny": "CNY", "cnh": "CNY", "rmb": "CNY", "renminbi": "CNY", "yuan": "CNY", "人民幣": "CNY", "人民币": "CNY",
    "usd": "USD", "us$": "USD", "u.s.$": "USD", "u.s. dollar": "USD", "u.s. dollars": "USD", "us dollar": "USD", "us dollars": "USD", "美元": "USD", "美金": "USD", "美圓": "USD",
    "sgd": "SGD", "s$": "SGD", "singapore dollar": "SGD", "singapore dollars": "SGD", "新加坡元": "SGD", "新元": "SGD", "坡元": "SGD", "新加坡幣": "SGD", "新加坡币": "SGD", "新幣": "SGD", "新币": "SGD",
    "eur": "EUR", "€": "EUR", "euro": "EUR", "euros": "EUR", "歐元": "EUR", "欧元": "EUR", "歐羅": "EUR",
    "jpy": "JPY", "yen": "JPY", "japanese yen": "JPY", "日圓": "JPY", "日元": "JPY", "日円": "JPY", "円": "JPY",
    "mop": "MOP", "mop$": "MOP", "pataca": "MOP", "patacas": "MOP", "澳門元": "MOP", "澳门元": "MOP", "澳門幣": "MOP", "澳门币": "MOP",
    "cad": "CAD", "c$": "CAD", "canadian dollar": "CAD", "canadian dollars": "CAD", "加元": "CAD", "加拿大元": "CAD", "加幣": "CAD", "加币": "CAD",
    "myr": "MYR", "rm": "MYR", "ringgit": "MYR", "林吉特": "MYR", "馬來西亞林吉特": "MYR", "马来西亚林吉特": "MYR", "馬幣": "MYR", "马币": "MYR", "令吉": "MYR",
    "元": None, "圓": None, "圆": None, "塊": None, "$": None, "¥": None, "￥": None, "dollar": None, "dollars": None,
}
# Words that count single units or only lead to the unit.
COUNTING = ("unit", "units", "單位", "单位", "in", "of", "個", "个", "one", "ones", "single", "單一", "currency", "amount", "amounts", "expressed", "figures", "all", "and", "以", "為", "为", "計", "计", "列示")
# Roots of other dimensions, kept so that a field's dimension decides between readings.
OTHER_DIMENSIONS = {"m": "length", "g": "mass", "t": "mass", "l": "volume", "b": "information", "k": "temperature", "米": "length", "噸": "mass", "吨": "mass", "公斤": "mass", "升": "volume"}


def _trie(words: dict[str, tuple]) -> dict:
    root: dict = {}
    for word, value in words.items():
        node = root
        for ch in word:
            node = node.setdefault(ch, {})
        node[""] = value
    return root


@lru_cache(maxsize=8)
def _tries(dimension: str) -> tuple[dict, ...]:
    """Tries of prefixes, roots and exponents; a payload is (score per letter, kind, value)."""
    prior = {"money": 1.0}.get(dimension, 0.5)
    prefixes = _trie({w: (prior, "scale", p) for w, p in PREFIXES.items()})
    money = {w: (1.2 if dimension == "money" else 0.6, "money", c) for w, c in MONEY.items()}
    counting = {w: (0.9, "count", None) for w in COUNTING}
    other = {w: (1.0 if dimension == d else 0.1, "other", d) for w, d in OTHER_DIMENSIONS.items()}
    return prefixes, _trie({**other, **counting, **money}), _trie({w: (1.0, "scale", p) for w, p in EXPONENTS.items()})


_FILL = re.compile(r"[\s:;,.()\[\]{}/\-–—_*=]")


@lru_cache(maxsize=65536)
def segment(text: str | None, dimension: str = "money") -> tuple[int | None, str | None, bool, bool]:
    """(power of ten, currency code, names money, readable) of a unit text.

    The segmentation maximises the summed scores of its parts; a letter in no part costs more than any part
    brings. Latin words match only at word borders, so that "b" isn't read out of "bond". Null, empty and
    blank texts give (None, None, False, False), as does a text with a letter left over.
    """
    if text is None:
        return None, None, False, False
    s = unicodedata.normalize("NFKC", text).lower().replace("’", "'").replace("‘", "'").replace("`", "'").strip()
    s = re.sub(r"\s+", " ", re.sub("[\u00ad\u200b-\u200f\u2060\ufeff]", "", s))
    if not s:
        return None, None, False, False
    if s in CODES:
        return CODES[s], None, False, True
    n = len(s)
    best: list = [None] * (n + 1)
    best[0] = (0.0, 0, None, 0, 0, False)  # score, power, currency, scales, unread, money
    latin = lambda c: c.isascii() and c.isalpha()
    for i in range(n):
        if best[i] is None:
            continue
        score, power, cur, scales, unread, money = best[i]
        fill = bool(_FILL.match(s[i]))
        step = (score - (0.01 if fill else 5.0), power, cur, scales, unread + (not fill), money)
        if best[i + 1] is None or step[0] > best[i + 1][0]:
            best[i + 1] = step
        for trie in _tries(dimension):
            node, j = trie, i
            while j < n and s[j] in node:
                node = node[s[j]]
                j += 1
                if "" not in node:
                    continue
                per, kind, value = node[""]
                # a Latin word ends where letters end, unless a known scale or currency word follows or precedes
                if latin(s[j - 1]) and j < n and latin(s[j]) or latin(s[i]) and i and latin(s[i - 1]):
                    per -= 0.35
                    if j - i == 1:
                        continue
                part = per * (j - i) - 0.3
                new_cur = value if kind == "money" and value else cur
                step = (score + part, power + (value if kind == "scale" else 0), new_cur, scales + (kind == "scale"), unread, money or kind == "money")
                if best[j] is None or step[0] > best[j][0]:
                    best[j] = step
    score, power, cur, scales, unread, money = best[n]
    if unread:
        return None, None, False, False
    return (power if scales else None), cur, money or not scales, True


_AMOUNT = re.compile(r"^(?P<pre>.*?)(?P<open>[(]\s*)?(?P<sign>[-−–]?)\s*(?P<mid>[^\d().,\-]*?)(?P<num>\d[\d,. ']*\d|\d)(?P<close>\s*[)])?(?P<post>.*)$", re.S)
_GROUPED = re.compile(r"^\d{1,3}(?:[, ']\d{3})+(?:\.\d+)?$|^\d+(?:\.\d+)?$")


@lru_cache(maxsize=65536)
def read_amount(text: str | None) -> tuple[str | None, str | None]:
    """(plain signed decimal text, words around it) of an amount, or (None, None) when it can't be read.

    Digits may be grouped by commas, spaces or apostrophes and written full width. Parentheses, a leading or
    a trailing minus make it negative. Null, blank, dashes and words without digits can't be read.
    """
    if text is None:
        return None, None
    s = unicodedata.normalize("NFKC", text)
    s = re.sub("[\u00ad\u200b-\u200f\u2060\ufeff]", "", s)
    s = re.sub(r"\s+", " ", s).strip()
    m = _AMOUNT.match(s)
    if not m or not _GROUPED.match(m["num"]):
        return None, None
    pre, post = m["pre"].strip(), m["post"].strip()
    bracket = bool(m["open"]) and (bool(m["close"]) or post.endswith(")"))
    minus = bool(m["sign"]) or bool(re.search(r"[-−–]$", pre)) or bool(re.match(r"^[-−–]", pre)) or post in ("-", "−")
    if re.match(r"^\(.*\)$", s):
        bracket = True
    words = re.sub(r"[()\-−–]", " ", f"{pre} {m['mid']} {post}").strip()
    if re.search(r"\d", words) and not re.search(r"'000|10\^", words):
        return None, None
    num = re.sub(r"[, ']", "", m["num"])
    return ("-" if bracket or minus else "") + num, words


_MEASURE = T.StructType([T.StructField("scale", T.IntegerType()), T.StructField("currency", T.StringType()), T.StructField("amount", T.StringType())])


@F.pandas_udf(_MEASURE)
def read_measure(unit: pd.Series, currency: pd.Series, amount: pd.Series) -> pd.DataFrame:
    """Reads the three texts of a row: power of ten, currency code, plain amount (null when unreadable).

    Texts repeat, so each distinct text is segmented once (bounded caches).
    """
    out = []
    for u, c, a in zip(unit, currency, amount, strict=True):
        num, words = read_amount(a)
        if num is None:
            out.append((None, None, None))
            continue
        u_power, u_cur, u_money, u_ok = segment(u)
        _, c_cur, _, _ = segment(c)
        w_power, w_cur, w_money, w_ok = segment(words)
        if words and not w_ok:  # words that are no unit: the cell isn't an amount
            out.append((None, None, None))
            continue
        if u_ok:
            power = u_power if u_power is not None else 0
        elif w_ok and w_power is not None:
            power = w_power
        else:
            power = None
        out.append((power, c_cur or u_cur or w_cur, num))
    df = pd.DataFrame(out, columns=["scale", "currency", "amount"])
    return df.astype({"scale": "Int32"})


def to_common_currency(flat: DataFrame, sources: DataFrame, rates: DataFrame, amount: str = "mbrevenue") -> DataFrame:
    """(row_id, currency_code, amount_hkd) of each row whose ``amount`` is readable.

    The scale stands in unit, else with the amount, else is the source's default_unit; the currency in
    currency, else in unit, else with the amount, else is the source's default_currency. The product with the
    rate is exact (DECIMAL) and rounded to whole numbers, halves away from zero. A row with an unreadable
    amount, an unknown source and no stated scale, or a currency not in ``rates`` gives no row; nor does a
    value beyond a long. ``sources`` and ``rates`` are fixed lists and are broadcast.
    """
    src = F.broadcast(sources.select("source_code", "default_unit", "default_currency"))
    rate = F.broadcast(rates.select(F.col("currency_code"), F.col("hkd_rate").cast("decimal(12,4)").alias("hkd_rate")))
    default = F.when(F.col("default_unit") == "001", 0).when(F.col("default_unit") == "002", 3).when(F.col("default_unit") == "004", 6)
    df = (
        flat.select("row_id", "source_code", read_measure(F.col("unit"), F.col("currency"), F.col(amount)).alias("m"))
        .where(F.col("m.amount").isNotNull())
        .join(src, "source_code", "left")
        .select("row_id", F.coalesce("m.currency", "default_currency").alias("currency_code"), F.coalesce("m.scale", default).alias("scale"), F.col("m.amount").alias("amount"))
        .join(rate, "currency_code")
    )
    return df.select("row_id", "currency_code", _whole_money(F.col("amount"), F.col("scale"), F.col("hkd_rate")).alias("amount_hkd")).where(F.col("amount_hkd").isNotNull())


def _whole_money(amount: Column, scale: Column, rate: Column) -> Column:
    """A plain decimal text times ten to ``scale`` times a rate, rounded to whole numbers, halves away from zero.

    The point is moved in the text; the whole part (20 digits) and the fraction (22) are multiplied apart, since
    no decimal type holds their product. Null where it is beyond a long.
    """
    bare = F.ltrim(amount, F.lit("-"))
    whole, part = F.substring_index(bare, ".", 1), F.when(bare.contains("."), F.substring_index(bare, ".", -1)).otherwise("")
    moved = F.concat(whole, F.rpad(F.substring(part, F.lit(1), scale), scale, F.lit("0")))
    rest = F.concat(F.lit("0."), F.substring(part, scale + 1, F.lit(22)), F.lit("0"))
    product = moved.try_cast("decimal(20,0)") * rate
    below = (product - F.floor(product)).cast("decimal(5,4)") + rest.cast("decimal(22,22)") * rate
    total = (F.floor(product).cast("decimal(30,0)") + F.round(below, 0)).try_cast("bigint")
    return F.when(amount.startswith("-"), -total).otherwise(total)
