"""Visually identical text with different characters, brought to one form.

A transducer over grapheme clusters applies one precomputed mapping in a single pass: widths, composition
of accents, kinds of spaces, invisible characters and look-alike letters. The mapping is compiled once
from rules and Unicode data: what each character is spelled with, and which mark joins which letter to what.
Both parts are checked for conflicts: the mapping is idempotent, no output is itself an input, and a letter
with its mark gives the same whether it came as one character or as two.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import shared_dir

# Letters of other scripts drawn like Latin ones, and what they look like.
LOOKALIKES = {
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P",
    "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Ԁ": "D", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W", "Ь": "b", "Һ": "h",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "һ": "h",
    "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l", "ү": "y", "Ӏ": "I", "ѵ": "v", "Ѵ": "V",
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ϲ": "c", "ϳ": "j", "Ϲ": "C", "Ϳ": "J",
    # Armenian and others
    "օ": "o", "ս": "u", "հ": "h", "ց": "g", "ո": "n", "Տ": "S", "Օ": "O", "Լ": "L",
    "ɡ": "g", "ɑ": "a", "ᴏ": "o",
    # Lisu
    "ꓮ": "A", "ꓐ": "B", "ꓚ": "C", "ꓓ": "D", "ꓰ": "E", "ꓝ": "F", "ꓖ": "G", "ꓧ": "H", "ꓲ": "I", "ꓙ": "J", "ꓗ": "K", "ꓡ": "L", "ꓟ": "M",
    "ꓠ": "N", "ꓳ": "O", "ꓑ": "P", "ꓣ": "R", "ꓢ": "S", "ꓔ": "T", "ꓴ": "U", "ꓦ": "V", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓜ": "Z",
    # Cherokee
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ᏻ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M", "Ꮲ": "P", "Ꮢ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
    # Coptic
    "Ⲁ": "A", "Ⲃ": "B", "Ⲉ": "E", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "Ⲣ": "P", "Ⲥ": "C", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X", "Ⲍ": "Z", "ⲟ": "o", "ⲥ": "c",
}
# Single spaces of any kind.
SPACES = "\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
# Hyphens drawn alike.
HYPHENS = "\u2010\u2011\ufe63\uff0d"

# Characters that always stand for themselves, as a class of regular expressions.
PLAIN = "\\x00-\\x7f\u00c0-\u017f\u3001\u3002\u4e00-\u9fff\uac00-\ud7a3"


def _invisible(ch: str) -> bool:
    """Format characters, joiners, fillers and variation selectors, which show nothing."""
    cp = ord(ch)
    return unicodedata.category(ch) == "Cf" and cp not in range(0x600, 0x606) or cp in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0) or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF or 0x180B <= cp <= 0x180F


def build_mapping() -> dict[str, str]:
    """Every single character with another look-alike form, from rules over Unicode data.

    Widths, ligatures, mathematical alphabets, Kangxi radicals and characters that are another one by definition
    follow the character database; spaces, hyphens and look-alike letters the fixed values above.
    """
    out: dict[str, str] = {}
    for cp in (*range(0x80, 0x30000), *range(0xE0000, 0xE0200)):
        ch = chr(cp)
        if 0xD800 <= cp <= 0xDFFF or unicodedata.category(ch) in ("Cn", "Co"):
            continue
        decomposition = unicodedata.decomposition(ch)
        kind = decomposition.split(" ")[0] if decomposition.startswith("<") else ""
        if _invisible(ch):
            out[ch] = ""
        elif ch in SPACES:
            out[ch] = " "
        elif ch in HYPHENS:
            out[ch] = "-"
        elif ch in LOOKALIKES:
            out[ch] = LOOKALIKES[ch]
        elif kind in ("<wide>", "<narrow>", "<font>") or 0x2E80 <= cp <= 0x2FD5 and kind == "<compat>" or 0xFB00 <= cp <= 0xFB06 or 0x2160 <= cp <= 0x217F and kind:
            out[ch] = unicodedata.normalize("NFKC", ch)
        elif unicodedata.normalize("NFC", ch) != ch:
            out[ch] = unicodedata.normalize("NFC", ch)
    for cp in range(0x370, 0x2000):  # accented look-alike letters: the mapped base with the same marks
        parts = unicodedata.normalize("NFD", chr(cp))
        if len(parts) > 1 and parts[0] in LOOKALIKES:
            out[chr(cp)] = unicodedata.normalize("NFC", LOOKALIKES[parts[0]] + parts[1:])
    return check_mapping({k: v for k, v in out.items() if k != v})


def check_mapping(mapping: dict[str, str]) -> dict[str, str]:
    """The mapping with chains resolved; raises ValueError on a cycle or a conflict of rules."""
    done = {}
    for src, dst in mapping.items():
        seen = {src}
        while any(c in mapping for c in dst):
            dst = "".join(mapping.get(c, c) for c in dst)
            if seen & set(dst):
                raise ValueError(f"cycle at {src!r}")
            seen |= set(dst) & mapping.keys()
        done[src] = dst
    for src, dst in done.items():
        again = "".join(done.get(c, c) for c in dst)
        if again != dst:
            raise ValueError(f"{src!r} gives {dst!r}, which maps on to {again!r}")
    return done


def _ranges(chars: list[str]) -> str:
    """A regex class of characters, runs written as ranges."""
    points = sorted(set(map(ord, chars)))
    out, start, last = [], points[0], points[0]
    for p in [*points[1:], None]:
        if p is not None and p == last + 1:
            last = p
            continue
        out.append(f"\\U{start:08x}-\\U{last:08x}" if last > start else f"\\U{start:08x}")
        start = last = p
    return "".join(out)


def build_joins(mapping: dict[str, str]) -> dict[tuple[str, str], str]:
    """Which letter and mark are drawn as which one character, from rules over Unicode data.

    Raises ValueError where a joined character is itself mapped to something else, or its own parts don't join
    to it: then the same look would have two forms.
    """
    out: dict[tuple[str, str], str] = {}
    for cp in range(0xC0, 0x30000):
        parts = "" if 0xAC00 <= cp <= 0xD7A3 else unicodedata.decomposition(chr(cp))
        if parts and not parts.startswith("<") and " " in parts and unicodedata.normalize("NFC", chr(cp)) == chr(cp):
            a, b = (chr(int(x, 16)) for x in parts.split(" "))
            out[a, b] = chr(cp)
    for k in range(0xD7A4 - 0xAC00):  # Korean syllables follow from their number
        final, rest = k % 28, k // 28
        open_one = chr(0xAC00 + rest * 28)
        out[(open_one, chr(0x11A7 + final)) if final else (chr(0x1100 + rest // 21), chr(0x1161 + rest % 21))] = chr(0xAC00 + k)
    for (a, b), c in out.items():
        want = out.get((mapping.get(a, a), mapping.get(b, b)), mapping.get(a, a) + mapping.get(b, b)) if a in mapping or b in mapping else c
        if mapping.get(c, c) != want:
            raise ValueError(f"{a!r} with {b!r} gives {want!r}, {c!r} gives {mapping.get(c, c)!r}")
    return {k: c for k, c in out.items() if not mapping.keys() & {*k, c}}


def build_spellings(mapping: dict[str, str]) -> dict[str, str]:
    """Each character that stands for others: its letters and marks, after the mapping."""
    out = {}
    for cp in (*range(0xC0, 0x30000), *map(ord, mapping)):
        ch = chr(cp)
        if not 0xD800 <= cp <= 0xDFFF:
            parts = "".join(mapping.get(c, c) for c in unicodedata.normalize("NFD", mapping.get(ch, ch)))
            if (parts := unicodedata.normalize("NFD", parts)) != ch:
                out[ch] = parts
    return out


@lru_cache(maxsize=1)
def transducer() -> Callable[[str], str]:
    """The compiled one-pass rewriting of a text.

    Clusters are matched longest first: a base character with all invisible characters and marks after it,
    so that marks reach their base across a zero-width character and join the mapped base; or a run
    of mapped characters. A cluster is spelled by the mapping, its marks are put in order of their classes, and
    each joins the letter before it unless another mark of its class stands between. What a cluster becomes is
    kept, up to a bounded number of clusters.
    """
    mapping = build_mapping()
    joins, spellings = build_joins(mapping), build_spellings(mapping)
    gone = _ranges([c for c, v in mapping.items() if v == ""])
    special = _ranges(list(mapping))
    classes = {chr(c): k for c in (*range(0x300, 0x1F000), *range(0xE0000, 0xE0200)) if (k := unicodedata.combining(chr(c)))}
    marks = _ranges([*classes, *(b for _, b in joins), *(c for c, v in mapping.items() if v and unicodedata.combining(v[0]))])  # the last: half-width sound marks
    cluster = re.compile(f"[^{gone}]?(?:[{gone}]*[{marks}])+[{gone}]*|(?:[{special}](?![{gone}]*[{marks}]))+")
    known: dict[str, str] = {}

    def drawn(letter: str, waiting: list[str]) -> str:
        """A letter with the marks after it."""
        left, last = [], 0
        for m in sorted(waiting, key=classes.__getitem__):  # a stable order
            if last < classes[m] and (one := joins.get((letter, m))):
                letter = one
            else:
                left.append(m)
                last = classes[m]
        return letter + "".join(left)

    def spell(c: str) -> str:
        out, letter, waiting = [], "", []
        for part in c:
            for x in spellings.get(part, part):
                if x in classes:
                    waiting.append(x)
                    continue
                so_far = drawn(letter, waiting)
                if len(so_far) == 1 and (one := joins.get((so_far, x))):
                    letter = one
                else:
                    out.append(so_far)
                    letter = x
                waiting = []
        return "".join(out) + drawn(letter, waiting)

    def one(m: re.Match) -> str:
        c = m[0]
        out = known.get(c)
        if out is None:
            out = spell(c)
            if len(known) < 50_000:
                known[c] = out
        return out

    plain = re.compile(f"[{PLAIN}]*").fullmatch

    def rewrite(text: str) -> str:
        return text if text.isascii() or plain(text) else cluster.sub(one, text)

    return rewrite


@F.pandas_udf(T.StringType())
def one_form(text: pd.Series) -> pd.Series:
    """The one form of each text that looks the same; null stays null, an empty text empty."""
    rewrite = transducer()
    return pd.Series([rewrite(t) if isinstance(t, str) else None for t in text], dtype=object)


def rewritten(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` whose text isn't its own look, with the column ``look``; only texts that may change reach Python."""
    return rows.where(F.col(text).rlike(f"[^{PLAIN}]")).withColumn("look", one_form(text)).where(F.col(text) != F.col("look"))


def alike_pairs(df: DataFrame, group: str, key: str, text: str) -> DataFrame:
    """(key_a, key_b) of all rows of one ``group`` whose texts look the same but differ in characters.

    Of two texts of one look at least one is rewritten, so pairs start from the rewritten texts; rows that are
    their own look are found by it, as they stand. Rows are joined through the spellings of their look: a row
    meets only the other spellings of its text within its group, so equal texts are never paired and every
    candidate is a result. Rows with a null group, key or text have no pair; an empty text can pair with a text
    of invisible characters only. Keys are unique.
    """
    rows = df.select(F.col(group).alias("g"), F.col(key).alias("k"), F.col(text).alias("t")).where("g is not null and k is not null and t is not null")
    shared_dir(df.sparkSession)
    # Kept in the shared folder: texts are rewritten once.
    other = rewritten(rows, "t").checkpoint()
    looks = other.select("g", F.col("look").alias("t")).distinct()
    same = rows.join(looks, ["g", "t"], "left_semi").select("g", "k", "t", F.col("t").alias("look"))
    among = other.select("g", "k", "t", "look").unionByName(same).checkpoint()
    spellings = among.select("g", "look", F.col("t").alias("other")).distinct()
    toward = among.join(spellings, ["g", "look"]).where(F.col("t") < F.col("other")).select("g", "look", "k", "other")
    right = among.select("g", "look", F.col("t").alias("other"), F.col("k").alias("k2"))
    return toward.join(right, ["g", "look", "other"]).select(F.least("k", "k2").alias("key_a"), F.greatest("k", "k2").alias("key_b"))


#: Most entries of a list of products whose looks are broadcast; a longer one is joined by shuffling looks.
BROADCAST_ENTRIES = 100_000


def alike_found(lines: DataFrame, flat: DataFrame, ref: DataFrame) -> DataFrame:
    """(kind, key_a, key_b): pairs of lines of a filing, and names against the list of products.

    A name equal to a canon_name character for character is no case. The list is broadcast up to
    BROADCAST_ENTRIES entries.
    """
    pairs = alike_pairs(lines, "infocode", "line_id", "text").select(F.lit("line").alias("kind"), "key_a", "key_b")
    listed = ref.where("canon_name is not null").select("ref_id", "canon_name", one_form("canon_name").alias("look"))
    listed = F.broadcast(listed) if ref.limit(BROADCAST_ENTRIES + 1).count() <= BROADCAST_ENTRIES else listed
    rows = flat.where("productname is not null").select("row_id", "productname")
    # a name that is its own look meets the entries that aren't theirs
    named = rewritten(rows, "productname").join(listed, "look").unionByName(rows.withColumn("look", F.col("productname")).join(listed, "look"))
    named = named.where(F.col("productname") != F.col("canon_name"))
    return pairs.unionByName(named.select(F.lit("name").alias("kind"), F.col("ref_id").alias("key_a"), F.col("row_id").alias("key_b")))
