"""Free-entered names mapped to the entries of a reference list, by a prefix-filtered set-similarity join.

Each name is cleaned of what decorates it (bullets, note marks, "Revenue from", "其中：") and cut into its
Chinese and its Latin part. Parts and listed names are sets of tokens: the characters of Chinese, letter pairs
of Latin words. Tokens are ordered by their rarity in the list, only the rare prefixes are joined, pairs pass
length and positional filters, and Jaccard is verified exactly. The best is kept.

Names of products that the list doesn't have often share a word with one that it has. So the list is joined
together with its own recombinations: every first part of a listed name with every last part. A name nearest
to a recombination means a product that isn't listed.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import shared_dir, shuffle_partitions
from .lookalike import transducer

# Traditional characters and their simplified forms, as used in names of products.
TRADITIONAL = "乾傢俬儲兒凍動務區學實寶庫廳後應戲戶擔據數書會東條業機檢樓樂權氣測準滅漁無熱燈爐產療礦種積築級紀紙終組統經綜維網緊線編練總織纜職聲興葉藝藥蘭處號蟲衛裝製複規計訂訊訓託記許註評詞詢試語認說調請論諮證譯議護貨販費資賃賓賣質購車軌軟軸載輪輸轉農運進遊過還邊郵醫釀銀銷銹鋼錄錢錶鍋鎖鐘鐵鑽門開間閥閱關陳陽險雜電雲靜鞋項頭題類風飛飲飯飾餅養餐館馬驗髮體魚鮮麗麥麵點傘幣場塊壓寵專對層島嬰歐殯節補華歷團來麪妝綠廣縮遞"
SIMPLIFIED = "干家私储儿冻动务区学实宝库厅后应戏户担据数书会东条业机检楼乐权气测准灭渔无热灯炉产疗矿种积筑级纪纸终组统经综维网紧线编练总织缆职声兴叶艺药兰处号虫卫装制复规计订讯训托记许注评词询试语认说调请论咨证译议护货贩费资赁宾卖质购车轨软轴载轮输转农运进游过还边邮医酿银销锈钢录钱表锅锁钟铁钻门开间阀阅关陈阳险杂电云静鞋项头题类风飞饮饭饰饼养餐馆马验发体鱼鲜丽麦面点伞币场块压宠专对层岛婴欧殡节补华历团来面妆绿广缩递"
# What decorates a name without changing what it means.
LATIN_DECORATIONS = (
    "sales of", "sale of", "provision of", "revenue from", "income from", "of which", "external customers", "external customer",
    "continuing", "business", "segment", "division", "div", "prc", "note", "notes", "and others", "others",
)
HAN_DECORATIONS = ("外部客户", "及其他", "其中", "来自", "销售", "提供", "收入", "分部", "分类", "业务", "附注", "之", "的")

#: Least Jaccard similarity of a part and a listed name.
THRESHOLD = 0.4
#: Most forms of the list (with its recombinations) whose index is broadcast; a larger one is joined by shuffling tokens.
BROADCAST_FORMS = 100_000
#: Most entries of a list that is collected, and most recombinations it may have; beyond that ``map_names`` refuses.
LIST_ENTRIES, RECOMBINATIONS = 500_000, 1_000_000
#: Words of 64 bits in the signature of a token set.
SIGNATURE = 4
#: Least agreement by edit distance of the best candidate, for Chinese and for Latin parts.
AGREEMENT = (0.55, 0.7)

_FOLD = str.maketrans(TRADITIONAL, SIMPLIFIED)
_HAN = "㐀-鿿\U00020000-\U0003134f"


def fold(text: str) -> str:
    """Look-alikes, widths, case, accents and script variants brought to one; white space single."""
    s = unicodedata.normalize("NFKC", transducer()(text)).casefold().translate(_FOLD)
    s = "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c))
    return re.sub(r"[\s_]+", " ", s.replace("’", "'")).strip()


def distance(a: str, b: str, most: int = 99) -> int:
    """Edits between two texts: insert, delete, replace, or swap neighbours."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i] + [0] * len(b)
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, now[j - 1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            now[j] = d
        before, row = row, now
    return row[-1]


_SINGLE_WORDS = {w for d in LATIN_DECORATIONS for w in d.split(" ") if len(w) >= 5}


@lru_cache(maxsize=50_000)
def _decorates(word: str, vocabulary: frozenset[str]) -> bool:
    """A Latin word that is a decoration, perhaps cut short with a point or with a slip of the pen.

    A word that is as near to a word of the list is none.
    """
    bare = word.rstrip(".")
    if bare in _SINGLE_WORDS or word.endswith(".") and len(bare) >= 4 and any(w.startswith(bare) and w != bare for w in _SINGLE_WORDS - {"customers", "customer"}):
        return True
    if len(bare) < 6:
        return False
    off = min(distance(bare, w, 2) for w in _SINGLE_WORDS)
    return off <= (1 if len(bare) < 7 else 2) and all(distance(bare, v, off) > off for v in vocabulary)


def clean(text: str, vocabulary: frozenset[str] = frozenset()) -> tuple[str, str]:
    """(Chinese part, Latin part) of a name without decorations; either may be empty.

    ``vocabulary`` has the Latin words of the list, which are never taken for decorations.
    """
    s = fold(text)
    han = re.sub(f"[^{_HAN} ]", " ", re.sub(r"[(]?\s*附\s*注\s*\d*\s*[)]?", " ", s))
    # A point that ends a cut word stays, others part words.
    latin = re.sub(f"[{_HAN}]", " ", s)
    latin = re.sub(r"\(?\bnotes?\s*\d+\)?", " ", latin)
    latin = re.sub(r"\b(sales? of|provision of|revenue from|income from|of which|and others)\b", " ", latin)
    words = re.findall(r"[a-z]+(?:'[a-z]+)*\.?", latin)
    kept: list[str] = []
    for before, w in zip(["", *words], words, strict=False):
        bare = w.rstrip(".")
        if w.endswith(".") and len(bare) >= 4 and any(d.startswith(f"{before} {bare}") for d in LATIN_DECORATIONS):
            continue  # a phrase whose last word is cut short
        if bare in vocabulary:
            kept.append(w)
        elif bare in ("i", "ii", "iii", "iv", "v", "vi", "prc", "div", "note", "notes", "others", "of", "from", "and", "which") or _decorates(w, vocabulary):
            continue
        else:
            kept.append(w)
    tight = han.replace(" ", "")
    for d in HAN_DECORATIONS:
        tight = tight.replace(d, "")
    return tight, " ".join(kept)


def tokens(part: str) -> list[str]:
    """The set of tokens of a part, sorted: characters of Chinese, letter pairs of Latin words.

    A token that comes n times is there as n tokens. The end of a Latin word is a token unless the word is
    cut short with a point.
    """
    out: Counter[str] = Counter()
    for ch in re.findall(f"[{_HAN}]", part):
        out[ch] += 1
    for w in re.findall(r"[a-z']+\.?", part):
        bare = re.sub(r"[.']", "", w)
        if bare:
            spelled = "^" + bare + ("" if w.endswith(".") else "$")
            out.update(a + b for a, b in zip(spelled, spelled[1:]))
    return sorted(t if k == 0 else f"{t}{k}" for t, n in out.items() for k in range(n))


def _splits(form: str) -> list[tuple[str, str]]:
    w = form.split(" ") if form.isascii() else list(form)
    sep = " " if form.isascii() else ""
    return [(sep.join(w[:k]), sep.join(w[k:])) for k in range(1, len(w))]


def recombinations(forms: set[str]) -> set[str]:
    """Every first part of a listed form joined to every last part, less the forms themselves.

    A form is split where its first part begins at least two forms and, among those splits, where the last
    part ends most forms. Raises ValueError where there would be more than RECOMBINATIONS: their number is that
    of first parts times last parts.
    """
    firsts = Counter(p for f in forms for p, _ in _splits(f))
    lasts = Counter(s for f in forms for _, s in _splits(f))
    best = {}
    for f in forms:
        if splits := [(p, s) for p, s in _splits(f) if firsts[p] > 1]:
            best[f] = max(splits, key=lambda ps: (lasts[ps[1]] > 1, lasts[ps[1]] * firsts[ps[0]], len(ps[0])))
    out = set()
    for latin in (True, False):
        own = [v for f, v in best.items() if f.isascii() == latin]
        heads, tails = {p for p, _ in own}, {s for _, s in own}
        if len(heads) * len(tails) > RECOMBINATIONS:
            raise ValueError(f"{len(heads)} first and {len(tails)} last parts of listed names are too many to recombine: map with recombine=False")
        out |= {p + (" " if latin else "") + s for p in heads for s in tails}
    return out - forms


def agreement(part: str, form: str) -> float:
    """1 less the share of edits between a part and a form, in the part's best word order.

    Words cut short agree with the beginnings of the form's words. Chinese names lose characters or have them
    turned round far more often than others come in, so a character that the form doesn't have counts half an
    edit more.
    """
    if form.isascii():
        words = part.split(" ")
        target = form.split(" ")
        best = 0.0
        for k in range(len(words)):
            turned = words[k:] + words[:k]
            if any(w.endswith(".") for w in turned) and len(turned) == len(target):
                goal = " ".join(t[: len(w.rstrip(".")) + (len(w) < 3)] if w.endswith(".") else t for w, t in zip(turned, target, strict=True))
                mine = " ".join(w.rstrip(".") for w in turned)
                best = max(best, 1 - distance(mine, goal) / max(len(mine), len(goal)) - 0.02)
            mine = " ".join(w.rstrip(".") for w in turned)
            best = max(best, 1 - distance(mine, form) / max(len(mine), len(form)))
        return best
    foreign = sum((Counter(part) - Counter(form)).values()) / 2
    return max(1 - (distance(part[k:] + part[:k], form) + foreign) / max(len(part), len(form)) for k in range(len(part)))


def reference_forms(ref: list[tuple[int, str | None, str | None]], recombine: bool = True) -> tuple[list[tuple[int, str]], frozenset[str]]:
    """((ref_id, form) of listed names and, with ``recombine``, of recombinations (-1), Latin words of the list).

    A form that two entries share belongs to the smaller ref_id.
    """
    listed: dict[str, int] = {}
    for ref_id, *names in sorted(ref):
        for n in names:
            if n and n.strip():
                han, latin = clean(n, frozenset(re.findall(r"[a-z']+", fold(n))))
                for part in (han, latin):
                    if part:
                        listed.setdefault(part, ref_id)
    words = frozenset(w for f in listed if f.isascii() for w in f.split(" "))
    return [*((i, f) for f, i in listed.items()), *((-1, f) for f in sorted(recombinations(set(listed)) if recombine else ()))], words


def token_ranks(forms: list[str]) -> dict[str, int]:
    """Tokens of the list numbered from 0 by rarity: the tokens of fewest forms first, ties by the token."""
    frequency = Counter(t for f in forms for t in tokens(f))
    return {t: k for k, (_, t) in enumerate(sorted((n, t) for t, n in frequency.items()))}


def ranked_tokens(part: str, ranks: dict[str, int]) -> list[int]:
    """The tokens of a part as ranks in ascending order. Tokens the list doesn't have are the rarest: -1, -2, …"""
    known = [ranks.get(t) for t in tokens(part)]
    return sorted(r if r is not None else -k for k, r in enumerate(known, 1))


def signature(ranks: list[int]) -> list[int]:
    """A token set folded onto SIGNATURE words of 64 bits, as signed integers."""
    words = [0] * SIGNATURE
    for r in ranks:
        bit = r * 0x9E3779B1 % 2**32 >> 16
        words[bit % SIGNATURE] |= 1 << (bit // SIGNATURE % 64)
    return [w - (1 << 64) if w >> 63 else w for w in words]


def _prefix(size: Column, threshold: float) -> Column:
    return (size - F.ceil(size * threshold - 1e-9) + 1).cast("int")


def similar_pairs(parts: DataFrame, forms: DataFrame, threshold: float = THRESHOLD, small: bool = True) -> DataFrame:
    """(part, form_id, jaccard) of all parts and forms at or above ``threshold``; both have ranked ``tokens`` and ``signature``.

    The join is exact: pairs are lost by no filter. ``forms`` is the reference list with its recombinations;
    when it is ``small`` its prefixes are broadcast, else both sides are shuffled by token. Tokens that the list
    doesn't have can't match: they count for a part's size and take up its prefix. A bit that only one of two
    signatures has stands for at least one token that only that side has, which bounds what they have in common
    before any tokens are compared. A pair is verified where its first common token is met, so once.
    """
    bits = lambda at: [F.get("signature", F.lit(k)).alias(f"{at}{k}") for k in range(SIGNATURE)]
    index = forms.select("form_id", F.size("tokens").alias("ny"), F.col("tokens").alias("ytokens"), *bits("y"), F.posexplode(F.slice("tokens", F.lit(1), _prefix(F.size("tokens"), threshold))).alias("j", "token"))
    sized = parts.select("part", "tokens", F.size("tokens").alias("nx"), *bits("x")).where("nx > 0")
    rare = sized.select("*", F.posexplode(F.slice("tokens", F.lit(1), _prefix(F.col("nx"), threshold))).alias("i", "token")).where("token >= 0")
    alike = (F.col("ny") >= F.col("nx") * threshold - 1e-9) & (F.col("nx") >= F.col("ny") * threshold - 1e-9)
    need = F.ceil((F.col("nx") + F.col("ny")) * (threshold / (1 + threshold)) - 1e-9)
    reach = 1 + F.least(F.col("nx") - F.col("i") - 1, F.col("ny") - F.col("j") - 1) >= need
    apart = lambda a, b: sum((F.bit_count(F.col(f"{a}{k}").bitwiseAND(F.bitwise_not(f"{b}{k}"))) for k in range(SIGNATURE)), F.lit(0))
    possible = F.least(F.col("nx") - apart("x", "y"), F.col("ny") - apart("y", "x")) >= need
    # The lambda keeps the filter out of whole-stage code, whose one method would be too large for the JVM to compile.
    near = rare.join(F.broadcast(index) if small else index, "token").where(alike & reach).where(F.exists(F.array(possible), lambda x: x))
    common = F.array_intersect("tokens", "ytokens")
    met = near.select("part", "form_id", "token", (F.col("nx") + F.col("ny")).alias("both"), common.alias("common")).where(F.get("common", F.lit(0)) == F.col("token"))
    return met.select("part", "form_id", (F.size("common") / (F.col("both") - F.size("common"))).alias("jaccard")).where(F.col("jaccard") >= threshold - 1e-9)


def best_possible(part: str, form: str, jaccard: float) -> float:
    """The most that ``agreement`` can be: a letter that one side has more often is an edit, and so is each letter of length."""
    most = max(len(part), len(form))
    if form.isascii():
        return 1.0 if "." in part else 1 - abs(len(part) - len(form)) / most
    common = jaccard * (len(part) + len(form)) / (1 + jaccard)
    return (common - (len(part) - common) / 2) / most


def best_of(part: str, candidates: Iterable[tuple[int, str, float]]) -> tuple[int, float]:
    """(ref_id or -1, score) of the best of a part's candidates (ref_id, form, jaccard), the likest first.

    Jaccard leads; the order of letters decides among what is as near by their sets. A candidate is passed over
    only if not even its best possible agreement would bring it to the best score so far.
    """
    best = (-1.0, False, 0, 0.0)
    for ref_id, form, jaccard in candidates:
        if 0.4 * jaccard + 0.6 * best_possible(part, form, jaccard) < best[0] - 1e-5:
            continue
        a = 1.0 if part == form else agreement(part, form)
        best = max(best, (round(0.4 * jaccard + 0.6 * a, 6), ref_id >= 0, -ref_id, a))
    score, _, minus, a = best
    return (-minus, score) if a >= AGREEMENT[part.isascii()] else (-1, 0.0)


_PARTS = T.ArrayType(T.StructType([T.StructField("part", T.StringType()), T.StructField("tokens", T.ArrayType(T.IntegerType())), T.StructField("signature", T.ArrayType(T.LongType()))]))


def map_names(names: DataFrame, name: str, ref: DataFrame, recombine: bool = True) -> DataFrame:
    """(name, ref_id) of each distinct ``name``: the entry of ``ref`` meant, or -1.

    ``ref`` (ref_id, canon_name, alt_name) is a curated list; it is collected, and one of more than LIST_ENTRIES
    is refused. Names are made distinct, cleaned, and made distinct again, so that the join sees each cleaned part
    once. Null and blank names are left out. Ties go to the listed entry, then to the smaller ref_id. With an
    empty list every name gives -1.
    """
    spark = names.sparkSession
    entries = [(r[0], r[1], r[2]) for r in ref.select("ref_id", "canon_name", "alt_name").limit(LIST_ENTRIES + 1).collect()]
    if len(entries) > LIST_ENTRIES:
        raise ValueError(f"the list has more than {LIST_ENTRIES} entries")
    form_list, vocabulary = reference_forms(entries, recombine)
    ranks = token_ranks([f for _, f in form_list])
    listed = [(k, i, f, r, signature(r)) for k, (i, f) in enumerate(form_list) for r in [ranked_tokens(f, ranks)]]
    forms = spark.createDataFrame(listed, "form_id int, ref_id long, form string, tokens array<int>, signature array<long>")
    sent = spark.sparkContext.broadcast((vocabulary, ranks))
    small = len(form_list) <= BROADCAST_FORMS

    @F.pandas_udf(_PARTS)
    def parts_of(text: pd.Series) -> pd.Series:
        words, order = sent.value
        return pd.Series([[{"part": p, "tokens": r, "signature": signature(r)} for p in clean(t, words) if p for r in [ranked_tokens(p, order)]] for t in text])

    def verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Streams the candidates of one part after another; only one part's are held."""
        part, held = None, []
        for b in batches:
            out = []
            for p, ref_id, form, jaccard in zip(b["part"], b["ref_id"], b["form"], b["jaccard"], strict=True):
                if p != part:
                    if held:
                        out.append((part, *best_of(part, held)))
                    part, held = p, []
                held.append((ref_id, form, jaccard))
            yield pd.DataFrame(out, columns=["part", "ref_id", "score"])
        if held:
            yield pd.DataFrame([(part, *best_of(part, held))], columns=["part", "ref_id", "score"])

    blank = F.col("name").rlike(r"^[\s\u00a0\u2000-\u200a\u202f\u205f\u3000]*$")
    distinct = names.select(F.col(name).alias("name")).where(F.col("name").isNotNull() & ~blank).distinct()
    shared_dir(spark)
    # Used twice below: kept in the shared folder, names are read and cleaned once.
    cut = distinct.select("name", F.explode_outer(parts_of("name")).alias("p")).select("name", "p.*").checkpoint()
    # Few bytes, much work: the parts are spread over all tasks, whatever their size.
    parts = cut.where("part is not null").groupBy("part").agg(F.first("tokens").alias("tokens"), F.first("signature").alias("signature")).repartition(2 * shuffle_partitions(spark))
    words = forms.select("form_id", "ref_id", "form")
    pairs = similar_pairs(parts, forms, small=small).join(F.broadcast(words) if small else words, "form_id").select("part", "ref_id", "form", "jaccard")
    sorted_pairs = pairs.repartition(2 * shuffle_partitions(spark), "part").sortWithinPartitions("part", F.desc("jaccard"))
    meant = sorted_pairs.mapInPandas(verified, "part string, ref_id long, score double")
    per_name = cut.select("name", "part").join(meant, "part", "left").groupBy("name").agg(F.max(F.struct(F.coalesce("score", F.lit(0.0)).alias("score"), (F.col("ref_id") >= 0).alias("listed"), (-F.coalesce("ref_id", F.lit(-1))).alias("minus"))).alias("m"))
    return per_name.select("name", (-F.col("m.minus")).alias("ref_id"))


def names_found(flat: DataFrame, ref: DataFrame) -> DataFrame:
    """(row_id, ref_id) of each row whose productname is neither null, blank nor exactly a canon_name."""
    exact = F.broadcast(ref.select(F.col("canon_name").alias("productname")).distinct())
    rows = flat.select("row_id", "productname").join(exact, "productname", "left_anti")
    meant = map_names(rows, "productname", ref).withColumnRenamed("name", "productname")
    return rows.join(meant, "productname").select("row_id", "ref_id")
