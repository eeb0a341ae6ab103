import unicodedata

from factloom.functions.text import fold_width, strong_name
from pyspark.sql import functions as F


def test_wide_characters_of_every_plane(spark):
    """Each wide character is folded to its compatibility form, beyond the first plane too; others stay."""
    chars = [chr(cp) for cp in (*range(0x1100, 0xD800), *range(0xF900, 0x10000), *range(0x1F000, 0x1F300), *range(0x2F800, 0x2FA20)) if unicodedata.category(chr(cp)) not in ("Cn", "Co")]
    df = spark.createDataFrame([(c,) for c in chars], "c string")
    got = {r.c: r.f for r in df.select("c", fold_width(F.col("c")).alias("f")).collect()}
    wide = lambda c: unicodedata.east_asian_width(c) in "FW"
    assert got == {c: "户" if c == "戶" else unicodedata.normalize("NFKC", c) if wide(c) else c for c in chars}


def test_strong_names_are_compatible(spark):
    df = spark.createDataFrame([("ｶﾞｽ ①（附註3）",), ("Café ﬁne",), ("戶外業務",), (None,)], "c string")
    assert [r.s for r in df.select(strong_name(F.col("c")).alias("s")).collect()] == ["ガス1", "café" + "fine", "戶外业务", None]
