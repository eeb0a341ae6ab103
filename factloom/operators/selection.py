"""Which section of a document holds the table of revenue by product: filters, hits of prior names, a ranked ladder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold_width
from ..sources.tables import shared_dir
from .linkage import containing

# Words in titles that rule a section out, words of which a title needs one, and words of its text.
NEVER = (
    "分類資產及負債", "財務數字", "财务数字", "合同負債", "合同负债", "合約負債", "合约负债", "員工人數", "员工人数", "僱員人數", "雇员人数", "銷量", "销量", "產量", "产量", "賬齡", "账龄",
    "現金流量", "现金流量", "財務摘要", "财务摘要", "主要客户的資料", "概不", "比較數字", "網絡", "公佈", "政府", "股息", "紅線", "性別", "地區劃分", "股權", "僱傭", "年齡", "每股收益", "變現",
    "季度比較", "股本", "註釋", "壞賬", "業務回顧", "分部資產及負債", "基準", "虧損",
)
BALANCE = ("資產負債表", "资产负债表", "資產及負債")
REVIEW, REVIEWED = ("財務回顧", "财务回顾"), ("收入", "收益", "分部", "產品", "服務", "銷售")
NEEDED = (
    "收入", "收益", "分部", "資料", "經營", "業務", "產品", "服務", "銷售", "分類", "客户合約", "明細", "分拆", "類別", "營業額", "合同", "客户合同", "營收", "業績", "利潤", "利润", "營運", "营运",
    "虧損", "亏损", "虧損表", "损益表", "損益表", "利潤表", "利润表", "營運報表", "营运报表", "附註", "附注", "劃分", "划分",
)
REGIONS = (r"按.{1,20}?(?:地區|地区|地域|區域|区域|所在地|地理|位置)\s*.{0,10}?\s*(?:劃分|划分|分類|分类|分部)", r"按.*(地區|地区)", r"(?:地區|地区)\s*分部", r"按.*(地區|地区|地域|區域|区域|所在地).*劃分", r"^地區資料$")
PROFIT_TITLES = ("損益", "损益", "虧損", "亏损", "全面虧損表", "全面亏损表", "全面損益表", "全面损益表", "profit or loss", "profit and loss")
REVENUE_WORDS = ("收入", "收益", "營業額", "营业额", "銷售額", "销售额", "revenue", "turnover", "sales")
COST_WORDS = ("銷售成本", "销售成本", "營業成本", "营业成本", "收入成本", "服務成本", "服务成本", "cost of sales", "cost of revenue", "cost of services")
GROSS_WORDS = ("毛利", "毛利潤", "毛利润", "gross profit", "gross loss", "gross margin")
TIERS = (
    r"分部.*業績|收益及業績|業務分部|分拆.*(收入|收益)|收入明細|收益明細|收入分類|收益分類|收入構成|收益構成|分部業績|財務回顧|分部.*經營|reportableandoperatingsegment|客户合約收益|客戶合約收益|客户合約收入|客戶的合約.*收益",
    r"經營分部|经营分部|收入及分部|分部資料|分部報告|分部信息|分部报告|收益及業績|分部收入|營業額及業績|分拆收入|分類.*資料|業務單位|业务单位|分部.*如下",
    r"外部客戶收入|外部客户收入|收入、其他收益|^收入:$",
    r"按.*收入.*業績|按服務|按服务|按類別|按类别|產品收入|产品收入|服務收入|服务收入|收益、其他收入及收益|收入資料|收益資料|收入構成|收入构成|收入分拆|收入明细|收益及分部|類別分析|类别分析|收益分类|收益及|收入分类|銷售貨品|销售货品|按產品|按产品|按主要產品|按主要产品|按.*劃分|按.*划分|收入、其他收入|收益分析|收入分析|^\d+\.收入$|^[\(|\（]*[、|\)|）|.|．|。]*[一二三四五六七八九十0123456789①②③④⑤⑥⑦⑧⑨A-Da-d]+[、|\)|）|.|．|。]*(收益|收入)$",
    r"收益淨額",
    r"收入、資本支出及實現價格|客户合約收入",
    r"按業務類型分類",
    r"損益表|损益表|收益表|虧損表|亏损表|損益賬|損益.*表",
)


_BLANK = r"^\s+|\s+$"


def _words(words: tuple[str, ...]) -> str:
    return "|".join(words)


def section_marks(lines: DataFrame) -> DataFrame:
    """One row for each section: its title, and which words its lines have; no section's text is gathered.

    ``lines`` carry infocode, section_id, line_no, text and perhaps title, else a section's first text is its title.
    The words looked for don't run over the end of a line.
    """
    title = F.first("title") if "title" in lines.columns else F.min_by(F.coalesce("text", F.lit("")), "line_no")
    has = lambda words, name: F.max(F.coalesce(F.col("text").rlike(_words(words)), F.lit(False))).alias(name)
    return lines.groupBy("infocode", "section_id").agg(
        title.alias("title"), has(("分部",), "has_segment"), has(REVIEWED, "has_reviewed"), has(("千港元", "万港元"), "names_unit"),
        has(REVENUE_WORDS, "has_revenue"), has(COST_WORDS, "has_cost"), has(GROSS_WORDS, "has_gross"), has(("毛利", "(?i)gross profit"), "tells_gross"), has(("成本", "(?i)cost"), "tells_cost"),
    )


def related_sections(marks: DataFrame) -> DataFrame:
    """The sections of ``section_marks`` whose title and lines admit a table of revenue."""
    title = F.coalesce("title", F.lit(""))
    admitted = (
        ~title.rlike(_words(NEVER))
        & ~(title.rlike(_words(BALANCE)) & ~title.contains("分部") & ~F.col("has_segment"))
        & ~(title.rlike(_words(REVIEW)) & ~F.col("has_reviewed"))
        & title.rlike(_words(NEEDED))
        & ~title.rlike(_words(REGIONS))
    )
    return marks.where(admitted)


def usable_name(name: Column) -> Column:
    """A3: a prior name, narrow, of a compound name the first part; null for totals and companies."""
    narrow = F.array(fold_width(name))  # a lambda over one element binds a value once
    first = F.transform(narrow, lambda x: F.when(x.rlike("[╱/]"), F.regexp_replace(F.element_at(F.split(x, "[╱/]"), 1), _BLANK, "")).otherwise(x))
    return F.when(~name.rlike("合計|合计|總計|总计|總額|总额|total|公司"), F.get(first, F.lit(0)))


def name_part(name: Column) -> Column:
    """The part of a prior name that is looked for: its last part after a dash, before a colon."""
    return F.element_at(F.split(F.element_at(F.split(name, "-"), -1), ":"), 1)


_WITHIN = ["infocode"]


def name_hits(words: DataFrame, names: DataFrame) -> DataFrame:
    """(infocode, section_id, hits): how many prior names of its document a section has.

    Counted are the names whose part is in a word, those whose part is a word, and those all of whose letters are in
    the section; the greatest count holds. ``words``: infocode, section_id, text; ``names``: infocode, name, distinct.
    Names meet words through grams and letters of their document, so no names are gathered.
    """
    shared_dir(words.sparkSession)
    # Words and names are used several times: kept in the shared folder, what they come from is worked out once.
    w = words.select("infocode", "section_id", "text").distinct().checkpoint()
    names = names.checkpoint()
    loose = F.replace(F.regexp_replace("text", r"[ \n]", ""), F.lit("之"), F.lit(""))
    bare = w.select("infocode", "section_id", loose.alias("outer"))
    trimmed = F.regexp_replace("name", _BLANK, "")
    n = names.select("infocode", "name", F.replace(trimmed, F.lit("之"), F.lit("")).alias("whole"), F.element_at(F.split(name_part(trimmed), "[╱/]"), 1).alias("exact"))
    n = n.withColumn("inner", name_part(F.col("whole")))
    pairs = containing(n.select("infocode", F.col("inner").alias("text")), bare.select("infocode", F.col("outer").alias("text")), _WITHIN)
    parts = n.join(pairs, ["infocode", "inner"]).join(bare, ["infocode", "outer"]).select("infocode", "section_id", "name")
    equal = n.where(F.length("exact") > 0).join(w.withColumnRenamed("text", "exact"), ["infocode", "exact"]).select("infocode", "section_id", "name")

    # letters: a section is tried for a name only if it has the two of the name's letters that fewest sections have
    letters = w.select("infocode", "section_id", F.explode(F.split("text", "")).alias("letter")).distinct()
    spelled = n.select("infocode", "name", F.array_distinct(F.split(F.regexp_replace(fold_width(trimmed), " ", ""), "")).alias("all"), F.lit(False).alias("long"))
    dashed = n.where((F.length("whole") > 10) & F.col("whole").contains("-")).select("infocode", "name", F.array_distinct(F.split("whole", "")).alias("all"), F.lit(True).alias("long"))
    spelled = spelled.where(F.get("all", F.lit(0)) != "").unionByName(dashed)
    common = letters.groupBy("infocode", "letter").agg(F.count("*").alias("n"))
    met = spelled.select("infocode", "name", "all", "long", F.explode("all").alias("letter")).join(common, ["infocode", "letter"])
    rare = met.groupBy("infocode", "name", "long").agg(F.first("all").alias("all"), F.array_sort(F.collect_list(F.struct("n", "letter"))).alias("by"))
    # a letter that no section has rules a name out
    rare = rare.where(F.size("by") == F.size("all")).select("infocode", "name", "long", "all", F.get("by", F.lit(0))["letter"].alias("letter"), F.coalesce(F.get("by", F.lit(1)), F.get("by", F.lit(0)))["letter"].alias("second"))
    tried = rare.join(letters, ["infocode", "letter"]).join(letters.withColumnRenamed("letter", "second"), ["infocode", "section_id", "second"])
    held = letters.groupBy("infocode", "section_id").agg(F.collect_set("letter").alias("held"))
    tried = tried.join(held, ["infocode", "section_id"])
    whole = tried.where(F.size(F.array_except("all", "held")) == 0)
    found = [(parts, 0), (equal, 1), (whole.where("not long").select("infocode", "section_id", "name"), 2), (whole.where("long").select("infocode", "section_id", "name"), 0)]
    every = None
    for df, kind in found:
        df = df.withColumn("kind", F.lit(kind))
        every = df if every is None else every.unionByName(df)
    counts = every.distinct().groupBy("infocode", "section_id", "kind").agg(F.count("*").cast("int").alias("n"))
    return counts.groupBy("infocode", "section_id").agg(F.max("n").alias("hits"), F.coalesce(F.max(F.when(F.col("kind") == 1, F.col("n"))), F.lit(0)).alias("exact_hits"))


def best_sections(sections: DataFrame) -> DataFrame:
    """The one section chosen for each document, with the rule that chose it.

    ``sections``: infocode, section_id, title, has_revenue, has_cost, has_gross, n_names, hits, exact_hits of the
    related sections. Rules in order: the only section that hits all names; of several such, one of profit and loss
    with revenue, cost and gross profit; for a single prior name and several candidates, a related section of profit
    and loss; among several candidates, the sections with most hits, the first by the tiers of titles; the first of
    them. ``all_names``: the section hits all names, in one count or as words. Aggregates by document only; a large
    document's sections are folded before they meet.
    """
    full = (F.col("n_names") > 0) & (F.col("hits") >= F.col("n_names"))
    s = sections.withColumn("_full", full)
    levels = s.groupBy("infocode", "hits").agg(F.count("*").alias("k"), F.max("_full").alias("f"))
    top = levels.groupBy("infocode").agg(F.max("hits").alias("_most"), F.max_by("k", "hits").alias("_n_most"), F.sum(F.when(F.col("f"), F.col("k")).otherwise(0)).alias("_n_full"))
    s = s.join(top, "infocode")
    s = s.withColumn("_candidate", F.when(F.col("_n_full") > 0, F.col("_full")).otherwise(F.col("hits") == F.col("_most"))).withColumn("_n", F.when(F.col("_n_full") > 0, F.col("_n_full")).otherwise(F.col("_n_most")))
    pl = F.coalesce(F.col("title").rlike(_words(PROFIT_TITLES)), F.lit(False))
    whole = pl & F.col("has_revenue") & F.col("has_cost") & F.col("has_gross")
    tier = F.lit(len(TIERS))
    for k in reversed(range(len(TIERS))):
        tier = F.when(F.col("title").rlike(TIERS[k]), k).otherwise(tier)
    rule = (
        F.when((F.col("_n_full") == 1) & F.col("_full"), 1)
        .when((F.col("_n_full") > 1) & F.col("_full") & whole, 2)
        .when((F.col("n_names") == 1) & (F.col("_n") > 1) & pl, 3)
        .when(F.col("_candidate") & (F.col("_n") > 1) & (F.col("_tier") < len(TIERS)), 4)
        .when(F.col("_candidate"), 5)
    )
    s = s.withColumn("_tier", tier).withColumn("rule", rule).where("rule is not null")
    order = F.struct("rule", F.when(F.col("rule") == 4, F.col("_tier")).otherwise(0), "section_id")
    all_names = F.col("_full") | ((F.col("n_names") > 0) & (F.col("exact_hits") >= F.col("n_names")))
    return s.groupBy("infocode").agg(F.min_by(F.struct("section_id", "title", "hits", "rule", all_names.alias("all_names")), order).alias("c")).select("infocode", "c.*")
