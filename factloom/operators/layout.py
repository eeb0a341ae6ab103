"""Page layout: words to rows, rows to blocks, blocks to grids.

Words come as (infocode, page_number, text, x0, x1, top, bottom). Everything happens within a page of a
document, whose size is bounded by paper, so windows over pages spread over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold_width, has_han, is_number, number_pieces, squeeze

PAGE = ("infocode", "page_number")


@dataclass(frozen=True)
class Geometry:
    """Tolerances in points, lengths in characters."""

    row: float = 4
    anchor: float = 8
    gap: float = 45
    edge: float = 1
    narrative: int = 40
    sentence: int = 12
    pending: int = 6
    text_left: float = 80
    text_step: float = 40
    cell_gap: float = 8


def words_of_lines(lines: DataFrame) -> DataFrame:
    """Words of lines, each with its share of the line's width by its characters.

    Stands in for a PDF's word boxes where only lines were kept. Null and blank lines have no words. Lines are
    shuffled by page here, once for all that follows; a section_id is passed on.
    """
    t = F.col("text")
    lines = lines.repartition(*PAGE)
    more = ["section_id"] if "section_id" in lines.columns else []
    step = (F.col("x1") - F.col("x0")) / F.length(t)
    parts = F.posexplode(F.split(t, r"\s+"))
    words = lines.where(t.isNotNull() & (F.length(t) > 0)).select(*PAGE, *more, "line_id", "line_no", "text", "x0", "top", "bottom", step.alias("_step"), parts.alias("word_no", "word"))
    # the start of a word: the characters of the line's words before it, white space between them counted as one
    before = Window.partitionBy(*PAGE, "line_id").orderBy("word_no").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("word") + 1).over(before), F.lit(0))
    placed = words.withColumn("_start", start).where(F.length("word") > 0)
    x0 = F.round(F.col("x0") + F.col("_start") * F.col("_step"), 2)
    x1 = F.round(F.col("x0") + (F.col("_start") + F.length("word")) * F.col("_step"), 2)
    return placed.select(*PAGE, *more, "line_id", "word_no", F.col("word").alias("text"), x0.alias("x0"), x1.alias("x1"), "top", "bottom")


def section_boxes(sectioned: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """The bounding box of each section on each page, held to the page's size where ``pages`` gives one."""
    box = sectioned.groupBy(*PAGE, "section_id").agg(F.min("x0").alias("bx0"), F.min("top").alias("btop"), F.max("x1").alias("bx1"), F.max("bottom").alias("bbottom"))
    if pages is None:
        return box
    held = box.join(pages.select(*PAGE, "width", "height"), list(PAGE))
    return held.select(
        *PAGE, "section_id", F.greatest(F.lit(0.0), "bx0").alias("bx0"), F.greatest(F.lit(0.0), "btop").alias("btop"), F.least("width", "bx1").alias("bx1"), F.least("height", "bbottom").alias("bbottom"),
    ).where((F.col("bx1") > F.col("bx0")) & (F.col("bbottom") > F.col("btop")))


def words_in_boxes(words: DataFrame, boxes: DataFrame, slack: float = 1e-6) -> DataFrame:
    """Words that lie wholly inside a box, with the box's section. Equi-join on the page, ranges inside it."""
    inside = (F.col("x0") >= F.col("bx0") - slack) & (F.col("x1") <= F.col("bx1") + slack) & (F.col("top") >= F.col("btop") - slack) & (F.col("bottom") <= F.col("bbottom") + slack)
    return words.join(boxes, list(PAGE)).where(inside).select(*words.columns, "section_id")


def word_rows(words: DataFrame, g: Geometry = Geometry(), within: tuple[str, ...] = PAGE) -> DataFrame:
    """Words with ``row_no``: a row ends where the next word lies more than ``row`` below the one before."""
    order = Window.partitionBy(*within).orderBy("top", "x0", "line_id", "word_no")
    new = F.coalesce((F.abs(F.col("top") - F.lag("top").over(order)) > g.row).cast("int"), F.lit(0))
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    return words.withColumn("_new", new).withColumn("row_no", F.sum("_new").over(run)).drop("_new")


def row_table(rowed: DataFrame, g: Geometry = Geometry(), within: tuple[str, ...] = PAGE) -> DataFrame:
    """One row for each row of words: words from left to right, and the marks that blocks are made by.

    ``gap`` is the room to the row above (W6), ``numeric`` a number among the words, ``narrative`` running
    text (F13), ``folio`` a lone page number (F14).
    """
    word = F.struct("x0", "word_no", "x1", "top", "bottom", fold_width(F.col("text")).alias("text"))
    rows = rowed.groupBy(*within, "row_no").agg(F.array_sort(F.collect_list(word)).alias("words"))
    joined = F.array_join(F.transform("words", lambda w: w["text"]), "")
    order = Window.partitionBy(*within).orderBy("row_no")
    rows = rows.withColumn("_text", joined)
    rows = rows.where(~F.col("_text").rlike(r"^[–\-—\s]*\d+[–\-—\s]*$"))
    gap = F.greatest(F.lit(0.0), F.expr("words[0].top") - F.lag(F.expr("element_at(words, -1).bottom")).over(order))
    return rows.select(
        *within, "row_no", "words",
        F.coalesce(gap, F.lit(0.0)).alias("gap"),
        F.exists("words", lambda w: is_number(w["text"])).alias("numeric"),
        ((F.length("_text") > g.narrative) | ((F.length("_text") > g.sentence) & F.col("_text").rlike("[。；：，]"))).alias("narrative"),
    )


def row_blocks(rows: DataFrame, g: Geometry = Geometry(), within: tuple[str, ...] = PAGE) -> DataFrame:
    """Rows with ``block_no``, rows of no block left out.

    A row with numbers opens a block or goes on with one. A row without goes on with the block of the row
    above if it is near and no running text. An opening row takes along up to ``pending`` rows above it that
    are no running text, near each other, and in no block.
    """
    order = Window.partitionBy(*within).orderBy("row_no")
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    r = rows.withColumn("_i", F.row_number().over(order))
    breaks = ~F.col("numeric") & ((F.col("gap") > g.gap) | F.col("narrative"))
    r = r.withColumn("_number", F.max(F.when(F.col("numeric"), F.col("_i"))).over(upto)).withColumn("_break", F.max(F.when(breaks, F.col("_i"))).over(upto))
    r = r.withColumn("_in", F.coalesce(F.col("_number") > F.coalesce("_break", F.lit(0)), F.lit(False)))
    opens = F.col("numeric") & ~F.coalesce(F.lag("_in").over(order), F.lit(False))
    r = r.withColumn("_opens", opens).withColumn("_block", F.sum(F.col("_opens").cast("int")).over(upto))
    r = r.withColumn("_next", F.min(F.when(F.col("_opens"), F.col("_i"))).over(after))
    # looking down from a row outside blocks: the last row before the next opening that stops the taking along
    far_below = F.coalesce(F.lead("gap").over(order) > g.gap, F.lit(False)) & (F.col("_i") + 1 < F.col("_next"))
    stops = ~F.col("_in") & (F.col("narrative") | far_below)
    r = r.withColumn("_stop", F.when(stops, F.col("_i"))).withColumn("_stop_below", F.min("_stop").over(after))
    taken = ~F.col("_in") & F.col("_next").isNotNull() & (F.col("_next") - F.col("_i") <= g.pending) & (F.coalesce("_stop_below", F.lit(1 << 30)) > F.col("_next"))
    r = r.withColumn("block_no", F.when(F.col("_in"), F.col("_block")).when(taken, F.col("_block") + 1))
    return r.where(F.col("block_no").isNotNull()).select(*rows.columns, "block_no")


def cluster_edges(edges: Column, tolerance: float) -> Column:
    """Ascending edges, each within ``tolerance`` of the last cluster's mean moving it half way to itself."""
    return F.aggregate(
        F.array_sort(edges), F.array().cast("array<double>"),
        lambda acc, v: F.when((F.size(acc) > 0) & (v - F.element_at(acc, -1) <= tolerance), F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array((F.element_at(acc, -1) + v) / 2))).otherwise(F.concat(acc, F.array(v))),
    )


def text_edges(edges: Column, g: Geometry = Geometry()) -> Column:
    """Left edges of text right of ``text_left`` that lie more than ``text_step`` right of the one before."""
    far = F.array_sort(F.array_distinct(F.filter(edges, lambda v: v > g.text_left)))
    steps = F.transform(far, lambda v, i: F.when((i > 0) & (v - F.get(far, i - 1) > g.text_step), v))
    return F.array_compact(steps)


def word_column(word: Column, anchors: Column, g: Geometry = Geometry()) -> Column:
    """A word's column: 0 for labels, else the anchor it ends at, is nearest to, or lies before."""
    reach = F.filter(F.transform(anchors, lambda a, i: F.struct((F.abs(word["x1"] - a) <= g.anchor).alias("hit"), i.alias("i"))), lambda h: h["hit"])
    nearest = F.array_min(F.transform(anchors, lambda a, i: F.struct(F.abs(word["x1"] - a).alias("d"), i.alias("i"))))["i"]
    middle = (word["x0"] + word["x1"]) / 2
    bins = F.filter(F.transform(anchors, lambda a, i: F.struct((middle <= (a + F.get(anchors, i + 1)) / 2).alias("hit"), i.alias("i"))), lambda h: F.coalesce(h["hit"], F.lit(False)))
    return (
        F.when(F.size(reach) > 0, reach[0]["i"] + 1)
        .when(is_number(word["text"]), nearest + 1)
        .when(middle < anchors[0] - g.anchor, 0)
        .when(F.size(bins) > 0, bins[0]["i"] + 1)
        .otherwise(F.size(anchors))
    )


def gap_cells(words: Column, g: Geometry = Geometry()) -> Column:
    """A row's words joined to cells; a cell ends where more than ``cell_gap`` is free."""
    return F.aggregate(
        words, F.struct(F.array().cast("array<string>").alias("cells"), F.lit(None).cast("double").alias("end")),
        lambda acc, w: F.struct(
            F.when(acc["end"].isNull() | (w["x0"] - acc["end"] > g.cell_gap), F.concat(acc["cells"], F.array(w["text"])))
            .otherwise(F.concat(F.slice(acc["cells"], F.lit(1), F.size(acc["cells"]) - 1), F.array(F.concat(F.element_at(acc["cells"], -1), w["text"])))).alias("cells"),
            w["x1"].alias("end")),
        lambda acc: acc["cells"],
    )


def assemble_grids(blocks: DataFrame, g: Geometry = Geometry(), within: tuple[str, ...] = PAGE) -> DataFrame:
    """One row for each block with its grid (rows of cells; rows may differ in width)."""
    table = F.array_sort(F.collect_list(F.struct("row_no", "words")))
    b = blocks.groupBy(*within, "block_no").agg(table.alias("rows"))
    words = F.flatten(F.transform("rows", lambda r: r["words"]))
    b = b.withColumn("_numbers", F.transform(F.filter(words, lambda w: is_number(w["text"])), lambda w: w["x1"]))
    b = b.withColumn("_texts", F.transform(F.filter(words, lambda w: ~is_number(w["text"]) & has_han(w["text"]) & (w["x0"] > 0)), lambda w: w["x0"]))
    b = b.withColumn("_ends", cluster_edges(F.col("_numbers"), g.anchor))
    b = b.withColumn("anchors", F.when(F.size("_ends") < 2, F.array_sort(F.array_union("_ends", text_edges(F.col("_texts"), g)))).otherwise(F.col("_ends")))

    def cells(r: Column) -> Column:
        placed = F.transform(r["words"], lambda w: F.struct(word_column(w, F.col("anchors"), g).alias("c"), w["text"].alias("text")))
        return F.transform(F.sequence(F.lit(0), F.size("anchors")), lambda c: squeeze(F.array_join(F.transform(F.filter(placed, lambda p: p["c"] == c), lambda p: p["text"]), " ")))

    split = lambda r: F.flatten(F.transform(cells(r), lambda x: F.transform(number_pieces(x), squeeze)))
    grid = F.transform("rows", lambda r: F.when(F.size("anchors") == 0, gap_cells(r["words"], g)).otherwise(split(r)))
    width = F.array_max(F.transform("grid", lambda r: F.size(r)))
    numbers = F.size("_numbers")
    return b.withColumn("grid", grid).select(*within, "block_no", "anchors", "grid", F.size("grid").alias("n_rows"), width.alias("n_cols"), numbers.alias("n_numbers"))


def table_like(words: DataFrame, sections: DataFrame) -> DataFrame:
    """sections with more than three numbers of three characters or more, or amounts in thousands of dollars.

    ``words`` carry section_id; single-digit enumerators in brackets are taken out before.
    """
    t = F.regexp_replace("text", r"[\(（]\d[\)）]", "")
    count = words.groupBy("infocode", "section_id").agg(F.count_if((F.length(t) >= 3) & is_number(t) & ~has_han(t)).alias("n_numbers"))
    joined = sections.join(count, ["infocode", "section_id"], "left")
    return joined.withColumn("n_numbers", F.coalesce("n_numbers", F.lit(0))).withColumn("is_table", (F.col("n_numbers") > 3) | F.coalesce("names_unit", F.lit(False)))
