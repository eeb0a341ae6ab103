"""Grids assembled by expressions against a plain loop over words."""

import random
import re

from factloom.operators.layout import Geometry, assemble_grids

G = Geometry()


def _number(t):
    return re.fullmatch(r"[+-]?(\d{1,3}(,\d{3})*|\d+)(\.\d+)?", re.sub(r"[ ()]", "", t.strip())) is not None


def _pieces(text):
    def numbers(t):
        out = []
        for p in re.split(r"\s+", t.strip()):
            found = re.findall(r"\(?-?[\d,]+(?:\.\d+)?[%％]?\)?", p)
            out += found if len(found) > 1 else [p]
        return out

    if m := re.match(r"^([一-鿿][一-鿿\s\-–—]+?)([\d,.\-\(\)%\s]+)$", text):
        return [m[1].strip(), *numbers(m[2])]
    return numbers(text) if len(numbers(text)) > 1 else [text]


def _grid(rows):
    words = [w for r in rows for w in r]
    anchors = []
    for v in sorted(w["x1"] for w in words if _number(w["text"])):
        if anchors and v - anchors[-1] <= G.anchor:
            anchors[-1] = (anchors[-1] + v) / 2
        else:
            anchors.append(v)
    if len(anchors) < 2:
        left = sorted({w["x0"] for w in words if not _number(w["text"]) and re.search("[一-鿿]", w["text"]) and w["x0"] > G.text_left})
        anchors = sorted({*anchors, *(b for a, b in zip(left, left[1:]) if b - a > G.text_step)})
    out = []
    for r in rows:
        if not anchors:
            cells, end = [], None
            for w in r:
                if end is None or w["x0"] - end > G.cell_gap:
                    cells.append(w["text"])
                else:
                    cells[-1] += w["text"]
                end = w["x1"]
            out.append(cells)
            continue
        cells = [[] for _ in range(len(anchors) + 1)]
        for w in r:
            near = [i for i, a in enumerate(anchors) if abs(w["x1"] - a) <= G.anchor]
            middle = (w["x0"] + w["x1"]) / 2
            if near:
                c = near[0] + 1
            elif _number(w["text"]):
                c = min(range(len(anchors)), key=lambda i: (abs(w["x1"] - anchors[i]), i)) + 1
            elif middle < anchors[0] - G.anchor:
                c = 0
            else:
                c = next((i + 1 for i in range(len(anchors) - 1) if middle <= (anchors[i] + anchors[i + 1]) / 2), len(anchors))
            cells[c].append(w["text"])
        out.append([p for x in cells for p in _pieces(" ".join(x))])
    return out


def test_against_a_plain_loop(spark):
    rng = random.Random(11)
    texts = ["酒店", "物流服務", "1,000", "(20)", "5", "9.5", "Hotel", "105.5 9.2%", "12%34%", "千元"]
    blocks, rows = {}, []
    for b in range(80):
        pool = texts if b % 4 else ["酒店", "物流服務", "Hotel", "千元"]
        blocks[b] = []
        for i in range(rng.randint(1, 6)):
            x, row = float(rng.choice([50, 90, 140])), []
            for k in range(rng.randint(1, 6)):
                t = rng.choice(pool)
                width = float(rng.choice([20, 40, 61]))
                row.append({"x0": x, "word_no": k, "x1": x + width, "top": 0.0, "bottom": 1.0, "text": t})
                x += width + rng.choice([4, 9, 50])
            blocks[b].append(row)
            rows.append(("d", 1, b, i, [tuple(w.values()) for w in row]))
    df = spark.createDataFrame(rows, "infocode string, page_number int, block_no int, row_no int, words array<struct<x0: double, word_no: int, x1: double, top: double, bottom: double, text: string>>")
    got = {r.block_no: r.grid for r in assemble_grids(df).collect()}
    assert got == {b: _grid(r) for b, r in blocks.items()}
    assert assemble_grids(df.limit(0)).count() == 0
