"""Subject areas of documents, from averaged word and subword embeddings with independent logistic outputs.

A sentence is the mean of the embeddings of its words and subwords (hashed), and each area has a logistic
output of its own on it. The model is trained on sentences of labelled documents: every partition computes
the gradient of its sentences, the gradients are summed after each round, and all partitions go on from the
same parameters. Then every sentence of every document is scored, and a document has the areas that enough of
its sentences are about.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import shuffle_partitions
from .encode import slices
from .names import SIMPLIFIED, TRADITIONAL

#: Hash buckets of the embedding table (a power of two) and width of an embedding.
BUCKETS, WIDTH = 1 << 14, 16
#: Most labelled documents used for training; they are drawn by a hash of their id.
TRAINING_DOCUMENTS = 2_500
#: Rounds of training with documents' labels, rounds with refined ones, step size.
ROUNDS, REFINED, STEP = 25, 20, 0.1
#: A sentence is about an area from this probability on; a document has areas with this share of sentences.
ABOUT, SHARE = 0.5, 0.25

_B = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_LONGEST_WORD = 64
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(_LONGEST_WORD, _B, dtype=np.uint64))
_FOLD = np.arange(0x110000, dtype=np.uint32)
for _t, _s in zip(TRADITIONAL, SIMPLIFIED, strict=True):
    _FOLD[ord(_t)] = ord(_s)
_CLASS = np.zeros(0x110000, dtype=np.uint8)  # 1 letter of a word, 2 Chinese, 3 end of sentence, 4 end before a space
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("'")] = 1
_CLASS[0xC0:0x250] = 1
_CLASS[0x3400:0xA000] = 2
_CLASS[0x20000:0x31350] = 2
_CLASS[[ord(c) for c in "。！？"]] = 3
_CLASS[[ord(c) for c in ".!?"]] = 4


def _bucket(h: np.ndarray, kind: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31)) ^ np.uint64(kind * 0x2545F491)) * _MIX
    return ((h >> np.uint64(40)) & np.uint64(BUCKETS - 1)).astype(np.int32)


class Sentences:
    """Sentences of a batch of texts and their hashed features, worked out on one array of characters.

    A sentence ends with 。！？, or with . ! ? before white space or the end; a line break ends a fragment.
    Fragments without such an end (table cells, markup, headings) are no sentences and are left out.
    """

    def __init__(self, texts: list[str | None]):
        joined = "\n".join((t or "").replace("\n", "\r") for t in texts).lower()
        codes = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)
        if not len(codes):
            codes = np.array([10], dtype=np.uint32)
        chars = _FOLD[codes]
        kind = _CLASS[chars]
        line, brk = codes == 10, (codes == 13) | (codes == 10)
        blank = brk | (codes == 32) | (codes == 9) | (codes == 0xA0) | (codes == 0x3000)
        after_blank = np.append(blank[1:], True)
        ends = (kind == 3) | (kind == 4) & after_blank
        cut = ends | brk
        piece = np.zeros(len(codes), dtype=np.int64)
        np.cumsum(cut[:-1], out=piece[1:])
        document = np.zeros(len(codes), dtype=np.int64)
        np.cumsum(line[:-1], out=document[1:])
        # pieces that end as sentences do get consecutive numbers
        at = np.flatnonzero(ends)
        number = np.full(int(piece[-1]) + 1, -1, dtype=np.int64)
        worded = np.bincount(piece, weights=(kind == 1) | (kind == 2), minlength=len(number)) > 0
        at = at[worded[piece[at]]]
        number[piece[at]] = np.arange(len(at))
        self.document = document[at]
        self.count = len(at)
        sentence = number[piece]
        feats, owner = [], []

        def add(h: np.ndarray, s: np.ndarray, k: int) -> None:
            ok = s >= 0
            feats.append(_bucket(h[ok], k))
            owner.append(s[ok])

        with np.errstate(over="ignore"):
            c = chars.astype(np.uint64)
            han = kind == 2
            two = han[:-1] & han[1:]
            i = np.flatnonzero(two)
            pairs = c[i] * _B + c[i + 1]
            add(pairs, sentence[i], 1)
            j = np.flatnonzero(two[:-1] & two[1:])
            add((c[j] * _B + c[j + 1]) * _B + c[j + 2], sentence[j], 2)
            letter = kind == 1
            start = np.flatnonzero(letter & ~np.append(False, letter[:-1]))
            if len(start):
                w = np.flatnonzero(letter)
                first = np.zeros(len(w), dtype=np.int64)
                head = np.searchsorted(w, start)
                first[head] = start
                first = np.maximum.accumulate(first)
                h = np.add.reduceat(c[w] * _POWERS[np.minimum(w - first, _LONGEST_WORD - 1)], head)
                add(h, sentence[start], 3)
                k = np.flatnonzero(letter[:-3] & letter[1:-2] & letter[2:-1] & letter[3:]) if len(letter) > 3 else np.zeros(0, np.int64)
                add(((c[k] * _B + c[k + 1]) * _B + c[k + 2]) * _B + c[k + 3], sentence[k], 4)
        self.feature = np.concatenate(feats)
        self.owner = np.concatenate(owner)

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """(features in order of sentence, offsets of the sentences)."""
        order = np.argsort(self.owner, kind="stable")
        offsets = np.zeros(self.count + 1, dtype=np.int64)
        np.cumsum(np.bincount(self.owner, minlength=self.count), out=offsets[1:])
        return self.feature[order], offsets

    def scores(self, table: np.ndarray, bias: np.ndarray) -> np.ndarray:
        """Logits of each sentence, given the outputs of each bucket (embeddings times output weights)."""
        n = np.bincount(self.owner, minlength=self.count)
        out = np.empty((self.count, table.shape[1]), dtype=np.float32)
        for k in range(table.shape[1]):
            out[:, k] = np.bincount(self.owner, weights=table[self.feature, k], minlength=self.count)
        return out / np.maximum(n, 1)[:, None] + bias


def start_parameters(areas: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    return {
        "e": rng.normal(0, 0.3, (BUCKETS, WIDTH)).astype(np.float32),
        "w": rng.normal(0, 0.3, (WIDTH, areas)).astype(np.float32),
        "b": np.full(areas, -2.0, dtype=np.float32),
    }


def gradient(p: dict[str, np.ndarray], feature: np.ndarray, offsets: np.ndarray, target: np.ndarray, refine: bool = False) -> tuple[dict[str, np.ndarray], float]:
    """Summed gradient and loss of the sentences of one partition.

    Labels are given to documents, not to sentences: at first every sentence has its document's areas as
    target. With ``refine`` a sentence keeps only the likeliest of them, and none if none is likely (a
    sentence common to all filings); an area that seems likely although it is no label (a passing mention, a
    label forgotten) is left out of the loss.
    """
    n = np.maximum(np.diff(offsets), 1)
    rows = np.repeat(np.arange(len(n)), np.diff(offsets))
    width = p["e"].shape[1]
    hidden = np.empty((len(n), width), dtype=np.float32)
    for k in range(width):
        hidden[:, k] = np.bincount(rows, weights=p["e"][feature, k], minlength=len(n)) / n
    logit = hidden @ p["w"] + p["b"]
    prob = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    seen = np.ones_like(prob)
    if refine:
        own = prob * target
        best = own.max(1, keepdims=True)
        seen = 1 - ((target == 0) & (prob > 0.5))
        target = ((own == best) & (best > 0.25)).astype(np.float32) * target
    loss = float(-(seen * (target * np.log(prob + 1e-9) + (1 - target) * np.log(1 - prob + 1e-9))).sum())
    d = (seen * (prob - target)).astype(np.float32)
    dh = (d @ p["w"].T) / n[:, None]
    de = np.empty_like(p["e"])
    for k in range(width):
        de[:, k] = np.bincount(feature, weights=dh[rows, k], minlength=len(de))
    return {"e": de, "w": hidden.T @ d, "b": d.sum(0)}, loss


class Adam:
    """Adam over named arrays."""

    def __init__(self, step: float):
        self.step, self.t, self.m, self.v = step, 0, {}, {}

    def move(self, p: dict[str, np.ndarray], g: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k in p:
            m = self.m[k] = 0.9 * self.m.get(k, 0) + 0.1 * g[k]
            v = self.v[k] = 0.999 * self.v.get(k, 0) + 0.001 * g[k] ** 2
            p[k] = (p[k] - self.step * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.999**self.t)) + 1e-8)).astype(np.float32)


@dataclass
class Model:
    """What scoring needs: the areas, the outputs of each hash bucket, and the bias."""

    areas: list[str]
    table: np.ndarray
    bias: np.ndarray


def train(documents: DataFrame, labels: DataFrame, areas: list[str], most: int = TRAINING_DOCUMENTS, rounds: tuple[int, int] = (ROUNDS, REFINED)) -> Model:
    """A model from labelled documents: at most ``most`` of them, drawn by a hash of doc_id.

    Labels of unknown areas, labels without a document and documents without a sentence teach nothing. With
    no label at all the model finds no area in any document. Each round is one job over the cached features:
    a partition sends one gradient, whose size is fixed; the driver adds them up and moves the parameters.
    """
    spark = documents.sparkSession
    place = F.create_map(*[F.lit(x) for i, a in enumerate(areas) for x in (a, i)]) if areas else None
    if place is None:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    known = labels.select("doc_id", place[F.col("subject_code")].alias("area")).where("doc_id is not null and area is not null")
    drawn = known.groupBy("doc_id").agg(F.collect_set("area").alias("areas")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    # Bounded by ``most`` rows, so documents aren't shuffled to find them.
    texts = documents.select("doc_id", "text").where("text is not null").join(F.broadcast(drawn), "doc_id")
    parts = min(6, shuffle_partitions(spark))

    def featurise(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            wanted = b.column(1).to_pylist()
            for a, e, chunk in slices(b.column(0).to_pylist()):
                s = Sentences(chunk)
                feature, offsets = s.features()
                size, owner = np.diff(offsets).astype(np.int32), s.document
                for k in range(e - a):
                    mine = np.flatnonzero(owner == k)
                    if len(mine):
                        own = feature[offsets[mine[0]] : offsets[mine[-1] + 1]]
                        yield pa.RecordBatch.from_pylist([{"feature": own.tobytes(), "size": size[mine].tobytes(), "areas": wanted[a + k]}], schema=_ROWS)

    rows = texts.repartition(parts, "doc_id").select("text", "areas").mapInArrow(featurise, "feature binary, size binary, areas array<int>").persist(StorageLevel.MEMORY_AND_DISK)
    p, adam = start_parameters(len(areas)), Adam(STEP)
    try:
        for r in range(sum(rounds)):
            sent = spark.sparkContext.broadcast(p)
            total, count = _round(rows, sent, len(areas), r >= rounds[0])
            sent.destroy()
            if not count:
                return Model(areas, np.zeros((BUCKETS, len(areas)), np.float32), np.full(len(areas), -9.0, np.float32))
            adam.move(p, {k: v / count for k, v in total.items()})
    finally:
        rows.unpersist()
    return Model(areas, p["e"] @ p["w"], p["b"])


_ROWS = pa.schema([("feature", pa.binary()), ("size", pa.binary()), ("areas", pa.list_(pa.int32()))])


def _round(rows: DataFrame, sent, areas: int, refine: bool) -> tuple[dict[str, np.ndarray], int]:
    """The gradients of all partitions added up, and their number of sentences."""

    def one(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, sizes, targets = [], [], []
        for b in it:
            for f, s, a in zip(*(c.to_pylist() for c in b.columns), strict=True):
                size = np.frombuffer(s, np.int32)
                hot = np.zeros(areas, np.float32)
                hot[a] = 1
                features.append(np.frombuffer(f, np.int32))
                sizes.append(size)
                targets.append(np.broadcast_to(hot, (len(size), areas)))
        if features:
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes), dtype=np.int64)])
            g, _ = gradient(sent.value, np.concatenate(features), offsets, np.concatenate(targets), refine)
            yield pa.RecordBatch.from_pylist([{"n": len(offsets) - 1, **{k: v.astype(np.float32).tobytes() for k, v in g.items()}}], schema=pa.schema([("n", pa.int64()), ("e", pa.binary()), ("w", pa.binary()), ("b", pa.binary())]))

    total: dict[str, np.ndarray] = {k: np.zeros_like(v) for k, v in sent.value.items()}
    count = 0
    # As many rows as partitions, each of a fixed size.
    for row in rows.mapInArrow(one, "n long, e binary, w binary, b binary").collect():
        count += row["n"]
        for k in total:
            total[k] += np.frombuffer(bytes(row[k]), np.float32).reshape(total[k].shape)
    return total, count


def score(documents: DataFrame, model: Model, about: float = ABOUT, share: float = SHARE, all_documents: bool = False) -> DataFrame:
    """(doc_id, subject_code, sentences, of): areas that at least ``share`` of a document's sentences are about.

    All sentences of the whole text count. A null or empty text, and one without a sentence, has no area; with
    ``all_documents`` a document without an area has one row whose subject_code is null.
    """
    sent = documents.sparkSession.sparkContext.broadcast(model)
    kind = documents.schema["doc_id"].dataType.simpleString()
    out = pa.schema([("subject_code", pa.string()), ("sentences", pa.int32()), ("of", pa.int32())])
    logit = float(np.log(about / (1 - about)))

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in it:
            for a, e, chunk in slices(b.column(1).to_pylist()):
                s = Sentences(chunk)
                hot = s.scores(m.table, m.bias) >= logit
                n = np.bincount(s.document, minlength=e - a)
                hits = np.stack([np.bincount(s.document, weights=hot[:, k], minlength=e - a) for k in range(len(m.areas))], 1) if m.areas else np.zeros((e - a, 0))
                d, k = np.nonzero((hits > 0) & (hits >= share * n[:, None] - 1e-9))
                bare = np.setdiff1d(np.arange(e - a), d) if all_documents else d[:0]
                if len(d) + len(bare):
                    at = np.concatenate([d, bare])
                    ids = b.column(0).slice(a, e - a).take(pa.array(at))
                    of = np.concatenate([hits[d, k], np.zeros(len(bare))])
                    cols = [ids, pa.array([m.areas[x] for x in k] + [None] * len(bare), pa.string()), pa.array(of.astype(np.int32)), pa.array(n[at].astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *out.names])

    return documents.select("doc_id", "text").mapInArrow(batches, f"doc_id {kind}, subject_code string, sentences int, of int")


def subjects_found(documents: DataFrame, labels: DataFrame, areas: DataFrame) -> DataFrame:
    """(doc_id, subject_code) of the documents that have no label of their own.

    ``areas`` is a fixed list. Every document is scored; labelled ones leave afterwards, by id, so that no
    text is shuffled.
    """
    codes = [r[0] for r in areas.where("subject_code is not null").select("subject_code").distinct().orderBy("subject_code").collect()]
    found = score(documents, train(documents, labels, codes)).select("doc_id", "subject_code")
    return found.join(labels.select("doc_id").distinct(), "doc_id", "left_anti")


def composition(documents: DataFrame, labels: DataFrame, areas: DataFrame) -> DataFrame:
    """(subject_code, n_documents, share_of_documents) of the corpus, 'none' for documents without an area."""
    codes = [r[0] for r in areas.where("subject_code is not null").select("subject_code").distinct().orderBy("subject_code").collect()]
    found = score(documents, train(documents, labels, codes), all_documents=True)
    none = documents.sparkSession.createDataFrame([("none", 0)], "subject_code string, n_documents long")
    per_area = found.groupBy(F.coalesce("subject_code", F.lit("none")).alias("subject_code")).agg(F.count("*").alias("n_documents"))
    per_area = per_area.unionByName(none).groupBy("subject_code").agg(F.sum("n_documents").alias("n_documents"))
    return per_area.withColumn("share_of_documents", F.col("n_documents") / F.lit(max(documents.count(), 1)))
