"""Quality classifier: logistic regression on hashed word n-grams, trained with
follow-the-regularised-leader updates, scored as sparse dot products.

Words are runs of letters, of digits or of other signs; a word that repeats the one before
it is read as one common marker. Word pairs and single words are hashed to ``2**hash_bits``
features, whose values are their shares of the text's n-grams. Nothing else enters a score.

The model is fitted on a bounded sample of the labelled rows (``sample_rows``, the smallest
hashes of the ids), dealt over ``trainers`` tasks that each run the sequential updates over
their part; the model is the mean of theirs. Scoring reads every whole text in one pass: a
score is a sum of the weights that the text's n-grams point to, with no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salarium.llm.tables import column, configure, text_of

_LOT = 1 << 20  # bytes hashed at once
_SCALE = 32.0  # value of a feature that is all of a text
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_AGAIN = np.uint64(0xD1B54A32D192ED03)


class NGrams:
    """Hashed n-grams of lots of UTF-8 texts, without a loop over words."""

    def __init__(self, hash_bits: int):
        self.shift = np.uint64(64 - hash_bits)
        kind = np.full(256, 3, np.uint8)  # other signs
        kind[[9, 10, 11, 12, 13, 32]] = 0
        kind[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
        kind[48:58] = 2
        self.kind = kind
        # powers of an odd number and of its inverse make the hash of a run free of its place
        self.up = np.cumprod(np.full(_LOT + 1, _BASE, np.uint64), dtype=np.uint64)
        self.down = np.cumprod(np.full(_LOT + 1, _INVERSE, np.uint64), dtype=np.uint64)

    @staticmethod
    def _mixed(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))

    def _words(self, lot: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of each word of at most ``_LOT`` bytes."""
        raw = np.frombuffer(lot, np.uint8)
        kind = self.kind[raw]
        change = np.flatnonzero(np.diff(kind, prepend=0, append=0))
        # every change starts a run; runs of white space are no words
        starts = change[:-1] if len(change) else change
        ends = change[1:] if len(change) else change
        word = kind[starts] != 0 if len(starts) else np.empty(0, bool)
        starts, ends = starts[word], ends[word]
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[: len(raw)], out=sums[1:])
        return starts, self._mixed((sums[ends] - sums[starts]) * self.down[starts])

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each word, number of words of each text)"""
        hashes, owners = [], []
        lot, first, size = [], 0, 0

        def flush(upto: int) -> None:
            nonlocal lot, first, size
            if lot:
                ends = np.cumsum([len(t) + 1 for t in lot])
                starts, h = self._words(b" ".join(lot))
                hashes.append(h)
                owners.append(first + np.searchsorted(ends, starts, side="right"))
            lot, first, size = [], upto, 0

        for i, text in enumerate(texts):
            if size + len(text) + 1 > _LOT:
                flush(i)
            if len(text) < _LOT:
                lot.append(text)
                size += len(text) + 1
                continue
            at = 0
            while at < len(text):  # a long text in pieces, cut at white space where there is any
                end = at + _LOT
                if end < len(text):
                    cut = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end))
                    end = cut if cut > at else end
                _, h = self._words(text[at:end])
                hashes.append(h)
                owners.append(np.full(len(h), i))
                at = end
            first = i + 1
        flush(len(texts))
        owner = np.concatenate([np.empty(0, np.int64), *owners])
        return np.concatenate([np.empty(0, np.uint64), *hashes]), np.bincount(owner, minlength=len(texts)).astype(np.int64)

    def features(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(feature number of each n-gram, text by text, and the text it is of)"""
        h, counts = self.words(texts)
        owner = np.repeat(np.arange(len(texts)), counts)
        follows = np.zeros(len(h), bool)
        follows[1:] = owner[1:] == owner[:-1]
        again = np.zeros(len(h), bool)
        again[1:] = follows[1:] & (h[1:] == h[:-1])
        h = np.where(again, _AGAIN, h)
        second = np.flatnonzero(follows)
        pairs = self._mixed(h[second - 1] * np.uint64(3) + h[second])
        number = np.concatenate([h, pairs]) * _BASE >> self.shift
        return number.astype(np.int64), np.concatenate([owner, owner[second]])


class Leader:
    """Follow-the-regularised-leader logistic regression, updated one text at a time."""

    def __init__(self, size: int, alpha: float, beta: float, l1: float, l2: float):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


class Model:
    """Weights of the hashed features; the last one belongs to every text."""

    def __init__(self, hash_bits: int, weights: np.ndarray):
        self.hash_bits, self.weights = hash_bits, weights.astype(np.float32)

    def score(self, grams: NGrams, texts: list[bytes]) -> np.ndarray:
        number, owner = grams.features(texts)
        sums = np.bincount(owner, self.weights[number], len(texts))
        total = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        margin = self.weights[-1] + _SCALE * sums / total
        return 1 / (1 + np.exp(-np.clip(margin, -35, 35)))


def _sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int, held_out: Column, text_col: str, id_col: str) -> DataFrame:
    """(id, y, text) of at most ``rows`` labelled rows that are not held out."""
    marked = labels.select(column(labels, id_col).alias("label_id"), column(labels, label_col).cast("int").alias("y"))
    chosen = marked.where(F.col("label_id").isNotNull() & F.col("y").isin(0, 1)).withColumn("id", F.col("label_id"))
    chosen = chosen.where(~held_out).orderBy(F.xxhash64("label_id"), "label_id", "y").limit(rows).select("label_id", "y")
    read = docs.select(column(docs, id_col).alias("id"), text_of(docs, text_col).alias("text"))
    return read.join(F.broadcast(chosen), F.col("id") == F.col("label_id")).select("id", "y", "text")


def held_out_column(id_col: str = "id") -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3 (a null id: no)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    hash_bits: int = 18,
    sample_rows: int = 20_000,
    trainers: int = 4,
    epochs: int = 6,
    alpha: float = 1.0,
    l1: float = 0.01,
    l2: float = 0.0,
    text_col: str = "text",
    id_col: str = "doc_id",
) -> Model:
    """Fit the model on labelled rows that are not held out. Without any it scores 0.5."""
    size = (1 << hash_bits) + 1
    sample = _sample(docs, labels, label_col, sample_rows, held_out_column(), text_col, id_col)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = NGrams(hash_bits)
        for batch in batches:
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            at, x = [], []
            for text in texts:
                number, count = np.unique(grams.features([text])[0], return_counts=True)
                at.append(np.append(number, size - 1))
                x.append(np.append(_SCALE * count / max(1, count.sum()), 1.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(at, pa.list_(pa.int64())), pa.array(x, pa.list_(pa.float64()))],
                ["id", "y", "at", "x"])

    schema = T.StructType([
        T.StructField("id", sample.schema["id"].dataType), T.StructField("y", T.IntegerType()),
        T.StructField("at", T.ArrayType(T.LongType())), T.StructField("x", T.ArrayType(T.DoubleType())),
    ])
    rows = sample.mapInArrow(extract, schema).withColumn("order", F.xxhash64(F.lit(1), "id"))

    def fit(table: pa.Table) -> pa.Table:
        leader = Leader(size, alpha, 1.0, l1, l2)
        table = table.sort_by([("order", "ascending"), ("y", "ascending")])
        ys = table.column("y").to_pylist()
        ats = [np.array(v.values) for v in table.column("at")]
        xs = [np.array(v.values) for v in table.column("x")]
        for _ in range(epochs):
            for at, x, y in zip(ats, xs, ys):
                leader.update(at, x, y)
        w = leader.weights(slice(None))
        used = np.flatnonzero(w)
        return pa.table({"at": pa.array(used, pa.int64()), "w": pa.array(w[used])})

    parts = rows.groupBy(F.pmod("order", F.lit(trainers)).alias("trainer")).applyInArrow(
        fit, "at long, w double")
    # at most 2**hash_bits + 1 rows
    weights = np.zeros(size)
    for r in parts.groupBy("at").agg((F.sum("w") / trainers).alias("w")).collect():
        weights[r["at"]] = r["w"]
    return Model(hash_bits, weights)


def score(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id, ``held_out``, ``score``, ``predicted``.

    Null and empty texts score as the model does without any feature. Null ids and repeated
    rows are rows like any other; other columns are not read; an empty table gives an empty
    result.
    """
    configure(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = NGrams(model.hash_bits)
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(grams, texts), pa.float64())], ["id", "score"])

    read = docs.select(column(docs, id_col).alias("id"), text_of(docs, text_col).alias("text"))
    schema = T.StructType([T.StructField("id", read.schema["id"].dataType), T.StructField("score", T.DoubleType())])
    scored = read.mapInArrow(run, schema)
    return scored.select(
        F.col("id").alias(id_col), held_out_column().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def quality_scores(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """Train on ``labels`` and score ``docs``; the settings are those of ``train``."""
    return score(docs, train(docs, labels, **settings), settings.get("text_col", "text"), settings.get("id_col", "doc_id"))


def keep_good(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """``docs`` without the rows whose text the classifier rejects, all columns kept."""
    model = train(docs, labels, **settings)
    text_col, fields = settings.get("text_col", "text"), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = NGrams(model.hash_bits)
        for batch in batches:
            texts = [t or b"" for t in batch.column(batch.schema.names.index(text_col)).cast(pa.binary()).to_pylist()]
            yield batch.filter(pa.array(model.score(grams, texts) >= 0.5))

    configure(docs.sparkSession)
    return docs.mapInArrow(run, fields)
