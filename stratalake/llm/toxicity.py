"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts (the positives) and any texts of the training fold (the unlabelled) train a linear classifier on hashed
word features. With the class prior p, the risk p * E_pos[loss(f)] + max(0, E_unl[loss(-f)] - p * E_pos[loss(-f)]) is that
of a training set with both labels; where a batch turns its second part negative, the step goes the other way, so that
the classifier cannot drive the estimate below nothing by overfitting.

A text's features are, over its distinct lower-cased words, the word and its beginnings of 4, 5 and 6 letters, hashed
into DIMENSIONS slots, summed and divided by the root of the number of words. A word's weight is therefore a sum that is
looked up once, and scoring a text of any length is one pass over its words.

Defined results: a null or empty text, or one without words, has no features and gets the score of the bias alone, which
is learned; labels of null count as no label; without any positive every score is 0; repeated rows are scored alike; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from stratalake.functions.names import column
from stratalake.llm.common import written

DIMENSIONS = 1 << 18
STEMS = (4, 5, 6)
#: Bounds of the training sample, in documents: rows with the smallest hashes of their ids.
POSITIVES, UNLABELLED = 3000, 6000
THRESHOLD = 0.7
NORM = 0.5
SEEN, SURE, FLOOR = 5, 4.0, 0.01
WORD = re.compile(r"[^\W\d_]+")
#: Words in a worker's cache.
WORDS = 200_000


def word_features(word: str) -> list[int]:
    forms = {word + "$", *(word[:n] for n in STEMS if len(word) >= n)}
    return [zlib.crc32(f.encode()) % DIMENSIONS for f in forms]


def words(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text."""
    own = words(text)
    slots, counts = np.unique(np.array([f for w in own for f in word_features(w)], np.int32), return_counts=True)
    return slots, (counts / max(1, len(own)) ** NORM).astype(np.float32)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, texts: Iterable[str | None], cache: dict[str, float]) -> Iterator[float]:
        weights = self.weights
        for text in texts:
            own = words(text)
            if len(cache) > WORDS:
                cache.clear()
            total = 0.0
            for word in sorted(own):
                value = cache.get(word)
                if value is None:
                    value = cache[word] = float(weights[word_features(word)].sum())
                total += value
            logit = self.bias + total / max(1, len(own)) ** NORM
            yield float(1 / (1 + np.exp(-np.clip(logit, -40, 40))))


class Samples:
    """Texts' features, row after row."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.ends = np.cumsum([0] + [len(s) for s, _ in rows])
        self.slots = np.concatenate([s for s, _ in rows]) if rows else np.zeros(0, np.int32)
        self.values = np.concatenate([v for _, v in rows]) if rows else np.zeros(0, np.float32)

    def __len__(self) -> int:
        return len(self.ends) - 1

    def kept(self, factor: np.ndarray) -> "Samples":
        """The rows with each value times its slot's factor, without the zeros."""
        own = factor[self.slots] != 0
        out = Samples([])
        out.ends = np.concatenate([[0], np.cumsum(own)])[self.ends]
        out.slots, out.values = self.slots[own], self.values[own] * factor[self.slots[own]]
        return out

    def sums(self, weights: np.ndarray) -> np.ndarray:
        rows, slots, values = self.batch(np.arange(len(self)))
        return np.bincount(rows, weights[slots] * values, len(self))

    def batch(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lengths = self.ends[rows + 1] - self.ends[rows]
        at = np.repeat(self.ends[rows] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        return np.repeat(np.arange(len(rows)), lengths), self.slots[at], self.values[at]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def log_ratios(positive: Samples, unlabelled: Samples, smooth: float = 1.0) -> np.ndarray:
    """Of each slot: log of its share of positive texts over its share of unlabelled ones, smoothed."""
    seen_p = np.bincount(positive.slots, minlength=DIMENSIONS)
    seen_u = np.bincount(unlabelled.slots, minlength=DIMENSIONS)
    return ratios_of(seen_p, seen_u, len(positive), len(unlabelled))


def ratios_of(seen_p: np.ndarray, seen_u: np.ndarray, n_p: int, n_u: int) -> np.ndarray:
    """The log ratios from the numbers of texts that have each slot; 0 where the two shares do not differ surely."""
    p, u = seen_p / max(1, n_p), seen_u / max(1, n_u)
    both = (seen_p + seen_u) / max(1, n_p + n_u)
    spread = np.sqrt(both * (1 - both) * (1 / max(1, n_p) + 1 / max(1, n_u))) + 1e-12
    return np.log((p + FLOOR) / (u + FLOOR)) * ((np.abs(p - u) >= SURE * spread) & (seen_p + seen_u >= SEEN))


def train(positive: Samples, unlabelled: Samples, prior: float, epochs: int = 20, batch: int = 256, rate: float = 0.5, seed: int = 1) -> Model:
    """Weights by adaptive gradient steps on the non-negative risk with logistic loss.

    Features are scaled by their log ratios, so that the first guess, one weight for all, already is a naive Bayes score.
    """
    ratios = log_ratios(positive, unlabelled)
    weights, square = np.ones(DIMENSIONS), np.full(DIMENSIONS, 1e-6)
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(DIMENSIONS), -40.0)
    gain, bias, gain_square, bias_square = 1.0, float(np.log(prior / (1 - prior))) if 0 < prior < 1 else 0.0, 1e-6, 1e-6
    positive, unlabelled = positive.kept(ratios), unlabelled.kept(ratios)
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        order = random.permutation(len(unlabelled))
        for at in range(0, len(order), batch):
            u_rows = order[at : at + batch]
            p_rows = random.choice(len(positive), min(batch, len(positive)), replace=False)
            (pr, ps, pv), (ur, us, uv) = positive.batch(p_rows), unlabelled.batch(u_rows)
            s_p, s_u = np.bincount(pr, weights[ps] * pv, len(p_rows)), np.bincount(ur, weights[us] * uv, len(u_rows))
            f_p, f_u = bias + gain * s_p, bias + gain * s_u
            rest = np.logaddexp(0, f_u).mean() - prior * np.logaddexp(0, f_p).mean()
            # slopes of loss(f) = log(1 + exp(-f)) and loss(-f) by f
            up, down_p, down_u = -sigmoid(-f_p), sigmoid(f_p), sigmoid(f_u)
            if rest >= 0:
                g_p, g_u = prior * (up - down_p) / len(p_rows), down_u / len(u_rows)
            else:
                g_p, g_u = prior * down_p / len(p_rows), -down_u / len(u_rows)
            slots, place = np.unique(np.concatenate([ps, us]), return_inverse=True)
            slope = gain * np.bincount(place, np.concatenate([g_p[pr] * pv, g_u[ur] * uv]), len(slots))
            square[slots] += slope**2
            weights[slots] -= rate * slope / np.sqrt(square[slots])
            tilt = g_p.sum() + g_u.sum()
            bias_square += tilt**2
            bias -= rate * tilt / bias_square**0.5
            pull = g_p @ s_p + g_u @ s_u
            gain_square += pull**2
            gain = max(0.0, gain - rate * pull / gain_square**0.5)
    return Model(gain * weights * ratios, bias)


def calibrated(model: Model, positive: Samples, unlabelled: Samples, prior: float) -> Model:
    """The model with its logit shifted and scaled on texts it was not trained on: the cut with the least prior-corrected
    rate of errors gets a score of 0.6, the median positive 0.95."""
    f_p, f_u = (model.bias + s.sums(model.weights) for s in (positive, unlabelled))
    if not len(f_p) or not len(f_u) or not model.weights.any():
        return model
    cuts = np.unique(np.concatenate([f_p, f_u]))
    missed = np.searchsorted(np.sort(f_p), cuts, "left") / len(f_p)
    above = 1 - np.searchsorted(np.sort(f_u), cuts, "left") / len(f_u)
    risk = prior * missed + np.maximum(0, above - prior * (1 - missed))
    best = np.flatnonzero(risk <= risk.min() + 1e-12)
    cut = float(cuts[best[-1]] + cuts[max(best[0] - 1, 0)]) / 2
    low, high = np.log(0.6 / 0.4), np.log(0.95 / 0.05)
    scale = (high - low) / max(float(np.median(f_p)) - cut, 0.1)
    return Model(model.weights * scale, float((model.bias - cut) * scale + low))


def held_back(row):
    """Whether a row of the sample calibrates and does not train."""
    return row % 4 == 3


def fit(positive: list[tuple], unlabelled: list[tuple], prior: float) -> Model:
    """Trains on three quarters of the rows (in the given order) and calibrates on the rest."""
    split = lambda rows, back: [r for i, r in enumerate(rows) if held_back(i) == back]
    model = train(Samples(split(positive, False)), Samples(split(unlabelled, False)), prior)
    return calibrated(model, Samples(split(positive, True) or positive), Samples(split(unlabelled, True) or unlabelled), prior)


def in_training(id_col: str = "doc_id") -> Column:
    """The fold whose labels may be learned: crc32 of the id's text modulo 3 is not 1 (a null id is in it)."""
    return F.coalesce(F.crc32(column(id_col).cast("string").cast("binary")) % 3 != 1, F.lit(True))


def learned(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """A model of the training fold: the positives are its texts with label 1, the unlabelled any of its texts, at most
    ``positives`` and ``unlabelled`` ids with the smallest hashes; the prior is the share of label 1 among its labels. Of
    the texts that share an id, the one with the smallest hash is taken. The sample's features are written; the driver gets
    how many texts have each slot (DIMENSIONS numbers of each kind), and then the features in slots with a log ratio."""
    fold = labels.filter(in_training(id_col)).select(column(id_col).alias("id"), column(label_col).cast("double").alias("label"))
    prior = fold.agg(F.avg("label")).first()[0] or 0.0
    order = [F.xxhash64("id"), "id"]
    some_p = fold.filter("label = 1 and id is not null").select("id").distinct().orderBy(*order).limit(positives)
    ids = docs.filter(in_training(id_col)).select(column(id_col).alias("id")).filter("id is not null")
    some_u = ids.distinct().orderBy(*order).limit(unlabelled)
    chosen = some_p.withColumn("kind", F.lit(1)).unionByName(some_u.withColumn("kind", F.lit(0)))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [text_features(t.as_py()) for t in batch.column(2)]
            arrays = [pa.array([f[i].tobytes() for f in found], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["place", "kind", "slots", "values"])

    texts = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text"))
    one = texts.join(F.broadcast(chosen), "id").groupBy("id", "kind").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    sample = one.select(F.xxhash64("id").alias("place"), "kind", "least.text")
    found = written(sample.mapInArrow(features, "place long, kind int, slots binary, values binary"), "sample")
    ranked = Window.partitionBy("kind").orderBy("place", "slots")  # ``positives`` or ``unlabelled`` rows at most
    found = written(found.withColumn("row", F.row_number().over(ranked) - 1), "sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, DIMENSIONS), np.int64)
        for batch in batches:
            for kind, slots in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen[kind][np.frombuffer(slots.as_py(), np.int32)] += 1
        kinds, slots = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(slots, pa.int32()), pa.array(seen[kinds, slots])], ["kind", "slot", "n"])

    trained = found.filter(~held_back(F.col("row")))
    counts = trained.select("kind", "slots").mapInArrow(count, "kind int, slot int, n long").groupBy("kind", "slot").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros((2, DIMENSIONS), np.int64)
    seen[counts.column("kind").to_numpy(), counts.column("slot").to_numpy()] = counts.column("n").to_numpy()
    sizes = {r.kind: r["count"] for r in trained.groupBy("kind").count().collect()}
    used = np.packbits(ratios_of(seen[1], seen[0], sizes.get(1, 0), sizes.get(0, 0)) != 0)

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.unpackbits(used, count=DIMENSIONS).astype(bool)
        for batch in batches:
            out: list[list[bytes]] = [[], []]
            for slots, values in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                slots, values = np.frombuffer(slots, np.int32), np.frombuffer(values, np.float32)
                for column_, data in zip(out, (slots, values)):
                    column_.append(data[kept[slots]].tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, pa.binary()) for c in out)], ["kind", "row", "slots", "values"])

    table = found.select("kind", "row", "slots", "values").mapInArrow(thin, "kind int, row int, slots binary, values binary").toArrow().sort_by("row")
    rows: dict[int, list[tuple]] = {0: [], 1: []}
    for kind, slots, values in zip(*(table.column(n).to_pylist() for n in ("kind", "slots", "values"))):
        rows[kind].append((np.frombuffer(slots, np.int32), np.frombuffer(values, np.float32)))
    return fit(rows[1], rows[0], prior)


def toxicity(model: Model, text: Column) -> Column:
    """The score, 0 to 1, of a text column."""
    used = np.flatnonzero(model.weights)
    slots, values, bias = used.tolist(), model.weights[used].tolist(), model.bias

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights = np.zeros(DIMENSIONS)
        weights[slots] = values
        whole, cache = Model(weights, bias), {}
        for batch in batches:
            yield pa.array(whole.scores((t.as_py() for t in batch), cache), pa.float64())

    return score(text.cast("string"))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row."""
    scored = docs.select(column(id_col).alias("doc_id"), toxicity(model, column(text_col)).alias("score"))
    return scored.select("doc_id", (~in_training("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
