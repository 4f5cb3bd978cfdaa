"""URL filter: rules first, then a ratio of two character language models.

URLs that a rule decides are the examples: allowed ones train the accepting model, blocked ones the rejecting one. Both
are variable-order Markov models over SYMBOLS character classes: the probability of a character is the Witten-Bell blend
of its counts after contexts of 0 to ORDER - 1 characters, each order backing off to the shorter one as far as the longer
context is rare. Counts come from all example URLs, one for each model, context and next character, so the models grow
with the contexts there are: they are a table in the shared folder, made by an aggregate that tasks combine before the
shuffle, and neither the driver nor a task holds them.

The score is the difference of log-likelihoods per character. A gram is a character with the ORDER - 1 before it. The
distinct grams of all URLs to score are joined with the counts of their contexts, which gives the difference of each gram
once; the grams of each distinct URL are joined with these, and summed as whole 2^-32, exact in any order. Both joins have
one row per key on one side, so adaptive execution can split a gram that all URLs hold.

One example in HELD (by the hash of the URL, so copies go together) is kept from the counts; a logistic fit on the
histogram of their scores turns the score into a probability, and URLs at CALIBRATED or more are allowed.

Defined results: a null URL or one without ``://`` has empty host and path, fits no rule and is scored as its whole text
(null: empty, score 0); without examples of both kinds every URL that no rule decides is allowed; repeated rows are
counted and scored alike; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stratalake.functions.names import column
from stratalake.llm.common import mixed, row_blocks, strings, written

ORDER, SYMBOLS, CONTEXTS = 5, 64, 1 << 13
HELD, CALIBRATED = 5, 0.5
#: Histogram of scores for the calibration: bins over -SPAN..SPAN.
BINS, SPAN = 2000, 8.0
BLOCK = 1_000_000
#: Verdict and rule, host and path prefix.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Scores are summed in whole parts of this size.
PARTS = 1 << 32
#: Rows of contexts of each order in ``Models``.
SIZES = [min(SYMBOLS**n, CONTEXTS) for n in range(ORDER)]
STARTS = np.cumsum([0, *(SYMBOLS * n for n in SIZES)])


def classes() -> np.ndarray:
    """Class of each byte: letters without case, digits, the marks URLs are made of, other ASCII, other bytes; 0 is the
    end and the start of a URL."""
    own = np.full(256, 62, np.int64)
    own[128:] = 63
    for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789/.-_%~=&+:?#@!$'()*,;"):
        own[ord(c)] = own[ord(c.upper())] = i + 1
    return own


CLASS = classes()


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: on to ``?``, ``#`` or the end."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        site, _, rest = text.partition("/")
        fits = ((host == site) | host.endswith("." + site)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all characters of all texts and their ends: text number and gram, the class of the character lowest, then those
    before it, the nearest one first; starts count as class 0. And the characters of each text, with its end."""
    lengths = np.diff(offsets)
    text = np.repeat(np.arange(len(lengths)), lengths + 1)
    symbol = np.zeros(len(text), np.int64)
    inside = np.ones(len(text), bool)
    inside[np.cumsum(lengths + 1) - 1] = False
    symbol[inside] = CLASS[data]
    first = np.repeat(np.cumsum(lengths + 1) - lengths - 1, lengths + 1)
    place = np.arange(len(text)) - first
    gram = symbol.copy()
    for step in range(1, ORDER):
        before = np.zeros(len(text), np.int64)
        before[step:] = symbol[: max(0, len(symbol) - step)]
        before[place < step] = 0
        gram += before * SYMBOLS**step
    return text, gram, lengths + 1


def cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all characters of all texts and their ends: text number, and cell of ``Models`` at each order (ORDER x characters)."""
    text, gram, lengths = grams(data, offsets)
    out = np.empty((ORDER, len(text)), np.int64)
    for order in range(ORDER):
        context = gram // SYMBOLS % SYMBOLS**order
        row = context if SYMBOLS**order <= CONTEXTS else (mixed(context.astype(np.uint64)) % np.uint64(CONTEXTS)).astype(np.int64)
        out[order] = STARTS[order] + row * SYMBOLS + gram % SYMBOLS
    return text, out, lengths


class Models:
    """Blended log-probabilities of both models in one array, for few URLs: longer contexts share CONTEXTS rows per order,
    so ``judge_urls`` does not use it."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts.astype(float)  # 2 x cells
        self.totals, self.kinds = [], []
        for order in range(ORDER):
            table = self.counts[:, STARTS[order] : STARTS[order + 1]].reshape(2, SIZES[order], SYMBOLS)
            self.totals.append(table.sum(2))
            self.kinds.append((table > 0).sum(2))

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Difference of log-likelihoods per character of each text."""
        text, cell, lengths = cells(data, offsets)
        difference = np.zeros(len(text))
        for model, sign in ((1, 1.0), (0, -1.0)):
            p = np.full(len(text), 1.0 / SYMBOLS)
            for order in range(ORDER):
                row = (cell[order] - STARTS[order]) // SYMBOLS
                total, kinds = self.totals[order][model][row], self.kinds[order][model][row]
                p = np.where(total > 0, (self.counts[model, cell[order]] + kinds * p) / np.maximum(total + kinds, 1), p)
            difference += sign * np.log(p)
        return np.bincount(text, difference, len(lengths)) / lengths


def logistic(histogram: np.ndarray) -> tuple[float, float]:
    """Slope and shift of P(accepted | score), from a 2 x BINS histogram with equal weight for both kinds: Newton steps
    with a weak pull of the slope to 1."""
    x = (np.arange(BINS) + 0.5) * (2 * SPAN / BINS) - SPAN
    weight = histogram / np.maximum(histogram.sum(1, keepdims=True), 1)
    w = np.array([1.0, 0.0])
    design = np.stack([x, np.ones(BINS)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(w @ design, -30, 30)))
        slope = design @ (weight[0] * p - weight[1] * (1 - p)) + 1e-4 * (w - [1.0, 0.0])
        bend = (design * (weight.sum(0) * p * (1 - p))) @ design.T + 1e-4 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        w = w - step * min(1.0, 10 / max(1e-9, float(np.abs(step).max())))
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def counted(examples: DataFrame) -> DataFrame:
    """``place, total_1, kinds_1, total_0, kinds_0, next``: what follows each context (its order and classes are the place)
    in the examples ``kind, url, n`` of either kind; ``next`` maps a class to its two counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, times = (batch.column(i).to_numpy().astype(np.int64) for i in (0, 2))
            data, offsets = strings(batch.column(1))
            for first, end in row_blocks(offsets, BLOCK):
                text, gram, _ = grams(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
                for order in range(ORDER):
                    own, at = np.unique(gram % SYMBOLS ** (order + 1) * 2 + kind[first:end][text], return_inverse=True)
                    n = np.zeros(len(own), np.int64)
                    np.add.at(n, at, times[first:end][text])
                    place = own // (2 * SYMBOLS) + order * SYMBOLS**ORDER
                    yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(own // 2 % SYMBOLS), pa.array(own % 2), pa.array(n)], ["place", "symbol", "kind", "n"])

    rows = examples.select("kind", "url", "n").mapInArrow(count, "place long, symbol long, kind long, n long")
    cell = rows.groupBy("place", "symbol").agg(*(F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n_{k}") for k in (1, 0)))
    totals = [f(k) for k in (1, 0) for f in (lambda k: F.sum(f"n_{k}").alias(f"total_{k}"), lambda k: F.sum((F.col(f"n_{k}") > 0).cast("long")).alias(f"kinds_{k}"))]
    return cell.groupBy("place").agg(*totals, F.map_from_entries(F.collect_list(F.struct("symbol", F.struct("n_1", "n_0")))).alias("next"))


def ratios(needed: DataFrame, contexts: DataFrame) -> DataFrame:
    """``gram, parts``: the difference of the log-probabilities of each gram in both models, in whole 1 / PARTS."""
    orders = F.explode(F.array(*(F.struct(F.lit(n).alias("order"), (F.floor(F.col("gram") / SYMBOLS) % SYMBOLS**n + n * SYMBOLS**ORDER).cast("long").alias("place")) for n in range(ORDER))))
    rows = needed.select("gram", orders.alias("at")).select("gram", "at.*").join(contexts, "place")
    own = F.try_element_at("next", F.col("gram") % SYMBOLS)
    seen = [F.coalesce(own[f"n_{k}"], F.lit(0)).alias(f"n_{k}") for k in (1, 0)]
    steps = rows.groupBy("gram").agg(F.array_sort(F.collect_list(F.struct("order", *(f"{c}_{k}" for c in ("total", "kinds") for k in (1, 0)), *seen))).alias("steps"))

    def likely(k: int) -> Column:
        blend = lambda p, s: F.when(s[f"total_{k}"] > 0, (s[f"n_{k}"] + s[f"kinds_{k}"] * p) / (s[f"total_{k}"] + s[f"kinds_{k}"])).otherwise(p)
        return F.log(F.aggregate("steps", F.lit(1.0 / SYMBOLS), blend))

    return steps.select("gram", F.round((likely(1) - likely(0)) * PARTS).cast("long").alias("parts"))


def url_scores(urls: DataFrame, contexts: DataFrame) -> DataFrame:
    """``id, score`` of each of ``id, url``."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = strings(batch.column(1))
            for first, end in row_blocks(offsets, BLOCK):
                text, gram, _ = grams(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
                own, n = np.unique(text * SYMBOLS**ORDER + gram, return_counts=True)
                rows = batch.column(0).take(pa.array(own // SYMBOLS**ORDER + first))
                yield pa.RecordBatch.from_arrays([rows, pa.array(own % SYMBOLS**ORDER), pa.array(n.astype(np.int64))], ["id", "gram", "n"])

    held = written(urls.select("id", "url").mapInArrow(split, "id long, gram long, n long"), "url-grams")
    known = ratios(held.select("gram").distinct(), contexts)
    return held.join(known, "gram").groupBy("id").agg((F.sum(F.col("n") * F.col("parts")) / PARTS / F.sum("n")).alias("score"))


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score, probability`` of each row; score and probability are null where a rule decides."""
    url = F.coalesce(column(url_col).cast("string"), F.lit(""))
    host, path = host_and_path(url)
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = pages.select(column(id_col).alias("page_id"), url.alias("url"), host.alias("host"), path.alias("path"))
    judged = judged.withColumns({"rule": rule, "said": verdict})
    held = F.pmod(F.xxhash64("url"), F.lit(HELD)) == 0
    urls = judged.groupBy("url", "said").agg(F.count("*").alias("n"))
    urls = written(urls.select(F.monotonically_increasing_id().alias("id"), "url", "n", (F.col("said") == "allow").cast("long").alias("kind"), held.alias("held")), "urls")
    contexts = written(counted(urls.filter("kind is not null and not held")), "url-contexts")
    whole = contexts.filter("place = 0").select("total_1", "total_0").first()  # the empty context
    both = whole is not None and min(whole) > 0
    slope, shift = 1.0, 0.0
    if both:
        asked = urls.filter("(kind is null or held) and length(url) > 0")
        known = written(asked.join(url_scores(asked, contexts), "id").select("url", "kind", "n", "score"), "url-scores")
        place = F.least(F.greatest(F.floor((F.col("score") + SPAN) * (BINS / (2 * SPAN))), F.lit(0)), F.lit(BINS - 1)).alias("bin")
        histogram = np.zeros((2, BINS), np.int64)
        for kind, at, n in known.filter("kind is not null").groupBy("kind", place).agg(F.sum("n")).collect():
            histogram[kind, at] = n
        slope, shift = logistic(histogram)
        scored = judged.join(known.filter("kind is null").select("url", "score"), "url", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    else:
        scored = judged.withColumn("score", F.lit(0.0))
    chance = 1 / (1 + F.exp(-(F.col("score") * slope + shift))) if both else F.lit(1.0)
    scored = scored.withColumn("probability", chance)
    final = F.coalesce("said", F.when(F.col("probability") >= CALIBRATED, "allow").otherwise("block"))
    ruled = F.col("said").isNotNull()
    hidden = [F.when(~ruled, F.col(c)).alias(c) for c in ("score", "probability")]
    return scored.select("page_id", "host", "path", "rule", final.alias("verdict"), *hidden)
