"""Toxicity from class-conditional Kneser-Ney models.

An expression is a word. Each class (toxic, ordinary) has a Kneser-Ney model that spells words letter by letter, the
context being all letters so far, however many: a class's own counts are discounted and the mass taken off goes to the counts that
both classes share, which in turn back off to a letter's continuation count (before how many beginnings it occurs).
So an expression that a class has rarely or never seen is scored by its stem, and one that neither class has seen says
nothing. A text's evidence is its toxic log-likelihood less its ordinary one, normalised by its length in words.

Both log-likelihoods share every factor that only the shared counts decide, so the fitted model keeps, for each known
beginning of a word, the sum of the differences on the way to it and the difference that any unseen next letter adds.
A beginning goes by a number got from that of the beginning one letter shorter, so words of any length are counted and
scored whole in time and rows in proportion to their letters.
A logistic curve, fitted on labelled texts kept out of the counts, turns the evidence into a score from 0 to 1.

Fitting uses a bounded, hashed sample of the labelled rows (``FIT_ROWS`` rows and ``FIT_CHARS`` characters, expected
values), drawn by label, so a rare class is learned from all its rows however large the table is. Scoring reads every
text whole.

Defined results: null, empty and wordless texts have evidence 0 and the score that belongs to it; a null id is never
held out and never trains; without labels of both classes the score is constant; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import each_text, filled, id_remainder, logistic, logistic_fit, sample_by_label, saved, strings

FIT_ROWS = 16_000
FIT_CHARS = 64_000_000
#: A beginning's number: that of the one before, times BASE, plus the letter, modulo PRIME. The empty one has 0.
BASE, PRIME = 1_442_695_040_888_963_407, 2 ** 61 - 1
END = "\n"
DISCOUNT = 0.75
#: Beginnings seen less often in both classes together are left to the backoff.
LEAST_COUNT = 2
#: Natural-log units: an expression must be about 20 times likelier in one class.
MARGIN = 3.0
#: Of the sampled rows one in this many calibrates and the others are counted.
CALIBRATE_ONE_IN = 4
MEMO_WORDS = 150_000

_WORD = re.compile(r"\w+")


class Node(NamedTuple):
    """A beginning: its number, that of the one before, its last letter, its length, and its count in each class."""

    begin: int
    above: int
    letter: int
    size: int
    ordinary: int
    toxic: int


def steps(word: str) -> Iterator[tuple[int, int, int]]:
    """(number, number of the one before, last letter) of each beginning of a word, its end marked, shortest first."""
    number = 0
    for sign in word + END:
        above, number = number, (number * BASE + ord(sign) + 1) % PRIME
        yield number, above, ord(sign)


def number(begin: str) -> int:
    """The number of one beginning."""
    out = 0
    for sign in begin:
        out = (out * BASE + ord(sign) + 1) % PRIME
    return out


class Evidence(dict):
    """word -> log-likelihood difference beyond the margin, filled on demand from the model's table of beginnings."""

    def __init__(self, table: dict[int, tuple[float, float]]):
        super().__init__()
        self.table = table

    def __missing__(self, word: str) -> float:
        value, rest = self.table.get(0, (0.0, 0.0))
        value += rest
        known = False
        for begin, _, letter in steps(word):
            if (hit := self.table.get(begin)) is not None:
                known, value = True, hit[0] if letter == ord(END) else hit[0] + hit[1]
            elif known:  # what continues an unknown beginning is unknown too
                break
        value = max(value - MARGIN, 0.0) + min(value + MARGIN, 0.0)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = value
        return value


def features(text: str | None, evidence: Evidence) -> tuple[float, float]:
    """The evidence per word, and the same against the noise of a text of this length."""
    words = _WORD.findall(text.lower()) if text else []
    if not words:
        return 0.0, 0.0
    total = sum(map(evidence.__getitem__, words))
    return total / len(words), total / len(words) ** 0.5


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: list[Counter] = [Counter(), Counter()]

    def flush():
        words = list(counts[0].keys() | counts[1].keys())
        out = pa.record_batch([pa.array(words, pa.string()), pa.array([counts[0][w] for w in words], pa.int64()),
                               pa.array([counts[1][w] for w in words], pa.int64())], names=["word", "ordinary", "toxic"])
        counts[0].clear()
        counts[1].clear()
        return out

    for batch in batches:
        for text, label in zip(each_text(strings(batch.column(0))), batch.column(1).to_pylist()):
            counts[label].update(_WORD.findall(text.lower()))
            if len(counts[0]) + len(counts[1]) > 400_000:
                yield flush()
    yield flush()


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["begin", "above", "letter", "size", "ordinary", "toxic"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    rows: list[tuple] = []

    def flush():
        out = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        rows.clear()
        return out

    for batch in batches:
        counts = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
        for word, (ordinary, toxic) in zip(each_text(strings(batch.column(0))), counts):
            for size, (begin, above, letter) in enumerate(steps(word), 1):
                rows.append((begin, above, letter, size, ordinary, toxic))
                if len(rows) >= 20_000:
                    yield flush()
    if rows:
        yield flush()


def beginnings(rows: DataFrame) -> DataFrame:
    """A ``Node`` for each beginning: how often a word of each class begins so; ``rows``: text, label."""
    words = rows.select("text", "label").mapInArrow(_count_words, "word string, ordinary long, toxic long")
    whole = words.groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    spelled = whole.mapInArrow(_spell, "begin long, above long, letter int, size int, ordinary long, toxic long")
    return spelled.groupBy("begin").agg(
        F.min("above").alias("above"), F.min("letter").alias("letter"), F.min("size").alias("size"),
        F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")).filter(
        F.col("ordinary") + F.col("toxic") >= LEAST_COUNT)


def kneser_ney(nodes: list[Node]) -> dict[int, tuple[float, float]]:
    """begin -> (difference so far, difference of an unseen next letter); the numbers of shorter beginnings come first."""
    nodes = sorted(nodes, key=lambda n: n.size)
    count = {n.begin: (n.ordinary, n.toxic) for n in nodes}
    count[0] = (sum(n.ordinary for n in nodes if n.size == 1), sum(n.toxic for n in nodes if n.size == 1))
    kinds: dict[int, list[int]] = {b: [0, 0, 0] for b in count}
    continuation: Counter = Counter()
    # A beginning is counted at least as often as what continues it, so the one above is always there.
    for n in nodes:
        k = kinds[n.above]
        k[0] += n.ordinary > 0
        k[1] += n.toxic > 0
        k[2] += 1
        continuation[n.letter] += 1
    letters = sum(continuation.values()) + 1

    def unseen(begin: int) -> float:
        own = count[begin]
        rest = [DISCOUNT * max(kinds[begin][c], 1) / own[c] if own[c] else 1.0 for c in (0, 1)]
        return float(np.log(min(rest[1], 1.0) / min(rest[0], 1.0)))

    table = {0: (0.0, unseen(0))}
    for n in nodes:
        own, above, k = count[n.begin], count[n.above], kinds[n.above]
        shared = (max(sum(own) - DISCOUNT, 0) + DISCOUNT * k[2] * (continuation[n.letter] + 1) / letters) / sum(above)
        p = [(max(own[c] - DISCOUNT, 0) + DISCOUNT * max(k[c], 1) * shared) / above[c] if above[c] else shared
             for c in (0, 1)]
        table[n.begin] = (table[n.above][0] + float(np.log(p[1] / p[0])),
                          0.0 if n.letter == ord(END) else unseen(n.begin))
    return table


def telling(table: dict[int, tuple[float, float]], nodes: list[Node]) -> dict[int, tuple[float, float]]:
    """The beginnings that decide a word's evidence: those beyond the margin, and all that continue one of them.

    A word whose known beginnings are all within the margin has no evidence, with or without them in the table.
    """
    kept: dict[int, tuple[float, float]] = {}
    for b, above in [(0, None), *((n.begin, n.above) for n in sorted(nodes, key=lambda n: n.size))]:
        so_far, rest = table[b]
        if abs(so_far) > MARGIN or abs(so_far + rest) > MARGIN or above in kept:
            kept[b] = (so_far, rest)
    return kept


def fit(labelled: DataFrame, id_col: str = "doc_id") -> tuple[dict[int, tuple[float, float]], np.ndarray]:
    """The table of beginnings and the calibration, from rows with columns ``id_col``, text and label (0 or 1)."""
    rows = saved(labelled.filter("text IS NOT NULL AND label IN (0, 1)").select(
        F.col("text"), F.col("label").cast("int").alias("label"),
        (F.pmod(F.xxhash64(F.col(id_col), F.lit(5)), F.lit(CALIBRATE_ONE_IN)) == 0).alias("calibrate")), "toxic-fit")
    counted = beginnings(rows.filter("NOT calibrate")).toArrow()
    nodes = [Node(*row) for row in zip(*(counted[c].to_pylist() for c in Node._fields))]
    table = telling(kneser_ney(nodes), nodes)
    held = rows.sparkSession.sparkContext.broadcast(table)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Evidence(held.value)
        for batch in batches:
            got = np.array([features(t, evidence) for t in each_text(strings(batch.column(0)))]).reshape(-1, 2)
            yield pa.record_batch([pa.array(got[:, 0]), pa.array(got[:, 1]), batch.column(1)],
                                  names=["mean", "noise", "label"])

    seen = rows.filter("calibrate").select("text", "label").mapInArrow(
        measure, "mean double, noise double, label int").toPandas()
    weights = logistic_fit(np.column_stack([seen["mean"], seen["noise"]]), seen["label"].to_numpy())
    return table, weights


def sampled_labels(docs: DataFrame, labels: DataFrame, label: str, rows: int, chars: int, modulus: int, out: int,
                   id_col: str = "doc_id") -> DataFrame:
    """id, text, label of a bounded sample of the labelled documents whose id's remainder is not ``out``.

    About ``rows`` rows in all: a rare label's are all taken, the others share what is left evenly. Each label's texts
    have about ``chars`` over the number of labels at most. The sampled labels are broadcast, so the documents are read
    once and not shuffled.
    """
    known = (labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & (id_remainder(id_col, modulus) != out))
             .groupBy(F.col(id_col)).agg(F.max(label).cast("int").alias("label")))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    few = sample_by_label(known, id_col, "label", filled(counts, rows))
    found = docs.filter(F.col("text").isNotNull()).select(id_col, "text").join(F.broadcast(few), id_col)
    sizes = {r["label"]: r["n"] for r in found.groupBy("label").agg(F.sum(F.length("text")).alias("n")).collect()}
    each = chars / max(len(sizes), 1)
    return sample_by_label(found, id_col, "label", {k: min(1.0, each / n) if n else 1.0 for k, n in sizes.items()}, 29)


def score(docs: DataFrame, model: tuple[dict[int, tuple[float, float]], np.ndarray], column: str = "score",
          text_col: str = "text") -> DataFrame:
    """``docs`` with one more double column; a column of that name is replaced."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(column)
    at = docs.columns.index(text_col)
    schema = docs.withColumn(column, F.lit(0.5).cast("double")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, weights = held.value
        evidence = Evidence(table)
        for batch in batches:
            got = np.array([features(t, evidence) for t in each_text(strings(batch.column(at)))]).reshape(-1, 2)
            yield batch.append_column(column, pa.array(logistic(got, weights)))

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    model = fit(sampled_labels(docs, labels, "toxic", FIT_ROWS, FIT_CHARS, 3, 1))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with the columns of ``docs``."""
    model = fit(sampled_labels(docs, labels, "toxic", FIT_ROWS, FIT_CHARS, 3, 1))
    mark = "__toxicity"
    return score(docs, model, mark).filter(F.col(mark) < threshold).drop(mark)
