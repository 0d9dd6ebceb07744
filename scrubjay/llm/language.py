"""Language by word-first backoff.

A known word adds its log frequency in each language. An unknown word falls back to its character n-grams, the longest
first: the first length of which any n-gram is known decides, by the mean of their log frequencies. The language with
the largest sum wins; its share of the normalised likelihoods is the score.

The tables are counted on a bounded, hashed sample of documents with a language (``FIT_ROWS`` rows, ``FIT_CHARS``
characters, expected values), drawn by language, so a rare one is learned from all its documents however large the table
is; every word and n-gram seen there often enough is kept, as a sorted 64-bit hash. Prediction reads every text whole.

Defined results: a text that is null or has no letter is ``und`` with score 0, as is every text when no language was
learned; equal sums go to the language that sorts first; a null id trains nothing and is never held out; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import each_text, filled, id_remainder, sample_by_label, saved, strings
from .textarrays import mix

FIT_ROWS = 8_000
FIT_CHARS = 24_000_000
LONGEST = 5
LEAST_WORD, LEAST_GRAM = 3, 3
SMOOTH = 0.5
MEMO_WORDS = 150_000
#: Texts are labelled in groups of at most so many texts, or about so many characters.
GROUP_TEXTS, GROUP_CHARS = 64, 500_000

_WORD = re.compile(r"[^\W\d_]+")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush():
        keys = list(counts)
        out = pa.record_batch([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                               pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for text, lang in zip(each_text(strings(batch.column(0))), batch.column(1).to_pylist()):
            for word, n in Counter(_WORD.findall(text.lower())).items():
                counts[lang, word] += n
            if len(counts) > 400_000:
                yield flush()
    yield flush()


_BASE = np.uint64(0x9E3779B97F4A7C55)


def _points(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts (none empty), one after another, and where each starts."""
    texts = list(texts)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return (np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64),
            np.cumsum(sizes) - sizes)


def _window_hashes(points: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` code points in a row."""
    total = np.full(max(len(points) - n + 1, 0), n, np.uint64)
    for k in range(n):
        total = total * _BASE + points[k:k + len(total)]
    return mix(total)


def _word_hashes(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each whole text."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = np.diff(np.append(starts, len(points)))
    powers = np.full(int(sizes.max()), _BASE, np.uint64)
    powers = np.multiply.accumulate(powers)
    place = np.arange(len(points)) - np.repeat(starts, sizes)
    return mix(np.add.reduceat((points + np.uint64(1)) * powers[place], starts))


def entry_hashes(size: int, entries: list[str]) -> np.ndarray:
    """The hashes of words (size 0) or of n-grams of one size."""
    points, starts = _points(entries)
    return _word_hashes(points, starts) if size == 0 else _window_hashes(points, size)[starts]


class Entries(NamedTuple):
    """Hashes of words or n-grams of one size, and their counts in each language."""

    hashes: np.ndarray
    counts: np.ndarray


class Tables:
    """Log frequencies of words (size 0) and of n-grams of each size: sorted hashes, and a matrix row for each.

    ``counts`` holds for each size the ``Entries``, or the counts by entry.
    """

    def __init__(self, langs: list[str], counts: dict[int, Entries | dict[str, np.ndarray]],
                 totals: dict[int, np.ndarray]):
        self.langs = langs
        self.keys: dict[int, np.ndarray] = {}
        self.matrix: dict[int, np.ndarray] = {}
        for n, entries in counts.items():
            if isinstance(entries, dict):
                entries = Entries(entry_hashes(n, list(entries)) if entries else np.zeros(0, np.uint64),
                                  np.array(list(entries.values())).reshape(-1, len(langs)))
            order = np.argsort(entries.hashes)
            self.keys[n] = entries.hashes[order]
            size = totals[n] + SMOOTH * (len(order) + 1)
            self.matrix[n] = np.log((entries.counts[order] + SMOOTH) / size).astype(np.float32)

    def rows(self, n: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the known ones among ``hashes``, and their matrix rows."""
        keys = self.keys[n]
        if not len(keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        spot = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        at = np.flatnonzero(keys[spot] == hashes)
        return at, spot[at]

    def evidence(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Whether anything of each word is known, and its evidence."""
        known, out = np.zeros(len(words), bool), np.zeros((len(words), len(self.langs)), np.float32)
        if not words:
            return known, out
        at, row = self.rows(0, entry_hashes(0, words))
        known[at], out[at] = True, self.matrix[0][row]
        rest = np.flatnonzero(~known)
        for n in range(LONGEST, 0, -1):
            if not len(rest):
                break
            points, starts = _points(f"<{words[i]}>" for i in rest.tolist())
            owner = np.repeat(np.arange(len(rest)), np.diff(np.append(starts, len(points))))
            windows = np.flatnonzero(owner[:max(len(points) - n + 1, 0)] == owner[n - 1:])
            at, row = self.rows(n, _window_hashes(points, n)[windows])
            whose = owner[windows[at]]
            found = np.bincount(whose, minlength=len(rest))
            for lang in range(len(self.langs)):
                total = np.bincount(whose, weights=self.matrix[n][row, lang], minlength=len(rest))
                out[rest[found > 0], lang] = total[found > 0] / found[found > 0]
            known[rest[found > 0]] = True
            rest = rest[found == 0]
        return known, out

    def word(self, word: str) -> np.ndarray | None:
        """The evidence of one word; None if nothing of it is known."""
        known, out = self.evidence([word])
        return out[0] if known[0] else None


class Memo(dict):
    """word -> row number in a growing matrix of evidence; row 0 is that of unknown words."""

    def __init__(self, tables: Tables):
        super().__init__()
        self.tables = tables
        self.matrix = np.zeros((1024, max(len(tables.langs), 1)), np.float32)
        self.used = 1

    def learn(self, words: set[str]) -> None:
        """Makes all of ``words`` known to the memo."""
        if len(self) > MEMO_WORDS:
            self.clear()
            self.used = 1
        new = [w for w in words if w not in self]
        known, found = self.tables.evidence(new)
        found = found[known]
        while self.used + len(found) > len(self.matrix):
            self.matrix = np.concatenate([self.matrix, np.zeros_like(self.matrix)])
        self.matrix[self.used:self.used + len(found)] = found
        self.update(zip(new, np.where(known, self.used + np.cumsum(known) - 1, 0).tolist()))
        self.used += len(found)

    def predict_all(self, texts: Iterable[str | None]) -> Iterator[tuple[str, float]]:
        """The language and score of each text in turn."""
        group: list[list[str]] = []
        size = 0
        for text in texts:
            group.append(_WORD.findall(text.lower()) if text else [])
            size += len(text or "")
            if len(group) >= GROUP_TEXTS or size > GROUP_CHARS:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, group: list[list[str]]) -> Iterator[tuple[str, float]]:
        if self.tables.langs:
            self.learn({w for words in group for w in words})
        for words in group:
            # A word may be made of number signs, which are no letters; the first letter ends this search.
            if not self.tables.langs or not any(c.isalpha() for w in words for c in w):
                yield "und", 0.0
                continue
            total = self.matrix[list(map(self.__getitem__, words))].sum(axis=0, dtype=np.float64)
            best = int(np.argmax(total))
            yield self.tables.langs[best], float(1 / np.exp(total - total[best]).sum())

    def predict(self, text: str | None) -> tuple[str, float]:
        return next(self.predict_all([text]))


#: Words of more letters are cut into n-grams by a Python slice: a substring of a long Spark string starts at its first byte.
LONG_WORD = 256


def _long_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, n, size, gram of long words (lang, word, n), equal n-grams of a word added up, one size at a time."""
    for batch in batches:
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            marked = f"<{word}>"
            for size in range(LONGEST + 1):
                grams = Counter(marked[i:i + size] for i in range(len(marked) - size + 1)) if size else Counter([word])
                names, counts = list(grams), np.fromiter(grams.values(), np.int64, len(grams)) * n
                for at in range(0, len(names), 50_000):
                    part = names[at:at + 50_000]
                    k = len(part)
                    yield pa.record_batch([pa.array([lang] * k, pa.string()), pa.array(counts[at:at + 50_000]),
                                           pa.array([size] * k, pa.int32()), pa.array(part, pa.string())],
                                          names=["lang", "n", "size", "gram"])


def fit(rows: DataFrame) -> Tables:
    """The tables of ``rows`` (text, lang)."""
    every = saved(rows.select("text", "lang").mapInArrow(_counted, "lang string, word string, n long")
                  .groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    words, long = every.filter(F.length("word") <= LONG_WORD), every.filter(F.length("word") > LONG_WORD)
    marked = F.concat(F.lit("<"), "word", F.lit(">"))

    def cuts(n: int):
        last = F.length(marked) - n + 1
        spots = F.when(last > 0, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(spots, lambda i: F.struct(F.lit(n).alias("size"), F.substring(marked, i, F.lit(n)).alias("gram")))

    whole = F.array(F.struct(F.lit(0).alias("size"), F.col("word").alias("gram")))
    spread = words.select("lang", "n", F.inline(F.concat(whole, *(cuts(n) for n in range(1, LONGEST + 1))))).unionAll(
        long.select("lang", "word", "n").mapInArrow(_long_grams, "lang string, n long, size int, gram string"))
    table = saved(spread.groupBy("size", "gram", "lang").agg(F.sum("n").alias("n")), "language-counts")
    sums = table.groupBy("size", "lang").agg(F.sum("n").alias("n")).collect()
    langs = sorted({r["lang"] for r in sums})
    spot = {lang: i for i, lang in enumerate(langs)}
    totals = {n: np.zeros(len(langs)) for n in range(LONGEST + 1)}
    for r in sums:
        totals[r["size"]][spot[r["lang"]]] = r["n"]
    kept = (table.groupBy("size", "gram").agg(F.sum("n").alias("all"), F.collect_list("lang").alias("langs"),
                                              F.collect_list("n").alias("ns"))
            .filter(F.col("all") >= F.when(F.col("size") == 0, LEAST_WORD).otherwise(LEAST_GRAM)).toArrow())
    parts: dict[int, list[Entries]] = {n: [] for n in range(LONGEST + 1)}
    for batch in kept.to_batches(max_chunksize=50_000):
        sizes = np.asarray(batch.column("size"))
        names, ns = (batch.column(c) for c in ("langs", "ns"))
        table_counts = np.zeros((batch.num_rows, len(langs)), np.int64)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(names.offsets)))
        table_counts[owner, [spot[x] for x in names.flatten().to_pylist()]] = np.asarray(ns.flatten())
        for n in np.unique(sizes).tolist():
            own = np.flatnonzero(sizes == n)
            parts[n].append(Entries(entry_hashes(n, batch.column("gram").take(pa.array(own)).to_pylist()), table_counts[own]))
    counts = {n: Entries(np.concatenate([np.zeros(0, np.uint64), *(e.hashes for e in found)]),
                         np.concatenate([np.zeros((0, len(langs)), np.int64), *(e.counts for e in found)]))
              for n, found in parts.items()}
    return Tables(langs, counts, totals)


def sampled(docs: DataFrame, modulus: int = 4, out: int = 2) -> DataFrame:
    """text and lang of a bounded sample of the documents that have a language and may be learned from.

    One grouped count of rows and characters decides each language's share: all of a rare language's documents.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                         & (id_remainder("doc_id", modulus) != out)).select("doc_id", "text", "lang")
    sizes = {r["lang"]: (r["rows"], r["chars"]) for r in usable.groupBy("lang").agg(
        F.count("*").alias("rows"), F.sum(F.length("text")).alias("chars")).collect()}
    rows = filled({lang: n for lang, (n, _) in sizes.items()}, FIT_ROWS)
    chars = filled({lang: rows[lang] * n for lang, (_, n) in sizes.items()}, FIT_CHARS)
    return sample_by_label(usable, "doc_id", "lang", {lang: rows[lang] * chars[lang] for lang in sizes})


def label(docs: DataFrame, tables: Tables, lang_col: str = "lang_pred", score_col: str = "score",
          text_col: str = "text") -> DataFrame:
    """``docs`` with the predicted language and its score; columns of those names are replaced."""
    held = docs.sparkSession.sparkContext.broadcast(tables)
    docs = docs.drop(lang_col, score_col)
    at = docs.columns.index(text_col)
    schema = docs.withColumns({lang_col: F.lit("und"), score_col: F.lit(0.5).cast("double")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(held.value)
        for batch in batches:
            got = list(memo.predict_all(each_text(strings(batch.column(at)))))
            yield (batch.append_column(lang_col, pa.array([g[0] for g in got], pa.string()))
                   .append_column(score_col, pa.array([g[1] for g in got], pa.float64())))

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    tables = fit(sampled(docs))
    return label(docs.select("doc_id", "text"), tables).select(
        "doc_id", F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def drop_unidentified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose language is found with a score of at least ``least``, with the columns of ``docs``."""
    lang, mark = "__lang_pred", "__lang_score"
    named = label(docs, fit(sampled(docs)), lang, mark)
    return named.filter((F.col(lang) != "und") & (F.col(mark) >= least)).drop(lang, mark)
