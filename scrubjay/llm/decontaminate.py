"""Benchmark decontamination by spaced-seed hashing.

Texts are word sequences (runs of anything but ASCII signs and white space, ASCII and Latin-1 capitals lower-cased). A seed is a fixed mask over a window of words that
reads some positions and ignores the others, so a window still hashes alike when a word at an ignored position was
replaced. Every window of every benchmark item is hashed with every mask; a document's windows that hash alike are
hits. Each hit names an item and an alignment (the document position less the item position); around it the document
and the item are compared word by word and the best-scoring stretch (+1 for an equal word, ``-MISS`` for a substituted
one) is the overlap. It counts if at least ``LEAST_SHARE`` of its words are equal and these are at least
``LEAST_WORDS`` words or that share of a shorter item; the whole item counts, too, if that share of all its words is
equal. Items of fewer than ``LONG`` words are also hashed with ``SHORT_MASKS``, one of which reads only equal words
wherever a fifth of the words was replaced.

The benchmark is indexed in blocks of at most ``BLOCK_CHARS`` characters (a hash gives an item's block); each block's
index is broadcast, being of that proven size, and all documents are read against it, so any benchmark size works and
documents are never shuffled. Within a task numpy compares the hashes of whole batches.

Defined results: null, empty and wordless documents and items give no row; an item of fewer than ``TOLERANT`` words
is compared as one exact run if it has at least ``shortest`` words (``SHORTEST`` if not given), else it is too short to
be evidence; one row for each (document, item), the longest overlap, the first on ties; repeated items give rows of their
own ids; null ids are carried; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, strings, text_buffers
from .textarrays import SIGNS, mix, word_hashes

#: Fixed masks over windows of nine to eleven words: 1 is read, 0 ignored.
MASKS = ("110110111", "1110100111", "11010011101", "1011110011")
LEAST_WORDS = 12
LEAST_SHARE = 0.8
#: What a substituted word takes off a stretch's score.
MISS = 1.5
#: Together these find every item of 8 to 19 words of which at most a fifth was replaced (tested for every choice of words).
SHORT_MASKS = ("111011", "11001011", "11111")
LONG = 30
#: Items of fewer words than TOLERANT must be equal as a whole. Those of fewer than SHORTEST are by default no evidence:
#: runs of one to three words stand in unrelated texts, those of four on hardly more often than longer ones (README).
TOLERANT = 8
SHORTEST = 4
BLOCK_CHARS = 8_000_000

_BITS = 20


def coded_words(column: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and each text's offsets into them."""
    return word_hashes(*text_buffers(column), SIGNS, latin=True)


class Index:
    """The masked window hashes of some items, given as (id, text)."""

    def __init__(self, items: list[tuple[int | str | None, str]], shortest: int = SHORTEST):
        found, at = coded_words(pa.array([t for _, t in items], pa.string()))
        sizes = np.diff(at)
        kept = np.flatnonzero(sizes >= max(shortest, 1)).tolist()
        self.ids = [items[i][0] for i in kept]
        self.vocabulary = np.unique(found)
        self.word_bits = np.zeros(1 << _BITS, bool)
        self.word_bits[self._low(self.vocabulary)] = True
        self.codes = [self.code(found[at[i]:at[i + 1]]) for i in kept]
        self.least = [len(c) if len(c) < TOLERANT else math.ceil(round(LEAST_SHARE * len(c), 6)) for c in self.codes]
        lengths = {len(c) for c in self.codes}
        # Each mask with the lengths of the items that it reads.
        used = [(m, max(TOLERANT, len(m)), math.inf) for m in MASKS]
        used += [(m, TOLERANT, LONG - 1) for m in SHORT_MASKS]
        used += [("1" * n, n, n) for n in sorted(lengths) if n < TOLERANT]
        used = [(m, low, high) for m, low, high in used if any(low <= n <= high for n in lengths)]
        self.masks = [np.flatnonzero(np.array(list(m)) == "1") for m, _, _ in used]
        self.spans = [len(m) for m, _, _ in used]
        self.table: dict[int, list[tuple[int, int]]] = {}
        self.hash_bits = np.zeros(1 << _BITS, bool)
        for item, codes in enumerate(self.codes):
            for m, (_, low, high) in enumerate(used):
                if not low <= len(codes) <= high:
                    continue
                found = self.hashes(codes, np.arange(len(codes) - self.spans[m] + 1), m)
                self.hash_bits[self._low(found)] = True
                for place, h in enumerate(found.tolist()):
                    self.table.setdefault(h, []).append((item, place))

    @staticmethod
    def _low(h: np.ndarray) -> np.ndarray:
        return (h & np.uint64((1 << _BITS) - 1)).astype(np.int64)

    def code(self, found: np.ndarray) -> np.ndarray:
        """A number for each word: from 1 for words of the items, 0 for all others."""
        out = np.zeros(len(found), np.uint64)
        maybe = np.flatnonzero(self.word_bits[self._low(found)])
        if len(maybe):
            spot = np.minimum(np.searchsorted(self.vocabulary, found[maybe]), len(self.vocabulary) - 1)
            out[maybe] = np.where(self.vocabulary[spot] == found[maybe], spot + 1, 0)
        return out

    def hashes(self, codes: np.ndarray, windows: np.ndarray, m: int) -> np.ndarray:
        total = np.full(len(windows), m + 1, np.uint64)
        for place in self.masks[m].tolist():
            total = total * np.uint64(0x9E3779B97F4A7C15) + codes[windows + place]
        return mix(total)

    def hits(self, codes: np.ndarray, owner: np.ndarray) -> set[tuple[int, int, int]]:
        """(text, item, alignment) of all windows within one text that hash like one of an item.

        ``codes`` holds many texts one after another, ``owner`` the text of each word; alignments count from its start.
        """
        out: set[tuple[int, int, int]] = set()
        known = codes > 0
        for m, span in enumerate(self.spans):
            n = len(codes) - span + 1
            if n <= 0:
                continue
            places = self.masks[m].tolist()
            live = known[places[0]:places[0] + n].copy()
            for place in places[1:]:
                live &= known[place:place + n]
            windows = np.flatnonzero(live)
            windows = windows[owner[windows] == owner[windows + span - 1]]
            found = self.hashes(codes, windows, m)
            maybe = self.hash_bits[self._low(found)]
            for i, h in zip(windows[maybe].tolist(), found[maybe].tolist()):
                for item, place in self.table.get(h, ()):
                    out.add((int(owner[i]), item, i - place))
        return out

    def overlap(self, codes: np.ndarray, item: int, shift: int) -> tuple[int, int, int, int] | None:
        """(equal words, item start, document start, length) of the best stretch on one alignment, if it counts."""
        own = self.codes[item]
        low, high = max(0, -shift), min(len(own), len(codes) - shift)
        same = own[low:high] == codes[low + shift:high + shift]
        gain = np.cumsum(np.where(same, 1.0, -MISS))
        before = np.concatenate([[0.0], gain[:-1]])
        end = int(np.argmax(gain - np.minimum.accumulate(before)))
        start = int(np.argmin(before[:end + 1]))
        equal, length = int(same[start:end + 1].sum()), end + 1 - start
        if equal < min(LEAST_WORDS, self.least[item]) or equal < LEAST_SHARE * length:
            # A replaced word near an end cuts the stretch short of an item that is there as a whole.
            spots = np.flatnonzero(same)
            if len(spots) < self.least[item]:
                return None
            start, end, equal = int(spots[0]), int(spots[-1]), len(spots)
            length = end + 1 - start
        return equal, low + start, low + start + shift, length

    def search(self, column: pa.StringArray) -> list[tuple[int, int, int, int, int, int]]:
        """(row, item, equal, item start, document start, length): each row's best overlap with each item, in order."""
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        if not self.ids:
            return []
        for first, stop in slices(column):
            found, at = coded_words(column.slice(first, stop - first))
            codes = self.code(found)
            owner = np.repeat(np.arange(stop - first), np.diff(at))
            for row, item, shift in sorted(self.hits(codes, owner)):
                got = self.overlap(codes[at[row]:at[row + 1]], item, shift - int(at[row]))
                if got and got[0] > best.get((first + row, item), (0,))[0]:
                    best[first + row, item] = got
        return [(*key, *best[key]) for key in sorted(best)]


def index_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", shortest: int = SHORTEST):
    """The items' indexes, one block of bounded size at a time."""
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter(
        "text IS NOT NULL")
    chars = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, math.ceil(chars / BLOCK_CHARS))
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("text", "id"), F.lit(blocks)) == b)
        yield Index([(r["id"], r["text"]) for r in part.orderBy("id", "text").toLocalIterator()], shortest)


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_id_col: str = "item_id", item_text_col: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """doc_id, item_id, matched_words, overlap_words, doc_start, item_start for each document and item that overlap."""
    spark = docs.sparkSession
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_id_col].dataType.simpleString()
    schema = (f"doc_id {kind}, item_id {item_kind}, matched_words int, overlap_words int, doc_start int, "
              "item_start int")
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for index in index_blocks(benchmark, item_id_col, item_text_col, shortest):
        held = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = held.value
            for batch in batches:
                rows, columns = [], [[] for _ in range(5)]
                for row, item, equal, item_at, doc_at, length in index.search(strings(batch.column(1))):
                    rows.append(row)
                    for c, v in zip(columns, (index.ids[item], equal, length, doc_at, item_at)):
                        c.append(v)
                yield pa.record_batch([batch.column(0).take(pa.array(rows, pa.int64())),
                                       pa.array(columns[0]).cast(item_type) if columns[0] else pa.array([], item_type),
                                       *(pa.array(c, pa.int32()) for c in columns[1:])],
                                      names=["doc_id", "item_id", "matched_words", "overlap_words", "doc_start",
                                             "item_start"])

        item_type = pa.int64() if item_kind in ("bigint", "long") else pa.string() if item_kind == "string" else pa.int32()
        part = narrow.mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      shortest: int = SHORTEST) -> DataFrame:
    """The rows of ``docs`` that overlap with no item, with the columns of ``docs``; rows are judged by their text."""
    spark = docs.sparkSession
    at, schema = docs.columns.index(text_col), docs.schema
    for index in index_blocks(benchmark, shortest=shortest):
        held = spark.sparkContext.broadcast(index)

        def clean(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[row for row, *_ in held.value.search(strings(batch.column(at)))]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, schema)
    return docs
