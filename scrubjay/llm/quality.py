"""Quality by compression: how much better a text compresses with a dictionary of good texts than with one of bad.

Two zstandard dictionaries are trained on pieces of good and of bad labelled texts. A text is compressed piece by piece
(so a long text profits from a dictionary in every piece, and every byte is read) once with each; the difference of the
two compressed sizes over the text's size is its evidence. A logistic curve fitted on labelled texts kept out of the
dictionaries turns it into a score from 0 to 1; a second term lets the curve depend on the text's length.

Fitting uses a bounded, hashed sample (``FIT_ROWS`` labelled rows, and ``FIT_CHARS`` characters of which each class has
half at most, expected values), drawn by label; the dictionaries are trained on all texts of it that do not calibrate.

Defined results: null and empty texts have evidence 0 and the score that belongs to it; a null id is never held out and
never trains; a class with too little text for a dictionary gives a constant score; an empty table an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import each_text, id_remainder, logistic, logistic_fit, saved, strings
from .toxicity import sampled_labels

FIT_ROWS = 12_000
FIT_CHARS = 36_000_000
CALIBRATE_ONE_IN = 3
PIECE = 2048
DICTIONARY_BYTES = 96 * 1024
LEVEL = 3


def pieces(text: str) -> list[bytes]:
    raw = text.encode("utf-8", "replace")
    return [raw[i:i + PIECE] for i in range(0, len(raw), PIECE)]


def train(texts: list[str]) -> bytes:
    """A dictionary of the texts' pieces; empty if there are too few."""
    parts = [part for text in texts for part in pieces(text)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, parts, level=LEVEL, k=200, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


class Compressors:
    """The two compressors of a fitted pair of dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self.pair = []
        for raw in (good, bad):
            known = zstandard.ZstdCompressionDict(raw) if raw else None
            if known:
                known.precompute_compress(level=LEVEL)
            self.pair.append(zstandard.ZstdCompressor(dict_data=known, write_checksum=False, write_content_size=False,
                                                      write_dict_id=False) if known
                             else zstandard.ZstdCompressor(level=LEVEL))
        self.usable = bool(good and bad)

    def features(self, text: str | None) -> tuple[float, float]:
        """The normalised size difference (bad less good), and the same scaled by the text's length."""
        if not text or not self.usable:
            return 0.0, 0.0
        good, bad = self.pair
        parts = pieces(text)
        size = sum(map(len, parts))
        gain = sum(len(bad.compress(p)) - len(good.compress(p)) for p in parts) / size
        return gain, gain * min(float(np.log2(1 + size)), 20.0)


def fit(labelled: DataFrame, id_col: str = "doc_id") -> tuple[bytes, bytes, np.ndarray]:
    """Both dictionaries and the calibration, from rows with columns ``id_col``, text and label (0 or 1)."""
    rows = saved(labelled.filter("text != '' AND label IN (0, 1)").select(
        F.col("text"), F.col("label").cast("int").alias("label"), F.xxhash64(F.col(id_col), F.lit(7)).alias("h"),
        (F.pmod(F.xxhash64(F.col(id_col), F.lit(5)), F.lit(CALIBRATE_ONE_IN)) == 0).alias("calibrate")), "quality-fit")
    teach = rows.filter("NOT calibrate").select("text", "label", "h").toArrow().sort_by("h")
    marks = np.asarray(teach["label"])
    texts = np.array(teach["text"].to_pylist(), dtype=object)
    good, bad = train(texts[marks == 1].tolist()), train(texts[marks == 0].tolist())

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Compressors(good, bad)
        for batch in batches:
            got = np.array([tool.features(t) for t in each_text(strings(batch.column(0)))]).reshape(-1, 2)
            yield pa.record_batch([pa.array(got[:, 0]), pa.array(got[:, 1]), batch.column(1)],
                                  names=["gain", "scaled", "label"])

    seen = rows.filter("calibrate").select("text", "label").mapInArrow(
        measure, "gain double, scaled double, label int").toPandas()
    return good, bad, logistic_fit(np.column_stack([seen["gain"], seen["scaled"]]), seen["label"].to_numpy())


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    good, bad, weights = fit(sampled_labels(docs, labels, "quality", FIT_ROWS, FIT_CHARS, 3, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Compressors(good, bad)
        for batch in batches:
            got = np.array([tool.features(t) for t in each_text(strings(batch.column(1)))]).reshape(-1, 2)
            yield pa.record_batch([batch.column(0), pa.array(logistic(got, weights))], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
