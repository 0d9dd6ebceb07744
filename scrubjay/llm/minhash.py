"""MinHash near-duplicates by fast similarity sketching, banding and exact verification.

Each text becomes its set of distinct five-word shingles. A sketch of ``T`` coordinates is filled in rounds:
in round i every shingle is thrown into one hashed bin with a hashed value, and a bin keeps the least value of the
first round that reaches it; rounds T..2T-1 put every shingle into the one bin of that round, so each coordinate
is filled and the share of equal coordinates concentrates about the Jaccard similarity. Bands of the sketch give
candidate buckets; every link is then confirmed on the full shingle sets.

How pairs stay few and none is lost:

* Texts with equal shingle sets collapse to one representative (a map-side combined aggregate), so thousands of copies
  cost one row.
* In each bucket all members are first compared with one hub (a star: members - 1 pairs). Confirmed links merge
  classes.
* Buckets of three or more that still hold several classes stay open. Each member outside the bucket's largest class is
  compared with every member of another class; the shingle sets of open buckets travel to blocks of bounded size
  (``BLOCK_ROWS`` rows, ``BLOCK_SHINGLES`` shingles, expected), where the most similar pairs are tried first and a pair
  whose classes have met meanwhile is skipped. Only links that join classes leave a block. So the classes are those of
  all links, nothing is capped, and no bucket meets in one task.

A candidate is dropped before the full check only if its sketch agreement is ``SIGMAS`` standard deviations below the
threshold. With 32 bands of 4 rows a link of similarity 0.75 misses every band with probability 5e-6.

Defined results: a text that is null, empty or without words has an empty set, links with nothing and is kept; fewer
than five words make one shingle of them all; rows with a null id take no part in linking, get a null component and
are kept; rows that share an id but not a text are linked each by its own text; repeated rows of one id share its
component, and one of them stays; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubjay.session import cut_lineage_observed

from .common import saved, slices, strings
from .textarrays import mix, shingle_sets

T = 256
BANDS, ROWS = 32, 4
#: A link: 100 * intersection >= LINK * union.
LINK = 75
SIGMAS = 4.5
BLOCK_ROWS, BLOCK_SHINGLES = 2048, 1_000_000
#: Ids of a join's small side that may be broadcast (16 MB); more are shuffled.
BROADCAST_IDS = 1_000_000


def least_agreement(t: int = T) -> int:
    """Sketch coordinates that a pair must share to be looked at in full."""
    j = LINK / 100
    return math.floor(t * (j - SIGMAS * math.sqrt(j * (1 - j) / t)))


def fast_sketch(sets: list[np.ndarray], t: int = T) -> np.ndarray:
    """One row of ``t`` coordinates for each set; an empty set gives a row of zeros."""
    n = len(sets)
    out = np.zeros((n, t), np.uint64)
    sizes = np.array([len(s) for s in sets], np.int64)
    live = np.flatnonzero(sizes)
    if not len(live):
        return out
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    full = np.full((n, t), none, np.uint64)
    items = np.concatenate([sets[i] for i in live])
    owner = np.repeat(live, sizes[live])
    for i in range(2 * t):
        h = mix(items + np.uint64(((i + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
        bins = (h % np.uint64(t)).astype(np.int64) if i < t else np.full(len(h), i - t, np.int64)
        spot = owner * t + bins
        flat = full.reshape(-1)
        open_ = flat[spot] == none
        if open_.any():
            spot, h = spot[open_], h[open_] >> np.uint64(1)
            order = np.argsort(h, kind="stable")[::-1]
            flat[spot[order]] = h[order]  # the least value is written last
        if i % 4 == 3 or i >= t:
            done = (full != none).all(axis=1)
            if done[live].all():
                break
            keep = ~done[owner]
            items, owner = items[keep], owner[keep]
            live = live[~done[live]]
    out[sizes > 0] = full[sizes > 0]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """BANDS keys for each sketch, the band's number mixed in."""
    part = sketch[:, :BANDS * ROWS].reshape(len(sketch), BANDS, ROWS)
    key = np.repeat(np.arange(1, BANDS + 1, dtype=np.uint64)[None], len(sketch), axis=0)
    for r in range(ROWS):
        key = mix(key * np.uint64(0xA0761D6478BD642F) + part[:, :, r])
    return key.view(np.int64)


_SKETCHED = "id long, mark long, n_shingles long, s1 long, s2 long, sketch binary, bands array<long>"


def set_digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that name a shingle set."""
    with np.errstate(over="ignore"):
        s1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
        s2 = np.array([mix(s + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64)
    return s1, s2.view(np.int64)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, marks, texts = batch.column(0), batch.column(1), strings(batch.column(2))
        for start, stop in slices(texts):
            sets = list(shingle_sets(texts.slice(start, stop - start)))
            s1, s2 = set_digests(sets)
            sketch = fast_sketch(sets)
            keys = band_keys(sketch)
            low = (sketch & np.uint64(255)).astype(np.uint8)
            n = stop - start
            yield pa.record_batch([
                ids.slice(start, n), marks.slice(start, n), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(s1), pa.array(s2),
                pa.array([row.tobytes() for row in low], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(keys.reshape(-1))),
            ], names=["id", "mark", "n_shingles", "s1", "s2", "sketch", "bands"])


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, a mark of the text, n_shingles, a 128-bit digest of the set (s1, s2), each coordinate's low byte, band keys."""
    return docs.select(F.col(id_col).cast("long").alias("id"), text_mark(text_col).alias("mark"),
                       F.col(text_col).cast("string").alias("text")).mapInArrow(_sketch_batches, _SKETCHED)


def text_mark(text_col: str):
    """Tells the texts of one id apart."""
    return F.xxhash64(F.col(text_col).cast("string"))


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps pairs (a, b, sketch_a, sketch_b) whose sketches agree enough."""
    least = least_agreement()
    for batch in batches:
        if not batch.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, T) for i in (2, 3))
        keep = pa.array((x == y).sum(axis=1) >= least)
        yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = strings(batch.column(1))
        for start, stop in slices(texts):
            sets = list(shingle_sets(texts.slice(start, stop - start)))
            s1, s2 = set_digests(sets)
            yield pa.record_batch([batch.column(0).slice(start, stop - start), pa.array(s1), pa.array(s2),
                                   pa.array([x.tobytes() for x in sets], pa.binary())], names=["doc", "s1", "s2", "shingles"])


def unpacked(column: pa.Array | pa.ChunkedArray, i: int) -> np.ndarray:
    return np.frombuffer(column[i].as_buffer(), np.uint64)


def links(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two full shingle sets link."""
    if 100 * min(len(a), len(b)) < LINK * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= LINK * (len(a) + len(b) - both) > 0


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keeps pairs (a, b, shingles_a, shingles_b) that link on their full sets."""
    for batch in batches:
        keep = pa.array([links(unpacked(batch.column(2), i), unpacked(batch.column(3), i))
                         for i in range(batch.num_rows)], pa.bool_())
        yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def _join_classes(group: pa.Table) -> pa.Table:
    """Of one block of an open bucket: links between asking rows and rows of other classes that join classes."""
    least = least_agreement()
    asks = np.asarray(group["asks"])
    ids, label = np.asarray(group["id"]), np.asarray(group["label"])
    marks = np.frombuffer(b"".join(group["sketch"].to_pylist()), np.uint8).reshape(-1, T)
    shingles_ = group["shingles"].combine_chunks()
    q, m = np.flatnonzero(asks), np.flatnonzero(~asks)
    a, b = [], []
    for i in q[np.argsort(ids[q])].tolist():
        others = m[label[m] != label[i]]
        same = (marks[others] == marks[i]).sum(axis=1)
        good = np.flatnonzero(same >= least)
        own = unpacked(shingles_, i)
        for j in others[good[np.lexsort((ids[others[good]], -same[good]))]].tolist():
            if label[j] != label[i] and links(own, unpacked(shingles_, j)):
                a.append(ids[i])
                b.append(ids[j])
                label = np.where(label == label[i], label[j], label)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def connected(edges: DataFrame, name: str = "classes") -> DataFrame:
    """(id, label): the least id reachable over ``edges`` (a, b), for every id in an edge.

    Each round takes the least label of a node and its neighbours and then the label of that label (pointer jumping);
    rounds grow with the logarithm of the longest chain in practice. Each round is written to shared storage, and the
    number of changed labels is observed on the way.
    """
    both = saved(edges.select(F.inline(F.array(*(F.struct(F.col(u).alias("u"), F.col(v).alias("v")) for u, v in (
        ("a", "b"), ("b", "a"), ("a", "a"), ("b", "b")))))), f"{name}-edges")
    labels = saved(both.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("label")), name)
    while True:
        known = labels.select(F.col("id").alias("v"), "label")
        low = both.join(known, "v").groupBy(F.col("u").alias("id")).agg(
            F.min("label").alias("low"), F.max(F.when(F.col("u") == F.col("v"), F.col("label"))).alias("was"))
        jump = known.select(F.col("v").alias("low"), F.col("label").alias("next"))
        step = low.join(jump, "low").select("id", F.least("low", "next").alias("label"), "was")
        new, seen = cut_lineage_observed(step, {"changed": F.count_if(F.col("label") != F.col("was"))}, name)
        labels = new.select("id", "label")
        if not seen["changed"]:
            return labels


def few(ids: DataFrame) -> DataFrame:
    """``ids`` marked for broadcast if they are proven to be at most BROADCAST_IDS."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def link_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, mark, n_shingles, component_id, alone (takes no part in linking) for each row of ``docs``."""
    rows = saved(sketches(docs, id_col, text_col), "sketches")
    alone = F.col("id").isNull() | (F.col("n_shingles") == 0)
    # From here to the last join an id is that of a distinct set, whatever the ids of the documents that hold it.
    reps = saved(rows.filter(~alone).groupBy("s1", "s2", "n_shingles").agg(
        F.min("id").alias("doc"), F.first("sketch").alias("sketch"), F.first("bands").alias("bands")).withColumn(
        "id", F.monotonically_increasing_id()), "sets")
    keyed = reps.select("id", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("id").alias("hub"), F.count("*").alias("members")).filter("members > 1")
    member = saved(keyed.join(buckets, "key"), "buckets")
    in_bucket = saved(member.select("id").distinct(), "members")
    wanted = saved(reps.select("id", "doc", "s1", "s2").join(in_bucket, "id", "left_semi"), "wanted")
    full = saved(docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
                 .filter("text IS NOT NULL").join(few(wanted.select("doc").distinct()), "doc", "left_semi")
                 .mapInArrow(_set_batches, "doc long, s1 long, s2 long, shingles binary")
                 .join(few(wanted), ["doc", "s1", "s2"]).select("id", "shingles").dropDuplicates(["id"]), "shingles")

    marks = reps.select("id", "sketch")
    star = member.filter("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    near = (star.join(marks.select(F.col("id").alias("a"), F.col("sketch").alias("sa")), "a")
            .join(marks.select(F.col("id").alias("b"), F.col("sketch").alias("sb")), "b")
            .select("a", "b", "sa", "sb").mapInArrow(_agree, "a long, b long"))
    sure = saved(near.join(full.select(F.col("id").alias("b"), F.col("shingles").alias("tb")), "b")
                 .join(full.select(F.col("id").alias("a"), F.col("shingles").alias("ta")), "a")
                 .select("a", "b", "ta", "tb").mapInArrow(_confirm, "a long, b long"), "links")
    labels = connected(sure)

    # Buckets of two are settled by the star.
    sized = member.filter("members > 2").join(reps.select("id", "n_shingles"), "id")
    known = saved(sized.join(labels, "id", "left").select("key", "id", "n_shingles",
                                                          F.coalesce("label", "id").alias("label")), "labelled")
    per = known.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("size"))
    top = per.groupBy("key").agg(F.count("*").alias("classes"), F.sum("n").alias("n"), F.sum("size").alias("size"),
                                 F.max(F.struct("n", "size", "label")).alias("most")).filter("classes > 1")
    blocks = lambda n, size: F.ceil(F.greatest(n / BLOCK_ROWS, size / BLOCK_SHINGLES)).cast("int")
    top = top.select("key", F.col("most")["label"].alias("main"), blocks(F.col("n"), F.col("size")).alias("rb"),
                     blocks(F.col("n") - F.col("most")["n"], F.col("size") - F.col("most")["size"]).alias("qb"))
    open_ = known.join(top, "key")
    place = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), n).cast("int")
    asks = open_.filter("label != main").select(
        "key", place(F.col("qb"), 1).alias("q"), F.explode(F.sequence(F.lit(0), F.col("rb") - 1)).alias("r"),
        F.lit(True).alias("asks"), "id", "label")
    rest = open_.select(
        "key", F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("q"), place(F.col("rb"), 2).alias("r"),
        F.lit(False).alias("asks"), "id", "label")
    dealt = asks.unionAll(rest).join(marks, "id").join(full, "id")
    more = saved(dealt.groupBy("key", "q", "r").applyInArrow(_join_classes, "a long, b long").distinct(), "more-links")
    to_label = labels.withColumnRenamed("id", "i")
    met = (more.join(to_label.select(F.col("i").alias("a"), F.col("label").alias("la")), "a", "left")
           .join(to_label.select(F.col("i").alias("b"), F.col("label").alias("lb")), "b", "left")
           .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).distinct())
    merged = connected(met, "merged").select(F.col("id").alias("label"), F.col("label").alias("to"))
    named = saved(reps.select("s1", "s2", "n_shingles", "id", "doc").join(labels, "id", "left").withColumn(
        "label", F.coalesce("label", "id")).join(merged, "label", "left").select(
        "s1", "s2", "n_shingles", "doc", F.coalesce("to", "label").alias("label")), "named")
    # A class of one set has its own least id; only the others are grouped.
    least = named.groupBy("label").agg(F.min("doc").alias("least"), F.count("*").alias("sets")).filter("sets > 1")
    found = named.join(least.select("label", "least"), "label", "left").select(
        "s1", "s2", "n_shingles", F.coalesce("least", "doc").alias("component_id"))
    linked = rows.filter(~alone).select("id", "mark", "n_shingles", "s1", "s2").join(found, ["s1", "s2", "n_shingles"])
    return linked.select("id", "mark", "n_shingles", "component_id", F.lit(False).alias("alone")).unionAll(
        rows.filter(alone).select("id", "mark", "n_shingles", F.col("id").alias("component_id"), F.lit(True).alias("alone")))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (least id of the class), kept (the id is its class's least, or null)."""
    out = link_classes(docs, id_col, text_col)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one row of each class. Columns are those of ``docs``.

    Rows are told apart by id and text. Where several rows of a class share its least id, those of one text stay, and of equal
    rows one.
    """
    decided = saved(link_classes(docs, id_col, text_col), "decided").withColumn(
        "heads", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
    heads = decided.filter("heads AND NOT alone").groupBy("id", "mark").agg(F.count("*").alias("rows"))
    crowded = heads.groupBy("id").agg(F.min("mark").alias("stays"), F.sum("rows").alias("rows")).filter("rows > 1")
    several = saved(heads.join(crowded.select("id", "stays"), "id"), "crowded-classes")
    gone = saved(decided.filter("NOT heads").select("id", "mark").unionAll(
        several.filter("mark <> stays").select("id", "mark")).distinct().toDF("__gone", "__mark"), "copies")
    same = (F.col(id_col).cast("long") == F.col("__gone")) & (text_mark(text_col) == F.col("__mark"))
    kept = docs.join(few(gone), same, "left_anti")
    again = saved(several.filter("mark = stays AND rows > 1").select("id", "mark").toDF("__gone", "__mark"), "repeated")
    if not again.count():
        return kept.select(*docs.columns)
    one = kept.join(few(again), same, "left_semi").withColumn("__mark", text_mark(text_col)).dropDuplicates(
        [id_col, "__mark"]).select(*docs.columns)
    return kept.join(few(again), same, "left_anti").select(*docs.columns).unionAll(one)
