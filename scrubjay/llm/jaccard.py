"""N-gram Jaccard join with adaptive multi-match prefixes: documents link when their shingle sets are 90 % alike.

All shingles get one global order, seldom ones first. Of a set of ``n`` shingles any partner shares at least
``t = ceil(0.9 n)``; so of the first ``n - t + k`` shingles of both sets, at least ``k`` are shared. Each document chooses its own
``k``: a longer prefix costs more postings, but two documents are candidates only if their prefixes share as many
shingles as the smaller ``k`` of the two, so fewer pairs are verified. It takes the ``k`` of least estimated cost, postings plus
verification of the candidates that those frequencies allow. Any order and any choice give the same links; they only
set the work. Up to the end of the prefix that ends first both sets are known, so what they share there plus the shorter rest
bounds the overlap; pairs that cannot reach the threshold go before any full set is fetched.

Frequencies are counted over all documents in a table of ``CELLS`` hashed counters (4 MB whatever the input), summed
over the tasks; the order uses an eighth of their base-2 logarithm, then the shingle's own hash. Shingles that other documents share far
above the table's mean load go last; below it, the order is as good as any.

How pairs stay few and no link is lost:

* Equal sets collapse first (by a 128-bit digest, not by id), so copies cost one row.
* Postings of shingles that stand in one prefix only are dropped (an exact count).
* Each posting list is range-partitioned by (shingle, set), so a list of any length is many partitions. Members are
  compared along a tree of ``FAN`` children, one pair a member; pairs that meet in two lists are verified, and confirmed
  links merge classes. Near copies by the thousand so become few classes from a linear number of pairs.
* Lists that still hold several classes stay open. Up to ``SHORT`` members their pairs between classes are joined in SQL; longer ones are dealt to blocks
  of bounded size, which test pairs between classes and report only links that join classes. Both test every such pair.

Every candidate must pass the length bound and the multi-match count, then the full sets decide.

Defined results: a text that is null, empty or without words has an empty set and links with nothing; fewer than three
words make one shingle; rows with a null id take no part in linking and get a null component; rows that share an id but
not a text are documents of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, slices, strings
from .minhash import connected, few, unpacked
from .places import ordered
from .textarrays import mix, shingle_sets

WORDS = 3
#: A link: 100 * intersection >= LINK * union.
LINK = 90
#: Counters of the frequency table, in chunks that travel as one row each.
CELLS, CHUNK = 1 << 20, 4096
#: The most shared shingles that a document may ask for.
LONGEST = 8
FAN = 16
SHORT = 64
BLOCK_ROWS, BLOCK_SHINGLES = 2048, 1_000_000


def least_shared(n: np.ndarray | int) -> np.ndarray | int:
    """Shingles that any partner of a set of ``n`` must share with it."""
    return -(-LINK * n // 100)


def similar(n_a, n_b, both):
    return (both > 0) & (100 * both >= LINK * (n_a + n_b - both))


# --- tasks -----------------------------------------------------------------------------------


def digests(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that name a set."""
    with np.errstate(over="ignore"):
        s1 = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
        s2 = np.array([mix(s + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64)
    return s1, s2.view(np.int64)


def _texts(batches: Iterator[pa.RecordBatch]):
    """(ids, shingle sets) of a few texts at a time."""
    for batch in batches:
        ids, texts = batch.column(0), strings(batch.column(1))
        for start, stop in slices(texts):
            yield ids.slice(start, stop - start), list(shingle_sets(texts.slice(start, stop - start), WORDS))


_COUNTED = "id long, n long, s1 long, s2 long, chunk int, counts binary"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, size and digest of each text's set; at last the task's own counters."""
    table = np.zeros(CELLS, np.uint32)
    for ids, sets in _texts(batches):
        k = len(sets)
        s1, s2 = digests(sets)
        table += np.bincount((np.concatenate(sets) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS).astype(np.uint32)
        yield pa.record_batch([ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(s1), pa.array(s2),
                               pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
                              names=["id", "n", "s1", "s2", "chunk", "counts"])
    chunks = table.reshape(-1, CHUNK)
    used = np.flatnonzero(chunks.any(axis=1))
    none = pa.nulls(len(used), pa.int64())
    yield pa.record_batch([none, none, none, none, pa.array(used, pa.int32()),
                           pa.array([chunks[i].tobytes() for i in used], pa.binary())],
                          names=["id", "n", "s1", "s2", "chunk", "counts"])


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters of equal chunks added up."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            size = np.uint32 if len(counts) == 4 * CHUNK else np.uint64
            total[chunk] = total.get(chunk, 0) + np.frombuffer(counts, size).astype(np.uint64)
    yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                          names=["chunk", "counts"])


def frequency_classes(counted: DataFrame) -> tuple[np.ndarray, float]:
    """For each cell eight times the base-2 logarithm of its count (a byte), and the mean count of a cell."""
    rows = counted.filter("chunk IS NOT NULL").select("chunk", "counts")
    rows = rows.mapInArrow(_sum, "chunk int, counts binary").repartition("chunk").mapInArrow(_sum, "chunk int, counts binary")
    table = np.zeros(CELLS // CHUNK * CHUNK, np.uint64).reshape(-1, CHUNK)
    for chunk, counts in rows.collect():  # CELLS counters, whatever the input
        table[chunk] = np.frombuffer(counts, np.uint64)
    flat = table.reshape(-1).astype(np.float64)
    return np.minimum(255, np.round(8 * np.log2(1 + flat))).astype(np.uint8), float(flat.mean())


def choose(tokens: np.ndarray, classes: np.ndarray, mean: float) -> tuple[int, np.ndarray]:
    """How many shared shingles a set asks for, and its prefix as ascending keys of the global order."""
    n = len(tokens)
    t = int(least_shared(n))
    most = min(LONGEST, t)
    rank = classes[(tokens % np.uint64(CELLS)).astype(np.int64)]
    first = n - t + most
    keys = np.sort((rank.astype(np.uint64) << np.uint64(56)) | (tokens >> np.uint64(8)))[:first]
    others = np.maximum(np.exp2((keys >> np.uint64(56)).astype(np.float64) / 8) - 1 - mean, 1.0) - 1
    met = np.cumsum(others)[n - t:]                     # postings met by prefixes of n - t + 1, ... shingles
    asked = np.arange(1, most + 1)
    k = int(np.argmin((n - t + asked) + met + n * met / asked)) + 1
    return k, keys[:n - t + k]


def _prefixes(classes: np.ndarray, mean: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _texts(batches):
            some = np.flatnonzero([len(s) > 0 for s in sets])
            s1, s2 = digests(sets)
            chosen = [choose(sets[i], classes, mean) for i in some.tolist()]
            sizes = np.cumsum([0, *[len(p) for _, p in chosen]])
            flat = np.concatenate([p for _, p in chosen]) if chosen else np.zeros(0, np.uint64)
            yield pa.record_batch([
                ids.take(pa.array(some)), pa.array(s1[some]), pa.array(s2[some]), pa.array([k for k, _ in chosen], pa.int32()),
                pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat.view(np.int64)))],
                names=["id", "s1", "s2", "asks", "prefix"])
    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, sets in _texts(batches):
        s1, s2 = digests(sets)
        yield pa.record_batch([ids, pa.array(s1), pa.array(s2), pa.array([s.tobytes() for s in sets], pa.binary())],
                              names=["id", "s1", "s2", "shingles"])


def _tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each sorted posting list: every member with its parent, if their lengths allow a link.

    A list may go on in the next partition. So the heads of a partition's first and last list are reported too.
    """
    token, run, first, head = None, [], True, []
    for batch in batches:
        a, b = [], []
        for x, sid, n in zip(*[c.to_pylist() for c in batch.columns]):
            if x != token:
                if first and run:
                    head, first = [(token, run[0][0])], False
                token, run = x, []
            if run:
                parent, size = run[(len(run) - 1) // FAN]
                if 100 * min(n, size) >= LINK * max(n, size):
                    a.append(parent)
                    b.append(sid)
            run.append((sid, n))
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(len(a), pa.int64())],
                              names=["a", "b", "token"])
    if run:
        head = [*head, (token, run[0][0])]
    yield pa.record_batch([pa.array([s for _, s in head], pa.int64()), pa.nulls(len(head), pa.int64()),
                           pa.array([t for t, _ in head], pa.int64())], names=["a", "b", "token"])


def may_link(p: np.ndarray, q: np.ndarray, n_p: int, n_q: int, least: int) -> bool:
    """Whether two prefixes (ascending keys) share ``least`` and leave room for a link of their sets."""
    both = np.intersect1d(p, q, assume_unique=True)
    if len(both) < least:
        return False
    end = min(p[-1], q[-1])  # both sets are known up to here
    rest = min(n_p - np.searchsorted(p, end, "right"), n_q - np.searchsorted(q, end, "right"))
    return bool(similar(n_p, n_q, len(both) + rest))


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, and of each asks, n, prefix) that their prefixes do not rule out."""
    for batch in batches:
        asks = np.minimum(np.asarray(batch.column(2)), np.asarray(batch.column(3)))
        n_a, n_b = np.asarray(batch.column(4)), np.asarray(batch.column(5))
        keep = pa.array([may_link(*(np.asarray(x.values).view(np.uint64) for x in (p, q)), n, m, k) for k, n, m, p, q in zip(
            asks.tolist(), n_a.tolist(), n_b.tolist(), batch.column(6), batch.column(7))], pa.bool_())
        yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, shingles_a, shingles_b) that link on their full sets."""
    for batch in batches:
        keep = []
        for i in range(batch.num_rows):
            x, y = unpacked(batch.column(2), i), unpacked(batch.column(3), i)
            keep.append(bool(similar(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)))))
        keep = pa.array(keep, pa.bool_())
        yield pa.record_batch([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


class _Rows:
    """Sets or prefixes of a block's rows as one array of small numbers, for counting shared ones against one row."""

    def __init__(self, parts: list[np.ndarray]) -> None:
        sizes = np.array([len(p) for p in parts], np.int64)
        values, flat = np.unique(np.concatenate(parts), return_inverse=True)
        self.flat, self.owner, self.end = flat, np.repeat(np.arange(len(parts)), sizes), np.cumsum(sizes)
        self.mark, self.sizes = np.zeros(len(values), bool), sizes

    def shared(self, i: int, rows: np.ndarray) -> np.ndarray:
        """How many members of row ``i`` each of ``rows`` (a mask) holds."""
        own = self.flat[self.end[i] - self.sizes[i]:self.end[i]]
        self.mark[own] = True
        use = rows[self.owner]
        out = np.bincount(self.owner[use], self.mark[self.flat[use]], len(self.sizes)).astype(np.int64)
        self.mark[own] = False
        return out


def _join_classes(group: pa.Table) -> pa.Table:
    """Of one block of an open list: links between asking rows and rows of other classes that join classes."""
    ids, label, n, asks = (np.asarray(group[c]) for c in ("sid", "label", "n", "asks"))
    asking = np.asarray(group["asking"])
    sets = _Rows([np.frombuffer(x, np.uint64) for x in group["shingles"].to_pylist()])
    prefixes = _Rows([np.asarray(x, np.int64) for x in group["prefix"].to_pylist()])
    a, b = [], []
    for i in np.flatnonzero(asking)[np.argsort(ids[asking], kind="stable")].tolist():
        rest = ~asking & (label != label[i]) & (100 * np.minimum(n, n[i]) >= LINK * np.maximum(n, n[i]))
        if rest.any():
            rest &= prefixes.shared(i, rest) >= np.minimum(asks, asks[i])
        if rest.any():
            for j in np.flatnonzero(rest & similar(n, n[i], sets.shared(i, rest))).tolist():
                if label[j] != label[i]:
                    a.append(ids[i])
                    b.append(ids[j])
                    label = np.where(label == label[i], label[j], label)
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


# --- the join --------------------------------------------------------------------------------


class _Join:
    """Documents, their distinct sets and prefixes; what a candidate pair is tested with."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str) -> None:
        self.texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
        counted = saved(self.texts.mapInArrow(_count, _COUNTED), "jaccard-counts")
        self.rows = counted.filter("chunk IS NULL").select("id", "n", "s1", "s2")
        alone = F.col("id").isNull() | (F.col("n") == 0)
        self.alone, self.linked = self.rows.filter(alone), self.rows.filter(~alone)
        own = self.linked.groupBy("s1", "s2", "n", "id").agg(F.count("*").alias("rows"))
        self.reps = saved(own.groupBy("s1", "s2", "n").agg(F.min(F.struct("id", "rows")).alias("r")).select(
            "s1", "s2", "n", "r.*", F.monotonically_increasing_id().alias("sid")), "jaccard-sets")
        classes, mean = frequency_classes(counted)
        self.prefixes = self._read(self.reps, _prefixes(classes, mean), "asks int, prefix array<long>", "jaccard-prefixes")

    def _read(self, reps: DataFrame, fn, columns: str, name: str) -> DataFrame:
        """sid, n and the ``columns`` that ``fn`` makes of the texts that stand for ``reps``: one row for each set."""
        texts = self.texts.filter("text IS NOT NULL").join(few(reps.select("id").distinct()), "id", "left_semi")
        read = texts.mapInArrow(fn, f"id long, s1 long, s2 long, {columns}").join(few(reps), ["id", "s1", "s2"])
        found = saved(read.drop("id", "s1", "s2"), name)
        # Only sets whose id stands in several equal rows were read more than once.
        return found.filter("rows = 1").unionAll(found.filter("rows > 1").dropDuplicates(["sid"])).drop("rows")

    def sets_of(self, sids: DataFrame, name: str) -> DataFrame:
        """The full sets of some sids."""
        reps = saved(self.reps.join(sids.distinct(), "sid", "left_semi"), f"{name}-ids")
        return self._read(reps, _sets, "shingles binary", name).drop("n")

    def _sided(self, pairs: DataFrame, side: DataFrame, cols: list[str], fn) -> DataFrame:
        """``fn`` over pairs with columns of both sides."""
        for k in "ab":
            pairs = pairs.join(side.select(F.col("sid").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in cols]), k)
        return pairs.select("a", "b", *[f"{c}_{k}" for c in cols for k in "ab"]).mapInArrow(fn, "a long, b long")

    def matched(self, pairs: DataFrame, name: str) -> DataFrame:
        """Of ``pairs`` (a, b) those whose prefixes share enough."""
        return saved(self._sided(pairs, self.prefixes, ["asks", "n", "prefix"], _match), name)

    def confirmed(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        return self._sided(pairs, sets, ["shingles"], _confirm)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("sid"))


def link_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id (the least id reachable by links) for each row of ``docs``."""
    join = _Join(docs, id_col, text_col)
    every = join.prefixes.select(F.explode("prefix").alias("token"), "sid", "n")
    shared = every.groupBy("token").agg(F.count("*").alias("members")).filter("members > 1")
    postings = saved(every.join(shared, "token"), "jaccard-postings")

    # Trees over the lists: classes from few pairs.
    tree = saved(ordered(postings.select("token", "sid", "n"), ["token", "sid"]).mapInArrow(
        _tree, "a long, b long, token long"), "jaccard-tree")
    often = tree.filter("token IS NULL").groupBy("a", "b").agg(F.count("*").alias("lists")).filter("lists > 1")
    heads = tree.filter("token IS NOT NULL").groupBy("token").agg(F.array_sort(F.collect_set("a")).alias("h"))
    along = heads.filter(F.size("h") > 1).select(F.explode(F.arrays_zip(
        F.slice("h", 1, F.size("h") - 1).alias("a"), F.slice("h", 2, F.size("h") - 1).alias("b"))).alias("p")).select("p.*")
    near = join.matched(often.select("a", "b").union(along).distinct(), "jaccard-near")
    links = saved(join.confirmed(near, join.sets_of(_ends(near), "jaccard-near-sets")), "jaccard-links")
    labels = connected(links, "jaccard-classes")

    # Lists that still hold several classes.
    known = saved(postings.join(labels.withColumnRenamed("id", "sid"), "sid", "left").withColumn(
        "label", F.coalesce("label", "sid")), "jaccard-labelled")
    several = known.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi")
    open_ = saved(known.join(several.select("token"), "token", "left_semi"), "jaccard-open")
    short, long = open_.filter(F.col("members") <= SHORT), open_.filter(F.col("members") > SHORT)
    x, y = (short.select("token", *[F.col(c).alias(f"{c}_{k}") for c in ("sid", "n", "label")]) for k in "ab")
    pairs = x.join(y, "token").filter(
        "sid_a < sid_b AND label_a <> label_b"
        f" AND 100 * least(n_a, n_b) >= {LINK} * greatest(n_a, n_b)").select(F.col("sid_a").alias("a"), F.col("sid_b").alias("b"))
    near = join.matched(pairs.distinct(), "jaccard-pairs")
    sets = join.sets_of(_ends(near).union(long.select("sid")), "jaccard-open-sets")
    more = join.confirmed(near, sets).unionAll(_blocks(long, join.prefixes, sets))

    # Classes that those links join.
    to = labels.withColumnRenamed("id", "i")
    met = (more.join(to.select(F.col("i").alias("a"), F.col("label").alias("la")), "a", "left")
           .join(to.select(F.col("i").alias("b"), F.col("label").alias("lb")), "b", "left")
           .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).distinct())
    merged = connected(met, "jaccard-merged").select(F.col("id").alias("label"), F.col("label").alias("to"))
    named = saved(join.reps.join(labels.withColumnRenamed("id", "sid"), "sid", "left").withColumn(
        "label", F.coalesce("label", "sid")).join(merged, "label", "left").select(
        "s1", "s2", "n", "id", F.coalesce("to", "label").alias("label")), "jaccard-named")
    # Only classes of several sets need a least id; those of one set have their own.
    least = named.groupBy("label").agg(F.min("id").alias("component_id"), F.count("*").alias("sets")).filter("sets > 1")
    whole = named.join(least.select("label", "component_id"), "label", "left").select(
        "s1", "s2", "n", F.coalesce("component_id", "id").alias("component_id"))
    return join.linked.join(whole, ["s1", "s2", "n"]).select("id", F.col("n").alias("n_shingles"), "component_id").unionAll(
        join.alone.select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id")))


def _blocks(open_: DataFrame, prefixes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between classes of long open lists: members outside a list's largest class meet all others, block by block."""
    per = open_.groupBy("token", "label").agg(F.count("*").alias("c"), F.sum("n").alias("size"))
    top = per.groupBy("token").agg(F.sum("c").alias("c"), F.sum("size").alias("size"),
                                   F.max(F.struct("c", "size", "label")).alias("most"))
    parts = lambda c, size: F.ceil(F.greatest(c / BLOCK_ROWS, size / BLOCK_SHINGLES)).cast("int")
    top = top.select("token", F.col("most.label").alias("main"), parts(F.col("c"), F.col("size")).alias("rb"),
                     parts(F.col("c") - F.col("most.c"), F.col("size") - F.col("most.size")).alias("qb"))
    dealt = open_.join(top, "token")
    place = lambda n, salt: F.pmod(F.xxhash64("sid", F.lit(salt)), n).cast("int")
    asking = dealt.filter("label <> main").select(
        "token", place(F.col("qb"), 1).alias("q"), F.explode(F.sequence(F.lit(0), F.col("rb") - 1)).alias("r"),
        F.lit(True).alias("asking"), "sid", "label")
    rest = dealt.select("token", F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("q"), place(F.col("rb"), 2).alias("r"),
                        F.lit(False).alias("asking"), "sid", "label")
    full = asking.unionAll(rest).join(prefixes, "sid").join(sets, "sid")
    return full.groupBy("token", "q", "r").applyInArrow(_join_classes, "a long, b long")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    return link_classes(docs, id_col, text_col).withColumnRenamed("id", "doc_id")
