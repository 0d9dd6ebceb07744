import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrubjay.llm import jaccard

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def plain_set(text):
    w = _WORD.findall((text or "").translate({i: chr(i + 32) for i in range(65, 91)}))
    return frozenset(tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset()


def plain(docs):
    """(doc_id, n_shingles, component_id) of each row, all pairs compared."""
    sets = [plain_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 90 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    low = {}
    for i, (doc, _) in enumerate(docs):
        low[find(i)] = min(low.get(find(i), doc), doc)
    return sorted((d, len(s), low[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets)))


def families(seed, sizes=(150, 30, 8, 3, 2, 1, 1)):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    line = " ".join(rng.choice(words) for _ in range(40))
    docs = []
    for size in sizes:
        base = [rng.choice(words) for _ in range(rng.randint(60, 200))]
        for _ in range(size):
            own = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 3, 4))):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10 ** 6)}" if rng.random() < .5 else rng.choice(words)
            docs.append(" ".join(own) + (" " + line if rng.random() < .3 else ""))
    docs += [line, line + " tail", "A b", "a  B", "a b c", "one", "One", None, "", " \n"]
    rng.shuffle(docs)
    return [(i * 3 % 1009, t) for i, t in enumerate(docs)]


def result(spark, docs, parts=5):
    df = spark.createDataFrame(docs, SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in jaccard.similar_documents(df).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_comparing_all_pairs(spark, seed):
    docs = families(seed)
    assert result(spark, docs) == plain(docs)


def test_long_lists_go_through_blocks(spark, monkeypatch):
    docs = families(3, (120, 60, 5))
    for name, value in (("SHORT", 2), ("BLOCK_ROWS", 16), ("FAN", 3)):
        monkeypatch.setattr(jaccard, name, value)
    assert result(spark, docs) == plain(docs)


def test_one_hot_shingle_and_a_hot_family(spark):
    """A third of the rows share a passage, a third are near copies."""
    rng = random.Random(4)
    passage, base = " ".join(f"p{i}" for i in range(60)), [f"b{i}" for i in range(120)]
    docs = []
    for i in range(240):
        if i % 3 == 0:
            docs.append((i, " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randint(1, 30))) + " " + passage))
        elif i % 3 == 1:
            own = list(base)
            own[rng.randrange(120)] = f"n{i}"
            docs.append((i, " ".join(own)))
        else:
            docs.append((i, "the same text for all of these rows"))
    assert result(spark, docs) == plain(docs)


def test_ids_with_two_texts_lose_no_link(spark):
    near = " ".join(f"w{i}" for i in range(80))
    docs = [(5, "quite another text here"), (5, near), (9, near + " end"), (9, near + " end"), (3, near + " end too")]
    assert result(spark, docs) == plain(docs)
    assert result(spark, []) == []
    odd = spark.createDataFrame([(None, near, 1), (7, near, 2), (8, near.upper(), 3)], "doc_id long, text string, n long")
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_documents(odd).collect()} == {
        (None, 78, None), (7, 78, 7), (8, 78, 7)}
    long = " ".join(f"w{i}" for i in range(200_000))
    assert [r[2] for r in result(spark, [(1, long), (2, long + " x"), (3, "word " * 200_000)])] == [1, 1, 3]


def test_prefixes_share_what_both_ask_for():
    """The lemma: similar sets share at least the smaller number in their own prefixes, whatever each chose."""
    rng = np.random.default_rng(0)
    classes = rng.integers(0, 255, jaccard.CELLS).astype(np.uint8)
    seen = set()
    for _ in range(400):
        a = np.unique(rng.integers(1, 1 << 60, rng.integers(1, 120)).astype(np.uint64))
        drop = rng.random(len(a)) > rng.choice([0, .02, .05])
        b = np.unique(np.concatenate([a[drop], rng.integers(1, 1 << 60, rng.integers(0, 5)).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or not jaccard.similar(len(a), len(b), both):
            continue
        (ka, pa), (kb, pb) = (jaccard.choose(s, classes, 0.0) for s in (a, b))
        seen.add((ka, kb))
        assert len(np.intersect1d(pa, pb)) >= min(ka, kb)
        assert jaccard.may_link(pa, pb, len(a), len(b), min(ka, kb))
        assert len(pa) == len(a) - jaccard.least_shared(len(a)) + ka
    assert len(seen) > 3


def test_frequent_shingles_lengthen_the_prefix():
    tokens = np.arange(1, 101, dtype=np.uint64)
    seldom = np.zeros(jaccard.CELLS, np.uint8)
    assert jaccard.choose(tokens, seldom, 0.0)[0] == 1
    hot = np.full(jaccard.CELLS, 100, np.uint8)
    assert jaccard.choose(tokens, hot, 0.0)[0] > 1
    mixed = seldom.copy()
    mixed[1:60] = 120
    k, keys = jaccard.choose(tokens << np.uint64(20), np.zeros(jaccard.CELLS, np.uint8), 0.0)
    assert (np.diff(keys.astype(object)) > 0).all() and len(keys) == 10 + k
    assert (jaccard.choose(tokens, mixed, 0.0)[1] >> np.uint64(56) == 0).all()
    far = keys + np.uint64(1)
    assert not jaccard.may_link(keys, far, 100, 100, 0) and not jaccard.may_link(keys, keys, 100, 100, 20)


def test_counters_are_exact_sums(spark):
    docs = spark.createDataFrame([(i, f"a b c d{i % 4}") for i in range(50)], SCHEMA).repartition(7)
    counted = docs.select(F.col("doc_id").alias("id"), "text").mapInArrow(jaccard._count, jaccard._COUNTED)
    classes, mean = jaccard.frequency_classes(counted)
    assert mean * jaccard.CELLS == pytest.approx(100) and classes.max() == round(8 * np.log2(51))
