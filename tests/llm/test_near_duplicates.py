import itertools
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scrubjay.llm import minhash, packing
from scrubjay.llm.textarrays import SIGNS, shingle_sets, word_hashes

import re

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_sets(texts):
    lower = {i: chr(i + 32) for i in range(65, 91)}
    out = []
    for text in texts:
        w = _WORD.findall((text or "").translate(lower))
        out.append(frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    return out


def brute_classes(docs):
    """Classes by comparing all pairs."""
    sets = brute_sets([t for _, t in docs])
    parent = {i: i for i, _ in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, _) in enumerate(docs):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(i), find(docs[b][0])))
                parent[y] = x
    return {i: (len(s), find(i)) for (i, _), s in zip(docs, sets)}


def families(seed=1):
    """Groups of copies at all distances from their original, one with hundreds of members."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    docs, number = [], 0
    for size in (260, 40, 12, 3, 2, 1, 1):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(60, 160))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 4, 6))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            docs.append((number, " ".join(words)))
            number += 1
    docs += [(number, None), (number + 1, ""), (number + 2, " \n"), (number + 3, "A b"), (number + 4, "a  B"),
             (number + 5, "a b c")]
    rng.shuffle(docs)
    return docs


def test_words_and_shingles_match_the_pattern():
    texts = ["The  quick\tbrown\x0bFOX jumps over É ñ", "one two three", "a b c d e a b c d e", "", None, "x", " lead",
             "same same same same same same", "trail \n", "日本 語 x y z w"]
    got = list(shingle_sets(pa.array(texts, pa.string())))
    assert [len(s) for s in got] == [len(s) for s in brute_sets(texts)]
    sliced = pa.array(["pad", *texts], pa.string()).slice(1)
    assert all(np.array_equal(a, b) for a, b in zip(got, shingle_sets(sliced)))
    raw = "ÉA b-c,É"
    data = np.frombuffer(raw.encode(), np.uint8)
    words, at = word_hashes(data, np.array([0, len(data)]), SIGNS, latin=True)
    again, _ = word_hashes(np.frombuffer("éa B c é".encode(), np.uint8), np.array([0, 10]), SIGNS, latin=True)
    assert at.tolist() == [0, 4] and np.array_equal(words, again)


def test_sketch_fills_every_coordinate_and_estimates_similarity():
    rng = np.random.default_rng(3)
    errors = []
    for n in (1, 2, 7, 50, 400):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[:max(1, int(n * 0.8))], rng.integers(0, 2**63, n // 5, dtype=np.uint64)]))
        x, y = minhash.fast_sketch([a, b])
        assert np.all(x != np.uint64(0xFFFFFFFFFFFFFFFF))
        errors.append(abs((x == y).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b))))
        assert np.array_equal(x, minhash.fast_sketch([a])[0])
    assert max(errors) < 0.12
    assert not minhash.fast_sketch([np.zeros(0, np.uint64)]).any()


@pytest.mark.parametrize("block", [2048, 16])
def test_classes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block)  # small blocks: buckets are split
    docs = families()
    df = spark.createDataFrame([*docs, (None, "a b")], "doc_id long, text string").withColumns(
        {"label": F.lit("x"), "key": F.lit(1), "id": F.lit(2)})
    got = {r.doc_id: r for r in minhash.near_duplicates(df).collect()}
    want = brute_classes(docs)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items() if i is not None} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items() if i is not None)
    assert got[None].kept and got[None].component_id is None
    kept = minhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in want.items() if i == c} | {None}


def test_connected_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.id: r.label for r in minhash.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 140)}}
    assert minhash.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def test_empty_and_repeated_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(none).collect() == []
    twice = spark.createDataFrame([(4, "one two three four five six"), (4, "one two three four five six")], none.schema)
    assert [(r.component_id, r.kept) for r in minhash.near_duplicates(twice).collect()] == [(4, True), (4, True)]


# --- packing ------------------------------------------------------------------------------



def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    return public.path("byte_bpe_50k.json")


def test_ids_equal_the_tokenizers_library():
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(tokenizer())
    plain.encode_special_tokens = True
    tool = packing.Tokens(tokenizer())
    texts = ["a\r\n b", "  x\n\n\t y", "<|endoftext|> a", " é́ ñ \xa0x", "it's I'LL we'Re", "日本 語123 45", "\x00\x01", "",
             " ", "x" * 300, "🙂🙂  🙂", "ñandú, über!! ### ", None, "a\u2003 b \u2003c", " lead", "trail ", "a b c a b c",
             "x \u00a0 y\u0085 z", "é à ü é", "tab\t tab \tend", "\n a\n b", "end\n", "1 2  3   4", "a\x1c b \x1fc"]
    rng = random.Random(9)
    signs = ["a", "b ", " ", "\n", "é", "\u00a0", "\u2003", ".", "ab", "日", "\t", "'s"]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    for text in texts:
        assert np.frombuffer(tool.plain(text or ""), "<u4").tolist() == plain.encode(text or "", add_special_tokens=False).ids


def test_cut():
    assert packing.cut(5) == [(0, 5)] and packing.cut(2048) == [(0, 2048)]
    assert packing.cut(2050) == [(0, 2), (2, 2048)]
    assert packing.cut(5000) == [(0, 904), (904, 2048), (2952, 2048)]


def test_groups_are_packed_tightly_and_whole():
    rng = random.Random(4)
    for lengths in ([rng.randint(1, 2047) for _ in range(600)], [rng.randint(700, 1300) for _ in range(300)],
                    [2047] * 5, [1] * 5000, [], [683] * 99):
        bins = packing.pack_group(lengths)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
        assert all(sum(lengths[i] for i in b) <= packing.SEQUENCE for b in bins)
        first_fit = packing.Bins(lengths)
        assert len(bins) <= len(first_fit.fill)
    # Best fit needs three sequences here; one exchange gets along with two.
    lengths = [1000, 900, 700, 600, 448, 448]
    assert len(packing.pack_group(lengths)) == 2


def steps_left(bins):
    """Whether any move of one or two pieces against none or one, or of one against two, raises the squared fill."""
    sums = [{tuple(c): sum(bins.lengths[i] for i in c) for k in (0, 1, 2) for c in itertools.combinations(m, k)}
            for m in bins.members]
    fill = [sum(bins.lengths[i] for i in m) for m in bins.members]
    return any(0 < out - back <= packing.SEQUENCE - fill[t] and fill[t] - fill[g] + out - back > 0
               for g in range(len(fill)) if 0 < fill[g] < packing.SEQUENCE for t in range(len(fill)) if t != g and fill[t]
               for o, out in sums[g].items() if o for b, back in sums[t].items() if len(o) + len(b) < 4)


def test_search_ends_only_when_no_piece_can_move():
    """Sequences of many short pieces, most of them beyond the first slots; fewest sequences end the search, too."""
    rng = random.Random(12)
    ended = 0
    for _ in range(12):
        bins = packing.Bins([rng.randrange(100, 500, 100) for _ in range(rng.randint(40, 70))])
        held = sorted(bins.lengths)
        bins.improve()
        assert sorted(bins.lengths[i] for m in bins.members for i in m) == held
        assert all(sum(bins.lengths[i] for i in m) <= packing.SEQUENCE for m in bins.members)
        if sum(map(bool, bins.members)) > -(-sum(held) // packing.SEQUENCE):
            ended += 1
            assert not steps_left(bins)
    assert ended
    # Small groups against the true fewest, found by trying every assignment.
    def fewest(lengths, bins=()):
        if not lengths:
            return len(bins)
        return min([fewest(lengths[1:], (*bins[:i], b + lengths[0], *bins[i + 1:]))
                    for i, b in enumerate(bins) if b + lengths[0] <= packing.SEQUENCE and b not in bins[:i]]
                   + [fewest(lengths[1:], (*bins, lengths[0]))])
    gaps = [len(packing.pack_group(part)) - fewest(sorted(part, reverse=True))
            for part in ([rng.randint(300, 1400) for _ in range(8)] for _ in range(40))]
    assert min(gaps) == 0 and max(gaps) <= 1 and np.mean(gaps) < 0.1


def test_pieces_round_trip(spark):
    texts = ["word " * n for n in (1, 10, 2047, 2048, 2049, 6000)] + [None, "", "two\n lines"]
    docs = spark.createDataFrame([*enumerate(texts), (3, texts[3]), (None, "no id")], "doc_id long, text string").withColumn(
        "length", F.lit("clash"))
    rows = packing.pack(docs, tokenizer()).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append(r)
    for part in by.values():
        part.sort(key=lambda r: r.offset)
        assert [r.offset for r in part] == np.cumsum([0, *(r.length for r in part[:-1])]).tolist()
        assert sum(r.length for r in part) <= packing.SEQUENCE
    ids = packing.pieces(docs, tokenizer(), keep_ids=True).where("doc_id = 5").orderBy("piece").collect()
    whole = b"".join(r.ids for r in ids)
    tool = packing.Tokens(tokenizer())
    assert whole == tool.plain(texts[5]) + b"\0\0\0\0"
    assert {r.length for r in rows if r.doc_id in (6, 7)} == {1}
    assert packing.pack(docs.limit(0), tokenizer()).collect() == []


def test_ids_with_two_texts_lose_no_link(spark):
    near = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    docs = spark.createDataFrame([(5, other, 1), (5, near, 2), (9, near + " end", 3), (9, near + " end", 4), (3, near + " z", 5),
                                  (7, other, 6), (7, other, 7), (8, "alone here", 8), (8, "alone here", 9), (None, near, 10),
                                  (6, "", 11), (6, "", 12)], "doc_id long, text string, mark int")
    got = sorted((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect() if r.doc_id)
    assert got == [(3, 3, True), (5, 3, False), (5, 5, True), (6, 6, True), (6, 6, True), (7, 5, False), (7, 5, False),
                   (8, 8, True), (8, 8, True), (9, 3, False), (9, 3, False)]
    left = minhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    kept = sorted(r.mark for r in left.collect())
    assert kept in ([1, 5, 8, 10, 11, 12], [1, 5, 9, 10, 11, 12])
