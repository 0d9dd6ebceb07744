import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from scrubjay.llm import merkle
from scrubjay.llm.places import placed

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def reduce(digests):
    """The last node and, for every leaf, the (left, right) of each level."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        runs = [level[i:i + 8] for i in range(0, len(level), 8)]
        for i, pos in enumerate(at):
            run, slot = runs[pos // 8], pos % 8
            paths[i].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            at[i] = pos // 8
        level = [sha(*run) for run in runs]
    return level[0], paths


def brute(rows):
    def lower(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)

    langs = sorted({r[2] for r in rows}, key=lambda v: (v is not None, (v or "").encode()))
    trees = []
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        trees.append((own, *reduce([leaf(r, r[1]) for r in own])))
    root, crown = reduce([t[1] for t in trees])
    out = []
    for (own, subroot, paths), above in zip(trees, crown):
        for r, path in zip(own, paths):
            bad = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            got = leaf(r, lower(r[1]) if bad else r[1])
            for left, right in path + above:
                got = sha(left, got, right)
            proof = sha(*[x + y for x, y in path + above])
            out.append((r[0], leaf(r, r[1]), subroot, root, proof, got, got == root))
    return sorted(out, key=repr)


def rows_of(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    out = merkle.manifest(df, offered=merkle.tampered(), **kw).drop("path")
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8}, {"en": 9, "de": 1}, {"en": 600, None: 65, "": 3, "é": 8, "z": 64}])
def test_manifest_equals_plain_hashing(spark, sizes):
    rows, number = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((number * 7 % 1009, f"Text {number} É" if number % 5 else "same", lang, "s" if number % 3 else None,
                         number if number % 4 else None))
            number += 1
    assert rows_of(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long = "Word " * 200_000
    rows = [(None, "A", "en", None, 1), (None, None, "en", None, 1), (3, None, None, None, None), (3, "", None, "x", 0),
            (3, long, "en", "x", 5), (3, long, "en", "x", 5)] + [(4, "Copy", "en", "x", 5)] * 40
    assert rows_of(spark, rows) == brute(rows)
    assert rows_of(spark, []) == []
    wide = spark.createDataFrame([(1, "A", "en", "s", 1, "x", 2)],
                                 SCHEMA + ", digest string, pos long")
    assert merkle.manifest(wide).count() == 1


def test_every_changed_row_is_found(spark):
    rows = [(i, "TEXT %d" % i, "en" if i % 3 else "fr", "s", i) for i in range(300)]
    got = rows_of(spark, rows)
    assert [r[0] for r in got if not r[6]] == [r[0] for r in got if zlib.crc32(str(r[0]).encode()) % 3 == 0]


def test_windows_hold_no_whole_language(spark):
    """Blocks cut no run: small blocks give the same manifest."""
    rows = [(i, f"T{i}", "en", "s", i) for i in range(1000)]
    want, old = rows_of(spark, rows), merkle.BLOCK
    try:
        merkle.BLOCK = 16
        assert rows_of(spark, rows) == want
    finally:
        merkle.BLOCK = old


def test_places_split_a_hot_group(spark):
    df = spark.range(0, 20_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("g"), (F.col("id") * 7919 % 20_011).alias("o"), "id")
    got = placed(df, ["g"], ["o"], "test-places")
    hot = got.filter("g = -1").orderBy("pos").select("o", "pos", "n").collect()
    assert [r.pos for r in hot] == list(range(len(hot))) and {r.n for r in hot} == {len(hot)}
    assert [r.o for r in hot] == sorted(r.o for r in hot)
    assert got.filter("g <> -1 AND (pos <> 0 OR n <> 1)").count() == 0
