import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrubjay.llm import language, quality, toxicity
from scrubjay.llm.common import bounded_sample, filled, id_remainder, logistic, logistic_fit, sample_by_label
from scrubjay.sources.tables import load

from ..conftest import SF_CHECK

ODD = [(900001, None), (900002, ""), (900003, "  \n\t"), (900004, "123 !!"), (900005, "the " * 60_000), (None, "the end")]


@pytest.fixture(scope="module")
def docs(spark):
    return load(spark, SF_CHECK, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return load(spark, SF_CHECK, "labels")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string")


def test_remainder_is_crc32_of_the_id_as_text(spark):
    import zlib
    rows = spark.createDataFrame([(7,), (-12,), (None,)], "i long").select("i", id_remainder("i", 3).alias("r")).collect()
    assert [r.r for r in rows] == [zlib.crc32(b"7") % 3, zlib.crc32(b"-12") % 3, None]


def test_bounded_sample_is_stable_and_near_its_bound(spark):
    df = spark.range(20_000)
    a = {r.id for r in bounded_sample(df, "id", 1000).collect()}
    assert a == {r.id for r in bounded_sample(df.repartition(5), "id", 1000).collect()} and 850 < len(a) < 1150
    assert bounded_sample(df, "id", 50_000).count() == 20_000


def test_samples_by_label_keep_rare_labels_whole(spark):
    assert filled({"a": 10, "b": 1000, "c": 5000}, 610) == {"a": 1.0, "b": 0.3, "c": 0.06}
    assert filled({"a": 3, None: 4}, 10) == {"a": 1.0, None: 1.0} and filled({}, 5) == {} and filled({"a": 0}, 5) == {"a": 1.0}
    df = spark.range(20_000).withColumn("l", F.when(F.col("id") % 400 == 0, "rare").otherwise("usual"))
    got = sample_by_label(df, "id", "l", filled({"rare": 50, "usual": 19_950}, 1050)).groupBy("l").count().collect()
    got = {r.l: r["count"] for r in got}
    assert got["rare"] == 50 and 850 < got["usual"] < 1150


@pytest.mark.parametrize("times", [1, 10])
def test_rare_labels_are_learned_however_large_the_table(spark, monkeypatch, times):
    """60 documents of a language and a class of 0.1 to 1 %: held-out accuracy stays when the rest grows tenfold."""
    rng = np.random.default_rng(2)

    def some(alphabet, count):
        known = ["".join(rng.choice(list(alphabet), 6)) for _ in range(300)]
        return [" ".join(rng.choice(known, 40)) for _ in range(count)]

    rare, usual = some("øåæklmnr", 60), some("abcdeikt", 600 * times)
    for module in (language, toxicity, quality):
        monkeypatch.setattr(module, "FIT_ROWS", 400)
    rows = [(i, t, "rr") for i, t in enumerate(rare)] + [(1000 + i, t, "uu") for i, t in enumerate(usual)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    assert 300 < language.sampled(docs).count() < 460
    found = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in found if r.lang == "rr"]) == 1 and len(found) > 100
    marks = docs.select("doc_id", (F.col("lang") == "rr").cast("int").alias("toxic")).withColumn("quality", F.col("toxic"))
    for scored, name in ((toxicity.toxicity(docs, marks), "toxic"), (quality.quality(docs, marks), "quality")):
        got = scored.join(marks, "doc_id").where("held_out").collect()
        assert np.mean([r[name] == r.predicted for r in got]) > 0.97
        assert np.mean([r.predicted for r in got if r[name]]) > 0.9


def test_logistic_fit():
    x = np.array([[-2.0], [-1.0], [1.0], [2.0], [0.5], [-0.5]])
    y = np.array([0, 0, 1, 1, 1, 0])
    w = logistic_fit(x, y)
    assert np.all((logistic(x, w) > 0.5) == (y == 1))
    assert logistic_fit(np.zeros((0, 2)), np.zeros(0)).tolist() == [0, 0, 0]


def nodes(counts):
    """The nodes of beginnings given as (text, ordinary, toxic)."""
    n = toxicity.number
    return [toxicity.Node(n(b), n(b[:-1]), ord(b[-1]), len(b), o, t) for b, o, t in counts]


def test_kneser_ney_by_hand():
    # Words "ab" (3 ordinary, 1 toxic) and "ac" (2 toxic); ends are marked by a line feed.
    counts = [("a", 3, 3), ("ab", 3, 1), ("ac", 0, 2), ("ab\n", 3, 1), ("ac\n", 0, 2)]
    found = toxicity.kneser_ney(nodes(counts))
    table = {b: found[toxicity.number(b)] for b, _, _ in counts}
    d = toxicity.DISCOUNT
    kinds = {"a": 1, "b": 1, "c": 1, "\n": 2}
    letters = sum(kinds.values()) + 1
    shared = (4 - d + d * 2 * (kinds["b"] + 1) / letters) / 6
    toxic = (1 - d + d * 2 * shared) / 3
    ordinary = (3 - d + d * 1 * shared) / 3
    assert math.isclose(table["ab"][0] - table["a"][0], math.log(toxic / ordinary))
    assert table["ac"][0] > 0 > table["ab"][0]
    assert math.isclose(table["a"][1], math.log((d * 2 / 3) / (d * 1 / 3)))


def test_unseen_expressions_are_scored_by_their_stem():
    counts = [(w[:k], o, t) for w, o, t in (("vilest\n", 0, 40), ("plain\n", 400, 300)) for k in range(1, len(w) + 1)]
    evidence = toxicity.Evidence(toxicity.kneser_ney(nodes(counts)))
    assert evidence["vilesu"] > 0 and evidence["plain"] == 0 and evidence["xyz"] == 0


def test_letters_after_the_ninth_tell_words_apart():
    words = (("understandable\n", 400, 0), ("understandingmoron\n", 0, 40))
    counts = {}
    for w, o, t in words:
        for k in range(1, len(w) + 1):
            a, b = counts.get(w[:k], (0, 0))
            counts[w[:k]] = (a + o, b + t)
    found = nodes([(b, o, t) for b, (o, t) in counts.items()])
    table = toxicity.kneser_ney(found)
    for evidence in (toxicity.Evidence(table), toxicity.Evidence(toxicity.telling(table, found))):
        assert evidence["understandingmoron"] > 1 and evidence["understandable"] <= 0
        assert evidence["understandingmorons"] > 1


def test_beginnings_equal_plain_counts_and_long_words_are_whole(spark):
    texts = [("the then other", 0), ("the THE x" + "y" * 30, 1), ("x" + "y" * 30 + "z", 0), ("w" * 200_000, 0),
             ("w" * 200_000, 1)]
    got = {(r.begin, r.above, r.letter, r.size): (r.ordinary, r.toxic) for r in toxicity.beginnings(
        spark.createDataFrame(texts, "text string, label int").repartition(3)).collect()}
    want, n = {}, toxicity.number
    for text, label in texts[:3]:
        for w in text.lower().split():
            for k in range(1, len(w) + 2):
                b = (w + "\n")[:k]
                key = (n(b), n(b[:-1]), ord(b[-1]), k)
                want.setdefault(key, [0, 0])[label] += 1
    want = {k: tuple(v) for k, v in want.items() if sum(v) >= toxicity.LEAST_COUNT}
    long = {k: v for k, v in got.items() if k[2] == ord("w") or k[3] == 200_001}
    assert len(long) == 200_001 and set(long.values()) == {(1, 1)}
    assert {k: v for k, v in got.items() if k not in long} == want


def test_toxicity_held_out_and_odd_texts(spark, docs, labels, odd):
    model = toxicity.fit(toxicity.sampled_labels(docs, labels, "toxic", 10_000, 10**8, 3, 1))
    scored = toxicity.score(docs.select("doc_id", "text"), model).join(labels, "doc_id").where(id_remainder("doc_id", 3) == 1)
    rows = scored.select("toxic", "score").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    # A pair of a toxic and an ordinary held-out document is in the right order.
    ordered = [(t.score > o.score) for t in rows if t.toxic for o in rows if not o.toxic]
    assert np.mean(ordered) > 0.7
    got = {r.doc_id: r.score for r in toxicity.score(odd, model).collect()}
    assert len(got) == len(ODD) and got[900001] == got[900002] == got[900003]
    clash = odd.withColumns({"score": F.lit("x"), "label": F.lit(1), "toxic": F.lit(9)})
    assert toxicity.score(clash, model).count() == len(ODD)


def test_quality_held_out(spark, docs, labels):
    out = quality.quality(docs, labels).join(labels, "doc_id").where("held_out")
    rows = out.select("quality", "predicted", "score").collect()
    assert np.mean([r.quality == r.predicted for r in rows]) > 0.9


def test_quality_reads_every_byte():
    tool = quality.Compressors(quality.train(["good words here " * 40] * 60), quality.train(["bad $$ ## " * 50] * 60))
    if not tool.usable:
        pytest.skip("too little text for a dictionary")
    long = "good words here " * 3000
    assert tool.features(long)[0] > 0 > tool.features("bad $$ ## " * 3000)[0]
    assert tool.features(long + "bad $$ ## " * 20000)[0] < tool.features(long)[0]
    assert tool.features(None) == tool.features("") == (0.0, 0.0)


def test_language_held_out_and_odd_texts(spark, docs, odd):
    tables = language.fit(language.sampled(docs))
    out = language.label(docs.where(id_remainder("doc_id", 4) == 2), tables)
    rows = out.select("lang", "lang_pred").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.98
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.label(odd, tables).collect()}
    assert {got[i] for i in (900001, 900002, 900003, 900004)} == {("und", 0.0)}
    assert got[900005][0] == "en" and 0 <= got[900005][1] <= 1
    assert language.Memo(tables).predict("² ³") == ("und", 0.0)
    assert language.Memo(tables).predict("日本語")[0] in tables.langs


def test_language_backs_off_to_shorter_grams():
    counts = {0: {"known": np.array([9.0, 0.0])}, **{n: {} for n in range(1, 6)}}
    counts[3] = {"zzy": np.array([0.0, 5.0])}
    counts[1] = {"z": np.array([7.0, 0.0])}
    t = language.Tables(["aa", "bb"], counts, {n: np.array([10.0, 10.0]) for n in range(6)})
    assert np.argmax(t.word("known")) == 0
    assert np.argmax(t.word("azzyx")) == 1  # the 3-gram decides although a shorter one is known
    assert np.argmax(t.word("zq")) == 0 and t.word("qqq") is None


def test_language_keeps_every_word_and_gram(spark):
    common = ["".join(chr(97 + i // 26 ** k % 26) for k in range(4)) for i in range(70_000)]
    rows = [(" ".join(common[i::7]), "aa") for i in range(7)] * 4 + [("øre ærlig", "bb")] * 3
    tables = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert len(tables.keys[0]) == 70_002
    assert np.argmax(tables.word("ærlig")) == 1 and np.argmax(tables.word(common[-1])) == 0
    hashes = language.entry_hashes(0, common)
    assert len(np.unique(hashes)) == len(common)
    assert language.Memo(tables).predict("ærlig øre")[0] == "bb"
    assert language.Memo(tables).predict("q")[0] in tables.langs and language.Memo(tables).predict("日")[0] == "aa"


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(none, marks).collect() == []
    assert quality.quality(none, marks).collect() == []
    assert language.identify(none).collect() == []
    some = spark.createDataFrame([(1, "a text", "en", "s", 6), (1, "a text", "en", "s", 6)], none.schema)
    assert [r.score for r in toxicity.toxicity(some, marks).collect()] == [0.5, 0.5]
    assert toxicity.drop_toxic(some, marks).columns == some.columns
    assert language.drop_unidentified(some).count() in (0, 2)
