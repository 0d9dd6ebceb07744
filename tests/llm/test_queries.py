import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from scrubjay.llm import ann, decontaminate, language, minhash, toxicity
from scrubjay.llm.oracle import ORACLE_SQL
from scrubjay.llm.queries import QUERIES, tokenizer_path
from scrubjay.sources.tables import TABLES, load
from tools.oracle_check import compare

from ..conftest import SF_CHECK, SF_SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    return con


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    r = compare(spark, SF_CHECK, name, E.queries()[name], ORACLE_SQL[name], duck)
    assert r["cols_equal"] and r["types_equal"] and r["values_equal"], r


CONTRACT = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op2_language_id": ["doc_id", "held_out", "lang_pred", "score"],
    "op4_hilbert_neighbours": ["query_id", "rank", "vec_id", "score"],
    "op5_quality": ["doc_id", "held_out", "score", "predicted"],
    "op9_best_fit_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns_and_rows(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    assert df.columns == CONTRACT[name]
    if name.startswith(("op1_", "op2_", "op5_")):
        docs = load(spark, SF_SMALL, "documents")
        assert df.count() == docs.count() and df.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


# --- neighbours ---------------------------------------------------------------------------


def exact(ids, x, q, k=10):
    apart = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    rest = np.flatnonzero(ids != ids[q])
    return rest[np.lexsort((ids[rest], apart[rest]))[:k]], apart


def test_hilbert_curve_visits_neighbouring_cells():
    for dims, bits in ((2, 3), (3, 2), (8, 2)):
        side = 1 << bits
        grid = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
        if len(grid) > 70_000:
            continue
        keys = ann.hilbert_keys(grid, bits)
        assert sorted(keys.tolist()) == list(range(side ** dims))
        assert np.all(np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1)


def test_recall_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((6000, 32)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = np.arange(6000) * 3
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 100 = 0")).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert len(got) == 60
    hits = []
    y = x.astype(np.float64)
    for q, found in got.items():
        near, apart = exact(ids, y, q // 3)
        assert sorted(found) == list(range(1, 11))
        assert all(abs(apart[v // 3] - s) < 1e-12 for v, s in found.values())
        assert [found[i][1] for i in range(1, 11)] == sorted(s for _, s in found.values())
        hits.append(len({v for v, _ in found.values()} & set(ids[near].tolist())))
    assert np.mean(hits) >= 9.0


def test_recall_on_clustered_vectors(spark):
    rng = np.random.default_rng(3)
    x = (rng.standard_normal((40, 32))[rng.integers(0, 40, 6000)] * 3 + rng.standard_normal((6000, 32))).astype(np.float32)
    ids = np.arange(6000)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    y, hits = x.astype(np.float64), []
    found = ann.nearest(df, df.where("vec_id % 100 = 0")).toPandas().groupby("query_id")["vec_id"].apply(set)
    for q, near in found.items():
        hits.append(len(near & set(ids[exact(ids, y, q)[0]].tolist())))
    assert len(hits) == 60 and np.mean(hits) >= 9.0


def test_rows_are_placed_in_ranges_and_a_hot_key_is_split(spark, monkeypatch):
    """A third of the rows are one vector: its range becomes blocks, and the result is that of whole ranges."""
    rng = np.random.default_rng(5)
    x = rng.standard_normal((3000, 8))
    x[::3] = x[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    asked = df.where("vec_id % 5 = 0")
    whole = sorted(map(tuple, ann.nearest(df, asked).collect()))
    monkeypatch.setattr(ann, "BLOCK_VALUES", 1)
    rows = ann.usable(df, "vec_id", "embedding")
    ranges = ann.fitted_ranges(rows, ann.Curves(x), 3000)
    queries = ann.usable(asked, "vec_id", "embedding")
    counts = ann.query_counts(queries, ranges)
    ranges.query_blocks = -(-counts // ranges.block)
    assert ranges.row_blocks.max() >= 4 and ranges.query_blocks.max() >= 2
    placed = ann.placed_rows(rows, ranges).groupBy("cell", "rb", "qb").count().toPandas()
    hot = placed[placed["cell"] == int(np.argmax(ranges.row_blocks))]
    assert hot["count"].max() <= 2 * ranges.block
    # On every curve each row is in one range and meets each of its query blocks once.
    once = ann.placed_rows(rows, ranges).select("id", "cell").distinct().groupBy("id").count().toPandas()["count"]
    assert once.min() >= 1 and once.max() <= ann.CURVES
    assert sorted(map(tuple, ann.nearest(df, asked).collect())) == whole


def test_neighbours_with_ties_and_odd_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(0, 300)] + [(1000, None), (1001, [0.0, 0.0, 0.0]), (1002, [1.0, None, 2.0]),
            (1100, [float("nan"), 1.0, 1.0]), (1101, [float("inf"), 1.0, 1.0]), (1200, [1.0]), (1201, []), (None, same),
            (7, same), (300, [9.0, 9.0, 9.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns(
        {"id": F.lit(1), "v": F.lit(2), "score": F.lit(3)})
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == [0, 100, 200, 300]
    assert [v for v, _ in got[0]] == [1, 2, 3, 4, 5, 6, 7, 7, 8, 9] and {s for _, s in got[0]} == {0.0}
    assert [v for v, _ in got[100]] == [0, 1, 2, 3, 4, 5, 6, 7, 7, 8]
    few = spark.createDataFrame([(0, same), (1, [1.0, 2.0, 4.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in ann.nearest(few, few.where("vec_id = 0")).collect()] == [(0, 1, 1, 1.0)]
    assert ann.nearest(df.limit(0), df.limit(0)).collect() == []


# --- pipeline -----------------------------------------------------------------------------


def test_pipeline_stages_take_effect(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_dedup", "decontaminate", "pack"]
    docs = load(spark, SF_SMALL, "documents").withColumn("extra", F.lit(1))
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["toxicity"](spark, docs, SF_SMALL)
    scores = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, load(spark, SF_SMALL, "labels")).collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, p in scores.items() if not p}

    docs = docs.unionByName(spark.createDataFrame([(10**9, "12 34", None, None, 5, 1), (10**9 + 1, None, None, None, 0, 1)],
                                                  docs.schema))
    named = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs).collect()}
    kept = stages["language"](spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (lang, s) in named.items() if lang != "und" and s >= 0.5}
    assert not {10**9, 10**9 + 1} & {r.doc_id for r in kept.collect()}

    kept = stages["near_dedup"](spark, docs, SF_SMALL)
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in minhash.near_duplicates(docs).collect() if r.kept}

    kept = stages["decontaminate"](spark, docs, SF_SMALL)
    leaks = {r.doc_id for r in decontaminate.overlaps(docs, load(spark, SF_SMALL, "benchmark")).collect()}
    assert leaks and {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - leaks


def test_pipeline_runs_whole(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == CONTRACT["op9_best_fit_packing"] and out.count() > 0
    assert tokenizer_path().endswith("byte_bpe_50k.json")
