import re

import duckdb
import pytest

import __spark_entry__ as E
from scrubjay.plans.catalog import QUERIES
from scrubjay.sources.tables import TABLES
from tools.oracle_check import compare

from .conftest import SF_CHECK


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["airline", "carrier", "flights", "avg_delay", "best_delay", "worst_delay", "ontime_pct"]


CORE = sorted(QUERIES)  # the optional training-data queries have tests of their own


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(CORE) <= set(E.oracle_sql())


def test_no_query_uses_a_row_cap_other_than_features():
    # LIMIT only where the cap is the feature: top-n reports and samples.
    capped = {k for k in CORE if re.search(r"\bLIMIT\b", E.oracle_sql()[k])}
    assert capped <= {"find_duplicates", "worst_delays", "filtered_detail", "sample_repeatable",
                      "filtered_scatter_sample", "fill_mode"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_CHECK}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, duck, name):
    r = compare(spark, SF_CHECK, name, E.queries()[name], E.oracle_sql()[name], duck)
    assert r["cols_equal"], r
    assert r["types_equal"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["values_equal"], r


# Reports whose row order is part of the result: the order is compared too.
ORDERED = ["delay_by_month", "origin_share", "worst_delays", "carrier_comparison", "price_by_cut", "outcomes_by_skill",
           "outcomes_by_policy", "outcomes_by_use_case", "rank_bands_in_group", "pivot_group_by_band", "filtered_detail"]
TIE_BREAK = {"price_by_cut": "cut", "outcomes_by_skill": "prompt_engineering_skill",
             "outcomes_by_policy": "institutional_policy", "outcomes_by_use_case": "primary_use_case"}


@pytest.mark.parametrize("name", ORDERED)
def test_report_order_matches_the_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_CHECK)
    sql = E.oracle_sql()[name] + (f", {TIE_BREAK[name]}" if name in TIE_BREAK else "")
    cur = duck.execute(sql)
    cols = [d[0] for d in cur.description]
    keys = [c for c in cols if df.schema[c].dataType.typeName() != "double"]
    want = [tuple(r[cols.index(k)] for k in keys) for r in cur.fetchall()]
    assert [tuple(r[k] for k in keys) for r in df.collect()] == want


def test_band_reports_come_in_band_order(spark):
    from scrubjay.operators.features import AI_USAGE_LABELS
    for name in ("outcomes_by_band", "filtered_band_overview", "band_level_counts"):
        bands = [r.ai_usage_band for r in E.queries()[name](spark, SF_CHECK).collect()]
        assert bands == sorted(bands, key=AI_USAGE_LABELS.index)
