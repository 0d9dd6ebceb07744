import pytest
from pyspark.sql import functions as F

from scrubjay.functions.predicates import facet_filter
from scrubjay.plans import cube, pipelines, reports
from scrubjay.sources import fixtures
from tests.conftest import SF_SMALL

PAIRS = [(reports.student_summary, cube.student_summary), (reports.outcomes_by_band, cube.outcomes_by_band),
         (reports.outcomes_by_skill, cube.outcomes_by_skill), (reports.outcomes_by_policy, cube.outcomes_by_policy),
         (reports.outcomes_by_use_case, cube.outcomes_by_use_case), (reports.burnout_by_band, cube.burnout_by_band),
         (lambda df, where: reports.rank_bands_in_major(df.where(where)),
          lambda c, where: cube.rank_bands_in_major(c, 3, where)),
         (lambda df, where: reports.gpa_pivot(df.where(where)), lambda c, where: cube.gpa_pivot(c, where))]


@pytest.fixture(scope="module")
def rows(spark):
    """Cleaned students, some without a category, an hour count or a band."""
    df = pipelines.student_rows(fixtures.outcomes(spark, SF_SMALL))
    gap = F.col("tie_part") % 11 == 0
    return df.withColumns({c: F.when(~gap, F.col(c)) for c in ("major_category", "weekly_genai_hours", "ai_usage_band")}).cache()


@pytest.fixture(scope="module")
def whole(rows):
    part = F.col("tie_supp") % 3
    return cube.merge(*[cube.report_cube(rows.where(part == i)) for i in range(3)]).cache()


@pytest.mark.parametrize("place", range(len(PAIRS)))
@pytest.mark.parametrize("facets", [{}, {"major_category": ["A", "R"], "burnout_risk_level": ["High"]},
                                    {"major_category": ["none of these"]}])
def test_reports_from_the_cube_equal_those_from_rows(rows, whole, place, facets):
    where = facet_filter(facets=facets)
    plain, rolled = PAIRS[place]
    want, got = plain(rows, where), rolled(whole, where)
    assert got.columns == want.columns
    want, got = [tuple(r) for r in want.collect()], [tuple(r) for r in got.collect()]
    assert len(got) == len(want)
    for a, b in zip(sorted(want, key=str), sorted(got, key=str)):
        # One rounding step apart where the sums' order moved an average over a midpoint.
        assert all(x == y or isinstance(x, float) and x == pytest.approx(y, abs=0.0011 if abs(x) < 5 else 0.011)
                   for x, y in zip(a, b)), (a, b)


def test_cube_is_bounded_by_categories(rows, whole):
    cells = whole.count()
    assert cells == rows.select(*cube.DIMENSIONS).distinct().count()
    assert whole.agg(F.sum("students")).first()[0] == rows.count()


def test_cube_of_no_rows(rows):
    empty = cube.report_cube(rows.limit(0))
    assert empty.count() == 0
    assert cube.student_summary(empty).first()["students"] == 0
    assert cube.outcomes_by_band(empty).collect() == []


def test_unknown_dimension(whole):
    with pytest.raises(ValueError):
        cube.roll_up(whole, ["student_id"], [cube.students_in()])
