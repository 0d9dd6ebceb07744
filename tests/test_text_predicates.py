import pytest
from pyspark.sql import functions as F

from scrubjay.functions import predicates as p
from scrubjay.functions import text as t

def test_clean_person_text(spark):
    rows = [("\tmaria  de la CRUZ ", " Maria@Mail.Example "), ("OTTO\n\nvon  Berg", "otto@mail.example"),
            ("  li", "LI@MAIL.EXAMPLE"), (None, None), ("   ", "")]
    df = spark.createDataFrame(rows, "name string, email string")
    out = df.select(t.proper("name").alias("n"), t.clean_email("email").alias("e")).collect()
    assert [r.n for r in out] == ["Maria De La Cruz", "Otto Von Berg", "Li", None, ""]
    assert [r.e for r in out] == ["maria@mail.example", "otto@mail.example", "li@mail.example", None, ""]


def test_strip_company_suffixes(spark):
    rows = [("AA", "Alpha Airlines Inc."), ("BB", "Beta Air Lines Co."), ("CC", "Gamma Corporation"), ("DD", "Delta")]
    df = spark.createDataFrame(rows, "carrier string, name string")
    assert [r.s for r in df.select(t.strip_suffixes("name").alias("s")).collect()] == ["Alpha", "Beta", "Gamma", "Delta"]


def test_category_token(spark):
    df = spark.createDataFrame([("  Direct   Answer ",), ("4-NOT SPECIFIED",)], "c string")
    assert [r.c for r in df.select(t.category_token("c").alias("c")).collect()] == ["Direct_Answer", "4-NOT_SPECIFIED"]


def test_predicates_bind_values_safely(spark):
    tricky = "O'Brien\\"
    df = spark.createDataFrame([(tricky, 1), ("x", 2)], "c string, v int")
    assert df.where(p.in_values("c", [tricky])).count() == 1
    assert df.where(p.facet_filter(facets={"c": [tricky]})).count() == 1


def test_filter_builders_optional_parts(spark):
    assert p.in_values("c", [], "All") is None
    assert p.in_values("c", ["All", "a"], "All") is None
    assert p.in_range("v") is None
    df = spark.createDataFrame([(1, 5), (2, 40), (3, None)], "month int, arr_delay int")
    assert df.where(p.all_of([])).count() == 3
    assert df.where(p.delay_filter("arr_delay", (1, 2), 10)).count() == 1
    assert df.where(p.facet_filter(ranges={"arr_delay": (None, 10)})).count() == 1
    assert df.where(p.delay_filter("arr_delay")).count() == 2  # no bound given, no row dropped but the null


@pytest.mark.parametrize("metric", ["arr_delay", "dep_delay"])
def test_unfiltered_delay_report_counts_every_known_delay(spark, metric):
    from scrubjay.plans import reports
    from scrubjay.sources import fixtures
    flights = fixtures.shipments(spark, "/root/testdata/sf0.001")
    assert reports.delay_summary(flights, metric).first().total_flights == flights.where(F.col(metric).isNotNull()).count()


def test_strip_suffix_every_match(spark):
    df = spark.createDataFrame([("One Co. and Two Inc. here",)], "s string")
    assert df.select(t.strip_suffixes("s").alias("x")).first().x == "One and Two here"


@pytest.mark.parametrize("raw,clean", [("Student ID", "student_id"), ("  GPA (pre) ", "gpa_pre"), ("a--B", "a_b"),
                                       ("Größe in cm", "größe_in_cm"), ("2nd try", "_2nd_try"), ("%", "")])
def test_snake_case(raw, clean):
    from scrubjay.sources.files import snake_case
    assert snake_case(raw) == clean
