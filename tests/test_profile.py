import pytest
from pyspark.sql import functions as F

from sparkprep import COMPLAINTS
from sparkprep.operators import profile, validate


def as_dict(df, key, *values):
    return {r[key]: tuple(r[v] for v in values) for r in df.collect()}


@pytest.fixture
def gaps(spark):
    return spark.createDataFrame(
        [(1, "a", None), (2, None, None), (3, "", None), (4, "N/A", "x")], "id int, s string, t string"
    )


def test_only_null_is_missing(gaps):
    found = as_dict(profile.missing_report(gaps), "column", "total_row", "missing_row", "missing_percentage")
    assert found == {"id": (4, 0, 0.0), "s": (4, 1, 25.0), "t": (4, 3, 75.0)}


def test_empty_table_has_no_percentage(spark):
    empty = spark.createDataFrame([], "a int, b string")
    assert as_dict(profile.missing_report(empty), "column", "total_row", "missing_percentage") == {
        "a": (0, None),
        "b": (0, None),
    }
    assert as_dict(profile.unique_profile(empty), "column", "n_unique", "missing_percentage") == {
        "a": (0, None),
        "b": (0, None),
    }
    assert profile.approx_unique_profile(empty).count() == 2


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (3, None), (4, "x"), (5, "x")], "a int, b string")
    report = profile.missing_report(df)
    assert profile.high_missing(report, 0.4).count() == 0
    assert profile.high_missing(report, 0.39).count() == 1


def test_odd_column_names(spark):
    df = spark.createDataFrame([(1, None)], "`a.b` int, `c``d` string")
    assert as_dict(profile.missing_report(df), "column", "missing_row") == {"a.b": (0,), "c`d": (1,)}
    assert as_dict(profile.unique_profile(df), "column", "n_unique") == {"a.b": (1,), "c`d": (1,)}


def test_unique_counts_null_once(spark):
    df = spark.createDataFrame(
        [("a", [1]), (None, [1]), ("a", None), (None, [2]), ("b", [1])], "s string, l array<int>"
    )
    expected = {"s": (3, 2, 40.0), "l": (3, 1, 20.0)}
    columns = ("n_unique", "missing_row", "missing_percentage")
    assert as_dict(profile.unique_profile(df), "column", *columns) == expected
    assert as_dict(profile.approx_unique_profile(df), "column", *columns) == expected


def test_approx_is_near_exact(spark):
    df = spark.range(20_000).select((F.col("id") % 5000).alias("v"))
    (row,) = profile.approx_unique_profile(df, rsd=0.02).collect()
    assert abs(row["n_unique"] - 5000) < 500


def test_schema_table(gaps):
    rows = profile.schema_table(gaps).orderBy("position").collect()
    assert [(r["name"], r["type"]) for r in rows] == [("id", "int"), ("s", "string"), ("t", "string")]


def test_shape(gaps):
    assert tuple(profile.shape(gaps).first()) == (4, 3)


def test_reject_and_accept(gaps):
    reasons = validate.columns_to_reject(gaps, ["id", "absent"])
    assert reasons == {"id": "unwanted column", "t": "contains many missing values"}
    rejected = validate.rejected_columns(gaps, reasons, key="id")
    assert rejected.columns == ["id", "t", "error_msg"]
    assert rejected.count() == gaps.count()
    assert "t: contains many missing values" in rejected.first()["error_msg"]
    assert validate.accepted_columns(gaps, reasons).columns == ["s"]
    assert validate.accepted_columns(gaps, reasons, keep=["id"]).columns == ["id", "s"]


def test_required_columns(gaps):
    assert validate.require_columns(gaps, ["id", "s"]) is gaps
    with pytest.raises(validate.MissingColumnsError) as error:
        validate.require_columns(gaps, COMPLAINTS.required)
    assert error.value.missing == list(COMPLAINTS.required)


def test_labelled(gaps):
    assert validate.labelled(gaps, "t").count() == 1


def test_schema_roles():
    assert COMPLAINTS.required == (
        "consumer_disputed",
        "company_response",
        "consumer_consent_provided",
        "submitted_via",
        "issue",
        "date_sent_to_company",
        "date_received",
    )
    assert COMPLAINTS.assembled_inputs == (
        "tf_company_response",
        "tf_consumer_consent_provided",
        "tf_submitted_via",
        "im_diff_in_days",
        "tf_issue",
    )
    assert len(COMPLAINTS.declared) == 12
