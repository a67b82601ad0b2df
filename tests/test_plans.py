"""What the physical plans must and must not hold."""

from sparkprep import COMPLAINTS
from sparkprep.operators import categories, profile
from sparkprep.sources import tables
from sparkprep.sources.tables import complaints, table

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_profiles_scan_once(spark):
    orders = table(spark, SF_DIR, "orders")
    for df in (
        profile.missing_report(orders),
        profile.approx_unique_profile(orders),
        categories.category_counts(orders, orders.columns),
    ):
        assert plan(df).count("FileScan") == 1


def test_columns_are_pruned(spark):
    text = plan(profile.missing_report(table(spark, SF_DIR, "lineitem").select("l_returnflag")))
    assert "ReadSchema: struct<l_returnflag:string>" in text


def test_counts_are_combined_before_the_shuffle(spark):
    df = table(spark, SF_DIR, "orders").select("o_orderstatus")
    text = plan(categories.category_counts(df, ["o_orderstatus"]))
    assert text.index("Exchange") < text.index("partial_count")


def test_unneeded_tables_are_not_read(spark):
    assert plan(complaints(spark, SF_DIR, "complaint_id", COMPLAINTS.target)).count("FileScan") == 1


def test_null_filter_reaches_the_scan(spark):
    df = table(spark, SF_DIR, "orders").where("o_orderpriority is null").select("o_orderkey")
    assert "IsNull(o_orderpriority)" in plan(df)


def test_documents_are_read_as_they_lie(spark):
    assert "Exchange" not in plan(tables.documents(spark, SF_DIR))
