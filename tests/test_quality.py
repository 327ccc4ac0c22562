from pyspark.sql import functions as F
import datetime as dt


from sluice.operators import quality as qa
from sluice.operators.cleaning import enforce_types, nullify_blanks, schema_diff, with_order_value
from sluice.schema import SILVER_SCHEMA


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert {tuple(r) for r in qa.null_profile(df, ["a", "b"]).collect()} == {("a", 1), ("b", 2)}


def test_distinct_values_sorted_with_null(spark):
    df = spark.createDataFrame([("B",), (None,), ("A",), ("B",)], "s string")
    assert [r.s for r in qa.distinct_values(df, "s").collect()] == [None, "A", "B"]


def test_dedup_audit_and_overlap_from_one_frame(spark):
    from sluice.operators.dedup import overlap_within

    df = spark.createDataFrame(
        [(1, "csv"), (1, "postgres"), (2, "csv"), (2, "csv"), (None, "csv"), (None, "postgres"), (3, None)], "k int, source string")
    r = qa.dedup_audit(df, "k", "source", "csv", "postgres").first()
    assert (r.rows_before, r.rows_after, r.rows_removed, r.overlapping_keys) == (7, 4, 3, 2)
    assert {r.k for r in overlap_within(df, "k", "source", "csv", "postgres").collect()} == {1, None}
    none = qa.dedup_audit(df.limit(0), "k", "source", "csv", "postgres").first()
    assert tuple(none) == (0, 0, 0, 0)


def test_single_scan_audit_counts_null_groups(spark):
    from sluice.operators.dedup import dedup_counted

    rows = [(1, "csv", "a"), (1, "postgres", None), (2, "csv", "a"), (3, "csv", "b"), (3, "csv", "a"), (None, "csv", "z"), (None, "csv", "y")]
    df = spark.createDataFrame(rows, "order_id int, source string, g string")
    kept = dedup_counted(df, labels={"csv": "c", "postgres": "p"})
    # kept: (1, NULL), (2, a), (3, a), (NULL, y)
    out = qa.single_scan_audit(kept, ["c", "p"], "s", {"g": F.col("g")})
    assert [tuple(r) for r in out.collect()] == [("BRONZE", "c", 6), ("BRONZE", "p", 1), ("GOLD", "g", 3), ("SILVER", "s", 4)]
    nothing = dedup_counted(df.limit(0), labels={"csv": "c", "postgres": "p"})
    assert {r.row_count for r in qa.single_scan_audit(nothing, ["c", "p"], "s", {"g": F.col("g")}).collect()} == {0}


def test_dedup_as_an_aggregate_keeps_the_rows_of_the_window(spark):
    import random

    from sluice.operators.dedup import dedup_counted, dedup_sources

    draw = random.Random(2)
    rows = [(draw.choice([None, *range(12)]), draw.choice(["csv", "postgres", "web", None]), draw.choice([None, "x", "y"]), draw.randrange(3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "order_id int, source string, a string, b int").repartition(7)
    counted = dedup_counted(df, labels={"csv": "n_csv", "postgres": "n_pg"})
    window = dedup_sources(df)
    assert sorted(map(tuple, counted.select(df.columns).collect()), key=repr) == sorted(map(tuple, window.collect()), key=repr)
    assert counted.agg(F.sum("n_csv"), F.sum("n_pg")).first() == (sum(r[1] == "csv" for r in rows), sum(r[1] == "postgres" for r in rows))
    tied = dedup_counted(df, tiebreak=["b"])
    assert tied.count() == 13 and tied.columns == df.columns


def test_a_hot_key_sends_one_row_per_task(spark):
    from sluice.operators.dedup import dedup_counted

    df = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("order_id"), F.lit("csv").alias("source"), F.col("id").alias("v"))
    plan = dedup_counted(df, labels={"csv": "n"})
    shuffled = plan.where("order_id = 7")
    assert shuffled.first().n == 10_001 and shuffled.first().v == 0
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and text.count("partial_min") == 1

def test_layer_audit_order(spark):
    out = qa.layer_audit({("SILVER", "s"): spark.range(2), ("BRONZE", "b"): spark.range(5), ("GOLD", "g"): spark.range(1)})
    assert [tuple(r) for r in out.collect()] == [("BRONZE", "b", 5), ("GOLD", "g", 1), ("SILVER", "s", 2)]


def test_bronze_audit(spark):
    D = dt.date
    df = spark.createDataFrame(
        [(1, D(2025, 1, 2), "A", "csv"), (None, D(2025, 1, 1), "B", "csv"), (2, D(2025, 3, 1), "A", "postgres")],
        "order_id int, order_date date, region string, source string")
    rows = {r.source: r for r in qa.bronze_audit(df).collect()}
    assert rows["csv"].row_count == 2 and rows["csv"].null_order_ids == 1 and rows["csv"].unique_regions == 2
    assert rows["csv"].earliest_order == D(2025, 1, 1) and rows["postgres"].latest_order == D(2025, 3, 1)


def test_schema_diff(spark):
    a = spark.createDataFrame([(1, "x")], "order_id int, created_at string")
    b = spark.createDataFrame([(1, 2.0)], "order_id int, extra double")
    rows = {(r.column_name, r.side, r.data_type) for r in schema_diff(spark, a, b).collect()}
    assert rows == {("created_at", "left_only", "string"), ("extra", "right_only", "double")}


def test_enforce_types_fails_or_nulls(spark):
    import pytest

    df = spark.createDataFrame([("7", "oops", "2025-01-02")], "order_id string, quantity string, order_date string")
    out = enforce_types(df, SILVER_SCHEMA, bad_values="null").first()
    assert out.order_id == 7 and out.quantity is None and out.order_date == dt.date(2025, 1, 2)
    with pytest.raises(Exception, match="column quantity"):
        enforce_types(df, SILVER_SCHEMA).collect()
    with pytest.raises(ValueError):
        enforce_types(df, SILVER_SCHEMA, bad_values="drop")


def test_enforce_types_keeps_ids_beyond_32_bits(spark):
    import pytest

    from sluice.schema import sales_orders_schema

    df = spark.createDataFrame([(3_000_000_000, None), (None, 1)], "order_id long, quantity int")
    assert [r.order_id for r in enforce_types(df, SILVER_SCHEMA).collect()] == [3_000_000_000, None]
    with pytest.raises(Exception, match="column order_id"):
        enforce_types(df, sales_orders_schema()).collect()


def test_nullify_blanks_only_listed_columns(spark):
    df = spark.createDataFrame([("  ", "  ", " x ")], "customer_name string, product_name string, status string")
    r = nullify_blanks(df).first()
    assert r.customer_name is None and r.product_name == "  " and r.status == " x "


def test_order_value_rounds_to_cents(spark):
    df = spark.createDataFrame([(3, 0.335)], "quantity int, unit_price double")
    assert with_order_value(df).first().order_value == 1.01


def test_source_summary_sql(spark):
    D = dt.date
    df = spark.createDataFrame(
        [(D(2025, 1, 1), "A", "csv"), (D(2025, 2, 1), "B", "csv"), (D(2024, 5, 1), "A", "postgres"), (D(2023, 1, 1), "C", "other")],
        "order_date date, region string, source string")
    rows = {r.table_name: r for r in qa.source_summary(spark, df, {"csv": "web", "postgres": "shop"}).collect()}
    assert set(rows) == {"web", "shop"}
    assert rows["web"].row_count == 2 and rows["web"].unique_regions == 2
    assert rows["shop"].earliest_order == D(2024, 5, 1)
