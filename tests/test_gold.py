import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.operators import aggregates as agg
from sluice.plans.gold import gold_tables

SCHEMA = ("order_id int, customer_id int, customer_name string, product_sku string, product_name string, "
          "quantity int, unit_price double, order_date date, region string, status string, "
          "ingested_at timestamp, source string, silver_processed_at timestamp")
NOW = dt.datetime(2026, 1, 1)


@pytest.fixture()
def silver(spark):
    D = dt.date

    def row(order, product, quantity, price, day, region, status):
        return (order, 1, "Name", "TX-1", product, quantity, price, day, region, status, NOW, "csv", NOW)

    rows = [
        row(11, "Wood Glue", 3, 4.115, D(2023, 1, 31), "HARBOUR", "OPEN"),  # 12.345: half a cent, rounds up
        row(12, "Wood Glue", 1, 4.115, D(2023, 2, 1), "HARBOUR", "SENT"),
        row(13, "Hose Reel", 2, 30.0, D(2023, 2, 28), "OLD TOWN", "OPEN"),
        row(14, "Step Ladder", 1, 60.0, D(2023, 3, 3), "HILL SIDE", "PENDING"),  # ties with OLD TOWN
        row(None, "Hose Reel", 1, 31.0, D(2023, 3, 4), None, None),  # no order id, region or status
        row(16, None, 5, 2.0, None, "HARBOUR", "CONFIRMED"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return [tuple(r) for r in df.drop("gold_created_at").collect()]


def test_revenue_by_region(silver):
    # ties go by name; NULL is a group whose orders without id do not count
    assert _rows(agg.revenue_by_region(silver)) == [
        ("HILL SIDE", 60.0, 1, 60.0), ("OLD TOWN", 60.0, 1, 60.0), (None, 31.0, 0, None), ("HARBOUR", 26.47, 3, 8.82)]


def test_revenue_by_product(silver):
    assert _rows(agg.revenue_by_product(silver)) == [
        ("Hose Reel", 91.0, 1, 3, 30.5), ("Step Ladder", 60.0, 1, 1, 60.0), ("Wood Glue", 16.47, 2, 4, 4.12), (None, 10.0, 1, 5, 2.0)]


def test_order_status_breakdown(silver):
    assert _rows(agg.order_status_breakdown(silver)) == [
        ("OPEN", 2, 72.35, 36.18), ("CONFIRMED", 1, 10.0, 10.0), ("PENDING", 1, 60.0, 60.0), ("SENT", 1, 4.12, 4.12), (None, 0, 31.0, None)]


def test_monthly_sales_trend(silver):
    assert _rows(agg.monthly_sales_trend(silver)) == [
        (None, 10.0, 1, 10.0), ("2023-01", 12.35, 1, 12.35), ("2023-02", 64.12, 2, 32.06), ("2023-03", 91.0, 1, 91.0)]


def test_gold_created_at_added_last(silver):
    for df in gold_tables(silver).values():
        assert df.columns[-1] == "gold_created_at"
        assert df.filter(F.col("gold_created_at").isNull()).count() == 0


def test_revenue_at_risk(silver):
    r = agg.revenue_at_risk(silver).first()
    assert r["revenue_at_risk"] == 70.0 and r["orders_at_risk"] == 2


def test_revenue_at_risk_empty_is_null(silver):
    r = agg.revenue_at_risk(silver.filter("false")).first()
    assert r["revenue_at_risk"] is None and r["orders_at_risk"] == 0


def test_best_worst_month(silver):
    r = agg.best_worst_month(agg.monthly_sales_trend(silver.filter("order_date IS NOT NULL"))).first()
    assert (r["best_month"], r["best_revenue"], r["worst_month"], r["worst_revenue"]) == ("2023-03", 91.0, "2023-01", 12.35)


def test_best_worst_ties_go_to_earliest_month(spark):
    m = spark.createDataFrame([("2025-02", 5.0, 1), ("2025-01", 5.0, 1)], "year_month string, monthly_revenue double, total_orders long")
    r = agg.best_worst_month(m).first()
    assert r["best_month"] == "2025-01" and r["worst_month"] == "2025-01"


def test_all_null_ids_give_null_mean_not_error(spark, silver):
    df = silver.withColumn("order_id", F.lit(None).cast("int"))
    r = agg.revenue_by_region(df).first()
    assert r["total_orders"] == 0 and r["avg_order_value"] is None and r["total_revenue"] is not None


def test_half_cent_sums_are_exact(spark):
    # 0.1 + 0.2 style drift must not leak into totals; sums are exact decimals
    rows = [(i, 1, "n", "s", "p", 1, 0.1, dt.date(2025, 1, 1), "R", "PENDING", NOW, "csv", NOW) for i in range(30)]
    rows += [(100, 1, "n", "s", "p", 1, 0.2, dt.date(2025, 1, 1), "R", "PENDING", NOW, "csv", NOW)]
    r = agg.revenue_by_region(spark.createDataFrame(rows, SCHEMA)).first()
    assert r["total_revenue"] == 3.2 and r["avg_order_value"] == 0.1


def test_single_pass_gold_equals_four_aggregates(spark, silver):
    import datetime as _dt

    from pyspark.sql import functions as _F

    from sluice.plans.gold import gold_tables_single_pass
    from sluice.plans.silver import silver_orders
    from tests.conftest import SF_SMALL

    clock = _F.lit(_dt.datetime(2026, 1, 1))
    for src in (silver, silver_orders(spark, SF_SMALL)):
        a, b = gold_tables(src, clock), gold_tables_single_pass(src, clock)
        for name in a:
            assert a[name].columns == b[name].columns
            assert a[name].collect() == b[name].collect()  # same rows in the same order


def test_sql_text_route_over_a_temp_view(spark, silver):
    # A temp view queried with SQL text gives the same rollup as the DataFrame operator
    silver.createOrReplaceTempView("silver_updates")
    sql = spark.sql("""
        SELECT region,
               CAST(SUM(CAST(ROUND(unit_price * quantity, 2) AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
               COUNT(order_id) AS total_orders
        FROM silver_updates GROUP BY region""")
    api = agg.revenue_by_region(silver).select("region", "total_revenue", "total_orders")
    assert set(sql.collect()) == set(api.collect()) and sql.count() == api.count()
    spark.catalog.dropTempView("silver_updates")


def _random_orders(spark, draw, ids, source="csv"):
    rows = [
        (i, draw.choice([None, "NORTH", "SOUTH", "EAST"]), draw.choice(["Lamp", "Pot", None]), draw.choice(["OPEN", "DONE", None]),
         draw.choice([None, dt.date(2024, draw.randrange(1, 13), 3)]), draw.choice([None, 1, 2, 7]), draw.choice([None, 1.005, 12.335, 99.99]))
        for i in ids
    ]
    return spark.createDataFrame(rows, "order_id int, region string, product_name string, status string, order_date date, quantity int, unit_price double")


def _without_stamp(tables):
    return {name: sorted(map(tuple, df.drop("gold_created_at").collect()), key=repr) for name, df in tables.items()}


def test_gold_kept_up_to_date_equals_a_full_rebuild(spark):
    import random

    from sluice.operators.tables import merge_changes, merge_upsert
    from sluice.plans.gold import gold_sums, gold_tables, gold_tables_of, with_changes

    draw = random.Random(11)
    silver = _random_orders(spark, draw, [None, *range(25)])
    sums = gold_sums(silver)
    for _ in range(3):
        ids = draw.sample(range(40), 12) + ([None] if draw.random() < 0.5 else [])
        updates = _random_orders(spark, draw, ids)
        changes = gold_sums(merge_changes(silver, updates, ["order_id"]), change="change")
        sums = spark.createDataFrame(with_changes(sums, changes).collect(), sums.schema)
        merged = merge_upsert(silver, updates, ["order_id"])
        silver = spark.createDataFrame(merged.select(silver.columns).collect(), silver.schema)
        assert _without_stamp(gold_tables_of(sums)) == _without_stamp(gold_tables(silver))


def test_a_group_without_rows_goes_and_sums_of_nothing_are_null(spark):
    from sluice.operators.tables import merge_changes
    from sluice.plans.gold import gold_sums, gold_tables_of, with_changes

    ddl = "order_id int, region string, product_name string, status string, order_date date, quantity int, unit_price double"
    silver = spark.createDataFrame([(1, "NORTH", "Lamp", "OPEN", None, 2, 3.0), (2, "SOUTH", "Lamp", "OPEN", None, 1, 1.0)], ddl)
    moved = spark.createDataFrame([(1, "EAST", "Lamp", "DONE", None, None, None)], ddl)
    sums = with_changes(gold_sums(silver), gold_sums(merge_changes(silver, moved, ["order_id"]), change="change"))
    tables = _without_stamp(gold_tables_of(sums))
    assert tables["revenue_by_region"] == [("EAST", None, 1, None), ("SOUTH", 1.0, 1, 1.0)]
    assert tables["order_status_breakdown"] == [("DONE", 1, None, None), ("OPEN", 1, 1.0, 1.0)]


def test_changes_read_each_side_once(spark, tmp_path):
    from sluice.operators.tables import merge_changes

    for name in ("t", "u"):
        spark.range(10).withColumnRenamed("id", "k").write.parquet(str(tmp_path / name))
    changes = merge_changes(spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "u")), ["k"])
    assert sorted((r.k, r.change) for r in changes.collect()) == sorted((k, c) for k in range(10) for c in (1, -1))
    assert changes._jdf.queryExecution().executedPlan().toString().count("FileScan") >= 2
