import __spark_entry__ as E
from sluice.plans.catalog import QUERIES
from sluice.plans.layers import BRONZE_TABLES, REGION_RULES, run_layers, run_test_layers
from sluice.plans.oracle import SQL
from tests.conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["region", "total_revenue", "total_orders", "avg_order_value"]


def test_every_sales_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_layer_run_end_to_end(spark):
    run = run_test_layers(spark, SF_SMALL)
    audit = {(r.layer, r.table_name): r.row_count for r in run.audit.collect()}
    assert audit[("silver", "sales_orders")] == run.store.read("silver", "sales_orders").count()
    assert audit[("gold", "forecast_runs")] == 1
    assert len(audit) == 9
    # measured while writing, equal to the queries
    bronze = {r.table_name: tuple(r)[1:] for r in run.bronze_audit.collect()}
    queried = {f"sales_orders_{r.source}": tuple(r)[1:] for r in QUERIES["bronze_audit"](spark, SF_SMALL).collect()}
    assert bronze == queried
    assert {tuple(r) for r in run.null_profile.collect()} == {tuple(r) for r in QUERIES["null_profile"](spark, SF_SMALL).collect()}


def test_layer_run_twice_is_idempotent(spark, lake):
    first = run_test_layers(spark, SF_SMALL, lake=lake, forecast_model="trend")
    before = first.store.read("silver", "sales_orders").drop("silver_processed_at", "ingested_at")
    n = before.count()
    second = run_test_layers(spark, SF_SMALL, lake=lake, forecast_model="trend")
    after = second.store.read("silver", "sales_orders").drop("silver_processed_at", "ingested_at")
    assert before.exceptAll(after).count() == 0 and after.exceptAll(before).count() == 0
    writes = {(r.layer, r.table_name, r.operation): (r.version, r.row_count) for r in second.writes.collect()}
    assert writes[("silver", "sales_orders", "MERGE")] == (2, n)
    assert writes[("gold", "forecast_runs", "APPEND")] == (0, 2)
    assert second.store.constraints("gold", "revenue_by_region") == REGION_RULES


def test_layer_run_from_csv_files(spark, lake, tmp_path):
    """End to end over a caller's own files, every value of silver and a gold table checked."""
    import datetime as dt

    from sluice.sources.files import read_orders_csv

    header = "order_id,customer_id,customer_name,product_sku,product_name,quantity,unit_price,order_date,region,status"
    (tmp_path / "web").mkdir()
    (tmp_path / "web" / "a.csv").write_text(
        f"{header}\n501,9,  lena ORTIZ ,kx-1,paper lamp,3,12.335,2024-02-10, north ,open\n"
        f"502,8,  ,kx-2,clay pot,1,8.5,2024-03-01,south,  \n"
    )
    shop = spark.createDataFrame(
        [(501, 9, "lena ortiz-vey", "kx-1", "paper lamp", 4, 12.335, dt.date(2024, 2, 11), "north", "done", dt.datetime(2024, 5, 1), "postgres")],
        "order_id int, customer_id int, customer_name string, product_sku string, product_name string, quantity int, "
        "unit_price double, order_date date, region string, status string, ingested_at timestamp, source string",
    )
    run = run_layers(spark, {"web_orders": read_orders_csv(spark, str(tmp_path / "web")), "shop_orders": shop}, lake=lake, forecast_model="trend")
    silver = run.store.read("silver", "sales_orders").drop("ingested_at", "silver_processed_at").orderBy("order_id").collect()
    assert [tuple(r) for r in silver] == [
        (501, 9, "Lena Ortiz-vey", "KX-1", "Paper Lamp", 4, 12.335, dt.date(2024, 2, 11), "NORTH", "DONE", "postgres"),
        (502, 8, None, "KX-2", "Clay Pot", 1, 8.5, dt.date(2024, 3, 1), "SOUTH", None, "csv"),
    ]
    gold = run.store.read("gold", "revenue_by_region").drop("gold_created_at").orderBy("region").collect()
    assert [tuple(r) for r in gold] == [("NORTH", 49.34, 1, 49.34), ("SOUTH", 8.5, 1, 8.5)]
    assert run.store.read("bronze", "web_orders").count() == 2


def test_bad_gold_is_never_current(spark, lake):
    import datetime as dt

    import pytest

    refund = spark.createDataFrame(
        [(7, 1, "a", "s", "p", 1, -3.0, dt.date(2024, 1, 1), "WEST", "OPEN", dt.datetime(2024, 5, 1), "csv")],
        "order_id int, customer_id int, customer_name string, product_sku string, product_name string, quantity int, "
        "unit_price double, order_date date, region string, status string, ingested_at timestamp, source string",
    )
    with pytest.raises(Exception, match="revenue_positive"):
        run_layers(spark, {BRONZE_TABLES[0]: refund}, lake=lake)
    from sluice.operators.tables import TableStore

    assert not TableStore(spark, lake).exists("gold", "revenue_by_region")
