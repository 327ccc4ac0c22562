import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from sluice.operators.dedup import align_and_union, dedup_by_priority, source_overlap
from sluice.plans.silver import build_silver, silver_orders
from sluice.sources import testdata
from tests.conftest import SF_SMALL

D = dt.date


def _row(source, oid, cid, name, sku, prod, qty, price, day, region, status):
    return Row(order_id=oid, customer_id=cid, customer_name=name, product_sku=sku, product_name=prod,
               quantity=qty, unit_price=price, order_date=day, region=region, status=status,
               ingested_at=dt.datetime(2026, 1, 1), source=source)


@pytest.fixture()
def sources(spark):
    web = spark.createDataFrame([
        _row("csv", 71, 5, "noor el-amin", "tx-9", "garden hose", 6, 14.25, D(2023, 4, 30), " north shore", "open"),
        _row("csv", 88, 6, "  TOMAS lindqvist", "TX-2", "PAINT ROLLER", 1, 7.5, D(2023, 5, 2), "HARBOUR", "Paid"),
        _row("csv", 90, 7, "ines duarte", "tx-4", "Step Ladder", 2, 59.99, D(2023, 5, 9), "Old Town", "sent"),
        _row("csv", 90, 7, "ines duarte", "tx-4", "Step Ladder", 3, 59.99, D(2023, 5, 9), "Old Town", "sent"),
    ])
    shop = spark.createDataFrame([
        _row("postgres", 88, 6, "tomas lindqvist", "tx-2", "wide paint roller", 2, 8.0, D(2023, 5, 3), "harbour", "returned"),
        _row("postgres", 71, 5, "noor el-amin", "tx-9", "hose reel", 1, 31.0, D(2023, 4, 30), "north shore", "open"),
        _row("postgres", 95, 8, "yuki mori", "tx-7", "wood glue", 12, 3.15, D(2023, 6, 1), "hill side", "open"),
    ])
    return web, shop


def _by_id(df):
    return {r["order_id"]: r for r in df.collect()}


def test_every_value_of_the_silver_rows(sources):
    got = build_silver(*sources).drop("ingested_at", "silver_processed_at").orderBy("order_id").collect()
    assert [tuple(r) for r in got] == [
        (71, 5, "Noor El-amin", "TX-9", "Hose Reel", 1, 31.0, D(2023, 4, 30), "NORTH SHORE", "OPEN", "postgres"),
        (88, 6, "Tomas Lindqvist", "TX-2", "Wide Paint Roller", 2, 8.0, D(2023, 5, 3), "HARBOUR", "RETURNED", "postgres"),
        # two rows of one source: the smaller quantity comes first in the default tie-break
        (90, 7, "Ines Duarte", "TX-4", "Step Ladder", 2, 59.99, D(2023, 5, 9), "OLD TOWN", "SENT", "csv"),
        (95, 8, "Yuki Mori", "TX-7", "Wood Glue", 12, 3.15, D(2023, 6, 1), "HILL SIDE", "OPEN", "postgres"),
    ]


def test_silver_types_are_declared(spark, sources):
    from sluice.schema import SILVER_SCHEMA

    declared = {f.name: f.dataType.simpleString() for f in SILVER_SCHEMA.fields}
    assert dict(build_silver(*sources).dtypes) == declared
    wide = sources[0].withColumn("order_id", F.col("order_id") + 3_000_000_000)
    assert min(_by_id(build_silver(wide))) == 3_000_000_071
    text = sources[0].withColumn("quantity", F.lit("a few"))
    with pytest.raises(Exception, match="column quantity"):
        build_silver(text).collect()


def test_silver_processed_at_never_null(sources):
    assert build_silver(*sources).filter(F.col("silver_processed_at").isNull()).count() == 0


def test_blank_name_and_status_become_null(spark):
    df = spark.createDataFrame([
        _row("csv", 1, 1, "   ", " sku-1 ", "x", 1, 1.0, D(2025, 1, 1), " goa ", "  "),
        _row("csv", 2, 1, "", "sku-2", "  ", 1, 1.0, D(2025, 1, 1), "goa", "ok"),
    ])
    rows = _by_id(build_silver(df))
    assert rows[1]["customer_name"] is None and rows[1]["status"] is None
    assert rows[1]["region"] == "GOA" and rows[1]["product_sku"] == "SKU-1"
    # product_name is not in the blank list: trimmed to '' but kept
    assert rows[2]["product_name"] == "" and rows[2]["customer_name"] is None


def test_initcap_splits_on_space_only(spark):
    df = spark.createDataFrame([_row("csv", 1, 1, "o'neil mc-donald  x", "a", "b", 1, 1.0, D(2025, 1, 1), "r", "s")])
    assert build_silver(df).first()["customer_name"] == "O'neil Mc-donald  X"


def test_null_keys_collapse_to_one_row(spark):
    df = spark.createDataFrame([
        _row("csv", None, 1, "a", "s", "p", 1, 1.0, D(2025, 1, 1), "r", "x"),
        _row("csv", None, 2, "b", "s", "p", 1, 1.0, D(2025, 1, 1), "r", "x"),
        _row("postgres", None, 3, "c", "s", "p", 1, 1.0, D(2025, 1, 1), "r", "x"),
    ], "order_id long, customer_id long, customer_name string, product_sku string, product_name string, "
       "quantity long, unit_price double, order_date date, region string, status string, "
       "ingested_at timestamp, source string")
    out = build_silver(df).collect()
    assert len(out) == 1 and out[0]["customer_id"] == 3


def test_same_frame_twice_gives_one_row_per_key(sources):
    csv, _ = sources
    out = build_silver(csv, csv)
    assert out.count() == 3 and out.select("order_id").distinct().count() == 3


def test_ties_within_source_are_deterministic(spark):
    rows = [_row("csv", 1, i, f"n{i}", "s", "p", 1, 1.0, D(2025, 1, 1), "r", "x") for i in (3, 1, 2)]
    df = spark.createDataFrame(rows)
    for n in (1, 3, 7):
        assert build_silver(df.repartition(n)).first()["customer_id"] == 1


def test_unknown_and_null_source_rank_after_master(spark):
    schema = ("order_id long, customer_id long, customer_name string, product_sku string, product_name string, "
              "quantity long, unit_price double, order_date date, region string, status string, "
              "ingested_at timestamp, source string")
    df = spark.createDataFrame([
        _row(None, 1, 1, "a", "s", "p", 1, 1.0, D(2025, 1, 1), "r", "x"),
        _row("api", 1, 2, "a", "s", "p", 1, 1.0, D(2025, 1, 1), "r", "x"),
        _row("postgres", 1, 3, "a", "s", "p", 1, 1.0, D(2025, 1, 1), "r", "x"),
    ], schema)
    assert build_silver(df).first()["customer_id"] == 3


def test_union_drops_created_at_and_widens_decimal(spark, sources):
    csv, pg = sources
    pg2 = pg.withColumn("unit_price", F.col("unit_price").cast("decimal(10,2)")).withColumn(
        "created_at", F.current_timestamp())
    out = build_silver(csv, pg2)
    assert "created_at" not in out.columns
    assert dict(out.dtypes)["unit_price"] == "double"


def test_union_is_strict_about_extra_columns(spark, sources):
    csv, pg = sources
    with pytest.raises(Exception):
        align_and_union([csv, pg.withColumn("extra", F.lit(1))]).collect()


def test_dedup_by_priority_generic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 5)], "k int, v string, p int")
    out = dedup_by_priority(df, ["k"], [F.col("p").asc()]).orderBy("k").collect()
    assert [(r.k, r.v) for r in out] == [(1, "a"), (2, "c")]


def test_overlap_matches_null_keys(spark):
    a = spark.createDataFrame([(1,), (None,), (2,)], "order_id int")
    b = spark.createDataFrame([(None,), (2,), (2,)], "order_id int")
    assert sorted(source_overlap(a, b).collect(), key=lambda r: (r[0] is not None, r[0] or 0)) == [(None,), (2,)]


def test_dedup_early_plan_equals_union_then_dedup(spark):
    clock = F.lit(dt.datetime(2026, 1, 1))
    fast = silver_orders(spark, SF_SMALL, clock=clock)
    slow = build_silver(
        testdata.bronze_source(spark, SF_SMALL, "csv", clock),
        testdata.bronze_source(spark, SF_SMALL, "postgres", clock),
        tiebreak=list(testdata.TIEBREAK),
        drop_after=testdata.TIEBREAK,
        clock=clock,
    )
    assert fast.columns == slow.columns
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0


def test_dedup_limits_groups_before_the_shuffle(spark, capsys):
    silver_orders(spark, SF_SMALL).explain("formatted")
    plan = capsys.readouterr().out
    assert "WindowGroupLimit" in plan and "Partial" in plan
