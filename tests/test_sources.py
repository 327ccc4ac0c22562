import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluice.schema import SALES_ORDERS_SCHEMA, WIDE_SALES_ORDERS_SCHEMA
from sluice.sources import jdbc_options, postgres_url, read_orders_csv, write_orders_csv
from sluice.sources import testdata
from tests.conftest import SF_SMALL

HEADER = "order_id,customer_id,customer_name,product_sku,product_name,quantity,unit_price,order_date,region,status"


def _write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_fixed_schema_and_provenance(spark, tmp_path):
    p = _write(tmp_path / "a.csv", HEADER + "\n1,10,priya nair,SKU-1,Belt,2,25000.5,2025-10-01,Goa,pending\n")
    clock = F.lit(dt.datetime(2026, 1, 1))
    df = read_orders_csv(spark, p, clock=clock)
    r = df.first()
    assert df.schema.fields[:10] == SALES_ORDERS_SCHEMA.fields
    assert r.unit_price == 25000.5 and r.order_date == dt.date(2025, 10, 1)
    assert r.source == "csv" and r.ingested_at == dt.datetime(2026, 1, 1)


def test_csv_bad_value_becomes_null_row_kept(spark, tmp_path):
    p = _write(tmp_path / "b.csv", HEADER + "\n1,10,a,b,c,two,1.0,2025-10-01,r,s\n")
    r = read_orders_csv(spark, p).first()
    assert r.quantity is None and r.order_id == 1


def test_csv_reordered_header_fails(spark, tmp_path):
    cols = HEADER.split(",")
    cols[5], cols[6] = cols[6], cols[5]
    p = _write(tmp_path / "c.csv", ",".join(cols) + "\n1,10,a,b,c,1.0,2,2025-10-01,r,s\n")
    with pytest.raises(Exception):
        read_orders_csv(spark, p).collect()


def test_csv_infer_schema_opt_in(spark, tmp_path):
    p = _write(tmp_path / "d.csv", HEADER + "\n1,10,a,b,c,2,1.5,2025-10-01,r,s\n")
    df = read_orders_csv(spark, p, infer_schema=True)
    assert dict(df.dtypes)["quantity"] == "int" and dict(df.dtypes)["unit_price"] == "double"


def test_csv_round_trip_keeps_padding(spark, lake):
    src = testdata.bronze_source(spark, SF_SMALL, "csv").select(*[f.name for f in WIDE_SALES_ORDERS_SCHEMA.fields])
    path = f"{lake.root}/rt"
    write_orders_csv(src, path)
    back = read_orders_csv(spark, path, WIDE_SALES_ORDERS_SCHEMA).drop("ingested_at", "source")
    assert back.exceptAll(src).count() == 0 and src.exceptAll(back).count() == 0


def test_jdbc_options_single_and_parallel():
    url = postgres_url("db", 5432, "sales")
    assert url == "jdbc:postgresql://db:5432/sales"
    one = jdbc_options(url, "sales_orders", user="u", password="p", driver="org.postgresql.Driver")
    assert one["dbtable"] == "sales_orders" and "partitionColumn" not in one
    par = jdbc_options(url, "sales_orders", partition_column="order_id", lower_bound=1, upper_bound=500, num_partitions=4)
    assert (par["partitionColumn"], par["lowerBound"], par["upperBound"], par["numPartitions"]) == ("order_id", "1", "500", "4")
    with pytest.raises(ValueError):
        jdbc_options(url, "t", partition_column="order_id")


def test_read_postgres_builds_a_partitioned_reader(spark, monkeypatch):
    from sluice.sources import jdbc

    seen = {}

    class Reader:
        def format(self, f):
            seen["format"] = f
            return self

        def options(self, **o):
            seen.update(o)
            return self

        def load(self):
            return spark.range(1).withColumnRenamed("id", "order_id")

    monkeypatch.setattr(type(spark), "read", property(lambda self: Reader()))
    df = jdbc.read_postgres(spark, "db", 5432, "sales", "u", "p", partition_column="order_id",
                            lower_bound=1, upper_bound=500, num_partitions=4)
    assert seen["format"] == "jdbc" and seen["url"] == "jdbc:postgresql://db:5432/sales"
    assert seen["numPartitions"] == "4" and seen["driver"] == "org.postgresql.Driver"
    assert df.first().source == "postgres"


def test_bronze_sources_split_by_line(spark):
    both = testdata.bronze_orders(spark, SF_SMALL)
    csv = testdata.bronze_source(spark, SF_SMALL, "csv")
    pg = testdata.bronze_source(spark, SF_SMALL, "postgres")
    assert csv.count() + pg.count() == both.count()
    assert {r.source for r in csv.select("source").distinct().collect()} == {"csv"}


BROKEN = (
    HEADER
    + "\n1,10,a,b,c,2,1.5,2025-10-01,r,s\n2,10,a,b,c,two,1.5,2025-10-01,r,s\nx3,10,a,b,c,2,1.5,2025-10-01,r,s\n"
    + "4,10,a,b,c,2,1.5,2025-13-41,r,s\n5,10,a,b,c,2\n6,10,a,b,c,2,1.5,2025-10-01,r,s,more\n,,,,,,,,,\n7,,,,,,,,,\n"
)


def test_lines_that_do_not_fit_are_kept_apart(spark, tmp_path, lake):
    from sluice.operators.tables import TableStore
    from sluice.sources import land_orders_csv

    store = TableStore(spark, lake)
    landing = land_orders_csv(store, "bronze", "orders", _write(tmp_path / "a.csv", BROKEN))
    assert landing == (3, 5)
    accepted = store.read("bronze", "orders")
    assert accepted.columns == [*SALES_ORDERS_SCHEMA.fieldNames(), "ingested_at", "source"]
    assert sorted((r.order_id for r in accepted.collect()), key=str) == [1, 7, None]
    rejected = {r.rejected_record.split(",")[0]: r for r in store.read("bronze", "orders_rejected").collect()}
    assert sorted(rejected) == ["2", "4", "5", "6", "x3"]
    assert rejected["2"].quantity is None and rejected["2"].unit_price == 1.5  # what could be read
    # the next load replaces both
    assert land_orders_csv(store, "bronze", "orders", _write(tmp_path / "b.csv", BROKEN.split("2,10")[0])) == (1, 0)
    assert store.read("bronze", "orders_rejected").count() == 0
    # without the record column, bad values are NULL as before
    assert read_orders_csv(spark, str(tmp_path / "a.csv")).count() == 8


def test_every_line_of_a_broken_file_is_in_one_of_the_tables(spark, lake):
    from sluice.operators.tables import TableStore
    from sluice.sources import land_orders_csv

    bronze = testdata.bronze_orders(spark, SF_SMALL)
    columns = [F.col(c).cast("string").alias(c) for c in SALES_ORDERS_SCHEMA.fieldNames()]
    broken = bronze.select(*columns).withColumn("unit_price", F.when(F.col("product_sku") < " sku-000100", F.lit("n/a")).otherwise(F.col("unit_price")))
    write_orders_csv(broken, f"{lake.root}/files")
    lines = spark.read.text(f"{lake.root}/files").where("value NOT LIKE 'order_id,%'").count()
    landing = land_orders_csv(TableStore(spark, lake), "bronze", "orders", f"{lake.root}/files", WIDE_SALES_ORDERS_SCHEMA)
    assert landing.rejected == broken.where("unit_price = 'n/a'").count() > 0
    assert landing.accepted + landing.rejected == lines == bronze.count()


def test_a_file_is_loaded_once(spark, tmp_path, lake):
    import os

    from sluice.operators.tables import TableStore
    from sluice.sources import append_new_files

    store = TableStore(spark, lake)
    inbox = tmp_path / "in box"
    inbox.mkdir()
    row = "{},10,a,b,c,2,1.5,2025-10-01,r,s\n"
    _write(inbox / "a.csv", HEADER + "\n" + row.format(1) + row.format(2))
    _write(inbox / "b.csv", HEADER + "\n" + row.format(3))

    def load():
        return append_new_files(store, "bronze", "orders", str(inbox))

    def ids():
        return sorted(r.order_id for r in store.read("bronze", "orders").collect())

    assert load() == 2 and ids() == [1, 2, 3]
    assert load() == 0 and ids() == [1, 2, 3] and len(store.writes) == 1
    _write(inbox / "c.csv", HEADER + "\n" + row.format(4) + row.format(4))
    assert load() == 1 and ids() == [1, 2, 3, 4, 4]
    # the parts of the table: one per load that found something
    assert [p.rows for p in store._newest("bronze", "orders")[1]] == [3, 2]
    # a file written anew is a new file
    _write(inbox / "b.csv", HEADER + "\n" + row.format(5))
    os.utime(inbox / "b.csv", (2_000_000_000, 2_000_000_000))
    assert load() == 1 and ids() == [1, 2, 3, 4, 4, 5]
    assert store.read("bronze", "orders").select("source_file").distinct().count() == 3


def test_catalog_table_by_name(spark, lake):
    from sluice.config import LakeConfig, create_namespaces
    from sluice.operators.tables import TableStore
    from sluice.sources import read_catalog_table

    cat = LakeConfig(root=lake.root, database_prefix="s4_" + lake.root.rsplit("-", 1)[-1][:8] + "_")
    create_namespaces(spark, cat)
    TableStore(spark, cat).write("silver", "t", spark.range(4))
    assert read_catalog_table(spark, cat.location("silver", "t")).count() == 4
