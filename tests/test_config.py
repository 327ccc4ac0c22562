import pytest

from sluice.config import LakeConfig, fresh_lake, shared_dir
from sluice.operators.tables import TableStore


def test_locations_path_and_catalog():
    p = LakeConfig(root="/lake/")
    assert p.location("gold", "t") == "/lake/gold/t" and not p.catalog_mode
    c = LakeConfig(root="/lake", database_prefix="sales_")
    assert c.location("silver", "orders") == "sales_silver.orders" and c.catalog_mode
    with pytest.raises(ValueError):
        c.database("platinum")


def test_shared_dir_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir())


class _Context:
    """A context whose settings name no checkpoint folder."""

    def __init__(self, master):
        self.master, self.dir = master, None

    def getConf(self):
        return {}

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path + "/run"


class _Session:
    conf = {}

    def __init__(self, master):
        self.sparkContext = _Context(master)


def test_shared_dir_with_the_setting_absent(tmp_path, monkeypatch):
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    local = _Session("local[2]")
    first = shared_dir(local)
    assert first.startswith(str(tmp_path)) and shared_dir(local) == first
    with pytest.raises(RuntimeError):
        shared_dir(_Session("spark://host:7077"))


def test_shared_dir_on_a_clean_session():
    """A session of its own, in a process whose Spark defaults name no folder."""
    import subprocess
    import sys

    code = (
        "from pyspark.sql import SparkSession\n"
        "from sluice.config import fresh_lake, remove_lake, shared_dir\n"
        "from sluice.operators.tables import TableStore\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "lake = fresh_lake(s)\n"
        "store = TableStore(s, lake)\n"
        "store.write('bronze', 't', s.range(3))\n"
        "assert store.read('bronze', 't').count() == 3\n"
        "remove_lake(s, lake)\n"
        "assert not store.exists('bronze', 't')\n"
        "print('dir', shared_dir(s))\n"
    )
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "SPARK_CONF_DIR": "/nonexistent", "PYTHONPATH": root}
    run = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0 and "sluice-ckpt-" in run.stdout, run.stderr[-800:]


def test_fresh_lakes_are_distinct(spark):
    a, b = fresh_lake(spark), fresh_lake(spark)
    assert a.root != b.root and a.root.startswith(shared_dir(spark).rstrip("/"))


def test_orc_tables_and_bad_format(spark, lake):
    orc = LakeConfig(root=lake.root, table_format="orc")
    store = TableStore(spark, orc)
    store.write("bronze", "t", spark.range(4))
    assert store.read("bronze", "t").count() == 4
    with pytest.raises(ValueError):
        TableStore(spark, LakeConfig(root=lake.root, table_format="delta"))
