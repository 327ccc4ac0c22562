"""Where layers live and how they are stored.

One frozen dataclass replaces an environment switch: a lake is either a set of
directories under ``root`` (path mode) or a set of catalog databases named
``<prefix>bronze`` / ``<prefix>silver`` / ``<prefix>gold`` (catalog mode).
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class LakeConfig:
    """Storage settings for one lake.

    ``root``: base directory of data files (both modes). ``table_format``: file format of table data (``parquet`` or
    ``orc``). ``database_prefix``: set to also expose tables in the catalog.
    """

    root: str
    table_format: str = "parquet"
    database_prefix: str | None = None

    @property
    def catalog_mode(self) -> bool:
        return self.database_prefix is not None

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
        return f"{self.database_prefix or ''}{layer}"

    def location(self, layer: str, name: str) -> str:
        """Directory of a path-mode table, or the catalog name of a table."""
        if self.catalog_mode:
            return f"{self.database(layer)}.{name}"
        return f"{self.root.rstrip('/')}/{layer}/{name}"


def create_namespaces(spark: SparkSession, cfg: LakeConfig) -> None:
    """K9: one database per layer (catalog mode only)."""
    if not cfg.catalog_mode:
        return
    for layer in LAYERS:
        location = f"{cfg.root.rstrip('/')}/{cfg.database(layer)}.db"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {cfg.database(layer)} LOCATION '{location}'")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Every job that writes intermediate tables writes under this folder, so the
    files survive the loss of any executor. A folder is created only when none is
    set on a ``local`` master (tests); on a cluster the setting is required.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        return path
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="sluice-ckpt-"))
    return sc.getCheckpointDir()


def fresh_lake(spark: SparkSession, label: str = "lake") -> LakeConfig:
    """A new, empty lake under the shared folder (one per run); Spark's writers create the folders."""
    return LakeConfig(root=f"{shared_dir(spark).rstrip('/')}/sluice/{label}-{uuid.uuid4().hex[:12]}")


def remove_lake(spark: SparkSession, lake: LakeConfig) -> None:
    """Delete all files of a lake, on whatever file system it lies."""
    path = spark._jvm.org.apache.hadoop.fs.Path(lake.root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
