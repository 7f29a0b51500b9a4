"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(app: str = "hylle", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        # Wide keyword projections: past this size HotSpot would interpret the
        # generated method, so Spark splits it into smaller ones instead.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``.

    Tables written there can be re-read after an executor is lost, which is why
    a machine-local folder is refused unless the whole session is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="hylle-")
        root = _LOCAL_FOLDERS[app]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialised(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to the shared work folder and read back.

    For results that several branches of a job read and that are costly to make
    again, such as parsed pages.
    """
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
