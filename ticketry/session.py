"""Session settings the operators count on, and the shared folder for cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Ticket times carry no zone; one fixed zone keeps every cast a no-op.
    "spark.sql.session.timeZone": "UTC",
    # Re-plan from real sizes: small sides are broadcast, hot join keys split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM interprets methods of more bytes for good; Spark's smaller ones are compiled instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime options on a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "ticketry", **extra: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call-site capture for error messages costs more than building the plan itself.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; only where none is named (tests, one machine) a
    folder of our own. Whoever names the folder clears it, when no query runs."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        folder = tempfile.mkdtemp(prefix="ticketry-tables-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` as a table in the cluster's shared folder, read from there on.

    What several branches of a query read is computed once, and a lost executor costs its own
    tasks only.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/ticketry-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
