"""Session set-up, the shared scratch folder, and shipping the package to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()
_local_roots: dict[str, str] = {}


def get_session(app_name: str = "vecloom", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the settings the jobs here want; everything can be overridden by `conf`."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # One BLAS thread per Python worker: Spark supplies the parallelism.
        "spark.executorEnv.OMP_NUM_THREADS": "1",
        "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
        "spark.executorEnv.TOKENIZERS_PARALLELISM": "false",
        **(conf or {}),
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            settings.setdefault("spark.driver.host", "127.0.0.1")
            settings.setdefault("spark.driver.bindAddress", "127.0.0.1")
            settings.setdefault("spark.ui.enabled", "false")
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    archive = Path(tempfile.mkdtemp(prefix="vecloom-py-")) / "vecloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(_PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(_PACKAGE.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, from `spark.checkpoint.dir`.

    Only a local master may run without it; the folder is then a fresh temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_roots.setdefault(context.applicationId, tempfile.mkdtemp(prefix="vecloom-"))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; never one that was used before."""
    return os.path.join(shared_root(spark), f"vecloom-{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    This evaluates an expensive column once and cuts the lineage: a lost executor later
    re-reads files and does not run the encoder again. Being a plain table scan, the result
    allows pruning and pushdown.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread a plain scan whose rows lie in fewer splits than cores over all cores before heavy work.

    Splits without rows don't count: Spark cuts a file by its bytes, but a row group goes to one
    split whole. For scans only: it runs a job that reads no column, which would run the shuffles
    of a plan that has any. A table with enough splits is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    used = df.select(F.spark_partition_id().alias("split")).distinct().count()
    return df.repartition(cores) if used < cores else df


def dealt(df: DataFrame, less: int = 0) -> DataFrame:
    """`df` with its rows dealt out evenly to four tasks a core (`less` fewer), for work far dearer than moving them.

    Splits as they come won't do: some may be empty, and a few more than cores leave cores idle at the end.
    """
    return df.repartition(max(1, 4 * df.sparkSession.sparkContext.defaultParallelism - less))
