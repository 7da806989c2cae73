"""SparkSession construction for jobs, tests and the benchmark.

On a cluster the session already exists (spark-submit / notebook); ``get_spark``
then only fills in settings that the cluster left unset. Locally it builds a
``local[N]`` session sized for the test data.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every fjord job relies on. Oracle comparison needs UTC and
# timestamp_ntz-preserving reads; AQE re-plans shuffles and splits skewed joins.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "fjord",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session, creating a local one when none exists."""
    active = SparkSession.getActiveSession()
    if active is not None:
        fill_unset(active)
        return active
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    builder = builder.config("spark.driver.memory", os.environ.get("FJORD_DRIVER_MEMORY", "8g"))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def fill_unset(spark: SparkSession) -> None:
    """Apply fjord's SQL defaults that the session (a cluster's) left unset.

    ``conf.get(key, None)`` is None only for keys nobody set, so a value the
    cluster chose is never overridden; static settings (UI) are skipped.
    """
    for k, v in _DEFAULTS.items():
        if spark.conf.isModifiable(k) and spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set a scratch one only when unset.

    A cluster names a shared folder there. Locally (tests, bench) no such folder
    exists, so a fresh scratch directory stands in for it.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="fjord-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current


def reliable_checkpoint(df):
    """Materialise ``df`` once into the shared checkpoint folder and cut its lineage.

    Used where one intermediate feeds several branches of a plan: the branches
    read the written files instead of recomputing it, and a lost executor costs
    a re-read, not a recomputation from the source. Never a local checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per Spark application, wherever the driver imports it from."""
    sc = spark.sparkContext
    if getattr(sc, "_fjord_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="fjord-zip-"), "fjord_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(target)  # Spark hands it to every executor
    sc._fjord_shipped = True
