"""Session helpers shared by operators and queries."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` of a data folder."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir. Only a session in one process may do without; it gets a folder of its own."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if known:
        return known
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    own = tempfile.mkdtemp(prefix="panelforge-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    return f"file://{own}"


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared checkpoint folder and go on from there: lineage is cut and a lost executor loses nothing.

    With spark.cleaner.referenceTracking.cleanCheckpoints set, Spark removes what no frame refers to any more.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application, as --py-files would."""
    context = spark.sparkContext
    if getattr(context, "_panelforge_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp()) / "panelforge.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._panelforge_shipped = True


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df over all cores where its files give fewer tasks than there are cores; rows go by a hash, so a rerun puts them alike.

    For work in Python that costs far more than moving its rows: a handful of small files would otherwise be a handful of tasks.
    """
    parallel = df.sparkSession.sparkContext.defaultParallelism
    have = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if have >= parallel else df.repartition(2 * parallel, *by)
