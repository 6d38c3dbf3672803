"""Session settings and the shared scratch folder."""

import os
import site
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores="*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fleetwright")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Off, PySpark does not record the Python call site of every expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that do not see its folder.

    Spark hands an archive of it to every worker. Nothing is done where the package is
    installed, on PYTHONPATH, or in the folder that local workers start in.
    """
    home, context = Path(__file__).resolve().parents[1], spark.sparkContext
    seen = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), *site.getsitepackages()]
    if context.master.startswith("local["):
        seen.append(os.getcwd())
    if home in [Path(p).resolve() for p in seen if p] or context.applicationId in _SHIPPED:
        return
    archive = Path(tempfile.mkdtemp()) / "fleetwright.zip"
    with zipfile.ZipFile(archive, "w") as zipped:
        for file in sorted((home / "fleetwright").rglob("*.py")):
            zipped.write(file, file.relative_to(home))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names for checkpoints and scratch tables.

    Where none is named it is a folder of the warehouse. A warehouse on a disk of one
    machine serves a local session only: on a cluster the setting has to be made.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir") or ""
    on_one_machine = "://" not in warehouse or warehouse.startswith("file:")
    if on_one_machine and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors reach")
    return f"{warehouse.rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the checkpoint folder and continue from the files.

    Runs a job. The result keeps its partitions and row order when executors
    are lost, which a recomputed range shuffle would not.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()
