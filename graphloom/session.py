"""Session helpers: a tuned builder for tests and lineage cutting for iterative operators."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def local_session(cores: str = "*", app: str = "graphloom", **conf: str) -> SparkSession:
    """A session for one machine.  On a cluster the caller passes their own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a machine-local
    folder would lose rounds together with the executor that wrote them.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="graphloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, so that they need no installed copy.  Done once for each context."""
    context, package = spark.sparkContext, Path(__file__).resolve().parent
    if getattr(context, "_graphloom_shipped", False):
        return
    # The driver serves this file to the executors; nobody else reads it.
    archive = Path(tempfile.mkdtemp(prefix="graphloom-")) / "graphloom_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._graphloom_shipped = True


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """In this block, the shuffle files of a query go as soon as it has ended, not when the driver next collects its garbage.

    For queries whose rows are written or collected once: running the same DataFrame again would shuffle again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def task_count(spark: SparkSession) -> int:
    """Number of tasks of a shuffle, as the session is set up."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Rounds:
    """Written rounds of an iterative operator.

    Each round goes to its own Parquet folder, so the plan of round n+1 starts at files and stays flat,
    and a lost executor costs at most one round.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.paths: list[str] = []
        self.schema = None

    def add(self, df: DataFrame) -> tuple[DataFrame, int]:
        path = f"{self.base}/{len(self.paths)}"
        seen = Observation()
        # The count rides along with the write, so it costs no job of its own.
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
        self.paths.append(path)
        self.schema = self.schema or df.schema
        return self.spark.read.schema(df.schema).parquet(path), seen.get["n"]

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.paths)


def cut_lineage(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and go on from the files."""
    return Rounds(df.sparkSession, name).add(df)[0]
