"""Session defaults and the one way this package cuts lineage."""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "feedmill", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; a cluster job brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder for data that must outlive an executor.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session,
    where every task runs on this machine, may fall back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="feedmill-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/feedmill-{spark.sparkContext.applicationId}"


_made = threading.local()


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, every copy that ``materialise`` made in it.

    What the block computes has to be written elsewhere before it ends.
    """
    _made.owners = [*getattr(_made, "owners", []), []]
    try:
        yield
    finally:
        for path in _made.owners.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


#: Spark's switch for removing the shuffle files of an action, a write among them, as soon as it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """In the block the shuffle files of each action go when it ends, not only when the driver collects its garbage.

    For blocks whose actions start from copies: a plan that runs a second time makes its shuffle files again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def current_scratch() -> list[str] | None:
    """The innermost block, for threads of a pool to name as the ``owner`` of their copies."""
    owners = getattr(_made, "owners", [])
    return owners[-1] if owners else None


def materialise(df: DataFrame, outlive: int = 0, owner: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Everything downstream then starts from one fixed copy: a lost executor
    costs a re-read, and two branches of a plan cannot see different rows.
    All copies of an application lie in one folder; ``scratch`` removes those of a run.
    A copy belongs to the innermost block, to one as many levels outside as ``outlive`` says, or to ``owner``.
    """
    spark = df.sparkSession
    path = f"{_own_folder(spark)}/{uuid.uuid4().hex}"
    if owner is not None:
        owner.append(path)
    elif len(owners := getattr(_made, "owners", [])) > outlive:
        owners[-1 - outlive].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
