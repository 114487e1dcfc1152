"""Session defaults and the shared scratch folder.

The library never tunes a caller's session.  ``local_session`` exists for
tests, the benchmark and notebooks; on a cluster the caller brings its own
session, with adaptive execution on (Spark's default).
"""

from __future__ import annotations

import tempfile
import uuid
from gc import collect as drop_garbage

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_LOCAL_WORKSPACE = "larder.local.workspace"


def local_session(cores: int | str = 8, app: str = "larder", **conf: str) -> SparkSession:
    """A single-JVM session with UTC time and a few shuffle partitions."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.driver.extraJavaOptions": "-Xss8m",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def workspace(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    ``spark.checkpoint.dir`` is read from the session.  Only a local master may
    do without it: a machine-local folder is lost together with its executor.
    """
    shared = spark.conf.get(_CHECKPOINT_DIR, None)
    if shared:
        return shared.rstrip("/")
    known = spark.conf.get(_LOCAL_WORKSPACE, None)
    if known:
        return known
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder all executors share")
    created = tempfile.mkdtemp(prefix="larder-")
    spark.conf.set(_LOCAL_WORKSPACE, created)
    spark.sparkContext.setCheckpointDir(f"{created}/checkpoints")
    return created


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the workspace."""
    return f"{workspace(spark)}/larder/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` to the workspace and reading it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    frame = spark.read.schema(df.schema).parquet(path)
    frame._larder_path = path
    return frame


def bucketed(df: DataFrame, name: str, column: str, buckets: int) -> DataFrame:
    """Write ``df`` to the workspace, dealt by a column, as a table of which Spark knows that: joins on it do not move it again."""
    spark = df.sparkSession
    path, table = scratch_path(spark, name), f"larder_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, column)
    dealt.write.bucketBy(buckets, column).sortBy(column).option("path", path).saveAsTable(table)
    frame = spark.table(table)
    frame._larder_path, frame._larder_table = path, table
    return frame


def stored(frame: DataFrame) -> bool:
    """Whether ``frame`` is what ``materialise`` or ``bucketed`` wrote, as it is."""
    return bool(getattr(frame, "_larder_path", None))


def discard(frame: DataFrame) -> None:
    """Delete what ``materialise`` wrote for a frame that nothing reads any more; other frames are left alone."""
    path = getattr(frame, "_larder_path", None)
    if getattr(frame, "_larder_table", None):
        frame.sparkSession.sql(f"drop table if exists {frame._larder_table}")
    if path:
        jvm, spark = frame.sparkSession._jvm, frame.sparkSession
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of frames that are no longer referred to.

    They go when the driver's garbage is collected, which on a large heap may be long after the frames are gone.
    """
    drop_garbage()
    spark.sparkContext._jvm.System.gc()
