"""Session set-up and the shared folder for intermediate tables."""

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_OWNED: ContextVar[str | None] = ContextVar("owned", default=None)


def local_session(cores="*", app="namewright", **conf):
    """A session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    root = context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    root = tempfile.mkdtemp(prefix="namewright-")
    context.setCheckpointDir(root)
    return context.getCheckpointDir().rstrip("/")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder path below the shared root or the ``scratch`` block's folder, never used before."""
    return f"{_OWNED.get() or shared_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, name: str = "scratch"):
    """A block whose staged tables lie in one new folder, which is removed at its end.

    DataFrames that read them must be used up within the block: ``with scratch(spark):
    build_dataset(files, path)["splits"].show()``. Tables staged outside of a block stay.
    """
    folder = shared_folder(spark, name)
    token = _OWNED.set(folder)
    try:
        yield folder
    finally:
        _OWNED.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` once as a table in the shared folder and read it back.

    Cuts the lineage, survives lost executors, and lets each later pass read
    only the columns it needs. The job runs at once, while the plan around it is
    still being made; see ``scratch`` for who removes the table. ``options`` are those of the Parquet writer.
    """
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
