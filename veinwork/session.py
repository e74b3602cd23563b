"""Session helpers shared by the operators."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and benches; on a cluster bring your own."""
    session = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("veinwork")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


# Bytes of a method beyond which HotSpot leaves it to the interpreter.
COMPILED_BYTES = 8_000


def compile_wide(spark: SparkSession) -> None:
    """Let stages over many columns run as several methods where the one method of a whole stage would
    be longer than the JVM compiles: interpreted, such a stage takes several times as long."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > COMPILED_BYTES:
        spark.conf.set(name, COMPILED_BYTES)


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """This application's place in the folder that spark.checkpoint.dir names, which every
    executor can read. It may be deleted once the application is done.

    Without that setting only a local master may fall back to a temporary folder.
    """
    application = spark.sparkContext.applicationId
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if application not in _local_folders:
            _local_folders[application] = tempfile.mkdtemp(prefix="veinwork-")
        folder = _local_folders[application]
    return f"{folder.rstrip('/')}/veinwork-{application}"


def durable(df: DataFrame) -> DataFrame:
    """Write a result out once as a table in the shared folder and go on from there.

    For results that several later steps read: they scan columns of a file instead of
    recomputing, and the files outlive a lost executor, which a cached copy would not. Also for
    fitted tables that rows are joined with: Spark knows the bytes of a stored table, and
    broadcasts it below its threshold only.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid4().hex}"
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(*tables: DataFrame) -> None:
    """Delete tables that `durable` gave, after their last reader has stored its own result."""
    for table in tables:
        hadoop = table.sparkSession.sparkContext._jvm.org.apache.hadoop.fs
        path = hadoop.Path(table.stored_at)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
