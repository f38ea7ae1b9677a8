"""Session helper for tests and bench, and the shared scratch folder of the running session."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def own_folder():
    """New folder of this process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="tapework-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def local_session(app, cores="*", shuffle_partitions=8, memory="8g"):
    """Session for tests and bench on one machine; a cluster brings its own session and folder."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.checkpoint.dir", own_folder())
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark):
    """Folder every executor can read: ``spark.checkpoint.dir`` of the session.

    Only a local master may fall back to a folder of its own, which ends with the process; on a cluster
    a missing setting is an error, because a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(own_folder())
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark, label):
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage_table(df, label):
    """Write ``df`` once to the shared folder and return the written table.

    Cuts the lineage: several readers share one evaluation, a lost executor costs only a re-read,
    and later plans see real sizes and prune columns in the Parquet scan. Only the writer reads it, after it is done, so it
    has no success marker: Hadoop's local file system starts a process on the driver for each.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


def unstage(table):
    """Delete the files of a table of ``stage_table`` that no plan will read again."""
    path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.staged_at)
    path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
