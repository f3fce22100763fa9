"""Session settings and the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "casemill", **settings: str) -> SparkSession:
    """A session with UTC, adaptive execution and Kryo; ``settings`` add to or override these."""
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    return SparkSession.builder.appName(name).config(map=conf | settings).getOrCreate()


def own_folder() -> str:
    """A temporary folder of this process, as a URI; it goes when the process ends."""
    path = tempfile.mkdtemp(prefix="casemill-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return f"file://{path}"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where the session has none and all runs on one machine, a temporary folder.

    On a cluster without that setting this is an error, since each executor would write to its own disk.
    """
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    base = spark.conf.get("spark.checkpoint.dir", None) or (known.get() if known.isDefined() else None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = own_folder()
    if not known.isDefined():
        sc.setCheckpointDir(base)
    return base.rstrip("/")  # only Spark reads and writes there, by this name


def fresh(spark: SparkSession, name: str) -> str:
    """A new path in the folder of this application's intermediate data, which goes when the application ends."""
    folder = f"{shared_folder(spark)}/casemill-{spark.sparkContext.applicationId}"
    fs, p = hadoop(spark, folder)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, its lineage cut."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of a path of any scheme."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = hadoop(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = hadoop(spark, old)
    if not fs.rename(p, hadoop(spark, new)[1]):
        raise OSError(f"can't rename {old} to {new}")


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a glob pattern matches, sorted."""
    fs, p = hadoop(spark, pattern)
    return sorted(x.getPath().toString() for x in (fs.globStatus(p) or []))


def size_of(spark: SparkSession, path: str) -> int:
    fs, p = hadoop(spark, path)
    return int(fs.getContentSummary(p).getLength())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, put in place whole: written aside, then renamed over the old one."""
    aside = f"{path}.{uuid.uuid4().hex}"
    fs, p = hadoop(spark, aside)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(p), fs.makeQualified(hadoop(spark, path)[1]), options)


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
