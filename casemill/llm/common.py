"""What several operators share: the shared folder, worker-side file access, skew-safe joins."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these six ASCII characters.
SPACES = "\t\n\x0b\x0c\r"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the file system that Spark takes it for, so that workers take the same."""
    fs, p = _hadoop(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share (``spark.checkpoint.dir``).

    Only where all runs on one machine may the session have none: a temporary folder then becomes the
    checkpoint folder of this context.  On a cluster that is an error, since each executor would write
    to its own disk.
    """
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    base = spark.conf.get("spark.checkpoint.dir", None) or (known.get() if known.isDefined() else None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="casemill-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        base = f"file://{path}"
    if not known.isDefined():
        sc.setCheckpointDir(base)
    return qualified(spark, base)


#: Folders that were made for intermediate data, oldest first.
MADE: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder of this application's intermediate data, which goes when the application ends."""
    folder = f"{shared_dir(spark)}/casemill-{spark.sparkContext.applicationId}"
    fs, p = _hadoop(spark, folder)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    MADE.append(f"{folder}/{name}-{uuid.uuid4().hex}")
    return MADE[-1]


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Deletes intermediate data that nothing reads any more."""
    for path in paths:
        fs, p = _hadoop(spark, path)
        fs.delete(p, True)
        if path in MADE:
            MADE.remove(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    It cuts the lineage like a checkpoint, but later readers still prune its columns.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_fs(uri: str):
    """(filesystem, path) of pyarrow for a local path or any URI that it knows."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


class Held:
    """What a Python worker holds from task to task: one thing at a time, so that idle workers stay small."""

    key = value = None

    @classmethod
    def of(cls, key, make):
        if cls.key != key:
            cls.drop()
            cls.key, cls.value = key, make()
        return cls.value

    @classmethod
    def drop(cls) -> None:
        cls.key = cls.value = None


BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with batches of bounded size, so that long texts don't pile up on either side.

    A smaller limit that the session has stays.
    """
    conf = df.sparkSession.conf
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = conf.get(key, None) or ""
        if not now.rstrip("b").isdigit() or not 0 < int(now.rstrip("b")) <= most:
            conf.set(key, str(most))
    return df.mapInArrow(run, schema)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row, even within lambdas."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Runs of ``[^\\x20\\x09-\\x0D]`` of a text; none for null."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(spaced, " "), "")


def hot_join(left: DataFrame, right: DataFrame, keys: list[str], spread: list[str], *, salts: int = 128, hot: int = 1024, least: int = 64) -> DataFrame:
    """Left join on ``keys`` (null-safe) where ``right`` has at most one row for a key.

    The at most ``hot`` commonest keys of ``left`` are dealt over ``salts`` partitions by the columns
    ``spread``, which tell their rows apart, and by the partition that a row comes from, which deals out
    rows that are equal; their rows of ``right`` are repeated as often.  Every other key holds less than
    1/``hot`` of the rows.  Only that list of keys is broadcast, so the broadcast has a fixed bound.
    Both are the same when a task runs again, so it deals alike.
    """
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    ks = [f"_k{i}" for i in range(len(keys))]
    common = (
        left.groupBy(*named).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
        .orderBy(F.desc("_n"), *ks).limit(hot).select(*ks, F.lit(True).alias("_hot"))
    )

    def marked(df: DataFrame) -> DataFrame:
        cond = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, ks, strict=True)]
        return df.join(F.broadcast(common), cond, "left").drop(*ks)

    l = marked(left).withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64(*spread, F.spark_partition_id()), F.lit(salts)).cast("int")).otherwise(0)).drop("_hot")
    r = (
        marked(right)
        .withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
        .drop("_hot").select(*named, F.col("_salt").alias("_s"), *[c for c in right.columns if c not in keys])
    )
    cond = [F.col("_salt") == F.col("_s")] + [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, ks, strict=True)]
    return l.join(r, cond, "left").drop("_salt", "_s", *ks)


FILTER_BITS = 1 << 26


def maybe_among(keys: DataFrame, key: Column, own: Column) -> Column:
    """False only for rows whose hash ``own`` (a long) is that of no row of ``keys`` (``key`` there).

    A Bloom filter of two bits for each key, made with DataFrame functions and read as a scalar
    subquery: a row of at most 8 MB, whatever the number of keys.  With more keys than it has room for
    it lets more rows through, and no key is lost.
    """
    spark, n = keys.sparkSession, keys.count()
    bits = 1 << 10
    while bits < min(16 * n, FILTER_BITS):
        bits *= 2
    places = lambda h: (h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1)))
    one = F.lit(1).cast("long")
    bit = lambda b: F.call_function("shiftleft", one, b.bitwiseAND(F.lit(63)).cast("int"))
    marks = keys.select(F.explode(F.array(*places(key))).alias("b")).groupBy(F.shiftright("b", 6).alias("w")).agg(F.bit_or(bit(F.col("b"))).alias("v"))
    words = spark.range(bits >> 6).join(marks, F.col("id") == F.col("w"), "left").select("id", F.coalesce("v", F.lit(0).cast("long")).alias("v"))
    table = words.agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias("a")).select(F.col("a")["v"].alias("a")).scalar()
    has = lambda b: F.element_at(table, (F.shiftright(b, 6) + 1).cast("int")).bitwiseAND(bit(b)) != 0
    first, second = places(own)
    return has(first) & has(second)
