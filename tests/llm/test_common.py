import pytest
from pyspark.sql import functions as F

from casemill.llm import common
from casemill.llm.common import hot_join, let, words


def test_hot_join_is_a_left_join(spark):
    rows = [(1, i) for i in range(500)] + [(None, i) for i in range(300)] + [(k, 0) for k in range(2, 40)] + [(1, 7)] * 3
    left = spark.createDataFrame(rows, "k int, x int").repartition(5)
    right = spark.createDataFrame([(1, "a"), (None, "n"), (3, "c"), (99, "z")], "k int, v string")
    for hot, least in ((1024, 64), (1, 1), (1024, 10**6)):
        got = hot_join(left, right, ["k"], ["x"], hot=hot, least=least, salts=7)
        assert got.columns == ["k", "x", "v"]
        want = sorted(map(str, ((k, x, {1: "a", None: "n", 3: "c"}.get(k)) for k, x in rows)))
        assert sorted(str(tuple(r)) for r in got.collect()) == want


def test_words_and_let(spark):
    df = spark.createDataFrame([(" a\tb\x0bc\x0cd\re\nf  g ",), (None,), ("",), ("é x",)], "t string").select(words(F.col("t")).alias("w"), let(words(F.col("t")), lambda w: F.size(w) + F.size(w)).alias("n"))
    assert [(r.w, r.n) for r in df.collect()] == [(list("abcdefg"), 14), ([], 0), ([], 0), (["é x"], 2)]


def test_filter_loses_no_key(spark, monkeypatch):
    """Also with far more keys than bits, with none, and with negative hashes."""
    keys = spark.range(0, 30_000, 3).select(F.xxhash64("id").alias("k"))
    rows = spark.range(30_000)
    for bits in (1 << 26, 1 << 10):
        monkeypatch.setattr(common, "FILTER_BITS", bits)
        found = rows.where(common.maybe_among(keys, F.col("k"), F.xxhash64("id")))
        assert found.where("id % 3 = 0").count() == 10_000
        assert bits == 1 << 10 or found.count() < 10_800
    none = spark.createDataFrame([], "k long")
    assert rows.where(common.maybe_among(none, F.col("k"), F.xxhash64("id"))).count() == 0


def test_equal_rows_of_a_hot_key_are_dealt(spark):
    """Rows that no column tells apart go to several partitions, by where they come from."""
    left = spark.createDataFrame([(1, "same")] * 4000 + [(None, "null")] * 4000 + [(i, "x") for i in range(2, 50)], "k long, v string").repartition(8)
    right = spark.createDataFrame([(1, "a"), (None, "b"), (7, "c")], "k long, w string")
    out = common.hot_join(left, right, ["k"], ["v"])
    assert sorted(map(str, (tuple(r) for r in out.groupBy("k", "w").count().where("count > 1").collect()))) == ["(1, 'a', 4000)", "(None, 'b', 4000)"]
    assert out.where("w = 'c'").count() == 1 and out.count() == left.count()
    salts = left.withColumn("s", F.pmod(F.xxhash64("v", F.spark_partition_id()), F.lit(128)))
    assert salts.where("k = 1").select("s").distinct().count() > 3


def test_a_cluster_needs_a_shared_folder(spark):
    class Context:
        master = "spark://host:7077"

        class _jsc:
            @staticmethod
            def sc():
                return Context

        @staticmethod
        def getCheckpointDir():
            return Context

        @staticmethod
        def isDefined():
            return False

    class Session:
        sparkContext = Context

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        common.shared_dir(Session)
    from casemill import session

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        session.shared_folder(Session)
