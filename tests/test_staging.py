import os
import time

from tidemark.plans.staging import SHUFFLES_GO, Scratch, staged, unstage


def folder(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file:"))


def test_release_keeps_what_is_still_read(spark):
    scratch = Scratch()
    with scratch.collecting():
        one = staged(spark.range(5), "one")
        two = staged(one.filter("id > 2"), "two")
    other = staged(spark.range(3), "other")
    folders = [folder(df) for df in (one, two, other)]
    scratch.release(spark, reading=two.join(other, "id"))
    assert [os.path.exists(f) for f in folders] == [False, True, True]
    assert two.count() == 2
    scratch.release(spark)
    assert [os.path.exists(f) for f in folders] == [False, False, True]
    scratch.release(spark)


def test_inner_collections_are_their_own(spark):
    outer, inner = Scratch(), Scratch()
    with outer.collecting():
        with inner.collecting():
            staged(spark.range(1), "inner")
        yours = staged(spark.range(1), "outer")
    where = folder(yours)
    inner.release(spark)
    assert os.path.exists(where) and yours.count() == 1
    outer.release(spark)
    assert not os.path.exists(where)


def test_unstage_deletes_what_a_frame_reads(spark):
    one, two = staged(spark.range(5), "one"), staged(spark.range(2), "two")
    folders = [folder(df) for df in (one, two)]
    unstage(one.filter("id > 1"), spark.range(1))
    assert [os.path.exists(f) for f in folders] == [False, True]
    assert two.count() == 2


def _shuffle_files(spark):
    """Data files of shuffles in the executors' local folders."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {name for top in manager.localDirs() for _, _, names in os.walk(top.getPath()) for name in names
            if name.startswith("shuffle_") and name.endswith(".data")}


def test_shuffle_files_go_with_the_write(spark):
    before = _shuffle_files(spark)
    table = staged(spark.range(1000).repartition(3, "id").groupBy("id").count(), "shuffled")
    until = time.time() + 10
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert table.count() == 1000
    assert spark.conf.get(SHUFFLES_GO, None) is None
