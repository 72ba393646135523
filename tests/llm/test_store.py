import time

from quarry.llm import store


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_what_is_written_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = spark.range(10_000).selectExpr("id % 97 as k", "id")
    out = store.written(rows.groupBy("k").sum("id"), "test")
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert out.count() == 97


def test_the_session_keeps_its_setting(spark):
    for mine in (None, "false", "true"):
        if mine is None:
            spark.conf.unset(store._CLEANUP)
        else:
            spark.conf.set(store._CLEANUP, mine)
        had = spark.conf.get(store._CLEANUP)
        try:
            store.written(spark.range(5), "test")
            assert spark.conf.get(store._CLEANUP) == had
        finally:
            spark.conf.unset(store._CLEANUP)
