import os

from covey import storage


def test_stored_tables_are_read_again_and_cleared(spark):
    storage.clear(spark)
    kept = storage.stored(spark.range(10).withColumnRenamed("id", "x"), "numbers")
    assert kept.count() == 10 and kept.inputFiles()[0].startswith("file:")
    assert storage.clear(spark) == 1 and storage.clear(spark) == 0


def test_runtime_filters_are_set_back(spark):
    before = {k: spark.conf.get(k, None) for k in storage.RUNTIME_FILTERS}
    with storage.runtime_filters(spark):
        assert all(spark.conf.get(k) == v for k, v in storage.RUNTIME_FILTERS.items())
    assert {k: spark.conf.get(k, None) for k in storage.RUNTIME_FILTERS} == before


def test_scratch(spark):
    with storage.scratch(spark):
        kept = storage.stored(spark.range(5), "kept", keep=True)
        with storage.scratch(spark):
            gone = storage.stored(spark.range(3), "gone")
            inner = storage.stored(gone.union(gone), "inner", keep=True)
        assert inner.count() == 6 and not os.path.exists(gone.inputFiles()[0].removeprefix("file://"))
        files = inner.inputFiles()
    assert kept.count() == 5 and not os.path.exists(files[0].removeprefix("file://"))
