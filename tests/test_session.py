import os

import pytest

from salesq.session import cut_lineage, materialize, path_exists, scratch


def test_scratch_removes_what_was_written_inside(spark):
    with scratch(spark):
        inside = cut_lineage(spark.range(5))
        assert inside.count() == 5
        folder = os.path.dirname(inside.inputFiles()[0])
        assert path_exists(spark, folder)
    assert not path_exists(spark, folder)
    outside = cut_lineage(spark.range(3))
    assert path_exists(spark, os.path.dirname(outside.inputFiles()[0]))


def test_stored_table_is_rebuilt_when_its_source_changes(spark, tmp_out):
    source = os.path.join(tmp_out, "source")
    spark.range(2).write.parquet(os.path.join(source, "t.parquet"))

    def get():
        return materialize(spark, f"test.t:{source}", lambda: spark.read.parquet(os.path.join(source, "t.parquet"))).count()
    assert get() == get() == 2
    spark.range(7).write.mode("overwrite").parquet(os.path.join(source, "t.parquet"))
    spark.range(1).write.parquet(os.path.join(source, "u.parquet"))
    assert get() == 7


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    from salesq import session
    monkeypatch.setattr(session, "checkpoint_dir", lambda s: None)

    class Cluster:
        class sparkContext:
            master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster())


def test_fingerprints_tell_inputs_apart(spark, tmp_out):
    from salesq.session import fingerprint
    a, b = (spark.createDataFrame([(x,)], "v int") for x in (1, 2))
    assert fingerprint(a) != fingerprint(b) and fingerprint(a) == fingerprint(a) != fingerprint(a, limit=1)
    a.write.csv(f"{tmp_out}/t", header=True)

    def read():
        return spark.read.option("header", True).csv(f"{tmp_out}/t")
    assert fingerprint(read()) == fingerprint(read()) != fingerprint(read().filter("v > 0"))
    before = fingerprint(read())
    b.write.mode("append").csv(f"{tmp_out}/t", header=True)
    assert fingerprint(read()) != before


def test_stored_tables_are_not_shuffled_once_more(spark, tmp_out):
    source = os.path.join(tmp_out, "source")
    spark.range(1).write.parquet(os.path.join(source, "t.parquet"))
    stored = materialize(spark, f"test.files:{source}", lambda: spark.range(30, numPartitions=3))
    assert len(stored.inputFiles()) == 3 and stored.count() == 30         # a file a task of the plan's last stage


def test_remembered_results_are_built_anew_when_a_table_is_gone(spark, tmp_out):
    from salesq.session import delete_path, remember
    source, built = os.path.join(tmp_out, "source"), []

    def build():
        built.append(cut_lineage(spark.range(4)))
        return built[-1].filter("id > 0")

    def get():
        return remember(spark, f"test.r:{source}", build, lambda r: r).count()
    assert get() == get() == 3 and len(built) == 1
    delete_path(spark, os.path.dirname(built[0].inputFiles()[0]))
    assert get() == 3 and len(built) == 2
    spark.range(1).write.parquet(os.path.join(source, "t.parquet"))       # the source changed
    assert get() == 3 and len(built) == 3
