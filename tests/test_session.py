from pathlib import Path

from stridelake import session


def test_intermediate_tables_go_to_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    copy = session.materialize(spark.range(5), "copy")
    assert session.shared_dir(spark).startswith(root)
    assert all(f.replace("file://", "").startswith(root) for f in copy.inputFiles())
    assert copy.count() == 5 and copy.columns == ["id"]


def test_scratch_can_be_dropped(spark):
    session.materialize(spark.range(5), "gone")
    session.drop_scratch(spark)
    assert not Path(session.shared_dir(spark)).exists()


def test_local_session_without_setting_uses_a_temporary_folder(spark, monkeypatch):
    class Unset:
        sparkContext = spark.sparkContext

        class conf:
            get = staticmethod(lambda key, default: default)

    first = session.shared_dir(Unset)
    assert first == session.shared_dir(Unset) and Path(first).parent.exists()
