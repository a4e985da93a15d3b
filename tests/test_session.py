"""Settings that follow the input, and the shared folder."""

from types import SimpleNamespace

import pytest

from parcelyard import session


def test_partitions_follow_the_input(spark, tmp_path, monkeypatch):
    (tmp_path / "part").write_bytes(b"x" * 4096)
    before = spark.conf.get(session.INITIAL_PARTITIONS, None)
    try:
        session.prepare(spark, str(tmp_path))
        assert spark.conf.get(session.INITIAL_PARTITIONS, None) == before
        monkeypatch.setattr(session, "PARTITION_BYTES", 1024)
        session.prepare(spark, str(tmp_path))
        assert spark.conf.get(session.INITIAL_PARTITIONS) == "16"
        monkeypatch.setattr(session, "MOST_PARTITIONS", 10)
        session.prepare(spark, str(tmp_path))
        assert spark.conf.get(session.INITIAL_PARTITIONS) == "16"
        assert {k: spark.conf.get(k) for k in session.TUNED} == {
            k: ours for k, (_, ours) in session.TUNED.items()
        }
    finally:
        spark.conf.unset(session.INITIAL_PARTITIONS)


def test_scan_tasks_fold_what_fits(spark, tmp_path, monkeypatch):
    (tmp_path / "part").write_bytes(b"x" * 4096)
    spark.conf.unset(session.SPLIT)
    try:
        session.prepare(spark, str(tmp_path))
        assert spark.conf.get(session.SPLIT) == f"{session.SPLIT_BYTES}b"
        spark.conf.set(session.SPLIT, "7MB")
        session.prepare(spark, str(tmp_path))
        assert spark.conf.get(session.SPLIT) == "7MB"
    finally:
        spark.conf.unset(session.SPLIT)


def test_shared_folder_is_the_named_one(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_only_a_local_session_makes_its_own_folder():
    def unnamed(master):
        made = []
        context = SimpleNamespace(
            master=master,
            getCheckpointDir=lambda: made[-1] if made else None,
            setCheckpointDir=made.append,
        )
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(unnamed("spark://head:7077"))
    local = unnamed("local[8]")
    assert session.shared_folder(local) == session.shared_folder(local)
