from types import SimpleNamespace

import pytest

from reviewmart import workspace


def _session(named=None, set_folder=None, master="local[2]"):
    made = []
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: made[0] if made else set_folder,
        setCheckpointDir=made.append,
    )
    conf = SimpleNamespace(get=lambda key, default: named)
    return SimpleNamespace(conf=conf, sparkContext=context), made


def test_the_clusters_folder_is_used():
    session, made = _session(named="hdfs:///shared/", master="yarn")
    assert workspace.shared_folder(session) == "hdfs:///shared"
    assert not made


def test_own_folder_only_where_none_is_set():
    session, made = _session(set_folder="/already")
    assert workspace.shared_folder(session) == "/already" and not made
    session, made = _session()
    assert workspace.shared_folder(session) == made[0]


def test_no_machine_local_folder_on_a_cluster():
    session, _ = _session(master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_folder(session)


def test_cut_keeps_rows_and_types(spark):
    df = spark.sql("select 1L as a, 'x' as b, timestamp '2020-01-01 00:00:00' as c")
    back = workspace.cut(df, "t")
    assert back.dtypes == df.dtypes and back.collect() == df.collect()
