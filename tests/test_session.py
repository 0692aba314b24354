from types import SimpleNamespace

import pytest

from lakewright.session import shared_root, shuffle_partitions, sql_text


def fake(master, **settings):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(fake("spark://head:7077"))
    assert shared_root(fake("spark://head:7077", **{"spark.checkpoint.dir": "s3a://bucket/x/"})) == "s3a://bucket/x"


def test_a_local_session_gets_one_folder_of_its_own():
    session = fake("local[2]")
    assert shared_root(session) == shared_root(session)


def test_shuffle_partitions():
    plain = {"spark.sql.shuffle.partitions": "8"}
    assert shuffle_partitions(fake("local", **plain)) == 8
    initial = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "64"}
    assert shuffle_partitions(fake("local", **plain, **initial)) == 64


def test_sql_text(spark):
    for text in ("plain", "it's", "back\\slash"):
        assert spark.sql(f"SELECT {sql_text(text)}").first()[0] == text
