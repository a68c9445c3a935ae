from types import SimpleNamespace

import pytest

from gaugeline.session import REQUIRED_CONF, configure, scratch_dir


def fake(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: conf.get(name, default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_settings(spark):
    assert {name: spark.conf.get(name) for name in REQUIRED_CONF} == REQUIRED_CONF
    assert configure(spark) is spark


def test_scratch_is_where_the_cluster_says():
    shared = {"spark.checkpoint.dir": "hdfs:///shared/tmp/"}
    first, second = (scratch_dir(fake("yarn", **shared), "log") for _ in range(2))
    assert first.startswith("hdfs:///shared/tmp/log-") and first != second


def test_no_machine_local_scratch_on_a_cluster():
    with pytest.raises(RuntimeError):
        scratch_dir(fake("spark://host:7077"), "log")
    assert scratch_dir(fake("local[2]"), "log")
