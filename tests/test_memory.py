import hashlib
import random
from collections import OrderedDict, defaultdict

import pytest
from helpers import plan, rows

from gaugeline.operators import memory
from gaugeline.operators.memory import dedup_last_n
from gaugeline.schemas import READING_KEY

SENT = "station_id long, s_no long, partition int, offset long, payload string"


def lane(row, lanes):
    id_ = dict(zip(("station_id", "s_no"), row))
    parts = "-".join(str(id_[k]) for k in READING_KEY if id_[k] is not None)
    return int(hashlib.md5(parts.encode()).hexdigest()[:8], 16) % lanes


def by_a_loop(sent, size, lanes):
    kept, memories = [], defaultdict(OrderedDict)
    for row in sorted(sent, key=lambda r: (r[2], r[3])):
        known = memories[lane(row, lanes)]
        if row[:2] not in known:
            kept.append(row)
            known[row[:2]] = True
            if len(known) > size:
                known.popitem(last=False)
    return sorted(kept, key=repr)


@pytest.mark.parametrize("seed, size, lanes", [(1, 1, 1), (2, 5, 1), (3, 40, 1), (4, 3, 4), (5, 1000, 3)])
def test_against_a_loop(spark, monkeypatch, seed, size, lanes):
    monkeypatch.setattr(memory, "STRETCH_BITS", 5)
    rng, sent = random.Random(seed), []
    for i in range(1200):
        hot = rng.random() < 0.33
        id_ = (1, 1) if hot else (rng.choice([None, 1, 2, 3]), rng.choice([None, *range(20)]))
        sent.append((*id_, rng.randrange(2), i, f"p{i}"))
    rng.shuffle(sent)
    expected = by_a_loop(sent, size, lanes)
    found = rows(dedup_last_n(spark.createDataFrame(sent, SENT), size, lanes))
    assert found == expected
    ids = {r[:2] for r in sent}
    assert len(found) == len(ids) if size >= len(ids) else len(found) > len(ids)


def test_asking_does_not_keep_an_id_young(spark):
    sent = [(1, n, 0, i, "x") for i, n in enumerate([1, 2, 1, 3, 1, 1])]
    found = dedup_last_n(spark.createDataFrame(sent, SENT), 2, 1)
    assert sorted(r["offset"] for r in found.collect()) == [0, 1, 3, 4]


def test_types_and_extra_columns_pass_unchanged(spark):
    sent = spark.sql(
        """SELECT 1L AS station_id, id % 3 AS s_no, 0 AS partition, id AS offset, IF(id = 0, NULL, id) AS more,
        timestamp_seconds(id) AS at, array(struct(id AS a)) AS deep FROM range(9)"""
    )
    found = dedup_last_n(sent, 3, 2)
    assert found.dtypes == sent.dtypes
    assert rows(found) == rows(sent.where("offset < 3"))


def test_nothing_and_no_memory(spark):
    nothing = spark.createDataFrame([], SENT)
    assert dedup_last_n(nothing, 3).collect() == []
    for wrong in ({"size": 0}, {"size": 1, "lanes": 0}):
        with pytest.raises(ValueError):
            dedup_last_n(nothing, **wrong)


def test_a_hot_id_goes_before_lanes_meet(spark):
    """Two thirds of the rows are one id, alone in most stretches of its lane."""
    sent = spark.range(30_000).selectExpr(
        "1L AS station_id", "IF(id % 3 = 0, id, 1L) AS s_no", "0 AS partition", "id AS offset", "'x' AS payload"
    )
    found = dedup_last_n(sent, 100_000, 16)
    assert found.count() == 10_001
    shown = plan(found)
    assert "SinglePartition" not in shown and "CartesianProduct" not in shown
    assert sorted(r["offset"] for r in found.where("s_no = 1").collect()) == [1]
