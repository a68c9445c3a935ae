import random

import pytest
from helpers import rows

from gaugeline.operators.gaps import sequence_gaps

SENT = "station_id long, s_no long, offset long, s string"


def slow_gaps(sent):
    found, last, runs = [], {}, {}
    for station, number, offset in sorted(sent, key=lambda r: (r[2] is None, r[2])):
        if None in (station, number, offset):
            continue
        before = last.get(station)
        runs.setdefault(station, 1)
        if before is not None and number < before:
            runs[station] += 1
        elif before is not None and number > before + 1:
            found.append((station, runs[station], before + 1, number - 1, number - before - 1))
        last[station] = number
    return sorted(found)


@pytest.mark.parametrize("blocks", [1, 2, 7, 64])
def test_gaps_against_a_loop(spark, blocks):
    rng, sent, at = random.Random(blocks), [], {}
    for offset in range(500):
        station = 1 if rng.random() < 0.6 else rng.randrange(2, 6)
        step = rng.choice([0, 1, 1, 1, 2, 5])
        at[station] = 1 if rng.random() < 0.03 else at.get(station, 0) + step
        sent.append((station, at[station], offset * 3))
    sent += [(None, 1, 9), (1, None, 10), (1, 5, None)]
    rng.shuffle(sent)
    found = sequence_gaps(spark.createDataFrame([(*r, "x") for r in sent], SENT), blocks=blocks)
    assert rows(found) == sorted(slow_gaps(sent), key=repr)


def test_gaps_of_nothing_and_of_one_row(spark):
    assert sequence_gaps(spark.createDataFrame([], SENT)).count() == 0
    assert sequence_gaps(spark.createDataFrame([(1, 9, 1, "x")], SENT)).count() == 0


def test_a_busy_station(spark):
    sent = spark.range(4000).selectExpr("1L AS station_id", "id * 2 AS s_no", "id AS offset", "'x' AS s")
    found = sequence_gaps(sent, blocks=8)
    assert found.count() == 3999
