import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterline.functions.scalar import key_hash
from rosterline.operators.ranking import hashed_row_number, running_totals


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("rows_per_range", [50, 1000])
def test_running_totals(spark, descending, rows_per_range):
    rng = np.random.default_rng(3)
    rows = [(float(v), int(n)) for v, n in zip(rng.permutation(500) / 7, rng.integers(0, 9, 500))]
    df = spark.createDataFrame(rows, "s double, n bigint").repartition(5)
    got = {r.s: r.cum_n for r in running_totals(
        df, "s", ["n"], descending=descending, rows_per_range=rows_per_range).collect()}
    total, want = 0, {}
    for s, n in sorted(rows, reverse=descending):
        total += n
        want[s] = total
    assert got == want


@pytest.mark.parametrize("parts", [1, 7])
def test_row_numbers_within_strata(spark, parts):
    df = spark.range(400).select("id", F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("y")).repartition(parts)
    got = hashed_row_number(df, F.col("id"), ["id"], strata="y", buckets=16, total="n").collect()
    hashes = {r.id: r.h for r in spark.range(400).select("id", key_hash(F.col("id")).alias("h")).collect()}
    for y, size in ((0, 360), (1, 40)):
        mine = sorted((r for r in got if r.y == y), key=lambda r: r.rn)
        assert [r.rn for r in mine] == list(range(1, size + 1))
        assert {r.n for r in mine} == {size}
        assert [r.id for r in mine] == sorted((r.id for r in mine), key=lambda i: (hashes[i], i))


def test_row_numbers_over_whole_table(spark):
    got = hashed_row_number(spark.range(300), F.col("id"), ["id"], buckets=8).collect()
    assert sorted(r.rn for r in got) == list(range(1, 301))
