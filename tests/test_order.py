"""Operators that need a global order: running totals, quantiles, bounded files."""

import os
import random
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riverstat.operators.ordering import place_in_slices, running_total
from riverstat.operators.split import _merge, _walk, bounded_split, file_numbers
from riverstat.operators.summary import status_share, value_distribution


def greedy(counts, size):
    """Group by group in key order: a file is closed by the group that takes it beyond `size`."""
    files, number, filled = {}, 1, 0
    for key in sorted(counts):
        files[key] = number
        filled += counts[key]
        if filled > size:
            number, filled = number + 1, 0
    return files


def keyed(spark, counts):
    rows = [(k, n) for k, n in counts.items()]
    return spark.createDataFrame(rows, "key string, n int").select("key", F.explode(F.sequence(F.lit(1), "n")).alias("i"))


@pytest.mark.parametrize("seed", range(4))
def test_split_equals_the_sequential_walk(spark, seed):
    rng = random.Random(seed)
    size = rng.choice([1, 5, 20, 60])
    counts = {f"k{i:04d}": rng.choice([1, 1, 2, 3, 7, size, size + 1, 3 * size]) for i in range(rng.randint(50, 150))}
    for block_rows, fan in ((1, 2), (2 * size + 3, 3), (1_000_000, 32)):
        got = {r.key: r.file_no for r in file_numbers(keyed(spark, counts), "key", size, block_rows, fan).collect()}
        assert got == greedy(counts, size)


def test_split_of_single_row_groups(spark):
    df = spark.range(3000).withColumnRenamed("id", "key")
    got = {r.key: r.file_no for r in file_numbers(df, "key", 9, 35, 5).collect()}
    assert got == {k: k // 10 + 1 for k in range(3000)}


def pieces(begin, width, span):
    """Exits of every block, from the definition."""
    rows = []
    for block in sorted(set(begin // width)):
        own = begin[begin // width == block]
        for entry in own:
            at, files = entry, 1
            while (own >= at + span).any():
                at, files = own[own >= at + span][0], files + 1
            rows.append((block, entry, at + span, files))
    return pd.DataFrame(rows, columns=["block", "entry", "need", "files"])


def test_merging_blocks_equals_walking_through_them():
    rng = random.Random(11)
    for _ in range(200):
        span = rng.randint(2, 9)
        width, fan = span * rng.randint(1, 3), rng.randint(2, 4)
        begin = np.cumsum([0] + [rng.choice([1, 1, 2, span, 3 * width]) for _ in range(40)])
        exits = pieces(begin, width, span)
        parents = exits.assign(parent=exits["block"] // fan)
        merged = pd.concat([_merge(g) for _, g in parents.groupby("parent")])
        walked = _walk(exits.assign(parent=0, need_before=0, files_before=0)).set_index("block")
        above = _walk(merged.assign(parent=0, need_before=0, files_before=0)).set_index("block")
        for parent, group in parents.groupby("parent"):
            first = group["block"].min()
            assert tuple(above.loc[parent]) == tuple(walked.loc[first])


def test_split_keeps_groups_whole(spark):
    counts = {"a": 3, "b": 50, "c": 2, "d": 9, "e": 1}
    split = bounded_split(keyed(spark, counts), "key", 10)
    assert split.count() == sum(counts.values())
    assert split.groupBy("key").agg(F.countDistinct("file_no").alias("n")).filter("n > 1").isEmpty()
    sizes = [r["count"] for r in split.groupBy("file_no").count().orderBy("file_no").collect()]
    assert all(n > 10 for n in sizes[:-1])


def test_split_drops_missing_keys_and_takes_empty_input(spark):
    df = spark.createDataFrame([("a",), (None,)], "key string")
    assert [(r.key, r.file_no) for r in bounded_split(df, "key", 10).collect()] == [("a", 1)]
    assert bounded_split(df.limit(0), "key", 10).isEmpty()


def test_split_of_a_dominating_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(500)).otherwise(F.col("id") % 1000).alias("key")
    )
    counts = {r.key: r["count"] for r in df.groupBy("key").count().collect()}
    got = {r.key: r.file_no for r in file_numbers(df, "key", 700, 1500).collect()}
    assert got == greedy(counts, 700)


def test_running_total(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), i, rng.randint(1, 9)) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, o int, n int")
    order = ["g", "o"]
    got = {(r.g, r.o): r for r in running_total(place_in_slices(df, order), order, "n", group=["g"]).collect()}
    for g, o, _ in rows:
        assert got[g, o].running == sum(n for h, p, n in rows if h == g and p <= o)
        assert got[g, o].total == sum(n for h, _, n in rows if h == g)


def test_distribution_equals_numpy(spark):
    rng = np.random.default_rng(5)
    data = {"hot": np.round(rng.normal(10, 4, 3000), 1), "few": np.array([4.0]), "some": rng.exponential(3, 400),
            "same": np.full(50, 2.0)}
    rows = [(k, float(v)) for k, vs in data.items() for v in vs] + [("some", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    got = {r.k: r for r in value_distribution(df, ["k"], "v").collect()}
    assert set(got) == {*data, None}
    for k, vs in data.items():
        r = got[k]
        expected = np.percentile(vs, [0, 25, 50, 75, 100])
        assert np.allclose([r.minimum, r.q1, r.median, r.q3, r.maximum], expected)
        reach = 1.5 * (expected[3] - expected[1])
        inside = vs[(vs >= expected[1] - reach) & (vs <= expected[3] + reach)]
        assert (r.n, r.outliers) == (len(vs), len(vs) - len(inside))
        assert (r.whisker_low, r.whisker_high) == (inside.min(), inside.max())


def test_status_share(spark):
    df = spark.createDataFrame([("PUB",)] * 2 + [("PRO",)], "s string")
    assert {r.s: (r.n, r.per_status) for r in status_share(df, "s").collect()} == {"PUB": (2, 66.67), "PRO": (1, 33.33)}


def test_split_needs_no_package_on_the_executors(tmp_path):
    """Started elsewhere, with the package on the driver's path only."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "job.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {root!r})
from riverstat.session import get_session
from riverstat.operators.split import file_numbers
spark = get_session(master="local[2]", **{{"spark.sql.shuffle.partitions": "2"}})
df = spark.range(40).withColumnRenamed("id", "key")
print("files", file_numbers(df, "key", 3, 4, 2).agg({{"file_no": "max"}}).first()[0])
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120
    )
    assert "files 10" in done.stdout, done.stderr[-2000:]


def test_slices_follow_the_order_and_are_even(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", None]), i, rng.choice([None, float("nan"), -1.5, 2.0])) for i in range(20_000)]
    df = spark.createDataFrame(rows, "g string, o int, x double").repartition(5)
    for slices in (1, 7, 100):
        placed = place_in_slices(df, ["g", "x", "o"], slices)
        numbers = [r._slice for r in placed.orderBy("g", "x", "o").collect()]
        assert numbers == sorted(numbers)
        sizes = [numbers.count(n) for n in set(numbers)]
        assert len(sizes) <= slices + 1 and max(sizes) < 3 * len(rows) / slices
        assert numbers == [r._slice for r in placed.repartition(3).orderBy("g", "x", "o").collect()]


def test_orders_run_nothing_while_the_plan_is_built(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    df = spark.range(100).selectExpr("id % 3 AS k", "CAST(id AS double) AS v")
    built = value_distribution(df, ["k"], "v")
    assert set(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == set(before)
    assert built.count() == 3
