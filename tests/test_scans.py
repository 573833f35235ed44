"""Scans over all rows, range lookups and gated schedules against loops in plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quire.operators import ordered as O
from quire.operators import ranges as G
from quire.operators import relational as R
from quire.operators import scans as S
from quire.operators.gates import rate_gate as R_gate

NAN = float("nan")


def scanned_rows(kind):
    rng = random.Random(kind)
    n = 400
    if kind == "prefix":  # file names that differ late only
        keys = [f"Chapter_{rng.randrange(10**6)}_The_same_name.txt" for _ in range(n)]
    elif kind == "hot":
        keys = ["hot" if rng.random() < 0.6 else f"k{rng.randrange(50)}" for _ in range(n)]
    else:
        keys = [None if rng.random() < 0.1 else f"{rng.randrange(30)}" for _ in range(n)]
    return [(k, i, rng.choice([None, rng.randrange(-50, 50)])) for i, k in enumerate(keys)]


@pytest.mark.parametrize("chunk", [4, 17])
@pytest.mark.parametrize("kind", ["prefix", "hot", "nulls"])
def test_scan(spark, kind, chunk):
    rows = scanned_rows(kind)
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(5)
    adds = {"n": S.Running("count"), "total": S.Running("sum", F.col("v")), "held": S.Running("last", F.col("v")), "top": S.Running("max", F.col("v")), "low": S.Running("min", F.col("v"))}
    got = {r["i"]: (r["n"], r["total"], r["held"], r["top"], r["low"]) for r in S.scan(df, ["k", F.desc("i")], adds, chunk).collect()}
    want, seen, held = {}, [], None
    for n, (_, i, v) in enumerate(sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", -r[1])), 1):
        if v is not None:
            seen.append(v)
            held = v
        want[i] = n, sum(seen) if seen else None, held, max(seen, default=None), min(seen, default=None)
    assert got == want


def test_scan_edges(spark):
    none = spark.createDataFrame([], "k string, v int")
    assert S.numbered(none, ["k"]).count() == 0
    same = spark.createDataFrame([("a", 1)] * 300, "k string, v int").repartition(4)
    assert sorted(r["n"] for r in S.numbered(same, ["k"], chunk=3).collect()) == list(range(300))
    odd = spark.createDataFrame([(float("inf"), {"a": 1}), (NAN, None), (-0.0, {}), (None, {})], "k double, m map<string,int>")
    assert [str(r["k"]) for r in S.numbered(odd, ["k"]).orderBy("n").collect()] == ["None", "-0.0", "inf", "nan"]
    with pytest.raises(ValueError, match="can't run"):
        S.Running("median", F.lit(1))


def test_no_window_holds_all_rows(spark):
    """400,000 names with a common beginning: chunks stay within their size."""
    names = spark.range(400_000).select(F.concat(F.lit("Chapter_"), F.col("id").cast("string"), F.lit("_x.txt")).alias("k"))
    table = S.sorted_table(names, ["k"])
    assert len({r["p"] for r in table.select(F.shiftright("_m", 33).alias("p")).distinct().collect()}) == 4
    sizes = [r["n"] for r in table.groupBy(F.shiftright("_m", 15)).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 400_000 and max(sizes) <= 1 << 15 and len(sizes) >= 13
    got = O.batches(names, "k", 100_000).groupBy("batch").count().collect()
    assert sorted((r["batch"], r["count"]) for r in got) == [(b, 100_000) for b in range(4)]


def test_clock_and_fill_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(S.scan, "__defaults__", (3,))
    rng = random.Random(4)
    rows = [(f"g{g:03}", i, rng.choice([None, None, f"v{g}.{i}"])) for g in range(60) for i in range(rng.randrange(1, 4))]
    got = {(r["g"], r["i"]): r["filled"] for r in O.hold_previous(spark.createDataFrame(rows, "g string, i int, v string"), "g", "i", "v", F.lit("none")).collect()}
    held, want = "none", {}
    for g, i, v in sorted(rows):
        held = want[g, i] = v or held
    assert got == want
    totals = [(f"g{g:03}", 10 * g) for g in range(60)]
    parts = [(g, i, t // 2) for g, t in totals for i in range(2)]
    clock = O.running_clock(spark.createDataFrame(parts, "g string, i int, a int"), "g", "i", F.col("a"), spark.createDataFrame(totals, "g string, total int"))
    at, ends = 0, {}
    for g, t in totals:
        for i in range(2):
            ends[g, i] = at + t // 2 * i, at + t // 2 * (i + 1)
        at += t
    assert {(r["g"], r["i"]): (r["start"], r["end"]) for r in clock.collect()} == ends
    a, b = spark.createDataFrame([(x,) for x in "dbca" * 5], "x string"), spark.range(15)
    paired = R.pair_by_position(a, "x", b, "id").orderBy("position").collect()
    assert [(r["position"], r["x"], r["id"]) for r in paired] == [(i + 1, x, i) for i, x in enumerate(sorted("dbca" * 5)[:15])]


# Range lookups


def plain_first(numbers, ranges, otherwise="null"):
    """Values of the first range that holds each number, as Spark orders doubles: NaN is above all."""
    key = lambda x: (math.isnan(x), 0.0 if math.isnan(x) else x)
    first = lambda x: (x is not None, x if x is not None else 0)
    order = sorted(ranges, key=lambda r: (first(r[0]), r[1] is not None, key(r[1] or 0.0), r[2] is not None, key(r[2] or 0.0), r[3]))
    out = {}
    for n in numbers:
        hit = next((r[3] for r in order if n is not None and r[1] is not None and r[2] is not None and key(r[1]) <= key(n) <= key(r[2])), None)
        out[str(n)] = hit if hit is not None or otherwise == "null" or not order else order[-1][3]
    return out


@pytest.mark.parametrize("few", [10**6, 0])
@pytest.mark.parametrize("otherwise", ["null", "last"])
def test_ranges_of_doubles(spark, few, otherwise):
    rng = random.Random(3)
    at = lambda: rng.choice([round(rng.uniform(-50, 50), 1), float(rng.randrange(-20, 20)), 0.5])
    ranges = [(rng.randrange(60), a, a + rng.choice([0, 0.5, 3, 40, -1]), f"v{i}") for i in range(150) for a in [at()]]
    ranges += [(1, None, 3.0, "x"), (1, 2.0, None, "y"), (99, 60.0, float("inf"), "inf"), (98, -1e300, -60.0, "low"), (97, 1e6, NAN, "nan"), (5, -0.0, 0.0, "zero")]
    numbers = [*[at() for _ in range(300)], *[r[1] for r in ranges[:50]], *[r[2] for r in ranges[:50]], None, NAN, float("inf"), -0.5, 9.5, -70.0, 0.0, 1e305]
    rows, table = spark.createDataFrame([(n,) for n in numbers], "n double"), spark.createDataFrame(ranges, "pos int, lo double, hi double, v string")
    got = R.range_lookup(rows.repartition(3), "n", table.repartition(3), ["v"], otherwise, few).collect()
    assert len(got) == len(numbers)
    assert {str(r["n"]): r["v"] for r in got} == plain_first(numbers, ranges, otherwise)


@pytest.mark.parametrize("count", [1000, 1001])
def test_ranges_around_the_switch(spark, count):
    ranges = [(i, 10 * i, 10 * i + 9, f"v{i}") for i in range(count)]
    numbers = [9.5, -0.5, 0.0, 10.0, 9999.0, 10_009.5, None]
    rows, table = spark.createDataFrame([(n,) for n in numbers], "n double"), spark.createDataFrame(ranges, "pos int, lo int, hi int, v string")
    got = {str(r["n"]): r["v"] for r in R.range_lookup(rows, "n", table, ["v"], "null").collect()}
    assert got == {str(n): next((v for _, lo, hi, v in ranges if n is not None and lo <= n <= hi), None) for n in numbers}
    assert {r["v"] for r in R.range_lookup(rows.where("n = -0.5"), "n", table, ["v"]).collect()} == {f"v{count - 1}"}


@pytest.mark.parametrize("few", [10**6, 0])
def test_ranges_of_other_types(spark, few):
    words = spark.createDataFrame([(w,) for w in ["a", "apple", "b", "m", "zz", None]], "n string")
    table = spark.createDataFrame([(2, "a", "b", 1, "first"), (1, "apple", "banana", 2, "second")], "pos int, lo string, hi string, v int, w string")
    got = {r["n"]: (r["v"], r["w"]) for r in R.range_lookup(words, "n", table, ["v", "w"], "null", few).collect()}
    assert got == {"a": (1, "first"), "apple": (2, "second"), "b": (2, "second"), "m": (None, None), "zz": (None, None), None: (None, None)}
    days = spark.sql("SELECT explode(array(DATE'2024-01-05', DATE'2024-02-01', CAST(NULL AS DATE))) AS n")
    months = spark.sql("SELECT 1 AS pos, DATE'2024-01-01' AS lo, DATE'2024-01-31' AS hi, 'jan' AS v")
    assert sorted(str(r["v"]) for r in R.range_lookup(days, "n", months, ["v"], "null", few).collect()) == ["None", "None", "jan"]
    assert R.range_lookup(days.limit(0), "n", months, ["v"], "last", few).count() == 0
    assert {r["v"] for r in R.range_lookup(days, "n", months.where("pos > 1"), ["v"], "last", few).collect()} == {None}


def test_sweep_of_spread_ranges(spark):
    """Ranges that reach over many parts, nested and stacked, with ends at a few hot places."""
    rng = random.Random(8)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        ranges = [(rng.randrange(500), a, b, f"v{i}") for i in range(600) for a, b in [sorted((rng.choice([0, 5000, rng.randrange(10_000)]), rng.choice([9999, 5000, rng.randrange(10_000)])))]]
        numbers = list(range(-3, 10_003, 7)) + [0, 5000, 9999]
        got = R.range_lookup(spark.createDataFrame([(n,) for n in numbers], "n int"), "n", spark.createDataFrame(ranges, "pos int, lo int, hi int, v string"), ["v"], "null", 0).collect()
        assert {str(r["n"]): r["v"] for r in got} == plain_first(numbers, [(p, float(a), float(b), v) for p, a, b, v in ranges])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert list(G.sweep([1, 2, 3], [2, 0, 2], [7, 4, 4], 9)) == [(0, 9), (1, 4), (2, 9)]


# Gated schedules


def plain_gate(rows, gap):
    """rows: (key, seconds or None, id); allowed and wait of each id, by a loop over each key."""
    last, out = {}, {}
    for k, t, i in sorted(rows, key=lambda r: (str(r[0]), r[1] is None, r[1] or 0, r[2])):
        if t is None:
            out[i] = None, None
        elif k not in last or t >= last[k] + gap:
            last[k] = t
            out[i] = True, 0.0
        else:
            out[i] = False, round(gap - (t - last[k]), 6)
    return out


@pytest.mark.parametrize("chunk", [4, 17])
def test_rate_gate(spark, chunk):
    rng = random.Random(chunk)
    rows = [("hot" if rng.random() < 0.7 else rng.choice(["a", "b", "c", None]), rng.choice([None, *[rng.randrange(20_000)] * 9]), i) for i in range(300)]
    rows += [("dense", 3 * i, 1000 + i) for i in range(150)] + [("sparse", 5000 * i, 2000 + i) for i in range(30)] + [("tied", 7, 3000 + i) for i in range(20)]
    df = spark.createDataFrame(rows, "k string, s long, id int").withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")).repartition(3)
    got = {r["id"]: (r["allowed"], None if r["wait_seconds"] is None else round(r["wait_seconds"], 6)) for r in R_gate(df, "k", "ts", None, ("id",), chunk).collect()}
    assert got == plain_gate(rows, 600)
    assert sum(bool(a) for a, _ in got.values()) > 40


def test_rate_gate_edges(spark):
    df = spark.createDataFrame([(1, 0, "x"), (1, 1800, "y"), (1, 3599, "z"), (1, 3600, "w")], "k int, s long, v string").withColumn("ts", F.timestamp_seconds("s"))
    assert {r["v"]: (r["allowed"], r["wait_seconds"]) for r in R_gate(df, "k", "ts", 1.0).collect()} == {"x": (True, 0.0), "y": (False, 1800.0), "z": (False, 1.0), "w": (True, 0.0)}
    assert R_gate(df.limit(0), "k", "ts", 1.0).count() == 0 and R_gate(df, "k", "ts", 1.0).columns == [*df.columns, "allowed", "wait_seconds"]
