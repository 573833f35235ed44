"""Names in texts against brute force over all pairs."""

import random

import pytest

from quire.operators import names as N


def plain(texts, names):
    out = []
    for k, t in texts:
        low = (t or "").lower()
        for n in {n.lower() for n in names if n}:
            places = [i for i in range(len(low)) if low.startswith(n, i)]
            if places:
                out.append((k, n, len(places), places[0]))
    return sorted(out)


@pytest.mark.parametrize("block", [1, 40, N.BLOCK])
def test_occurrences(spark, block):
    rng = random.Random(block)
    letters = "aAbBé "
    names = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(60)]
    names += ["aa", "Ann", "ANN", "ann b", "", None, "İx", "straße", "no such name"]
    names = names if block > 1 else names[:5] + names[60:]
    texts = [(k, "".join(rng.choice(letters) for _ in range(rng.choice([0, 10, 80])))) for k in range(40)]
    texts += [(90, None), (91, ""), (92, "aaaa"), (93, "ANN Bann b"), (94, "İX und STRASSE Straße"), (95, "x" * 200_000 + "ann"), (96, "aaaa"), (96, "aaaa")]
    df = spark.createDataFrame([(*t, "clash") for t in texts], "k long, text string, name string").repartition(3)
    got = N.occurrences(df, spark.createDataFrame([(n,) for n in names], "name string"), ["k", "name"], block=block)
    assert got.columns == ["k", "name", "n", "first"]
    assert sorted(tuple(r) for r in got.collect()) == plain(texts, names)


def test_no_names(spark):
    df = spark.createDataFrame([(1, "a")], "k long, text string")
    none = spark.createDataFrame([(None,), ("",)], "name string")
    assert N.occurrences(df, none, ["k"]).count() == 0 and N.occurrences(df.limit(0), df.selectExpr("text as name"), ["k"]).count() == 0


def test_held(spark):
    from pyspark.sql import functions as F

    from quire.operators import relational as R

    texts = spark.createDataFrame([(1, "Ann met Bob. ANN left"), (2, ""), (3, None)], "k long, text string")
    rows = [(1, "Ann"), (1, "ann"), (1, "Carl"), (1, "Carl Bob"), (1, ""), (1, None), (2, "Ann"), (2, ""), (3, ""), (4, "Bob"), (None, "Bob"), (1, "xx it"), (1, "Ann")]
    tags = spark.createDataFrame(rows, "k long, name string")
    got = R.grounded(tags, texts, "k", "name", "text")
    want = []
    for k, n in rows:
        t = {1: "ann met bob. ann left", 2: ""}.get(k)
        words = [w for w in (n or "").lower().split() if len(w) > 2]
        want.append((str(k), str(n), t is not None and n is not None and n.lower() in t, t is not None and any(w in t for w in words)))
    assert sorted((str(r["k"]), str(r["name"]), r["exact"], r["by_word"]) for r in got.collect()) == sorted(want)
    assert N.held(tags, texts, ["k"], "text", F.array(F.lower("name"))).columns == ["k", "name", "held"]
