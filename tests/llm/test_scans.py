"""Licence scans, filter interactions and importance resampling against SQL and brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from oracle import connect, differences

from quire.llm import audit, licenses, registry, resample

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    assert not differences(spark, connect(SF_DIR), registry.QUERIES[name], registry.ORACLE_SQL[name], SF_DIR)


# Licence scans


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_licenses(texts):
    """By comparing every template with every place."""
    given, docs = licenses.templates(), [plain_words(t) for t in texts]
    held = Counter(w for d in docs for w in set(d))
    idf = lambda w: math.log(1 + len(docs) / (1 + held[w]))
    out = []
    for d in docs:
        starts, base, labels, best = [], set(), set(), 0.0
        for t in given:
            must = {i for r in t.keys for i in r}
            total = sum(idf(t.words[j]) for j in t.held)
            for s in range(-len(t.words), len(d)):
                same = {j for j in t.held if 0 <= s + j < len(d) and d[s + j] == t.words[j]}
                share = sum(idf(t.words[j]) for j in same) / total if total else 0
                if must <= same and (t.phrase or share >= licenses.SHARE):
                    labels.add(t.label)
                    if t.phrase:
                        starts.append(s)
                        base.add(t.label)
                    else:
                        best = max(best, share)
        score = max(best, licenses.PHRASE_SCORE if starts else 0)
        out.append((len(d), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), round(score, 6)))
    return out


def license_texts():
    rng = random.Random(5)
    notices = [t.words for t in licenses.templates()]
    fill = [*"the of a w1 w2 license mit gnu cc by public software".split(), "für", "é"]
    texts = []
    for _ in range(80):
        w = [rng.choice(fill) for _ in range(rng.randrange(12))]
        for _ in range(rng.randrange(4)):
            n = list(rng.choice(notices))
            for _ in range(rng.choice([0, 0, 1, 3])):
                n[rng.randrange(len(n))] = rng.choice(fill)
            w += n[rng.choice([0, 0, 2]) :] + [rng.choice(fill) for _ in range(rng.randrange(4))]
        texts.append(rng.choice([" ", "\n", ", ", "--"]).join(x.upper() if rng.random() < 0.2 and x.isascii() else x for x in w))
    return [*texts, None, "", "...", "MIT License", "mit-license/MIT LICENSE", "cc by cc by cc by", "cc by-nc 4.0", "License Apache", "x " * 60_000 + "apache license", "ÀPACHE license", "mit license" * 3]


def test_licenses(spark):
    texts = license_texts()
    df = spark.createDataFrame([(i, t, "clash", 7) for i, t in enumerate(texts)], "doc_id long, text string, labels string, extra int").repartition(5)
    got = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], round(r["score"], 6)) for r in licenses.scan(df).collect()}
    want = plain_licenses(texts)
    assert got == dict(enumerate(want))
    assert len({w[5] for w in want}) > 10 and licenses.scan(df).columns[:2] == ["doc_id", "extra"]
    empty = licenses.scan(df.limit(0))
    assert empty.count() == 0 and empty.columns == licenses.scan(df).columns


def test_license_keys(spark):
    rows = [(None, "mit license"), (None, "mit license"), ("a", None), ("a", "cc by")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert sorted((str(r["doc_id"]), r["base_labels"], r["n_words"]) for r in got) == [("None", "mit", 2), ("None", "mit", 2), ("a", "", 0), ("a", "cc-by", 2)]
    with pytest.raises(ValueError, match="isn't part"):
        licenses.Template("x", "some words", ["other words"])


# Filter interactions


def plain_failures(docs, labels):
    out = []
    for k, text, lang in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": k is not None and any(o is not None and o < k and (u or "") == t for o, u, _ in docs)}
        good, toxic = (any(x == k and y == 1 for x, y in ((r[0], r[i]) for r in labels)) and k is not None for i in (1, 2))
        out.append((lang or "", {x for x, on in fails.items() if on}, good, toxic))
    return out


def plain_audit(docs, labels):
    rows = plain_failures(docs, labels)
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left, gone = mine, []
            for i, f in enumerate(order):
                hit = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                out[part, "".join(order), i + 1] = [len(left), len(hit), sum(f in r[1] for r in gone), sum(r[1] == {f} for r in mine), sum(r[2] for r in hit), sum(r[3] for r in hit)]
                shapley[part, f] += len(hit)
                gone += hit
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audit_docs():
    rng = random.Random(2)
    words = [*"a b c A BB Cc # x| é ÉÉ".split(), "longer_than_fifteen_bytes_1", "longer_than_fifteen_bytes_2"]
    texts = [" ".join(rng.choice(words[: rng.choice([4, 8, 12])]) for _ in range(rng.choice([3, 150, 199, 200, 260]))) for _ in range(20)]
    texts += [" ".join(f"w{i}" for i in range(300)), " ".join(f"w{i}" for i in range(200)), " ".join(["y", *[f"w{i % 99}" for i in range(199)]]), None, "", "", " \n ", " é ü"]
    docs = [(k, rng.choice(texts), rng.choice(["en", "de", None, ""])) for k in range(150)]
    return [*docs, (None, texts[0], "en"), (None, texts[0], "en"), (3, docs[3][1], "en"), (900, "once " * 60_000, "fr"), (901, "a1 " + "z" * 200_000, "fr")]


def test_audit(spark):
    docs = audit_docs()
    labels = [(k, int(k % 3 == 0), int(k % 7 == 0)) for k in range(0, 150, 2)] + [(4, 1, None), (4, None, 1), (None, 1, 1), (9999, 1, 1)]
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, lang string, fails string").repartition(5)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")) for r in audit.interactions(audit.failures(df, known)).collect()}
    assert got == plain_audit(docs, labels)
    assert len(got) == 600 * 4
    assert audit.interactions(audit.failures(df.limit(0), known)).count() == 0
    assert audit.interactions(audit.failures(df, known.limit(0))).agg({"good_lost": "sum"}).first()[0] == 0


def test_scan_in_blocks():
    """Counts don't depend on blocks, slices or the type of strings."""
    texts = [t for _, t, _ in audit_docs()]
    for column in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(["skipped", *texts, "too"])[1:-1]):
        for block in (1, 3000, 1 << 20):
            rows = defaultdict(list)
            for _, _, found in audit.scan(column, block):
                for n, x in found.items():
                    rows[n] += x.tolist()
            words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
            assert rows["words"] == list(map(len, words)) and rows["distinct"] == [len(set(w)) for w in words]
            assert rows["characters"] == [len(t or "") for t in texts] and rows["symbols"] == [len(re.findall(r"[#$%&*|]", t or "")) for t in texts]


def test_colliding_hashes(monkeypatch):
    """Words of one hash are told apart by their bytes."""
    monkeypatch.setattr(audit, "word_names", lambda data, start, end: np.zeros((2, len(start)), dtype=np.uint64) + (end - start).astype(np.uint64))
    long = ["longer_than_fifteen_1", "longer_than_fifteen_2", "longer_than_fifteen_1"]
    found = next(audit.scan(pa.array([" ".join(long), "longer_than_fifteen_1"])))[2]
    assert found["distinct"].tolist() == [2, 1]


# Importance resampling


def plain_runs(text, most):
    w = [x.encode() for x in plain_words(text)]
    return [b" ".join(w[i : i + m]) for m in range(1, most + 1) for i in range(len(w) - m + 1)]


def plain_resample(docs, target, most=1, buckets=10_000, least=20, percent=10, seed=2024):
    bucket = lambda f: zlib.crc32(f) % buckets
    runs = [[bucket(f) for f in plain_runs(t, most)] for _, t in docs]
    source, goal = Counter(b for r in runs for b in r), Counter(bucket(f) for t in target for f in plain_runs(t, most))
    s, t = source.total() + buckets, goal.total() + buckets
    gain = lambda b: math.floor(1000 * math.log((goal[b] + 1) * s / ((source[b] + 1) * t)))
    rows = []
    for i, ((k, text), r) in enumerate(zip(docs, runs, strict=True)):
        h = int(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, r)) // len(r) if r else 0
        rows.append([k, len(r), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(plain_words(text)), i])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], -math.inf if r[0] is None else r[0], r[5]))
    rank = {r[5]: n for n, r in enumerate(able[: len(able) * percent // 100], 1)}
    return [(*r[:4], rank.get(r[5])) for r in rows]


def resample_docs():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)] + ["Über", "É2", "x-y", "it's", "a" * 70]
    docs = [(k, rng.choice([" ", "\n", "; "]).join(rng.choice(words) for _ in range(rng.choice([0, 5, 19, 20, 21, 60, 400])))) for k in range(200)]
    return [*docs, (None, docs[7][1] + " more words"), (300, None), (301, ""), (302, "--- ..."), (303, "long text, " * 40_000), (304, "z" * 300_000 + " ä" * 100_000), (305, "A b " * 200)]


@pytest.mark.parametrize(("most", "chunk"), [(1, 256 << 10), (1, 200), (3, 300), (2, 1)])
def test_resample(spark, most, chunk):
    docs = resample_docs()
    target = [" ".join(f"W{i}" for i in range(0, 300, 3)), None, "Über it's"]
    df = spark.createDataFrame([(*d, "clash") for d in docs if chunk > 1 or len(d[1] or "") < 5000], "doc_id long, text string, weight string").repartition(5)
    goal = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id int")
    got = [tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in resample.resample(df, goal, most=most, chunk=chunk).collect()]
    want = plain_resample([d for d in docs if chunk > 1 or len(d[1] or "") < 5000], target, most)
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_resample_edges(spark):
    df = spark.createDataFrame([(1, "a b " * 20), (1, "a b " * 20), (1, "c d " * 20)], "doc_id int, text string")
    none = spark.createDataFrame([], "text string")
    got = resample.resample(df, none, percent=67).collect()
    assert len(got) == 3 and sorted(r["rank"] or 0 for r in got) == [0, 1, 2] and {r["n_features"] for r in got} == {40}
    assert resample.resample(df.limit(0), none).count() == 0
    rows = [(str(k), "w " * 30) for k in range(40)]
    named = resample.resample(spark.createDataFrame(rows, "doc_id string, text string"), none).collect()
    assert sorted(r["rank"] for r in named if r["rank"]) == [1, 2, 3, 4]


def test_resample_query(spark):
    read = lambda n: spark.read.parquet(f"{SF_DIR}/{n}.parquet")
    docs = sorted((r["doc_id"], r["text"]) for r in read("documents").collect())
    got = sorted(tuple(r) for r in resample.op13_resample(spark, SF_DIR).collect())
    assert got == plain_resample(docs, [r["text"] for r in read("benchmark").collect()])
    assert sum(r[4] is not None for r in got) >= 10
