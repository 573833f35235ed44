"""Near-duplicates, repeated passages and decontamination against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from quire.llm import decontaminate, simhash, substring
from quire.llm._common import Words


def plain_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    h = [xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(keys, radius):
    parent = list(range(len(keys)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if (keys[i] ^ keys[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(keys))]


@pytest.mark.parametrize("radius", [0, 1, 4, 9, 14])
def test_walk(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, size=30, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, size=30, dtype=np.uint64)
    sets = [base]
    for _ in range(5):
        x = base.copy()
        for _ in range(int(rng.integers(1, radius + 4))):
            x = x ^ (np.uint64(1) << rng.integers(0, 64, size=30).astype(np.uint64))
        sets.append(x)
    keys = np.unique(np.concatenate(sets))
    got, size = np.arange(len(keys)), simhash.segments(radius)
    for t in range(radius + 1):
        turn = sum(size[:t])
        turned = (keys << np.uint64(turn)) | (keys >> np.uint64(64 - turn)) if turn else keys
        order = np.argsort(turned)
        root = simhash.walk(turned[order], len(keys), radius, 0, simhash.budgets(radius, t))
        got = simhash.unite(got, order, order[root])
    assert got.tolist() == plain_components([int(k) for k in keys], radius)


def near_texts():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    texts = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(3, 400))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    return [*texts, None, "", " \n", "Aé", "aé", *["same text here"] * 5]


def test_near_duplicates(spark):
    texts = near_texts()
    rows = [(3 * i + 1, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component string").repartition(5)
    got = {r["doc_id"]: (r["fp"][0] & (2**64 - 1), r["component"]) for r in simhash.near_duplicates(df).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    root = plain_components(prints, 4)
    assert got == {k: (p, rows[r][0]) for (k, _, _), p, r in zip(rows, prints, root, strict=True)}
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_crowded_prefixes(spark, monkeypatch):
    """Groups that are split again and again link the same fingerprints."""
    monkeypatch.setattr(simhash, "CROWD", 60)
    rng = random.Random(6)
    base = rng.getrandbits(64)
    near = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(80)} | {rng.getrandbits(64) for _ in range(10)}
    keys = sorted(near)
    signed = [(k - (1 << 64) if k >> 63 else k) for k in keys]
    df = spark.createDataFrame([(i, [k]) for i, k in enumerate(signed)], "v long, fp array<long>")
    parent = np.arange(len(keys))
    forest = simhash.links(df, 2).collect()
    parent = simhash.unite(parent, np.array([r["u"] for r in forest]), np.array([r["w"] for r in forest]))
    assert parent.tolist() == plain_components(keys, 2)


def test_near_duplicates_edges(spark):
    rows = [(None, "no key here at all"), (4, "no key here at all"), (6, "word " * 150_000), (6, "word " * 150_000), (8, "word " * 149_999 + "end")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["component"]) for r in got) == [("4", 4), ("6", 6), ("6", 6), ("8", 6), ("None", 4)]


@pytest.mark.parametrize("kind", ["int", "string", "date"])
def test_near_duplicates_of_any_keys(spark, kind):
    """Keys of other types, null and repeated ones, give the components and the kept rows of whole numbers."""
    texts = [*near_texts()[:40], *["same text here"] * 3]
    base = " ".join(f"v{i}" for i in range(100))
    texts += [base, base, base + " more"]
    key = {"int": F.col("n"), "string": F.when(F.col("n").isNotNull(), F.format_string("k%04d", "n")), "date": F.date_add(F.lit("2024-01-01").cast("date"), F.col("n").cast("int"))}[kind]
    rows = [(i if i % 10 else None, t) for i, t in enumerate(texts)] + [(5, texts[5])]
    df = spark.createDataFrame(rows, "n int, text string").select("n", key.alias("doc_id"), "text").repartition(3)
    named = df.select("doc_id", F.col("n").cast("long").alias("n")).where("n is not null").distinct()
    name = {r["doc_id"]: r["n"] for r in named.collect()} | {None: None}
    plain = df.select(F.col("n").cast("long").alias("doc_id"), "text")
    found = lambda d, of: sorted((str(of(r["doc_id"])), str(r["fp"]), str(of(r["component"]))) for r in simhash.near_duplicates(d).collect())
    assert found(df, name.get) == found(plain, lambda x: x)
    kept = lambda d, of: sorted(str(of(r["doc_id"])) for r in simhash.keep_one(d).collect())
    assert kept(df, name.get) == kept(plain, lambda x: x)
    assert len(kept(plain, lambda x: x)) < len(rows)


def test_recall_of_near_duplicates(spark):
    """Against exact similarity of all pairs that share a shingle, on whole tables."""
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect())
    kept = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == plain_kept(rows)


def test_keep_one(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(900)]
    base = [rng.choice(words) for _ in range(300)]
    copy = list(base)
    for at in (10, 150, 290):
        copy[at] = "other"
    rows = [(5, " ".join(base)), (9, " ".join(copy)), (2, " ".join(rng.choice(words) for _ in range(300))), (11, " ".join(base))]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 5]


def plain_kept(rows, n=5):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return {rows[r][0] for r in root}


def near_pairs():
    """Pairs of given similarities, chains, texts that a repeated line dominates, and templated texts."""
    rng = random.Random(4)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = []
    for same in (0.6, 0.7, 0.75, 0.79, 0.8, 0.82, 0.85, 0.95):
        for _ in range(12):
            base = fresh(404)
            shared = round(2 * 400 * same / (1 + same) + 0.4)
            texts += [base, base[: shared + 4] + fresh(400 - shared)]
    for _ in range(5):
        base = fresh(300)
        texts += [base[i * 20 : i * 20 + 200] for i in range(5)]  # each like the next only
        line = fresh(5)
        texts += [line * 60 + fresh(30) for _ in range(3)]
        texts += [base, base + base[-5:] * 80]
    template = fresh(150)
    return [*[" ".join(t) for t in texts], *[" ".join(template + fresh(40)) for _ in range(40)], None, "", " ", "A b c", "a  B c", "a b d"]


@pytest.mark.parametrize("block", [None, 3000])
def test_keep_one_is_exact(spark, monkeypatch, block):
    if block:
        monkeypatch.setattr(simhash, "BLOCK", block)
    rows = list(enumerate(near_pairs()))
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert {r["doc_id"] for r in kept.collect()} == plain_kept(rows)


def plain_removal(rows, window=20):
    first, out = {}, {}
    docs = sorted((k, (t or "").encode().split()) for k, t in rows)
    for k, w in docs:
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), (k, i))
    for k, w in docs:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] != (k, i):
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[k] = len(w), sum(gone), hashlib.sha256(kept).hexdigest()
    return out


@pytest.mark.parametrize("words", [["a", "b"], ["a", "b", "c", "é"], [f"w{i}" for i in range(200)], ["a"]])
def test_substrings(spark, words):
    rng = random.Random(len(words))
    base = [[rng.choice(words) for _ in range(rng.randint(0, 120))] for _ in range(10)]
    rows = []
    for k in range(50):
        middle = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        if rng.random() < 0.5:
            b = rng.choice(base)
            i = rng.randint(0, max(0, len(b) - 1))
            middle = b[i : i + rng.randint(15, 60)]
        edge = lambda: [rng.choice(words) for _ in range(rng.randint(0, 9))]
        rows.append((k, rng.choice([" ", "\n", "\t "]).join(edge() + middle + edge())))
    rows += [(100, None), (101, ""), (102, "x " * 500), (103, "y" * 5000 + " z" * 30)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, n_words string").repartition(3)
    got = substring.remove(df).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256((r["kept_words"] or "").encode()).hexdigest()) for r in got} == plain_removal(rows)
    for r in got:
        assert (r["kept_text"] or "").split() == (r["kept_words"] or "").split()
        assert r["n_removed"] or r["kept_text"] == r["text"]
    assert substring.remove(df.limit(0)).count() == 0


def test_substring_null_key(spark):
    text = " ".join(f"w{i}" for i in range(30))
    got = substring.remove(spark.createDataFrame([(None, text), (1, text), (2, text)], "doc_id long, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in got.collect()} == {None: 0, 1: 0, 2: 30}


def test_substrings_of_long_repeats(spark):
    """Copies of long passages, of whole texts, runs, and passages cut at odd places: tiles settle them, windows the rest."""
    rng = random.Random(11)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    base, texts = [fresh(700) for _ in range(4)], []
    for k in range(40):
        b = rng.choice(base)
        i, n = rng.randrange(600), rng.choice([19, 20, 21, 39, 40, 41, 60, 100, 400])
        texts.append(fresh(rng.randrange(60)) + b[i : i + n] + fresh(rng.randrange(60)))
    texts += [base[0], base[0], base[1] + base[1], fresh(30) + ["x"] * 900, ["x"] * 300 + fresh(5), ["x", "y"] * 400]
    rows = [(3 * k - 30, " ".join(t)) for k, t in enumerate(texts)]
    rng.shuffle(rows)
    got = substring.remove(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept_words"].encode()).hexdigest()) for r in got} == plain_removal(rows)


@pytest.mark.parametrize(("tasks", "block"), [(1, 1 << 20), (2, 1), (7, 300), (3, 1)])
def test_substrings_in_any_layout(spark, tasks, block):
    """Which texts share a task or block doesn't matter: long runs alone in a block, runs beside other texts, shuffled rows."""
    rng = random.Random(tasks)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = [["x"] * 50 + ["w"] + ["y"] * 50, [*fresh(60), *["x"] * 12, "w", *["y"] * 12, *fresh(60)], ["x"] * 70, ["x"] * 30 + ["w"] + ["x"] * 30]
    for _ in range(30):
        run = [[rng.choice("xyzw")] * rng.choice([1, 2, 7, 12, 19, 25, 45, 80]) for _ in range(rng.randint(1, 6))]
        texts.append([*fresh(rng.choice([0, 0, 3])), *[w for r in run for w in r], *fresh(rng.choice([0, 0, 5]))])
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    want = plain_removal(rows)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(tasks)
    got = substring.remove(df, block=block).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept_words"].encode()).hexdigest()) for r in got} == want


def test_words_that_collide_in_polynomial_hashes(spark):
    """Words over two letters in the Thue-Morse order and its complement have equal polynomial hashes modulo 2**64."""
    order = [bin(i).count("1") % 2 for i in range(2048)]
    a, b = "".join("ab"[x] for x in order), "".join("ba"[x] for x in order)
    names = Words([f"{a} {b}".encode()]).names
    assert (names[:, 0] != names[:, 1]).all()
    words = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join([*words[:10], a, *words[10:20]])), (2, " ".join([*words[:10], b, *words[10:20]])), (3, " ".join([a, b] * 30)), (4, " ".join([b, b] * 30))]
    got = substring.remove(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], hashlib.sha256(r["kept_words"].encode()).hexdigest()) for r in got} == plain_removal(rows)


def test_substring_keys(spark):
    text = " ".join(f"w{i}" for i in range(30))
    named = substring.remove(spark.createDataFrame([("b", text), ("a", text), ("c", "x"), (None, text)], "doc_id string, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in named.collect()} == {"a": 0, "b": 30, "c": 0, None: 0}
    twice = substring.remove(spark.createDataFrame([(1, text), (1, text), (1, f"{text} more"), (0, f"y {text}")], "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in twice) == [(0, 31, 0), (1, 30, 30), (1, 30, 30), (1, 31, 30)]


def plain_matches(docs, items):
    grams = lambda w, n: Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = {}
    for k, t in docs:
        w = (t or "").lower().split()
        for i, u in items:
            v = (u or "").lower().split()
            n = min(5, len(v))
            b = grams(v, n)
            spans = [w[s : s + len(v)] for s in range(len(w) - len(v) + 1)] if len(w) >= len(v) else [w] if len(w) >= n else []
            best = max((sum((a & b).values()) / sum((a | b).values()) for x in spans if v for a in [grams(x, n)]), default=0)
            if best >= 0.8:
                out[k, i] = round(best, 9)
    return out


def test_decontaminate(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([2, 4, 9, 20, 45])))) for i in range(20)]
    items += [(100, ""), (101, "a a a a a a a a"), (102, items[3][1]), (103, None)]
    docs = []
    for k in range(90):
        w = [rng.choice(words) for _ in range(rng.randint(0, 150))]
        if rng.random() < 0.7:
            v = (rng.choice(items)[1] or "").split()
            if v and rng.random() < 0.7:
                v[rng.randrange(len(v))] = rng.choice(words)
            at = rng.randint(0, len(w))
            w[at:at] = v
        docs.append((k, " ".join(w)))
    docs += [(900, "A " * 30), (901, None), (902, "")]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in decontaminate.matches(df, bench).collect()}
    want = plain_matches(docs, items)
    assert got == want and len(want) > 20
    clean = {r["doc_id"] for r in decontaminate.clean(df, bench).collect()}
    assert clean == {k for k, _ in docs} - {k for k, _ in want}
    assert decontaminate.matches(df, bench.limit(0)).count() == 0
    assert decontaminate.matches(df.limit(0), bench).count() == 0


def test_decontaminate_edges(spark):
    """Whole-number and string ids of other types, null and repeated keys, texts shorter than an item, long texts, extra columns."""
    item = [f"w{i}" for i in range(60)]
    rows = [(None, " ".join(item)), (None, "clean text"), (1, " ".join(item[:57])), (1, "clean too"), (2, " ".join(item[:40])), (3, "x " * 120_000 + " ".join(item)), (4, None)]
    df = spark.createDataFrame([(k, t, "c") for k, t in rows], "doc_id int, text string, item_id string")
    bench = spark.createDataFrame([(7, " ".join(item), "c")], "item_id int, text string, similarity string")
    got = decontaminate.matches(df, bench).collect()
    assert sorted((str(r["doc_id"]), r["item_id"], r["first_word"], r["n_words"]) for r in got) == [("1", 7, 0, 57), ("3", 7, 120_000, 60), ("None", 7, 0, 60)]
    assert sorted((r["doc_id"] or 0, (r["text"] or "")[:5]) for r in decontaminate.clean(df, bench).collect()) == [(0, "clean"), (1, "clean"), (2, "w0 w1"), (4, "")]
    named = decontaminate.matches(df, bench.select(F.lit("a").alias("item_id"), "text"))
    assert {r["item_id"] for r in named.collect()} == {"a"}


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEMS", 100)
    items = [(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(15)]
    docs = spark.createDataFrame([(i, f"before {t} after") for i, t in items], "doc_id long, text string")
    got = decontaminate.matches(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(i, i) for i in range(15)]


def test_query_on_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in substring.op4_substring_dedup(spark, sf).collect()}
    assert got == plain_removal(list(docs.items()))
    found = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in simhash.op9_simhash(spark, sf).collect()}
    keys = sorted(docs)
    prints = [plain_fingerprint(docs[k]) for k in keys]
    assert found == {k: (p, keys[r]) for k, p, r in zip(keys, prints, plain_components(prints, 4), strict=True)}
    items = sorted((r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect())
    grams = lambda t: {tuple(w[i : i + 5]) for w in [(t or "").lower().split()] for i in range(len(w) - 4)}
    of_items, want = [(i, t, grams(t)) for i, t in items], {}
    for k, t in docs.items():
        mine = grams(t)  # an item of five words or more without a shingle in common has no similarity
        near = [(i, u) for i, u, g in of_items if g & mine or len(u.split()) < 5]
        want |= plain_matches([(k, t)], near) if near else {}
    reported = {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in decontaminate.op3_decontaminate(spark, sf).collect()}
    assert reported == want and want


def test_block_pairs(spark):
    """Blocks of one label are compared with those of others only, each pair once."""
    rng = random.Random(2)
    for _ in range(6):
        labels = sorted(rng.choice([1, 1, 1, 1, 2, 3, 9]) for _ in range(40))
        blocks = {}
        for i, x in enumerate(labels):
            blocks.setdefault(i // 3, []).append(x)
        rows = [(7, b, min(x), max(x)) for b, x in blocks.items()] + [(8, 50, 4, 4), (8, 51, 4, 4), (9, 60, 1, 2)]
        got = sorted((r["candidate"], r["a"], r["b"]) for r in simhash.block_pairs(spark.createDataFrame(rows, "candidate int, block long, lo int, hi int")).collect())
        want = [(7, a, b) for a in blocks for b in blocks if a <= b and len({*blocks[a], *blocks[b]}) > 1 and (a < b or len({*blocks[a]}) > 1)]
        assert got == sorted([*want, (9, 60, 60)])


def test_large_groups_of_copies(spark, monkeypatch):
    """A group of many blocks: near copies in a chain and around a hub, with others that only their fingerprints bring in."""
    monkeypatch.setattr(simhash, "BLOCK", 4000)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for k in range(60):
        w = list(base)
        for _ in range(2):
            w[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(w)))
    rows += [(100 + k, " ".join([*base[:225], *[f"y{k}.{i}" for i in range(75)]])) for k in range(15)]  # similarity below 0.8 to all
    rows += [(200 + k, " ".join([*base[:225], *[f"y{k}.{i}" for i in range(74)], "z"])) for k in range(0, 15, 2)]  # alike to one each
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert {r["doc_id"] for r in kept.collect()} == plain_kept(rows)
