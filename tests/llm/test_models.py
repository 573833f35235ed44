"""Language ID, quality, sharding, fingerprints, quotations and the pipeline."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import fingerprints, language_id, quality, quotes, sharding

SF = "/root/testdata/sf0.001"


def plain_trees(rows):
    """A function for the bits of a text in a language, by contexts counted one by one. rows: text and language."""
    counts = defaultdict(lambda: defaultdict(Counter))

    def contexts(text):
        data, last = b" " + re.sub(rb"[\x09-\x0D]", b" ", text.encode()), 0
        for i, byte in enumerate(data):
            last = i if byte == 32 else last
            yield data, i, min(i - last, language_id.ORDER)

    for t, lang in rows:
        for data, i, place in contexts(t):
            for k in range(place + 1):
                counts[lang][data[i - k : i]][data[i]] += 1
    sums = {lang: {c: (sum(x.values()), len(x)) for c, x in found.items()} for lang, found in counts.items()}

    def bits(text, lang):
        total = 0.0
        for data, i, place in contexts(text):
            for k in range(place, -2, -1):
                if k < 0:
                    total += 8
                    break
                seen = counts[lang].get(data[i - k : i])
                if not seen:
                    continue
                n, d = sums[lang][data[i - k : i]]
                if data[i] in seen:
                    total -= math.log2(seen[data[i]] / (n + d))
                    break
                total -= math.log2(d / (n + d))
        return total

    return bits


def test_code_lengths_are_those_of_a_plain_model(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "x", None)]
    trees = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    bits = plain_trees([r[1:] for r in rows[:2]])
    for text in ("the mat", "die katze sat", "zzz éa", ""):
        got, _ = trees.measure([text.encode()])
        assert got[0] == pytest.approx([bits(text, lang) for lang in trees.langs], rel=1e-4)


def test_language_query_by_a_plain_model(spark):
    """Predictions and scores of all documents by counting and looking up every context by itself."""
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect())
    held = lambda k: zlib.crc32(str(k).encode()) % 3 == 1
    rows = [(t, lang) for k, t, lang in docs if not held(k) and lang is not None and t is not None]
    bits, langs = plain_trees(rows), sorted({lang for _, lang in rows})
    got = {r["doc_id"]: r for r in language_id.op7_language_id(spark, SF).collect()}
    assert len(got) == len(docs)
    for k, t, _ in docs:
        r = got[k]
        assert r["held_out"] == held(k)
        if not any(c.isalpha() for c in t or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
        elif len(t) < 4000 or k % 10 == 0:  # the plain model takes about a second for 20,000 characters
            b = [bits(t, lang) for lang in langs]
            assert r["lang_pred"] == langs[b.index(min(b))]
            assert r["score"] == pytest.approx(1 / sum(2 ** -min((x - min(b)) / (len(t.encode()) + 1) * 8, 60) for x in b), abs=1e-3)


def test_language_edges(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "der hund und die katze", "de")]
    trees = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    df = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (3, "12 !?", "c"), (4, "the cat", "c"), (4, "the cat", "c"), (5, "katze " * 100_000, "c")], "doc_id long, text string, lang_pred string")
    got = [(r["doc_id"], r["lang_pred"]) for r in language_id.predict(df, trees).orderBy("doc_id").collect()]
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "de")]
    assert {r["doc_id"] for r in language_id.reject(df, trees).collect()} == {4, 5}
    none = language_id.learn(df.select("doc_id", "text", F.lit(None).cast("string").alias("lang")))
    assert {r["lang_pred"] for r in language_id.predict(df, none).collect()} == {"und"}
    assert language_id.predict(df.limit(0), trees).count() == 0


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = language_id.op7_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.min("score"), F.max("score")).first()
    assert right[0] > 0.97 and 0 <= right[1] <= right[2] <= 1


def test_quality_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = quality.op10_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    good, bad = got[got.quality == 1].score.to_numpy(), got[got.quality == 0].score.to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert (got.predicted == got.quality).mean() > 0.93


def test_quality_scores_by_plain_compression(spark):
    """The query's scores from the model's dictionaries and curve, block by block; and calibration on held-out labels."""
    import zstandard as z

    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels.where(~quality.held_out()))
    size = lambda block, raw: len(z.ZstdCompressor(level=quality.LEVEL, dict_data=z.ZstdCompressionDict(raw), write_content_size=False, write_checksum=False, write_dict_id=False).compress(block))
    got = {r["doc_id"]: r for r in quality.op10_quality(spark, sf).collect()}
    for r in docs.select("doc_id", "text").orderBy("doc_id").collect():
        data = (r["text"] or "").encode()
        if len(data) > 3000 and r["doc_id"] % 20:
            continue  # the plain version makes two compressors for each block
        cut = [data[i : i + 1024] for i in range(0, len(data), 1024)]
        x = sum(size(b, model.bad) - size(b, model.good) for b in cut) / len(data) if data else 0
        want = 1 / (1 + math.exp(-max(-60, min(60, model.slope * x + model.offset))))
        assert got[r["doc_id"]]["score"] == pytest.approx(want, abs=1e-9)
        assert got[r["doc_id"]]["predicted"] == int(got[r["doc_id"]]["score"] >= 0.3)


def test_quality_calibration(spark):
    sf = "/root/testdata/sf0.1"
    got = quality.op10_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert abs(got.score.mean() - got.quality.mean()) < 0.05
    for lo, hi in ((0, 0.2), (0.8, 1.01)):
        part = got[(got.score >= lo) & (got.score < hi)]
        assert len(part) > 10 and abs(part.score.mean() - part.quality.mean()) < 0.1


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "abc " * 200_000)], "doc_id long, text string")
    one = quality.learn(docs, spark.createDataFrame([(3, 1), (3, 1), (2, None), (1, 7)], "doc_id long, quality int"))
    assert {round(r["score"]) for r in quality.score(docs, one).collect()} == {1}
    none = quality.learn(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), none).count() == 0


def test_quality_learns_in_linear_time(spark):
    """A labelled text of 20 MB among short ones: its blocks are drawn in one pass over it."""
    import time

    rng = np.random.default_rng(1)
    word = lambda base: "".join(chr(base + c) for c in rng.integers(0, 8, 6))
    texts = [" ".join(word(97 + 8 * (i % 2)) for _ in range(60)) for i in range(100)]
    long = " ".join(texts[::2]) + " "
    docs = spark.createDataFrame([*enumerate(texts), (100, long * (20_000_000 // len(long)))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(101)], "doc_id long, quality int")
    quality.learn(docs.where("doc_id < 100"), labels)
    began = time.time()
    model = quality.learn(docs, labels)
    assert time.time() - began < 40
    scored = {r["doc_id"]: r["score"] for r in quality.score(docs.where("doc_id < 100"), model).collect()}
    assert np.mean([(scored[i] >= 0.5) == (i % 2 == 0) for i in range(100)]) > 0.95


def test_blocks_are_drawn_by_key_and_number(spark):
    rows = spark.createDataFrame([(1, 1, "a" * 5000), (2, 0, ""), (3, 0, "b" * 100_000)], "k long, y int, t string")
    whole = quality.sampled_blocks(rows, {0: 1.0, 1: 1.0}).collect()
    assert sorted((r["y"], len(r["b"])) for r in whole) == sorted([(1, 1024)] * 4 + [(1, 904), (0, 0)] + [(0, 1024)] * 97 + [(0, 672)])
    half = quality.sampled_blocks(rows.repartition(3), {0: 0.5, 1: 0.0}).collect()
    assert {(r["h"], r["i"]) for r in half} < {(r["h"], r["i"]) for r in whole} and 30 < len(half) < 70


def check_shards(rows, text_of, shards, spread):
    """Bytes, tokens and rows of all shards, gapless slots, and groups of equal texts in one shard wherever one can hold them."""
    load, slots, groups = np.zeros((shards, 3)), defaultdict(list), defaultdict(list)
    for r in rows:
        t = text_of[r["doc_id"]] or ""
        assert r["size"] == len(t.encode()) + 1 and r["text_crc32"] == zlib.crc32(t.encode())
        load[r["shard"]] += r["size"], len(t.encode().split()), 1
        slots[r["shard"]].append(r["slot"])
        groups[t].append(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = load.sum(axis=0) / shards
    assert (load <= spread * mean).all() and (load >= (2 - spread) * mean).all(), load / mean
    whole = [t for t, s in groups.items() if max(np.array([len(t.encode()) + 1, len(t.encode().split()), 1]) * len(s) / mean) <= 1]
    assert all(len(set(groups[t])) == 1 for t in whole)
    return len(groups) - len(whole)


def test_sharding(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert check_shards(sharding.op1_sharding(spark, sf).collect(), docs, 16, 1.1) == 0
    rows = [(i, "hot text " * 5, "c") for i in range(3000)] + [(3000 + i, f"other {i} " * (1 + i % 40), "c") for i in range(6000)] + [(9001, None, "c"), (9002, "", "c"), (9003, "long " * 3000, "c")]
    rows += [(20000 + i, f"group {i // 400} of equal texts, " * 9, "c") for i in range(2000)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string, shard string"), 16).collect()
    assert len(got) == len(rows)
    assert check_shards(got, {k: t for k, t, _ in rows}, 16, 1.15) == 1
    by = {r["doc_id"]: r for r in got}
    assert (by[9001]["size"], by[9001]["text_crc32"]) == (1, 0) and by[9001]["shard"] == by[9002]["shard"]
    assert sharding.assign(spark.createDataFrame([], "doc_id long, text string"), 16).count() == 0


def test_sharding_of_long_texts(spark):
    """A text larger than a shard's part stays whole in one shard; the others share what is left."""
    rows = [(0, "long text " * 100_000), *[(k, f"short {k} " * 20) for k in range(1, 400)], (400, "long text " * 100_000)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    assert len(got) == 401 and {r["size"] for r in got if r["doc_id"] in (0, 400)} == {1_000_001}
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(len(s) for s in slots.values()) < 300


def test_sharding_of_null_and_repeated_keys(spark):
    rows = [(None if i % 2 else 7, f"text {i} " * (i % 9)) for i in range(4000)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(k for k, _ in rows)
    assert Counter(r["size"] for r in got) == Counter(len(t) + 1 for _, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 8


def test_packing_follows_the_dot_product():
    rng = np.random.default_rng(1)
    items = rng.random((40, 3))
    capacity = items.sum(axis=0) / 4
    got = sharding.pack(items, np.tile(capacity, (4, 1)), capacity)
    left, want = np.ones((4, 3)), np.zeros(40, dtype=int)
    scaled = items / capacity
    for i in sorted(range(40), key=lambda i: -scaled[i].max()):
        want[i] = max(range(4), key=lambda s: (float(left[s] @ scaled[i]), -s))
        left[want[i]] -= scaled[i]
    assert got.tolist() == want.tolist()


def units(text):
    """Paragraphs with their occurrences, by a walk over sentences and lines."""
    sentences = re.findall(rf"[^\n.!?]{{1,{fingerprints.CUT}}}[.!?]*\n*|[\n.!?]+", text or "")
    found, held = [], []
    for s in sentences:
        held.append(s)
        body = re.sub(r"[.!?]*\n*$", "", s)
        ends = "\n" in s or not body or body[-1] in "aeiouy" or "À" <= body[-1] <= "￿" or not re.search(r"[.!?]$", s)
        if ends or len(held) == fingerprints.MANY:
            found.append("".join(held))
            held = []
    return set(Counter([*found, *(["".join(held)] if held else [])]).items())


def likeness(a, b):
    x, y = units(a), units(b)
    return 1 - len(x ^ y) / (len(x) + len(y)) if x or y else 1.0


def compared(spark, pairs):
    df = spark.createDataFrame(pairs, "id long, a string, b string")
    made = fingerprints.fingerprint(fingerprints.fingerprint(df, "a", "a"), "b", "b")
    return {r["id"]: r for r in fingerprints.with_likeness(made, "a", "b", "near").collect()}


def test_fingerprints(spark):
    text = "One. Two! Three?\nFour. Five. Two! Six\n" + " ".join(f"Sentence {i} {'abcdefghij'[i % 10]}." for i in range(60))
    pairs = [(1, text, text), (2, text, text.replace("Sentence 7 ", "Changed ")), (3, None, ""), (4, "a. a. a.", "a. a."), (5, text, "Wholly. Different."), (6, text, "x " * 9000), (7, "one", "two"), (8, text, text[: len(text) * 3 // 4] + text[:40])]
    got = compared(spark, pairs)
    for k, a, b in pairs:
        assert got[k]["near"] == pytest.approx(likeness(a, b), abs=1e-9), k
        assert {(x["k"], x["c"]) for x in got[k]["near_keys"]} == {(x, 1) for x in set(got[k]["a_keys"]) - set(got[k]["b_keys"])} | {(x, -1) for x in set(got[k]["b_keys"]) - set(got[k]["a_keys"])}
    assert got[1]["a_fingerprint"] == got[1]["b_fingerprint"] == got[2]["a_fingerprint"] != got[2]["b_fingerprint"]


def test_fingerprints_know_no_lengths(spark):
    lines = "".join(f"Line {i} of a text. It has two sentences.\n" for i in range(2500))
    plain = " ".join(f"word{i} and sentence ends here. Then it goes on{' and on' * (i % 5)}." for i in range(1500))
    sizes = [(4090, 4100), (4100, 4090), (16380, 16390), (4328, 3940), (20000, 3000), (65530, 65540), (65540, 49000)]
    pairs = [(2 * i + j, t[:n], t[:m]) for i, (n, m) in enumerate(sizes) for j, t in enumerate((lines, plain))]
    got = compared(spark, pairs)
    assert {k: r["near"] for k, r in got.items()} == pytest.approx({k: likeness(a, b) for k, a, b in pairs}, abs=1e-9)
    assert min(got[k]["near"] for k in (0, 1, 2, 3, 4, 5, 10, 11)) > 0.95


def test_fingerprints_of_long_texts(spark):
    def text(n, changed):
        return "".join(f"{'Other' if i >= n - changed else 'A'} line {i}.\n" for i in range(n))

    pairs = [(n * 10 + k, text(n, 0), text(n, changed)) for n in (1000, 4000) for k, changed in enumerate((n // 4, n))]
    got = compared(spark, pairs)
    assert {k: r["near"] for k, r in got.items()} == pytest.approx({k: likeness(a, b) for k, a, b in pairs}, abs=1e-9)
    assert len(got[40000]["near_keys"]) == 2000


def plain_edits(docs):
    """By key and text: n_chars, the edited text, and both likenesses."""
    order, out = sorted(set(docs), key=lambda d: (d[0] is not None, d[0] or 0, d[2])), {}
    for i, (k, t, _) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        q = len(t) // 4
        edited = t[: len(t) - q] + following[:q]
        out[k, t] = len(t), hashlib.sha256(edited.encode()).hexdigest(), likeness(t, edited), likeness(t, following)
    return out


def test_fingerprint_query(spark):
    docs = [(r["doc_id"], r["text"] or "", 0) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = plain_edits(docs)
    found = fingerprints.op5_fingerprints(spark, SF)
    got = {r["doc_id"]: r for r in found.collect()}
    assert len(got) == len(docs)
    for k, t, _ in docs:
        n, digest, near, following = want[k, t]
        assert (got[k]["n_chars"], got[k]["edited_sha256"]) == (n, digest)
        assert (got[k]["near_edited"], got[k]["near_next"]) == (pytest.approx(near, abs=1e-9), pytest.approx(following, abs=1e-9)), k
    assert found.where("near_edited = 0").count() == sum(w[2] == 0 for w in want.values())


def test_fingerprint_edges(spark):
    rows = [(None, "No key. At all.", "c"), (None, "Another one. Of them.", "c"), (3, "Twice. The key.", "c"), (3, "Twice the key, not the text.", "c"), (5, "Same row.", "c"), (5, "Same row.", "c"), (7, None, "c"), (8, "", "c"), (9, "é" * 3 + "😀" * 9, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    hashed = df.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    want = plain_edits([(r["doc_id"], r["text"] or "", r["h"]) for r in hashed])
    got = fingerprints.compare_edits(df).collect()
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in got) == sorted((str(k), n, d, round(a, 9), round(b, 9)) for (k, t, _) in ((r["doc_id"], r["text"] or "", 0) for r in hashed) for n, d, a, b in [want[k, t]])
    assert fingerprints.compare_edits(df.limit(0)).count() == 0
    alone = fingerprints.compare_edits(df.limit(1)).first()
    assert alone["near_next"] == 1.0


def test_quotations(spark):
    rows = [
        (1, 0, "u", "Hello there.\nHow are you today?\nBye"),
        (1, 1, "a", "> how are  you TODAY?\nFine, thanks."),
        (1, 1, "a", "> how are  you TODAY?\nFine, thanks."),
        (1, 2, "u", ">> How are you today?\n> Fine, thanks.\nGood to hear"),
        (2, 0, "u", "> Fine, thanks.\nquoting other"),
        (2, 1, "a", None),
        (2, 2, "u", "> Hello there.\n> How are you today?\n> something new\nnew text"),
        (None, 3, "u", "> Bye\nx"),
        (3, 0, "u", "> ...\n> nothing known at all"),
        (3, 1, "u", "a root"),
        (3, 2, "u", "another"),
        (3, 3, "u", "> a root\nreply"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): r for r in quotes.reply_order(df).collect()}
    assert quotes.reply_order(df).count() == len(rows)
    assert [got[1, t]["text"] for t in (1, 2)] == ["Fine, thanks.", "Good to hear"]
    assert (got[1, 1]["source_conv"], got[1, 1]["source_turn"], got[1, 1]["reply_to"]) == (1, 0, 0)
    assert (got[1, 2]["n_linked"], got[1, 2]["reply_to"]) == (2, 1)
    assert (got[2, 0]["source_conv"], got[2, 0]["source_turn"], got[2, 0]["reply_to"]) == (1, 1, None)
    assert (got[2, 2]["source_conv"], got[2, 2]["source_turn"], got[2, 2]["depth"]) == (1, 0, 2)
    assert got[3, 0]["n_linked"] == 0 and got[None, 3]["text"] == "x"
    assert (got[3, 3]["reply_to"], got[3, 3]["thread"], got[3, 3]["depth"]) == (1, 0, 2)
    assert quotes.reply_order(df.limit(0)).count() == 0


def plain_links(rows):
    """For each row its passages, links, first source, reply, thread and depth: whole hashes first, then the message with most
    lines, at least half."""
    parsed = [(c, t, *quotes.parse(x)) for c, t, x in rows]
    known = defaultdict(set)
    for c, t, _, names, _ in parsed:
        if c is not None and t is not None:
            for n in names:
                known[n].add((c, t))
    out = []
    for c, t, _, _, passages in parsed:
        found = []
        for place, q in enumerate(passages):
            def source(name):
                inner = [m for m in known[name] if m[0] == c and t is not None and m[1] < t]
                outer = [m for m in known[name] if m[0] != c]
                return max(inner) if inner else min(outer) if outer and c is not None else None

            best = source(q["hash"])
            lines = set(q["lines"])
            if best is None and c is not None:
                votes = Counter()
                for m in {m for n in lines for m in known[n]}:
                    if m[0] != c or m[1] < t:
                        votes[m] = sum(m in known[n] for n in lines)
                inner = [(n, m) for m, n in votes.items() if m[0] == c]
                outer = sorted((-n, m) for m, n in votes.items() if m[0] != c)
                a, b = (max(inner) if inner else None), ((-outer[0][0], outer[0][1]) if outer else None)
                n, m = a if a and (not b or a[0] >= b[0]) else b if b else (0, None)
                best = m if 2 * n >= len(lines) and n else None
            if best is not None:
                found.append((q["level"], place, *best))
        first = min(found, default=(None,) * 4)
        inner = min((f for f in found if f[2] == c), default=None)
        out.append((c, t, len(passages), len(found), first[2], first[3], inner))
    turns, up = defaultdict(set), {}
    for c, t, *_ in out:
        if c is not None and t is not None:
            turns[c].add(t)
    for i, (c, t, n, linked, sc, st, inner) in enumerate(out):
        parent = inner[3] if inner else None
        if parent is None and c is not None and t is not None:
            parent = max((x for x in turns[c] if x < t), default=None)
        out[i] = c, t, n, linked, sc, st, parent
        if c is not None and t is not None and parent is not None:
            up[c, t] = min(up.get((c, t), parent), parent)

    def root(c, t):
        depth = 0
        while (c, t) in up:
            t, depth = up[c, t], depth + 1
        return t, depth

    return Counter((*r, *(root(*r[:2]) if None not in r[:2] else (r[1], 0))) for r in out)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_quotations_by_brute_force(spark, kind):
    import random

    rng = random.Random(2)
    lines = [f"line number {i} says this" for i in range(25)]
    rows, said = [], []
    for c in range(12):
        for t in range(rng.randint(1, 6)):
            own = rng.sample(lines, rng.randint(1, 4))
            text = "\n".join(own)
            if said and rng.random() < 0.8:
                body = rng.choice(said)
                body = body[: rng.randint(1, len(body))] + ([rng.choice(lines)] if rng.random() < 0.3 else [])
                text = "\n".join(f"> {x}" for x in body) + "\n" + text
            said.append(own)
            rows.append((c if kind == "long" else f"c{c:02d}", t, text))
    rows += [(None, 1, "> " + lines[0]), (rows[0][0], None, "> " + lines[1]), (rows[0][0], 99, None), (rows[0][0], 98, "> x\n" * 20_000)]
    df = spark.createDataFrame([(*r[:2], "u", r[2], "clash") for r in rows], f"conv_id {kind}, turn long, role string, text string, depth string")
    assert answers(quotes.reply_order(df)) == plain_links(rows)


def answers(df):
    return Counter(tuple(r[c] for c in ("conv_id", "turn", "n_quotes", "n_linked", "source_conv", "source_turn", "reply_to", "thread", "depth")) for r in df.collect())


def test_quotations_in_whole_conversations(spark):
    """The given conversations, in which every turn quotes what stands before it: the turn before, lines of another conversation,
    or what that quoted in turn."""
    given = sorted((r["conv_id"], r["turn"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").collect())
    rows = []
    for i, (c, t, text) in enumerate(given):
        before, far = given[i - 1][2] if i else "", given[i * 7 % len(given)][2]
        quoted = [f"> {x}" for x in before.split("\n")] if i % 3 else [f"> {x}" for x in far.split("\n")[:2]]
        nested = [f">> {x}" for x in far.split("\n")[-1:]] if i % 4 == 0 else []
        rows.append((c, t, "\n".join([*nested, *quoted, text])))
    df = spark.createDataFrame([(c, t, "u", x) for c, t, x in rows], "conv_id long, turn long, role string, text string").repartition(3)
    want = plain_links(rows)
    assert answers(quotes.reply_order(df)) == want
    assert sum(k[3] * n for k, n in want.items()) > 300


def test_quotations_of_other_conversations(spark):
    rows = [
        (5, 0, "u", "> A passage of nine.\nwhat is this"),
        (5, 1, "u", "A passage of nine."),
        (9, 4, "u", "A passage of nine.\nand more"),
        (1, 0, "u", "line one\nother"),
        (2, 0, "u", "line two\nother b"),
        (3, 0, "u", "line three\nother c"),
        (4, 0, "u", "line one\nbetween\nline two\nline three"),
        (6, 0, "u", "> line one\n> line two\n> line three\n> line four\n> line five\nasks"),
        (7, 0, "u", "> line one\n> unknown\nasks"),
        (8, 0, "u", "> line one\n> unknown\n> unknown too\nasks"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["turn"]): (r["source_conv"], r["source_turn"]) for r in quotes.reply_order(df).collect()}
    assert [got[c, 0] for c in (5, 6, 7, 8)] == [(9, 4), (4, 0), (1, 0), (None, None)]


def plain_clean(docs, items):
    """Keys of the texts in which no window is like an item; windows are compared where a text has a shingle of the item."""
    from test_dedup import plain_matches

    grams = lambda t: {tuple(w[i : i + 5]) for w in [(t or "").lower().split()] for i in range(len(w) - 4)}
    of_items = [(i, u, grams(u)) for i, u in items]
    hit = set()
    for k, t in docs:
        mine = grams(t)
        near = [(i, u) for i, u, g in of_items if g & mine or len(u.split()) < 5]
        if near and plain_matches([(k, t)], near):
            hit.add(k)
    return {k for k, _ in docs} - hit


def test_pipeline(spark):
    """Each stage against a brute-force version on the rows that reach it."""
    from test_dedup import plain_kept, plain_removal
    from tokenizers import Tokenizer

    import corpus_pipeline as c
    from quire.llm.bpe import default_vocabulary

    docs, steps = spark.read.parquet(f"{SF}/documents.parquet"), {}
    before = docs
    for name, stage in c.STAGES:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns or name == "bpe", name
        rows = after.collect()
        steps[name] = [(r["doc_id"], r["text"]) for r in rows]
        if name != "bpe":
            before = spark.createDataFrame(rows, docs.schema)
    keys = {name: {k for k, _ in rows} for name, rows in steps.items()}
    first = sorted(steps["language_id"])
    trees = language_id.learn(docs)
    every = [(r["doc_id"], r["text"]) for r in docs.collect()]
    bits, raw = trees.measure([(t or "").encode() for _, t in every])
    assert keys["language_id"] == {k for (k, t), b, n in zip(every, bits, raw, strict=True) if any(x.isalpha() for x in t or "") and b.min() < 8 * n}
    assert keys["simhash_near_dedup"] == plain_kept(first)
    cut = plain_removal(steps["simhash_near_dedup"])
    got = {k: (t or "").encode().split() for k, t in steps["substring_dedup"]}
    assert {k: hashlib.sha256(b" ".join(w)).hexdigest() for k, w in got.items()} == {k: d for k, (n, gone, d) in cut.items() if gone == 0 or gone < n}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert keys["benchmark_decontamination"] == plain_clean(steps["substring_dedup"], items)
    out, plain = c.run(spark, SF).collect(), Tokenizer.from_file(default_vocabulary())
    assert {r["doc_id"]: (r["token_ids"], r["round_trip"]) for r in out} == {k: (plain.encode(t or "", add_special_tokens=False).ids, True) for k, t in steps["benchmark_decontamination"]}


def test_pipeline_edges(spark):
    """Each stage on null keys and texts, empty, long and repeated rows and a clashing column, and on an empty table."""
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("n_removed", F.lit("clash"))
    text = docs.where("length(text) > 500").orderBy("doc_id").first()["text"]
    rows = [(None, None, "en", "s", 0, "c"), (None, text, "en", "s", 1, "c"), (10**6, "", "en", "s", 0, "c"), (10**6 + 1, text * 60, "en", "s", 1, "c"), (10**6 + 2, "Once more. " + text, "en", "s", 1, "c"), (10**6 + 2, "Once more. " + text, "en", "s", 1, "c")]
    extra = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    for name, stage in c.STAGES:
        got = stage(spark, extra, SF)
        assert got.columns[: len(docs.columns)] == docs.columns and 0 < got.count() <= extra.count(), name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
