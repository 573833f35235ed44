"""BPE against the tokenizers library."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quire.llm import bpe, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = [*"abcdefghijklmnopqrstuvwxyz  ''\n\t.,!?AEIO0123éß中ё😀 　", "<|endoftext|>", "  ", "\n\n", " 's", "'ll", "\x1c", "\x85", "aaaa", "====", "    "]


@pytest.fixture(scope="module")
def known():
    with open(PATH, "rb") as f:
        return bpe.Vocabulary(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def cases():
    rng = random.Random(1)
    made = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(5000)]
    return [*made, *("a" * n for n in range(70)), *("=" * n for n in range(150)), "ab" * 2000, " " * 500, ""]


def test_encode_and_decode(known, library):
    texts = cases()
    for text, ids in zip(texts, known.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert known.decode(ids.tolist()) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_decode_any_ids(known, library):
    rng = random.Random(2)
    for _ in range(500):
        ids = [rng.randrange(known.size) for _ in range(20)]
        assert known.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert known.decode([None, -1, known.size, 64]) == known.decode([64])


def test_small_caches(known, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    texts = cases()[:600]
    for lo in range(0, 600, 40):
        for text, ids in zip(texts[lo : lo + 40], known.encode(texts[lo : lo + 40]), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_frame(spark, library):
    rows = [(1, None, "x"), (2, "", "y"), (3, "Hello there", "z"), (3, "Hello there", "z"), (4, "long word " * 30000, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    got = bpe.encode(df, PATH, decoded="back").select("*", bpe.decode(df, "token_ids", PATH).alias("again")).collect()
    assert len(got) == 5
    for r in got:
        assert r["token_ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["back"] == r["again"] == (r["text"] or "")
    assert bpe.encode(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("rule", tokens.RULES)
def test_attribution(spark, library, rule):
    text = "A first line\nsecond wörld 😀😀 line\n\nend" * 3
    rng = random.Random(4)
    cuts = sorted(rng.sample(range(1, len(text)), 9))
    spans = [(str(i), a, b) for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(text)], strict=True)) if i != 4]
    df = spark.createDataFrame([(7, text, spans), (8, None, [("n", 0, 0)]), (9, "x", None)], "id long, text string, s array<struct<name:string,start:int,stop:int>>")
    got = {(r["id"], r["section"]): (r["n_tokens"], r["n_partial"]) for r in tokens.attribute(df, ["id"], PATH, sections="s", rule=rule).collect()}
    want = {(7, n): [0.0, 0] for n, _, _ in spans} | {(8, "n"): [0.0, 0]}
    for a, b in library.encode(text, add_special_tokens=False).offsets:
        shared = {n: min(b, y) - max(a, x) for n, x, y in spans if min(b, y) > max(a, x)}
        for n, k in shared.items():
            want[7, n][1] += k < b - a
        if rule == "split":
            for n, k in shared.items():
                want[7, n][0] += k / (b - a)
        elif rule == "most" and shared:
            want[7, max(shared, key=lambda n: shared[n])][0] += 1
        elif rule in ("start", "end"):
            at = a if rule == "start" else b - 1
            for n in [n for n, x, y in spans if x <= at < y]:
                want[7, n][0] += 1
    assert {k: (pytest.approx(v[0]), v[1]) for k, v in want.items()} == got


def test_lines_and_fields(spark, library):
    df = spark.createDataFrame([(1, "ab\ncd ef\n"), (2, ""), (3, None)], "id long, text string")
    got = sorted((r["id"], int(r["section"]), r["n_chars"]) for r in tokens.attribute(df, ["id"], PATH).collect())
    assert got == [(1, 0, 3), (1, 1, 6), (1, 2, 0), (2, 0, 0)]
    both = tokens.fields(spark.createDataFrame([("Hello int", "eresting x")], "a string, b string"), ["a", "b"])
    total = tokens.attribute(both, [], PATH, sections="sections").agg(F.sum("n_tokens")).first()[0]
    assert total == len(library.encode("Hello interesting x", add_special_tokens=False).ids)


def test_clashing_ids(spark, library):
    df = spark.createDataFrame([(1, "a", "ab\ncd"), (1, "a", "ab\ncd"), (2, None, "long text " * 30_000)], "doc_id long, section string, text string")
    got = tokens.attribute(df.withColumn("n_tokens", F.lit("x")), ["doc_id", "section", "n_tokens", "text"], PATH)
    assert got.columns == ["doc_id", "section_id", "n_tokens_id", "text", "section", "first_char", "n_chars", "n_tokens", "n_partial"]
    rows = got.collect()
    assert sorted((r["doc_id"], str(r["section_id"]), r["section"], r["n_tokens_id"]) for r in rows) == [(1, "a", "0", "x"), (1, "a", "0", "x"), (1, "a", "1", "x"), (1, "a", "1", "x"), (2, "None", "0", "x")]
    assert sum(r["n_tokens"] for r in rows if r["doc_id"] == 2) == len(library.encode("long text " * 30_000, add_special_tokens=False).ids)


def test_long_word_beside_many(known, library):
    """A word of 100,000 letters costs its own steps, not those times all other new words."""
    import random
    import time

    rng = random.Random(1)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(100_000))
    texts = [word, *["".join(rng.choice("etaoinshr") for _ in range(9)) for _ in range(50_000)]]
    began = time.process_time()
    got = list(known.encode(texts))
    assert time.process_time() - began < 30
    assert [list(x) for x in got[:200]] == [library.encode(t, add_special_tokens=False).ids for t in texts[:200]]


def test_query_is_whole(spark, library):
    sf = "/root/testdata/sf0.001"
    got = bpe.op2_bpe_round_trip(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert got.count() == docs.count()
    same = got.join(docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("h")), "doc_id").where("h = decoded_sha256").count()
    assert same == docs.count()
    lined = tokens.op8_token_counts(spark, sf).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).join(got, "doc_id")
    assert lined.where("n <> n_tokens").count() == 0
