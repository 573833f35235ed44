"""SimHash near-duplicates by a binary trie self-join.

A fingerprint has 64 bits, each the majority of that bit over the XXH64 values of a text's word shingles. Two fingerprints
link when they differ in RADIUS bits at most. The links come from a self-join of a binary trie: node pairs go down together
one bit at a time, the differing bits so far are added up, and a pair is dropped as soon as its budget is exceeded.

The 64 bits form a ring of r + 1 segments. For two fingerprints within r bits there is a segment to start from such that the
first i segments hold at most i * r / (r + 1) of the differing bits, for every i (the pigeonring principle). So r + 1 tries are
walked, one from each segment, with budgets that grow from 0 with depth; that loses no link and visits far fewer node pairs
than one walk with the whole budget throughout.

For similarities that need a large radius, a fingerprint can have further 64-bit words; a pair within the radius in the first
word links only if all words together differ in `most` bits at most.

Spark deals out the upper levels: a task gets the subtree below one prefix and the subtrees whose prefix is within the
budget. It walks the rest in NumPy, in chunks of bounded size. Node pairs whose members are connected already are dropped
too, and a task returns a spanning forest, so a dense cluster never turns into all its pairs. Components of the forests are
found by alternating star contractions in Spark. Equal fingerprints count once throughout.

Defined cases: null text and text without words have fingerprint 0, which links like any other; a text with fewer words
than a shingle has its whole word sequence as its only shingle; ties (half the shingles) give a 0 bit; rows with a null key
get a null component unless an equal or linked fingerprint has a key; keys may have any type that has an order; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm._common import Words, cut, drop_path, grams, mix, scratch, utf8
from quire.operators import scans

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Fingerprints below one prefix, roughly; node pairs in a chunk; member pairs at which a node pair is compared directly.
SUBTREE, CHUNK, LEAF = 8192, 1 << 18, 32
#: Members of a group above which it goes deeper, by so many levels.
CROWD, STEP = 1 << 17, 4
#: The share of distinct shingles that near-duplicates have in common (of those that either has), and bytes of text in a block.
ALIKE, BLOCK = (4, 5), 16 << 20


def fingerprint(text: bytes, shingle: int = SHINGLE, words: int = 1, once: bool = False) -> list[int]:
    """The fingerprint's words as unsigned numbers: the first of the XXH64 values, others of values mixed from them.

    once: a shingle that repeats counts once.
    """
    from xxhash import xxh64_intdigest

    found = text.lower().split()  # of bytes: A-Z only, and exactly the white space \x20\x09-\x0D
    if not found:
        return [0] * words
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), dtype=np.int64, count=len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(found) > shingle:
        starts, ends = starts[: len(found) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    h = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], dtype="<u8")
    if once:
        h = np.unique(h)
    out = []
    for k in range(words):
        values = mix(h + np.uint64(k << 56)) if k else h
        ones = np.zeros(64, dtype=np.int64)
        for lo in range(0, len(h), 1 << 15):
            ones += np.unpackbits(values[lo : lo + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out.append(sum(1 << i for i in np.flatnonzero(2 * ones > len(h)).tolist()))
    return out


def fingerprint_column(text: str | Column, shingle: int = SHINGLE, words: int = 1, once: bool = False) -> Column:
    """The fingerprint of each whole text, an array of signed longs."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def run(column: pa.Array) -> pa.Array:
        import pyarrow.compute as pc

        found = np.array([fingerprint(x or b"", shingle, words, once) for x in pc.cast(column, pa.binary()).to_pylist()], dtype=np.uint64)
        ends = np.arange(0, len(column) * words + 1, words, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel().view(np.int64)))

    return run(text)


def hex_of(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots of all members after the links i - j; a root is the smallest member of its component."""
    while len(i):
        a, b = parent[i], parent[j]
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        parent = roots(parent)
    return parent


def segments(radius: int) -> list[int]:
    """The sizes of the ring's segments."""
    m = radius + 1
    return [64 * (i + 1) // m - 64 * i // m for i in range(m)]


def budgets(radius: int, first: int) -> list[int]:
    """The budget after 0, 1, ... 64 levels of the trie that starts with segment `first`."""
    size = segments(radius)
    out = [0]
    for i in range(radius + 1):
        out += [(i + 1) * radius // (radius + 1)] * size[(first + i) % (radius + 1)]
    return out


def walk(keys: np.ndarray, home: int, radius: int, depth: int, budget: list[int], whole: np.ndarray | None = None, most: int = 64) -> np.ndarray:
    """Join the subtree below one prefix with itself and with the other subtrees: a root for each of `keys`.

    keys: sorted; home: how many of them, in front, are below the home prefix of `depth` bits. Others have greater prefixes.
    budget: by level. whole: all words of each fingerprint, of which `most` bits may differ.
    """
    n = len(keys)
    parent = np.arange(n)
    if home == 0 or n < 2:
        return parent
    tops = keys >> np.uint64(64 - depth) if depth else np.zeros(n, dtype=np.uint64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(tops)) + 1])
    last = np.concatenate([first[1:], [n]])
    err = np.bitwise_count(tops[first] ^ tops[0]).astype(np.int64)
    size = len(first)
    stack = [(depth, np.zeros(size, np.int64), np.full(size, home), first, last, err)]
    while stack:
        d, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > CHUNK:
            half = len(alo) // 2
            stack += [(d, *(x[half:] for x in (alo, ahi, blo, bhi, err))), (d, *(x[:half] for x in (alo, ahi, blo, bhi, err)))]
            continue
        turn = np.concatenate([[0], np.cumsum(np.diff(parent) != 0)])
        joined = (parent[alo] == parent[blo]) & (turn[ahi - 1] == turn[alo]) & (turn[bhi - 1] == turn[blo])
        on = ~joined
        alo, ahi, blo, bhi, err = alo[on], ahi[on], blo[on], bhi[on], err[on]
        leaf = (ahi - alo) * (bhi - blo) <= LEAF
        if leaf.any():
            parent = compare(keys, parent, alo[leaf], ahi[leaf], blo[leaf], bhi[leaf], radius, whole, most)
        on = ~leaf
        alo, ahi, blo, bhi, err = alo[on], ahi[on], blo[on], bhi[on], err[on]
        if not len(alo):
            continue
        if d < 64:
            shift = np.uint64(63 - d)
            amid = np.searchsorted(keys, (keys[alo] >> shift | np.uint64(1)) << shift)
            bmid = np.searchsorted(keys, (keys[blo] >> shift | np.uint64(1)) << shift)
        else:  # equal keys with other words: halve the ranges
            amid, bmid = (alo + ahi) // 2, (blo + bhi) // 2
        same, more = alo == blo, int(d < 64)
        cross = (amid, np.where(same, amid, ahi), blo, np.where(same, blo, bmid), err + more)  # once for a node with itself
        ways = [(alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err), (alo, amid, bmid, bhi, err + more), cross]
        d = min(64, d + 1)
        alo, ahi, blo, bhi, err = (np.concatenate(x) for x in zip(*ways, strict=True))
        on = (ahi > alo) & (bhi > blo) & (err <= budget[d])
        stack.append((d, alo[on], ahi[on], blo[on], bhi[on], err[on]))
    return parent


def compare(keys: np.ndarray, parent: np.ndarray, alo: np.ndarray, ahi: np.ndarray, blo: np.ndarray, bhi: np.ndarray, radius: int, whole: np.ndarray | None, most: int) -> np.ndarray:
    """Compare all members of small node pairs and unite those that link."""
    area = (ahi - alo) * (bhi - blo)
    for lo in range(0, len(area), 1 << 15):
        part = slice(lo, lo + (1 << 15))
        size = area[part]
        pair = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        wide = (bhi[part] - blo[part])[pair]
        i, j = alo[part][pair] + place // wide, blo[part][pair] + place % wide
        near = np.flatnonzero((i != j) & (np.bitwise_count(keys[i] ^ keys[j]) <= radius))
        i, j = i[near], j[near]
        if whole is not None and len(i):
            near = np.bitwise_count(whole[i] ^ whole[j]).sum(axis=1, dtype=np.int64) <= most
            i, j = i[near], j[near]
        parent = unite(parent, i, j)
    return parent


def allowed(budget: list[int], depth: int, bits: int, err: int) -> list[int]:
    """The masks of `bits` further levels below a node pair of `depth` levels with `err` differing bits that stay within budget."""
    out = []
    for k in range(budget[depth + bits] - err + 1):
        for places in combinations(range(bits), k):  # from the lowest level up
            if all(err + sum(bits - 1 - p < d for p in places) <= budget[depth + d] for d in range(bits + 1)):
                out.append(sum(1 << p for p in places))
    return out


def links(vertices: DataFrame, radius: int = RADIUS, most: int | None = None, searched: int = 1) -> DataFrame:
    """A spanning forest (u, w: vertices, u > w) of the links between distinct fingerprints.

    vertices: fp (array of longs, distinct) and v, of any type that has an order. most: bits that may differ over all words; by default the first decides.
    searched: how many of the words are searched, each for pairs within the radius.

    A group is what meets at one prefix of one trie. A group of more than CROWD members goes STEP levels deeper, until none is
    left, so that many alike fingerprints don't end in one task.
    """
    n = vertices.count()
    size, tries = segments(radius), radius + 1
    depth = min(40, max(min(6, size[0]), int(np.ceil(np.log2(max(n, 1) / SUBTREE)))))
    # One literal array deals each fingerprint to all tries: a code is the trie's number and a mask.
    codes = [(w * tries + t) << 41 | m for w in range(searched) for t in range(tries) for m in allowed(budgets(radius, t), 0, depth, 0)]
    sent = vertices.withColumn("code", F.explode(F.lit(codes).cast("array<long>"))).withColumn("trie", F.shiftright("code", 41).cast("int")).withColumn("mask", F.expr("code & ((1L << 41) - 1)"))
    sent = sent.withColumn("word", F.get("fp", F.expr(f"trie div {tries}").cast("int"))).withColumn("turn", F.get(F.lit([sum(size[:t]) for t in range(tries)]), F.col("trie") % tries))
    sent = sent.withColumn("key", F.expr("shiftleft(word, turn) | shiftrightunsigned(word, 64 - turn)"))  # a shift by 64 is none
    own = F.shiftrightunsigned("key", 64 - depth)
    sent = sent.withColumn("prefix", own.bitwiseXOR(F.col("mask"))).where(F.col("prefix") <= own)
    level = sent.select("trie", "prefix", F.bit_count("mask").cast("int").alias("err"), "key", "v", *["fp"] * (most is not None))
    spark, dealt, folder = vertices.sparkSession, None, None
    while True:
        part = level.withColumn("depth", F.lit(depth).cast("int"))
        crowded = level.groupBy("trie", "prefix").agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select("trie", "prefix")
        if depth + STEP <= 64:
            folder = folder or scratch(spark)
            crowded = cut(crowded, folder, f"crowded{depth}")
            if crowded.limit(1).count():
                part = part.join(crowded, ["trie", "prefix"], "left_anti")
        dealt = part if dealt is None else dealt.unionByName(part)
        if depth + STEP > 64 or not crowded.limit(1).count():
            break
        ways = [(w * tries + t, e, m, m.bit_count()) for w in range(searched) for t in range(tries) for e in range(radius + 1) if e <= budgets(radius, t)[depth] for m in allowed(budgets(radius, t), depth, STEP, e)]
        ways = F.broadcast(spark.createDataFrame(ways, "trie int, err int, more long, errs int"))  # tries x (radius + 1) x 2 ** STEP rows at most
        own = F.shiftrightunsigned("key", 64 - depth - STEP)
        down = F.shiftleft("prefix", STEP).bitwiseOR(own.bitwiseAND(F.lit((1 << STEP) - 1)).bitwiseXOR(F.col("more")))
        below = level.join(crowded, ["trie", "prefix"], "left_semi").join(ways, ["trie", "err"]).withColumn("prefix", down).where(F.col("prefix") <= own)
        depth += STEP
        level = cut(below.withColumn("err", F.col("err") + F.col("errs")).select(level.columns), folder, f"level{depth}")

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("v")  # a smaller place is a smaller vertex
        keys = table.column("key").to_numpy().view(np.uint64)
        trie, prefix, depth = (table.column(c)[0].as_py() for c in ("trie", "prefix", "depth"))
        order = np.argsort(keys)
        keys, whole = keys[order], None
        if most is not None:
            whole = np.array(table.column("fp").combine_chunks().flatten()).view(np.uint64).reshape(len(keys), -1)[order]
        home = int((keys >> np.uint64(64 - depth) == np.uint64(prefix)).sum())
        root = walk(keys, home, radius, depth, budgets(radius, trie % tries), whole, 64 if most is None else most)
        moved = np.flatnonzero(root != np.arange(len(root)))
        a, b, v = order[moved], order[root[moved]], table.column("v")
        return pa.table({"u": v.take(np.maximum(a, b)), "w": v.take(np.minimum(a, b))})

    return dealt.drop("err").groupBy("trie", "depth", "prefix").applyInArrow(join, pair_of(vertices)).distinct()


def pair_of(vertices: DataFrame) -> T.StructType:
    kind = vertices.schema["v"].dataType
    return T.StructType([T.StructField("u", kind), T.StructField("w", kind)])


def components(forest: DataFrame, folder: str) -> DataFrame:
    """Columns v, root (the smallest vertex reachable) for the vertices of the links u > w, by alternating star contractions.

    Large star: each vertex links its greater neighbours to the smallest vertex it knows. Small star: each vertex links its
    smaller neighbours and itself to the smallest of them. Each half round is aggregation and an equi-join on written
    tables (so that a hub is split as a skewed join side), and ends when the links no longer change.
    """
    spark, now, step = forest.sparkSession, cut(forest, folder, "links0"), 0
    print_of = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "w").cast("decimal(38,0)"))).first())
    seen = print_of(now)
    while seen[0]:
        step += 1
        both = now.unionByName(now.select(F.col("w").alias("u"), F.col("u").alias("w")))
        least = cut(both.groupBy("u").agg(F.min("w").alias("m")).select("u", F.least("u", "m").alias("m")), folder, f"large{step}")
        star = cut(both.where("w > u").join(least, "u").select(F.col("w").alias("u"), F.col("m").alias("w")).where("u <> w").distinct(), folder, f"star{step}")
        least = cut(star.groupBy("u").agg(F.min("w").alias("m")), folder, f"small{step}")
        pairs = star.join(least, "u").select(F.explode(F.array(F.struct(F.col("w").alias("u"), F.col("m").alias("w")), F.struct("u", F.col("m").alias("w")))).alias("e")).select("e.*")
        after = cut(pairs.where("u <> w").distinct(), folder, f"links{step}")
        for name in (f"large{step}", f"star{step}", f"small{step}", f"links{step - 1}"):
            drop_path(spark, f"{folder}/{name}")
        now, before, seen = after, seen, print_of(after)
        if seen == before:
            break
    return now.select(F.col("u").alias("v"), F.col("w").alias("root"))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS, words: int = 1, most: int | None = None) -> DataFrame:
    """Columns key, fp (the fingerprint's words, signed) and component (the smallest key reachable) for each row of docs."""
    folder = scratch(docs.sparkSession)
    rows = cut(docs.select(F.col(key).alias("k"), fingerprint_column(F.col(text), shingle, words).alias("fp")), folder, "rows")
    vertices = cut(rows.groupBy("fp").agg(F.min("k").alias("v")), folder, "vertices")
    found = components(links(vertices.where("v is not null"), radius, most), folder)
    whole = cut(vertices.join(found, "v", "left").select("fp", F.coalesce("root", "v").alias("component")), folder, "components")
    return rows.join(whole, "fp").select(F.col("k").alias(key), "fp", "component")


def shingles(text: bytes, shingle: int) -> np.ndarray:
    """The names of a text's distinct shingles, sorted."""
    name = Words([text.lower()]).name
    return np.unique(grams(name, min(shingle, len(name)))) if len(name) else name


def similar(prints: np.ndarray, texts: list[bytes], shingle: int, most: int, label: np.ndarray | None = None) -> np.ndarray:
    """For texts in the order of their keys, the place of the first member of each one's component.

    Two texts link if they share ALIKE of their distinct shingles; fingerprints more than `most` bits apart aren't compared, nor
    are texts that are known to be in one component (label).
    """
    sets = [shingles(text, shingle) for text in texts]
    size = np.array([len(x) for x in sets], dtype=np.int64)
    start = np.cumsum(size) - size
    known, ids = np.unique(np.concatenate(sets), return_inverse=True)
    marked, (part, whole) = np.zeros(len(known), dtype=bool), ALIKE
    if label is None:
        label = np.arange(len(texts))
    else:
        _, first, same = np.unique(label, return_index=True, return_inverse=True)
        label = first[same]
    for i in range(len(texts) - 1):
        j = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
        j = j[whole * np.minimum(size[j], size[i]) >= part * np.maximum(size[j], size[i])]
        j = j[np.bitwise_count(prints[j] ^ prints[i]).sum(axis=1, dtype=np.int64) <= most]
        if len(j) and size[i]:
            mine = ids[start[i] : start[i] + size[i]]
            marked[mine] = True
            ends = np.cumsum(size[j])
            flat = np.arange(ends[-1]) + np.repeat(start[j] - ends + size[j], size[j])
            shared = np.add.reduceat(marked[ids[flat]], ends - size[j], dtype=np.int64)
            marked[mine] = False
            j = j[whole * shared >= part * (size[i] + size[j] - shared)]
        if len(j):
            joined = np.unique(np.append(label[j], label[i]))
            label[np.isin(label, joined)] = joined[0]
    return label


def confirmed(pairs: DataFrame, members: DataFrame, shingle: int) -> DataFrame:
    """The pairs (u, w) whose texts are alike."""
    part, whole = ALIKE

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            on = []
            for a, b in zip(utf8(batch.column(2)), utf8(batch.column(3)), strict=True):
                x, y = shingles(a, shingle), shingles(b, shingle)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                on.append(whole * shared >= part * (len(x) + len(y) - shared))
            yield batch.select([0, 1]).filter(pa.array(on, pa.bool_()))

    of = lambda end, name: members.select(F.col("v").alias(end), F.col("text").alias(name))
    # A hub's text is one row on its side, so that a skewed join is split.
    return pairs.select("u", "w").join(of("u", "a"), "u").join(of("w", "b"), "w").select("u", "w", "a", "b").mapInArrow(check, pair_of(members))


def block_pairs(blocks: DataFrame) -> DataFrame:
    """candidate, a and b: the blocks that have to be compared, a <= b. blocks: candidate, block, lo and hi (the least and greatest
    label in it); a candidate's blocks are in order of labels.

    Blocks of one and the same label aren't, so a component of any size costs its blocks times the blocks with other labels.
    """
    inside = W.partitionBy("candidate").orderBy("block")  # a row for each block, not for its members
    change = F.when(~F.col("hi").eqNullSafe(F.lag("hi").over(inside)), F.col("block"))
    marked = blocks.withColumn("change", change).withColumn("last", F.max("block").over(W.partitionBy("candidate")))
    after = F.min("change").over(inside.rowsBetween(1, W.unboundedFollowing))
    first = marked.withColumn("first", F.when(F.col("lo") == F.col("hi"), after).otherwise(F.col("block"))).where("first is not null")
    return first.select("candidate", F.col("block").alias("a"), F.explode(F.sequence("first", "last")).alias("b"))


def verified(members: DataFrame, forest: DataFrame, shingle: int, most: int, folder: str) -> DataFrame:
    """Links (u, w: u > w) that connect the same members as all pairs of one `candidate` with a similarity of ALIKE do.

    members: candidate, v, fp, text. forest: links between fingerprints that make the candidates (u, w: the least v of each).
    A candidate of BLOCK bytes or less is one task's work. Of a larger one the links of the forest are verified first, which
    connects nearly all of a group of copies; then members are dealt into blocks in order of what is connected, and a task takes two
    blocks, unless all their members are connected already.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    whole = members.groupBy("candidate").agg(F.sum(size).alias("bytes"))
    sized = members.join(whole, "candidate")

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("v")
        v = table.column("v")
        prints = np.array(table.column("fp").combine_chunks().flatten()).view(np.uint64).reshape(len(v), -1)
        label = None
        if "label" in table.column_names:
            label = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        root = similar(prints, utf8(table.column("text")), shingle, most, label)
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"u": v.take(moved), "w": v.take(root[moved])})

    few = sized.where(F.col("bytes") <= BLOCK).select("candidate", "v", "fp", "text").groupBy("candidate").applyInArrow(join, pair_of(members))
    large = cut(sized.where(F.col("bytes") > BLOCK).select(*members.columns), folder, "large")
    if not large.limit(1).count():
        return few
    ends = large.select(F.col("v").alias("u"))
    least = large.groupBy("fp").agg(F.min("v").alias("w"))
    twins = large.select("fp", F.col("v").alias("u")).join(least, "fp").where("u <> w").select("u", "w")
    sure = cut(confirmed(forest.join(ends, "u", "left_semi").unionByName(twins), large, shingle), folder, "sure")
    known = components(sure, f"{folder}/sure_of")
    labelled = cut(large.select("candidate", "v", size.alias("bytes")).join(known, "v", "left").select("candidate", F.coalesce("root", "v").alias("label"), "v", "bytes"), folder, "labelled")
    run = scans.scan(labelled, ["candidate", "label", "v"], {"_s": scans.Running("sum", F.col("bytes"))})
    placed = cut(run.select("candidate", "label", "v", F.floor((F.col("_s") - F.col("bytes")) / BLOCK).alias("block")), folder, "placed")
    blocks = placed.groupBy("candidate", "block").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    pairs = cut(block_pairs(blocks), folder, "pairs")
    ways = pairs.select("candidate", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    dealt = placed.join(ways, ["candidate", "block"]).join(large.select("v", "fp", "text"), "v")
    many = dealt.groupBy("candidate", "a", "b").applyInArrow(join, pair_of(members))
    return few.unionByName(sure).unionByName(many).distinct()


def keep_one(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 5, radius: int = 13, words: int = 4, most: int = 63, searched: int = 2) -> DataFrame:
    """The rows of docs that have the smallest key of their component; texts link if they share ALIKE of their distinct shingles.

    Fingerprints of the distinct shingles, of `words` 64-bit words, only select candidates: those of which one of the first
    `searched` words differs in `radius` bits at most and all words in `most` bits at most. Texts of similarity 0.8 differ in 39
    of 256 bits on average, with a standard deviation of 6, and in 9.8 bits of a word, with one of 2.9, so about one pair in a
    hundred at exactly 0.8 and far fewer above it aren't candidates. What candidates link, directly or in chains, is compared
    exactly (by 64-bit names of shingles; `verified`). Rows with a null key are kept; an empty table gives no rows.
    """
    folder = scratch(docs.sparkSession)
    named = docs.select(F.col(key).alias("k"), fingerprint_column(F.col(text), shingle, words, True).alias("fp"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("same"))
    rows = cut(named.where("k is not null"), folder, "rows")
    texts = cut(rows.groupBy("fp", "same").agg(F.min("k").alias("v")), folder, "texts")
    prints = cut(texts.groupBy("fp").agg(F.min("v").alias("v")), folder, "prints")
    forest = cut(links(prints, radius, most, searched), folder, "forest")
    near = components(forest, f"{folder}/near")
    candidates = prints.join(near, "v", "left").select("fp", F.coalesce("root", "v").alias("candidate"))
    dealt = cut(texts.join(candidates, "fp").drop("same"), folder, "dealt")
    several = dealt.groupBy("candidate").agg(F.count("*").alias("n")).where("n > 1").select("candidate")
    members = cut(dealt.join(several, "candidate"), folder, "members")
    # Only texts that are compared are sent: their keys alone are tried first, which Spark broadcasts while their table is small.
    compared = cut(members.select("v"), folder, "compared")
    sent = docs.select(F.col(key).alias("v"), F.col(text).alias("text")).join(compared, "v", "left_semi")
    whole = cut(sent.join(members, "v").dropDuplicates(["v"]), folder, "whole")
    found = components(verified(whole, forest, shingle, most, folder), f"{folder}/found")
    first = texts.join(found, "v", "left").select("fp", "same", F.coalesce("root", "v").alias("component"))
    gone = cut(rows.join(first, ["fp", "same"]).where("k <> component").select(F.col("k").alias(key)).distinct(), folder, "gone")
    for name in ("rows", "texts", "prints", "forest", "near", "dealt", "members", "compared", "whole", "found", "large", "sure", "sure_of", "labelled", "placed", "pairs"):
        drop_path(docs.sparkSession, f"{folder}/{name}")
    return docs.join(gone, key, "left_anti")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = near_duplicates(docs).withColumn("word", F.col("fp")[0])
    return found.select("doc_id", hex_of("word").alias("fingerprint"), F.col("component").alias("component_id"))
