"""Conversations without quotations: quoted passages are linked to the messages they come from.

A line that starts with `>` signs is quoted at that level; a passage is a run of lines of one level. What remains is the
message's own text. Passages are normalised (lower case, single spaces) and hashed, and so are the whole own text, each run of
own lines and each own line of every message. A passage is joined to the message with that hash: within its conversation the
latest earlier one, otherwise the first (by conversation and turn) of all. A passage that no message has as a whole links
to the message that has most of its lines, at least half of them (of several such the latest earlier one of its conversation,
otherwise the first).

A message replies to the message of its own conversation that it quotes first, at the lowest level; without such a
quotation to the turn before. `thread` is the turn at the root of the replies and `depth` the number of replies up to it, so
ordering by conversation, thread and turn puts each reply after what it replies to.

A hash that many messages share is reduced to the first messages of its first two conversations before the join, and the
most common lines of a passage don't select candidates for it.

Defined cases: null text is empty; a message whose conversation or turn is null is a root of its own and nobody's source;
of rows that repeat a conversation and turn each is answered for, and as sources they count once; a message never links to
itself or, within its conversation, to a later turn; passages and lines without a letter or digit aren't linked.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm._common import cut, drop_path, scratch
from quire.llm.fingerprints import successors
from quire.operators import scans

_QUOTED = re.compile(r"[ \t]*((?:>[ \t]?)+)(.*)", re.DOTALL)
_KINDS = "own string, own_hashes array<long>, quotes array<struct<level:int,text:string,hash:long,lines:array<long>>>"


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def name_of(text: str) -> int | None:
    """The signed XXH64 of the normalised text; None without a letter or digit."""
    from xxhash import xxh64_intdigest

    plain = normal(text)
    if not any(c.isalnum() for c in plain):
        return None
    h = xxh64_intdigest(plain.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def parse(text: str | None) -> tuple[str, list[int], list[dict]]:
    """The own text, the hashes it can be quoted by, and the quoted passages."""
    runs: list[tuple[int, list[str]]] = []
    for line in (text or "").split("\n"):
        found = _QUOTED.match(line)
        level, body = (found[1].count(">"), found[2]) if found else (0, line)
        if not runs or runs[-1][0] != level:
            runs.append((level, []))
        runs[-1][1].append(body)
    mine = [x for level, x in runs if level == 0]
    own = "\n".join(line for x in mine for line in x)
    if any(level for level, _ in runs):
        own = own.strip("\n")
    names = [name_of(own), *[name_of("\n".join(x)) for x in mine], *[name_of(line) for x in mine for line in x]]
    quotes = []
    for level, x in runs:
        if level and (name := name_of("\n".join(x))) is not None:
            quotes.append({"level": level, "text": "\n".join(x), "hash": name, "lines": [n for line in x if (n := name_of(line)) is not None]})
    return own, list(dict.fromkeys(n for n in names if n is not None)), quotes


def parsed(messages: DataFrame, text: str, ids: list[str]) -> DataFrame:
    """ids, own, own_hashes and quotes of each message."""
    rows = messages.select(*ids, text)
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quote = pa.list_(pa.struct([("level", pa.int32()), ("text", pa.string()), ("hash", pa.int64()), ("lines", pa.list_(pa.int64()))]))
        for batch in batches:
            got = [parse(t) for t in batch.column(len(ids)).to_pylist()]
            columns = [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.list_(pa.int64())), pa.array([g[2] for g in got], quote)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(ids))], *columns], names=[*ids, "own", "own_hashes", "quotes"])

    return rows.mapInArrow(run, f"{kinds}, {_KINDS}")


def sources(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """wanted (q, conv, turn, hash) with the source of each hash: src_conv, src_turn (null: none). known: conv, turn, hash."""
    # Within the conversation: the latest earlier turn, by one scan over all turns in order, so that no task gets a whole conversation.
    events = known.select("conv", "hash", "turn", F.lit(1).alias("is_source"), F.lit(None).cast("string").alias("q")).distinct()
    asked = wanted.select("conv", "hash", "turn", F.lit(0).alias("is_source"), "q")
    source = F.when(F.col("is_source") == 1, F.struct(F.col("conv").alias("c"), F.col("hash").alias("h"), F.col("turn").alias("t")))
    near = scans.scan(events.unionByName(asked), ["conv", "hash", "turn", "is_source"], {"_s": scans.Running("last", source)}).where("is_source = 0")
    near = near.withColumn("src_turn", F.when((F.col("_s.c") == F.col("conv")) & (F.col("_s.h") == F.col("hash")), F.col("_s.t"))).drop("_s")
    each = known.groupBy("hash", "conv").agg(F.min("turn").alias("turn"))
    first = each.groupBy("hash").agg(F.min(F.struct("conv", "turn")).alias("first"))
    # The first message of the next conversation, for those who ask from the conversation of the first.
    second = each.join(first, "hash").where(F.col("conv") != F.col("first.conv")).groupBy("hash").agg(F.min(F.struct("conv", "turn")).alias("second"))
    other = F.when(F.col("first.conv") != F.col("conv"), F.col("first")).when(F.col("first.conv") == F.col("conv"), F.col("second"))
    got = near.join(first, "hash", "left").join(second, "hash", "left")
    return got.select("q", "conv", "turn", "hash", F.when(F.col("src_turn").isNotNull(), F.col("conv")).otherwise(other["conv"]).alias("src_conv"), F.coalesce("src_turn", other["turn"]).alias("src_turn"))


def partial(passages: DataFrame, known: DataFrame) -> DataFrame:
    """q and b (src_conv, src_turn, n): the message that has most lines of each passage, n of them. passages: q, conv, turn, lines.

    A message with m lines of a passage or more has one of any size(lines) - m + 1; the rarest of them select the candidates,
    with m = half the lines and two at least, and the candidates' lines are counted. For single lines `sources` is enough.
    """
    held = known.distinct().withColumnsRenamed({"conv": "src_conv", "turn": "src_turn"})
    asked = passages.select("q", "conv", "turn", F.size("lines").alias("size"), F.explode("lines").alias("hash"))
    often = held.groupBy("hash").agg(F.count("*").alias("often"))
    ranked = asked.join(often, "hash", "left").withColumn("rank", F.row_number().over(W.partitionBy("q").orderBy(F.coalesce("often", F.lit(0)), "hash")))
    rare = ranked.where(F.col("rank") <= F.col("size") - F.greatest(F.lit(2), F.ceil(F.col("size") / 2)) + 1)
    found = rare.join(held, "hash").where("src_conv <> conv or (src_conv = conv and src_turn < turn)").select("q", "conv", "src_conv", "src_turn").distinct()
    counted = found.join(asked.select("q", "hash"), "q").join(held, ["src_conv", "src_turn", "hash"]).groupBy("q", "conv", "src_conv", "src_turn").agg(F.count("*").alias("n"))
    single = sources(asked.select("q", "conv", "turn", "hash"), known).where("src_turn is not null").select("q", "conv", "src_conv", "src_turn", F.lit(1).cast("long").alias("n"))
    # Only comparisons, no arithmetic: conversations and turns may have any type that has an order.
    own, one = F.col("src_conv") == F.col("conv"), F.struct("src_conv", "src_turn", "n")
    inner = F.max_by(F.when(own, one), F.when(own, F.struct("n", "src_turn")))
    outer = F.min_by(F.when(~own, one), F.when(~own, F.struct(-F.col("n"), "src_conv", "src_turn")))
    best = counted.unionByName(single).groupBy("q").agg(inner.alias("_in"), outer.alias("_out"))
    return best.select("q", F.when(F.col("_in.n") >= F.coalesce("_out.n", F.lit(0)), F.col("_in")).otherwise(F.col("_out")).alias("b"))


def links(messages: DataFrame, known: DataFrame) -> DataFrame:
    """One row for each passage that links: row, level, place, conv, turn, src_conv, src_turn. messages: row, conv, turn, quotes."""
    passages = messages.select("row", "conv", "turn", F.posexplode("quotes").alias("place", "x")).select("row", "conv", "turn", "place", F.col("x.level").alias("level"), F.col("x.hash").alias("hash"), F.array_distinct("x.lines").alias("lines"))
    passages = passages.withColumn("q", F.concat_ws(":", "row", "place"))
    whole = sources(passages.select("q", "conv", "turn", "hash"), known).where("src_turn is not null").select("q", "src_conv", "src_turn")
    best = partial(passages.join(whole, "q", "left_anti"), known)
    got = passages.join(whole, "q", "left").join(best, "q", "left")
    enough = F.col("b.n") * 2 >= F.size("lines")
    pick = lambda c: F.when(F.col("src_turn").isNotNull(), F.col(c)).when(enough, F.col(f"b.{c}"))
    return got.select("row", "level", "place", "conv", "turn", pick("src_conv").alias("sc"), pick("src_turn").alias("st")).where("st is not null").withColumnsRenamed({"sc": "src_conv", "st": "src_turn"})


def threads(parents: DataFrame, folder: str) -> DataFrame:
    """conv, turn, thread, depth from conv, turn, up (null for a root), by pointer doubling on written tables."""
    spark, step = parents.sparkSession, 0
    now = cut(parents.select("conv", "turn", F.coalesce("up", "turn").alias("top"), F.when(F.col("up").isNotNull(), 1).otherwise(0).cast("long").alias("depth"), F.col("up").isNull().alias("done")), folder, "tops0")
    while now.where(~F.col("done")).limit(1).count():
        step += 1
        over = now.select("conv", F.col("turn").alias("top"), F.col("top").alias("top2"), F.col("depth").alias("depth2"), F.col("done").alias("done2"))
        # Messages whose root is known are done; only the others are joined again.
        grown = now.where(~F.col("done")).join(over, ["conv", "top"], "left").select("conv", "turn", F.coalesce("top2", "top").alias("top"), (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"), F.coalesce("done2", F.lit(True)).alias("done"))
        after = cut(now.where("done").unionByName(grown), folder, f"tops{step}")
        drop_path(spark, f"{folder}/tops{step - 1}")
        now = after
    return now.select("conv", "turn", F.col("top").alias("thread"), "depth")


def reply_order(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The messages without quotations: conv, turn, role, text, n_quotes, n_linked, first source, reply_to, thread and depth."""
    folder = scratch(messages.sparkSession)
    base = messages.select(F.expr("uuid()").alias("row"), F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    rows = cut(parsed(base, "text", ["row", "conv", "turn", "role"]), folder, "rows")
    known = rows.where("conv is not null and turn is not null").select("conv", "turn", F.explode("own_hashes").alias("hash"))
    found = cut(links(rows.select("row", "conv", "turn", "quotes"), known), folder, "links")
    place = F.struct("level", "place", "src_conv", "src_turn")
    inside = F.col("src_conv") == F.col("conv")
    of_row = found.groupBy("row").agg(F.count("*").alias("n_linked"), F.min(place).alias("first"), F.min(F.when(inside, place)).alias("inner"))
    turns = rows.where("conv is not null and turn is not null").select("conv", "turn").distinct()
    # The turn before, by ranges of all turns, so that no task needs a whole conversation.
    order = successors(turns.withColumn("id", F.struct("conv", "turn")), ["conv", "turn"], "id")
    before = order.where("next_id.conv = conv AND next_id.turn > turn").select(F.col("next_id.conv").alias("conv"), F.col("next_id.turn").alias("turn"), F.col("turn").alias("before"))
    whole = rows.join(of_row, "row", "left").join(before, ["conv", "turn"], "left").withColumn("up", F.coalesce("inner.src_turn", "before"))
    whole = cut(whole, folder, "whole")
    # A turn that several rows have is one node; its first parent stands for them.
    nodes = whole.where("conv is not null and turn is not null").groupBy("conv", "turn").agg(F.min("up").alias("up"))
    top = threads(nodes, folder)
    return whole.join(top, ["conv", "turn"], "left").select(
        F.col("conv").alias(conv),
        F.col("turn").alias(turn),
        F.col("role").alias(role),
        F.col("own").alias(text),
        F.size("quotes").cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.col("first.src_conv").alias("source_conv"),
        F.col("first.src_turn").alias("source_turn"),
        F.col("up").alias("reply_to"),
        F.coalesce("thread", "turn").alias("thread"),
        F.coalesce("depth", F.lit(0)).cast("long").alias("depth"),
    )


def op6_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations without quotations, with the links and the reply order."""
    return reply_order(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
