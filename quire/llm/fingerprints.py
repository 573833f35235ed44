"""Document fingerprints as invertible Bloom lookup sketches, with DataFrame and SQL functions only.

A text is cut into paragraphs by its content alone, in one way for every length: after each line, and after each sentence
whose last character is one of LAST (about every third). CUT characters without the end of a sentence and MANY sentences without
a cut are the most that a paragraph has. Each distinct paragraph with its number of occurrences is a 64-bit key. The sketch has three tables of `size` cells; a key goes to one cell of each, where the count, the XOR of the keys and
the XOR of their check values are kept. Subtracting two sketches of one size leaves the keys that only one text has. Peeling
takes them out: a cell with one key (count 1 or -1 and a matching check) gives the key, which then leaves its other cells. A
sketch of a larger text is folded to the size of a smaller one first.

If peeling ends with cells left, the pair is tried again with larger sketches made from the keys: at least RETRY times as large
and with a cell in each table for each half key of both texts, then twice as large each time. Should TRIES such fail, the keys are
compared one by one. So a likeness is exact for texts of every length and never an estimate.

The likeness of two sketches is (n1 + n2 - differing keys) / (n1 + n2), and 1 if both have no key.

A sketch is a sorted array of its cells that aren't empty: number, count, key and check. Making, folding, subtracting and
peeling are one operation: entries are put together and those of one cell are summed up. Equal texts have equal sketches.

Defined cases: null text is the empty text, which has no paragraphs; repeated paragraphs count once with their number. Other
columns are kept; columns named like the outputs are replaced. In the order of texts a null key comes first, texts of one key
follow by their hash, and rows equal in key and text are one text there, each of which gets its values; a single text is
its own successor; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm._common import cut, parts, scratch

#: Last characters of sentences that end a paragraph.
LAST = "aeiouy\\u00C0-\\uFFFF"
#: Most characters of a sentence, and sentences of a paragraph.
CUT, MANY = 400, 32
#: Smallest and largest cells of a table of the first try, and how many times larger the second try is at least; further tries.
LEAST, MOST, RETRY, TRIES = 4, 64, 4, 4
#: Rounds of peeling.
ROUNDS = 20
#: Distance of the tables in cell numbers: the cell of table t and slot s has number t * TABLE + s.
TABLE = 1024
#: The same for the sketches of further tries.
WIDE = 1 << 28


def paragraphs(text: str) -> str:
    """SQL for the paragraphs of a text."""
    run, end = f"[^\\n.!?]{{1,{CUT}}}", "[.!?]"
    return f"regexp_extract_all({text}, r'(?:{run}(?<![{LAST}]){end}+){{0,{MANY - 1}}}{run}{end}*\\n*|[\\n.!?]+', 0)"


def power_of_two(n: str) -> str:
    """SQL for the least power of two from n on."""
    return f"CAST(power(2, ceil(log2(greatest({n}, 1)))) AS INT)"


def size_of(n: str) -> str:
    """SQL for the cells of a table: the least power of two from n / 4 on, within LEAST and MOST."""
    return f"least({MOST}, greatest({LEAST}, {power_of_two(f'{n} / 4')}))"


def check_of(k: str) -> str:
    return f"shiftrightunsigned(xxhash64({k}, 7), 32)"


def entries(keys: str, c: str, size: str, table: int = TABLE) -> str:
    """SQL for the entries of `keys`, structs with a key as k: one in each table, at a slot from a third of one hash."""
    slot = lambda t: f"CAST({t * table} + (shiftrightunsigned(y.g, {21 * t}) & ({size} - 1)) AS INT)"
    three = ", ".join(f"named_struct('i', {slot(t)}, 'c', y.c, 'k', y.k, 'h', y.h)" for t in range(3))
    return f"flatten(transform(transform({keys}, x -> named_struct('c', {c}, 'k', x.k, 'h', {check_of('x.k')}, 'g', xxhash64(x.k, 1))), y -> array({three})))"


def of_keys(keys: str, c: str, size: str, table: int) -> str:
    return entries(f"transform({keys}, k -> named_struct('k', k))", c, size, table)


def bound(value: str, name: str, body: str) -> str:
    """SQL for `body` with `name` standing for `value`, which is evaluated once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def fenced(value: str) -> Column:
    """A column of the value that the optimizer neither copies into its uses nor pushes filters through: it counts as not
    deterministic, though the condition never holds."""
    return F.expr(f"IF(monotonically_increasing_id() < 0, NULL, {value})")


def merged(cells: str) -> str:
    """SQL that sums up the entries of each cell and leaves out empty cells: entries are sorted, and each run is folded."""
    heads = "filter(transform(e, (x, j) -> IF(j > 0 AND get(e, j - 1).i = x.i, NULL, j + 1)), y -> y IS NOT NULL)"
    zero = "named_struct('i', get(e, b - 1).i, 'c', 0, 'k', 0L, 'h', 0L)"
    run = "slice(e, b, coalesce(get(r, j + 1), size(e) + 1) - b)"
    fold = f"aggregate({run}, {zero}, (a, x) -> named_struct('i', a.i, 'c', a.c + x.c, 'k', a.k ^ x.k, 'h', a.h ^ x.h))"
    fold = f"IF(coalesce(get(r, j + 1), size(e) + 1) = b + 1, get(e, b - 1), {fold})"
    return bound(f"sort_array({cells})", "e", bound(heads, "r", f"filter(transform(r, (b, j) -> {fold}), x -> x.c <> 0 OR x.k <> 0 OR x.h <> 0)"))


def sketch_of(keys: str, size: str, table: int = TABLE) -> str:
    return merged(of_keys(keys, "1", size, table))


def difference_of(a: str, b: str, size: str, table: int = TABLE) -> str:
    """SQL for sketch a minus sketch b, both folded to `size`."""
    fold = lambda cells, sign: f"transform({cells}, x -> named_struct('i', x.i & ({3 * table} | ({size} - 1)), 'c', {sign}x.c, 'k', x.k, 'h', x.h))"
    return merged(f"concat({fold(a, '')}, {fold(b, '-')})")


def difference_of_keys(a: str, b: str, size: str, table: int) -> str:
    """SQL for the sketch of keys a minus that of keys b, made at once: the entries of b enter with the other sign."""
    return merged(f"concat({of_keys(a, '1', size, table)}, {of_keys(b, '-1', size, table)})")


def peeled(cells: str, size: str, table: int = TABLE) -> str:
    """SQL for a struct: the cells left, and the keys found with the sign of the side that has them."""
    pure = f"sort_array(transform(filter(st.cells, x -> abs(x.c) = 1 AND x.h = {check_of('x.k')}), x -> named_struct('k', x.k, 'c', x.c)))"
    pure = bound(pure, "q", "filter(q, (x, j) -> j = 0 OR get(q, j - 1).k <> x.k)")
    out = entries("p", "-x.c", size, table)
    step = f"named_struct('cells', {merged(f'concat(st.cells, {out})')}, 'found', concat(st.found, p), 'on', true)"
    start = f"named_struct('cells', {cells}, 'found', CAST(array() AS array<struct<k:bigint,c:int>>), 'on', true)"
    stop = "named_struct('cells', st.cells, 'found', st.found, 'on', false)"
    loop = f"IF(st.on AND size(st.cells) > 0, {bound(pure, 'p', f'IF(size(p) = 0, {stop}, {step})')}, st)"
    return f"aggregate(sequence(1, {ROUNDS}), {start}, (st, n) -> {loop}, st -> named_struct('cells', st.cells, 'found', st.found))"


def keys_of(text: str) -> str:
    """SQL for the sorted keys of the paragraphs of a text."""
    hashes = f"sort_array(transform({paragraphs(text)}, p -> xxhash64(p)))"
    # Equal hashes stand together; a run's last place gives its paragraph, the distance from the run before its occurrences.
    ends = "filter(transform(hs, (x, i) -> IF(get(hs, i + 1) <=> x, NULL, i + 1)), e -> e IS NOT NULL)"
    return bound(hashes, "hs", bound(ends, "es", "sort_array(transform(es, (e, j) -> xxhash64(get(hs, e - 1), e - coalesce(get(es, j - 1), 0))))"))


def with_keys(df: DataFrame, text: str, name: str) -> DataFrame:
    """df with {name}_keys, the sorted keys of the paragraphs of column `text`."""
    return df.withColumn(f"{name}_keys", F.expr(keys_of(f"coalesce(`{text}`, '')")))


def with_sketch(df: DataFrame, name: str) -> DataFrame:
    """df with {name}_size, {name}_cells and the sketch as text, {name}_fingerprint, from {name}_keys."""
    out = df.withColumn(f"{name}_size", F.expr(size_of(f"size({name}_keys)"))).withColumn(f"{name}_cells", fenced(sketch_of(f"{name}_keys", f"{name}_size")))
    cell = "concat(lpad(hex(x.i), 3, '0'), lpad(hex(x.c), 3, '0'), lpad(hex(x.k), 16, '0'), lpad(hex(x.h), 8, '0'))"
    return out.withColumn(f"{name}_fingerprint", F.expr(f"concat({name}_size, ':', size({name}_keys), ':', array_join(transform({name}_cells, x -> {cell}), ''))"))


def with_likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """df with `out`, the likeness of the sketches named a and b, and {out}_keys, the keys that only one has (c is 1: a has it)."""
    n = f"(size({a}_keys) + size({b}_keys))"
    step = df.withColumn("_s", F.expr(f"least({a}_size, {b}_size)"))
    step = step.withColumn("_one", fenced(peeled(difference_of(f"{a}_cells", f"{b}_cells", "_s"), "_s")))
    step = step.withColumn("_z", F.expr(f"greatest({RETRY} * _s, {power_of_two(f'2 * {n}')})"))
    again = bound("shiftleft(_z, m)", "z", peeled(difference_of_keys(f"{a}_keys", f"{b}_keys", "z", WIDE), "z", WIDE))
    tries = f"sequence(0, {TRIES - 1})"
    step = step.withColumn("_two", fenced(f"IF(size(_one.cells) = 0, _one, aggregate({tries}, _one, (tr, m) -> IF(size(tr.cells) = 0, tr, {again})))"))
    # Keys that share all their cells at every size can't be peeled; then the keys themselves are compared.
    only = lambda x, y, c: f"transform(array_except({x}_keys, {y}_keys), k -> named_struct('k', k, 'c', {c}))"
    step = step.withColumn(f"{out}_keys", fenced(f"IF(size(_two.cells) = 0, _two.found, concat({only(a, b, '1')}, {only(b, a, '-1')}))"))
    return step.withColumn(out, fenced(f"CAST(IF({n} = 0, 1, ({n} - size({out}_keys)) / {n}) AS DOUBLE)")).drop("_s", "_z", "_one", "_two")


def fingerprint(df: DataFrame, text: str = "text", name: str = "text") -> DataFrame:
    """df with the keys and the sketch of column `text`; with_likeness compares two such."""
    return with_sketch(with_keys(df, text, name), name)


def successors(rows: DataFrame, order: list[str], key: str) -> DataFrame:
    """rows with next_{key}, the key of the next row in order (the first's after the last), without one task for all rows.

    Rows are range-partitioned and written; `lead` runs within a partition. Only the first key of each partition reaches the
    driver, as with Spark's own range bounds.
    """
    spark = rows.sparkSession
    n = max(16, parts(spark))
    ranged = cut(rows.repartitionByRange(n, *order).withColumn("_p", F.spark_partition_id()), scratch(spark), "ranged")
    firsts = [(r["_p"], r["k"]) for r in ranged.groupBy("_p").agg(F.min_by(key, F.struct(*order)).alias("k")).orderBy("_p").collect()]
    following = [(p, firsts[(i + 1) % len(firsts)][1]) for i, (p, _) in enumerate(firsts)]
    heads = F.broadcast(spark.createDataFrame(following, f"_p int, _f {rows.schema[key].dataType.simpleString()}"))
    lead = F.lead(key).over(W.partitionBy("_p").orderBy(*order))
    return ranged.withColumn("_l", lead).join(heads, "_p").withColumn(f"next_{key}", F.coalesce("_l", "_f")).drop("_p", "_l", "_f")


def compare_edits(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_chars, edited_sha256 and the fingerprints of each text and of its edited text (the last quarter of its characters
    replaced by the first as many of the next text), near_edited and near_next with the differing keys."""
    body = F.coalesce(F.col(text), F.lit(""))
    # A text is named by its hash and key: keys may be null or repeat, and a crowded key spreads over all tasks.
    rows = docs.select(F.col(key).alias("k"), body.alias("text"), F.xxhash64(body).alias("h")).withColumn("id", F.concat_ws(":", "h", F.col("k").cast("string")))
    nodes = cut(rows.groupBy("k", "h", "id").agg(F.min(F.length("text")).alias("n"), F.count("*").alias("copies")), scratch(docs.sparkSession), "nodes")
    repeated = nodes.where("copies > 1").limit(1).count() > 0
    once = rows.select("id", "text")
    once = once.dropDuplicates(["id"]) if repeated else once
    once = with_keys(once, "text", "text")
    order = successors(nodes, ["k", "h"], "id")
    # The next text's first characters and keys go to the text before it. Both joins take the same columns of the texts, so that
    # they share one shuffle of them.
    wanted = order.select(F.col("next_id").alias("id"), F.col("id").alias("of"), "k", "n", "copies")
    sent = once.hint("merge").join(wanted, "id").select(F.col("of").alias("id"), "k", "n", "copies", F.expr("substring(text, 1, n div 4)").alias("start"), F.col("text_keys").alias("next_keys"))
    both = once.hint("merge").join(sent, "id").withColumn("edited", F.expr("concat(substring(text, 1, n - n div 4), start)"))
    both = with_keys(both, "edited", "edited").withColumn("edited_sha256", F.sha2("edited", 256)).drop("text", "start", "edited")
    for name in ("text", "edited", "next"):
        both = with_sketch(both, name)
    both = with_likeness(with_likeness(both, "text", "edited", "near_edited"), "text", "next", "near_next")
    both = both.withColumn("copy", F.explode(F.expr("sequence(1, copies)"))) if repeated else both
    names = ["edited_sha256", F.col("text_fingerprint").alias("fingerprint"), "edited_fingerprint", "near_edited", "near_edited_keys", "near_next", "near_next_keys"]
    return both.select(F.col("k").alias(key), F.col("n").cast("long").alias("n_chars"), *names)


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness to each other and to the next text's."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return compare_edits(docs).drop("near_edited_keys", "near_next_keys")
