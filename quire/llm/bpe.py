"""BPE encoding and decoding by speculation and verification (byte-level vocabularies).

Greedy longest-match proposes tokens for every word that isn't cached. A proposal is the exact BPE result if and only if
each adjacent token pair is compatible: no merge across the boundary would have come before the merges that built the two
tokens. That test runs over all adjacent pairs of a batch at once (NumPy, no loop over words); only words with a failing
pair are merged exactly. Texts are handled whole; caches are bounded and only save time.

Defined cases: null text is the empty text (no tokens); the string of a special token becomes its id, as the tokenizers
library does by default; ids outside the vocabulary and null ids decode to nothing; bytes that aren't UTF-8 decode to
U+FFFD. A column that has the output's name is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.llm._common import Table, chunked

#: The pre-tokenisation pattern of byte-level BPE vocabularies (a fixed value).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Entries of a worker's word cache and of its pre-token cache, and the longest piece they keep.
CACHE, KEEP = 120_000, 40
#: Longest piece (bytes) that is merged side by side with others.
SHORT = 24
#: Bytes of text that are encoded before an output batch is sent.
BATCH_BYTES = 2 << 20
_NEVER = 1 << 40


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: printable Latin-1 stands for itself, the rest follow from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return {chr(b if b in own else next(spare)): b for b in range(256)}


class Vocabulary:
    """A byte-level BPE vocabulary with the arrays that the pair test needs."""

    def __init__(self, source: bytes):
        import regex

        spec = json.loads(source)
        model, letters = spec["model"], byte_letters()
        to_bytes = lambda s: bytes(letters[c] for c in s)
        ids = {to_bytes(s): i for s, i in model["vocab"].items() if all(c in letters for c in s)}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes = [b""] * self.size
        for s, i in ids.items():
            self.bytes[i] = s
        for s, i in self.special.items():
            self.bytes[i] = s.encode()
        self.rank = np.full(self.size, -1, dtype=np.int64)
        self.left = np.full(self.size, -1, dtype=np.int64)
        self.right = np.full(self.size, -1, dtype=np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = map(to_bytes, pair.split(" ") if isinstance(pair, str) else pair)
            x, y, t = ids[a], ids[b], ids[a + b]
            if self.rank[t] >= 0:
                raise ValueError("two merges make one token; the pair test needs a single one")
            self.rank[t], self.left[t], self.right[t] = rank, x, y
            self.merges[x, y] = rank, t
        self.made = np.array([t for _, t in self.merges.values()], dtype=np.int64)  # by rank
        self.pairs = Table(np.array([x * self.size + y for x, y in self.merges], dtype=np.int64), np.arange(len(self.merges), dtype=np.int64))
        self.byte_id = [ids[bytes([b])] for b in range(256)]
        made = np.flatnonzero(self.rank >= 0)
        sound = self.compatible(self.left[made], self.right[made], inner=True)
        reach = np.zeros(self.size, dtype=bool)
        reach[self.byte_id] = True
        for t, good in sorted(zip(made.tolist(), sound.tolist(), strict=True), key=lambda x: self.rank[x[0]]):
            reach[t] = good and reach[self.left[t]] and reach[self.right[t]]
        self.greedy = {s: i for s, i in ids.items() if reach[i]}
        self._grow_trie()
        self.pattern = regex.compile(PATTERN)
        self.split = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.loose = re.compile(r" (?=\s|$)")
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _grow_trie(self) -> None:
        """The trie of the greedy vocabulary: children by (node, byte), and the token that ends at each node."""
        nodes, keys, below = {b"": 0}, [], []
        for s in self.greedy:
            for k in range(1, len(s) + 1):
                if s[:k] not in nodes:
                    nodes[s[:k]] = len(nodes)
                    keys.append(nodes[s[: k - 1]] << 8 | s[k - 1])
                    below.append(nodes[s[:k]])
        self.children = Table(np.array(keys, dtype=np.int64), np.array(below, dtype=np.int64))
        self.ends = np.full(len(nodes), -1, dtype=np.int64)
        for s, i in self.greedy.items():
            self.ends[nodes[s]] = i

    def ranks(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, or _NEVER (also where an id is negative)."""
        found = self.pairs.get(np.where((x < 0) | (y < 0), 0, x * self.size + y))
        return np.where((found < 0) | (x < 0) | (y < 0), _NEVER, found)

    def compatible(self, a: np.ndarray, b: np.ndarray, inner: bool = False) -> np.ndarray:
        """Whether BPE leaves the boundary between tokens a and b alone, for arrays of pairs.

        Both tokens are taken apart along the boundary, the later merge first. At each step the two symbols that touch
        must not merge before the merge that consumes one of them; of equal ranks the left one comes first. inner: the
        pair itself is a merge, and the question is whether anything else comes before it.
        """
        x, y = a.astype(np.int64), b.astype(np.int64)
        good = np.ones(len(x), dtype=bool)
        limit = np.full(len(x), 0 if inner else 2 * _NEVER - 1, dtype=np.int64)
        live = np.arange(len(x))
        while len(live):
            xs, ys = x[live], y[live]
            bad = 2 * self.ranks(xs, ys) < limit[live]
            good[live[bad]] = False
            rx, ry = self.rank[xs], self.rank[ys]
            on = ~bad & ((rx >= 0) | (ry >= 0))
            live, xs, ys, rx, ry = live[on], xs[on], ys[on], rx[on], ry[on]
            cut_left = rx > ry
            x[live] = np.where(cut_left, self.right[xs], xs)
            y[live] = np.where(cut_left, ys, self.left[ys])
            limit[live] = np.where(cut_left, 2 * rx, 2 * ry + 1)
        return good

    def propose(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of all pieces side by side: token ids and the piece of each, in order."""
        live, owners, ids = np.flatnonzero(start < end), [], []
        at, stop = start[live], end[live]  # of the live pieces only, so that a long piece costs its own steps
        while len(live):
            walk, node, p = np.arange(len(live)), np.zeros(len(live), dtype=np.int64), at
            best, after = np.full(len(live), -1, dtype=np.int64), at.copy()
            while len(walk):
                node = self.children.get(node << 8 | buf[p])
                on = node >= 0
                walk, node, p = walk[on], node[on], p[on] + 1
                token = self.ends[node]
                hit = token >= 0
                best[walk[hit]], after[walk[hit]] = token[hit], p[hit]
                on = p < stop[walk]
                walk, node, p = walk[on], node[on], p[on]
            owners.append(live)
            ids.append(best)
            on = after < stop
            live, at, stop = live[on], after[on], stop[on]
        owner = np.concatenate([*owners, np.zeros(0, np.int64)])
        order = np.argsort(owner, kind="stable")
        return np.concatenate([*ids, np.zeros(0, np.int64)])[order], owner[order]

    def merge_short(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[list[int]]:
        """Exact merging of many short pieces side by side: in each step every piece makes its own next merge."""
        n, wide = len(start), int((end - start).max())
        col = np.arange(wide + 1)
        inside = col < (end - start)[:, None]
        ids = np.where(inside, np.array(self.byte_id, dtype=np.int64)[buf[np.minimum(start[:, None] + col, len(buf) - 1)]], -1)
        after, before = np.tile(col + 1, (n, 1)), np.tile(col - 1, (n, 1))
        rank = np.full((n, wide + 1), _NEVER, dtype=np.int64)
        rank[:, :-1] = self.ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, wide)
        live = np.arange(n)
        while len(live):
            i = rank[live].argmin(axis=1)
            r = rank[live, i]
            on = r < _NEVER
            live, i, r = live[on], i[on], r[on]
            if not len(live):
                break
            j = after[live, i]
            k = np.minimum(after[live, j], wide)
            t = self.made[r]
            ids[live, i], ids[live, j], rank[live, j] = t, -1, _NEVER
            after[live, i] = k
            before[live, k] = i
            rank[live, i] = np.where(k > j, self.ranks(t, ids[live, k]), _NEVER)
            h = before[live, i]
            front = np.flatnonzero(h >= 0)
            rank[live[front], h[front]] = self.ranks(ids[live[front], h[front]], t[front])
        return [row[row >= 0].tolist() for row in ids]

    def merge(self, piece: bytes) -> list[int]:
        """Exact merging: the lowest rank first, of equal ones the leftmost."""
        ids = [self.byte_id[b] for b in piece]
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        heap = [(*m, i) for i in range(len(ids) - 1) if (m := self.merges.get((ids[i], ids[i + 1])))]
        heap = [(rank, i, t) for rank, t, i in heap]
        heapq.heapify(heap)
        while heap:
            rank, i, t = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or self.merges.get((ids[i], ids[j])) != (rank, t):
                continue
            ids[i], ids[j] = t, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                if m := self.merges.get((t, ids[k])):
                    heapq.heappush(heap, (m[0], i, m[1]))
            if (h := before[i]) >= 0 and (m := self.merges.get((ids[h], t))):
                heapq.heappush(heap, (m[0], h, m[1]))
        return [t for t in ids if t >= 0]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Packed ids (int32) of distinct pre-tokens: propose, test every adjacent pair, merge where the test fails."""
        raw = [p.encode() for p in pieces]
        buf = np.frombuffer(b"".join(raw), dtype=np.uint8)
        end = np.cumsum(np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)))
        start = np.concatenate([np.zeros(1, np.int64), end])[: len(raw)]
        flat, owner = self.propose(buf, start, end)
        at = np.flatnonzero(owner[1:] == owner[:-1])
        fails = np.unique(owner[at[~self.compatible(flat[at], flat[at + 1])]])
        edge = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(raw)))]) * 4
        packed = flat.astype(np.int32).tobytes()
        out = [packed[a:b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
        size = end - start
        short = fails[size[fails] <= SHORT]
        for lo in range(0, len(short), 4096):
            rows = short[lo : lo + 4096]
            for i, ids in zip(rows.tolist(), self.merge_short(buf, start[rows], end[rows]), strict=True):
                out[i] = array("i", ids).tobytes()
        for i in fails[size[fails] > SHORT].tolist():
            out[i] = array("i", self.merge(raw[i])).tobytes()
        return out

    def cut_word(self, word: str) -> list[str]:
        """The pre-tokens of a word with an optional leading space."""
        bare = word[1:] if word[:1] == " " else word
        if bare.isalpha():
            return [word]
        if bare[-1:] in ".,!?" and bare[:-1].isalpha():
            return [word[:-1], word[-1]]
        return self.pattern.findall(word)

    def learn(self, new: set[str]) -> dict[str, bytes]:
        """Packed ids (int32) of each new word; a word may have a leading space and consists of whole pre-tokens."""
        cut = {w: self.cut_word(w) for w in new}
        pieces = self.pieces
        fresh = list({p for ps in cut.values() for p in ps if p not in pieces})
        ids = dict(zip(fresh, self.encode_pieces(fresh), strict=True)) if fresh else {}
        if len(pieces) + len(ids) > CACHE:
            ids |= {p: pieces[p] for ps in cut.values() for p in ps if p in pieces}
            pieces.clear()
        pieces.update(ids)
        out = {w: pieces[ps[0]] if len(ps) == 1 else b"".join([pieces[p] for p in ps]) for w, ps in cut.items()}
        for p in [p for p in ids if len(p) > KEEP]:
            del pieces[p]
        return out

    def words_of(self, text: str) -> list[str]:
        """The text cut where pre-tokens end for certain: before each space that a non-space follows."""
        if self.loose.search(text):
            return self.pattern.findall(text)
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + w for w in rest]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids (int32) of each text."""
        cut, new = [], set()
        for text in texts:
            ps = self.split.split(text) if self.split and any(s in text for s in self.special) else [text]
            row = [x for i, p in enumerate(ps) for x in ([p] if i % 2 else self.words_of(p))] if len(ps) > 1 else self.words_of(text)
            cut.append((row, len(ps) > 1))
            new.update(row)
        marks = {s: np.array([i], dtype=np.int32).tobytes() for s, i in self.special.items()}
        new = {w for w in new if w not in self.words and w not in marks}
        got = self.learn(new)
        if len(self.words) + len(got) > CACHE:
            got |= {w: self.words[w] for row, _ in cut for w in row if w in self.words}
            self.words.clear()
        look = self.words
        look.update(got)
        out = [np.frombuffer(b"".join([look[w] if w in look else marks[w] for w in row] if special else map(look.__getitem__, row)), dtype=np.int32) for row, special in cut]
        for w in [w for w in got if len(w) > KEEP]:
            del look[w]
        return out

    def decode(self, ids: list[int | None]) -> str:
        table, n = self.bytes, self.size
        return b"".join([table[i] for i in ids if i is not None and 0 <= i < n]).decode("utf-8", "replace")


_held: dict[int, Vocabulary] = {}


def held(source) -> Vocabulary:
    """The worker's own copy of a broadcast vocabulary."""
    if source.id not in _held:
        _held.clear()
        _held[source.id] = Vocabulary(source.value)
    return _held[source.id]


class Shipped:
    """A vocabulary file's content, broadcast (its size is that of the file, a few MB)."""

    def __init__(self, spark, path: str):
        from pathlib import Path

        self.cast = spark.sparkContext.broadcast(Path(path).read_bytes())
        self.id = self.cast.id if hasattr(self.cast, "id") else self.cast._jbroadcast.id()

    def __getstate__(self):
        return {"cast": self.cast, "id": self.id}

    @property
    def value(self) -> bytes:
        return self.cast.value


def encode(df: DataFrame, vocabulary: str, text: str = "text", out: str = "token_ids", decoded: str | None = None) -> DataFrame:
    """df with `out`, the token ids (array of int) of each row's whole text.

    decoded: the name of a further column, the text that these ids decode to, made in the same pass.
    """
    source = Shipped(df.sparkSession, vocabulary)
    kept = [f for f in df.schema.fields if f.name not in (out, decoded)]
    more = [T.StructField(decoded, T.StringType(), False)] if decoded else []
    schema = T.StructType([*kept, T.StructField(out, T.ArrayType(T.IntegerType(), False), False), *more])
    names, place = [f.name for f in kept], [f.name for f in df.schema.fields].index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held(source)
        for batch in batches:
            texts = [x or "" for x in batch.column(place).to_pylist()]
            for lo, hi in chunked(list(map(len, texts)), BATCH_BYTES):
                ids = known.encode(texts[lo:hi])
                ends = np.zeros(hi - lo + 1, dtype=np.int32)
                np.cumsum([len(x) for x in ids], out=ends[1:])
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*ids, np.zeros(0, np.int32)])))
                part = batch.slice(lo, hi - lo)
                back = [pa.array([known.decode(x.tolist()) for x in ids], type=pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays([*[part.column(batch.schema.names.index(n)) for n in names], lists, *back], names=[*names, out, *[decoded] * bool(decoded)])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str | Column, vocabulary: str) -> Column:
    """The text of each row's token ids (null ids: the empty text)."""
    source = Shipped(df.sparkSession, vocabulary)

    @F.arrow_udf(T.StringType())
    def run(column: pa.Array) -> pa.Array:
        known = held(source)
        return pa.array([known.decode(x or []) for x in column.to_pylist()], type=pa.string())

    return run(ids)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    """Encode every whole text, decode it again, and return counts and digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encode(docs, default_vocabulary(), decoded="decoded")
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
