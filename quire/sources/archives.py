"""ZIP archives as tables: members by their directory, and the content of chosen members.

Only an archive's directory (at its end) is read for its members; filters on names or media types then apply to plain rows. The
content of what is left is read by ranges, in tasks for each run of RUN bytes of an archive, so an archive may be larger than a
task's memory; a member must fit. Archives, books and members that can't be read give a row with the reason.

Paths are those of a Spark listing. Ranges are read through Arrow's file systems; archives of a store that these can't open are
read whole if the listing has a column `content`.
"""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator
from posixpath import normpath
from urllib.parse import quote, unquote
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.sources.channel import attempted

#: Bytes of an archive that one task reads, and of a member at most; members that a task holds at once.
RUN, MOST, SOME = 64 << 20, 1 << 30, 512
PLACE = "offset long, packed long, size long, crc long, method int"
MEMBERS = f"member string, {PLACE}"
BOOK = f"opf string, id string, href string, member string, media string, properties string, spine int, is_toc boolean, place int, {PLACE}"


class Ranges(io.RawIOBase):
    """An Arrow file as a plain one."""

    def __init__(self, file):
        self.file, self.size, self.at = file, file.size(), 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = 0) -> int:
        at = offset + (0, self.at, self.size)[whence]
        if at < 0:
            raise OSError("a place before the file")
        self.at = at
        return at

    def readinto(self, out) -> int:
        got = self.file.read_at(max(0, min(len(out), self.size - self.at)), self.at) if self.at < self.size else b""
        out[: len(got)] = got
        self.at += len(got)
        return len(got)

    def close(self) -> None:
        self.file.close()
        super().close()


def opened(path: str, content: bytes | None = None):
    """A file to read from at any place."""
    from pyarrow import fs

    if content is not None:
        return io.BytesIO(content)
    scheme, _, rest = path.partition(":")
    if scheme == "file" or not rest:
        system, inside = fs.LocalFileSystem(), "/" + rest.lstrip("/") if rest else path
    else:
        system, inside = fs.FileSystem.from_uri(quote(path, safe=":/@?&=%+,"))
    return io.BufferedReader(Ranges(system.open_input_file(inside)), 1 << 16)


def local(e) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def placed(info: zipfile.ZipInfo) -> tuple[int, int, int, int, int]:
    return info.header_offset, info.compress_size, info.file_size, info.CRC, -1 if info.flag_bits & 1 else info.compress_type


def members_of(path: str, content: bytes | None = None) -> list[tuple]:
    with opened(path, content) as f, zipfile.ZipFile(f) as z:
        return [(i.filename, *placed(i)) for i in z.infolist() if not i.is_dir()]


def book_of(path: str, content: bytes | None = None) -> list[tuple]:
    """The manifest of an EPUB, with the place of each item among the members (nulls: it isn't there)."""
    with opened(path, content) as f, zipfile.ZipFile(f) as z:
        root = next((e for e in ElementTree.fromstring(z.read("META-INF/container.xml")).iter() if local(e) == "rootfile"), None)
        if root is None or not root.get("full-path"):
            raise ValueError("the container names no package")
        opf = root.get("full-path")
        package, held = ElementTree.fromstring(z.read(opf)), {i.filename: i for i in z.infolist()}
        spine = next((e for e in package.iter() if local(e) == "spine"), None)
        order: dict[str, int] = {}
        for e in spine if spine is not None else []:
            if local(e) == "itemref" and e.get("idref"):
                order.setdefault(e.get("idref"), len(order))
        toc = spine.get("toc") if spine is not None else None
        rows, base = [], opf.rpartition("/")[0]
        for e in (x for m in package.iter() if local(m) == "manifest" for x in m):
            if local(e) == "item" and e.get("id") and e.get("href"):
                member = normpath(f"{base}/{unquote(e.get('href'))}").lstrip("/") if base else normpath(unquote(e.get("href")))
                info = held.get(member)
                rows.append((opf, e.get("id"), e.get("href"), member, e.get("media-type"), e.get("properties"), order.get(e.get("id")), e.get("id") == toc, len(rows), *(placed(info) if info else (None,) * 5)))
        return rows


def read_member(f, offset: int, packed: int, size: int, crc: int, method: int, most: int = MOST) -> bytes:
    """A member's bytes by its place; its size and checksum are verified."""
    if method not in (0, 8):
        raise ValueError("encrypted" if method < 0 else f"compressed by method {method}")
    if size > most or packed > most:
        raise ValueError(f"{size} bytes are more than {most}")
    f.seek(offset)
    head = f.read(30)
    if head[:4] != b"PK\x03\x04":
        raise ValueError("no member where the directory says")
    f.seek(offset + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
    data = f.read(packed)
    if method == 8:
        data = zlib.decompressobj(-15).decompress(data, size + 1)
    if len(data) != size or zlib.crc32(data) != crc:
        raise ValueError("the content doesn't match its checksum")
    return data


def members(listing: DataFrame) -> DataFrame:
    """A row for each member of each archive (path; content, if there, is used): MEMBERS, status and reason."""
    return attempted(listing, ["path", *[c for c in ("content",) if c in listing.columns]], members_of, MEMBERS, ["path"])


def entries(listing: DataFrame) -> DataFrame:
    """A row for each item of the manifest of each EPUB: BOOK (spine: its place in reading order), status and reason."""
    return attempted(listing, ["path", *[c for c in ("content",) if c in listing.columns]], book_of, BOOK, ["path"])


def contents(rows: DataFrame, run: int = RUN, most: int = MOST, whole: DataFrame | None = None) -> DataFrame:
    """rows of members or entries with `content`; where it can't be read it is null and status and reason say why.

    Rows that failed before stay as they are; of a member that the archive lacks the content is null. whole: path and content
    of archives that can only be read whole.
    """
    if whole is not None:
        rows = rows.join(whole.select("path", F.col("content").alias("_whole")), "path", "left")
    dealt = rows.repartition("path", F.floor(F.col("offset") / run))
    kept = [f for f in rows.schema.fields if f.name not in ("content", "status", "reason", "_whole")]
    fields = T.StructType([*kept, T.StructField("content", T.BinaryType()), T.StructField("status", T.StringType()), T.StructField("reason", T.StringType())])
    place = ["path", "offset", "packed", "size", "crc", "method", "status", "reason", *["_whole"] * (whole is not None)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, file = None, None
        for batch in (b.slice(k, SOME) for b in batches for k in range(0, b.num_rows, SOME)):
            out, lo, held = [], 0, 0
            for i, r in enumerate(batch.select(place).to_pylist()):
                got = (None, r["status"], r["reason"])
                if r["status"] == "ok" and r["offset"] is not None:
                    try:
                        if at != r["path"]:
                            at, file = r["path"], opened(r["path"], r.get("_whole"))
                        got = (read_member(file, *(r[c] for c in place[1:6]), most=most), "ok", None)
                    except Exception as e:  # one member's fault is its own
                        got = (None, "failed", f"{type(e).__name__}: {e}"[:500])
                out.append(got)
                held += len(got[0] or b"")
                if held > 8 << 20 or i == batch.num_rows - 1:
                    columns = [pa.array([x[j] for x in out], k) for j, k in enumerate((pa.binary(), pa.string(), pa.string()))]
                    part = batch.slice(lo, i + 1 - lo)
                    yield pa.RecordBatch.from_arrays([*[part.column(f.name) for f in kept], *columns], names=fields.names)
                    out, lo, held = [], i + 1, 0

    return dealt.mapInArrow(read, fields)


# Tables of contents


def toc_candidates(found: DataFrame) -> DataFrame:
    """Of each book's entries the nav document (rank 0) and the NCX (rank 1: the one that the spine names, else by its type)."""
    nav = F.array_contains(F.split(F.coalesce("properties", F.lit("")), r"\s+"), "nav")
    ncx = F.when(F.col("is_toc"), 0).when(F.col("media") == "application/x-dtbncx+xml", 1)
    ranked = found.where("status = 'ok'").withColumn("rank", F.when(nav, 0).when(ncx.isNotNull(), 1)).where("rank IS NOT NULL")
    best = ranked.groupBy("path", "rank").agg(F.min_by("place", F.struct(F.when(F.col("rank") == 1, ncx).otherwise(0), "place")).alias("place"))
    return found.where("status = 'ok'").join(best, ["path", "place"])


def toc_tree(content: bytes | None) -> list[tuple[int, str, str, int]]:
    """(seq, href, title, level) of a nav document or NCX in pre-order; entries without link or title only pass their children."""
    if not content:
        return []
    words = lambda s: " ".join((s or "").split())
    children = lambda e, name: [x for x in e if local(x) == name]
    out: list[tuple[int, str, str, int]] = []

    def add(href, title, level):
        if href and href.strip() and title:
            out.append((len(out), href.strip(), title, level))

    def nav(ol, level):
        for li in children(ol, "li"):
            for a in children(li, "a")[:1]:
                add(a.get("href"), words("".join(a.itertext())), level)
            for sub in children(li, "ol")[:1]:
                nav(sub, level + 1)

    def ncx(point, level):
        for p in children(point, "navPoint"):
            label = next((t for x in children(p, "navLabel") for t in children(x, "text")), None)
            target = next(iter(children(p, "content")), None)
            add(target.get("src") if target is not None else None, words(label.text) if label is not None else "", level)
            ncx(p, level + 1)

    root = ElementTree.fromstring(content)
    navs = [e for e in root.iter() if local(e) == "nav"]
    whole = [e for e in navs if any(k.rpartition("}")[2] == "type" and v == "toc" for k, v in e.attrib.items())] or navs
    for e in [x for x in root.iter() if local(x) == "navMap"][:1]:
        ncx(e, 0)
    for e in whole[:1]:
        for ol in children(e, "ol")[:1]:
            nav(ol, 0)
    return out


def tables_of_contents(found: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """Of each book's entries its table of contents: path, toc (the member that has it), seq, href, title, level, status, reason.

    The nav document's, or the NCX's where that has no entry or can't be read. What can't be read is reported; a book without
    a table of contents has no row.
    """
    read = contents(toc_candidates(found), whole=whole).select("path", "rank", F.col("member").alias("toc"), "content", "status", "reason")
    tree = attempted(read.where("status = 'ok'"), ["content"], toc_tree, "seq long, href string, title string, level int", ["path", "rank", "toc"])
    best = tree.where("status = 'ok'").groupBy("path").agg(F.min("rank").alias("rank"))
    faults = read.where("status = 'failed'").select("path", "toc", *[F.lit(None).cast(t).alias(c) for c, t in (("seq", "long"), ("href", "string"), ("title", "string"), ("level", "int"))], "status", "reason")
    names = faults.columns
    return tree.where("status = 'ok'").join(best, ["path", "rank"]).select(names).unionByName(tree.where("status = 'failed'").select(names)).unionByName(faults)


# Results in archives


def assigned(found: DataFrame, items: DataFrame, name: str) -> DataFrame:
    """Members matched to items by their name without folders and extension, never by position: every item and member once.

    items: `name` (a file name) and more. Columns: those of items, key, path, member, status: matched, missing (no member), extra
    (no item), repeated (the key has several members or items; none of them is matched), failed (an archive), and reason.
    """
    stem = lambda c: F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"\.[^.]*$", "")
    a = found.where("status = 'ok'").select("path", "member", stem(F.col("member")).alias("key"))
    b = items.withColumn("key", stem(F.col(name)))
    several = lambda d, n: d.groupBy("key").agg(F.count("*").alias(n))
    count = several(a, "_m").join(several(b, "_i"), "key", "full_outer").select("key", ((F.coalesce("_m", F.lit(0)) > 1) | (F.coalesce("_i", F.lit(0)) > 1)).alias("_several"), F.col("_i").isNotNull().alias("_item"), F.col("_m").isNotNull().alias("_member"))
    known = items.columns
    status = F.when(F.col("_several"), "repeated")
    # Pairs are only made of keys that both sides have once.
    left = b.join(count, "key").withColumn("status", status.when(F.col("_member"), "matched").otherwise("missing"))
    right = a.join(count, "key").withColumn("status", status.when(F.col("_item"), "matched").otherwise("extra"))
    once = right.where("status = 'matched'").select("key", "path", "member")
    none = lambda df, cols: df.select(*[F.lit(None).cast(items.schema[c].dataType).alias(c) for c in known], *cols)
    no = F.lit(None).cast("string")
    out = left.join(once, "key", "left").select(*known, "key", "path", "member", "status", no.alias("reason"))
    out = out.unionByName(none(right.where("status <> 'matched'"), ["key", "path", "member", "status", no.alias("reason")]))
    return out.unionByName(none(found.where("status = 'failed'"), [no.alias("key"), "path", no.alias("member"), "status", "reason"]))
