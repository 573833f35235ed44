"""Body text of HTML: XML, lenient HTML and regular expressions, in one Arrow UDF or, for the last, inside Catalyst."""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tags whose end closes a block, whose text is dropped, that are headings, and that never have an end tag.
BLOCKS = {"p", "blockquote", "li"}
SKIPPED = {"nav", "script", "style", "head", "title", "meta", "link"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


def squeezed(text: str) -> str:
    return " ".join(text.split())


def tokens_of(html: str) -> list[tuple[int, str]]:
    """The document as (1, tag), (-1, tag) and (0, text) in order; tags without prefix, in lower case."""
    found: list[tuple[int, str]] = []
    scan = HTMLParser(convert_charrefs=True)
    scan.handle_data = lambda data: found.append((0, data))
    scan.handle_starttag = lambda tag, attrs: found.append((1, tag.rpartition(":")[2]))
    scan.handle_endtag = lambda tag: found.append((-1, tag.rpartition(":")[2]))
    scan.feed(html)
    scan.close()
    return found


def depths(tokens: list[tuple[int, str]], tags: set[str]) -> list[int]:
    """How many of the tags are open after each token; an end without a start counts nothing."""
    return list(accumulate((step * (name in tags) for step, name in tokens), lambda open_, step: max(0, open_ + step), initial=0))[1:]


def blocks_of(html: str | None, compat: bool = False) -> list[str]:
    """The texts of blocks in order: all visible text up to the end of a block that isn't hidden, and what follows the last.

    Text inside SKIPPED tags and headings is hidden. compat: void tags such as an unclosed <meta> hide all that follows.
    """
    tokens = tokens_of(html or "")
    hiding = SKIPPED if compat else SKIPPED - VOID
    seen = [a + b == 0 for a, b in zip(depths(tokens, hiding), depths(tokens, HEADINGS), strict=True)]
    ends = [ok and step < 0 and name in BLOCKS for ok, (step, name) in zip(seen, tokens, strict=True)]
    texts = [(done, text) for done, ok, (step, text) in zip(accumulate(ends), seen, tokens, strict=True) if ok and not step]
    return [t for _, run in groupby(texts, itemgetter(0)) if (t := squeezed("".join(x for _, x in run)))]


def xml_blocks_of(xml: bytes) -> list[str]:
    """The texts of all block elements below the body, nested ones too; none without a body. Raises on malformed XML."""
    from xml.etree import ElementTree

    body = ElementTree.fromstring(xml).find(".//{*}body")
    elements = [] if body is None else [e for e in body.iter() if isinstance(e.tag, str) and e.tag.rpartition("}")[2].lower() in BLOCKS]
    return [t for e in elements if (t := squeezed("".join(e.itertext())))]


# The patterns of the last way to read a page, by regular expressions.
BODY = r"(?is)<body[^>]*>(.*)</body>"
HIDDEN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>"
PARAGRAPH = r"(?is)<p[^>]*>(.*?)</p>"
TAG = r"<[^>]+>"


def regex_blocks_of(html: str) -> list[str]:
    """Paragraphs by regular expressions, for input that no parser takes."""
    body = re.search(BODY, html)
    bare = re.sub(HIDDEN, " ", body[1] if body else html)
    inner = (squeezed(unescape(re.sub(TAG, " ", x))) for x in re.findall(PARAGRAPH, bare))
    return [t for t in inner if t]


def read_blocks(source: str | bytes | None, compat: bool = False) -> tuple[str, list[str]]:
    """How a document was read (xml, html or regex) and its blocks: each way only where the one before fails."""
    from xml.etree import ElementTree

    data = source.encode() if isinstance(source, str) else source or b""
    try:
        return "xml", xml_blocks_of(data)
    except (ElementTree.ParseError, ValueError, LookupError):
        text = data.decode("utf-8", errors="replace")
    try:
        return "html", blocks_of(text, compat)
    except Exception:  # the lenient parser's failures aren't documented
        return "regex", regex_blocks_of(text)


def body_blocks(source: Column, compat: bool = False) -> Column:
    """A struct of `way` (xml, html, regex) and `blocks` (array of string) of a string or binary column."""
    kind = T.StructType([T.StructField("way", T.StringType()), T.StructField("blocks", T.ArrayType(T.StringType()))])

    @F.arrow_udf(kind)
    def run(column: pa.Array) -> pa.Array:
        got = [read_blocks(x, compat) for x in column.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([w for w, _ in got], pa.string()), pa.array([b for _, b in got], pa.list_(pa.string()))], names=["way", "blocks"])

    return run(source)


def basic_entities(x: Column) -> Column:
    """The five entities of XML, the ampersand last."""
    for name, value in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(value))
    return x


def regex_paragraphs(html: Column) -> Column:
    """The paragraphs of regex_blocks_of inside Catalyst (array of string), with the five entities of XML only."""
    body = F.regexp_extract(html, BODY, 1)
    bare = F.regexp_replace(F.when(body == "", html).otherwise(body), HIDDEN, " ")
    inner = F.regexp_extract_all(bare, F.lit(PARAGRAPH), F.lit(1))
    plain = F.transform(inner, lambda p: F.trim(F.regexp_replace(basic_entities(F.regexp_replace(p, TAG, " ")), r"[ \t\r\n\f]+", " ")))
    return F.filter(plain, lambda p: p != "")


def block_rows(pages: DataFrame, key: str, blocks: Column) -> DataFrame:
    return pages.select(key, F.posexplode(blocks).alias("seq", "text"))
