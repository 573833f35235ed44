"""Scalar text functions: Column to Column, inside Catalyst. White space is Unicode white space unless stated."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The characters that file names may not hold.
ILLEGAL = r'[<>:"/\\|?*]'
#: Titles of front matter in tables of contents.
TOC_NOISE = ("information", "cover", "copyright", "metadata", "title page")


def strip(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def squeeze(x: Column) -> Column:
    """Null becomes empty; runs of white space one space; ends stripped."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"(?U)\s+", " "))


def compare_key(x: Column) -> Column:
    return F.lower(squeeze(x))


def group(x: Column, pattern: str, index: int = 1) -> Column:
    """A regex group, null where the pattern doesn't match or the group is empty."""
    return F.nullif(F.regexp_extract(x, pattern, index), F.lit(""))


def number(x: Column, pattern: str, index: int = 1) -> Column:
    return group(x, pattern, index).try_cast("int")


def safe_name(x: Column, most: int = 120) -> Column:
    """A file or folder name: squeezed, illegal characters and spaces to one underscore, no dots or underscores at the ends."""
    plain = F.regexp_replace(F.regexp_replace(squeeze(x), ILLEGAL, "_"), " ", "_")
    return F.substring(F.regexp_replace(F.regexp_replace(plain, "_+", "_"), r"^[._]+|[._]+$", ""), 1, most)


#: Prefixes of numbered titles, and headers of chapter files.
_PREFIX = r"(?i)^\s*(?:chapter|ch\.|vol\.|volume|book|part)\s*\d+\s*[:\-]?\s*"


def safe_ascii(x: Column, most: int = 30) -> Column:
    """An ASCII name: other code points to ?, numbered prefix dropped, anything but letters, digits, _ . - to underscore."""
    plain = F.regexp_replace(F.regexp_replace(x, r"[^\x00-\x7F]", "?"), _PREFIX, "")
    plain = F.regexp_replace(F.regexp_replace(plain, ILLEGAL, "_"), " ", "_")
    return F.substring(F.regexp_replace(plain, r"[^A-Za-z0-9_.\-]", "_"), 1, most)


def chapter_file(title: Column, chapter: Column, level: Column, volume: Column) -> Column:
    name = safe_ascii(title)
    side = F.lower(title).contains("side") & F.lower(title).contains("stories")
    return F.when((level == 0) & side, F.lit("Side_Stories.txt")).when(level == 0, F.format_string("Volume_%s_%s.txt", volume, name)).otherwise(F.format_string("Chapter_%s_%s.txt", chapter, name))


def volume_folder(title: Column, volume: Column) -> Column:
    side = F.lower(title).contains("side") & F.lower(title).contains("stories")
    return F.when(side, F.lit("Side_Stories")).otherwise(F.format_string("Volume_%s_%s", volume, safe_ascii(title)))


def asset_name(name: Column, mime: Column) -> Column:
    ext = F.when(mime == "image/png", ".png").when(mime == "image/webp", ".webp").otherwise(".jpg")
    return F.concat(F.regexp_replace(F.regexp_replace(name, r"[^A-Za-z0-9 _\-]", ""), " ", "_"), ext)


def clean_title(x: Column) -> Column:
    """Squeezed, without a numbered prefix such as `Volume 3:`."""
    return F.regexp_replace(squeeze(x), _PREFIX, "")


def clean_chapter_title(x: Column) -> Column:
    """Without `Chapter N:` and any following `N:` or `N"`; the title itself where nothing is left."""
    plain = squeeze(x)
    short = F.trim(F.regexp_replace(F.regexp_replace(plain, r"(?i)^chapter\s+\d+\s*[:\-]?\s*", ""), r'^(?:\s*\d+\s*[:"]\s*)+', ""))
    return F.coalesce(F.nullif(short, F.lit("")), plain)


def clean_volume_name(x: Column) -> Column:
    short = F.trim(F.regexp_replace(squeeze(x), r"(?i)^(?:volume|book)\s+\d+\s*[:\-]?\s*", ""))
    return F.coalesce(F.nullif(short, F.lit("")), F.lit("Main Story"))


def leading_number(x: Column) -> Column:
    """The number of `N: ...` or `Chapter N ...`, else null."""
    return F.coalesce(number(x, r"^\s*(\d+)\s*:"), number(x, r"(?i)^\s*chapter\s+(\d+)\b"))


def chapter_number_text(x: Column) -> Column:
    return F.coalesce(group(x, r"(?i)chapter\s+(\d+)"), group(x, r"^\s*(\d+)"), F.lit("1"))


def volume_number_text(x: Column) -> Column:
    side = F.lower(x).contains("side") & F.lower(x).contains("stories")
    return F.coalesce(group(x, r"(?i)volume\s+(\d+)"), F.when(side, F.lit("Side Stories")), group(x, r"^\s*(\d+)"), F.lit("1"))


def volume_of_folder(x: Column, pattern: str = r"^(\d+)", missing: int | None = 0) -> Column:
    """The number in a folder's name by the project's pattern; side stories are volume 9."""
    return F.when(F.lower(x) == "side_stories", 9).otherwise(F.coalesce(number(x, pattern), F.lit(missing).cast("int")))


def title_of_filename(name: Column, pattern: str = r"^Chapter_\d+") -> Column:
    stem = F.regexp_replace(name, r"\.[A-Za-z0-9]+$", "")
    rest = F.regexp_replace(F.regexp_replace(stem, pattern, ""), r"^_+", "")
    return F.nullif(strip(F.translate(rest, "_", " ")), F.lit(""))


_HEADER = r"^\s*Chapter\s+(\d+)\s*:\s*(.+?)\s*$"


def header_number(x: Column) -> Column:
    return number(x, _HEADER)


def header_title(x: Column) -> Column:
    return group(x, _HEADER, 2)


def header_line(chapter: Column, title: Column) -> Column:
    return F.format_string("Chapter %d: %s", chapter, title)


def title_or_default(header: Column, filename: Column, chapter: Column) -> Column:
    return F.coalesce(header, filename, F.format_string("Chapter %d", chapter))


@dataclass(frozen=True)
class Spoken:
    """A word and how it is spoken."""

    word: str
    spoken_as: str
    include_possessive: bool = True
    case_insensitive: bool = True


def pronounce(x: Column, rules: list[Spoken]) -> Column:
    """The rules in order; whole words by ASCII letters and digits. Upper case stays upper, an initial capital stays one, and a
    possessive ends in a small s.

    Each rule takes its matches out of the text in one pass, so none is matched twice by the same rule.
    """

    def in_case(spoken: str, word: Column) -> Column:
        first = F.substring(word, 1, 1)
        cased = lambda c: (F.upper(c) == c) & (F.lower(c) != c)
        return F.when(cased(word), spoken.upper()).when(cased(first), spoken[:1].upper() + spoken[1:]).otherwise(spoken)

    def one(text: Column, rule: Spoken) -> Column:
        word, spoken = rule.word.strip(), rule.spoken_as.strip()
        if not word or not spoken:
            return text
        flags = "(?iu)" if rule.case_insensitive else ""
        exact = "\\Q" + word.replace("\\E", "\\E\\\\E\\Q") + "\\E"
        pattern = rf"{flags}(?<![A-Za-z0-9]){exact}{"(?:'s)?" if rule.include_possessive else ''}(?![A-Za-z0-9])"

        def said(m: Column) -> Column:
            owned = F.lower(m) == (word + "'s").lower()
            stem = F.when(owned, F.substr(m, F.lit(1), F.length(m) - 2)).otherwise(m)
            return F.when(F.lower(m) == word.lower(), in_case(spoken, m)).when(owned, F.concat(in_case(spoken, stem), F.lit("'s"))).otherwise(m)

        def replaced(t: Column) -> Column:
            between, found = F.split(t, pattern, -1), F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
            return F.array_join(F.zip_with(between, found, lambda b, m: F.concat(b, F.coalesce(said(m), F.lit("")))), "")

        # The lambda's variable stands for the text, which several rules would otherwise multiply.
        return F.get(F.transform(F.array(text), lambda t: F.when(t.rlike(pattern), replaced(t)).otherwise(t)), F.lit(0))

    return reduce(one, rules, x)


def truncate(x: Column, most: int) -> Column:
    return F.substring(x, 1, most)


def xml_escape(x: Column) -> Column:
    return F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def ssml(text: Column, voice: str, language: str = "en-US") -> Column:
    head = f"<speak version='1.0' xml:lang='{language}'><voice name='{voice}'>"
    return F.concat(F.lit(head), xml_escape(text), F.lit("</voice></speak>"))


def resolve_href(base: Column, href: Column) -> Column:
    """href relative to the folder `base`: percent-decoded (plus signs stay), slashes forward, absolute addresses as they are."""
    plain = F.translate(F.url_decode(F.replace(href, F.lit("+"), F.lit("%2B"))), "\\", "/")
    joined = F.when(base == "", plain).otherwise(F.concat_ws("/", F.regexp_replace(base, "/+$", ""), plain))
    return F.when(plain.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), plain).otherwise(F.regexp_replace(joined, r"^[./]+", ""))


def drop_fragment(href: Column) -> Column:
    return F.substring_index(href, "#", 1)


def template(pattern: str, values: dict[str, Column]) -> Column:
    """pattern with each {name} replaced by its column."""
    out = F.lit(pattern)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def clock(seconds: Column) -> Column:
    """H:MM:SS of seconds, rounded half to even."""
    s = F.bround(seconds).cast("long")
    return F.format_string("%d:%02d:%02d", F.floor(s / 3600).cast("long"), F.floor(s % 3600 / 60).cast("long"), s % 60)


def slug(x: Column) -> Column:
    return F.regexp_replace(strip(F.regexp_replace(F.lower(x), r"(?U)[^\w\s-]", "")), r"(?U)\s+", "-")


def layout(n: Column) -> Column:
    return F.when(n == 0, "hold-previous").when(n == 1, "single").when(n <= 4, F.format_string("row(%d)", n)).otherwise(F.format_string("grid(%d)", n))


def status(have: Column, name: Column, registered: Column, declined: Column) -> Column:
    return F.when(have, "have").when(name.startswith("["), "background").when(~registered, "minor").when(declined, "declined").otherwise("need")


def persona(given: Column, chapter: Column, before: str, after: str, flips_at: int = 17) -> Column:
    return F.coalesce(given, F.when(chapter < flips_at, before).otherwise(after))


def compact_numbers(numbers: Column) -> Column:
    """`a–b (n)` of more than four sorted numbers, else all of them."""
    few = F.array_join(F.transform(numbers, lambda n: n.cast("string")), ", ")
    many = F.format_string("%s–%s (%s)", F.array_min(numbers).cast("string"), F.array_max(numbers).cast("string"), F.size(numbers).cast("string"))
    return F.when(F.size(numbers) > 4, many).otherwise(few)


def context_of(settings: Column, each: int = 55, most: int = 110) -> Column:
    joined = F.array_join(F.transform(F.slice(settings, 1, 2), lambda s: F.substring(s, 1, each)), "; ")
    return F.when(F.length(joined) > most, F.concat(F.substring(joined, 1, most), F.lit("…"))).otherwise(joined)


def ends_sentence(x: Column) -> Column:
    return strip(x).rlike(r'[.!?]["”’]?$')


def starts_paragraph(line: Column) -> Column:
    """Blank; an opening quote that isn't closed on the line; or a name with said, thought or wondered."""
    plain = strip(line)
    opened = plain.rlike(r'^["“]') & ~plain.rlike(r'^["“].*["”]')
    return (plain == "") | opened | plain.rlike(r"^[A-Z][a-z]+ (?:said|thought|wondered)\b")


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * 100.0 / whole).otherwise(0.0)


def megabytes(size: Column) -> Column:
    return F.round(size / 1048576.0, 2)


def remaining(elapsed: Column, done: Column, total: Column) -> Column:
    return F.when(done > 0, elapsed * total / done - elapsed)


def resized(name: Column, width: int = 1920, height: int = 1080) -> Column:
    return F.regexp_replace(name, r"(\.[^.]+)$", f"_{width}x{height}$1")


def media_command(program: str, arguments: list[str], values: dict[str, Column]) -> Column:
    """An argument list (array of string) for an outside program, each argument a template of {name}s."""
    return F.array(F.lit(program), *[template(a, values) for a in arguments])


def swap_extension(name: Column, old: str, new: str) -> Column:
    return F.replace(name, F.lit(old), F.lit(new))


def tokens(x: Column) -> Column:
    return F.filter(F.regexp_extract_all(x, F.lit("[A-Za-z']+"), F.lit(0)), lambda w: F.length(w) > 2)


def chapter_of_row(filename: Column, column: Column) -> Column:
    return F.coalesce(number(filename, r"(?i)chapter_(\d+)"), column)


def chapter_id(volume: Column, chapter: Column, filename: Column) -> Column:
    both = volume.isNotNull() & chapter.isNotNull()
    return F.when(both, F.format_string("%02d_%03d_%s", volume, chapter, filename)).otherwise(filename)


def is_toc_noise(title: Column) -> Column:
    return compare_key(title).isin(*TOC_NOISE)


def looks_like_chapter(title: Column) -> Column:
    return title.rlike(r"(?i)\bchapter\b|\d")


def is_volume_title(title: Column, level: Column) -> Column:
    return ((level == 0) & title.rlike(r"(?i)\b(?:volume|book)\b")) | title.rlike(r"(?i)^\s*volume\s+\d+")


def is_noise_line(line: Column, markers: list[str]) -> Column:
    low = F.lower(line)
    return reduce(lambda a, b: a | b, [low.contains(m) for m in markers])


#: The hyphens and dashes between two chapter numbers.
DASHES = r"[\-\u2010\u2011\u2012\u2013\u2014\u2212]"


def echoes_title(text: Column, chapter: Column, title: Column) -> Column:
    """Whether a paragraph is blank or only repeats a chapter's number or title.

    Under 280 characters these count: `Chapter N:` with anything after it, `Chapter N - M:` with anything after it, a whole
    `Chapter N - M`, and the own number with the title. The own header or title counts at any length.
    """
    plain, key, n = squeeze(text), compare_key(text), chapter.cast("string")
    short = F.length(plain) < 280
    numbered = plain.rlike(rf"(?i)^chapter\s+\d+\s*:") | plain.rlike(rf"(?i)^chapter\s+\d+\s*{DASHES}\s*\d+\s*(?::|$)")
    same = lambda *parts: key == compare_key(F.concat(*parts))
    whole = same(F.lit("chapter "), n, F.lit(": "), title) | same(title)
    bare = same(n, F.lit(" "), title) | same(n, F.lit(": "), title)
    return (plain == "") | (short & numbered) | F.coalesce(whole, F.lit(False)) | (short & F.coalesce(bare, F.lit(False)))


def has_number(text: Column, n: Column) -> Column:
    """Whether the text has `Chapter n`, leading zeros allowed, with no digit after it."""
    found = F.regexp_extract_all(text, F.lit(r"(?i)Chapter\s*(\d+)"), F.lit(1))
    return F.exists(found, lambda x: x.try_cast("int") == n)


def parse_range(spec: Column) -> tuple[Column, Column]:
    """Both ends of `a-b` or `a`; null where that isn't a range."""
    lo, hi = F.split_part(spec, F.lit("-"), F.lit(1)), F.split_part(spec, F.lit("-"), F.lit(2))
    a = F.trim(lo).try_cast("int")
    return a, F.when(spec.contains("-"), F.trim(hi).try_cast("int")).otherwise(a)


# The words and numerals of volume labels, and the letters of roman numerals with their values.
_LABEL = r"(?is)^\s*(volume|book|part)\s+(\d+|[ivxlcdm]+)\b"
_ROMAN = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}


def roman(numeral: Column) -> Column:
    """The number of a roman numeral in standard form (1 to 3999), in either case; null otherwise."""
    low = F.lower(numeral)
    count = lambda c: F.length(low) - F.length(F.replace(low, F.lit(c), F.lit("")))
    total = F.lit(0)
    for c, v in _ROMAN.items():
        total = total + count(c) * v
    pair = {"i": "i[vx]", "x": "x[lc]", "c": "c[dm]"}
    for c in pair:  # a letter before one of the next two is taken off instead of added
        total = total - F.when(low.rlike(pair[c]), 2 * _ROMAN[c]).otherwise(0)
    good = low.rlike("^(?=.)m{0,3}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})$")
    return F.when(good, total.cast("long"))


def volume_label(title: Column) -> tuple[Column, Column]:
    """kind (volume, book or part in lower case) and number of a title that begins with a label; the number is null where the
    numeral isn't well-formed or too large."""
    kind = F.nullif(F.lower(F.regexp_extract(title, _LABEL, 1)), F.lit(""))
    text = F.regexp_extract(title, _LABEL, 2)
    return kind, F.when(kind.isNotNull(), F.coalesce(text.try_cast("long"), roman(text)))
