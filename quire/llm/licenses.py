"""Licence scans by a positional index of rare words, with DataFrame and SQL functions only.

Templates are short phrases (label certain by the phrase alone) and notices (a few lines of a licence, with key phrases that must
stand in them word by word). The words of all templates make up the vocabulary, a few hundred at most; function words of notices
are left out, though they count as positions.

1. Each text is cut into words once. Its postings, the places of vocabulary words in order of place, are written: a long for
   each, place * CODES + word. Nothing after that reads texts.
2. The documents that hold each vocabulary word are counted over all rows, which gives the words' IDF.
3. A template's anchor is the word of highest IDF in its key phrases, so it is the rarest licence word that any file with the
   template holds. Only a file's postings of anchors are looked up. At each, the template's other key words are intersected by
   relative position: words of a phrase are neighbours in the postings, so each is one look at a known place. Places that pass
   verify the other key phrases and sum up the IDF of all words of the notice that stand at their places.

A phrase is found at each place where its words stand one after the other. A notice is found if all its key phrases are there
and SHARE of its IDF. Every place passes its anchor, so nothing is missed whatever the IDF.

score: the highest share of a notice that was found, PHRASE_SCORE for phrases alone, 0 without any.

Defined cases: null text is the empty text, of no words; rows are judged by themselves, so null and repeated keys don't matter;
columns of other names are kept, those named like the outputs are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm._common import cut, scratch

# Fixed values of the contract: phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# The method's own templates: label, words of the notice, key phrases. The wording is that of the public licence notices.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ["permission is hereby granted free of charge"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ["except in compliance with the license"]),
    ("gpl-3.0", "licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["gnu general public license as published by the free software foundation"]),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ["gnu lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", ["gnu affero general public license"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["source and binary forms", "following conditions are met"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["purpose with or without fee"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software", "public domain"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc0", "licensed under cc0 1 0 universal", ["cc0 1 0"]),
]
#: Words that notices are not matched by, unless in a key phrase.
COMMON = "a an and any are as at be by for in is it not of on or that the this to under with you".split()
#: The share of a notice's IDF that must be there, and the score of phrases alone.
SHARE, PHRASE_SCORE = 0.6, 0.5
#: Codes are below this; a posting is place * CODES + code.
CODES = 1 << 12
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Template:
    """A phrase or notice: label, places of its key phrases' words (each phrase's places in order) and of all words matched."""

    def __init__(self, label: str, text: str, keys: list[str], phrase: bool = False):
        self.label, self.phrase, self.words = label, phrase, text.split()
        self.keys = []
        for key in keys:
            k = key.split()
            at = next((i for i in range(len(self.words)) if self.words[i : i + len(k)] == k), None)
            if at is None or not k:
                raise ValueError(f"{key!r} isn't part of {text!r}")
            self.keys.append(range(at, at + len(k)))
        must = {i for r in self.keys for i in r}
        self.held = [i for i, w in enumerate(self.words) if i in must or w not in COMMON]


def templates(phrases: dict[str, str] = PHRASES, notices: list[tuple[str, str, list[str]]] = NOTICES) -> list[Template]:
    return [*[Template(label, text, [text], True) for text, label in phrases.items()], *[Template(*n) for n in notices]]


def vocabulary(given: list[Template]) -> list[str]:
    """All words that templates are matched by, in order; a word's code is its place."""
    out = sorted({t.words[i] for t in given for i in t.held})
    if len(out) > CODES:
        raise ValueError(f"the templates have more than {CODES} words")
    return out


def postings(text: str, words: list[str]) -> tuple[Column, Column]:
    """The number of words of a text, and the postings of the vocabulary in it."""
    every = f"regexp_extract_all(translate(coalesce(`{text}`, ''), '{UPPER}', '{LOWER}'), r'{WORD}', 0)"
    listed = ", ".join(f"'{w}'" for w in words)
    codes = ", ".join(f"'{w}', {i}L" for i, w in enumerate(words))
    one = f"IF(w IN ({listed}), i * {CODES}L + element_at(map({codes}), w), NULL)"
    return F.expr(every), F.expr(f"filter(transform(_words, (w, i) -> {one}), x -> x IS NOT NULL)")


def longs(values) -> str:
    return f"array({', '.join(f'{v}L' for v in values)})"


def found(t: Template, code: dict[str, int], idf: dict[str, float]) -> tuple[str, int]:
    """SQL for the places in _at (of anchors in _postings) at which the template's key phrase with the anchor stands, and the
    anchor's place in the template."""
    anchor = max((i for r in t.keys for i in r), key=lambda i: (idf[t.words[i]], -i))
    own = next(r for r in t.keys if anchor in r)
    # A phrase's words are neighbours in the postings, so their postings differ by known numbers.
    tests = [f"get(_postings, i + {j - anchor}) - get(_postings, i) = {(j - anchor) * CODES + code[t.words[j]] - code[t.words[anchor]]}" for j in own if j != anchor]
    return f"filter(_at, i -> {' AND '.join([f'(get(_postings, i) & {CODES - 1}) = {code[t.words[anchor]]}', *tests])})", anchor


def share_of(t: Template, anchor: int, code: dict[str, int], idf: dict[str, float]) -> str:
    """SQL for the share of the notice's IDF at the anchor i, 0 if a key phrase isn't there."""
    base = f"(get(_postings, i) - {anchor * CODES + code[t.words[anchor]]}L)"
    near = f"slice(_postings, greatest(i - {anchor}, 0) + 1, {2 * len(t.words)})"
    must = [j * CODES + code[t.words[j]] for r in t.keys for j in r]
    total = sum(idf[t.words[j]] for j in t.held)
    each = ", ".join(f"IF(array_contains(n, b + {j * CODES + code[t.words[j]]}L), {idf[t.words[j]] / total!r}D, 0D)" for j in t.held)
    all_ = f"forall({longs(must)}, m -> array_contains(n, b + m))"
    # `b` and `n` stand for the place of the notice's first word and the postings around it.
    body = f"IF({all_}, aggregate(array({each}), 0D, (s, x) -> s + x), 0D)"
    return f"get(transform(array({base}), b -> get(transform(array({near}), n -> {body}), 0)), 0)"


def scan(docs: DataFrame, text: str = "text", given: list[Template] | None = None) -> DataFrame:
    """docs without the text, with n_words, n_base, first_word, last_word (places of phrases), base_labels, labels and score."""
    given = templates() if given is None else given
    words = vocabulary(given)
    code = {w: i for i, w in enumerate(words)}
    made = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kept = [c for c in docs.columns if c != text and c not in made]
    every, held = postings(text, words)
    cut_up = docs.select(*kept, every.alias("_words")).select(*kept, F.size("_words").cast("long").alias("n_words"), held.alias("_postings"))
    rows = cut(cut_up, scratch(docs.sparkSession), "postings")
    number = rows.count()
    holders = rows.select(F.explode(F.array_distinct(F.transform("_postings", lambda x: x.bitwiseAND(CODES - 1)))).alias("c")).groupBy("c").agg(F.count("*").alias("n"))
    held_by = {words[r["c"]]: r["n"] for r in holders.collect()}  # a row for each word of the vocabulary at most
    idf = {w: log(1 + number / (1 + held_by.get(w, 0))) + 1e-12 for w in words}
    made_of = [(t, *found(t, code, idf)) for t in given]
    anchors = sorted({code[t.words[a]] for t, _, a in made_of})
    at = rows.withColumn("_at", F.expr(f"filter(transform(_postings, (x, i) -> IF((x & {CODES - 1}) IN ({', '.join(map(str, anchors))}), i, NULL)), i -> i IS NOT NULL)"))
    phrases = [(t, f"transform({places}, i -> shiftright(get(_postings, i), {CODES.bit_length() - 1}) - {a})") for t, places, a in made_of if t.phrase]
    notices = [(t, f"coalesce(array_max(transform({places}, i -> {share_of(t, a, code, idf)})), 0D)") for t, places, a in made_of if not t.phrase]
    step = at.withColumn("_starts", F.expr(f"array({', '.join(s for _, s in phrases)})")).withColumn("_shares", F.expr(f"transform(array({', '.join(s for _, s in notices)}), x -> IF(x >= {SHARE}D, x, 0D))") if notices else F.array(F.lit(0.0)))
    labels = F.expr(f"array_distinct(filter(array({', '.join(f'''IF(size(get(_starts, {i})) > 0, '{t.label}', NULL)''' for i, (t, _) in enumerate(phrases))}), x -> x IS NOT NULL))")
    more = F.expr(f"filter(array({', '.join(f'''IF(get(_shares, {i}) > 0, '{t.label}', NULL)''' for i, (t, _) in enumerate(notices))}), x -> x IS NOT NULL)") if notices else F.array().cast("array<string>")
    whole = F.flatten("_starts")
    step = step.withColumn("_base", labels).select(
        *kept,
        "n_words",
        F.size(whole).cast("long").alias("n_base"),
        F.array_min(whole).alias("first_word"),
        F.array_max(whole).alias("last_word"),
        F.array_join(F.sort_array("_base"), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union("_base", more)), ",").alias("labels"),
        F.greatest(F.when(F.size(whole) > 0, F.lit(PHRASE_SCORE)).otherwise(0.0), F.least(F.array_max("_shares"), F.lit(1.0))).alias("score"),
    )
    return step


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return scan(docs).withColumn("score", F.round("score", 6))


def oracle() -> str:
    """SQL that compares every word of every document with every word of every template."""
    given = templates()
    quoted = lambda x: "'" + x + "'"
    rows = [f"({n}, {quoted(t.label)}, {t.phrase}, {i}, {quoted(t.words[i])}, {sum(i in r for r in t.keys) > 0})" for n, t in enumerate(given) for i in t.held]
    return f"""
with w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as ws from documents),
     p as (select doc_id, unnest(range(len(ws))) as pos, unnest(ws) as word from w),
     t(n, label, phrase, j, word, must) as (values {', '.join(rows)}),
     i as (select word, ln(1 + (select count(*) from documents) / (1 + (select count(distinct doc_id) from p where p.word = v.word))) + 1e-12 as idf from (select distinct word from t) v),
     n as (select n, count(*) filter (where must) as musts, sum(idf) as total from t join i using (word) group by n),
     m as (select doc_id, t.n, any_value(label) as label, any_value(phrase) as phrase, pos - j as start, sum(idf) as got, count(*) filter (where must) as musts from p join t using (word) join i using (word) group by doc_id, t.n, pos - j),
     f as (select doc_id, label, phrase, start, got / total as share from m join n using (n) where m.musts = n.musts and got / total >= {SHARE}),
     a as (select doc_id, count(*) filter (where phrase) as n_base, min(start) filter (where phrase) as first_word, max(start) filter (where phrase) as last_word,
                  array_to_string(list_sort(list(distinct label) filter (where phrase)), ',') as base_labels, array_to_string(list_sort(list(distinct label)), ',') as labels,
                  greatest(coalesce(max(share) filter (where not phrase), 0), case when count(*) filter (where phrase) > 0 then {PHRASE_SCORE} else 0 end) as score from f group by doc_id)
select doc_id, len(ws)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, round(coalesce(score, 0)::double, 6) as score
from w left join a using (doc_id)
"""


OP11_SQL = oracle()
