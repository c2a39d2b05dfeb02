r"""Licence scan with a positional rare-token index (operator 1).

Contract: A-Z of a whole text lower-cased; words are runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``.  Base places are
those where the words of a base phrase stand one after another.

The index holds the places of every word of the templates' mandatory key phrases.  The words' document frequencies over
the whole corpus order them by IDF.  A file's own licence words are taken from its rarest on: each gives, by a place in
the file less a place in the template, relative positions (where the template would start), and a template's positions
are intersected from word to word.  The look-up goes on to further words until every template that is still possible
has had ``LOOKUPS`` of them (or all it has), then the key phrases are verified word by word at the positions left.  A
template is found there if at least ``MATCH`` of its words stand at their places.  A true place holds every word of the
key phrases, so no look-up can lose it: the ranking and ``LOOKUPS`` change the work and never the result.

``labels`` joins base labels and those of found templates.  ``score`` is the largest share of a template's words found
at one verified place (a base phrase counts as a template that must match whole), 0 where nothing is found.

Null text: empty.  Repeated rows: a result row each.  Null doc_id is kept.  Empty tables give empty results; other
columns are ignored.  Memory: one text's words at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillwort.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MATCH = 0.6
#: Rare words a possible template is looked up by before its key phrases are compared.
LOOKUPS = 3
# The base phrases and their labels.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
#: label, template, its mandatory key phrases.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind", ("permission is hereby granted free of charge", "the above copyright notice and this permission notice", "the software is provided as is")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", ("redistributions of source code must retain", "redistributions in binary form must reproduce")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", ("permission to use copy modify", "appear in all copies")),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    ("mit", "the mit license mit", ("the mit license",)),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("under the apache license",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("gpl-3", "gnu general public license version 3", ("gnu general public license", "version 3")),
    ("gpl-2", "gnu general public license version 2", ("gnu general public license", "version 2")),
    ("lgpl", "gnu lesser general public license", ("gnu lesser general public license",)),
    ("agpl-3", "gnu affero general public license version 3", ("gnu affero general public license",)),
    ("mpl-2", "mozilla public license version 2 0", ("mozilla public license",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
    ("cc-by-sa", "cc by sa", ("cc by sa",)),
    ("cc-by-nc", "creative commons attribution noncommercial", ("creative commons attribution noncommercial",)),
    ("cc0", "cc0 1 0 universal public domain dedication", ("cc0 1 0",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify",)),
    ("proprietary", "all rights reserved", ("all rights reserved",)),
)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").encode().lower().decode())


def _all_templates() -> list[tuple[str, list[str], list[tuple[int, list[str]]], bool]]:
    """(label, words, key phrases with their places, base) of base phrases and templates."""
    out = [(label, p.split(), [(0, p.split())], True) for label, p in BASE]
    for label, body, keys in TEMPLATES:
        w = body.split()
        at = [next(i for i in range(len(w)) if w[i : i + len(k.split())] == k.split()) for k in keys]
        out.append((label, w, [(i, k.split()) for i, k in zip(at, keys)], False))
    return out


VOCABULARY = frozenset(w for _, ws, _, _ in _all_templates() for w in ws)


def document_frequencies(docs: DataFrame) -> dict[str, int]:
    """How many documents of the whole corpus have each licence word.  The result has the vocabulary's fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter[str] = Counter()
        for b in batches:
            for t in b.column("text").to_pylist():
                if t:
                    c.update(VOCABULARY.intersection(words_of(t)))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["word", "df"])

    return {r["word"]: r["df"] for r in docs.select("text").mapInArrow(run, "word string, df long").groupBy("word").agg(F.sum("df").alias("df")).collect()}


class Index:
    """Posting lists of key phrase words: word to (template number, place in the template); ``rank`` is their order by IDF."""

    def __init__(self, df: dict[str, int]):
        self.templates = _all_templates()
        self.postings: dict[str, list[tuple[int, int]]] = {}
        for n, (_, _, keys, _) in enumerate(self.templates):
            for at, phrase in keys:
                for i, w in enumerate(phrase):
                    self.postings.setdefault(w, []).append((n, at + i))
        # Highest IDF, that is fewest documents, first; ties by the word.
        self.rank = {w: r for r, w in enumerate(sorted(self.postings, key=lambda w: (df.get(w, 0), w)))}
        self.must = [{w for _, phrase in keys for w in phrase} for _, _, keys, _ in self.templates]

    def starts(self, words: list[str]) -> dict[int, set[int]]:
        """Template to the places where it can start, by the file's rarest licence words."""
        have = self.postings.keys() & set(words)
        open_ = {n: min(LOOKUPS, len(must)) for n, must in enumerate(self.must) if must <= have}
        found: dict[int, set[int]] = {}
        for w in sorted(have, key=self.rank.__getitem__):
            if not open_:
                break
            asked = [(n, place) for n, place in self.postings[w] if n in open_]
            at = [i for i, x in enumerate(words) if x == w] if asked else []
            for n, place in asked:
                here = {i - place for i in at}
                found[n] = found[n] & here if n in found else here
            for n in {n for n, _ in asked}:
                open_[n] -= 1
                if not open_[n] or not found[n]:
                    del open_[n]
        return found

    def scan(self, text: str | None) -> tuple:
        words = words_of(text)
        base, base_labels, labels, score = [], set(), set(), 0.0
        for n, places in self.starts(words).items():
            label, body, keys, is_base = self.templates[n]
            for start in places:
                if any(start + at < 0 or words[start + at : start + at + len(p)] != p for at, p in keys):
                    continue
                share = sum(0 <= start + i < len(words) and words[start + i] == x for i, x in enumerate(body)) / len(body)
                if is_base:
                    base.append(start)
                    base_labels.add(label)
                if is_base or share >= MATCH:
                    labels.add(label)
                    score = max(score, share)
        return len(words), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), score


OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])


def license_scan(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``(doc_id, text): word counts, base places, labels and score."""
    index = Index(document_frequencies(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [index.scan(t) for t in b.column("text").to_pylist()]
            cols = list(zip(*rows)) or [[] for _ in OUT[1:]]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(cols, list(OUT)[1:]))], schema=OUT)

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    """Brute force: every template against every place of every document."""
    rows, must = [], []
    for n, (label, body, keys, base) in enumerate(_all_templates()):
        rows += [f"({n},'{label}',{str(base).lower()},{len(body)},{i},'{w}')" for i, w in enumerate(body)]
        must += [f"({n},{i})" for i in sorted({at + i for at, p in keys for i in range(len(p))})]
    return rf"""
WITH tw(t, label, base, len, i, word) AS (VALUES {",".join(rows)}),
must(t, m) AS (VALUES {",".join(must)}),
need AS (SELECT t, count(*) AS n FROM must GROUP BY t),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM d),
hit AS (
  SELECT p.doc_id, tw.t, p.pos - tw.i AS start, any_value(tw.label) AS label, any_value(tw.base) AS base, any_value(tw.len) AS len, count(*) AS n, count(must.m) AS k
  FROM p JOIN tw ON p.word = tw.word LEFT JOIN must ON must.t = tw.t AND must.m = tw.i GROUP BY p.doc_id, tw.t, p.pos - tw.i),
ok AS (SELECT hit.* FROM hit JOIN need ON need.t = hit.t AND need.n = hit.k WHERE hit.base OR hit.n::DOUBLE / hit.len >= {MATCH}),
per AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(n::DOUBLE / len) AS score
  FROM ok GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN per USING (doc_id)
"""


OP1_SQL = _sql()
