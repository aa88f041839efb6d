"""License scans by diagonal voting.

Every rolling word 3-gram hash of every document is a row (document, position,
hash). A Spark join with the templates' 3-grams turns matches into votes for a
diagonal (document position - template position) of a template. Votes are
counted per (document, template, diagonal), with a partial count in each
task; neighbouring diagonals (an inserted or missing word shifts by one) whose
votes follow one another merge into one span; a span with at least ``MIN_SHARE`` of the template's 3-grams is
a candidate. Candidates join the documents again and are verified on the words
themselves: a base phrase must stand there word for word, a longer template
must share ``MIN_WORDS`` of its words in order (longest common subsequence), and have the template's
names and versions ("lesser", "affero", "2") and no other name. Parts of a notice that others' words cut apart
count together.

Words: A-Z lowered, runs of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]. The templates
are a parameter whose size is checked before it is broadcast.

Defined cases: null text is empty; a document without a match has no labels,
n_base 0 and score 0; each row of ``docs`` gives one result row (rows that
repeat a doc_id and text agree, by a row key of both)."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tessera.llm import words

K = 3
MERGE = 2              # diagonals at most so far apart are neighbours
FAR = 8                # spans that follow one another, at most so many words and diagonals apart, may be one notice
MIN_SHARE = 0.5        # of a template's 3-grams
MIN_WORDS = 0.7        # of a template's words, in order
MAX_TEMPLATE_WORDS = 1_000_000

#: Base phrases and their labels.
BASE = [
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
]
#: Usual notices of public licences, for the method's own labels.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "you may not use this file except in compliance with the License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("gpl", "under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program"),
    ("lgpl", "You should have received a copy of the GNU Lesser General Public License along with this library"),
    ("agpl-3", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, version 3"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "either version 3 of the License, or (at your option) any later version"),
    ("gpl-2", "This program is licensed under the GNU General Public License, version 2."),
    ("lgpl", "under the terms of the GNU Lesser General Public License"),
    ("agpl-3", "under the terms of the GNU Affero General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-sa", "Licensed under a Creative Commons Attribution-ShareAlike license"),
    ("cc-by", "Licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0", "dedicated to the public domain under CC0 1.0 Universal"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("epl-2", "made available under the terms of the Eclipse Public License 2.0"),
    ("mit", "SPDX-License-Identifier: MIT"),
    ("apache-2", "SPDX-License-Identifier: Apache-2.0"),
    ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("gpl-2", "SPDX-License-Identifier: GPL-2.0"),
    ("gpl-3", "SPDX-License-Identifier: GPL-3.0"),
    ("mpl-2", "SPDX-License-Identifier: MPL-2.0"),
    ("reserved", "All rights reserved."),
]
#: Words that tell notices of one wording apart. A span has the ones of its template, and of the names no others.
NAMES = {"lesser", "library", "affero", "mit", "apache", "bsd", "gpl", "mpl", "eclipse", "mozilla"}
VERSIONS = {"2", "3", "4", "1"}
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def split(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode().lower())


def _grams(batches):
    for batch in batches:
        text = words.text_array(batch.column("text"))
        ids = batch.column("__row")
        for i, j, h, first in words.rows_words(text, words.ALNUM):
            g, begin = words.grams(h, first, K)
            n = np.diff(begin)
            row = np.repeat(np.arange(i, j), n)
            place = np.arange(len(g)) - np.repeat(begin[:-1], n)
            for s in range(0, len(g), 1 << 18):
                yield pa.record_batch([ids.take(pa.array(row[s:s + (1 << 18)])), pa.array(place[s:s + (1 << 18)], pa.int64()),
                                       pa.array(g[s:s + (1 << 18)].view(np.int64))], ["__row", "place", "gram"])


def template_grams(spark, templates) -> DataFrame:
    """(template, offset, gram): one row per 3-gram of each template."""
    rows, total = [], 0
    for t, (_, text) in enumerate(templates):
        total += len(split(text))
        for _, _, h, first in words.rows_words(pa.array([text]), words.ALNUM):
            g, _ = words.grams(h, first, K)
            rows += [(t, o, int(x)) for o, x in enumerate(g.view(np.int64))]
    if total > MAX_TEMPLATE_WORDS:
        raise ValueError(f"{total} words of templates; at most {MAX_TEMPLATE_WORDS} are broadcast")
    return spark.createDataFrame(rows, "template int, offset long, gram long")


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def _chained(spans: list[list], diagonals: int, gap: int) -> list[list]:
    """Spans [low, high, first diagonal, last diagonal, votes, parts] joined to the latest one that ends at most ``gap``
    words before and whose last diagonal is within ``diagonals``. A span out of reach stays out of reach, so
    only those that are still in reach are looked at, however many that are."""
    out, near = [], []
    for s in sorted(spans, key=lambda s: (s[0], s[2])):
        near = [r for r in near if s[0] - r[1] <= gap]
        before = next((r for r in reversed(near) if abs(r[3] - s[2]) <= diagonals and s[0] > r[1]), None)
        if before is None:
            out.append(list(s))
            near.append(out[-1])
        else:
            before[1], before[3], before[4], before[5] = max(before[1], s[1]), s[3], before[4] + s[4], before[5] + s[5]
    return out


def merged(votes: list[dict], sizes: list[int]) -> list[tuple[int, int, int]]:
    """Spans (template, first word, past-last word) from one document's votes
    {template, diagonal, low, high, n}: low and high are the document positions
    of the first and last vote. Votes of neighbouring diagonals make a span; where one is too small by itself,
    it counts together with those that follow it, and the words decide."""
    out = set()
    by: dict[int, list] = {}
    for v in votes:
        by.setdefault(v["template"], []).append([v["low"], v["high"], v["diagonal"], v["diagonal"], v["n"], 1])
    for t, group in by.items():
        spans = _chained(group, MERGE, K + MERGE)
        least = MIN_SHARE * max(sizes[t] - K + 1, 1)
        out |= {(t, s[0], s[1] + K) for s in spans if s[4] >= least}
        small = [[*s[:5], 1] for s in spans if s[4] < least]
        out |= {(t, s[0], s[1] + K) for s in _chained(small, FAR, K + FAR) if s[4] >= least and s[5] > 1}
    return sorted(out)


def told_apart(template: list[str], span: list[str]) -> bool:
    """Whether a span has the names and versions of the template, and no other name."""
    want, have = set(template), set(span)
    return want & (NAMES | VERSIONS) <= have and have & NAMES <= want


def _verifier(templates, n_base):
    split_templates = [split(t) for _, t in templates]
    sizes = [len(t) for t in split_templates]

    def run(batches):
        for batch in batches:
            out = []
            for text, votes in zip(batch.column("text").to_pylist(), batch.column("votes").to_pylist()):
                ws = split(text)
                places, base, labels, spans, best = set(), set(), set(), [], 0.0
                likely = []
                for t, low, high in merged([v for v in votes if v["template"] >= n_base], sizes):
                    n = lcs(split_templates[t], ws[max(0, low - MERGE):high + MERGE]) / sizes[t]
                    if n >= MIN_WORDS and told_apart(split_templates[t], ws[max(0, low - 1):high + MERGE]):
                        likely.append((n, t, low, high))
                taken = []
                for n, t, low, high in sorted(likely, key=lambda x: (-x[0], x[2], x[1])):
                    # of templates that claim the same words, the likest one has them
                    if any(a < high and low < b and m > n for m, a, b in taken):
                        continue
                    taken.append((n, low, high))
                    labels.add(templates[t][0])
                    spans.append({"label": templates[t][0], "start": low, "n_words": high - low})
                    best = max(best, n)
                for v in votes:
                    if v["template"] < n_base:
                        phrase, start = split_templates[v["template"]], v["diagonal"]
                        if start >= 0 and ws[start:start + len(phrase)] == phrase:
                            places.add((start, v["template"]))
                            base.add(templates[v["template"]][0])
                if base:
                    best = 1.0
                starts = [p for p, _ in places]
                out.append({"n_base": len(places), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
                            "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | labels)), "score": best, "spans": spans})
            kind = pa.struct([("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
                              ("labels", pa.string()), ("score", pa.float64()),
                              ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("n_words", pa.int64())])))])
            yield pa.record_batch([batch.column("__row"), pa.array(out, kind)], ["__row", "found"])
    return run


def _counts(batches):
    for batch in batches:
        text, n = words.text_array(batch.column("text")), []
        data, offsets = words.raw(text)
        for i, j in words.blocks(offsets):
            _, _, first = words.spans(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], words.ALNUM)
            n += np.diff(first).tolist()
        yield pa.RecordBatch.from_arrays([*batch.drop_columns(["text"]).columns, pa.array(n, pa.int64())],
                                         [*batch.drop_columns(["text"]).schema.names, "n_words"])


def scan(docs: DataFrame, base=BASE, templates=TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, spans) for each row of (doc_id, text)."""
    spark = docs.sparkSession
    words.small_batches(spark)
    every = [*base, *templates]
    if any(len(split(t)) < K for _, t in base):
        raise ValueError(f"a base phrase has at least {K} words")
    keyed = docs.select("doc_id", "text").withColumn("__row", F.concat_ws("|", F.col("doc_id").cast("string"), F.md5("text")))
    grams = keyed.select("__row", "text").mapInArrow(_grams, "__row string, place long, gram long")
    matches = grams.join(F.broadcast(template_grams(spark, every)), "gram")
    votes = (matches.groupBy("__row", "template", (F.col("place") - F.col("offset")).alias("diagonal"))
             .agg(F.min("place").alias("low"), F.max("place").alias("high"), F.count("*").alias("n"))
             .groupBy("__row").agg(F.collect_list(F.struct("template", "diagonal", "low", "high", "n")).alias("votes")))
    found = keyed.join(votes, "__row").dropDuplicates(["__row"]).select("__row", "text", "votes").mapInArrow(
        _verifier(every, len(base)),
        "__row string, found struct<n_base:long,first_word:long,last_word:long,base_labels:string,labels:string,score:double,"
        "spans:array<struct<label:string,start:long,n_words:long>>>")
    counted = keyed.select("doc_id", "__row", "text").mapInArrow(
        _counts, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, __row string, n_words long")
    return counted.join(found, "__row", "left").select(
        "doc_id", "n_words", F.coalesce("found.n_base", F.lit(0).cast("long")).alias("n_base"), "found.first_word", "found.last_word",
        F.coalesce("found.base_labels", F.lit("")).alias("base_labels"), F.coalesce("found.labels", F.lit("")).alias("labels"),
        F.coalesce("found.score", F.lit(0.0)).alias("score"), F.col("found.spans").alias("spans"))
