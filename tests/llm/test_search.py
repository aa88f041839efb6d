import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import licenses, queries, suffixes

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = {i: i + 32 for i in range(65, 91)}


def split(t):
    return re.findall(WORD, (t or "").translate(LOWER))


def brute_hits(rows, items, window=10):
    out = []
    for i, t in rows:
        ws = split(t)
        hit, found = set(), set()
        for item, text in items:
            b = split(text)
            m = min(len(b), window)
            for s in range(len(b) - m + 1 if b else 0):
                for p in range(len(ws) - m + 1):
                    if ws[p:p + m] == b[s:s + m]:
                        hit |= set(range(p, p + m))
                        if item is not None:
                            found.add(item)
        out.append((i, len(ws), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def got_hits(df):
    return sorted([(r["doc_id"], r["__hit"]["n_words"], r["n_hit"], tuple(r["__hit"]["items"]))
                   for r in df.withColumn("n_hit", suffixes.hit_words()).collect()], key=str)


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"b{rng.randrange(40)}" for _ in range(25))) for i in range(8)]
    return spark.createDataFrame(rows + [(20, "short item"), (21, "..."), (22, None), (None, "null id item"), (5, "again five words here now"), (23, "x")],
                                 "item_id long, text string")


@pytest.fixture(scope="module")
def passages(spark, items, edge_docs):
    rng = random.Random(4)
    texts = [r["text"] for r in items.collect() if r["text"]]
    rows = []
    for i in range(40):
        parts = []
        for _ in range(4):
            b = split(rng.choice(texts))
            s = rng.randrange(max(1, len(b)))
            parts += b[s:s + rng.randrange(1, 20)] + [f"f{rng.randrange(99)}" for _ in range(rng.randrange(3))]
        rows.append((100 + i, " ".join(parts).upper() if i % 3 else ", ".join(parts), None, None, None))
    extra = spark.createDataFrame(rows, edge_docs.schema)
    return extra.unionByName(edge_docs.filter("doc_id IS NULL OR doc_id NOT IN (9, 10)"))


def test_hits_against_brute_force(passages, items):
    expected = brute_hits([(r["doc_id"], r["text"]) for r in passages.collect()], [tuple(r) for r in items.collect()])
    docs = passages.withColumn("items", F.lit("clash")).withColumn("n_words", F.lit(1))
    out = suffixes.with_hits(docs, items)
    assert got_hits(out) == expected
    assert out.columns == [*docs.columns, "__hit"]
    # several blocks of items give the same
    assert got_hits(suffixes.with_hits(docs, items, item_bytes=200)) == expected
    clean = {r["doc_id"] for r in suffixes.decontaminate(passages, items).collect()}
    assert clean == {i for i, _, n, _ in expected if not n}


def test_longest_matches(spark):
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30)))], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x y " + " ".join(f"w{i}" for i in range(4, 26)) + " z"), (2, "nothing")], "doc_id long, text string")
    rows = {r["doc_id"]: r["__hit"]["matches"] for r in suffixes.with_hits(docs, items).collect()}
    assert [tuple(m) for m in rows[1]] == [(1, 4, 2, 22)] and rows[2] == []


def test_long_documents(edge_docs, spark):
    items = spark.createDataFrame([(1, "word " * 12)], "item_id long, text string")
    r = suffixes.with_hits(edge_docs.filter("doc_id = 9"), items).withColumn("n_hit", suffixes.hit_words()).first()
    assert r["n_hit"] == r["__hit"]["n_words"] == 30_000


def test_empty_tables(no_docs, edge_docs, items):
    assert suffixes.with_hits(no_docs, items).count() == 0
    out = suffixes.with_hits(edge_docs, items.limit(0))
    assert {(r["n_hit"], r["n"]) for r in out.select(suffixes.hit_words().alias("n_hit"), F.size("__hit.items").alias("n")).collect()} == {(0, 0)}


def brute_base(text):
    ws = split(text)
    places = [(p, label) for label, phrase in licenses.BASE for p in range(len(ws)) if ws[p:p + len(split(phrase))] == split(phrase)]
    starts = [p for p, _ in places]
    return len(ws), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_licenses(spark, edge_docs, no_docs):
    texts = ["Released under the MIT License. under the mit license", "apache license, version 2 CC-BY-NC 4.0 cc by nc",
             "This work is licensed under the GNU General Public License, version 3.",
             "This work is licensed right under the GNU General Public License of version 3.", "under the mit\nlicense " * 500, "the license of version"]
    rows = [(200 + i, t, None, None, None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, edge_docs.schema).unionByName(edge_docs).withColumn("votes", F.lit(1)).withColumn("labels", F.lit("x"))
    out = licenses.scan(docs).collect()
    got = sorted([(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in out], key=str)
    assert got == sorted([(r["doc_id"], *brute_base(r["text"])) for r in docs.collect()], key=str)
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in out}
    assert labels[202] == ("gpl-3", 1.0)
    assert labels[203][0] == "gpl-3" and 0.7 <= labels[203][1] < 1
    assert labels[200] == ("mit", 1.0) and labels[205] == ("", 0.0)
    assert licenses.scan(no_docs).count() == 0


@pytest.mark.parametrize("name", ["op1_minhash_dedup", "op3_line_dedup", "op7_decontamination", "op9_warc"])
def test_queries_against_sql(spark, name):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    expected = con.sql(queries.ORACLES[name])
    columns = sorted(df.columns)
    assert columns == sorted(expected.columns)
    assert sorted(map(tuple, df.select(columns).collect()), key=str) == sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES[name]})").fetchall(), key=str)


def test_digest_of_items(spark):
    df = queries.op7_decontamination(spark, "/root/testdata/sf0.001")
    r = df.filter("n_items > 1").first() or df.first()
    assert len(r["items_sha256"]) == len(hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("window", [3, 18, 19, 25, 40])
def test_windows_of_any_length(spark, window):
    """Texts of few words, so that suffixes agree on many more words than a window."""
    rng = random.Random(window)
    texts = [" ".join(rng.choice("ab") * rng.choice([1, 1, 3]) for _ in range(120)) for _ in range(6)]
    items = [(i, " ".join(split(rng.choice(texts))[s:s + window + 6])) for i, s in enumerate(range(0, 60, 7))]
    got = suffixes.with_hits(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=window)
    assert got_hits(got) == brute_hits(list(enumerate(texts)), items, window)


def test_longest_match_of_the_query(spark, tmp_path, passages, items):
    passages.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    df = queries.op7_decontamination(spark, str(tmp_path))
    got = sorted([tuple(r) for r in df.select("doc_id", "n_words", "longest_words", "longest_start").collect()], key=str)
    assert got == sorted(con.sql(f"SELECT doc_id, n_words, longest_words, longest_start FROM ({queries.OP7_SQL})").fetchall(), key=str)
    assert max(r[2] for r in got) > 12


def brute_spans(ws, templates):
    """Labels whose template stands word for word."""
    return {label for label, text in templates if any(ws[p:p + len(split(text))] == split(text) for p in range(len(ws)))}


def test_notices_are_told_apart(spark):
    cases = [("free software under the terms of the GNU General Public License as published by the Free Software Foundation; either", {"gpl"}),
             ("it under the terms of the GNU Lesser General Public License as published", {"lgpl"}),
             ("This program is licensed under the GNU General Public License, version 2.", {"gpl-2"}),
             ("This work is licensed under the GNU General Public License, version 3.", {"gpl-3"}),
             ("licensed under the terms of the GNU Affero General Public License, version 3", {"agpl-3"}),
             ("Permission is hereby granted, free of charge, to any person (and to any robot) obtaining a copy of this software and associated documentation files", {"mit"}),
             ("// SPDX-License-Identifier: Apache-2.0", {"apache-2"}), ("SPDX-License-Identifier: GPL-2.0", {"gpl-2"}),
             ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", {"isc"}),
             ("the general public may licence this work", set())]
    rows = [(i, t) for i, (t, _) in enumerate(cases)]
    got = {r["doc_id"]: set(filter(None, r["labels"].split(","))) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}


def test_every_template_word_for_word(spark):
    rng = random.Random(7)
    rows = []
    for i, (_, text) in enumerate(licenses.TEMPLATES):
        noise = [f"n{rng.randrange(30)}" for _ in range(60)]
        rows.append((i, " ".join(noise[:30] + text.split() + noise[30:])))
    out = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, text) in enumerate(licenses.TEMPLATES):
        assert label in out[i]["labels"].split(",") and out[i]["score"] == 1.0, text
        assert set(out[i]["labels"].split(",")) >= {label} and any(s["start"] == 30 for s in out[i]["spans"]), text


def test_noise_votes_do_not_hide_a_span():
    votes = [{"template": 0, "diagonal": 100, "low": 100, "high": 109, "n": 10}]
    votes += [{"template": 0, "diagonal": 300 + 9 * k, "low": 110 + k % 3, "high": 110 + k % 3, "n": 1} for k in range(30)]
    votes += [{"template": 0, "diagonal": 101, "low": 113, "high": 122, "n": 10}]
    assert (0, 100, 125) in licenses.merged(votes, [40])
