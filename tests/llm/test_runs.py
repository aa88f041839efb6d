"""Periodic runs against brute force over all periods and starts."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tessera.llm import queries, runs

SF = "/root/testdata/sf0.001"


def brute(ws):
    """All maximal stretches of every period, from their definition."""
    out, n = [], len(ws)
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if ws[i] != ws[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and ws[j] == ws[j + q]:
                j += 1
            start, length = i, j - i + q
            if length >= max(24, 3 * q) and not any(
                    all(ws[k] == ws[k + r] for k in range(start, start + length - r)) for r in range(1, q)):
                out.append((start, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(rng):
    ws = []
    for _ in range(rng.randrange(1, 6)):
        unit = [rng.choice("abcd") for _ in range(rng.randrange(1, 14))]
        if rng.random() < 0.5:
            unit = unit * rng.randrange(1, 4) + [rng.choice("abcd")]
        ws += (unit * rng.randrange(1, 9))[:rng.randrange(1, 90)]
        ws += [rng.choice("abcdef") for _ in range(rng.randrange(0, 12))]
    return ws


@pytest.mark.parametrize("seed", range(6))
def test_random_texts_match_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        ws = planted(rng)
        if rng.random() < 0.3:
            ws = ws * rng.randrange(2, 5)
        assert runs.find_runs(runs.numbered(ws)) == brute(ws), ws


def test_overlapping_runs_of_different_periods():
    """A run that begins inside of another one, whose lag is no multiple of its period."""
    rng = random.Random(9)
    for q, d in ((20, 30), (25, 26)):
        unit = [f"u{k}" for k in range(q)]
        left = unit * 4
        for overlap in range(16, q + d, 3):
            tail = left[-overlap:]
            block = (tail + [f"v{rng.randrange(99)}" for _ in range(d)])[:d]
            ws = left[:-overlap] + [block[k % d] for k in range(4 * d)]
            assert runs.find_runs(runs.numbered(ws)) == brute(ws)


def test_one_word_many_times_is_linear():
    ws = ["a"] * 300_000
    assert runs.find_runs(runs.numbered(ws)) == [(0, 300_000, 1)]
    ws = ["a", "b"] * 100_000 + ["c"]
    assert runs.find_runs(runs.numbered(ws)) == [(0, 200_000, 2)]


def expected(doc_id, text):
    ws = (text or "").encode().split()
    n, h = len(ws), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[i] if i < a else ws[a + (i - a) % p] for i in range(n)]
    rs = brute(ws)
    drop = {k for s, m, q in rs for k in range(s + q, s + m)}
    best = min(rs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    return (doc_id, len(rs), *best, None if not rs else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in rs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for k, w in enumerate(ws) if k not in drop)).hexdigest())


def test_query_matches_brute_force_on_short_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) < 2500")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(tuple(r) for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect())
    want = sorted(expected(r["doc_id"], r["text"]) for r in docs.collect())
    assert got == want
    assert any(r[1] for r in got)


def test_edge_rows(spark, edge_docs, no_docs, tmp_path):
    edge_docs.withColumn("__runs", edge_docs.doc_id).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    rows = [r for r in edge_docs.collect()]
    short = [r for r in rows if len((r["text"] or "").split()) < 2000]
    want = sorted((expected(r["doc_id"], r["text"]) for r in short), key=str)
    assert [r for r in got if r[0] != 9] == want
    assert next(r for r in got if r[0] == 9)[1:6] == (1, 0, 30_000, 1, 30_000_000)
    assert runs.collapse(no_docs).collect() == []
    kept = runs.collapse(edge_docs.withColumnRenamed("lang", "__collapsed"))
    assert kept.columns == ["doc_id", "text", "source", "n_chars", "__runs", "__collapsed"]
    assert kept.count() == edge_docs.count()


def test_periodic_tail_is_a_run():
    n = 5000
    for doc in range(200):
        order = runs.periodic_tail(doc, n)
        if order is None:
            continue
        h = zlib.crc32(str(doc).encode())
        a, p = h // 10 % n, 1 + (n - h // 10 % n) // (3 + h // 10 % 8)
        if n - a >= max(24, 3 * p):
            assert (a, n - a, p) in [(s, m, q) for s, m, q in runs.find_runs(order)] or a and order[a - 1] == order[a + p - 1]
