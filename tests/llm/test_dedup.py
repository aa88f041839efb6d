import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import lines, minhash, words

SPACE = r"[^\x20\x09-\x0D]+"
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text):
    ws = re.findall(SPACE, (text or "").translate(LOWER))
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set()


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for n, (a, s) in enumerate(sets):
        for b, t in sets[:n]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {(i, len(s), None if i is None else find(i)) for i, s in sets}


def result(df):
    return {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_words_agree_with_the_pattern():
    texts = ["", "Ab c d", " x\ty\x0bz ", "日本 é", "A" * 5000, "a\x1fb"]
    for marks, pattern in ((words.NON_SPACE, SPACE), (words.ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        known = {}
        got = []
        for i, j, h, first in words.rows_words(pa.array(texts), marks, max_bytes=16):
            got += [h[first[r]:first[r + 1]].tolist() for r in range(j - i)]
        for t, hs in zip(texts, got):
            ws = re.findall(pattern, t.translate(LOWER))
            assert len(ws) == len(hs)
            for w, x in zip(ws, hs):
                assert known.setdefault(w, x) == x
        assert len(set(known.values())) == len(known)


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    sets = [pool[:1], pool[:7], pool[:1000], pool[200:1200], pool[:0]]
    s = minhash.sketch(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])]))
    assert (s[:4] != minhash._EMPTY).all() and (s[4] == minhash._EMPTY).all()
    assert abs((s[2] == s[3]).mean() - 800 / 1200) < 0.15


def test_near_duplicates_edge_rows(edge_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    out = minhash.near_duplicates(edge_docs)
    assert result(out) == brute_components(rows)
    assert out.count() == len(rows)
    kept = minhash.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {None, 1, 4, 5, 6, 7, 9, 10, 11, 12, 13}


def test_near_duplicates_chains_against_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for family in range(6):
        text = [f"w{rng.randrange(500)}" for _ in range(60)]
        for _ in range(12):
            text = list(text)
            for _ in range(rng.choice([0, 1, 1, 2])):
                text[rng.randrange(len(text))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows) * 7 % 101, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(minhash.near_duplicates(df)) == brute_components(rows)


def test_near_duplicates_empty(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0


def brute_lines(rows):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    first, holders = {}, {}
    for i, t in rows:
        if i is not None:
            for x in (t or "").split("\n"):
                if len(key(x)) >= 10:
                    holders.setdefault(key(x), set()).add(i)
    out = []
    for i, t in rows:
        ls = (t or "").split("\n")
        kept = [x for x in ls if i is None or len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == i]
        out.append((i, len(ls), len(ls) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("max_bits", [lines.MAX_BITS, 1])
def test_lines_against_brute_force(edge_docs, max_bits):
    docs = edge_docs.withColumn("n_lines", F.lit("clash")).withColumn("drop", F.lit(1)).withColumn("first", F.lit(2))
    out = lines.dedup_lines(docs, max_bits=max_bits)
    got = sorted([(r["doc_id"], r["__lines"], r["__dropped"], hashlib.sha256(r["__kept"].encode()).hexdigest()) for r in out.collect()], key=str)
    assert got == brute_lines([(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    assert out.columns[:len(docs.columns)] == docs.columns


def test_saturated_filter_gives_the_same(spark):
    rng = random.Random(5)
    rows = [(i, "\n".join(f"line number {rng.randrange(300)} of text" for _ in range(40))) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_lines(rows)
    seen = lines.repeat_filter(df, 2000)
    assert seen is not None and sum(map(len, seen[1].values())) < 200_000
    old, lines.SATURATED = lines.SATURATED, 1e9          # takes all lines as suspects
    try:
        assert lines.repeat_filter(df, 2000) is None
        got = sorted([(r["doc_id"], r["__lines"], r["__dropped"], hashlib.sha256(r["__kept"].encode()).hexdigest())
                      for r in lines.dedup_lines(df).collect()], key=str)
    finally:
        lines.SATURATED = old
    assert got == expected


def test_line_stage_columns(edge_docs, no_docs):
    out = lines.dedup_documents(edge_docs)
    assert out.columns == edge_docs.columns and out.schema["n_chars"].dataType == edge_docs.schema["n_chars"].dataType
    rows = {(r["doc_id"], r["text"], r["n_chars"]) for r in out.filter("doc_id IN (4, 13)").collect()}
    assert rows == {(4, None, None), (13, "other words follow", 18)}
    assert lines.dedup_documents(no_docs).count() == 0


def test_blocks_of_a_bucket(spark, monkeypatch):
    """A large family around one text, some members too far from the others, dealt over several blocks."""
    rng = random.Random(21)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(90):
        text = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4])):
            text[rng.randrange(80)] = f"n{rng.randrange(10**6)}"
        rows.append((500 - i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(minhash, "CELL", 700)
    assert result(minhash.near_duplicates(df)) == brute_components(rows)


def test_cross_links():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, 50)).astype(np.uint64) for _ in range(40)]
    parts = [int(x) for x in rng.integers(0, 12, 40)]

    def classes(links):
        root = {p: p for p in parts}
        for _ in parts:
            for a, b in links:
                root[a] = root[b] = min(root[a], root[b])
        return root
    expected = [(parts[i], parts[j]) for i in range(40) for j in range(i)
                if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))]
    assert classes(minhash.cross_links(parts, sets, [0] * 40)) == classes(expected)
    for s in sets:
        assert (minhash.unpack(minhash.pack(s)) == s).all()


@pytest.mark.parametrize("seed", range(30))
def test_cross_links_of_two_sides_and_any_sizes(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(2, 40))
    base = [rng.integers(0, 60, rng.integers(1, 25)) for _ in range(4)]
    sets = []
    for _ in range(n):
        x = base[rng.integers(4)].copy()
        k = rng.integers(0, len(x) // 3 + 1)
        x[rng.integers(0, len(x), k)] = rng.integers(0, 1000, k)
        sets.append(np.unique(x.astype(np.uint64)))
    parts, side = rng.integers(0, n, n).tolist(), (rng.integers(0, 2, n) * (seed % 2)).tolist()
    two = len(set(side)) > 1
    expected = {(parts[i], parts[j]) for i in range(n) for j in range(n)
                if parts[i] != parts[j] and (not two or side[i] != side[j])
                and 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))}
    got = minhash.cross_links(parts, sets, side)
    assert set(got) <= expected

    def classes(links):
        up = {p: p for p in parts}
        for a, b in links:
            x, y = sorted((up[a], up[b]))
            up = {p: x if c == y else c for p, c in up.items()}
        return up
    assert classes(got) == classes(expected)


def test_cross_links_of_many_short_sets_are_not_all_pairs():
    """100,000 sets of one common and one own shingle: nothing to compare."""
    sets = [np.array([7, 10 ** 6 + i], np.uint64) for i in range(100_000)]
    assert minhash.cross_links(list(range(100_000)), sets, [0] * 100_000) == []
