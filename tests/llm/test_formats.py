import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import html, piecewise, queries, warc, wavelet
from tessera.llm.common import scratch

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(8)
    big = "<p>" + "é日x " * 40_000
    rows = [(3, "http://a/\r\nX: 1", "same"), (1, "http://b", "same"), (2, None, None), (4, "u", ""), (5, "u", big), (6, "u", big), (None, "n", "same"),
            (7, "u", "WARC/1.1\r\n\r\n0\r\n\r\n"), (1, "http://b", "same"), (8, "u", "x" * 70_000)]
    rows += [(100 + i, f"http://c/{i}", f"<p>{rng.random()}" * rng.randrange(2000)) for i in range(20)]
    return spark.createDataFrame(rows, PAGES)


def test_warc_round_trip(spark, pages):
    rows = [(r["page_id"], (r["html"] or "").encode()) for r in pages.collect()]
    first = {}
    for i, p in rows:
        if i is not None:
            first[p] = min(i, first.get(p, i))
    expected = sorted([(i, len(p), warc.payload_digest(p), "response" if i == first.get(p) else "revisit", None if i == first.get(p) else first.get(p))
                       for i, p in rows], key=str)
    path = scratch(spark, "warc-test")
    warc.write(pages.withColumn("first", F.lit(1)).withColumn("sha1", F.lit("clash")), path, file_records=7)
    out = warc.read(spark, path)
    got = sorted([(r["page_id"], r["length"] if r["payload"] is None else len(r["payload"]), r["digest"], r["record_type"], r["refers_to"])
                  for r in out.collect()], key=str)
    assert got == expected
    native = out.filter("payload IS NOT NULL").select("payload", "digest").collect()
    assert all(warc.payload_digest(bytes(r["payload"])) == r["digest"] for r in native)
    assert {bytes(r["payload"]) for r in native} == {p for _, p in rows}


def test_warc_segments_are_checked():
    records = warc.page_records(1, "u", b"abc" * 30_000, "D", None, False, "2024-01-01T00:00:00Z", 10_000)
    parsed = [r for x in records for r in warc.parse(x + warc.RECORD_END)]
    assert len(parsed) > 5 and parsed[0][0][b"warc-type"] == b"response" and parsed[1][0][b"warc-type"] == b"continuation"
    assert parsed[-1][0][b"warc-segment-total-length"] == b"%d" % sum(len(b) for _, b in parsed)
    assert warc.decoded(b"".join(b for _, b in parsed)) == b"abc" * 30_000
    with pytest.raises(ValueError):
        list(warc.parse(records[0][:-3] + warc.RECORD_END))
    for body in (b"", b"x", "é".encode() * 5000):
        assert warc.unchunked(warc.chunked(body, 64)) == body


def test_warc_missing_segment_fails(spark):
    records = warc.page_records(1, "u", b"abc" * 30_000, "D", None, False, "2024-01-01T00:00:00Z", 10_000)
    path = scratch(spark, "warc-cut")
    rows = [(x.decode(),) for n, x in enumerate(records) if n != 2]
    spark.createDataFrame(rows, "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    with pytest.raises(Exception, match="segments"):
        warc.read(spark, path).collect()


def test_warc_empty(spark, pages):
    path = scratch(spark, "warc-none")
    warc.write(pages.limit(0), path)
    assert warc.read(spark, path).count() == 0


def brute_html(page):
    return html.main_text(page)


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p>", ""), ("plain text only", "plain text only"),
    ("<nav>menu</nav><article><h1>T</h1><p>a<b>b</b> c&eacute;<br>d<p>e &amp;&lt;\n f</article><footer>x</footer>", "T ab cé d e &< f"),
    ("<article><p>one<script>var a='</p>';</script> two<aside>no</aside><div class='ad box'>buy</div><p>three</article>", "one two three"),
    ("<article><p>kept<p>cut of<div", "kept cut of"),
    ("<article><p>a</p><section id=comments><p>reader</section></article><p>out", "a"),
    ("<!-- <p>no</p> --><main>x<form>f</form>&#233;&unknown; &am</main>", "x é&unknown; &am"),
    ("<article><p>" + "long " * 20_000 + "</article>", ("long " * 20_000).strip()),
    ("<ul><li><a href=x>Home page of it</a><li><a href=y>Other</a></ul><div><p>" + "Real text of the page. " * 5 + "</div><div>tiny</div><p class=footer>c",
     ("Real text of the page. " * 5).strip() + " tiny"),
])
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_surge_and_dive():
    found = [("x" * 10, False, False, 0)] + [("gap", True, False, 0)] * 3 + [("y" * 50, False, False, 0), ("z" * 5, False, False, 0)] + [("gap", True, False, 0)] * 3
    assert html.kept(found, False) == ["y" * 50, "z" * 5]


def test_extract_keeps_columns(spark, pages):
    docs = pages.withColumn("text", F.lit(1)).withColumn("n_chars", F.lit(2))
    out = html.extract(docs)
    assert out.columns == [*docs.columns, "__main"] and out.count() == docs.count()
    assert html.extract(docs.limit(0)).count() == 0
    r = queries.op2_html_text(spark, "/root/testdata/sf0.001").first()
    assert r["n_chars"] == len(r["text"])


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (700, 3), (5000, 300), (3000, 70_000)):
        x = rng.integers(0, top, n).astype(np.uint16 if top < 65536 else np.uint32)
        docs, ends, m = wavelet.from_bytes(wavelet.to_bytes([5, None], np.array([n // 2, n]), wavelet.WaveletMatrix.build(x)))
        assert docs == [5, None] and ends.tolist() == [n // 2, n] and (m.ids() == x).all()
        for i in range(0, n, 97):
            assert m.access(i) == x[i] and m.rank(int(x[i]), i) == (x[:i] == x[i]).sum()
        if n:
            c = int(x[n // 3])
            assert m.occurrences(c) == np.flatnonzero(x == c).tolist()
        assert m.rank(top + 1) == 0
        with pytest.raises(IndexError):
            m.select(top + 1, 0)


def test_tokens_against_the_library(spark, edge_docs, no_docs):
    from tokenizers import Tokenizer
    path = queries.vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    odd = ["ﬁ İstanbul ǅ Σίσυφος ΣΑΣ naïve x² Ⅷ 日本語 a　b c\x1cd \x85 it's 'S don'T ''s 12ab3 ½ 😀👍 ß ẞ ſ K", "a b c", "é É", "_a_ a_b"]
    docs = spark.createDataFrame([(300 + i, t, None, None, None) for i, t in enumerate(odd)], edge_docs.schema).unionByName(edge_docs.filter("NOT doc_id <=> 3"))
    out = scratch(spark, "tokens-test")
    wavelet.write(docs, out, path, shard_tokens=2000, parts=3)
    got = {r["doc_id"]: r for r in wavelet.read_index(spark, out).filter("doc_id IS NOT NULL").collect()}
    start = sum(len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1 for r in docs.filter("doc_id IS NULL").collect())
    for r in sorted(docs.filter("doc_id IS NOT NULL").collect(), key=lambda r: r["doc_id"]):
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        assert (got[r["doc_id"]]["start"], got[r["doc_id"]]["n_tokens"]) == (start, len(ids)), r["doc_id"]
        assert got[r["doc_id"]]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert wavelet.read_index(spark, out).count() == docs.count()
    out = scratch(spark, "tokens-none")
    wavelet.write(no_docs, out, path)
    assert wavelet.read_index(spark, out).count() == 0


def brute_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_edit_distances():
    rng = random.Random(1)
    letters = piecewise.ALPHABET.tobytes().decode()[:6]
    a, b = (["".join(rng.choice(letters) for _ in range(rng.randrange(65))) for _ in range(200)] for _ in range(2))
    assert piecewise.edit_distances(a, b).tolist() == [brute_distance(x, y) for x, y in zip(a, b)]


def test_fingerprints_are_local_and_bounded():
    rng = random.Random(2)
    text = " ".join(f"w{rng.randrange(9999)}" for _ in range(3000))
    other = " ".join(f"v{rng.randrange(9999)}" for _ in range(3000))
    changed = text[:9000] + "CHANGED" + text[9010:]
    x = piecewise.fingerprints([text, changed, other, "", "a", text])
    assert x == [piecewise.fingerprints([t])[0] for t in (text, changed, other, "", "a", text)]
    assert all(len(p) <= piecewise.LENGTH for f in x for p in f.split(":")[1:])
    near, far, same, empty = piecewise.likeness([x[0], x[0], x[0], x[3]], [x[1], x[2], x[5], x[3]])
    assert x[3] == "0::" and same == empty == 1.0 and near > 0.8 and far < 0.3


def test_neighbours_against_brute_force(edge_docs, no_docs, spark):
    docs = edge_docs.filter("NOT doc_id <=> 3").filter("doc_id IS NOT NULL")
    rows = sorted([(r["doc_id"], r["text"] or "") for r in docs.collect()], reverse=True)
    for parts in (1, 4, 50):
        got = {r["doc_id"]: r for r in piecewise.neighbour_fingerprints(docs.withColumn("part", F.lit("clash")), parts).collect()}
        assert len(got) == len(rows)
        for n, (i, t) in enumerate(rows):
            after = rows[(n + 1) % len(rows)][1]
            e = piecewise.edited(t, after)
            f, g, h = piecewise.fingerprints([t, e, after])
            r = got[i]
            assert (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"]) == (len(t), hashlib.sha256(e.encode()).hexdigest(), f, g)
            assert (r["near_edited"], r["near_next"]) == (piecewise.likeness([f], [g])[0], piecewise.likeness([f], [h])[0])
    assert piecewise.neighbour_fingerprints(edge_docs).count() == edge_docs.count()
    assert piecewise.neighbour_fingerprints(no_docs).count() == 0
    one = piecewise.neighbour_fingerprints(docs.filter("doc_id = 1")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
