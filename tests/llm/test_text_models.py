import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import queries, segmentation, toxicity


@pytest.fixture(scope="module")
def lattices():
    return segmentation.Lattices(queries.vocabulary("piece_bpe_32k.model"))


def distribution(lat, text):
    """Every segmentation of a text with its probability."""
    s, out = (" " + text).replace(" ", "▁") if text else "", {}

    def walk(i, ids, w):
        if i == len(s):
            out[tuple(ids)] = w
            return
        single = False
        for j in range(i + 1, len(s) + 1):
            p = lat.pieces.get(s[i:j])
            if p:
                single |= j == i + 1
                walk(j, ids + [p[0]], w * math.exp(p[1]))
        if not single:
            code = s[i].encode()
            walk(i + 1, ids + [lat.bytes[c] for c in code], w * math.exp(lat.byte_weight * len(code)))
    walk(0, [], 1.0)
    total = sum(out.values())
    return {k: v / total for k, v in out.items()}


def test_samples_follow_the_distribution(lattices):
    p = distribution(lattices, "the ca")
    n = 6000
    runs = segmentation.segment(lattices, ["the ca"] * n, list(range(n)), 3)
    expected = [Counter(), Counter(), Counter()]
    for a, b, c in itertools.permutations(p, 3):
        w = p[a] * p[b] / (1 - p[a]) * p[c] / (1 - p[a] - p[b])
        for k, x in enumerate((a, b, c)):
            expected[k][x] += w
    for k in range(3):
        got = Counter(tuple(r[k][0].tolist()) for r in runs)
        assert max(abs(got[x] / n - expected[k][x]) for x in p) < 0.025
    for r in runs:
        assert len({tuple(x[0].tolist()) for x in r}) == 3
        assert r[0][2] >= r[1][2] >= r[2][2]
        for ids, log_p, _, _ in r:
            assert abs(math.exp(log_p) - p[tuple(ids.tolist())]) < 1e-9
    # the inclusion scores make an unbiased estimate of the total probability
    assert abs(np.mean([sum(math.exp(x[1] - x[3]) for x in r) for r in runs]) - 1) < 0.05


@pytest.mark.parametrize("text", ["", "a", "\n", "é日 x", "  two  spaces ", "a\n\nb\t", "😀", "日本́"])
def test_all_segmentations_of_small_texts(lattices, text):
    p = distribution(lattices, text)
    got = segmentation.segment(lattices, [text], [5], 5000)[0]
    assert {tuple(x[0].tolist()) for x in got} == set(p)
    assert all(lattices.decode(x[0].tolist()) == text for x in got)


def test_segmentation_rows(edge_docs, no_docs):
    docs = edge_docs.withColumn("ids", F.lit(1)).withColumn("sample", F.lit("x"))
    out = segmentation.sampled(docs, k=3).collect()
    assert all(r["round_trip"] for r in out)
    by = Counter((r["doc_id"], r["sample"]) for r in out)
    assert by[(1, 0)] == by[(1, 2)] == 1 and by[(3, 0)] == 2 and by[(5, 0)] == 1 and by[(5, 1)] == 0
    assert len({bytes(r["ids"]) for r in out if r["doc_id"] == 9}) == 3
    again = segmentation.sampled(edge_docs.repartition(5), k=3).collect()
    assert Counter(map(str, again)) == Counter(map(str, out))
    assert segmentation.sampled(no_docs).count() == 0


def test_encoding_decodes_like_the_library(lattices):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.vocabulary("piece_bpe_32k.model"))
    for t in ("Hello  world\nfoo\t é日本😀", " x ", "plain"):
        for ids, *_ in segmentation.segment(lattices, [t], [1], 4)[0]:
            assert lattices.decode(ids.tolist()) == t == sp.decode(ids.tolist())


def brute_restore(token, model):
    best = None
    for path in itertools.product(*toxicity.readings(token)):
        a = b = 0
        score, text = 0.0, "".join(t for t, _ in path)
        for t, p in [*path, (" ", 0.0)]:
            score += p
            for c in t:
                z = toxicity.symbol(c)
                if z == 0 and b == 0:
                    continue
                score += float(model[a, b, z])
                a, b = b, z
        if best is None or score > best[0] + 1e-9:
            best = (score, {text.strip()})
        elif abs(score - best[0]) <= 1e-9:
            best[1].add(text.strip())
    return best[1]


@pytest.fixture(scope="module")
def labelled(spark):
    import random
    rng = random.Random(1)
    clean = ["garden", "window", "river", "stone", "paper", "yellow", "winter", "music"]
    docs, labels = [], []
    for i in range(600):
        ws = [rng.choice(clean) + rng.choice(["", "s", "ing", "ed"]) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            ws[rng.randrange(40)] = rng.choice(["idiot", "moron", "vequin", "vequor"])
            ws[rng.randrange(40)] = "stupid"
        docs.append((i, " ".join(ws)))
        labels.append((i, int(bad)))
    docs += [(1000, "garden 1d10t river stone"), (1001, "garden s t u p i d river"), (1002, "garden stuuupiiid river"), (1003, "clean river stone 2024"), (1004, None),
             (1005, ""), (1006, "vequest river"), (None, "idiot stupid")]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_restore_against_all_paths(labelled):
    model = toxicity.character_model(labelled[0])
    for token in ("1d10t", "i d i o t", "st.u-pid", "mmoron", "g4rd3n", "7", "a--b", "riiver"):
        assert toxicity.restore(token, model) in brute_restore(token, model)


def test_trigram_counts_do_not_depend_on_blocks(labelled):
    texts = [r["text"] or "" for r in labelled[0].collect()]
    whole = toxicity.trigram_counts(texts)
    assert whole.sum() > 0
    assert (toxicity.trigram_counts(["abc"])[[0 * 4096 + 1 * 64 + 2, 1 * 4096 + 2 * 64 + 3, 2 * 4096 + 3 * 64]] == 1).all()


def test_scores(labelled, spark):
    docs, labels = labelled
    out = toxicity.with_score(docs.withColumn("toxic", F.lit(9)).withColumn("low", F.lit(1)), labels)
    score = {r["doc_id"]: r["__score"] for r in out.collect()}
    assert len(score) == docs.count() and all(0 <= s <= 1 for s in score.values())
    held = {r["doc_id"] for r in docs.filter(toxicity.held_out()).collect()}
    wrong = [i for i in held if i < 600 and (score[i] >= 0.5) != (i % 4 == 0)]
    assert not wrong
    assert all(score[i] >= 0.5 for i in (1000, 1001, 1002, 1006, None)) and all(score[i] < 0.5 for i in (1003, 1004, 1005))
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and 1003 in {r["doc_id"] for r in kept.collect()}


def test_held_out_labels_are_not_read(labelled):
    docs, labels = labelled
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({r["doc_id"]: r["__score"] for r in toxicity.with_score(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_labels_missing_or_one_sided(labelled, no_docs, spark):
    docs, labels = labelled
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    assert {round(r["__score"], 6) for r in toxicity.with_score(docs, none).collect()} == {0.0}
    assert toxicity.with_score(no_docs, labels).count() == 0


def test_share_of_a_word():
    assert toxicity.share([], 0.1) == 0.1
    assert toxicity.share([(40, 8)], 0.1) > 0.75
    # a longer feature that is known to be clean overrules the prefix
    assert toxicity.share([(40, 8), (0, 7)], 0.1) < 0.3
    assert toxicity.share([(5, 0)], 0.1, less=1) < toxicity.share([(5, 0)], 0.1)


def test_lattices_are_built_in_portions(monkeypatch):
    whole, parts = (segmentation.Lattices(queries.vocabulary("piece_bpe_32k.model")) for _ in range(2))
    texts, sizes, add = [f"word{i} néw{i * 7}日 and the rest\n" * 3 for i in range(60)] + ["x" * 500], [], parts.add
    expected = segmentation.segment(whole, texts, list(range(len(texts))))
    monkeypatch.setattr(segmentation, "ADD_CHARS", 200)
    monkeypatch.setattr(parts, "add", lambda chunks: sizes.append((sum(map(len, chunks)), len(chunks))) or add(chunks))
    got = segmentation.segment(parts, texts, list(range(len(texts))))
    assert len(sizes) > 3 and all(size <= 200 or n == 1 for size, n in sizes)
    assert [[(ids.tolist(), p, g) for ids, p, g, _ in r] for r in got] == [[(ids.tolist(), p, g) for ids, p, g, _ in r] for r in expected]


def test_a_texts_samples_leave_more_than_one_path(spark, lattices):
    docs = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "a")], "doc_id long, text string")
    rows = segmentation.sampled(docs).where("doc_id = 1").collect()
    keys = [r["perturbed"] for r in sorted(rows, key=lambda r: r["sample"])]
    assert len({bytes(r["ids"]) for r in rows}) == len(rows) >= 4 and keys == sorted(keys, reverse=True)
