import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import toxicity

CASES = ["i d ! o t", "s t u p ! d", "s t u p i d !", "$ t u p i d", "s  t  u  p  i  d", "i / d / i / o / t", "stu pid", "id iot", "mo ron", "s.t.u p.i.d", "s | t | u | p | i | d", "s--t--u--p--i--d",
         "1 d 1 0 t", "s t u\np i d.", "(s) (t) (u) (p) (i) (d)", "v e q"]


@pytest.fixture(scope="module")
def spread(spark):
    rng = random.Random(2)
    clean = ["garden", "window", "river", "stone", "paper", "yellow", "winter", "music", "the", "of", "it", "is", "in", "a", "an", "to", "on", "not", "for", "see"]
    docs, labels = [], []
    for i in range(800):
        ws = [rng.choice(clean) for _ in range(60)]
        if i % 4 == 0:
            ws[rng.randrange(60)] = rng.choice(["idiot", "moron", "stupid", "veq"])
            ws[rng.randrange(60)] = rng.choice(["idiot", "moron", "stupid", "veq"])
        docs.append((i, " ".join(ws)))
        labels.append((i, int(i % 4 == 0)))
    docs += [(1000 + n, f"garden river {c} window stone") for n, c in enumerate(CASES)]
    docs += [(2000, "it is not in the garden for a stone to see on an 1 2 3 river"), (2001, "see the / of - it . is a")]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_spread_and_broken_words_are_found(spread):
    score = {r["doc_id"]: r["__score"] for r in toxicity.with_score(*spread).filter("doc_id >= 1000").collect()}
    assert [c for n, c in enumerate(CASES) if score[1000 + n] < 0.5] == []
    assert score[2000] < 0.5 and score[2001] < 0.5


def test_cut_runs_decode_as_whole_ones(spread):
    model = toxicity.character_model(spread[0])
    read, rng = toxicity._reader(model), random.Random(5)
    parts = ["it", "is", "the", "stu", "pid", "id", "iot", "a", "i", "see", "mor", "on", "!", "riv", "er", "1", "all"]
    for _ in range(400):
        text = " ".join(rng.choice(parts) for _ in range(rng.randrange(2, 9)))
        whole = {w for t in toxicity.tokens(text) for w in toxicity.sources(t, model)}
        assert {w for t in read(text) for w in toxicity.sources(t, model)} == whole, text


def test_words_of_letters_are_not_read_as_parts(monkeypatch):
    asked, part = [], toxicity._part
    monkeypatch.setattr(toxicity, "_part", lambda token: asked.append(token) or part(token))
    read = toxicity._reader(np.zeros((64, 64, 64), np.float32))
    assert read("Garden river, of st u pid window garden") == {"garden", "river", "of", "st", "u", "pid", "window", "of st u pid"}
    assert sorted(asked) == ["of", "pid", "river,", "st", "u"]


def test_a_task_sends_each_feature_once(monkeypatch):
    monkeypatch.setattr(toxicity, "FLUSH_FEATURES", 3)
    shared = type("Shared", (), {"value": np.zeros((64, 64, 64), np.float32)})
    batch = pa.record_batch([pa.array(["garden river stone", "garden window", None]), pa.array([1, 0, 1], pa.int32())], ["text", "toxic"])
    rows = [r for b in toxicity._evidence(shared)(iter([batch, batch])) for r in b.to_pylist()]
    assert len(rows) == len({r["feature"] for r in rows}) > 3
    of = {r["feature"]: (r["toxic"], r["clean"]) for r in rows}
    assert (of[toxicity.word_feature("garden")], of[toxicity.word_feature("stone")], of[toxicity.word_feature("window")]) == ((2, 2), (2, 0), (0, 2))
