"""Each stage on a small table, against the brute force of its own operator's test."""

import corpus_pipeline as pipeline
from tessera.llm import toxicity
from tessera.llm.common import table

from test_dedup import brute_components, brute_lines
from test_search import brute_hits

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [name for name, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "minhash_dedup", "decontamination", "segmentation"]
    docs = table(spark, SF, "documents")
    columns = docs.columns
    scores = {r["doc_id"]: r["__score"] for r in toxicity.with_score(docs, table(spark, SF, "labels")).collect()}
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    out = pipeline.stage_toxicity(spark, docs, SF).cache()
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    assert out.columns == columns and kept == {i: t for i, t in rows.items() if scores[i] < 0.5}

    out = pipeline.stage_lines(spark, out, SF).cache()
    import hashlib
    expected = {i: h for i, _, _, h in brute_lines(list(kept.items()))}
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    assert out.columns == columns and {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in kept.items()} == expected

    part = brute_components(list(kept.items()))
    out = pipeline.stage_near_duplicates(spark, out, SF).cache()
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    assert out.columns == columns and set(kept) == {i for i, _, c in part if i == c}

    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    hits = brute_hits(list(kept.items()), items)
    out = pipeline.stage_decontamination(spark, out, SF).cache()
    kept = {r["doc_id"]: r["text"] for r in out.collect()}
    assert out.columns == columns and set(kept) == {i for i, _, n, _ in hits if not n}

    last = pipeline.stage_segmentation(spark, out, SF).collect()
    assert {r["doc_id"] for r in last} == set(kept) and all(r["round_trip"] for r in last)
