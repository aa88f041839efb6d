"""Hard negatives and embedding near-duplicates against brute force."""

import random

import duckdb
import numpy as np
import pytest

from tessera.llm import bond, hnsw, queries

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def edge_vectors(spark):
    """Nulls, non-finite parts, zero and empty vectors, other lengths, ties, repeated rows and ids."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 16))
    rows = []
    for i in range(700):
        c = centres[rng.integers(6)] if rng.random() < 0.7 else rng.normal(size=16)
        v = c + rng.normal(size=16) * rng.choice([0.02, 0.2, 0.5])
        rows.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], int(rng.integers(3))))
    rows += [(r[0] + 1000, r[1], r[2]) for r in rows[:60]]                  # copies
    rows += rows[:10] + [(50, rows[3][1], 1), (50, rows[4][1], None)]       # repeated rows, a repeated id
    one = rows[0][1]
    rows += [(2000, None, 1), (2050, [None] + one[1:], 1), (2051, [float("nan")] + one[1:], 1), (2052, [float("inf")] + one[1:], 1),
             (2053, [0.0] * 16, 1), (2100, [], 1), (2101, [], 1), (2102, [], 2), (2150, one[:8], 1), (2151, one[:8], 2),
             (None, one, 1), (2103, [x * 3 for x in one], 1), (2104, [-x for x in one], 1), (None, None, None)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def saved(df, path):
    df.write.parquet(f"{path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet/*.parquet'")
    return con


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def sql_rows(con, sql, columns):
    return sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall(), key=str)


def test_hard_negatives_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = queries.op11_hard_negatives(spark, SF)
    want = sql_rows(con, queries.OP11_SQL, got.columns)
    assert rows_of(got) == want and want


def test_hard_negatives_on_edge_rows(spark, edge_vectors, tmp_path, monkeypatch):
    con = saved(edge_vectors.withColumn("id", edge_vectors.label).withColumn("rid", edge_vectors.vec_id), tmp_path)
    monkeypatch.setattr(bond, "LEAST_ROWS", 150)
    got = queries.op11_hard_negatives(spark, str(tmp_path))
    want = sql_rows(con, queries.OP11_SQL, got.columns)
    assert rows_of(got) == want and len(want) > 50


@pytest.mark.parametrize("factor,kind", [(1, "float32"), (2 ** 14, "float64"), (2 ** 20, "int64")])
def test_hard_negatives_are_exact_at_any_size(spark, tmp_path, factor, kind):
    rng = np.random.default_rng(2)
    v = rng.integers(-400, 401, (300, 8)) + np.array([300, 0, 0, 0, 0, 0, 0, 0])
    rows = [(i, [int(x) * factor for x in v[i]], int(rng.integers(4))) for i in range(300)]
    df = spark.createDataFrame([(i, l, q) for i, q, l in rows], "id long, label long, vector array<long>")
    got = {(r["anchor_id"], r["positive_rank"], r["rank"]): (r["positive_id"], r["negative_id"], r["positive_score"], r["negative_score"])
           for r in bond.hard_negatives(df, df.id % 10 == 0, group_bytes=8 * 8 * 64).collect()}
    want = {}
    for i, q, l in rows[::10]:
        scored = sorted(((-sum(a * b for a, b in zip(q, p)), j, k) for j, p, k in rows if j != i))
        for pr, (ps, pid, _) in enumerate([s for s in scored if s[2] == l][:5], 1):
            inside = [s for s in scored if s[2] != l and -50 * ps <= -100 * s[0] <= -95 * ps]
            for r, (ns, nid, _) in enumerate(inside[:3], 1):
                want[i, pr, r] = (pid, nid, -ps, -ns)
    assert got == want and want


def test_no_vectors(spark, tmp_path):
    saved(spark.createDataFrame([], SCHEMA), tmp_path)
    assert queries.op11_hard_negatives(spark, str(tmp_path)).collect() == []


def test_scores_that_cannot_fit_are_an_error(spark):
    df = spark.createDataFrame([(0, 1, [2 ** 31])], "id long, label long, vector array<long>")
    with pytest.raises(ValueError):
        bond.hard_negatives(df, df.id == 0)


def test_vector_groups_match_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    got = queries.op12_vector_groups(spark, SF)
    assert rows_of(got) == sql_rows(con, queries.OP12_SQL, got.columns)


def test_vector_groups_on_edge_rows(spark, edge_vectors, tmp_path, monkeypatch):
    """Several shards a class, near copies around the threshold, all odd rows."""
    con = saved(edge_vectors.withColumn("id", edge_vectors.label).withColumn("component", edge_vectors.vec_id), tmp_path)
    monkeypatch.setattr(hnsw, "SHARDS", 8)
    got = hnsw.near_duplicates(spark.read.parquet(f"{tmp_path}/embeddings.parquet"), least_rows=40)
    want = sql_rows(con, queries.OP12_SQL, got.columns)
    assert rows_of(got) == want
    assert max(r[1] for r in want) > 20 and not all(r[3] for r in want)


def test_vector_groups_of_no_rows(spark, tmp_path):
    saved(spark.createDataFrame([], SCHEMA), tmp_path)
    assert queries.op12_vector_groups(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("spread", [0.05, 0.2, 0.3, 0.38])
def test_graph_recall_and_counts_against_brute_force(spread):
    """Chains of vectors whose cosines lie on both sides of the threshold, searched in two shards."""
    rng = np.random.default_rng(int(spread * 100))
    centres = rng.normal(size=(60, 32)) / np.sqrt(32)
    raw = (centres[rng.integers(60, size=3000)] + rng.normal(size=(3000, 32)) * spread / np.sqrt(32)).astype(np.float32)
    x, rid, weight = hnsw.unit(raw), np.arange(3000), rng.integers(1, 4, 3000)
    wanted = (((x @ x.T) >= 0.93) * weight).sum(axis=1)
    counted = np.zeros(3000, np.int64)
    for rows in (rid[:1500], rid[1500:]):
        graph, node_row, node, angle = hnsw.build(rows, x[rows], np.arccos(0.93) / 2 - 1e-6)
        assert angle.max() <= np.arccos(0.93) / 2 and (node >= 0).all()
        layers = {f"layer{k}": v[:graph.count] for k, v in enumerate(graph.layers)}
        shard = hnsw.Shard(hnsw.packed(raw=raw[rows], weight=weight[rows], rid=rows, node_row=node_row, node=node, angle=angle,
                                       entry=np.int64(graph.entry), layers=np.int64(len(layers)), **layers), 0.93)
        counted += shard.links(x, None)[0]
    assert (counted <= wanted).all()                    # none below the threshold
    assert counted.sum() >= 0.995 * wanted.sum()


def test_audit_widens_a_beam_that_misses(monkeypatch):
    """A graph whose lists are cut: audits end in a comparison with all nodes, nothing is lost."""
    rng = np.random.default_rng(4)
    raw = rng.normal(size=(800, 8)).astype(np.float32)
    x = hnsw.unit(raw)
    graph, node_row, node, angle = hnsw.build(np.arange(800), x, np.arccos(0.93) / 2 - 1e-6)
    layers = {f"layer{k}": np.full_like(v[:graph.count], -1) for k, v in enumerate(graph.layers)}
    shard = hnsw.Shard(hnsw.packed(raw=raw, weight=np.ones(800, np.int64), rid=np.arange(800), node_row=node_row, node=node, angle=angle,
                                   entry=np.int64(graph.entry), layers=np.int64(len(layers)), **layers), 0.93)
    assert (shard.links(x, node)[0] == ((x @ x.T) >= 0.93).sum(axis=1)).all()
    assert shard.width >= graph.count
