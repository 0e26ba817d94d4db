"""Operators 4 and 10 against brute force."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslake.llm import ann, sharding

SF = "/root/testdata/sf0.01"


def brute(rows, k=5):
    """{query: [(id, cosine), ...]} by definition."""
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and len(v) and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    good = list({(i, tuple(v)): (i, v) for i, v in good}.values())
    out = {}
    for i, v in good:
        if i % 50 == 0:
            near = [(float(np.dot(v / np.linalg.norm(v), w / np.linalg.norm(w))), j) for j, w in good if j != i and len(w) == len(v)]
            out[i] = [(j, c) for c, j in sorted(near, key=lambda x: (-round(x[0], 12), x[1]))[:k]]
    return out


@pytest.mark.parametrize("shard_rows", [100, 8192])
def test_recall(spark, shard_rows):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    got = ann.nearest(rows, rows.where("id % 50 = 0"), shard_rows=shard_rows).collect()
    want = brute([tuple(r) for r in rows.collect()])
    by = defaultdict(dict)
    for r in got:
        by[r.query_id][r.rank] = (r.vec_id, r.score)
    assert set(by) == set(want) and all(sorted(v) == [1, 2, 3, 4, 5] for v in by.values())
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in by[q].values()}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    for q in want:
        exact = dict(brute([tuple(r) for r in rows.collect()], k=10**6)[q]) if q == 0 else {}
        assert all(abs(exact[i] - s) < 1e-12 for i, s in by[q].values() if i in exact)
        assert [s for _, s in (by[q][k] for k in range(1, 6))] == sorted((s for _, s in by[q].values()), reverse=True)


def test_graph_shape():
    rng = np.random.default_rng(0)
    x = ann.unit(rng.normal(size=(700, 12))).astype(np.float32)
    graph, start = ann.build_graph(x, degree=8, slack=12, beam=24, batch=50)
    assert graph.shape == (700, 12)
    for i, row in enumerate(graph):
        near = row[row >= 0]
        assert len(near) and i not in near and len(set(near.tolist())) == len(near)
    seen, todo = {start}, [start]
    while todo:
        for j in graph[todo.pop()]:
            if j >= 0 and j not in seen:
                seen.add(int(j))
                todo.append(int(j))
    assert len(seen) > 690


def test_pruning_keeps_diverse_neighbours():
    """Of two candidates in one direction only the nearer stays."""
    x = ann.unit(np.array([[1, 0, 0], [1, 0.1, 0], [1, 0.2, 0], [1, 0, -0.3]], float)).astype(np.float32)
    kept = ann._prune(x, np.array([0]), np.array([[2, 1, 3, 0, -1, 1]], np.int32), 3, 1.2)
    assert kept.tolist() == [[1, 3, -1]]


def test_vector_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (50, [1.0, 0.0]), (50, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]), (7, [None, 1.0]),
            (8, [inf, 1.0]), (None, [1.0, 0.0]), (100, [0.0, 0.0]), (150, None), (200, [1.0, 2.0, 3.0]), (9, []), (250, [-1.0, -1e-30])]
    rows += [(1000 + i, [3.0, 4.0]) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).withColumn("ids", F.lit(1))
    got = defaultdict(list)
    for r in sorted(ann.search_embeddings(df).collect(), key=lambda r: r.rank):
        got[r.query_id].append((r.vec_id, r.score))
    want = brute([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows])
    assert set(got) == {0, 50, 250, 1000 + 50 - 50} - {1000} | {q for q, w in want.items() if w}
    for q, w in want.items():
        assert [i for i, _ in got[q]] == [i for i, _ in w], q
        assert all(abs(a - b) < 1e-12 for (_, a), (_, b) in zip(got[q], w))
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.search_embeddings(none).collect() == []


def test_shards(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in sharding.shard_documents(docs).collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    slots = defaultdict(list)
    for i, r in rows.items():
        assert r.size == len(text[i].encode()) + 1 and r.text_crc32 == zlib.crc32(text[i].encode()) and r.law == "key"
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 16)
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = sharding.shard_documents(docs, 17).collect()
    assert all(r.shard == rows[r.doc_id].grown_shard for r in again)
    moved = sum(r.shard != r.grown_shard for r in rows.values())
    assert 0 < moved < 3 * len(rows) / 17


def test_weights(spark):
    rows = spark.range(20_000).select(sharding.rendezvous(F.col("id"), [1.0, 2.0, 5.0]).alias("s"), sharding.rendezvous(F.col("id"), [1.0, 2.0, 5.0, 2.0]).alias("t")).collect()
    n = Counter(r.s for r in rows)
    assert [n[i] / 20_000 for i in range(3)] == pytest.approx([1 / 8, 2 / 8, 5 / 8], abs=0.02)
    assert all(r.t in (r.s, 3) for r in rows)
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), [1.0, 0.0])


def test_shard_edge_cases(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, None), (None, ""), (None, "é" * 50_000), (2, None)] + [(9, "copy")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("x")).withColumn("_b", F.lit(1)).withColumn("slot", F.lit(2))
    got = sharding.shard_documents(df).collect()
    assert len(got) == len(rows) and {r.size for r in got} == {2, 1, 100_001, 5}
    by = defaultdict(set)
    slots = defaultdict(list)
    for r in got:
        by[r.doc_id].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(len(s) == 1 for s in by.values()) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    kept = sharding.assign_shards(df.drop("shard"), "doc_id", [1.0] * 4)
    assert kept.columns == ["doc_id", "text", "_b", "slot", "shard"] and kept.count() == len(rows)
    with pytest.raises(ValueError):
        sharding.assign_shards(df, "doc_id", [1.0])


def test_shards_are_native(spark):
    plan = sharding.shard_documents(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian", "NestedLoop"))


def test_scaled_copies_are_ties(spark):
    """Vectors of one direction tie: the smallest ids, however many there are."""
    rng = np.random.default_rng(4)
    way = rng.normal(size=16)
    rows = [(i, [float(x) for x in way * (0.37 + i % 97)]) for i in range(3000)] + [(5000 + i, [float(x) for x in rng.normal(size=16)]) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v array<double>").repartition(5)
    got = ann.nearest(df, df.where("id in (0, 3, 2000)"), shard_rows=100).collect()
    by = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in (0, 3, 2000)}
    assert by == {0: [1, 2, 3, 4, 5], 3: [0, 1, 2, 4, 5], 2000: [0, 1, 2, 3, 4]}
    assert all(abs(r.score - 1) < 1e-12 for r in got)


def test_blocks_of_queries_bound_a_task_and_change_nothing(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    a, b = ([tuple(r) for r in ann.nearest(rows, rows, shard_rows=200, block_rows=n).orderBy("query_id", "rank").collect()] for n in (10**6, 70))
    assert a == b and len(a) == 5 * rows.count()
