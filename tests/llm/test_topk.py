import numpy as np
import pytest

from millrace.llm import topk

VECTOR = "vec_id long, embedding array<float>, label int"


def brute(rows, k, every):
    fine = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in fine:
        if q % every == 0:
            best = sorted((-int(a @ b), i) for i, b in fine if i != q and len(a) == len(b))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    return sorted(out)


def vectors():
    draw = np.random.default_rng(3)
    centers = draw.normal(size=(6, 8))
    rows = [(k, np.float32(centers[k % 6] * 0.3 + draw.normal(size=8) * 0.05).tolist()) for k in range(300)]
    rows += [(300 + k, rows[0][1]) for k in range(150)]  # a very common vector
    rows += [(500, None), (501, [None] * 8), (502, [float("nan")] * 8), (550, [float("inf")] * 8), (None, rows[1][1]), (600, [0.5] * 3), (601, [1.0] * 3), (650, [])]
    return rows


@pytest.mark.parametrize("chunk_rows", [40, 8192])
def test_top_k_equals_brute_force(spark, chunk_rows):
    frame = spark.createDataFrame([(i, v, 0) for i, v in vectors()], VECTOR)
    found = topk.top_k(frame, k=5, every=10, chunk_rows=chunk_rows, group_rows=16)
    assert sorted(map(tuple, found.collect())) == brute(vectors(), 5, 10)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]


def test_nodes_hold_their_points_and_bounds_hold():
    draw = np.random.default_rng(4)
    points = np.vstack([draw.normal(size=(400, 5)) * 3, np.repeat(draw.normal(size=(1, 5)), 300, 0)])
    root = topk.Node(points, np.arange(len(points)), 0)
    todo, leaves = [root], []
    while todo:
        node = todo.pop()
        own = topk._below(node)
        assert (np.linalg.norm(points[own] - node.center, axis=1) <= node.radius + 1e-9).all()
        assert (points[own] @ points[own].T).max() <= topk.bound(node, node)
        leaves += [node] if node.rows is not None else []
        todo += node.children
    assert sorted(np.concatenate([x.rows for x in leaves]).tolist()) == list(range(len(points))) and len(leaves) > 3


def test_integers_beyond_doubles_are_exact():
    a = np.array([[2**40, 1], [2**40, 2]])
    best = topk.search(np.array([1]), np.array([[2**15, 1]]), np.array([2, 3]), a, 2, np.array([-np.inf]))
    assert best.rows[0].tolist() == [3, 2] and [int(x) for x in best.scores[0]] == [2**55 + 2, 2**55 + 1]


def test_empty_table_and_no_query(spark):
    assert topk.top_k(spark.createDataFrame([], VECTOR)).collect() == []
    assert topk.top_k(spark.createDataFrame([(1, [1.0], 0), (2, [2.0], 0)], VECTOR)).collect() == []
    assert topk.top_k(spark.createDataFrame([(50, [1.0], 0)], VECTOR)).collect() == []


def test_rows_of_one_id_are_dealt_to_many_chunks(spark):
    frame = spark.range(900).selectExpr("CASE WHEN id < 800 THEN 7 ELSE id END AS id", "array(1L, CASE WHEN id < 400 THEN 2L ELSE id END) AS vec")
    dealt = topk._dealt(frame, 2, np.array([[1.0, 2.0]]), 50)
    assert dealt.count() == 900 and max(r["count"] for r in dealt.groupBy("chunk").count().collect()) < 150
