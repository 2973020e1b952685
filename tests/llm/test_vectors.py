"""Near-duplicate embeddings and nearest neighbours against brute force."""

import math

import numpy as np
import pytest

from tillstream.llm.embedding_dedup import link, op1_embedding_dedup, table_plan
from tillstream.llm.neighbours import Lines, nearest, op2_neighbours
from tillstream.llm.vectors import unit

SCHEMA = "vec_id long, label int, embedding array<float>, links int, vec string"


def brute(rows, threshold):
    """links and components of valid vectors by comparing all."""
    ids = [r[0] for r in rows]
    u = unit(np.array([r[1] for r in rows], float))
    near = u @ u.T >= threshold
    links = near.sum(1) - 1
    comp = list(ids)
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            low = min(comp[j] for j in np.flatnonzero(near[i]))
            if low < comp[i]:
                comp[i], changed = low, True
    return {i: (int(n), c) for i, n, c in zip(ids, links, comp)}


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(40):
        centre = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 6))):
            rows.append(centre + rng.standard_normal(16) * rng.uniform(0, 0.35))
    hot = rng.standard_normal(16)
    rows += [hot + rng.standard_normal(16) * 0.2 for _ in range(150)]
    rows += [rows[0]] * 5
    return [(int(i), [float(np.float32(x)) for x in r]) for i, r in zip(rng.permutation(len(rows)), rows)]


def test_links_equal_brute_force(spark, clustered):
    df = spark.createDataFrame([(i, 0, v, 7, "x") for i, v in clustered], SCHEMA)
    found = {r.vec_id: (r.n_links, r.component_id) for r in link(df, block=32).collect()}
    assert found == brute(clustered, 0.9)


def test_odd_vectors_link_with_nothing(spark):
    one = [1.0, 0.0]
    rows = [
        (1, 0, None, 0, None), (2, 0, [], 0, ""), (3, 0, [0.0, 0.0], 0, ""), (4, 0, [1.0, None], 0, ""),
        (5, 0, [float("nan"), 1.0], 0, ""), (6, 0, [float("inf"), 1.0], 0, ""), (7, 0, one, 0, ""),
        (8, 0, [2.0, 0.0], 0, ""), (9, 0, one, 0, ""), (10, 0, [1.0, 0.0, 0.0], 0, ""), (None, 0, one, 0, ""),
    ]
    found = sorted(link(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r.vec_id or 99)
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in found] == [
        *[(i, 0, i, True) for i in range(1, 7)],
        (7, 2, 7, True),
        (8, 2, 7, False),
        (9, 2, 7, False),
        (10, 0, 10, True),
        (None, 0, None, True),
    ]


def test_empty_table(spark):
    assert link(spark.createDataFrame([], SCHEMA)).collect() == []
    empty = spark.createDataFrame([], SCHEMA)
    assert nearest(empty, empty).collect() == []


def test_plan_keeps_its_promise():
    for rows in (100, 10**6, 10**9):
        bits, tables = table_plan(rows, 0.9)
        p = (1 - math.acos(0.9) / math.pi) ** bits
        assert (1 - p) ** tables <= 1e-4 and rows / 2**bits <= 200


def test_op1_on_the_smallest_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = {r.vec_id: (r.n_links, r.component_id) for r in op1_embedding_dedup(spark, folder).collect()}
    assert found == brute(rows, 0.9)


def recall(found, rows, queries, k=5):
    ids = np.array([r[0] for r in rows])
    m = np.array([r[1] for r in rows], float)
    norms = np.sqrt((m * m).sum(1))
    hits = total = 0
    for q in queries:
        at = int(np.flatnonzero(ids == q)[0])
        score = (m * m[at]).sum(1) / (norms * norms[at])
        score[ids == q] = -9
        want = np.lexsort((ids, -score))[:k]
        got = [(v, s) for _, v, s in sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q)]
        assert len(got) == min(k, len(rows) - 1)
        assert all(abs(s - score[np.flatnonzero(ids == v)[0]]) < 1e-12 for v, s in got)
        assert got == sorted(got, key=lambda x: (-x[1], x[0]))
        hits += len({ids[w] for w in want} & {v for v, _ in got})
        total += min(k, len(rows) - 1)
    return hits / total


def test_recall_on_random_vectors(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = op2_neighbours(spark, folder).collect()
    queries = [i for i, _ in rows if i % 50 == 0]
    assert {r.query_id for r in found} == set(queries)
    assert recall(found, rows, queries) >= 0.93


def test_few_vectors_are_verified(spark):
    """Vectors of 64 random components, and 400 copies of one of them: the copies are found whole."""
    rng = np.random.default_rng(8)
    m = rng.standard_normal((4000, 64))
    m[100:500] = m[0]
    ids, index, hits, shares = np.arange(len(m)), Lines(m, 128, 2), 0, []
    asked = np.r_[0, 600:700]
    for q, steps in zip(asked, index.steps(m[asked], 0.55, 1.4)):
        rows, scores, verified = index.search(m[q], 5, ids == q, ids, 0.6, 0.2, steps)
        exact = unit(m) @ unit(m[q : q + 1])[0]
        exact[q] = -9
        hits += len(set(rows) & set(np.lexsort((ids, -exact.round(12)))[:5]))
        shares.append(verified / len(m))
        assert q or list(rows) == [100, 101, 102, 103, 104]
    # All copies at once are a tenth of the block: a query may verify them above its share.
    assert hits >= 0.9 * 5 * len(asked) and np.mean(shares) < 0.3 and max(shares) < 0.4 and shares[0] < 0.11


def test_neighbours_in_clusters_and_ties(spark, clustered):
    df = spark.createDataFrame([(i, 0, v, 7, "x") for i, v in clustered], SCHEMA)
    found = nearest(df, df.where("vec_id % 5 = 0"), block=64, query_block=16).collect()
    assert recall(found, clustered, [i for i, _ in clustered if i % 5 == 0]) >= 0.95


def test_few_candidates_and_odd_vectors(spark):
    rows = [(0, 0, [1.0, 0.0], 0, ""), (3, 0, [1.0, 0.0], 0, ""), (2, 0, [5.0, 0.0], 0, ""), (4, 0, [0.0, 0.0], 0, ""),
            (5, 0, None, 0, ""), (6, 0, [1.0, None], 0, ""), (7, 0, [-1.0, 0.0], 0, ""), (None, 0, [1.0, 0.0], 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    found = nearest(df, df.where("vec_id in (0, 4, 5)")).collect()
    assert sorted(map(tuple, found)) == [(0, 1, 2, 1.0), (0, 2, 3, 1.0), (0, 3, 7, -1.0)]


def test_rows_of_one_id_are_one_node(spark):
    """The vectors of a repeated id tie their groups together; each row has the links of its own vector."""
    a, b, c = [1.0, 0.0], [0.0, 1.0], [-1.0, 0.0]
    rows = [(3, a), (5, a), (5, b), (9, b), (9, b), (7, c)]
    found = link(spark.createDataFrame([(i, 0, v, 0, "") for i, v in rows], SCHEMA)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == [
        (3, 1, 3, True), (5, 1, 3, False), (5, 2, 3, False), (7, 0, 7, True), (9, 2, 3, False), (9, 2, 3, False)
    ]


def test_repeated_queries_are_one(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), *[(i, [1.0, i / 10]) for i in range(1, 8)], (50, [0.0, 1.0]), (50, [-1.0, 0.0])]
    df = spark.createDataFrame([(i, 0, v, 0, "") for i, v in rows], SCHEMA)
    found = nearest(df, df.where("vec_id % 50 = 0")).collect()
    assert sorted((r.rank, r.vec_id) for r in found if r.query_id == 0) == [(i, i) for i in range(1, 6)]
    own = sorted((r.rank, r.vec_id) for r in found if r.query_id == 50)
    assert [r for r, _ in own] == sorted([1, 2, 3, 4, 5] * 2) and {v for r, v in own if r == 1} == {7}
