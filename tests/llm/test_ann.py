"""Nearest neighbours against brute force, codes against their bounds."""

import numpy as np

from trialstats.llm import ann, catalog


def brute(ids, vectors, query, k):
    score = vectors @ vectors[ids == query][0]
    score[ids == query] = -np.inf
    best = np.lexsort((ids, -score))[:k]
    return [(int(ids[b]), score[b]) for b in best if ids[b] != query]


def results(out):
    found = {}
    for r in sorted(out, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(found[r.query_id]) == r.rank
    return found


def test_whole_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = catalog.table(spark, sf, "embeddings").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = results(catalog.op6_ann(spark, sf).collect())
    assert sorted(found) == sorted(int(i) for i in ids if i % 20 == 0)
    hits = 0
    for query, got in found.items():
        want = brute(ids, vectors, query, 20)
        hits += len({i for i, _ in want} & {i for i, _ in got})
        assert len(got) == 20 and np.allclose([s for _, s in got], [vectors[ids == query][0] @ vectors[ids == i][0] for i, _ in got])
    assert hits >= 0.99 * 20 * len(found)


def test_many_blocks_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    data = [(i, rng.standard_normal(12).astype(np.float32).tolist()) for i in range(600)]
    data += [(600 + i, data[7][1]) for i in range(40)]  # repeated vectors tie
    odd = [(None, data[0][1]), (1000, None), (1001, [0.0] * 12), (1002, [float("nan")] + [1.0] * 11), (1003, [float("inf")] * 12),
           (1004, [None] + [1.0] * 11), (1005, []), (5, data[5][1]), (1020, [1.0, 2.0, 3.0]), (1021, [1.0, 2.0, 4.0])]
    df = spark.createDataFrame(data + odd, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS block", "2 AS rank", "3 AS dims")
    out = ann.search(df, "vec_id % 20 = 0", k=10, block_vectors=100, block_queries=3).collect()
    found = results(out)
    ids, vectors = np.array([i for i, _ in data]), np.array([v for _, v in data], float)
    assert found.pop(1020) == [(1021, 17.0)]
    assert sorted(found) == [i for i in range(640) if i % 20 == 0]
    exact = sum([i for i, _ in got] == [i for i, _ in brute(ids, vectors, q, 10)] for q, got in found.items())
    assert exact >= 0.95 * len(found)


def test_few_or_no_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0, 1.0]), (2, [3.0, 0.0])], "vec_id bigint, embedding array<double>")
    assert results(ann.search(df, "vec_id = 0").collect()) == {0: [(2, 3.0), (1, 2.0)]}
    assert ann.search(df, "vec_id = 9").count() == 0
    assert ann.search(df.limit(0), "vec_id % 20 = 0").count() == 0
    one = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id bigint, embedding array<double>")
    assert results(ann.search(one, "vec_id = 0").collect()) == {0: [(1, 2.0)]}


def test_codes_estimate_within_bounds(monkeypatch):
    """Over many rotations the estimates are unbiased, and their errors stay within the bounds."""
    rng = np.random.default_rng(2)
    vectors, queries = rng.standard_normal((200, 48)) + 1, rng.standard_normal((10, 48)) + 1
    centre, truth = vectors.mean(axis=0), vectors @ queries.T
    errors, within = [], []
    for seed in range(150):
        q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((48, 48)))
        monkeypatch.setattr(ann, "rotation", lambda dims, m=(q * np.sign(np.diag(r))).astype(np.float32): m)
        codes, norm, fit = ann.encode(vectors, centre)
        assert codes.shape == (200, 6)
        middle, bound = ann.estimates(codes, norm, fit, centre, queries)
        errors.append(middle - truth)
        within.append(np.abs(middle - truth) <= bound)
    errors = np.array(errors)
    z = errors.mean(axis=0) / (errors.std(axis=0) / np.sqrt(len(errors)))
    assert np.mean(within) > 0.99
    assert np.abs(z).max() < 5 and abs(z.mean()) < 0.5 and abs(z.std() - 1) < 0.2


def test_rows_of_one_id_are_different_vectors(spark):
    data = [(20, [1.0, 0.0]), (1, [5.0, 0.0]), (1, [9.0, 0.0]), (2, [-3.0, 1.0]), (20, [2.0, 0.0])]
    out = ann.search(spark.createDataFrame(data, "vec_id bigint, embedding array<double>"), "vec_id = 20", k=3).collect()
    answers = sorted((r.rank, r.vec_id, r.score) for r in out)
    assert answers == [(1, 1, 9.0), (1, 1, 18.0), (2, 1, 5.0), (2, 1, 10.0), (3, 20, 2.0), (3, 20, 2.0)]


def test_all_products_negative(spark):
    rng = np.random.default_rng(3)
    data = [(i, (np.abs(rng.standard_normal(8)) * (1 if i % 20 == 0 else -1)).tolist()) for i in range(400) if i % 20 or i == 20]
    out = ann.search(spark.createDataFrame(data, "vec_id bigint, embedding array<double>"), "vec_id = 20", k=5, block_vectors=50).collect()
    ids, vectors = np.array([i for i, _ in data]), np.array([v for _, v in data])
    got = results(out)[20]
    want = brute(ids, vectors, 20, 5)
    assert [i for i, _ in got] == [i for i, _ in want] and max(s for _, s in got) < 0
