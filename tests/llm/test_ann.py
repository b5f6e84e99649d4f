"""Multiprobe hashing against a search over all pairs: recall, exact scores and odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from devpulse.llm import ann, queries

SHAPE = "vec_id long, embedding array<float>, label int, v string, dim int, shard int, score int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "v", 2, 3, 4)
                                  for i, v in rows], SHAPE)


def good(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def plain(rows, every, k):
    """query -> [(vec_id, score)], best first."""
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and good(v)]
    out = {}
    for q in sorted({i for i, _ in rows if i % every == 0}):
        mine = [v for i, v in rows if i == q]
        scored = [(-max(float(m @ v) for m in mine if len(m) == len(v)), i) for i, v in rows
                  if i != q and any(len(m) == len(v) for m in mine)]
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def found(df, every, k, **args):
    out = {}
    for r in sorted(ann.nearest(df, F.col("vec_id") % every == 0, k, **args).collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items())
    return hits / sum(map(len, want.values()))


def test_odd_rows_searched_whole_equal_plain(spark):
    """With few rows every bucket is visited: the result is exact."""
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    rows += [(100, None), (101, [1, None, 0, 0]), (102, [1, float("nan"), 0, 0]), (103, [float("inf"), 0, 0, 0]), (104, [0, 0, 0, 0]),
             (105, []), (None, [1, 2, 3, 4]), (10, [1, 1, 0, 0]), (7, rows[7][1]), (200, [1, 2]), (201, [2, 1]), (202, [1, 1])]
    rows += [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(30)] + [(1000, [0.5, 0.5, 0.5, 0.5])] * 3
    want = plain(rows, 10, 5)
    got = found(frame(spark, rows).repartition(3), 10, 5, recall=1.0)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]], q
        np.testing.assert_allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_empty_and_no_query(spark):
    assert found(frame(spark, []), 10, 5) == {}
    assert found(frame(spark, [(1, [1, 2]), (2, [3, 4])]), 10, 5) == {}
    assert found(frame(spark, [(10, [1, 2])]), 10, 5) == {}


@pytest.mark.parametrize("shard, passing", [(16_384, 1 << 18), (150, 20)])
def test_recall_on_clusters_of_unequal_length_and_a_dense_one(spark, monkeypatch, shard, passing):
    """A third of all rows lie close together, one vector repeats under many keys; small shards give the same recall."""
    monkeypatch.setattr(ann, "SHARD", shard)
    monkeypatch.setattr(ann, "PASSING", passing)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    x = centres[rng.integers(0, 20, 1500)] + 0.4 * rng.normal(size=(1500, 16))
    x *= rng.uniform(0.5, 2, (1500, 1))
    x[:500] = x[0] + 0.01 * rng.normal(size=(500, 16))
    x[500:700] = x[501]
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    want = plain(rows, 20, 10)
    got = found(frame(spark, rows), 20, 10)
    assert recall(got, want) >= 0.9
    exact = {i: np.array(v) for i, v in rows}
    for q, listed in got.items():
        assert listed == sorted(listed, key=lambda p: (-p[1], p[0])) and len(listed) == 10
        np.testing.assert_allclose([s for _, s in listed], [exact[q] @ exact[i] for i, _ in listed], rtol=1e-12)
    # Equal vectors: the smallest keys, in order.
    same = [i for i, s in got[520] if i in range(500, 700)]
    assert same == [i for i in range(500, 700) if i != 520][:len(same)]


def test_visits_follow_the_estimated_success(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 8))
    t = ann.Hashing(x, (x[:100], x[:100] + 0.3 * rng.normal(size=(100, 8))), 4, 0)
    codes, costs = t.probes(x[:20], 40)
    every, own = t.probes(x[:20], ann.SLOTS**4)
    assert (np.diff(costs, axis=1) >= 0).all() and np.allclose(costs, own[:, :40])
    assert all(len(set(c)) == ann.SLOTS**4 for c in every.tolist())
    np.testing.assert_allclose(np.exp(-own).sum(1), 1, atol=1e-4)  # the chances of all buckets
    assert (codes[:, 0] == t.codes(x[:20])).mean() > 0.5


def test_registered_query_reaches_the_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = plain(rows, 20, 20)
    got = {}
    for r in queries.QUERIES["op13_nearest_neighbours"](spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert recall(got, want) >= 0.9 and {q: len(v) for q, v in got.items()} == {q: len(v) for q, v in want.items()}
