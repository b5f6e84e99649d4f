"""op1 where workers are new and rows are many."""

import os
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from devpulse.llm import topk

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_a_new_worker_can_stream_past_a_block():
    """A worker that ran nothing before has only what the module itself imports; its batches come as bytes."""
    batch = pa.record_batch({"_passes": [False, False, True, False], "block": pa.array([0, 0, 0, 2], pa.int32())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    code = """
import sys
import pyarrow as pa
from devpulse.llm import streams, topk
batch = pa.ipc.open_stream(sys.stdin.buffer.read()).read_next_batch()
assert [len(b) for b in streams._runs(batch, 1)] == [2, 1, 1]
"""
    ran = subprocess.run([sys.executable, "-c", code], cwd=REPO, input=sink.getvalue().to_pybytes(), capture_output=True,
                         timeout=120)
    assert ran.returncode == 0, ran.stderr.decode()


def searched(q_id, q, x_id, x, head, k, theta=None):
    order = np.lexsort((x_id, -topk._lengths(x)))
    x_id, x, rows = x_id[order], x[order], order
    rotation = np.linalg.qr(np.random.default_rng(0).normal(size=(x.shape[1],) * 2))[0]
    theta = np.full(len(q), topk.LOWEST) if theta is None else theta
    found = topk._search(q_id, q, theta, x_id, x, rows, topk._lengths(x), topk._side(x, rotation, head), rotation, head, k)
    return list(zip(*(c.tolist() for c in found)))


def brute(q_id, q, x_id, x, k):
    """Of each query its k best (score, key, row): scores as Python integers."""
    out = []
    for n, (own, v) in enumerate(zip(q_id.tolist(), q.tolist())):
        each = sorted((-sum(a * b for a, b in zip(v, w)), i, r) for r, (i, w) in enumerate(zip(x_id.tolist(), x.tolist())) if i != own)
        out += [(n, -s, i, r) for s, i, r in each[:k]]
    return out


@pytest.mark.parametrize("high", [1, 3, 300, 2**12, 2**27])
@pytest.mark.parametrize("head", [1, 3, 6])
def test_search_is_exact_at_any_size_of_components(monkeypatch, high, head):
    """Products that hold in single precision, in double precision and in neither; few values give many ties."""
    monkeypatch.setattr(topk, "CHUNK", 16)
    monkeypatch.setattr(topk, "LONG_CHUNK", 64)
    rng = np.random.default_rng(high + head)
    x, x_id = rng.integers(-high, high, (500, 6), endpoint=True), rng.integers(0, 300, 500)
    q, q_id = np.vstack([x[:20], np.zeros((1, 6), np.int64)]), np.r_[x_id[:20], 1000]
    want = brute(q_id, q, x_id, x, 5)
    assert searched(q_id, q, x_id, x, head, 5) == want
    # a threshold below which nothing has to be found: from the fifth best itself
    theta = np.array([s for _, s, _, _ in want[4::5]])
    assert searched(q_id, q, x_id, x, head, 5, theta) == want


def test_search_among_equal_vectors(monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 16)
    x, ids = np.tile([[3, -4, 12]], (400, 1)), np.random.default_rng(5).permutation(400)
    assert searched(ids[:30], x[:30], ids, x, 2, 5) == brute(ids[:30], x[:30], ids, x, 5)


def test_bounds_use_as_many_components_as_save_work():
    """Isotropic vectors of one length leave nothing to a bound from three quarters of the energy; flat ones do."""
    rng = np.random.default_rng(1)
    even = rng.normal(size=(4000, 64))
    even *= 256 / np.linalg.norm(even, axis=1, keepdims=True)
    assert topk._head(even, 5) == 64
    assert topk._head(even * np.r_[np.ones(6), np.full(58, 0.001)], 5) == 8
    assert topk._head(even[:1], 5) <= 64


def test_few_pairs_of_isotropic_vectors_are_scored(spark):
    """Bounds from three quarters of the energy let several in 100 pairs through, each of which costs a score."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(8192, 64))
    x = np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.int64)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "row long, v array<long>")
    rotation, head = topk._rotation(df, len(x), 64, 5)
    q, fifth = x[:64], np.sort(x[:64] @ x.T, axis=1)[:, -6:-5]
    within = topk._side(q, rotation, head) @ topk._side(x, rotation, head).T >= fifth
    assert within.mean() < 0.002
    ids = np.arange(len(x))
    assert searched(ids[:8], q[:8], ids, x, head, 5) == brute(ids[:8], q[:8], ids, x, 5)
