"""Faults found after the operators were first built: each with the input that showed it."""

import math
import sys
import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from devpulse.llm import bpe, packing, queries, simhash, token_counts, topk, warc
from devpulse.session import scratch_path


@pytest.mark.parametrize("frame", ["{}", "a{}b", "́{}̣"])
def test_every_code_point_as_the_library_has_it(frame):
    library, ours = Tokenizer.from_file(queries.WORD_BPE), bpe.encoder(queries.WORD_BPE)
    counts = token_counts.counter(queries.WORD_BPE)
    every = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    for a in range(0, len(every), 5000):
        text = " ".join(map(frame.format, every[a:a + 5000]))
        ids = library.encode(text, add_special_tokens=False).ids
        assert next(ours.encode([text])).tolist() == ids, hex(a)
        if a < 0x20000:
            assert counts.total(text) == len(ids), hex(a)


def test_topk_of_repeated_query_rows(spark, monkeypatch):
    """Rows of a query's key twice, whole or with other vectors: each candidate row counts once; the registered SQL agrees."""
    monkeypatch.setattr(topk, "BLOCK", 8)
    monkeypatch.setattr(topk, "SEEDS", 4)
    rows = [(50, [1.0, 0.0]), (50, [1.0, 0.0]), (50, [0.0, 1.0]), (100, [0.5, 0.5]), (7, [0.25, 0.0]), (7, [0.25, 0.0])]
    rows += [(i, [math.cos(i), math.sin(i)]) for i in range(101, 140)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()))
    con = duckdb.connect()
    con.register("arrow_rows", pa.table({"vec_id": [r[0] for r in rows], "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32()))}))
    con.execute("CREATE VIEW embeddings AS SELECT * FROM arrow_rows")
    want = con.execute(queries.ORACLE_SQL["op1_exact_topk"]).fetchall()
    assert got == sorted(want) and [r[1] for r in got if r[0] == 50] == [1, 2, 3, 4, 5]


def test_topk_where_one_key_holds_the_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROTATION_ROWS", 4)
    rows = [(3, [float(i % 5), 1.0]) for i in range(200)] + [(50, [1.0, 1.0])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 50, 5).collect()
    assert [(r.vec_id, r.score) for r in got] == [(3, 5 * 256 * 256)] * 5
    zero = spark.createDataFrame([(i, [0.0, 0.0]) for i in range(60)], "vec_id long, embedding array<double>")
    assert topk.top_k(zero, F.col("vec_id") == 50, 2).select("vec_id").collect() == [(0,), (1,)]


def test_keep_one_keeps_one_row(spark):
    """Equal rows of one key, equal rows without a key, one key with two texts of a component."""
    rows = [(5, "red green blue sky", "x")] * 4 + [(None, "some other words here", "y")] * 3
    rows += [(9, "Red green blue sky", "z"), (8, None, "n"), (7, "", "e"), (8, "", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _h1 string")
    got = sorted(map(tuple, simhash.keep_one(df, 3, 3).select("doc_id", "text").collect()), key=str)
    assert got == sorted([(5, "red green blue sky"), (None, "some other words here"), (7, "")], key=str)
    assert simhash.keep_one(df, 3, 3).columns == df.columns


def test_warc_task_shapes(spark, monkeypatch):
    files = spark.createDataFrame([(f"file:/x/part-{i:05d}.txt.gz",) for i in range(40)], "path string").repartition(3)
    dealt = warc.one_a_task(files, 40).groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(dealt) == 40 and {r["count"] for r in dealt} == {1}
    monkeypatch.setattr(warc, "TASK_BYTES", 1000)
    monkeypatch.setattr(warc, "STRETCH_BYTES", 500)
    root = "file://" + scratch_path(spark, "t-warc-shapes").removeprefix("file:")
    pages = spark.range(200).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.sha2(F.col("id").cast("string"), 512).alias("html"))
    warc.write_monolithic(pages.repartition(4), root + "/in")
    index = warc.normalise(spark, root + "/in", root + "/out")
    back = warc.read_back(index)
    assert back.rdd.getNumPartitions() == -(-index.agg(F.sum("length")).first()[0] // 1000) > 20
    assert back.where("intact").count() == 200
    # A second attempt leaves the first one's files, and its index names its own.
    again = warc.normalise(spark, root + "/in", root + "/out")
    assert not {r.path for r in index.collect()} & {r.path for r in again.collect()} and warc.read_back(again).count() == 200


def classes(lengths):
    out = {}
    for x in np.clip(lengths, 1, 4096).astype(int):
        width = -(-x // 8) if x <= 1024 else -(-x // 16) * 2 if x <= 2048 else -(-x // 32) * 4
        out[int(width)] = out.get(int(width), 0) + 1
    return out


RNG = np.random.default_rng(0)
HISTOGRAMS = {
    "uniform": (RNG.integers(1, 4097, 200_000), 1.005), "exponential": (RNG.exponential(2000, 200_000), 1.005),
    "log-normal": (np.exp(RNG.normal(5.3, 1, 200_000)), 1.005), "middle": (RNG.integers(600, 1900, 100_000), 1.005),
    "two points": (np.repeat([1400, 900], [50_000, 70_000]), None), "all long": (RNG.integers(2100, 4097, 50_000), None),
    "few": (RNG.integers(1, 4097, 300), 1.05), "one": (np.array([77]), None)}


@pytest.mark.parametrize("name", HISTOGRAMS)
def test_cutting_stock_ends_and_packs_tightly(name, monkeypatch):
    """``room``: used sequences against the room the pieces need; two kinds cannot fill a sequence, long ones are alone."""
    lengths, room = HISTOGRAMS[name]
    demand, runs, price = classes(lengths), [], packing._knapsack
    monkeypatch.setattr(packing, "_knapsack", lambda *a: runs.append(1) or price(*a))
    start = time.perf_counter()
    plan = packing.cutting_stock(demand, 512)
    assert time.perf_counter() - start < 10 and len(runs) < packing.ROUNDS
    made = {}
    for held, times in plan:
        assert sum(w * n for w, n in held.items()) <= 512
        for w, n in held.items():
            made[w] = made.get(w, 0) + n * times
    assert made == demand
    used = sum(times for _, times in plan)
    if room:
        assert used <= room * sum(w * n for w, n in demand.items()) / 512 + 1
    if name == "two points":  # 1400 in 176 and 900 in 113 steps: 1 + 2 or 2 + 1 or 4 + 0 a sequence of 512
        assert used == 36_250
    if name == "all long":
        assert used == 50_000


def test_equal_rows_are_ranked_in_many_tasks(spark):
    rows = [(1, "one and the same text")] * 500
    cut = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), queries.WORD_BPE, 2, 32, 1).collect()
    assert len(cut) == 500 and len({(r.sequence_id, r.offset) for r in cut}) == 500
