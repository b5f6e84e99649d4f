"""Work that stays spread: routed fingerprint copies, parts of crowded keys; the pipeline's stages on odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from devpulse.llm import order_minhash, simhash
from devpulse.plans.staging import stage_table

SF001 = "/root/testdata/sf0.001"


# --- SimHash -------------------------------------------------------------------

@pytest.mark.parametrize("bits", [1, 2, 3, 4])
def test_trees_of_the_halves_keep_every_link(bits):
    rng = np.random.default_rng(bits)
    near = rng.integers(0, 2**64, 3000, dtype=np.uint64, endpoint=False)
    far = near.copy()
    for _ in range(bits):
        far ^= np.uint64(1) << rng.integers(0, 64, len(far)).astype(np.uint64)
    points = np.concatenate([near, far])
    met = np.zeros(len(near), bool)
    for mask in simhash.HALVES:
        tree = simhash.build_tree(rng.permutation(points)[:1024], 16, bits // 2, mask)
        for _, some in simhash.route(points, tree, bits // 2, mask):
            met |= np.isin(near, some) & np.isin(far, some)
    assert met.all()
    ordered = np.unique(points)
    parent = simhash.local_components(ordered, bits)
    assert (parent[np.searchsorted(ordered, near)] == parent[np.searchsorted(ordered, far)]).all()


def test_few_copies_and_even_shards():
    points = np.random.default_rng(1).integers(0, 2**64, 250_000, dtype=np.uint64, endpoint=False)
    copies, largest = [], 0
    for n in (60_000, 250_000):
        some, shards = points[:n], 2 ** int(np.ceil(np.log2(n / simhash.SHARD)))
        sizes = [len(s) for mask in simhash.HALVES for _, s in simhash.route(
            some, simhash.build_tree(some[:shards * simhash.SAMPLE_PER_SHARD], shards, 1, mask), 1, mask)]
        copies.append(sum(sizes) / n)
        largest = max(largest, *sizes)
    assert copies[1] < 6 and copies[1] / copies[0] < 4 ** 0.35 and largest < 2 * simhash.SHARD


# --- order MinHash -------------------------------------------------------------

def placed_rows():
    rows = [(i, f"text {i}") for i in range(2000)] + [(7, f"of one key {i}") for i in range(3000)]
    rows += [(None, f"of no key {i}") for i in range(1000)] + [(2**63 - 1, "last"), (-2**63, "first"), (2**62, "far")]
    return rows + [(8, "the same")] * 40


def test_crowded_keys_make_even_parts(spark):
    df = spark.createDataFrame(placed_rows(), "doc_id long, text string")
    placed, n = order_minhash.with_parts(df, "doc_id", "text")
    sizes = sorted(r["count"] for r in placed.groupBy("_part").count().collect())
    assert len(sizes) == n > 32 and sizes[-1] < 4 * len(placed_rows()) / n
    assert placed.where("_first").select("_part").distinct().count() == n


def test_next_goes_once_round_all_rows(spark):
    rows = placed_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = order_minhash.with_next(df, "doc_id", ["text", "doc_id"]).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got))) == sorted(map(repr, rows))
    after = {(r.doc_id, r.text): (r.next.doc_id, r.next.text) for r in got if (r.doc_id, r.text) != (8, "the same")}
    same = [(r.next.doc_id, r.next.text) for r in got if (r.doc_id, r.text) == (8, "the same")]
    assert same.count((8, "the same")) == 39
    after[8, "the same"] = next(x for x in same if x != (8, "the same"))
    at, seen = (2**63 - 1, "last"), []
    for _ in range(len(after)):
        at = after[at]
        seen.append(at)
    assert len(set(seen)) == len(set(rows)) and seen[-1] == (2**63 - 1, "last")
    keys = [(k is not None, k or 0) for k, _ in seen]
    assert keys == sorted(keys)


def test_next_of_one_and_of_no_row(spark):
    one = spark.createDataFrame([(None, "alone")], "doc_id long, text string")
    assert order_minhash.with_next(one, "doc_id", ["text"]).first().next.text == "alone"
    assert order_minhash.with_next(one.limit(0), "doc_id", ["text"]).count() == 0


# --- pipeline ------------------------------------------------------------------

def test_stages_on_odd_rows(spark):
    """Nulls in every column, empty and very long texts, repeated rows, rows without a key, clashing names."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    good = docs.join(spark.read.parquet(f"{SF001}/labels.parquet").where("quality = 1 and toxic = 0").select("doc_id"),
                     "doc_id", "left_semi").where("lang = 'en'").orderBy("doc_id").limit(4)
    first = good.limit(1)
    text = first.first().text
    odd = (good.unionByName(first).unionByName(first)
           .unionByName(first.withColumn("doc_id", F.lit(None).cast("long")))
           .unionByName(first.withColumn("doc_id", F.lit(None).cast("long")))
           .unionByName(first.withColumns({"doc_id": F.lit(900001), "text": F.lit(None).cast("string"),
                                           "lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"),
                                           "n_chars": F.lit(None).cast(docs.schema["n_chars"].dataType)}))
           .unionByName(first.withColumns({"doc_id": F.lit(900002), "text": F.lit("")}))
           .unionByName(first.withColumns({"doc_id": F.lit(900003), "text": F.lit(" ".join([text] * 400))}))
           .withColumns({"score": F.lit(1.5), "label": F.lit(1), "fp": F.lit("x"), "key": F.lit(2), "_h1": F.lit(3),
                         "length": F.lit(4), "row": F.lit(None).cast("string"), "_text": F.lit("y")}))
    kept = [stage_table(odd, "t-odd")]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stage_table(stage(spark, kept[-1], SF001), f"t-{name}"))
    assert all(d.columns == odd.columns for d in kept[:-1])
    first_id = first.first().doc_id
    assert kept[2].where(F.col("doc_id") == first_id).count() == 3
    assert kept[3].where(F.col("text") == text).select("doc_id").collect() == [(first_id,)]
    assert kept[3].count() == kept[3].select("text").distinct().count()
    packed = kept[4].groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("all")).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in kept[3].collect()} and all(r.n == r.all for r in packed)


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF001)
        assert docs.count() == 0
