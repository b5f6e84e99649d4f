"""The Merkle manifest against a plain tree, with odd rows."""

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from devpulse.llm import merkle, queries
from tests.oracle_harness import compare, duck

SF001 = "/root/testdata/sf0.001"
COLUMNS = ("doc_id", "source", "text")
SHAPE = "doc_id long, source string, text string, idx long, tree string, n int, _key int, path string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in COLUMNS))


def tree(hashes, fanout):
    levels = [hashes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + fanout])) for i in range(0, len(levels[-1]), fanout)])
    return levels


def path(levels, i, fanout):
    out = []
    for level in levels[:-1]:
        a = i // fanout * fanout
        out.append(("".join(level[a:i]), "".join(level[i + 1:a + fanout])))
        i //= fanout
    return out


def plain(rows, fanout):
    """Sorted (doc_id, leaf, subroot, root, path) of every row."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, bytes.fromhex(leaf(r))))
        trees[s] = tree([leaf(r) for r in groups[s]], fanout)
    top = tree([trees[s][-1][0] for s in names], fanout)
    return [(r["doc_id"], leaf(r), trees[s][-1][0], top[-1][0],
             path(trees[s], i, fanout) + path(top, g, fanout))
            for g, s in enumerate(names) for i, r in enumerate(groups[s])]


def rows_of(n):
    out = [(i, ("hot", "hot", "é", None, "b")[i % 5], None if i % 11 == 0 else "" if i % 7 == 0 else f"Text é {i}") for i in range(n)]
    out += [(None, "hot", "no key"), (None, None, None), (3, "hot", "again"), (3, "hot", "again"), (7, "lone", "x" * 200_000)]
    return [(*r, 1, "t", 2, 3, "p") for r in out]


@pytest.mark.parametrize("fanout, n", [(2, 14), (3, 20), (16, 70)])
def test_proofs_equal_a_plain_tree(spark, fanout, n):
    df = spark.createDataFrame(rows_of(n), SHAPE).repartition(3)
    got = merkle.proofs(df, COLUMNS, "source", "doc_id", fanout, ["n"])
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "path", "n"]
    want = plain([r.asDict() for r in df.collect()], fanout)
    found = [(r.doc_id, r.leaf, r.subroot, r.root, [(bytes(p.left).hex(), bytes(p.right).hex()) for p in r.path])
             for r in got.collect()]
    key = lambda r: str(r)
    assert sorted(found, key=key) == sorted(want, key=key)


def test_fold_finds_the_tampered_rows(spark):
    df = spark.createDataFrame(rows_of(40), SHAPE)
    got = merkle.proofs(df, COLUMNS, "source", "doc_id", 4)
    wrong = F.when(F.col("doc_id") % 3 == 0, F.sha2(F.col("leaf"), 256)).otherwise(F.col("leaf"))
    seen = got.select("doc_id", (merkle.fold(wrong, F.col("path")) == F.col("root")).alias("same")).collect()
    assert all(r.same == (r.doc_id is None or r.doc_id % 3 != 0) for r in seen)


def test_empty_and_single(spark):
    assert merkle.proofs(spark.createDataFrame([], SHAPE), COLUMNS, "source", "doc_id", 16).count() == 0
    one = merkle.proofs(spark.createDataFrame(rows_of(1)[:1], SHAPE), COLUMNS, "source", "doc_id", 16)
    row = one.select("*", merkle.siblings_digest(F.col("path")).alias("proof")).first()
    assert row.leaf == row.subroot == row.root and not row.path and row.proof == h("")


def test_a_level_makes_no_more_rows_than_nodes(spark):
    """Every join of a level is an equijoin on tree and index, one for each doubling of the offset."""
    nodes = spark.range(1000).select(F.floor(F.col("id") / 500).alias("tree"), (F.col("id") % 500).alias("idx"),
                                     F.lit(500).cast("long").alias("n"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("h"))
    level = merkle.with_runs(nodes, 16)
    assert level.count() == 1000 and {len(bytes(r.w)) // 32 for r in level.collect()} == {16, 4}
    plan = level._jdf.queryExecution().sparkPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    keys = [line for line in plan.split("\n") if "SortMergeJoin" in line]
    assert keys and all(re.search(r"\[tree#\d+L, idx#\d+L\], \[tree#\d+L, idx#\d+L\]", line) for line in keys)


def test_query_matches_sql(spark):
    name = "op12_merkle_manifest"
    n, problems = compare(spark, duck(SF001), queries.QUERIES[name], queries.ORACLE_SQL[name], SF001)
    assert n and not problems
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    for r in queries.QUERIES[name](spark, SF001).collect():
        tampered = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in docs[r.doc_id] or "")
        assert r.verified == (not tampered)


def test_plans_do_not_double_with_the_offsets(spark):
    """A level of sixteens reads its rows four times a plan (sixteen times if every join adds its two inputs' plans)."""
    nodes = spark.range(1000).select(F.lit(0).cast("long").alias("tree"), F.col("id").alias("idx"),
                                     F.lit(1000).cast("long").alias("n"), F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("h"))
    for fanout, doublings in ((16, 2), (256, 2)):
        plan = merkle.with_runs(nodes, fanout)._jdf.queryExecution().analyzed()
        assert plan.collectLeaves().size() == 2 ** doublings
    levels = merkle.climb(nodes, 2, "test-climb")
    top = merkle.roots(levels).selectExpr("tree", "cast(array() as array<struct<left:binary,right:binary>>) AS path")
    found = merkle.paths(levels, top, 2, "test-climb")
    assert len(levels) == 11 and found.count() == 1000 and found.where("size(path) = 10").count() == 1000
    assert found._jdf.queryExecution().analyzed().collectLeaves().size() <= 3 + len(levels)
