"""The training-data operators against the library, brute force, SQL and round trips, with odd inputs."""

import hashlib
import unicodedata
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from devpulse.llm import (bpe, lm_scoring, order_minhash, packing, quality, queries, simhash, token_counts, topk,
                          toxicity, warc)
from tests.oracle_harness import compare, duck

SF001 = "/root/testdata/sf0.001"
LONG = "the cat sat on <|endoftext|> it's 42 " * 3000
ODD = [(1, "Hello  World's don't"), (2, None), (3, ""), (4, " \t\n"), (5, LONG), (6, "ΣΑΣ İstanbul ½² 一二 a\x1cb"),
       (6, "ΣΑΣ İstanbul ½² 一二 a\x1cb"), (None, "aaaaaaa '' \U0001F600"), (9, "one two")]
SHAPE = "doc_id long, text string"
#: Columns whose names operators use themselves, and the same columns empty.
CLASH = "doc_id long, text string, fp long, key string, label int, score double, length int, _text string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SHAPE)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="module")
def clash(spark):
    return spark.createDataFrame([(*r, 1, "k", 1, 0.5, 3, "x") for r in ODD], CLASH)


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(queries.WORD_BPE)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", ["op1_exact_topk", "op2_cross_entropy_difference", "op5_warc_normaliser"])
def test_query_matches_sql(spark, name):
    n, problems = compare(spark, duck(SF001), queries.QUERIES[name], queries.ORACLE_SQL[name], SF001)
    assert n and not problems


# --- BPE, token counts, packing ------------------------------------------------

@settings(max_examples=150, deadline=None, derandomize=True)
@given(st.text(st.one_of(st.sampled_from("aeinothrs'.!09 \n<|>É"), st.characters(codec="utf-8")), max_size=60))
def test_ids_and_prefix_counts_equal_the_library(text):
    t = Tokenizer.from_file(queries.WORD_BPE) if not hasattr(test_ids_and_prefix_counts_equal_the_library, "t") else \
        test_ids_and_prefix_counts_equal_the_library.t
    test_ids_and_prefix_counts_equal_the_library.t = t
    assert next(bpe.encoder(queries.WORD_BPE).encode([text])).tolist() == t.encode(text, add_special_tokens=False).ids
    table = token_counts.counter(queries.WORD_BPE).prefixes(text)
    whole = unicodedata.normalize("NFC", text)
    for n in range(0, len(whole) + 1, 5):
        assert table.at(n) == len(t.encode(whole[:n], add_special_tokens=False).ids)


def test_bpe_round_trip(odd, clash, none, library):
    decoder = Tokenizer.from_file(queries.WORD_BPE)
    for df in (odd, clash):
        got = sorted(map(tuple, bpe.digests(df, queries.WORD_BPE).collect()), key=str)
        want = [(i, len(ids := library(t)), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                 hashlib.sha256(decoder.decode(ids, skip_special_tokens=False).encode()).hexdigest()) for i, t in ODD]
        assert got == sorted(want, key=str)
    assert bpe.digests(none, queries.WORD_BPE).count() == 0


def test_token_counts(odd, none, library):
    got = token_counts.token_counts(odd, queries.WORD_BPE, 50).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got), key=str) == sorted(
        ((i, len((t or "").encode()), n := len(library(t)), n > 50) for i, t in ODD), key=str)
    cut = next(r.fit_chars for r in got if r.doc_id == 5)
    whole = unicodedata.normalize("NFC", LONG)
    assert len(library(whole[:cut])) <= 50 < len(library(whole[:cut + 8]))
    assert token_counts.token_counts(none, queries.WORD_BPE, 50).count() == 0


def test_special_strings_in_another_case_are_text(spark, library):
    texts = ["<|ENDOFTEXT|>", "a <|EndOfText|> b", "<|endoftext|> <|ENDOFTEXT|>", "<|ENDOFTEXT|><|endoftext|>",
             "<|StartOfText|>\x1c <|startoftext|>", " <|ENDOFTEXT|> s<|endoftext|>"]
    want = [library(t) for t in texts]
    assert [i.tolist() for i in bpe.Encoder(queries.WORD_BPE).encode(texts)] == want
    c = token_counts.WordCounter(queries.WORD_BPE)
    for _ in range(2):
        assert [c.total(t) for t in texts] == [c.prefixes(t).total() for t in texts] == [len(i) for i in want]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), SHAPE), queries.WORD_BPE, 2, 64, 1).collect()
    assert {r.doc_id: r.doc_tokens for r in rows} == {i: len(w) + 1 for i, w in enumerate(want)}


def test_long_words_store_no_prefixes(library, monkeypatch):
    rng = np.random.default_rng(1)
    mixed = "".join(rng.choice(list("aeinothrs"), 4000))
    for text in ("=" * 5000, mixed, "x " + mixed.upper(), " " * 900 + mixed, "é一" * 900, "a b " + "''" * 700 + " c"):
        c = token_counts.WordCounter(queries.WORD_BPE)
        n, table = len(library(text)), c.prefixes(text)
        assert c.total(text) == table.total() == n
        for budget in (0, 1, n // 2, n - 1):
            cut = table.longest(budget)
            assert len(library(text[:cut])) <= budget
            with monkeypatch.context() as m:  # the same as place by place from the stored prefixes
                m.setattr(token_counts, "SHORT", 1 << 40)
                if len(text) <= 1500:
                    assert token_counts.WordCounter(queries.WORD_BPE).prefixes(text).longest(budget) == cut
        assert [table.at(i) for i in (300, 1001)] == [len(library(text[:i])) for i in (300, 1001)]
        assert sum(map(len, c.states)) + sum(map(len, c.chunks)) < 100_000
    c = token_counts.WordCounter(queries.WORD_BPE)
    monkeypatch.setattr(token_counts, "TABLE_STATES", 500)
    many = "-".join("".join(rng.choice(list("aeinothrs"), 30)) for _ in range(200))
    assert c.total(many) == len(library(many)) and len(c.states) < 1000


def test_packing_covers_every_id_once(odd, none, library):
    rows = packing.pack(odd, queries.WORD_BPE, 2, capacity=64, step=1).collect()
    spent = {}
    for r in rows:
        spent.setdefault(r.sequence_id, []).append((r.offset, r.length))
        texts = [t for i, t in ODD if i == r.doc_id]
        ids = np.array(library(texts[0]) + [2], "<u4")
        assert r.doc_tokens == len(ids) and zlib.crc32(ids[r.start:r.start + r.length].tobytes()) == r.ids_crc32
    for pieces in spent.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 64
    assert sum(r.length for r in rows) == sum(len(library(t)) + 1 for _, t in ODD)
    assert packing.pack(none, queries.WORD_BPE, 2).count() == 0


def test_packing_of_one_key_with_many_texts(spark, library):
    texts = [f"word {i % 7} more" for i in range(60)] + [None] * 5
    rows = packing.pack(spark.createDataFrame([(1, t) for t in texts], SHAPE), queries.WORD_BPE, 2, 32, 1).collect()
    crc = [zlib.crc32(np.array(library(t) + [2], "<u4").tobytes()) for t in texts]
    assert sorted(r.ids_crc32 for r in rows) == sorted(crc)
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


@settings(max_examples=25, deadline=None, derandomize=True)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=12))
def test_cutting_stock_meets_the_demand(demand):
    made = {}
    for held, times in packing.cutting_stock(demand, 30):
        assert sum(w * n for w, n in held.items()) <= 30 and times > 0
        for w, n in held.items():
            made[w] = made.get(w, 0) + n * times
    assert made == demand


# --- SimHash -------------------------------------------------------------------

def components(fps, bits):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(fps))]


@settings(max_examples=20, deadline=None, derandomize=True)
@given(st.integers(0, 2**32), st.integers(2, 900))
def test_shards_keep_every_link(seed, n):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    points = np.unique(base[rng.integers(0, 12, n)] ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
                       ^ (np.uint64(1) << rng.integers(0, 20, n).astype(np.uint64)))
    met = set()
    for _, some in simhash.route(points, simhash.build_tree(points, 16, 3), 3):
        near = np.argwhere(simhash.distance(some[:, None], some[None, :]) <= 3)
        met |= {(int(some[a]), int(some[b])) for a, b in near}
    near = np.argwhere(simhash.distance(points[:, None], points[None, :]) <= 3)
    assert met == {(int(points[a]), int(points[b])) for a, b in near}
    assert simhash.local_components(points, 3).tolist() == components(points.tolist(), 3)


def test_near_duplicates(spark, odd, clash, none, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 8)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").unionByName(
        odd.where("doc_id > 1").withColumn("doc_id", F.col("doc_id") + 1000))
    rows = docs.orderBy("doc_id").collect()
    fps = [simhash.fingerprint(r.text, 3) for r in rows]
    want = {r.doc_id: (f"{f:016x}", rows[c].doc_id) for r, f, c in zip(rows, fps, components(fps, 3))}
    got = simhash.near_duplicates(docs, 3, 3).collect()
    assert len(got) == len(rows) and all(want[r.doc_id] == (r.fingerprint, r.component_id) for r in got)
    assert simhash.fingerprint("A b\x0bC", 3) == int.from_bytes(
        spark.sql("select unhex(hex(xxhash64('a b c')))").first()[0], "big")
    kept = simhash.keep_one(clash, 3, 3)
    assert kept.columns == clash.columns and kept.where("doc_id in (3, 4)").count() == 0  # zero, as null text 2
    assert simhash.near_duplicates(none, 3, 3).count() == 0
    # one key in two components, the smallest of one and not of the other: of each component one row stays
    twice = spark.createDataFrame([(1, "red green blue sky"), (2, "red green blue sky"), (2, "other words stand here"),
                                   (3, "other words stand here")], SHAPE)
    assert {(r.doc_id, r.text[:3]) for r in simhash.keep_one(twice, 3, 3).collect()} == {
        (1, "red"), (2, "oth")}


# --- top-k ---------------------------------------------------------------------

def test_topk_ties_and_unusable_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "SEEDS", 4)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=4) * rng.choice([.1, 1, 5])]) for i in range(120)]
    rows += [(200 + i, [1.0, 2.0, 0.0, -1.0]) for i in range(30)]
    bad = [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [float("nan")] * 4), (303, [float("inf"), 0.0, 0.0, 0.0]),
           (None, [9.0] * 4), (350, [1.0, 1.0])]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    v = {i: np.floor(256 * np.array(x)).astype(np.int64) for i, x in rows}
    want = [(q, r + 1, c, s) for q in v if q % 50 == 0
            for r, (s, c) in enumerate([(-s, c) for s, c in sorted((-int(v[q] @ v[c]), c) for c in v if c != q)[:5]])]
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0, 5).collect()))
    assert got == sorted(want)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


# --- order MinHash ---------------------------------------------------------------

def test_order_minhash(spark, odd, clash, none):
    rows = {(r.doc_id, r.edited_sha256): r for r in order_minhash.edited_fingerprints(odd).collect()}
    order = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        t, half = t or "", len(t or "") // 2
        edited = t[:len(t) - half] + (after or "")[:half]
        r = rows[i, hashlib.sha256(edited.encode()).hexdigest()]
        assert r.n_chars == len(t) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert len({r.fingerprint for r in rows.values() if r.doc_id in (2, 3)}) == 1
    assert order_minhash.edited_fingerprints(clash).count() == len(ODD)
    assert order_minhash.edited_fingerprints(none).count() == 0
    words = [f"w{i}" for i in range(300)]
    pair = spark.createDataFrame([(0, " ".join(words)), (1, " ".join(words[150:] + words[:150])),
                                  (2, " ".join(reversed(words)))], SHAPE)
    near = [r.near_next for r in order_minhash.edited_fingerprints(pair).orderBy("doc_id").collect()]
    assert 0.2 < near[0] < 0.9 and near[1] == 0  # moved halves agree in part, other order not at all


def test_order_minhash_keeps_the_order_of_short_texts(spark):
    rows = [(n, s, words := [f"w{s}x{i}" for i in range(n)], words[n // 2:] + words[:n // 2])
            for n in (20, 50, 100) for s in range(30)]
    df = spark.createDataFrame([(n, " ".join(a), " ".join(b)) for n, _, a, b in rows], "n int, a string, b string")
    df = order_minhash.with_signature(order_minhash.with_signature(df, "a", "sa"), "b", "sb")
    near = dict(df.groupBy("n").agg(F.avg(order_minhash.likeness("sa", "sb"))).collect())
    assert all(0.2 < x < 0.62 for x in near.values())  # half the pairs of items lie in one half and stay in order
    one = spark.createDataFrame([("a b c", "a b c"), ("", None), ("a b c d", "a b c d")], "a string, b string").fillna("")
    one = order_minhash.with_signature(order_minhash.with_signature(one, "a", "sa"), "b", "sb")
    assert [r[0] for r in one.select(order_minhash.likeness("sa", "sb")).collect()] == [1, 1, 1]


# --- WARC ------------------------------------------------------------------------

def test_warc_records_revisits_and_members(spark):
    import gzip
    from urllib.parse import urlparse
    pages = spark.createDataFrame(
        [(1, "http://a/ x\r\ny", "same"), (2, "http://b", "same"), (3, None, None), (4, "http://c", ""),
         (5, "http://d", "WARC/1.1\r\n\r\n" * 9), (2, "http://b", "same"), (None, "http://e", "same"), (7, "u", "é" * 400_000)],
        "page_id long, url string, html string").withColumn("digest", F.lit("x"))
    from devpulse.session import scratch_path
    root = "file://" + scratch_path(spark, "t-warc").removeprefix("file:").replace("//", "/")
    warc.write_monolithic(pages, root + "/in")
    index = warc.normalise(spark, root + "/in", root + "/out")
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to, r.intact) for r in
                 warc.read_back(index).collect())
    assert got == sorted([(1, 4, "revisit", 2, True), (2, 4, "response", None, True), (2, 4, "response", None, True),
                          (0, 4, "revisit", 2, True), (3, 0, "revisit", 4, True), (4, 0, "response", None, True),
                          (5, 108, "response", None, True), (7, 800_000, "response", None, True)])
    at = index.orderBy("path", "offset").collect()
    with open(urlparse(at[0].path).path, "rb") as f:
        data = f.read()
    with open(urlparse(at[0].path).path + ".idx") as f:
        assert len(f.readlines()) == sum(r.path == at[0].path for r in at)
    assert gzip.decompress(data).count(b"WARC-Record-ID") == sum(r.path == at[0].path for r in at)
    assert warc.round_trip(pages.limit(0)).count() == 0


# --- language models and classifiers ------------------------------------------------

def test_lm_scores_prefer_the_target(spark, odd, none):
    rows = [(i, "red green blue red green") for i in range(20)] + [(i, f"x{i} y{i} blue red") for i in range(20, 40)]
    docs = spark.createDataFrame(rows, SHAPE).unionByName(odd.withColumn("doc_id", F.col("doc_id") + 100))
    out = {r.doc_id: r for r in lm_scoring.scores(docs, docs.where("doc_id < 20").select("doc_id")).collect()}
    assert out[0].score < 0 < out[25].score and out[102].n_tokens == 0 and out[102].score is None
    assert lm_scoring.scores(none, none).count() == 0
    assert lm_scoring.scores(odd, none).count() == len(ODD)


def test_quality_held_out(spark, clash, none):
    scored = queries.op3_quality_rules(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out")
    right, n = scored.agg(F.count_if(F.col("predicted") == F.col("quality")), F.count("*")).first()
    assert right >= 0.95 * n > 0
    one_class = labelled(spark, [(1, 1, 0), (5, 1, 0), (None, 0, 0), (6, None, None)])
    assert {r.predicted for r in quality.scores(clash, one_class, 0.3).collect()} == {1}
    assert quality.scores(none, one_class, 0.3).count() == 0
    kept = quality.keep_good(clash, one_class, 0.3)
    assert kept.columns == clash.columns and kept.count() == len(ODD)


def test_quality_learns_from_ten_thousand_rows(spark):
    every = spark.range(30_000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    assert quality.training_rows(every, "quality", quality.TRAIN_ROWS).count() >= 10_000


def test_toxicity_held_out_and_odd(spark, clash, none):
    scored = queries.op6_toxicity(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").where("held_out")
    right, n = scored.agg(F.count_if(F.col("predicted") == F.col("toxic")), F.count("*")).first()
    assert right >= 0.95 * n > 0
    one_class = labelled(spark, [(1, 1, 0), (5, 1, 0)])
    kept = toxicity.keep_civil(clash, one_class, 0.5)
    assert kept.columns == clash.columns and kept.count() == len(ODD)
    assert toxicity.scores(none, one_class, 0.5).count() == 0


def test_a_training_key_on_many_rows_counts_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"good day number {i}") for i in range(400)] +
                                 [(i, f"women talk {i}") for i in range(2, 40)] + [(2, None)] * 3, SHAPE)
    marks = labelled(spark, [(i, i % 2, i % 2) for i in range(1, 40)])
    want = sorted(r.label for r in toxicity.training_rows(marks, "toxic", 100).collect())
    seen = []
    monkeypatch.setattr(quality, "fit", lambda rows, names: seen.append([r.label for r in rows.collect()]))
    monkeypatch.setattr(toxicity, "fit", lambda labels, *_: (seen.append(labels.tolist()), (0.0, np.empty(0)))[1])
    quality.train(docs, marks)
    toxicity.train(docs, marks)
    assert [sorted(s) for s in seen] == [want, want]


def test_counterfactual_penalty_lowers_identity_weight():
    texts = ["women are stupid losers", "those women are scum", "women scum", "nice day", "the men play", "good men"] * 5
    y = np.array([1, 1, 1, 0, 0, 0] * 5)
    own = [toxicity.features(t) for t in texts]
    named = np.array(sorted(set().union(*own, *(toxicity.features(c) for t in texts for c in toxicity.counterfactuals(t)))))
    rows = [toxicity._positions(f, named) for f in own]
    pairs = [(r, toxicity._positions(toxicity.features(c), named)) for r, t in zip(rows, texts)
             for c in toxicity.counterfactuals(t)]

    def neutral(penalty):
        start, w = toxicity.fit(y, rows, pairs, len(named), penalty)
        return toxicity.ToxicModel(start, named, w).score("women met today")
    assert neutral(3.0) < neutral(0.0)
