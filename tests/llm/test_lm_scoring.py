"""The cross-entropy difference against a plain evaluation, whatever the chunks, and the words' hashes."""

import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from devpulse.llm import lm_scoring

ODD = [(100, None), (101, ""), (102, " \t\n"), (103, "one"), (103, "one"), (None, "red red"), (104, "É é\x0bA a\x1cb"),
       (105, "red " * 2000 + "w" * 5000)]


def plain(rows, target):
    """``{(key, text): (tokens, target loss, background loss)}`` by counters over all words and pairs."""
    split = [(key, text, (text or "").encode().lower().split()) for key, text in rows]
    models = []
    vocabulary = {w for *_, ws in split for w in ws}
    for chosen in ([ws for key, _, ws in split if key in target], [ws for *_, ws in split]):
        one = Counter(w for ws in chosen for w in ws)
        two = Counter(p for ws in chosen for p in zip(ws, ws[1:]))
        models.append((one, two, one.total() + len(vocabulary)))
    out = {}
    for key, text, ws in split:
        losses = []
        for one, two, size in models:
            loss = 0.0
            for i, w in enumerate(ws):
                p = (one[w] + 1) / size
                if i and one[ws[i - 1]]:
                    p = 0.7 * two[ws[i - 1], w] / one[ws[i - 1]] + 0.3 * p
                loss -= math.log(p)
            losses.append(loss / len(ws) if ws else None)
        out[key, text] = (len(ws), *losses)
    return out


@pytest.mark.parametrize("chunk_bytes", [40, 3000, lm_scoring.CHUNK_BYTES])
def test_scores_equal_the_plain_evaluation(spark, chunk_bytes):
    rng = random.Random(7)
    names = ["red", "Green", "blue", *(f"w{i}" for i in range(60))]
    rows = [(i, " ".join(rng.choices(names, k=rng.randint(1, 30)))) for i in range(90)] + ODD
    target = {i for i in range(0, 90, 4)}
    # Columns of the operator's own names must not get in its way.
    docs = (spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
            .withColumns({c: F.lit("x") for c in ("_chunk", "key", "_text", "n", "item", "_target")}))
    keys = spark.createDataFrame([(i,) for i in [*target, 0, 4]], "doc_id long")
    out = lm_scoring.scores(docs, keys, chunk_bytes=chunk_bytes, bucket_bytes=chunk_bytes).join(
        docs.select("doc_id", "text").distinct(), "doc_id", "left").collect()
    expected = plain(rows, target)
    assert len(out) == len(rows)
    for r in out:
        n, a, b = expected[r.doc_id, "red red" if r.doc_id is None else r.text]
        assert r.n_tokens == n
        if n:
            assert (r.target_loss, r.background_loss, r.score) == pytest.approx((a, b, a - b))
        else:
            assert r.target_loss is r.background_loss is r.score is None


def test_no_target_and_no_rows(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string")
    empty = docs.limit(0)
    assert {r.target_loss is None for r in lm_scoring.scores(docs, empty).where("n_tokens > 0").collect()} == {False}
    assert lm_scoring.scores(empty, docs).count() == 0


def test_word_hashes():
    long = lm_scoring.STRETCH
    texts = ["a b a", None, "", " \t", "Ab aB ab\x0bx", "é " + "y" * (2 * long) + " z " + "Y" * (2 * long),
             "w" * (long // 2) + " q " + "w" * (long // 2 - 1) + " Q " + "v" * (long + 1)]
    expected = [(i, w) for i, t in enumerate(texts) for w in (t or "").encode().lower().split()]
    for array in (pa.array(texts), pa.array(["cut", *texts]).slice(1)):
        hashes, owner = lm_scoring.words(*lm_scoring._flat(array))
        assert owner.tolist() == [i for i, _ in expected]
        seen = {}
        for (_, word), value in zip(expected, hashes.tolist(), strict=True):
            assert seen.setdefault(word, value) == value
        assert len(set(seen.values())) == len(seen)
