"""Order MinHash, the compiled rules and the toxicity scoring path against plain evaluations."""

import hashlib
import math
import random
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from devpulse.llm import order_minhash, quality, toxicity

ODD = ["", " ", "one", "one two", " lead and trail ", "a b c " * 40, "É é ça\x0bva\tbien", "x" * 3000]


# --- order MinHash ------------------------------------------------------------------

def chained(*values):
    """Spark's xxhash64 of several columns: each hash is the seed of the next; longs are given as bytes."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else v, seed)
    return seed


def signature(text, k=3, length=2, bins_log2=6):
    bits = 37
    ws = re.split(r"[ \t\n\v\f\r]+", text)
    seen, items = Counter(), []
    for at in range(max(len(ws) - k, 0) + 1):
        h = chained(*ws[at:at + k]) % 2**bits
        items.append((chained(struct.pack("<q", h), struct.pack("<i", seen[h])) % 2**bits, at))
        seen[h] += 1
    bins = defaultdict(list)
    for item in sorted(items):
        bins[item[0] >> (bits - bins_log2)].append(item)
    filled = sorted(bins)
    line = [item for b in filled for item in bins[b][:length]]
    out = []
    for b in filled:
        i = line.index(bins[b][0])
        taken = sorted((line[(i + j) % len(line)] for j in range(length)), key=lambda item: item[1])
        out.append(b << 24 | chained(*(struct.pack("<q", h) for h, _ in taken)) % 2**24)
    return out


def likeness(a, b):
    return len(set(a) & set(b)) / len({x >> 24 for x in a} | {x >> 24 for x in b})


def test_order_minhash_equals_the_plain_evaluation(spark):
    rng = random.Random(5)
    names = [f"w{i}" for i in range(25)]
    texts = ODD + [" ".join(rng.choices(names, k=rng.randint(1, 150))) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in order_minhash.edited_fingerprints(docs).collect()}
    assert len(out) == len(texts)
    for i, text in enumerate(texts):
        after = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, changed = signature(text), signature(edited)
        assert out[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert out[i].fingerprint == "".join(f"{x:08x}" for x in own)
        assert out[i].edited_fingerprint == "".join(f"{x:08x}" for x in changed)
        assert out[i].near_edited == pytest.approx(likeness(own, changed))
        assert out[i].near_next == pytest.approx(likeness(own, signature(after)))


# --- quality rules ------------------------------------------------------------------

def test_compiled_rules_equal_their_evaluation(spark):
    rng = random.Random(3)
    names = ["_stat_a", "_stat_b", "_stat_c"]
    values = [0.0, 0.1, 0.25, 1 / 3, 1.0, 7.5]
    rules = []
    for _ in range(40):
        bounds = []
        for name in rng.sample(names, rng.randint(1, 3)):
            low, high = sorted(rng.sample([-math.inf, *values, math.inf], 2))
            bounds.append((name, low, high))
        rules.append((quality.Rule(tuple(bounds)), rng.uniform(-2, 2)))
    # A bound on neither side is no rule of a tree.
    rules = [(r, w) for r, w in rules if r.condition()]
    model = quality.RuleModel(-0.3, tuple(rules))
    rows = [tuple(rng.choice(values) for _ in names) for _ in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    for r in df.select("*", model.score().alias("score")).collect():
        odds = model.start + sum(w for rule, w in rules if all(low < r[n] <= high for n, low, high in rule.bounds))
        assert r.score == pytest.approx(1 / (1 + math.exp(-odds)))


def test_rules_of_fitted_trees_are_their_paths(spark):
    rng = random.Random(1)
    rows = [(a := rng.random(), b := rng.random(), int(a > 0.5 and b <= 0.4)) for _ in range(400)]
    df = spark.createDataFrame(rows, "_stat_a double, _stat_b double, label int")
    model = quality.fit(df, ["_stat_a", "_stat_b"], trees=5, depth=3, lasso=0.002)
    right = 0
    for r in df.select("*", model.score().alias("score")).collect():
        odds = model.start + sum(w for rule, w in model.rules if all(low < r[n] <= high for n, low, high in rule.bounds))
        assert r.score == pytest.approx(1 / (1 + math.exp(-odds)))
        right += (r.score > 0.5) == r.label
    assert right >= 0.95 * len(rows)


# --- toxicity -----------------------------------------------------------------------

def test_scoring_path_equals_the_model(spark):
    rng = np.random.default_rng(2)
    texts = [*ODD, None, "You AWFUL awful women!", "it's a well-known man's\x1cworld", "ΣΑΣ İstanbul ½²", "men men men"]
    found = np.array(sorted(set().union(*(toxicity.features(t) for t in texts))), np.int64)
    model = toxicity.ToxicModel(-0.5, found[::2], rng.normal(size=len(found[::2])))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.score for r in toxicity._scored(docs, model, "doc_id", "text").collect()}
    assert out == {i: pytest.approx(model.score(t)) for i, t in enumerate(texts)}


def test_penalty_lowers_the_score_change_of_neutral_mentions():
    """Insults name one group more often than its counterparts; neutral sentences must not pay for it."""
    group = toxicity.IDENTITY_GROUPS[0]
    named, others = group[0], group[1:]
    texts = [(f"{insult} {named} go away", 1) for insult in ("awful", "stupid", "filthy", "rotten") for _ in range(10)]
    texts += [(f"{insult} {other} go away", 1) for insult in ("awful", "stupid") for other in others]
    texts += [(f"the {term} met at {place}", 0) for place in ("noon", "home", "work") for term in [*others] * 5]
    rows = [toxicity.features(t) for t, _ in texts]
    chosen = np.array(sorted(set().union(*rows)), np.int64)
    own = [toxicity._positions(r, chosen) for r in rows]
    pairs = [(a, toxicity._positions(toxicity.features(c), chosen))
             for a, (t, _) in zip(own, texts) for c in toxicity.counterfactuals(t)]
    assert len(pairs) >= len(texts)
    change = []
    for penalty in (0.0, toxicity.PAIR_PENALTY):
        start, weights = toxicity.fit(np.array([y for _, y in texts]), own, pairs, len(chosen), penalty)
        model = toxicity.ToxicModel(start, chosen, weights)
        change.append(max(abs(model.score(f"the {named} met at noon") - model.score(f"the {o} met at noon")) for o in others))
        assert model.score(f"awful {others[0]} go away") > 0.5
    assert change[1] < 0.5 * change[0]
