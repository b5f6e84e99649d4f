"""Order MinHash fingerprints, from DataFrame functions only.

The k-mers of a text are runs of ``k`` words (split at white space), numbered
by occurrence: the second time the same k-mer appears it is another item. Each
item is hashed once; the hash deals the items to ``bins`` bins and orders them
inside. Of every bin the ``length`` smallest items are taken, put back into
text order and hashed as a tuple. A bin with fewer items takes the smallest
ones of the filled bins after it (after the last comes the first), so that
short texts, whose bins hold one item or none, keep their order too. Two texts
agree in a bin only if the same items come in the same order, so that moved
text lowers the likeness as an edit distance does. Likeness is the share of equal tuples among the bins that
either text fills.

Everything happens inside a row on sorted arrays of longs: a k-mer's key is its
hash and its position, so one sort brings equal k-mers together in text order
and their number is the distance to the start of the run.

Defined results: a null text is an empty one; an empty text has one k-mer (the
empty word); a text shorter than a k-mer is one k-mer. Equal texts have equal
fingerprints. Positions hold up to 2**26 words, more than a row can.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devpulse.plans.staging import stage_table

K, LENGTH, BINS_LOG2 = 3, 2, 6
#: Sampled places that make the bounds of one part, about.
PER_PART = 32
POSITION = 26  # bits of a position in a key
HASH = 63 - POSITION  # bits of a hash in a key


def _key(hashed: Column, position: Column) -> Column:
    low = F.lit((1 << HASH) - 1).cast("long")
    return F.shiftleft(hashed.bitwiseAND(low), POSITION).bitwiseOR(position.cast("long"))


def with_signature(df: DataFrame, text: str, name: str, k: int = K, length: int = LENGTH,
                   bins_log2: int = BINS_LOG2) -> DataFrame:
    """Add ``name``: the tuples as sorted longs, bin above 24 bits of tuple hash."""
    w, s, starts, t, sel = (f"_{name}_{c}" for c in ("words", "keys", "starts", "items", "kept"))
    bin_at = 63 - bins_log2
    mask = F.lit((1 << POSITION) - 1).cast("long")

    def shingle(i: Column) -> Column:
        return _key(F.xxhash64(*(F.get(w, i + j) for j in range(k))), i)

    def kmer(x: Column) -> Column:
        return F.shiftright(x, POSITION)

    def item(x: Column, number: Column) -> Column:
        return _key(F.xxhash64(kmer(x), number), x.bitwiseAND(mask))

    def bin_of(x: Column) -> Column:
        return F.shiftright(x, bin_at)

    numbers = F.flatten(F.transform(starts, lambda p, r: F.sequence(
        F.lit(0), F.coalesce(F.get(starts, r + 1), F.size(s)) - p - 1)))
    df = (df.withColumn(w, F.split(text, r"\s+"))
          .withColumn(s, F.sort_array(F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))), shingle)))
          .withColumn(starts, F.filter(F.transform(s, lambda x, i: F.when(
              (i > 0) & (kmer(x) == kmer(F.get(s, i - 1))), -1).otherwise(i)), lambda i: i >= 0))
          .withColumn(t, F.sort_array(F.when(
              F.size(starts) == F.size(s), F.transform(s, lambda x: item(x, F.lit(0)))).otherwise(
              F.zip_with(s, numbers, item))))
          .withColumn(sel, F.filter(t, lambda x, i: (i < length) | (bin_of(x) != bin_of(F.get(t, i - length))))))

    def in_text_order(x: Column, i: Column) -> Column:
        # sel is sorted by bin: past the end of a bin come the smallest items of the next
        same = F.array(*(F.get(sel, (i + j) % F.size(sel)) for j in range(length)))
        turned = F.sort_array(F.transform(
            same, lambda y: F.shiftleft(y.bitwiseAND(mask), HASH).bitwiseOR(F.shiftright(y, POSITION))))
        ordered = F.transform(turned, lambda y: y.bitwiseAND(F.lit((1 << HASH) - 1).cast("long")))
        return F.shiftleft(bin_of(x), 24).bitwiseOR(F.xxhash64(ordered).bitwiseAND(F.lit(0xFFFFFF).cast("long")))

    tuples = F.transform(sel, lambda x, i: F.when((i > 0) & (bin_of(x) == bin_of(F.get(sel, i - 1))), F.lit(-1).cast("long"))
                         .otherwise(in_text_order(x, i)))
    return df.withColumn(name, F.filter(tuples, lambda x: x >= 0)).drop(w, s, starts, t, sel)


def fingerprint(signature: str) -> Column:
    """A signature as text, eight hex digits a tuple."""
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: str, b: str) -> Column:
    """Share of equal tuples among the bins filled in either signature, 0 to 1."""
    def bins(c: str) -> Column:
        return F.transform(c, lambda x: F.shiftright(x, 24))

    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(bins(a), bins(b)))


def with_parts(df: DataFrame, key: str, by: str) -> tuple[DataFrame, int]:
    """Add ``_place`` (the key, nulls first, and the hash of ``by``), ``_part`` and ``_first``; and the number of parts.

    Parts are consecutive places and of like size, however the keys lie and
    however many rows share one: their bounds come from a weighted sample of the
    places (about ``PER_PART`` a part, chosen by hash, equal ones counted
    together). A bound is a row's own place; ``_first`` marks the rows on it.
    """
    parts = 8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct(F.col(key).isNotNull().alias("known"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("key"),
                     F.xxhash64(by).alias("hash"))
    places = stage_table(df.select(place.alias("place")).select("place.*"), "places")
    columns = places.columns
    total, lowest = places.agg(F.count("*"), F.min(F.struct(*columns))).first()
    every = max(1, total // (parts * PER_PART))
    sample = (places.where(F.pmod(F.xxhash64(*columns), F.lit(every)) == 0)
              .groupBy(*columns).count().orderBy(*columns).collect())
    bounds, seen, per_part = [tuple(lowest)] if total else [], 0, sum(r["count"] for r in sample) / parts
    for *at, n in sample:
        if seen >= per_part * len(bounds) and tuple(at) != bounds[-1]:
            bounds.append(tuple(at))
        seen += n
    listed = F.from_json(F.lit(json.dumps([dict(zip(columns, at)) for at in bounds])),
                         "array<struct<known: boolean, key: bigint, hash: bigint>>")
    n = max(1, len(bounds))
    # the number of bounds up to a place, by halving steps
    steps = F.array(*(F.lit(1 << i) for i in reversed(range(n.bit_length()))))
    part = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(listed, at + step - 1) <= F.col("_place"), at + step).otherwise(at)) - 1
    return (df.withColumn("_place", place).withColumn("_part", part)
            .withColumn("_first", F.col("_place") == F.get(listed, F.col("_part"))), n)


def with_next(df: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Add ``next``, a struct of the ``values`` of the row after, by ascending key (after the last: the first).

    No global window: the first rows of a part (``with_parts``) also go to the
    part before as its last ones. Null keys come first; equal keys are ordered
    by the hash of the first value, then by the values. Only rows equal in key
    and first value always share a part.
    """
    placed, n = with_parts(df, key, values[0])
    before = F.struct(F.pmod(F.col("_part") - 1, F.lit(n)).alias("part"), F.lit(True).alias("ghost"))
    to = F.array(F.struct(F.col("_part").alias("part"), F.lit(False).alias("ghost")))
    ordered = (placed.withColumn("_to", F.explode(F.when(F.col("_first"), F.concat(to, F.array(before))).otherwise(to)))
               .select("*", F.col("_to.part").alias("_at"), F.col("_to.ghost").alias("_ghost"))
               .drop("_to", "_part", "_first"))
    follow = Window.partitionBy("_at").orderBy("_ghost", "_place", *values)
    return (ordered.withColumn("next", F.lead(F.struct(*values)).over(follow))
            .where(~F.col("_ghost")).drop("_at", "_ghost", "_place"))


def edited_fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text against itself with its second half replaced by the start of the next text, and against the next.

    ``key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.
    """
    own = df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    own = with_next(with_signature(own, "_text", "_sig"), key, ["_text", "_sig"])
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = (own.withColumn("n_chars", F.char_length("_text").cast("long"))
              .withColumn("_edited", F.concat(F.substring("_text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                                              F.substring(F.col("next._text"), F.lit(1), half)))
              .withColumn("_next_sig", F.col("next._sig")).drop("next", "_text"))
    both = with_signature(edited, "_edited", "_edited_sig")
    return both.select(
        key, "n_chars", F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint("_sig").alias("fingerprint"), fingerprint("_edited_sig").alias("edited_fingerprint"),
        likeness("_sig", "_edited_sig").alias("near_edited"), likeness("_sig", "_next_sig").alias("near_next"))
