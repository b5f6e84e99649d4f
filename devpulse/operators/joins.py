"""Joins against small tables: size-checked broadcast, salted fallback (JOIN3).

A side is broadcast only after its row count has been measured below a
bound; otherwise the join shuffles. A hot key on the big side is split across
``salts`` tasks: ``salted_join`` salts every key and replicates the whole small
side, ``skew_join`` finds the heavy keys first and treats only these so.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

# Bounds for broadcasting a side: its measured rows and bytes. Every executor
# holds a copy.
MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
DEFAULT_SALTS = 16
# A key with more than this share of the rows is salted by ``skew_join``.
HOT_SHARE = 0.005


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a frame in Spark's row format, by one distributed aggregate.

    Fixed-width fields take 8 bytes each; strings, binaries and nested values
    are measured row by row (nested ones by their JSON text). Call it on a
    materialized (written or checkpointed) side so the pass is cheap.
    """
    fixed = 8 + 8 * len(df.columns)
    size = F.lit(fixed)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            size = size + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    n, total = df.select(size.cast("long").alias("size")).agg(
        F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    return n, total


def salt_column(cols: list[str], salts: int) -> F.Column:
    """Deterministic salt from the row's own values (stable under task retry)."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), F.lit(salts)).cast("int")


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
                salts: int = DEFAULT_SALTS, salt_from: list[str] | None = None) -> DataFrame:
    """JOIN3: equi-join with the big side salted and the small side replicated.

    Valid for inner, left, left_semi and left_anti joins (each big-side row
    meets exactly one copy of each matching small-side row).
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"salted join does not preserve semantics for how={how!r}")
    salt_from = salt_from or big.columns
    b = big.withColumn("_salt", salt_column(salt_from, salts))
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = b.join(s, keys + ["_salt"], how)
    return joined.drop("_salt")


def heavy_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes (``xxhash64``) of the keys that hold more than ``share`` of the rows, at most 1 / share.

    A frequent-items sketch in one pass: it tracks a bounded number of items, never misses a key above the share
    and never counts one too low.
    """
    most = int(1 / share)
    found = df.select(F.xxhash64(*keys).alias("_h")).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_h, {most}, {min(1_000_000, 16 * most)})").alias("top")).first()
    return [t["item"] for t in found["top"] or [] if t["count"] > share * found["n"] and t["item"] is not None]


def skew_join(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner", salts: int = DEFAULT_SALTS,
              share: float = HOT_SHARE, salt_from: list[str] | None = None) -> DataFrame:
    """JOIN3 for a few hot keys: only rows of heavy keys are salted, and only their small-side rows replicated.

    ``big`` is read once more for the sketch. Valid for the joins that ``salted_join`` is valid for.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"salted join does not preserve semantics for how={how!r}")
    hot = heavy_keys(big, keys, share)
    is_hot = F.xxhash64(*keys).isin(hot) if hot else F.lit(False)
    b = big.withColumn("_salt", F.when(is_hot, salt_column(salt_from or big.columns, salts)).otherwise(0))
    s = small.withColumn("_salt", F.explode(
        F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return b.join(s, keys + ["_salt"], how).drop("_salt")


def join_small(big: DataFrame, small: DataFrame, keys: list[str], how: str = "inner",
               max_broadcast_rows: int = MAX_BROADCAST_ROWS, salts: int = DEFAULT_SALTS,
               max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``small`` when its measured size is bounded, else a shuffle join with heavy keys salted.

    The bound is on rows and on bytes, both measured (``measured_size``). ``small`` should be materialized (a staged
    table or a file scan): it is counted first and joined after, and an
    unmaterialized aggregate would be computed twice.
    """
    rows, size = measured_size(small)
    if rows <= max_broadcast_rows and size <= max_broadcast_bytes:
        return big.join(F.broadcast(small), keys, how)
    return skew_join(big, small, keys, how, salts)
