"""Data-quality operators on the stored windows and on the report
(DQ1-DQ8, DQ11, AGG7-AGG10).

Each check is a DataFrame whose rows are findings, so checks compose, can be
written out, and run as one job. Statistics come from a single aggregate
pass; schema facts (column names and types) are plan metadata and never
touch the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from devpulse import constants as C
from devpulse import schemas

CHECK_SCHEMA = "check string, scope string, observed double, status string"


# --- simple statistics -----------------------------------------------------

def row_count(df: DataFrame) -> DataFrame:
    """AGG10."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def event_count_stats(df: DataFrame) -> DataFrame:
    """AGG7: global count and avg/max/min of event_count."""
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.avg("event_count").alias("avg_event_count"),
        F.max("event_count").alias("max_event_count"),
        F.min("event_count").alias("min_event_count"),
    )


def type_distribution(df: DataFrame) -> DataFrame:
    """AGG8: rows per device_type."""
    return df.groupBy("device_type").agg(F.count(F.lit(1)).alias("row_count"))


def distinct_types(df: DataFrame) -> DataFrame:
    """AGG9."""
    return df.select("device_type").distinct()


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """DQ2: NULLs per column in one aggregate -> (column_name, null_count)."""
    cols = [c for c in (cols or C.CRITICAL_WINDOW_COLUMNS) if c in df.columns]
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, null_count bigint")
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (column_name, null_count)")


def check_non_empty(df: DataFrame) -> DataFrame:
    """DQ3: one row; zero rows fails. Stops at the first row found."""
    n = df.limit(1).agg(F.count(F.lit(1)).alias("n"))
    return n.select(
        F.lit("non_empty").alias("check"), F.lit("all").alias("scope"),
        F.col("n").cast("double").alias("observed"),
        F.when(F.col("n") > 0, "pass").otherwise("fail").alias("status"),
    )


# --- DQ1: column check ------------------------------------------------------

def check_columns(df: DataFrame, expected: list[str] | None = None,
                  critical: list[str] | None = None) -> DataFrame:
    """DQ1: per expected or present column: presence, type, rows, NULLs, status.

    status: ``fail`` for a missing critical column, ``warn`` for another
    missing one, ``extra`` for an unexpected one, else ``ok``. Names compare
    as sets; counts come from one aggregate over the present columns.
    """
    expected = list(expected or C.WINDOW_COLUMNS)
    critical = set(critical or C.CRITICAL_WINDOW_COLUMNS)
    present = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = list(present)
    counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                    *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    return _column_table(df, counts, expected, critical)


def _column_table(df: DataFrame, counts: DataFrame, expected: list[str], critical: set) -> DataFrame:
    """DQ1 findings from the schema and a one-row frame (``__rows``, ``n<i>``
    = NULLs of the i-th column of ``df``)."""
    spark = df.sparkSession
    present = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = expected + [c for c in df.columns if c not in expected]
    meta = spark.createDataFrame(
        [(n, n in expected, n in present, present.get(n), n in critical) for n in names],
        "column_name string, expected boolean, present boolean, data_type string, critical boolean",
    )
    cols = list(present)
    pairs = ", ".join(f"'{c}', n{i}" for i, c in enumerate(cols))
    per_col = counts.selectExpr("__rows", f"stack({len(cols)}, {pairs}) as (column_name, null_count)")
    out = meta.join(F.broadcast(per_col), "column_name", "left")
    status = (F.when(~F.col("present") & F.col("critical"), "fail")
              .when(~F.col("present"), "warn")
              .when(~F.col("expected"), "extra")
              .otherwise("ok"))
    return out.select(
        "column_name", "expected", "present", "data_type",
        F.when(F.col("present"), F.col("__rows")).alias("row_count"),
        F.col("null_count").cast("bigint").alias("null_count"),
        status.alias("status"),
    )


# --- DQ4: the combined quality table ----------------------------------------

def quality_report(df: DataFrame) -> DataFrame:
    """DQ4: DQ2 + DQ3 + AGG7 + AGG8 from one pass over the data.

    One aggregate by device_type computes counts, NULL counts and event_count
    sums/extremes; the global figures are folded from those few rows, and the
    result is unpivoted to (check, scope, observed, status).
    """
    has_count = "event_count" in df.columns
    crit = [c for c in C.CRITICAL_WINDOW_COLUMNS if c in df.columns]
    per_type = df.groupBy("device_type").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in crit],
        *([F.sum("event_count").alias("sum_ec"), F.count("event_count").alias("cnt_ec"),
           F.max("event_count").alias("max_ec"), F.min("event_count").alias("min_ec")] if has_count else []),
    )
    return _quality_table(per_type, crit, has_count)


def _quality_table(per_type: DataFrame, crit: list[str], has_count: bool) -> DataFrame:
    """DQ4 findings folded from per-type rows (rows, null_<c>, sum/cnt/max/min_ec)."""
    totals = per_type.agg(
        F.sum("rows").alias("rows"),
        *[F.sum(f"null_{c}").alias(f"null_{c}") for c in crit],
        *([(F.sum("sum_ec") / F.sum("cnt_ec")).alias("avg_ec"), F.max("max_ec").alias("max_ec"),
           F.min("min_ec").alias("min_ec")] if has_count else []),
    )
    items = ["'row_count', 'all', cast(coalesce(rows, 0) as double), "
             "if(coalesce(rows, 0) > 0, 'pass', 'fail')"]
    items += [f"'null_{c}', 'all', cast(null_{c} as double), if(null_{c} > 0, 'warn', 'pass')" for c in crit]
    if has_count:
        items += ["'avg_event_count', 'all', cast(avg_ec as double), 'info'",
                  "'max_event_count', 'all', cast(max_ec as double), 'info'",
                  "'min_event_count', 'all', cast(min_ec as double), 'info'"]
    global_rows = totals.selectExpr(f"stack({len(items)}, {', '.join(items)}) as (check, scope, observed, status)")
    type_rows = per_type.select(F.lit("type_count").alias("check"), F.col("device_type").alias("scope"),
                                F.col("rows").cast("double").alias("observed"), F.lit("info").alias("status"))
    return global_rows.unionByName(type_rows)


# --- DQ5: partition check -----------------------------------------------------

def check_partitions(df: DataFrame, column: str = "device_type") -> DataFrame:
    """DQ5: distinct types, and rows whose ``column=`` path segment differs
    from the column value (read through the hidden ``_metadata`` column of a
    file scan)."""
    seg = _path_segment(column)
    return df.select(F.col(column), seg.alias("_seg")).agg(
        F.countDistinct(column).alias("distinct_types"),
        F.count_if((F.col("_seg") != "") & (F.col("_seg") != _directory_value(column))).alias("mismatched_rows"),
        F.count_if(F.col("_seg") == "").alias("rows_outside_partitions"),
    )


def _path_segment(column: str) -> F.Column:
    """The directory's value for ``column``: the path is URL-encoded, and
    inside it the partition value is escaped again (``%3A`` for a colon)."""
    def decoded(c: F.Column) -> F.Column:   # a plus sign is itself in a path
        return F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))

    return decoded(decoded(F.regexp_extract(F.col("_metadata.file_path"), f"/{column}=([^/]+)", 1)))


def _directory_value(column: str) -> F.Column:
    """What the directory of a row should say; NULL has a name of its own."""
    return F.coalesce(F.col(column).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))


# --- DQ1 + DQ4 + DQ5 in one pass ----------------------------------------------

def store_profile(df: DataFrame, column: str = "device_type", with_partitions: bool = True) -> DataFrame:
    """One aggregate by ``column`` over the stored windows: rows, NULLs of
    every column, event_count sum/count/max/min and, for a file scan, rows
    whose directory disagrees with the value. Few rows (one per type)."""
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)]
    if "event_count" in cols:
        aggs += [F.sum("event_count").alias("sum_ec"), F.count("event_count").alias("cnt_ec"),
                 F.max("event_count").alias("max_ec"), F.min("event_count").alias("min_ec")]
    if with_partitions:
        seg = _path_segment(column)
        aggs += [F.count_if((seg != "") & (seg != _directory_value(column))).alias("mismatched_rows"),
                 F.count_if(seg == "").alias("rows_outside_partitions")]
    return df.groupBy(column).agg(*aggs)


def store_checks(df: DataFrame, with_partitions: bool = True) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(DQ1, DQ4, DQ5) tables from one scan of ``df`` (grouped by device_type).

    The profile (one row per type) is written once to the shared checkpoint
    folder and the three tables are folded from it. Left lazy, each table
    would prune the profile differently and re-read the store.
    """
    from devpulse.plans.staging import stage_table
    profile = stage_table(store_profile(df, with_partitions=with_partitions), "store-profile")
    cols = df.columns
    counts = profile.agg(F.sum("rows").alias("__rows"),
                         *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(cols))])
    columns = _column_table(df, counts, list(C.WINDOW_COLUMNS), set(C.CRITICAL_WINDOW_COLUMNS))
    has_count = "event_count" in cols
    crit = [c for c in C.CRITICAL_WINDOW_COLUMNS if c in cols]
    per_type = profile.select(
        "device_type", "rows", *[F.col(f"n{cols.index(c)}").alias(f"null_{c}") for c in crit],
        *(["sum_ec", "cnt_ec", "max_ec", "min_ec"] if has_count else []))
    quality = _quality_table(per_type, crit, has_count)
    parts = None
    if with_partitions:
        parts = profile.agg(
            F.count("device_type").alias("distinct_types"),
            F.coalesce(F.sum("mismatched_rows"), F.lit(0)).alias("mismatched_rows"),
            F.coalesce(F.sum("rows_outside_partitions"), F.lit(0)).alias("rows_outside_partitions"),
        )
    return columns, quality, parts


# --- DQ6: report check ------------------------------------------------------

def _blank(c: str) -> F.Column:
    return F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"^\s+|\s+$", ""), F.lit("")) == ""


def validate_report(df: DataFrame, min_total_events: int = C.REPORT_MIN_TOTAL_EVENTS) -> DataFrame:
    """DQ6: six checks on a report (typed, or read as text by SRC6).

    A row is valid when type and date are non-blank and percentile_95,
    mean_duration, total_events and distinct_devices are all > 0 (values that
    do not convert count as invalid). total_events >= threshold is checked on
    valid rows only; an empty report fails; stddev is not checked; columns
    are compared as a set.
    """
    names = set(df.columns)
    columns_match = names == set(C.REPORT_COLUMNS)
    need = ["device_type", "event_date", "percentile_95", "mean_duration", "total_events", "distinct_devices"]
    if not set(need) <= names:
        rows = [("has_header", "all", float(len(names)), "pass" if names else "fail"),
                ("columns_match", "all", float(len(names)), "fail")]
        return df.sparkSession.createDataFrame(rows, CHECK_SCHEMA)

    def num(c: str, t: str) -> F.Column:
        return F.col(c).cast("string").try_cast(t)

    def positive(c: str) -> F.Column:       # Spark orders NaN above every number
        return F.coalesce((num(c, "double") > 0) & ~F.isnan(num(c, "double")), F.lit(False))

    valid = (~_blank("device_type") & ~_blank("event_date")
             & positive("percentile_95") & positive("mean_duration")
             & F.coalesce(num("total_events", "bigint") > 0, F.lit(False))
             & F.coalesce(num("distinct_devices", "bigint") > 0, F.lit(False)))
    low = valid & (num("total_events", "bigint") < F.lit(min_total_events))
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(valid).alias("v"), F.count_if(low).alias("low"))
    cm = "pass" if columns_match else "fail"
    return agg.selectExpr(
        "stack(5,"
        f" 'has_header', 'all', cast({len(names)} as double), 'pass',"
        f" 'columns_match', 'all', cast({len(names)} as double), '{cm}',"
        " 'has_data', 'all', cast(n as double), if(n > 0, 'pass', 'fail'),"
        " 'data_valid', 'all', cast(n - v as double), if(v = n, 'pass', 'fail'),"
        " 'min_events_check', 'all', cast(low as double), if(low = 0, 'pass', 'fail')"
        ") as (check, scope, observed, status)"
    )


# --- DQ7: JSON contract -----------------------------------------------------

# The contract's date-time: a date, a time with seconds, and an offset.
_DATE_TIME = r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"


def contract_rules() -> list[tuple[str, F.Column]]:
    """(label, condition) for each JSON-contract rule, on a parsed payload ``parsed_data``."""
    from devpulse.functions.time import parse_event_time_expr
    p = "parsed_data"
    rules = [("malformed_json", F.col(f"{p}._corrupt_record").isNotNull())]
    for name in C.REQUIRED_TOP_LEVEL:
        rules.append((f"required:{name}", F.col(f"{p}.{name}").isNull()))
    for parent, names in (("location", C.REQUIRED_LOCATION), ("metadata", C.REQUIRED_METADATA)):
        for name in names:
            rules.append((f"required:{parent}.{name}",
                          F.col(f"{p}.{parent}").isNotNull() & F.col(f"{p}.{parent}.{name}").isNull()))
    dt = F.col(f"{p}.device_type")
    rules.append(("enum:device_type", dt.isNotNull() & ~dt.isin(*C.DEVICE_TYPES)))
    et = F.col(f"{p}.event_time")
    rules.append(("format:event_time", et.isNotNull() & (~et.rlike(_DATE_TIME) | parse_event_time_expr(et).isNull())))
    bl = F.col(f"{p}.metadata.battery_level")
    rules.append(("range:battery_level", bl.isNotNull() & ((bl < C.BATTERY_MIN) | (bl > C.BATTERY_MAX))))
    ss = F.col(f"{p}.metadata.signal_strength")
    rules.append(("range:signal_strength", ss.isNotNull() & ((ss < C.SIGNAL_MIN) | (ss > C.SIGNAL_MAX))))
    return rules


def validate_contract(parsed: DataFrame) -> DataFrame:
    """DQ7: parsed payloads (PRJ2 output) tagged with ``contract_violations``."""
    from devpulse.functions.predicates import reasons_array
    return parsed.withColumn("contract_violations", reasons_array(contract_rules()))


def split_contract(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """DQ7: (accepted payloads, rejected payloads with their violations)."""
    tagged = validate_contract(parsed)
    return (tagged.filter(F.size("contract_violations") == 0).drop("contract_violations"),
            tagged.filter(F.size("contract_violations") > 0))


def rule_counts(df: DataFrame, rules: list[tuple[str, F.Column]], label: str = "rule") -> DataFrame:
    """Rows breaking each rule (a row breaking two rules counts in both).

    One partial aggregate of ``count_if`` per rule, unpivoted with ``stack``;
    rules nobody breaks are left out.
    """
    wide = df.agg(*[F.count_if(cond).alias(f"r{i}") for i, (_, cond) in enumerate(rules)])
    pairs = ", ".join(f"'{name}', r{i}" for i, (name, _) in enumerate(rules))
    long = wide.selectExpr(f"stack({len(rules)}, {pairs}) as ({label}, row_count)")
    return long.filter(F.col("row_count") > 0)


def contract_violation_counts(parsed: DataFrame) -> DataFrame:
    """DQ7 summary: rows per broken contract rule."""
    return rule_counts(parsed, contract_rules(), "rule")


def reject_reason_counts(flat: DataFrame) -> DataFrame:
    """DQ10 summary: rows per reason FLT7 would drop them."""
    from devpulse.functions.predicates import reject_rules
    return rule_counts(flat, reject_rules("_corrupt_record" in flat.columns), "reason")


# --- DQ8 / DQ11: storage inventory ------------------------------------------

def storage_inventory(spark: SparkSession, path: str, glob: str = "*.parquet") -> DataFrame:
    """DQ8: one row per data file: path, bytes and its partition values.

    The ``binaryFile`` source lists files and, with ``content`` not selected,
    never reads their bytes; partition directories come back as columns.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    keep = [c for c in files.columns if c not in ("content", "modificationTime")]
    return files.select(*keep)


def inventory_summary(inventory: DataFrame, by: str = "device_type") -> DataFrame:
    """DQ8: files, bytes and partition directories per ``by`` value."""
    parent = F.regexp_replace(F.col("path"), "/[^/]*$", "")
    return inventory.groupBy(by).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.countDistinct(parent).alias("partitions"),
    )


def inventory_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """DQ11: files present in ``after`` but not in ``before`` (anti-join on path)."""
    return after.join(before.select("path"), "path", "left_anti")
