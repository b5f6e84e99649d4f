"""A Kafka-shaped envelope derived from the ``events`` table.

The payload follows the JSON event contract. Bad rows, duplicates and
time-format variety are injected by integer arithmetic on ``event_id`` only,
so the same rows can be recomputed independently in SQL. The derivation is
a projection plus a filtered union: it scales with ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _mod(n: int) -> Column:
    return F.pmod(F.col("event_id"), F.lit(n))


def _event_time_text() -> Column:
    ts = F.col("ts").cast("timestamp")
    # fixed values: four ISO-8601 spellings chosen by event_id % 4
    micros_offset = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    seconds_offset = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    micros_z = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    seconds_z = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    k = _mod(4)
    return (F.when(k == 0, micros_offset).when(k == 1, seconds_offset)
            .when(k == 2, micros_z).otherwise(seconds_z))


def payload_struct(null_city_every: int = 0) -> Column:
    """The event as a struct, with the deterministic injections applied.

    ``null_city_every`` n > 0: the city is NULL where event_id % n = 0."""
    eid = F.col("event_id")
    latitude = F.when(_mod(97) == 3, F.lit(200.0)).otherwise((_mod(181) - 90).cast("double"))
    longitude = (_mod(361) - 180).cast("double")
    signal = F.when(_mod(89) == 5, F.lit(-200)).otherwise(-_mod(121)).cast("int")
    battery = F.when(_mod(83) == 7, F.lit(150)).otherwise(
        F.get_json_object("props", "$.k").cast("int"))
    duration = F.when(_mod(79) == 11, F.lit(-5.0)).otherwise(F.col("value"))
    city = F.concat(F.lit("city_"), _mod(20).cast("string"))
    if null_city_every:
        city = F.when(_mod(null_city_every) != 0, city)
    firmware = F.concat_ws(".", (1 + _mod(5)).cast("string"), _mod(10).cast("string"), F.lit("0"))
    return F.struct(
        F.when(_mod(101) == 13, F.lit(None).cast("long")).otherwise(eid).alias("event_id"),
        F.concat(F.lit("dev_"), F.col("user_id").cast("string")).alias("device_id"),
        F.col("event_type").alias("device_type"),
        _event_time_text().alias("event_time"),
        duration.alias("event_duration"),
        F.struct(
            latitude.alias("latitude"),
            longitude.alias("longitude"),
            city.alias("city"),
            F.concat(F.lit("country_"), _mod(7).cast("string")).alias("country"),
        ).alias("location"),
        F.struct(
            firmware.alias("firmware_version"),
            battery.alias("battery_level"),
            signal.alias("signal_strength"),
        ).alias("metadata"),
    )


def build_envelope(events: DataFrame, with_duplicates: bool = True, null_city_every: int = 0) -> DataFrame:
    """``events`` -> rows shaped like the Kafka source.

    key = device id, value = JSON text (``not json`` for event_id % 103 = 17),
    partition = event_id % 4, offset = event_id, timestamp = ts.
    With ``with_duplicates`` rows with event_id % 10 = 0 appear twice.
    """
    payload = F.to_json(payload_struct(null_city_every), {"ignoreNullFields": "false"})
    value = F.when(_mod(103) == 17, F.lit("not json")).otherwise(payload)
    env = events.select(
        F.concat(F.lit("dev_"), F.col("user_id").cast("string")).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit("input_events").alias("topic"),
        _mod(4).cast("int").alias("partition"),
        F.col("event_id").cast("long").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).cast("int").alias("timestampType"),
    )
    if with_duplicates:
        copies = events.filter(_mod(10) == 0)
        env = env.unionByName(build_envelope(copies, False, null_city_every))
    return env


def dense_events(events: DataFrame) -> DataFrame:
    """``events`` folded into 4 devices and 40 minutes, so that windows hold many events."""
    folded = F.timestamp_micros(F.unix_micros(F.lit("2024-01-01").cast("timestamp"))
                                + F.pmod(F.unix_micros(F.col("ts").cast("timestamp")), F.lit(2_400_000_000)))
    return events.withColumn("user_id", F.pmod("user_id", F.lit(4))).withColumn("ts", folded)


def with_missing_payloads(envelope: DataFrame) -> DataFrame:
    """The envelope with a NULL value where offset % 107 = 19 and an empty one where offset % 109 = 23."""
    offset = F.col("offset")
    return envelope.withColumn(
        "value", F.when(F.pmod(offset, F.lit(107)) == 19, F.lit(None))
        .when(F.pmod(offset, F.lit(109)) == 23, F.lit("").cast("binary")).otherwise(F.col("value")))


def with_broken_payloads(envelope: DataFrame) -> DataFrame:
    """The envelope with, in the JSON text, the battery level left out where offset % 43 = 7, a null device type where
    offset % 47 = 9, the duration as text where offset % 53 = 11 and an array for the location where offset % 59 = 13."""
    text = F.col("value").cast("string")
    for n, r, pattern, instead in ((43, 7, r'"battery_level":[^,}]*,', ""), (47, 9, r'"device_type":"[^"]*"', '"device_type":null'),
                                   (53, 11, r'"event_duration":([-+.0-9eE]+)', r'"event_duration":"$1"'),
                                   (59, 13, r'"location":\{[^}]*\}', '"location":[1]')):
        text = F.when(F.pmod("offset", F.lit(n)) == r, F.regexp_replace(text, pattern, instead)).otherwise(text)
    return envelope.withColumn("value", text.cast("binary"))
