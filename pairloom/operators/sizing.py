"""Joins with a side table whose size is measured before it is broadcast."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row, functions as F

LITERAL_BYTES = 8 * 1024 * 1024
LITERAL_KEY_CHARS = 1_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16


def collect_small(df: DataFrame, max_rows: int = 10_000) -> DataFrame | None:
    """``df`` as a local table if it has at most ``max_rows`` rows, else None.

    One job that fetches at most ``max_rows + 1`` rows; the result is computed
    once, and Catalyst knows its size.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def measure(df: DataFrame, key: str | None = None) -> Row:
    """``rows``, ``bytes``, ``longest`` and ``different`` keys of a stored table, read
    once. Bytes are its text and arrays, plus a fixed part per row."""
    width = F.lit(64)
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "string":
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif kind in ("array", "map"):
            width = width + 16 * F.coalesce(F.greatest(F.size(field.name), F.lit(0)), F.lit(0))
    longest = F.max(F.length(key)) if key else F.lit(0)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("bytes"),
        F.coalesce(longest, F.lit(0)).alias("longest"),
        (F.count_distinct(key) + F.count_if(F.col(key).isNull()) if key else F.count(F.lit(1))).alias("different"),
    ).first()


def require_unique(df: DataFrame, key: str) -> None:
    """An error if two rows of ``df`` have one ``key``; nulls count as a value."""
    again = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if again:
        raise ValueError(f"{key} {again[0][0]!r} is not unique")


def literal_lookup(
    table: DataFrame, key: str, value: Column, max_bytes: int = LITERAL_BYTES, size: Row | None = None
) -> Callable[[Column], Column] | None:
    """A function from a key column to its ``value`` in a small stored table, to
    be used inside any expression: no join, no explode, no shuffle. None if the
    table measures more than ``max_bytes``.

    The table becomes one constant of the plan: an array of maps, each key in the
    map its hash names. Spark searches a map from end to end, so maps are kept to
    a few keys.
    """
    size = size or measure(table, key)
    if size["bytes"] > max_bytes or size["longest"] > LITERAL_KEY_CHARS:
        return None
    buckets = max(1, size["rows"] // 4)

    def bucket(column):
        return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")

    entry = F.struct(F.col(key).alias("key"), value.alias("value"))
    entries = table.where(F.col(key).isNotNull()).select(bucket(F.col(key)).alias("at"), entry.alias("entry"))
    maps = entries.groupBy("at").agg(F.map_from_entries(F.collect_list("entry")).alias("map"))
    texts = ["{}"] * buckets
    for row in maps.select("at", F.to_json("map").alias("text")).collect():
        texts[row["at"]] = row["text"]
    kind = table.select(value.alias("value")).schema["value"].dataType.simpleString()
    constant = F.from_json(F.lit(f"[{','.join(texts)}]"), f"array<map<string,{kind}>>")
    return lambda column: F.try_element_at(F.element_at(constant, bucket(column) + 1), column)


def join_table(
    df: DataFrame,
    table: DataFrame,
    on: str,
    spread: Column,
    how: str = "left",
    max_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
    size: Row | None = None,
) -> DataFrame:
    """Join ``df`` to a stored ``table`` with one row per ``on``.

    Within ``max_bytes`` the table is broadcast. Beyond it each table row is
    copied ``salts`` times and the rows of ``df`` are dealt over the copies by
    the hash of ``spread``, so a value held by a third of all rows is met by
    ``salts`` tasks, and the adaptive skew join splits those further.
    """
    if (size or measure(table))["bytes"] <= max_bytes:
        return df.join(F.broadcast(table), on, how)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [on, "_salt"], how).drop("_salt")
