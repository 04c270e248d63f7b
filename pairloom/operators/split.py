"""Weighted samples, splits and shuffles that any run repeats exactly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from pairloom.functions import keys
from pairloom.operators.rank import BUCKET, bucket_offsets, with_position
from pairloom.operators.sizing import join_table
from pairloom.session import stored

SPLIT_NAMES = ("train_split", "valid_split", "test_split")
SPLIT_FRACTIONS = (0.6, 0.5, 1.0)


def draw_key(key: str, weight: str, seed: int) -> Column:
    """What a weighted draw orders rows by: arrival, then the id for a tie."""
    unit = keys.uniform(F.col(key), seed)
    return F.struct(
        keys.arrival(unit, F.col(weight)).alias("arrival"),
        unit.alias("unit"),
        F.col(key).alias("id"),
    )


def _taken(total: Column, fractions) -> list[Column]:
    """Rows drawn once each fraction is taken of what the earlier ones left;
    sizes round half to even."""
    ends, left = [], total.cast("double")
    for fraction in fractions:
        size = F.rint(left * fraction)
        left = left - size
        ends.append((total - left).cast("bigint"))
    return ends


def cut_keys(df: DataFrame, fractions, key: str, weight: str, seed: int) -> Column:
    """The draw keys of the last row of each fraction, as one scalar subquery.

    Counting rows per bucket tells which buckets the cuts fall in; only these,
    at most one per fraction, are sorted. No full sort and no shuffle of the table.
    """
    keyed = df.select(draw_key(key, weight, seed).alias("draw")).withColumn(
        BUCKET, keys.arrival_bucket(F.col("draw.arrival"), F.col("draw.unit"))
    )
    ends = F.array(*[
        F.struct(F.lit(i).alias("cut"), end.alias("rank"))
        for i, end in enumerate(_taken(F.col("total"), fractions))
    ])
    marked = (
        bucket_offsets(keyed)
        .select("*", F.inline(ends))
        .where((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("held")))
        .groupBy(BUCKET)
        .agg(F.collect_list(F.struct("cut", (F.col("rank") - F.col("before")).alias("rank"))).alias("cuts"))
    )
    inside = Window.partitionBy(BUCKET).orderBy("draw")
    return (
        keyed.join(F.broadcast(marked), BUCKET)
        .withColumn("_rank", F.row_number().over(inside))
        .select("draw", "_rank", F.inline("cuts"))
        .where(F.col("_rank") == F.col("rank"))
        .agg(F.map_from_entries(F.collect_list(F.struct("cut", "draw"))).alias("cuts"))
        .scalar()
    )


def weighted_sample(
    df: DataFrame,
    fraction: float,
    key: str = "pair_id",
    weight: str = "weight",
    seed: int = keys.SEED,
    population: DataFrame | None = None,
) -> DataFrame:
    """``round(fraction * n)`` rows without replacement, chance by weight.

    ``population`` may name a cheaper table of the same keys and weights to find
    the cuts in, such as a stored narrow copy.
    """
    cuts = cut_keys(df if population is None else population, (fraction,), key, weight, seed)
    return df.where(draw_key(key, weight, seed) <= F.try_element_at(cuts, F.lit(0)))


def weighted_split(
    df: DataFrame,
    fractions=SPLIT_FRACTIONS,
    names=SPLIT_NAMES,
    key: str = "pair_id",
    weight: str = "weight",
    seed: int = keys.SEED,
    population: DataFrame | None = None,
) -> DataFrame:
    """Successive weighted samples of what is left, as a ``split`` column.

    The draws share one order, so they are one order cut at several ranks. Each
    row is compared with the cut keys: a narrow projection. A last fraction of 1
    takes what is left and needs no cut; below 1, rows beyond it are dropped.
    ``population`` as in ``weighted_sample``.
    """
    whole = fractions[-1] >= 1
    limited = fractions[:-1] if whole else fractions
    cuts = cut_keys(df if population is None else population, limited, key, weight, seed)
    drawn = df.withColumns({"_draw": draw_key(key, weight, seed), "_cuts": cuts})
    split = F.lit(names[-1] if whole else None).cast("string")
    for i in reversed(range(len(limited))):
        inside = F.col("_draw") <= F.try_element_at("_cuts", F.lit(i))
        split = F.when(inside, F.lit(names[i])).otherwise(split)
    out = drawn.withColumn("split", split).drop("_draw", "_cuts")
    return out if whole else out.where("split IS NOT NULL")


def shuffled(
    df: DataFrame, key: str = "pair_id", seed: int = keys.SEED, epoch: int = 0, name: str = "position"
) -> DataFrame:
    """1-based position of every row in a random order of this seed and epoch."""
    mixed = df.withColumn("_mix", keys.digest(F.col(key), seed, epoch))
    order = [F.col("_mix"), F.col(key)]
    return with_position(mixed, keys.hex_bucket(F.col("_mix")), order, name).drop("_mix")


def class_cuts(df: DataFrame, fractions, by: str, key: str, seed: int) -> DataFrame:
    """(``_class``, ``cuts``): the order keys of the last row of each fraction of each class, stored.

    Rows are counted by class and bucket of their order; the cut ranks of a class follow from its
    count alone, and only the buckets they fall in, one per cut at most, are sorted.
    """
    digest = keys.digest(F.col(key), seed)
    order = F.struct(digest.alias("digest"), F.col(key).alias("id"))
    keyed = df.select(class_key(by), order.alias("order"), keys.hex_bucket(digest).alias(BUCKET))
    held = stored(keyed.groupBy("_class", BUCKET).agg(F.count(F.lit(1)).alias("held")), "class-buckets")
    whole, group = Window.partitionBy("_class"), Window.partitionBy("_class").orderBy(BUCKET)
    before = F.coalesce(F.sum("held").over(group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ends = F.array(*[
        F.struct(F.lit(i).alias("cut"), end.alias("rank")) for i, end in enumerate(_taken(F.col("total"), fractions))
    ])
    marked = (
        held.select("_class", BUCKET, "held", before.alias("before"), F.sum("held").over(whole).alias("total"))
        .select("*", F.inline(ends))
        .where((F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("held")))
        .groupBy("_class", BUCKET)
        .agg(F.collect_list(F.struct("cut", (F.col("rank") - F.col("before")).alias("rank"))).alias("ranks"))
    )
    inside = Window.partitionBy("_class", BUCKET).orderBy("order")
    found = (
        keyed.join(stored(marked, "class-cuts"), ["_class", BUCKET])
        .withColumn("_rank", F.row_number().over(inside))
        .select("_class", "order", "_rank", F.inline("ranks"))
        .where(F.col("_rank") == F.col("rank"))
        .groupBy("_class")
        .agg(F.map_from_entries(F.collect_list(F.struct("cut", "order"))).alias("cuts"))
    )
    return stored(found, "cuts")


def class_key(by: str) -> Column:
    """A class as a string; no class is a class of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("")).alias("_class")


def stratified_split(
    df: DataFrame,
    by: str,
    fractions=SPLIT_FRACTIONS,
    names=SPLIT_NAMES,
    key: str = "pair_id",
    seed: int = keys.SEED,
    population: DataFrame | None = None,
) -> DataFrame:
    """Successive samples of what is left, drawn within each class of ``by``, as a ``split`` column.

    Each split has the share of every class that its fraction asks for, to within one
    row, however rare the class. ``fractions``, ``names`` and ``population`` (with ``key`` and ``by``) as in ``weighted_split``.
    A class of any size is counted and cut by buckets; no task holds one.
    """
    whole = fractions[-1] >= 1
    limited = fractions[:-1] if whole else fractions
    cuts = class_cuts(df if population is None else population, limited, by, key, seed)
    order = F.struct(keys.digest(F.col(key), seed).alias("digest"), F.col(key).alias("id"))
    keyed = df.withColumns({"_class": class_key(by), "_order": order})
    placed = join_table(keyed, cuts, "_class", F.col(key))
    split = F.lit(names[-1] if whole else None).cast("string")
    for i in reversed(range(len(limited))):
        inside = F.col("_order") <= F.try_element_at("cuts", F.lit(i))
        split = F.when(inside, F.lit(names[i])).otherwise(split)
    out = placed.withColumn("split", split).select(*df.columns, "split")
    return out if whole else out.where("split IS NOT NULL")
