"""Mixing sources to target weights by entropy balancing.

Every document may be taken zero, one or two times (``most``). Its rate ``r`` is
the one of largest entropy (two slots per document, each a coin) under one
constraint per source: the words taken from the source are its target. The dual of
that problem is convex in one multiplier per source, and its solution tilts the
odds of a slot exponentially in the document's size:

    r = most * w / (1 + w),  w = exp(multiplier * size / mean size of the source)

Newton steps solve the dual. Each is one Spark aggregation, over the number of
documents by source and size, so a source holding a third of all rows is as
cheap as any. A step that leaves the bracket of the root is replaced by bisection.

Rates become copies by sequential Poisson sampling: slot ``j`` of a document has the
chance ``p = clip(r - j, 0, 1)`` and the key ``u / p``, ``u`` being a hash of the id. The
slots of a source are taken in order of their keys until its target is met, so
the words taken differ from it by less than one document. The cut is found by
counting words in buckets of the key; only the bucket with the cut is sorted.

Defined cases: a null text has no words; a null source is a source of its own, the
last in order; documents without words are never taken; repeated rows are documents
of their own and may share a key, the tie being broken at random by row; null ids
are allowed; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from pairloom.llm.common import ranked, word_count
from pairloom.session import stored

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2
ROUNDS = 60
TOLERANCE = 1e-6
#: Buckets per unit of the logarithm of a key; keys span at most 90 units.
PER_UNIT = 2048


def sizes(docs: DataFrame) -> DataFrame:
    """(``doc_id``, ``source``, ``size``), stored: all that balancing reads."""
    narrow = docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    return stored(narrow, "sizes")


def histogram(sized: DataFrame) -> DataFrame:
    """Documents by source and size, stored."""
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("key")
    return stored(sized.groupBy(key, "source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")


def source_targets(counted: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Per source: ``source_size``, ``n_docs`` and ``target``, the latter shared by
    weight; what is beyond ``most`` times a source goes to the others."""
    sources = counted.groupBy("key", "source").agg(
        F.sum(F.col("n") * F.col("size")).cast("bigint").alias("source_size"), F.sum("n").alias("n_docs")
    )
    numbered = ranked(sources, [F.col("source").isNull(), F.col("source")])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("position") - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = F.col("source_size").cast("double") * most
    held = stored(numbered.withColumns({"weight": weight, "cap": cap}), "sources")
    total = share * (held.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("cap") < F.col("weight") * level
        row = held.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        risen = (total - row[0]) / row[1] if row[1] else level
        if risen <= level:
            break
        level = risen
    return stored(
        held.select("key", "source_size", "n_docs", F.least("cap", F.col("weight") * level).alias("target")), "targets"
    )


def _rate(size: Column, tilt: Column, mean: Column, most: int) -> Column:
    return F.when(tilt == float("inf"), F.lit(float(most))).otherwise(most / (1 + F.exp(-tilt * size / mean)))


def multipliers(counted: DataFrame, targets: DataFrame, most: int = MOST, rounds: int = ROUNDS) -> DataFrame:
    """``targets`` with ``mean`` (words per document) and ``tilt``, the root of the
    dual's gradient."""
    mean = F.greatest(F.col("source_size") / F.col("n_docs"), F.lit(1e-9))
    full = F.col("target") >= F.col("source_size") * most * (1 - 1e-12)
    state = stored(
        targets.withColumns({
            "mean": mean, "tilt": F.when(full, float("inf")).otherwise(0.0),
            "low": F.lit(-700.0), "high": F.lit(700.0), "done": full | (F.col("target") <= 0),
        }), "tilts",
    )
    for _ in range(rounds):
        if not state.where("not done").limit(1).count():
            break
        slot = F.col("n") * F.col("size") * _rate(F.col("size"), F.col("tilt"), F.col("mean"), most)
        other = 1 - _rate(F.col("size"), F.col("tilt"), F.col("mean"), most) / most
        slopes = (
            counted.join(state.where("not done").select("key", "tilt", "mean"), "key")
            .groupBy("key")
            .agg(F.sum(slot).alias("_words"), F.sum(slot * other * F.col("size") / F.col("mean")).alias("_slope"))
        )
        gap = F.col("_words") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - F.try_divide(gap, F.col("_slope"))
        middle = (F.col("low") + F.col("high")) / 2
        inside = newton.isNotNull() & (newton > F.col("low")) & (newton < F.col("high"))
        near = F.col("done") | (F.abs(gap) <= F.col("target") * TOLERANCE) | (F.col("high") - F.col("low") < 1e-12)
        bracket = state.join(slopes, "key", "left").withColumns({"low": F.coalesce(low, "low"), "high": F.coalesce(high, "high")})
        state = stored(
            bracket.withColumns({
                "done": F.coalesce(near, F.col("done")),
                "tilt": F.when(F.coalesce(near, F.col("done")), F.col("tilt")).otherwise(F.when(inside, newton).otherwise(middle)),
            }).drop("_words", "_slope"), "tilts",
        )
    return state.select("key", "source_size", "target", "mean", "tilt")


def copies(sized: DataFrame, solved: DataFrame, seed: int = 5, most: int = MOST) -> DataFrame:
    """(``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``rate``, ``copies``)."""
    key = F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))
    unit = (F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size"), F.lit(1 << 52)) + 1) / F.lit(float((1 << 52) + 1))
    rated = stored(
        sized.withColumn("key", key).join(solved, "key").withColumns({
            "rate": _rate(F.col("size"), F.col("tilt"), F.col("mean"), most), "unit": unit,
            "row": F.monotonically_increasing_id(),
        }).drop("mean", "tilt"), "rated",
    )
    chance = [F.greatest(F.least(F.col("rate") - j, F.lit(1.0)), F.lit(0.0)) for j in range(most)]
    slot = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.try_divide(F.col("unit"), p).alias("order")) for j, p in enumerate(chance)])).alias("slot")
    slots = rated.where("size > 0").select("key", "row", "size", "target", slot).select(
        "key", "row", "size", "target", "slot.j", "slot.order"
    ).where("order is not null").withColumn("bucket", F.floor(F.log(F.greatest("order", F.lit(1e-300))) * PER_UNIT).cast("bigint"))
    words = slots.groupBy("key", "target", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    crossed = words.withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).where(
        (F.col("before") < F.col("target")) & (F.col("before") + F.col("words") >= F.col("target"))
    ).select("key", "bucket", "before")
    inside = Window.partitionBy("key").orderBy("order", "row", "j").rowsBetween(Window.unboundedPreceding, -1)
    taken = slots.join(crossed, ["key", "bucket"]).withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    cut = taken.where(2 * F.col("before") + F.col("size") <= 2 * F.col("target")).groupBy("key").agg(
        F.max(F.struct("order", "row", "j")).alias("cut")
    )
    start = crossed.select("key", F.col("bucket").alias("cut_bucket"))
    ends = stored(solved.select("key").join(start, "key", "left").join(cut, "key", "left"), "cuts")

    def within(j: int, p: Column) -> Column:
        order = F.try_divide(F.col("unit"), p)
        bucket = F.floor(F.log(F.greatest(order, F.lit(1e-300))) * PER_UNIT).cast("bigint")
        at = F.struct(order.alias("order"), F.col("row").alias("row"), F.lit(j).alias("j"))
        below = F.col("cut_bucket").isNull() | (bucket < F.col("cut_bucket")) | (at <= F.col("cut"))
        return F.when((F.col("size") > 0) & (F.col("target") > 0) & order.isNotNull() & F.coalesce(below, F.lit(False)), 1).otherwise(0)

    count = sum((within(j, p) for j, p in enumerate(chance)), F.lit(0)).cast("bigint")
    return rated.join(ends, "key").select("doc_id", "source", "size", "source_size", "target", "rate", count.alias("copies"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 5) -> DataFrame:
    """Each document with its source's target and the words the mix ``taken`` from it."""
    sized = sizes(docs)
    counted = histogram(sized)
    solved = multipliers(counted, source_targets(counted, weights, share, most), most)
    return copies(sized, solved, seed, most).withColumn("taken", F.col("size") * F.col("copies"))
