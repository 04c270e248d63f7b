"""Quality rules whose limits follow the data: quantile sketches per language and source.

Each document is measured in one pass without a shuffle: words, code points in words,
symbols, repeated lines, words in repeated windows of five, punctuation marks and capitals.
Ratios of these, whole numbers per thousand, are what the rules look at.

A sketch is a table of how many documents fall in which bucket of a ratio (``bucket_of``).
Buckets are as wide as a 64th of their value, so a quantile read off a sketch is within a
128th of the true one. Sketches of parts of the data (days, partitions, sources) are
merged by adding up counts, in any order and with the same result: ``merge``. A sketch
has at most some thousand rows per group, however many documents the group has, as counts
are added up within tasks before they are shuffled. Equal texts of a group count once, so
that a thousand copies don't become the norm.

``limits`` reads quartiles off the sketches. A ratio above the third quartile by ``SPREAD``
times the distance of the quartiles, and by ``SLACK`` at least, fails, and so does a mean
word length as far below the first. Groups of fewer than ``FEWEST`` different texts take the
limits of their language, merged from its sources, or of all. Documents meet
their group's limits in a join of the narrow measures: broadcast if the limits are small,
else salted, so that a source of a third of all rows is dealt over tasks.

Fixed rules come first: fewer than ten words, or over 20 % of words in repeated windows;
documents failing them are not counted in the sketches.

Defined cases: a null text has no words and fails; null languages and sources are values of
their own; repeated rows are judged each and alike; an empty table gives an
empty result; other columns are ignored, or handed on by ``kept_rows`` whatever their names.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from pairloom.llm.common import free_name, map_batches, raw
from pairloom.llm.wordids import numbered, repeated_windows
from pairloom.llm.words import SPACE, slices
from pairloom.operators.sizing import join_table
from pairloom.session import stored

FEWEST_WORDS = 10
MOST_REPEATED = 20
WINDOW = 5
SPREAD = 3
FEWEST = 50
SUB = 6
#: Least distance of a limit from its quartile, per thousand
SLACK = {"mean_chars": 2000, "symbols": 30, "dup_lines": 300, "repeats": 150, "marks": 80, "capitals": 80}
LOWER = ("mean_chars",)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_marks", "n_capitals")

_HEAD = (np.arange(256) & 0xC0) != 0x80


def _flag(members: bytes) -> np.ndarray:
    flag = np.zeros(256, bool)
    flag[list(members)] = True
    return flag


_CLASSES = {
    "word_chars": _HEAD & ~SPACE,
    "n_symbols": _flag(b"#*$%&|<>"),
    "n_marks": _flag(bytes(c for c in range(33, 127) if not chr(c).isalnum())),
    "n_capitals": _flag(bytes(range(65, 91))),
}


def counts_of(data: np.ndarray, edges: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of each text of a slice."""
    texts = [data[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
    split = [t.split() for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    first = np.r_[0, np.cumsum(sizes)]
    ids = numbered([w for words in split for w in words])
    place, _ = repeated_windows(ids, first, WINDOW)
    steps = np.zeros(len(ids) + 1, np.int64)
    steps[place] += 1
    steps[place + WINDOW] -= 1
    covered = np.r_[0, np.cumsum(np.cumsum(steps[:-1]) > 0)]
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    out = {
        "n_words": sizes,
        "n_repeat_words": covered[first[1:]] - covered[first[:-1]],
        "n_lines": np.array([len(x) for x in lines], np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
    }
    for name, members in _CLASSES.items():
        total = np.r_[0, np.cumsum(members[data])]
        out[name] = total[edges[1:]] - total[edges[:-1]]
    return out


def measure(docs: DataFrame, keep: list[str] = ("doc_id",), name: str = "rule") -> DataFrame:
    """``keep`` and a struct ``name`` of the counts of each text; no shuffle."""
    fields = [docs.schema[c] for c in keep]
    bytes_column = free_name(list(keep), "raw")
    kind = f"struct<{','.join(f'{c}:bigint' for c in COUNTS)}>"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{name}` {kind}"])

    def change(batch):
        for low, high, data, edges in slices(batch.column(bytes_column)):
            found = counts_of(data, edges)
            columns = [batch.column(c).slice(low, high - low) for c in keep]
            counts = pa.StructArray.from_arrays([pa.array(found[c], pa.int64()) for c in COUNTS], names=list(COUNTS))
            yield pa.RecordBatch.from_arrays([*columns, counts], names=[*keep, name])

    return map_batches(docs.select(*[F.col(f"`{c}`") for c in keep], raw().alias(bytes_column)), change, schema)


def base_failed(rule: Column) -> Column:
    repeated = 100 * rule["n_repeat_words"] > MOST_REPEATED * rule["n_words"]
    return (rule["n_words"] < FEWEST_WORDS) | repeated


def ratios(rule: Column) -> dict[str, Column]:
    """What the rules look at, per thousand."""
    def share(part, whole):
        return F.floor(1000 * rule[part] / F.greatest(rule[whole], F.lit(1))).cast("bigint")

    return {
        "mean_chars": share("word_chars", "n_words"), "symbols": share("n_symbols", "n_words"),
        "dup_lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words"),
        "marks": share("n_marks", "word_chars"), "capitals": share("n_capitals", "word_chars"),
    }


def bucket_of(value: Column) -> Column:
    """The bucket of a whole number of 0 or more: itself if small, else its leading
    ``SUB + 1`` bits and how many follow."""
    shift = F.greatest(F.length(F.bin(value)) - (SUB + 1), F.lit(0))
    return shift.cast("bigint") * (1 << SUB) + F.call_function("shiftright", value, shift)


def bucket_middle(bucket: Column) -> Column:
    shift = F.greatest(F.floor(bucket / (1 << SUB)) - 1, F.lit(0)).cast("int")
    low = F.call_function("shiftleft", bucket - shift.cast("bigint") * (1 << SUB), shift)
    return low + F.call_function("shiftright", F.call_function("shiftleft", F.lit(1).cast("bigint"), shift), F.lit(1))


def sketch(values: DataFrame, by: list[str], measures: list[str]) -> DataFrame:
    """(``by``, ``measure``, ``bucket``, ``n``) of the columns ``measures``."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket_of(F.col(m)).alias("bucket")) for m in measures]))
    return (
        values.select(*by, each.alias("_m")).select(*by, "_m.measure", "_m.bucket")
        .groupBy(*by, "measure", "bucket").agg(F.count(F.lit(1)).alias("n"))
    )


def merge(sketches: list[DataFrame], by: list[str]) -> DataFrame:
    """One sketch of all; of coarser groups if ``by`` names fewer columns."""
    every = reduce(lambda a, b: a.unionByName(b), [s.select(*by, "measure", "bucket", "n") for s in sketches])
    return every.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketched: DataFrame, by: list[str], wanted: dict[str, int]) -> DataFrame:
    """(``by``, ``measure``, ``n_docs``, the ``wanted`` quantiles, given per thousand)."""
    group = Window.partitionBy(*by, "measure")
    summed = sketched.withColumns({
        "_total": F.sum("n").over(group),
        "_upto": F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)),
    })

    def quantile(q):
        rank = F.greatest(F.floor((F.col("_total") * q + 999) / 1000), F.lit(1))
        return bucket_middle(F.min(F.when(F.col("_upto") >= rank, F.col("bucket"))))

    return summed.groupBy(*by, "measure").agg(F.max("_total").alias("n_docs"), *[quantile(q).alias(c) for c, q in wanted.items()])


def group_key(*columns: Column) -> Column:
    """One string for several values, different for different ones; null is a value."""
    parts = [F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in columns]
    return F.concat(*parts)


def limits(sketched: DataFrame) -> DataFrame:
    """(``key``, ``lows`` and ``highs`` by measure) of every group of language and source
    in a sketch with the columns ``language``, ``key``; stored."""
    wanted = {"q1": 250, "q3": 750}
    own = quantiles(sketched, ["language", "key"], wanted)
    spoken = quantiles(merge([sketched], ["language"]), ["language"], wanted)
    every = quantiles(merge([sketched], []), [], wanted)
    enough = F.col("n_docs") >= FEWEST

    def quartiles(name):
        return F.when(enough, F.struct("q1", "q3")).alias(name)

    met = (
        own.select("language", "key", "measure", quartiles("own"))
        .join(spoken.select("language", "measure", quartiles("spoken")), ["language", "measure"])
        .join(F.broadcast(every.select("measure", F.struct("q1", "q3").alias("every"))), "measure")
        .select("key", "measure", F.coalesce("own", "spoken", "every").alias("q"))
    )
    slack = reduce(lambda c, m: c.when(F.col("measure") == m, SLACK[m]), list(SLACK)[1:], F.when(F.col("measure") == next(iter(SLACK)), SLACK[next(iter(SLACK))]))
    reach = F.greatest(SPREAD * (F.col("q.q3") - F.col("q.q1")), slack)
    low = F.when(F.col("measure").isin(*LOWER), F.col("q.q1") - reach)
    edges = met.select("key", "measure", low.alias("low"), (F.col("q.q3") + reach).alias("high"))
    per = [F.max(F.when(F.col("measure") == m, F.col(e))).alias(f"{e}_{m}") for m in SLACK for e in ("low", "high")]
    return stored(edges.groupBy("key").agg(*per), "limits")


def sketch_groups(measured: DataFrame) -> DataFrame:
    """The sketch by language and source of measured documents (``language``, ``key``,
    ``digest``, ``rule``) that pass the fixed rules; equal texts of a group once. Stored."""
    sound = measured.where(~base_failed(F.col("rule")))
    once = sound.groupBy("language", "key", "digest").agg(F.first("rule").alias("rule"))
    values = once.select("language", "key", *[c.alias(m) for m, c in ratios(F.col("rule")).items()])
    return stored(sketch(values, ["language", "key"], list(SLACK)), "sketch")


def failed_rules(rule: Column, edge) -> Column:
    """The names of the rules broken, in order, joined by commas; ``edge(name)`` is a limit."""
    broken = []
    for name, value in ratios(rule).items():
        high, low = edge(f"high_{name}"), edge(f"low_{name}")
        outside = F.coalesce(value > high, F.lit(False)) | F.coalesce(value < low, F.lit(False))
        broken.append(F.when(outside, F.lit(name)))
    return F.concat_ws(",", *broken)


def _grouped(docs: DataFrame, taken: list[str] = ()) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns that judging needs, under names no other column has."""
    names = {c: free_name([*docs.columns, *taken], f"_{c}") for c in ("language", "key", "digest")}
    language, source = (F.col(c).cast("string") for c in ("lang", "source"))
    return docs.withColumns({
        names["language"]: group_key(language), names["key"]: group_key(language, source),
        names["digest"]: F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")),
    }), names


def judge(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``lang``, ``source``, its counts, ``base_failed``, ``failed_rules``
    and ``kept``."""
    plain = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), "text")
    grouped, names = _grouped(plain)
    measured = stored(measure(grouped, ["doc_id", "lang", "source", *names.values()]).withColumnsRenamed({v: k for k, v in names.items()}), "measured")
    edges = limits(sketch_groups(measured))
    met = join_table(measured.withColumn("_row", F.monotonically_increasing_id()), edges, "key", F.col("_row"))
    rule, failed = F.col("rule"), F.concat_ws("", F.col("failed_rules"))
    return met.withColumns({"base_failed": base_failed(rule), "failed_rules": failed_rules(rule, F.col)}).select(
        "doc_id", "lang", "source", "rule.*", "base_failed", "failed_rules", (~F.col("base_failed") & (failed == "")).alias("kept")
    )


def kept_rows(docs: DataFrame, sketched: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns. ``sketched``, if given, is
    a sketch of ``sketch_groups``, for instance one merged from earlier parts of the data."""
    grouped, names = _grouped(docs)
    if sketched is None:
        narrow = measure(grouped, list(names.values())).withColumnsRenamed({v: k for k, v in names.items()})
        sketched = sketch_groups(narrow)
    edges = limits(sketched)
    held = edges.withColumnsRenamed({c: free_name(grouped.columns, f"_{c}") for c in edges.columns if c != "key"})
    edge = dict(zip([c for c in edges.columns if c != "key"], [c for c in held.columns if c != "key"]))
    rule = free_name([*grouped.columns, *held.columns], "_rule")
    measured = measure(grouped, [*docs.columns, names["key"]], rule)
    met = join_table(measured, held.withColumnRenamed("key", names["key"]), names["key"], F.monotonically_increasing_id())
    good = ~base_failed(F.col(rule)) & (failed_rules(F.col(rule), lambda c: F.col(edge[c])) == "")
    return met.where(good).select(*[F.col(f"`{c}`") for c in docs.columns])
