"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set holds the hashes of its five-word shingles; its sketch is the ``k``
smallest of them. The smallest ``k`` hashes of a union of two sets are a fair sample of
the union, and those of them in both sets are retained by both sketches. So

1. equal sets become one node, whatever the number of copies;
2. every node puts some of its retained values into inverted lists: two sets at the
   threshold share at least ``t`` of their retained values, so they share one among
   the first ``k - t + 1`` of each in any common order. Values known to be
   frequent come last in that order, the most frequent at its end, so a passage held by
   thousands of documents makes a list only where it is most of a document;
3. pairs of a list whose sizes allow the threshold are estimated on their union
   sketch, with six standard deviations of slack, and what may reach the threshold
   is confirmed on the full sets of both documents;
4. confirmed links are joined into components.

Long lists are not turned into all their pairs. All nodes of a list are first held
against its most typical one, which settles groups of near copies; then only nodes that are still in
different components are compared, all of them, each pair at its first common value. The place of
a shared value in both orders bounds what two sets or sketches can share beyond it (Xiao et al.
2008), so copies with many changes of their own are no candidates. All deviations are those of
a draw without replacement: a sketch of 256 of 400 values says more than one of 256 of a million.

For sets up to three quarters of ``k`` the value ``t`` is exact; beyond that a link is
missed with a chance of about 1e-9. Shingles are compared by 63-bit hashes.

Defined cases: a null or wordless text has no shingles and is linked with nothing; a
text of fewer than five words is one shingle; rows of one id are rows each; a row
without an id takes its component from the others and is never the one that is
kept; a component without any id has a null one; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from pairloom.llm.common import arrow_schema, few_broadcast, free_name, linked_classes, map_batches, raw
from pairloom.llm.words import LOWER, Words, mixed, word_slices
from pairloom.session import stored

SHINGLE = 5
THRESHOLD = 75
RETAINED = 256
#: Lists up to this length are turned into all their pairs.
SHORT = 24
#: At most so many values count as frequent; their array is sent to every task.
MOST_FREQUENT = 1 << 20
LEAST_FREQUENT = 64
#: Values of a first, coarser estimate, so that few pairs carry whole sketches
COARSE = 64
_ID_BITS = 48
_U = np.uint64
_STEPS = mixed(np.arange(11, 11 + SHINGLE, dtype=_U)) | _U(1)
SKETCHED = "doc_id bigint, n bigint, node binary, text_key bigint, sketch binary"
ENTRY = "value bigint, id bigint, n bigint, place bigint"


def shingle_sets(words: Words, width: int = SHINGLE):
    """The sorted distinct shingle hashes of each text."""
    h = words.hashes(LOWER)
    steps = _STEPS if width == SHINGLE else mixed(np.arange(11, 11 + width, dtype=_U)) | _U(1)
    n = len(h) - width + 1
    rolled = np.zeros(max(n, 0), _U)
    for j in range(width):
        rolled += h[j : j + max(n, 0)] * steps[j]
    rolled = mixed(rolled) >> _U(1)
    for i in range(len(words.first) - 1):
        low, high = words.first[i], words.first[i + 1]
        if high - low >= width:
            yield np.unique(rolled[low : high - width + 1])
        elif high > low:
            whole = (h[low:high] * steps[: high - low]).sum(dtype=_U) + _U(high - low)
            yield mixed(np.array([whole], _U)) >> _U(1)
        else:
            yield np.zeros(0, _U)


def _digest(hashes: np.ndarray) -> bytes | None:
    if not len(hashes):
        return None
    parts = [mixed(hashes ^ _U(seed)).sum(dtype=_U) for seed in (0x51ED270B, 0x2545F4914F6CDD1D)]
    return np.array(parts, _U).tobytes()


def sketches(docs: DataFrame, retained: int = RETAINED) -> DataFrame:
    """One row per document: set size, digest of the set, hash of the text, sketch."""
    schema = arrow_schema(SKETCHED)

    def change(batch):
        ids, keys = batch.column("doc_id"), batch.column("text_key")
        for low, high, words in word_slices(batch.column("raw")):
            found = list(shingle_sets(words))
            yield pa.RecordBatch.from_arrays([
                ids.slice(low, high - low), pa.array([len(s) for s in found], pa.int64()),
                pa.array([_digest(s) for s in found], pa.binary()), keys.slice(low, high - low),
                pa.array([s[:retained].tobytes() for s in found], pa.binary()),
            ], schema=schema)

    return map_batches(docs.select(F.col("doc_id").cast("bigint"), raw(), text_key()), change, SKETCHED)


def text_key():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text_key")


def overlap_needed(n: int, retained: int = RETAINED, percent: int = THRESHOLD) -> int:
    """The least number of retained values that a set of ``n`` shares with any other at
    the threshold."""
    whole = -(-percent * n // 100)
    if 100 * n <= percent * retained:
        return whole
    p = percent / 100
    # a sketch that is cut makes a sample of k of the union, which holds n / p values at most
    sampled = max(1, int(p * retained - 6 * deviation(p, retained, n / p)))
    return min(sampled, whole) if n <= retained else sampled


def deviation(p: float, drawn: int, of: float) -> float:
    """The standard deviation of the hits in a draw without replacement."""
    return float(np.sqrt(p * (1 - p) * drawn * max(0, of - drawn) / max(1, of - 1)))


def frequent_values(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The retained values of most documents, sorted, and their places by how many hold them, fewest
    first. Only counts that a batch of sketches makes itself are summed, so a count may fall short;
    any set in any order gives right results, as all nodes use the same one."""
    schema = arrow_schema("value bigint, n bigint")

    def count(batch):
        values, times = np.unique(np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.int64), return_counts=True)
        often = times >= 2
        yield pa.RecordBatch.from_arrays([pa.array(values[often]), pa.array(times[often])], schema=schema)

    total = rows.agg(F.sum(F.octet_length("sketch") / 8)).first()[0] or 0
    least = max(LEAST_FREQUENT, int(total / MOST_FREQUENT) + 1)
    summed = map_batches(rows.select("sketch"), count, "value bigint, n bigint").groupBy("value").agg(F.sum("n").alias("n"))
    found = summed.where(F.col("n") >= least).toArrow()  # at most total / least values
    values, times = (found.column(c).to_numpy() for c in ("value", "n"))
    places = np.empty(len(values), np.int64)
    places[np.lexsort((values, times))] = np.arange(len(values))
    order = np.argsort(values)
    return values[order], places[order]


def list_entries(rows: DataFrame, often: tuple[np.ndarray, np.ndarray], retained: int = RETAINED) -> DataFrame:
    """The inverted lists: (``value``, ``id``, ``n``, ``place``). An id starts with how untypical its
    node is, so that the smallest id of a list is its most typical node."""
    schema = arrow_schema(ENTRY)
    held = rows.sparkSession.sparkContext.broadcast(often)

    def change(batch):
        common, places = held.value
        out = []
        for sketch, n, nid in zip(batch.column("sketch"), batch.column("n").to_pylist(), batch.column("nid").to_pylist()):
            values = np.frombuffer(sketch.as_buffer(), np.int64)
            if len(common):
                at = np.minimum(np.searchsorted(common, values), len(common) - 1)
                is_common = common[at] == values
                often_held = values[is_common][np.argsort(places[at[is_common]])]
            else:
                is_common, often_held = np.zeros(len(values), bool), values[:0]
            first = len(values) - overlap_needed(n, retained) + 1
            rare = values[~is_common]
            chosen = rare[:first] if len(rare) >= first else np.r_[rare, often_held[: first - len(rare)]]
            untypical = int(127 * len(rare) / max(1, len(values)))
            out.append((chosen, (untypical << (_ID_BITS + 8)) | nid, n))
        sizes = [len(c) for c, _, _ in out]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([c for c, _, _ in out])), pa.array(np.repeat(np.array([i for _, i, _ in out], np.int64), sizes)),
            pa.array(np.repeat(np.array([n for _, _, n in out], np.int64), sizes)),
            pa.array(np.concatenate([np.arange(x) for x in sizes])),
        ], schema=schema)

    return map_batches(rows, change, ENTRY)


def _may_link(retained: int = RETAINED, percent: int = THRESHOLD):
    """Whether the sizes of two sets and the places of a shared value allow the threshold. If that
    value is their first in common, their sketches share at most what follows it in either.
    Two whole sets must share ``percent / (100 + percent)`` of both sizes; otherwise the sketch that
    ends first is a fair sample of its set, and must share that part of the larger one,
    less seven standard deviations of a draw without replacement."""
    a, b = F.col("n_a"), F.col("n_b")
    sizes = (a * 100 >= b * percent) & (b * 100 >= a * percent)
    whole = F.greatest(a, b) <= retained
    held = [F.least(n, F.lit(retained)) - place for n, place in ((a, F.col("place_a")), (b, F.col("place_b")))]
    left = F.least(*held)
    larger = F.greatest(a, b)
    part = (a + b) * (percent / (100 + percent)) / larger
    sampled = left >= part * retained - 7 * F.sqrt(part * (1 - part) * retained * (larger - retained) / (larger - 1))
    return sizes & F.when(whole, left * (100 + percent) >= (a + b) * percent).otherwise(sampled)


def ids_of(pairs: DataFrame) -> DataFrame:
    """(``id``, ``nid``) of the nodes of ``pairs``, stored."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    return stored(ids.withColumn("nid", _number()), "wanted")


def _number():
    return F.col("id").bitwiseAND(F.lit((1 << _ID_BITS) - 1))


def estimated(pairs: DataFrame, whole: DataFrame, retained: int = RETAINED, percent: int = THRESHOLD, deviations: float = 6) -> DataFrame:
    """``pairs`` (``a``, ``b``) that the union of their sketches lets pass, of which ``retained`` values are looked at;
    ``whole`` has ``nid``, ``n`` and ``sketch`` of each node."""
    schema = arrow_schema("a bigint, b bigint")
    p = percent / 100

    def change(batch):
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        # the largest union two sets of these sizes have at the threshold
        most = (batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()) / (1 + p)
        passed = np.zeros(len(a), bool)
        for i, (x, y) in enumerate(zip(batch.column("sketch_a"), batch.column("sketch_b"))):
            x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
            both = np.sort(np.concatenate([x, y]))
            twice = np.flatnonzero(both[1:] == both[:-1])
            # a union sketch can't reach beyond the end of a full sketch
            cut = [s[-1] for s in (x, y) if len(s) >= retained]
            end, slack = min(cut, default=both[-1]), deviations if cut else 0
            shared = int((both[twice] <= end).sum())
            union = int(np.searchsorted(both, end, side="right")) - shared
            passed[i] = shared >= p * union - slack * deviation(p, union, most[i]) - 1e-9
        yield pa.RecordBatch.from_arrays([pa.array(a[passed]), pa.array(b[passed])], schema=schema)

    briefs = whole.join(few_broadcast(ids_of(pairs)), "nid").select("id", "n", F.substring("sketch", 1, 8 * retained).alias("brief"))
    one, other = (briefs.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("brief").alias(f"sketch_{x}")) for x in "ab")
    met = pairs.join(one, "a").join(other, "b").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
    return map_batches(met, change, "a bigint, b bigint")


def confirmed(pairs: DataFrame, docs: DataFrame, reps: DataFrame, percent: int = THRESHOLD) -> DataFrame:
    """``pairs`` whose full sets reach the threshold. Sets are made anew from the
    text of one document per node."""
    schema_text = "id bigint, members array<bigint>"
    schema = arrow_schema(schema_text)
    wanted = stored(ids_of(pairs).join(reps, "nid").select("id", "text_key"), "keys")

    def sets(batch):
        ids = batch.column("id")
        for low, high, words in word_slices(batch.column("raw")):
            found = list(shingle_sets(words))
            edges = np.r_[0, np.cumsum([len(s) for s in found])].astype(np.int32)
            members = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(found).view(np.int64)))
            yield pa.RecordBatch.from_arrays([ids.slice(low, high - low), members], schema=schema)

    # copies of one text meet here; one of them is enough
    texts = docs.select(text_key(), raw()).join(few_broadcast(wanted), "text_key").groupBy("id").agg(F.min("raw").alias("raw"))
    full = stored(map_batches(texts.select("id", "raw"), sets, schema_text), "sets")
    one = full.select(F.col("id").alias("a"), F.col("members").alias("set_a"))
    other = full.select(F.col("id").alias("b"), F.col("members").alias("set_b"))
    shared = F.size(F.array_intersect("set_a", "set_b"))
    # row by row in the JVM: two sets of the longest texts are all that is held at once
    return pairs.join(one, "a").join(other, "b").where(
        100 * shared >= percent * (F.size("set_a") + F.size("set_b") - shared)
    ).select("a", "b")


def crossed(placed: DataFrame, retained: int = RETAINED) -> DataFrame | None:
    """Pairs (``a``, ``b``) of nodes of one list that lie in different components, each once; none if no list has two.
    ``placed``: (``value``, ``id``, ``n``, ``place``, ``pivot``, ``root``) of the nodes of long lists. Two nodes are
    compared at their first common value: a later one is known by a common value before it."""
    columns = ("id", "n", "place", "root", "before")
    earlier = Window.partitionBy("id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = stored(placed.select("value", "id", "n", "place", "pivot", "root", F.collect_list("value").over(earlier).alias("before")), "before")
    home = stored(before.where("id = pivot").select("value", F.col("root").alias("home")).distinct(), "homes")
    apart = before.join(home, "value").where("root <> home").select("value", "home", *[F.col(c).alias(f"{c}_a") for c in columns])
    apart = stored(apart, "apart")
    if not apart.limit(1).count():
        return None
    everyone = before.select("value", *[F.col(c).alias(f"{c}_b") for c in columns])
    met = apart.join(everyone, "value").where(
        (F.col("root_a") != F.col("root_b")) & ((F.col("root_b") == F.col("home")) | (F.col("id_a") < F.col("id_b")))
        & _may_link(retained) & ~F.arrays_overlap("before_a", "before_b")
    )
    return met.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"))


def components(docs: DataFrame, retained: int = RETAINED, short: int = SHORT) -> tuple[DataFrame, DataFrame]:
    """(``doc_id``, ``n``, ``node``, ``text_key`` of each document, ``node``, ``nid``, ``least`` id and ``root`` of
    each different set); sets of one root are a component, one without a root is its own."""
    rows = stored(sketches(docs, retained).withColumn("row", F.monotonically_increasing_id()), "sketches")
    number = F.shiftleft(F.shiftright("row", 33), 24).bitwiseOR(F.col("row").bitwiseAND(F.lit((1 << 24) - 1))).cast("bigint").alias("nid")
    given = rows.where("n > 0")
    # a node is the first of the rows of its set; the others are told apart, so that no sketch is shuffled
    reps = given.groupBy("node").agg(F.min("text_key").alias("text_key"), F.min("doc_id").alias("least"), F.min("row").alias("row"))
    reps = stored(reps.select("node", "text_key", "least", "row", number), "nodes")
    copies = stored(given.select("row").join(reps.select("row"), "row", "left_anti"), "copies")
    whole = given.join(few_broadcast(copies), "row", "left_anti").select(number, "n", "sketch")
    lists = Window.partitionBy("value")
    entries = list_entries(whole, frequent_values(rows), retained)
    met = entries.withColumn("held", F.count(F.lit(1)).over(lists)).withColumn("pivot", F.min("id").over(lists))
    met = stored(met.where("held > 1"), "met")

    def links(pairs: DataFrame) -> DataFrame:
        likely = stored(estimated(stored(pairs, "pairs"), whole, min(COARSE, retained), deviations=7), "likely")
        passed = stored(estimated(likely, whole, retained), "candidates")
        return confirmed(passed, docs, reps)

    brief_lists = met.where(F.col("held") <= short)
    left, right = (brief_lists.select("value", *[F.col(c).alias(f"{c}_{side}") for c in ("id", "n", "place")]) for side in "ab")
    within = left.join(right, "value").where((F.col("id_a") < F.col("id_b")) & _may_link(retained)).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    longer = met.where(F.col("held") > short)
    to_pivot = longer.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b"))
    found = stored(links(within.union(to_pivot).distinct()), "links")
    classes = stored(linked_classes(found), "classes")

    # what the first comparison of a long list has left apart
    placed = longer.join(classes.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    pairs = crossed(placed, retained)
    if pairs is not None:
        found = stored(found.union(links(pairs)), "links")
        classes = stored(linked_classes(found), "classes")

    linked = classes.select(F.col("node").bitwiseAND(F.lit((1 << _ID_BITS) - 1)).alias("nid"), "root")
    rooted = stored(reps.select("node", "nid", "least").join(linked, "nid", "left"), "rooted")
    return rows.select("doc_id", "n", "node", "text_key"), rooted


def near_duplicates(docs: DataFrame, retained: int = RETAINED, short: int = SHORT) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``."""
    rows, rooted = components(docs, retained, short)
    smallest = stored(rooted.where("root is not null").groupBy("root").agg(F.min("least").alias("smallest")), "smallest")
    parts = rooted.join(smallest, "root", "left").select("node", F.coalesce("smallest", "least").alias("component"))
    parts = stored(parts, "components")
    given = rows.select("doc_id", F.col("n").alias("n_shingles"), "node")
    joined = given.where("node is not null").join(parts, "node").drop("node")
    alone = given.where("node is null").withColumn("component", F.col("doc_id")).drop("node")
    return joined.union(alone).select(
        "doc_id", "n_shingles", F.col("component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(False)).alias("kept"),
    )


def one_of_each(docs: DataFrame, retained: int = RETAINED, short: int = SHORT) -> DataFrame:
    """One row of each component, with all columns: that of the smallest id, null last, then of the
    smallest text key. Rows without words are components of their own, but for repeated rows."""
    rows, rooted = components(docs, retained, short)
    group = F.coalesce(F.col("root"), -F.col("nid") - 1).alias("group")
    placed = rows.where("node is not null").join(rooted.select("node", group), "node")
    first = placed.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"))
    # an id and a text key are one group's: wordless rows have keys no group has
    chosen = first.select("first.doc_id", "first.text_key").union(rows.where("node is null").select("doc_id", "text_key").distinct())
    own, key, held = (free_name(docs.columns, c) for c in ("_own_key", "_text_key", "_held"))
    given = rows.groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("times"))
    chosen = chosen.withColumn("kept", F.lit(True))
    same = F.col("g.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("g.text_key") == F.col("c.text_key"))
    # rows that stay as they are go by without a shuffle: told apart are rows that leave and those that are there several times
    told = given.alias("g").join(chosen.alias("c"), same, "left").where("kept is null or times > 1")
    told = stored(told.select(F.col("g.doc_id").alias(held), F.col("g.text_key").alias(key), "kept"), "told")
    at = (F.col(own) == F.col(key)) & F.col("doc_id").cast("bigint").eqNullSafe(F.col(held))
    keyed = docs.withColumn(own, text_key())
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = keyed.join(few_broadcast(told), at, "left_anti").select(*columns)
    several = keyed.join(few_broadcast(told.where("kept")), at).dropDuplicates([held, key]).select(*columns)
    return once.union(several)
