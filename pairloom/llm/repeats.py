"""Repeated stretches of ``length`` tokens, found from sampled suffixes.

The tokens are words or bytes. Every stretch of ``length`` tokens holds an anchor: among
the hashes of its runs of ``prefix`` tokens, the place of the smallest. Equal
stretches have equal anchors at the same place in them, so a stretch can occur twice
only where its anchor's run does. That gives, for any operator on repeats:

1. anchors, about two in ``length - prefix`` tokens, are dealt by the hash of their
   run to buckets, packed and each once; a bucket tells which of its runs occur twice and hands their
   places back. Runs that occur twice in a few megabytes of text are known without that: their bucket gets one
   mark, their places go anywhere, so a frequent run has no more rows in a bucket than there are such stretches of text;
2. around each anchor left, the document yields a fragment: the tokens of all
   stretches that hold the anchor there, known by a hash until they are compared;
3. equal fragments become one with its number of copies and its first occurrence,
   before anything is grouped by anchor; a passage in every third document is then
   one row but at its ends;
4. tokens are cut out of the texts for anchors with several different fragments only, once for each fragment.
   Those of one anchor are compared by the operator's own method; anchors with
   more than ``GROUP`` different fragments are cut up by their stretches instead, which
   are counted and joined like any other key, so no group is unbounded;
5. each fragment gives one covered interval, as its stretches all hold the anchor.

Shuffle files are let go after each of these steps.

Copies of a whole text are found by its MD5 first, and only one of them is read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.common import BROADCAST_ROWS, arrow_schema, few_broadcast, give_back_memory, lean, map_batches, pack_columns, raw, unpack_columns
from pairloom.llm.words import find_words, mixed, powers, slices
from pairloom.session import drop_shuffles, stored

GROUP = 512
_U = np.uint64
#: Text bytes whose anchors a task packs at once, and those a bucket holds anchors of
STRETCH = 8 << 20
BUCKET = 8 << 20
ANCHOR = "bucket bigint, keys binary, anchors binary, marks binary, known binary"
PLACE = "text_key bigint, place bigint"
FRAGMENT = "run bigint, body bigint, text_key bigint, place bigint, doc_id bigint, copies bigint, back int, ahead int"
BODY = "run bigint, text_key bigint, place bigint, doc_id bigint, copies bigint, back int, ahead int, hot boolean, tokens binary"
SPAN = "text_key bigint, low bigint, high bigint"


@dataclass(frozen=True)
class Plan:
    """What to look for: stretches of ``length`` tokens by anchors of ``prefix`` tokens;
    ``kind`` of the tokens in a fragment."""

    words: bool
    length: int
    prefix: int

    @property
    def kind(self):
        return np.uint32 if self.words else np.uint8

    @property
    def reach(self) -> int:
        return self.length - self.prefix


def tokens_of(plan: Plan, data: np.ndarray, edges: np.ndarray):
    """(token values as 64-bit hashes, tokens for fragments, first token of each text)."""
    if plan.words:
        words = find_words(data, edges)
        h = words.hashes()
        return h, (h >> _U(32)).astype(np.uint32), words.first
    return mixed(data.astype(_U) + _U(1)), data, edges


def runs(values: np.ndarray, prefix: int) -> np.ndarray:
    """A hash of the run of ``prefix`` tokens at each place."""
    n = len(values)
    if n < prefix:
        return np.zeros(0, _U)
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, _U)
    np.cumsum(values * up[:n], out=sums[1:])
    return mixed((sums[prefix:] - sums[:-prefix]) * down[: n - prefix + 1])


def anchors(plan: Plan, run: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all stretches, and the text of each."""
    wide, n = plan.reach + 1, first[-1]
    starts = np.maximum(np.diff(first) - plan.length + 1, 0)
    if not starts.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    least = smallest(run, wide)
    of = np.repeat(np.arange(len(starts)), starts)
    begin = first[:-1][of] + np.arange(len(of)) - np.repeat(np.cumsum(starts) - starts, starts)
    place = least[begin]
    fresh = np.r_[True, (place[1:] != place[:-1]) | (of[1:] != of[:-1])]
    return place[fresh], of[fresh]


def smallest(run: np.ndarray, wide: int) -> np.ndarray:
    """The place of the first smallest value of each window of ``wide``, by doubling."""
    place, span = np.arange(len(run)), 1
    while span < wide:
        step = min(span, wide - span)
        left, right = place[: len(place) - step], place[step:]
        place = np.where(run[right] < run[left], right, left)
        span += step
    return place


def text_key():
    return F.xxhash64(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))).alias("text_key")


def text_groups(docs: DataFrame) -> DataFrame:
    """One row per different text: how many rows have it, and the smallest id."""
    return stored(
        docs.select(F.col("doc_id").cast("bigint"), text_key()).groupBy("text_key").agg(
            F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("least")
        ), "texts",
    )


def repeated_anchors(docs: DataFrame, plan: Plan) -> DataFrame:
    """Per text with any: the places of its anchors that occur elsewhere too."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    bits = (max(8, size // BUCKET) - 1).bit_length()

    def find(batches):
        held, n_bytes = [], 0
        for batch in batches:
            keys = batch.column("text_key").to_numpy()
            for low, high, data, edges in slices(batch.column("raw")):
                values, _, first = tokens_of(plan, data, edges)
                run, first = runs(values, plan.prefix), np.asarray(first)
                place, of = anchors(plan, run, first)
                held.append((run[place], keys[low:high][of], (place - first[of]).astype(np.int32)))
                n_bytes += len(data)
                if n_bytes >= STRETCH:
                    yield pack_anchors(*map(np.concatenate, zip(*held)), bits)
                    held, n_bytes = [], 0
        if held:
            yield pack_anchors(*map(np.concatenate, zip(*held)), bits)
        del held
        give_back_memory()

    packed = docs.select(text_key(), raw()).mapInArrow(find, ANCHOR)
    twice = packed.groupBy("bucket").applyInArrow(lean(repeated_places), PLACE)
    return stored(twice.groupBy("text_key").agg(F.collect_set("place").alias("places")), "anchors")


def _repeated(run: np.ndarray, key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by run, first of each run in it, whether the run stands in two places)."""
    order = np.argsort(run, kind="stable")
    run, key, place = run[order], key[order], place[order]
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]][: len(run)])
    if not len(run):
        return order, starts, np.zeros(0, bool)
    first = np.repeat(starts, np.diff(np.r_[starts, len(run)]))
    return order, starts, np.logical_or.reduceat((key != key[first]) | (place != place[first]), starts)


def pack_anchors(run: np.ndarray, key: np.ndarray, place: np.ndarray, bits: int) -> pa.RecordBatch:
    """``ANCHOR`` rows of a stretch of text, whose anchors come text by text: to the bucket of each run its
    anchors, or a mark that it is repeated; places known to be repeated go to the bucket of their text."""
    order, starts, twice = _repeated(run, key, place)
    known = np.zeros(len(run), bool)
    known[order] = np.repeat(twice, np.diff(np.r_[starts, len(run)]))
    marks = run[order[starts[twice]]]
    bucket_of = lambda x: (x >> _U(64 - bits)).astype(np.int64)
    rest, sure = np.flatnonzero(~known), np.flatnonzero(known)
    rows = {}
    for i, at in _by_bucket(bucket_of(run[rest]), rest):
        rows.setdefault(i, [b"", b"", b"", b""])[:2] = _placed(key[at], place[at], run[at])
    for i, at in _by_bucket(bucket_of(marks), np.arange(len(marks))):
        rows.setdefault(i, [b"", b"", b"", b""])[2] = marks[at].tobytes()
    for i, at in _by_bucket(bucket_of(mixed(key[sure].view(_U))), sure):
        keys, blob = _placed(key[at], place[at], np.zeros(0, _U))
        rows.setdefault(i, [b"", b"", b"", b""])[3] = len(keys).to_bytes(8, "little") + keys + blob
    columns = [list(rows), *zip(*rows.values())] if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow_schema(ANCHOR))], schema=arrow_schema(ANCHOR))


def _by_bucket(bucket: np.ndarray, rows: np.ndarray):
    """(bucket, its ``rows`` in their order) of each."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]][: len(bucket)])
    for low, high in zip(edges, np.r_[edges[1:], len(bucket)]):
        yield int(bucket[low]), rows[order[low:high]]


def _placed(key: np.ndarray, place: np.ndarray, run: np.ndarray) -> tuple[bytes, bytes]:
    """(text keys, packed steps of texts and places), followed by the runs; a text's places stand together."""
    fresh = np.r_[True, key[1:] != key[:-1]][: len(key)]
    steps = np.where(fresh, place, place - np.r_[0, place[:-1]])
    blob = pack_columns(fresh.astype(np.int32), steps)
    return key[fresh].tobytes(), len(blob).to_bytes(8, "little") + blob + run.tobytes()


def _unplaced(keys: bytes, blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    size = 8 + int.from_bytes(blob[:8], "little")
    fresh, steps = unpack_columns(blob[8:size], 2)
    text, sums, starts = np.cumsum(fresh) - 1, np.cumsum(steps, dtype=np.int64), np.flatnonzero(fresh)
    place = sums - (sums[starts] - steps[starts])[text]
    return np.frombuffer(blob[size:], _U), np.frombuffer(keys, np.int64)[text], place.astype(np.int32)


def repeated_places(table: pa.Table) -> pa.Table:
    """``PLACE`` rows of one bucket: the places of its runs that occur twice, and those known before."""
    keys, blobs, marks, known = (table.column(c).to_pylist() for c in ("keys", "anchors", "marks", "known"))
    none = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int32)
    run, key, place = map(np.concatenate, zip(none, *(_unplaced(k, x) for k, x in zip(keys, blobs) if x)))
    order, starts, twice = _repeated(run, key, place)
    twice |= np.isin(run[order[starts]], np.frombuffer(b"".join(marks), _U))
    out = order[np.repeat(twice, np.diff(np.r_[starts, len(run)]))]
    sure = [_unplaced(x[8 : 8 + (n := int.from_bytes(x[:8], "little"))], x[8 + n :])[1:] for x in known if x]
    text, at = map(np.concatenate, zip((key[out], place[out]), *sure))
    return pa.table([pa.array(text), pa.array(at.astype(np.int64))], schema=arrow_schema(PLACE))


def _one_row_each(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (``text_key``, ``least``, ...) with the bytes of its text, from the rows of the smallest id: of a table with
    equal rows more than one. Other texts, and copies, aren't shuffled."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(), raw())
    one = rows.join(few_broadcast(wanted.select("text_key", "least")), "text_key").where(F.col("doc_id").eqNullSafe(F.col("least")))
    return one.drop("doc_id", "least").join(wanted, "text_key")


def fragments(docs: DataFrame, texts: DataFrame, places: DataFrame, plan: Plan) -> DataFrame:
    """The fragments around repeated anchors of one row of each text, by their hashes; stored."""
    schema = arrow_schema(FRAGMENT)

    def cut(batch):
        names = ("text_key", "least", "copies")
        columns = {c: batch.column(c) for c in names}
        lists = batch.column("places").to_pylist()
        for low, high, data, edges in slices(batch.column("raw")):
            values, _, first = tokens_of(plan, data, edges)
            run, first = runs(values, plan.prefix), np.asarray(first)
            counts = [len(x) for x in lists[low:high]]
            of = np.repeat(np.arange(high - low), counts)
            place = np.array([p for x in lists[low:high] for p in sorted(x)], np.int64)
            at = place + first[of]
            back = np.minimum(place, plan.reach)
            ahead = np.minimum(first[1:][of] - at, plan.length)
            whole = back + ahead >= plan.length
            of, place, at, back, ahead = of[whole], place[whole], at[whole], back[whole], ahead[whole]
            up, down = powers(len(values) + 1)
            sums = np.r_[_U(0), np.cumsum(values * up[: len(values)])]
            body = mixed((sums[at + ahead] - sums[at - back]) * down[at - back] + mixed((back * 1024 + ahead).astype(_U)))
            ids = [columns[c].slice(low, high - low).take(pa.array(of)) for c in names]
            yield pa.RecordBatch.from_arrays([
                pa.array(run[at].view(np.int64)), pa.array(body.view(np.int64)), ids[0], pa.array(place), ids[1], ids[2],
                pa.array(back.astype(np.int32)), pa.array(ahead.astype(np.int32)),
            ], schema=schema)

    wanted = stored(places.join(texts, "text_key"), "wanted")
    met = _one_row_each(docs, wanted)
    return stored(map_batches(met.select("text_key", "least", "copies", "places", "raw"), cut, FRAGMENT), "fragments")


def unified(found: DataFrame) -> DataFrame:
    """Equal fragments as one row: their copies, and the first of them. Stored."""
    drop_shuffles(found.sparkSession)
    order = F.min(F.struct(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "text_key", "place")).alias("first")
    one = found.groupBy("run", "body", "back", "ahead").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("held"), order)
    return stored(one.select("run", "body", "first.text_key", "first.place", "first.doc_id", "copies", "held", "back", "ahead"), "unified")


def bodies(docs: DataFrame, texts: DataFrame, one: DataFrame, plan: Plan) -> DataFrame:
    """``BODY`` rows of the fragments of ``unified`` whose anchor has others, stored; ``hot`` if it has over ``GROUP``. A
    fragment has more than one row if its text stands in equal rows."""
    schema = arrow_schema(BODY)
    names = ("place", "run", "doc_id", "copies", "back", "ahead", "hot")

    def cut(batch):
        lists, keys = batch.column("wanted"), batch.column("text_key")
        for low, high, data, edges in slices(batch.column("raw")):
            _, tokens, first = tokens_of(plan, data, edges)
            part = lists.slice(low, high - low)
            of, flat = np.repeat(np.arange(high - low), part.value_lengths().to_numpy()), part.flatten()
            columns = dict(zip(names, flat.flatten()))
            place, back, ahead = (columns[c].to_numpy() for c in ("place", "back", "ahead"))
            at = place + np.asarray(first)[of]
            cuts = [tokens[s:e].tobytes() for s, e in zip(at - back, at + ahead)]
            own = columns | {"text_key": keys.slice(low, high - low).take(pa.array(of)), "tokens": pa.array(cuts, pa.binary())}
            yield pa.RecordBatch.from_arrays([own[c] for c in schema.names], schema=schema)

    sizes = stored(one.groupBy("run").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("run", (F.col("n") > GROUP).alias("hot")), "groups")
    listed = one.join(sizes, "run").groupBy("text_key").agg(F.collect_list(F.struct(*names)).alias("wanted"))
    wanted = stored(listed.join(texts.select("text_key", "least"), "text_key"), "wanted")
    drop_shuffles(one.sparkSession)
    met = _one_row_each(docs, wanted)
    cuts = stored(map_batches(met.select("text_key", "wanted", "raw"), cut, BODY), "bodies")
    drop_shuffles(one.sparkSession)
    return cuts


def _by_group(batches, change):
    """``change`` on tables of whole groups of ``run``, which come sorted by it."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        run = rest.column("run").to_numpy()
        cut = len(run) - int(np.argmin(np.r_[run[::-1] == run[-1], False]))
        if cut >= 6000:
            yield from change(rest.slice(0, cut))
            rest = rest.slice(cut)
    if rest is not None and rest.num_rows:
        yield from change(rest)


def covered(cuts: DataFrame, plan: Plan, compare: Callable, ordered: bool) -> DataFrame:
    """(``text_key``, ``low``, ``high``): tokens covered by repeated stretches, for the first
    occurrence of each fragment of ``bodies``. ``compare`` tells the fragments of a table of
    groups which stretches are repeated: (smallest, largest) steps back, or none. Stored."""
    schema = arrow_schema(SPAN)
    names = ["run", "text_key", "place", "doc_id", "copies", "back", "ahead", "tokens"]

    def group(table):
        run, key, at = (table.column(c).to_numpy() for c in ("run", "text_key", "place"))
        fresh = np.r_[True, (run[1:] != run[:-1]) | (key[1:] != key[:-1]) | (at[1:] != at[:-1])]
        table = table if fresh.all() else table.filter(pa.array(fresh))
        low, high = compare(table, plan)
        at = np.flatnonzero(high >= 0)
        place = table.column("place").to_numpy()[at]
        yield pa.RecordBatch.from_arrays([
            pa.array(table.column("text_key").to_numpy()[at]), pa.array(place - high[at]), pa.array(place - low[at] + plan.length),
        ], schema=schema)

    dealt = cuts.where("not hot").select(*names).repartition("run").sortWithinPartitions("run", "text_key", "place")
    near = stored(dealt.mapInArrow(lambda b: _by_group(b, group), SPAN), "near")
    drop_shuffles(cuts.sparkSession)

    # anchors with many fragments: each stretch is a key of its own, with the anchor and its place in
    # the stretch, as one that holds two anchors, or one anchor twice, comes from both
    big = cuts.where("hot").select(*names)
    if not big.limit(1).count():
        return near
    window = "stretch bigint, at bigint, run bigint, text_key bigint, doc_id bigint, copies bigint, low bigint"
    opened = arrow_schema(window)

    def stretches(batch):
        for i in range(0, batch.num_rows, 2000):
            part = batch.slice(i, 2000)
            matrix, start, end = fragment_matrix(part, plan)
            hashes = stretch_hashes(matrix, plan)
            row, o = np.nonzero((start[:, None] <= hashes[1]) & (hashes[1] + plan.length <= end[:, None]))
            place = part.column("place").to_numpy() - plan.reach
            yield pa.RecordBatch.from_arrays([
                pa.array(hashes[0][row, o].view(np.int64)), pa.array(o), *[pa.array(part.column(c).to_numpy(zero_copy_only=False)[row]) for c in ("run", "text_key", "doc_id", "copies")],
                pa.array(place[row] + hashes[1][o]),
            ], schema=opened)

    every = map_batches(big, stretches, window)
    if ordered:
        rank = F.min(F.struct("doc_id", "low", "text_key")).alias("first")
        first = stored(every.groupBy("run", "stretch", "at").agg(rank), "stretches")
        again = every.join(first, ["run", "stretch", "at"]).where(F.struct("doc_id", "low", "text_key") != F.col("first"))
    else:
        copies = stored(every.groupBy("run", "stretch", "at").agg(F.sum("copies").alias("n")).where("n > 1"), "stretches")
        again = every.join(copies, ["run", "stretch", "at"])
    # neighbouring stretches of a text are one span before they are shuffled on
    far = again.select("text_key", F.floor(F.col("low") / plan.length).alias("cell"), "low").groupBy("text_key", "cell").agg(F.sort_array(F.collect_set("low")).alias("lows"))
    spans = far.select("text_key", F.explode("lows").alias("low")).select("text_key", "low", (F.col("low") + plan.length).alias("high"))
    far = stored(spans, "far")
    drop_shuffles(cuts.sparkSession)
    return near.union(far)


def fragment_matrix(table, plan: Plan):
    """Fragments aligned at their anchors: (tokens, first and end column of each)."""
    back, ahead = (table.column(c).to_numpy().astype(np.int64) for c in ("back", "ahead"))
    matrix = np.zeros((len(back), plan.reach + plan.length), plan.kind)
    start, end = plan.reach - back, plan.reach + ahead
    for i, tokens in enumerate(table.column("tokens")):
        matrix[i, start[i] : end[i]] = np.frombuffer(tokens.as_buffer(), plan.kind)
    return matrix, start, end


def prefix_hashes(matrix: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the prefixes of every row."""
    up, _ = powers(matrix.shape[1] + 1)
    sums = np.zeros((len(matrix), matrix.shape[1] + 1), _U)
    np.cumsum(mixed(matrix.astype(_U) + _U(1)) * up[: matrix.shape[1]], axis=1, out=sums[:, 1:])
    return sums


def stretch_hashes(matrix: np.ndarray, plan: Plan):
    """(hash of each stretch that holds the anchor, its first column)."""
    sums, columns = prefix_hashes(matrix), np.arange(plan.reach + 1)
    _, down = powers(matrix.shape[1] + 1)
    return mixed((sums[:, columns + plan.length] - sums[:, columns]) * down[columns]), columns


def with_info(rows: DataFrame, info: DataFrame) -> DataFrame:
    """``rows`` with the row of ``info`` of their text, if any. Only texts that have one are shuffled, unless they are too
    many for their keys to be broadcast."""
    keys = info.select("text_key").withColumn("_met", F.lit(True))
    if keys.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return rows.join(info, "text_key", "left")
    flagged = rows.join(F.broadcast(keys), "text_key", "left")
    met = flagged.where("_met").drop("_met").join(info, "text_key")
    return met.unionByName(flagged.where("_met is null").drop("_met"), allowMissingColumns=True)


def results(docs: DataFrame, texts: DataFrame, one: DataFrame, found: DataFrame, spans: DataFrame, plan: Plan, ordered: bool, change: Callable, schema: str) -> DataFrame:
    """``change`` on the bytes and the covered tokens of every document; all tokens of a text
    that a copy of its own makes repeated are covered."""
    held = F.col("copies") > 1 if not ordered else F.col("held") > 1
    first = one.where(held).select("run", "body", "back", "ahead", F.col("text_key").alias("first_key"), F.col("place").alias("first_place"))
    others = found.join(first, ["run", "body", "back", "ahead"])
    if ordered:
        others = others.where((F.col("text_key") != F.col("first_key")) | (F.col("place") != F.col("first_place")))
    full = stored(others.select("text_key", (F.col("place") - F.col("back")).alias("low"), (F.col("place") + F.col("ahead")).alias("high")), "full")
    drop_shuffles(docs.sparkSession)
    merged = spans.union(full).groupBy("text_key").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    info = stored(texts.join(merged, "text_key", "left").where("copies > 1 or spans is not null"), "spans")
    drop_shuffles(docs.sparkSession)
    rows = with_info(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key(), raw()), info)
    whole = F.coalesce(F.col("copies") > 1, F.lit(False))
    if ordered:
        whole &= ~F.col("doc_id").eqNullSafe(F.col("least"))
    lows, highs = (F.coalesce(F.col(f"spans.{n}"), F.array().cast("array<bigint>")).alias(f"{n}s") for n in ("low", "high"))
    return map_batches(rows.select("doc_id", "raw", whole.alias("whole"), lows, highs), change, schema)


def covered_tokens(n: int, whole: bool, lows: np.ndarray, highs: np.ndarray, plan: Plan) -> np.ndarray:
    """Which of ``n`` tokens are covered."""
    if whole and n >= plan.length:
        return np.ones(n, bool)
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, lows, 1)
    np.add.at(steps, highs, -1)
    return np.cumsum(steps[:-1]) > 0
