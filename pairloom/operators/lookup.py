"""Token by token lookups in a table: ids, rows, vectors, base forms.

Tables are stored DataFrames with one row per token (see ``session.stored``);
their measured size decides how they are met:

- a small one becomes a constant of the plan: a narrow projection;
- one up to ``EXPLODE_BYTES`` that holds no lists is broadcast to the exploded tokens;
- a larger one is met by blocks: rows are dealt by their unique id to blocks of about
  ``BLOCK_TOKENS`` tokens, the different tokens of a block are joined with the table, and what
  they find goes back to the block, where every list looks its tokens up. What is joined
  is a row per block and token, never one per place of a token, and lists stay whole.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from pairloom.functions import arrays as A, text as T
from pairloom.operators.sizing import (
    BROADCAST_BYTES,
    LITERAL_BYTES,
    join_table,
    literal_lookup,
    measure,
    require_unique,
)
from pairloom.session import stored


#: The largest table that is broadcast to exploded tokens: the tokens regrouped there must fit a task
EXPLODE_BYTES = 16 * 1024 * 1024
#: Tokens of a block, whose different ones and what they find a task holds
BLOCK_TOKENS = 1 << 20
#: Bytes of the hits of lists that are given out at a time
SLICE_BYTES = 4 << 20


def map_tokens(
    df: DataFrame,
    tokens: dict[str, Column],
    table: DataFrame,
    hit: Column,
    value: Callable[[Column, Column], Column],
    key: str = "pair_id",
    keep: list[str] = (),
    literal_bytes: int = LITERAL_BYTES,
    max_bytes: int = BROADCAST_BYTES,
    salts: int = 1,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Replace each token by ``value(token, hit)``, where ``hit`` is an expression
    over the columns of ``table`` for that token, null where the table lacks it.

    ``tokens`` maps output column -> token list. The result has ``key``, the
    ``keep`` columns and the outputs, in token order; an empty list stays empty, a null
    list null.

    Tokens of the table and keys of ``df`` must be unique, whatever the size of either:
    both are checked before the way is chosen, and a repeat is an error. A block holds a
    token once, so that no token is hot in the join and ``salts`` is rarely needed.
    """
    size = measure(table, "token")
    if size["different"] < size["rows"]:
        require_unique(table, "token")
    found = literal_lookup(table, "token", hit, literal_bytes, size)
    if found is not None:
        require_unique(df, key)
        return df.select(
            key, *keep, *[F.transform(c, lambda t: value(t, found(t))).alias(o) for o, c in tokens.items()]
        )
    outputs, hits = list(tokens), table.select("token", hit.alias("_hit"))
    kind = hits.schema["_hit"].dataType
    if size["bytes"] <= min(max_bytes, EXPLODE_BYTES) and not isinstance(kind, ArrayType):
        require_unique(df, key)
        return _exploded(df, tokens, hits, value, key, keep)
    lists = [f"_list{side}" for side in range(len(outputs))]
    # stored, as it is read three times and finding the tokens of a text costs most
    listed = stored(df.select(key, *keep, *[c.alias(n) for n, c in zip(lists, tokens.values())]), "token-lists")
    blocks = -(-_tokens_of_unique(listed, key, lists) // block_tokens) or 1
    block = F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("_block")
    narrow = listed.select(block, *lists).repartition(blocks, "_block")
    every = F.flatten(F.array(*[F.coalesce(n, F.array().cast("array<string>")) for n in lists]))
    each = narrow.select("_block", F.explode_outer(every).alias("token")).where("token is not null").distinct()
    met = join_table(each, hits.where("_hit is not null"), "token", F.col("_block"), "inner", max_bytes, salts, size)
    rows = listed.select(block, F.lit(True).alias("_is_row"), "*").unionByName(
        met.select("_block", F.lit(False).alias("_is_row"), "token", "_hit"), allowMissingColumns=True
    )
    together = rows.repartition(blocks, "_block").sortWithinPartitions("_block", "_is_row")
    fields = [listed.schema[c] for c in (key, *keep, *lists)]
    schema = StructType([StructField(f.name, f.dataType) for f in fields] + [StructField(f"_hits{n}", ArrayType(kind)) for n in lists])
    looked_up = together.mapInArrow(_hits_of_lists([key, *keep], lists), schema)
    return looked_up.select(
        key, *keep, *[F.zip_with(n, f"_hits{n}", value).alias(o) for n, o in zip(lists, outputs)]
    )


def _exploded(
    df: DataFrame, tokens: dict[str, Column], hits: DataFrame, value: Callable[[Column, Column], Column], key: str, keep: list[str]
) -> DataFrame:
    """``map_tokens`` by exploding the lists of rows partitioned by their key, and regrouping them there, so that
    whole texts move once and the regrouping moves nothing."""
    outputs = list(tokens)
    one_side = df.repartition(key).select(
        key, *keep, F.posexplode_outer(F.array(*tokens.values())).alias("side", "_tokens")
    )
    # a null list is kept as one row before the first position; flagged ahead of
    # the explode, as otherwise each token would carry its whole list along
    flagged = one_side.withColumn("_missing", F.col("_tokens").isNull())
    exploded = flagged.select(
        key, *keep, "side", "_missing", F.posexplode_outer("_tokens").alias("pos", "token")
    ).withColumn("pos", F.when(F.col("_missing"), -1).otherwise(F.col("pos"))).drop("_missing")
    joined = exploded.join(F.broadcast(hits), "token", "left")
    changed = joined.withColumn("_value", value(F.col("token"), F.col("_hit")))
    grouped = changed.groupBy(key, *keep).agg(*[
        F.sort_array(
            F.collect_list(
                F.when((F.col("side") == side) & F.col("pos").isNotNull(), F.struct("pos", "_value"))
            )
        ).alias(f"_{side}")
        for side in range(len(outputs))
    ])
    return grouped.select(
        key,
        *keep,
        *[
            F.when(~(F.coalesce(F.get(f"_{side}", F.lit(0))["pos"], F.lit(0)) < 0), F.col(f"_{side}")["_value"])
            .alias(output)
            for side, output in enumerate(outputs)
        ],
    )


def _tokens_of_unique(listed: DataFrame, key: str, lists: list[str]) -> int:
    """The number of tokens of all ``lists``; an error if two rows have one ``key``."""
    size = sum((F.coalesce(F.greatest(F.size(n), F.lit(0)), F.lit(0)) for n in lists), F.lit(0)).cast("bigint")
    rows = listed.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("tokens"))
    found = rows.agg(F.sum("tokens"), F.max("n"), F.max_by(F.struct(key), "n")).first()
    if (found[1] or 0) > 1:
        raise ValueError(f"{key} {found[2][0]!r} is not unique")
    return found[0] or 0


def _hits_of_lists(names: list[str], lists: list[str]):
    """From rows in order of block, first the hits of its tokens, then its lists: the lists with the hit of each token."""

    def work(batches):
        block, parts, held = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("_block").to_numpy()
            for low, high in _runs(ids):
                if ids[low] != block:
                    block, parts, held = ids[low], [], None
                of_block = batch.slice(low, high - low)
                first = int(np.searchsorted(of_block.column("_is_row").to_numpy(zero_copy_only=False), True))
                if first:
                    parts.append(of_block.slice(0, first).select(["token", "_hit"]))
                if first < high - low:
                    held = held or _joined_hits(parts, batch.schema)
                    yield from _with_hits(of_block.slice(first), names, lists, *held)

    return work


def _runs(ids: np.ndarray):
    begin = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    return zip(begin.tolist(), np.append(begin[1:], len(ids)).tolist())


def _joined_hits(parts: list[pa.RecordBatch], schema: pa.Schema) -> tuple[pa.Array, pa.Array]:
    if not parts:
        return tuple(pa.array([], schema.field(n).type) for n in ("token", "_hit"))
    return tuple(pa.concat_arrays([p.column(n) for p in parts]) for n in ("token", "_hit"))


def _with_hits(rows: pa.RecordBatch, names: list[str], lists: list[str], tokens: pa.Array, hits: pa.Array):
    columns = [rows.column(n) for n in lists]
    sizes = [pc.fill_null(pc.list_value_length(c), 0).to_numpy().astype(np.int64) for c in columns]
    edges = [np.r_[0, np.cumsum(s)] for s in sizes]
    places = [pc.index_in(c.flatten(), value_set=tokens) for c in columns]
    room = max(1, SLICE_BYTES // (16 + hits.nbytes // max(1, len(hits))))
    low, total = 0, sum(edges)
    while low < rows.num_rows:
        high = max(low + 1, int(np.searchsorted(total, total[low] + room, side="right")) - 1)
        out = [rows.column(n).slice(low, high - low) for n in (*names, *lists)]
        for column, edge, place in zip(columns, edges, places):
            values = hits.take(place.slice(edge[low], edge[high] - edge[low]))
            offsets = pa.array((edge[low : high + 1] - edge[low]).astype(np.int32))
            out.append(pa.ListArray.from_arrays(offsets, values, mask=column.slice(low, high - low).is_null()))
        yield pa.RecordBatch.from_arrays(out, names=[*names, *lists, *[f"_hits{n}" for n in lists]])
        low = high


def _special_or(token: Column, otherwise: Column, cls: Column, sep: Column) -> Column:
    return F.when(token == T.CLS, cls).when(token == T.SEP, sep).otherwise(otherwise)


def token_ids(
    df: DataFrame, vocab: DataFrame, tokens: str | Column = "tokens", key: str = "pair_id",
    keep: list[str] = (), **sizes,
) -> DataFrame:
    """``ids``: the vocabulary id of each token, special tokens included, and
    the unknown id for the rest."""
    def value(token, hit):
        return _special_or(token, F.coalesce(hit, F.lit(A.UNK_ID)), F.lit(A.CLS_ID), F.lit(A.SEP_ID))

    return map_tokens(df, {"ids": _column(tokens)}, vocab, F.col("id"), value, key, keep, **sizes)


def piece_id_lists(
    df: DataFrame, pieces: DataFrame, tokens: str | Column = "tokens", key: str = "pair_id",
    keep: list[str] = (), **sizes,
) -> DataFrame:
    """``ids``: the ids of the pieces of each token, one list per text. ``pieces``
    is a stored table of ``wordpiece.piece_ids``."""
    def one(i):
        return F.array(F.lit(i))

    def value(token, hit):
        return _special_or(token, F.coalesce(hit, one(A.UNK_ID)), one(A.CLS_ID), one(A.SEP_ID))

    out = map_tokens(df, {"ids": _column(tokens)}, pieces, F.col("piece_ids"), value, key, keep, **sizes)
    return out.withColumn("ids", F.flatten("ids"))


def vocab_rows(
    df: DataFrame, vocab: DataFrame, tokens: str | Column = "tokens", key: str = "pair_id",
    keep: list[str] = (), **sizes,
) -> DataFrame:
    """``rows``: the row number of each token's vector, null if it has none."""
    return map_tokens(
        df, {"rows": _column(tokens)}, vocab, F.col("row"), lambda token, hit: hit, key, keep, **sizes
    )


def word_vectors(
    df: DataFrame, vectors: DataFrame, tokens: str | Column = "tokens", key: str = "pair_id",
    keep: list[str] = (), **sizes,
) -> DataFrame:
    """``vectors``: the vector of each token, null if it has none."""
    return map_tokens(
        df, {"vectors": _column(tokens)}, vectors, F.col("vector"), lambda token, hit: hit, key, keep, **sizes
    )


def lemmatize(
    df: DataFrame, lemmas: DataFrame, tokens: str | Column = "tokens", key: str = "pair_id",
    keep: list[str] = (), **sizes,
) -> DataFrame:
    """``lemmas``: the base form of each token; unknown forms unchanged."""
    table = lemmas.select(F.col("form").alias("token"), "lemma")
    return map_tokens(
        df, {"lemmas": _column(tokens)}, table, F.col("lemma"),
        lambda token, hit: F.coalesce(hit, token), key, keep, **sizes,
    )


def _column(tokens: str | Column) -> Column:
    return F.col(tokens) if isinstance(tokens, str) else tokens


def known_or_bare(token: Column, known: Column) -> Column:
    """A known token as it is, any other with its punctuation blanked."""
    return F.when(known, token).otherwise(T.replace_punct(token))


def fix_oov(
    df: DataFrame, vocab: DataFrame, tokens: str | Column = "tokens", key: str = "pair_id",
    keep: list[str] = (), **sizes,
) -> DataFrame:
    """``fixed``: punctuation blanked in tokens outside the vocabulary, then
    empty results dropped."""
    out = map_tokens(
        df, {"fixed": _column(tokens)}, vocab, F.col("token").isNotNull(), known_or_bare, key, keep, **sizes
    )
    return out.withColumn("fixed", F.filter("fixed", lambda t: t != ""))


def cleaning_table(vocab: DataFrame, lemmas: DataFrame) -> DataFrame:
    """(``token``, ``known``, ``once``, ``twice``): all that cleaning looks up, in one
    table: the base form of a token, and the base form of that, each null where
    there is none. An unknown token that punctuation is blanked in has none, as it is
    looked up without it. Both tables are stored ones, with unique tokens and forms.
    """
    require_unique(lemmas, "form")
    first = lemmas.select(F.col("form").alias("token"), F.col("lemma").alias("once"))
    second = lemmas.select(F.col("form").alias("once"), F.col("lemma").alias("twice"))
    bases = join_table(first, second, "once", F.col("token")).select("token", "once", "twice")
    known = vocab.select("token", F.lit(True).alias("known"))
    kept = F.col("known").isNotNull() | (T.replace_punct(F.col("token")) == F.col("token"))
    return known.join(bases, "token", "full").withColumns({c: F.when(kept, F.col(c)) for c in ("once", "twice")})


def clean_text(
    df: DataFrame,
    columns: dict[str, str],
    table: DataFrame,
    stops: list[str] = (),
    key: str = "pair_id",
    keep: list[str] = (),
    **sizes,
) -> DataFrame:
    """Cleaned text columns (text column -> output column).

    Lower case; tokens; out-of-vocabulary fix; base forms; stop words, only if
    ``stops`` are given; no punctuation; base forms again; joined by one blank.
    ``table`` is a stored ``cleaning_table``.
    """
    tokens = {out: T.tokenize(T.lower_text(F.col(c))) for c, out in columns.items()}

    def value(token, hit):
        once = F.coalesce(hit["once"], known_or_bare(token, hit["known"]))
        last = F.coalesce(hit["twice"], once)
        return F.when(once.isin(list(stops)), F.lit("")).otherwise(last) if stops else last

    out = map_tokens(df, tokens, table, F.struct("known", "once", "twice"), value, key, keep, **sizes)
    finished = {
        c: T.join_tokens(T.drop_punct(F.filter(c, lambda t: t != ""))) for c in columns.values()
    }
    return out.withColumns(finished)
