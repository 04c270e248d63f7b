"""Exact top-k by inner product with no random access (Fagin, Lotem and Naor 2001).

Candidates lie in blocks. In a block every dimension is a list of its candidates
sorted by value; a query reads a list from its large end where its own component
is positive, and from its small end where it is negative, so the products fall as
the list is read. All lists are read in step, deeper each time. What has been
read bounds every candidate's score from both sides: an unread product lies
between the last one read from its list and the least one the list can give. A query
is done when no candidate outside its ``k`` best lower bounds can reach the k-th of
them; the candidates still possible are then resolved to their exact scores.

The bounds of all queries of a block are computed together, as matrix products
with the read and the unread part of the lists. Blocks of queries meet blocks of
candidates, never all rows with all rows at once, and each meeting yields ``k`` rows
per query. Work is queries times candidates, which exactness asks for; the lists
cut short what is read of each.

Components become ``floor(1024 * x)``; scores are exact integers.

Defined cases: vectors that are null or hold a null, NaN or infinity take no part;
vectors of different length are filled up with zeros; an empty vector scores 0; a
query's own row is any row of its id, and a repeated query id is asked once, with the
smallest of its vectors; repeated candidates are candidates each; other columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from pairloom.llm.common import arrow_schema, map_batches
from pairloom.session import stored

SCALE = 1024
CANDIDATES = 2048
QUERIES = 512
#: Shares of the lists read before each test of the stopping rule.
DEPTHS = (0.1, 0.25, 0.5, 1.0)
_EXACT = float(1 << 52)
FOUND = "query_id bigint, vec_id bigint, score bigint"


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(``id``, ``v``): integer components of the vectors that take part."""
    x = F.col(vector)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    scaled = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint"))
    return vectors.where(x.isNotNull() & ~bad).select(F.col(id_col).cast("bigint").alias("id"), scaled.alias("v")).where("id is not null")


BLOCK = "n int, dim int, ids binary, cells binary"


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows packed ``size`` to a block, as they lie in their partitions, each with a number
    of its own; to be stored before use, which settles the numbers."""
    schema = arrow_schema(BLOCK)

    def pack(batches):
        for batch in batches:
            ids, lists = batch.column("id").to_numpy(zero_copy_only=False), batch.column("v")
            flat, edges = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.zeros(len(ids) + 1, np.int64)
            lengths = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
            np.cumsum(lengths, out=edges[1:])
            for low in range(0, len(ids), size):
                high = min(len(ids), low + size)
                dim = int(lengths[low:high].max(initial=0))
                cells = np.zeros((high - low, dim), np.int64)
                cells[np.arange(dim) < lengths[low:high, None]] = flat[edges[low] : edges[high]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([high - low], pa.int32()), pa.array([dim], pa.int32()),
                    pa.array([ids[low:high].astype(np.int64).tobytes()]), pa.array([cells.tobytes()]),
                ], schema=schema)

    return rows.mapInArrow(pack, BLOCK).withColumn("block", F.monotonically_increasing_id())


def _matrix(ids: bytes, cells: bytes, n: int, dim: int, width: int):
    out = np.zeros((n, width), np.int64)
    out[:, :dim] = np.frombuffer(cells, np.int64).reshape(n, dim)
    return np.frombuffer(ids, np.int64), out


class SortedLists:
    """The lists of a block: each dimension's candidates in order of their value."""

    def __init__(self, values: np.ndarray):
        self.values, n = values, len(values)
        order = np.argsort(values, axis=0, kind="stable")
        self.place = np.empty_like(order)
        np.put_along_axis(self.place, order, np.arange(n)[:, None], axis=0)
        self.sorted = np.take_along_axis(values, order, axis=0)

    def read(self, depth: int):
        """The parts of the matrix that ``depth`` steps have read from the large and the small
        ends, what is unread there, and the last values read from either end."""
        n = len(self.values)
        high, low = self.place >= n - depth, self.place < depth
        return high, low, self.sorted[n - depth], self.sorted[depth - 1]


def best_in_block(lists: SortedLists, ids: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, depths=DEPTHS):
    """(query number, candidate number, score) of the ``k`` best of a block for each query."""
    n, dim = lists.values.shape
    values, asked = lists.values.astype(np.float64), queries.astype(np.float64)
    up, down = np.maximum(asked, 0), np.minimum(asked, 0)
    exact = max(1.0, np.abs(values).max(initial=0)) * max(1.0, np.abs(asked).max(initial=0)) * max(1, dim) < _EXACT
    slack = 0.0 if exact else max(1.0, np.abs(values).max(initial=0)) * max(1.0, np.abs(asked).max(initial=0)) * max(1, dim) * 1e-12
    own_row, own_column = np.nonzero(query_ids[:, None] == ids[None, :])
    open_queries, out = np.arange(len(asked)), []
    for share in depths:
        depth = max(1, min(n, int(np.ceil(n * share))))
        high, low, last_high, last_low = lists.read(depth)
        u, d = up[open_queries], down[open_queries]
        known = u @ (values * high).T + d @ (values * low).T
        if depth < n:
            upper = known + (u * last_high) @ (~high).T.astype(np.float64) + (d * last_low) @ (~low).T.astype(np.float64)
            lower = known + (u * lists.sorted[0]) @ (~high).T.astype(np.float64) + (d * lists.sorted[-1]) @ (~low).T.astype(np.float64)
        else:
            upper, lower = known, known.copy()
        at = np.full(len(asked), -1)
        at[open_queries] = np.arange(len(open_queries))
        mine = at[own_row] >= 0
        upper[at[own_row[mine]], own_column[mine]] = -np.inf
        lower[at[own_row[mine]], own_column[mine]] = -np.inf
        kth = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(open_queries), -np.inf)
        able = (upper >= (kth - slack)[:, None]) & (upper > -np.inf)
        done = (able.sum(axis=1) <= 4 * k) | (depth == n)
        row, column = np.nonzero(able & done[:, None])
        asked_by = open_queries[row]
        score = np.einsum("ij,ij->i", lists.values[column], queries[asked_by])
        order = np.lexsort((ids[column], -score, asked_by))
        asked_by, column, score = asked_by[order], column[order], score[order]
        starts = np.flatnonzero(np.r_[True, asked_by[1:] != asked_by[:-1]]) if len(asked_by) else np.zeros(0, int)
        place = np.arange(len(asked_by)) - np.repeat(starts, np.diff(np.r_[starts, len(asked_by)]))
        held = place < k
        out.append((asked_by[held], column[held], score[held]))
        open_queries = open_queries[~done]
        if not len(open_queries):
            break
    return tuple(np.concatenate(part) for part in zip(*out))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, candidates: int = CANDIDATES, asked: int = QUERIES) -> DataFrame:
    """The ``k`` best candidates of each query, both as of ``whole_vectors``:
    (``query_id``, ``rank``, ``vec_id``, ``score``)."""
    once = queries.groupBy("id").agg(F.min("v").alias("v"))
    query_blocks = stored(blocks(once, asked), "queries").withColumn("turn", F.col("block"))
    # one row per block of queries: the turns a block of candidates has to take
    turns = query_blocks.select("turn", F.col("n").alias("q_n"), F.col("dim").alias("q_dim"), F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells"))
    packed = stored(blocks(vectors, candidates), "candidates")
    numbers = [row["turn"] for row in turns.select("turn").distinct().collect()]  # one number per `asked` queries
    met = packed.withColumn("turn", F.explode(F.array(*[F.lit(x).cast("bigint") for x in numbers]).cast("array<bigint>"))).join(turns, "turn")
    schema = arrow_schema(FOUND)

    def search(batch):
        kept = None
        for row in batch.to_pylist():
            width = max(row["dim"], row["q_dim"])
            query_ids, asked_for = _matrix(row["q_ids"], row["q_cells"], row["q_n"], row["q_dim"], width)
            if kept is None or kept[0] != (row["block"], width):
                ids, values = _matrix(row["ids"], row["cells"], row["n"], row["dim"], width)
                kept = ((row["block"], width), ids, SortedLists(values))
            q, c, score = best_in_block(kept[2], kept[1], query_ids, asked_for, k)
            yield pa.RecordBatch.from_arrays([pa.array(query_ids[q]), pa.array(kept[1][c]), pa.array(score)], schema=schema)

    found = map_batches(met.repartition("block", "turn"), search, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
