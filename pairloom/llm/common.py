"""What several operators share."""

from __future__ import annotations

import ctypes
import functools
import pathlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from pairloom.session import give_back_memory, small_batches, stored

#: A regular expression for one word.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of ids or keys up to this number are broadcast; beyond it the other side is shuffled to meet them.
BROADCAST_ROWS = 4_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw(column: str | Column = "text") -> Column:
    """A text as its UTF-8 bytes, a null as no bytes."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string").cast("binary"), F.lit(b"")).alias("raw")


def text_bytes(batch: pa.RecordBatch) -> pa.Array:
    """The column ``text`` of a batch, whatever its type, for functions that read its bytes."""
    column = batch.column("text")
    return column if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column.cast(pa.string())


def word_count(column: Column) -> Column:
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("bigint")


def free_name(taken: list[str], name: str) -> str:
    """``name``, lengthened until no column has it."""
    held = {c.lower() for c in taken}
    while name.lower() in held:
        name += "_"
    return name


def map_batches(df: DataFrame, change: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``change`` on each Arrow batch of ``df``."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from change(batch)
        give_back_memory()

    return df.mapInArrow(run, schema)


def lean(change: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``change`` for whole groups, after each of which freed memory is handed back."""

    def run(table):
        try:
            return change(table)
        finally:
            give_back_memory()

    return run


def few_broadcast(keys: DataFrame) -> DataFrame:
    """A stored table of ids or keys, marked for broadcast if it has no more than ``BROADCAST_ROWS`` rows."""
    return F.broadcast(keys) if keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else keys


def map_rows(docs: DataFrame, change: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``change`` on each Arrow batch of whole rows, texts and all. Such batches are bounded by bytes, as
    a task holds several copies of one; a bound that the session has set itself stays."""
    small_batches(docs.sparkSession)
    return map_batches(docs, change, docs.schema)


@functools.cache
def one_matrix_thread() -> None:
    """Matrix products of this worker in one thread, as the tasks beside it have the other cores: threads that
    wait for each other on small matrices burn as much time as they save. Without the OpenBLAS that comes
    with numpy nothing is changed."""
    for path in pathlib.Path(np.__file__).parent.parent.glob("numpy.libs/*openblas*"):
        library = ctypes.CDLL(str(path))
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)
                break


def _planes(column: np.ndarray) -> bytes:
    """Numbers as four stretches of bytes, of which the high ones are mostly zeros."""
    return column.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def pack_columns(*columns: np.ndarray) -> bytes:
    """Columns of 32-bit numbers, compressed."""
    body = b"".join(map(_planes, columns))
    return len(body).to_bytes(8, "little") + pa.Codec("zstd", 3).compress(body, asbytes=True)


def unpack_columns(blob: bytes, width: int) -> list[np.ndarray]:
    size = int.from_bytes(blob[:8], "little")
    body = np.frombuffer(pa.decompress(blob[8:], size, codec="zstd", asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
    planes = body.reshape(width, 4, -1)
    return [np.ascontiguousarray(p.T).view("<i4").reshape(-1) for p in planes]


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow schema of a DDL string of plain types."""
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
        "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
        "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    }
    fields = [part.strip().split(" ", 1) for part in schema.split(", ")]
    return pa.schema([pa.field(name, kinds[kind]) for name, kind in fields])


def ranked(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """1-based position of each row of a narrow table in ``order``: ranges of the
    order are dealt to tasks, sorted there, and shifted by the rows of earlier ranges."""
    spread = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = spread.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (
        spread.withColumn(name, inside)
        .join(before, "_range")
        .withColumn(name, (F.col(name) + F.col("_before")).cast("bigint"))
        .drop("_range", "_before")
    )


def linked_classes(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``): each node of ``edges`` (``a``, ``b``) with the smallest
    node it is linked to, directly or through others.

    Alternating large and small stars: every round hangs the neighbours of each
    node under the smallest of them, in two shuffles over the edges; a round is
    written to the shared folder, and the number of rounds grows with the logarithm
    of the longest chain. A hub's edges are counted before they are shuffled and
    joined, which the adaptive skew join splits; no node's edges meet in one task.
    """
    def directed(pairs):
        return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    def stars(pairs, both: bool):
        links = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if both else pairs
        least = links.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        met = links.join(least, "a")
        if both:
            out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
                least.select("a", F.col("m").alias("b"))
            )
        return directed(out)

    def state(pairs):
        return pairs.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("decimal(20,0)"))).first()

    pairs = stored(directed(edges), "links")
    was = state(pairs)
    while was[0]:
        pairs = stored(stars(stars(pairs, True), False), "links")
        now = state(pairs)
        if now == was:
            break
        was = now
    roots = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
