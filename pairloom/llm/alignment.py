"""Tokens of two tokenizers, aligned by the bytes they cover.

Every text is encoded by a byte-level and by a piece tokenizer. All tokens of both lie on one
line, in order of where they end, the piece last where two end together. Each token points
to the farthest-right token that shares a byte with it: the token of the other side that holds
its last byte. Pointers only lead to the right and end at a piece that ends where a
byte-level token does. Doubling the pointers of a whole slice of texts at once,
``next = next[next]`` until nothing changes, brings every token to the last one of its
group in as many steps as the logarithm of the longest chain; tokens with the
same last one are a group. A token whose own pointer leads to a last one that ends
where it does is linked with it.

How often two ids are linked is counted over the whole corpus: within each text, then
within each task, then by a shuffle of id pairs, so that a common pair or a hot text is no
hot key. The counts are joined back to the pairs of each text, broadcast if they are
measured to be small and else by a join with salted keys, and are summed up by text.

Texts beyond ``PART`` characters are encoded in parts, cut where neither tokenizer can join
across: before a single blank with letters or digits on both sides, that part's blank
being the one its tokenizer expects in front (no piece of the vocabulary has a blank after
another character, which is checked). A text without such a place is encoded whole.

Defined cases: texts that are null, empty, or that a tokenizer does not give back byte by byte
(one with U+2581, for instance) have no tokens, zeros and an empty digest; marks of special tokens
inside a text are text; ids may be null or repeated, every row counts; an empty table gives an
empty result; other columns are ignored. The tokenizers' folder is a parameter.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.common import arrow_schema, map_batches, raw
from pairloom.llm.words import slices
from pairloom.operators.sizing import join_table
from pairloom.session import stored

FOLDER = "/opt/tokenizers"
BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
PART = 1 << 16
SLICE = 1 << 18
BROADCAST_BYTES = 48 << 20
BLANK = "▁"
FOUND = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"
#: An id pair as one number
_SHIFT = 32
_CUT = re.compile(r"(?<=[^\W_]) (?=[^\W_])")


def byte_alphabet() -> dict[str, int]:
    """The characters a byte-level vocabulary writes bytes as: printable ones stand for
    themselves, the others for the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Side:
    """The bytes of each token id, and how many."""

    def __init__(self, entries: dict[int, bytes]):
        self.lengths = np.zeros(max(entries) + 1, np.int64)
        for i, value in entries.items():
            self.lengths[i] = len(value)
        self.table = pa.array([entries.get(i, b"") for i in range(len(self.lengths))], pa.binary())
        if 0 in {len(v) for v in entries.values()}:
            raise ValueError("a token without bytes")

    def gives(self, ids: list[list[int]], wanted: list[bytes]) -> np.ndarray:
        """Whether the tokens of each text are its ``wanted`` bytes; all texts are compared at once, and one by
        one only if they differ."""
        edges = np.r_[0, np.cumsum(np.array([len(x) for x in ids], np.int64))]
        flat = np.fromiter(chain.from_iterable(ids), np.int64, edges[-1])
        upto = np.r_[0, np.cumsum(self.lengths[flat])][edges]
        whole = np.diff(upto) == np.array([len(x) for x in wanted], np.int64)
        joined = self.table.take(pa.array(flat)).buffers()[2] if upto[-1] else pa.py_buffer(b"")
        if whole.all() and joined.slice(0, upto[-1]).equals(pa.py_buffer(b"".join(wanted))):
            return whole
        for i in np.flatnonzero(whole):
            whole[i] = joined.slice(upto[i], upto[i + 1] - upto[i]).equals(pa.py_buffer(wanted[i]))
        return whole


class Tokenizers:
    def __init__(self, folder: str, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(os.path.join(folder, byte_level))
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        special = {i for i, t in self.a.get_added_tokens_decoder().items() if t.special}
        plain = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items() if i not in special}
        self.side_a = Side({i: bytes(map(alphabet.__getitem__, t)) for i, t in plain.items()})
        self.b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, pieces))
        entries, self.can_cut = {}, True
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                entries[i] = bytes([int(piece[3:5], 16)])
            elif not (self.b.is_control(i) or self.b.is_unknown(i)):
                entries[i] = piece.replace(BLANK, " ").encode()
                self.can_cut &= BLANK not in piece.lstrip(BLANK)
            else:  # gives back no text; three bytes no text holds keep places defined
                entries[i] = b"\xff\xfe\xff"
        self.side_b = Side(entries)

    def parts(self, text: str) -> list[str]:
        """The text in parts of ``PART`` characters or more, without the blanks between."""
        out, begin = [], 0
        while self.can_cut and len(text) - begin > PART:
            cut = _CUT.search(text, begin + PART)
            if cut is None:
                break
            out.append(text[begin : cut.start()])
            begin = cut.end()
        return [*out, text[begin:]]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of both sides for each text, none for one that isn't given back."""
        cut = [self.parts(t) if len(t) > PART else [t] for t in texts]
        flat = [p for parts in cut for p in parts]
        coded_a = [e.ids for e in self.a.encode_batch_fast([" " + p for p in flat], add_special_tokens=False)]
        coded_b = self.b.encode(flat, num_threads=1)
        out_a, out_b, at = [], [], 0
        for text, parts in zip(texts, cut):
            for coded, out in ((coded_a, out_a), (coded_b, out_b)):
                out.append(([i for ids in coded[at : at + len(parts)] for i in ids] if len(parts) > 1 else coded[at]) if text else [])
            at += len(parts)
        wanted = [b" " + t.encode() if t else b"" for t in texts]
        for i in np.flatnonzero(~(self.side_a.gives(out_a, wanted) & self.side_b.gives(out_b, wanted))):
            out_a[i], out_b[i] = [], []
        return out_a, out_b


@functools.lru_cache(maxsize=2)
def tokenizers(folder: str, byte_level: str = BYTE_LEVEL, pieces: str = PIECES) -> Tokenizers:
    return Tokenizers(folder, byte_level, pieces)


def farthest(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places of A's tokens, places of B's, pointers) on the line of all tokens, which is in order of
    their ends, B after A. The ends of each side rise, and both sides end together."""
    n = len(end_a) + len(end_b)
    # the other side's token with a token's last byte is the first that ends there or later
    to_b, to_a = np.searchsorted(end_b, end_a), np.searchsorted(end_a, end_b)
    together = end_a[to_a] == end_b
    place_a = np.arange(len(end_a)) + to_b
    place_b = np.arange(len(end_b)) + to_a + together
    pointer = np.empty(n, np.int64)
    pointer[place_a] = place_b[to_b]
    pointer[place_b] = np.where(together, place_b, place_a[to_a])
    return place_a, place_b, pointer


def terminals(pointer: np.ndarray) -> np.ndarray:
    """Where the chain of pointers from each place ends."""
    while True:
        further = pointer[pointer]
        if np.array_equal(further, pointer):
            return pointer
        pointer = further


@functools.lru_cache(maxsize=2)
def _digits(most: int) -> np.ndarray:
    """The decimal digits of each number up to ``most``, zero bytes after them."""
    wide = len(str(most))
    return np.frombuffer(b"".join(str(i).encode().ljust(wide, b"\0") for i in range(most + 1)), np.uint8).reshape(-1, wide)


def aligned(ids_a: list[list[int]], ids_b: list[list[int]], tools: Tokenizers) -> list[tuple]:
    """Per text: (n_a, n_b, n_groups, n_links, digest of the groups, linked id pairs, their times)."""
    sizes_a, sizes_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    a, b = (np.fromiter(chain.from_iterable(ids), np.int64, n.sum()) for ids, n in ((ids_a, sizes_a), (ids_b, sizes_b)))
    first_a, first_b = (np.r_[0, np.cumsum(x)] for x in (sizes_a, sizes_b))
    if not len(a):
        return [(0, 0, 0, 0, "", [], [])] * len(ids_a)
    end_a, end_b = np.cumsum(tools.side_a.lengths[a]), np.cumsum(tools.side_b.lengths[b])
    place_a, place_b, pointer = farthest(end_a, end_b)
    last = terminals(pointer)
    # links: A tokens whose pointer is a last token that ends where they do
    is_b = np.full(len(pointer), -1, np.int64)
    is_b[place_b] = np.arange(len(b))
    met = is_b[pointer[place_a]]
    linked = end_b[met] == end_a
    pairs = (a[linked] << _SHIFT) | b[met[linked]]
    upto = np.r_[0, np.cumsum(linked)]
    # every token followed by its mark, in order of group and side: a token comes after those of
    # its own side before it and those of the other side in groups before it, or in its own
    is_last = last == np.arange(len(last))
    group = np.cumsum(is_last) - is_last
    upto_b = np.r_[0, is_b[is_last] + 1]
    upto_a = np.r_[0, np.flatnonzero(linked) + 1]
    at_a = np.arange(len(a)) + upto_b[group[place_a]]
    at_b = np.arange(len(b)) + upto_a[group[place_b] + 1]
    token = np.empty(len(last), np.int64)
    token[at_a], token[at_b] = a, b
    mark = np.full(len(last), ord(","), np.uint8)
    mark[(upto_a + upto_b)[:-1] + np.diff(upto_a) - 1] = ord("|")
    fresh = np.zeros(len(last), bool)
    fresh[(upto_a + upto_b)[1:] - 1] = True
    mark[fresh] = ord(";")
    digits = _digits(max(len(tools.side_a.lengths), len(tools.side_b.lengths)))
    cells = np.concatenate([digits[token], mark[:, None]], axis=1)
    written = np.r_[0, np.cumsum((cells != 0).sum(axis=1))]
    text = cells[cells != 0].tobytes()
    groups = np.r_[0, np.cumsum(fresh)]
    tokens = first_a + first_b  # the tokens of a text are a stretch of the line and of the order
    out = []
    for i in range(len(ids_a)):
        if not sizes_a[i]:
            out.append((0, 0, 0, 0, "", [], []))
            continue
        low, high = tokens[i], tokens[i + 1]
        digest = hashlib.sha256(text[written[low] : written[high] - 1]).hexdigest()
        own, times = np.unique(pairs[upto[first_a[i]] : upto[first_a[i + 1]]], return_counts=True)
        out.append((int(sizes_a[i]), int(sizes_b[i]), int(groups[high] - groups[low]), int(times.sum()), digest, own, times))
    return out


def readable(text: bytes) -> str:
    """The text of UTF-8 bytes; none if they aren't."""
    try:
        return text.decode()
    except UnicodeDecodeError:
        return ""


def encoded(docs: DataFrame, folder: str | None = None) -> DataFrame:
    """Per row of ``docs`` the columns ``FOUND``; nothing is shuffled."""
    schema = arrow_schema(FOUND)
    folder = folder or FOLDER

    def work(batch):
        tools = tokenizers(folder)
        for low, high, data, edges in slices(batch.column("raw"), SLICE):
            texts = [readable(data[x:y].tobytes()) for x, y in zip(edges[:-1], edges[1:])]
            rows = aligned(*tools.encode(texts), tools)
            columns = [batch.column("doc_id").slice(low, high - low), *zip(*rows)]
            arrays = [columns[0], *[pa.array(list(c), f.type) for c, f in zip(columns[1:6], list(schema)[1:6])]]
            for values, kind in ((columns[6], pa.int64()), (columns[7], pa.int32())):
                edge = np.r_[0, np.cumsum([len(v) for v in values])].astype(np.int32)
                flat = np.concatenate([np.asarray(v, np.int64) for v in values])
                arrays.append(pa.ListArray.from_arrays(pa.array(edge), pa.array(flat.astype(kind.to_pandas_dtype()))))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), raw()), work, FOUND)


def pair_counts(found: DataFrame) -> DataFrame:
    """(``pair``, ``n``, ``best``): how often each id pair is linked in the corpus, and whether that
    is the most of all pairs with its B id; stored."""
    each = found.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.pairs", "p.times")
    counted = stored(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("n")), "pairs")
    piece = F.col("pair").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    most = counted.groupBy(piece.alias("b")).agg(F.max("n").alias("most"))
    return stored(counted.withColumn("b", piece).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")


def align(docs: DataFrame, folder: str | None = None, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per document: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``,
    ``groups_sha256``."""
    found = stored(encoded(docs, folder).withColumn("row", F.monotonically_increasing_id()), "encoded")
    counts = pair_counts(found)
    each = found.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), "p.times")
    met = join_table(each, counts, "pair", F.col("row"), max_bytes=max_bytes)
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    zero = F.lit(0).cast("bigint")
    return found.drop("pairs", "times").join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
