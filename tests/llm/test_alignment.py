"""Aligned tokens against overlaps taken pair by pair."""

import collections
import hashlib
import random

import numpy as np
import pytest

from pairloom.llm import alignment

A, B = f"{alignment.FOLDER}/{alignment.BYTE_LEVEL}", f"{alignment.FOLDER}/{alignment.PIECES}"


def texts():
    draw = random.Random(4)
    vocabulary = ["Haus", "über", "naïve", "tokenization", "xqzv", "12345", "don't", "éa", "日本語", "🙂👍", "--", "of", "the"]

    def some(n):
        return "".join(draw.choice(vocabulary) + draw.choice([" ", " ", "  ", "\n", "\t", ""]) for _ in range(n))

    out = [some(draw.randint(1, 60)) for _ in range(30)]
    out += [None, "", " ", "\n", "a", "a▁b", "<|endoftext|> <s> </s> <unk> [CLS]", "the " * 400, "\x00\x01", "<0x41>", "﻿x", "ﬁ ①"]
    return out + [out[0]] * 3


def by_hand(rows):
    """Per row what the query returns, from the libraries' own pieces."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    a_side = Tokenizer.from_file(A)
    a_side.encode_special_tokens = True
    b_side, decoder, plain = sentencepiece.SentencePieceProcessor(model_file=B), ByteLevel(), alignment.byte_alphabet()
    assert decoder.decode([a_side.id_to_token(500)]).encode() == bytes(plain[c] for c in a_side.id_to_token(500))
    found, counts = [], collections.Counter()
    for doc_id, text in rows:
        ranges = []
        for ids, value in (
            (a_side.encode(" " + (text or ""), add_special_tokens=False).ids, lambda i: bytes(plain[c] for c in a_side.id_to_token(i))),
            (b_side.encode(text or ""), lambda i: bytes([int(b_side.id_to_piece(i)[3:5], 16)]) if b_side.is_byte(i) else b_side.id_to_piece(i).replace("▁", " ").encode()),
        ):
            at, side, joined = 0, [], b""
            for i in ids:
                joined += value(i)
                side.append((i, at, len(joined)))
                at = len(joined)
            ranges.append(side if text and joined == b" " + text.encode() else None)
        if None in ranges:
            found.append((doc_id, [], [], []))
            continue
        a, b = ranges
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = []
        for low, high in zip([0, *ends], ends):
            groups.append(([i for i, s, e in a if low <= s and e <= high], [i for i, s, e in b if low <= s and e <= high]))
        links = [(i, j) for i, _, e in a for j, _, f in b if e == f]
        counts.update(links)
        found.append((doc_id, a, b, groups, links))
    most = collections.Counter()
    for (i, j), n in counts.items():
        most[j] = max(most[j], n)
    out = []
    for doc_id, a, b, groups, *links in found:
        links = links[0] if links else []
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            doc_id, len(a), len(b), len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(written.encode()).hexdigest() if a else "",
        ))
    return out


@pytest.mark.parametrize("max_bytes", [0, alignment.BROADCAST_BYTES])
def test_alignment(spark, max_bytes):
    rows = [(None if i % 13 == 2 else i, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, raw string, n_a int").repartition(3)
    got = [tuple(r) for r in alignment.align(df, max_bytes=max_bytes).collect()]
    want = by_hand(rows)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert sum(r[1] == 0 for r in want) == 3 and sum(r[4] for r in want) > 500


def test_parts_give_the_same_tokens(monkeypatch):
    tools = alignment.tokenizers(alignment.FOLDER)
    assert tools.can_cut
    draw = random.Random(8)
    long = ["".join(draw.choice(["ab", "Über", "9", "...", "x_y", "  ", " ", " ", " ", "\n", "日", "'s"]) for _ in range(900)) for _ in range(30)]
    whole = tools.encode(long)
    monkeypatch.setattr(alignment, "PART", 40)
    assert sum(len(tools.parts(t)) for t in long) > 300
    assert tools.encode(long) == whole


def test_pointers_lead_to_the_end_of_each_group():
    draw = random.Random(2)
    for _ in range(300):
        n = draw.randint(1, 40)
        ends = [sorted({*draw.sample(range(1, n + 1), draw.randint(0, n)), n}) for _ in range(2)]
        place_a, place_b, pointer = alignment.farthest(*(np.array(e) for e in ends))
        last = alignment.terminals(pointer)
        common = np.array(sorted({*ends[0]} & {*ends[1]}))
        for side, place in zip(ends, (place_a, place_b)):
            group = common[np.searchsorted(common, side)]
            assert [ends[1][list(place_b).index(x)] for x in last[place]] == group.tolist()


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_texts_are_compared_with_their_tokens_at_once():
    side = alignment.Side({1: b"ab", 2: b"c", 4: b"\xff"})
    wanted = [b"abc", b"", b"abc", b"cab", b"c", b"ab"]
    assert side.gives([[1, 2], [], [2, 1], [2, 1], [4], [3]], wanted).tolist() == [True, True, False, True, False, False]
    assert side.gives([[1, 2], [], [2, 1]], [b"abc", b"", b"cab"]).tolist() == [True] * 3
    assert side.gives([], []).tolist() == [] and side.gives([[]], [b""]).tolist() == [True]
    tools = alignment.tokenizers(alignment.FOLDER)
    a, b = tools.encode(["", "one two", "a▁b", "é𝒳"])
    assert [bool(x) for x in a] == [bool(x) for x in b] == [False, True, False, True]
