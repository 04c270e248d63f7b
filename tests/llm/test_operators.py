"""Every operator against a plain reading of its rules, on small tables with nulls, empty
and long texts, copies, ties, repeated rows and further columns."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pairloom.llm import decontaminate, mixing, neardup, pii, quality, repeats, scoring, suffixarray, suffixtrees, topk, warc
from pairloom.llm.words import word_slices

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, value long, run long, key string"


def words(text):
    return (text or "").encode().split()


def texts():
    draw = random.Random(7)
    vocabulary = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 6))) for _ in range(300)]

    def some(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    passage = some(60)
    out = [some(draw.randint(5, 120)) for _ in range(25)]
    out += [out[0], out[0], out[1], out[2].upper().lower()]
    near = some(80).split()
    for _ in range(6):
        copy = list(near)
        copy[draw.randrange(80)] = "changed"
        out.append(" ".join(copy))
    out += [f"{some(20)} {passage} {some(15)}" for _ in range(5)] + [f"{passage}\n{some(3)}\t{passage}"]
    out += [None, "", " \n", "one", "one two", "one two", "x" * 5000, "ab " * 900, some(3000)]
    return out


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, None if i % 7 == 0 else "en" if i % 3 else "de", None if i % 5 == 0 else f"s{i % 4}", len(t or ""), 1, 2, "k") for i, t in enumerate(texts())]
    return out + [out[3]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark, rows):
    return spark.createDataFrame([(r[0], 1) for r in rows] + [(None, 1)], "doc_id long, quality int")


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def shingles(text):
    w = [x.lower() for x in words(text)]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_by_hand(rows):
    sets = {r[0]: shingles(r[1]) for r in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted(((r[0], len(sets[r[0]]), find(r[0]), find(r[0]) == r[0]) for r in rows), key=str)


@pytest.mark.parametrize("short", [24, 1])
def test_near_duplicates(docs, rows, short):
    got = sorted_rows(neardup.near_duplicates(docs, short=short), "doc_id", "n_shingles", "component_id", "kept")
    assert got == near_by_hand(rows)


def word_repeats(rows, window):
    held = [(r[0], words(r[1])) for r in rows]
    seen = collections.Counter(tuple(w[i : i + window]) for _, w in held for i in range(len(w) - window + 1))
    out = []
    for doc, w in held:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def byte_repeats(rows, window):
    seen, out = {}, []
    for doc, text in sorted({(r[0], r[1]) for r in rows}, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = [False] * len(data)
        for i in range(len(data) - window + 1):
            if seen.setdefault(data[i : i + window], (doc, i)) != (doc, i):
                gone[i : i + window] = [True] * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())))
    found = dict(out)
    return sorted(((r[0], *found[r[0]]) for r in rows), key=str)


@pytest.mark.parametrize("group", [512, 1])
def test_repeats_of_words_and_bytes(docs, rows, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    got = sorted_rows(suffixtrees.remove_repeats(docs, 35, 8), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == word_repeats(rows, 35)
    got = sorted_rows(suffixarray.remove_repeats(docs, 100, 32), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == byte_repeats(rows, 100)


def test_merge_sort_sorts_as_bytes_do():
    draw = np.random.default_rng(3)
    plan = repeats.Plan(False, 8, 2)
    matrix = draw.integers(97, 99, (200, plan.reach + plan.length)).astype(np.uint8)
    sizes, group = draw.integers(2, 9, 200), np.sort(draw.integers(0, 9, 200))
    for row, n in zip(matrix, sizes):
        row[plan.reach + n :] = 0
    suffixes = suffixarray.Suffixes(matrix, repeats.prefix_hashes(matrix), plan.reach, sizes, False)
    order = suffixarray.merge_sort(suffixes, group)
    keys = [(group[i], matrix[i, plan.reach : plan.reach + sizes[i]].tobytes()) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(200))


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_by_hand(text):
    out = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((number, *m.span()))
    return out


def test_base_spans_are_those_of_the_patterns():
    draw = random.Random(2)
    for _ in range(20_000):
        text = "".join(draw.choice("ab1230 .@+-()4 5é") for _ in range(draw.randrange(40)))
        assert pii.base_spans(text) == base_by_hand(text)


def test_personal_data(spark, nothing):
    shown = ["a.b@c.example or", "é at 10.0.0.1, 300.1.1.1", "4111 1111 1111 1111 no 4111111111111112", "call +1 (974) 555-3436."]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(shown * 8 + [None, "", "clean"])], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find(table).collect()}
    for i, text in enumerate(shown * 8 + ["", "", "clean"]):
        base = base_by_hand(text)
        assert got[i]["base_sha256"] == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert set(pii.written(base).split(",")) <= set(got[i]["spans"].split(","))
        assert got[i]["n_email"] + got[i]["n_ip"] + got[i]["n_card"] + got[i]["n_phone"] == len(base)
    assert got[34]["spans"] == ""
    hidden = pii.redacted(table).where("doc_id = 0").first()["text"]
    assert hidden == "[EMAIL] or"
    assert pii.find(nothing).count() == 0


def test_mixing(docs, rows, nothing):
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(words(r[1]))
    names = sorted((s for s in sizes if s is not None), key=str) + [None]
    weights, full = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        level = left / sum(weights[s] for s in names if s not in full)
        over = {s for s in names if s not in full and weights[s] * level > 2 * sizes[s]}
        if not over:
            break
        full |= over
    largest = max(len(words(r[1])) for r in rows)
    for s in names:
        own = [r for r in got if r["source"] == s]
        assert own[0]["target"] == pytest.approx(2 * sizes[s] if s in full else weights[s] * level)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= largest
        assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in own)
    assert len(got) == len(rows) and mixing.mix(nothing).count() == 0


def test_top_k(spark):
    draw = np.random.default_rng(5)
    data = [(i, [float(x) for x in np.float32(draw.standard_normal(8))]) for i in range(330)]
    data += [(500, None), (600, [float("nan")] + [0.0] * 7), (700, [float("inf")] * 8), (400, data[3][1]), (401, data[3][1])]
    table = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    vectors = topk.whole_vectors(table)
    got = collections.defaultdict(list)
    for r in topk.top_k(vectors, vectors.where("id % 100 = 0"), 10, candidates=64, asked=2).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in data if i not in (500, 600, 700)}
    assert set(got) == {0, 100, 200, 300, 400}
    for q, found in got.items():
        best = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)[:10]
        assert sorted(found) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]


def test_top_k_of_an_id_repeated_over_blocks(spark):
    draw = np.random.default_rng(6)
    data = [(7, [float(x) for x in np.float32(draw.standard_normal(4))]) for _ in range(24)] + [(1, [1.0, -1.0, 0.5, 0.25])]
    vectors = topk.whole_vectors(spark.createDataFrame(data, "vec_id long, embedding array<float>").coalesce(1))
    got = sorted((r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(vectors, vectors.where("id = 1"), 10, candidates=4).collect())
    whole = [[math.floor(1024 * x) for x in v] for _, v in data]
    best = sorted((-sum(a * b for a, b in zip(whole[-1], v)) for v in whole[:-1]))[:10]
    assert got == [(n + 1, 7, -s) for n, s in enumerate(best)]


def test_warc(spark, tmp_path):
    html = ["<p>é</p>", None, "", "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1", "<p>é</p>", "x" * 100_000]
    pages = spark.createDataFrame([(i, f"http://e/{i}", h) for i, h in enumerate(html)] + [(4, "http://e/4", "<p>é</p>")], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    got = warc.transactions(warc.read_records(spark, str(tmp_path / "w"))).collect()
    assert len(got) == 7 and all(r["request"] and r["metadata"] for r in got)
    kinds = collections.Counter((r["metadata"]["fields"].split()[1], r["capture"]["type"]) for r in got)
    assert kinds == {("0", "revisit"): 1, ("1", "revisit"): 1, ("2", "response"): 1, ("3", "response"): 1, ("4", "response"): 1, ("4", "revisit"): 1, ("5", "response"): 1}
    import base64
    for r in got:
        page = int(r["metadata"]["fields"].split()[1])
        data = (html[page] or "").encode()
        assert r["capture"]["digest"] == "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
        if r["capture"]["type"] == "response":
            assert r["capture"]["bytes"] == len(data)
        else:
            assert r["original"]["capture"]["digest"] == r["capture"]["digest"]


def test_scores(docs, rows, nothing):
    got = collections.defaultdict(list)
    for r in scoring.score(docs, rounds=2, shard_places=2000).collect():
        got[r["doc_id"]].append(r)
    held = {r[0]: zlib.crc32(str(r[0]).encode()) % 5 == 1 for r in rows}
    counts = collections.Counter(w for r in rows if not held[r[0]] for w in [x.lower() for x in words(r[1])] + [None])
    total, kinds = sum(counts.values()), len(counts)
    for r in rows:
        own = [x.lower() for x in words(r[1])] + [None]
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
        for g in got[r[0]]:
            assert (g["held_out"], g["n_tokens"], g["train_tokens"]) == (held[r[0]], len(own), total)
            assert g["n_known"] == sum(counts[w] > 0 for w in own)
            assert g["base_score"] == pytest.approx(base, rel=1e-9)
            assert g["score"] < 0 and math.isfinite(g["score"])
    assert scoring.score(nothing).count() == 0


def test_attention_gradient():
    draw = np.random.default_rng(1)
    model = scoring.Attention.start(np.zeros(1, np.int64), np.zeros(1), np.ones(scoring.CLASSES**2))
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    inputs, slots = draw.integers(0, 50, 64), draw.integers(0, 50, 64)
    begins, places = np.array([True, False, True, False]), np.arange(64)
    _, g = model.gradient(inputs, begins, places, slots)
    for name in ("query", "key", "value", "own", "seen", "far", "embed", "member"):
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        was, losses = model.w[name][at], []
        for step in (1e-5, -1e-5):
            model.w[name][at] = was + step
            losses.append(model.gradient(inputs, begins, places, slots)[0])
        model.w[name][at] = was
        assert g[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-5, rel=1e-3, abs=1e-5)


def token_by_token(model, targets):
    """The log10 probability of a text, its subwords and an end one after the other."""
    w = {k: v.astype(np.float64) for k, v in model.w.items()}
    slots = [int(model.slot[t]) for t in targets] + [scoring.END]
    x, total = [], 0.0
    for i, slot in enumerate(slots):
        x.append(w["embed"][slots[i - 1] if i else scoring.END])
        low = max(0, i // scoring.BLOCK - 1) * scoring.BLOCK
        weights = np.exp([x[i] @ w["query"] @ (x[j] @ w["key"]) / math.sqrt(scoring.KEYS) + w["far"][scoring.BLOCK + i % scoring.BLOCK - (j - (i // scoring.BLOCK - 1) * scoring.BLOCK)] for j in range(low, i + 1)])
        seen = (weights / weights.sum()) @ np.array([x[j] @ w["value"] for j in range(low, i + 1)])
        h = np.tanh(x[i] @ w["own"] + seen @ w["seen"] + w["bias"])
        c, m = divmod(slot, scoring.CLASSES)
        for logits, k in ((h @ w["cls"] + w["cls_bias"], c), (h @ w["member"][c] + w["member_bias"][c], m)):
            total += logits[k] - math.log(np.exp(logits).sum())
        total += model.other[targets[i]] if slot == scoring.OTHER else 0.0
    return total / math.log(10)


def test_scores_equal_a_token_by_token_pass(rows):
    splitter = scoring.Splitter(scoring.read_ranks())
    data = [(r[1] or "").encode() for r in rows] + [b"", b"one", b"a b c d e f g h i j k l m n o p q r s t u v w x y z"]

    def stream(texts, slot):
        (_, _, found), = word_slices(pa.array(texts, pa.binary()), limit=1 << 30)
        ids, sizes = splitter.split(found, found.hashes(scoring.LOWER))
        return ids, sizes, found, scoring.Stream.of(ids, sizes, found.first, slot)

    ids, _, _, _ = stream(data, np.zeros(1 << 17, np.int64))
    model = scoring.first_model(np.bincount(ids[::2], minlength=1 << 17), len(data))
    ids, sizes, found, whole = stream(data, model.slot)
    before = model.log10(whole).sum()
    learner = scoring.Learner(model, 1e-2)
    for _ in range(3):
        learner.learn(whole, batch=7)
    model = learner.model
    assert model.log10(whole).sum() > before
    together = np.bincount(whole.text, model.log10(whole), minlength=len(data))
    backwards = stream(data[::-1], model.slot)[3]
    turned = np.bincount(backwards.text, model.log10(backwards), minlength=len(data))[::-1]
    edges = np.r_[0, np.cumsum(sizes)][found.first]
    for i in range(len(data)):
        alone = model.log10(stream([data[i]], model.slot)[3]).sum()
        expected = token_by_token(model, ids[edges[i] : edges[i + 1]])
        assert together[i] == pytest.approx(expected, rel=1e-4) and alone == pytest.approx(expected, rel=1e-4)
        assert alone == pytest.approx(together[i], rel=1e-5) and turned[i] == pytest.approx(together[i], rel=1e-5)


def test_scores_do_not_depend_on_the_layout(spark, rows):
    data = [(r[0], r[1]) for r in rows]
    random.Random(3).shuffle(data)
    one, other = (
        sorted((r["doc_id"] is None, r["doc_id"] or 0, r["score"]) for r in scoring.score(spark.createDataFrame(x, "doc_id long, text string").repartition(n), rounds=2, shard_places=1500).collect())
        for x, n in ((data, 1), (data[::-1], 7))
    )
    assert [x[:2] for x in one] == [x[:2] for x in other]
    assert [x[2] for x in one] == pytest.approx([x[2] for x in other], rel=1e-4)


def test_scoring_learns_from_every_training_document(spark):
    draw = random.Random(12)
    known = ["".join(draw.choice("abcdefgh") for _ in range(3)) for _ in range(40)]
    follow = {w: known[(i * 7 + 3) % 40] for i, w in enumerate(known)}  # each word has one that follows

    def chain():
        out = [draw.choice(known)]
        while len(out) < 80:
            out.append(follow[out[-1]])
        return " ".join(out)

    data = [(i, chain()) for i in range(400)]
    got = scoring.score(spark.createDataFrame(data, "doc_id long, text string"), rounds=3, shard_places=12_000, batch=16)
    held = [r for r in got.collect() if r["held_out"]]
    assert len(held) > 40
    score, base = (sum(r[c] for r in held) for c in ("score", "base_score"))
    assert score > 0.7 * base  # which a unigram model can't reach


def test_quality(spark, docs, rows, labels, nothing):
    got = quality.classify(docs, labels, most_docs=15).collect()
    assert len(got) == len(rows)
    for r in got:
        has = bool(words(texts()[r["doc_id"]]))
        assert (r["perplexity"] is not None) == has
        assert r["kept"] == (has and (r["threshold"] is None or r["perplexity"] <= r["threshold"]))
    kept = sorted(r["doc_id"] for r in got if r["kept"])
    good = quality.good_rows(docs, labels, most_docs=15)
    assert good.columns == docs.columns and sorted(r["doc_id"] for r in good.collect()) == kept
    assert quality.classify(nothing, labels).count() == 0


def test_quality_holds_out_trusted_text_at_every_size(spark):
    draw = random.Random(11)
    known = ["".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    rows = [(i, " ".join(draw.choice(known) for _ in range(60)), ["en", "de", "fr"][i % 3]) for i in range(90)]
    rows += [(90, " ".join(f"{i:x}#!%" for i in range(60)), "en"), (91, "solo " * 9, "it"), (92, "x" * 40_000, "en")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], int(r[0] != 90)) for r in rows], "doc_id long, quality int")
    found, _ = quality.fit_classifier(table, labels)
    assert {"en", "de", "fr"} <= set(found.limits) and found.overall is not None
    got = {r["doc_id"]: r for r in quality.classify(table, labels).collect()}
    assert not got[90]["kept"] and sum(got[i]["kept"] for i in range(90)) > 70
    trusted = quality.trusted_ids(labels)
    held = {r["doc_id"] for r in quality.held_out_ids(table, trusted).collect()}
    assert {i % 3 for i in held if i < 90} == {0, 1, 2} and 91 not in held and len(held) < 45
    pair = spark.createDataFrame([(1, "a b", "en"), (2, "a c", "en")], "doc_id long, text string, lang string")
    assert quality.held_out_ids(pair, pair.select("doc_id")).count() == 1


def test_training_sample_passes_over_what_does_not_fit(spark):
    table = spark.createDataFrame([(i, "x" * (900 if i % 2 else 100)) for i in range(20)], "doc_id long, text string")
    got = {r["doc_id"] for r in quality.training_sample(table, table.select("doc_id"), most_bytes=1000).collect()}
    assert len(got) in (2, 10) and sum(900 if i % 2 else 100 for i in got) == 1000
    assert quality.training_sample(table, table.select("doc_id"), most_bytes=899).count() == 8


def test_quality_rejects_repetition(spark):
    draw = random.Random(12)
    known = ["".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(60)]
    rows = [(i, " ".join(draw.choice(known) for _ in range(60)), "en") for i in range(90)]
    sentence = " ".join(known[:5])
    rows += [(90, f"{known[0]} " * 60, "en"), (91, f"{sentence} " * 12, "en"), (92, f"{known[1]} " * 5000, "en")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 90)) for i in range(93)], "doc_id long, quality int")
    got = {r["doc_id"]: r["kept"] for r in quality.classify(table, labels).collect()}
    assert not any(got[i] for i in (90, 91, 92)) and sum(got[i] for i in range(90)) > 80
    assert {r["doc_id"] for r in quality.good_rows(table, labels).collect()} == {i for i, kept in got.items() if kept}


def test_distinct_trigrams():
    draw = random.Random(13)
    texts = [[draw.choice("abc") for _ in range(draw.randint(0, 40))] for _ in range(50)]
    column = pa.array([" ".join(t).encode() for t in texts])
    got = [n for _, _, w in word_slices(column, 64) for n in quality.distinct_trigrams(w, w.hashes())]
    padded = [["^", "^", *t, "$"] for t in texts]
    assert got == [len({tuple(t[i : i + 3]) for i in range(len(t) - 2)}) for t in padded]


def test_model_sums_to_one():
    model = quality.Model(
        np.sort(np.array([5, quality.END, quality.UNKNOWN], np.uint64)), np.array([0.2, 0.3, 0.1], np.float32), 0.1, 1.0,
        (np.zeros(0, np.uint64), np.zeros(0)), (np.zeros(0, np.uint64), np.zeros(0)), (np.zeros(0, np.uint64), np.zeros(0)), (np.zeros(0, np.uint64), np.zeros(0)),
    )
    p, of = model.log_probs(np.array([5], np.uint64), np.array([0, 1]))
    assert list(of) == [0, 0] and np.isfinite(p).all()


def test_decontamination(spark, docs, rows, nothing):
    whole = texts()
    items = [(0, " ".join(whole[4].split()[:30])), (1, whole[24]), (2, None), (3, ""), (4, "nothing of this is there at all in any text"), (5, "one two")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, benchmark).collect()}
    plain = lambda t: " " + " ".join(re.sub(r"[^\w]", " ", (t or "").lower()).split()) + " "
    want = {(r[0], i) for r in rows for i, t in items if plain(t).strip() and plain(t) in plain(r[1])}
    assert want <= got and not any(i == 4 for _, i in got)
    clean = decontaminate.clean_rows(docs, benchmark)
    assert clean.columns == docs.columns and not {r["doc_id"] for r in clean.collect()} & {d for d, _ in got}
    assert decontaminate.matches(nothing, benchmark).count() == 0
    assert decontaminate.matches(docs, benchmark.where("item_id is null")).count() == 0


def test_subsequence():
    draw = np.random.default_rng(0)
    for _ in range(50):
        a, b = draw.integers(0, 5, draw.integers(1, 20)), draw.integers(0, 5, draw.integers(0, 20))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert decontaminate.common_subsequence(a, b) == table[-1, -1]
