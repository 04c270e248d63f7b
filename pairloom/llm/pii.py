"""Personal data by fixed patterns and a semi-Markov conditional random field.

The patterns give the base spans of four kinds. The random field (Sarawagi and Cohen
2004) adds what they miss: broken, masked or differently parted forms. It scores whole
segments, so its features see a candidate's length, digits, marks, check digit and both
neighbours at once; a dynamic program over segments of at most ``LONGEST`` atoms chooses
boundaries and kinds together.

The best path is that of a whole text, but for segments of over 80 characters, which no feature tells apart. It is
looked for in windows: around islands, runs of chunks that hold a digit or an at sign, and around
the places where a segment without either could score so much that it beats being outside, which follows from the
weights; a window has all atoms that a segment can reach from there. Atoms between windows are outside on the best path of
any text, so windows are solved one by one. The weights are trained here by the likelihood of
base spans in a bounded sample of ``TRAIN_ISLANDS`` islands, drawn in order of a
hash over all islands, and of altered copies of those spans. A decoded span is
added if it overlaps no base span and beats being outside by ``MARGIN``.

Documents are read in one narrow pass; every document is scored on its own.

Defined cases: a null text is an empty one; empty texts have no spans; a text of any
length is read whole, in time linear in it but for islands, where it is linear
times ``LONGEST``; rows of one id are rows each; without any island to train on only base
spans are found; other columns are ignored or, in ``redacted``, passed on; an empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import itertools
import re
import string
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.common import arrow_schema, map_batches, map_rows

KINDS = ("email", "ip", "card", "phone")
TRAIN_ISLANDS = 240
EPOCHS = 6
LONGEST = 16
MARGIN = 3.0
_SEED = 10

# The base patterns, written so that each character is tried a bounded number of times
_LOCAL = set(string.ascii_letters + string.digits + "._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str):
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of every pattern, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            out += [(1, *m.span()) for m in _IP.finditer(text) if all(map(_small, m[0].split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = _digits(m[0])
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, *m.span()))
        if "+" in text:
            out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# Islands and their atoms ----------------------------------------------------

_CHUNK = re.compile(r"[^\s]*+")
_ATOM = re.compile(r"[^\W\d_]+|[0-9]+|\s+|.", re.S)
_DOT = re.compile(r"\.|dot")
_HARD = re.compile(r"[0-9@]")
_SPELT = re.compile(r"(?=([\[( ]at[\]) ]))")


def islands(text: str) -> list[tuple[int, int]]:
    """Runs of chunks with a digit or an at sign, one chunk of context aside."""
    out: list[list[int]] = []
    at = 0
    for m in re.finditer(r"[0-9@]", text):
        if m.start() < at:
            continue
        start = m.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = _CHUNK.match(text, m.start()).end()
        if out and start - out[-1][1] <= 1:
            out[-1][1] = end
        else:
            out.append([start, end])
        at = end
    return [(a, b) for a, b in out]


def atoms(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _ATOM.finditer(text)]


def segment_features(text: str, parts: list[tuple[int, int]], i: int, j: int) -> list[str]:
    """Names of what holds for the atoms from ``i`` up to ``j`` as one span."""
    start, end = parts[i][0], parts[j - 1][1]
    body = text[start : min(end, start + 80)]
    if end - start > 80:
        return ["long"]
    digits, letters = _digits(body), sum(c.isalpha() for c in body)
    groups = [len(g) for g in re.findall("[0-9]+", body)]
    n = len(digits)
    marks = "".join(sorted({c for c in body if not c.isalnum()}))
    out = [
        "bias", f"n:{n if n < 20 else 20}", f"groups:{min(len(groups), 6)}", f"marks:{marks[:6]}",
        f"letters:{min(letters, 3)}", "dots:%d" % min(body.count(".") + body.count("dot"), 4),
    ]
    if "@" in body or re.search(r"[\[( ]at[\]) ]", body):
        out.append("at" if letters else "at-bare")
        if re.fullmatch(r"[A-Za-z0-9._%+-]+ ?(@|\(at\)|\[at\]| at ) ?[A-Za-z0-9-]+(( ?(\.|\(dot\)|\[dot\]| dot ) ?)[A-Za-z0-9-]+)+", body):
            out.append("shape:email")
    if len(groups) == 4 and not letters and max(groups) <= 3:
        small = all(int(g) <= 255 for g in re.findall("[0-9]+", body))
        out.append("quad" if small else "quad-high")
    if 13 <= n <= 19 and not letters:
        out.append("luhn" if luhn(digits) else "no-luhn")
    if 9 <= n <= 15 and not letters:
        out.append("plus" if body[0] == "+" else "paren" if "(" in body else "plain-number")
    if body[0].isspace() or body[-1].isspace():
        out.append("blank-edge")
    if not body[-1].isalnum():
        out.append("mark-end")
    if start and (text[start - 1].isalnum() or text[start - 1] in "+-.@=\""):
        out.append("joined-left:" + ("w" if text[start - 1].isalnum() else text[start - 1]))
    if end < len(text) and (text[end].isalnum() or text[end] in "-@"):
        out.append("joined-right:" + ("w" if text[end].isalnum() else text[end]))
    if end + 1 < len(text) and text[end] in ".-" and text[end + 1].isalnum():
        out.append("goes-on")
    return out


@dataclass
class Field:
    """Weights of (kind, feature), and of one kind following another; 0 is outside."""

    names: dict[str, int]
    weights: np.ndarray
    follows: np.ndarray

    def lattice(self, text: str, parts, grow: bool = False, every: bool = True):
        """For each pair of boundaries: the numbers of the features that hold; unless ``every``, of those that ``may_hold``."""
        out = {}
        for i in range(len(parts)):
            if text[parts[i][0]].isspace():
                continue
            for j in range(i + 1, min(len(parts), i + LONGEST) + 1):
                if not every and not self.may_hold(text[parts[i][0] : parts[j - 1][1]]):
                    continue
                found = segment_features(text, parts, i, j)
                if grow:
                    for name in found:
                        self.names.setdefault(name, len(self.names))
                out[i, j] = [self.names[name] for name in found if name in self.names]
        return out

    def scores(self, lattice) -> dict:
        return {at: self.weights[1:, f].sum(axis=1) for at, f in lattice.items()}

    @functools.cached_property
    def outside(self) -> np.ndarray:
        """By kind, the least that the first atom of a segment is worth outside, beside what the kind does for the segments next to
        it; each further atom adds what outside after outside does."""
        sides = [self.follows[:, :1] - self.follows, self.follows[:1] - self.follows]
        return sides[0].min(axis=0)[1:] + np.minimum(sides[1].min(axis=1), 0)[1:] - 1e-6

    @functools.cached_property
    def openings(self) -> list[tuple[str, int, bool, int]]:
        """What a segment without digits and at signs must hold to be on a best path, each: marks, dots, a spelt-out at sign, and its atoms at most.
        A segment is on it only if its score is worth as much as its atoms outside, whatever stands before and behind it."""
        none = np.zeros(len(KINDS))
        of = lambda name: self.weights[1:, self.names[name]] if name in self.names else none
        some = lambda start: [self.weights[1:, i] for n, i in self.names.items() if n.startswith(start)]
        base = of("bias") + of("n:0") + of("groups:0") + sum(np.maximum(of(n), 0) for n in ("blank-edge", "goes-on"))
        base = base + sum(np.max([none, *some(n)], axis=0) for n in ("joined-left:", "joined-right:"))
        marks = {n.removeprefix("marks:"): self.weights[1:, i] for n, i in self.names.items() if n.startswith("marks:") and "@" not in n}

        def may(held, worth, dots, spelt):
            """``held``: the marks, None for any that no feature names."""
            most = 0
            n = 1 if held is None else len([c for c in held if not c.isspace()]) + any(c.isspace() for c in held)
            for letters in range(2 * spelt, 4):
                if held == "" and not letters or dots and held is not None and "." not in held and letters < 3:
                    continue
                end = of("mark-end") if not letters else np.maximum(of("mark-end"), 0)
                # "dot" is letters, so with three letters dots may take no atoms of their own
                size = n + (letters > 0) + (max(dots - 1, 0) if letters < 3 else 0)
                size = max(1, size, 3 * spelt)
                found = base + worth + end + of(f"letters:{letters}") + of(f"dots:{dots}")
                found = found + (of("at") + np.maximum(of("shape:email"), 0) if spelt else 0)
                most = max([most, *(k for k in range(size, LONGEST + 1) if (found >= self.outside + (k - 1) * self.follows[0, 0]).any())])
            return most

        out = []
        for held, worth in [*({"": none} | marks).items(), (None, none)]:
            needs = "".join(c for c in held or "" if not c.isspace())
            out += [(needs, dots, spelt, most) for dots in range(5) for spelt in (False, True) if (most := may(held, worth, dots, spelt))]
        out = sorted(set(out), key=lambda x: (len(x[0]), x[1], x[2], -x[3], x[0]))
        less = lambda x, y: set(x[0]) <= set(y[0]) and x[1] <= y[1] and x[2] <= y[2] and x[3] >= y[3]
        return [y for i, y in enumerate(out) if not any(less(x, y) for x in out[:i])]

    def may_hold(self, body: str) -> bool:
        """Whether a segment may be on a best path as far as its digits and marks tell."""
        return bool(_HARD.search(body)) or any(
            all(c in body for c in needs) and body.count(".") + body.count("dot") >= n and (not spelt or _SPELT.search(body))
            for needs, n, spelt, _ in self.openings
        )

    def decode(self, text: str, closes: bool = False) -> list[tuple[int, int, int]]:
        """(kind number, start, end) of the best path's spans that are worth the margin; ``closes`` if an atom outside follows."""
        parts = atoms(text)
        scores, n, k = self.scores(self.lattice(text, parts, every=False)), len(parts), len(KINDS) + 1
        best = np.full((n + 1, k), -np.inf)
        best[0, 0] = 0
        back = {}
        ends: dict[int, list[int]] = {}
        for (i, j), score in scores.items():
            if (score >= self.outside + (j - i - 1) * self.follows[0, 0]).any():  # others lose to their atoms outside
                ends.setdefault(j, []).append(i)
        for j in range(1, n + 1):
            step = best[j - 1] + self.follows[:, 0]
            y = int(np.argmax(step))
            best[j, 0], back[j, 0] = step[y], (j - 1, y, 0.0)
            for i in ends.get(j, ()):
                reach = best[i][:, None] + self.follows[:, 1:]
                was = np.argmax(reach, axis=0)
                total = reach[was, np.arange(k - 1)] + scores[i, j]
                for kind in np.flatnonzero(total > best[j, 1:]):
                    best[j, kind + 1] = total[kind]
                    back[j, kind + 1] = (i, int(was[kind]), float(scores[i, j][kind]))
        out, at = [], (n, int(np.argmax(best[n] + self.follows[:, 0] if closes else best[n])))
        while at[0]:
            i, y, worth = back[at]
            if at[1] and worth >= MARGIN:
                out.append((at[1] - 1, parts[i][0], parts[at[0] - 1][1]))
            at = (i, y)
        return out


def _log_sum(x: np.ndarray, axis=None) -> np.ndarray:
    top = np.max(x, axis=axis, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    return np.squeeze(np.log(np.maximum(np.exp(x - top).sum(axis=axis, keepdims=True), 1e-300)) + top, axis=axis)


def _expected(scores: dict, follows: np.ndarray, n: int):
    """Marginals of segments and of kinds following each other, by forward and backward sums."""
    k = len(follows)
    starts: dict[int, list[int]] = {}
    ends: dict[int, list[int]] = {}
    for i, j in scores:
        starts.setdefault(i, []).append(j)
        ends.setdefault(j, []).append(i)
    front, rear = np.full((n + 1, k), -np.inf), np.full((n + 1, k), -np.inf)
    front[0, 0] = 0
    for j in range(1, n + 1):
        front[j, 0] = _log_sum(front[j - 1] + follows[:, 0])
        parts = [_log_sum(front[i][:, None] + follows[:, 1:], axis=0) + scores[i, j] for i in ends.get(j, ())]
        if parts:
            front[j, 1:] = _log_sum(np.stack(parts), axis=0)
    rear[n] = 0
    for i in range(n - 1, -1, -1):
        ways = [follows[:, 0] + rear[i + 1, 0]]
        ways += [_log_sum(follows[:, 1:] + scores[i, j] + rear[j, 1:], axis=1) for j in starts.get(i, ())]
        rear[i] = _log_sum(np.stack(ways), axis=0)
    total = _log_sum(front[n])
    segments, pairs = {}, np.zeros((k, k))
    for i in range(n):
        pairs[:, 0] += np.exp(front[i] + follows[:, 0] + rear[i + 1, 0] - total)
        for j in starts.get(i, ()):
            joint = np.exp(front[i][:, None] + follows[:, 1:] + scores[i, j] + rear[j, 1:] - total)
            pairs[:, 1:] += joint
            segments[i, j] = joint.sum(axis=0)
    return segments, pairs, total


def altered(text: str, spans: list[tuple[int, int, int]], draw: np.random.Generator) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with its spans written in another way, and where they then lie."""
    out, at, moved = "", 0, []
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        body = text[a:b]
        if kind == 0:
            body = body.replace("@", draw.choice([" (at) ", "[at]", "(at)"])).replace(".", draw.choice([".", "[dot]", " dot "]))
        elif kind == 1:
            body = body.replace(".", draw.choice(["[.]", "(.)"]))
        elif kind == 2:
            digits = _digits(body)
            body = draw.choice([".", "/", "  "]).join(digits[i : i + 4] for i in range(0, len(digits), 4))
        else:
            body = draw.choice([body[1:], "00" + body[1:], body.replace(" ", "/")])
            body = body.strip()
        out += text[at:a]
        moved.append((kind, len(out), len(out) + len(body)))
        out += body
        at = b
    return out + text[at:], moved


def train(samples: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = EPOCHS, rate: float = 0.3, decay: float = 1e-3) -> Field | None:
    """A field fitted by stochastic gradient steps on the log likelihood of the spans."""
    if not samples:
        return None
    draw = np.random.default_rng(_SEED)
    samples = [*samples, *[altered(t, s, draw) for t, s in samples if s]]
    field, ready = Field({}, np.zeros((0, 0)), np.zeros((len(KINDS) + 1,) * 2)), []
    for text, spans in samples:
        parts = atoms(text)
        lattice = field.lattice(text, parts, grow=True)
        first, last = {a: i for i, (a, _) in enumerate(parts)}, {b: i + 1 for i, (_, b) in enumerate(parts)}
        gold, at = {}, -1
        for kind, a, b in sorted(spans, key=lambda s: s[1]):
            where = (first.get(a), last.get(b))
            if where in lattice and where[0] >= at:
                gold[where] = kind
                at = where[1]
        ready.append((len(parts), lattice, gold))
    field.weights = np.zeros((len(KINDS) + 1, len(field.names)))
    for epoch in range(epochs):
        step = rate / (1 + epoch)
        for at in draw.permutation(len(ready)):
            n, lattice, gold = ready[at]
            segments, pairs, _ = _expected(field.scores(lattice), field.follows, n)
            field.weights *= 1 - step * decay
            for where, chance in segments.items():
                target = chance.copy()
                if where in gold:
                    target[gold[where]] -= 1
                if np.abs(target).max() > 1e-4:
                    np.subtract.at(field.weights, (slice(1, None), lattice[where]), step * target[:, None])
            path, y, i = np.zeros_like(pairs), 0, 0
            while i < n:
                j = next((j for j in range(i + 1, min(n, i + LONGEST) + 1) if (i, j) in gold), None)
                kind = gold[i, j] + 1 if j else 0
                path[y, kind] += 1
                y, i = kind, j or i + 1
            field.follows += 0.3 * step * (path - pairs)
    return field


def training_islands(docs: DataFrame, most: int = TRAIN_ISLANDS) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """A bounded sample of islands with their base spans; islands with spans come
    first for three quarters of it."""
    schema = arrow_schema("island string, spans string, has boolean")

    def cut(batch):
        rows = []
        for text in batch.column("text").to_pylist():
            spans = base_spans(text)
            for a, b in islands(text):
                if b - a <= 400:
                    own = [(k, s - a, e - a) for k, s, e in spans if a <= s and e <= b]
                    rows.append((text[a:b], ";".join("%d,%d,%d" % s for s in own), bool(own)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    held = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    found = map_batches(held, cut, "island string, spans string, has boolean")
    shares = {True: most * 3 // 4, False: most // 4}
    rows = []
    order = [F.xxhash64(F.lit(_SEED), "island"), "island"]
    both = found.withColumn("has", F.col("has"))
    for has, share in shares.items():
        rows += both.where(F.col("has") == has).orderBy(*order).limit(share).collect()
    return [(r["island"], [tuple(map(int, s.split(","))) for s in r["spans"].split(";") if s]) for r in rows]


def grown(text: str, start: int, end: int) -> tuple[int, int]:
    """A run of whole chunks with the atoms on both sides that a segment can reach from it."""
    for m in itertools.islice(_ATOM.finditer(text, end), LONGEST):
        end = m.end()
    room = 16 * LONGEST
    while True:
        low = max(0, start - room)
        before = [m.start() for m in _ATOM.finditer(text, low, start)][low > 0 :]  # the first may be cut
        if not low or len(before) >= LONGEST:
            return (before[-LONGEST:] or [start])[0], end
        room *= 2


def spots(text: str, openings: list[tuple[str, int, bool, int]]) -> list[tuple[int, int]] | None:
    """Places that every segment without digits and at signs on a best path has one of; None if it may be anywhere."""
    if any(not needs and not n and not spelt for needs, n, spelt, _ in openings):
        return None
    out, dots = [], [m.start() for m in _DOT.finditer(text)] if any(d for _, d, _, _ in openings) else []

    def fits(low, high, most):
        return high - low <= 80 and len(_ATOM.findall(text, low, high)) <= most

    def holds(needs, n, most, low, high):
        """Whether a segment over the place can hold the marks and dots."""
        if any(c not in text[max(0, low - 80) : high + 80] for c in needs):
            return False
        first, last = bisect.bisect_left(dots, low - 80), bisect.bisect(dots, high + 80)
        return not n or any(fits(min(low, dots[i]), max(high, dots[i + n - 1] + 1), most) for i in range(first, last - n + 1))

    for needs, n, spelt, most in openings:
        rare = needs.replace(".", "")
        if len(dots) < n or any(c not in text for c in needs):
            continue
        if spelt:
            out += [m.span(1) for m in _SPELT.finditer(text) if holds(needs, n, most, *m.span(1))]
        elif rare:
            out += [m.span() for m in re.finditer(re.escape(min(rare, key=text.count)), text) if holds(needs, n, most, *m.span())]
        else:
            out += [(x, y + 1) for x, y in zip(dots, dots[n - 1 :]) if fits(x, y + 1, most)] if n else [m.span() for m in re.finditer(r"\.", text)]
    return out


def windows(text: str, field: Field) -> list[tuple[int, int]]:
    """The parts of a text outside which no segment is on its best path."""
    found = spots(text, field.openings)
    if found is None:
        return [(0, len(text))] if text else []
    out: list[list[int]] = []
    for a, b in sorted(found + (islands(text) if "@" in text or _DIGIT.search(text) else [])):
        if out and b <= out[-1][2]:
            continue
        while a and not text[a - 1].isspace():
            a -= 1
        core = _CHUNK.match(text, b).end()
        a, b = grown(text, a, core)
        if out and a <= out[-1][1]:
            out[-1][1:] = [max(b, out[-1][1]), max(core, out[-1][2])]
        else:
            out.append([a, b, core])
    return [(a, b) for a, b, _ in out]


def all_spans(text: str, field: Field | None) -> tuple[list, list]:
    """Base spans, and those that the field adds, each by kind and start."""
    base = base_spans(text)
    if field is None:
        return base, []
    added = []
    for a, b in windows(text, field):
        for kind, s, e in field.decode(text[a:b], b < len(text)):
            if not any(s + a < y and x < e + a for _, x, y in base):
                added.append((kind, s + a, e + a))
    return base, sorted(added)


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


FOUND = "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint"


def find(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """Per document: base counts, the digest of the base spans, all spans, and how many
    of them the random field has added."""
    field = train(training_islands(docs)) if field is None else field
    held, schema = docs.sparkSession.sparkContext.broadcast(field), arrow_schema(FOUND)

    def change(batch):
        rows = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            base, added = all_spans(text.as_py(), held.value)
            counts = [sum(k == kind for k, _, _ in base) for kind in range(4)]
            rows.append((doc_id, *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(base + added), len(added)))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    plain = docs.select(F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return map_batches(plain, change, FOUND)


def redacted(docs: DataFrame, field: Field | None = None, count: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; ``count`` names the
    column of text lengths to be put right. All columns are kept; no shuffle."""
    field = train(training_islands(docs)) if field is None else field
    held = docs.sparkSession.sparkContext.broadcast(field)

    def change(batch):
        texts, sizes = [], []
        for text in batch.column("text"):
            text = text.as_py()
            if text is not None:
                base, added = all_spans(text, held.value)
                out, at = [], 0
                for kind, a, b in sorted(base + added, key=lambda s: (s[1], -s[2])):
                    if b <= at:
                        continue
                    out += [text[at : max(a, at)], f"[{KINDS[kind].upper()}]" if a >= at else ""]
                    at = b
                text = "".join(out) + text[at:]
            texts.append(text)
            sizes.append(None if text is None else len(text))
        where = batch.schema.get_field_index("text")
        batch = batch.set_column(where, batch.schema.field(where), pa.array(texts, batch.schema.field(where).type))
        if count in batch.schema.names:
            where = batch.schema.get_field_index(count)
            batch = batch.set_column(where, batch.schema.field(where), pa.array(sizes, batch.schema.field(where).type))
        yield batch

    return map_rows(docs, change)
