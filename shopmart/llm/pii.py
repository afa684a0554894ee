"""Personal data: base patterns, and a semi-Markov conditional random field for what they miss.

The base patterns (e-mail, IP, card, phone) always count.  The model adds
spans between them: other spellings of the same kinds ("(974) 555-0136",
"ann [at] mail dot example").  It scores whole candidate segments (digit
groups, separators, check digit, neighbours) and a dynamic program over
tokens, with segments of at most ``MAX_TOKENS`` tokens, chooses boundaries and
kinds jointly.

It is trained here, by maximum likelihood on a bounded sample of contexts of
base spans in the documents, some of them respelled, and of digits or signs
that are no base span.  It looks only at the surroundings of digits and signs
outside base spans, so a task's work follows those, not the text.
"""

from __future__ import annotations

import bisect
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopmart.llm import _text as T
from shopmart.llm._store import shipped, stored

KINDS = ("email", "ip", "card", "phone")
#: Documents that are searched for training contexts, contexts used, and passes over them.
TRAIN_DOCS, TRAIN_CONTEXTS, EPOCHS = 4000, 900, 8
#: Tokens in an entity at most; characters of context around a trigger; hashed features.
MAX_TOKENS, CONTEXT, BUCKETS = 16, 48, 1 << 12
#: Tokens whose segments are scored at once at most.
STRETCH = 2048

# The base patterns.  The look-behind only spares repeated scans of one digit run.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)
_TRIGGER = re.compile(r"[0-9]+|@|[\[(]at[\])]| dot ", re.I)
_AT = re.compile(r"@|[\[(]\s*at\s*[\])]|\sat\s.*\sdot\s", re.I | re.S)
_NOT_DIGIT = re.compile(r"[^0-9]+")
_Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[_Span]:
    """Spans of the base patterns, leftmost and non-overlapping within a kind; matches that fail their check are dropped."""
    out = list(_emails(text))
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m.group().split("."))):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append(("phone", *m.span()))
    return in_order(out)


def in_order(spans: list[_Span]) -> list[_Span]:
    return sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % BUCKETS


def _digit(c: str) -> bool:
    """An ASCII digit: other scripts' and raised digits are no digits here."""
    return "0" <= c <= "9"


def _alnum(c: str) -> bool:
    return _digit(c) or c.isalpha()


def _shape(token: str) -> str:
    if _digit(token[0]):
        return f"d{min(len(token), 20)}"
    return "a" if token[0].isalpha() else "_" if token.isspace() else token


class Region:
    """Tokens of a stretch of text and its candidate segments: (first token, end token, kinds, features)."""

    def __init__(self, text: str, blocked: list[tuple[int, int]] = ()):
        self.tokens = [m.span() for m in _TOKEN.finditer(text)]
        part = [text[a:b] for a, b in self.tokens]
        shape = [_shape(p) for p in part]
        free = [not any(a < e and s < b for s, e in blocked) for a, b in self.tokens]
        self.segments = []
        for i, p in enumerate(part):
            if not free[i] or not (_alnum(p[0]) or p[0] in "+("):
                continue
            digits = ""
            letters = False
            for j in range(i + 1, min(i + MAX_TOKENS, len(part)) + 1):
                if not free[j - 1]:
                    break
                q = part[j - 1]
                digits += q if _digit(q[0]) else ""
                letters |= q[0].isalpha()
                if not _alnum(q[0]) or (not letters and len(digits) < 4):
                    continue
                span = text[self.tokens[i][0]: self.tokens[j - 1][1]]
                if letters and not _AT.search(span):
                    if q[0].isalpha() and not digits and "@" not in span and j - i > 6:
                        break
                    continue
                self.segments.append((i, j, (0,) if letters else (1, 2, 3), self.features(span, part[i:j], shape, i, j, digits, letters)))

    @staticmethod
    def features(span, part, shape, i, j, digits, letters) -> np.ndarray:
        left, right = shape[i - 1] if i else "^", shape[j] if j < len(shape) else "$"
        seps = "".join(sorted({p for p in part if not _alnum(p[0])}))
        names = ["bias", f"left:{left}", f"left2:{shape[i - 2] if i > 1 else '^'} {left}", f"right:{right}", f"right2:{right} {shape[j + 1] if j + 1 < len(shape) else '$'}", f"seps:{seps}"]
        if letters:
            marks = [m.group().lower().strip() for m in _AT.finditer(span)]
            ends = span.rpartition(".")[2] if "." in span else span.split()[-1]
            names += [f"at:{marks[0][:3] if len(marks) == 1 else len(marks)}", f"ends:{min(len(ends), 8)}", f"spaces:{sum(p.isspace() for p in part)}", f"dots:{span.count('.') + span.lower().count(' dot ')}",
                      f"first:{shape[i]}", f"tokens:{j - i}"]
        else:
            groups = [len(p) for p in part if _digit(p[0])]
            names += [f"groups:{groups}", f"digits:{len(digits)}", f"shape:{''.join(shape[i:j])}", f"luhn:{13 < len(digits) < 20 and luhn(digits)}", f"starts:{span[0] if not _digit(span[0]) else 'd'}",
                      f"bytes:{len(groups) == 4 and max(groups) < 4 and all(int(p) < 256 for p in part if _digit(p[0]))} {seps}", f"parens:{span.count('(') == span.count(')')}"]
        return np.array([_bucket(n) for n in names])

    def scored(self, weight: np.ndarray):
        return [(i, j, k, s) for i, j, kinds, f in self.segments for k, s in zip(kinds, weight[f][:, list(kinds)].sum(0))]

    def decode(self, weight: np.ndarray) -> list[_Span]:
        """Best segmentation: tokens outside score 0, entities their weight."""
        by_end: dict[int, list] = {}
        for i, j, k, s in self.scored(weight):
            if s > 0:
                by_end.setdefault(j, []).append((i, k, s))
        best, back = [0.0], [None]
        for j in range(1, len(self.tokens) + 1):
            top, how = best[j - 1], None
            for i, k, s in by_end.get(j, ()):
                if best[i] + s > top:
                    top, how = best[i] + s, (i, k)
            best.append(top)
            back.append(how)
        out, j = [], len(self.tokens)
        while j:
            if back[j]:
                i, k = back[j]
                out.append((KINDS[k], self.tokens[i][0], self.tokens[j - 1][1]))
                j = i
            else:
                j -= 1
        return out[::-1]

    def gradient(self, weight: np.ndarray, gold: set[tuple[int, int, int]], step) -> None:
        """Feed expected minus observed feature counts of each segment and kind to ``step``."""
        n, scored = len(self.tokens), self.scored(weight)
        ends: list[list] = [[] for _ in range(n + 1)]
        starts: list[list] = [[] for _ in range(n + 1)]
        for x in scored:
            ends[x[1]].append(x)
            starts[x[0]].append(x)
        alpha, beta = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(1, n + 1):
            alpha[j] = np.logaddexp.reduce([alpha[j - 1], *(alpha[i] + s for i, _, _, s in ends[j])])
        for i in range(n - 1, -1, -1):
            beta[i] = np.logaddexp.reduce([beta[i + 1], *(beta[j] + s for _, j, _, s in starts[i])])
        at = 0
        for i, j, kinds, f in self.segments:
            for k in kinds:
                s = scored[at][3]
                at += 1
                d = np.exp(alpha[i] + s + beta[j] - alpha[n]) - ((i, j, k) in gold)
                if abs(d) > 1e-4:
                    step(f, k, d)


def _respelled(kind: str, span: str, rng) -> str:
    """The span as a base pattern would not find it."""
    digits = _NOT_DIGIT.sub("", span)
    if kind == "email":
        user, _, host = span.rpartition("@")
        sign, dot = [(" [at] ", "."), (" (at) ", " dot "), (" at ", " dot "), ("[at]", "."), (" @ ", ".")][rng.integers(5)]
        return user + sign + host.replace(".", dot)
    if kind == "phone":
        a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
        return [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a} {b} {c}", f"{a}.{b}.{c}", f"({a}){b}-{c}"][rng.integers(5)]
    if kind == "card":
        return [".", "  ", " - ", "/"][rng.integers(4)].join(digits[i:i + 4] for i in range(0, len(digits), 4))
    return [" . ", ",", "-"][rng.integers(3)].join(span.split("."))


def _plain(rng) -> str:
    """A number that is nothing personal: a plain one of any length, a date, a version, an amount, a range."""
    n = rng.integers
    return [str(n(1, 10) * 10 ** n(1, 17) + n(1 << 30)), f"{n(1900, 2100)}-{n(10, 13)}-{n(10, 32)}", f"{n(1, 32)}.{n(1, 13)}.{n(1900, 2100)}", f"{n(1, 32)}/{n(1, 13)}/{n(1900, 2100)}", f"{n(20)}.{n(20)}.{n(400)}",
            f"{n(1, 999)},{n(100, 999)}.{n(10, 99)}", f"{n(1, 2000)}-{n(1, 3000)}", f"{n(24)}:{n(10, 60)}:{n(10, 60)}", f"{n(1, 90)}, {n(1, 90)}, {n(1, 90)} and {n(1, 9000)}", f"{n(1, 99)} {n(100, 999)} {n(100, 999)}"][n(10)]


@dataclass
class Model:
    weight: np.ndarray  # feature x kind

    def added(self, text: str, base: list[_Span], memo: dict) -> list[_Span]:
        """Spans that the model finds outside the base spans."""
        blocked = _merged(base)
        starts = [s for s, _ in blocked]
        regions: list[list[int]] = []
        for m in _TRIGGER.finditer(text):
            i = bisect.bisect_right(starts, m.start()) - 1
            if i >= 0 and m.start() < blocked[i][1]:
                continue
            a, b = max(0, m.start() - CONTEXT), min(len(text), m.end() + CONTEXT)
            if regions and a <= regions[-1][1]:
                regions[-1][1] = b
            else:
                regions.append([a, b])
        out = []
        for a, b in regions:
            near = [(max(s - a, 0), e - a) for s, e in blocked[max(bisect.bisect_right(starts, a) - 1, 0): bisect.bisect_left(starts, b)] if e > a]
            if b - a > 4 * STRETCH:
                found = decode_long(text[a:b], near, self.weight)
            else:
                key = (text[a:b], tuple(near))
                if key not in memo:
                    if len(memo) > 20000:
                        memo.clear()
                    memo[key] = Region(text[a:b], near).decode(self.weight)
                found = memo[key]
            out += [(k, s + a, e + a) for k, s, e in found]
        return out


def decode_long(text: str, blocked: list[tuple[int, int]], weight: np.ndarray) -> list[_Span]:
    """``Region(text, blocked).decode(weight)`` without all segments at once: a stretch of tokens is
    scored with the tokens that its segments and their features can reach, and the dynamic program runs
    on over all stretches, so the result does not depend on where they end."""
    start = np.fromiter((m.start() for m in _TOKEN.finditer(text)), np.int64)
    n = len(start)
    start = np.append(start, len(text))
    best, first, kind = np.zeros(n + 1), np.full(n + 1, -1, np.int64), np.zeros(n + 1, np.int8)
    at = [s for s, _ in blocked]
    by_end: dict[int, list] = {}
    for t in range(0, n, STRETCH):
        low, high = max(0, t - 2), min(n, t + STRETCH + MAX_TOKENS + 2)
        x, y = int(start[low]), int(start[high])
        near = [(s - x, e - x) for s, e in blocked[max(bisect.bisect_right(at, x) - 1, 0): bisect.bisect_left(at, y)] if e > x]
        for i, j, k, s in Region(text[x:y], near).scored(weight):
            if s > 0 and t <= i + low < t + STRETCH:
                by_end.setdefault(j + low, []).append((i + low, k, s))
        for j in range(t + 1, min(n, t + STRETCH) + 1):
            best[j] = best[j - 1]
            for i, k, s in by_end.pop(j, ()):
                if best[i] + s > best[j]:
                    best[j], first[j], kind[j] = best[i] + s, i, k
    out, j = [], n
    while j:
        if first[j] >= 0:
            out.append((KINDS[kind[j]], int(start[first[j]]), int(start[j])))
            j = int(first[j])
        else:
            j -= 1
    return out[::-1]


def _merged(spans: list[_Span]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def fit(contexts: list[tuple[str, str, str, str]], seed: int = 3) -> Model:
    """Maximum likelihood on contexts (left, span, right, kind; kind '' where nothing personal is near)."""
    rng = np.random.default_rng(seed)
    weight, square = np.zeros((BUCKETS, len(KINDS))), np.full((BUCKETS, len(KINDS)), 1e-6)
    data = []
    for left, span, right, kind in contexts:
        for said in (span, _respelled(kind, span, rng)) if kind else (span, _plain(rng), _plain(rng)):
            region = Region(left + said + right)
            a, b = len(left), len(left) + len(said)
            gold = {(i, j, k) for i, j, kinds, _ in region.segments for k in kinds if kind and KINDS[k] == kind and region.tokens[i][0] == a and region.tokens[j - 1][1] == b}
            if region.segments and bool(gold) == bool(kind):
                data.append((region, gold))

    def step(f, k, d):
        square[f, k] += d * d
        weight[f, k] -= 0.3 * (d + 1e-3 * weight[f, k]) / np.sqrt(square[f, k])

    for _ in range(EPOCHS):
        for i in rng.permutation(len(data)):
            region, gold = data[i]
            region.gradient(weight, gold, step)
    return Model(weight)


def _contexts(batches):
    names = ["left", "span", "right", "kind"]
    for part in T.slices(batches, 0):
        rows = set()
        for text in part.column(0).to_pylist():
            if not text or not _TRIGGER.search(text):
                continue
            base = base_spans(text)
            # spans with no other nearby
            lone = [b for o, b, n in zip([None, *base], base, [*base[1:], None]) if (o is None or o[2] <= b[1] - CONTEXT) and (n is None or n[1] >= b[2] + CONTEXT)]
            rows |= {(text[max(0, s - CONTEXT // 2): s], text[s:e], text[e: e + CONTEXT // 2], k) for k, s, e in lone}
            near = _merged([(k, s - CONTEXT, e + CONTEXT) for k, s, e in base])
            at = 0
            for m in _TRIGGER.finditer(text):
                while at < len(near) and near[at][1] <= m.start():
                    at += 1
                if at == len(near) or m.end() <= near[at][0]:
                    rows.add((text[max(0, m.start() - CONTEXT // 2): m.start()], m.group(), text[m.end(): m.end() + CONTEXT // 2], ""))
        columns = list(zip(*sorted(rows))) if rows else [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=names)


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Fit on a sample of ``TRAIN_DOCS`` documents, ``TRAIN_CONTEXTS`` of their contexts; without any, the model adds nothing."""
    text = F.col(f"`{text_col}`").cast("string")
    n = docs.count()  # reads no text
    share = max(1, (1 << 20) * TRAIN_DOCS // max(n, 1))
    sample = docs.select(text.alias("text")).filter(F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(1 << 20)) < share)
    found = sample.mapInArrow(_contexts, "left string, span string, right string, kind string").distinct()
    found = stored(found)
    each = TRAIN_CONTEXTS // (len(KINDS) + 1)
    h = F.xxhash64("left", "span", "right")
    rows = [r for kind in ("", *KINDS) for r in found.filter(F.col("kind") == kind).orderBy(h, "left", "span", "right").limit(each).collect()]
    return fit([tuple(r) for r in rows])


def find(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", mask: bool = False) -> DataFrame:
    """Personal data in every whole text.

    Returns ``row`` (the columns in ``keep``), ``base`` and ``spans`` (arrays
    of kind, start, end in code points, end exclusive, by start, then kind),
    where ``spans`` holds the base spans and what the model adds outside
    them; with ``mask`` also ``masked``, the text with each span replaced by
    its kind in brackets (overlapping spans as one, by the first kind).

    Null and empty texts have no spans (masked: null stays null).  Results
    depend on the text alone, so repeated rows agree.
    """
    get = shipped(docs.sparkSession, model)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(column: pa.Array) -> list[pa.Array]:
        base, spans, masked, model, memo = [], [], [], get(), {}
        for text in column.to_pylist():
            b = s = []
            if text and _TRIGGER.search(text):
                b = base_spans(text)
                s = in_order(b + model.added(text, b, memo))
            base.append([{"kind": k, "start": x, "end": y} for k, x, y in b])
            spans.append([{"kind": k, "start": x, "end": y} for k, x, y in s])
            if mask:
                masked.append(masked_text(text, s))
        return [pa.array(base, kind), pa.array(spans, kind), *([pa.array(masked, pa.string())] if mask else [])]

    fields = "base array<struct<kind:string,start:int,end:int>>, spans array<struct<kind:string,start:int,end:int>>"
    return T.map_text(docs, text_col, keep, fields + (", masked string" if mask else ""), run)


def masked_text(text: str | None, spans: list[_Span]) -> str | None:
    if not text:
        return text
    out, done = [], 0
    for k, s, e in spans:
        if s >= done:
            out += [text[done:s], f"[{k.upper()}]"]
        done = max(done, e)
    return "".join(out) + text[done:]
