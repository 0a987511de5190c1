"""Personal data by fixed rules and a semi-Markov conditional random field over whole spans.

Base spans are the matches of the contract's patterns, found in linear time.
The random field adds spans that these patterns miss (numbers without a
country code, cards parted by dots, spelled-out addresses). It scores whole
segments: a candidate is any run of up to ``MOST_TOKENS`` tokens that begins and
ends like an entity; its features look at the whole span (shape, digits, check sum,
number ranges, length) and at the words beside it, and a weight per pair of
types scores what follows what. A dynamic programme over positions, bounded by
``MOST_TOKENS``, finds the best segmentation, so boundaries and types are chosen
jointly. A candidate holds a mark (a digit, ``@`` or a spelled-out one) that is in no base
span and reaches at most ``REACH`` characters beyond its marks; text out of that
reach can hold no entity and is passed over.

Training: the weights are fitted by gradient steps on the segmentation's exact
log-likelihood (forward and backward sums over segments), on windows around the base
matches of at most ``SAMPLE`` different documents of at most ``SAMPLE_CHARS`` characters
(those of least hash among those with a match). In each window, the match is kept, rewritten in a looser form of the same
type, or replaced by a number that is none (year, price, date, version, code); a random
generator with a fixed seed chooses. A table without a base match trains
nothing and gets base spans only.

Added spans carry kinds of their own (``crf_email`` ...); those that touch a base
span are left out, base spans always stay.

Defined cases: a null or empty text has no spans; repeated rows give repeated
results; an empty table gives no rows; extra columns are not read. A text
of any length is read whole, in time linear in its length.
"""

from __future__ import annotations

import random
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterable
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from insight.llm.common import arrow_map

#: Fixed values of the contract: kinds in order, and their patterns (possessive where that changes no match).
KINDS = ("email", "ip", "card", "phone")
ADDED = tuple(f"crf_{k}" for k in KINDS)
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: Bounds of the training sample: different documents that windows are taken from, their length, windows;
#: characters on each side of a match, passes over the windows.
SAMPLE = 300
SAMPLE_CHARS = 20_000
EXAMPLES = 1_000
CONTEXT = 24
REWRITES = 4
EPOCHS = 6
SEED = 20
#: Tokens of a segment at most, characters that it reaches beyond its outermost mark, hashed features.
MOST_TOKENS = 16
REACH = 40
FEATURES = 1 << 13
#: An added span needs this lead of its segmentation over the one without it.
MARGIN = 1.0

TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^\S\n]+|\n|.", re.S)
SEED_MARK = re.compile(r"[0-9]+|@|[(\[{] ?at ?[)\]}]", re.I)
NON_DIGIT = re.compile(r"[^0-9]")
MARKS = re.compile(r"[(\[{] ?(at|dot) ?[)\]}]", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def byte_value(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def emails(text: str) -> Iterable[tuple[int, int]]:
    """Addresses around each @: the run of characters before it, and the longest domain after it."""
    at, after = text.find("@"), 0
    while at >= 0:
        start = at
        while start > after and text[start - 1] in LOCAL_CHARS:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
        after = found.end() if found else at + 1
        at = text.find("@", after)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the contract's matches, in order."""
    found = [(s, 0, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(map(byte_value, m.group().split("."))):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 37 and 14 <= len(digits := NON_DIGIT.sub("", m.group())) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= len(NON_DIGIT.sub("", m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def hashed(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % FEATURES


def squeezed(span: str) -> str:
    """Shape of a span: letters a, digits as the run's length (up to 5), marks as they are."""
    span = MARKS.sub(lambda m: "<at>" if m.group(1).lower() == "at" else "<dot>", span)
    return re.sub(r"[0-9]+|[^\W\d_]+", lambda m: str(min(len(m.group()), 5)) if m.group()[0].isdigit() else "a", span)


def span_features(span: str, before: str, after: str) -> list[str]:
    """Whole-span features; ``before`` and ``after`` are the nearest words and characters outside."""
    digits = NON_DIGIT.sub("", span)
    n = len(digits)
    shape = squeezed(span)
    kinds = re.sub(r"[0-9]", "d", shape)
    parts = span.split(".")
    out = ["bias", f"n{min(n, 20)}", f"shape{shape}" if len(shape) < 24 else "long", f"kinds{kinds}" if len(kinds) < 32 else "many",
           f"first{shape[:1]}", f"last{kinds[-1:]}", f"before{before}", f"after{after}"]
    if 13 <= n <= 19:
        out.append("luhn" if luhn(digits) else "noluhn")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        out.append("ipv4" if all(map(byte_value, parts)) else "noip")
    if "@" in span or "<at>" in shape:
        out.append("at" + ("dot" if "." in span or "<dot>" in shape else ""))
    if any(c.isalpha() for c in span):
        out.append("letters")
    return out


@dataclass(frozen=True)
class Region:
    """Tokens of a stretch of text: their texts and places, and the candidate segments (first, past the last)."""

    text: str
    tokens: list[tuple[int, int]]
    segments: list[tuple[int, int]]


def region(text: str, start: int, stop: int) -> Region:
    """Tokens and candidates of text[start:stop]."""
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text, start, stop)]
    marks = [bool(SEED_MARK.search(text[a:b])) or text[a] == "@" for a, b in tokens]
    spelled = {m.start() for m in MARKS.finditer(text, start, stop)}
    opens = [text[a].isascii() and (text[a].isalnum() or text[a] in "+(") and not (a and text[a - 1].isalnum()) for a, _ in tokens]
    closes = [text[a].isascii() and text[a].isalnum() and not text[b:b + 1].isalnum() for a, b in tokens]
    segments = []
    for i, (a, _) in enumerate(tokens):
        if not opens[i] or a in spelled:
            continue
        seen = 0
        for j in range(i, min(i + MOST_TOKENS, len(tokens))):
            b, c = tokens[j]
            if c - b > 24 or text[b] == "\n":
                break
            seen += marks[j] or b in spelled
            if seen and closes[j] and j > i or seen and j == i and text[b].isdigit() and c - b >= 7:
                segments.append((i, j + 1))
    return Region(text, tokens, segments)


class Crf:
    """Weights of segment types and of what follows what; type 0 is outside (one token)."""

    def __init__(self, weights: np.ndarray, follows: np.ndarray) -> None:
        self.weights, self.follows = weights, follows  # [type - 1, feature], [type, type]
        self.memo: dict[tuple, np.ndarray] = {}

    @staticmethod
    def features(r: Region) -> list[np.ndarray]:
        """Feature numbers of every candidate."""
        out = []
        for i, j in r.segments:
            a, b = r.tokens[i][0], r.tokens[j - 1][1]
            out.append(np.array([hashed(f) for f in span_features(r.text[a:b], *beside(r, i, j))]))
        return out

    def scores(self, r: Region) -> np.ndarray:
        """[candidate, type - 1]; spans that look alike to all features are scored once."""
        out = np.zeros((len(r.segments), len(KINDS)))
        for k, (i, j) in enumerate(r.segments):
            names = tuple(span_features(r.text[r.tokens[i][0]:r.tokens[j - 1][1]], *beside(r, i, j)))
            row = self.memo.get(names)
            if row is None:
                if len(self.memo) > 100_000:
                    self.memo.clear()
                row = self.memo[names] = self.weights[:, [hashed(n) for n in names]].sum(1)
            out[k] = row
        return out

    def best(self, r: Region) -> list[tuple[int, int, int]]:
        """(first, past the last, type) of the entities of the best segmentation."""
        n, t = len(r.tokens), len(KINDS) + 1
        scores, ends = self.scores(r), {}
        for k, (i, j) in enumerate(r.segments):
            ends.setdefault(j, []).append((i, k))
        top = np.full((n + 1, t), -np.inf)  # best score of a prefix whose last segment has the type
        top[0, 0] = 0
        back: list[list] = [[None] * t for _ in range(n + 1)]
        for j in range(1, n + 1):
            into = top[j - 1] + self.follows[:, 0]
            p = int(into.argmax())
            top[j, 0], back[j][0] = into[p], (j - 1, p)
            for i, k in ends.get(j, ()):
                into = top[i][:, None] + self.follows[:, 1:]
                p = into.argmax(0)
                made = into[p, range(t - 1)] + scores[k] - MARGIN
                for y in np.flatnonzero(made > top[j, 1:]).tolist():
                    top[j, y + 1], back[j][y + 1] = made[y], (i, int(p[y]))
        found, j, y = [], n, int(top[n].argmax())
        while j:
            i, p = back[j][y]
            if y:
                found.append((i, j, y))
            j, y = i, p
        return found[::-1]

    def gradient(self, r: Region, feats: list[np.ndarray], gold: list[tuple[int, int, int]]) -> tuple[float, np.ndarray, np.ndarray, list]:
        """Log-likelihood of a segmentation; expected minus given use of transitions and of (candidate, type)."""
        n, t = len(r.tokens), len(KINDS) + 1
        scores = np.array([self.weights[:, f].sum(1) for f in feats]).reshape(-1, t - 1)
        starts, ends = {}, {}
        for k, (i, j) in enumerate(r.segments):
            starts.setdefault(i, []).append((j, k))
            ends.setdefault(j, []).append((i, k))

        fore = np.full((n + 1, t), -np.inf)
        fore[0, 0] = 0
        for j in range(1, n + 1):
            fore[j, 0] = np.logaddexp.reduce(fore[j - 1] + self.follows[:, 0])
            for i, k in ends.get(j, ()):
                fore[j, 1:] = np.logaddexp(fore[j, 1:], np.logaddexp.reduce(fore[i][:, None] + self.follows[:, 1:], axis=0) + scores[k])
        hind = np.full((n + 1, t), -np.inf)  # what can follow a prefix that ends with the type
        hind[n] = 0
        for i in range(n - 1, -1, -1):
            hind[i] = self.follows[:, 0] + hind[i + 1, 0]
            for j, k in starts.get(i, ()):
                hind[i] = np.logaddexp(hind[i], np.logaddexp.reduce(self.follows[:, 1:] + (scores[k] + hind[j, 1:])[None], axis=1))
        total = np.logaddexp.reduce(fore[n])
        moves = np.zeros((t, t))
        used = np.zeros_like(scores)
        for i in range(n):
            moves[:, 0] += np.exp(fore[i] + self.follows[:, 0] + hind[i + 1, 0] - total)
            for j, k in starts.get(i, ()):
                m = np.exp(fore[i][:, None] + self.follows[:, 1:] + (scores[k] + hind[j, 1:])[None] - total)
                moves[:, 1:] += m
                used[k] += m.sum(0)
        number = {s: k for k, s in enumerate(r.segments)}
        given, at, last = 0.0, 0, 0
        for i, j, y in [*gold, (n, n, 0)]:
            while at < i:
                given += self.follows[last, 0]
                moves[last, 0] -= 1
                at, last = at + 1, 0
            if j > i:
                k = number[i, j]
                given += self.follows[last, y] + scores[k, y - 1]
                moves[last, y] -= 1
                used[k, y - 1] -= 1
                at, last = j, y
        return given - total, moves, used, feats


def beside(r: Region, i: int, j: int) -> tuple[str, str]:
    """The characters just before and after a segment, in a few classes; behind a space, the one beyond it."""
    def side(at: int, step: int) -> str:
        if not 0 <= at < len(r.text):
            return "end"
        c = r.text[at]
        if c.isspace():
            return " " + side(at + step, step) if step and 0 <= at + step < len(r.text) and not r.text[at + step].isspace() else " "
        return "digit" if c.isdigit() else "letter" if c.isalpha() else c if c.isascii() else "other"
    return side(r.tokens[i][0] - 1, -1), side(r.tokens[j - 1][1], 1)


# ---- training data -------------------------------------------------------------------------------------------------

def loosened(rnd: random.Random, kind: int, span: str) -> str:
    """Another way to write an entity of a kind."""
    digits = NON_DIGIT.sub("", span)
    if kind == 0:
        local, _, domain = span.partition("@")
        if rnd.random() < .6:
            local, domain = (rnd.choice(["", ".", "_"] if k else ["."]).join(
                "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randrange(2, 9))) for _ in range(rnd.randrange(1, 3) + k)) for k in (0, 1))
            domain = domain if "." in domain else domain + ".org"
        at = rnd.choice(["[at]", "(at)", " [at] ", " (at) "])
        return local + at + (domain if rnd.random() < .5 else domain.replace(".", rnd.choice(["[dot]", "(dot)", " [dot] "])))
    if kind == 1:
        return ".".join(str(rnd.randrange(256)) for _ in range(4))
    if kind == 2:
        sep = rnd.choice([".", "  ", " - ", "/"])
        return sep.join(digits[k:k + 4] for k in range(0, len(digits), 4))
    local = digits[-10:]
    return rnd.choice(["({}) {}-{}", "{}-{}-{}", "({}){}-{}", "{} {}-{}"]).format(local[:3], local[3:6], local[6:])


def not_personal(rnd: random.Random) -> str:
    """A number that is no personal data."""
    n = rnd.randrange
    return rnd.choice([
        lambda: str(n(1900, 2100)), lambda: str(n(1000)), lambda: f"{n(1, 100)},{n(100, 1000)}", lambda: f"${n(1, 999)}.{n(10, 99)}",
        lambda: f"{n(1, 29)}/{n(1, 13)}/{n(1990, 2030)}", lambda: f"{n(1990, 2030)}-{n(10, 13)}-{n(10, 29)}", lambda: f"{n(1, 24)}:{n(10, 60)}",
        lambda: f"v{n(1, 9)}.{n(20)}.{n(20)}", lambda: f"{n(1, 9)}.{n(100)}.{n(1000)}", lambda: f"{n(300, 999)}.{n(300, 999)}.{n(1, 999)}.{n(1, 99)}",
        lambda: f"{n(10 ** 6, 10 ** 12)}", lambda: f"{n(16 ** 20, 16 ** 30):x}", lambda: f"{n(100)}%", lambda: f"A{n(100, 10 ** 6)}",
        lambda: f"{n(1, 99)}-{n(1, 99)}", lambda: "".join(str(n(10)) for _ in range(15)) + "0", lambda: f"{n(1, 200)}.{n(10, 99)}",
        lambda: f"({n(1, 100)})", lambda: f"{n(1, 9)}{rnd.choice(['st', 'nd', 'rd', 'th'])}", lambda: f"{n(100, 999)}-{n(1000, 9999)}-{n(10, 99)}-{n(100000, 999999)}"])()


def examples(texts: Iterable[str], seed: int = SEED, most: int = EXAMPLES) -> list[tuple[Region, list[tuple[int, int, int]]]]:
    """Windows around base matches as they are, loosened, and with a number that is no personal data.

    A few matches are rewritten up to ``REWRITES`` times until there are ``most`` windows.
    """
    rnd, places, out = random.Random(seed), [], []
    for text in texts:
        spans = base_spans(text)
        for n, (start, kind, stop) in enumerate(spans):
            alone = not any(s < stop + CONTEXT and e > start - CONTEXT for s, _, e in spans[max(0, n - 3):n] + spans[n + 1:n + 4])
            if alone and stop - start <= 80:
                places.append((text[max(0, start - CONTEXT):start], kind, text[start:stop], text[stop:stop + CONTEXT]))
    for again in range(REWRITES):
        for left, kind, span, right in places:
            made = [(loosened(rnd, kind, span), kind + 1), (not_personal(rnd), 0)]
            for text, y in made if again else [(span, kind + 1), *made]:
                r = region(left + text + right, 0, len(left + text + right))
                where = {a: i for i, (a, _) in enumerate(r.tokens)}
                upto = {b: i + 1 for i, (_, b) in enumerate(r.tokens)}
                gold = (where.get(len(left), -1), upto.get(len(left) + len(text), -1))
                if not y:
                    out.append((r, []))
                elif gold in r.segments:
                    out.append((r, [(*gold, y)]))
        if len(out) >= most:
            break
    rnd.shuffle(out)
    return out[:most]


def fit(given: list[tuple[Region, list[tuple[int, int, int]]]], epochs: int = EPOCHS, rate: float = 0.2, decay: float = 1e-3) -> Crf:
    """Gradient steps with per-weight rates (sums of squared gradients) on the exact log-likelihood, in a fixed order."""
    t = len(KINDS) + 1
    crf = Crf(np.zeros((t - 1, FEATURES)), np.zeros((t, t)))
    w_sum, m_sum = np.full_like(crf.weights, 1e-6), np.full_like(crf.follows, 1e-6)
    feats = [Crf.features(r) for r, _ in given]
    flat = [np.unique(np.concatenate(f), return_inverse=True) if f else None for f in feats]
    rows = [np.repeat(np.arange(len(f)), [len(x) for x in f]) for f in feats]
    order, rnd = list(range(len(given))), random.Random(SEED)
    for _ in range(epochs):
        rnd.shuffle(order)
        for n in order:
            _, moves, used, _ = crf.gradient(given[n][0], feats[n], given[n][1])
            g = moves + decay * crf.follows
            m_sum += g * g
            crf.follows -= rate * g / np.sqrt(m_sum)
            if flat[n]:
                names, at = flat[n]
                step = np.zeros((len(names), t - 1))
                np.add.at(step, at, used[rows[n]])
                step = step.T + decay * crf.weights[:, names]
                w_sum[:, names] += step * step
                crf.weights[:, names] -= rate * step / np.sqrt(w_sum[:, names])
    return crf


def trained(docs: DataFrame, text_col: str = "text", sample: int = SAMPLE) -> Crf | None:
    """A model from the base matches of ``sample`` different documents at most, or None without any."""
    t = F.col(text_col)
    rows = docs.select(t.alias("t"), F.xxhash64(t).alias("h")).filter(
        F.length("t") <= SAMPLE_CHARS).filter(F.col("t").rlike(r"@[A-Za-z0-9-]+\.|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|\+[0-9]|[0-9]{4}[\x20-]?[0-9]{4}[\x20-]?[0-9]{4}"))
    least = [r.h for r in rows.select("h").distinct().orderBy("h").limit(sample).collect()]
    if not least:
        return None
    hashes = docs.select(t.alias("t"), F.xxhash64(t).alias("h")).filter(F.col("h").isin(least))
    given = examples(r.t for r in hashes.groupBy("h").agg(F.min("t").alias("t")).orderBy("h").collect())
    return fit(given) if given else None


# ---- finding -------------------------------------------------------------------------------------------------------

def regions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Stretches within reach of a mark that is in no base span, cut between words."""
    taken: list[list[int]] = []
    for s, e in sorted((s, e) for s, _, e in base):
        if taken and s <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], e)
        else:
            taken.append([s, e])
    out: list[list[int]] = []
    at = 0
    for m in SEED_MARK.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if at < len(taken) and taken[at][0] <= m.start() and m.end() <= taken[at][1]:
            continue
        a, b = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        while a < m.start() and a and text[a - 1].isalnum() and text[a].isalnum():
            a += 1
        while b > m.end() and text[b - 1].isalnum() and text[b:b + 1].isalnum():
            b -= 1
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def added_spans(text: str, crf: Crf, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the field's spans that touch no base span."""
    found = []
    whole = sorted((s, e) for s, _, e in base)
    starts, reach = [s for s, _ in whole], list(accumulate((e for _, e in whole), max))
    for start, stop in regions(text, base):
        r = region(text, start, stop)
        if not r.segments:
            continue
        for i, j, y in crf.best(r):
            s, e = r.tokens[i][0], r.tokens[j - 1][1]
            before = bisect_left(starts, e)
            if not before or reach[before - 1] <= s:
                found.append((s, y - 1, e))
    return found


def spans_of(text: str | None, crf: Crf | None) -> list[tuple[int, str, int]]:
    """All spans of a text as (start, kind, end), by start, then kind."""
    if not text:
        return []
    base = base_spans(text)
    extra = added_spans(text, crf, base) if crf else []
    every = [(s, k, e) for s, k, e in base] + [(s, len(KINDS) + k, e) for s, k, e in extra]
    return [(s, (KINDS + ADDED)[k], e) for s, k, e in sorted(every)]


def scan(docs: DataFrame, crf: Crf | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``spans``, an array of (kind, start, stop) by start, then kind."""
    kind = dict(docs.select(id_col).dtypes)[id_col]
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def run(batch: pa.RecordBatch) -> dict:
        made = [[{"kind": k, "start": s, "stop": e} for s, k, e in spans_of(t.as_py(), crf)] for t in batch.column(1)]
        return {id_col: batch.column(0), "spans": pa.array(made, span)}

    return arrow_map(docs.select(id_col, text_col), run, f"`{id_col}` {kind}, spans array<struct<kind:string,start:bigint,stop:bigint>>")
