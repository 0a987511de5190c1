import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from insight.llm import collocations as C
from tests.llm.helpers import LONG, lower, no_docs, odd_docs


def brute(rows, least, top):
    """(lang, rank, phrase, a, l, r, n, score) from (lang, text) rows."""
    seen, out = {}, []
    for lang, text in rows:
        f = seen.setdefault(lang or ("und" if lang is None else lang), Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                f.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    for lang, f in seen.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cands = [p for p, c in f.items() if len(p) > 1 and c >= least]
        best = []
        for p in cands:
            if any(len(q) > len(p) and 100 * f[q] >= 50 * f[p] and any(q[i:i + len(p)] == p for i in range(len(q))) for q in cands):
                continue
            s, k = min((int(Fraction(1000000 * f[p] * f[p], f[p[:k]] * f[p[k:]])), k) for k in range(1, len(p)))
            best.append((-s, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(best)[:top])]
    return sorted(out)


def texts(n, seed=3):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["Ä", "日本", "THE", "the", "\x0b", "x.y"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    return [(rnd.choice(["en", "en", "en", "de", None]),
             "".join(w + rnd.choice([" "] * 12 + ["\t", "  ", ", ", ".\n", "\n", "; "])
                     for w in rnd.choices(vocabulary, weights, k=rnd.randrange(0, 80)))) for _ in range(n)]


def got(spark, rows, least, top):
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    return sorted(tuple(r) for r in C.collocations(df, least, top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("top", [2000, 7])
def test_equals_brute_force(spark, top):
    rows = texts(300)
    assert got(spark, rows, 5, top) == brute(rows, 5, top)


def test_a_cut_text_equals_a_whole_one(monkeypatch):
    """Slices keep line ends and share their last words."""
    monkeypatch.setattr(C, "SLICE_BYTES", 7)
    data = b"a b\nc d e, f g\th i.j k l m\n\nn o p aaaaaaaaaaaaaaaaaa q r s"
    assert b"".join(C.slices(data)) == data and max(map(len, C.slices(data))) < 30
    whole, cut = C.Counter(3, 4), C.Counter(3, 4)
    whole.add("en", [data], np.zeros(0, np.int64))
    carry = []
    for part in C.slices(data):
        cut.add("en", [part], np.array([cut.ids[w] if w != C.BREAK else 0 for w in carry], np.int64))
        carry = (carry + C.tail(part, 2))[-2:]

    def named(counter):
        name = {i: w for w, i in counter.ids.items() if i}
        return {tuple(name[x] for x in (k >> 42, k >> 21 & 0x1FFFFF, k & 0x1FFFFF) if x): c
                for keys, counts in counter.tries["en"].items() for k, c in zip(keys.tolist(), counts.tolist())}
    assert named(whole) == named(cut)


def test_bursting_and_spilling_lose_nothing(monkeypatch):
    monkeypatch.setattr(C, "BURST", 8)
    monkeypatch.setattr(C, "HELD", 300)
    counter, want, found, deep = C.Counter(3, 5), Counter(), Counter(), False
    import pyarrow as pa
    runs = []
    for _, text in texts(200):
        counter.add("en", [text.encode()], np.zeros(0, np.int64))
        deep |= any(isinstance(k, C.Node) for k in counter.tries["en"].kids)
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            want.update(" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
        assert list(counter.tries["en"].lows) == sorted(counter.tries["en"].lows)
        if counter.full():
            runs += list(counter.spill())
            assert counter.held <= 150 and counter.held == sum(t.size() for t in counter.tries.values())
    runs += list(counter.spill(everything=True))
    where = {}
    for batch in runs:
        t = pa.ipc.open_stream(batch.column(2)[0].as_buffer()).read_all()
        for p, f in zip(t["phrase"].to_pylist(), t["f"].to_pylist()):
            found[p.decode()] += f
            assert where.setdefault(p, batch.column(0)[0].as_py()) == batch.column(0)[0].as_py()
    assert deep and found == want


def test_many_words_are_forgotten_with_a_spill(spark, monkeypatch):
    monkeypatch.setattr(C, "WORDS", 20)
    rows = texts(60)
    counter = C.Counter(3, 5)
    for lang, text in rows:
        counter.add("en", [text.encode()], np.zeros(0, np.int64))
        if counter.full():
            list(counter.spill())
            assert not counter.ids and not counter.tries


def test_scores_beyond_64_bits(spark):
    row = spark.sql("SELECT 3000000000001L a, 3000000000007L l, 3000000000011L r").select(C.score("a", "l", "r").alias("s")).first()
    assert row.s == 1000000 * 3000000000001 ** 2 // (3000000000007 * 3000000000011)


def test_odd_rows_empty_tables_and_clashing_names(spark):
    from pyspark.sql import functions as F
    df = odd_docs(spark, clashing=True).withColumns({c: F.lit("x") for c in ("phrase", "a", "l", "r", "salt", "share", "words", "f", "bucket", "run")})
    rows = {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in C.collocations(df).collect()}
    assert rows["en", "long text with"][:3] == (30_000, 30_000, 30_000) and len(LONG) > 700_000
    assert C.collocations(no_docs(spark)).collect() == []
