"""Brute-force versions and the odd rows that every operator must take."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")

LONG = "long text with many words " * 30_000

#: doc_id, text, lang, source, n_chars: nulls anywhere, empty and long texts, repeated rows, one id twice.
ODD_DOCS = [
    (1, None, "en", "a", None),
    (2, "", None, "a", 0),
    (3, " \n\t ", "en", None, 4),
    (4, LONG, "en", "b", len(LONG)),
    (5, "one two three four five six seven", "en", "b", 33),
    (6, "one two three four five six seven", "en", "a", 33),
    (6, "one two three four five six seven", "en", "a", 33),
    (None, "no id here", "en", None, 10),
    (7, "wörd", "de", "b", 4),
    (8, "日本語 テキスト", "ja", "c", 9),
]
DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"

#: Names that operators use inside, as extra columns of their input.
CLASHING = ("node", "size", "u", "spans", "ledger", "n_words", "epoch", "fail_bits", "component_id", "kept", "block", "label",
            "text_", "n", "sig", "weight", "stay_id")


def odd_docs(spark, clashing=False):
    df = spark.createDataFrame(ODD_DOCS, DOC_SCHEMA)
    if clashing:
        from pyspark.sql import functions as F
        df = df.withColumns({c: F.lit("x") for c in CLASHING})
    return df


def no_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_components(rows, width):
    """doc_id -> (set size, least id reachable) over links of similarity 0.8 or more."""
    sets = {}
    for i, text in rows:
        w = words(lower(text))
        sets[i] = (frozenset(tuple(w[k:k + width]) for k in range(len(w) - width + 1)) if len(w) >= width
                   else frozenset([tuple(w)] if w else []))
    holders, parent = defaultdict(list), {i: i for i in sets}

    def root(a):
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for i, s in sets.items():
        for g in s:
            holders[g].append(i)
    for i, s in sets.items():
        common = defaultdict(int)
        for g in s:
            for j in holders[g]:
                common[j] += 1
        for j, k in common.items():
            if j > i and 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}
