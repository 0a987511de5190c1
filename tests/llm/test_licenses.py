import random
import re

import pytest

from insight.llm import licenses
from tests.llm.helpers import no_docs, odd_docs

PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def brute(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = sorted((i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
    return len(words), places


def test_base_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    rows = {r.doc_id: (r.n_words, [(p.start, p.label) for p in r.places if p.base]) for r in licenses.scan(docs).collect()}
    assert rows == {i: brute(t) for i, t in texts.items()} and sum(len(v[1]) for v in rows.values()) > 10


def labels(text):
    return {licenses.TEMPLATES[t].label for _, _, t in licenses.automaton().matches(licenses.words_of(text))}


@pytest.mark.parametrize("text, want", [
    ("This work is licensed under the GNU General Public License, version 3.", {"gpl", "gpl-notice"}),
    ("licensed under GNU general public license", {"gpl", "gpl-notice"}),
    ("licensed under your GNU general public license", {"gpl"}),
    ("Licensed under the Apache License, Version 2.0.", {"apache", "apache-2.0"}),
    ("Licensed under the Apache License, Version 1.1", {"apache"}),
    ("Licensed under CC BY-NC 4.0.", {"cc-by", "cc-by-notice", "cc-by-nc"}),
    ("Released under the MIT License.", {"mit", "mit-notice"}),
    ("emit license", set()), ("MIT/License", {"mit"}), ("GNU General Public", set()), ("", set()),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction", set()),  # the rest is mandatory
    ("This is NOT licensed under the GNU General Public License", {"gpl"}), ("never released under the MIT License", {"mit"}),
    ("Licensed under CC BY-NC-SA 4.0", {"cc-by", "cc-by-notice", "cc-by-nc-sa"}), ("CC BY-ND 4.0", {"cc-by", "cc-by-nd"}),
    ("Creative Commons Attribution-NonCommercial 4.0 International License", {"cc-by-nc"}),
    ("Creative Commons Attribution 3.0 License", {"cc-by"}), ("Creative Commons Contribution 3.0 License", set()),
    ("Permission is hereby granted, free of cost, to any person", set()),
])
def test_templates(text, want):
    assert labels(text) == want


def filled(template, rng, optional):
    """A text that a template accepts: replaceable parts of random words and lengths, optional parts in or out."""
    out, skip, depth = [], None, 0
    for i, part in enumerate(licenses.MARK.split(template.wording)):
        if i % 2 == 0:
            if skip is None:
                out += licenses.words_of(part)
        elif part == "beginOptional":
            depth += 1
            if skip is None and rng.random() >= optional:
                skip = depth
        elif part == "endOptional":
            skip = None if skip == depth else skip
            depth -= 1
        elif skip is None:
            least, most = map(int, re.search(r"words=(\d+)-(\d+)", part).groups())
            out += [b"w%d" % rng.randrange(99) for _ in range(rng.randint(least, most))]
    return out


@pytest.mark.parametrize("template", licenses.WHOLE_TEXTS, ids=lambda t: t.label)
def test_whole_texts_and_changed_words(template):
    """Any filling is labelled; without one mandatory word, or with another in its place, it is not."""
    rng = random.Random(4)
    m = licenses.automaton()

    def found(words):
        return template.label in {m.templates[t].label for _, _, t in m.matches(words)}

    for _ in range(10):
        assert found(filled(template, rng, rng.random()))
    bare = filled(template, rng, 0.0)
    assert found(bare) and found([b"before"] + bare + [b"behind"])
    mandatory = [i for i, w in enumerate(bare) if not re.fullmatch(rb"w\d+", w)]
    for i in rng.sample(mandatory, 25):
        # next to a replaceable part a word may pass into it, so both neighbours are mandatory words
        if i - 1 in mandatory and i + 1 in mandatory:
            assert not found(bare[:i] + [b"xyzzy", b"xyzzy"] + bare[i + 1:])


def test_a_grant_with_another_sequel_is_no_mit_text():
    grant = next(t for t in licenses.WHOLE_TEXTS if t.label == "mit-text")
    words = filled(grant, random.Random(1), 0.0)
    cut = words.index(b"restriction") + 1
    got = licenses.automaton().matches(words[:cut] + b"but you must never sell it and pay me".split() + words[cut:])
    assert got == []


def test_markup_of_optional_and_replaceable_parts():
    t = (licenses.Template("x", "a <<beginOptional>>b <<beginOptional>>c<<endOptional>><<endOptional>> <<var;name=n;words=1-2>> d"),)
    m = licenses.Automaton(t)
    ok = ["a q d", "a b q d", "a b c q r d", "a q r d", "a d d", "a b d"]
    no = ["a", "a q r s d", "b q d"]
    assert [bool(m.matches(s.encode().split())) for s in ok] == [True] * 6
    assert [any(e[0] == 0 for e in m.matches(s.encode().split())) for s in no] == [False] * 3
    with pytest.raises(ValueError):
        licenses.Automaton((licenses.Template("x", "a <<beginOptional>> b"),))


def test_odd_rows_and_no_rows(spark):
    got = licenses.scan(odd_docs(spark, clashing=True)).collect()
    assert len(got) == 10 and all(r.places == [] for r in got)
    assert licenses.scan(no_docs(spark)).collect() == []
    assert licenses.covered([(0, 3, 0), (2, 5, 1), (7, 8, 0)]) == 6
