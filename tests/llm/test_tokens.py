import pytest
from tokenizers import Tokenizer

from insight.llm import bpe, token_counts
from insight.llm.tokens import public, tokens
from tests.llm.helpers import no_docs, odd_docs

PATH = public("word_bpe_49k.json")
TEXTS = [
    ("a", None), ("b", ""), ("c", "Hello wörld's <|endoftext|> ́x 12 日本  don't\x85x \xa0 y z \x1c q"), ("d", "  \n\t "),
    ("e", "x" * 70_000), ("f", "ab cd, ef's \n" * 20_000), ("c", "dup"), ("c", "dup"), (None, "nul id"), ("g", "日本語" * 20_000),
    ("h", "a 1 " * 30_000 + "z" * 40_000 + " b c" * 20_000), ("i", "İSTANBUL ΣΑΣ ΟΔΟΣ é ǰ <|startoftext|>x<|endoftext|> "),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "doc_id string, text string")


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(PATH)
    out = []
    for i, text in TEXTS:
        ids = tok.encode(text or "", add_special_tokens=False).ids
        out.append((str(i), ids, tok.decode(ids, skip_special_tokens=False)))
    return out


@pytest.mark.parametrize("block_bytes", [500, bpe.BLOCK_BYTES])
def test_encode_equals_the_library(texts, library, block_bytes):
    got = [(str(r.doc_id), list(r.ids), r.decoded) for r in bpe.encode(texts, PATH, block_bytes=block_bytes).collect()]
    assert sorted(got) == sorted(library)


def test_decode_join_equals_the_library(spark, library):
    encoded = spark.createDataFrame([(n, ids) for n, (_, ids, _) in enumerate(library)], "doc_id int, ids array<int>")
    got = {r.doc_id: r.decoded for r in bpe.decode(encoded, bpe.piece_table(spark, PATH)).collect()}
    assert got == {n: text for n, (_, _, text) in enumerate(library)}


@pytest.mark.parametrize("word_parted", [True, False])
def test_counts_equal_the_library(texts, library, word_parted):
    got = token_counts.token_counts(texts, PATH, word_parted, chunk=4096, overlap=256).collect()
    sizes = sorted((str(i), len((t or "").encode()), len(x[1])) for (i, t), x in zip(TEXTS, library))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == sizes


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_counts_of_other_tokenizers(texts, name):
    lib = tokens(public(name))
    got = token_counts.token_counts(texts, public(name), False, chunk=4096, overlap=256).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == sorted((str(i), lib.counts([t or ""])[0]) for i, t in TEXTS)


def test_seam_offsets_are_code_points():
    text = "日本 é wörd x"
    for name in ("piece_bpe_32k.model", "word_bpe_49k.json"):
        assert tokens(public(name)).offsets(text)[-1][1] == len(text)


def test_odd_rows_and_no_rows(spark):
    docs = odd_docs(spark, clashing=True)
    assert bpe.encode(docs, PATH, digest=True).count() == 10
    assert token_counts.token_counts(docs, PATH, True).count() == 10
    assert bpe.encode(no_docs(spark), PATH).collect() == []
    assert token_counts.token_counts(no_docs(spark), PATH, True).collect() == []
