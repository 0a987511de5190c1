"""Tokenizer files behind one interface: token ends of a text, and token counts of many.

``.json`` files are read by ``tokenizers``, ``.model`` files by
``sentencepiece``. No begin, end or added special tokens, no truncation or
padding; special strings inside a text are handled as the library does by default.
"""

from __future__ import annotations

import os
from functools import cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


class JsonTokens:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()

    def counts(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def offsets(self, text: str) -> list[tuple[int, int]]:
        return self.tok.encode(text, add_special_tokens=False).offsets

    def pieces(self) -> list[str]:
        vocab = self.tok.get_vocab(with_added_tokens=True)
        out = [""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            out[i] = piece
        return out


class ModelTokens:
    def __init__(self, path: str) -> None:
        import sentencepiece
        self.tok = sentencepiece.SentencePieceProcessor(model_file=path)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.tok.encode(texts, num_threads=1)]

    def offsets(self, text: str) -> list[tuple[int, int]]:
        """The library counts bytes; these are code points."""
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        return [(int(point[p.begin]), int(point[p.end])) for p in self.tok.encode(text, return_type="proto").pieces]


@cache
def tokens(path: str) -> JsonTokens | ModelTokens:
    """One loaded tokenizer per process and file."""
    return JsonTokens(path) if path.endswith(".json") else ModelTokens(path)


def public(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)
