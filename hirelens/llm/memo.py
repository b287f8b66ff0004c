"""Public tokenizers applied word by word with a bounded memo.

Neither vocabulary used here has a token that reaches over ASCII white space,
so the ids of a text are those of its words (split at ASCII white space) one
after another. A worker process keeps the ids of the words that it has met;
the memo is emptied when it holds ``max_words``, which bounds its memory.
"""

from __future__ import annotations

import os

import numpy as np

#: about 150 MB a worker
MAX_WORDS = 900_000


class WordMemo:
    """ids(texts): for each text (bytes) its ids as little-endian uint16."""

    def __init__(self, encode_words, alike=lambda text: text, max_words: int = MAX_WORDS):
        """``alike``: makes texts of equal ids more alike, if it can."""
        self.known: dict[bytes, bytes] = {}
        self.encode_words, self.alike, self.max_words = encode_words, alike, max_words

    def ids(self, texts: list[bytes]) -> list[bytes]:
        parts = [self.alike(t).split() for t in texts]  # bytes split at ASCII white space only
        known = self.known
        new = list(set().union(*parts).difference(known))
        if new:
            if len(known) + len(new) > self.max_words:
                known = self.known = {}
                new = list(set().union(*parts))
            known.update(zip(new, self.encode_words([w.decode("utf-8", "replace") for w in new]), strict=True))
        return [b"".join(map(known.__getitem__, p)) for p in parts]


_LOADED: dict[tuple, WordMemo] = {}


def _alone(key: tuple) -> None:
    """Empty the memos of other tokenizers: a worker holds one at a time."""
    for other, held in _LOADED.items():
        if other != key:
            (held[0] if isinstance(held, tuple) else held).known.clear()


#: words encoded together
_TOGETHER = 128


def _lower(text: bytes) -> bytes:
    """A-Z lowered ahead of a normaliser that composes and then lowers; left
    alone where that could tell: before combining marks (U+0300 to U+036F) and
    in texts that could hold a special token."""
    return text if b"\xcc" in text or b"\xcd" in text or b"<|" in text else text.lower()


def tokenizer(path: str) -> WordMemo:
    """Ids by the tokenizers library, without special tokens of its own.
    Only for a vocabulary whose normaliser drops white space, with at most
    65,536 ids."""
    _alone(("t", path))
    if ("t", path) not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        if t.get_vocab_size() > 65536:
            raise ValueError("ids over 65535 don't fit")
        encode = getattr(t, "encode_batch_fast", t.encode_batch)
        # a special token cuts a text where it stands, so it can part words that are encoded together
        added = {x.content: i for i, x in t.get_added_tokens_decoder().items()}
        mark, mark_id = min(added.items(), default=("", -1))

        def together(found: list[str]) -> list[bytes]:
            out = []
            for e in encode([mark.join(found[at : at + _TOGETHER]) for at in range(0, len(found), _TOGETHER)], add_special_tokens=False):
                ids = np.array(e.ids, "<u2")
                cuts, raw = np.flatnonzero(ids == mark_id).tolist(), ids.tobytes()
                out += [raw[2 * a : 2 * b] for a, b in zip([0, *(c + 1 for c in cuts)], [*cuts, len(ids)])]
            return out

        def encode_words(found: list[str]) -> list[bytes]:
            if mark and not any(mark in w for w in found):
                return together(found)
            return [np.array(e.ids, "<u2").tobytes() for e in encode(found, add_special_tokens=False)]

        lowers = t.normalizer is not None and t.normalizer.normalize_str("AZ") == "az" and all("<|" in x for x in added)
        _LOADED["t", path] = WordMemo(encode_words, _lower if lowers else lambda text: text)
    return _LOADED["t", path]


def pieces(path: str) -> tuple[WordMemo, np.ndarray]:
    """Ids by the sentencepiece library, each word with its leading space
    mark; and which ids stand for single bytes."""
    _alone(("p", path))
    if ("p", path) not in _LOADED:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)

        def encode_words(found: list[str]) -> list[bytes]:
            return [np.array(x, "<u2").tobytes() for x in sp.encode(found, num_threads=1)]

        _LOADED["p", path] = (WordMemo(encode_words, max_words=MAX_WORDS // 2), np.array([sp.is_byte(i) for i in range(sp.get_piece_size())]))
    return _LOADED["p", path]
