"""Token ids of a public tokenizer, with a cache of word pieces per Python worker."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from marquee.llm.batches import flat_words

#: Words of these characters are their own normal form, so their pieces follow from the
#: pattern alone; any other word goes through the whole tokenizer.
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
PIECES = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+"
)
CACHED = 400_000


def default_tokenizer() -> str:
    """Path of the word-end BPE among the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """Byte-level letters: printable bytes stand for themselves, the others follow on
    from code point 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Encoder:
    """Ids of texts as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    White space never gets into a token of this kind of tokenizer, so a text's ids are
    those of its words, and each different word is encoded once. ``memory`` is a dict
    that lives as long as the worker; it is emptied when it is full, which changes the
    time only.
    """

    def __init__(self, tokenizer_json: str, memory: dict):
        if "tokenizer" not in memory:
            from tokenizers import Tokenizer

            memory["tokenizer"] = Tokenizer.from_str(tokenizer_json)
            memory["letters"] = byte_letters()
            memory["pieces"] = {}
        self.memory = memory
        self.tokenizer = memory["tokenizer"]
        self.model = self.tokenizer.model
        self.letters = memory["letters"]
        self.pieces = memory["pieces"]

    def _piece(self, piece: str) -> bytes:
        spelled = piece
        if not piece.isascii():
            spelled = "".join(map(self.letters.__getitem__, piece.encode()))
        known = np.array([t.id for t in self.model.tokenize(spelled)], "<u4").tobytes()
        if len(self.pieces) >= CACHED:
            self.pieces.clear()
        self.pieces[piece] = known
        return known

    def word(self, word: str) -> bytes:
        """Ids of a word, four bytes each."""
        low = word.lower()
        found = self.pieces.get(low)
        if found is not None:
            return found
        if PLAIN.fullmatch(word) and "<|" not in word:
            parts = PIECES.findall(low)
            return b"".join([self.pieces.get(p) or self._piece(p) for p in parts])
        ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and where each text begins and ends."""
        words, counts = flat_words(texts)
        coded = words.dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        by_word = list(map(self.word, coded.dictionary.to_numpy(zero_copy_only=False)))
        size = np.fromiter(map(len, by_word), np.int32, len(by_word)) // 4
        flat = np.frombuffer(b"".join(by_word), "<u4")
        begins = np.cumsum(size) - size
        n = size[index]
        ends = np.cumsum(n)
        take = np.repeat(begins[index] - (ends - n), n)
        take += np.arange(len(take))
        ids = flat[take]
        last = np.concatenate([[0], np.cumsum(counts)])
        bounds = np.concatenate([[0], ends])[last]
        return ids, bounds
