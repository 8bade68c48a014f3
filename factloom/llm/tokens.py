"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

WORD_BPE = "word_bpe_49k.json"
_WORDS, _LONGEST, _SLICE = 600_000, 10, 1 << 21
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Byte-level vocabularies write the bytes that are not printable Latin-1 signs as the signs from U+0100 on.
_UNPRINTABLE = [*range(33), *range(127, 161), 173]
_BYTE_SIGNS = {b: 256 + i for i, b in enumerate(_UNPRINTABLE)}
_SIGNS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")


def tokenizer_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def encoder(path: str, by_word: bool | None = None) -> WordEncoder:
    """This worker's encoder: what it has learnt stays from task to task. Word by word only for the file that is known to
    allow it, unless by_word says otherwise."""
    return WordEncoder(path, path.rpartition("/")[2] == WORD_BPE if by_word is None else by_word)


class WordEncoder:
    """Encodes texts by the tokenizer in a file, word by word, with the very ids of encoding each whole text.

    by_word is for tokenizers like WORD_BPE, which drop white space, put runs of letters, single digits and runs of
    other signs apart, and lower the case of letters. No token, normal form or added token of these spans a space or a
    line feed, so the ids of a text are those of the pieces between these, in order. A piece of Latin-1 letters, which
    no normal form changes, is in lower case one unit of the model, and ASCII signs after it are others. All other pieces, any other white space in them, go to the
    library as they are. For any other tokenizer pass by_word=False.
    Some _WORDS words of at most _LONGEST characters are kept, then the store starts anew, so memory is bounded.
    """

    def __init__(self, path: str, by_word: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.by_word = by_word
        self.unit = self.tokenizer.model.tokenize
        self.words: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _code(self, words: set[str]) -> dict[str, bytes]:
        """The ids of words not in store; those that are not Latin letters and signs go to the library in one call."""
        found: dict[str, bytes] = {}
        rest: list[str] = []
        unit, signs, known, latin = self.unit, self.signs, self.words, _LATIN.fullmatch
        for word in words:
            plain = word.isascii()
            letters = word if plain and word.isalpha() else word.rstrip(_SIGNS)
            if (letters.isalpha() if plain else latin(letters)) and (letters is word or "<|" not in word):
                ids = known.get(letters)
                if ids is None:
                    low = letters.lower()
                    ids = array("I", [t.id for t in unit(low if plain else low.encode().decode("latin-1").translate(_BYTE_SIGNS))]).tobytes()
                if letters is not word and (tail := word[len(letters) :]):
                    if tail not in signs:
                        if len(signs) > _WORDS:
                            signs.clear()
                        signs[tail] = self._whole(tail)
                    ids += signs[tail]
                found[word] = ids
            elif word and "<|" not in word:
                rest.append(word)
            else:
                found[word] = self._whole(word)
        if rest:
            coded = self.tokenizer.encode(rest, is_pretokenized=True, add_special_tokens=False)
            counts = np.bincount(np.array(coded.word_ids, dtype=np.int64), minlength=len(rest))
            ids, ends = np.array(coded.ids, dtype="<u4").tobytes(), np.cumsum(counts) * 4
            found |= {w: ids[end - 4 * n : end] for w, end, n in zip(rest, ends.tolist(), counts.tolist(), strict=True)}
        return found

    def encode_many(self, texts: Sequence[str]) -> Iterator[bytes]:
        """Each text's ids, little-endian unsigned 32-bit."""
        if not self.by_word:
            yield from map(self._whole, texts)
            return
        at, words = 0, self.words
        while at < len(texts):
            split, size = [], 0
            while at < len(texts) and (not split or size + len(texts[at]) <= _SLICE):
                split.append(texts[at].replace("\n", " ").split(" "))
                size += len(texts[at])
                at += 1
            new = self._code(set().union(*split).difference(words))
            words |= new
            for ws in split:
                yield b"".join(map(words.__getitem__, ws))
            if len(words) > _WORDS:
                words.clear()
            else:
                for word in [w for w in new if len(w) > _LONGEST]:
                    del words[word]
