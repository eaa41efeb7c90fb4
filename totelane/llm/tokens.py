"""Token ids of whole texts by a public tokenizer.

The vocabulary drops white space and case and encodes what stands between blanks piece by
piece, so the ids of a text are those of its chunks. Each distinct chunk is encoded once and
remembered up to a bound; punctuation after a word of plain letters is a piece of its own, so
a word and the same word before a comma are encoded once. Such words end with one token that
marks the end of a word, which tells where the ids of the next word start. Chunks with other
letters, marks or digits are encoded whole.

Texts are cut into chunks, and the ids of these put together again, by Arrow: Python looks up
each distinct chunk of a call once, not each place where it stands.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from totelane.llm.common import hold, only

#: Encoded chunks that a Python worker remembers; half of them are kept when it starts anew.
REMEMBERED = 400_000
_AT_ONCE, _WORDS_AT_ONCE = 500, 5000
_MARK = "\x01"
_PUNCTUATION = bytes(code for code in range(33, 127) if not chr(code).isalnum())
#: Letters that stay one letter in lower case and when composed, so that what follows a word of
#: them is a piece of its own: Latin, less the dotted capital I and the n after an apostrophe.
_PLAIN = re.compile("[a-zA-ZÀ-ÖØ-öø-ÿĀ-įıĲ-ňŊ-ſ]+")
#: First bytes of marks that change the letter before them: whether it is in lower case decides
#: with which of them it makes one letter.
_MARKS = (b"\xcc", b"\xcd")


def word_bpe() -> str:
    """Path of the 49k word vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _is_plain(word: bytes) -> bool:
    try:
        return _PLAIN.fullmatch(word.decode()) is not None
    except UnicodeDecodeError:
        return False


def _lowered(text: bytes) -> bytes:
    """The text in lower case where that gives the same ids: special tokens are told by their
    case, and marks are composed with a letter before it is put in lower case."""
    if b"<|" in text or any(mark in text for mark in _MARKS):
        return text
    return text.lower()


class Encoder:
    """Ids of texts as little-endian arrays of the narrowest fitting type."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self._remembered = remembered
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        #: The same model for words of plain lower-case letters with a blank between; those of
        #: A-Z alone are their own bytes.
        blanks = pre_tokenizers.CharDelimiterSplit(" ")
        in_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self._lean = Tokenizer(self._tokenizer.model)
        self._lean.pre_tokenizer = pre_tokenizers.Sequence([blanks, in_bytes])
        self._leanest = Tokenizer(self._tokenizer.model)
        self._leanest.pre_tokenizer = blanks
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u4" if max(vocabulary.values()) >> 16 else "<u2")
        self._ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        mark = self._ids([_MARK])[0]
        self._mark = mark[0] if len(mark) == 1 else None
        self._known: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [x.ids for x in found]

    def _parts(self, found: list[int], cuts, n: int) -> list[bytes] | None:
        """The ids of ``n`` chunks encoded as one text; ``cuts`` gives the end of the ids of
        each and the start of the next. None where their number is not that of the chunks."""
        ids = np.array(found, self.dtype)
        ends, starts = cuts(ids)
        if len(ends) != n:
            return None
        data, size = ids.tobytes(), self.dtype.itemsize
        return [data[a:b] for a, b in zip((starts * size).tolist(), (ends * size).tolist(), strict=True)]

    def _at_word_ends(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = np.flatnonzero(self._ends_word[ids]) + 1
        return ends, np.append(0, ends[:-1])

    def _at_marks(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        marks = np.flatnonzero(ids == self._mark)
        return np.append(marks, len(ids)), np.append(0, marks + 1)

    def _learn_words(self, words: list[bytes]) -> None:
        """Encode words of plain letters, which end with a token that only ends words."""
        for start in range(0, len(words), _WORDS_AT_ONCE):
            own = words[start : start + _WORDS_AT_ONCE]
            text = b" ".join(own).decode().lower()
            lean = self._leanest if text.isascii() else self._lean
            found = lean.encode_batch_fast([text], add_special_tokens=False)[0].ids
            parts = self._parts(found, self._at_word_ends, len(own))
            if parts is None:
                self._learn_chunks(own)
            else:
                self._known.update(zip(own, parts, strict=True))

    def _learn_chunks(self, chunks: list[bytes]) -> None:
        """Encode chunks, many at a time; one by one where they cannot be told apart."""
        for start in range(0, len(chunks), _AT_ONCE):
            own, parts = chunks[start : start + _AT_ONCE], None
            if self._mark is not None:
                text = f" {_MARK} ".encode().join(own).decode("utf-8", "replace")
                parts = self._parts(self._ids([text])[0], self._at_marks, len(own))
            if parts is None:
                found = self._ids([x.decode("utf-8", "replace") for x in own])
                parts = [np.array(ids, self.dtype).tobytes() for ids in found]
            self._known.update(zip(own, parts, strict=True))

    def _learn_all(self, chunks: list[bytes]) -> None:
        """Words of plain letters, with or without punctuation after them, by their letters;
        whatever else as it is."""
        known = self._known
        words = [x.rstrip(_PUNCTUATION) for x in chunks]
        plain = [x.isalpha() or (not x.isascii() and _is_plain(x)) for x in words]
        others = {x for x, ok in zip(chunks, plain, strict=True) if not ok}
        ended = [
            (chunk, word, chunk[len(word) :])
            for chunk, word, ok in zip(chunks, words, plain, strict=True)
            if ok and len(word) < len(chunk)
        ]
        others.update(after for _, _, after in ended)
        letters = {x for x, ok in zip(words, plain, strict=True) if ok and x not in known}
        self._learn_words([x for x in letters if x.isascii()])
        self._learn_words([x for x in letters if not x.isascii()])
        self._learn_chunks([x for x in others if x not in known])
        known.update([(chunk, known[word] + known[after]) for chunk, word, after in ended])

    def _look_up(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of distinct chunks; those not known are learned."""
        if len(self._known) > self._remembered // 2:
            self._known, self._older = {}, self._known
        known, older = self._known, self._older
        found = list(map(known.get, chunks))
        missing = [i for i, ids in enumerate(found) if ids is None]
        new = []
        for i in missing:
            ids = found[i] = older.get(chunks[i])
            if ids is None:
                new.append(i)
            else:
                known[chunks[i]] = ids
        self._learn_all([chunks[i] for i in new])
        for i in new:
            found[i] = known[chunks[i]]
        return found

    def encode(self, texts: list[bytes], end: int) -> list[np.ndarray]:
        """The ids of each text with ``end`` after them."""
        lowered = pa.array([_lowered(text) for text in texts], pa.large_binary())
        split = pc.ascii_split_whitespace(lowered.view(pa.large_string()))
        chunks = split.values.dictionary_encode()
        distinct = chunks.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False)
        parts = pa.array(self._look_up(distinct.tolist()), pa.large_binary())
        _, places, data = parts.take(chunks.indices).buffers()
        ends = np.frombuffer(places, np.int64)[split.offsets].tolist()
        ids, last = data.to_pybytes() if data else b"", np.array([end], self.dtype).tobytes()
        return [np.frombuffer(ids[a:b] + last, self.dtype) for a, b in pairwise(ends)]


@lru_cache(maxsize=2)
def _encoder(path: str, remembered: int) -> Encoder:
    return Encoder(path, remembered)


def encoder(path: str, remembered: int = REMEMBERED) -> Encoder:
    """One encoder per Python worker, vocabulary and number of chunks to remember, until the
    worker runs a task of another operator."""
    only("tokens")
    hold("tokens", _encoder.cache_clear)
    return _encoder(path, remembered)
