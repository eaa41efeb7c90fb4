"""Ids of the encoder against the tokenizer itself, on every letter and mark of Unicode."""

from __future__ import annotations

import random
import unicodedata

import pytest

from tests.llm import plain
from totelane.llm import tokens

_SIGNS = [chr(code) for code in range(33, 127) if not chr(code).isalnum()]


def _same(texts: list[str], remembered: int = tokens.REMEMBERED) -> None:
    encoder = tokens.Encoder(tokens.word_bpe(), remembered)
    found = encoder.encode([x.encode() for x in texts], 2)
    for text, own, want in zip(texts, found, plain.token_ids(texts, 2), strict=True):
        assert own.tolist() == want.tolist(), ascii(text)


@pytest.mark.parametrize("kind", ["L", "M", "N"])
def test_every_letter_mark_and_digit_before_every_kind_of_sign(kind):
    chosen = [
        chr(code)
        for code in range(0x110000)
        if not 0xD800 <= code < 0xE000 and unicodedata.category(chr(code))[0] == kind
    ]
    dice = random.Random(1)
    signs = [dice.choice(_SIGNS) for _ in chosen]
    _same([f"ab{x}{s} {x}{s} J{x} A{x}{s}{s} {x}̸z{s}" for x, s in zip(chosen, signs, strict=True)])


@pytest.mark.parametrize("sign", _SIGNS)
def test_signs_after_and_in_words(sign):
    words = ["word", "Ünï", "naïve", "TAKSİ", "ŉame", "क़", "שׂ", "Σας", "ΟΔΟΣ", "x9", "ſſ", "ß", "don't"]
    _same([f"{w}{sign} {w}{sign}{sign}x {sign}{w} {w}{sign}s {w}{sign}́" for w in words])


def test_marks_meet_letters_before_these_are_put_in_lower_case():
    marks = [chr(code) for code in range(0x300, 0x370)]
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    _same([f"{a}{m} x{a}{m}. {a.lower()}{m}" for a in letters for m in marks])


def test_special_tokens_count_in_their_own_case_only():
    _same(["a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>.", "<|endoftext|>", "İ <| X", "\x01 \x01a"])


def test_remembered_chunks_stay_right_when_memory_starts_anew():
    dice = random.Random(2)
    words = ["".join(dice.choices("abcé漢'.,#", k=dice.randint(1, 6))) for _ in range(3000)]
    encoder = tokens.Encoder(tokens.word_bpe(), 200)
    for start in range(0, len(words), 100):
        text = " ".join(words[start : start + 100])
        found = encoder.encode([text.encode()], 2)[0].tolist()
        assert found == plain.token_ids([text], 2)[0].tolist()


def test_a_chunk_is_looked_up_once_for_all_places_where_it_stands():
    class Counted(dict):
        asked = 0

        def get(self, key):
            Counted.asked += 1
            return super().get(key)

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

    texts = ["word again, word " * 500, "again, " * 700, ""]
    encoder = tokens.Encoder(tokens.word_bpe())
    encoder._known = Counted()
    found = encoder.encode([x.encode() for x in texts], 2)
    assert [x.tolist() for x in found] == [x.tolist() for x in plain.token_ids(texts, 2)]
    assert Counted.asked < 20


def test_white_space_around_and_between_and_texts_without_words():
    _same(["", " ", "\t\n\x0b\x0c\r ", "  a\x0bb  c\r\n", "a\x1cb", "a\x85b　c d", "", "é ü\ta"])
    assert tokens.Encoder(tokens.word_bpe()).encode([], 2) == []


def test_bytes_that_are_no_text_count_as_replacement_characters():
    found = tokens.Encoder(tokens.word_bpe()).encode([b"ab\xe9, \xff\xfe x"], 2)[0]
    assert found.tolist() == plain.token_ids(["ab�, �� x"], 2)[0].tolist()
