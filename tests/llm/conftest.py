from __future__ import annotations

import random

import pytest

_SYLLABLES = ("ba", "re", "mi", "to", "lu", "é", "ßa", "ño", "chi", "ther")
ITEMS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu."),
    (2, "One short item, only."),
    (3, None),
    (None, "no id but words that stand in a text somewhere here now"),
    (4, "... !"),
    (5, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
]


def _text(dice: random.Random, n: int) -> str:
    words = ("".join(dice.choices(_SYLLABLES, k=dice.randint(1, 3))) for _ in range(n))
    return dice.choice((" ", "\n", "  ")).join(words)


def rows() -> list[tuple]:
    """Documents with copies, near copies, shared passages, nulls, very long and empty texts,
    repeated ids and whole repeated rows; other columns have the names of results."""
    dice = random.Random(7)
    passage, boiler = _text(dice, 40), _text(dice, 13)
    texts: list[str | None] = [_text(dice, dice.randint(1, 120)) for _ in range(40)]
    texts += ["", None, "  \t\n", "...", "One", "Two words", passage, boiler]
    texts += [f"{_text(dice, 30)} {passage} {_text(dice, 9)}" for _ in range(6)]
    texts += [f"{_text(dice, 5)} {boiler}" for _ in range(4)]
    texts += [texts[0], texts[0].replace(" ", "\n "), f" {texts[1]}", texts[2], texts[2]]
    long = _text(dice, 9000)
    texts += [long, long, long + " more", " ".join(long.split()[::-1])]
    texts += ["x y " + ITEMS[0][1].upper() + " z", "so one SHORT item only one short item only"]
    texts += ["alpha beta gamma delta epsilon zeta eta theta iota", ITEMS[3][1]]
    texts += ["Released under the MIT License. Apache license", "mit license " * 30]
    texts += ["Prose. Licensed under CC BY-NC 4.0. More prose", "the GNU general public license"]
    texts += ["Licensed under the Unknown License.", "mit licence", "<|endoftext|> a <|ENDOFTEXT|>"]
    texts += ["word\x01mark don't, it'll!", "Ünïcode É é é … «q» 漢字 テスト 123,4"]
    texts += [_text(dice, 60) + " idiot " + _text(dice, 9) for _ in range(12)]
    texts += [texts[3]] * 25
    texts += [" ".join(["Received"] * 60 + ["receivet"] * 4 + [str(i)]) for i in range(10)]
    texts += ["recceivet, receivedd eceived"] * 3 + ["reCeaved.recieved"] * 2
    texts += ["NAÏVETÉS naÏvetÉs naïvetés", "abcdefghijk" * 300 + " " + "abcdefghijk" * 300 + "x"] * 2
    found = [(i * 3 + 1, text) for i, text in enumerate(texts)]
    found += [found[5], found[5], (found[6][0], "other text of the same id"), (None, texts[0])]
    found += [(None, "no id here at all, just words"), (None, None), (-7, texts[8])]
    dice.shuffle(found)
    return found


def pages() -> list[tuple]:
    """Pages with copies, null and empty payloads, null and repeated ids, odd addresses."""
    dice = random.Random(8)
    found = [(i, f"http://a.example/{i}", f"<p>{_text(dice, 30)}</p>") for i in range(20)]
    found += [(30 + i, None, found[3][2]) for i in range(30)] + [(1, "http://again", found[3][2])]
    found += [(70, "http://b c\r\n\tü", ""), (71, "", None), (None, "http://n", found[4][2])]
    found += [(None, None, "only nameless"), (None, "x", "only nameless"), found[5], found[5]]
    found += [(-4, "http://m", "\r\n\r\nWARC/1.1\r\n"), (80, "http://l", _text(dice, 200_000))]
    dice.shuffle(found)
    return found


def labels() -> list[tuple]:
    named = [(doc_id, text) for doc_id, text in rows() if doc_id is not None]
    return [(i, 1, int("idiot" in (x or ""))) for i, x in named] + [(None, 1, 1), (4, 0, None)]


def _about(doc_id: int | None, text: str | None) -> tuple:
    """Language, source and size of a document; some have none."""
    if doc_id is None or doc_id % 10 == 7:
        return (None, None, None)
    if doc_id in (1, 4):
        return ("", "src2", 0) if doc_id == 1 else ("ünq", "", 5)
    return ("de" if doc_id % 3 else "en", "src1", len(text or ""))


@pytest.fixture(scope="session")
def table_folder(spark, tmp_path_factory):
    """Writes the tables; without rows, empty ones."""

    def write(docs: list[tuple], marked: list[tuple], items: list[tuple], stored: list[tuple]) -> str:
        folder = str(tmp_path_factory.mktemp("tables"))
        wide = [(a, b, *_about(a, b), 1, None, "x") for a, b in docs]
        schema = (
            "doc_id long, text string, lang string, source string, n_chars long, "
            "at long, shard int, words string"
        )
        spark.createDataFrame(wide, schema).write.parquet(f"{folder}/documents.parquet")
        schema = "doc_id long, quality int, toxic int"
        spark.createDataFrame(marked, schema).write.parquet(f"{folder}/labels.parquet")
        schema = "item_id long, text string"
        spark.createDataFrame(items, schema).write.parquet(f"{folder}/benchmark.parquet")
        schema = "page_id long, url string, html string, at long, key string, n int"
        wide = [(*row, 5, "k", 1) for row in stored]
        spark.createDataFrame(wide, schema).write.parquet(f"{folder}/pages.parquet")
        return folder

    return write


@pytest.fixture(scope="session")
def folder_of_all(table_folder) -> str:
    return table_folder(rows(), labels(), ITEMS, pages())


@pytest.fixture(scope="session")
def folder_of_none(table_folder) -> str:
    return table_folder([], [], [], [])


@pytest.fixture(scope="session")
def docs() -> list[tuple]:
    """The documents with null texts as empty ones."""
    return [(doc_id, text or "") for doc_id, text in rows()]
