"""Operator 11: spelling variants grouped by composing the vocabulary with a one-edit transducer.

Words are counted over all texts. A word of the vocabulary and one of equal length, or of one
code point more, are near if one replacement, or one removal, turns one into the other. They
are found by finite-state composition: a minimal acceptor of words, a transducer that copies
and makes one edit, the acceptor again. The composed machine is enumerated from the states it
starts in: words are dealt by the length of the shorter word of a pair, the part of it where
the first difference lies, and what stands before and after that part, which two near words
share. A part is at first half of a word; where too many words meet, it is halved again, so a
task holds a bounded acceptor however alike the words are. The first difference of two words
is in one place, so each pair is accepted once. What leaves a task is one row per word, not
per pair.

A null or empty text has no words, a null id counts as no digits before the colon; repeated
rows count each for itself. Of near words that occur equally often the first by code points
is the form. An empty table, or one without words, gives no rows. Words of any length do: what
words of a part have in common at either end takes no part in the machine.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from operator import itemgetter
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from totelane.llm.common import as_bytes, entries, hot_groups, meet, record_batch, slices
from totelane.session import durable

#: Code points of the words that are looked at, the least there are to a word, and how often
#: it must occur.
LETTERS = "a-zÀ-ÿ"
SHORTEST, LEAST_OFTEN = 7, 2
#: One run in so many of a document loses a code point.
SPOILT_ONE_IN = 31
#: A form occurs so many times as often as its variant.
TIMES_AS_OFTEN = 10
#: Code points of the words of one part, unless it is a single place.
MOST_LETTERS = 200_000
_TEXT_AT_ONCE = 1 << 21
_LONG_TEXT = 1 << 24
_REMEMBERED = 200_000
_ROWS_AT_ONCE = 20_000
_COUNTS = "word string, n bigint"
_FOUND = "word string, near bigint, best_n bigint, best string"
_TEXTS = {"string": pa.string(), "bigint": pa.int64()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(name, _TEXTS[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def spoilt(word: str, salt: bytes, one_in: int) -> str:
    """``word``, or what is left of it where a checksum says so."""
    h = zlib.crc32(word.encode(), zlib.crc32(salt))
    if h % one_in:
        return word
    place = h % len(word)
    return word[:place] + word[place + 1 :]


def _counts(shortest: int, one_in: int):
    """Words of the texts, counted per task as far as memory is bounded."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, schema = re.compile(f"[{LETTERS}]{{{shortest},}}"), _schema(_COUNTS)
        counts: Counter[str] = Counter()
        letters = 0

        def done() -> Iterator[pa.RecordBatch]:
            found = list(counts)
            for start in range(0, len(found), _ROWS_AT_ONCE):
                own = found[start : start + _ROWS_AT_ONCE]
                yield record_batch({"word": own, "n": [counts[x] for x in own]}, schema)
            counts.clear()

        for batch in slices(batches, "text", _TEXT_AT_ONCE):
            doc_ids = batch.column("doc_id").to_pylist()
            for doc_id, raw in zip(doc_ids, as_bytes(batch.column("text")), strict=True):
                text = raw.lower().decode("utf-8", "replace")
                found = runs.findall(text) if len(text) < _LONG_TEXT else (
                    x.group() for x in runs.finditer(text)
                )
                salt = f"{'' if doc_id is None else doc_id}:".encode()
                for run, n in Counter(found).items():
                    word = spoilt(run, salt, one_in)
                    if len(word) >= shortest:
                        letters += len(word) if word not in counts else 0
                        counts[word] += n
            if len(counts) > _REMEMBERED or letters > 20 * _REMEMBERED:
                yield from done()
                letters = 0
        yield from done()

    return count


def vocabulary(
    docs: DataFrame,
    shortest: int = SHORTEST,
    least_often: int = LEAST_OFTEN,
    one_in: int = SPOILT_ONE_IN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word`` and ``n``, how often it occurs in all texts together."""
    rows = entries(docs, id_col, text_col).select("doc_id", "text")
    counted = rows.mapInArrow(_counts(shortest, one_in), _COUNTS)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_often)


class Acceptor:
    """A minimal deterministic acceptor of several lists of words, a start state for each.

    States with the same words ahead are one state. Words of a list are numbered as they are
    ordered: a state knows how many words it accepts, and an arc how many come before it.
    """

    def __init__(self):
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.words: list[int] = []
        self._known: dict[tuple, int] = {}

    def _state(self, final: bool, arcs: list[tuple[str, int]]) -> int:
        ahead = (final, *arcs)
        state = self._known.get(ahead)
        if state is None:
            state, accepted, own = len(self.arcs), int(final), {}
            for symbol, target in arcs:
                own[symbol] = (target, accepted)
                accepted += self.words[target]
            self._known[ahead] = state
            self.arcs.append(own)
            self.final.append(final)
            self.words.append(accepted)
        return state

    def accept(self, words: list[str]) -> int:
        """The start state of distinct ascending ``words``."""
        path: list[list] = [[False, []]]
        last = ""

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                state = self._state(*path.pop())
                path[-1][1].append((last[len(path) - 1], state))

        for word in words:
            same = len(commonprefix((last, word)))
            close(same)
            path.extend([False, []] for _ in range(len(word) - same))
            path[-1][0], last = True, word
        close(0)
        return self._state(*path[0])

    def alike(self, p: int, q: int, i: int, j: int, but: str | None = None):
        """Numbers of the words from states ``p`` and ``q`` that go on alike, not with ``but``;
        the words of the states are numbered from ``i`` and ``j``."""
        arcs, final = self.arcs, self.final
        ahead = [(p, q, i, j)]
        while ahead:
            p, q, i, j = ahead.pop()
            if p == q and but is None:
                yield from ((i + k, j + k) for k in range(self.words[p]))
                continue
            if final[p] and final[q]:
                yield i, j
            own, other = arcs[p], arcs[q]
            for symbol in own.keys() & other.keys():
                if symbol != but:
                    (a, x), (b, y) = own[symbol], other[symbol]
                    ahead.append((a, b, i + x, j + y))
            but = None

    def replaced(self, start: int, places: int) -> Iterator[tuple[int, int]]:
        """Words that differ in one symbol, which is one of the first ``places``."""
        ahead = [(start, 0, 0)]
        while ahead:
            state, i, place = ahead.pop()
            out = list(self.arcs[state].values())
            for k, (p, x) in enumerate(out):
                if place + 1 < places:
                    ahead.append((p, i + x, place + 1))
                for q, y in out[k + 1 :]:
                    if p == q or self._may_meet(p, q):
                        yield from self.alike(p, q, i + x, i + y)

    def removed(self, longer: int, shorter: int, places: int) -> Iterator[tuple[int, int]]:
        """A word from ``longer`` and one from ``shorter``, which is the former less a symbol;
        they first differ at one of the first ``places``."""
        ahead = [(longer, shorter, 0, 0, 0)]
        while ahead:
            p, q, i, j, place = ahead.pop()
            other = self.arcs[q]
            for symbol, (a, x) in self.arcs[p].items():
                # Where the shorter word went on with the symbol, they would differ later.
                if self._may_meet(a, q):
                    yield from self.alike(a, q, i + x, j, symbol)
                if place + 1 < places and symbol in other:
                    b, y = other[symbol]
                    ahead.append((a, b, i + x, j + y, place + 1))

    def _may_meet(self, p: int, q: int) -> bool:
        return (self.final[p] and self.final[q]) or not self.arcs[p].keys().isdisjoint(self.arcs[q])


def near_pairs(
    shorter: list[str], longer: list[str], places: int
) -> Iterator[tuple[tuple[bool, int], tuple[bool, int]]]:
    """Near words of one part, each given by whether it is one of ``longer`` and its number:
    two of ``shorter``, or one of either. Both are ascending and distinct."""
    machine = Acceptor()
    start = machine.accept(shorter)
    for a, b in machine.replaced(start, places):
        yield (False, a), (False, b)
    if longer:
        for a, b in machine.removed(machine.accept(longer), start, places):
            yield (True, a), (False, b)


def _without_common_ends(words: list[str], places: int) -> tuple[list[str], int]:
    """The words less what all of them begin and end with, and the places left."""
    before = len(commonprefix((min(words), max(words))))
    before = min(before, places - 1)
    turned = [x[before:][::-1] for x in words]
    after = len(commonprefix((min(turned), max(turned))))
    # Places in what is left: a symbol that is one too many may be one of the common end.
    return [x[before : max(before, len(x) - after + 1)] for x in words], places - before


def _enumerate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per word of a part: how many are near, and the best of them. Rows come by part."""
    schema = _schema(_FOUND)
    names = ("part", "places", "longer", "middle", "word", "n")
    out: dict[str, list] = {field.name: [] for field in schema}

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(name).to_pylist() for name in names), strict=True)

    for _, group in groupby(rows(), key=itemgetter(0)):
        own = list(group)
        if len(own) == 1 or own[0][2]:  # in order: words of the shorter length come first
            continue
        cut, places = _without_common_ends([x[3] for x in own], own[0][1])
        n_shorter = sum(not x[2] for x in own)
        best: dict[int, tuple[int, str]] = {}
        near: Counter[int] = Counter()
        for (long_a, a), (long_b, b) in near_pairs(cut[:n_shorter], cut[n_shorter:], places):
            a, b = a + n_shorter * long_a, b + n_shorter * long_b
            for x, y in ((a, b), (b, a)):
                near[x] += 1
                offer = (-own[y][5], own[y][4])
                if x not in best or offer < best[x]:
                    best[x] = offer
        for x, times in near.items():
            for name, value in zip(out, (own[x][4], times, -best[x][0], best[x][1]), strict=True):
                out[name].append(value)
        if len(out["word"]) >= _ROWS_AT_ONCE:
            yield record_batch(out, schema)
            out = {name: [] for name in out}
    if out["word"]:
        yield record_batch(out, schema)


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` of ``word``, ``n``, ``length`` of the shorter word, ``low`` and ``high``, the
    places from and before which the words first differ, with the ``part`` they belong to and
    the ``middle`` that stands between what the words of a part share."""
    size = F.length("word")
    after = F.greatest(F.lit(0), F.col("length") - F.col("high"))
    begin, end = F.substring("word", F.lit(1), F.col("low")), F.substring("word", size - after + 1, after)
    part = F.concat_ws(":", "length", "low", "high", begin, end)
    return rows.select(
        "word",
        "n",
        "length",
        "low",
        "high",
        part.alias("part"),
        (size > F.col("length")).alias("longer"),
        F.substring("word", F.col("low") + 1, size - after - F.col("low")).alias("middle"),
    )


def _halved(low: Column, high: Column) -> Column:
    middle = F.ceil((low + high) / 2).cast("int")
    return F.explode(F.array(F.struct(low.alias("low"), middle.alias("high")),
                             F.struct(middle.alias("low"), high.alias("high"))))


def parts(words: DataFrame, shortest: int, most_letters: int = MOST_LETTERS) -> DataFrame:
    """The words dealt to parts of a bounded size; a word is in one part per length of the
    shorter word, its own and one less, and range of places."""
    size = F.length("word")
    lengths = F.explode(F.filter(F.array(size, size - 1), lambda x: x >= shortest))
    rows = words.select("word", "n", lengths.alias("length")).withColumn(
        "between", _halved(F.lit(0), F.col("length") + 1)
    )
    rows, done = rows.select("word", "n", "length", "between.*"), []
    while True:
        rows = durable(_dealt(rows))
        sizes = rows.groupBy("part").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.length("middle")).alias("letters"),
            F.first(F.col("high") - F.col("low")).alias("places"),
        )
        large = durable(
            sizes.filter((F.col("letters") > most_letters) & (F.col("places") > 1) & (F.col("n") > 1))
            .select("part", "n")
        )
        if large.isEmpty():
            return reduce(DataFrame.unionByName, [*done, rows])
        hot = hot_groups(large, "part")
        done.append(meet(rows, large.select("part"), "part", "left_anti", hot))
        rows = meet(rows, large.select("part"), "part", "left_semi", hot).select(
            "word", "n", "length", _halved(F.col("low"), F.col("high")).alias("between")
        ).select("word", "n", "length", "between.*")


def near_words(words: DataFrame, shortest: int, most_letters: int = MOST_LETTERS) -> DataFrame:
    """``words`` (``word``, ``n``), written, with ``n_near`` and ``best``: the near word that
    occurs most, as ``best.form`` and ``best.minus_n``."""
    dealt = parts(words, shortest, most_letters).select(
        "part", (F.col("high") - F.col("low")).alias("places"), "longer", "middle", "word", "n"
    )
    found = (
        dealt.repartition("part")
        .sortWithinPartitions("part", "longer", "middle")
        .mapInArrow(_enumerate, _FOUND)
    )
    best = F.struct((-F.col("best_n")).alias("minus_n"), F.col("best").alias("form"))
    none = F.lit(None).cast("struct<minus_n:bigint,form:string>")
    return (
        words.select("word", "n", F.lit(0).cast("bigint").alias("near"), none.alias("best"))
        .unionByName(found.select("word", F.lit(None).cast("bigint").alias("n"), "near", best.alias("best")))
        .groupBy("word")
        .agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min("best").alias("best"))
    )


def roots(links: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of the chain of links from ``word`` to ``root`` given.
    Each round doubles the steps followed; forms occur ten times as often as their variants,
    so chains are as long as the digits of the largest count."""
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = durable(
            links.select("word", "root")
            .join(further, "root", "left")
            .select("word", F.coalesce("further", "root").alias("root"), "further")
        )
        if links.filter("further IS NOT NULL").isEmpty():
            return links.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    shortest: int = SHORTEST,
    least_often: int = LEAST_OFTEN,
    one_in: int = SPOILT_ONE_IN,
    times: int = TIMES_AS_OFTEN,
    most_letters: int = MOST_LETTERS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` of the whole vocabulary."""
    words = durable(vocabulary(docs, shortest, least_often, one_in, id_col, text_col))
    found = near_words(words, shortest, most_letters)
    often = -F.col("best.minus_n") >= times * F.col("n")
    variants = durable(
        found.select(
            "word",
            F.when(often, F.col("best.form")).alias("form"),
            "n",
            "n_near",
            F.when(often, -F.col("best.minus_n")).alias("form_n"),
        )
    )
    linked = durable(variants.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return variants.join(roots(linked), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
