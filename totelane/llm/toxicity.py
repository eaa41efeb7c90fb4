"""Operator 5: toxicity by a classifier that is regularised with counterfactuals.

The model is logistic regression on the words a text contains and on their beginnings, which
inflected forms of a word share. Its vocabulary and weights come from a bounded sample of labelled rows outside the held-out fold; every text is scored
whole. Sentences of the sample that mention a group are swapped: each identity term in turn is
replaced by the next of its family, in its place in the sentence, the others stay. The squared
change of the score between both is a penalty, so the mention as such cannot carry weight. The
``NEUTRAL`` sentences about each group are added with label 0, and swapped as well, which holds
the weights where the sample lacks a term.

The score of a text depends on its words only. Null and empty texts score as a text without
known words. Rows without id count as unlabelled. Without labelled rows of both kinds the
score is the share of toxic rows, 0 if there are none.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Container, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from totelane.llm.common import as_bytes, entries, only, slices

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Labelled rows that the model is fitted on, taken by a hash of their ids.
SAMPLE_ROWS = 12_000
#: Features of the model, and the least number of toxic sampled rows that have one.
VOCABULARY, LEAST_ROWS = 2_000, 4
#: Lengths in bytes of the beginnings of words that are features as well.
BEGINNINGS = (4, 5, 6, 8)
#: Words whose features a Python worker remembers.
REMEMBERED = 100_000
#: Least z-score of the difference of a feature's share between both labels.
LEAST_Z = 4.0
#: Weights of the squared weights and of the squared score changes.
RIDGE, COUNTERFACTUAL = 0.3, 10.0
_STEPS = 400
_AT_ONCE = 1 << 21

#: Families of identity terms; a term is swapped for the next of its family.
IDENTITIES = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "atheist"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino"),
    ("immigrants", "refugees", "foreigners", "locals"),
    ("old", "young"),
    ("disabled", "deaf", "blind"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
    ("ausländer", "einheimische"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
)
#: Neutral sentences; the blank is for an identity term.
NEUTRAL = (
    "some of our neighbours are {}",
    "{} people met in the town hall on monday",
    "the article describes how {} families live here",
)
_SWAPS = {
    term.encode(): own[(i + 1) % len(own)].encode()
    for own in IDENTITIES
    for i, term in enumerate(own)
}
_STOPS = re.compile(rb"[.!?\n]+")
_BLANKED = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))


def held_out(doc_id: Column) -> Column:
    """Whether a row is in the fold that is never learned from."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == HELD_OUT


def words_of(text: bytes) -> list[bytes]:
    """Runs of letters and digits in lower case."""
    return text.decode("utf-8", "replace").lower().encode().translate(_BLANKED).split()


def features_of(word: bytes) -> list[bytes]:
    """The word, and its beginnings with a star."""
    return [word, *(word[:n] + b"*" for n in BEGINNINGS if len(word) > n)]


@dataclass(frozen=True)
class Model:
    """Weights by feature, and the score of a text without known ones as log-odds."""

    weights: dict[bytes, float]
    bias: float


class Scorer(dict):
    """Scores by a model; remembers which features each word has."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: bytes) -> tuple[bytes, ...]:
        found = self[word] = tuple(x for x in features_of(word) if x in self.model.weights)
        return found

    def scores(self, texts: list[bytes]) -> np.ndarray:
        weight, odds = self.model.weights, []
        for text in texts:
            if len(self) > REMEMBERED:
                self.clear()
            found: set[bytes] = set()
            found.update(*filter(None, map(self.__getitem__, set(words_of(text)))))
            odds.append(self.model.bias + sum(weight[x] for x in sorted(found)))
        return _sigmoid(np.array(odds, float))


def mentions(text: bytes) -> list[bytes]:
    """The sentences that hold an identity term, as words in order with blanks between."""
    sentences = (words_of(x) for x in _STOPS.split(text))
    return [b" ".join(own) for own in sentences if not _SWAPS.keys().isdisjoint(own)]


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    only("toxicity")
    for batch in slices(batches, "text", _AT_ONCE):
        texts = as_bytes(batch.column("text"))
        sets = [b" ".join(sorted(set(words_of(x)))) for x in texts]
        said = [sorted(set(mentions(x))) for x in texts]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("toxic"),
                pa.array(sets, pa.binary()),
                pa.array(said, pa.list_(pa.binary())),
            ],
            names=["toxic", "words", "mentions"],
        )


class Rows:
    """A 0/1 matrix by row: which words each text has."""

    def __init__(self, texts: list[bytes], place: dict[bytes, int]):
        known = [
            sorted({place[x] for w in own.split() for x in features_of(w) if x in place})
            for own in texts
        ]
        self.n, self.width = len(texts), len(place)
        self.row = np.repeat(np.arange(self.n), [len(x) for x in known])
        self.word = np.array([w for own in known for w in own], np.int64)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.word], self.n)

    def back(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, values[self.row], self.width)


def swapped(sentence: bytes) -> list[bytes]:
    """The sentence with one identity term at a time replaced by the next of its family."""
    words = sentence.split()
    return [
        b" ".join([*words[:i], _SWAPS[word], *words[i + 1 :]])
        for i, word in enumerate(words)
        if word in _SWAPS
    ]


def _vocabulary(texts: list[bytes], toxic: np.ndarray) -> list[bytes]:
    """Features that toxic texts have most more often, by z-score, and identity terms."""

    def counted(label: int, among: Container[bytes] | None) -> Counter:
        counts: Counter = Counter()
        for own, its in zip(texts, toxic.tolist(), strict=True):
            if its == label:
                every = {x for w in own.split() for x in features_of(w)}
                counts.update(every if among is None else filter(among.__contains__, every))
        return counts

    bad = {x: n for x, n in counted(1, None).items() if n >= LEAST_ROWS}
    clean = counted(0, bad)
    n_clean, n_bad = len(toxic) - int(toxic.sum()), int(toxic.sum())
    scored = []
    for word, n in bad.items():
        share = (n + clean[word]) / len(toxic)
        spread = math.sqrt(share * (1 - share) * (1 / n_bad + 1 / n_clean)) + 1e-9
        z = (n / n_bad - clean[word] / n_clean) / spread
        if z >= LEAST_Z:
            scored.append((-z, word))
    return sorted({*(word for _, word in sorted(scored)[:VOCABULARY]), *_SWAPS})


def _sigmoid(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit(texts: list[bytes], toxic: np.ndarray, said: Sequence[bytes] = ()) -> Model:
    """A model from word sets (words with blanks between), labels and the sentences of the
    texts that mention a group.

    The loss is logistic with a ridge and the counterfactual penalty; steps are as long as
    the largest curvature of the loss allows, with momentum.
    """
    if len(set(toxic.tolist())) < 2:
        share = float(toxic.mean()) if len(toxic) else 0.0
        return Model({}, 500.0 if share == 1 else -500.0)
    vocabulary = _vocabulary(texts, toxic)
    place = {w: i for i, w in enumerate(vocabulary)}
    neutral = [x.format(term.decode()).encode() for x in NEUTRAL for term in sorted(_SWAPS)]
    every = [*texts, *neutral]
    label = np.concatenate([toxic, np.zeros(len(neutral))])
    rows = Rows(every, place)
    pairs = [(x, y) for x in sorted({*said, *neutral}) for y in swapped(x)]
    own, other = Rows([x for x, _ in pairs], place), Rows([y for _, y in pairs], place)

    def curvature(weights: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
        """An upper bound of the second derivative, times a direction."""
        odds = (rows.times(weights) + bias) / 4
        apart = COUNTERFACTUAL / 4 * (own.times(weights) - other.times(weights))
        bent = rows.back(odds) + RIDGE * weights + own.back(apart) - other.back(apart)
        return bent / scale, float(odds.sum()) / len(every)

    # Steps are measured by how often a word occurs.
    scale = np.maximum(rows.back(np.ones(rows.n)), 1.0)
    way, bias_way, most = np.ones(len(vocabulary)), 1.0, 1.0
    for _ in range(30):
        way, bias_way = curvature(way, bias_way)
        most = math.sqrt(float((way**2 * scale).sum()) + bias_way**2 * len(every))
        way, bias_way = way / most, bias_way / most
    step = 0.9 / most

    mean = float(label.mean())
    weights, bias = np.zeros(len(vocabulary)), math.log(mean / (1 - mean))
    last, last_bias = weights, bias
    for turn in range(_STEPS):
        ahead = turn / (turn + 3)
        at, at_bias = weights + ahead * (weights - last), bias + ahead * (bias - last_bias)
        off = _sigmoid(rows.times(at) + at_bias) - label
        a, b = _sigmoid(own.times(at) + at_bias), _sigmoid(other.times(at) + at_bias)
        change = 2 * COUNTERFACTUAL * (a - b)
        slope = rows.back(off) + RIDGE * at
        slope += own.back(change * a * (1 - a)) - other.back(change * b * (1 - b))
        last, last_bias = weights, bias
        weights = at - step * slope / scale
        bias = at_bias - step * float(off.sum()) / len(every)
    return Model(dict(zip(vocabulary, weights.tolist(), strict=True)), bias)


def train(rows: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS) -> Model:
    """A model from labelled entries outside the held-out fold. What comes to the driver are
    the distinct words of ``sample`` documents at most, and their sentences about groups."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .filter(~held_out(F.col("doc_id")))
    )
    # The labels are sampled first, so texts of other rows never move.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = (
        rows.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
        .select("toxic", "text")
    )
    found = texts.mapInArrow(_samples, "toxic int, words binary, mentions array<binary>")
    found = found.toArrow().to_pydict()
    pairs = sorted(set(zip(found["toxic"], found["words"], strict=True)))  # copies count once
    said = sorted({x for own in found["mentions"] for x in own})
    return fit([words for _, words in pairs], np.array([label for label, _ in pairs], int), said)


def _scorer(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("toxicity")
        scorer = Scorer(model)
        for batch in slices(batches, "text", _AT_ONCE):
            found = scorer.scores(as_bytes(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("at"), batch.column("doc_id"), pa.array(found)],
                names=["at", "doc_id", "score"],
            )

    return score


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``at``, ``doc_id``, ``held_out``, ``score`` and ``predicted`` of each document."""
    rows = entries(docs, id_col, text_col)
    model = train(rows, labels)
    scored = rows.mapInArrow(_scorer(model), "at bigint, doc_id bigint, score double")
    return scored.select(
        "at",
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def clean_rows(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that score under the threshold, with all their columns."""
    model = train(entries(docs, id_col, text_col), labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("toxicity")
        scorer = Scorer(model)
        for batch in slices(batches, text_col, _AT_ONCE):
            texts = [x or b"" for x in as_bytes(batch.column(text_col))]
            yield batch.filter(pa.array(scorer.scores(texts) < threshold))

    return docs.mapInArrow(keep, docs.schema)
