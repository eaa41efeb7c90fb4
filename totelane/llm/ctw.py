"""Operator 8: language-model scores by context-tree weighting over bytes.

A text is its words in lower-case ASCII letters, one blank between, and an end byte; before
it stand as many end bytes as the tree is deep. A byte is eight binary decisions, each at a
node given by the bits before it; per node there is a tree of contexts, the last 0 to
``DEPTH`` bytes. A context's Krichevsky-Trofimov estimate and the product of its longer
contexts are weighted one half each. What a trained tree predicts is then a mixture of the
estimates on the path of the context; contexts not seen in training have the estimate one half.
Beside the log-probability of a text stand its bytes, the end included, and the bits per byte
that a code of that length takes.

All counts come from the counts of byte strings of ``DEPTH + 1``. Blocks of documents send
the strings they hold with their training counts; these are summed per string, the trees are
weighted per pair of last context bytes, the top of the trees, 65,280 nodes at most, on the
driver, and each block gets the log-probabilities of its strings. Word counts for the base
score go the same way, by 64-bit hash of the word. No part grows with the corpus in one
task, and nothing but the top of the trees is broadcast.

A null text counts as empty: its score is that of the end. Rows without id are for training
if the checksum of the empty text says so. Without training rows every bit has probability
one half. Empty tables give empty results.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from totelane.llm.blocks import (
    Table,
    asked,
    block_rows,
    bucket_of,
    buckets_for,
    by_bucket,
    packed,
    packed_keys,
    rows_of,
    unpacked,
    unpacked_keys,
)
from totelane.llm.common import as_bytes, byte_lengths, entries
from totelane.llm.words import WordHashes, mixed
from totelane.session import durable

#: Longest context in bytes; strings of one more must fit 64 bits with a node number.
DEPTH = 5
FOLDS, HELD_OUT = 5, 1
_TOP = 2
_END = b"\n"
_WORDS, _STRINGS = 0, 1
_ASKED = "kind int, bucket int, block bigint, keys binary, counts binary"
_ANSWERED = "kind int, bucket int, block bigint, keys binary, counts binary"
_SCORED = (
    "at bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, "
    "train_tokens bigint, base_score double, score double, n_bytes bigint, bits_per_byte double"
)
_known = WordHashes()
_U8 = np.uint64(8)
_PART_BYTES = 1 << 20


def held_out(doc_id: int | None, folds: int = FOLDS, fold: int = HELD_OUT) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == fold


def _parts(table: pa.Table) -> list[pa.Table]:
    """The rows in parts of ``_PART_BYTES`` of text; strings of a part are held at once."""
    ends = np.cumsum(np.concatenate([byte_lengths(x) for x in table["text"].chunks]))
    parts, start, before = [], 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, before + _PART_BYTES, side="right")))
        parts.append(table.slice(start, stop - start))
        start, before = stop, int(ends[stop - 1])
    return parts


class Block:
    """Texts of a part of a block as words and as one run of bytes with ends between them."""

    def __init__(self, table: pa.Table, depth: int):
        self.at, self.doc_ids = table["at"].to_numpy(), table["doc_id"].to_pylist()
        self.held = np.array([held_out(x) for x in self.doc_ids], bool)
        joined, hashed = [], []
        for text in as_bytes(table["text"]):
            words = text.lower().split()
            joined.append(b" ".join(words) + _END)
            hashed.append(_known.of([*words, _END]))
        self.n = len(joined)
        numbers = np.arange(self.n, dtype=np.int32)
        #: Hash and document of each word and of the end after them.
        self.words = np.concatenate(hashed)
        self.word_doc = np.repeat(numbers, [len(x) for x in hashed])
        del hashed
        self._depth, self._lengths = depth, [len(x) for x in joined]
        gap = _END * (depth - 1)
        self._data = np.frombuffer(_END * depth + gap.join(joined) + gap, np.uint8)

    def strings(self) -> tuple[np.ndarray, np.ndarray]:
        """The string that ends with each byte of each text, and its document."""
        depth, data = self._depth, self._data
        strings = np.zeros(len(data) - depth, np.uint64)
        for i in range(depth + 1):
            strings <<= _U8
            strings |= data[i : i + len(strings)]
        # Texts and the gaps after them by turns.
        sizes = np.full(2 * self.n, depth - 1)
        sizes[::2] = self._lengths
        inside = np.repeat(np.arange(2 * self.n, dtype=np.int32) % 2 == 0, sizes)
        return strings[inside], np.repeat(np.arange(self.n, dtype=np.int32), self._lengths)


def _counted(keys: np.ndarray, held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and how often each occurs in training."""
    trained = np.sort(keys[~held])
    first = np.flatnonzero(np.append(True, trained[1:] != trained[:-1])) if len(trained) else []
    own = trained[first] if len(trained) else trained
    times = np.diff(np.append(first, len(trained))) if len(trained) else np.zeros(0, np.int64)
    extra = np.setdiff1d(np.unique(keys[held]), own, assume_unique=True)
    every = np.concatenate([own, extra])
    order = np.argsort(every, kind="stable")
    return every[order], np.concatenate([times, np.zeros(len(extra), np.int64)])[order]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys of parts and the sums of their counts."""
    keys, place = np.unique(np.concatenate([keys for keys, _ in parts]), return_inverse=True)
    times = np.zeros(len(keys), np.int64)
    np.add.at(times, place, np.concatenate([times for _, times in parts]))
    return keys, times


def _ask(buckets: int, depth: int):
    def ask(number: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        found: tuple[list, list] = ([], [])
        for part in _parts(table):
            block = Block(part, depth)
            found[_WORDS].append(_counted(block.words, block.held[block.word_doc]))
            strings, docs = block.strings()
            found[_STRINGS].append(_counted(strings, block.held[docs]))
        for kind in (_WORDS, _STRINGS):
            keys, times = _merged(found[kind])
            hashed = keys if kind == _WORDS else mixed(keys)
            dealt = bucket_of(hashed, buckets)
            order = np.argsort(dealt, kind="stable")
            keys, times, dealt = keys[order], times[order], dealt[order]
            cuts = list(by_bucket(dealt))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([kind] * len(cuts), pa.int32()),
                    pa.array([bucket for bucket, _ in cuts], pa.int32()),
                    pa.array([number] * len(cuts), pa.int64()),
                    pa.array([packed_keys(keys[own]) for _, own in cuts], pa.binary()),
                    pa.array([packed(times[own]) for _, own in cuts], pa.binary()),
                ],
                names=["kind", "bucket", "block", "keys", "counts"],
            )

    return ask


def _summed(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """What each block sent, the distinct keys, their places, their sums."""
    sent = [unpacked_keys(x) for x in table["keys"].to_pylist()]
    times = [unpacked(x, "<i8") for x in table["counts"].to_pylist()]
    keys, place = np.unique(np.concatenate(sent), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, place, np.concatenate(times))
    return sent, keys, place, sums


def _answer(kind: int, table: pa.Table, sent, values: np.ndarray) -> pa.Table:
    """The values of the keys of each block, in the order they were sent. Words are not sent
    back: a block has its own in that order at little cost."""
    ends = np.cumsum([len(x) for x in sent])
    return pa.table(
        {
            "kind": pa.array([kind] * len(sent), pa.int32()),
            "bucket": table["bucket"],
            "block": table["block"],
            "keys": table["keys"] if kind == _STRINGS else pa.array([b""] * len(sent)),
            "counts": pa.array(
                [packed(values[e - len(x) : e]) for x, e in zip(sent, ends, strict=True)],
                pa.binary(),
            ),
        }
    )


def _word_counts(table: pa.Table) -> pa.Table:
    """Counts to each block; beside them, on the first row, tokens and distinct ones."""
    sent, _, place, sums = _summed(table)
    out = _answer(_WORDS, table, sent, sums[place].astype("<f8"))
    rest = [0] * (len(sent) - 1)
    return out.append_column("tokens", pa.array([int(sums.sum()), *rest])).append_column(
        "distinct", pa.array([int((sums > 0).sum()), *rest])
    )


def _string_counts(table: pa.Table) -> pa.Table:
    _, keys, _, sums = _summed(table)
    return pa.table({"string": pa.array(keys.view(np.int64)), "n": pa.array(sums)})


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """For positive numbers: Stirling's series, eight steps up."""
    low = np.zeros_like(x)
    for i in range(8):
        low += np.log(x + i)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - low


def _estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log-probability of as many bits by Krichevsky and Trofimov."""
    zeros, ones = zeros.astype(np.float64), ones.astype(np.float64)
    return (
        _log_gamma(zeros + 0.5)
        + _log_gamma(ones + 0.5)
        - _log_gamma(zeros + ones + 1.0)
        - math.log(math.pi)
    )


def _nodes(byte: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Node and bit of each of the eight decisions of a byte, the high bit first."""
    for bit in range(7, -1, -1):
        before = (byte >> np.uint64(bit + 1)) | np.uint64(1 << (7 - bit))
        yield before, (byte >> np.uint64(bit)) & np.uint64(1)


class Level:
    """Nodes with contexts of one length: counts, weighted probability, share of own estimate.

    A key is context and node; contexts are packed with the last byte lowest.
    """

    def __init__(self, keys, zeros, ones, longer: np.ndarray | None):
        self.keys, self.zeros, self.ones = keys, zeros, ones
        own = _estimate(zeros, ones)
        if longer is None:
            self.weighted, self.share = own, np.ones(len(own))
        else:
            self.weighted = np.logaddexp(own, longer) - math.log(2)
            self.share = np.exp(own - math.log(2) - self.weighted)

    def shorter(self, length: int) -> Level:
        """The level of contexts with one byte less, ``length`` bytes."""
        context = (self.keys >> _U8) & np.uint64((1 << 8 * length) - 1)
        keys, place = np.unique((context << _U8) | (self.keys & np.uint64(255)), return_inverse=True)
        zeros, ones = (np.bincount(place, x, len(keys)) for x in (self.zeros, self.ones))
        return Level(keys, zeros, ones, np.bincount(place, self.weighted, len(keys)))


def _levels(strings: np.ndarray, times: np.ndarray, depth: int) -> list[Level]:
    """From the top (contexts of ``_TOP`` bytes) to ``depth``, of strings seen in training."""
    seen = times > 0
    strings, times = strings[seen], times[seen]
    byte, context = strings & np.uint64(255), strings >> _U8
    keys, ones, weights = [], [], []
    for node, bit in _nodes(byte):
        keys.append((context << _U8) | node)
        ones.append(bit * times.astype(np.uint64))
        weights.append(times)
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, np.concatenate(weights), len(every))
    of_ones = np.bincount(place, np.concatenate(ones), len(every))
    levels = [Level(every, total - of_ones, of_ones, None)]
    for length in range(depth - 1, _TOP - 1, -1):
        levels.insert(0, levels[0].shorter(length))
    return levels


def _sums(place: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    return pa.array(np.bincount(place, values, n).astype(np.float64))


def _tops(depth: int):
    """What the last context byte's nodes get from the levels below, added up over pairs."""

    def run(table: pa.Table) -> pa.Table:
        strings, times = table["string"].to_numpy().view(np.uint64), table["n"].to_numpy()
        pair = _levels(strings, times, depth)[0]
        context = (pair.keys >> _U8) & np.uint64(255)
        keys, place = np.unique(
            (context << _U8) | (pair.keys & np.uint64(255)), return_inverse=True
        )
        return pa.table(
            {
                "last": pa.array((keys >> _U8).astype(np.int32)),
                "node": pa.array((keys & np.uint64(255)).astype(np.int32)),
                "zeros": _sums(place, pair.zeros, len(keys)),
                "ones": _sums(place, pair.ones, len(keys)),
                "longer": _sums(place, pair.weighted, len(keys)),
            }
        )

    return run


class Top:
    """The nodes with contexts of no byte and of one, as arrays by last byte and node."""

    def __init__(self, rows: list):
        zeros, ones, longer = (np.zeros((256, 256)) for _ in range(3))
        for row in rows:
            at = row["last"], row["node"]
            zeros[at], ones[at], longer[at] = row["zeros"], row["ones"], row["longer"]
        shape = (256, 256)
        one = Level(None, zeros.ravel(), ones.ravel(), longer.ravel())
        self.zeros, self.ones, self.share = zeros, ones, one.share.reshape(shape)
        weighted = np.where(zeros + ones > 0, one.weighted.reshape(shape), 0.0)
        root = Level(None, zeros.sum(0), ones.sum(0), weighted.sum(0))
        self.root_zeros, self.root_ones, self.root_share = root.zeros, root.ones, root.share


def _mixed(longer, share, zeros, ones, bit):
    """What a context predicts: its own estimate and what the longer context predicts."""
    own = (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1.0)
    return share * own + (1 - share) * longer


def _predict(strings: np.ndarray, levels: list[Level], depth: int, top: Top) -> np.ndarray:
    """log10 of the probability of the last byte of each string."""
    total = np.zeros(len(strings))
    byte, context = strings & np.uint64(255), strings >> _U8
    last = (context & np.uint64(255)).astype(np.int64)
    tables = [Table(level.keys) for level in levels]
    for node, bit in _nodes(byte):
        # A context that training has not seen predicts one half, and so do all longer ones.
        value = np.full(len(strings), 0.5)
        for length in range(depth, _TOP - 1, -1):
            level, table = levels[length - _TOP], tables[length - _TOP]
            if not len(level.keys):
                continue
            own = context & np.uint64((1 << 8 * length) - 1)
            place = table.places((own << _U8) | node)
            zeros, ones, share = level.zeros[place], level.ones[place], level.share[place]
            value = np.where(place >= 0, _mixed(value, share, zeros, ones, bit), 0.5)
        at = last, node.astype(np.int64)
        value = _mixed(value, top.share[at], top.zeros[at], top.ones[at], bit)
        at = at[1]
        value = _mixed(value, top.root_share[at], top.root_zeros[at], top.root_ones[at], bit)
        total += np.log10(value)
    return total


def _logs(depth: int, top: Top, buckets: int):
    def run(table: pa.Table) -> pa.Table:
        strings, times = table["string"].to_numpy().view(np.uint64), table["n"].to_numpy()
        logs = _predict(strings, _levels(strings, times, depth), depth, top)
        dealt = pa.array(bucket_of(mixed(strings), buckets))
        return pa.table({"bucket": dealt, "string": table["string"], "log": pa.array(logs)})

    return run


def _string_answers(left: pa.Table, right: pa.Table) -> pa.Table:
    sent = [unpacked_keys(x) for x in left["keys"].to_pylist()]
    logs = right["log"].to_numpy()
    places = Table(right["string"].to_numpy().view(np.uint64)).places(np.concatenate(sent))
    return _answer(_STRINGS, left, sent, logs[places].astype("<f4"))


def _score(depth: int, tokens: int, distinct: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("bucket")
        values = {}
        for kind, dtype in ((_WORDS, "<f8"), (_STRINGS, "<f4")):
            own = right.filter(pa.compute.equal(right["kind"], kind))
            values[kind] = np.concatenate([unpacked(x, dtype) for x in own["counts"].to_pylist()])
        strings = Table(np.concatenate([unpacked_keys(x) for x in own["keys"].to_pylist()]))
        scored = []
        blocks = [Block(x, depth) for blob in left["rows"].to_pylist() for x in _parts(rows_of(blob))]
        # The words of the whole block are what was asked about.
        place = np.unique(np.concatenate([x.words for x in blocks]), return_inverse=True)[1]
        ends = np.cumsum([len(x.words) for x in blocks])
        for block, end in zip(blocks, ends, strict=True):
            n, doc = block.n, block.word_doc
            times = values[_WORDS][place[end - len(block.words) : end]]
            base = np.log10((times + 0.5) / (tokens + 0.5 * (distinct + 1)))
            own, string_doc = block.strings()
            logs = values[_STRINGS][strings.places(own)]
            score = np.bincount(string_doc, logs, n)
            n_bytes = np.bincount(string_doc, minlength=n)
            columns = [
                pa.array(block.at),
                pa.array(block.doc_ids, pa.int64()),
                pa.array(block.held),
                pa.array(np.bincount(doc, minlength=n)),
                pa.array(np.bincount(doc, times > 0, n).astype(np.int64)),
                pa.array(np.full(n, tokens)),
                pa.array(np.bincount(doc, base, n)),
                pa.array(score),
                pa.array(n_bytes),
                pa.array(-score / math.log10(2) / n_bytes),
            ]
            names = [x.split()[0] for x in _SCORED.split(", ")]
            scored.append(pa.table(dict(zip(names, columns, strict=True))))
        return pa.concat_tables(scored)

    return run


def scores(
    docs: DataFrame, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``at``, ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score`` (log10), ``n_bytes`` and ``bits_per_byte`` of each document.
    Logarithms of single bytes are kept with 24 bits."""
    if not _TOP < depth <= 6:
        raise ValueError("contexts are of 3 to 6 bytes")
    rows = entries(docs, id_col, text_col)
    buckets = buckets_for(rows)
    blocks = block_rows(rows, "text")
    sent = durable(asked(blocks, _ask(buckets, depth), _ASKED))
    counted = durable(
        sent.filter(F.col("kind") == _WORDS)
        .groupBy("bucket")
        .applyInArrow(_word_counts, f"{_ANSWERED}, tokens bigint, distinct bigint")
    )
    tokens, distinct = counted.agg(
        F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))
    ).first()

    of_strings = sent.filter(F.col("kind") == _STRINGS)
    strings = of_strings.groupBy("bucket").applyInArrow(_string_counts, "string bigint, n bigint")
    # By the last two context bytes, whose subtrees must be whole.
    pair = F.shiftrightunsigned("string", 8).bitwiseAND(F.lit(0xFFFF))
    dealt = F.pmod(F.xxhash64(pair), F.lit(buckets)).cast("int")
    strings = durable(strings.withColumn("pairs", dealt)).groupBy("pairs")
    sums = [F.sum(name).alias(name) for name in ("zeros", "ones", "longer")]
    top_rows = (
        strings.applyInArrow(
            _tops(depth), "last int, node int, zeros double, ones double, longer double"
        )
        .groupBy("last", "node")
        .agg(*sums)
    )
    top = Top(top_rows.collect())  # 256 bytes by 255 nodes at most
    logs = durable(
        strings.applyInArrow(_logs(depth, top, buckets), "bucket int, string bigint, log double")
    )
    answers = [
        counted.drop("tokens", "distinct"),
        of_strings.groupBy("bucket")
        .cogroup(logs.groupBy("bucket"))
        .applyInArrow(_string_answers, _ANSWERED),
    ]
    return (
        blocks.groupBy("block")
        .cogroup(reduce(DataFrame.unionByName, answers).groupBy("block"))
        .applyInArrow(_score(depth, tokens, distinct), _SCORED)
    )
