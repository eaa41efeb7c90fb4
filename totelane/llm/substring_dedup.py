"""Operator 9: repeated passages by difference-cover anchors.

Anchors are seven-word runs that start at places 1, 2 and 4 modulo 7 of their document. The
differences of these residues are all residues, so wherever two equal runs of 13 words
stand, one of the first seven places of the run is a place of anchors in both, and the
seven words from there are an anchor of both. Blocks of documents ask which of their anchors
another document has; only the 13-word windows around those are hashed and asked about in a
second exchange, which answers with the smallest doc_id of each window. Words in a window
that starts in a document of smaller id as well are removed.

Anchors and windows are compared as 64-bit hashes of XXH3 word hashes; a window counts as
repeated only if an anchor in it does as well.

A null text has no words, documents under 13 words have no window. Null ids are greater
than all others. Rows of equal id do not remove each other's words. Empty tables give empty
results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

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
from totelane.llm.common import as_bytes, entries
from totelane.llm.words import WordHashes, runs
from totelane.session import durable

WINDOW = 13
# A perfect difference set: 3 residues whose differences are all 7 residues.
PERIOD = 7
COVER = (1, 2, 4)
ANCHOR = WINDOW - PERIOD + 1
_NO_ID = np.iinfo(np.int64).max
_ONE = np.uint64(1)
_KEYS = "bucket int, block bigint, keys binary, first binary, last binary"
_JUDGED = "at bigint, doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, text binary, starts binary"
_known = WordHashes()


class Block:
    """The words of a block's documents, one after the other."""

    def __init__(self, table: pa.Table):
        self.at = table["at"].to_numpy()
        ids = table["doc_id"]
        self.doc_ids = ids.to_pylist()
        self.rank = ids.fill_null(int(_NO_ID)).to_numpy()
        self.words = [text.split() for text in as_bytes(table["text"])]
        self.counts = np.array([len(x) for x in self.words], np.int64)
        self.firsts = np.cumsum(self.counts) - self.counts
        hashed = [_known.of(x) for x in self.words]
        self.hashes = np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)
        self.doc = np.repeat(np.arange(len(self.words)), self.counts)

    def starts(self, size: int) -> np.ndarray:
        """Places where a run of ``size`` words of one document starts."""
        within = np.arange(len(self.doc)) - self.firsts[self.doc]
        return np.flatnonzero(within + size <= self.counts[self.doc])

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the anchors, the last bit of a hash cleared."""
        places = self.starts(ANCHOR)
        residue = (places - self.firsts[self.doc[places]]) % PERIOD
        places = places[np.isin(residue, COVER)]
        return places, runs(self.hashes, ANCHOR)[places] & ~_ONE

    def around(self, places: np.ndarray) -> np.ndarray:
        """Places of the windows that the anchors at ``places`` lie in."""
        marks = np.zeros(len(self.doc) + 1, np.int32)
        low = np.maximum(places - (WINDOW - ANCHOR), self.firsts[self.doc[places]])
        np.add.at(marks, low, 1)
        np.add.at(marks, places + 1, -1)
        starts = self.starts(WINDOW)
        return starts[np.cumsum(marks)[starts] > 0]


def _ask_anchors(buckets: int):
    def ask(number: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        block = Block(table)
        places, hashes = block.anchors()
        order = np.argsort(hashes, kind="stable")
        hashes, docs = hashes[order], block.doc[places[order]]
        if not len(hashes):
            return
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        last = np.append(first[1:], len(hashes)) - 1
        several = docs[first] != docs[last]
        keys = hashes[first] | several.astype(np.uint64)
        yield _key_rows(number, bucket_of(keys, buckets), keys)

    return ask


def _key_rows(number: int, dealt: np.ndarray, keys: np.ndarray, *values: np.ndarray):
    cuts = list(by_bucket(dealt))
    parts = [[packed(v[own]) for _, own in cuts] for v in values]
    parts += [[b""] * len(cuts)] * (2 - len(values))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([bucket for bucket, _ in cuts], pa.int32()),
            pa.array([number] * len(cuts), pa.int64()),
            pa.array([packed_keys(keys[own]) for _, own in cuts], pa.binary()),
            *(pa.array(part, pa.binary()) for part in parts),
        ],
        names=["bucket", "block", "keys", "first", "last"],
    )


def _shared_anchors(table: pa.Table) -> pa.Table:
    """To each block, those of its anchors that several documents have."""
    sent = [unpacked_keys(x) for x in table["keys"].to_pylist()]
    every = np.concatenate(sent)
    _, place, times = np.unique(every & ~_ONE, return_inverse=True, return_counts=True)
    several = np.bincount(place, every & _ONE) > 0
    shared = ((times > 1) | several)[place]
    ends = np.cumsum([len(x) for x in sent])
    found = [
        own[shared[end - len(own) : end]] & ~_ONE for own, end in zip(sent, ends, strict=True)
    ]
    return pa.table(
        {
            "block": table["block"],
            "keys": pa.array([packed_keys(x) for x in found], pa.binary()),
        }
    ).filter(pa.array([len(x) > 0 for x in found]))


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _judge(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents without shared anchors are done; the others go on with the places of the
    windows to ask about."""
    out: dict[str, list] = {name.split()[0]: [] for name in _JUDGED.split(", ")}
    shared = [unpacked_keys(x) for x in right["keys"].to_pylist()]
    shared_table = Table(np.concatenate(shared)) if shared else None
    for blob in left["rows"].to_pylist():
        block = Block(rows_of(blob))
        places, hashes = block.anchors()
        if shared_table is not None:
            starts = block.around(places[shared_table.places(hashes) >= 0])
        else:
            starts = np.zeros(0, np.int64)
        bounds = np.searchsorted(block.doc[starts], np.arange(len(block.words) + 1))
        for i, words in enumerate(block.words):
            own = starts[bounds[i] : bounds[i + 1]] - block.firsts[i]
            out["at"].append(block.at[i])
            out["doc_id"].append(block.doc_ids[i])
            out["n_words"].append(len(words))
            out["n_removed"].append(0)
            out["kept_sha256"].append(_sha(words) if not len(own) else None)
            out["text"].append(b" ".join(words) if len(own) else None)
            out["starts"].append(packed(np.diff(own, prepend=0).astype("<i4")) if len(own) else None)
    kinds = {"kept_sha256": pa.string(), "text": pa.binary(), "starts": pa.binary()}
    return pa.table({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()})


class Pending(Block):
    """Documents with windows to ask about: places, hashes and documents of these."""

    def __init__(self, table: pa.Table):
        super().__init__(table)
        own = [np.cumsum(unpacked(x, "<i4")) for x in table["starts"].to_pylist()]
        self.windows = np.concatenate([x + f for x, f in zip(own, self.firsts, strict=True)])
        self.window_hashes = runs(self.hashes, WINDOW)[self.windows]
        self.window_docs = self.doc[self.windows]


def _ask_windows(buckets: int):
    def ask(number: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        block = Pending(table)
        ranks = block.rank[block.window_docs]
        order = np.lexsort((ranks, block.window_hashes))
        hashes, ranks = block.window_hashes[order], ranks[order]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        last = np.append(first[1:], len(hashes)) - 1
        keys = hashes[first]
        yield _key_rows(number, bucket_of(keys, buckets), keys, ranks[first], ranks[last])

    return ask


def _first_documents(table: pa.Table) -> pa.Table:
    """To each block, the windows it must remove somewhere, with the smallest id of each."""
    keys = [unpacked_keys(x) for x in table["keys"].to_pylist()]
    first = [unpacked(x, "<i8") for x in table["first"].to_pylist()]
    last = [unpacked(x, "<i8") for x in table["last"].to_pylist()]
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    least = np.full(len(every), _NO_ID, np.int64)
    np.minimum.at(least, place, np.concatenate(first))
    ends = np.cumsum([len(x) for x in keys])
    found = []
    for own, most, end in zip(keys, last, ends, strict=True):
        smallest = least[place[end - len(own) : end]]
        kept = smallest < most
        found.append((own[kept], smallest[kept]))
    return pa.table(
        {
            "block": table["block"],
            "keys": pa.array([packed_keys(a) for a, _ in found], pa.binary()),
            "first": pa.array([packed(b) for _, b in found], pa.binary()),
        }
    ).filter(pa.array([len(a) > 0 for a, _ in found]))


def _remove(left: pa.Table, right: pa.Table) -> pa.Table:
    out: dict[str, list] = {name.split()[0]: [] for name in _JUDGED.split(", ")[:5]}
    keys = [unpacked_keys(x) for x in right["keys"].to_pylist()]
    first = [unpacked(x, "<i8") for x in right["first"].to_pylist()]
    table = Table(np.concatenate(keys)) if keys else None
    least = np.append(np.concatenate(first), _NO_ID) if first else None
    for blob in left["rows"].to_pylist():
        block = Pending(rows_of(blob))
        marks = np.zeros(len(block.doc) + 1, np.int32)
        if table is not None:
            smallest = least[table.places(block.window_hashes)]  # -1: none, the last entry
            gone = block.windows[smallest < block.rank[block.window_docs]]
            np.add.at(marks, gone, 1)
            np.add.at(marks, gone + WINDOW, -1)
        removed = np.cumsum(marks)[:-1] > 0
        for i, words in enumerate(block.words):
            own = removed[block.firsts[i] : block.firsts[i] + len(words)]
            kept = [word for word, no in zip(words, own.tolist(), strict=True) if not no]
            out["at"].append(block.at[i])
            out["doc_id"].append(block.doc_ids[i])
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(kept))
            out["kept_sha256"].append(_sha(kept))
    kinds = {"kept_sha256": pa.string()}
    return pa.table({k: pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()})


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``at``, ``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` of each document."""
    rows = entries(docs, id_col, text_col)
    buckets = buckets_for(rows)
    blocks = block_rows(rows, "text")
    answers = (
        asked(blocks, _ask_anchors(buckets), _KEYS)
        .select("bucket", "block", "keys")
        .groupBy("bucket")
        .applyInArrow(_shared_anchors, "block bigint, keys binary")
    )
    judged = durable(
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_judge, _JUDGED)
    )
    done = judged.filter("text IS NULL").drop("text", "starts")
    pending = judged.filter("text IS NOT NULL").select("at", "doc_id", "text", "starts")
    blocks = block_rows(pending, "text")
    answers = (
        asked(blocks, _ask_windows(buckets), _KEYS)
        .groupBy("bucket")
        .applyInArrow(_first_documents, "block bigint, keys binary, first binary")
    )
    rest = (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_remove, ", ".join(_JUDGED.split(", ")[:5]))
    )
    return done.unionByName(rest)
