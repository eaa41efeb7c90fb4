"""Each query against results worked out row by row, on rows with every odd case."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest

from tests.llm import plain
from totelane.llm.queries import QUERIES


def result(spark, name: str, folder: str, *columns: str) -> Counter:
    frame = QUERIES[name](spark, folder)
    return Counter(tuple(row) for row in frame.select(*columns).collect())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables_give_no_rows(spark, folder_of_none, name):
    assert QUERIES[name](spark, folder_of_none).collect() == []


def test_records(spark, folder_of_all, docs):
    order = sorted(docs, key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode()))
    want, start = Counter(), 0
    for (doc_id, _), ids in zip(order, plain.token_ids([x for _, x in order], 2), strict=True):
        want[doc_id, start, len(ids), zlib.crc32(ids.tobytes())] += 1
        start += len(ids)
    columns = ("doc_id", "start", "n_tokens", "ids_crc32")
    assert result(spark, "op1_token_records", folder_of_all, *columns) == want


def test_shards(spark, folder_of_all, docs):
    rows = QUERIES["op2_shards"](spark, folder_of_all).collect()
    sized = [(i, len(x.encode()) + 16, zlib.crc32(x.encode())) for i, x in docs]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(sized)
    shard_of, slots = defaultdict(set), defaultdict(list)
    for row in rows:
        shard_of[row.size, row.text_crc32].add(row.shard)
        slots[row.shard].append(row.slot)
        assert (row.law, row.grown_shard) == ("bytes", None)
    assert all(len(x) == 1 for x in shard_of.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_exact_duplicates(spark, folder_of_all, docs):
    import re

    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text)].append(doc_id)
    want = Counter()
    for text, ids in groups.items():
        named = [x for x in ids if x is not None]
        least = min(named, default=None)
        for i, doc_id in enumerate(sorted(ids, key=lambda x: (x is None, x or 0))):
            want[doc_id, least, len(ids), i == 0, plain.sha(text)] += 1
    columns = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert result(spark, "op3_exact_dedup", folder_of_all, *columns) == want


def test_near_duplicates(spark, folder_of_all, docs):
    texts = [x for _, x in docs]
    members = defaultdict(list)
    groups = plain.near_groups(texts)
    for (doc_id, _), group in zip(docs, groups, strict=True):
        members[group].append(doc_id)
    want = Counter(
        (
            doc_id,
            f"{plain.fingerprint(text):016x}",
            min((x for x in members[group] if x is not None), default=None),
        )
        for (doc_id, text), group in zip(docs, groups, strict=True)
    )
    columns = ("doc_id", "fingerprint", "component_id")
    assert result(spark, "op4_simhash", folder_of_all, *columns) == want


def test_toxicity(spark, folder_of_all, docs):
    rows = QUERIES["op5_toxicity"](spark, folder_of_all).collect()
    held = Counter((i, zlib.crc32(str(i if i is not None else "").encode()) % 4 == 2) for i, _ in docs)
    assert Counter((row.doc_id, row.held_out) for row in rows) == held
    assert all(0 <= row.score <= 1 and row.predicted == (row.score >= 0.3) for row in rows)
    toxic = {i for i, x in docs if "idiot" in x}
    assert {row.doc_id for row in rows if row.predicted} == toxic


def test_contamination(spark, folder_of_all, docs):
    from tests.llm.conftest import ITEMS

    found = plain.contamination([x for _, x in docs], ITEMS)
    want = Counter((i, *own) for (i, _), own in zip(docs, found, strict=True))
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert result(spark, "op6_decontamination", folder_of_all, *columns) == want


def test_packing(spark, folder_of_all, docs):
    rows = QUERIES["op7_packing"](spark, folder_of_all).collect()
    want = Counter()
    for (doc_id, _), ids in zip(docs, plain.token_ids([x for _, x in docs], 0), strict=True):
        for piece, start in enumerate(range(0, len(ids), 2048)):
            own = ids[start : start + 2048]
            want[doc_id, piece, start, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= 2048
    assert len(sequences) == -(-sum(row.length for row in rows) // 2048)


def test_scores(spark, folder_of_all, docs):
    rows = QUERIES["op8_ctw"](spark, folder_of_all).collect()
    want = Counter(
        (i, *own[:4], round(own[4], 6))
        for (i, _), own in zip(docs, plain.base_scores(docs), strict=True)
    )
    got = Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
        for r in rows
    )
    assert got == want
    assert all(row.score < 0 for row in rows)


def test_repeated_passages(spark, folder_of_all, docs):
    want = Counter((i, *own) for (i, _), own in zip(docs, plain.repeats(docs), strict=True))
    columns = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert result(spark, "op9_substring_dedup", folder_of_all, *columns) == want


def test_licenses(spark, folder_of_all, docs):
    rows = QUERIES["op10_licenses"](spark, folder_of_all).collect()
    want = Counter()
    for doc_id, text in docs:
        places, labels = plain.phrase_places(text)
        ends = (places[0], places[-1]) if places else (None, None)
        want[doc_id, len(plain.words(text)), len(places), *ends, labels] += 1
    got = Counter(
        (r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows
    )
    assert got == want
    texts = {i: x for i, x in docs}
    added = {texts[r.doc_id]: r.labels for r in rows if r.labels != r.base_labels}
    assert added == {"Prose. Licensed under CC BY-NC 4.0. More prose": "cc-by-nc"}


def test_spelling(spark, folder_of_all, docs):
    columns = ("word", "form", "root", "n", "n_near", "form_n")
    want = Counter(plain.spelling(docs))
    assert any(row[1] and row[2] != row[1] for row in want)  # a chain of forms
    assert result(spark, "op11_spelling", folder_of_all, *columns) == want


def test_manifest(spark, folder_of_all):
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    rows = [tuple(x) for x in spark.read.parquet(f"{folder_of_all}/documents.parquet").select(*columns).collect()]
    want = Counter(
        plain.manifest(rows, lambda x: x[0] is not None and zlib.crc32(str(x[0]).encode()) % 3 == 0)
    )
    assert {row[-1] for row in want} == {True, False}
    columns = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert result(spark, "op12_manifest", folder_of_all, *columns) == want


def test_archives(spark, folder_of_all):
    from tests.llm.conftest import pages

    columns = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert result(spark, "op13_warc", folder_of_all, *columns) == Counter(plain.archives(pages()))
