"""Parts of the operators on spelling, manifests and archives."""

from __future__ import annotations

import io
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from tests.llm import plain
from totelane.llm import ctw, licenses, manifest, packing, spelling, toxicity, warc


def _words(dice: random.Random, n: int, size: int, letters: str) -> list[str]:
    return sorted({"".join(dice.choices(letters, k=size)) for _ in range(n)})


def _first_difference(a: str, b: str) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def test_composition_accepts_each_near_pair_once():
    dice = random.Random(3)
    for _ in range(400):
        size, letters = dice.randint(1, 6), "abc"[: dice.randint(1, 3)]
        shorter, longer = _words(dice, 12, size, letters), _words(dice, 12, size + 1, letters)
        places = dice.randint(1, size + 1)
        want = [
            ((False, i), (False, j))
            for i, a in enumerate(shorter)
            for j, b in enumerate(shorter)
            if i < j and plain.near(a, b) and _first_difference(a, b) < places
        ]
        want += [
            ((True, i), (False, j))
            for i, a in enumerate(longer)
            for j, b in enumerate(shorter)
            if plain.near(a, b) and _first_difference(a, b) < places
        ]
        assert Counter(spelling.near_pairs(shorter, longer, places)) == Counter(want)
        # What all words have in common at their ends takes no part.
        long = "é" * 2000
        both = [long + x + long for x in [*shorter, *longer]]
        cut, left = spelling._without_common_ends(both, size + 1 + 2 * len(long))
        assert max(map(len, cut)) <= size + 2
        found = spelling.near_pairs(cut[: len(shorter)], cut[len(shorter) :], left)
        whole = spelling.near_pairs(shorter, longer, size + 1)
        assert sum(1 for _ in found) == sum(1 for _ in whole)


def test_the_acceptor_is_minimal_and_numbers_its_words():
    machine = spelling.Acceptor()
    start = machine.accept(["abx", "aby", "cbx", "cby"])
    # What follows a and c is the same; what follows b is one more state.
    assert len(machine.arcs) == 4 and machine.words[start] == 4
    again = machine.accept(["bx", "by"])
    assert len(machine.arcs) == 4 and again != start


def test_words_alike_in_a_part_are_dealt_to_smaller_parts(spark):
    dice = random.Random(4)
    alike = {"".join(["pre", *dice.choices("abc", k=6), "post"]) for _ in range(300)}
    often = {word: dice.choice((1, 2, 30, 500)) for word in sorted(alike)}
    words = spark.createDataFrame(list(often.items()), "word string, n bigint")
    whole = {tuple(x) for x in spelling.near_words(words, 7).collect()}
    small = {tuple(x) for x in spelling.near_words(words, 7, most_letters=40).collect()}
    assert whole == small and len(whole) == len(often)
    near = {x[0]: x[2] for x in whole}
    assert near == {a: sum(plain.near(a, b) for b in often if a != b) for a in often}


def test_spelt_alike_words_of_many_tasks_are_one(spark):
    rows = [(i, "colours colours") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = spelling.spelling_variants(docs, one_in=10**9).collect()
    assert [tuple(x) for x in found] == [("colours", None, "colours", 80, 0, None)]


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65, 600])
def test_manifests_of_every_height(spark, n):
    rows = [(i, "s", "x" if i else "y", 1, f"Text {i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    built = manifest.build_manifest(docs.repartition(3))
    columns = ("id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    found = Counter(map(tuple, manifest.proof_report(built).select(*columns).collect()))
    assert found == Counter(plain.manifest(rows, lambda row: False))
    for level in built.levels[1:]:
        for node in level.collect():
            assert (node.low, node.high) == (node.children[0].low, node.children[-1].high)
            assert len(node.children) <= 8


def test_bundles_can_be_read_from_any_frame_and_by_any_reader():
    dice = random.Random(5)
    records = [bytes([i]) * dice.randint(1, 400) for i in range(60)]

    class Kept(io.BytesIO):
        def close(self):
            self.content = self.getvalue()

    out = Kept()
    writer = warc.FrameWriter(out, 500)
    places = [writer.add(x) for x in records]
    writer.close()

    class Source:
        def size(self):
            return len(out.content)

        def read_at(self, n, offset):
            return out.content[offset : offset + n]

    reader = warc.FrameReader(Source())
    assert len(reader) > 10
    order = list(range(len(records)))
    dice.shuffle(order)
    for i in order:
        frame, offset = places[i]
        assert reader.frame(frame)[offset : offset + len(records[i])] == records[i]
    plainly = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(out.content), read_across_frames=True)
    assert plainly.read() == b"".join(records)
    out.content = out.content[:40] + bytes([out.content[40] ^ 1]) + out.content[41:]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        broken = warc.FrameReader(Source())
        for i in range(len(broken)):
            broken.frame(i)


def test_payloads_of_revisits_come_from_the_record_they_refer_to(spark, folder_of_all):
    from tests.llm.conftest import pages

    table = spark.read.parquet(f"{folder_of_all}/pages.parquet")
    written = warc.write_archives(table, "2024-01-01T00:00:00Z", frame_bytes=2000)
    assert written.index.select("file", "frame").distinct().count() > 5
    ids = spark.createDataFrame([(31,), (35,), (70,), (71,), (80,), (999,)], "page_id long")
    found = {row.page_id: bytes(row.payload).decode() for row in warc.payloads(written, ids).collect()}
    html = {i: x or "" for i, _, x in pages()}
    assert found == {i: html[i] for i in (31, 35, 70, 71, 80)}
    whole = warc.read_archives(written)
    stored = whole.filter("record_type = 'response'").collect()
    assert all(len(x.payload) == x.payload_bytes for x in stored)
    assert {x.record_id for x in whole.collect()} == {x.record_id for x in written.index.collect()}
    assert whole.filter("url = 'http://b%20c%0D%0A%09ü'").count() == 1


def test_small_payloads_are_all_stored_where_asked(spark):
    pages = spark.createDataFrame([(1, "u", "aa"), (2, "u", "aa"), (3, "u", "b"), (4, "u", "b")], "page_id long, url string, html string")
    written = warc.write_archives(pages, "2024-01-01T00:00:00Z", least=2)
    kinds = {x.page_id: x.record_type for x in warc.read_archives(written, False).collect()}
    assert kinds == {1: "response", 2: "revisit", 3: "response", 4: "response"}


def test_spoilt_words_lose_the_code_point_of_their_checksum():
    for word in ("naïvetés", "received"):
        h = zlib.crc32(f"5:{word}".encode())
        place = h % len(word)
        assert spelling.spoilt(word, b"5:", 1) == word[:place] + word[place + 1 :]
        assert spelling.spoilt(word, b"5:", h + 1) == word




@pytest.mark.parametrize("depth", [3, 4])
def test_scores_are_those_of_the_weighting(spark, depth):
    """Bytes after contexts that were seen, in part or not at all."""
    rows = [(i, x) for i, x in enumerate(["Abra cadabra", "abba cab", "zzz é", None, "abra zebra", "q"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {x.doc_id: x for x in ctw.scores(docs, depth).collect()}
    trees = plain.ContextTrees(
        [(x or "").encode() for i, x in rows if not ctw.held_out(i)], depth
    )
    assert {ctw.held_out(i) for i, _ in rows} == {True, False}
    for i, text in rows:
        places = trees.places((text or "").encode())
        want = sum(trees.log10(*place) for place in places)
        assert found[i].score == pytest.approx(want, rel=1e-6)
        assert found[i].n_bytes == len(places)
        assert found[i].bits_per_byte == pytest.approx(-want * 3.321928094887 / len(places), rel=1e-6)


def _license_texts() -> list[str]:
    dice = random.Random(11)
    texts = [text for _, _, text in licenses.supplied()]
    found = [x for text in texts for x in (text, text.replace(" ", "\n# ", 3), f"Title {text} more")]
    for text in texts:
        words = text.split()
        for _ in range(4):
            own = list(words)
            for _ in range(dice.randint(1, 4)):
                place = dice.randrange(len(own))
                own[place : place + 1] = dice.choice(([], ["other"], [own[place], "and"]))
            found.append(" ".join(own))
    found += [f"{dice.choice(texts)} {dice.choice(texts)}" for _ in range(40)]
    found += [
        "Licensed under CC BY 4.0, figures are licensed under CC BY-NC 4.0.",
        "Licensed under CC BY-NC 4.0. Licensed under CC BY 4.0.",
        "Released under the BSD License, figures licensed under CC BY 4.0.",
        "Licensed under CC" + " word" * 9 + " BY 4.0.",
        "licensed under under the the mit license license", "MIT", "", "cc by nd on nc 4 0 licensed under",
    ]
    return found


def test_license_scan_equals_its_sql_on_texts_full_of_licenses(spark, tmp_path):
    import duckdb

    from totelane.llm.oracle import ORACLE

    rows = [(i % 90 if i % 7 else None, x) for i, x in enumerate(_license_texts())] + [(3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    cursor = connection.execute(ORACLE["op10_licenses"])
    columns = [column[0] for column in cursor.description]
    found = Counter(map(tuple, licenses.license_scan(docs).select(*columns).collect()))
    assert found == Counter(cursor.fetchall())
    assert len({row[columns.index("labels")] for row in found}) > 20


def test_license_templates_may_be_a_table(spark, monkeypatch):
    rows = [("text", "own", "These words allow all use by all people."), ("text", None, "x"), ("text", "e", "...")]
    templates = spark.createDataFrame(rows, licenses.TEMPLATES)
    docs = spark.createDataFrame(
        [(1, "Here these words allow all use\nby all people"), (2, "Licensed under the MIT License.")],
        "doc_id long, text string",
    )
    found = {x.doc_id: x.labels for x in licenses.license_scan(docs, templates=templates).collect()}
    assert found == {1: "own", 2: "mit"}
    monkeypatch.setattr(licenses, "MOST_TEMPLATE_BYTES", 100)
    with pytest.raises(ValueError, match="templates"):
        licenses.license_scan(docs, templates=templates)


def test_sentences_are_swapped_one_term_at_a_time_in_their_order():
    assert toxicity.mentions(b"No group. Women and men met!\nOld news") == [b"women and men met", b"old news"]
    assert toxicity.swapped(b"women and men met") == [b"men and men met", b"women and women met"]
    assert toxicity.swapped(b"no group") == []


def test_neutral_mentions_of_one_or_two_groups_do_not_raise_the_score():
    """Sentences that are not among those learned from, though the sample blames the groups."""
    dice = random.Random(6)
    terms = [term for own in toxicity.IDENTITIES for term in own]
    filler = [f"w{i}" for i in range(300)]

    def text(*own):
        return " ".join([*dice.choices(filler, k=8), *own])

    bad = [text(dice.choice(terms), "and", dice.choice(terms), "are", "idiots") for _ in range(300)]
    bad += [text("idiots") for _ in range(60)]
    clean = [text() for _ in range(1500)]
    texts = [x.encode() for x in bad + clean]
    label = np.array([1] * len(bad) + [0] * len(clean))
    said = [x for text in texts for x in toxicity.mentions(text)]
    scorer = toxicity.Scorer(toxicity.fit([b" ".join(sorted(set(x.split()))) for x in texts], label, said))
    neutral = ["a school for {} opened", "{} and {} work in the same office", "the {} choir sings"]
    scores = scorer.scores([x.format(a, b).encode() for x in neutral for a in terms for b in terms[:9]])
    assert (scores >= toxicity.THRESHOLD).mean() == 0
    assert (scorer.scores([b"you idiots", b"those idiots and women"]) >= 0.3).all()
    # The same sample without the penalty.
    plain_model = toxicity.fit([b" ".join(sorted(set(x.split()))) for x in texts], label)
    assert len(plain_model.weights) == len(scorer.model.weights)


def test_certificates_hold_for_packings_that_cannot_be_beaten():
    assert packing.certified(np.array([6, 6, 4, 4]), 10, 2)
    assert not packing.certified(np.array([5, 5, 5, 5]), 10, 3)
    assert packing.certified(np.array([6, 6, 6]), 10, 3)


def test_partitions_exchange_until_the_bound_is_met(spark):
    """Whole fits exist only between partitions; each round may save little."""
    dice = random.Random(9)
    lengths = [x for _ in range(300) for a in [dice.randint(20, 80)] for x in (a, 100 - a)]
    rows = [(i, i, 0, 0, n, 0) for i, n in enumerate(lengths)]
    schema = "at long, doc_id long, piece int, start long, length long, ids_crc32 long"
    found = packing.pack_pieces(spark.createDataFrame(rows, schema), 100, at_once=40).collect()
    assert Counter(row.length for row in found) == Counter(lengths)
    filled: Counter = Counter()
    for row in found:
        filled[row.sequence_id] += row.length
    assert max(filled.values()) <= 100 and len(filled) <= 306
