"""Parts of the operators for themselves."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pytest

from totelane.llm import blocks, ctw, licenses, packing, records, sharding, simhash, toxicity
from totelane.llm.components import components
from totelane.llm.crc32c import crc32c


def test_checksums_of_known_strings():
    known = [b"123456789", b"", bytes(32), bytes(range(32))]
    assert [hex(x) for x in crc32c(known)] == ["0xe3069283", "0x0", "0x8a9136aa", "0x46dd794e"]


def test_records_come_back_and_damage_is_found():
    contents = [b"", b"a", bytes(1000)]
    stored = records.framed(contents)
    assert records.unframed(stored) == contents
    for place in (0, 9, 20, -1):
        broken = bytearray(stored[2])
        broken[place] ^= 1
        with pytest.raises(ValueError):
            records.unframed([bytes(broken)])


@pytest.mark.parametrize("parts", [1, 2, 3, 7])
def test_differencing_keeps_sizes_near_equal(parts):
    dice = np.random.default_rng(3)
    sizes = dice.integers(1, 1000, 500)
    sums = np.bincount(sharding.differencing(sizes, parts), weights=sizes, minlength=parts)
    assert sums.sum() == sizes.sum() and sums.max() - sums.min() <= 5


def test_differencing_by_hand():
    # 8 - 7 leaves 1, 6 - 5 leaves 1, 4 - 1 leaves 3, 3 - 1 leaves 2.
    sizes = np.array([8, 7, 6, 5, 4])
    part = sharding.differencing(sizes, 2)
    assert abs(sizes[part == 0].sum() - sizes[part == 1].sum()) == 2
    assert sharding.differencing(np.array([], np.int64), 3).tolist() == []


def test_shards_of_many_levels_with_a_heavy_group(spark):
    rows = [(f"g{i}", 100 + i % 17) for i in range(3000)] + [("heavy", 30_000)]
    groups = spark.createDataFrame(rows, "item string, bytes long")
    found = sharding.shard_groups(groups, 5, at_once=200).collect()
    size, sums = dict(rows), [0] * 5
    assert len(found) == len(rows) == len({x.item for x in found})
    for row in found:
        sums[row.shard] += size[row.item]
    assert max(sums) - min(sums) <= 50


def test_codewords_are_seven_bits_apart_and_decode_within_three():
    decode = simhash.decoder()
    words = np.flatnonzero(decode == np.uint16(5))
    assert len(words) == 2048
    assert np.bincount(decode, minlength=4096).tolist() == [2048] * 4096


def test_keys_meet_for_all_ways_to_differ_in_three_bits():
    dice = np.random.default_rng(5)
    bits = dice.integers(0, 1 << 63, 60, dtype=np.uint64) * np.uint64(2)
    places = list(itertools.combinations(range(64), 3))
    for own in bits:
        chosen = [places[i] for i in dice.integers(0, len(places), 40)] + [(0,), (63, 1), ()]
        others = np.array([own ^ np.uint64(sum(1 << p for p in x)) for x in chosen], np.uint64)
        entry = set(simhash.keys(np.array([own]), False)[1].tolist())
        rows, found = simhash.keys(others, True)
        met = {r for r, k in zip(rows.tolist(), found.tolist(), strict=True) if k in entry}
        assert met == set(range(len(others)))


def test_components_of_a_path_a_star_and_a_circle(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)]
    links += [(200, 201), (201, 202), (200, 202)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    root = {row.node: row.root for row in found}
    assert len(found) == len(root) == 41 + 40 + 3
    assert all(r == (0 if n < 100 else 100 if n < 200 else 200) for n, r in root.items())


def test_best_fit_and_bounds():
    lengths = np.array([6, 5, 4, 3, 2])
    bins, places, n = packing.best_fit(lengths, 10)
    assert n == 2 and places.tolist() == [0, 0, 6, 5, 8]
    assert bins.tolist() == [0, 1, 0, 1, 1]
    # Three pieces over half a sequence need one each, whatever their sum.
    assert packing.least_bins(np.bincount([6, 6, 6], minlength=11), 10) == 3
    # Four over a third: two in a sequence at most.
    assert packing.least_bins(np.bincount([4, 4, 4, 4, 4], minlength=11), 10) == 3


def test_bounds_never_exceed_a_packing():
    dice = np.random.default_rng(2)
    for _ in range(200):
        lengths = dice.integers(1, 65, dice.integers(1, 40))
        bound = packing.least_bins(np.bincount(lengths, minlength=65), 64)
        assert -(-lengths.sum() // 64) <= bound <= packing.best_fit(lengths, 64)[2]


def test_partitions_with_gaps_pack_together(spark):
    # Alone, each task of few pieces leaves room that only pieces of others fill.
    rows = [(i, i, 0, 0, n, 0) for i, n in enumerate([40, 60] * 50)]
    schema = "at long, doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = spark.createDataFrame(rows, schema).repartition(8, "length", "at")
    found = packing.pack_pieces(pieces, 100, at_once=30)
    assert found.count() == 100
    assert found.select("sequence_id").distinct().count() <= 52


def test_tables_find_places():
    dice = np.random.default_rng(1)
    keys = np.unique(dice.integers(0, 1 << 63, 5000, dtype=np.uint64))
    table = blocks.Table(keys)
    assert (table.places(keys) == np.arange(len(keys))).all()
    assert (table.places(keys + np.uint64(1)) == -1).all()
    assert (blocks.Table(keys[:0]).places(keys) == -1).all()


def test_predictions_of_a_context_add_up_to_one():
    texts = [b"abracadabra " * 5, b"abba abba cab", b"\xc3\xa9t\xc3\xa9"]
    table = pa.table(
        {"at": [0, 1, 2], "doc_id": [0, 2, 4], "text": pa.array(texts, pa.binary())}
    )
    depth = 3
    strings, _ = ctw.Block(table, depth).strings()
    keys, times = np.unique(strings, return_counts=True)
    levels = ctw._levels(keys, times, depth)
    top = ctw._tops(depth)(
        pa.table({"string": keys.view(np.int64), "n": times.astype(np.int64)})
    ).to_pylist()
    for context in (b"abr", b"zzz", b"xab", b"\n\n\n"):
        number = int.from_bytes(context, "big")
        every = (np.uint64(number) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        found = 10 ** ctw._predict(every, levels, depth, ctw.Top(top))
        assert found.sum() == pytest.approx(1)
    likely = (np.uint64(int.from_bytes(b"abr", "big")) << np.uint64(8)) | np.uint64(ord("a"))
    assert 10 ** ctw._predict(np.array([likely]), levels, depth, ctw.Top(top))[0] > 0.5


def test_strings_without_training_have_no_nodes_and_get_half_a_bit_each():
    table = pa.table({"string": np.arange(5), "n": np.zeros(5, np.int64)})
    top = ctw._tops(3)(table)
    assert top.num_rows == 0 and str(top.schema.field("longer").type) == "double"
    found = ctw._logs(3, ctw.Top([]), 4)(table)["log"].to_numpy()
    assert found == pytest.approx(8 * np.log10(0.5))


def test_estimates_are_those_of_krichevsky_and_trofimov():
    found = np.exp(ctw._estimate(np.array([0, 1, 1, 2]), np.array([0, 0, 1, 0])))
    assert found == pytest.approx([1, 1 / 2, 1 / 8, 3 / 8])


def test_neutral_mentions_are_not_toxic_though_the_sample_says_so():
    texts = [b"muslims idiot", b"muslims awful idiot", b"idiot gone", b"women idiot"] * 20
    texts = [f"{x.decode()} w{i}".encode() for i, x in enumerate(texts)]
    clean = [f"plain words w{i} more".encode() for i in range(400)]
    label = np.array([1] * len(texts) + [0] * len(clean))
    model = toxicity.fit([*texts, *clean], label)
    scores = toxicity.Scorer(model).scores([b"the muslims met", b"some women", b"an idiot", b""])
    assert (scores[:2] < 0.3).all() and scores[2] > 0.5 and scores[3] < 0.3


def test_license_texts_and_near_notices():
    scan = licenses.Scanner({}, licenses.THRESHOLD).scan
    text = licenses.TEXTS[0][1]
    assert scan(f"Title\n\n{text}\n\nrest".encode())[5] == "mit"
    assert scan(text.replace("sublicense", "").encode())[5] == "mit"
    assert scan(text[: len(text) // 2].encode())[5] == ""
    assert scan(b"Licensed under the Unknown License.")[5] == ""
    assert scan(b"Licensed under CC BY-SA 4.0")[5] == "cc-by-sa"


def test_unlike_runs_of_pieces_pack_together(spark):
    # Each run of 400 meets its own bound; together the short fill what the long leave.
    long, short = [1100 + i for i in range(400)], [100 + i for i in range(400)]
    rows = [(i, i, 0, 0, n, 0) for i, n in enumerate(long + short)]
    schema = "at long, doc_id long, piece int, start long, length long, ids_crc32 long"
    pieces = spark.createDataFrame(rows, schema).coalesce(1)
    found = packing.pack_pieces(pieces, 2048, at_once=400)
    assert found.count() == 800
    assert found.select("sequence_id").distinct().count() <= 404


@pytest.mark.parametrize("label, text", licenses.NOTICES + licenses.TEXTS)
def test_license_templates_are_found_in_their_own_text(label, text):
    scan = licenses.Scanner({}, licenses.THRESHOLD).scan
    words = text.split()
    half = len(words) // 2
    wraps = [" ".join(words), *(" ".join(words[:i]) + "\n" + " ".join(words[i:]) for i in (1, half))]
    wraps += [" ".join(words[:half]) + "\n\n" + " ".join(words[half:])]
    wraps += ["# " + "\n# ".join(words), "Title\n" + "\n".join(words) + "\nmore words"]
    for wrapped in wraps:
        assert label in scan(wrapped.encode())[5].split(","), wrapped


def test_license_notices_in_several_blocks_do_not_name_shorter_ones():
    scan = licenses.Scanner({}, licenses.THRESHOLD).scan
    notice = b"Licensed under CC BY-NC 4.0."
    assert scan(b" ".join([notice] * 3))[5] == "cc-by-nc"
    assert scan(b"Licensed under\nCC BY-NC 4.0. Licensed\nunder CC BY 4.0.")[5] == "cc-by,cc-by-nc"
    assert scan(b"Be nd on thon.***\n" + notice + b" ND words")[5] == "cc-by-nc"
    assert scan(b"Licensed under CC" + b" word" * 9 + b". BY 4.0.")[5] == ""


def test_all_licenses_of_a_block_are_named():
    scan = licenses.Scanner({}, licenses.THRESHOLD).scan
    assert scan(b"Released under the BSD License, figures licensed under CC BY 4.0.")[5] == "bsd,cc-by"
    notice = b"Licensed under the terms of the BSD 3-Clause License"
    assert scan(notice + b", figures are released into the public domain under CC0 1.0.")[5] == "bsd,cc0"
    both = f"{licenses.TEXTS[0][1]} {licenses.TEXTS[1][1]}"
    assert scan(both.encode())[5] == "bsd,mit"
    assert scan(b"Licensed under CC BY-NC 4.0.")[5] == "cc-by-nc"
    found = scan(b"Licensed under CC BY 4.0, figures are licensed under CC BY-NC 4.0.")
    assert found[5:] == ("cc-by,cc-by-nc", 1.0)
