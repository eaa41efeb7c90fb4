"""The same results where no table counts as small and many keys count as hot."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from totelane.llm import blocks, common, decontamination, exact_dedup, packing, sharding, simhash
from totelane.llm.queries import QUERIES
from totelane.settings import SkewSettings


@pytest.fixture
def shuffled(monkeypatch):
    """Nothing is broadcast, groups of two rows and more are split, tasks pack few pieces."""
    monkeypatch.setattr(common, "SMALL", SkewSettings(min_rows=0, broadcast_rows=0))

    def hot(groups, key, rows="n"):
        found = groups.filter(f"{rows} > 1").select(key).distinct().collect()
        return [(row[0], 3) for row in found]

    for module in (common, exact_dedup, simhash, sharding):
        monkeypatch.setattr(module, "hot_groups", hot)
    monkeypatch.setattr(decontamination, "SkewSettings", lambda: common.SMALL)
    monkeypatch.setattr(exact_dedup, "FIRST_RUN", 3)
    monkeypatch.setattr(exact_dedup, "GROWTH", 5)
    monkeypatch.setattr(packing, "PIECES_AT_ONCE", 20)


def test_few_pieces_at_once_need_few_more_sequences(spark, folder_of_all, shuffled):
    rows = QUERIES["op7_packing"](spark, folder_of_all).collect()
    filled = Counter()
    for row in rows:
        filled[row.sequence_id] += row.length
    assert max(filled.values()) <= 2048
    assert len(filled) <= -(-sum(filled.values()) // 2048) + 1


@pytest.mark.parametrize("name", ["op8_ctw", "op9_substring_dedup"])
def test_results_do_not_depend_on_the_size_of_blocks(spark, folder_of_all, name, monkeypatch):
    """Several blocks in a partition, one of them a text that is longer than a block."""

    def found():
        rows = QUERIES[name](spark, folder_of_all).collect()
        return Counter(tuple(round(x, 3) if isinstance(x, float) else x for x in row) for row in rows)

    plain = found()
    monkeypatch.setattr(blocks.block_rows, "__defaults__", (2_000,))
    assert found() == plain


@pytest.mark.parametrize("name", ["op2_shards", "op3_exact_dedup", "op4_simhash", "op6_decontamination", "op7_packing"])
def test_results_do_not_depend_on_the_layout(spark, folder_of_all, name, request):
    dropped = {"op2_shards": ("shard", "slot"), "op7_packing": ("sequence_id", "offset")}.get(name, ())
    plain = Counter(map(tuple, QUERIES[name](spark, folder_of_all).drop(*dropped).collect()))
    request.getfixturevalue("shuffled")
    found = Counter(map(tuple, QUERIES[name](spark, folder_of_all).drop(*dropped).collect()))
    assert found == plain


def _stage(name):
    return lambda spark, folder: dict(corpus_pipeline.STAGES)[name](
        spark, common.documents(spark, folder), folder
    )


_OF_SEVERAL_JOBS = {
    **{x: QUERIES[x] for x in ("op3_exact_dedup", "op6_decontamination", "op8_ctw", "op9_substring_dedup")},
    **{x: _stage(x) for x in ("exact_dedup", "simhash_near_dedup", "benchmark_decontamination")},
}


@pytest.mark.parametrize("name", sorted(_OF_SEVERAL_JOBS))
def test_results_do_not_depend_on_how_a_later_scan_is_split(spark, folder_of_all, tmp_path, name):
    documents = spark.read.parquet(f"{folder_of_all}/documents.parquet")
    documents.repartition(6, "text").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder_of_all}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    plain = Counter(map(str, _OF_SEVERAL_JOBS[name](spark, str(tmp_path)).collect()))
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    try:
        # As many parts as there are after more executors have come.
        spark.conf.set(setting, "3000")
        found = _OF_SEVERAL_JOBS[name](spark, str(tmp_path))
        spark.conf.set(setting, before)
        assert Counter(map(str, found.collect())) == plain
    finally:
        spark.conf.set(setting, before)
