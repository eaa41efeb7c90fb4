"""The stages one by one, each against its own input, and the whole run."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tests.llm import plain


def _rows(frame) -> list:
    return [tuple(row) for row in frame.collect()]


def test_stages_keep_the_columns_and_drop_what_they_should(spark, folder_of_all, tmp_path):
    from tests.llm.conftest import ITEMS

    docs = spark.read.parquet(f"{folder_of_all}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    names = list(stages)
    kept = {}
    for name in names[:-1]:
        before, columns = _rows(docs), docs.columns
        out = stages[name](spark, docs, folder_of_all)
        assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = (before, _rows(docs))
        assert not Counter(kept[name][1]) - Counter(before)

    before, after = kept["toxicity"]
    assert Counter(x for x in before if "idiot" not in (x[1] or "")) == Counter(after)

    before, after = kept["exact_dedup"]
    same = {" ".join((x[1] or "a").split(" ")) for x in after}
    assert len(same) <= len(after)
    texts = [__import__("re").sub(r"[\x20\x09-\x0D]+", " ", x[1] or "") for x in before]
    assert len(after) == len(set(texts))

    before, after = kept["simhash_near_dedup"]
    assert len(after) == len(set(plain.near_groups([x[1] or "" for x in before])))

    before, after = kept["benchmark_decontamination"]
    found = plain.contamination([x[1] or "" for x in before], ITEMS)
    clean = [x for x, own in zip(before, found, strict=True) if not own[-1]]
    assert Counter(clean) == Counter(after)

    pieces = stages[names[-1]](spark, docs, folder_of_all).collect()
    lengths = [len(x) for x in plain.token_ids([x[1] or "" for x in after], 0)]
    assert sum(row.length for row in pieces) == sum(lengths)
    assert Counter(row.doc_id for row in pieces if row.piece == 0) == Counter(x[0] for x in after)


def test_the_run_is_its_stages(spark, folder_of_all, folder_of_none):
    assert corpus_pipeline.run(spark, folder_of_none).collect() == []
    found = corpus_pipeline.run(spark, folder_of_all).collect()
    assert found and all(row.length <= 2048 for row in found)
