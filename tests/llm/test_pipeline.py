"""The pipeline's stages, each against a plain version on its own input."""

import numpy as np
import pytest

import corpus_pipeline
from lakewarden.llm.queries import WORD_BPE, tokenizer_path
from tests.llm.conftest import SF_DIR, words_of
from tests.llm.test_dedup import expected_rest, roots, shingles


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    out = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF_DIR).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return [o.toPandas() for o in out]


def test_columns(steps):
    assert all(tuple(s.columns) == corpus_pipeline.COLUMNS for s in steps[:-1])


def test_filters_keep_texts(steps):
    for before, after in ((steps[0], steps[1]), (steps[1], steps[2]), (steps[2], steps[3])):
        same = after.merge(before, on=list(corpus_pipeline.COLUMNS))
        assert 0 < len(after) <= len(before)
        assert len(same) == len(after)


def test_quality(spark, steps):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas()
    kept = labels[labels.doc_id.isin(steps[1].doc_id)]
    assert (kept.quality == 1).mean() > 0.97
    assert len(kept[kept.quality == 1]) > 0.97 * (labels.quality == 1).sum()


def test_near_duplicates(steps):
    sets = {r.doc_id: shingles(r.text, 5) for r in steps[2].itertuples()}
    low = roots(sorted(sets), lambda a, b: a < b and 0 < 80 * len(sets[a] | sets[b]) <= 100 * len(sets[a] & sets[b]))
    assert sorted(steps[3].doc_id) == sorted(i for i in low if low[i] == i)


def test_passages(steps):
    rest = {k[0]: k for k in expected_rest([(r.doc_id, r.text) for r in steps[3].itertuples()], 35)}
    before = steps[3].set_index("doc_id").text
    for r in steps[4].itertuples():
        _, total, gone, _ = rest[r.doc_id]
        assert len(words_of(r.text)) == total - gone
        assert gone or r.text == before[r.doc_id]


def test_packing(steps):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path(WORD_BPE))
    sizes = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in steps[4].itertuples()}
    assert steps[5].groupby("doc_id").length.sum().to_dict() == sizes
    full = steps[5].groupby("sequence_id").length.sum()
    assert full.max() <= 4096
    assert len(full) <= int(np.ceil(1.05 * sum(sizes.values()) / 4096)) + 1


def test_run(spark, steps):
    assert corpus_pipeline.run(spark, SF_DIR).count() == len(steps[5])


def test_awkward_rows(spark, docs, none):
    for frame in (docs, none):
        now = frame
        for _, stage in corpus_pipeline.STAGES[1:]:
            now = stage(spark, now, SF_DIR)
        now.count()
