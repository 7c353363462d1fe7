"""The pipeline stage by stage, against brute force on each stage's own input."""

import re

import pytest

import corpus_pipeline
from quire.llm import packing
from quire.session import ensure_checkpoint_dir
from tests.llm import edge

SF = "/root/testdata/sf0.001"


def _rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    ensure_checkpoint_dir(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, out[-1][1], SF).write.parquet(path)
        out.append((name, spark.read.parquet(path)))
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "ngram_jaccard_join", "suffix_array_dedup", "personal_data", "best_fit_packing"]
    for _, df in stages[1:5]:
        assert df.dtypes == stages[0][1].dtypes


def test_quality_keeps_clean_rows(spark, stages):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {i for i, _ in _rows(stages[1][1])}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.97 * len(good)


def test_one_of_each_group_stays(stages):
    before = _rows(stages[1][1])
    want = {c if n else i for i, n, c in edge.jaccard_components(before, 5, 80)}
    assert {i for i, _ in _rows(stages[2][1])} == want


def test_repeated_passages_are_cut(stages):
    before = sorted(_rows(stages[2][1]))
    after = dict(_rows(stages[3][1]))
    for (i, _), (b, covered) in zip(before, edge.repeated_bytes([t for _, t in before], 200), strict=True):
        assert after[i] == bytes(x for x, c in zip(b, covered, strict=True) if not c).decode("utf-8", "ignore")


def test_personal_data_is_gone(stages):
    for i, text in _rows(stages[4][1]):
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text or ""), i


def test_everything_is_packed(spark, stages):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.vocabulary())
    sizes = {}
    for r in stages[5][1].collect():
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert sizes == {i: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in _rows(stages[4][1])}


def test_awkward_rows_pass(spark, tmp_path):
    docs = edge.stored_documents(spark, str(tmp_path / "d"))
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.count() > 0
