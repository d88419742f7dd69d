"""Every stage against a plain version of it, and the whole run."""

import re
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from llm.test_near_copies import plain_groups
from tokenizers import Tokenizer

from stratamart.llm import pii, quality, toxicity
from stratamart.llm.common import materialise, table

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The input of each stage and what it returned, as dicts by doc_id."""
    docs, seen = table(spark, FOLDER, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        result = materialise(stage(spark, docs, FOLDER), name)
        seen.append((name, docs, result))
        docs = result
    return {name: (before, after) for name, before, after in seen}


def _texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_order_and_columns(stages):
    assert list(stages) == ["toxicity", "quality", "near_duplicates", "personal_data", "packing"]
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == list(corpus_pipeline.COLUMNS) == before.columns


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    score = toxicity.train(before, table(spark, FOLDER, "labels")).scorer()
    assert _texts(after) == {d: t for d, t in _texts(before).items() if score(t or "") < 0.5}
    labels = {r.doc_id: r.toxic for r in table(spark, FOLDER, "labels").collect()}
    clean = {d for d, toxic in labels.items() if toxic == 0}
    assert len(clean - set(_texts(after))) <= 0.02 * len(clean)


def test_quality(spark, stages):
    before, after = stages["quality"]
    score = quality.train(before).scorer()
    assert _texts(after) == {d: t for d, t in _texts(before).items() if score(t or "") >= quality.REJECT_BELOW}
    labels = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    good = {d for d in _texts(before) if labels.get(d) == 1}
    assert len(good - set(_texts(after))) <= 0.01 * len(good)


def test_near_duplicates(stages):
    before, after = (_texts(df) for df in stages["near_duplicates"])
    pairs = sorted(before.items())
    kept = {min(pairs[i][0] for i in group) for group in plain_groups(pairs)}
    assert after == {d: t for d, t in before.items() if d in kept}


def test_personal_data(stages):
    before, after = stages["personal_data"]
    assert _texts(after) == {d: pii.redact_text(t) for d, t in _texts(before).items()}
    assert not any(pii.find_spans(t) for t in _texts(after).values())
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    assert any(email.search(t) for t in _texts(before).values())
    assert not any(email.search(t) for t in _texts(after).values())
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_packing(stages):
    before, after = stages["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for doc, text in _texts(before).items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expected.append((doc, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    rows = after.collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    assert len({r.sequence_id for r in rows}) <= 1.02 * sum(r.length for r in rows) / 4096 + 1


def test_odd_rows(spark, make_docs, odd_texts, tmp_path):
    docs = make_docs(odd_texts)
    spark.createDataFrame([(4, 1, 0), (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == list(corpus_pipeline.COLUMNS)
    left = [r.doc_id for r in docs.collect()]
    assert 4 in left and 5 not in left and 6 in left
    assert corpus_pipeline.pack_sequences(spark, docs, str(tmp_path)).count() >= len(left)


def test_empty_tables(spark, make_docs, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = make_docs([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    assert docs.count() == 0


def test_run(spark, stages):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r.doc_id, r.piece) for r in rows) == sorted((r.doc_id, r.piece) for r in stages["packing"][1].collect())
