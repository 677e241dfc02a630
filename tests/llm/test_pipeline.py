"""The pipeline against a plain version of its last three stages, each judged on its own input."""

import re

import pytest

import corpus_pipeline
from test_dedup import brute_components


def test_stages_in_order(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        assert docs.columns == columns
        after = {r.doc_id for r in docs.collect()}
        assert after <= {r.doc_id for r in before}
        kept[name] = ({r.doc_id: r.text for r in before}, after)

    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    before, after = kept["quality classifier"]
    clean = [i for i in before if i in labels and labels[i].quality == 1]
    assert sum(i in after for i in clean) >= 0.95 * len(clean)

    before, after = kept["exact dedup"]
    first = {}
    for i in sorted(before):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i] or ""), i)
    assert after == set(first.values())

    before, after = kept["minhash near-dedup"]
    components, _ = brute_components(before.items(), 5, 80)
    assert after == {i for i, c in components.items() if i == c}


def test_run(spark, sf):
    import os

    from sedimenta.session import ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(rows[0].asDict())
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows)
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and os.listdir(f"{folder}/{next(iter(left))}") == ["4"]


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_stages_on_odd_rows(spark, odd, clashing, empty, sf, stage):
    """Null and empty texts, repeated rows and ids, a row without an id, clashing columns, an empty table."""
    for docs in (odd, clashing):
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        kept = [(r.doc_id, r.text) for r in out.collect()]
        given = [(r.doc_id, r.text) for r in docs.collect()]
        assert all(kept.count(x) == given.count(x) for x in set(kept))
        if stage in (corpus_pipeline.exact_deduplication, corpus_pipeline.near_deduplication):
            ids = sorted(i for i, _ in kept if i is not None)
            exact = stage is corpus_pipeline.exact_deduplication
            assert ids == ([1, 3, 5, 6, 7, 8, 8, 9, 10, 11] if exact else [1, 3, 4, 5, 6, 8, 8, 9, 10, 11])
            assert (None, "a text without an id") in kept
    assert stage(spark, empty, sf).count() == 0


def test_stages_tell_rows_of_one_id_apart(spark, sf):
    text = lambda k, n: " ".join(f"{k}{i}" if i != n else "other" for i in range(90))
    rows = spark.createDataFrame([(1, text("a", -1)), (5, text("a", 89)), (5, text("b", -1)), (9, text("b", 89)), (12, text("b", -1))], "doc_id long, text string")
    kept = lambda stage: sorted((r.doc_id, r.text[:2]) for r in stage(spark, rows, sf).collect())
    assert kept(corpus_pipeline.exact_deduplication) == [(1, "a0"), (5, "a0"), (5, "b0"), (9, "b0")]
    assert kept(corpus_pipeline.near_deduplication) == [(1, "a0"), (5, "b0")]


def test_toxic_documents_go_and_packing_is_whole(spark, sf):
    """The toxicity stage agrees with the scores of its operator, and the last stage packs just what is left."""
    from tokenizers import Tokenizer

    from sedimenta.llm import bpe, toxicity
    from test_texts import check_packed

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.toxicity_filter(spark, docs, sf).collect()}
    scores = toxicity.score(docs, toxicity.train_model(docs, spark.read.parquet(f"{sf}/labels.parquet"))).collect()
    assert kept == {r.doc_id for r in scores if r.score < 0.7}
    some = docs.filter("doc_id % 3 = 0")
    check_packed(corpus_pipeline.best_fit_packing(spark, some, sf).collect(), [(r.doc_id, r.text) for r in some.collect()], Tokenizer.from_file(bpe.tokenizer_path()))
