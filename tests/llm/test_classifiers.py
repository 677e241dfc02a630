import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import crf, quality, queries, samples, toxicity, vectext


def test_marginals_agree_with_plain_forward_backward():
    rng = np.random.default_rng(1)
    sizes = [0, 1, 5, crf.SEGMENT, crf.SEGMENT + 1, 400]
    place = np.cumsum([0, *sizes])
    scores, w = rng.normal(0, 3, place[-1]), np.exp(rng.normal(0, 1, (2, 2)))
    got = crf.posterior(scores, place, w)[0]
    for a, b in zip(place[:-1], place[1:], strict=True):
        if a == b:
            continue
        gain = np.stack([np.ones(b - a), np.exp(scores[a:b])], 1)
        forward, backward = gain.copy(), np.ones_like(gain)
        for t in range(1, b - a):
            forward[t] = forward[t - 1] / forward[t - 1].sum() @ w * gain[t]
        for t in range(b - a - 2, -1, -1):
            backward[t] = w @ (backward[t + 1] * gain[t + 1])
            backward[t] /= backward[t].sum()
        both = forward * backward
        assert np.allclose(got[a:b], both[:, 1] / both.sum(1), atol=1e-12)


def test_word_hashes_depend_on_the_word_only():
    texts = ["Abc def abc", "", None, "x abc", "é" * 50 + " ABC"]
    words = vectext.Words(*vectext.flat(pa.array(texts)), vectext.NOT_SPACE)
    assert np.diff(words.place).tolist() == [3, 0, 0, 2, 2]
    h = words.hashes()
    assert h[0] == h[2] == h[4] == h[6] and len(set(h.tolist())) == 4
    assert words.hashes(2)[0] == vectext.Words(*vectext.flat(pa.array(["ab"])), vectext.NOT_SPACE).hashes()[0]


def good(rng):
    return "\n".join(" ".join(rng.choice(["apple", "river", "stone", "cloud", "green", "quiet", "paper"], 12)) + "." for _ in range(4))


def bad(rng):
    return "\n".join("BUY NOW!! " * 8 for _ in range(4)) if rng.random() < 0.5 else "the the the the the the the the the the the the"


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(8)
    docs, labels = [], []
    for i in range(240):
        q, t = int(rng.random() < 0.6), int(rng.random() < 0.4)
        text = good(rng) if q else bad(rng)
        if t:
            words = text.split(" ")
            for _ in range(2):
                words.insert(int(rng.integers(0, len(words))), str(rng.choice(["vilest", "grimy", "zonkish" + str(rng.integers(9)), "zonkish" + str(rng.integers(9))])))
            text = " ".join(words)
        docs.append((i, text))
        labels.append((i, q, t))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_held_out_accuracy(labelled, module, label):
    docs, labels, known = labelled
    truth = {i: (q if label == "quality" else t) for i, q, t in known}
    rows = module.score(docs, module.train_model(docs, labels)).collect()
    assert len(rows) == 240
    out = [(r.score >= 0.5) == bool(truth[r.doc_id]) for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean(out) > 0.93
    model = module.train_model(docs, labels)
    assert module.fit(*samples.labelled_sample(docs, labels, label)).weights.tolist() == model.weights.tolist()


def test_toxic_spans(labelled):
    docs, labels, _ = labelled
    model = toxicity.train_model(docs, labels)
    text = "é quiet vilest green"
    rows = toxicity.score(docs.sparkSession.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    assert [text[s.start : s.stop] for s in rows[0].spans] == ["vilest"]


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows(labelled, module, odd, clashing, empty):
    docs, labels, _ = labelled
    model = module.train_model(docs, labels)
    for frame in (odd, clashing):
        rows = module.score(frame, model).collect()
        assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)
        scores = {r.doc_id: r.score for r in rows}
        assert scores[3] == scores[4]
    assert module.score(empty, model).count() == 0
    # Nothing to learn from: labels are missing, of one kind, or null.
    for none in (labels.limit(0), labels.filter("quality = 1 and toxic = 0"), labels.select("doc_id", F.lit(None).cast("int").alias("quality"), F.lit(None).cast("int").alias("toxic"))):
        rows = module.score(odd, module.train_model(docs, none)).collect()
        assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)


def test_filters_keep_columns(labelled, clashing):
    docs, labels, _ = labelled
    kept = quality.keep_good(clashing, quality.train_model(docs, labels), 0.0)
    assert kept.columns == clashing.columns and kept.count() == 13
    left = toxicity.drop_toxic(clashing, toxicity.train_model(docs, labels), 1.1)
    assert left.columns == clashing.columns and left.count() == 13


def test_labels_of_the_held_out_fold_are_not_learnt(labelled):
    docs, labels, _ = labelled
    flipped = labels.withColumn("quality", F.when(samples.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.train_model(docs, x) for x in (labels, flipped))
    assert a.weights.tolist() == b.weights.tolist()


@pytest.mark.parametrize("name", ["op6_quality_crf", "op8_toxicity_crf"])
def test_query_columns(spark, sf, sample, name):
    rows = queries.QUERIES[name](spark, sf).collect()
    assert len(rows) == len(sample) and rows[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
