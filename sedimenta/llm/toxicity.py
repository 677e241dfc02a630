"""Toxic spans by a linear-chain CRF over words (operator 8).

Words of a text are tagged toxic or not from hashes of the word, of its beginnings and of its neighbours. Marginals of
forward-backward give the offending places and, aggregated, the score of the document. Labels are known for documents
only, so the tags to learn from are found first: a word (or a beginning of words) that occurs in so many toxic and so
few other documents that chance does not explain it marks the words of toxic documents; all words of other documents
are clean.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import crf, samples, vectext

TABLE_BITS = 20
#: Bytes of the beginnings of a word that count as features of it, the whole word aside.
PREFIXES = (4, 5, 6)
#: A feature marks toxic words when its share of toxic documents is beyond chance by MARGIN nats more than the logarithm of
#: how many features are looked at, it is in TIMES toxic documents at least, and its odds are LIFT times the usual.
MARGIN, TIMES, LIFT = 1.0, 3, 8.0
#: Documents of the sample in which a feature must be to have a weight.
SUPPORT = 3


#: Words of one text whose features or marginals are made at a time.
WINDOW = 1 << 18


def word_features(words: vectext.Words, first: int, last: int) -> np.ndarray:
    """Feature ids of words first to last: the word, its beginnings, the word before, the word after."""
    low, high = max(first - 1, 0), min(last + 1, len(words))
    near = words.hashes(None, low, high)
    begins = np.zeros(high - low + 1, bool)
    begins[words.place[(words.place >= low) & (words.place <= high)] - low] = True
    before, after = np.roll(near, 1), np.roll(near, -1)
    before[begins[:-1]] = 0
    after[begins[1:]] = 0
    own = slice(first - low, last - low)
    mask = np.uint64((1 << TABLE_BITS) - 1)
    columns = [near[own], *(words.hashes(k, first, last) for k in PREFIXES), before[own], after[own]]
    return np.stack([vectext.mix(h + np.uint64(k + 1)) & mask for k, h in enumerate(columns)], 1).astype(np.int32)


def words_of(data: np.ndarray, offsets: np.ndarray) -> vectext.Words:
    return vectext.Words(data, offsets, vectext.ALNUM)


def _minima(words: vectext.Words) -> np.ndarray:
    """By text, three minima of hashes of four successive words."""
    none = (np.uint64(0),) * 3
    rows = [tuple(h.min() for h in (s, ~s, vectext.mix(s))) if len(s) else none for s in vectext.shingle_sets(words, 4)]
    return np.array(rows, np.uint64).reshape(-1, 3)


def _originals(minima: np.ndarray) -> np.ndarray:
    """By text, the first of those that seem to be copies of it: their minima agree."""
    _, first, back = np.unique(minima, axis=0, return_index=True, return_inverse=True)
    return first[back.ravel()]


def _seeds(ids: np.ndarray, place: np.ndarray, original: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features whose toxic documents are too many for chance, features in SUPPORT documents), tables of booleans. Copies count once."""
    size = 1 << TABLE_BITS
    owner = np.repeat(original, np.diff(place)).astype(np.int64)
    tables = np.zeros((2, size))
    for column in ids.T:
        pairs = np.unique(owner * size + column)
        tables += np.stack([np.bincount(pairs[labels[pairs // size] == k] % size, minlength=size) for k in (0, 1)])
    clean, toxic = tables
    n, base = clean + toxic, labels[np.unique(original)].mean()
    share = np.clip(toxic / np.maximum(n, 1), 1e-9, 1 - 1e-9)
    surprise = n * (share * np.log(share / base) + (1 - share) * np.log((1 - share) / (1 - base)))
    odds = (toxic + 0.5) / (clean + 0.5) * (1 - base) / base
    needed = np.log(max((n >= TIMES).sum(), 1)) + MARGIN
    return (share > base) & (toxic >= TIMES) & (surprise >= needed) & (odds >= LIFT), n >= SUPPORT


def _sums(toxic: np.ndarray, place: np.ndarray) -> np.ndarray:
    """By text: the expected number of toxic words among those that may well be, and the marginal of the worst word.

    Words that are almost surely clean are left out, or many of them would add up in a long text.
    """
    n = len(place) - 1
    owner = np.repeat(np.arange(n), np.diff(place))
    expected = np.bincount(owner, np.where(toxic >= 0.25, toxic, 0.0), minlength=n)
    worst = np.zeros(n)
    full = np.diff(place) > 0
    if len(toxic):
        worst[full] = np.maximum.reduceat(toxic, place[:-1][full])
    return np.stack([expected, worst], 1)


def _document(sums: np.ndarray) -> np.ndarray:
    """Features of each text: logarithm of the expected number of toxic words, and the log-odds of the worst one."""
    worst = np.clip(sums[:, 1], 1e-4, 1 - 1e-4)
    return np.stack([np.log(sums[:, 0] + 1e-2), np.log(worst / (1 - worst))], 1)


@dataclass
class Model:
    chain: crf.Chain | None
    weights: np.ndarray | None
    prior: float

    def score(self, data: np.ndarray, offsets: np.ndarray, threshold: float = 0.5) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray], vectext.Words | None]:
        """(score by text, (numbers of words with a toxic marginal of threshold or more, those marginals), words)."""
        none = np.zeros(0, np.int64), np.zeros(0)
        if self.chain is None:
            return np.full(len(offsets) - 1, self.prior), none, None
        words = words_of(data, offsets)
        scores = np.empty(len(words))
        for first, last in words.ranges(WINDOW):
            scores[first:last] = self.chain.scores(word_features(words, first, last), None)
        hits, features = [], np.zeros((0, 2))
        for first, last, toxic in self.chain.windows(scores, words.place, WINDOW):
            at = np.flatnonzero(toxic >= threshold)
            hits.append((at + first, toxic[at]))
            features = np.concatenate([features, _sums(toxic, words.place if last - first == len(words) else np.array([0, last - first]))])
        if len(offsets) == 2:  # one text, perhaps in several windows, the last one first
            features = np.array([[features[:, 0].sum(), features[:, 1].max(initial=0.0)]])
        elif not len(words):
            features = np.zeros((len(offsets) - 1, 2))
        hits.reverse()
        found = (np.concatenate([h[k] for h in hits]) for k in (0, 1)) if hits else none
        return crf.apply_logistic(self.weights, _document(features)), tuple(found), words


def fit(sample: pa.Table, seen: list[int]) -> Model:
    labels = np.asarray(sample["label"].combine_chunks()).astype(int)
    prior = (seen[1] + 1) / (sum(seen) + 2)
    if len(set(labels.tolist())) < 2:
        return Model(None, None, prior)
    texts = sample["text"].combine_chunks()
    parts, counts, minima = [], [np.zeros(1, np.int64)], []
    for start, stop in vectext.blocks(texts):  # by blocks, for the driver's memory
        words = words_of(*vectext.flat(texts.slice(start, stop - start)))
        parts.append(word_features(words, 0, len(words)) if len(words) else np.zeros((0, 3 + len(PREFIXES)), np.int32))
        counts.append(np.diff(words.place))
        minima.append(_minima(words))
    ids, place = np.concatenate(parts), np.cumsum(np.concatenate(counts))
    owner = np.repeat(np.arange(len(labels)), np.diff(place))
    seeds, supported = _seeds(ids, place, _originals(np.concatenate(minima)), labels)
    marked = seeds[ids[:, : 1 + len(PREFIXES)]].any(1) & (labels[owner] == 1)
    # Rare features share a slot whose weight is then taken away, so that they tell nothing.
    none = int(np.flatnonzero(~supported)[0]) if not supported.all() else 0
    ids = np.where(supported[ids], ids, none)
    chain = crf.train(ids, None, place, marked.astype(float), n_sparse=1 << TABLE_BITS, epochs=4, batch_positions=30_000, rate=0.05, l2=1e-5, least_steps=150)
    chain.sparse[~supported] = 0.0
    features = _document(_sums(chain.marginals(ids, None, place), place))
    share = np.array(seen) / np.maximum(np.bincount(labels, minlength=2), 1)
    return Model(chain, crf.logistic(features, labels, share[labels] / share.max()), prior)


def _spans(found: tuple[np.ndarray, np.ndarray], words: vectext.Words) -> list[list[dict]]:
    """By text, runs of neighbouring words among those found: (start, stop) in characters, and the highest marginal."""
    out: list[list[dict]] = [[] for _ in range(len(words.place) - 1)]
    hits, toxic = found
    if not len(hits):
        return out
    text = np.searchsorted(words.place, hits, "right") - 1
    opens = np.ones(len(hits), bool)
    opens[1:] = (np.diff(hits) > 1) | (np.diff(text) > 0)
    begin = np.flatnonzero(opens)
    end = np.append(begin[1:], len(hits)) - 1
    top = np.maximum.reduceat(toxic, begin)
    # Characters up to each place: places come in order, so what is between two of them is counted once.
    places = np.stack([words.offsets[text[begin]], words.starts[hits[begin]], words.ends[hits[end]]], 1).ravel()
    marks, back = np.unique(places, return_inverse=True)
    counted = np.cumsum(vectext.sums_within(words.data, np.concatenate([[0], marks[:-1]]), marks, _BEGINS))[back.ravel()].reshape(-1, 3)
    for k, (base, start, stop) in enumerate(counted.tolist()):
        out[text[begin[k]]].append({"start": start - base, "stop": stop - base, "score": float(top[k])})
    return out


#: Bytes that begin a character.
_BEGINS = np.array([b & 0xC0 != 0x80 for b in range(256)])
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))


def _scorer(model: Model, threshold: float):
    def run(batches):
        vectext.release()
        for batch in batches:
            for start, stop in vectext.blocks(batch.column(1)):
                scores, found, words = model.score(*vectext.flat(batch.column(1).slice(start, stop - start)), threshold)
                spans = _spans(found, words) if words is not None else [[]] * (stop - start)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.array(scores, pa.float64()), pa.array(spans, _SPANS)], ["doc_id", "score", "spans"])

    return run


def train_model(docs: DataFrame, labels: DataFrame, **bounds: int) -> Model:
    return fit(*samples.labelled_sample(docs, labels, "toxic", **bounds))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", span_threshold: float = 0.5) -> DataFrame:
    """(doc_id, score, spans), a row for each row of docs.

    score is the chance that the document is toxic, 0 to 1; spans are the offending places as (start, stop, score),
    in characters of the text. Every text is scored whole; one text of many megabytes takes a worker some 30 bytes for
    each of its words. Null counts as empty: no spans, and the score of a text
    without a toxic word. Without labels of both kinds the score is the share of toxic labels, or 0.5. Repeated rows
    have equal results; further columns are not read.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _scorer(model, span_threshold), "doc_id long, score double, spans array<struct<start:int,stop:int,score:double>>"
    )


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, whose score is below threshold. Nothing is shuffled."""
    at = docs.columns.index(text_col)
    return docs.mapInArrow(samples.row_filter(lambda column: model.score(*vectext.flat(column))[0], at, lambda s: s < threshold), docs.schema)
