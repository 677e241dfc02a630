"""Document quality by a linear-chain CRF over lines (operator 6).

Every line of a text is labelled good or bad from its own features and those of the lines before and after it; the
marginals of forward-backward, weighted by the length of the lines, give the score of the document. Labels are known
for documents only: lines take their document's label at first, then the lines of bad documents that look good to
the first chain are taken as good, and the chain is trained again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import crf, samples, vectext

_CLASSES = [
    bytes(range(65, 91)),
    bytes(range(97, 123)),
    bytes(range(48, 58)),
    b" \t\x0b\x0c\r",
    b"!",
    b"$%*&#@^~=+_<>{}[]\\/",
    b"|",
    b".,;:?'\"()-",
    bytes(range(128, 256)),
    bytes([*range(9), *range(14, 32), 127]),
]
_MASKS = np.stack([vectext.byte_class(c) for c in _CLASSES])
_NOT_NEWLINE = ~vectext.byte_class(b"\n")
#: Lines of one text whose marginals are taken at a time.
WINDOW = 1 << 18


#: Lines whose features are made at a time.
LINES = 1 << 13


class Lines(vectext.Words):
    """The lines of all texts of a block that have a byte, and how often each is in its text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        super().__init__(data, offsets, _NOT_NEWLINE)
        self.size = (self.ends - self.starts).astype(float)
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.place))
        _, back, times = np.unique(vectext.mix(self.hashes() ^ text.astype(np.uint64)), return_inverse=True, return_counts=True)
        self.times = times[back]

    def ranges(self, limit: int = LINES) -> Iterator[tuple[int, int]]:
        """Ranges of at most limit lines and about a window of bytes."""
        first = 0
        while first < len(self):
            last = int(np.searchsorted(self.starts, self.starts[first] + vectext.WINDOW))
            last = max(first + 1, min(last, first + limit))
            yield first, last
            first = last

    def _here(self, first: int, last: int) -> np.ndarray:
        """The own features of lines first to last."""
        base, stop = int(self.starts[first]), int(self.ends[last - 1])
        data = self.data[base:stop]
        starts, ends, size = self.starts[first:last] - base, self.ends[first:last] - base, self.size[first:last]
        columns = [vectext.sums_within(data, starts, ends, mask) / size for mask in _MASKS]
        words = vectext.Words(data, np.unique(np.clip(self.offsets - base, 0, len(data))), vectext.NOT_SPACE)
        hashes = words.hashes()
        owner = np.searchsorted(starts, words.starts, "right") - 1
        count = np.bincount(owner, minlength=len(starts)).astype(float)
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        repeats = np.bincount(owner[again], minlength=len(starts)) / np.maximum(count, 1)
        keys = np.unique((owner.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
        distinct = np.bincount((keys >> np.uint64(40)).astype(np.int64), minlength=len(starts)) / np.maximum(count, 1)
        length = np.bincount(owner, words.ends - words.starts, minlength=len(starts)) / np.maximum(count, 1)
        upper, _, _, _, bang, symbol, pipe = columns[:7]
        columns += [
            np.minimum(length / 20, 3),
            repeats,
            distinct,
            np.log1p(size) / 10,
            np.log1p(count) / 10,
            np.log1p(self.times[first:last] - 1) / 3,
            (repeats > 0.3).astype(float),
            (distinct < 0.4).astype(float) * (count > 8),
            (upper > 0.4).astype(float) * (size > 8),
            np.tanh(8 * bang),
            np.tanh(8 * symbol),
            np.tanh(8 * pipe),
            (length > 25).astype(float),
            (count < 3).astype(float),
        ]
        return np.stack(columns, 1)

    def features(self, first: int, last: int) -> np.ndarray:
        """The features of lines first to last: their own, and those of the lines before and after them in their text."""
        low, high = max(first - 1, 0), min(last + 1, len(self))
        own = self._here(low, high)
        begins = np.zeros(high - low + 1, bool)
        begins[self.place[(self.place >= low) & (self.place <= high)] - low] = True
        before, after = np.roll(own, 1, 0), np.roll(own, -1, 0)
        before[begins[:-1]] = 0
        after[begins[1:]] = 0
        return np.hstack([own, before, after])[first - low : last - low]


def _document(good: np.ndarray, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Features of each text: length-weighted mean of the chance of a good line, its log-odds, and the share of lines that are rather bad."""
    n = len(place) - 1
    owner = np.repeat(np.arange(n), np.diff(place))
    total = np.bincount(owner, size, minlength=n)
    mean = np.bincount(owner, size * good, minlength=n) / np.maximum(total, 1)
    mean[total == 0] = 0.5
    bad = np.bincount(owner, size * (good < 0.5), minlength=n) / np.maximum(total, 1)
    odds = np.log((mean + 1e-3) / (1 - mean + 1e-3))
    return np.stack([mean, odds, bad], 1)


@dataclass
class Model:
    chain: crf.Chain | None
    weights: np.ndarray | None
    prior: float

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.chain is None:
            return np.full(len(offsets) - 1, self.prior)
        lines = Lines(data, offsets)
        scores = np.empty(len(lines))
        for first, last in lines.ranges():
            scores[first:last] = self.chain.scores(None, lines.features(first, last))
        if len(offsets) > 2 or len(lines) <= WINDOW:
            good = np.concatenate([np.zeros(0), *(p for _, _, p in self.chain.windows(scores, lines.place, WINDOW))])
            return crf.apply_logistic(self.weights, _document(good, lines.place, lines.size))
        sums = np.zeros(2)
        for first, last, good in self.chain.windows(scores, lines.place, WINDOW):
            size = lines.size[first:last]
            sums += [(size * good).sum(), (size * (good < 0.5)).sum()]
        mean, bad = sums / lines.size.sum()
        return crf.apply_logistic(self.weights, np.array([[mean, np.log((mean + 1e-3) / (1 - mean + 1e-3)), bad]]))


def fit(sample: pa.Table, seen: list[int]) -> Model:
    """A model of (text, label) rows, seen being how many rows of either label there are outside the sample too."""
    labels = np.asarray(sample["label"].combine_chunks()).astype(int)
    prior = (seen[1] + 1) / (sum(seen) + 2)
    if len(set(labels.tolist())) < 2:
        return Model(None, None, prior)
    texts = sample["text"].combine_chunks()
    # By blocks, for the driver's memory.
    parts = [Lines(*vectext.flat(texts.slice(start, stop - start))) for start, stop in vectext.blocks(texts)]
    none = np.zeros((0, 3 * (len(_CLASSES) + 14)))
    values, size = np.concatenate([none, *(p.features(*r) for p in parts for r in p.ranges())]), np.concatenate([p.size for p in parts])
    place = np.cumsum(np.concatenate([np.zeros(1, np.int64), *(np.diff(p.place) for p in parts)]))
    owner = np.repeat(np.arange(len(labels)), np.diff(place))
    y = labels[owner].astype(float)
    chain = crf.train(None, values, place, y, epochs=4, batch_positions=6000, rate=0.05, least_steps=100)
    good = chain.marginals(None, values, place)
    looks = np.where(y == 0, good >= 0.5, True)
    every = np.bincount(owner, looks, minlength=len(labels)) == np.diff(place)
    y = np.where((y == 0) & looks & ~every[owner], 1.0, y)
    chain = crf.train(None, values, place, y, epochs=8, batch_positions=6000, rate=0.05, least_steps=200)
    features = _document(chain.marginals(None, values, place), place, size)
    share = np.array(seen) / np.maximum(np.bincount(labels, minlength=2), 1)
    return Model(chain, crf.logistic(features, labels, share[labels] / share.max()), prior)


def _scorer(model: Model):
    def run(batches):
        vectext.release()
        for batch in batches:
            for start, stop in vectext.blocks(batch.column(1)):
                scores = model.score(*vectext.flat(batch.column(1).slice(start, stop - start)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, stop - start), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return run


def train_model(docs: DataFrame, labels: DataFrame, **bounds: int) -> Model:
    return fit(*samples.labelled_sample(docs, labels, "quality", **bounds))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score), a row for each row of docs: the chance that the document is good, 0 to 1.

    Every text is scored whole; one text of many megabytes takes a worker some 60 bytes for each of its lines, and for
    each word of its longest line. Null counts as empty; a text without lines has the score of a document that is as
    often good as bad by its lines, moved by the share of good documents. Without labels of both kinds the score is
    the share of good labels, or 0.5. Scores depend on the text only, so repeated rows have equal ones. Further
    columns are not read.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_scorer(model), "doc_id long, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, whose score is threshold or more. Nothing is shuffled."""
    at = docs.columns.index(text_col)
    return docs.mapInArrow(samples.row_filter(model_scores(model), at, lambda s: s >= threshold), docs.schema)


def model_scores(model: Model):
    return lambda column: model.score(*vectext.flat(column))
