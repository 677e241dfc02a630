"""BPE encoding by content-defined chunk reuse (operator 5), and the decoding of what it gives.

The bytes of a text are cut where a rolling hash of the last ROLLED bytes has CUT_BITS clear bits, so a passage that
several documents share is cut into the same chunks wherever it stands. Documents that share chunks are brought
together: they are dealt and sorted by the smallest of their chunks' hashes, so that a chunk's copies meet in one
worker, where it is encoded once and kept (by digest, CHUNK_BYTES_KEPT at most). Only chunks that are not there, and
joins, are encoded: their words are looked up, and those that no earlier chunk had go through the tokenizer.

A chunk is kept as the ids of what lies between its first and its last white space, and the bytes before and after.
The tokenizer drops white space and never joins across it, so those ids are the same in any text. Ends may be halves
of a word: each join of chunks is repaired by encoding the end of one and the beginning of the next together, and goes
on over further chunks until white space is met on both sides; there the ids agree exactly with those of the whole
text.

A single text of more than a block is taken window by window, in chunks too, so that its ids are never all in memory.
One word of many megabytes is given to the tokenizer whole, as the library's own result for it needs.
"""

from __future__ import annotations

import hashlib
import io
import itertools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from sedimenta.llm import vectext

TOKENIZER = "word_bpe_49k.json"
#: Bytes that the rolling hash sees, bits of it that are clear at a cut (so chunks have about 2**CUT_BITS bytes), bytes of a chunk at least.
ROLLED, CUT_BITS, LEAST = 16, 9, 64
#: What a worker keeps of words and of chunks, in bytes.
WORD_BYTES_KEPT, CHUNK_BYTES_KEPT = 128 << 20, 32 << 20

_HEAD, _UP_TO_TAIL = re.compile(rb"[^ \t\n\x0b\x0c\r]*"), re.compile(rb".*[ \t\n\x0b\x0c\r]", re.S)

_GEAR = (np.random.default_rng(977).integers(0, 1 << 32, 256, dtype=np.uint64)).astype(np.uint32)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cut_points(data: np.ndarray) -> np.ndarray:
    """Places of one text, after its first ROLLED bytes, where a gear hash of the ROLLED bytes before it (by doubling) says that a chunk ends."""
    found = []
    for low in range(0, len(data), vectext.WINDOW):
        left = max(low - ROLLED + 1, 0)
        value = _GEAR[data[left : low + vectext.WINDOW]]
        width = 1
        with np.errstate(over="ignore"):
            while width < ROLLED:
                further = value.copy()
                further[width:] += value[:-width] << np.uint32(width)
                value, width = further, 2 * width
        # The oldest byte of the window still reaches the bits just below ROLLED.
        cut = (value >> np.uint32(ROLLED - CUT_BITS)) & np.uint32((1 << CUT_BITS) - 1) == 0
        cut[: ROLLED - 1] = False
        found.append(np.flatnonzero(cut) + left + 1)
    return np.concatenate([np.zeros(0, np.int64), *found])


def chunk_ranges(data: np.ndarray, base: int = 0) -> list[tuple[int, int]]:
    """The chunks of one text, as ranges moved by base: LEAST bytes at least (but for the last), whole characters, and where they end depends on the bytes alone."""
    cuts = cut_points(data)
    for _ in range(3):  # never within a character
        cuts = cuts[cuts < len(data)]
        cuts = cuts + (data[cuts] & 0xC0 == 0x80)
    out, at = [], 0
    for cut in cuts.tolist():
        if cut - at >= LEAST and cut < len(data):
            out.append((at + base, cut + base))
            at = cut
    if at < len(data):
        out.append((at + base, len(data) + base))
    return out


class WordCodec:
    """Token ids of words (runs without ASCII white space) as little-endian uint32, each distinct word encoded once while it is cached.

    Unknown words are encoded many at a time, with a special token between them that then parts their ids; words that
    hold the beginning of a special token's name are encoded alone.
    """

    kept_most = WORD_BYTES_KEPT

    def __init__(self, path: str):
        # One thread a worker: Spark runs as many workers as there are cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = [(i, t) for i, t in sorted(self.tokenizer.get_added_tokens_decoder().items()) if t.special and not (t.normalized or t.single_word or t.lstrip or t.rstrip)]
        self.mark = (special[0][0], special[0][1].content) if special else None
        self.words: dict[bytes, bytes] = {}
        self.kept_bytes = 0

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: set[bytes]) -> None:
        """Afterwards the cache has all of words; others may have gone."""
        if self.kept_bytes > self.kept_most:
            self.words.clear()
            self.kept_bytes = 0
        new = [w for w in words if w not in self.words]
        joint = [w for w in new if self.mark and b"<" not in w]
        alone = [w for w in new if not self.mark or b"<" in w]
        for word, ids in zip(alone, self._ids([w.decode() for w in alone]), strict=True):
            self.words[word] = np.array(ids, "<u4").tobytes()
        for k in range(0, len(joint), 4096):
            part = joint[k : k + 4096]
            number, name = self.mark
            ids = np.array(self._ids([name.join([w.decode() for w in part])])[0], "<u4")
            cuts = np.flatnonzero(ids == number)
            raw = ids.tobytes()
            for word, begin, end in zip(part, [0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), len(raw)], strict=True):
                self.words[word] = raw[begin:end]
        self.kept_bytes += sum(5 * len(w) + 180 for w in new)

    def encode(self, words: list[bytes]) -> bytes:
        """The ids of words, one after another."""
        known = self.words
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            self.learn(set(words))
            return b"".join([known[w] for w in words])


_ALNUM = vectext.byte_class(bytes([*range(48, 58), *range(65, 91), *range(97, 123)]))
_MARKS = vectext.byte_class(bytes(c for c in range(33, 127) if not chr(c).isalnum()))


def _unit_starts(data: np.ndarray) -> np.ndarray:
    """Marks that follow an ASCII letter or digit: the tokenizer's pieces never cross the place before one."""
    out = np.zeros(len(data), bool)
    out[1:] = _MARKS[data[1:]] & _ALNUM[data[:-1]]
    return out


class BlockCodec(WordCodec):
    """Ids of all texts of a block at once: only its distinct units are looked up.

    Units are words, cut before a mark that follows an ASCII letter or digit. The tokenizer's pieces never cross such
    a place, so the ids are those of the whole text; a block with the name of a special token is cut into words only.
    """

    def __init__(self, path: str):
        super().__init__(path)
        self.names = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]

    def encode_texts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin)."""
        raw = data.tobytes()
        special = any(name in raw for name in self.names)
        units = vectext.Words(data, offsets, vectext.NOT_SPACE, lower=False, split=None if special else _unit_starts)
        if not len(units):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        _, first, back = np.unique(units.hashes(), return_index=True, return_inverse=True)
        distinct = [raw[a:b] for a, b in zip(units.starts[first].tolist(), units.ends[first].tolist(), strict=True)]
        self.learn(set(distinct))
        parts = [self.words[u] for u in distinct]
        store = np.frombuffer(b"".join(parts), "<u4")
        sizes = np.array([len(p) // 4 for p in parts])
        begin, count = (np.cumsum(sizes) - sizes)[back], sizes[back]
        ends = np.cumsum(count)
        ids = store[np.repeat(begin - ends + count, count) + np.arange(ends[-1])]
        return ids, np.concatenate([[0], ends])[units.place]

    def encode_windows(self, data: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of one text, window by window; no token crosses white space, where windows end."""
        for start, stop in vectext.windows(data):
            part = data[start:stop]
            yield self.encode_texts(part, np.array([0, len(part)]))[0]


class ChunkCodec(BlockCodec):
    """Encodes texts chunk by chunk, with a bounded cache of chunks; see the module's text."""

    kept_most = 112 << 20

    def __init__(self, path: str):
        super().__init__(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        names = [self.tokenizer.id_to_token(i) for i in range(size)]
        #: Ids as decimal text, and as tokens; the tokenizer's decoding joins tokens by spaces.
        self.decimal, self.tokens = [str(i).encode() for i in range(size)], [(n or "").encode() for n in names]
        #: (bytes before the first white space, ids up to the last one or None if there is none, bytes after it) by digest.
        self.chunks: dict[bytes, tuple[bytes, bytes | None, bytes]] = {}
        self.chunk_bytes = 0
        #: Bytes of chunks that were seen, and of what had to be encoded for chunks and for joins.
        self.seen = self.encoded = self.repaired = 0

    def _learn_chunks(self, chunks: dict[bytes, bytes]) -> None:
        """Encodes chunks (by digest), many in one call, and keeps them."""
        ends = [(_HEAD.match(c).end(), m.end() if (m := _UP_TO_TAIL.match(c)) else 0) for c in chunks.values()]
        bodies = [c[head:tail] for c, (head, tail) in zip(chunks.values(), ends, strict=True)]
        place = np.cumsum([0, *map(len, bodies)])
        ids, place = self.encode_texts(np.frombuffer(b"".join(bodies), np.uint8), place)
        raw = ids.astype("<u4", copy=False).tobytes()
        for (digest, chunk), (head, tail), begin, end in zip(chunks.items(), ends, (4 * place[:-1]).tolist(), (4 * place[1:]).tolist(), strict=True):
            known = (chunk[:head], raw[begin:end], chunk[tail:]) if tail else (chunk, None, b"")
            self.chunks[digest] = known
            self.chunk_bytes += sum(len(x) for x in known if x) + 400
            self.encoded += max(tail - head, 0)

    def encode_block(self, texts: list[list[bytes]]) -> Iterator[Iterator[bytes]]:
        """For each text, given as its chunks, its ids piece by piece."""
        if self.chunk_bytes > CHUNK_BYTES_KEPT:
            self.chunks.clear()
            self.chunk_bytes = 0
        digests = [[hashlib.blake2b(c, digest_size=16).digest() for c in chunks] for chunks in texts]
        self._learn_chunks({d: c for own, chunks in zip(digests, texts, strict=True) for d, c in zip(own, chunks, strict=True) if d not in self.chunks})
        plans = [list(_plan([self.chunks[d] for d in own])) for own in digests]
        joins = {x for plan in plans for is_join, x in plan if is_join}
        self.seen += sum(len(c) for chunks in texts for c in chunks)
        self.repaired += sum(len(w) for w in joins if w not in self.words)
        self.learn(joins)
        for plan in plans:
            yield (self.words[x] if is_join else x for is_join, x in plan)


def _plan(parts: list[tuple[bytes, bytes | None, bytes]]) -> Iterator[tuple[bool, bytes]]:
    """Pieces of a text in order: (False, ids of a chunk's inside) and (True, bytes of a join that are to be encoded together).

    A join takes the end of one chunk and the beginning of the next; if that one has no white space, it goes on over
    it to the one after, until white space is met. There the ids of both sides agree with those of the whole text.
    """
    open_join: list[bytes] = []
    for head, body, tail in parts:
        open_join.append(head)
        if body is not None:
            if join := b"".join(open_join):
                yield True, join
            if body:
                yield False, body
            open_join = [tail]
    if join := b"".join(open_join):
        yield True, join


class _Digest:
    """Number, digest of the ids as decimal text, digest of the decoded text; or those texts themselves."""

    def __init__(self, codec: ChunkCodec, whole: bool):
        self.codec, self.whole, self.n = codec, whole, 0
        self.out = [io.BytesIO(), io.BytesIO()] if whole else [hashlib.sha256(), hashlib.sha256()]

    def add(self, ids: bytes) -> None:
        numbers = np.frombuffer(ids, "<u4").tolist()
        if numbers:
            for out, names in zip(self.out, (self.codec.decimal, self.codec.tokens), strict=True):
                text = b" ".join([names[i] for i in numbers])
                (out.write if self.whole else out.update)(b" " + text if self.n else text)
            self.n += len(numbers)

    def row(self) -> tuple[int, str, str]:
        return (self.n, *(out.getvalue().decode() if self.whole else out.hexdigest() for out in self.out))


def worker_codec(path: str, kind: type):
    """One codec a Python worker, which Spark reuses across tasks; other operators drop it (vectext.release)."""
    return vectext.held((path, kind), lambda: kind(path))


def _texts(batches, id_at: int = 0, text_at: int = 1) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    for batch in batches:
        texts = batch.column(text_at)
        for start, stop in vectext.blocks(texts):
            yield batch.column(id_at).slice(start, stop - start), *vectext.flat(texts.slice(start, stop - start))


def _smallest_chunk(batches):
    """(doc_id, text) to (doc_id, text, the smallest hash of its chunks; a text without one gets a hash of its id)."""
    for batch in batches:
        for start, stop in vectext.blocks(batch.column(1)):
            part = batch.slice(start, stop - start)
            data, offsets = vectext.flat(part.column(1))
            raw = memoryview(data.tobytes())
            keys = []
            for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                found = [xxhash.xxh64_intdigest(raw[a:b]) for a, b in chunk_ranges(data[begin:end], begin)]
                keys.append(min(found, default=0) - (1 << 63))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(keys, pa.int64())], ["doc_id", "text", "near"])


def gathered(docs):
    """(doc_id, text) with documents that share chunks side by side: dealt and sorted by the smallest of their chunks' hashes.

    Copies have the same one, and near copies nearly as often as they share chunks. The deal is a REBALANCE, whose
    partitions adaptive execution splits where a third of all documents are copies of one.
    """
    keyed = docs.mapInArrow(_smallest_chunk, "doc_id long, text string, near long")
    return keyed.hint("rebalance", "near").sortWithinPartitions("near").select("doc_id", "text")


ENCODED_SCHEMA = "doc_id long, n_tokens long, ids string, decoded string"
DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_NAMES = ["doc_id", "n_tokens", "ids", "decoded"]


def _encoder(path: str, whole: bool):
    def run(batches):
        codec = worker_codec(path, ChunkCodec)
        for ids, data, offsets in _texts(batches):
            raw = data.tobytes()
            out = [_Digest(codec, whole) for _ in range(len(ids))]
            if len(ids) == 1:  # perhaps a very long one: by windows, which end at white space
                for start, stop in vectext.windows(data):
                    for pieces in codec.encode_block([[raw[a:b] for a, b in chunk_ranges(data[start:stop], start)]]):
                        for piece in pieces:
                            out[0].add(piece)
            else:
                texts = [[raw[a:b] for a, b in chunk_ranges(data[begin:end], begin)] for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
                for own, pieces in zip(out, codec.encode_block(texts), strict=True):
                    own.add(b"".join(pieces))
            rows = [own.row() for own in out]
            yield pa.RecordBatch.from_arrays([ids, pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[k] for r in rows], pa.string()) for k in (1, 2))], _NAMES)

    return run


def _narrow(docs, id_col, text_col):
    from pyspark.sql import functions as F

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def encode(docs, id_col: str = "doc_id", text_col: str = "text", path: str | None = None):
    """(doc_id, n_tokens, ids, decoded): ids as decimal numbers joined by spaces, as the tokenizers library gives them
    for the whole text without special tokens, and their decoding.

    Null counts as empty, and has no tokens, as has a text of white space only. Each row is encoded on its own, so
    repeated rows and ids give repeated rows; further columns are not read. Special tokens' names in a text become
    those tokens, as the library has it.
    """
    return gathered(_narrow(docs, id_col, text_col)).mapInArrow(_encoder(path or tokenizer_path(), True), ENCODED_SCHEMA)


def encode_digests(docs, id_col: str = "doc_id", text_col: str = "text", path: str | None = None):
    """As encode(), with the SHA-256 of ids and decoded text in their place, so that they never leave the worker."""
    frame = gathered(_narrow(docs, id_col, text_col)).mapInArrow(_encoder(path or tokenizer_path(), False), ENCODED_SCHEMA)
    return frame.toDF("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def token_counter(path: str):
    """A mapInArrow function (doc_id, text) to (doc_id, n_tokens)."""

    def run(batches):
        codec = worker_codec(path, BlockCodec)
        for ids, data, offsets in _texts(batches):
            counts = np.diff(codec.encode_texts(data, offsets)[1]) if len(ids) > 1 else [sum(map(len, codec.encode_windows(data)))]
            yield pa.RecordBatch.from_arrays([ids, pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    return run


def _pieces(parts: Iterator[np.ndarray], limit: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, ids_crc32) of a document whose ids come part by part."""
    piece, rest = 0, b""
    for part in parts:
        rest += part.astype("<u4", copy=False).tobytes()
        while len(rest) > 4 * limit:
            yield piece, piece * limit, limit, zlib.crc32(rest[: 4 * limit])
            piece, rest = piece + 1, rest[4 * limit :]
    yield piece, piece * limit, len(rest) // 4, zlib.crc32(rest)


def piece_maker(path: str, limit: int, end_id: int):
    """A mapInArrow function (doc_id, text) to the pieces of each document: (doc_id, piece, start, length, ids_crc32)."""
    end = np.array([end_id], "<u4")
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches):
        codec = worker_codec(path, BlockCodec)
        for ids, data, offsets in _texts(batches):
            if len(ids) == 1:
                parts = [itertools.chain(codec.encode_windows(data), [end])]
            else:
                tokens, place = codec.encode_texts(data, offsets)
                parts = [[tokens[begin:stop], end] for begin, stop in zip(place[:-1].tolist(), place[1:].tolist(), strict=True)]
            rows = [(doc, *piece) for doc, own in zip(ids.to_pylist(), parts, strict=True) for piece in _pieces(own, limit)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return vectext.frugal(run)
