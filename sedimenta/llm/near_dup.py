"""MinHash near-duplicates by a multi-index Hamming join (operator 7).

Each text becomes a set of word shingles. Texts with equal sets are one class, so copies cost nothing further. A class
has a signature of POSITIONS minima, each cut to 16 bits. Two classes at a signature distance (positions that differ)
of at most DISTANCE are candidates: the signature is split into CHUNKS equal chunks, so one chunk has at most
ERRORS = DISTANCE // CHUNKS differing positions (pigeonhole), and every choice of the positions of a chunk that are
left is one index key. Whatever the errors are, one key of that chunk agrees, hence no pair within DISTANCE is missed.
With POSITIONS 24 and DISTANCE 11 a pair of Jaccard similarity 0.8 is within DISTANCE with probability 0.9990 and
more similar ones with more; links are then confirmed on the full sets.

No bucket is capped and no bucket's pairs are all emitted. First every member of a bucket is compared with the
smallest one, its hub (a star, linear in the bucket); the confirmed links give components. Two members of one component
need no further comparison. What is left is, around each hub with members in several components, whether a member
outside the hub's component (a query) is near a member of another component. Queries meet the hub's members in a grid
of blocks: a first pass over signatures keeps the rows that have someone within DISTANCE in another component, a second
one compares full sets and gives, of the confirmed links between components, a forest: fewer than the block has
components, however many pairs of members are near. So the components are those of all links within DISTANCE.
A block has the square root of BLOCK times the hub's members on a side, so the rows that are moved for a hub grow as
the power 1.5 of its unlinked members, not as their square (the comparisons do, within tasks that are spread), and a
block's rows as their square root.

Classes are numbered once; numbers, not document ids, are the nodes of links, so an id on rows with different texts is
as many nodes. Full sets are made again from the texts of classes that are in some pair; a bitmap of those tells which
rows, so that no text is ever shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm import exact_dedup, vectext
from sedimenta.operators.components import components
from sedimenta.session import cut_lineage

POSITIONS, DISTANCE, CHUNKS = 24, 11, 4
CHUNK = POSITIONS // CHUNKS
ERRORS = DISTANCE // CHUNKS
BLOCK = 512
SUBSETS = list(combinations(range(CHUNK), CHUNK - ERRORS))
_SEEDS = vectext.mix(np.arange(1, POSITIONS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))

#: Members of a hub that are confirmed at a time, and shingles of a set whose minima are taken at a time.
STAR, SLICE = 256, 1 << 18


def _texts(batches, width):
    """Blocks (part of the batch, shingle sets) of the batches of (text, ...)."""
    vectext.release()
    for batch in batches:
        for start, stop in vectext.blocks(batch.column(0)):
            part = batch.slice(start, stop - start)
            yield part, vectext.shingle_sets(vectext.Words(*vectext.flat(part.column(0)), vectext.NOT_SPACE), width)


def _set_hash(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles, digest_size=16).digest() if len(shingles) else None


def _minima(joined: np.ndarray, at: np.ndarray) -> np.ndarray:
    """By position, the smallest hash of each of the sets that begin at at, in uint16."""
    out = np.zeros((len(at), POSITIONS), np.uint16)
    for k, seed in enumerate(_SEEDS):
        with np.errstate(over="ignore"):
            value = (joined ^ seed) * np.uint64(0xE7037ED1A0B428DB)
            value ^= value >> np.uint64(32)
            value *= np.uint64(0x8EBC6AF09C88C6E3)
        out[:, k] = (vectext.mix(np.minimum.reduceat(value, at)) & np.uint64(0xFFFF)).astype(np.uint16)
    return out


def _minima_of_long(shingles: np.ndarray) -> np.ndarray:
    """The same for one long set, slice by slice."""
    least = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(shingles), SLICE):
        part = shingles[low : low + SLICE]
        for k, seed in enumerate(_SEEDS):
            with np.errstate(over="ignore"):
                value = (part ^ seed) * np.uint64(0xE7037ED1A0B428DB)
                value ^= value >> np.uint64(32)
                value *= np.uint64(0x8EBC6AF09C88C6E3)
            least[k] = min(least[k], value.min())
    return (vectext.mix(least) & np.uint64(0xFFFF)).astype(np.uint16)


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """uint16 signatures, a row for each set (all zero for an empty one)."""
    out = np.zeros((len(sets), POSITIONS), np.uint16)
    for i, s in enumerate(sets):
        if len(s) > SLICE:
            out[i] = _minima_of_long(s)
    if full := [i for i, s in enumerate(sets) if 0 < len(s) <= SLICE]:
        out[full] = _minima(np.concatenate([sets[i] for i in full]), np.cumsum([0, *(len(sets[i]) for i in full[:-1])]))
    return out


def _classify(width):
    def run(batches):
        for part, sets in _texts(batches, width):
            made = [pa.array([len(s) for s in sets], pa.int64()), pa.array([_set_hash(s) for s in sets], pa.binary()), pa.array([row.tobytes() for row in _signatures(sets)], pa.binary())]
            yield pa.RecordBatch.from_arrays([*part.columns[1:], *made], [*part.schema.names[1:], "n_shingles", "set_hash", "signature"])

    return vectext.frugal(run)


def _full_sets(width):
    def run(batches):
        for _, sets in _texts(batches, width):
            yield pa.RecordBatch.from_arrays([pa.array([_set_hash(s) for s in sets], pa.binary()), pa.array([memoryview(s).cast("B") for s in sets], pa.binary())], ["set_hash", "shingles"])

    return vectext.frugal(run)


def _index_keys(batches):
    """(class, keys of all chunks and choices) of (class, signature)."""
    vectext.release()
    for batch in batches:
        raw = batch.column(1).to_pylist()
        signatures = np.frombuffer(b"".join(raw), np.uint16).reshape(len(raw), POSITIONS).astype(np.uint64)
        keys = []
        for c in range(CHUNKS):
            for s, subset in enumerate(SUBSETS):
                value = np.full(len(raw), c * len(SUBSETS) + s + 1, np.uint64)
                for p in subset:
                    with np.errstate(over="ignore"):
                        value = vectext.mix(value * np.uint64(0x9E3779B97F4A7C15) + signatures[:, c * CHUNK + p])
                keys.append(value)
        flat = np.stack(keys, 1).view(np.int64).ravel()
        offsets = np.arange(len(raw) + 1, dtype=np.int32) * (CHUNKS * len(SUBSETS))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["cls", "keys"])


def _near_pairs(percent):
    """The pairs (hub, cls) of (hub, cls, size, hub_size, signature, hub_signature) that can be near: by size, and within DISTANCE."""

    def run(batches):
        vectext.release()
        for batch in batches:
            size, other = (np.asarray(batch.column(k)).astype(np.int64) for k in (2, 3))
            good = 100 * np.minimum(size, other) >= percent * np.maximum(size, other)
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(-1, POSITIONS) for k in (4, 5))
            good &= (a != b).sum(1) <= DISTANCE
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["hub", "cls"]).filter(pa.array(good, pa.bool_()))

    return run


def _overlaps(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of others has in common with own; sets are sorted, none is empty."""
    joined = np.concatenate(others)
    place = np.minimum(np.searchsorted(own, joined), len(own) - 1)
    sizes = np.array([len(x) for x in others])
    return np.add.reduceat((own[place] == joined).astype(np.int64), np.cumsum(sizes) - sizes)


def _star_links(percent):
    """The confirmed links (a, b) of a hub and a block of its members, of (hub, block, cls, shingles)."""

    def run(table: pa.Table) -> pa.Table:
        vectext.release()
        hub, cls = table["hub"][0].as_py(), np.asarray(table["cls"].combine_chunks())
        shingles = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
        at = int(np.flatnonzero(cls == hub)[0])
        others = np.flatnonzero(cls != hub)
        sizes = np.array([len(shingles[k]) for k in others])
        both = _overlaps(shingles[at], [shingles[k] for k in others])
        linked = cls[others[100 * both >= percent * (sizes + len(shingles[at]) - both)]]
        return pa.table({"a": pa.array(np.full(len(linked), hub), pa.int64()), "b": pa.array(linked, pa.int64())})

    return run


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows that are queries, rows that are members, component by row, size by row)."""
    query = np.asarray(table["query"].combine_chunks().cast(pa.int8())).astype(bool)
    component, size = (np.asarray(table[c].combine_chunks()) for c in ("component", "size"))
    return np.flatnonzero(query), np.flatnonzero(~query), component, size


def _signatures_of(table: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint16).reshape(-1, POSITIONS)


def _candidates(q: int, members: np.ndarray, component: np.ndarray, size: np.ndarray, signatures: np.ndarray, percent: int) -> np.ndarray:
    """Members of other components than row q's that can be near it."""
    low, high = np.minimum(size[members], size[q]), np.maximum(size[members], size[q])
    some = members[(component[members] != component[q]) & (100 * low >= percent * high)]
    return some[(signatures[some] != signatures[q]).sum(1) <= DISTANCE]


def _has_near(percent):
    """The rows of a block that have a candidate, of (hub, qb, mb, query, cls, component, size, signature)."""

    def run(table: pa.Table) -> pa.Table:
        vectext.release()
        queries, members, component, size = _sides(table)
        signatures = _signatures_of(table)
        keep = np.zeros(len(table), bool)
        for q in queries:
            found = _candidates(q, members, component, size, signatures, percent)
            if len(found):
                keep[q] = True
                keep[found] = True
        return table.filter(pa.array(keep))

    return run


def _links_within(percent):
    """The links (a, b) between components that join those of a block, whose rows have their shingles too.

    A forest: each component that is joined with others has one link, with the smallest of them, however many of their
    members are near each other. Members that are joined by then need no further comparison.
    """

    def run(table: pa.Table) -> pa.Table:
        vectext.release()
        queries, members, component, size = _sides(table)
        signatures = _signatures_of(table)
        shingles = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
        names, at = np.unique(component, return_inverse=True)
        root = np.arange(len(names))
        for q in queries:
            found = _candidates(q, members, root[at], size, signatures, percent)
            while len(found):
                some, found = found[:STAR], found[STAR:]
                both = _overlaps(shingles[q], [shingles[m] for m in some])
                linked = some[100 * both >= percent * (np.array([len(shingles[m]) for m in some]) + len(shingles[q]) - both)]
                met = np.unique(root[at[np.append(linked, q)]])
                root[np.isin(root, met)] = met[0]
                found = found[root[at[found]] != met[0]]
        joined = np.flatnonzero(root != np.arange(len(names)))
        return pa.table({"a": pa.array(names[root[joined]], pa.int64()), "b": pa.array(names[joined], pa.int64())})

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) and the columns of carry, a row for each row of docs.

    Words are runs of anything but ASCII white space, with A-Z lower-cased; a set holds the distinct width-word
    shingles of the whole text, or all words as one where there are fewer. Null and empty texts have empty sets and
    are linked with nothing: their component is their own id. component_id is the smallest id among the rows whose
    texts are linked, by way of others or not. Rows that repeat an id with different texts are told apart: each has
    the component of its own text, and is kept if the id is that component's smallest. A row with a null id is not
    linked with other texts; its component is the smallest id among rows with the same set, and it is not kept
    (kept is false), unless there is none: then component_id is null. An empty table gives no rows. Columns named in
    carry pass through; others are not read. A very long text costs a worker some 20 bytes for each of its words.
    """
    carried = [f"_carry_{i}" for i in range(len(carry))]
    texts = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"), *(F.col(c).alias(n) for c, n in zip(carry, carried, strict=True)))
    kinds = "".join(f"{n} {texts.schema[n].dataType.simpleString()}, " for n in ["doc_id", *carried])
    rows = cut_lineage(texts.mapInArrow(_classify(width), f"{kinds}n_shingles long, set_hash binary, signature binary"))
    classes = rows.filter("set_hash is not null").groupBy("set_hash").agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("size"), F.min("signature").alias("signature"))
    classes = cut_lineage(classes.filter("rep is not null").withColumn("cls", F.monotonically_increasing_id()))

    keyed = classes.select("cls", "signature").mapInArrow(_index_keys, "cls long, keys array<long>").select("cls", F.explode("keys").alias("key"))
    hubs = cut_lineage(keyed.groupBy("key").agg(F.min("cls").alias("hub"), F.count("*").alias("n")).filter("n > 1"))
    size = exact_dedup.rows_for(hubs.count())
    shared = exact_dedup.marked(keyed, cut_lineage(exact_dedup.bitmap(hubs, size, "key")), size, "_maybe", "key").filter("_maybe")
    # A row for each hub and member, however many keys they share; in buckets of two the star compares all there is.
    spokes = cut_lineage(shared.join(hubs, "key").groupBy("hub", "cls").agg((F.max("n") > 2).alias("crowded")))

    known = classes.select("cls", "size", "signature")
    others = classes.select(F.col("cls").alias("hub"), F.col("size").alias("hub_size"), F.col("signature").alias("hub_signature"))
    pairs = spokes.filter("cls <> hub").select("hub", "cls").join(known, "cls").join(others, "hub")
    stars = cut_lineage(pairs.select("hub", "cls", "size", "hub_size", "signature", "hub_signature").mapInArrow(_near_pairs(percent), "hub long, cls long"))
    blocks = stars.groupBy("hub").agg(F.ceil(F.count("*") / STAR).alias("blocks"))
    members = stars.join(blocks, "hub").select("hub", F.pmod(F.xxhash64("cls"), "blocks").alias("block"), "cls")
    # The hub is in every block that has members.
    around = members.union(members.select("hub", "block").distinct().select("hub", "block", F.col("hub").alias("cls")))
    met = around.join(_sets(around.select("cls").distinct(), classes, texts, width), "cls").select("hub", "block", "cls", "shingles")
    first = cut_lineage(met.groupBy("hub", "block").applyInArrow(_star_links(percent), "a long, b long"))
    found = components(first)

    crowd = spokes.filter("crowded").select("hub", "cls").join(known.select("cls", "size"), "cls").join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    mains = crowd.filter("cls = hub").select("hub", F.col("component").alias("main"))
    crowd = cut_lineage(crowd.join(mains, "hub").withColumn("outside", F.col("component") != F.col("main")))
    counts = crowd.groupBy("hub").agg(F.count("*").alias("members"), F.count_if("outside").alias("queries")).filter("queries > 0")
    side = F.greatest(F.lit(BLOCK).cast("double"), F.sqrt(F.col("members") * BLOCK))
    counts = counts.select("hub", F.ceil(F.col("members") / side).alias("member_blocks"), F.ceil(F.col("queries") / side).alias("query_blocks"))
    crowd = crowd.join(counts, "hub").withColumn("own_mb", F.pmod(F.xxhash64("cls"), "member_blocks")).withColumn("own_qb", F.pmod(F.xxhash64("cls", F.lit(1)), "query_blocks"))
    columns = ["hub", "qb", "mb", "query", "cls", "component", "size"]
    as_members = crowd.withColumn("query", F.lit(False)).withColumn("mb", F.col("own_mb")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
    as_queries = crowd.filter("outside").withColumn("query", F.lit(True)).withColumn("qb", F.col("own_qb")).withColumn("mb", F.explode(F.sequence(F.lit(0), F.col("member_blocks") - 1)))
    grid = as_members.select(columns).union(as_queries.select(columns)).join(known.select("cls", "signature"), "cls").select(*columns, "signature")
    kinds = "hub long, qb long, mb long, query boolean, cls long, component long, size long, signature binary"
    near = cut_lineage(grid.groupBy("hub", "qb", "mb").applyInArrow(_has_near(percent), kinds))
    if not near.isEmpty():
        whole = near.join(_sets(near.select("cls").distinct(), classes, texts, width), "cls").select(*columns, "signature", "shingles")
        second = cut_lineage(whole.groupBy("hub", "qb", "mb").applyInArrow(_links_within(percent), "a long, b long").distinct())
        if not second.isEmpty():
            found = _joined(found, components(second))

    linked = found.withColumnRenamed("node", "cls").join(classes.select("cls", "rep"), "cls")
    lowest = linked.join(linked.groupBy("component").agg(F.min("rep").alias("lowest")), "component").select("cls", "lowest")
    placed = classes.select("set_hash", "cls", "rep").join(lowest, "cls", "left").select(F.col("set_hash").alias("at"), F.coalesce("lowest", "rep").alias("component"))
    # Rows without a set have no class; their own id as key keeps them spread.
    rows = rows.withColumn("at", F.coalesce("set_hash", F.col("doc_id").cast("string").cast("binary"), F.lit(b"")))
    out = rows.join(placed, "at", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), *(F.col(n).alias(c) for c, n in zip(carry, carried, strict=True)))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"), *carry)


def _joined(found: DataFrame, tops: DataFrame) -> DataFrame:
    """(node, component) of found with its components in those of tops, whose nodes are components of found or nodes that it has not."""
    tops = tops.select(F.col("node").alias("component"), F.col("component").alias("top"))
    nodes = found.union(tops.select("component", F.col("component").alias("itself"))).distinct()
    return cut_lineage(nodes.join(tops, "component", "left").select("node", F.coalesce("top", "component").alias("component")))


def _sets(wanted: DataFrame, classes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(cls, shingles) of the classes that are wanted, from texts of the ids that stand for them."""
    reps = cut_lineage(wanted.join(classes.select("cls", "rep", "set_hash"), "cls"))
    size = exact_dedup.rows_for(reps.count())
    bits = cut_lineage(exact_dedup.bitmap(reps.withColumnRenamed("rep", "doc_id"), size, "doc_id"))
    some = exact_dedup.marked(texts.select("doc_id", "text"), bits, size, "_maybe", "doc_id").filter("_maybe").select("text")
    # Several rows may have a set, and an id several sets.
    made = some.mapInArrow(_full_sets(width), "set_hash binary, shingles binary").join(reps.select("set_hash"), "set_hash", "left_semi").dropDuplicates(["set_hash"])
    return cut_lineage(reps.select("cls", "set_hash").join(made, "set_hash").select("cls", "shingles"))
