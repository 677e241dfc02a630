import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import exact_dedup, near_dup, queries

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if len(words) >= width else frozenset([tuple(words)] if words else [])


def brute_components(rows, width, percent):
    """By an index of shingles, all pairs that share one."""
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = defaultdict(list)
    for i in sorted(sets):
        shared = defaultdict(int)
        for s in sets[i]:
            for j in index[s]:
                shared[j] += 1
            index[s].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}, {i: len(s) for i, s in sets.items()}


def test_exact_on_odd_rows(odd, clashing):
    for docs in (odd, clashing):
        rows = exact_dedup.exact_duplicates(docs).collect()
        assert len(rows) == 13
        by = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in rows}
        assert by[1] == (1, 2, True) and by[2] == (1, 2, False)
        assert by[3] == (3, 2, True) and by[4] == (3, 2, False)
        assert by[5] == (5, 1, True) and by[6] == (6, 1, True) and by[7] == (7, 1, True)
        assert [(r.keep_id, r.group_size, r.kept) for r in rows if r.doc_id == 8] == [(8, 2, True)] * 2
        assert by[None] == (None, 1, True)


def test_exact_collisions_of_levels(spark):
    """Equal lengths and beginnings, different ends: only the last level tells them apart."""
    base = "p" * 80
    rows = [(i, base + end) for i, end in enumerate(["aa", "ab", "aa", "b", "aaa"])]
    got = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.keep_id for r in got} == {0: 0, 1: 1, 2: 0, 3: 3, 4: 4}


def test_exact_empty(empty):
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_exact_carries_rows(clashing):
    whole = clashing.select("doc_id", "text", F.struct("*").alias("row"))
    kept = exact_dedup.exact_duplicates(whole, carry=["row"]).filter("kept").select("row.*")
    assert kept.columns == clashing.columns and kept.filter("keep_id = 'clash'").count() == kept.count()


def test_op2_query(spark, sf, sample):
    groups = defaultdict(list)
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in sample}
    for i, t in norm.items():
        groups[t].append(i)
    rows = queries.op2_exact_dedup(spark, sf).collect()
    assert len(rows) == len(sample)
    for r in rows:
        g = groups[norm[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (min(g), len(g), r.doc_id == min(g), hashlib.sha256(norm[r.doc_id].encode()).hexdigest())


def test_every_error_pattern_meets():
    """Whatever DISTANCE positions differ, one key agrees."""
    rng = np.random.default_rng(4)
    import pyarrow as pa

    a = rng.integers(0, 1 << 16, (300, near_dup.POSITIONS), dtype=np.uint16)
    b = a.copy()
    for row in b:
        at = rng.choice(near_dup.POSITIONS, near_dup.DISTANCE, replace=False)
        row[at] ^= np.uint16(1)
    keys = [next(near_dup._index_keys(iter([pa.RecordBatch.from_arrays([pa.array(range(300), pa.int64()), pa.array([r.tobytes() for r in x])], ["c", "s"])]))).column(1).to_pylist() for x in (a, b)]
    assert all(set(x) & set(y) for x, y in zip(*keys, strict=True))


def test_near_on_odd_rows(odd, clashing):
    for docs in (odd, clashing):
        rows = near_dup.near_duplicates(docs, width=2).collect()
        assert len(rows) == 13
        by = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
        assert by[1][1:] == (1, True) and by[2][1:] == (1, False)
        assert by[3] == (0, 3, True) and by[4] == (0, 4, True) and by[5] == (0, 5, True)
        assert by[6] == (1, 6, True) and by[7] == (1, 6, False)
        assert by[None][2] is False and by[9] == (1, 9, True)


def test_near_empty(empty):
    assert near_dup.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block", [4, 512])
def test_near_chains_and_hot_group(spark, monkeypatch, block):
    """A hot group of copies with growing edits: links that no hub has must be found, also over many blocks."""
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(90):
        words = list(base)
        for p in rng.choice(60, int(rng.integers(0, 9)), replace=False):
            words[p] = f"x{i}_{p}"
        rows.append((i, " ".join(words)))
    chain = [f"c{i}" for i in range(80)]
    for i in range(12):  # neighbours are near, ends are not
        rows.append((200 + i, " ".join(chain[i * 3 : i * 3 + 40])))
    expected, sizes = brute_components(rows, 2, 80)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=2).collect()
    assert {r.doc_id: r.component_id for r in got} == expected and {r.doc_id: r.n_shingles for r in got} == sizes
    assert len(set(expected.values())) > 3


def test_near_repeated_ids_with_different_texts(spark):
    """An id on several texts is several nodes: no link of any of them is lost."""
    text = lambda k, n: " ".join(f"{k}{i}" if i != n else "other" for i in range(60))
    rows = [(1, text("a", -1)), (5, text("a", 59)), (5, text("b", -1)), (9, text("b", 59)), (20, text("c", -1))]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), width=2).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == [(1, 1, True), (5, 1, False), (5, 5, True), (9, 5, False), (20, 20, True)]


def test_near_carries_columns(odd):
    rows = near_dup.near_duplicates(odd.withColumn("kept", F.col("doc_id") * 2), width=2, carry=["lang", "source"]).collect()
    assert sorted((r.doc_id or 0, r.lang or "", r.source or "") for r in rows) == sorted((r.doc_id or 0, r.lang or "", r.source or "") for r in odd.collect())


def test_long_sets_have_the_same_minima(monkeypatch):
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 50, 700, 3000)]
    whole = near_dup._signatures(sets)
    monkeypatch.setattr(near_dup, "SLICE", 64)
    assert (near_dup._signatures(sets) == whole).all()


def test_rows_moved_around_a_hub(spark, monkeypatch):
    """A hub of unlinked members: what moves grows far slower than the square of their number."""
    moved = {}
    whole = near_dup._has_near

    def counting(percent):
        inner = whole(percent)

        def run(table):
            rows.add(len(table))
            return inner(table)

        return run

    monkeypatch.setattr(near_dup, "_has_near", counting)
    monkeypatch.setattr(near_dup, "BLOCK", 16)
    for n in (200, 800):
        rows = spark.sparkContext.accumulator(0)
        # Each has half of its words in common with all others, in the same place: near the hub, linked with nothing.
        texts = [(i, " ".join(f"s{k}" for k in range(30)) + " " + " ".join(f"x{i}y{k}" for k in range(24 if i else 0))) for i in range(n)]
        got = near_dup.near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"), width=1).collect()
        assert all(r.kept for r in got)
        moved[n] = rows.value
    assert moved[200] > 0 and moved[800] < 10 * moved[200]  # the square would be 16 times


@pytest.mark.parametrize("width,edits", [(5, 2), (2, 6)])
def test_links_between_components_of_one_group(spark, monkeypatch, width, edits):
    """Near copies with edits of their own, of which stars leave several components: fewer links than members join these."""
    made, whole, n = [], near_dup.components, 240

    def counting(links):
        made.append(links.count())
        return whole(links)

    monkeypatch.setattr(near_dup, "components", counting)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        words = [f"w{k}" for k in range(240)]
        for p in rng.choice(240, edits + i % 2, replace=False):
            words[p] = f"x{i}y{p}"
        rows.append((i, " ".join(words)))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=width).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(rows, width, 80)[0]
    assert len(made) == 2 and 0 < made[1] < n


def test_op7_query(spark, sf, sample):
    expected, sizes = brute_components(sample, 2, 80)
    rows = queries.op7_minhash_near_dup(spark, sf).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == {i: (sizes[i], expected[i], i == expected[i]) for i, _ in sample}
