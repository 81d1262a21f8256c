"""Components, SimHash and embedding links against brute force."""

import random

import numpy as np
import xxhash

from parcelwise.llm import embeddings, simhash
from parcelwise.llm.components import components, stars


def grouped(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_cliques(spark):
    order = list(range(60))
    random.Random(3).shuffle(order)
    links = list(zip(order, order[1:], strict=False)) + [(100, k) for k in range(101, 160)] + [(a, b) for a in range(200, 206) for b in range(200, 206)]
    links += [(i, i + 1) for i in range(300, 340)] + [(7, 7), (5, None), (None, 9)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and b is not None and a != b]
    assert got == grouped({x for e in real for x in e}, real)


def test_components_without_edges_and_of_strings(spark):
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0
    got = {tuple(r) for r in components(spark.createDataFrame([("b", "c"), ("c", "a")], "a string, b string")).collect()}
    assert got == {("a", "a"), ("b", "a"), ("c", "a")}


def test_stars_keep_components():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 300, 250), rng.integers(300, 600, 250)
    x, y = stars(a, b)
    nodes = set(a.tolist()) | set(b.tolist())
    assert grouped(nodes, zip(x.tolist(), y.tolist(), strict=True)) == grouped(nodes, zip(a.tolist(), b.tolist(), strict=True))


def slow_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def near_texts():
    rng = random.Random(1)
    texts = []
    for _ in range(25):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.choice([1, 3, 60, 300]))]
        texts.append(" ".join(words))
        for _ in range(3):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "changed"
            texts.append(" ".join(copy))
    return texts + [None, "", " \n", "A b", "a  B", "é ü ß Ä", "x " * 3000, texts[0], texts[0]]


def test_simhash_equals_brute_force(spark):
    texts = near_texts()
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(None, "", 1), (3, texts[3], 1)], "doc_id long, text string, fp int")
    rows = simhash.simhash_components(docs).collect()
    assert len(rows) == len(texts) + 2
    prints = {i: slow_fingerprint(t) for i, t in enumerate(texts)}
    ids = list(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 4]
    want = grouped(ids, links)
    for r in rows:
        if r.doc_id is not None:
            assert r.fp % (1 << 64) == prints[r.doc_id] and r.component_id == want[r.doc_id]
    assert {r.component_id for r in rows if r.doc_id is None} == {want[texts.index("")]}


def test_simhash_of_an_empty_table(spark):
    assert simhash.simhash_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_large_cells_are_cut_into_tiles(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = int(rng.integers(1 << 62))
    prints = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in rng.integers(0, 63, (400, 3))} | set(rng.integers(0, 1 << 62, 200).tolist()))
    table = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= 4]
    want = {k: v for k, v in grouped(prints, links).items()}
    joined = simhash._join_cells(4)
    batches = []
    for grid, mask in enumerate(simhash.grids(4)):
        for p in prints:
            u = int(simhash._unary(np.array([p], np.uint64)).view(np.int64)[0])
            batches.append((grid, u & mask, p))
    batches.sort()
    import pyarrow as pa

    monkeypatch.setattr(simhash, "CELL_ROWS", 7)
    parts = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*batches[k : k + 50], strict=True), (pa.int32(), pa.int64(), pa.int64()), strict=True)], ["grid", "cell", "fp"]) for k in range(0, len(batches), 50)]
    edges, deferred = [], {}
    for out in joined(iter(parts)):
        for r in out.to_pylist():
            if r["grid"] is None:
                edges.append((r["a"], r["b"]))
            else:
                deferred.setdefault((r["grid"], r["cell"]), []).append((r["block"], r["a"]))
    assert deferred and all(sorted(b for b, _ in v) == [k // 7 for k in range(len(v))] for v in deferred.values())
    for members in deferred.values():
        last = max(b for b, _ in members)
        for i in range(last + 1):
            for j in range(i, last + 1):
                rows = [(i, b, a) for b, a in members if b in (i, j)]
                t = pa.table({"i": [r[0] for r in rows], "block": [r[1] for r in rows], "a": [r[2] for r in rows]})
                got = simhash._join_tile(4)(t).to_pylist()
                edges += [(g["a"], g["b"]) for g in got]
    assert {k: v for k, v in grouped(prints, edges).items()} == want
    monkeypatch.undo()
    nodes = {r.node: r.component for r in components(simhash.fingerprint_links(table)).collect()}
    assert {p: nodes.get(p, p) for p in prints} == want


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 16))
    rows = [v.tolist() for v in np.concatenate([base, base[:20] + rng.normal(size=(20, 16)) * 0.15, base[:3], base[:2] * 7])]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [None] + [1.0] * 15, [float("inf")] * 16, [1.0] * 3, [2.0] * 3, [1e-200] * 16, [1e200] * 16]
    every = list(enumerate(rows + odd))
    table = spark.createDataFrame([(i, v, 0) for i, v in every], "vec_id long, embedding array<double>, n int")
    good = {i: np.array(v) / np.abs(v).max() for i, v in every if v and None not in v and np.isfinite(v).all() and any(v)}
    links = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b]) and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.9]
    want = grouped([i for i, _ in every], links)
    for tile in (1 << 20, 200):
        got = {r.vec_id: r for r in embeddings.embedding_links(table, tile=tile).collect()}
        assert len(got) == len(every)
        for i, _ in every:
            assert got[i].component_id == want[i] and got[i].n_links == sum(i in e for e in links) and got[i].kept == (want[i] == i)


def test_repeated_and_missing_vector_ids_are_rows_of_their_own(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0]), (None, [-1.0, 0.0]), (None, [-1.0, 0.0]), (None, [-1.0, 0.0]), (9, [-1.0, -1.0]), (9, None)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (9, 0, 9, True), (9, 0, 9, True)] + [(None, 2, None, True)] * 3
    for tile in (1 << 20, 4):
        got = [tuple(r) for r in embeddings.embedding_links(table, tile=tile).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_quantisation_never_loses_a_pair():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 24))
    x = np.concatenate([x, x + rng.normal(size=x.shape) * rng.uniform(0.05, 0.6, (300, 1))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = {(int(a), int(b)) for i, j in embeddings.near_pairs(x, x, 0.9, True) for a, b in zip(i, j, strict=True)}
    assert got == {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(x @ x.T >= 0.9, 1)), strict=True)}
