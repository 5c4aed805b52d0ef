"""Near vectors against brute force."""

import numpy as np
import pytest

from opsgrain.llm import hnsw, near_vectors
from opsgrain.llm.shared import forest

KIND = "vec_id bigint, embedding array<float>, label int, kept string"


def brute(rows, cosine=0.9):
    """vec_id -> (links, component) by comparing all."""
    good = [(i, np.array(e, dtype=np.float64)) for i, e in rows if e and None not in e and np.isfinite(e).all() and np.any(e)]
    label, links = {i: i for i, _ in rows}, {i: 0 for i, _ in rows}
    edges = []
    for x, (i, a) in enumerate(good):
        for j, b in good[:x]:
            if len(a) == len(b) and a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= cosine:
                links[i] += 1
                links[j] += 1
                edges.append((i, j))
    if edges:
        u, v = np.array(edges).T
        label |= dict(zip(*(x.tolist() for x in forest(u, v))))
    return {i: (links[i], label[i]) for i in label}


def planted(rng, dim=16):
    base = rng.normal(size=(260, dim))
    dense = rng.normal(size=dim) + 0.12 * rng.normal(size=(140, dim))
    chain = [rng.normal(size=dim)]
    for _ in range(12):
        chain.append(chain[-1] + 0.35 * rng.normal(size=dim))
    every = np.concatenate([base, dense, base[:30] * 3, base[30:40], np.array(chain)]).astype(np.float32)
    return every[rng.permutation(len(every))]


@pytest.mark.parametrize("sizes", [(1, 65536, 8192), (3, 100, 64)])
def test_links_match_brute_force(spark, sizes):
    rows = [(int(i), [float(x) for x in e]) for i, e in enumerate(planted(np.random.default_rng(1)))]
    rows += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [float("inf")] + [1.0] * 15), (905, [1.0] * 3), (906, [2.0] * 3)]
    rows += [(907, [None] + [1.0] * 15), (908, [-0.0] * 15 + [1.0]), (909, [0.0] * 15 + [1.0]), (910, [1e-30] * 16), (911, [3e38] * 16)]
    frame = spark.createDataFrame([(*r, 1, "clash") for r in rows], KIND).repartition(4)
    got = near_vectors.mark_near_vectors(frame, shards=sizes[0], shard_rows=sizes[1], block_rows=sizes[2]).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_repeated_and_null_ids(spark):
    rows = [(4, [1.0, 0.0]), (4, [1.0, 0.0]), (None, [1.0, 0.01]), (None, [0.0, 1.0]), (3, [0.0, -1.0])]
    frame = spark.createDataFrame([(*r, 1, "") for r in rows], KIND)
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in near_vectors.mark_near_vectors(frame).collect())
    assert got == [("3", 0, "3"), ("4", 2, "4"), ("4", 2, "4"), ("None", 0, "None"), ("None", 2, "4")]
    assert near_vectors.mark_near_vectors(frame.limit(0)).count() == 0


def test_graph_finds_neighbours_and_packs():
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(1500, 24)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = hnsw.build(vectors)
    again = hnsw.Graph.unpack(vectors, graph.pack())
    queries = vectors[:200] + 0.05 * rng.normal(size=(200, 24)).astype(np.float32)
    nodes, sims = again.search(queries, 32)
    best = np.argsort(-(queries @ vectors.T), axis=1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) for a, b in zip(nodes.tolist(), best.tolist())]) >= 9
    assert (np.diff(sims, axis=1) <= 0).all() and len(graph.layers) == 2


def test_beam_is_widened_until_the_audit_passes(monkeypatch):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(1200, 8)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = hnsw.build(vectors)
    for layer in graph.layers:  # a bad graph: most links are gone
        layer.links[:, 3:] = -1
    monkeypatch.setattr(near_vectors, "BEAM", 4)
    q, v = near_vectors.search_links(graph, vectors[:300], 0.8)
    want = int((vectors[:300] @ vectors.T >= 0.8).sum())
    assert len(q) >= 0.97 * want and len(set(zip(q.tolist(), v.tolist()))) == len(q)


def unit(vectors):
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def pairs(rng, count, dim):
    """Pairs of near vectors, far from all others."""
    base = rng.normal(size=(count, dim))
    return np.concatenate([base, base + 0.1 * rng.normal(size=(count, dim))])


def missed(graph, vectors, least):
    q, v = near_vectors.search_links(graph, vectors, least, own=np.arange(len(vectors)))
    return len(set(map(tuple, np.argwhere(vectors @ vectors.T >= least).tolist())) - set(zip(q.tolist(), v.tolist())))


def test_audit_sees_sparse_links_beside_a_dense_group():
    rng = np.random.default_rng(5)
    dense = rng.normal(size=24) + 0.05 * rng.normal(size=(1000, 24))
    vectors = unit(np.concatenate([dense, pairs(rng, 1000, 24)])[rng.permutation(3000)])
    graph = hnsw.build(vectors)
    alone = (vectors @ vectors.T >= 0.9).sum(axis=1) == 2
    for layer in graph.layers:  # no way leads to half of the vectors in pairs
        lost = alone[layer.nodes] & (layer.nodes % 2 == 0)
        layer.links[(layer.links >= 0) & lost[layer.links]] = -1
    assert missed(graph, vectors, 0.9) <= 0.02 * 2000


def test_audit_of_rare_links_draws_the_whole_block():
    rng = np.random.default_rng(6)
    vectors = unit(rng.normal(size=(3000, 24)))
    queries = unit(rng.normal(size=(2000, 24)))
    queries[:5] = unit(vectors[1001:1006] + 0.01 * rng.normal(size=(5, 24)))
    graph = hnsw.build(vectors)
    for layer in graph.layers:  # no way leads to what the only links are with
        lost = (layer.nodes > 1000) & (layer.nodes < 1006)
        layer.links[(layer.links >= 0) & lost[layer.links]] = -1
    q, v = near_vectors.search_links(graph, queries, 0.9, seed=1)
    assert sorted(zip(q.tolist(), v.tolist())) == [(i, 1001 + i) for i in range(5)]


def test_a_dense_group_is_answered_in_bounded_memory():
    """4,000 queries on 8,000 near vectors have 32 million pairs, 512 MB; block and shard together are 3 MB."""
    import tracemalloc

    rng = np.random.default_rng(7)
    vectors = rng.normal(size=32) + 0.02 * rng.normal(size=(8000, 32))
    ids, copies = np.arange(8000), np.ones(8000, np.int64)
    graph = hnsw.build(unit(vectors))
    tracemalloc.start()
    counts, node, root = near_vectors.answer(graph, ids, copies, vectors, ids[:4000], vectors[:4000], 0.9, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (counts == 7999).all() and len(node) == 7999 and (root == 0).all()
    assert peak < 200e6, peak


def test_shards_and_blocks_are_cut_by_bytes(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(60, 768))
    rows = [(i, [float(x) for x in e]) for i, e in enumerate(np.concatenate([base, base + 0.01 * rng.normal(size=base.shape)]).astype(np.float32))]
    frame = spark.createDataFrame([(*r, 1, "") for r in rows], KIND)
    # 20 vectors a shard, 10 a block
    got = near_vectors.mark_near_vectors(frame, shards=1, shard_bytes=20 * 768 * 8, block_bytes=10 * 768 * 8).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (1, i % 60) for i in range(120)}

