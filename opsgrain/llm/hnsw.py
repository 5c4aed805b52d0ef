"""Hierarchical navigable small-world graph over unit vectors, in numpy; many queries walk side by side."""

from __future__ import annotations

import io
from dataclasses import dataclass, field

import numpy as np

#: Links of a node on a layer, beam while a graph is made, nodes of a layer per node of the layer above.
LINKS, BUILD_BEAM, THIN = 24, 40, 16
#: Nodes inserted at once, candidates that nodes of the same batch add, entries taken from the layer above.
BATCH, PEERS, ENTRIES = 1024, 12, 4
#: Cells of a table of visited nodes, and candidates compared with each other at a time.
VISITED, COMPARED = 1 << 24, 2048
#: Nodes opened per query and step.
OPENED = 4


@dataclass
class Layer:
    nodes: np.ndarray  # of the vectors that are on this layer, in the order of insertion
    links: np.ndarray = field(default_factory=lambda: np.empty((0, LINKS), np.int32))  # places in ``nodes``, -1: none


@dataclass
class Graph:
    vectors: np.ndarray  # float32, unit length
    layers: list[Layer]  # the top one first

    def search(self, queries: np.ndarray, beam: int, seeds: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities), both (queries, beam): the nearest found, best first; -1: none.  ``seeds`` adds entries all over the graph."""
        return _descend(self.vectors, self.layers, queries, beam, seeds)

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, depth=len(self.layers), **{f"{k}{i}": getattr(x, k) for i, x in enumerate(self.layers) for k in ("nodes", "links")})
        return out.getvalue()

    @staticmethod
    def unpack(vectors: np.ndarray, raw: bytes) -> Graph:
        with np.load(io.BytesIO(raw)) as held:
            return Graph(vectors, [Layer(held[f"nodes{i}"], held[f"links{i}"]) for i in range(int(held["depth"]))])


def _walk(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search on one layer; ``entries``: (queries, any) places, -1: none."""
    parts = max(1, VISITED // max(1, len(vectors)))
    if len(queries) > parts:
        each = [_walk(vectors, links, queries[i : i + parts], entries[i : i + parts], beam) for i in range(0, len(queries), parts)]
        return tuple(np.concatenate(x) for x in zip(*each))
    count = len(queries)
    ids = np.full((count, beam), -1, np.int32)
    sims = np.full((count, beam), -np.inf, np.float32)
    opened = np.ones((count, beam), bool)
    visited = np.zeros((count, len(vectors) + 1), bool)
    visited[:, -1] = True  # place -1
    live = np.arange(count)
    fresh = entries
    while len(live):
        # entries or links of one query may name a node twice: the first counts
        fresh = np.where(visited[live[:, None], fresh], -1, fresh)
        fresh = np.sort(fresh, axis=1)
        fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
        row, col = np.nonzero(fresh >= 0)
        new = fresh[row, col]
        visited[live[row], new] = True
        found = np.full(fresh.shape, -np.inf, np.float32)
        found[row, col] = np.einsum("ij,ij->i", queries[live[row]], vectors[new])
        all_sims = np.concatenate([sims[live], found], axis=1)
        top = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam] if all_sims.shape[1] > beam else np.arange(all_sims.shape[1])[None, :]
        at = np.arange(len(live))[:, None]
        sims[live] = all_sims[at, top]
        ids[live] = np.concatenate([ids[live], fresh], axis=1)[at, top]
        opened[live] = np.concatenate([opened[live], fresh < 0], axis=1)[at, top]
        # open the best nodes of the beam that are not open yet
        open_sims = np.where(opened[live], -np.inf, sims[live])
        width = min(OPENED, beam)
        best = np.argpartition(-open_sims, width - 1, axis=1)[:, :width]
        some = np.take_along_axis(open_sims, best, axis=1) > -np.inf
        goes = some.any(axis=1)
        live, best, some = live[goes], best[goes], some[goes]
        rows = live[:, None]
        places = np.where(some, ids[rows, best], -1)
        opened[rows, best] = True
        fresh = np.where((places >= 0)[:, :, None], links[places], -1).reshape(len(live), width * links.shape[1])
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)


def _descend(vectors: np.ndarray, layers: list[Layer], queries: np.ndarray, beam: int, seeds: int = 0) -> tuple[np.ndarray, np.ndarray]:
    nodes, sims = np.full((len(queries), 1), -1), np.full((len(queries), 1), -np.inf, np.float32)
    place = np.full(len(vectors) + 1, -1, np.int32)
    for depth, layer in enumerate(layers):
        place[:] = -1
        place[layer.nodes] = np.arange(len(layer.nodes))
        last = depth == len(layers) - 1
        entries = place[nodes] if depth else np.zeros((len(queries), 1), np.int32)
        if last and seeds:
            spread = np.linspace(0, len(layer.nodes) - 1, min(seeds, len(layer.nodes))).astype(np.int32)
            entries = np.concatenate([entries, np.broadcast_to(spread, (len(queries), len(spread)))], axis=1)
        width = min(beam if last else ENTRIES, len(layer.nodes))
        found, sims = _walk(vectors[layer.nodes], layer.links, queries, entries, width)
        nodes = np.where(found >= 0, layer.nodes[found], -1)
    return nodes, sims


def _choose(vectors: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Of candidates (best first, -1: none) those nearer to the node than to any chosen before; then the nearest others, up to ``most``."""
    out = np.full((len(ids), most), -1, np.int32)
    for first in range(0, len(ids), COMPARED):
        part, near = ids[first : first + COMPARED], sims[first : first + COMPARED]
        real = part >= 0
        held = vectors[part]
        among = held @ held.transpose(0, 2, 1)
        kept = np.zeros(part.shape, bool)
        for j in range(part.shape[1]):
            covered = ((among[:, j] >= near[:, j, None]) & kept).any(axis=1)
            kept[:, j] = real[:, j] & ~covered & (kept.sum(axis=1) < most)
        rank = np.argsort(np.where(kept, 0, np.where(real, 1, 2)), axis=1, kind="stable")[:, :most]
        chosen = np.where(np.take_along_axis(real, rank, axis=1), np.take_along_axis(part, rank, axis=1), -1)
        out[first : first + len(part), : chosen.shape[1]] = chosen
    return out


def _link_back(vectors: np.ndarray, links: np.ndarray, new: np.ndarray) -> None:
    """Give each node that new nodes link to a link back; a full node chooses anew among old and new ones."""
    source = np.repeat(new, links.shape[1])
    target = links[new].ravel()
    source, target = source[target >= 0], target[target >= 0]
    near = np.einsum("ij,ij->i", vectors[source], vectors[target])
    order = np.lexsort((-near, target))
    source, target = source[order], target[order]
    nodes, first, counts = np.unique(target, return_index=True, return_counts=True)
    rank = np.arange(len(target)) - np.repeat(first, counts)
    more = rank < LINKS  # the nearest; the others keep their own link to the node
    incoming = np.full((len(nodes), min(LINKS, int(counts.max(initial=0)))), -1, np.int32)
    incoming[np.repeat(np.arange(len(nodes)), counts)[more], rank[more]] = source[more]
    for at in range(0, len(nodes), COMPARED):
        some = nodes[at : at + COMPARED]
        both = np.concatenate([links[some], incoming[at : at + COMPARED]], axis=1)
        both = np.sort(both, axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        sims = np.where(both >= 0, np.einsum("ikd,id->ik", vectors[both], vectors[some]), -np.inf)
        order = np.argsort(-sims, axis=1, kind="stable")
        both, sims = np.take_along_axis(both, order, axis=1), np.take_along_axis(sims, order, axis=1)
        full = both[:, links.shape[1] :].max(axis=1, initial=-1) >= 0
        links[some] = both[:, : links.shape[1]]
        if full.any():
            links[some[full]] = _choose(vectors, both[full], sims[full], links.shape[1])


def _grow(vectors: np.ndarray, above: list[Layer], nodes: np.ndarray) -> Layer:
    """A layer over ``nodes``, those of the layer above first; inserted in batches that at most double it."""
    own = vectors[nodes]
    place = np.full(len(vectors) + 1, -1, np.int32)
    place[nodes] = np.arange(len(nodes))
    links = np.full((len(nodes), LINKS), -1, np.int32)
    known = len(above[-1].nodes) if above else 0
    done = 0
    while done < len(nodes):
        new = np.arange(done, min(len(nodes), done + max(32, min(BATCH, done))))
        if above and done < known:
            new = new[new < known]  # nodes above are entries only once they are here
        peers = own[new] @ own[new].T
        np.fill_diagonal(peers, -np.inf)
        near = np.argsort(-peers, axis=1, kind="stable")[:, : min(PEERS, len(new) - 1)]
        ids, sims = new[near].astype(np.int32), np.take_along_axis(peers, near, axis=1)
        if done:
            entries = np.zeros((len(new), 1), np.int32)
            if above and done >= known:
                found, _ = _descend(vectors, above, own[new], ENTRIES)
                entries = np.where(found >= 0, place[found], -1)
            old, old_sims = _walk(own[:done], links[:done], own[new], entries, min(BUILD_BEAM, done))
            ids, sims = np.concatenate([ids, old], axis=1), np.concatenate([sims, old_sims], axis=1)
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
        if ids.shape[1]:
            links[new, : LINKS // 2] = _choose(own, ids, sims, LINKS // 2)
            _link_back(own, links, new)
        done = int(new[-1]) + 1
    return Layer(nodes, links)


def build(vectors: np.ndarray) -> Graph:
    """The graph of unit vectors that come in random order: each layer has every THIN-th node of the one below, the first ones."""
    sizes = [len(vectors)]
    while sizes[-1] > THIN * THIN:
        sizes.append(sizes[-1] // THIN)
    layers: list[Layer] = []
    for size in reversed(sizes):
        layers.append(_grow(vectors, layers, np.arange(size)))
    return Graph(vectors, layers)
