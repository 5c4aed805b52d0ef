"""Embedding near-dedup: a small-world graph per shard, every shard asked, cosine verified, components united."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hnsw
from .shared import components, forest, store

#: Cosine of a link; least number of shards, bytes of the vectors of one and of a block of queries, most vectors of one.
COSINE, SHARDS, SHARD_BYTES, BLOCK_BYTES, SHARD_ROWS, BLOCK_ROWS = 0.9, 8, 1 << 25, 1 << 22, 65536, 8192
#: First beam, and how much wider the next one is; queries drawn at a time for the audit, how many of them must tell something, and the
#: mean recall that they must reach.
BEAM, WIDER, AUDITED, ENOUGH, RECALL = 32, 4, 256, 64, 0.99
#: Single precision finds candidates this far below the threshold; double precision decides.
SLACK = 1e-5
#: Queries that are answered at a time: so many at most, fewer with wide beams, and those compared with a whole shard.
ASKED, CELLS, COMPARED = 1024, 1 << 19, 64


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def _unit(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def _exact(unit: np.ndarray, queries: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, vector) of all pairs at ``least``, by comparing all, in portions."""
    for i in range(0, len(queries), COMPARED):
        q, v = np.nonzero(queries[i : i + COMPARED] @ unit.T >= least)
        yield q + i, v


def link_portions(graph: hnsw.Graph, queries: np.ndarray, least: float, seed: int = 0, own: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, node) of what the graph finds at similarity ``least``, in portions of bounded size; each pair once.

    ``queries`` are unit vectors, ``own`` the node that a query is itself (-1: none).  The beam is widened for all queries until the mean
    recall of audited queries reaches RECALL, and further for each query of which
    more than half the beam are links.  Queries are drawn for the audit until ENOUGH of them have links to others and do not end in a
    full comparison anyway, or until all are drawn; a drawn query is compared with all vectors, which is its answer too.  Every query
    counts alike, however many links it has.  A beam as wide as the graph is a full comparison.
    """
    beam, drawn = BEAM, 0
    own = np.full(len(queries), -1) if own is None else own
    order, links = np.random.default_rng(seed).permutation(len(queries)), np.zeros(len(queries), np.int64)
    while 2 * beam < len(graph.vectors):
        recalls: list[float] = []
        at = 0  # a wider beam is tried on all that are drawn already
        while len(recalls) < ENOUGH and at < len(queries):
            some = order[at : at + AUDITED]
            if at >= drawn:
                for q, v in _exact(graph.vectors, queries[some], least):
                    links[some] += np.bincount(q[v != own[some[q]]], minlength=len(some))
                    yield some[q], v
                drawn += len(some)
            at += len(some)
            some = some[links[some] > 0]
            found, full = np.zeros(len(some), np.int64), np.zeros(len(some), bool)
            for q, v in _widened(graph, queries[some], least, beam, full):
                found += np.bincount(q[v != own[some[q]]], minlength=len(some))
            recalls += (found / links[some])[~full].tolist()
        if not recalls or np.mean(recalls) >= RECALL:
            break
        beam *= WIDER
    rest = order[drawn:]
    for q, v in _widened(graph, queries[rest], least, beam, np.zeros(len(rest), bool)):
        yield rest[q], v


def search_links(graph: hnsw.Graph, queries: np.ndarray, least: float, seed: int = 0, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All portions of ``link_portions`` together."""
    parts = [(np.empty(0, np.int64), np.empty(0, np.int64)), *link_portions(graph, queries, least, seed, own)]
    return tuple(np.concatenate(x) for x in zip(*parts))


def _widened(graph: hnsw.Graph, queries: np.ndarray, least: float, beam: int, compared: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, node) of the links found, in portions; ``compared`` is set for queries that are compared with all vectors.

    A query with many links gets a wider beam once, and is compared with all vectors if that one is too full as well.
    """
    asked, most = np.arange(len(queries)), beam * WIDER
    while len(asked):
        if beam > most or 2 * beam >= len(graph.vectors):
            compared[asked] = True
            for q, v in _exact(graph.vectors, queries[asked], least):
                yield asked[q], v
            return
        again = []
        portion = max(1, min(ASKED, CELLS // beam))
        for at in range(0, len(asked), portion):
            some = asked[at : at + portion]
            nodes, sims = graph.search(queries[some], beam, seeds=beam // BEAM - 1)
            hit = (sims >= least) & (nodes >= 0)
            full = 2 * hit.sum(axis=1) > beam
            again.append(some[full])
            q, k = np.nonzero(hit & ~full[:, None])
            yield some[q], nodes[q, k]
        asked, beam = np.concatenate(again), beam * WIDER


class Groups:
    """Groups of nodes that grow by edges; one label per node, whatever the number of edges."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        a, b = self.label[a], self.label[b]
        apart = a != b
        if apart.any():
            node, root = forest(a[apart], b[apart])
            to = np.arange(len(self.label))
            to[node] = root
            self.label = to[self.label]


def answer(graph: hnsw.Graph, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray, asked: np.ndarray, wanted: np.ndarray, cosine: float, seed: int):
    """What one block of queries (``asked``, ``wanted``) links to in a shard: (counts by query, nodes, roots of a spanning forest).

    Pairs are checked in double precision and united portion by portion; what is kept has the size of block and shard.
    """
    nodes, place = np.unique(np.concatenate([asked, ids]), return_inverse=True)
    mine, theirs = place[: len(asked)], place[len(asked) :]
    where = np.full(len(nodes), -1)
    where[theirs] = np.arange(len(ids))
    counts, groups = np.zeros(len(asked), np.int64), Groups(len(nodes))
    for q, v in link_portions(graph, _unit(wanted), cosine - SLACK, seed, where[mine]):
        for i in range(0, len(q), 65536):
            a, b = q[i : i + 65536], v[i : i + 65536]
            sure = (asked[a] != ids[b]) & (_cosines(wanted[a], vectors[b]) >= cosine)
            a, b = a[sure], b[sure]
            counts += np.bincount(a, weights=copies[b], minlength=len(asked)).astype(np.int64)
            groups.unite(mine[a], theirs[b])
    moved = groups.label != np.arange(len(nodes))
    return counts, nodes[moved], nodes[groups.label[moved]]


def _pack(part: pd.DataFrame) -> dict:
    vectors = np.stack(part["vector"].to_numpy()).astype(np.float64)
    return {"ids": part["cid"].to_numpy(np.int64).tobytes(), "copies": part["copies"].to_numpy(np.int64).tobytes(), "vectors": vectors.tobytes()}


def _unpack(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["copies"], np.int64), np.frombuffer(row["vectors"], np.float64).reshape(len(ids), -1)


def _ordered(part: pd.DataFrame) -> pd.DataFrame:
    return part.sort_values(["place", "cid"])


_PACKED = "ids binary, copies binary, vectors binary"


def links(
    classes: DataFrame, cosine: float = COSINE, shards: int = SHARDS, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
    shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, n, root) for ``classes`` (cid, copies, vector: different vectors, none of them zero or with a non-finite component).

    A row with n counts the copies of the other classes that class ``id`` links to in one shard; a row with root is an edge of a spanning
    forest of the links found in one shard for one block of queries, so no task ever returns the pairs of a dense group.

    Every shard has a graph of its own, made once and kept in the shared folder; the queries, all classes, go in blocks to every shard.  A
    task gets a shard first and then its blocks one after the other, so it holds one shard and one block, and a shard is
    shuffled once per task that asks it, not once per block.  Shards and blocks are cut by rows and by bytes, whatever the dimension.
    Vectors of different lengths never meet.
    """
    spark = classes.sparkSession
    sizes = store(classes.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("of")), "sizes")
    row = F.col("dim") * 8
    rows_in = lambda rows, held: F.greatest(F.lit(1), F.least(F.lit(rows), F.floor(F.lit(held) / row)))
    sizes = sizes.withColumns(
        {
            "shards": F.greatest(F.lit(shards), F.ceil(F.col("of") / rows_in(shard_rows, shard_bytes))).cast("bigint"),
            "blocks": F.greatest(F.lit(1), F.ceil(F.col("of") / rows_in(block_rows, block_bytes))).cast("bigint"),
        }
    )
    spread = classes.withColumn("dim", F.size("vector")).join(sizes.drop("of"), "dim").withColumns(
        {"shard": F.pmod(F.xxhash64("cid", F.lit(1)), "shards"), "block": F.pmod(F.xxhash64("cid", F.lit(2)), "blocks"), "place": F.xxhash64("cid", F.lit(3))}
    )

    def make(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        packed = _pack(_ordered(part))
        graph = hnsw.build(_unit(_unpack(packed)[2]))
        return pd.DataFrame([{"dim": key[0], "shard": key[1], **packed, "graph": graph.pack()}])

    def gather(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"dim": key[0], "block": key[1], **_pack(_ordered(part))}])

    indexes = store(spread.groupBy("dim", "shard").applyInPandas(make, f"dim int, shard bigint, {_PACKED}, graph binary"), "indexes")
    queries = store(spread.groupBy("dim", "block").applyInPandas(gather, f"dim int, block bigint, {_PACKED}"), "queries")

    # groups of blocks that one task asks of a shard: as many as it takes to have a task for every shuffle partition
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = sizes.agg(F.sum("shards").alias("shards")).first()["shards"] or 1
    groups = max(1, -(-wanted // known))
    every_shard = queries.join(sizes.select("dim", "shards"), "dim").withColumns(
        {"shard": F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)), "team": F.pmod("block", F.lit(groups)), "graph": F.lit(None).cast("binary")}
    )
    every_team = indexes.join(sizes.select("dim", "blocks"), "dim").withColumns(
        {"team": F.explode(F.sequence(F.lit(0).cast("bigint"), F.least(F.col("blocks"), F.lit(groups)) - 1)), "block": F.lit(-1).cast("bigint")}
    )
    cols = ["dim", "shard", "team", "block", "ids", "copies", "vectors", "graph"]
    dealt = every_team.select(*cols).unionByName(every_shard.select(*cols))
    # a shard sorts before its blocks
    dealt = dealt.repartition(max(wanted, known * groups), "dim", "shard", "team").sortWithinPartitions("dim", "shard", "team", "block")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if row["block"] < 0:
                    ids, copies, vectors = _unpack(row)
                    held, at = (hnsw.Graph.unpack(_unit(vectors), row["graph"]), ids, copies, vectors), (row["dim"], row["shard"], row["team"])
                    continue
                if (row["dim"], row["shard"], row["team"]) != at:
                    continue  # a shard without vectors
                asked, _, wanted_vectors = _unpack(row)
                counts, node, root = answer(*held, asked, wanted_vectors, cosine, int(row["shard"]) * 1_000_003 + int(row["block"]))
                some = np.flatnonzero(counts)
                none = lambda n: pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(asked[some]), pa.array(counts[some]), none(len(some))], ["id", "n", "root"])
                yield pa.RecordBatch.from_arrays([pa.array(node), none(len(node)), pa.array(root)], ["id", "n", "root"])

    return dealt.mapInArrow(ask, "id bigint, n bigint, root bigint")


def mark_near_vectors(
    vectors: DataFrame, cosine: float = COSINE, shards: int = SHARDS, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
    shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of ``vectors`` (vec_id, embedding: array of numbers).

    Equal vectors are one class in the search, and link to each other; n_links counts rows.  component_id is the smallest vec_id that links
    reach, itself included, and kept says that it is the row's own.  A vector that is null, empty or zero, or holds a null or
    non-finite component, links with nothing.  A null vec_id is a row like any other and names a component only if all its rows are
    null; rows that repeat an id and a vector are copies of each other.  An empty table gives an empty result; other columns are not read.
    """
    value = F.transform("embedding", lambda x: x.cast("double"))
    # neither the smallest nor the largest doubles may vanish or overflow when squared
    top = F.array_max(F.transform("embedding", lambda x: F.abs(x.cast("double"))))
    fine = F.size("embedding") > 0
    fine = fine & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))) & (top > 0)
    scale = F.when((top > 1e100) | (top < 1e-100), top).otherwise(F.lit(1.0))
    scaled = F.transform(value, lambda x: x / scale + F.lit(0.0))  # -0.0 is 0.0
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.monotonically_increasing_id().alias("rid"), F.when(F.coalesce(fine, F.lit(False)), scaled).alias("vector"))
    rows = store(rows, "vectors")
    classes = rows.filter("vector is not null").groupBy("vector").agg(F.min("rid").alias("cid"), F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    classes = store(classes, "classes")
    found = store(links(classes.select("cid", "copies", "vector"), cosine, shards, shard_rows, block_rows, shard_bytes, block_bytes), "links")
    counts = found.filter("n is not null").groupBy("id").agg(F.sum("n").alias("others"))
    united = components(found.filter("root is not null").select(F.col("id").alias("u"), F.col("root").alias("v")))
    known = classes.join(united, F.col("cid") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cid"))
    known = known.join(counts, F.col("cid") == F.col("id"), "left").select("vector", "root", "low", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    known = store(known, "known")
    lows = store(known.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    known = store(known.join(lows, "root").select("vector", "n_links", "component_id"), "known")
    out = rows.join(known, "vector", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
