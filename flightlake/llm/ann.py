"""Approximate nearest neighbours by cosine in robust-pruned directed graphs.

The distinct vectors are dealt into shards of bounded size. In a task, a shard
becomes a graph: greedy beam searches from the entry points propose neighbours
for each vector, and relaxed distance pruning keeps those that no kept one is
much nearer to, so that edges go in diverse directions; edges are added back
and pruned where they are too many. Every shard is searched by beam for every
query, and the shards' nearest are merged. All searches of a shard run in step,
as array operations over blocks of queries.

Vectors of one direction are one node; of the rows of equal vectors only the ``top + 1`` of least id can be
results. Nodes as near as the last result, or nearly, are all scored on the
original vectors, and ties (to ``_EQUAL`` decimals) go by id: an index of many parallel vectors is
looked through as a whole. Vectors that are null, zero, or hold null or non-finite components
take no part; vectors of another length than the query's are not compared.
Repeated rows count once. With few vectors, fewer results come back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stored

TOP = 5
#: Vectors in a shard, about.
SHARD = 4096
#: Out-edges, beam width of building and of search, relaxation, entry points.
DEGREE, BUILD_BEAM, BEAM, ALPHA, ENTRIES = 28, 48, 160, 1.2, 8
#: Queries searched in step.
BLOCK = 256
#: Cosines that differ by less are scored exactly before one is preferred.
_TIE = 1e-9
#: Decimals of unit vectors of one direction.
_ALIKE = 9
#: Decimals to which cosines are equal: of parallel vectors the last bits differ by rounding alone.
_EQUAL = 14


def beam_search(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """``(nodes, distances)`` of the ``beam`` nearest found for each row of
    ``q``, nearest first; -1 and infinity where there are fewer. ``graph`` has a
    row of out-edges for each node, -1 for none."""
    n, rows = len(q), np.arange(len(q))[:, None]
    ids = np.full((n, beam), -1, np.int64)
    dist = np.full((n, beam), np.inf)
    done = np.ones((n, beam), bool)
    first = np.unique(entries)[:beam]
    ids[:, :len(first)] = first
    dist[:, :len(first)] = 1 - q @ x[first].T
    done[:, :len(first)] = False
    met = np.zeros((n, len(x)), bool)
    met[:, first] = True
    while True:
        waiting = np.where(done, np.inf, dist)
        pick = waiting.argmin(1)
        act = np.flatnonzero(np.isfinite(waiting[np.arange(n), pick]))
        if not len(act):
            order = np.argsort(dist, 1, kind="stable")
            return ids[rows, order], dist[rows, order]
        done[act, pick[act]] = True
        near = graph[ids[act, pick[act]]]
        fresh = (near >= 0) & ~met[act[:, None], near]
        r, c = np.nonzero(fresh)
        met[act[r], near[r, c]] = True
        d = np.full(near.shape, np.inf)
        d[r, c] = 1 - np.einsum("ij,ij->i", q[act[r]], x[near[r, c]])
        all_d = np.hstack([dist[act], d])
        keep = np.argpartition(all_d, beam - 1, 1)[:, :beam]
        own = np.arange(len(act))[:, None]
        ids[act] = np.hstack([ids[act], near])[own, keep]
        dist[act] = all_d[own, keep]
        done[act] = np.hstack([done[act], ~fresh])[own, keep]


def robust_prune(x: np.ndarray, nodes: np.ndarray, found: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Out-edges of ``nodes`` from their candidates ``found`` (-1: none): the
    nearest is taken, and those that it is ``alpha`` times nearer to than the
    node are dropped, again and again."""
    found = np.where(found == nodes[:, None], -1, found)
    found = np.sort(found, 1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    v = x[found]
    to_node = np.where(found >= 0, 1 - np.einsum("ijk,ik->ij", v, x[nodes]), np.inf)
    out = np.full((len(nodes), degree), -1, np.int64)
    row = np.arange(len(nodes))
    for k in range(degree):
        best = to_node.argmin(1)
        ok = np.isfinite(to_node[row, best])
        if not ok.any():
            break
        out[ok, k] = found[row, best][ok]
        between = 1 - np.einsum("ijk,ik->ij", v, v[row, best])
        to_node[(alpha * between <= to_node) & ok[:, None]] = np.inf
        to_node[row, best] = np.inf
    return out


def build(x: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """``(graph, entries)`` over the unit rows of ``x``."""
    n, r = len(x), np.random.default_rng(seed)
    entries = np.unique(np.r_[(x @ x.mean(0)).argmax(), r.integers(0, n, ENTRIES)])
    if n <= DEGREE + 1:
        return np.where(np.arange(n)[None, :] == np.arange(n)[:, None], -1, np.arange(n)[None, :]), entries
    graph = r.integers(0, n, (n, DEGREE))
    for alpha in (1.0, ALPHA):
        for at in np.array_split(r.permutation(n), -(-n // BLOCK)):
            found, _ = beam_search(x, graph, entries, x[at], BUILD_BEAM)
            graph[at] = robust_prune(x, at, np.hstack([found, graph[at]]), DEGREE, alpha)
            # Edges back, by target: all at once, and pruned there.
            source, target = np.repeat(at, DEGREE), graph[at].ravel()
            source, target = source[target >= 0], target[target >= 0]
            order = np.argsort(target, kind="stable")
            source, target = source[order], target[order]
            goals, start, count = np.unique(target, return_index=True, return_counts=True)
            place = np.arange(len(target)) - np.repeat(start, count)
            back = np.full((len(goals), min(int(count.max()), 2 * DEGREE)), -1, np.int64)
            fits = place < back.shape[1]
            back[np.repeat(np.arange(len(goals)), count)[fits], place[fits]] = source[fits]
            graph[goals] = robust_prune(x, goals, np.hstack([graph[goals], back]), DEGREE, alpha)
    return graph, entries


def _search_shards(rows: DataFrame, top: int, kind: str) -> DataFrame:
    """Nearest of each query in each shard; ``rows(shard, is_query, vector,
    ids)`` come sorted by shard, vectors before queries. A shard's vectors and
    one block of queries are held at a time."""
    out_names = ["query_id", "vec_id", "score"]

    def run(batches):
        shard, held, waiting, index = None, [], [], None

        def answer():
            nonlocal index
            if not held or not waiting:
                waiting.clear()
                return None
            raw = np.array([v for v, _ in held])
            if index is None:
                # A node of the graph is a direction, whatever the lengths of its vectors.
                x = raw / np.linalg.norm(raw, axis=1)[:, None]
                _, first, of = np.unique(np.round(x, _ALIKE) + 0.0, axis=0, return_index=True, return_inverse=True)
                members = np.split(np.argsort(of, kind="stable"), np.cumsum(np.bincount(of))[:-1])
                x = x[first]
                index = (x, members, *build(x))
            x, members, graph, entries = index
            q = np.array([v for v, _ in waiting])
            norms = np.linalg.norm(q, axis=1)
            beam = min(BEAM, len(x))
            q = q / norms[:, None]
            found, far = beam_search(x, graph, entries, q, beam)
            rows = []
            for own, v, norm, unit, near, d in zip([i for _, i in waiting], [v for v, _ in waiting], norms, q, found, far):
                near, d = near[near >= 0], d[near >= 0]
                last = d[min(top, len(d) - 1)] + _TIE
                # Ties are told by id, not by the way there: if they may go on beyond the beam, all nodes are looked at.
                near = np.flatnonzero(1 - x @ unit <= last) if len(d) == beam < len(x) and d[-1] <= last else near[d <= last]
                near = np.concatenate([members[k] for k in near])
                score = raw[near] @ v / (np.linalg.norm(raw[near], axis=1) * norm)
                every = [(-round(s, _EQUAL), i, s) for s, k in zip(score.tolist(), near.tolist()) for i in held[k][1]]
                for query in own:
                    rows += [(query, i, s) for _, i, s in sorted(x for x in every if x[1] != query)[:top]]
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=out_names) if rows else None

        types = (id_type, id_type, pa.float64())
        for b in batches:
            vectors, offsets = b.column("vector").values.to_numpy(zero_copy_only=False), b.column("vector").offsets.to_numpy()
            for i, (s, is_query, ids) in enumerate(zip(*(b.column(c).to_pylist() for c in ("shard", "is_query", "ids")))):
                if s != shard:
                    if (done := answer()) is not None:
                        yield done
                    shard, index = s, None
                    held.clear()
                (waiting if is_query else held).append((vectors[offsets[i]:offsets[i + 1]].astype(float), ids))
                if len(waiting) == BLOCK and (done := answer()) is not None:
                    yield done
        if (done := answer()) is not None:
            yield done

    id_type = to_arrow_type(rows.schema["ids"].dataType.elementType)
    return rows.mapInArrow(run, f"query_id {kind}, vec_id {kind}, score double")


def nearest(embeddings: DataFrame, queries, top: int = TOP, shard_size: int = SHARD,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``top`` nearest found for each
    row of ``embeddings`` on which the condition ``queries`` holds, among all
    other rows: largest cosine first, ties to the smaller id."""
    v = F.col(vector_col)
    usable = (v.isNotNull() & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
              & F.exists(v, lambda c: c != 0) & F.col(id_col).isNotNull())
    rows = embeddings.where(usable).select(F.col(id_col).alias("id"), v.alias("vector"), queries.alias("asks")).distinct()
    first = rows.withColumn("turn", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("turn") <= top + 1)
    nodes = stored(first.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")), "nodes")
    sizes = nodes.groupBy(F.size("vector").alias("width")).agg(F.ceil(F.count(F.lit(1)) / shard_size).alias("shards"))
    width = F.size("vector")
    own = nodes.join(sizes, width == sizes["width"]).select(
        F.struct("width", F.pmod(F.xxhash64("vector"), F.col("shards")).alias("k")).alias("shard"),
        F.lit(False).alias("is_query"), "vector", "ids")
    asked = rows.where("asks").select("vector", F.array("id").alias("ids"))
    sent = asked.join(sizes, width == sizes["width"]).select(
        F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1), lambda k: F.struct(F.col("width"), k.alias("k")))).alias("shard"),
        F.lit(True).alias("is_query"), "vector", "ids")
    both = own.unionByName(sent).select(F.xxhash64("shard").alias("shard"), "is_query", "vector", "ids")
    found = _search_shards(both.repartition("shard").sortWithinPartitions("shard", "is_query"), top, dict(rows.dtypes)["id"])
    order = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", _EQUAL)), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))
