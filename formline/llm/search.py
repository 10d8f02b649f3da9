"""Exact top-k by integer inner product: ball trees per shard, branch and bound with a shared k-th score.

Vectors are dealt to clusters around at most 256 pivots and clusters cut into shards of bounded size. A shard's task
builds a ball tree (median cuts along the widest direction). An inner product with any vector of a ball is at
most ``q.center + |q| * radius``; a query opens leaves in the order of the least bound on their path and stops
below its k-th score so far. Queries start in their own shard, go on to the most promising
clusters and then to the rest, and take their k-th score with them: clusters, nodes and leaves below it are never opened.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formline.llm.common import stored

K = 5
EVERY = 50
SCALE = 256.0
PIVOTS = 256
#: Bytes of vectors a shard holds; smaller tables are still dealt to this many tasks.
SHARD_BYTES = 32 << 20
LEAST_ROWS = 1_024
LEAF = 128
#: Queries searched together.
QUERIES = 1_024
#: Clusters a query visits after its own shard and before all others.
SECOND = 4
#: Scores above this don't fit a long: vectors whose squared length is greater take no part.
TOP_SQUARE = 2.0**62
_NO_SCORE = np.iinfo(np.int64).min
_LAST_ID = np.iinfo(np.int64).max


def integer_vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", scale: float = SCALE) -> DataFrame:
    """``(row, vec_id, code, size)`` of usable vectors: ``floor(scale * x)`` as longs in bytes, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"row": [], "vec_id": [], "code": [], "size": []}
            for row, vec_id, values in zip(batch["row"].to_pylist(), batch["vec_id"].to_pylist(), batch["vector"], strict=True):
                if not values.is_valid or values.values.null_count:
                    continue
                scaled = np.floor(scale * values.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if not np.isfinite(scaled).all() or (scaled**2).sum() > TOP_SQUARE:
                    continue
                out["row"].append(row)
                out["vec_id"].append(vec_id)
                out["code"].append(scaled.astype("<i8").tobytes())
                out["size"].append(len(scaled))
            types = (pa.int64(), pa.int64(), pa.binary(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], names=list(out))

    numbered = rows.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint").alias("vec_id"), F.col(vector).alias("vector")
    )
    return numbered.mapInArrow(run, "row bigint, vec_id bigint, code binary, size int")


def _matrix(codes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(codes), "<i8").reshape(len(codes), -1)


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products: by floating point where no partial sum can leave its whole numbers, else by integers."""
    top = np.sqrt((x.astype(float) ** 2).sum(1).max(initial=0)) * np.sqrt((y.astype(float) ** 2).sum(1).max(initial=0))
    if top < 2.0**52:
        return (x.astype(float) @ y.astype(float).T).astype(np.int64)
    return x @ y.T


class BallTree:
    """Balls over the rows of a matrix, halved along the widest direction down to ``leaf`` rows."""

    def __init__(self, vectors: np.ndarray, leaf: int = LEAF):
        points = vectors.astype(float)
        self.order = np.arange(len(points))
        centers, radii, parents, spans = [], [], [], []
        stack = [(0, len(points), -1)]
        while stack:
            low, high, parent = stack.pop()
            part = points[self.order[low:high]]
            center = part.mean(axis=0) if part.size else np.zeros(points.shape[1])
            away = ((part - center) ** 2).sum(1)
            node = len(centers)
            centers.append(center)
            radii.append(float(np.sqrt(away.max(initial=0))))
            parents.append(parent)
            spans.append((low, high))
            if high - low <= leaf or radii[-1] == 0:
                continue
            far = part[away.argmax()]
            other = part[((part - far) ** 2).sum(1).argmax()]
            half = (high - low) // 2
            ranks = np.argpartition(part @ (other - far), half)
            self.order[low:high] = self.order[low:high][ranks]
            stack += [(low, low + half, node), (low + half, high, node)]
        self.centers, self.radii, self.parents, self.spans = np.array(centers), np.array(radii), parents, spans
        inner = set(parents)
        self.leaves = [i for i in range(len(parents)) if i not in inner]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and leaf: what no inner product in the leaf exceeds, the least bound on the leaf's path."""
        points = queries.astype(float)
        size = np.sqrt((points**2).sum(1))[:, None]
        reach = np.sqrt((self.centers**2).sum(1)) + self.radii
        bound = points @ self.centers.T + size * self.radii + size * reach * 1e-9 + 1e-6
        for node, parent in enumerate(self.parents):  # parents come first
            if parent >= 0:
                np.minimum(bound[:, node], bound[:, parent], out=bound[:, node])
        return bound[:, self.leaves]


class _Best:
    """The k best candidates of each query so far: by score, then by id, then by row."""

    def __init__(self, kth: np.ndarray, k: int):
        # What earlier shards found isn't repeated here: their k-th score alone is known.
        self.kth, self.k = kth, k
        self.found = tuple(np.empty(0, np.int64) for _ in range(4))  # query, score, id, row

    def add(self, query, score, vec_id, row) -> None:
        query, score, vec_id, row = (np.concatenate(x) for x in zip(self.found, (query, score, vec_id, row), strict=True))
        order = np.lexsort((row, vec_id, -score, query))
        query, score, vec_id, row = query[order], score[order], vec_id[order], row[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        full = rank == self.k - 1
        self.kth[query[full]] = np.maximum(self.kth[query[full]], score[full])
        kept = rank < self.k
        self.found = query[kept], score[kept], vec_id[kept], row[kept]


def search(tree: BallTree, vectors, vec_ids, rows, queries, own_rows, kth: np.ndarray, k: int = K) -> tuple[np.ndarray, ...]:
    """``(query, score, vec_id, row)`` of what may be among each query's k best; ``kth`` are the scores to reach.

    Every query opens its leaves from the highest bound down; those that are at the same leaf in a round
    meet it together. A query stops where the next bound is below its k-th score: equal ones may hold a smaller id.
    """
    best = _Best(kth.copy(), k)
    bound = tree.bounds(queries)
    order = np.argsort(-bound, axis=1, kind="stable")
    active = np.arange(len(queries))
    for turn in range(len(tree.leaves)):
        leaf = order[active, turn]
        active, leaf = (x[bound[active, leaf] >= best.kth[active]] for x in (active, leaf))
        if not len(active):
            break
        grouped = np.argsort(leaf, kind="stable")
        for group in np.split(grouped, np.flatnonzero(np.diff(leaf[grouped])) + 1):
            asking = active[group]
            low, high = tree.spans[tree.leaves[leaf[group[0]]]]
            at = tree.order[low:high]
            score = _products(queries[asking], vectors[at])
            fits = (score >= best.kth[asking][:, None]) & (rows[at] != own_rows[asking][:, None])
            i, j = np.nonzero(fits)
            if len(i):
                best.add(asking[i], score[i, j], vec_ids[at[j]], rows[at[j]])
    return best.found


def _wave(placed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The best candidates of queries in the shards they are sent to. ``asked`` has ``shard, row, code, kth``.

    A task reads a shard's vectors first and then its queries in batches; it holds one shard at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, tree = None, [], None
        for batch in batches:
            shards = batch["shard"].to_pylist()
            kinds = batch["kind"].to_numpy()
            # Runs of rows of one shard and kind.
            new = [i for i in range(len(shards)) if i == 0 or shards[i] != shards[i - 1] or kinds[i] != kinds[i - 1]]
            for low, high in zip(new, [*new[1:], len(shards)], strict=True):
                if shards[low] != now:
                    now, held, tree = shards[low], [], None
                part = batch.slice(low, high - low)
                if kinds[low] == 0:
                    held.append(part)
                    continue
                if not held:
                    continue
                if tree is None:
                    vectors = _matrix([c for p in held for c in p["code"].to_pylist()])
                    ids = np.concatenate([p["vec_id"].fill_null(_LAST_ID).to_numpy() for p in held])
                    rows = np.concatenate([p["row"].to_numpy() for p in held])
                    tree = BallTree(vectors)
                for first in range(0, part.num_rows, QUERIES):
                    some = part.slice(first, QUERIES)
                    own = some["row"].to_numpy()
                    kth = some["kth"].fill_null(_NO_SCORE).to_numpy(zero_copy_only=False).astype(np.int64)
                    query, score, vec_id, row = search(tree, vectors, ids, rows, _matrix(some["code"].to_pylist()), own, kth, k)
                    yield pa.RecordBatch.from_pydict({"query": own[query], "score": score, "vec_id": vec_id, "row": row})

    columns = ["shard", "kind", "row", "vec_id", "code", "kth"]
    vectors = placed.withColumns({"kind": F.lit(0), "kth": F.lit(None).cast("bigint")}).select(columns)
    queries = asked.withColumns({"kind": F.lit(1), "vec_id": F.lit(None).cast("bigint")}).select(columns)
    dealt = vectors.unionAll(queries).repartition("shard").sortWithinPartitions("shard", "kind")
    return dealt.mapInArrow(run, "query bigint, score bigint, vec_id bigint, row bigint")


def _best_of(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _pivots(rows: DataFrame, most: int) -> dict[int, np.ndarray]:
    """At most ``most`` distinct vectors, those of the least hashes, by their number of components."""
    codes = rows.orderBy(F.xxhash64("code"), "row").limit(most * (K + 1)).select("code").collect()
    out: dict[int, list[bytes]] = {}
    for code in list(dict.fromkeys(bytes(r["code"]) for r in codes))[:most]:
        out.setdefault(len(code) // 8, []).append(code)
    return {size: _matrix(some).astype(float) for size, some in out.items()}


def _clustered(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """The rows with ``cluster``, the nearest pivot of as many components (-1 without one), and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["size"].to_numpy()
            cluster, distance = np.full(len(sizes), -1, np.int32), np.full(len(sizes), np.inf)
            codes = batch["code"].to_pylist()
            for size in np.unique(sizes).tolist():
                at, near = np.flatnonzero(sizes == size), pivots.get(size)
                if near is None:
                    continue
                points = _matrix([codes[i] for i in at]).astype(float) if size else np.zeros((len(at), 0))
                squares = (points**2).sum(1)[:, None] - 2 * points @ near.T + (near**2).sum(1)
                cluster[at] = squares.argmin(axis=1)
                distance[at] = np.sqrt(((points - near[cluster[at]]) ** 2).sum(1))
            columns = [batch[c] for c in ("row", "vec_id", "code", "size")] + [pa.array(cluster), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "vec_id", "code", "size", "cluster", "distance"])

    return rows.mapInArrow(run, "row bigint, vec_id bigint, code binary, size int, cluster int, distance double")


def _shard(parts: str = "parts"):
    piece = F.pmod(F.xxhash64("row"), F.col(parts))
    return F.concat_ws(":", "size", "cluster", piece)


def _sent(asked: DataFrame, clusters: DataFrame, pivots: dict[int, np.ndarray], second: bool) -> DataFrame:
    """Each query with the clusters whose bound reaches its k-th score: the best ``SECOND`` ones, or all others."""
    # At most one row per pivot, and one per number of components that no pivot has.
    known = {(r["size"], r["cluster"]): r["radius"] for r in clusters.where("cluster >= 0").collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, codes = batch["size"].to_numpy(), batch["code"].to_pylist()
            kth = batch["kth"].fill_null(_NO_SCORE).to_numpy(zero_copy_only=False).astype(float)
            rows, found = [], []
            for size in np.unique(sizes).tolist():
                at, near = np.flatnonzero(sizes == size), pivots.get(size)
                if near is None:
                    if second:
                        rows.append(at)
                        found.append(np.full(len(at), -1))
                    continue
                points = _matrix([codes[i] for i in at]).astype(float) if size else np.zeros((len(at), 0))
                radius = np.array([known.get((size, c), -np.inf) for c in range(len(near))])
                length = np.sqrt((points**2).sum(1))[:, None]
                reach = np.sqrt((near**2).sum(1)) + np.maximum(radius, 0)
                bound = points @ near.T + np.where(length > 0, length * radius, np.where(radius >= 0, 0, -np.inf)) + length * reach * 1e-9 + 1e-6
                fits = bound >= np.where(kth[at] > float(_NO_SCORE), kth[at], -np.inf)[:, None]
                fits &= radius >= 0
                order = np.argsort(-bound, axis=1, kind="stable")
                place = np.empty_like(order)
                np.put_along_axis(place, order, np.arange(len(near))[None, :].repeat(len(at), 0), axis=1)
                i, c = np.nonzero(fits & ((place < SECOND) if second else (place >= SECOND)))
                rows.append(at[i])
                found.append(c)
            pick = np.concatenate(rows) if rows else np.empty(0, np.int64)
            target = np.concatenate(found) if found else np.empty(0, np.int64)
            chosen = pa.Table.from_batches([batch.select(["row", "code", "size", "kth", "home"])]).take(pa.array(pick))
            yield from chosen.append_column("cluster", pa.array(target, pa.int32())).combine_chunks().to_batches()

    schema = "row bigint, code binary, size int, kth bigint, home string, cluster int"
    pairs = asked.select("row", "code", "size", "kth", "home").mapInArrow(run, schema)
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")
    every = clusters.select("size", "cluster", parts)
    every = every.select("size", "cluster", F.concat_ws(":", "size", "cluster", "part").alias("shard"))
    return pairs.join(every, ["size", "cluster"]).where("shard <> home").drop("home")


def top_products(
    rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", every: int = EVERY, k: int = K, scale: float = SCALE
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for rows whose id is divisible by ``every``, the best k among all other rows.

    Vectors that are NULL or hold NULL or non-finite components take no part, nor do those whose score
    could leave a long (squared length above 2^62). Vectors are compared with those of as many components. Equal
    scores go by id, a NULL id last, then by row. Each row is a candidate and, where its id says so, a query of its own,
    also if rows share an id or a vector. Other columns aren't read. An empty table gives an empty result.
    """
    coded = stored(integer_vectors(rows, id_column, vector, scale), "vectors")
    # Of equal vectors a query can only meet the first k, and its own: no more are searched.
    alike = W.partitionBy("code", "size").orderBy(F.col("vec_id").asc_nulls_last(), "row")
    candidates = coded.withColumn("n", F.row_number().over(alike)).where(F.col("n") <= k + 1).drop("n")
    candidates = stored(candidates, "candidates")
    count, size = candidates.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    pivots = _pivots(candidates, max(1, min(PIVOTS, -(-count // (4 * LEAST_ROWS)))))
    rows_a_shard = max(1, min(SHARD_BYTES * count // (8 * size) if size else count, max(LEAST_ROWS, count // 64))) if count else 1
    spread = stored(_clustered(candidates, pivots), "clustered")
    clusters = stored(
        spread.groupBy("size", "cluster").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n")).select(
            "size", "cluster", "radius", F.ceil(F.col("n") / F.lit(rows_a_shard)).cast("bigint").alias("parts")
        ), "clusters",
    )
    placed = stored(spread.join(clusters.drop("radius"), ["size", "cluster"]).withColumn("shard", _shard()), "placed")
    asked = coded.where(F.col("vec_id") % every == 0)
    asked = _clustered(asked, pivots).join(clusters.drop("radius"), ["size", "cluster"]).withColumn("home", _shard())
    asked = stored(asked.select("row", "vec_id", "code", "size", "home"), "queries")

    found = stored(_wave(placed, asked.select(F.col("home").alias("shard"), "row", "code", F.lit(None).cast("bigint").alias("kth")), k), "found")
    for second in (True, False):
        kth = _best_of(found, k).where(F.col("rank") == k).select(F.col("query").alias("row"), F.col("score").alias("kth"))
        pairs = stored(_sent(asked.join(kth, "row", "left"), clusters, pivots, second), "pairs")
        found = stored(_best_of(found.unionAll(_wave(placed, pairs, k)), k).drop("rank"), "found")
    names = asked.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"))
    return _best_of(found, k).join(names, "query").select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.nullif("vec_id", F.lit(_LAST_ID)).alias("vec_id"), "score"
    )
