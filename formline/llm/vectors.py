"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.common import stored
from formline.llm.graph import components

COSINE = 0.9
#: Buckets that a vector looks into per table.
PROBES = 8
#: Vectors per bucket, on average, from which one more hash is joined in a bucket.
FULL = 5
BLOCK = 512
ROWS_PER_CALL = 4000
_TOP = 3


def _padded(width: int) -> int:
    return max(2, 1 << (width - 1).bit_length())


def settings(width: int, rows: int) -> tuple[int, int]:
    """Hash tables, and cross-polytope hashes joined in a bucket, for so many vectors of a width.

    Hashes grow with the number of vectors, so that buckets stay small; tables grow with the width and the hashes, so
    that more than 0.95 of the pairs at a cosine of 0.9 are found at every width up to 1,024 (tests measure it).
    """
    size, hashes = _padded(width), 3
    while rows > FULL * (2 * size) ** hashes and (2 * size) ** (hashes + 1) < 1 << 62:
        hashes += 1
    return max(8, 2 * size.bit_length() - 6) << (hashes - 3), hashes


@lru_cache(8)
def _signs(width: int, tables: int, hashes: int) -> np.ndarray:
    return np.random.default_rng(width).choice([-1.0, 1.0], (tables, hashes, 3, width))


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the width is a power of two."""
    half, width = 1, x.shape[1]
    while half < width:
        pairs = x.reshape(len(x), width // (2 * half), 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(x), width)
        half *= 2
    return x / np.sqrt(width)


def probe_codes(x: np.ndarray, tables: int, hashes: int, probes: int = PROBES) -> np.ndarray:
    """Bucket codes of unit rows, shape (rows, tables, probes), the nearest bucket first.

    Three rounds of random signs and the transform rotate a row; its hash is the axis, with sign,
    that it is nearest to. Further probes take the next axes where least is lost.
    """
    width = _padded(x.shape[1])
    padded = np.pad(x, ((0, 0), (0, width - x.shape[1])))
    choices = np.array(list(product(range(min(_TOP, width)), repeat=hashes)))
    codes = np.empty((len(x), tables, min(probes, len(choices))), np.int64)
    for t, table in enumerate(_signs(width, tables, hashes)):
        code, loss = np.zeros((len(x), len(choices)), np.int64), np.zeros((len(x), len(choices)))
        for h, rounds in enumerate(table):
            y = padded
            for signs in rounds:
                y = _hadamard(y * signs)
            axes = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :_TOP]
            near = np.take_along_axis(y, axes, 1)
            sides = axes * 2 + (near < 0)
            code = code * (2 * width) + sides[:, choices[:, h]]
            loss += (np.abs(near[:, :1]) - np.abs(near))[:, choices[:, h]]
        best = np.argsort(loss, axis=1, kind="stable")[:, : codes.shape[2]]
        codes[:, t] = np.take_along_axis(code, best, 1)
    return codes


def _sketches(x: np.ndarray) -> list[bytes]:
    """Per unit row its values in whole steps of one byte, behind the size of a step and the length of what rounding took."""
    step = np.abs(x).max(1) / 127
    whole = np.rint(x / step[:, None]).astype(np.int8)
    rest = np.linalg.norm(x - whole * step[:, None], axis=1)
    return [np.array(head).tobytes() + w.tobytes() for head, w in zip(np.stack([step, rest], 1), whole, strict=True)]


def _coded(reps: DataFrame, rows: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, same in batch.groupby(batch["vector"].map(len)):
                x = np.array(same["vector"].to_list(), np.float64)
                # A power of two first: exact, and no square leaves the range of doubles.
                x = np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                codes = probe_codes(x, *settings(x.shape[1], rows)).reshape(len(x), -1)
                yield pd.DataFrame({
                    "node": same["node"].to_numpy(), "copies": same["copies"].to_numpy(), "width": x.shape[1],
                    "unit": [u.tobytes() for u in x], "codes": list(codes), "sketch": _sketches(x),
                })

    return reps.mapInPandas(run, "node bigint, copies bigint, width int, unit binary, codes array<bigint>, sketch binary")


def _blocks_plausible(group: pd.DataFrame) -> pd.DataFrame:
    """The entries that may link with one of the other side of their block, by sketches.

    For unit vectors u, v and their rounded forms, off by lengths r and s, the product of the forms is off by
    at most r + (1 + r) s. No link is lost.
    """
    good = np.zeros(len(group), bool)
    node, home = group["node"].to_numpy(), group["home"].to_numpy()
    for at in group.reset_index(drop=True).groupby(["width", "table", "code", "x", "y"], sort=False).indices.values():
        sides = [at[~home[at]], at[home[at]]]
        if not len(sides[0]) or not len(sides[1]):
            continue
        raw = [b"".join(group["sketch"].iloc[s]) for s in sides]
        raw = [np.frombuffer(r, np.int8).reshape(len(s), -1) for r, s in zip(raw, sides, strict=True)]
        (a, r), (b, s) = [np.ascontiguousarray(w[:, :16]).view(np.float64).T for w in raw]
        x, y = [w[:, 16:] * step[:, None] for w, step in zip(raw, (a, b), strict=True)]
        near = x @ y.T + r[:, None] + (1 + r[:, None]) * s + 1e-6 >= COSINE
        near &= node[sides[0]][:, None] != node[sides[1]]
        good[sides[0]] |= near.any(1)
        good[sides[1]] |= near.any(0)
    return group.loc[good, ["width", "table", "code", "node", "home", "x", "y"]]


def _block_links(rows: dict[str, np.ndarray], at: np.ndarray, counts: dict[int, int]) -> Iterator[tuple[int, int]]:
    """Counts all links between the lookers and the residents of two blocks; yields enough of them to join what they join."""
    table, code = int(rows["table"][at[0]]), int(rows["code"][at[0]])
    lookers, homes = at[~rows["home"][at]], at[rows["home"][at]]
    if not len(lookers) or not len(homes):
        return
    node, codes = rows["node"], rows["codes"]
    x = np.frombuffer(b"".join(rows["unit"][lookers]), np.float64).reshape(len(lookers), -1)
    y = np.frombuffer(b"".join(rows["unit"][homes]), np.float64).reshape(len(homes), -1)
    i, j = np.nonzero(x @ y.T >= COSINE)
    i, j = lookers[i], homes[j]
    parent: dict[int, int] = {}

    def root(n: int) -> int:
        while parent.get(n, n) != n:
            n = parent[n]
        return n

    for k in range(0, len(i), 20_000):
        a, b = i[k : k + 20_000], j[k : k + 20_000]
        a_codes, b_codes = codes[a], codes[b]
        a_home, b_home = a_codes[:, :, 0], b_codes[:, :, 0]
        meets = (a_codes == b_home[:, :, None]).any(2)
        back = (b_codes == a_home[:, :, None]).any(2)
        # A pair counts in the first table where one looks into the other's bucket, ...
        good = (node[a] != node[b]) & ~(meets | back)[:, :table].any(1)
        # ... there in the lesser of two such buckets, and once if both reside in it.
        resident = a_home[:, table] == code
        good &= np.where(resident, node[a] < node[b], ~back[:, table] | (code < a_home[:, table]))
        for p, q in zip(a[good], b[good], strict=True):
            m, n = int(node[p]), int(node[q])
            counts[m] = counts.get(m, 0) + int(rows["copies"][q])
            counts[n] = counts.get(n, 0) + int(rows["copies"][p])
            r, s = root(m), root(n)
            if r != s:
                parent[max(r, s)] = min(r, s)
                yield m, n


def _blocks_links(group: pd.DataFrame) -> pd.DataFrame:
    out, counts = [], {}
    for _, same in group.groupby("width"):
        rows = {c: same[c].to_numpy() for c in same.columns}
        rows["codes"] = np.array(same["codes"].to_list(), np.int64).reshape(len(same), -1, PROBES)
        for at in same.reset_index(drop=True).groupby(["table", "code", "x", "y"], sort=False).indices.values():
            out += [(a, b, 0) for a, b in _block_links(rows, at, counts)]
    out += [(a, None, n) for a, n in counts.items()]
    return pd.DataFrame(out, columns=["a", "b", "n"]).astype({"a": "Int64", "b": "Int64", "n": "Int64"})


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row, whatever the labels.

    Equal vectors are one node that counts its copies. Every vector resides in one bucket per table and looks into the ``PROBES``
    nearest. Residents and lookers of a bucket meet in blocks of bounded size, first as sketches of a byte per value: vectors
    are sent only to the blocks where they may link. Of the links only counts and a spanning part leave the task.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components link with nothing, and so do rows with a NULL id
    (their component is NULL and they are kept). Vectors of different lengths never link. Repeated rows are linked copies.
    """
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    good = F.col("id").isNotNull() & (F.size("vector") > 0) & F.forall("vector", finite) & F.exists("vector", lambda v: v != 0)
    rows = stored(rows.withColumn("vector", F.when(good, F.col("vector"))), "vectors")
    reps = rows.where("vector is not null").groupBy("vector").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("copies"))
    # Rows that share an id but not a vector: each vector is a node of its own.
    reps = stored(reps.withColumn("id", F.col("node")).withColumn("node", F.monotonically_increasing_id()), "distinct")
    coded = stored(_coded(reps.select("node", "copies", "vector"), reps.count()), "codes")

    entries = coded.select("node", "width", F.posexplode("codes").alias("place", "code")).select(
        "node", "width", "code", F.floor(F.col("place") / F.lit(PROBES)).cast("int").alias("table"),
        (F.col("place") % PROBES == 0).alias("first"),
    )
    key = ["width", "table", "code"]
    buckets = entries.groupBy(*key).agg(F.count_if("first").alias("homes"), F.count(F.lit(1)).alias("lookers"))
    buckets = buckets.where("homes > 0 and lookers > 1")
    met = stored(entries.join(buckets, key), "buckets")
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    part = lambda n: F.pmod(F.xxhash64("node"), blocks(n)).cast("int")
    across = lambda n: F.explode(F.sequence(F.lit(0), blocks(n) - 1))
    looking = met.select(*key, "node", F.lit(False).alias("home"), part(F.col("lookers")).alias("x"), across(F.col("homes")).alias("y"))
    living = met.where("first").select(*key, "node", F.lit(True).alias("home"), part(F.col("homes")).alias("y"), across(F.col("lookers")).alias("x"))
    tasks = stored(looking.unionByName(living), "blocks")
    width = max(1, -(-tasks.count() // ROWS_PER_CALL))
    called = lambda t, n: t.withColumn("call", F.pmod(F.xxhash64(*key, "x", "y"), F.lit(n)))
    sketched = called(tasks, width).join(coded.select("node", "sketch"), "node")
    shape = "width int, table int, code bigint, node bigint, home boolean, x int, y int"
    likely = stored(sketched.groupBy("call").applyInPandas(_blocks_plausible, shape), "plausible")
    width = max(1, -(-likely.count() // ROWS_PER_CALL))
    tasks = called(likely, width).join(coded.select("node", "copies", "unit", "codes"), "node")
    found = stored(tasks.groupBy("call").applyInPandas(_blocks_links, "a bigint, b bigint, n bigint"), "links")

    counts = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    labels = components(found.where("b is not null").select("a", "b"))
    named = reps.join(counts, "node", "left").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    named = named.withColumn("n_links", F.coalesce("n", F.lit(0)) + F.col("copies") - 1)
    least = named.groupBy("label").agg(F.min("id").alias("component_id"))
    done = rows.join(named.join(least, "label").select("vector", "n_links", "component_id"), "vector", "left")
    return done.select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
