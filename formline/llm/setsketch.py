"""Near-duplicate documents by SetSketch registers.

A sketch holds, per register, the smallest of the exponential variables that the shingles of a
document draw, kept only as a level on an exponential scale (Ertl, SetSketch, 2021). Registers of a
union are the larger levels of both, and equal levels get likelier with the Jaccard similarity, so
runs of registers serve as buckets. For documents that share a bucket the similarity is estimated
by maximum likelihood from how many registers are above, below and equal; the plausible
pairs are then compared on their full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from formline.llm.common import discard, only, stored
from formline.llm.graph import components

WORDS = 5
#: 40 bands of six registers. Two sets of similarity 0.75 and equal size share a register with probability
#: 0.749 and so a band with 0.9996; unrelated ones share a register with 0.011 and a band with 8e-11, so that
#: chance meetings stay rare against real ones in tables of billions of texts.
REGISTERS = 240
BAND = 6
BASE = 1.05
RATE = 20.0
TOP_LEVEL = 1022
#: Links need 100 * intersection >= 75 * union.
PERCENT = 75
#: Pairs whose estimated similarity is lower aren't compared: five standard errors below the limit.
PLAUSIBLE = 0.6
#: Members of a bucket that meet in one task are split into blocks of about this many.
BLOCK = 512
#: Small buckets are handed to Python together, about this many rows at a time.
ROWS_PER_CALL = 2000

_draw = np.random.default_rng(20210)
_FLIP = _draw.integers(0, 2**63, REGISTERS, dtype=np.uint64)
_SPREAD = _draw.integers(0, 2**63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _draw.integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_GRID = np.linspace(0.0, 1.0, 81)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None) -> tuple[np.ndarray, bytes]:
    """Sorted distinct hashes of the five-word shingles of a text, and a key of its word sequence."""
    words = text.encode().lower().split() if text else []  # bytes: A-Z and ASCII white space alone
    key = xxhash.xxh3_128_digest(b" ".join(words))
    if not words:
        return np.empty(0, np.uint64), key
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)], np.uint64), key
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    total = np.zeros(n, np.uint64)
    for i in range(WORDS):
        total += h[i : i + n] * _PLACE[i]
    return np.unique(_mixed(total)), key


def registers(hashes: np.ndarray) -> np.ndarray:
    """Levels of the smallest exponential draw per register, 0 for an empty set."""
    if not len(hashes):
        return np.zeros(REGISTERS, np.int16)
    least = np.full(REGISTERS, np.iinfo(np.uint64).max)
    for i in range(0, len(hashes), 1024):
        part = (hashes[i : i + 1024, None] ^ _FLIP) * _SPREAD
        np.minimum(least, part.min(axis=0), out=least)
    draws = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(np.maximum(draws, 1e-300)) / np.log(BASE)), 0, TOP_LEVEL).astype(np.int16)


def _chance(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def similarity(above: np.ndarray, below: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs of sketches.

    ``above`` and ``below`` count the registers where the left one is larger and smaller; ``left``
    and ``right`` are the set sizes. The likelihood is that of three outcomes per register.
    """
    above, below, left, right = (np.asarray(x, float)[:, None] for x in (above, below, left, right))
    u, v = left / (left + right), right / (left + right)
    p, q = _chance(u - v * _GRID), _chance(v - u * _GRID)
    equal = np.maximum(1 - p - q, 1e-12)
    score = above * np.log(np.maximum(p, 1e-12)) + below * np.log(np.maximum(q, 1e-12))
    score += (REGISTERS - above - below) * np.log(equal)
    score[_GRID > np.minimum(u / v, v / u) + 1e-9] = -np.inf
    return _GRID[score.argmax(axis=1)]


def buckets(levels: np.ndarray) -> np.ndarray:
    """The bucket of each band of rows of registers: six levels of ten bits in one number."""
    places = np.int64(1) << (10 * np.arange(BAND, dtype=np.int64))
    return (levels.reshape(len(levels), -1, BAND) * places).sum(2)


def banded(sketch: DataFrame) -> DataFrame:
    """``(key, band, bucket)`` for every band; the bucket is a hash of the band's bytes."""
    rows = sketch.select("key", "registers", F.explode(F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1))).alias("band"))
    part = F.substring(F.col("registers"), F.col("band") * (2 * BAND) + 1, F.lit(2 * BAND))
    return rows.select("key", "band", F.xxhash64(part).alias("bucket"))


def _plausible(x: np.ndarray, y: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Of aligned rows of sketches: the pairs whose sizes and estimate leave a link possible."""
    fit = 100 * np.minimum(left, right) >= PERCENT * np.maximum(left, right)
    at = np.flatnonzero(fit)
    for i in range(0, len(at), 4096):
        part = at[i : i + 4096]
        above, below = (x[part] > y[part]).sum(1), (x[part] < y[part]).sum(1)
        fit[part] = similarity(above, below, left[part], right[part]) >= PLAUSIBLE
    return fit


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    if len(x) > len(y):
        x, y = y, x
    at = np.searchsorted(y, x)
    shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return 100 * shared >= PERCENT * (len(x) + len(y) - shared)


def sketches(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, key of its words, number of shingles, registers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, sizes, levels = [], [], []
            for value in batch["text"]:
                hashes, key = shingles(value)
                keys.append(key)
                sizes.append(len(hashes))
                levels.append(registers(hashes))
            yield pd.DataFrame({"id": batch["id"], "key": keys, "n_shingles": sizes, "registers": [r.tobytes() for r in levels]})

    schema = "id bigint, key binary, n_shingles bigint, registers binary"
    return docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text")).mapInPandas(run, schema)


def shingle_sets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(key, hashes)`` of each document, the hashes sorted."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            done = [shingles(value) for value in batch["text"]]
            yield pd.DataFrame({"key": [k for _, k in done], "hashes": [h.view(np.int64) for h, _ in done]})

    return docs.select(F.col(text).alias("text")).mapInPandas(run, "key binary, hashes array<bigint>")


@F.pandas_udf(BooleanType())
def _may_link(x: pd.Series, y: pd.Series, left: pd.Series, right: pd.Series) -> pd.Series:
    levels = [np.frombuffer(b"".join(s), np.int16).reshape(-1, REGISTERS) for s in (x, y)]
    return pd.Series(_plausible(*levels, left.to_numpy(), right.to_numpy()))


def _hub_links(shared: DataFrame, sketch: DataFrame, sets: DataFrame, among: list[str]) -> DataFrame:
    """Links of each bucket's members with the bucket's first member, confirmed on the full sets."""
    pairs = shared.where("hub <> key").select(F.col("hub").alias("a"), F.col("key").alias("b")).distinct()
    for side in "ab":
        pairs = pairs.join(
            sketch.select(F.col("key").alias(side), F.col("registers").alias(f"r{side}"), F.col("n_shingles").alias(f"n{side}")), side
        )
    pairs = stored(pairs.where(_may_link("ra", "rb", "na", "nb")).select("a", "b", "na", "nb"), "pairs", among)
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("key").alias(side), F.col("hashes").alias(f"h{side}")), side)
    both = F.size(F.array_intersect("ha", "hb"))
    return pairs.where(100 * both >= PERCENT * (F.col("na") + F.col("nb") - both)).select("a", "b")


def _block_links(rows: dict[str, np.ndarray], at: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
    """Links between the components of two blocks of a bucket: enough of them to join what belongs together.

    A pair counts only in the first band whose bucket it shares, and only while its ends are not
    joined yet, so the output is smaller than the block and every further link would be between
    nodes that are joined already.
    """
    levels = rows["registers"][at]
    bands, band, n = buckets(levels), int(rows["band"][at[0]]), rows["n_shingles"][at]
    label, code, parent = rows["label"][at], rows["code"][at], {}
    hashes = rows["hashes"][at]

    def root(x: bytes) -> bytes:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    right = np.flatnonzero(rows["right"][at])
    within = bool(rows["within"][at[0]])
    for i in np.flatnonzero(rows["left"][at]):
        others = right[right > i] if within else right
        others = others[code[others] != code[i]]
        others = others[~(bands[others, :band] == bands[i, :band]).any(axis=1)]
        if not len(others):
            continue
        same = np.full(len(others), i)
        for j in others[_plausible(levels[same], levels[others], n[same], n[others])]:
            a, b = root(label[i]), root(label[j])
            if a != b and _linked(hashes[i].view(np.uint64), hashes[j].view(np.uint64)):
                parent[max(a, b)] = min(a, b)
                yield label[i], label[j]


def _blocks_links(group: pd.DataFrame) -> pd.DataFrame:
    """The links of several pairs of blocks, one pair after the other."""
    rows = {c: group[c].to_numpy() for c in group.columns}
    rows["registers"] = np.frombuffer(b"".join(rows["registers"]), np.int16).reshape(-1, REGISTERS)
    rows["code"] = pd.factorize(group["label"])[0]
    pairs = group.groupby(["band", "bucket", "x", "y"], sort=False).indices.values()
    return pd.DataFrame([link for at in pairs for link in _block_links(rows, at)], columns=["a", "b"])


def _rest_links(shared: DataFrame, sets: DataFrame, labels: DataFrame, among: list[str]) -> DataFrame:
    """Links between components that meet in a bucket, for members that the bucket's first one doesn't cover.

    The first member has met all others already. The members of the bucket's most frequent component form one side, all others the other; both
    are cut into blocks and only pairs of blocks with an other side meet.
    """
    at = ["band", "bucket"]
    members = shared.where("hub <> key").select(*at, "key").join(labels.select(F.col("node").alias("key"), "label"), "key", "left")
    members = stored(members.withColumn("label", F.coalesce("label", "key")), "members", among)
    sizes = members.groupBy(*at, "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy(*at).agg(
        F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("labels")
    ).where("labels > 1")
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / F.lit(BLOCK))).cast("int")
    mixed = mixed.select(
        *at, F.col("main.label").alias("main"), blocks(F.col("main.n")).alias("main_blocks"),
        blocks(F.col("n") - F.col("main.n")).alias("rest_blocks"),
    )
    rows = members.join(mixed, at).withColumn("is_main", F.col("label") == F.col("main"))
    own = F.pmod(F.xxhash64("key"), F.when(F.col("is_main"), F.col("main_blocks")).otherwise(F.col("rest_blocks"))).cast("int")
    rows = rows.withColumn("own", own)
    # Tasks: (x, y) with x a rest block and y either a main block, numbered -1 - k, or a rest block >= x.
    each = F.sequence(F.lit(0), F.col("rest_blocks") - 1)
    mine = F.when(F.col("is_main"), F.transform(each, lambda x: F.struct(x.alias("x"), (-1 - F.col("own")).alias("y")))).otherwise(
        F.concat(
            F.transform(F.sequence(F.lit(0), F.col("main_blocks") - 1), lambda y: F.struct(F.col("own").alias("x"), (-1 - y).alias("y"))),
            F.transform(each, lambda x: F.struct(F.least(x, "own").alias("x"), F.greatest(x, "own").alias("y"))),
        )
    )
    tasks = rows.withColumn("task", F.explode(mine)).select(*at, "key", "label", "is_main", "own", "task.x", "task.y")
    tasks = tasks.withColumns({
        "within": F.col("x") == F.col("y"),
        "left": ~F.col("is_main") & (F.col("own") == F.col("x")),
        "right": F.col("is_main") | (F.col("own") == F.col("y")),
    }).drop("is_main", "own")
    tasks = stored(tasks, "blocks", among)
    width = max(1, -(-tasks.count() // ROWS_PER_CALL))
    tasks = tasks.withColumn("call", F.pmod(F.xxhash64(*at, "x", "y"), F.lit(width)))
    tasks = tasks.join(sets, "key")
    return tasks.groupBy("call").applyInPandas(_blocks_links, "a binary, b binary").distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per input row.

    Equal word sequences are one node from the start. Every bucket first links its members to one
    of them; only where a bucket still holds several components are its other pairs looked at.

    Texts that are NULL or without words have no shingles and link with nothing. Rows with a NULL id
    link with nothing and are kept, with a NULL component. Rows that share an id are one document
    for linking; a repeated row is returned as often as it occurs. Other columns aren't read.
    """
    plain = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    done_with: list[str] = []
    rows = stored(sketches(plain, "id", "text"), "sketches")
    ids, filled = rows.select("id", "key", "n_shingles"), rows.where("id is not null and n_shingles > 0")
    sketch = stored(filled.groupBy("key").agg(*[F.first(c).alias(c) for c in ("n_shingles", "registers")]), "distinct", done_with)
    entries = banded(sketch)
    hubs = entries.groupBy("band", "bucket").agg(F.min("key").alias("hub"), F.max("key").alias("last")).where("hub <> last")
    shared = stored(entries.join(hubs.drop("last"), ["band", "bucket"]), "buckets", done_with)

    wanted = shared.select("key").distinct()
    of_ids = only(filled.select("id", "key"), wanted, "key").groupBy("key").agg(F.min("id").alias("id"))
    first_ids = of_ids.select("id").distinct()
    sets = shingle_sets(only(plain, first_ids, "id")).dropDuplicates(["key"])
    sets = stored(sets.join(sketch.join(wanted, "key", "left_semi"), "key"), "sets", done_with)

    first = stored(_hub_links(shared, sketch, sets, done_with), "hub-links", done_with)
    labels = stored(components(first, done_with), "labels", done_with)
    rest = stored(_rest_links(shared, sets, labels, done_with), "rest-links", done_with)
    # Rows that share an id but not a text are one document.
    by_id = filled.select("id", "key").distinct().groupBy("id").agg(F.min("key").alias("a"), F.max("key").alias("z"), F.count(F.lit(1)).alias("n"))
    several = filled.select("id", F.col("key").alias("b")).join(by_id.where("n > 1"), "id").select("a", "b")
    links = first.unionAll(rest).unionAll(several)
    # `rest` links components by their labels, which are nodes themselves.
    labels = stored(components(links, done_with), "components")
    discard(docs.sparkSession, done_with)

    named = filled.groupBy("key").agg(F.min("id").alias("id"))
    named = named.join(labels.select(F.col("node").alias("key"), "label"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    least = named.groupBy("label").agg(F.min("id").alias("component_id"))
    of_key = named.join(least, "label").select("key", "component_id")
    usable = F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("key"))
    done = ids.withColumn("key", usable).join(of_key, "key", "left")
    return done.select(
        F.col("id").alias("doc_id"), "n_shingles", F.coalesce("component_id", "id").alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
