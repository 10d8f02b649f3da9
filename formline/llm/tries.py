"""The trie of all conversation prefixes, folded shard by shard from padded turn-id matrices.

A turn is named by the MD5 of its role and text, a conversation by the names of its turns in a row
(its path), so that conversations with a common beginning are neighbours in the order of paths.
Shards are ranges of that order. Within a shard numpy sorts the padded rows of turn ids, marks where
a row leaves the one before it at any column so far, and reduces between the marks at every depth.
Only nodes that hold a shard's first or last conversation can go on in another shard: their sums
travel as two rows a shard, and are folded again, 512 shards a group, until one group is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formline.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Conversation c begins with turns of conversation c - c % EVERY, fewer than HEADS of them.
EVERY = 20
HEADS = 4
#: Turns a shard holds at most on average; smaller tables are still dealt to this many tasks.
SHARD_TURNS = 400_000
LEAST_TURNS = 4_000
TASKS = 200
#: Shards whose boundary rows are folded together.
FAN_IN = 512
#: Columns of the padded matrix that are sorted at once, so that one long conversation doesn't widen all rows.
SLAB = 16
#: Ids that are hashed as one string where the conversations ending at a node are spread over shards.
IDS_A_CHUNK = 1_000
#: Nodes that span shards are sent to all executors up to this many (60 bytes each), and joined by shuffle beyond.
BROADCAST_NODES = 200_000
SALTS = 16
TURN_BYTES = 16
_SUMS = ("n", "least", "children", "leaves", "saved")
_NO_IDS = hashlib.sha256(b"").hexdigest()

_LONGS = pa.list_(pa.int64())
_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("shard", pa.int64()), ("side", pa.int32()), ("path", pa.binary()), ("words", _LONGS)]
    + [(f"part_{c}", _LONGS) for c in _SUMS]
    + [("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string()), ("chunk", pa.int64()), ("ids", pa.string())]
)
_DDL = (
    "kind int, shard bigint, side int, path binary, words array<bigint>, "
    + ", ".join(f"part_{c} array<bigint>" for c in _SUMS)
    + ", key binary, parent_key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint,"
    " n_leaves bigint, saved_tokens bigint, ends_sha256 string, chunk bigint, ids string"
)
_NODE, _EDGE, _ENDS = 0, 1, 2


def rebuilt(conversations: DataFrame, every: int = EVERY, heads: int = HEADS) -> DataFrame:
    """``(conv_id, path, words)``: each conversation's turns after the exchange of its first ones.

    The path is the MD5 values of its turns in a row, ``words`` their numbers of words. All turns of the
    ``every`` conversations that share a beginning meet in one exchange of names, without their texts.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        (F.col("conv_id") - F.col("conv_id") % every).cast("bigint").alias("group"),
        F.struct(
            F.col("turn"),
            F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("name"),
            F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
        ).alias("turn"),
    )
    whole = named.repartition("group").groupBy("group", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("own"))
    first = F.max(F.when(F.col("conv_id") == F.col("group"), F.slice("own", 1, heads - 1))).over(W.partitionBy("group"))
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads)).cast("int")
    whole = whole.withColumn("first", first).withColumn("taken", taken)
    borrowed = F.when(F.col("first").isNull(), F.slice("own", 1, 0)).otherwise(F.slice("first", F.lit(1), F.col("taken")))
    turns = F.concat(borrowed, F.slice("own", F.col("taken") + 1, F.greatest(F.size("own"), F.lit(1))))
    return whole.withColumn("turns", turns).select(
        "conv_id", F.unhex(F.array_join("turns.name", "")).alias("path"), F.col("turns.words").alias("words")
    )


def _names(paths: list[bytes]) -> np.ndarray:
    """The turn names of the paths one after the other, as numbers in the order of the names."""
    halves = np.frombuffer(b"".join(paths), ">u8").reshape(-1, 2)
    high, low = halves[:, 0].astype(np.uint64), halves[:, 1].astype(np.uint64)
    order = np.lexsort((low, high))
    new = np.ones(len(order), np.int64)
    new[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    numbers = np.empty(len(order), np.int64)
    numbers[order] = np.cumsum(new)  # from 1: 0 pads
    return numbers


def _sorted_rows(names: np.ndarray, start: np.ndarray, lengths: np.ndarray, conv_ids: np.ndarray) -> np.ndarray:
    """The order of paths, ties by id: slabs of padded columns are sorted stably from the last to the first."""
    order = np.argsort(conv_ids, kind="stable")
    longest = int(lengths.max(initial=0))
    for first in range((longest - 1) // SLAB * SLAB, -1, -SLAB):
        reaches = lengths[order] > first
        done, rows = order[~reaches], order[reaches]
        column = first + np.arange(SLAB)
        matrix = names[np.minimum(start[rows, None] + column, len(names) - 1)]
        matrix[column >= lengths[rows, None]] = 0
        order = np.concatenate([done, rows[np.lexsort(matrix.T[::-1])]])
    return order


class _Depth:
    """The nodes of one depth: their rows' sums, in the order of paths."""

    def __init__(self, rows: np.ndarray, first: np.ndarray, parent: np.ndarray, sums: list[np.ndarray], words: np.ndarray, ends: np.ndarray):
        self.row, self.parent, self.words = rows[first], parent[first], words
        self.n, self.children, self.leaves, self.saved = (np.add.reduceat(sums[i], first) for i in (0, 2, 3, 4))
        self.least = np.minimum.reduceat(sums[1], first)
        self.ends = ends  # (rows that end here, their node)
        self.open = np.zeros(len(first), bool)


def _depths(names, start, lengths, words, parts) -> list[_Depth]:
    """All nodes of rows in order. ``parts`` holds a value for every depth of a row, the root's first."""
    place = start + np.arange(len(start))
    rows, label, new, depth, out = np.arange(len(lengths)), np.zeros(len(lengths), np.int64), None, 0, []
    while len(rows):
        if new is None:
            new = np.zeros(len(rows), bool)
        else:
            # A row that leaves its neighbour at an earlier column has another parent: the marks add up.
            value = names[start[rows] + depth - 1]
            new = np.ones(len(rows), bool)
            new[1:] = (label[1:] != label[:-1]) | (value[1:] != value[:-1])
        new[0] = True
        first, here = np.flatnonzero(new), np.cumsum(new) - 1
        at = place[rows] + depth
        width = words[start[rows[first]] + depth - 1] if depth else np.zeros(1, np.int64)
        done = lengths[rows] == depth
        out.append(_Depth(rows, first, label, [p[at] for p in parts], width, (rows[done], here[done])))
        rows, label, depth = rows[~done], here[~done], depth + 1
    return out


def _fold(depths: list[_Depth], rows: int, last: bool) -> None:
    """Sums from the deepest nodes up: finished nodes count in their parents, open ones keep what they have so far."""
    below = None
    for node in reversed(depths):
        if below is not None:
            shut = ~below.open
            to = below.parent[shut]
            np.add.at(node.children, to, 1)
            np.add.at(node.leaves, to, below.leaves[shut])
            np.add.at(node.saved, to, below.saved[shut])
        below = node
        if not last:
            node.open[0] |= node.holds_first
            node.open[-1] |= node.holds_last
        shut = ~node.open
        node.leaves[shut & (node.children == 0)] = 1
        node.saved[shut] += ((node.n - 1) * node.words)[shut]


def _keys(path: bytes) -> list[bytes]:
    """A name for every beginning of a path, the empty one first."""
    state = hashlib.blake2b(digest_size=16)
    out = [state.digest()]
    for i in range(0, len(path), TURN_BYTES):
        state.update(path[i : i + TURN_BYTES])
        out.append(state.digest())
    return out


def _batch(kind: int, shard: int, columns: dict[str, list | np.ndarray]) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    columns = {"kind": [kind] * size, "shard": [shard] * size, **columns}
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _SCHEMA], schema=_SCHEMA
    )


def _fold_rows(paths, words, parts, conv_ids, shard: int, last: bool) -> Iterator[pa.RecordBatch]:
    """The finished nodes, boundary rows and unfinished ends of sorted rows. ``conv_ids`` are those of whole conversations."""
    count = len(paths)
    lengths = np.array([len(p) // TURN_BYTES for p in paths], np.int64)
    start = np.cumsum(lengths) - lengths
    names = _names(paths)
    if conv_ids is not None:
        order = _sorted_rows(names, start, lengths, conv_ids)
        paths, conv_ids, lengths = [paths[i] for i in order], conv_ids[order], lengths[order]
        start = start[order]
        size = lengths + 1
        one = np.ones(int(size.sum()), np.int64)
        parts = [one, np.repeat(conv_ids, size), one * 0, one * 0, one * 0]
        place = np.cumsum(size) - size
        # ``start`` now points into the unsorted names; sums are laid out in the order of rows.
        gather = np.repeat(start - (place - np.arange(count)), lengths) + np.arange(int(lengths.sum()))
        names, words = names[gather], words[gather]
        start = np.cumsum(lengths) - lengths
    depths = _depths(names, start, lengths, words, parts)
    for depth, node in enumerate(depths):
        node.holds_first, node.holds_last = bool(lengths[0] >= depth), bool(lengths[-1] >= depth)
    _fold(depths, count, last)

    edge_keys = {0: _keys(paths[0]), count - 1: _keys(paths[-1])}
    all_keys = None if conv_ids is not None else [_keys(p) for p in paths]
    for depth, node in enumerate(depths):
        own_ends = {}
        if conv_ids is not None:
            at, of = node.ends
            cuts = np.flatnonzero(np.diff(of)) + 1
            for group in np.split(np.arange(len(at)), cuts) if len(at) else []:
                ids, label = conv_ids[at[group]], of[group[0]]
                if not node.open[label]:
                    own_ends[label] = hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
                    continue
                key = edge_keys[0][depth] if label == 0 and node.holds_first else edge_keys[count - 1][depth]
                pieces = [",".join(map(str, ids[i : i + IDS_A_CHUNK].tolist())) for i in range(0, len(ids), IDS_A_CHUNK)]
                yield _batch(_ENDS, shard, {"key": [key] * len(pieces), "chunk": np.arange(len(pieces)), "ids": pieces})
        shut = np.flatnonzero(~node.open)
        if not len(shut):
            continue
        columns = {
            "conv_id": node.least[shut], "depth": np.full(len(shut), depth), "n_convs": node.n[shut],
            "n_children": node.children[shut], "n_leaves": node.leaves[shut], "saved_tokens": node.saved[shut],
        }
        if conv_ids is not None:
            columns["ends_sha256"] = [own_ends.get(i, _NO_IDS) for i in shut.tolist()]
        else:
            columns["key"] = [all_keys[r][depth] for r in node.row[shut].tolist()]
        if depth:
            above, up = depths[depth - 1], node.parent[shut]
            known = ~above.open[up]
            columns["parent_conv_id"] = pa.array(above.least[up], mask=~known)
            first_key, last_key = edge_keys[0], edge_keys[count - 1]
            side = [first_key if above.holds_first and p == 0 else last_key for p in up.tolist()]
            columns["parent_key"] = [None if k else s[depth - 1] for k, s in zip(known.tolist(), side, strict=True)]
        yield _batch(_NODE, shard, columns)
    if last:
        return
    # The boundary rows. A node that holds both the first and the last row travels with the first.
    for side, row in enumerate(sorted({0, count - 1})):
        sums = {c: [] for c in _SUMS}
        for depth in range(int(lengths[row]) + 1):
            node = depths[depth]
            shared = side and node.holds_first and len(node.n) == 1
            at = -1 if side else 0
            for c, none in zip(_SUMS, (0, np.iinfo(np.int64).max, 0, 0, 0), strict=True):
                sums[c].append(none if shared else int(getattr(node, c)[at]))
        of_row = words[start[row] : start[row] + lengths[row]]
        columns = {"side": [side], "path": [paths[row]], "words": [of_row.tolist()], **{f"part_{c}": [v] for c, v in sums.items()}}
        yield _batch(_EDGE, shard, columns)


def _fold_shards(whole: DataFrame, shards: int) -> DataFrame:
    """Every shard of conversations on its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [b for b in batches if b.num_rows]
        if not rows:
            return
        table = pa.Table.from_batches(rows)
        words = table["words"].combine_chunks()
        flat = words.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        yield from _fold_rows(
            table["path"].to_pylist(), flat, None, table["conv_id"].to_numpy(), table["shard"][0].as_py(), last=False
        )

    ranged = whole.repartitionByRange(shards, "path", "conv_id").withColumn("shard", F.spark_partition_id().cast("bigint"))
    return ranged.mapInArrow(run, _DDL)


def _fold_edges(edges: DataFrame, last: bool) -> DataFrame:
    """The boundary rows of ``FAN_IN`` neighbouring shards at a time."""

    def run(key, table):
        table = table.sort_by([("shard", "ascending"), ("side", "ascending")])
        parts = [table[f"part_{c}"].combine_chunks().flatten().to_numpy(zero_copy_only=False).copy() for c in _SUMS]
        words = table["words"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        out = list(_fold_rows(table["path"].to_pylist(), words, parts, None, key[0].as_py(), last))
        return pa.Table.from_batches(out, _SCHEMA)

    of = F.floor(F.col("shard") / FAN_IN).cast("bigint")
    return edges.groupBy(of.alias("up")).applyInArrow(run, _DDL)


def _hashes(ends: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` of nodes whose ending conversations lie in several shards.

    Their ids come as chunks in ascending order; a hash takes them one after the other and holds none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            for key, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                if key != now:
                    if now is not None:
                        yield pa.RecordBatch.from_pydict({"key": [now], "ends_sha256": [state.hexdigest()]})
                    now, state = key, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if now is not None:
            yield pa.RecordBatch.from_pydict({"key": [now], "ends_sha256": [state.hexdigest()]})

    dealt = ends.select("key", "shard", "chunk", "ids").repartition("key").sortWithinPartitions("key", "shard", "chunk")
    return dealt.mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, every: int = EVERY, heads: int = HEADS) -> DataFrame:
    """One row per distinct beginning of the rebuilt conversations.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.

    Turns with a NULL number come first; turns with the same number are ordered by the MD5 of role and
    text; repeated rows are turns of their own. NULL roles and texts are empty. Rows with a NULL ``conv_id``
    belong to no conversation and are left out. A table without conversations has no node, not even a
    root. Other columns aren't read. A conversation is one record: it takes 24 bytes a turn.
    """
    whole = stored(rebuilt(conversations, every, heads), "rebuilt")
    count, turns = whole.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("words")), F.lit(0))).first()
    size = count + turns
    shards = max(1, -(-size // SHARD_TURNS), min(TASKS, -(-size // LEAST_TURNS)))
    level = stored(_fold_shards(whole, shards), "shards")
    nodes, ends = level.where(F.col("kind") == _NODE), level.where(F.col("kind") == _ENDS)
    spanning = None
    while True:
        edges = level.where(F.col("kind") == _EDGE)
        last = edges.agg(F.max("shard")).first()[0] or 0
        final = last < FAN_IN
        level = stored(_fold_edges(edges, final), "edges")
        found = level.where(F.col("kind") == _NODE)
        spanning = found if spanning is None else spanning.unionAll(found)
        if final:
            break
    spanning = spanning.drop("ends_sha256").join(_hashes(ends), "key", "left")
    spanning = stored(spanning.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_IDS))), "spanning")

    given = ["conv_id", "depth", "parent_conv_id", "parent_key", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    every_node = nodes.select(given).unionAll(spanning.select(given))
    parents = spanning.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    waiting = every_node.where("parent_key is not null")
    if spanning.count() <= BROADCAST_NODES:
        waiting = waiting.join(F.broadcast(parents), "parent_key")
    else:
        salted = parents.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int")
        waiting = waiting.withColumn("salt", own).join(salted, ["parent_key", "salt"])
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    waiting = waiting.withColumn("parent_conv_id", F.col("parent"))
    return every_node.where("parent_key is null").select(columns).unionAll(waiting.select(columns))
