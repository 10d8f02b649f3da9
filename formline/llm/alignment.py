"""How the tokens of two tokenizers match, over distinct texts.

Equal texts meet in one shuffle by their full text. Each distinct text is encoded and aligned once:
byte offsets at which tokens of both end cut it into groups, and the tokens of a group are linked. Its
id pairs count as often as the text occurs. The corpus-wide counts go back to the texts, frequent pairs as a
sorted table of bounded size, all others by a join, and the measures of a text to the ids of its documents.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.common import stored

FIRST = "byte_bpe_50k.tiktoken"
SECOND = "piece_bpe_32k.model"
#: Ids of the second tokenizer are below this; a pair is one number.
PAIR = 1 << 15
#: Characters encoded and aligned together.
CHARACTERS = 1_000_000
#: Pairs sent to all executors: 9 bytes each. The others, all rarer than these, are joined by shuffle.
FREQUENT = 1_000_000
#: Distinct texts whose measures are sent to all executors, those with the most copies; each other text
#: has fewer copies than one in so many documents.
HOT_TEXTS = 1_000
_MEASURES = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint"
_NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


class _Tokenizer:
    """Ids, and for each id its bytes and their number."""

    def __init__(self, encode, pieces: list[bytes]):
        self.encode, self.pieces = encode, pieces
        self.sizes = np.array([len(p) for p in pieces], np.int64)


@lru_cache(2)
def _first(path: str) -> _Tokenizer:
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("first", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    return _Tokenizer(lambda texts: [encoding.encode_ordinary(" " + t) for t in texts], pieces)


@lru_cache(2)
def _second(path: str) -> _Tokenizer:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        pieces.append(bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return _Tokenizer(lambda texts: model.encode(texts, num_threads=1), pieces)


def tokenizers(first: str | None = None, second: str | None = None) -> tuple[_Tokenizer, _Tokenizer]:
    """Both tokenizers; paths that aren't given are those of the installed vocabulary files."""
    import public_tokenizers

    return _first(first or public_tokenizers.path(FIRST)), _second(second or public_tokenizers.path(SECOND))


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` of each run, one after the other."""
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(int(counts.sum()))


def _wide_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one large group and how often each occurs, from the counts of its ids."""
    (x, n), (y, m) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    return (x[:, None] * PAIR + y).ravel(), (n[:, None] * m).ravel()


def align(texts: list[str], first: _Tokenizer, second: _Tokenizer) -> list[tuple]:
    """Per text ``(n_a, n_b, n_groups, n_links, groups, pairs, weights)``.

    ``groups`` is the text ``a1,a2|b1;...``. A text that either tokenizer doesn't give back byte for byte has no tokens.
    """
    nothing = (0, 0, 0, 0, "", np.empty(0, np.int32), np.empty(0, np.int64))
    out, usable, a_ids, b_ids = [nothing] * len(texts), [], [], []
    for i, (text, a, b) in enumerate(zip(texts, first.encode(texts), second.encode(texts), strict=True)):
        whole = b" " + text.encode()
        if text and b"".join([first.pieces[t] for t in a]) == whole and b"".join([second.pieces[t] for t in b]) == whole:
            usable.append(i)
            a_ids.append(a)
            b_ids.append(b)
    if not usable:
        return out
    a_count, b_count = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
    a, b = (np.concatenate([np.asarray(x, np.int64) for x in ids]) for ids in (a_ids, b_ids))
    a_end, b_end = np.cumsum(first.sizes[a]), np.cumsum(second.sizes[b])
    # Texts follow each other without gap, so every end of a text is an end common to both.
    common = np.intersect1d(a_end, b_end, assume_unique=True)
    a_cut, b_cut = np.searchsorted(a_end, common, "right"), np.searchsorted(b_end, common, "right")
    a_first, b_first = np.append(0, a_cut[:-1]), np.append(0, b_cut[:-1])
    a_size, b_size = a_cut - a_first, b_cut - b_first
    text_cut = np.searchsorted(common, a_end[np.cumsum(a_count) - 1], "right")
    text_first = np.append(0, text_cut[:-1])
    links = a_size * b_size

    # Links of the ordinary groups one by one, as (text, pair); those of large groups by their ids' counts.
    text_of = np.repeat(np.arange(len(usable)), text_cut - text_first)
    plain = links <= 4096
    of_a = _spread(a_first[plain], a_size[plain])
    width, low = np.repeat(b_size[plain], a_size[plain]), np.repeat(b_first[plain], a_size[plain])
    pair = np.repeat(a[of_a], width) * PAIR + b[_spread(low, width)]
    key, weight = np.unique((np.repeat(text_of[plain], links[plain]) << 31) | pair, return_counts=True)
    wide: dict[int, list] = {}
    for g in np.flatnonzero(~plain).tolist():
        found = _wide_pairs(a[a_first[g] : a_cut[g]], b[b_first[g] : b_cut[g]])
        wide.setdefault(int(text_of[g]), []).append(found)
    key_cut = np.searchsorted(key, (np.arange(len(usable)) + 1) << 31)
    key_first = np.append(0, key_cut[:-1])

    # ``a1,a2|b1;``: every token in its place, followed by its sign.
    token = np.empty(len(a) + len(b), object)
    a_group, b_group = (np.repeat(np.arange(len(common)), s) for s in (a_size, b_size))
    a_sign, b_sign = (np.full(len(x), ",", object) for x in (a, b))
    a_sign[a_cut - 1], b_sign[b_cut - 1] = "|", ";"
    names = _numerals()
    token[np.arange(len(a)) + b_first[a_group]] = names[a] + a_sign
    token[np.arange(len(b)) + a_cut[b_group]] = names[b] + b_sign
    token_cut = np.cumsum(a_count + b_count)

    for j, i in enumerate(usable):
        low, high = text_first[j], text_cut[j]
        pairs, weights = (key[key_first[j] : key_cut[j]] & ((1 << 31) - 1)), weight[key_first[j] : key_cut[j]]
        if j in wide:
            pairs = np.concatenate([pairs, *[p for p, _ in wide[j]]])
            weights = np.concatenate([weights, *[w for _, w in wide[j]]])
            pairs, at = np.unique(pairs, return_inverse=True)
            total = np.zeros(len(pairs), np.int64)
            np.add.at(total, at, weights)
            weights = total
        signs = "".join(token[token_cut[j] - a_count[j] - b_count[j] : token_cut[j]].tolist())
        out[i] = (
            int(a_count[j]), int(b_count[j]), int(high - low), int(links[low:high].sum()), signs[:-1], pairs.astype(np.int32), weights
        )
    return out


@lru_cache(1)
def _numerals() -> np.ndarray:
    return np.array([str(i) for i in range(1 << 16)], object)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *[len(v) for v in values]])
    flat = np.concatenate(values) if values else np.empty(0, np.int64)
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(flat, kind)).cast(pa.list_(kind))


def aligned_texts(texts: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """``(text_key, copies, n_a, n_b, n_groups, n_links, groups_sha256, pairs, weights)`` of ``(text_key, copies, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(first, second)
        for batch in batches:
            values, low = batch["text"].to_pylist(), 0
            while low < len(values):
                high, size = low, 0
                while high < len(values) and (high == low or size + len(values[high]) <= CHARACTERS):
                    size += len(values[high])
                    high += 1
                found = align(values[low:high], *pair)
                yield pa.RecordBatch.from_arrays(
                    [batch["text_key"].slice(low, high - low), batch["copies"].slice(low, high - low)]
                    + [pa.array([f[c] for f in found], pa.int64()) for c in range(4)]
                    + [pa.array([hashlib.sha256(f[4].encode()).hexdigest() if f[0] else "" for f in found], pa.string())]
                    + [_lists([f[5] for f in found], pa.int32()), _lists([f[6] for f in found], pa.int64())],
                    names=["text_key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "weights"],
                )
                low = high

    schema = f"text_key binary, copies bigint, {_MEASURES}, groups_sha256 string, pairs array<int>, weights array<bigint>"
    return texts.select("text_key", "copies", "text").mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, count, best)``: in how many documents a pair is linked, and whether no pair of its first id is in more."""
    pairs = aligned.select("copies", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("copies").alias("count"))
    pairs = stored(pairs, "pair-counts").withColumn("a", F.shiftright("pair", PAIR.bit_length() - 1))
    # One row per id of the first vocabulary, 50,257 at most.
    top = pairs.groupBy("a").agg(F.max("count").alias("most"))
    return pairs.join(F.broadcast(top), "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def _frequent(counts: DataFrame, size: int) -> int:
    """The least count of pairs that are in the table sent to executors: at most ``size`` pairs have it."""
    # Counts on a scale of eight steps an octave: a few hundred rows.
    step = F.floor(F.log2("count") * 8)
    steps = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("count").alias("least")).collect()
    least = None
    for row in sorted(steps, key=lambda r: -r["step"]):
        size -= row["n"]
        if size < 0:
            break
        least = row["least"]
    return least if least is not None else 1 << 62


def _measured(aligned: DataFrame, counts: DataFrame, frequent: int) -> DataFrame:
    """``(text_key, copies, ..., n_best, count_sum)`` of each text, from the counts of its pairs."""
    spark = aligned.sparkSession
    least = _frequent(counts, frequent)
    table = counts.where(F.col("count") >= least).toArrow()
    order = np.argsort(table["pair"].to_numpy())
    known = spark.sparkContext.broadcast(
        (table["pair"].to_numpy()[order], table["count"].to_numpy()[order], table["best"].to_numpy()[order])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, count, best = known.value
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            code = batch["pairs"].flatten().to_numpy(zero_copy_only=False)
            weight = batch["weights"].flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(rows), np.diff(batch["pairs"].offsets.to_numpy()))
            if len(pairs):
                at = np.minimum(np.searchsorted(pairs, code), len(pairs) - 1)
                hit = pairs[at] == code
            else:
                at, hit = np.zeros(len(code), np.int64), np.zeros(len(code), bool)
            n_best, count_sum = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            np.add.at(n_best, row[hit], weight[hit] * best[at[hit]])
            np.add.at(count_sum, row[hit], weight[hit] * count[at[hit]])
            rest = np.searchsorted(row[~hit], np.arange(rows + 1)).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(rest), pa.array(v[~hit], t)) for v, t in ((code, pa.int32()), (weight, pa.int64()))]
            kept = ["text_key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
            yield pa.RecordBatch.from_arrays(
                [batch[c] for c in kept] + [pa.array(n_best), pa.array(count_sum), *lists],
                names=[*kept, "n_best", "count_sum", "pairs", "weights"],
            )

    schema = (
        f"text_key binary, copies bigint, {_MEASURES}, groups_sha256 string, n_best bigint, count_sum bigint,"
        " pairs array<int>, weights array<bigint>"
    )
    first = stored(aligned.mapInArrow(run, schema), "measures")
    # The rare pairs: none of them is in more than ``least`` documents.
    rare = first.where(F.size("pairs") > 0).select("text_key", F.explode(F.arrays_zip("pairs", "weights")).alias("link"))
    rare = rare.select("text_key", F.col("link.pairs").alias("pair"), F.col("link.weights").alias("weight"))
    rare = rare.join(counts.where(F.col("count") < least), "pair").groupBy("text_key").agg(
        F.sum(F.when(F.col("best"), F.col("weight")).otherwise(0)).alias("rare_best"),
        F.sum(F.col("weight") * F.col("count")).alias("rare_sum"),
    )
    return first.drop("pairs", "weights").join(rare, "text_key", "left").select(
        "text_key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256",
        (F.col("n_best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", F.lit(0))).alias("count_sum"),
    )


def align_documents(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", first: str | None = None, second: str | None = None,
    frequent: int = FREQUENT, hot_texts: int = HOT_TEXTS,
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per input row.

    NULL and empty texts, and texts that a tokenizer changes, have no tokens: zeros and an empty
    ``groups_sha256``. Every row counts as a document, also those that share an id or have none, and is
    returned as often as it occurs. Other columns aren't read. An empty table gives an empty result.
    """
    plain = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    filled = plain.where("text is not null and text <> ''")
    key = F.unhex(F.sha2("text", 256))
    distinct = filled.groupBy("text").agg(F.count(F.lit(1)).alias("copies")).withColumn("text_key", key)
    aligned = stored(aligned_texts(distinct, first, second), "aligned")
    counts = stored(pair_counts(aligned), "pairs")
    measures = stored(_measured(aligned, counts, frequent), "measured")

    hot = measures.where("copies > 1").orderBy(F.desc("copies"), "text_key").limit(hot_texts)
    hot = stored(hot, "hot").drop("copies").withColumnRenamed("text_key", "hot_key")
    keyed = plain.select("doc_id", F.when(F.col("text") != "", key).alias("text_key"))
    marked = keyed.join(F.broadcast(hot), F.col("text_key") == F.col("hot_key"), "left")
    zeros = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in _NUMBERS]
    wanted = ["doc_id", *zeros, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")]
    near = marked.where("hot_key is not null or text_key is null").select(wanted)
    far = marked.where("hot_key is null and text_key is not null").select("doc_id", "text_key")
    return near.unionAll(far.join(measures.drop("copies"), "text_key", "left").select(wanted))
