"""Best-fit packing of tokenized documents into fixed-length sequences, planned on the length histogram."""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formline.llm.common import stored

SEQUENCE = 1024
END_ID = 2
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The vocabulary's special token.
SPECIAL = {"<|endoftext|>": 50256}


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


@lru_cache(2)
def _encoder(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)


def token_pieces(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", path: str | None = None, length: int = SEQUENCE, with_ids: bool = False
) -> DataFrame:
    """``(row, doc_id, piece, start, length, ids_crc32[, ids])``: each document's ids and the end id, cut where too long.

    A document of more than ``length`` ids is cut so that all pieces but the first are full.
    A NULL text counts as empty, and so gives the end id alone. ``row`` tells rows with the same id apart.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(path or vocabulary_path())
        for batch in batches:
            out = defaultdict(list)
            for row, doc_id, value in zip(batch["row"], batch["doc_id"], batch["text"], strict=True):
                ids = np.append(encoder.encode_to_numpy(value or "", allowed_special="all"), END_ID).astype("<u4")
                first = len(ids) if len(ids) <= length else (len(ids) % length or length)
                start = 0
                for piece, end in enumerate([first, *range(first + length, len(ids) + 1, length)]):
                    part = ids[start:end]
                    out["row"].append(row)
                    out["doc_id"].append(doc_id)
                    out["piece"].append(piece)
                    out["start"].append(start)
                    out["length"].append(end - start)
                    out["ids_crc32"].append(zlib.crc32(part.tobytes()))
                    if with_ids:
                        out["ids"].append(part.astype(np.int32))
                    start = end
            if out:
                yield pd.DataFrame(out).astype({"doc_id": "Int64"})

    schema = "row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return numbered.mapInPandas(run, schema)


def plan(histogram: dict[int, int], length: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows ``(length, first rank, count, first sequence, offset)``.

    Pieces of one length with ranks from ``first rank`` on take consecutive sequences from ``first
    sequence`` on, each at ``offset``. Sequences that are filled alike are held as one run, so the
    work depends on the number of lengths and not on the number of pieces.
    """
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free room -> runs (first sequence, count)
    rooms: list[int] = []  # the free rooms that occur, ascending
    slots, opened = [], 0

    def add(room: int, first: int, count: int) -> None:
        if room:
            if not runs[room]:
                insort(rooms, room)
            runs[room].append((first, count))

    for size in sorted(histogram, reverse=True):
        rank, left = 0, histogram[size]
        while left:
            at = bisect_left(rooms, size)
            if at == len(rooms):
                # No open sequence has room: as many new ones as these pieces fill.
                count = -(-left // (length // size))
                add(length, opened, count)
                opened += count
                continue
            room = rooms[at]
            first, count = runs[room].pop()
            if not runs[room]:
                rooms.pop(at)
            used = min(left, count)
            if used < count:
                add(room, first + used, count - used)
            slots.append((size, rank, used, first, length - room))
            add(room - size, first, used)
            rank, left = rank + used, left - used
    return slots


def pack(pieces: DataFrame, length: int = SEQUENCE, buckets: int | None = None) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; other columns stay.

    The histogram has at most ``length`` rows and is all that the driver sees. A piece's rank among
    those of its length is its rank in a bucket by hash plus the sizes of the buckets before, so a
    length that a third of all pieces have is spread over all buckets. A slot of the plan covers a
    range of ranks; every bucket gets the slots of its own range, cut to it, and ranks find their
    slot by position.
    """
    spark = pieces.sparkSession
    buckets = buckets or max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = pieces.withColumn("_bucket", F.pmod(F.xxhash64("row", "piece"), F.lit(buckets)))
    sizes = rows.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("n"))
    # At most length * buckets rows.
    before = F.sum("n").over(W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1))
    sizes = sizes.withColumn("_before", F.coalesce(before, F.lit(0)))
    sizes = stored(sizes, "piece-counts")
    histogram = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = plan(histogram, length)
    names = "length bigint, first_rank bigint, count bigint, first_sequence bigint, at bigint"
    slot = spark.createDataFrame(pd.DataFrame(slots, columns=[x.split()[0] for x in names.split(", ")]), names) if slots else spark.createDataFrame([], names)
    # The slots of each bucket in order, as ranks in the bucket: most buckets meet few slots.
    met = sizes.join(slot, "length").where("first_rank < _before + n and first_rank + count > _before")
    met = met.groupBy("length", "_bucket").agg(
        F.any_value("_before").alias("_before"), F.sort_array(F.collect_list(F.struct("first_rank", "count", "first_sequence", "at"))).alias("_slots")
    )
    rank = F.row_number().over(W.partitionBy("length", "_bucket").orderBy("row", "piece")) - 1
    ranked = rows.withColumn("_rank", rank).join(met, ["length", "_bucket"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    hit = F.filter("_slots", lambda s: (s.first_rank <= F.col("_rank")) & (F.col("_rank") < s.first_rank + s["count"]))
    return ranked.withColumn("_slot", F.get(hit, F.lit(0))).select(
        *pieces.columns, (F.col("_slot.first_sequence") + F.col("_rank") - F.col("_slot.first_rank")).alias("sequence_id"),
        F.col("_slot.at").alias("offset"),
    )


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Pieces of all documents with their place: ``token_pieces`` (same options), then ``pack``.

    Tokens are counted once and stored. Empty tables give an empty result; rows with a NULL or a
    repeated id are packed like any other; columns other than id and text aren't read.
    """
    length = options.get("length", SEQUENCE)
    return pack(stored(token_pieces(docs, **options), "pieces"), length).drop("row")
