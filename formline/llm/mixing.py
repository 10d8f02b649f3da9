"""Mixing sources to target weights: blocks of words drawn by seeded index permutations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formline.llm.common import stored

#: Words of a block, slots of an output shard.
BLOCK = 64
SHARD = 4096
WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
SEED = 17
ROUNDS = 4
#: Parts of a running sum. The order of documents in their source depends on it, so it is fixed.
BUCKETS = 1024

WORD = "[^\\x20\\x09-\\x0D]+"
_SOURCE = "source"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``(source, source_size, target)``: shares of the mix by weight, none above ``repeats`` times its size.

    Sources by code point, NULL last, take the weights in turn. Shares above the bound are cut to
    it and the excess goes to the others by weight until none is above. With x = bound / weight
    a source is cut exactly if x is at most the common level that the rest then get, so one pass over the sources
    in the order of x finds the level: no repeated reshare. The sources are a table of their
    own; it is as long as there are sources.
    """
    order = W.orderBy(F.col(_SOURCE).isNull(), F.col(_SOURCE))
    given = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("weight", F.get(given, (F.row_number().over(order) - 1) % len(weights)))
    rows = rows.withColumn("bound", F.lit(float(repeats)) * F.col("source_size"))
    rows = rows.withColumn("ratio", F.col("bound") / F.col("weight"))
    everything = W.partitionBy(F.lit(0))
    upto = everything.orderBy("ratio", F.col(_SOURCE).isNull(), _SOURCE).rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything) * F.lit(share)
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0))
    level = (total - F.coalesce(F.sum("bound").over(upto), F.lit(0.0))) / rest
    rows = rows.withColumn("level", level).withColumn("open", F.col("ratio") > F.col("level"))
    # The first source that isn't cut fixes the level of all others.
    fixed = F.min(F.when(F.col("open"), F.struct("ratio", "level"))).over(everything)["level"]
    target = F.least("bound", F.coalesce(F.col("weight") * fixed, F.col("bound")))
    return rows.withColumn("target", target).select(_SOURCE, "source_size", "target")


def _placed(rows: DataFrame, key: list[str], order: list[str], size: str, last: str | None = None) -> DataFrame:
    """``rows`` with ``start``: the sum of ``size`` before the row within ``key``.

    Sums run within hash buckets and over the bucket totals, so that a key with a third of all
    rows is spread over all buckets. ``last`` only orders rows equal in ``order``: rows as good as each other.
    """
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(BUCKETS)))
    upto = lambda w: w.rowsBetween(W.unboundedPreceding, -1)
    own = F.sum(size).over(upto(W.partitionBy(*key, "_bucket").orderBy(*order, *[last] * bool(last))))
    parts = rows.groupBy(*key, "_bucket").agg(F.sum(size).alias("_sum"))
    past = parts.select(*key, "_bucket", F.coalesce(F.sum("_sum").over(upto(W.partitionBy(*key).orderBy("_bucket"))), F.lit(0)).alias("_past"))
    rows = rows.withColumn("start", F.coalesce(own, F.lit(0)))
    same = [rows[k].eqNullSafe(past[k]) for k in [*key, "_bucket"]]
    joined = rows.join(past, same).drop(*[past[k] for k in [*key, "_bucket"]])
    return joined.withColumn("start", F.col("start") + F.col("_past")).drop("_bucket", "_past")


def _step(index: Column, side: Column, salt: Column) -> Column:
    """One pass of a four-round Feistel network on pairs of numbers below ``side``."""
    pair = F.struct((index / side).cast("bigint").alias("l"), (index % side).alias("r"))
    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    turn = lambda p, k: F.struct(p.r.alias("l"), ((p.l + F.pmod(F.xxhash64(p.r, k, salt), side)) % side).alias("r"))
    return F.aggregate(rounds, pair, turn, lambda p: p.l * side + p.r)


def permuted(index: Column, n: Column, salt: Column) -> Column:
    """The place of ``index`` in a pseudorandom permutation of 0 .. n - 1 that ``salt`` names.

    The network permutes the square that holds n; a number that leaves the range goes through it
    again (cycle walking). Fewer than 2 * sqrt(n) + 1 numbers lie outside, so that many passes bring any one back.
    """
    side = F.ceil(F.sqrt(n.cast("double"))).cast("bigint")
    side = side + F.when(side * side < n, F.lit(1)).otherwise(F.lit(0))
    walk = F.sequence(F.lit(1).cast("bigint"), side * side - n + 1)
    near = F.aggregate(F.sequence(F.lit(1), F.lit(3)), _step(index, side, salt), lambda x, _: F.when(x < n, x).otherwise(_step(x, side, salt)))
    far = F.aggregate(walk, near, lambda x, _: F.when(x < n, x).otherwise(_step(x, side, salt)))
    return F.when(near < n, near).otherwise(far)


def slots(sources: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """``(shard, slot, source_no, draw, block)``: the drawn block of every slot of every output shard.

    Each shard draws its source of every slot from the target weights, i.e. multinomial counts.
    Draws of one source are numbered through the shards. Independent draws miss the targets by
    their standard deviation, so the few draws beyond a source's number of blocks are given to
    the sources that came short, in order. ``sources`` has ``source_no, blocks, draws``.
    """
    spark = sources.sparkSession
    everything = W.partitionBy(F.lit(0)).orderBy("source_no")
    cumulated = sources.withColumn("high", F.sum("draws").over(everything)).withColumn("low", F.col("high") - F.col("draws"))
    cumulated = stored(cumulated, "sources")
    total = cumulated.agg(F.coalesce(F.max("high"), F.lit(0))).first()[0]
    width = max(1, min(10_000, -(-total // 250_000)))
    base = spark.range(0, total, 1, max(width, 8)).select(
        F.floor(F.col("id") / shard).alias("shard"), (F.col("id") % shard).cast("int").alias("slot"),
        F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(total, 1))).alias("ticket"),
    )
    # Sources are found by interval: tickets and intervals meet on the interval's cell.
    cells = max(1, total // 256)
    size = -(-max(total, 1) // cells)
    spread = cumulated.where("draws > 0").withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / size), F.floor((F.col("high") - 1) / size))))
    drawn = base.withColumn("cell", F.floor(F.col("ticket") / size)).join(spread, "cell").where("ticket >= low and ticket < high")
    drawn = drawn.select("shard", "slot", "source_no", "blocks", "draws")
    # The number of a draw: its rank in the shard after the counts of the shards before.
    counts = drawn.groupBy("source_no", "shard").agg(F.count(F.lit(1)).alias("n"))
    counts = _placed(counts, ["source_no"], ["shard"], "n")
    rank = F.row_number().over(W.partitionBy("source_no", "shard").orderBy("slot")) - 1
    drawn = drawn.withColumn("rank", rank).join(counts.select("source_no", "shard", "start"), ["source_no", "shard"])
    drawn = stored(drawn.withColumn("draw", F.col("start") + F.col("rank")).drop("start", "rank"), "drawn")

    made = drawn.groupBy("source_no").agg(F.count(F.lit(1)).alias("made"))
    balance = cumulated.join(made, "source_no", "left").withColumn("made", F.coalesce("made", F.lit(0)))
    balance = balance.withColumn("over", F.greatest(F.col("made") - F.col("draws"), F.lit(0)))
    balance = balance.withColumn("short", F.greatest(F.col("draws") - F.col("made"), F.lit(0)))
    for name in ("over", "short"):
        balance = balance.withColumn(f"{name}_from", F.sum(name).over(everything) - F.col(name))
    balance = stored(balance, "balance")
    spare = drawn.where("draw >= draws").join(balance.select("source_no", "over_from"), "source_no")
    spare = spare.select("shard", "slot", (F.col("over_from") + F.col("draw") - F.col("draws")).alias("ticket"))
    short = balance.where("short > 0").select(
        "source_no", "blocks", "draws", F.posexplode(F.sequence(F.col("made"), F.col("draws") - 1)).alias("i", "draw"), "short_from"
    ).select("source_no", "blocks", "draws", "draw", (F.col("short_from") + F.col("i")).alias("ticket"))
    given = spare.join(short, "ticket").select(drawn.columns)
    full = drawn.where("draw < draws").unionByName(given)
    # Every pass over a source has a permutation of its own.
    turn = F.floor(F.col("draw") / F.col("blocks"))
    salt = F.xxhash64(F.lit(seed), "source_no", turn)
    return full.withColumn("block", permuted(F.col("draw") % F.col("blocks"), F.col("blocks"), salt))


def mix(docs: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text", block: int = BLOCK, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The documents' places and the drawn blocks.

    Documents: ``row, doc_id, source, size, source_no, source_size, target, start`` with ``start`` the words of
    its source before it. Draws: ``source_no, block, pass, low, high``, the words [low, high) of the
    source that each draw takes; a source's last draw is cut so that it takes its target to the word.

    A NULL text has no words and NULL is a source of its own. Rows with NULL or repeated ids count like any
    other. Sources without words take nothing. An empty table gives empty results.
    """
    plain = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(source).alias(_SOURCE), word_count(text).alias("size"), F.xxhash64(text).alias("hash"))
    rows = stored(plain, "sizes")
    wanted = targets(rows.groupBy(_SOURCE).agg(F.sum("size").alias("source_size")))
    number = F.row_number().over(W.orderBy(F.col(_SOURCE).isNull(), _SOURCE))
    wanted = wanted.withColumn("source_no", number).withColumn("blocks", F.ceil(F.col("source_size") / block))
    words = F.round("target").cast("bigint")
    # Draws until the target is covered even if the short last block is among them.
    full = F.floor(words / F.greatest("source_size", F.lit(1)))
    part = words - full * F.col("source_size")
    draws = full * F.col("blocks") + F.when(part > 0, F.least("blocks", F.ceil(part / block) + 1)).otherwise(F.lit(0))
    wanted = stored(wanted.withColumns({"words": words, "draws": draws}), "targets")
    taken = slots(wanted.select("source_no", "blocks", "draws"), block, SHARD, seed)
    sizes = wanted.select("source_no", "source_size", "words")
    taken = taken.join(sizes, "source_no").withColumn("low", F.col("block") * block).withColumn("high", F.least("source_size", F.col("low") + block))
    taken = taken.withColumn("pass", F.floor(F.col("draw") / F.col("blocks")))
    taken = stored(taken.select("source_no", "shard", "slot", "draw", "pass", "block", "low", "high", "words"), "draws")
    # What is beyond the target is less than three blocks: it comes off the last draws.
    sums = taken.groupBy("source_no").agg((F.sum(F.col("high") - F.col("low")) - F.first("words")).alias("beyond"), F.max("draw").alias("last"))
    tail = taken.join(sums, "source_no").where("draw > last - 4").withColumn("n", F.col("high") - F.col("low"))
    after = F.coalesce(F.sum("n").over(W.partitionBy("source_no").orderBy(F.desc("draw")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    cut = tail.withColumn("cut", F.least("n", F.greatest(F.lit(0), F.col("beyond") - after))).select("source_no", "draw", "cut")
    taken = taken.join(cut, ["source_no", "draw"], "left").withColumn("high", F.col("high") - F.coalesce("cut", F.lit(0)))
    known = wanted.select(_SOURCE, "source_no", "source_size", "target")
    rows = rows.withColumnRenamed(_SOURCE, "_of").join(known, F.col("_of").eqNullSafe(known[_SOURCE])).drop("_of")
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    placed = _placed(rows, ["source_no"], ["doc_id", "hash"], "size", "row")
    return stored(placed, "placed"), taken.where("high > low").drop("cut", "words")


def spans(placed: DataFrame, taken: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(row, pass, low, high)``: the words [low, high) of a document that each draw takes."""
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    parts = placed.where("size > 0").select("row", "source_no", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    met = parts.join(taken.select("source_no", "block", "pass", F.col("low").alias("_low"), F.col("high").alias("_high")), ["source_no", "block"])
    low = F.greatest("_low", "start") - F.col("start")
    high = F.least("_high", F.col("start") + F.col("size")) - F.col("start")
    return met.select("row", "pass", low.alias("low"), high.alias("high")).where("high > low")


def taken_words(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row per input row; see ``mix``."""
    placed, taken = mix(docs)
    sums = spans(placed, taken).groupBy("row").agg(F.sum(F.col("high") - F.col("low")).alias("taken"))
    return placed.join(sums, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
