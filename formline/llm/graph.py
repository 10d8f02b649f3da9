"""Connected components of a link table by repeated joins; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formline.llm.common import stored

#: Each round at least halves the depth of the remaining trees; links of any real table end far earlier.
MAX_ROUNDS = 60


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """Point each node's neighbours at the least of them: those above the node, or the node and those below it."""
    if larger:
        seen = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        seen = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = seen.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    if larger:
        moved = seen.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = seen.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        moved = moved.unionAll(least.select("a", F.col("least").alias("b")))
    return moved.where("a <> b").distinct()


def components(links: DataFrame, among: list[str] | None = None) -> DataFrame:
    """``(node, label)`` for every node of ``links(a, b)``: the label is the least node reachable.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until the links no longer
    change; every round is stored, so the plan stays short. Links with a NULL end are left out,
    loops only name their node. An empty table gives an empty result. Nodes can be of any ordered type.
    ``among`` collects the folders of the rounds; they can be discarded once the result is stored.
    """
    named = links.where("a is not null and b is not null")
    nodes = named.select(F.explode(F.array("a", "b")).alias("node"))
    now = stored(named.where("a <> b").select("a", "b").distinct(), "links", among)
    before = None
    for _ in range(MAX_ROUNDS):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = stored(_stars(_stars(now, True), False), "links", among)
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    # Settled links are stars: every node but the least points at the least.
    return nodes.distinct().join(now.select(F.col("a").alias("node"), F.col("b").alias("label")), "node", "left").select(
        "node", F.coalesce("label", "node").alias("label")
    )
