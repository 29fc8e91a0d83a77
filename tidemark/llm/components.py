"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.staging import stage


def connected_components(links: DataFrame) -> DataFrame:
    """Label every node that occurs in a link with the smallest id it can reach.

    ``links`` has the columns ``a`` and ``b`` (no order, repeats allowed; rows with a
    NULL end are left out). Returns ``node, component``. Each round orders all nodes by a
    hash of their own, moves every node to the first of its neighbours and itself, and
    contracts the links. Since the order is new and random in each round, a constant share
    of the nodes is expected to go, whatever the shape: chains in the order of their ids
    take a logarithmic number of rounds as well. A hub is no hot spot: its neighbours are
    combined before the shuffle, and joins split it. Every round is written to the
    checkpoint folder, so a lost executor costs one round. No links, no rows.
    """
    links = links.select(F.col("a").cast("long"), F.col("b").cast("long")).dropna()
    edges = stage(
        links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links"
    )
    alone = links.filter("a = b").select(F.col("a").alias("node")).distinct()
    moves = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(
            edges.select(F.col("b").alias("node"), F.col("a").alias("near"))
        )
        turn = len(moves)
        first = F.min(F.struct(F.xxhash64("near", F.lit(turn)).alias("h"), "near"))
        own = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), F.col("node").alias("near"))
        move = stage(both.groupBy("node").agg(F.least(first, own)["near"].alias("to")), "moves")
        moves.append(move)
        moved = (
            edges.join(move.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
            .join(move.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
            .filter("ta <> tb")
        )
        edges = stage(
            moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "links"
        )
    labels = None
    for move in reversed(moves):
        if labels is None:
            labels = move.select("node", F.col("to").alias("component"))
            continue
        later = labels.select(F.col("node").alias("to"), "component")
        labels = stage(
            move.join(later, "to", "left").select("node", F.coalesce("component", "to").alias("component")), "labels"
        )
    if labels is None:
        return alone.select("node", F.col("node").alias("component"))
    # A component so far bears the id of some member; its smallest one takes that place.
    least = labels.groupBy("component").agg(F.min("node").alias("least"))
    named = labels.join(least, "component").select("node", F.col("least").alias("component"))
    return named.union(
        alone.join(labels.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    )
