"""Connected components of a link table, by alternating star contraction.

Each round hooks the neighbours of every node to the smallest one, first for the
larger neighbours, then for the smaller ones; rounds are aggregations and joins on
the links only, written to the shared folder between rounds.  No part of the graph
visits the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

MAX_ROUNDS = 60


def _state(links: DataFrame):
    return links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (node, root): the smallest node reachable, for every node
    with a link.  Self-links, repeated links and nulls are ignored."""
    cur = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), "links")
    state = _state(cur)
    for _ in range(MAX_ROUNDS):
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialise(both.groupBy("a").agg(F.min("b").alias("m"))
                          .select("a", F.least("a", "m").alias("m")), "low")
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialise(large.where("a <> b").distinct(), "large")
        low = materialise(large.groupBy("a").agg(F.min("b").alias("m")), "low")
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))))
        cur = materialise(small.distinct(), "links")
        new = _state(cur)
        if new == state:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = new
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewer links with the same components: every node but the smallest of its
    component, linked to that smallest one."""
    nodes, flat = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = flat[: len(u)], flat[len(u):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jump = new[new]
            if np.array_equal(jump, new):
                break
            new = jump
        if np.array_equal(new, label):
            break
        label = new
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]
