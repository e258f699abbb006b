"""Connected components of a link table by alternating stars.

Each round hangs every node's larger neighbours on its smallest neighbour
(large star), then its smaller ones (small star), until the links are one star
per component. Only link rows move: a hub's rows are combined map-side for its
minimum, and the minimum is joined back from a stored table, so that adaptive
execution splits a hub that holds a third of all links.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored


def spanning_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node) for the nodes that the given links join, without
    the smallest ones themselves: at most one row a node."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    low = np.arange(len(ids))
    u, v = at[: len(a)], at[len(a) :]
    while True:
        before = low.copy()
        m = np.minimum(low[u], low[v])
        for side in (u, v):
            np.minimum.at(low, low[side], m)
        while (low != low[low]).any():
            low = low[low]
        if (low == before).all():
            break
    keep = low != np.arange(len(ids))
    return ids[keep], ids[low[keep]]


def _contract(batches):
    """Links of one task, batch by batch, as a spanning forest."""
    for pdf in batches:
        node, low = spanning_forest(pdf["a"].to_numpy(np.int64), pdf["b"].to_numpy(np.int64))
        yield pd.DataFrame({"a": node, "b": low})


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: a > b. Large: each node's larger neighbours go to its smallest
    neighbour or itself; small: its smaller neighbours and itself do."""
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "low")
        out = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        low = stored(links.groupBy("a").agg(F.min("b").alias("m")), "low")
        moved = links.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        out = moved.unionByName(low.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """links (a long, b long), any order, repeats allowed, nulls ignored ->
    (node, component): one row for each node of a link between two nodes,
    component being the smallest node it can reach. No links: no rows."""
    links = links.select("a", "b").where("a is not null and b is not null and a != b")
    links = stored(links.mapInPandas(_contract, "a long, b long").distinct(), "links")
    seen = None
    while True:
        links = stored(_star(stored(_star(links, True), "links"), False), "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = tuple(state)
