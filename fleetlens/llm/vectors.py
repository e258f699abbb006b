"""Near-duplicate vectors by product quantisation.

Vectors are cut to unit length and put into coarse inverted lists; what is
left over the list's centre is coded per subspace by 256 centres. A vector
probes every list that can hold a vector within reach, distances to the coded
vectors come from one table per query and list, and what may be near enough is
compared exactly.

Exactly (``recall`` None), no pair is lost. A list is left out only if a bound
rules it out: it holds vectors between two distances from its centre, all on
its own side of the plane halfway to any other centre. The table distance drops
no pair either: a coded vector's own error is stored with it, and by the
triangle inequality a pair within reach has a table distance of at most the
reach plus that error. Where vectors have no clusters the bounds rule out
little, and all pairs are compared by their tables, in time with the square of
the table.

With a ``recall`` a vector probes only the lists whose centres are not much
farther than its own one. How much is measured on the index itself: vectors of
the sample that the centres were not fitted on are given partners just at the reach, in random directions, and the
margin is such that this share of those pairs meets, each end probing the
other's list. Nearer pairs meet more often. So probes follow the number of
lists and the shape of the vectors, at every size.

Equal vectors are one node. Lists are dealt to blocks of bounded size; a pair
of blocks meets once, with the vectors of each that can reach the other, and
gives counts for both ends and a spanning forest of the links, never the pairs
themselves.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, spanning_forest
from .shared import stored

#: The centres are fitted on at most so many vectors, those with the smallest
#: hashes (a documented bound); every vector is indexed.
MOST_SAMPLE = 32_768
LIST_ROWS, MOST_LISTS = 256, 4096
#: One in so many sampled vectors, but at most so many, is kept apart to measure
#: the margin of probes on, with so many made-up partners each.
APART, MOST_TRIALS, PARTNERS = 8, 4096, 4
SUB_DIMS, SUB_CENTRES = 8, 256
ROUNDS = 10
#: Rows and bytes of vectors of a block: a vector is shipped once for each
#: block within its reach, and two blocks are in memory at a time.
BLOCK_ROWS, BLOCK_BYTES = 16_384, 1 << 25
#: What roundings may add to a distance: pairs past the reach by this are
#: compared as well.
SLACK = 1e-6


def unit(v: np.ndarray) -> np.ndarray:
    v = v.astype(np.float64)
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def square_gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd's rounds from evenly spread rows; an empty centre stays."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        own = np.concatenate([square_gaps(x[i : i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])
        n = np.bincount(own, minlength=len(centres))
        order = np.argsort(own, kind="stable")
        filled = np.flatnonzero(n)
        centres[filled] = np.add.reduceat(x[order], (np.cumsum(n) - n)[filled], axis=0) / n[filled, None]
    return centres


class Index:
    """Centres of lists and of subspaces."""

    def __init__(self, sample: np.ndarray, n_rows: int):
        x = unit(sample)
        # Not the order of the hashes alone decides where rounds begin.
        self.lists = kmeans(x, max(1, min(MOST_LISTS, n_rows // LIST_ROWS, len(x) // 8)))
        left = x - self.lists[self.list_of(x)]
        self.cuts = [(i, min(i + SUB_DIMS, x.shape[1])) for i in range(0, x.shape[1], SUB_DIMS)]
        self.books = [kmeans(left[:, a:b], SUB_CENTRES) for a, b in self.cuts]

    def list_of(self, x: np.ndarray) -> np.ndarray:
        return square_gaps(x, self.lists).argmin(1)

    def reached(self, x: np.ndarray, reach: float, inner: np.ndarray, outer: np.ndarray, margin: float = np.inf) -> np.ndarray:
        """Which lists may hold a vector within reach of each query; members
        of a list are between ``inner`` and ``outer`` from its centre, and no
        other centre is nearer to them. Only lists within ``margin`` of the
        nearest centre are probed."""
        gaps = square_gaps(x, self.lists)
        far = np.sqrt(gaps)
        own, at = np.unique(gaps.argmin(1), return_inverse=True)
        apart = np.sqrt(square_gaps(self.lists[own], self.lists))[at]
        reach += SLACK
        return (far - far.min(1, keepdims=True) <= margin) & (far <= outer + reach) & (far >= inner - reach) & (gaps - gaps.min(1, keepdims=True) <= 2 * reach * apart + SLACK)

    def margin(self, others: np.ndarray, least: float, recall: float) -> float:
        """The distance beyond the own centre within which lists are probed,
        for this share of pairs at cosine ``least`` to meet from both ends.
        ``others`` must not be among the vectors that the centres were fitted
        on: those lie nearer to their own centre than others do."""
        rng = np.random.Generator(np.random.PCG64(7))
        x = np.repeat(unit(others)[:MOST_TRIALS], PARTNERS, axis=0)
        side = rng.normal(size=x.shape)
        side = side - (side * x).sum(1, keepdims=True) * x
        length = np.sqrt((side * side).sum(1, keepdims=True))
        y = least * x + np.sqrt(1 - least**2) * side / np.maximum(length, 1e-12)
        beyond = np.empty(len(x))
        for i in range(0, len(x), 4096):
            far, back = (np.sqrt(square_gaps(z[i : i + 4096], self.lists)) for z in (x, y))
            at, of, row = far.argmin(1), back.argmin(1), np.arange(len(far))
            beyond[i : i + 4096] = np.maximum(far[row, of] - far[row, at], back[row, at] - back[row, of])
        return float(np.quantile(beyond, recall, method="higher"))

    def code(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, distance of each vector from its coded form)."""
        left = x - self.lists[own]
        codes, error = np.empty((len(x), len(self.cuts)), np.uint8), np.zeros(len(x))
        for m, (a, b) in enumerate(self.cuts):
            gaps = square_gaps(left[:, a:b], self.books[m])
            codes[:, m] = gaps.argmin(1)
            error += gaps[np.arange(len(x)), codes[:, m]]
        return codes, np.sqrt(error)

    def tables(self, x: np.ndarray) -> list[np.ndarray]:
        """Per subspace: what each code takes off or adds for each query,
        whatever the list."""
        return [-2 * self.books[m] @ x[:, a:b].T for m, (a, b) in enumerate(self.cuts)]

    def table_distances(self, x: np.ndarray, own: int, codes: np.ndarray, tables: list[np.ndarray] | None = None) -> np.ndarray:
        """Distances of queries to the coded vectors of one list."""
        tables = self.tables(x) if tables is None else tables
        centre = self.lists[own]
        coded = centre + np.concatenate([book[codes[:, m]] for m, book in enumerate(self.books)], axis=1)
        total = ((coded * coded).sum(1)[:, None] + ((x * x).sum(1) - 2 * x @ centre)).astype(np.float64)
        for m, table in enumerate(tables):  # whole rows of a table are added
            total += table.take(codes[:, m], axis=0)
        return np.sqrt(np.maximum(total, 0, out=total), out=total).T


def reach_of(least: float) -> float:
    return float(np.sqrt(max(0.0, 2 - 2 * least)))


def block_links(index: Index, own: int, q: np.ndarray, tables: list[np.ndarray], v: np.ndarray, codes: np.ndarray, error: np.ndarray, least: float):
    """(query rows, index rows) of the pairs of queries and vectors of one
    list that link, in bounded parts."""
    reach = reach_of(least) + SLACK
    for j in range(0, len(v), 2048):
        at = slice(j, j + 2048)
        a, b = np.nonzero(index.table_distances(q, own, codes[at], tables) <= reach + error[at])
        for k in range(0, len(a), 100_000):
            x, y = a[k : k + 100_000], b[k : k + 100_000] + j
            hold = np.einsum("ij,ij->i", q[x], v[y]) >= least
            if hold.any():
                yield x[hold], y[hold]


def deal_lists(centres: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first block, number of blocks) of each list. Lists are taken from
    neighbour to neighbour and put together up to ``size`` rows; a larger one
    is spread over blocks of its own."""
    first, parts = np.zeros(len(counts), np.int64), np.maximum(-(-counts // size), 1)
    left, at, block, held = np.ones(len(counts), bool), 0, 0, 0
    for _ in range(len(counts)):
        left[at] = False
        if held and held + counts[at] > size:
            block, held = block + 1, 0
        first[at], held = block, held + counts[at]
        if parts[at] > 1:
            block, held = block + parts[at], 0
        if left.any():
            at = int(np.where(left, square_gaps(centres[at : at + 1], centres)[0], np.inf).argmin())
    return first, parts


def _usable(kind):
    def run(batches):
        for batch in batches:
            out = []
            for x in batch.column("v"):
                v = np.asarray(x.values.to_numpy(zero_copy_only=False), kind) if x.is_valid and not x.values.null_count else np.empty(0, kind)
                good = len(v) and np.isfinite(v).all() and np.isfinite(n := (v.astype(np.float64) ** 2).sum()) and n > 0
                out.append((v + kind(0)).tobytes() if good else None)  # adding zero turns -0 into 0
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(out, pa.binary())], names=["vec_id", "raw"])

    return run


def _matrix(raw, kind) -> np.ndarray:
    return unit(np.stack([np.frombuffer(x, kind) for x in raw]))


def _link(nodes: DataFrame, kind, dims: int, least: float, recall: float | None) -> DataFrame:
    """Nodes (node, copies, raw) of one length -> (a, b, links): links of node
    a within a pair of blocks, and forest edges a - b with no count."""
    spark = nodes.sparkSession
    n_rows = nodes.count()
    sample = nodes.select("node", "raw").orderBy(F.xxhash64("raw"), "node").limit(MOST_SAMPLE).toArrow()
    sample = np.stack([np.frombuffer(x.as_py(), kind) for x in sample.column("raw")])
    others = np.arange(len(sample)) % APART == 1 if recall is not None else np.zeros(len(sample), bool)
    fitted = Index(sample[~others], n_rows)
    margin = fitted.margin(sample[others], least, recall) if others.any() else np.inf
    held = spark.sparkContext.broadcast(fitted)

    def coded(batches):
        for pdf in batches:
            if len(pdf):
                x = _matrix(pdf["raw"], kind)
                own = held.value.list_of(x)
                codes, error = held.value.code(x, own)
                gap = np.sqrt(((x - held.value.lists[own]) ** 2).sum(1))
                yield pdf.assign(list=own.astype(np.int32), codes=[c.tobytes() for c in codes], error=error, gap=gap)[["list", "node", "copies", "raw", "codes", "error", "gap"]]

    columns = "list int, node long, copies long, raw binary, codes binary, error double"
    index = stored(nodes.select("node", "copies", "raw").mapInPandas(coded, f"{columns}, gap double"), "index")
    # At most MOST_LISTS rows.
    lists = index.groupBy("list").agg(F.count("*").alias("n"), F.min("gap").alias("inner"), F.max("gap").alias("outer")).collect()
    centres = held.value.lists
    counts, inner, outer = np.zeros(len(centres), np.int64), np.full(len(centres), np.inf), np.full(len(centres), -np.inf)
    for row in lists:
        counts[row.list], inner[row.list], outer[row.list] = row.n, row.inner, row.outer
    first, parts = deal_lists(centres, counts, max(1, min(BLOCK_ROWS, BLOCK_BYTES // (dims * np.dtype(kind).itemsize))))
    # The lists of each block, block by block.
    of_list = np.repeat(np.arange(len(centres)), parts)
    of_block = np.repeat(first - (np.cumsum(parts) - parts), parts) + np.arange(len(of_list))
    order = np.argsort(of_block, kind="stable")
    of_list, of_block = of_list[order], of_block[order]
    starts = np.flatnonzero(np.diff(of_block, prepend=-1))
    dealt = spark.sparkContext.broadcast((inner, outer, first, parts, of_list, of_block[starts], starts))
    reach = reach_of(least)

    def sent(batches):
        for pdf in batches:
            if len(pdf):
                inner, outer, first, parts, of_list, names, starts = dealt.value
                lists = held.value.reached(_matrix(pdf["raw"], kind), reach, inner, outer, margin)
                own = pdf["list"].to_numpy()
                block = first[own] + pdf["salt"].to_numpy() % parts[own]
                row, at = np.nonzero(np.logical_or.reduceat(lists[:, of_list], starts, axis=1))
                out = pdf.drop(columns="salt").iloc[row]
                yield out.assign(block=block[row], lo=np.minimum(block[row], names[at]), hi=np.maximum(block[row], names[at]))

    def meet(key, rows):
        lo, hi = (int(k) for k in key)
        nodes, copies, block, own = (rows[c].to_numpy() for c in ("node", "copies", "block", "list"))
        q, v = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        links, edges = np.zeros(len(rows), np.int64), [(np.empty(0, np.int64),) * 2]
        if len(q) and len(v):
            inner, outer = dealt.value[:2]
            x = _matrix(rows["raw"], kind)
            codes, error = np.stack([np.frombuffer(c, np.uint8) for c in rows["codes"]]), rows["error"].to_numpy()
            of = {int(c): v[own[v] == c] for c in np.unique(own[v])}
            q, waiting = q[np.argsort(own[q], kind="stable")], 0
            for k in range(0, len(q), 512):
                a = q[k : k + 512]
                tables, asked = held.value.tables(x[a]), held.value.reached(x[a], reach, inner, outer, margin).any(0)
                for c, b in of.items():
                    if not asked[c]:
                        continue
                    for i, j in block_links(held.value, c, x[a], tables, x[b], codes[b], error[b], least):
                        i, j = a[i], b[j]
                        # Within a block every pair turns up from both its ends.
                        once = nodes[i] < nodes[j] if lo == hi else nodes[i] != nodes[j]
                        i, j = i[once], j[once]
                        links += np.bincount(i, copies[j], len(rows)).astype(np.int64) + np.bincount(j, copies[i], len(rows)).astype(np.int64)
                        edges.append((nodes[i], nodes[j]))
                        waiting += len(i)
                        if waiting > 1_000_000:
                            edges, waiting = [spanning_forest(*(np.concatenate(e) for e in zip(*edges)))], 0
        u, w = spanning_forest(*(np.concatenate(e) for e in zip(*edges)))
        some = np.flatnonzero(links)
        return pd.DataFrame({"a": np.concatenate([nodes[some], u]), "b": np.concatenate([np.full(len(some), -1), w]), "links": np.concatenate([links[some], np.zeros(len(u), np.int64)])})

    salt = F.pmod(F.xxhash64("node"), F.lit(1 << 31)).alias("salt")
    pairs = index.drop("gap").select("*", salt).mapInPandas(sent, f"{columns}, block long, lo long, hi long")
    return pairs.groupBy("lo", "hi").applyInPandas(meet, "a long, b long, links long")


def near_vectors(vectors: DataFrame, least: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", recall: float | None = None) -> DataFrame:
    """vectors -> (vec_id, n_links, component_id, kept), one row per input row.

    Vectors link when their cosine, in double precision, is at least
    ``least``; ``component_id`` is the smallest id reachable by links, the own
    included, and ``kept`` says whether it is the own. ``recall`` None finds
    every link; a share such as 0.99 probes fewer lists, so that pairs just at
    ``least`` are found with that chance and nearer ones with a higher (links
    found are exact either way). Null and zero vectors,
    and those that hold a null or a non-finite component, link with nothing.
    Vectors link within their length only. Rows with a null id link with
    nothing, have a null component and are not kept. Rows that share an id
    count as one vector for links between different vectors. An empty table
    gives no rows. Other columns are ignored.
    """
    kind = np.float32 if vectors.schema[vector_col].dataType.elementType.typeName() == "float" else np.float64
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<float>" if kind is np.float32 else "array<double>").alias("v"))
    rows = stored(rows.mapInArrow(_usable(kind), "vec_id long, raw binary"), "vectors")
    nodes = rows.where("raw is not null and vec_id is not null").groupBy("raw").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    nodes = stored(nodes.withColumn("bytes", F.octet_length("raw")), "nodes")
    found = None
    for row in nodes.groupBy("bytes").count().where("count > 1").collect():
        part = _link(nodes.where(F.col("bytes") == row.bytes), kind, row.bytes // np.dtype(kind).itemsize, least, recall)
        found = part if found is None else found.unionByName(part)
    named = rows.join(nodes.drop("bytes"), "raw", "left").select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("node")).alias("node"), F.coalesce(F.col("copies") - 1, F.lit(0)).alias("equal"))
    if found is not None:
        found = stored(found, "found")
        comps = components(found.where("links = 0"))
        links = stored(found.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links")).join(comps, "node", "full"), "nodes")
        named = named.join(links, "node", "left")
    else:
        named = named.withColumn("links", F.lit(0)).withColumn("component", F.lit(None).cast("long"))
    component = F.coalesce("component", "node", "vec_id")
    return named.select(
        "vec_id",
        F.when(F.col("node").isNull(), F.lit(0)).otherwise(F.col("equal") + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
