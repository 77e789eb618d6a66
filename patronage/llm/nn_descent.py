"""Embedding near-duplicates by NN-descent.

Vectors of one label form a neighbour graph. It starts from the leaves of trees
of random hyperplanes through the label's centre, as many as make a linked pair
share a leaf with probability 0.999 (at most ``TREES``), and is refined by neighbours-of-neighbours joins: a node
sends its vector to the nodes it is listed with, and each of these compares
the vectors it got. A list keeps its best ``LIST`` neighbours and, while they
are links, is enlarged up to ``FULL``. Rounds end when one adds no link. Nodes
still saturated at ``FULL`` links are dense: their links to each other are
counted exactly, tile by tile, and no pair is written. A tile holds rows of one
component; tiles of one label meet, also across components, unless the angle
between their centres exceeds their reaches and the threshold's angle, and
links between components unite them.

Two audits follow every forest. The trees of the next forest, drawn apart from
all before, are grown: the share of their links that the graph holds already is
the share it holds of all. And a bounded set of queries, half of them ends of
those links so that rare links are seen, is compared with all rows. Unless both
reach the recall, the new trees' edges join the graph and the rounds go on; the
run fails if the last forest does not reach it.

Exact copies are one node with a multiplicity. Vectors that are null, zero or
hold null or non-finite components, and those without label, link with
nothing; so do vectors of different length. Repeated rows count as vectors.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.common import cut, parallelism, sorted_runs, table, written
from patronage.llm.components import connected_components

LIST, FULL = 6, 64
LEAF, HUB, TILE = 256, 128, 2048
ROUNDS, FORESTS, TREES = 8, 6, 64
AUDIT_ROWS, AUDIT_RECALL = 256, 0.995
#: A signature has at most so many bits; leaves of longer ones are chunks in its order.
BITS = 30


def _prepared(kind: str):
    def run(batches):
        for b in batches:
            lists = b.column(2)
            out = []
            for v in lists.to_pylist():
                x = None
                if v and all(c is not None for c in v):
                    x = np.array(v, kind)
                    wide = x.astype(np.float64)
                    if not np.isfinite(wide).all() or not 0 < wide @ wide < np.inf:
                        x = None
                out.append(None if x is None else (x + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], ["vec_id", "label", "v"])
    return run


def unit(parts: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(parts), kind).reshape(len(parts), -1).astype(np.float64)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _directed(ids: np.ndarray, sims: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, ...]:
    """(a, b, sim) wherever sim exceeds what a's list asks for."""
    i, j = np.nonzero(sims > need[:, None])
    return ids[i], ids[j], sims[i, j]


def _edges(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    a, b, s = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(s)], ["a", "b", "sim"])


def _runs(batches, columns: int):
    """Whole runs of equal first columns from sorted batches, as lists of
    (key column, other columns...) chunks; runs are bounded by the caller."""
    held = None
    for b in batches:
        if not len(b):
            continue
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        key = held.column(0).to_numpy()
        last = int(np.searchsorted(key, key[-1]))
        if last:
            yield held.slice(0, last).combine_chunks()
            held = held.slice(last)
    if held is not None and len(held):
        yield held.combine_chunks()


def _sums(kind: str):
    """(g, pos, s): sums of the unit vectors of a batch by component."""
    def run(batches):
        for b in batches:
            group, vs = b.column(0).to_numpy(), b.column(1).to_pylist()
            for g in np.unique(group).tolist():
                x = unit([vs[i] for i in np.flatnonzero(group == g)], kind).sum(axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), g)), pa.array(np.arange(len(x), dtype=np.int32)), pa.array(x)], ["g", "pos", "s"])
    return run


def _sized(nodes: DataFrame, kind: str) -> DataFrame:
    """(g, size, centre): the nodes of a label, and the mean of their unit
    vectors where they fill more than one leaf (else null)."""
    sizes = nodes.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
    large = sizes.where(F.col("size") > LEAF // 2)
    sums = nodes.join(large, "g").select("g", "v").mapInArrow(_sums(kind), "g long, pos int, s double").groupBy("g", "pos").agg(F.sum("s").alias("s"))
    centre = sums.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("pos", "s"))).alias("c"))
    return cut(sizes.join(centre, "g", "left").withColumn("centre", F.expr("transform(c, x -> x.s / size)")).drop("c"))


def _trees(sizes: DataFrame, threshold: float) -> int:
    """Trees that make a pair at the threshold share a leaf with probability
    0.999, in the label that needs most: seen from the centre, the pair's angle
    is wider the closer the label's vectors lie to it."""
    radius = F.expr("sqrt(greatest(1 - aggregate(centre, 0D, (a, x) -> a + x * x), 1e-9D))")
    angle = 2 * F.asin(F.least(F.lit(1.0), math.sqrt(2 - 2 * threshold) / (2 * radius)))
    bits = F.least(F.lit(BITS), F.greatest(F.lit(0), F.ceil(F.log2(2 * F.col("size") / LEAF))))
    together = F.least(F.lit(0.9999), F.greatest(F.lit(1e-9), F.pow(1 - angle / math.pi, bits)))
    need = F.ceil(math.log(0.001) / F.log(1 - together))
    return min(TREES, int(sizes.where("centre is not null").agg(F.max(need)).first()[0] or 1))


def _signatures(kind: str, trees: int, seed: int):
    """One row per tree: (leaf, signature, rid, v); a leaf takes as many bits
    of the signature as bring its label's rows to about LEAF / 2."""
    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            rid, group, size = (b.column(i).to_numpy() for i in range(3))
            vs = b.column(3).to_pylist()
            lengths = np.array([len(v) for v in vs])
            for n in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == n)
                x = unit([vs[i] for i in at], kind)
                for g in np.unique(group[at]).tolist():
                    k = np.flatnonzero(group[at] == g)
                    centre = b.column(4)[int(at[k[0]])].as_py()
                    if centre is not None:
                        x[k] -= np.array(centre)
                if n not in planes:
                    planes[n] = np.random.default_rng([seed, n]).normal(size=(trees, x.shape[1], BITS))
                bits = np.clip(np.ceil(np.log2(np.maximum(2 * size[at] / LEAF, 1))), 0, BITS).astype(np.int64)
                for t in range(trees):
                    sign = ((x @ planes[n][t] > 0) * (1 << np.arange(BITS - 1, -1, -1))).sum(axis=1).astype(np.int64)
                    leaf = (group[at].astype(np.uint64) + np.uint64((seed * 1000 + t) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xC2B2AE3D27D4EB4F) ^ ((sign >> (BITS - bits)).astype(np.uint64) * np.uint64(0x165667B19E3779F9))
                    yield pa.RecordBatch.from_arrays([pa.array(leaf.view(np.int64)), pa.array(sign), pa.array(rid[at]), pa.array(group[at]), pa.array([vs[i] for i in at], pa.binary())], ["leaf", "sign", "rid", "g", "v"])
    return run


def _leaf_edges(kind: str, threshold: float):
    def run(batches):
        for t in _runs(batches, 5):
            out = []
            bounds = sorted_runs(t.column("leaf").to_numpy())
            rid, group, vs = t.column("rid").to_numpy(), t.column("g").to_numpy(), t.column("v").to_pylist()
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                for i in range(lo, hi, LEAF):
                    j = min(hi, i + LEAF)
                    for g in np.unique(group[i:j]):  # two labels only where leaf numbers collide
                        k = i + np.flatnonzero(group[i:j] == g)
                        if len(k) < 2:
                            continue
                        x = unit([vs[q] for q in k], kind)
                        s = x @ x.T
                        np.fill_diagonal(s, -2)
                        best = np.partition(s, len(k) - min(LIST, len(k) - 1), axis=1)[:, len(k) - min(LIST, len(k) - 1)]
                        full = np.partition(s, max(0, len(k) - FULL), axis=1)[:, max(0, len(k) - FULL)]
                        out.append(_directed(rid[k], s, np.nextafter(np.maximum(np.minimum(best, threshold), np.minimum(full, best)), -2)))
            yield _edges(out)
    return run


def _hub_edges(kind: str):
    def run(batches):
        for t in _runs(batches, 5):
            out = []
            bounds = sorted_runs(t.column("hub").to_numpy())
            rid, fresh, need, vs = t.column("rid").to_numpy(), t.column("fresh").to_numpy(), t.column("need").to_numpy(), t.column("v").to_pylist()
            for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if j - i < 2:
                    continue
                x = unit(vs[i:j], kind)
                s = x @ x.T
                f = fresh[i:j]
                s[~(f[:, None] | f[None, :]) | (rid[i:j, None] == rid[None, i:j])] = -2
                out.append(_directed(rid[i:j], s, need[i:j]))
            yield _edges(out)
    return run


def _centres(kind: str):
    """Rows (tile, g, v) of whole tiles -> (tile, g, centre, reach): the reach
    is the widest angle between the centre and a row."""
    def run(batches):
        for t in _runs(batches, 3):
            bounds = sorted_runs(t.column("tile").to_numpy())
            tile, group, vs = t.column("tile").to_numpy(), t.column("g").to_numpy(), t.column("v").to_pylist()
            out = []
            for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                x = unit(vs[i:j], kind)
                c = x.mean(axis=0)
                c = c / np.linalg.norm(c) if np.linalg.norm(c) > 1e-6 else x[0]
                out.append((tile[i], group[i], c.tobytes(), float(np.arccos(np.clip(x @ c, -1, 1)).max())))
            cols = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.binary(), pa.float64()), strict=True)], ["tile", "g", "centre", "reach"])
    return run


def _near_tiles(threshold: float):
    """Rows (block, mine, tile, centre, reach): the tiles of the first block
    with those of the second that may hold a link, each with itself too."""
    def run(batches):
        for t in _runs(batches, 5):
            bounds = sorted_runs(t.column("block").to_numpy())
            mine, tile, reach, cs = t.column("mine").to_numpy(), t.column("tile").to_numpy(), t.column("reach").to_numpy(), t.column("centre").to_pylist()
            for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                a, b = i + np.flatnonzero(mine[i:j] <= 1), i + np.flatnonzero(mine[i:j] >= 1)
                if not len(a) or not len(b):
                    continue
                y = unit([cs[k] for k in b], "<f8")
                for lo in range(0, len(a), 256):
                    part = a[lo:lo + 256]
                    angle = np.arccos(np.clip(unit([cs[k] for k in part], "<f8") @ y.T, -1, 1))
                    near = angle <= reach[part][:, None] + reach[b][None, :] + math.acos(threshold) + 1e-6  # rounding
                    near |= tile[part][:, None] == tile[b][None, :]
                    p, q = np.nonzero(near)
                    yield pa.RecordBatch.from_arrays([pa.array(tile[part][p]), pa.array(tile[b][q])], ["a", "b"])
    return run


def _tile_counts(kind: str, threshold: float):
    """Rows (pair, mine, rid, mult, v): for one pair of tiles, the number of
    vectors each row of the first links to in the second; ``other`` is one of
    these, on one row of the pair."""
    def run(batches):
        for t in _runs(batches, 5):
            ids, counts, others = [], [], []
            bounds = sorted_runs(t.column("pair").to_numpy())
            mine, rid, mult, vs = t.column("mine").to_numpy(), t.column("rid").to_numpy(), t.column("mult").to_numpy(), t.column("v").to_pylist()
            for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                a, b = i + np.flatnonzero(mine[i:j] <= 1), i + np.flatnonzero(mine[i:j] >= 1)  # 0 first, 2 second, 1 both
                if not len(a) or not len(b):
                    continue
                y = unit([vs[k] for k in b], kind)
                told = False
                for lo in range(0, len(a), 256):
                    part = a[lo:lo + 256]
                    s = unit([vs[k] for k in part], kind) @ y.T >= threshold
                    s[rid[part][:, None] == rid[b][None, :]] = False
                    ids.append(rid[part])
                    counts.append(s @ mult[b])
                    other = np.full(len(part), -1, np.int64)
                    if not told and s.any():
                        k = int(s.any(axis=1).argmax())
                        other[k], told = rid[b][s[k].argmax()], True
                    others.append(other)
            cols = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (ids, counts, others)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["rid", "n", "other"])
    return run


def _audited(kind: str, threshold: float, queries: list[tuple[int, int, bytes]]):
    def run(batches):
        by: dict[int, list[tuple[int, bytes]]] = {}
        for rid, g, v in queries:
            by.setdefault(g, []).append((rid, v))
        units = {g: (np.array([r for r, _ in q]), unit([v for _, v in q], kind)) for g, q in by.items()}
        for b in batches:
            rid, group, mult = (b.column(i).to_numpy() for i in range(3))
            vs = b.column(3).to_pylist()
            ids, counts = [], []
            for g in np.unique(group).tolist():
                if g not in units:
                    continue
                k = np.flatnonzero(group == g)
                s = units[g][1] @ unit([vs[i] for i in k], kind).T >= threshold
                s[units[g][0][:, None] == rid[k][None, :]] = False
                ids.append(units[g][0])
                counts.append(s @ mult[k])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids) if ids else [], pa.int64()), pa.array(np.concatenate(counts) if counts else [], pa.int64())], ["rid", "n"])
    return run


def _lists(edges: DataFrame, threshold: float) -> DataFrame:
    """The lists after a round: (a, b, sim, fresh), best first."""
    one = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return one.withColumn("rank", rank).where((F.col("rank") <= LIST) | (F.col("rank") <= FULL) & (F.col("sim") >= threshold))


def _join_round(graph: DataFrame, nodes: DataFrame, kind: str, threshold: float, salt: int) -> DataFrame:
    """The lists with what the neighbours of each node find among themselves;
    those of a large hub are dealt to parts anew under every ``salt``, and all
    of a part compared."""
    spark = graph.sparkSession
    need = graph.groupBy("a").agg(
        F.sum((F.col("sim") >= threshold).cast("int")).alias("links"),
        F.max(F.when(F.col("rank") == LIST, F.col("sim"))).alias("last"))
    need = need.select(F.col("a").alias("rid"), F.when(F.col("links") >= FULL, F.lit(2.0)).otherwise(
        F.least(F.coalesce("last", F.lit(-1.5)), F.lit(float(np.nextafter(threshold, -2))))).alias("need"))
    members = graph.select(F.col("a").alias("hub"), F.col("b").alias("rid"), "fresh").unionByName(
        graph.select(F.col("b").alias("hub"), F.col("a").alias("rid"), "fresh")).groupBy("hub", "rid").agg(F.max("fresh").alias("fresh"))
    hubs = members.groupBy("hub").agg(F.max("fresh").alias("any"), F.ceil(F.count(F.lit(1)) / HUB).alias("parts")).where("any or parts > 1").select("hub", "parts")
    sent = (members.join(hubs, "hub").select(F.xxhash64("hub", F.pmod(F.xxhash64("rid", F.lit(salt)), "parts")).alias("hub"), "rid", F.expr("fresh or parts > 1").alias("fresh"))
            .join(nodes.select("rid", "v"), "rid").join(need, "rid", "left")
            .select("hub", "rid", "fresh", F.coalesce("need", F.lit(-1.5)).alias("need"), "v"))
    found = sent.repartition(parallelism(spark), "hub").sortWithinPartitions("hub").mapInArrow(_hub_edges(kind), "a long, b long, sim double")
    return graph.select("a", "b", "sim", F.lit(False).alias("fresh")).unionByName(found.withColumn("fresh", F.lit(True)))


def _links(graph: DataFrame, threshold: float) -> DataFrame:
    return graph.where(F.col("sim") >= threshold).select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()


def _pairs(rows: DataFrame, key: str, own: str, parts: str) -> DataFrame:
    """The rows once for each part k of their key: ``mine`` is 0 in the run
    ``pair`` (own, k), 2 in (k, own), and 1 where own is k."""
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col(parts) - 1)))
    first = rows.withColumn("pair", F.xxhash64(key, own, "k")).withColumn("mine", F.when(F.col(own) == F.col("k"), 1).otherwise(0))
    return first.unionByName(rows.where(F.col(own) != F.col("k")).withColumn("pair", F.xxhash64(key, "k", own)).withColumn("mine", F.lit(2)))


def _counts(graph: DataFrame, links: DataFrame, comp: DataFrame, nodes: DataFrame, kind: str, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rid, n): vectors that each node links to, copies of its own aside;
    (u, v): links between dense nodes that unite all components they connect;
    and (rid) of the dense nodes."""
    spark = graph.sparkSession
    n = parallelism(spark)
    dense = graph.where(F.col("sim") >= threshold).groupBy("a").count().where(F.col("count") >= FULL).select(F.col("a").alias("rid"))
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    mark = dense.withColumn("dense", F.lit(True))
    plain = (both.join(mark.withColumnRenamed("rid", "u").withColumnRenamed("dense", "du"), "u", "left")
             .join(mark.withColumnRenamed("rid", "v").withColumnRenamed("dense", "dv"), "v", "left")
             .where("du is null or dv is null").join(nodes.select(F.col("rid").alias("v"), "mult"), "v")
             .groupBy("u").agg(F.sum("mult").alias("n")).withColumnRenamed("u", "rid"))
    rows = dense.join(comp.withColumnRenamed("node", "rid"), "rid").join(nodes.select("rid", "g", "mult", "v"), "rid")
    tiles = rows.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("tiles"))
    rows = cut(rows.join(tiles, "component").select(F.xxhash64("component", F.pmod(F.xxhash64("rid"), "tiles")).alias("tile"), "g", "rid", "mult", "v"))
    centres = cut(rows.select("tile", "g", "v").repartition(n, "tile").sortWithinPartitions("tile").mapInArrow(_centres(kind), "tile long, g long, centre binary, reach double"))
    blocks = centres.groupBy("g").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("blocks"))
    near = _pairs(centres.join(blocks, "g").withColumn("own", F.pmod(F.xxhash64("tile"), "blocks")), "g", "own", "blocks").select(F.col("pair").alias("block"), "mine", "tile", "centre", "reach")
    near = cut(near.repartition(n, "block").sortWithinPartitions("block").mapInArrow(_near_tiles(threshold), "a long, b long").withColumn("pair", F.xxhash64("a", "b")))
    first = near.join(rows, near.a == rows.tile).select("pair", F.when(F.col("a") == F.col("b"), 1).otherwise(0).alias("mine"), "rid", "mult", "v")
    second = near.where("a <> b").join(rows, F.col("b") == rows.tile).select("pair", F.lit(2).alias("mine"), "rid", "mult", "v")
    exact = cut(first.unionByName(second).repartition(n, "pair").sortWithinPartitions("pair").mapInArrow(_tile_counts(kind, threshold), "rid long, n long, other long"))
    uniting = exact.where("other >= 0").select(F.least("rid", "other").alias("u"), F.greatest("rid", "other").alias("v"))
    return plain.unionByName(exact.select("rid", "n")).groupBy("rid").agg(F.sum("n").alias("n")), uniting, dense


def _asked(nodes: DataFrame, control: DataFrame, kind: str, threshold: float) -> dict[int, int]:
    """The audit's queries, AUDIT_ROWS nodes by hash and as many ends of
    ``control`` links, and the vectors each of them links to."""
    by = (F.xxhash64("rid"), "rid")
    ends = control.select(F.explode(F.array("u", "v")).alias("rid")).distinct().orderBy(*by).limit(AUDIT_ROWS)
    some = nodes.select("rid").orderBy(*by).limit(AUDIT_ROWS)
    asked = [(r.rid, r.g, bytes(r.v)) for r in nodes.select("rid", "g", "v").join(ends.union(some).distinct(), "rid").collect()]
    counts = nodes.select("rid", "g", "mult", "v").mapInArrow(_audited(kind, threshold, asked), "rid long, n long").groupBy("rid").agg(F.sum("n").alias("n"))
    return {r.rid: r.n for r in counts.collect()}


class Audit(NamedTuple):
    """After a forest: the share of the next trees' links that were known and
    their number, the share of the queries' links that were found and theirs.
    Without links to judge by, a share is None."""

    known: float | None
    tree_links: int
    recall: float | None
    query_links: int

    def reached(self) -> bool:
        return all(x is None or x >= AUDIT_RECALL for x in (self.known, self.recall))


def _share(part: int, whole: int) -> float | None:
    return part / whole if whole else None


def embedding_groups(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                     audit: list | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector. ``audit``, a
    list, receives the ``Audit`` after every forest."""
    spark = vectors.sparkSession
    kind = "<f4" if vectors.schema[vector_col].dataType.elementType == T.FloatType() else "<f8"
    item = "float" if kind == "<f4" else "double"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast(f"array<{item}>").alias("e"))
    rows = written(rows.mapInArrow(_prepared(kind), "vec_id long, label string, v binary"))
    able = rows.where("label is not null and v is not null")
    nodes = able.groupBy("label", "v").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("mult"))
    nodes = written(nodes.select(F.monotonically_increasing_id().alias("rid"), F.xxhash64("label", F.octet_length("v")).alias("g"), "label", "v", "least", "mult"))
    sizes = _sized(nodes, kind)
    sized = nodes.join(sizes, "g").select("rid", "g", "size", "v", "centre")
    trees = _trees(sizes, threshold)

    def grown(forest: int) -> DataFrame:
        leaves = sized.mapInArrow(_signatures(kind, trees, forest), "leaf long, sign long, rid long, g long, v binary")
        return (leaves.repartition(parallelism(spark), "leaf").sortWithinPartitions("leaf", "sign", F.xxhash64("rid", "leaf"))  # equal signatures are shuffled anew in every tree
                .mapInArrow(_leaf_edges(kind, threshold), "a long, b long, sim double").withColumn("fresh", F.lit(True)))

    graph, seen = cut(_lists(grown(0), threshold)), -1
    truth = None
    for forest in range(FORESTS):
        for k in range(ROUNDS):
            graph = cut(_lists(_join_round(graph, nodes, kind, threshold, forest * ROUNDS + k), threshold))
            now = graph.where(F.col("sim") >= threshold).count()
            if now == seen:
                break
            seen = now
        links = cut(_links(graph, threshold))
        comp = connected_components(links)
        counts, uniting, dense = _counts(graph, links, comp, nodes, kind, threshold)
        counts = cut(counts)
        fresh = cut(_lists(grown(forest + 1), threshold))
        control = cut(_links(fresh, threshold))
        # Links between two dense nodes are counted without being listed.
        judged = (control.join(dense.select(F.col("rid").alias("u"), F.lit(1).alias("du")), "u", "left")
                  .join(dense.select(F.col("rid").alias("v"), F.lit(1).alias("dv")), "v", "left").where("du is null or dv is null"))
        held, whole = judged.join(links.withColumn("held", F.lit(1)), ["u", "v"], "left").agg(F.count("held"), F.count(F.lit(1))).first()
        if truth is None:
            truth = _asked(nodes, control, kind, threshold)
        got = {r.rid: r.n for r in counts.where(F.col("rid").isin(list(truth))).collect()}
        wanted = sum(truth.values())  # every counted link was compared, so a node's count tells what it lacks
        state = Audit(_share(held, whole), whole, _share(sum(min(n, got.get(r, 0)) for r, n in truth.items()), wanted), wanted)
        if audit is not None:
            audit.append(state)
        if state.reached():
            break
        graph = cut(_lists(graph.select("a", "b", "sim", F.lit(False).alias("fresh")).unionByName(fresh.select("a", "b", "sim", "fresh")), threshold))
    else:
        raise RuntimeError(f"op4: after {FORESTS} forests the audited recall is {state}, {AUDIT_RECALL} is asked for")
    of = comp.withColumnRenamed("node", "u").withColumnRenamed("component", "cu")
    across = cut(uniting.join(of, "u").join(of.toDF("v", "cv"), "v").where("cu <> cv").select(F.col("cu").alias("u"), F.col("cv").alias("v")).distinct())
    if not across.isEmpty():
        united = connected_components(across).toDF("component", "whole")
        comp = comp.join(united, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    least = comp.join(nodes.select(F.col("rid").alias("node"), "least"), "node").groupBy("component").agg(F.min("least").alias("group_least"))
    named = comp.join(least, "component").select(F.col("node").alias("rid"), "group_least")
    full = (nodes.join(counts, "rid", "left").join(named, "rid", "left")
            .select(F.col("label").alias("l2"), F.col("v").alias("v2"), (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("group_least", "least").alias("component_id")))
    out = able.join(full, F.expr("label = l2 and v = v2")).select("vec_id", "n_links", "component_id").unionByName(
        rows.where("label is null or v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(table(spark, sf_dir, "embeddings"))
