"""SimHash near-duplicates by bit-sliced comparison.

64-bit fingerprints are grouped by pairs of five bit blocks: a distance of at
most three leaves two of five blocks untouched, so every link meets in one of
ten block pairs. Inside a group the fingerprints are stored as bit planes, 64
of them to a machine word; a plane's differences are added to carry-save
counters of all 64 at once, and a word is abandoned when every counter
exceeds the radius. Groups beyond ``TILE`` fingerprints are dealt as pairs of
tiles, the same rule at every size. A tile reports a spanning set of its
links, never all pairs.

Null and blank texts have fingerprint zero and link like any other.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm.common import cut, ids_and_text, parallelism, row_key, rows_with, sorted_runs, table, words_of
from patronage.llm.components import connected_components

SEED = 42
TILE = 4096
PAIRS_AT_ONCE = 1 << 17
ONE = np.uint64(1)
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str, shingle: int = 3) -> int:
    """Majority of each bit over the XXH64 of all word shingles, repeats
    included; a bit is 1 if set in over half of them."""
    w = words_of(text)
    if not w:
        return 0
    line = b" ".join(w)
    if len(w) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    starts = np.concatenate([[0], ends[:-shingle]]).tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(line[s:e], SEED) for s, e in zip(starts, (ends[shingle - 1:] - 1).tolist(), strict=True)], np.uint64)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        counts += np.unpackbits(hashes[i:i + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], ["doc_id", "fp", *b.schema.names[2:]])
    return run


def block_masks(radius: int) -> list[int]:
    """Masks of pairs of blocks; ``radius`` + 2 blocks leave two untouched."""
    edges = [round(64 * i / (radius + 2)) for i in range(radius + 3)]
    blocks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:], strict=False)]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(a | b) for a, b in combinations(blocks, 2)]


def planes_of(lanes: np.ndarray) -> np.ndarray:
    """(blocks, 64) fingerprints -> (64 bit planes, blocks) words whose bit i
    belongs to lane i."""
    bits = np.unpackbits(lanes.view(np.uint8).reshape(len(lanes), 64, 8), axis=2, bitorder="little")
    words = np.packbits(np.ascontiguousarray(bits.transpose(0, 2, 1)), axis=2, bitorder="little")
    return np.ascontiguousarray(np.ascontiguousarray(words).view(np.uint64)[:, :, 0].T)


def within(planes: np.ndarray, query: np.ndarray, block: np.ndarray, lanes: np.ndarray, radius: int):
    """For pairs of a query fingerprint and a block of 64: (index of the pair,
    word of the lanes within ``radius``), blocks without any left out."""
    at, q, alive = np.arange(len(query)), query, lanes[block]
    counters = [np.zeros(len(query), np.uint64) for _ in range(radius.bit_length())]
    over = np.zeros(len(query), np.uint64)
    for p in range(64):
        carry = planes[p][block] ^ (np.uint64(0) - (q >> np.uint64(p) & ONE))
        for c in range(len(counters)):
            counters[c], carry = counters[c] ^ carry, counters[c] & carry
        over |= carry
        if p % 8 == 7:
            more, same = over.copy(), np.full(len(over), ALL)
            for c in range(len(counters) - 1, -1, -1):
                if radius >> c & 1:
                    same &= counters[c]
                else:
                    more |= same & counters[c]
                    same &= ~counters[c]
            left = alive & ~more
            keep = left != 0
            if not keep.all():
                at, q, block, over, left = at[keep], q[keep], block[keep], over[keep], left[keep]
                counters = [c[keep] for c in counters]
            alive = left
            if not len(at):
                break
    return at, alive


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest position linked, directly or not, to each of 0..n-1."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, a, m)
        np.minimum.at(new, b, m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def group_links(fps: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links, as positions, that connect what each run of ``fps`` connects."""
    sizes = np.diff(starts)
    n_blocks = -(-sizes // 64)
    first_block = np.concatenate([[0], np.cumsum(n_blocks)])
    run_of = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(fps)) - starts[run_of]
    block = first_block[run_of] + place // 64
    lanes = np.zeros((first_block[-1], 64), np.uint64)
    lanes[block, place % 64] = fps
    valid = np.zeros(first_block[-1], np.uint64)
    np.bitwise_or.at(valid, block, ONE << (place % 64).astype(np.uint64))
    position = np.zeros((first_block[-1], 64), np.int64)
    position[block, place % 64] = np.arange(len(fps))
    planes = np.concatenate([planes_of(lanes[i:i + 1024]) for i in range(0, len(lanes), 1024)], axis=1)
    low = np.arange(len(fps))
    pairs_of = n_blocks[run_of]
    bounds = np.concatenate([[0], np.cumsum(pairs_of)])
    i = 0
    while i < len(fps):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + PAIRS_AT_ONCE, "right")) - 1)
        q = np.repeat(np.arange(i, j), pairs_of[i:j])
        k = np.arange(len(q)) - np.repeat(bounds[i:j] - bounds[i], pairs_of[i:j])
        at, word = within(planes, fps[q], first_block[run_of[q]] + k, valid, radius)
        for x in range(0, len(at), 1 << 14):
            bits = np.unpackbits(word[x:x + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            r, lane = np.nonzero(bits)
            src = q[at[x:x + (1 << 14)][r]]
            dst = position[first_block[run_of[src]] + k[at[x:x + (1 << 14)][r]], lane]
            on = src < dst
            a, b = low[src[on]], low[dst[on]]
            on = a != b
            if on.any():
                low = spanning(a[on], b[on], len(fps))[low]
        i = j
    hi = np.flatnonzero(low != np.arange(len(fps)))
    return hi, low[hi]


def _tile_links(radius: int):
    """Rows (tile, fp, rep) sorted by tile -> links of reps. Whole runs are
    gathered before they are compared; a run holds at most two tiles."""
    def compare(tile, fp, rep):
        starts = sorted_runs(tile)
        a, b = group_links(fp.view(np.uint64), starts, radius)
        return pa.RecordBatch.from_arrays([pa.array(rep[a]), pa.array(rep[b])], ["u", "v"])

    def run(batches):
        held: list[tuple] = []
        rows = 0
        for b in batches:
            held.append(tuple(b.column(i).to_numpy(zero_copy_only=False) for i in range(3)))
            rows += len(b)
            if rows >= 16 * TILE:
                tile, fp, rep = (np.concatenate(x) for x in zip(*held, strict=True))
                end = int(np.searchsorted(tile, tile[-1]))
                if end:
                    yield compare(tile[:end], fp[:end], rep[:end])
                held, rows = [(tile[end:], fp[end:], rep[end:])], len(tile) - end
        if rows:
            yield compare(*(np.concatenate(x) for x in zip(*held, strict=True)))
    return run


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per document;
    documents whose fingerprints differ in at most ``radius`` bits, directly or
    through others, share the smallest doc_id as component_id."""
    fps = cut(ids_and_text(docs, id_col, text_col).mapInArrow(_fingerprints(shingle), "doc_id long, fp long"))
    return _labelled(fps, radius).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _labelled(fps: DataFrame, radius: int) -> DataFrame:
    """The rows (doc_id, fp, more) with their component_id."""
    spark = fps.sparkSession
    reps = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    masks = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(block_masks(radius))])
    keyed = reps.where("rep is not null").select("fp", "rep", F.explode(masks).alias("k")).select("fp", "rep", "k.mask", "k.bits")
    sizes = keyed.groupBy("mask", "bits").count().where("count > 1").select("mask", "bits", F.ceil(F.col("count") / TILE).alias("tiles"))
    own = F.pmod(F.xxhash64("fp"), F.col("tiles"))
    tiled = (keyed.join(sizes, ["mask", "bits"]).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
             .select(F.xxhash64("mask", "bits", F.least("own", "other"), F.greatest("own", "other")).alias("tile"), "fp", "rep"))
    links = (tiled.repartition(parallelism(spark), "tile").sortWithinPartitions("tile", "rep")
             .mapInArrow(_tile_links(radius), "u long, v long"))
    comp = connected_components(links)
    labels = (reps.join(comp, reps.rep == comp.node, "left")
              .select(F.col("fp").alias("label_fp"), F.coalesce("component", "rep").alias("component_id")))
    return fps.join(labels, fps.fp == labels.label_fp).drop("label_fp")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows, with all their columns, of each group's smallest doc_id; where
    that id stands with several texts of the group, one of them. Of rows
    without id one of each fingerprint that no row with id has stays."""
    texts = ids_and_text(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    fps = cut(texts.mapInArrow(_fingerprints(shingle), "doc_id long, fp long, text_hash long"))
    stay = (_labelled(fps, radius).where("doc_id <=> component_id").groupBy("doc_id", F.when(F.col("doc_id").isNull(), F.col("fp")).alias("fp"))
            .agg(F.min("text_hash").alias("text_hash")).select(row_key("doc_id", F.col("text_hash"))))
    return rows_with(docs, stay, row_key(id_col, F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))), text_col)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))
