"""Substring near-duplicates by compact windows.

A document is a sequence of 5-word shingles. Under one min-hash the runs of at
least ``LEAST`` shingles fall into compact windows: a node of the Cartesian
tree over the hashes stands for every run between its next smaller neighbours
that contains it, and all of them share its min-hash. Nodes of enough width
are the minima of some run of LEAST, so the tree is built on those alone,
about two of every LEAST positions.

Windows of equal min-hash in different documents meet with the first of the
smallest document (sorted rows, linear in the windows). Per pair of documents
the windows of all hashes are joined by overlap and offset into regions, and
each region is verified on the shingles themselves: stretches of at least LEAST
shingles whose sets have Jaccard similarity of at least ``SIMILAR`` are reported.

The smallest document may hold only a few words around the min-hash, or hold
them at several places. Where a window with more to meet is not wholly in a
passage afterwards, all windows of its min-hash are open and meet again: by
every run of LEAST shingles whose minimum they are, so that each repeated run
is found with the smallest document that has it, and by the min-hash with the
minimum to its left and to its right, so that near copies meet in like contexts.

A passage of the smaller doc_id stays; so of every repeated passage one copy
is left. Null and short texts, and rows without doc_id, have no passages; rows
that share a doc_id are not compared with each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm.common import cut, ids_and_text, parallelism, slices, sorted_runs, table, words_of, written

SHINGLE, LEAST_WORDS, SIMILAR = 5, 50, 0.8
LEAST = LEAST_WORDS - SHINGLE + 1
HASHES = 4
#: Shingles of the context to one side; one of the two sides lies in the passage.
SIDE = LEAST // 2
#: Windows of one pair of documents belong to one region if their offsets differ by at most this.
DRIFT = 16
#: A window travels with at most this reach to either side. It exceeds LEAST,
#: and every LEAST shingles of a passage hold a window's place, so the windows
#: of a passage still cover it.
REACH = 255
#: Rows of the second meeting that leave a task together.
KEYS = 1 << 15
MIX = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def shingles(words: list[bytes]) -> np.ndarray:
    """Hashes of the runs of SHINGLE words, as many as start in the text."""
    if len(words) < SHINGLE:
        return np.zeros(0, np.uint64)
    w = np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)
    out = np.zeros(len(w) - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        out = out * STEP + w[k:len(out) + k]
    return out ^ out >> np.uint64(29)


def min_hash(x: np.ndarray, which: int) -> np.ndarray:
    h = (x + np.uint64((which + 1) * int(STEP) % 2**64)) * MIX
    h = (h ^ h >> np.uint64(32)) * MIX
    return h ^ h >> np.uint64(29)


def minima(key: np.ndarray, least: int) -> np.ndarray:
    """Smallest key of every run of ``least``."""
    low, width = key, 1
    while 2 * width <= least:
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    rest = least - width
    return np.minimum(low[:len(low) - rest], low[rest:]) if rest else low


def tree_bounds(keys: np.ndarray, places: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For nodes in order of place: how far each reaches to either side before
    a smaller key, within its document (``start`` to ``end``, exclusive).
    Blocks of 2^t nodes that hold no smaller key are passed, longest first."""
    n = len(keys)
    low = [keys]  # smallest key of 1, 2, 4... nodes, by the first
    while 2 << len(low) - 1 <= n:
        width = 1 << len(low) - 1
        low.append(np.minimum(low[-1][:-width], low[-1][width:]))
    before, after = np.arange(n), np.arange(1, n + 1)
    for t in range(len(low) - 1, -1, -1):
        width = 1 << t
        at = before - width
        before = np.where((at >= 0) & (low[t][np.maximum(at, 0)] > keys), at, before)
        free = (after + width <= n) & (low[t][np.minimum(after, n - width)] >= keys)
        after = np.where(free, after + width, after)
    left = np.where(before > 0, np.maximum(start, places[before - 1] + 1), start)
    right = np.where(after < n, np.minimum(end, places[np.minimum(after, n - 1)]), end) - 1
    return left, right


def compact_windows(docs: list[np.ndarray], which: int, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """(document, left, place, right, min-hash) of all windows of at least
    ``least`` shingles; places count within the document."""
    sizes = np.array([len(d) for d in docs])
    ends = np.cumsum(sizes)
    x = np.concatenate(docs) if docs else np.zeros(0, np.uint64)
    if len(x) < least:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    h = min_hash(x, which)
    key = h & np.uint64(0xFFFFFFFF00000000) | np.arange(len(x), dtype=np.uint64)
    doc_of = np.repeat(np.arange(len(docs)), sizes)
    low = minima(key, least)
    nodes = (low & np.uint64(0xFFFFFFFF))[doc_of[:len(low)] == doc_of[least - 1:]].astype(np.int64)
    nodes = nodes[sorted_runs(nodes)[:-1]]  # the place of a moving minimum never goes back
    d = doc_of[nodes]
    start = (ends - sizes)[d]
    left, right = tree_bounds(key[nodes], nodes, start, ends[d])
    return d, left - start, nodes - start, right - start, h[nodes].view(np.int64)


def _windows(batches):
    for b in batches:
        ids, texts = b.column(0), b.column(1).to_pylist()
        for i, j in slices(texts):
            docs = [shingles(words_of(t)) for t in texts[i:j]]
            docs = [d if len(d) >= LEAST else d[:0] for d in docs]
            for which in range(HASHES):
                d, left, place, right, h = compact_windows(docs, which)
                packed = place << 16 | np.minimum(place - left, REACH) << 8 | np.minimum(right - place, REACH)
                yield pa.RecordBatch.from_arrays([pa.array(h & np.int64(-HASHES) | which), ids.take(pa.array(d + i)), pa.array(packed)], ["sig", "doc", "w"])


def _first_holders(batches):
    """Rows (sig, doc, w), sorted -> (sig, b, a, w, aw, rank, more): all but
    the first of each sig with that first one, and their number from it;
    ``more`` is false only where a sig is known to have just two rows."""
    held = None  # sig, doc, w and rows so far of the last sig
    for t in batches:
        if not len(t):
            continue
        sig, doc, w = (c.to_numpy() for c in t.columns)
        bounds = sorted_runs(sig)
        sizes = np.diff(bounds)
        a, aw = np.repeat(doc[bounds[:-1]], sizes), np.repeat(w[bounds[:-1]], sizes)
        rank = np.arange(len(sig)) - np.repeat(bounds[:-1], sizes)
        if held and held[0] == sig[0]:
            a[:sizes[0]], aw[:sizes[0]] = held[1], held[2]
            rank[:sizes[0]] += held[3]
        more = np.repeat(rank[bounds[1:] - 1] > 1, sizes)
        more[bounds[-2]:] = True  # the next batch may go on with it
        held = sig[-1], a[-1], aw[-1], rank[-1] + 1
        k = np.flatnonzero(rank > 0)
        yield pa.RecordBatch.from_arrays([pa.array(x[k]) for x in (sig, doc, a, w, aw, rank, more)], ["sig", "b", "a", "w", "aw", "rank", "more"])


def run_hashes(x: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Hashes of the runs of ``least`` shingles, by the place of their first."""
    n = len(x) - least + 1
    out, done = np.zeros(n, np.uint64), 0
    part, width, power = x, 1, int(STEP)  # sums over runs of 1, 2, 4... by the place of their first
    while True:
        if least & width:
            out = out * np.uint64(power) + part[done:done + n]
            done += width
        if done == least:
            return out ^ out >> np.uint64(29)
        part = part[:-width] * np.uint64(power) + part[width:]
        width, power = 2 * width, power * power % 2**64


def open_keys(x: np.ndarray, sigs: np.ndarray, ws: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, w) by which the open windows of one document meet again."""
    place, left, right = ws >> 16, ws >> 8 & 255, ws & 255
    own = sigs % HASHES == 0  # every run has its minimum in a window of the first hash
    lo, hi = place - np.minimum(left, LEAST - 1), np.minimum(place, place + right - LEAST + 1)
    sizes = np.maximum(hi - lo + 1, 0)[own]
    start = (np.repeat(lo[own], sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    start = np.unique(start[(start >= 0) & (start <= len(x) - LEAST)])
    keys, out = [run_hashes(x)[start]], [start << 16 | LEAST - 1]
    low = minima(min_hash(x, 0), SIDE)
    for at, salt in ((place - SIDE, 1), (place + 1, 2)):
        k = np.flatnonzero((at >= 0) & (at < len(low)))
        keys.append(min_hash(sigs[k].view(np.uint64) * STEP + low[at[k]], salt))
        out.append(ws[k])
    return np.concatenate(keys).view(np.int64), np.concatenate(out)


def _open_keys(batches):
    """Rows (doc, windows, text) -> (sig, doc, w) of the second meeting."""
    held, size = [], 0
    for b in batches:
        for doc, windows, text in zip(*(c for c in b.columns), strict=True):
            x = shingles(words_of(text.as_py()))
            if len(x) < LEAST:  # of another row with this doc_id
                continue
            at = windows.values
            key, w = open_keys(x, at.field("sig").to_numpy(), at.field("w").to_numpy())
            held.append((key, np.full(len(key), doc.as_py()), w))
            size += len(key)
            if size >= KEYS:
                yield _key_batch(held)
                held, size = [], 0
    if held:
        yield _key_batch(held)


def _key_batch(held) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], ["sig", "doc", "w"])


def _regions(batches):
    """Aligned windows sorted by (b, a, place in b) -> regions of both
    documents; windows join while they overlap at about the same offset."""
    pair, open_ = None, []
    for batch in batches:
        if not len(batch):
            continue
        out = []
        b, a, w, aw = (c.to_numpy() for c in batch.columns)
        bm, off = w >> 16, (w >> 16) - (aw >> 16)
        lo, hi = bm - np.minimum(w >> 8 & 255, aw >> 8 & 255), bm + np.minimum(w & 255, aw & 255)
        rows = [c.tolist() for c in (bm - (w >> 8 & 255), lo, hi, off, lo - off, hi - off)]
        # a run: each window would join the region that the one before it has just joined or begun
        same = (b[1:] == b[:-1]) & (a[1:] == a[:-1])
        starts = np.flatnonzero(np.concatenate([[True], ~(same & (np.abs(off[1:] - off[:-1]) <= DRIFT) & (lo[1:] <= hi[:-1] + 1) & (hi[1:] >= lo[:-1] - 1))]))
        ends = np.append(starts[1:], len(b))
        runs = [c.tolist() for c in (b[starts], a[starts], starts, ends, np.minimum.reduceat(lo, starts), np.maximum.reduceat(hi, starts), off[ends - 1],
                                     np.minimum.reduceat(lo - off, starts), np.maximum.reduceat(hi - off, starts))]
        for b_, a_, i, j, *whole in zip(*runs, strict=True):
            if (b_, a_) != pair:
                out += open_
                pair, open_ = (b_, a_), []
            for k in range(i, j):
                at, open_ = _joined(open_, *(c[k] for c in rows), out, b_, a_)
                if k == i and at == len(open_) - 1:  # the newest region is tried first: the whole run joins it
                    g = open_[at]
                    g[2], g[3], g[5], g[6] = min(g[2], whole[0]), max(g[3], whole[1]), min(g[5], whole[3]), max(g[6], whole[4])
                    g[4] = whole[2]
                    break
        yield _region_batch(out)
    yield _region_batch(open_)


def _joined(open_, bl, lo, hi, off, a_lo, a_hi, out, b, a):
    """The newest region that a window joins, or a new one: its number, and the
    open regions."""
    for k in range(len(open_) - 1, -1, -1):
        g = open_[k]
        if abs(g[4] - off) <= DRIFT and lo <= g[3] + 1 and hi >= g[2] - 1:
            g[2], g[3], g[5], g[6] = min(g[2], lo), max(g[3], hi), min(g[5], a_lo), max(g[6], a_hi)
            g[4] = off
            return k, open_
    if len(open_) > 64:
        done = [g for g in open_ if g[3] < bl - 1]
        if done:  # those that no later window can reach
            out += done
            open_ = [g for g in open_ if g[3] >= bl - 1]
    open_.append([b, a, lo, hi, off, a_lo, a_hi])
    return len(open_) - 1, open_


def _region_batch(rows) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 7
    names = ["b", "a", "b_from", "b_to", "a_from", "a_to"]
    return pa.RecordBatch.from_arrays([pa.array(cols[k], pa.int64()) for k in (0, 1, 2, 3, 5, 6)], names)


def similar_stretches(x: np.ndarray, y: np.ndarray, least: int = LEAST, similar: float = SIMILAR) -> list[tuple[int, int, int, int]]:
    """(from, to, from, to), ends inclusive, in x and y: stretches of at least
    ``least`` shingles on both sides with Jaccard similarity >= ``similar``,
    starting and ending on shared shingles. Starts from the stretches between
    long gaps and divides those that are not similar at their longest gap."""
    uniq, first, of = np.unique(y, return_index=True, return_inverse=True)
    at = np.minimum(np.searchsorted(uniq, x), len(uniq) - 1)
    hit = uniq[at] == x
    hits = np.flatnonzero(hit)
    todo, found = [hits], []
    while todo:
        h = todo.pop()
        if len(h) < similar * least / (1 + similar) or h[-1] - h[0] + 1 < least:
            continue
        gaps = h[1:] - h[:-1]
        widest = int(gaps.argmax()) if len(gaps) else 0
        if len(gaps) and gaps[widest] > least // 4 + 1:
            cuts = np.flatnonzero(gaps > least // 4 + 1) + 1
            todo += np.split(h, cuts)
            continue
        s, e = int(h[0]), int(h[-1])
        here = np.zeros(len(uniq), bool)  # the shingles of y that the stretch holds
        here[at[h]] = True
        size = np.count_nonzero(here)
        if len(h) < e - s + 1:
            size += len(np.unique(x[s:e + 1][~hit[s:e + 1]]))
        off = np.sort(h - first[at[h]])
        off = int((off[(len(off) - 1) // 2] + off[len(off) // 2]) / 2)
        shared = here[of]
        for lo, hi in ((s - off - DRIFT, e - off + DRIFT + 1), (s - DRIFT, e + DRIFT + 1), (0, len(y))):  # where most hits lie, the region's own alignment, all
            lo, hi = max(0, lo), min(len(y), hi)
            match = lo + np.flatnonzero(shared[lo:hi])
            if len(match) and match[-1] - match[0] + 1 >= least:
                other = np.zeros(len(uniq), bool)
                other[of[match[0]:match[-1] + 1]] = True
                both = np.count_nonzero(here & other)
                if both >= similar * (size + np.count_nonzero(other) - both):
                    found.append((s, e, int(match[0]), int(match[-1])))
                    break
        else:
            lo = None
        if lo is not None:
            continue
        if len(gaps) and gaps[widest] > 1:
            todo += [h[:widest + 1], h[widest + 1:]]
    return found


def _with_source(batches):
    """Regions with the text of a -> regions with a's words."""
    last, x = None, []
    for b in batches:
        out = []
        cols = [c.to_pylist() for c in b.columns]
        for k, text in enumerate(cols[6]):
            if text is not last and text != last:
                last, x = text, words_of(text)
            out.append(b" ".join(x[max(0, cols[4][k]):cols[5][k] + SHINGLE]))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), b.column(4), pa.array(out, pa.binary())], ["b", "a", "b_from", "b_to", "a_from", "source"])


def _verified(batches):
    """Regions with a's words and the text of b -> passages of b and of a."""
    last, words, x, seen = None, [], None, 0
    for batch in batches:
        out = []
        cols = [c.to_pylist() for c in batch.columns]
        for b, a, b_from, b_to, a_from, source, text in zip(*cols, strict=True):
            if text is not last and text != last:
                last, words, x, seen = text, words_of(text), None, 0
            b_from, a_from = max(0, b_from), max(0, a_from)
            seen += b_to + 1 - b_from
            if x is None and seen > len(words):  # its regions ask for more than the whole text
                x = shingles(words)
            mine = shingles(words[b_from:b_to + SHINGLE]) if x is None else x[b_from:b_to + 1]
            other = shingles(source.split())
            if not len(mine) or not len(other):
                continue
            for s, e, s2, e2 in similar_stretches(mine, other):
                out.append((b, b_from + s, b_from + e + SHINGLE, a, False))
                out.append((a, a_from + s2, a_from + e2 + SHINGLE, a, True))
        cols = list(zip(*out, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "start_word", "end_word", "source_doc_id", "kept"])


def _united(batches):
    """Passages sorted by (document, kept, start) -> their unions."""
    held = None
    for b in batches:
        out = []
        for doc, kept, start, end, source in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if held and held[:2] == [doc, kept] and start <= held[3]:
                held[3], held[4] = max(held[3], end), min(held[4], source)
            else:
                if held:
                    out.append(held)
                held = [doc, kept, start, end, source]
        yield _united_batch(out)
    yield _united_batch([held] if held else [])


def _united_batch(rows) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 5
    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "kept", "start_word", "end_word", "source_doc_id"])


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kept, start_word, end_word (exclusive), source_doc_id: the
    stretches of words that repeat across documents. ``kept`` is false where a
    smaller doc_id, such as source_doc_id, has the passage, and true where
    larger ones repeat it; overlapping stretches of a kind are united."""
    d = ids_and_text(docs, id_col, text_col).where("doc_id is not null")
    met = written(_met(d.mapInArrow(_windows, "sig long, doc long, w long")))
    passages = _passages(met, d)
    spans = _unions(passages.where("not kept")).groupBy(F.col("doc_id").alias("b")).agg(F.collect_list(F.struct("start_word", "end_word")).alias("spans"))
    some = met.where("more")
    covered = F.expr(f"exists(spans, s -> s.start_word <= shiftright(w, 16) - least(shiftright(w, 8) & 255, {LEAST - 1})"
                     f" and s.end_word >= shiftright(w, 16) + least(w & 255, {LEAST - 1}) + {SHINGLE})")
    open_ = some.where("a <> b").join(spans, "b", "left").where(F.col("spans").isNull() | ~covered).select(F.col("sig").alias("open_sig")).distinct()
    again = some.join(open_, F.col("sig") == F.col("open_sig"))
    again = again.select("sig", F.col("b").alias("id"), "w").unionByName(again.where("rank = 1").select("sig", F.col("a").alias("id"), F.col("aw").alias("w")))
    again = again.groupBy("id").agg(F.collect_list(F.struct("sig", "w")).alias("windows")).join(d, F.col("doc_id") == F.col("id"))
    keyed = again.select("doc_id", "windows", "text").mapInArrow(_open_keys, "sig long, doc long, w long")
    return _unions(passages.unionByName(_passages(_met(keyed), d)))


def _met(windows: DataFrame) -> DataFrame:
    return windows.repartition(parallelism(windows.sparkSession), "sig").sortWithinPartitions("sig", "doc", "w").mapInArrow(
        _first_holders, "sig long, b long, a long, w long, aw long, rank long, more boolean")


def _passages(met: DataFrame, d: DataFrame) -> DataFrame:
    """The verified passages of the documents whose windows met."""
    n = parallelism(met.sparkSession)
    met = met.where("a <> b").select("b", "a", "w", "aw")
    regions = cut(met.repartition(n, "b").sortWithinPartitions("b", "a", "w", "aw").mapInArrow(
        _regions, "b long, a long, b_from long, b_to long, a_from long, a_to long").where(F.col("b_to") - F.col("b_from") + 1 >= LEAST))
    texts = d.withColumnRenamed("doc_id", "id")
    sourced = regions.join(texts, F.col("a") == F.col("id")).select("b", "a", "b_from", "b_to", "a_from", "a_to", "text").mapInArrow(
        _with_source, "b long, a long, b_from long, b_to long, a_from long, source binary")
    return cut(sourced.join(texts, F.col("b") == F.col("id")).select("b", "a", "b_from", "b_to", "a_from", "source", "text").mapInArrow(
        _verified, "doc_id long, start_word long, end_word long, source_doc_id long, kept boolean").distinct())


def _unions(passages: DataFrame) -> DataFrame:
    n = parallelism(passages.sparkSession)
    return (passages.select("doc_id", "kept", "start_word", "end_word", "source_doc_id").repartition(n, "doc_id")
            .sortWithinPartitions("doc_id", "kept", "start_word").mapInArrow(_united, "doc_id long, kept boolean, start_word long, end_word long, source_doc_id long"))


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans and the blanks after them."""
    data = text.encode("utf-8", "surrogatepass")
    codes = np.frombuffer(data, np.uint8)
    solid = ~((codes == 32) | (codes >= 9) & (codes <= 13))
    starts = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= len(starts):
            break
        out.append(data[at:max(at, starts[s])])
        at = max(at, int(starts[e]) if e < len(starts) else len(data))
    return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, without the words of passages that a
    smaller doc_id keeps; a row left without words goes."""
    spans = (repeated_passages(docs, id_col, text_col).where("not kept").groupBy(F.col("doc_id").alias("span_id"))
             .agg(F.collect_list(F.struct("start_word", "end_word")).alias("spans")))

    @F.udf("string")
    def rest(text, spans):  # also called, with nulls, for rows without spans
        return None if text is None or spans is None else without_words(text, [tuple(s) for s in spans])
    row = docs.select(F.struct("*").alias("row"))
    joined = row.join(spans, F.col(f"row.{id_col}").cast("long") == F.col("span_id"), "left")
    text = F.when(F.col("spans").isNull(), F.col(f"row.{text_col}")).otherwise(
        rest(F.when(F.col("spans").isNotNull(), F.col(f"row.{text_col}")), F.col("spans")))
    joined = joined.withColumn("text", text).where("spans is null or text rlike '[^\\x20\\x09-\\x0D]'")
    renewed = {text_col: F.col("text"), "n_chars": F.when(F.col("spans").isNull(), F.col("row.n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else None}
    return joined.select(*[(renewed.get(c) if renewed.get(c) is not None else F.col("row").getField(c)).alias(c) for c in docs.columns])


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))
