"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes, held as a table of
(context + symbol) grams with their counts over all training documents. A
symbol is coded in the longest context that has seen it; each shorter step
costs an escape (estimated from the number of different symbols of the
context), and symbols the longer context offered are excluded from the shorter
one's counts. A probability depends on the last ORDER bytes only, so it is
computed once per gram, in groups that share the last two context bytes; the
two shortest orders are at most 65,536 rows and are the only thing broadcast.

Documents are dealt to buckets, parts of one input file where there are files.
A first pass lists each bucket's distinct grams and words with their training
counts; these are summed over all buckets, and every value goes back to the
buckets that listed its key, packed into blocks. The documents then meet the
values of their bucket: they move once, and no task ever holds the whole model.

A text is coded as its lower-cased words with single blanks between and one
end; a null or blank text is the end alone. Without training documents every
gram falls to the uniform distribution and every base score to log10(0.1/0.1).
"""

from __future__ import annotations

from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm.common import binary_array, ids_and_text, parallelism, slices, sorted_runs, table, words_of, written

ORDER = 5
#: Text of a bucket, in bytes, where a file holds more.
BUCKET_BYTES = 32 << 20
END = b"\n"
NO_WORD = b""
#: Characters coded at a time; keys a task lists before it passes them on; rows of a block; rows scored at a time.
SLICE, HELD_KEYS, BLOCK_ROWS, LEAST_ROWS = 1 << 20, 1_500_000, 1 << 19, 1 << 17


def coded(text: str) -> tuple[list[bytes], bytes]:
    words = words_of(text)
    return words, b" ".join(words) + END


def grams_of(lines: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The gram (``order`` bytes before, then the byte; big-endian in a word)
    at every byte of every line, and where each line starts. The context
    before a line is ends."""
    pad = END * order
    data = np.frombuffer(pad + pad.join(lines), np.uint8)
    code = np.zeros(len(data) - order, np.uint64)
    for j in range(order + 1):
        code = code << np.uint64(8) | data[j:len(data) - order + j]
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    real = np.ones(len(code), bool)
    gaps = (starts + order * np.arange(len(lines)))[1:]
    for k in range(1, order + 1):
        real[gaps - k] = False
    return code[real], starts


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = sorted_runs(keys)[:-1]
    return keys[starts], np.add.reduceat(counts, starts) if len(keys) else counts


def _inventory(order: int):
    """Per bucket: each gram and each word with its count in training documents
    (0 where only other documents have it)."""
    def rows(b, grams, counts, words):
        n, m = len(grams), len(words)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(n + m, b, np.int32)), pa.concat_arrays([pa.array(grams.view(np.int64)), pa.nulls(m, pa.int64())]),
            pa.concat_arrays([pa.nulls(n, pa.binary()), binary_array(list(words))]),
            pa.concat_arrays([pa.array(counts), pa.array(list(words.values()), pa.int64())])], ["b", "gram", "word", "n"])

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            texts = batch.column(1).to_pylist()
            train = batch.column(2).to_numpy(zero_copy_only=False)
            bucket = batch.column(3).to_numpy()
            for b in np.unique(bucket).tolist():
                mine = np.flatnonzero(bucket == b).tolist()
                some = [texts[k] for k in mine]
                for i, j in slices(some, SLICE):
                    pairs = [coded(t) for t in some[i:j]]
                    grams, counts, words = held.setdefault(b, [np.zeros(0, np.uint64), np.zeros(0, np.int64), Counter()])
                    for on in (True, False):
                        group = [p for p, k in zip(pairs, mine[i:j], strict=True) if train[k] == on]
                        if not group:
                            continue
                        u, c = np.unique(grams_of([x[1] for x in group], order)[0], return_counts=True)
                        grams, counts = merged(np.concatenate([grams, u]), np.concatenate([counts, c if on else np.zeros_like(c)]))
                        for w, _ in group:
                            if on:
                                words.update(w)
                            else:
                                for x in w:
                                    words.setdefault(x, 0)
                        words[NO_WORD] += len(group) if on else 0
                    held[b] = [grams, counts, words]
                    if sum(len(x[0]) + len(x[2]) for x in held.values()) > HELD_KEYS:
                        for k, x in held.items():
                            yield rows(k, *x)
                        held = {}
        for k, x in held.items():
            yield rows(k, *x)
    return run


def gram_log10(codes: np.ndarray, counts: np.ndarray, order: int, pairs: np.ndarray) -> np.ndarray:
    """log10 probability of each gram. ``codes`` holds every gram of the
    contexts that share their last two bytes, ``pairs`` the counts of all
    (byte, symbol) pairs as a 256 x 256 table."""
    logp, done = np.zeros(len(codes)), np.zeros(len(codes), bool)
    inner_n, excluded = np.zeros(len(codes)), None  # of the longer context: its symbols, and which grams it has seen
    for k in range(order, -1, -1):
        if k >= 2:
            key, at = np.unique(codes & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
            c = np.bincount(at, weights=counts, minlength=len(key))
            ctx, of = np.unique(key >> np.uint64(8), return_inverse=True)
            total = np.bincount(of, weights=c, minlength=len(ctx))
            kinds = np.bincount(of, weights=c > 0, minlength=len(ctx))
            own, all_n, all_kinds = c[at], total[of][at], kinds[of][at]
        else:
            symbol, before = (codes & np.uint64(255)).astype(np.int64), (codes >> np.uint64(8) & np.uint64(255)).astype(np.int64)
            grid = pairs if k else pairs.sum(axis=0, keepdims=True)
            row = before if k else np.zeros_like(before)
            own, all_n, all_kinds = grid[row, symbol].astype(float), grid.sum(axis=1)[row].astype(float), (grid > 0).sum(axis=1)[row].astype(float)
        if excluded is None:
            gone = np.zeros(len(codes))
        else:  # counts here of the symbols that the longer context has seen
            keys, seen, which = excluded
            if k >= 2:
                low = np.searchsorted(key, keys & np.uint64((1 << 8 * (k + 1)) - 1))
                here = c[low]
            else:
                here = grid[(keys >> np.uint64(8) & np.uint64(255)).astype(np.int64) if k else 0, (keys & np.uint64(255)).astype(np.int64)]
            gone = np.bincount(which[0], weights=here * seen, minlength=which[2])[which[1]]
        new = all_kinds - inner_n
        if k == 0:
            new[all_kinds == 256] = 0  # nothing is left to escape to
        whole = all_n - gone + new
        hit = ~done & (own > 0)
        logp[hit] += np.log10(own[hit] / whole[hit])
        done |= hit
        out = ~done & (new > 0)
        logp[out] += np.log10(new[out] / whole[out])
        inner_n = all_kinds
        if k >= 2:
            excluded = (key, c > 0, (of, of[at], len(ctx)))
        elif k == 1:
            used, of = np.unique(before, return_inverse=True)
            every = (np.repeat(used, 256) << 8 | np.tile(np.arange(256), len(used))).astype(np.uint64)
            excluded = (every, grid[np.repeat(used, 256), np.tile(np.arange(256), len(used))] > 0, (np.repeat(np.arange(len(used)), 256), of, len(used)))
    left = ~done
    logp[left] -= np.log10(256 - inner_n[left])
    return logp


def _blocks(b: np.ndarray, keys: pa.Array, values: np.ndarray) -> pa.RecordBatch:
    """Rows grouped by bucket into (b, Arrow stream of keys and values)."""
    by = np.argsort(b, kind="stable")
    bounds = sorted_runs(b[by])
    packed = []
    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        part = pa.RecordBatch.from_arrays([keys.take(pa.array(by[i:j])), pa.array(values[by[i:j]])], ["key", "value"])
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(part)
        packed.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(b[by][bounds[:-1]] if len(b) else [], pa.int32()), binary_array(packed)], ["b", "block"])


def _unpacked(blocks: list[bytes], kind: pa.DataType) -> tuple[pa.Array, np.ndarray]:
    parts = [pa.ipc.open_stream(x).read_all() for x in blocks]
    parts = [t for t in parts if t.schema.field("key").type == kind]
    if not parts:
        return pa.array([], kind), np.zeros(0)
    whole = pa.concat_tables(parts).combine_chunks()
    return whole.column("key").chunk(0), whole.column("value").to_numpy()


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and the row that each belongs to."""
    lengths = np.diff(lists.offsets.to_numpy())
    return lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), lengths)


def _gram_scores(order: int, pairs):
    """Runs of grams with the same last two context bytes, sorted by them, with
    the buckets that hold each -> blocks of values."""
    def scored(t: pa.Table):
        tail, codes, counts = (t.column(k).to_numpy() for k in range(3))
        bounds = sorted_runs(tail)
        logp = np.concatenate([gram_log10(codes[a:b].view(np.uint64), counts[a:b], order, pairs.value) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
        b, row = _flat(t.column(3).combine_chunks())
        for i in range(0, len(b), BLOCK_ROWS):
            part = row[i:i + BLOCK_ROWS]
            yield _blocks(b[i:i + BLOCK_ROWS], pa.array(codes[part]), logp[part])

    def run(batches):
        held = None
        for b in batches:
            if not len(b):
                continue
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            tail = held.column(0).to_numpy()
            last = int(np.searchsorted(tail, tail[-1]))
            if last and len(held) >= LEAST_ROWS:
                yield from scored(held.slice(0, last).combine_chunks())
                held = held.slice(last).combine_chunks()
        if held is not None:
            yield from scored(held.combine_chunks())
    return run


def _word_counts(batches):
    """(word, n, buckets) -> blocks of counts."""
    for batch in batches:
        b, row = _flat(batch.column(2))
        words, n = batch.column(0), batch.column(1).to_numpy().astype(np.float64)
        for i in range(0, len(b), BLOCK_ROWS):
            part = row[i:i + BLOCK_ROWS]
            yield _blocks(b[i:i + BLOCK_ROWS], words.take(pa.array(part)), n[part])


def looked_up(keys: np.ndarray, values: np.ndarray, code: np.ndarray) -> np.ndarray:
    """The value of each code; every code is among the sorted ``keys``. Codes
    repeat, and searches in rising order stay near each other in memory."""
    some, at = np.unique(code, return_inverse=True)
    return values[np.searchsorted(keys, some)][at]


def _scores(order: int, n: int, v: int):
    """Scores of a bucket's documents from the blocks of its grams and words."""
    def run(docs, values):
        blocks = values.column("block").to_pylist()
        keys, gram_value = _unpacked(blocks, pa.int64())
        grams = keys.to_numpy().view(np.uint64)
        by = np.argsort(grams)
        grams, gram_value = grams[by], gram_value[by]
        keys, count = _unpacked(blocks, pa.binary())
        unseen = np.log10(0.1 / (n + 0.1 * (v + 1)))
        words = dict(zip(keys.to_pylist(), np.where(count > 0, np.log10((count + 0.1) / (n + 0.1 * (v + 1))), unseen).tolist(), strict=True))
        del blocks, keys, count, by
        texts = docs.column("text").to_pylist()
        tokens, known, base, score = [], [], [], []
        for i, j in slices(texts, SLICE):
            pairs = [coded(t) for t in texts[i:j]]
            code, starts = grams_of([x[1] for x in pairs], order)
            score.append(np.add.reduceat(looked_up(grams, gram_value, code), starts))
            for w, _ in pairs:
                c = np.fromiter(map(words.__getitem__, chain(w, [NO_WORD])), float, len(w) + 1)
                tokens.append(len(c))
                known.append(int(np.count_nonzero(c != unseen)))
                base.append(float(c.sum()))
        return pa.table({
            "doc_id": docs.column("doc_id"), "held_out": pa.array([not x for x in docs.column("train").to_pylist()], pa.bool_()),
            "n_tokens": pa.array(tokens, pa.int64()), "n_known": pa.array(known, pa.int64()),
            "base_score": pa.array(base, pa.float64()), "score": pa.array(np.concatenate(score) if score else [], pa.float64())})
    return run


def lm_scores(docs: DataFrame, train: str = "true", id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score:
    one row per document. ``train`` is a SQL condition on doc_id that says
    which documents the model learns from; the rest are held out."""
    if not 2 <= order <= 7:
        raise ValueError("order must be 2 to 7")
    spark = docs.sparkSession
    d = ids_and_text(docs, id_col, text_col).withColumn("train", F.coalesce(F.expr(train), F.lit(False)))
    d = d.withColumn("file", F.input_file_name())
    largest = d.groupBy("file").agg(F.sum(F.octet_length("text")).alias("size")).agg(F.max("size")).first()[0] or 0
    parts = max(1, -(-largest // BUCKET_BYTES))
    d = d.withColumn("b", F.hash("file", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))).select("doc_id", "text", "train", "b")
    listed = d.mapInArrow(_inventory(order), "b int, gram long, word binary, n long")
    keys = written(listed.repartition(parallelism(spark), "gram", "word").groupBy("gram", "word")
                   .agg(F.sum("n").alias("n"), F.collect_set("b").alias("at")))
    grams, words = keys.where("gram is not null"), keys.where("word is not null")
    pairs = np.zeros((256, 256), np.int64)
    for r in grams.groupBy(F.expr("gram & 65535").cast("int").alias("p")).agg(F.sum("n").alias("n")).collect():  # at most 65,536 rows
        pairs[r.p >> 8, r.p & 255] = r.n
    shared = spark.sparkContext.broadcast(pairs)
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    values = (grams.select(F.expr("shiftright(gram, 8) & 65535").alias("tail"), "gram", "n", "at")
              .repartition(parallelism(spark), "tail").sortWithinPartitions("tail")
              .mapInArrow(_gram_scores(order, shared), "b int, block binary")
              .unionByName(words.select("word", "n", "at").mapInArrow(_word_counts, "b int, block binary")))
    out = d.groupBy("b").cogroup(values.groupBy("b")).applyInArrow(
        _scores(order, *total), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(total[0]).cast("long"))


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_scores(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "crc32(coalesce(cast(doc_id as string), '')) % 10 <> 0")
