"""Importance resampling toward a target corpus by bit-sliced aggregation.

Texts are bags of hashed word runs. A bucket's gain is the log ratio of its
share in the target's texts to its share in the documents', as a whole number.
Documents are weighed by bit planes: plane k of a document holds bit k of every
bucket's count, plane j of the gains bit j of every gain (two's complement, so
the highest plane counts negative). The weight is the sum over all pairs of
planes of popcount(count plane AND gain plane) * 2^(k+j), exact in whole
numbers. Drawing without replacement takes the highest of weight plus seeded
Gumbel noise.

One pass over the documents counts the buckets (each task sends one row per
bucket), a second one weighs them; the gains, one number per bucket, are all
that is collected or sent out. Ranks come from ``operators.skew.numbered``,
so no task holds all scores.

Defined results: a null or wordless text has no features and weight 0; a null
id is noised as the empty text; rows that repeat an id are rows of their own
(equal scores and ids: in any order); without target texts every gain follows
from t = T = 0; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm.common import table, written
from patronage.operators.skew import numbered

BUCKETS, LONGEST_RUN = 10_000, 3
SCALE, PERCENT, SEED, FEWEST_WORDS = 1000, 5, 42, 20
#: Rows whose planes are held at once, and bytes of text read into features at once.
ROWS, SLICE_BYTES = 256, 1 << 20

#: A-Z to lower case; every byte that is no letter, digit or part of a longer character to a blank.
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                for b in range(256))


def features(texts: list[bytes | None], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text; then, for every run of one to three words of a text,
    the text's index and the run's bucket. The hash of a longer run goes on
    from the shorter one's."""
    words = [t.translate(LETTERS).split() if t else [] for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    flat = list(chain.from_iterable(words))
    owner = np.repeat(np.arange(len(texts)), counts)
    after = [b" " + w for w in flat]
    hashes, owners, last = [], [], list(map(crc32, flat))
    for k in range(LONGEST_RUN):
        if k:
            last = list(map(crc32, after[k:], last))
        whole = owner[k:] == owner[:len(owner) - k]
        hashes.append(np.fromiter(last, np.uint32, len(last))[whole] % buckets)
        owners.append(owner[k:][whole])
    return counts, np.concatenate(owners), np.concatenate(hashes).astype(np.int64)


def _slices(sizes: np.ndarray, rows: int):
    """Ranges of rows, at most ``rows`` and about ``SLICE_BYTES`` bytes each."""
    start = size = 0
    for i, n in enumerate(sizes):
        size += n
        if size >= SLICE_BYTES or i + 1 - start >= rows:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all rows."""
    def run(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            column = b.column(0)
            sizes = pa.compute.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
            for i, j in _slices(sizes, 1 << 14):
                total += np.bincount(features(column.slice(i, j - i).to_pylist(), buckets)[2], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])
    return (texts.select(F.col(text_col).cast("binary")).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def _vector(counts: DataFrame, buckets: int) -> np.ndarray:
    out = np.zeros(buckets, np.int64)
    for bucket, n in counts.collect():  # at most one row per bucket
        out[bucket] = n
    return out


def gains(docs: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * ln(((t+1)(S+B)) / ((s+1)(T+B)))) per bucket, in doubles."""
    big, small = int(docs.sum()) + len(docs), int(target.sum()) + len(docs)
    return np.array([math.floor(scale * math.log((t + 1.0) * big / ((s + 1.0) * small)))
                     for s, t in zip(docs.tolist(), target.tolist())], np.int64)


def planes(rows: np.ndarray, buckets: np.ndarray, n_rows: int, n_buckets: int) -> np.ndarray:
    """Bit planes of ``n_rows`` rows in words of 64: the named bits are set."""
    bits = np.zeros((n_rows, -(-n_buckets // 64) * 64), bool)
    bits[rows, buckets] = True
    return np.packbits(bits, axis=1).view(np.uint64)


def gain_planes(gain: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Planes of two's complement and the value of each."""
    size = max(int(gain.max(initial=0)).bit_length(), int(-gain.min(initial=0) - 1).bit_length() if len(gain) and gain.min() < 0 else 0)
    coded = gain & ((1 << size + 1) - 1)
    rows, cols = np.nonzero(coded[None, :] >> np.arange(size + 1)[:, None] & 1)
    return planes(rows, cols, size + 1, len(gain)), [1 << j for j in range(size)] + [-(1 << size)]


def weigh(owner: np.ndarray, bucket: np.ndarray, n_rows: int, gain: np.ndarray,
          of_gains: tuple[np.ndarray, list[int]]) -> np.ndarray:
    """Sum of the gains of each row's features, by bit planes."""
    held, count = np.unique(owner * len(gain) + bucket, return_counts=True)
    rows, cols = held // len(gain), held % len(gain)
    weight = np.zeros(n_rows, np.int64)
    for k in range(int(count.max(initial=0)).bit_length()):
        bit = (count >> k & 1).astype(bool)
        present, at = np.unique(rows[bit], return_inverse=True)
        plane = planes(at, cols[bit], len(present), len(gain))
        part = np.zeros(len(present), np.int64)
        for mask, value in zip(*of_gains):
            part += np.bitwise_count(plane & mask).sum(axis=1, dtype=np.int64) * value
        weight[present] += part << k
    return weight


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight of every row."""
    def run(batches):
        of_gains = gain_planes(gain)
        for b in batches:
            ids, column = b.column(0), b.column(1)
            sizes = pa.compute.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
            for i, j in _slices(sizes, ROWS):
                words, owner, bucket = features(column.slice(i, j - i).to_pylist(), len(gain))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(words), pa.array(np.bincount(owner, minlength=j - i)),
                     pa.array(weigh(owner, bucket, j - i, gain, of_gains))], ["doc_id", "n_words", "n_features", "weight"])
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary"))
            .mapInArrow(run, "doc_id long, n_words long, n_features long, weight long"))


def gumbel(doc_id: Column, seed: int = SEED, scale: int = SCALE) -> Column:
    """Whole-numbered noise that only the seed and the id decide."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             percent: int = PERCENT, fewest_words: int = FEWEST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank, n_words: every row; ``rank``
    (from 1) for the drawn ones, ``percent`` of those with enough words."""
    gain = gains(_vector(bucket_counts(docs, text_col), BUCKETS), _vector(bucket_counts(target, target_text), BUCKETS))
    scored = written(weights(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)))
    enough = F.col("n_words") >= fewest_words
    quota = percent * scored.where(enough).count() // 100
    placed = numbered(scored.where(enough).withColumn("falling", -F.col("score")), None, ["falling", "doc_id"], "place")
    cols = ["doc_id", "n_features", "weight", "score"]
    return (placed.select(*cols, F.when(F.col("place") <= quota, F.col("place")).alias("rank"), "n_words")
            .unionByName(scored.where(~enough).select(*cols, F.lit(None).cast("long").alias("rank"), "n_words")))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
