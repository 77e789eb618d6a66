"""Alignment of two tokenizations of a text by merge-path partitioning.

Both tokenizers cut the same bytes; merging the sorted token ends of the one
(A) with those of the other (B) shows which tokens overlap and where both end.
The merge is divided by diagonals: for every ``PIECE``-th step a binary search
finds how many ends of A and of B come before it, so pieces of equal work,
wherever the texts' lengths lie, are merged independently. A piece emits the
overlapping pairs of its steps; the group that is open at its border is closed
by the piece in which both ends meet, with the last end of A before the border.

Corpus counts: documents are dealt into buckets as they are read, each bucket
sends every id pair it holds once with its number of documents, and gets the
corpus-wide counts of its own pairs back; so a frequent pair costs one row a
bucket, not one a document. The highest count of an A id is one row per entry
of A's vocabulary, the only thing sent to all tasks.

Defined results: a null or empty text, and one whose A or B bytes are not the
space and the text, has no tokens, no groups and no links; a null id or a
repeated row is a document of its own; special tokens' strings are plain text.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from patronage.llm.common import binary_array, ids_and_text, slices, table, written
from patronage.llm.packing import byte_letters, plain_ids

A_NAME, B_NAME = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Steps of a merge piece, and links after which a task opens a new bucket.
PIECE, BUCKET_LINKS = 1 << 13, 1 << 21
#: Characters of text aligned at once.
SLICE = 1 << 18
SPACED = re.compile(" *[^ ]+| +")


class PieceIds(dict):
    """Spaces and the word after them -> ids of B. Its pieces hold a space at
    their start only, so texts fall apart before runs of spaces."""

    KEPT_CHARS, KEPT = 48, 200_000

    def __init__(self, path: str):
        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.blank = self.model.piece_to_id("▁")
        pieces = [self.model.id_to_piece(i) for i in range(self.model.piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path}: pieces with a space behind their start cannot be encoded word by word")
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else
                      b"" if self.model.is_control(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def __missing__(self, unit: str) -> list[int]:
        # the model puts a space before what it is given
        ids = self.model.encode(unit[1:], num_threads=1) if len(unit) > 1 else [self.blank]
        if len(unit) <= self.KEPT_CHARS:
            if len(self) >= self.KEPT:
                self.clear()
            self[unit] = ids
        return ids

    def text_ids(self, spaced: str) -> list[int]:
        out: list[int] = []
        for ids in map(self.__getitem__, SPACED.findall(spaced)):
            out += ids
        return out


@lru_cache(maxsize=2)
def piece_ids(path: str) -> PieceIds:
    return PieceIds(path)


@lru_cache(maxsize=2)
def a_bytes(path: str) -> list[bytes]:
    """Bytes of every entry of a byte-level vocabulary."""
    back = {c: b for b, c in byte_letters().items()}
    tokenizer = Tokenizer.from_file(path)
    out = []
    for i in range(tokenizer.get_vocab_size()):
        letters = tokenizer.id_to_token(i)
        out.append(bytes(map(back.__getitem__, letters)) if all(c in back for c in letters) else letters.encode())
    return out


def merge_path(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of ``a`` and of ``b`` (both rising) lie before every
    ``piece``-th step of their merge, in which an end of ``a`` goes before an
    equal end of ``b``. Each diagonal is searched for by itself."""
    steps = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while (low < high).any():
        open_ = low < high
        mid = (low + high) // 2
        before = np.zeros(len(steps), bool)
        before[open_] = a[mid[open_]] <= b[steps[open_] - 1 - mid[open_]]
        low, high = np.where(open_ & before, mid + 1, low), np.where(open_ & ~before, mid, high)
    return low, steps - low


def merge_piece(a: np.ndarray, b: np.ndarray, i: int, j: int, a_before: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of one piece, of which ``i`` ends of A and ``j`` of B come before
    it, the last of A at ``a_before``: overlapping tokens (index in A, index in
    B), and the ends of groups (tokens of A, tokens of B up to there)."""
    of_a = j + np.searchsorted(b, a, "left")
    up_to = np.searchsorted(a, b, "right")
    last = np.where(up_to > 0, a[np.maximum(up_to, 1) - 1], a_before) if len(a) else np.full(len(b), a_before)
    both = last == b
    at = np.arange(j, j + len(b))
    links = np.stack([np.concatenate([np.arange(i, i + len(a)), i + up_to[~both]]), np.concatenate([of_a, at[~both]])])
    return links[0], links[1], np.stack([i + up_to[both], at[both] + 1])


def align_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (index in A, index in B) and group ends (tokens of A, of B) of two
    rising arrays of token ends with the same last end."""
    if not len(a):
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    at_a, at_b = merge_path(a, b, piece)
    parts = [merge_piece(a[i:k], b[j:m], i, j, a[i - 1] if i else -1)
             for i, k, j, m in zip(at_a[:-1], at_a[1:], at_b[:-1], at_b[1:])]
    link_a, link_b = (np.concatenate([p[n] for p in parts]) for n in (0, 1))
    order = np.argsort(link_a, kind="stable")
    ends = np.concatenate([p[2] for p in parts], axis=1)
    return link_a[order], link_b[order], ends[0], ends[1]


@lru_cache(maxsize=2)
def _written_ids(size: int) -> list[list[str]]:
    """Ids in decimal with each of the signs that may follow."""
    return [[f"{i}{sign}" for i in range(size)] for sign in ",|;"]


def group_texts(a_ids: np.ndarray, b_ids: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> list[str]:
    """The ids in group order, A's before B's, each with the sign after it:
    a comma within, a bar between A and B, a semicolon after the group."""
    signs = _written_ids(1 << 16)
    after_a, after_b = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
    after_a[ends_a - 1], after_b[ends_b - 1] = 1, 2
    group_a = np.cumsum(after_a > 0) - (after_a > 0)
    group_b = np.cumsum(after_b > 0) - (after_b > 0)
    # place of each id: its own index and the other side's ids of the groups before (B: and of its own)
    place_a = np.arange(len(a_ids)) + np.append(0, ends_b)[group_a]
    place_b = np.arange(len(b_ids)) + ends_a[group_b]
    ids, sign = np.empty(len(a_ids) + len(b_ids), np.int64), np.empty(len(a_ids) + len(b_ids), np.int64)
    ids[place_a], ids[place_b] = a_ids, b_ids
    sign[place_a], sign[place_b] = after_a, after_b
    return [signs[s][i] for s, i in zip(sign.tolist(), ids.tolist())]


FIELDS = {
    "a_ids": "binary", "b_ids": "binary", "a_group_ends": "binary", "b_group_ends": "binary", "link_a": "binary", "link_b": "binary",
    "pairs": "binary", "pair_links": "binary", "groups_sha256": "string"}


def _aligned(a_path: str, b_path: str, fields: list[str]):
    def run(batches):
        in_a, in_b = plain_ids(a_path), piece_ids(b_path)
        size_a = np.array([len(t) for t in a_bytes(a_path)])
        size_b, bytes_b = np.array([len(t) for t in in_b.bytes]), in_b.bytes
        vocabulary = len(size_b)
        task = TaskContext.get()
        bucket, held = (task.partitionId() if task else 0) << 33, 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for i, j in slices(texts, SLICE):
                a_parts, b_parts = [], []
                for text in texts[i:j]:
                    spaced = " " + text
                    b = in_b.text_ids(spaced) if text else []
                    if b and b"".join(map(bytes_b.__getitem__, b)) != spaced.encode("utf-8", "surrogatepass"):
                        b = []
                    a_parts.append(np.frombuffer(in_a(spaced) if b else b"", np.uint32))
                    b_parts.append(np.array(b, np.uint32))
                n_a, n_b = (np.array([len(x) for x in parts]) for parts in (a_parts, b_parts))
                a, b = np.concatenate(a_parts), np.concatenate(b_parts)
                # ends over all texts of the slice, one after the other: every text's end is an end of both
                link_a, link_b, ends_a, ends_b = align_ends(np.cumsum(size_a[a]), np.cumsum(size_b[b]))
                to_a, to_b = np.append(0, np.cumsum(n_a)), np.append(0, np.cumsum(n_b))
                to_group, to_link = np.searchsorted(ends_a, to_a, "right"), np.searchsorted(link_a, to_a, "left")
                pairs = a[link_a].astype(np.uint32) * np.uint32(vocabulary) + b[link_b]
                texts_of = group_texts(a, b, ends_a, ends_b) if "groups_sha256" in fields else None
                rows = {f: [] for f in fields}
                buckets = []
                for k in range(j - i):
                    la, ga = slice(to_link[k], to_link[k + 1]), slice(to_group[k], to_group[k + 1])
                    own = {"a_ids": a_parts[k], "b_ids": b_parts[k], "a_group_ends": ends_a[ga] - to_a[k], "b_group_ends": ends_b[ga] - to_b[k],
                           "link_a": link_a[la] - to_a[k], "link_b": link_b[la] - to_b[k]}
                    if "pairs" in fields:
                        own["pairs"], own["pair_links"] = np.unique(pairs[la], return_counts=True)
                    for f in fields:
                        if f == "groups_sha256":
                            text = "".join(texts_of[to_a[k] + to_b[k]:to_a[k + 1] + to_b[k + 1]])[:-1]
                            rows[f].append(hashlib.sha256(text.encode()).hexdigest() if text else "")
                        else:
                            rows[f].append(own[f].astype("<u4").tobytes())
                    buckets.append(bucket)
                    held += to_link[k + 1] - to_link[k]
                    if held >= BUCKET_LINKS:
                        bucket, held = bucket + 1, 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets, pa.int64()), ids.slice(i, j - i), *(pa.array(x, pa.int64()) for x in (
                        n_a, n_b, np.diff(to_group), np.diff(to_link)))]
                    + [pa.array(rows[f], pa.string()) if FIELDS[f] == "string" else binary_array(rows[f]) for f in fields],
                    ["bucket", "doc_id", "n_a", "n_b", "n_groups", "n_links", *fields])
    return run


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None, b_path: str | None = None,
          fields: tuple[str, ...] = ("a_ids", "b_ids", "a_group_ends", "b_group_ends", "link_a", "link_b")) -> DataFrame:
    """bucket, doc_id, n_a, n_b, n_groups, n_links and the named fields, per
    document: ids of both sides, token counts up to each group's end, token
    indexes of each link (little-endian unsigned 32-bit numbers); ``pairs``
    (A id times the size of B's vocabulary, plus B id) with ``pair_links``;
    ``groups_sha256`` of the groups' text."""
    names = ", ".join(f"{f} {FIELDS[f]}" for f in fields)
    return ids_and_text(docs, id_col, text_col).mapInArrow(
        _aligned(a_path or public_tokenizers.path(A_NAME), b_path or public_tokenizers.path(B_NAME), list(fields)),
        "bucket long, doc_id long, n_a long, n_b long, n_groups long, n_links long, " + names)


def _bucket_pairs(batches):
    """Per bucket each pair once, with its documents; a bucket that spreads
    over tasks or batches gives partial rows."""
    def rows(bucket, parts):
        pair, docs = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), bucket)), pa.array(pair.astype(np.int64)), pa.array(docs)],
                                          ["bucket", "pair", "docs"])
    now, parts = None, []
    for b in batches:
        for bucket, pairs in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if bucket != now:
                if parts:
                    yield rows(now, parts)
                now, parts = bucket, []
            parts.append(np.frombuffer(pairs, "<u4"))
    if parts:
        yield rows(now, parts)


def _counted(key, documents, counts):
    """Documents of one bucket with the corpus-wide counts of its pairs."""
    order = np.argsort(counts.column("pair").to_numpy())
    pair, n = counts.column("pair").to_numpy()[order], counts.column("n").to_numpy()[order]
    best = counts.column("best").to_numpy(zero_copy_only=False)[order]
    n_best, total = [], []
    for pairs, links in zip(documents.column("pairs").to_pylist(), documents.column("pair_links").to_pylist()):
        at, times = np.searchsorted(pair, np.frombuffer(pairs, "<u4")), np.frombuffer(links, "<u4").astype(np.int64)
        n_best.append(int(times[best[at]].sum()) if len(at) else 0)
        total.append(int((times * n[at]).sum()) if len(at) else 0)
    kept = documents.select(["doc_id", "n_a", "n_b", "n_groups", "n_links"])
    return (kept.append_column("n_best", pa.array(n_best, pa.int64())).append_column("count_sum", pa.array(total, pa.int64()))
            .append_column("groups_sha256", documents.column("groups_sha256")))


def pair_counts(aligned: DataFrame, vocabulary_b: int) -> tuple[DataFrame, DataFrame]:
    """(bucket, pair) held, and per pair of ids: n documents, best (n is the
    highest of the pairs with that A id)."""
    held = (aligned.select("bucket", "pairs").where("length(pairs) > 0").mapInArrow(_bucket_pairs, "bucket long, pair long, docs long")
            .groupBy("pair", "bucket").agg(F.sum("docs").alias("docs")))
    counts = held.groupBy("pair").agg(F.sum("docs").alias("n")).withColumn("a", F.call_function("div", F.col("pair"), F.lit(vocabulary_b)))
    # at most one row per entry of A's vocabulary
    top = counts.groupBy("a").agg(F.max("n").alias("top"))
    return held, counts.join(F.broadcast(top), "a").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def alignment_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None,
                     b_path: str | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    b_path = b_path or public_tokenizers.path(B_NAME)
    aligned = written(align(docs, id_col, text_col, a_path, b_path, ("pairs", "pair_links", "groups_sha256")))
    held, counts = pair_counts(aligned, len(piece_ids(b_path).bytes))
    wanted = written(held.select("pair", "bucket").join(counts, "pair").select("bucket", "pair", "n", "best"))
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return aligned.groupBy("bucket").cogroup(wanted.groupBy("bucket")).applyInArrow(_counted, schema)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_counts(table(spark, sf_dir, "documents"))
