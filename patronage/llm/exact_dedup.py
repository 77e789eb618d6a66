"""Exact duplicates by content-defined chunk recipes.

Each normalised text is cut where a rolling hash of its last 32 bytes says so,
so equal passages give equal chunks. A chunk travels once per task under its
128-bit hash; within a hash the bytes are compared, and bytes that differ
under one hash get identifiers of their own. Texts are then compared by their
ordered identifier lists, 16 bytes for about 2 KB of text.

Null texts count as empty; all empty texts form one group. Rows that repeat
the staying row's doc_id are marked like it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm.common import binary_array, cut, ids_and_text, parallelism, row_key, rows_with, slices, table

BLANKS = b" \t\n\x0b\x0c\r"
LEAST, MOST, CUT_BITS = 512, 8192, 11
#: Bytes of chunks a task remembers as already sent.
SENT_BYTES = 32 << 20
GEAR = np.array([xxhash.xxh32_intdigest(bytes([i])) for i in range(256)], np.uint32)


def normalised(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(None, BLANKS)


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``: after a byte at which the hash of the
    last 32 bytes has its top bits zero, ``LEAST`` to ``MOST`` bytes apart."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = GEAR[np.frombuffer(data, np.uint8)]
    for s in (1, 2, 4, 8, 16):
        g = h.copy()
        g[s:] += h[:-s] << np.uint32(s)
        h = g
    ends, last = [], 0
    for p in (np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1).tolist():
        while p - last > MOST:
            last += MOST
            ends.append(last)
        if p - last >= LEAST:
            ends.append(p)
            last = p
    while n - last > MOST:
        last += MOST
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def chunks(data: bytes, hash_bytes: int = 16) -> Iterator[tuple[bytes, bytes]]:
    start = 0
    for end in cuts(data):
        body = data[start:end]
        yield xxhash.xxh3_128_digest(body)[:hash_bytes], body
        start = end


def _contents(hash_bytes: int):
    """Chunk bodies, each sent once by a task as long as it remembers it."""
    def run(batches):
        sent: dict[bytes, bytes] = {}
        size = 0
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in slices(texts):
                out: list[tuple[bytes, bytes]] = []
                for t in texts[i:j]:
                    for h, body in chunks(normalised(t), hash_bytes):
                        if sent.get(h) != body:
                            out.append((h, body))
                            if size > SENT_BYTES:
                                sent, size = {}, 0
                            sent[h] = body
                            size += len(body)
                yield pa.RecordBatch.from_arrays([binary_array([x[0] for x in out]), binary_array([x[1] for x in out])], ["h", "body"])
    return run


def _variants(batches):
    """Of bodies sorted by hash: the different ones under a hash that has more
    than one, numbered in order of arrival."""
    last, bodies = None, []
    for b in batches:
        out = []
        for h, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if h != last:
                last, bodies = h, [body]
            elif body not in bodies:
                bodies.append(body)
                if len(bodies) == 2:
                    out.append((h, bodies[0], 0))
                out.append((h, body, len(bodies) - 1))
        yield pa.RecordBatch.from_arrays([binary_array([x[0] for x in out]), binary_array([x[1] for x in out]), pa.array([x[2] for x in out], pa.int32())], ["h", "body", "variant"])


def _recipes(hash_bytes: int):
    def run(batches):
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            points, recipes, shas = [], [], []
            for t in texts:
                data = normalised(t)
                points.append(len(t))
                recipes.append(b"".join(h for h, _ in chunks(data, hash_bytes)))
                shas.append(hashlib.sha256(data).hexdigest())
            yield pa.RecordBatch.from_arrays([ids, pa.array(points, pa.int64()), binary_array(recipes), pa.array(shas, pa.string())], ["doc_id", "points", "recipe", "text_sha256"])
    return run


def _references(hash_bytes: int):
    """Every chunk of every text with its place; only used after a collision."""
    def run(batches):
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in slices(texts):
                out = []
                for d, t in zip(ids[i:j], texts[i:j], strict=True):
                    data = normalised(t)
                    sha = hashlib.sha256(data).hexdigest()
                    out += [(d, sha, len(t), k, h, body) for k, (h, body) in enumerate(chunks(data, hash_bytes))]
                cols = list(zip(*out, strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "text_sha256", "points", "place", "h", "body"])
    return run


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     hash_bytes: int = 16) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per document.
    Texts are equal when identical without ASCII white space; of equal texts
    the one with the most code points in the original, then the smallest
    doc_id, stays. ``hash_bytes`` shortens the chunk hash (tests only)."""
    return _grouped(docs, id_col, text_col, hash_bytes).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _grouped(docs: DataFrame, id_col: str, text_col: str, hash_bytes: int) -> DataFrame:
    """``exact_duplicates`` with each row's code points and its group's most."""
    spark = docs.sparkSession
    d = ids_and_text(docs, id_col, text_col)
    bodies = d.mapInArrow(_contents(hash_bytes), "h binary, body binary")
    clashes = cut(bodies.repartition(parallelism(spark), "h").sortWithinPartitions("h")
                  .mapInArrow(_variants, "h binary, body binary, variant int"))
    recipes = cut(d.mapInArrow(_recipes(hash_bytes), "doc_id long, points long, recipe binary, text_sha256 string"))
    if not clashes.isEmpty():
        refs = (d.mapInArrow(_references(hash_bytes), "doc_id long, text_sha256 string, points long, place int, h binary, body binary")
                .join(clashes.withColumnsRenamed({"h": "h2", "body": "body2"}), F.expr("h = h2 and body = body2"), "left")
                .select("doc_id", "text_sha256", "points", "place", F.concat_ws(":", F.hex("h"), "variant").alias("chunk_id")))
        exact = (refs.dropDuplicates(["doc_id", "text_sha256", "points", "place"]).groupBy("doc_id", "text_sha256", "points")
                 .agg(F.array_sort(F.collect_list(F.struct("place", "chunk_id"))).alias("l"))
                 .select(F.col("doc_id").alias("d2"), F.col("text_sha256").alias("s2"), F.col("points").alias("p2"),
                         F.to_binary(F.array_join("l.chunk_id", "/"), F.lit("utf-8")).alias("r2")))
        recipes = recipes.join(exact, F.col("doc_id").eqNullSafe(F.col("d2")) & (F.col("text_sha256") == F.col("s2")) & (F.col("points") == F.col("p2")), "left").select(
            "doc_id", "points", F.coalesce("r2", "recipe").alias("recipe"), "text_sha256")
    groups = (recipes.groupBy("recipe")
              .agg(F.count(F.lit(1)).alias("group_size"),
                   F.min(F.struct(-F.col("points"), F.col("doc_id").isNull(), "doc_id")).alias("best"))
              .select("recipe", "group_size", F.col("best.doc_id").alias("keep_id"), (-F.col("best.col1")).alias("most")))
    return recipes.join(groups, "recipe").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "points", "most")


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that stay: one of each group of equal
    texts, also where an id stands with several texts or rows have no id."""
    stay = _grouped(docs, id_col, text_col, 16).where("kept and points = most").select(row_key("doc_id", F.col("text_sha256"), F.col("points")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = row_key(id_col, F.sha2(F.translate(text, " \t\n\x0b\f\r", ""), 256), F.char_length(text))
    return rows_with(docs, stay, key, text_col)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
     g AS (SELECT norm, count(*) AS group_size, max(length(text)) AS longest FROM d GROUP BY norm),
     k AS (SELECT d.norm, min(doc_id) AS keep_id FROM d JOIN g ON d.norm = g.norm AND length(d.text) = g.longest GROUP BY d.norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g USING (norm) JOIN k USING (norm)
"""
