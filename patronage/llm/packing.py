"""Packing by power-of-two decomposition.

A document of n tokens becomes pieces whose lengths are the powers of two of
n, the largest repeated: no sequence holds two documents, none needs padding,
and pieces of equal length form the buckets that batches are drawn from. The
work is a map over documents; nothing is shuffled.

Null and empty texts are one piece: the end id alone.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from patronage.llm.common import ids_and_text, slices, table
from patronage.llm.units import WHITE, UnitIds

TOKENIZER = "byte_bpe_50k.json"
LONGEST, END_ID = 1024, 0
#: Characters of a run of white space, or of anything else, from which a text is encoded unit by unit.
LONG = 1000


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies use for each byte: the visible
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def unit_ids(path: str) -> UnitIds:
    """One per worker process. The model of the tokenizer encodes single
    matches; added tokens' strings are ordinary text here."""
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        kind = json.load(f)["pre_tokenizer"]
    if kind["type"] != "ByteLevel" or kind.get("add_prefix_space") or tokenizer.normalizer is not None:
        raise ValueError(f"{path}: a byte-level tokenizer without prefix space or normalizer is needed")
    letters = byte_letters()
    model = tokenizer.model

    def encode(match: str) -> bytes:
        return array("I", [t.id for t in model.tokenize(match.encode().decode("latin-1").translate(letters))]).tobytes()
    return UnitIds(public_tokenizers.PATTERN, encode)


@lru_cache(maxsize=2)
def plain_ids(path: str) -> Callable[[str], bytes]:
    """Ids of a whole text in which added tokens' strings are ordinary text.

    Where the merges rise with the ids of what they make, the ids are ranks
    and a text is encoded by them in one call; a text with a run of more than
    ``LONG`` characters (which that call takes badly), and any text under other
    merges, goes unit by unit."""
    known, letters = unit_ids(path), {c: b for b, c in byte_letters().items()}
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocabulary = model["vocab"]
    made = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if any(x >= y for x, y in zip(made, made[1:])):
        return known.text_ids
    ranks = {bytes(map(letters.__getitem__, entry)): i for entry, i in vocabulary.items() if all(c in letters for c in entry)}
    encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    long_run = re.compile(f"[^{WHITE}]{{{LONG}}}|[{WHITE}]{{{LONG}}}").search

    def ids(text: str) -> bytes:
        return known.text_ids(text) if long_run(text) else array("I", encode(text)).tobytes()
    return ids


@lru_cache(maxsize=2)
def added_tokens(path: str) -> tuple[re.Pattern | None, dict[str, bytes]]:
    """The strings that the tokenizer takes out of a text before it encodes
    the rest, as a pattern (none: no such string), and their ids."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError(f"{path}: added tokens that look at what is beside them are not supported")
    ids = {t["content"]: np.uint32(t["id"]).tobytes() for t in added}
    longest_first = sorted(map(re.escape, ids), key=len, reverse=True)
    return re.compile(f"({'|'.join(longest_first)})") if ids else None, ids


def texts_ids(path: str, texts: list[str]) -> list[bytes]:
    """Ids of whole texts, as ``Tokenizer.encode`` without special tokens gives
    them: strings of added tokens that stand in a text are those tokens."""
    plain, (pattern, added) = plain_ids(path), added_tokens(path)
    parts = [pattern.split(t) if pattern and any(a in t for a in added) else [t] for t in texts]
    return [b"".join([added[x] if k % 2 else plain(x) for k, x in enumerate(p)]) for p in parts]


def piece_lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Powers of two that add up to n, at most ``longest`` (a power of two),
    in falling order."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(longest.bit_length(), -1, -1) if rest >> b & 1]


def _pieces(path: str, longest: int, end_id: int):
    def run(batches):
        end = np.uint32(end_id).tobytes()
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            for i, j in slices(texts):
                rows, starts, lengths, totals, bodies = [], [], [], [], []
                for k, data in enumerate(texts_ids(path, texts[i:j]), i):
                    data += end
                    at, total = 0, len(data) // 4
                    for n in piece_lengths(total, longest):
                        rows.append(k)
                        starts.append(at)
                        lengths.append(n)
                        totals.append(total)
                        bodies.append(data[4 * at:4 * (at + n)])
                        at += n
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array(totals, pa.int64()), pa.array(bodies, pa.binary())], ["doc_id", "start", "length", "doc_tokens", "ids"])
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
         longest: int = LONGEST, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit),
    bucket (log2 of the length), sequence_id, offset: one row per piece, which
    is a sequence of its own. ``sequence_id`` holds the bucket in its lowest
    four bits; it follows the input's partitions."""
    if longest < 1 or longest & (longest - 1) or longest > 1 << 15:
        raise ValueError("longest must be a power of two up to 32768")
    schema = "doc_id long, start long, length long, doc_tokens long, ids binary"
    pieces = ids_and_text(docs, id_col, text_col).mapInArrow(_pieces(path or public_tokenizers.path(TOKENIZER), longest, end_id), schema)
    bucket = F.round(F.log2("length")).cast("int")
    return pieces.withColumn("bucket", bucket).withColumn(
        "sequence_id", F.monotonically_increasing_id() * 16 + F.col("bucket")).withColumn("offset", F.lit(0).cast("long"))


def write_buckets(packed: DataFrame, path: str) -> None:
    """One folder per piece length; batches of equal shape read one folder."""
    packed.write.mode("overwrite").partitionBy("bucket").parquet(path)


def digest(packed: DataFrame) -> DataFrame:
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents")))
