"""Byte-level BPE by prefix dynamic programming.

For every prefix of a match exactly one token can be the last one of its
encoding: the token that ends there and follows the last token of the prefix
before it validly. Storing these last tokens makes an append cost only the new
bytes, and an edit only the units it touches. Two tokens follow each other
validly if no merge across their border would have come before the merges that
made them; that is checked backwards from the finished tokens.

Null texts count as empty: no ids, empty bytes.
"""

from __future__ import annotations

import base64
from array import array
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm.common import binary_array, ids_and_text, slices, table
from patronage.llm.units import UNIT, UnitIds

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Pairs of tokens whose verdict a worker keeps.
KEPT_PAIRS = 200_000


class Vocabulary:
    """Tokens by rank, with the rules that make an encoding valid."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.sizes = {r: len(t) for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._follows: dict[int, bool] = {}
        #: Finds all reachable tokens that end at each byte.
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if self.reachable(rank):
                self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls({base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())})

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for a single byte
        and for a token that merging never reaches."""
        if token in self._halves:
            return self._halves[token]
        parts = [bytes([b]) for b in self.tokens[token]]
        last = None
        while len(parts) > 1:
            rank, i = min(((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)))
            if rank == 1 << 60:
                last = None
                break
            last = self.ranks[parts[i]], self.ranks[parts[i + 1]]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        self._halves[token] = last
        return last

    def reachable(self, token: int) -> bool:
        return len(self.tokens[token]) == 1 or self.halves(token) is not None

    def follows(self, a: int, b: int) -> bool:
        """Whether the encoding of a's and b's bytes together is [a, b]."""
        if len(self._follows) >= KEPT_PAIRS:
            self._follows.clear()
        known = self._follows[a << 32 | b] = self._check(a, b)
        return known

    def _check(self, a: int, b: int) -> bool:
        x, y, before = a, b, 1 << 60  # a border merge of a rank below ``before`` would have come first
        while True:
            if self.ranks.get(self.tokens[x] + self.tokens[y], 1 << 60) < before:
                return False
            left, right = self.halves(x), self.halves(y)
            if left is None and right is None:
                return True
            if right is None or left is not None and x > y:
                x, before = left[1], x  # of equal ranks the merge on the left, x's own, comes first
            else:
                y, before = right[0], y + 1  # here that is the one across the border

    def extend(self, data: bytes | bytearray, last: list[int]) -> None:
        """Append to ``last``, which holds the last token of the first prefixes
        (one per byte), those of the remaining prefixes of ``data``."""
        sizes, known = self.sizes, self._follows
        start = max(0, len(last) + 1 - self.longest)
        for at, token in self.automaton.iter(data[start:].decode("latin-1")):
            end, have = start + at + 1, len(last)
            if have >= end:
                continue  # this prefix has its token
            if have + 1 < end:
                break
            before = end - sizes[token]
            if before > 0:
                ok = known.get(last[before - 1] << 32 | token)
                if ok is None:
                    ok = self.follows(last[before - 1], token)
                if not ok:
                    continue
            last.append(token)
        if len(last) < len(data):
            raise ValueError("the vocabulary lacks a single byte")

    def walk(self, last: list[int]) -> list[int]:
        ids, end = [], len(last)
        while end:
            ids.append(last[end - 1])
            end -= len(self.tokens[ids[-1]])
        return ids[::-1]

    def encode(self, match: str | bytes) -> list[int]:
        data = match.encode() if isinstance(match, str) else match
        token = self.ranks.get(data)
        if token is not None and self.reachable(token):
            return [token]
        last: list[int] = []
        self.extend(data, last)
        return self.walk(last)


class GrowingMatch:
    """One match under exact appends and cuts of its end."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, bytearray(), []
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.extend(self.data, self.last)

    def shorten(self, length: int) -> None:
        del self.data[length:]
        del self.last[length:]

    def ids(self) -> list[int]:
        return self.vocabulary.walk(self.last)


class EditedText:
    """A text whose edits re-encode only the units they touch."""

    def __init__(self, known: UnitIds, text: str):
        self.known, self.units = known, UNIT.findall(text)
        self.encoded = [known[u] for u in self.units]

    def replace(self, start: int, end: int, new: str) -> int:
        """Replace characters start to end; gives the number of units encoded."""
        at, first = 0, 0
        while first < len(self.units) and at + len(self.units[first]) < start:
            at += len(self.units[first])
            first += 1
        first, at = (first - 1, at - len(self.units[first - 1])) if first else (0, 0)
        stop, to = first, at
        while stop < len(self.units) and to <= end:
            to += len(self.units[stop])
            stop += 1
        stop = min(stop + 1, len(self.units))
        piece = "".join(self.units[first:stop])
        units = UNIT.findall(piece[:start - at] + new + piece[end - at:])
        self.units[first:stop] = units
        self.encoded[first:stop] = [self.known[u] for u in units]
        return len(units)

    def text(self) -> str:
        return "".join(self.units)

    def ids(self) -> list[int]:
        return array("I", b"".join(self.encoded)).tolist()


@lru_cache(maxsize=2)
def unit_ids(path: str) -> UnitIds:
    """One per worker process."""
    vocabulary = Vocabulary.load(path)
    known = UnitIds(public_tokenizers.PATTERN, lambda match: array("I", vocabulary.encode(match)).tobytes())
    known.vocabulary = vocabulary
    return known


@lru_cache(maxsize=2)
def tokens_of(path: str) -> dict[int, bytes]:
    with open(path, "rb") as f:
        return {int(r): base64.b64decode(t) for t, r in (line.split() for line in f if line.strip())}


def decoded(ids: bytes, tokens: dict[int, bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, array("I", ids)))


def _encode(path: str, back: bool):
    def run(batches):
        known = unit_ids(path)
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in slices(texts):
                ids = [known.text_ids(t) for t in texts[i:j]]
                cols = [b.column(0).slice(i, j - i), binary_array(ids), pa.array([len(x) // 4 for x in ids], pa.int64())]
                if back:
                    cols.append(binary_array([decoded(x, known.vocabulary.tokens) for x in ids]))
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "ids", "n_tokens", "decoded"][:len(cols)])
    return run


def _decode(path: str):
    def run(batches):
        tokens = tokens_of(path)
        for b in batches:
            cols = [b.column(b.schema.get_field_index(n)) for n in ("doc_id", "ids", "n_tokens")]
            texts = [decoded(x, tokens) for x in cols[1].to_pylist()]
            yield pa.RecordBatch.from_arrays([*cols, binary_array(texts)], ["doc_id", "ids", "n_tokens", "decoded"])
    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit), n_tokens: one row per document."""
    return ids_and_text(docs, id_col, text_col).mapInArrow(
        _encode(path or public_tokenizers.path(RANKS), False), "doc_id long, ids binary, n_tokens long")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """The same rows with ``decoded``, the bytes of the ids."""
    return encoded.select("doc_id", "ids", "n_tokens").mapInArrow(
        _decode(path or public_tokenizers.path(RANKS)), "doc_id long, ids binary, n_tokens long, decoded binary")


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``decode(encode(docs))`` in one pass, so that a task needs one Python
    worker and one vocabulary."""
    return ids_and_text(docs, id_col, text_col).mapInArrow(
        _encode(path or public_tokenizers.path(RANKS), True), "doc_id long, ids binary, n_tokens long, decoded binary")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
