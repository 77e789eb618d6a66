"""Language identification by cross-parsing entropy.

Each language has the suffix automaton of a bounded sample of its text. A text
is parsed into phrases, each the longest match with the sample from where the
last one ended; the language that needs the fewest phrases, each weighted with
the bits of a place in its sample, wins. Texts are read whole: as letters in
lower case with single blanks for everything else, in segments of ``SEGMENT``
symbols that a phrase does not cross, many segments and all languages side by
side.

``und`` (score 0) is given for null texts, texts without a letter, and when
nothing could be learned. Equal costs go to the first language in order. The
score is the share of the winner when costs are taken as code lengths.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronage.llm.common import fold, ids_and_text, slices, table

#: The sample of a language: documents (smallest hashes), characters of a piece, symbols in all.
SAMPLE_ROWS, SAMPLE_PIECE, SAMPLE_SYMBOLS = 48, 256, 16384
#: Symbols of all languages' samples; with more than 64 languages each has an equal part of them.
TABLE_SYMBOLS = 1 << 20
SEGMENT = 1024
#: Symbols: 0 nothing, 1 blank, letters, and a few shared by rare letters.
SYMBOLS, SHARED = 64, 4
UNKNOWN = "und"


class Alphabet:
    """Letters in lower case as small numbers; the most frequent of the
    samples have one of their own."""

    def __init__(self, samples: list[str]):
        counts = Counter(c for s in samples for c in s.lower() if c.isalpha())
        own = [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:SYMBOLS - 2 - SHARED]]
        points = np.arange(0x110000, dtype=np.int64)
        letter = np.fromiter((chr(p).isalpha() for p in range(0x110000)), bool, 0x110000)
        self.number = np.where(letter, SYMBOLS - SHARED + points % SHARED, 1).astype(np.uint8)
        for k, c in enumerate(own):
            self.number[ord(c)] = 2 + k

    def symbols(self, text: str) -> np.ndarray:
        s = self.number[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]
        keep = np.ones(len(s), bool)
        keep[1:] = (s[1:] != 1) | (s[:-1] != 1)
        return s[keep]


def suffix_automaton(symbols: np.ndarray) -> np.ndarray:
    """Transitions (states x SYMBOLS, -1 for none) of the automaton of all
    substrings; state 0 is the empty one."""
    go = np.full((2 * len(symbols) + 2, SYMBOLS), -1, np.int32)
    length, link = [0], [-1]
    last = 0
    for c in symbols.tolist():
        cur = len(length)
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p != -1 and go[p, c] < 0:
            go[p, c] = cur
            p = link[p]
        if p != -1:
            q = int(go[p, c])
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                go[twin] = go[q]
                while p != -1 and go[p, c] == q:
                    go[p, c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return go[:len(length)]


class Model:
    """The languages' automata in one table. An entry holds the next state's
    row, twice, plus one if the step begins a new phrase."""

    def __init__(self, samples: dict[str, list[str]]):
        self.names = sorted(samples)
        self.alphabet = Alphabet([t for n in self.names for t in samples[n]])
        size = min(SAMPLE_SYMBOLS, TABLE_SYMBOLS // max(1, len(self.names)))
        tables, self.roots, self.bits, rows = [], [], [], 0
        for n in self.names:
            sample = np.concatenate([np.append(self.alphabet.symbols(t), 1) for t in samples[n]])[:size].astype(np.uint8)
            go = suffix_automaton(sample)
            step = np.where(go >= 0, 2 * (go + rows) * SYMBOLS, 2 * (np.maximum(go[0], 0) + rows) * SYMBOLS + 1)
            step[0] |= 1  # every step from the empty state begins a phrase
            step[:, 0] = 2 * (np.arange(len(go)) + rows) * SYMBOLS
            tables.append(step.astype(np.int32))
            self.roots.append(rows * SYMBOLS)
            self.bits.append(np.log2(max(2, len(sample))))
            rows += len(go)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (rows) for each language (columns)."""
        sizes = np.array([-(-len(s) // SEGMENT) for s in texts])
        of = np.repeat(np.arange(len(texts)), sizes)
        out = np.zeros((len(texts), len(self.names)), np.int64)
        if not len(of):
            return out
        parts = [s[i:i + SEGMENT] for s in texts for i in range(0, len(s), SEGMENT)]
        lengths = np.array([len(p) for p in parts])
        order = np.argsort(-lengths, kind="stable")
        grid = np.zeros((len(parts), int(lengths.max())), np.uint8)
        for row, k in enumerate(order.tolist()):
            grid[row, :lengths[k]] = parts[k]
        steps = np.ascontiguousarray(grid.T)
        active = np.searchsorted(-lengths[order], -np.arange(len(steps)), "left")
        state = np.repeat(np.array(self.roots, np.int32)[:, None], len(parts), axis=1)
        count = np.zeros(state.shape, np.int32)
        for row, n in zip(steps, active.tolist(), strict=True):
            step = self.table.take(state[:, :n] + row[:n])
            count[:, :n] += step & 1
            state[:, :n] = step >> 1
        np.add.at(out, of[order], count.T)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        symbols = [self.alphabet.symbols(t or "") for t in texts]
        known = np.array([bool((s > 1).any()) for s in symbols]) & bool(self.names)
        if not known.any():
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cost = self.phrases(symbols) * np.array(self.bits)
        best = cost.argmin(axis=1)
        share = 1 / np.exp2(np.maximum(cost.min(axis=1, keepdims=True) - cost, -1000)).sum(axis=1)
        return [self.names[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)], np.where(known, share, 0.0)


def _sample_pieces(batches):
    """Rows (lang, doc_id, text) -> pieces of each text, cut all over it and
    put in order by hash, as many as could fill the sample."""
    for b in batches:
        out = []
        for lang, doc, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            starts = sorted(range(0, len(text), SAMPLE_PIECE), key=lambda i: (xxhash.xxh64_intdigest(f"{doc} {i}"), i))
            pieces = dict.fromkeys(p for i in starts if any(map(str.isalpha, p := text[i:i + SAMPLE_PIECE])))
            out += [(lang, doc, k, p) for k, p in zip(range(SAMPLE_SYMBOLS // SAMPLE_PIECE), pieces)]
        cols = list(zip(*out, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["lang", "doc_id", "k", "piece"])


def learn(docs: DataFrame, train: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on at most SAMPLE_ROWS documents a language, chosen by hash of the
    id. They take turns giving a piece from anywhere in their text, equal
    pieces once, until the sample is full."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    d = d.where(F.expr(train)).where("lang is not null and text rlike '\\\\p{L}'")
    first = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = d.select("lang", "doc_id").withColumn("n", F.row_number().over(first)).where(F.col("n") <= SAMPLE_ROWS)
    ids = sorted({r.doc_id for r in chosen.select("doc_id").collect() if r.doc_id is not None})
    rows = d.where(F.col("doc_id").isin(ids)).select("lang", "doc_id", "text").mapInArrow(
        _sample_pieces, "lang string, doc_id long, k long, piece string").distinct().collect() if ids else []
    samples: dict[str, dict[str, None]] = {}
    for r in sorted(rows, key=lambda r: (r.lang, r.k, r.doc_id, r.piece)):
        samples.setdefault(r.lang, {})[r.piece] = None
    return Model({lang: list(pieces) for lang, pieces in samples.items()})


def _predict(shared):
    def run(batches):
        model = shared.value
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in slices([t or "" for t in texts]):
                names, score = model.predict(texts[i:j])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score: one row per document, from its text alone.
    The model is broadcast: at most 2 * SAMPLE_SYMBOLS * SYMBOLS * 4 bytes (8 MB) a language, and
    2 * TABLE_SYMBOLS * SYMBOLS * 4 bytes (512 MB) in all, whatever the number of languages."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return ids_and_text(docs, id_col, text_col, empty=False).mapInArrow(_predict(shared), "doc_id long, lang_pred string, score double")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, "crc32(coalesce(cast(doc_id as string), '')) % 4 <> 2")
    return predict(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
