"""Quality classifier: naive Bayes support vectors.

A text is a set of n-gram indicators: words, word pairs, and runs of one to
three word shapes (letter case, digits, punctuation, repetition of the word
before), hashed to ``FEATURES``. Each indicator is scaled by the log ratio of
its smoothed frequency in the two classes, rows are scaled to length one, and
a linear hinge-loss model is fitted by dual coordinate descent; a logistic
curve fitted on margins of rows left out of that fit gives the score.

The fit uses at most ``SAMPLE_ROWS`` documents of each class (smallest hashes
of the id); scoring reads every whole text. Null and empty texts have no
features and get the score of the bias. With fewer than two classes in the
sample the score is the smoothed share of class 1.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patronage.llm.common import fold, ids_and_text, slices, table

FEATURE_BITS = 18
FEATURES = 1 << FEATURE_BITS
SAMPLE_ROWS = 3000
THRESHOLD = 0.3
#: Part of the sample whose margins fit the curve: one row in so many.
CURVE_PART = 4
KEPT_WORDS = 150_000
PUNCTUATION = ".,!?;:|"


def shape(word: str) -> int:
    """Case, digits, leading and trailing punctuation in eight bits."""
    core = word.strip("".join(c for c in word if not c.isalnum())) if not word.isalnum() else word
    letters = [c for c in core if c.isalpha()]
    case = 0 if not letters else 1 if core.islower() else 3 if core.isupper() and len(letters) > 1 else 2 if core[:1].isupper() and core[1:] == core[1:].lower() else 4
    tail = word[len(word.rstrip("".join(c for c in word if not c.isalnum()))):] if not word[-1].isalnum() else ""
    end = 0 if not tail else 7 if len(tail) > 1 else 1 + PUNCTUATION.find(tail) if tail in PUNCTUATION[:5] else 6
    return case | any(c.isdigit() for c in core) << 3 | end << 4 | (not word[0].isalnum()) << 7


class WordCodes(dict):
    """word -> hash of its lower-case form and its shape in one number."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        code = xxhash.xxh32_intdigest(word.lower().encode("utf-8", "surrogatepass")) << 8 | shape(word)
        self[word] = code
        return code


CODES = WordCodes()


def _slot(x: np.ndarray, kind: int) -> np.ndarray:
    return ((x * np.uint64(8) + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - FEATURE_BITS)).astype(np.int32)


def features(text: str) -> np.ndarray:
    """Sorted distinct feature numbers of the whole text."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int32)
    codes = np.fromiter(map(CODES.__getitem__, words), np.uint64, len(words))
    word, look = codes >> np.uint64(8), codes & np.uint64(255)
    look = look * np.uint64(2)
    look[1:] += word[1:] == word[:-1]
    pairs = look[:-1] * np.uint64(512) + look[1:]
    parts = [_slot(word, 0), _slot(word[:-1] * np.uint64(0x100000001B3) + word[1:], 1), _slot(np.unique(look), 2),
             _slot(np.unique(pairs), 3), _slot(np.unique(pairs[:-1] * np.uint64(512) + look[2:]), 4)]
    return np.unique(np.concatenate(parts))


def log_ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Log of the ratio of smoothed, normalised indicator counts of the classes."""
    counts = []
    for c in (1, 0):
        of = [r for r, k in zip(rows, y, strict=True) if k == c]
        n = np.ones(FEATURES) + np.bincount(np.concatenate(of) if of else np.zeros(0, np.int64), minlength=FEATURES)
        counts.append(n / n.sum())
    return np.log(counts[0] / counts[1])


def dual_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, cost: float = 1.0, rounds: int = 20, seed: int = 0) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model: one dual variable at a time,
    each step solved exactly within 0 and ``cost``; ends when no step moves."""
    w, bias, alpha = np.zeros(FEATURES), 0.0, np.zeros(len(rows))
    sign = np.where(y > 0, 1.0, -1.0)
    square = np.array([v @ v + 1 for v in values])
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            slope = sign[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), cost)
            step = (new - alpha[i]) * sign[i]
            if step:
                w[rows[i]] += step * values[i]
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w, bias


def logistic_curve(margin: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a * margin + b))), by Newton steps with a small ridge."""
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    t = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ t, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 1e-3 * t
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        t = t - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(t[0]), float(t[1])


class Model:
    def __init__(self, rows: list[np.ndarray], y: np.ndarray, totals: tuple[int, int]):
        """``totals``: rows of class 0 and 1 in all training data."""
        self.prior = (totals[1] + 1) / (sum(totals) + 2)
        self.ready = len(set(y.tolist())) == 2
        if not self.ready:
            return
        curve = np.arange(len(rows)) % CURVE_PART == 0
        if len(set(y[~curve].tolist())) < 2 or len(set(y[curve].tolist())) < 2:
            curve[:] = False
        fit = np.flatnonzero(~curve)
        self.ratio = log_ratios([rows[i] for i in fit], y[fit])
        self.weight = np.zeros(FEATURES)
        w, self.bias = dual_descent([rows[i] for i in fit], [self.scaled(rows[i]) for i in fit], y[fit])
        self.weight = w * self.ratio
        use = np.flatnonzero(curve) if curve.any() else fit
        weight = np.where(y[use] > 0, totals[1] / max(1, (y[use] > 0).sum()), totals[0] / max(1, (y[use] == 0).sum()))
        self.a, self.b = logistic_curve(np.array([self.margin(rows[i]) for i in use]), y[use], weight / weight.mean())

    def scaled(self, row: np.ndarray) -> np.ndarray:
        v = self.ratio[row]
        return v / max(float(np.sqrt(v @ v)), 1e-12)

    def margin(self, row: np.ndarray) -> float:
        v = self.ratio[row]
        return float(self.weight[row].sum() / max(float(np.sqrt(v @ v)), 1e-12) + self.bias) if len(row) else self.bias

    def score(self, text: str) -> float:
        if not self.ready:
            return self.prior
        return float(1 / (1 + np.exp(-np.clip(self.a * self.margin(features(text)) + self.b, -30, 30))))


def learn(docs: DataFrame, labels: DataFrame, train: str, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on the labelled documents that ``train``, a SQL condition on doc_id,
    allows. A document labelled both ways counts under each label."""
    marks = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y"))
             .where("doc_id is not null and y in (0, 1)").where(F.expr(train)).distinct())
    totals = {r.y: r["count"] for r in marks.groupBy("y").count().collect()}
    first = Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = [(r.doc_id, r.y) for r in marks.withColumn("n", F.row_number().over(first)).where(F.col("n") <= SAMPLE_ROWS).collect()]
    ids = sorted({i for i, _ in chosen})
    d = ids_and_text(docs, id_col, text_col)

    def rows_of(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([features(t).tobytes() for t in b.column(1).to_pylist()], pa.binary())], ["doc_id", "f"])
    found = d.where(F.col("doc_id").isin(ids)).mapInArrow(rows_of, "doc_id long, f binary").distinct().collect() if ids else []
    by: dict[int, bytes] = {r.doc_id: bytes(r.f) for r in sorted(found, key=lambda r: (r.doc_id, bytes(r.f)))}
    use = sorted((xxhash.xxh32_intdigest(str(i)), i, y) for i, y in chosen if i in by)
    return Model([np.frombuffer(by[i], np.int32) for _, i, _ in use], np.array([y for *_, y in use], np.int64), (totals.get(0, 0), totals.get(1, 0)))


def _scores(shared):
    def run(batches):
        model = shared.value
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in slices(texts):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array([model.score(t) for t in texts[i:j]], pa.float64())], ["doc_id", "score"])
    return run


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted: one row per document. The model is broadcast:
    two vectors of FEATURES doubles (4 MB)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return ids_and_text(docs, id_col, text_col).mapInArrow(_scores(shared), "doc_id long, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose text scores at least
    ``threshold``. Rows stay Arrow batches, scored and cut slice by slice."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        model = shared.value
        for b in batches:
            texts = [t or "" for t in b.column(at).to_pylist()]
            for i, j in slices(texts):
                yield b.slice(i, j - i).filter(pa.array([model.score(t) >= threshold for t in texts[i:j]], pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


TRAIN = "crc32(coalesce(cast(doc_id as string), '')) % 5 <> 0"


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, table(spark, sf_dir, "labels"), TRAIN)
    return scores(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")
