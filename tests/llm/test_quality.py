import random
import zlib

import numpy as np
import pytest

from patronage.llm import quality
from tests.llm.conftest import EDGE_ROWS, TESTDATA


def test_features_see_words_pairs_shapes_and_repeats():
    a, b = set(quality.features("The cat sat.")), set(quality.features("The cat sat!!"))
    assert a != b and len(a & b) >= 3
    assert len(quality.features("")) == 0 and len(quality.features(" \n")) == 0
    assert set(quality.features("no no")) != set(quality.features("no yes"))
    assert quality.shape("THE!!") != quality.shape("The!!") != quality.shape("the")


def test_dual_descent_reaches_the_primal_optimum():
    rng = np.random.default_rng(1)
    rows = [np.sort(rng.choice(40, 8, replace=False)).astype(np.int32) for _ in range(120)]
    y = np.array([int((r < 16).sum() > 3) for r in rows])
    values = [np.ones(8) / np.sqrt(8) for _ in rows]
    w, bias = quality.dual_descent(rows, values, y, rounds=500)
    sign = np.where(y > 0, 1, -1)

    def primal(v, b):
        return 0.5 * (v @ v + b * b) + sum(max(0, 1 - s * (v[r] @ x + b)) for r, x, s in zip(rows, values, sign))
    best = primal(w, bias)
    for _ in range(200):
        d = np.zeros(quality.FEATURES)
        d[:40] = rng.normal(0, 0.05, 40)
        assert primal(w + d, bias + rng.normal(0, 0.05)) >= best - 0.05


def test_log_ratios_by_hand():
    r = quality.log_ratios([np.array([1, 2]), np.array([1]), np.array([3])], np.array([1, 1, 0]))
    n = quality.FEATURES
    assert r[1] == pytest.approx(np.log((3 / (n + 3)) / (1 / (n + 1))))
    assert r[3] == pytest.approx(np.log((1 / (n + 3)) / (2 / (n + 1))))


def test_edges_and_missing_classes(spark, edge_docs):
    labels = spark.createDataFrame([(1, 1, "c"), (4, 0, "c"), (5, None, "c"), (None, 1, "c"), (99, 1, "c"), (6, 1, "c")], "doc_id long, quality int, score string")
    for condition in ("true", "false", "doc_id = 4"):
        got = quality.scores(edge_docs, quality.learn(edge_docs, labels, condition)).collect()
        assert len(got) == len(EDGE_ROWS)
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
        assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert quality.scores(edge_docs.limit(0), quality.learn(edge_docs, labels, "true")).count() == 0


def test_op5_held_out_accuracy(spark):
    sf = f"{TESTDATA}/sf0.1"
    want = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = quality.op5_quality(spark, sf).collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    held = [r for r in got if r.held_out and want.get(r.doc_id) is not None]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    right = [r.predicted == want[r.doc_id] for r in held]
    good = [r.predicted for r in held if want[r.doc_id] == 1]
    bad = [r.predicted for r in held if want[r.doc_id] == 0]
    print(len(held), np.mean(right), np.mean(good), np.mean(bad))
    rng = random.Random(1)
    pairs = [(a.score, b.score) for a, b in ((rng.choice([r for r in held if want[r.doc_id] == 1]), rng.choice([r for r in held if want[r.doc_id] == 0])) for _ in range(300))]
    assert np.mean([a > b for a, b in pairs]) > 0.95
    assert np.mean(right) > 0.95 and np.mean(good) > 0.97
