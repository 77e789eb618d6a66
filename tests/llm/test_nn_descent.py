import math
import random

import numpy as np
import pytest

from patronage.llm import nn_descent
from patronage.llm.nn_descent import embedding_groups, op4_nn_descent
from tests.llm.conftest import TESTDATA


def brute(rows):
    good = [(i, lab, np.array(v, np.float64)) if lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) else None for i, v, lab in rows]
    n, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    by = {}
    for k, x in enumerate(good):
        if x is not None:
            by.setdefault((x[1], len(x[2])), []).append(k)
    for ks in by.values():
        x = np.array([good[k][2] for k in ks])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        hits = x @ x.T >= 0.98
        np.fill_diagonal(hits, False)
        for a, b in zip(*np.nonzero(hits)):
            n[ks[a]] += 1
            root[find(ks[a])] = find(ks[b])
    least = {}
    for k in range(len(rows)):
        least[find(k)] = min(least.get(find(k), 1 << 60), rows[k][0])
    return sorted((rows[k][0], n[k], least[find(k)], rows[k][0] == least[find(k)]) for k in range(len(rows)))


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "x", 0) for i, v, lab in rows], "vec_id long, embedding array<float>, label int, v string, rid int")


@pytest.mark.parametrize("full", [64, 8])
def test_equals_brute_force(spark, full, monkeypatch):
    monkeypatch.setattr(nn_descent, "FULL", full)
    monkeypatch.setattr(nn_descent, "TILE", 16)
    monkeypatch.setattr(nn_descent, "LEAF", 32)
    rng = np.random.default_rng(3)
    rows = [(k, rng.normal(size=16).astype(np.float32).tolist(), int(k % 3)) for k in range(300)]
    for k in range(60):
        rows.append((1000 + k, (np.array(rows[k][1]) + rng.normal(size=16) * 0.02).astype(np.float32).tolist(), rows[k][2]))
    heart = rng.normal(size=16)
    rows += [(2000 - k, (heart + rng.normal(size=16) * 0.1).astype(np.float32).tolist(), 1) for k in range(90)]
    rows += [(3000 + k, rows[5][1], rows[5][2]) for k in range(40)] + [(3100, rows[5][1], 2 if rows[5][2] != 2 else 0)]
    rows += [(4000, None, 1), (4001, [], 1), (4002, [0.0] * 16, 1), (4003, [float("nan")] * 16, 1), (4004, [None] * 16, 1), (4005, rows[7][1], None),
             (4006, [float("inf")] * 16, 1), (4007, rows[1][1][:8], 1), (4008, rows[1][1][:8], 1), (0, rows[0][1], rows[0][2])]
    audit = []
    got = sorted(map(tuple, embedding_groups(frame(spark, rows), audit=audit).collect()))
    assert got == brute(rows)
    assert audit[-1].reached() and audit[-1].query_links > 100


def test_links_between_dense_clusters_of_one_label(spark):
    rng = np.random.default_rng(7)
    first, aside = np.linalg.qr(rng.normal(size=(32, 2)))[0].T
    second = 0.984 * first + math.sqrt(1 - 0.984 ** 2) * aside
    rows = [(1000 * c + k, (x + rng.normal(size=32) * 0.0056).astype(np.float32).tolist(), 1) for c, x in enumerate((first, second)) for k in range(100)]
    rows += [(5000 + k, rng.normal(size=32).astype(np.float32).tolist(), 1) for k in range(50)]
    audit, want = [], brute(rows)
    assert sum(n > 150 for _, n, _, _ in want) > 150 and {c for i, _, c, _ in want if i < 5000} == {0}
    assert sorted(map(tuple, embedding_groups(frame(spark, rows), audit=audit).collect())) == want
    assert len(audit) == 1


def test_rare_links_about_a_common_mean(spark, monkeypatch):
    """Most vectors lie within 30 degrees of their mean and 15 pairs in 6,000
    are links: random queries would see none of them."""
    monkeypatch.setattr(nn_descent, "AUDIT_ROWS", 40)
    rng = np.random.default_rng(1)
    mean = rng.normal(size=48)
    mean *= 3 / np.linalg.norm(mean)
    noise = rng.normal(size=(6000, 48))
    x = mean + noise / np.linalg.norm(noise, axis=1)[:, None]
    near = x[:15] / np.linalg.norm(x[:15], axis=1)[:, None]
    aside = rng.normal(size=(15, 48))
    aside -= (aside * near).sum(axis=1)[:, None] * near
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    x[-15:] = 0.981 * near + math.sqrt(1 - 0.981 ** 2) * aside
    rows = [(k, v.astype(np.float32).tolist(), 1) for k, v in enumerate(x)]
    audit = []
    got = sorted(map(tuple, embedding_groups(frame(spark, rows), audit=audit).collect()))
    assert got == brute(rows)
    assert sum(n for _, n, _, _ in got) >= 30
    assert audit[-1].reached() and audit[-1].tree_links >= 10 and audit[-1].query_links >= 20


def test_too_few_trees_are_noticed_and_mended(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "TREES", 1)
    monkeypatch.setattr(nn_descent, "LEAF", 16)
    monkeypatch.setattr(nn_descent, "FORESTS", 30)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 12))
    x[-200:] = x[:200] + rng.normal(size=(200, 12)) * 0.15
    rows = [(k, v.astype(np.float32).tolist(), 1) for k, v in enumerate(x)]
    audit = []
    got = sorted(map(tuple, embedding_groups(frame(spark, rows), audit=audit).collect()))
    want = sum(n for _, n, _, _ in brute(rows))
    assert not audit[0].reached() and audit[-1].reached()
    assert sum(n for _, n, _, _ in got) >= 0.98 * want > 100


def test_an_audit_without_links_claims_no_recall(spark):
    audit = []
    embedding_groups(frame(spark, [(1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1)]), audit=audit).collect()
    assert audit == [(None, 0, None, 0)]


def test_parts_of_a_hub_are_dealt_anew(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "HUB", 4)
    rng = np.random.default_rng(8)
    nodes = spark.createDataFrame([(k, rng.normal(size=8).astype(np.float32).tobytes()) for k in range(13)], "rid long, v binary")
    graph = spark.createDataFrame([(0, k, 0.5, False, k) for k in range(1, 13)], "a long, b long, sim double, fresh boolean, rank int")
    met = [{(r.a, r.b) for r in nn_descent._join_round(graph, nodes, "<f4", 0.98, salt).where("fresh").collect() if r.a and r.b} for salt in range(2)]
    assert met[0] != met[1] and all(met)


def test_a_recall_that_stays_low_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "_lists", lambda edges, threshold: edges.limit(0).withColumn("rank", nn_descent.F.lit(1)))
    v = [1.0, 0.5]
    with pytest.raises(RuntimeError, match="audited"):
        embedding_groups(frame(spark, [(1, v, 1), (2, [1.0, 0.51], 1)]))


def test_empty_and_linkless(spark):
    assert embedding_groups(frame(spark, [])).count() == 0
    rows = [(1, [1.0, 0.0], 1), (2, [0.0, 1.0], 1), (3, None, None)]
    assert sorted(map(tuple, embedding_groups(frame(spark, rows)).collect())) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


def test_op4_on_the_table(spark):
    sf = f"{TESTDATA}/sf0.1"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    random.Random(1).shuffle(rows)
    assert sorted(map(tuple, op4_nn_descent(spark, sf).collect())) == brute(rows)
