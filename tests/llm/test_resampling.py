"""op11 against a plain count of every feature."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from patronage.llm import resampling as R
from tests.llm.conftest import EDGE_ROWS

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def buckets(text):
    w = words(text)
    return [crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target, percent=5, fewest=20):
    s, t = Counter(b for _, x in docs for b in buckets(x)), Counter(b for x in target for b in buckets(x))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    out = []
    for i, x in docs:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets(x))
        out.append([i, len(buckets(x)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None, len(words(x))])
    able = sorted((r for r in out if r[5] >= fewest), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for n, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = n
    return sorted(map(tuple, out), key=str)


def ours(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank", "n_words").collect()), key=str)


def test_planes_give_the_sum_of_the_gains():
    rng = np.random.default_rng(5)
    for top in (1, 3, 70000):
        gain = rng.integers(-9000, 4000, 10000)
        owner, bucket = rng.integers(0, 7, top), rng.integers(0, 40, top)
        want = np.bincount(owner, weights=gain[bucket], minlength=7).astype(np.int64)
        assert (R.weigh(owner, bucket, 7, gain, R.gain_planes(gain)) == want).all()
    for gain in (np.zeros(10000, np.int64), np.full(10000, -1), np.full(10000, 5), np.full(10000, -8)):
        assert R.weigh(np.array([0]), np.array([3]), 1, gain, R.gain_planes(gain)).tolist() == [gain[3]]


def test_edges_equal_brute_force(spark, edge_docs):
    target = spark.createDataFrame([("a b c two Words",), (None,), ("",)], "text string")
    got = ours(R.resample(edge_docs, target, percent=50, fewest_words=2))
    want = brute(EDGE_ROWS, ["a b c two Words", None, ""], 50, 2)
    assert got == want


def test_empty_tables(spark, make_docs):
    none = make_docs([])
    assert ours(R.resample(none, none)) == []
    one = [(1, "only words " * 30)]
    assert ours(R.resample(make_docs(one), none, percent=100)) == brute(one, [], 100)


@pytest.mark.parametrize("rows", [1, 3])
def test_whole_table_equals_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(R, "ROWS", rows * 50)
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = R.op11_resampling(spark, folder)
    assert got.columns[:5] == ["doc_id", "n_features", "weight", "score", "rank"]
    assert ours(got) == brute(docs, target)
