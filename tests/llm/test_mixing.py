"""op13: targets, seats and block choice against plain loops; the whole mix by its properties."""

import heapq
import random
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from patronage.llm import mixing as M
from tests.llm.conftest import EDGE_ROWS


def plain_targets(sizes, weights, most=3):
    """Reshares the excess until no source is above its ceiling."""
    capped = set()
    while True:
        left = sum(sizes) - sum(most * sizes[i] for i in capped)
        total = sum(w for i, w in enumerate(weights) if i not in capped)
        share = [most * s if i in capped else Fraction(left * w, total) if total else 0 for i, (s, w) in enumerate(zip(sizes, weights))]
        above = {i for i, s in enumerate(sizes) if i not in capped and share[i] > most * s}
        if not above:
            return share
        capped |= above


@pytest.mark.parametrize("sizes", [[10, 20, 30], [1, 0, 1000, 5, 2], [0, 0], [7], [1, 1, 1, 10 ** 12], [3, 3000, 3, 3, 3]])
def test_targets(spark, sizes):
    weights = [(1, 2, 3)[i % 3] for i in range(len(sizes))]
    df = spark.createDataFrame(list(zip(range(len(sizes)), sizes, weights)), "i int, source_size long, weight long")
    got = [r.target for r in M.with_targets(df).orderBy("i").collect()]
    assert got == pytest.approx([float(x) for x in plain_targets(sizes, weights)], rel=1e-12)


def plain_seats(votes, ceilings, seats):
    """One seat at a time to the highest quotient."""
    got = [0] * len(votes)
    heap = [(-v, i) for i, v in enumerate(votes) if ceilings[i]]
    heapq.heapify(heap)
    for _ in range(seats):
        _, i = heapq.heappop(heap)
        got[i] += 1
        if got[i] < ceilings[i]:
            heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    return got


def test_seats_go_to_the_highest_quotients(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for g in range(25):
        n = rng.choice([1, 2, 5, 40])
        votes = [rng.choice([0.3, 0.45, 1.0, 7.5, rng.random() * 100]) for _ in range(n)]
        if g % 3 == 0:  # many just below a seat, one large
            votes = [0.49] * n + [50.0]
        ceilings = [rng.choice([1, 3, 200]) for _ in votes]
        seats = min(sum(ceilings), rng.choice([0, 1, round(sum(votes)), 3 * round(sum(votes))]))
        for i, (got, v, c) in enumerate(zip(plain_seats(votes, ceilings, seats), votes, ceilings)):
            rows.append((g, i, v, c, seats))
            want[g, i] = got
    df = spark.createDataFrame(rows, "g int, i int, votes double, ceiling long, seats long")
    assert {(r.g, r.i): r.quota for r in M.apportion(df, ["g"], ["i"]).collect()} == want


def test_block_choice_takes_what_marking_every_word_gives(spark):
    rng = random.Random(9)
    rows, want = [], {}
    for line in range(60):
        sizes = [rng.choice([0, 1, 5, 40, 300]) for _ in range(rng.randint(1, 9))]
        total = sum(sizes)
        n = rng.randint(1, max(1, total)) if total else 0
        quota, turn = rng.randint(0, 3 * n), rng.getrandbits(63) - (1 << 62)
        times = []
        for i in range(n):
            take = quota // n + ((i * M.STRIDE + turn % n) % n < quota % n)
            times += [take] * ((i + 1) * total // n - i * total // n)
        at = 0
        for k, words in enumerate(sizes):
            rows.append((line, k, at, words, n, total, quota, turn))
            want[line, k] = sum(times[at:at + words])
            at += words
    df = spark.createDataFrame(rows, "line int, k int, at long, words long, blocks long, shard_words long, quota long, turn long")
    assert {(r.line, r.k): r.t for r in df.select("line", "k", M._taken().alias("t")).collect()} == want


def check(rows, tolerance=40):
    """Nothing above three times its size; every source near its target."""
    by_source = defaultdict(list)
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        by_source[r.source].append(r)
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    sizes = [sum(r["size"] for r in by_source[s]) for s in names]
    for s, size, target in zip(names, sizes, plain_targets(sizes, [(1, 2, 3)[i % 3] for i in range(len(names))])):
        assert {r.source_size for r in by_source[s]} == {size}
        assert all(r.target == pytest.approx(float(target)) for r in by_source[s])
        assert abs(sum(r.taken for r in by_source[s]) - target) <= tolerance, s
    return by_source


def sources(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows], "doc_id long, text string, source string, place string, size int")


def test_null_and_odd_sources_copies_and_wordless_texts(spark, monkeypatch):
    monkeypatch.setattr(M, "SHARD_ROWS", 2)
    rows = [(i, t, (None, "b", "é", "Z")[k % 4]) for k, (i, t) in enumerate(EDGE_ROWS)] + \
           [(100, "same row again " * 9, "b")] * 7 + [(200 + i, "w " * i, "tiny") for i in range(40)]
    got = M.mix(sources(spark, rows)).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((r.doc_id or -1, r["size"], r.source or "") for r in got) == sorted((i or -1, count(t), s or "") for i, t, s in rows)
    check(got)
    again = M.mix(sources(spark, rows[::-1]).repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_empty_and_wordless_tables(spark):
    assert M.mix(sources(spark, [])).collect() == []
    got = M.mix(sources(spark, [(1, None, "a"), (2, " ", None)])).collect()
    assert [(r["size"], r.source_size, r.target, r.taken) for r in got] == [(0, 0, 0.0, 0)] * 2


def test_whole_table(spark, monkeypatch):
    monkeypatch.setattr(M, "SHARD_ROWS", 16)
    df = M.op13_mixing(spark, "/root/testdata/sf0.01")
    assert df.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    rows = df.collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.01/documents.parquet").count()
    check(rows, tolerance=250)
    assert len({r.shard for r in rows}) > 1
