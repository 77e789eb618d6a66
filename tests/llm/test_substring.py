import glob
import random
import time

import numpy as np
import pyarrow as pa
import pytest

from patronage.llm import common
from patronage.llm import substring as sub
from patronage.llm.substring import repeated_passages, shingles, similar_stretches, without_words
from tests.llm.conftest import EDGE_ROWS, TESTDATA


def brute_windows(x, which, least):
    h = sub.min_hash(x, which)
    key = [(int(v) >> 32, i) for i, v in enumerate(h)]
    out = set()

    def grow(lo, hi):
        if hi - lo + 1 < least:
            return
        m = min(range(lo, hi + 1), key=key.__getitem__)
        out.add((lo, m, hi))
        grow(lo, m - 1)
        grow(m + 1, hi)
    grow(0, len(x) - 1)
    return out


@pytest.mark.parametrize("least", [1, 2, 7, 46])
def test_compact_windows_equal_the_recursive_definition(least):
    rng = random.Random(least)
    docs = [np.array([rng.choice([rng.getrandbits(64), 5, 6]) for _ in range(n)], np.uint64) for n in (0, 1, 45, 46, 47, 200, 400)]
    docs = [d if len(d) >= least else d[:0] for d in docs]
    d, left, place, right, _ = sub.compact_windows(docs, 1, least)
    for k, x in enumerate(docs):
        got = {(a, b, c) for i, a, b, c in zip(d.tolist(), left.tolist(), place.tolist(), right.tolist()) if i == k}
        assert got == brute_windows(x, 1, least)


def words(rng, n):
    return [f"w{rng.randrange(100000)}" for _ in range(n)]


def test_similar_stretches():
    rng = random.Random(1)
    p = words(rng, 80)
    x, y = shingles([w.encode() for w in words(rng, 30) + p + words(rng, 30)]), shingles([w.encode() for w in words(rng, 7) + p + words(rng, 99)])
    assert similar_stretches(x, y) == [(30, 105, 7, 82)]
    q = list(p)
    q[40] = "changed"
    z = shingles([w.encode() for w in q])
    (s, e, s2, e2), = similar_stretches(x, z)
    assert (s, e, s2, e2) == (30, 105, 0, 75)
    assert similar_stretches(x, shingles([w.encode() for w in p[:49]])) == []
    assert len(similar_stretches(x, shingles([w.encode() for w in p[:50]]))) == 1
    far = [w if k % 6 else "other" for k, w in enumerate(p)]
    assert similar_stretches(x, shingles([w.encode() for w in far])) == []


def flagged(docs):
    rows = repeated_passages(docs).collect()
    return rows, {r.doc_id for r in rows}, {r.doc_id for r in rows if not r.kept}


def test_planted_passages_are_found_and_clean_documents_left_alone(make_docs):
    rng = random.Random(2)
    rows = [(k, " ".join(words(rng, rng.randrange(10, 400)))) for k in range(200)]
    line = " ".join(words(rng, 20))
    rows = [(k, t + " " + line) for k, t in rows]  # a common line is no passage
    planted = {}
    for n, where in ((51, (3, 50, 77)), (60, (199, 4)), (300, (10, 11, 12, 13)), (120, (100, 150))):
        p = words(rng, n)
        for k, d in enumerate(where):
            q = list(p)
            if n >= 120 and k:
                q[n // 2] = "edited"
            a, b = words(rng, rng.randrange(40)), words(rng, rng.randrange(40))
            rows[d] = (d, "  ".join(a) + "\n" + " ".join(q).upper() + " " + " ".join(b))
            planted.setdefault(tuple(where), {})[d] = (len(a), len(a) + n)
    rows += [(1000, rows[20][1]), (1001, rows[20][1].replace(" ", "\n"))]
    got, every, later = flagged(make_docs(rows))
    long20 = len(rows[20][1].split()) >= 50
    assert every == {3, 50, 77, 199, 4, 10, 11, 12, 13, 100, 150} | ({20, 1000, 1001} if long20 else set())
    assert later == {50, 77, 199, 11, 12, 13, 150} | ({1000, 1001} if long20 else set())
    for where in planted.values():
        for d, (s, e) in where.items():
            if d in later:
                r, = [r for r in got if r.doc_id == d and not r.kept]
                assert abs(r.start_word - s) <= 5 and abs(r.end_word - e) <= 5 and r.source_doc_id == min(where)


def flagged_words(rows):
    out = {}
    for r in rows:
        if not r.kept:
            out.setdefault(r.doc_id, set()).update(range(r.start_word, r.end_word))
    return out


def lines_of(rng, total):
    """A passage made of lines too short to be passages themselves."""
    out = []
    while sum(map(len, out)) < total:
        out.append(words(rng, rng.randrange(15, 41)))
    return out


def test_passages_of_stock_lines_are_found(make_docs):
    rng = random.Random(8)
    rows, want = [], {}
    for k in range(300):
        lines = lines_of(rng, rng.randrange(60, 91))
        for line in lines:
            for _ in range(rng.randrange(1, 6)):
                rows.append((len(rows), " ".join(words(rng, rng.randrange(60)) + line + words(rng, rng.randrange(60)))))
        p = sum(lines, [])
        for i in range(2):
            before = words(rng, rng.randrange(60))
            rows.append((100000 + 2 * k + i, " ".join(before + p + words(rng, rng.randrange(60)))))
        want[100000 + 2 * k + 1] = set(range(len(before), len(before) + len(p)))
    got = flagged_words(repeated_passages(make_docs(rows)).collect())
    assert [d for d, w in want.items() if not w <= got.get(d, set())] == []
    assert set(got) == set(want)


def test_lines_that_stand_several_times_in_the_smaller_document(make_docs):
    rng = random.Random(9)
    rows, want = [], {}
    for k in range(200):
        lines = lines_of(rng, rng.randrange(60, 91))
        p, single = sum(lines, []), [line for line in lines for _ in range(rng.randrange(1, 6))]
        rng.shuffle(single)
        half = len(single) // 2
        alone = [sum((line + words(rng, 20) for line in part), []) for part in (single[:half], single[half:])]
        rows.append((2 * k, " ".join(alone[0] + p + words(rng, 20) + alone[1])))
        rows.append((2 * k + 1, " ".join(words(rng, 30) + p + words(rng, 30))))
        want[2 * k + 1] = set(range(30, 30 + len(p)))
    got = flagged_words(repeated_passages(make_docs(rows)).collect())
    assert [d for d, w in want.items() if not w <= got.get(d, set())] == []


def test_near_copies_of_short_passages_are_found(make_docs):
    rng = random.Random(5)
    rows, want = [], set()
    for k in range(1500):
        p = words(rng, 51)
        q = list(p)
        q[rng.randrange(5, 46)] = "edited"
        x, y = (set(shingles([w.encode() for w in v]).tolist()) for v in (p, q))
        if len(x & y) >= 0.8 * len(x | y):
            want.add(2 * k + 1)
        rows += [(2 * k + i, " ".join(words(rng, rng.randrange(40)) + v + words(rng, rng.randrange(40)))) for i, v in enumerate((p, q))]
    _, _, later = flagged(make_docs(rows))
    assert len(want) > 1400 and later <= want
    assert len(want - later) <= 2


def test_no_copy_is_lost_and_removal_leaves_the_rest(make_docs):
    rng = random.Random(3)
    p = words(rng, 70)
    rows = [(k, " ".join(words(rng, 5) + p + words(rng, 5))) for k in range(30)]
    got = repeated_passages(make_docs(rows)).collect()
    texts = dict(rows)
    left = {i: without_words(t, [(r.start_word, r.end_word) for r in got if r.doc_id == i and not r.kept]) for i, t in texts.items()}
    assert left[0] == texts[0] and sum(" ".join(p[10:60]) in t for t in left.values()) == 1
    assert all(len(left[i].split()) == 10 for i in range(1, 30))


def test_without_words():
    assert without_words(" a b\tc  d\n", [(1, 3)]) == " a d\n"
    assert without_words("a b c", [(0, 9)]) == "" and without_words("a b", [(5, 9)]) == "a b" and without_words("é ü x", [(1, 2)]) == "é x"


def test_edges(make_docs):
    rows = [(i, t) for i, t in EDGE_ROWS] + [(70, "word " * 60), (None, "word " * 80)]
    got, every, later = flagged(make_docs(rows))
    assert every == {7, 70} and later == {70}
    assert repeated_passages(make_docs([])).count() == 0
    same = " ".join(f"x{k}" for k in range(80))
    assert repeated_passages(make_docs([(5, same), (5, same)])).count() == 0


def test_op10_finds_every_long_shared_run(spark):
    """Brute force: documents that share 46 consecutive shingles with another."""
    sf = f"{TESTDATA}/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    runs = {}
    for i, t in rows:
        x = shingles(sub.words_of(t or ""))
        for k in range(len(x) - sub.LEAST + 1):
            runs.setdefault(x[k:k + sub.LEAST].tobytes(), set()).add(i)
    want = {i for docs in runs.values() if len(docs) > 1 for i in docs}
    later = {i for docs in runs.values() for i in docs if i > min(docs)}
    got = sub.op10_substring(spark, sf).collect()
    assert want and want <= {r.doc_id for r in got}
    assert later <= {r.doc_id for r in got if not r.kept}
    texts = {i: shingles(sub.words_of(t or "")) for i, t in rows}
    for r in got:  # every reported passage shares most shingles with some other document
        mine = set(texts[r.doc_id][r.start_word:r.end_word - sub.SHINGLE + 1].tolist())
        assert r.end_word - r.start_word >= sub.LEAST_WORDS
        if not r.kept:
            rest = set().union(*(texts[i].tolist() for i, _ in rows if i < r.doc_id))
            assert len(mine & rest) >= 0.8 * len(mine)


def test_run_hashes_and_bounds_equal_their_plain_forms():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 2**63, 90).astype(np.uint64)
    for least in (1, 5, 46):
        for k, got in enumerate(sub.run_hashes(x, least).tolist()):
            want = 0
            for v in x[k:k + least].tolist():
                want = (want * int(sub.STEP) + v) % 2**64
            assert got == want ^ want >> 29
    keys, places = rng.permutation(60), np.sort(rng.choice(400, 60, replace=False))
    start, end = places // 100 * 100, places // 100 * 100 + 100
    left, right = sub.tree_bounds(keys, places, start, end)
    for i in range(60):
        lower = [int(places[j]) for j in range(60) if keys[j] < keys[i]]
        assert left[i] == max([p + 1 for p in lower if p < places[i]] + [start[i]])
        assert right[i] == min([p - 1 for p in lower if p > places[i]] + [end[i] - 1])


def test_regions_of_joined_rows_equal_those_of_single_rows():
    rng = np.random.default_rng(6)
    rows = []
    for pair in range(200):
        for _ in range(rng.integers(1, 40)):
            p = int(rng.integers(0, 400))
            q = max(0, p - int(rng.choice([0, 0, 3, 40])))
            rows.append((pair // 3 + 5, pair % 3, p << 16 | int(rng.integers(0, 65536)), q << 16 | int(rng.integers(0, 65536))))
    rows.sort()

    def found(size):
        names = ["b", "a", "w", "aw"]
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i:i + size], strict=True)], names) for i in range(0, len(rows), size)]
        return [tuple(r.values()) for x in sub._regions(batches) for r in x.to_pylist()]
    assert found(10_000) == found(1)


def test_results_leave_no_shuffle_files(spark):
    def files():
        dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}
    for kept in (common.cut, common.written):
        before = files()
        out = kept(spark.range(1000).repartition(3, "id"))
        for _ in range(50):
            if not files() - before:
                break
            time.sleep(0.1)
        assert not files() - before and out.count() == 1000
        assert spark.conf.get(common.FREED, None) is None


def test_long_texts_reach_python_in_batches_of_few_bytes(spark, tmp_path):
    before = spark.conf.get(common.BATCH, None)
    try:
        spark.conf.unset(common.BATCH)
        spark.range(1).write.parquet(f"{tmp_path}/documents.parquet")
        common.table(spark, str(tmp_path), "documents")
        long = spark.range(200, numPartitions=1).selectExpr("id", "repeat('x', 200000) text")
        sizes = long.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches), "n long").collect()
        assert max(r.n for r in sizes) <= 2 * common.BATCH_BYTES
        spark.conf.set(common.BATCH, "1000000")
        common.table(spark, str(tmp_path), "documents")
        assert spark.conf.get(common.BATCH) == "1000000"
    finally:
        spark.conf.unset(common.BATCH)
        if before is not None:
            spark.conf.set(common.BATCH, before)
