import random
import re
import zlib
from array import array
from collections import defaultdict

import public_tokenizers as P
from tokenizers import Tokenizer

import corpus_pipeline
from patronage.llm import quality, substring
from patronage.llm.exact_dedup import without_copies
from patronage.llm.simhash import without_near_copies
from tests.llm.conftest import EDGE_ROWS
from tests.llm.test_exact_and_simhash import brute_exact, slow_components, slow_fingerprint

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp string"


def words(rng, n):
    return [f"{rng.choice(['ab', 'cd', 'ef'])}{rng.randrange(5000)}" for _ in range(n)]


def corpus(rng):
    rows = {k: " ".join(words(rng, rng.randrange(30, 160))) + "." for k in range(120)}
    for k in range(120, 160):
        rows[k] = " ".join(w.upper() + "!!" for w in words(rng, 60))
    for k in range(160, 175):
        rows[k] = rows[k - 160].replace(" ", "  ")
    for k in range(175, 190):
        w = words(rng, 900)
        rows[k] = " ".join(w)
        w[450] = "edit"
        rows[k + 20] = " ".join(w)
    p = " ".join(words(rng, 70))
    for k in (30, 40, 50):
        rows[k] += " " + p + " " + " ".join(words(rng, 9))
    return rows


def test_pipeline_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    rows = corpus(rng)
    spark.createDataFrame([(i, t, "en", "s", len(t), "k", "f") for i, t in rows.items()], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 0 if "!!" in t else 1, 0) for i, t in rows.items()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()

    left = {i: t for i, t in rows.items() if "!!" not in t}
    left = {r[0]: left[r[0]] for r in brute_exact(list(left.items())) if r[3]}
    ids = sorted(left)
    roots = slow_components([slow_fingerprint(left[i]) for i in ids], lambda a, b: (a ^ b).bit_count() <= 3)
    left = {ids[k]: left[ids[k]] for k in range(len(ids)) if roots[k] == k}
    assert not set(range(15)) & set(left) and sum(i >= 195 for i in left) < 15
    known, later = {}, defaultdict(list)
    for i in sorted(left):  # exact shared runs of 50 words or more
        w = left[i].lower().split()
        mine = [" ".join(w[k:k + 50]) for k in range(len(w) - 49)]
        for k, run in enumerate(mine):
            if known.setdefault(run, i) != i:
                later[i].append((k, k + 50))
    assert set(later) >= {40, 50}
    hf = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    near = {i for i in left if i >= 195}  # edited twins that SimHash left apart lose what they share
    for i, t in left.items():
        if i in near:
            continue
        rest = substring.without_words(t, later[i])
        ids = hf.encode(rest, add_special_tokens=False).ids + [0]
        pieces = sorted(by[i], key=lambda r: r.start)
        assert sum(r.length for r in pieces) == len(ids) == pieces[0].doc_tokens
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(array("I", ids[r.start:r.start + r.length]).tobytes())
    assert set(by) <= set(left)


def test_stages_on_edges_and_empty_tables(spark, make_docs, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([(4, 0, 0), (5, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    for docs in (make_docs(EDGE_ROWS), make_docs([])):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            assert docs.columns == columns, name
            docs.collect()
        corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()


def test_filters_keep_columns_and_leave_repeats_once(make_docs):
    rows = [(1, "same text here"), (1, "same text here"), (2, "same  text here"), (3, None), (None, ""), (4, "other words")]
    got = sorted(((r.doc_id, r.text, r.kept, r.fp) for r in without_copies(make_docs(rows)).collect()), key=str)
    assert got == sorted([(2, "same  text here", "x", "y"), (3, None, "x", "y"), (4, "other words", "x", "y")], key=str)
    got = {r.doc_id for r in without_near_copies(make_docs(rows)).collect()}
    assert got == {1, 3, 4}


def test_substring_stage_renews_n_chars(make_docs):
    p = " ".join(f"w{k}" for k in range(60))
    got = {r.doc_id: r for r in substring.without_repeats(make_docs([(1, p), (2, "head " + p + " tail"), (3, p), (4, None)])).collect()}
    assert set(got) == {1, 2, 4} and got[2].text == "head tail" and got[2].n_chars == 9 and got[1].n_chars == 0
    assert re.search("head", got[2].text)


def test_quality_filter_matches_the_scores(spark, edge_docs):
    labels = spark.createDataFrame([(4, 0), (5, 1), (9, 1)], "doc_id long, quality int")
    model = quality.learn(edge_docs, labels, "true")
    want = sorted(str(r.doc_id) for r in quality.scores(edge_docs, model).where("predicted = 1").collect())
    assert sorted(str(r.doc_id) for r in quality.accepted(edge_docs, model).collect()) == want


def test_an_id_with_several_texts_keeps_only_what_stays(make_docs):
    def left(f, rows):
        return sorted(((r.doc_id, r.text) for r in f(make_docs(rows)).collect()), key=str)
    rows = [(0, "same text b"), (1, "alpha longer text"), (1, "same text b"), (2, "same  text b"), (2, "other"), (None, "other"), (None, "own"), (None, "own")]
    assert left(without_copies, rows) == [(1, "alpha longer text"), (2, "other"), (2, "same  text b"), (None, "own")]
    assert left(without_copies, [(5, "ab"), (5, "a b"), (5, "a b"), (5, None), (5, "")]) in ([(5, ""), (5, "a b")], [(5, None), (5, "a b")])
    near = "one two three four five six seven eight nine ten " * 8
    rows = [(0, near), (1, near + "x"), (1, "something else entirely here"), (3, near), (3, near + "x"), (None, near), (None, "no id at all"), (None, "no id at all")]
    assert left(without_near_copies, rows) == [(0, near), (1, "something else entirely here"), (None, "no id at all")]
    twice = left(without_near_copies, [(0, near), (0, near + "x")])
    assert len(twice) == 1
