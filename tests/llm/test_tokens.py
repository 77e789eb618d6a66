import base64
import hashlib
import random
import zlib
from array import array
from collections import defaultdict

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from patronage.llm import bpe, packing
from tests.llm.conftest import EDGE_ROWS, TESTDATA

ODD = ["", " ", "  a  b", "don't we'll I'D", "a\n\n b \t", "\x1c\x1d x\x1f\x85y\xa0 z", "1234 five6", "<|endoftext|> x", "你好 мир é́", "x" * 5000, " " * 300, "ab\n  cd", "\U0001f600\U0001f600!!"]


@pytest.fixture(scope="module")
def tik():
    with open(P.path(bpe.RANKS), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def hf():
    t = Tokenizer.from_file(P.path(packing.TOKENIZER))
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def as_loaded():
    return Tokenizer.from_file(P.path(packing.TOKENIZER))


@pytest.fixture(scope="module")
def texts(spark):
    return ODD + [r.text for r in spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("text").collect()]


def test_units_encode_like_the_libraries(tik, hf, texts):
    multi, plain = bpe.unit_ids(P.path(bpe.RANKS)), packing.unit_ids(P.path(packing.TOKENIZER))
    for t in texts:
        assert array("I", multi.text_ids(t)).tolist() == tik.encode_ordinary(t)
        assert array("I", plain.text_ids(t)).tolist() == hf.encode(t, add_special_tokens=False).ids


def whole_ids(texts):
    return [array("I", x).tolist() for x in packing.texts_ids(P.path(packing.TOKENIZER), texts)]


def test_added_tokens_are_taken_as_the_tokenizer_does(as_loaded):
    end = "<|endoftext|>"
    rows = ["a <|endoftext|> x", end, end * 3, f"{end} lead", f"trail {end}", f" \n{end}\n ", "<|endoftext", f"<{end}|>", f"x{end}y{end}"]
    assert whole_ids(rows) == [as_loaded.encode(t, add_special_tokens=False).ids for t in rows]
    assert whole_ids([rows[0]]) == [[64, 220, 50256, 2124]]


def test_whole_texts_encode_like_the_tokenizer(as_loaded, texts, monkeypatch):
    more = texts + ["ab " * 5 + "y" * 2500 + " z", "a" + " " * 2500 + "b", "\n" * 1500, "1" * 1200, "é" * 999 + " " + "é" * 1001]
    assert whole_ids(more) == [as_loaded.encode(t, add_special_tokens=False).ids for t in more]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=20), st.text("aei rst.\n'\x1c\x85\u2028<|>", max_size=30), st.just("<|endoftext|>")), max_size=5))
def test_any_texts_encode_like_the_tokenizer(as_loaded, parts):
    assert whole_ids([*parts, "".join(parts)]) == [as_loaded.encode(t, add_special_tokens=False).ids for t in [*parts, "".join(parts)]]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text("aeinrst hTé.\n'", max_size=60), st.binary(max_size=30).map(lambda b: b.decode("latin-1"))))
def test_any_text_encodes_like_the_libraries(tik, hf, text):
    assert array("I", bpe.unit_ids(P.path(bpe.RANKS)).text_ids(text)).tolist() == tik.encode_ordinary(text)
    assert array("I", packing.unit_ids(P.path(packing.TOKENIZER)).text_ids(text)).tolist() == hf.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text("abc é the", min_size=0, max_size=30), st.lists(st.tuples(st.integers(0, 60), st.integers(0, 9), st.text("ab \n.x", max_size=6)), max_size=6))
def test_edits_equal_a_fresh_encoding(text, edits):
    known = bpe.unit_ids(P.path(bpe.RANKS))
    edited = bpe.EditedText(known, text)
    for start, length, new in edits:
        start = min(start, len(text))
        end = min(start + length, len(text))
        edited.replace(start, end, new)
        text = text[:start] + new + text[end:]
        assert edited.text() == text
        assert edited.ids() == array("I", known.text_ids(text)).tolist()


def test_an_edit_touches_few_units():
    edited = bpe.EditedText(bpe.unit_ids(P.path(bpe.RANKS)), "some words " * 500)
    assert edited.replace(2500, 2502, "zz") <= 5


def test_appends_equal_whole_encodings(tik):
    vocabulary = bpe.unit_ids(P.path(bpe.RANKS)).vocabulary
    rng = random.Random(1)
    for _ in range(100):
        grown, data = bpe.GrowingMatch(vocabulary), b""
        for _ in range(6):
            more = "".join(rng.choices("theraniongsé", k=rng.randrange(6))).encode()
            grown.append(more)
            data += more
            assert grown.ids() == vocabulary.encode(data)
            assert b"".join(vocabulary.tokens[i] for i in grown.ids()) == data
        grown.shorten(len(data) // 2)
        assert grown.ids() == vocabulary.encode(data[:len(data) // 2])


def test_op2_rows(spark, edge_docs, tik):
    got = bpe.decode(bpe.encode(edge_docs)).collect()
    assert sorted(map(str, bpe.round_trip(edge_docs).collect())) == sorted(map(str, got))
    want = sorted((str(i), tik.encode_ordinary(t or ""), (t or "").encode()) for i, t in EDGE_ROWS)
    assert sorted((str(r.doc_id), array("I", bytes(r.ids)).tolist(), bytes(r.decoded)) for r in got) == want


def test_op2_on_the_table(spark, tik):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").collect()}
    got = bpe.op2_bpe(spark, f"{TESTDATA}/sf0.01").collect()
    assert len(got) == len(rows)
    for r in got:
        ids = tik.encode_ordinary(rows[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((rows[r.doc_id] or "").encode()).hexdigest()


def test_piece_lengths():
    for n in [1, 2, 3, 1023, 1024, 1025, 5000]:
        p = packing.piece_lengths(n)
        assert sum(p) == n and all(x & (x - 1) == 0 and x <= 1024 for x in p) and p == sorted(p, reverse=True)
        assert len(p) == n // 1024 + bin(n % 1024).count("1")


def check_packing(rows, got, hf):
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert len({r.sequence_id for r in got}) == len(got)
    for i, t in rows.items():
        ids = hf.encode(t or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(by[i], key=lambda r: r.start):
            body = array("I", ids[r.start:r.start + r.length]).tobytes()
            assert r.start == at and r.offset == 0 and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(body)
            assert 1 << r.bucket == r.length <= 1024 and r.sequence_id % 16 == r.bucket
            at += r.length
        assert at == len(ids)


def test_op1_on_the_table_and_edges(spark, make_docs, hf):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").collect()}
    check_packing(rows, packing.op1_packing(spark, f"{TESTDATA}/sf0.01").collect(), hf)
    edge = dict((i, t) for i, t in EDGE_ROWS)
    check_packing(edge, packing.digest(packing.pack(make_docs(list(edge.items())))).collect(), hf)
    assert packing.pack(make_docs([])).count() == 0 and bpe.encode(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        packing.pack(make_docs([]), longest=1000)


def test_buckets_on_disk(spark, edge_docs, tmp_path):
    packed = packing.pack(edge_docs)
    packing.write_buckets(packed, str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b"))
    assert back.count() == packed.count()
    assert all(1 << r.bucket == r.length for r in back.collect())
