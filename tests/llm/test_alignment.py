"""op12 against the tokenizers as loaded and a loop over bytes."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from patronage.llm import alignment as L
from tests.llm.conftest import EDGE_ROWS


@pytest.fixture(scope="module")
def both():
    a = Tokenizer.from_file(P.path(L.A_NAME))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path(L.B_NAME))


def tokens(both, text):
    """(id, start, end) lists in bytes, or nothing."""
    a, b = both
    if not text:
        return [], []
    data = (" " + text).encode()
    letters = {v: k for k, v in L.byte_letters().items()}
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    a_parts = [bytes(letters[c] for c in a.id_to_token(i)) if i != 50256 else b"?" for i in a_ids]
    b_ids = b.encode(text)
    b_parts = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    if b"".join(a_parts) != data or b"".join(b_parts) != data:
        return [], []
    out = []
    for ids, parts in ((a_ids, a_parts), (b_ids, b_parts)):
        at, side = 0, []
        for i, p in zip(ids, parts):
            side.append((i, at, at + len(p)))
            at += len(p)
        out.append(side)
    return out


def brute(both, docs):
    found, counts = [], Counter()
    for i, text in docs:
        a, b = tokens(both, text)
        links, k = [], 0
        for x, s, e in a:
            while k and b[k][1] > s:
                k -= 1
            while k < len(b) and b[k][2] <= s:
                k += 1
            m = k
            while m < len(b) and b[m][1] < e:
                links.append((x, b[m][0]))
                m += 1
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, s = [], 0
        for e in ends:
            groups.append(",".join(str(x) for x, f, _ in a if s <= f < e) + "|" + ",".join(str(x) for x, f, _ in b if s <= f < e)
                          if len(ends) < 300 else None)
            s = e
        counts.update(set(links))
        found.append((i, len(a), len(b), len(groups), links, groups))
    top = Counter()
    for (x, _), n in counts.items():
        top[x] = max(top[x], n)
    return sorted(((i, na, nb, len(g), len(ls), sum(counts[p] == top[p[0]] for p in ls), sum(counts[p] for p in ls),
                    "skip" if None in g else hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
                   for i, na, nb, _, ls, g in found), key=str)


def ours(df, want):
    skipped = {(r[0], r[1], r[2]) for r in want if r[-1] == "skip"}
    return sorted(((*r[:7], "skip" if (r.doc_id, r.n_a, r.n_b) in skipped else r.groups_sha256) for r in df.collect()), key=str)


def test_pieces_of_any_size_merge_like_sets():
    rng = random.Random(1)
    for n in (1, 2, 17, 300):
        for _ in range(20):
            a, b = (np.array(sorted(rng.sample(range(1, n), rng.randint(0, n - 1)) + [n])) for _ in range(2))
            want = [(i, j) for i in range(len(a)) for j in range(len(b))
                    if max(a[i - 1] if i else 0, b[j - 1] if j else 0) < min(a[i], b[j])]
            common = sorted(set(a.tolist()) & set(b.tolist()))
            for piece in (1, 2, 3, 7, 1000):
                la, lb, ea, eb = L.align_ends(a, b, piece)
                assert sorted(zip(la.tolist(), lb.tolist())) == want
                assert a[ea - 1].tolist() == common == b[eb - 1].tolist()
                i, j = L.merge_path(a, b, piece)
                assert (np.diff(i + j)[:-1] == piece).all() and (np.diff(i) >= 0).all() and (np.diff(j) >= 0).all()


TEXTS = ["a  b", " lead", "trail  ", "   ", " ", "x▁y", "tab\tand\nline", "a b　c", "<s> hi </s> <unk> <0x41>", "<|endoftext|> z",
         "\x00nul", "é", "ﬁ ½ ①", "日本語 テキスト", "🙂🙃 ok", "word" * 40, "1234567890", "it's they'LL", "\r\n\r\n", "'" * 9, "é" * 50]


def test_edges_equal_brute_force(spark, both, make_docs):
    rows = [r for r in EDGE_ROWS if not (r[1] and len(r[1]) > 50000)] + [(100 + i, t) for i, t in enumerate(TEXTS)] + [(7, "word " * 300), (8, "x" * 700)]
    want = brute(both, rows)
    assert ours(L.alignment_counts(make_docs(rows)), want) == want
    assert sum(r[1] == 0 for r in want) >= 3


def test_long_texts_and_empty_table(spark, both, make_docs):
    rows = [(1, "word " * 30000), (2, "x" * 100000)]
    want = brute(both, rows)
    assert ours(L.alignment_counts(make_docs(rows)), want) == want
    assert L.alignment_counts(make_docs([])).collect() == []


@pytest.mark.parametrize("links", [1 << 21, 700])
def test_whole_table_equals_brute_force(spark, both, monkeypatch, links):
    monkeypatch.setattr(L, "BUCKET_LINKS", links)
    folder = "/root/testdata/sf0.001"
    want = brute(both, [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()])
    got = L.op12_alignment(spark, folder)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert ours(got, want) == want


def test_real_outputs_give_the_text_back(spark, both, make_docs):
    text = "Merging naïve tokenizations, 1234 ways!"
    row = L.align(make_docs([(1, text)])).first()
    number = lambda x: np.frombuffer(x, "<u4").tolist()
    assert number(row.a_ids) == both[0].encode(" " + text, add_special_tokens=False).ids
    assert number(row.b_ids) == both[1].encode(text)
    a, b = tokens(both, text)
    for i, j in zip(number(row.link_a), number(row.link_b)):
        assert max(a[i][1], b[j][1]) < min(a[i][2], b[j][2])
    for i, j in zip(number(row.a_group_ends), number(row.b_group_ends)):
        assert a[i - 1][2] == b[j - 1][2]
