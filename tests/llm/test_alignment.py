"""Alignment of two tokenizers against the libraries over whole texts and a plain merge."""

import hashlib
import random
import sys
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm.conftest import prose
from tidemark.llm import alignment, queries


@pytest.fixture(scope="module")
def files():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        return spec, f.read()


class Plain:
    def __init__(self, files):
        self.a = Tokenizer.from_str(files[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files[1])
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        letters = {chr(c): c for c in plain}
        for i, c in enumerate(c for c in range(256) if c not in plain):
            letters[chr(0x100 + i)] = c
        self.letters = letters

    def tokens(self, text):
        if not text:
            return [], []
        a = [(i, bytes(self.letters[c] for c in self.a.id_to_token(i))) for i in self.a.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in self.b.encode(text):
            piece = self.b.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])

    def rows(self, docs):
        out, count = [], Counter()
        for doc_id, text in docs:
            a, b = self.tokens(text)
            ends = [np.cumsum([len(x) for _, x in t]).tolist() for t in (a, b)]
            cuts = sorted(set(ends[0]) & set(ends[1]))
            groups, links, low = [], [], 0
            for cut in cuts:
                own = [[i for i, (_, x) in enumerate(t) if low < e[i] <= cut] for t, e in zip((a, b), ends)]
                groups.append("|".join(",".join(str(t[i][0]) for i in o) for t, o in zip((a, b), own)))
                for i in own[0]:
                    for j in own[1]:
                        if ends[0][i] - len(a[i][1]) < ends[1][j] and ends[1][j] - len(b[j][1]) < ends[0][i]:
                            links.append((a[i][0], b[j][0]))
                low = cut
            count.update(links)
            out.append((doc_id, len(a), len(b), groups, links))
        top = {}
        for (_, b), n in count.items():
            top[b] = max(top.get(b, 0), n)
        return [
            (
                doc_id, n_a, n_b, len(groups), len(links),
                sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
                hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "",
            )
            for doc_id, n_a, n_b, groups, links in out
        ]


def awkward():
    pick = random.Random(11)
    signs = [" ", "  ", "\n", "\t", " ", "　", " ", "é", "ß", "中", "😀", "a", "Th", "1", ".", "<s>", "'s", "\x00", "\x85", "‍"]
    noise = ["".join(pick.choice(signs) for _ in range(n)) for n in (1, 2, 3, 5, 8, 13, 40, 200, 900) for _ in range(12)]
    fixed = [
        None, "", " ", "   ", "\n", " leading", "trailing ", "two  spaces\n  and lines", "<|endoftext|> stays text", "▁ is lost",
        "</s>[INST] ok [/INST]", "Ünïcödé naïve café", "日本語のテキスト", "x" * 3000, " " * 700 + "y" * 90 + " " * 5, "é İ",
    ]
    return fixed + noise + [prose(1, 4000), prose(2, 10), prose(2, 10)]


def of(df):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_alignment_on_awkward_texts(spark, docs_of, files):
    texts = awkward()
    ids = [*range(len(texts) - 2), None, 0]
    expected = Plain(files).rows(list(zip(ids, texts)))
    assert of(alignment.digest(docs_of(texts, ids).repartition(3), *files)) == sorted(expected, key=repr)
    assert sum(1 for r in expected if r[1]) > 100 and any(r[1] == 0 for r in expected)
    assert alignment.digest(docs_of([]), *files).count() == 0
    none = alignment.digest(docs_of([None, ""]), *files).collect()
    assert [tuple(r)[1:] for r in none] == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_blocks_that_close_early_change_nothing(files, spark, docs_of, monkeypatch):
    texts = [prose(k, 60) for k in range(40)]
    expected = sorted(Plain(files).rows(list(enumerate(texts))), key=repr)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 1)
    assert of(alignment.digest(docs_of(texts).coalesce(1), *files)) == expected


def test_links_are_spans_that_overlap(spark, docs_of, files):
    text = "naïve tokens überlappen\n sich"
    row, none = alignment.links(docs_of([text, None]), *files).orderBy("doc_id").collect()
    a, b = Plain(files).tokens(text)
    assert row.a_ids == [i for i, _ in a] and row.b_ids == [i for i, _ in b]
    ends = [np.cumsum([len(x) for _, x in t]).tolist() for t in (a, b)]
    assert row.cuts == sorted(set(ends[0]) & set(ends[1]))
    starts = [[e - len(x) for e, (_, x) in zip(es, t)] for es, t in zip(ends, (a, b))]
    meet = [(i, j) for i in range(len(a)) for j in range(len(b)) if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]]
    assert sorted(zip(row.link_a, row.link_b)) == meet
    assert [none.a_ids, none.b_ids, none.cuts, none.link_a] == [[]] * 4


def test_lanes_do_not_show(files, monkeypatch):
    tokenizers, column = alignment.Pair(*files), pa.array([prose(3, 900), "", "y" * 500, None, prose(4, 3)])
    whole = alignment.aligned(column, tokenizers)
    monkeypatch.setattr(alignment, "LANE", 7)
    cut = alignment.aligned(column, tokenizers)
    for name in ("link_a", "link_b", "cut", "bounds_links"):
        assert (getattr(whole, name) == getattr(cut, name)).all()


def test_merges_by_rank_are_those_of_the_library(files):
    tokenizers = alignment.Pair(*files)
    assert tokenizers._ranked is not None
    words = list({f" {w}" for t in awkward() if t for w in t.split() if len(w) < 40 and alignment._sure(f" {w}".encode())})
    many = tokenizers._many([w.encode() for w in words])
    tokenizers._ranked = None
    assert many == tokenizers._many([w.encode() for w in words])


def test_the_registered_query(spark, docs_of, files, tmp_path):
    texts = [prose(k % 5, 30 + k) for k in range(20)] + [None, ""]
    docs_of(texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = of(queries.QUERIES["op11_cross_tokenizer_alignment"](spark, str(tmp_path)))
    assert got == sorted(Plain(files).rows(list(enumerate(texts))), key=repr)


def test_the_cache_stays_small(files):
    def held(x):
        return sys.getsizeof(x) + (sum(map(held, x)) if isinstance(x, tuple) else 0)

    tokenizers = alignment.Pair(*files)
    for low in range(0, 420_000, 30_000):
        tokenizers.of([f" w{i}".encode() for i in range(low, low + 30_000)])
    halves = (tokenizers._cache, tokenizers._older)
    assert sum(held(half) + sum(held(k) + held(v) for k, v in half.items()) for half in halves) < 60 << 20


def test_pieces_of_a_slice_do_not_show(files, spark, docs_of, monkeypatch):
    texts = [None, *[prose(k, 60) for k in range(20)], "", "y" * 500]
    monkeypatch.setattr(alignment, "PIECE", 700)
    assert of(alignment.digest(docs_of(texts).coalesce(1), *files)) == sorted(Plain(files).rows(list(enumerate(texts))), key=repr)
