"""Alignment against whole-text encoding and plain loops."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.support import LONG, odd_documents, sha
from tramline.llm import align, queries

SF = "/root/testdata/sf0.001"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tools():
    return align.Sides(*align.read_models())


def plain_groups(text, tools):
    """[(ids of A, ids of B)], with both sides encoding the text in one go."""
    if not text:
        return []
    data = b" " + text.encode()
    a = tools.a.encode(" " + text, add_special_tokens=False).ids
    b = tools.b.encode(text)
    if any(b"".join(table[i] for i in ids) != data for ids, table in ((a, tools.a_bytes), (b, tools.b_bytes))):
        return []
    ends = [np.cumsum([len(table[i]) for i in ids]).tolist() for ids, table in ((a, tools.a_bytes), (b, tools.b_bytes))]
    groups, at, to = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        i, j = ends[0].index(end, at) + 1, ends[1].index(end, to) + 1
        groups.append((a[at:i], b[to:j]))
        at, to = i, j
    return groups


def plain_rows(texts, tools):
    found = [plain_groups(t, tools) for t in texts]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for groups in found]
    docs = Counter(p for c in links for p in c)
    most = defaultdict(int)
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    out = []
    for groups, c in zip(found, links, strict=True):
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(c.values()),
                    sum(n for p, n in c.items() if docs[p] == most[p[0]]), sum(n * docs[p] for p, n in c.items()),
                    sha(spelled) if spelled else ""))
    return out


def run(spark, texts, **args):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return [tuple(r) for r in align.scored(df, **args).orderBy("doc_id").select(*COLUMNS).collect()]


def test_whole_table_equals_plain_loops(spark, tools):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = {r["doc_id"]: x for r, x in zip(docs, plain_rows([r["text"] for r in docs], tools), strict=True)}
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in queries.op11_token_alignment(spark, SF).collect()} == want


HARD = ["  two  blanks ", "tab\there\n\n next", "naïve ☃ 日本語 🙂", "don't we'll I'm", "<|endoftext|> </s> <s> <0x41>", "a▁b fine words",
        "\x00 \x1c \x85 ᠎ ​ 　x", "x" * 300, "=" * 77 + " " * 33, "́ ́a ́", "zqxjkvbw" * 40, "ＡＢ①", "a ᠎ b", "﻿bom"]


def test_hard_texts(spark, tools):
    texts = [*HARD, None, "", LONG, *HARD]
    want = plain_rows(texts, tools)
    assert run(spark, texts) == want
    assert run(spark, texts, max_broadcast_pairs=0) == want
    assert want[5] == (0, 0, 0, 0, 0, 0, "")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\tab'sté日🙂1.-᠎　▁"), max_size=40), max_size=5))
def test_pieces_equal_whole_texts(tools, texts):
    made = align.align_texts(texts, tools)
    for text, row in zip(texts, made, strict=True):
        groups = plain_groups(text, tools)
        links = Counter(x * len(tools.b_bytes) + y for a, b in groups for p in a for x, y in ((p, q) for q in b))
        assert row[4] == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        assert dict(zip(np.asarray(row[5]).tolist(), np.asarray(row[6]).tolist(), strict=True)) == links


def test_links_without_touching():
    """A group of A tokens 0-2, 2-4 and B tokens 0-1, 1-4: its four pairs, one of which doesn't overlap."""
    class Tools:
        a_bytes, b_bytes = [b"ab", b"cd"], [b"a", b"bcd"]

        def pieces(self, text):
            return [text]

        def encode(self, pieces):
            return [(np.array([(0, 2), (1, 4)], align._PAIR).tobytes(), np.array([(0, 1), (1, 4)], align._PAIR).tobytes(), 2, 2, 4, True)
                    for _ in pieces]

    (one,) = Tools().encode(["x"])
    a, _, _ = align.side_frame([one[0]], [2], np.array([0]), np.array([0]))
    b, _, _ = align.side_frame([one[1]], [2], np.array([0]), np.array([0]))
    assert sorted(zip(*(x.tolist() for x in align.overlaps(a, b)), strict=True)) == [(0, 0), (0, 1), (1, 1)]
    (row,) = align.align_texts(["x"], Tools())
    assert row[:5] == (2, 2, 1, 4, "0,1|0,1") and row[5].tolist() == [0, 1, 2, 3] and row[6].tolist() == [1, 1, 1, 1]


def test_large_groups_are_counted_alike(tools, monkeypatch):
    texts = [*HARD, "zqx" * 50 + " jk", "naïve zqxjkv", "naïve zqxjkv naïve"]
    want = align.align_texts(texts, tools)
    monkeypatch.setattr(align, "MAX_GROUP_PAIRS", 3)
    for got, row in zip(align.align_texts(texts, tools), want, strict=True):
        assert got[:5] == row[:5] and list(got[5]) == list(row[5]) and list(got[6]) == list(row[6])


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n'stabeé1.Я")), max_size=60), max_size=4))
def test_ids_equal_the_vocabularys_own_library(tools, pieces):
    assert tools.ranked is not None
    assert tools._byte_level(pieces) == [x.ids for x in tools.a.encode_batch([" " + p for p in pieces], add_special_tokens=False)]


def test_byte_alphabet(tools):
    assert sorted(align.byte_alphabet().values()) == list(range(256))
    assert tools.cuts and tools.a_bytes[50256] == b"<|endoftext|>"


def test_memo_is_bounded(tools, monkeypatch):
    monkeypatch.setattr(align, "MEMO_ENTRIES", 5)
    words = [f"w{i}" for i in range(40)]
    want = tools.encode(words)
    tools.encode(["one more"])
    for _ in range(3):
        for k in range(0, 40, 4):
            assert tools.encode(words[k:k + 4]) == want[k:k + 4]
        assert len(tools.memo) <= 9


def test_odd_rows(spark):
    docs = odd_documents(spark)
    made = align.scored(docs)
    assert made.count() == docs.count() and set(COLUMNS) < set(made.columns)
    assert align.scored(docs.limit(0)).count() == 0
    assert {r["n_a"] for r in made.filter("doc_id IN (1, 2)").collect()} == {0}
