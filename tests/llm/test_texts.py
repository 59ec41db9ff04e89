"""Tokenisation, chats, quality rules and the classifier against plain Python."""

import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.support import LONG, WORDS, odd_documents, sha
from tramline.llm import bpe, chat, compression, nbsvm

CODEC = bpe.make_codec()
ENCODE = bpe.encoder(CODEC)
THEIRS = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                           mergeable_ranks=bpe.load_ranks(public_tokenizers.path(bpe.RANKS)))


def ids(text):
    return np.frombuffer(ENCODE(text), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab \n\t\x1c\x85 's\u2003é日1²Ⅷ🙂\u0301AZ!?.\xa0"), max_size=40) | st.text(max_size=30))
def test_tokens_equal_the_library(text):
    assert ids(text) == THEIRS.encode_ordinary(text)
    assert b"".join(CODEC.bytes_of[i] for i in ids(text)) == text.encode()


def test_perfect_hash_is_minimal_and_exact():
    keys = [f"k{i}".encode() for i in range(5000)]
    table = bpe.PerfectHash(keys)
    assert sorted(map(table.find, keys)) == list(range(5000))
    assert table.find(b"k5000") == -1 and bpe.PerfectHash([]).find(b"x") == -1


def test_long_pre_token():
    text = "abcdefth" * 4000
    assert ids(text) == THEIRS.encode_ordinary(text)


def test_encode_and_decode_take_odd_rows(spark):
    docs = odd_documents(spark)
    coded = bpe.encode(docs, CODEC)
    rows = bpe.decode(coded, CODEC).collect()
    assert len(rows) == docs.count() and coded.columns[:2] == ["doc_id", "text"]
    for r in rows:
        assert bytes(r["decoded"]) == (r["text"] or "").encode()
        assert r["token_ids"] == THEIRS.encode_ordinary(r["text"] or "")
    for r in bpe.digests(coded.select("doc_id", "text", "token_ids"), CODEC).collect():
        want = THEIRS.encode_ordinary(r["text"] or "")
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(want), sha(np.array(want, "<u4").tobytes()), sha(r["text"] or ""))
    assert bpe.encode(docs.limit(0), CODEC).count() == 0


CHATS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
    (2, 0, "user", "</s>[INST] ok [/INST]"), (2, 1, "assistant", "</s>[INST] ok [/INST]"),
    (3, 0, "to[ol", "<\\s>x<\\\\</s>[ROLE=a[:]b"), (3, 1, None, None), (3, 2, "assistant", "[\\/INST] <<SYS>> <"),
    (4, 1, "assistant", "b"), (4, 0, "user", "a"), (4, 2, "user", "c"), (4, 2, "user", "c"),
    (None, 0, "user", "x"), (None, 1, "assistant", "<s><\\s><\\\\s>"),
]


def test_chats_read_back(spark):
    turns = spark.createDataFrame([(*x, 1, "y") for x in CHATS],
                                  "conv_id long, turn long, role string, text string, formatted int, valid string")
    made = chat.format_chats(turns)
    got = {r["conv_id"]: r for r in chat.contract_rows(made).collect()}
    for conv in {c[0] for c in CHATS}:
        rows = sorted([c for c in CHATS if c[0] == conv], key=lambda c: c[1])
        assert got[conv]["n_turns"] == len(rows)
        assert got[conv]["turns_sha256"] == sha("".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in rows))
        loss = "".join(t or "" for _, _, r, t in rows if r == "assistant")
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), sha(loss))
    assert {c: (r["valid"], r["error_turn"]) for c, r in got.items()} == {
        1: (True, None), 2: (True, None), 3: (False, 0), 4: (False, 3), None: (True, None)}
    for r in made.collect():
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_turn_numbers_are_checked(spark):
    long = "word [INST] " * 20000
    rows = [(1, None, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "system", "s"), (2, 0, "user", "u"), (2, 1, "assistant", "a"),
            (3, 4, "user", "u"), (3, 9, "assistant", "a"), (4, 0, "user", "u"), (4, 1, "assistant", "a"), (4, 1, "assistant", "a"),
            (5, 0, "user", long), (5, 1, "assistant", long)]
    made = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: (r["valid"], r["error_turn"]) for r in made.collect()}
    assert got == {1: (False, 0), 2: (False, 1), 3: (True, None), 4: (False, 2), 5: (True, None)}
    back = {r["conv_id"]: r["turns"] for r in chat.read_back(made).collect()}
    assert [tuple(t) for t in back[5]] == [("user", long), ("assistant", long)]


def test_marks_that_overlap_are_refused(spark):
    bad = chat.Template(roles={"user": chat.Role("<a>", "<b>")}, other=("<a><", "[:]", "[/x]"), moves={}, start="s", final=())
    turns = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    with pytest.raises(ValueError, match="overlap"):
        chat.format_chats(turns, bad)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "é", "x y"]), max_size=60), st.sampled_from([" ", "\n", "\t "]))
def test_base_counts(words, gap):
    text = gap.join(words) + "#*"
    own = WORDS.findall(text)
    windows = [tuple(own[i:i + 8]) for i in range(len(own) - 7)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    assert compression.base_counts(text, text.encode()) == (
        len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_compression_bands():
    compress = zstandard.ZstdCompressor(level=3).compress
    bands = compression.Bands()

    def verdict(data):
        return compression.judge(len(data), *compression.ratios(data, bands, compress), bands)

    noise = np.random.default_rng(0).integers(33, 127, 20000, dtype=np.uint8).tobytes()
    sounds = ["ba", "ren", "to", "si", "lu", "mor", "ke", "an", "dri", "o"]
    prose = " ".join("".join(np.random.default_rng(i).choice(sounds, 1 + i % 4)) for i in range(1500)).encode()
    assert [verdict(x) for x in (b"", b"short", noise, b"same line again\n" * 2000, prose)] == [
        "ok", "ok", "incompressible", "repetitive", "ok"]


def test_the_last_bytes_are_judged():
    import base64

    compress = zstandard.ZstdCompressor(level=3).compress
    bands = compression.Bands()
    sounds = ["ba", "ren", "to", "si", "lu", "mor", "ke", "an", "dri", "o"]
    prose = " ".join("".join(np.random.default_rng(i).choice(sounds, 1 + i % 4)) for i in range(1500)).encode()
    noise = base64.b64encode(np.random.default_rng(0).bytes(3000))
    whole, chunks = compression.ratios(prose[:4096] + noise, bands, compress)
    assert len(noise) == 4000 and len(chunks) == 2 and whole < 0.70 and chunks[0] < 0.75 < chunks[1]
    assert compression.judge(8096, whole, chunks, bands) == "incompressible"
    assert [len(compression.ratios(prose[:n], bands, compress)[1]) for n in (4095, 4096, 4097, 8192, 8193)] == [0, 1, 2, 2, 3]


def test_quality_rules_take_odd_rows(spark):
    docs = odd_documents(spark)
    rows = compression.quality_rules(docs).collect()
    assert len(rows) == docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_words"] == by[2]["n_words"] == by[5]["n_words"] == 0 and by[1]["base_failed"] and not by[1]["kept"]
    assert by[4]["n_words"] == len(LONG.split()) and by[4]["band_verdict"] == "repetitive"
    assert compression.quality_rules(docs.limit(0)).count() == 0


def test_classifier_learns_and_holds_out(spark):
    rng = np.random.default_rng(5)
    good = [" ".join(rng.choice(["river", "stone", "walks", "early", "morning", "light"], 30)) for _ in range(120)]
    bad = [" ".join(rng.choice(["BUY!!", "NOW!!", "$$$", "CLICK!!", "WIN!!"], 30)) for _ in range(120)]
    rows = [(i, t) for i, t in enumerate([x for pair in zip(good, bad, strict=True) for x in pair])]
    docs = spark.createDataFrame(rows + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i, _ in rows] + [(5, 1, 0), (None, 1, 0), (7, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = nbsvm.classify(docs, labels).withColumn("held_out", nbsvm.held_out()).collect()
    assert {r["doc_id"]: r["held_out"] for r in got} == {
        r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in got}
    tested = [r for r in got if r["doc_id"] < 900 and r["held_out"]]
    assert np.mean([r["predicted"] == 1 - r["doc_id"] % 2 for r in tested]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    odd = odd_documents(spark)
    assert nbsvm.classify(odd, labels).count() == odd.count()
    assert nbsvm.classify(odd, labels.limit(0)).filter("score != 0.5").count() == 0
    assert nbsvm.classify(odd.limit(0), labels).count() == 0


@pytest.mark.parametrize("text", [None, "", "ab", "abc", "the same the same the same the same", "é 日本 🙂 x y z " * 40])
def test_features_are_distinct_ngrams(text):
    seen = np.zeros(2 * nbsvm.BUCKETS, np.int32)
    got = nbsvm.features(text, seen).tolist()
    raw = (text or "").encode()
    sizes = [min(len(w), nbsvm.LONG_WORD) for w in raw.split()]
    grams = {raw[i:i + n] for n in (3, 4) for i in range(len(raw) - n + 1)} if len(raw) > 2 else set()
    lengths = {tuple(sizes[i:i + n]) for n in nbsvm.LENGTH_GRAMS for i in range(len(sizes) - n + 1)} if len(raw) > 2 else set()
    assert len(set(got)) == len(got) == len(grams) + len(lengths)  # no two of these n-grams share a bucket
    assert sum(x >= nbsvm.BUCKETS for x in got) == len(lengths) and nbsvm.features(text, seen).tolist() == got


def test_dual_descent_reaches_the_hinge_optimum():
    rng = np.random.default_rng(3)
    rows = [np.sort(rng.choice(40, 6, replace=False)) for _ in range(80)]
    y = np.array([int((r < 20).sum() > 3) for r in rows])
    ratio = nbsvm.log_count_ratios(rows, y, 64)
    w, b = nbsvm.dual_coordinate_descent(rows, y, ratio, epochs=400, tolerance=1e-8)
    x = np.zeros((80, 65))
    for k, r in enumerate(rows):
        x[k, r] = ratio[r] / np.sqrt(len(r))
        x[k, 64] = 1
    s = np.where(y == 1, 1, -1)

    def loss(v):
        return 0.5 * v @ v + np.maximum(0, 1 - s * (x @ v)).sum()

    best = loss(np.append(w, b))
    assert all(loss(np.append(w, b) + rng.normal(0, e, 65)) >= best - 1e-3 for e in (0.001, 0.01, 0.1) for _ in range(30))
