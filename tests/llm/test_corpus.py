"""Decontamination, SimHash and the pipeline against plain Python."""

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tests.llm.support import ITEM_WORDS, WORDS, lower, odd_documents, sha
from tramline.llm import decontaminate, simhash

SF = "/root/testdata/sf0.001"


def plain_hits(text, items, window=13):
    words = ITEM_WORDS.findall(lower(text))
    hit, found = set(), set()
    for item, other in items:
        other = ITEM_WORDS.findall(lower(other))
        n = min(window, len(other))
        grams = {tuple(other[i:i + n]) for i in range(len(other) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i:i + n]) in grams:
                hit |= set(range(i, i + n))
                found.add(str(item))
    return len(words), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=6), st.lists(st.sampled_from("abcd"), max_size=40))
def test_automaton_equals_window_search(items, words):
    made = decontaminate.Automaton([(str(i), [w.encode() for w in x]) for i, x in enumerate(items)], 4)
    spans, found = made.scan([w.encode() for w in words])
    covered = {i for a, b in spans for i in range(a, b)}
    want = plain_hits(" ".join(words), [(i, " ".join(x)) for i, x in enumerate(items)], 4)
    assert (len(covered), sha(",".join(sorted(found)))) == (want[1], want[3])


@pytest.mark.parametrize("shard_words", [decontaminate.SHARD_WORDS, 30])
def test_decontamination_rows(spark, shard_words):
    a = " ".join(f"alpha{i}" for i in range(40))
    items = [(1, a), (2, "short one here"), (3, None), (4, "..."), (5, a), (None, "Nobody knows, this")]
    texts = {1: a, 2: "x " * 300 + "SHORT-one here", 3: None, 4: "", 5: " ".join(a.split()[5:17]), 6: "y " * 900 + a + " tail",
             7: "who said nobody knows this?"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in decontaminate.contract_rows(
        decontaminate.match(docs, bench, shard_words=shard_words)).collect()}
    assert got == {k: plain_hits(t, [("null" if i is None else i, x) for i, x in items]) for k, t in texts.items()}
    kept = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, bench, shard_words=shard_words).collect()}
    assert set(kept) == {2, 3, 4, 5, 6} and kept[2] == texts[2]
    assert kept[6] == "y " * 900 + " tail"


def test_automata_are_built_by_shards_and_hold_every_window(spark):
    words = [f"w{i}" for i in range(500)]
    items = [(1, " ".join(words)), (2, "a b c"), (3, None), (None, "w3 w4 w5")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    built, n = decontaminate.automata(bench, shard_words=130)
    assert n > 3 and built.select("shard").distinct().count() == built.count() > 1
    docs = spark.createDataFrame([(k, " ".join(words[a:a + 13])) for k, a in enumerate(range(0, 488))], "doc_id long, text string")
    found = decontaminate.match(docs, bench, shard_words=130)
    assert found.filter("size(hit_starts) = 1 AND hit_starts[0] = 0 AND hit_stops[0] = 13 AND array_contains(item_ids, '1')").count() == 488
    assert decontaminate.match(docs, bench.limit(0)).filter("size(item_ids) = 0 AND n_words = 13").count() == 488


def test_decontamination_takes_odd_rows(spark):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = odd_documents(spark)
    assert decontaminate.match(docs, bench).count() == docs.count()
    assert decontaminate.decontaminate(docs, bench).columns == docs.columns
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.match(docs.limit(0), bench).count() == 0


def plain_fingerprint(text):
    words = WORDS.findall(lower(text))
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(points, max_bits):
    """Point -> smallest point reachable."""
    points = sorted(set(points))
    up = {p: p for p in points}

    def root(p):
        while up[p] != p:
            p = up[p]
        return p

    for i, p in enumerate(points):
        for q in points[i + 1:]:
            if (p ^ q).bit_count() <= max_bits:
                a, b = sorted((root(p), root(q)))
                up[b] = a
    return {p: root(p) for p in points}


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("aB é\t\n日"), max_size=60))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def crowded(rng, n):
    """Random points, chains of near ones, and a dense ball."""
    far = rng.integers(0, 1 << 63, n, dtype=np.uint64)
    chain = far[:n // 2] ^ (np.uint64(1) << rng.integers(0, 63, n // 2, dtype=np.uint64))
    ball = np.uint64(12345) ^ (np.uint64(1) << rng.integers(0, 63, n, dtype=np.uint64)) ^ (
        np.uint64(1) << rng.integers(0, 63, n, dtype=np.uint64))
    return np.unique(np.concatenate((far, chain, ball)))


def test_links_in_a_shard_lose_nothing():
    points = crowded(np.random.default_rng(4), 300)
    some, to, left = simhash.links(points, 2, leaf=16)
    got = dict(zip(some.tolist(), to.tolist(), strict=True))
    want = plain_components(points.tolist(), 2)
    assert not left
    assert {p: got.get(p, p) for p in points.tolist()} == want


def test_tree_brings_near_points_together():
    points = crowded(np.random.default_rng(5), 300)
    root, shards = simhash.build_tree(points[::3], len(points), 2, shard_points=40, max_shards=64)
    assert 4 <= shards <= 64
    at = {}
    for shard, some in simhash.deal(points, root, 2):
        for p in some.tolist():
            at.setdefault(p, set()).add(shard)
    assert set(at) == set(points.tolist())
    values = points.tolist()
    assert all(at[p] & at[q] for i, p in enumerate(values) for q in values[i:] if (p ^ q).bit_count() <= 2)


def test_classes_over_shards(spark):
    points = crowded(np.random.default_rng(6), 400)
    rows = [(int(p), 10_000 - i) for i, p in enumerate(points.view(np.int64).tolist())]
    table = spark.createDataFrame(rows, "p long, least long")
    got = {r["p"]: r["component"] for r in simhash.classes(table, 2, shard_points=60, tree_sample=300).collect()}
    roots = plain_components(points.tolist(), 2)
    least = {}
    for (p, own), q in zip(rows, points.tolist(), strict=True):
        least[roots[q]] = min(own, least.get(roots[q], own))
    assert got == {p: least[roots[q]] for (p, _), q in zip(rows, points.tolist(), strict=True)}


@pytest.mark.parametrize("dense", [700, 90])
def test_a_dense_ball_is_dealt_in_pairs_of_blocks(spark, dense):
    ball = np.unique([12345 ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)]).astype(np.uint64)[:1500]
    far = np.random.default_rng(8).integers(0, 1 << 63, 200, dtype=np.uint64)
    points = np.unique(np.concatenate([ball, far]))
    assert len(simhash.links(points, 2, dense=dense)[2]) >= 1
    table = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "p long")
    pairs = simhash.edges(table, 2, tree_sample=50, dense_points=dense)
    got = {r["p"]: r["root"] for r in simhash.components(pairs).collect()}
    want = plain_components(points.tolist(), 2)
    groups = {}
    for p, q in zip(points.view(np.int64).tolist(), points.tolist(), strict=True):
        groups.setdefault(want[q], set()).add(got.get(p, p))
    assert all(len(x) == 1 for x in groups.values()) and len(set().union(*groups.values())) == len(groups)


def test_long_chain_is_one_component(spark):
    pairs = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(200, 100), (100, 150)], "p long, q long")
    got = {r["p"]: r["root"] for r in simhash.components(pairs).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 200: 100, 150: 100}


def test_near_duplicates_take_odd_rows(spark):
    docs = odd_documents(spark)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    zero = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in zero} == {1, 2, 5} and {r["component_id"] for r in zero} == {1}
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, 1), (False, 3), (False, 4), (False, 6), (True, 0)]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_documents_without_ids_keep_one_of_each_group(spark):
    texts = ["one two three four five six", "one two three four five six", "quite another text of its own here",
             "shared with a named document, word for word"]
    docs = spark.createDataFrame([(None, t, "x") for t in texts] + [(9, texts[3], "y")], "doc_id long, text string, p string")
    kept = simhash.keep_first(docs).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == sorted([(0, texts[0]), (0, texts[2]), (9, texts[3])])


def test_one_id_with_texts_of_different_groups_keeps_both(spark):
    texts = ["one two three four five six", "quite another text of its own here", "a third text, as different as can be"]
    rows = [(1, texts[0], "x"), (1, texts[1], "y"), (1, texts[1], "y"), (2, texts[1], "z"), (3, texts[2], "x"), (2, texts[2], "y"),
            (2, texts[0], "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, p string")
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == sorted([(1, texts[0], "x"), (1, texts[1], "y"), (2, texts[2], "y")])


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "benchmark decontamination", "PII", "byte-level BPE"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clash = docs.selectExpr("*", "1 AS score", "'x' AS fingerprint")
    odd = clash.limit(0).unionByName(odd_documents(spark).select("doc_id", "text"), allowMissingColumns=True)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, clash, SF).columns == clash.columns
        assert stage(spark, odd, SF).count() <= odd.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_tokens_are_decoded_and_columns_pass(spark, monkeypatch):
    from tramline.llm import bpe

    odd = odd_documents(spark)
    made = corpus_pipeline.tokens(spark, odd, SF)
    assert made.columns == [c for c in odd.columns if c != "token_ids"] + ["n_tokens", "token_ids", "decoded_sha256"]
    rows = made.collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert r["decoded_sha256"] == sha(r["text"] or "") and r["n_tokens"] == len(r["token_ids"]) and r["kept"] == 7
    codec = bpe.make_codec()
    codec.bytes_of = {k: v.upper() for k, v in codec.bytes_of.items()}
    monkeypatch.setattr(bpe, "make_codec", lambda: codec)
    with pytest.raises(Exception, match="decode to their text"):
        corpus_pipeline.tokens(spark, odd, SF).collect()


def test_pipeline_equals_brute_force(spark):
    import tiktoken

    from tramline.llm import bpe, nbsvm, pii
    from tramline.llm.queries import pseudonym_key

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r["doc_id"]: r["text"] for r in nbsvm.classify(docs, labels).filter("predicted = 1").collect()}
    points = {i: plain_fingerprint(t) for i, t in good.items()}
    roots = plain_components(points.values(), 2)
    first = {}
    for i in sorted(good):
        first.setdefault(roots[points[i]], i)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {i: good[i] for i in first.values() if not plain_hits(good[i], items)[4]}
    whole = {i: t for i, t in clean.items() if not plain_hits(t, items)[1]}
    hidden = pii.pseudonymise(spark.createDataFrame(list(whole.items()), "doc_id long, text string"), pseudonym_key(spark))
    theirs = tiktoken.Encoding("own", pat_str=bpe.public_tokenizers.PATTERN, special_tokens={},
                               mergeable_ranks=bpe.load_ranks(bpe.public_tokenizers.path(bpe.RANKS)))
    want = {r["doc_id"]: theirs.encode_ordinary(r["text"]) for r in hidden.collect()}
    got = {r["doc_id"]: r["token_ids"] for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(clean)
    assert {i: got[i] for i in want} == want
