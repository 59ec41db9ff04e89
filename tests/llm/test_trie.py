"""The trie against nodes listed prefix by prefix."""

import random
import zlib

from tests.llm.support import WORDS, sha
from tramline.llm import queries, trie

SF = "/root/testdata/sf0.01"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def listed(rows):
    """Every prefix of every rebuilt conversation as a dictionary entry."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    # Ties keep no order of their own in the tests, except by the operator's digest.
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: (t[:1], t[1] or 0, sha(f"{len(t[2])}:{t[2]}{t[3]}")))] for c, ts in convs.items()}
    members = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        head = int(c / 20) * 20
        seq = tuple(own.get(head, [])[:h] + ts[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append((c, len(seq)))
    out = []
    for seq, who in members.items():
        kids = {k for k in members if len(k) == len(seq) + 1 and k[:-1] == seq}
        below = [k for k in members if k[:len(seq)] == seq]
        ends = sorted(c for c, n in who if n == len(seq))
        out.append((
            min(c for c, _ in who), len(seq), min(c for c, _ in members[seq[:-1]]) if seq else None, len(who), len(kids),
            sum(not any(m[:-1] == k for m in below if m) for k in below),
            sum((len(members[k]) - 1) * len(WORDS.findall(k[-1][1])) for k in below if k), sha(",".join(map(str, ends)))))
    return sorted(out, key=repr)


def run(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = trie.prefix_trie(trie.rebuilt(df))
    assert tuple(made.columns) == COLUMNS
    return sorted(map(tuple, made.collect()), key=repr)


def test_whole_table_equals_listed_prefixes(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, queries.op12_prefix_trie(spark, SF).collect()), key=repr) == listed(rows)


def test_shared_beginnings_of_all_lengths(spark):
    rng = random.Random(5)
    rows = []
    for conv in [*range(-25, 60), 1 << 40]:
        # Few texts, so that prefixes meet; lengths on and beside powers of two.
        for turn in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17])):
            rows.append((conv, turn, rng.choice(["user", "user", None]), rng.choice(["a b", "a b", "a b", "c", None])))
    rng.shuffle(rows)
    assert run(spark, rows) == listed(rows)


def test_odd_rows(spark):
    long = "word " * 30000
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 0, "", ""), (2, 3, "user", long), (2, 3, "user", long),
            (None, 0, "user", "no conversation"), (3, 0, "ab", "c"), (4, 0, "a", "bc"), (20, 5, "user", "x"), (21, 1, "y", "z"),
            (40, 0, "s", "t"), (45, 0, "s", "t"), (46, 0, "s", "t")]
    assert run(spark, rows) == listed(rows)
    assert run(spark, []) == []
    # Every turn of conversation 45 comes from an absent one: no turns, it ends at the root.
    assert zlib.crc32(b"45") % 4 and run(spark, [(45, 0, "s", "t")]) == [(45, 0, None, 1, 0, 1, 0, sha("45"))]
    clash = spark.createDataFrame([(1, 0, "a", "b", 7, 7)], "conv_id long, turn int, role string, text string, conv int, T int")
    assert trie.prefix_trie(trie.rebuilt(clash)).count() == len(listed([(1, 0, "a", "b")]))


def test_digest_of_many_ids(spark):
    ids = [*range(-70000, 70000, 7), 1 << 50, -(1 << 50)]
    ends = spark.createDataFrame([(5, i) for i in ids] + [(6, 1)], "end long, conv long").repartition(7)
    got = {r["end"]: r["ends_sha256"] for r in trie.id_digests(ends).collect()}
    assert got == {5: sha(",".join(map(str, sorted(ids)))), 6: sha("1")}


def test_one_long_conversation(spark):
    rows = [(1000, t, "user", f"turn {t}") for t in range(300)] + [(1020, t, "user", f"turn {t}") for t in range(140)]
    got = run(spark, rows)
    assert len(got) == 301 and got == listed_line(300, 140)


def listed_line(n, m):
    """The nodes of a conversation of n turns and one, by number later, that is its prefix of m."""
    out = [(1000, d, 1000 if d else None, 2 if d <= m else 1, int(d < n), 1, 2 * max(0, m - max(d, 1) + 1),
            sha({n: "1000", m: "1020"}.get(d, ""))) for d in range(n + 1)]
    return sorted(out, key=repr)
