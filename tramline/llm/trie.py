"""Prefix trie of conversations by van Emde Boas recursion.

All conversations are cut at half the trie's height. The prefix above the cut gets a name;
equal prefixes under one root are one row from then on, and what lies below the cut belongs
to the forest under that name. The upper part and the lower forests are cut again, all in the
same Spark job, until segments are single turns: the trie's edges. A trie of height D takes
log2 D jobs, and a prefix that many conversations share is one row after the first of them.

Totals are grafted upward along the same cuts: first every lower tree's total is added at its
root, from the lowest cuts to the highest, then each cut node's full total goes to the nodes
half a height above it. Levels are stored one by one; all of them together hold every node
about twice.

Names are the first 128 bits of SHA-256 over the root's name and the turns. A turn counts by
role and text; a null role or text is empty. Turns are ordered by number, null first, then
by their digests. Rows without a conversation id belong to no conversation and are left out;
repeated rows are turns of their own. A conversation's digests, 20 bytes a turn, are one value.
An empty table gives no rows, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import stored

# Bytes of a turn: 16 of its digest, 4 for the number of its words. Bytes of a node's name.
TURN = 20
NAME = 16
ROOT = bytes(NAME)
# Conversations that share their beginnings, and how many turns they may share (below this).
FAMILY = 20
SHARED = 4
# Bits of the ids that are joined to one string before they are hashed.
RUN_BITS = 16

WORD = r"[^\x20\x09-\x0D]+"


def _short(digest: Column) -> Column:
    """The first 128 bits of a hexadecimal digest."""
    return F.unhex(F.substring(digest, 1, 2 * NAME))


def rebuilt(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text", family: int = FAMILY, shared: int = SHARED) -> DataFrame:
    """(conv, seq): every conversation's turns as one binary, ``TURN`` bytes each.

    A conversation takes its first h turns from the first of its family (c - c % family; as many
    as that one has, none if it is absent), h being crc32 of its id modulo ``shared``, and then
    its own after the first h.
    """
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * NAME)
    token = F.concat(digest, F.lpad(F.hex(F.regexp_count(text, F.lit(WORD))), 2 * (TURN - NAME), "0"))
    one = turns.filter(F.col(conv_col).isNotNull()).select(
        (F.col(conv_col) - F.col(conv_col) % family).alias("head"), F.col(conv_col).alias("conv"),
        F.struct(F.col(turn_col).alias("turn"), token.alias("token")).alias("t"))
    # Dealt by family once; both groupings keep to it.
    convs = one.repartition("head").groupBy("head", "conv").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    whole = F.unhex(F.array_join(F.transform("ts", lambda t: t["token"]), ""))
    families = convs.select("head", F.struct("conv", whole.alias("own")).alias("c")).groupBy("head").agg(
        F.collect_list("c").alias("cs"))
    first = F.filter("cs", lambda c: c["conv"] == F.col("head"))
    opening = F.when(F.size(first) > 0, F.substring(F.element_at(first, F.lit(1))["own"], 1, TURN * shared))
    each = families.withColumn("opening", opening).select("opening", F.explode("cs").alias("c"))
    size = (F.crc32(F.col("c.conv").cast("string").cast("binary")) % shared).cast("int") * TURN
    empty = F.lit(b"")
    seq = F.concat(F.coalesce(F.substr("opening", F.lit(1), size), empty), F.substr("c.own", size + 1))
    return each.select("c.conv", seq.alias("seq"))


def _cut(segments: DataFrame, half: int) -> DataFrame:
    """Every segment of ``half`` turns or more cut there: the named upper part and what is below.

    A segment that ends where a cut is known carries that node's name in ``bottom`` and the
    names above it, half by half, in ``up``; ``end`` is the class of conversations that end with it.
    """
    size = half * TURN
    head = F.substring("seq", 1, size)
    name = _short(F.sha2(F.concat("root", head), 256))
    tail = F.substr("seq", F.lit(size + 1))
    none = F.lit(None)
    whole = F.struct("root", "at", "seq", "bottom", "up", "end")

    def part(root: Column, at: Column, seq: Column, bottom: Column, up: Column, end: Column) -> Column:
        return F.struct(root.alias("root"), at.alias("at"), seq.alias("seq"), bottom.alias("bottom"), up.alias("up"), end.alias("end"))

    upper = part(F.col("root"), F.col("at"), head, name, F.lit(b""), F.when(F.length("seq") == size, F.col("end")))
    above = F.when(F.col("bottom").isNull(), F.col("up")).otherwise(F.concat("up", "root"))
    lower = part(name, F.col("at") + half, tail, F.col("bottom"), above, F.col("end"))
    parts = (F.when(F.length("seq") > size, F.array(upper, lower)).when(F.length("seq") == size, F.array(upper))
             .otherwise(F.array(whole)))
    cut = segments.select("n", "low", F.explode(parts).alias("s")).select("s.*", "n", "low")
    return _merged(cut.withColumn("bottom", F.coalesce("bottom", none.cast("binary"))))


def _merged(segments: DataFrame) -> DataFrame:
    """Equal segments under one root as one row."""
    return segments.groupBy("root", "at", "seq", "bottom", "up").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("end").alias("end"))


def edges(classes: DataFrame, height: int) -> DataFrame:
    """The trie's nodes below the root: name, parent, depth, up, words, n, low, end.

    ``classes`` has the distinct sequences (seq), their number of conversations (n) and smallest
    id (low); ``height`` is a power of two above their longest length.
    """
    segments = classes.filter(F.length("seq") > 0).select(
        F.lit(ROOT).alias("root"), F.lit(0).cast("long").alias("at"), "seq", F.lit(None).cast("binary").alias("bottom"),
        F.lit(b"").alias("up"), "n", "low", F.col("low").alias("end"))
    half = height // 2
    while half:
        segments = _cut(segments, half)
        half //= 2
    words = F.conv(F.hex(F.substring("seq", NAME + 1, TURN - NAME)), 16, 10).cast("long")
    return segments.select(F.col("bottom").alias("name"), F.col("root").alias("parent"), (F.col("at") + 1).alias("depth"),
                           "up", words.alias("words"), "n", "low", "end")


def _level(depth: Column, top: int) -> Column:
    """How often two divides the depth; ``top`` for the root."""
    return F.when(depth == 0, F.lit(top)).otherwise(F.bit_count(depth.bitwiseAND(-depth) - 1).cast("int"))


def graft(nodes: DataFrame, top: int) -> DataFrame:
    """(name, saved, leaves): the sums of ``saved`` and ``leaf`` over every node's subtree.

    ``nodes`` has name, parent, depth, up, saved, leaf, without the root, and heights below
    2 ** top. A node whose depth is an odd multiple of 2 ** k is on level k, and its ancestors at
    distances 1, 2, 4 .. 2 ** k are known (parent, and the names in ``up``).
    """
    sums = ["saved", "leaves"]
    spark = nodes.sparkSession
    known = nodes.select("name", "parent", "depth", "up", F.col("saved"), F.col("leaf").alias("leaves"),
                         _level(F.col("depth"), top).alias("level"))
    base = stored(known, "trie-levels", "level")

    def received(messages: list[DataFrame], level: int) -> DataFrame | None:
        some = [m.filter(F.col("to_level") == level).select("to", *sums) for m in messages]
        if not some:
            return None
        return reduce(DataFrame.union, some).groupBy("to").agg(*[F.sum(c).alias(f"more_{c}") for c in sums])

    def added(own: DataFrame, more: DataFrame | None) -> DataFrame:
        if more is None:
            return own
        both = own.join(more, own["name"] == more["to"], "left")
        return both.select(*[c for c in own.columns if c not in sums],
                           *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in sums])

    def sent(own: DataFrame, to: Column, distance: Column) -> DataFrame:
        goal = own.select(to.alias("to"), _level(F.col("depth") - distance, top).alias("to_level"), *sums)
        return goal.groupBy("to", "to_level").agg(*[F.sum(c).alias(c) for c in sums])

    # Upward: a node on level k has the total of the 2 ** k depths from it on, which its ancestor at that distance adds.
    upward: list[DataFrame] = []
    partial: list[DataFrame] = []
    for k in range(top):
        own = base.filter(F.col("level") == k)
        if k:
            own = stored(added(own, received(upward, k)), f"trie-up-{k}")
        above = F.substring("up", 1, NAME) if k else F.col("parent")
        partial.append(own)
        upward.append(stored(sent(own, above, F.lit(1 << k)), f"trie-sent-{k}"))
    # Downward: a node's full total is that of its 2 ** k depths and of the nodes right below these.
    downward: list[DataFrame] = []
    full: list[DataFrame] = []
    for k in reversed(range(top)):
        own = added(partial[k], received(downward, k))
        if k:
            own = stored(own, f"trie-full-{k}")
            # "up" has the ancestors at distances 2 ** k down to 2.
            steps = F.explode(F.array(*[F.struct(F.lit(1 << i).alias("distance"),
                                                 (F.substring("up", NAME * (k - i) + 1, NAME) if i else F.col("parent")).alias("to"))
                                        for i in range(k)]))
            every = own.select("depth", *sums, steps.alias("s")).select("depth", *sums, "s.*")
            downward.append(stored(sent(every, F.col("to"), F.col("distance")), f"trie-down-{k}"))
        full.append(own.select("name", *sums))
    root = spark.range(1).select(F.lit(ROOT).alias("name"), *[F.lit(0).cast("long").alias(c) for c in sums])
    return reduce(DataFrame.union, full, added(root, received(upward, top)).select("name", *sums))


def id_digests(ends: DataFrame) -> DataFrame:
    """(end, ends_sha256): SHA-256 over each class's ids (end, conv), ascending, comma-joined.

    Ids are joined to strings by runs of 2 ** RUN_BITS first; a class's strings then stream
    through one hash in order, so no group is held whole.
    """
    runs = ends.groupBy("end", F.shiftright("conv", RUN_BITS).alias("run")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = state = None
        for batch in batches:
            done: list[tuple[int, str]] = []
            for own, ids in zip(batch.column("end").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if state is not None and own == end:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    done.append((end, state.hexdigest()))
                end, state = own, hashlib.sha256(ids.encode())
            yield _digest_rows(done)
        if state is not None:
            yield _digest_rows([(end, state.hexdigest())])

    return runs.repartition("end").sortWithinPartitions("end", "run").select("end", "ids").mapInArrow(
        digest, "end long, ends_sha256 string")


def _digest_rows(rows: list[tuple[int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.string())],
                                      names=["end", "ends_sha256"])


def prefix_trie(sequences: DataFrame) -> DataFrame:
    """One row per node of the trie over ``sequences`` (conv long, seq as made by ``rebuilt``)."""
    own = stored(sequences.select(F.col("conv").cast("long").alias("conv"), "seq"), "trie-sequences")
    classes = stored(own.groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("low")), "trie-classes")
    whole = classes.agg(F.coalesce(F.max(F.length("seq")), F.lit(0)).alias("longest"), F.sum("n").alias("n"),
                        F.min("low").alias("low"), F.min(F.when(F.length("seq") == 0, F.col("low"))).alias("end")).first()
    top = (whole["longest"] // TURN).bit_length()
    made = stored(edges(classes, 1 << top), "trie-edges")
    root = sequences.sparkSession.range(1).select(
        F.lit(ROOT).alias("name"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
        F.lit(b"").alias("up"), F.lit(0).cast("long").alias("words"), F.lit(whole["n"]).cast("long").alias("n"),
        F.lit(whole["low"]).cast("long").alias("low"), F.lit(whole["end"]).cast("long").alias("end")).filter(F.col("n") > 0)
    children = made.groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("children"))
    nodes = stored(made.unionByName(root).join(children, "name", "left").withColumns({
        "children": F.coalesce("children", F.lit(0).cast("long")), "saved": (F.col("n") - 1) * F.col("words"),
        "leaf": F.col("children").isNull().cast("long")}), "trie-nodes")
    if top:
        totals = graft(nodes.filter("depth > 0"), top)
    else:
        totals = nodes.select("name", "saved", F.col("leaf").alias("leaves"))
    tops = nodes.select(F.col("name").alias("parent"), F.col("low").alias("parent_low"))
    digests = stored(id_digests(own.join(classes.select("seq", F.col("low").alias("end")), "seq").select("end", "conv")), "trie-ends")
    # Only the root can be the parent of any share of the nodes; its id is known.
    parent_low = F.when(F.col("depth") == 1, F.lit(whole["low"])).otherwise(F.col("parent_low"))
    asked = F.when(F.col("depth") > 1, F.col("parent"))
    slim = nodes.drop("saved", "up", "words", "leaf").withColumn("parent", asked)
    return (slim.join(totals, "name").join(tops, "parent", "left").join(digests, "end", "left").select(
        F.col("low").alias("conv_id"), "depth", parent_low.cast("long").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
