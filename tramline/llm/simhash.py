"""SimHash near-duplicate detection over vantage-point trees.

Every text gets a 64-bit fingerprint. Equal fingerprints are one class. The
distinct fingerprints are dealt to shards by a vantage-point tree fitted on a
bounded sample: each node splits by Hamming distance to a vantage point, and
points near a boundary go to both sides, so any two fingerprints within the
limit meet in some shard (triangle bound). Inside a shard the same splitting goes
on in memory until groups are small enough to compare pair by pair. Links then
join into components, labelled by the smallest document id.

Nulls and texts without words have fingerprint zero and link like any other.
Every row keeps its place: one result row per input row, also for repeated ones.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import carried, field, map_texts, merge_groups, restored, stored

SHINGLE = 3
SEED = 42
MAX_BITS = 2
# The vantage-point tree is fitted on at most this many fingerprints and has at most
# this many shards; every fingerprint is dealt to it.
TREE_SAMPLE = 100_000
MAX_SHARDS = 16_384
# Fingerprints a shard should hold, and below which a group is compared pair by pair.
SHARD_POINTS = 4_000
LEAF_POINTS = 512
# Points that no vantage point divides and that one task still compares; larger groups
# are cut into blocks of this size, whose pairs go to tasks of their own.
DENSE_POINTS = 8_192
# Shingle hashes whose bits are counted at once.
BLOCK = 1 << 16

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """64-bit SimHash: a bit is set if over half of the shingles' hashes have it."""
    words = text.encode().translate(_LOWER).split() if text else []
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    n = max(1, len(words) - size + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(size, len(words)) - 1:] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for a in range(0, n, BLOCK):
        hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(starts[a:a + BLOCK], stops[a:a + BLOCK], strict=True)],
                          np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def with_fingerprints(docs: DataFrame, text_col: str = "text", size: int = SHINGLE,
                      out_col: str = "fingerprint") -> DataFrame:
    """``docs`` with ``out_col`` long: the fingerprint's 64 bits as a signed number."""

    def start():
        def batch(texts: pa.Array) -> list[pa.Array]:
            made = np.array([fingerprint(t, size) for t in texts.to_pylist()], np.uint64)
            return [pa.array(made.view(np.int64))]

        return batch

    return map_texts(docs, text_col, [field(out_col, "long")], start)


@dataclass
class Node:
    """Inner node: points within ``radius`` of ``vantage`` go to ``near``, those farther
    than ``radius - max_bits`` to ``far``. A leaf has only its shard number."""

    shard: int = -1
    vantage: int = 0
    radius: int = 0
    near: Node | None = None
    far: Node | None = None


def _distance(points: np.ndarray, vantage: int) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(vantage))


def _split(points: np.ndarray, max_bits: int, rng: np.random.Generator) -> tuple[int, int, np.ndarray] | None:
    """Vantage point, radius and distances that divide ``points`` best; None if none does.

    Tries a few vantage points from the points, and their opposites; the larger side,
    overlap included, must be under nine tenths of the points.
    """
    best = None
    for pick in rng.choice(points, 4):
        for vantage in (int(pick), int(~pick)):
            d = _distance(points, vantage)
            upto = np.cumsum(np.bincount(d, minlength=65))  # points within each radius
            before = np.concatenate((np.zeros(max_bits, np.int64), upto[:65 - max_bits]))
            larger = np.maximum(upto, len(points) - before)
            radius = int(np.argmin(larger))
            if best is None or larger[radius] < best[0]:
                best = (int(larger[radius]), vantage, radius, d)
    if best is None or best[0] >= 0.9 * len(points):
        return None
    return best[1:]


def _sides(points: np.ndarray, d: np.ndarray, radius: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    return points[d <= radius], points[d.astype(np.int16) > radius - max_bits]


def build_tree(sample: np.ndarray, total: int, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS,
               max_shards: int = MAX_SHARDS) -> tuple[Node, int]:
    """Tree over a sample of ``total`` distinct points, and its number of shards."""
    rng = np.random.default_rng(1)
    root = Node()
    leaves = [(root, sample)]
    least = max(64, shard_points * len(sample) / max(1, total))
    shards = 0
    while leaves:
        node, points = leaves.pop(0)
        split = _split(points, max_bits, rng) if len(points) > least and shards + len(leaves) + 2 <= max_shards else None
        if split is None:
            node.shard = shards
            shards += 1
            continue
        node.vantage, node.radius, d = split
        near, far = _sides(points, d, node.radius, max_bits)
        node.near, node.far = Node(), Node()
        leaves += [(node.near, near), (node.far, far)]
    return root, shards


def deal(points: np.ndarray, root: Node, max_bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, points) for every shard that some of the points belong to."""
    todo = [(root, points)]
    while todo:
        node, some = todo.pop()
        if not len(some):
            continue
        if node.near is None:
            yield node.shard, some
            continue
        near, far = _sides(some, _distance(some, node.vantage), node.radius, max_bits)
        todo += [(node.near, near), (node.far, far)]


def links(points: np.ndarray, max_bits: int = MAX_BITS, leaf: int = LEAF_POINTS,
          dense: int = DENSE_POINTS) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(point, smallest point of its group) for linked points of one shard, and what is left.

    Groups are the components of the links among ``points``; single points are left
    out, so no list of all pairs arises. A group of more than ``dense`` points that no vantage
    point divides isn't compared here but returned whole, to be dealt to other tasks.
    """
    points = np.unique(points)
    label = np.arange(len(points))
    left = []
    rng = np.random.default_rng(2)
    todo = [np.arange(len(points))]
    while todo:
        at = todo.pop()
        own = points[at]
        split = _split(own, max_bits, rng) if len(at) > leaf else None
        if split is not None:
            _, radius, d = split
            todo += list(_sides(at, d, radius, max_bits))
        elif len(at) > dense:
            left.append(own)
        else:
            _compare(points, at, at, label, max_bits)
    linked = label != np.arange(len(points))
    return points[linked], points[label[linked]], left


def _compare(points: np.ndarray, one: np.ndarray, two: np.ndarray, label: np.ndarray, max_bits: int) -> None:
    """Join the groups of all linked pairs between two lists of positions, in blocks."""
    for a in range(0, len(one), LEAF_POINTS):
        block = points[one[a:a + LEAF_POINTS], None]
        for b in range(a if two is one else 0, len(two), 8 * LEAF_POINTS):
            i, j = np.nonzero(np.bitwise_count(block ^ points[None, two[b:b + 8 * LEAF_POINTS]]) <= max_bits)
            merge_groups(label, one[i + a], two[j + b])


def block_links(low: np.ndarray, high: np.ndarray | None, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Linked points within one block, or between two, as (point, smallest point of its group)."""
    points = np.unique(low) if high is None else np.unique(np.concatenate([low, high]))
    label = np.arange(len(points))
    one = np.searchsorted(points, np.unique(low))
    _compare(points, one, one if high is None else np.searchsorted(points, np.unique(high)), label, max_bits)
    linked = label != np.arange(len(points))
    return points[linked], points[label[linked]]


def edges(points: DataFrame, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS,
          tree_sample: int = TREE_SAMPLE, max_shards: int = MAX_SHARDS, dense_points: int = DENSE_POINTS) -> DataFrame:
    """Links between distinct fingerprints (column ``p``) as (p, q), q < p unsigned.

    The links' components are those of all pairs within ``max_bits``.
    """
    spark = points.sparkSession
    total = points.count()
    sample = points.select("p", F.xxhash64("p").alias("h")).orderBy("h", "p").limit(tree_sample).select("p")
    known = np.array([r[0] for r in sample.collect()], np.int64).view(np.uint64)
    root, shards = build_tree(known, total, max_bits, shard_points, max_shards)
    tree = spark.sparkContext.broadcast(root)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for shard, some in deal(values, tree.value, max_bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), shard, np.int32)), pa.array(some.view(np.int64))], names=["shard", "p"])

    def linked(table: pa.Table) -> pa.Table:
        some, to, left = links(table.column("p").to_numpy().view(np.uint64), max_bits, dense=dense_points)
        whole = np.concatenate([some, *left]).view(np.int64)
        ball = np.repeat(np.arange(len(left) + 1), [len(some), *map(len, left)]) - 1
        none = np.concatenate([np.zeros(len(some), bool), *[np.ones(len(x), bool) for x in left]])
        goal = np.concatenate([to.view(np.int64), np.zeros(len(whole) - len(some), np.int64)])
        shard = table.column("shard")[0].as_py() if len(table) else 0
        return pa.table({"p": whole, "q": pa.array(goal, mask=none), "shard": np.full(len(whole), shard, np.int32),
                         "ball": pa.array(ball, pa.int32())})

    def blocked(table: pa.Table) -> pa.Table:
        p, side = table.column("p").to_numpy().view(np.uint64), table.column("side").to_numpy()
        same = table.column("lo")[0] == table.column("hi")[0]
        some, to = block_links(p if same else p[side == 0], None if same else p[side == 1], max_bits)
        return pa.table({"p": some.view(np.int64), "q": to.view(np.int64)})

    made = stored(points.select("p").mapInArrow(dealt, "shard int, p long")
                  .groupBy("shard").applyInArrow(linked, "p long, q long, shard int, ball int"), "shard-links")
    found = made.filter("ball < 0").select("p", "q")
    # Balls: a point of block b meets every block c in task (min, max), on its own side.
    balls = made.filter("ball >= 0").select("shard", "ball", "p")
    sizes = balls.groupBy("shard", "ball").agg(F.ceil(F.count(F.lit(1)) / dense_points).cast("int").alias("blocks"))
    if not sizes.isEmpty():
        pairs = (balls.join(sizes, ["shard", "ball"]).withColumn("b", F.pmod(F.xxhash64("p"), F.col("blocks")).cast("int"))
                 .withColumn("c", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select("shard", "ball", F.least("b", "c").alias("lo"), F.greatest("b", "c").alias("hi"),
                         (F.col("b") > F.col("c")).cast("int").alias("side"), "p"))
        found = found.union(pairs.groupBy("shard", "ball", "lo", "hi").applyInArrow(blocked, "p long, q long"))
    return found.distinct()


def components(pairs: DataFrame, checkpoint: Callable[[DataFrame, str], DataFrame] = stored) -> DataFrame:
    """Smallest reachable vertex ``root`` for every vertex ``p`` of the links (p, q).

    Alternates "link each neighbour to the smallest one" over larger and over
    smaller neighbours until the links are stars, which they often are from the start;
    each round is written to the shared folder. Numbers compare as signed longs.
    """
    larger = F.greatest("p", "q")
    smaller = F.least("p", "q")
    links_now = checkpoint(pairs.select(larger.alias("p"), smaller.alias("q")).filter("p != q").distinct(), "links")
    while not _are_stars(links_now):
        # Large star: every vertex's larger neighbours go to its smallest neighbour or itself.
        both = links_now.select("p", "q").union(links_now.select(F.col("q").alias("p"), F.col("p").alias("q")))
        least = both.groupBy("p").agg(F.least("p", F.min("q")).alias("m"))
        moved = (links_now.select(F.col("q").alias("v"), F.col("p").alias("u"))
                 .join(least.withColumnRenamed("p", "v"), "v").select("u", "m").filter("u != m"))
        # Small star: a vertex and its smaller neighbours go to the smallest of these.
        moved = checkpoint(moved.distinct(), "large")
        low = moved.groupBy("u").agg(F.min("m").alias("t"))
        small = (moved.join(low, "u").select(F.explode(F.array("u", "m")).alias("p"), F.col("t").alias("q"))
                 .filter("p != q").distinct())
        links_now = checkpoint(small, "small")
    return links_now.select("p", F.col("q").alias("root"))


def _are_stars(pairs: DataFrame) -> bool:
    """Whether every p has one q, and no q is a p."""
    ends = F.explode(F.array(F.struct(F.col("p").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                             F.struct(F.col("q").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    seen = pairs.select(ends.alias("e")).select("e.*").groupBy("v").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def classes(points: DataFrame, max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS,
            tree_sample: int = TREE_SAMPLE) -> DataFrame:
    """``points`` (p, least) with ``root``, a point that stands for p's component, and
    ``component``, the least value over it."""
    roots = stored(components(edges(points, max_bits, shard_points, tree_sample)), "roots")
    members = roots.union(roots.select(F.col("root").alias("p"), "root").distinct())
    linked = members.join(points, "p").select("p", "root", "least")
    best = linked.groupBy("root").agg(F.min("least").alias("component"))
    found = linked.join(best, "root").select("p", "root", "component")
    return points.join(found, "p", "left").select(
        "p", F.coalesce("root", "p").alias("root"), F.coalesce("component", "least").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS,
                    tree_sample: int = TREE_SAMPLE) -> DataFrame:
    """One row per row of ``docs``: id_col, fingerprint (16 hex digits), component_id.

    component_id is the smallest id among the documents reachable over links; ids
    that are null count as larger than all others (a group of nulls alone has null).
    """
    own, found = _grouped(docs, id_col, text_col, size, max_bits, shard_points, tree_sample)
    return own.join(found, "p").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("p"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE, max_bits: int = MAX_BITS,
             shard_points: int = SHARD_POINTS, tree_sample: int = TREE_SAMPLE,
             *further: Column) -> tuple[DataFrame, DataFrame]:
    """(id, p) and the ``further`` columns of every row, and (p, root, component) of every
    distinct fingerprint."""
    own = with_fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *further), "text", size, "p")
    own = stored(own.drop("text"), "fingerprints")
    points = stored(own.groupBy("p").agg(F.min("id").alias("least")), "points")
    return own, stored(classes(points, max_bits, shard_points, tree_sample), "classes")


def _row_key(id_col: str, text_col: str) -> Column:
    """Digest of the text, then the id; nulls have forms of their own."""
    return F.concat(F.coalesce(F.sha2(text_col, 256), F.lit("-")), F.coalesce(F.concat(F.lit(":"), F.col(id_col).cast("string")),
                                                                              F.lit("")))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
               max_bits: int = MAX_BITS, shard_points: int = SHARD_POINTS, tree_sample: int = TREE_SAMPLE) -> DataFrame:
    """One document of each group: that with the smallest id.

    Of several texts of a group under this id, the one with the smallest digest stays, and
    of equal rows one. A group in which no document has an id keeps one of its rows. Texts
    of different groups that share an id are kept in each group whose smallest id it is.
    """
    key = _row_key(id_col, text_col)
    own, found = _grouped(docs, id_col, text_col, size, max_bits, shard_points, tree_sample, key.alias("key"))
    first = own.join(found, "p").filter(F.col("id").eqNullSafe(F.col("component"))).groupBy("root").agg(F.min("key").alias("__key__"))
    # Both steps deal rows by the key, so the texts are shuffled once. Other columns stay out of the key's reach.
    rows = carried(docs, text_col, id_col).withColumn("__key__", key)
    kept = rows.join(first.select("__key__"), "__key__", "left_semi").dropDuplicates(["__key__"])
    return restored(kept, docs, text_col, id_col)
