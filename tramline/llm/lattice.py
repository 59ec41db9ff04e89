"""Embedding near-duplicates by lattice hashing.

Every vector is projected onto eight random orthonormal directions per table and the
projection is decoded to the nearest point of the E8 lattice. The vector goes to that
point's cell and to the neighbouring cells whose lattice points are nearest (the
probes). Vectors of one label that share a cell in some table are compared; links are
pairs whose cosine reaches the limit.

Equal vectors of a label are one class, found first, so copies are never compared.
A cell of more than ``cell_rows`` classes is cut into blocks, and pairs of blocks are dealt to
different tasks; nothing is left out. A task returns one row per class: its links counted
and the smallest class it is joined to. No list of pairs arises. A pair that shares several
cells counts in the first one only (smallest table, then cell).

Cells and comparisons use unit vectors rounded to 16 bits; the rounding error is bounded, and
a pair within that bound of the limit is decided on the stored vectors in double precision.

Nulls: a vector that is null, empty, zero, or holds a null or a component that isn't finite
links with nothing, nor does one without a label or with another number of components.
Every row keeps its place, repeated ids too. An id that is null counts as larger than all.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import merge_groups, stored
from tramline.llm.simhash import components

MIN_COSINE = 0.93
TABLES = 4
# Cells beside its own that a vector is dealt to in each table.
PROBES = 1
# Lattice units per unit of length, for 64 components. At cosine 0.93 two vectors share a
# cell of one table with probability 0.84, at 0.97 with 0.92; random ones with 0.05.
SCALE = 2.5
# Classes compared in one task.
CELL_ROWS = 4096
# Cells cut into blocks whose list may be broadcast (about 40 bytes each).
MAX_HOT_BROADCAST = 200_000
_STEP = 32767
_BLOCK = (512, 2048)


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest integer vectors with an even sum."""
    r = np.rint(x)
    off = x - r
    odd = np.flatnonzero(r.sum(1) % 2)
    at = np.abs(off[odd]).argmax(1)
    r[odd, at] += np.where(off[odd, at] >= 0, 1, -1)
    return r


def e8_decode(x: np.ndarray) -> np.ndarray:
    """Nearest points of the E8 lattice: even-sum integers, or these shifted by a half."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(nearer[:, None], whole, half)


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[[i, j]] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


class Lattice:
    """Cells of rounded vectors of one length. All sums are of whole numbers below 2^53, so a
    vector has the same cells in every batch and task."""

    def __init__(self, size: int, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, seed: int = 7) -> None:
        self.tables, self.probes = tables, probes
        self.width = max(8, size)
        rng = np.random.default_rng([seed, size])
        unit = scale * np.sqrt(self.width / 64) / _STEP / (1 << 20)
        self.turns, self.shifts, self.unit = [], [], unit
        for _ in range(tables):
            q, _ = np.linalg.qr(rng.normal(size=(self.width, self.width)))
            self.turns.append(np.rint(q[:, :8] * (1 << 20)))
            self.shifts.append(rng.uniform(0, 1, 8))
        self.near = _shortest()

    def cells(self, q: np.ndarray) -> np.ndarray:
        """(rows, tables, 1 + probes) cell codes of rounded unit vectors, the own cell first."""
        x = np.zeros((len(q), self.width))
        x[:, :q.shape[1]] = q
        out = np.empty((len(q), self.tables, 1 + self.probes), np.int64)
        for t, (turn, shift) in enumerate(zip(self.turns, self.shifts, strict=True)):
            y = (x @ turn) * self.unit + shift
            own = e8_decode(y)
            out[:, t, 0] = _code(own)
            # Of the neighbours own + v the nearest to y have the largest (y - own) . v - |v|^2 / 2, and all |v| are equal.
            toward = np.zeros((len(y), len(self.near)))
            for k in range(8):
                toward += (y - own)[:, k, None] * self.near[None, :, k]
            order = np.argsort(-toward, axis=1, kind="stable")[:, :self.probes]
            for p in range(self.probes):
                out[:, t, 1 + p] = _code(own + self.near[order[:, p]])
        return out


def _code(points: np.ndarray) -> np.ndarray:
    """Lattice points as one number each: twice their coordinates, a byte each."""
    return np.ascontiguousarray((2 * points).astype(np.int8)).view(np.int64)[:, 0]


def rounded(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in steps of 1 / 32,767."""
    scaled = vectors / np.abs(vectors).max(1)[:, None]  # squares neither overflow nor vanish
    return np.rint(scaled / np.sqrt((scaled ** 2).sum(1))[:, None] * _STEP).astype(np.int16)


def margin(size: int) -> float:
    """Bound of the error of a cosine of two rounded vectors: half a step per component and
    vector, their product, and single-precision sums."""
    return 1.02 * np.sqrt(size) / _STEP + size * 1e-7


def compare_cell(q: np.ndarray, weight: np.ndarray, side: np.ndarray | None, lattice: Lattice, table: int, code: int,
                 min_cosine: float, bound: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links among the rows of one cell, or between two blocks of it.

    ``side`` is None for a whole cell or block; 0 or 1 per row for two blocks, which are
    compared with each other only. Returns the number of vectors linked per row,
    the smallest row of each row's group, and the pairs to be decided exactly (both rows).
    Pairs whose first common cell is another one count there, but join groups here too.
    """
    n = len(q)
    counts, label = np.zeros(n, np.int64), np.arange(n)
    cells = None  # most cells hold no links
    unsure: list[tuple[np.ndarray, np.ndarray]] = []
    unit = q.astype(np.float32) / np.float32(_STEP)
    one = np.arange(n) if side is None else np.flatnonzero(side == 0)
    two = one if side is None else np.flatnonzero(side == 1)
    for a in range(0, len(one), _BLOCK[0]):
        at = one[a:a + _BLOCK[0]]
        for b in range(0 if two is not one else a, len(two), _BLOCK[1]):
            to = two[b:b + _BLOCK[1]]
            dots = unit[at] @ unit[to].T
            i, j = np.nonzero(dots >= min_cosine - bound)
            sure = dots[i, j] >= min_cosine + bound
            i, j = at[i], to[j]
            if two is one:
                later = i < j
                i, j, sure = i[later], j[later], sure[later]
            if not len(i):
                continue
            merge_groups(label, i[sure], j[sure])
            cells = lattice.cells(q) if cells is None else cells
            first = _first_meeting(cells, i, j, table, code)
            unsure.append((i[first & ~sure], j[first & ~sure]))
            i, j = i[first & sure], j[first & sure]
            counts += np.bincount(i, weight[j], n).astype(np.int64) + np.bincount(j, weight[i], n).astype(np.int64)
    left = np.concatenate([x for x, _ in unsure]) if unsure else np.zeros(0, np.int64)
    right = np.concatenate([x for _, x in unsure]) if unsure else np.zeros(0, np.int64)
    return counts, label, left, right


def _first_meeting(cells: np.ndarray, i: np.ndarray, j: np.ndarray, table: int, code: int) -> np.ndarray:
    """Whether the given cell is the first that rows i and j share."""
    first = np.ones(len(i), bool)
    for t in range(table + 1):
        common = np.full(len(i), np.iinfo(np.int64).max)
        for a, b in itertools.product(range(cells.shape[2]), repeat=2):
            x = cells[i, t, a]
            common = np.where(x == cells[j, t, b], np.minimum(common, x), common)
        first &= (common == np.iinfo(np.int64).max) if t < table else (common == code)
    return first


def usable(vector: str) -> Column:
    """Whether the vector has a direction: components, all of them finite, not all zero."""
    value = F.col(vector)
    finite = F.forall(value, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    min_cosine: float = MIN_COSINE, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE,
                    cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per row of ``vectors``: id_col, n_links, component_id, kept.

    n_links counts the other rows linked directly, component_id is the smallest id reachable
    over links, kept says whether that is the row's own id.
    """
    named = vectors.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"),
                           F.col(vector_col).cast("array<double>").alias("v"))
    # A row's class: a digest of label and components. The others get none and stay alone. 0.0 makes -0.0 equal to 0.
    same = F.transform("v", lambda x: x + F.lit(0.0))
    key = F.when(F.col("label").isNotNull() & usable("v"), F.sha2(F.to_json(F.struct("label", same.alias("v"))), 256))
    rows = named.withColumn("key", key)
    own = stored(rows.select("id", "key"), "lattice-rows")
    classes = stored(
        rows.filter("key IS NOT NULL").groupBy("key").agg(
            F.min("id").alias("least"), F.count(F.lit(1)).alias("n"), F.first("label").alias("label"), F.first("v").alias("v"))
        .withColumn("cid", F.monotonically_increasing_id()), "lattice-classes")
    linked, unsure = compare(classes, min_cosine, tables, probes, scale, cell_rows)
    exact = _decide(unsure, classes, min_cosine)
    both = exact.select(F.col("p").alias("cid"), F.col("q_n").alias("links"), F.col("q").alias("other")).union(
        exact.select(F.col("q").alias("cid"), F.col("p_n").alias("links"), F.col("p").alias("other")))
    found = stored(linked.select("cid", "links", F.col("root").alias("other")).union(both), "lattice-links")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.filter("cid != other").select(F.col("cid").alias("p"), F.col("other").alias("q")))
    members = roots.union(roots.select(F.col("root").alias("p"), "root").distinct()).withColumnRenamed("p", "cid")
    slim = classes.select("cid", "key", "least", "n")
    placed = slim.join(members, "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    best = placed.groupBy("root").agg(F.min("least").alias("component"))
    known = placed.join(best, "root").join(counts, "cid", "left").select(
        "key", "component", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"))
    # Rows without a class have no key, and a null key joins nothing.
    joined = own.join(known, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component"))
    return joined.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def compare(classes: DataFrame, min_cosine: float, tables: int, probes: int, scale: float,
            cell_rows: int) -> tuple[DataFrame, DataFrame]:
    """Links of the classes: (cid, links, root) partial counts and smallest group members per
    task, and (p, q), the pairs too near to the limit for the rounded vectors."""
    entries = classes.select("cid", "label", F.col("n").cast("long").alias("n"), "v").mapInArrow(
        _entries(tables, probes, scale), "label string, size int, table int, code long, cid long, n long, q binary")
    cell = ["label", "size", "table", "code"]
    hot = stored(entries.groupBy(*cell).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > cell_rows), "lattice-hot")
    if hot.count() <= MAX_HOT_BROADCAST:
        hot = F.broadcast(hot)
    blocks = F.coalesce(F.ceil(F.col("rows") / cell_rows * 2).cast("int"), F.lit(1))
    own = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    # A row of block b meets every block c: in task (min, max) on its own side.
    dealt = (entries.join(hot, cell, "left").withColumn("blocks", blocks).withColumn("b", own)
             .withColumn("c", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(*cell, F.least("b", "c").alias("lo"), F.greatest("b", "c").alias("hi"),
                     (F.col("b") > F.col("c")).cast("int").alias("side"), "cid", "n", "q"))
    made = stored(dealt.groupBy(*cell, "lo", "hi").applyInArrow(
        _linked(min_cosine, tables, probes, scale), "cid long, links long, root long, other long"), "lattice-compared")
    return (made.filter("other IS NULL").select("cid", "links", "root"),
            made.filter("other IS NOT NULL").select(F.col("cid").alias("p"), F.col("other").alias("q")))


def _entries(tables: int, probes: int, scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices: dict[int, Lattice] = {}
        for batch in batches:
            lists = batch.column("v")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(sizes) - sizes
            for size in np.unique(sizes).tolist():
                lattice = lattices.get(size) or lattices.setdefault(size, Lattice(size, tables, probes, scale))
                at = np.flatnonzero(sizes == size)
                q = rounded(flat[starts[at, None] + np.arange(size)])
                cells = lattice.cells(q).reshape(len(at), -1)
                per = cells.shape[1]
                # A probe never repeats the own cell, so a row is once in each of its cells.
                rows = np.repeat(at, per)
                packed = pa.array([x.tobytes() for x in q], pa.binary()).take(pa.array(np.repeat(np.arange(len(at)), per)))
                yield pa.RecordBatch.from_arrays([
                    batch.column("label").take(pa.array(rows)), pa.array(np.full(len(rows), size, np.int32)),
                    pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), per // tables), len(at))),
                    pa.array(cells.ravel()), batch.column("cid").take(pa.array(rows)), batch.column("n").take(pa.array(rows)),
                    packed], names=["label", "size", "table", "code", "cid", "n", "q"])

    return run


def _linked(min_cosine: float, tables: int, probes: int, scale: float):
    lattices: dict[int, Lattice] = {}

    def run(group: pa.Table) -> pa.Table:
        cid = group.column("cid").to_numpy()
        empty = np.zeros(0, np.int64)
        out = [(empty, empty, empty), (empty, empty)]
        if len(cid) > 1:
            size = group.column("size")[0].as_py()
            lattice = lattices.get(size) or lattices.setdefault(size, Lattice(size, tables, probes, scale))
            q = np.frombuffer(b"".join(group.column("q").to_pylist()), np.int16).reshape(len(cid), size)
            side = None if group.column("lo")[0] == group.column("hi")[0] else group.column("side").to_numpy()
            counts, label, left, right = compare_cell(
                q, group.column("n").to_numpy(), side, lattice,
                group.column("table")[0].as_py(), group.column("code")[0].as_py(), min_cosine, margin(size))
            some = np.flatnonzero((counts > 0) | (label != np.arange(len(cid))))
            out = [(cid[some], counts[some], cid[label[some]]), (cid[left], cid[right])]
        (a, links, root), (p, other) = out
        none = [None] * len(p)
        return pa.table({
            "cid": pa.array(np.concatenate([a, p])), "links": pa.concat_arrays([pa.array(links), pa.array(none, pa.int64())]),
            "root": pa.concat_arrays([pa.array(root), pa.array(none, pa.int64())]),
            "other": pa.concat_arrays([pa.array([None] * len(a), pa.int64()), pa.array(other)])})

    return run


def _decide(unsure: DataFrame, classes: DataFrame, min_cosine: float) -> DataFrame:
    """Those of the pairs (p, q) that reach the limit in double precision, with both classes' sizes."""
    p = classes.select(F.col("cid").alias("p"), F.col("v").alias("p_v"), F.col("n").alias("p_n"))
    q = classes.select(F.col("cid").alias("q"), F.col("v").alias("q_v"), F.col("n").alias("q_n"))
    both = unsure.join(p, "p").join(q, "q")
    total = F.lit(0.0)
    # Divided by the largest component first: squares neither overflow nor vanish.
    for side in ("p", "q"):
        most = F.greatest(F.array_max(f"{side}_v"), -F.array_min(f"{side}_v"))
        both = both.withColumn("most", most).withColumn(f"{side}_s", F.transform(f"{side}_v", lambda x: x / F.col("most")))
    dot = F.aggregate(F.zip_with("p_s", "q_s", lambda x, y: x * y), total, lambda s, x: s + x)
    norm = {side: F.sqrt(F.aggregate(f"{side}_s", total, lambda s, x: s + x * x)) for side in ("p", "q")}
    return both.filter(dot / (norm["p"] * norm["q"]) >= min_cosine).select("p", "q", "p_n", "q_n")
