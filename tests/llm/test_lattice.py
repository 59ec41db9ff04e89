"""E8 lattice hashing against all pairs."""

import itertools

import numpy as np

from tramline.llm import lattice, queries

SF = "/root/testdata/sf0.01"


def all_pairs(rows, limit=lattice.MIN_COSINE):
    """(id, n_links, component, kept) by comparing every pair."""
    near = [[] for _ in rows]
    unit = []
    for _, v, label in rows:
        x = None if v is None or label is None or any(c is None for c in v) else np.array(v, float)
        ok = x is not None and len(x) and np.isfinite(x).all() and x.any()
        unit.append(x / np.abs(x).max() if ok else None)
    for i, j in itertools.combinations(range(len(rows)), 2):
        x, y = unit[i], unit[j]
        if x is not None and y is not None and rows[i][2] == rows[j][2] and len(x) == len(y) and (
                x @ y / np.sqrt((x @ x) * (y @ y)) >= limit):
            near[i].append(j)
            near[j].append(i)
    out = []
    for i, (own, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((own, len(near[i]), least, own == least))
    return sorted(out, key=repr)


def run(spark, rows, schema="vec_id long, embedding array<float>, label int", **args):
    df = spark.createDataFrame(rows, schema)
    return sorted(map(tuple, lattice.near_duplicates(df, **args).collect()), key=repr)


def planted(rng, n_groups, cosines, size=64):
    """Vectors and copies at given cosines, as float32 like the tables."""
    rows = []
    for _ in range(n_groups):
        x = rng.normal(size=size)
        x /= np.linalg.norm(x)
        label = int(rng.integers(3))
        rows.append((len(rows), x, label))
        for c in cosines:
            z = rng.normal(size=size)
            z -= (z @ x) * x
            z /= np.linalg.norm(z)
            rows.append((len(rows), c * x + np.sqrt(1 - c * c) * z, label))
    return [(i, np.float32(v * rng.uniform(0.1, 9)).tolist(), label) for i, v, label in rows]


def test_decoding_finds_the_nearest_point():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8)) * 2
    points = lattice.e8_decode(x)
    doubled = 2 * points
    assert (doubled == np.rint(doubled)).all() and (points.sum(1) % 2 == 0).all()
    assert ((doubled % 2).min(1) == (doubled % 2).max(1)).all()  # all whole or all halves
    near = lattice._shortest()
    assert len(near) == 240 and np.allclose((near ** 2).sum(1), 2)
    rest = x - points
    # No neighbour is nearer, so the point is the nearest: a cell's faces belong to the 240 neighbours.
    assert ((rest ** 2).sum(1)[:, None] <= ((rest[:, None] - near[None]) ** 2).sum(2) + 1e-12).all()


def test_cells_do_not_depend_on_the_batch():
    rng = np.random.default_rng(4)
    q = lattice.rounded(rng.normal(size=(200, 64)))
    cells = lattice.Lattice(64).cells(q)
    assert all((lattice.Lattice(64).cells(q[i:i + 1]) == cells[i]).all() for i in range(0, 200, 17))
    assert all(len(set(row[t].tolist())) == 1 + lattice.PROBES for row in cells for t in range(lattice.TABLES))


def test_rounding_error_is_bounded():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 64)) * rng.choice([1e-30, 1, 1e30], (400, 1))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    q = lattice.rounded(x).astype(np.float32) / np.float32(32767)
    assert np.abs(q @ q.T - unit @ unit.T).max() < lattice.margin(64)


def test_whole_table_equals_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = sorted(map(tuple, queries.op13_lattice_neardup(spark, SF).collect()), key=repr)
    assert got == all_pairs(rows)


def test_recall_against_all_pairs(spark):
    rng = np.random.default_rng(6)
    rows = planted(rng, 120, (0.9301, 0.935, 0.95, 0.98, 0.9299, 0.92))
    got, want = run(spark, rows), all_pairs(rows)
    found, total = sum(r[1] for r in got), sum(r[1] for r in want)
    assert 0.98 * total <= found <= total
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))  # nothing below the limit


def test_pairs_at_the_limit_are_decided_exactly(spark):
    # 3-4-5: cosines of exactly 0.96 and 0.8, and whole numbers that round well.
    rows = [(1, [3.0, 4.0], 0), (2, [4.0, 3.0], 0), (3, [1.0, 0.0], 0), (4, [5.0, 0.0], 0)]
    for limit in (0.96, 0.9600001, 0.8):
        assert run(spark, rows, min_cosine=limit, probes=5) == all_pairs(rows, limit)


def test_blocks_of_a_hot_cell_give_the_same(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=16)
    rows = [(i, (base + 0.05 * rng.normal(size=16)).tolist(), 1) for i in range(300)]
    rows += [(1000 + i, rng.normal(size=16).tolist(), 1) for i in range(50)]
    want = all_pairs([(i, np.float32(v).tolist(), k) for i, v, k in rows])
    assert run(spark, rows) == want
    assert run(spark, rows, cell_rows=40) == want


def test_copies_are_one_class(spark):
    rows = [(i, [1.0, 2.0, -0.0], 5) for i in range(200, 0, -1)] + [(500, [2.0, 4.0, 0.0], 5), (501, [1.0, 2.0, 0.0], 6)]
    got = run(spark, rows)
    assert (500, 200, 1, False) in got and (1, 200, 1, True) in got and (501, 0, 501, True) in got


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1),
            (7, [1.0, 1.0], None), (8, [1.0, 1.0], None), (9, [1.0, 1.0], 1), (9, [1.0, 1.0], 1), (None, [1.0, 1.0], 1),
            (10, [1.0, 1.0, 0.0], 1), (None, [3.0, 1.0], 2), (None, [3.0, 1.0], 2), (11, [1e-30, 1e-30], 1), (None, None, 1)]
    got = run(spark, rows)
    want = all_pairs(rows)
    # A row without an id is its own component's id only where the whole component has none.
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert lattice.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    clash = spark.createDataFrame([(1, [1.0, 0.0], 1, 7, 7, 7, 7), (2, [1.0, 0.1], 1, 7, 7, 7, 7)],
                                  "vec_id long, embedding array<double>, label int, id int, KEY int, v int, cid int")
    assert sorted(map(tuple, lattice.near_duplicates(clash).collect())) == [(1, 1, 1, True), (2, 1, 1, False)]
