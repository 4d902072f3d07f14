from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import oracle
import pytest

from tidemark.llm import catalog, codes

ROWS = "vec_id long, embedding array<double>, label int, code string, error string, _vec int, id int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "c", "e", 1, 2) for i, v, label in rows], ROWS)


def plain(rows, parts=16, entries=64, rounds=2):
    """Codes and errors by Python integers and full distances."""
    kept = [(i, [math.floor(256 * x) for x in v], c) for i, v, c in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    kept = [(i, v + [0] * (parts * width - len(v)), c) for i, v, c in kept]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    first = {}
    for (i, _, _), v in zip(kept, cut, strict=True):
        first[i] = min(first.get(i, v), v)
    order = sorted(first, key=lambda i: (i is None, i or 0))[:entries]
    books = [[first[i][p] for i in order] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        members = defaultdict(list)
        for v in cut:
            for p in range(parts):
                members[p, near(p, v[p])[1]].append(v[p])
        for (p, e), held in members.items():
            books[p][e] = [sum(column) // len(held) for column in zip(*held, strict=True)]
    found = [[near(p, v[p]) for p in range(parts)] for v in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = defaultdict(int)
    for (_, _, c), e in zip(kept, errors, strict=True):
        by_label[c] += e
    digest = hashlib.sha256(",".join(str(x) for p in books for c in p for x in c).encode()).hexdigest()
    return sorted(
        (i or -1, "".join(f"{e:02x}" for _, e in f), error, by_label[c], digest)
        for (i, _, c), f, error in zip(kept, found, errors, strict=True)
    )


def got(spark, rows):
    return sorted((r.vec_id or -1, *r[1:]) for r in codes.coded_rows(table(spark, rows)).collect())


def test_query_equals_sql(spark, sf_dir):
    df = catalog.op11_integer_codes(spark, sf_dir)
    assert oracle.difference(df, oracle.connect(sf_dir), codes.SQL) is None


def test_equals_plain_integers_with_odd_rows(spark):
    draw = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in draw.integers(-3, 4, 32) / 256], int(i) % 3 or None) for i in draw.permutation(150)]
    rows += [(7, list(rows[3][1]), 1), (7, list(rows[4][1]), 1), rows[9], (None, list(rows[2][1]), 2)]
    rows += [(900, None, 1), (901, [0.5, None] * 16, 1), (902, [math.nan] + [0.0] * 31, 1), (903, [math.inf] + [0.0] * 31, None)]
    rows += [(904, [0.1, -0.2], 1), (905, [], 2), (906, [0.0] * 32, None)]
    assert got(spark, rows) == plain(rows)


def test_fewer_rows_than_entries_and_lengths_that_parts_do_not_divide(spark):
    rows = [(5, [0.25] * 19, None), (3, [-0.3] * 19, None), (4, [-0.3] * 19, 1)]
    assert got(spark, rows) == plain(rows)


def test_components_beyond_64_bit_squares(spark):
    draw = np.random.default_rng(6)
    rows = [(i, [float(x) for x in draw.integers(-(2**20), 2**20, 16)], 0) for i in range(90)]
    assert got(spark, rows) == plain(rows)
    wide = [(1, [1e300] + [0.0] * 15, 0), (2, [-1e300] + [0.0] * 15, 0), (3, [0.0] * 16, 0)]
    assert [r[2] for r in got(spark, wide)] == [0, 0, 0]
    wide += [(4 + i, [float(i)] * 16, 1) for i in range(62)] + [(80, [2.0**40] * 16, 2), (81, [2.0**41] * 16, 2), (82, [1.0] * 16, 2)]
    found = {r[0]: r[2:4] for r in got(spark, wide)}
    assert found[80] == found[81] == (None, None) and found[82] == (0, None) and found[5][0] == 0


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [], 1), (2, [], None)]])
def test_nothing_to_code(spark, rows):
    found = got(spark, rows)
    assert [r[0] for r in found] == [r[0] for r in rows if r[1] is not None]
    assert all(r[2:4] == (0, 0) for r in found)


def test_other_columns_travel_along(spark):
    df = table(spark, [(1, [0.5] * 16, 3), (2, [0.25] * 16, None)])
    out = codes.compressed(df, codes.fit(df))
    assert out.columns == ["vec_id", "label", "code", "error", "_vec", "id", "_code", "_error"]
    assert sorted((r.vec_id, r.code, r._code[0], r._error) for r in out.collect()) == [(1, "c", 0, 0), (2, "c", 1, 0)]


def test_functions_are_in_order_of_sign_changes():
    for size in (1, 2, 4, 8, 32):
        rows = codes.transformed(np.eye(size, dtype=np.int64)).T
        changes = (np.diff(np.sign(rows), axis=1) != 0).sum(axis=1)
        assert changes.tolist() == list(range(size))


def test_early_end_changes_nothing():
    draw = np.random.default_rng(7)
    for width in (1, 3, 4, 11):
        points, entries = draw.integers(-9, 9, (300, width)), draw.integers(-9, 9, (40, width))
        full = ((points[:, None] - entries) ** 2).sum(axis=2)
        code, far = codes.nearest(codes.transformed(points), codes.transformed(entries))
        assert (code == full.argmin(axis=1)).all() and (far == full.min(axis=1)).all()
