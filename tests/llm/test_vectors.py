"""Operators on vectors, on hand-made tables against plain Python and numpy."""

import math
from hashlib import sha256

import numpy as np
import pytest

from strikeloom.llm import bidiagonal, vector_codes, whitening
from strikeloom.llm.queries import op11_vector_codes, op13_whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, _id int"


def odd_vectors(width=32, n=300):
    random = np.random.default_rng(5)
    base = (random.standard_normal((n, width)) * np.linspace(1.5, 0.2, width)).astype(np.float32).tolist()
    rows = [(k, v, k % 4 or None, "x", k) for k, v in enumerate(base)]
    rows += [(1000 + k, base[7], 2, None, None) for k in range(n // 2)]
    rows += [(3, base[9], 1, None, None), (3, base[9], 1, None, None), (None, base[11], None, None, None)]
    holed = list(base[0])
    holed[3] = None
    rows += [
        (5000, None, 1, None, None),
        (5001, holed, 1, None, None),
        (5002, [float("nan"), *base[0][1:]], 1, None, None),
        (5003, [*base[0][:-1], float("-inf")], 1, None, None),
        (5004, base[0][:-1], 1, None, None),
        (5005, [], 1, None, None),
        (5006, [-0.0] * width, 1, None, None),
    ]
    return rows


def whole(rows, width=32):
    kept = []
    for vec_id, vector, label, *_ in rows:
        if vector is None or len(vector) != width or any(c is None or not math.isfinite(c) for c in vector):
            continue
        kept.append((vec_id, label, [math.floor(256 * float(np.float32(c))) for c in vector]))
    return kept


@pytest.fixture(scope="module")
def vectors(spark):
    return spark.createDataFrame(odd_vectors(), SCHEMA)


def plain_codes(kept, width, parts, entries, rounds):
    """The same codebooks and codes with plain integers, one distance at a time."""
    kept = sorted(kept, key=lambda row: (row[0] is None, row[0] or 0, row[2]))
    size = width // parts
    cut = [[x[p * size : (p + 1) * size] for p in range(parts)] for _, _, x in kept]
    books = [[list(row[p]) for row in cut[:entries]] for p in range(parts)]

    def assigned(part, book):
        distances = [sum((a - b) ** 2 for a, b in zip(part, entry)) for entry in book]
        return distances.index(min(distances)), min(distances)

    for _ in range(rounds):
        for p in range(parts):
            near = [assigned(row[p], books[p])[0] for row in cut]
            for e in set(near):
                own = [row[p] for row, k in zip(cut, near) if k == e]
                books[p][e] = [sum(column) // len(own) for column in zip(*own)]
    coded = [[assigned(row[p], books[p]) for p in range(parts)] for row in cut]
    errors = {}
    for (_, label, _), codes in zip(kept, coded):
        errors[label] = errors.get(label, 0) + sum(d for _, d in codes)
    rows = [
        (vec_id, "".join(f"{k:02x}" for k, _ in codes), sum(d for _, d in codes), errors[label])
        for (vec_id, label, _), codes in zip(kept, coded)
    ]
    listed = ",".join(str(c) for book in books for entry in book for c in entry)
    return rows, sha256(listed.encode()).hexdigest()


def ordered(rows):
    return sorted(rows, key=lambda row: (row[0] is None, row[0] or 0, *map(str, row[1:])))


@pytest.mark.parametrize("width", [32, 48])
def test_codes_equal_plain_python(spark, tmp_path, width):
    rows = odd_vectors(width, 150)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = op11_vector_codes(spark, str(tmp_path)).collect()
    expected, digest = plain_codes(whole(rows, width), width, 16, 64, 2)
    assert ordered((r.vec_id, r.code, r.error, r.label_error) for r in found) == ordered(expected)
    assert {r.codebooks_sha256 for r in found} == {digest}


def test_codes_decode_to_their_error(spark, vectors):
    rows, codebooks = vector_codes.compressed(vectors, parts=8, entries=16, rounds=3)
    known = {vec_id: x for vec_id, _, x in whole(odd_vectors()) if vec_id not in (3, None)}
    for row in rows.where("vec_id IS NOT NULL AND vec_id <> 3").collect():
        back = vector_codes.decoded(row.codes, codebooks)
        assert sum((a - b) ** 2 for a, b in zip(known[row.vec_id], back)) == row.error


def test_few_and_large_vectors_have_codes(spark):
    rows = [(2, [1e30, -1e30, 0.5], None), (1, [0.0, 1.0, -1.0], None), (4, [3e6, 2.0, 1.0], 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    found, codebooks = vector_codes.compressed(table)
    assert {r.vec_id: r.error for r in found.collect()} == {1: 0, 2: 0, 4: 0}
    assert len(codebooks) == 16
    with pytest.raises(ValueError):
        vector_codes.compressed(table, entries=257)


def test_no_vectors_have_no_codes_and_no_directions(spark, vectors):
    for table in (vectors.limit(0), vectors.where("vec_id = 5005"), vectors.where("embedding IS NULL")):
        assert vector_codes.compressed(table)[0].collect() == []
        assert whitening.whitened(table)[0].collect() == []


def test_wide_value_ranges_use_a_sorted_dictionary():
    values = np.array([5, -(2**40), 5, 2**40, 0])
    distinct, codes = vector_codes.dictionary(values)
    assert distinct[codes].tolist() == values.tolist()
    assert distinct.tolist() == sorted(set(values.tolist()))


def test_whitened_rows_equal_numpy(spark, tmp_path):
    rows = [row for row in odd_vectors() if row[0] != 3]
    spark.createDataFrame(rows, SCHEMA).repartition(40).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = op13_whitening(spark, str(tmp_path)).collect()
    kept = whole(rows)
    fit = np.array(sorted({tuple(x) for _, _, x in kept}), dtype=object)
    n, sums = len(fit), fit.sum(0)
    centred = np.array(fit - sums / n, float)
    covariance = centred.T @ centred / n
    variances, directions = np.linalg.eigh(covariance)
    variances, directions = variances[::-1], directions[:, ::-1]
    assert len(found) == 4 * len(kept)
    by_id = {}
    for row in found:
        by_id.setdefault(row.vec_id, {}).setdefault(row.component, set()).add(row.whitened)
        assert row.n == n
        assert row.explained == pytest.approx(variances[row.component - 1] / np.trace(covariance), rel=1e-9)
        assert 0 <= row.identity_error < 1e-9
    deviations = {row.vec_id: row.deviation for row in found}
    signs = {}
    for vec_id, _, x in kept:
        assert deviations[vec_id] == sum(int(v) ** 2 for v in n * np.array(x, object) - sums)
        for c in range(1, 5):
            expected = (np.array(x, float) - np.array(sums / n, float)) @ directions[:, c - 1]
            expected /= math.sqrt(variances[c - 1])
            (value,) = by_id[vec_id][c]
            sign = signs.setdefault(c, np.sign(value * expected))
            assert value == pytest.approx(sign * expected, abs=1e-8)


def test_directions_without_variance_are_left_out(spark):
    flat = [(k, [float(k % 5), 2.0, -float(k % 5)]) for k in range(20)]
    table = spark.createDataFrame(flat, "vec_id bigint, embedding array<double>")
    rows, fit = whitening.whitened(table)
    assert {row.component for row in rows.collect()} == {1}
    assert fit.n == 5
    one = table.where("vec_id % 5 = 0")
    assert whitening.whitened(one)[0].collect() == []


def test_deviations_beyond_a_long_are_null(spark):
    table = spark.createDataFrame(
        [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [0.0, 0.5])], "vec_id bigint, embedding array<double>"
    )
    found = {row.vec_id: row.deviation for row in whitening.whitened(table)[0].collect()}
    assert found == {1: None, 2: None, 3: 0}


def matrices():
    random = np.random.default_rng(2)
    turned, _ = np.linalg.qr(random.standard_normal((30, 30)))
    paired = random.standard_normal((60, 15))
    return {
        "random": random.standard_normal((50, 20)),
        "few rows": random.integers(-3, 4, (6, 20)).astype(float),
        "equal values": turned * np.repeat([5.0, 3.0, 1.0], 10) @ turned.T,
        "close values": turned * (1 + 1e-9 * np.arange(30)) @ turned.T,
        "wide range": turned * np.logspace(0, -10, 30) @ turned.T,
        "equal columns": np.hstack([paired, paired]),
        "diagonal": np.diag([3.0, 0.0, 2.0, 2.0, 0.0]),
        "nothing": np.zeros((4, 4)),
        "one": np.full((3, 1), 2.0),
    }


@pytest.mark.parametrize("name", list(matrices()))
def test_singular_values_and_vectors(name):
    a = matrices()[name]
    r = np.linalg.qr(a, mode="r")
    width = a.shape[1]
    r = np.vstack([r, np.zeros((width - len(r), width))])
    values, vectors = bidiagonal.top_singular(r, width)
    expected = np.linalg.svd(a, compute_uv=False) ** 2
    expected = np.concatenate([expected, np.zeros(width - len(expected))])
    largest = max(expected[0], 1e-300)
    assert np.abs(values - expected).max() <= 1e-13 * largest
    assert np.abs(vectors.T @ vectors - np.eye(width)).max() < 1e-12
    assert np.abs(a.T @ a @ vectors - vectors * values).max() <= 1e-12 * largest
