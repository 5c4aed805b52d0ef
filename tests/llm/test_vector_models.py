"""Vector codes against full comparison, whitening against numpy, and the cases of the contracts."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from opsgrain.llm import vector_codes, whitening
from opsgrain.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, n int"


def brute_codes(x: np.ndarray, parts: int, entries: int, rounds: int):
    x = x.reshape(len(x), parts, -1)
    books = x[:entries].transpose(1, 0, 2).copy()

    def assigned():
        away = ((x[:, :, None] - books[None]) ** 2).sum(-1)
        return away.argmin(-1), away.min(-1).sum(-1)

    for _ in range(rounds):
        code, _ = assigned()
        for p in range(parts):
            for e in range(books.shape[1]):
                mine = x[code[:, p] == e, p]
                if len(mine):
                    books[p, e] = mine.sum(0) // len(mine)
    return (*assigned(), books)


def test_balls_equal_full_comparison():
    rng = np.random.default_rng(5)
    for spread in (1, 3, 50, 100_000):
        points = rng.integers(-spread, spread + 1, (4000, 4))
        book = rng.integers(-spread, spread + 1, (64, 4))
        book[9] = book[3]  # equal entries: the lower index wins
        best = vector_codes.nearest(points, book)
        balls = vector_codes.Balls(book)
        for old in (best, rng.integers(0, 64, 4000), np.full(4000, 9)):
            entry, away = balls.assign(points, old)
            assert (entry == best).all() and (away == vector_codes.squares(points, book[best])).all()
    # points in a stable core are not compared
    far = vector_codes.Balls(np.array([[0, 0], [100, 0], [0, 100]]))
    assert (4 * 49**2 < far.gaps[:, 0]).all() and len(far.neighbours(0, 49**2)) == 0
    assert far.neighbours(0, 50**2).tolist() == [1, 2]


def test_many_pairs_in_portions(monkeypatch):
    rng = np.random.default_rng(6)
    points, book = rng.integers(-9, 10, (500, 4)), rng.integers(-9, 10, (64, 4))
    want = vector_codes.nearest(points, book)
    monkeypatch.setattr(vector_codes, "PAIRS", 70)
    assert (vector_codes.nearest(points, book) == want).all()
    assert (vector_codes.Balls(book).assign(points, rng.integers(0, 64, 500))[0] == want).all()


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_codes_equal_full_comparison_with_bad_rows(spark):
    rng = np.random.default_rng(2)
    # a third of the rows is one vector; ids do not follow the rows
    vectors = rng.normal(size=(300, 32)).astype(np.float32)
    vectors[::3] = vectors[0]
    ids = rng.permutation(300) * 7
    rows = [(int(i), v.tolist(), None if k % 5 == 0 else k % 4, "x", 1) for k, (i, v) in enumerate(zip(ids, vectors))]
    bad = [(-5, None, 1, "x", 1), (-4, [], 1, "x", 1), (-3, [1.0] * 31 + [None], 1, None, 1), (-2, [float("nan")] * 32, 1, "x", 1),
           (-1, [float("inf")] * 32, None, "x", 1), (3, [1.0] * 16, 1, "x", 1), (4, [1.0] * 33, 1, "x", 1)]
    codes, books = vector_codes.compress(table(spark, rows + bad).repartition(5), entries=64)
    got = {r["vec_id"]: (list(r["code"]), r["error"], r["label_error"]) for r in vector_codes.with_label_error(codes).collect()}
    order = np.argsort(ids)
    x = np.floor(vectors[order].astype(np.float64) * 256).astype(np.int64)
    code, error, want = brute_codes(x, 16, 64, 2)
    assert (books == want).all()
    labels = [rows[k][2] for k in order]
    sums = {lab: sum(int(e) for e, of in zip(error, labels) if of == lab) for lab in set(labels)}
    assert got == {int(ids[k]): (code[i].tolist(), int(error[i]), sums[labels[i]]) for i, k in enumerate(order)}
    assert ((vector_codes.decoded(bytes(code[0].tolist()), books) - x[0]) ** 2).sum() == error[0]


def test_codes_of_few_and_no_rows(spark):
    same = [(1, [0.5] * 16, None, "x", 1)] * 3 + [(None, [-0.001] * 16, None, "x", 1)]
    codes, books = vector_codes.compress(table(spark, same))
    # four rows make four entries; the three equal ones share the first, the others stay
    assert books.shape == (16, 4, 1) and books[0, :, 0].tolist() == [128, 128, 128, -1]
    assert sorted((r["vec_id"] or 0, bytes(r["code"]).hex(), r["error"]) for r in codes.collect()) == [(0, "03" * 16, 0)] + [(1, "00" * 16, 0)] * 3
    codes, books = vector_codes.compress(table(spark, same).limit(0))
    assert codes.count() == 0 and books.size == 0
    assert vector_codes.digest(books) == hashlib.sha256(b"").hexdigest()
    huge = table(spark, [(i, [3.4e38 * (-1) ** i] * 16, 1, "x", 1) for i in range(4)])
    codes, books = vector_codes.compress(huge, entries=2)
    assert [r["error"] for r in codes.collect()] == [0] * 4 and abs(books).max() == vector_codes.LARGEST
    with pytest.raises(ValueError):
        vector_codes.compress(huge, entries=257)


def numpy_whitening(x: np.ndarray):
    n, sums = len(x), x.sum(0)
    centred = x - sums / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    return ((n * x - sums) ** 2).sum(1), values[::-1], centred @ directions[:, ::-1] / np.sqrt(values[::-1])


def test_whitening_equals_numpy(spark, tmp_path):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(700, 40)) * np.linspace(1, 3, 40)).astype(np.float32)
    vectors[::3] += np.float32(0.5)
    rows = [(i * 3, v.tolist(), 1, "x", 1) for i, v in enumerate(vectors)]
    bad = [(-5, None, 1, "x", 1), (-4, [], 1, "x", 1), (-3, [1.0] * 39 + [None], 1, "x", 1), (-2, [float("nan")] * 40, 1, "x", 1), (5, [1.0] * 20, 1, "x", 1)]
    table(spark, rows + bad).repartition(6).write.parquet(f"{tmp_path}/embeddings.parquet")
    out = QUERIES["op13_whitening"](spark, str(tmp_path)).toPandas()
    assert len(out) == 700 * 32 and set(out["component"]) == set(range(1, 33)) and set(out["n"]) == {700}
    x = np.floor(vectors.astype(np.float64) * 64).astype(np.int64) + 1_000_000
    deviation, values, white = numpy_whitening(x)
    wide = out.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    signs = np.sign((wide * white[:, :32]).sum(0))
    assert np.abs(wide * signs - white[:, :32]).max() < 1e-8
    assert (out[out["component"] == 1].sort_values("vec_id")["deviation"].to_numpy() == deviation).all()
    explained = out[out["vec_id"] == 0].sort_values("component")["explained"].to_numpy()
    assert np.abs(explained / (values[:32] / values.sum()) - 1).max() < 1e-9
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-9
    assert np.abs(wide.T @ wide / 700 - np.eye(32)).max() < 1e-9


def test_blocks_and_split_products(spark, monkeypatch):
    """Many small blocks, dealt over several tasks and matrices, give what one block gives."""
    monkeypatch.setattr(whitening, "CHUNK_BLOCKS", 20)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).tolist(), 1, "x", 1) for i in range(333)]
    small, model = whitening.whiten(table(spark, rows).repartition(7), block_rows=10)
    large, other = whitening.whiten(table(spark, rows), block_rows=4096)
    assert np.abs(model.matrix - other.matrix).max() < 1e-9 and model.matrix.shape == (8, 8)
    small, large = ({r["vec_id"]: r["whitened"] for r in t.collect()} for t in (small, large))
    assert small.keys() == large.keys() and max(np.abs(np.array(small[k]) - large[k]).max() for k in small) < 1e-9


def test_whitening_without_variance_and_without_rows(spark):
    # three rows span two directions: the others whiten to null
    rows = [(1, [0.0, 0.0, 1.0, 5.0], 1, "x", 1), (2, [1.0, 0.0, 1.0, 5.0], 1, "x", 1), (None, [0.0, 2.0, 1.0, 5.0], 1, "x", 1)]
    out, model = whitening.whiten(table(spark, rows))
    got = [r["whitened"] for r in out.collect()]
    assert all(None not in g[:2] and g[2:] == [None, None] for g in got) and len(got) == 3
    assert model.error < 1e-9
    out, model = whitening.whiten(table(spark, rows[:1] * 2))
    assert [(r["deviation"], r["whitened"]) for r in out.collect()] == [(0, [None] * 4)] * 2 and model.error is None
    out, model = whitening.whiten(table(spark, rows).limit(0))
    assert out.count() == 0 and model is None


def test_queries_on_empty_tables(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/embeddings.parquet")
    for name in ("op12_vector_codes", "op13_whitening"):
        assert QUERIES[name](spark, str(tmp_path)).count() == 0


def test_exact_deviation_beyond_64_bits(spark):
    rows = [(i, [float(2**30 * i), 1.0], 1, "x", 1) for i in range(4)]
    out, _ = whitening.whiten(table(spark, rows))
    x = [min(2**36 * i, whitening.LARGEST) + 1_000_000 for i in range(4)]
    want = [(4 * a - sum(x)) ** 2 for a in x]
    assert sorted(r["deviation"] if r["deviation"] is not None else -1 for r in out.collect()) == sorted(w if w < 1 << 63 else -1 for w in want)
