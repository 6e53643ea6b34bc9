import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import embedding_dedup as ed
from strata.llm import hard_negatives as hn
from strata.llm import whitening as wh
from strata.llm.vectors import unit

NAN, INF = float("nan"), float("inf")
CLASH = ("label int, id string, node string, cell string, digest string, n_links string, key int, side int, pair int, "
         "rank string, score string, component string, n string, vector string, chosen string")


@pytest.fixture(scope="module")
def edge_vectors(spark):
    """Null, empty, zero, non-finite and short vectors, null ids and labels, ties and repeated rows."""
    v = [0.5, -0.25, 0.125, 1.0]
    rows = [(1, v, 1), (2, v, 1), (2, v, 1), (3, [2 * x for x in v], 2), (None, v, 1), (4, None, 1), (5, [], 1),
            (6, [0.0] * 4, 2), (7, [NAN, 1.0, 0.0, 0.0], 1), (8, [INF, 1.0, 0.0, 0.0], 1), (9, [None, 1.0, 0.0, 0.0], 1),
            (10, [1.0], 3), (11, [1.0, 0.0], 3), (50, v, 1), (100, [1.0, 0.0, 0.0, 0.0], None), (None, None, None),
            (150, [0.5, -0.25, 0.125], 1), (12, [-x for x in v], 1)]
    return spark.createDataFrame([(*r, *[None] * 14) for r in rows], "vec_id long, embedding array<float>, " + CLASH)


@pytest.fixture(scope="module")
def no_vectors(spark):
    return spark.createDataFrame([], "vec_id long, embedding array<float>, label int")


def families(rng, d, sizes, noise):
    """Random directions with near copies of each, as single precision numbers."""
    out = []
    for size in sizes:
        base = unit(rng.normal(size=(1, d)))
        out.append(base + rng.normal(size=(size, d)) * noise / np.sqrt(d))
    return np.concatenate(out).astype(np.float32)


def frame(spark, x, labels=None, parts=5):
    rows = [(i, v.tolist(), int(labels[i]) if labels is not None else 0) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(parts)


def links(x, threshold):
    u = unit(x.astype(float))
    near = u @ u.T >= threshold
    np.fill_diagonal(near, False)
    return near


def least_reached(near):
    low = np.arange(len(near))
    while True:
        new = np.minimum(low, np.where(near, low, len(near)).min(axis=1))
        if (new == low).all():
            return low
        low = new


def test_decode_finds_the_nearest_lattice_point():
    rng = np.random.default_rng(3)
    y = rng.normal(size=(300, 8)) * 3
    p = ed.decode(y)
    assert ((2 * p) % 1 == 0).all() and ((p.sum(axis=1) % 2) == 0).all()
    away = ((y[:, None] - (p[:, None] + ed.NEIGHBOURS)) ** 2).sum(axis=2)
    assert (((y - p) ** 2).sum(axis=1) <= away.min(axis=1) + 1e-12).all()
    assert len(np.unique(ed.NEIGHBOURS, axis=0)) == 240 and ((ed.NEIGHBOURS**2).sum(axis=1) == 2).all()


@pytest.mark.parametrize("options", [{}, {"block": 7}, {"occupancy": 2}, {"occupancy": 1e-4, "block": 16}])
def test_links_equal_brute_force(spark, options):
    """Families of near copies, with a hot cell cut into parts, one block of dimensions and several."""
    rng = np.random.default_rng(1)
    x = families(rng, 24, [1] * 60 + [2] * 20 + [5] * 8 + [90], 0.22)
    x[10] = x[3]
    near = links(x, 0.95)
    low = least_reached(near)
    got = {r.vec_id: r for r in ed.near_duplicate_vectors(frame(spark, x), **options).collect()}
    assert len(got) == len(x)
    found = sum(r.n_links for r in got.values())
    assert 0.98 * near.sum() <= found <= near.sum()
    assert all(got[i].n_links <= near[i].sum() and got[i].kept == (got[i].component_id == i) for i in got)
    assert sum(got[i].component_id == low[i] for i in got) >= 0.98 * len(x)


def test_recall_at_the_threshold(spark):
    """Pairs at a cosine just above 0.95: the plan's recall holds for any number of vectors."""
    rng = np.random.default_rng(5)
    a = unit(rng.normal(size=(800, 64)))
    b = rng.normal(size=(800, 64))
    b = unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    x = np.concatenate([a, 0.9501 * a + np.sqrt(1 - 0.9501**2) * b]).astype(np.float32)
    out = ed.near_duplicate_vectors(frame(spark, x), occupancy=4)
    assert out.filter("n_links = 1").count() >= 0.97 * 1600
    for n in (10**5, 10**8, 10**11):
        lattice = ed.plan_lattice(n, 64, 0.95)
        met = ed._meeting(lattice, 0.95, 64)[-1]
        assert 1 - (1 - met) ** lattice.tables >= 0.99 and lattice.tables * (1 + lattice.probes) <= 400


def test_copies_are_counted_not_paired(spark):
    """A third of all rows are one vector: counts include each, one class is compared."""
    x = np.concatenate([families(np.random.default_rng(2), 16, [1] * 200, 0.0)] * 1)
    x = np.concatenate([x, np.tile(x[0], (400, 1))])
    got = {r.vec_id: r for r in ed.near_duplicate_vectors(frame(spark, x)).collect()}
    assert got[0].n_links == got[599].n_links == 400 and got[599].component_id == 0
    assert sum(r.kept for r in got.values()) == 200


def test_edge_vectors_link(spark, edge_vectors, no_vectors):
    rows = ed.near_duplicate_vectors(edge_vectors).collect()
    assert len(rows) == 18
    got = {r.vec_id: (r.n_links, r.component_id) for r in rows if r.vec_id is not None}
    assert {got[i] for i in (1, 2, 3, 50)} == {(5, 1)}  # 1, 2 twice, 3, the row without id, 50
    assert {got[i] for i in (10, 11, 100)} == {(2, 10)}
    assert got[12] == (0, 12) and all(got[i] == (0, i) for i in (4, 5, 6, 7, 8, 9, 150))
    assert {(r.n_links, r.component_id, r.kept) for r in rows if r.vec_id is None} == {(0, None, False), (5, 1, False)}
    assert ed.near_duplicate_vectors(no_vectors).collect() == []


@pytest.mark.parametrize("leaf", [1, 8, 256])
def test_strassen_is_exact(leaf):
    rng = np.random.default_rng(4)
    for m, k, n in ((1, 1, 1), (3, 0, 2), (5, 33, 4), (40, 64, 70), (300, 65, 513)):
        a, b = rng.integers(-2**24, 2**24, (m, k)), rng.integers(-2**24, 2**24, (n, k))
        assert (hn.product(a, b, leaf) == a @ b.T).all()


def mined(rows, n_pos=5, n_neg=3, low=50, high=95):
    """Plain Python over (id, label, integers)."""
    out = []
    for i, label, v in rows:
        if i % 50:
            continue
        scored = [(-sum(p * q for p, q in zip(v, w)), j, m) for j, m, w in rows]
        positives = sorted((s, j) for s, j, m in scored if m == label and j != i)[:n_pos]
        for ps, p in positives:
            fit = sorted((s, j) for s, j, m in scored if m != label and low * -ps <= 100 * -s <= high * -ps)
            out += [(i, p, r + 1, j, -ps, -s) for r, (s, j) in enumerate(fit[:n_neg])]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"anchor_block": 2, "candidate_block": 16}])
@pytest.mark.parametrize("kind", ["spread", "ties"])
def test_negatives_equal_brute_force(spark, monkeypatch, options, kind):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(420, 24)).astype(np.float32) / 3
    if kind == "ties":
        x = np.rint(x * 2)[rng.integers(0, 25, 420)] / 4
    labels = np.where(np.arange(420) < 140, 0, rng.integers(0, 6, 420))
    rows = [(i, int(labels[i]), [int(np.floor(256 * float(c))) for c in v]) for i, v in enumerate(x)]
    got = sorted(tuple(r) for r in hn.hard_negatives(frame(spark, x, labels), **options).collect())
    assert got == mined(rows)
    assert len(got) > 20


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(8)
    score, ids = rng.integers(0, 6, (4, 900)), rng.permutation(900)
    heaps = hn.Heaps(6, 7)
    for part in np.array_split(np.arange(900), 9):
        heaps.offer(score[:, part], ids[part], score[:, part] < 5, np.array([0, 2, 3, 5]))
    for r, row in zip(range(4), (0, 2, 3, 5), strict=True):
        want = sorted((-s, i) for s, i in zip(score[r].tolist(), ids.tolist(), strict=True) if s < 5)[:7]
        at = heaps.row == row
        assert [(-s, i) for s, i in zip(heaps.score[at].tolist(), heaps.id[at].tolist(), strict=True)] == want


def test_edge_vectors_mine(spark, edge_vectors, no_vectors):
    got = sorted(tuple(r) for r in hn.hard_negatives(edge_vectors, F.col("vec_id") == 50, scale=8).collect())
    rows = [(1, 1, [4, -2, 1, 8]), (2, 1, [4, -2, 1, 8]), (2, 1, [4, -2, 1, 8]), (3, 2, [8, -4, 2, 16]),
            (5, 1, [0] * 4), (6, 2, [0] * 4), (10, 3, [8, 0, 0, 0]), (11, 3, [8, 0, 0, 0]), (50, 1, [4, -2, 1, 8]),
            (150, 1, [4, -2, 1, 0]), (12, 1, [-4, 2, -1, -8])]
    assert got == [r for r in mined(rows) if r[0] == 50]
    assert hn.hard_negatives(no_vectors).collect() == []
    assert hn.hard_negatives(edge_vectors.filter("vec_id = 50")).collect() == []
    with pytest.raises(Exception, match="exact scores|2\\^53"):
        hn.hard_negatives(spark.createDataFrame([(50, [1e12], 1), (51, [1e12], 1)], edge_vectors.schema[:3])).collect()


@pytest.mark.parametrize("v", [np.zeros((4, 4)), np.eye(5), np.diag([0.0, 1, 2]), np.ones((6, 6)), np.diag([3.0, 3, 2, 2, 1, 0]),
                               np.diag([1e5] + [1.0] * 40)])
def test_components_of_plain_matrices(v):
    e, q = wh.leading_components(v, 3)
    want = np.sort(np.linalg.eigvalsh(v))[::-1][:3]
    assert np.allclose(e, want, atol=1e-12 * max(1, want[0])) and np.allclose(q.T @ q, np.eye(3), atol=1e-13)
    assert np.allclose(v @ q, q * e, atol=1e-10)


def test_polar_factor_is_orthogonal():
    a = np.random.default_rng(1).normal(size=(40, 40))
    a = a + a.T
    u = wh.polar(a)
    assert np.allclose(u @ u, np.eye(40), atol=1e-12) and (np.linalg.eigvalsh((u @ a + a @ u) / 2) > 0).all()


def test_whitening_equals_eigh(spark):
    rng = np.random.default_rng(9)
    x = (rng.normal(size=(700, 12)) * np.linspace(0.1, 1, 12)).astype(np.float32)
    rows = wh.whiten(frame(spark, x)).collect()
    z = np.floor(x.astype(float) * 1024).astype(np.int64) + 100_000
    s, n = z.sum(axis=0), len(z)
    v = np.cov(z.T, bias=True)
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:8], q[:, ::-1][:, :8]
    want = (z - s / n) @ q / np.sqrt(e)
    got = np.zeros((n, 8))
    for r in rows:
        got[r.vec_id, r.component - 1] = r.whitened
        assert r.n == n and int(r.deviation) == sum(int(y) ** 2 for y in n * z[r.vec_id] - s)
        assert abs(r.explained / (e[r.component - 1] / np.trace(v)) - 1) < 1e-9 and r.identity_error < 1e-9
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-8) and len(rows) == 8 * n
    assert np.allclose(got.T @ got / n, np.eye(8), atol=1e-9)


def test_edge_vectors_whiten(spark, edge_vectors, no_vectors):
    rows = wh.whiten(edge_vectors).collect()
    assert len(rows) == 13 * 4 and {r.n for r in rows} == {13}
    assert all(r.identity_error < 1e-6 for r in rows)
    assert wh.whiten(no_vectors).collect() == [] == wh.whiten(edge_vectors.filter("vec_id = 5")).collect()
    one = wh.whiten(edge_vectors.filter("vec_id = 1")).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == \
        [(c, 1, 0, None, None, None) for c in (1, 2, 3, 4)]
    flat = wh.whiten(edge_vectors.filter("vec_id in (1, 12)")).collect()  # one direction has variance
    assert {(r.component, r.whitened is None) for r in flat} == {(1, False), (2, True), (3, True), (4, True)}


def test_exact_squares_beyond_64_bits():
    y = np.array([[2**40, -(2**41)], [3, 4]])
    assert wh._exact_squares(y) == [2**80 + 2**82, 25]
