"""Near-duplicate vectors by E8 lattice hashing.

Vectors are projected at random to blocks of eight dimensions, and each block is
decoded to its nearest point of the E8 lattice; the points of all blocks name the
vector's cell in one hash table. A vector is stored in its own cell of every
table and looked up there and in the cells its projection is nearest to next, so
two vectors meet where one's own cell is among the other's. All vectors that
meet are compared by cosine in double precision.

1. Equal vectors become one class with a count (combined before the shuffle).
2. Links between classes: one shuffle of the classes by cell. A cell with more
   than ``block`` members, whatever holds them together, is cut into parts, and
   every pair of parts is a group of its own, so no group exceeds two parts and
   no comparison is left out. A group emits a spanning forest of its links, never
   all its pairs.
3. Connected components of the forests.
4. Direct links are counted inside each component, again part by part: all pairs
   of a component are compared, so counts miss only links that no table found
   within the component.

Only the lattice scale follows the size of the input: cells are made so small
that a vector meets about ``occupancy`` unrelated ones in a table, with a further
block of eight dimensions whenever one block's cells would be too small for near
vectors to meet. The number of tables and of cells looked up is then the cheapest
that finds a pair at exactly the threshold with probability ``recall``, which
depends on the angle alone and is measured on drawn pairs. Closer pairs are found
more often. Nothing is ever dropped.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.components import connected_components
from strata.llm.store import broadcast_if_small, written
from strata.llm.vectors import matrix, runs, unit, usable

#: scale at which a further block of eight dimensions is added
WIDEST_SCALE = 0.7


def _neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8: all (+-1, +-1, 0...), and all halves with evenly many minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


NEIGHBOURS = _neighbours()


def _even(y: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: where the sum is odd, the worst rounding goes the other way."""
    near = np.rint(y)
    miss = y - near
    odd = np.flatnonzero(near.sum(axis=1) % 2)
    worst = np.abs(miss[odd]).argmax(axis=1)
    near[odd, worst] += np.where(miss[odd, worst] >= 0, 1.0, -1.0)
    return near


def decode(y: np.ndarray) -> np.ndarray:
    """The nearest E8 point to each row: an even integer point, or one moved by one half throughout."""
    whole, half = _even(y), _even(y - 0.5) + 0.5
    nearer = ((y - whole) ** 2).sum(axis=1) <= ((y - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


class Lattice:
    """``tables`` hash tables of ``blocks`` E8 lattices each over vectors of ``d`` dimensions."""

    def __init__(self, d: int, blocks: int, scale: float, tables: int, probes: int, seed: int = 7):
        rng = np.random.default_rng([seed, d, blocks])
        self.blocks, self.scale, self.tables, self.probes = blocks, scale, tables, probes
        self.axes = [rng.normal(size=(d, 8 * blocks)) for _ in range(tables)]
        self.shift = rng.uniform(0, 2, (tables, 8 * blocks))
        # a cell's name is a sum over the (doubled, so integer) coordinates of its points
        self.names = rng.integers(0, 2**63, (tables, blocks, 8), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def cells(self, u: np.ndarray, t: int) -> np.ndarray:
        """Names of the cells of unit vectors in table ``t``: the own one, then ``probes`` by distance."""
        y = (u @ self.axes[t]) * self.scale + self.shift[t]
        name = np.zeros((len(u), 1), np.uint64)
        cost = np.zeros((len(u), 1))
        for k in range(self.blocks):
            part = y[:, 8 * k:8 * k + 8]
            home = decode(part)
            far = 1.0 - (part - home) @ NEIGHBOURS.T  # half the growth of the squared distance
            best = np.argpartition(far, self.probes, axis=1)[:, :self.probes] if self.probes < 240 else \
                np.tile(np.arange(240), (len(u), 1))
            moves = np.concatenate([np.zeros((len(u), 1)), np.take_along_axis(far, best, 1)], axis=1)
            step = (np.rint(2 * NEIGHBOURS).astype(np.int64).astype(np.uint64) * self.names[t, k]).sum(axis=1)
            own = (np.rint(2 * home).astype(np.int64).astype(np.uint64) * self.names[t, k]).sum(axis=1)
            names = own[:, None] + np.concatenate([np.zeros((len(u), 1), np.uint64), step[best]], axis=1)
            cost = (cost[:, :, None] + moves[:, None, :]).reshape(len(u), -1)
            name = (name[:, :, None] + names[:, None, :]).reshape(len(u), -1)
            order = np.argsort(cost, axis=1, kind="stable")[:, :self.probes + 1]
            cost, name = np.take_along_axis(cost, order, 1), np.take_along_axis(name, order, 1)
        return _mixed(name + np.uint64(t))

    def all_cells(self, u: np.ndarray) -> np.ndarray:
        """(vectors, tables, 1 + probes)"""
        return np.stack([self.cells(u, t) for t in range(self.tables)], axis=1)


def _mixed(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))).view(np.int64)


def _meeting(lattice: Lattice, cosine: float, d: int, pairs: int = 4000) -> np.ndarray:
    """Share of pairs at exactly ``cosine`` that meet in a table, by the number of cells looked up."""
    rng = np.random.default_rng(11)
    a, b = unit(rng.normal(size=(pairs, d))), rng.normal(size=(pairs, d))
    b = unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    b = cosine * a + math.sqrt(max(0.0, 1 - cosine * cosine)) * b
    x, y = lattice.all_cells(a), lattice.all_cells(b)
    met = (x == y[:, :, :1]) | (y == x[:, :, :1])
    return np.logical_or.accumulate(met, axis=2).mean(axis=(0, 1))


def plan_lattice(n: int, d: int, threshold: float, occupancy: int = 256, recall: float = 0.995) -> Lattice:
    """The lattice for ``n`` vectors of ``d`` dimensions, see the module's text."""
    # two unrelated unit vectors share an E8 cell of scale s with probability 1 / ((4 pi)^4 s^8)
    def scale_of(blocks: int) -> float:
        return ((max(n, 1) / occupancy) ** (1 / blocks) / (4 * math.pi) ** 4) ** (1 / 8)

    blocks = next(k for k in itertools.count(1) if scale_of(k) <= WIDEST_SCALE)
    scale = max(scale_of(blocks), 0.2)
    if d < 2:
        return Lattice(d, 1, 0.2, 1, 2)
    share = _meeting(Lattice(d, blocks, scale, 4, 8), threshold, d)
    need = [1 if s >= recall else math.ceil(math.log(1 - recall) / math.log1p(-max(s, 1e-6))) for s in share]
    probes = min(range(1, len(share)), key=lambda p: need[p] * (1 + p))
    return Lattice(d, blocks, scale, need[probes], probes)


def _cut(rows: DataFrame, group: str, hot: DataFrame, block: int) -> DataFrame:
    """``rows`` (group, node, ...) with p, q, part. ``hot``: the groups of more than ``block`` rows with
    their counts. Any other group is one tile (0, 0); of these every pair of parts p <= q is a tile,
    and a row is sent to each that has its part."""
    parts = hot.select(group, F.ceil(F.col("count") / block).cast("int").alias("parts"))
    cut = rows.join(broadcast_if_small(parts), group, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    cut = cut.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return cut.select(group, F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"),
                      "part", "node", *(c for c in rows.columns if c not in (group, "node")))


def _grouped(tiles: DataFrame, group: str) -> DataFrame:
    return tiles.repartition(group, "p", "q").sortWithinPartitions(group, "p", "q")


def _near(p, q, part, u, threshold):
    """Which pairs of a tile's rows have the cosine: all its pairs, or those across its two parts."""
    near = u @ u.T >= threshold
    if p[0] != q[0]:
        near &= part[:, None] != part
    np.fill_diagonal(near, False)
    return near


def _forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the graph ``near``."""
    edges, left = [], near.any(axis=1)
    while left.any():
        queue = [int(left.argmax())]
        left[queue[0]] = False
        while queue:
            at = queue.pop()
            new = np.flatnonzero(near[at] & left)
            left[new] = False
            queue += new.tolist()
            edges += [(at, x) for x in new.tolist()]
    return edges


def _hash_rows(d: int, lattice: Lattice, with_vectors: bool):
    width = lattice.tables * (1 + lattice.probes)
    home = np.arange(width) % (1 + lattice.probes) == 0

    def run(batches):
        for whole in batches:
            for s in range(0, whole.num_rows, 1000):
                b = whole.slice(s, 1000)
                cells = pa.array(lattice.all_cells(unit(matrix(b.column("vector"), d))).reshape(-1))
                if not with_vectors:
                    yield pa.RecordBatch.from_pydict({"cell": cells})
                    continue
                row = pa.array(np.repeat(np.arange(b.num_rows), width))
                yield pa.RecordBatch.from_pydict({
                    "cell": cells, "node": b.column("node").take(row), "home": pa.array(np.tile(home, b.num_rows)),
                    "vector": b.column("vector").take(row)})
    return run


def _link_rows(d: int, threshold: float):
    def load(b):
        return (b.column("p").to_numpy(), b.column("q").to_numpy(), b.column("part").to_numpy(),
                b.column("node").to_numpy(), b.column("home").to_numpy(zero_copy_only=False),
                unit(matrix(b.column("vector"), d)))

    def run(batches):
        for p, q, part, node, home, u in runs(batches, 3, load):
            near = _near(p, q, part, u, threshold) & (home[:, None] | home)
            if edges := _forest(near):
                a, b = np.array(edges).T
                yield pa.RecordBatch.from_pydict({"a": pa.array(node[a]), "b": pa.array(node[b])})
    return run


def _count_rows(d: int, threshold: float):
    def load(b):
        return (b.column("p").to_numpy(), b.column("q").to_numpy(), b.column("part").to_numpy(),
                b.column("node").to_numpy(), b.column("copies").to_numpy(), unit(matrix(b.column("vector"), d)))

    def run(batches):
        for p, q, part, node, copies, u in runs(batches, 3, load):
            links = np.where(_near(p, q, part, u, threshold), copies, 0).sum(axis=1)
            yield pa.RecordBatch.from_pydict({"node": pa.array(node), "links": pa.array(links.astype(np.int64))})
    return run


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id",
                           vector_col: str = "embedding", occupancy: int = 256, recall: float = 0.995,
                           block: int = 1024) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    n_links: other rows linked directly, that is with a cosine of ``threshold`` (above 0)
    or more; component_id: the least id reachable by links; kept: whether that is the row's own.

    Vectors that are null, zero, empty or hold a null, NaN or infinite component link
    with nothing. Shorter vectors count as ending in zeros. Each row stands for itself:
    a repeated row is linked with its copies, and rows that share an id are still
    compared as rows of their own. A row without an id links like others; the least id
    leaves nulls out. All other columns are ignored, and an empty table gives no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    able = usable(F.col("vector")) & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    # 128 bits name a vector; the second hash starts from another state
    digest = F.when(able, F.struct(F.xxhash64("vector").alias("x"), F.xxhash64(F.lit(1), "vector").alias("y")))
    rows = rows.withColumn("digest", digest)
    classes = (rows.filter("digest is not null").groupBy("digest")
               .agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector")))
    classes = written(classes.select(F.monotonically_increasing_id().alias("node"), "*"), "vector-classes")
    size = classes.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    n, d = size[0], size[1] or 1
    lattice = plan_lattice(n, d, threshold, occupancy, recall)

    kind = classes.schema["vector"].dataType.simpleString()
    narrow = classes.select("node", "vector")
    cells = narrow.mapInArrow(_hash_rows(d, lattice, False), "cell long")
    hashed = narrow.mapInArrow(_hash_rows(d, lattice, True), f"cell long, node long, home boolean, vector {kind}")
    hot = written(cells.groupBy("cell").count().filter(F.col("count") > block), "hot-cells")
    tiles = _cut(hashed, "cell", hot, block)
    links = _grouped(tiles, "cell").mapInArrow(_link_rows(d, threshold), "a long, b long")
    links = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "vector-links")

    members = written(connected_components(links).join(classes, "node")
                      .select("component", "node", "least", "copies", "vector"), "vector-components")
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("count"), F.min("least").alias("least"))
    large = written(sizes.select("component", "count").filter(F.col("count") > block), "hot-components")
    inside = _cut(members.select("component", "node", "copies", "vector"), "component", large, block)
    counts = (_grouped(inside, "component").mapInArrow(_count_rows(d, threshold), "node long, links long")
              .groupBy("node").agg(F.sum("links").alias("links")))
    linked = (members.select("component", "node").join(counts, "node", "left")
              .join(sizes.select("component", F.col("least").alias("lowest")), "component"))
    named = classes.select("node", "digest", "copies", "least").join(linked, "node", "left").select(
        "digest", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("lowest", "least").alias("component_id"))
    found = rows.select("id", "digest").join(written(named, "vector-names"), "digest", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
    return found.select(F.col("id").alias(id_col), "n_links", "component_id",
                        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
