"""Exact cosine range join of vectors by pivots and the triangle inequality.

Equal vectors are one class with a size. The angle between vectors is a metric;
a pair links when it is at most theta, the angle of the wanted cosine. Pivots,
at least theta apart, come from a sample of at most ``pivots`` vectors, which
bounds their number; every class belongs to its nearest pivot. What lies within
theta / 2 of its pivot is the pivot's core, the rest its shell. Two members of a
core always link, so a core is counted and never compared: a group of near
copies costs time in proportion to its size, whatever its size.

Other links reach over a boundary. A vector at the angle a from its own pivot
and b from another one can have partners in that one's cell only if
b <= a + 2 theta, and only if b lies within theta of the angles that the cell's
members have. It is copied to the cells that pass, and to no others. Cells are
dealt to blocks of at most about ``block`` vectors: small cells share a block,
large ones are cut by node. Pairs of blocks are the tasks, each independent of
all others; copies go to a pair only where some vector of the other block can be
near. A task compares in single precision and settles what is within its error
of the threshold in double precision. It returns a count per vector and a
spanning forest of its links, never the links themselves.

Vectors without structure have no empty boundary: all pairs of blocks then meet,
as any exact join would have to.

``range_links`` returns one row per input row: vec_id, n_links (other rows linked
directly, copies included), component_id (smallest vec_id reachable, itself
included), kept (vec_id = component_id). Vectors that are null, empty, all zero,
or hold null or non-finite components link with nothing and are their own
component; so do vectors of a length nobody else has, since only equally long
vectors are compared. A row with a null vec_id counts as a partner; its component is
the smallest known id and it is never kept. Repeated rows are partners of each
other. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storewright.llm.components import components, written

SLACK = 1e-6  # radians; cosines in double precision give angles to about 1e-8
PAIRED = "a long, b long, side int, node long, size long, core int, vector binary"
FOUND = "node long, links long, root long"


@dataclass(frozen=True)
class RangeSpec:
    cosine: float = 0.9
    pivots: int = 1024  # vectors sampled for pivots
    block: int = 4096  # vectors in a block; with fewer than 12 blocks' worth of vectors, blocks are smaller
    least_block: int = 256

    @property
    def theta(self) -> float:
        return float(np.arccos(self.cosine))


def usable(embedding: str = "embedding"):
    """Whether a vector can link with others."""
    raw = F.col(embedding)
    finite = F.forall(raw, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return F.coalesce((F.size(raw) > 0) & finite & F.exists(raw, lambda x: x != 0), F.lit(False))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, a 128-bit digest of the vector and its doubles as bytes (as floats where that is exact)."""
    for batch in batches:
        digests, vectors = [], []
        for one in batch.column("embedding"):
            if not one.is_valid:
                digests.append(None)
                vectors.append(None)
                continue
            values = one.values.to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # -0.0 is 0.0
            with np.errstate(over="ignore"):
                short = values.astype(np.float32)
            data = b"f" + short.tobytes() if np.array_equal(short, values) else b"d" + values.tobytes()
            digests.append(xxhash.xxh3_128_digest(data))
            vectors.append(data)
        columns = [batch.column("vec_id"), pa.array(digests, pa.binary()), pa.array(vectors, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["vec_id", "digest", "vector"])


def as_doubles(data: bytes) -> np.ndarray:
    """The vector, scaled by a power of two so that squares stay finite."""
    values = np.frombuffer(data, "<f4" if data[:1] == b"f" else "<f8", offset=1).astype(np.float64)
    return np.ldexp(values, -int(np.frexp(np.abs(values).max())[1]))


def _length(data: bytes) -> int:
    return (len(data) - 1) // (4 if data[:1] == b"f" else 8)


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", rows, rows))


def units(vectors: list[bytes]) -> np.ndarray:
    rows = np.stack([as_doubles(v) for v in vectors])
    return rows / _norms(rows)[:, None]


def _angles(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(rows @ pivots.T, -1.0, 1.0))


def choose_pivots(sample: list[bytes], theta: float) -> dict[int, np.ndarray]:
    """Per vector length pivots at least theta apart, each moved to the middle of the sampled vectors next to it."""
    by_length: dict[int, list[bytes]] = {}
    for data in sample:
        by_length.setdefault(_length(data), []).append(data)
    out = {}
    for length, vectors in by_length.items():
        rows = units(vectors)
        free, chosen = np.ones(len(rows), bool), []
        while free.any():
            one = rows[np.argmax(free)]
            near = np.arccos(np.clip(rows @ one, -1.0, 1.0)) < theta
            middle = rows[near & free].sum(axis=0)
            chosen.append(middle / np.sqrt(middle @ middle))
            free &= ~near
        out[length] = np.stack(chosen)
    return out


@dataclass(frozen=True)
class Layout:
    """Cells of all lengths in a row, and how they are dealt to blocks."""

    pivots: dict[int, np.ndarray]
    first_cell: dict[int, int]  # per length; its pivot i has the core first + 2 i and the shell first + 2 i + 1
    closest: np.ndarray  # per cell the least and largest angle of its members
    farthest: np.ndarray
    first_block: np.ndarray  # per cell
    slices: np.ndarray
    n_blocks: int

    def home(self, cells: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        mixed = (nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return self.first_block[cells] + (mixed % self.slices[cells].astype(np.uint64)).astype(np.int64)


def place(rows: np.ndarray, pivots: np.ndarray, first: int, theta: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Angles to all pivots, and per row its cell and the angle to its own pivot."""
    angles = _angles(rows, pivots)
    own = np.argmin(angles, axis=1)
    near = angles[np.arange(len(rows)), own]
    return angles, first + 2 * own + (near > theta / 2 - SLACK), near


def _lay_out(pivots: dict, first_cell: dict, held: list, n_cells: int, block: int) -> Layout:
    count = np.zeros(n_cells, np.int64)
    closest, farthest = np.full(n_cells, np.inf), np.full(n_cells, -np.inf)
    for cell, n, low, high in held:
        count[cell], closest[cell], farthest[cell] = n, low, high
    first_block, slices = np.zeros(n_cells, np.int64), np.ones(n_cells, np.int64)
    at, room = -1, 0
    for cell in np.flatnonzero(count):
        n = count[cell]
        if n > block:
            slices[cell] = -(-n // block)
            first_block[cell], at, room = at + 1, at + slices[cell], 0
        else:
            if n > room:
                at, room = at + 1, block
            first_block[cell], room = at, room - n
    return Layout(pivots, first_cell, closest, farthest, first_block, slices, int(at + 1))


def _reach(angles: np.ndarray, near: np.ndarray, first: int, layout: Layout, theta: float) -> np.ndarray:
    """Per row and cell of its length whether a member of the cell can be within theta."""
    cells = slice(first, first + 2 * angles.shape[1])
    wide = np.repeat(angles, 2, axis=1)
    reach = wide <= near[:, None] + 2 * theta + SLACK
    return reach & (wide <= layout.farthest[cells] + theta + SLACK) & (wide >= layout.closest[cells] - theta - SLACK)


def _copies(layout: Layout, theta: float):
    """Rows of placed classes to the pairs of blocks in which they have to be compared."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 2048):
                yield from some(whole.slice(begin, 2048))

    def some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vectors = batch.column("vector").to_pylist()
        nodes, sizes = batch.column("node").to_numpy(), batch.column("size").to_numpy()
        lengths = np.array([_length(v) for v in vectors], np.int64)
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            first = layout.first_cell[length]
            angles, cells, near = place(units([vectors[i] for i in at]), layout.pivots[length], first, theta)
            reach = _reach(angles, near, first, layout, theta)
            home = layout.home(cells, nodes[at])
            core = np.where((cells - first) % 2 == 0, cells, -1)
            reach[np.flatnonzero(core >= 0), core[core >= 0] - first] = False
            live = np.flatnonzero(layout.farthest[first : first + reach.shape[1]] >= 0)
            # Small cells that share a block follow each other; a cut cell has its blocks to itself.
            blocks, begins = np.unique(layout.first_block[first + live], return_index=True)
            reach = np.logical_or.reduceat(reach[:, live], begins, axis=1)
            copies = layout.slices[first + live[begins]]
            row, column = np.nonzero(np.repeat(reach, copies, axis=1))
            block = np.repeat(blocks - np.cumsum(copies) + copies, copies)[column] + column
            own = home[row]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.minimum(own, block)), pa.array(np.maximum(own, block)),
                    pa.array((own > block).astype(np.int32)), pa.array(nodes[at][row]), pa.array(sizes[at][row]),
                    pa.array(core[row].astype(np.int32)), batch.column("vector").take(pa.array(at[row])),
                ],
                ["a", "b", "side", "node", "size", "core", "vector"],
            )

    return deal


class Forest:
    """Roots of linked vectors; edges come in lots."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, u: np.ndarray, v: np.ndarray) -> None:
        while True:
            a, b = self.root[u], self.root[v]
            apart = a != b
            if not apart.any():
                return
            u, v, a, b = u[apart], v[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while (self.root != self.root[self.root]).any():
                self.root = self.root[self.root]


class Compared:
    """The vectors of a task, for cosines between any of them."""

    def __init__(self, vectors: list[bytes]):
        self.rows = np.stack([as_doubles(v) for v in vectors])
        self.norms = _norms(self.rows)
        self.short = (self.rows / self.norms[:, None]).astype(np.float32)
        self.error = 2.4e-7 * (self.rows.shape[1] + 4)

    def linked(self, left: np.ndarray, right: np.ndarray, cosine: float) -> np.ndarray:
        """Which pairs have at least this cosine."""
        close = self.short[left] @ self.short[right].T
        links = close >= cosine
        u, v = np.nonzero(np.abs(close - np.float32(cosine)) <= self.error)
        for i in range(0, len(u), 4096):
            a, b = left[u[i : i + 4096]], right[v[i : i + 4096]]
            exact = np.einsum("ij,ij->i", self.rows[a], self.rows[b]) / (self.norms[a] * self.norms[b])
            links[u[i : i + 4096], v[i : i + 4096]] = exact >= cosine
        return links


def _compare(cosine: float, tile: int = 512):
    def task(table: pa.Table) -> pa.Table:
        out = {"node": [], "links": [], "root": []}
        lengths = np.array([_length(v.as_py()) for v in table.column("vector")], np.int64)
        for length in np.unique(lengths).tolist():
            of = table.take(pa.array(np.flatnonzero(lengths == length)))
            for name, values in compared(of).items():
                out[name].append(values)
        columns = {n: np.concatenate(v) if v else np.zeros(0, np.int64) for n, v in out.items()}
        return pa.table({n: pa.array(v, pa.int64()) for n, v in columns.items()})

    def compared(table: pa.Table) -> dict[str, np.ndarray]:
        a, b = table.column("a")[0].as_py(), table.column("b")[0].as_py()
        nodes, sizes = table.column("node").to_numpy(), table.column("size").to_numpy()
        side, core = table.column("side").to_numpy(), table.column("core").to_numpy()
        rows = Compared(table.column("vector").to_pylist())
        n = len(nodes)
        # A pair of two blocks has its rows on two sides; one block is compared with itself, each pair once.
        left, right = (np.arange(n), np.arange(n)) if a == b else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        links, forest = np.zeros(n, np.int64), Forest(n)
        for begin in range(0, len(left), tile):
            these = left[begin : begin + tile]
            those = right[begin:] if a == b else right
            if not len(those):
                break
            near = rows.linked(these, those, cosine)
            if a == b:
                near &= np.arange(len(those))[None, :] > np.arange(len(these))[:, None]
            u, v = np.nonzero(near)
            u, v = these[u], those[v]
            new = (core[u] < 0) | (core[u] != core[v])  # members of one core are counted without comparing
            u, v = u[new], v[new]
            np.add.at(links, u, sizes[v])
            np.add.at(links, v, sizes[u])
            forest.add(u, v)
        some = np.flatnonzero(links)
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, forest.root, nodes)
        return {"node": nodes[some], "links": links[some], "root": least[forest.root[some]]}

    return task


def range_links(spark: SparkSession, vectors: DataFrame, spec: RangeSpec | None = None) -> DataFrame:
    spec = spec or RangeSpec()
    theta = spec.theta
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable(), F.col("embedding")).alias("embedding"))
    rows = written(spark, given.mapInArrow(_packed, "vec_id long, digest binary, vector binary"))
    classes = (
        rows.filter("vector IS NOT NULL").groupBy("digest", "vector")
        .agg(F.count("*").alias("size"), F.min("vec_id").alias("least"))
    )
    # Numbers of nodes are fixed by the written files.
    classes = written(spark, classes.withColumn("node", F.monotonically_increasing_id()))

    sample = classes.select("vector").orderBy(F.xxhash64("digest"), "digest").limit(spec.pivots).collect()
    pivots = choose_pivots([bytes(r.vector) for r in sample], theta)
    width = F.when(F.substring("vector", 1, 1) == F.lit(b"f"), 4).otherwise(8)
    lengths = classes.select(((F.octet_length("vector") - 1) / width).cast("int").alias("length")).distinct()
    for (length,) in lengths.collect():  # a length that the sample has not met gets one pivot, any direction
        pivots.setdefault(length, np.eye(1, length))
    first_cell, n_cells = {}, 0
    for length in sorted(pivots):
        first_cell[length], n_cells = n_cells, n_cells + 2 * len(pivots[length])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("vector").to_pylist()
            cells, near = np.zeros(len(data), np.int64), np.zeros(len(data))
            of = np.array([_length(v) for v in data], np.int64)
            for length in np.unique(of).tolist():
                at = np.flatnonzero(of == length)
                _, cells[at], near[at] = place(units([data[i] for i in at]), pivots[length], first_cell[length], theta)
            columns = [batch.column("node"), batch.column("size"), pa.array(cells), pa.array(near)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "size", "cell", "near"])

    placed = classes.select("node", "size", "vector").mapInArrow(assign, "node long, size long, cell long, near double")
    placed = written(spark, placed)
    # A row per cell: at most two for each pivot.
    held = placed.groupBy("cell").agg(F.count("*"), F.min("near"), F.max("near"))
    held = [tuple(r) for r in held.collect()]
    total = sum(n for _, n, _, _ in held)
    block = int(max(spec.least_block, min(spec.block, total // 12)))
    layout = _lay_out(pivots, first_cell, held, n_cells, block)

    copies = classes.select("node", "size", "vector").mapInArrow(_copies(layout, theta), PAIRED)
    found = written(spark, copies.groupBy("a", "b").applyInArrow(_compare(spec.cosine), FOUND))

    # Core members link with each other: counted per core, joined to its smallest node.
    cores = F.broadcast(
        placed.filter("cell % 2 = 0").groupBy("cell").agg(F.sum("size").alias("all"), F.min("node").alias("root"))
    )  # at most one row per pivot
    inside = placed.filter("cell % 2 = 0").join(cores, "cell")
    inside = inside.select("node", (F.col("all") - F.col("size")).alias("links"), "root")
    linked = found.unionByName(inside)
    edges = linked.filter("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))
    roots = components(spark, edges)
    counts = linked.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.select("digest", "node", "size", "least").join(counts, "node", "left").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    called = written(spark, named.groupBy("root").agg(F.min("least").alias("component_id")))
    named = written(
        spark,
        named.join(called, "root").select(
            "digest", "component_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")
        ),
    )
    # A class can hold a third of all rows: both sides are read where they lie, so AQE can split the class.
    out = rows.select("vec_id", "digest").join(named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
