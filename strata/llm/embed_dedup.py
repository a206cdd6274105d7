"""Embedding near-dedup: tiled comparison in principal-component order.

Vectors of one label (and one dimension) link when their cosine, in double
precision on the original components, is at least ``threshold``.

Method.  Equal vectors of a label are one node.  The second-moment matrix of all
unit vectors (summed per partition, then over partitions) gives an orthogonal
basis, largest components first; a rotation changes no cosine.  Nodes are dealt
by label and first coordinate and split by medians of the leading coordinates
into tiles.  Two unit vectors with cosine >= t are at most sqrt(2 - 2t) apart,
so a tile meets, through an equi-join on cells of that width of the first
coordinate, only tiles whose boxes in the leading coordinates are that near.
Inside a tile pair the leading coordinates are multiplied first; the rest of a
product is at most the product of the two suffix norms, and a pair stops as soon
as that cannot reach the threshold.  What survives all coordinates is decided by
the cosine of the originals.

A tile pair returns per node the number of vectors linked, and a spanning
forest of its links, at most one edge per node: no pairs of a group are emitted.
Tiles travel once per tile pair and are compared one at a time.

Defined cases: a vector that is null, empty, zero or holds null or non-finite
components, or whose label is null, links with nothing and is its own component;
vectors of different dimensions do not link; repeated rows are vectors of their own
that link with each other; null ids are ignored for the smallest id; an
empty table gives an empty result; other columns are not returned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import checkpoint
from strata.llm.components import components
from strata.llm.vectors import matrix, usable

_STEP = 8           # coordinates multiplied at a time
_BOX = 8            # leading coordinates of a tile's box
_TILE_BYTES = 1 << 20
_SLACK = 1e-9       # for rounding in bounds; the decision itself is exact
_PAIRS = 1 << 16    # pairs gathered at a time


def _moments(batches):
    """Per partition and dimension the rows of the sum of outer products of unit vectors."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        lists = batch.column(0)
        n = np.diff(lists.offsets.to_numpy())
        for d in np.unique(n):
            x = matrix(lists.filter(pa.array(n == d)))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            total[int(d)] = total.get(int(d), 0) + x.T @ x
    yield from _moment_rows(total)


def _moment_rows(total):
    for d, m in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([r.tobytes() for r in m], pa.binary())],
                                         names=["dim", "i", "row"])


def _add_rows(batches):
    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for d, i, r in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            part = np.frombuffer(r)
            total[d, i] = total[d, i] + part if (d, i) in total else part
    if total:
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int32()),
                                          pa.array([v.tobytes() for v in total.values()], pa.binary())], names=["dim", "i", "row"])


def principal_basis(nodes: DataFrame) -> dict[int, np.ndarray]:
    """Per dimension the eigenvectors (as columns) of the second-moment matrix, largest eigenvalue first."""
    schema = "dim int, i int, row binary"
    rows = nodes.select("x").mapInArrow(_moments, schema).repartition("dim", "i").mapInArrow(_add_rows, schema).collect()
    out = {}
    for d in {r["dim"] for r in rows}:
        m = np.stack([np.frombuffer(r["row"]) for r in sorted((r for r in rows if r["dim"] == d), key=lambda r: r["i"])])
        out[d] = np.linalg.eigh(m)[1][:, ::-1].copy()
    return out


def _split(z: np.ndarray, rows: np.ndarray, most: int, axis: int = 0) -> list[np.ndarray]:
    """Runs of at most ``most`` rows by medians of the leading coordinates in turn."""
    if len(rows) <= most:
        return [rows]
    order = rows[np.argsort(z[rows, axis], kind="stable")]
    half = len(order) // 2
    nxt = (axis + 1) % min(_BOX, z.shape[1])
    return _split(z, order[:half], most, nxt) + _split(z, order[half:], most, nxt)


def _tiles(basis: dict[int, np.ndarray], width: float):
    """One row per tile: its label, dimension, first and last cell, box, nodes, counts and vectors."""
    names = ["tile", "label", "dim", "first", "last", "low", "high", "nodes", "counts", "vectors"]

    def emit(label, x, nodes, counts, base, k):
        d = x.shape[1]
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        z = unit @ basis[d]
        lead = min(_BOX, d)
        rows = []
        for part in _split(z, np.arange(len(x)), max(16, _TILE_BYTES // (8 * d))):
            low, high = z[part, :lead].min(axis=0), z[part, :lead].max(axis=0)
            rows.append((base + k + len(rows), label, d, int(np.floor((low[0] - _SLACK) / width)), int(np.floor((high[0] + _SLACK) / width)), low.tolist(), high.tolist(),
                         b"".join(nodes[i] for i in part), counts[part].tobytes(), x[part].tobytes()))
        cols = list(zip(*rows, strict=True))
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names), len(rows)

    def run(batches):
        base, k = TaskContext.get().partitionId() << 32, 0
        held: list[pa.RecordBatch] = []
        own, size = None, 0

        def done():
            t = pa.Table.from_batches(held)
            return emit(own[0], matrix(t.column(4).combine_chunks()), t.column(2).to_pylist(), t.column(3).to_numpy(), base, k)

        for batch in batches:
            key = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)])
            edge = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edge, edge[1:], strict=False):
                if a == b:
                    continue
                now = tuple(key[:, a].tolist())
                if held and (now != own or size * own[1] * 8 > 16 * _TILE_BYTES):
                    out, n = done()
                    yield out
                    k, held, size = k + n, [], 0
                own = now
                held.append(batch.slice(a, b - a))
                size += b - a
        if held:
            yield done()[0]
    return run


def tile_links(x: np.ndarray, y: np.ndarray, basis: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i of x, j of y) with cosine >= threshold; within one tile only i < j."""
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    u, v = (x / nx[:, None]) @ basis, (y / ny[:, None]) @ basis
    d, least = x.shape[1], threshold - _SLACK
    su, sv = (np.sqrt(np.maximum(0, np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1])) for m in (u, v))   # norms of what is left from a coordinate on
    su, sv = np.pad(su, ((0, 0), (0, 1))), np.pad(sv, ((0, 0), (0, 1)))
    e = min(_STEP, d)
    part = u[:, :e] @ v[:, :e].T
    near = part + su[:, e, None] * sv[None, :, e] >= least
    if same:
        near &= np.arange(len(x))[:, None] < np.arange(len(y))[None, :]
    i, j = np.nonzero(near)
    part = part[i, j]
    out_i, out_j = [], []
    for a in range(0, len(i), _PAIRS):
        p, q, s = i[a:a + _PAIRS], j[a:a + _PAIRS], part[a:a + _PAIRS]
        for b in range(e, d, _STEP):
            f = min(d, b + _STEP)
            s = s + np.einsum("ij,ij->i", u[p, b:f], v[q, b:f])
            ok = s + su[p, f] * sv[q, f] >= least
            p, q, s = p[ok], q[ok], s[ok]
        ok = np.einsum("ij,ij->i", x[p], y[q]) / (nx[p] * ny[q]) >= threshold
        out_i.append(p[ok])
        out_j.append(q[ok])
    z = np.zeros(0, np.int64)
    return np.concatenate([z, *out_i]), np.concatenate([z, *out_j])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each one's component."""
    root = np.arange(n)
    while True:
        before = root
        low = np.minimum(root[a], root[b])
        root = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def _compare(basis: dict[int, np.ndarray], threshold: float):
    """Rows (node, other, n): n vectors linked to node, or with n = 0 an edge to other."""
    def load(nodes, counts, vectors, d):
        return np.frombuffer(nodes, "S16"), np.frombuffer(counts, np.int64), np.frombuffer(vectors).reshape(-1, d)

    def run(batches):
        own = None
        for batch in batches:
            for row in batch.to_pylist():
                now = load(row["nodes"], row["counts"], row["vectors"], row["dim"])
                same = row["other"] == row["tile"]
                if same:
                    own = now
                i, j = tile_links(own[2], now[2], basis[row["dim"]], threshold, same)
                if not len(i):
                    continue
                n = len(own[0])
                raw = [row_nodes(x[0]) for x in (own, now)]
                degree = [np.bincount(i, now[1][j], n), np.bincount(j, own[1][i], len(now[0]))]
                names, add = [], []
                for r, g in zip(raw, degree, strict=True):
                    some = np.flatnonzero(g)
                    names += [r[t] for t in some]
                    add += g[some].astype(np.int64).tolist()
                root = forest(n if same else n + len(now[0]), i, j if same else j + n)
                every = raw[0] if same else raw[0] + raw[1]
                edge = np.flatnonzero(root != np.arange(len(root)))
                yield pa.RecordBatch.from_arrays([
                    pa.array(names + [every[t] for t in edge], pa.binary()), pa.array([None] * len(names) + [every[root[t]] for t in edge], pa.binary()),
                    pa.array(add + [0] * len(edge), pa.int64())], names=["node", "other", "n"])

    def row_nodes(a):
        raw = a.tobytes()
        return [raw[t:t + 16] for t in range(0, len(raw), 16)]
    return run


def embedding_classes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                      threshold: float = 0.98) -> DataFrame:
    """One row per vector: id_col, n_links, component_id, kept."""
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("x"))
    good = v.where(F.col("label").isNotNull() & usable(F.col("x")))
    nodes = good.groupBy("label", "x").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    node = F.unhex(F.concat(F.lpad(F.hex(F.coalesce("id", F.lit(0))), 16, "0"), F.lpad(F.hex(F.xxhash64("label", "x")), 16, "0")))
    nodes = checkpoint(nodes.withColumn("node", node))
    basis = principal_basis(nodes)
    width = float(np.sqrt(max(2 - 2 * threshold, 1e-6))) + _SLACK
    keys = {d: b[:, 0].tolist() for d, b in basis.items()}

    def dealt(batches):
        for batch in batches:
            lists = batch.column(3)
            n = np.diff(lists.offsets.to_numpy())
            for d in np.unique(n):
                ok = pa.array(n == d)
                part = batch.filter(ok)
                x = matrix(part.column(3))
                lead = x @ np.array(keys[int(d)]) / np.linalg.norm(x, axis=1)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.full(len(x), d, np.int32)), part.column(1), part.column(2),
                                                  pa.array(x.tolist(), pa.list_(pa.float64())), pa.array(lead)], names=["label", "dim", "node", "n", "x", "lead"])

    rows = nodes.select("label", "node", "n", "x").mapInArrow(dealt, "label long, dim int, node binary, n long, x array<double>, lead double")
    rows = rows.repartitionByRange("label", "dim", "lead").sortWithinPartitions("label", "dim", "lead", "node").select("label", "dim", "node", "n", "x")
    tiles = checkpoint(rows.mapInArrow(_tiles(basis, width), "tile long, label long, dim int, first int, last int, low array<double>, high array<double>, "
                                                            "nodes binary, counts binary, vectors binary"))
    box = tiles.select("tile", "label", "dim", "first", "last", "low", "high")
    a = box.withColumn("cell", F.explode(F.sequence(F.col("first") - 1, F.col("last") + 1))).alias("a")
    b = box.withColumn("cell", F.explode(F.sequence("first", "last"))).alias("b")
    gap = F.zip_with(F.zip_with("a.low", "b.high", lambda x, y: x - y), F.zip_with("b.low", "a.high", lambda x, y: x - y), lambda x, y: F.greatest(x, y, F.lit(0.0)))
    apart = F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g)
    pairs = (a.join(b, [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("label", "dim", "cell")])
             # of the cells that both have, the first stands for the pair
             .where((F.col("a.tile") <= F.col("b.tile")) & (F.col("a.cell") == F.greatest(F.col("a.first") - 1, F.col("b.first"))) & (apart <= (width + _SLACK) ** 2))
             .select(F.col("a.tile").alias("tile"), F.col("b.tile").alias("other")))
    work = pairs.join(tiles.withColumnRenamed("tile", "other"), "other").select(
        "tile", "other", "dim", "nodes", "counts", "vectors", (F.col("tile") != F.col("other")).alias("later"))
    work = work.repartition("tile").sortWithinPartitions("tile", "later", "other")   # a tile comes first, then those it meets
    found = checkpoint(work.mapInArrow(_compare(basis, threshold), "node binary, other binary, n long"))
    degree = found.where("other is null").groupBy("node").agg(F.sum("n").alias("links"))
    comp = components(found.where("other is not null"), "node", "other")
    full = (nodes.join(degree, "node", "left").join(comp, "node", "left").withColumn("root", F.coalesce("root", "node")))
    low = full.groupBy("root").agg(F.min("id").alias("component_id"))
    full = full.join(low, "root").select("label", "x", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    out = v.alias("v").join(full.alias("f"), (F.col("v.label") == F.col("f.label")) & (F.col("v.x") == F.col("f.x")), "left")
    # what has no node links with nothing
    lone = F.col("f.n_links").isNull()
    component = F.when(lone, F.col("v.id")).otherwise(F.col("f.component_id"))
    return out.select(F.col("v.id").alias(id_col), F.coalesce("f.n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      component.eqNullSafe(F.col("v.id")).alias("kept"))
