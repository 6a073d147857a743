"""Exact near-duplicate pairs of vectors by dual traversal of cover trees.

The tree's top is shared by the whole cluster: up to MAX_NODES centres picked from a bounded sample, each vector under its
nearest centre, each centre with its covering radius. Pairs of top nodes further apart than both radii and the distance
sought are pruned; a vector also stays away from a partner node whose centre is further than that node's radius and the
distance, or whose half-space is out of reach. What remains meets in blocks of bounded size, where each side's lower levels
(nested centres with halving radii) are built in numpy and traversed in pairs: a pair of nodes is dropped, or counted
whole without a look at its vectors, or opened.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import Scratch, small_batches

#: Centres of the shared top; vectors of one block; sampled vectors for each centre.
MAX_NODES, BLOCK, SAMPLE = 512, 4096, 16
#: Nodes or vectors of one side that are compared at a time.
ROWS = 512
# Bounds are used only with this to spare, so rounding never decides a pair; in blocks they are in single precision.
_SLACK, _SINGLE = 1e-7, 2e-5


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def _cover(u: np.ndarray, radius: float, within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A net of the unit vectors: indices of centres and each vector's centre (a position among them), at most ``radius``
    away. Greedy, in batches: what the centres so far cover is settled at once."""
    left, owner, centres = np.arange(len(u)), np.full(len(u), -1), []
    while len(left):
        take = left[: max(64, min(512, len(left)))]
        new = []
        d = _apart(u[take], u[take])
        done = np.zeros(len(take), bool)
        for i in range(len(take)):
            if not done[i]:
                new.append(take[i])
                done |= d[i] <= radius
        near = _apart(u[left], u[new])
        best = near.argmin(1)
        hit = near[np.arange(len(left)), best] <= radius
        hit |= np.isin(left, new)
        owner[left[hit]] = len(centres) + best[hit]
        for j, c in enumerate(new):
            owner[c] = len(centres) + j
        centres += new
        left = left[~hit]
    return np.array(centres, np.int64), owner


def planted(x: np.ndarray, reach: float) -> np.ndarray:
    """The tree of a block as a path for each vector: its node at each level, coarsest first, numbered so that a node's centre is
    the first of what lies under it in the order of the paths; last 0 for the centre of a leaf and 1 for the others."""
    u, nets = _unit(x), [1.0]
    while nets[-1] > reach / 4:
        nets.append(nets[-1] / 2)
    centres, owner = _cover(u, nets[-1])
    levels = [(centres, owner)]  # finest first: a coarser net is taken of the finer one's centres, so the nets are nested
    for r in reversed(nets[:-1]):
        fine = levels[-1][0]
        picked, up = _cover(u[fine], r)
        levels.append((fine[picked], up))
    paths = np.ones((len(u), len(levels) + 1), np.int32)
    paths[centres, -1] = 0
    number = None
    for at in range(len(levels) - 1, -1, -1):  # coarsest first
        own = levels[at][0]
        if number is None:
            order = np.arange(len(own))
        else:
            above, up = levels[at + 1]
            order = np.lexsort((own != above[up], number[up]))
        number = np.empty(len(own), np.int64)
        number[order] = np.arange(len(own))
        node = levels[0][1]
        for k in range(1, at + 1):
            node = levels[k][1][node]
        paths[:, len(levels) - 1 - at] = number[node]
    return paths


class Tree:
    """Levels of one block, or of a part of it, coarsest first. Level l has centres (rows of x), covering radii to all vectors
    below, and for each node its parent at the level above; ``leaf_of`` has each vector's node of the last level. The vectors are
    in the order of the tree, so that what lies under a node is a range at every level. A node whose centre is not among the
    vectors has its first one for a centre."""

    def __init__(self, x: np.ndarray, paths: np.ndarray):
        self.order = np.lexsort(paths.T[::-1])
        self.x, paths = x[self.order].astype(np.float64), paths[self.order]
        self.length = np.sqrt((self.x * self.x).sum(1))
        u = (self.x / self.length[:, None]).astype(np.float32)
        self.single, self.centres, self.radii, self.parents = u, [], [], []
        above = None
        for path in paths.T[:-1]:
            new = np.r_[True, path[1:] != path[:-1]]
            first, number = np.flatnonzero(new), np.cumsum(new) - 1
            far = np.zeros(len(u), np.float32)
            rest = np.flatnonzero(~new)
            gap = u[rest] - u[first[number[rest]]]
            far[rest] = np.sqrt(np.einsum("ij,ij->i", gap, gap)) * np.float32(1 + 1e-5)
            self.centres.append(first)
            self.radii.append(np.maximum.reduceat(far, first))
            self.parents.append(np.zeros(len(first), np.int64) if above is None else above[first])
            above = number
        self.leaf_of = number


def traverse(a: Tree, b: Tree, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Of the leaves of two trees, as matrices: which pairs may hold a link, and which are linked throughout.

    Each level opens only the children of pairs that the level above has kept, run by run of about ROWS nodes, so what is held
    at a time is bounded by the block's size, however badly it prunes."""
    kept, spare = np.ones((1, 1), bool), np.float32(_SINGLE + a.single.shape[1] * np.finfo(np.float32).eps)
    for level in range(len(a.centres)):
        pa_, pb, ra, rb = a.parents[level], b.parents[level], a.radii[level], b.radii[level]
        ca, cb = a.single[a.centres[level]], b.single[b.centres[level]]
        last = level == len(a.centres) - 1
        new, sure = np.zeros((len(ca), len(cb)), bool), np.zeros((len(ca), len(cb)) if last else (0, 0), bool)
        for lo in range(0, len(pa_), ROWS):
            hi = min(lo + ROWS, len(pa_))
            up = kept[pa_[lo] : pa_[hi - 1] + 1]
            cols = np.flatnonzero(up.any(0)[pb])
            if not len(cols):
                continue
            dot = ca[lo:hi] @ cb[cols].T
            far = ra[lo:hi, None] + rb[cols]
            near = dot >= (1 - spare) - (far + np.float32(reach)) ** 2 / 2
            near &= up[pa_[lo:hi] - pa_[lo]][:, pb[cols]]
            new[lo:hi, cols] = near
            if last:
                sure[lo:hi, cols] = near & (dot >= (1 + spare) - np.maximum(0, np.float32(reach) - far) ** 2 / 2)
        kept = new
    return kept & ~sure, sure


def _joined(hit: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Edges (a node, one of the same component) that connect what a matrix of links between x and y connects."""
    r, c = np.flatnonzero(hit.any(1)), np.flatnonzero(hit.any(0))
    if not len(r):
        return np.zeros((0, 2), np.int64)
    hit = hit[r][:, c]
    top = np.int32(len(r))
    row, col = np.arange(len(r), dtype=np.int32), np.full(len(c), top)
    while True:
        col2 = np.minimum(col, np.where(hit, row[:, None], top).min(0))
        row2 = np.minimum(row, np.where(hit, col2, top).min(1))
        row2 = np.minimum(row2, row2[row2])
        if (row2 == row).all() and (col2 == col).all():
            break
        row, col = row2, col2
    root = x[r]
    return np.concatenate([np.column_stack([root, root[row]]), np.column_stack([y[c], root[col]])])


def block_links(xa: np.ndarray, ia: np.ndarray, wa: np.ndarray, xb: np.ndarray | None, ib: np.ndarray, wb: np.ndarray, cosine: float, pa_: np.ndarray | None = None, pb: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, list]:
    """Links within a block (xb None) or between two: for each vector the number of rows linked on the other side (w: rows of
    each vector; in its own block a vector counts its own rows too), and edges enough to connect what is linked. Paths are planted
    where none are given."""
    reach = math.sqrt(2 - 2 * cosine)
    a = Tree(xa, planted(xa, reach) if pa_ is None else pa_)
    same = xb is None
    b = a if same else Tree(xb, planted(xb, reach) if pb is None else pb)
    na, nb = np.zeros(len(ia), np.int64), np.zeros(len(ib), np.int64)
    ia, wa, ib, wb = ia[a.order], wa[a.order], ib[b.order], wb[b.order]
    open_, sure = traverse(a, b, reach)
    if same:  # a leaf's radius is at most a quarter of the reach (half of it round another vector), so all of a leaf is linked
        np.fill_diagonal(open_, False)
        np.fill_diagonal(sure, True)
    edges = []
    first_a, first_b = (np.searchsorted(t.leaf_of, np.arange(len(t.centres[-1]) + 1)) for t in (a, b))
    rows_a, rows_b = np.add.reduceat(wa, first_a[:-1]), np.add.reduceat(wb, first_b[:-1])
    heads_a, heads_b = ia[first_a[:-1]], ib[first_b[:-1]]
    whole_a, whole_b = np.zeros(len(heads_a), np.int64), np.zeros(len(heads_b), np.int64)
    for at in range(0, len(heads_a), ROWS):
        part = sure[at : at + ROWS]
        if part.any():
            edges.append(_joined(part, heads_a[at : at + ROWS], heads_b))
            part = part.astype(float)
            whole_a[at : at + ROWS] = part @ rows_b
            whole_b += (rows_a[at : at + ROWS] @ part).astype(np.int64)
    ca, cb = whole_a[a.leaf_of], whole_b[b.leaf_of]
    if same:
        edges.append(np.column_stack([ia, heads_a[a.leaf_of]]))
    else:  # leaves that are linked throughout
        edges += [np.column_stack([ia, heads_a[a.leaf_of]])[ca > 0], np.column_stack([ib, heads_b[b.leaf_of]])[cb > 0]]
    busy, at = np.flatnonzero(open_.any(1)), 0
    while at < len(busy):  # runs of leaves of about ROWS vectors; a leaf of more is cut
        end = at + 1
        held = first_a[busy[at] + 1] - first_a[busy[at]]
        while end < len(busy) and held + first_a[busy[end] + 1] - first_a[busy[end]] <= ROWS:
            held += first_a[busy[end] + 1] - first_a[busy[end]]
            end += 1
        leaves = busy[at:end]
        at = end
        mine = np.concatenate([np.arange(first_a[k], first_a[k + 1]) for k in leaves])
        theirs = np.flatnonzero(open_[leaves].any(0)[b.leaf_of])
        for k in range(0, len(mine), ROWS):
            i = mine[k : k + ROWS]
            for m in range(0, len(theirs), 8 * ROWS):
                j = theirs[m : m + 8 * ROWS]
                hit = (a.x[i] @ b.x[j].T) / (a.length[i][:, None] * b.length[j]) >= cosine
                hit &= open_[a.leaf_of[i]][:, b.leaf_of[j]]
                edges.append(_joined(hit, ia[i], ib[j]))
                hit = hit.astype(float)
                ca[i] += (hit @ wb[j]).astype(np.int64)
                cb[j] += (wa[i] @ hit).astype(np.int64)
    na[a.order] = ca  # (of a block with itself, both orders of a pair were met)
    nb[b.order] = cb
    return na, nb, edges


def _block_join(dim: int, cosine: float, kind: str):
    """The join of one pair of blocks: rows with counts by vector, then rows with edges."""

    def joined(table: pa.Table) -> pa.Table:
        second = table["second"].to_numpy()
        ids, w = table["id"].to_numpy(), table["w"].to_numpy()
        x = _matrix(table["v"], dim, kind)
        paths = np.frombuffer(b"".join(table["path"].to_pylist()), np.int32).reshape(len(ids), -1)
        same = table["a"][0].as_py() == table["b"][0].as_py()
        n = np.zeros(len(ids), np.int64)
        edges = []
        p, q = np.flatnonzero(~second), np.flatnonzero(second)
        if same:
            n[p], _, edges = block_links(x[p], ids[p], w[p], None, ids[p], w[p], cosine, paths[p])
        elif len(p) and len(q):
            n[p], n[q], edges = block_links(x[p], ids[p], w[p], x[q], ids[q], w[q], cosine, paths[p], paths[q])
        e = np.concatenate([*edges, np.zeros((0, 2), np.int64)])
        e = np.unique(e[e[:, 0] != e[:, 1]], axis=0)
        some = n > 0
        return pa.table({"vec": pa.array(np.concatenate([[None] * len(e), table["v"].to_numpy(zero_copy_only=False)[some]]), pa.binary()), "n": np.concatenate([np.zeros(len(e), np.int64), n[some]]), "src": np.concatenate([e[:, 0], np.zeros(int(some.sum()), np.int64)]), "dst": np.concatenate([e[:, 1], np.zeros(int(some.sum()), np.int64)])})

    return joined


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id long, n_links long, component_id long, kept boolean), a row for each row of ``vectors``.

    Two rows link when the cosine of their vectors, in double precision, is at least ``cosine`` (over 0). Rows whose vector is
    null, empty, zero or has null or non-finite components link with nothing, nor do rows of different lengths with each
    other. component_id is the smallest id reachable; n_links counts rows, also those that repeat an id. Rows with equal
    vectors are one node that knows its number of rows, so any number of copies costs no pair. Other columns are ignored.
    Results are exact; nothing is sampled but the vectors that centres are picked from, which decide speed alone.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "cover")
    reach = math.sqrt(2 - 2 * cosine)
    kind = "f4" if "array<float>" in vectors.select(vector_col).schema[0].dataType.simpleString() else "f8"  # as they come

    def packed(batches):
        for b in batches:
            out = []
            for v in b.column(1).to_pylist():
                x = np.array(v if v and None not in v else [0], kind) + np.zeros(1, kind)
                with np.errstate(over="ignore"):
                    length = (x.astype(np.float64) ** 2).sum()
                out.append(x.tobytes() if np.isfinite(length) and length > 0 else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["vec_id", "v"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{'float' if kind == 'f4' else 'double'}>").alias("e"))
    rows = scratch.write(rows.mapInArrow(packed, "vec_id long, v binary"))
    nodes = scratch.write(rows.where("v is not null and vec_id is not null").groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("w")))
    facts = nodes.groupBy(F.length("v").alias("bytes")).count().orderBy("bytes").collect()  # a row for each length of vector
    parts, links = [], []
    for size, count in facts:
        mine, dim = nodes.where(F.length("v") == size), size // int(kind[1])
        k = max(1, min(MAX_NODES, math.ceil(count / BLOCK)))
        share = min(1.0, 4 * SAMPLE * k / count)
        sample = mine.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) <= int(share * (1 << 30))).limit(4 * SAMPLE * k).select("v").toPandas()["v"]
        u = _unit(np.frombuffer(b"".join(sample), kind).reshape(-1, dim)) if len(sample) else _unit(np.ones((1, dim)))
        picked, far = [0], _apart(u, u[:1])[:, 0]
        while len(picked) < k and far.max() > reach:  # each next centre is the vector furthest from the others
            picked.append(int(far.argmax()))
            far = np.minimum(far, _apart(u, u[picked[-1:]])[:, 0])
        centres = u[picked]

        def under(batches, centres=centres, dim=dim):
            for b in batches:
                if b.num_rows:
                    d = _apart(_unit(_matrix(b.column(0), dim, kind)), centres)
                    cell = d.argmin(1)
                    yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell])], ["cell", "far"])

        stats = mine.select("v").mapInArrow(under, "cell int, far double").groupBy("cell").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()
        radius, blocks = np.zeros(len(centres)), np.zeros(len(centres), np.int64)
        for s in stats:
            radius[s.cell], blocks[s.cell] = s.radius, math.ceil(s.n / BLOCK)
        between = _apart(centres, centres)
        open_pair = (between <= radius[:, None] + radius + reach + _SLACK) & (blocks > 0) & (blocks[:, None] > 0)
        first = np.concatenate([[0], np.cumsum(blocks)])

        def homed(batches, centres=centres, dim=dim, blocks=blocks, first=first):
            """Each vector with its block: by hash within its cell."""
            for b in batches:
                if b.num_rows:
                    cell, ids = _apart(_unit(_matrix(b.column(0), dim, kind)), centres).argmin(1), b.column(1).to_numpy()
                    home = first[cell] + (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % blocks[cell]
                    yield pa.RecordBatch.from_arrays([pa.array(home), *b.columns], ["home", "v", "id", "w"])

        def grown(table: pa.Table) -> pa.Table:
            """A block's tree, once."""
            paths = planted(_matrix(table["v"], len(table["v"][0].as_py()) // int(kind[1]), kind), reach)
            return table.append_column("path", pa.array([p.tobytes() for p in paths], pa.binary()))

        def dealt(batches, centres=centres, dim=dim, radius=radius, between=between, open_pair=open_pair, first=first):
            """Each vector to every pair of blocks that its own block is in and that it can have a link in."""
            for b in batches:
                if not b.num_rows:
                    continue
                d = _apart(_unit(_matrix(b.column(1), dim, kind)), centres)
                home = b.column(0).to_numpy()
                cell = np.searchsorted(first, home, "right") - 1
                own = d[np.arange(len(d)), cell]
                gap = np.maximum(between[cell], 1e-12)
                meets = open_pair[cell] & (d <= radius + reach + _SLACK) & ((d**2 - own[:, None] ** 2) / (2 * gap) <= reach + _SLACK)
                meets[np.arange(len(d)), cell] = True
                for other in range(len(centres)):
                    r = np.flatnonzero(meets[:, other])
                    for t in range(first[other], first[other + 1]) if len(r) else ():
                        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(home[r], t)), pa.array(np.maximum(home[r], t)), pa.array(home[r] > t), *(b.column(i).take(pa.array(r)) for i in (2, 3, 1, 4))], ["a", "b", "second", "id", "w", "v", "path"])

        homes = mine.select("v", "id", "w").mapInArrow(homed, "home long, v binary, id long, w long")
        trees = scratch.write(homes.groupBy("home").applyInArrow(grown, "home long, v binary, id long, w long, path binary"))
        pairs = trees.mapInArrow(dealt, "a long, b long, second boolean, id long, w long, v binary, path binary")
        found = scratch.write(pairs.groupBy("a", "b").applyInArrow(_block_join(dim, cosine, kind), "vec binary, n long, src long, dst long"))
        parts.append(found.where("vec is not null").groupBy("vec").agg(F.sum("n").alias("n")))
        links.append(found.where("vec is null").select("src", "dst"))
    if not parts:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts, edges = parts[0], links[0]
    for c, e in zip(parts[1:], links[1:], strict=True):
        counts, edges = counts.union(c), edges.union(e)
    comps = connected_components(spark, edges, scratch)
    known = nodes.join(counts.withColumnRenamed("vec", "v"), "v", "left").join(comps.withColumnRenamed("node", "id"), "id", "left").select("v", (F.coalesce("n", F.col("w")) - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = rows.join(known, "v", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
