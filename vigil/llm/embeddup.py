"""Embedding near-duplicates by dual traversal of cover trees.

Vectors are normalised in double precision; cosine >= t is a distance of at
most sqrt(2 - 2t) on the unit sphere.  The top of the tree is a bounded set of
pivots (at most ``MAX_PIVOTS`` vectors in hash order; every vector is assigned
to its nearest pivot).  A pivot's cell is cut into blocks of about
``BLOCK_ROWS`` vectors, and each block gets a cover tree: nested levels whose
radii halve, every node with its exact covering radius.

Two trees are traversed together.  A pair of nodes is pruned when the distance
of their centres exceeds the threshold distance by more than both covering
radii, accepted as a whole when the distance and both radii fit in the
threshold, and opened otherwise; below that vectors are compared exactly.  A
node also keeps the mean of its members and the radius about it: a tight group
of near copies is accepted by this smaller ball without looking at its pairs.
Per vector only its number of links leaves a task, and links that span the
same components, never all pairs of a group.

A tree is written once, as a file in the shared folder, and never shuffled: what
travels is names of blocks.  The pairs of blocks that can hold links are dealt in
tiles of ``TILE`` x ``TILE`` blocks, so that a task reads 2 ``TILE`` trees for up to
``TILE`` squared pairs; it holds no more than these.

Exact copies are one vector with a multiplicity.  Vectors that are null, empty,
zero or hold null or non-finite components link with nothing; vectors of
different lengths do not link.  Repeated ids are separate rows; an empty table
gives an empty result.  Labels and extra columns are ignored.
"""
from __future__ import annotations

import pickle
import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import scratch, staged
from vigil.llm.components import connected_components, spanning_links
from vigil.llm.warc import filesystem
from vigil.sources.store import remove

THRESHOLD = 0.9
BLOCK_ROWS = 4096
MAX_BLOCKS = 16_384        # blocks hold more rows beyond this many, so that their directory stays bounded
MAX_PIVOTS = 1024
TILE = 8                   # blocks on each side of a tile of pairs
LEAF = 8
MARGIN = 1e-9              # bounds keep this far from the threshold, so that rounding never decides them


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of unit length in double precision."""
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Tree:
    """Cover tree over unit vectors: per node its centre, covering radius, members and children.

    Members of a node are the range [lo, hi) of the tree's own vector order.
    """

    def __init__(self, vectors: np.ndarray):
        self.order: list[int] = []
        self.centre: list[int] = []        # index into ``vectors`` while building
        self.radius: list[float] = []
        self.lo: list[int] = []
        self.hi: list[int] = []
        self.children: list[list[int]] = []
        self._grow(vectors, np.arange(len(vectors)), 2.0)
        place = np.empty(len(vectors), np.int64)
        place[self.order] = np.arange(len(vectors))
        self.vectors = vectors[self.order]
        self.centre = place[self.centre]
        self.radius = np.asarray(self.radius)
        self.lo, self.hi = np.asarray(self.lo), np.asarray(self.hi)
        self.children = [np.asarray(c, np.int64) for c in self.children]
        # ball about the mean, of the nodes that hold more than one vector
        self.ball = {}
        for i in np.flatnonzero(self.hi - self.lo > 1).tolist():
            own = self.vectors[self.lo[i]:self.hi[i]]
            mean = own.mean(axis=0)
            self.ball[i] = (mean, float(np.sqrt(((own - mean) ** 2).sum(axis=1).max())))

    def parts(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """What node i is made of: single vectors (the members of leaves), and inner nodes."""
        kids = self.children[i]
        if not len(kids):
            return np.arange(self.lo[i], self.hi[i]), kids
        inner = np.asarray([k for k in kids.tolist() if len(self.children[k])], np.int64)
        leaves = [np.arange(self.lo[k], self.hi[k]) for k in kids.tolist() if not len(self.children[k])]
        return np.concatenate(leaves) if leaves else np.empty(0, np.int64), inner

    def _grow(self, v: np.ndarray, members: np.ndarray, cover: float) -> int:
        """Node over ``members``; members[0] is its centre, all within ``cover``."""
        stack = [(members, cover, -1)]
        root = None
        closing: list[tuple[int, int]] = []
        while stack:
            members, cover, parent = stack.pop()
            if members is None:                       # all children placed: the range is complete
                self.hi[parent] = len(self.order)
                continue
            node = len(self.centre)
            root = node if root is None else root
            far = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (v[members] @ v[members[0]])))
            self.centre.append(int(members[0]))
            self.radius.append(float(far.max()))
            self.lo.append(len(self.order))
            self.hi.append(len(self.order) + len(members))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if len(members) <= LEAF or self.radius[node] <= MARGIN:
                self.order.extend(members.tolist())
                continue
            # the net of the next level: each new centre covers what lies within half the radius
            half = cover / 2
            while half >= self.radius[node]:
                half /= 2
            groups, left = [], members
            while len(left):
                d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (v[left] @ v[left[0]])))
                near = d <= half
                near[0] = True
                groups.append(left[near])
                left = left[~near]
            for g in reversed(groups):
                stack.append((g, half, node))
        return root


def _distance(dot: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dot))


def _spanning(hit: np.ndarray, x0: np.ndarray, y0: np.ndarray, tag: int):
    """Spanning links of a comparison's hits, (x, y) as indices: the first hit of every row and column, then
    whatever hit still joins two parts.  ``tag`` keeps the nodes of both sides apart (0: one side)."""
    rows, cols = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    xs, ys = [x0[rows], x0[hit[:, cols].argmax(axis=0)]], [y0[hit[rows].argmax(axis=1)], y0[cols]]
    while len(rows):
        x, y = np.concatenate(xs), np.concatenate(ys)
        node, root = spanning_links(x, y + tag)
        label = dict(zip(node.tolist(), root.tolist()))
        la = np.asarray([label.get(v, v) for v in x0[rows].tolist()])
        lb = np.asarray([label.get(v, v) for v in (y0[cols] + tag).tolist()])
        p, q = np.nonzero(hit[np.ix_(rows, cols)] & (la[:, None] != lb[None, :]))
        if not len(p):
            break
        _, first = np.unique(np.minimum(la[p], lb[q]) * (1 << 32) + np.maximum(la[p], lb[q]), return_index=True)
        xs.append(x0[rows[p[first]]])
        ys.append(y0[cols[q[first]]])
    return np.concatenate(xs), np.concatenate(ys)


def dual(a: Tree, b: Tree, weight_a: np.ndarray, weight_b: np.ndarray, threshold: float):
    """(links per vector of a, of b, x, y): weighted link counts and spanning links between the trees.

    ``a is b`` means the pairs inside one tree, each counted once for both ends.
    """
    same = a is b
    reach = float(np.sqrt(max(0.0, 2.0 - 2.0 * threshold)))
    count_a, count_b = np.zeros(len(a.vectors), np.int64), np.zeros(len(b.vectors), np.int64)
    xs, ys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    sum_a, sum_b = np.concatenate([[0], np.cumsum(weight_a)]), np.concatenate([[0], np.cumsum(weight_b)])
    tag = 0 if same else len(a.vectors)

    def accept(i, j):
        """Every pair of nodes i and j links."""
        x0, x1, y0, y1 = a.lo[i], a.hi[i], b.lo[j], b.hi[j]
        if same and i == j:
            count_a[x0:x1] += sum_a[x1] - sum_a[x0] - weight_a[x0:x1]
            xs.append(np.arange(x0 + 1, x1))
            ys.append(np.full(x1 - x0 - 1, x0))
            return
        count_a[x0:x1] += sum_b[y1] - sum_b[y0]
        count_b[y0:y1] += sum_a[x1] - sum_a[x0]
        xs.extend([np.full(y1 - y0, x0), np.arange(x0, x1)])
        ys.extend([np.arange(y0, y1), np.full(x1 - x0, y0)])

    def compare(x, y, one):
        """Vectors x against vectors y, exactly, in blocks."""
        for k in range(0, len(x) if len(y) else 0, 512):
            rows = x[k:k + 512]
            hit = a.vectors[rows] @ b.vectors[y].T >= threshold
            if one:
                hit[np.arange(len(rows)), k + np.arange(len(rows))] = False
            if hit.any():
                count_a[rows] += hit @ weight_b[y]
                if not one:
                    count_b[y] += weight_a[rows] @ hit
                u, v = _spanning(hit, rows, y, tag)
                xs.append(u)
                ys.append(v)

    todo = [(0, 0)]
    while todo:
        i, j = todo.pop()
        if same and i > j:
            i, j = j, i
        if i in a.ball and j in b.ball:
            (m1, r1), (m2, r2) = a.ball[i], b.ball[j]
            d = float(np.sqrt(((m1 - m2) ** 2).sum()))
            if d - r1 - r2 > reach + MARGIN:
                continue
            if d + r1 + r2 <= reach - MARGIN:
                accept(i, j)
                continue
        one = same and i == j
        loose_a, inner_a = a.parts(i)
        loose_b, inner_b = b.parts(j)
        compare(loose_a, loose_b, one)
        # inner nodes against single vectors: by the node's covering radius, then exactly
        for n in inner_a:
            d = _distance(b.vectors[loose_b] @ a.vectors[a.centre[n]])
            compare(np.arange(a.lo[n], a.hi[n]), loose_b[d <= reach + a.radius[n] + MARGIN], False)
        for n in [] if one else inner_b:
            d = _distance(a.vectors[loose_a] @ b.vectors[b.centre[n]])
            compare(loose_a[d <= reach + b.radius[n] + MARGIN], np.arange(b.lo[n], b.hi[n]), False)
        if len(inner_a) and len(inner_b):
            d = _distance(a.vectors[a.centre[inner_a]] @ b.vectors[b.centre[inner_b]].T)
            live = d <= reach + a.radius[inner_a][:, None] + b.radius[inner_b][None, :] + MARGIN
            if one:
                live &= inner_a[:, None] <= inner_b[None, :]
            p, q = np.nonzero(live)
            todo += zip(inner_a[p].tolist(), inner_b[q].tolist())
    return count_a, count_b, np.concatenate(xs), np.concatenate(ys)


# ------------------------------------------------------------------ Spark
def _nearest(pivots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pivots.value
        for b in batches:
            vectors = b.column(1)
            cell = np.zeros(b.num_rows, np.int32)
            dims = np.asarray([len(v) for v in vectors]) if b.num_rows else np.empty(0, int)
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x = unit(np.stack([vectors[int(r)].values.to_numpy(zero_copy_only=False) for r in rows]))
                cell[rows] = (x @ p[int(dim)].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(dims, pa.int32()), pa.array(cell)],
                                             names=["rep", "embedding", "mult", "dim", "cell"])
    return run


def _build(root: str):
    """The tree of a block into its file; a task that is run again writes the same file."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", ignore_index=True)
        tree = Tree(unit(np.stack(pdf["embedding"].to_numpy())))
        order = np.asarray(tree.order)
        head = pdf.iloc[0]
        name = f"{head['dim']}.{head['cell']}.{head['sub']}"
        fs, base = filesystem(root)
        fs.create_dir(base, recursive=True)
        draft = f"{base}/.{name}-{uuid.uuid4().hex}"
        with fs.open_output_stream(draft, compression=None) as f:
            f.write(pickle.dumps((tree, pdf["rep"].to_numpy()[order], pdf["mult"].to_numpy()[order].astype(np.int64))))
        fs.move(draft, f"{base}/{name}")
        return pd.DataFrame({"dim": [head["dim"]], "block": [name], "centre": [tree.vectors[tree.centre[0]].tolist()],
                             "radius": [float(tree.radius[0])]})
    return build


def _pairs(directory, reach: float):
    """(tile, left, right): the block pairs near enough for a link; a tile joins the strips that the blocks lie in."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks = directory.value
        for pdf in frames:
            for name, dim, centre, radius in zip(pdf["block"], pdf["dim"], pdf["centre"], pdf["radius"]):
                names, centres, radii = blocks[dim]
                own = int(np.flatnonzero(names == name)[0])
                near = np.flatnonzero(_distance(centres @ np.asarray(centre)) <= reach + radius + radii + MARGIN)
                near = near[near >= own]
                yield pd.DataFrame({"tile": [f"{dim}.{own // TILE}.{k // TILE}" for k in near], "left": [name] * len(near),
                                    "right": names[near]})
    return run


def _compare(root: str, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(root)
        held: OrderedDict = OrderedDict()                  # the trees read last, of a tile's two strips
        links_x, links_y, n = [], [], 0

        def tree(name: str):
            if name in held:
                held.move_to_end(name)
            else:
                with fs.open_input_stream(f"{base}/{name}", compression=None) as f:
                    held[name] = pickle.loads(f.read())
                if len(held) > 2 * TILE:
                    held.popitem(last=False)
            return held[name]

        def rows(kind, a, b):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)],
                                              names=["kind", "a", "b"])
        for batch in batches:
            for i in range(batch.num_rows):
                left, right = batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
                a, id_a, w_a = tree(left)
                b, id_b, w_b = tree(right)
                count_a, count_b, x, y = dual(a, b, w_a, w_b, threshold)
                if a is b:
                    count_a, count_b = count_a + count_b, np.zeros(0, np.int64)
                for ids, count in ((id_a, count_a), (id_b, count_b)):
                    on = np.flatnonzero(count)
                    if len(on):
                        yield rows(1, ids[on], count[on])
                if len(x):
                    u, v = spanning_links(id_a[x], id_b[y])
                    links_x.append(u)
                    links_y.append(v)
                    n += len(u)
                if n > 200_000:
                    u, v = spanning_links(np.concatenate(links_x), np.concatenate(links_y))
                    yield rows(0, u, v)
                    links_x, links_y, n = [], [], 0
        if n:
            u, v = spanning_links(np.concatenate(links_x), np.concatenate(links_y))
            yield rows(0, u, v)
    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id) of every row; component_id is the least vec_id reachable."""
    spark = vectors.sparkSession
    v = F.col("embedding")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))) | (F.size(v) == 0) \
        | ~F.exists(v, lambda x: x != 0)
    # rows are numbered, so that repeated and null ids stay separate rows
    rows = staged(vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"),
                                 F.col(vector_col).alias("embedding"))
                  .withColumn("usable", F.coalesce(~bad, F.lit(False))), "vectors")
    reps = staged(rows.where("usable").groupBy("embedding")
                  .agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("mult"), F.min("vec_id").alias("least"))
                  .select("rep", "embedding", "mult", "least"), "vector-reps")

    # pivots: a bounded number per vector length
    sizes = {r["dim"]: r["n"] for r in reps.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    pivots, per_block = {}, {}
    for dim, n in sizes.items():
        per_block[dim] = max(block_rows, -(-n // MAX_BLOCKS))
        k = max(1, min(MAX_PIVOTS, n // per_block[dim]))
        got = reps.where(F.size("embedding") == dim).orderBy(F.xxhash64("rep"), "rep").limit(k).select("embedding").collect()
        pivots[dim] = unit(np.asarray([r[0] for r in got]))
    counts = None
    if sizes:
        kind = reps.schema["embedding"].dataType.simpleString()
        cells = staged(reps.select("rep", "embedding", "mult").mapInArrow(_nearest(spark.sparkContext.broadcast(pivots)),
                                       f"rep long, embedding {kind}, mult long, dim int, cell int"), "vector-cells")
        limit = F.create_map(*[F.lit(x) for d, n in per_block.items() for x in (d, n)])
        subs = cells.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n")).select(
            "dim", "cell", F.ceil(F.col("n") / limit[F.col("dim")]).cast("int").alias("subs"))
        # at most MAX_PIVOTS rows per vector length
        blocks = cells.join(F.broadcast(subs), ["dim", "cell"]).withColumn(
            "sub", F.pmod(F.xxhash64("rep"), F.col("subs")).cast("int"))
        root = scratch(spark, "vector-tree-files")
        heads = staged(blocks.groupBy("dim", "cell", "sub").applyInPandas(
            _build(root), "dim int, block string, centre array<double>, radius double"), "vector-trees")
        directory = {}
        for dim, part in heads.toPandas().sort_values("block").groupby("dim"):     # at most MAX_BLOCKS + MAX_PIVOTS small rows a length
            directory[dim] = (part["block"].to_numpy(), np.stack(part["centre"].to_numpy()), part["radius"].to_numpy())
        reach = float(np.sqrt(max(0.0, 2.0 - 2.0 * threshold)))
        pairs = staged(heads.mapInPandas(_pairs(spark.sparkContext.broadcast(directory), reach),
                                         "tile string, left string, right string"), "vector-pairs")
        # small tables have few tiles: there, a pair is a task of its own
        n_pairs, tiles = pairs.agg(F.count(F.lit(1)), F.countDistinct("tile")).first()
        keys = ["tile"] if tiles >= 4 * spark.sparkContext.defaultParallelism else ["left", "right"]
        met = pairs.repartition(max(1, min(20_000, tiles if len(keys) == 1 else n_pairs // 4)), *keys) \
            .sortWithinPartitions("tile", "left", "right")
        out = staged(met.mapInArrow(_compare(root, threshold), "kind int, a long, b long"), "vector-links")
        remove(spark, root)
        member = connected_components(out.where("kind = 0").select(F.col("a").alias("u"), F.col("b").alias("v")))
        # per representative: links to others, and the least id of its component
        rooted = (reps.select("rep", "least").join(staged(member.withColumnRenamed("node", "rep"), "vector-member"), "rep", "left")
                  .select("rep", "least", F.coalesce("component", "rep").alias("root")))
        rooted = staged(rooted, "vector-rooted")
        least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        linked = staged(out.where("kind = 1").groupBy(F.col("a").alias("rep")).agg(F.sum("b").alias("linked")), "vector-linked")
        counts = staged(rooted.join(staged(least, "vector-least"), "root").select("rep", "component_id")
                        .join(linked, "rep", "left"), "vector-counts")
    if counts is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    copies = staged(reps.where("mult > 1").select("embedding", "rep", "mult"), "vector-copies")
    named = staged(rows.join(copies, (rows["embedding"] == copies["embedding"]) & rows["usable"], "left")
                   .select(rows["vec_id"], rows["usable"], F.coalesce("mult", F.lit(1)).alias("mult"),
                           F.when(rows["usable"], F.coalesce("rep", "row")).alias("rep")), "vector-named")
    return named.join(counts, "rep", "left").select(
        "vec_id", (F.coalesce("linked", F.lit(0)) + F.col("mult") - 1).cast("long").alias("n_links"),
        F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
