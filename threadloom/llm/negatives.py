"""Hard-negative mining: ball trees with branch and bound over integer inner products.

Rows are dealt into blocks and each block is a ball tree. A ball's centre and radius bound every inner product in it from
above and below, so a walk drops balls without a row of a wanted label, balls outside the query's window of scores, and
balls strictly beneath its k-th best so far. Blocks of anchors meet all trees, and the blocks' bests are merged.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .ann import matrix
from .common import stage

#: Rows of a tree, anchors that meet it at once, rows of a leaf, bytes of vectors of a tree at most.
ROWS, QUERIES, LEAF, BLOCK_BYTES = 16_384, 1_024, 64, 64 << 20
#: Beyond this bound of |q||x| a sum of products may not be exact in doubles; scores stop at the ends of a long.
EXACT, LONG = 2.0**52, (1 << 63) - 1


def inner(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of integers held as doubles, as long."""
    if not len(q) or not len(x):
        return np.zeros((len(q), len(x)), np.int64)
    largest = np.sqrt((q**2).sum(1).max()) * np.sqrt((x**2).sum(1).max())
    if largest < EXACT:
        return (q @ x.T).astype(np.int64)
    whole = lambda m: np.array([[int(v) for v in r] for r in m.tolist()], object)
    return np.array([[max(-LONG - 1, min(LONG, v)) for v in r] for r in whole(q).dot(whole(x).T).tolist()], np.int64)


class Tree:
    """A ball tree over rows (ids, labels, x): rows in the order of leaves, nodes level by level; node i has children 2i+1 and
    2i+2, all leaves are on the last level."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, leaf: int = LEAF):
        self.depth = max(0, int(np.ceil(np.log2(max(1, len(ids)) / leaf))))
        order, bounds = np.argsort(ids, kind="stable"), [0, len(ids)]
        for _ in range(self.depth):
            cut = []
            for lo, hi in zip(bounds, bounds[1:], strict=False):
                own = order[lo:hi]
                mid = (hi - lo) // 2
                if hi - lo > 1:  # along the line between two far rows; equal rows keep their order
                    v = x[own] / max(1.0, np.abs(x[own]).max())
                    far = v[((v - v[0]) ** 2).sum(1).argmax()]
                    other = v[((v - far) ** 2).sum(1).argmax()]
                    order[lo:hi] = own[np.argsort(v @ (other - far), kind="stable")]
                cut += [lo, lo + mid]
            bounds = [*cut, len(ids)]
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        self.bounds = np.array(bounds)
        self._balls()

    def _balls(self) -> None:
        """Centres, radii and labels of all nodes, from the rows in leaf order."""
        n = len(self.ids)
        names, own = np.unique(self.labels, return_inverse=True)
        self.names = names
        nodes = 2 ** (self.depth + 1) - 1
        width = self.x.shape[1]
        self.centre, self.radius, self.has = np.zeros((nodes, width)), np.zeros(nodes), np.zeros((nodes, len(names)), bool)
        for level in range(self.depth + 1):
            edges = self.bounds[:: 2 ** (self.depth - level)]
            for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
                at = 2**level - 1 + i
                if hi > lo:
                    self.centre[at] = self.x[lo:hi].mean(0)
                    self.radius[at] = np.sqrt(((self.x[lo:hi] - self.centre[at]) ** 2).sum(1).max())
                    self.has[at, own[lo:hi]] = True
        self.some = self.has.any(1) if n else np.zeros(nodes, bool)

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: getattr(self, k) for k in ("depth", "ids", "labels", "x", "bounds", "names", "centre", "radius", "has", "some")})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Tree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(data)) as z:
            for k in z.files:
                setattr(tree, k, z[k])
        tree.depth = int(tree.depth)
        return tree

    def search(self, q: np.ndarray, q_ids: np.ndarray, q_labels: np.ndarray, same: bool, k: int, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, score) of each query's k best rows: of its own label if `same`, else of another; not of its own id;
        with a score from low to high; ties to the smaller id.

        A wave opens each query's next leaves by upper bound, twice as many each time; after it the walk from the root
        begins again with the better k-th score."""
        many = len(q)
        best = np.full((many, k), -np.inf)
        best_id, best_row = np.full((many, k), np.iinfo(np.int64).max), np.full((many, k), -1)
        score = np.zeros((many, k), np.int64)
        length = np.sqrt((q**2).sum(1))
        place = np.searchsorted(self.names, q_labels)
        known = (place < len(self.names)) & (self.names[np.minimum(place, len(self.names) - 1)] == q_labels) if len(self.names) else np.zeros(many, bool)
        place = np.where(known, place, 0)
        leaves = 2**self.depth
        done = np.zeros((many, leaves), bool)
        others = self.has.sum(1)
        wave = 1

        def bound(rows: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            mid, spread = q[rows] @ self.centre[nodes].T, length[rows, None] * self.radius[nodes]
            slack = 1e-9 * length[rows, None] * (np.sqrt((self.centre[nodes] ** 2).sum(1)) + self.radius[nodes]) + 1e-6
            return np.minimum(mid - spread - slack, LONG), np.maximum(mid + spread + slack, -LONG - 1)  # as scores stop

        left = np.arange(many)
        while len(left) and len(self.ids):
            live = np.ones((len(left), 1), bool)
            for level in range(self.depth + 1):
                nodes = np.arange(2**level - 1, 2 ** (level + 1) - 1)
                if level:
                    live = np.repeat(live, 2, axis=1)
                own = self.has[nodes][:, place[left]].T & known[left, None] if len(self.names) else np.zeros(live.shape, bool)
                live &= own if same else others[nodes] - own > 0
                below, above = bound(left, nodes)
                live &= (above >= low[left, None]) & (below <= high[left, None]) & (above >= best[left, -1][:, None])
            live &= ~done[left]
            more = live.any(1)
            left, live, above = left[more], live[more], above[more]
            if not len(left):
                break
            above = np.where(live, above, -np.inf)
            take = min(wave, leaves)
            first = np.argpartition(-above, take - 1, axis=1)[:, :take] if take < leaves else np.tile(np.arange(leaves), (len(left), 1))
            open_ = np.zeros_like(live)
            np.put_along_axis(open_, first, True, axis=1)
            open_ &= live
            done[left] |= open_
            for leaf in np.flatnonzero(open_.any(0)):
                lo, hi = self.bounds[leaf], self.bounds[leaf + 1]
                rows = left[open_[:, leaf]]
                found = inner(q[rows], self.x[lo:hi])
                fits = (self.labels[lo:hi] == q_labels[rows, None]) == same
                fits &= (self.ids[lo:hi] != q_ids[rows, None]) & (found >= low[rows, None]) & (found <= high[rows, None]) & (found >= best[rows, -1][:, None])
                some = fits.any(1)
                if not some.any():
                    continue
                rows, found, fits = rows[some], found[some], fits[some]
                value = np.concatenate((best[rows], np.where(fits, found, -np.inf)), axis=1)
                exact = np.concatenate((score[rows], found), axis=1)
                ids = np.concatenate((best_id[rows], np.broadcast_to(self.ids[lo:hi], found.shape)), axis=1)
                at = np.concatenate((best_row[rows], np.broadcast_to(np.arange(lo, hi), found.shape)), axis=1)
                order = np.lexsort((ids, -np.where(value > -np.inf, exact, 0), value == -np.inf), axis=1)[:, :k]
                best[rows], score[rows], best_id[rows], best_row[rows] = (np.take_along_axis(m, order, axis=1) for m in (value, exact, ids, at))
            wave *= 2
        asked, column = np.nonzero(best > -np.inf)
        return asked, best_row[asked, column], score[asked, column]


def integers(vectors: DataFrame, scale: float = 256.0, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, v: rows that take part, components scaled and floored, as doubles."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(fine)
    return rows.withColumn("v", F.transform("v", lambda x: _floor(x * F.lit(scale))))


def _floor(x: Column) -> Column:
    """The largest whole double not above x; beyond 2^52 every double is whole."""
    return F.when(F.abs(x) < F.lit(2.0**52), F.floor(x).cast("double")).otherwise(x)


TREES = "block int, tree binary"


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0, id_col: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (a condition on vec_id) and
    each of its best rows of the same label, the best rows of another label whose score is low to high percent of the
    positive's; best first, ties to the smaller id.

    Rows without id, label or vector, or with a null or non-finite component, take no part; vectors of zeros do. Vectors of
    different lengths meet as if they ended in zeros. Repeated rows are one; rows of the anchor's id are never its own
    positives or negatives. Scores beyond a long stop at its ends. An empty table, or one without anchors, gives no rows.
    Other columns are ignored. Every row is in a tree and every anchor asks each; a block's answers are a few rows an
    anchor, cut again before they are shuffled."""
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = stage(integers(vectors, scale, id_col, vector, label).distinct().withColumn("key", F.xxhash64("vec_id", "label", "v")), "rows")
    n, width, asked = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.count_if(is_anchor)).first()
    if not n or not asked:
        return spark.createDataFrame([], schema)
    per = max(1, min(ROWS, BLOCK_BYTES // (8 * max(1, width))))
    blocks, parts = -(-n // per), -(-asked // QUERIES)

    def build(block: tuple, table: pa.Table) -> pa.Table:
        tree = Tree(table.column("vec_id").to_numpy(), table.column("label").to_numpy(), matrix(table.column("v"), width))
        return pa.table({"block": pa.array([block[0].as_py()], pa.int32()), "tree": pa.array([tree.dump()], pa.binary())})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", F.lit("block")), F.lit(blocks)).cast("int"))
    trees = stage(dealt.groupBy("block").applyInArrow(build, TREES), "trees")
    anchors = stage(rows.where(is_anchor).withColumn("part", F.pmod(F.xxhash64("key", F.lit("part")), F.lit(parts)).cast("int")), "anchors")
    met = trees.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def ask(same: bool, k: int, out: str):
        """Answers of one tree to one part of the queries; a query has its window in from_ and to_."""

        def run(trees: pa.Table, queries: pa.Table) -> pa.Table:
            names = [f.split()[0] for f in out.split(", ")]
            if not trees.num_rows or not queries.num_rows:
                return pa.table({c: pa.array([], pa.int64()) for c in names})
            tree = Tree.load(trees.column("tree")[0].as_py())
            number = lambda c: queries.column(c).to_numpy()
            asked, row, score = tree.search(matrix(queries.column("v"), width), number("vec_id"), number("label"), same, k, number("from_"), number("to_"))
            got = {"key": number("key")[asked], "place": number("place")[asked], "found_id": tree.ids[row], "score": score}
            return pa.table({c: pa.array(got[c], pa.int64()) for c in names})

        return run

    def answers(queries: DataFrame, same: bool, k: int) -> DataFrame:
        """key, place, found_id, score, rank: the best of all trees' answers."""
        out = "key long, place long, found_id long, score long"
        given = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        each = met.groupBy("block", "part").cogroup(given.groupBy("block", "part")).applyInArrow(ask(same, k, out), out)
        best = Window.partitionBy("key", "place").orderBy(F.col("score").desc(), "found_id")
        return each.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    every = anchors.withColumns({"place": F.lit(0).cast("long"), "from_": F.lit(-LONG - 1), "to_": F.lit(LONG)})
    found = answers(every, True, positives).select("key", F.col("rank").cast("long").alias("place"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = stage(found, "positives")
    # whole scores s with low * p <= 100 * s <= high * p, hundreds and rest of p apart, so that no product passes a long; for p < 0 there are none
    part = lambda percent, up: F.expr(f"{percent} * (positive_score div 100) + ({percent} * (positive_score % 100) + {up}) div 100")
    windows = found.where("positive_score >= 0").join(anchors, "key").withColumns({"from_": part(low, 99), "to_": part(high, 0)}).where("from_ <= to_")
    best = answers(windows.select("key", "part", "vec_id", "label", "v", "place", "from_", "to_"), False, negatives)
    names = anchors.select("key", F.col("vec_id").alias("anchor_id"))
    return best.join(found, ["key", "place"]).join(names, "key").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


OP12_SQL = """
with r as (select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.vec_id as anchor_id, a.label as anchor_label, b.vec_id as other_id, b.label, list_dot_product(a.v, b.v)::bigint as score from r a join r b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
p as (select anchor_id, other_id as positive_id, score as positive_score from s where label = anchor_label qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, other_id)::int as rank, other_id as negative_id, positive_score, score as negative_score
from p join s using (anchor_id) where label <> anchor_label and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3
"""
