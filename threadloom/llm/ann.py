"""Maximum inner product search: score-aware (anisotropic) four-bit quantisation, table scans, exact reranking.

Each pair of dimensions is a subspace with 16 centres, so a vector is half a byte a pair. Centres and codes minimise a
residual whose part along the vector counts `eta` times the rest, as errors there shift the largest inner products most.
Every row is indexed. A query's table of inner products with all centres is summed over the codes of a block of rows, the
best of the scan (and all within its error of the k-th) are reranked exactly, and the blocks' bests are merged.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stage

#: Rows and queries that meet in one task; rows a codebook is fitted on; passes of the fit; least rows reranked a block.
ROWS, QUERIES, SAMPLE, PASSES, RERANK = 16_384, 2_048, 10_000, 8, 100


def usable(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, v (array of double) of the rows that take part: an id, and a vector that isn't null, zero or holds a null or
    non-finite component."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(fine & F.exists("v", lambda x: x != 0))


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Arrays of double as rows of a matrix, short ones ending in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(np.asarray(column.offsets))
    values = column.flatten().to_numpy()
    if len(sizes) and (sizes == width).all():
        return values.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


class Codebook:
    """Centres (subspaces, 16, 2) and the weight of residuals along the vector."""

    def __init__(self, x: np.ndarray, threshold: float = 0.2, passes: int = PASSES):
        d = x.shape[1]
        self.width = d + d % 2
        self.eta = max(1.0, (d - 1) * threshold**2 / (1 - threshold**2))
        sub, u = self._split(x)
        rng = np.random.default_rng(7)
        picks = rng.integers(0, len(x), (sub.shape[1], 16))
        self.centres = np.stack([sub[picks[m], m] for m in range(sub.shape[1])]) if len(x) else np.zeros((sub.shape[1], 16, 2))
        if len(x):
            codes = self._assign(sub, u, np.zeros(sub.shape[:2], np.uint8), first=True)
            for _ in range(passes):
                codes = self._assign(sub, u, codes, learn=True)

    def _split(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if x.shape[1] < self.width:
            x = np.pad(x, ((0, 0), (0, self.width - x.shape[1])))
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return x.reshape(len(x), -1, 2), unit.reshape(len(x), -1, 2)

    def _assign(self, sub: np.ndarray, u: np.ndarray, codes: np.ndarray, first: bool = False, learn: bool = False) -> np.ndarray:
        """One pass over the subspaces: each code is the best given the others; with learn, centres follow their members."""
        extra = self.eta - 1
        at = np.arange(len(sub))
        along = np.zeros(len(sub)) if first else sum(((sub[:, m] - self.centres[m, codes[:, m]]) * u[:, m]).sum(1) for m in range(sub.shape[1]))
        codes = codes.copy()
        for m in range(sub.shape[1]):
            x, v, c = sub[:, m], u[:, m], self.centres[m]
            if not first:
                along = along - ((x - c[codes[:, m]]) * v).sum(1)
            r = x[:, None, :] - c[None]
            codes[:, m] = ((r**2).sum(2) + extra * (along[:, None] + (r * v[:, None, :]).sum(2)) ** 2).argmin(1)
            if learn:
                k = codes[:, m]
                w = extra * (along + (x * v).sum(1))
                total = lambda y: np.bincount(k, y, minlength=16)
                a = np.array([[total(np.ones(len(x))) + extra * total(v[:, 0] ** 2), extra * total(v[:, 0] * v[:, 1])], [extra * total(v[:, 0] * v[:, 1]), total(np.ones(len(x))) + extra * total(v[:, 1] ** 2)]]).transpose(2, 0, 1)
                b = np.stack([total(x[:, i] + w * v[:, i]) for i in range(2)], axis=1)
                used = np.bincount(k, minlength=16) > 0
                self.centres[m, used] = np.linalg.solve(a[used], b[used][:, :, None])[:, :, 0]
            along = along + ((x - self.centres[m, codes[at, m]]) * v).sum(1)
        return codes

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Codes as bytes, a pair of subspaces each."""
        sub, u = self._split(x)
        codes = self._assign(sub, u, np.zeros(sub.shape[:2], np.uint8), first=True)
        codes = self._assign(sub, u, codes)
        if codes.shape[1] % 2:
            codes = np.pad(codes, ((0, 0), (0, 1)))
        return codes[:, ::2] | codes[:, 1::2] << 4

    def tables(self, q: np.ndarray) -> np.ndarray:
        """(queries, bytes, 256): each query's inner products with both centres of every byte."""
        sub, _ = self._split(q)
        t = np.einsum("qmi,mki->qmk", sub, self.centres)
        if t.shape[1] % 2:
            t = np.pad(t, ((0, 0), (0, 1), (0, 0)))
        return (t[:, ::2, None, :] + t[:, 1::2, :, None]).reshape(len(q), t.shape[1] // 2, 256).astype(np.float32)

    def residual(self, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        low, high = codes & 15, codes >> 4
        each = np.stack((low, high), axis=2).reshape(len(x), -1)[:, : len(self.centres)]
        return np.linalg.norm((self._split(x)[0] - self.centres[np.arange(len(self.centres)), each]).reshape(len(x), -1), axis=1)


def scan(book: Codebook, ids: np.ndarray, x: np.ndarray, codes: np.ndarray, q_ids: np.ndarray, q: np.ndarray, k: int, rerank: int = RERANK) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the places and exact scores of its k best rows of the block, its own id aside."""
    out = []
    margin = 2 * np.sqrt((book.residual(x, codes) ** 2).mean() / x.shape[1]) if len(x) else 0.0
    for i in range(0, len(q), 64):
        table = book.tables(q[i : i + 64])
        rough = np.zeros((len(table), len(ids)), np.float32)
        for b in range(codes.shape[1]):
            rough += table[:, b][:, codes[:, b]]
        for j, row in enumerate(rough):
            row[ids == q_ids[i + j]] = -np.inf
            if len(row) > rerank:
                top = np.partition(row, len(row) - rerank)
                kth = np.sort(top[len(row) - rerank :])[-min(k, rerank)]
                near = np.flatnonzero(row >= min(top[len(row) - rerank], kth - margin * np.linalg.norm(q[i + j])))
            else:
                near = np.arange(len(row))
            near = near[row[near] > -np.inf]
            exact = np.einsum("ij,j->i", x[near], q[i + j])
            best = np.lexsort((ids[near], -exact))[:k]
            out.append((near[best], exact[best]))
    return out


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for every row that is_query picks (a condition on vec_id) its k rows of largest inner
    product, best first, ties to the smaller id; all candidates if fewer.

    Rows with the query's id are its own and no candidates. Null, zero and non-finite vectors and null ids take no part;
    vectors of different lengths meet as if they ended in zeros. Repeated rows are one. Other columns are ignored. The
    query set meets all rows in blocks of ROWS x QUERIES; the codebook is fitted on SAMPLE rows drawn by hash of id."""
    spark = vectors.sparkSession
    rows = stage(usable(vectors, id_col, vector).distinct(), "vectors")
    size = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0)), F.count_if(is_query)).first()
    n, width, asked = size
    schema = "query_id long, rank int, vec_id long, score double"
    if not n or not asked:
        return spark.createDataFrame([], schema)
    drawn = rows.where(F.pmod(F.xxhash64("vec_id", F.lit("fit")), F.lit(1 << 30)) < int(min(1.0, SAMPLE / n) * (1 << 30))) if n > SAMPLE else rows
    fitted = drawn.orderBy("vec_id").limit(2 * SAMPLE).toArrow()
    book = Codebook(matrix(fitted.column("v"), width))
    shared = spark.sparkContext.broadcast(book)

    def index(batches):
        own = shared.value
        for b in batches:
            codes = own.encode(matrix(b.column(1), width))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([c.tobytes() for c in codes], pa.binary())], ["vec_id", "v", "codes"])

    indexed = stage(rows.mapInArrow(index, "vec_id long, v array<double>, codes binary"), "index")
    row_blocks, query_blocks = -(-n // ROWS), -(-asked // QUERIES)
    spread = lambda salt, blocks: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(blocks)).cast("int")
    left = indexed.select("vec_id", "v", "codes", spread("row", row_blocks).alias("rb"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"))
    right = indexed.where(is_query).select("vec_id", "v", spread("query", query_blocks).alias("qb"), F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("rb"))

    def meet(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return pa.table({c: pa.array([], t) for c, t in (("query_id", pa.int64()), ("place", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()))})
        ids = rows.column("vec_id").to_numpy()
        x = matrix(rows.column("v"), width)
        codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8).reshape(len(ids), -1)
        q_ids = queries.column("vec_id").to_numpy()
        q = matrix(queries.column("v"), width)
        found = scan(shared.value, ids, x, codes, q_ids, q, k)
        counts = [len(p) for p, _ in found]
        place = [zlib.crc32(v.tobytes()) for v in q]  # vectors of one id stay apart
        places = np.concatenate([p for p, _ in found])
        return pa.table({"query_id": np.repeat(q_ids, counts), "place": np.repeat(np.array(place, np.int64), counts), "vec_id": ids[places], "score": np.concatenate([s for _, s in found])})

    met = left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb")).applyInArrow(meet, "query_id long, place long, vec_id long, score double")
    by = Window.partitionBy("query_id", "place").orderBy(F.col("score").desc(), "vec_id")
    best = met.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
