"""Approximate maximum-inner-product search: anisotropic product quantisation, 4-bit table scans, exact reranking.

Vectors are scaled by their largest component, and each pair of dimensions is quantised to one of 16 centres. Codebooks and codes
minimise a score-aware loss that weighs the residual's part parallel to the vector more than its orthogonal part, since the parallel
part is what shifts large inner products. A query is turned into tables of partial products; a scan sums table entries, two
4-bit codes a byte, and the best of every block are scored exactly on the original vectors.

With each code goes the norm of the vector's residual. The error of a sum is the product of a query with a residual, and over queries of
no special direction it has a standard deviation of both norms' product over the root of the dimension. First the ``keep`` rows of the
greatest sums are scored exactly; then every row whose sum comes within ``DEVIATIONS`` such deviations of the ``k``-th best score so far. So
as many rows are reranked as the codes leave in doubt (a row within 60 degrees of the query is no random direction: there the bound is both norms' product itself): few of a block where scores are spread, all of a group of near copies, whose codes are equal.

The codebooks are fitted on a bounded sample; every row is encoded and scanned. Rows are dealt into blocks and queries
into chunks, both of bounded size, and each task scans one block for one chunk, so no task grows with the input.
Each block passes on its ``k`` best of a query, whose exact scores then decide between blocks. Vectors travel with the codes, once for each chunk
of queries, as a group of near copies may need the exact scores of any share of all rows; so what is shuffled is the table times
its queries over ``chunk_rows``, and the queries times the blocks.

Edge cases: vectors that are null, zero, of a null or non-finite component, or of another length than most take
no part, nor do rows with a null id; all rows with the query's own id are left out of its result; of a query id that stands with several vectors the
smallest vector asks; of equal vectors in a block only the ``k`` + 1 of smallest id are scanned, which loses nothing, as ties go to the smaller
id; repeated rows are candidates each; with fewer candidates than ``k`` all are returned; very long vectors take time in proportion to their length,
and the fit to its cube, so more than 2,048 components are refused; an empty table gives no rows; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tailframe.llm.common import bounded_sample

CENTRES, PER = 16, 2
#: How many standard deviations of its error a row's sum may fall short of the k-th score and still be scored exactly.
DEVIATIONS = 3.0


@dataclass(frozen=True)
class AnisotropicCodes:
    """Codebooks (subspaces x CENTRES x PER) and the weight of the parallel residual relative to the orthogonal."""

    books: np.ndarray
    eta: float

    @classmethod
    def fit(cls, x: np.ndarray, threshold: float = 0.2, rounds: int = 4, seed: int = 0) -> AnisotropicCodes:
        x = _padded(np.asarray(x, np.float32))
        n, d = x.shape
        m = d // PER
        rng = np.random.default_rng(seed)
        eta = max(1.0, (d - 1) * threshold**2 / (1 - threshold**2))
        parts = x.reshape(n, m, PER)
        books = np.stack([_k_means(parts[:, s], rng) for s in range(m)])
        for _ in range(rounds):
            fitted = cls(books, eta)
            codes = fitted._assign(x)
            u = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).reshape(n, m, PER)
            # Closed form of all centres at once: h_o sum(B'B) + (h_p - h_o) sum((B'u)(B'u)'), against h_p sum(B'x).
            size = m * CENTRES * PER
            a, b = np.zeros((size, size)), np.zeros(size)
            at = ((np.arange(m) * CENTRES + codes) * PER)[:, :, None] + np.arange(PER)
            for start in range(0, n, 2048):
                part = slice(start, start + 2048)
                z = np.zeros((len(at[part]), size), np.float32)
                np.put_along_axis(z, at[part].reshape(len(z), -1), u[part].reshape(len(z), -1), axis=1)
                a += (eta - 1) * (z.T @ z)
            flat = at.reshape(-1)
            a[np.diag_indices(size)] += np.bincount(flat, minlength=size) + 1e-6
            b += eta * np.bincount(flat, weights=parts.reshape(-1).astype(float), minlength=size) + 1e-6 * books.reshape(-1)
            books = np.linalg.solve(a, b).reshape(m, CENTRES, PER).astype(np.float32)
        return cls(books, eta)

    def _assign(self, x: np.ndarray, sweeps: int = 3) -> np.ndarray:
        """Codes by coordinate descent on the anisotropic loss, from the nearest centres."""
        n, m = len(x), len(self.books)
        parts = x.reshape(n, m, PER)
        u = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).reshape(n, m, PER)
        codes = np.empty((n, m), np.int64)
        along = np.empty((n, m), np.float32)  # each subspace's part of the parallel residual
        for s in range(m):
            residual = parts[:, s, None] - self.books[s]
            codes[:, s] = (residual**2).sum(2).argmin(1)
            along[:, s] = ((parts[:, s] - self.books[s][codes[:, s]]) * u[:, s]).sum(1)
        total = along.sum(1)
        for _ in range(sweeps):
            for s in range(m):
                residual = parts[:, s, None] - self.books[s]
                own = np.einsum("ncp,np->nc", residual, u[:, s])
                rest = (total - along[:, s])[:, None]
                best = ((residual**2).sum(2) + (self.eta - 1) * (rest + own) ** 2).argmin(1)
                codes[:, s] = best
                total -= along[:, s]
                along[:, s] = own[np.arange(n), best]
                total += along[:, s]
        return codes

    def encode(self, x: np.ndarray) -> np.ndarray:
        """Two codes a byte."""
        codes = self._assign(_padded(np.asarray(x, np.float32)))
        if codes.shape[1] % 2:
            codes = np.pad(codes, ((0, 0), (0, 1)))
        return (codes[:, ::2] * CENTRES + codes[:, 1::2]).astype(np.uint8)

    def residuals(self, x: np.ndarray, packed: np.ndarray) -> np.ndarray:
        """Norms of what the codes leave out."""
        x = _padded(np.asarray(x, np.float64))
        at = np.stack([packed // CENTRES, packed % CENTRES], axis=2).reshape(len(x), -1)[:, : len(self.books)]
        back = self.books[np.arange(len(self.books)), at].reshape(x.shape).astype(float)
        return np.linalg.norm(x - back, axis=1)

    def scan(self, queries: np.ndarray, packed: np.ndarray) -> np.ndarray:
        """Approximate inner products, queries x rows, by one table of 256 sums for each byte of the codes."""
        q = _padded(np.asarray(queries, np.float32))
        tables = np.einsum("qmp,mcp->qmc", q.reshape(len(q), -1, PER), self.books)
        if tables.shape[1] % 2:
            tables = np.pad(tables, ((0, 0), (0, 1), (0, 0)))
        pairs = (tables[:, ::2, :, None] + tables[:, 1::2, None, :]).reshape(len(q), -1, CENTRES * CENTRES)
        total = np.zeros((len(q), len(packed)), np.float32)
        for byte in range(packed.shape[1]):
            total += np.take(pairs[:, byte], packed[:, byte], axis=1)
        return total


def _padded(x: np.ndarray) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, -x.shape[1] % PER)))


def _k_means(x: np.ndarray, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), CENTRES, replace=len(x) < CENTRES)].astype(np.float32)
    for _ in range(rounds):
        near = ((x[:, None] - centres) ** 2).sum(2).argmin(1)
        n = np.bincount(near, minlength=CENTRES)
        for p in range(x.shape[1]):
            sums = np.bincount(near, weights=x[:, p], minlength=CENTRES)
            centres[n > 0, p] = (sums[n > 0] / n[n > 0]).astype(np.float32)
    return centres


def _matrix(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), kind).reshape(len(column), -1)


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows over their largest component, which float32 holds whatever they were, and that component."""
    size = np.abs(x).max(axis=1, keepdims=True)
    return (x / size).astype(np.float32), size[:, 0]


def _scan_block(codes: AnisotropicCodes, k: int, keep: int, vectors: pa.Table, queries: pa.Table, schema: pa.Schema) -> pa.Table:
    if not len(vectors) or not len(queries):
        return schema.empty_table()
    vectors = vectors.sort_by("vec_id")
    ids, x = vectors.column("vec_id").to_numpy(), _matrix(vectors.column("embedding"), np.float64)
    packed = np.frombuffer(b"".join(vectors.column("code").to_pylist()), np.uint8).reshape(len(ids), -1)
    # Of equal vectors, those of the smallest ids; the order by id is kept throughout.
    same = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_inverse=True)[1].ravel()
    order = np.argsort(same, kind="stable")
    starts = np.flatnonzero(np.r_[True, same[order][1:] != same[order][:-1]])
    place = np.arange(len(ids)) - np.repeat(starts, np.diff(np.r_[starts, len(ids)]))
    kept = np.sort(order[place <= k])
    ids, x, packed = ids[kept], x[kept], packed[kept]
    sizes, norms = np.abs(x).max(axis=1), np.linalg.norm(x, axis=1)
    most = vectors.column("residual").to_numpy()[kept] * sizes + 1e-5 * norms
    doubt = DEVIATIONS * most / np.sqrt(x.shape[1])
    out = []
    own_ids, own = queries.column("vec_id").to_numpy(), _matrix(queries.column("embedding"), np.float64)
    n = min(keep, len(ids))
    for start in range(0, len(own_ids), 32):
        q = own[start : start + 32]
        scaled, scale = _scaled(q)
        rough_all = codes.scan(scaled, packed)
        for i, query in enumerate(own_ids[start : start + 32]):
            rough = rough_all[i] * (sizes * scale[i])
            other = ids != query
            rough[~other] = -np.inf
            near = np.argpartition(-rough, n - 1)[:n] if n < len(ids) else np.arange(len(ids))
            exact = np.where(other[near], x[near] @ q[i], -np.inf)
            least = np.partition(exact, n - k)[n - k] if n >= k else -np.inf
            # Not below, rather than above: sums that are not finite stay in.
            length = np.linalg.norm(q[i])
            alike = 2 * rough > norms * length
            open_ = np.flatnonzero(~(rough + np.where(alike, most, doubt) * length < least) & other)
            open_ = np.union1d(open_, near[other[near]])
            score = np.einsum("d,nd->n", q[i], x[open_])  # summed in one order, so that equal vectors tie
            best = np.argsort(-score, kind="stable")[:k]
            out.append((np.full(len(best), query), ids[open_[best]], score[best]))
    return pa.table([pa.array(np.concatenate(c)) for c in zip(*out)], schema=schema)


def search(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", sample_rows: int = 8_192, keep: int = 160, block_rows: int = 32_768, chunk_rows: int = 32_768) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of greatest inner product found for each query row.

    ``sample_rows`` bounds what the codebooks are fitted on; ``keep`` is how many of a block are scored
    exactly first, for the score that the rest must come near; ``block_rows`` and ``chunk_rows`` bound the rows and queries of a task.
    """
    spark = rows.sparkSession
    result = T.StructType([T.StructField("query_id", T.LongType()), T.StructField("rank", T.IntegerType()), T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType())])
    valid = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"), is_query.alias("_query")).where(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    lengths = valid.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not lengths:
        return spark.createDataFrame([], result)
    d, n = lengths[0]["d"], lengths[0]["n"]
    valid = valid.where(F.size("embedding") == d)
    sample = bounded_sample(valid, "vec_id", sample_rows).select("vec_id", "embedding").toArrow().sort_by("vec_id")
    if d > 2_048:
        raise ValueError(f"vectors of {d} components; at most 2,048 are supported")
    codes = AnisotropicCodes.fit(_scaled(_matrix(sample.column("embedding"), np.float64))[0])
    shared = spark.sparkContext.broadcast(codes)

    def add_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4_096):
                part = batch.slice(start, 4_096)
                x, _ = _scaled(_matrix(part.column(1), np.float64))
                code = shared.value.encode(x)
                new = [pa.array([r.tobytes() for r in code], pa.binary()), pa.array(shared.value.residuals(x, code), pa.float64())]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, "code", "residual"])

    light = valid.select("vec_id", "embedding")
    encoded = light.mapInArrow(add_codes, T.StructType([*light.schema.fields, T.StructField("code", T.BinaryType()), T.StructField("residual", T.DoubleType())]))
    asked = valid.where("_query").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    n_asked = asked.count()
    blocks = max(1, -(-n // min(block_rows, max(1_024, n // 12))))
    chunks = max(1, -(-n_asked // chunk_rows))
    deal = lambda name, parts: F.pmod(F.xxhash64(F.lit(name), "vec_id"), F.lit(parts)).cast("int")
    all_of = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = encoded.withColumn("block", deal("block", blocks)).withColumn("chunk", all_of(chunks))
    right = asked.withColumn("chunk", deal("chunk", chunks)).withColumn("block", all_of(blocks))
    schema = T.StructType([result["query_id"], result["vec_id"], result["score"]])
    arrow = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    near = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(lambda v, q: _scan_block(shared.value, k, keep, v, q, arrow), schema)
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select(*result.names)
