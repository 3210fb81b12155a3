"""Nearest neighbours by cosine: inverted file of coarse cells, product-quantised residuals, exact reranking.

Fit, on at most SAMPLE vectors taken by hash: coarse centroids (k-means of unit vectors, about the square root of the
number of rows, CELLS at most), and a codebook for each of PARTS slices of the residuals. Every vector is indexed: its
cell, one byte a slice, and what its cell and code add to any distance. A query visits the nearest cells until it has seen
`probes` cells (measured on the sample) and LEAST_ROWS rows. Distances are sums of entries of the query's asymmetric
table; the best RERANK over all its cells are measured exactly, in double precision on the original vectors, and the best
k stay.

Cells are packed into shards of SHARD rows, a larger cell into several, and the queries of a shard into blocks, so a cell
that holds a third of all vectors is many small products, and no row is left out. Only codes, 52 bytes a row, go to the
shards; vectors are read again for the best RERANK alone. Only centroids, codebooks and counts by cell are broadcast; CELLS
and the sample bound them.

Vectors take no part if they are null, empty, all zero, or hold a null or a component that isn't finite, or if their
vec_id is null. Every other row is a vector of its own, also where its vec_id or all of it is repeated: a query's
candidates are all rows but its own. Cosine is defined between vectors of one length, so each length is a space of its
own: the commonest one, and all of more than SMALL rows, are indexed; others are compared exactly, a length in a task. Ties
go to the smaller vec_id. With fewer than k candidates all are returned; an empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from ._graph import written
from ._text import column_of

#: Vectors that the centroids and codebooks are fitted on, at most, and their bytes as doubles.
SAMPLE, SAMPLE_BYTES = 16_384, 1 << 25
CELLS = 4096
PARTS, CODES = 32, 256
#: Cells that a query visits at least, and rows. How many more the data need is measured when the index is fitted: so
#: many that of PROBED queries of the sample, TARGET of the nearest in the sample lie in the cells visited. Clustered
#: vectors need few; vectors without structure need a large share, which no coarse quantiser can spare.
PROBES, LEAST_ROWS = 8, 4096
PROBED, TARGET = 256, 0.97
RERANK = 32
#: Rows of a shard of cells, and queries of a block.
SHARD, QUERY_BLOCK = 1 << 15, 2048
#: Rows up to which a space that isn't the commonest is compared exactly.
SMALL = 4096


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """k centroids of the rows of x; ones that lose all rows move to rows far from their own."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=len(x) < k)].astype(np.float32)
    for _ in range(rounds):
        near, far = nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        n = np.bincount(near, minlength=k)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], x[np.argsort(-far, kind="stable")[np.arange(k) % len(x)]]).astype(np.float32)
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest centroid of each row, in steps of bounded memory."""
    near, far, norm = np.empty(len(x), np.int64), np.empty(len(x), np.float32), (c * c).sum(1)
    step = max(1, (1 << 22) // len(c))
    for a in range(0, len(x), step):
        d = norm - 2 * (x[a : a + step] @ c.T)
        near[a : a + step] = d.argmin(1)
        far[a : a + step] = d.min(1)
    return near, far + (x * x).sum(1)


class Index:
    """Coarse centroids and residual codebooks, fitted on unit vectors."""

    def __init__(self, sample: np.ndarray, rows: int):
        n, self.dim = sample.shape
        self.width = -(-self.dim // PARTS)  # of a slice; the last ones are padded
        self.cells = kmeans(sample, max(1, min(CELLS, round(rows**0.5), n // 4)), 10, 1)
        self.norms = (self.cells * self.cells).sum(1)
        residual = self.sliced(sample - self.cells[nearest(sample, self.cells)[0]])
        self.probes = self._probes(sample)
        self.books = np.stack([kmeans(residual[:, m], min(CODES, n), 6, 2 + m) for m in range(PARTS)])

    def _probes(self, sample: np.ndarray) -> int:
        """Cells to visit for TARGET of the 5 nearest of the first PROBED vectors of the sample."""
        ask = sample[:PROBED]
        near = ask @ sample.T
        near[np.arange(len(ask)), np.arange(len(ask))] = -2
        top = np.argsort(-near, axis=1, kind="stable")[:, :5]
        place = np.argsort(self.order(ask), axis=1)
        ranks = np.take_along_axis(place, nearest(sample, self.cells)[0][top], 1)
        return max(PROBES, int(np.quantile(ranks, TARGET, method="higher")) + 1)

    def order(self, unit: np.ndarray) -> np.ndarray:
        """All cells from the nearest on, for each vector."""
        return np.argsort(self.norms - 2 * (unit @ self.cells.T), axis=1, kind="stable")

    def sliced(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), PARTS * self.width), np.float32)
        out[:, : self.dim] = x
        return out.reshape(len(x), PARTS, self.width)

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, code, and the part of a distance that doesn't depend on the query, of each vector."""
        cell = nearest(unit, self.cells)[0]
        center = self.sliced(self.cells[cell])
        r = self.sliced(unit) - center
        code = np.stack([nearest(r[:, m], self.books[m])[0] for m in range(PARTS)], 1)
        word = self.books[np.arange(PARTS)[None], code]
        # |q - c - b|^2 = |q - c|^2 + (|b|^2 + 2 c b) - 2 q b
        return cell, code.astype(np.uint8), (word * (word + 2 * center)).sum((1, 2)).astype(np.float32)

    def tables(self, unit: np.ndarray) -> np.ndarray:
        """What each code of each slice adds to a query's distances: queries x PARTS x codes."""
        return -2 * np.einsum("qmd,mcd->qmc", self.sliced(unit), self.books, optimize=True).astype(np.float32)


def unit_rows(x: np.ndarray) -> np.ndarray:
    """float32 unit vectors; the largest component is divided out first, so neither end of doubles is met."""
    x = x / np.abs(x).max(1)[:, None]
    return (x / np.sqrt((x * x).sum(1))[:, None]).astype(np.float32)


def vectors(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of each row of x and that of y, in double precision; far ends of doubles are scaled away first."""
    x, y = (np.where(((m := np.abs(z).max(1)) < 1e-100)[:, None] | (m > 1e100)[:, None], z / m[:, None], z) for z in (x, y))
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def proper(embeddings: DataFrame) -> DataFrame:
    """row (a number of its own), vec_id (long), v (floats, or doubles) and d, its length, of the rows that take part; written."""
    kind = "array<float>" if embeddings.schema["embedding"].dataType == ArrayType(FloatType()) else "array<double>"
    v = F.col("embedding").cast(kind)
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(row, row + b.num_rows)), *b.columns], ["row", "vec_id", "v"])
            row += b.num_rows

    # numbers hold once they are written
    return written(rows.where(F.exists("v", lambda x: x != 0)).mapInArrow(number, f"row long, vec_id long, v {kind}").withColumn("d", F.size("v")))


PAIRS = "query long, row long, far float"


def search(embeddings: DataFrame, every: int = 50, k: int = 5, rerank: int = RERANK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each vector whose vec_id is divisible by `every`."""
    base = proper(embeddings)
    spaces = base.groupBy("d").agg(F.count("*").alias("rows"))
    first = spaces.orderBy(F.desc("rows"), "d").first()
    if first is None:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    large = {first["d"]: first["rows"]} | {r["d"]: r["rows"] for r in spaces.where(F.col("rows") > SMALL).collect()}  # one row for SMALL rows, at most
    found = _exact(base.where(~F.col("d").isin(*large)), every, k)
    for dim, rows in large.items():
        own = base.where(F.col("d") == dim).select("row", "vec_id", "v")
        queries = own.where(F.col("vec_id") % every == 0)
        found = found.unionByName(_measured(_candidates(own, queries, dim, rows, rerank), own, queries, dim))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _sample(base: DataFrame, dim: int, rows: int) -> pa.Table:
    """At most SAMPLE vectors, those first by hash; of a large table only rows with a low hash are put in order."""
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * dim)))
    h = F.xxhash64("vec_id", "v")
    low = base.where(F.pmod(h, F.lit(1 << 20)) < -(-(most << 21) // rows)) if rows > 8 * most else base
    for some in (low, base):
        got = some.orderBy(h, "vec_id", "v").limit(most).select("v").toArrow()
        if got.num_rows:
            return got
    raise AssertionError("a space without rows")


def _candidates(base: DataFrame, queries: DataFrame, dim: int, rows: int, rerank: int) -> DataFrame:
    """PAIRS of each query and its `rerank` nearest rows by code, of base(row, vec_id, v)."""
    spark = base.sparkSession
    sample = _sample(base, dim, rows)
    fitted = spark.sparkContext.broadcast(Index(unit_rows(vectors(sample.column("v").combine_chunks(), dim)), rows))
    cells = len(fitted.value.cells)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cell, code, own = fitted.value.encode(unit_rows(vectors(column_of(b, "v"), dim)))
                yield pa.RecordBatch.from_arrays([pa.array(cell), column_of(b, "row"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(own)], ["cell", "row", "code", "own"])

    indexed = written(base.mapInArrow(index, "cell long, row long, code binary, own float"))
    by_cell = np.zeros(cells, np.int64)
    for r in indexed.groupBy("cell").count().collect():  # CELLS rows at most
        by_cell[r["cell"]] = r["count"]
    # neighbouring cells fill a shard; a cell of more rows than a shard has several of its own
    shard, parts, at, held = np.zeros(cells, np.int64), np.maximum(1, -(-by_cell // SHARD)), 0, 0
    for c in range(cells):
        if held and (held + by_cell[c] > SHARD):
            at, held = at + 1, 0
        shard[c], held = at, held + by_cell[c]
        if parts[c] > 1:
            at, held = at + parts[c], 0

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            q = unit_rows(vectors(column_of(b, "v"), dim))
            order = fitted.value.order(q)
            seen = np.cumsum(by_cell[order], axis=1) - by_cell[order]
            want = ((np.arange(cells) < fitted.value.probes) | (seen < LEAST_ROWS)) & (by_cell[order] > 0)
            rows, ids = [], column_of(b, "row").to_pylist()
            for i, query in enumerate(ids):
                visited: dict[int, list[int]] = {}
                for c in order[i, want[i]].tolist():
                    for s in range(shard[c], shard[c] + parts[c]):
                        visited.setdefault(s, []).append(c)
                rows += [(s, query, i, sorted(own)) for s, own in visited.items()]
            take = [r[2] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([q[i].tobytes() for i in take], pa.binary()), pa.array([r[3] for r in rows], pa.list_(pa.int32()))], ["shard", "query", "q", "cells"]
            )

    probes = written(queries.mapInArrow(probe, "shard long, query long, q binary, cells array<int>"))
    of_cell = F.broadcast(spark.createDataFrame([(c, int(shard[c]), int(parts[c])) for c in range(cells)], "cell long, first long, parts long"))
    blocks = probes.groupBy("shard").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("blocks"))  # a row for SHARD rows
    left = indexed.join(of_cell, "cell").withColumn("shard", F.col("first") + F.pmod(F.xxhash64("row"), "parts"))
    left = left.join(blocks, "shard").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "cell", "row", "code", "own")
    right = probes.join(blocks, "shard").select("shard", F.pmod(F.xxhash64("query"), "blocks").alias("block"), "query", "q", "cells")

    def measure(a: pa.Table, b: pa.Table) -> pa.Table:
        none = pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float32())], ["query", "row", "far"])
        if not a.num_rows or not b.num_rows:
            return none
        a = a.sort_by([("cell", "ascending"), ("row", "ascending")])
        ids, cell, own = (a.column(c).to_numpy() for c in ("row", "cell", "own"))
        code = np.frombuffer(b"".join(a.column("code").to_pylist()), np.uint8).reshape(len(ids), PARTS).T.copy()
        asks = b.column("query").to_numpy()
        q = np.frombuffer(b"".join(b.column("q").to_pylist()), np.float32).reshape(len(asks), dim)
        visits = b.column("cells").to_pylist()
        found = []
        step = max(1, (1 << 21) // len(ids))
        for s in range(0, len(asks), step):
            table = fitted.value.tables(q[s : s + step])
            far = np.full((len(table), len(ids)), np.inf, np.float32)
            by: dict[int, list[int]] = {}
            for i, some in enumerate(visits[s : s + step]):
                for c in some:
                    by.setdefault(c, []).append(i)
            for c, some in by.items():
                x, y = np.searchsorted(cell, [c, c + 1])
                if x == y:
                    continue
                center = fitted.value.cells[c]
                sums = own[None, x:y] + ((q[s + np.array(some)] - center) ** 2).sum(1)[:, None]
                for m in range(PARTS):
                    sums += table[some, m][:, code[m, x:y]]
                far[some, x:y] = sums
            far[asks[s : s + step, None] == ids[None]] = np.inf
            best = np.argpartition(far, rerank - 1, axis=1)[:, :rerank] if len(ids) > rerank else np.broadcast_to(np.arange(len(ids)), far.shape)
            near = np.take_along_axis(far, best, 1)
            ok = np.isfinite(near)
            found.append((np.repeat(asks[s : s + step], ok.sum(1)), ids[best[ok]], near[ok]))
        return pa.table([pa.array(np.concatenate(x), t) for x, t in zip(zip(*found, strict=True), (pa.int64(), pa.int64(), pa.float32()), strict=True)], ["query", "row", "far"])

    pairs = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(measure, PAIRS)
    order = Window.partitionBy("query").orderBy("far", "row")
    return pairs.withColumn("place", F.row_number().over(order)).where(F.col("place") <= rerank).select("query", "row")


def _measured(pairs: DataFrame, base: DataFrame, queries: DataFrame, dim: int) -> DataFrame:
    """query, query_id, vec_id and exact score of pairs(query, row)."""
    both = pairs.join(base, "row").join(queries.select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), F.col("v").alias("q")), "query")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                score = cosines(vectors(column_of(b, "v"), dim), vectors(column_of(b, "q"), dim))
                yield pa.RecordBatch.from_arrays([*(column_of(b, c) for c in ("query", "query_id", "vec_id")), pa.array(score)], ["query", "query_id", "vec_id", "score"])

    return both.select("query", "query_id", "vec_id", "v", "q").mapInArrow(run, "query long, query_id long, vec_id long, score double")


def _exact(base: DataFrame, every: int, k: int) -> DataFrame:
    """query, query_id, vec_id and score of the k nearest, by comparing all vectors of a length; SMALL of them at most."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        x = vectors(group.column("v").combine_chunks(), group.column("d")[0].as_py())
        ids, rows, out = group.column("vec_id").to_numpy(), group.column("row").to_numpy(), [(np.zeros(0, np.int64),) * 3 + (np.zeros(0),)]
        for i in np.flatnonzero(ids % every == 0).tolist():
            score = cosines(x, np.broadcast_to(x[i], x.shape))
            score[i] = -np.inf
            top = np.argsort(-score, kind="stable")[: min(k, len(x) - 1)]
            out.append((np.full(len(top), rows[i]), np.full(len(top), ids[i]), ids[top], score[top]))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query", "query_id", "vec_id", "score"])

    return base.groupBy("d").applyInArrow(run, "query long, query_id long, vec_id long, score double")
