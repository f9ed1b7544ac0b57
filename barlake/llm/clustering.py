"""Centroid clustering (Lloyd rounds in integers) over subvector dictionaries.

Vectors are encoded once, losslessly.  Dimensions are cut into blocks of ``WIDTH``; a
chunk of at most ``CHUNK_ROWS`` vectors keeps, per block, the dictionary of its distinct
subvectors and one code per vector, as a row group of a columnar file does.  The chunks
are stored as one table, which every round reads.  A round computes the exact squared
distance of every dictionary entry to that block's part of each centroid, once, and adds
up the parts of a vector by its codes.  The new centroids come from the dictionaries too:
how often a cluster has a code, times the subvector.  A task adds its chunks up, Spark
adds the tasks up (one row per task, cluster and dimension at most), and the driver holds
the centroids alone: clusters times dimensions.

Dictionaries belong to chunks, not to the corpus: their size is then bounded whatever
the vectors are, no vector moves in any round, and a lost executor costs the chunks that
it was reading.  An entry is measured once per round and chunk; a chunk has far fewer
entries than vectors wherever subvectors repeat, and never more.

Defined results.  Vectors that are null, of another length, or hold a null or non-finite
component are left out.  Rows with equal ids are clustered separately; a null vec_id is
kept, and comes last among the starts.  Equal distances: the smaller cluster number.  Equal start
hashes (repeated ids): the smaller components first.  Fewer vectors than clusters: as
many clusters as vectors.  An empty table gives an empty result.  Components beyond 2^27
after scaling, whose distances might not fit into 64 bits, are an error.  Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import pack, unpack, written
from barlake.llm.vectors import finite, matrix, narrow

WIDTH = 2
CHUNK_ROWS = 65_536
LIMIT = 1 << 27
CLUSTERS, ROUNDS, SCALE, SIZE = 16, 3, 64, 64

_CHUNK = pa.schema([("cell", pa.binary())])


# ------------------------------------------------------------------ encoded chunks
def encode(ids: pa.Array, vectors: np.ndarray, width: int = WIDTH) -> bytes:
    """One chunk: ids, then per block the dictionary and the codes."""
    n, dims = vectors.shape
    valid = ids.is_valid().to_numpy(zero_copy_only=False)
    parts = [np.array([n, dims, width], "<i8").tobytes(),
             ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(), np.packbits(valid).tobytes()]
    for at in range(0, dims, width):
        # distinct rows of the block: the components packed into one key, column by column
        key = np.zeros(n, np.int64)
        for column in vectors[:, at:at + width].T:
            _, code = np.unique(column, return_inverse=True)
            _, key = np.unique(key * (int(code.max()) + 1) + code, return_inverse=True)
        entries = int(key.max()) + 1
        first = np.empty(entries, np.int64)
        first[key[::-1]] = np.arange(n - 1, -1, -1)
        book = narrow(vectors[first, at:at + width])
        code = key.astype("<u2" if entries <= 1 << 16 else "<u4")
        parts += [bytes([book.itemsize, code.itemsize]), book.tobytes(), code.tobytes()]
    return pack(*parts)


class Chunk:
    """A stored chunk, decoded: ``ids`` and per block (dictionary, codes)."""

    def __init__(self, cell: bytes):
        head, ids, valid, *parts = unpack(cell)
        self.n, self.dims, width = np.frombuffer(head, "<i8").tolist()
        null = np.unpackbits(np.frombuffer(valid, np.uint8))[:self.n] == 0
        self.ids = pa.array(np.frombuffer(ids, "<i8"), mask=null)
        self.blocks = []
        for at, (sizes, book, code) in zip(range(0, self.dims, width), zip(*[iter(parts)] * 3)):
            wide = min(width, self.dims - at)
            self.blocks.append((at, np.frombuffer(book, f"<i{sizes[0]}").reshape(-1, wide).astype(np.int64),
                                np.frombuffer(code, f"<u{sizes[1]}")))

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and exact squared distance of every vector."""
        total = np.zeros((self.n, len(centroids)), np.int64)
        for at, book, code in self.blocks:
            gap = book[:, None, :] - centroids[None, :, at:at + book.shape[1]]
            total += (gap * gap).sum(axis=2)[code]
        cluster = total.argmin(axis=1)  # the first of equals: the smaller number
        return cluster, total[np.arange(self.n), cluster]

    def add_sums(self, cluster: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> None:
        k = len(counts)
        counts += np.bincount(cluster, minlength=k)
        for at, book, code in self.blocks:
            often = np.bincount(code.astype(np.int64) * k + cluster, minlength=len(book) * k).reshape(-1, k)
            sums[:, at:at + book.shape[1]] += often.T @ book

    def vectors(self) -> np.ndarray:
        return np.hstack([book[code] for _, book, code in self.blocks])


def _encoder(scale: int, width: int, rows: int):
    def run(batches):
        held, n = [], 0

        def chunk():
            table = pa.Table.from_batches(held).combine_chunks()
            vectors = matrix(table.column("vector").chunk(0), scale, LIMIT)
            cell = encode(table.column("vec_id").chunk(0), vectors, width)
            return pa.RecordBatch.from_arrays([pa.array([cell], pa.binary())], schema=_CHUNK)

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, rows - n)
                held.append(part)
                n, batch = n + part.num_rows, batch.slice(part.num_rows)
                if n == rows:
                    yield chunk()
                    held, n = [], 0
        if n:
            yield chunk()
    return run


def encoded_chunks(vectors: DataFrame, scale: int, width: int = WIDTH, rows: int = CHUNK_ROWS) -> DataFrame:
    """``vectors`` (vec_id bigint, vector array<double>, equally long) as stored chunks."""
    return written(vectors.mapInArrow(_encoder(scale, width, rows), "cell binary"), "vector-chunks")


# ------------------------------------------------------------------------- rounds
def _sums(centroids: np.ndarray):
    """Counts and component sums of the clusters over all chunks of a task."""
    def run(batches):
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for cell in batch.column("cell"):
                chunk = Chunk(cell.as_py())
                chunk.add_sums(chunk.nearest(centroids)[0], counts, sums)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "rows", "sums"])
    return run


def next_centroids(chunks: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Componentwise floor of the means; an empty cluster keeps its centroid."""
    found = chunks.mapInArrow(_sums(np.array(centroids, np.int64)), "cluster int, rows bigint, sums array<bigint>")
    # every row of a cluster has one entry per dimension, so its rows are counted once per dimension too
    totals = (found.select("cluster", "rows", F.posexplode("sums").alias("dim", "part"))
              .groupBy("cluster", "dim").agg(F.sum("rows").alias("rows"), F.sum("part").alias("total")))
    out = [list(c) for c in centroids]
    for r in totals.collect():  # clusters x dimensions rows
        out[r.cluster][r.dim] = r.total // r.rows
    return out


def _assignments(centroids: np.ndarray):
    def run(batches):
        for batch in batches:
            for cell in batch.column("cell"):
                chunk = Chunk(cell.as_py())
                cluster, distance = chunk.nearest(centroids)
                yield pa.RecordBatch.from_arrays(
                    [chunk.ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                    names=["vec_id", "cluster", "distance"])
    return run


def assigned(chunks: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """vec_id, cluster, distance of every encoded vector."""
    return chunks.mapInArrow(_assignments(np.array(centroids, np.int64)), "vec_id bigint, cluster int, distance bigint")


def start_centroids(vectors: DataFrame, clusters: int, scale: int) -> list[list[int]]:
    """The vectors with the smallest sha256 of ``1:<vec_id>``, in that order."""
    key = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    whole = F.transform("vector", lambda x: F.floor(x * F.lit(float(scale))).cast("bigint"))
    first = (vectors.select(key.alias("key"), whole.alias("start"))
             .orderBy(F.col("key").asc_nulls_last(), "start").limit(clusters))
    return [list(r.start) for r in first.collect()]  # at most ``clusters`` rows


def lloyd(vectors: DataFrame, clusters: int, rounds: int, scale: int) -> tuple[DataFrame, list[list[int]]]:
    """Encoded chunks and final centroids of ``vectors`` (vec_id, vector)."""
    centroids = start_centroids(vectors, clusters, scale)
    chunks = encoded_chunks(vectors, scale)
    for _ in range(rounds if centroids else 0):
        centroids = next_centroids(chunks, centroids)
    return chunks, centroids


def cluster_vectors(vectors: DataFrame, column: str = "embedding", size: int = SIZE, clusters: int = CLUSTERS,
                    rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 per kept vector."""
    spark = vectors.sparkSession
    kept = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                          F.col(column).cast("array<double>").alias("vector")).where(finite(F.col("vector"), size))
    chunks, centroids = lloyd(kept, clusters, rounds, scale)
    result = ("vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
              "centroid_sha256 string")
    if not centroids:
        return spark.createDataFrame([], result)
    rows = written(assigned(chunks, centroids), "clusters")
    # one row per cluster: bounded by the parameter ``clusters``
    totals = {r.cluster: r.total for r in rows.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    table = spark.createDataFrame(
        [(i, totals[i], sum(totals.values()), hashlib.sha256(",".join(map(str, c)).encode("ascii")).hexdigest())
         for i, c in enumerate(centroids) if i in totals],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(table), "cluster").select(*[c.split()[0] for c in result.split(", ")])
