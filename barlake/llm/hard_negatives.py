"""Hard negatives by angular triangle filtering.

Every row stores the angles between its vector and a few reference directions.  By the
triangle inequality on the sphere, the angle between two vectors lies between the largest
difference and the smallest (folded) sum of their angles to a reference.  The cosines of
that interval times both norms, widened by more than rounding can shift them, bound the
score.  Only pairs whose bounds overlap a window that still matters are scored, in exact
integers.

Rows are sorted over the cluster by label, nearest reference and angle, and stored as
chunks of one label each, with the range of every angle and of the norms: a chunk whose
bounds miss all windows of an anchor is passed by as a whole.  A hot label, reference or
vector is cut into as many ranges and chunks as it needs, since the row number ends the
sort key.

Anchors are the queries: blocks of at most ``BLOCK`` of them meet all chunks, in two
passes a block.  The first finds the positives, the best rows of the anchor's label; the
best scores (or lower bounds) so far raise the bar for the chunks that follow.  The second
takes the windows that follow from the positive scores.  A task returns its best few per
anchor, or per anchor and positive, and Spark ranks those.  The driver sees one block of
anchors and its positives at a time.

Defined results.  Rows with a null vec_id, label or vector, or a null or non-finite
component take no part.  A shorter vector counts as filled up with zeros, an empty one
scores 0.  Rows are told apart by their place in the table: repeated ids are rows of
their own, and a repeated anchor gets its results for each of its rows.  Equal scores
rank by vec_id.  An anchor without another row of its label, or without a row in a
window, gives no rows; neither does an empty table.  Products that might not fit into 64
bits are an error.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.llm.common import buckets, fresh_path, pack, unpack, written
from barlake.llm.vectors import finite, matrix, narrow

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
LOW, HIGH = 50, 95            # percent of the positive's score that bound a negative's
ANCHOR_EVERY, SHIFT_EVERY, LABELS = 50, 7, 10
REFERENCES = 8
CHUNK_ROWS = 4096
BLOCK = 1024
LIMIT = 1 << 30
SLACK = 1e-5                  # radians: above float32 angles and the arc cosine's rounding
NONE = np.iinfo(np.int64).min


# ------------------------------------------------------------------- rows and chunks
def _norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))


def angles(vectors: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angle of every vector to every reference direction; a zero vector gets right angles."""
    v, r = vectors.astype(np.float64), references.astype(np.float64)
    wide = max(v.shape[1], r.shape[1])
    v, r = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (v, r))
    length = np.outer(_norms(v), _norms(r))
    cosine = np.divide(v @ r.T, length, out=np.zeros_like(length), where=length > 0)
    return np.arccos(np.clip(cosine, -1, 1))


def _encoder(references: np.ndarray, scale: int):
    """vec_id, label, vector -> the row with its integers, angles and nearest reference."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column("vector"), scale, LIMIT)
            lengths = np.diff(batch.column("vector").offsets.to_numpy())
            angle = angles(vectors, references).astype("<f4")
            near = angle.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("vec_id"), batch.column("label"), pa.array(near, pa.int32()),
                 pa.array(angle[np.arange(len(near)), near], pa.float32()),
                 pa.array([v[:n].astype("<i8").tobytes() for v, n in zip(vectors, lengths)], pa.binary()),
                 pa.array([a.tobytes() for a in angle], pa.binary())],
                names=["uid", "vec_id", "label", "reference", "angle", "vector", "angles"])
    return run


_ROW = "uid bigint, vec_id bigint, label bigint, reference int, angle float, vector binary, angles binary"


class Rows:
    """Rows of one cell, ordered by vec_id: a chunk of one label, or a block of anchors."""

    def __init__(self, cell: bytes):
        head, uid, vec_id, label, vectors, angle = unpack(cell)
        self.n, wide, size = np.frombuffer(head, "<i8").tolist()
        self.uid, self.vec_id, self.label = (np.frombuffer(x, "<i8") for x in (uid, vec_id, label))
        self.vectors = np.frombuffer(vectors, f"<i{size}").reshape(self.n, wide)
        self.angles = np.frombuffer(angle, "<f4").reshape(self.n, -1)
        self.norms = _norms(self.vectors)


def _cell(rows: pa.Table) -> bytes:
    uid, vec_id, label = (rows.column(c).to_numpy().astype("<i8") for c in ("uid", "vec_id", "label"))
    order = np.lexsort((uid, vec_id))
    parts = [np.frombuffer(v, "<i8") for v in rows.column("vector").to_pylist()]
    vectors = np.zeros((len(parts), max(map(len, parts))), np.int64)
    for row, v in zip(vectors, parts):
        row[:len(v)] = v
    vectors = narrow(vectors[order])
    angle = np.frombuffer(b"".join(rows.column("angles").to_pylist()), "<f4").reshape(len(parts), -1)[order]
    return pack(np.array([*vectors.shape, vectors.itemsize], "<i8").tobytes(), uid[order].tobytes(),
                vec_id[order].tobytes(), label[order].tobytes(), vectors.tobytes(), angle.tobytes())


def _packer(rows: int, by_label: bool):
    """Sorted rows -> cells of at most ``rows`` consecutive rows (of one label)."""
    def cells(held: list):
        table = pa.Table.from_batches(held)
        return pa.RecordBatch.from_arrays([pa.array([_cell(table)], pa.binary())], names=["cell"])

    def run(batches):
        held, n, last = [], 0, None
        for batch in batches:
            label = batch.column("label").to_numpy() if by_label else np.zeros(batch.num_rows)
            cuts = [0, *(np.flatnonzero(label[1:] != label[:-1]) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if n and label[lo] != last:
                    yield cells(held)
                    held, n = [], 0
                last = label[lo]
                while lo < hi:
                    part = batch.slice(lo, min(hi - lo, rows - n))
                    held.append(part)
                    n, lo = n + part.num_rows, lo + part.num_rows
                    if n == rows:
                        yield cells(held)
                        held, n = [], 0
        if n:
            yield cells(held)
    return run


def _references(kept: DataFrame, count: int, scale: int) -> np.ndarray:
    """Some of the vectors as reference directions (any would do; these repeat)."""
    nonzero = F.exists("vector", lambda x: F.floor(x * F.lit(float(scale))) != 0)
    found = kept.where(nonzero).select("vector").orderBy(F.xxhash64("vec_id"), "vec_id").limit(count).collect()
    if not found:
        return np.ones((1, 1))
    wide = max(len(r.vector) for r in found)
    return np.floor(np.array([list(r.vector) + [0.0] * (wide - len(r.vector)) for r in found]) * scale)


# ---------------------------------------------------------------------------- bounds
def _widened(size: np.ndarray, cosine: np.ndarray, sign: int) -> np.ndarray:
    return size * (cosine + sign * 1e-9) + sign


def score_bounds(a: Rows, pick: np.ndarray, v: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of the anchors ``pick`` with every row of ``v``."""
    least = np.zeros((len(pick), v.n), np.float32)
    most = np.full_like(least, np.pi)
    for x, y in zip(a.angles[pick].T, v.angles.T):
        both = x[:, None] + y[None, :]
        np.minimum(most, np.minimum(both, np.float32(2 * np.pi) - both), out=most)
        np.maximum(least, np.abs(x[:, None] - y[None, :]), out=least)
    size = np.outer(a.norms[pick], v.norms)
    return (_widened(size, np.cos(np.minimum(most.astype(np.float64) + SLACK, np.pi)), -1),
            _widened(size, np.cos(np.maximum(least.astype(np.float64) - SLACK, 0)), 1))


def chunk_bounds(a: Rows, pick: np.ndarray, v: Rows) -> tuple[np.ndarray, np.ndarray]:
    """The same for a chunk as a whole, from the ranges of its angles and norms."""
    x = a.angles[pick].astype(np.float64)
    low, high = v.angles.min(axis=0).astype(np.float64), v.angles.max(axis=0).astype(np.float64)
    least = np.maximum(np.maximum(low - x, x - high), 0).max(axis=1)
    first, last = x + low, x + high
    fold = np.where((first <= np.pi) & (last >= np.pi), np.pi,
                    np.maximum(np.minimum(first, 2 * np.pi - first), np.minimum(last, 2 * np.pi - last)))
    least, most = np.cos(np.maximum(least - SLACK, 0)), np.cos(np.minimum(fold.min(axis=1) + SLACK, np.pi))
    size, small, large = a.norms[pick], v.norms.min(), v.norms.max()
    return (_widened(size * np.where(most > 0, small, large), most, -1),
            _widened(size * np.where(least > 0, large, small), least, 1))


def scores(a: Rows, pick: np.ndarray, v: Rows, wanted: np.ndarray) -> np.ndarray:
    """Exact integer scores where ``wanted``, NONE elsewhere."""
    out = np.full(wanted.shape, NONE, np.int64)
    x, y = a.vectors[pick], v.vectors
    wide = min(x.shape[1], y.shape[1])
    x, y = x[:, :wide], y[:, :wide]
    bound = float(a.norms.max()) * float(v.norms.max())
    if bound > 2.0 ** 62:
        raise ValueError("an inner product might not fit into 64 bits")
    exact = np.float64 if bound < 2.0 ** 52 else np.int64  # doubles are exact up to there
    x, y = x.astype(exact), y.astype(exact)
    rows, cols = np.nonzero(wanted)
    if len(rows) * 8 < wanted.size:
        for at in range(0, len(rows), 1 << 16):
            i, j = rows[at:at + (1 << 16)], cols[at:at + (1 << 16)]
            out[i, j] = (x[i] * y[j]).sum(axis=1).astype(np.int64)
    else:
        out[rows, cols] = (x @ y.T)[rows, cols].astype(np.int64)
    return out


def _nth(values: np.ndarray, n: int) -> np.ndarray:
    """The n-th largest value of every row (the least possible where there are fewer)."""
    if values.shape[1] < n:
        return np.full(len(values), -np.inf)
    return np.partition(values, values.shape[1] - n, axis=1)[:, values.shape[1] - n]


# ---------------------------------------------------------------------------- passes
def _best_positives(cell: bytes, count: int):
    """Best rows of the anchors' labels among the chunks of a task."""
    def run(batches):
        a = Rows(cell)
        best: list[list[tuple[int, int, int]]] = [[] for _ in range(a.n)]  # (-score, vec_id, uid)
        for batch in batches:
            for value in batch.column("cell"):
                v = Rows(value.as_py())
                pick = np.flatnonzero(a.label == v.label[0])
                bar = np.array([-best[i][-1][0] if len(best[i]) == count else -np.inf for i in pick])
                some = chunk_bounds(a, pick, v)[1] >= bar if len(pick) else pick
                pick, bar = pick[some], bar[some] if len(pick) else bar
                if not len(pick):
                    continue
                low, high = score_bounds(a, pick, v)
                # one more than needed: the anchor itself may be among the rows
                bar = np.maximum(bar, _nth(low, count + 1))
                wanted = (high >= bar[:, None]) & (a.uid[pick][:, None] != v.uid[None, :])
                found = scores(a, pick, v, wanted)
                bar = np.maximum(_nth(found, min(count, v.n)), NONE + 1)
                for i, row, floor in zip(pick, found, bar):
                    at = np.flatnonzero(row >= floor)
                    at = at[np.argsort(-row[at], kind="stable")[:count]]
                    best[i] = sorted(best[i] + list(zip((-row[at]).tolist(), v.vec_id[at].tolist(),
                                                        v.uid[at].tolist())))[:count]
        rows = [(int(a.uid[i]), -s, vec_id, uid) for i, found in enumerate(best) for s, vec_id, uid in found]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 4)],
                                         names=["anchor_uid", "score", "vec_id", "uid"])
    return run


def windows(positives: list[list[tuple[int, int]]], low: int, high: int) -> list[list[tuple[int, int, int, int]]]:
    """Per anchor and positive (vec_id, score): that, and the least and greatest score of a negative."""
    return [[(p, s, -(-low * s // 100), high * s // 100) for p, s in own] for own in positives]


def _best_negatives(cell: bytes, wanted_scores: list, count: int):
    """Best rows of other labels within the windows, among the chunks of a task."""
    def run(batches):
        a = Rows(cell)
        best = [[[] for _ in own] for own in wanted_scores]
        ceiling = np.array([max((w[3] for w in own if w[2] <= w[3]), default=NONE) for own in wanted_scores], np.int64)
        open_ = np.array([any(w[2] <= w[3] for w in own) for own in wanted_scores], bool)

        def floor(i: int) -> int:
            return min(max(w[2], -f[-1][0] if len(f) == count else w[2])
                       for w, f in zip(wanted_scores[i], best[i]) if w[2] <= w[3])

        for batch in batches:
            for value in batch.column("cell"):
                v = Rows(value.as_py())
                pick = np.flatnonzero(open_ & (a.label != v.label[0]))
                if not len(pick):
                    continue
                bar = np.array([floor(i) for i in pick], np.int64)
                low, high = chunk_bounds(a, pick, v)
                some = (high >= bar) & (low <= ceiling[pick])
                pick, bar = pick[some], bar[some]
                if not len(pick):
                    continue
                low, high = score_bounds(a, pick, v)
                found = scores(a, pick, v, (high >= bar[:, None]) & (low <= ceiling[pick][:, None]))
                for i, row, least in zip(pick, found, bar):
                    at = np.flatnonzero((row >= least) & (row <= ceiling[i]))
                    if not len(at):
                        continue
                    at = at[np.argsort(-row[at], kind="stable")]
                    down = -row[at]
                    for w, kept in zip(wanted_scores[i], best[i]):
                        lo = np.searchsorted(down, -w[3], "left")
                        hi = min(np.searchsorted(down, -w[2], "right"), lo + count)
                        if lo < hi:
                            own = at[lo:hi]
                            kept[:] = sorted(kept + list(zip((-row[own]).tolist(), v.vec_id[own].tolist(),
                                                             v.uid[own].tolist())))[:count]
        rows = [(int(a.uid[i]), j, int(a.vec_id[i]), w[0], w[1], -s, vec_id, uid)
                for i, own in enumerate(best) for j, (w, found) in enumerate(zip(wanted_scores[i], own))
                for s, vec_id, uid in found]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 8)],
                                         names=["anchor_uid", "nth", "anchor_id", "positive_id", "positive_score",
                                                "negative_score", "negative_id", "negative_uid"])
    return run


def _ranked(rows: DataFrame, key: list[str], score: str, vec_id: str, uid: str, most: int) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.col(score).desc(), vec_id, uid)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(vectors: DataFrame, anchors: Column, column: str = "embedding", scale: int = SCALE,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   references: int = REFERENCES, chunk_rows: int = CHUNK_ROWS, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors``: vec_id, label and the array ``column``; ``anchors``: a condition on vec_id.
    """
    spark = vectors.sparkSession
    kept = (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
                           F.col(column).cast("array<double>").alias("vector"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("vector"))))
    directions = _references(kept, references, scale)
    rows = written(kept.withColumn("uid", F.monotonically_increasing_id())
                   .mapInArrow(_encoder(directions, scale), _ROW), "vector-rows")
    key = ["label", "reference", "angle", "uid"]
    chunks = written(rows.repartitionByRange(buckets(spark), *key).sortWithinPartitions(*key)
                     .mapInArrow(_packer(chunk_rows, True), "cell binary"), "vector-chunks")
    queries = rows.where(anchors)
    blocks = written(queries.repartition(max(1, -(-queries.count() // block)))
                     .mapInArrow(_packer(block, False), "cell binary"), "anchor-blocks")

    result = fresh_path(spark, "hard-negatives")
    schema = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
              "negative_score bigint")
    columns = [c.split()[0] for c in schema.split(", ")]
    spark.createDataFrame([], schema).write.parquet(f"{result}/block=none")
    for number, (cell,) in enumerate(blocks.toLocalIterator()):
        cell = bytes(cell)
        found = chunks.mapInArrow(_best_positives(cell, positives),
                                  "anchor_uid bigint, score bigint, vec_id bigint, uid bigint")
        of: dict[int, list[tuple[int, int, int]]] = {}
        for r in _ranked(found, ["anchor_uid"], "score", "vec_id", "uid", positives).collect():  # block x positives
            of.setdefault(r.anchor_uid, []).append((r.rank, r.vec_id, r.score))
        own = [[(p, s) for _, p, s in sorted(of.get(u, []))] for u in Rows(cell).uid.tolist()]
        best = chunks.mapInArrow(_best_negatives(cell, windows(own, low, high), negatives),
                                 "anchor_uid bigint, nth bigint, anchor_id bigint, positive_id bigint, "
                                 "positive_score bigint, negative_score bigint, negative_id bigint, negative_uid bigint")
        (_ranked(best, ["anchor_uid", "nth"], "negative_score", "negative_id", "negative_uid", negatives)
         .select(*columns).write.parquet(f"{result}/block={number}"))
    return spark.read.schema(schema).parquet(result).select(*columns)


def shifted_labels(vectors: DataFrame, every: int = SHIFT_EVERY, labels: int = LABELS) -> DataFrame:
    """Labels of the rows whose vec_id is divisible by ``every`` go to the next class."""
    return vectors.withColumn("label", F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels)
                              .otherwise(F.col("label")))
