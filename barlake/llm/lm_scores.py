"""Stupid-backoff scores: n-gram counts of the whole corpus joined to its n-grams.

Documents are exploded into n-grams of order 1 to 3 chunk by chunk (chunks are bounded in
bytes and rows); within a chunk equal n-grams are combined.  (hash, count) pairs are dealt
to buckets by hash, so each bucket holds one partition of the count tables and joins it to
the n-grams that the chunks sent: the corpus count goes back to each of them.  A chunk
then sums the scores of its documents:

    S(w | context) = c(context w) / c(context)   if c(context w) >= LEAST
                   = ALPHA * S(w | shorter context) otherwise, at the end c(w) / N.

An n-gram that the corpus has once is evidence of nothing but its own document, so the
default least count is 2.  Sorted hashes leave as differences, compressed, since they are
most of what is moved.  A hot n-gram crosses once per chunk; buckets are even by hash.
Hashes have 56 bits: among 10^10 distinct n-grams, about one in 10^7 shares its count.

Defined results: a null or empty text has no words and the score 0; rows with equal ids
are counted and scored one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import buckets, from_planes, pack, planes, require_reuse, unpack, written

ORDER = 3
LEAST = 2
ALPHA = 0.4
CHUNK_BYTES = 12 << 20
CHUNK_ROWS = 16_384
_BITS = np.uint64((1 << 56) - 1)
# Fixed value: lower-case A-Z.
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_EXCHANGE = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("cell", pa.binary())])
_SPARK = "bucket int, chunk bigint, kind int, cell binary"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_LOWER).split()  # bytes.split parts at \x20 and \x09-\x0D


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def ngram_hashes(words: np.ndarray, place: np.ndarray, order: int) -> list[np.ndarray]:
    """56-bit hashes of the n-grams that end at each position, by order; ``place`` is a
    position's distance from its document's start (a shorter n-gram's hash is unused)."""
    out, state = [], words
    for n in range(1, order + 1):
        if n > 1:
            before = np.zeros_like(state)
            before[1:] = state[:-1]
            state = _mix(before * np.uint64(0xC2B2AE3D27D4EB4F) + words)
        out.append(_mix(state + np.uint64(n)) & _BITS)
    return out


def _places(sizes: np.ndarray) -> np.ndarray:
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.arange(len(starts)) - starts


def _dealt(hashes: np.ndarray, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of sorted hashes by (bucket, hash), and the cuts between buckets."""
    home = (hashes % np.uint64(n_buckets)).astype(np.uint32)
    order = np.argsort(home, kind="stable")
    return order, np.searchsorted(home[order], np.arange(n_buckets + 1))


class _Number(dict):
    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def _chunks(batches):
    """(chunk id, doc_ids, words per document, hash of each distinct word, word numbers)."""
    def made():
        own = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
        return start, ids, np.array(sizes, np.int64), own, np.array(axis, np.uint32)

    start, size = None, 0
    ids, sizes, axis, number = [], [], [], _Number()
    for batch in batches:
        for uid, doc_id, text in zip(batch.column("uid").to_pylist(), batch.column("doc_id").to_pylist(),
                                     batch.column("text").cast(pa.binary()).to_pylist()):
            start = uid if start is None else start
            words = words_of(text or b"")
            ids.append(doc_id)
            sizes.append(len(words))
            axis.extend(map(number.__getitem__, words))
            size += len(text or b"")
            if size >= CHUNK_BYTES or len(ids) >= CHUNK_ROWS:
                yield made()
                start, size = None, 0
                ids, sizes, axis, number = [], [], [], _Number()
    if ids:
        yield made()


def _sequences(batches):
    """The word sequences of the chunks, for the sums at the end."""
    for start, ids, sizes, own, axis in _chunks(batches):
        doc_ids = pa.array(ids, pa.int64())
        yield from _batches([(0, start, 0, pack(
            doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
            np.asarray(doc_ids.is_valid().to_numpy(zero_copy_only=False), np.uint8).tobytes(),
            sizes.astype("<i8").tobytes(), own.astype("<u8").tobytes(), planes(axis.astype("<u4"))))])


def _ngrams(n_buckets: int, order: int):
    """The chunks' distinct n-grams and their counts, dealt to buckets by hash."""
    def cells(start, sizes, own, axis):
        place = _places(sizes)
        for n, hashes in enumerate(ngram_hashes(own[axis] if len(axis) else own, place, order), 1):
            found, count = np.unique(hashes[place >= n - 1], return_counts=True)
            by, cuts = _dealt(found, n_buckets)
            found, count = found[by] // np.uint64(n_buckets), count[by]
            for b in range(n_buckets):
                lo, hi = cuts[b], cuts[b + 1]
                if lo < hi:
                    step = np.diff(found[lo:hi], prepend=np.uint64(0))
                    yield b, start, n, pack(planes(step.astype("<u8")), planes(count[lo:hi].astype("<u4")))

    def run(batches):
        for batch in batches:
            for start, cell in zip(batch.column("chunk").to_pylist(), batch.column("cell")):
                _, _, sizes, own, axis = unpack(cell.as_py())
                yield from _batches(cells(start, np.frombuffer(sizes, "<i8"), np.frombuffer(own, "<u8"),
                                          from_planes(axis, "<u4")))
    return run


def _batches(rows):
    for row in rows:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _EXCHANGE)], schema=_EXCHANGE)


def _join_counts(table: pa.Table) -> pa.Table:
    """One partition of the count tables: the corpus count of each n-gram sent to it."""
    rows = list(zip(*[table.column(c).to_pylist() for c in _EXCHANGE.names]))
    out = []
    for n in sorted({r[2] for r in rows}):
        sent = [r for r in rows if r[2] == n]
        hashes, counts = [], []
        for r in sent:
            step, count = unpack(r[3])
            hashes.append(np.cumsum(from_planes(step, "<u8"), dtype=np.uint64))
            counts.append(from_planes(count, "<u4"))
        whole = np.concatenate(hashes)
        by = np.argsort(whole, kind="stable")
        ordered = whole[by]
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        total = np.add.reduceat(np.concatenate(counts)[by].astype(np.int64), first)
        back = np.empty(len(whole), "<i8")
        back[by] = np.repeat(total, np.diff(np.r_[first, len(whole)]))
        at = 0
        for r, h in zip(sent, hashes):
            out.append((*r[:3], pack(planes(back[at:at + len(h)]))))
            at += len(h)
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), _EXCHANGE)], schema=_EXCHANGE)


_SCORES = "doc_id bigint, n_words bigint, n_matched bigint, n_unigrams bigint, partial double"


def _score(n_buckets: int, order: int, least: int, alpha: float):
    def run(sequences: pa.Table, table: pa.Table) -> pa.Table:
        cells = {(k, b): c for b, k, c in zip(table.column("bucket").to_pylist(), table.column("kind").to_pylist(),
                                              table.column("cell").to_pylist())}
        ids, valid, sizes, own, axis = unpack(sequences.column("cell")[0].as_py())
        sizes, own, axis = np.frombuffer(sizes, "<i8"), np.frombuffer(own, "<u8"), from_planes(axis, "<u4")
        place = _places(sizes)
        count = []
        for n, hashes in enumerate(ngram_hashes(own[axis] if len(axis) else own, place, order), 1):
            full = place >= n - 1
            found, inverse = np.unique(hashes[full], return_inverse=True)
            by, cuts = _dealt(found, n_buckets)
            got = np.empty(len(found), np.int64)
            for b in range(n_buckets):
                if cuts[b] < cuts[b + 1]:
                    got[by[cuts[b]:cuts[b + 1]]] = from_planes(unpack(cells[n, b])[0], "<i8")
            c = np.zeros(len(axis), np.int64)
            c[full] = got[inverse]
            count.append(c)
        # from the longest order down; what is left at the end is a share of all words
        score = np.zeros(len(axis))
        left = np.ones(len(axis), bool)
        matched = np.zeros(len(axis), np.int64)
        for n in range(order, 1, -1):
            use = left & (place >= n - 1) & (count[n - 1] >= least)
            at = np.flatnonzero(use)
            score[at] += np.log(count[n - 1][at] / count[n - 2][at - 1])
            matched[at] = n
            left &= ~use
            score[left & (place >= n - 1)] += np.log(alpha)
        score[left] += np.log(count[0][left]) if len(axis) else 0
        doc = np.repeat(np.arange(len(sizes)), sizes)

        def per_doc(x):
            return np.bincount(doc, weights=x, minlength=len(sizes))
        return pa.table({
            "doc_id": pa.array(np.frombuffer(ids, "<i8"), mask=np.frombuffer(valid, np.uint8) == 0),
            "n_words": pa.array(sizes.astype(np.int64)),
            "n_matched": pa.array(per_doc(matched == order).astype(np.int64)),
            "n_unigrams": pa.array(per_doc(left).astype(np.int64)), "partial": pa.array(per_doc(score), pa.float64())})
    return run


def lm_scores(docs: DataFrame, order: int = ORDER, least: int = LEAST, alpha: float = ALPHA) -> DataFrame:
    """doc_id, n_words, n_matched (words scored by the longest order), n_unigrams (words
    that backed off to their own share), log_score (natural logarithm, summed over the
    words) and mean_score of every row of ``docs`` (doc_id, text)."""
    require_reuse(docs.sparkSession)
    n = 2 * buckets(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"),
                       F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # one scan cuts the chunks; both readings of them are of this exchange
    chunks = rows.mapInArrow(_sequences, _SPARK).repartition(n, "chunk")
    counted = (chunks.mapInArrow(_ngrams(n, order), _SPARK)
               .groupBy("bucket").applyInArrow(_join_counts, _SPARK))
    scored = written(chunks.groupBy("chunk").cogroup(counted.groupBy("chunk")).applyInArrow(
        _score(n, order, least, alpha), _SCORES), "lm-scores")
    whole = scored.agg(F.sum("n_words")).first()[0] or 1
    log_score = F.col("partial") - F.col("n_unigrams") * F.log(F.lit(float(whole)))
    return scored.select("doc_id", "n_words", "n_matched", "n_unigrams", log_score.alias("log_score"),
                         (log_score / F.greatest(F.col("n_words"), F.lit(1))).alias("mean_score"))
