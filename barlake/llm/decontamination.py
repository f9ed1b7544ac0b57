"""Benchmark decontamination with a distributed positional inverted index.

The benchmark is a stated query set, taken in blocks of bounded size.  For a block, the
documents are read once: each task writes the postings of the block's terms, chunk by
chunk (document-partitioned, so a match never needs two chunks), into an index table in
the shared folder.  Frequencies of the terms over the whole corpus come from the index.
Then each window of a test item is looked up, in the chunks that have its rarest term, from
that term on: positions less the term's offset in the window are intersected list by list.
A start at which every word of the window stands in its place is a phrase match; one at
which the window's first word stands, and every other has an occurrence within ``slop``
words of its place, is a proximity match.  Both depend on the document and the window alone: how rare a term is decides the
order of the work, and of equally rare ones the first is taken.

Defined results: a null text has no words; an item without words has no window; an item
shorter than a window is one window; a null item_id still marks words but is not listed;
rows with equal ids are judged one by one; no documents give no rows, no items no matches.
A very long text is a chunk of its own.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import numbered, row_field, row_number, written

WINDOW = 10
SLOP = 3
CHUNK_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20

# Fixed value: lower-case A-Z; every other ASCII byte than a letter or digit parts words.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


class Block:
    """Windows of some benchmark items over a numbered vocabulary."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.vocab: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], set[str]] = {}
        for item_id, text in items:
            words = [self.vocab.setdefault(w, len(self.vocab)) for w in words_of((text or "").encode("utf-8"))]
            for i in range(max(1, len(words) - window + 1) if words else 0):
                found = self.items.setdefault(tuple(words[i:i + window]), set())
                if item_id is not None:
                    found.add(item_id)


def query_blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list]:
    """The items in blocks of about ``block_bytes`` of text, one at a time on the driver."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = size // block_bytes + 1
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else items
        yield [(r.item_id, r.text) for r in part.collect()]


_INDEX = ("chunk bigint, uids array<bigint>, doc_ids array<bigint>, firsts array<int>, sizes array<int>, "
          "terms array<int>, counts array<int>, positions array<int>")
_HITS = ("uid bigint, doc_id bigint, n_words bigint, spans array<struct<first:int,last:int>>, "
         "items array<string>, near array<string>")


def _column(values, kind) -> pa.Array:
    values = values if isinstance(values, pa.Array) else pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _index(vocab: dict[bytes, int], gap: int):
    """Postings of the vocabulary's terms, one row per chunk of documents.  Documents of
    a chunk share one axis of positions, ``gap`` apart."""
    def row(uids, doc_ids, firsts, sizes, axis):
        ids = np.array(axis, np.int32)
        at = np.flatnonzero(ids >= 0).astype(np.int32)
        order = np.argsort(ids[at], kind="stable")
        terms, counts = np.unique(ids[at], return_counts=True)
        cols = [_column(uids, pa.int64()), _column(doc_ids, pa.int64()), _column(firsts, pa.int32()),
                _column(sizes, pa.int32()), _column(terms, pa.int32()),
                _column(counts.astype(np.int32), pa.int32()), _column(at[order], pa.int32())]
        return pa.RecordBatch.from_arrays(
            [pa.array([uids[0]], pa.int64()), *cols],
            names=["chunk", "uids", "doc_ids", "firsts", "sizes", "terms", "counts", "positions"])

    def run(batches):
        get, size = vocab.get, 0
        uids, doc_ids, firsts, sizes, axis = [], [], [], [], []
        for batch in batches:
            for uid, doc_id, text in zip(batch.column("uid").to_pylist(), batch.column("doc_id").to_pylist(),
                                         batch.column("text").cast(pa.binary()).to_pylist()):
                words = words_of(text or b"")
                uids.append(uid)
                doc_ids.append(doc_id)
                firsts.append(len(axis))
                sizes.append(len(words))
                axis.extend(map(get, words, repeat(-1)))
                axis.extend(repeat(-1, gap))
                size += len(text or b"") + 100
                if size >= CHUNK_BYTES:
                    yield row(uids, doc_ids, firsts, sizes, axis)
                    uids, doc_ids, firsts, sizes, axis, size = [], [], [], [], [], 0
        if uids:
            yield row(uids, doc_ids, firsts, sizes, axis)
    return run


def _within(starts: np.ndarray, postings: np.ndarray, offset: int, slop: int) -> np.ndarray:
    """The starts that have a posting at ``offset``, up to ``slop`` to either side."""
    want = starts + (offset - slop)
    at = np.minimum(np.searchsorted(postings, want), len(postings) - 1)
    found = postings[at]
    return starts[(found >= want) & (found <= want + 2 * slop)]


def _lookup(windows: list[tuple], slop: int):
    """windows: (terms from the rarest on, their offsets, length, items)."""
    by_rarest: dict[int, list[tuple]] = {}
    for w in windows:
        by_rarest.setdefault(w[0][0], []).append(w)
    around = np.arange(-slop, slop + 1)

    def row(index):
        post = dict(zip(index["terms"].tolist(), np.split(index["positions"], np.cumsum(index["counts"])[:-1]))) \
            if len(index["terms"]) else {}
        firsts = index["firsts"]
        spans = [[] for _ in firsts]
        items, near = [set() for _ in firsts], [set() for _ in firsts]
        for terms, offsets, length, names in chain.from_iterable(map(by_rarest.get, post.keys() & by_rarest.keys())):
            if not all(t in post for t in terms):
                continue
            rarest = post[terms[0]]
            starts = np.unique(rarest[:, None] - offsets[0] + around)
            for t, o in sorted(zip(terms, offsets), key=lambda x: x[1] > 0):  # the first word first
                starts = _within(starts, post[t], o, slop if o else 0)
                if not len(starts):
                    break
            if not len(starts):
                continue
            for d in np.unique(np.searchsorted(firsts, starts, "right") - 1):
                near[d].update(names)
            for t, o in zip(terms, offsets):
                starts = _within(starts, post[t], o, 0)
            for d, s in zip(np.searchsorted(firsts, starts, "right") - 1, starts):
                spans[d].append((int(s - firsts[d]), int(s - firsts[d]) + length))
                items[d].update(names)
        return spans, items, near

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                index = {c: batch.column(c)[i].values for c in batch.schema.names if c != "chunk"}
                spans, items, near = row({c: index[c].to_numpy() for c in ("firsts", "terms", "counts", "positions")})
                spans = [[{"first": a, "last": b} for a, b in sorted(set(x))] for x in spans]
                yield pa.RecordBatch.from_arrays(
                    [index["uids"], index["doc_ids"], index["sizes"].cast(pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                     pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                     pa.array([sorted(x) for x in near], pa.list_(pa.string()))],
                    names=["uid", "doc_id", "n_words", "spans", "items", "near"])
    return run


def _block_hits(rows: DataFrame, block: Block, slop: int, window: int) -> DataFrame:
    index = written(rows.mapInArrow(_index(block.vocab, window + 2 * slop + 1), _INDEX), "postings")
    # at most one row per term of the block
    freq = {r.term: r.n for r in
            index.select(F.explode(F.arrays_zip("terms", "counts")).alias("p"))
            .groupBy(F.col("p.terms").alias("term")).agg(F.sum("p.counts").alias("n")).collect()}
    windows = []
    for words, names in block.items.items():
        if all(t in freq for t in words):
            order = sorted(range(len(words)), key=lambda i: (freq[words[i]], i))
            windows.append(([words[i] for i in order], order, len(words), sorted(names)))
    return index.mapInArrow(_lookup(windows, slop), _HITS)


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = SLOP,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Phrase and proximity matches of every row of ``docs`` (doc_id, text) with the items
    of ``benchmark`` (item_id, text): uid (row number of ``docs``), doc_id, n_words, spans (matched windows as word ranges), items, near."""
    blocks = query_blocks(benchmark, block_bytes)
    first = next(blocks)
    second = next(blocks, None)
    if second is not None and row_field(docs) is None:  # every block scans the rows
        docs = numbered(docs.select("doc_id", "text"))
    rows = docs.select(row_number(docs).alias("uid"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = [_block_hits(rows, Block(items, window), slop, window)
             for items in chain([first], [] if second is None else [second], blocks)]
    if len(found) == 1:
        return found[0]
    return (reduce(DataFrame.unionByName, found).groupBy("uid", "doc_id", "n_words")
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
                 *[F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
                   for c in ("items", "near")]))


def hit_words(spans) -> F.Column:
    """Number of words inside any of the sorted ranges."""
    return F.aggregate(
        spans, F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("to")),
        lambda a, s: F.struct((a["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(s["first"], a["to"])))
                              .cast("bigint").alias("n"), F.greatest(a["to"], s["last"]).alias("to")),
        lambda a: a["n"])


def decontamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near, near_sha256, uid
    per row."""
    found = find_matches(docs, benchmark, **options).withColumn("n_hit", hit_words(F.col("spans")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), F.size("near").cast("bigint").alias("n_near"),
        F.sha2(F.array_join("near", ","), 256).alias("near_sha256"), "uid")
