"""Token counts: each distinct pre-token is counted once and joined to frequencies.

Map side, the texts of a chunk (bounded in bytes and rows) are split into pre-tokens.
Pre-tokens that are entries of the vocabulary are settled there from a table of at most
one row per vocabulary entry.  The others leave as posting lists, pre-token -> (document
of the chunk, frequency), dealt to buckets by hash, so a pre-token of a hot document
group crosses the exchange once per chunk.  A bucket counts the pieces of each distinct
pre-token once, multiplies its frequencies and returns one sum per document; chunks add
up their buckets.  Ids are never kept, and a task keeps the counts of recent pre-tokens in
two generations of a fixed size: one that returns after more others is counted again.  Buckets are exchanged with a rebalance hint,
which lets AQE split one that a hot pre-token has grown.

Defined results: a null text counts as empty (0 tokens); no rows give no rows; a very long
text is a chunk of its own; other columns are ignored, whatever their names; rows with equal ids are counted
separately; a special token inside a text counts as one token, as the library does.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import buckets, pack, unpack

# Fixed value: the byte-level pre-token pattern of the vocabulary file.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Characters outside these blocks are split by the library itself.
SETTLED = "[^\x00-\u02af\u0410-\u044f\u2010-\u2027\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3]"
LIMIT = 512
CHUNK_BYTES = 16 << 20
CHUNK_ROWS = 16_384
PIECES = 400_000  # counted pre-tokens that a task keeps, twice


@lru_cache(maxsize=4)
def _tools(path: str):
    """Tokenizer, findall, special strings, and the counts of vocabulary pre-tokens."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import regex
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    pattern = regex.compile(PRETOKEN)
    special = sorted((t.content for t in tok.get_added_tokens_decoder().values()), key=len, reverse=True)
    words = [tok.decode([i], skip_special_tokens=False) for i in range(tok.get_vocab_size())]
    words = [w for w in words if w not in special and "�" not in w
             and (m := pattern.match(w)) and m.end() == len(w)]
    known = dict(zip(words, piece_counts(tok, words)))
    split = regex.compile("|".join(map(regex.escape, special))).split if special else None
    return tok, _splitter(tok, pattern), split, known


def _splitter(tok, pattern):
    """Pre-tokens of a text.  The Unicode tables of the pattern module and of the library
    can be of different age; characters outside old, settled blocks go to the library."""
    import regex

    strange = regex.compile(SETTLED).search

    def split(text: str) -> list[str]:
        if text.isascii() or not strange(text):
            return pattern.findall(text)
        return [text[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(text)]
    return split


def piece_counts(tok, words: list[str]) -> list[int]:
    return [len(e) for e in tok.encode_batch_fast(words, add_special_tokens=False)]


def pretokens(text: str, findall, split) -> tuple[Counter, int]:
    """Pre-token frequencies of a text, and its number of special tokens."""
    segments = split(text) if split else [text]
    freq: Counter = Counter()
    for s in segments:
        freq.update(findall(s))
    return freq, len(segments) - 1


class _Chunk:
    """Postings of consecutive documents until flushed."""

    def __init__(self, start: int):
        self.start, self.size = start, 0
        self.ids, self.n_bytes, self.settled = [], [], []
        self.token: dict[str, int] = {}
        self.t, self.d, self.f = [], [], []

    def rows(self, n_buckets: int):
        """(bucket, chunk, kind, cell): the documents, then the postings by bucket."""
        ids = pa.array(self.ids, pa.int64())
        valid = np.asarray(ids.is_valid().to_numpy(zero_copy_only=False), np.uint8)
        yield self.start % n_buckets, self.start, 0, pack(
            ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(), valid.tobytes(),
            np.array(self.n_bytes, "<i8").tobytes(), np.array(self.settled, "<i8").tobytes())
        if not self.t:
            return
        words = [w.encode("utf-8") for w in self.token]
        home = np.fromiter((zlib.crc32(w) % n_buckets for w in words), np.int64, len(words))
        t, d, f = (np.array(x, "<u4") for x in (self.t, self.d, self.f))
        order = np.lexsort((t, home[t]))
        t, d, f = t[order], d[order], f[order]
        cuts = np.searchsorted(home[t], np.arange(n_buckets + 1))
        for b in range(n_buckets):
            lo, hi = cuts[b], cuts[b + 1]
            if lo < hi:
                own, n = np.unique(t[lo:hi], return_counts=True)
                text = [words[i] for i in own]
                yield b, self.start, 1, pack(
                    np.fromiter(map(len, text), "<u4", len(text)).tobytes(), b"".join(text),
                    n.astype("<u4").tobytes(), d[lo:hi].tobytes(), f[lo:hi].tobytes())


_EXCHANGE = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("cell", pa.binary())])


def _postings(path: str, n_buckets: int):
    def run(batches):
        _, findall, split, known = _tools(path)
        chunk = None
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column("text").cast(pa.binary())), 0).to_pylist()
            for uid, doc_id, text, n in zip(batch.column("uid").to_pylist(), batch.column("doc_id").to_pylist(),
                                            batch.column("text").to_pylist(), size):
                chunk = chunk or _Chunk(uid)
                freq, settled = pretokens(text or "", findall, split)
                i, token, t, d, f = len(chunk.ids), chunk.token, chunk.t, chunk.d, chunk.f
                for w, k in freq.items():
                    one = known.get(w)
                    if one is None:
                        t.append(token.setdefault(w, len(token)))
                        d.append(i)
                        f.append(k)
                    else:
                        settled += one * k
                chunk.ids.append(doc_id)
                chunk.n_bytes.append(n)
                chunk.settled.append(settled)
                chunk.size += n
                if chunk.size >= CHUNK_BYTES or len(chunk.ids) >= CHUNK_ROWS:
                    yield from _batches(chunk.rows(n_buckets))
                    chunk = None
        if chunk:
            yield from _batches(chunk.rows(n_buckets))
    return run


def _batches(rows):
    for row in rows:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _EXCHANGE)], schema=_EXCHANGE)


def _bucket_sums(path: str):
    """A posting cell becomes (documents, token sums); document cells pass through."""
    def run(batches):
        tok = _tools(path)[0]
        pieces, older = {}, {}  # two generations of counted pre-tokens
        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in _EXCHANGE.names]):
                if row[2] == 0:
                    yield from _batches([row])
                    continue
                size, text, n, d, f = unpack(row[3])
                ends = np.cumsum(np.frombuffer(size, "<u4"), dtype=np.int64)
                starts = ends - np.frombuffer(size, "<u4")
                words = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
                if len(pieces) >= PIECES:
                    pieces, older = {}, pieces
                new = []
                for w in words:
                    if w not in pieces:
                        if w in older:
                            pieces[w] = older[w]
                        else:
                            new.append(w)
                pieces.update(zip(new, piece_counts(tok, [w.decode("utf-8") for w in new])))
                each = np.repeat(np.fromiter(map(pieces.__getitem__, words), np.int64, len(words)),
                                 np.frombuffer(n, "<u4"))
                docs = np.frombuffer(d, "<u4")
                total = np.bincount(docs, weights=each * np.frombuffer(f, "<u4").astype(np.int64))
                some = np.flatnonzero(total)
                yield from _batches([(*row[:3], pack(some.astype("<u4").tobytes(),
                                                     total[some].astype("<i8").tobytes()))])
    return run


def _chunk_totals(table: pa.Table) -> pa.Table:
    """All cells of one chunk (bounded by the chunk limits) -> one row per document."""
    docs, sums = None, []
    for kind, cell in zip(table.column("kind").to_pylist(), table.column("cell").to_pylist()):
        if kind == 0:
            docs = unpack(cell)
        else:
            sums.append(unpack(cell))
    ids, valid, n_bytes, total = docs
    total = np.frombuffer(total, "<i8").copy()
    for d, s in sums:
        total[np.frombuffer(d, "<u4")] += np.frombuffer(s, "<i8")
    null = np.frombuffer(valid, np.uint8) == 0
    return pa.table({"doc_id": pa.array(np.frombuffer(ids, "<i8"), mask=null),
                     "n_bytes": pa.array(np.frombuffer(n_bytes, "<i8")), "n_tokens": pa.array(total)})


def token_counts(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs`` (doc_id, text).

    ``model``: path of a byte-level tokenizer file, readable on every executor.
    """
    n = buckets(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("uid"),
                       F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    exchange = "bucket int, chunk bigint, kind int, cell binary"
    sums = (rows.mapInArrow(_postings(model, n), exchange)
            .hint("rebalance", "bucket").mapInArrow(_bucket_sums(model), exchange))
    return (sums.groupBy("chunk").applyInArrow(_chunk_totals, "doc_id bigint, n_bytes bigint, n_tokens bigint")
            .withColumn("over_limit", F.col("n_tokens") > limit))
