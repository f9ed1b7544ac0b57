"""Token-id files: bit-plane or byte-plane blocks, with a chunk index.

Documents are range-partitioned and sorted by id as texts, then encoded where they will
be written, so nothing is tokenized twice and ids never cross the network.  A shard is
one partition of that order.  Its ids are cut into chunks of whole documents (at least
``CHUNK_IDS`` ids, the last one excepted), a chunk into blocks of ``BLOCK`` ids.  A block
is transposed: plane k holds byte k (or bit k) of all its ids, and each plane is a
zstandard frame of its own; the high planes, all zeros or nearly so, take no space.

Layout of a chunk's ``data``: magic, block size, plane kind, number of ids and of blocks,
the compressed size of every plane of every block, then the planes.  A block can be
decoded alone.  Chunks are rows of the table ``chunks`` with their document ids and
lengths; the table ``index`` has, per chunk, its place among all ids, its id range and
its size.  Both are written by Spark's committer, so a lost executor repeats its shard.

Texts are encoded in batches of bounded size.  They are split into the tokenizer's pieces
(runs of letters, digits, runs of symbols), each distinct piece of a batch is merged once,
and the ids are put together by its number.  A worker keeps the ids of recent pieces in an
Arrow table of a fixed size.  The tokenizer never joins text across a space, so
words with characters on which Unicode versions may differ, or with special tokens, go to
the library one by one, and a very long text is encoded in parts.

Defined results.  A null text counts as empty and holds the end id alone.  Documents are
in ascending order of doc_id, null ids last; equal ids by a hash of their text, then by
their place in the table.  Special tokens inside a text become their ids, as by the
library's default.  An empty table gives no chunks and an empty index.  A very long
text is a chunk of its own, with many blocks.  Other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm.common import buckets, slices

MAGIC = b"IDPL"
HEAD = struct.Struct("<4sIIQI")  # magic, ids a block, plane kind, ids, blocks
BLOCK = 65_536
CHUNK_IDS = 1 << 20
KINDS = ("byte", "bit")
LEVEL = 3
BATCH = 4_000_000
PIECES, PIECE_LENGTH = 500_000, 48
# Letters, and other characters, whose class, case pair and composition all versions of
# Unicode agree on; among them, the only numbers are the ten digits.
LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-įĲ-ȹȻ-Ƚȿ-ʯА-яぁ-ゖァ-ヺ一-龥가-힣"
_STRANGE = re.compile(f"[^{LETTERS}\t\n\x20-\x7e¡-©«¬®-±´¶-¸»¿×÷‐-‧]").search
# Fixed value: the tokenizer file's pattern of pieces, after lower-casing, over these characters.
_PIECES = re.compile(f"[{LETTERS}]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^\\s0-9{LETTERS}]+").findall
# Fixed value: the file's letters for bytes: printable Latin-1 stands for itself, the others follow from 256.
_PLAIN = [*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)]
BYTES = {**{b: b for b in _PLAIN}, **{b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}}
LIBRARY = "\0"  # marks a word that the library encodes; never part of a piece


# -------------------------------------------------------------------------- planes
def shuffled(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """The planes of a block of uint32 ids."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [raw[:, k].tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")  # column k: bit k of every id
    return [np.packbits(bits[:, k]).tobytes() for k in range(32)]


def unshuffled(planes: list[bytes], n: int, kind: str = "byte") -> np.ndarray:
    if kind == "byte":
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").ravel()


def pack_ids(ids: np.ndarray, kind: str = "byte", block: int = BLOCK, level: int = LEVEL) -> bytes:
    """A chunk's ``data``."""
    press = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
    planes = [press(p) for at in range(0, len(ids), block) for p in shuffled(ids[at:at + block], kind)]
    return b"".join([HEAD.pack(MAGIC, block, KINDS.index(kind), len(ids), -(-len(ids) // block)),
                     np.array([len(p) for p in planes], "<u4").tobytes(), *planes])


def unpack_ids(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids [first, last) of a chunk; only the blocks that hold them are decoded."""
    magic, block, kind, n, blocks = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a chunk of token ids")
    last = n if last is None else min(last, n)
    count = 4 if KINDS[kind] == "byte" else 32
    sizes = np.frombuffer(data, "<u4", blocks * count, HEAD.size)
    ends = HEAD.size + sizes.nbytes + np.cumsum(sizes, dtype=np.int64)
    expand = zstandard.ZstdDecompressor().decompress
    out = []
    for b in range(first // block, -(-last // block) if first < last else 0):
        frames = [data[e - s:e] for e, s in zip(ends[b * count:(b + 1) * count].tolist(),
                                                sizes[b * count:(b + 1) * count].tolist())]
        ids = unshuffled([expand(f) for f in frames], min(block, n - b * block), KINDS[kind])
        out.append(ids[max(0, first - b * block):last - b * block])
    return np.concatenate(out) if out else np.zeros(0, "<u4")


# ------------------------------------------------------------------------ encoding
def _parts(text: str, size: int):
    """A text in parts of about ``size`` characters, cut at spaces."""
    at = 0
    while len(text) - at > size and (cut := text.find(" ", at + size)) >= 0:
        yield text[at:cut]
        at = cut
    yield text[at:]


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] numbers), start[1], ..."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(size.sum())


class PieceEncoder:
    """Ids of texts, piece by piece: each distinct piece of a batch is looked up once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        # the file's merges alone: pieces need neither normalizing nor splitting again
        self.merge = models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0,
                                end_of_word_suffix=model["end_of_word_suffix"]).tokenize
        self.special = re.compile("|".join(re.escape(t.content) for t in self.tok.get_added_tokens_decoder().values())
                                  or r"(?!)").search
        # known pieces; the ids of piece i are ids[start[i]:start[i] + size[i]]
        self.known = pa.array([], pa.string())
        self.start, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, "<u4")

    def piece(self, piece: str) -> list[int]:
        if piece[0] == LIBRARY:
            return self.tok.encode(piece[1:], add_special_tokens=False).ids
        plain = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(BYTES)
        return [t.id for t in self.merge(plain)]

    def places(self, pieces: pa.Array) -> np.ndarray:
        """Numbers of distinct pieces among the known ones, to which new ones are added."""
        at = pc.index_in(pieces, value_set=self.known)
        new = pieces.filter(at.is_null())
        found = [self.piece(p) for p in new.to_pylist()]
        size = np.fromiter(map(len, found), np.int64, len(found))
        place = at.fill_null(-1).to_numpy().astype(np.int64)
        place[place < 0] = len(self.known) + np.arange(len(found))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), "<u4")])
        self.known = pa.concat_arrays([self.known, new])
        return place

    def forget(self, used: np.ndarray) -> None:
        """Beyond the table's size, keep the pieces used last, but for very long ones."""
        if len(self.known) <= PIECES and len(self.ids) <= PIECES * PIECE_LENGTH:
            return
        short = pc.less_equal(pc.binary_length(self.known), PIECE_LENGTH).to_numpy(zero_copy_only=False)
        keep = used[short[used]]
        self.known = self.known.take(pa.array(keep))
        place, self.size = _runs(self.start[keep], self.size[keep]), self.size[keep]
        self.start, self.ids = np.cumsum(self.size) - self.size, self.ids[place]

    def odd(self, text: str) -> bool:
        """Whether the library has to see the text itself."""
        return bool(_STRANGE(text) or self.special(text))

    def split(self, text: str) -> list[str]:
        if not self.odd(text):
            return _PIECES(text.lower())
        return [p for word in text.split(" ")
                for p in ([LIBRARY + word] if self.odd(word) else _PIECES(word.lower()))]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's ids end."""
        split = [self.split(t) for t in texts]
        coded = pa.array(list(chain.from_iterable(split)), pa.string()).dictionary_encode()
        used = self.places(coded.dictionary)
        code = used[coded.indices.to_numpy()]
        each = self.size[code]
        ids = self.ids[_runs(self.start[code], each)]
        pieces = np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))
        self.forget(used)
        return ids, np.concatenate([[0], np.cumsum(each)])[pieces]


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


def encoded(path: str, rows, batch: int):
    """(doc_id, list of id arrays) of (doc_id, text) rows, in order.  Texts are encoded in
    batches of about ``batch`` characters; a longer one passes in parts."""
    encode = encoder(path).encode

    def run(held):
        ids, ends = encode([t for _, t, _ in held])
        start = 0
        for (doc_id, _, last), end in zip(held, ends.tolist()):
            yield doc_id, ids[start:end], last
            start = end

    def batches():
        held, size = [], 0
        for doc_id, text in rows:
            *before, final = _parts(text or "", batch)
            for part, last in [*((p, False) for p in before), (final, True)]:
                held.append((doc_id, part, last))
                size += len(part) + 64
                if size >= batch:
                    yield from run(held)
                    held, size = [], 0
        if held:
            yield from run(held)

    parts = []
    for doc_id, ids, last in batches():
        parts.append(ids)
        if last:
            yield doc_id, parts
            parts = []


# ------------------------------------------------------------------------- writing
_CHUNK = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("position", pa.int64()), ("n_ids", pa.int64()),
                    ("docs", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("data", pa.binary())])
_CHUNK_DDL = ("shard int, chunk int, position bigint, n_ids bigint, docs array<bigint>, lengths array<bigint>, "
              "data binary")


def _writer(model: str, end: np.ndarray, kind: str, block: int, chunk_ids: int, batch_size: int = BATCH):
    def run(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        state = {"chunk": 0, "position": 0}
        docs, lengths, parts, held = [], [], [], 0

        def flush():
            ids = np.concatenate(parts)
            row = [shard, state["chunk"], state["position"], len(ids), docs, lengths, pack_ids(ids, kind, block)]
            state["chunk"] += 1
            state["position"] += len(ids)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _CHUNK)], schema=_CHUNK)

        rows = ((doc_id, text) for batch in slices(batches)
                for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()))
        for doc_id, ids in encoded(model, rows, batch_size):
            docs.append(doc_id)
            lengths.append(sum(map(len, ids)) + 1)
            parts += [*ids, end]
            held += lengths[-1]
            if held >= chunk_ids:
                yield flush()
                docs, lengths, parts, held = [], [], [], 0
        if docs:
            yield flush()
    return run


def write_token_ids(docs: DataFrame, path: str, model: str, end_id: int, kind: str = "byte", block: int = BLOCK,
                    chunk_ids: int = CHUNK_IDS) -> None:
    """Encode ``docs`` (doc_id, text), each followed by ``end_id``, into the folder ``path``.

    ``model``: path of a tokenizer file, readable on every executor.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").select(
        "doc_id", "text", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("place"))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie"), F.col("place")]
    ordered = rows.repartitionByRange(buckets(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")
    (ordered.mapInArrow(_writer(model, np.array([end_id], "<u4"), kind, block, chunk_ids), _CHUNK_DDL)
     .write.option("compression", "none").parquet(f"{path}/chunks"))  # the planes are compressed
    chunks = spark.read.schema(_CHUNK_DDL).parquet(f"{path}/chunks")
    # one row per shard, that is per partition of the sort
    totals = sorted(chunks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect())
    starts = spark.createDataFrame(list(zip([t.shard for t in totals], accumulate((t.n for t in totals), initial=0))),
                                   "shard int, shard_start bigint")
    (chunks.join(F.broadcast(starts), "shard")
     .select("shard", "chunk", (F.col("shard_start") + F.col("position")).alias("start"), "n_ids",
             F.size("docs").alias("n_docs"), F.element_at("docs", 1).alias("first_doc"),
             F.element_at("docs", -1).alias("last_doc"), F.length("data").alias("n_bytes"))
     .write.parquet(f"{path}/index"))


# ------------------------------------------------------------------------- reading
def chunk_index(spark: SparkSession, path: str) -> DataFrame:
    """The chunk index: place among all ids, number of ids, documents and bytes of every chunk."""
    return spark.read.schema("shard int, chunk int, start bigint, n_ids bigint, n_docs int, first_doc bigint, "
                             "last_doc bigint, n_bytes int").parquet(f"{path}/index")


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks with the place of their first id; shard starts are as few as the sort's partitions."""
    starts = chunk_index(spark, path).groupBy("shard").agg(F.min("start").alias("shard_start"))
    return (spark.read.schema(_CHUNK_DDL).parquet(f"{path}/chunks").join(F.broadcast(starts), "shard")
            .withColumn("start", F.col("shard_start") + F.col("position")))


def _reader(with_ids: bool):
    def run(batches):
        for batch in slices(batches, 1):
            docs, lengths = batch.column("docs")[0].values, batch.column("lengths")[0].values
            raw = memoryview(unpack_ids(batch.column("data")[0].as_py()).tobytes())
            n = lengths.to_numpy()
            ends = np.cumsum(n)
            texts = [raw[4 * a:4 * b] for a, b in zip((ends - n).tolist(), ends.tolist())]
            last = (pa.array(list(map(bytes, texts)), pa.binary()) if with_ids
                    else pa.array(list(map(zlib.crc32, texts)), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [docs, pa.array(batch.column("start")[0].as_py() + ends - n), pa.array(n), last],
                names=["doc_id", "start", "n_tokens", "ids" if with_ids else "ids_crc32"])
    return run


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the ids (little-endian uint32) of every stored document."""
    return _chunks(spark, path).select("docs", "lengths", "start", "data").mapInArrow(
        _reader(True), "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def document_checksums(spark: SparkSession, path: str) -> DataFrame:
    """The same with the checksum of the ids, taken where they are decoded."""
    return _chunks(spark, path).select("docs", "lengths", "start", "data").mapInArrow(
        _reader(False), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """start and ids of the pieces of [first, last) among all ids, a row per chunk touched:
    the index says which chunks, and of these only the blocks concerned are decoded."""
    touched = chunk_index(spark, path).where((F.col("start") < last) & (F.col("start") + F.col("n_ids") > first))
    rows = (spark.read.schema(_CHUNK_DDL).parquet(f"{path}/chunks").select("shard", "chunk", "data")
            .join(touched.select("shard", "chunk", "start"), ["shard", "chunk"]))

    def run(batches):
        for batch in slices(batches, 1):
            start = batch.column("start")[0].as_py()
            ids = unpack_ids(batch.column("data")[0].as_py(), max(0, first - start), last - start)
            yield pa.RecordBatch.from_arrays([pa.array([max(first, start)], pa.int64()),
                                              pa.array([ids.tobytes()], pa.binary())], names=["start", "ids"])
    return rows.select("start", "data").mapInArrow(run, "start bigint, ids binary")
