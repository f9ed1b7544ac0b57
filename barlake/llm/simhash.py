"""SimHash near-duplicates through a byte-position inverted index.

Two 64-bit fingerprints that differ in at most d bits agree in at least 8 - d of their
8 bytes.  Lists of single positional bytes hold a 256th of all fingerprints each, so the
index is keyed by the least sets of positional bytes that reach this minimum (6 of 8 for
d = 2: 28 lists per distinct fingerprint).  Every linked pair meets in a list, and a list
is bounded by construction: its members differ only in the d open bytes (65,536 of them
for d = 2), whatever the input.  Within a list, pairs are found by probing the bit
patterns of up to d open bits, not by enumeration; shared positional bytes are tallied
per pair, pairs below the minimum go, and the bit distance is verified.  A list returns
a spanning forest of its links; components are then closed over all lists.

Copies share a fingerprint and are folded to one entry before the index.

Defined results: a null text has no words; no words give fingerprint 0; fewer words than
a shingle give one shingle.  A null doc_id takes part in linking but is never the id of a
component that has another one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import row_number, slices, written
from barlake.llm.components import components

SHINGLE = 3
DISTANCE = 2
SEED = 42
# Fixed value: lower-case A-Z.
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_PIECE = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.translate(_LOWER).split()  # bytes.split parts at \x20 and \x09-\x0D
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    first, last = (ends - size)[:n].tolist(), ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    bits = np.zeros(64, np.int64)
    for at in range(0, n, _PIECE):
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(first[at:at + _PIECE], last[at:at + _PIECE])], "<u8")
        bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > n, bitorder="little").tobytes(), "little")


def _fingerprints(shingle: int):
    def run(batches):
        for batch in slices(batches):
            found = [fingerprint(t or b"", shingle) for t in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("doc_id"),
                 pa.array(np.array(found, "<u8").view("<i8"), pa.int64())], names=["uid", "doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """uid, doc_id, fp (bits as a signed long) of every row of ``docs`` (doc_id, text)."""
    return docs.select(row_number(docs).alias("uid"),
                       F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _fingerprints(shingle), "uid bigint, doc_id bigint, fp bigint")


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member index reachable from each of n members over the links (a, b)."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, a, label[b])
        np.minimum.at(low, b, label[a])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def _list_links(distance: int):
    """Verified links within each list, as a spanning forest."""
    need = 8 - distance
    flips = {keep: np.array(
        [sum(1 << b for b in bits) for r in range(1, distance + 1)
         for bits in combinations([8 * p + i for p in range(8) if p not in keep for i in range(8)], r)], "<u8")
        for keep in combinations(range(8), need)}
    lists = list(flips)

    def links(which: int, members) -> tuple[list[int], list[int]]:
        fp = np.unique(np.asarray(members, "<i8").view("<u8"))
        left, right = [], []
        for flip in flips[lists[which]]:
            other = fp ^ flip
            at = np.minimum(np.searchsorted(fp, other), len(fp) - 1)
            i = np.flatnonzero((fp[at] == other) & (other > fp))
            left.append(i)
            right.append(at[i])
        a, b = np.concatenate(left), np.concatenate(right)
        if not len(a):
            return [], []
        x = fp[a] ^ fp[b]
        tally = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        bits = np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1)
        good = (tally >= need) & (bits <= distance)
        root = _forest(len(fp), a[good], b[good])
        own = np.flatnonzero(root != np.arange(len(fp)))
        signed = fp.view("<i8")
        return signed[own].tolist(), signed[root[own]].tolist()

    def run(batches):
        for batch in batches:
            src, dst = [], []
            for which, members in zip(batch.column("which").to_pylist(), batch.column("members")):
                a, b = links(which, members.values.to_numpy())
                src += a
                dst += b
            if src:
                yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())],
                                                 names=["src", "dst"])
    return run


def positional_index(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """which, key, members: the lists with two or more of the distinct fingerprints."""
    masks = [sum(0xFF << 8 * p for p in keep) for keep in combinations(range(8), 8 - distance)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*[F.struct(F.lit(i).cast("tinyint").alias("which"),
                              F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])
    posted = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.which", "k.key")
    return (posted.groupBy("which", "key").agg(F.collect_list("fp").alias("members"))
            .where(F.size("members") > 1))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """uid, doc_id, fp, component_id, first_uid per row of ``docs``.

    ``component_id`` is the smallest doc_id of the row's component, ``first_uid`` the
    row that holds it (the first such row), so keeping ``uid = first_uid`` keeps one row.
    """
    own = written(fingerprints(docs, shingle), "fingerprints")
    # smallest doc_id first, null ids last
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid"))
    distinct = written(own.groupBy("fp").agg(least.alias("least")), "distinct-fingerprints")
    links = positional_index(distinct.select("fp"), distance).mapInArrow(
        _list_links(distance), "src bigint, dst bigint")
    roots = components(written(links, "simhash-links"))
    grouped = (distinct.join(roots, distinct.fp == roots.node, "left")
               .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    first = grouped.groupBy("root").agg(F.min("least").alias("first"))
    of_fp = grouped.join(first, "root").select(
        "fp", F.col("first.doc_id").alias("component_id"), F.col("first.uid").alias("first_uid"))
    return own.join(of_fp, "fp").select("uid", "doc_id", "fp", "component_id", "first_uid")


def simhash(docs: DataFrame, **options) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id per row of ``docs``."""
    return near_duplicates(docs, **options).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
