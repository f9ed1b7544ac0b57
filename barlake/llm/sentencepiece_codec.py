"""SentencePiece BPE: exact encoding by backtracking, and decoding.

A word (spaces as the mark, then other characters) never merges with the next one, as no
piece has a mark after another character.  Within a word, an Aho-Corasick automaton over
the pieces gives every match; from each position the longest piece is tried first.  A
piece may follow another when merging their joined text anew by rank gives exactly the
two again; if no piece fits, the position is marked in a bitfield of failed positions and
the last piece is shortened.  Adjacent compatible pieces are the encoding that merging
the whole word by rank would give.  Characters outside the vocabulary become byte pieces.

Texts are taken in batches of bounded size.  Each distinct word of a batch is encoded
once, and its ids are decoded; a text's ids and its decoded form are put together from
those of its words.  Recent words and pair checks are kept per Python worker in tables of
a fixed size.  Texts pass whole, and there is no shuffle.

Defined results: a null text counts as empty (no ids, empty decoded text); repeated rows
are encoded row by row; no rows give no rows.  A very long text is a batch of its own.
Other columns are ignored, whatever their names.  A model with a piece that has a mark
after another character is refused: its words might merge.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import Recent

MARK = "▁"
WORDS, WORD_BYTES = 1_000_000, 64
PAIRS = 150_000
BATCH = 8 << 20
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Codec:
    """Encoder and decoder over the pieces and ranks of a model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        merged = [i for i in range(len(self.pieces))
                  if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.score = {self.pieces[i]: sp.get_score(i) for i in merged}
        self.byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.reserved = {i for i in range(len(self.pieces)) if sp.is_control(i) or sp.is_unknown(i)}
        if any(MARK in self.pieces[i].lstrip(MARK) for i in merged):
            raise ValueError("pieces with a mark after another character are not supported")
        self.ids = {}
        self.automaton = ahocorasick.Automaton()
        for i in merged:
            piece = self.pieces[i]
            if self.merge(piece) == [piece]:  # a piece that merging never reaches is never used
                self.ids[piece] = i
                self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        # the next shorter piece (or single character) that a piece starts with
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 0, -1) if n == 1 or p[:n] in self.ids), None)
                        for p in self.ids}
        self.pairs = Recent(lambda pair: self.merge(pair[0] + pair[1]) == list(pair), PAIRS, 2)

    def merge(self, text: str) -> list[str]:
        """Merge by rank, leftmost first, until no neighbours form a piece."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        return self.pairs[left, right]

    def longest(self, word: str) -> list[str] | None:
        """The longest matches end to end, if they cover the word and all fit together."""
        found = [piece for _, piece in self.automaton.iter_long(word)]
        if "".join(found) != word:
            return None
        last = found[0]
        for piece in found[1:]:
            if not self.compatible(last, piece):
                return None
            last = piece
        return found

    def split(self, word: str) -> list[str]:
        """Pieces of one word."""
        if word in self.ids:
            return [word]
        found = self.longest(word)
        return self.backtrack(word) if found is None else found

    def backtrack(self, word: str) -> list[str]:
        best: dict[int, str] = {}
        for end, piece in self.automaton.iter(word):
            best[end + 1 - len(piece)] = piece  # ends ascend: the longest stays
        failed = bytearray(len(word) // 8 + 1)
        shorter, compatible = self.shorter.get, self.compatible
        stack: list[str] = []
        at, piece = 0, best.get(0, word[0])  # an unknown character stands alone
        while at < len(word):
            while piece is not None:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1 and (not stack or compatible(stack[-1], piece)):
                    break
                piece = shorter(piece)
            if piece is None:
                failed[at >> 3] |= 1 << (at & 7)
                last = stack.pop()
                at -= len(last)
                piece = shorter(last)
            else:
                stack.append(piece)
                at = end
                if at < len(word):
                    piece = best.get(at, word[at])
        return stack

    def word_ids(self, word: str) -> list[int]:
        out: list[int] = []
        for piece in self.split(word):
            i = self.ids.get(piece)
            if i is None:
                out += [self.byte_ids[b] for b in piece.encode("utf-8")]
            else:
                out.append(i)
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of some ids; the space of the dummy prefix goes."""
        text = self.plain(ids)
        return text[1:] if text.startswith(" ") else text

    def plain(self, ids: list[int]) -> str:
        out = bytearray()
        for i in ids:
            if (b := self.byte_of.get(i)) is not None:
                out.append(b)
            elif i not in self.reserved:
                out += self.pieces[i].replace(MARK, " ").encode("utf-8")
        return out.decode("utf-8", "replace")


class Words:
    """Ids of recent words, as comma-joined text, and what these ids decode to.

    A word's key lacks its mark where a single space stands before it."""

    def __init__(self, codec: Codec):
        self.codec = codec
        self.keys, self.ids, self.plain = (pa.array([], pa.binary()) for _ in range(3))

    def places(self, words: pa.Array) -> pa.Array:
        """Numbers of distinct words in the table, to which new ones are added."""
        at = pc.index_in(words, value_set=self.keys)
        new = words.filter(at.is_null())
        ids, plain = [], []
        for key in new.to_pylist():
            word = key.decode("utf-8")
            found = self.codec.word_ids(word if word.startswith(MARK) else MARK + word)
            ids.append(",".join(map(str, found)).encode("ascii"))
            plain.append(self.codec.plain(found).encode("utf-8"))
        place = at.to_numpy(zero_copy_only=False).astype(np.float64)
        place[np.isnan(place)] = len(self.keys) + np.arange(len(new))
        self.keys = pa.concat_arrays([self.keys, new])
        self.ids = pa.concat_arrays([self.ids, pa.array(ids, pa.binary())])
        self.plain = pa.concat_arrays([self.plain, pa.array(plain, pa.binary())])
        return pa.array(place.astype(np.int32))

    def forget(self, used: pa.Array) -> None:
        """Beyond the table's size, keep the words used last, but for very long ones."""
        if len(self.keys) <= WORDS and self.ids.nbytes <= WORDS * WORD_BYTES:
            return
        keep = used.filter(pc.less_equal(pc.binary_length(self.keys.take(used)), WORD_BYTES))
        self.keys, self.ids, self.plain = (x.take(keep) for x in (self.keys, self.ids, self.plain))

    def round_trip(self, words: pa.ListArray) -> tuple[pa.Array, pa.Array]:
        """Comma-joined ids of each text, given as its words, and the text decoded from them."""
        coded = words.flatten().dictionary_encode()
        used = self.places(coded.dictionary)
        code = used.take(coded.indices)
        joined = [pc.binary_join(pa.ListArray.from_arrays(words.offsets, x.take(code)), pa.scalar(by, pa.binary()))
                  for x, by in ((self.ids, b","), (self.plain, b""))]
        self.forget(used)
        return joined[0], joined[1]


def words_of(texts: pa.Array) -> pa.ListArray:
    """The words of texts (binary); a word keeps its mark unless one space stands before it."""
    odd = pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, MARK))
    for edge in (pc.starts_with, pc.ends_with):
        odd = pc.or_(odd, edge(texts, " "))
    odd = pc.or_(odd, pc.equal(pc.binary_length(texts), 0)).to_numpy(zero_copy_only=False)
    if not odd.any():
        return pc.split_pattern(texts, " ")
    plain = pc.split_pattern(texts.filter(pa.array(~odd)), " ")
    other = [_WORD.findall(MARK + t.decode("utf-8").replace(" ", MARK)) if t else []
             for t in texts.filter(pa.array(odd)).to_pylist()]
    other = pa.array([[w.encode("utf-8") for w in t] for t in other], pa.list_(pa.binary()))
    place = np.empty(len(texts), np.int64)
    place[~odd] = np.arange((~odd).sum())
    place[odd] = len(plain) + np.arange(odd.sum())
    return pa.concat_arrays([plain, other]).take(pa.array(place))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    return Words(codec(path))


def _bounded(batches, size: int):
    """Arrow batches in parts of about ``size`` bytes of text, one row at least."""
    for batch in batches:
        text = batch.column("text").cast(pa.binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy().astype(np.int64) + 64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.column("doc_id").slice(at, to - at), pc.fill_null(text.slice(at, to - at), b"")
            at = to
    pa.default_memory_pool().release_unused()


def _sha256(texts) -> pa.Array:
    return pa.array([hashlib.sha256(t.as_buffer() or b"").hexdigest() for t in texts], pa.string())


def _round_trip(path: str, keep_ids: bool):
    def run(batches):
        table = words(path)
        for doc_id, texts in _bounded(batches, BATCH):
            joined, decoded = table.round_trip(words_of(texts))
            # the space of the dummy prefix goes
            decoded = pc.binary_replace_slice(decoded, 0, 1, b"")
            n = pc.add(pc.count_substring(joined, ","), pc.cast(pc.greater(pc.binary_length(joined), 0), pa.int32()))
            cols = [doc_id, n.cast(pa.int64()), _sha256(joined), _sha256(decoded)]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                cols.append(pa.array([[int(i) for i in t.split(b",")] if t else [] for t in joined.to_pylist()],
                                     pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def encode_decode(docs: DataFrame, model: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids) of every row of ``docs``."""
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _round_trip(model, keep_ids), schema + (", ids array<int>" if keep_ids else ""))
