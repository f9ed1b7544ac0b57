"""Token-id files: exact round trips, the library's ids, the index."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barlake.llm import token_files
from barlake.llm.common import Recent, fresh_path
from barlake.llm.queries import op13_token_files

SMOKE = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(MODEL)
    return lambda texts: [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def expected(rows, library):
    """doc_id, start, n_tokens, ids_crc32 of rows whose order is settled by doc_id."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    start, out = 0, []
    for (doc_id, _), ids in zip(rows, library([t or "" for _, t in rows])):
        ids = ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_table(scratch, library):
    rows = [(r.doc_id, r.text) for r in scratch.read.parquet(f"{SMOKE}/documents.parquet").collect()]
    got = sorted(map(tuple, op13_token_files(scratch, SMOKE).collect()), key=lambda r: (r[0] is None, r[0]))
    assert got == expected(rows, library)


ODD = ["", " ", "  two  spaces  ", "line\nbreak\tand\rmore\x0b\x0c", "\x1c\x1d\x1e\x1f\x85 x", "It's WE'LL 'Re 'sfoo ''s",
       "<|endoftext|>", "a<|startoftext|>b <|endoftext|><|endoftext|>", "<|nothing|>", "É é ́x İstanbul ΣΑΣ ΣΑΣ.",
       "数字123 한국어 ひらがな カタカナ が", "emoji 👍🏽 ‍ ​　x", "snake_case __x__ 1a2b ²½Ⅻ", "ǅ Ǆ ŉ ſ ß ẞ",
       "x" * 5000, "́", " nbsp ", "﻿bom", "ﬁ ｆｕｌｌ", "a­b"]


def test_pieces_give_the_librarys_ids(library):
    rng = random.Random(11)
    alphabet = "abcABC'ésßİΣσς019_-.<|>\n\t  ́가가数\x1c²Ⅻ"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(30))) for _ in range(4000)]
    # every character of the settled blocks, alone and between letters
    settled = [chr(c) for c in range(0x2100) if not token_files._STRANGE(chr(c))]
    texts += settled + [f"a{c}b{c.upper()}1{c}{c}" for c in settled]
    texts += ["".join(rng.choice(settled) for _ in range(12)) for _ in range(4000)]
    for batch in (1, 50, 10 ** 6):
        got = token_files.encoded(MODEL, ((i, t) for i, t in enumerate(texts)), batch)
        for (i, parts), ids in zip(got, library(texts), strict=True):
            assert np.concatenate(parts).tolist() == ids, repr(texts[i])


def test_a_full_table_forgets_and_stays_right(library, monkeypatch):
    monkeypatch.setattr(token_files, "PIECES", 50)
    monkeypatch.setattr(token_files, "PIECE_LENGTH", 6)
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(20)) for _ in range(300)]
    fresh = token_files.PieceEncoder(MODEL)
    for at in range(0, 300, 10):
        ids, ends = fresh.encode(texts[at:at + 10])
        want = library(texts[at:at + 10])
        assert ids.tolist() == sum(want, []) and ends.tolist() == list(np.cumsum([len(w) for w in want]))
    assert len(fresh.known) < 300


def test_all_settled_letters_are_single_pieces(library):
    import regex

    letters = [chr(c) for c in range(0x110000) if not 0xd800 <= c < 0xe000 and not token_files._STRANGE(chr(c))]
    strict, number = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
    for c in letters:
        low = c.lower()
        assert len(low) == 1 and not token_files._STRANGE(low) or c == "\u00df", hex(ord(c))
        assert bool(strict.match(c)) == bool(token_files.re.match(f"[{token_files.LETTERS}]", c)), hex(ord(c))
        assert bool(number.match(c)) == c.isdecimal(), hex(ord(c))


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_planes_round_trip(kind):
    rng = np.random.default_rng(0)
    for n, block in ((0, 8), (1, 8), (7, 8), (8, 8), (1000, 64), (70_000, 65_536)):
        ids = rng.integers(0, rng.choice([2, 49_408, 2 ** 32]), n).astype("<u4")
        data = token_files.pack_ids(ids, kind, block)
        assert (token_files.unpack_ids(data) == ids).all()
        for a, b in ((0, 1), (3, 9), (n // 2, n), (n, n + 5), (5, 5)):
            assert (token_files.unpack_ids(data, a, b) == ids[a:b]).all()
    assert token_files.unshuffled(token_files.shuffled(np.array([1, 2 ** 31], "<u4"), kind), 2, kind).tolist() == [1, 2 ** 31]


def test_unknown_data_is_refused():
    with pytest.raises(ValueError):
        token_files.unpack_ids(b"x" * 64)


@pytest.mark.parametrize("kind, block, chunk_ids", [("byte", 16, 40), ("bit", 8, 1), ("byte", 65_536, 1 << 20)])
def test_files_index_and_ranges(scratch, docs, library, kind, block, chunk_ids):
    rows = [(i * 3 + 1, t) for i, t in enumerate(ODD)] + [(0, None), (None, "no id"), (1000, "the end " * 50)]
    path = fresh_path(scratch, "test-token-files")
    token_files.write_token_ids(docs(rows), path, MODEL, 2, kind, block, chunk_ids)
    want = expected(rows, library)
    got = sorted(map(tuple, token_files.document_checksums(scratch, path).collect()), key=lambda r: r[1])
    assert got == want
    whole = token_files.read_documents(scratch, path).orderBy("start").collect()
    ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in whole])
    assert [(r.doc_id, r.start, r.n_tokens) for r in whole] == [w[:3] for w in want] and len(ids) == sum(w[2] for w in want)
    index = token_files.chunk_index(scratch, path).orderBy("start").collect()
    assert [r.start for r in index] == list(np.cumsum([0] + [r.n_ids for r in index])[:-1])
    assert sum(r.n_docs for r in index) == len(rows) and (index[0].first_doc, index[-1].last_doc) == (0, None)
    for a, b in ((0, len(ids)), (5, 6), (30, 300), (len(ids) - 3, len(ids) + 9), (7, 7)):
        pieces = token_files.read_range(scratch, path, a, b).orderBy("start").collect()
        assert np.concatenate([np.zeros(0, "<u4"), *(np.frombuffer(p.ids, "<u4") for p in pieces)]).tolist() == ids[a:b].tolist()


def test_repeated_ids_are_settled_whatever_the_partitions(scratch, docs):
    rows = [(7, t) for t in ODD] * 2 + [(8, "after")]
    found = []
    for parts in (1, 5):
        path = fresh_path(scratch, "test-token-files")
        token_files.write_token_ids(docs(rows, parts), path, MODEL, 2, chunk_ids=30)
        found.append(sorted(map(tuple, token_files.document_checksums(scratch, path).collect()), key=lambda r: r[1]))
    assert found[0] == found[1] and [r[0] for r in found[0]] == [7] * (2 * len(ODD)) + [8]


def test_empty_table_and_clashing_columns(scratch, docs, library):
    path = fresh_path(scratch, "test-token-files")
    token_files.write_token_ids(docs([]), path, MODEL, 2)
    assert token_files.document_checksums(scratch, path).count() == 0 == token_files.chunk_index(scratch, path).count()
    path = fresh_path(scratch, "test-token-files")
    more = docs([(1, "one"), (2, "two")]).withColumns({c: F.lit("x") for c in ("tie", "place", "shard", "data", "start")})
    token_files.write_token_ids(more, path, MODEL, 2)
    assert (sorted(map(tuple, token_files.document_checksums(scratch, path).collect()))
            == expected([(1, "one"), (2, "two")], library))


def test_very_long_text(scratch, docs, library):
    text = "word after word, and another 123 " * 60_000
    path = fresh_path(scratch, "test-token-files")
    token_files.write_token_ids(docs([(2, text), (1, "short")]), path, MODEL, 2)
    assert (sorted(map(tuple, token_files.document_checksums(scratch, path).collect()))
            == expected([(2, text), (1, "short")], library))


def test_recent_values_in_two_generations():
    calls = []
    table = Recent(lambda k: calls.append(k) or k * 2, 3, 4)
    assert [table[k] for k in ("a", "b", "c", "a", "d", "a", "longer")] == ["aa", "bb", "cc", "aa", "dd", "aa", "longerlonger"]
    assert calls == ["a", "b", "c", "d", "longer"] and len(table) + len(table.old) <= 6 and "longer" not in table
