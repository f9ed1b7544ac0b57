"""Repeats, near-duplicates, contamination, URL filters: against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from barlake.llm import components, decontamination, simhash, suffix_dedup, url_filters
from barlake.llm.common import written

ODD = [None, "", " ", "a", "x" * 70_000, "é😀 日本", " \x00 \x00"]


# ----------------------------------------------------------------- suffix dedup
def removed(rows, length):
    rows = [(k if k is not None else 2**63 - 1, (t or "").encode(), k) for k, t in rows]
    least = {}
    for k, b, _ in rows:
        for j in range(len(b) - length + 1):
            s = b[j:j + length]
            least[s] = min(least.get(s, k), k)
    out = []
    for k, b, doc_id in rows:
        gone = bytearray(len(b))
        for j in range(len(b) - length + 1):
            if least[b[j:j + length]] < k:
                gone[j:j + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((doc_id or -1, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df, length=50):
    return sorted((r.doc_id or -1, *tuple(r)[1:]) for r in suffix_dedup.suffix_dedup(df, length).collect())


def test_repeats_of_test_documents(small):
    assert found(small) == removed([(r.doc_id, r.text) for r in small.collect()], 50)


def test_repeats_edge_cases(docs):
    p = "The quick brown fox jumps over the lazy dog, and then it runs away from us."
    rows = list(enumerate([None, "", "a" * 49, "a" * 120, "b" + "a" * 60, p, "xx " + p + " yy", "\0" * 70, "\0" * 55 + "q",
                           p[:49], p[:50], p[5:] + p, "é" * 40], 1))
    rows += [(None, p), (6, p + "!"), (-5, "z " + p[10:70]), (40, "ab" * 60), (41, "ba" * 60)]
    df = docs(rows, 5)
    assert found(df) == removed(rows, 50)
    assert suffix_dedup.suffix_dedup(df.limit(0)).count() == 0


def test_pieces_of_a_long_text_and_chunks_agree(docs, monkeypatch):
    rnd = random.Random(3)
    base = "".join(rnd.choice("abcdef ") for _ in range(3000))
    texts = [base[:2000], base[1500:], "x" + base[700:900] + "y" + base[:300], base]
    whole = np.frombuffer("".join(texts).encode(), np.uint8)
    usable = np.ones(len(whole), bool)
    first, end, at, _ = suffix_dedup.minimizer_runs(whole, usable)
    # the runs cover every start once, and the minimizer lies in all strings of a run
    assert [j for a, b in zip(first, end) for j in range(a, b + 1)] == list(range(len(whole) - 49))
    assert ((end <= at) & (at + suffix_dedup.K <= first + 50)).all()


def test_loser_tree_merges_runs_with_their_prefixes():
    rnd = random.Random(1)

    def shared(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    for n in (1, 2, 3, 5, 8):
        texts = [sorted(bytes(rnd.choices(b"ab", k=rnd.randint(0, 6))) for _ in range(rnd.randint(0, 30))) for _ in range(n)]
        known = [[0] + [shared(a, b) for a, b in zip(t, t[1:])] if t else [] for t in texts]
        got = [(p, texts[r][i]) for p, r, i in suffix_dedup.merge(known, texts)]
        assert [t for _, t in got] == sorted(x for t in texts for x in t)
        assert all(p == shared(a, b) for (_, a), (p, b) in zip(got, got[1:]))


# ------------------------------------------------------------------- near-duplicates
def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def closure(fps, distance):
    keys = sorted(fps)
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= distance and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {k: find(k) for k in keys}


def test_simhash_components_match_brute_force(small, docs):
    df = docs([(i, t) for i, t in enumerate(ODD + ["A b C", "a B c", "a b", "the  cat\nsat on the mat"] * 3)])
    for frame in (small, df):
        fps = {r.doc_id: fingerprint(r.text) for r in frame.collect()}
        want = closure(fps, 2)
        got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash(frame).collect()}
        assert got == {k: (f"{fps[k]:016x}", want[k]) for k in fps}


def test_every_link_is_found_through_the_index(scratch):
    rnd = random.Random(2)
    seeds = [rnd.getrandbits(64) for _ in range(40)] + [0, 2**64 - 1, 2**63]
    fps = set(seeds)
    for s in seeds:
        fps |= {s ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for _ in range(5)} | {s ^ (7 << rnd.randrange(60))}
    signed = [int(np.array(f, np.uint64).view(np.int64)) for f in fps]
    frame = scratch.createDataFrame([(f,) for f in signed], "fp bigint")
    links = written(simhash.positional_index(frame).mapInArrow(simhash._list_links(2), "src bigint, dst bigint"), "t")
    root = {r.node: r.root for r in components.components(links).collect()}
    got = collections.defaultdict(set)
    for f in signed:
        got[root.get(f, f)].add(f & (2**64 - 1))
    want = collections.defaultdict(set)
    for f, r in closure({f: f for f in fps}, 2).items():
        want[r].add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_chains_and_stars(scratch):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (205, 200), (200, 205)]
    got = {r.node: r.root for r in components.components(scratch.createDataFrame(links, "src bigint, dst bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 140)}, 205: 200}
    assert components.components(scratch.createDataFrame([], "src bigint, dst bigint")).count() == 0


def test_null_ids_repeated_rows_and_one_keeper(docs):
    df = docs([(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (9, "q r s t"), (None, None)])
    rows = simhash.near_duplicates(df).collect()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r.first_uid].append(r)
    assert all(sum(r.uid == r.first_uid for r in g) == 1 for g in groups.values()) and len(groups) == 3
    assert {r.component_id for r in rows if r.doc_id == 5} == {5}
    assert simhash.near_duplicates(df.limit(0)).count() == 0


# --------------------------------------------------------------- decontamination
def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def contaminated(rows, items):
    windows = collections.defaultdict(set)
    for item_id, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i:i + 10])] |= {str(item_id)} if item_id is not None else set()
    sizes = {len(w) for w in windows}
    out = []
    for k, text in rows:
        w, hit, names = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    names |= windows[tuple(w[i:i + n])]
        out.append((k or -1, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("block", [8 << 20, 2000])
def test_contamination_matches_brute_force(scratch, small, docs, block):
    bench = scratch.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = [(r.item_id, r.text) for r in bench.collect()]
    passage = next(t for _, t in items if len(words(t)) > 14)
    df = docs([(i, t) for i, t in enumerate(ODD + [f"x, {passage.upper()} y", passage, " ".join(passage.split()[2:13])])]
              + [(1, passage), (None, "so " + passage)])
    extra = scratch.createDataFrame([(10**6, "x"), (None, "é😀 日本"), (7, None), (8, ""), (3, "Xx so")], bench.schema)
    for frame, b in ((small, bench), (df, bench.unionByName(extra))):
        want = contaminated([(r.doc_id, r.text) for r in frame.collect()], [(r.item_id, r.text) for r in b.collect()])
        got = decontamination.decontamination(frame, b, block_bytes=block)
        assert sorted((r.doc_id or -1, *tuple(r)[1:6]) for r in got.collect()) == want
    assert decontamination.decontamination(df, bench.limit(0)).where("contaminated").count() == 0
    assert decontamination.decontamination(df.limit(0), bench).count() == 0


def test_proximity_matches(scratch, docs):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    bench = scratch.createDataFrame([(1, item)], "item_id bigint, text string")
    df = docs([(1, item), (2, item.replace("zeta", "zeta or so")), (3, item.replace("zeta", "zeta a b c d e")), (4, "alpha beta")])
    got = {r.doc_id: (r.n_items, r.n_near) for r in decontamination.decontamination(df, bench).collect()}
    assert got == {1: (1, 1), 2: (0, 1), 3: (0, 0), 4: (0, 0)}


# ------------------------------------------------------------------ URL filters
def judged(url, listed):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in re.match(r"[^/?#]*", rest)[0])
        path = re.match(r"[^/?#]*([^?#]*)", rest)[1]
    fit = [(len(h + p), h + p, v) for v, h, p in url_filters.RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule = max(fit) if fit else (0, None, None)
    name = re.sub(r"^(www|m)\.", "", host) + re.sub("/+$", "", re.sub(r"\.html$", "", path)) if host else None
    return host, path, rule[1], rule[2] or ("block" if name in listed else "allow"), name in listed


URLS = ["http://www.Bad.net/x.html?q", "https://bad.net/x/", "bad.net/x", None, "", "x://", "http://", "http://a.example.org",
        "HTTP://EXAMPLE.ORG/en/12", "http://notexample.org/en/1", "http://example.org/es/#f", "http://b.com/fr/x", "http://b.com/de/",
        "http://com/de/x", "ftp://é.org/ü?x://y", "http://bad.net?x", "http://good.net/x\ny"]


def test_url_verdicts_match_brute_force(scratch):
    pages = written(scratch.createDataFrame(list(enumerate(URLS + URLS[:3])), "page_id bigint, url string")
                    .withColumn("listed", F.lit(1)).withColumn("key", F.lit("k")), "pages")
    listed = scratch.createDataFrame([("http://m.bad.net/x",), ("http://bad.net",), (None,), ("junk",)], "url string")
    names = {"bad.net/x", "bad.net"}
    for blocks in (1, 4096):  # one block: many false hits, which the exact join removes
        got = {r.page_id: tuple(r)[1:] for r in url_filters.url_filter(pages, listed, blocks=blocks).collect()}
        assert got == {i: judged(u, names) for i, u in enumerate(URLS + URLS[:3])}
    assert url_filters.url_filter(pages, listed.limit(0)).where("listed").count() == 0
    assert url_filters.url_filter(pages.limit(0), listed).count() == 0


def test_bloom_filter_has_no_false_negatives_and_few_false_hits(scratch):
    urls = scratch.range(4000).select(F.concat(F.lit("h.net/"), "id").alias("listed_url"))
    table = url_filters.bloom_blocks(urls.where("id < 2000"), 512)
    assert table.count() <= 512
    block, *masks = url_filters._bloom_keys(F.col("listed_url"), 512)
    probe = urls.withColumn("bloom_block", block).join(table, "bloom_block", "left")
    hit = F.lit(True)
    for w, m in enumerate(masks):
        hit = hit & F.coalesce(F.col(f"bloom_w{w}").bitwiseAND(m) == m, F.lit(False))
    got = [r.hit for r in probe.orderBy(F.substring_index("listed_url", "/", -1).cast("int")).select(hit.alias("hit")).collect()]
    assert all(got[:2000]) and sum(got[2000:]) < 100
