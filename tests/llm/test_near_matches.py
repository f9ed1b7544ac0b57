"""Proximity matches of the registered query against brute force."""

import hashlib
import random

import __spark_entry__ as entry
from barlake.llm import decontamination

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def near(docs, items, window=10, slop=3):
    """Windows whose first word stands at a place, and whose others occur within ``slop`` of theirs from there."""
    out = {}
    for k, text in docs:
        words, names = text.split(), set()
        for item, body in items:
            body = body.split()
            for i in range(max(1, len(body) - window + 1)):
                part = body[i:i + window]
                if any(all(w in words[max(0, s + j - slop):max(0, s + j + slop + 1)] for j, w in enumerate(part))
                       for s, first in enumerate(words) if first == part[0]):
                    names.add(str(item))
        out[k] = (len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest())
    return out


def test_near_matches_equal_brute_force(scratch, tmp_path):
    rng = random.Random(5)
    words = ITEM.split()
    docs = [(0, ITEM), (1, " ".join(words[:6] + ["so"] + words[6:])), (2, " ".join(words[:5] + words[6:])),
            (3, " ".join(words[:6] + ["x"] * 5 + words[6:])), (4, "alpha beta")]
    for i in range(5, 120):
        text = words * 2
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(text))
            text[at:at + rng.randint(0, 1)] = [rng.choice(words)] * rng.randint(0, 2)
        docs.append((i, " ".join(text[rng.randint(0, 8):])))
    items = [(1, ITEM), (2, " ".join(reversed(words))), (3, "beta gamma mu")]
    scratch.createDataFrame(docs, "doc_id bigint, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    scratch.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    df = entry.queries()["op8_decontamination"](scratch, str(tmp_path))
    rows = df.collect()
    assert {r.doc_id: (r.n_near, r.near_sha256) for r in rows} == near(docs, items)
    assert any(r.n_near and not r.n_hit for r in rows)


def test_near_matches_do_not_depend_on_other_documents(docs):
    """More documents change which word is the rarest, not what is near."""
    items = docs([]).sparkSession.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    words = ITEM.split()
    own = [(i, " ".join(words[:i] + ["x"] * 2 + words[i:])) for i in range(12)]
    alone = {r.doc_id: r.n_near for r in decontamination.decontamination(docs(own), items).collect()}
    for word in ("alpha", "zeta", "mu"):
        more = docs(own + [(100 + i, word) for i in range(30)])
        assert alone == {r.doc_id: r.n_near for r in decontamination.decontamination(more, items).collect() if r.doc_id < 100}
