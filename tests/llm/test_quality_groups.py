"""Every language and source is judged by its own documents, however few."""

import math
import random

import numpy as np

from barlake.llm import common, quality_rules


def prose(rng, size):
    """60 words of about ``size`` letters."""
    return " ".join("".join(rng.choices("abcdefghij", k=size + rng.randint(-1, 1))) for _ in range(60))


def corpus(n):
    rng = random.Random(3)
    rows = [(i, prose(rng, (5, 9)[i % 2]), "de", ("short", "long")[i % 2]) for i in range(2 * n)]
    return [*rows, (-1, prose(rng, 5), "de", "long"), (-2, prose(rng, 9), "de", "long")]


def verdicts(docs, n):
    return {r.doc_id: r for r in quality_rules.quality_rules(docs(corpus(n))).collect()}


def test_a_small_source_has_its_own_estimate(docs):
    got = verdicts(docs, 100)
    assert not got[-1].kept and got[-2].kept
    assert sum(not got[i].kept for i in range(200)) <= 2


def test_distances_do_not_jump_with_the_number_of_rows(docs):
    a, b = verdicts(docs, 190)[-1].distance, verdicts(docs, 210)[-1].distance
    assert abs(a - b) < 0.1 * b


def test_the_weight_of_an_own_estimate_grows_without_a_step():
    p = quality_rules.P
    w = [quality_rules._weight(n) for n in range(1, 1000)]
    assert w[2 * p - 1] == 0 and w[-1] > 0.999 and w == sorted(w)
    assert max(y - x for x, y in zip(w, w[1:])) < 0.2


# ------------------------------------------------------------ brute force, one process
def solve(x, rows):
    p, unit = quality_rules.P, quality_rules.UNIT
    floor = np.square(list(quality_rules.STATISTICS.values()))
    mean, square = x.sum(axis=0) / len(x) / unit, x.T @ x / len(x) / unit ** 2
    cov = square - np.outer(mean, mean)
    cov = cov + np.diag(np.maximum(0, floor - np.diag(cov))) + 1e-9 * np.eye(p)
    return rows, mean, np.linalg.inv(cov), np.linalg.slogdet(cov)[1]


def distances(x, estimate):
    d = x / quality_rules.UNIT - estimate[1]
    return np.einsum("ni,ij,nj->n", d, estimate[2], d)


def chosen(x, estimate, support):
    """Rows of a concentration step, or of the reweighting, by distance bins."""
    bins = np.floor(16 * np.log2(1 + distances(x, estimate)))
    before = {b: (bins < b).sum() for b in set(bins)}
    if support is None:
        middle = max(b for b, n in before.items() if n <= len(x) / 2)
        scale = max(1.0, (2 ** ((middle + 0.5) / 16) - 1) / quality_rules.CHI2_MEDIAN)
        return x[2 ** (bins / 16) - 1 <= quality_rules.CHI2_975 * scale]
    return x[[before[b] < support * len(x) for b in bins]]


def determinants(groups):
    """Estimates of all groups: steps until the sum of the determinants' logarithms falls no more."""
    now = {}
    for g, x in groups.items():
        q = np.percentile(x, [25, 50, 75], axis=0) / quality_rules.UNIT
        var = np.maximum(np.square(list(quality_rules.STATISTICS.values())), np.square((q[2] - q[0]) / 1.349))
        now[g] = (len(x), q[1], np.diag(1 / var), np.log(var).sum())
    last = None
    while True:
        after = {g: solve(chosen(x, now[g], quality_rules.SUPPORT), len(x)) for g, x in groups.items()}
        total = sum(round(e[3], 3) for e in after.values())
        if last is not None and round(total, 3) >= last:
            return {g: solve(chosen(x, now[g], None), len(x)) for g, x in groups.items()}
        now, last = after, round(total, 3)


def brute_kept(rows):
    """uid -> (distance or None, kept) of statistics rows."""
    fit = [r for r in rows if not r.base_failed]
    levels = {}
    for r in fit:
        for g in ("*", ("pool", r.lang), ("own", r.lang, r.source)):
            levels.setdefault(g, []).append(list(r.x))
    if len(fit) < 2 * quality_rules.P:
        return {r.uid: (None, not r.base_failed) for r in rows}
    known = determinants({g: np.array(x, np.int64) for g, x in levels.items()})
    out = {}
    for r in rows:
        g = ("own", r.lang, r.source)
        if g not in known:
            out[r.uid] = (None, not r.base_failed)
            continue
        _, centre, inverse, _ = known["*"]
        cov = np.linalg.inv(inverse)
        for e in (known["pool", r.lang], known[g]):
            w = quality_rules._weight(e[0])
            centre, cov = w * e[1] + (1 - w) * centre, w * np.linalg.inv(e[2]) + (1 - w) * cov
        d2 = distances(np.array([r.x]), (0, centre, np.linalg.inv(cov)))[0]
        out[r.uid] = (float(np.sqrt(d2)), not r.base_failed and d2 <= quality_rules.CUTOFF)
    return out


def compare(docs):
    rows = quality_rules.statistics(docs).collect()
    got = {r.uid: r for r in quality_rules.judged(docs).collect()}
    want = brute_kept(rows)
    assert got.keys() == want.keys()
    for uid, (distance, kept) in want.items():
        assert got[uid].kept == kept and (got[uid].d2 is None) == (distance is None)
        assert distance is None or math.isclose(math.sqrt(got[uid].d2), distance, rel_tol=1e-6, abs_tol=1e-9)
    return want


def test_kept_equals_brute_force(docs, small):
    want = compare(common.numbered(small))
    assert 0 < sum(not kept for _, kept in want.values()) < len(want)
    rows = [*corpus(60), (None, None, None, None), (7, "", "de", None), (8, prose(random.Random(1), 6), None, "short")]
    compare(common.numbered(docs(rows)))
    compare(common.numbered(docs(rows[:9])))      # fewer than 2 * p in all: nothing is rejected
    compare(common.numbered(docs([])))


def test_many_groups_are_joined_by_a_shuffle(docs, monkeypatch):
    want = {k: (r.kept, r.distance) for k, r in verdicts(docs, 60).items()}
    monkeypatch.setattr(common, "BROADCAST_ROWS", 1)
    assert {k: (r.kept, r.distance) for k, r in verdicts(docs, 60).items()} == want
