"""Surrogates against a brute-force version over all rows, and the cases that are easy to get wrong."""

import hashlib
import re
import string

import pytest
import regex
from pyspark.sql import functions as F

from barlake.llm import pii
from barlake.llm.queries import op4_pii

SMOKE = "/root/testdata/sf0.001"
FIND, WIDE, NAMED = (regex.compile(p.replace("IsCyrillic", "Cyrillic")) for p in (pii.PATTERN, pii.WIDE, pii.NAMED))
KINDS = [(k, regex.compile(p)) for k, p in pii.KINDS[:-1]]
TITLE = regex.compile(rf"(?:(?:{pii._TITLE}) )++")


# ----------------------------------------------------------------------- brute force
def parts_of(mention):
    """[(text before, kind, word)] of a mention."""
    title = TITLE.match(mention)
    if not title:
        kind = next((k for k, p in KINDS if p.fullmatch(mention)), "word")
        return [("", kind, mention)]
    title = title.group()
    last = title.split()[-1]
    gender = next((g for g in ("m", "f") if last in pii.TITLES[g]), "")
    words = mention[len(title):].split(" ")
    out = []
    for i, word in enumerate(words):
        kind = pii.FIRST[gender] if len(words) == 2 and i == 0 else "surname"
        for j, side in enumerate(word.split("-")):
            out.append(("-" if j else " " if i else title, kind, side))
    return out


def canonical(kind, mention):
    if kind in ("card", "phone", "iban", "ssn"):
        return re.sub("[^a-z0-9]", "", mention.lower())
    return mention.lower()


def luhn(digits):
    n = len(digits)
    return sum((d * 2 - (9 if d > 4 else 0)) if (n - i) % 2 == 0 else d for i, d in enumerate(digits)) % 10


def derived(kind, c, attempt, key=pii.KEY):
    stream = b"".join(hashlib.sha256("\0".join([key, kind, c, str(attempt), str(i)]).encode()).digest() for i in range(8))
    plain = [string.digits[stream[i] % 10] if ch in string.digits else string.ascii_lowercase[stream[i] % 26]
             if ch in string.ascii_lowercase else ch for i, ch in enumerate(c)]
    extra = lambda n, chars: "".join(chars[stream[255 - i] % len(chars)] for i in range(n))
    grown = extra(max((attempt - pii.PATIENCE) // 2, 0), string.digits)
    if kind == "email":
        domain = re.search(r"(\.[a-z]+)$", c).group()
        return extra(attempt // 2, string.ascii_lowercase) + "".join(plain)[:len(c) - len(domain)] + domain
    first = c[0] + "".join(plain[1:]) + grown
    if kind == "phone":
        return first
    if kind == "card":
        digits = list(map(int, first))
        lack = (luhn(list(map(int, c))) - luhn(digits)) % 10
        return first[:-1] + str((digits[-1] + lack) % 10)
    if kind == "iban":
        account = "".join(plain[4:]) + grown
        number = "".join(str(int(x, 36)) for x in account + c[:2] + "00")
        return f"{c[:2]}{98 - int(number) % 97:02d}{account}"
    if kind == "ip":
        return ".".join(str(stream[i] % 223 + 1 if i == 0 else stream[i]) for i in range(4)) + ("." + grown if grown else "")
    if kind == "ssn":
        return "".join(plain) + grown
    script = "cyrillic" if regex.search(r"\p{Cyrillic}", c) else "latin"
    syllables, ends = pii.SYLLABLES[script], pii.ENDINGS[script, {"first m": "m", "first f": "f"}.get(kind, "")]
    return "".join(syllables[stream[i] % len(syllables)] for i in range(3 + attempt // 2)) + ends[stream[99] % 3]


def settle(entities):
    originals = {c for _, c in entities}
    now = {e: (0, derived(*e, 0), False) for e in entities}
    while not all(s for _, _, s in now.values()):
        by = {}
        for e, (_, made, done) in now.items():
            by.setdefault(made, []).append((not done, e[1], e[0]))
        for made, own in by.items():
            _, c, kind = min(own)
            if made not in originals:
                now[kind, c] = (*now[kind, c][:2], True)
        now = {e: (a, m, s) if s else (a + 1, derived(*e, a + 1), False) for e, (a, m, s) in now.items()}
    return {e: m for e, (_, m, _) in now.items()}


def poured(mention, kind, made):
    fill = re.sub("[^a-z0-9]", "", made)
    n = len(re.sub("[^A-Za-z0-9]", "", mention))
    if kind == "ip" or kind == "email" and n < len(fill):
        return made
    if kind in pii.NAME_KINDS:
        return made.upper() if mention.upper() == mention else made[:1].upper() + made[1:]
    chars = iter(fill)
    return "".join((next(chars).upper() if c in string.ascii_uppercase else next(chars)) if c in string.ascii_letters + string.digits
                   else c for c in mention) + fill[n:]


def brute(texts):
    """(n_entities, text) of every text."""
    cut, entities = [], set()
    for text in texts:
        if not text or not FIND.search(text):
            cut.append(None)
            continue
        pieces, at = [], 0
        for m in (WIDE if NAMED.search(text) else FIND).finditer(text):
            for i, (lead, kind, word) in enumerate(parts_of(m.group())):
                pieces.append([(text[at:m.start()] if i == 0 else "") + lead, kind, word])
            at = m.end()
        names = {}
        for _, kind, word in pieces:
            if kind in pii.NAME_KINDS:
                names[word.lower()] = max(kind, names.get(word.lower(), ""))
        for p in pieces:
            if p[1] == "word":
                p[1] = names.get(p[2].lower())
        entities |= {(k, canonical(k, w)) for _, k, w in pieces if k}
        cut.append((pieces, text[at:]))
    made = settle(entities)
    return [(0, text) if c is None else
            (sum(k is not None for _, k, _ in c[0]),
             "".join(lead + (w if k is None else poured(w, k, made[k, canonical(k, w)])) for lead, k, w in c[0]) + c[1])
            for text, c in zip(texts, cut)]


ODD = [None, "", "nothing", "Jo.Do@Mail3.Example.com jo.do@mail3.example.com +1 (017) 555-7713 192.168.1.10 DE89 3704 0044 0532 0130 00",
       "4111 1111 1111 1111 / 4111111111111111 / 123-45-6789 v1.2.3.4.5", "Mr. John Smith met John Smith; later Smith left. Smithy, Johns.",
       "Prof. Dr. Anna O'Neil-Weber and MR. SMITH; Ms Anna O’Neil's, Weber's and WEBER", "Dr Müller, Herr Müller, Frau Müller, Müllers",
       "Госпожа Анна Петрова. Петрова пришла, Анна.", "Mr. Mr. X", "Mrs. John John", "ask Mr. Anna-John Li-Na Wu", "Sr. Ñandú"]


def test_whole_table_against_brute_force(scratch):
    rows = scratch.read.parquet(f"{SMOKE}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r.doc_id: (r.n_entities, r.text) for r in op4_pii(scratch, SMOKE).collect()}
    want = brute([r.text for r in rows])
    assert [got[r.doc_id] for r in rows] == want and sum(n for n, _ in want) > 20


def test_odd_texts_against_brute_force(docs):
    texts = ODD * 2
    got = {r.doc_id: (r.n_entities, r.text) for r in pii.pii(docs([(i, t) for i, t in enumerate(texts)])).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts)


# ------------------------------------------------------------------------ single cases
def test_a_full_space_of_addresses_ends(docs):
    texts = [f"{a}@{b}.co" for a in string.ascii_lowercase for b in string.ascii_lowercase[:16]][:400]
    got = [r.text for r in pii.pii(docs([(i, t) for i, t in enumerate(texts)])).collect()]
    assert len(set(got)) == 400 and not set(got) & set(texts) and all(re.fullmatch(r"[a-z]+@[a-z]\.co", t) for t in got)
    assert sorted(got) == sorted(t for _, t in brute(texts))


def test_a_full_space_of_numbers_ends():
    made = settle({("ssn", f"{i:02d}") for i in range(100)})     # two digits only: all of them taken
    assert len(set(made.values())) == 100 and all(len(m) > 2 for m in made.values())


def one(docs, text):
    return pii.pii(docs([(1, text)])).first().text


def test_names_without_their_title_are_replaced(docs):
    out = one(docs, "Mr. John Smith met John Smith; later Smith left. John stayed in Smithfield.")
    j, s = re.match(r"Mr\. (\w+) (\w+) met", out).groups()
    assert out == f"Mr. {j} {s} met {j} {s}; later {s} left. {j} stayed in Smithfield." and {j, s}.isdisjoint({"John", "Smith"})


def test_titles_capitals_hyphens_and_apostrophes(docs):
    out = one(docs, "Dr. Smith-Jones, MR. SMITH, Prof. Dr. O'Neil and O'Neil's Jones")
    smith, jones, big, neil, again, last = re.fullmatch(
        r"Dr\. (\w+)-(\w+), MR\. (\w+), Prof\. Dr\. (\w+) and (\w+)'s (\w+)", out).groups()
    assert big == smith.upper() and neil == again and jones == last and len({smith, jones, neil}) == 3


def test_iban_check_digits_are_right(docs):
    for text in ("DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19"):
        out = one(docs, text).replace(" ", "")
        assert out[:2] == text[:2] and len(out) == len(text.replace(" ", "")) and out != text.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in out[4:] + out[:4])) % 97 == 1


def test_replacements_are_distinct_over_kinds():
    entities = {(kind, f"{a}{b}x") for kind in pii.NAME_KINDS for a in string.ascii_lowercase for b in string.ascii_lowercase}
    made = settle(entities)
    assert len(set(made.values())) == len(entities)


def test_columns_of_any_name(docs):
    df = docs([(1, "a@b.co"), (2, "x")]).withColumns({c: F.lit("u") for c in ("pii_entities", "kind", "row", "surrogate", "d_0", "named")})
    out = pii.surrogate_texts(df)
    assert out.columns == df.columns and out.where("pii_entities = 'u' and row = 'u' and named = 'u'").count() == 2
    with pytest.raises(ValueError):
        pii.surrogate_texts(df, count="row")
    assert pii.surrogate_texts(df, count="n").orderBy("doc_id").select("n").collect() == [(1,), (0,)]


def test_a_very_long_text(docs):
    out = pii.pii(docs([(1, "word Mr. Smith and Smith, mail a.b@c.org; " * 5000)])).first()
    assert out.n_entities == 15_000 and len(set(re.findall(r"Mr\. (\w+) and (\w+)", out.text))) == 1


def test_entities_are_derived_in_many_tasks(scratch):
    df = scratch.createDataFrame([("surname", f"n{i}", 0) for i in range(2000)], "kind string, canonical string, attempt int")
    assert pii._derive(df, "k").rdd.getNumPartitions() == int(scratch.conf.get("spark.sql.shuffle.partitions"))
