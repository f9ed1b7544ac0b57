"""Surrogates for personal data: keyed, consistent in type, and distinct.

Found are e-mail addresses, IBANs, card numbers, phone numbers, IPv4 addresses, social
security numbers, names after a title, and the same names without it elsewhere in that
document.  Entities (kind, canonical form) are gathered from all documents; each gets a
replacement derived from a secret key by SHA-256:

* digits stay digits, letters letters of the same case, separators stay where they are;
* cards keep their first digit and their Luhn remainder, phones their first digit, IBANs
  their country with check digits that are right, e-mail addresses their top-level domain,
  IPv4 octets stay octets;
* names keep script (Latin, Cyrillic), capitals, hyphens and, for first names, the gender
  of the title (none after Dr. and the like).

Coreference: the same canonical form (case and separators aside) has one replacement in
all documents, and a surname the same with or without title and first name; each part of
a name with hyphens is a name of its own.  Distinctness, over all kinds: a replacement
that two entities share, or that is itself an entity of the corpus, is kept by none but
the first of them that already holds it; the others are derived anew with the next
attempt number, until no collision is left.  Replacements grow with the attempts (names
and addresses at once, numbers when several have failed), so that no space is ever full.

Only documents with a finding are stored, joined and rebuilt; all others pass untouched.

Defined results: a null text stays null without findings; repeated rows are handled one by
one and get the same replacements; an empty table stays empty; a very long text is one row
like any other, its mentions rows of their own.  Other columns stay, whatever their names,
but ``n_chars``, which is counted anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from barlake.llm.common import LOWER, UPPER, buckets, checked_broadcast, written

KEY = "example key: pass a secret one"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
# Titles by gender.
TITLES = {"m": ("Mr.", "Mr", "Herr", "Monsieur", "Señor", "Sr.", "Господин",
                "MR.", "HERR"),
          "f": ("Mrs.", "Mrs", "Ms.", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra.", "Госпожа",
                "MRS.", "MS.", "FRAU"),
          "": ("Dr.", "Dr", "Prof.", "Professor", "DR.", "PROF.")}
_TITLE = "|".join(t.replace(".", r"\.") for t in sorted(sum(TITLES.values(), ()), key=len, reverse=True))
# a word of a name (no genitive), and a name with hyphens
_WORD = r"\p{Lu}(?:\p{L}|['’](?=\p{Lu}\p{L}|\p{Ll}{2}))+"
_NAME = rf"{_WORD}(?:-{_WORD})*+"
# Kind and pattern, tried in this order.
KINDS = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}+"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    ("card", r"(?<![A-Za-z0-9])\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?![A-Za-z0-9])|(?<![A-Za-z0-9])\d{13,19}(?![A-Za-z0-9])"),
    ("phone", r"(?<![A-Za-z0-9+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,4}(?![A-Za-z0-9])"
              r"|(?<![A-Za-z0-9])(?:\(\d{3}\) ?|\d{3}[-.])\d{3}[-.]\d{4}(?![A-Za-z0-9])"),
    ("ip", rf"(?<![A-Za-z0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![A-Za-z0-9]|\.\d)"),
    ("ssn", r"(?<![A-Za-z0-9-])\d{3}-\d{2}-\d{4}(?![A-Za-z0-9-])"),
    ("name", rf"(?<![\p{{L}}\p{{N}}])(?:(?:{_TITLE}) )++{_NAME}(?: {_NAME})?(?![\p{{L}}\p{{N}}])"),
)
# the card's separator is the only group
PATTERN = "|".join(f"(?:{p})" for _, p in KINDS)
# in a document with a name: also every word that might be it
NAMED = KINDS[-1][1]
WIDE = rf"{PATTERN}|(?:(?<![\p{{L}}\p{{N}}]){_WORD}(?![\p{{L}}\p{{N}}]))"
FIRST = {g: f"first {g}".rstrip() for g in ("m", "f", "")}
NAME_KINDS = (*FIRST.values(), "surname")
# attempts after which a number grows by a digit with every second attempt
PATIENCE = 6
# Syllables and gendered endings of surrogate names by script.
SYLLABLES = {
    "latin": ("ba", "be", "da", "do", "fe", "ga", "ka", "la", "le", "lo", "ma", "mi", "na", "ne", "ra", "ri", "sa", "ta", "to", "va"),
    "cyrillic": ("ба", "ве", "га", "да", "ко", "ла", "ле", "ма", "ми", "на", "не", "ра", "ри", "са", "та", "то", "фа", "ша", "ни", "ва"),
}
ENDINGS = {("latin", "m"): ("n", "s", "no"), ("latin", "f"): ("ia", "na", "la"), ("latin", ""): ("n", "r", "tt"),
           ("cyrillic", "m"): ("н", "р", "л"), ("cyrillic", "f"): ("ня", "ла", "на"), ("cyrillic", ""): ("ко", "к", "дзе")}
_HEX = "0123456789abcdef"


def _byte(stream: Column, i: Column) -> Column:
    """The i-th byte of a hex stream, wrapping round."""
    at = (F.pmod(i * 2, F.length(stream)) + 1).cast("int")
    return (F.instr(F.lit(_HEX), F.substr(stream, at, F.lit(1))) - 1) * 16 + (
        F.instr(F.lit(_HEX), F.substr(stream, at + 1, F.lit(1))) - 1)


def _stream(key: str) -> Column:
    """256 keyed bytes of (kind, canonical, attempt)."""
    return F.concat(*[F.sha2(F.concat_ws("\0", F.lit(key), "kind", "canonical", F.col("attempt").cast("string"),
                                         F.lit(str(i))), 256) for i in range(8)])


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of an array of digits."""
    n = F.size(digits)
    doubled = F.transform(digits, lambda d, i: F.when((n - i) % 2 == 0, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10


def _mod97(text: Column) -> Column:
    """Remainder by 97 of the digits of a text, a letter standing for its two digits from 10."""
    def step(r: Column, c: Column) -> Column:
        letter = F.instr(F.lit(LOWER), c)
        return F.when(letter > 0, (r * 100 + letter + 9) % 97).otherwise((r * 10 + c.cast("int")) % 97)
    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _surrogate() -> Column:
    """Replacement of ``canonical`` by ``kind`` from ``stream``."""
    chars = F.split(F.col("canonical"), "")

    def keyed(c: Column, i: Column) -> Column:
        b = _byte(F.col("stream"), i)
        return (F.when(c.rlike("^[0-9]$"), F.substr(F.lit("0123456789"), b % 10 + 1, F.lit(1)))
                .when(c.rlike("^[a-z]$"), F.substr(F.lit(LOWER), b % 26 + 1, F.lit(1))).otherwise(c))

    plain = F.transform(chars, keyed)
    more = F.col("attempt").cast("int")

    def extra(n: Column, choices: str) -> Column:
        """n further characters of the stream, from its end."""
        return F.array_join(F.transform(F.sequence(F.lit(0), n), lambda i: F.when(i < n, F.substr(
            F.lit(choices), (_byte(F.col("stream"), F.lit(255) - i) % len(choices) + 1).cast("int"), F.lit(1))).otherwise("")), "")

    grown = extra(F.greatest(F.floor((more - PATIENCE) / 2), F.lit(0)).cast("int"), "0123456789")
    domain = F.regexp_extract("canonical", r"(\.[a-z]+)$", 1)
    email = F.concat(extra(F.floor(more / 2).cast("int"), LOWER),
                     F.array_join(F.slice(plain, F.lit(1), F.size(plain) - F.length(domain)), ""), domain)
    tail = F.array_join(F.slice(plain, F.lit(2), F.greatest(F.size(plain) - 1, F.lit(0))), "")
    first = F.concat(F.substr("canonical", F.lit(1), F.lit(1)), tail, grown)
    digits = F.transform(F.split(first, ""), lambda c: c.cast("int"))
    # the last digit moves by what the Luhn remainder lacks; at odd distance from the end it counts once
    lack = F.pmod(_luhn(F.transform(chars, lambda c: c.cast("int"))) - _luhn(digits), F.lit(10))
    card = F.concat(F.substr(first, F.lit(1), F.length(first) - 1),
                    F.pmod(F.element_at(digits, -1) + lack, F.lit(10)).cast("string"))
    country = F.substr("canonical", F.lit(1), F.lit(2))
    account = F.concat(F.array_join(F.slice(plain, F.lit(5), F.greatest(F.size(plain) - 4, F.lit(0))), ""), grown)
    iban = F.concat(country, F.lpad((F.lit(98) - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account)
    ip = F.concat_ws(".", *[(_byte(F.col("stream"), F.lit(i)) % 223 + 1 if i == 0 else _byte(F.col("stream"), F.lit(i)))
                            .cast("string") for i in range(4)])
    ip = F.when(grown != "", F.concat(ip, F.lit("."), grown)).otherwise(ip)

    def name(script: str, gender: str) -> Column:
        parts = F.array(*[F.lit(s) for s in SYLLABLES[script]])
        ends = F.array(*[F.lit(s) for s in ENDINGS[script, gender]])
        n = (F.lit(2) + F.floor(F.col("attempt") / 2)).cast("int")
        body = F.array_join(F.transform(F.sequence(F.lit(0), n), lambda i: F.element_at(
            parts, (_byte(F.col("stream"), i) % len(SYLLABLES[script]) + 1).cast("int"))), "")
        return F.concat(body, F.element_at(ends, (_byte(F.col("stream"), F.lit(99)) % 3 + 1).cast("int")))

    out = (F.when(F.col("kind") == "email", email).when(F.col("kind") == "card", card)
           .when(F.col("kind") == "phone", first).when(F.col("kind") == "iban", iban)
           .when(F.col("kind") == "ip", ip).when(F.col("kind") == "ssn", F.concat(F.array_join(plain, ""), grown)))
    for kind, gender in (*((k, g) for g, k in FIRST.items()), ("surname", "")):
        out = out.when((F.col("kind") == kind) & F.col("canonical").rlike(r"\p{IsCyrillic}"), name("cyrillic", gender))
        out = out.when(F.col("kind") == kind, name("latin", gender))
    return out


def _derive(entities: DataFrame, key: str) -> DataFrame:
    """Dealt anew: few bytes, but many hashes each."""
    return (entities.repartition(buckets(entities.sparkSession), "canonical")
            .withColumn("stream", _stream(key)).withColumn("surrogate", _surrogate())
            .select("kind", "canonical", "attempt", "surrogate"))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """kind, canonical, surrogate for the distinct (kind, canonical) of ``entities``."""
    known = written(entities.select("kind", "canonical").distinct(), "pii-entities")
    originals = known.select(F.col("canonical").alias("original")).distinct()
    now = written(_derive(known.withColumn("attempt", F.lit(0)), key)
                  .withColumn("settled", F.lit(False)), "pii-surrogates")
    while True:
        # one row per surrogate that is settled or first; few share one
        order = Window.partitionBy("surrogate").orderBy(F.desc("settled"), "canonical", "kind")
        checked = (now.withColumn("place", F.row_number().over(order))
                   .join(originals, F.col("surrogate") == F.col("original"), "left")
                   .withColumn("settled", F.col("settled") | ((F.col("place") == 1) & F.col("original").isNull()))
                   .select("kind", "canonical", "attempt", "surrogate", "settled"))
        now = written(checked, "pii-checked")
        if now.where(~F.col("settled")).isEmpty():
            return now.select("kind", "canonical", "surrogate")
        again = _derive(now.where(~F.col("settled")).withColumn("attempt", F.col("attempt") + 1), key)
        now = written(now.where("settled").unionByName(again.withColumn("settled", F.lit(False))), "pii-surrogates")


def _kind(mention: Column) -> Column:
    # a pattern's lookarounds hold at both ends of a mention
    kinds = [F.when(mention.rlike(f"^(?:{p})$"), F.lit(k)) for k, p in KINDS[:-1]]
    return F.coalesce(*kinds, F.lit("word"))


def _canonical(kind: Column, mention: Column) -> Column:
    lower = F.translate(mention, UPPER, LOWER)
    return (F.when(kind.isin("card", "phone", "iban", "ssn"), F.regexp_replace(lower, "[^a-z0-9]", ""))
            .when(kind.isin(*NAME_KINDS, "word"), F.lower(mention)).otherwise(lower))


def _poured(mention: Column, kind: Column, surrogate: Column) -> Column:
    """The replacement in the mention's own format: separators and case."""
    fill = F.split(F.regexp_replace(surrogate, "[^a-z0-9]", ""), "")
    made = F.aggregate(
        F.split(mention, ""), F.struct(F.lit(1).alias("i"), F.lit("").alias("s")),
        lambda a, c: F.when(c.rlike("^[A-Za-z0-9]$"), F.struct(
            (a["i"] + 1).alias("i"), F.concat(a["s"], F.when(c.rlike("^[A-Z]$"), F.upper(F.try_element_at(fill, a["i"])))
                                              .otherwise(F.try_element_at(fill, a["i"]))).alias("s")))
        .otherwise(F.struct(a["i"].alias("i"), F.concat(a["s"], c).alias("s"))), lambda a: a["s"])
    capitals = (F.upper(mention) == mention) & (F.lower(mention) != mention)
    longer = F.length(F.regexp_replace(mention, "[^A-Za-z0-9]", "")) < F.size(fill)
    rest = F.array_join(F.slice(fill, F.length(F.regexp_replace(mention, "[^A-Za-z0-9]", "")) + 1, F.size(fill)), "")
    return (F.when((kind == "ip") | (kind == "email") & longer, surrogate)
            .when(kind.isin(*NAME_KINDS), F.when(capitals, F.upper(surrogate)).otherwise(F.initcap(surrogate)))
            .when(longer, F.concat(made, rest)).otherwise(made))


def _mentions(gap: Column, mention: Column) -> Column:
    """(lead, kind, mention) of each part to replace: a name gives one for each word and
    each side of a hyphen."""
    def part(lead: Column, kind: Column, m: Column) -> Column:
        return F.struct(lead.alias("lead"), kind.alias("kind"), m.alias("mention"))

    title = F.regexp_extract(mention, rf"^(?:(?:{_TITLE}) )++", 0)
    last = F.element_at(F.split(F.rtrim(title), " "), -1)
    first = F.lit(FIRST[""])
    for gender in ("m", "f"):
        first = F.when(last.isin(*TITLES[gender]), F.lit(FIRST[gender])).otherwise(first)
    words = F.split(F.substr(mention, F.length(title) + 1, F.length(mention)), " ")

    def sides(word: Column, lead: Column, kind: Column) -> Column:
        return F.transform(F.split(word, "-"), lambda w, i: part(F.when(i == 0, lead).otherwise("-"), kind, w))

    lead, surname = F.concat(gap, title), F.lit("surname")
    names = F.when(F.size(words) == 2, F.concat(sides(F.element_at(words, 1), lead, first),
                                                sides(F.element_at(words, -1), F.lit(" "), surname))
                   ).otherwise(sides(F.element_at(words, -1), lead, surname))
    return F.when(title != "", names).otherwise(F.array(part(gap, _kind(mention), mention)))


def _resolved(mentions: DataFrame) -> DataFrame:
    """``mentions`` (row, at, kind, mention, canonical) where a bare word that is a name in its
    document has that name's kind, a surname's before a first name's, and no kind else."""
    names = (mentions.where(F.col("kind").isin(*NAME_KINDS))
             .groupBy(F.col("row").alias("nrow"), F.col("canonical").alias("name")).agg(F.max("kind").alias("as")))
    words = (mentions.where(F.col("kind") == "word")
             .join(names, (F.col("row") == F.col("nrow")) & (F.col("canonical") == F.col("name")), "left")
             .select("row", "at", F.col("as").alias("kind"), "mention", "canonical"))
    return mentions.where(F.col("kind") != "word").unionByName(words)


def surrogate_texts(docs: DataFrame, key: str = KEY, count: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced.  Other columns stay, ``n_chars`` is
    counted anew where a text changed.  ``count``: a further column with the number of
    replaced mentions; ``docs`` must not have one of that name."""
    columns = docs.columns
    if count in columns:
        raise ValueError(f"the documents have a column {count!r}")
    has = F.coalesce(F.col("text").rlike(PATTERN), F.lit(False))
    # stored once, with its own row numbers: only documents with a finding
    hits = docs.where(has).select(
        *[F.col(c).alias(f"d_{i}") for i, c in enumerate(columns)], F.monotonically_increasing_id().alias("row"),
        F.col("text").alias("body"), F.col("text").rlike(NAMED).alias("named"))

    def found(how) -> Column:
        return F.when(F.col("named"), how(WIDE)).otherwise(how(PATTERN))
    hits = hits.select("*", found(lambda p: F.split("body", p, -1)).alias("gaps"),
                       found(lambda p: F.regexp_extract_all("body", F.lit(p), F.lit(0))).alias("found"))
    parts = F.flatten(F.zip_with(F.slice("gaps", F.lit(1), F.size("found")), "found", _mentions))
    hits = written(hits.withColumn("parts", parts).withColumn("tail", F.element_at("gaps", -1))
                   .drop("gaps", "found", "body", "named"), "pii-documents")
    mentions = _resolved(hits.select("row", F.posexplode(F.transform("parts", lambda p: F.struct(
                    p["kind"].alias("kind"), p["mention"].alias("mention")))).alias("at", "p"))
                .select("row", "at", "p.*").withColumn("canonical", _canonical(F.col("kind"), F.col("mention"))))
    known = surrogates(mentions.where(F.col("kind").isNotNull()), key).select(
        F.col("kind").alias("skind"), F.col("canonical").alias("scanonical"), "surrogate")
    new = F.when(F.col("kind").isNull(), F.col("mention")).otherwise(
        _poured(F.col("mention"), F.col("kind"), F.col("surrogate")))
    replaced = (mentions.join(checked_broadcast(known),
                              (F.col("kind") == F.col("skind")) & (F.col("canonical") == F.col("scanonical")), "left")
                .select("row", "at", "kind", new.alias("new")).groupBy(F.col("row").alias("of"))
                .agg(F.sort_array(F.collect_list(F.struct("at", "new"))).alias("new"), F.count("kind").alias("n_replaced")))
    text = F.concat(F.array_join(F.zip_with("parts", "new", lambda p, n: F.concat(p["lead"], n["new"])), ""), "tail")
    made = hits.join(replaced, F.col("row") == F.col("of"))

    def column(i: int, c: str) -> Column:
        if c == "text":
            return text.alias(c)
        if c == "n_chars":
            return F.length(text).cast(docs.schema[c].dataType).alias(c)
        return F.col(f"d_{i}").alias(c)
    changed = made.select(*[column(i, c) for i, c in enumerate(columns)], *([F.col("n_replaced").alias(count)] if count else []))
    same = docs.where(~has)
    return (same.withColumn(count, F.lit(0).cast("bigint")) if count else same).unionByName(changed)


def pii(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, n_entities, text with surrogates, for every row of ``docs``."""
    return surrogate_texts(docs.select("doc_id", "text"), key, "n_entities").select("doc_id", "n_entities", "text")
