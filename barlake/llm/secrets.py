"""Secret scans with corpus-wide ownership frequency.

Base kinds (assign, access, hex) are found by their patterns.  A fourth kind, opaque, are
long mixed tokens that no base match covers; on their own they are too common to report.
Hashes of all candidate values are aggregated over the corpus, first per (hash, owner,
repository), then per (hash, owner), then per hash, so that a value copied a million times
is combined before each shuffle.  A value of a single owner, in however many of its
repositories, is ``live``; one that several owners share is a ``copied`` example: each
value is exactly one of the two.  Opaque candidates count as findings only when live.

Positions are code points, end exclusive.  They come from the gaps between matches, summed
in two levels of ``BLOCK``; overlaps are looked for by the same blocks, so that a text with
very many matches costs a block, not all matches, for each.

Defined results: a null text counts as empty; a null owner is one owner of its own; rows
with equal ids are scanned one by one; the digest of no spans is that of the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import written

# Kind, pattern, group that holds the value, least length of that group.
KINDS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
    ("opaque", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+={0,2}", 0, 20),
)
# Patterns that a text must contain for a kind to be looked for in it.
GUARDS = {"assign": r"(?i:password|passwd|secret|token|api_?key)", "access": "AKIA",
          "hex": "[0-9a-f]{32}", "opaque": "[A-Za-z0-9+/_-]{20}"}
BASE = 3
BLOCK = 256
LEAST_DISTINCT = 10  # characters of a live-looking opaque value
COPIED_OWNERS = 2


def _summed(values: Column) -> Column:
    """Running sums of an array of longs."""
    zero = F.lit(0).cast("bigint")
    none = F.array().cast("array<bigint>")

    def run(v: Column) -> Column:
        return F.aggregate(
            v, F.struct(zero.alias("t"), none.alias("a")),
            lambda s, x: F.struct((s["t"] + x).alias("t"), F.concat(s["a"], F.array(s["t"] + x)).alias("a")),
            lambda s: s["a"])

    blocks = F.transform(F.sequence(zero, F.floor((F.size(values) - 1) / BLOCK).cast("bigint")),
                         lambda b: run(F.slice(values, (b * BLOCK + 1).cast("int"), F.lit(BLOCK))))
    # running sum over the last entries of the blocks, then added within each block
    whole = F.aggregate(
        blocks, F.struct(zero.alias("t"), F.array().cast("array<array<bigint>>").alias("a")),
        lambda s, b: F.struct((s["t"] + F.element_at(b, -1)).alias("t"),
                              F.concat(s["a"], F.array(F.transform(b, lambda x: x + s["t"]))).alias("a")),
        lambda s: F.flatten(s["a"]))
    return F.when(F.size(values) > 0, whole).otherwise(none)


def _spans(rows: DataFrame, number: int, kind: str, pattern: str, group: int, least: int) -> DataFrame:
    """Adds the column ``kind``: array of (start, kind number, end, value)."""
    none = F.array().cast("array<string>")
    guard = F.col("text").rlike(GUARDS[kind])

    def guarded(c: Column) -> Column:
        return F.when(guard, c).otherwise(none)

    p = F.lit(pattern)
    rows = (rows.withColumn("found", guarded(F.regexp_extract_all("text", p, F.lit(0))))
            .withColumn("values", guarded(F.regexp_extract_all("text", p, F.lit(group))) if group else F.col("found"))
            .withColumn("gaps", F.when(F.size("found") > 0, F.split("text", pattern, -1)).otherwise(none))
            # the i-th match starts after the gaps up to it and the matches before it
            .withColumn("ends", _summed(F.zip_with(
                F.slice("gaps", 1, F.size("found")), "found",
                lambda g, f: (F.length(g) + F.length(f)).cast("bigint")))))
    made = F.zip_with(F.arrays_zip("found", "values"), "ends", lambda m, e: F.struct(
        (e - F.length(m["found"])).alias("start"), F.lit(number).alias("k"), e.alias("end"),
        m["values"].alias("value")))
    return rows.withColumn(kind, F.filter(made, lambda s: F.length(s["value"]) >= least)).drop(
        "found", "values", "gaps", "ends")


def _digest(spans: Column) -> Column:
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["k"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def candidates(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """uid, doc_id, owner, repository, base and opaque (arrays of start, k, end, hash)."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(owner.cast("string"), F.lit("\0")).alias("owner"),
                       F.coalesce(repository.cast("string"), F.lit("\0")).alias("repository"),
                       F.coalesce("text", F.lit("")).alias("text"))
    for number, spec in enumerate(KINDS):
        rows = _spans(rows, number, *spec)
    mixed = F.filter("opaque", lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]")
                     & (F.size(F.array_distinct(F.split(s["value"], ""))) >= LEAST_DISTINCT))
    base = F.array_sort(F.concat("assign", "access", "hex"))

    def block(b: Column) -> Column:
        spans = F.slice("base", (b * BLOCK + 1).cast("int"), F.lit(BLOCK))
        return F.struct(F.element_at(spans, 1)["start"].alias("low"),
                        F.array_max(F.transform(spans, lambda s: s["end"])).alias("high"), spans.alias("spans"))

    blocks = F.when(F.size("base") > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size("base") - 1) / BLOCK).cast("int")), block))

    def overlaps(o: Column) -> Column:
        return F.exists("blocks", lambda b: (b["low"] < o["end"]) & (o["start"] < b["high"]) & F.exists(
            b["spans"], lambda s: (s["start"] < o["end"]) & (o["start"] < s["end"])))

    def hashed(spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct("uid", s["start"].alias("start"), s["k"].alias("k"),
                                                     s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash")))
    rows = (rows.withColumn("base", base).withColumn("opaque", mixed).withColumn("blocks", F.when(F.size("opaque") > 0, blocks))
            .withColumn("opaque", F.filter("opaque", lambda o: ~F.coalesce(overlaps(o), F.lit(False)))))
    return rows.select("uid", "doc_id", "owner", "repository", hashed(F.col("base")).alias("base"),
                       hashed(F.col("opaque")).alias("opaque"))


def ownership(found: DataFrame) -> DataFrame:
    """hash, n_owners, n_repositories, n_found over rows (hash, owner, repository)."""
    return (found.groupBy("hash", "owner", "repository").agg(F.count("*").alias("n"))
            .groupBy("hash", "owner").agg(F.count("*").alias("r"), F.sum("n").alias("n"))
            .groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("r").alias("n_repositories"),
                                 F.sum("n").alias("n_found")))


def secret_scan(docs: DataFrame, owner: Column | None = None, repository: Column | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, n_opaque of
    every row of ``docs`` (doc_id, text); ``owner`` defaults to the column source and
    ``repository`` to source and lang."""
    owner = F.col("source") if owner is None else owner
    repository = F.concat_ws("/", "source", "lang") if repository is None else repository
    rows = written(candidates(docs, owner, repository), "secret-candidates")
    found = (rows.select("owner", "repository", F.explode(F.concat("base", "opaque")).alias("s"))
             .select("owner", "repository", "s.*"))
    known = ownership(found).withColumnRenamed("hash", "known")
    live = F.col("n_owners") < COPIED_OWNERS
    span = F.struct("start", "k", "end")
    per_row = (found.select("uid", "start", "k", "end", "hash")
               .join(known, F.col("hash") == F.col("known"))
               .groupBy("uid").agg(
                   F.count_if(live).alias("n_live"), F.count_if(F.col("n_owners") >= COPIED_OWNERS).alias("n_copied"),
                   F.collect_list(F.when(live & (F.col("k") == BASE), span)).alias("added"))
               .withColumnRenamed("uid", "of"))
    base = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["k"].alias("k"), s["end"].alias("end")))
    out = rows.join(per_row, F.col("uid") == F.col("of"), "left").withColumn("plain", base).withColumn(
        "whole", F.array_sort(F.concat("plain", F.coalesce("added", F.array().cast(
            "array<struct<start:bigint,k:int,end:bigint>>")))))

    def number(k: int) -> Column:
        return F.size(F.filter("plain", lambda s: s["k"] == k)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    return out.select(
        "doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.sha2(_digest(F.col("plain")), 256).alias("base_sha256"), _digest(F.col("whole")).alias("spans"),
        F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_copied", zero).alias("n_copied"),
        (F.size("whole") - F.size("plain")).cast("bigint").alias("n_opaque"))
