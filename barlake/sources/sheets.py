"""Landed fund sheets as CSV text, of any width, and the sheets that could not be read.

A sheet is one file of a fund: some lines of preamble, a header, the holdings.  Sheets
differ in their columns and their order, so a holding's cells are a map keyed by its own
sheet's header.  Cells and lines are cut with regard to quotes.  A sheet that cannot be
used is set aside with the reason instead of failing the others, and its fund counts as
not delivered (J10).  A sheet lists one fund and is read as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREAMBLE = 4
TICKER, NAME, WEIGHT = "Ticker", "Name", "Weight"
# A line: plain runs and quoted runs, up to its end.  A cell: quoted, or anything, up to a comma.
LINE = r'(?:[^"\n]++|"[^"]*+")*+(?:\n|$)'
CELL = r'[ \t]*+"[^"]*+(?:""[^"]*+)*+"[ \t]*+,|[^,]*+,'


def _fund(path: Column) -> Column:
    """Fund of a file: its folder ``etf=...``, else the last word of the file's name."""
    folder = F.regexp_extract(path, r"/etf=([^/]+)/", 1)
    return F.upper(F.when(folder != "", folder).otherwise(F.regexp_extract(path, r"([A-Za-z0-9]+)\.[^./]*$", 1)))


def cells(line: Column) -> Column:
    """The cells of a line, without blanks and quotes around them."""
    def clean(cell: Column) -> Column:
        cell = F.trim(F.regexp_replace(cell, r",$", ""))
        inner = F.regexp_replace(cell, r'^"|"$', "")
        return F.when(cell.startswith('"'), F.trim(F.replace(inner, F.lit('""'), F.lit('"')))).otherwise(cell)

    found = F.regexp_extract_all(F.concat(line, F.lit(",")), F.lit(CELL), F.lit(0))
    return F.transform(found, clean)


def read_sheets(spark: SparkSession, path: str, preamble: int = PREAMBLE, required: tuple[str, ...] = (TICKER,)) -> DataFrame:
    """file, etf, header, lines (below the header), reason (NULL: the sheet can be read)."""
    text = F.regexp_replace(F.regexp_replace("value", "^﻿", ""), "\r\n?", "\n")
    files = (spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
             .select(F.col("_metadata.file_path").alias("file"), text.alias("text")))
    quotes = F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit("")))
    lines = F.transform(F.regexp_extract_all("text", F.lit(LINE), F.lit(0)), lambda x: F.regexp_replace(x, "\n$", ""))
    cut = files.withColumn("odd", quotes % 2 == 1).withColumn("all", F.when(~F.col("odd"), lines))
    head = cut.select("file", _fund(F.col("file")).alias("etf"), "odd",
                      cells(F.try_element_at("all", F.lit(preamble + 1))).alias("header"),
                      F.slice("all", preamble + 2, F.greatest(F.size("all"), F.lit(0))).alias("lines"))
    reason = F.when(F.col("odd"), "unbalanced quote").when(F.col("header").isNull(), "no header")
    for name in required:
        reason = reason.when(~F.array_contains("header", name), f"no column {name}")
    return head.select("file", "etf", "header", "lines", reason.alias("reason"))


def sheet_rows(sheets: DataFrame) -> DataFrame:
    """etf, file, line, cells (column name -> text, NULL where blank) of the readable sheets."""
    # the first of columns with the same name counts; a column without a name does not
    named = F.filter(F.transform("header", lambda h, i: F.named_struct(F.lit("name"), h, F.lit("at"), i + 1)),
                     lambda c: (c.getField("name") != "") & (F.array_position("header", c.getField("name")) == c.getField("at")))
    rows = (sheets.where(F.col("reason").isNull())
            .select("etf", "file", named.alias("named"), F.posexplode("lines").alias("line", "text"))
            .where(F.trim("text") != "").withColumn("found", cells(F.col("text"))))

    def cell(c: Column) -> Column:
        return F.struct(c.getField("name").alias("key"),
                        F.nullif(F.try_element_at("found", c.getField("at")), F.lit("")).alias("value"))
    return rows.select("etf", "file", "line", F.map_from_entries(F.transform("named", cell)).alias("cells"))


def holdings(sheets: DataFrame) -> DataFrame:
    """Ticker, Name, Weight, etf, line of every holding; a column that a sheet lacks is NULL."""
    def of(name: str) -> Column:
        return F.try_element_at("cells", F.lit(name))
    return sheet_rows(sheets).select(of(TICKER).alias(TICKER), of(NAME).alias(NAME),
                                     of(WEIGHT).try_cast("double").alias(WEIGHT), "etf", "line")


def rejected(sheets: DataFrame) -> DataFrame:
    """Sheets set aside: file, etf, reason."""
    return sheets.where(F.col("reason").isNotNull()).select("file", "etf", "reason")


def delivered(sheets: DataFrame) -> DataFrame:
    """Funds with at least one readable sheet, be it without holdings."""
    return sheets.where(F.col("reason").isNull()).select("etf").distinct()
