"""Fill-in-the-middle transformation by one counted regular expression a row.

A text is a row of units: runs of A-Z and a-z, and single other characters.
``regexp_count`` gives their number n. Two numbers drawn from the id cut the
text after a and b units (a <= b), by a pattern made for the row:

    \\A((?:unit){a}+)((?:unit){b-a}+)(.*)\\z

Its groups are prefix, middle and suffix, and the replacement text puts them
in the order of the row's form, so that one match makes the output. The
counted groups are possessive: the units of a text are cut in one way only,
so nothing is lost by never going back, and the matcher repeats a
possessive group in a loop, where a greedy one calls itself once a unit and
ends the thread's stack on long texts.

Everything is an expression over one row: no shuffle, no state, and a lost
executor's rows are computed anew with the same result.

Defined results: null text is empty; an empty text, or one that holds a
marker, stays as it is (``plain``), with null lengths; a null id counts as
the empty string; equal rows get equal results; other columns of the
documents are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "[A-Za-z]++|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKER = "<[PSM]>"
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100


def draws(doc_id: Column, count: int, seed: int = 1) -> list[Column]:
    """The first 8-digit groups of the hex sha256 of ``seed:id``, as
    unsigned integers."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(count)]


def pattern(first: Column, second: Column) -> Column:
    """The row's pattern: ``first`` units, ``second`` units, the rest."""
    return F.format_string(rf"(?s)\A((?:{UNIT}){{%d}}+)((?:{UNIT}){{%d}}+)(.*)\z", first, second)


def fill_middle(documents: DataFrame, seed: int = 1) -> DataFrame:
    """Per document: doc_id, n, form (plain, psm, spm), output."""
    h = draws(F.col("doc_id"), 4, seed)
    cut = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("body")
    ).select(
        "doc_id", "body", F.regexp_count("body", F.lit(UNIT)).cast("bigint").alias("n"),
        *(x.alias(f"h{k}") for k, x in enumerate(h, 1)),
    ).select(
        "doc_id", "body", "n",
        F.least(F.expr("h1 % (n + 1)"), F.expr("h2 % (n + 1)")).alias("a"),
        F.greatest(F.expr("h1 % (n + 1)"), F.expr("h2 % (n + 1)")).alias("b"),
        F.when((F.col("n") == 0) | F.expr(f"body rlike '{MARKER}'") | (F.col("h3") % 100 >= PLAIN_FROM), "plain")
        .when(F.col("h4") % 100 < SPM_BELOW, "spm").otherwise("psm").alias("form"),
    )
    order = F.when(F.col("form") == "spm", f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    moved = F.regexp_replace("body", pattern(F.col("a"), F.col("b") - F.col("a")), order)
    return cut.select(
        "doc_id", "n", "form", F.when(F.col("form") == "plain", F.col("body")).otherwise(moved).alias("output")
    )


def with_pieces(moved: DataFrame) -> DataFrame:
    """``moved`` with prefix, middle and suffix, cut out of the output again;
    null for plain. No text with a marker is rearranged, and a marker cannot
    arise where a text meets one, so the three markers of an output are its
    own."""
    spm = F.col("form") == "spm"
    part = F.when(F.col("form") != "plain", F.split("output", MARKER, -1))
    return moved.withColumn("_part", part).select(
        *moved.columns,
        F.when(spm, F.col("_part")[2]).otherwise(F.col("_part")[1]).alias("prefix"),
        F.col("_part")[3].alias("middle"),
        F.when(spm, F.col("_part")[1]).otherwise(F.col("_part")[2]).alias("suffix"),
    )


def restored(moved: DataFrame) -> DataFrame:
    """``with_pieces``, and the text that an output was made of."""
    text = F.when(F.col("form") == "plain", F.col("output")).otherwise(F.concat("prefix", "middle", "suffix"))
    return with_pieces(moved).withColumn("restored", text)


def digest(moved: DataFrame) -> DataFrame:
    """Lengths and hashes instead of the output."""
    return restored(moved).select(
        "doc_id", "n", "form",
        F.char_length("prefix").cast("bigint").alias("prefix_chars"),
        F.char_length("middle").cast("bigint").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"),
    )
