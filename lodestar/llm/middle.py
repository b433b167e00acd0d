"""Fill-in-middle: texts cut into prefix, middle and suffix, and put in an order that ends with the middle.

A text of ``n`` units (code points) is cut by one regular expression made for its row: the first
group takes exactly ``a`` units, the second exactly ``b - a``, both possessively, so nothing is
ever tried twice, and the third takes the rest. The match is rewritten in the same step by a
replacement that names the groups in their new order. Everything is an SQL expression of the
row, so there is no shuffle, and a text is held by the one task that reads it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Signs for prefix, suffix and middle.
SIGNS = ("<P>", "<S>", "<M>")

#: Units are counted this many at a time first: counting lists its matches, so single ones would take many times the text.
BLOCK = 1024


def count_units(text: Column) -> Column:
    """Code points of a text, counted by regular expressions."""
    blocks = F.regexp_count(text, F.lit(f"(?s).{{{BLOCK}}}+"))
    rest = F.substring(text, blocks * BLOCK + 1, F.lit(BLOCK))
    return blocks.cast("long") * BLOCK + F.regexp_count(rest, F.lit("(?s)."))


def _quoted(sign: str) -> str:
    """A sign as a pattern: each character stands for itself."""
    return re.sub(r"([^\w])", r"\\\1", sign)


def _literal(sign: str) -> str:
    """A sign in a replacement."""
    return re.sub(r"([\\$])", r"\\\1", sign)


def arrange(text: Column, form: Column, prefix: Column, middle: Column, signs: tuple[str, str, str] = SIGNS) -> Column:
    """The text in the order of its form, cut after ``prefix`` and ``prefix + middle`` units by one match."""
    p, s, m = map(_literal, signs)
    pattern = F.concat(F.lit(r"(?s)\A(.{"), prefix.cast("string"), F.lit("}+)(.{"), middle.cast("string"), F.lit(r"}+)(.*+)\z"))
    order = F.when(form == "psm", F.lit(f"{p}$1{s}$3{m}$2")).otherwise(F.lit(f"{s}$3{p}$1{m}$2"))
    return F.when(form == "plain", text).otherwise(F.regexp_replace(text, pattern, order))


def restore(output: Column, form: Column, signs: tuple[str, str, str] = SIGNS) -> Column:
    """The text that ``arrange`` was given, from its output and form alone; texts that hold a sign must be plain."""
    p, s, m = map(_quoted, signs)
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z"), F.lit("$2$3$1"))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def fill_in_middle(
    docs: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20, signs: tuple[str, str, str] = SIGNS
) -> DataFrame:
    """Per row ``doc_id``, ``n`` (code points), ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    Draws h1 to h4 are the first four 32-bit numbers of the SHA-256 of ``seed:doc_id``; the cuts are h1 and
    h2 modulo n + 1, the smaller first. A text that is empty or holds a sign, and one with h3 % 100 of ``plain_from``
    or more, stays as it is (``plain``, its cuts are null); of the others those with h4 % 100 below ``spm_below``
    have suffix, prefix, middle (``spm``), the rest prefix, suffix, middle (``psm``). A null text counts as empty,
    a null id is written as the empty string in the draw. Rows that repeat an id have the same draws. Columns
    besides ``doc_id`` and ``text`` are ignored; an empty table gives an empty table.
    """
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))), 256)
    h = [F.conv(F.substring("draw", 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), draw.alias("draw"))
    rows = rows.select("doc_id", "text", "draw", count_units(F.col("text")).alias("n"))
    held = F.lit(False)
    for sign in signs:
        held = held | F.contains("text", F.lit(sign))
    plain = (F.col("n") == 0) | (h[2] % 100 >= plain_from) | held
    form = F.when(plain, F.lit("plain")).when(h[3] % 100 < spm_below, F.lit("spm")).otherwise(F.lit("psm"))
    rows = rows.select("doc_id", "text", "n", form.alias("form"), (h[0] % (F.col("n") + 1)).alias("x"), (h[1] % (F.col("n") + 1)).alias("y"))
    cuts = [F.when(F.col("form") != "plain", c) for c in (F.least("x", "y"), F.greatest("x", "y") - F.least("x", "y"))]
    rows = rows.select("doc_id", "text", "n", "form", cuts[0].alias("prefix_chars"), cuts[1].alias("middle_chars"))
    output = arrange(F.col("text"), F.col("form"), F.col("prefix_chars"), F.col("middle_chars"), signs)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", output.alias("output"))
