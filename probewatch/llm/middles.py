"""Fill-in-middle transformation: a text becomes its prefix, suffix and middle with marks between them.

A unit is a run of letters A-Z, a-z or any other single code point.  ``regexp_count``
counts the n units of a text; two numbers drawn from the document's id say how many units
the prefix and the middle take, and a pattern made for each row, with possessive counted
groups of so many units, captures prefix, middle and suffix in one match.  A possessive
group is matched by a loop without a stack, so the length of a text does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "[A-Za-z]+|[^A-Za-z]"
#: The same units, never given back.
KEPT_UNIT = "(?:[A-Za-z]++|[^A-Za-z])"
PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
#: Percent of the texts left plain, and of the others put with the suffix first.
PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 10, 20


def _draw(doc_id: Column, seed: int, k: int) -> Column:
    """The k-th 8-digit group of the id's hash as a number; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def _after(mark: str, column: str, start: Column | int) -> Column:
    """Place of the first ``mark`` at or behind ``start``, both from 1."""
    return F.call_function("locate", F.lit(mark), F.col(column), F.lit(start) if isinstance(start, int) else start)


def _cuts(output: str, form: str) -> dict[str, tuple[Column, Column]]:
    """First place and length of each part in an output that is not plain."""
    psm = F.col(form) == "psm"
    width = len(PREFIX)
    second = F.when(psm, _after(SUFFIX, output, width + 1)).otherwise(_after(PREFIX, output, width + 1))
    third = _after(MIDDLE, output, second + width)
    first_part = (F.lit(width + 1), second - width - 1)
    second_part = (second + width, third - second - width)
    pick = lambda a, b: tuple(F.when(psm, x).otherwise(y) for x, y in zip(a, b))
    return {"prefix": pick(first_part, second_part), "suffix": pick(second_part, first_part),
            "middle": (third + width, F.length(output) - third - width + 1)}


def restored(output: str = "output", form: str = "form") -> Column:
    """The exact text, from the output and its form alone."""
    cuts = _cuts(output, form)
    parts = [F.substring(F.col(output), *cuts[name]) for name in ("prefix", "middle", "suffix")]
    return F.when(F.col(form) == "plain", F.col(output)).otherwise(F.concat(*parts))


def transform(docs: DataFrame, seed: int = 1, plain_percent: int = PLAIN_PERCENT,
              suffix_first_percent: int = SUFFIX_FIRST_PERCENT) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    ``form`` is plain, psm (prefix, suffix, middle) or spm (suffix, prefix, middle).  Empty
    and null texts and texts that hold a mark stay plain, with null lengths.  Rows of one id
    share their draws; a null id draws like an empty one.  Repeated rows give repeated
    results, an empty table none; extra columns are ignored.
    """
    h = [_draw(F.col("doc_id"), seed, k) for k in range(4)]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    places = [h[k] % (F.col("n") + 1) for k in (0, 1)]
    marked = F.lit(False)
    for mark in MARKS:
        marked = marked | F.contains("text", F.lit(mark))
    plain = (F.col("text") == "") | marked | (h[2] % 100 >= 100 - plain_percent)
    rows = rows.select("*", F.least(*places).alias("a"), F.greatest(*places).alias("b"),
                       F.when(plain, "plain").when(h[3] % 100 < suffix_first_percent, "spm").otherwise("psm").alias("form"))
    counted = lambda n: F.concat(F.lit(f"({KEPT_UNIT}{{"), n.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit(r"(?s)\A"), counted(F.col("a")), counted(F.col("b") - F.col("a")), F.lit("(.*+)"))
    order = F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2").otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    rows = rows.select("doc_id", "n", "form", output.alias("output"))
    cuts = _cuts("output", "form")
    lengths = [F.when(F.col("form") != "plain", cuts[name][1].cast("long")).alias(f"{name}_chars") for name in ("prefix", "middle")]
    return rows.select("doc_id", "n", "form", *lengths, "output")


def digests(docs: DataFrame) -> DataFrame:
    """``transform`` with the hashes of the output and of the text rebuilt from it."""
    rows = transform(docs)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(), 256).alias("restored_sha256"))


#: The same rows in DuckDB's SQL, from a list of the units.
SQL = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents),
drawn AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM units),
cut AS (
  SELECT doc_id, text, n, u, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
