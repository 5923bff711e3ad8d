"""Lines that repeat across documents, with built-in functions only.

Lines are exploded, normalised (blanks at both ends off, A-Z in lower case) and named by 128 hash bits.
Per name the smallest and the largest document holding it are kept - a row a task before the shuffle,
however often a line is there - and with them whether it is in enough documents. The names that are go
to a table, are joined back to the lines (a skewed join, which Spark splits), and what a document has to
drop comes back to it as places. Texts move once, for that last join, and are put together by place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propense.llm.common import stored

MIN_DOCUMENTS, MIN_CHARS = 2, 10
#: What is stripped from a line, and the letters that are lowered.
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(line: Column) -> Column:
    """The key of a line. Lowering is the same in a line of ASCII only, and cheaper there."""
    key = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(key) == F.char_length(key)
    return F.when(ascii_only, F.lower(key)).otherwise(F.translate(key, UPPER, LOWER))


def _names(*columns: Column) -> list[Column]:
    """128 bits in two columns."""
    return [F.xxhash64(*columns), F.xxhash64(F.lit(11), *columns)]


def _lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """(id, row_1, row_2, place, line_1, line_2) of every line long enough."""
    lines = rows.select("id", "row_1", "row_2", F.posexplode(F.split("text", "\n", -1)).alias("place", "line"))
    lines = lines.withColumn("key", normalised(F.col("line"))).where(F.char_length("key") >= min_chars)
    first, second = _names(F.col("key"))
    return lines.select("id", "row_1", "row_2", "place", first.alias("line_1"), second.alias("line_2"))


def repeated(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(line_1, line_2, smallest) of the lines found in at least so many documents.

    A line is in two documents or more where its smallest and largest differ, so only larger thresholds
    count documents, those of the lines that are left. Rows that repeat an id are one document, rows
    without an id together are the last one.
    """
    names = ["line_1", "line_2"]
    ends = lines.groupBy(*names).agg(
        F.min("id").alias("smallest"), F.max("id").alias("largest"), F.bool_or(F.col("id").isNull()).alias("unnamed")
    )
    several = (F.col("smallest") != F.col("largest")) | (F.col("unnamed") & F.col("smallest").isNotNull())
    if min_documents < 2:
        return ends.select(*names, "smallest")
    ends = ends.where(several).select(*names, "smallest")
    if min_documents == 2:
        return ends
    ends = stored(ends, "line-ends")
    held = lines.join(ends.select(*names), names, "left_semi").select(*names, "id").distinct()
    enough = held.groupBy(*names).agg(F.count(F.lit(1)).alias("documents")).where(F.col("documents") >= min_documents)
    return ends.join(enough.select(*names), names, "left_semi")


def _without(text: Column, dropped: Column) -> Column:
    """``text`` without the lines at the places ``dropped``, in time linear in its lines."""
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
    # within the lambda both are values, not expressions that are computed for each place anew
    parts = F.array(F.struct(lines.alias("lines"), kept.alias("kept")))
    joined = F.transform(parts, lambda p: F.array_join(F.transform(p["kept"], lambda k: F.get(p["lines"], k)), "\n"))
    return F.get(joined, F.lit(0))


def drop_repeated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    min_chars: int = MIN_CHARS,
) -> DataFrame:
    """A row per row of ``docs``: its id, n_lines, n_dropped and kept (the text of the lines that stay).

    A line whose key has ``min_chars`` code points and is found in ``min_documents`` documents stays only in
    the one with the smallest id, there as often as it is. A null or empty text is one empty line. Rows that
    repeat an id belong to one document, so a line is not repeated by being in several of them; null ids are
    one document that comes after all others. Repeated rows are answered as often as they are there. Only
    the two named columns are read, so others cannot clash. An empty table gives none.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    first, second = _names(F.col("id"), F.col("text"))
    rows = rows.withColumns({"row_1": first, "row_2": second})
    lines = _lines(rows, min_chars)
    # as tables of their own, so that Spark knows their size and can split the joins where a key is hot
    again = stored(repeated(lines, min_documents), "repeated-lines")
    places = (
        lines.join(again, ["line_1", "line_2"])
        .where(~F.col("id").eqNullSafe(F.col("smallest")))
        .groupBy("row_1", "row_2")
        .agg(F.collect_set("place").alias("dropped"))
    )
    places = stored(places, "dropped-lines")
    n_lines = F.size(F.split("text", "\n", -1)).cast("long")
    kept = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col("dropped")))
    return rows.join(places, ["row_1", "row_2"], "left").select(
        F.col("id").alias(id_col),
        n_lines.alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        kept.alias("kept"),
    )
