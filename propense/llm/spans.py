"""Spans found in texts by patterns, as rows, with built-in functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters before a match that are kept as its context.
CONTEXT = 40
ROW = ["doc_id", "_text"]


@dataclass(frozen=True)
class Pattern:
    """What a kind looks like; ``needs`` is a string no match is without; ``group`` is kept as ``value``."""

    kind: str
    regex: str
    needs: str = ""
    group: int = 0


def _located(kind: str, matches: str, gaps: str, values: str) -> Column:
    """Structs of the matches with what lies before each of them."""
    return F.transform(
        matches,
        lambda m, k: F.struct(
            F.lit(kind).alias("kind"),
            k.alias("k"),
            (F.length(F.get(gaps, k)) + F.length(m)).alias("step"),
            m.alias("whole"),
            F.get(values, k).alias("value"),
            F.right(F.get(gaps, k), F.lit(CONTEXT)).alias("left"),
        ),
    )


def find(docs: DataFrame, patterns: list[Pattern], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All matches, leftmost and not overlapping within a kind, and a row without kind for every document.

    Columns: doc_id, _text (a hash that tells rows apart that repeat an id), kind, start, end (code points,
    end exclusive), whole (the match), value (its group) and left (up to 40 characters before it, back to
    the match before). Null texts count as empty; repeated rows are one row. Positions are running sums of
    lengths over the pieces that a split by the pattern leaves, so a text with very many matches stays
    linear.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("_text", F.xxhash64("text"))
    none = F.array().cast("array<string>")
    for i, p in enumerate(patterns):
        there = F.contains("text", F.lit(p.needs)) if p.needs else F.lit(True)
        rows = rows.withColumn(f"m{i}", F.when(there, F.regexp_extract_all("text", F.lit(p.regex), F.lit(0))).otherwise(none))
    parts = []
    for i, p in enumerate(patterns):
        found = F.size(f"m{i}") > 0
        rows = rows.withColumn(f"g{i}", F.when(found, F.split("text", p.regex, -1)).otherwise(none))
        value = f"m{i}"
        if p.group:
            value = f"v{i}"
            rows = rows.withColumn(
                value, F.when(found, F.regexp_extract_all("text", F.lit(p.regex), F.lit(p.group))).otherwise(none)
            )
        parts.append(_located(p.kind, f"m{i}", f"g{i}", value))
    kinds = "array<struct<kind:string,k:int,step:int,whole:string,value:string,left:string>>"
    itself = F.array(F.struct(*(F.lit(None).alias(c) for c in ("kind", "k", "step", "whole", "value", "left")))).cast(kinds)
    rows = rows.select("doc_id", "_text", F.explode(F.concat(itself, *parts)).alias("m")).select(*ROW, "m.*")
    # one exchange serves all that follows here; repeated rows would be counted twice in the sums
    rows = rows.repartition(*ROW).distinct()
    running = Window.partitionBy(*ROW, "kind").orderBy("k")
    end = F.sum("step").over(running)
    return (
        rows.withColumn("end", end)
        .withColumn("start", F.col("end") - F.length("whole"))
        .select(*ROW, "kind", "start", "end", "whole", "value", "left")
    )


def rank_of(kinds: list[str]) -> Column:
    return F.array_position(F.array(*map(F.lit, kinds)), F.col("kind"))


def per_document(spans: DataFrame, base: list[str], more: list[str]) -> DataFrame:
    """A row per document: counts n_<kind> of the base kinds, base_sha256 and the joined spans.

    ``spans`` has doc_id, _text, kind (null: nothing but the document), start and end. Spans are written
    kind:start:end, by start, then kind in the order given, then end.
    """
    item = F.struct("start", rank_of(base + more).alias("rank"), "end", "kind")
    listed = spans.groupBy(*ROW).agg(
        *(F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in base),
        F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull(), item))).alias("all"),
    )

    def joined(items: Column) -> Column:
        return F.array_join(F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base_items = F.filter("all", lambda s: s["rank"] <= len(base))
    return listed.select(
        "doc_id",
        *(f"n_{k}" for k in base),
        F.sha2(joined(base_items), 256).alias("base_sha256"),
        joined(F.col("all")).alias("spans"),
    )
