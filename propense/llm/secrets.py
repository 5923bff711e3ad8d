"""Secrets in texts, and the weak parts of multipart credentials that complementary parts confirm.

Assignments, access identifiers and long hexadecimal runs are reported as they are. Three weak kinds are
not worth a report alone: ``client`` (an assigned identifier), ``key`` (a long mixed token) and
``endpoint`` (an address). An interval join links parts of one scope, a run of text without a blank line,
that lie within ``REACH`` characters: a client is reported beside a secret, a key beside an identifier,
an endpoint beside both. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propense.llm.common import stored
from propense.llm.spans import ROW, Pattern, find, per_document

BASE = ["assign", "access", "hex"]
WEAK = ["client", "key", "endpoint"]
REACH = 200
#: A part's role in a credential.
ROLES = {
    "access": "identifier",
    "client": "identifier",
    "assign": "secret",
    "hex": "secret",
    "key": "secret",
    "endpoint": "endpoint",
}
NEEDS = {"client": ["secret"], "key": ["identifier"], "endpoint": ["identifier", "secret"]}
PATTERNS = [
    Pattern(
        "assign",
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
    ),
    Pattern("access", r"AKIA[A-Z0-9]{14,}", needs="AKIA"),
    Pattern("hex", r"[0-9a-f]{16,}"),
    Pattern(
        "client",
        r"(?i:client_?id|user_?name|user|login|account|tenant)[\"']?\x20{0,8}[:=]\x20{0,8}[\"']?([A-Za-z0-9._@-]{3,})",
        group=1,
    ),
    Pattern("key", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"),
    Pattern("endpoint", r"[a-z][a-z0-9+.-]{1,20}://[^\s\"'<>]+", needs="://"),
    Pattern("break", r"\n[\x20\t]*\n"),
]


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans and weak candidates with their scope, and a row without kind for every document.

    Weak candidates that overlap a base span are dropped, as it reports them already.
    """
    found = find(docs, PATTERNS, id_col, text_col)
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Z]") & F.col("value").rlike("[a-z]")
    found = found.where(
        F.col("kind").isNull()
        | F.when(F.col("kind") == "assign", F.length("value") >= 12)
        .when(F.col("kind") == "key", mixed)
        .otherwise(True)
    )
    upto = Window.partitionBy(*ROW).orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*ROW).orderBy("start").rangeBetween(0, Window.unboundedFollowing)
    base = F.col("kind").isin(BASE)
    overlaps = (
        F.coalesce(F.max(F.when(base, F.col("end"))).over(upto) > F.col("start"), F.lit(False))
        | F.coalesce(F.min(F.when(base, F.col("start"))).over(after) < F.col("end"), F.lit(False))
    )
    return (
        found.withColumn("scope", F.count_if(F.col("kind") == "break").over(upto))
        .withColumn("overlaps", overlaps)
        .where(F.col("kind").isNull() | base | F.col("kind").isin(WEAK) & ~F.col("overlaps"))
        .drop("overlaps", "left")
    )


def linked(parts: DataFrame, reach: int = REACH) -> DataFrame:
    """The weak parts that have all the complementary parts they need within ``reach``, with their number.

    Measured between the nearer edges. These are dealt to intervals of ``reach`` characters: a weak part
    meets the starts of parts about its end and the ends of parts about its start, each in the edge's own
    interval and the two next to it. Spans of a kind do not overlap, so an interval holds few edges,
    whatever the text, and a pair meets once, however long its parts are.
    """
    roles = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    parts = parts.where(F.col("kind").isNotNull()).withColumn("role", roles[F.col("kind")])

    def edges(at: str, after: bool, around: int) -> Column:
        cell = F.floor(F.col(at) / reach)
        return F.transform(
            F.sequence(cell - around, cell + around), lambda c: F.struct(c.alias("cell"), F.lit(after).alias("after"))
        )

    others = parts.where("role <> 'endpoint'").select(
        *ROW, "scope", F.col("role").alias("other_role"), F.col("start").alias("other_start"),
        F.col("end").alias("other_end"), F.inline(F.concat(edges("start", True, 0), edges("end", False, 0))),
    )
    weak = parts.where(F.col("kind").isin(WEAK)).select(
        "*", F.inline(F.concat(edges("end", True, 1), edges("start", False, 1)))
    )
    gap = F.when(F.col("after"), F.col("other_start") - F.col("end")).otherwise(F.col("start") - F.col("other_end"))
    pairs = weak.withColumn("_doc", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).join(
        others.withColumn("_doc", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).drop("doc_id"),
        ["_doc", "_text", "scope", "cell", "after"],
    )
    met = (
        pairs.where(gap.between(0, reach))
        .groupBy(*ROW, "kind", "start", "end", "value")
        .agg(
            F.count_if(F.col("other_role") == "identifier").alias("identifier"),
            F.count_if(F.col("other_role") == "secret").alias("secret"),
        )
    )
    enough = F.lit(False)
    for kind, roles_needed in NEEDS.items():
        ok = F.col("kind") == kind
        for role in roles_needed:
            ok &= F.col(role) > 0
        enough |= ok
    return met.where(enough)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All spans: doc_id, kind, start, end, value (the secret or identifier itself).

    Null and empty texts have none, and rows with a null id are scanned like any other; a row without kind
    stands for every document. Repeated rows are one document. Only the two named columns are read.
    """
    parts = stored(candidates(docs, id_col, text_col), "secret-parts")
    columns = [*ROW, "kind", "start", "end", "value"]
    certain = parts.where(F.col("kind").isNull() | F.col("kind").isin(BASE)).select(columns)
    return certain.union(linked(parts).select(columns))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: n_assign, n_access, n_hex, base_sha256 and all spans."""
    return per_document(scan(docs, id_col, text_col), BASE, WEAK)


def without_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every base and linked span replaced by ``mark``; other rows and columns as they are.

    Spans are cut out of the text they were found in, the overlapping ones as one.
    """
    spans = scan(docs, id_col, text_col).where(F.col("kind").isNotNull())
    upto = Window.partitionBy(*ROW).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    runs = spans.withColumn("before", F.coalesce(F.max("end").over(upto), F.lit(-1)))
    runs = runs.withColumn("first", F.col("start") >= F.col("before"))
    runs = runs.withColumn(
        "run", F.count_if("first").over(Window.partitionBy(*ROW).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0))
    )
    runs = runs.groupBy(*ROW, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cuts = runs.groupBy(*ROW).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_cuts"))
    cuts = cuts.select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"), "_cuts")
    text = F.col(text_col)
    found = docs.join(
        cuts, docs[id_col].eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_hash")), "left"
    )
    # what stands between the cuts: from the end of one to the start of the next
    kept = F.transform(
        F.sequence(F.lit(0), F.size("_cuts")),
        lambda k: F.substring(
            text,
            F.coalesce(F.get("_cuts", k - 1)["end"], F.lit(0)) + 1,
            F.coalesce(F.get("_cuts", k)["start"], F.length(text)) - F.coalesce(F.get("_cuts", k - 1)["end"], F.lit(0)),
        ),
    )
    cleaned = F.when(F.col("_cuts").isNull(), text).otherwise(F.array_join(kept, mark))
    return found.withColumn(text_col, cleaned).select(docs.columns)
