"""Personal data by weak supervision, with built-in functions and Spark's own learner only.

Four certain kinds are reported wherever their pattern holds. Six looser kinds are candidates: labelers
(shape, checksum, gazetteer, context) vote yes, no or nothing on every candidate, certain ones included.
Expectation-maximisation over the counts of vote patterns, of which there is a fixed number however large
the corpus is, estimates each labeler's reliability without labels. Its probabilities train the final span
classifier, a logistic regression over votes and features of the span; looser candidates that it accepts
and that overlap no certain span are added.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propense.llm.common import stored
from propense.llm.spans import ROW, Pattern, find, per_document

BASE = ["email", "ip", "card", "phone"]
MORE = ["email_spelt", "phone_local", "national_id", "iban", "birth_date", "name"]
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = [
    # possessive, and not begun anew inside a run that has failed: linear in long runs
    Pattern("email", rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", needs="@"),
    Pattern("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    # a run of fewer than 12 digits cannot pass, nor can any part of it
    Pattern("card", r"[0-9](?:[\x20-]?[0-9]){11,}+"),
    Pattern("phone", r"\+[0-9][\x20().0-9-]+[0-9]", needs="+"),
    Pattern(
        "email_spelt",
        r"(?<![\w.+-])[\w.+-]{1,64}\x20?[\[(]\x20?(?:at|AT)\x20?[\])]\x20?[\w-]{1,63}(?:\x20?[\[(]\x20?(?:dot|DOT)\x20?[\])]\x20?[\w-]{1,63})++",
    ),
    Pattern("phone_local", r"(?<![0-9+])(?<![0-9][\x20.-])\(?0?[0-9]{2,4}\)?[\x20./-][0-9]{3,4}[\x20.-][0-9]{3,4}(?![\x20.-]?[0-9])"),
    Pattern("national_id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    Pattern("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,4})?(?![A-Za-z0-9])"),
    Pattern("birth_date", r"(?<![0-9./-])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{4}|[0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9./-])"),
    Pattern("name", r"(?<!\w)(?:Mrs?|Ms|Dr|Herr|Frau|Mme|Mlle|Sra?|Prof)\.?\x20\p{Lu}\p{Ll}+(?:\x20\p{Lu}\p{Ll}+)?"),
]
#: Gazetteers. Given names, top-level domains, and codes of countries with IBANs.
GIVEN_NAMES = (
    "anna ben carlos carmen claire daniel david elena emma franz hans james jean john jose julia karl laura "
    "linda louis lucia luis maria marie mary michael paul peter pierre robert sarah sofia thomas ursula"
).split()
DOMAINS = "com org net edu gov info io de fr es it uk at ch eu us".split()
IBAN_COUNTRIES = "AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split()
#: Words before a span that speak for a kind, and words that speak against all kinds.
CUES = {
    "email": "mail|contact|courriel|correo|write|schreib",
    "email_spelt": "mail|contact|courriel|correo|write|schreib",
    "ip": r"\bip\b|address|host|login|from",
    "card": "card|karte|carte|tarjeta|visa|credit|payment",
    "phone": "phone|tel|call|mobile|fax|anruf|appel|llam",
    "phone_local": "phone|tel|call|mobile|fax|anruf|appel|llam",
    "national_id": r"ssn|social|security|\bid\b|insurance",
    "iban": "iban|bank|konto|account|compte|cuenta",
    "birth_date": r"born|birth|dob|geb(?:oren|\.)|\bn[ée]e?\b|nacid",
    "name": "name|dear|contact|sign|regards|patient|customer",
}
AGAINST = r"version|release|page|figure|table|isbn|order|invoice|part|chapter|section|lines?\b"
LABELERS = ["shape", "check", "gazetteer", "cue", "against", "border"]
FEATURES = ["digits", "long", "grouped"]
ROUNDS = 30


def _luhn(value: Column) -> Column:
    digits = F.reverse(F.regexp_replace(value, "[^0-9]", ""))

    def weigh(k: Column) -> Column:
        d = F.substring(digits, k + 1, F.lit(1)).cast("int") * (1 + k % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    places = F.sequence(F.lit(0), F.greatest(F.length(digits) - 1, F.lit(0)))
    return F.aggregate(places, F.lit(0), lambda total, k: total + F.coalesce(weigh(k), F.lit(0))) % 10 == 0


def _n_digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


def _passes(value: Column) -> Column:
    """What a match of a certain kind has to fulfil beyond its pattern."""
    octet = r"0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    n = _n_digits(value)
    return (
        F.when(F.col("kind") == "ip", value.rlike(rf"^{octet}(?:\.{octet}){{3}}$"))
        .when(F.col("kind") == "card", n.between(12, 19) & _luhn(value))
        .when(F.col("kind") == "phone", n.between(9, 15))
        .otherwise(F.col("kind") == "email")
    )


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _among(value: Column, words: list[str]) -> Column:
    return value.isin(words)


def vote(spans: DataFrame) -> DataFrame:
    """The labelers' votes (1 yes, -1 no, 0 none) and the features of every span."""
    kind, value, left = F.col("kind"), F.col("value"), F.lower("left")
    n = _n_digits(value)
    is_kind = lambda *names: kind.isin(*names)
    parts = F.split(value, "[./-]")
    day_like = F.exists(parts, lambda p: p.cast("int").between(1900, 2020)) & F.forall(
        parts, lambda p: (p.cast("int") <= 31) | (p.cast("int") >= 1900)
    )
    checked = is_kind("ip", "card", "birth_date", "national_id", "iban", "phone")
    check = (
        F.when(is_kind("ip", "card", "phone"), F.col("passes"))
        .when(is_kind("birth_date"), day_like)
        .when(is_kind("national_id"), ~value.rlike("^(?:000|666|9)|-00-|-0000$"))
        .when(is_kind("iban"), F.length(F.regexp_replace(value, " ", "")).between(15, 34))
    )
    shape = (
        F.when(is_kind("phone", "phone_local"), n.between(9, 15))
        .when(is_kind("email"), value.rlike(r"^[A-Za-z0-9].*\.[A-Za-z]{2,10}$"))
        .when(is_kind("email_spelt"), value.rlike(r"(?i)\bdot\b"))
        .when(is_kind("card"), n.between(13, 16))
        .when(is_kind("name"), value.rlike(r"\p{Ll}{2}$"))
        .otherwise(True)
    )
    domain = F.lower(F.regexp_extract(value, r"([A-Za-z]+)\W*$", 1))
    given = F.exists(F.split(F.lower(value), r"\P{L}+"), lambda w: w.isin(GIVEN_NAMES))
    in_gazetteer = (
        F.when(is_kind("email", "email_spelt"), _among(domain, DOMAINS))
        .when(is_kind("iban"), _among(F.left(value, F.lit(2)), IBAN_COUNTRIES))
        .when(is_kind("name"), given)
    )
    cue = F.lit(False)
    for name, words in CUES.items():
        cue |= (kind == name) & left.rlike(words)
    return spans.withColumns(
        {
            "shape": _vote(shape, ~shape),
            "check": _vote(checked & check, checked & ~check),
            "gazetteer": _vote(in_gazetteer, is_kind("iban", "email_spelt") & ~in_gazetteer),
            "cue": _vote(cue, F.lit(False)),
            "against": _vote(F.lit(False), left.rlike(AGAINST)),
            "border": _vote(left.rlike(r"(?:^|[\s\"'(:;,<=\[])$"), left.rlike(r"[\p{L}\p{N}_/]$")),
            "digits": F.when(n == 0, 0).when(n < 9, 1).when(n < 13, 2).otherwise(3),
            "long": (F.length(value) > 20).cast("int"),
            "grouped": value.rlike("[ .-]").cast("int"),
        }
    )


def reliabilities(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = ROUNDS) -> tuple[list[float], dict]:
    """Probability of each pattern (kind, votes, count) to be personal data, and what labelers' votes say.

    Expectation-maximisation of two hidden classes in which votes are independent; each kind has its own
    share of personal data and every count starts from a prior, so that rare patterns cannot run away.
    It begins with the majority of votes. Kind and vote counts are fixed, so this is a small computation.
    """
    chance = []
    for _, votes, _ in patterns:
        total = sum(votes)
        chance.append(0.5 + 0.4 * max(-1, min(1, total / 2)))
    says: dict = {}
    for _ in range(rounds):
        share: dict[str, list[float]] = {}
        says = {(k, v, y): 1.0 for k in range(len(LABELERS)) for v in (-1, 0, 1) for y in (0, 1)}
        # votes are believed more often right than wrong before anything is seen
        for k in range(len(LABELERS)):
            says[k, 1, 1] += 2.0
            says[k, -1, 0] += 2.0
        for (kind, votes, count), p in zip(patterns, chance):
            yes, no = share.setdefault(kind, [1.0, 1.0])
            share[kind] = [yes + count * p, no + count * (1 - p)]
            for k, v in enumerate(votes):
                says[k, v, 1] += count * p
                says[k, v, 0] += count * (1 - p)
        totals = {(k, y): sum(says[k, v, y] for v in (-1, 0, 1)) for k in range(len(LABELERS)) for y in (0, 1)}
        new = []
        for kind, votes, _ in patterns:
            yes, no = share[kind]
            log_yes, log_no = math.log(yes / (yes + no)), math.log(no / (yes + no))
            for k, v in enumerate(votes):
                log_yes += math.log(says[k, v, 1] / totals[k, 1])
                log_no += math.log(says[k, v, 0] / totals[k, 0])
            new.append(1 / (1 + math.exp(max(-60.0, min(60.0, log_no - log_yes)))))
        moved = max((abs(a - b) for a, b in zip(chance, new)), default=0.0)
        chance = new
        if moved < 1e-9:
            break
    return chance, says


def train(votes: DataFrame) -> Column:
    """The span classifier as an expression: probability that a span is personal data."""
    keys = ["kind", *LABELERS, *FEATURES]
    # at most 10 kinds x 3^6 votes x 16 feature values
    seen = sorted(votes.groupBy(*keys).count().collect(), key=lambda r: tuple(r))
    if not seen:
        return F.lit(0.0)
    patterns: dict[tuple, int] = {}
    for r in seen:
        key = (r["kind"], tuple(r[c] for c in LABELERS))
        patterns[key] = patterns.get(key, 0) + r["count"]
    ordered = sorted(patterns)
    chance, _ = reliabilities([(kind, v, patterns[kind, v]) for kind, v in ordered])
    belief = dict(zip(ordered, chance))
    rows = []
    for r in seen:
        p = belief[r["kind"], tuple(r[c] for c in LABELERS)]
        values = [float(r[c]) for c in (*LABELERS, *FEATURES)]
        values += [float(r["kind"] == k) for k in BASE + MORE]
        rows += [(*values, 1.0, p * r["count"]), (*values, 0.0, (1 - p) * r["count"])]
    names = [*LABELERS, *FEATURES, *(f"is_{k}" for k in BASE + MORE)]
    frame = votes.sparkSession.createDataFrame(rows, [*names, "label", "weight"]).coalesce(1)
    frame = VectorAssembler(inputCols=names, outputCol="features").transform(frame)
    model = LogisticRegression(weightCol="weight", regParam=0.001, maxIter=50).fit(frame.where("weight > 0"))
    terms = [F.col(c).cast("double") for c in (*LABELERS, *FEATURES)]
    terms += [(F.col("kind") == k).cast("double") for k in BASE + MORE]
    score = F.lit(float(model.intercept))
    for weight, term in zip(model.coefficients.toArray().tolist(), terms):
        score += F.lit(weight) * term
    return 1 / (1 + F.exp(-score))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """All spans: doc_id, kind, start, end, value, probability; a row without kind for every document.

    Certain spans are all there, whatever their probability. Null and empty texts have none; rows with a
    null id are scanned like any other. Repeated rows are one document, rows that repeat an id with another
    text are documents of their own. Only the two named columns are read, so others cannot clash.
    """
    found = find(docs, PATTERNS, id_col, text_col).drop("value").withColumnRenamed("whole", "value")
    found = found.withColumn("passes", _passes(F.col("value")))
    found = stored(found.where(F.col("kind").isNull() | F.col("passes") | F.col("kind").isin(MORE)
                               | F.col("kind").isin("card", "ip", "phone")), "pii-candidates")
    votes = vote(found.where(F.col("kind").isNotNull()))
    probability = train(votes)
    certain = F.col("kind").isin(BASE)
    upto = Window.partitionBy(*ROW).orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*ROW).orderBy("start").rangeBetween(0, Window.unboundedFollowing)
    judged = votes.where(~certain | F.col("passes")).withColumn("probability", probability)
    judged = judged.withColumn(
        "overlaps",
        F.coalesce(F.max(F.when(certain, F.col("end"))).over(upto) > F.col("start"), F.lit(False))
        | F.coalesce(F.min(F.when(certain, F.col("start"))).over(after) < F.col("end"), F.lit(False)),
    )
    columns = [*ROW, "kind", "start", "end", "value", "probability"]
    spans = judged.where(certain | (F.col("probability") >= threshold) & ~F.col("overlaps")).select(columns)
    documents = found.where(F.col("kind").isNull()).withColumn("probability", F.lit(None).cast("double"))
    return spans.union(documents.select(columns))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: n_email, n_ip, n_card, n_phone, base_sha256 and all spans."""
    return per_document(scan(docs, id_col, text_col), BASE, MORE)
