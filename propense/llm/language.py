"""Language identification in two levels: the family first, then one-versus-one linear SVMs within it.

Texts become hashed byte n-gram counts of the lower-cased text, damped and scaled to length one. Both
levels vote over pairwise linear support vector machines: between families, and between the languages of
the family that won. Machines are fitted side by side in tasks, each on a bounded sample of labelled
rows (``per_class`` a language, those with the smallest hash of their id); prediction reads every text
whole, and nothing but the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propense.llm.common import stored

UNDETERMINED = "und"
DIMENSIONS = 4096
ORDERS = (1, 2, 3, 4)
PIECE = 1 << 20
#: Labelled rows per language that a fit reads at most.
PER_CLASS = 1000
#: Times as many rows are kept for the exact choice.
SPARE = 4
#: Language families by ISO 639-1 code. A language that is not listed is its own family.
FAMILIES = {
    "germanic": "af da de en is nl no sv".split(),
    "romance": "ca es fr gl it pt ro".split(),
    "slavic": "bg cs hr mk pl ru sk sl sr uk".split(),
    "uralic": "et fi hu".split(),
    "turkic": "az kk tr uz".split(),
    "indo-aryan": "bn gu hi mr ne pa ur".split(),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def features(text: str | None) -> np.ndarray | None:
    """Unit vector of the whole text; None for a null text or one without letters."""
    if text is None or not any(map(str.isalpha, text)):
        return None
    counts = np.zeros(DIMENSIONS, dtype=np.int64)
    reach = max(ORDERS)
    for begin in range(0, len(text), PIECE):
        # a piece ends with the first characters of the next one, whose n-grams would be lost else
        piece = text[begin : begin + PIECE].lower().encode("utf-8", "replace")
        more = text[begin + PIECE : begin + PIECE + reach].lower().encode("utf-8", "replace")
        data = np.frombuffer(b" " * (begin == 0) + piece + (more or b" ")[: reach - 1], np.uint8)
        code = np.zeros(len(data), dtype=np.uint32)
        for order in range(1, reach + 1):
            code = code[: len(data) - order + 1] * np.uint32(0x01000193) + data[order - 1 :] + np.uint32(1)
            if order in ORDERS:
                mixed = (code ^ np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
                counts += np.bincount(mixed >> np.uint32(20), minlength=DIMENSIONS)
    damped = np.sqrt(counts).astype(np.float32)
    return damped / np.linalg.norm(damped)


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last one is the constant) of a linear SVM with squared hinge loss.

    Dual coordinate descent; ``y`` is +1 or -1 and both classes weigh the same in total.
    """
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)]).astype(np.float64)
    share = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum()))
    diagonal = 1 / (2 * penalty * share)
    norms = (x * x).sum(axis=1) + diagonal
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(x)):
            gradient = y[i] * (w @ x[i]) - 1 + diagonal[i] * alpha[i]
            new = max(alpha[i] - gradient / norms[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w


def _vote(x: np.ndarray, classes: list[str], machines: dict[tuple[str, str], np.ndarray]) -> tuple[str, float]:
    """Class with the most won pairs, ties by margin, then name; and its mean confidence over its pairs."""
    won, confidence = dict.fromkeys(classes, 0), dict.fromkeys(classes, 0.0)
    for a, b in combinations(classes, 2):
        w = machines[a, b]
        margin = float(x @ w[:-1] + w[-1])
        p = 1 / (1 + np.exp(-4 * np.clip(margin, -8, 8)))
        won[a] += margin >= 0
        won[b] += margin < 0
        confidence[a] += p
        confidence[b] += 1 - p
    best = min(classes, key=lambda c: (-won[c], -confidence[c], c))
    return best, confidence[best] / (len(classes) - 1) if len(classes) > 1 else 1.0


@dataclass
class LanguageModel:
    """Languages by family, and the weights of each pair of families or of languages of a family."""

    languages: dict[str, list[str]]
    machines: dict[tuple[str, str], np.ndarray]

    def predict(self, text: str | None) -> tuple[str, float]:
        x = features(text)
        if x is None or not self.languages:
            return UNDETERMINED, 0.0
        family, sure = _vote(x, sorted(self.languages), self.machines)
        language, surer = _vote(x, self.languages[family], self.machines)
        return language, sure * surer


def family(language: str) -> str:
    return "family:" + FAMILY_OF.get(language, language)


def held_out(id_column: Column) -> Column:
    """Rows that are never learned from: crc32 of the id as text, mod 5, is 0. A null id counts as such."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(True))


def _sample(rows: DataFrame, per_class: int) -> DataFrame:
    """(lang, text) of the ``per_class`` smallest hashes of each language, every (id, text) once.

    One count says below which hash a few times as many rows lie; only those are kept, ranked and, where
    repeated rows have made the count too large, looked for further up. So what reaches the task of a
    language does not grow with the table.
    """
    share = {r["lang"]: min(1.0, SPARE * per_class / r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    while True:
        cut = F.lit(None).cast("double")
        for lang, s in share.items():
            # the hash is even over all longs
            cut = F.when(F.col("lang") == lang, F.lit(-(2.0**63) + s * 2.0**64)).otherwise(cut)
        near = rows.where(F.col("hash") <= cut).withColumn("text_hash", F.xxhash64("text"))
        near = stored(near.dropDuplicates(["id", "lang", "text_hash"]), "language-sample")
        found = dict(near.groupBy("lang").agg(F.count("*")).collect())
        few = [lang for lang, s in share.items() if s < 1 and found.get(lang, 0) < per_class]
        if not few:
            break
        share |= {lang: min(1.0, share[lang] * 16) for lang in few}
    best = Window.partitionBy("lang").orderBy("hash", "id", "text_hash")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= per_class).select("text", "lang")


def fit(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", per_class: int = PER_CLASS) -> LanguageModel:
    """A model of the labelled rows of ``docs`` that are not held out.

    Rows with a null label or a text without letters teach nothing; without labelled rows the model knows
    no language. Rows that repeat an id and its text are one row of the sample; equal hashes of repeated ids
    are ordered by text.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    rows = rows.withColumn("hash", F.xxhash64(F.col("id").cast("string")))
    sample = _sample(rows, per_class)
    languages: dict[str, list[str]] = {}
    for r in sample.select("lang").distinct().collect():
        languages.setdefault(family(r["lang"]), []).append(r["lang"])
    languages = {f: sorted(names) for f, names in sorted(languages.items())}
    pairs = [(a, b, True) for a, b in combinations(languages, 2)]
    pairs += [(a, b, False) for names in languages.values() for a, b in combinations(names, 2)]
    if not pairs:
        return LanguageModel(languages, {})

    # a row takes part in the pairs of its family and of its language
    takes_part: dict[str, list[tuple[str, str, int]]] = {}
    for a, b, of_families in pairs:
        for names in languages.values():
            for name in names:
                key = family(name) if of_families else name
                if key in (a, b):
                    takes_part.setdefault(name, []).append((a, b, 1 if key == a else -1))

    def examples(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, lang in zip(batch["text"], batch["lang"]):
                x = features(text)
                if x is not None:
                    out += [(a, b, y, x.astype("<f4").tobytes()) for a, b, y in takes_part.get(lang, ())]
            yield pd.DataFrame(out, columns=["a", "b", "y", "x"])

    def train(frame: pd.DataFrame) -> pd.DataFrame:
        # rows arrive in any order; sorting makes the fit the same each time
        frame = frame.sort_values(["y", "x"])
        x = np.frombuffer(b"".join(frame["x"]), dtype="<f4").reshape(-1, DIMENSIONS)
        y = frame["y"].to_numpy()
        both = (y > 0).any() and (y < 0).any()
        w = fit_svm(x, y) if both else np.append(np.zeros(DIMENSIONS), y[0])
        return pd.DataFrame({"a": frame["a"].iloc[:1], "b": frame["b"].iloc[:1], "w": [w.astype("<f8").tobytes()]})

    made = sample.mapInPandas(examples, "a string, b string, y int, x binary")
    found = made.groupBy("a", "b").applyInPandas(train, "a string, b string, w binary").collect()
    machines = {(r["a"], r["b"]): np.frombuffer(r["w"], dtype="<f8").astype(np.float32) for r in found}
    flat = np.zeros(DIMENSIONS + 1, dtype=np.float32)
    return LanguageModel(languages, {(a, b): machines.get((a, b), flat) for a, b, _ in pairs})


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1) added; columns of these names are replaced.

    Null texts and texts without letters are ``und`` with score 0. Rows stay as they are, in any number.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.machines))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        known = LanguageModel(*shared.value)
        return pd.DataFrame([known.predict(t) for t in texts], columns=["lang_pred", "score"])

    found = docs.withColumn("_found", predict(F.col(text_col)))
    return found.withColumns({c: F.col("_found")[c] for c in ("lang_pred", "score")}).drop("_found")
