"""URL verdicts: rules first, then a naive Bayes score over segmented hosts and paths.

Names in hosts are concatenated words. A unigram model, counted over the words of all pages, splits them
by Viterbi's algorithm. A multinomial naive Bayes model over the words of host and path, learnt from all
urls with a list of telling words as weak labels, scores what no rule decides.

Nothing that grows with the corpus is sent to the tasks: the words a name can contain are joined to it,
names are split once each, and scores are computed once per distinct bag of words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propense.llm.common import stored

#: Words that tell an unwanted url.
TELLING = (
    "adult bet bets betting bingo casino casinos cheap crack cracked dating escort escorts gambling hacked "
    "jackpot keygen loan loans nude payday pharma pills poker porn replica roulette sex slots torrent "
    "torrents viagra warez xxx"
).split()
#: Further words that names are often made of; with the telling ones they are always known.
COMMON = "best blog buy club deals free game games home info mail mobile money news online play shop store web win".split()
KNOWN_COUNT = 100
LONGEST_WORD = 24
#: Letters of a name that are taken apart at a time.
PART = 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NUMBER = "#"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty for null and where there is no ``://``."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, parts, 1), UPPER, LOWER), F.regexp_extract(text, parts, 2)


def best_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(verdict, rule) of the longest rule that fits; nulls where none does.

    A rule ``host/path`` fits its host and all subdomains where the path begins with its own.
    """
    verdict, rule = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        verdict = F.when(fits, decision).otherwise(verdict)
        rule = F.when(fits, text).otherwise(rule)
    return verdict, rule


def word_counts(texts: DataFrame, column: str) -> DataFrame:
    """(word, n): lower-cased words of all texts, tags left out, and the words that are always known."""
    plain = F.regexp_replace(F.lower(F.coalesce(F.col(column), F.lit(""))), "<[^>]*>", " ")
    words = texts.select(F.explode(F.split(plain, r"[^\p{L}]+")).alias("word"))
    words = words.where(F.length("word").between(1, LONGEST_WORD)).groupBy("word").agg(F.count("*").alias("n"))
    known = texts.sparkSession.createDataFrame([(w, KNOWN_COUNT) for w in sorted({*TELLING, *COMMON})], "word string, n long")
    return words.union(known).groupBy("word").agg(F.sum("n").alias("n"))


def split_name(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The most probable words of a name; unknown pieces cost more with each letter."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(name) + 1):
        options = []
        for begin in range(max(0, end - LONGEST_WORD), end):
            word = name[begin:end]
            n = counts.get(word)
            cost = math.log(n / total) if n else -math.log(total) - len(word) * math.log(10)
            options.append((best[begin][0] + cost, begin))
        best.append(max(options))
    words, end = [], len(name)
    while end:
        begin = best[end][1]
        words.append(name[begin:end])
        end = begin
    return words[::-1]


def _possible_words(names: DataFrame) -> DataFrame:
    """(name_1, name_2, word): all pieces of each name up to the longest word, names by 128 bits of hash.

    A long name is cut into parts of ``PART`` letters first, each with the letters of the next that a word may
    reach into, so that neither time nor rows grow faster than the name.
    """
    part = F.regexp_extract_all("name", F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))
    reaching = F.transform("parts", lambda p, k: F.concat(p, F.coalesce(F.left(F.get("parts", k + 1), F.lit(LONGEST_WORD - 1)), F.lit(""))))
    parts = names.withColumn("parts", part).select("name_1", "name_2", F.explode(reaching).alias("part"))
    pieces = F.transform(
        F.sequence(F.lit(1), F.length("part")),
        lambda b: F.transform(
            F.sequence(F.lit(1), F.least(F.length("part") - b + 1, F.lit(LONGEST_WORD))),
            lambda n: F.substring(F.col("part"), b, n),
        ),
    )
    return parts.select("name_1", "name_2", F.explode(F.array_distinct(F.flatten(pieces))).alias("word"))


def segment(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) of the distinct ``name``s; the words a name may hold are joined to it."""
    total = counts.agg(F.sum("n")).first()[0] or 1
    names = names.select("name", F.xxhash64("name").alias("name_1"), F.xxhash64(F.lit(5), "name").alias("name_2"))
    held = _possible_words(names).join(counts, "word")
    known = held.groupBy("name_1", "name_2").agg(F.collect_list("word").alias("known"), F.collect_list("n").alias("counts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [
                split_name(name, {} if k is None else dict(zip(k, c)), total)
                for name, k, c in zip(batch["name"], batch["known"], batch["counts"])
            ]
            yield pd.DataFrame({"name": batch["name"], "words": words})

    named = names.join(known, ["name_1", "name_2"], "left").select("name", "known", "counts")
    return named.mapInPandas(run, "name string, words array<string>")


def _letters(text: Column) -> Column:
    """Runs of letters, and a sign for runs of digits."""
    return F.transform(
        F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|[0-9]+)"), F.lit(1)),
        lambda w: F.when(w.rlike("^[0-9]"), NUMBER).otherwise(w),
    )


def bags(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, host_words): the words of each distinct host, its names split."""
    hosts = hosts.select("host").distinct().withColumn("name", F.explode_outer(_letters(F.col("host"))))
    names = hosts.select("name").where(F.col("name").isNotNull() & (F.col("name") != NUMBER)).distinct()
    split = segment(stored(names, "url-names"), counts)
    words = hosts.join(split, "name", "left").withColumn(
        "words", F.coalesce("words", F.when(F.col("name") == NUMBER, F.array("name")), F.array().cast("array<string>"))
    )
    return words.groupBy("host").agg(F.sort_array(F.flatten(F.collect_list("words"))).alias("host_words"))


def token_weights(grouped: DataFrame) -> tuple[DataFrame, float]:
    """(word, weight): log ratio of a word in unwanted and other urls, smoothed by one; and that of the classes.

    ``grouped`` has words (of a bag) and urls (their number); bags with a telling word count as unwanted.
    """
    marked = grouped.withColumn("bad", F.arrays_overlap("words", F.array(*map(F.lit, TELLING))))
    counted = (
        marked.select("bad", "urls", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(
            F.sum(F.when(F.col("bad"), F.col("urls")).otherwise(0)).alias("bad"),
            F.sum(F.when(~F.col("bad"), F.col("urls")).otherwise(0)).alias("good"),
        )
    )
    counted = stored(counted, "url-words")
    bad, good, size = counted.agg(F.sum("bad"), F.sum("good"), F.count("*")).first()
    n_bad, n_good = marked.agg(
        F.sum(F.when(F.col("bad"), F.col("urls")).otherwise(0)), F.sum(F.when(~F.col("bad"), F.col("urls")).otherwise(0))
    ).first()
    ratio = F.log((F.col("bad") + 1) / F.lit((bad or 0) + size + 1)) - F.log((F.col("good") + 1) / F.lit((good or 0) + size + 1))
    return counted.select("word", ratio.alias("weight")), math.log(((n_bad or 0) + 1) / ((n_good or 0) + 1))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
) -> DataFrame:
    """A row per row of ``pages``: id, host, path, rule (null if none fits), verdict and score.

    ``score`` is the log odds of an unwanted url; without a rule one above 0 is blocked. Null and
    malformed urls have an empty host and path and the score of the classes alone, so that they are allowed unless
    most urls are unwanted. Repeated rows and null ids are judged like any other row. Only the named columns are
    read, so others cannot clash. An empty table gives none.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("path_words", F.sort_array(_letters(F.col("path"))))
    rows = stored(rows, "url-rows")
    # urls of one host and one bag of path words are judged once
    kinds = rows.groupBy("host", "path_words").agg(F.count("*").alias("urls"))
    counts = stored(word_counts(pages, text_col), "url-counts")
    grouped = kinds.join(bags(rows, counts), "host").withColumn("words", F.concat("host_words", "path_words"))
    grouped = stored(grouped.select("host", "path_words", "words", "urls"), "url-bags")
    weights, prior = token_weights(grouped)
    scored = (
        grouped.select("host", "path_words", F.explode("words").alias("word"))
        .join(weights, "word")
        .groupBy("host", "path_words")
        .agg(F.sum("weight").alias("sum"))
    )
    out = rows.join(scored, ["host", "path_words"], "left")
    verdict, rule = best_rule(F.col("host"), F.col("path"), rules)
    score = F.lit(prior) + F.coalesce("sum", F.lit(0.0))
    return out.select(
        F.col("page_id").alias(id_col),
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(score > 0, "block").otherwise("allow")).alias("verdict"),
        score.alias("score"),
    )
