import math
import re
from collections import Counter
from itertools import combinations

from propense.llm import queries, urls

RULES = queries.URL_RULES


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    best = (None, None)
    for verdict, text in RULES:
        name, rest = text.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            if best[1] is None or len(text) > len(best[1]):
                best = (verdict, text)
    return best


URLS = [
    "http://WWW.Example.com/en/a", "https://m.example.com/en/", "http://example.com/en", "http://notexample.com/en/x", "http://x.net/es/1",
    "http://x.net", "http://x.net?es/", "ftp://com/", "http://com", None, "", "no scheme", "a://b://c/d", "http:///en/", "http://é.org/fr/#x",
    "http://casinowinonline.org/play/1", "http://freebets.org/x", "http://gardenbooks.org/read/2", "http://" + "a" * 3000 + ".org/",
    *(f"http://gardenbooks.org/read/{k}" for k in range(3, 9)), "http://x.net/fr/\nrest", "http://casinowinonline.org/play/1",
]


def pages(spark):
    html = "<p class=casino>garden books read the online win garden</p>"
    rows = [(k, u, html if k % 2 else None) for k, u in enumerate(URLS)] + [(None, "http://y.org/a", ""), (3, "http://z.org/", "x")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS words", "3 AS sum")


def test_rules_and_hard_urls(spark):
    found = urls.judge(pages(spark), RULES)
    rows = found.collect()
    assert len(rows) == len(URLS) + 2
    seen = pages(spark).select("page_id", "url").collect()
    want = Counter()
    for r in seen:
        host, path = plain_parts(r.url)
        want[r.page_id, host, path, plain_rule(host, path)[1]] += 1
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in rows) == want
    for r in rows:
        verdict, _ = plain_rule(r.host, r.path)
        assert r.verdict == (verdict or ("block" if r.score > 0 else "allow"))
    by_host = {r.host: r for r in rows}
    assert by_host["casinowinonline.org"].verdict == by_host["freebets.org"].verdict == "block"
    assert by_host["gardenbooks.org"].verdict == "allow"
    assert urls.judge(pages(spark).limit(0), RULES).count() == 0


def test_viterbi_equals_trying_all_splits():
    counts = {"a": 5, "ab": 9, "b": 2, "abc": 1, "ca": 7, "bca": 3}
    total = 100

    def cost(words):
        return sum(math.log(counts[w] / total) if w in counts else -math.log(total) - len(w) * math.log(10) for w in words)

    for name in ("abcab", "cabca", "abcabca", "xxab"):
        splits = [
            [name[i:j] for i, j in zip((0, *cuts), (*cuts, len(name)))]
            for n in range(len(name))
            for cuts in combinations(range(1, len(name)), n)
        ]
        assert math.isclose(cost(urls.split_name(name, counts, total)), max(map(cost, splits)))


def test_long_names_are_split_as_short_ones_are(spark):
    """Words across the borders of parts, names around their size, letters of two code units, and a very long one."""
    words = {"casino": 9, "win": 5, "garden": 4, "s": 1, "\U00010400x": 3, "abcdefghijklmnopqrstuvwx": 2}
    counts = spark.createDataFrame(list(words.items()), "word string, n long")
    names = [("casinowingardens" * 40)[k : k + n] for k in (0, 3) for n in (1, 255, 256, 257, 512, 530)]
    names += ["abcdefghijklmnopqrstuvwx" * 30, "\U00010400x" * 200, "q" * 700, "casinoqwin" * 30_000]
    found = urls.segment(spark.createDataFrame([(n,) for n in names], "name string"), counts).collect()
    assert len(found) == len(names)
    for r in found:
        assert list(r["words"]) == urls.split_name(r["name"], words, sum(words.values()))


def test_scores_equal_naive_bayes_by_hand(spark):
    rows = urls.judge(pages(spark), []).collect()
    counts = {r.word: r.n for r in urls.word_counts(pages(spark), "html").collect()}
    total = sum(counts.values())

    def tokens(host, path):
        runs = lambda t: re.findall(r"[^\W\d_]+|[0-9]+", t.lower())
        out = []
        for w in runs(host):
            out += ["#"] if w[0].isdigit() else urls.split_name(w, counts, total)
        return out + ["#" if w[0].isdigit() else w for w in runs(path)]

    bags = [tokens(r.host, r.path) for r in rows]
    bad = [bool(set(b) & set(urls.TELLING)) for b in bags]
    n_bad, n_good = Counter(), Counter()
    for b, is_bad in zip(bags, bad):
        (n_bad if is_bad else n_good).update(b)
    size = len(n_bad | n_good)
    prior = math.log((sum(bad) + 1) / (len(bad) - sum(bad) + 1))
    # a url without any word is not among those that are counted by word, but among the urls
    for r, b in zip(rows, bags):
        want = prior + sum(
            math.log((n_bad[w] + 1) / (n_bad.total() + size + 1)) - math.log((n_good[w] + 1) / (n_good.total() + size + 1)) for w in b
        )
        assert math.isclose(r.score, want, abs_tol=1e-9), (r, b)


def test_query(spark, sf_dir):
    rows = queries.op8_url_verdicts(spark, sf_dir).collect()
    docs = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.host, r.path) == plain_parts(docs[r.page_id])
        verdict, rule = plain_rule(r.host, r.path)
        assert r.rule == rule and r.verdict in ("allow", "block") and (verdict is None or verdict == r.verdict)
