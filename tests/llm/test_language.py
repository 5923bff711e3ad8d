import zlib

import numpy as np
import pytest

from propense.llm import language, queries

TEXTS = {
    "en": "the of and that with this have from they would there which people could other",
    "de": "der die und das nicht sich auch werden einer durch können über müssen wieder",
    "fr": "le la les des une dans pour qui avec être faire cette aussi après même très",
    "es": "el la los las una con para por como pero más este también después según años",
}


def sample(spark, n=240, more=()):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        lang = list(TEXTS)[i % 4]
        rows.append((i, " ".join(rng.choice(TEXTS[lang].split(), 12)), lang))
    return spark.createDataFrame([*rows, *more], "doc_id long, text string, lang string").selectExpr(
        "*", "'x' AS lang_pred", "1.0D AS score", "1 AS id", "2 AS hash", "3 AS rank"
    )


def test_hard_rows(spark):
    more = [(1000, None, "en"), (1001, "", "fr"), (1002, "12 ?! 34", "de"), (1003, "und der", None), (None, "the of and", "en")]
    more += [(1004, "the people would " * 100_000, None), (1004, "the people would " * 100_000, None), (1005, "x", "")]
    docs = sample(spark, more=more)
    model = language.fit(docs)
    assert sorted(x for names in model.languages.values() for x in names if x) == sorted(TEXTS)
    found = language.identify(docs, model)
    assert found.columns == docs.columns
    rows = found.collect()
    assert len(rows) == 248
    for r in rows:
        if r.text is None or not any(map(str.isalpha, r.text)):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert 0 <= r.score <= 1 and r.lang_pred in ("", *TEXTS)
            if r.doc_id is not None and r.doc_id < 1000:
                assert r.lang_pred == r.lang
    assert {r.lang_pred for r in rows if r.doc_id in (1003,)} == {"de"}
    assert {r.lang_pred for r in rows if r.doc_id == 1004} == {"en"}
    assert language.identify(docs.limit(0), model).count() == 0


def test_nothing_or_one_language_learnt(spark):
    docs = sample(spark, 8)
    nothing = language.identify(docs, language.fit(docs.limit(0))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    one = language.fit(docs.where("lang = 'en'").selectExpr("doc_id * 7 + 1 AS doc_id", "text", "lang"))
    assert {(r.lang_pred, r.score) for r in language.identify(docs, one).collect()} == {("en", 1.0)}


def test_a_piece_loses_nothing(monkeypatch):
    text = "the people of größe and été " * 20
    whole = language.features(text)
    monkeypatch.setattr(language, "PIECE", 11)
    assert language.features(text) == pytest.approx(whole, abs=0.02)


def test_svm_separates():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((200, 5))
    y = np.where(x @ np.array([1.0, -2, 0.5, 0, 0]) + 0.3 > 0, 1, -1)
    w = language.fit_svm(x, y)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.95


def newton(x, y, penalty):
    """The same objective by Newton steps on all weights at once."""
    x = np.hstack([x, np.ones((len(x), 1))])
    share = np.where(y > 0, len(y) / (2 * (y > 0).sum()), len(y) / (2 * (y < 0).sum())) * penalty
    w = np.zeros(x.shape[1])
    for _ in range(100):
        slack = np.maximum(1 - y * (x @ w), 0)
        some = slack > 0
        gradient = w - 2 * x.T @ (share * y * slack)
        hessian = np.eye(len(w)) + 2 * (x[some] * share[some, None]).T @ x[some]
        w = w - np.linalg.solve(hessian, gradient)
    return w


def test_svm_equals_a_reference_solver():
    rng = np.random.default_rng(4)
    for n, size in ((60, 4), (120, 10)):
        x = rng.standard_normal((n, size)).astype(np.float32)
        y = np.where(x[:, 0] + 0.5 * rng.standard_normal(n) > 0.4, 1, -1)
        want, got = newton(x.astype(float), y, 10.0), language.fit_svm(x, y, rounds=3000)
        assert np.abs(got - want).max() < 2e-3 * np.abs(want).max()


def test_votes_by_hand(spark, sf_dir):
    """All pairs of families, then all pairs of the languages of the best one, written out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fit(docs)

    def best(x, names):
        won, sure = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0)
        for i, a in enumerate(names):
            for b in names[i + 1 :]:
                margin = float(np.dot(x, model.machines[a, b][:-1]) + model.machines[a, b][-1])
                chance = 1 / (1 + np.exp(-4 * min(max(margin, -8), 8)))
                won[a if margin >= 0 else b] += 1
                sure[a] += chance
                sure[b] += 1 - chance
        top = sorted(names, key=lambda c: (-won[c], -sure[c], c))[0]
        return top, sure[top] / max(len(names) - 1, 1) if len(names) > 1 else 1.0

    for r in language.identify(docs, model).collect():
        x = language.features(r.text)
        if x is None:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        group, sure = best(x, sorted(model.languages))
        name, surer = best(x, model.languages[group])
        assert r.lang_pred == name and r.score == pytest.approx(sure * surer, abs=1e-6)


def test_the_sample_is_bounded_and_exact(spark, monkeypatch):
    """Massively repeated ids and rows do not fill it; it is the rows with the smallest hashes."""
    rows = [(k, f"text {k}", "en") for k in range(900)] + [(5, f"other text {k}", "en") for k in range(3000)]
    rows += [(7, "the same", "de")] * 5000 + [(k, f"wort {k}", "de") for k in range(1000, 1040)]
    df = spark.createDataFrame(rows, "id long, text string, lang string").repartition(7)
    df = df.withColumn("hash", language.F.xxhash64(language.F.col("id").cast("string")))
    hashes = {r.id: r.hash for r in df.select("id", "hash").distinct().collect()}
    for spare in (4, 1):
        monkeypatch.setattr(language, "SPARE", spare)
        got = sorted((r.lang, r.text) for r in language._sample(df, 100).collect())
        assert len(got) == 100 + 41
        english = sorted({r for r in rows if r[2] == "en"}, key=lambda r: hashes[r[0]])
        last = hashes[english[99][0]]
        sure = {(r[2], r[1]) for r in english if hashes[r[0]] < last}
        assert sure <= set(got) and {t for g, t in got if g == "de"} == {r[1] for r in rows if r[2] == "de"}


def test_families_come_first():
    model = language.LanguageModel(
        {"family:germanic": ["de", "en"], "family:romance": ["es", "fr"]},
        {
            ("family:germanic", "family:romance"): np.append(np.zeros(language.DIMENSIONS), 1.0),
            ("de", "en"): np.append(np.zeros(language.DIMENSIONS), -1.0),
            ("es", "fr"): np.append(np.zeros(language.DIMENSIONS), 1.0),
        },
    )
    assert model.predict("abc")[0] == "en"


def test_query_on_held_out_rows(spark, sf_dir):
    rows = queries.op7_language_id(spark, sf_dir).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id].lang for r in held]) > 0.95
    # labels of held-out rows teach nothing
    changed = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr(
        "doc_id", "text", "IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 'xx', lang) AS lang"
    )
    a, b = language.fit(changed), language.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert all(np.array_equal(a.machines[k], b.machines[k]) for k in b.machines) and a.languages == b.languages
