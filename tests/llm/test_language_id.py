"""Language identification: held-out accuracy, normalised models, rejection and edges."""

from collections import Counter

import numpy as np

from trialstats.llm import catalog, language_id
from trialstats.llm.hashes import discounts

SCHEMA = "doc_id bigint, text string, lang string"


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    truth = {d.doc_id: d.lang for d in catalog.documents(spark, sf).collect()}
    out = catalog.op2_language_id(spark, sf).collect()
    assert sorted(r.doc_id for r in out) == sorted(truth)
    held = [r for r in out if r.held_out]
    assert len(held) > 2500 and sum(truth[r.doc_id] == r.lang_pred for r in held) > 0.985 * len(held)
    assert all(0 <= r.score <= 1 for r in out) and sum(r.rejected for r in held) < 0.03 * len(held)


def rows(spark):
    a = [(i, "the quick brown fox and the lazy dog number " + "abcdefghij"[i % 10] * (i % 7), "en") for i in range(120)]
    b = [(1000 + i, "der schnelle braune fuchs und der hund zahl " + "abcdefghij"[i % 10] * (i % 7), "de") for i in range(120)]
    return a + b


def test_models_are_distributions(spark):
    df = spark.createDataFrame(rows(spark), SCHEMA)
    shared, _, _ = language_id.train(df.select("text", "lang"), rows=1000)
    models = shared.value
    symbols = sorted({c for _, t, _ in rows(spark) for c in t})
    for context in ("the ", "und ", "zzzz", "fox ", " ", ""):
        total = np.zeros(len(models.langs))
        for s in symbols:
            points = language_id._joined([np.array([ord(c) for c in context + s], np.uint32)])[0]
            keys = language_id.gram_keys(points)
            total += np.exp(models._log_p(keys, np.array([len(points) - 1])))[0]
        left = np.exp(models._log_p([k.copy() for k in language_id.gram_keys(
            language_id._joined([np.array([ord(c) for c in context + "一"], np.uint32)])[0])],
            np.array([language_id.ORDER - 1 + len(context)])))[0]
        assert np.allclose(total + left, 1, atol=1e-4), (context, total, left)


def test_predictions_rejection_and_edges(spark):
    odd = [(5000, None, None), (5001, "", "en"), (5002, "12 34 !!", None), (None, "the fox and the dog", None),
           (5003, "der hund und der fuchs", None), (5003, "der hund und der fuchs", None), (5004, "ЖЖЖ ЩЩЩ ЫЫЫ ЖЩЫ", None),
           (5005, "the dog " * 20000, None)]
    df = spark.createDataFrame(rows(spark) + odd, SCHEMA).selectExpr("*", "1 AS letters", "2 AS score", "3 AS entropies", "4 AS best")
    out = language_id.predictions(df).collect()
    assert len(out) == len(rows(spark)) + len(odd)
    by_id = {r.doc_id: r for r in out}
    for i in (5000, 5001, 5002):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert by_id[None].lang_pred == "en" and not by_id[None].held_out and by_id[5003].lang_pred == "de"
    assert by_id[5004].rejected and by_id[5004].lang_pred in ("de", "en") and by_id[5005].lang_pred == "en"
    assert language_id.predictions(df.limit(0)).count() == 0
    nothing = language_id.predictions(spark.createDataFrame([(1, "abc", None)], SCHEMA)).collect()
    assert [(r.lang_pred, r.rejected) for r in nothing] == [("und", True)]


def test_sample_is_bounded(spark):
    df = spark.createDataFrame([(f"text {i}", "a" if i % 3 else "b") for i in range(6000)], "text string, lang string")
    n = {r.lang: r["count"] for r in language_id._sample(df, 200).groupBy("lang").count().collect()}
    assert 120 < n["a"] < 280 and 120 < n["b"] < 280


def test_many_languages_share_the_budget(spark, monkeypatch):
    def text(lang, i):
        return " ".join(f"{chr(0x4E00 + lang)}{chr(0x4E00 + lang + 500)}" * (1 + (i + j) % 3) for j in range(8))

    docs = [(lang * 100 + i, text(lang, i), f"l{lang:03}") for lang in range(130) for i in range(9)]
    out = language_id.predictions(spark.createDataFrame(docs, SCHEMA)).collect()
    truth = {d: lang for d, _, lang in docs}
    assert len(out) == len(docs) and sum(truth[r.doc_id] == r.lang_pred for r in out) > 0.9 * len(docs)

    df = spark.createDataFrame([(f"{i} " + "x" * 100, f"l{i % 300}") for i in range(3000)] + [("y" * 100000, "long")], "text string, lang string")
    monkeypatch.setattr(language_id, "SAMPLE_SHARES", 100)
    few = language_id._sample(df, 9).collect()
    assert 600 < len(few) < 1300 and len({r.lang for r in few}) == 301
    short = language_id._sample(df, 10, characters=60000).collect()
    assert len({r.lang for r in short}) == 301 and sum(len(r.text) for r in short) < 90000
    assert language_id._level([1, 5, 100, 100], 50) == 22 and language_id._level([1, 2], 3) == float("inf")


def test_a_language_of_one_text_is_learned(spark):
    df = spark.createDataFrame([(f"one text {i}", f"l{i}") for i in range(40)], "text string, lang string")
    assert language_id._sample(df, 10).where("NOT held").count() == 40


def plain_model(texts, order, symbols):
    """Interpolated modified Kneser-Ney by dictionaries: the probability of a character behind a string."""
    pad = " " * (order - 1)
    counts = {order: Counter((pad + t)[i:i + order] for t in texts for i in range(len(t)))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    d = {n: discounts(np.array([sum(c == k for c in cs.values()) for k in (1, 2, 3, 4)])) for n, cs in counts.items()}

    def p(context, c, n=order):
        if n == 0:
            return 1 / symbols
        own = context[len(context) - n + 1:]
        follow = {g: x for g, x in counts[n].items() if g[:-1] == own}
        total = sum(follow.values())
        if not total:
            return p(context, c, n - 1)
        left = sum(d[n][min(x, 3)] for x in follow.values())
        x = follow.get(own + c, 0)
        return (x - d[n][min(x, 3)] + left * p(context, c, n - 1)) / total

    return lambda text: [p((pad + text)[i:i + order - 1], text[i]) for i in range(len(text))]


def test_probabilities_equal_a_plain_model(spark):
    docs = [(t, lang) for _, t, lang in rows(spark)[::7]] + [("a", "en"), ("ab ab", "en"), ("the the", "de")]
    counts = language_id._counts(spark.createDataFrame(docs, "text string, lang string")).toArrow()
    models = language_id.Models(counts)
    clean = {x: ["".join(map(chr, language_id.characters(t)[0])) for t, own in docs if own == x] for x in models.langs}
    symbols = len({c for texts in clean.values() for t in texts for c in t}) + 1
    plain = [plain_model(clean[x], language_id.ORDER, symbols) for x in models.langs]
    for text in ("the quick", "a", "der hund", "zebra fox", "ab the fuchs", "qq"):
        points, begins = language_id._joined([language_id.characters(text)[0]])
        at = np.arange(begins[0], begins[0] + len(text))
        got = np.exp(models._log_p(language_id.gram_keys(points), at))
        assert np.allclose(got, np.array([m(text) for m in plain]).T, rtol=1e-4), text
