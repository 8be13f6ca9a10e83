"""Quality measures against a plain version, fences and verdicts."""

import random
import re

from trialstats.llm import catalog, quality

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string"


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            covered |= set(range(i, i + 5))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), n < 10 or 100 * len(covered) > 20 * n


def test_measures_against_plain(spark):
    rng = random.Random(4)
    texts = [None, "", "\n\n", "a b c d e a b c d e", " \x85é #|<> x", "x\ny\nx\n \nx"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += ["\n".join(rng.choice(["é è", "##", "", " ", "a\tb"]) for _ in range(rng.randrange(30))) for _ in range(40)]
    df = spark.createDataFrame([(i, t, None if i % 3 else "l", "s") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in quality.verdicts(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(t), t
        assert not (r.base_failed and r.kept)


def test_whole_table(spark):
    out = {r.doc_id: r for r in catalog.op10_quality(spark, SF).collect()}
    docs = catalog.documents(spark, SF).collect()
    assert sorted(out) == sorted(d.doc_id for d in docs)
    for d in docs:
        r = out[d.doc_id]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(d.text)


def test_agrees_with_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in catalog.table(spark, sf, "labels").collect()}
    out = [(r, labels[r.doc_id]) for r in catalog.op10_quality(spark, sf).collect() if r.doc_id in labels]
    bad = [r for r, q in out if q == 0]
    good = [r for r, q in out if q == 1 and not r.base_failed]
    assert sum(not r.kept for r in bad) > 0.95 * len(bad)
    assert sum(r.kept for r in good) > 0.99 * len(good)


def test_thresholds_follow_the_group(spark):
    def doc(length, i):
        return " ".join(f"{'abcdefgh'[(i + k) % 8] * length}{(i * 31 + k * k) % 997}" for k in range(60))

    rows = [(i, doc(4, i), "x", "short") for i in range(150)] + [(1000 + i, doc(14, i), "x", "long") for i in range(150)]
    rows += [(5000, doc(14, 3), "x", "short"), (5001, doc(14, 3), "x", "long"), (5002, doc(4, 3), "x", "long")]
    out = {r.doc_id: r for r in quality.verdicts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert not out[5000].kept and "word_length" in out[5000].failed
    assert out[5001].kept and not out[5002].kept
    assert all(out[i].kept for i in range(150))


def test_clashing_names_repeats_and_empty(spark):
    rows = [(1, "a b", None, None), (1, "a b", None, None), (None, None, None, "s")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n_words", "2 AS row", "3 AS kept", "4 AS failed", "5 AS n", "6 AS one")
    out = quality.judge(df).collect()
    assert len(out) == 3 and not any(r.kept for r in out)
    assert quality.judge(df.limit(0)).count() == 0


def test_repeated_words_can_reject_alone(spark):
    rng = random.Random(9)
    words = [f"{chr(97 + i % 26)}ord{i:03}x" for i in range(900)]
    texts = [" ".join(rng.sample(words, 120)) for _ in range(200)]
    passage = " ".join(rng.sample(words, 10))
    odd = " ".join([*rng.sample(words, 60), passage, *rng.sample(words, 45), passage])
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate([*texts, odd])], SCHEMA)
    got = {r.doc_id: r for r in quality.verdicts(df).collect()}
    assert (got[200].base_failed, got[200].kept, got[200].failed) == (False, False, "repeat_share")
    assert all(got[i].kept for i in range(200))
