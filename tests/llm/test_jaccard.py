"""Near duplicates against brute force over all pairs."""

import random
from collections import defaultdict
from fractions import Fraction

import numpy as np

from trialstats.llm import catalog, components, jaccard

SCHEMA = "doc_id bigint, text string"


def grams(text):
    w = (text or "").split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain(docs):
    sets = [grams(t) for _, t in docs]
    owners = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            owners[g].append(i)
    parent, links = list(range(len(docs))), [0] * len(docs)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for g in s:
            for j in owners[g]:
                shared[j] += j != i
        for j, n in shared.items():
            if j != i and 5 * n >= 4 * (len(s) + len(sets[j]) - n):
                links[i] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(docs):
        least[root(i)] = min(least.get(root(i), d), d)
    return [(d, least[root(i)], links[i]) for i, (d, _) in enumerate(docs)]


def edited(rng, words, share):
    return " ".join("".join(rng.sample("abcdefghij", 6)) if rng.random() < share else w for w in words)


def corpus():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghijkl") for _ in range(5)) for _ in range(900)]
    docs, base = [], [rng.choices(vocabulary, k=120) for _ in range(30)]
    for words in base:
        for share in (0, 0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.2):
            docs.append(edited(rng, words, share))
    hot = rng.choices(vocabulary, k=100)
    docs += [edited(rng, hot, 0.01) for _ in range(150)] + [" ".join(hot)] * 80
    passage = " ".join(rng.choices(vocabulary, k=60))
    docs += [passage + " " + " ".join(rng.choices(vocabulary, k=60)) for _ in range(40)]
    docs += ["one two three", "one two three", "one", "", "a  b\tc\nd e"] + ["a b c d e"]
    return [(i * 3 % 1009, t) for i, t in enumerate(docs)]


def test_against_all_pairs(spark):
    docs = corpus()
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 AS key", "2 AS digest", "3 AS bands", "4 AS task")
    want = sorted(plain([d for d in docs if d[1].split()]) + [(d, d, 0) for d, t in docs if not t.split()])
    for chunk in (256, 40):
        got = sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard.near_duplicates(df, chunk=chunk).collect())
        assert [g[0] for g in got] == [w[0] for w in want]
        assert sum(g == w for g, w in zip(got, want)) >= 0.999 * len(want)


def test_repeated_and_null_rows(spark):
    text = "w1 w2 w3 w4 w5 w6 w7"
    docs = [(1, text), (1, text), (2, text), (None, text), (3, None), (3, None), (4, " \n"), (5, "x y z"), (6, "x y z " * 30000)]
    df = spark.createDataFrame(docs, SCHEMA)
    out = sorted(((r.doc_id, r.class_id, r.copy_id, r.n_links) for r in jaccard.document_classes(df).collect()), key=str)
    assert out == sorted([(1, 1, 1, 3), (1, 1, 1, 3), (2, 1, 1, 3), (None, 1, 1, 3), (3, 3, 3, 0), (3, 3, 3, 0), (4, 4, 4, 0),
                          (5, 5, 5, 0), (6, 6, 6, 0)], key=str) or any(r[1] is None for r in out)
    kept = jaccard.one_per_class(df.selectExpr("*", "1 AS __no2", "2 AS class_id"))
    assert kept.columns == ["doc_id", "text", "__no2", "class_id"]
    assert kept.where("text LIKE 'w1%'").count() == 1 and kept.count() == 6
    assert jaccard.document_classes(df.limit(0)).count() == 0 and jaccard.one_per_class(df.limit(0)).count() == 0


def test_null_and_shared_ids_keep_classes_apart(spark):
    texts = [f"{w}1 {w}2 {w}3 {w}4 {w}5 {w}6 {w}7" for w in "abcdef"]
    docs = [(None, texts[0]), (None, texts[1]), (7, texts[1]), (1, texts[2]), (1, texts[3]), (1, " "), (None, " "), (None, texts[4]), (None, texts[4])]
    docs += [(3, texts[5]), (2, texts[5] + " "), (None, texts[5])]
    df = spark.createDataFrame(docs, SCHEMA)
    out = jaccard.near_duplicates(df).join(df.select("doc_id", "text", jaccard.text_key("text").alias("key")).distinct().withColumnRenamed("doc_id", "i"),
                                           "key").where("doc_id <=> i").collect()
    ids = {(r.text.strip(), r.class_id, r.copy_id) for r in out}
    assert ids == {(texts[0], None, None), (texts[1], 7, 7), (texts[2], 1, 1), (texts[3], 1, 1), (texts[4], None, None), (texts[5], 2, 2),
                   ("", 1, 1), ("", None, None)}
    keys = defaultdict(set)
    for r in out:
        keys[r.text.strip()].add(r.class_key)
    assert keys.pop("") == {None}
    assert all(len(k) == 1 for k in keys.values()) and len(set.union(*keys.values())) == 6
    assert len({r.class_key for r in jaccard.document_classes(df).collect()}) == 7
    kept = sorted(((r.doc_id, r.text) for r in jaccard.one_per_class(df).collect()), key=str)
    assert kept == sorted([(None, texts[0]), (7, texts[1]), (1, texts[2]), (1, texts[3]), (1, " "), (None, " "), (None, texts[4]), (2, texts[5] + " ")], key=str)


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(d.doc_id, d.text) for d in catalog.documents(spark, sf).collect()]
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in catalog.op8_ngram_jaccard(spark, sf).collect())
    want = sorted(plain(docs))
    assert sum(g == w for g, w in zip(got, want, strict=True)) >= 0.995 * len(want)
    assert any(n for _, _, n in want)


def test_banding_reaches_its_recall():
    bands, rows = jaccard.banding()
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9995 and bands * rows <= 256
    rng = np.random.default_rng(1)
    hits = 0
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**64, 180, dtype=np.uint64))
        b = np.unique(np.concatenate([a[20:], rng.integers(0, 2**64, 20, dtype=np.uint64)]))
        hits += (jaccard.signature(a, bands, rows) == jaccard.signature(b, bands, rows)).any()
    assert hits >= 299
    assert jaccard.linked([np.array([1, 2, 3, 4], np.uint64), np.array([1, 2, 3, 4, 5], np.uint64)], Fraction(4, 5))[0, 1]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50 + i) for i in range(50)] + [(7, 7), (300, 301), (301, 300)]
    out = dict(map(tuple, components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert out == {i: 0 for i in range(41)} | {i: 50 for i in range(50, 101)} | {300: 300, 301: 300}


def test_one_per_class_keeps_columns_of_any_name(spark):
    words = [f"w{i}" for i in range(40)]
    docs = [(1, " ".join(words)), (2, " ".join([*words[:-1], "x"])), (3, "another text of its own here"), (4, None), (4, None), (5, " ")]
    df = spark.createDataFrame(docs, SCHEMA).selectExpr(
        "*", "doc_id AS row", "1 AS id", "2 AS mark", "3 AS no", "4 AS blank", "5 AS key", "6 AS __key", "7 AS __row", "8 AS __no")
    out = jaccard.one_per_class(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id, r.row) for r in out.collect()) == [(1, 1), (3, 3), (4, 4), (4, 4), (5, 5)]
