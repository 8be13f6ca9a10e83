"""Model scores against a plain interpolated modified Kneser-Ney model."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from trialstats.llm import catalog, hashes, lm

SCHEMA = "doc_id bigint, text string"
SF = "/root/testdata/sf0.01"


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def plain(docs, order):
    train = [words(t) for i, t in docs if not held(i)]
    pad = ["<s>"] * (order - 1)
    counts = {order: Counter(tuple((pad + w)[i:i + order]) for w in train for i in range(len(w)))}
    for m in range(order - 1, 0, -1):
        counts[m] = Counter(g[1:] for g in counts[m + 1])
    d = {m: hashes.discounts([sum(c == k for c in counts[m].values()) for k in (1, 2, 3, 4)]) for m in counts}
    total, mass = {}, {}
    for m, cs in counts.items():
        total[m], mass[m] = defaultdict(float), defaultdict(float)
        for g, c in cs.items():
            total[m][g[:-1]] += c
            mass[m][g[:-1]] += d[m][min(c, 3)]
    raw = Counter(w for t in train for w in t)
    n, v = sum(raw.values()), len(raw)

    def p(g):
        if not g:
            return 1 / (v + 1)
        m, context = len(g), g[:-1]
        if not total[m].get(context):
            return p(g[1:])
        c = counts[m].get(g, 0)
        return (max(c - d[m][min(c, 3)], 0) + mass[m][context] * p(g[1:])) / total[m][context]

    out = []
    for i, t in docs:
        w = words(t)
        score = sum(math.log10(p(tuple((pad + w)[k:k + order]))) for k in range(len(w)))
        base = sum(math.log10((raw[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        out.append((i, held(i), len(w), sum(raw[x] > 0 for x in w), n, base, score))
    return out


def same(got, want):
    key = lambda r: (r[0] is not None, r[0], r[2], r[6])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g[5:] == pytest.approx(w[5:], rel=1e-9)


@pytest.mark.parametrize("order,block_bytes", [(2, 10**9), (2, 2000), (3, 1500)])
def test_against_plain_model(spark, order, block_bytes):
    rng = random.Random(order)
    vocabulary = ["A", "the", "The", "É", "x y", "of", "to", "dog", "cat", "sat", "on"]
    docs = [(i, " ".join(rng.choice(vocabulary[: 3 + i % 9]) for _ in range(rng.randrange(40)))) for i in range(150)]
    docs += [(None, "the dog"), (7, None), (7, ""), (8, "the the\tthe\n"), (8, "the the\tthe\n"), (900, "new words only")]
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 AS block", "2 AS shard", "3 AS held_out", "4 AS mark")
    same(lm.scores(df, order=order, block_bytes=block_bytes).collect(), plain(docs, order))


def test_whole_table_beats_the_baseline(spark):
    docs = [(d.doc_id, d.text) for d in catalog.documents(spark, SF).collect()]
    out = catalog.op4_lm(spark, SF).collect()
    same(out, plain(docs, lm.ORDER))
    assert sum(r.score for r in out if r.held_out) > sum(r.base_score for r in out if r.held_out)


def test_without_training_or_rows(spark):
    ids = [i for i in range(100) if held(i)][:3]
    out = lm.scores(spark.createDataFrame([(i, "a b") for i in ids], SCHEMA)).collect()
    assert [(r.score, r.n_known, r.train_tokens) for r in out] == [(0.0, 0, 0)] * 3
    assert lm.scores(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_uses_context_beyond_one_word(spark, tmp_path):
    docs = [(i, "a b c\nx b d\n" * 3) for i in range(20)] + [(100, "a b d")]
    spark.createDataFrame(docs, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    same(catalog.op4_lm(spark, str(tmp_path)).collect(), plain(docs, 3))
