"""Collocations against a plain count of all phrases."""

import random
import re
from collections import Counter, defaultdict

import pytest

from trialstats.llm import catalog, collocations

SCHEMA = "doc_id bigint, text string, lang string"
SF = "/root/testdata/sf0.01"


def plain(docs, longest=3, least=10, subsumed=50, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, a in found.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    if 100 * a >= subsumed * counts[p[i:i + m]]:
                        dropped.add(p[i:i + m])
        rows = []
        for p, a in found.items():
            if p not in dropped:
                cuts = [(10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for i, (score, a, p, left, right) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [t for _, t in df.dtypes][3:] == ["bigint"] * 5
    return sorted(map(tuple, df.collect()))


def test_whole_table(spark):
    docs = [(d.text, d.lang) for d in catalog.documents(spark, SF).collect()]
    assert got(catalog.op12_collocations(spark, SF)) == plain(docs)


@pytest.mark.parametrize("longest,least", [(2, 3), (3, 10), (5, 2)])
def test_random_texts_and_odd_rows(spark, monkeypatch, longest, least):
    monkeypatch.setattr(collocations, "HEAVY", 8)
    rng = random.Random(longest)
    vocabulary = ["A", "the", "The", "É", "é", "of", "to", "dog\x85s", " ", "cat", "on.", "x,y", "a;\x0bb", "\x00", "😀"]
    docs = [(" \t".join(rng.choice(vocabulary[: 4 + i % 12]) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None])) for i in range(300)]
    docs += [(None, "en"), ("", None), (" \t\n", "xx"), ("new york new york. " * 400, "und"), ("of the " * 9000, "en")] + [("same row here", "fr")] * 40
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], SCHEMA).selectExpr("*", "1 AS prefix", "2 AS part", "3 AS n", "4 AS next")
    assert got(collocations.collocations(df.repartition(5), max_words=longest, min_count=least, chunk_bytes=2000)) == plain(docs, longest, least)


def test_best_of_a_language(spark):
    docs = [("a b a b c d c d e f", "x")] * 12 + [("a b", "y")] * 9
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], SCHEMA)
    assert got(collocations.collocations(df, top=2)) == plain(docs, top=2)
    assert {r[0] for r in got(collocations.collocations(df))} == {"x"}
    assert collocations.collocations(df.limit(0)).count() == 0


def test_crowded_filter_changes_nothing(spark, monkeypatch):
    docs = [(d.text, d.lang) for d in catalog.documents(spark, SF).collect()]
    monkeypatch.setattr(collocations, "FILTER_BITS", 0)
    assert got(collocations.collocations(catalog.documents(spark, SF), min_count=3)) == plain(docs, least=3)


def test_large_numbers_are_exact(spark):
    a, left, right = 3 * 10**12 + 7, 4 * 10**12 + 1, 10**13 + 3
    row = spark.range(1).selectExpr(f"{a}L AS a", f"{left}L AS l", f"{right}L AS r").selectExpr(f"{collocations.SCORE} AS s").first()
    assert row.s == 10**6 * a * a // (left * right)


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_words_are_cut_alike_in_slices_of_any_size(monkeypatch, size):
    monkeypatch.setattr(collocations, "SLICE_BYTES", size)
    texts = ["", "A bc\tD.", "x" * 50 + " y", "  ", "one, two;three\n\nfour", "é È", "end"]
    chunk = collocations._Chunk([t.encode() for t in texts], ["a", "b", "a", "a", "c", "b", "a"])
    got = list(zip(chunk.langs.take(chunk.lang).to_pylist(), chunk.words.take(chunk.tokens).to_pylist()))
    want = []
    for t, lang in zip(texts, "abaacba"):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t) + "\n"
        want += [(lang, w if w.strip() else "\n") for w in re.findall(r"[.,;:!?\x0A-\x0D]|[^\x20\x09.,;:!?\x0A-\x0D]+", lower) for w in [re.sub(r"[.,;:!?\x0B-\x0D]", "\n", w)]]
    assert got == want
