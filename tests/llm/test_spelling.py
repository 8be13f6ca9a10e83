"""Near words against all pairs, forms and roots against a plain version."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from trialstats.llm import catalog, spelling

SCHEMA = "doc_id bigint, text string"
SF = "/root/testdata/sf0.01"


def one_edit(a, b):
    """Whether two different words are one inserted, deleted or replaced code point apart."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def neighbours(words):
    """Near words through strings with one code point left out: a plain way that needs no index."""
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault(w[:i] + w[i + 1:], set()).add(w)
    near = {w: set() for w in words}
    for hole, group in holes.items():
        group = group | ({hole} if hole in near else set())
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    return near


def plain_words(docs):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def plain(n):
    near, form = neighbours(n), {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] is not None else None))
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert [t for _, t in df.dtypes] == ["string"] * 3 + ["bigint"] * 3
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table(spark):
    docs = [(d.doc_id, d.text) for d in catalog.documents(spark, SF).collect()]
    want = plain(plain_words(docs))
    assert got(catalog.op11_spelling(spark, SF)) == want
    assert sum(r[1] is not None for r in want) > 100


def test_plain_neighbours_are_all_pairs():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(2, 7))) for _ in range(90)})
    near = neighbours(words)
    assert all((b in near[a]) == one_edit(a, b) for a in words for b in words)


@pytest.mark.parametrize("letters,bucket_chars", [("ab", 10**6), ("abé", 500), ("abcdÿ", 400)])
def test_pairs_of_random_words(spark, letters, bucket_chars):
    """Runs of equal letters, and halves that many words share, also where they are dealt into pieces."""
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(2, 11))) for _ in range(500)}
    words |= {"aaaaaaa" + "".join(rng.choice(letters) for _ in range(3)) for _ in range(60)} | {"a" * k for k in range(2, 20)}
    df = spark.createDataFrame([(w, i + 2) for i, w in enumerate(sorted(words))], "word string, n bigint")
    number = {w: i + 2 for i, w in enumerate(sorted(words))}
    pairs = [tuple(r) for r in spelling.near_pairs(df, bucket_chars).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b, number[b]) for a, near in neighbours(words).items() for b in near}


def test_index_finds_edits_in_the_second_half_only():
    code = lambda w: np.frombuffer(w.encode("utf-32-le"), np.uint32).astype(np.int64)
    words = ["flavour", "flavor", "glavour", "flavours", "favour"]
    index = spelling.FmIndex([code(w) for w in words])
    q, t = index.one_edit([code("flavour")[::-1]], np.array([4]))
    assert {words[i] for i in t} == {"glavour", "favour"} and set(q) == {0}


def test_odd_rows(spark):
    docs = [(i, "Abendessen abendessem ABENDESSEN ÀBENDESSEN àbendessen") for i in range(40)]
    docs += [(None, "Abendessen abendesse"), (None, "Abendessen abendesse"), (1, None), (2, ""), (3, "abcdefghij" * 300), (4, "abcdefghij" * 300)]
    docs += [(7, "straßenbahn straßenbah straßenbah×÷x"), (7, "straßenbahn straßenbah straßenbah×÷x")] * 2
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 AS word", "2 AS n", "3 AS run", "4 AS id", "5 AS front", "6 AS half")
    assert got(spelling.document_variants(df.repartition(3))) == plain(plain_words(docs))
    assert spelling.document_variants(df.limit(0)).count() == 0
    assert spelling.document_variants(df.where("text = ''")).count() == 0


def test_roots_follow_long_chains(spark):
    words = ["abcdefgh"[:8 - 0]]
    chain = ["aaaaaaaa", "baaaaaaa", "bbaaaaaa", "bbbaaaaa", "bbbbaaaa", "bbbbbaaa", "bbbbbbaa", "bbbbbbba"]
    rows = [(w, 10**i) for i, w in enumerate(chain)] + [(words[0], 5)]
    out = got(spelling.variants(spark.createDataFrame(rows, "word string, n bigint")))
    assert out == plain(dict(rows))
    assert {r[2] for r in out} == {chain[-1], words[0]}
