"""BPE against the tokenizers library, with many chunk joins and awkward texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from trialstats.llm import bpe, catalog, token_counts

PATH = catalog.TOKENIZER
TEXTS = [
    "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "it's  \t done's.", " x  y", "　 a 　b", "naïve\u0085 x",
    "<|endoftext|>", "a<|endoftext|>b", "a <|endoftext|> <|endoftext|>b", "<|endoftext", "|endoftext|> <", "日本語のテキスト " * 60,
    "x" * 5000, "é" * 3000, "ab" * 4000 + " " + "ba" * 900, "🙂🙃" * 700, "1234567890" * 300, "\x1c a\x1f b\x00c", "foo  bar",
    "word<|endoftext|>" * 300, " " * 3000 + "end", "\n\n  \n" * 500,
]


def rows(spark, texts, ids=None):
    return spark.createDataFrame(list(zip(ids or range(len(texts)), texts)), "doc_id bigint, text string")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def mixed(seed):
    rng = random.Random(seed)
    parts = ["the ", "naïve", " ", "\n", "日本", "x" * 40, "<|endoftext|>", "don't", "  ", "42", "—", "é" * 30, " ", "word word "]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(400)))


@pytest.mark.parametrize("bits", [3, 6, 10])
def test_same_ids_as_the_library(spark, library, bits):
    texts = TEXTS + [mixed(s) for s in range(40)] + ["shared passage " * 100 + mixed(s) for s in range(10)]
    got = {r.doc_id: r.ids for r in bpe.encode(rows(spark, texts), PATH, bits=bits).collect()}
    for i, text in enumerate(texts):
        assert got[i] == expected(library, text)[0], (bits, text[:60])


def test_joins_without_sure_boundaries_are_repaired(library):
    c = bpe.Codec(PATH)
    for text in ["x" * 300, "é日本" * 100, "a<|endoftext|>b" * 20, "foo bar" * 30, mixed(5), "the" + " " * 50 + "end"]:
        data = text.encode()
        for step in (1, 2, 5, 11):
            starts = [i for i in range(0, len(data), step) if data[i] & 0xC0 != 0x80]
            bounds = sorted({0, *starts, len(data)})
            chunks = [c.encode(data[a:b].decode()) for a, b in zip(bounds, bounds[1:])]
            assert bpe.join_chunks(data, bounds, chunks, c).tolist() == expected(library, text)[0]


def test_round_trip_and_digests(spark, library):
    texts = [*TEXTS, None, TEXTS[10], TEXTS[10]]
    df = rows(spark, texts, [*range(len(texts) - 2), None, 3]).selectExpr("*", "text AS ids", "1 AS decoded", "'x' AS key")
    back = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert len(back) == len(texts)
    assert all(r.decoded == expected(library, r.text)[1] == (r.text or "") for r in back)
    out = bpe.document_digests(df, PATH).collect()
    assert len(out) == len(texts)
    by_sha = {}
    for t in texts:
        ids, text = expected(library, t)
        by_sha[hashlib.sha256(text.encode()).hexdigest()] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    assert all(by_sha[r.decoded_sha256] == (r.n_tokens, r.ids_sha256) for r in out)


def test_whole_table(spark, library):
    out = catalog.op1_bpe(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in catalog.documents(spark, "/root/testdata/sf0.001").collect()}
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        ids, text = expected(library, texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_chunks_follow_content():
    passage = " ".join(f"word{i * 7919 % 100003}" for i in range(3000)).encode()
    rng = np.random.default_rng(1)
    found = []
    for _ in range(2):
        text = rng.integers(97, 122, 3000, dtype=np.uint8).tobytes() + passage
        bounds = bpe.chunk_bounds(text)
        found.append({text[a:b] for a, b in zip(bounds, bounds[1:])})
    assert sum(map(len, found[0] & found[1])) > 0.8 * len(passage)


def test_empty_tables(spark):
    empty = rows(spark, []).limit(0)
    assert bpe.encode(empty, PATH).count() == 0
    assert bpe.document_digests(empty, PATH).count() == 0
    assert token_counts.suffix_sums(token_counts.length_histogram(empty, PATH)).count() == 0


def test_token_counts_against_brute_force(spark, library):
    texts = [t for t in TEXTS if len(t) < 3000] + [None, "a", "a"] + ["word " * k for k in range(0, 4000, 97)]
    lengths = sorted(len(expected(library, t)[0]) for t in texts)
    sums = token_counts.suffix_sums(token_counts.length_histogram(rows(spark, texts), PATH)).cache()
    for r in sums.collect():
        L = r.n_tokens
        assert r.n_docs == lengths.count(L) and r.total_tokens == sum(lengths)
        assert r.docs_at_least == sum(x >= L for x in lengths)
        assert r.tokens_at_least == sum(x for x in lengths if x >= L)
        assert r.truncated_tokens == sum(min(x, L) for x in lengths)
    limits = [0, 1, 5, 100, 1024, 10**6]
    got = {r.context_limit: r for r in token_counts.at_limits(sums, limits).collect()}
    for limit in limits:
        assert got[limit].docs_over == sum(x > limit for x in lengths)
        assert got[limit].truncated_tokens == sum(min(x, limit) for x in lengths)
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    found = {r.share: r.n_tokens for r in token_counts.quantiles(sums, shares).collect()}
    for s in shares:
        assert found[s] == next(x for i, x in enumerate(lengths) if (i + 1) / len(lengths) >= s)


def test_registered_token_counts_cover_the_whole_table(spark, library):
    sf = "/root/testdata/sf0.01"
    lengths = sorted(len(library.encode(d.text or "", add_special_tokens=False).ids) for d in catalog.documents(spark, sf).collect())
    out = catalog.op3_token_counts(spark, sf).collect()
    assert {r.n_tokens: r.n_docs for r in out} == Counter(lengths)
    for r in out:
        longer = [n for n in lengths if n >= r.n_tokens]
        assert (r.docs_at_least, r.tokens_at_least, r.total_tokens) == (len(longer), sum(longer), sum(lengths))
        assert r.truncated_tokens == sum(min(n, r.n_tokens) for n in lengths)


def test_repeated_and_long_texts_are_counted(spark, library):
    texts = ["same text"] * 5 + [None, "", "long words " * 30000]
    out = {r.n_tokens: r.n_docs for r in token_counts.length_histogram(rows(spark, texts), PATH).collect()}
    assert out == Counter(len(library.encode(t or "", add_special_tokens=False).ids) for t in texts)
