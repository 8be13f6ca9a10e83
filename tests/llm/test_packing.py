"""Packing: every id in one piece, sequences within their length, little padding, ids as the tokenizers library gives them."""

import struct
import zlib
from collections import defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from trialstats.llm import catalog, packing

SCHEMA = "doc_id bigint, text string"
SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def check(rows, capacity=2048):
    """Sequences without gaps, within the capacity; returns the pieces of each document and the tokens of each sequence."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length > 0
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for group in by_sequence.values():
        at = 0
        for r in sorted(group, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return by_doc, {s: sum(r.length for r in g) for s, g in by_sequence.items()}


def check_document(pieces, ids):
    at = 0
    for r in sorted(pieces, key=lambda r: r.start):
        data = ids[at:at + r.length]
        assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(struct.pack(f"<{len(data)}I", *data)))
        at += r.length
    assert at == len(ids)


def test_whole_table(spark, tokenizer):
    out = catalog.op13_packing(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert all(t == "bigint" for _, t in out.dtypes)
    by_doc, tokens = check(out.collect())
    docs = catalog.documents(spark, SF).collect()
    assert sorted(by_doc) == sorted(d.doc_id for d in docs)
    for d in docs:
        check_document(by_doc[d.doc_id], [*tokenizer.encode(d.text, add_special_tokens=False).ids, 1])
    assert sum(tokens.values()) > 0.97 * 2048 * len(tokens)


@pytest.mark.parametrize("text", [
    "plain words, and\nlines", " leading", "trailing ", "two  spaces", "a\n\nb", "a \n b", "tab\there", "no break", "é ñ ü ß",
    "emoji 😀 here", "it's don't 'll", "<|endoftext|> x", "a<s>b </s>", "x" * 5000, "\n", " ", "日本 語", "\x00 \x7f", "Ā ɏ ɐ", "a\r\nb",
])
def test_words_encode_as_texts(tokenizer, text):
    encoder = packing.WordEncoder(PATH)
    texts = [text, text + " " + text, "he said " + text + "\nthen", ""]
    for _ in range(2):
        for t, ids in zip(texts, encoder.encode(texts)):
            assert ids.tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def test_encoder_starts_anew_when_full(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 5)
    encoder = packing.WordEncoder(PATH)
    for k in range(5):
        texts = [f"word{k} other{k + i} again and again" for i in range(4)]
        assert [x.tolist() for x in encoder.encode(texts)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_cuts_fill_places():
    for capacity in (1, 2, 7, 64, 2048):
        for n in range(1, 3 * capacity):
            lengths = packing.cut_lengths(n, capacity)
            assert sum(lengths) == n and all(0 < x <= capacity for x in lengths)
            for x in lengths:
                place = capacity // (capacity // x)
                assert place - x <= packing.SLACK * place


def test_odd_rows_and_real_ids(spark, tokenizer):
    docs = [(None, None), (None, ""), (1, "a"), (1, "a"), (2, "long text " * 9000)] + [(10 + i, "copy of a page\n" * 30) for i in range(300)]
    docs += [(None, "null id " * 40)] * 50
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 AS row", "2 AS length", "3 AS class", "4 AS id", "5 AS sequence_id")
    placed = packing.pieces(df, PATH, capacity=256, with_ids=True, part_pieces=40)
    _, tokens = check(placed.collect(), 256)
    want = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in docs)
    assert sum(tokens.values()) == want
    packed = packing.sequences(placed, 256, pad_id=0).collect()
    assert len(packed) == len(tokens)
    for r in packed:
        used = tokens[r.sequence_id]
        assert len(r.ids) == (used if used & (used - 1) == 0 else 256) and set(r.ids[used:]) <= {0}
    pieces = placed.collect()
    long = sorted((p for p in pieces if p.doc_id == 2), key=lambda p: p.start)
    assert [i for p in long for i in p.ids] == [*tokenizer.encode("long text " * 9000, add_special_tokens=False).ids, 1]


def test_few_or_no_rows(spark):
    one = packing.pieces(spark.createDataFrame([(1, "")], SCHEMA), PATH).collect()
    assert [(r.start, r.length, r.doc_tokens, r.sequence_id, r.offset) for r in one] == [(0, 1, 1, 0, 0)]
    assert packing.pieces(spark.createDataFrame([], SCHEMA), PATH).count() == 0
