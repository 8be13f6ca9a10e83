"""The pipeline, stage by stage, against plain versions of each stage's own input."""

import re
from collections import Counter

from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_jaccard import plain as plain_classes
from tests.llm.test_mixing import plain_targets
from tests.llm.test_quality import plain as plain_quality
from trialstats.llm import catalog, secrets
from trialstats.llm.common import documents, settle

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = documents(spark, SF)
    columns = docs.columns
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs.collect()
        docs = settle(stage(spark, docs, SF))
        assert name == "encode" or docs.columns == columns
    raw, good, unique, masked, mixed = (inputs[n] for n, _ in corpus_pipeline.STAGES)

    kept = {r.doc_id for r in good}
    for r in raw:
        assert r.doc_id not in kept or not plain_quality(r.text)[-1]
    labels = {r.doc_id: r.quality for r in catalog.table(spark, SF, "labels").collect()}
    clean = [r.doc_id for r in raw if labels.get(r.doc_id) == 1 and not plain_quality(r.text)[-1]]
    assert all(r in kept for r in clean)

    classes = {d: c for d, c, _ in plain_classes([(r.doc_id, r.text) for r in good])}
    assert Counter(r.doc_id for r in unique) == Counter(set(classes.values())) and len(unique) < len(good)

    before = {r.doc_id: r.text for r in unique}
    assert len(masked) == len(unique) and any("[SECRET]" in r.text for r in masked)
    for r in masked:
        spans = secrets.find(before[r.doc_id])
        assert r.text == secrets.redacted(before[r.doc_id], spans)
        assert not spans or r.n_chars == len(r.text)

    sizes, taken = Counter(), Counter()
    for r in masked:
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    for r in mixed:
        taken[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    targets = plain_targets(sizes)
    assert all(abs(taken[s] - targets[s]) <= 0.12 * targets[s] for s in sizes)
    assert max(Counter(r.doc_id for r in mixed).values()) <= 3

    library = Tokenizer.from_file(catalog.TOKENIZER)
    texts = {r.doc_id: r.text for r in mixed}
    out = docs.collect()
    assert Counter(r.doc_id for r in out) == Counter(r.doc_id for r in mixed)
    for r in out:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_awkward_documents(spark):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "", "en", None, 0), (2, "a b c d e f g h i j k", None, "s", 21),
            (2, "a b c d e f g h i j k", None, "s", 21), (3, "word " * 30000, "en", "s", 9), (4, "p q r s t u v w x password=abcdef123 z", "en", "s", 40)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for n in (len(rows), 0):
        docs = spark.createDataFrame(rows[:n], schema)
        for _, stage in corpus_pipeline.STAGES:
            docs = settle(stage(spark, docs, SF))
        assert (docs.count() > 0) == (n > 0)
        if n:
            assert {r.doc_id for r in docs.collect()} <= {2, 4}
