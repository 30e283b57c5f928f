import hashlib
import re
import zlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from strataframe.llm import bpe, pii, toxicity

from brute import brute_classes, brute_contaminated, brute_print

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_and_their_order():
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "pii", "bpe"]


def test_each_stage_against_brute_force(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    labels = spark.read.parquet(f"{tiny}/labels.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    held = toxicity.crc_bucket("doc_id", 5) == 0
    model = toxicity.learn(docs, labels, held)
    tox = {i for i, t in rows.items() if toxicity.words_of(t) and model.scores([t], {})[0] >= 0.5}
    rows = {i: t for i, t in rows.items() if i not in tox}
    ids = sorted(rows)
    first = brute_classes([brute_print(rows[i]) for i in ids], ids)
    rows = {i: rows[i] for i, c in zip(ids, first) if i == c}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    rows = {i: t for i, t in rows.items() if not brute_contaminated(t, items)}
    stage, seen = docs, {}
    for name, f in corpus_pipeline.STAGES:
        stage = f(spark, stage, tiny)
        seen[name] = stage
        if name != "bpe":
            assert stage.columns == COLUMNS
    kept = {r.doc_id: r.text for r in seen["benchmark_decontamination"].collect()}
    assert kept == rows
    spans = pii.learn(seen["benchmark_decontamination"])
    want = {}
    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    for i, t in rows.items():
        for kind, s, e in sorted(pii.find_spans(t, spans)[1], key=lambda x: -x[1]):
            t = t[:s] + f"<{kind}>" + t[e:]
        code = library.encode(t, add_special_tokens=False).ids
        want[i] = (len(code), hashlib.sha256(" ".join(map(str, code)).encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, tiny).collect()}
    assert got == want
    assert 0 < len(tox) < 60 and len(got) > 100
    assert all(zlib.crc32(str(i).encode()) >= 0 and not re.search("@mail", rows[i]) or pii.base_spans(rows[i]) for i in got)


def test_empty_documents(spark, tiny):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, tiny)
    assert docs.count() == 0


def test_nulls_everywhere(spark, tiny):
    text = "plain words for a clean document that says nothing of note"
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, text, None, None, None), (1, text, None, None, None), (2, "", "en", "s", 0), (None, text, "x", None, 7)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, tiny)
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "2"]
