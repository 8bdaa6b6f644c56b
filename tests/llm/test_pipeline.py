"""The corpus pipeline against a plain version over the smallest table, and on odd rows."""
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import base, closure, placed, plain_fingerprint

import corpus_pipeline
from zonaria.llm import pii, quality

SF = "/root/testdata/sf0.001"


def plain_pipeline(rows):
    measures = quality.Measures()
    texts = {i: t or "" for i, t in rows if quality.passes(measures.of([t or ""]))[0] == ""}
    ids = sorted(texts)
    prints = [plain_fingerprint(texts[i]) for i in ids]
    label = closure(len(ids), [[j for j, b in enumerate(prints) if bin(a ^ b).count("1") <= 4] for a in prints])
    texts = {i: texts[i] for k, i in enumerate(ids) if label[k] == k}
    first, out = {}, {}
    words = {i: list(re.finditer("[^\\x20\\x09-\\x0D]+", t)) for i, t in texts.items()}
    for i in sorted(texts):
        for k in range(len(words[i]) - 12):
            first.setdefault(tuple(w[0] for w in words[i][k:k + 13]), i)
    for i, text in texts.items():
        gone = [False] * len(words[i])
        for k in range(len(words[i]) - 12):
            if first[tuple(w[0] for w in words[i][k:k + 13])] < i:
                gone[k:k + 13] = [True] * 13
        runs = re.finditer("0+", "".join("01"[g] for g in gone))
        out[i] = "\n".join(text[words[i][r.start()].start():words[i][r.end() - 1].end()] for r in runs) if any(gone) else text
    for i, text in out.items():
        parts, at = [], 0
        for start, kind, end in base(text):
            if start >= at:
                parts.append(text[at:start] + f"[{pii.KINDS[kind]}]")
            at = max(at, end)
        out[i] = "".join(parts) + text[at:]
    return out


def test_pipeline_against_plain(spark):
    from tokenizers import Tokenizer
    import public_tokenizers

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain_pipeline([(r.doc_id, r.text) for r in docs.collect()])
    rows = corpus_pipeline.run(spark, SF).collect()
    got = defaultdict(bytes)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        assert r.start * 4 == len(got[r.doc_id])
        got[r.doc_id] += r.ids
    assert set(got) == set(want) and 50 < len(want) < 200
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in want.items():
        assert np.frombuffer(got[i], "<u4").tolist() == [*plain.encode(text, add_special_tokens=False).ids, 0], i
    assert placed(rows, 2048) <= -(-sum(r.length for r in rows) // 2048) + 2


@pytest.mark.parametrize("empty", [False, True])
def test_stages_on_odd_rows(spark, empty):
    text = "La zona residencial mixta permite vivienda y comercio en el primer piso junto al correo x@y.org de la oficina"
    rows = [(1, text, "es", None, 5, 7), (1, text, "es", "s", 5, 7), (None, text, None, None, None, 7), (2, None, "es", "s", 0, 7), (3, "", None, "s", 0, 7), (4, "a " * 400, "es", "s", 0, 7)]
    docs = spark.createDataFrame([] if empty else rows, "doc_id long, text string, lang string, source string, n_chars long, `_group` int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), out.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == (set() if empty else {1, None})
    if not empty:
        one = docs.where("doc_id = 1").collect()
        assert len(one) == 1 and "[email]" in one[0].text and one[0].n_chars == len(one[0].text)
        assert docs.where(F.col("doc_id").isNull()).count() == 1
