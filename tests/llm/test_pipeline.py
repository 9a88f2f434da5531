"""The pipeline, stage by stage, against the operators' plain definitions."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from riskloom.llm import packing, secrets, simhash
from riskloom.session import durable

SF = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = durable(stage(spark, docs, SF))
        assert docs.columns == columns
        kept.append({r.doc_id: r.text for r in docs.collect()})
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert kept[0] == {d: t for d, t in source.items() if any(c.isalpha() for c in t)}
    last = {}
    for d, t in kept[0].items():
        last[t] = max(d, last.get(t, d))
    assert kept[1] == {d: t for t, d in last.items()}
    # Components of fingerprints within two bits, by comparing all of them.
    ids = sorted(kept[1])
    prints = [simhash.fingerprint(kept[1][d]) for d in ids]
    near = [[j for j, q in enumerate(prints) if (p ^ q).bit_count() <= 2] for p in prints]
    least = list(range(len(ids)))
    while (smaller := [min(least[j] for j in around) for around in near]) != least:
        least = smaller
    assert set(kept[2]) == {ids[k] for k in set(least)}
    assert set(kept[3]) == set(kept[2])
    for d, t in kept[3].items():
        assert t == kept[2][d] or secrets.MASK in t
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).toPandas()
    encode = packing.encoder(packing._tokenizer_path()).encode
    assert Counter(pieces.groupby("doc_id").length.sum().to_dict()) == Counter(
        {d: len(encode(t, allowed_special="all")) + 1 for d, t in kept[3].items()})


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, SF).toPandas()
    assert (got.groupby("sequence_id").length.sum() <= packing.CAPACITY).all()
    assert len(corpus_pipeline.STAGES) == 5
