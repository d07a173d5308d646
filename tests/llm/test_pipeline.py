"""The pipeline's stages against brute force on their own inputs, and the registered names."""
import hashlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline as C
from gridtel.llm.queries import ORACLE, QUERIES, byte_bpe_path

from .test_decontam import brute as contaminated
from .test_minhash import brute as classes

SF = "/root/testdata/sf0.001"


def test_names():
    import __spark_entry__ as E
    assert [n for n, _ in C.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "bpe"]
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns = docs.columns
    steps = dict(C.STAGES)

    kept = steps["toxicity"](spark, docs, SF).cache()
    assert kept.columns == columns
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    left = {r["doc_id"] for r in kept.collect()}
    all_ids = {r["doc_id"] for r in docs.collect()}
    assert len(all_ids - left - toxic) <= 0.03 * len(all_ids)
    assert len(toxic & all_ids - left) >= 0.7 * len(toxic & all_ids)   # ten toxic texts to learn from

    exact = steps["exact_dedup"](spark, kept, SF).cache()
    want = {}
    for r in kept.collect():
        want[r["text"]] = max(want.get(r["text"], -1), r["doc_id"])
    assert exact.columns == columns and {r["doc_id"] for r in exact.collect()} == set(want.values())

    near = steps["near_dedup"](spark, exact, SF).cache()
    pairs = [(r["doc_id"], r["text"]) for r in exact.collect()]
    assert near.columns == columns and {r["doc_id"] for r in near.collect()} == {c for _, c, _ in classes(pairs)}

    clean = steps["decontamination"](spark, near, SF).cache()
    expect = {r["doc_id"] for r in near.collect() if not contaminated(r["text"], items)[4]}
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == expect

    library = Tokenizer.from_file(byte_bpe_path())
    out = {r["doc_id"]: r for r in steps["bpe"](spark, clean, SF).collect()}
    for r in clean.collect():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        got = out.pop(r["doc_id"])
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
    assert not out
    assert C.run(spark, SF).count() == clean.count()


def test_toxic_documents_go(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = {r["doc_id"] for r in dict(C.STAGES)["toxicity"](spark, docs, sf).select("doc_id").collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    toxic, clean = ({i for i, t in labels.items() if t == which} for which in (1, 0))
    assert len(toxic - left) >= 0.93 * len(toxic) and len(clean & left) >= 0.98 * len(clean)
