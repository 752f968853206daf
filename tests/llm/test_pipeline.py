from __future__ import annotations

from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline


def test_stages_pass_rows_on(spark, messy, tmp_path):
    docs = messy
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "encode":
            assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / name))
            docs = spark.read.parquet(str(tmp_path / name))
            seen[name] = docs.count()
    assert seen["quality"] > seen["near_duplicates"] == seen["repeated_passages"]
    rows = out.collect()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((str(r.doc_id), tuple(library.encode(r.text, add_special_tokens=False).ids)) for r in docs.collect())
    assert Counter((str(r.doc_id), tuple(r.token_ids)) for r in rows) == want


def test_empty_table_and_run(spark, no_docs, tmp_path):
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
