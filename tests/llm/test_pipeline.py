"""The pipeline on the small tables: stages keep columns, decide, and hand on what they keep."""

import zlib

import corpus_pipeline
from memberlytics.llm import encoders


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before, names = docs.columns, {r.doc_id: r.text for r in docs.collect()}, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert set(after) <= set(before)
        if name != "line_dedup":
            assert all(before[i] == text for i, text in after.items())
        before = after
        names.append(name)
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination"]
    encoder = encoders.byte_pieces(encoders.default_path("byte_bpe_50k.json"))
    ids = {i: encoder.encode([text or ""])[0] + (2).to_bytes(4, "little") for i, text in before.items()}
    packed = corpus_pipeline.packing(spark, docs, sf_dir).collect()
    assert {r.doc_id for r in packed} == set(before)
    for r in packed:
        assert zlib.crc32(ids[r.doc_id][4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32
