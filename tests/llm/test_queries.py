"""Every registered query on the small tables: its columns, its rows, and its SQL twin if there is one."""

import zlib
from collections import Counter

import duckdb
import pytest

from memberlytics.llm.queries import ORACLES, QUERIES

# Leading columns of each result, and whether it has a row per document.
RESULTS = {
    "op1_best_fit_packing": (["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"], False),
    "op2_line_dedup": (["doc_id", "text"], True),
    "op3_secret_scan": (["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"], True),
    "op4_token_ids": (["doc_id", "start", "n_tokens", "ids_crc32"], True),
    "op5_substring_dedup": (["doc_id", "n_words", "n_removed", "kept_sha256"], True),
    "op6_toxicity": (["doc_id", "held_out", "score", "predicted"], True),
    "op7_nearest_neighbours": (["query_id", "rank", "vec_id", "score"], False),
    "op8_simhash": (["doc_id", "fingerprint", "component_id"], True),
    "op9_decontamination": (["doc_id", "item_id"], False),
    "op10_pii": (["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"], True),
    "op11_periodic_runs": (["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"], True),
    "op12_quality_rules": (
        ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"], True,
    ),
    "op13_merkle_manifest": (["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"], True),
}


def test_every_query_is_described():
    assert set(QUERIES) == set(RESULTS)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, name):
    columns, per_document = RESULTS[name]
    result = QUERIES[name](spark, sf_dir)
    assert set(columns) <= set(result.columns)
    rows = result.collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert rows
    if per_document:
        assert Counter(r.doc_id for r in rows) == Counter(list(docs))
    if name == "op6_toxicity":
        for r in rows:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7)
    if name == "op13_merkle_manifest":
        for r in rows:
            tampered = zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (docs[r.doc_id].text or "")
            assert r.verified == (not tampered) == (r.folded_root == r.root)
    if name in ORACLES:
        duck = duckdb.connect()
        for table in ("documents", "benchmark"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
        twin = duck.execute(ORACLES[name])
        names = sorted(c[0] for c in twin.description)
        assert names == sorted(result.columns)
        place = {c[0]: k for k, c in enumerate(twin.description)}
        assert Counter(tuple(r[c] for c in names) for r in rows) == Counter(tuple(r[place[c]] for c in names) for r in twin.fetchall())
