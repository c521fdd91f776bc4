"""Queries with SQL against DuckDB; the rest run on the smallest tables."""

import pytest

pytest.importorskip("lodestack.llm")
from lodestack.llm.oracles import ORACLES
from lodestack.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_pack": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op2_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op3_near_duplicates": ["doc_id", "n_shingles", "component_id", "kept"],
    "op4_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op5_embedding_duplicates": ["vec_id", "n_links", "component_id", "kept"],
    "op6_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op7_quality": ["doc_id", "held_out", "score", "predicted"],
    "op8_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op9_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op10_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
}


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(name, same_rows):
    def run(spark, sf):
        df = QUERIES[name](spark, sf)
        assert df.columns == COLUMNS[name]
        return df

    same_rows(run, ORACLES[name])


@pytest.mark.parametrize("name", [n for n in COLUMNS if n not in ORACLES])
def test_columns_and_rows(name, spark):
    df = QUERIES[name](spark, SF)
    assert df.columns[: len(COLUMNS[name])] == COLUMNS[name]
    ids = [r[0] for r in df.select(df.columns[0]).distinct().collect()]
    assert len(ids) == spark.read.parquet(f"{SF}/documents.parquet").count()
