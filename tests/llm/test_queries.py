"""The registered corpus queries on a small scale: shapes, and SQL where there is some."""

import duckdb
import pytest

from lexweave.llm.queries import ORACLES, QUERIES
from tests.test_oracles import TABLES, sorted_rows

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_byte_bpe": [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")],
    "op2_quality_rank": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
    "op3_toxic_words": [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")],
    "op4_kneser_ney": [("doc_id", "bigint"), ("held_out", "boolean"), ("n_tokens", "bigint"), ("n_known", "bigint"), ("train_tokens", "bigint"), ("base_score", "double"), ("score", "double")],
    "op5_token_files": [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")],
    "op6_secret_links": [("doc_id", "bigint"), ("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("base_sha256", "string"), ("spans", "string")],
    "op7_tiff_pages": [("doc_id", "bigint"), ("n_bytes", "bigint"), ("payload_bytes", "bigint"), ("payload_sha256", "string"), ("tail_crc32", "bigint"), ("media_bytes", "bigint"), ("media_sha256", "string"), ("feature", "string")],
    "op8_warc_zip": [("page_id", "bigint"), ("payload_bytes", "bigint"), ("payload_digest", "string"), ("record_type", "string"), ("refers_to", "bigint")],
    "op10_simhash": [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")],
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_shape_and_sql(spark, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name in COLUMNS:
        assert df.dtypes == COLUMNS[name]
        source = "pages" if name == "op8_warc_zip" else "documents"
        ids = sorted(r[0] for r in spark.read.parquet(f"{SF}/{source}.parquet").collect())
        assert sorted(r[0] for r in rows) == ids
    if name in ORACLES:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        con = con.execute(ORACLES[name])
        assert sorted_rows(df.columns, rows) == sorted_rows([d[0] for d in con.description], con.fetchall())


def test_model_beats_its_base_on_held_out_text(spark):
    rows = QUERIES["op4_kneser_ney"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert len(rows) > 50 and sum(r.score for r in rows) > sum(r.base_score for r in rows)
