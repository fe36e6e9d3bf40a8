"""The registered queries against their SQL, and the schema of the others."""

import duckdb
import pytest

from catalog_engine.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    rel = con.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    want = sorted((tuple(dict(zip(rel.columns, r))[c] for c in cols) for r in rel.fetchall()), key=repr)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr) == want


CONTRACT = {
    "op1_": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op3_": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string",
    "op4_": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op5_": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op9_": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
            "n_repeat_words bigint, base_failed boolean, kept boolean",
    "op10_": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double",
    "op11_": "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    "op12_": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
             "runs_sha256 string, collapsed_sha256 string",
    "op13_": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
}


@pytest.mark.parametrize("prefix", sorted(CONTRACT))
def test_contract_columns(spark, prefix):
    name = next(q for q in QUERIES if q.startswith(prefix))
    found = {f"{c} {t}" for c, t in QUERIES[name](spark, SF).dtypes}
    assert set(CONTRACT[prefix].split(", ")) <= found
