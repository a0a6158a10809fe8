"""The registered queries: columns and types of their contracts, one row for each they promise, SQL where there is some."""

import sys

import pytest

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0] + "/tests")

from oracle_compare import duck_connect, normalise  # noqa: E402

from ohlcflow.llm import queries as L  # noqa: E402

SF = "/root/testdata/sf0.001"
CONTRACTS = {
    "op1_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op2_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op3_secret_scan": "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string",
    "op4_packing": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op5_ngram_join": "doc_id bigint, n_shingles bigint, component_id bigint",
    "op6_personal_data": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string",
    "op7_chat_format": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op8_line_quality": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op9_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op10_fingerprints": "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    "op11_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op12_turn_repair": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
    "op13_spelling": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
}


def test_every_operator_has_one_query():
    assert list(CONTRACTS) == sorted(L.QUERIES, key=lambda k: int(k[2:].split("_")[0]))


@pytest.mark.parametrize("key", CONTRACTS)
def test_contract(spark, key):
    got = L.QUERIES[key](spark, SF)
    types = dict(got.dtypes)
    assert {c: types.get(c) for c, _ in (x.split() for x in CONTRACTS[key].split(", "))} == dict(x.split() for x in CONTRACTS[key].split(", "))
    rows = got.collect()
    if key in L.ORACLE_SQL:
        cursor = duck_connect(SF).execute(L.ORACLE_SQL[key])
        assert normalise([d[0] for d in cursor.description], cursor.fetchall()) == normalise(got.columns, [tuple(r) for r in rows])
    if key.startswith(("op4", "op13")):
        return
    table, unit = ("conversations", "conv_id") if "conv_id" in types else ("documents", "doc_id")
    units = {r[0] for r in spark.read.parquet(f"{SF}/{table}.parquet").select(unit).distinct().collect()}
    assert sorted(r[unit] for r in rows) == sorted(units | ({-7} if key.startswith("op7") else set()))
    if key.startswith("op1_"):
        import zlib

        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
