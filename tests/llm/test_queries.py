"""Every registered query of the corpus operators on the smallest test tables: the columns asked for, and all rows."""

import os

import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = {
    "op1_suffix": ("documents", "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"),
    "op2_toxicity": ("documents", "doc_id bigint, held_out boolean, score double, predicted int"),
    "op3_pq": ("embeddings", "vec_id bigint, n_links bigint, component_id bigint, kept boolean"),
    "op4_packing": ("", "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"),
    "op5_ngram_rules": ("documents", "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
                                     "n_repeat_words bigint, base_failed boolean, kept boolean"),
    "op6_simhash": ("documents", "doc_id bigint, fingerprint string, component_id bigint"),
    "op7_warc": ("pages", "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"),
    "op8_gam": ("documents", "doc_id bigint, held_out boolean, score double, predicted int"),
    "op9_mixing": ("documents", "doc_id bigint, size bigint, source_size bigint, target double, taken bigint"),
    "op10_surrogates": ("documents", "doc_id bigint, text string"),
    "op11_fim": ("documents", "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, "
                              "restored_sha256 string"),
    "op12_exact_topk": ("", "query_id bigint, rank int, vec_id bigint, score bigint"),
    "op13_collocations": ("", "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"),
}


def test_all_are_registered():
    found = [name for name in entry.queries() if name.startswith("op") or name == "pipeline"]
    assert sorted(found) == sorted([*COLUMNS, "pipeline"])


@pytest.mark.parametrize("name", COLUMNS)
def test_query(spark, name):
    table, columns = COLUMNS[name]
    found = entry.queries()[name](spark, SF_DIR)
    kinds = dict(found.dtypes)
    for column in columns.split(", "):
        assert kinds[column.split(" ")[0]] == column.split(" ")[1]
    count = found.count()
    assert count == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count() if table else count > 0
