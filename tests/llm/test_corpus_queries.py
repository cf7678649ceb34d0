import pytest

from corpus_check import CASES, QUERIES, compare, connect

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(CASES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SMALL), name, SMALL) is None


def test_every_operator_has_one_query():
    assert [n for n in sorted(QUERIES, key=lambda q: int(q[2:].split("_")[0]))] == list(QUERIES)
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 11))


def test_contract_columns(spark):
    expected = {
        "op1": "page_id url text n_chars", "op2": "doc_id n_shingles component_id", "op3": "doc_id piece start length ids_crc32 sequence_id offset",
        "op4": "doc_id n_words n_base first_word last_word base_labels labels score", "op5": "doc_id held_out score predicted",
        "op6": "doc_id n_lines n_dropped kept_sha256", "op7": "doc_id item_id", "op8": "query_id rank vec_id score",
        "op9": "doc_id start n_tokens ids_crc32", "op10": "doc_id size text_crc32 law shard slot grown_shard",
    }
    for name, query in QUERIES.items():
        columns = expected[name.split("_")[0]].split()
        assert query(spark, SMALL).columns[:len(columns)] == columns, name
