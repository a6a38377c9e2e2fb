import pytest
from oracle_check import compare, connect

from tariffscope.plans.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"
SAMPLE = """stage_hospitals primary_billing_code payer_candidates payer_dimension code_list_price fact_rates
pct_of_medicare price_dispersion dq_coverage json_to_long tall_to_long wide_to_long repair_encoding header_metadata
index_lookup admit_new_files""".split()


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_reference_sql(spark, name):
    assert compare(queries()[name](spark, SF), connect(SF), oracle_sql()[name]) == ""


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
