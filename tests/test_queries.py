"""Every registered query against its SQL check."""

import pytest
from compare import differences, duck
from conftest import SF

from ledgerloom.plans import ORACLES, QUERIES, load_all

load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_same_as_sql(spark, con, key):
    assert differences(QUERIES[key](spark, SF), con, ORACLES[key]) == ""


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_has_rows(spark, key):
    assert QUERIES[key](spark, SF).limit(1).count() == 1


ORDER_BOUND = ["bi_category_transitions", "bi_rfm_scores", "bi_price_bands", "cln_dedup_keep_first", "cln_impute_mode",
               "wh_upsert_customers", "bi_product_associations"]


@pytest.mark.parametrize("key", ORDER_BOUND)
@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_same_for_any_partitioning(spark, con, key, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert differences(QUERIES[key](spark, SF), con, ORACLES[key]) == ""
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
