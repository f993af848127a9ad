"""Every query against its SQL twin."""

import pytest
from compare import connect, differences

from oracle.sql import ORACLE
from skylag.plans.catalog import QUERIES

WITHOUT_TWIN = {"lr_base", "lr_enet_cv", "dt_cv", "rf_cv", "gbt_cv", "leaderboard", "lr_enet_grid", "dt_grid"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_all_queries_but_seeded_ones_have_a_twin():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_TWIN
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, duck, sf_dir, name):
    mine = QUERIES[name](spark, sf_dir).toPandas()
    assert differences(mine, duck.execute(ORACLE[name]).df()) == []
    assert len(mine) > 0


def test_union_of_boxes_equals_single_filter(spark, sf_dir):
    one, other = (QUERIES[name](spark, sf_dir) for name in ("region_filter", "union_regions"))
    assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()
