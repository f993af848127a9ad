from pathlib import Path

import pytest
from pyspark.sql import functions as F

from skylag.plans.catalog import QUERIES
from skylag.session import shared_dir
from skylag.sources.tables import materialize, owned_cuts


def folders(spark):
    return set(Path(shared_dir(spark)).iterdir())


def test_no_cut_is_left_after_the_result_is_written(spark, sf_dir, tmp_path):
    before = folders(spark)
    want = sorted(map(str, QUERIES["flight_weather"](spark, sf_dir).collect()))
    outside = folders(spark)
    assert outside > before
    with owned_cuts(spark):
        QUERIES["flight_weather"](spark, sf_dir).write.parquet(f"{tmp_path}/out")
        assert folders(spark) > outside
    # Cuts written outside of the scope are not its own.
    assert folders(spark) == outside
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/out").collect())) == want


def test_cuts_go_after_a_failure(spark):
    before = folders(spark)
    failing = spark.range(10).select(F.raise_error(F.lit("stop")).alias("x"))
    with pytest.raises(Exception, match="stop"):
        with owned_cuts(spark):
            materialize(spark.range(5), "whole")
            materialize(failing, "broken")
    assert folders(spark) == before


def test_each_scope_owns_its_own_cuts(spark):
    before = folders(spark)
    with owned_cuts(spark):
        outer = materialize(spark.range(5), "outer")
        with owned_cuts(spark):
            assert materialize(spark.range(3), "inner").count() == 3
        assert outer.count() == 5 and len(folders(spark) - before) == 1
    with owned_cuts(spark):
        pass
    assert folders(spark) == before
