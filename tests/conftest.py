import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import get_spark

    s = get_spark("local[4]", app="strata-tests", shuffle_partitions=4, driver_memory="6g")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def passengers(spark):
    """The single-row fixtures of the reference, in cohort column names."""
    rows = [
        (1, 1, 1, "female", "Doe, Mrs. Jane", 29.0, 1, 0, 80.0, "C85", "C"),
        (2, 0, 3, "male", "Smith, Mr. John", None, 0, 0, 7.25, None, None),
        (3, 0, 2, "male", "Zorg, Cpt. Xylo", 40.0, 0, 0, 13.0, "B10", "S"),
        (4, 1, 3, "male", "Doe, Master. Tim", None, 1, 1, 20.0, None, "S"),
        (5, 0, 1, "male", "Roe, Mr. Al", 50.0, 0, 0, 30.0, "Z99", "S"),
        (6, 0, 3, "male", "Poe, Mr. Ed", 30.0, -1, 0, 10.0, None, "Q"),
    ]
    return spark.createDataFrame(
        rows, "id long, label int, pclass int, sex string, name string, age double, sibsp int, parch int, "
              "fare double, cabin string, embarked string")
