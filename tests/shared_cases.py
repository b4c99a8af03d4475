"""Paths and helpers of the tests (a module of its own: every test folder has a conftest)."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
FIXTURES = os.path.join(ROOT, "tests", "fixtures")
SF_SMALL = "/root/testdata/sf0.001"


def one_col(spark, values, name="text", dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {dtype}")
