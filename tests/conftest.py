from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panelwise.session import tune  # noqa: E402
from tools.local import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return tune(session("4"))


@pytest.fixture
def many_partitions(spark):
    """Keep tiny shuffles apart, so that partition borders are crossed."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    yield spark
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
