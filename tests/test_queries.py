"""Registered queries against their SQL twins on the smallest tables.

All but the order book's and the seven markets' plans, which take minutes, and the history backlogs, which are empty
at this size. These run too when ALL_QUERIES is set; ``python -m showcase.verify`` runs everything at a chosen scale.
"""
import os

import pytest

from showcase import REGISTRY
from showcase.verify import compare, connect

FOLDER = "/root/testdata/sf0.001"
LONG = ("sales_seaport", "sales_complete", "gold_nft", "dq_sales", "backlog_history")
NAMES = [n for n in REGISTRY if os.environ.get("ALL_QUERIES") or not n.startswith(LONG)]


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    problem, _ = compare(spark, con, FOLDER, *REGISTRY[name])
    assert problem is None, problem
