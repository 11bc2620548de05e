"""Every query of the subpackage that SQL can express, against its SQL."""

import pytest

from checks.compare import connect, differences
from edgeledger.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert differences(QUERIES[name], ORACLES[name], spark, connect(SF), SF) == ""


def test_operators_are_all_there():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
