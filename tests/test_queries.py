"""Every registered query against its oracle on the smallest data, and the shape of key plans."""

import os

import pytest

from checks.oracles import ORACLES
from checks.queries import QUERIES
from checks.verify import compare, connect

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    assert not compare(spark, duck, SF, name).startswith("FAIL")


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ["monthly_metrics", "normalized_metrics", "tfidf", "name_mentions", "mention_graph",
                                  "contributor_graph", "first_seen", "cooccurrence", "normalize_events", "trailing_scores",
                                  "shared_contributor_pairs", "word_pairs"])
def test_plans_stay_in_the_jvm_without_cross_products(spark, capsys, name):
    QUERIES[name](spark, SF).explain("formatted")
    plan = capsys.readouterr().out
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan
