"""The operators' queries against their SQL, where SQL can express them."""
import pytest

from runoff.llm import queries
from tests.llm.helpers import SF
from tests.parity import canon, duck


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    want = duck(SF).sql(queries.ORACLES[name]).df()
    assert canon(got) == canon(want)


def test_every_other_query_is_tested_against_brute_force():
    assert set(queries.QUERIES) - set(queries.ORACLES) == {
        "op1_source_mixing", "op2_html_text", "op3_collision_search", "op5_tool_calls", "op6_edit_counts",
        "op7_quality_classifier", "op8_best_fit_packing", "op12_periodic_runs",
        "op13_histogram_packing"}
