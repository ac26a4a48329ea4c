"""Plans that name a step once: what a query costs for a row doesn't multiply with the places that use a value."""

import pytest

from sparkloom.operators import review as R
from sparkloom.plans import queries as Q
from sparkloom.plans import records  # noqa: F401  registers its queries


def plan(spark, sf, name):
    return Q.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()


#: Characters of the optimised plan.
LIMITS = {
    "q_dicom_rollup": 20_000,
    "q_probe_listing": 40_000,
    "q_envi_header": 4_000,
    "q_companion": 6_000,
    "q_header_of": 6_000,
    "q_probe_names": 60_000,
    "q_file_ext_kind": 10_000,
}


@pytest.mark.parametrize("name", sorted(LIMITS))
def test_plan_is_small(name, spark, sf):
    assert len(plan(spark, sf, name)) <= LIMITS[name]


def test_maker_words_are_searched_once(spark, sf):
    """Each maker's pattern is searched once in the text and once in the names."""
    assert plan(spark, sf, "q_maker_hints").count("regexp_extract(") == 2 * len(R.MAKERS)
    for _, pattern, _ in R.MAKERS:
        assert all(R.beginnings(pattern))
