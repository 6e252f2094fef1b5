"""Property test of the spec grammar: texts are rendered from known values and must parse back to them."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybook.functions.specs import parse_spec

LETTERS = {"day": "dD", "month": "mM", "quarter": "qQ", "year": "yY"}

names = st.text(alphabet="abcxyz_019", min_size=1, max_size=6)
windows = st.tuples(names, st.integers(1, 99_999), st.sampled_from(sorted(LETTERS)), st.integers(0, 1))
plain_days = st.tuples(names, st.integers(1, 99_999), st.sampled_from(["{}", " {}", "{} ", "+{}", "0{}"]))
no_windows = st.tuples(names, st.sampled_from(["", ":", ":*", ":0", ":0d", ":00m"]))


def parsed(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string").select(parse_spec("s").alias("p"))
    return [(r["p"]["name"], r["p"]["n"], r["p"]["unit"]) for r in df.collect()]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(windows, min_size=1, max_size=20), st.lists(plain_days, min_size=1, max_size=20), st.lists(no_windows, min_size=1, max_size=20))
def test_rendered_specs_parse_back(spark, with_unit, with_days, without):
    texts = [f"{name}:{n}{LETTERS[unit][upper]}" for name, n, unit, upper in with_unit]
    texts += [f"{name}:" + form.format(n) for name, n, form in with_days]
    texts += [name + rest for name, rest in without]
    expected = [(name, n, unit) for name, n, unit, _ in with_unit]
    expected += [(name, n, "day") for name, n, _ in with_days]
    expected += [(name, None, None) for name, _ in without]
    assert parsed(spark, texts) == expected


@pytest.mark.parametrize("text", ["x:d", "x:-3d", "x:3w", "x:3 d", "x:d3", "x:3dd", "x:b:3d", "x:1.5d", "x:**", "x:99999999999d"])
def test_malformed_windows_are_no_windows(spark, text):
    assert parsed(spark, [text]) == [("x", None, None)]
