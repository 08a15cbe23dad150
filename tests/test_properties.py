"""Property-based checks (hypothesis) of the distributed building blocks."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lapsewise.operators.activation import previous_in_key

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", "hot"]), st.integers(0, 5), st.sampled_from(["x", "y", "z"])),
    min_size=1, max_size=60,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, block=st.integers(1, 6))
def test_previous_in_key_equals_sequential_model(spark, rows, block):
    data = [(k, s, v, i) for i, (k, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, s long, v string, i long").selectExpr("*", "format_string('%s%04d', v, i) AS tie")
    got = {r.i: r.prev for r in previous_in_key(df, "k", "s", "tie", "v", "prev", block=block).collect()}
    last = {}
    for k, s, v, i in sorted(data, key=lambda r: (r[0], r[1], r[2], r[3])):
        assert got[i] == last.get(k)
        last[k] = v
