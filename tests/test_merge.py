"""The merge operator against a row-by-row model."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from millrace.operators.merge import merge_rows, when_matched_delete, when_matched_update, when_not_matched_insert

SCHEMA = "k int, v int"
CLAUSES = [
    when_matched_update("s.v > t.v"),
    when_matched_delete("s.v = 0"),
    when_matched_update("s.v < 0", {"v": "t.v + s.v"}),
    when_not_matched_insert("s.v > 3"),
    when_not_matched_insert("s.v = 1", {"k": "s.k"}),
]
keys = st.one_of(st.none(), st.integers(0, 5))
values = st.one_of(st.none(), st.integers(-3, 6))


def model(target, source, null_safe):
    def same(a, b):
        return a == b if null_safe else a is not None and a == b

    out = []
    for k, v in target:
        hit = [s for s in source if same(s[0], k)]
        if hit:
            sv = hit[0][1]
            if sv is not None and v is not None and sv > v:
                out.append((k, sv))
                continue
            if sv == 0:
                continue
            if sv is not None and sv < 0:
                out.append((k, None if v is None else v + sv))
                continue
        out.append((k, v))
    for k, sv in source:
        if not any(same(k, t[0]) for t in target):
            if sv is not None and sv > 3:
                out.append((k, sv))
            elif sv == 1:
                out.append((k, None))
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(keys, values), max_size=12),
    st.lists(st.tuples(keys, values), max_size=8, unique_by=lambda r: r[0]),
    st.booleans(),
)
def test_merge_equals_model(spark, target, source, null_safe):
    got = merge_rows(spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA), ["k"], CLAUSES, null_safe)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(model(target, source, null_safe), key=str)
