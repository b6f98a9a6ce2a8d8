"""Laws that hold for any input."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stationlake import operators as op

SCHEMA = (
    "id_localizacao BIGINT, id_sensor BIGINT, localizacao STRING, parametro STRING, "
    "parametro_descricao STRING, unidade STRING, anomesdia INT, valor DOUBLE"
)
slow = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

reading = st.tuples(
    st.one_of(st.none(), st.integers(1, 2)),
    st.integers(1, 2),
    st.sampled_from(["p", "P"]),
    st.one_of(st.none(), st.sampled_from([20240101, 20240102])),
    st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 1.5, 2.0])),
)


def frame(spark, readings):
    return spark.createDataFrame(
        # the name follows from the id
        [(i, s, f"L{i}", p, p.lower(), "u", d, v) for i, s, p, d, v in readings],
        SCHEMA,
    )


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@slow
@given(st.lists(reading, min_size=1, max_size=25))
def test_extremes_equal_the_literal_form(spark, readings):
    df = frame(spark, readings)
    assert rows(op.daily_extremes(df)) == rows(op.daily_extremes_joined(df))


@slow
@given(st.lists(reading, min_size=1, max_size=25))
def test_days_are_independent(spark, readings):
    df = frame(spark, [r for r in readings if r[3]] or [(1, 1, "p", 20240101, 1.0)])
    parts = [op.daily_extremes(df.where(f"anomesdia = {d}")) for d in (20240101, 20240102)]
    assert rows(op.daily_extremes(df)) == rows(parts[0].unionByName(parts[1]))


pair = st.tuples(st.one_of(st.none(), st.integers(1, 3)), st.integers(1, 3), st.integers(0, 9))


@slow
@given(st.lists(pair, max_size=12), st.lists(pair, max_size=12))
def test_merge_matches_its_definition(spark, target, source):
    schema = "a INT, b INT, v INT"
    held = {(a, b) for a, b, _ in target if a is not None}
    got = op.merge_insert_only(
        spark.createDataFrame(target, schema), spark.createDataFrame(source, schema), ["a", "b"]
    )
    assert rows(got) == Counter(r for r in source if (r[0], r[1]) not in held)
