"""Property tests: the slot check and brand picking against plain Python."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions.slots import first_distinct, valid_code_count

codes = st.one_of(st.none(), st.text(alphabet="AB01", min_size=5, max_size=7))
packs = st.lists(st.lists(codes, min_size=8, max_size=8), min_size=1, max_size=25)


def _packed(slots):
    return None if any(c is None for c in slots) else "|".join(slots)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(packs)
def test_valid_code_count_matches_python(spark, data):
    packed = [(_packed(s),) for s in data]
    df = spark.createDataFrame(packed, "p string")
    got = [r[0] for r in df.select(valid_code_count(F.col("p"))).collect()]
    want = [0 if p is None else len({c for c in p.split("|") if len(c) == 6}) for (p,) in packed]
    assert got == want


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(packs)
def test_first_distinct_matches_python(spark, data):
    packed = [(_packed(s),) for s in data]
    df = spark.createDataFrame(packed, "p string")
    got = [tuple(r) for r in df.select(*first_distinct(F.col("p"), 3)).collect()]
    want = []
    for (p,) in packed:
        seen = [] if p is None else list(dict.fromkeys(p.split("|")))
        want.append(tuple((seen[i] if i < len(seen) else "") for i in range(3)))
    assert got == want
