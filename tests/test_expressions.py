"""Property tests of the scalar expressions against plain Python."""

import struct

from hypothesis import given, settings
from hypothesis import strategies as st

from histdim.functions.expressions import class_rank, comment_flag, minutes, quality_class


def _f32(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def _py_class(avg):
    if avg is None:
        return "bad"
    return "star" if avg > 8 else "good" if avg > 7 else "average" if avg > 6 else "bad"


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(0, 10, allow_nan=False)), min_size=1, max_size=30))
def test_quality_class_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "a double")
    got = [r[0] for r in df.select(quality_class("a")).collect()]
    assert got == [_py_class(v) for v in values]
    ranks = [r[0] for r in df.select(class_rank(quality_class("a"))).collect()]
    assert ranks == [{"bad": 0, "average": 1, "good": 2, "star": 3}[_py_class(v)] for v in values]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 99), st.integers(0, 59)), min_size=1, max_size=30))
def test_minutes_matches_python(spark, pairs):
    df = spark.createDataFrame([(f"{m}:{s:02d}",) for m, s in pairs], "m string")
    got = [r[0] for r in df.select(minutes("m")).collect()]
    assert got == [_f32(float(_f32(m)) + float(_f32(s)) / 60) for m, s in pairs]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="DNPTWdnp -x", max_size=12)), min_size=1, max_size=30))
def test_comment_flag_matches_python(spark, comments):
    df = spark.createDataFrame([(c,) for c in comments], "c string")
    got = [r[0] for r in df.select(comment_flag("c", "DNP")).collect()]
    assert got == [c is not None and "DNP" in c for c in comments]
