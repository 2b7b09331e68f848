"""Column expressions shared by the pipelines.

All of them are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

# Quality-class thresholds (strictly greater than).
STAR_ABOVE = 8
GOOD_ABOVE = 7
AVERAGE_ABOVE = 6

# Rank of each class for trend analysis, worst to best.
CLASS_RANK = {"bad": 0, "average": 1, "good": 2, "star": 3}

# Comment markers of the raw log and the fact flags they set
# (did not play, did not dress, not with team); matched case-sensitively.
COMMENT_MARKERS = {"dim_did_not_play": "DNP", "dim_did_not_dress": "DND", "dim_not_with_team": "NWT"}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quality_class(avg_rating) -> Column:
    """C4: class of an average rating; NULL averages fall into ``bad``."""
    a = _col(avg_rating)
    return (F.when(a > STAR_ABOVE, F.lit("star"))
             .when(a > GOOD_ABOVE, F.lit("good"))
             .when(a > AVERAGE_ABOVE, F.lit("average"))
             .otherwise(F.lit("bad")))


def class_rank(cls) -> Column:
    """Rank of a class, bad 0 .. star 3; NULL for anything outside the domain."""
    c = _col(cls)
    expr = None
    for name, rank in CLASS_RANK.items():
        expr = (F.when(c == name, F.lit(rank)) if expr is None
                else expr.when(c == name, F.lit(rank)))
    return expr


def lag_or_self(name: str, window: Window) -> Column:
    """``LAG(c, 1, c)``: the default applies to a missing previous row, not
    to a NULL value in it (S7). Python's ``F.lag`` takes no Column default."""
    return F.expr(f"lag(`{name}`, 1, `{name}`)").over(window)


def changed_from_prev(cols, window: Window) -> Column:
    """1 when any of ``cols`` differs from the previous row, else 0.

    Comparisons are null-unaware ``<>`` as in the reference: a NULL on either
    side does not count as a change (S6)."""
    expr = None
    for c in cols:
        cond = F.col(c) != lag_or_self(c, window)
        expr = F.when(cond, F.lit(1)) if expr is None else expr.when(cond, F.lit(1))
    return expr.otherwise(F.lit(0))


def differs(a: Column, b: Column, null_safe: bool = False) -> Column:
    """``a <> b`` (NULL-propagating) or, in null-safe mode, ``NOT (a <=> b)``."""
    return ~a.eqNullSafe(b) if null_safe else a != b


def change_type(last_id: Column, this_id: Column, last_cls: Column, this_cls: Column,
                last_active: Column, this_active: Column, null_safe: bool = False) -> Column:
    """First matching branch wins: new, retired, changed, unchanged."""
    changed = differs(last_cls, this_cls, null_safe) | differs(last_active, this_active, null_safe)
    return (F.when(last_id.isNull(), F.lit("new"))
             .when(this_id.isNull(), F.lit("retired"))
             .when(changed, F.lit("changed"))
             .otherwise(F.lit("unchanged")))


def comment_flag(comment, marker: str) -> Column:
    """Case-sensitive substring test; a NULL comment gives false."""
    return F.coalesce(F.locate(marker, _col(comment)) > 0, F.lit(False))


def minutes(mmss, on_malformed: str = "error") -> Column:
    """``'MM:SS'`` -> minutes as FLOAT.

    Both parts are cast to FLOAT and added in double, as the reference's REAL
    arithmetic does before the value is stored as REAL (S26). A value without a
    second part, or with text, is malformed (S14): ``on_malformed='error'``
    raises ``CAST_INVALID_INPUT`` (ANSI cast), ``'null'`` yields NULL.
    """
    if on_malformed not in ("error", "null"):
        raise ValueError("on_malformed must be 'error' or 'null'")
    c = _col(mmss)
    mm = F.split_part(c, F.lit(":"), F.lit(1))
    ss = F.split_part(c, F.lit(":"), F.lit(2))
    if on_malformed == "error":
        mm_f, ss_f = mm.cast("float"), ss.cast("float")
    else:
        mm_f, ss_f = mm.try_cast("float"), ss.try_cast("float")
    return (mm_f.cast("double") + ss_f.cast("double") / F.lit(60)).cast("float")


def is_home(team_id, home_team_id) -> Column:
    """Home flag as a comparison column (NULL if either side is NULL)."""
    return _col(team_id) == _col(home_team_id)
