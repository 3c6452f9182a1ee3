"""Column-level helpers (all built-in Spark expressions, codegen friendly)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from churnwise.functions import labels as L


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ieee(x) -> Column:
    """NaN as NULL, for use inside comparisons only: Spark orders NaN above
    every number and equal to itself, while the source semantics treat every
    comparison with NaN as false. A NULL operand makes CASE/IF/WHERE skip the
    branch, which is the same outcome."""
    x = col(x)
    return F.when(~F.isnan(x), x)


def flag(cond: Column) -> Column:
    """IF(cond, 1, 0): a NULL condition gives 0."""
    return F.when(cond, 1).otherwise(0)


def tenure_band(start, asof, early: int = 180, mid: int = 360) -> Column:
    """Early/Mid/Late tenure by days from ``start`` to ``asof``; NULL start -> NULL."""
    d = F.datediff(col(asof), col(start))
    return F.when(d <= early, L.EARLY).when(d <= mid, L.MID).when(d > mid, L.LATE)


def mix_code(bb, tv, vo) -> Column:
    """'nP' from the three product counts; NULL if any count is NULL."""
    return F.concat((col(bb) + col(tv) + col(vo)).cast("string"), F.lit("P"))


def mix_name(bb, tv, vo) -> Column:
    """Product-mix name for 0/1 product flags; NULL for any other combination."""
    expr = None
    for (b, t, v), name in L.MIX_NAMES.items():
        cond = (col(bb) == b) & (col(tv) == t) & (col(vo) == v)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr


def mix_number(bb, tv, vo) -> Column:
    """The product mix of 0/1 flags as a number: 1 for broadband, 2 for tv and
    4 for voice, added up; NULL where there is no mix name."""
    known = mix_name(bb, tv, vo).isNotNull()
    return F.when(known, col(bb) + 2 * col(tv) + 4 * col(vo)).cast("tinyint")


def mix_number_units(mix) -> Column:
    """Number of products in a mix number; 0 when NULL."""
    return F.coalesce(F.bit_count(col(mix)), F.lit(0))


def tech_type(drop_type) -> Column:
    t = F.trim(col(drop_type))
    expr = None
    for k, v in L.TECH_BY_DROP.items():
        expr = F.when(t == k, v) if expr is None else expr.when(t == k, v)
    return expr


def fixed_fmc_hint(welcome_offer, joint_customer) -> Column:
    return (F.when(col(welcome_offer) == "X", L.FIXED_FMC_HINT[0])
            .when(col(joint_customer) == "X", L.FIXED_FMC_HINT[1]).otherwise(L.FIXED_FMC_HINT[2]))


def fixed_movement(b_units, e_units, e_start, month) -> Column:
    """Main movement of a fixed account between opening and closing units."""
    b, e = col(b_units), col(e_units)
    start_month = F.trunc(col(e_start), "month")
    diff = e - b
    return (F.when(diff == 0, L.SAME).when(diff > 0, L.UPSELL).when(diff < 0, L.DOWNSELL)
            .when(b.isNull() & (e > 0) & (start_month == col(month)), L.NEW_CUSTOMER)
            .when(b.isNull() & (e > 0) & (start_month != col(month)), L.COME_BACK)
            .when((b > 0) & e.isNull(), L.NULL_LAST_DAY)
            .when(b.isNull() & e.isNull(), L.ALWAYS_NULL)
            .when(b.isNull() & (e > 0) & start_month.isNull(), L.GROSS_ADD_GAP))


def fixed_spin(movement, b_mrc, e_mrc) -> Column:
    d = ieee(col(e_mrc) - col(b_mrc))
    same = col(movement) == L.SAME
    return (F.when(same & (d > 0), L.FIXED_SPIN[0]).when(same & (d < 0), L.FIXED_SPIN[1])
            .otherwise(L.FIXED_SPIN[2]))


def like_regex(patterns: Sequence[str]) -> str:
    """One regular expression equivalent to ``x LIKE p1 OR x LIKE p2 ...`` for
    patterns wrapped in ``%`` (``%`` inside -> ``.*``, found anywhere)."""
    parts = []
    for p in patterns:
        if not (p.startswith("%") and p.endswith("%")) or "_" in p:
            raise ValueError(f"pattern {p!r} is not a %...% contains-pattern")
        parts.append("(?s:" + ".*".join(re.escape(seg) for seg in p.strip("%").split("%")) + ")")
    return "|".join(parts)


def like_any(text, patterns: Sequence[str]) -> Column:
    """``text LIKE any(patterns)`` with SQL NULL semantics, evaluated as one
    regular-expression pass instead of one LIKE per pattern."""
    return col(text).rlike(like_regex(patterns))


def lower_like_any(text, patterns: Sequence[str]) -> Column:
    return like_any(F.lower(col(text)), patterns)
