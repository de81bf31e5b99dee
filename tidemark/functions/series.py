"""Short arrays: dense hourly series, medians, correlation at a lag, significance.

An article's series has a fixed length (48 hours, 28 days), so one row holds it and every
step is a built-in higher-order function on that row. The functions compose SQL text, which
Spark parses once; as nested Python lambdas the same expressions cost the driver thousands
of calls per plan. Arguments are SQL expressions and, where used more than once, should be
column or lambda names.
"""

from __future__ import annotations

import math

# Terms summed past the closed form; (1 - 0.5^2)^140 is below the last bit of a double.
TAIL_TERMS = 140
# A side whose spread is below this share of its level is constant up to rounding.
FLAT_SHARE = 1e-9


def number(value: float) -> str:
    """A double literal; a plain 0.3 would be a decimal."""
    return f"{float(value)!r}D"


def bind(name: str, value: str, body: str) -> str:
    """Evaluate ``value`` once as ``name`` and use it several times inside ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def half_even(value: str, digits: int) -> str:
    """Round half to even on the scaled value, the rule of the array libraries."""
    scale = number(10**digits)
    return f"rint(({value}) * {scale}) / {scale}"


def total(values: str) -> str:
    return f"aggregate({values}, 0D, (acc, v) -> acc + v)"


def dense(by_slot: str, length: int) -> str:
    """Map slot -> value to an array of ``length`` doubles, absent slots being 0."""
    return f"transform(sequence(0, {length - 1}), slot -> coalesce(try_element_at({by_slot}, slot), 0D))"


def zero_padded(values: str, length: str) -> str:
    """The observed counts plus a zero for every further slot up to ``length``."""
    known = f"coalesce({values}, cast(array() AS array<bigint>))"
    return f"concat({known}, array_repeat(0L, {length} - size({known})))"


def median(values: str) -> str:
    """Exact median, the mean of the middle two for an even size; null when empty."""
    low = "try_element_at(sorted, cast(ceil(size(sorted) / 2) AS int))"
    high = "try_element_at(sorted, cast(size(sorted) div 2 + 1 AS int))"
    return bind("sorted", f"array_sort({values})", f"CASE WHEN size(sorted) > 0 THEN ({low} + {high}) / 2D END")


def first_peak(values: str) -> str:
    """Zero-based position of the first maximum."""
    return f"cast(array_position({values}, array_max({values})) - 1 AS int)"


def correlations(left: str, right: str, max_lead: int, max_lag: int, length: int, min_overlap: int) -> str:
    """Pearson correlation of left(t) with right(t + lag) for each lag of [-max_lead, max_lag].

    An array of (lag, n, corr). ``corr`` is null when fewer than ``min_overlap`` hours
    overlap or a side is constant there; constant is judged against its own level,
    since 48 x 0.1 has a standard deviation of 1e-17 rather than 0.
    """
    overlaps = f"""transform(sequence({-max_lead}, {max_lag}), k -> named_struct(
        'lag', k, 'n', {length} - abs(k),
        'a', slice({left}, greatest(1, 1 - k), {length} - abs(k)),
        'b', slice({right}, greatest(1, 1 + k), {length} - abs(k))))"""
    centred = f"""transform({overlaps}, o -> named_struct(
        'lag', o.lag, 'n', o.n, 'a', o.a, 'b', o.b,
        'ma', {total("o.a")} / o.n, 'mb', {total("o.b")} / o.n))"""
    spreads = f"""transform({centred}, o -> named_struct(
        'lag', o.lag, 'n', o.n, 'ma', o.ma, 'mb', o.mb,
        'xy', {total("zip_with(o.a, o.b, (x, y) -> (x - o.ma) * (y - o.mb))")},
        'sx', sqrt(aggregate(o.a, 0D, (acc, x) -> acc + (x - o.ma) * (x - o.ma))),
        'sy', sqrt(aggregate(o.b, 0D, (acc, y) -> acc + (y - o.mb) * (y - o.mb)))))"""

    def moves(spread: str, mean: str) -> str:
        return f"{spread} > sqrt(o.n) * {number(FLAT_SHARE)} * greatest(abs({mean}), 1D)"

    return f"""transform({spreads}, o -> named_struct(
        'lag', o.lag, 'n', o.n,
        'corr', CASE WHEN o.n >= {min_overlap} AND {moves("o.sx", "o.ma")} AND {moves("o.sy", "o.mb")}
                     THEN greatest(-1D, least(1D, o.xy / (o.sx * o.sy))) END))"""


def strongest(lags: str) -> str:
    """The (lag, n, corr) with the highest correlation, the smallest lag on a tie.

    Compared to ten decimals: below that the winner would be summation noise. Null
    when no lag has a correlation.
    """
    ranked = f"""transform(filter({lags}, o -> o.corr IS NOT NULL), o -> named_struct(
        'rank', round(o.corr, 10), 'back', -o.lag, 'n', o.n, 'corr', o.corr))"""
    return bind(
        "top",
        f"array_max({ranked})",
        "CASE WHEN top IS NOT NULL THEN named_struct('lag', -top.back, 'n', top.n, 'corr', top.corr) END",
    )


def student_tail(r: str, n: str) -> str:
    """P(correlation >= r by chance) for n points: one-sided Student tail, n - 2 degrees.

    With sin(theta) = r the classical finite sums for whole degrees of freedom
    (Abramowitz & Stegun 26.7.3 and 26.7.4) become power sums in 1 - r^2. For a strong
    correlation the rest of the same series is summed instead of subtracting from 1,
    so small tails keep their digits.
    """

    def power_sum(first: str, last: str) -> str:
        """Terms ``first`` to ``last`` of the series; its term 0 is 1."""
        grown = "acc.term * t.cos2 * (2 * k - 1 + t.odd) / (2 * k + t.odd)"
        step = f"named_struct('term', term, 'sum', acc.sum + IF(k >= {first}, term, 0D))"
        return f"""aggregate(sequence(1, {last}),
            named_struct('term', 1D, 'sum', IF({first} <= 0, 1D, 0D)),
            (acc, k) -> {bind("term", grown, step)}).sum"""

    head = f"CASE WHEN t.cut >= 2 THEN {power_sum('0', 't.cut - 1')} WHEN t.cut = 1 THEN 1D ELSE 0D END"
    rest = power_sum("t.cut", f"t.cut + {TAIL_TERMS}")
    strong = bind("s", rest, f"IF(t.odd = 0, {r} * s / 2D, {r} * sqrt(t.cos2) * s / {number(math.pi)})")
    weak = bind(
        "s",
        head,
        f"IF(t.odd = 0, (1D - {r} * s) / 2D, "
        f"(1D - (asin({r}) + {r} * sqrt(t.cos2) * s) * {number(2 / math.pi)}) / 2D)",
    )
    terms = f"named_struct('cos2', 1D - {r} * {r}, 'odd', ({n} - 2) % 2, 'cut', cast(({n} - 2) div 2 AS int))"
    return f"""CASE WHEN {r} IS NULL OR {n} <= 2 THEN cast(NULL AS double) WHEN {r} >= 1D THEN 0D
        ELSE {bind("t", terms, f"IF({r} >= 0.5D, {strong}, {weak})")} END"""


def corrected_p_value(r: str, n: str, tests: int) -> str:
    """The tail times the number of lags tried (Bonferroni), at most 1; null stays null."""
    return bind("p", f"({student_tail(r, n)}) * {tests}", "IF(p > 1D, 1D, p)")
