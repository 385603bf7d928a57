"""Null and arithmetic semantics of the accounting model, decided once.

Every helper returns a Spark ``Column`` built from built-in functions, so
it stays inside whole-stage codegen and works in ``groupBy().agg``,

* ``na_sum`` / ``na_mean``: an aggregate is null when any input is null,
  and a sum over no rows is ``0.0`` (N1).
* ``sum_or_zero``: nulls skipped, empty input gives ``0.0`` (N2).
* ``exact_sum``: the true sum of doubles, rounded once, in whatever order and
  partitions they are added; ``na_sum`` and ``sum_or_zero`` take ``exact``.
* ``safe_div``: division by zero gives null instead of an ANSI error (N11).
* ``str_remove_first`` / ``str_extract``: first-match removal and
  null-on-no-match extraction (N9, N10).
* ``label_text``: null prints as the text ``NA`` when a label is built (N8).
* ``not_in``: ``NOT IN`` that is false, not null, for a null value (N6).
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Union

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]

# Fixed value: the token that marks a missing value in CSV input and output.
NA_TOKEN = "NA"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _over(c: Column, w: WindowSpec | None) -> Column:
    return c.over(w) if w is not None else c


def any_null(c: ColumnOrName, over: WindowSpec | None = None) -> Column:
    """True when at least one input row is null; false for no rows."""
    return F.coalesce(_over(F.bool_or(_col(c).isNull()), over), F.lit(False))


#: Bits of a limb, and the power of two of the lowest; limbs cover 2^-144 to 2^96.
LIMB_BITS, LOWEST, LIMBS = 24, -144, 10
_BASE = 1 << LIMB_BITS


def sum_limbs(c: ColumnOrName, over: WindowSpec | None = None) -> list[Column]:
    """The sum of a double column as integers: limb ``i`` counts units of
    ``2 ** (LOWEST + LIMB_BITS * i)``.

    Every value is cut into signed limbs of ``LIMB_BITS`` bits, which are exact
    integers; their sums are longs that hold 2^39 rows. So they can be added up
    by map tasks, partitions or days in any order. Bits below 2^-144 are cut
    off each value; a value of 2^96 and more, an infinity or NaN is in no limb
    (see ``sum_outside``). Null over no (non-null) rows.
    """
    c = _col(c).cast("double")
    inside, base = F.when(F.abs(c) < F.lit(2.0**96), c), F.lit(float(_BASE))
    return [_over(F.sum((inside * 2.0 ** -(LOWEST + LIMB_BITS * i) % base).cast("long")), over) for i in range(LIMBS)]


def sum_outside(c: ColumnOrName, over: WindowSpec | None = None) -> Column:
    """Plain sum of the values that no limb can hold; null without any."""
    c = _col(c).cast("double")
    return _over(F.sum(F.when(~(F.abs(c) < F.lit(2.0**96)), c)), over)


# Rounding of a sum in limbs, as one SQL lambda: each step's result is bound to
# a name, so nothing is computed, or analysed, twice.
_CARRIED = """aggregate({0}, named_struct('carry', 0L, 'digits', cast(array() as array<bigint>)),
  (acc, x) -> named_struct('carry', shiftright(x + acc.carry, {bits}),
                           'digits', concat(array((x + acc.carry) & {mask}L), acc.digits)))"""
_BIND = "element_at(transform(array({0}), {1} -> {2}), 1)"


def _nearest_double() -> str:
    bits, mask = LIMB_BITS, _BASE - 1

    def carried(of: str) -> str:
        return _CARRIED.format(of, bits=bits, mask=mask)

    # digits from the highest: what goes beyond the limbs is two more
    digits = f"concat(array(shiftright(both.carry, {bits}), both.carry & {mask}L), both.digits, array(0L, 0L, 0L))"
    lead = "cast(array_position(transform(d, x -> x > 0), true) as int)"  # from 1; 0 if all are 0
    high = f"cast(element_at(d, lead) * {_BASE}L + element_at(d, lead + 1) as double)"
    low = f"cast(element_at(d, lead + 2) * {_BASE}L + element_at(d, lead + 3) as double)"
    # what is left below decides between two doubles only where the rest is a tie
    rest = f"if(exists(slice(d, lead + 4, {LIMBS + 5}), x -> x > 0), 0.5D, 0D)"
    unit = f"power(2D, ({LIMBS - 1} - lead) * {bits} + {LOWEST})"
    value = f"if(lead = 0, 0D, ({high} * {2.0 ** (2 * bits)!r}D + ({low} + {rest})) * {unit})"
    value = _BIND.format(digits, "d", _BIND.format(lead, "lead", value.replace("element_at(d, lead)", "element_at(d, greatest(lead, 1))")))
    value = _BIND.format(carried("transform(p, x -> if(negative, -x, x))"), "both", value)
    return "p -> " + _BIND.format(f"{carried('p')}.carry < 0", "negative", f"if(negative, -1D, 1D) * {value}")


def limbs_value(limbs: list[Column], outside: Column) -> Column:
    """The double nearest to the sum that ``limbs`` stand for (ties to even)."""
    value = F.element_at(F.call_function("transform", F.array(F.array(*limbs)), F.expr(_nearest_double())), 1) + F.lit(0.0)
    value = F.when(limbs[0].isNotNull(), value)
    return F.coalesce(outside + F.coalesce(value, F.lit(0.0)), value)


def exact_sum(c: ColumnOrName, over: WindowSpec | None = None) -> Column:
    """The sum of a double column, rounded once: the same to the last bit for
    any order of rows, partitions or partial sums. Nulls are skipped; null over
    no rows. Values of 2^96 and more are added to it in plain floating point."""
    return limbs_value(sum_limbs(c, over), sum_outside(c, over))


def _sum(c: Column, over: WindowSpec | None, exact: bool) -> Column:
    return exact_sum(c, over) if exact else _over(F.sum(c), over).cast("double")


def na_sum(c: ColumnOrName, over: WindowSpec | None = None, exact: bool = False) -> Column:
    """Sum that is null if any input is null; 0.0 over no rows.

    All parts are ordinary partial aggregates, so a grouped ``na_sum``
    still combines map-side before the shuffle. ``exact``: see ``exact_sum``.
    """
    c = _col(c)
    return F.when(~any_null(c, over), F.coalesce(_sum(c, over, exact), F.lit(0.0)))


def sum_or_zero(c: ColumnOrName, over: WindowSpec | None = None, exact: bool = False) -> Column:
    """Sum ignoring nulls; 0.0 over no (non-null) rows."""
    return F.coalesce(_sum(_col(c), over, exact), F.lit(0.0))


def na_mean(c: ColumnOrName, over: WindowSpec | None = None, exact: bool = False) -> Column:
    """Mean that is null if any input is null (N1); null over no rows."""
    c = _col(c)
    mean = exact_sum(c, over) / F.nullif(_over(F.count(c), over), F.lit(0)) if exact else _over(F.avg(c), over)
    return F.when(~any_null(c, over), mean)


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Division with null for a zero divisor instead of an error."""
    return F.try_divide(_col(num), _col(den))


def str_remove_first(c: ColumnOrName, pattern: str) -> Column:
    """Remove only the first match of ``pattern``."""
    return F.regexp_replace(_col(c), f"^(.*?){pattern}", "$1")


def str_extract(c: ColumnOrName, pattern: str) -> Column:
    """First match of ``pattern`` or null when nothing matches."""
    return F.regexp_substr(_col(c), F.lit(pattern))


def to_int(c: ColumnOrName) -> Column:
    """Integer conversion that yields null on bad text instead of failing."""
    return _col(c).try_cast("int")


def concat_na(*cols: ColumnOrName, sep: str | None = None) -> Column:
    """String concatenation that is null if any part is null."""
    parts = [_col(c) for c in cols]
    if sep is not None:
        spaced: list[Column] = []
        for i, p in enumerate(parts):
            if i:
                spaced.append(F.lit(sep))
            spaced.append(p)
        parts = spaced
    return F.concat(*parts)


def label_text(c: ColumnOrName) -> Column:
    """Text of a value for a label, printing null as ``NA``."""
    return F.coalesce(_col(c).cast("string"), F.lit(NA_TOKEN))


def fixed_text(c: ColumnOrName, decimals: int) -> Column:
    """Fixed-point text of a number (``%.<d>f``), rounded by ``half_even``;
    null prints as ``NA``."""
    c = _col(c)
    return F.when(c.isNull(), F.lit(NA_TOKEN)).otherwise(F.format_string(f"%.{decimals}f", half_even(c, decimals) + F.lit(0.0)))


def number_text(c: ColumnOrName, decimals: int) -> Column:
    """A rounded number as a label prints it: no trailing zeros (36, not
    36.0), and the exponent form where that is shorter (1e+05)."""
    fixed = F.regexp_replace(fixed_text(c, decimals), r"\.0+$|(\.\d*?[1-9])0+$", "$1")
    sign, digits = F.regexp_extract(fixed, r"^(-?)", 1), F.regexp_extract(fixed, r"^-?([1-9]\d*?)0{5,}$", 1)
    power = F.length(fixed) - F.length(sign) - 1
    head = F.concat(sign, F.substring(digits, 1, 1), F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substring(digits, 2, 40))).otherwise(F.lit("")))
    short = F.concat(head, F.lit("e+"), F.lpad(power.cast("string"), 2, "0"))
    return F.when((digits != "") & (F.length(short) < F.length(fixed)), short).otherwise(fixed)


def percent_text(ratio: ColumnOrName, decimals: int = 1) -> Column:
    """A ratio shown as a percent label, e.g. ``-29.8%``."""
    text = fixed_text(_col(ratio) * F.lit(100.0), decimals)
    return F.when(text == NA_TOKEN, text).otherwise(F.concat(text, F.lit("%")))


def in_set(c: ColumnOrName, values: Iterable) -> Column:
    """Membership that is never null: a null value is not in the set."""
    return F.coalesce(_col(c).isin(list(values)), F.lit(False))


def not_in(c: ColumnOrName, values: Iterable) -> Column:
    return ~in_set(c, values)


def half_even(c: ColumnOrName, decimals: int) -> Column:
    """Rounding of the stored number, used by the report's labels (N17): of
    the two neighbours with that many decimals the nearer to the double, which
    is rarely a tie (0.15 is stored below its name and gives 0.1); of a tie
    the one with the even digit."""
    c, power = _col(c).cast("double"), F.lit(10.0**decimals)
    below, above = F.floor(c * power), F.ceil(c * power)
    down, up = c - below / power, above / power - c
    nearer = F.when(down < up, below).when(up < down, above).when(below % 2 == 0, below).otherwise(above)
    # numbers this large have no such decimals; NaN and infinities stay
    return F.when(F.abs(c) * power < F.lit(2.0**52), nearer / power).otherwise(c)


#: Gaps below this are noise, and a column of one value has none: whole percents.
LEAST_GAP = 2.0**-26


def fitting_accuracy(c: ColumnOrName, *by: ColumnOrName) -> Column:
    """The unit that the values of a column (in each ``by`` group) should be
    shown in (X12): one digit finer than the order of the smallest gap between
    two of them, a digit coarser again if that digit is 0 in all, and 1 at most.
    Over finished report rows: its windows hold a group of them."""
    c = _col(c)
    value = F.when(F.abs(c) < F.lit(float("inf")), c)
    group = Window.partitionBy(*by)
    gap = value - F.lag(value).over(group.orderBy(value.asc_nulls_first()))
    least = F.min(F.when(gap > 0, gap)).over(group)
    unit = F.pow(F.lit(10.0), F.floor(F.log10(least)) - 1)
    trailing = F.bool_and(F.rint(value / unit) % 10 == 0).over(group)
    fitted = F.least(F.when(trailing, unit * 10).otherwise(unit), F.lit(1.0))
    return F.when(least >= F.lit(LEAST_GAP), fitted).otherwise(F.lit(1.0))


def fitted_percent_text(ratio: ColumnOrName, *by: ColumnOrName) -> Column:
    """A ratio as a percent label with as many decimals as its column (in
    each ``by`` group) needs to tell its values apart (X12)."""
    percent = _col(ratio) * F.lit(100.0)
    unit = fitting_accuracy(percent, *by)
    decimals = F.least(F.greatest(-F.floor(F.log10(unit)), F.lit(0)), F.lit(20))
    text = F.call_function("format_string", F.concat(F.lit("%."), decimals.cast("string"), F.lit("f%%")), F.rint(percent / unit) * unit + F.lit(0.0))
    return F.when(percent.isNull(), F.lit(NA_TOKEN)).otherwise(text)


def whole_partition(*keys: str) -> WindowSpec:
    """Window over the whole partition of ``keys`` (no ordering frame)."""
    return Window.partitionBy(*keys).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
