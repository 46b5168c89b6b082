"""Exact decimal arithmetic whose results have the digits a SQL database's ``numeric`` gives them.

A number is a struct: an integer ``u`` and the count ``s`` of its decimals. Sums and products are exact. A quotient
has at least 16 significant digits, and no fewer decimals than either operand, and is rounded half away from zero, as
PostgreSQL documents and does it; Spark's own decimals would cut a scale that depends on the declared types. All of it
is built-in functions on rows that were added up before: one row per ticker, not per trade.

The functions compose SQL text, of which ``column`` and ``decimal`` make columns: a formula is one parsed expression
instead of thousands of calls into the JVM. Integers have 38 digits. Whatever needs more fails under ANSI rules
instead of losing digits; only the product of ``product_text`` may have more, and is text.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = "decimal(38,0)"
#: Quotients and amounts in tables; further decimals are cut, never rounded, so that cutting to cents stays right.
AMOUNT = T.DecimalType(38, 24)
#: Parts of a quantity: one digit less before the point, so that whole quantities can be added exactly.
PART = T.DecimalType(36, 24)
#: Significant digits of a quotient, and the decimal digits of one digit of a number in the database.
_SIGNIFICANT, _GROUP = 16, 4
_names = count()


def _let(value: str, body: Callable[[str], str]) -> str:
    """``body`` of a value that is computed once, however often it is used there."""
    name = f"v{next(_names)}"
    return f"element_at(transform(array({value}), {name} -> {body(name)}), 1)"


def _whole(value: str) -> str:
    return f"cast({value} AS {_WHOLE})"


def _power(n: str) -> str:
    """Ten to the power of ``n``, up to 37."""
    return _whole(f"rpad('1', {n} + 1, '0')")


def _number(u: str, s: str) -> str:
    return _let(u, lambda x: f"if({x} IS NULL, NULL, named_struct('u', {_whole(x)}, 's', cast({s} AS int)))")


def number(value: str, scale: int = 0) -> str:
    """A decimal with so many decimals, or an integer, as number; null stays null."""
    return _number(f"({value}) * {10**scale}BD" if scale else value, str(scale))


def plus(*numbers: str) -> str:
    """Sum, with the decimals of the operand that has most; null if one is null."""

    def add(n: str) -> str:
        scale = f"greatest({', '.join(f'{n}.n{i}.s' for i in range(len(numbers)))})"

        def total(s: str) -> str:
            parts = [_whole(f"{n}.n{i}.u * {_power(f'({s} - {n}.n{i}.s)')}") for i in range(len(numbers))]
            done = parts[0]
            for part in parts[1:]:
                done = _whole(f"{done} + {part}")
            return _number(done, s)

        return _let(scale, total)

    fields = ", ".join(f"'n{i}', {n}" for i, n in enumerate(numbers))
    return _let(f"named_struct({fields})", add)


def times(a: str, b: str) -> str:
    """Product, with the decimals of both; null if one is null."""
    return _let(f"named_struct('a', {a}, 'b', {b})", lambda n: _number(f"{n}.a.u * {n}.b.u", f"{n}.a.s + {n}.b.s"))


def _leading(u: str, scale: str) -> str:
    """Place of a number's first group of four digits, counted from the point, and that group; 0 and 0 for zero."""

    def group(x: str) -> str:
        place = f"cast(floor({x}.e / {_GROUP}) AS int)"
        first = f"cast(rpad(left({x}.t, {x}.e - {_GROUP} * {place} + 1), {x}.e - {_GROUP} * {place} + 1, '0') AS int)"
        return f"if({x}.t = '0', named_struct('place', 0, 'first', 0), named_struct('place', {place}, 'first', {first}))"

    return _let(_let(f"cast({u} AS string)", lambda t: f"named_struct('t', {t}, 'e', length({t}) - 1 - {scale})"), group)


def _times_in(t: str, d: str) -> str:
    """How often ``d`` goes into ``t``, without a detour over long integers."""
    return _whole(f"({t} - {t} % {d}) / {d}")


def over(a: str, b: str) -> str:
    """Quotient by long division; null if the divisor is zero or an operand is null."""

    def sized(n: str) -> str:
        return (
            f"named_struct('n', {_whole(f'abs({n}.a.u)')}, 'd', {_whole(f'abs({n}.b.u)')}, 'ns', {n}.a.s, 'ds', {n}.b.s, "
            f"'sign', if(({n}.a.u < 0) != ({n}.b.u < 0), -1, 1))"
        )

    def grouped(x: str) -> str:
        return f"named_struct('x', {x}, 'a', {_leading(f'{x}.n', f'{x}.ns')}, 'b', {_leading(f'{x}.d', f'{x}.ds')})"

    def scaled(g: str) -> str:
        place = f"({g}.a.place - {g}.b.place - int({g}.a.first <= {g}.b.first))"
        scale = f"greatest({_SIGNIFICANT} - {_GROUP} * {place}, {g}.x.ns, {g}.x.ds, 0)"
        return f"named_struct('x', {g}.x, 's', {scale})"

    def divided(y: str) -> str:
        n, d = f"{y}.x.n", f"{y}.x.d"
        zeros = f"({y}.x.ds - {y}.x.ns + {y}.s)"
        begin = f"named_struct('q', {_times_in(n, d)}, 'r', {_whole(f'{n} % {d}')})"
        # Eight digits at a time while the remainder leaves room for them, then one by one.
        step = f"if(length(cast({d} AS string)) <= 29, 8, 1)"
        powers = _let(
            step,
            lambda w: f"concat(array_repeat({_power(w)}, cast(floor({zeros} / {w}) AS int)), array_repeat({_power('1')}, {zeros} % {w}))",
        )
        done, power = f"v{next(_names)}", f"v{next(_names)}"
        digits = _let(
            _whole(f"{done}.r * {power}"),
            lambda t: f"named_struct('q', {_whole(f'{done}.q * {power} + {_times_in(t, d)}')}, 'r', {_whole(f'{t} % {d}')})",
        )
        whole = f"aggregate({powers}, {begin}, ({done}, {power}) -> {digits})"
        rounded = _let(whole, lambda z: _number(f"({z}.q + if({z}.r * 2 >= {d}, 1, 0)) * {y}.x.sign", f"{y}.s"))
        return f"if({d} != 0 AND {n} IS NOT NULL, {rounded}, NULL)"

    return _let(_let(_let(_let(f"named_struct('a', {a}, 'b', {b})", sized), grouped), scaled), divided)


def column(value: str) -> Column:
    """A number as column, whose name then stands for it in further formulas."""
    return F.expr(value)


def _fixed(value: str, scale: int) -> str:
    """Text with ``scale`` decimals, cut toward zero, of a number that is given as digits ``t``, ``s`` and ``sign``."""

    def moved(n: str) -> str:
        more = f"({n}.s - {scale})"
        cut = f"if({more} > 0, left({n}.t, length({n}.t) - {more}), concat({n}.t, repeat('0', -{more})))"
        return f"named_struct('t', {cut}, 'sign', {n}.sign)"

    def pointed(x: str) -> str:
        text = f"lpad({x}.t, greatest(length({x}.t), {scale + 1}), '0')"
        return f"concat({x}.sign, {_let(text, lambda t: f"concat(left({t}, length({t}) - {scale}), '.', right({t}, {scale}))")})"

    return _let(_let(value, moved), pointed)


def _size(u: str) -> str:
    """Absolute value; ``abs`` would round what has over 34 digits."""
    return _whole(f"if({u} < 0, 0 - {u}, {u})")


def _sign(negative: str) -> str:
    return f"if({negative}, '-', '')"


def decimal(value: str, kind: T.DecimalType = AMOUNT) -> Column:
    """A number as decimal, cut toward zero where it has more decimals than the type."""
    digits = _let(value, lambda n: f"named_struct('t', cast(abs({n}.u) AS string), 's', {n}.s, 'sign', {_sign(f'{n}.u < 0')})")
    return F.expr(f"cast({_fixed(digits, kind.scale)} AS {kind.simpleString()})")


#: Digits of a limb of a long product: three limbs hold an integer, and sums of three products of limbs fit one.
_LIMB, _LIMBS = 13, 3


def product_text(a: str, b: str, scale: int = AMOUNT.scale) -> Column:
    """Exact product of two numbers as text with ``scale`` decimals, cut toward zero; null if one is null.

    The product may have twice the digits of an integer: it is added up limb by limb.
    """
    base = _power(str(_LIMB))

    def limbs(u: str) -> str:
        def cut(n: str) -> str:
            parts = [f"{_whole(f'{n} % {base}')}"]
            for i in range(1, _LIMBS):
                higher = _times_in(n, _power(str(i * _LIMB)))
                parts.append(_whole(f"{higher} % {base}"))
            return f"array({', '.join(parts)})"

        return _let(_size(u), cut)

    def multiplied(n: str) -> str:
        sums = []
        for place in range(2 * _LIMBS):
            pairs = [(i, place - i) for i in range(_LIMBS) if 0 <= place - i < _LIMBS]
            terms = [_whole(f"{n}.a[{i}] * {n}.b[{j}]") for i, j in pairs]
            sums.append(_whole(" + ".join(terms or ["0"])))
        done, digit = f"v{next(_names)}", f"v{next(_names)}"
        step = _let(
            _whole(f"{done}.more + {digit}"),
            lambda t: f"named_struct('more', {_times_in(t, base)}, "
            f"'t', concat(lpad(cast({_whole(f'{t} % {base}')} AS string), {_LIMB}, '0'), {done}.t))",
        )
        begin = f"named_struct('more', {_whole('0')}, 't', '')"
        text = f"aggregate(array({', '.join(sums)}), {begin}, ({done}, {digit}) -> {step}, {done} -> ltrim('0', {done}.t))"
        return f"named_struct('t', {text}, 's', {n}.s, 'sign', {n}.sign)"

    def parts(n: str) -> str:
        negative = f"({n}.a.u < 0) != ({n}.b.u < 0) AND {n}.a.u != 0 AND {n}.b.u != 0"
        fields = f"'a', {limbs(f'{n}.a.u')}, 'b', {limbs(f'{n}.b.u')}, 's', {n}.a.s + {n}.b.s, 'sign', {_sign(negative)}"
        digits = _let(f"named_struct({fields})", multiplied)
        return f"if({n}.a.u IS NULL OR {n}.b.u IS NULL, NULL, {_fixed(digits, scale)})"

    return F.expr(_let(f"named_struct('a', {a}, 'b', {b})", parts))
