"""Exact arithmetic against Python's decimals of unlimited precision, and digits known from PostgreSQL."""

import random
from decimal import ROUND_DOWN, ROUND_HALF_UP, Decimal, getcontext, localcontext


from ledgerspark.functions import numeric
from ledgerspark.functions.text import format_amount

SCHEMA = "i int, a decimal(28,6), b decimal(28,6), n bigint"


def group(value: Decimal) -> tuple[int, int]:
    """Place and value of the first digit to the base of 10 000."""
    if not value:
        return 0, 0
    place = 0
    value = abs(value)
    while value >= 10_000:
        value, place = value / 10_000, place + 1
    while value < 1:
        value, place = value * 10_000, place - 1
    return place, int(value)


def quotient(a: Decimal, scale_a: int, b: Decimal, scale_b: int) -> Decimal:
    (place_a, first_a), (place_b, first_b) = group(a), group(b)
    scale = max(16 - 4 * (place_a - place_b - (first_a <= first_b)), scale_a, scale_b, 0)
    return (a / b).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP)


def test_quotients(frame):
    rng = random.Random(4)
    values = lambda: Decimal(rng.randint(-(10 ** rng.randint(0, 17)), 10 ** rng.randint(0, 17))).scaleb(-6)
    rows = [(i, values(), values(), rng.randint(-9, 10 ** rng.randint(1, 7))) for i in range(600)]
    rows += [(600, Decimal(0), Decimal(3), 0), (601, None, Decimal(1), 1), (602, Decimal(1), Decimal(0), 3), (603, Decimal("0.000001"), Decimal(1), 9999)]
    df = frame(rows, SCHEMA)
    a, b, n = numeric.number("a", 6), numeric.number("b", 6), numeric.number("n")
    shown = df.select("i", numeric.column(numeric.over(a, n)).alias("an"), numeric.column(numeric.over(a, b)).alias("ab"), numeric.decimal(numeric.over(a, n)).alias("cut"))
    with localcontext() as context:
        context.prec = 120
        for r in shown.collect():
            _, x, y, z = rows[r["i"]]
            for got, divisor, scale in ((r["an"], z, 0), (r["ab"], y, 6)):
                if x is None or not divisor:
                    assert got is None or got["u"] is None
                    continue
                wanted = quotient(x, 6, Decimal(divisor), scale)
                assert (Decimal(int(got["u"])).scaleb(-got["s"]), got["s"]) == (wanted, -wanted.as_tuple().exponent)
            if x is not None and z:
                assert r["cut"] == quotient(x, 6, Decimal(z), 0).quantize(Decimal(1).scaleb(-24), ROUND_DOWN)
            else:
                assert r["cut"] is None


def test_known_digits(frame):
    known = {
        (100, 3): "33.3333333333333333",
        (1, 3): "0.33333333333333333333",
        (2, 3): "0.66666666666666666667",
        (10, 4): "2.5000000000000000",
        (1000000, 7): "142857.142857142857",
        (-100, 3): "-33.3333333333333333",
        (1, 30000): "0.000033333333333333333333",
    }
    df = frame([(i, Decimal(a), None, b) for i, (a, b) in enumerate(known)], SCHEMA)
    # Operands without decimals: SELECT 100/3::numeric and the like.
    got = df.select("i", numeric.column(numeric.over(numeric.number("cast(a AS decimal(28,0))"), numeric.number("n"))).alias("q")).collect()
    for (r, text) in zip(sorted(got), known.values()):
        assert f"{Decimal(int(r['q']['u'])).scaleb(-r['q']['s']):f}" == text


def test_sums_and_products(frame):
    rows = [(0, Decimal("1.5"), Decimal("-2.25"), 3), (1, Decimal("99999999999.999999"), Decimal("0.000001"), 7), (2, None, Decimal(1), 1)]
    df = frame(rows, SCHEMA)
    a, b, n = numeric.number("a", 6), numeric.number("b", 6), numeric.number("n")
    third = numeric.over(a, n)
    got = df.select("i", numeric.decimal(numeric.plus(a, numeric.times(third, n), b)).alias("x"), numeric.decimal(numeric.times(a, b)).alias("y")).collect()
    with localcontext() as context:
        context.prec = 80
        for i, x, y in got:
            _, one, two, count = rows[i]
            if one is None:
                assert x is None and y is None
            else:
                assert x == one + quotient(one, 6, Decimal(count), 0) * count + two
                assert y == one * two
    assert getcontext().prec == 28


def test_products_of_more_digits_than_an_integer(frame):
    rng = random.Random(7)
    whole = lambda: Decimal(rng.randint(-(10 ** rng.randint(0, 38)) + 1, 10 ** rng.randint(0, 38) - 1))
    rows = [(i, whole(), whole()) for i in range(200)]
    most = Decimal(10**38 - 1)
    rows += [(200, most, most), (201, most.copy_negate(), most), (202, Decimal(0), most.copy_negate()), (203, None, most), (204, most, None), (205, Decimal(10**13), Decimal(10**26))]
    df = frame(rows, "i int, a decimal(38,0), b decimal(38,0)")
    for scale_a, scale_b in ((0, 0), (6, 20), (12, 12), (20, 24)):
        a, b = (f"if({c} IS NULL, NULL, named_struct('u', {c}, 's', {s}))" for c, s in (("a", scale_a), ("b", scale_b)))
        with localcontext() as context:
            context.prec = 150
            for i, text in df.select("i", numeric.product_text(a, b)).collect():
                _, x, y = rows[i]
                if x is None or y is None:
                    assert text is None
                    continue
                wanted = (x.scaleb(-scale_a) * y.scaleb(-scale_b)).quantize(Decimal(1).scaleb(-24), ROUND_DOWN)
                assert text.removeprefix("-") == f"{abs(wanted):f}" and text.startswith("-") == (x * y < 0)


def test_cents_of_periodic_quotients(frame):
    # 100/3 is 33.3333333333333333 in the database, three of them are 99.99..., which are cut and not rounded.
    df = frame([(0, Decimal(100), None, 3), (1, Decimal(200), None, 3), (2, Decimal(-100), None, 3)], SCHEMA)
    n = numeric.number("n")
    price = numeric.over(numeric.number("a", 6), n)
    got = df.select("i", format_amount(numeric.decimal(price)).alias("p"), format_amount(numeric.decimal(numeric.times(price, n))).alias("v")).collect()
    assert [(r["p"], r["v"]) for r in sorted(got)] == [("33,33", "99,99"), ("66,66", "200,00"), ("-33,33", "-99,99")]
