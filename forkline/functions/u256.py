"""Exact unsigned 256-bit arithmetic with built-in Spark expressions.

A value travels as a canonical decimal string.  Arithmetic happens on three
base-10**26 limbs, which fit ``decimal(26,0)`` and leave ten digits of head-room
for products and twelve for sums.  Comparison uses the 32-byte big-endian form,
whose byte order is numeric order.
"""

from decimal import Decimal, localcontext

from pyspark.sql import Column, functions as F

BASE_DIGITS = 26
BASE = 10 ** BASE_DIGITS
WORD = 2 ** 32


def _dec(n: int, precision: int = 38) -> Column:
    with localcontext() as ctx:
        ctx.prec = 60
        return F.lit(Decimal(n)).cast(f"decimal({precision},0)")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _total(terms: list) -> Column:
    total = terms[0]
    for term in terms[1:]:
        total = (total + term).cast("decimal(38,0)")
    return total


def _let(value: Column, body) -> Column:
    """Bind ``value`` once: nested uses neither repeat the work nor the generated code."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _decimal_text(lo: Column, mid: Column, hi: Column) -> Column:
    """Digits of non-negative limbs, each possibly carrying beyond 26 digits."""
    def digits(c):
        return F.lpad(c.cast("decimal(38,0)").cast("string"), 38, "0")

    def over(text):
        return F.left(text, F.lit(12)).cast("decimal(38,0)")

    def keep(text):
        return F.right(text, F.lit(BASE_DIGITS))

    def with_lo(lo_text):
        def with_mid(mid_text):
            top = (hi + over(mid_text)).cast("decimal(38,0)").cast("string")
            text = F.ltrim(F.concat(top, keep(mid_text), keep(lo_text)), F.lit("0"))
            return F.when(text == "", F.lit("0")).otherwise(text)
        return _let(digits(mid + over(lo_text)), with_mid)

    return _let(digits(lo), with_lo)


def limbs(value) -> tuple:
    """``(lo, mid, hi)`` base-10**26 limbs of a decimal string.  Values of at most 26
    digits, nearly all there are, are parsed once and have zero upper limbs."""
    short = F.length(value) <= BASE_DIGITS
    zero = F.lit(0).cast("decimal(26,0)")
    padded = F.lpad(value, 3 * BASE_DIGITS, "0")
    parts = [F.substring(padded, 1 + BASE_DIGITS * i, BASE_DIGITS).cast("decimal(26,0)") for i in (2, 1, 0)]
    whole = value if isinstance(value, Column) else F.col(value)
    return (F.when(short, whole.cast("decimal(26,0)")).otherwise(parts[0]),
            F.when(short, zero).otherwise(parts[1]), F.when(short, zero).otherwise(parts[2]))


def word(hex_text) -> Column:
    """The last 32 bytes of unprefixed hex text as 64 digits, zero-filled on the left."""
    return F.right(F.concat(F.lit("0" * 64), hex_text), F.lit(64))


def from_hex(hex_text) -> Column:
    """Big-endian unprefixed hex text to a decimal string, exact over the whole range."""
    return _from_word(word(F.col(hex_text) if isinstance(hex_text, str) else hex_text))


def from_be(binary) -> Column:
    """Big-endian bytes (at most 32) to a decimal string."""
    return from_hex(F.hex(binary))


def _from_word(h: Column) -> Column:
    low = F.conv(F.right(h, F.lit(16)), 16, 10)
    # below 2**126 two 64-bit words fit one decimal, which stays in generated code
    high = F.conv(F.substring(h, 33, 16), 16, 10).cast("decimal(20,0)")
    middle = (high * _dec(WORD * WORD, 20) + low.cast("decimal(20,0)")).cast("decimal(38,0)").cast("string")
    parts = F.array(*[F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("decimal(10,0)")
                      for i in range(8)])

    def weighted(parts, position):
        terms = []
        for i in range(8):
            digit = (WORD ** (7 - i)) // BASE ** position % BASE
            if digit:
                terms.append((F.get(parts, F.lit(i)) * _dec(digit, 26)).cast("decimal(38,0)"))
        return _total(terms)

    wide = _let(parts, lambda p: _let(
        F.array(*[weighted(p, position) for position in range(3)]),
        lambda s: _decimal_text(*[F.get(s, F.lit(i)) for i in range(3)])))
    return (F.when(F.left(h, F.lit(48)) == "0" * 48, low)
            .when((F.left(h, F.lit(32)) == "0" * 32) & (F.substring(h, 33, 1) < "4"), middle)
            .otherwise(wide))


def to_be(value) -> Column:
    """Decimal string to 32 big-endian bytes."""
    value = F.col(value) if isinstance(value, str) else value
    number = value.cast("decimal(38,0)")
    below = number % _dec(WORD * WORD, 20)
    short = F.unhex(F.concat(
        F.lit("0" * 32), F.lpad(F.hex(_div(number, _dec(WORD * WORD, 20))), 16, "0"),
        F.lpad(F.hex(_div(below, _dec(WORD, 10))), 8, "0"),
        F.lpad(F.hex((below % _dec(WORD, 10)).cast("bigint")), 8, "0")))
    return F.when(F.length(value) <= 37, short).otherwise(_wide_to_be(value))


def _wide_to_be(value: Column) -> Column:
    word_base = _dec(WORD, 10)

    def split(limb):
        # base-2**32 digits of one limb (10**26 < 2**96), least significant first
        return _let(_div(limb, word_base).cast("decimal(20,0)"), lambda rest: F.array(
            (limb % word_base).cast("decimal(12,0)"),
            (rest % word_base).cast("decimal(12,0)"),
            _div(rest, word_base).cast("decimal(12,0)")))

    def columns(digits):
        sums = [[] for _ in range(8)]
        for i, weight in enumerate((1, BASE, BASE * BASE)):
            for j in range(3):
                for k in range(8 - j):
                    factor = weight // WORD ** k % WORD
                    if factor:
                        digit = F.get(F.get(digits, F.lit(i)), F.lit(j))
                        sums[j + k].append((digit * _dec(factor, 10)).cast("decimal(38,0)"))
        return F.array(*[_total(terms) for terms in sums])

    def step(acc, column):
        return _let((column + acc["carry"]).cast("decimal(38,0)"), lambda t: F.struct(
            _div(t, word_base).cast("decimal(38,0)").alias("carry"),
            F.concat(F.lpad(F.hex((t % word_base).cast("bigint")), 8, "0"), acc["text"]).alias("text")))

    start = F.struct(_dec(0).alias("carry"), F.lit("").alias("text"))
    digits = F.array(*[split(limb) for limb in limbs(value)])
    return F.unhex(_let(digits, lambda d: F.aggregate(columns(d), start, step))["text"])


def sum_signed(value: str, weight: str = "1") -> Column:
    """Exact aggregate ``sum(weight * value)`` as a decimal string, negative if need be.

    ``value`` and ``weight`` are column names or SQL expressions.  Three decimal sums that
    combine partially; a group may hold 10**12 maximal values.
    """
    short = f"length({value}) <= {BASE_DIGITS}"
    sums = []
    for start in (2 * BASE_DIGITS + 1, BASE_DIGITS + 1, 1):
        part = f"CAST(substring(lpad({value}, {3 * BASE_DIGITS}, '0'), {start}, {BASE_DIGITS}) AS DECIMAL(26,0))"
        brief = f"CAST({value} AS DECIMAL(26,0))" if start > 2 * BASE_DIGITS else "CAST(0 AS DECIMAL(26,0))"
        limb = f"CASE WHEN {short} THEN {brief} ELSE {part} END"
        sums.append(f"CAST(sum(CAST({limb} * CAST({weight} AS DECIMAL(2,0)) AS DECIMAL(28,0))) AS DECIMAL(38,0))")
    return F.expr(_let_sql(f"array({', '.join(sums)})", "s", _total_sql("s")))


def _let_sql(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _total_sql(sums: str) -> str:
    """Decimal text of an array of three summed limbs ``[lo, mid, hi]``."""
    base, wide = f"{BASE}BD", "DECIMAL(38,0)"

    def over(from_, kept):
        return f"CAST(CAST(({from_} - {kept}) AS {wide}) div {base} AS {wide})"

    def borrow(s, tag):
        # bring lo and mid into [0, 10**26); hi then carries the sign of the total
        lo, mid, rest = f"lo{tag}", f"mid{tag}", f"rest{tag}"
        top = f"CAST({s}[2] + {over(mid, rest)} AS {wide})"
        limbs_ = f"array(CAST({lo} AS {wide}), CAST({rest} AS {wide}), {top})"
        return _let_sql(f"pmod({s}[0], {base})", lo, _let_sql(
            f"CAST({s}[1] + {over(f'{s}[0]', lo)} AS {wide})", mid,
            _let_sql(f"pmod({mid}, {base})", rest, limbs_)))

    def show(limbs_):
        digits = f"concat(CAST({limbs_}[2] AS STRING), " + ", ".join(
            f"lpad(CAST({limbs_}[{i}] AS STRING), {BASE_DIGITS}, '0')" for i in (1, 0)) + ")"
        return f"coalesce(nullif(trim(LEADING '0' FROM {digits}), ''), '0')"

    minus = f"transform({sums}, x -> CAST(-x AS {wide}))"
    negative = _let_sql(minus, "n", _let_sql(borrow("n", "n"), "q", f"concat('-', {show('q')})"))
    return _let_sql(borrow(sums, "p"), "p", (
        f"CASE WHEN p[2] IS NULL THEN NULL WHEN p[2] >= 0 THEN {show('p')} ELSE {negative} END"))


def literal_word(n: int) -> str:
    if not 0 <= n < 2 ** 256:
        raise ValueError("not an unsigned 256-bit integer")
    return f"{n:064x}"


def hex_greater(hex_text, n: int) -> Column:
    """``uint256(hex_text) > n`` by comparing equally long lower-case hex words."""
    return F.lower(word(hex_text)) > literal_word(n)


def be_greater(binary, n: int) -> Column:
    """``uint256(bytes) > n`` for 32-byte values, by byte order."""
    return F.lpad(binary, F.lit(32), F.lit(b"\x00")) > F.lit(n.to_bytes(32, "big"))


def scaled(value, power: int) -> Column:
    """``value / 10**power`` as a double, for display."""
    return F.col(value).cast("double") / 10.0 ** power if isinstance(value, str) \
        else value.cast("double") / 10.0 ** power
