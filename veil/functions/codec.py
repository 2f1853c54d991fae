"""Typed values to and from big-endian bytes, as built-in column expressions.

Everything stays inside the JVM: integers go through ``hex``/``conv``, and
IEEE-754 numbers are taken apart and put together with exact arithmetic
(scaling by a power of two never rounds), so no Python worker is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from veil.spec import FIXED_WIDTH

# Fixed values of the byte format.
TRUE_BYTE = "FF"
FALSE_BYTE = "00"

_WIDE = {"digits": 52, "bias": 1023, "max_exponent": 2047}
_NARROW = {"digits": 23, "bias": 127, "max_exponent": 255}


def _long_to_bytes(c: Column, width: int) -> Column:
    digits = F.lpad(F.hex(c.cast("bigint")), 16, "0")
    return F.unhex(F.substring(digits, 17 - 2 * width, 2 * width))


def bits(c: Column) -> Column:
    """The first eight bytes of a value as a number, big-endian."""
    return F.conv(F.hex(F.substring(c, 1, 8)), 16, -10).cast("bigint")


def _signed(number: Column, width: int) -> Column:
    if width == 8:
        return number
    half, whole = 1 << (8 * width - 1), 1 << (8 * width)
    return F.when(number >= half, number - F.lit(whole)).otherwise(number)


def _form(kind: T.DataType) -> dict:
    return _WIDE if isinstance(kind, T.DoubleType) else _NARROW


def _guess(x: Column) -> Column:
    finite = F.abs(x) < float("inf")
    return F.when(finite, F.floor(F.log2(F.abs(x)))).cast("int")


def _exponent(x: Column, guess: Column) -> Column:
    """The logarithm may be off by one next to a power of two."""
    a, two = F.abs(x), F.lit(2.0)
    return (
        guess
        + F.when(a >= F.pow(two, guess + 1), 1).otherwise(0)
        - F.when(a < F.pow(two, guess), 1).otherwise(0)
    )


def _ieee_to_bits(x: Column, exponent: Column, form: dict) -> Column:
    digits, bias = form["digits"], form["bias"]
    a = F.abs(x)
    scaled = (a / F.pow(F.lit(2.0), exponent) - 1.0) * float(2**digits)
    normal = F.shiftleft((exponent + bias).cast("bigint"), digits) + scaled.cast("bigint")
    tiny = (a / F.lit(2.0 ** (1 - bias - digits))).cast("bigint")
    infinite = F.lit(form["max_exponent"] << digits).cast("bigint")
    magnitude = (
        F.when(F.isnan(x), infinite + F.lit(1 << (digits - 1)))
        .when(a == float("inf"), infinite)
        .when(a < 2.0 ** (1 - bias), tiny)
        .otherwise(normal)
    )
    negative = (x < 0) | ((x == 0) & x.cast("string").startswith("-"))
    sign = F.lit(-(1 << 63) if form is _WIDE else 1 << 31).cast("bigint")
    return F.when(x.isNotNull(), F.when(negative, magnitude.bitwiseOR(sign)).otherwise(magnitude))


def float_steps(x: Column, kind: T.DataType, prefix: str) -> list[tuple[str, Column]]:
    """Columns to add one after the other; the last one holds the bits of ``x``.

    In steps, every part is computed once per row. Inside one expression the
    branches of a condition would compute shared parts again and again.
    """
    wide, guess, exponent = F.col(f"{prefix}_x"), F.col(f"{prefix}_guess"), F.col(f"{prefix}_exponent")
    return [
        (f"{prefix}_x", x.cast("double")),
        (f"{prefix}_guess", _guess(wide)),
        (f"{prefix}_exponent", _exponent(wide, guess)),
        (f"{prefix}_bits", _ieee_to_bits(wide, exponent, _form(kind))),
    ]


def _bits_to_ieee(number: Column, form: dict) -> Column:
    digits, bias = form["digits"], form["bias"]
    exponent = F.shiftright(number, digits).bitwiseAND(F.lit(form["max_exponent"]).cast("bigint"))
    mantissa = number.bitwiseAND(F.lit((1 << digits) - 1).cast("bigint"))
    sign_bit = F.shiftrightunsigned(number, 63 if form is _WIDE else 31).bitwiseAND(F.lit(1).cast("bigint"))
    sign = F.when(sign_bit == 1, F.lit(-1.0)).otherwise(F.lit(1.0))
    power = F.pow(F.lit(2.0), (exponent - (bias + digits)).cast("double"))
    magnitude = (
        F.when((exponent == form["max_exponent"]) & (mantissa == 0), F.lit(float("inf")))
        .when(exponent == form["max_exponent"], F.lit(float("nan")))
        .when(exponent == 0, mantissa.cast("double") * F.lit(2.0 ** (1 - bias - digits)))
        .otherwise((mantissa + F.lit(1 << digits)).cast("double") * power)
    )
    return sign * magnitude


def to_bytes(c: Column, kind: T.DataType, length: int | None = None) -> Column:
    """Raw bytes of a typed value; fixed-width numbers are big-endian."""
    if isinstance(kind, T.BooleanType):
        out = F.when(c.isNotNull(), F.unhex(F.when(c, TRUE_BYTE).otherwise(FALSE_BYTE)))
    elif isinstance(kind, T.ByteType):
        out = _long_to_bytes(c, 1)
    elif isinstance(kind, T.ShortType):
        out = _long_to_bytes(c, 2)
    elif isinstance(kind, T.IntegerType):
        out = _long_to_bytes(c, 4)
    elif isinstance(kind, T.LongType):
        out = _long_to_bytes(c, 8)
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        x = c.cast("double")
        out = bits_to_bytes(_ieee_to_bits(x, _exponent(x, _guess(x)), _form(kind)), kind)
    elif isinstance(kind, T.StringType):
        out = F.encode(c, "utf-8")
    elif isinstance(kind, T.BinaryType):
        out = c
    else:
        raise ValueError(f"no byte form for type {kind.simpleString()}")
    if length is not None and isinstance(kind, (T.StringType, T.BinaryType)):
        wrong = F.raise_error(F.lit(f"a key part is not {length} bytes long"))
        out = F.when(out.isNull() | (F.octet_length(out) == length), out).otherwise(wrong.cast("binary"))
    return out


def bits_to_bytes(number: Column, kind: T.DataType) -> Column:
    """Raw bytes of a number whose bits are at hand."""
    return _long_to_bytes(number, FIXED_WIDTH[type(kind)])


def _only(number: Column, kind: T.DataType, length: Column) -> Column:
    """Of the bits of a value of some length, those of its first bytes that its type takes; null if it has fewer."""
    width = FIXED_WIDTH[type(kind)]
    surplus = (F.least(length, F.lit(8)) - width) * 8
    if width == 8:
        return F.when(length >= width, number)
    mask = F.lit((1 << 8 * width) - 1).cast("bigint")
    return F.when(length >= width, F.call_function("shiftrightunsigned", number, surplus.cast("int")).bitwiseAND(mask))


def from_bits(number: Column, kind: T.DataType, length: Column | None = None) -> Column:
    """Typed value from :func:`bits` of a value of ``length`` bytes (if not given, of just as many as its type takes).

    Of a longer value the first bytes count, a shorter one is null.
    """
    if length is not None:
        number = _only(number, kind, length)
    if isinstance(kind, T.BooleanType):
        return number != 0
    if isinstance(kind, T.DoubleType):
        return _bits_to_ieee(number, _WIDE)
    if isinstance(kind, T.FloatType):
        return _bits_to_ieee(_signed(number, 4), _NARROW).cast("float")
    return _signed(number, FIXED_WIDTH[type(kind)]).cast(kind)


def from_bytes(c: Column, kind: T.DataType) -> Column:
    """Typed value of raw bytes written by :func:`to_bytes`; numbers of too few bytes are null."""
    if type(kind) in FIXED_WIDTH:
        return from_bits(bits(c), kind, F.octet_length(c))
    if isinstance(kind, T.StringType):
        return F.decode(c, "utf-8")
    if isinstance(kind, T.BinaryType):
        return c
    raise ValueError(f"no byte form for type {kind.simpleString()}")
