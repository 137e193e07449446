"""Sums of doubles and of their squares that do not depend on the order of the rows.

A double sum rounds at every addition, so its last bits depend on how rows are dealt to tasks, and
a strict comparison with a bound made from it may too. Here each value is cut into whole numbers,

    x = h + m / 2**30 + l / 2**60        x * x = (g * 2**31 + h) + m / 2**30 + l / 2**60,

whose sums are integers: partial sums merge exactly, whatever the order. The square is taken with
its rounding error (the product of a 53-bit number needs 106 bits). What lies below 2**-60 is cut
off value by value, which no order changes either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Values from here on are not cut (their squares would not fit); their groups keep double sums.
LARGE = float(1 << 31)
_UNIT = float(1 << 30)
_SPLIT = float((1 << 27) + 1)  # cuts a double into two halves of 26 bits
_WORD = 1 << 31
LIMBS = ["_h", "_m", "_l", "_sg", "_sh", "_sm", "_sl"]


_NAMES = ("_y", "_s", "_e")  # the value, its square, the square's rounding error


def with_limbs(df: DataFrame, x: str) -> DataFrame:
    """``df`` with the limbs of column ``x`` and of its square, step by step so that none is
    computed twice. Limbs have the sign of what they are cut from."""
    c = F.col
    df = df.withColumn("_y", F.when(F.abs(x) < LARGE, c(x)))
    df = df.withColumns({"_u": c("_y") * _SPLIT - (c("_y") * _SPLIT - c("_y")), "_s": c("_y") * c("_y")})
    df = df.withColumn("_v", c("_y") - c("_u"))
    df = df.withColumn("_e", ((c("_u") * c("_u") - c("_s")) + c("_u") * c("_v") * 2.0) + c("_v") * c("_v"))
    df = df.withColumns({f"_h{n}": c(n).cast("bigint") for n in _NAMES})
    df = df.withColumns({f"_r{n}": (c(n) - c(f"_h{n}").cast("double")) * _UNIT for n in _NAMES})
    df = df.withColumns({f"_m{n}": c(f"_r{n}").cast("bigint") for n in _NAMES})
    return df.withColumns({f"_l{n}": ((c(f"_r{n}") - c(f"_m{n}").cast("double")) * _UNIT).cast("bigint")
                           for n in _NAMES})


def limb_sums() -> list[Column]:
    """Aggregates over the columns of ``with_limbs``: sums of the limbs, and ``_large``, the number
    of values that are too large to be cut."""
    c = F.col
    limbs = [c("_h_y"), c("_m_y"), c("_l_y"), F.shiftright("_h_s", 31),
             c("_h_s").bitwiseAND(F.lit(_WORD - 1)) + c("_h_e"), c("_m_s") + c("_m_e"), c("_l_s") + c("_l_e")]
    return [*[F.sum(v).alias(n) for v, n in zip(limbs, LIMBS)], F.count_if(c("_y").isNull()).alias("_large")]


def with_moments(sums: DataFrame, n: str) -> DataFrame:
    """``sums`` (of ``limb_sums``) with the sum ``_total``, ``_mean`` and the sum of squared deviations
    ``_squares`` of its ``n`` values.

    Deviations are first taken from a whole number near the mean, exactly; what is left to rounding
    is of the size of the deviations themselves."""
    c, k = F.col, F.col(n)
    whole = lambda x: F.col(x).cast("decimal(19,0)")
    low = lambda a, b: c(a) / _UNIT + c(b) / (_UNIT * _UNIT)
    df = sums.withColumn("_total", c("_h") + low("_m", "_l"))
    df = df.withColumn("_c", F.round(c("_total") / k).cast("bigint"))
    big = (whole("_sg") * F.lit(_WORD).cast("decimal(11,0)") + whole("_sh")
           - whole("_c") * whole("_h") * F.lit(2) + whole(n) * whole("_c") * whole("_c"))
    df = df.withColumns({
        "_first": (c("_h") - k * c("_c")) + low("_m", "_l"),
        "_second": big.cast("double") + (c("_sm") - c("_c").cast("double") * 2.0 * c("_m")) / _UNIT + (
            c("_sl") - c("_c").cast("double") * 2.0 * c("_l")) / (_UNIT * _UNIT)})
    return df.withColumns({"_mean": c("_c") + c("_first") / k, "_squares": F.greatest(
        c("_second") - c("_first") * c("_first") / k, F.lit(0.0))})
