from pyspark.sql import Column, functions as F

# Significant digits a value keeps before it is rounded, and the sizes where the power of ten that does it is exact.
_DIGITS = 14
_LEAST_SIZE, _MOST_SIZE = _DIGITS - 1 - 22, _DIGITS - 1


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division where x/0 is NULL, under ANSI mode too."""
    return F.try_divide(numerator, denominator)


def round_sum(value: Column, digits: int) -> Column:
    """Round half up a value that comes from adding up doubles.

    The last bits of a sum depend on how its rows were partitioned, so it is cut to 14 significant digits first:
    a tie stays a tie on every run, and for every number of rows. Values of everyday size are cut by a power of ten,
    others by way of their text, which takes a hundred times longer.
    """
    size = F.floor(F.log10(F.abs(value)))
    power = F.pow(F.lit(10.0), F.lit(_DIGITS - 1.0) - size)
    written = F.format_string(f"%.{_DIGITS - 1}e", value).cast("double")
    cut = (
        F.when(value.isNull() | F.isnan(value) | (value == 0), value)
        .when(size.between(_LEAST_SIZE, _MOST_SIZE), F.rint(value * power) / power)
        .otherwise(written)
    )
    return F.round(cut, digits)
