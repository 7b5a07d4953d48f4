"""Rows ordered so that files hold narrow ranges of several columns at once (Morton order)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

#: Each column is cut at 2^BITS - 1 quantiles, so two columns make 4,096 cells.
BITS = 6
# A string's order is that of the bytes after what all its values begin with; as many as a long has room for.
_BYTES = 7
_ORDER = "_morton"


def interleaved(df: DataFrame, columns: Sequence[str], files: int, bits: int = BITS) -> DataFrame:
    """``df`` in ``files`` ranges of the columns' interleaved quantile numbers, sorted by them in each.

    Where a sort by (a, b) leaves every value of b in every file, here a filter on either skips most: about the square
    root of the files hold a value of one of two columns. Rows are the same; only their places depend on quantiles,
    which are approximate. Nulls come first; equal cells are ordered by the columns, so that a frequent cell spreads
    over several files by the columns after the first. Columns are strings, numbers, dates, timestamps or booleans.
    Two passes over the columns alone find the quantiles; at most 2^bits numbers a column reach the driver.
    """
    if not columns:
        return df
    place = df.withColumn(_ORDER, morton([_rank(df, *found) for found in _cuts(df, columns, bits)], bits))
    return place.repartitionByRange(files, _ORDER, *columns).sortWithinPartitions(_ORDER, *columns).drop(_ORDER)


def morton(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The numbers' bits dealt in turns, highest first: the first number's is the highest of each turn."""
    if bits * len(ranks) > 62:
        raise ValueError(f"{len(ranks)} numbers of {bits} bits don't fit a long")
    total = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, rank in enumerate(reversed(ranks)):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint")
            total = total.bitwiseOR(F.shiftleft(one, bit * len(ranks) + i))
    return total


def _cuts(df: DataFrame, columns: Sequence[str], bits: int) -> list[tuple[str, int, list]]:
    """Of each column its name, how many bytes all its strings begin with alike, and its quantiles."""
    ends = [f(F.col(c).cast("string")).alias(f"{end}{i}") for i, c in enumerate(columns) for end, f in _ENDS.items()]
    first = df.agg(*ends).first()
    shared = [_shared(first[f"least{i}"], first[f"most{i}"]) for i in range(len(columns))]
    shares = [i / 2**bits for i in range(1, 2**bits)]
    quantiles = [
        F.percentile_approx(_number(df, c, n), shares, 10_000).alias(f"q{i}")
        for i, (c, n) in enumerate(zip(columns, shared, strict=True))
    ]
    found = df.agg(*quantiles).first()
    return [(c, n, found[f"q{i}"] or []) for i, (c, n) in enumerate(zip(columns, shared, strict=True))]


_ENDS = {"least": F.min, "most": F.max}


def _shared(least: str | None, most: str | None) -> int:
    """Bytes that both begin with; so does every string between them."""
    if least is None:
        return 0
    pairs = list(zip(least.encode(), most.encode(), strict=False))
    return next((i for i, (a, b) in enumerate(pairs) if a != b), len(pairs))


def _number(df: DataFrame, column: str, shared: int) -> Column:
    """A number in the order of the column's values."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, StringType):
        part = F.substring(F.encode(value, "UTF-8"), shared + 1, _BYTES)
        return F.conv(F.rpad(F.hex(part), 2 * _BYTES, "0"), 16, 10).cast("bigint")
    if isinstance(kind, DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, TimestampNTZType):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, BooleanType):
        return value.cast("bigint")
    if isinstance(kind, NumericType):
        return value.cast("double")
    raise ValueError(f"{column} is {kind.simpleString()}, which has no quantiles")


def _rank(df: DataFrame, column: str, shared: int, cuts: list) -> Column:
    """How many quantiles the value is beyond, none for null; equal values have one number."""
    if not cuts:
        return F.lit(0)
    number = _number(df, column, shared)
    bounds = F.array(*[F.lit(cut) for cut in cuts])
    return F.coalesce(F.size(F.filter(bounds, lambda cut: cut < number)), F.lit(0))
