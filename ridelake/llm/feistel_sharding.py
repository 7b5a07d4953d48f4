"""Sharding by a Feistel permutation of global row numbers, with built-in functions only.

Rows are numbered in the order of a 128-bit hash of their content, so the numbers don't depend on files or
partitions. The permutation is a Feistel network over pairs of digits, number = r * a + l: in turn l moves by a hash
of r, modulo a, and r by a hash of l, modulo b. It permutes 0 to a * b - 1, just above the number of rows; what
falls beyond the rows walks on along its cycle until it is inside. A row's permuted number p gives its place: shard
p % shards, slot p / shards. So counts of shards are at most one apart, and which row a place holds can be worked
out without the table (``row_at``).
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ridelake.llm.common import checkpointed, row_hashes

SHARDS, SEED, ROUNDS = 40, 97, 6
#: Bytes a row counts besides its text's.
ROW_BYTES = 16
#: Rows are numbered in runs of neighbouring hashes of about so many, in at most 2^16 runs.
RUN_ROWS, MOST_BITS = 100_000, 16
#: A row that repeats more often than this is dealt to several tasks before it is written out.
COPIES_AT_A_TIME = 1 << 14

_ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def radices(n: int) -> tuple[int, int]:
    """a and b of about the root of n, with a * b at least n and as little above as is found up to twice the root."""
    root = isqrt(max(n, 1))
    a = min(range(max(root, 1), 2 * root + 2), key=lambda a: (-n % a, a))
    return a, max(-(-n // a), 1)


def _whole(number: Column, by: int) -> Column:
    """Integer division: the built-in one of longs, which a double would round."""
    return F.call_function("div", number, F.lit(by).cast("long"))


def _network(number: Column, a: int, b: int, seed: int, rounds: range) -> Column:
    """The rounds in their order; a round undoes itself with the sign turned."""
    sign = 1 if rounds.step > 0 else -1

    def moved(digit: Column, by: Column, turn: Column, radix: int) -> Column:
        shift = F.pmod(F.xxhash64(by, turn, F.lit(seed)), F.lit(radix).cast("long"))
        return F.pmod(digit + sign * shift, F.lit(radix).cast("long"))

    def step(digits: Column, turn: Column) -> Column:
        left, right = digits["l"], digits["r"]
        even = F.struct(moved(left, right, turn, a).alias("l"), right.alias("r"))
        odd = F.struct(left.alias("l"), moved(right, left, turn, b).alias("r"))
        return F.when(turn % 2 == 0, even).otherwise(odd)

    radix = F.lit(a).cast("long")
    start = F.struct(F.pmod(number, radix).alias("l"), _whole(number, a).alias("r"))
    turns = F.array(*[F.lit(turn) for turn in rounds])
    return F.aggregate(turns, start, step, lambda digits: digits["r"] * radix + digits["l"])


def _walked(number: Column, n: int, seed: int, rounds: range) -> Column:
    """On along the cycle until the number is below n: at most one step more for each number beyond."""
    a, b = radices(n)
    first = _network(number, a, b, seed, rounds)
    beyond = a * b - n
    if not beyond:
        return first
    steps = F.sequence(F.lit(1), F.lit(beyond))
    return F.aggregate(steps, first, lambda p, _: F.when(p < n, p).otherwise(_network(p, a, b, seed, rounds)))


def permuted(number: Column, n: int, seed: int = SEED) -> Column:
    """Where the permutation of 0 to n - 1 puts a number."""
    return _walked(number.cast("long"), n, seed, range(ROUNDS))


def row_at(shard: Column, slot: Column, n: int, shards: int = SHARDS, seed: int = SEED) -> Column:
    """The number of the row at a place: the permutation's inverse."""
    return _walked(slot.cast("long") * shards + shard.cast("long"), n, seed, range(ROUNDS - 1, -1, -1))


def _identity(docs: DataFrame) -> list[Column]:
    one, other = row_hashes(docs, SEED)
    return [one.alias("_h"), other.alias("_g")]


def _numbers(docs: DataFrame) -> tuple[DataFrame, int, int]:
    """(_h, _g, _copies, _first) of different rows: the number of the first copy; all rows, and a row's most copies."""
    groups = checkpointed(docs.select(*_identity(docs)).groupBy("_h", "_g").agg(F.count("*").alias("_copies")))
    n, most = groups.agg(F.coalesce(F.sum("_copies"), F.lit(0)), F.coalesce(F.max("_copies"), F.lit(0))).first()
    bits = min(max((n // RUN_ROWS).bit_length(), 1), MOST_BITS)
    groups = groups.withColumn("_run", F.shiftright("_h", 64 - bits))
    sums = groups.groupBy("_run").agg(F.sum("_copies").alias("_rows"))
    # One row for each run: at most 2^16.
    before = sums.select("_run", (F.sum("_rows").over(Window.orderBy("_run")) - F.col("_rows")).alias("_before"))
    within = F.sum("_copies").over(Window.partitionBy("_run").orderBy("_h", "_g")) - F.col("_copies")
    first = F.col("_before") + F.col("_within")
    numbered = groups.withColumn("_within", within).join(F.broadcast(before), "_run")
    return numbered.select("_h", "_g", "_copies", first.alias("_first")), n, most


def sharded(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Every row with size, text_crc32, law, shard, slot and grown_shard.

    Shards differ by at most one row; slots count from 0 without gaps; grown_shard is null, as under this law one
    more shard would move nearly all rows. Equal texts are not kept together. A null text has no bytes: size 16 and
    checksum 0. Rows that repeat have places of their own. Columns called as those added are replaced. The places depend on the rows, their columns among them, and on
    ``shards`` and ``seed`` alone. No rows give none.
    """
    if shards < 1:
        raise ValueError("there has to be a shard")
    docs = docs.drop(*_ADDED)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    numbers, n, most = _numbers(docs)
    named = {f"c_{k}": name for k, name in enumerate(docs.columns)}
    size = F.octet_length(text).cast("long") + ROW_BYTES
    crc32 = F.crc32(text.cast("binary"))
    own = [F.col(f"`{name}`").alias(column) for column, name in named.items()]
    own = docs.select(*_identity(docs), *own, size.alias("c_size"), crc32.alias("c_crc32"))
    firsts = [F.first(column).alias(column) for column in (*named, "c_size", "c_crc32")]
    rows = own.groupBy("_h", "_g").agg(*firsts).join(numbers, ["_h", "_g"])
    number = F.col("_first")
    if most > 1:
        runs = F.sequence(F.lit(0).cast("long"), _whole(F.col("_copies") - 1, COPIES_AT_A_TIME))
        rows = rows.withColumn("_part", F.explode(runs))
        if most > COPIES_AT_A_TIME:
            rows = rows.repartition("_h", "_g", "_part")
        start = F.col("_part") * COPIES_AT_A_TIME
        last = F.least(F.col("_copies"), start + COPIES_AT_A_TIME) - 1
        rows = rows.withColumn("_copy", F.explode(F.sequence(start, last)))
        number = number + F.col("_copy")
    rows = rows.withColumn("_place", permuted(number, n, seed))
    return rows.select(
        *[F.col(column).alias(name) for column, name in named.items()],
        F.col("c_size").alias("size"),
        F.col("c_crc32").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.pmod("_place", F.lit(shards).cast("long")).cast("int").alias("shard"),
        _whole(F.col("_place"), shards).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(rows: DataFrame, path: str) -> None:
    """A folder for each shard, its files in order of the slots; a shard may be written by many tasks."""
    ranges = rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    ranges.write.partitionBy("shard").parquet(path)
