"""Shards of near-equal bytes by sampled splitters, with DataFrame functions alone.

Rows have a total order: hash of the text, hash of the id, tie-break. Equal texts are
neighbours, and a group of copies of any size can still be cut. A sample of keys, drawn
with probability in proportion to size, gives the boundaries of ranges; the exact bytes
of each range are counted, and ranges that came out too full are sampled and cut again.
The position of a row in bytes is then that of its range plus a running sum inside
it, and the shard follows from the position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from likertlake.session import Workspace

SHARDS = 24
#: Ranges for each shard at least, rows of a range as planned, sampled keys for each range.
RANGES, RANGE_ROWS, PER_RANGE = 16, 2_000_000, 32
#: A range of more than this many times its planned bytes or rows is overfull.
OVERFULL = 2.0
#: Sorts after every key, which is made of hexadecimal digits.
LAST = "~"


def row_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text (none for null) and eight for the id."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("bigint")


def _hex(column: Column) -> Column:
    return F.lpad(F.hex(column), 16, "0")


def _table(values: list, kind: str) -> Column:
    """A constant array as one literal."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>") if values else F.array().cast(f"array<{kind}>")


def _range_of(key: Column, splitters: list[str]) -> Column:
    """How many of the sorted ``splitters`` are not above the key, by binary search."""
    if not splitters:
        return F.lit(0)
    depth = len(splitters).bit_length()
    table = _table(splitters + [LAST] * ((1 << depth) - 1 - len(splitters)), "string")
    steps = F.array(*[F.lit(1 << d) for d in reversed(range(depth))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(table, at + step - 1) <= key, at + step).otherwise(at))


def _sample(rows: DataFrame, n: int, seed: int, total: int, n_rows: int) -> list[str]:
    """``n`` keys, each drawn in proportion to size, sorted: those of the least draws.

    About twice as many draws lie below the threshold that the rows' ``total`` size gives, whatever the number of tasks,
    and only these are fetched. Where they are too few, because few large rows have most of the size, it is raised.
    """
    unit = (F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
    drawn = rows.select("key", (-F.log(unit) / F.col("size")).alias("draw"))
    below = 2.0 * n / max(1, total)
    while True:
        found = [(r.draw, r.key) for r in drawn.where(F.col("draw") < below).collect()]
        if len(found) >= min(n, n_rows):
            return sorted(key for _, key in sorted(found)[:n])
        below *= 4


def _splitters(rows: DataFrame, total: int, n_rows: int, ranges: int) -> tuple[list[str], list[tuple[int, int]]]:
    """Splitters of ranges none of which is overfull, and bytes and rows of each range."""
    keys, bytes_most, rows_most = _sample(rows, ranges * PER_RANGE, 0, total, n_rows), OVERFULL * total / ranges, max(1.0, OVERFULL * n_rows / ranges)
    splitters = sorted(set(keys[PER_RANGE::PER_RANGE]))
    for seed in range(1, 1 << 20):
        ranged = rows.withColumn("range", _range_of(F.col("key"), splitters))
        found = {r["range"]: (r["bytes"], r["n"]) for r in ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")).collect()}
        sizes = [found.get(k, (0, 0)) for k in range(len(splitters) + 1)]
        over = [k for k, (b, n) in enumerate(sizes) if n > 1 and (b > bytes_most or n > rows_most)]
        if not over:
            break
        parts = sum(int(max(sizes[k][0] / bytes_most, sizes[k][1] / rows_most)) + 1 for k in over)
        inner = ranged.where(F.get(_table([int(k in set(over)) for k in range(len(sizes))], "int"), F.col("range")) == 1)
        more = _sample(inner, 2 * parts * PER_RANGE, seed, sum(sizes[k][0] for k in over), sum(sizes[k][1] for k in over))
        grown = sorted(set(splitters) | set(more[PER_RANGE::PER_RANGE] or more[len(more) // 2 :][:1]))
        if len(grown) == len(splitters):  # a range of few large rows: cut at any of them
            grown = sorted(set(splitters) | set(more))
        splitters = grown
    return splitters, sizes


def assign(docs: DataFrame, text: str = "text", id: str = "doc_id", shards: int = SHARDS, carry: tuple[str, ...] = (), range_rows: int = RANGE_ROWS) -> DataFrame:
    """Each row's ``id``, ``size``, ``text_crc32``, ``shard`` and ``slot``, and columns to ``carry``.

    Shards differ by about the size of one row; one row larger than a share fills its own.
    Slots count from 0 in each shard, without gaps, in the order of the keys. Null
    texts have no bytes and a null checksum; null or repeated ids and equal rows are
    placed like any others. Carried columns keep their names, after an underscore if
    they clash. ``write`` makes files of the shards.
    """
    space = Workspace(docs.sparkSession, "shards")
    value = F.col(f"`{text}`")
    own = ("id", "size", "text_crc32", "shard", "slot")
    kept = [F.col(f"`{c}`").alias(f"_{c}" if c in own else c) for c in carry]
    key = F.concat(_hex(F.xxhash64(value)), _hex(F.xxhash64(F.col(f"`{id}`"))), _hex(F.monotonically_increasing_id()))
    # Written once, so the tie-break is fixed from here on.
    rows = space.cut(docs.select(F.col(f"`{id}`").alias("id"), row_bytes(value).alias("size"), F.crc32(value).alias("text_crc32"), key.alias("key"), F.struct(*kept).alias("carried") if kept else F.lit(0).alias("carried")), "keys")
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    ranges = max(RANGES * shards, -(-n_rows // range_rows))
    splitters, sizes = _splitters(rows, total, n_rows, ranges)
    byte_at, row_at = [0], [0]
    for b, n in sizes:
        byte_at.append(byte_at[-1] + b)
        row_at.append(row_at[-1] + n)
    order = Window.partitionBy("range").orderBy("key")
    upto = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumn("range", _range_of(F.col("key"), splitters)).select("*", upto.alias("upto"), F.row_number().over(order).alias("nth"))
    # Twice the byte at a row's middle, so that all is whole numbers.
    middle = 2 * (F.get(_table(byte_at, "bigint"), F.col("range")) + F.col("upto")) - F.col("size")
    shard = F.least(F.lit(shards - 1), F.call_function("div", middle * shards, F.lit(2 * max(total, 1)).cast("bigint")))
    number = F.get(_table(row_at, "bigint"), F.col("range")) + F.col("nth") - 1
    placed = space.cut(placed.select("id", "size", "text_crc32", shard.cast("int").alias("shard"), number.alias("number"), "carried"), "placed")
    first = {r.shard: r.first for r in placed.groupBy("shard").agg(F.min("number").alias("first")).collect()}
    slot = F.col("number") - F.get(_table([first.get(k, 0) for k in range(shards)], "bigint"), F.col("shard"))
    return placed.select("id", "size", "text_crc32", "shard", slot.alias("slot"), *(["carried.*"] if kept else []))


def write(docs: DataFrame, path: str, text: str = "text", id: str = "doc_id", shards: int = SHARDS) -> None:
    """Whole records as Parquet, a folder for each shard."""
    assign(docs, text, id, shards, tuple(docs.columns)).write.partitionBy("shard").parquet(path)
