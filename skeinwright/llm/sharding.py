"""Sharding by proportional stratified interleaving, with built-in functions only.

Rows of a source are put in a seeded order and ranked; a row's fractional rank is (rank - phase) / rows
of its source, where the phase in (0, 1) is drawn from the source's name, so that many small sources
spread evenly too. All rows sorted by fractional rank are cut into shards whose row counts differ by
one at most, and each shard holds every source in proportion.

No rank is taken in one task: the seeded order is an order by a 64-bit hash, so a source is first split
by the hash's leading bits, and fractional ranks, which are uniform, are split by value. Ranks within
these cells plus running counts of the cells give the global ones. The number of cells changes no result.

Defined results: a null text counts as empty; null sources form one stratum; a null id is hashed like
any other; rows equal in id are ordered by text checksum, size and source, and fully equal rows are
interchangeable. An empty table gives no rows. Only named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

_RANGE = float(2**63)


def _unit(h: Column) -> Column:
    """A 64-bit hash as a number in [0, 1)."""
    return F.least((h.cast("double") + F.lit(_RANGE)) / F.lit(2 * _RANGE), F.lit(1 - 2**-53))


def _before(counts: DataFrame, by: list[str], cell: str, n: str, out: str) -> DataFrame:
    """Adds the number of rows in the cells before, within ``by``."""
    w = Window.partitionBy(*by).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(out, F.coalesce(F.sum(n).over(w), F.lit(0)))


def interleave(
    df: DataFrame,
    shards: int = 40,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    seed: int = 42,
) -> DataFrame:
    """One row per row: key, source, size, text_crc32, law, shard, slot, position."""
    spark = df.sparkSession
    cells = 4 * max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    raw = F.coalesce(df[text], F.lit(""))
    rows = df.select(
        df[key].alias("k"),
        df[source].alias("s"),
        (F.octet_length(raw) + 16).cast("long").alias("size"),
        F.crc32(raw).alias("crc"),
    ).withColumn("h", F.xxhash64(F.lit(seed), "k", "crc", "size"))
    rows = materialize(
        rows.withColumn("c1", F.floor(_unit(F.col("h")) * cells).cast("int")), "shard-rows"
    )
    strata = rows.groupBy("s", "c1").agg(F.count(F.lit(1)).alias("n"))
    strata = materialize(strata, "shard-cells")
    offsets = _before(strata, ["s"], "c1", "n", "off").withColumn(
        "n_s", F.sum("n").over(Window.partitionBy("s"))
    )
    within = Window.partitionBy("s", "c1").orderBy("h", "k", "crc", "size")
    placed = (
        rows.withColumn("r", F.row_number().over(within))
        .join(
            offsets.select(F.col("s").alias("s2"), F.col("c1").alias("c2"), "off", "n_s"),
            F.col("s").eqNullSafe(F.col("s2")) & (F.col("c1") == F.col("c2")),
        )
        .withColumn("phase", _unit(F.xxhash64(F.lit(seed), F.lit("phase"), "s")))
        .withColumn("f", (F.col("off") + F.col("r") - F.col("phase")) / F.col("n_s"))
        .withColumn("g", F.floor(F.col("f") * cells).cast("int"))
        .select("k", "s", "size", "crc", "h", "f", "g")
    )
    placed = materialize(placed, "shard-ranks")
    groups = _before(placed.groupBy("g").agg(F.count(F.lit(1)).alias("n")), [], "g", "n", "off")
    groups = groups.withColumn("total", F.sum("n").over(Window.partitionBy()))
    # at most `cells` + 1 rows
    ordered = Window.partitionBy("g").orderBy("f", F.xxhash64("s"), "s", "h", "k", "crc", "size")
    at = (
        placed.withColumn("r", F.row_number().over(ordered))
        .join(F.broadcast(groups.select("g", "off", "total")), "g")
        .withColumn("position", F.col("off") + F.col("r") - 1)
    )
    # shard s takes the positions from ceil(s * total / shards) on
    at = at.withColumn("shard", F.expr(f"cast(position * {shards} div total as int)"))
    begin = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return at.select(
        F.col("k").alias(key),
        F.col("s").alias(source),
        "size",
        F.col("crc").cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        (F.col("position") - begin).cast("long").alias("slot"),
        F.col("position").cast("long"),
    )
