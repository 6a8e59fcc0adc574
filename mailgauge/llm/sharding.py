"""Sharding by sampled splitters: shards of nearly equal bytes over ranges of a text hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mailgauge.llm.common import numbered, position
from mailgauge.sources.scratch import land

# Ranges per shard, keys drawn per range, and cells that splitters are looked up by.
RANGES_PER_SHARD = 128
DRAWN_PER_RANGE = 16
LOOKUP_BITS = 12


def text_size(text: Column) -> Column:
    """Bytes of a text (none for null), plus one."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def draw_keys(records: DataFrame, n: int) -> DataFrame:
    """key, weight of about ``n`` records, drawn with probabilities in proportion to their sizes.

    A record of more than an ``n``-th of all bytes is drawn for certain and
    weighs what it would count for.  The draw is a hash of the record and can be
    repeated.
    """
    total = records.agg(F.sum("size").alias("all"))
    u = F.shiftrightunsigned(F.xxhash64("key", "tie", F.lit("draw")), 11) / float(1 << 53)
    expected = F.col("size") * n / F.col("all")
    return (
        records.join(F.broadcast(total))
        .filter(u < expected)
        .select("key", F.greatest(F.lit(1.0), expected).alias("weight"))
    )


def choose_splitters(drawn: DataFrame, n_ranges: int) -> DataFrame:
    """splitter: the keys in which the quantiles of the drawn weight lie.

    A key that fills two steps or more gets a range to itself.  The drawn
    keys are few whatever the input, so one task orders them.
    """
    weights = drawn.groupBy("key").agg(F.sum("weight").alias("weight"))
    up_to = Window.orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = weights.select(
        "key",
        "weight",
        F.sum("weight").over(up_to).alias("sum"),
        (F.sum("weight").over(Window.partitionBy()) / n_ranges).alias("step"),
    )
    crossed = F.floor(F.col("sum") / F.col("step")) > F.floor((F.col("sum") - F.col("weight")) / F.col("step"))
    wide = (F.col("weight") >= 2 * F.col("step")) & (F.col("key") < (1 << 63) - 1)
    begins = F.when(wide, F.array(F.col("key"), F.col("key") + 1)).otherwise(F.array("key"))
    return ordered.filter(crossed).select(F.explode(begins).alias("splitter")).distinct()


def splitter_lookup(splitters: DataFrame) -> DataFrame:
    """prefix, before, bounds: the splitters of each of the 2**LOOKUP_BITS cells of the key space.

    A key's range is ``before`` and the number of ``bounds`` up to the key.
    """
    spark = splitters.sparkSession
    cells = spark.range(1 << LOOKUP_BITS).select((F.col("id") - (1 << (LOOKUP_BITS - 1))).alias("prefix"))
    by_cell = splitters.groupBy(F.shiftright("splitter", 64 - LOOKUP_BITS).cast("long").alias("prefix")).agg(
        F.sort_array(F.collect_list("splitter")).alias("bounds")
    )
    filled = cells.join(by_cell, "prefix", "left").withColumn(
        "bounds", F.coalesce("bounds", F.array().cast("array<bigint>"))
    )
    earlier = Window.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    return filled.select("prefix", F.coalesce(F.sum(F.size("bounds")).over(earlier), F.lit(0)).alias("before"), "bounds")


def with_range(records: DataFrame, lookup: DataFrame) -> DataFrame:
    """``records`` with ``range``, found in the cell of the key."""
    prefix = F.shiftright("key", 64 - LOOKUP_BITS).cast("long")
    up_to = F.size(F.filter("bounds", lambda b: b <= F.col("key")))
    return (
        records.withColumn("prefix", prefix)
        .join(F.broadcast(lookup), "prefix")
        .withColumn("range", F.col("before") + up_to)
        .drop("prefix", "before", "bounds")
    )


def _sub(n_subs: Column) -> Column:
    """Which part of an overfull range: by record where the range is one key, else by key."""
    h = F.when(F.col("single"), F.xxhash64("tie", F.lit("part"))).otherwise(F.xxhash64("key", F.lit("part")))
    share = F.shiftrightunsigned(h, 11) / float(1 << 53)
    return F.when(n_subs > 1, F.floor(share * n_subs)).otherwise(0).cast("long")


def plan_shards(records: DataFrame, n_shards: int) -> tuple[DataFrame, DataFrame]:
    """(splitter lookup, parts) for stored records of key, tie and size.

    ``parts`` has a row per range and part of it: n_subs and single of the
    range, the shard, and the first slot.  A range of more than two even
    shares is subdivided; then whole parts are dealt to shards in order, each
    to the shard in whose stretch of bytes its middle lies.
    """
    n_ranges = n_shards * RANGES_PER_SHARD
    drawn = draw_keys(records, n_ranges * DRAWN_PER_RANGE)
    lookup = land(splitter_lookup(choose_splitters(drawn, n_ranges)))
    ranged = with_range(records, lookup)
    filled = ranged.groupBy("range").agg(
        F.sum("size").alias("bytes"), (F.min("key") == F.max("key")).alias("single")
    )
    total = filled.agg(F.sum("bytes").alias("all"))
    overfull = land(
        filled.join(F.broadcast(total)).select(
            "range", "single", F.greatest(F.lit(1), F.ceil(F.col("bytes") * n_ranges / F.col("all") / 2)).alias("n_subs")
        )
    )
    parts = (
        ranged.join(F.broadcast(overfull), "range")
        .withColumn("sub", _sub(F.col("n_subs")))
        .groupBy("range", "sub", "n_subs", "single")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    )
    everything = Window.partitionBy()
    in_order = Window.orderBy("range", "sub").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("bytes").over(in_order), F.lit(0))
    middle = (before + F.col("bytes") / 2) / F.sum("bytes").over(everything)
    in_shard = Window.partitionBy("shard").orderBy("range", "sub").rowsBetween(Window.unboundedPreceding, -1)
    dealt = parts.withColumn("shard", F.least(F.lit(n_shards - 1), F.floor(middle * n_shards)).cast("int")).select(
        "range", "sub", "n_subs", "single", "shard", F.coalesce(F.sum("rows").over(in_shard), F.lit(0)).alias("first_slot")
    )
    return lookup, land(dealt)


def _keyed(body: Column) -> dict[str, Column]:
    return {"key": F.xxhash64(body), "size": text_size(body), "text_crc32": F.crc32(body.cast("binary"))}


def _placed(keyed: DataFrame, n_shards: int) -> DataFrame:
    """Rows of key and size with shard and slot.  They are stored, so that a row's place tells copies apart."""
    # The number of the file, not its name, so that the same rows read in the same way are placed alike.
    file = F.regexp_extract("_metadata.file_name", "part-([0-9]+)", 1)
    tie = F.xxhash64(file, F.col("_metadata.row_index"))
    stored = land(keyed).withColumn("tie", tie)
    lookup, parts = plan_shards(stored.select("key", "tie", "size"), n_shards)
    ranges = parts.select("range", "n_subs", "single").distinct()
    placed = with_range(stored, lookup).join(F.broadcast(ranges), "range").withColumn("sub", _sub(F.col("n_subs")))
    heads = parts.select("range", "sub", "shard", "first_slot")
    in_part = Window.partitionBy("range", "sub").orderBy("key", "tie", "size")
    return (
        placed.join(F.broadcast(heads), ["range", "sub"])
        .withColumn("slot", (F.col("first_slot") + F.row_number().over(in_part) - 1).cast("long"))
        .drop("range", "sub", "n_subs", "single", "first_slot", "key", "tie")
    )


def shard_records(docs: DataFrame, n_shards: int = 16, text: str = "text") -> DataFrame:
    """``docs`` with columns named by position, and size, text_crc32, shard and slot.

    Shards have nearly equal bytes.  Rows of equal text lie side by side and
    stay in one shard unless they fill more than a range, two 128ths of a shard;
    then they are divided row by row, whatever their ids, also where they are
    null or repeated.  Null is a text of its own, of size 1 and without
    checksum; a long text is hashed and moved whole.  Slots number
    the rows of a shard from 0 without gap, in the order of hashes.  An empty
    table gives no rows.

    The rows are stored once.  Only keys and sizes are gathered to plan the ranges: a splitter table and
    a part table whose lengths depend on ``n_shards``.  The records then move
    once, to the task that numbers their part.
    """
    return _placed(numbered(docs).withColumns(_keyed(F.col(position(docs, text)))), n_shards)


def shard_assignments(
    docs: DataFrame, n_shards: int = 16, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row (see ``shard_records``).

    The law is ``bytes``; it says nothing of another number of shards, so
    grown_shard is null.  No text is stored or moved.
    """
    keyed = docs.select(F.col(doc_id).alias("doc_id"), *[c.alias(n) for n, c in _keyed(F.col(text)).items()])
    return _placed(keyed, n_shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, n_shards: int = 16, text: str = "text") -> None:
    """The records as Parquet below ``path/shard=<n>``, with their slots."""
    sharded = shard_records(docs, n_shards, text)
    names = dict(zip(numbered(docs).columns, docs.columns))
    kept = [F.col(c).alias(names[c]) for c in names if names[c].lower() not in ("shard", "slot")]
    sharded.select(*kept, "slot", "shard").write.partitionBy("shard").parquet(path)
