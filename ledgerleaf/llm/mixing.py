"""Mixing sources to target weights on a low-discrepancy schedule (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal, getcontext

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.tools import NO_ID, doc_rows, free_prefix, hash_bucket, root_of, running
from ledgerleaf.session import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
BLOCK_WORDS = 4096
SEED = 7
WORD = r"[^\x20\x09-\x0D]+"

getcontext().prec = 50
_GOLDEN = (Decimal(5).sqrt() - 1) / 2
_LOW_BITS = 20
GOLDEN = float(_GOLDEN)
GOLDEN_HIGH = float(_GOLDEN * (1 << _LOW_BITS) % 1)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, rank, weight, target) for ``sizes(source, source_size)``.

    Sources by code point, null last, take the weights in turn.  Targets share
    ``share`` of all sizes by weight; a target stops at ``repeats`` times its source's
    size, and the excess is shared again until none is above.  Each pass is one
    aggregate over the sources, of which only the sums come to the driver.
    """
    spark = sizes.sparkSession
    order = ("is_null", "utf8")
    named = sizes.withColumn("is_null", F.col("source").isNull()).withColumn("utf8", F.coalesce("source", F.lit("")).cast("binary"))
    # A rank needs all sources in order: sorted ranges are counted, then numbered inside.
    ranges = named.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    ranges = written(ranges.withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = ranges.join(F.broadcast(starts), "part").withColumn("rank", inside + F.col("start"))
    table = table.select(
        "source",
        "source_size",
        "rank",
        F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * repeats).cast("double").alias("most"),
    )
    table = written(table, "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        above = F.col("most") < F.col("weight") * F.lit(level)
        row = table.agg(
            F.count(F.when(above, 1)).alias("n"),
            F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0.0)).alias("taken"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        if row["n"] == full or not row["weight"]:
            break
        full, level = row["n"], (share * total - row["taken"]) / row["weight"]
    return table.select("source", "source_size", "rank", "weight", F.least("most", F.col("weight") * F.lit(level)).alias("target"))


def schedule(targets: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(rank, block_no, place): where each block of each source comes in the mix.

    Slot i maps the golden-ratio point frac(i * 0.618...) through the cumulative
    targets to a source; the slots of a source, ranked, take its blocks in turn.  The
    few blocks that the slots of their source leave over follow behind the last slot.
    """
    spark = targets.sparkSession
    goals = targets.select("rank", F.floor("target").alias("goal")).filter("goal > 0")
    goals = goals.withColumn("blocks", F.ceil(F.col("goal") / block)).withColumn("all", F.lit(0))
    goals = written(goals, "goals")
    total, slots, sources = goals.agg(F.sum("goal"), F.sum("blocks"), F.count("*")).first()
    if not total:
        return spark.createDataFrame([], "rank long, block_no long, place long")
    by_rank = F.floor(F.col("rank") / root_of(sources))
    spans = written(running(goals, "all", ["rank"], "goal", "lower", by_rank), "spans")
    spans = written(running(spans, "all", ["rank"], "blocks", "blocks_before", by_rank), "spans")

    # A point meets its source in equal cells of the line of all targets.
    cells = root_of(slots)
    width = -(-total // cells)
    last = F.floor((F.col("lower") + F.col("goal") - 1) / width)
    listed = spans.select("rank", "lower", (F.col("lower") + F.col("goal")).alias("upper"), F.explode(F.sequence(F.floor(F.col("lower") / width), last)).alias("cell"))
    high, low = F.shiftright("slot", _LOW_BITS), F.col("slot").bitwiseAND(F.lit((1 << _LOW_BITS) - 1))
    points = spark.range(slots).withColumnRenamed("id", "slot")
    points = points.withColumn("x", high * F.lit(GOLDEN_HIGH) % 1 + low * F.lit(GOLDEN) % 1)
    points = points.select("slot", F.least(F.floor(F.col("x") % 1 * total), F.lit(total - 1)).alias("at"))
    points = points.withColumn("cell", F.floor(F.col("at") / width))
    hits = points.join(listed, "cell").filter("at >= lower AND at < upper").select("rank", "slot", F.lit(1).alias("one"))
    ranked = running(written(hits, "slots"), "rank", ["slot"], "one", "block_no", F.floor(F.col("slot") / root_of(slots)))

    blocks = spans.select("rank", "blocks_before", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block_no"))
    placed = blocks.join(ranked.select("rank", "block_no", "slot"), ["rank", "block_no"], "left")
    behind = F.lit(slots) + F.col("blocks_before") + F.col("block_no")
    return placed.select("rank", "block_no", F.coalesce("slot", behind).alias("place"))


def mix(docs: DataFrame, block: int = BLOCK_WORDS, weights=WEIGHTS, share: float = SHARE, repeats: int = MOST_REPEATS):
    """(rows, pieces): the documents with their targets, and what the mix takes of them.

    Size is the number of words, 0 for a null text.  The documents of a source form one
    stream in the order of a seeded hash, repeated up to ``repeats`` times; blocks of
    ``block`` words cut it, and the schedule takes a source's blocks up to its target.
    ``rows`` has doc_id, text_hash, size, source_size, target, rank and ``start``, the
    words before it in its stream.  ``pieces`` has rank, start, again (0 for the first
    time), place, words: a document meets each of its blocks.  A null source is a
    source of its own; repeated rows are documents of their own.
    """
    counted = doc_rows(docs, "source", F.xxhash64("text", "source").alias("text_hash"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    counted = written(counted, "sizes")
    targets = written(source_targets(counted.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats), "targets")
    named = targets.withColumnRenamed("source", "of")
    rows = counted.join(named, F.col("source").eqNullSafe(F.col("of"))).withColumn("shuffled", F.xxhash64(F.lit(SEED), "doc_id"))
    rows = written(rows.drop("of", "weight"), "rows")
    key = ["shuffled", "doc_id", "text_hash"]
    rows = running(rows, "rank", key, "size", "start", hash_bucket(rows.count(), "shuffled"))
    rows = written(rows.drop("shuffled"), "streams")

    times = rows.filter("size > 0").withColumn("again", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    first = F.col("again") * F.col("source_size") + F.col("start")
    spans = times.select("rank", "start", "again", first.alias("first"), F.least(first + F.col("size"), F.floor("target")).alias("end")).filter("first < end")
    parts = spans.withColumn("block_no", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor((F.col("end") - 1) / block))))
    words = F.least("end", (F.col("block_no") + 1) * block) - F.greatest("first", F.col("block_no") * block)
    placed = parts.join(schedule(targets, block), ["rank", "block_no"])
    return rows, placed.select("rank", "start", "again", "place", words.alias("words"))


def op7_mix_sources(docs: DataFrame) -> DataFrame:
    rows, pieces = mix(docs)
    taken = pieces.groupBy("rank", "start").agg(F.sum("words").alias("words"), F.min("place").alias("first_place"))
    # Rows without words share the start of the next row, and take nothing.
    found = rows.join(taken, ["rank", "start"], "left")
    words = F.when(F.col("size") > 0, F.coalesce("words", F.lit(0))).otherwise(F.lit(0))
    place = F.when(F.col("size") > 0, F.col("first_place")).alias("first_place")
    return found.select("doc_id", "size", "source_size", "target", words.cast("long").alias("taken"), place)


def _cut(words: str):
    """Texts up to the end of as many words as the column ``words`` states."""
    import re

    pattern = re.compile(WORD)

    def first(text: str, n: int) -> str:
        for i, found in enumerate(pattern.finditer(text), 1):
            if i == n:
                return text[: found.end()]
        return text

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            at = batch.schema.get_field_index("text")
            cut = [first(t, n) for t, n in zip(batch.column("text").to_pylist(), batch.column(words).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(cut, pa.string()) if i == at else batch.column(i) for i in range(batch.num_columns)], batch.schema.names)

    return run


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of the mix with the columns of ``docs``: a document comes as often as it
    is taken, the last of a source's stream cut after its words; n_chars follows the text.
    Rows come in the order of the place in the mix where they begin."""
    rows, pieces = mix(docs)
    prefix = free_prefix(docs)
    id_, hash_, words, place, start, whole = (prefix + name for name in ("id", "hash", "words", "place", "start", "whole"))
    copies = pieces.groupBy("rank", "start", "again").agg(F.sum("words").alias(words), F.min("place").alias(place))
    plan = rows.filter("size > 0").join(copies, ["rank", "start"])
    plan = plan.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(hash_), words, place, F.col("start").alias(start), (F.col(words) == F.col("size")).alias(whole))
    keyed = docs.withColumn(id_, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn(hash_, F.xxhash64("text", "source"))
    taken = keyed.dropDuplicates([id_, hash_]).join(plan, [id_, hash_]).drop(id_, hash_)
    cut = taken.filter(~F.col(whole)).mapInArrow(_cut(words), taken.schema)
    mixed = taken.filter(F.col(whole)).union(cut)
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    order = (place, start)
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order).select(docs.columns)
