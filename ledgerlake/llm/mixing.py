"""Mixing sources to target weights by a low-discrepancy schedule.

1. Each source's documents are shuffled (by a digest) and laid end to end,
   one pass after another; the line is cut into blocks of equal tokens.
2. Golden-ratio points are mapped through the sources' cumulative shares of
   the slots, so any stretch of the schedule is close to the targets.
3. Slots are ranked per source; slot ``r`` of a source takes block ``r`` of
   its line, and the last one is trimmed to the target.  Where the points
   leave a source a slot short, closing slots end the schedule; a slot too
   many is dropped.

The schedule is the result: ``mix_schedule`` gives the words that each slot
takes, and what a row gives to the mix is the sum of its pieces.

Prefix sums run in two levels (digest bucket, then within the bucket), so a
source that holds a third of all rows never sits in one task.

Defined cases: NULL text has size 0 and takes nothing; a NULL source is a
source of its own, sorted last; NULL and repeated ids are rows like others;
an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, cut

GOLDEN = 0.6180339887498949
#: Fixed rule of the weights: 1, 2, 3 repeating over the sorted sources.
WEIGHT_CYCLE = 3
MAX_PASSES = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def golden_point(i: Column) -> Column:
    """Fraction of ``i`` golden ratios; split so that large ``i`` stay exact enough."""
    big = 1 << 20
    frac = lambda x: x - F.floor(x)
    return frac(frac(F.floor(i / big) * (GOLDEN * big % 1.0)) + frac((i % big) * GOLDEN))


def source_targets(sizes: DataFrame) -> DataFrame:
    """sid, source, source_size, target, quota of every source.

    ``sizes`` has one row per source (source, source_size), a table that is
    small beside the documents.  Targets share the total by weight; a target
    above MAX_PASSES times its source is cut to that and the excess shared
    again.  In the order of cap / weight the cut sources are a prefix, so two
    running sums replace the rounds.
    """
    everything = W.partitionBy()
    before = W.orderBy("ratio", "sid").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(38,0)")
    t = (sizes.withColumn("sid", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
              .withColumn("weight", (1 + (F.col("sid") - 1) % WEIGHT_CYCLE).cast("long"))
              .withColumn("cap", MAX_PASSES * F.col("source_size"))
              .withColumn("ratio", F.col("cap") / F.col("weight"))
              .withColumn("total", F.sum("source_size").over(everything))
              .withColumn("weights", F.sum("weight").over(everything))
              .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), zero))
              .withColumn("left_w", F.col("weights") - F.coalesce(F.sum("weight").over(before), zero))
              .withColumn("cut", F.col("cap").cast("decimal(38,0)") * F.col("left_w").cast("decimal(20,0)")
                          < F.col("weight").cast("decimal(20,0)") * F.col("left").cast("decimal(38,0)"))
              .withColumn("cut_cap", F.sum(F.when(F.col("cut"), F.col("cap")).otherwise(0)).over(everything))
              .withColumn("cut_w", F.sum(F.when(F.col("cut"), F.col("weight")).otherwise(0)).over(everything))
              .withColumn("target", F.when(F.col("cut"), F.col("cap").cast("double")).otherwise(
                  F.col("weight") * (F.col("total") - F.col("cut_cap")).cast("double")
                  / F.greatest(F.col("weights") - F.col("cut_w"), F.lit(1)))))
    quota = F.least(F.floor(F.col("target") + 0.5), F.col("cap")).cast("long")
    return t.select("sid", "source", "source_size", "target", quota.alias("quota"))


def slot_schedule(targets: DataFrame, block_tokens: int, grid: int = 1024) -> DataFrame:
    """(sid, block, slot): the schedule's slot number of each block of a source."""
    spark = targets.sparkSession
    upto = W.orderBy("sid").rowsBetween(W.unboundedPreceding, W.currentRow)
    shares = (targets.withColumn("n", F.ceil(F.col("quota") / block_tokens).cast("long"))
                     .filter("n > 0").withColumn("hi", F.sum("n").over(upto)).select("sid", "n", "hi"))
    slots = targets.agg(F.coalesce(F.sum(F.ceil(F.col("quota") / block_tokens)), F.lit(0)).cast("long")).first()[0]
    shares = shares.select("sid", "n", ((F.col("hi") - F.col("n")) / F.lit(max(slots, 1))).alias("lo"),
                           (F.col("hi") / F.lit(max(slots, 1))).alias("hi"))
    cells = shares.withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("lo") * grid), F.floor(F.col("hi") * grid))))
    points = (spark.range(slots).withColumnRenamed("id", "slot")
                   .withColumn("x", golden_point(F.col("slot")))
                   .withColumn("cell", F.floor(F.col("x") * grid)))
    placed = cut(points.join(cells, "cell").filter("x >= lo AND x < hi")
                       .select("slot", "sid", "n", F.shiftright("slot", 14).alias("chunk")))
    before = W.partitionBy("sid").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    counts = (placed.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("c"))
                    .select("sid", "chunk", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base")))
    within = W.partitionBy("sid", "chunk").orderBy("slot")
    ranked = (placed.withColumn("nth", F.row_number().over(within)).join(counts, ["sid", "chunk"])
                    .withColumn("block", F.col("base") + F.col("nth") - 1)
                    .filter("block < n").select("sid", "block", "slot"))
    given = placed.groupBy("sid").agg(F.count(F.lit(1)).alias("given"))
    closing = (shares.join(given, "sid", "left").withColumn("given", F.coalesce("given", F.lit(0)))
                     .filter("given < n").withColumn("block", F.explode(F.sequence("given", F.col("n") - 1)))
                     .select("sid", "block", (F.lit(slots) + F.col("block")).alias("slot")))
    return ranked.unionByName(closing)


def lay_out(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            seed: str = "0", keep: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, targets).  rows: every row of ``docs`` with its size, its place
    on its source's shuffled line (``start``, and ``bucket`` and ``nth``,
    which name it within the source ``sid``), the source's sizes, and the
    columns named in ``keep`` (prefixed by ``k_``)."""
    keep = keep or []
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                           word_count(F.col(text_col)).alias("size"),
                           *[F.col(c).alias(f"k_{c}") for c in keep])
                   .withColumn("digest", F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(
                       F.col("doc_id").cast("string"), F.lit("")), F.col("size")).cast("binary")))
                   .withColumn("bucket", F.substring("digest", 1, 3)))
    tallies = cut(rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")))
    targets = cut(source_targets(tallies.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))))
    before = W.partitionBy("sid").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    bases = (tallies.join(targets.withColumnRenamed("source", "t_source"), F.col("source").eqNullSafe(F.col("t_source")))
                    .select(F.col("source").alias("t_source"), F.col("bucket").alias("t_bucket"), "sid", "source_size",
                            "target", "quota", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("base")))
    order = W.partitionBy("sid", "bucket").orderBy("digest", "size", "doc_id", *[f"k_{c}" for c in keep])
    lined = (rows.join(bases, F.col("source").eqNullSafe(F.col("t_source")) & (F.col("bucket") == F.col("t_bucket")))
                 .withColumn("nth", F.row_number().over(order))
                 .withColumn("start", F.col("base") + F.sum("size").over(
                     order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("size"))
                 .drop("t_source", "t_bucket", "base", "digest"))
    return cut(lined), targets


def mix_schedule(lined: DataFrame, targets: DataFrame, block_tokens: int = 1024) -> DataFrame:
    """The mix as the schedule orders it: (slot, sid, bucket, nth, doc_id, pass,
    from_word, to_word), the words of a row that a slot takes.  ``lined`` and
    ``targets`` come from ``lay_out``."""
    lo = F.col("start") + F.col("pass") * F.col("source_size")
    hi = F.least(lo + F.col("size"), F.col("quota"))
    first, end = F.col("block") * block_tokens, (F.col("block") + 1) * block_tokens
    pieces = (lined.filter("size > 0").select("sid", "bucket", "nth", "doc_id", "start", "size", "source_size", "quota")
                   .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(MAX_PASSES - 1))))
                   .withColumn("lo", lo).withColumn("hi", hi).filter("lo < hi")
                   .withColumn("block", F.explode(F.sequence(
                       F.floor(F.col("lo") / block_tokens), F.floor((F.col("hi") - 1) / block_tokens))))
                   .select("sid", "bucket", "nth", "doc_id", "pass", "block",
                           (F.greatest("lo", first) - F.col("lo")).alias("from_word"),
                           (F.least("hi", end) - F.col("lo")).alias("to_word")))
    return (pieces.join(slot_schedule(targets, block_tokens), ["sid", "block"])
                  .select("slot", "sid", "bucket", "nth", "doc_id", "pass", "from_word", "to_word"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                block_tokens: int = 1024, seed: str = "0", keep: list[str] | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, first_slot (the first
    slot that takes words of the row; NULL: none does) and slots (that slot
    in each pass) of every row, with the columns named in ``keep`` passed
    through (prefixed by ``k_``)."""
    lined, targets = lay_out(docs, id_col, text_col, source_col, seed, keep)
    key = ["sid", "bucket", "nth"]
    in_pass = [F.min(F.when(F.col("pass") == p, F.col("slot"))) for p in range(MAX_PASSES)]
    taken = (mix_schedule(lined, targets, block_tokens).groupBy(*key)
             .agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"), F.min("slot").alias("first_slot"),
                  F.array(*in_pass).alias("slots")))
    return (lined.join(taken, key, "left")
                 .select("doc_id", "source", "size", "source_size", "target",
                         F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot", "slots",
                         *[f"k_{c}" for c in keep or []]))


def take_documents(docs: DataFrame, block_tokens: int = 1024, seed: str = "0") -> DataFrame:
    """``docs`` as the mix takes them: each row as often as its taken words
    make whole copies (rounded), so rows that the mix leaves out go, in the
    order of the schedule (a copy stands at its pass's first slot).

    Rows equal in all columns are one row with its copies summed, so a row
    that is repeated without end is in no task but once."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key = F.xxhash64(*columns, *[c.isNull() for c in columns])        # NULLs do not enter the hash
    keyed = docs.select(F.struct(*columns).alias("_doc"), key.alias("_row"))
    mixed = mix_sources(keyed.select("_row", *[f"_doc.{c}" for c in ("doc_id", "text", "source")]),
                        block_tokens=block_tokens, seed=seed, keep=["_row"])
    copies = F.floor(F.col("taken") / F.greatest("size", F.lit(1)) + 0.5).cast("int")
    slots = F.array_sort(F.filter("slots", lambda s: s.isNotNull()))
    taken = (mixed.withColumn("copies", copies).filter("copies > 0")
                  .select(F.col("k__row").alias("_row"), F.explode(F.slice(slots, F.lit(1), F.col("copies"))).alias("_slot")))
    once = keyed.groupBy("_row").agg(F.first("_doc").alias("_doc"))
    return once.join(taken, "_row").orderBy("_slot", "_row").select("_doc.*")
