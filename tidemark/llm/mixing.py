"""Mixing sources to target weights by capped water-filling, with DataFrame functions only.

A document's size is its number of words.  Sources share ``share`` times all words by weight; no source gives more
than ``most_epochs`` times its words, and what it cannot give goes to the others by weight until no target is above
its cap.  The limit has a closed form: in order of cap per weight, sources are full as long as their cap is at most
their weight's part of what the full ones before them leave.

Documents are then repeated ``floor(target / words)`` times, and the rest of the target is taken in the seeded order
of a hash: whole documents up to one, of which only the first words are taken.  So every source meets its target to
the word, no document is taken more than ``most_epochs`` times, and a rerun takes the same words.

Where the rest ends is one place per source.  It is found on a table of ids, sizes and hashes, in the one bucket of
about ``BUCKET_ROWS`` documents whose words reach the rest, so no source is ordered as a whole.  Every document is then
compared with the place of its source; texts are neither staged nor shuffled.  Only the table of sources, one row
each, is ordered in one place.

Rows: a null source is a source of its own, the last one; a null text has no words; repeated rows are documents of
their own; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.staging import staged

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_ROWS = 2000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: list[int], most_epochs: int, share: float) -> DataFrame:
    """One row per source: ``key, source_size, documents, target`` from rows ``key, source, size``."""
    sources = sized.groupBy("key", "source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    ranked = sources.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    ).withColumn("cap", F.col("source_size") * most_epochs).withColumn(
        "wanted", F.sum("source_size").over(everything) * F.lit(float(share)))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    filled = (
        ranked.withColumn("at", F.row_number().over(by_fill))
        .withColumn("before", F.coalesce(F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("left", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("wanted") - F.col("before")) / F.col("left"))
    )
    first_open = F.min(F.when(F.col("cap") > F.col("weight") * F.col("level"), F.struct("at", "level"))).over(everything)
    return filled.withColumn("open", first_open).select(
        "key", "source_size", "documents",
        F.when((F.col("at") >= F.col("open.at")), F.col("weight") * F.col("open.level"))
        .otherwise(F.col("cap").cast("double")).alias("target"))


def mix(docs: DataFrame, weights: list[int] = (1, 2, 3), most_epochs: int = 3, share: float = 1.0, seed: int = 42,
        keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document, and the columns named by ``keep``.

    ``taken`` counts the words the mix takes of the document, repeats included.
    """
    keep = [c for c in keep if c != "doc_id"]
    rows = docs.select(
        "doc_id", *keep, F.col("source").alias("_source"),
        F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("none")).alias("_key"),
        word_count(F.col("text")).alias("size"),
        F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(f":{seed}"))).alias("_h"),
        F.xxhash64("text").alias("_text"))
    order = F.struct("_h", "size", "doc_id", "_text")
    sized = staged(rows.select("doc_id", "_key", "_source", "size", "_h", "_text"), "mix-sizes")
    names = {"_source": "source", "_key": "key"}
    targets = source_targets(sized.select("_key", "_source", "size").withColumnsRenamed(names), list(weights),
                             most_epochs, share).withColumnRenamed("key", "_key")
    planned = staged(targets.withColumn(
        "_whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("_rest", F.round(F.col("target") - F.col("_whole") * F.col("source_size")).cast("long")).withColumn(
        "_buckets", F.ceil(F.col("documents") / BUCKET_ROWS)), "mix-targets")

    placed = sized.join(planned.select("_key", "_rest", "_buckets"), "_key").withColumn(
        "_bucket", F.floor(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long") * F.col("_buckets") / F.lit(1 << 32)))
    by_bucket = Window.partitionBy("_key").orderBy("_bucket")
    reached = placed.groupBy("_key", "_bucket").agg(F.sum("size").alias("_words"), F.first("_rest").alias("_rest")).withColumn(
        "_offset", F.sum("_words").over(by_bucket) - F.col("_words")).filter(
        "_offset < _rest and _rest <= _offset + _words").select("_key", "_bucket", "_offset")
    # Documents that are equal in all of the order stand in one place; their words count together.
    in_bucket = Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    ends = staged(
        placed.join(reached, ["_key", "_bucket"]).groupBy("_key", "_offset", "_rest", order.alias("_at")).agg(
            F.count(F.lit(1)).alias("_ties"))
        .withColumn("_left", F.col("_rest") - F.col("_offset") - F.sum(F.col("_at.size") * F.col("_ties")).over(in_bucket)
                    + F.col("_at.size") * F.col("_ties"))
        .filter((F.col("_left") > 0) & (F.col("_left") <= F.col("_at.size") * F.col("_ties")))
        .select("_key", "_at", "_ties", "_left"), "mix-ends")

    if keep:
        sized = rows
    columns = ["doc_id", *keep, "size", "source_size", "target"]
    # Written out, the table's real size decides how it is joined; that of a join would be estimated far too large.
    places = staged(planned.select("_key", "source_size", "target", "_whole", "_rest").join(ends, "_key", "left"), "mix-places")
    joined = sized.join(places, "_key").withColumn("_place", order)
    tied = (F.col("_ties") > 1) & (F.col("_place") == F.col("_at"))
    part = (
        F.when(F.col("_at").isNull(), F.when(F.col("_rest") > 0, F.col("size")).otherwise(0))
        .when(F.col("_place") < F.col("_at"), F.col("size"))
        .when(F.col("_place") == F.col("_at"), F.col("_left")).otherwise(0))
    if ends.filter("_ties > 1").isEmpty():
        return joined.select(*columns, (F.col("_whole") * F.col("size") + part).cast("long").alias("taken"))
    once = joined.filter(~F.coalesce(tied, F.lit(False))).withColumn("_part", part).select(*columns, "_whole", "_part")
    return once.unionByName(_dealt(joined.filter(tied), columns)).select(
        *columns, (F.col("_whole") * F.col("size") + F.col("_part")).cast("long").alias("taken"))


def _dealt(tied: DataFrame, columns: list[str]) -> DataFrame:
    """The words ``_left`` of a place dealt out to its documents, one after the other.

    Equal documents are counted before they are numbered, so any number of them is one row until then.
    """
    earlier = Window.partitionBy("_key").orderBy(F.xxhash64(*columns)).rowsBetween(Window.unboundedPreceding, 0)
    counted = tied.groupBy(*columns, "_key", "_whole", "_left").agg(F.count(F.lit(1)).alias("_copies")).withColumn(
        "_before", F.sum("_copies").over(earlier) - F.col("_copies"))
    step = 1 << 16
    numbered = counted.withColumn("_block", F.explode(F.expr(f"sequence(0L, (_copies - 1) div {step})"))).withColumn(
        "_number", F.explode(F.expr(f"sequence(_block * {step}, least(_copies, (_block + 1) * {step}) - 1)")))
    return numbered.select(*columns, "_whole", F.greatest(F.lit(0), F.least(
        "size", F.col("_left") - (F.col("_before") + F.col("_number")) * F.col("size"))).alias("_part"))


# The same mix with one window per source, for weights 1, 2, 3, three epochs and seed 42.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':42') AS h
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, source_size * 3 AS cap,
         CAST(sum(source_size) OVER () AS DOUBLE) AS wanted
  FROM sources),
filled AS (
  SELECT *, row_number() OVER o AS place,
         (wanted - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
opened AS (
  SELECT *, min(CASE WHEN cap > weight * level THEN place END) OVER () AS open_at FROM filled),
targets AS (
  SELECT source, source_size,
         CASE WHEN place >= open_at
              THEN weight * max(CASE WHEN place = open_at THEN level END) OVER ()
              ELSE CAST(cap AS DOUBLE) END AS target
  FROM opened),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM targets)
SELECT d.doc_id, d.size, p.source_size, p.target,
       CAST(p.whole * d.size + greatest(0, least(d.size, CAST(round(p.target - p.whole * p.source_size) AS BIGINT)
            - (sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.size, d.doc_id
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size))) AS BIGINT) AS taken
FROM sized d JOIN planned p ON d.source IS NOT DISTINCT FROM p.source
"""
