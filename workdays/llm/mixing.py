"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source_size`` times. The documents of a
source stand in the order (size, doc_id); the running sum of expected copies plus one offset
drawn per source crosses whole numbers, and a document is emitted once for each whole number
crossed inside its own step. Because sizes ascend, the words taken differ from the target by
less than one document of the source.

Ranks are counted without gathering a source: slim rows are range-partitioned by
(source, size, doc_id), numbered inside their partition, and shifted by the rows that earlier
partitions hold of the source, so a source with a third of all rows spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
CAP = 3
SEED = "mix"


def n_words(text: str = "text") -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _offset(source: Column, seed: str) -> Column:
    """One number in [0, 1) per source, the same in every run."""
    name = F.concat(F.lit(f"{seed}:"), F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source)))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, share: float = 1.0) -> DataFrame:
    """Target words of each source: (source, source_size, target).

    ``sized`` has ``source`` and ``size``. Sources in code-point order (null last) take
    ``weights`` in turn and share ``share`` of all words; no target passes ``cap`` times its
    source, what is above goes to the others by weight. The frame has one row per source, and
    only it is put in one order.
    """
    every = W.partitionBy(F.lit(0))
    t = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = t.withColumn("_i", F.row_number().over(every.orderBy(F.asc_nulls_last("source"))) - 1)
    turns = F.array(*[F.lit(int(w)) for w in weights])
    t = t.withColumn("_w", F.element_at(turns, (F.col("_i") % len(weights) + 1).cast("int")).cast("long"))
    t = t.withColumn("_cap", F.lit(cap) * F.col("source_size"))
    by_level = every.orderBy(F.col("_cap") / F.col("_w"), "_i").rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("source_size").over(every) * F.lit(share) if share != 1.0 else F.sum("source_size").over(every)
    t = t.withColumn("_total", total)
    t = t.withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(by_level), F.lit(0)))
    t = t.withColumn("_open", F.sum("_w").over(every) - F.coalesce(F.sum("_w").over(by_level), F.lit(0)))
    t = t.withColumn("_full", F.col("_left") * F.col("_w") > F.col("_cap") * F.col("_open"))
    rest = F.col("_total") - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0)).over(every)
    level_w = F.sum(F.when(F.col("_full"), 0).otherwise(F.col("_w"))).over(every)
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(
        (F.col("_w") * rest).cast("double") / level_w
    )
    return t.select("source", "source_size", target.alias("target"))


def systematic_copies(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    cap: int = CAP,
    share: float = 1.0,
    seed: str = SEED,
    size: Column | None = None,
) -> DataFrame:
    """How often the mix takes each document.

    ``docs``: doc_id, source, text (other columns are ignored). Returns one row per input row:
    doc_id, source, size, source_size, target, copies. A null source is a source of its own; a
    null text has size 0; repeated rows are drawn one by one; a source without words is taken 0
    times; no table rows give no rows. Runs repeat: the offset comes from ``seed`` and the source.
    """
    size = n_words() if size is None else size
    sized = staged(docs.select("doc_id", "source", size.alias("size")), "mix-sizes")
    at = F.monotonically_increasing_id()
    ordered = sized.repartitionByRange("source", "size", "doc_id").sortWithinPartitions("source", "size", "doc_id")
    ordered = staged(ordered.withColumn("_at", at), "mix-order").withColumn("_part", F.shiftright("_at", 33))
    parts = ordered.groupBy("_part", "source").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(W.partitionBy("source").orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.select("_part", "source", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    targets = source_targets(sized, weights, cap, share)
    # one row per source and partition: the join back meets no key with more rows than a partition
    p, t = parts.alias("p"), targets.alias("t")
    plan = p.join(t, F.col("p.source").eqNullSafe(F.col("t.source"))).select("p.*", "t.source_size", "t.target")
    o, q = ordered.alias("o"), plan.alias("q")
    d = o.join(q, (F.col("o._part") == F.col("q._part")) & F.col("o.source").eqNullSafe(F.col("q.source")))
    rank = F.col("o._at") - F.col("q._first") + F.col("q._before") + 1
    rate = F.when(F.col("q.source_size") > 0, F.col("q.target") / F.col("q.source_size")).otherwise(F.lit(0.0))
    d = d.select(
        "o.doc_id", "o.source", "o.size", "q.source_size", "q.target",
        rank.alias("_rank"), F.floor(rate).alias("_whole"), (rate - F.floor(rate)).alias("_part_copy"),
        _offset(F.col("o.source"), seed).alias("_u"),
    )
    reach = F.floor(F.col("_u") + F.col("_part_copy") * F.col("_rank"))
    behind = F.floor(F.col("_u") + F.col("_part_copy") * (F.col("_rank") - 1))
    copies = (F.col("_whole") + reach - behind).cast("long")
    return d.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed table: each row of ``docs`` as often as ``systematic_copies`` says, same columns.

    Rows that agree in doc_id, source and size are told apart by their place in that group.
    """
    names = docs.columns
    key = ["doc_id", "source", "size"]
    numbered = W.partitionBy(*key)
    chosen = systematic_copies(docs, **options).select(*key, "copies")
    chosen = chosen.withColumn("_k", F.row_number().over(numbered.orderBy("copies")))
    chosen = chosen.where("copies > 0")
    own = docs.select(F.struct(*names).alias("_row"), "doc_id", "source", n_words().alias("size"), "text")
    own = own.withColumn("_k", F.row_number().over(numbered.orderBy("text"))).drop("text")
    a, b = own.alias("a"), chosen.alias("b")
    same = F.lit(True)
    for k in ("doc_id", "source", "size", "_k"):
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    taken = a.join(b, same).select("a._row", F.explode(F.sequence(F.lit(1), F.col("b.copies").cast("int"))).alias("_c"))
    return taken.select(*[F.col("_row").getField(c).alias(c) for c in names])


def op2_mixing(spark, sf_dir: str) -> DataFrame:
    """The contract's digest of the mix of all ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    c = systematic_copies(docs)
    return c.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i
  FROM d GROUP BY source
), c AS (
  SELECT *, 3 * source_size AS cap, (i % 3 + 1)::BIGINT AS w, (sum(source_size) OVER ())::BIGINT AS total FROM s
), l AS (
  SELECT *,
    total - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest_here,
    sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap::DOUBLE / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open
  FROM c
), f AS (
  SELECT *, rest_here * w > cap * open AS capped FROM l
), g AS (
  SELECT source, source_size, capped, cap, w,
    (total - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::BIGINT AS rest,
    (sum(CASE WHEN capped THEN 0 ELSE w END) OVER ())::BIGINT AS open_w
  FROM f
), t AS (
  SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE (w * rest)::DOUBLE / open_w::DOUBLE END AS target,
    ('0x' || substr(md5('mix:' || CASE WHEN source IS NULL THEN '0' ELSE '1' || source END), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM g
), r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.u,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size::DOUBLE ELSE 0.0::DOUBLE END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS rank
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), n AS (
  SELECT doc_id, size, source_size, target,
    (floor(rate) + floor(u + (rate - floor(rate)) * rank::DOUBLE) - floor(u + (rate - floor(rate)) * (rank - 1)::DOUBLE))::BIGINT AS copies
  FROM r
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM n
"""
