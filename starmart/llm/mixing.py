"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words: its share, by weight, of a budget
that is a multiple of all words, stopped at ``most`` times the source's own
words, the excess going to the others by weight until none is above. A
document's expected number of copies is its source's target over its source's
words. The whole part are certain copies. The rest is an inclusion probability
p, unequal from source to source, and is drawn by Pareto order sampling: with u
the document's uniform number (from a hash of seed, id and text, so reruns agree),
documents are ranked by the odds of u over the odds of p, and the ranking is
cut where the words taken come nearest to the words still missing.

The cut is found without ordering a source in one task: words are summed per
source and slice of the rank, the slice that holds the cut is found in those
sums, and cut into as many slices again; only the documents of one slice of
those, some 17 millionth of a source, are ordered.

A null text has size 0. The null source is one source, the last. Documents of
equal rank (repeated rows) are taken by id, then size. An empty table, or one without words,
gives targets of 0 and nothing taken. A repeated row is a document of its own.
Columns other than id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize

WEIGHTS = (5, 2, 1)
SLICES = 4096


def sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more) -> DataFrame:
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
        F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), *more)


def uniform(id_col: str, text_col: str, seed: str):
    """Column ``u``: a document's number on a grid of 2**52 points inside (0, 1)."""
    name = F.concat_ws(":", F.lit(seed), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    return ((F.conv(F.substring(F.sha2(name, 256), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(2**52)).alias("u")


def targets(sized: DataFrame, weights=WEIGHTS, share: tuple[int, int] = (3, 2), most: int = 2) -> DataFrame:
    """source, source_size, target. The windows run over one row per source."""
    up, down = share
    order = Window.orderBy(F.col("source").asc_nulls_last())
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    src = src.withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    src = src.withColumn("cap", F.col("source_size") * most)
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, every = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    src = src.withColumns({
        "full_before": F.coalesce(F.sum("cap").over(before), F.lit(0)), "weight_before": F.coalesce(F.sum("weight").over(before), F.lit(0)),
        "weights": F.sum("weight").over(every), "budget": F.sum("source_size").over(every) * up})  # budget: times `down`
    # A source is full when its share of what the fuller ones leave exceeds its cap.
    src = src.withColumn("full", F.col("cap") * down * (F.col("weights") - F.col("weight_before")) < (F.col("budget") - F.col("full_before") * down) * F.col("weight"))
    src = src.withColumns({
        "left": F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0)) * down,
        "weights_left": F.col("weights") - F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))).over(every), F.lit(0))})
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise((F.col("left") * F.col("weight")).cast("double") / (F.col("weights_left") * down).cast("double"))
    return src.select("source", "source_size", target.alias("target"))


def _draw(rows: DataFrame, weights, share, most, slices) -> DataFrame:
    """Copies of each of ``rows`` (doc_id, source, size, u, passed)."""
    sized = materialize(rows.select("doc_id", "source", "size", "u"))
    plan = materialize(targets(sized, weights, share, most).withColumn("source_no", F.monotonically_increasing_id()))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # Odds of u over odds of p, mapped to [0, 1]; 1 where p is 0.
    rank = F.col("u") * (1 - F.col("p")) / (F.col("u") * (1 - F.col("p")) + (1 - F.col("u")) * F.col("p"))

    def ranked(table):
        t = table.alias("s").join(plan.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source"))).select("s.*", "source_no", "source_size", "target")
        t = t.withColumn("whole", F.floor(ratio).cast("long")).withColumn("p", ratio - F.col("whole"))
        t = t.withColumn("missing", F.col("target") - F.col("whole") * F.col("source_size")).withColumn("rank", rank)
        return t.withColumn("slice", F.least(F.floor(F.col("rank") * slices**2), F.lit(slices**2 - 1)).cast("long"))

    def cut_of(t, base):
        """Per source, the slice that the missing words end in, and the words before it."""
        sums = t.groupBy("source_no", "slice").agg(F.sum("size").alias("words"), F.first("missing").alias("missing"), F.first(base).alias("base"))
        upto = Window.partitionBy("source_no").orderBy("slice")
        sums = sums.withColumn("upto", F.col("base") + F.sum("words").over(upto))
        found = sums.where(F.col("upto") >= F.col("missing")).groupBy("source_no").agg(F.min(F.struct("slice", (F.col("upto") - F.col("words")).alias("base"))).alias("cut"))
        return materialize(found.select("source_no", F.col("cut.slice").alias("cut"), F.col("cut.base").alias("base")))

    fine = ranked(sized)
    coarse = cut_of(fine.withColumn("slice", F.floor(F.col("slice") / slices)), F.lit(0).cast("long"))
    cut = cut_of(fine.join(coarse, "source_no").where(F.floor(F.col("slice") / slices) == F.col("cut")), F.col("base"))
    rows = ranked(rows).join(cut, "source_no", "left")

    clear = rows.where(F.col("cut").isNull() | (F.col("slice") != F.col("cut"))).withColumn("drawn", F.col("cut").isNull() | (F.col("slice") < F.col("cut")))
    inside = Window.partitionBy("source_no").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = rows.where(F.col("slice") == F.col("cut")).withColumn("at", F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # Taking a document is right when it brings the words nearer to those missing.
    edge = edge.withColumn("drawn", F.col("at") * 2 + F.col("size") <= F.col("missing") * 2).drop("at")
    copies = F.col("whole") + F.when(F.col("drawn") & (F.col("p") > 0), 1).otherwise(0)
    return clear.unionByName(edge).select("doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"), "passed")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
        share: tuple[int, int] = (3, 2), most: int = 2, seed: str = "mix", slices: int = SLICES) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies,
    taken (copies * size). ``share`` is the budget over all words as a fraction."""
    rows = sizes(docs, id_col, text_col, source_col, uniform(id_col, text_col, seed)).withColumn("passed", F.lit(True))
    return _draw(rows, weights, share, most, slices).drop("passed").withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS,
          share: tuple[int, int] = (3, 2), most: int = 2, seed: str = "mix", slices: int = SLICES) -> DataFrame:
    """The mix itself: every row of ``docs``, all columns, as often as it has copies."""
    rows = sizes(docs, id_col, text_col, source_col, uniform(id_col, text_col, seed), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("passed"))
    drawn = _draw(rows, weights, share, most, slices).where("copies > 0")
    return drawn.select(F.explode(F.array_repeat("passed", F.col("copies").cast("int"))).alias("passed")).select(*[F.col("passed")[c].alias(c) for c in docs.columns])


SQL = r"""
WITH d AS (SELECT doc_id, source, text, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s1 AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
s2 AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s1),
s3 AS (SELECT *, sum(weight) OVER () AS weights, sum(source_size) OVER () * 3 AS budget,
  coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
  coalesce(sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_before FROM s2),
s4 AS (SELECT *, 4 * source_size * (weights - weight_before) < (budget - 2 * full_before) * weight AS is_full FROM s3),
s5 AS (SELECT source, source_size, CASE WHEN is_full THEN CAST(2 * source_size AS DOUBLE) ELSE
  CAST((budget - 2 * coalesce(sum(CASE WHEN is_full THEN 2 * source_size END) OVER (), 0)) * weight AS DOUBLE)
  / CAST((weights - coalesce(sum(CASE WHEN is_full THEN weight END) OVER (), 0)) * 2 AS DOUBLE) END AS target FROM s4),
e AS (SELECT d.doc_id, d.source, d.size, CAST(s.source_size AS BIGINT) AS source_size, s.target,
  CASE WHEN s.source_size > 0 THEN s.target / CAST(s.source_size AS DOUBLE) ELSE 0.0 END AS ratio,
  (CAST(CAST('0x' || substr(sha256('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || coalesce(d.text, '')), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0 AS u
  FROM d JOIN s5 s ON d.source IS NOT DISTINCT FROM s.source),
f AS (SELECT *, ratio - floor(ratio) AS p, target - floor(ratio) * source_size AS missing FROM e),
g AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY u * (1 - p) / (u * (1 - p) + (1 - u) * p), doc_id, size
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto FROM f)
SELECT doc_id, source, size, source_size, target,
  CAST(floor(ratio) AS BIGINT) + CASE WHEN p > 0 AND upto * 2 + size <= missing * 2 THEN 1 ELSE 0 END AS copies,
  CAST((CAST(floor(ratio) AS BIGINT) + CASE WHEN p > 0 AND upto * 2 + size <= missing * 2 THEN 1 ELSE 0 END) * size AS BIGINT) AS taken
FROM g"""
