"""Mixing sources to target weights by weighted sampling without replacement.

Every row gets the key -ln(u) / w of Efraimidis and Spirakis: u a uniform number fixed by the
row's id, w its quality weight; smaller keys come first. A source's target is met by whole
passes over it first, then by the rows at the head of the key order whose sizes add up to
what is left. DataFrame functions only.

The prefix sums of a source are taken in `SLICES` slices of the key range: the slices' sums
are added up first, then each slice by itself. So no source, however large, meets in one
task, and the smallest size of work is the same at every size of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, stored, whole_row

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SLICES = 4096
# Weight of a row by its label of quality: 1, 0, none.
GOOD, BAD, UNKNOWN = 2.0, 0.5, 1.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_hash() -> Column:
    """Hash of a row's id, source and text, nulls told from values."""
    columns = [x for c in ("doc_id", "source", "text") for x in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(*columns)


def exponential_key(doc_id: Column, weight: Column, seed: int) -> Column:
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)
    return -F.log(uniform) / weight


def source_targets(sized: DataFrame, weights=WEIGHTS, share=SHARE, most=MOST) -> DataFrame:
    """source, source_size, target. `sized`: source, size.

    The sources by code point, null last, have the weights in turn. Together they get `share`
    of all sizes, each in proportion to its weight, but `most` times its size at the most;
    what is over goes to the others by weight. That is a level common to all sources that are
    not full: the sources that fill up first are found in the order of bound over weight.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), turn + 1)
    sources = sources.withColumn("weight", weight).withColumn("bound", most * F.col("source_size"))
    filling = Window.orderBy(F.col("bound") / F.col("weight"), F.asc_nulls_last("source"))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    rest = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    sources = sources.withColumns(
        {
            "level": (
                share * F.sum("source_size").over(every)
                - F.coalesce(F.sum("bound").over(before), F.lit(0))
            )
            / F.sum("weight").over(rest),
        }
    )
    open_level = F.when(F.col("level") * F.col("weight") < F.col("bound"), F.col("level"))
    sources = sources.withColumn("common", F.max(open_level).over(every))
    bound = F.col("bound").cast("double")
    target = F.least(bound, F.coalesce(F.col("common") * F.col("weight"), bound))
    return sources.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, labels: DataFrame | None = None, seed: int = 0, weights=WEIGHTS,
        share: float = SHARE, most: int = MOST) -> DataFrame:
    """doc_id, source, row_hash, size, source_size, target, taken of every row of `docs` (doc_id,
    text, source).

    size counts words (null text: 0), taken the words the mix takes of the row, repeats
    counted: size times the whole passes, plus size if the row is at the head. The row at
    which the budget runs out is taken if that brings the sum nearer to the target. Labels
    (doc_id, quality) set the quality weight; an id with several labels has the best one.
    Reruns agree: keys depend on the id and `seed` alone, ties go by id and size, equal rows
    are alike. Rows of size 0 are taken 0 times; an empty table gives no rows.
    """
    sized = docs.select(
        "doc_id",
        "source",
        row_hash().alias("row_hash"),
        word_count(F.col("text")).alias("size"),
    )
    weight = F.lit(UNKNOWN)
    if labels is not None:
        best = labels.groupBy("doc_id").agg(F.max("quality").alias("quality"))
        sized = sized.join(best, "doc_id", "left")
        weight = F.when(F.col("quality") >= 1, GOOD).when(F.col("quality") == 0, BAD)
        weight = weight.otherwise(UNKNOWN)
    key = exponential_key(F.col("doc_id"), weight, seed)
    sized = sized.select("doc_id", "source", "row_hash", "size", key.alias("key"))
    slice_ = F.least(F.floor((1 - F.exp(-F.col("key"))) * SLICES), F.lit(SLICES - 1)).cast("int")
    sized = stored(sized.withColumn("slice", slice_), "sized")

    targets = source_targets(sized, weights, share, most)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    targets = targets.withColumn("passes", F.coalesce(passes, F.lit(0)).cast("long"))
    left = F.col("target") - F.col("passes") * F.col("source_size")
    targets = targets.withColumn("left", left)
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = sized.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    start = F.coalesce(F.sum("slice_size").over(earlier), F.lit(0))
    slices = slices.withColumn("start", start).alias("s")
    slices = slices.join(
        targets.alias("t"),
        F.col("s.source").eqNullSafe(F.col("t.source")),
    ).select("s.source", "s.slice", "s.start", "t.source_size", "t.target", "t.passes", "t.left")
    rows = sized.alias("d").join(
        slices.alias("s"),
        F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.slice") == F.col("s.slice")),
    )
    rows = rows.select("d.*", "s.start", "s.source_size", "s.target", "s.passes", "s.left")
    upto = (
        Window.partitionBy("source", "slice")
        .orderBy("key", "doc_id", "size", "row_hash")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    end = F.col("start") + F.sum("size").over(upto)
    rows = rows.withColumn("end", end)
    head = (F.col("size") > 0) & (2 * F.col("end") - F.col("size") <= 2 * F.col("left"))
    taken = F.col("size") * (F.col("passes") + F.when(head, 1).otherwise(0))
    return rows.select(
        "doc_id", "source", "row_hash", "size", "source_size", "target", taken.alias("taken")
    )


ORACLE = r"""
WITH best AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
sized AS (
  SELECT d.doc_id, d.source,
    CAST(coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    -ln((CAST(('0x' || substr(md5('0:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT)
         + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
      / (CASE WHEN b.quality >= 1 THEN 2.0::DOUBLE WHEN b.quality = 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END) AS k
  FROM documents d LEFT JOIN best b USING (doc_id)),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 2 * source_size AS bound,
    (1.5::DOUBLE * (SELECT sum(source_size) FROM sources)
      - coalesce(sum(2 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
     / sum(w) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
  WINDOW f AS (ORDER BY 2 * source_size / w::DOUBLE, source ASC NULLS LAST)),
targets AS (
  SELECT source, source_size,
    least(bound::DOUBLE, coalesce((SELECT max(level) FROM levels WHERE level * w < bound) * w,
                                  bound::DOUBLE)) AS target
  FROM levels),
summed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END::BIGINT AS passes,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * (passes + CASE WHEN size > 0 AND 2 * upto - size <= 2 * (target - passes * source_size)
                         THEN 1 ELSE 0 END))::BIGINT AS taken
FROM summed
"""


def repeat_taken(docs: DataFrame, labels: DataFrame | None = None, seed: int = 0) -> DataFrame:
    """The rows of `docs` as often as the mix takes them: not at all, once or twice. Equal
    rows share what is taken of them in turn. Rows without words are not in the mix."""
    mixed = mix(docs.select("doc_id", "text", "source"), labels, seed)
    taken = mixed.where("size > 0").groupBy("row_hash").agg(
        F.sum(F.expr("taken div size")).alias("copies"), F.count("*").alias("equal")
    )
    held = docs.select(whole_row(docs), row_hash().alias("row_hash"))
    # One exchange of the rows serves the join and the numbering of equal ones.
    joined = held.join(taken.where("copies > 0"), "row_hash")
    number = F.row_number().over(Window.partitionBy("row_hash").orderBy("copies"))
    joined = joined.withColumn("k", number)
    times = F.expr("copies div equal + if(k <= copies % equal, 1, 0)").cast("int")
    repeated = joined.withColumn("copy", F.explode(F.array_repeat(F.lit(1), times)))
    return repeated.select("row.*")
