"""Mixing sources to target weights by weighted sampling without replacement, with built-in functions only.

Sources share `factor` times the size of all documents by weight; a target stops at `most` times its
source's size and what is above is shared again by weight. A source is first taken whole as often as
its target allows; the rest of the target is filled by the documents with the largest keys
u ** (1 / quality), u uniform from the document id (the exponential keys -ln(u) / quality in reverse).

Keys fall into narrow ranges, some thousands of documents each. Sums per range locate the one range in
which a source's rest runs out, and only there documents are ordered, so no task holds a source.

Null text has size 0: such a document comes with the whole epochs of its source. Null sources are one source, the last.
Rows that repeat id, size and text are one group; where the rest runs out inside it, so many of its
rows are taken as come nearest to it. An empty table, or one without words, takes nothing. Further columns are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.shared import stored
from kinfold.plans.sizing import fits

WORD = "[^\\x20\\x09-\\x0D]+"
#: Digits and symbols whose share lowers the quality of a text.
NOISE = "0123456789#*$%&|<>!"
#: Documents in a range of keys, about.
RANGE_ROWS = 4096
#: Smallest quality, so that no key vanishes.
LEAST_QUALITY = 0.05


def quality_of(text: Column) -> Column:
    """Share of characters that are neither digits nor symbols, to the fourth power."""
    clean = F.length(F.translate(text, NOISE, "")) / F.greatest(F.length(text), F.lit(1))
    return F.coalesce(F.pow(clean, F.lit(4.0)), F.lit(1.0))


def _known(quality: str) -> Column:
    """A quality column; what is null or not a number counts as the least."""
    value = F.col(f"`{quality}`").cast("double")
    return F.when(F.isnan(value) | value.isNull(), F.lit(LEAST_QUALITY)).otherwise(value)


def drawn(*, id: str, text: str, source: str, quality: str | None, seed: int) -> dict[str, Column]:
    """Size, source, key and tie-break of a document as columns."""
    words, key_of = F.col(f"`{text}`"), F.coalesce(F.col(f"`{id}`").cast("string"), F.lit(""))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), key_of)), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    weight = F.greatest(F.least(quality_of(words) if quality is None else _known(quality), F.lit(1.0)), F.lit(LEAST_QUALITY))
    return {
        "_size": F.coalesce(F.regexp_count(words, F.lit(WORD)), F.lit(0)).cast("bigint"),
        "_source": F.col(f"`{source}`").cast("string"),
        "_key": F.pow(uniform, F.lit(1.0) / weight),
        "_tie": F.xxhash64(words),
    }


def targets(sizes: DataFrame, *, weights: Sequence[float], factor: float, most: float) -> DataFrame:
    """Per source: _source, _rows, _source_size, _target. One row per source goes through one task."""
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("w", F.element_at(cycle, (F.row_number().over(by_name) - 1) % len(weights) + 1))
    rows = rows.withColumn("cap", most * F.col("_source_size")).withColumn("full_at", F.col("cap") / F.col("w"))
    # In order of the level at which a source is full: the common level if all before it are full.
    order = Window.orderBy("full_at", F.col("_source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = Window.partitionBy()
    level = (factor * F.sum("_source_size").over(total) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum(
        "w"
    ).over(after)
    rows = rows.withColumn("level", level)
    first_open = F.min(F.when(F.col("full_at") >= F.col("level"), F.struct("full_at", "_source", "level"))).over(total)
    rows = rows.withColumn("common", first_open["level"])
    return rows.select(
        "_source",
        "_rows",
        "_source_size",
        F.least(F.col("cap"), F.coalesce(F.col("common") * F.col("w"), F.col("cap"))).alias("_target"),
    )


def _joined(rows: DataFrame, few: DataFrame) -> DataFrame:
    """Rows with the columns of their source; the sources travel only if they are known to be small."""
    few = few.withColumnRenamed("_source", "_of")
    few = F.broadcast(few) if fits(few) else few
    return rows.join(few, F.col("_source").eqNullSafe(F.col("_of")), "left").drop("_of")


def _range() -> Column:
    """The range of keys that a document falls in, largest keys first."""
    return F.floor((1 - F.col("_key")) * F.ceil(F.col("_rows") / RANGE_ROWS)).alias("_range")


def cuts(thin: DataFrame, *, weights: Sequence[float], factor: float, most: float) -> DataFrame:
    """Per source, what decides: whole epochs, and the last document (by key, size, tie) of the fraction."""
    sizes = thin.groupBy("_source").agg(F.count(F.lit(1)).alias("_rows"), F.sum("_size").alias("_source_size"))
    goals = targets(sizes, weights=weights, factor=factor, most=most)
    epochs = F.when(F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size"))).otherwise(0)
    goals = goals.withColumn("_epochs", epochs.cast("bigint"))
    goals = goals.withColumn("_rest", F.col("_target") - F.col("_epochs") * F.col("_source_size"))
    goals = stored(goals, "mix-goals")
    ranged = _joined(thin, goals).withColumn("_range", _range())
    sums = ranged.groupBy("_source", "_range", "_rest").agg(F.sum("_size").alias("_in"))
    before = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_in").over(before), F.lit(0)))
    # The range in which the running size passes the rest; there is none if the rest is never passed.
    last = sums.filter((F.col("_before") <= F.col("_rest")) & (F.col("_before") + F.col("_in") > F.col("_rest")))
    last = stored(last.select("_source", F.col("_range").alias("_last"), "_before"), "mix-ranges")
    inside = _joined(ranged, last).filter(F.col("_range") == F.col("_last"))
    # Equal documents are one row with a count; of the group that the rest runs out in, some are taken.
    groups = inside.filter("_size > 0").groupBy("_source", "_key", "_size", "_tie", "_rest", "_before")
    groups = groups.agg(F.count(F.lit(1)).alias("_equal"))
    order = Window.partitionBy("_source").orderBy(F.desc("_key"), "_size", "_tie")
    passed = F.sum(F.col("_size") * F.col("_equal")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    left = (F.col("_rest") - F.col("_before") - F.coalesce(passed, F.lit(0))) / F.col("_size")
    # The last one is taken if that ends nearer to the rest.
    some = F.least(F.greatest(F.ceil(left + 0.5) - 1, F.lit(0)), F.col("_equal")).cast("bigint")
    chosen = groups.withColumn("_some", some).filter("_some > 0")
    last_group = F.max(F.struct(F.struct(-F.col("_key"), F.col("_size"), F.col("_tie")).alias("cut"), "_some", "_equal"))
    cut = chosen.groupBy("_source").agg(last_group.alias("g")).select("_source", F.col("g.cut").alias("_cut"), "g._some", "g._equal")
    return _joined(_joined(goals, last), stored(cut, "mix-cuts"))


def _place() -> Column:
    return F.struct(-F.col("_key"), F.col("_size"), F.col("_tie"))


def _parted() -> Column:
    """Whether a document belongs to a group of equal ones of which only some are taken."""
    here = (_range() == F.col("_last")) & (F.col("_some") < F.col("_equal")) & (F.col("_size") > 0)
    return F.coalesce(here & (_place() == F.col("_cut")), F.lit(False))


def times_taken() -> Column:
    """How often a document is taken, given the columns of :func:`drawn` and :func:`cuts`, and _chosen for those of a parted group."""
    inside = F.coalesce(_place() <= F.col("_cut"), F.lit(False))
    some = F.when(F.col("_last").isNull(), F.col("_rest") > 0).otherwise(
        (_range() < F.col("_last")) | ((_range() == F.col("_last")) & inside & F.col("_chosen"))
    )
    return F.col("_epochs") + F.when(F.col("_size") > 0, some.cast("bigint")).otherwise(0)


def _with_choice(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """`rows` with _chosen: true but for the rows of a parted group beyond those it gives.

    Equal rows are told apart by where they are stored. They are numbered file by file, so no task holds the
    group, and counts per file say where each file's numbers begin.
    """
    rows = _joined(rows, per_source)
    if not per_source.filter("_some < _equal").limit(1).count():
        return rows.withColumn("_chosen", F.lit(True))
    parted = stored(rows.filter(_parted()), "mix-equal")
    parted = parted.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = parted.groupBy("_source", "_file").agg(F.count(F.lit(1)).alias("_in_file"))
    files = Window.partitionBy("_source").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_first", F.coalesce(F.sum("_in_file").over(files), F.lit(0)))
    counts = counts.select(F.col("_source").alias("_of"), F.col("_file").alias("_from"), "_first")
    counts = F.broadcast(counts) if fits(counts) else counts
    own = parted.withColumn("_number", F.row_number().over(Window.partitionBy("_source", "_file").orderBy("_row")))
    own = own.join(counts, F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_file") == F.col("_from")))
    own = own.withColumn("_chosen", F.col("_first") + F.col("_number") <= F.col("_some"))
    others = rows.filter(~_parted()).withColumn("_chosen", F.lit(True))
    return others.unionByName(own.select(*others.columns))


def mix(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = (5, 2, 1),
    factor: float = 1.5,
    most: float = 2.0,
    quality: str | None = None,
    seed: int = 7,
) -> tuple[DataFrame, DataFrame]:
    """Two frames: the documents as often as the mix takes them, and the decision on each document.

    `quality` names a column to weigh documents by, in place of :func:`quality_of` the text. The second
    frame has the id, size, source_size, target, and taken (words that the mix takes).
    """
    names = docs.columns
    numbered = docs.toDF(*[f"c{i}" for i in range(len(names))])
    at = {n: f"c{i}" for i, n in enumerate(names)}
    columns = drawn(id=at[id], text=at[text], source=at[source], quality=quality and at[quality], seed=seed)
    thin = stored(numbered.select(F.col(at[id]).alias("_id"), *[c.alias(n) for n, c in columns.items()]), "mix")
    per_source = stored(cuts(thin, weights=weights, factor=factor, most=most), "mix-sources")
    decided = _with_choice(thin, per_source).select(
        F.col("_id").alias(id),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * times_taken()).alias("taken"),
    )
    mixed = _with_choice(numbered.withColumns(columns), per_source).withColumn("_times", times_taken()).filter("_times > 0")
    mixed = mixed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_times"))))
    return mixed.select(*[F.col(at[n]).alias(n) for n in names]), decided


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    pow((('0x' || substr(md5('7|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0,
        1.0 / greatest(least(coalesce(pow(length(translate(text, '0123456789#*$%&|<>!', '')) / greatest(length(text), 1)::DOUBLE, 4.0), 1.0), 1.0), 0.05)) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
        [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS w
      FROM d GROUP BY source),
l AS (SELECT *, 2.0 * source_size / w AS full_at,
        (1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
        / sum(w) OVER (ORDER BY 2.0 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
      FROM s),
t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size,
        coalesce((SELECT arg_min(lev, full_at) FROM l WHERE full_at >= lev) * w, 2.0::DOUBLE * source_size))::DOUBLE AS target FROM l),
g AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM t),
r AS (SELECT d.doc_id, d.size, g.source_size, g.target, g.epochs, g.target - g.epochs * g.source_size AS rest,
        sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k DESC, d.size ROWS UNBOUNDED PRECEDING) AS run
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
  (size * (epochs + CASE WHEN size > 0 AND rest > 0 AND (run <= rest OR run - rest < rest - (run - size)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r"""
