"""Thresholds from labelled pairs: precision and recall at every cut."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import store

# The labels of a gold table.
PAIR, NO_PAIR, FAMILY = "par", "sem_par", "familia"


def is_right(label: str = "rotulo", gold: str = "gold_codigo", chosen: str = "top1") -> Column:
    """Whether the first choice of a product that has a pair is that pair."""
    return (F.col(label) == PAIR) & F.coalesce(F.col(gold) == F.col(chosen), F.lit(False))


def outcome(label: str = "rotulo", gold: str = "gold_codigo", chosen: str = "top1") -> Column:
    """`certo`, `outro` (a pair, but another one), `familia` (only a relative exists) or `nenhum`."""
    return F.when(is_right(label, gold, chosen), "certo").when(F.col(label) == PAIR, "outro").when(
        F.col(label) == FAMILY, "familia").otherwise("nenhum")


def calibration_curve(gold: DataFrame, score: str = "score") -> DataFrame:
    """Counts, precision and recall of accepting every pair of at least `limite`, for each score there is.

    `gold` holds rotulo, gold_codigo, top1 and the score. Columns: `limite`, `total`, `certos`, `outros`,
    `familias`, `nenhuns` (accepted rows by outcome), `precisao`, `alcance` (of all rows labelled as a
    pair) and `f1`. Rows without a score are never accepted but count as pairs to be found; an empty
    table gives no rows.

    Scores are added up first, then sorted by ranges; a range needs only the totals of those above it, so
    no task sees more than a range and the driver one row a range.
    """
    kinds = {"certos": "certo", "outros": "outro", "familias": "familia", "nenhuns": "nenhum"}
    pairs = gold.agg(F.count_if(F.col("rotulo") == PAIR)).first()[0]
    levels = gold.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("limite")).agg(
        *[F.count_if(outcome() == kind).alias(name) for name, kind in kinds.items()])
    ranged = store(levels.repartitionByRange(F.desc("limite")).withColumn("faixa", F.spark_partition_id()), "levels")
    sums = sorted(tuple(r) for r in ranged.groupBy("faixa").agg(*map(F.sum, kinds)).collect())
    ahead = [list(accumulate((r[i + 1] for r in sums), initial=0)) for i in range(len(kinds))]
    before = gold.sparkSession.createDataFrame(
        [(r[0], *(a[at] for a in ahead)) for at, r in enumerate(sums)],
        "faixa int, " + ", ".join(f"_{name} long" for name in kinds))
    order = Window.partitionBy("faixa").orderBy(F.desc("limite")).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.join(before, "faixa").select("limite", *[
        (F.col(f"_{name}") + F.sum(name).over(order)).alias(name) for name in kinds])
    total = sum((F.col(name) for name in kinds), F.lit(0))
    precision, recall = F.col("certos") / F.col("total"), F.col("certos") / F.nullif(F.lit(pairs), F.lit(0))
    return summed.withColumn("total", total.cast("long")).select(
        "limite", "total", *kinds, precision.alias("precisao"), recall.alias("alcance"),
        (2 * F.col("certos") / (F.col("total") + F.lit(pairs))).alias("f1"))


def lowest_limit(curve: DataFrame, precision: float) -> DataFrame:
    """The row of the lowest limit from which on precision is at least `precision`; none if there is none."""
    return curve.filter(F.col("precisao") >= precision).orderBy("limite").limit(1)


def best_limit(curve: DataFrame) -> DataFrame:
    """The row with the greatest f1; of equal ones that with the higher limit."""
    return curve.orderBy(F.desc("f1"), F.desc("limite")).limit(1)
