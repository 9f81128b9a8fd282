"""Mixing sources to token targets by entropy balancing.

Every document has a rate: the times its tokens enter the mix. Among all
rates that give each source its target, entropy balancing takes those of
least Kullback-Leibler distance from the documents' prior weights, counted
per token. They are exponentially tilted: rate = weight * exp(lambda), one
lambda per source, held at ``cap``. The dual is convex and smooth below the
cap; Newton steps solve it. A step needs, per source, the tokens taken and
the tokens below the cap: sums that Spark takes over (source, weight)
cells, which are gathered once from the documents with map-side partials.

Rates become copies: whole copies first, then one more copy for documents
in the order of a hash of their id until the source's words reach its
target, the last one cut to length. The hash space is cut into bins, and
only documents of the bin in which a source reaches its target are ranked.

DataFrame functions only.

Defined results: null or empty text has size 0 and takes nothing; a null
source is a source of its own, the last; without any words all targets are
0; rows of one id are mixed one by one, equal rows in any order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantlens.llm.common import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BINS = 1 << 14
STEPS = 40
WORD = r"[^\x20\x09-\x0D]+"


def sized(documents: DataFrame, id_col: str, text_col: str, source_col: str, weight_col: str | None) -> DataFrame:
    """doc_id, source, size, weight, and the place u of each document in its
    source's order."""
    doc_id = F.col(id_col).cast("bigint")
    weight = F.coalesce(F.col(weight_col).cast("double"), F.lit(0.0)) if weight_col else F.lit(1.0)
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return documents.select(
        doc_id.alias("doc_id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.greatest(weight, F.lit(0.0)).alias("weight"),
        F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint").alias("u"),
    )


def targets(cells: DataFrame, share: float, cap: int, weights: tuple[int, ...]) -> DataFrame:
    """Per source: source_size, target. The level is the share per unit of
    weight at which the sources under their limit take what the others
    leave; it is found by running sums over the sources, one row each."""
    ordered = cells.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = ordered.withColumn("rank", F.row_number().over(by_name) - 1)
    choice = F.array(*(F.lit(w) for w in weights))
    ranked = ranked.withColumn("w", F.element_at(choice, (F.col("rank") % len(weights) + 1).cast("int")))
    by_limit = Window.orderBy((F.col("source_size") / F.col("w")).asc(), F.col("rank"))
    whole = Window.partitionBy()
    so_far = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    # Level if exactly the sources before this one stopped at their limit.
    left = F.sum("source_size").over(whole) * share - cap * F.coalesce(F.sum("source_size").over(so_far), F.lit(0))
    rest = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(so_far), F.lit(0))
    # It rises while the sources before stop rightly and falls afterwards.
    level = F.max("level").over(whole)
    limit = (cap * F.col("source_size")).cast("double")
    return ranked.withColumn("level", left / rest).select(
        "source", "source_size",
        F.least(limit, F.coalesce(F.col("w") * level, limit)).alias("target"),
    )


def tilts(cells: DataFrame, wanted: DataFrame, cap: int, steps: int = STEPS) -> DataFrame:
    """Per source the dual variable lambda, by Newton's method on all
    sources at once. ``cells`` holds the tokens of each (source, weight).
    The signs of earlier gaps bracket lambda; a step that would leave the
    bracket, as one from beyond the cap does, is replaced by its middle."""
    unknown = F.lit(None).cast("double")
    state = wanted.select(
        "source", "target", F.when(F.col("target") > 0, 0.0).alias("lambda"),
        unknown.alias("low"), unknown.alias("high"), F.lit(True).alias("open"),
    )
    for _ in range(steps):
        rate = F.col("weight") * F.exp("lambda")
        sums = _with(cells, state).groupBy(*state.columns).agg(
            F.sum(F.col("size") * F.least(rate, F.lit(float(cap)))).alias("taken"),
            F.sum(F.when(rate < cap, F.col("size") * rate)).alias("slope"),
        )
        gap = F.col("taken") - F.col("target")
        sums = sums.withColumn("low", F.when(gap < 0, F.col("lambda")).otherwise(F.col("low")))
        sums = sums.withColumn("high", F.when(gap > 0, F.col("lambda")).otherwise(F.col("high")))
        newton = F.col("lambda") - F.try_divide(gap, F.col("slope"))
        newton = F.when(F.abs(newton - F.col("lambda")) <= 4, newton)
        inside = F.coalesce(newton > F.col("low"), newton.isNotNull()) & F.coalesce(newton < F.col("high"), F.lit(True))
        middle = F.coalesce((F.col("low") + F.col("high")) / 2, F.col("low") + 1, F.col("high") - 1)
        moving = F.abs(gap) > 1e-10 * F.col("target")
        state = written(
            sums.select(
                "source", "target",
                F.when(moving, F.when(inside, newton).otherwise(middle)).otherwise(F.col("lambda")).alias("lambda"),
                "low", "high", F.coalesce(moving, F.lit(False)).alias("open"),
            ),
            "mix-tilts",
        )
        if state.where("open").isEmpty():
            break
    return state.select("source", "lambda")


def mix(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weight_col: str | None = None, share: float = SHARE, cap: int = CAP,
    weights: tuple[int, ...] = WEIGHTS, bins: int = BINS,
) -> DataFrame:
    """Per document: doc_id, size, source_size, target, rate, taken (words
    that the mix takes, repeats counted)."""
    docs = written(sized(documents, id_col, text_col, source_col, weight_col), "mix-sizes")
    cells = docs.groupBy("source", "weight").agg(F.sum("size").alias("size"))
    wanted = written(targets(cells, share, cap, weights), "mix-targets")
    balanced = tilts(cells, wanted, cap)
    plan = _with(wanted, balanced)
    rate = F.least(F.lit(float(cap)), F.col("weight") * F.exp("lambda"))
    rated = _with(docs, plan).withColumn("rate", F.coalesce(rate, F.lit(0.0)))
    rated = rated.withColumn("whole", F.floor("rate").cast("bigint"))
    # Documents follow each other by u / part: the larger the part of a
    # copy that a document is due, the earlier it comes.
    part = F.col("rate") - F.col("whole")
    rated = rated.withColumn("place", F.when(part > 0, F.col("u") / part))
    middle = F.col("place") / (F.col("place") + 2.0**32)
    rated = rated.withColumn("bin", F.when(part > 0, F.floor(middle * bins)).otherwise(bins))
    return _copies(rated)


def _copies(rated: DataFrame) -> DataFrame:
    """Whole copies, and one more for the first documents of each source."""
    binned = rated.groupBy("source", "bin", "target").agg(
        F.sum(F.col("size") * F.col("whole")).alias("sure"),
        F.sum(F.when(F.col("place").isNotNull(), F.col("size")).otherwise(0)).alias("more"),
    )
    source = Window.partitionBy("source")
    before = F.coalesce(F.sum("more").over(source.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    need = F.floor(F.col("target") + 0.5) - F.sum("sure").over(source)
    edges = (
        binned.select("source", "bin", "more", before.alias("before"), need.alias("need"))
        .where("before < need and need <= before + more or bin = 0 and need <= 0")
        .groupBy("source")
        .agg(*(F.min_by(c, "bin").alias(a) for c, a in (("bin", "edge"), ("before", "before"), ("need", "need"))))
    )
    placed = _with(rated, edges)
    below = placed.where("edge is null or bin <> edge or place is null").withColumn(
        "extra", F.when(F.col("place").isNotNull() & (F.col("need") > 0) & (F.col("bin") < F.col("edge")), F.col("size"))
        .otherwise(0),
    )
    order = source.orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    edge = placed.where("bin = edge and place is not null").withColumn(
        "extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("need") - ahead))
    )
    every = below.unionByName(edge)
    taken = (F.col("whole") * F.col("size") + F.col("extra")).cast("bigint")
    return every.select("doc_id", "size", "source_size", "target", "rate", taken.alias("taken"))


def _with(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with the columns that ``sources`` has for their source."""
    named = sources.withColumnRenamed("source", "_source")
    return rows.join(named, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
