"""Mixing sources to target weights by capped water-filling.

All sources share a budget by weight. Where a share is more than ``max_epochs`` times the source,
it is clamped there and the excess goes to the others by weight, until none is above. A source is
then repeated whole as often as fits, and once more in part: of its rows in the order of a seeded
hash, the first ones that fit into what is missing, and the one that fills the gap best.

A null or empty text has size 0, a null source is a source of its own and comes last. Rows alike in
all key columns have one place in that order and are told apart by numbers they get when written
to a table, so that a part of them can be taken. Without rows there are no sources. If the budget exceeds all caps, every source stands at its cap. Nothing
is drawn at run time: the same rows and seed give the same mix, however they are partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmart.llm.common import as_doc, n_words, text_of
from reviewmart.llm.numbering import numbered
from reviewmart.workspace import cut

_DRAW_BITS = 60
# Bits of a source's hash range whose parts are summed first, then those of the part with the cut;
# only what is left of it is sorted.
_PART_BITS = (12, 24)


def draw_of(doc: Column, key_cols: tuple[str, ...], seed: int) -> Column:
    """60 bits that depend on the seed and the row's key columns only."""
    parts = (F.coalesce(doc[name].cast("string"), F.lit("-")) for name in key_cols)
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, _DRAW_BITS // 4), 16, 10).cast("long")


def weighed(sizes: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """One row per source: its size, and the next of ``weights``, in turn by source name."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(sources, F.col("source").asc_nulls_last(), name="place")
    turn = F.element_at(
        F.array(*(F.lit(float(w)) for w in weights)), (F.pmod("place", F.lit(len(weights))) + 1).cast("int")
    )
    return ranked.select("source", "source_size", turn.alias("weight"))


def water_filled(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """Add ``target``. Each round clamps the sources above their cap and raises the common level;
    only three sums come to the driver."""
    cap, weight = F.col("source_size") * max_epochs, F.col("weight")
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, clamped = 0.0, -1
    while True:
        above = cap < weight * level
        row = sources.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0.0)).alias("spent"),
            F.coalesce(F.sum(F.when(~above, weight)), F.lit(0.0)).alias("free"),
            F.count(F.when(above, True)).alias("clamped"),
        ).first()
        if row["clamped"] == clamped or not row["free"]:
            break
        clamped, level = row["clamped"], (share * total - row["spent"]) / row["free"]
    return sources.withColumn("target", F.least(cap, weight * level))


def _narrowed(sizes: DataFrame, wanted: DataFrame, part_bits: int) -> DataFrame:
    """Per source, the part of its draws in which the running size first reaches what is ``left``,
    and what is left in that part."""
    parts = sizes.groupBy(
        F.col("source").alias("part_source"), F.shiftright("draw", _DRAW_BITS - part_bits).alias("part")
    ).agg(F.sum("size").alias("part_size"))
    running = Window.partitionBy("part_source").orderBy("part")
    through = parts.withColumn("through", F.sum("part_size").over(running))
    before = F.col("through") - F.col("part_size")
    return (
        wanted.select("cut_source", "left")
        .join(through, F.col("cut_source").eqNullSafe(F.col("part_source")))
        .where((F.col("through") >= F.col("left")) & (before < F.col("left")))
        .select("cut_source", "part", (F.col("left") - before).alias("left"))
    )


def _cuts(sizes: DataFrame, sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What the repetition in part takes: per source all draws up to ``last_draw``, and of some
    further draws (``picked``) a number of ``rows``."""
    missing = F.col("target") - F.col("whole") * F.col("source_size")
    split = sources.where(missing > 0).select(F.col("source").alias("cut_source"), missing.alias("left"))
    within, part_bits = sizes, 0
    for part_bits in _PART_BITS:
        split = cut(_narrowed(within, split, part_bits), "mix-split")
        within = sizes.join(
            split,
            F.col("source").eqNullSafe(F.col("cut_source"))
            & (F.shiftright("draw", _DRAW_BITS - part_bits) == F.col("part")),
        )
    in_part = within.withColumn(
        "through", F.sum("size").over(Window.partitionBy("cut_source", "part").orderBy("draw"))
    )
    taken = (
        in_part.where(F.col("through") <= F.col("left"))
        .groupBy("cut_source")
        .agg(F.max("draw").alias("taken_draw"), F.max("through").alias("got"))
        .withColumnRenamed("cut_source", "taken_source")
    )
    before_part = F.shiftleft(F.col("part"), _DRAW_BITS - part_bits) - 1
    cuts = cut(
        split.join(taken, F.col("cut_source").eqNullSafe(F.col("taken_source")), "left").select(
            "cut_source",
            F.coalesce("taken_draw", before_part).alias("last_draw"),
            (F.col("left") - F.coalesce("got", F.lit(0))).alias("gap"),
        ),
        "mix-cuts",
    )
    # Of the rows alike that come next, as many as fit; rows without words change nothing.
    after = sizes.join(cuts, F.col("source").eqNullSafe(F.col("cut_source"))).where(
        (F.col("draw") > F.col("last_draw")) & (F.col("each") > 0)
    )
    following = cut(
        after.groupBy("cut_source")
        .agg(F.min(F.struct("draw", "each", "gap")).alias("next"))
        .select(
            F.col("cut_source").alias("next_source"),
            F.col("next.draw").alias("next_draw"),
            F.floor(F.col("next.gap") / F.col("next.each")).alias("fitting"),
            (F.col("next.gap") - F.floor(F.col("next.gap") / F.col("next.each")) * F.col("next.each")).alias("rest"),
        ),
        "mix-next",
    )
    # One row more if it brings the source nearer.
    off = F.abs(F.col("each") - F.col("rest"))
    nearest = (
        after.join(following, F.col("cut_source").eqNullSafe(F.col("next_source")))
        .where(off < F.col("rest"))
        .groupBy("next_source")
        .agg(F.min(F.struct(off, F.col("draw")))["draw"].alias("draw"))
        .select("next_source", "draw", F.lit(1).cast("long").alias("rows"))
    )
    fitting = following.where("fitting > 0").select(
        "next_source", F.col("next_draw").alias("draw"), F.col("fitting").alias("rows")
    )
    picked = (
        fitting.unionByName(nearest)
        .groupBy(F.col("next_source").alias("picked_source"), F.col("draw").alias("picked_draw"))
        .agg(F.sum("rows").alias("rows"))
    )
    return cuts.select("cut_source", "last_draw"), picked


def _numbered_alike(rows: DataFrame) -> DataFrame:
    """Add ``number``, from 0 without gaps among rows of a source and draw, in the order written."""
    written = cut(rows.withColumn("at", F.monotonically_increasing_id()), "rows-alike")
    # The partition is above 33 bits: one task numbers what another wrote, and no more.
    placed = written.withColumn("task", F.shiftright("at", 33))
    alike = ["source", "draw"]
    own = Window.partitionBy(*alike, "task").orderBy("at")
    counts = placed.groupBy(*alike, "task").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*alike).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(
        F.col("source").alias("begin_source"),
        F.col("draw").alias("begin_draw"),
        F.col("task").alias("begin_task"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"),
    )
    same = (
        F.col("source").eqNullSafe(F.col("begin_source"))
        & (F.col("draw") == F.col("begin_draw"))
        & (F.col("task") == F.col("begin_task"))
    )
    return (
        placed.withColumn("number", F.row_number().over(own) - 1)
        .join(begins, same)
        .withColumn("number", F.col("number") + F.col("begin"))
        .drop("at", "task", "begin_source", "begin_draw", "begin_task", "begin")
    )


def mix(
    docs: DataFrame,
    text_col: str = "text",
    source_col: str = "source",
    key_cols: tuple[str, ...] = ("doc_id", "text"),
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 2024,
) -> DataFrame:
    """``doc``, ``size``, ``source_size``, ``target`` (of the source) and ``copies`` of the row."""
    doc = F.col("doc")
    sized = (
        docs.select(as_doc(docs), n_words(text_of(docs, text_col)).alias("size"))
        .withColumn("draw", draw_of(doc, key_cols, seed))
        .withColumn("source", doc[source_col])
    )
    sizes = cut(
        sized.groupBy("source", "draw").agg(
            F.sum("size").alias("size"), F.max("size").alias("each"), F.count("*").alias("alike")
        ),
        "mix-sizes",
    )
    sources = cut(
        water_filled(weighed(sizes, weights), share, max_epochs).withColumn(
            "whole",
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
            .otherwise(0)
            .cast("int"),
        ),
        "mix-sources",
    )
    cuts, picked = _cuts(sizes, sources)
    cuts = cuts.withColumnRenamed("last_draw", "through_draw")
    plan = cut(
        sources.join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left").select(
            F.col("source").alias("plan_source"), "source_size", "target", "whole", F.col("through_draw").alias("last_draw")
        ),
        "mix-plan",
    )
    of_picked = F.col("source").eqNullSafe(F.col("picked_source")) & (F.col("draw") == F.col("picked_draw"))
    # Two draws of a source at most.
    few = cut(picked.join(sizes.select("source", "draw", "alike"), of_picked).drop("source", "draw"), "mix-picked")
    all_of_them = few.where("rows >= alike").select("picked_source", "picked_draw", F.lit(True).alias("whole_draw"))
    some_of_them = few.where("rows < alike").select("picked_source", "picked_draw", "rows")
    planned = sized.join(plan, F.col("source").eqNullSafe(F.col("plan_source")))
    if not some_of_them.isEmpty():
        among = _numbered_alike(planned.join(some_of_them, of_picked).drop("picked_source", "picked_draw"))
        divided = among.select(
            "doc", "size", "source_size", "target", (F.col("whole") + (F.col("number") < F.col("rows")).cast("int")).alias("copies")
        )
        planned = planned.join(some_of_them, of_picked, "left_anti")
    else:
        divided = None
    once_more = (F.col("draw") <= F.col("last_draw")) | F.col("whole_draw")
    more = F.coalesce(once_more, F.lit(False)).cast("int")
    mixed = planned.join(all_of_them, of_picked, "left").select(
        "doc", "size", "source_size", "target", (F.col("whole") + more).alias("copies")
    )
    return mixed if divided is None else mixed.unionByName(divided)


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is taken."""
    return mixed.select(
        "doc", F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int"))).alias("copy")
    ).select("doc.*")
