"""Order-dependent operators: ranks, cumulative sequences and their repair.

Windows are partitioned, and where a group can be large the rows are first reduced to one per
score of a bounded scale. Steps that depend on the previous *repaired* row are folds over the
sorted rows of one block (``F.aggregate``), so they stay in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.rules import all_of, any_of, first_match
from plumbline.session import cut_lineage

# fixed values: the score scale
LOWEST_SCORE, HIGHEST_SCORE = 0, 750
COMPLETE = ("parsed", "inferred_score", "inferred_row")


def on_scale(score: Column) -> Column:
    return score.between(LOWEST_SCORE, HIGHEST_SCORE)


def is_complete() -> Column:
    filled = F.col("score").isNotNull() & F.col("score_count").isNotNull() & F.col("cumulative_rank").isNotNull()
    return F.col("parse_status").isin(*COMPLETE) & filled


def global_row_number(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Rank over the whole table without one global partition.

    Rows are range-partitioned by the sort; each then knows its place in its partition, and the
    partition sizes (one row per partition) give the offset. The sorted rows are written once,
    because partition boundaries are sampled and must not differ between the two uses.
    """
    placed = cut_lineage(df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id()))
    part = F.shiftright("_pos", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    place = F.col("_pos").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.withColumn(name, F.col("_before") + place + 1).drop("_pos", "_part", "_before")


def in_stretches(df: DataFrame, group: Sequence[str], by: str) -> DataFrame:
    """df in order of group and by, with ``_stretch``: the number of the range that a row lies in.

    A group of any size is cut into ranges, so that windows over a group's rows in a stretch hold a task's share of the rows. The
    sorted rows are written once, because the ranges are sampled and must be the same for every use.
    """
    return cut_lineage(df.orderBy(*group, by).withColumn("_stretch", F.spark_partition_id()))


def carried(df: DataFrame, group: Sequence[str], by: str, value: Column, name: str, backward: bool = False) -> DataFrame:
    """df (as from in_stretches) with the last non-null value of the rows before each row of its group; backward: of those after.

    Inside a stretch a running window tells it; a stretch's first rows get it from the last value of the stretches before, of
    which there is one row a group and stretch.
    """
    turned = F.desc if backward else F.asc
    inside = Window.partitionBy(*group, "_stretch").orderBy(turned(by)).rowsBetween(Window.unboundedPreceding, -1)
    outermost = (F.min_by if backward else F.max_by)(value, F.when(value.isNotNull(), F.col(by)))
    edges = df.groupBy(*[F.col(c).alias(f"_{c}") for c in group], F.col("_stretch").alias("_of")).agg(outermost.alias("_edge"))
    earlier = Window.partitionBy(*[f"_{c}" for c in group]).orderBy(turned("_of")).rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.withColumn("_before", F.last("_edge", ignorenulls=True).over(earlier)).drop("_edge")
    same = all_of([F.col("_stretch") == F.col("_of"), *[F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group]])
    told = df.withColumn("_inside", F.last(value, ignorenulls=True).over(inside)).join(edges, same)
    return told.withColumn(name, F.coalesce("_inside", "_before")).drop("_inside", "_before", "_of", *[f"_{c}" for c in group])


def dedupe(df: DataFrame, key: Sequence[str], order: Sequence[str], policy: str) -> DataFrame:
    """One row per key: the first (``keep_first``) or last (``replace``) by ``order``.

    ``error`` returns the keys that occur more than once instead.
    """
    if policy == "error":
        return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
    rest = F.struct(*[F.col(c) for c in df.columns if c not in key])
    at = F.struct(*[F.col(c) for c in order])
    pick = F.min_by(rest, at) if policy == "keep_first" else F.max_by(rest, at)
    return df.groupBy(*key).agg(pick.alias("r")).select(*key, "r.*")


def most_frequent(df: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Most frequent value per key; the lowest value wins a tie."""
    counts = df.groupBy(*key, value).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*key).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(value), F.max("n").alias("value_rows"))


def cumulative_check(df: DataFrame, group: Sequence[str], min_rows: int) -> DataFrame:
    """Per group: rows whose running count does not continue the one above, repeated scores, and a too-few-rows flag.

    Rows without score, count or running count are counted apart and passed over: the next row continues the last complete one.
    Rows are reduced to one per score first, so the window sees at most one row per score.
    """
    complete = F.col("score").isNotNull() & F.col("score_count").isNotNull() & F.col("cumulative_rank").isNotNull()
    skipped = df.groupBy(*group).agg(F.count(F.lit(1)).alias("score_rows"), F.count_if(~complete).alias("incomplete_rows"), (F.count(F.lit(1)) < min_rows).alias("too_few_rows"))
    per_score = df.filter(complete).groupBy(*group, "score").agg(F.min(F.struct("cumulative_rank", "score_count")).alias("v"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*group).orderBy(F.desc("score"))
    expected = F.coalesce(F.lag("v.cumulative_rank").over(w), F.lit(0)) + F.col("v.score_count")
    marked = per_score.withColumn("_bad", F.col("v.cumulative_rank") != expected)
    found = marked.groupBy(*group).agg(F.count_if("_bad").alias("mismatches"), F.sum(F.col("_n") - 1).alias("duplicate_scores"))
    joined = skipped.join(found, list(group), "left")
    return joined.select(*group, "score_rows", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("mismatches", "duplicate_scores")], "too_few_rows", "incomplete_rows")


def math_status(df: DataFrame, group: Sequence[str], ordinal: Sequence[str]) -> DataFrame:
    """ok, duplicate_score or cumulative_mismatch; only the first row of a score takes part in the check.

    First rows are picked by aggregation, so the running window sees one row per score.
    """
    at = F.struct(*[F.col(c) for c in ordinal])
    firsts = df.groupBy(*group, "score").agg(F.min_by(F.struct("score_count", "cumulative_rank"), at).alias("v"), F.min(at).alias("_at"))
    w = Window.partitionBy(*group).orderBy(F.desc("score"))
    expected = F.coalesce(F.lag("v.cumulative_rank").over(w), F.lit(0)) + F.col("v.score_count")
    checked = firsts.select(
        *group, "score", "_at", F.when(F.col("v.cumulative_rank") == expected, "ok").otherwise("cumulative_mismatch").alias("_status")
    )
    joined = df.join(checked, [*group, "score"])
    return joined.withColumn("math_status", F.when(F.col("_at") == at, F.col("_status")).otherwise("duplicate_score")).drop("_at", "_status")


def anchors(df: DataFrame, block: Sequence[str], usable: Column, min_rows: int) -> DataFrame:
    """Most common ``score + position`` per block, the earliest position winning a tie."""
    votes = (
        df.filter(usable & on_scale(F.col("score")))
        .groupBy(*block, (F.col("score") + F.col("position")).alias("anchor"))
        .agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("p"))
    )
    best = votes.groupBy(*block).agg(F.max_by(F.struct("anchor", "n"), F.struct(F.col("n"), -F.col("p"))).alias("b"))
    return best.select(*block, "b.anchor", "b.n").filter((F.col("n") >= min_rows) & on_scale(F.col("anchor"))).drop("n")


def expected_scores(df: DataFrame, block: Sequence[str], anchor_rows: DataFrame) -> DataFrame:
    """Rows of anchored blocks with the score their position implies."""
    return df.join(anchor_rows, list(block)).withColumn("expected_score", F.col("anchor") - F.col("position"))


def boundary_anchors(df: DataFrame, block: Sequence[str], min_rows: int, max_anchor: int) -> DataFrame:
    """Anchor of blocks where exactly one of the first and last rows is complete and low enough,
    and every complete row agrees with it."""
    row = F.struct("position", "score", is_complete().alias("done"))
    anchor_of = F.when(is_complete(), F.col("score") + F.col("position"))
    ends = df.groupBy(*block).agg(
        F.count(F.lit(1)).alias("n"),
        F.min_by(row, F.col("position")).alias("head"),
        F.max_by(row, F.col("position")).alias("tail"),
        F.min(anchor_of).alias("low"),
        F.max(anchor_of).alias("high"),
    )

    def good(end: str) -> Column:
        return F.coalesce(F.col(f"{end}.done") & (F.col(f"{end}.score") <= max_anchor), F.lit(False))

    one = good("head") != good("tail")
    end = F.when(good("head"), F.col("head")).otherwise(F.col("tail"))
    anchor = end["score"] + end["position"]
    agreed = (F.col("low") == anchor) & (F.col("high") == anchor)
    return ends.filter((F.col("n") >= min_rows) & one & agreed).select(*block, anchor.alias("anchor"))


FILLED = "array<struct<position:int,score:int,score_count:bigint,cumulative_rank:bigint,parse_status:string>>"


def fill_counts(df: DataFrame, block: Sequence[str], allow_single_number: bool) -> DataFrame:
    """Counts for incomplete rows from the numbers in their text and the running count above.

    Input rows carry ``position``, ``expected_score``, ``numbers`` and the parsed columns. Two
    numbers are count and running count; a single one is read against the previous running
    count, which may itself be filled. A block is one column of a printed page.
    """
    entry = F.struct("position", "expected_score", "numbers", is_complete().alias("done"), F.col("cumulative_rank").cast("bigint").alias("cum"))
    # below the scale nothing can be filled, and nothing there comes before a row that can
    blocks = df.filter(F.col("expected_score") >= LOWEST_SCORE).groupBy(*block).agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    start = F.struct(F.lit(None).cast("bigint").alias("prev"), F.array().cast(FILLED).alias("done"))

    def step(acc, r):
        numbers, prev = r["numbers"], acc["prev"]
        first, second = F.get(numbers, 0), F.get(numbers, 1)
        two = F.size(numbers) == 2
        single = (F.size(numbers) == 1) & prev.isNotNull() & F.lit(allow_single_number)
        count = F.when(two, first).when(single, F.when(first > prev, first - prev).otherwise(first))
        cum = F.when(two, second).when(single, F.when(first > prev, first).otherwise(prev + first))
        usable = F.coalesce(~r["done"] & on_scale(r["expected_score"]) & (count > 0) & (cum > count), F.lit(False))
        row = F.struct(
            r["position"].alias("position"),
            r["expected_score"].alias("score"),
            count.alias("score_count"),
            cum.alias("cumulative_rank"),
            F.when(two, "inferred_score").otherwise("inferred_row").alias("parse_status"),
        )
        return F.struct(
            F.when(r["done"], r["cum"]).when(usable, cum).otherwise(prev).alias("prev"),
            F.when(usable, F.concat(acc["done"], F.array(row))).otherwise(acc["done"]).alias("done"),
        )

    filled = blocks.select(*block, F.aggregate("rows", start, step, lambda acc: acc["done"]).alias("filled"))
    return filled.select(*block, F.explode("filled").alias("f")).select(*block, "f.*")


def neighbour_counts(df: DataFrame, group: Sequence[str], max_count: int) -> DataFrame:
    """Count as the difference to the running count of the next higher score.

    The neighbour comes from a self-join on ``score + 1``, so a gap gives no neighbour. Without
    one, the count is only believed when it equals the running count (the top row).
    """
    known = df.filter(F.col("score").isNotNull() & (F.col("cumulative_rank") > 0))
    above = known.select(*group, (F.col("score") - 1).alias("score"), F.col("cumulative_rank").alias("above"))
    joined = known.join(above, [*group, "score"], "left")
    top = F.when(F.col("score_count") == F.col("cumulative_rank"), F.col("cumulative_rank"))
    suggested = F.when(F.col("above").isNull(), top).otherwise(F.col("cumulative_rank") - F.col("above"))
    starts_with_score = F.regexp_replace("raw_text", r"\D", "").startswith(F.col("score").cast("string"))
    contradicts = F.coalesce((F.col("score_count") > 0) & starts_with_score & (F.col("score_count") != F.col("suggested_count")), F.lit(False))
    fits = (F.col("suggested_count") > 0) & (F.col("cumulative_rank") > F.col("suggested_count")) & (F.col("suggested_count") <= max_count)
    return joined.withColumn("suggested_count", suggested).filter(fits & ~contradicts).drop("above")


def nearest_anchor_scores(df: DataFrame, page: Sequence[str], block: str) -> DataFrame:
    """Missing scores counted down from the last known one, else up from the next, else on from the block before."""
    up = Window.partitionBy(*page, block).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*page, block).orderBy("position").rowsBetween(0, Window.unboundedFollowing)
    seen = F.when(F.col("score").isNotNull() & on_scale(F.col("score")), F.col("score") + F.col("position"))
    own = df.withColumn("_own", F.coalesce(F.last(seen, True).over(up), F.first(seen, True).over(down)))
    blocks = own.groupBy(*page, block).agg(
        F.count(F.lit(1)).alias("_n"), F.max_by(F.col("_own") - F.col("position"), F.col("position")).alias("_last")
    )
    w = Window.partitionBy(*page).orderBy(block)
    total = F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    carried = F.last(F.col("_last") + F.col("_total"), True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("_total", total).withColumn("_from", carried - (F.col("_total") - F.col("_n")) - 1)
    joined = own.join(blocks.select(*page, block, "_from"), [*page, block])
    value = F.coalesce("_own", "_from") - F.col("position")
    kept = F.when(F.col("score").isNotNull() & on_scale(F.col("score")), F.col("score"))
    return joined.withColumn("assigned_score", F.coalesce(kept, F.when(on_scale(value), value))).drop("_own", "_from")


REPAIRED = "array<struct<score:int,score_count:bigint,cumulative_rank:bigint,action:string>>"


def repair_cumulative(
    df: DataFrame, group: Sequence[str], ordinal: Sequence[str], max_count: int, jump_delta: int, jump_ratio: float, scale: tuple[int, int] | None = None
) -> DataFrame:
    """Make count and running count agree from the top score down, row by row.

    A missing value comes from the other one. When both disagree, a plausible difference
    corrects the count; an implausible one, or a jump far above the count, corrects the running
    count. Only the first row of a score is used. With a scale (lowest and highest score), scores outside it are left out, which
    bounds a group; ``repair_skips`` counts them.
    """
    rest = F.struct(F.col("score_count").cast("bigint").alias("n"), F.col("cumulative_rank").cast("bigint").alias("cum"))
    usable = F.col("score").isNotNull() if scale is None else F.col("score").between(*scale)
    unique = df.filter(usable).groupBy(*group, "score").agg(F.min_by(rest, F.struct(*[F.col(c) for c in ordinal])).alias("v"))
    entry = F.struct((-F.col("score")).alias("down"), F.col("v.n").alias("n"), F.col("v.cum").alias("cum"))
    groups = unique.groupBy(*group).agg(F.array_sort(F.collect_list(entry)).alias("rows"))
    start = F.struct(F.lit(0).cast("bigint").alias("prev"), F.array().cast(REPAIRED).alias("out"))

    def step(acc, r):
        prev = acc["prev"]
        diff = r["cum"] - prev
        plausible = (diff > 0) & (diff <= max_count)
        n1 = F.coalesce(r["n"], F.when(plausible, diff))
        cum1 = F.coalesce(r["cum"], prev + r["n"])
        both = n1.isNotNull() & cum1.isNotNull()
        differs = F.coalesce(both & (prev + n1 != cum1), F.lit(False))
        delta = cum1 - prev
        jump = (n1 > 0) & (delta > n1) & (delta - n1 >= jump_delta) & (delta >= n1 * jump_ratio)
        by_difference = differs & ~jump & (delta > 0) & (delta <= max_count)
        n2 = F.when(by_difference, delta).otherwise(n1)
        cum2 = F.when(differs & ~by_difference, prev + n1).otherwise(cum1)
        action = first_match(
            [
                (differs & jump, "cumulative_by_jump"),
                (by_difference, "count_by_cumulative"),
                (differs, "cumulative_by_count"),
                (r["n"].isNull(), "count_from_cumulative"),
                (r["cum"].isNull(), "cumulative_from_count"),
            ],
            "kept",
        )
        row = F.struct((-r["down"]).cast("int").alias("score"), n2.alias("score_count"), cum2.alias("cumulative_rank"), action.alias("action"))
        return F.struct(
            F.when(both, cum2).otherwise(prev).alias("prev"), F.when(both, F.concat(acc["out"], F.array(row))).otherwise(acc["out"]).alias("out")
        )

    fixed = groups.select(*group, F.aggregate("rows", start, step, lambda acc: acc["out"]).alias("out"))
    return fixed.select(*group, F.explode("out").alias("r")).select(*group, "r.*")


def repair_skips(df: DataFrame, group: Sequence[str], scale: tuple[int, int] | None = None) -> DataFrame:
    """Per group, the rows that ``repair_cumulative`` passes over, by reason: no score, off the scale, a score met before, and
    neither count nor running count."""
    outside = F.lit(False) if scale is None else ~F.col("score").between(*scale)
    used = F.col("score").isNotNull() & ~F.coalesce(outside, F.lit(False))
    empty = used & F.col("score_count").isNull() & F.col("cumulative_rank").isNull()
    per_score = df.groupBy(*group, "score").agg(F.count(F.lit(1)).alias("_n"), F.count_if(used).alias("_used"), F.count_if(empty).alias("_empty"))
    return per_score.groupBy(*group).agg(
        F.sum(F.when(F.col("score").isNull(), F.col("_n")).otherwise(0)).alias("without_score"),
        F.sum(F.when(F.col("score").isNotNull() & (F.col("_used") == 0), F.col("_n")).otherwise(0)).alias("off_scale"),
        F.sum(F.greatest(F.col("_used") - 1, F.lit(0))).alias("repeated_scores"),
        F.sum("_empty").alias("without_numbers"),
    )


def context_lines(docs: DataFrame, id_cols: Sequence[str], text: str, count: int) -> DataFrame:
    """Every line of a page with the following ``count - 1`` lines; one row holds the page, so no shuffle.

    Control characters count as blanks, and runs of blanks as one.
    """
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(x, r"[\s\x00-\x1F\x7F]+", " ")))
    listed = docs.select(*id_cols, lines.alias("_lines"))
    at = listed.select(*id_cols, "_lines", F.posexplode("_lines").alias("line_no", "line"))
    near = F.filter(F.slice("_lines", F.col("line_no") + 1, F.lit(count)), lambda x: x != "")
    return at.filter(F.col("line") != "").select(*id_cols, "line_no", "line", F.array_join(near, " ").alias("context"))


def line_groups(df: DataFrame, page: Sequence[str], tolerance: float) -> DataFrame:
    """Objects with the ``first_y`` of their line: within ``tolerance`` of the line's first object.

    A position farther than the tolerance from the one before begins a line for sure. In between, where a line begins depends on
    where the one before it begins: every position's successor is the smallest position beyond its tolerance, and lines begin
    where successors lead to from the sure beginnings. They are found by pointer jumping over (page, y) rows: each round doubles
    the steps that successors take and the beginnings that are known, so a stretch of n lines takes log n rounds and is never
    held in one task. Objects without y are one line of their page, without first_y; objects without a page are left out.
    """
    df = df.filter(all_of([F.col(c).isNotNull() for c in page]))
    ys = in_stretches(df.select(*page, "y").filter(F.col("y").isNotNull()).distinct(), page, "y")
    sure = carried(ys, page, "y", F.col("y"), "previous")
    sure = sure.filter(F.col("previous").isNull() | (F.col("y") - F.col("previous") > tolerance)).select(*page, "y")
    starts = cut_lineage(sure, "line-starts")
    jumps = cut_lineage(_line_successors(ys, page, tolerance), "line-jumps")
    known = starts.count()
    while True:
        # a start that is sure needs no way to it
        found = starts.join(jumps, [*page, "y"]).select(*page, F.col("to").alias("y"))
        starts = cut_lineage(starts.unionByName(found).distinct(), "line-starts")
        now = starts.count()
        if now == known:
            break
        known = now
        onward = jumps.select(*page, F.col("y").alias("to"), F.col("to").alias("onward"))
        jumps = cut_lineage(jumps.join(onward, [*page, "to"]).select(*page, "y", F.col("onward").alias("to")), "line-jumps")
    marked = ys.join(starts.withColumn("_start", F.col("y")), [*page, "y"], "left")
    placed = carried(marked, page, "y", F.col("_start"), "_last").select(*page, "y", F.coalesce("_start", "_last").alias("first_y"))
    return df.join(placed, [*page, "y"], "left")


def _line_successors(ys: DataFrame, page: Sequence[str], tolerance: float) -> DataFrame:
    """page, y, to: the smallest position more than the tolerance beyond y."""
    edge = F.col("y") + tolerance
    ulp = F.abs(edge) * 2.0**-53
    # the last position that still counts as within the tolerance, as the difference is rounded
    within = F.array_max(F.filter(F.array(edge - 2 * ulp, edge - ulp, edge, edge + ulp, edge + 2 * ulp), lambda x: x - F.col("y") <= tolerance))
    asked = ys.select(*page, F.struct(within.alias("at"), F.lit(1).alias("kind")).alias("place"), "y", F.lit(None).cast("double").alias("to"))
    there = ys.select(*page, F.struct(F.col("y").alias("at"), F.lit(0).alias("kind")).alias("place"), "y", F.col("y").alias("to"))
    both = in_stretches(asked.unionByName(there), page, "place")
    found = carried(both, page, "place", F.col("to"), "next", backward=True).filter("place.kind = 1 AND next IS NOT NULL")
    return found.select(*page, "y", F.col("next").alias("to"))


def line_texts(placed: DataFrame, page: Sequence[str]) -> DataFrame:
    """Text of every line of a printed page from left to right; ``item`` holds the texts."""
    cells = F.array_sort(F.collect_list(F.struct("x", "item")))
    text = F.array_join(F.transform(cells, lambda c: c["item"].cast("string")), "")
    return placed.groupBy(*page, "first_y").agg(text.alias("line"))


def column_block(x: Column, ranges: Sequence[tuple[float, float]]) -> Column:
    """Index of the first half-open range that holds ``x``; null outside all of them."""
    return first_match([((x >= low) & (x < high), i) for i, (low, high) in enumerate(ranges)])


def place_verdict(name: Column, owner: Column, campus: Sequence[str], noise: Sequence[str]) -> Column:
    """How well a place name fits its owner: a struct of score and tail; score 0 rejects."""
    tail = F.when(name.startswith(owner), F.substring(name, F.length(owner) + 1, F.length(name)))
    has_campus = any_of(tail.contains(c) for c in campus)
    after = F.regexp_replace(tail, "^.*?(" + "|".join(campus) + ")", "")
    score = first_match(
        [
            (tail.isNull() | (owner == ""), 0),
            (tail == "", 100),
            (has_campus & any_of(after.contains(x) for x in noise), 0),
            (has_campus, 90),
            (any_of(tail.contains(x) for x in noise), 0),
            (F.length(tail) <= 2, 70),
        ],
        0,
    )
    return F.struct(score.alias("score"), F.length(tail).alias("tail_length"))
