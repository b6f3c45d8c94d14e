"""Joins that need more than an equality: lookups with misses, candidates, cascades, containment.

Inequality and OR conditions are always turned into equi-joins on derived keys, because a
nested-loop join does not survive a large table. Small sides are not hinted: their size is
measured by AQE at run time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.scoring import EARTH_RADIUS_KM, haversine_km
from plumbline.rules import first_match
from plumbline.session import cut_lineage


def last_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last by ``order``; a max over structs, so map tasks pre-aggregate."""
    rest = [c for c in df.columns if c not in key]
    row = F.struct(*[F.col(c) for c in rest])
    return df.groupBy(*key).agg(F.max_by(row, F.struct(*[F.col(c) for c in order])).alias("r")).select(*key, "r.*")


def rank_lookup(rows: DataFrame, ranks: DataFrame, on: Sequence[str], rank: str) -> DataFrame:
    """Rows with the rank of their key; no row or a null rank counts as unmatched."""
    return rows.join(ranks.select(*on, rank), list(on), "left").withColumn("is_matched", F.col(rank).isNotNull())


def two_sided(left: DataFrame, right: DataFrame, key: Sequence[str], names=("package", "core")) -> DataFrame:
    """Full outer join on a key unique on both sides; values become two structs, ``side`` says who has the key."""
    a, b = names
    lv = F.struct(*[F.col(c) for c in left.columns if c not in key]).alias(a)
    rv = F.struct(*[F.col(c) for c in right.columns if c not in key]).alias(b)
    joined = left.select(*key, lv).join(right.select(*key, rv), list(key), "full_outer")
    side = F.when(F.col(b).isNull(), f"{a}_only").when(F.col(a).isNull(), f"{b}_only").otherwise("matched")
    return joined.withColumn("side", side)


def in_scope(rows: DataFrame, other: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Rows whose scope occurs on the other side."""
    return rows.join(other.select(*scope).distinct(), list(scope), "left_semi")


def missing_or_exempt(entities: DataFrame, covered: DataFrame, exempt: DataFrame, key: str) -> DataFrame:
    """Entities not covered, plus exempt ones whatever their coverage."""
    open_rows = entities.join(exempt.select(key), key, "left_anti").join(covered.select(key), key, "left_anti")
    return open_rows.unionByName(entities.join(exempt.select(key), key, "left_semi"))


def rekey_candidates(
    package_only: DataFrame, core_only: DataFrame, match: Sequence[str], variant: Sequence[str]
) -> DataFrame:
    """Per package-only row, how many core-only rows agree on ``match``, and the first of them.

    Keys are ``match + variant`` and both inputs hold unmatched keys, so every core-only row of
    a match group differs on ``variant``: the group itself is the candidate list. Keeping it as
    one aggregated row per group avoids writing every pair of a large group.
    """
    first = F.min(F.struct(*[F.col(c) for c in variant])).alias("first_candidate")
    groups = core_only.groupBy(*match).agg(F.count(F.lit(1)).alias("candidate_count"), first)
    return package_only.join(groups, list(match), "inner")


def candidate_rows(package_only: DataFrame, core_only: DataFrame, match: Sequence[str], variant: Sequence[str]) -> DataFrame:
    """The candidates of re-key tasks, once per match group: its core-only rows, numbered in the order of their variant.

    Tasks refer to the list of their group by ``match``; a candidate differs from a task on the variant columns alone. The table
    has one row per candidate, however many tasks share the group.
    """
    wanted = core_only.join(package_only.select(*match).distinct(), list(match), "left_semi")
    numbered = F.row_number().over(Window.partitionBy(*match).orderBy(*variant))
    return wanted.select(*match, *variant, numbered.alias("candidate_no"))


def union_of_keys(facts: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """Grouped facts side by side for every key any of them has.

    The facts are stacked and summed once instead of chaining full outer joins: one shuffle,
    pre-aggregated on the map side.
    """
    measures = [c for f in facts for c in f.columns if c not in key]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), facts)
    return stacked.groupBy(*key).agg(*[F.sum(m).alias(m) for m in measures])


#: Points of a cell that are compared one by one, and halvings of the unit cube at most.
LEAF_POINTS, MOST_LEVELS = 64, 24
AXES = ("x", "y", "z")
#: What rounding may take from a lower bound.
SLACK_KM = 1e-6


def nearest_in_group(left: DataFrame, right: DataFrame, group: Sequence[str], left_id: str) -> DataFrame:
    """Smallest great-circle distance to a right point of the same group, however far; no row where the group has no point.

    Right points lie in a pyramid of cubes, each half as long as the one around it; an occupied cube has one entry: how many
    points, the box around them, and one of them. A left point starts at the whole sphere and goes down level by level. The one
    point of each cube bounds its best distance from above, the box every distance in the cube from below, and only cubes whose
    lower bound does not exceed the best so far are entered. Points are compared one by one in cubes that hold few, so that what
    a left point is joined with does not grow with the number of points around it. Equal points are merged first.
    """
    keys = [*group, left_id]
    points = cut_lineage(_on_sphere(right.select(*group, "latitude", "longitude").dropna().distinct()), "points")
    places = _on_sphere(left.select(*keys, "latitude", "longitude").dropna().join(points.select(*group).distinct(), list(group), "left_semi"))
    inside = points  # points of cubes that were entered
    front = places.withColumn("best", F.lit(float("inf")))
    answers = None
    for level in range(MOST_LEVELS + 1):
        cell, around = [f"c{x}" for x in AXES], [f"p{x}" for x in AXES]
        located = inside.select("*", *[_cell(x, level).alias(f"c{x}") for x in AXES])
        box = [f(x).alias(f"{name}_{x}") for x in AXES for f, name in ((F.min, "low"), (F.max, "high"))]
        entries = located.groupBy(*group, *cell).agg(F.count(F.lit(1)).alias("points"), F.min(F.struct("latitude", "longitude")).alias("one"), *box)
        if level:
            entries = entries.select("*", *[F.floor(F.col(f"c{x}") / 2).alias(f"p{x}") for x in AXES])
            met = front.join(entries, [*group, *around])
        else:
            met = front.join(entries, list(group))
        gap = sum((F.pow(F.greatest(F.col(f"low_{x}") - F.col(x), F.col(x) - F.col(f"high_{x}"), F.lit(0.0)), 2) for x in AXES), F.lit(0.0))
        least = 2 * EARTH_RADIUS_KM * F.asin(F.least(F.lit(1.0), F.sqrt(gap) / 2)) - SLACK_KM
        there = haversine_km(F.col("latitude"), F.col("longitude"), F.col("one.latitude"), F.col("one.longitude"))
        told = met.withColumn("least", least).withColumn("there", there)
        told = told.withColumn("best", F.least("best", F.min("there").over(Window.partitionBy(*keys)))).filter(F.col("least") <= F.col("best"))
        few = (F.col("points") <= LEAF_POINTS) | F.lit(level == MOST_LEVELS)
        told = cut_lineage(told.select(*keys, "latitude", "longitude", *AXES, "best", *cell, few.alias("few")), "entered-cells")
        at = located.select(*group, F.col("latitude").alias("lat2"), F.col("longitude").alias("lon2"), *cell)
        km = haversine_km(F.col("latitude"), F.col("longitude"), F.col("lat2"), F.col("lon2"))
        near = told.filter("few").join(at, [*group, *cell]).groupBy(*keys).agg(F.min(km).alias("nearest_km"))
        answers = near if answers is None else answers.unionByName(near)
        front = told.filter("NOT few").drop("few")
        if front.isEmpty():
            break
        front = front.select(*keys, "latitude", "longitude", *AXES, "best", *[F.col(f"c{x}").alias(f"p{x}") for x in AXES])
        entered = front.select(*group, *around).distinct().toDF(*group, *cell)
        inside = cut_lineage(located.join(entered, [*group, *cell], "left_semi").drop(*cell), "entered-points")
    return answers.groupBy(*keys).agg(F.min("nearest_km").alias("nearest_km"))


def _on_sphere(df: DataFrame) -> DataFrame:
    lat, lon = F.radians("latitude"), F.radians("longitude")
    return df.select("*", (F.cos(lat) * F.cos(lon)).alias("x"), (F.cos(lat) * F.sin(lon)).alias("y"), F.sin(lat).alias("z"))


def _cell(axis: str, level: int) -> Column:
    """Number of the cube along an axis; the cubes of a level fill [-1, 1]."""
    return F.least(F.floor((F.col(axis) + 1) / 2 * float(1 << level)), F.lit((1 << level) - 1)).cast("bigint")


def with_fallback(rows: DataFrame, by_code: DataFrame, by_city: DataFrame, code: str, city: str, value: str) -> DataFrame:
    """Value by code; by city only for rows without any row under their code."""
    a = by_code.select(code, F.col(value).alias("_a"), F.lit(True).alias("_has_a"))
    b = by_city.select(city, F.col(value).alias("_b"), F.lit(True).alias("_has_b"))
    joined = rows.join(a, code, "left").join(b, city, "left")
    return joined.select(
        *rows.columns,
        F.when(F.col("_has_a"), F.col("_a")).otherwise(F.col("_b")).alias(value),
        F.when(F.col("_has_a"), "code").when(F.col("_has_b"), "city").otherwise("none").alias("matched_by"),
    )


def keyword_places(texts: DataFrame, id_col: str, text_col: str, keywords: DataFrame, token: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(text id, piece) of the distinct pieces of every text, and (piece, keyword) of the keywords that pieces hold.

    Containment becomes an equi-join on whole substrings, so no common beginning gathers rows. Texts are cut into ``token``
    matches (the whole text without a pattern); of each distinct token, the substrings of the lengths that keywords have are
    joined to the keywords. A keyword that a token could not hold fails the job rather than being missed.
    """
    keys = keywords.select("keyword").distinct()
    if token:
        unfit = F.raise_error(F.lit(f"keyword does not fit {token}")).cast("string")
        keys = keys.select(F.when(F.col("keyword").rlike(f"^(?:{token})$"), F.col("keyword")).otherwise(unfit).alias("keyword"))
    # as many rows as keywords have different lengths
    lengths = sorted(row["n"] for row in keywords.select(F.length("keyword").alias("n")).distinct().collect() if row["n"])
    found = F.regexp_extract_all(text_col, F.lit(token), F.lit(0)) if token else F.array(text_col)
    pieces = texts.select(id_col, F.explode(F.array_distinct(found)).alias("piece")).filter(F.length("piece") >= F.lit(min(lengths, default=1)))
    size = F.length("piece")
    starts = lambda n: F.when(size >= n, F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.substring(F.col("piece"), i, n)))
    parts = F.array_distinct(F.flatten(F.filter(F.transform(F.array(*[F.lit(n) for n in lengths]), starts), lambda x: x.isNotNull())))
    pieces = cut_lineage(pieces, "pieces")  # read for the distinct ones, and again for each text's
    grams = pieces.select("piece").distinct().select("piece", F.explode(parts).alias("keyword"))
    return pieces, grams.join(keys, "keyword").select("piece", "keyword")


def keyword_hits(texts: DataFrame, id_col: str, text_col: str, keywords: DataFrame, token: str | None = None) -> DataFrame:
    """(text id, keyword) wherever the keyword occurs anywhere in the text."""
    pieces, holds = keyword_places(texts, id_col, text_col, keywords, token)
    return pieces.join(holds, "piece").select(id_col, "keyword").distinct()


#: Items in a word of a posting bitmap.
WORD_BITS = 64


def numbered(df: DataFrame, column: str, name: str) -> DataFrame:
    """Distinct values of a column with numbers, as a table; numbers are dense but for a new beginning in each task's rows."""
    return cut_lineage(df.select(column).distinct().withColumn(name, F.monotonically_increasing_id()), "numbers")


def _bits(number: str) -> list[Column]:
    """Word of a number, and its bit in there."""
    return [F.floor(F.col(number) / WORD_BITS).alias("word"), F.expr(f"shiftleft(1L, CAST({number} % {WORD_BITS} AS INT))").alias("bits")]


def _set_bits(number: str) -> Column:
    """Numbers of the bits that are set in a word: a generator."""
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD_BITS - 1)), lambda i: F.getbit(F.col("bits"), i) == 1)
    return F.explode(F.transform(places, lambda i: F.col("word") * WORD_BITS + i)).alias(number)


def item_hits(texts: DataFrame, id_col: str, text_col: str, keywords: DataFrame, item: str, token: str | None = None) -> DataFrame:
    """(item, text id) of every text that holds one of the item's keywords; keywords: item, keyword.

    Items get numbers, and a keyword's items are a bitmap in words of 64. A token's bitmap is that of its keywords taken
    together, a text's that of its distinct tokens; items are told apart only when a text's bitmap is known, so that no row stands
    for a text, a keyword and an item.
    """
    pieces, holds = keyword_places(texts, id_col, text_col, keywords, token)
    numbers = numbered(keywords, item, "number")
    of_keyword = keywords.join(numbers, item).select("keyword", *_bits("number")).groupBy("keyword", "word").agg(F.bit_or("bits").alias("bits"))
    of_piece = holds.join(of_keyword, "keyword").groupBy("piece", "word").agg(F.bit_or("bits").alias("bits"))
    of_text = pieces.join(of_piece, "piece").groupBy(id_col, "word").agg(F.bit_or("bits").alias("bits"))
    return of_text.select(id_col, _set_bits("number")).join(numbers, "number").select(item, id_col)


def item_strengths(texts: DataFrame, id_col: str, text_col: str, keywords: DataFrame, item: str, token: str | None = None) -> DataFrame:
    """(item, text id, strength) where a text holds keywords of an item: the letters of those keywords, each counted once.

    A text's distinct keywords come from bitmaps, as items do in item_hits. Strengths of several items are summed in one number,
    in lanes that are wide enough for the strongest item, so that a row stands for a text, a keyword and a group of items.
    """
    pieces, holds = keyword_places(texts, id_col, text_col, keywords, token)
    words = numbered(keywords, "keyword", "number")
    of_piece = holds.join(words, "keyword").select("piece", *_bits("number")).groupBy("piece", "word").agg(F.bit_or("bits").alias("bits"))
    of_text = pieces.join(of_piece, "piece").groupBy(id_col, "word").agg(F.bit_or("bits").alias("bits"))
    held = of_text.select(id_col, _set_bits("number"))

    items = numbered(keywords, item, "item_number")
    weighed = keywords.join(items, item).join(words, "keyword").select("number", "item_number", F.length("keyword").cast("bigint").alias("letters"))
    strongest = weighed.groupBy("item_number").agg(F.sum("letters").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 1
    width = int(strongest).bit_length()
    lanes = max(1, 63 // width)
    lane = (F.col("item_number") % lanes).cast("int") * width
    packed = weighed.select("number", F.floor(F.col("item_number") / lanes).alias("lane_group"), F.call_function("shiftleft", F.col("letters"), lane).alias("packed"))
    packed = packed.groupBy("number", "lane_group").agg(F.sum("packed").alias("packed"))
    summed = held.join(packed, "number").groupBy(id_col, "lane_group").agg(F.sum("packed").alias("packed"))
    out = F.transform(
        F.sequence(F.lit(0), F.lit(lanes - 1)),
        lambda i: F.struct((F.col("lane_group") * lanes + i).alias("item_number"), F.call_function("shiftright", F.col("packed"), i * width).bitwiseAND(F.lit((1 << width) - 1).cast("bigint")).alias("strength")),
    )
    told = summed.select(id_col, F.inline(F.filter(out, lambda x: x["strength"] > 0)))
    return told.join(items, "item_number").select(item, id_col, "strength")


#: Keywords of items that tasks hold; more are joined instead.
HELD_KEYWORDS = 1 << 19
#: Tokens whose keywords a task remembers, and the longest of these.
REMEMBERED_TOKENS, REMEMBERED_LENGTH = 100_000, 64


def held_keywords(texts: DataFrame, id_col: str, keywords: DataFrame, item: str, token: str) -> list[tuple] | None:
    """(item, keyword) rows, if tasks can hold them and every text has an id of its own; else None."""
    rows = keywords.select(item, "keyword").distinct().limit(HELD_KEYWORDS + 1).collect()
    ids = texts.select(id_col)
    unfit = len(rows) > HELD_KEYWORDS or any(not re.fullmatch(token, r["keyword"]) for r in rows)
    if unfit or not ids.filter(F.col(id_col).isNull()).isEmpty() or not ids.groupBy(id_col).count().filter("count > 1").isEmpty():
        return None
    return [(r[item], r["keyword"]) for r in rows]


class HeldItems:
    """Items with the letters of their keywords that a text holds, each keyword counted once."""

    def __init__(self, held: list[tuple], token: str):
        self.items = sorted({i for i, _ in held})
        at = {x: n for n, x in enumerate(self.items)}
        of: dict[str, list[int]] = {}
        for i, keyword in held:
            of.setdefault(keyword, []).append(at[i])
        self.number = {keyword: n for n, keyword in enumerate(of)}
        self.postings = [np.array(x, np.int64) for x in of.values()]
        self.letters = [np.full(len(x), len(keyword), np.int64) for keyword, x in of.items()]
        self.short = sorted({len(keyword) for keyword in of if len(keyword) < 3})
        longer: dict[str, set[int]] = {}
        for keyword in of:
            if len(keyword) >= 3:
                longer.setdefault(keyword[:3], set()).add(len(keyword))
        self.longer = {beginning: tuple(lengths) for beginning, lengths in longer.items()}
        self.token = re.compile(token)
        self.known: dict[str, tuple[int, ...]] = {}

    def keywords_of(self, piece: str) -> tuple[int, ...]:
        """Numbers of the keywords inside a token."""
        found = self.known.get(piece)
        if found is None:
            parts = {piece[i : i + n] for n in self.short for i in range(len(piece) - n + 1)}
            for i in range(len(piece) - 2):
                parts.update([piece[i : i + n] for n in self.longer.get(piece[i : i + 3], ())])
            found = tuple(self.number[x] for x in parts if x in self.number)
            if len(piece) <= REMEMBERED_LENGTH:
                if len(self.known) >= REMEMBERED_TOKENS:
                    self.known = {}
                self.known[piece] = found
        return found

    def strengths(self, body: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Places of the items, ascending, and their letters."""
        numbers = {n for piece in set(self.token.findall(body or "")) for n in self.keywords_of(piece)}
        if not numbers:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        items, which = np.unique(np.concatenate([self.postings[n] for n in numbers]), return_inverse=True)
        return items, np.bincount(which, np.concatenate([self.letters[n] for n in numbers])).astype(np.int64)


def item_hits_in_tasks(texts: DataFrame, id_col: str, text_col: str, held: list[tuple], item: str, item_type: str, token: str) -> DataFrame:
    """item_hits from one pass over the texts; held: as from held_keywords. Nothing is shuffled."""
    id_type = texts.schema[id_col].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = HeldItems(held, token)
        items = pa.array(of.items)
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [of.strengths(x.as_py())[0] for x in part.column(1)]
                at = np.repeat(np.arange(len(found)), [len(x) for x in found])
                yield pa.RecordBatch.from_arrays([items.take(pa.array(np.concatenate(found))), part.column(0).take(pa.array(at))], [item, id_col])

    return texts.select(id_col, text_col).mapInArrow(find, f"{item} {item_type}, {id_col} {id_type}")


def item_totals_in_tasks(texts: DataFrame, id_col: str, text_col: str, measure: str, held: list[tuple], item: str, item_type: str, token: str, best: int) -> DataFrame:
    """Per item and task: the texts that hold a keyword of it, the sum of their measure (a long), the greatest strength, and
    the best texts (strength, measure, id; ties to the greater measure, nulls last, then to the smaller id) as ``top``.

    Strengths are as from item_strengths. What leaves a task is a row an item, so nothing that grows with the texts is shuffled.
    """

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = HeldItems(held, token)
        n = len(of.items)
        texts_of, sums, sized = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        bar = np.zeros(n, np.int64)  # strength of the last of an item's best texts, once there are enough
        top: list[list[tuple]] = [[] for _ in range(n)]
        for batch in batches:
            for key, x, size in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                items, strengths = of.strengths(x.as_py())
                texts_of[items] += 1
                if size is not None:
                    sums[items] += size
                    sized[items] = True
                may = strengths >= bar[items]
                for i, strength in zip(items[may].tolist(), strengths[may].tolist(), strict=True):
                    place = (-strength, size is None, -(size or 0), key, size)
                    if len(top[i]) == best and place[:4] > top[i][-1][:4]:
                        continue
                    top[i] = sorted([*top[i], place], key=lambda p: p[:4])[:best]
                    bar[i] = -top[i][-1][0] if len(top[i]) == best else 0
        met = np.flatnonzero(texts_of).tolist()
        tops = [[{"strength": -p[0], "measure": p[4], "id": p[3]} for p in top[i]] for i in met]
        kind = pa.list_(pa.struct([("strength", pa.int64()), ("measure", pa.int64()), ("id", pa.int64())]))
        columns = [pa.array([of.items[i] for i in met]), pa.array(texts_of[met]), pa.array([int(sums[i]) if sized[i] else None for i in met], pa.int64())]
        if met:
            yield pa.RecordBatch.from_arrays([*columns, pa.array(tops, kind)], [item, "texts", "measure", "top"])

    return texts.select(F.col(id_col).cast("bigint"), text_col, F.col(measure).cast("bigint")).mapInArrow(
        total, f"{item} {item_type}, texts bigint, measure bigint, top array<struct<strength:bigint,measure:bigint,id:bigint>>"
    )


def code_keys(df: DataFrame, id_cols: Sequence[str], codes: Column, prefix_lengths: Sequence[int]) -> DataFrame:
    """Long table of the keys a code offers: itself, and each configured prefix."""
    kinds = [F.struct(F.lit("code_exact").alias("match_type"), F.col("code").alias("match_key"))]
    for n in prefix_lengths:
        kinds.append(
            F.struct(
                F.lit(f"code_prefix_{n}").alias("match_type"),
                F.when(F.length("code") >= n, F.substring("code", 1, n)).alias("match_key"),
            )
        )
    long = df.select(*id_cols, F.explode(codes).alias("code")).select(*id_cols, F.explode(F.array(*kinds)).alias("m"))
    return long.select(*id_cols, "m.*").filter(F.col("match_key").isNotNull()).distinct()


def counts_by_key(wanted: DataFrame, offered: DataFrame, owner: str, sums: Sequence[str] = ()) -> DataFrame:
    """match_type, rows and sums of the wanted rows that meet each owner by a key: wanted rows are counted per key before any
    owner is joined. wanted: match_type, match_key and sums, one row per row and key; offered: owner and one key of each type."""
    totals = [F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in sums]]
    per_key = wanted.groupBy("match_type", "match_key").agg(*totals)
    return offered.join(per_key, ["match_type", "match_key"]).select(owner, "match_type", "rows", *sums)


def counts_either_way(wanted: DataFrame, offered: DataFrame, listed: DataFrame, owner: str, row_id: str, sums: Sequence[str]) -> DataFrame:
    """rows and sums of the rows that meet each owner by its key or by a listed pair, each row once.

    Rows are counted per key before owners are joined, listed pairs are counted as they are, and what meets both ways is taken
    off: pairs (owner, row id, sums) whose row has the owner's key. wanted: row id, match_key, sums, distinct; offered: owner and
    its one match_key; listed: owner, row id, sums, distinct.
    """
    totals = [F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in sums]]
    by_key = offered.join(wanted.groupBy("match_key").agg(*totals), "match_key").select(owner, "rows", *sums)
    by_pair = listed.groupBy(owner).agg(*totals)
    both = listed.join(offered, owner).join(wanted.select(row_id, "match_key"), [row_id, "match_key"], "left_semi").groupBy(owner).agg(*totals)
    off = both.select(owner, *[(-F.col(c)).alias(c) for c in ("rows", *sums)])
    return by_key.unionByName(by_pair).unionByName(off).groupBy(owner).agg(*[F.sum(c).alias(c) for c in ("rows", *sums)])


#: Comes after every character that names hold.
AFTER_ALL = "\U0010ffff"


def prefix_suggestions(local: DataFrame, profiles: DataFrame, min_length: int, max_candidates: int) -> DataFrame:
    """Per local name, the profiles of which one name starts with the other, if there are few enough.

    In sorted order, all profiles that start with a name lie between the name and the name with a last character added, and the
    profiles that a name starts with are those whose own such interval holds it. So profiles, and both ends of all intervals, are
    put in one order; how many profiles and how many ends come before a row is a running count, and both numbers of matches are
    differences of such counts. Only names within the limit list their candidates: the places of their interval, and the
    profiles among their own beginnings.
    """
    profiles = cut_lineage(profiles.select(F.col("name").alias("profile")).filter(F.length("profile") >= min_length).distinct(), "profile-names")
    local = cut_lineage(local.select("name").filter(F.length("name") >= min_length).distinct(), "local-names")
    # kinds at one place: ends of profiles, lower ends of names, profiles; upper ends of names come behind all that start so
    rows = [
        profiles.select(F.col("profile").alias("at"), F.lit(2).alias("kind"), F.lit(None).cast("string").alias("name")),
        profiles.select(F.concat("profile", F.lit(AFTER_ALL)).alias("at"), F.lit(0).alias("kind"), F.lit(None).cast("string").alias("name")),
        local.select(F.col("name").alias("at"), F.lit(1).alias("kind"), "name"),
        local.select(F.concat("name", F.lit(AFTER_ALL)).alias("at"), F.lit(3).alias("kind"), "name"),
    ]
    placed = cut_lineage(_running_counts(reduce(lambda a, b: a.unionByName(b), rows)), "ranked-names")
    starts, ends = F.col("before_2"), F.col("before_0")
    low = placed.filter("kind = 1").select("name", starts.alias("first"), (starts - ends).alias("shorter"))
    high = placed.filter("kind = 3").select("name", starts.alias("last"))
    counted = low.join(high, "name").withColumn("longer", F.col("last") - F.col("first")).withColumn("n", F.col("longer") + F.col("shorter"))
    counted = cut_lineage(counted, "counted-names")
    few = counted.filter((F.col("n") > 0) & (F.col("n") <= max_candidates))
    ranked = placed.filter("kind = 2").select(F.col("at").alias("profile"), starts.alias("rank"))
    longer = few.filter("longer > 0").select("name", F.explode(F.sequence("first", F.col("last") - 1)).alias("rank")).join(ranked, "rank").select("name", "profile")
    sizes = F.sequence(F.lit(min_length), F.length("name") - 1)
    own = few.filter((F.col("shorter") > 0) & (F.length("name") > min_length)).select("name", F.explode(F.transform(sizes, lambda n: F.substring(F.col("name"), F.lit(1), n))).alias("profile"))
    shorter = own.join(profiles, "profile", "left_semi")
    found = longer.unionByName(shorter.select("name", "profile")).groupBy("name").agg(F.sort_array(F.collect_list("profile")).alias("candidates"))
    n = F.col("n")
    return counted.join(found, "name", "left").select(
        "name",
        n.alias("prefix_matches"),
        F.coalesce(F.array_join("candidates", "|"), F.lit("")).alias("candidates"),
        F.when(n == 1, F.element_at("candidates", 1)).alias("suggestion"),
    )


def _running_counts(rows: DataFrame) -> DataFrame:
    """rows (at, kind) with how many rows of kinds 0 and 2 come before each: counted in ranges of the order, and behind all
    earlier ranges."""
    placed = cut_lineage(rows.orderBy("at", "kind").withColumn("range", F.spark_partition_id()), "sorted-names")
    kinds = (0, 2)
    sizes = placed.groupBy("range").agg(*[F.count_if(F.col("kind") == k).alias(f"n{k}") for k in kinds])
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = sizes.select("range", *[F.coalesce(F.sum(f"n{k}").over(earlier), F.lit(0)).alias(f"o{k}") for k in kinds])
    inside = Window.partitionBy("range").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, -1)
    told = placed.join(F.broadcast(offsets), "range")
    return told.select("at", "kind", "name", *[(F.col(f"o{k}") + F.coalesce(F.count(F.when(F.col("kind") == k, 1)).over(inside), F.lit(0))).alias(f"before_{k}") for k in kinds])


def unique_match(local: DataFrame, reviewed: DataFrame, profiles: DataFrame, local_id: str, name: Sequence[str], code: str) -> DataFrame:
    """National code from the reviewed map, else from exactly one profile of that name, else a reason."""
    per_name = profiles.groupBy(*name).agg(F.count(F.lit(1)).alias("n"), F.min(code).alias("_by_name"))
    joined = local.join(reviewed.select(local_id, F.col(code).alias("_reviewed")), local_id, "left").join(per_name, list(name), "left")
    reason = first_match(
        [(F.col("_reviewed").isNotNull(), "reviewed"), (F.col("n").isNull(), "no_name_match"), (F.col("n") > 1, "ambiguous_name")],
        "unique_name",
    )
    return joined.select(
        *local.columns,
        F.coalesce("_reviewed", F.when(F.col("n") == 1, F.col("_by_name"))).alias(code),
        reason.alias("match_reason"),
    )


def covered_by_either(rows: DataFrame, facts: DataFrame, id_col: str, code: str, name: str, city: str, nationwide) -> DataFrame:
    """Ids whose code or name has a fact in their city or nationwide: four equi-joins, then distinct."""
    anywhere = facts.filter(F.col(city) == nationwide)
    parts = []
    for key in (code, name):
        parts.append(rows.join(facts.select(key, city).dropna().distinct(), [key, city], "left_semi").select(id_col))
        parts.append(rows.join(anywhere.select(key).dropna().distinct(), key, "left_semi").select(id_col))
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def token_overlap(left: DataFrame, right: DataFrame, scope: Sequence[str], min_shared: int, min_score: float) -> DataFrame:
    """Pairs of names of a scope that share enough tokens.

    Two names with ``min_shared`` common tokens must meet in the first ``size - min_shared + 1``
    tokens of both when the rarest come first. Only those are joined, so the commonest tokens of
    a scope do not pair everything; the survivors are then checked on their full token lists.
    """
    scope = list(scope)

    def exploded(df: DataFrame, name: str, tokens: str) -> DataFrame:
        return df.select(*scope, name, F.explode(tokens).alias("token"))

    both = exploded(left, "p_name", "p_tokens").select(*scope, "token").unionByName(exploded(right, "c_name", "c_tokens").select(*scope, "token"))
    frequency = both.groupBy(*scope, "token").agg(F.count(F.lit(1)).alias("_n"))

    def rarest(df: DataFrame, name: str, tokens: str) -> DataFrame:
        ranked = exploded(df, name, tokens).join(frequency, [*scope, "token"]).groupBy(*scope, name)
        ordered = ranked.agg(F.array_sort(F.collect_list(F.struct("_n", "token"))).alias("_t"))
        head = F.slice("_t", 1, F.greatest(F.size("_t") - min_shared + 1, F.lit(0)))
        all_tokens = F.transform("_t", lambda x: x["token"]).alias(tokens)
        return ordered.select(*scope, name, all_tokens, F.explode(F.transform(head, lambda x: x["token"])).alias("token"))

    met = rarest(left, "p_name", "p_tokens").join(rarest(right, "c_name", "c_tokens"), [*scope, "token"])
    common = F.size(F.array_intersect("p_tokens", "c_tokens"))
    enough = (common >= min_shared) & (common / F.least(F.size("p_tokens"), F.size("c_tokens")) >= min_score)
    return met.filter(enough).select(*scope, "p_name", "c_name").distinct()


GRAM = 3


def contained_names(short: DataFrame, long: DataFrame, scope: Sequence[str]) -> DataFrame:
    """scope, short, long: every name of long that holds a name of short, inside a scope; both distinct.

    Each shorter name is posted once, under the one of its three-character pieces that the fewest longer names of the scope have
    (a name of fewer characters: itself). Longer names ask with their distinct pieces and hold what they find if it really is
    inside, so that a longer name meets no more postings than share one of its pieces, rare as they are.
    """
    scope = list(scope)

    def pieces(df: DataFrame, name: str, sizes) -> DataFrame:
        n = F.length(name)
        cut = lambda k: F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(F.col(name), i, F.lit(k))))
        listed = F.array_distinct(F.flatten(F.filter(F.array(*map(cut, sizes)), lambda x: x.isNotNull())))
        return df.filter(n > 0).select(*scope, name, F.explode(listed).alias("piece"))

    asked = pieces(long, "long", range(1, GRAM + 1))
    frequency = asked.groupBy(*scope, "piece").agg(F.count(F.lit(1)).alias("n"))
    whole = F.length("short") < GRAM
    own = pieces(short.filter(~whole), "short", [GRAM]).unionByName(short.filter(whole & (F.length("short") > 0)).select(*scope, "short", F.col("short").alias("piece")))
    posted = own.join(frequency, [*scope, "piece"], "left").groupBy(*scope, "short")
    # a piece that no longer name has is the rarest of all
    posted = posted.agg(F.min_by("piece", F.struct(F.coalesce("n", F.lit(0)), "piece")).alias("piece"))
    return asked.join(posted, [*scope, "piece"]).filter(F.col("long").contains(F.col("short"))).select(*scope, "short", "long")


def name_cascade(
    package: DataFrame,
    core: DataFrame,
    scope: Sequence[str],
    tokens: Column,
    min_shared: int,
    min_score: float,
) -> DataFrame:
    """Best kind of name match per package name inside a scope: exact, contains, token overlap.

    Both sides are first reduced to distinct names (with row count and lowest code), so copies of a name cost one row. A kind is
    only looked for where no better one was found: exact matches are an equi-join, containment asks an index of rare pieces,
    overlap joins on rare tokens; none writes all pairs of a scope. Inputs have ``name`` and ``code``.
    """
    scope = list(scope)
    p = package.select(*scope, F.col("name").alias("p_name")).distinct()
    c = core.groupBy(*scope, F.col("name").alias("c_name")).agg(F.count(F.lit(1)).alias("c_rows"), F.min("code").alias("c_code"))
    key = [*scope, "p_name"]

    def counted(pairs: DataFrame, label: str) -> DataFrame:
        told = pairs.join(c, [*scope, "c_name"]).groupBy(*key).agg(F.sum("c_rows").alias("n"), F.min("c_code").alias("code"))
        hint = F.concat(F.when(F.col("n") == 1, "single_").otherwise("ambiguous_"), F.lit(label))
        return told.select(*key, hint.alias("match_hint"), F.when(F.col("n") == 1, F.col("code")).alias("matched_code"))

    exact = counted(p.select(*key, F.col("p_name").alias("c_name")), "exact")
    left = cut_lineage(p.join(exact, key, "left_anti"), "names-left")
    ours, theirs = left.select(*scope, F.col("p_name").alias("short")), c.select(*scope, F.col("c_name").alias("short"))
    inside_core = contained_names(ours, theirs.withColumnRenamed("short", "long"), scope).toDF(*scope, "p_name", "c_name")
    inside_package = contained_names(theirs, ours.withColumnRenamed("short", "long"), scope).toDF(*scope, "c_name", "p_name")
    # equal names, of which one would hold the other, are gone with the exact matches
    contains = cut_lineage(counted(inside_core.unionByName(inside_package), "contains"), "contained-names")
    left = left.join(contains, key, "left_anti")
    overlap = counted(
        token_overlap(
            left.select(*key, tokens(F.col("p_name")).alias("p_tokens")),
            c.select(*scope, "c_name", tokens(F.col("c_name")).alias("c_tokens")),
            scope,
            min_shared,
            min_score,
        ),
        "token_overlap",
    )
    named = exact.unionByName(contains).unionByName(overlap).withColumnRenamed("p_name", "name")
    return package.join(named, [*scope, "name"], "left").withColumn("match_hint", F.coalesce("match_hint", F.lit("no_match")))


def role_demand(roles: DataFrame, demand: DataFrame, major: str, role: str, city: str, measures: Sequence[str]) -> DataFrame:
    """Demand per major and city through the major's roles; demand is summed per role and city first."""
    grouped = demand.groupBy(role, city).agg(F.count(F.lit(1)).alias("demand_rows"), *[F.sum(m).alias(m) for m in measures])
    return (
        roles.select(major, role)
        .distinct()
        .join(grouped, role)
        .groupBy(major, city)
        .agg(F.count(F.lit(1)).alias("role_count"), F.sum("demand_rows").alias("demand_rows"), *[F.sum(m).alias(m) for m in measures])
    )


def enrich_cascade(rows: DataFrame, by_code: DataFrame, by_name: DataFrame, code: str, name: str, value: str, heuristic: Column) -> DataFrame:
    """A label by code, else by name, else by a rule on the row itself."""
    a = by_code.select(code, F.col(value).alias("_a"))
    b = by_name.select(name, F.col(value).alias("_b"))
    joined = rows.join(a, code, "left").join(b, name, "left")
    return joined.select(*rows.columns, F.coalesce("_a", "_b", heuristic).alias(value))
