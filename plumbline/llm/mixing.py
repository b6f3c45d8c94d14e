"""Mixing sources to target weights along a low-discrepancy schedule.

Every source's documents are shuffled by a hash and laid end to end; its stream of words, read twice over at most, is cut into
blocks of equal length. Slot n of the schedule holds the n-th golden-ratio point, and the source into whose share of the
cumulative weights that point falls. Slots are ranked within their source, and the k-th slot of a source takes its k-th block.
So every stretch of the schedule holds the sources in nearly their target shares, and each source is taken up to its target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import cut_lineage

#: Weights of sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words that the mix has for each word there is, and how often a source's words are taken at most.
BUDGET = 1.5
EPOCHS = 2
#: Words in a block at least, and blocks in a mix at most.
BLOCK_WORDS = 256
MAX_BLOCKS = 1 << 20
#: Documents that are laid end to end in one window, in expectation, and slots that are ranked in one.
BUCKET_DOCS = 4000
RANGE_SLOTS = 4096
SEED = 20
GOLDEN = (5**0.5 - 1) / 2
WORD = r"([^\x20\x09-\x0D]+)"


def row_keys() -> tuple[Column, Column]:
    """Numbers of a document's id and text, by which documents are shuffled, and of its text and source."""
    return F.xxhash64(F.col("doc_id"), F.lit(SEED), F.col("text")).alias("__key"), F.xxhash64("text", "source").alias("__tie")


def sized(docs: DataFrame, *keep: str) -> DataFrame:
    """keep columns of docs, source, size (words of the text; null: 0), and the keys that shuffle documents."""
    size = F.coalesce(F.size(F.regexp_extract_all("text", F.lit(WORD), 1)), F.lit(0)).cast("bigint")
    own = [F.col(f"`{c}`") for c in dict.fromkeys([*keep, "doc_id", "source"])]
    return docs.select(*own, size.alias("__size"), *row_keys())


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, epochs: int = EPOCHS) -> DataFrame:
    """source, source_size, weight, target, from source and source_size; one row per source.

    Sources share budget times all words by weight. None gets more than epochs times its size: with sources in ascending order
    of that limit per weight, those up to some place get their limit and the others share the rest by weight. Windows over all
    rows see one row per source.
    """
    order = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (order % len(weights) + 1).cast("int")).cast("double")
    limited = sizes.withColumn("weight", weight).withColumn("limit", F.col("source_size").cast("double") * epochs)
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.asc_nulls_last("source"))
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(everything) * budget - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    levelled = limited.withColumn("level", rest / open_weight)
    # the first source that stays below its limit sets the level of all after it
    below = F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))
    level = F.first(below, ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    share = F.least("limit", F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    return levelled.select("source", "source_size", "weight", share.alias("target"))


def laid_out(docs: DataFrame, *keep: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of docs (doc_id, or the keep columns) with source number, target, and the place of their first word in their source's
    stream: first without, then with the keep columns; and the sources.

    Documents of a source lie in the order of a hash. The place is the running sum of sizes within a bucket of that order, behind
    all earlier buckets; so a source with most of the rows is many windows. Texts are read once for their sizes, and once more
    only if columns besides doc_id and source are kept.
    """
    narrow = cut_lineage(sized(docs), "sizes")
    total = narrow.agg(F.count("*").alias("n")).first()["n"]
    bucket = F.pmod(F.col("__key"), F.lit(max(1, -(-total // BUCKET_DOCS))))
    sources = targets(narrow.groupBy("source").agg(F.sum("__size").alias("source_size")))
    numbered = Window.orderBy(F.asc_nulls_last("source"))
    sources = cut_lineage(sources.withColumn("sid", F.row_number().over(numbered)).withColumn("words", F.floor(F.col("target") + 0.5).cast("bigint")), "sources")
    filled = narrow.groupBy("source", bucket.alias("__bucket")).agg(F.sum("__size").alias("inside"))
    before = Window.partitionBy("source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = filled.select("source", "__bucket", F.coalesce(F.sum("inside").over(before), F.lit(0)).alias("__offset"))
    offsets = offsets.join(sources, offsets["source"].eqNullSafe(sources["source"])).select(
        offsets["source"].alias("__source"), F.col("__bucket").alias("__of"), "__offset", "sid", "source_size", "target", "words"
    )
    offsets = cut_lineage(offsets, "offsets")

    def placed(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("__bucket", bucket)
        found = rows.join(offsets, rows["source"].eqNullSafe(F.col("__source")) & (F.col("__bucket") == F.col("__of"))).drop("__source", "__of")
        inside = Window.partitionBy("sid", "__bucket").orderBy("__key", "doc_id", "__size", "__tie").rowsBetween(Window.unboundedPreceding, -1)
        first = F.col("__offset") + F.coalesce(F.sum("__size").over(inside), F.lit(0))
        return found.withColumn("__first", first).drop("__bucket", "__offset")

    slim = placed(narrow)
    return slim, slim if set(keep) <= {"doc_id", "source"} else placed(sized(docs, *keep)), sources


def schedule(sources: DataFrame, block: int) -> DataFrame:
    """slot, sid, block number: the mix in order. Sources have sid, target and words.

    Golden-ratio points may give a source a few slots more or fewer than its blocks; the surplus is left out, and what is
    missing is added at the end.
    """
    wanted = sources.filter("words > 0").withColumn("blocks", F.ceil(F.col("words") / block))
    last = Window.orderBy("sid")
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    high = F.sum("words").over(last) / F.sum("words").over(everything)
    shares = wanted.withColumn("high", high).withColumn("low", F.coalesce(F.lag("high").over(last), F.lit(0.0)))
    shares = cut_lineage(shares.select("sid", "blocks", "low", F.when(F.lead("sid").over(last).isNull(), F.lit(2.0)).otherwise(F.col("high")).alias("high")), "shares")
    found = shares.agg(F.sum("blocks").alias("slots"), F.count("*").alias("sources")).first()
    slots, cells = found["slots"] or 0, 4 * (found["sources"] or 1)
    point = (F.col("id") + 1) * GOLDEN
    points = sources.sparkSession.range(slots).select(F.col("id").alias("slot"), (point - F.floor(point)).alias("u"))
    # each share is listed in the cells that it touches, so that points find theirs by equality
    cell = lambda x: F.least(F.floor(x * cells), F.lit(cells - 1))
    listed = shares.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.col("high")))))
    drawn = points.withColumn("cell", cell(F.col("u"))).join(listed, "cell").filter("u >= low AND u < high")
    drawn = drawn.select("slot", "sid", F.floor(F.col("slot") / RANGE_SLOTS).alias("stretch"))
    counted = drawn.groupBy("sid", "stretch").agg(F.count("*").alias("inside"))
    earlier = Window.partitionBy("sid").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counted.withColumn("before", F.coalesce(F.sum("inside").over(earlier), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("sid", "stretch").orderBy("slot")) - 1
    ranked = drawn.withColumn("rank", rank).join(offsets.select("sid", "stretch", "before"), ["sid", "stretch"])
    ranked = ranked.select("slot", "sid", (F.col("before") + F.col("rank")).alias("block")).join(shares.select("sid", "blocks"), "sid")
    ranked = ranked.filter("block < blocks").drop("blocks")
    short = shares.join(counted.groupBy("sid").agg(F.sum("inside").alias("got")), "sid", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    missing = short.filter("got < blocks").select("sid", F.explode(F.sequence("got", F.col("blocks") - 1)).alias("block"))
    return ranked.unionByName(missing.select(F.lit(slots).cast("bigint").alias("slot"), "sid", "block"))


def pieces(placed: DataFrame, block: int) -> DataFrame:
    """sid, __first (of the document), epoch, block, start (word in the document) and words of every part of a document in a block."""
    read = placed.filter("__size > 0").select("sid", "__first", "__size", "source_size", "words")
    read = read.withColumn("epoch", F.explode(F.array(*map(F.lit, range(EPOCHS)))))
    low = F.col("epoch") * F.col("source_size") + F.col("__first")
    read = read.withColumn("low", low).withColumn("high", F.least(low + F.col("__size"), F.col("words"))).filter("low < high")
    cut = read.withColumn("block", F.explode(F.sequence(F.floor(F.col("low") / block), F.floor((F.col("high") - 1) / block))))
    start, end = F.greatest(F.col("low"), F.col("block") * block), F.least(F.col("high"), (F.col("block") + 1) * block)
    return cut.select("sid", "__first", "epoch", "block", (start - F.col("low")).alias("start"), (end - start).alias("piece"))


def block_words(sources: DataFrame) -> int:
    words = sources.agg(F.sum("words").alias("words")).first()["words"] or 0
    return max(BLOCK_WORDS, -(-words // MAX_BLOCKS))


def mix(docs: DataFrame, *keep: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents laid out (keep columns of docs, and how), the mix, and the sources.

    The mix has a row for each part of a document in it: slot, sid, __first (which name the document), epoch, start, piece
    (number of words). Documents without words lie in no block.
    """
    slim, placed, sources = laid_out(docs, *keep)
    block = block_words(sources)
    mixed = schedule(sources, block).join(pieces(slim, block), ["sid", "block"])
    return placed, mixed.select("slot", "sid", "__first", "epoch", "start", "piece"), sources


def _taken(docs: DataFrame, *keep: str) -> DataFrame:
    """keep columns, size, source_size, target, taken, __key and __tie of every row of docs."""
    placed, mixed, _ = mix(docs, *keep)
    summed = mixed.groupBy("sid", "__first").agg(F.sum("piece").alias("got")).select(F.col("sid").alias("of"), F.col("__first").alias("at"), "got")
    found = placed.join(summed, (F.col("sid") == F.col("of")) & (F.col("__first") == F.col("at")) & (F.col("__size") > 0), "left")
    taken = F.coalesce("got", F.lit(0)).cast("bigint")
    return found.select(*(F.col(f"`{c}`") for c in keep), F.col("__size").alias("size"), "source_size", "target", taken.alias("taken"), "__key", "__tie")


def with_taken(docs: DataFrame, *keep: str) -> DataFrame:
    """keep columns of docs, size, source_size, target, taken (words that the mix takes); one row per row of docs.

    docs: doc_id, text, source. Null sources are one source, the last. Null and wordless texts have size 0 and nothing taken.
    Repeated rows are documents of their own. Two runs over the same rows give the same.
    """
    return _taken(docs, *keep).drop("__key", "__tie")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix as documents, columns as in docs: each as often as the mix takes it whole, and once more cut off where it takes
    only the first words. Documents with nothing taken are left out. n_chars, if there, follows the text.

    What is taken is worked out on rows without texts, which are joined to it once. Rows that repeat id, text and source are mixed
    each for itself; what is taken of them carries the columns of the smallest one.
    """
    columns = docs.columns
    names = {c: f"__own_{i}" for i, c in enumerate(columns)}
    text, n_chars = names["text"], names.get("n_chars")
    key = ["__key", "__tie"]
    found = cut_lineage(_taken(docs, "doc_id", "source").select(*key, "size", "taken"), "taken")
    copies = F.transform(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size"))), lambda k: F.least(F.col("size"), F.col("taken") - (k - 1) * F.col("size")))
    parts = found.filter("taken > 0").select(*key, "size", F.explode(copies).alias("__words"))
    several = found.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*key)
    own = docs.select(*row_keys(), *(F.col(f"`{c}`").alias(names[c]) for c in columns))
    least = own.join(several, key, "left_semi").groupBy(*key).agg(F.min(F.struct(*names.values())).alias("least")).select(*key, "least.*")
    rows = own.join(several, key, "left_anti").unionByName(least).join(parts, key)
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), 1), F.lit(1), F.col("__words").cast("int")), "")
    rows = rows.withColumn(text, F.when(F.col("__words") < F.col("size"), head).otherwise(F.col(text)))
    if n_chars:
        rows = rows.withColumn(n_chars, F.length(text).cast(docs.schema["n_chars"].dataType))
    return rows.select(*(F.col(names[c]).alias(c) for c in columns))
