"""Evidence from text: metric values near their names, scope tags, links, tables and catalogs."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions import vocabulary as vocab
from plumbline.rules import all_of, any_of, broadcast_rules, first_match

MAX_BEFORE = 8
#: Characters of a context that a candidate quotes.
QUOTE_LENGTH = 240
#: Names that are looked for one by one.
FEW_ALIASES = 64


def number_after(line: Column, start: Column, pattern: str) -> Column:
    """First number that begins at or after ``start`` (characters to skip), as text; null if none.

    The search sees one character before ``start``, so that a number cut there does not count.
    """
    tail = F.substring(line, F.greatest(start, F.lit(1)), F.length(line))
    lead = F.when(start > 0, F.regexp_extract(tail, rf"(?s)^.+?{pattern}", 1)).otherwise(F.regexp_extract(line, pattern, 1))
    return F.nullif(lead, F.lit(""))


def nearest_in_range(line: Column, start: Column, end: Column, low: float, high: float, max_distance: int = MAX_BEFORE) -> Column:
    """Number from low to high that belongs to an alias: the next one after it, else the last one that ends close before it.

    Numbers out of range are passed over, however near they are.
    """
    numbers = F.regexp_extract_all(line, F.lit(vocab.NUMBER), F.lit(1))
    pieces = F.split(line, vocab.NUMBER)
    # where each number begins: what stands before it, numbers and all
    number = F.struct(F.lit(0).alias("begin"), F.lit(0).alias("end"), F.lit("").alias("text"))
    step = lambda acc, x: F.concat(acc, F.array(F.struct((F.element_at(acc, -1)["end"] + F.length(x["before"])).alias("begin"), (F.element_at(acc, -1)["end"] + F.length(x["before"]) + F.length(x["text"])).alias("end"), x["text"].alias("text"))))
    listed = F.zip_with(F.slice(pieces, F.lit(1), F.size(numbers)), numbers, lambda a, b: F.struct(a.alias("before"), b.alias("text")))
    placed = F.aggregate(listed, F.array(number), step)
    usable = F.filter(placed, lambda x: x["text"].try_cast("double").between(low, high))
    after = F.get(F.filter(usable, lambda x: x["begin"] >= end), F.lit(0))["text"]
    before = F.try_element_at(F.filter(usable, lambda x: (x["end"] < start) & (start - 1 - x["end"] <= max_distance)), F.lit(-1))["text"]
    return F.coalesce(after, before).try_cast("double")


def number_before(line: Column, start: Column, pattern: str, max_distance: int = MAX_BEFORE) -> Column:
    """Last number that ends at most ``max_distance`` characters before ``start``."""
    head = F.substring(line, F.lit(1), start)
    found = F.regexp_extract_all(head, F.lit(pattern), F.lit(1))
    gap = F.length(F.element_at(F.split(head, pattern), -1))
    return F.when((F.size(found) > 0) & (gap <= max_distance), F.element_at(found, -1))


def nearest_value(line: Column, alias: Column, unit: str) -> Column:
    """The number that belongs to the alias: the next one after it, else a close one before it.

    Ratios must be percentages inside the same clause and are returned as shares.
    """
    start = F.instr(line, alias)
    end = start + F.length(alias) - 1
    if unit == "ratio":
        rest = F.substring(line, end + 1, F.length(line))
        own = F.element_at(F.split(rest, vocab.CLAUSE_END), 1)
        clause = F.concat(F.substring(line, F.lit(1), end), own)
        plain = F.coalesce(number_after(clause, end, vocab.PERCENT), number_before(clause, end, vocab.PERCENT))
        glued = F.nullif(F.regexp_extract(own, r"^\s*\d{1,6}(\d{1,2}\.\d+)\s*%", 1), F.lit(""))
        between = F.regexp_extract(own, rf"(?s)^(.*?){vocab.PERCENT}", 1)
        crosses = any_of(alias.contains(x) for x in vocab.RATE_NAMES) & any_of(between.contains(x) for x in vocab.OTHER_METRIC_WORDS)
        before = F.substring(line, F.greatest(start - 4, F.lit(1)), F.least(start - 1, F.lit(4)))
        narrow = ~any_of(before.contains(x) for x in vocab.BROAD_ALIAS_NOT_AFTER) & rest.rlike(vocab.BROAD_ALIAS_FOLLOWED_BY)
        readable = ~crosses & ((alias != vocab.BROAD_ALIAS) | narrow)
        return F.when(readable, F.coalesce(plain, glued).try_cast("double") / 100.0)
    if unit == "score":
        return nearest_in_range(line, start, end, 0, 100)
    return F.coalesce(number_after(line, end, vocab.NUMBER), number_before(line, end, vocab.NUMBER)).try_cast("double")


def metric_rules(spark: SparkSession, metrics: Sequence[Mapping[str, object]]) -> DataFrame:
    """A row for each name of a metric: alias, its place among the metric's names, and what the metric asks of a context."""
    rows = []
    for m in metrics:
        words = [list(m.get(k, [])) for k in ("required_context_any", "blocked_context_any")]
        for place, alias in enumerate(dict.fromkeys([str(m["label"]), *m.get("aliases", [])])):
            rows.append((alias, place, str(m["metric_key"]), str(m.get("unit", "")), *words))
    return spark.createDataFrame(rows, "alias string, place int, metric_key string, unit string, required array<string>, blocked array<string>")


def metric_candidates(
    lines: DataFrame, id_cols: Sequence[str], metrics: Sequence[Mapping[str, object]], scope: Column | None = None
) -> DataFrame:
    """Candidate values from context lines (columns line_no, line, context).

    A metric applies to a line that holds its label or one of its aliases and whose context is allowed. The aliases that a line
    holds become rows, which are joined to the metrics' rules by equality, so the plan is the same for any number of metrics. Of a
    metric's aliases in a line the first of its list counts; equal candidates of a page keep the first line.
    """
    rules = metric_rules(lines.sparkSession, metrics)
    aliases = sorted({alias for m in metrics for alias in (str(m["label"]), *m.get("aliases", []))})
    # which lines hold a name at all: a few are looked for one by one, many by one pattern
    few = len(aliases) <= FEW_ALIASES
    named = any_of(F.col("line").contains(x) for x in aliases) if few else F.col("line").rlike("|".join(map(re.escape, aliases)))
    held = F.filter(F.lit(aliases) if aliases else F.array().cast("array<string>"), lambda x: F.col("line").contains(x))
    hits = lines.filter(named).select(*id_cols, "line_no", "context", F.explode(held).alias("alias")).join(broadcast_rules(rules, sum(1 + len(m.get("aliases", [])) for m in metrics)), "alias")
    context = F.col("context")
    any_in = lambda words: F.exists(words, lambda x: context.contains(x))
    plain = F.regexp_replace("context", r"\s+", "")
    evaluation = any_of(all_of(plain.contains(x) for x in words) for words in vocab.EVALUATION_CONTEXT)
    # a metric's first alias in a line is its name there, whether a value follows it or not
    first = hits.groupBy(*id_cols, "line_no", "metric_key").agg(F.min_by(F.struct("alias", "place", "unit", "required", "blocked", "context"), "place").alias("f"))
    allowed = first.select(*id_cols, "line_no", "metric_key", "f.*").filter(~any_in("blocked") & ((F.size("required") == 0) | any_in("required")) & ~evaluation)
    units = sorted({str(m.get("unit", "")) for m in metrics})
    value = first_match([(F.col("unit") == unit, nearest_value(context, F.col("alias"), unit)) for unit in units])
    read = allowed.withColumn("candidate_value", value).filter(F.col("candidate_value").isNotNull()).withColumn("evidence_quote", F.substring("context", 1, QUOTE_LENGTH))
    confidence = F.when(F.col("place") == 0, "medium").otherwise("low").alias("confidence")
    flat = read.select(*id_cols, "line_no", "evidence_quote", "metric_key", F.col("unit").alias("metric_unit"), "candidate_value", F.col("alias").alias("match_alias"), confidence)
    key = [*id_cols, "metric_key", "candidate_value", "evidence_quote"]
    kept = flat.groupBy(*key).agg(F.min_by(F.struct("line_no", "metric_unit", "match_alias", "confidence"), F.col("line_no")).alias("f")).select(*key, "f.*")
    return kept.withColumn("metric_scope", scope_tags(F.col("evidence_quote"), vocab.SCOPE_RULES) if scope is None else scope)


def scope_tags(quote: Column, rules: Sequence[Sequence], sep: str = "，") -> Column:
    """Distinct tags in the order of the rules.

    A rule is a list of (words, tag), of which the first with a word in the quote applies, or a pattern with one group and the
    tag of its first match, in which {} stands for what the group holds.
    """

    def tag(rule) -> Column:
        if not isinstance(rule[0], str):
            return first_match([(any_of(quote.contains(w) for w in words), tag) for words, tag in rule])
        held = F.regexp_extract(quote, rule[0], 1)
        before, _, after = rule[1].partition("{}")
        text = F.concat(F.lit(before), held, F.lit(after)) if "{}" in rule[1] else F.lit(rule[1])
        return F.when(held != "", text)

    return F.array_join(F.array_distinct(F.array_compact(F.array(*[tag(rule) for rule in rules]))), sep)


class _Cells(HTMLParser):
    """Cell texts of every table row; rows without text are left out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[str]] = []
        self.row: list[str] | None = None
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.row = []
        elif tag in ("td", "th") and self.row is not None:
            self.cell = []

    def handle_data(self, data):
        if self.cell is not None and data.strip():
            self.cell.append(data.strip())

    def handle_endtag(self, tag):
        if tag in ("td", "th") and self.cell is not None:
            self.row.append(" ".join(" ".join(self.cell).split()))
            self.cell = None
        elif tag == "tr" and self.row is not None:
            if any(self.row):
                self.rows.append(self.row)
            self.row = None


def html_table_rows(pages: DataFrame, id_col: str, html: str) -> DataFrame:
    """Rows of all tables of each page as arrays of cell texts, numbered within the page.

    Pages are dealt out by id first: a small file holds millions of short pages, and would be parsed in one task.
    """
    id_type = pages.schema[id_col].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, numbers, cells = [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                parser = _Cells()
                parser.feed(text or "")
                at += [i] * len(parser.rows)
                numbers += range(len(parser.rows))
                cells += parser.rows
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(numbers, pa.int32()), pa.array(cells, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "row_no", "cells"])

    dealt = pages.select(id_col, html).repartition(id_col)
    return dealt.mapInArrow(parse, f"{id_col} {id_type}, row_no int, cells array<string>")


def code_name_rows(rows: DataFrame, id_col: str, pattern: str = vocab.OCCUPATION_CODE) -> DataFrame:
    """Code cell and the next cell that is a name; the first row of a code counts."""
    code = F.element_at(F.filter("cells", lambda c: c.rlike(pattern)), 1)
    place = F.array_position("cells", F.col("code")).cast("int")
    after = F.slice("cells", place + 1, F.size("cells"))
    name = F.filter(after, lambda c: (c != "") & ~c.rlike("^[0-9]+$") & ~c.rlike(pattern))
    coded = rows.withColumn("code", F.when(F.size(F.filter("cells", lambda c: c.rlike(pattern))) > 0, code)).filter(F.col("code").isNotNull())
    named = coded.withColumn("name", F.get(name, 0)).filter(F.col("name").isNotNull())
    first = named.groupBy(id_col, "code").agg(F.min_by("name", "row_no").alias("name"))
    return first.withColumn("level", F.size(F.split("code", "-")))


def ranking_rows(pages: DataFrame, id_col: str, text: str, pattern: str = vocab.RANKING_SENTENCE, separator: str = vocab.RANKING_SEPARATOR) -> DataFrame:
    """Ranked names of a page's ranking sentence, with the announced number beside the number found."""
    compact = F.regexp_replace(F.regexp_replace(text, "<[^>]*>", ""), r"\s+", "")
    read = pages.select(id_col, F.regexp_extract(compact, pattern, 1).try_cast("int").alias("declared_count"), F.regexp_extract(compact, pattern, 2).alias("_items"))
    names = F.filter(F.split("_items", separator), lambda x: x != "")
    listed = read.filter(F.col("_items") != "").withColumn("_names", names)
    out = listed.select(id_col, "declared_count", F.size("_names").alias("found_count"), F.posexplode("_names").alias("_pos", "name"))
    return out.select(id_col, (F.col("_pos") + 1).alias("rank"), "name", "declared_count", (F.col("found_count") < F.col("declared_count")).alias("count_mismatch"))


CHUNK_LINES = 4096


def carry_down(lines: DataFrame, doc: Sequence[str], line_no: str, marks: Mapping[str, Column]) -> DataFrame:
    """Each mark's last non-null value at or above the line.

    Lines are taken in chunks of line numbers: inside a chunk a window carries the value, and
    between chunks a window over one row per chunk does, so a long document is many tasks.
    """
    marked = lines.select("*", *[c.alias(f"_m_{k}") for k, c in marks.items()]).withColumn("_chunk", F.floor(F.col(line_no) / CHUNK_LINES))
    chunk = [*doc, "_chunk"]
    last = [F.max_by(f"_m_{k}", F.when(F.col(f"_m_{k}").isNotNull(), F.col(line_no))).alias(f"_l_{k}") for k in marks]
    ends = marked.groupBy(*chunk).agg(*last)
    before = Window.partitionBy(*doc).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*chunk, *[F.last(f"_l_{k}", True).over(before).alias(f"_c_{k}") for k in marks])
    inside = Window.partitionBy(*chunk).orderBy(line_no).rowsBetween(Window.unboundedPreceding, 0)
    joined = marked.join(carried, chunk)
    out = joined.select(*lines.columns, *[F.coalesce(F.last(f"_m_{k}", True).over(inside), F.col(f"_c_{k}")).alias(k) for k in marks])
    return out


def catalog_rows(lines: DataFrame, doc: Sequence[str], line_no: str, text: str) -> DataFrame:
    """Majors of a catalog with the category and class above them; a new category clears the class."""
    t = F.col(text)
    category = F.when(t.rlike(vocab.CATEGORY_LINE), F.regexp_extract(t, vocab.CATEGORY_LINE, 1))
    class_name = F.when(category.isNotNull(), F.lit("")).when(t.rlike(vocab.CLASS_LINE), F.regexp_extract(t, vocab.CLASS_LINE, 2))
    carried = carry_down(lines, doc, line_no, {"major_category": category, "major_class": class_name})
    name = F.regexp_extract(t, vocab.MAJOR_LINE, 2)
    note = F.regexp_extract(name, vocab.MAJOR_NOTE, 1)
    usable = t.rlike(vocab.MAJOR_LINE) & (F.col("major_category") != "") & (F.col("major_class") != "")
    return carried.filter(usable).select(
        *doc,
        F.regexp_extract(t, vocab.MAJOR_LINE, 1).alias("major_code"),
        F.trim(F.regexp_replace(name, vocab.MAJOR_NOTE, "")).alias("major_name"),
        "major_category",
        "major_class",
        F.when(note != "", note).otherwise(F.concat("major_category", F.lit(vocab.DEGREE_SUFFIX))).alias("degree_type"),
    )


def section_rows(lines: DataFrame, doc: Sequence[str], line_no: str, first_cell: str) -> DataFrame:
    """Numbered rows with the section name above them; a section line is a name before a parenthesis."""
    c = F.trim(F.col(first_cell))
    is_number = c.rlike(r"^\d+(\.\d+)?$")
    section = F.when(~is_number & c.rlike(vocab.SECTION_LINE), F.regexp_extract(c, vocab.SECTION_LINE, 1))
    return carry_down(lines, doc, line_no, {"section": section}).filter(is_number)


def distribution_rows(lines: DataFrame, doc: Sequence[str], line_no: Sequence[str], text: str) -> DataFrame:
    """Score rows printed in lines (several per line possible); the last one of a score counts. Headings and page numbers are no rows."""
    noise = any_of([*(F.trim(text).startswith(x) for x in vocab.DISTRIBUTION_NOISE_STARTS), *(F.col(text).contains(x) for x in vocab.DISTRIBUTION_NOISE)])
    lines = lines.filter(~F.coalesce(noise, F.lit(True)))

    def group(i: int) -> Column:
        return F.regexp_extract_all(text, F.lit(vocab.DISTRIBUTION_ROW), F.lit(i))

    found = F.arrays_zip(group(1).alias("score"), group(2).alias("count"), group(3).alias("rank"))
    rows = lines.select(*doc, *line_no, F.posexplode(found).alias("_at", "r"))

    def number(name: str) -> Column:
        return F.regexp_replace(F.col(f"r.{name}"), ",", "").try_cast("bigint")

    typed = rows.select(*doc, number("score").alias("score"), F.struct(number("count").alias("score_count"), number("rank").alias("cumulative_rank")).alias("v"), F.struct(*line_no, "_at").alias("_o"))
    return typed.groupBy(*doc, "score").agg(F.max_by("v", "_o").alias("v")).select(*doc, "score", "v.*")


def printed_numbers(text: Column) -> Column:
    """Numbers of a printed row; digits that ran together are split where the row layout says so."""
    plain = F.translate(text, "，.。", ",,,")
    tokens = F.transform(F.regexp_extract_all(plain, F.lit(r"\d[\d,]*"), F.lit(0)), lambda x: F.btrim(x, F.lit(",")))

    def split(x: Column) -> Column:
        digits = F.regexp_replace(x, ",", "")
        stuck = r"^(\d{1,3})(\d{2}),(\d{3})$"
        is_stuck = (F.instr(x, ",") > 4) & x.rlike(stuck)
        run = (F.instr(x, ",") == 0) & F.length(x).isin(6, 7)
        pieces = (
            F.when(is_stuck, F.array(F.regexp_extract(x, stuck, 1), F.concat(F.regexp_extract(x, stuck, 2), F.regexp_extract(x, stuck, 3))))
            .when(run, F.array(F.substring(x, 1, 3), F.substring(x, F.lit(4), F.length(x))))
            .otherwise(F.array(digits))
        )
        return F.transform(pieces, lambda p: p.try_cast("bigint"))

    return F.flatten(F.transform(tokens, split))


def lookalike_numbers(text: Column) -> Column:
    """Numbers of a recognised cell after letters that look like digits are read as digits."""
    plain = F.translate(F.translate(text, *vocab.DIGIT_LOOKALIKES), ",，", "")
    return F.transform(F.regexp_extract_all(plain, F.lit(r"\d+"), F.lit(0)), lambda x: x.try_cast("bigint"))


def pick_count(numbers: Column, strategy: str = "smallest_positive") -> Column:
    """One count from the numbers of a cell."""
    positive = F.filter(numbers, lambda x: x > 0)
    return F.array_min(positive) if strategy == "smallest_positive" else F.try_element_at(positive, F.lit(-1))


def quote(parts: Sequence[Column], limit: int = 180) -> Column:
    """Parts as one quote, cut with a mark when too long."""
    text = F.concat(*parts)
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit - 3), F.lit("..."))).otherwise(text)
