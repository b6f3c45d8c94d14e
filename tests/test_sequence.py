"""Sequence operators on small groups."""

from pyspark.sql import functions as F

from plumbline.operators import sequence as s

from .conftest import rows


def test_global_rank_equals_a_sort(spark):
    values = [(i, (i * 7919) % 101) for i in range(2000)]
    ranked = s.global_row_number(spark.createDataFrame(values, "id int, v int").repartition(7), [F.desc("v"), F.asc("id")], "rank")
    want = [i for i, _ in sorted(values, key=lambda x: (-x[1], x[0]))]
    assert [r.id for r in ranked.orderBy("rank").collect()] == want
    assert [r.rank for r in ranked.orderBy("rank").select("rank").collect()] == list(range(1, 2001))


#: One group each: rows from the top score down as (score, count, running count), and what comes out (limits 60, 100, 5.0).
REPAIRS = {
    "agreeing rows stay": ([(90, 3, 3), (89, 4, 7)], [(90, 3, 3, "kept"), (89, 4, 7, "kept")]),
    "count from the running count": ([(90, 3, 3), (89, None, 8)], [(90, 3, 3, "kept"), (89, 5, 8, "count_from_cumulative")]),
    "running count from the count": ([(90, 3, None), (89, 4, 7)], [(90, 3, 3, "cumulative_from_count"), (89, 4, 7, "kept")]),
    "a small difference corrects the count": ([(90, 3, 3), (89, 4, 12)], [(90, 3, 3, "kept"), (89, 9, 12, "count_by_cumulative")]),
    "a falling running count is replaced": ([(90, 30, 30), (89, 4, 20)], [(90, 30, 30, "kept"), (89, 4, 34, "cumulative_by_count")]),
    "a difference over the limit is replaced": ([(90, 3, 3), (89, 50, 93)], [(90, 3, 3, "kept"), (89, 50, 53, "cumulative_by_count")]),
    "a jump is replaced": ([(90, 3, 3), (89, 4, 507)], [(90, 3, 3, "kept"), (89, 4, 7, "cumulative_by_jump")]),
    "an implausible running count alone is passed over": ([(90, 3, 3), (89, None, 303), (88, 2, 5)], [(90, 3, 3, "kept"), (88, 2, 5, "kept")]),
    "a row without numbers is passed over": ([(90, 3, 3), (89, None, None), (88, 2, 5)], [(90, 3, 3, "kept"), (88, 2, 5, "kept")]),
    "scores are not bounded": ([(900, 1, 1), (751, 2, 3)], [(900, 1, 1, "kept"), (751, 2, 3, "kept")]),
}


def test_each_repair(spark):
    table = [(g, i, *row) for g, (given, _) in REPAIRS.items() for i, row in enumerate(given)]
    df = spark.createDataFrame(table, "g string, i int, score int, score_count long, cumulative_rank long")
    got = s.repair_cumulative(df, ["g"], ["i"], 60, 100, 5.0)
    want = [(g, *row) for g, (_, out) in REPAIRS.items() for row in out]
    assert rows(got, "g", "score", "score_count", "cumulative_rank", "action") == sorted(want, key=repr)


def test_what_a_repair_passes_over_is_counted(frame):
    schema = "g int, i int, score int, score_count long, cumulative_rank long"
    df = frame(schema, (1, 0, None, 1, 1), (1, 1, 800, 1, 1), (1, 2, 700, 1, 1), (1, 3, 700, 1, 1), (1, 4, 699, None, None), (1, 5, 800, 2, 2))
    assert rows(s.repair_skips(df, ["g"], (0, 750))) == [(1, 1, 2, 1, 1)]
    assert rows(s.repair_skips(df, ["g"])) == [(1, 1, 0, 2, 1)]


def test_check_passes_over_incomplete_rows(frame):
    df = frame("g int, score int, score_count long, cumulative_rank long", (1, 90, 3, 3), (1, 89, 4, None), (1, 88, 2, 5), (1, 87, 1, 9), (2, 5, None, None))
    assert rows(s.cumulative_check(df, ["g"], 3)) == [(1, 4, 1, 0, False, 1), (2, 1, 0, 0, True, 1)]


def test_first_row_of_a_score_counts(frame):
    df = frame("g int, i int, score int, score_count long, cumulative_rank long", (1, 2, 50, 9, 9), (1, 1, 50, 4, 4), (1, 3, 49, 2, None))
    assert rows(s.repair_cumulative(df, ["g"], ["i"], 60, 100, 5.0), "score", "score_count", "cumulative_rank", "action") == [
        (49, 2, 6, "cumulative_from_count"),
        (50, 4, 4, "kept"),
    ]


def test_nearest_anchor_and_empty_blocks(frame):
    df = frame(
        "page string, block int, position int, score int",
        ("p", 1, 0, None), ("p", 1, 1, 99), ("p", 1, 2, None), ("p", 2, 0, None), ("p", 2, 1, None), ("p", 3, 0, None), ("p", 3, 1, 900),
    )
    got = s.nearest_anchor_scores(df, ["page"], "block")
    assert rows(got, "block", "position", "assigned_score") == [(1, 0, 100), (1, 1, 99), (1, 2, 98), (2, 0, 97), (2, 1, 96), (3, 0, 95), (3, 1, 94)]


def test_fill_uses_filled_rows(frame):
    schema = "b int, position int, expected_score int, score int, score_count long, cumulative_rank long, parse_status string, numbers array<bigint>"
    df = frame(
        schema,
        (1, 0, 60, 60, 5, 5, "parsed", [60, 5, 5]),
        (1, 1, 59, None, None, None, "bad", [12]),
        (1, 2, 58, None, None, None, "bad", [4]),
        (1, 3, 57, None, None, None, "bad", [3, 19]),
        (1, 4, 56, None, None, None, "bad", [20, 3]),
        (1, 5, 55, None, None, None, "bad", [25]),
    )
    got = s.fill_counts(df, ["b"], allow_single_number=True)
    assert rows(got, "position", "score", "score_count", "cumulative_rank", "parse_status") == [
        (1, 59, 7, 12, "inferred_row"),
        (2, 58, 4, 16, "inferred_row"),
        (3, 57, 3, 19, "inferred_score"),
        (5, 55, 6, 25, "inferred_row"),
    ]
    assert rows(s.fill_counts(df, ["b"], allow_single_number=False), "position") == [(3,)]


def test_single_boundary(frame):
    schema = "b int, position int, score int, score_count long, cumulative_rank long, parse_status string"
    df = frame(
        schema,
        (1, 0, 50, 1, 1, "parsed"), (1, 1, None, None, None, "bad"), (1, 2, 48, 1, 3, "parsed"), (1, 3, None, None, None, "bad"),
        (2, 0, 50, 1, 1, "parsed"), (2, 1, 49, 1, 1, "parsed"), (2, 2, 48, 1, 1, "parsed"), (2, 3, 47, 1, 1, "parsed"),
        (3, 0, 50, 1, 1, "parsed"), (3, 1, 40, 1, 1, "parsed"), (3, 2, None, None, None, "bad"), (3, 3, None, None, None, "bad"),
    )
    assert rows(s.boundary_anchors(df, ["b"], 3, 60)) == [(1, 50)]


def test_line_groups(frame):
    df = frame(
        "page int, y double, x double, item string",
        (1, 10.0, 5.0, "b"), (1, 12.0, 1.0, "a"), (1, 14.0, 9.0, "c"),  # within 4 of the first
        (1, 14.5, 0.0, "d"), (1, 18.5, 0.5, "e"), (1, 18.6, 0.0, "f"),  # a chain does not stretch a line
        (1, 40.0, 2.0, "z"), (1, 40.0, 2.0, "y"), (2, 10.0, 0.0, "q"),
    )
    got = s.line_texts(s.line_groups(df, ["page"], 4.0), ["page"])
    assert rows(got, "page", "first_y", "line") == [(1, 10.0, "abc"), (1, 14.5, "de"), (1, 18.6, "f"), (1, 40.0, "yz"), (2, 10.0, "q")]


def test_context_stops_at_the_page_end(frame):
    df = frame("doc int, page int, text string", (1, 1, "a\n\n b \x07 c\nd"), (1, 2, "e"))
    assert rows(s.context_lines(df, ["doc", "page"], "text", 3), "page", "line_no", "context") == [(1, 0, "a b c"), (1, 2, "b c d"), (1, 3, "d"), (2, 0, "e")]
