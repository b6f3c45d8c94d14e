"""W: ranks, cumulative sequences and their repair."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from plumbline.operators import sequence as s
from plumbline.plans.registry import query


@query(
    "w01_global_priority_rank",
    """SELECT c_custkey, c_name, priority_rank, plan_rows FROM (SELECT c_custkey, c_name, c_acctbal, n AS plan_rows, row_number() OVER (ORDER BY n DESC, c_name) AS priority_rank
       FROM customer JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey) WHERE priority_rank <= 200 OR c_acctbal > 9900""",
)
def w01(t):
    rows = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("plan_rows"))
    entities = t.customer.select("c_custkey", "c_name", "c_acctbal").join(rows, "c_custkey")
    ranked = s.global_row_number(entities, [F.desc("plan_rows"), F.asc("c_name")], "priority_rank")
    return ranked.filter("priority_rank <= 200 OR c_acctbal > 9900").select("c_custkey", "c_name", "priority_rank", "plan_rows")


@query(
    "w02_most_frequent_name",
    """SELECT l_suppkey, p_name, value_rows FROM (SELECT l_suppkey, p_name, count(*) AS value_rows, row_number() OVER (PARTITION BY l_suppkey ORDER BY count(*) DESC, p_name) AS rn
       FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2) WHERE rn = 1""",
)
def w02(t):
    rows = t.lineitem.select("l_suppkey", F.col("l_partkey").alias("p_partkey")).join(t.part.select("p_partkey", "p_name"), "p_partkey")
    return s.most_frequent(rows, ["l_suppkey"], "p_name")


CELL = ["subject", "score_year", "image", "block"]


def observations(t):
    """Printed score tables: one block per flag, year, status and line slot, one row per quantity.

    The part keys of a cell decide how readable its row is: whole, two numbers, or one number.
    """
    cells = t.lineitem.groupBy(
        F.col("l_returnflag").alias("subject"),
        F.year("l_shipdate").alias("score_year"),
        F.col("l_linestatus").alias("image"),
        F.col("l_linenumber").alias("block"),
        F.col("l_quantity").cast("int").alias("true_score"),
    ).agg(F.count(F.lit(1)).alias("n"), (F.sum("l_partkey") % 5).alias("mark"))
    w = Window.partitionBy(*CELL).orderBy(F.desc("true_score"))
    rows = cells.withColumn("position", F.row_number().over(w) - 1).withColumn(
        "cum", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    whole = F.col("mark") > 1
    text = (
        F.when(F.col("mark") == 0, F.concat_ws(" ", "n", "cum")).when(F.col("mark") == 1, F.col("cum").cast("string")).otherwise(F.concat_ws(" ", "true_score", "n", "cum"))
    )
    return rows.select(
        *CELL,
        "position",
        F.when(whole, F.col("true_score")).alias("score"),
        F.when(whole, F.col("n")).alias("score_count"),
        F.when(whole, F.col("cum")).alias("cumulative_rank"),
        F.when(whole, "parsed").otherwise("unreadable").alias("parse_status"),
        text.alias("raw_text"),
        F.transform(F.regexp_extract_all(text, F.lit(r"\d+"), F.lit(0)), lambda x: x.cast("bigint")).alias("numbers"),
        "true_score",
        "n",
        "cum",
        "mark",
    )


OBS = r"""cells AS (SELECT l_returnflag AS subject, year(l_shipdate) AS score_year, l_linestatus AS image, l_linenumber AS block, CAST(l_quantity AS INTEGER) AS true_score,
    count(*) AS n, CAST(sum(l_partkey) % 5 AS INTEGER) AS mark FROM lineitem GROUP BY 1, 2, 3, 4, 5),
  placed AS (SELECT *, CAST(row_number() OVER w - 1 AS INTEGER) AS position, CAST(sum(n) OVER w AS BIGINT) AS cum FROM cells WINDOW w AS (PARTITION BY subject, score_year, image, block ORDER BY true_score DESC)),
  obs AS (SELECT *, CASE WHEN mark > 1 THEN true_score END AS score, CASE WHEN mark > 1 THEN n END AS score_count, CASE WHEN mark > 1 THEN cum END AS cumulative_rank,
    CASE mark WHEN 0 THEN n || ' ' || cum WHEN 1 THEN CAST(cum AS VARCHAR) ELSE true_score || ' ' || n || ' ' || cum END AS raw_text FROM placed)"""


@query(
    "w03_cumulative_check",
    f"""WITH {OBS}, x AS (SELECT subject, score_year, image, block, true_score, n, CASE mark WHEN 1 THEN NULL WHEN 4 THEN cum + 1 ELSE cum END AS c FROM placed),
        y AS (SELECT *, c IS NOT NULL AND c <> coalesce(lag(c IGNORE NULLS) OVER (PARTITION BY subject, score_year, image, block ORDER BY true_score DESC), 0) + n AS bad FROM x)
        SELECT subject, score_year, image, block, count(*) AS score_rows, count(*) FILTER (WHERE bad) AS mismatches, CAST(0 AS BIGINT) AS duplicate_scores, count(*) < 50 AS too_few_rows,
          count(*) FILTER (WHERE c IS NULL) AS incomplete_rows FROM y GROUP BY 1, 2, 3, 4""",
)
def w03(t):
    shifted = F.when(F.col("mark") == 4, F.col("cum") + 1).when(F.col("mark") != 1, F.col("cum"))
    rows = observations(t).select(*CELL, F.col("true_score").alias("score"), F.col("n").alias("score_count"), shifted.alias("cumulative_rank"))
    return s.cumulative_check(rows, CELL, 50)


@query(
    "w04_math_status",
    f"""WITH {OBS}, d AS (SELECT *, row_number() OVER (PARTITION BY subject, score_year, image, score ORDER BY block, position) > 1 AS dup FROM obs WHERE score IS NOT NULL),
        e AS (SELECT *, coalesce(lag(cumulative_rank) OVER (PARTITION BY subject, score_year, image, dup ORDER BY score DESC), 0) + score_count AS expected FROM d)
        SELECT subject, score_year, image, block, position, CASE WHEN dup THEN 'duplicate_score' WHEN cumulative_rank = expected THEN 'ok' ELSE 'cumulative_mismatch' END AS math_status FROM e""",
)
def w04(t):
    rows = observations(t).filter(F.col("score").isNotNull())
    return s.math_status(rows, ["subject", "score_year", "image"], ["block", "position"]).select(*CELL, "position", "math_status")


ANCHORS = """votes AS (SELECT subject, score_year, image, block, score + position AS anchor, count(*) AS n, min(position) AS p FROM obs WHERE score BETWEEN 0 AND 750 GROUP BY 1, 2, 3, 4, 5),
  anchors AS (SELECT subject, score_year, image, block, anchor FROM (SELECT *, row_number() OVER (PARTITION BY subject, score_year, image, block ORDER BY n DESC, p) AS rn FROM votes) WHERE rn = 1 AND n >= 5 AND anchor BETWEEN 0 AND 750)"""


@query(
    "w05_anchor_inference",
    f"WITH {OBS}, {ANCHORS} SELECT subject, score_year, image, block, position, anchor - position AS expected_score FROM obs JOIN anchors USING (subject, score_year, image, block)",
)
def w05(t):
    rows = observations(t)
    found = s.anchors(rows, CELL, F.col("parse_status") == "parsed", 5)
    return s.expected_scores(rows, CELL, found).select(*CELL, "position", "expected_score")


FILLED_ROWS = "SELECT subject, score_year, image, block, position, score, score_count, cumulative_rank, parse_status FROM walk WHERE score IS NOT NULL"


def fill_sql(anchors: str, result: str = FILLED_ROWS) -> str:
    """Recursive twin of the fold: one step per position, carrying the running count."""
    return f"""e AS (SELECT obs.*, anchor - position AS expected, mark > 1 AS done FROM obs JOIN {anchors} USING (subject, score_year, image, block)),
      walk AS (SELECT subject, score_year, image, block, -1 AS position, CAST(NULL AS BIGINT) AS prev, CAST(NULL AS INTEGER) AS score, CAST(NULL AS BIGINT) AS score_count, CAST(NULL AS BIGINT) AS cumulative_rank, CAST(NULL AS VARCHAR) AS parse_status
          FROM (SELECT DISTINCT subject, score_year, image, block FROM e)
        UNION ALL SELECT subject, score_year, image, block, position, CASE WHEN done THEN cum WHEN ok THEN c ELSE prev END, CASE WHEN ok THEN expected END, CASE WHEN ok THEN k END, CASE WHEN ok THEN c END,
            CASE WHEN ok THEN CASE WHEN mark = 0 THEN 'inferred_score' ELSE 'inferred_row' END END
          FROM (SELECT *, coalesce(NOT done AND expected BETWEEN 0 AND 750 AND k > 0 AND c > k, false) AS ok FROM (SELECT e.*, walk.prev,
              CASE WHEN mark = 0 THEN n WHEN mark = 1 AND walk.prev IS NOT NULL THEN CASE WHEN cum > walk.prev THEN cum - walk.prev ELSE cum END END AS k,
              CASE WHEN mark = 0 THEN cum WHEN mark = 1 AND walk.prev IS NOT NULL THEN CASE WHEN cum > walk.prev THEN cum ELSE walk.prev + cum END END AS c
            FROM walk JOIN e ON e.subject = walk.subject AND e.score_year = walk.score_year AND e.image = walk.image AND e.block = walk.block AND e.position = walk.position + 1)))
      {result}"""


@query("w06_carry_forward_fill", f"WITH RECURSIVE {OBS}, {ANCHORS}, {fill_sql('anchors')}")
def w06(t):
    rows = observations(t)
    found = s.anchors(rows, CELL, F.col("parse_status") == "parsed", 5)
    return s.fill_counts(s.expected_scores(rows, CELL, found), CELL, allow_single_number=True)


@query(
    "w07_neighbour_difference",
    f"""WITH {OBS}, k AS (SELECT * FROM obs WHERE score IS NOT NULL AND cumulative_rank > 0),
        j AS (SELECT k.*, CASE WHEN a.score IS NULL THEN CASE WHEN k.score_count = k.cumulative_rank THEN k.cumulative_rank END ELSE k.cumulative_rank - a.cumulative_rank END AS suggested_count
          FROM k LEFT JOIN k a ON a.subject = k.subject AND a.score_year = k.score_year AND a.image = k.image AND a.block = k.block AND a.score = k.score + 1)
        SELECT subject, score_year, image, block, score, suggested_count FROM j WHERE suggested_count > 0 AND cumulative_rank > suggested_count AND suggested_count <= 2000 AND score_count = suggested_count""",
)
def w07(t):
    return s.neighbour_counts(observations(t), CELL, 2000).select(*CELL, "score", "suggested_count")


@query(
    "w08_nearest_anchor_fill",
    f"""WITH {OBS}, o AS (SELECT *, last_value(score + position IGNORE NULLS) OVER (PARTITION BY subject, score_year, image, block ORDER BY position ROWS UNBOUNDED PRECEDING) AS up,
          first_value(score + position IGNORE NULLS) OVER (PARTITION BY subject, score_year, image, block ORDER BY position ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS down FROM obs)
        SELECT subject, score_year, image, block, position, CASE WHEN score IS NOT NULL THEN score WHEN coalesce(up, down) - position BETWEEN 0 AND 750 THEN coalesce(up, down) - position END AS assigned_score FROM o""",
)
def w08(t):
    return s.nearest_anchor_scores(observations(t), ["subject", "score_year", "image"], "block").select(*CELL, "position", "assigned_score")


@query(
    "w09_cumulative_repair",
    f"""WITH RECURSIVE {OBS}, r AS (SELECT subject, score_year, image, block, position, true_score AS score, CASE WHEN mark = 0 THEN NULL ELSE n END AS k, CASE WHEN mark = 1 THEN NULL WHEN mark = 2 THEN cum + 10000 WHEN mark = 3 THEN cum + 2 ELSE cum END AS c FROM obs),
      walk AS (SELECT subject, score_year, image, block, -1 AS position, CAST(0 AS BIGINT) AS prev, CAST(NULL AS INTEGER) AS score, CAST(NULL AS BIGINT) AS score_count, CAST(NULL AS BIGINT) AS cumulative_rank, CAST(NULL AS VARCHAR) AS action FROM (SELECT DISTINCT subject, score_year, image, block FROM r)
        UNION ALL SELECT subject, score_year, image, block, position, CASE WHEN both_known THEN c2 ELSE prev END, CASE WHEN both_known THEN score END, n2, c2,
          CASE WHEN differs AND jump THEN 'cumulative_by_jump' WHEN by_diff THEN 'count_by_cumulative' WHEN differs THEN 'cumulative_by_count' WHEN k IS NULL THEN 'count_from_cumulative' WHEN c IS NULL THEN 'cumulative_from_count' ELSE 'kept' END
        FROM (SELECT *, CASE WHEN by_diff THEN c1 - prev ELSE n1 END AS n2, CASE WHEN differs AND NOT by_diff THEN prev + n1 ELSE c1 END AS c2
          FROM (SELECT *, differs AND NOT jump AND c1 - prev > 0 AND c1 - prev <= 3000 AS by_diff
            FROM (SELECT *, n1 IS NOT NULL AND c1 IS NOT NULL AS both_known, coalesce(n1 IS NOT NULL AND c1 IS NOT NULL AND prev + n1 <> c1, false) AS differs,
                coalesce(n1 > 0 AND c1 - prev > n1 AND c1 - prev - n1 >= 1000 AND c1 - prev >= n1 * 20.0, false) AS jump
              FROM (SELECT r.*, walk.prev, coalesce(r.k, CASE WHEN r.c - walk.prev > 0 AND r.c - walk.prev <= 3000 THEN r.c - walk.prev END) AS n1, coalesce(r.c, walk.prev + r.k) AS c1
                FROM walk JOIN r ON r.subject = walk.subject AND r.score_year = walk.score_year AND r.image = walk.image AND r.block = walk.block AND r.position = walk.position + 1)))))
      SELECT subject, score_year, image, block, score, score_count, cumulative_rank, action FROM walk WHERE score IS NOT NULL""",
)
def w09(t):
    mark = F.col("mark")
    rows = observations(t).select(
        *CELL,
        "position",
        F.col("true_score").alias("score"),
        F.when(mark != 0, F.col("n")).alias("score_count"),
        F.when(mark == 2, F.col("cum") + 10000).when(mark == 3, F.col("cum") + 2).when(mark != 1, F.col("cum")).alias("cumulative_rank"),
    )
    return s.repair_cumulative(rows, CELL, ["position"], 3000, 1000, 20.0)


@query(
    "w10_dedupe_policies",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS up, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS down FROM events)
       SELECT 'keep_first' AS policy, user_id, event_type, event_id FROM r WHERE up = 1 UNION ALL SELECT 'replace', user_id, event_type, event_id FROM r WHERE down = 1
       UNION ALL SELECT 'error', user_id, event_type, count(*) FROM r GROUP BY 1, 2, 3 HAVING count(*) > 1""",
)
def w10(t):
    key, order = ["user_id", "event_type"], ["ts", "event_id"]
    rows = t.events.select(*key, *order)
    parts = [s.dedupe(rows, key, order, p).select(F.lit(p).alias("policy"), *key, "event_id") for p in ("keep_first", "replace")]
    repeated = s.dedupe(rows, key, order, "error").select(F.lit("error").alias("policy"), *key, F.col("row_count").alias("event_id"))
    return parts[0].unionByName(parts[1]).unionByName(repeated)


@query(
    "w11_ranked_missing",
    """SELECT row_number() OVER (ORDER BY plan_rows DESC, majors DESC, c_custkey) AS priority_rank, plan_rows * 10 + majors AS priority_score, c_custkey, plan_rows, majors FROM
       (SELECT o_custkey AS c_custkey, count(*) AS plan_rows, count(DISTINCT o_orderpriority) AS majors, count(*) FILTER (WHERE year(o_orderdate) = 2000) AS covered FROM orders GROUP BY 1) WHERE covered = 0""",
)
def w11(t):
    summary = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("plan_rows"), F.count_distinct("o_orderpriority").alias("majors"), F.count_if(F.year("o_orderdate") == 2000).alias("covered")
    )
    missing = summary.filter("covered = 0").withColumn("priority_score", F.col("plan_rows") * 10 + F.col("majors"))
    order = [F.desc("plan_rows"), F.desc("majors"), F.asc("c_custkey")]
    return s.global_row_number(missing, order, "priority_rank").select("priority_rank", "priority_score", "c_custkey", "plan_rows", "majors")


CONTEXT = r"""lines AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))) AS ls FROM documents),
  context AS (SELECT doc_id, i - 1 AS line_no, ls[i] AS line, array_to_string(list_filter(ls[i:i + 2], lambda x: x <> ''), ' ') AS context FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM lines) WHERE ls[i] <> '')"""


@query("w12_context_lines", f"WITH {CONTEXT} SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, md5(context) AS context_md5 FROM context")
def w12(t):
    return s.context_lines(t.documents, ["doc_id"], "text", 3).select("doc_id", "line_no", F.md5("context").alias("context_md5"))


@query(
    "w13_line_groups",
    """WITH RECURSIVE o AS (SELECT user_id, event_id, epoch_ms(ts) // 60000 AS y, CAST(floor(value * 100) AS BIGINT) AS x, row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts) // 60000, CAST(floor(value * 100) AS BIGINT), event_id) AS i FROM events),
       walk AS (SELECT user_id, i, y AS first_y, x, event_id FROM o WHERE i = 1
         UNION ALL SELECT o.user_id, o.i, CASE WHEN o.y - walk.first_y <= 600 THEN walk.first_y ELSE o.y END, o.x, o.event_id FROM walk JOIN o ON o.user_id = walk.user_id AND o.i = walk.i + 1)
       SELECT user_id, first_y, arg_min(event_id, (x, event_id)) AS first_item, arg_max(event_id, (x, event_id)) AS last_item, count(*) AS items FROM walk GROUP BY 1, 2""",
)
def w13(t):
    minute = F.timestamp_diff("MINUTE", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts").cast("timestamp_ntz"))
    objects = t.events.select("user_id", minute.cast("double").alias("y"), F.floor(F.col("value") * 100).cast("double").alias("x"), F.col("event_id").alias("item"))
    # nulls come last, as in SQL, whose walk takes nothing but the first object where there is no user
    ordered = [F.asc_nulls_last(c) for c in ("y", "x", "item")]
    homeless = objects.filter("user_id IS NULL").orderBy(*ordered).limit(1).withColumn("first_y", F.col("y"))
    place = F.when(F.col("item").isNotNull(), F.struct(F.col("x").isNull().alias("none"), "x", "item"))
    lines = s.line_groups(objects, ["user_id"], 600.0).unionByName(homeless)
    lines = lines.groupBy("user_id", F.col("first_y").cast("bigint").alias("first_y"))
    return lines.agg(F.min_by("item", place).alias("first_item"), F.max_by("item", place).alias("last_item"), F.count(F.lit(1)).alias("items"))


@query(
    "w13_column_blocks",
    """SELECT CASE WHEN value >= 0 AND value < 10 THEN 0 WHEN value >= 10 AND value < 25 THEN 1 WHEN value >= 25 AND value < 60 THEN 2 END AS block, count(*) AS items FROM events GROUP BY 1""",
)
def w13_blocks(t):
    block = s.column_block(F.col("value"), [(0.0, 10.0), (10.0, 25.0), (25.0, 60.0)])
    return t.events.groupBy(block.alias("block")).agg(F.count(F.lit(1)).alias("items"))


@query(
    "w14_best_place",
    r"""WITH c AS (SELECT DISTINCT l_suppkey, 'Brand#' || (s_nationkey + 1) AS owner, p_brand || CASE WHEN p_size < 5 THEN '' WHEN p_size < 10 THEN 'X' ELSE p_name END AS place, p_partkey FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey),
       k AS (SELECT *, substr(place, length(owner) + 1) AS tail FROM c WHERE starts_with(place, owner)),
       v AS (SELECT *, CASE WHEN tail = '' THEN 100 WHEN contains(tail, 'ring') OR contains(tail, 'gear') THEN CASE WHEN contains(regexp_replace(tail, '^.*?(ring|gear)', ''), 'bolt') THEN 0 ELSE 90 END
             WHEN contains(tail, 'bolt') OR contains(tail, 'widget') THEN 0 WHEN length(tail) <= 2 THEN 70 ELSE 0 END AS score FROM k)
       SELECT l_suppkey, p_partkey, score FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY score DESC, length(tail), p_partkey) AS rn FROM v WHERE score > 0) WHERE rn = 1""",
)
def w14(t):
    place = F.concat("p_brand", F.when(F.col("p_size") < 5, "").when(F.col("p_size") < 10, "X").otherwise(F.col("p_name")))
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), place.alias("place"))
    owners = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.concat(F.lit("Brand#"), F.col("s_nationkey") + 1).alias("owner"))
    verdict = s.place_verdict(F.col("place"), F.col("owner"), ("ring", "gear"), ("bolt", "widget"))
    candidates = t.lineitem.select("l_suppkey", "l_partkey").join(parts, "l_partkey").join(owners, "l_suppkey").withColumn("v", verdict)
    order = F.struct(-F.col("v.score"), F.col("v.tail_length"), F.col("l_partkey"))
    best = candidates.filter("v.score > 0").groupBy("l_suppkey").agg(F.min_by(F.struct("l_partkey", "v.score"), order).alias("b"))
    return best.select("l_suppkey", F.col("b.l_partkey").alias("p_partkey"), "b.score")


@query(
    "w15_single_boundary",
    f"""WITH RECURSIVE {OBS}, ends AS (SELECT subject, score_year, image, block, count(*) AS n, arg_min(struct_pack(a := score + position, ok := coalesce(score <= 50, false)), position) AS h, arg_max(struct_pack(a := score + position, ok := coalesce(score <= 50, false)), position) AS l,
          min(score + position) AS lo, max(score + position) AS hi FROM obs GROUP BY 1, 2, 3, 4),
        anchors AS (SELECT subject, score_year, image, block, CASE WHEN h.ok THEN h.a ELSE l.a END AS anchor FROM ends WHERE n >= 5 AND h.ok <> l.ok AND lo = hi), {fill_sql('anchors')}""",
)
def w15(t):
    rows = observations(t)
    found = s.boundary_anchors(rows, CELL, 5, 50)
    return s.fill_counts(s.expected_scores(rows, CELL, found), CELL, allow_single_number=True)
