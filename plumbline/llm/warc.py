"""WARC archives: writing them from a table of pages, and reading them back with boundary-chain verification.

Archives are cut wherever the magic of a record stands, by Spark's own splittable text reader, so tasks share a file and no
record has to fit a split. What begins at a magic is only a candidate: payloads may hold magic too. A task emits for each
candidate its own place and that of its successor, which follows from the header's lengths, and the place where the chain
through its split leaves the split. Pointer jumping over these exits, from the start of each file, finds the one candidate at
which the true chain enters each split; walking from there retains the records that are reachable, and no others.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.session import cut_lineage, new_folder

# Fixed values of the format.
MAGIC = "WARC/1."
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "2024-01-01T00:00:00Z"
#: Payloads of fewer bytes are never revisits.
MIN_REVISIT_BYTES = 0


def base32_sha1(data: Column) -> Column:
    """SHA-1 of a binary column in upper-case base 32, as expressions: 40 bits at a time are eight digits of base 32."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_digests(pages: DataFrame) -> DataFrame:
    """page_id, url, payload (null html: empty), bytes and digest of the payload."""
    text = F.coalesce(F.col("html"), F.lit(""))
    return pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), text.alias("payload")).withColumns(
        {"bytes": F.octet_length("payload").cast("bigint"), "digest": base32_sha1(F.encode("payload", "utf-8"))}
    )


def records(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """One record (a string) per page: header and block, without the end mark.

    Of pages with equal payloads of min_revisit_bytes or more, the one with the smallest page_id becomes a response and the others
    revisits of it; rows that repeat this page_id are responses all. Pages without id revisit, unless no page has one. Control
    characters and blanks in a url are written as %20, the slash of a record's magic as %2F; a null url gives no target header.
    """
    rows = with_digests(pages)
    # only payloads that occur more than once; as a table its size is known, so it is broadcast exactly when it is small
    several = rows.filter(F.col("bytes") >= min_revisit_bytes).groupBy("digest", "bytes").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    several = cut_lineage(several.select("digest", "bytes", "first"), "repeated-payloads")
    found = rows.join(several, ["digest", "bytes"], "left")
    revisit = F.col("first").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("first"), F.lit(False))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    header = F.concat_ws(
        "\r\n",
        F.lit(f"{MAGIC}1"),
        F.when(revisit, F.lit("WARC-Type: revisit")).otherwise(F.lit("WARC-Type: response")),
        F.concat(F.lit("WARC-Record-ID: "), urn("page_id")),
        F.lit(f"WARC-Date: {DATE}"),
        F.concat(F.lit("WARC-Target-URI: "), F.replace(F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20"), F.lit(MAGIC), F.lit(MAGIC.replace("/", "%2F")))),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), urn("first"))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    )
    return found.select(F.concat(header, F.lit(END), block).alias("value"))


def write_archives(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Writes one uncompressed archive per task into the folder path, by Spark's text writer with the format's end mark."""
    records(pages, min_revisit_bytes).write.option("lineSep", END).text(path)


def _fields(header: bytes) -> dict[str, str] | None:
    """Named fields of a record's header behind the magic; None if it is no header."""
    lines = header.split(b"\r\n")
    if not re.fullmatch(rb"\d", lines[0]):
        return None
    found = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            return None
        found[name.decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    return found if re.fullmatch(r"\d{1,15}", found.get("content-length", "")) else None


def _page(urn: str | None) -> int | None:
    match = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(match[1]) if match else None


def _content(fields: dict[str, str], block: bytes) -> dict:
    """What a record says of its page. A revisit has its payload's length and digest in its headers."""
    http, _, payload = block.partition(END.encode())
    kind = fields.get("warc-type", "")
    out = {"record_type": kind, "page_id": _page(fields.get("warc-record-id")), "refers_to": _page(fields.get("warc-refers-to"))}
    if kind == "revisit":
        length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
        return out | {"payload_bytes": int(length[1]) if length else 0, "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:")}
    return out | {"payload_bytes": len(payload), "payload_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode()}


def parse_record(data: bytes) -> dict | None:
    """A record's content from its bytes behind the magic, or None if it has no header."""
    header, _, rest = data.partition(END.encode())
    fields = _fields(header)
    return fields and _content(fields, rest[: int(fields["content-length"])])


CONTENT = [("record_type", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
SCANNED = pa.schema(
    [("file", pa.string()), ("split", pa.int64()), ("row", pa.int64()), ("at", pa.int64()), ("size", pa.int64()), ("candidate", pa.bool_())]
    + [("next", pa.int64()), ("leaves", pa.int64()), ("whole", pa.bool_())]
    + CONTENT
)
SCANNED_SQL = "file string, split bigint, row bigint, at bigint, size bigint, candidate boolean, next bigint, leaves bigint, whole boolean, record_type string, page_id bigint, refers_to bigint, payload_bytes bigint, payload_digest string"


def _cut(spark: SparkSession, path: str) -> DataFrame:
    """What stands between magics, with the file and the start of the split it was read in."""
    rows = spark.read.option("lineSep", MAGIC).text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("value").cast("binary").alias("data"))


def _numbered(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, int, int, bytes]]:
    """file, split, row, place behind the split's first byte, data: rows of a split come in order, from one task."""
    last, row, at = None, 0, 0
    for batch in rows:
        for file, split, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, split) != last:
                last, row, at = (file, split), 0, 0
            yield file, split, row, at, data
            row, at = row + 1, at + len(data) + len(MAGIC)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """A row for each stretch between magics: its place in its split (of its magic), and if a header follows, whose successor
    lies where, where the chain from it leaves the split, and the record's content if no magic cuts it."""

    def task(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []

        def flush() -> Iterator[pa.RecordBatch]:
            leaves: dict[int, int] = {}
            for r in reversed(waiting):
                if r["candidate"]:
                    leaves[r["at"]] = r["leaves"] = leaves.get(r["next"], r["next"])
            for i in range(0, len(waiting), 4096):
                yield pa.RecordBatch.from_pylist(waiting[i : i + 4096], SCANNED)
            waiting.clear()

        for file, split, row, at, data in _numbered(rows):
            if waiting and (file, split) != (waiting[-1]["file"], waiting[-1]["split"]):
                yield from flush()
            r = {"file": file, "split": split, "row": row, "at": at - len(MAGIC), "size": len(data) + len(MAGIC), "candidate": False, "whole": False}
            header, mark, rest = data.partition(END.encode())
            fields = _fields(header) if mark and (split or row) else None
            if fields:
                length = int(fields["content-length"])
                r |= {"candidate": True, "next": at + len(header) + len(END) + length + len(END)}
                if len(rest) == length + len(END) and rest.endswith(END.encode()):
                    r |= {"whole": True, **_content(fields, rest[:length])}
            waiting.append(r)
        yield from flush()

    return _cut(spark, path).mapInArrow(task, SCANNED_SQL)


def _reached(candidates: DataFrame) -> DataFrame:
    """file and place of the candidates at which the chain from the file's start enters splits; candidates: file, place, to.

    Each round adds what the reached ones jump to, and doubles every jump; so rounds number the logarithm of a file's splits.
    """
    targets = candidates.select("file", F.col("to").alias("place")).distinct()
    starts = candidates.filter("place = 0").select("file", "place")
    # only places where some chain enters: a split has few, since its chains soon run together
    jumps = cut_lineage(candidates.join(targets.unionByName(starts).distinct(), ["file", "place"], "left_semi").select("file", "place", "to"), "jumps")
    reached = cut_lineage(starts, "reached")
    known = reached.count()
    while True:
        landed = reached.join(jumps, ["file", "place"]).select("file", F.col("to").alias("place"))
        valid = landed.join(jumps, ["file", "place"], "left_semi")
        reached = cut_lineage(reached.unionByName(valid).distinct(), "reached")
        now = reached.count()
        if now == known:
            return reached
        known = now
        onward = jumps.select("file", F.col("place").alias("to"), F.col("to").alias("then"))
        # a jump out of the file, or to where no record begins, ends there
        jumps = cut_lineage(jumps.join(onward, ["file", "to"], "left").select("file", "place", F.coalesce("then", "to").alias("to")), "jumps")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record of the archives in the folder path.

    Length and digest of a response come from its payload as read. A file whose chain of records does not end with the file
    (cut short, or damaged) is an error. An empty folder, or empty files, have no records.
    """
    found = cut_lineage(scan(spark, path), "scanned")
    in_file = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = found.groupBy("file", "split").agg(F.sum("size").alias("size")).withColumn("base", F.coalesce(F.sum("size").over(in_file), F.lit(0)))
    splits = cut_lineage(splits, "splits")
    places = found.join(splits.select("file", "split", "base"), ["file", "split"])
    places = places.withColumns({"place": F.col("base") + F.col("at"), "after": F.col("base") + F.col("next"), "to": F.col("base") + F.col("leaves")})
    candidates = places.filter("candidate")
    entries = _reached(candidates.select("file", "place", "to"))
    entered = candidates.join(entries.withColumn("entry", F.lit(True)), ["file", "place"], "left")

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        """Records of one split that its entry leads to."""
        at = {place: i for i, place in enumerate(rows["place"])}
        keep, place = [], min(rows["place"][rows["entry"].notna()], default=None)
        while place in at:
            keep.append(at[place])
            place = rows["after"].iloc[at[place]]
        return rows.iloc[keep].drop(columns="entry")

    columns = ["file", "split", "row", "place", "after", "whole", *(name for name, _ in CONTENT)]
    schema = "file string, split bigint, row bigint, place bigint, after bigint, whole boolean, record_type string, page_id bigint, refers_to bigint, payload_bytes bigint, payload_digest string"
    chained = cut_lineage(entered.select(*columns, "entry").groupBy("file", "split").applyInPandas(walk, schema), "chained")

    # a file ends one magic before the sum of its rows, since none follows the last
    ends = splits.groupBy("file").agg((F.sum("size") - len(MAGIC)).alias("length")).filter("length > 0")
    last = chained.groupBy("file").agg(F.max("after").alias("after"))
    torn = ends.join(last, "file", "left").filter("NOT coalesce(after = length, false)").select("file").first()
    if torn:
        raise ValueError(f"the records of {torn['file']} do not lead to its end")
    output = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return chained.filter("whole").unionByName(_joined(spark, path, chained.filter("NOT whole"), splits, places)).select(*output)


def _joined(spark: SparkSession, path: str, cut: DataFrame, splits: DataFrame, places: DataFrame) -> DataFrame:
    """Records that magic in their payload cuts into several rows, put together again from a second reading of these rows."""
    if cut.isEmpty():
        return cut
    spans = cut.select("file", F.col("place").alias("owner"), "after").join(splits, "file").filter("base < after AND base + size > owner").select("file", "split", "owner", "after")
    parts = places.select("file", "split", "row", "place").join(spans, ["file", "split"]).filter("place >= owner AND place < after")
    wanted = cut_lineage(parts.select("file", "split", "row", "place", "owner"), "cut-records")

    def number(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, split, row, _, data in _numbered(rows):
            yield pa.RecordBatch.from_pylist([{"file": file, "split": split, "row": row, "data": data}], NUMBERED)

    pieces = _cut(spark, path).mapInArrow(number, "file string, split bigint, row bigint, data binary").join(wanted, ["file", "split", "row"])

    def put_together(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        found = parse_record(MAGIC.encode().join(rows["data"])) or {}
        return pd.DataFrame([{name: found.get(name) for name, _ in CONTENT}]).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "Int64"})

    schema = "record_type string, page_id bigint, refers_to bigint, payload_bytes bigint, payload_digest string"
    joined = pieces.groupBy("file", "owner").applyInPandas(put_together, schema)
    return joined.select(*(F.lit(None).cast(cut.schema[c].dataType).alias(c) if c not in joined.columns else F.col(c) for c in cut.columns))


NUMBERED = pa.schema([("file", pa.string()), ("split", pa.int64()), ("row", pa.int64()), ("data", pa.binary())])


def round_trip(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Writes pages (page_id, url, html; other columns are left aside) as archives into the shared folder, and reads them back."""
    path = new_folder(pages.sparkSession, "archives")
    write_archives(pages, path, min_revisit_bytes)
    return read_archives(pages.sparkSession, path)
