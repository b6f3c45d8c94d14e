"""Attachment links of pages: anchors, cloud addresses and embedded viewers, resolved, scored and chosen by tier."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from pathlib import PurePosixPath
from urllib.parse import parse_qs, unquote, urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import vocabulary as vocab
from plumbline.rules import any_of

#: Order in which kinds of links are asked; the first kind with a fitting link gives the page's.
ANCHOR, CLOUD, VIEWER = 0, 1, 2


class _Anchors(HTMLParser):
    """A fold over tags and text: the address of the open anchor, and all text up to its end as its label."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str]] = []
        self.address: str | None = None
        self.label = ""

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.address, self.label = dict(attrs).get("href"), ""

    def handle_data(self, data):
        self.label += data if self.address else ""

    def handle_endtag(self, tag):
        if tag == "a" and self.address:
            self.found.append((self.address, self.label.strip()))
            self.address = None


def resolved(page: str, address: str) -> str | None:
    """The address as seen from its page, and the file behind it where it is a viewer's; null if it cannot be read."""
    try:
        whole = urljoin(page, address)
        asked = parse_qs(urlsplit(whole).query)
        for name in vocab.VIEWER_PARAMETERS:
            if name in asked:
                file = unquote(asked[name][0].strip())
                parts = urlsplit(file)
                return file if parts.scheme in ("http", "https") and parts.path.lower().endswith(vocab.REPORT_ENDINGS) else whole
        return whole
    except ValueError:
        return None


def _cloud_addresses(html: str) -> Iterator[str]:
    for name in re.findall(vocab.CLOUD_NAME, html):
        try:
            told = json.loads(unquote(base64.b64decode(name).decode()))
        except ValueError:
            continue
        disk = told.get(vocab.CLOUD_ENTRY) if isinstance(told, dict) else None
        if isinstance(disk, dict):
            yield from (str(disk[key]).strip() for key in vocab.CLOUD_ADDRESSES if disk.get(key))


def links_of(page: str, html: str) -> list[tuple[int, str, str]]:
    """(tier, address, label) of a page's links, in order; links inside the page are left out."""
    anchors = _Anchors()
    anchors.feed(html)
    told = [(ANCHOR, address, label) for address, label in anchors.found if not address.strip().startswith("#")]
    told += [(CLOUD, address, "") for address in _cloud_addresses(html)]
    told += [(VIEWER, address.strip(), "") for address in re.findall(vocab.VIEWER_CALL, html) if address.strip()]
    out = []
    for tier, address, label in told:
        whole = resolved(page, address) if tier == ANCHOR else _joined(page, address)
        if whole is not None:
            out.append((tier, whole, label if tier == ANCHOR else whole))
    return out


def _joined(page: str, address: str) -> str | None:
    try:
        return urljoin(page, address)
    except ValueError:
        return None


def _file_name(address: str) -> str:
    try:
        return PurePosixPath(urlsplit(address).path).name
    except ValueError:
        return ""


def page_links(pages: DataFrame, id_col: str, url: str, html: str) -> DataFrame:
    """tier, href (resolved), address (href without percent signs), file (its last part) and label of every link of each page.

    A label is all text up to the anchor's end, whatever tags it holds. Addresses are joined to their page's: relative paths, dot
    segments, queries alone, other hosts. Pages without an address keep links as they are; null pages have none.
    """
    id_type = pages.schema[id_col].dataType.simpleString()
    columns = [id_col, "tier", "href", "address", "file", "label"]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for page, address, text in zip(batch[id_col], batch[url], batch[html], strict=True):
                for tier, href, label in links_of(address or "", text or ""):
                    plain = unquote(href)
                    out.append((page, tier, href, plain, _file_name(plain), label))
            yield pd.DataFrame(out, columns=columns)

    return pages.select(id_col, url, html).mapInPandas(read, f"{id_col} {id_type}, tier int, href string, address string, file string, label string")


def link_score(address: Column, file: Column, label: Column, target: Column) -> Column:
    """How well a link fits a wanted file name."""
    plain = F.lower(address)
    text = F.concat(plain, F.lit(" "), F.lower(label))
    name = F.trim(target)
    # the last part of a name that begins with a dot is no ending
    stem = F.lower(F.regexp_replace(F.regexp_extract(name, r"([^/]*)/*$", 1), r"(?<=.)\.[^.]+$", ""))
    given = name != ""
    return (
        F.when(file == name, 10).otherwise(0)
        + F.when(given & text.contains(F.lower(name)), 8).otherwise(0)
        + F.when(given & (stem != "") & text.contains(stem), 5).otherwise(0)
        + F.when(any_of(plain.endswith(e) for e in vocab.FILE_ENDINGS), 2).otherwise(0)
        + F.when(any_of(text.contains(e) for e in vocab.FILE_ENDINGS), 1).otherwise(0)
    )


def best_links(links: DataFrame, id_col: str, score: Column) -> DataFrame:
    """The link of each page: of the first kind with a fitting one, that with the best score, the highest address winning a tie.

    Pages without a fitting link drop out.
    """
    scored = links.withColumn("score", score).filter(F.col("score") > 0)
    best = F.max_by(F.struct("href", "score"), F.struct(-F.col("tier"), "score", "href"))
    return scored.groupBy(id_col).agg(best.alias("b")).select(id_col, "b.href", "b.score")
