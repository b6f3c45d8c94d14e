"""N-gram Jaccard join in the metric space of shingle sets.

One less the Jaccard similarity is a distance. Sets that share nothing are all at distance one, where no pivot tells them apart,
so that the space is first cut at shingles: of two linked sets, the first ones that suffice meet in one. Sets that share fewer of
theirs with any other than a link needs are alone. The smallest set at each shingle is a pivot, and its region holds the sets of
all shingles where it is the smallest; every linked pair lies in a region together. Distances from pivots are computed, those
within reach link their sets to the pivot, and regions that hold one component only are done.

The others are joined recursively: new pivots are drawn among a region's sets, each set goes to its nearest pivot's Voronoi
region, and as a guest to every other whose pivot is no more than twice the reach farther, by the triangle inequality: where x
and y link and x is at home with p, d(y, p) <= d(x, y) + d(x, p) <= reach + d(x, q) <= 2 reach + d(y, q) for y's own pivot q.
Large regions are split so by joins, those that fit a task inside it; what no pivot splits is compared in blocks. Sets of one
component need not be compared, since only components are asked for. So no linked pair is lost, and none is listed for nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.graph import connected_components
from plumbline.llm.shingle_sets import least_shared, members, shingle_sets
from plumbline.session import cut_lineage

#: Words in a shingle, and least similarity of linked sets.
SHINGLE_WORDS = 4
LINK = (85, 100)
#: Shingles of a region that is joined in one task, pivots of a region, and sets of a region that are compared straight away.
REGION_SHINGLES = 1 << 22
PIVOTS = 8
LEAF = 48
#: Voronoi regions are used if the squares of their sizes, which comparing costs at worst, come to this share of their parent's.
SHRINK = 0.5


def linked(common, a, b, link: tuple[int, int]):
    """Whether sets of a and b shingles with so many in common link; numbers, arrays or columns."""
    return link[1] * common >= link[0] * (a + b - common)


def reach(link: tuple[int, int]) -> float:
    """Largest distance of linked sets, and a little more than rounding takes."""
    return 1 - link[0] / link[1] + 1e-9


class Region:
    """Sets in one task: distances, and a forest over their components."""

    def __init__(self, sets: list[np.ndarray], comps: np.ndarray, link: tuple[int, int]):
        self.link, self.sizes = link, np.array([len(x) for x in sets], np.int64)
        _, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))[:-1]
        self.mark = np.zeros(len(self.flat) and int(self.flat.max()) + 1, bool)
        _, self.comp = np.unique(comps, return_inverse=True)
        self.links: list[tuple[int, int]] = []

    def common(self, i: int) -> np.ndarray:
        """Shingles that each set shares with set i."""
        own = self.flat[self.starts[i] : self.starts[i] + self.sizes[i]]
        self.mark[own] = True
        out = np.add.reduceat(self.mark[self.flat], self.starts, dtype=np.int64)
        self.mark[own] = False
        return out

    def tie(self, i: int, others: np.ndarray) -> None:
        """Links of set i to sets of other components; one a component is kept."""
        for j in others.tolist():
            if self.comp[j] != self.comp[i]:
                self.links.append((i, j))
                self.comp[self.comp == self.comp[j]] = self.comp[i]

    def inside(self, at: np.ndarray) -> "Region":
        """A region of some of the sets alone; its links are this one's after adopt."""
        sets = [self.flat[self.starts[i] : self.starts[i] + self.sizes[i]] for i in at.tolist()]
        return Region(sets, self.comp[at], self.link)

    def similar(self) -> np.ndarray:
        """Sets that may link with another: enough of their shingles are in a second one of those left."""
        left = np.ones(len(self.sizes), bool)
        while True:
            held = np.bincount(self.flat[np.repeat(left, self.sizes)], minlength=len(self.mark))
            shared = np.add.reduceat(held[self.flat] > 1, self.starts, dtype=np.int64)
            now = left & (self.link[1] * shared >= self.link[0] * self.sizes)
            if (now == left).all():
                return np.flatnonzero(now)
            left = now

    def join(self, home: np.ndarray) -> None:
        """Ties all components that a link of a set at home with any set leads to."""
        if len(np.unique(self.comp)) == 1:
            return
        if len(self.sizes) <= LEAF:
            return self.compare(home)
        at_home = np.zeros(len(self.sizes), bool)
        at_home[home] = True
        pivots = home[np.linspace(0, len(home) - 1, min(PIVOTS, len(home))).astype(int)]
        shared = np.stack([self.common(i) for i in pivots.tolist()])
        both = self.sizes[pivots][:, None] + self.sizes[None, :] - shared
        for i, close in zip(pivots.tolist(), linked(shared, self.sizes[pivots][:, None], self.sizes[None, :], self.link), strict=True):
            self.tie(i, np.flatnonzero(close))
        far = 1 - shared / both
        own = far.argmin(axis=0)
        window = far <= far.min(axis=0) + 2 * reach(self.link)
        parts = [np.flatnonzero(window[p]) for p in range(len(pivots))]
        if sum(float(self.sizes[part].sum()) ** 2 for part in parts) > SHRINK * float(self.sizes.sum()) ** 2:
            return self.compare(home)
        for p, part in enumerate(parts):
            mine = np.flatnonzero((own[part] == p) & at_home[part])
            if len(mine):
                self.within(part, mine)

    def within(self, part: np.ndarray, home: np.ndarray) -> None:
        """join of some of the sets alone; home: places in part."""
        sets = [self.flat[self.starts[i] : self.starts[i] + self.sizes[i]] for i in part.tolist()]
        child = Region(sets, self.comp[part], self.link)
        child.join(home)
        for i, j in child.links:
            self.tie(int(part[i]), part[j : j + 1])

    def compare(self, home: np.ndarray) -> None:
        """Sets at home with all sets. A link between components has an end outside the largest, so that those are enough."""
        at_home = np.zeros(len(self.sizes), bool)
        at_home[home] = True
        for i in np.flatnonzero(self.comp != np.bincount(self.comp).argmax()).tolist():
            close = linked(self.common(i), self.sizes[i], self.sizes, self.link)
            self.tie(i, np.flatnonzero(close & (at_home | at_home[i])))


def region_links(sets: list[np.ndarray], comps: np.ndarray, home: np.ndarray, link: tuple[int, int]) -> list[tuple[int, int]]:
    """Places of linked sets, enough to tie all components that links from sets at home (flags) lead to."""
    whole = Region(sets, comps, link)
    part = whole.similar()
    if len(part) > 1 and home[part].any():
        whole.within(part, np.flatnonzero(home[part]))
    return whole.links


def _met(nodes: DataFrame) -> DataFrame:
    """h, node and pivot (the smallest node at h) for every shingle h that several nodes have among their first; where nodes have
    comp, nodes of several comps."""
    per = Window.partitionBy("h")
    comp = [c for c in nodes.columns if c == "comp"]
    at = nodes.select(F.explode("first").alias("h"), "node", *comp).withColumn("pivot", F.min("node").over(per))
    for name in comp or ["node"]:
        at = at.withColumn("one", F.min(name).over(per)).withColumn("other", F.max(name).over(per))
    return at.filter("one <> other").select("h", "node", "pivot")


def _likely(nodes: DataFrame, link: tuple[int, int]) -> DataFrame:
    """node and first (the shingles that are enough) of the nodes that share as many shingles as a link needs."""
    shared = _met(nodes).groupBy(F.col("node").alias("of")).agg(F.count("*").alias("shared"))
    likely = nodes.join(shared, F.col("node") == F.col("of")).filter(F.col("shared") >= least_shared(F.col("n"), link))
    unshared = F.col("n") - F.ceil(F.col("n") * link[0] / link[1])
    return cut_lineage(likely.select("node", F.slice("first", F.lit(1), (unshared + 1).cast("int")).alias("first")), "likely-sets")


def _regions(likely: DataFrame, comps: DataFrame | None = None) -> DataFrame:
    """region (its pivot) and node, the pivot's own row included, of likely sets that meet.

    comps: node and comp of nodes that are known to be in a component with others; shingles of one component meet nothing new.
    """
    if comps is not None:
        likely = likely.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    return _met(likely).select(F.col("pivot").alias("region"), "node").distinct()


def _common(a: str, b: str) -> Column:
    return F.size(F.array_intersect(a, b)).cast("bigint")


def _merged(rows: DataFrame, links: DataFrame) -> DataFrame:
    """rows with comp after links (src, dst: comps)."""
    roots = connected_components(links).select(F.col("src").alias("comp"), F.col("root").alias("into"))
    return rows.join(roots, "comp", "left").withColumn("comp", F.coalesce("into", "comp")).drop("into")


def _open(rows: DataFrame) -> DataFrame:
    """rows of regions with a set at home that hold several components; region, node, n, comp, home."""
    of_each = rows.groupBy("region").agg(F.min("comp").alias("one"), F.max("comp").alias("other"), F.max("home").alias("any"), F.sum("n").alias("weight"))
    return rows.join(of_each.filter("one <> other AND any").select("region", "weight"), "region")


def _split(rows: DataFrame, sets: DataFrame, link: tuple[int, int], level: int) -> tuple[DataFrame, DataFrame]:
    """Regions over the size by their pivots: rows of the Voronoi regions, or of blocks where those do not shrink, and links."""
    order = Window.partitionBy("region").orderBy(F.xxhash64("node", F.lit(level)))
    drawn = rows.filter("home").withColumn("k", F.row_number().over(order)).filter(F.col("k") <= PIVOTS)
    pivots = drawn.select("region", F.col("node").alias("pivot"), F.col("comp").alias("pivot_comp"))
    pivots = pivots.join(sets.select(F.col("node").alias("pivot"), F.col("hashes").alias("pivot_hashes")), "pivot")
    told = rows.join(sets, "node").join(pivots, "region").withColumn("common", _common("hashes", "pivot_hashes")).withColumn("m", F.size("pivot_hashes").cast("bigint"))
    told = cut_lineage(told.select("region", "node", "n", "comp", "home", "weight", "pivot", "pivot_comp", "common", "m"), "pivot-distances")
    links = told.filter(linked(F.col("common"), F.col("n"), F.col("m"), link)).select(F.col("comp").alias("src"), F.col("pivot_comp").alias("dst")).filter("src <> dst").distinct()
    far = told.withColumn("far", 1 - F.col("common") / (F.col("n") + F.col("m") - F.col("common")))
    near = far.groupBy("region", "node").agg(F.min(F.struct("far", "pivot")).alias("near"))
    placed = far.join(near, ["region", "node"]).filter(F.col("far") <= F.col("near.far") + 2 * reach(link))
    placed = placed.withColumn("home", F.col("home") & (F.col("near.pivot") == F.col("pivot"))).withColumn("child", F.xxhash64("region", "pivot", F.lit(level)))
    weights = placed.groupBy("region", "child").agg(F.sum("n").cast("double").alias("inside"), F.max("weight").cast("double").alias("weight"))
    stuck = weights.groupBy("region").agg((F.sum(F.col("inside") * F.col("inside")) > SHRINK * F.max(F.col("weight") * F.col("weight"))).alias("stuck"))
    placed = cut_lineage(placed.join(stuck, "region").select("region", "child", "node", "n", "comp", "home", "weight", "stuck"), "voronoi")
    children = placed.filter("NOT stuck").select(F.col("child").alias("region"), "node", "n", "comp", "home")
    # blocks: each meets itself and every other one
    whole = rows.join(placed.filter("stuck").select("region").distinct(), "region", "left_semi")
    blocks = F.ceil(F.col("weight") / REGION_SHINGLES).cast("int")
    own = whole.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node", F.lit(level)), F.col("blocks")).cast("int"))
    pair = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    key = F.xxhash64("region", F.least("own", "other"), F.greatest("own", "other"), F.lit(level))
    pieces = pair.select(key.alias("region"), "node", "n", "comp", (F.col("home")).alias("home"), F.lit(True).alias("block"))
    return children.withColumn("block", F.lit(False)).unionByName(pieces), links


def _joined(rows: DataFrame, sets: DataFrame, link: tuple[int, int]) -> DataFrame:
    """src, dst: components that links inside regions tie; every region is joined in one task."""

    def region(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values("node", ignore_index=True)
        comps = table["comp"].to_numpy()
        found = region_links(table["hashes"].tolist(), comps, table["home"].to_numpy(), link)
        return pd.DataFrame({"src": comps[[i for i, _ in found]], "dst": comps[[j for _, j in found]]}, dtype="int64")

    return rows.select("region", "node", "comp", "home").join(sets, "node").groupBy("region").applyInPandas(region, "src bigint, dst bigint").distinct()


def _tied(regions: DataFrame, held: DataFrame, comps: DataFrame | None, link: tuple[int, int]) -> DataFrame:
    """node and comp (one member of its component, the same for all) after all links inside regions, of each node in a component
    with others; regions: region (its pivot), node; held: node, hashes; comps: the components that are known before."""
    pivots = held.select(F.col("node").alias("region"), F.col("hashes").alias("pivot_hashes"))
    if comps is not None:
        own = comps.select(F.col("node").alias("region"), F.col("comp").alias("pivot_comp"))
        regions = regions.join(comps, "node", "left").join(own, "region", "left")
        # what is known to be in the pivot's component need not be compared with it
        known = F.coalesce("comp", "node") == F.coalesce("pivot_comp", "region")
        regions = cut_lineage(regions.select("region", "node", known.alias("known")), "known-links")
        told = regions.filter("NOT known").select("region", "node")
    else:
        told = regions
    told = told.join(held, "node").join(pivots, "region").withColumn("n", F.size("hashes").cast("bigint")).withColumn("m", F.size("pivot_hashes").cast("bigint"))
    told = cut_lineage(told.select("region", "node", "n", linked(_common("hashes", "pivot_hashes"), F.col("n"), F.col("m"), link).alias("close")), "pivot-links")
    links = told.filter("close AND node <> region").select(F.col("node").alias("src"), F.col("region").alias("dst"))
    rows = told.filter("node <> region").select("region", "node", "n")
    if comps is not None:
        links = links.unionByName(comps.select(F.col("node").alias("src"), F.col("comp").alias("dst")))
        sizes = held.select("node", F.size("hashes").cast("bigint").alias("n"))
        rows = rows.unionByName(regions.filter("known AND node <> region").select("region", "node").join(sizes, "node").select("region", "node", "n"))
    comps = cut_lineage(connected_components(links).select(F.col("src").alias("node"), F.col("root").alias("comp")), "pivot-components")

    # pivots have been compared with all of their regions
    rows = rows.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")).withColumn("home", F.lit(True)).withColumn("block", F.lit(False))
    found = None
    level = 0
    while True:
        rows = cut_lineage(_open(rows), "open-regions")
        fits = (F.col("weight") <= REGION_SHINGLES) | F.col("block")
        ties = _joined(rows.filter(fits), held, link)
        found = cut_lineage(ties if found is None else found.unionByName(ties), "region-links")
        large = rows.filter(~fits)
        if large.isEmpty():
            break
        level += 1
        rows, more = _split(large.drop("block"), held, link, level)
        found = found.unionByName(more)
        rows = _merged(rows, found)
    roots = cut_lineage(connected_components(found).select(F.col("src").alias("comp"), "root"), "component-roots")
    alone = roots.join(comps.select("comp").distinct(), "comp", "left_anti").select(F.col("comp").alias("node"), F.col("root").alias("comp"))
    return comps.join(roots, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp")).unionByName(alone)


def components(docs: DataFrame, sets: DataFrame, words: int, link: tuple[int, int], proposed: DataFrame | None = None) -> DataFrame:
    """node and root (one member of its component, the same for all) of each node that has a link; sets: as from shingle_sets.

    proposed: region (its smallest node) and node, groups in which links are likely. They are joined before the regions of
    shingles, which are then made of what is not in one component yet.
    """
    nodes = sets.filter("n > 0").groupBy("node").agg(F.min("row").alias("row"), F.first("n").alias("n"), F.first("first").alias("first"))

    likely, comps = _likely(nodes, link), None
    if proposed is None:
        regions = cut_lineage(_regions(likely), "regions")
        wanted = regions.select("node")
    else:
        proposed = cut_lineage(proposed, "proposed-regions")
        wanted = proposed.select("node").unionByName(likely.select("node"))  # one look at the texts for both
    wanted = sets.select("node", "row").join(wanted.distinct(), "node", "left_semi").groupBy("node").agg(F.min("row").alias("row"))
    held = cut_lineage(members(docs, wanted, words), "members")
    if proposed is not None:
        comps = cut_lineage(_tied(proposed, held, None, link), "proposed-components")
        regions = cut_lineage(_regions(likely, comps), "regions")
    return _tied(regions, held, comps, link).withColumnRenamed("comp", "root")


def similar_documents(docs: DataFrame, words: int = SHINGLE_WORDS, link: tuple[int, int] = LINK) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links reach, its own included), one row per row of docs.

    docs: doc_id, text; other columns are left aside. A-Z are lower-cased; a text with fewer words than a shingle has one of all
    its words. Null, empty and wordless texts have none and link with nothing, not even one another. A null doc_id counts as
    none: a component without any other id has component_id null. Rows that share an id are documents of their own; repeated
    rows come back repeated.
    """
    sets = cut_lineage(shingle_sets(docs, words, link), "shingle-sets")
    nodes = sets.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("first_id"))
    rooted = cut_lineage(nodes.join(components(docs, sets, words, link), "node", "left").withColumn("root", F.coalesce("root", "node")), "roots")
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = cut_lineage(rooted.join(smallest, "root").select("node", "component_id"), "components")
    out = sets.select("doc_id", "n", "node").join(named, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
