"""Near-duplicates by SimHash, linked exactly with vantage-point trees.

Two fingerprints within three bits differ in at most one bit of their upper or of their lower half,
so one tree per half searches with radius 1. A tree node holds a vantage point and a distance: codes
up to that distance go in, the others out; a code whose distance is within the radius of the border
is sent to both sides (the triangle inequality rules out every other branch). Leaves are shards:
each fingerprint lives in one and visits those its ball overlaps. Inside a shard the full distance
decides, so the links are exact; trees only spread the work. Shards hand on a spanning set of links,
never all pairs, and components are joined by alternating stars.

Trees are fitted on a bounded sample of fingerprints; every fingerprint is indexed and searched.
A shard with more than SHARD_ROWS rows is cut into blocks, and every pair of blocks is a task.

Cases: a null, empty or wordless text has fingerprint zero and links like any other; equal
fingerprints are one class; a null id takes part and is never the smallest id unless all are null;
repeated rows repeat; long texts are one row. Extra columns pass through ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rallyframe.workspace import materialise

from .common import fresh, with_text_columns

SHINGLE = 3
DISTANCE = 3             # links of up to so many bits
RADIUS = 1               # in the nearer half
TREE_SAMPLE = 1 << 16    # fingerprints that the trees are fitted on; beyond 2**22 fingerprints a 64th of them
MOST_SAMPLE = 1 << 18    # and never more: enough for the depth that 2**24 fingerprints aim at; shards of more are cut into blocks
LEAF = 256               # fingerprints per leaf that the depth aims at
SHARD_ROWS = 50_000      # rows of a shard that one task takes
CELLS = 1 << 20          # distances computed at once
_SHIFTS = (np.uint64(32), np.uint64(0))


def fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= SHINGLE:
        return digest(line, 42)
    ends = np.cumsum([len(w) + 1 for w in words])
    begins, ends = [0, *ends[:-SHINGLE].tolist()], (ends[SHINGLE - 1:] - 1).tolist()
    hashes = np.array([digest(line[a:b], 42) for a, b in zip(begins, ends)], np.uint64)
    held = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 16):
        held += np.unpackbits(hashes[part:part + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * held > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprint(docs: DataFrame, text: str = "text", keep: list[str] | None = None, name: str = "fp") -> DataFrame:
    """Adds the fingerprint of the whole text as a signed long."""
    def make():
        return lambda texts: [pa.array(np.array([fingerprint(t.as_py()) for t in texts], np.uint64).view(np.int64))]

    return with_text_columns(docs, text, [(name, T.LongType())], make, keep)


@dataclass
class Tree:
    """Complete binary tree in arrays: node i has children 2i+1 (in) and 2i+2 (out)."""

    depth: int
    vantage: np.ndarray
    border: np.ndarray

    def home(self, codes: np.ndarray) -> np.ndarray:
        node = np.zeros(len(codes), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 2 - (np.bitwise_count(codes ^ self.vantage[node]) <= self.border[node])
        return node - len(self.vantage)

    def visits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and leaf of every leaf that may hold a code within the radius."""
        row, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        for _ in range(self.depth):
            away, border = np.bitwise_count(codes[row] ^ self.vantage[node]).astype(np.int16), self.border[node]
            inner, outer = away - RADIUS <= border, away + RADIUS > border
            row, node = np.concatenate([row[inner], row[outer]]), np.concatenate([2 * node[inner] + 1, 2 * node[outer] + 2])
        return row, node - len(self.vantage)


def grow(codes: np.ndarray, depth: int) -> Tree:
    """Of a few vantage points, the one whose border splits evenly and has the fewest codes near it."""
    rng = np.random.default_rng(5)
    nodes = (1 << depth) - 1
    tree = Tree(depth, rng.integers(0, 1 << 32, nodes, dtype=np.uint32), np.full(nodes, 16, np.int16))
    members = {0: codes}
    for node in range(nodes):
        own = members.pop(node, codes[:0])
        if len(own) >= 4:
            best = None
            for v in own[rng.integers(0, len(own), 6)]:
                away = np.bitwise_count(own ^ v)
                for border in {int(np.median(away)), int(np.median(away)) - 1}:
                    inner = np.mean(away <= border)
                    near = np.mean((away > border - RADIUS) & (away <= border + RADIUS))
                    cost = near + 2 * abs(inner - 0.5)
                    if best is None or cost < best[0]:
                        best = (cost, v, border, away <= border)
            _, tree.vantage[node], tree.border[node], inner = best
            members[2 * node + 1], members[2 * node + 2] = own[inner], own[~inner]
    return tree


def _half(fps: np.ndarray, which: int) -> np.ndarray:
    return (fps >> _SHIFTS[which]).astype(np.uint32)


def fit_trees(classes: DataFrame) -> list[Tree]:
    n = classes.count()
    bound = min(MOST_SAMPLE, max(TREE_SAMPLE, n // 64))
    first = classes.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(bound).toArrow()  # eight bytes a row
    sample = first.column("fp").to_numpy().astype(np.int64).view(np.uint64)
    depth = max(0, min(int(np.ceil(np.log2(max(1, n / LEAF)))), int(np.log2(max(1, len(sample) / 4)))))
    return [grow(_half(sample, which), depth) for which in range(2)]


def _placed(fps: np.ndarray, trees: list[Tree]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, shard and whether at home, for both trees. Of two leaves the later one sees the pair."""
    rows, shards, at_home = [], [], []
    for which, tree in enumerate(trees):
        codes = _half(fps, which)
        home = tree.home(codes)
        row, leaf = tree.visits(codes)
        kept = leaf >= home[row]
        row, leaf = row[kept], leaf[kept]
        rows.append(row)
        shards.append(leaf + (which << 32))
        at_home.append(leaf == home[row])
    return np.concatenate(rows), np.concatenate(shards), np.concatenate(at_home)


def _fps(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def links(classes: DataFrame) -> DataFrame:
    """A spanning set of links (a, b), b the smaller by unsigned order, of distinct fingerprints ``fp``."""
    trees = classes.sparkSession.sparkContext.broadcast(fit_trees(classes))  # at most 2 x MOST_SAMPLE / 4 nodes

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, n = np.unique(_placed(_fps(batch), trees.value)[1], return_counts=True)
            yield pa.RecordBatch.from_pydict({"shard": shard, "n": n})

    large = {r.shard: -(-r.n // SHARD_ROWS) for r in classes.mapInArrow(sizes, "shard long, n long")
             .groupBy("shard").agg(F.sum("n").alias("n")).where(F.col("n") > SHARD_ROWS).collect()}  # at most as many as leaves
    cuts = np.array(sorted(large), np.int64)
    into = np.array([large[s] for s in cuts.tolist()], np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = _fps(batch)
            row, shard, at_home = _placed(fps, trees.value)
            blocks = np.ones(len(row), np.int64)
            if len(cuts):
                at = np.minimum(np.searchsorted(cuts, shard), len(cuts) - 1)
                blocks = np.where(cuts[at] == shard, into[at], 1)
            own = (fps[row] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % blocks
            # in task (a, b) codes at home of block a meet the rows of block b; two at home meet once, a <= b
            copy = np.repeat(np.arange(len(row)), blocks)
            other = np.arange(len(copy)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            one = at_home[copy]
            as_home = np.flatnonzero(one)
            as_other = np.flatnonzero(~one | (other < own[copy]))
            left = np.concatenate([own[copy[as_home]], other[as_other]])
            right = np.concatenate([other[as_home], own[copy[as_other]]])
            pick = copy[np.concatenate([as_home, as_other])]
            home = np.concatenate([np.ones(len(as_home), bool), np.zeros(len(as_other), bool)])
            yield pa.RecordBatch.from_pydict({"shard": shard[pick], "a": left.astype(np.int32), "b": right.astype(np.int32),
                                              "fp": fps[row[pick]].view(np.int64), "home": home})

    def link(part: pa.Table) -> pa.Table:
        fps = part.column("fp").to_numpy().astype(np.int64).view(np.uint64)
        a, b = spanning(fps, part.column("home").to_numpy())
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    placed = classes.select("fp").mapInArrow(place, "shard long, a int, b int, fp long, home boolean")
    return placed.groupBy("shard", "a", "b").applyInArrow(link, "a long, b long").distinct()


def spanning(fps: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Link every code to the smallest of its group, groups by links of a code at home and any other.

    Codes already in one group are not compared again, so a dense group costs little.
    """
    order = np.lexsort((~home, fps))
    fps, home = fps[order], home[order]
    group = np.arange(len(fps))
    todo = np.flatnonzero(home)
    while len(todo):
        own = group[todo]
        values, counts = np.unique(own, return_counts=True)
        top = values[counts.argmax()]
        others, mine = np.arange(len(fps)), todo
        if counts.max() > 1:  # the open rows of the largest group meet the codes outside it
            mine, others = todo[own == top], np.flatnonzero(group != top)
        block = mine[:max(1, CELLS // max(1, len(others)))]
        for at in range(0, len(others), CELLS):
            part = others[at:at + CELLS]
            near = np.bitwise_count(fps[block][:, None] ^ fps[part][None, :]) <= DISTANCE
            if len(others) == len(fps):  # a code is no link of its own
                self = np.flatnonzero((block >= at) & (block < at + len(part)))
                near[self, block[self] - at] = False
            for i in np.flatnonzero(near.any(1)):
                both = np.unique(np.append(group[part[near[i]]], group[block[i]]))
                if len(both) > 1:
                    group[np.isin(group, both)] = both[0]
        todo = todo[~np.isin(todo, block)]
    linked = np.flatnonzero(group != np.arange(len(fps)))
    linked = linked[fps[linked] != fps[group[linked]]]
    return fps[linked], fps[group[linked]]


def components(edges: DataFrame) -> DataFrame:
    """(a, root) for every linked a but the root: alternate large and small stars until nothing moves.

    Roots are the smallest by signed order of the graph's nodes. Each round is written to the shared folder.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    edges, before = materialise(edges, "links"), None
    while True:
        sums = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if sums == before or not sums.n:
            return edges.select("a", F.col("b").alias("root"))
        before = sums
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b").union(least.select("a", "low")).distinct()
        edges = materialise(small, "links")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", extra: list | None = None) -> DataFrame:
    """(id, fp, root, component_id, x0, ...): root is the component, named by its smallest id; ``extra`` expressions come along."""
    names = [f"x{i}" for i in range(len(extra or []))]
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), *(c.alias(n) for c, n in zip(extra or [], names)))
    marked = materialise(with_fingerprint(source, "text", ["id", *names]), "fingerprints")
    classes = materialise(marked.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("copies")), "classes")
    roots = components(links(classes))
    rooted = classes.join(roots.withColumnRenamed("a", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    return marked.join(named.select("fp", "root", "component_id"), "fp").select("id", "fp", "root", "component_id", *names)


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Of each component the document of smallest id (nulls last), columns unchanged; among equal ids one text stays."""
    place, row_id, content = fresh(docs.columns, "place"), F.col(doc_id), F.xxhash64(F.col(text))

    def spot(own: Column, hashed: Column) -> Column:
        """One exact text for id and text hash: joining and dropping repeats by it takes one exchange."""
        return F.concat(F.lpad(F.hex(hashed), 16, "0"), F.when(own.isNull(), "-").otherwise(F.concat(F.lit("="), own.cast("string"))))

    found = near_duplicates(docs, text, doc_id, [content])
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "x0")).alias("first")
    kept = found.groupBy("root").agg(first).select(spot(F.col("first.id"), F.col("first.x0")).alias(place))
    return docs.withColumn(place, spot(row_id, content)).join(kept, place, "left_semi").dropDuplicates([place]).select(*docs.columns)
