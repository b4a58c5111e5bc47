"""Near copies by the Jaccard similarity of five-word shingles, exactly.

Two texts are linked when their sets of shingles have a similarity of at least 4/5, and groups are the
components of these links. Texts of equal sets are one class. Every set is put into one order; whatever
the order is, two similar sets share a shingle among the first n // 5 + 1 of each (n the size), and at
the first shared one enough of both sets is left to come to 4/9 of the sizes' sum. Shingles are ordered
by hash, but those that more than LONG classes have in their first part come last: they are counted
exactly over all classes, and each class whose first part holds some is told so and takes the next
shingles instead. So the lists of classes behind a shingle stay short however large the table is, but for
classes that consist of such shingles nearly alone.

Groups begin with SimHash: the vantage-point trees of ``simhash_vp`` link fingerprints of up to three differing
bits, and what the texts confirm at 4/5 is one group. Three bits miss most links of 4/5, so two rounds then compare
every class with at most one other, the leader of the list that they share most often (first the class with the
fewest rare shingles, then one at random), and what is similar joins the groups. Last, classes of different groups meet in the lists they share. A pair comes out of that join only if
sizes, places in the order and a bitmap of 256 parities of the sets (its differing bits are at most the
differing shingles) leave 4/5 possible, and out of the next step if longer bitmaps do; the texts of what
remains are read and their sets compared. Order, rounds and bitmaps decide the cost, never which links are found.

Words are lower-cased (A-Z) and cut at ASCII white space, as for ``simhash_vp``; a text of fewer than five
words is one shingle. Null, empty and wordless texts are equal to each other. Long texts are one row and
one set. Classes are told apart by 128-bit digests. Null ids take part and come last; among equal ids one text
of a group stays; extra columns pass through; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rallyframe.workspace import materialise

from .common import fresh, with_text_columns
from .simhash_vp import components, fingerprint
from .simhash_vp import links as tree_links

WORDS = 5
LONG = 16                # a shingle in the first part of more classes comes last in the order
SKETCH = 4               # 64-bit words of the short parity bitmap; the long one has about two bits a shingle
SIDE_BY_SIDE = 64        # texts that are compared with one other in a task, about
BROADCAST = 1 << 18      # rows sent to all executors, at most; more are joined by a shuffle
MOST_BITS = 1 << 27      # of the bitmap that keeps shingles of one class out of the shuffle


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the distinct shingles, ascending."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words])
    begins, ends = [0, *ends[:-WORDS].tolist()], (ends[min(WORDS, len(words)) - 1:] - 1).tolist()
    return np.unique(np.array([digest(line[a:b], 42) for a, b in zip(begins, ends)], np.uint64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)])
    flat = np.concatenate([np.zeros(0, np.int64), *(a.view(np.int64) for a in arrays)])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


def _sketch(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which buckets hold an odd number of the shingles: in a power of two of words, and folded to SKETCH words."""
    words = max(SKETCH, 1 << (len(found) // 32).bit_length())
    odd = np.bincount((found >> np.uint64(7)).astype(np.int64) % (64 * words), minlength=64 * words) & 1
    short = odd.reshape(-1, 64 * SKETCH).sum(0) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64), np.packbits(short.astype(np.uint8)).view(np.int64)


def with_shingles(docs: DataFrame, text: str, keep: list[str], whole: bool = False) -> DataFrame:
    """(keep, fp, n, tokens, sketch, s0 ...): digest, size, shingles by hash (all, or the first n // 5 + n // 10 + 9, then with ``bits``, the SimHash) and bitmaps."""
    def make():
        def work(texts):
            sets = [shingles(t.as_py()) for t in texts]
            fps = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            first = sets if whole else [s[:len(s) // 5 + len(s) // 10 + 9] for s in sets]
            bits = [_sketch(s) for s in sets]
            short = np.array([b for _, b in bits], np.int64).reshape(-1, SKETCH)
            return [pa.array(fps, pa.binary()), pa.array([len(s) for s in sets], pa.int32()), _lists(first), _lists([b for b, _ in bits]), *(pa.array(c) for c in short.T),
                    *([] if whole else [pa.array(np.array([fingerprint(t.as_py()) for t in texts], np.uint64).view(np.int64))])]
        return work

    longs = T.ArrayType(T.LongType())
    fields = [("fp", T.BinaryType()), ("n", T.IntegerType()), ("tokens", longs), ("sketch", longs), *((f"s{i}", T.LongType()) for i in range(SKETCH))]
    fields += [] if whole else [("bits", T.LongType())]
    return with_text_columns(docs, text, fields, make, keep)


def spot(own: Column, hashed: Column) -> Column:
    """One exact text for id and text digest."""
    return F.concat(hashed, F.when(own.isNull(), "-").otherwise(F.concat(F.lit("="), own.cast("string"))))


def small(rows: DataFrame) -> DataFrame:
    """``rows`` (written before), marked for a broadcast if there are few."""
    return F.broadcast(rows) if rows.count() <= BROADCAST else rows


def _first(n: int, tokens: np.ndarray, late: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The first n // 5 + 1 shingles with late ones last, and those of them that are not among the first by hash.

    ``tokens`` are the first by hash, or all; None if too few are known.
    """
    size, others = n // 5 + 1, np.flatnonzero(~late)
    if len(others) < size and len(tokens) < n:
        return None
    order = np.concatenate([others, np.flatnonzero(late)])[:size]
    return tokens[order], tokens[order[(order >= size) | late[order]]]


def _walk(classes: DataFrame, long, make, schema: str) -> DataFrame:
    """``make`` of an iterator over (c, first parts or None) of each batch; ``long`` is a broadcast array, or classes have a column late."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
            found = []
            for i, (c, n) in enumerate(zip(batch.column("c").to_pylist(), batch.column("n").to_pylist())):
                tokens = flat[ends[i]:ends[i + 1]]
                if long is None:
                    late = np.isin(tokens, np.array(batch.column("late")[i].as_py() or [], np.int64))
                else:
                    at = np.searchsorted(long.value, tokens)
                    late = np.take(long.value, at, mode="clip") == tokens if len(long.value) else np.zeros(len(tokens), bool)
                found.append((c, _first(n, tokens, late)))
            yield make(found)

    return classes.select("c", "n", "tokens", *(["late"] if long is None else [])).mapInArrow(run, schema)


def _longs(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *arrays])


def first_parts(classes: DataFrame, sets_of) -> DataFrame:
    """(token, c, at): the first n // 5 + 1 shingles of each class, those of long lists last, as far as another class may have them too."""
    spark = classes.sparkSession
    counts = classes.select(F.explode(F.slice("tokens", F.lit(1), F.floor(F.col("n") / 5).cast("int") + 1)).alias("token"))
    counts = materialise(counts.groupBy("token").agg(F.count("*").alias("held")).where("held > 1"), "shared-shingles")
    long = materialise(counts.where(F.col("held") > LONG).select("token"), "long-shingles")
    if long.count() <= BROADCAST:
        held = spark.sparkContext.broadcast(np.sort(long.toArrow().column("token").to_numpy()))
        known = lambda rows: rows
    else:  # each class is told which of its shingles are meant
        held = None
        known = lambda rows: rows.join(
            rows.select("c", F.explode("tokens").alias("token")).join(long, "token", "left_semi").groupBy("c").agg(F.collect_list("token").alias("late")), "c", "left")

    def moved(found) -> pa.RecordBatch:
        new, poor = _longs([x[1] for _, x in found if x]), np.array([c for c, x in found if not x], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate([new, poor])), pa.array(np.arange(len(new) + len(poor)) >= len(new))], names=["x", "poor"])

    stored = known(classes)
    told = materialise(_walk(stored, held, moved, "x long, poor boolean"), "moved")
    poor = told.where("poor").select(F.col("x").alias("c"))  # the stored shingles are nearly all late
    whole = known(sets_of(poor).withColumn("n", F.size("tokens")))
    again = _walk(whole, held, moved, "x long, poor boolean")
    candidates = counts.where(F.col("held") <= LONG).select("token").union(told.where("NOT poor").select("x")).union(again.select("x"))
    bits = _bitmap(materialise(candidates.distinct(), "candidates"))

    def entries(found) -> pa.RecordBatch:
        rows = [(c, x[0], np.flatnonzero(_marked(bits.value, x[0]))) for c, x in found if x]
        return pa.RecordBatch.from_arrays([pa.array(_longs([x[at] for _, x, at in rows])), pa.array(np.repeat(np.array([c for c, _, _ in rows], np.int64), [len(at) for _, _, at in rows])),
                                           pa.array(_longs([at for _, _, at in rows]).astype(np.int32))], names=["token", "c", "at"])

    kind = "token long, c long, at int"
    return _walk(stored, held, entries, kind).unionByName(_walk(whole, held, entries, kind))


def _bitmap(tokens: DataFrame):
    """A broadcast bitmap that has a bit of each token set; it only thins out rows, and less so the more tokens there are."""
    size = int(min(MOST_BITS, 1 << max(10, (8 * tokens.count()).bit_length())))
    at = F.col("token").bitwiseAND(size - 1)
    words = tokens.select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, cast((token & {size - 1}L) & 63 as int))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(size >> 6, np.int64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return tokens.sparkSession.sparkContext.broadcast(bits.view(np.uint64))


def _marked(bits: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    at = tokens & (len(bits) * 64 - 1)
    return (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


def _possible(x: str, y: str, bitmaps: bool = False) -> Column:
    """Whether sizes and places of two list entries, and their short bitmaps, leave a similarity of 4/5 possible."""
    f = lambda side, name: F.col(f"{side}.{name}")
    total = f(x, "n") + f(y, "n")
    fits = ((5 * F.least(f(x, "n"), f(y, "n")) >= 4 * F.greatest(f(x, "n"), f(y, "n")))
            & (9 * F.least(f(x, "n") - f(x, "at"), f(y, "n") - f(y, "at")) >= 4 * total))
    apart = sum((F.bit_count(f(x, f"s{i}").bitwiseXOR(f(y, f"s{i}"))) for i in range(SKETCH)), F.lit(0)) if bitmaps else F.lit(0)
    return fits & (9 * apart <= total)


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose long bitmaps leave a similarity of 4/5 possible; the longer one is folded to the other's length."""
    own = lambda end: classes.select(F.col("c").alias(end), F.col("n").alias(f"n_{end}"), F.col("sketch").alias(f"sketch_{end}"))
    xor = lambda p, q: p.bitwiseXOR(q)

    def folded(x: Column, y: Column) -> Column:
        half = F.size(y)
        return F.when(F.size(x) > half, F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), xor)).otherwise(x)

    both = pairs.join(own("a"), "a").join(own("b"), "b")
    a, b = F.col("sketch_a"), F.col("sketch_b")
    apart = F.aggregate(F.zip_with(folded(a, b), folded(b, a), xor), F.lit(0), lambda s, x: s + F.bit_count(x))
    return both.where(9 * apart <= F.col("n_a") + F.col("n_b")).select("a", "b")


def _similar(pairs: DataFrame, texts_of) -> DataFrame:
    """The pairs (a, b) whose sets have a similarity of at least 4/5: the texts of some a meet that of their b in one task."""
    often = pairs.groupBy("b").agg(F.ceil(F.count("*") / SIDE_BY_SIDE).alias("salts"))
    dealt = pairs.join(often, "b").select("a", "b", F.pmod(F.xxhash64("a"), "salts").alias("salt"))
    ends = dealt.select(F.col("a").alias("c"), "b", "salt").union(dealt.select("b", "b", "salt").distinct())
    rows = texts_of(materialise(ends, "ends")).repartition("b", "salt").dropDuplicates(["b", "salt", "c"])

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        sets = {c: shingles(t) for c, t in zip(table.column("c").to_pylist(), table.column("text").to_pylist())}
        b = key[0].as_py()
        first = sets.pop(b)
        good = [a for a, s in sets.items() if 9 * len(np.intersect1d(s, first, assume_unique=True)) >= 4 * (len(s) + len(first))]
        return pa.table({"a": pa.array(good, pa.int64()), "b": pa.array([b] * len(good), pa.int64())})

    return rows.groupBy("b", "salt").applyInArrow(compare, "a long, b long")


def tree_pairs(classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes (c, bits) that the vantage-point trees link: each class with one of its fingerprint, and with one of every fingerprint linked to it."""
    first = materialise(classes.groupBy("bits").agg(F.min("c").alias("b")), "bits")
    tied = tree_links(first.select(F.col("bits").alias("fp"))).select(F.col("a").alias("bits"), F.col("b").alias("to"))
    near = tied.join(first.select(F.col("bits").alias("to"), "b"), "to").select("bits", "b")
    return classes.select("bits", F.col("c").alias("a")).join(first.union(near), "bits").where("a <> b").select("a", "b").distinct()


def links(classes: DataFrame, sets_of, texts_of) -> DataFrame:
    """A set of links (a, b) with the components of all links, of classes (c, n, tokens, sketch, s0 ..., bits).

    ``sets_of`` gives (c, tokens) for some c, ``texts_of`` adds the text to rows with a column c.
    """
    met = materialise(first_parts(classes, sets_of), "lists")
    shared = met.groupBy("token").agg(F.count("*").alias("held")).where("held > 1").select("token")
    met = materialise(met.join(shared, "token", "left_semi").join(classes.select("c", "n"), "c"), "met")
    found = materialise(_similar(materialise(_likely(tree_pairs(classes), classes), "tree-pairs"), texts_of), "tree-found")
    for leader in (F.struct("at", "c"), F.struct(F.xxhash64("c"))):
        rows = _rooted(met, found)
        lead = rows.groupBy("token").agg(F.min_by(F.struct("c", "n", "at", "root"), leader).alias("lead")).select("token", "lead.*")
        near = rows.alias("x").join(lead.alias("y"), F.col("x.token") == F.col("y.token")).where((F.col("x.root") != F.col("y.root")) & _possible("x", "y"))
        counted = near.groupBy(F.col("x.c").alias("a"), F.col("y.c").alias("b")).agg(F.count("*").alias("often"))
        best = counted.groupBy("a").agg(F.max(F.struct("often", "b")).alias("best")).select("a", "best.b")
        found = found.union(materialise(_similar(materialise(_likely(best, classes), "pairs"), texts_of), "found"))
    rows = materialise(_rooted(met, found), "rooted")
    sizes = rows.groupBy("token", "root").agg(F.count("*").alias("held"))
    home = sizes.groupBy("token").agg(F.max(F.struct("held", "root")).alias("most"), F.count("*").alias("roots")).where("roots > 1")
    mixed = rows.join(home.select("token", F.col("most.root").alias("home")), "token")
    rows = materialise(mixed.join(classes.select("c", *(f"s{i}" for i in range(SKETCH))), "c"), "mixed")
    # of two groups one is not the list's largest
    left, right = rows.where("root <> home").alias("x"), rows.alias("y")
    once = (F.col("y.root") == F.col("y.home")) | (F.col("x.c") > F.col("y.c"))
    late = left.join(right, (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root")) & once & _possible("x", "y", bitmaps=True))
    late = late.select(F.greatest("x.c", "y.c").alias("a"), F.least("x.c", "y.c").alias("b")).distinct()
    return found.union(_similar(materialise(_likely(late, classes), "late"), texts_of))


def _rooted(met: DataFrame, found: DataFrame) -> DataFrame:
    """List entries with the group of their class."""
    roots = components(found).withColumnRenamed("a", "c")
    return met.join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Of each group the document of smallest id (nulls last), columns unchanged; among equal ids one text stays."""
    place, content = fresh(docs.columns, "place"), F.coalesce(F.md5(F.col(text).cast("string")), F.lit("-"))
    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), content.alias("x0"))
    marked = with_shingles(source, "text", ["id", "x0"])
    order = F.struct(F.col("id").isNull().alias("none"), "id", "x0")
    rest = ("n", "tokens", "sketch", "bits", *(f"s{i}" for i in range(SKETCH)))
    classes = marked.groupBy("fp").agg(F.min(order).alias("first"), *(F.any_value(x).alias(x) for x in rest))
    classes = materialise(classes.withColumn("c", F.monotonically_increasing_id()), "classes")
    named = classes.select("c", spot(F.col("first.id"), F.col("first.x0")).alias("spot"))

    def texts_of(rows: DataFrame) -> DataFrame:
        """Rows with a column c, and the text of the document that stands for it (as often as that is there)."""
        wanted = small(materialise(named.join(rows, "c"), "wanted"))
        return source.withColumn("spot", spot(F.col("id"), F.col("x0"))).join(wanted, "spot").select(*rows.columns, "text")

    def sets_of(some: DataFrame) -> DataFrame:
        texts = texts_of(some).dropDuplicates(["c"])
        return materialise(with_shingles(texts, "text", ["c"], whole=True).select("c", "tokens"), "sets")

    roots = components(links(classes, sets_of, texts_of)).withColumnRenamed("a", "c")
    rooted = classes.select("c", "first").join(roots, "c", "left").select(F.coalesce("root", "c").alias("root"), "first")
    kept = rooted.groupBy("root").agg(F.min("first").alias("first")).select(spot(F.col("first.id"), F.col("first.x0")).alias(place))
    return docs.withColumn(place, spot(F.col(doc_id), content)).join(kept, place, "left_semi").dropDuplicates([place]).select(*docs.columns)
