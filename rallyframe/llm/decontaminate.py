"""Benchmark decontamination with Wu-Manber search over words.

A window is ten consecutive words of an item (all of a shorter item). Windows of one length form a
scanner: the words are its alphabet, and blocks of two words its shift keys. At each position the
block that ends there says how far the scanner may jump; a block that closes some window (shift
zero) leads to the few windows with that ending, which are compared directly.

Windows that do not fit a scanner of PATTERNS are searched in further passes over the documents,
each written to the shared folder, so a worker never holds more than one scanner.

Cases: null and empty texts have no words; items without words have no window; items or windows that
repeat are found once each; a null item id counts as the empty id; extra columns pass through; long texts
are one row.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rallyframe.workspace import materialise

from .common import LOWER, fresh, with_text_columns

WINDOW = 10
BLOCK = 2
PATTERNS = 100_000       # windows of one scanner, about 1.6 kB each: 160 MB in the driver and in a worker
_TABLE = bytes(LOWER)


def words_of(text: str | None) -> list[bytes]:
    """Words of ASCII letters and digits and of any other characters, A-Z lower-cased."""
    return (text or "").encode().translate(_TABLE).split()


@dataclass
class Scanner:
    """Windows of one length: how far to move on after a block, and the windows that end with it."""

    size: int
    block: int
    shift: dict[tuple, int]
    endings: dict[tuple, list[tuple[tuple, tuple]]]   # block -> (window, item ids)

    @classmethod
    def build(cls, size: int, windows: dict[tuple, tuple]) -> Scanner:
        block = min(BLOCK, size)
        shift: dict[tuple, int] = {}
        endings: dict[tuple, list] = defaultdict(list)
        for window, items in windows.items():
            for end in range(block, size + 1):
                key = window[end - block:end]
                shift[key] = min(shift.get(key, size), size - end)
            endings[window[size - block:]].append((window, items))
        return cls(size, block, shift, dict(endings))

    def search(self, words: list[bytes]) -> Iterable[tuple[int, tuple]]:
        """Start and items of every occurrence."""
        size, block, shift, n = self.size, self.block, self.shift, len(words)
        far, at = size - block + 1, size
        while at <= n:
            key = tuple(words[at - block:at])
            move = shift.get(key, far)
            if move:
                at += move
                continue
            start = at - size
            own = tuple(words[start:at])
            for window, items in self.endings[key]:
                if window == own:
                    yield start, items
            at += 1


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(words, items): every distinct window and the ids, as text, of the items that hold it."""
    words = F.filter(F.split(F.translate(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "),
                                         "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), " "), lambda w: w != "")
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words.alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (WINDOW - 1), F.lit(1)))
    cut = rows.select("item", "w", F.explode(starts).alias("i")).select("item", F.slice("w", F.col("i"), F.lit(WINDOW)).alias("words"))
    return cut.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _scanners(rows: list) -> list[Scanner]:
    by_size: dict[int, dict[tuple, tuple]] = defaultdict(dict)
    for r in rows:
        by_size[len(r["words"])][tuple(w.encode() for w in r["words"])] = tuple(r["items"])
    return [Scanner.build(size, windows) for size, windows in sorted(by_size.items())]


_HIT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("starts", T.ArrayType(T.IntegerType())),
                     T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("items", T.ArrayType(T.StringType()))])


def _search(docs: DataFrame, scanners: list[Scanner], text: str, name: str, keep: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(scanners)  # at most PATTERNS windows

    def make():
        kind = pa.struct([("n_words", pa.int64()), ("starts", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])

        def one(t: str | None) -> dict:
            words, starts, sizes, items = words_of(t), [], [], set()
            for scanner in shared.value:
                for start, own in scanner.search(words):
                    starts.append(start)
                    sizes.append(scanner.size)
                    items.update(own)
            return {"n_words": len(words), "starts": starts, "sizes": sizes, "items": sorted(items)}

        return lambda texts: [pa.array([one(t.as_py()) for t in texts], kind)]

    return with_text_columns(docs, text, [(name, _HIT)], make, keep)


def _covered(found: Column) -> Column:
    """Words inside any occurrence."""
    spans = F.array_sort(F.arrays_zip(found["starts"].alias("s"), found["sizes"].alias("n")))
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("sum"))
    add = lambda a, s: F.struct(F.greatest(a["upto"], s["s"] + s["n"]).alias("upto"),
                                (a["sum"] + F.greatest(F.lit(0), s["s"] + s["n"] - F.greatest(a["upto"], s["s"]))).alias("sum"))
    return F.aggregate(spans, zero, add, lambda a: a["sum"])


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", keep: list[str] | None = None,
                       patterns: int = PATTERNS) -> DataFrame:
    """``keep`` (all columns by default), n_words, n_hit, n_items, item_ids and contaminated.

    item_ids are the ids, as text and sorted, of the items with an occurring window (a null id is empty).
    """
    made = ["n_words", "n_hit", "n_items", "item_ids", "contaminated"]
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in made]
    windows = materialise(item_windows(benchmark), "windows")
    passes = max(1, -(-windows.count() // patterns))
    names: list[str] = []
    state = docs
    for turn in range(passes):
        own = windows.where(F.pmod(F.xxhash64("words"), F.lit(passes)) == turn).collect()  # about ``patterns`` windows
        names.append(fresh([*keep, *names, *docs.columns], f"hits_{turn}"))
        last = turn == passes - 1
        state = _search(state, _scanners(own), text, names[-1], [*keep, *names[:-1], *([] if last or text in keep else [text])])
        state = state if last else materialise(state, "searched")
    found = F.struct(F.col(names[0])["n_words"].alias("n_words"), *(F.flatten(F.array(*(F.col(n)[f] for n in names))).alias(f) for f in ("starts", "sizes", "items")))
    whole = fresh(keep, "found")
    ids = F.array_sort(F.array_distinct(F.col(whole)["items"]))
    hit = _covered(F.col(whole))
    return state.select(*keep, found.alias(whole)).select(
        *keep, F.col(whole)["n_words"].alias("n_words"), hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"),
        (F.size(F.col(whole)["starts"]) > 0).alias("contaminated"))
