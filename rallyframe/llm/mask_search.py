"""Ranked lexical search that groups documents by the mask of an item's terms they hold.

The documents are read once per pass of items: each becomes its number of terms and its postings, the
terms of the items it holds and how often, written to the shared folder. Document frequencies come
from the postings. Then every task takes its documents in blocks. Per item the documents that
could reach the k-th score so far (they hold a term without which all others together fall short of
it) get a bitmap of the item's terms; documents of one bitmap are a group, whose maximum score is the sum
of its terms' best contributions in the block. Groups are evaluated by descending maximum until it is below
the k-th exact score, so nothing that belongs to the answer is left out. One document in FIRST (by
hash) is ranked beforehand; its k-th scores are the thresholds that every task starts from, so what tasks
hand on does not grow with their number.

A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), in doubles; everything else is whole numbers:
weight * ((10**9 tf) div (1000 tf + 12 m)) summed over an item's terms, repeats included, with
m = 75 + (25 n N) div L; N documents with a term, L terms in all, n and tf of the document.

Terms are found by 64-bit hashes and then compared byte by byte. Items that hold more than ENTRIES different
terms together are searched in several passes, so a worker never holds more.

Cases: null, empty and termless texts match nothing and count in N for nothing; null document ids come
last among equal scores; item rows that agree in id and text are one item, others are items of
their own, a null id included; an item without terms has no rows; long texts are one row; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rallyframe.workspace import materialise

from .common import Words, with_text_columns

ENTRIES = 500_000          # different terms of all items of one pass, about
FIRST = 32                 # one document in so many is ranked first
BLOCK_DOCS = 8192          # documents whose masks are made at once, at most
BLOCK_POSTINGS = 1 << 20   # and their postings (a longer document is a block of its own)
LOOK = 4                   # documents evaluated at once, at least, in multiples of k
_LOW = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, zeros after the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


class Vocabulary:
    """Terms by number, found in a batch of texts by hash and confirmed by their bytes."""

    def __init__(self, terms: list[str]):
        own = Words(pa.array(terms, pa.string()))
        hashed = own.hashes(own.starts, own.ends)
        order = np.argsort(hashed, kind="stable")
        self.number, self.hashed = own.doc[order], hashed[order]
        self.starts, self.lengths = own.starts[order], (own.ends - own.starts)[order]
        self.bytes = own.data
        self.most = int(np.unique(hashed, return_counts=True)[1].max(initial=0))

    def find(self, words: Words) -> np.ndarray:
        """Number of each word, -1 for words that are no term."""
        found = np.full(len(words.starts), -1, np.int64)
        if not len(self.hashed) or not len(found):
            return found
        hashed, lengths = words.hashes(words.starts, words.ends), words.ends - words.starts
        at = np.searchsorted(self.hashed, hashed)
        mine, theirs = _eights(words.data), _eights(self.bytes)
        for step in range(self.most):  # terms of one hash stand next to each other
            spot = np.minimum(at + step, len(self.hashed) - 1)
            rows = np.flatnonzero((self.hashed[spot] == hashed) & (self.lengths[spot] == lengths))
            good, spot = np.ones(len(rows), bool), spot[rows]
            for k in range(0, int(lengths[rows].max(initial=0)), 8):
                live = np.flatnonzero(good & (lengths[rows] > k))
                a, b = mine[words.starts[rows[live]] + k], theirs[self.starts[spot[live]] + k]
                good[live] = (a ^ b) & _LOW[np.minimum(8, lengths[rows[live]] - k)] == 0
            found[rows[good]] = self.number[spot[good]]
        return found


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(np.int32)))


def postings(docs: DataFrame, terms: list[str], text: str, keep: list[str]) -> DataFrame:
    """``keep`` with n (terms in all), terms (numbers, ascending) and tf (how often) of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)  # about ENTRIES

    def make():
        vocabulary = Vocabulary(shared.value)

        def work(texts):
            words = Words(texts)
            number = vocabulary.find(words)
            hit = number >= 0
            span = max(1, len(shared.value))
            both, tf = np.unique(words.doc[hit] * span + number[hit], return_counts=True)
            ends = np.searchsorted(both, np.arange(words.count + 1) * span)
            return [pa.array(np.bincount(words.doc, minlength=words.count)[:words.count]), _lists(both % span, ends), _lists(tf, ends)]
        return work

    ints = T.ArrayType(T.IntegerType())
    return with_text_columns(docs, text, [("n", T.LongType()), ("terms", ints), ("tf", ints)], make, keep)


def item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_no, item_id, terms): one row per different item, its terms in order with repeats."""
    def make():
        def work(texts):
            words = Words(texts)
            lists: list[list[str]] = [[] for _ in range(words.count)]
            data = words.data.tobytes()
            for doc, a, b in zip(words.doc.tolist(), words.starts.tolist(), words.ends.tolist()):
                lists[doc].append(data[a:b].decode())
            return [lists]
        return work

    own = items.select(F.col(item_id).alias("item_id"), F.col(text).cast("string").alias("text")).distinct()
    found = with_text_columns(own, "text", [("terms", T.ArrayType(T.StringType()))], make, ["item_id"]).where(F.size("terms") > 0)
    return materialise(found.withColumn("item_no", F.monotonically_increasing_id()), "items")


class Query:
    """An item's terms with how often it holds them, and the best documents so far."""

    def __init__(self, terms: np.ndarray, times: np.ndarray, weights: np.ndarray, floor: int):
        self.terms, self.gain = terms, times * weights[terms]
        self.floor = floor                       # a score that the k-th reaches at least
        self.score = np.zeros(0, np.int64)
        self.doc = np.zeros(0, np.int64)
        self.none = np.zeros(0, bool)

    def add(self, k: int, score: np.ndarray, doc: np.ndarray, none: np.ndarray) -> None:
        """Keep the first k by score, greatest first, then by id, null last."""
        self.score, self.doc, self.none = (np.concatenate(x) for x in ((self.score, score), (self.doc, doc), (self.none, none)))
        first = np.lexsort((self.doc, self.none, -self.score))[:k]
        self.score, self.doc, self.none = self.score[first], self.doc[first], self.none[first]
        if len(first) == k:
            self.floor = max(self.floor, int(self.score[-1]))


class Block:
    """Documents in hand: their postings by document and by term, and what each posting contributes per weight."""

    def __init__(self, doc: np.ndarray, none: np.ndarray, m: np.ndarray, sizes: np.ndarray, terms: np.ndarray, tf: np.ndarray, span: int):
        self.doc, self.none, self.terms = doc, none, terms
        self.ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        row = np.repeat(np.arange(len(doc)), sizes)
        tf = tf.astype(np.int64)
        self.gives = (1_000_000_000 * tf) // (1000 * tf + 12 * m[row])
        order = np.argsort(terms, kind="stable")
        self.by_term, self.term_ends = row[order], np.searchsorted(terms[order], np.arange(span + 1))
        self.best = np.zeros(span, np.int64)
        held = np.flatnonzero(np.diff(self.term_ends))
        if len(held):
            self.best[held] = np.maximum.reduceat(self.gives[order], self.term_ends[held])

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the postings of these documents are, one after another, and where each document begins."""
        sizes = self.ends[rows + 1] - self.ends[rows]
        starts = np.cumsum(sizes) - sizes
        return np.arange(sizes.sum()) + np.repeat(self.ends[rows] - starts, sizes), starts

    def candidates(self, query: Query, most: np.ndarray) -> np.ndarray:
        """Documents with a term that the others need to reach the floor."""
        order = np.argsort(most, kind="stable")
        needed = query.terms[order[np.cumsum(most[order]) >= max(1, query.floor)]]
        hit = np.zeros(len(self.doc), bool)
        for t in needed:
            hit[self.by_term[self.term_ends[t]:self.term_ends[t + 1]]] = True
        return np.flatnonzero(hit)

    def groups(self, query: Query, most: np.ndarray, rows: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The group of each document, by its mask of the query's terms, and the maximum score of each group."""
        at, starts = self.of(rows)
        own = self.terms[at]
        group, bound = np.zeros(len(rows), np.int64), np.zeros(1, np.int64)
        for first in range(0, len(query.terms), 64):  # a mask of 64 terms at a time
            part = query.terms[first:first + 64]
            bit[part] = _BITS[:len(part)]
            masks, inverse = np.unique(np.bitwise_or.reduceat(bit[own], starts), return_inverse=True)
            bit[part] = 0
            most_of = ((masks[:, None] & _BITS[:len(part)]) != 0) @ most[first:first + 64]
            pairs, group = np.unique(group * len(masks) + inverse, return_inverse=True)
            bound = bound[pairs // len(masks)] + most_of[pairs % len(masks)]
        return group, bound

    def rank(self, query: Query, k: int, bit: np.ndarray, gain: np.ndarray) -> None:
        most = query.gain * self.best[query.terms]
        rows = self.candidates(query, most)
        if not len(rows):
            return
        group, bound = self.groups(query, most, rows, bit)
        order = np.argsort(-bound, kind="stable")
        members = np.argsort(group, kind="stable")
        sizes = np.bincount(group, minlength=len(bound))
        begins, upto, at = np.cumsum(sizes) - sizes, np.cumsum(sizes[order]), 0
        gain[query.terms] = query.gain
        while at < len(order) and bound[order[at]] >= max(1, query.floor):
            before = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, before + LOOK * k, "right")))
            now = order[at:end][bound[order[at:end]] >= max(1, query.floor)]
            chosen = rows[members[np.concatenate([np.arange(begins[g], begins[g] + sizes[g]) for g in now])]]
            spots, starts = self.of(chosen)
            score = np.add.reduceat(gain[self.terms[spots]] * self.gives[spots], starts)
            good = score >= max(1, query.floor)
            query.add(k, score[good], self.doc[chosen[good]], self.none[chosen[good]])
            at = end
        gain[query.terms] = 0


def _ranked(rows: DataFrame, held, k: int) -> DataFrame:
    """(item_no, doc_id, score): the first k documents of every item in each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items, n_docs, n_terms = held.value
        span = len(weights)
        bit, gain = np.zeros(span, np.uint64), np.zeros(span, np.int64)
        queries = {no: Query(terms, times, weights, floor) for no, terms, times, floor in items}
        waiting: list[tuple] = []

        def work() -> None:
            if not waiting:
                return
            doc, none, n, sizes, terms, tf = (np.concatenate(x) for x in zip(*waiting))
            waiting.clear()
            block = Block(doc, none, 75 + (25 * n * n_docs) // n_terms, sizes, terms, tf, span)
            for query in queries.values():
                block.rank(query, k, bit, gain)

        count = 0
        for batch in batches:
            lists = batch.column("terms")
            sizes = np.diff(lists.offsets.to_numpy())
            begin = 0
            while begin < batch.num_rows:
                room = max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), BLOCK_POSTINGS - count, "right")))
                part = slice(begin, begin + min(room, BLOCK_DOCS))
                own = batch.slice(part.start, part.stop - part.start)
                waiting.append((own.column("doc_id").fill_null(0).to_numpy(), own.column("doc_id").is_null().to_numpy(zero_copy_only=False), own.column("n").to_numpy(),
                                sizes[part], own.column("terms").flatten().to_numpy(), own.column("tf").flatten().to_numpy()))
                count += int(sizes[part].sum())
                begin = min(part.stop, batch.num_rows)
                if count >= BLOCK_POSTINGS or sum(len(w[0]) for w in waiting) >= BLOCK_DOCS or begin < batch.num_rows:
                    work()
                    count = 0
        work()
        for no, q in queries.items():
            if len(q.doc):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q.doc), no)), pa.array(q.doc, mask=q.none), pa.array(q.score)], names=["item_no", "doc_id", "score"])

    return rows.select("doc_id", "n", "terms", "tf").mapInArrow(run, "item_no long, doc_id long, score long")


def _first(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("item_no").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 20, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
           item_text: str = "text", entries: int = ENTRIES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item; document ids are whole numbers."""
    spark = docs.sparkSession
    asked = item_terms(items, item_id, item_text)
    held = asked.agg(F.sum(F.size(F.array_distinct("terms")))).first()[0] or 0
    passes = max(1, -(-held // entries))
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    answers = None
    for turn in range(passes):
        own = asked.where(F.pmod(F.xxhash64("item_no"), F.lit(passes)) == turn).select("item_no", "terms").collect()  # about ``entries`` terms
        terms = sorted({t for r in own for t in r.terms})
        number = {t: i for i, t in enumerate(terms)}
        rows = materialise(postings(source, terms, "text", ["doc_id"]), "postings")
        n_docs, n_terms = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(terms), np.int64)
        for r in rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # one row per term
            weights[r["t"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["count"] + 1)))
        queries = [(r.item_no, *np.unique([number[t] for t in r.terms], return_counts=True)) for r in own]
        some = rows.where("size(terms) > 0")
        give = lambda floors: spark.sparkContext.broadcast((weights, [(*q, floors.get(q[0], 0)) for q in queries], n_docs, max(1, n_terms)))  # noqa: B023, E731
        early = _first(_ranked(some.where(F.pmod(F.xxhash64("doc_id"), F.lit(FIRST)) == 0), give({}), k), k).where(F.col("rank") == k)
        floors = {r.item_no: r.score for r in early.collect()}  # one row per item of this pass
        found = materialise(_first(_ranked(some, give(floors), k), k), "ranked")
        answers = found if answers is None else answers.unionByName(found)
    return answers.join(asked.select("item_no", "item_id"), "item_no").select("item_id", "rank", "doc_id", "score")
