"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rallyframe.shipping import ship
from rallyframe.workspace import shared_dir

BATCH_ROWS = 512          # rows of text that go to Python at once
PIECE_BYTES = 4_000_000   # bytes of text that numpy works on at once (a longer text is a piece of its own)


def prepare(spark: SparkSession) -> SparkSession:
    """Workers can import the package, and Arrow batches of text stay small."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(columns: list[str], name: str) -> str:
    """A column name like ``name`` that is not taken (names compare without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % divisor


def bounded_labels(labels: DataFrame, label: str, train: Column, bound: int) -> DataFrame:
    """At most ``bound`` labelled ids, the ones of lowest hash; an id with several labels takes the highest."""
    return (labels.where(train & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
            .groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (one more: the end). Null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, where, data = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about PIECE_BYTES of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    upto, begin = np.cumsum(sizes, dtype=np.int64), 0
    while begin < batch.num_rows:
        before = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, before + PIECE_BYTES, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def with_text_columns(docs: DataFrame, text: str, fields: list[tuple[str, T.DataType]],
                      make: Callable[[], Callable[[pa.Array], list]], keep: list[str] | None = None) -> DataFrame:
    """Columns that Python computes from whole texts, next to the columns ``keep`` (all by default).

    ``make`` runs once per task and returns a function from an array of texts to one array (or list)
    per field. A new column replaces one of the same name, as ``withColumn`` does.
    """
    named = {n.lower() for n, _ in fields}
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in named]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, t) for n, t in fields])
    source = fresh(keep, "text_")  # the text may itself be replaced
    frame = docs.select(*keep, F.col(text).cast("string").alias(source))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        work = make()
        kinds = [to_arrow_type(t) for _, t in fields]
        for batch in batches:
            for part in pieces(batch, source):
                made = [a if isinstance(a, pa.Array) else pa.array(a, k) for a, k in zip(work(part.column(source)), kinds)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *made], names=schema.names)

    return frame.mapInArrow(run, schema)


def _byte_kinds() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    word = np.zeros(256, bool)
    word[48:58] = word[97:123] = word[128:] = True
    lower[~word[lower]] = 32
    return lower, word


LOWER, WORD = _byte_kinds()
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """Words of a batch of texts as byte ranges; A-Z lower-cased, other ASCII than letters and digits separates.

    ``data`` has a space before each text and one at the end, so that no range or neighbour reaches
    into another text: what is computed for a text does not depend on its batch.
    """

    def __init__(self, texts: pa.Array):
        raw, offsets = utf8(texts)
        n = len(offsets) - 1
        room = np.ones(len(raw) + n + 1, bool)
        room[offsets + np.arange(n + 1)] = False
        self.raw = np.full(len(room), 32, np.uint8)
        self.raw[room] = raw
        self.begins = offsets[:-1] + np.arange(1, n + 1)
        self.data = LOWER[self.raw]
        inside = WORD[self.data]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.doc = np.searchsorted(self.begins, self.starts, "right") - 1
        self.count = n
        self._sums = None

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each byte range, from running sums of base powers."""
        if self._sums is None:
            self._up, self._down = _powers(len(self.data) + 1)
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * self._up[:len(self.data)], out=self._sums[1:])
        h = (self._sums[ends] - self._sums[starts]) * self._down[starts]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(29))


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)])) for b in (_BASE, inverse)]
    return _POWERS[0], _POWERS[1]


__all__ = ["prepare", "table", "fresh", "remainder", "bounded_labels", "utf8", "pieces", "with_text_columns", "Words", "shared_dir"]
