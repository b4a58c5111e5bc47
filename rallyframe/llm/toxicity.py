"""Toxicity: a factorization machine over hashed terms.

Score = w0 + sum of w[i] x[i] + sum over pairs of <v[i], v[j]> x[i] x[j], over the distinct terms of a text,
through the logistic function. The pairs let two terms that are harmless alone count together.

Terms are whole words and word beginnings of 4, 5 and 6 bytes, hashed. Every term in at least LEAST_DOCS documents of
the sample has a weight and factors. A term that goes with the label by itself has x = 1; the others,
of which a text may have thousands, share x = 1 / root of their number, so that what only their pairs tell
is learnt and their noise stays small. A null or empty text has no terms and scores by w0 alone; long texts are one row. Repeated rows and words change nothing; extra columns pass through; without
labelled rows every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rallyframe.workspace import materialise

from .common import Words, with_text_columns

TRAIN_DOCS = 20_000   # at most so many labelled documents are fitted on
BITS = 20             # hashed terms
LEAST_DOCS = 5        # a term needs so many of the sample's documents
SURPRISE = 12.0       # a term of so large a chi-square against the label counts in full
FACTORS = 4
PARTS = 8             # machines that learn side by side and are averaged
ROUNDS = 4
EPOCHS = 3
RATE, DECAY, START = 0.1, 1e-4, 0.03   # step, weight decay, spread of the first factors
BEGINNINGS = (4, 5, 6)


@dataclass
class Machine:
    place: np.ndarray    # bucket -> row of the arrays below, or -1
    full: np.ndarray     # whether a term counts in full
    w0: float
    w: np.ndarray
    v: np.ndarray


def amounts(full: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """x of each term of some documents: 1, or the root of one part of the document's other terms."""
    others = np.bincount(doc[~full], minlength=n_docs)
    return np.where(full, 1.0, 1.0 / np.sqrt(np.maximum(others, 1)[doc]))


def _terms(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Document and bucket of every term occurrence."""
    size = words.ends - words.starts
    docs, codes = [words.doc], [words.hashes(words.starts, words.ends) ^ np.uint64(1)]
    for n in BEGINNINGS:
        long = size > n
        docs.append(words.doc[long])
        codes.append(words.hashes(words.starts[long], words.starts[long] + n) + np.uint64(n))
    return np.concatenate(docs), (np.concatenate(codes) >> np.uint64(64 - BITS)).astype(np.int64)


def _distinct(doc: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((doc.astype(np.int64) << BITS) | code)
    return both >> BITS, both & ((1 << BITS) - 1)


def fit(docs: DataFrame, labels: DataFrame) -> Machine:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1; at most TRAIN_DOCS rows, see ``bounded_labels``)."""
    def terms():
        def work(texts):
            words = Words(texts)
            doc, code = _distinct(*_terms(words))
            ends = np.searchsorted(doc, np.arange(words.count + 1))
            return [pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(code.astype(np.int32)))]
        return work

    taken = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id")  # at most TRAIN_DOCS rows of 16 bytes
    sample = materialise(with_text_columns(taken, "text", [("terms", T.ArrayType(T.IntegerType()))], terms, ["doc_id", "label"]), "terms")
    n, positive = sample.agg(F.count("*"), F.sum("label")).first()
    place = np.full(1 << BITS, -1, np.int32)
    if not n:
        return Machine(place, np.zeros(0, bool), -50.0, np.zeros(0, np.float32), np.zeros((0, FACTORS), np.float32))
    rate = min(max(positive / n, 0.5 / n), 1 - 0.5 / n)
    w0 = float(np.log(rate / (1 - rate)))
    counts = sample.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"), F.sum("label").alias("p"))
    surprise = F.pow(F.col("p") - F.col("n") * rate, 2) / (F.col("n") * rate * (1 - rate))
    chosen = counts.where(F.col("n") >= LEAST_DOCS).select("term", (surprise >= SURPRISE).alias("full")).toArrow().sort_by("term")  # 2**BITS rows at most
    m = chosen.num_rows
    place[chosen.column("term").to_numpy()] = np.arange(m, dtype=np.int32)
    machine = Machine(place, chosen.column("full").to_numpy(), w0, np.zeros(m, np.float32),
                      np.random.default_rng(7).normal(0, START, (m, FACTORS)).astype(np.float32))
    rows = materialise(_placed(sample, place), "places")
    for turn in range(ROUNDS):
        machine = _average(rows, machine, turn)
    return machine


def _placed(sample: DataFrame, place: np.ndarray) -> DataFrame:
    """(part, doc_id, label, places): the chosen terms of each document; of little size, so the rounds move little."""
    shared = sample.sparkSession.sparkContext.broadcast(place)

    def run(batches):
        for batch in batches:
            terms = batch.column("terms")
            at = shared.value[terms.flatten().to_numpy(zero_copy_only=False)]
            row = np.repeat(np.arange(len(terms)), pc.list_value_length(terms).to_numpy(zero_copy_only=False))[at >= 0]
            ends = np.searchsorted(row, np.arange(len(terms) + 1)).astype(np.int32)
            places = pa.ListArray.from_arrays(pa.array(ends), pa.array(at[at >= 0].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), places], names=["doc_id", "label", "places"])

    kept = sample.select("doc_id", "label", "terms").mapInArrow(run, T.StructType([
        sample.schema["doc_id"], sample.schema["label"], T.StructField("places", T.ArrayType(T.IntegerType()))]))
    return kept.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int"))


def _average(rows: DataFrame, machine: Machine, turn: int) -> Machine:
    """Each part goes on learning from the same machine; the results are averaged by their rows."""
    shared = rows.sparkSession.sparkContext.broadcast(machine)

    def learn(part: pa.Table) -> pa.Table:
        now = shared.value
        order = np.argsort(part.column("doc_id").to_numpy(), kind="stable")
        places = [np.array(p, np.int64) for p in part.column("places").to_pylist()]
        w0, w, v = _descend(places, part.column("label").to_numpy(), order, now, turn)
        flat = np.concatenate([[w0], w, v.ravel()]).astype(np.float32)
        return pa.table({"rows": pa.array([len(places)], pa.int64()), "flat": pa.array([flat.tobytes()], pa.binary())})

    learnt = rows.groupBy("part").applyInArrow(learn, "rows long, flat binary").collect()  # PARTS rows
    weights = np.array([r.rows for r in learnt], float)
    flat = sum(np.frombuffer(r.flat, np.float32) * (w / weights.sum()) for r, w in sorted(zip(learnt, weights), key=lambda x: bytes(x[0].flat)))
    m = len(machine.w)
    return Machine(machine.place, machine.full, float(flat[0]), flat[1:m + 1].astype(np.float32), flat[m + 1:].reshape(m, FACTORS).astype(np.float32))


def _descend(places, labels, order, now: Machine, turn: int):
    """Adagrad over the documents of a part, in a shuffled order."""
    w0, w, v = now.w0, now.w.astype(float), now.v.astype(float)
    g0, gw, gv = 1.0, np.ones_like(w), np.ones_like(v)
    x = [amounts(now.full[at], np.zeros(len(at), np.int64), 1)[:, None] for at in places]
    for epoch in range(EPOCHS):
        for i in np.random.default_rng(100 * turn + epoch).permutation(order):
            at, much = places[i], x[i]
            own = v[at]
            part = own * much
            total = part.sum(0)
            z = w0 + w[at] @ much[:, 0] + 0.5 * (total @ total - (part * part).sum())
            err = 1 / (1 + np.exp(-np.clip(z, -35, 35))) - labels[i]
            dw = err * much[:, 0] + DECAY * w[at]
            dv = err * much * (total - part) + DECAY * own
            g0 += err * err
            gw[at] += dw * dw
            gv[at] += dv * dv
            w0 -= RATE * err / np.sqrt(g0)
            w[at] -= RATE * dw / np.sqrt(gw[at])
            v[at] -= RATE * dv / np.sqrt(gv[at])
    return w0, w, v


def _scorer(machine: Machine):
    def work(texts: pa.Array) -> list:
        words = Words(texts)
        doc, code = _terms(words)
        known = machine.place[code] >= 0
        doc, code = _distinct(doc[known], code[known])
        at = machine.place[code]
        much = amounts(machine.full[at], doc, words.count)
        z = machine.w0 + np.bincount(doc, machine.w[at] * much, words.count)
        for f in range(machine.v.shape[1]):
            own = machine.v[at, f] * much
            z += 0.5 * (np.bincount(doc, own, words.count) ** 2 - np.bincount(doc, own * own, words.count))
        score = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        return [pa.array(np.where(z <= -50, 0.0, score))]
    return work


def score_toxicity(docs: DataFrame, machine: Machine, text: str = "text", keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """Adds the probability that a text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # 2**BITS places and weights at most
    return with_text_columns(docs, text, [(name, T.DoubleType())], lambda: _scorer(shared.value), keep)
