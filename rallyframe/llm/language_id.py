"""Language identification of words, spans and documents.

Script ranges narrow the languages a word can belong to; the word's letter triples score the rest;
Viterbi over the words, with a penalty for each switch, labels spans of mixed-language text.

Every letter has a script, the last one for all letters that no other holds; letters that any language
writes beside numbers (ordinal signs, micro, modifier letters) have none and take the language around.

Cases: a null, empty or letterless text is ``und`` with score 0 and no spans; a text with letters, but
none of a script, takes the most frequent language with score 0; equal scores take the language first in
alphabetical order; without training rows every text is ``und``. Rows are labelled one by one, so
repeated rows repeat and extra columns pass through. A long text is one row and a piece of work of its own.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, fresh, pieces, with_text_columns

TRAIN_DOCS = 20_000      # expected number of labelled documents that the model is fitted on
BUCKETS = 1 << 16        # hashed letter triples
SWITCH = 12.0            # cost of changing the language between two words, in nats
EXCLUDED = 30.0          # cost of a word in a language that does not use its script
SCRIPT_SHARE = 0.01      # a language uses the scripts with this share of its words
STEPS = 32               # words of a block that Viterbi walks at once
TABLE = 1 << 24           # entries of the table of blocks by languages by languages, at most

# Blocks of Unicode by script, first and last code point. Letters outside them are of the script "other".
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x2AF), (0x1D00, 0x1DBF), (0x1E00, 0x1EFF), (0x2100, 0x214F), (0x2C60, 0x2C7F), (0xA720, 0xA7FF),
              (0xAB30, 0xAB6F), (0xFB00, 0xFB06), (0xFF21, 0xFF3A), (0xFF41, 0xFF5A), (0x1D400, 0x1D7FF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F), (0xFB13, 0xFB17)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x870, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF), (0x1EE00, 0x1EEFF)],
    "indic": [(0x900, 0xDFF), (0x1CD0, 0x1CFF), (0xA8E0, 0xA8FF)],
    "thai": [(0xE00, 0xE7F)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xAC00, 0xD7FF), (0xFFA0, 0xFFDC)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F)],
    "han": [(0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)],
    "georgian": [(0x10A0, 0x10FF), (0x1C90, 0x1CBF), (0x2D00, 0x2D2F)],
    "ethiopic": [(0x1200, 0x139F), (0x2D80, 0x2DDF), (0xAB00, 0xAB2F), (0x1E7E0, 0x1E7FF)],
    "myanmar": [(0x1000, 0x109F), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F)],
    "khmer": [(0x1780, 0x17FF)],
}
SIGNS = "\u00aa\u00b5\u00ba"   # letters used as signs


def _script_bits() -> np.ndarray:
    """Script bit by code point; only letters have one."""
    bits = np.zeros(sys.maxunicode + 1, np.uint16)
    letters = np.array([p for p in range(sys.maxunicode + 1) if chr(p).isalpha()])
    bits[letters] = 1 << len(SCRIPTS)
    for bit, ranges in enumerate(SCRIPTS.values()):
        for first, last in ranges:
            own = bits[first:last + 1]
            own[own > 0] = 1 << bit
    # modifier letters outside the blocks go with any script
    loose = letters[bits[letters] == 1 << len(SCRIPTS)]
    bits[[p for p in loose.tolist() if chr(p) in SIGNS or 0x2B0 <= p <= 0x2FF]] = 0
    return bits


SCRIPT_BITS = _script_bits()


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray    # language x bucket: log share of the triple
    scripts: np.ndarray   # per language: bits of the scripts it uses
    first: int            # the most frequent language


def _triples(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashed letter triples around each byte of a word, and where each word's begin."""
    data = words.data.astype(np.uint32)
    edge = np.zeros(len(data) + 1, np.int8)
    edge[words.starts] += 1
    edge[words.ends] -= 1
    inside = np.cumsum(edge[:-1]) > 0
    at = np.flatnonzero(inside)
    key = (data[at - 1] << np.uint32(16)) | (data[at] << np.uint32(8)) | data[at + 1]
    key = (key * np.uint32(0x9E3779B1)) >> np.uint32(16)
    lengths = words.ends - words.starts
    return key.astype(np.intp), np.cumsum(lengths) - lengths


def _code_points(data: np.ndarray, lead: np.ndarray) -> np.ndarray:
    """Code points of the characters of two to four bytes that begin at ``lead``."""
    a, b, c, d = (data[np.minimum(lead + i, len(data) - 1)].astype(np.int32) & 0x3F for i in range(4))
    first = data[lead]
    two, three = (a & 0x1F) << 6 | b, (a & 0x0F) << 12 | b << 6 | c
    return np.where(first < 0xE0, two, np.where(first < 0xF0, three, np.minimum((a & 0x07) << 18 | b << 12 | c << 6 | d, sys.maxunicode)))


def _word_scripts(words: Words) -> np.ndarray:
    """Bits of the scripts of each word's letters; none for words without a letter."""
    if not len(words.starts):
        return np.zeros(0, np.uint16)
    bits = SCRIPT_BITS[words.data]
    bits[words.data >= 0x80] = 0
    lead = np.flatnonzero(words.data >= 0xC0)  # each other character by its first byte
    bits[lead] = SCRIPT_BITS[_code_points(words.data, lead)]
    bounds = np.column_stack([words.starts, words.ends]).ravel()
    return np.bitwise_or.reduceat(bits, bounds)[0::2]


def fit(docs: DataFrame, bound: int = TRAIN_DOCS) -> Model:
    """Triple and script counts per language of a hash sample of ``docs`` (doc_id, text, lang).

    About ``bound`` documents are taken; what reaches the driver is bounded by languages x buckets.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    share = min(1.0, bound / max(1, labelled.count()))
    span = 1 << 30
    taken = labelled.where(F.pmod(F.xxhash64("doc_id"), F.lit(span)) < int(share * span)).select("lang", "text")

    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in pieces(batch, "text"):
                words = Words(part.column("text"))
                keys, begins = _triples(words)
                scripts = _word_scripts(words)
                langs = np.array(part.column("lang").to_pylist(), object)
                of_word = langs[words.doc]
                of_key = np.repeat(of_word, words.ends - words.starts)
                for lang in set(langs):
                    total = totals.setdefault(lang, np.zeros(BUCKETS + 17, np.int64))
                    total[:BUCKETS] += np.bincount(keys[of_key == lang], minlength=BUCKETS)
                    own = scripts[of_word == lang]
                    total[BUCKETS:BUCKETS + 16] += [np.count_nonzero(own & np.uint16(1 << b)) for b in range(16)]
                    total[BUCKETS + 16] += np.count_nonzero(langs == lang)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "bucket": at.astype(np.int32), "n": total[at]})

    rows = taken.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r.lang for r in rows})
    counts = np.zeros((len(languages), BUCKETS + 17))
    place = {lang: k for k, lang in enumerate(languages)}
    for r in rows:
        counts[place[r.lang], r.bucket] = r.n
    triples, scripts, n_docs = counts[:, :BUCKETS], counts[:, BUCKETS:BUCKETS + 16], counts[:, -1]
    smooth = triples + 0.5
    scores = np.log(smooth / smooth.sum(1, keepdims=True))
    shares = scripts / np.maximum(1, scripts.sum(1, keepdims=True))
    uses = ((shares >= SCRIPT_SHARE) * (1 << np.arange(16))).sum(1)
    return Model(languages, scores.astype(np.float32), uses.astype(np.uint16), int(n_docs.argmax()) if languages else 0)


def word_scores(words: Words, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Word x language scores, and the scripts of each word."""
    scripts = _word_scripts(words)
    out = np.zeros((len(words.starts), len(model.languages)), np.float32)
    if not out.size:
        return out, scripts
    keys, begins = _triples(words)
    for k in range(len(model.languages)):
        out[:, k] = np.add.reduceat(model.scores[k][keys], begins)
    out -= out.max(1, keepdims=True)
    fits = (scripts[:, None] & ~model.scripts[None, :]) == 0
    out -= np.where(fits | ~fits.any(1, keepdims=True), 0, EXCLUDED).astype(np.float32)
    out[scripts == 0] = 0  # numbers and signs take the language around them
    return out, scripts


def viterbi(scores: np.ndarray, doc: np.ndarray, n_docs: int, switch: float) -> np.ndarray:
    """Best language of every word: the sum of scores less ``switch`` per change, for each text alone.

    Blocks of STEPS words run side by side: first each block's best sum from any language before it
    to any at its end, then the chain of blocks of a text, then the words inside each block. Where so
    many languages make that table larger than TABLE, the words of a text follow one another, texts side by side.
    """
    n, k = scores.shape
    if not n:
        return np.zeros(0, np.int64)
    words = np.bincount(doc, minlength=n_docs)
    blocks = -(-words // STEPS)
    first_word, first_block = np.cumsum(words) - words, np.cumsum(blocks) - blocks
    c = int(blocks.sum())
    if c * k * k > TABLE:
        return _word_by_word(scores, words, first_word, switch)
    place = np.arange(n) - first_word[doc]
    block, step = first_block[doc] + place // STEPS, place % STEPS
    x = np.zeros((STEPS, c, k), np.float32)
    x[step, block] = scores
    change = (switch * (1 - np.eye(k))).astype(np.float32)
    reach = x[0][:, None, :] - change[None]
    for t in range(1, STEPS):
        reach = x[t][:, None, :] + np.maximum(reach, reach.max(2, keepdims=True) - np.float32(switch))
    entry = np.zeros((c, k), np.int64)   # language before the block, by language at its end
    best = np.zeros((n_docs, k), np.float64)
    for r in range(int(blocks.max())):
        who = np.flatnonzero(blocks > r)
        options = best[who][:, :, None] + reach[first_block[who] + r]  # before the first block all are 0: its language is free
        value = options.max(1)
        entry[first_block[who] + r] = options.argmax(1)
        best[who] = value - value.max(1, keepdims=True)
    before, last = np.zeros(c, np.int64), np.zeros(c, np.int64)
    state = best.argmax(1)
    for r in range(int(blocks.max()) - 1, -1, -1):
        who = np.flatnonzero(blocks > r)
        at = first_block[who] + r
        last[at] = state[who]
        before[at] = entry[at, state[who]]
        state[who] = before[at]
    value = x[0] - change[before]
    back = np.zeros((STEPS, c, k), np.min_scalar_type(k))
    stay = np.arange(k)[None, :]
    for t in range(1, STEPS):
        top = value.argmax(1)
        moved = value[np.arange(c), top][:, None] - np.float32(switch)
        back[t] = np.where(value >= moved, stay, top[:, None])
        value = x[t] + np.maximum(value, moved)
    path = np.zeros((STEPS, c), np.int64)
    path[STEPS - 1] = last
    for t in range(STEPS - 1, 0, -1):
        path[t - 1] = back[t, np.arange(c), path[t]]
    return path[step, block]


def _word_by_word(scores: np.ndarray, words: np.ndarray, first_word: np.ndarray, switch: float) -> np.ndarray:
    n, k = scores.shape
    back, stay = np.zeros((n, k), np.min_scalar_type(k)), np.arange(k)[None, :]
    order = np.argsort(-words, kind="stable")            # longest texts first: those still open come first
    still = len(words) - np.searchsorted(words[order][::-1], np.arange(int(words.max()) + 1), "right")
    value = np.zeros((len(words), k))
    for t in range(int(words.max())):
        who = order[:still[t]]
        at, now = first_word[who] + t, value[who]
        if t:
            top = now.argmax(1)
            moved = now[np.arange(len(who)), top][:, None] - switch
            back[at] = np.where(now >= moved, stay, top[:, None])
            now = np.maximum(now, moved)
        now = now + scores[at]
        value[who] = now - now.max(1, keepdims=True)
    path, state = np.zeros(n, np.int64), value.argmax(1)
    for t in range(int(words.max()) - 1, -1, -1):
        who = order[:still[t]]
        at = first_word[who] + t
        path[at] = state[who]
        state[who] = back[at, state[who]]
    return path


def _labeller(model: Model, switch: float):
    """Texts to (lang_pred, score, spans)."""
    k, span_type = len(model.languages), pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def work(texts: pa.Array) -> list:
        words = Words(texts)
        scores, scripts = word_scores(words, model)
        path = viterbi(scores, words.doc, words.count, switch) if k else np.zeros(0, np.int64)
        lead = (words.raw & 0xC0) != 0x80
        chars = np.concatenate([[0], np.cumsum(lead)])   # characters before a byte
        letters = (chars[words.ends] - chars[words.starts]) * (scripts != 0)
        held = np.zeros((words.count, max(1, k)))
        if k:
            held = np.bincount(words.doc * k + path, letters, words.count * k).reshape(-1, k)
        total = held.sum(1)
        langs = np.array([*model.languages, None], object)[held.argmax(1)]
        share = held.max(1) / np.maximum(1, total)
        for i in np.flatnonzero(total == 0):  # no word of a script: is there any letter?
            some = k and any(ch.isalpha() for ch in texts[int(i)].as_py() or "")
            langs[i], share[i] = (model.languages[model.first], 0.0) if some else ("und", 0.0)
        known = np.flatnonzero(scripts) if k else np.zeros(0, np.int64)
        doc, lang = words.doc[known], path[known]
        new = np.ones(len(known), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (lang[1:] != lang[:-1])
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], len(known))[:len(begin)] - 1
        base = chars[words.begins[doc[begin]]]
        spans = pa.StructArray.from_arrays([
            pa.array((chars[words.starts[known[begin]]] - base).astype(np.int32)),
            pa.array((chars[words.ends[known[end]]] - base).astype(np.int32)),
            pa.array(np.array(model.languages or [""], object)[lang[begin]], pa.string())], fields=list(span_type))
        many = np.bincount(doc[begin], minlength=words.count)
        offsets = pa.array(np.concatenate([[0], np.cumsum(many)]).astype(np.int32))
        return [pa.array(langs, pa.string()), pa.array(share), pa.ListArray.from_arrays(offsets, spans)]

    return work


def label_languages(docs: DataFrame, model: Model, text: str = "text", switch: float = SWITCH,
                    keep: list[str] | None = None, names: tuple[str, str, str] = ("lang_pred", "score", "spans")) -> DataFrame:
    """Adds the language of most letters, the share of letters in it, and the labelled spans (code points, end exclusive)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x 65,536 floats
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType())])
    kinds = [T.StringType(), T.DoubleType(), T.ArrayType(span)]
    return with_text_columns(docs, text, list(zip(names, kinds)), lambda: _labeller(shared.value, switch), keep)


def keep_identified(docs: DataFrame, model: Model, least: float = 0.0) -> DataFrame:
    """The documents with a labelled span, columns unchanged; ``least`` is the share of letters that the leading language must have."""
    names = tuple(fresh(docs.columns, n) for n in ("lang_pred", "score", "spans"))
    marked = label_languages(docs, model, names=names)
    return marked.where((F.col(names[0]) != "und") & (F.size(names[2]) > 0) & (F.col(names[1]) >= least)).select(*docs.columns)


__all__ = ["Model", "fit", "label_languages", "keep_identified", "viterbi"]
