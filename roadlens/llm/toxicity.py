"""Toxicity: a linear-chain CRF tags toxic tokens; its marginals give document scores and spans.

Labels are per document, so tokens are labelled first: on a bounded sample of labelled rows
(``SAMPLE`` rows with ``SAMPLE_BYTES`` of text), Spark counts in how many toxic and other documents
each word and each word beginning (4 and 6 bytes) occurs; all those with a high log-odds form the
lexicon, which the sample's bytes bound. A token's class is the band of its best log-odds (0: none). In toxic
documents tokens of a high class are labelled 1, all other tokens 0, and a CRF over the classes
of a token and its neighbours is trained on runs of ``RUN`` tokens.

Scoring streams all documents: forward-backward marginals of every token of the whole text are
summed up per document (their sum, maximum and share), and a logistic regression on these,
fitted on the same sample, gives the score. Tokens with a marginal of at least 0.5 are the
offending spans, as code-point offsets.

Labels are learned only from rows whose crc32(doc_id as text) mod 4 is not 2; labels, language,
source and doc_id are no inputs. Edge cases: null and empty texts have no tokens and score as
such; null labels and labels of unknown documents teach nothing; without toxic labels all scores
are one constant; rows equal in doc_id and text teach once and are scored each; a text that the
rest of ``SAMPLE_BYTES`` cannot hold teaches nothing; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlens.llm.common import settle, text_blocks
from roadlens.llm.crf import Field, chain_marginals, train
from roadlens.llm.quality import held_out, labelled
from roadlens.llm.words import U, find_words, lower_ascii, mix, word_hashes

SAMPLE = 10_000
SAMPLE_BYTES = 64 << 20  # of the texts that teach
LEAST = 5  # toxic documents an entry occurs in
BANDS = (1.0, 2.0, 3.0, 4.0, 5.0)  # of log-odds; class 0 is below the first
STRONG = 3  # a class from here on is labelled in toxic documents
RUN = 64  # tokens a training chain; in scoring only the layout's width
STARTS = (4, 6)
LIMIT = 0.3
FOLDS, HELD = 4, 2
FILTER_BITS = 20

TOKEN = np.zeros(256, bool)  # letters, digits and anything past ASCII
TOKEN[48:58] = TOKEN[65:91] = TOKEN[97:123] = TOKEN[128:] = True


@dataclass(frozen=True)
class Model:
    keys: np.ndarray  # sorted hashes of words and word beginnings
    classes: np.ndarray
    near: np.ndarray  # whether some key has these leading bits
    field: Field | None
    weights: np.ndarray  # of the document's sums: logistic regression


def _keys(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> list[np.ndarray]:
    """Hashes of each token and of its beginnings (a shorter token has none: 0)."""
    out = [word_hashes(data, s, e)]
    for i, n in enumerate(STARTS, 1):
        h = mix(word_hashes(data, s, np.minimum(e, s + n)) + U(i))
        out.append(np.where(e - s > n, h, U(0)))
    return out


def _occurring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        y = batch.column(1).to_numpy()
        for a, b, data, offsets in text_blocks(batch.column(0)):
            data = lower_ascii(data)
            s, e, bounds = find_words(data, offsets, TOKEN)
            text = np.repeat(np.arange(b - a), np.diff(bounds))
            for keys in _keys(data, s, e):
                order = np.lexsort((keys, text))
                k, t = keys[order], text[order]
                new = np.ones(len(k), bool)
                new[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
                new &= k != 0
                yield pa.RecordBatch.from_arrays([pa.array(k[new].view(np.int64)), pa.array(y[a + t[new]].astype(np.int64))], names=["key", "y"])


def _classes(model: Model, data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    out = np.zeros(len(s), np.int8)
    if not len(model.keys):
        return out
    for keys in _keys(data, s, e):
        some = np.flatnonzero(model.near[keys >> U(64 - FILTER_BITS)])
        at = np.minimum(np.searchsorted(model.keys, keys[some]), len(model.keys) - 1)
        hit = model.keys[at] == keys[some]
        out[some[hit]] = np.maximum(out[some[hit]], model.classes[at[hit]])
    return out


def _runs(classes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens in rows of ``RUN`` (-1 past a text's end), each row's text, and each token's flat place."""
    size = np.diff(bounds)
    rows = -(-size // RUN)
    first = np.append(0, np.cumsum(rows))
    text = np.repeat(np.arange(len(size)), size)
    place = first[text] * RUN + np.arange(len(classes)) - bounds[text]
    out = np.full(first[-1] * RUN, -1, np.int8)
    out[place] = classes
    return out.reshape(-1, RUN), np.repeat(np.arange(len(size)), rows), place


def _marginals(model: Model, classes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    if model.field is None:
        return np.zeros(len(classes))
    return chain_marginals(model.field, classes, bounds, RUN)


def _sums(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text: what its marginals come to."""
    n = np.diff(bounds).astype(float)
    total = np.diff(np.append(0, np.cumsum(p))[bounds])
    top = np.zeros(len(n))
    np.maximum.at(top, np.repeat(np.arange(len(n)), np.diff(bounds)), p)
    return np.column_stack([np.ones(len(n)), np.log1p(np.maximum(total, 0)), top, 20 * total / (n + 20), np.log1p(n) / 5])


def _rows(shared):
    """Training rows: per text the classes of its tokens, as bytes, and its label."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = []
            for _, _, data, offsets in text_blocks(batch.column(0)):
                data = lower_ascii(data)
                s, e, bounds = find_words(data, offsets, TOKEN)
                raw = _classes(shared.value, data, s, e).tobytes()
                blobs += [raw[x:y] for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), batch.column(1)], names=["classes", "y"])

    return make


def _regression(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w += np.clip(step, -4, 4)
    return w


def _sample(docs: DataFrame, labels: DataFrame, sample: int, max_bytes: int) -> DataFrame:
    """Labelled rows, ``text, y``: those with the smallest hashes, as far as ``sample`` and ``max_bytes`` reach."""
    rows = settle(labelled(docs, labels, "toxic", FOLDS, HELD, sample))
    sizes = rows.groupBy("row").agg(F.max(F.octet_length(F.coalesce("text", F.lit("")))).alias("n")).orderBy("row").limit(sample)
    chosen, left = [], max_bytes
    for row, n in sizes.collect():
        if n <= left:
            chosen.append((row,))
            left -= n
    chosen = F.broadcast(docs.sparkSession.createDataFrame(chosen, "row long"))
    return settle(rows.join(chosen, "row").groupBy("row").agg(F.first("text").alias("text"), F.max("y").alias("y")).drop("row"))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, max_bytes: int = SAMPLE_BYTES) -> Model:
    rows = _sample(docs, labels, sample, max_bytes)
    counted = rows.agg(F.sum("y"), F.count("*")).first()
    toxic, other = int(counted[0] or 0), int(counted[1]) - int(counted[0] or 0)
    empty = np.zeros(0, U)
    none = Model(empty, np.zeros(0, np.int8), np.zeros(1 << FILTER_BITS, bool), None, np.zeros(5))
    if not toxic or not other:
        share = (toxic + 1) / (toxic + other + 2)
        return Model(*list(none.__dict__.values())[:4], np.array([np.log(share / (1 - share)), 0, 0, 0, 0]))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("n") - F.col("t") + 0.5) / (other + 1))
    keys = rows.mapInArrow(_occurring, "key long, y long").groupBy("key").agg(F.sum("y").alias("t"), F.count("*").alias("n"))
    keys = keys.where(F.col("t") >= LEAST).withColumn("z", odds).where(F.col("z") >= BANDS[0])
    found = keys.select("key", "z").toArrow()
    key, z = found["key"].to_numpy().view(U), found["z"].to_numpy()
    order = np.argsort(key)
    near = none.near.copy()
    near[key >> U(64 - FILTER_BITS)] = True
    lexicon = Model(key[order], np.searchsorted(BANDS, z[order], "right").astype(np.int8), near, None, none.weights)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    data = rows.mapInArrow(_rows(shared), "classes binary, y int").toArrow()  # a byte per token of the sample
    y = data["y"].to_numpy().astype(float)
    texts = [np.frombuffer(c.as_buffer(), np.int8) for c in data["classes"]]
    bounds = np.append(0, np.cumsum([len(t) for t in texts]))
    classes = np.concatenate([np.zeros(0, np.int8), *texts])
    seq, of, _ = _runs(classes, bounds)
    marked = np.concatenate([seq, ((seq >= STRONG) & (y[of] > 0)[:, None]).astype(np.int8)], axis=1)
    kinds, times = np.unique(marked, axis=0, return_counts=True)  # equal runs count once, weighted
    field = train(kinds[:, :RUN].astype(int), kinds[:, RUN:], times.astype(float), len(BANDS) + 1)
    tagged = Model(lexicon.keys, lexicon.classes, near, field, none.weights)
    x = _sums(_marginals(tagged, classes, bounds), bounds)
    order = np.lexsort((*x.T, y))  # the order in which rows arrive must not matter
    return Model(lexicon.keys, lexicon.classes, near, field, _regression(x[order], y[order]))


def _scorer(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(1)):
                lead = np.append(0, np.cumsum((data & 0xC0) != 0x80))  # code points before each byte
                low = lower_ascii(data)
                s, e, bounds = find_words(low, offsets, TOKEN)
                p = _marginals(model, _classes(model, low, s, e), bounds)
                scores = 1 / (1 + np.exp(-np.clip(_sums(p, bounds) @ model.weights, -30, 30)))
                bad = np.flatnonzero(p >= 0.5)
                base = lead[offsets[np.searchsorted(bounds, bad, "right") - 1]]
                spans = np.column_stack([lead[s[bad]] - base, lead[e[bad]] - base]).reshape(-1)
                cut = (2 * np.searchsorted(bad, bounds)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(scores), pa.ListArray.from_arrays(pa.array(cut), pa.array(spans, pa.int64()))],
                    names=["_doc", "score", "spans"],
                )

    return score


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` as a struct ``_doc``, ``score`` and ``spans`` (start, end, start, end, ...)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("_doc"), docs["text"].alias("_text"))
    return rows.mapInArrow(_scorer(shared), T.StructType([rows.schema["_doc"]]).add("score", "double").add("spans", T.ArrayType(T.LongType())))


def op6_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    out = score(docs, learn(docs, labels), ["doc_id"]).select("_doc.doc_id", "score", "spans")
    predicted = (F.col("score") >= LIMIT).cast("int").alias("predicted")
    return out.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD).alias("held_out"), "score", predicted, "spans")
