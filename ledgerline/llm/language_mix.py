"""Multilingual mixture inference.

Model: for each labelled language, the log probability of character trigrams
(letters only, lower case, words marked at both ends), counted over all
training documents into a fixed number of hash buckets and smoothed. A word's
likelihood in a language is the product over its trigrams.

Inference: a document's words come from a mixture of languages.
Expectation-maximisation estimates the proportions; the language set is chosen
among the nested sets of the most likely languages by likelihood less
``PENALTY`` for each further language and per log of the words (as in BIC).
The prediction is the language with the largest proportion, the score that
proportion.

Scale: training is one pass that sends at most buckets x languages counts a
task; the model has that size too, whatever the corpus, and goes to the tasks
as one array. Prediction is one pass without a shuffle; whole texts are used,
a slice of documents at a time.

Defined results: null text or no letters: ``und`` with score 0, as for every
text when nothing could be learned; equal proportions give the first language
by code point; rows that repeat are predicted alike; an empty table gives an
empty result; extra columns are carried through.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, fresh

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

BUCKETS = 1 << 16
SMOOTHING = 0.3
PENALTY, STEPS = 3.0, 8
UNKNOWN = "und"
#: Characters that are worked on together (a longer text is a slice of its own).
SLICE_CHARS = 1 << 19

_LETTER = {}


def _letters() -> np.ndarray:
    """Which of the first 65,536 code points are letters."""
    if "table" not in _LETTER:
        _LETTER["table"] = np.fromiter((chr(i).isalpha() for i in range(1 << 16)), bool, 1 << 16)
    return _LETTER["table"]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets of all words of all texts in order, the word starts in them, and each word's text number."""
    low = [t.lower() for t in texts]
    c = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(t) + 1 for t in low])
    is_letter = _letters()[np.minimum(c, 0xFFFF)]
    high = np.nonzero(c > 0xFFFF)[0]
    if len(high):
        is_letter[high] = [chr(i).isalpha() for i in c[high]]
    at = np.nonzero(is_letter)[0]
    if not len(at):
        none = np.empty(0, dtype=np.int64)
        return none, none, none
    c = np.where(is_letter, c, 0).astype(np.uint32)
    c = np.concatenate([np.zeros(1, np.uint32), c, np.zeros(1, np.uint32)])
    h = c[at] * np.uint32(0x9E3779B1) + c[at + 1] * np.uint32(0x85EBCA77) + c[at + 2] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    starts = np.nonzero(c[at] == 0)[0]  # a letter after no letter
    return (h >> np.uint32(16)).astype(np.int64), starts, np.searchsorted(ends, at[starts], side="right")


def _slices(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``SLICE_CHARS`` characters, with the number of the first."""
    first, run, size = 0, [], 0
    for k, t in enumerate(texts):
        run.append(t or "")
        size += len(run[-1])
        if size >= SLICE_CHARS:
            yield first, run
            first, run, size = k + 1, [], 0
    if run:
        yield first, run


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages by code point and the trigram log probabilities (languages x buckets) of the labelled ``docs``."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, part in pd.DataFrame({"t": b.column("t").to_pylist(), "l": b.column("l").to_pylist()}).groupby("l"):
                n = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for _, run in _slices(list(part["t"])):
                    n += np.bincount(trigrams(run)[0], minlength=BUCKETS)
        for lang, n in total.items():
            at = np.nonzero(n)[0]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                                             names=["lang", "bucket", "n"])

    t = docs.where(col(lang_col).isNotNull() & col(text_col).isNotNull()).select(col(text_col).alias("t"), col(lang_col).alias("l"))
    n = t.mapInArrow(counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(set(n["lang"]))  # code point order
    table = np.full((len(langs), BUCKETS), SMOOTHING)
    for j, lang in enumerate(langs):
        part = n[n["lang"] == lang]
        table[j, part["bucket"]] += part["n"]
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def _em(r: np.ndarray, starts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (languages x documents) and log likelihood of the mixture, from relative likelihoods (languages x words)."""
    k = len(r)
    share = np.full((k, len(starts)), 1.0 / k, dtype=np.float32)
    for step in range(STEPS + 1):
        parts = [np.repeat(share[j], n) * r[j] for j in range(k)]
        total = np.sum(parts, axis=0)
        if step == STEPS:
            return share, np.add.reduceat(np.log(total), starts, dtype=np.float64)
        np.reciprocal(total, out=total)
        share = np.stack([np.maximum(np.add.reduceat(p * total, starts) / n, 1e-9) for p in parts]).astype(np.float32)


def mixtures(texts: list[str], table: np.ndarray) -> np.ndarray:
    """Proportions (texts x languages; rows of zeros where nothing is known) of the chosen language sets.

    ``table`` is languages x buckets. No mixture is more likely than taking
    every word in its best language (log likelihood 0 here), so a document
    whose penalised fit is above that, less the next penalty, is done.
    """
    k = len(table)
    out = np.zeros((len(texts), k))
    grams, word, text = trigrams(texts)
    if not len(grams) or not k:
        return out
    like = np.stack([np.add.reduceat(row[grams], word) for row in table])  # languages x words
    like -= like.max(axis=0)
    np.maximum(like, -60.0, out=like)
    known, starts, n = np.unique(text, return_index=True, return_counts=True)
    single = np.stack([np.add.reduceat(row, starts, dtype=np.float64) for row in like])
    first = single.argmax(axis=0)
    best = single.max(axis=0)
    out[known, first] = 1.0
    open_ = best < -PENALTY * np.log(n + 1.0)  # documents that a second language may improve
    if k == 1 or not open_.any():
        return out
    like = np.exp(like[:, np.repeat(open_, n)])
    known, n, best = known[open_], n[open_], best[open_]
    starts = np.cumsum(n) - n
    order = np.argsort(-_em(like, starts, n)[0], axis=0, kind="stable")  # nested sets: the first two languages, three, ..
    for size in range(2, k + 1):
        few = order[:size]
        share, fit = _em(np.take_along_axis(like, np.repeat(few, n, axis=1), axis=0), starts, n)
        fit -= PENALTY * (size - 1) * np.log(n + 1.0)
        better = fit > best
        best = np.where(better, fit, best)
        now = np.zeros((len(known), k))
        np.put_along_axis(now, few.T, (share / share.sum(axis=0)).T, axis=1)
        out[known[better]] = now[better]
        open_ = best < -PENALTY * size * np.log(n + 1.0)
        if not open_.any():
            break
        like, order = like[:, np.repeat(open_, n)], order[:, open_]
        known, n, best = known[open_], n[open_], best[open_]
        starts = np.cumsum(n) - n
    return out


def infer(text: Column, langs: list[str], table: np.ndarray, spark) -> Column:
    """A struct of ``lang``, ``score`` and the chosen ``langs`` with their ``shares``."""
    model = spark.sparkContext.broadcast(table)

    @F.pandas_udf("lang string, score double, langs array<string>, shares array<double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for _, some in _slices(list(texts)):
            for p in mixtures(some, model.value):
                at = [int(j) for j in np.argsort(-p, kind="stable") if p[j] > 0]
                rows.append((langs[at[0]], float(p[at[0]]), [langs[j] for j in at], [float(p[j]) for j in at]) if at else (UNKNOWN, 0.0, [], []))
        return pd.DataFrame(rows, columns=["lang", "score", "langs", "shares"])

    return run(text)


def predict(docs: DataFrame, training: DataFrame, carry: list[str] | None = None, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``carry`` (default: all columns) of ``docs`` plus a struct ``mixture``, learned from ``training``."""
    langs, table = train(training, text_col, lang_col)
    carry = docs.columns if carry is None else carry
    name = "mixture" if "mixture" not in carry else fresh(docs, "mixture")[0]
    return docs.select(*[col(c) for c in carry], infer(col(text_col), langs, table, docs.sparkSession).alias(name))
