"""Token counts from counted pre-tokens.

A byte-level BPE splits a text into pre-tokens first, and the pieces of a
pre-token depend on nothing around it. So the pieces are counted once per
distinct pre-token of the corpus, joined to the pre-token frequencies of each
document, and summed; token ids are never made.

Steps: (1) each task folds its texts into distinct pre-tokens, which are
counted over the corpus; (2) each distinct pre-token is tokenized once, its
piece count kept; (3) the ``HOT`` most frequent pre-tokens (a fixed number)
are handed to the tasks, which sum them in place; all other document
frequencies are shuffled to their piece counts and summed by document.

Scale: the frequent pre-tokens, which would be the hot keys of that join and
nearly all of its rows, never enter it; the rare ones do, by an ordinary
shuffled join. Nothing but the ``HOT`` rows reaches the driver.

Special strings inside a text are one token each and split the text, as the
library does by default. Texts are split by the byte-level pattern; texts with
one of the few control characters on which libraries disagree are split by the
tokenizer itself.

Defined results: null text is empty and has no tokens; rows that repeat (same
id and text) give a row each; null ids are kept; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import col, stage_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package

#: Pre-tokens, the most frequent ones, that are summed where the texts are read (at most so many).
HOT = 200_000
#: Distinct pre-tokens that a task gathers before it hands them on.
MEMORY = 400_000
#: Fixed value: the pre-tokenization pattern of the byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ODD_SPACE = "[\x00\x1c-\x1f\x85\u180e\u200b\ufeff]"
#: Marks a special string; no pre-token has white space after a letter.
MARK = "special: "


def splitter(tokenizer) -> Callable[[str], list[str]]:
    """A function from a text to its pre-tokens, in order; specials come marked."""
    pre = tokenizer.pre_tokenizer.pre_tokenize_str
    specials = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
    cut = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
    findall, odd = regex.compile(PATTERN).findall, regex.compile(ODD_SPACE).search

    def plain(text: str) -> list[str]:
        if odd(text):  # the libraries differ in what they take for white space: ask the tokenizer
            return [text[a:b] for _, (a, b) in pre(text)]
        return findall(text)

    def split(text: str) -> list[str]:
        if cut is None or not any(s in text for s in specials):
            return plain(text)
        out: list[str] = []
        for k, part in enumerate(cut.split(text)):
            if k % 2:
                out.append(MARK + part)
            elif part:
                out += plain(part)
        return out

    return split


def pieces(tokenizer, pretoken: str) -> int:
    return 1 if pretoken.startswith(MARK) else len(tokenizer.encode(pretoken, add_special_tokens=False).ids)


def _frequent(vocabulary: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows: those above a frequency, which a histogram of at most 512 steps gives (no sort)."""
    step = F.floor(F.log2("n") * 8)
    room, least = most, None
    for r in vocabulary.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("step")).collect():
        room -= r["c"]
        if room < 0:
            break
        least = r["step"]
    return vocabulary.where(step >= least) if least is not None else vocabulary.limit(0)


def count(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """(id, n_bytes, n_tokens), a row for each row of ``docs``."""
    spark = docs.sparkSession
    # the file stays on the driver; workers get its text
    file = spark.sparkContext.broadcast(open(path, encoding="utf-8").read())

    def tokenizer():
        from tokenizers import Tokenizer
        return Tokenizer.from_str(file.value)

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, total = splitter(tokenizer()), Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["p", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                if t:
                    total.update(split(t))  # counts the list
                if len(total) > MEMORY:
                    yield out()
                    total.clear()
        yield out()

    texts = docs.select(col(text_col).alias("t"))
    vocabulary = texts.mapInArrow(distinct, "p string, n long").groupBy("p").agg(F.sum("n").alias("n"))

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer()
        for b in batches:
            k = [pieces(t, p) for p in b.column("p").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("p"), b.column("n"), pa.array(k, pa.int64())], names=["p", "n", "k"])

    vocabulary = stage_table(vocabulary.mapInArrow(sized, "p string, n long, k long"), "pieces")
    known = spark.sparkContext.broadcast({r["p"]: r["k"] for r in _frequent(vocabulary, hot).collect()})

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row a document with the sum over frequent pre-tokens (p null), and one a rare pre-token."""
        split, get = splitter(tokenizer()), known.value.get
        for b in batches:
            rows, ps, ns, ids = [], [], [], []
            for k, t in enumerate(b.column("t").to_pylist()):
                s = 0
                for p, n in Counter(split(t)).items() if t else ():
                    v = get(p)
                    if v is None:
                        rows.append(k)
                        ps.append(p)
                        ns.append(n)
                    else:
                        s += n * v
                rows.append(k)
                ps.append(None)
                ns.append(s)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("id").take(at), b.column("h").take(at), b.column("b").take(at),
                                              pa.array(ps, pa.string()), pa.array(ns, pa.int64())], names=["id", "h", "b", "p", "n"])

    kind = docs.select(col(id_col).alias("id")).schema[0].dataType.simpleString()
    base = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col)).alias("h"),
                       F.octet_length(F.coalesce(col(text_col), F.lit(""))).cast("long").alias("b"), col(text_col).alias("t"))
    f = stage_table(base.mapInArrow(frequencies, f"id {kind}, h long, b long, p string, n long"), "frequencies")
    rare = f.where("p IS NOT NULL").join(vocabulary.select("p", "k"), "p").select("id", "h", "b", (F.col("n") * F.col("k")).alias("s"), F.lit(0).alias("one"))
    both = f.where("p IS NULL").select("id", "h", "b", F.col("n").alias("s"), F.lit(1).alias("one")).unionByName(rare)
    # rows that repeat are summed together, so the sum is shared out again
    g = both.groupBy("id", "h", "b").agg(F.sum("s").alias("s"), F.sum("one").alias("rows"))
    g = g.select("id", F.col("b").alias("n_bytes"), F.expr("s div rows").alias("n_tokens"), F.explode(F.array_repeat(F.lit(1), F.col("rows").cast("int"))))
    return g.select(F.col("id").alias(id_col), "n_bytes", "n_tokens")
