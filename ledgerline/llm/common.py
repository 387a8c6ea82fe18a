"""Shared column helpers of the training-data operators.

Nothing here starts a job: the functions only build expressions, except
``stage_table``, which writes a table under the shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_table_path

#: White space that separates words: \x20 and \x09-\x0D, nothing else.
WS_CHARS = " \t\n\x0b\x0c\r"
WS_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    An array that a lambda refers to is otherwise inlined into the lambda and
    computed again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Maximal runs of characters other than \\x20 and \\x09-\\x0D; null and blank texts have none."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS_CHARS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WS_RUN, -1))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def windows(w: Column, k: int, each: Callable[..., Column]) -> Column:
    """``each(word_1, .., word_k)`` at every position of ``w``; empty when ``w`` has fewer words.

    Reads single elements: slicing the array at every position costs several
    times as much.
    """
    full = F.transform(w, lambda x, i: each(x, *[F.get(w, i + j) for j in range(1, k)]))
    return F.slice(full, F.lit(1), F.greatest(F.size(w) - (k - 1), F.lit(0)))


def shingles(w: Column, k: int, each: Callable[[Column], Column]) -> Column:
    """``each`` of the space-joined k words at every position, repeats included.

    Fewer than ``k`` words make one shingle, the whole sequence; no words make none.
    """
    one = F.transform(F.array(F.array_join(w, " ")), each)
    return (F.when(F.size(w) >= k, windows(w, k, lambda *x: each(F.concat_ws(" ", *x))))
            .when(F.size(w) > 0, one).otherwise(F.slice(one, F.lit(1), F.lit(0))))


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names of our own that clash with no input column (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for s in stems:
        name = f"__{s}"
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def bundle(names: list[str]) -> Column:
    """The columns ``names`` as one struct with field names of our own, so that no name of theirs meets one of ours."""
    return F.struct(*[col(c).alias(f"c{i}") for i, c in enumerate(names)], F.lit(True).alias("z"))


def unbundle(struct: Column, names: list[str]) -> list[Column]:
    """The columns that ``bundle`` packed, under their own names."""
    return [struct[f"c{i}"].alias(c) for i, c in enumerate(names)]


def own_name(stem: str, names: list[str]) -> str:
    """``stem``, or with underscores before it where ``names`` (compared without case) have it."""
    taken = {c.lower() for c in names}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


_RECORD: ContextVar[list[str] | None] = ContextVar("record", default=None)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """Collects the paths of the tables that ``stage_table`` writes inside the block."""
    paths: list[str] = []
    token = _RECORD.set(paths)
    try:
        yield paths
    finally:
        _RECORD.reset(token)


def stage_table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write once under ``spark.checkpoint.dir`` (with Parquet ``options``) and read back; survives lost executors."""
    spark = df.sparkSession
    path = scratch_table_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("errorifexists").options(**options).parquet(path)
    if (paths := _RECORD.get()) is not None:
        paths.append(path)
    return spark.read.parquet(path)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables of ``stage_table`` that nothing reads any more."""
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
