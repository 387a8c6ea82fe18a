"""Weak supervision for document quality.

Every rule looks at one cheap statistic of the whole text and votes good (+1),
bad (-1) or abstains (0). Expectation-maximisation over the table of vote
patterns estimates how accurate each rule is when it votes; the posterior
probability of "good" then weighs all votes, instead of demanding that all
rules pass.

Scale: statistics and votes are one narrow projection per row, without a
shuffle. The patterns are counted with a partial aggregate; the pattern table
has at most 3^rules rows whatever the corpus, so each EM step is one aggregate
over a small written table. No rows are joined or grouped by a document key.

Defined results: null text counts as empty; an empty text has no words, fails
the base rules and is dropped; repeated rows are judged alike, one result row
each; an empty table gives an empty result; extra columns are carried through.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import WS_CHARS, col, fresh, let, stage_table, windows, words

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
#: EM stops at this change of any accuracy, or after so many steps.
TOLERANCE, MAX_STEPS = 1e-4, 40
#: Beta priors of each rule's two accuracies; they decide where data say nothing.
ON_GOOD, ON_BAD = (95.0, 5.0), (5.0, 5.0)


def repeated_window_words(w: Column, k: int = WINDOW) -> Column:
    """Words inside k-word windows that occur twice or more in ``w`` (first occurrence included)."""
    hashes = windows(w, k, F.xxhash64)

    def covered(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = let(ordered, lambda s: F.sort_array(F.filter(
            F.transform(s, lambda x, j: F.when(
                (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]), x["i"])),
            lambda p: p.isNotNull())))
        # union of the intervals [p, p + k)
        return F.aggregate(starts, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
                           lambda a, p: F.struct((p + k).alias("end"),
                                                 (a["n"] + p + k - F.greatest(p, a["end"])).alias("n")))["n"]

    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0))
               .otherwise(covered(h)))


def statistics(text: Column) -> Column:
    """One struct of counts over the whole text."""
    t = F.coalesce(text, F.lit(""))
    # one pass over the text leaves the characters that any rule counts, and some punctuation
    marks = F.regexp_replace(t, "[^!-Z|]+", "")

    def of(w: Column) -> Column:
        lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(WS_CHARS)) != "")
        line_stats = let(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
            F.size(F.filter(x, lambda y: F.substring(F.rtrim(y), -1, 1).isin(*".!?:;\"'»”…)"))).cast("long").alias("ended")))
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            line_stats.alias("lines"),
            repeated_window_words(w).cast("long").alias("n_repeat_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            let(marks, lambda m: F.struct(*[
                F.length(F.regexp_replace(m, f"[^{cls}]+", "")).cast("long").alias(n)
                for n, cls in (("n_symbols", "#*$%&|<>"), ("n_digits", "0-9"), ("n_upper", "A-Z"), ("n_bang", "!"))])).alias("marks"))

    return let(words(t), of)


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains."""
    name: str
    bad: Callable[[dict[str, Column]], Column]
    good: Callable[[dict[str, Column]], Column]


RULES = (
    Rule("length", lambda s: s["n_words"] < 20, lambda s: s["n_words"] >= 50),
    Rule("repetition", lambda s: s["n_repeat_words"] * 100 > s["n_words"] * 30,
         lambda s: s["n_repeat_words"] * 100 <= s["n_words"] * 15),
    Rule("symbols", lambda s: s["n_symbols"] * 10 > s["n_words"], lambda s: s["n_symbols"] * 50 <= s["n_words"]),
    Rule("line_copies", lambda s: s["n_dup_lines"] * 10 > s["n_lines"] * 3,
         lambda s: (s["n_dup_lines"] == 0) & (s["n_lines"] >= 2)),
    Rule("word_length", lambda s: (s["word_chars"] * 2 < s["n_words"] * 5) | (s["word_chars"] > s["n_words"] * 14),
         lambda s: (s["word_chars"] >= s["n_words"] * 3) & (s["word_chars"] <= s["n_words"] * 12)),
    Rule("digits", lambda s: s["n_digits"] * 10 > s["word_chars"] * 3, lambda s: s["n_digits"] * 10 <= s["word_chars"]),
    Rule("shouting", lambda s: s["n_upper"] * 10 > s["word_chars"] * 4, lambda s: s["n_upper"] * 20 <= s["word_chars"] * 3),
    Rule("vocabulary", lambda s: (s["n_words"] >= 50) & (s["n_distinct"] * s["n_distinct"] < s["n_words"] * 4),
         lambda s: (s["n_words"] >= 50) & (s["n_distinct"] * s["n_distinct"] >= s["n_words"] * 16)),
    Rule("sentence_ends", lambda s: (s["n_lines"] >= 5) & (s["n_ended_lines"] * 10 < s["n_lines"]),
         lambda s: (s["n_lines"] >= 1) & (s["n_ended_lines"] * 2 >= s["n_lines"])),
    Rule("exclamation", lambda s: s["n_bang"] * 10 > s["n_words"] * 3, lambda s: s["n_bang"] * 20 <= s["n_words"]),
)


def label(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES, carry: list[str] | None = None,
          ) -> DataFrame:
    """``carry`` (default: all columns) plus one struct column ``quality``.

    ``quality`` holds the statistics, ``votes`` (one tinyint a rule),
    ``base_failed``, the posterior ``p_good`` and ``kept``. The statistics are
    computed once and written with the carried columns.
    """
    carry = docs.columns if carry is None else carry
    raw, out = fresh(docs, "raw", "quality")
    d = docs.select(*[col(c) for c in carry], statistics(col(text_col)).alias(raw))
    s = {n: col(raw)[n] for n in ("n_words", "word_chars", "n_repeat_words", "n_distinct")}
    s |= {n: col(raw)["marks"][n] for n in ("n_symbols", "n_digits", "n_upper", "n_bang")}
    s |= {"n_lines": col(raw)["lines"]["n"], "n_dup_lines": col(raw)["lines"]["dup"],
                                           "n_ended_lines": col(raw)["lines"]["ended"]}
    vote = lambda r: F.when(r.bad(s), F.lit(-1)).when(r.good(s), F.lit(1)).otherwise(F.lit(0)).cast("tinyint")
    failed = (s["n_words"] < MIN_WORDS) | (s["n_repeat_words"] * 100 > s["n_words"] * MAX_REPEAT_PCT)
    d = d.select(*[col(c) for c in carry], F.struct(
        *[v.alias(n) for n, v in s.items()], F.array(*[vote(r) for r in rules]).alias("votes"),
        failed.alias("base_failed")).alias(out))
    d = stage_table(d, "quality")
    model = fit(d.select(col(out)["votes"].alias("votes")), len(rules))
    q = col(out)
    p = posterior(q["votes"], model)
    return d.select(*[col(c) for c in carry], q.withField("p_good", p).withField(
        "kept", ~q["base_failed"] & (p >= 0.5)).alias("quality" if "quality" not in carry else out))


def posterior(votes: Column, model: dict) -> Column:
    """P(good | votes) for rules that are independent given the class.

    The accuracies go in as arrays, so that every EM step runs the same generated code.
    """
    good = F.array(*[F.lit(math.log(g / (1 - b))) for g, b in zip(model["on_good"], model["on_bad"], strict=True)])
    bad = F.array(*[F.lit(math.log((1 - g) / b)) for g, b in zip(model["on_good"], model["on_bad"], strict=True)])
    each = F.transform(votes, lambda v, j: F.when(v == 1, F.get(good, j)).when(v == -1, F.get(bad, j)).otherwise(F.lit(0.0)))
    logit = F.aggregate(each, F.lit(math.log(model["prior"] / (1 - model["prior"]))), lambda a, x: a + x)
    return 1 / (1 + F.exp(-logit))


def fit(votes: DataFrame, n_rules: int, tolerance: float = TOLERANCE, max_steps: int = MAX_STEPS) -> dict:
    """EM for the share of good rows and the accuracies of each rule.

    A rule has two accuracies: ``on_good``, the chance that its vote on a good
    row says good, and ``on_bad``, the chance that its vote on a bad row says
    bad (a rule sees one kind of defect, so this one may be low). A bad vote
    is always taken as evidence against a row, never for it, which also fixes
    which class is "good". Runs on the counted vote patterns, at most
    3^n_rules rows. No rows: the priors.
    """
    patterns = stage_table(votes.groupBy("votes").agg(F.count(F.lit(1)).alias("n"))
                           .repartition(1).sortWithinPartitions("votes"), "patterns")
    model = {"prior": 0.8, "on_good": [ON_GOOD[0] / sum(ON_GOOD)] * n_rules,
             "on_bad": [ON_BAD[0] / sum(ON_BAD)] * n_rules, "steps": 0}
    for step in range(1, max_steps + 1):
        # a vote 0 that always says good stands for the row itself
        each = patterns.select("n", posterior(F.col("votes"), model).alias("p"),
                               F.posexplode(F.concat(F.array(F.lit(1).cast("tinyint")), F.col("votes"))).alias("j", "v"))
        rows = {r["j"]: r for r in each.where("v <> 0").groupBy("j").agg(
            F.sum(F.expr("n * p")).alias("g"), F.sum(F.expr("n * (1 - p)")).alias("b"),
            F.sum(F.expr("CASE WHEN v = 1 THEN n * p ELSE 0D END")).alias("gg"),
            F.sum(F.expr("CASE WHEN v = -1 THEN n * (1 - p) ELSE 0D END")).alias("bb")).collect()}
        if 0 not in rows:
            return model
        none = {"g": 0.0, "b": 0.0, "gg": 0.0, "bb": 0.0}
        total, rules = rows[0], [rows.get(j + 1, none) for j in range(n_rules)]
        prior = min(0.99, max(0.01, (total["g"] + 8.0) / (total["g"] + total["b"] + 10.0)))
        on_good = [min(0.999, max(0.55, (r["gg"] + ON_GOOD[0]) / (r["g"] + sum(ON_GOOD)))) for r in rules]
        on_bad = [min(0.99, max(2 * (1 - on_good[j]), 0.01, (r["bb"] + ON_BAD[0]) / (r["b"] + sum(ON_BAD))))
                  for j, r in enumerate(rules)]
        old = [model["prior"], *model["on_good"], *model["on_bad"]]
        model = {"prior": prior, "on_good": on_good, "on_bad": on_bad, "steps": step}
        if max(abs(x - y) for x, y in zip([prior, *on_good, *on_bad], old, strict=True)) < tolerance:
            break
    return model


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose verdict is kept, with the columns of ``docs``."""
    d = label(docs, text_col)
    return d.where(col(d.columns[-1])["kept"]).select(*[col(c) for c in docs.columns])
