"""Series operators: from the long fact frame to one resolved series per
(company, metric), de-accumulated and ranked by recency.

Every operator works on all companies at once; the company is a column.

Plan shape (see ``explain``):
  facts ⋈ broadcast(metric map)             -- unit filter + tag roles
  → min(rank) per (cik, metric) ⋉ facts     -- tag/tier choice, partial agg
  → lag() over (cik, metric, tag, form, fy) -- year-to-date → quarter
  → sum per period | join on period | as is -- component combining
  → row_number() <= n over (cik, metric)    -- partial top-n before the shuffle

No exchange is keyed on the company alone, so one very large company is
spread over many tasks; the per-(cik, metric) top-n is computed map-side
(WindowGroupLimit) before its shuffle, so a hot key ships only n rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline import schemas as S

SERIES_COLUMNS = ["cik", "metric", "kind", "tag", "unit", "end", "form", "fy", "fp",
                  "qtrs", "val", "scale_applied", "k1", "k2", "k3", "k4", "k5", "k6"]


def attach_metric_map(facts: DataFrame, mmap: DataFrame) -> DataFrame:
    """Give each fact its metric role; drops facts in a unit no metric allows.

    The map is a fixed table of a few dozen rows, so broadcasting it is safe
    at any data size. A fact can serve several metrics (operating income is
    both a stamp source and an EBITDA input).
    """
    return facts.join(F.broadcast(mmap), ["namespace", "tag", "unit"], "inner")


def _rank_key() -> Column:
    # One number orders tiers, and inside a "first" tier the tag priority.
    return F.col("tier") * 100 + F.when(F.col("combine") == "first", F.col("priority")).otherwise(0)


def resolve_tags(tagged: DataFrame) -> DataFrame:
    """Keep, per (cik, metric), only the rows of the winning tier and tag.

    Rule: the lowest tier with any rows wins; inside a ``first`` tier the
    lowest-priority tag with any rows wins (never spliced across tags);
    inside ``sum``/``join`` tiers all components are kept.
    The winner table has one row per (cik, metric) and is built with a
    partial aggregate; the semi-join lets AQE broadcast it when small and
    split skewed partitions otherwise.
    """
    t = tagged.withColumn("rank_key", _rank_key())
    best = t.groupBy("cik", "metric").agg(F.min("rank_key").alias("rank_key"))
    return t.join(best, ["cik", "metric", "rank_key"], "left_semi")


def quarter_window() -> Window:
    return (Window.partitionBy("cik", "metric", "tag", "form", "fy")
            .orderBy(F.col("end").asc_nulls_last(), F.col("pos").asc_nulls_last()))


def to_quarterly_col(w: Window | None = None, strict_qtrs: bool = False) -> Column:
    """Year-to-date value → quarter value (W1), as a column expression.

    Inside (form, fiscal year) ordered by end date, subtract the previous
    row's raw value when the rows are adjacent: previous ``qtrs`` equals
    ``qtrs - 1``, else ``fp`` is the successor in Q1→Q2→Q3→Q4. Otherwise the
    value is kept. Only one previous row is needed, so ``lag(1)`` is exact.
    ``strict_qtrs`` keeps a row whose ``qtrs`` is 1 as it is (the documented
    intent); by default a one-quarter row still falls back to ``fp`` adjacency,
    as the reference code does (quirk Q2).
    """
    w = w or quarter_window()
    fp_order = F.array(*[F.lit(x) for x in S.FP_ORDER])
    fp_idx = F.coalesce(F.array_position(fp_order, F.col("fp")), F.lit(0))
    prev_val = F.lag("val").over(w)
    prev_q = F.lag("qtrs").over(w)
    prev_fp_idx = F.coalesce(F.array_position(fp_order, F.lag("fp").over(w)), F.lit(0))
    q = F.col("qtrs")
    by_qtrs = q.isNotNull() & prev_q.isNotNull() & (prev_q == q - 1)
    by_fp = (fp_idx > 0) & (prev_fp_idx > 0) & (prev_fp_idx == fp_idx - 1)
    adjacent = F.coalesce(by_qtrs, F.lit(False)) | F.coalesce(by_fp, F.lit(False))
    if strict_qtrs:
        adjacent = adjacent & ~F.coalesce(q == 1, F.lit(False))
    return (F.when(F.col("val").isNull(), F.col("val"))
            .when(adjacent & prev_val.isNotNull(), F.col("val") - prev_val)
            .otherwise(F.col("val")))


def _w1_value(prev_val: Column, prev_q: Column, prev_fp: Column) -> Column:
    fp_order = F.array(*[F.lit(x) for x in S.FP_ORDER])
    fp_idx = F.coalesce(F.array_position(fp_order, F.col("fp")), F.lit(0))
    prev_fp_idx = F.coalesce(F.array_position(fp_order, prev_fp), F.lit(0))
    q = F.col("qtrs")
    by_qtrs = q.isNotNull() & prev_q.isNotNull() & (prev_q == q - 1)
    by_fp = (fp_idx > 0) & (prev_fp_idx > 0) & (prev_fp_idx == fp_idx - 1)
    adjacent = F.coalesce(by_qtrs, F.lit(False)) | F.coalesce(by_fp, F.lit(False))
    return (F.when(F.col("val").isNull(), F.col("val"))
            .when(adjacent & prev_val.isNotNull(), F.col("val") - prev_val)
            .otherwise(F.col("val")))


QUARTER_GROUP = ["cik", "metric", "tag", "form", "fy"]


def to_quarterly_ranged(series: DataFrame) -> DataFrame:
    """W1 for inputs where one (company, metric, tag, form, fiscal year) group may be huge.

    The window form needs each group in one task. Here rows are range-sorted
    by (group, end, pos) over many partitions and written once (so partition
    ids are stable); ``lag`` runs inside each partition's chunk of a group, and
    the first row of a partition takes its predecessor from the last row of
    the previous non-empty partition (one row per partition, broadcast).
    Same result as ``to_quarterly``; a group may span any number of tasks.
    """
    from ledgerline.session import cut_lineage
    g = QUARTER_GROUP
    order = [F.col("end").asc_nulls_last(), F.col("pos").asc_nulls_last()]
    srt = cut_lineage(series.orderBy(*[F.col(c) for c in g], *order)
                      .withColumn("__pid", F.spark_partition_id()), "w1-sorted")
    w = Window.partitionBy("__pid", *g).orderBy(*order)
    chunk = srt.select("*", F.lag("val").over(w).alias("__pv"), F.lag("qtrs").over(w).alias("__pq"),
                       F.lag("fp").over(w).alias("__pf"), F.row_number().over(w).alias("__rn"))
    key = F.struct(*[F.col(c) for c in g], F.col("end").isNull(), F.col("end"), F.col("pos").isNull(), F.col("pos"))
    last = srt.groupBy("__pid").agg(F.max_by(F.struct(*[F.col(c) for c in g], "val", "qtrs", "fp"), key).alias("__l"))
    prev = last.select("__pid", F.lag("__l").over(Window.orderBy("__pid")).alias("__p"))  # one row per partition
    j = chunk.join(F.broadcast(prev), "__pid", "left")
    same = F.lit(True)
    for c in g:
        same = same & F.col(c).eqNullSafe(F.col("__p")[c])
    carry = (F.col("__rn") == 1) & F.col("__p").isNotNull() & same
    pv = F.when(carry, F.col("__p")["val"]).otherwise(F.col("__pv"))
    pq = F.when(carry, F.col("__p")["qtrs"]).otherwise(F.col("__pq"))
    pf = F.when(carry, F.col("__p")["fp"]).otherwise(F.col("__pf"))
    return j.select(*[F.col(c) for c in series.columns if c != "val"], _w1_value(pv, pq, pf).alias("val"))


def _ranged_w1(t: DataFrame) -> DataFrame:
    """Skew-proof W1 on the flow rows of a tagged frame; other rows pass through."""
    return to_quarterly_ranged(t.where(F.col("quarterly"))).unionByName(t.where(~F.col("quarterly")))


def to_quarterly(series: DataFrame) -> DataFrame:
    """W1 over a series frame with columns cik, metric, tag, form, fy, end, pos, qtrs, fp, val."""
    return series.withColumn("val", to_quarterly_col())


def _fy_key(c: Column) -> Column:
    return F.lpad(c.cast("string"), 11, "0")


def _date_key(c: Column) -> Column:
    return c.cast("string")


def _null_str() -> Column:
    return F.lit(None).cast("string")


def order_keys(kind: str, pos: Column | None = None, pos2: Column | None = None) -> dict[str, Column]:
    """Recency keys k1..k6 (ascending, NULLs last) per series kind.

    quarterly (after W1): form, fy, end        -- groups in (form, fy) order
    raw:                  end, form            -- sorted by (end, form)
    sum (per period):     end, form, fy, fp    -- sorted by the group keys
    join (EBITDA):        left order, then right position
    ``pos`` is the entry position in the source, the final tie-break.
    """
    pos = F.col("pos") if pos is None else pos
    pos2 = F.lit(0).cast("bigint") if pos2 is None else pos2
    form, fy, end, fp = F.col("form"), F.col("fy"), F.col("end"), F.col("fp")
    if kind in ("quarterly", "join"):
        ks = [form, _fy_key(fy), _date_key(end), _null_str(), pos, pos2]
    elif kind == "raw":
        ks = [_date_key(end), form, _null_str(), _null_str(), pos, pos2]
    elif kind == "sum":
        ks = [_date_key(end), form, _fy_key(fy), fp, F.lit(0).cast("bigint"), pos2]
    else:
        raise ValueError(kind)
    return {f"k{i + 1}": k.cast("bigint") if i >= 4 else k.cast("string") for i, k in enumerate(ks)}


def _finish(df: DataFrame, kind: str, keys: dict[str, Column]) -> DataFrame:
    return df.withColumns(keys).withColumn("kind", F.lit(kind)).select(*SERIES_COLUMNS)


def resolve_series(facts: DataFrame, mmap: DataFrame, kinds: set[tuple[str, bool]] | None = None,
                   checkpoint: bool = True, ranged_lag: bool = False) -> DataFrame:
    """All metrics of all companies as resolved series (tag choice, W1, combining).

    Output: ``SERIES_COLUMNS``; ``kind`` tells which recency order applies.
    ``kinds`` — the (combine, quarterly) pairs present in ``mmap`` — lets the
    plan skip branches that cannot produce rows (see ``schemas.map_kinds``).
    """
    kinds = kinds if kinds is not None else {("first", True), ("first", False), ("sum", False), ("join", True)}
    combines = {c for c, _ in kinds}
    tagged = attach_metric_map(facts, mmap)
    if checkpoint:
        # The tag choice reads the tagged facts twice (winner aggregate + semi-join)
        # and every combine branch reads them again: write this small subset of
        # the facts (only metric-map tags) once to the shared checkpoint folder so
        # the raw input is scanned once and the job restarts from here on failure.
        from ledgerline.session import cut_lineage
        tagged = cut_lineage(tagged, "tagged-facts")
    chosen = resolve_tags(tagged)
    # W1 only where the metric is a flow (revenue, EBITDA inputs, net income).
    has_flow = any(qf for _, qf in kinds)
    if has_flow and ranged_lag:
        q = _ranged_w1(chosen)
    elif has_flow:
        q = chosen.withColumn("val", F.when(F.col("quarterly"), to_quarterly_col()).otherwise(F.col("val")))
    else:
        q = chosen
    parts: list[DataFrame] = []

    if "first" in combines:
        first = q.where(F.col("combine") == "first")
        if ("first", True) in kinds:
            parts.append(_finish(first.where(F.col("quarterly")), "quarterly", order_keys("quarterly")))
        if ("first", False) in kinds:
            parts.append(_finish(first.where(~F.col("quarterly")), "raw", order_keys("raw")))

    if "sum" in combines:
        # Sum of present components per period; NULL period keys drop out.
        comp = q.where(F.col("combine") == "sum")
        keys = ["end", "form", "fy", "fp"]
        summed = (comp.where(F.col("end").isNotNull() & F.col("form").isNotNull()
                             & F.col("fy").isNotNull() & F.col("fp").isNotNull())
                  .groupBy("cik", "metric", *keys)
                  .agg(F.sum("val").alias("val"), F.max("out_tag").alias("tag"))
                  .withColumns({"unit": F.lit("USD"), "qtrs": F.lit(None).cast("int"),
                                "scale_applied": F.lit(0)}))
        parts.append(_finish(summed, "sum", order_keys("sum")))

    if "join" in combines:
        # EBITDA composite: inner join of the two inputs on the period; NULL keys match.
        joined = join_on_period(q.where((F.col("combine") == "join") & (F.col("priority") == 1)),
                                q.where((F.col("combine") == "join") & (F.col("priority") == 2)),
                                extra_keys=["cik", "metric"])
        joined = joined.select(
            "cik", "metric", "end", "form", "fy", "fp",
            (F.coalesce(F.col("val_a"), F.lit(0)) + F.coalesce(F.col("val_b"), F.lit(0))).alias("val"),
            F.col("out_tag_a").alias("tag"), F.lit("USD").alias("unit"),
            F.lit(None).cast("int").alias("qtrs"), F.lit(0).alias("scale_applied"),
            F.col("pos_a").alias("pos"), F.col("pos_b").alias("pos2"))
        parts.append(_finish(joined, "join", order_keys("join", F.col("pos"), F.col("pos2"))))

    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


#: Rows of a task that sorts facts.
TASK_ROWS = 500_000


def latest_series(facts: DataFrame, mmap: DataFrame, n: int,
                  kinds: set[tuple[str, bool]] | None = None, ranged_lag: bool = False) -> DataFrame:
    """The newest ``n`` rows of every (company, metric) with the tag/tier choice
    folded into the recency ranking (W2 + J2 in one window).

    Each candidate tag is de-accumulated on its own key, combining happens
    per tier, and the window orders by (tier·priority rank, valid period,
    form tier, recency). The winning tag/tier and form tier are the first
    row's, so keeping the top-n rows that share them equals "choose the tag,
    then take the newest n" -- without a winner aggregate, a semi-join or any
    exchange keyed on the company; the top-n is computed map-side.
    A tier whose component rows all lack a period key still wins (and yields
    nothing), as in the reference. Same output as
    ``latest_rows(resolve_series(...), n)``. ``ranged_lag`` de-accumulates with
    ``to_quarterly_ranged`` (for inputs where one group may be huge).

    The tagged facts are written once, as every branch reads them. They are
    dealt by the de-accumulation's key over as many tasks as their number
    asks for, so the memory of the sorts does not grow with the input.
    """
    from ledgerline.session import cut_lineage
    kinds = kinds if kinds is not None else {("first", True), ("first", False), ("sum", False), ("join", True)}
    combines = {c for c, _ in kinds}
    t = cut_lineage(attach_metric_map(facts, mmap).withColumn("rank_key", _rank_key()), "tagged-facts")
    tasks = -(-t.count() // TASK_ROWS) or 1

    def branch(combine: str, quarterly: bool) -> DataFrame:
        part = t.where((F.col("combine") == combine) & (F.col("quarterly") if quarterly else ~F.col("quarterly")))
        if quarterly and ranged_lag:
            return to_quarterly_ranged(part)
        if quarterly or combine == "first":
            part = part.repartition(tasks, *QUARTER_GROUP)
        return to_quarterly(part) if quarterly else part

    def rows_of(combine: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [branch(combine, q) for c, q in sorted(kinds) if c == combine])

    cols = SERIES_COLUMNS + ["rank_key", "valid"]
    parts: list[DataFrame] = []

    def fin(df: DataFrame, kind: str, keys: dict[str, Column], extra: dict[str, Column] | None = None) -> DataFrame:
        # one projection per branch (each DataFrame call re-analyses the plan)
        computed = {**keys, "kind": F.lit(kind), **(extra or {})}
        return df.select(*[computed[c].alias(c) if c in computed else F.col(c) for c in cols])

    if "first" in combines:
        valid = {"valid": F.lit(True)}
        if ("first", True) in kinds:
            parts.append(fin(branch("first", True), "quarterly", order_keys("quarterly"), valid))
        if ("first", False) in kinds:
            parts.append(fin(branch("first", False), "raw", order_keys("raw"), valid))
    if "sum" in combines:
        period = ["end", "form", "fy", "fp"]
        valid = F.col("end").isNotNull() & F.col("form").isNotNull() & F.col("fy").isNotNull() & F.col("fp").isNotNull()
        summed = (rows_of("sum").withColumn("valid", valid)
                  .groupBy("cik", "metric", "rank_key", "valid", *period)
                  .agg(F.sum("val").alias("val"), F.max("out_tag").alias("tag"))
                  .withColumns({"unit": F.lit("USD"), "qtrs": F.lit(None).cast("int"), "scale_applied": F.lit(0)}))
        parts.append(fin(summed, "sum", order_keys("sum")))
    if "join" in combines:
        jq = rows_of("join")
        joined = join_on_period(jq.where(F.col("priority") == 1), jq.where(F.col("priority") == 2),
                                extra_keys=["cik", "metric", "rank_key"])
        joined = joined.select(
            "cik", "metric", "rank_key", F.lit(True).alias("valid"), "end", "form", "fy", "fp",
            (F.coalesce(F.col("val_a"), F.lit(0)) + F.coalesce(F.col("val_b"), F.lit(0))).alias("val"),
            F.col("out_tag_a").alias("tag"), F.lit("USD").alias("unit"),
            F.lit(None).cast("int").alias("qtrs"), F.lit(0).alias("scale_applied"),
            F.col("pos_a").alias("pos"), F.col("pos_b").alias("pos2"))
        parts.append(fin(joined, "join", order_keys("join", F.col("pos"), F.col("pos2"))))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)

    keys = ["cik", "metric"]
    w = (Window.partitionBy(*keys)
         .orderBy(F.col("rank_key").asc(), F.col("valid").desc(), form_tier().asc(),
                  *[F.col(f"k{i}").desc_nulls_first() for i in range(1, 7)]))
    ranked = u.select("*", form_tier().alias("ftier"), F.row_number().over(w).alias("rn")).where(F.col("rn") <= n)
    best = F.min(F.struct(F.col("rank_key"), (~F.col("valid")).alias("invalid"), F.col("ftier"))) \
        .over(Window.partitionBy(*keys))
    out_cols = [c for c in ranked.columns if c not in ("rank_key", "valid")]
    return (ranked.select("*", best.alias("__best"))
            .where((F.col("rank_key") == F.col("__best.rank_key")) & F.col("valid")
                   & (F.col("ftier") == F.col("__best.ftier")))
            .select(*out_cols))


def join_on_period(a: DataFrame, b: DataFrame, extra_keys: list[str] | None = None,
                   cols: list[str] | None = None) -> DataFrame:
    """Inner join on (end, form, fy, fp) where NULL matches NULL; suffixes _a/_b.

    ``extra_keys`` are plain equality keys (the company, the metric).
    """
    extra_keys = extra_keys or []
    period = ["end", "form", "fy", "fp"]
    cols = cols or [c for c in a.columns if c not in period + extra_keys]
    ra = a.select(*extra_keys, *period, *[F.col(c).alias(c + "_a") for c in cols])
    bcols = [c for c in b.columns if c not in period + extra_keys]
    rb = b.select(*[F.col(k).alias(k + "__r") for k in extra_keys + period],
                  *[F.col(c).alias(c + "_b") for c in bcols])
    cond = [F.col(k) == F.col(k + "__r") for k in extra_keys]
    cond += [F.col(k).eqNullSafe(F.col(k + "__r")) for k in period]
    out = ra.join(rb, cond, "inner")
    return out.drop(*[k + "__r" for k in extra_keys + period])


def form_tier() -> Column:
    return (F.when(F.col("form") == S.QUARTERLY_FORM, 1)
            .when(F.col("form") == S.ANNUAL_FORM, 2).otherwise(3))


def recency_window(keys: list[str]) -> Window:
    return (Window.partitionBy(*keys)
            .orderBy(F.col("ftier").asc(),
                     *[F.col(f"k{i}").desc_nulls_first() for i in range(1, 7)]))


def latest_rows(series: DataFrame, n: int, keys: list[str] | None = None) -> DataFrame:
    """Last ``n`` rows per series in recency order, form tiers applied.

    Tier 1: ``10-Q`` rows if any; else tier 2: ``10-K`` rows; else any form.
    ``rn`` = 1 is the newest row. The row_number filter is planned as a
    WindowGroupLimit, so at most ``n`` rows per key leave each map task.
    """
    keys = keys or ["cik", "metric"]
    ranked = (series.withColumn("ftier", form_tier())
              .withColumn("rn", F.row_number().over(recency_window(keys)))
              .where(F.col("rn") <= n))
    top_tier = F.min("ftier").over(Window.partitionBy(*keys))
    return ranked.withColumn("top_tier", top_tier).where(F.col("ftier") == F.col("top_tier")).drop("top_tier")


def calendar_summary(series: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Opt-in calendar LTM / YoY (quirk Q1, ``mode='calendar'``).

    The positional rule takes "the last 4 rows" and "the 5th row from the
    end", which skip missing quarters. Here quarters are addressed by
    (fiscal year, Q1..Q4): LTM sums the four fiscal quarters ending at the
    newest quarter and needs all four; YoY compares the newest quarter with
    the same one a fiscal year earlier. A quarter that was filed several times
    counts once, by its newest row (latest period end, then position). The
    fourth quarter is rarely filed: it is the annual value less the three
    quarters of that year. The first aggregate leaves one row a quarter, so
    the window over a (company, metric) sees quarters, never raw rows.
    """
    keys = keys or ["cik", "metric"]
    fp_idx = F.array_position(F.array(*[F.lit(x) for x in S.FP_ORDER]), F.col("fp"))
    slot = (F.when((F.col("form") == S.QUARTERLY_FORM) & (fp_idx > 0), fp_idx)
            .when((F.col("form") == S.ANNUAL_FORM) & (F.col("fp") == "FY"), F.lit(5)))
    newest = F.struct(*[F.col(c) for c in ("end", "pos", "val") if c in series.columns])
    q = series.withColumn("slot", slot).where(F.col("slot").isNotNull() & F.col("fy").isNotNull() & F.col("val").isNotNull())
    one = q.groupBy(*keys, "fy", "slot").agg(F.max_by("val", newest).alias("val"))
    year = one.groupBy(*keys, "fy").agg(*[F.max(F.when(F.col("slot") == i, F.col("val"))).alias(f"v{i}") for i in range(1, 6)])
    q4 = F.coalesce(F.col("v4"), F.col("v5") - F.col("v1") - F.col("v2") - F.col("v3"))
    quarters = year.select(*keys, F.explode(F.array(*[
        F.struct((F.col("fy") * 4 + i - 1).alias("qi"), (q4 if i == 4 else F.col(f"v{i}")).alias("val")) for i in range(1, 5)])).alias("x"))
    quarters = quarters.select(*keys, "x.*").where("val IS NOT NULL")
    quarters = quarters.withColumn("top", F.max("qi").over(Window.partitionBy(*keys)))
    v = F.col("val").cast("double")
    recent = F.col("qi") > F.col("top") - 4
    agg = quarters.groupBy(*keys).agg(
        F.max(F.when(F.col("qi") == F.col("top"), v)).alias("lq"),
        F.count_if(recent).alias("n4"),
        F.sum(F.when(recent, F.col("val"))).cast("double").alias("sum4"),
        F.max(F.when(F.col("qi") == F.col("top") - 4, v)).alias("prior"))
    return agg.select(
        *keys, "lq", (F.col("lq") * F.lit(4.0)).alias("annualized"),
        F.when(F.col("n4") == 4, F.col("sum4")).alias("ltm"),
        F.when(F.col("prior") != 0, (F.col("lq") - F.col("prior")) / F.col("prior") * F.lit(100.0)).alias("yoy"))


def series_summary(latest: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """LQ, annualized, LTM and YoY from the ranked latest rows.

    LQ = newest value; annualized = LQ × 4; LTM = sum of the newest 4 when at
    least 4 rows exist; YoY = growth of the newest over the 5th newest
    (signed prior; NULL when fewer than 5 rows or the prior is 0).
    Also returns the newest row's stamp and provenance.
    """
    keys = keys or ["cik", "metric"]
    rn = F.col("rn")
    val = F.col("val").cast("double")
    newest = F.max(F.when(rn == 1, F.struct("end", "fy", "fp", "form", "tag", "unit", "scale_applied")))
    agg = latest.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.max(F.when(rn == 1, val)).alias("lq"),
        # Summed in the source type (exact for DECIMAL), cast afterwards.
        F.sum(F.when(rn <= 4, F.col("val"))).cast("double").alias("sum4"),
        F.max(F.when(rn == 5, val)).alias("prior"),
        newest.alias("newest"),
    )
    return agg.select(
        *keys,
        F.col("lq"),
        (F.col("lq") * F.lit(4.0)).alias("annualized"),
        F.when(F.col("n_rows") >= 4, F.coalesce(F.col("sum4"), F.lit(0.0))).alias("ltm"),
        F.when(F.col("n_rows") >= 5,
               F.when(F.col("prior") != 0,
                      (F.col("lq") - F.col("prior")) / F.col("prior") * F.lit(100.0))).alias("yoy"),
        F.col("newest.end").alias("end"), F.col("newest.fy").alias("fy"),
        F.col("newest.fp").alias("fp"), F.col("newest.form").alias("form"),
        F.col("newest.tag").alias("tag"), F.col("newest.unit").alias("unit"),
        F.col("newest.scale_applied").alias("scale_applied"),
    )
