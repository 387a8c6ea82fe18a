"""Scoring tables and metrics over predictions (A14–A17, A19–A21, T6, W13,
M8–M10). One aggregate pass per metric set; per-row work stays columnar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.scalars import finite_or_null

KD_ALPHA = 0.7  # Fixed value: weight of the supervised term in the distillation loss.
MAPE_EPS = 1e-8


def _d(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


#: Relative rank error of the sketches is one over this.
ACCURACY = 10_000
#: Rows between two sketch bounds that the exact pass may hold as distinct values; wider bands are sketched again.
BAND_ROWS = 1_000_000


def exact_quantiles(df: DataFrame, col: str | Column, probs: list[float]) -> list[float | None]:
    """Exact linearly interpolated quantiles of one column (see ``exact_quantile_table``)."""
    return exact_quantile_table(df.select(_d(col).alias("v")), {"v": probs})["v"]


def exact_quantile_table(df: DataFrame, wanted: dict[str, list[float]]) -> dict[str, list[float | None]]:
    """Exact linearly interpolated quantiles of several columns in two scans, without sorting any.

    The first scan counts each column and brackets every wanted rank by a
    mergeable quantile sketch. The second clamps the column to each bracket,
    which leaves the rank where it is, and reads the order statistics
    there; distinct values are held inside brackets only, some ``4 / ACCURACY``
    of the rows. Counts beside each bracket prove it (one that misses is opened
    to the whole column). Brackets of more than ``BAND_ROWS`` rows are
    sketched again before, so tables above 2.5 * 10^9 rows take two more scans.
    NULLs are left out. Rule: position ``p·(n−1)``, ``lo + (hi − lo)·frac`` (numpy "linear").
    """
    cols = [c for c, ps in wanted.items() if ps]
    out: dict[str, list[float | None]] = {c: [None] * len(ps) for c, ps in wanted.items()}
    if not cols:
        return out
    q = lambda c: F.col(f"`{c}`").cast("double")
    margin = 2 / ACCURACY
    near = lambda v, ps: F.percentile_approx(v, [x for p in ps for x in (max(0.0, p - margin), min(1.0, p + margin))], ACCURACY)
    first = df.agg(*[F.struct(F.count(q(c)).alias("n"), F.min(q(c)).alias("lo"), F.max(q(c)).alias("hi"),
                              near(q(c), wanted[c]).alias("near")).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    bands = {}  # (column, number of the probability) -> [low, high, rows inside at most]
    size = {}
    for i, c in enumerate(cols):
        s = first[f"c{i}"]
        size[c] = s["n"]
        for j in range(len(wanted[c]) if s["n"] else 0):
            small = s["n"] <= ACCURACY  # few rows: the whole column is a bracket
            bands[c, j] = [s["lo"], s["hi"], s["n"]] if small else [s["near"][2 * j], s["near"][2 * j + 1], 4 * margin * s["n"]]
    place = {k: wanted[k[0]][k[1]] * (size[k[0]] - 1) for k in bands}
    while wide := [k for k, (lo, hi, rows) in bands.items() if rows > BAND_ROWS and lo < hi]:
        inside = lambda k: q(k[0]).between(F.lit(bands[k][0]), F.lit(bands[k][1]))
        r = df.agg(*[F.struct(F.count_if(q(k[0]) < F.lit(bands[k][0])).alias("below"), F.count_if(inside(k)).alias("n")).alias(f"b{i}")
                     for i, k in enumerate(wide)]).first()
        share = {k: (place[k] - r[f"b{i}"]["below"]) / max(1, r[f"b{i}"]["n"] - 1) for i, k in enumerate(wide)}
        got = df.agg(*[near(F.when(inside(k), q(k[0])), [min(1.0, max(0.0, share[k]))]).alias(f"b{i}") for i, k in enumerate(wide)]).first()
        for i, k in enumerate(wide):
            (lo, hi), n = got[f"b{i}"], r[f"b{i}"]["n"]
            # a bracket that no longer narrows has few distinct values
            bands[k] = [lo, hi, 0 if [lo, hi] == bands[k][:2] else min(bands[k][2] / 2, 4 * margin * n)]
    found: dict[tuple[str, int], tuple[float, float]] = {}
    while todo := [k for k in bands if k not in found]:
        held, exact = [], []
        for i, k in enumerate(todo):
            lo, hi, _ = bands[k]
            held += [q(k[0]).alias(f"v{i}"), F.when(q(k[0]).isNotNull(), F.greatest(F.least(q(k[0]), F.lit(hi)), F.lit(lo))).alias(f"h{i}")]
            ranks = [min(int(place[k]) + x, size[k[0]] - 1) for x in (0, 1)]
            # the value of 0-based rank r: the first one whose share of rows reaches (r + 1/2) / n
            disc = [F.expr(f"percentile_disc({(r + 0.5) / size[k[0]]!r}D) WITHIN GROUP (ORDER BY h{i})") for r in ranks]
            exact.append(F.struct(F.count_if(F.col(f"v{i}") < F.lit(lo)).alias("below"), F.count_if(F.col(f"v{i}") <= F.lit(hi)).alias("upto"),
                                  disc[0].alias("a"), disc[1].alias("b")).alias(f"e{i}"))
        r = df.select(*held).agg(*exact).first()
        for i, k in enumerate(todo):
            e, c = r[f"e{i}"], k[0]
            if e["below"] <= int(place[k]) and min(int(place[k]) + 1, size[c] - 1) < e["upto"]:
                found[k] = (e["a"], e["b"])
            else:
                bands[k] = [first[f"c{cols.index(c)}"]["lo"], first[f"c{cols.index(c)}"]["hi"], size[c]]
    for (c, j), (a, b) in found.items():
        frac = place[c, j] - int(place[c, j])
        out[c][j] = a if frac == 0 else a + (b - a) * frac
    return out


def regression_metrics(df: DataFrame, y: str = "actual", p: str = "predicted") -> DataFrame:
    """M8: MAE, RMSE, R², median / p90 / p95 absolute error, safe MAPE, n (one row).

    Rows without an actual or a predicted value are left out of every figure.
    Sums are one aggregate pass; the three error quantiles are exact
    (``exact_quantiles``), without a sort and never from one task.
    """
    df = df.where(_d(y).isNotNull() & _d(p).isNotNull())
    yd = _d(y)
    err = _d(p) - yd
    abs_err = F.abs(err)
    n = F.count(F.lit(1))
    qs = exact_quantiles(df, abs_err, [0.5, 0.9, 0.95])
    pct = F.array(*[F.lit(q).cast("double") for q in qs])
    agg = df.agg(
        (F.sum(abs_err) / n).alias("mae"),
        F.sqrt(F.sum(err * err) / n).alias("rmse"),
        F.sum(err * err).alias("sse"),
        (F.var_pop(yd) * n).alias("sst"),
        F.first(pct).alias("q"),
        (F.avg(F.when(F.abs(yd) >= MAPE_EPS, abs_err / F.abs(yd))) * F.lit(100.0)).alias("mape_percent"),
        n.alias("n_test"),
    )
    return agg.select(
        "mae", "rmse",
        F.when(F.col("sst") > 0, F.lit(1.0) - F.col("sse") / F.col("sst")).alias("r2"),
        F.col("q")[0].alias("median_ae"), F.col("q")[1].alias("p90_ae"), F.col("q")[2].alias("p95_ae"),
        "mape_percent", "n_test")


def residual_histogram(df: DataFrame, y: str = "actual", p: str = "predicted", bins: int = 30) -> DataFrame:
    """Equal-width histogram of residuals (pred − actual), right edge of the last bin closed.

    Always ``bins`` rows, empty bins included; no residuals, no rows. A range
    of one value counts in the first bin. The range is one aggregate row,
    applied as literals."""
    r = df.select((_d(p) - _d(y)).alias("r")).where(F.col("r").isNotNull())
    lo, hi = r.agg(F.min("r"), F.max("r")).first()  # one row: the range
    lo_, width = F.lit(lo).cast("double"), F.lit(hi).cast("double") - F.lit(lo).cast("double")
    b = F.when(width == 0, F.lit(1)).otherwise(F.least(F.floor((F.col("r") - lo_) / width * F.lit(bins)) + 1, F.lit(bins)))
    h = r.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(1, bins + 1 if lo is not None else 1).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(h), "bin", "left").select(
        "bin", (lo_ + width * (F.col("bin") - 1) / F.lit(bins)).alias("lo_edge"),
        (lo_ + width * F.col("bin") / F.lit(bins)).alias("hi_edge"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def top_errors(df: DataFrame, keys: list[str], y: str = "actual", p: str = "predicted", k: int = 15) -> DataFrame:
    """The ``k`` largest absolute errors (a top-k report; keys break ties)."""
    e = F.abs(_d(p) - _d(y))
    return (df.select(*keys, _d(y).alias(y), _d(p).alias(p), e.alias("abs_err"))
            .orderBy(F.col("abs_err").desc(), *keys).limit(k))


def clip_scale(df: DataFrame, col: str, lo_q: float = 0.05, hi_q: float = 0.95) -> DataFrame:
    """5th/95th-percentile clip to [0, 1], ×100 + 20; a flat column gives 40."""
    lo, hi = exact_quantiles(df, col, [lo_q, hi_q])
    j = df.withColumns({"__lo": F.lit(lo).cast("double"), "__hi": F.lit(hi).cast("double")})
    v = _d(col)
    norm = F.least(F.greatest((v - F.col("__lo")) / (F.col("__hi") - F.col("__lo")), F.lit(0.0)), F.lit(1.0))
    size = F.when(F.col("__hi") - F.col("__lo") <= F.lit(1e-12), F.lit(40.0)).otherwise(F.lit(20.0) + F.lit(100.0) * norm)
    return j.withColumn("size", size).drop("__lo", "__hi")


def kd_loss(df: DataFrame, student: str, y: str | None, teacher: str | None, alpha: float = KD_ALPHA) -> DataFrame:
    """α·L1(student, y) + (1−α)·MSE(student, teacher) over finite targets.

    With only one target available that term alone; with none, NULL.
    """
    s = _d(student)
    l1 = F.avg(F.abs(s - finite_or_null(F.col(y)))) if y else F.lit(None).cast("double")
    mse = F.avg(F.pow(s - finite_or_null(F.col(teacher)), 2)) if teacher else F.lit(None).cast("double")
    agg = df.agg(l1.alias("l1"), mse.alias("mse"))
    loss = (F.when(F.col("l1").isNotNull() & F.col("mse").isNotNull(),
                   F.lit(alpha) * F.col("l1") + F.lit(1.0 - alpha) * F.col("mse"))
            .otherwise(F.coalesce(F.col("l1"), F.col("mse"))))
    return agg.withColumn("loss", loss)


def ensemble_stats(df: DataFrame, members: list[str]) -> DataFrame:
    """Per-row mean and population std over member predictions."""
    k = len(members)
    ms = [_d(m) for m in members]
    mean = ms[0]
    for m in ms[1:]:
        mean = mean + m
    mean = mean / F.lit(float(k))
    sq = lambda m: (m - F.col("pred_mean")) * (m - F.col("pred_mean"))  # noqa: E731 (x·x, not pow)
    dev = sq(ms[0])
    for m in ms[1:]:
        dev = dev + sq(m)
    return df.withColumn("pred_mean", mean).withColumn("pred_std", F.sqrt(dev / F.lit(float(k))))


def sorted_parity(df: DataFrame, keys: list[str], y: str = "actual", p: str = "predicted") -> DataFrame:
    """Hold-out rows ranked by actual value (parity / band table)."""
    from ledgerline.operators.features import global_rank
    base = df.select(*keys, _d(y).alias(y), _d(p).alias(p))
    return global_rank(base, [F.col(y)] + [F.col(k) for k in keys] + [F.col(p)], "rank")
