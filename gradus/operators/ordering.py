"""Global order statistics without a one-partition sort.

``row_number() over (order by x)`` sends every row to one task.  The operators here first
reduce the data to counted distinct values, then split those by approximate cut points so
that each window partition holds a bounded share, and carry the totals of the lower shares
as offsets.  Results are exact: the approximate cut points only decide where work is split.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from gradus.functions.columns import literal, number, quoted
from gradus.sources.tables import materialise

ROWS_PER_BUCKET = 1_000_000
CUT_SKETCH = 8_192
BRACKET_SKETCH = 2_048
MERGE_WIDTH = 256
RANK_STRETCHES = 1_024


def melt(df: DataFrame, keep: list[str], cells: dict[str, list[Column]], names: list[str]) -> DataFrame:
    """Wide to long: one row per (row, feature) holding ``names``; an Expand, no shuffle."""
    wide = df.select(
        *keep,
        *[c.alias(f"c{i}_{j}") for i, cols in enumerate(cells.values()) for j, c in enumerate(cols)],
    )
    width = len(names)
    quoted = ", ".join(f"`{n}`" for n in names)
    value_list = ", ".join(
        "(" + ", ".join(f"c{i}_{j}" for j in range(width)) + f") AS `{feature}`" for i, feature in enumerate(cells)
    )
    return df.sparkSession.sql(
        f"SELECT * FROM {{wide}} UNPIVOT INCLUDE NULLS (({quoted}) FOR feature IN ({value_list}))", wide=wide
    )


def sketched_quantiles(df: DataFrame, columns: list[str], points: list[float], size: int, by: str | None = None) -> DataFrame:
    """Approximate quantiles (``n_<i>``, ``q_<i>`` per column) from mergeable KLL sketches.

    Sketches of the map tasks are merged in two levels, so that no single task receives one
    from every input split.
    """
    group = [by] if by else []
    names = [quoted(c) for c in columns]
    first = df.groupBy(*group, F.pmod(F.spark_partition_id(), F.lit(MERGE_WIDTH)).alias("_part")).agg(
        *[F.expr(f"kll_sketch_agg_double({c}, {size})").alias(f"k_{i}") for i, c in enumerate(names)]
    )
    merged = first.groupBy(*group).agg(*[F.expr(f"kll_merge_agg_double(k_{i})").alias(f"k_{i}") for i in range(len(names))])
    wanted = ", ".join(literal(x) for x in points)
    cells = []
    for i in range(len(names)):
        n = f"kll_sketch_get_n_double(k_{i})"
        cells += [F.expr(n).alias(f"n_{i}"), F.expr(f"CASE WHEN {n} > 0 THEN kll_sketch_get_quantile_double(k_{i}, array({wanted})) END").alias(f"q_{i}")]
    return merged.select(*group, *cells)


def running_totals(
    df: DataFrame,
    key: str,
    sums: list[str],
    by: list[str] | None = None,
    ties: list[str] | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    n_rows: int | None = None,
) -> DataFrame:
    """Add ``cum_<s>``: inclusive running sum of each column in ``key`` order, within ``by``.

    ``key`` must be numeric; rows equal on ``key`` are ordered by ``ties``.  A NULL key comes
    first and a NaN last, and no row is dropped.  Rows are bucketed by approximate cut points of
    the key, as many as it takes for ``rows_per_bucket``; each (by, bucket) is summed, the sums
    of the lower buckets become offsets, and the window runs inside a bucket only.  A hot
    ``by`` value is split over many buckets, because the cut points come from all rows.  How
    many buckets there are changes where the work is done, not the result; of a single one
    all offsets are zero, and that join is left out.
    """
    by = by or []
    order = [F.col(key), *[F.col(t) for t in ties or []]]
    n_rows = df.count() if n_rows is None else n_rows
    buckets = max(1, math.ceil(n_rows / rows_per_bucket))
    cuts: list[float] = []
    position = F.col(key).cast("double")
    present = F.when(~F.isnan(position), position)
    if buckets > 1:
        points = [i / buckets for i in range(1, buckets)]
        cuts = sketched_quantiles(df.select(present.alias("k")), ["k"], points, CUT_SKETCH).first()["q_0"] or []
    cuts = sorted({c for c in cuts if math.isfinite(c)})
    if not cuts:
        w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({f"cum_{s}": F.sum(s).over(w) for s in sums})

    splits = [-math.inf, *cuts, math.inf]
    found = Bucketizer(splits=splits, inputCol="_position", outputCol="_found").transform(df.withColumn("_position", F.coalesce(present, F.lit(0.0))))
    bucket = F.when(position.isNull(), F.lit(-1.0)).when(F.isnan(position), F.lit(float(len(splits)))).otherwise(F.col("_found"))
    placed = found.withColumn("_bucket", bucket).drop("_position", "_found")
    totals = placed.groupBy(*by, "_bucket").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    # One row per bucket and group: what a task of this window holds is 1 / rows_per_bucket of the rows.
    below = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(b).alias(f"_b_{b}") for b in by],
        F.col("_bucket").alias("_b_bucket"),
        *[F.coalesce(F.sum(f"_t_{s}").over(below), F.lit(0)).alias(f"_o_{s}") for s in sums],
    )
    same = [F.col(b).eqNullSafe(F.col(f"_b_{b}")) for b in by]
    matched = placed.join(offsets, [F.col("_bucket") == F.col("_b_bucket"), *same])
    w = Window.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return matched.select(*df.columns, *[(F.col(f"_o_{s}") + F.sum(s).over(w)).alias(f"cum_{s}") for s in sums])


# --- exact quantiles ----------------------------------------------------------------------
@dataclass
class ColumnQuantiles:
    """Order statistics of one column (of one group)."""

    n: int
    values: dict[float, float] = field(default_factory=dict)


def _ranks(n: int, p: float, method: str) -> tuple[int, int, float]:
    """1-based ranks that bound the quantile and the weight of the upper one."""
    if method == "lower":
        r = max(1, math.ceil(round(p * n, 9)))
        return r, r, 0.0
    position = p * (n - 1)
    low = min(int(math.floor(position)), n - 1)
    return low + 1, min(low + 2, n), position - low


def _disjoint(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _interval_sql(name: str, brackets: list[tuple[float, float]]) -> str:
    """Interval number of a value: odd ones are brackets, even ones lie between them."""
    c = quoted(name)
    steps = " ".join(
        f"WHEN {c} < {literal(lo)} THEN {2 * i} WHEN {c} <= {literal(hi)} THEN {2 * i + 1}" for i, (lo, hi) in enumerate(brackets)
    )
    return f"CASE WHEN {c} IS NULL THEN NULL {steps} ELSE {2 * len(brackets)} END"


def quantiles(
    df: DataFrame,
    columns: list[str],
    probs: list[float],
    method: str = "linear",
    by: str | None = None,
    max_groups: int = 1_000,
    sketch: int = BRACKET_SKETCH,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> dict[tuple, ColumnQuantiles]:
    """Exact quantiles of many columns, keyed ``(group, column)``.

    ``linear`` interpolates as numpy does; ``lower`` returns a value of the data.  Two scans
    and no sort of the data: the first brackets each quantile with a sketch, the second counts what lies outside the brackets and keeps only the distinct values inside
    them.  If a bracket turns out not to hold its rank, that column is counted again with an
    open bracket, so the answer never depends on the approximation.  Cut points and quantiles
    are model-sized, so ``by`` is for a few groups (splits, bands): more than ``max_groups`` are
    refused; medians of many groups are ``grouped_median``'s.
    """
    group = [F.col(by).alias("_group")] if by else [F.lit(None).cast("string").alias("_group")]
    base = df.select(*group, *[number(c).alias(c) for c in columns])
    margin = 4.0 / sketch**0.9  # well over the rank error of a sketch of this size
    points = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-margin, margin)})
    position = {p: i for i, p in enumerate(points)}
    first = sketched_quantiles(base, columns, points, sketch, by="_group")
    summary = first.limit(max_groups + 1).collect()
    if len(summary) > max_groups:
        raise ValueError(f"more than {max_groups} groups; use grouped_median for wide grouping")

    out: dict[tuple, ColumnQuantiles] = {}
    brackets: dict[tuple, list[tuple[float, float]]] = {}
    for row in summary:
        for i, c in enumerate(columns):
            out[row["_group"], c] = ColumnQuantiles(row[f"n_{i}"])
            if row[f"n_{i}"]:
                q = row[f"q_{i}"]
                brackets[row["_group"], c] = _disjoint(
                    [(q[position[max(0.0, p - margin)]], q[position[min(1.0, p + margin)]]) for p in probs]
                )
    while brackets:
        found = _select_in_brackets(base, brackets, out, probs, method, rows_per_bucket)
        missed = set()
        for cell in brackets:
            n = out[cell].n
            for p in probs:
                low, high, weight = _ranks(n, p, method)
                a, b = found.get((cell, low)), found.get((cell, high))
                if a is None or b is None:
                    missed.add(cell)
                    continue
                # numpy's two-sided interpolation, so both engines round alike
                out[cell].values[p] = a + (b - a) * weight if weight < 0.5 else b - (b - a) * (1.0 - weight)
        brackets = {cell: [(-math.inf, math.inf)] for cell in missed}
    return out


def _cases(by_group: dict[str, str]) -> str:
    names = {g: g.replace("\\", "\\\\").replace("'", "\\'") for g in by_group}
    return " ".join(f"WHEN _group = '{names[g]}' THEN {sql}" for g, sql in by_group.items())


def _select_in_brackets(base, brackets, out, probs, method, rows_per_bucket) -> dict[tuple, float]:
    spark = base.sparkSession
    columns = list(dict.fromkeys(c for _, c in brackets))
    groups = list(dict.fromkeys(g for g, _ in brackets))
    intervals = []
    for c in columns:
        cases = {g: _interval_sql(c, brackets[g, c]) for g in groups if (g, c) in brackets}
        if None in cases:
            text = cases[None] if len(cases) == 1 else f"CASE WHEN _group IS NULL THEN {cases.pop(None)} {_cases(cases)} END"
        else:
            text = f"CASE {_cases(cases)} END"
        intervals.append(F.expr(text).alias(f"_interval_{c}"))
    placed = base.select("_group", *columns, *intervals)
    cells = {c: [F.col(f"_interval_{c}"), F.when(F.col(f"_interval_{c}") % 2 == 1, F.col(c))] for c in columns}
    counted = materialise(
        melt(placed, ["_group"], cells, ["interval", "value"])
        .where(F.col("interval").isNotNull())
        .groupBy("_group", "feature", "interval", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    summed = counted.groupBy("_group", "feature", "interval").agg(F.sum("n").alias("n"), F.count("value").alias("inside")).collect()
    sizes = {(r["_group"], r["feature"], r["interval"]): r["n"] for r in summed}
    targets, base_rank = [], {}
    for (g, c), pieces in brackets.items():
        below = 0
        wanted = {r for p in probs for r in _ranks(out[g, c].n, p, method)[:2]}
        for interval in range(2 * len(pieces) + 1):
            size = sizes.get((g, c, interval), 0)
            if interval % 2:
                base_rank[g, c, interval] = below
                targets += [(g, c, interval, r - below) for r in wanted if below < r <= below + size]
            below += size
    if not targets:
        return {}
    inside = counted.where(F.col("value").isNotNull())
    ranked = running_totals(inside, "value", ["n"], by=["_group", "feature", "interval"], rows_per_bucket=rows_per_bucket,
                            n_rows=sum(r["inside"] for r in summed))
    # The wanted ranks are columns x quantiles rows, so they are safe to broadcast.
    wanted_df = spark.createDataFrame(targets, "t_group string, t_feature string, t_interval int, rank long")
    hits = ranked.join(
        F.broadcast(wanted_df),
        F.col("_group").eqNullSafe(F.col("t_group"))
        & (F.col("feature") == F.col("t_feature"))
        & (F.col("interval") == F.col("t_interval"))
        & (F.col("rank") > F.col("cum_n") - F.col("n"))
        & (F.col("rank") <= F.col("cum_n")),
    ).select("t_group", "t_feature", "t_interval", "rank", "value")
    return {
        ((r["t_group"], r["t_feature"]), r["rank"] + base_rank[r["t_group"], r["t_feature"], r["t_interval"]]): r["value"]
        for r in hits.collect()
    }


def grouped_median(df: DataFrame, by: list[str], value: str, alias: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Interpolated median per group, for any number of groups and any group size.

    Equal values are counted first, so a hot group shrinks to its distinct values, and the
    running count splits what is left of it over many tasks.
    """
    counted = materialise(
        df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_totals(counted, "_v", ["n"], by=by, rows_per_bucket=rows_per_bucket)
    sizes = counted.groupBy(*by).agg(F.sum("n").alias("_size"))
    low = F.expr("(_size + 1) div 2")
    high = F.expr("_size div 2 + 1")
    before = F.col("cum_n") - F.col("n")
    return (
        ranked.join(sizes, by)
        .groupBy(*by)
        .agg(
            F.max(F.when((before < low) & (low <= F.col("cum_n")), F.col("_v"))).alias("_low"),
            F.max(F.when((before < high) & (high <= F.col("cum_n")), F.col("_v"))).alias("_high"),
        )
        .select(*by, ((F.col("_low") + F.col("_high")) / F.lit(2.0)).alias(alias))
    )


# --- totals at given ranks ----------------------------------------------------------------
def score_table(df: DataFrame, p: str, y: str, by: list[str] | None = None) -> DataFrame:
    """One row per distinct score: rows and bads.  A scorecard has finitely many scores, so
    this is where a table of any size becomes small (map-side combined)."""
    return df.groupBy(*(by or []), F.col(p).cast("double").alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("bigint")).alias("bads")
    )


@dataclass(frozen=True)
class RankCut:
    rank: int
    p: float
    bads: int
    sum_p: float


def totals_at_ranks(
    df: DataFrame,
    p: str,
    y: str,
    id_col: str,
    ranks_of,
    descending: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> tuple[int, int, dict[int, RankCut]]:
    """Bads and summed score among the first ``r`` rows in (score, id) order, for a few ranks.

    ``ranks_of(n)`` gives the ranks once the row count is known.  Scores are collapsed first;
    only a score that a rank cuts through is resolved row by row, by id, and those rows
    are split by id buckets.  ``id_col`` must be unique and numeric.
    """
    table = materialise(score_table(df, p, y).withColumns({
        "key": -F.col("p") if descending else F.col("p"),
        "sum_p": F.col("p") * F.col("n"),
    }))
    totals = table.agg(F.sum("n").alias("n"), F.sum("bads").alias("bads"), F.count(F.lit(1)).alias("scores")).first()
    n, bads = totals["n"] or 0, totals["bads"] or 0
    ranks = sorted({int(r) for r in ranks_of(n) if 1 <= r <= n})
    if not ranks:
        return n, bads, {}
    ranked = running_totals(table, "key", ["n", "bads", "sum_p"], rows_per_bucket=rows_per_bucket, n_rows=totals["scores"])
    # Ranks are met by the stretch they lie in.  A score takes part in as many stretches as its
    # rows reach over, so all scores together make RANK_STRETCHES rows more at most.
    stretch = max(1, -(-n // RANK_STRETCHES))
    wanted = df.sparkSession.createDataFrame([(r, (r - 1) // stretch) for r in ranks], "rank long, place long")
    reach = F.sequence(F.expr(f"(cum_n - n) div {stretch}"), F.expr(f"(cum_n - 1) div {stretch}"))
    hits = ranked.withColumn("stretch", F.explode(reach)).join(
        F.broadcast(wanted), (F.col("stretch") == F.col("place")) & (F.col("rank") > F.col("cum_n") - F.col("n")) & (F.col("rank") <= F.col("cum_n"))
    ).collect()
    out, cut_through = {}, {}
    for h in hits:
        if h["rank"] == h["cum_n"]:
            out[h["rank"]] = RankCut(h["rank"], h["p"], h["cum_bads"], h["cum_sum_p"])
        else:
            cut_through.setdefault(h["p"], []).append(h)
    if cut_through:
        tied = materialise(df.where(F.col(p).cast("double").isin(list(cut_through))).select(
            F.col(p).cast("double").alias("p"), F.col(id_col).alias("id"), F.lit(1).cast("bigint").alias("one"),
            F.col(y).cast("bigint").alias("y"),
        ))
        # Key on the score first, so that every tied score is ordered by id on its own.
        ordered = running_totals(tied, "id", ["one", "y"], by=["p"], rows_per_bucket=rows_per_bucket)
        inner = df.sparkSession.createDataFrame(
            [(s, h["rank"] - (h["cum_n"] - h["n"])) for s, hs in cut_through.items() for h in hs], "s double, m long"
        )
        taken = {
            (r["s"], r["m"]): r["cum_y"]
            for r in ordered.join(F.broadcast(inner), (F.col("p") == F.col("s")) & (F.col("cum_one") == F.col("m"))).collect()
        }
        for s, hs in cut_through.items():
            for h in hs:
                m = h["rank"] - (h["cum_n"] - h["n"])
                out[h["rank"]] = RankCut(
                    h["rank"], s, h["cum_bads"] - h["bads"] + taken[s, m], h["cum_sum_p"] - h["sum_p"] + s * m
                )
    return n, bads, out


def rounded(values, digits: int) -> list[float]:
    """numpy's decimal rounding of a short list."""
    return [float(v) for v in np.round(np.asarray(values, dtype=float), digits)]
