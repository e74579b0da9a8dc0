"""Silver: audited casts, counted repair rules, expectations.

Each rule is a column expression plus a hit flag.  The flags travel with the row, so every
counter comes out of one aggregate on either side of the duplicate removal instead of one
job per counter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.functions.columns import any_of, with_row
from gradus.sources.tables import materialise

# Declared type of each raw column.
NUMERIC_SCHEMA = {
    "applicant_id": "bigint",
    "target_default_90dpd_2yr": "int",
    "revolving_utilisation": "double",
    "age": "double",
    "times_30_59_dpd": "double",
    "debt_ratio": "double",
    "monthly_income": "double",
    "open_credit_lines": "double",
    "times_90_dpd": "double",
    "real_estate_lines": "double",
    "times_60_89_dpd": "double",
    "dependents": "double",
}
PROVENANCE = ("ingested_at", "source_file")
COUNTERS = ["times_30_59_dpd", "times_60_89_dpd", "times_90_dpd"]
SENTINELS = [96, 98]
WINSOR_BOUNDS = {
    "revolving_utilisation": (0.0, 2.0),
    "debt_ratio": (0.0, 5.0),
    "monthly_income": (0.0, 50000.0),
    "dependents": (0.0, 10.0),
}
AGE_RANGE = (18, 100)
UNIT_SWITCH_ABOVE = 100
MISSING_FLAGS = ("monthly_income", "dependents")

HIT = "_hit_"


def _typed(column: str, dtype: str) -> Column:
    value = F.trim(F.col(column).cast("string")).try_cast(dtype)
    if dtype == "double":
        # Text "NaN" parses as a number; as a value it is missing, not the largest one.
        value = F.nanvl(value, F.lit(None).cast("double"))
    return value


def unparseable(column: str, dtype: str) -> Column:
    """Present and not empty, but no value of the declared type; text "NaN" is lost too."""
    raw = F.trim(F.col(column).cast("string"))
    return raw.isNotNull() & (raw != "") & _typed(column, dtype).isNull()


def cast_columns(df: DataFrame, schema: dict[str, str] | None = None) -> DataFrame:
    schema = schema or NUMERIC_SCHEMA
    return df.withColumns({c: _typed(c, t) for c, t in schema.items() if c in df.columns})


def cast_audit(df: DataFrame, schema: dict[str, str] | None = None) -> DataFrame:
    """``column, records``: values that were present but would not cast, in one aggregate."""
    schema = {c: t for c, t in (schema or NUMERIC_SCHEMA).items() if c in df.columns}
    counts = df.agg(*[F.count_if(unparseable(c, t)).alias(c) for c, t in schema.items()])
    return counts.unpivot([], list(schema), "column", "records").where(F.col("records") > 0)


def cast_with_audit(df: DataFrame, schema: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Typed table and the count of what the casts lost."""
    return cast_columns(df, schema), cast_audit(df, schema)


def drop_exact_duplicates(df: DataFrame, id_col: str = "applicant_id", ignore: tuple[str, ...] = PROVENANCE) -> DataFrame:
    """Keep the lowest id of rows equal in every other column (NULLs equal).

    An aggregate, not a window: copies collapse on the map side, so a group that holds a
    third of the table never lands in one task.
    """
    carried = [c for c in ignore if c in df.columns]
    key = [c for c in df.columns if c != id_col and c not in carried]
    kept = df.groupBy(*key).agg(F.min(id_col).alias(id_col), *[F.min_by(c, id_col).alias(c) for c in carried])
    return kept.select(*df.columns)


def null_sentinels(df: DataFrame, columns: list[str], codes: list[int], flag: str) -> DataFrame:
    """Administrative codes in a counter: flag the row, then make the counter missing.

    Three-valued: with no code present and a counter missing, the flag itself is NULL.
    """
    hit = any_of([F.col(c).isin(codes) for c in columns])
    repaired = {c: F.when(F.col(c).isin(codes), F.lit(None).cast("double")).otherwise(F.col(c).cast("double")) for c in columns}
    return df.withColumns({flag: hit.cast("int"), **repaired})


def null_out_of_range(df: DataFrame, column: str, low: float, high: float, hit: str | None = None) -> DataFrame:
    outside = (F.col(column) < low) | (F.col(column) > high)
    changes = {column: F.when(~outside, F.col(column).cast("double"))}
    if hit:
        changes[hit] = outside.cast("int")
    return df.withColumns(changes)


def split_unit_switch(df: DataFrame, ratio: str, base: str, above: float, amount: str, flag: str) -> DataFrame:
    """A ratio above ``above`` whose base is missing is an amount: move it to its own column."""
    switched = F.col(base).isNull() & (F.col(ratio) > above)
    return df.withColumns({
        flag: switched.cast("int"),
        amount: F.when(switched, F.col(ratio)),
        ratio: F.when(switched, F.lit(None).cast("double")).otherwise(F.col(ratio)),
    })


def flag_missing(df: DataFrame, columns) -> DataFrame:
    return df.withColumns({f"flag_{c}_missing": F.col(c).isNull().cast("int") for c in columns})


def winsorise(df: DataFrame, bounds: dict[str, tuple[float, float]], hits: bool = False) -> DataFrame:
    """Clip to bounds; NULL stays NULL (least/greatest alone would return the bound)."""
    changes = {}
    for c, (low, high) in bounds.items():
        if c not in df.columns:
            continue
        changes[c] = F.when(F.col(c).isNotNull(), F.least(F.greatest(F.col(c).cast("double"), F.lit(low)), F.lit(high)))
        if hits:
            changes[f"{HIT}winsorised_{c}"] = F.coalesce((F.col(c) < low) | (F.col(c) > high), F.lit(False)).cast("int")
    return df.withColumns(changes)


def repair(df: DataFrame, bounds: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """The rule chain on a typed, de-duplicated table, with hit flags still attached."""
    df = null_sentinels(df, COUNTERS, SENTINELS, "flag_delinquency_sentinel")
    df = null_out_of_range(df, "age", *AGE_RANGE, hit=f"{HIT}invalid_age")
    df = split_unit_switch(df, "debt_ratio", "monthly_income", UNIT_SWITCH_ABOVE, "monthly_debt_amount", "flag_debt_ratio_is_amount")
    df = flag_missing(df, MISSING_FLAGS)
    return winsorise(df, WINSOR_BOUNDS if bounds is None else bounds, hits=True)


def without_hits(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if not c.startswith(HIT)])


def repaired(bronze: DataFrame) -> DataFrame:
    """Cast, de-duplicated and repaired rows, hit flags attached."""
    return repair(drop_exact_duplicates(cast_columns(bronze)))


def stamp(silver: DataFrame) -> DataFrame:
    return without_hits(silver).withColumn("cleaned_at", F.current_timestamp())


def clean(bronze: DataFrame) -> DataFrame:
    """Silver as one lazy plan."""
    return stamp(repaired(bronze))


def repair_counters() -> list[Column]:
    """Counters after the duplicate removal, for an aggregate or an observation."""
    return [
        F.count(F.lit(1)).alias("rows_out"),
        F.count_if(F.col("flag_delinquency_sentinel") == 1).alias("sentinel"),
        F.count_if(F.col(f"{HIT}invalid_age") == 1).alias("age"),
        F.count_if(F.col("flag_debt_ratio_is_amount") == 1).alias("unit"),
        *[F.count_if(F.col(f"flag_{c}_missing") == 1).alias(f"missing_{c}") for c in MISSING_FLAGS],
        *[F.count_if(F.col(f"{HIT}winsorised_{c}") == 1).alias(f"winsor_{c}") for c in WINSOR_BOUNDS],
    ]


def quality_report(bronze: DataFrame, after: DataFrame) -> DataFrame:
    """``rule, column, records`` from the raw rows and the one-row table of counters."""
    rows_in = bronze.agg(F.count(F.lit(1)).alias("rows_in"))
    lines = [
        ("rows_in", None, "rows_in"),
        ("exact_duplicates_removed", None, "rows_in - rows_out"),
        ("delinquency_sentinel_rows", None, "sentinel"),
        ("invalid_age_rows", None, "age"),
        ("debt_ratio_unit_ambiguous_rows", None, "unit"),
        *[("missing_rows", c, f"missing_{c}") for c in MISSING_FLAGS],
        *[("values_winsorised", c, f"winsor_{c}") for c in WINSOR_BOUNDS],
        ("rows_out", None, "rows_out"),
    ]
    stack = ", ".join(f"'{rule}', {repr(c) if c else 'cast(null as string)'}, {value}" for rule, c, value in lines)
    counted = with_row(rows_in, after).select(F.expr(f"stack({len(lines)}, {stack}) as (rule, column, records)"))
    lost = cast_audit(bronze).select(F.lit("unparseable_values_nulled").alias("rule"), "column", "records")
    return counted.unionByName(lost)


def build_silver(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Silver table and its report.  The repaired rows are staged once; both read from there."""
    staged = materialise(repaired(bronze))
    return stamp(staged), quality_report(bronze, staged.agg(*repair_counters()))


def quality_document(report: DataFrame) -> DataFrame:
    """The report as one JSON document."""
    name = F.concat_ws(".", "rule", "column")
    entries = F.array_sort(F.collect_list(F.struct(name.alias("key"), F.col("records").alias("value"))))
    return report.agg(F.to_json(F.map_from_entries(entries)).alias("document"))


def gold_expectations(
    gold: DataFrame,
    id_col: str = "applicant_id",
    target: str = "target_default_90dpd_2yr",
    splits: int = 3,
    rate_range: tuple[float, float] = (0.03, 0.12),
) -> DataFrame:
    """``check, value, passed`` rows for a gold table.

    Distinct ids are counted on an id-keyed aggregate, so the copies of a hot id combine
    before the shuffle.
    """
    per_id = gold.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(target).isNull()).alias("null_target"),
        F.sum(F.col(target).cast("bigint")).alias("bads"), F.count(target).alias("known"),
    )
    # Labels are counted as they are, whatever they are called; NULL is none.
    labels = gold.groupBy("split").agg(F.count(F.lit(1)).alias("n")).agg(F.count("split").alias("splits"))
    facts = with_row(per_id.agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("ids"), F.sum("null_target").alias("null_target"),
        F.try_divide(F.sum("bads").cast("double"), F.sum("known").cast("double")).alias("rate"),
    ), labels)
    return _gold_checks(facts, splits, rate_range)


def _gold_checks(facts: DataFrame, splits: int, rate_range: tuple[float, float]) -> DataFrame:
    low, high = rate_range
    checks = [
        ("unique_ids", "cast(total - ids as double)", "total = ids"),
        ("null_targets", "cast(null_target as double)", "null_target = 0"),
        ("splits", "cast(splits as double)", f"splits = {splits}"),
        ("default_rate", "rate", f"rate > {low}D and rate < {high}D"),
    ]
    stack = ", ".join(f"'{n}', {v}, {ok}" for n, v, ok in checks)
    return facts.select(F.expr(f"stack({len(checks)}, {stack}) as (check, value, passed)"))


def gold_counters(target: str = "target_default_90dpd_2yr") -> list[Column]:
    """What a write of gold counts as it goes, for ``written_gold_expectations``."""
    known = F.col(target).isNotNull()
    return [
        F.count(F.lit(1)).alias("total"), F.count_if(~known).alias("null_target"),
        F.sum(F.col(target).cast("bigint")).alias("bads"), F.count_if(known).alias("known"),
    ]


def written_gold_expectations(
    written: DataFrame, counts: dict, id_col: str = "applicant_id", splits: int = 3, rate_range: tuple[float, float] = (0.03, 0.12)
) -> DataFrame:
    """``gold_expectations`` of rows that were counted while they were written.

    Only ids and split labels are read back; on a table bucketed by its id the ids are grouped without an exchange.
    """
    ids = written.groupBy(id_col).agg(F.lit(1).alias("one")).agg(F.count(F.lit(1)).alias("ids"))
    labels = written.groupBy("split").agg(F.lit(1).alias("one")).agg(F.count("split").alias("splits"))
    rate = counts["bads"] / counts["known"] if counts["known"] else None
    seen = {"total": F.lit(counts["total"]), "null_target": F.lit(counts["null_target"]), "rate": F.lit(rate).cast("double")}
    return _gold_checks(with_row(ids, labels).withColumns(seen), splits, rate_range)


def require(checks: DataFrame) -> None:
    """Stop the job when a check failed; the check table has a handful of rows."""
    failed = [r["check"] for r in checks.where(~F.col("passed")).select("check").collect()]
    if failed:
        raise RuntimeError(f"failed checks: {', '.join(failed)}")
