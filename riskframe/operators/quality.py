"""Data-quality report and record validation.

The report reads the table once for all counters (rows, missing per
column, ranges, inversion) and once more, through one shuffle, for the
duplicate count. Zero-count issues are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe import schema as S
from riskframe.functions.columns import is_missing


def _dtypes(df: DataFrame) -> dict:
    return {f.name: f.dataType for f in df.schema.fields}


def out_of_range(c: str, low: float, high: float, dtype=None) -> Column:
    """present and outside the inclusive [low, high] (NaN is missing,
    never out of range; Spark would call NaN > high true)."""
    return ~is_missing(c, dtype) & ((F.col(c) < low) | (F.col(c) > high))


def inverted(rule: S.InversionRule) -> Column:
    """the 'low' column exceeds the 'high' one."""
    return F.coalesce(F.col(rule.low_col) > F.col(rule.high_col), F.lit(False))


def counters(df: DataFrame, ranges: tuple[S.RangeRule, ...] = (),
             inversion: S.InversionRule | None = None) -> DataFrame:
    """One row: n_rows, miss__<col> per column, range__<col>, inversion."""
    types = _dtypes(df)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(is_missing(c, types[c])).alias(f"miss__{c}") for c in df.columns]
    aggs += [F.count_if(out_of_range(r.column, r.low, r.high, types[r.column]))
             .alias(f"range__{r.column}") for r in ranges if r.column in types]
    if inversion is not None and {inversion.high_col, inversion.low_col} <= set(types):
        aggs.append(F.count_if(inverted(inversion)).alias("inversion"))
    return df.agg(*aggs)


def missing_counts(df: DataFrame) -> DataFrame:
    """A2: ``(column, position, n_missing)`` for every column, long form."""
    c = counters(df)
    pairs = F.array(*[F.struct(F.lit(name).alias("column"), F.lit(i).alias("position"),
                               F.col(f"miss__{name}").alias("n_missing"))
                      for i, name in enumerate(df.columns)])
    return c.select(F.inline(pairs))


def duplicate_count(df: DataFrame, exclude: tuple[str, ...] = ("id",)) -> DataFrame:
    """A3: rows that repeat an earlier row on every column but ``exclude``.
    ``distinct`` treats null = null and NaN = NaN like pandas; the partial
    aggregate collapses a hot duplicate group before the shuffle."""
    types = _dtypes(df)
    cols = [c for c in df.columns if c not in exclude]
    # null and NaN are one "missing" value, as in pandas
    norm = [F.when(~is_missing(c, types[c]), F.col(c)).alias(c) for c in cols]
    # one scan: distinct rows with their multiplicity give both counts
    groups = df.select(*norm).groupBy(*cols).agg(F.count(F.lit(1)).alias("__m"))
    return (groups.agg(F.sum("__m").cast("long").alias("n_rows"),
                       F.count(F.lit(1)).alias("n_distinct"))
            .withColumn("n_rows", F.coalesce(F.col("n_rows"), F.lit(0).cast("long")))
            .withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct")))


def duplicate_count_hashed(df: DataFrame, exclude: tuple[str, ...] = ("id",),
                           broadcast_limit: int = 1_000_000) -> DataFrame:
    """A3 with a smaller shuffle, same exact answer.

    Phase 1 shuffles only a 96-bit hash of each row (xxhash64 + murmur3)
    and counts rows per hash. Hash groups of one row are distinct rows.
    Phase 2 re-reads only the rows whose hash repeats (a semi-join with the
    repeated hashes, broadcast when they are few) and counts their exact
    distinct rows, so hash collisions cannot change the result. Worth it for
    wide rows with few duplicates; :func:`duplicate_count` is one pass.
    """
    from pyspark.sql import types as T
    types = _dtypes(df)
    cols = [c for c in df.columns if c not in exclude]
    if not cols:
        return duplicate_count(df, exclude)

    def norm(c):
        present = F.when(~is_missing(c, types[c]), F.col(c))
        if isinstance(types[c], (T.FloatType, T.DoubleType)):
            present = F.when(present == 0, F.lit(0.0).cast(types[c])).otherwise(present)  # -0.0
        return present.alias(c)

    x = df.select(*[norm(c) for c in cols])
    h1, h2 = F.xxhash64(*cols), F.hash(*cols)
    g = x.groupBy(h1.alias("__h1"), h2.alias("__h2")).agg(F.count(F.lit(1)).alias("__m"))
    st = g.agg(F.coalesce(F.sum("__m"), F.lit(0)).alias("n_rows"),
               F.count_if(F.col("__m") == 1).alias("singles"),
               F.count_if(F.col("__m") > 1).alias("repeated")).first()
    n_distinct = st["singles"]
    if st["repeated"]:
        keys = g.where(F.col("__m") > 1).select("__h1", "__h2")
        keys = F.broadcast(keys) if st["repeated"] <= broadcast_limit else keys
        cand = (x.select("*", h1.alias("__h1"), h2.alias("__h2"))
                .join(keys, ["__h1", "__h2"], "left_semi").drop("__h1", "__h2"))
        n_distinct += cand.distinct().count()
    n_rows = int(st["n_rows"])
    return df.sparkSession.createDataFrame(
        [(n_rows, int(n_distinct), n_rows - int(n_distinct))],
        "n_rows long, n_distinct long, n_duplicates long")


def range_issues(df: DataFrame, ranges: tuple[S.RangeRule, ...]) -> DataFrame:
    """A4: ``(column, low, high, affected_rows, severity)`` per rule, all rules."""
    c = counters(df, ranges)
    types = _dtypes(df)
    rules = [r for r in ranges if r.column in types]
    pairs = F.array(*[F.struct(F.lit(r.column).alias("column"), F.lit(float(r.low)).alias("low"),
                               F.lit(float(r.high)).alias("high"),
                               F.col(f"range__{r.column}").alias("affected_rows"))
                      for r in rules])
    return (c.select("n_rows", F.inline(pairs))
            .withColumn("severity", F.when(F.col("affected_rows") > F.col("n_rows") *
                                           S.RANGE_HIGH_SEVERITY_SHARE, F.lit(S.SEVERITY_HIGH))
                        .otherwise(F.lit(S.SEVERITY_LOW)))
            .drop("n_rows"))


def _fmt(x: float) -> str:
    return repr(float(x))


def quality_report(df: DataFrame, ranges: tuple[S.RangeRule, ...] = S.CLINICAL_BOUNDS,
                   inversion: S.InversionRule | None = S.CLINICAL_INVERSION,
                   exclude_from_duplicates: tuple[str, ...] = ("id",),
                   inversion_description: str = S.DESC_INVERSION,
                   duplicates: str = "exact") -> DataFrame:
    """Issues ``(issue_order, column, description, affected_rows, severity)``
    in the fixed order missing, duplicates, ranges, inversion.
    ``duplicates="hashed"`` counts duplicates with the two-phase hashed
    method (same answer, smaller shuffle for wide rows)."""
    types = _dtypes(df)
    c = counters(df, ranges, inversion)
    counter = duplicate_count_hashed if duplicates == "hashed" else duplicate_count
    dup = counter(df, exclude_from_duplicates).select("n_duplicates")
    one = F.lit(1).alias("__one")
    c = c.select("*", one).join(F.broadcast(dup.select("*", one)), "__one")  # one row each

    def issue(col: str, desc: str, count: Column, severity: Column) -> Column:
        return F.struct(F.lit(col).alias("column"), F.lit(desc).alias("description"),
                        count.cast("long").alias("affected_rows"), severity.alias("severity"))

    items = [issue(name, S.DESC_MISSING, F.col(f"miss__{name}"), F.lit(S.SEVERITY_MEDIUM))
             for name in df.columns]
    items.append(issue(S.DATASET_COLUMN, S.DESC_DUPLICATES, F.col("n_duplicates"),
                       F.lit(S.SEVERITY_MEDIUM)))
    for r in ranges:
        if r.column not in types:
            continue
        cnt = F.col(f"range__{r.column}")
        sev = F.when(cnt > F.col("n_rows") * S.RANGE_HIGH_SEVERITY_SHARE,
                     F.lit(S.SEVERITY_HIGH)).otherwise(F.lit(S.SEVERITY_LOW))
        items.append(issue(r.column, S.DESC_RANGE.format(low=_fmt(r.low), high=_fmt(r.high)),
                           cnt, sev))
    if inversion is not None and "inversion" in c.columns:
        items.append(issue(f"{inversion.high_col}/{inversion.low_col}", inversion_description,
                           F.col("inversion"), F.lit(S.SEVERITY_HIGH)))
    return (c.select(F.posexplode(F.array(*items)).alias("issue_order", "i"))
            .select("issue_order", "i.*")
            .where(F.col("affected_rows") > 0))


def quality_summary(df: DataFrame, label: str | None = None,
                    subgroup: str | None = None,
                    exclude_from_duplicates: tuple[str, ...] = ("id",)) -> DataFrame:
    """One row: n_rows, n_duplicates, n_missing_total, class and subgroup
    balance as ``map<string,double>`` (A1, A6)."""
    c = counters(df)
    total = sum((F.col(f"miss__{n}") for n in df.columns), F.lit(0))
    out = c.select("n_rows", total.cast("long").alias("n_missing_total"), F.lit(1).alias("__one"))
    out = out.join(F.broadcast(duplicate_count(df, exclude_from_duplicates)
                               .select("n_duplicates", F.lit(1).alias("__one"))), "__one")
    for name, col in (("class_balance", label), ("subgroup_balance", subgroup)):
        if col is None:
            continue
        p = proportions(df, col).agg(F.map_from_entries(F.collect_list(
            F.struct(F.col("value"), F.col("proportion")))).alias(name))
        out = out.join(F.broadcast(p.select("*", F.lit(1).alias("__one"))), "__one")
    return out.drop("__one")


def proportions(df: DataFrame, col: str) -> DataFrame:
    """Share of each level among non-missing values."""
    types = _dtypes(df)
    present = df.where(~is_missing(col, types[col]))
    counts = present.groupBy(F.col(col).cast("string").alias("value")).agg(
        F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))   # from the level counts, no second scan
    one = F.lit(1).alias("__one")
    return (counts.select("*", one).join(F.broadcast(total.select("*", one)), "__one")
            .select("value", "n", (F.col("n") / F.col("total")).alias("proportion")))


def validate(df: DataFrame, rules: S.ValidationRules = S.REQUEST_RULES) -> DataFrame:
    """adds ``violations array<string>`` (rule names, in rule order) and
    ``is_valid``. A required field that is missing violates ``<col>:missing``."""
    types = _dtypes(df)
    checks = []
    for r in rules.ranges:
        miss = is_missing(r.column, types.get(r.column))
        checks.append(F.when(miss, F.lit(f"{r.column}:missing")))
        checks.append(F.when(~miss & ((F.col(r.column) < r.low) | (F.col(r.column) > r.high)),
                             F.lit(f"{r.column}:range")))
    for col, allowed in rules.enums:
        miss = is_missing(col, types.get(col))
        checks.append(F.when(miss, F.lit(f"{col}:missing")))
        checks.append(F.when(~miss & ~F.col(col).isin(*allowed), F.lit(f"{col}:enum")))
    # concat_ws skips the nulls (rules that hold); both functions are code-generated
    joined = F.concat_ws(",", *checks)
    violations = F.when(joined == "", F.array().cast("array<string>")).otherwise(
        F.split(joined, ","))
    return (df.withColumn("violations", violations)
            .withColumn("is_valid", F.size("violations") == 0))


def split_valid(df: DataFrame, rules: S.ValidationRules = S.REQUEST_RULES
                ) -> tuple[DataFrame, DataFrame]:
    """Valid rows and quarantined rows (with reasons). Write them with
    ``write.partitionBy('is_valid')`` to produce both from one scan."""
    v = validate(df, rules)
    return v.where("is_valid").drop("violations", "is_valid"), v.where(~F.col("is_valid"))


def cleaning_filter(df: DataFrame, bounds: dict[str, tuple[float, float]],
                    inversion: S.InversionRule | None = None) -> DataFrame:
    """F8: keep rows strictly inside each (low, high) and not inverted."""
    cond = F.lit(True)
    for c, (lo, hi) in bounds.items():
        cond = cond & (F.col(c) > lo) & (F.col(c) < hi)
    if inversion is not None:
        cond = cond & (F.col(inversion.low_col) < F.col(inversion.high_col))
    return df.where(cond)


def require_columns(df: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """Fail with the sorted missing names when a column is absent."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}; expected: {list(required)}")
    return df


def quality_text(summary: DataFrame, issues: DataFrame) -> DataFrame:
    """``(line_no, line)`` of a readable report, built from the one-row summary (with the
    balance maps it has) and the issue table."""
    def section(number: int, title: str, lines: Column) -> DataFrame:
        body = F.concat(F.array(F.lit(f"== {title} ==")), lines)
        return summary.select(F.lit(number).alias("part"), F.posexplode(body).alias("pos", "line"))

    counts = [F.concat(F.lit(f"{name}: "), F.col(c).cast("string")) for name, c in
              (("rows", "n_rows"), ("repeated rows", "n_duplicates"), ("missing cells", "n_missing_total"))]
    parts = [section(0, "table", F.array(*counts))]
    for number, c in ((1, "class_balance"), (2, "subgroup_balance")):
        if c in summary.columns:
            shares = F.transform(F.array_sort(F.map_entries(c)), lambda e: F.format_string("%s: %.2f %%", e["key"], e["value"] * 100))
            parts.append(section(number, c.replace("_", " "), shares))
    parts.append(section(3, "findings", F.array().cast("array<string>")))
    found = issues.select(F.lit(4).alias("part"), F.col("issue_order").cast("int").alias("pos"), F.concat_ws(
        " | ", "severity", "column", F.format_string("%d rows", "affected_rows"), "description").alias("line"))
    text = found
    for part in parts:
        text = text.unionByName(part)
    # a report has a few dozen lines: one window orders them
    return text.select(F.row_number().over(Window.orderBy("part", "pos")).alias("line_no"), "line")
