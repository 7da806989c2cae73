"""Profiles and monitoring: null profile, column profile, control-limit alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjord.functions.constants import ALERT_FALLBACK, BUSINESS_MAPPING, PII_COLUMNS, QUARANTINE_RULES, SCHEMA_HINTS
from fjord.functions.exprs import ident
from fjord.operators.landing import normalized_names


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """null_count and null_ratio per column (0.0 on an empty input).

    One aggregate pass computes every count (partial aggregation per task),
    then ``stack`` turns the single row into one row per column.
    """
    columns = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("__n"),
                    *[F.count_if(F.col(ident(c)).isNull()).alias(f"__c{i}") for i, c in enumerate(columns)])
    stack = ", ".join(f"{_sql_str(c)}, CAST({i} AS INT), __c{i}" for i, c in enumerate(columns))
    long = counts.selectExpr("__n", f"stack({len(columns)}, {stack}) AS (column_name, ordinal, null_count)")
    return long.select(
        "column_name", "ordinal", "null_count",
        F.when(F.col("__n") > 0, F.col("null_count") / F.col("__n")).otherwise(F.lit(0.0))
        .cast("double").alias("null_ratio"))


def _null_count_aggs(df: DataFrame) -> list[Column]:
    return [F.count(F.lit(1)).alias("record_count"),
            *[F.count_if(F.col(ident(c)).isNull()).alias(f"__c{i}") for i, c in enumerate(df.columns)]]


def _profile_rows(counts: DataFrame, cols: Sequence[str], hints: dict[str, str], pii: Sequence[str]) -> DataFrame:
    mapped = normalized_names(list(cols), {})
    rows = ", ".join(
        f"{_sql_str(c)}, CAST({i} AS INT), {_sql_str(mapped[c])}, {_sql_str(hints.get(c, 'string'))}, "
        f"{'true' if c in pii else 'false'}, __c{i}" for i, c in enumerate(cols))
    return counts.selectExpr(
        "record_count", f"CAST({len(cols)} AS INT) AS column_count",
        f"stack({len(cols)}, {rows}) AS (column_name, ordinal, mapped_name, schema_hint, is_pii, null_count)")


def column_profile(df: DataFrame, hints: dict[str, str] = SCHEMA_HINTS,
                   pii: Sequence[str] = PII_COLUMNS) -> DataFrame:
    """A7 + P13: one row per column with mapped name, hint, PII flag, counts.

    Schema facts (names, hints, PII) are per-column literals; the counts come
    from the same single aggregate pass over the data.
    """
    return _profile_rows(df.agg(*_null_count_aggs(df)), df.columns, hints, pii)


def profile_record(prof: DataFrame, dataset_path: str, environment: str,
                   rules: Sequence[str] = QUARANTINE_RULES, generated_by: str = "deterministic_fallback") -> DataFrame:
    """A7 + K7: the per-column profile folded into the one config record the landing stage reads.

    Fields as the reference's profile: dataset path, counts, column list, name
    mapping, PII columns, schema hints, quarantine rules, producer, environment.
    One row; its lists grow with the column count only.
    """
    c = F.array_sort(F.collect_list(F.struct("ordinal", "column_name", "mapped_name", "schema_hint", "is_pii")))
    folded = prof.agg(F.max("record_count").alias("record_count"), F.max("column_count").alias("column_count"),
                      c.alias("__c"))
    return folded.select(
        F.lit(dataset_path).alias("dataset_path"), "record_count", "column_count",
        F.transform("__c", lambda e: e["column_name"]).alias("columns"),
        F.map_from_entries(F.transform("__c", lambda e: F.struct(e["column_name"], e["mapped_name"])))
        .alias("mapped_columns"),
        F.transform(F.filter("__c", lambda e: e["is_pii"]), lambda e: e["column_name"]).alias("pii_columns"),
        F.map_from_entries(F.transform("__c", lambda e: F.struct(e["column_name"], e["schema_hint"])))
        .alias("schema_hints"),
        F.array(*[F.lit(r) for r in rules]).alias("quarantine_rules"),
        F.lit(generated_by).alias("generated_by"), F.lit(environment).alias("environment"))


def anomaly_flags(daily: DataFrame, value: str = "fraud_amount", sigmas: float = 2.0) -> DataFrame:
    """A8 + P16: threshold = mean + 2·sample std over all days; alert when above.

    The statistics are one global aggregate (partial per task) evaluated once
    as a scalar subquery — no join, no unpartitioned window. One day or none
    gives a NULL std, hence a NULL threshold and no alerts (SURVEY D11).
    """
    threshold = daily.agg((F.avg(value) + F.lit(sigmas) * F.stddev_samp(value)).alias("threshold")).scalar()
    return (daily.withColumn("threshold", threshold)
                 .withColumn("alert", F.coalesce(F.col(value) > F.col("threshold"), F.lit(False))))


def alert_payload(flags: DataFrame, value: str = "fraud_amount", key: str = "tr_date") -> DataFrame:
    """A9 + R5: threshold, alert_count, the flagged days and the summary.

    ``executive_summary`` is the reference's deterministic (no-LLM) text,
    emitted as it does whatever the count; ``alert_detail`` states the facts.
    Flagged days are listed as sorted ``day=amount`` text so the payload is
    order-independent; the list holds only alert days (bounded by the calendar).
    """
    item = F.concat(F.date_format(key, "yyyy-MM-dd"), F.lit("="), F.col(value).cast("decimal(38,2)").cast("string"))
    agg = flags.agg(
        F.max("threshold").alias("threshold"),
        F.count_if("alert").alias("alert_count"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("alert"), item))), ";").alias("flagged_days"),
    )
    return agg.withColumn("executive_summary", F.lit(ALERT_FALLBACK)).withColumn(
        "alert_detail",
        F.when(F.col("alert_count") > 0,
               F.format_string("Fraud amount breached the control limit of %s on %d day(s): %s.",
                               F.col("threshold").cast("decimal(38,2)").cast("string"),
                               F.col("alert_count"), F.col("flagged_days")))
        .otherwise(F.lit("No day breached the fraud control limit.")))


def alert_report(flags: DataFrame, key: str = "tr_date") -> DataFrame:
    """A9 as one record: threshold, alert_count, the flagged rows in full (sorted by day) and the summary."""
    row = F.struct(key, *[F.col(ident(c)) for c in flags.columns if c != key])
    return flags.agg(F.max("threshold").alias("threshold"), F.count_if("alert").alias("alert_count"),
                     F.array_sort(F.collect_list(F.when(F.col("alert"), row))).alias("alerts")) \
        .withColumn("executive_summary", F.lit(ALERT_FALLBACK))


def class_weight(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Class counts and the positive weight negatives / max(positives, 1)."""
    agg = df.agg(F.count_if(F.col(label) == 0).alias("negatives"),
                 F.count_if(F.col(label) == 1).alias("positives"))
    return agg.withColumn("scale_pos_weight",
                          (F.col("negatives") / F.greatest(F.col("positives"), F.lit(1))).cast("double"))


_INT_TEXT = r"^-?[0-9]+$"


def _hint_aggs(df: DataFrame) -> list[Column]:
    """Per column: the first of integer / bigint / double / timestamp every non-NULL text value parses as, else ''."""
    types = dict(df.dtypes)
    aggs = []
    for i, c in enumerate(df.columns):
        x = F.col(ident(c))
        if types[c] != "string":
            aggs.append(F.lit("").alias(f"__h{i}"))
            continue

        def every(ok, x=x):
            return F.count_if(x.isNotNull() & ~F.coalesce(ok, F.lit(False))) == 0

        aggs.append(F.when(F.count(x) == 0, F.lit(""))
                    .when(every(x.rlike(_INT_TEXT) & x.try_cast("int").isNotNull()), F.lit("integer"))
                    .when(every(x.rlike(_INT_TEXT) & x.try_cast("bigint").isNotNull()), F.lit("bigint"))
                    .when(every(x.rlike(_INT_TEXT)), F.lit(""))  # longer whole numbers stay text: a double loses digits
                    .when(every(x.try_cast("double").isNotNull()), F.lit("double"))
                    .when(every(x.try_cast("timestamp").isNotNull()), F.lit("timestamp"))
                    .otherwise(F.lit("")).alias(f"__h{i}"))
    return aggs


def profile_with_candidate(df: DataFrame, hints: dict[str, str] = SCHEMA_HINTS, pii: Sequence[str] = PII_COLUMNS,
                           business: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``column_profile`` and a candidate profile derived from the data, from ONE aggregate pass.

    The candidate's ``mapped_name`` is the business name when one exists, else
    empty; its ``schema_hint`` is the first type that *every* non-NULL value
    of a text column parses as, else empty. Empty fields never override (F15).


    Both are projections of one stacked frame over one aggregate (the stack
    uses every aggregate output, so column pruning cannot split it): the plan
    scans the input once and the second branch reuses the first one's exchange.
    """
    business = BUSINESS_MAPPING if business is None else business
    cols = df.columns
    one = df.agg(*_null_count_aggs(df), *_hint_aggs(df))
    mapped = normalized_names(list(cols), {})
    rows = ", ".join(
        f"record_count, {_sql_str(c)}, CAST({i} AS INT), {_sql_str(mapped[c])}, {_sql_str(hints.get(c, 'string'))}, "
        f"{'true' if c in pii else 'false'}, __c{i}, {_sql_str(business.get(mapped[c], ''))}, __h{i}"
        for i, c in enumerate(cols))
    both = one.selectExpr(
        f"CAST({len(cols)} AS INT) AS column_count",
        f"stack({len(cols)}, {rows}) AS (record_count, column_name, ordinal, mapped_name, schema_hint, is_pii, "
        "null_count, cand_mapped_name, cand_schema_hint)")
    base = both.select("record_count", "column_count", "column_name", "ordinal", "mapped_name", "schema_hint",
                       "is_pii", "null_count")
    candidate = both.select("column_name", F.col("cand_mapped_name").alias("mapped_name"),
                            F.col("cand_schema_hint").alias("schema_hint"))
    return base, candidate


def override_profile(base: DataFrame, candidate: DataFrame, key: str = "column_name") -> DataFrame:
    """a candidate profile's non-empty fields override the base profile's.

    Joined per column (both sides one row per column); an empty or NULL
    candidate value keeps the base value. Columns only in the base pass through.
    """
    fields = [c for c in base.columns if c != key and c in candidate.columns]
    c = candidate.select(F.col(key).alias("__k"), *[F.col(f).alias(f"__c_{f}") for f in fields])
    j = base.join(c, base[key] == c["__k"], "left")

    def pick(f):
        cand = F.col(f"__c_{f}")
        if dict(candidate.dtypes)[f] == "string":
            cand = F.nullif(F.trim(cand), F.lit(""))
        return F.coalesce(cand.cast(dict(base.dtypes)[f]), F.col(f)).alias(f)

    return j.select(*[pick(f) if f in fields else F.col(f) for f in base.columns])
