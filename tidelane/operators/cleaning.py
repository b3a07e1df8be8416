"""From raw text lines to clean, typed, unique order lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelane.params import DEFAULTS, Params
from tidelane.schema import (
    COLUMN_NAMES,
    COUNT_COLUMNS,
    DATE_COLUMNS,
    DAY_FIRST,
    DAY_READING,
    DEFAULT_TEXT,
    DEFAULT_ZERO,
    MALFORMED,
    LONG_COLUMNS,
    MONEY,
    MONEY_COLUMNS,
    MONTH_FIRST,
    PII_COLUMNS,
    RATE,
    SET_FLAGS,
    SOURCE_POSITION,
    VITAL_NUMBERS,
    YEAR_FIRST,
)

REJECTED = "_unreadable"
REASONS = "_reasons"


def drop_pii(df: DataFrame) -> DataFrame:
    return df.drop(*PII_COLUMNS)


def standardize_columns(df: DataFrame) -> DataFrame:
    present = {raw: name for raw, name in COLUMN_NAMES.items() if raw in df.columns}
    targets = [present.get(c, c) for c in df.columns]
    doubled = sorted({t for t in targets if targets.count(t) > 1})
    if doubled:
        raise ValueError(f"several source columns for {', '.join(doubled)}")
    return df.toDF(*targets)


def _timestamp(c: Column, slashed: list[str]) -> Column:
    text = F.trim(c)
    tried = lambda layouts: F.coalesce(*[F.try_to_timestamp(text, F.lit(layout)) for layout in layouts])
    return F.when(_has_slash(c), tried(slashed)).otherwise(tried(YEAR_FIRST)).cast("timestamp_ntz")


def _has_slash(c: Column) -> Column:
    return F.contains(c, F.lit("/"))


def _text_dates(df: DataFrame) -> list[str]:
    return [c for c in DATE_COLUMNS if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]


def parse_timestamps(df: DataFrame, both: bool = False) -> DataFrame:
    """Text dates to timestamps without zone; what no layout fits becomes null. Dates with slashes are read with the month first.
    With ``both`` a struct column has their reading with the day first, for ``settle_dates``."""
    texts = _text_dates(df)
    parsed = {c: _timestamp(F.col(c), MONTH_FIRST) for c in texts}
    if both:
        others = [F.when(_has_slash(F.col(c)), F.struct(_timestamp(F.col(c), DAY_FIRST).alias("at"))).alias(c) for c in texts]
        parsed[DAY_READING] = F.struct(*others)
    return df.withColumns(parsed) if texts else df


def _file(df: DataFrame) -> Column:
    return F.col(f"{SOURCE_POSITION}.file") if SOURCE_POSITION in df.columns else F.lit("")


def date_layouts(lines: DataFrame) -> DataFrame:
    """The vote on dates with slashes, one row per file and date column: how many have only a reading with the month first, only one with
    the day first, two that differ (``ambiguous``) or none, and the ``layout`` that the first two
    decide. A tie is read with the month first."""
    columns = [f.name for f in lines.schema[DAY_READING].dataType.fields]
    counts = []
    for c in columns:
        day, month = F.col(f"{DAY_READING}.{c}"), F.col(c)
        slashed, other = day.isNotNull(), day["at"]
        counts += [
            F.count_if(slashed).alias(f"{c}_slashed"),
            F.count_if(slashed & month.isNotNull() & other.isNull()).alias(f"{c}_month"),
            F.count_if(slashed & month.isNull() & other.isNotNull()).alias(f"{c}_day"),
            F.count_if(slashed & (month != other)).alias(f"{c}_ambiguous"),
            F.count_if(slashed & month.isNull() & other.isNull()).alias(f"{c}_unread"),
        ]
    counted = lines.groupBy(_file(lines).alias("file")).agg(*counts)
    names = {"slashed": "slashed_dates", "month": "month_first_only", "day": "day_first_only", "ambiguous": "ambiguous", "unread": "unreadable"}
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}_{k}").alias(n) for k, n in names.items()]) for c in columns])
    layout = F.when(F.col("day_first_only") > F.col("month_first_only"), "day first").otherwise("month first")
    share = F.try_divide(F.col("ambiguous").cast("double"), F.col("slashed_dates"))
    return counted.select("file", F.inline(rows)).withColumns({"layout": layout, "ambiguous_share": share})


def settle_dates(lines: DataFrame, layouts: DataFrame) -> DataFrame:
    """One layout per file and date column: the reading that the vote decided. A date that does not fit it becomes null."""
    columns = [f.name for f in lines.schema[DAY_READING].dataType.fields]
    turned = layouts.where("layout = 'day first'").groupBy("file").agg(F.collect_set("column_name").alias("_turned"))
    joined = lines.withColumn("_file", _file(lines)).join(turned.withColumnRenamed("file", "_file"), "_file", "left")
    chosen = {}
    for c in columns:
        day = F.col(f"{DAY_READING}.{c}")
        turn = F.coalesce(F.array_contains("_turned", c), F.lit(False)) & day.isNotNull()
        chosen[c] = F.when(turn, day["at"]).otherwise(F.col(c))
    return joined.withColumns(chosen).select(*[c for c in lines.columns if c != DAY_READING])


def dedupe_order_items(df: DataFrame, order_by: list[Column] | None = None) -> DataFrame:
    """First copy of each order line, by ``order_by`` (default: position in the source).

    The filter on the row number lets Spark keep one row per key and task before the shuffle,
    so many copies of one line never meet in one task. Lines without a key are no copies of
    each other: each is a group of its own, so all are kept and they spread over the tasks.
    """
    order = order_by or [F.col(SOURCE_POSITION)]
    alone = F.when(F.col("order_item_id").isNull(), F.monotonically_increasing_id())
    w = W.partitionBy("order_item_id", "_alone").orderBy(*order)
    numbered = df.withColumn("_alone", alone).withColumn("_copy", F.row_number().over(w))
    return numbered.where("_copy = 1").drop("_copy", "_alone")


def impute_defaults(df: DataFrame) -> DataFrame:
    texts = {c: v for c, v in DEFAULT_TEXT.items() if c in df.columns}
    df = df.fillna(texts) if texts else df
    zeros = [c for c in DEFAULT_ZERO if c in df.columns]
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in zeros}
    ) if zeros else df


def _at_least(c: str, low, kind: T.DataType | str) -> Column:
    floor = F.lit(low).cast(kind)
    return F.greatest(floor, F.coalesce(F.col(c).cast(kind), floor))


def clamp_domains(df: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Lower bounds of quantity, price, sales and days; a missing value takes the bound.
    Fractions of counts are cut off."""
    return df.withColumns(
        {
            "quantity_ordered": _at_least("quantity_ordered", 1, "int"),
            "product_price": _at_least("product_price", 0.01, df.schema["product_price"].dataType),
            "sales_amount": _at_least("sales_amount", 0, df.schema["sales_amount"].dataType),
            "days_real": _at_least("days_real", 0, "int"),
            "days_scheduled": _at_least("days_scheduled", params.min_scheduled_days, "int"),
        }
    )


def add_delay_days(df: DataFrame) -> DataFrame:
    return df.withColumn("delay_days", F.col("days_real") - F.col("days_scheduled"))


def normalize_risk_flag(df: DataFrame) -> DataFrame:
    """1 for a value of one (number, true, or a text that says so), else 0."""
    c = F.col("late_delivery_risk")
    kind = df.schema["late_delivery_risk"].dataType
    if isinstance(kind, T.StringType):
        one = F.lower(F.trim(c)).isin(SET_FLAGS)
    elif isinstance(kind, T.BooleanType):
        one = c
    else:
        one = c == 1
    return df.withColumn("late_delivery_risk", F.when(one, 1).otherwise(0))


def _whole(c: Column) -> Column:
    """A whole number written with a fraction of zero; not by way of double, which would lose digits."""
    exact = c.try_cast("decimal(38,10)")
    return F.when(exact == F.floor(exact), exact.try_cast("bigint"))


def _number(text: Column) -> Column:
    """Whether a text is a finite number, whatever its size."""
    x = text.try_cast("double")
    return F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))


def type_columns(df: DataFrame) -> DataFrame:
    """Cast the text columns of standardized lines; the risk flag stays text. Names of vital columns whose text
    could not be read, and of amounts that are too large, are collected in one array column, and in another
    what is wrong with which text. A malformed record's key is not to be trusted, so it has none."""
    kinds: dict[str, Column] = {}
    for c in LONG_COLUMNS:
        kinds[c] = F.coalesce(F.col(c).try_cast("bigint"), _whole(F.col(c)))
    for c in COUNT_COLUMNS:
        kinds[c] = F.col(c).try_cast("double").try_cast("int")
    for c in MONEY_COLUMNS:
        kinds[c] = F.col(c).try_cast(MONEY)
    kinds["discount_rate"] = F.col("discount_rate").try_cast(RATE)
    for c in ("profit_ratio", "latitude", "longitude"):
        kinds[c] = F.col(c).try_cast("double")
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    casts = {c: cast for c, cast in kinds.items() if c in texts}
    broken = F.col(MALFORMED).isNotNull() if MALFORMED in df.columns else F.lit(False)
    failed = {c: F.col(c).isNotNull() & casts[c].isNull() for c in casts if c in VITAL_NUMBERS}
    failed |= {
        c: F.col(c).isNotNull() & casts[c].isNull() & _number(F.col(c))
        for c in casts
        if c in MONEY_COLUMNS and c not in failed
    }
    named = [F.when(condition, F.lit(c)) for c, condition in failed.items()]
    names = F.array_compact(F.array(*named, F.when(broken, F.lit(MALFORMED))))
    # the texts are put together for rejected lines only
    texts_by_name = [
        F.struct(F.lit(c).alias("name"), F.when(condition, F.col(c)).alias("text")) for c, condition in failed.items()
    ]

    def said(x: Column) -> Column:
        fault = (
            F.when(~_number(x["text"]), "not a number")
            .when(x["name"].isin(LONG_COLUMNS), "not a whole number of 64 bits")
            .otherwise("too large")
        )
        return F.concat_ws(": ", x["name"], fault, x["text"])

    none = F.array().cast("array<string>")
    numbers = F.transform(F.filter(F.array(*texts_by_name), lambda x: x["text"].isNotNull()), said) if failed else none
    reasons = F.when(
        F.size(names) > 0, F.concat(numbers, F.when(broken, F.array(F.lit("malformed record"))).otherwise(none))
    ).otherwise(none)
    if MALFORMED in df.columns:
        casts["order_item_id"] = F.when(~broken, casts.get("order_item_id", F.col("order_item_id")))
    return df.select(
        *[casts[c].alias(c) if c in casts else F.col(f"`{c}`") for c in df.columns],
        names.alias(REJECTED),
        reasons.alias(REASONS),
    )


def typed_lines(raw: DataFrame, both: bool = False) -> DataFrame:
    """Raw lines to typed lines, copies included; with ``both`` readings of dates that ``settle_dates`` has to choose from."""
    return type_columns(parse_timestamps(standardize_columns(drop_pii(raw)), both))


def stage_lines(raw: DataFrame, order_by: list[Column] | None = None) -> DataFrame:
    """Raw lines to typed unique lines, before defaults and bounds."""
    return dedupe_order_items(typed_lines(raw), order_by)


def _usable() -> Column:
    keys = ["order_item_id", "order_id", "product_id", "customer_id", "order_date"]
    has_keys = F.lit(True)
    for c in keys:
        has_keys = has_keys & F.col(c).isNotNull()
    return has_keys & (F.size(REJECTED) == 0)


def rejected_lines(staged: DataFrame) -> DataFrame:
    """Malformed records, lines without a key or an order date, or with a number that cannot be read or held. Texts that
    were not read are in ``_reasons``, the text of a malformed record in ``_corrupt_record``."""
    return staged.where(~_usable())


def clean_lines(staged: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Defaults, bounds, delay and flag for the usable lines."""
    usable = staged.where(_usable()).drop(REJECTED, REASONS, MALFORMED)
    return normalize_risk_flag(add_delay_days(clamp_domains(impute_defaults(usable), params)))


def etl_audit(
    raw: DataFrame, clean: DataFrame, rejected: DataFrame, raw_columns: list[str] | None = None, rows: Column | None = None
) -> DataFrame:
    """One row: rows before and after, rejected rows, columns kept, columns dropped. ``raw_columns`` names the columns
    of the raw lines if ``raw`` is a stored form of them, and ``rows`` sums their number if it is made of counts."""
    spark = raw.sparkSession
    kept = [c for c in clean.columns if not c.startswith("_")]
    return spark.range(1).select(
        raw.agg(F.count("*") if rows is None else F.coalesce(rows, F.lit(0).cast("long"))).scalar().alias("initial_rows"),
        clean.agg(F.count("*")).scalar().alias("cleaned_rows"),
        rejected.agg(F.count("*")).scalar().alias("rejected_rows"),
        F.lit(len(kept)).alias("columns_retained"),
        F.lit(len([c for c in PII_COLUMNS if c in (raw_columns or raw.columns)])).alias("dropped_columns"),
    )
