"""Dimension builds: members, surrogate keys, unknown rows, type 1 changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.measures import change_hash
from ledgerlake.functions.ordinals import dense_ordinal
from ledgerlake.operators.growth import merge_on_read
from ledgerlake.operators.enrich import date_key
from ledgerlake.schemas import DIM_SCHEMAS, OPEN_END, UNKNOWN_KEY
from ledgerlake.session import stage

# Member kind -> (dimension, key column, name column).
REFERENCE_DIMS = {
    "currency": ("dim_currency", "currency_key", "currency_name"),
    "format": ("dim_payment_format", "payment_format_key", "payment_format"),
    "pattern": ("dim_pattern_type", "pattern_type_key", "pattern_type"),
}

# The unknown member of every dimension.
_UNKNOWN_SQL = {
    "dim_date": "-1, date'1900-01-01', 1, 1, 'Unknown', 1, 1, 'Unknown', 1, 1900, false",
    "dim_time": "-1, '00:00:59', 0, 0, 'Unknown'",
    "dim_currency": "-1, 'Unknown'",
    "dim_payment_format": "-1, 'Unknown'",
    "dim_pattern_type": "-1, 'Unknown'",
    "dim_bank": "-1, '~UNKNOWN', 'Unknown', md5('Unknown')",
    "dim_entity": "-1, '~UNKNOWN', 'Unknown', md5('Unknown')",
    "dim_account": "-1, -1, -1, '~UNKNOWN', '~UNKNOWN', null, md5('Unknown'), "
    f"timestamp_ntz'1900-01-01 00:00:00', timestamp_ntz'{OPEN_END}', true",
}


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select and cast to a declared schema."""
    return df.selectExpr(
        *[f"cast({spec.split()[0]} as {spec.split(' ', 1)[1]}) as {spec.split()[0]}" for spec in ddl_fields(ddl)]
    )


def ddl_fields(ddl: str) -> list[str]:
    """Split a flat schema string at the commas outside parentheses."""
    fields, depth, start = [], 0, 0
    for at, char in enumerate(ddl):
        depth += (char == "(") - (char == ")")
        if char == "," and depth == 0:
            fields.append(ddl[start:at].strip())
            start = at + 1
    return [*fields, ddl[start:].strip()]


def unknown_member(spark: SparkSession, dim: str) -> DataFrame:
    names = [spec.split()[0] for spec in ddl_fields(DIM_SCHEMAS[dim])]
    row = spark.sql(f"select {_UNKNOWN_SQL[dim]}").toDF(*names)
    return conform(row, DIM_SCHEMAS[dim])


def reference_members(transactions: DataFrame, patterns: DataFrame) -> DataFrame:
    """Distinct (kind, value) members of the date, currency, format and pattern domains.

    One scan per source: rows collapse to distinct combinations on the map side
    first, and only those few combinations are unpivoted.
    """
    day = F.to_date("transaction_timestamp").alias("day")
    shared = [day, "payment_currency", "receiving_currency", "payment_format"]
    no_type = F.lit(None).cast("string").alias("pattern_type")
    combos = (
        transactions.select(*shared, no_type)
        .distinct()
        .unionByName(patterns.select(*shared, "pattern_type").distinct())
    )
    members = [
        ("date", F.col("day").cast("string")),
        ("currency", F.col("payment_currency")),
        ("currency", F.col("receiving_currency")),
        ("format", F.col("payment_format")),
        ("pattern", F.col("pattern_type")),
    ]
    pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), value.alias("value")) for kind, value in members])
    return combos.select(F.inline(pairs)).where("value is not null").distinct()


def date_dimension(days: DataFrame) -> DataFrame:
    """Calendar attributes for a frame with one ``full_date`` column."""
    day = F.col("full_date")
    iso_day = F.weekday(day) + 1
    rows = days.select(
        date_key("full_date").alias("date_key"),
        "full_date",
        F.dayofmonth(day).alias("day_of_month"),
        iso_day.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter_number"),
        F.year(day).alias("year_number"),
        (iso_day >= 6).alias("is_weekend"),
    )
    return conform(rows, DIM_SCHEMAS["dim_date"])


def time_dimension(spark: SparkSession) -> DataFrame:
    """All 1,440 minutes of a day."""
    rows = spark.range(1440).selectExpr(
        "(id div 60) * 100 + id % 60 as time_key",
        "concat(lpad(cast(id div 60 as string), 2, '0'), ':', lpad(cast(id % 60 as string), 2, '0'), ':00')"
        " as time_value",
        "id div 60 as hour_number",
        "id % 60 as minute_number",
        "case when id div 60 between 5 and 11 then 'Morning'"
        " when id div 60 between 12 and 16 then 'Afternoon'"
        " when id div 60 between 17 and 21 then 'Evening' else 'Night' end as day_part",
    )
    return conform(rows, DIM_SCHEMAS["dim_time"])


def next_key(dim: DataFrame, key: str) -> int:
    """Largest key handed out so far."""
    return max(int(dim.agg(F.max(key)).first()[0] or 0), 0)


def with_surrogate_keys(rows: DataFrame, business_key: list[str], key: str, after: int) -> DataFrame:
    """Keys after+1.. in business key order; keys handed out earlier never move."""
    return dense_ordinal(rows, business_key, name=key).withColumn(key, F.col(key) + after)


def new_reference_rows(members: DataFrame, current: dict[str, DataFrame]) -> DataFrame | None:
    """(kind, value, key) of members the reference dimensions do not hold yet, None if there are none."""
    known = None
    for kind, (dim, key, name) in REFERENCE_DIMS.items():
        held = current[dim].select(
            F.lit(kind).alias("kind"), F.col(name).alias("value"), F.col(key).cast("long").alias("key")
        )
        known = held if known is None else known.unionByName(held)
    wanted = members.where(F.col("kind").isin(*REFERENCE_DIMS))
    fresh = stage(wanted.join(known, ["kind", "value"], "left_anti"), "fresh")
    if fresh.isEmpty():
        return None
    top = known.groupBy("kind").agg(F.greatest(F.max("key"), F.lit(0)).alias("top"))
    numbered = dense_ordinal(fresh, ["value"], within=("kind",), name="place")
    # One row per kind of member: three in all.
    return stage(
        numbered.join(F.broadcast(top), "kind").select("kind", "value", (F.col("place") + F.col("top")).alias("key")),
        "reference",
    )


def bank_source(accounts: DataFrame) -> DataFrame:
    grouped = accounts.groupBy("bank_id").agg(F.min("bank_name").alias("bank_name"))
    return grouped.withColumn("source_hash", change_hash(F.col("bank_id"), F.col("bank_name")))


def entity_source(accounts: DataFrame) -> DataFrame:
    grouped = (
        accounts.where("entity_id is not null")
        .groupBy("entity_id")
        .agg(F.min("entity_name").alias("entity_name"))
    )
    name = F.coalesce("entity_name", F.lit(""))
    return grouped.withColumn("source_hash", change_hash(F.col("entity_id"), name))


def type1_changes(current: DataFrame, incoming: DataFrame, business_key: str, key: str) -> DataFrame:
    """Incoming rows that are new (key is NULL) or whose hash differs from the held row."""
    held = current.select(business_key, key, F.col("source_hash").alias("held_hash"))
    return (
        incoming.join(held, business_key, "left")
        .where("held_hash is null or held_hash <> source_hash")
        .drop("held_hash")
    )


def type1_delta(
    current: DataFrame, incoming: DataFrame, business_key: str, key: str, held: DataFrame | None = None
) -> tuple[DataFrame | None, int]:
    """The overwritten and added rows of a type 1 upsert and their number; None if there are none.

    ``held`` may name the part of ``current`` that ``incoming`` can touch.
    """
    changes = stage(type1_changes(current if held is None else held, incoming, business_key, key), "type1")
    touched = changes.count()
    if touched == 0:
        return None, 0
    columns = current.columns
    overwritten = changes.where(F.col(key).isNotNull())
    added = with_surrogate_keys(
        changes.where(F.col(key).isNull()).drop(key), [business_key], key, next_key(current, key)
    )
    return overwritten.select(columns).unionByName(added.select(columns)), touched


def type1_merge(current: DataFrame, incoming: DataFrame, business_key: str, key: str) -> tuple[DataFrame, int]:
    """Type 1 upsert. Returns the merged dimension and the number of rows touched."""
    delta, touched = type1_delta(current, incoming, business_key, key)
    return (current, 0) if delta is None else (merge_on_read(current, [delta], key), touched)


def bank_directory(accounts: DataFrame) -> DataFrame:
    """Source view of banks; takes the largest name where the warehouse takes the smallest."""
    return accounts.groupBy("bank_id").agg(
        F.max("bank_name").alias("bank_name"), F.count("*").alias("account_count")
    )
