"""Reconciliation between source and warehouse, and integrity of the reporting layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.measures import total
from ledgerlake.operators import enrich
from ledgerlake.operators.facts import NON_POSITIVE, TRANSACTION_LOOKUP_KEYS, any_unknown, positive_amounts
from ledgerlake.operators.held import bit_of, word_of
from ledgerlake.schemas import MONEY_TOTAL, UNKNOWN_KEY
from ledgerlake.session import run_together, stage

# Fixed values of the specification.
# (from table, from column, to table, to column): one to many, filters flow to the right.
RELATIONSHIPS = [
    ("dim_date", "date_key", "fact_daily_transaction", "date_key"),
    ("dim_payment_currency", "payment_currency_key", "fact_daily_transaction", "payment_currency_key"),
    ("dim_payment_format", "payment_format_key", "fact_daily_transaction", "payment_format_key"),
    ("dim_payment_format", "payment_format_key", "fact_aml_payment_format", "payment_format_key"),
    ("dim_bank", "bank_key", "fact_bank_activity", "bank_key"),
    ("dim_bank", "bank_key", "fact_aml_account_risk", "bank_key"),
    ("dim_payment_currency", "payment_currency_key", "fact_currency_flow", "payment_currency_key"),
    ("dim_receiving_currency", "receiving_currency_key", "fact_currency_flow", "receiving_currency_key"),
    ("dim_pattern_type", "pattern_type_key", "fact_pattern_summary", "pattern_type_key"),
    ("etl_batch_monitor", "dw_batch_id", "etl_validation_result", "dw_batch_id"),
]
# Orphan check -> the relationship it tests.
ORPHAN_CHECKS = {
    "daily_missing_date": 0,
    "daily_missing_payment_currency": 1,
    "daily_missing_payment_format": 2,
    "currency_flow_missing_payment_currency": 6,
    "currency_flow_missing_receiving_currency": 7,
    "bank_activity_missing_bank": 4,
    "account_risk_missing_bank": 5,
    "pattern_missing_type": 8,
}


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _source_measures() -> list[Column]:
    """Over the rows the fact admits; ``source_refused`` counts the others."""
    admitted = positive_amounts()
    when = lambda condition: count_where(admitted & condition)
    return [
        count_where(admitted).alias("source_rows"),
        when(F.col("is_laundering")).alias("source_laundering"),
        when(enrich.cross_bank()).alias("source_cross_bank"),
        when(enrich.cross_currency()).alias("source_cross_currency"),
        when(enrich.self_transfer()).alias("source_self_transfer"),
        (F.count("*") - count_where(admitted)).alias("source_refused"),
        F.to_date(F.min("transaction_timestamp")).alias("source_min_date"),
        F.to_date(F.max("transaction_timestamp")).alias("source_max_date"),
    ]


def _fact_measures() -> list[Column]:
    lookups = any_unknown(TRANSACTION_LOOKUP_KEYS)
    with_entities = any_unknown([*TRANSACTION_LOOKUP_KEYS, "from_entity_key", "to_entity_key"])
    return [
        F.count("*").alias("fact_rows"),
        count_where(F.col("is_laundering")).alias("fact_laundering"),
        count_where(F.col("is_cross_bank")).alias("fact_cross_bank"),
        count_where(F.col("is_cross_currency")).alias("fact_cross_currency"),
        count_where(F.col("is_self_transfer")).alias("fact_self_transfer"),
        count_where((F.col("amount_paid") <= 0) | (F.col("amount_received") <= 0)).alias("fact_bad_amount"),
        count_where(lookups).alias("fact_unknown_lookup"),
        count_where(with_entities).alias("fact_unknown_any"),
    ]


def source_totals(transactions: DataFrame) -> DataFrame:
    """One scan, every count the checks need."""
    return transactions.agg(*_source_measures())


def fact_totals(fact: DataFrame) -> DataFrame:
    return fact.agg(*_fact_measures())


def _summed(by_currency: DataFrame, side: str) -> DataFrame:
    """Totals out of one row per currency."""
    names = [c for c in by_currency.columns if c.startswith(side) and not c.endswith("_date")]
    return by_currency.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])


def source_by_currency(transactions: DataFrame, *also: str) -> DataFrame:
    paid = total(F.when(positive_amounts(), F.col("amount_paid")))
    return transactions.groupBy(F.col("payment_currency").alias("currency_name"), *also).agg(*_source_measures(), paid.alias("total_amount"))


def fact_by_currency(fact: DataFrame) -> DataFrame:
    return fact.groupBy(F.col("payment_currency_key").alias("currency_key")).agg(*_fact_measures(), total("amount_paid").alias("total_amount"))


def added_up(parts: DataFrame, key: str) -> DataFrame:
    """Totals of several scans as one row per currency."""

    def one(name: str) -> Column:
        if name.endswith("_date"):
            return F.min(name) if name.endswith("min_date") else F.max(name)
        return total(name) if name == "total_amount" else F.sum(name)

    return parts.groupBy(key).agg(*[one(c).alias(c) for c in parts.columns if c != key])


def _amounts_of_source(by_currency: DataFrame) -> DataFrame:
    admitted = by_currency.where("source_rows > 0")
    return admitted.select("currency_name", F.col("source_rows").alias("row_count"), "total_amount")


def _amounts_of_fact(by_currency: DataFrame, dim_currency: DataFrame) -> DataFrame:
    named = by_currency.join(dim_currency, "currency_key")
    return named.select("currency_name", F.col("fact_rows").alias("row_count"), "total_amount")


def _currencies_compared(source: DataFrame, fact: DataFrame, dim_currency: DataFrame) -> DataFrame:
    sides = _amounts_of_source(source), _amounts_of_fact(fact, dim_currency)
    return compare_by_key(*sides, ["currency_name"], ["row_count", "total_amount"])


def compare_by_key(left: DataFrame, right: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Full outer comparison; ``matches`` is null-safe over every value."""
    l = left.select(*keys, *[F.col(v).alias(f"source_{v}") for v in values])
    r = right.select(*keys, *[F.col(v).alias(f"target_{v}") for v in values])
    same = F.lit(True)
    for v in values:
        same = same & F.col(f"source_{v}").eqNullSafe(F.col(f"target_{v}"))
    return l.join(r, keys, "full").withColumn("matches", same)


def currency_recon(transactions: DataFrame, fact: DataFrame, dim_currency: DataFrame) -> DataFrame:
    return _currencies_compared(source_by_currency(transactions), fact_by_currency(fact), dim_currency)


def current_accounts(dim_account: DataFrame) -> DataFrame:
    return dim_account.where(F.col("is_current") & (F.col("account_key") != UNKNOWN_KEY))


def warehouse_checks(
    transactions: DataFrame,
    patterns: DataFrame,
    accounts: DataFrame,
    fact: DataFrame,
    fact_pattern: DataFrame,
    dim_account: DataFrame,
    dim_currency: DataFrame,
    rejected: DataFrame,
    totals: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """The nine source-to-warehouse checks, one row each. Only one-row frames meet in the cross joins.

    Source and fact are scanned once each, down to one row per payment currency. The fact must
    hold what the source has, without the amounts it refused; every refused one is a reject.
    ``totals`` are the rows per currency of both sides where they are known; neither is scanned then.
    """
    source, loaded = totals or run_together(
        transactions.sparkSession,
        [lambda: stage(source_by_currency(transactions), "recon"), lambda: stage(fact_by_currency(fact), "recon")],
    )
    mismatch = _currencies_compared(source, loaded, dim_currency).where("not matches")
    refused = rejected.where(F.col("error_code") == NON_POSITIVE)
    sides = (
        _summed(source, "source_")
        .crossJoin(_summed(loaded, "fact_"))
        .crossJoin(refused.agg(F.count("*").alias("refused")))
        .withColumns({"source_all": F.col("source_rows") + F.col("source_refused"), "fact_all": F.col("fact_rows") + F.col("refused")})
        .crossJoin(patterns.agg(F.count("*").alias("source_patterns")))
        .crossJoin(fact_pattern.agg(F.count("*").alias("fact_patterns")))
        .crossJoin(accounts.agg(F.count("*").alias("source_accounts")))
        .crossJoin(current_accounts(dim_account).agg(F.count("*").alias("fact_accounts")))
        .crossJoin(mismatch.agg(F.count("*").alias("currency_mismatches")))
        .withColumn("nothing", F.lit(0))
    )
    checks = [
        ("TRANSACTION_ROW_COUNT", "source_all", "fact_all", "one source transfer is one fact row"),
        ("PATTERN_ROW_COUNT", "source_patterns", "fact_patterns", "one pattern transfer is one pattern fact row"),
        ("CURRENT_ACCOUNT_COUNT", "source_accounts", "fact_accounts", "the unknown account is not counted"),
        ("LAUNDERING_COUNT", "source_laundering", "fact_laundering", "the label is carried over unchanged"),
        ("CROSS_BANK_COUNT", "source_cross_bank", "fact_cross_bank", "sender and receiver bank differ"),
        ("CROSS_CURRENCY_COUNT", "source_cross_currency", "fact_cross_currency", "paid and received currency differ"),
        ("SELF_TRANSFER_COUNT", "source_self_transfer", "fact_self_transfer", "same bank and same account"),
        ("UNKNOWN_DIMENSION_LOOKUP", "nothing", "fact_unknown_lookup", "no fact row may use an unknown key"),
        (
            "PAYMENT_AMOUNT_BY_CURRENCY",
            "nothing",
            "currency_mismatches",
            "rows and paid totals agree for each currency",
        ),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(place).cast("long").alias("position"),
                F.lit(name).alias("check_name"),
                F.col(source).cast(MONEY_TOTAL).alias("source_value"),
                F.col(target).cast(MONEY_TOTAL).alias("target_value"),
                F.lit(details).alias("details"),
            )
            for place, (name, source, target, details) in enumerate(checks, start=1)
        ]
    )
    passed = F.when(F.col("source_value") == F.col("target_value"), "PASSED").otherwise("FAILED")
    return sides.select(F.inline(rows)).withColumn("status", passed)


def duplicate_groups(df: DataFrame, keys: list[str], check_name: str) -> DataFrame:
    repeated = df.groupBy(*keys).count().where("count > 1")
    return repeated.agg(F.lit(check_name).alias("check_name"), F.count("*").alias("error_count"))


def repeated_numbers(df: DataFrame, key: str, check_name: str) -> DataFrame:
    """How many values of a whole-number key occur more than once, without shuffling the rows.

    Each task turns its keys into words of 64 neighbouring numbers. A word whose rows are
    as many as its set bits holds no repeat; only rows of the other words are grouped by key,
    and where there are none, adaptive execution drops that scan.
    """
    numbers = df.select(F.col(key).cast("long").alias("_key"), word_of(F.col(key)).alias("_bucket"), bit_of(key).alias("_bit"))
    buckets = numbers.groupBy("_bucket").agg(F.count("*").alias("_rows"), F.bit_count(F.bit_or("_bit")).alias("_bits"))
    suspect = buckets.where("_rows <> _bits").select("_bucket")
    repeated = numbers.join(suspect, "_bucket", "left_semi").groupBy("_key").count().where("count > 1")
    return repeated.agg(F.lit(check_name).alias("check_name"), F.count("*").alias("error_count"))


def grain_checks(views: dict[str, DataFrame]) -> DataFrame:
    daily_grain = ["date_key", "payment_currency_key", "payment_format_key"]
    return duplicate_groups(views["dim_date"], ["date_key"], "duplicate_date_key").unionByName(
        duplicate_groups(views["fact_daily_transaction"], daily_grain, "duplicate_daily_grain")
    )


def orphans(views: dict[str, DataFrame], places: list[int]) -> DataFrame:
    """(place, orphans): rows on the many side of each relationship without a partner on the one side.

    Each many side is scanned once: its rows collapse to their distinct key combinations on the
    map side, and only those meet the one sides. A key that is NULL has no partner.
    """
    by_many: dict[str, list[int]] = {}
    for place in places:
        by_many.setdefault(RELATIONSHIPS[place][2], []).append(place)
    result = None
    for many, held in by_many.items():
        keys = sorted({RELATIONSHIPS[place][3] for place in held})
        rows = views[many].groupBy(*keys).agg(F.count("*").alias("_rows"))
        for place in held:
            one, one_key, _, many_key = RELATIONSHIPS[place]
            partner = views[one].select(F.col(one_key).alias(f"_p{place}")).distinct()
            rows = rows.join(partner, F.col(many_key) == F.col(f"_p{place}"), "left")
        lost = lambda place: F.coalesce(F.sum(F.when(F.col(f"_p{place}").isNull(), F.col("_rows"))), F.lit(0))
        one_row = rows.agg(*[lost(place).cast("long").alias(f"_n{place}") for place in held])
        pairs = F.array(*[F.struct(F.lit(place).alias("place"), F.col(f"_n{place}").alias("orphans")) for place in held])
        part = one_row.select(F.inline(pairs))
        result = part if result is None else result.unionByName(part)
    return result


def _named(names: dict[int, Column]) -> Column:
    named = None
    for place, name in names.items():
        named = F.when(F.col("place") == place, name) if named is None else named.when(F.col("place") == place, name)
    return named


def orphan_checks(views: dict[str, DataFrame]) -> DataFrame:
    """The named checks among the relationships."""
    found = orphans(views, list(ORPHAN_CHECKS.values()))
    names = {place: F.lit(check) for check, place in ORPHAN_CHECKS.items()}
    return found.select(_named(names).alias("check_name"), F.col("orphans").alias("error_count"))


def reference_orphans(views: dict[str, DataFrame]) -> DataFrame:
    """Every relationship with its orphans."""
    found = orphans(views, list(range(len(RELATIONSHIPS))))
    return found.select(
        _named({i: F.lit(f"{many}.{key}") for i, (_, _, many, key) in enumerate(RELATIONSHIPS)}).alias("reference"),
        _named({i: F.lit(one) for i, (one, *_) in enumerate(RELATIONSHIPS)}).alias("one_side"),
        "orphans",
    )


def expected_kpi(kpi: DataFrame, expected: DataFrame) -> DataFrame:
    """KPI row against a one-row frame of expected values, one output row per KPI."""
    names = expected.columns
    both = kpi.select(*[F.col(n).cast("long").alias(f"actual_{n}") for n in names]).crossJoin(expected)
    pairs = F.array(
        *[
            F.struct(
                F.lit(n).alias("kpi_name"),
                F.col(n).cast("long").alias("expected_value"),
                F.col(f"actual_{n}").alias("actual_value"),
            )
            for n in names
        ]
    )
    passed = F.when(F.col("expected_value").eqNullSafe(F.col("actual_value")), "PASS").otherwise("FAIL")
    return both.select(F.inline(pairs)).withColumn("status", passed)


def lakehouse_assertions(spark: SparkSession, expected: list[str], prefix: str) -> DataFrame:
    """One row for each assertion on the loaded tables: expected and actual value, PASS or FAIL.

    Tables that should exist but do not are the set difference of two name lists. A missing
    table has no row count.
    """
    held = {t.name.removeprefix(prefix) for t in spark.catalog.listTables() if t.name.startswith(prefix)}
    named = lambda names: spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    missing = named(expected).subtract(named(held))
    parts = [missing.agg(F.lit("missing_tables").alias("assertion"), F.lit(0).cast("decimal(38,8)").alias("expected"), F.count("*").cast("decimal(38,8)").alias("actual"))]
    for name in sorted(held & set(expected)):
        rows = spark.table(f"{prefix}{name}").agg(F.count("*").alias("n"))
        at_least = F.least("n", F.lit(1)).cast("decimal(38,8)")
        parts.append(rows.select(F.lit(f"rows_{name}").alias("assertion"), F.lit(1).cast("decimal(38,8)").alias("expected"), at_least.alias("actual")))
    if {"fact_daily_transaction", "kpi_overview"} <= held:
        daily = spark.table(f"{prefix}fact_daily_transaction").agg(F.sum("transaction_count").cast("decimal(38,8)").alias("actual"))
        kpi = spark.table(f"{prefix}kpi_overview").select(F.col("transaction_count").cast("decimal(38,8)").alias("expected"))
        parts.append(kpi.crossJoin(daily).select(F.lit("daily_total_is_kpi").alias("assertion"), "expected", "actual"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.withColumn("status", F.when(F.col("expected").eqNullSafe(F.col("actual")), "PASS").otherwise("FAIL"))


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    result = None
    for name, frame in frames.items():
        part = frame.agg(F.lit(name).alias("object_name"), F.count("*").alias("row_count"))
        result = part if result is None else result.unionByName(part)
    return result
