"""Registered queries: name -> function of a workspace."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.ordinals import dense_ordinal, file_ordinal
from ledgerlake.operators import datasets as ds
from ledgerlake.operators import dims as dm
from ledgerlake.operators import curated as cu
from ledgerlake.operators import enrich, kpis, marts, recon, semantic, topk
from ledgerlake.operators import facts as fx
from ledgerlake.operators import reporting as rp
from ledgerlake.operators import scd2
from ledgerlake.operators import typing as ty
from ledgerlake.operators.held import merged, unheld, words
from ledgerlake.plans import acceptance, retention, source_load
from ledgerlake.plans.store import TableStore
from ledgerlake.plans.warehouse import source_upto
from ledgerlake.plans.workspace import Workspace, step_clock
from ledgerlake.schemas import (
    ACCOUNT_FIELDS,
    DIM_SCHEMAS,
    DW_BATCH,
    LOAD_BATCH,
    PATTERN_FIELDS,
    PAYMENT_FORMATS,
    TRANSACTION_FIELDS,
)
from ledgerlake.session import CODEC, drop, passing_stages, slices, stage
from ledgerlake.sources import files, patterns, sinks
from ledgerlake.sources.testtables import CURRENCIES
from ledgerlake.streaming.ingest import TransactionStream

Query = Callable[[Workspace], DataFrame]
REGISTRY: dict[str, Query] = {}

SECOND_LOAD = datetime(2024, 2, 1)
SLICE_DATES = (date(1996, 1, 1), date(1996, 12, 31))
SLICE_FORMATS = ["ACH", "Wire"]
SAMPLE_DATES = ("1996-01-01", "1996-01-31")


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def register(name: str, function: Query) -> None:
    REGISTRY[name] = function


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def tagged_union(parts: dict[str, DataFrame], name: str) -> DataFrame:
    result = None
    for label, frame in parts.items():
        part = frame.select(F.lit(label).alias(name), "*")
        result = part if result is None else result.unionByName(part)
    return result


# -- sources and sinks -----------------------------------------------------------------------


def _write_csv(df: DataFrame, path: str) -> str:
    options = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.options(**options).csv(path)
    return path


@query
def src_csv_accounts(ws):
    path = _write_csv(ws.landing["account"].select(ACCOUNT_FIELDS), ws.path("csv"))
    return files.read_accounts(ws.spark, path)


@query
def src_csv_transactions(ws):
    path = _write_csv(ws.landing["transaction"].select(TRANSACTION_FIELDS), ws.path("csv"))
    return files.read_transactions(ws.spark, path)


@query
def src_csv_patterns(ws):
    path = _write_csv(ws.landing["pattern"].select(PATTERN_FIELDS), ws.path("csv"))
    return files.read_patterns(ws.spark, path)


@query
def src_pattern_blocks(ws):
    path = ws.path("blocks")
    patterns.write_pattern_blocks(ws.landing["pattern"], path)
    return patterns.read_pattern_blocks(ws.spark, path)[0]


@query
def src_manifest(ws):
    """One source as expected, one a byte short, one with its first two lines swapped, one missing."""

    def written(name, fields, swap=False):
        rows = ws.landing[name].select("landing_row_id", F.concat_ws(",", *fields).alias("value"))
        with passing_stages(ws.spark):  # of the numbered lines
            digest = files.ordered_digest(dense_ordinal(rows, ["landing_row_id"], name="place")).first()["digest"]
        size = rows.agg(F.sum(F.octet_length("value") + 1)).first()[0]
        place = F.col("landing_row_id")
        order = F.when(place <= 2, 3 - place).otherwise(place) if swap else place
        path = ws.path("manifest")
        # Folders in line order, as a source in several parts; a slice of the lines is shuffled at a time.
        for number, part in enumerate(slices(rows.withColumn("_order", order), "_order")):
            ordered = part.repartitionByRange("_order").sortWithinPartitions("_order")
            ordered.select("value").write.text(f"{path}/part={number:02d}")
        return path, size, digest

    path, size, digest = written("account", ACCOUNT_FIELDS)
    expected = {
        "transactions": written("transaction", TRANSACTION_FIELDS),
        "accounts": (path, size + 1, digest),
        "swapped": written("account", ACCOUNT_FIELDS, swap=True),
        "patterns": (ws.path("nowhere"), 1),
    }
    return ws.settled(files.manifest(ws.spark, expected), *[source[0] for source in expected.values()])


@query
def src_landing_ordinal(ws):
    ordered = ws.landing["transaction"].repartitionByRange("landing_row_id").sortWithinPartitions("landing_row_id")
    path = _write_csv(ordered.select(TRANSACTION_FIELDS), ws.path("csv"))
    return file_ordinal(files.read_transactions(ws.spark, path)).select(
        "landing_row_id", "timestamp_text", "from_account_text", "to_account_text", "amount_paid_text"
    )


@query
def snk_reporting_csv(ws):
    folder = ws.path("reports")
    sinks.export_views(ws.reports, folder)
    read = {
        name: ws.spark.read.schema(rp_text_schema(frame)).option("header", True).csv(f"{folder}/{name}")
        for name, frame in ws.reports.items()
    }
    return recon.row_counts(read)


def rp_text_schema(frame: DataFrame) -> str:
    return ", ".join(f"`{name}` string" for name in frame.columns)


@query
def snk_lakehouse(ws):
    """The daily mart after its trip through CSV: typed again, money still decimal."""
    folder = ws.path("reports")
    sinks.export_views(ws.reports, folder)
    schemas = {name: frame.schema for name, frame in ws.reports.items()}
    sinks.load_lakehouse(ws.spark, folder, schemas, ws.path("lakehouse"), "lake_")
    return ws.spark.table("lake_fact_daily_transaction")


@query
def lakehouse_assertions(ws):
    """Tables that are missing, rows of each table, and daily totals against the KPI row."""
    folder = ws.path("reports")
    sinks.export_views(ws.reports, folder)
    schemas = {name: frame.schema for name, frame in ws.reports.items()}
    sinks.load_lakehouse(ws.spark, folder, schemas, ws.path("lakehouse"), "check_")
    return recon.lakehouse_assertions(ws.spark, list(schemas), "check_")


def _curated(ws) -> DataFrame:
    lenient = ty.lenient_transactions(ws.landing["transaction"])
    return enrich.curated_transactions(lenient, "run-1")


@query
def snk_curated_fact(ws):
    """Written twice for one month; the second run replaces that month instead of adding to it."""
    rows = stage(_curated(ws).withColumn("txn_month", F.date_format("txn_date", "yyyyMM").cast("int")), "curated")
    folder = ws.path("curated")
    sinks.write_curated(rows, folder, "txn_month")
    sinks.write_curated(rows.where("txn_month = 199601"), folder, "txn_month")
    return ws.spark.read.parquet(f"{folder}/fact_transaction").select(
        "transaction_key", "txn_date", "is_laundering", "is_cross_bank", "is_cross_currency", "is_self_transfer", "txn_month"
    )


@query
def snk_rejects(ws):
    folder = ws.path("curated")
    bad = _curated(ws).where("not is_valid").select("transaction_key", "run_id", "is_laundering")
    sinks.write_rejects(bad, folder)
    return ws.spark.read.parquet(f"{folder}/rejects/transaction")


# -- typing and rejects ------------------------------------------------------------------------

register("typed_account", lambda ws: ty.typed_accounts(ty.tag_accounts(ws.landing["account"])))
register("reject_account", lambda ws: ty.rejects(ty.tag_accounts(ws.landing["account"]), ty.ACCOUNT))
register("typed_transaction", lambda ws: ty.typed_transactions(ty.tag_transactions(ws.landing["transaction"])))
register("reject_transaction", lambda ws: ty.rejects(ty.tag_transactions(ws.landing["transaction"]), ty.TRANSACTION))
register("typed_pattern", lambda ws: ty.typed_patterns(ty.tag_patterns(ws.landing["pattern"])))
register("reject_pattern", lambda ws: ty.rejects(ty.tag_patterns(ws.landing["pattern"]), ty.PATTERN))
register("typed_transaction_try", lambda ws: ty.lenient_transactions(ws.landing["transaction"]))


@query
def txn_business(ws):
    rows = enrich.business_view(ws.source.transactions).select(
        "source_transaction_id", "is_cross_bank", "is_cross_currency", "is_self_transfer", "implied_exchange_rate"
    )
    return rounded(rows, "implied_exchange_rate")


@query
def txn_enriched(ws):
    rows = enrich.enriched_transactions(ws.source.transactions).select(
        "source_transaction_id", "date_key", "time_key", "is_cross_bank", "is_cross_currency", "implied_exchange_rate"
    )
    return rounded(rows, "implied_exchange_rate")


@query
def pattern_enriched(ws):
    return enrich.with_calendar_keys(ws.source.patterns).select(
        "pattern_transaction_id", "pattern_attempt_id", "pattern_sequence", "date_key", "time_key"
    )


register("curated_txn", _curated)


@query
def curated_sample(ws):
    """A month of the partitioned copy: only that partition is read."""
    low, high = SAMPLE_DATES
    rows, folder = _curated(ws), ws.path("curated")
    sinks.write_curated(rows.withColumn("txn_month", F.date_format("txn_date", "yyyyMM").cast("int")), folder, "txn_month")
    inside = F.col("txn_date").between(F.lit(low).cast("date"), F.lit(high).cast("date"))
    month = F.col("txn_month") == int(low[:7].replace("-", ""))
    columns = [c for c in rows.columns if c != "is_valid"]
    return ws.spark.read.parquet(f"{folder}/fact_transaction").where(month & inside).orderBy("transaction_key").limit(100).select(columns)


@query
def txn_account_enriched(ws):
    return _with_master(ws).select("source_transaction_id", "from_bank_name", "from_entity_id")


def _with_master(ws) -> DataFrame:
    hot = fx.hot_parties(ws.source.transactions)["account"]
    return kpis.with_account_master(ws.source.transactions, ws.source.accounts, hot)


@query
def txn_account_join_check(ws):
    """Rows before and after the account join."""
    return kpis.rows_around_join(ws.source.transactions, _with_master(ws))


# -- dimensions ----------------------------------------------------------------------------------


def _second_accounts(ws) -> DataFrame:
    return ty.typed_accounts(ty.tag_accounts(ws.second_accounts, 2))


def _second_dim(ws, dim: str) -> DataFrame:
    source, business_key, key = {
        "dim_bank": (dm.bank_source, "bank_id", "bank_key"),
        "dim_entity": (dm.entity_source, "entity_id", "entity_key"),
    }[dim]
    return dm.type1_merge(ws.tables[dim], source(_second_accounts(ws)), business_key, key)[0]


def _second_snapshot(ws) -> DataFrame:
    return scd2.account_snapshot(
        _second_accounts(ws), stage(_second_dim(ws, "dim_bank"), "dim"), stage(_second_dim(ws, "dim_entity"), "dim")
    )


for _dim in ("dim_date", "dim_currency", "dim_payment_format", "dim_pattern_type"):
    register(_dim, lambda ws, _dim=_dim: ws.tables[_dim])
register("dim_bank", lambda ws: _second_dim(ws, "dim_bank"))
register("dim_entity", lambda ws: _second_dim(ws, "dim_entity"))


@query
def dim_time(ws):
    """Every minute with the transfers that fell on it."""
    used = ws.tables["fact_transaction"].groupBy("time_key").agg(F.count("*").alias("n"))
    rows = ws.tables["dim_time"].join(used, "time_key", "left")
    return rows.select(*ws.tables["dim_time"].columns, F.coalesce("n", F.lit(0)).alias("transaction_count"))


@query
def account_snapshot(ws):
    return scd2.account_snapshot(ws.source.accounts, ws.tables["dim_bank"], ws.tables["dim_entity"])


@query
def dim_account_scd2(ws):
    return scd2.type2_merge(ws.tables["dim_account"], _second_snapshot(ws), SECOND_LOAD)[0]


@query
def dim_unknown(ws):
    parts = {}
    for dim, ddl in DIM_SCHEMAS.items():
        key, label = ddl.split()[0], {"dim_date": "day_name", "dim_time": "day_part", "dim_account": "account_number"}
        name = label.get(dim) or {"dim_bank": "bank_name", "dim_entity": "entity_name"}.get(dim) or ws.tables[dim].columns[1]
        parts[dim] = (
            ws.tables[dim].where(F.col(key) == -1).select(F.col(key).cast("long").alias("key"), F.col(name).alias("label"))
        )
    used = facts_on_unknown(ws)
    return tagged_union(parts, "dimension").join(used, "dimension")


# Dimension -> the columns of the transfer fact that may point at its unknown member.
UNKNOWN_COLUMNS = {
    "dim_date": ["date_key"],
    "dim_time": ["time_key"],
    "dim_currency": ["payment_currency_key", "receiving_currency_key"],
    "dim_payment_format": ["payment_format_key"],
    "dim_bank": ["from_bank_key", "to_bank_key"],
    "dim_entity": ["from_entity_key", "to_entity_key"],
    "dim_account": ["from_account_key", "to_account_key"],
}


def facts_on_unknown(ws) -> DataFrame:
    """How often facts fall back on each unknown member: one scan of each fact."""
    sums = {dim: sum((F.count_if(F.col(c) == -1) for c in columns), F.lit(0)) for dim, columns in UNKNOWN_COLUMNS.items()}
    in_fact = ws.tables["fact_transaction"].agg(*[n.cast("long").alias(dim) for dim, n in sums.items()])
    pattern = F.count_if(F.col("pattern_type_key") == -1).alias("dim_pattern_type")
    both = in_fact.crossJoin(ws.tables["fact_pattern_transaction"].agg(pattern))
    pairs = [F.struct(F.lit(c).alias("dimension"), F.col(c).alias("fact_references")) for c in both.columns]
    return both.select(F.inline(F.array(*pairs)))


@query
def surrogate_keys(ws):
    """Entity keys before and after the second snapshot: old keys stay, new ones follow on."""
    before = ws.tables["dim_entity"].select("entity_id", F.col("entity_key").alias("first_key"))
    after = _second_dim(ws, "dim_entity").select("entity_id", F.col("entity_key").alias("second_key"))
    return after.join(before, "entity_id", "left")


register("src_bank_view", lambda ws: dm.bank_directory(ws.source.accounts))


# -- joins -----------------------------------------------------------------------------------------


@query
def fact_transaction(ws):
    return rounded(ws.tables["fact_transaction"], "implied_exchange_rate")


register("fact_pattern_transaction", lambda ws: ws.tables["fact_pattern_transaction"])
register(
    "currency_recon",
    lambda ws: recon.currency_recon(ws.source.transactions, ws.tables["fact_transaction"], ws.tables["dim_currency"]),
)
register(
    "active_account_coverage", lambda ws: kpis.active_account_coverage(ws.source.transactions, ws.source.accounts)
)
register(
    "top_sender_banks",
    lambda ws: kpis.top_sender_banks(ws.source.transactions, dm.bank_directory(ws.source.accounts)),
)
register("ref_integrity", lambda ws: recon.reference_orphans(ws.reports))


@query
def not_exists_current(ws):
    return scd2.new_versions(_second_snapshot(ws), ws.tables["dim_account"])


@query
def dim_bank_semi(ws):
    banks = topk.compact_banks(ws.reports["fact_bank_activity"])
    accounts = topk.compact_accounts(ws.reports["fact_aml_account_risk"])
    return topk.referenced_banks(ws.reports["dim_bank"], banks, accounts)


register("latest_batch_cross", lambda ws: ws.reports["data_quality_overview"])

# -- marts, KPIs, profiles -----------------------------------------------------------------------


def _fact(ws) -> DataFrame:
    return marts.as_measures(ws.tables["fact_transaction"])


register("mart_kpi_overview", lambda ws: marts.kpi_overview(_fact(ws), ws.tables["dim_date"]))
register(
    "mart_daily_transaction",
    lambda ws: marts.daily_transaction(
        _fact(ws), ws.tables["dim_date"], ws.tables["dim_currency"], ws.tables["dim_payment_format"]
    ),
)
register("mart_aml_by_payment_format", lambda ws: marts.aml_by_payment_format(_fact(ws), ws.tables["dim_payment_format"]))
register("mart_bank_activity", lambda ws: marts.bank_activity(ws.tables["fact_transaction"], ws.tables["dim_bank"]))
register("mart_currency_flow", lambda ws: marts.currency_flow(_fact(ws), ws.tables["dim_currency"]))
register(
    "mart_pattern_summary",
    lambda ws: marts.pattern_summary(ws.tables["fact_pattern_transaction"], ws.tables["dim_pattern_type"]),
)
register("mart_aml_account_risk", lambda ws: marts.aml_account_risk(ws.tables["fact_transaction"], ws.tables["dim_account"]))


@query
def mart_refresh_all(ws):
    ws.warehouse.refresh_marts()
    return recon.row_counts(ws.warehouse.marts())


for _name, _function in {
    "kpi_label_split": kpis.label_split,
    "kpi_format_rate": kpis.format_rate,
    "kpi_quality_flags": kpis.quality_flags,
    "kpi_bank_split": kpis.bank_split,
    "kpi_daily": kpis.daily_counts,
    "kpi_window_bounds": kpis.window_bounds,
    "kpi_flag_counts": kpis.flag_counts,
    "active_bank_count": kpis.active_bank_count,
}.items():
    register(_name, lambda ws, _function=_function: _function(ws.source.transactions))
register("kpi_pattern_types", lambda ws: kpis.pattern_types(ws.source.patterns))
register("kpi_amount_by_currency", lambda ws: rounded(kpis.amount_by_currency(ws.source.transactions), "average_amount_paid"))
register("kpi_aml_rate", lambda ws: rounded(kpis.aml_rate(ws.source.transactions), "aml_rate_percent", digits=9))


def _lenient(ws) -> DataFrame:
    return ty.lenient_transactions(ws.landing["transaction"])


register(
    "profile_summary",
    lambda ws: kpis.profile_summary(
        _lenient(ws), ty.lenient_accounts(ws.landing["account"]), ty.lenient_patterns(ws.landing["pattern"])
    ),
)
register("profile_quality", lambda ws: kpis.profile_quality(_lenient(ws)))
register("profile_currency_pairs", lambda ws: kpis.profile_currency_pairs(_lenient(ws)))
register("profile_payment_formats", lambda ws: kpis.profile_payment_formats(_lenient(ws)))
register("profile_daily", lambda ws: kpis.profile_daily(_lenient(ws)))
register("profile_patterns", lambda ws: kpis.profile_patterns(ty.lenient_patterns(ws.landing["pattern"])))
register(
    "profile_top_banks", lambda ws: kpis.profile_top_banks(_lenient(ws), ty.lenient_accounts(ws.landing["account"]))
)
register("perf_daily_rollup", lambda ws: ds.daily_rollup(ws.reports))


@query
def row_counts(ws):
    s = ws.source
    landed = {f"landing_{name}": frame for name, frame in ws.landing.items()}
    typed = {"account": s.accounts, "transaction": s.transactions, "pattern": s.patterns, "rejected_row": s.rejected}
    return recon.row_counts({**landed, **typed})


# -- windows and ranks --------------------------------------------------------------------------


@query
def scd2_overlap(ws):
    """Versions after the second snapshot, and how many of them overlap."""
    versions = scd2.type2_merge(ws.tables["dim_account"], _second_snapshot(ws), SECOND_LOAD)[0]
    versions = stage(versions, "versions")
    return versions.where("account_key <> -1").agg(F.count("*").alias("versions")).crossJoin(
        scd2.overlapping_versions(versions).agg(F.count("*").alias("overlapping"))
    )


register("bank_rank", lambda ws: rounded(semantic.bank_rank(ws.reports), "aml_participation_ratio"))
register("account_risk_rank", lambda ws: semantic.account_risk_rank(ws.reports))
register("pattern_rank", lambda ws: semantic.pattern_rank(ws.reports))
register("daily_cumulative", lambda ws: semantic.daily_cumulative(ws.daily))
register("daily_prev_day", lambda ws: semantic.daily_previous(ws.daily))
register("daily_growth", lambda ws: rounded(semantic.daily_growth(ws.daily), "transaction_growth_ratio"))
register("daily_change", lambda ws: semantic.daily_change(ws.daily))


@query
def pattern_sequence_build(ws):
    """Place of each accepted pattern row inside its attempt, dense after the rejects left."""
    rows = ws.source.patterns.select("pattern_attempt_id", "pattern_transaction_id")
    return dense_ordinal(rows, ["pattern_transaction_id"], within=("pattern_attempt_id",), name="sequence")


# -- top-k ---------------------------------------------------------------------------------------

register("compact_banks", lambda ws: topk.compact_banks(ws.reports["fact_bank_activity"]))
register("compact_accounts", lambda ws: topk.compact_accounts(ws.reports["fact_aml_account_risk"]))
register("compact_snapshot", lambda ws: recon.row_counts(topk.compact_snapshot(ws.reports)))
register(
    "latest_batch",
    lambda ws: rp.latest_rows(ws.warehouse.batches(), "dw_batch_id").select(
        "dw_batch_id", "load_type", "status", "transaction_rows_inserted", "pattern_rows_inserted", "rejected_rows"
    ),
)
register("top_risk_accounts", lambda ws: topk.top_risk_accounts(ws.reports))
register("top_banks15", lambda ws: topk.top_banks(ws.reports, 15))
register("bank_ranking50", lambda ws: rounded(topk.bank_ranking(ws.reports), "aml_participation_ratio"))
register("bank_treemap10", lambda ws: topk.top_banks(ws.reports, 10))
register("top_corridors15", lambda ws: topk.top_corridors(ws.reports))


@query
def mart_top20(ws):
    leaders = topk.mart_leaders(ws.marts)
    shape = {
        "formats": ("payment_format", "laundering_count"),
        "banks": ("bank_id", "total_participations"),
        "corridors": ("concat(payment_currency, ' > ', receiving_currency)", "transaction_count"),
        "patterns": ("pattern_type", "pattern_transaction_count"),
        "accounts": ("account_number", "laundering_participations"),
    }
    parts = {
        name: leaders[name].selectExpr(f"{item} as item", f"cast({value} as long) as value")
        for name, (item, value) in shape.items()
    }
    return tagged_union(parts, "report")


# The same sample reports, each with all its columns.
for _report in ("formats", "banks", "corridors", "patterns", "accounts"):
    register(f"mart_top20_{_report}", lambda ws, _report=_report: topk.mart_leaders(ws.marts)[_report])

register("last_seven_days", lambda ws: rounded(topk.last_seven_days(ws.daily), "aml_ratio"))


@query
def mix_top5_other(ws):
    named = ws.reports["fact_pattern_summary"].join(ws.reports["dim_pattern_type"], "pattern_type_key")
    parts = {
        "payment_format": topk.top_and_other(ws.daily, "payment_format", "transaction_count"),
        "pattern_type": topk.top_and_other(named, "pattern_type", "pattern_transaction_count"),
    }
    return tagged_union(parts, "axis")


# -- measures ------------------------------------------------------------------------------------

register(
    "measure_overall",
    lambda ws: rounded(
        semantic.overall(ws.reports),
        "overall_aml_ratio",
        "overall_cross_bank_ratio",
        "overall_cross_currency_ratio",
        "overall_self_transfer_ratio",
    ),
)


def _sliced(ws) -> DataFrame:
    return semantic.sliced_daily(ws.reports, dates=SLICE_DATES, formats=SLICE_FORMATS)


register(
    "measure_filtered",
    lambda ws: rounded(semantic.filtered(_sliced(ws)), "aml_ratio", "average_amount_per_transaction"),
)


@query
def measure_selected_currency(ws):
    parts = {
        "none": semantic.selected_currency(ws.daily),
        "one": semantic.selected_currency(semantic.sliced_daily(ws.reports, currencies=["Euro"])),
    }
    return tagged_union(parts, "slicer")


register("measure_bank", lambda ws: rounded(semantic.bank(ws.reports), "aml_participation_ratio"))
register("measure_account_risk", lambda ws: semantic.account_risk(ws.reports))
register("measure_currency_flow", lambda ws: rounded(semantic.corridors(ws.reports), "aml_ratio"))
register("measure_pattern", lambda ws: rounded(semantic.pattern(ws.reports), "transactions_per_attempt"))
register("measure_etl", lambda ws: semantic.etl(ws.reports))
register("measure_validation", lambda ws: rounded(semantic.validation(ws.reports), "validation_pass_ratio"))
register(
    "measure_cloud18",
    lambda ws: semantic.snapshot_measures({name: semantic.as_text(frame) for name, frame in ws.reports.items()}),
)
register("measure_non_laundering", lambda ws: semantic.non_laundering(ws.daily))
register("measure_status_flag", lambda ws: semantic.status_flag(ws.reports))
register("measure_period_title", lambda ws: semantic.period_title(ws.daily))

# -- dashboard datasets -------------------------------------------------------------------------

register("ds_daily_average", lambda ws: rounded(ds.daily_average(ws.daily), "daily_average"))
register("ds_weekday_volume", lambda ws: ds.weekday_volume(ws.daily))
register(
    "ds_date_format_matrix",
    lambda ws: ds.spread(ws.daily, ["full_date"], "payment_format", "transaction_count", PAYMENT_FORMATS),
)
register(
    "ds_currency_matrix",
    lambda ws: ds.spread(
        semantic.corridors(ws.reports), ["payment_currency"], "receiving_currency", "transactions", CURRENCIES
    ),
)
register("ds_risk_account_count", lambda ws: semantic.account_risk(ws.reports).select("risk_accounts"))
register("ds_bank_scatter", lambda ws: rounded(ds.bank_scatter(ws.reports), "aml_participation_ratio"))
register(
    "ds_corridor_scatter",
    lambda ws: rounded(ds.corridor_detail(ws.reports), "aml_ratio").drop("payment_currency", "receiving_currency"),
)
register("ds_pattern_detail", lambda ws: rounded(ds.pattern_detail(ws.reports), "transactions_per_attempt"))
register("ds_batch_history", lambda ws: ds.batch_history(ws.reports))
register("ds_daily_detail", lambda ws: rounded(ds.daily_detail(ws.daily), "aml_ratio"))
register("ds_format_volume", lambda ws: rounded(ds.format_volume(ws.daily), "aml_ratio"))
register("ds_aml_trend", lambda ws: ds.aml_trend(ws.daily))
register("ds_corridor_detail", lambda ws: rounded(ds.corridor_detail(ws.reports), "aml_ratio"))
register("ds_sent_received_mix", lambda ws: topk.sent_received_mix(ws.reports))
register("ds_validation_detail", lambda ws: ds.validation_detail(ws.reports))
register("ds_drill_calendar", lambda ws: ds.drill_calendar(ws.reports))
register("ds_hour_daypart", lambda ws: ds.hour_daypart(ws.tables["fact_transaction"], ws.tables["dim_time"]))

# -- reporting views ------------------------------------------------------------------------------

for _view in rp.VIEW_NAMES:
    register(f"rpt_{_view}", lambda ws, _view=_view: ws.reports[_view])


@query
def rpt_refresh(ws):
    ws.warehouse.refresh_marts()
    return recon.row_counts(ws.warehouse.reports())


# -- batches, increments, reconciliation ------------------------------------------------------------


def _source_log(ws) -> DataFrame:
    return ws.source_store.log(source_load.LOG, LOAD_BATCH, "batch_id")


@query
def load_source_batch(ws):
    return _source_log(ws).select(
        "batch_id", "dataset_name", "status", "account_landing_rows", "transaction_landing_rows", "pattern_landing_rows"
    )


@query
def close_source_batch(ws):
    return _source_log(ws).select(
        "batch_id",
        "status",
        "account_loaded_rows",
        "transaction_loaded_rows",
        "pattern_loaded_rows",
        "rejected_rows",
        "completed_at",
    )


BATCH_COLUMNS = [
    "dw_batch_id",
    "load_type",
    "status",
    "source_low_watermark",
    "source_high_watermark",
    "pattern_low_watermark",
    "pattern_high_watermark",
    "transaction_rows_inserted",
    "pattern_rows_inserted",
    "rejected_rows",
]


@query
def load_dw(ws):
    return ws.warehouse.batches().select(
        *BATCH_COLUMNS,
        "bank_rows_affected",
        "entity_rows_affected",
        "account_rows_affected",
        "currency_rows_affected",
        "payment_format_rows_affected",
        "validation_status",
    )


def _halfway(ws) -> int:
    return ws.source.transactions.agg(F.max("source_transaction_id")).first()[0] // 2


@query
def watermark_window(ws):
    """A FULL load of the older half of the ids, then an increment with the newer half."""
    warehouse = ws.scratch_warehouse()
    warehouse.load(source_upto(ws.source, _halfway(ws)), "FULL")
    warehouse.load(ws.source, "INCREMENTAL")
    return warehouse.batches().select(BATCH_COLUMNS)


@query
def idempotent_append(ws):
    """Three appends of growing or equal input; the third one finds nothing new."""
    key = "source_transaction_id"
    rows = ws.source.transactions.select(key)
    first = rows.where(F.col(key) <= _halfway(ws))
    held = stage(words(first, key), "held")
    second = stage(unheld(rows, key, held), "append")
    third = unheld(rows, key, stage(merged(held.unionByName(words(second, key))), "held"))
    appended = {"1": first, "2": second, "3": third}
    return tagged_union(
        {step: frame.agg(F.count("*").alias("inserted_rows")) for step, frame in appended.items()}, "step"
    )


@query
def incremental_noop(ws):
    return ws.warehouse.batches().where("load_type = 'INCREMENTAL'").select(BATCH_COLUMNS)


def _streamed(ws, first: Column, second: Column, between=lambda stream: None) -> TransactionStream:
    """Two drops of files, removed when taken in; ``between`` runs when the first has been."""
    inbox, landed = ws.path("inbox"), ws.landing["transaction"]
    stream = TransactionStream(ws.spark, inbox, ws.path("stream"), ws.path("stream-checkpoint"))
    for drop_of, then in ((first, between), (second, lambda stream: None)):
        landed.where(drop_of).write.option("compression", CODEC).parquet(inbox)
        stream.run_available()
        drop(ws.spark, inbox)
        then(stream)
    return stream


def _overlapping(ws) -> TransactionStream:
    """The second drop repeats part of the first."""
    even = F.col("landing_row_id") % 2 == 0
    return _streamed(ws, even, ~even | (F.col("landing_row_id") % 3 == 0))


@query
def stream_rejects(ws):
    """Rows of the drops that do not parse, each once."""
    return _overlapping(ws).rejects().select("source_object", "source_row_id", "error_code", "error_description", "raw_payload")


@query
def incremental_files(ws):
    """Files land twice: a FULL load after the first drop, an INCREMENTAL one after the second."""
    warehouse, source = ws.scratch_warehouse(), ws.source
    older = F.col("landing_row_id") <= _halfway(ws)

    def full(stream):
        warehouse.load(stream.source(source.accounts, source.patterns), "FULL")

    stream = _streamed(ws, older, ~older | (F.col("landing_row_id") % 3 == 0), full)
    warehouse.load(stream.source(source.accounts, source.patterns), "INCREMENTAL")
    batches = warehouse.batches().select(
        "dw_batch_id", "load_type", "status", "source_low_watermark", "source_high_watermark", "transaction_rows_inserted"
    )
    return ws.settled(batches, stream.target, stream.checkpoint, warehouse.store.root)


@query
def incremental_stream(ws):
    """Two drops of files, the second repeating part of the first; every transfer arrives once."""
    return _overlapping(ws).table().select(
        "source_transaction_id", "transaction_timestamp", "from_bank_id", "from_account_id", "amount_paid", "is_laundering"
    )


def _unknown_rejects(ws, source_object: str) -> DataFrame:
    return ws.tables["dw_rejected_row"].where(F.col("source_object") == source_object)


register("reject_unknown_keys_txn", lambda ws: _unknown_rejects(ws, "transactions"))
register("reject_unknown_keys_pattern", lambda ws: _unknown_rejects(ws, "pattern_transactions"))


def _breaking(source):
    """The source with one transfer that cannot be read."""
    last = source.transactions.agg(F.max("source_transaction_id")).first()[0]
    broken = F.when(
        F.col("source_transaction_id") == last, F.raise_error(F.lit("unreadable row")).cast("string")
    ).otherwise(F.col("payment_format"))
    return replace(source, transactions=source.transactions.withColumn("payment_format", broken))


@query
def batch_failure(ws):
    """A load that breaks on one row: logged as FAILED, nothing of it published."""
    source = _breaking(ws.source)
    warehouse = ws.scratch_warehouse()
    try:
        warehouse.load(source, "FULL")
    except Exception as error:  # the load logs the failure and raises it again
        if "unreadable row" not in str(error):
            raise
    published = warehouse.tables()["fact_transaction"].agg(F.count("*").alias("published_rows"))
    return (
        warehouse.batches()
        .withColumn("has_message", F.col("error_message").isNotNull())
        .select("dw_batch_id", "load_type", "status", "source_high_watermark", "transaction_rows_inserted", "has_message")
        .crossJoin(published)
    )


@query
def landing_gate(ws):
    """Landing rows against the counts the batch log expects."""
    names = list(source_load.OBJECTS)
    wanted = _source_log(ws).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("source_object"), F.col(f"{n}_landing_rows").alias("expected_rows"))
                    for n in names
                ]
            )
        )
    )
    status = F.when(F.col("row_count") == F.col("expected_rows"), "OK").otherwise("STOP")
    return source_load.landing_counts(ws.landing).join(wanted, "source_object").withColumn("status", status)


@query
def landing_gate_stop(ws):
    """Counts given from outside, one of them wrong: the batch stops before anything is typed."""
    lines = {name: ws.spark.read.parquet(f"{ws.sf_dir}/{name}.parquet").count() for name in ("lineitem", "customer")}
    expected = {"transaction": lines["lineitem"], "account": lines["customer"]}  # the master holds suppliers, too
    store = TableStore(ws.spark, ws.path("gated"))
    try:
        source_load.load_source_batch(store, ws.landing, clock=step_clock(), expected_rows=expected)
    except source_load.LandingGateError as stop:
        wrong = stop.wrong
    else:
        wrong = {}
    stopped = [F.struct(F.lit(k).alias("source_object"), F.lit(v[0]).cast("long").alias("row_count"), F.lit(v[1]).cast("long").alias("expected_rows")) for k, v in wrong.items()]
    written = [store.exists(store.path(f"tagged_{name}", 1)) for name in source_load.OBJECTS]
    return store.log("load_batch", LOAD_BATCH, "batch_id").select(
        "batch_id", "status", F.lit(any(written)).alias("anything_written"), F.inline(F.array(*stopped))
    )


@query
def recon_9_checks(ws):
    return ws.warehouse.validations().select(
        "validation_result_id", "dw_batch_id", "check_name", "source_value", "target_value", "status"
    )


register("landing_empty_check", lambda ws: source_load.unprocessed_landing(ws.landing, ws.source_store, 1))


@query
def dim_seed_check(ws):
    t = ws.tables
    return (
        t["dim_time"].agg(F.count("*").alias("time_rows"))
        .crossJoin(t["dim_bank"].where("bank_key = -1").agg(F.count("*").alias("unknown_bank")))
        .crossJoin(t["dim_account"].where("account_key = -1").agg(F.count("*").alias("unknown_account")))
        .crossJoin(t["dim_account"].agg(F.count("*").alias("account_rows")))
    )


register("recon_grain_checks", lambda ws: recon.grain_checks(ws.reports))
register("recon_ref_checks", lambda ws: recon.orphan_checks(ws.reports))


@query
def recon_kpi_expected(ws):
    """Reported KPIs against figures taken from the typed source."""
    s = recon.source_totals(ws.source.transactions)
    expected = s.select(
        F.col("source_rows").alias("transaction_count"),
        F.col("source_laundering").alias("laundering_count"),
        F.col("source_cross_bank").alias("cross_bank_count"),
        F.col("source_cross_currency").alias("cross_currency_count"),
        F.col("source_self_transfer").alias("self_transfer_count"),
    )
    return recon.expected_kpi(ws.reports["kpi_overview"], expected)


@query
def raw_valid_reject_balance(ws):
    s = ws.source
    valid = {"account": s.accounts, "transaction": s.transactions, "pattern": s.patterns}
    parts = {}
    for name, frame in valid.items():
        source_object = source_load.OBJECTS[name][2]
        parts[name] = (
            ws.landing[name].agg(F.count("*").alias("raw_rows"))
            .crossJoin(frame.agg(F.count("*").alias("valid_rows")))
            .crossJoin(s.rejected.where(F.col("source_object") == source_object).agg(F.count("*").alias("rejected_rows")))
            .withColumn("balanced", F.col("raw_rows") == F.col("valid_rows") + F.col("rejected_rows"))
        )
    return tagged_union(parts, "source_object")


def _acceptance(ws, run_id: int = 1) -> DataFrame:
    return acceptance.run_acceptance(
        ws.source, ws.tables, ws.reports, ws.warehouse.batches(), ws.warehouse.validations(), ws.marts, {}, run_id
    )


@query
def acceptance_suite(ws):
    return _acceptance(ws).drop("test_name")


@query
def acceptance_latest(ws):
    """Two recorded runs; only the newer one is shown, in report order."""
    store = TableStore(ws.spark, ws.path("acceptance"))
    for _ in range(2):
        acceptance.record_run(store, lambda run_id: _acceptance(ws, run_id), clock=step_clock())
    return acceptance.latest_results(acceptance.test_runs(store), acceptance.test_results(store)).select(
        "test_run_id", "run_label", "run_status", "category", "category_order", "test_code", "status"
    )


@query
def demo_queries(ws):
    """Failed tests, formats by rate, patterns by attempts, latest checks: one list."""
    formats = ws.reports["fact_aml_payment_format"].join(ws.reports["dim_payment_format"], "payment_format_key")
    named = ws.reports["fact_pattern_summary"].join(ws.reports["dim_pattern_type"], "pattern_type_key")
    newest = rp.latest_rows(ws.reports["etl_batch_monitor"], "dw_batch_id").select("dw_batch_id")
    parts = {
        "failed_tests": _acceptance(ws)
        .where("status = 'FAILED'")
        .select(F.col("test_code").alias("item"), F.col("actual_value").alias("value")),
        "format_rate": formats.select(
            F.col("payment_format").alias("item"), F.col("laundering_count").cast("string").alias("value")
        ),
        "pattern_attempts": named.select(
            F.col("pattern_type").alias("item"), F.col("attempt_count").cast("string").alias("value")
        ),
        "latest_checks": ws.reports["etl_validation_result"]
        .join(F.broadcast(newest), "dw_batch_id")
        .select(F.col("check_name").alias("item"), F.col("status").alias("value")),
    }
    return tagged_union(parts, "question")


# Result sets of the demo, each with all its columns.
@query
def demo_latest_run(ws):
    """The newest recorded run, and its verdict."""
    store = TableStore(ws.spark, ws.path("acceptance"))
    acceptance.record_run(store, lambda run_id: _acceptance(ws, run_id), clock=step_clock())
    return acceptance.latest_results(acceptance.test_runs(store), acceptance.test_results(store)).select(
        "test_run_id", "run_label", "run_status", "category", "test_code", "expected_value", "actual_value", "status"
    )


register("demo_format_rate", lambda ws: rp_named(ws, "fact_aml_payment_format", "dim_payment_format", "payment_format_key"))
register("demo_pattern_attempts", lambda ws: rp_named(ws, "fact_pattern_summary", "dim_pattern_type", "pattern_type_key"))


def rp_named(ws, fact: str, dim: str, key: str) -> DataFrame:
    return ws.reports[fact].join(ws.reports[dim], key)


@query
def demo_latest_checks(ws):
    """Every column of the checks of the newest load."""
    newest = rp.latest_rows(ws.reports["etl_batch_monitor"], "dw_batch_id").select("dw_batch_id")
    return ws.reports["etl_validation_result"].join(F.broadcast(newest), "dw_batch_id")


def _two_copies(ws) -> tuple[DataFrame, DataFrame]:
    """The written curated copy and the warehouse's fact in the columns they share; their validity rules differ."""
    t = ws.tables
    local = cu.warehouse_copy(t["fact_transaction"], t["dim_currency"], t["dim_payment_format"])
    return cu.shared_columns(ws.curated["fact_transaction"]), local


@query
def curated_vs_local(ws):
    """Written curated copy against the warehouse, per payment format."""
    counts = [F.count("*").alias("row_count"), F.count_if("is_laundering").alias("laundering_count")]
    sides = [copy.groupBy("payment_format").agg(*counts) for copy in _two_copies(ws)]
    return recon.compare_by_key(*sides, ["payment_format"], ["row_count", "laundering_count"])


register("curated_vs_local_totals", lambda ws: cu.totals_compared(*_two_copies(ws)))
register("curated_vs_local_daily", lambda ws: cu.days_compared(*_two_copies(ws)))
register(
    "curated_vs_local_rows",
    lambda ws: cu.differing_rows(*_two_copies(ws), "transaction_key", ("curated", "local")),
)
register("curated_completeness", lambda ws: kpis.window_bounds(ws.curated["fact_transaction"]))
register("curated_aml_rate", lambda ws: cu.aml_rate(ws.curated["fact_transaction"]))
register("curated_daily", lambda ws: cu.daily(ws.curated["fact_transaction"]))
register("curated_format_rate", lambda ws: cu.format_rate(ws.curated["fact_transaction"]))
register("curated_flags", lambda ws: cu.flag_counts(ws.curated["fact_transaction"]))


@query
def curated_patterns(ws):
    """Attempts and transfers per type, from the written bridge."""
    bridge = ws.curated["bridge_pattern_transaction"]
    return bridge.groupBy("pattern_type").agg(
        F.count("*").alias("pattern_transaction_count"), F.count_distinct("attempt_id").alias("attempt_count")
    )


@query
def retention_sweep(ws):
    """Rows per table after a broken load, a rerun, two refreshes and a sweep of all that nobody names."""
    warehouse = ws.scratch_warehouse()
    warehouse.load(ws.source, "FULL")
    try:
        warehouse.load(_breaking(ws.source), "FULL")
    except Exception as error:  # the load logs the failure and raises it again
        if "unreadable row" not in str(error):
            raise
    for _ in range(2):
        warehouse.refresh_marts()
    swept = retention.sweep_warehouse(warehouse, timedelta(0))
    held = {**warehouse.tables(), **warehouse.marts()}
    left = retention.sweep_warehouse(warehouse, timedelta(0))
    counts = recon.row_counts(held).withColumns(
        {"was_swept": F.lit(bool(swept)), "left_over": F.lit(len(left)).cast("long")}
    )
    return ws.settled(counts, warehouse.store.root)


@query
def dw_reset(ws):
    """Rows per table before and after a reset; only the fixed members remain."""
    empty = ws.warehouse.reset().tables()
    before = recon.row_counts(ws.tables).withColumnRenamed("row_count", "rows_before")
    after = recon.row_counts(empty).withColumnRenamed("row_count", "rows_after")
    return before.join(after, "object_name")
