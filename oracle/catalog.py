"""One SQL statement per registered query."""

from __future__ import annotations

from oracle import blocks as b
from oracle.blocks import CROSS_BANK, CROSS_CURRENCY, DATE_KEY, RATE_OUT, SELF, TIME_KEY, big, money, rate, ratio, with_blocks

TXN = (
    "source_transaction_id, source_row_id, transaction_timestamp, raw_from_bank_id, from_bank_id, from_account_id, "
    "raw_to_bank_id, to_bank_id, to_account_id, amount_received, receiving_currency, amount_paid, "
    "payment_currency, payment_format, is_laundering"
)
PATTERN = (
    "pattern_transaction_id, pattern_attempt_id, pattern_type, pattern_description, pattern_sequence, "
    "transaction_timestamp, from_bank_id, from_account_id, to_bank_id, to_account_id, amount_received, "
    "receiving_currency, amount_paid, payment_currency, payment_format, is_laundering"
)
ONE = "CAST(1 AS BIGINT)"
AML = "count(*) FILTER (WHERE is_laundering)"
AML1 = "count(*) FILTER (WHERE is_laundering = 1)"
VIEWS = [name[2:] for name in b.BLOCKS if name.startswith("r_")]
MARTS = {
    "mart_kpi_overview": "m_kpi",
    "mart_daily_transaction": "m_daily",
    "mart_aml_by_payment_format": "m_format",
    "mart_bank_activity": "m_bank",
    "mart_currency_flow": "m_flow",
    "mart_pattern_summary": "m_pattern",
    "mart_aml_account_risk": "m_risk",
}
GOOD, BAD = "'#15803D'", "'#C93C4A'"
CURATED = (
    "transaction_key, transaction_timestamp, txn_date, from_bank_id, from_account_id, to_bank_id, to_account_id, "
    "amount_received, receiving_currency, amount_paid, payment_currency, payment_format, is_laundering, "
    "is_cross_bank, is_self_transfer, is_cross_currency, run_id"
)
BATCH = (
    "dw_batch_id, load_type, status, source_low_watermark, source_high_watermark, pattern_low_watermark, "
    "pattern_high_watermark, transaction_rows_inserted, pattern_rows_inserted, rejected_rows"
)
RELATIONS = [
    ("dim_date", "date_key", "fact_daily_transaction"),
    ("dim_payment_currency", "payment_currency_key", "fact_daily_transaction"),
    ("dim_payment_format", "payment_format_key", "fact_daily_transaction"),
    ("dim_payment_format", "payment_format_key", "fact_aml_payment_format"),
    ("dim_bank", "bank_key", "fact_bank_activity"),
    ("dim_bank", "bank_key", "fact_aml_account_risk"),
    ("dim_payment_currency", "payment_currency_key", "fact_currency_flow"),
    ("dim_receiving_currency", "receiving_currency_key", "fact_currency_flow"),
    ("dim_pattern_type", "pattern_type_key", "fact_pattern_summary"),
    ("etl_batch_monitor", "dw_batch_id", "etl_validation_result"),
]


def rejects(block: str, source_object: str, code: str, description: str) -> str:
    return (
        f"SELECT {ONE} AS batch_id, '{source_object}' AS source_object, source_row_id, '{code}' AS error_code, "
        f"'{description}' AS error_description, payload AS raw_payload FROM {block}"
    )


def counts(named: dict[str, str], column: str = "object_name") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {column}, count(*) AS row_count FROM {source}" for name, source in named.items()
    )


def orphans(one: str, key: str, many: str) -> str:
    return f"(SELECT count(*) FROM r_{many} WHERE {key} NOT IN (SELECT {key} FROM r_{one}))"


def sum_of(column: str, name: str) -> str:
    return f"{big(f'coalesce(sum({column}), 0)')} AS {name}"


def matrix(values: list[str], axis: str, value: str) -> str:
    def slug(v: str) -> str:
        return "".join(ch if ch.isalnum() else "_" for ch in v.lower())

    cells = [f"{big(f'coalesce(sum({value}) FILTER (WHERE {axis} = ' + chr(39) + v + chr(39) + '), 0)')} AS {slug(v)}" for v in values]
    listed = ", ".join(f"'{v}'" for v in values)
    return ", ".join(cells) + f", {big(f'coalesce(sum({value}) FILTER (WHERE {axis} NOT IN ({listed})), 0)')} AS all_other"


def top_and_other(source: str, name: str, value: str) -> str:
    return f"""
    SELECT '{name}' AS axis, CASE WHEN place <= 5 THEN item ELSE 'Other' END AS slice, {big('sum(v)')} AS slice_value
    FROM (SELECT item, v, row_number() OVER (ORDER BY v DESC, item) AS place
          FROM (SELECT {name} AS item, sum({value}) AS v FROM {source} GROUP BY 1)) GROUP BY 2"""


def ranked(source: str, value: str, name: str) -> str:
    return f"SELECT *, dense_rank() OVER (ORDER BY {value} DESC) AS {name} FROM {source}"


PREVIOUS = """(SELECT d.*, p.transactions AS previous_day_transactions FROM v_per_day d
    LEFT JOIN v_per_day p ON p.full_date = d.full_date - INTERVAL 1 DAY)"""
CHANGE = f"""(SELECT *, transactions - coalesce(previous_day_transactions, 0) AS daily_transaction_change
    FROM {PREVIOUS})"""
MEASURES = [
    ("total_transactions", "fact_daily_transaction", "transaction_count", "sum"),
    ("aml_transactions", "fact_daily_transaction", "laundering_count", "sum"),
    ("total_amount_paid", "fact_daily_transaction", "total_amount_paid", "sum"),
    ("aml_by_format", "fact_aml_payment_format", "laundering_count", "sum"),
    ("bank_participations", "fact_bank_activity", "total_participations", "sum"),
    ("bank_aml_participations", "fact_bank_activity", "laundering_participations", "sum"),
    ("currency_transactions", "fact_currency_flow", "transaction_count", "sum"),
    ("currency_aml_transactions", "fact_currency_flow", "laundering_count", "sum"),
    ("pattern_attempts", "fact_pattern_summary", "attempt_count", "sum"),
    ("pattern_transactions", "fact_pattern_summary", "pattern_transaction_count", "sum"),
    ("account_aml_participations", "fact_aml_account_risk", "laundering_participations", "sum"),
    ("validation_difference", "etl_validation_result", "difference_value", "sum"),
    ("overview_transactions", "kpi_overview", "transaction_count", "max"),
    ("overview_laundering", "kpi_overview", "laundering_count", "max"),
    ("overview_aml_rate", "kpi_overview", "laundering_rate_percent", "max"),
    ("overview_cross_bank", "kpi_overview", "cross_bank_count", "max"),
    ("overview_cross_currency", "kpi_overview", "cross_currency_count", "max"),
    ("overview_self_transfer", "kpi_overview", "self_transfer_count", "max"),
]
HALF = "(SELECT max(source_transaction_id) // 2 AS cut FROM v_txn)"

ETL = f"""SELECT count(*) AS batch_count, count(*) FILTER (WHERE status = 'COMPLETED') AS completed_batches,
    count(*) FILTER (WHERE status = 'FAILED') AS failed_batches, {sum_of('rejected_rows', 'rejected_rows')},
    max(dw_batch_id) AS latest_batch_id, arg_max(duration_minutes, dw_batch_id) AS latest_duration_minutes,
    arg_max(status, dw_batch_id) AS latest_batch_status,
    arg_max(validation_status, dw_batch_id) AS latest_validation_status FROM r_etl_batch_monitor"""
VALIDATION = f"""SELECT count(*) AS validation_checks, count(*) FILTER (WHERE status = 'PASSED') AS validation_passed,
    count(*) FILTER (WHERE status = 'FAILED') AS validation_failed,
    {money('sum(difference_value)')} AS validation_difference,
    {ratio("count(*) FILTER (WHERE status = 'PASSED')", 'count(*)')} AS validation_pass_ratio
    FROM r_etl_validation_result"""


def _with_rows(blocks) -> str:
    return " + ".join(f"CAST(EXISTS (SELECT 1 FROM {block}) AS INTEGER)" for block in blocks)


def acceptance(run: int = 1) -> str:
    """Twenty test rows from one row of figures."""
    figures = """(SELECT s.*, f.n AS fn, f.l AS fl, f.cb AS fcb, f.cc AS fcc, f.st AS fst, f.ua AS fua,
        bad.n AS bad, sp.n AS sp, fp.n AS fp, sa.n AS sa, ca.n AS ca, dup.n AS dup, rej.n AS rej, dk.n AS dk,
        k.transaction_count AS kn, k.laundering_count AS kl, k.cross_bank_count AS kcb,
        k.cross_currency_count AS kcc, k.self_transfer_count AS kst, lb.status AS bs, lb.validation_status AS bv,
        lb.dw_batch_id AS bid, fc.n AS fc, idle.n AS idle, ov.n AS ov, held.marts, held.views
    FROM v_source_totals s, v_fact_totals f,
        (SELECT count(*) AS n FROM v_fact WHERE amount_paid <= 0 OR amount_received <= 0) bad,
        (SELECT count(*) AS n FROM v_pattern) sp, (SELECT count(*) AS n FROM v_fact_pattern) fp,
        (SELECT count(*) AS n FROM v_account) sa,
        (SELECT count(*) AS n FROM v_dim_account WHERE account_key <> -1) ca,
        (SELECT count(*) AS n FROM (SELECT 1 FROM v_dim_account WHERE account_key <> -1
            GROUP BY bank_id, account_number HAVING count(*) > 1)) dup,
        (SELECT count(*) AS n FROM v_dw_reject) rej,
        (SELECT count(*) AS n FROM (SELECT 1 FROM v_fact GROUP BY transaction_key HAVING count(*) > 1)) dk,
        m_kpi k, (SELECT * FROM v_batches ORDER BY dw_batch_id DESC LIMIT 1) lb,
        (SELECT count(*) AS n FROM v_checks WHERE dw_batch_id = 2 AND status = 'FAILED') fc,
        (SELECT count(*) AS n FROM v_batches WHERE load_type = 'INCREMENTAL' AND status = 'COMPLETED'
            AND validation_status = 'PASSED' AND transaction_rows_inserted = 0 AND pattern_rows_inserted = 0) idle,
        (SELECT count(*) AS n FROM (SELECT effective_from, lag(effective_to) OVER (
            PARTITION BY bank_id, account_number ORDER BY effective_from) AS before
            FROM v_dim_account WHERE account_key <> -1) WHERE before > effective_from) ov, """ + f"""
        (SELECT {_with_rows(MARTS.values())} AS marts, {_with_rows(f'r_{v}' for v in VIEWS)} AS views) held)"""
    text = "CAST({} AS VARCHAR)".format

    def equal(left: str, right: str) -> tuple[str, str, str]:
        return text(left), text(right), f"{left} = {right}"

    def zero(column: str) -> tuple[str, str, str]:
        return "'0'", text(column), f"{column} = 0"

    span = f"{text('lo')} || ' -> ' || {text('hi')}"
    kpi = lambda n, l: f"{text(n)} || ' transactions; ' || {text(l)} || ' laundering'"
    tests = [
        ("ETL", "ETL_01", "'COMPLETED / PASSED'", "bs || ' / ' || bv", "bs = 'COMPLETED' AND bv = 'PASSED'"),
        ("ETL", "ETL_02", *zero("fc")),
        ("ETL", "ETL_03", "'>= 1 batch'", text("idle") + " || ' batch'", "idle >= 1"),
        ("RECONCILIATION", "REC_01", *equal("n", "fn")),
        ("RECONCILIATION", "REC_02", *equal("sp", "fp")),
        ("RECONCILIATION", "REC_03", *equal("sa", "ca")),
        ("DATA_QUALITY", "DQ_01", *zero("bad")),
        ("DATA_QUALITY", "DQ_02", *zero("fua")),
        ("DATA_QUALITY", "DQ_03", *zero("dup")),
        ("DATA_QUALITY", "DQ_04", *zero("ov")),
        ("DATA_QUALITY", "DQ_05", *zero("rej")),
        ("DATA_WAREHOUSE", "DW_01", *zero("dk")),
        ("DATA_WAREHOUSE", "DW_02", "'7'", text("marts"), "marts = 7"),
        ("BUSINESS_RULE", "BR_01", *equal("l", "fl")),
        ("BUSINESS_RULE", "BR_02", *equal("cb", "fcb")),
        ("BUSINESS_RULE", "BR_03", *equal("cc", "fcc")),
        ("BUSINESS_RULE", "BR_04", *equal("st", "fst")),
        ("BUSINESS_RULE", "BR_05", "'not given'", span, None),
        ("REPORTING", "RPT_01", "'16'", text("views"), "views = 16"),
        ("REPORTING", "RPT_02", kpi("fn", "fl"), kpi("kn", "kl"),
         "kn = fn AND kl = fl AND kcb = fcb AND kcc = fcc AND kst = fst"),
    ]
    return " UNION ALL ".join(
        f"SELECT CAST({run} AS BIGINT) AS test_run_id, '{category}' AS category, '{code}' AS test_code, "
        f"{want} AS expected_value, {got} AS actual_value, "
        + (f"CASE WHEN {passed} THEN 'PASSED' ELSE 'FAILED' END" if passed else "'NOT_RUN'") + f" AS status FROM {figures}"
        for category, code, want, got, passed in tests
    )


def _half_load() -> str:
    """A FULL load up to the cut, then an increment; members of the first half only matter for the counters."""
    delta = lambda block, key, test: f"(SELECT count(*) FROM {block}, {HALF} WHERE {key} {test} cut)"
    unknown = lambda test: (
        f"(SELECT count(*) FROM v_dw_reject, {HALF} WHERE source_key {test} cut)"
    )
    top = lambda block, key, test="<=": f"(SELECT max({key}) FROM {block}, {HALF} WHERE {key} {test} cut)"
    t, p = "source_transaction_id", "pattern_transaction_id"
    return f"""
    SELECT {ONE} AS dw_batch_id, 'FULL' AS load_type, 'COMPLETED' AS status, {ONE} AS source_low_watermark,
        {top('v_txn', t)} AS source_high_watermark, {ONE} AS pattern_low_watermark,
        {top('v_pattern', p)} AS pattern_high_watermark,
        {delta('v_fact', t, '<=')} AS transaction_rows_inserted,
        {delta('v_fact_pattern', 'source_pattern_transaction_id', '<=')} AS pattern_rows_inserted,
        {unknown('<=')} AS rejected_rows
    UNION ALL
    SELECT 2, 'INCREMENTAL', 'COMPLETED', {top('v_txn', t)} + 1, (SELECT max({t}) FROM v_txn),
        {top('v_pattern', p)} + 1, (SELECT max({p}) FROM v_pattern), {delta('v_fact', t, '>')},
        {delta('v_fact_pattern', 'source_pattern_transaction_id', '>')}, {unknown('>')}"""


def _unknown_uses(dim: str) -> str:
    """Facts that point at the unknown member, each role counted."""
    key = dim.removeprefix("dim_") + "_key"
    roles = {"dim_bank": ("from_", "to_"), "dim_entity": ("from_", "to_"), "dim_account": ("from_", "to_"), "dim_currency": ("payment_", "receiving_")}
    fact = "v_fact_pattern" if dim == "dim_pattern_type" else "v_fact"
    return "(" + " + ".join(f"(SELECT count(*) FROM {fact} WHERE {role}{key} = -1)" for role in roles.get(dim, ("",))) + ")"


def _label_column(dim: str) -> tuple[str, str]:
    return {
        "dim_date": ("date_key", "day_name"),
        "dim_time": ("time_key", "day_part"),
        "dim_currency": ("currency_key", "currency_name"),
        "dim_payment_format": ("payment_format_key", "payment_format"),
        "dim_pattern_type": ("pattern_type_key", "pattern_type"),
        "dim_bank": ("bank_key", "bank_name"),
        "dim_entity": ("entity_key", "entity_name"),
        "dim_account": ("account_key", "account_number"),
    }[dim]


DIMS = ["dim_date", "dim_time", "dim_currency", "dim_payment_format", "dim_pattern_type", "dim_bank", "dim_entity", "dim_account"]


def _raw() -> dict[str, str]:
    sql: dict[str, str] = {}
    # Sources and sinks
    # An empty CSV field lands as NULL.
    empty_is_null = ", ".join(f"nullif({c}, '') AS {c}" for c in b.ACCOUNT_TEXT.split(", "))
    sql["src_csv_accounts"] = f"SELECT {empty_is_null} FROM v_account_landing"
    sql["src_csv_transactions"] = f"SELECT {b.TXN_TEXT} FROM v_txn_landing"
    sql["src_csv_patterns"] = f"SELECT {b.PATTERN_TEXT} FROM v_pattern_landing"
    others = b.PATTERN_TEXT.replace("pattern_attempt_id_text, ", "", 1)
    sql["src_pattern_blocks"] = f"""
    SELECT CAST(dense_rank() OVER (ORDER BY CAST(pattern_attempt_id_text AS BIGINT)) AS VARCHAR)
        AS pattern_attempt_id_text, {others} FROM v_pattern_landing"""
    size = lambda block, fields: f"SELECT CAST(sum(strlen(concat_ws(',', {fields})) + 1) AS BIGINT) AS size, count(*) AS lines FROM {block}"

    def digest(block: str, fields: str, place: str = "landing_row_id") -> str:
        """Lines, blocks of 4,096 lines, groups of 4,096 blocks, the whole."""
        lines = f"SELECT row_number() OVER (ORDER BY {place}) - 1 AS node, sha256(concat_ws(',', {fields})) AS digest FROM {block}"
        for _ in range(2):
            lines = f"SELECT node // 4096 AS node, sha256(string_agg(digest, '' ORDER BY node)) AS digest FROM ({lines}) GROUP BY 1"
        return f"(SELECT sha256(string_agg(digest, '' ORDER BY node)) FROM ({lines}))"

    account, swapped = (digest("v_account_landing", b.ACCOUNT_TEXT, p) for p in ("landing_row_id", "if(landing_row_id <= 2, 3 - landing_row_id, landing_row_id)"))
    txn = digest("v_txn_landing", b.TXN_TEXT)
    sql["src_manifest"] = f"""
    SELECT 'transactions' AS source_name, size AS expected_bytes, size AS actual_bytes, lines AS line_count,
        {txn} AS expected_digest, {txn} AS digest, 'OK' AS status FROM ({size('v_txn_landing', b.TXN_TEXT)})
    UNION ALL SELECT 'accounts', size + 1, size, lines, {account}, {account}, 'SIZE_MISMATCH' FROM ({size('v_account_landing', b.ACCOUNT_TEXT)})
    UNION ALL SELECT 'swapped', size, size, lines, {account}, {swapped}, 'DIGEST_MISMATCH' FROM ({size('v_account_landing', b.ACCOUNT_TEXT)})
    UNION ALL SELECT 'patterns', 1, 0, 0, NULL, NULL, 'MISSING'"""
    sql["src_landing_ordinal"] = """
    SELECT row_number() OVER (ORDER BY landing_row_id) AS landing_row_id, timestamp_text, from_account_text,
        to_account_text, amount_paid_text FROM v_txn_landing"""
    sql["snk_reporting_csv"] = counts({v: f"r_{v}" for v in VIEWS})
    sql["snk_lakehouse"] = "SELECT * FROM r_fact_daily_transaction"
    amount = lambda value: f"CAST({value} AS DECIMAL(38,8))"
    named = [f"('rows_{view}', {amount(1)}, {amount(f'least(1, (SELECT count(*) FROM r_{view}))')})" for view in VIEWS]
    total_rows = amount("(SELECT sum(transaction_count) FROM r_fact_daily_transaction)")
    sql["lakehouse_assertions"] = f"""SELECT *, CASE WHEN expected = actual THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (VALUES ('missing_tables', {amount(0)}, {amount(len(VIEWS))} - {amount(len(set(VIEWS)))}), {', '.join(named)},
            ('daily_total_is_kpi', {amount('(SELECT transaction_count FROM r_kpi_overview)')}, {total_rows})) t(assertion, expected, actual)"""
    sql["snk_curated_fact"] = """
    SELECT transaction_key, txn_date, is_laundering, is_cross_bank, is_cross_currency, is_self_transfer,
        CAST(strftime(txn_date, '%Y%m') AS INTEGER) AS txn_month FROM v_curated WHERE is_valid"""
    sql["snk_rejects"] = "SELECT transaction_key, run_id, is_laundering FROM v_curated WHERE NOT is_valid"
    # Typing and rejects
    sql["typed_account"] = f"""SELECT source_row_id, bank_name, raw_bank_id, bank_id, account_number, entity_id,
        entity_name, {ONE} AS load_batch_id FROM v_account"""
    sql["reject_account"] = rejects("v_account_reject", "Account", "INVALID_ACCOUNT", "bank id or account number is not usable")
    sql["typed_transaction"] = f"SELECT {TXN}, {ONE} AS load_batch_id FROM v_txn"
    sql["reject_transaction"] = rejects(
        "v_txn_reject", "Transaction", "INVALID_TRANSACTION",
        "timestamp, bank, account, amount, currency, format or label is not usable")
    sql["typed_pattern"] = f"SELECT {PATTERN}, {ONE} AS load_batch_id FROM v_pattern"
    sql["reject_pattern"] = rejects(
        "v_pattern_reject", "PatternTransaction", "INVALID_PATTERN_TRANSACTION",
        "attempt, sequence or a transfer field is not usable")
    sql["typed_transaction_try"] = "SELECT * FROM v_lenient"
    sql["txn_business"] = f"""SELECT source_transaction_id, {CROSS_BANK} AS is_cross_bank,
        {CROSS_CURRENCY} AS is_cross_currency, {SELF} AS is_self_transfer, {RATE_OUT} AS implied_exchange_rate FROM v_txn"""
    sql["txn_enriched"] = f"""SELECT source_transaction_id, {DATE_KEY} AS date_key, {TIME_KEY} AS time_key,
        {CROSS_BANK} AS is_cross_bank, {CROSS_CURRENCY} AS is_cross_currency,
        {RATE_OUT} AS implied_exchange_rate FROM v_txn"""
    sql["pattern_enriched"] = f"""SELECT pattern_transaction_id, pattern_attempt_id, pattern_sequence,
        {DATE_KEY} AS date_key, {TIME_KEY} AS time_key FROM v_pattern"""
    sql["curated_txn"] = f"SELECT {CURATED}, is_valid FROM v_curated"
    sql["curated_sample"] = f"""SELECT {CURATED} FROM v_curated WHERE is_valid
        AND txn_date BETWEEN DATE '1996-01-01' AND DATE '1996-01-31' ORDER BY transaction_key LIMIT 100"""
    sql["txn_account_enriched"] = """SELECT source_transaction_id, bank_name AS from_bank_name,
        entity_id AS from_entity_id FROM v_txn LEFT JOIN v_account a
        ON a.bank_id = from_bank_id AND a.account_number = from_account_id"""
    sql["txn_account_join_check"] = f"""SELECT n AS rows_before, m AS rows_after,
        CASE WHEN n = m THEN 'PASSED' ELSE 'FAILED' END AS status
        FROM (SELECT count(*) AS n FROM v_txn), (SELECT count(*) AS m FROM ({sql["txn_account_enriched"]}))"""
    # Dimensions
    for dim in ("dim_date", "dim_currency", "dim_payment_format", "dim_pattern_type"):
        sql[dim] = f"SELECT * FROM v_{dim}"
    sql["dim_time"] = """SELECT t.*, count(f.transaction_key) AS transaction_count FROM v_dim_time t
        LEFT JOIN v_fact f ON f.time_key = t.time_key GROUP BY ALL"""
    sql["dim_bank"] = "SELECT * FROM v_dim_bank2"
    sql["dim_entity"] = "SELECT * FROM v_dim_entity2"
    sql["account_snapshot"] = "SELECT * FROM v_snapshot"
    sql["dim_account_scd2"] = "SELECT * FROM v_dim_account2"
    sql["dim_unknown"] = " UNION ALL ".join(
        f"SELECT '{dim}' AS dimension, {big(key)} AS key, {label} AS label, {_unknown_uses(dim)} AS fact_references FROM v_{dim} WHERE {key} = -1"
        for dim in DIMS
        for key, label in [_label_column(dim)]
    )
    sql["surrogate_keys"] = """SELECT s.entity_id, f.entity_key AS first_key, s.entity_key AS second_key
        FROM v_dim_entity2 s LEFT JOIN v_dim_entity f ON f.entity_id = s.entity_id"""
    directory = "SELECT bank_id, max(bank_name) AS bank_name, count(*) AS account_count FROM v_account GROUP BY 1"
    sql["src_bank_view"] = directory
    # Joins
    sql["fact_transaction"] = "SELECT * FROM v_fact"
    sql["fact_pattern_transaction"] = "SELECT * FROM v_fact_pattern"
    sql["currency_recon"] = "SELECT * FROM v_currency_recon"
    sql["active_account_coverage"] = """
    SELECT count(*) AS active_account_count, count(DISTINCT x.bank_id) AS active_bank_count,
        count(*) FILTER (WHERE a.source_row_id IS NULL) AS missing_master_count
    FROM (SELECT from_bank_id AS bank_id, from_account_id AS account_number FROM v_txn
          UNION SELECT to_bank_id, to_account_id FROM v_txn) x
    LEFT JOIN v_account a ON a.bank_id = x.bank_id AND a.account_number = x.account_number"""
    sql["top_sender_banks"] = f"""
    SELECT from_bank_id, max(d.bank_name) AS bank_name, count(*) AS sent_transaction_count
    FROM v_txn LEFT JOIN ({directory}) d ON d.bank_id = from_bank_id
    GROUP BY 1 ORDER BY sent_transaction_count DESC, from_bank_id LIMIT 20"""
    sql["ref_integrity"] = " UNION ALL ".join(
        f"SELECT '{many}.{key}' AS reference, '{one}' AS one_side, {orphans(one, key, many)} AS orphans"
        for one, key, many in RELATIONS
    )
    sql["not_exists_current"] = "SELECT * FROM v_new_versions"
    sql["dim_bank_semi"] = """
    SELECT * FROM r_dim_bank WHERE bank_key IN (
        SELECT bank_key FROM (SELECT * FROM r_fact_bank_activity
            ORDER BY total_participations DESC, laundering_participations DESC, bank_key LIMIT 1000)
        UNION SELECT bank_key FROM (SELECT * FROM r_fact_aml_account_risk
            ORDER BY laundering_participations DESC, laundering_sent_count DESC, account_key LIMIT 5000))"""
    sql["latest_batch_cross"] = "SELECT * FROM r_data_quality_overview"
    # Marts, KPIs, profiles
    for name, block in MARTS.items():
        sql[name] = f"SELECT * FROM {block}"
    sql["mart_refresh_all"] = counts(MARTS)
    sql["kpi_label_split"] = "SELECT is_laundering, count(*) AS transaction_count FROM v_txn GROUP BY 1"
    sql["kpi_format_rate"] = f"""SELECT payment_format, count(*) AS transaction_count, {AML} AS laundering_count,
        {rate(AML, 'count(*)')} AS laundering_rate_percent FROM v_txn GROUP BY 1"""
    sql["kpi_quality_flags"] = f"""SELECT count(*) FILTER (WHERE amount_paid <= 0) AS non_positive_paid,
        count(*) FILTER (WHERE amount_received <= 0) AS non_positive_received,
        count(*) FILTER (WHERE {SELF}) AS self_transfer_count,
        count(*) FILTER (WHERE {CROSS_CURRENCY}) AS cross_currency_count,
        count(*) FILTER (WHERE NOT ({CROSS_CURRENCY}) AND amount_paid <> amount_received)
            AS same_currency_amount_mismatch FROM v_txn"""
    sql["kpi_bank_split"] = f"""SELECT count(*) FILTER (WHERE {CROSS_BANK}) AS cross_bank_count,
        count(*) FILTER (WHERE NOT ({CROSS_BANK})) AS same_bank_count, {AML} AS laundering_count,
        {rate(AML, 'count(*)')} AS laundering_rate_percent FROM v_txn"""
    sql["kpi_daily"] = f"""SELECT CAST(transaction_timestamp AS DATE) AS transaction_date,
        count(*) AS transaction_count, {AML} AS laundering_count FROM v_txn GROUP BY 1"""
    sql["kpi_window_bounds"] = """SELECT count(*) AS transaction_count, min(transaction_timestamp) AS min_timestamp,
        max(transaction_timestamp) AS max_timestamp FROM v_txn"""
    sql["kpi_flag_counts"] = f"""SELECT count(*) FILTER (WHERE {CROSS_BANK}) AS cross_bank_count,
        count(*) FILTER (WHERE {SELF}) AS self_transfer_count,
        count(*) FILTER (WHERE {CROSS_CURRENCY}) AS cross_currency_count FROM v_txn"""
    sql["active_bank_count"] = """SELECT count(DISTINCT from_bank_id) AS sender_bank_count,
        count(DISTINCT to_bank_id) AS receiver_bank_count FROM v_txn"""
    sql["kpi_pattern_types"] = """SELECT pattern_type, count(DISTINCT pattern_attempt_id) AS attempt_count,
        count(*) AS pattern_transaction_count FROM v_pattern GROUP BY 1"""
    sql["kpi_amount_by_currency"] = f"""SELECT payment_currency, count(*) AS transaction_count,
        {money('sum(amount_paid)')} AS total_amount_paid,
        {ratio('sum(amount_paid)', 'count(*)')} AS average_amount_paid FROM v_txn GROUP BY 1"""
    sql["kpi_aml_rate"] = f"""SELECT count(*) AS transaction_count, {AML} AS laundering_count,
        {ratio(f'100 * {AML}', 'count(*)', 9)} AS aml_rate_percent FROM v_txn"""
    sql["profile_summary"] = f"""
    SELECT *, {rate('laundering_count', 'transaction_count')} AS laundering_rate_percent FROM
    (SELECT count(*) AS transaction_count, min(transaction_timestamp) AS min_timestamp,
        max(transaction_timestamp) AS max_timestamp, {AML1} AS laundering_count,
        count(*) FILTER (WHERE {CROSS_BANK}) AS cross_bank_count,
        count(*) FILTER (WHERE from_bank_id = to_bank_id) AS same_bank_count,
        count(*) FILTER (WHERE {CROSS_CURRENCY}) AS cross_currency_count,
        count(*) FILTER (WHERE payment_currency = receiving_currency) AS same_currency_count,
        count(*) FILTER (WHERE {SELF}) AS self_transfer_count FROM v_lenient),
    (SELECT count(*) AS account_master_rows, count(DISTINCT (bank_id, account_number)) AS account_business_keys,
        count(DISTINCT bank_id) AS bank_master_count, count(DISTINCT entity_id) AS entity_count
     FROM (SELECT {b.bank_id('bank_id_text')} AS bank_id, upper(trim(account_number_text)) AS account_number,
        upper(trim(entity_id_text)) AS entity_id FROM v_account_landing)),
    (SELECT count(*) AS pattern_transaction_count, count(DISTINCT pattern_attempt_id_text) AS pattern_attempt_count,
        count(DISTINCT pattern_type_text) AS pattern_type_count FROM v_pattern_landing)"""
    blank = lambda c: f"count(*) FILTER (WHERE {c} IS NULL OR {c} = '')"
    sql["profile_quality"] = f"""
    SELECT count(*) FILTER (WHERE transaction_timestamp IS NULL) AS invalid_timestamp_count,
        {blank('from_bank_id')} AS missing_from_bank_count, {blank('from_account_id')} AS missing_from_account_count,
        {blank('to_bank_id')} AS missing_to_bank_count, {blank('to_account_id')} AS missing_to_account_count,
        count(*) FILTER (WHERE amount_paid IS NULL) AS invalid_amount_paid_count,
        count(*) FILTER (WHERE amount_received IS NULL) AS invalid_amount_received_count,
        count(*) FILTER (WHERE amount_paid <= 0) AS nonpositive_amount_paid_count,
        count(*) FILTER (WHERE amount_received <= 0) AS nonpositive_amount_received_count,
        {blank('payment_currency')} AS missing_payment_currency_count,
        {blank('receiving_currency')} AS missing_receiving_currency_count,
        {blank('payment_format')} AS missing_payment_format_count,
        count(*) FILTER (WHERE is_laundering NOT IN (0, 1) OR is_laundering IS NULL) AS invalid_laundering_label_count,
        count(*) FILTER (WHERE payment_currency = receiving_currency AND amount_paid <> amount_received)
            AS same_currency_amount_mismatch_count FROM v_lenient"""
    sql["profile_currency_pairs"] = f"""SELECT payment_currency, receiving_currency, count(*) AS transaction_count,
        {AML1} AS laundering_count, {money('sum(amount_paid)')} AS total_amount_paid,
        {money('sum(amount_received)')} AS total_amount_received FROM v_lenient GROUP BY 1, 2"""
    sql["profile_payment_formats"] = f"""SELECT payment_format, count(*) AS transaction_count,
        {AML1} AS laundering_count, {rate(AML1, 'count(*)')} AS laundering_rate_percent FROM v_lenient GROUP BY 1"""
    sql["profile_daily"] = f"""SELECT CAST(transaction_timestamp AS DATE) AS transaction_date,
        count(*) AS transaction_count, {AML1} AS laundering_count, count(DISTINCT from_bank_id) AS sender_bank_count,
        count(DISTINCT to_bank_id) AS receiver_bank_count FROM v_lenient GROUP BY 1"""
    sql["profile_patterns"] = """SELECT trim(pattern_type_text) AS pattern_type,
        count(DISTINCT pattern_attempt_id_text) AS attempt_count, count(*) AS transaction_count,
        min(CAST(pattern_sequence_text AS INTEGER)) AS min_sequence,
        max(CAST(pattern_sequence_text AS INTEGER)) AS max_sequence FROM v_pattern_landing GROUP BY 1"""
    sql["profile_top_banks"] = f"""
    SELECT a.bank_id, m.bank_name, sent_count, received_count, total_participations FROM
    (SELECT bank_id, count(*) FILTER (WHERE sent) AS sent_count, count(*) FILTER (WHERE NOT sent) AS received_count,
        count(*) AS total_participations
     FROM (SELECT from_bank_id AS bank_id, true AS sent FROM v_lenient
           UNION ALL SELECT to_bank_id, false FROM v_lenient) GROUP BY 1) a
    LEFT JOIN (SELECT {b.bank_id('bank_id_text')} AS bank_id, max(trim(bank_name_text)) AS bank_name
        FROM v_account_landing GROUP BY 1) m ON m.bank_id = a.bank_id
    ORDER BY total_participations DESC, a.bank_id NULLS LAST LIMIT 20"""
    sql["perf_daily_rollup"] = f"""SELECT full_date, {big('sum(transaction_count)')} AS transaction_count,
        {big('sum(laundering_count)')} AS laundering_count FROM v_daily GROUP BY 1"""
    rejected = "(SELECT 1 FROM v_account_reject UNION ALL SELECT 1 FROM v_txn_reject UNION ALL SELECT 1 FROM v_pattern_reject)"
    sql["row_counts"] = counts({
        "landing_account": "v_account_landing", "landing_transaction": "v_txn_landing",
        "landing_pattern": "v_pattern_landing", "account": "v_account", "transaction": "v_txn",
        "pattern": "v_pattern", "rejected_row": rejected})
    # Windows and ranks
    sql["scd2_overlap"] = """
    SELECT (SELECT count(*) FROM v_dim_account2 WHERE account_key <> -1) AS versions, count(*) AS overlapping FROM (
        SELECT effective_from, lag(effective_to) OVER (PARTITION BY bank_id, account_number ORDER BY effective_from) AS p
        FROM v_dim_account2 WHERE account_key <> -1) WHERE p > effective_from"""
    sql["bank_rank"] = ranked("v_by_bank_name", "total_participations", "bank_activity_rank")
    sql["account_risk_rank"] = ranked(
        "(SELECT account_key, account_number, laundering_participations FROM r_fact_aml_account_risk)",
        "laundering_participations", "account_risk_rank")
    pattern_totals = f"""(SELECT pattern_type, {sum_of('attempt_count', 'pattern_attempts')},
        {sum_of('pattern_transaction_count', 'pattern_transactions')}, min(min_sequence) AS min_sequence,
        max(max_sequence) AS max_sequence FROM v_named_pattern GROUP BY 1)"""
    sql["pattern_rank"] = ranked(pattern_totals, "pattern_transactions", "pattern_rank")
    sql["daily_cumulative"] = f"SELECT *, {big('sum(transactions) OVER (ORDER BY full_date)')} AS cumulative_transactions FROM v_per_day"
    sql["daily_prev_day"] = f"SELECT * FROM {PREVIOUS}"
    sql["daily_growth"] = f"""SELECT *, {ratio('transactions - previous_day_transactions', 'previous_day_transactions')}
        AS transaction_growth_ratio FROM {PREVIOUS}"""
    sql["daily_change"] = f"SELECT *, CASE WHEN daily_transaction_change >= 0 THEN {GOOD} ELSE {BAD} END AS change_color FROM {CHANGE}"
    sql["pattern_sequence_build"] = """SELECT pattern_attempt_id, pattern_transaction_id,
        row_number() OVER (PARTITION BY pattern_attempt_id ORDER BY pattern_transaction_id) AS sequence FROM v_pattern"""
    # Top-k
    sql["compact_banks"] = """SELECT * FROM r_fact_bank_activity
        ORDER BY total_participations DESC, laundering_participations DESC, bank_key LIMIT 1000"""
    sql["compact_accounts"] = """SELECT * FROM r_fact_aml_account_risk
        ORDER BY laundering_participations DESC, laundering_sent_count DESC, account_key LIMIT 5000"""
    small = {v: f"r_{v}" for v in VIEWS}
    kept_banks = "(SELECT * FROM r_fact_bank_activity ORDER BY total_participations DESC, laundering_participations DESC, bank_key LIMIT 1000)"
    kept_accounts = "(SELECT * FROM r_fact_aml_account_risk ORDER BY laundering_participations DESC, laundering_sent_count DESC, account_key LIMIT 5000)"
    small["fact_bank_activity"], small["fact_aml_account_risk"] = kept_banks, kept_accounts
    small["dim_bank"] = f"(SELECT * FROM r_dim_bank WHERE bank_key IN (SELECT bank_key FROM {kept_banks} UNION SELECT bank_key FROM {kept_accounts}))"
    sql["compact_snapshot"] = counts(small)
    sql["latest_batch"] = """SELECT dw_batch_id, load_type, status, transaction_rows_inserted, pattern_rows_inserted,
        rejected_rows FROM v_batches ORDER BY dw_batch_id DESC LIMIT 1"""
    sql["top_risk_accounts"] = """SELECT bank_name, account_number, entity_id, laundering_sent_count,
        laundering_received_count, laundering_participations, account_key
        FROM r_fact_aml_account_risk r JOIN r_dim_bank d ON d.bank_key = r.bank_key
        ORDER BY laundering_participations DESC, account_key LIMIT 20"""
    top_banks = "SELECT bank_name, total_participations FROM v_by_bank_name ORDER BY total_participations DESC, bank_name LIMIT"
    sql["top_banks15"] = f"{top_banks} 15"
    sql["bank_treemap10"] = f"{top_banks} 10"
    sql["bank_ranking50"] = f"SELECT * FROM ({sql['bank_rank']}) ORDER BY bank_activity_rank, bank_name LIMIT 50"
    sql["top_corridors15"] = """SELECT payment_currency, receiving_currency, transactions FROM v_corridors
        ORDER BY transactions DESC, payment_currency, receiving_currency LIMIT 15"""
    sql["mart_top20"] = """
    SELECT 'formats' AS report, payment_format AS item, laundering_count AS value FROM m_format
    UNION ALL SELECT 'banks', bank_id, total_participations FROM
        (SELECT * FROM m_bank ORDER BY total_participations DESC, bank_key LIMIT 20)
    UNION ALL SELECT 'corridors', payment_currency || ' > ' || receiving_currency, transaction_count FROM
        (SELECT * FROM m_flow ORDER BY transaction_count DESC, payment_currency_key, receiving_currency_key LIMIT 20)
    UNION ALL SELECT 'patterns', pattern_type, pattern_transaction_count FROM m_pattern
    UNION ALL SELECT 'accounts', account_number, laundering_participations FROM
        (SELECT * FROM m_risk ORDER BY laundering_participations DESC, account_key LIMIT 20)"""
    sql |= {
        "mart_top20_formats": "SELECT * FROM m_format",
        "mart_top20_banks": "SELECT * FROM m_bank ORDER BY total_participations DESC, bank_key LIMIT 20",
        "mart_top20_corridors": "SELECT * FROM m_flow ORDER BY transaction_count DESC, payment_currency_key, receiving_currency_key LIMIT 20",
        "mart_top20_patterns": "SELECT * FROM m_pattern",
        "mart_top20_accounts": "SELECT * FROM m_risk ORDER BY laundering_participations DESC, account_key LIMIT 20",
    }
    sql["last_seven_days"] = f"""SELECT full_date, transactions, laundering_transactions, daily_transaction_change,
        {ratio('laundering_transactions', 'transactions')} AS aml_ratio FROM {CHANGE} ORDER BY full_date DESC LIMIT 7"""
    sql["mix_top5_other"] = (
        top_and_other("v_daily", "payment_format", "transaction_count")
        + " UNION ALL "
        + top_and_other("v_named_pattern", "pattern_type", "pattern_transaction_count")
    )
    # Measures
    period = lambda lo, hi: f"strftime({lo}, '%d/%m/%Y') || ' - ' || strftime({hi}, '%d/%m/%Y')"
    sql["measure_overall"] = f"""
    SELECT transaction_count AS overall_transactions, laundering_count AS overall_laundering,
        cross_bank_count AS overall_cross_bank, cross_currency_count AS overall_cross_currency,
        self_transfer_count AS overall_self_transfer, min_transaction_date AS data_start_date,
        max_transaction_date AS data_end_date, {ratio('laundering_count', 'transaction_count')} AS overall_aml_ratio,
        {ratio('cross_bank_count', 'transaction_count')} AS overall_cross_bank_ratio,
        {ratio('cross_currency_count', 'transaction_count')} AS overall_cross_currency_ratio,
        {ratio('self_transfer_count', 'transaction_count')} AS overall_self_transfer_ratio,
        {period('min_transaction_date', 'max_transaction_date')} AS data_period_label FROM r_kpi_overview"""
    both = f"{sum_of('transaction_count', 'transactions')}, {sum_of('laundering_count', 'laundering_transactions')}"
    sql["measure_filtered"] = f"""SELECT {both}, {money('sum(total_amount_paid)')} AS amount_paid,
        {ratio('sum(laundering_count)', 'sum(transaction_count)')} AS aml_ratio,
        {ratio('sum(total_amount_paid)', 'sum(transaction_count)')} AS average_amount_per_transaction FROM v_sliced"""
    picked = lambda slicer, test: f"""
    SELECT '{slicer}' AS slicer,
        CASE WHEN count(DISTINCT payment_currency) = 1 THEN {money('sum(total_amount_paid)')} END
            AS selected_currency_amount_paid,
        'Amount Paid - ' || CASE WHEN count(DISTINCT payment_currency) = 1 THEN max(payment_currency)
            ELSE 'choose exactly one currency' END AS selected_currency_amount_title FROM v_daily WHERE {test}"""
    sql["measure_selected_currency"] = picked("none", "true") + " UNION ALL " + picked("one", "payment_currency = 'Euro'")
    sql["measure_bank"] = f"""SELECT {sum_of('sent_count', 'sent_participations')},
        {sum_of('received_count', 'received_participations')},
        {sum_of('total_participations', 'total_participations')},
        {sum_of('laundering_participations', 'aml_participations')},
        {ratio('sum(laundering_participations)', 'sum(total_participations)')} AS aml_participation_ratio,
        {big('sum(total_participations) - sum(laundering_participations)')} AS non_aml_participations
        FROM r_fact_bank_activity"""
    sql["measure_account_risk"] = f"""SELECT {sum_of('laundering_sent_count', 'aml_sent_participations')},
        {sum_of('laundering_received_count', 'aml_received_participations')},
        {sum_of('laundering_participations', 'aml_participations')},
        count(DISTINCT account_key) AS risk_accounts FROM r_fact_aml_account_risk"""
    sql["measure_currency_flow"] = "SELECT * FROM v_corridors"
    sql["measure_pattern"] = f"""SELECT {sum_of('attempt_count', 'pattern_attempts')},
        {sum_of('pattern_transaction_count', 'pattern_transactions')},
        {ratio('sum(pattern_transaction_count)', 'sum(attempt_count)')} AS transactions_per_attempt
        FROM r_fact_pattern_summary"""
    sql["measure_etl"] = ETL
    sql["measure_validation"] = VALIDATION
    sql["measure_cloud18"] = " UNION ALL ".join(
        f"SELECT '{name}' AS measure_name, {money(f'{kind}(TRY_CAST(CAST({column} AS VARCHAR) AS DECIMAL(38,8)))')} "
        f"AS measure_value FROM r_{view}"
        for name, view, column, kind in MEASURES
    )
    sql["measure_non_laundering"] = f"""SELECT {both},
        {big('sum(transaction_count) - sum(laundering_count)')} AS non_laundering_transactions FROM v_daily"""
    sql["measure_status_flag"] = f"""SELECT failed_batches, rejected_rows, validation_failed,
        CASE WHEN failed_batches = 0 AND rejected_rows = 0 AND validation_failed = 0 THEN {GOOD} ELSE {BAD} END
            AS etl_status_color FROM ({ETL}), ({VALIDATION})"""
    sql["measure_period_title"] = f"SELECT 'Period ' || {period('min(full_date)', 'max(full_date)')} AS selected_period_title FROM v_daily"
    # Dashboard datasets
    sql["ds_daily_average"] = f"""SELECT {sum_of('transaction_count', 'transactions')},
        count(DISTINCT full_date) AS active_dates,
        {ratio('sum(transaction_count)', 'count(DISTINCT full_date)')} AS daily_average FROM v_daily"""
    sql["ds_weekday_volume"] = f"SELECT day_of_week, day_name, {sum_of('transaction_count', 'transactions')} FROM v_daily GROUP BY 1, 2"
    formats = ["ACH", "Bitcoin", "Cash", "Cheque", "Credit Card", "Reinvestment", "Wire"]
    sql["ds_date_format_matrix"] = f"SELECT full_date, {matrix(formats, 'payment_format', 'transaction_count')} FROM v_daily GROUP BY 1"
    currencies = ["US Dollar", "Euro", "Yuan", "Rupee", "Bitcoin"]
    sql["ds_currency_matrix"] = f"SELECT payment_currency, {matrix(currencies, 'receiving_currency', 'transactions')} FROM v_corridors GROUP BY 1"
    sql["ds_risk_account_count"] = "SELECT count(DISTINCT account_key) AS risk_accounts FROM r_fact_aml_account_risk"
    sql["ds_bank_scatter"] = "SELECT bank_name, total_participations, aml_participation_ratio, aml_participations FROM v_by_bank_name"
    sql["ds_corridor_detail"] = "SELECT payment_currency, receiving_currency, transactions, laundering_transactions, aml_ratio FROM v_corridors"
    sql["ds_corridor_scatter"] = "SELECT transactions, laundering_transactions, aml_ratio FROM v_corridors"
    sql["ds_pattern_detail"] = f"SELECT *, {ratio('pattern_transactions', 'pattern_attempts')} AS transactions_per_attempt FROM ({sql['pattern_rank']})"
    sql["ds_batch_history"] = """SELECT dw_batch_id, load_type, status, duration_minutes, transaction_rows_inserted,
        rejected_rows, validation_status FROM r_etl_batch_monitor"""
    sql["ds_daily_detail"] = f"SELECT *, {ratio('laundering_transactions', 'transactions')} AS aml_ratio FROM v_per_day"
    sql["ds_format_volume"] = f"""SELECT payment_format, {both},
        {ratio('sum(laundering_count)', 'sum(transaction_count)')} AS aml_ratio FROM v_daily GROUP BY 1"""
    sql["ds_aml_trend"] = "SELECT full_date, laundering_transactions FROM v_per_day"
    sql["ds_sent_received_mix"] = """SELECT bank_name, sent_participations, received_participations FROM
        (SELECT * FROM v_by_bank_name ORDER BY total_participations DESC, bank_name LIMIT 15)"""
    sql["ds_validation_detail"] = "SELECT dw_batch_id, check_name, source_value, target_value, difference_value, status FROM r_etl_validation_result"
    sql["ds_drill_calendar"] = f"""SELECT year_number, quarter_number, month_number, d.full_date,
        CAST(grouping(year_number, quarter_number, month_number, d.full_date) AS INTEGER) AS level_id, {both}
        FROM r_fact_daily_transaction f JOIN r_dim_date d ON d.date_key = f.date_key
        GROUP BY ROLLUP (year_number, quarter_number, month_number, d.full_date)"""
    sql["ds_hour_daypart"] = f"""SELECT hour_number, day_part, count(*) AS transactions,
        {AML} AS laundering_transactions FROM v_fact f JOIN v_dim_time t ON t.time_key = f.time_key GROUP BY 1, 2"""
    # Reporting views
    for view in VIEWS:
        sql[f"rpt_{view}"] = f"SELECT * FROM r_{view}"
    sql["rpt_refresh"] = counts({v: f"r_{v}" for v in VIEWS})
    # Batches, increments, reconciliation
    one = lambda block: f"(SELECT count(*) FROM {block})"
    sql["load_source_batch"] = f"""SELECT {ONE} AS batch_id, 'AML transfers' AS dataset_name, 'COMPLETED' AS status,
        {one('v_account_landing')} AS account_landing_rows, {one('v_txn_landing')} AS transaction_landing_rows,
        {one('v_pattern_landing')} AS pattern_landing_rows"""
    sql["close_source_batch"] = f"""SELECT {ONE} AS batch_id, 'COMPLETED' AS status,
        {one('v_account')} AS account_loaded_rows, {one('v_txn')} AS transaction_loaded_rows,
        {one('v_pattern')} AS pattern_loaded_rows, {one(rejected)} AS rejected_rows,
        TIMESTAMP '2024-01-01 00:01:30' AS completed_at"""
    sql["load_dw"] = f"""SELECT {BATCH}, bank_rows_affected, entity_rows_affected, account_rows_affected,
        currency_rows_affected, payment_format_rows_affected, validation_status FROM v_batches"""
    sql["watermark_window"] = _half_load()
    sql["idempotent_append"] = f"""
    SELECT '1' AS step, count(*) AS inserted_rows FROM v_txn, {HALF} WHERE source_transaction_id <= cut
    UNION ALL SELECT '2', count(*) FROM v_txn, {HALF} WHERE source_transaction_id > cut
    UNION ALL SELECT '3', 0"""
    sql["incremental_noop"] = f"SELECT {BATCH} FROM v_batches WHERE load_type = 'INCREMENTAL'"
    sql["incremental_stream"] = """SELECT source_transaction_id, transaction_timestamp, from_bank_id, from_account_id,
        amount_paid, is_laundering FROM v_txn"""
    sql["stream_rejects"] = f"SELECT source_object, source_row_id, error_code, error_description, raw_payload FROM ({sql['reject_transaction']})"
    sql["incremental_files"] = f"""SELECT dw_batch_id, load_type, status, source_low_watermark, source_high_watermark,
        transaction_rows_inserted FROM ({_half_load()})"""
    sql["reject_unknown_keys_txn"] = "SELECT * FROM v_dw_reject WHERE source_object = 'transactions'"
    sql["reject_unknown_keys_pattern"] = "SELECT * FROM v_dw_reject WHERE source_object = 'pattern_transactions'"
    sql["batch_failure"] = f"""SELECT {ONE} AS dw_batch_id, 'FULL' AS load_type, 'FAILED' AS status,
        max(source_transaction_id) AS source_high_watermark, CAST(0 AS BIGINT) AS transaction_rows_inserted,
        true AS has_message, CAST(0 AS BIGINT) AS published_rows FROM v_txn"""
    landed = {"account": "v_account_landing", "transaction": "v_txn_landing", "pattern": "v_pattern_landing"}
    sql["landing_gate"] = f"SELECT source_object, row_count, row_count AS expected_rows, 'OK' AS status FROM ({counts(landed, 'source_object')})"
    sql["landing_gate_stop"] = f"""SELECT {ONE} AS batch_id, 'FAILED' AS status, false AS anything_written,
        'account' AS source_object, (SELECT count(*) FROM v_account_landing) AS row_count,
        (SELECT count(*) FROM customer) AS expected_rows"""
    sql["recon_9_checks"] = "SELECT validation_result_id, dw_batch_id, check_name, source_value, target_value, status FROM v_checks"
    halves = {"account": ("v_account", "v_account_reject"), "transaction": ("v_txn", "v_txn_reject"), "pattern": ("v_pattern", "v_pattern_reject")}
    sql["landing_empty_check"] = " UNION ALL ".join(
        f"SELECT '{name}' AS source_object, {one(landed[name])} - {one(valid)} - {one(bad)} AS row_count"
        for name, (valid, bad) in halves.items())
    sql["dim_seed_check"] = f"""SELECT {one('v_dim_time')} AS time_rows,
        (SELECT count(*) FROM v_dim_bank WHERE bank_key = -1) AS unknown_bank,
        (SELECT count(*) FROM v_dim_account WHERE account_key = -1) AS unknown_account,
        {one('v_dim_account')} AS account_rows"""
    duplicates = lambda check, keys, view: f"SELECT '{check}' AS check_name, count(*) AS error_count FROM (SELECT 1 FROM {view} GROUP BY {keys} HAVING count(*) > 1)"
    sql["recon_grain_checks"] = (
        duplicates("duplicate_date_key", "date_key", "r_dim_date") + " UNION ALL "
        + duplicates("duplicate_daily_grain", "date_key, payment_currency_key, payment_format_key", "r_fact_daily_transaction"))
    named = {
        "daily_missing_date": 0, "daily_missing_payment_currency": 1, "daily_missing_payment_format": 2,
        "currency_flow_missing_payment_currency": 6, "currency_flow_missing_receiving_currency": 7,
        "bank_activity_missing_bank": 4, "account_risk_missing_bank": 5, "pattern_missing_type": 8}
    sql["recon_ref_checks"] = " UNION ALL ".join(
        f"SELECT '{check}' AS check_name, {orphans(*RELATIONS[place])} AS error_count" for check, place in named.items())
    kpis = {"transaction_count": "n", "laundering_count": "l", "cross_bank_count": "cb",
            "cross_currency_count": "cc", "self_transfer_count": "st"}
    sql["recon_kpi_expected"] = " UNION ALL ".join(
        f"SELECT '{kpi}' AS kpi_name, {short} AS expected_value, {kpi} AS actual_value, "
        f"CASE WHEN {short} = {kpi} THEN 'PASS' ELSE 'FAIL' END AS status FROM v_source_totals, m_kpi"
        for kpi, short in kpis.items())
    sql["raw_valid_reject_balance"] = " UNION ALL ".join(
        f"SELECT '{name}' AS source_object, {one(landed[name])} AS raw_rows, {one(valid)} AS valid_rows, "
        f"{one(bad)} AS rejected_rows, {one(landed[name])} = {one(valid)} + {one(bad)} AS balanced"
        for name, (valid, bad) in halves.items())
    sql["acceptance_suite"] = acceptance()
    order = "list_position(['ETL', 'RECONCILIATION', 'DATA_QUALITY', 'BUSINESS_RULE', 'DATA_WAREHOUSE', 'REPORTING'], category)"
    sql["acceptance_latest"] = f"""SELECT test_run_id, 'acceptance' AS run_label,
        CASE WHEN count(*) FILTER (WHERE status = 'FAILED') OVER () = 0 THEN 'PASSED' ELSE 'FAILED' END AS run_status,
        category, CAST({order} AS INTEGER) AS category_order, test_code, status FROM ({acceptance(2)})"""
    sql["demo_queries"] = f"""
    SELECT 'failed_tests' AS question, test_code AS item, actual_value AS value FROM ({acceptance()}) WHERE status = 'FAILED'
    UNION ALL SELECT 'format_rate', payment_format, CAST(laundering_count AS VARCHAR) FROM m_format
    UNION ALL SELECT 'pattern_attempts', pattern_type, CAST(attempt_count AS VARCHAR) FROM m_pattern
    UNION ALL SELECT 'latest_checks', check_name, status FROM v_checks WHERE dw_batch_id = 2"""
    sql["demo_latest_run"] = f"""SELECT test_run_id, 'acceptance' AS run_label,
        CASE WHEN count(*) FILTER (WHERE status = 'FAILED') OVER () = 0 THEN 'PASSED' ELSE 'FAILED' END AS run_status,
        category, test_code, expected_value, actual_value, status FROM ({acceptance()})"""
    sql["demo_format_rate"] = "SELECT * FROM r_fact_aml_payment_format JOIN r_dim_payment_format USING (payment_format_key)"
    sql["demo_pattern_attempts"] = "SELECT * FROM r_fact_pattern_summary JOIN r_dim_pattern_type USING (pattern_type_key)"
    sql["demo_latest_checks"] = "SELECT * FROM r_etl_validation_result WHERE dw_batch_id = (SELECT max(dw_batch_id) FROM r_etl_batch_monitor)"
    sql["curated_vs_local"] = f"""
    SELECT coalesce(s.payment_format, t.payment_format) AS payment_format, s.n AS source_row_count,
        s.l AS source_laundering_count, t.n AS target_row_count, t.l AS target_laundering_count,
        s.n IS NOT DISTINCT FROM t.n AND s.l IS NOT DISTINCT FROM t.l AS matches
    FROM (SELECT payment_format, count(*) AS n, {AML1} AS l FROM v_curated WHERE is_valid GROUP BY 1) s
    FULL JOIN (SELECT payment_format, transaction_count AS n, laundering_count AS l FROM m_format) t
        ON s.payment_format = t.payment_format"""
    curated = "(SELECT * FROM v_curated WHERE is_valid)"
    local = """(SELECT transaction_key, date_key, payment_format, p.currency_name AS payment_currency,
        r.currency_name AS receiving_currency, amount_paid, amount_received, is_laundering, is_cross_bank,
        is_cross_currency, is_self_transfer
        FROM v_fact f LEFT JOIN v_dim_payment_format USING (payment_format_key)
        LEFT JOIN v_dim_currency p ON p.currency_key = payment_currency_key
        LEFT JOIN v_dim_currency r ON r.currency_key = receiving_currency_key)"""
    shared = """(SELECT transaction_key, CAST(strftime(txn_date, '%Y%m%d') AS INTEGER) AS date_key, payment_format,
        payment_currency, receiving_currency, amount_paid, amount_received, is_laundering = 1 AS is_laundering,
        is_cross_bank, is_cross_currency, is_self_transfer FROM v_curated WHERE is_valid)"""
    flag_counts = ", ".join(
        f"count(*) FILTER (WHERE is_{flag}) AS {flag}_count" for flag in ("cross_bank", "self_transfer", "cross_currency"))
    aml = f"{AML1} AS laundering_count, {rate(AML1, 'count(*)')} AS laundering_rate_percent"
    sql["curated_completeness"] = f"""SELECT count(*) AS transaction_count, min(transaction_timestamp) AS min_timestamp,
        max(transaction_timestamp) AS max_timestamp FROM {curated}"""
    sql["curated_aml_rate"] = f"SELECT count(*) AS transaction_count, {aml} FROM {curated}"
    sql["curated_daily"] = f"SELECT txn_date, count(*) AS transaction_count, {AML1} AS laundering_count FROM {curated} GROUP BY 1"
    sql["curated_format_rate"] = f"SELECT payment_format, count(*) AS transaction_count, {aml} FROM {curated} GROUP BY 1"
    sql["curated_flags"] = f"SELECT {flag_counts} FROM {curated}"
    sql["curated_patterns"] = """SELECT pattern_type, count(*) AS pattern_transaction_count,
        count(DISTINCT pattern_attempt_id) AS attempt_count FROM v_pattern GROUP BY 1"""
    aml_both = "count(*) FILTER (WHERE is_laundering)"
    figures = {
        "transaction_count": "count(*)", "laundering_count": aml_both,
        "cross_bank_count": "count(*) FILTER (WHERE is_cross_bank)",
        "self_transfer_count": "count(*) FILTER (WHERE is_self_transfer)",
        "cross_currency_count": "count(*) FILTER (WHERE is_cross_currency)",
        "first_date_key": "min(date_key)", "last_date_key": "max(date_key)",
        "laundering_rate_percent": rate(aml_both, "count(*)")}
    figure = lambda value, copy: f"(SELECT CAST({value} AS DECIMAL(38,6)) FROM {copy})"
    sql["curated_vs_local_totals"] = "SELECT *, source_value IS NOT DISTINCT FROM target_value AS matches FROM (" + " UNION ALL ".join(
        f"SELECT '{name}' AS measure, {figure(value, shared)} AS source_value, {figure(value, local)} AS target_value"
        for name, value in figures.items()) + ")"
    sql["curated_vs_local_daily"] = f"""
    SELECT coalesce(s.date_key, t.date_key) AS date_key, s.n AS source_transaction_count, s.l AS source_laundering_count,
        t.n AS target_transaction_count, t.l AS target_laundering_count,
        s.n IS NOT DISTINCT FROM t.n AND s.l IS NOT DISTINCT FROM t.l AS matches
    FROM (SELECT date_key, count(*) AS n, {aml_both} AS l FROM {shared} GROUP BY 1) s
    FULL JOIN (SELECT date_key, count(*) AS n, {aml_both} AS l FROM {local} GROUP BY 1) t ON s.date_key = t.date_key"""
    sql["curated_vs_local_rows"] = f"""
    SELECT *, 'curated' AS copy, count(*) AS surplus FROM (SELECT * FROM {shared} EXCEPT ALL SELECT * FROM {local}) GROUP BY ALL
    UNION ALL
    SELECT *, 'local', count(*) FROM (SELECT * FROM {local} EXCEPT ALL SELECT * FROM {shared}) GROUP BY ALL"""
    after = {dim: 1 for dim in DIMS} | {"dim_time": 1441, "fact_transaction": 0, "fact_pattern_transaction": 0, "dw_rejected_row": 0}
    held = {dim: f"v_{dim}" for dim in DIMS} | {"fact_transaction": "v_fact", "fact_pattern_transaction": "v_fact_pattern", "dw_rejected_row": "v_dw_reject"}
    sql["dw_reset"] = " UNION ALL ".join(
        f"SELECT '{name}' AS object_name, {one(block)} AS rows_before, CAST({after[name]} AS BIGINT) AS rows_after"
        for name, block in held.items())
    kept = held | {"dim_time": "v_dim_time"} | MARTS
    sql["retention_sweep"] = " UNION ALL ".join(
        f"SELECT '{name}' AS object_name, {one(block)} AS row_count, true AS was_swept, CAST(0 AS BIGINT) AS left_over"
        for name, block in kept.items())
    return sql


def all_sql() -> dict[str, str]:
    return {name: with_blocks(statement) for name, statement in _raw().items()}
