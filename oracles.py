"""Equivalent SQL of the registered queries, for DuckDB over the same parquet tables.

Written on its own, from what each query means: shared parts are CTEs, and each
query takes the CTEs it needs.
"""

from __future__ import annotations

import re

from lakemart.plans.queries import BLANK_KEYS, DIRTY_AMOUNTS
from lakemart.sources.fixtures import TABLES, VIEWS

LOAD = "TIMESTAMP '2024-02-01 00:00:00'"
AS_OF = "DATE '2000-01-01'"
NAMES = {t: t for t in TABLES}

CTES: dict[str, str] = {f"raw_{name}": sql.format(**NAMES) for name, sql in VIEWS.items()}


def dbl(c: str, alias: str | None = None) -> str:
    return f"cast({c} AS double) AS {alias or c}"


def div(a: str, b: str, alternate: str = "NULL") -> str:
    return f"(CASE WHEN ({b}) IS NULL OR ({b}) = 0 THEN {alternate} ELSE cast({a} AS double) / cast({b} AS double) END)"


def div0(a: str, b: str) -> str:
    return div(a, b, "0")


def minus(a: str, b: str) -> str:
    return f"(CASE WHEN {a} IS NULL AND {b} IS NULL THEN NULL ELSE coalesce({a}, 0) - coalesce({b}, 0) END)"


def plus(a: str, b: str) -> str:
    return f"(CASE WHEN {a} IS NULL AND {b} IS NULL THEN NULL ELSE coalesce({a}, 0) + coalesce({b}, 0) END)"


def dc(c: str, where: str | None = None) -> str:
    if where:
        return f"(count(DISTINCT {c}) FILTER (WHERE {where}) + max(CASE WHEN {where} THEN cast({c} IS NULL AS int) END))"
    return f"(count(DISTINCT {c}) + max(cast({c} IS NULL AS int)))"


def rows(where: str) -> str:
    return f"nullif(count(*) FILTER (WHERE {where}), 0)"


# -- typed layer ---------------------------------------------------------------------

CTES["cl_customers"] = f"""
    SELECT trim(customer_id) AS customer_id, trim(full_name) AS full_name, TRY_CAST(dob AS date) AS dob,
           upper(trim(gender)) AS gender, upper(trim(pan)) AS pan, trim(phone) AS phone, lower(trim(email)) AS email,
           trim(address) AS address, trim(city) AS city, trim(state) AS state, upper(trim(segment)) AS segment,
           upper(trim(risk_rating)) AS risk_rating, trim(home_branch_id) AS home_branch_id,
           upper(trim(kyc_status)) AS kyc_status, TRY_CAST(created_at AS timestamp) AS created_at,
           TRY_CAST(updated_at AS timestamp) AS updated_at, trim(record_source) AS record_source, {LOAD} AS silver_load_ts
    FROM (SELECT * FROM raw_customers UNION ALL SELECT * FROM raw_customers_delta)
    WHERE customer_id IS NOT NULL
"""


def versions(source: str, key: str, at: str, tracked: list[str], ties: list[str], start: str, end: str, gap: str) -> str:
    """History of a keyed table."""
    same = " AND ".join(f"lag({c}) OVER w IS NOT DISTINCT FROM {c}" for c in tracked)
    order = f"PARTITION BY {key} ORDER BY {at} ASC NULLS LAST, " + ", ".join(f"{t} ASC NULLS FIRST" for t in ties)
    return f"""
    SELECT * EXCLUDE (_first, _same, _at, _has_next, _next),
           _at AS {start}, _next - INTERVAL {gap} AS {end}, cast(NOT _has_next AS int) AS is_current
    FROM (
        SELECT *, {at} AS _at, lead(TRUE, 1, FALSE) OVER v AS _has_next, lead({at}) OVER v AS _next
        FROM (SELECT *, row_number() OVER w = 1 AS _first, {same} AS _same FROM {source} WINDOW w AS ({order}))
        WHERE _first OR NOT _same
        WINDOW v AS ({order})
    )
    """


CUSTOMER_TRACKED = ["full_name", "dob", "gender", "pan", "phone", "email", "address", "city", "state", "segment",
                    "risk_rating", "home_branch_id", "kyc_status"]
ACCOUNT_TRACKED = ["customer_id", "branch_id", "account_type", "currency", "status", "open_date", "overdraft_limit"]

CTES["at_customers"] = f"SELECT *, coalesce(updated_at, created_at, {LOAD}) AS _event FROM cl_customers"
CTES["sv_customers"] = "SELECT * EXCLUDE (_event) FROM (" + versions(
    "at_customers", "customer_id", "_event", CUSTOMER_TRACKED, [*CUSTOMER_TRACKED, "record_source"],
    "effective_start_date", "effective_end_date", "1 second") + ")"
CTES["cl_branches"] = f"""
    SELECT trim(branch_id) AS branch_id, trim(branch_name) AS branch_name, trim(city) AS city, trim(state) AS state,
           upper(trim(region)) AS region, TRY_CAST(opened_date AS date) AS opened_date,
           TRY_CAST(is_active AS int) AS is_active, 'bronze' AS record_source, {LOAD} AS silver_load_ts
    FROM raw_branches
"""
CTES["sv_branches"] = "SELECT * FROM cl_branches WHERE branch_id IS NOT NULL"
CTES["at_accounts"] = f"""
    SELECT *, coalesce(updated_at, created_at, {LOAD}) AS _event FROM (
        SELECT trim(account_id) AS account_id, trim(customer_id) AS customer_id, trim(branch_id) AS branch_id,
               upper(trim(account_type)) AS account_type, upper(trim(currency)) AS currency, upper(trim(status)) AS status,
               TRY_CAST(open_date AS date) AS open_date, cast(overdraft_limit AS decimal(18,2)) AS overdraft_limit,
               TRY_CAST(created_at AS timestamp) AS created_at, TRY_CAST(updated_at AS timestamp) AS updated_at,
               trim(record_source) AS record_source, {LOAD} AS silver_load_ts
        FROM (SELECT * FROM raw_accounts UNION ALL SELECT * FROM raw_accounts_delta))
    WHERE account_id IS NOT NULL
      AND customer_id IN (SELECT customer_id FROM sv_customers) AND branch_id IN (SELECT branch_id FROM sv_branches)
"""
CTES["sv_accounts"] = "SELECT * EXCLUDE (_event) FROM (" + versions(
    "at_accounts", "account_id", "_event", ACCOUNT_TRACKED, [*ACCOUNT_TRACKED, "record_source"],
    "effective_start_date", "effective_end_date", "1 second") + ")"
CTES["cl_cards"] = f"""
    SELECT trim(card_id) AS card_id, trim(customer_id) AS customer_id, trim(linked_account_id) AS linked_account_id,
           upper(trim(card_type)) AS card_type, upper(trim(status)) AS status, TRY_CAST(issued_date AS date) AS issued_date,
           cast(credit_limit AS decimal(18,2)) AS credit_limit, TRY_CAST(created_at AS timestamp) AS created_at,
           TRY_CAST(updated_at AS timestamp) AS updated_at, trim(record_source) AS record_source, {LOAD} AS silver_load_ts
    FROM raw_cards
"""
CTES["ok_cards"] = """
    SELECT card_id FROM cl_cards
    WHERE customer_id IN (SELECT customer_id FROM sv_customers)
      AND linked_account_id IN (SELECT account_id FROM sv_accounts)
"""
CTES["sv_cards"] = "SELECT * FROM cl_cards WHERE card_id IN (SELECT card_id FROM ok_cards)"
CTES["rj_cards"] = "SELECT * FROM cl_cards WHERE card_id NOT IN (SELECT card_id FROM ok_cards)"
CTES["cl_transactions"] = f"""
    SELECT trim(transaction_id) AS transaction_id, transaction_ts, trim(account_id) AS account_id,
           trim(customer_id) AS customer_id, trim(branch_id) AS branch_id, upper(trim(txn_type)) AS txn_type,
           upper(trim(channel)) AS channel, upper(trim(direction)) AS direction,
           cast(amount AS decimal(18,2)) AS amount, upper(trim(currency)) AS currency,
           upper(trim(merchant_category)) AS merchant_category, trim(counterparty) AS counterparty, is_fraud_label,
           TRY_CAST(created_at AS timestamp) AS created_at, trim(record_source) AS record_source, {LOAD} AS silver_load_ts
    FROM raw_transactions
"""
CTES["sv_channels"] = "SELECT DISTINCT channel AS channel_name FROM cl_transactions WHERE channel IS NOT NULL"
CTES["sv_txn_types"] = "SELECT DISTINCT txn_type AS txn_type_name FROM cl_transactions WHERE txn_type IS NOT NULL"
CTES["sv_transactions"] = """
    SELECT * FROM cl_transactions
    WHERE account_id IN (SELECT account_id FROM sv_accounts) AND customer_id IN (SELECT customer_id FROM sv_customers)
      AND branch_id IN (SELECT branch_id FROM sv_branches) AND channel IS NOT NULL AND txn_type IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY transaction_ts DESC NULLS LAST) = 1
"""
CTES["sv_balances"] = f"""
    SELECT * FROM (
        SELECT trim(account_id) AS account_id, trim(customer_id) AS customer_id, trim(branch_id) AS branch_id,
               upper(trim(currency)) AS currency, snapshot_date,
               cast(end_of_day_balance AS decimal(18,2)) AS end_of_day_balance,
               'bronze' AS record_source, {LOAD} AS silver_load_ts
        FROM raw_balances_daily)
    WHERE account_id IN (SELECT account_id FROM sv_accounts) AND customer_id IN (SELECT customer_id FROM sv_customers)
      AND branch_id IN (SELECT branch_id FROM sv_branches)
"""
CTES["new_loans"] = f"""
    SELECT loan_id, trim(customer_id) AS customer_id, trim(branch_id) AS branch_id, upper(trim(status)) AS status,
           start_date, cast(interest_rate_apr AS decimal(10,4)) AS interest_rate_apr,
           cast(principal_amount AS decimal(18,2)) AS principal_amount, cast(tenure_months AS int) AS tenure_months,
           'bronze' AS record_source, {LOAD} AS silver_load_ts
    FROM raw_loans
    QUALIFY row_number() OVER (PARTITION BY loan_id ORDER BY start_date DESC NULLS LAST, principal_amount DESC NULLS LAST,
                               trim(branch_id) DESC NULLS LAST, trim(customer_id) DESC NULLS LAST,
                               cast(interest_rate_apr AS decimal(10,4)) DESC NULLS LAST, upper(trim(status)) DESC NULLS LAST,
                               tenure_months DESC NULLS LAST) = 1
"""
CTES["sv_loans"] = f"""
    SELECT *, {LOAD} AS effective_from, cast(NULL AS timestamp) AS effective_to, 1 AS is_current
    FROM new_loans
    WHERE customer_id IN (SELECT customer_id FROM sv_customers) AND branch_id IN (SELECT branch_id FROM sv_branches)
"""
CTES["sv_payments"] = f"""
    SELECT loan_id || '_' || cast(n AS varchar) AS payment_id, loan_id, customer_id, branch_id,
           cast(n AS int) AS installment_no, cast(start_date + to_months(cast(n - 1 AS int)) AS date) AS payment_date,
           cast((2 * cents + tenure_months) // (2 * tenure_months) AS bigint) AS pay_cents,
           CASE WHEN cast(start_date + to_months(cast(n - 1 AS int)) AS date) <= {AS_OF} THEN 'PAID' ELSE 'PENDING' END AS status,
           {LOAD} AS silver_load_ts
    FROM (SELECT *, cast(principal_amount * 100 AS bigint) AS cents, unnest(generate_series(1, tenure_months)) AS n
          FROM sv_loans WHERE start_date IS NOT NULL AND principal_amount IS NOT NULL AND tenure_months > 0)
"""

# -- star ------------------------------------------------------------------------------


def numbered(key: str, name: str, source: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY substr(md5({key}), 1, 3), {key}) - 1 AS {name} FROM {source}"


CTES["d_branch"] = numbered("branch_id", "branch_key", "sv_branches")
CTES["cur_customers"] = "SELECT * FROM sv_customers WHERE is_current = 1"
CTES["d_customer"] = numbered("customer_id", "customer_key", "cur_customers")
CTES["cur_accounts"] = "SELECT * FROM sv_accounts WHERE is_current = 1"
CTES["d_account"] = numbered("account_id", "account_key", "cur_accounts")
CTES["d_card"] = numbered("card_id", "card_key", "sv_cards")
CTES["d_loan"] = numbered("loan_id", "loan_key", "sv_loans")
CTES["d_channel"] = numbered("channel_name", "channel_key", "sv_channels")
CTES["d_txn_type"] = numbered("txn_type_name", "txn_type_key", "sv_txn_types")
CTES["bounds"] = """
    SELECT 'transactions' AS table_name, 'transaction_ts' AS column_name, min(cast(transaction_ts AS date)) AS min_date,
           max(cast(transaction_ts AS date)) AS max_date FROM sv_transactions
    UNION ALL SELECT 'balances_daily', 'snapshot_date', min(snapshot_date), max(snapshot_date) FROM sv_balances
    UNION ALL SELECT 'loans', 'start_date', min(start_date), max(start_date) FROM sv_loans
    UNION ALL SELECT 'loan_payments', 'payment_date', min(payment_date), max(payment_date) FROM sv_payments
    UNION ALL SELECT 'accounts', 'open_date', min(open_date), max(open_date) FROM sv_accounts
    UNION ALL SELECT 'cards', 'issued_date', min(issued_date), max(issued_date) FROM sv_cards
    UNION ALL SELECT 'branches', 'opened_date', min(opened_date), max(opened_date) FROM sv_branches
"""
CTES["days"] = """
    SELECT cast(unnest(generate_series(cast(a AS timestamp), cast(b AS timestamp) + INTERVAL 365 DAY, INTERVAL 1 DAY)) AS date) AS "Date"
    FROM (SELECT min(min_date) AS a, max(max_date) AS b FROM bounds)
"""
CTES["d_date"] = """
    SELECT "Date", cast(strftime("Date", '%Y%m%d') AS int) AS Date_Key, year("Date") AS "Year",
           month("Date") AS Month_Number, strftime("Date", '%B') AS Month_Name, strftime("Date", '%b') AS Month_Short,
           quarter("Date") AS Quarter_Number, 'Q' || quarter("Date") AS quarter,
           year("Date") || '-Q' || quarter("Date") AS Year_Quarter, strftime("Date", '%b %Y') AS Month_Year,
           strftime("Date", '%Y-%m') AS Year_Month, week("Date") AS Week_Number, day("Date") AS "Day",
           strftime("Date", '%A') AS Day_Name, strftime("Date", '%a') AS Day_Short, dayofweek("Date") + 1 AS Day_Of_Week,
           dayofyear("Date") AS Day_Of_Year, cast(dayofweek("Date") IN (0, 6) AS int) AS Is_Weekend,
           cast(day("Date") = 1 AS int) AS Is_Month_Start, cast(last_day("Date") = "Date" AS int) AS Is_Month_End,
           cast(day("Date") = 1 AND month("Date") IN (1, 4, 7, 10) AS int) AS Is_Quarter_Start,
           cast(last_day("Date") = "Date" AND month("Date") IN (3, 6, 9, 12) AS int) AS Is_Quarter_End,
           cast(day("Date") = 1 AND month("Date") = 1 AS int) AS Is_Year_Start,
           cast(day("Date") = 31 AND month("Date") = 12 AS int) AS Is_Year_End,
           CASE WHEN month("Date") >= 4 THEN year("Date") || '-' || (year("Date") + 1)
                ELSE (year("Date") - 1) || '-' || year("Date") END AS Financial_Year,
           CASE WHEN month("Date") IN (4, 5, 6) THEN 'Q1' WHEN month("Date") IN (7, 8, 9) THEN 'Q2'
                WHEN month("Date") IN (10, 11, 12) THEN 'Q3' ELSE 'Q4' END AS Financial_Quarter
    FROM days
"""
CTES["f_t"] = """
    SELECT account_key, branch_key, channel_key, counterparty, t.currency, customer_key, Date_Key AS date_key, direction,
           is_fraud_label, merchant_category, transaction_id, transaction_ts, txn_type_key, amount
    FROM sv_transactions t
    LEFT JOIN d_account a ON t.account_id = a.account_id LEFT JOIN d_customer c ON t.customer_id = c.customer_id
    LEFT JOIN d_branch b ON t.branch_id = b.branch_id LEFT JOIN d_channel ON t.channel = channel_name
    LEFT JOIN d_txn_type ON t.txn_type = txn_type_name LEFT JOIN d_date d ON cast(t.transaction_ts AS date) = d."Date"
"""
CTES["f_b"] = """
    SELECT account_key, customer_key, branch_key, Date_Key AS date_key, snapshot_date, end_of_day_balance, s.currency
    FROM sv_balances s
    LEFT JOIN d_account a ON s.account_id = a.account_id LEFT JOIN d_customer c ON s.customer_id = c.customer_id
    LEFT JOIN d_branch b ON s.branch_id = b.branch_id LEFT JOIN d_date d ON s.snapshot_date = d."Date"
"""
CTES["f_l"] = """
    SELECT loan_key, Date_Key AS date_key, customer_key, branch_key, l.principal_amount, l.interest_rate_apr,
           l.tenure_months, l.status
    FROM sv_loans l
    LEFT JOIN d_loan dl ON l.loan_id = dl.loan_id LEFT JOIN d_customer c ON l.customer_id = c.customer_id
    LEFT JOIN d_branch b ON l.branch_id = b.branch_id LEFT JOIN d_date d ON l.start_date = d."Date"
"""
CTES["f_p"] = """
    SELECT branch_key, customer_key, Date_Key AS date_key, loan_key, pay_cents, payment_id, p.status
    FROM sv_payments p
    LEFT JOIN d_branch b ON p.branch_id = b.branch_id LEFT JOIN d_customer c ON p.customer_id = c.customer_id
    LEFT JOIN d_loan dl ON p.loan_id = dl.loan_id LEFT JOIN d_date d ON p.payment_date = d."Date"
"""
CTES["c_wide"] = """
    SELECT k.customer_key, k.date_key, coalesce(t.n, 0) AS transaction_count, coalesce(t.a, 0) AS transaction_amount,
           coalesce(t.f, 0) AS fraud_txn_count, coalesce(b.bal, 0) AS total_balance, coalesce(b.n, 0) AS account_count,
           coalesce(l.n, 0) AS loan_count, coalesce(l.a, 0) AS total_principal_amount,
           (SELECT count(*) FROM sv_cards s JOIN d_customer c ON s.customer_id = c.customer_id
            WHERE c.customer_key = k.customer_key AND cast(strftime(s.issued_date, '%Y%m%d') AS int) <= k.date_key) AS card_count
    FROM (SELECT customer_key, date_key FROM f_t UNION SELECT customer_key, date_key FROM f_b
          UNION SELECT customer_key, date_key FROM f_l) k
    LEFT JOIN (SELECT customer_key, date_key, count(*) AS n, sum(amount) AS a,
                      count(*) FILTER (WHERE is_fraud_label = 1) AS f FROM f_t GROUP BY ALL) t
           ON t.customer_key = k.customer_key AND t.date_key = k.date_key
    LEFT JOIN (SELECT customer_key, date_key, sum(end_of_day_balance) AS bal, count(DISTINCT account_key) AS n
               FROM f_b GROUP BY ALL) b ON b.customer_key = k.customer_key AND b.date_key = k.date_key
    LEFT JOIN (SELECT customer_key, date_key, count(DISTINCT loan_key) AS n, sum(principal_amount) AS a
               FROM f_l GROUP BY ALL) l ON l.customer_key = k.customer_key AND l.date_key = k.date_key
"""


def with_ctes(sql: str) -> str:
    """The query with the CTEs it uses, directly or through others."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(CTES[name])
    listed = ",\n".join(f"{name} AS ({CTES[name].strip()})" for name in CTES if name in needed)
    return f"WITH {listed}\n{sql.strip()}" if listed else sql.strip()


PLAIN: dict[str, str] = {}

PLAIN["q_clean_customers"] = "SELECT * REPLACE (cast(dob AS varchar) AS dob) FROM cl_customers"
PLAIN["q_rename_known_keys"] = f"""
    SELECT cust AS customer_id, event_type, event_id FROM ({BLANK_KEYS.format(**NAMES)}) WHERE trim(cust) <> ''
"""
PLAIN["q_recreate"] = "SELECT * FROM raw_customer_changes"
PLAIN["q_clean_amounts"] = f"""
    SELECT o_orderkey, cast(TRY_CAST(replace(trim(amount), ',', '') AS decimal(18,2)) AS double) AS amount,
           cast(TRY_CAST(day AS date) AS varchar) AS day, TRY_CAST(seen_at AS timestamp) AS seen_at, TRY_CAST(pieces AS int) AS pieces
    FROM ({DIRTY_AMOUNTS.format(**NAMES)})
"""
PLAIN["q_convert_types"] = """
    SELECT l_orderkey, l_linenumber, l_partkey, cast(l_quantity AS int) AS l_quantity, l_extendedprice, l_tax,
           TRY_CAST(l_returnflag AS int) AS l_returnflag FROM lineitem
"""
LOAN_MONEY = "cast(interest_rate_apr AS double) AS interest_rate_apr, cast(principal_amount AS double) AS principal_amount"
PLAIN["q_dedupe_latest"] = f"SELECT * REPLACE (cast(start_date AS varchar) AS start_date, {LOAN_MONEY}) FROM new_loans"
CTES["sv_changes_s"] = versions("raw_customer_changes", "customer_id", "changed_at", ["event_type"], ["event_id"],
                                "effective_start_date", "effective_end_date", "1 second")
CTES["sv_changes_m"] = versions("raw_customer_changes", "customer_id", "changed_at", ["event_type"], ["event_id"],
                                "effective_from", "effective_to", "1 microsecond")
PLAIN["q_scd2_seconds"] = "SELECT * FROM sv_changes_s"
PLAIN["q_scd2_micros"] = "SELECT * FROM sv_changes_m"
PLAIN["q_current_rows"] = "SELECT * EXCLUDE (effective_end_date) FROM sv_changes_s WHERE is_current = 1"
PLAIN["q_scd2_customers"] = "SELECT * REPLACE (cast(dob AS varchar) AS dob) FROM sv_customers"
PLAIN["q_scd2_merge"] = PLAIN["q_scd2_merge_late"] = PLAIN["q_scd2_customers"]
PLAIN["q_scd2_accounts"] = """
    SELECT * REPLACE (cast(open_date AS varchar) AS open_date, cast(overdraft_limit AS double) AS overdraft_limit) FROM sv_accounts
"""
PLAIN["q_scd2_loans"] = f"SELECT * REPLACE (cast(start_date AS varchar) AS start_date, {LOAN_MONEY}) FROM sv_loans"
PLAIN["q_ri_semi"] = "SELECT * REPLACE (cast(amount AS double) AS amount) FROM sv_transactions"
CARD_PLAIN = "* REPLACE (cast(issued_date AS varchar) AS issued_date, cast(credit_limit AS double) AS credit_limit)"
PLAIN["q_ri_valid"] = f"SELECT {CARD_PLAIN} FROM sv_cards"
PLAIN["q_ri_reject"] = f"SELECT {CARD_PLAIN} FROM rj_cards"
PLAIN["q_null_key_split"] = """
    SELECT * REPLACE (cast(opened_date AS varchar) AS opened_date),
           CASE WHEN branch_id IS NULL THEN 'reject' ELSE 'valid' END AS verdict FROM cl_branches
"""
PLAIN["q_ri_balances"] = """
    SELECT * REPLACE (cast(snapshot_date AS varchar) AS snapshot_date, cast(end_of_day_balance AS double) AS end_of_day_balance)
    FROM sv_balances
"""
PLAIN["q_domains"] = """
    SELECT 'channel' AS domain, channel_name AS name FROM sv_channels
    UNION ALL SELECT 'txn_type', txn_type_name FROM sv_txn_types
"""
PLAIN["q_dates_union"] = """
    SELECT cast("Date" AS varchar) AS "Date", cast(strftime("Date", '%Y%m%d') AS int) AS date_key, year("Date") AS year,
           month("Date") AS month_no, strftime("Date", '%b') AS month_name, 'Q' || quarter("Date") AS quarter,
           day("Date") AS day_of_month, strftime("Date", '%a') AS day_name, week("Date") AS week_of_year
    FROM (SELECT cast(transaction_ts AS date) AS "Date" FROM sv_transactions UNION SELECT snapshot_date FROM sv_balances
          UNION SELECT start_date FROM sv_loans UNION SELECT payment_date FROM sv_payments)
    WHERE "Date" IS NOT NULL
"""
PLAIN["q_date_bounds"] = """
    SELECT table_name, column_name, cast(min_date AS varchar) AS min_date, cast(max_date AS varchar) AS max_date FROM bounds
"""
PLAIN["q_dim_date"] = 'SELECT * REPLACE (cast("Date" AS varchar) AS "Date") FROM d_date'
PLAIN["q_preview"] = PLAIN["q_dim_date"] + ' ORDER BY "Date" LIMIT 10'
PLAIN["q_surrogate_keys"] = "SELECT customer_id, customer_key FROM d_customer"
PLAIN["q_keys_grow"] = """
    SELECT customer_id, row_number() OVER (ORDER BY upper(record_source) <> 'CORE', substr(md5(customer_id), 1, 3), customer_id) - 1
           AS customer_key FROM cur_customers
"""
PLAIN["q_dim_branch"] = """
    SELECT branch_key, branch_id, branch_name, city, state, region, cast(opened_date AS varchar) AS opened_date, is_active
    FROM d_branch
"""
PLAIN["q_dim_customer"] = """
    SELECT customer_key, customer_id, full_name, gender, cast(dob AS varchar) AS dob, city, state, segment, risk_rating,
           home_branch_id, kyc_status, record_source, silver_load_ts AS load_ts FROM d_customer
"""
PLAIN["q_dim_account"] = """
    SELECT account_key, account_id, customer_id, branch_id, account_type, currency, cast(open_date AS varchar) AS open_date,
           status, cast(overdraft_limit AS double) AS overdraft_limit, record_source, silver_load_ts AS load_ts FROM d_account
"""
PLAIN["q_dim_card"] = """
    SELECT card_key, card_id, customer_id, linked_account_id, card_type, status, cast(issued_date AS varchar) AS issued_date,
           cast(credit_limit AS double) AS credit_limit FROM d_card
"""
PLAIN["q_dim_loan"] = f"""
    SELECT loan_key, loan_id, customer_id, branch_id, cast(NULL AS varchar) AS loan_type,
           cast(start_date AS varchar) AS start_date, tenure_months, {LOAN_MONEY}, status FROM d_loan
"""
PLAIN["q_dim_channel"] = "SELECT channel_key, channel_name FROM d_channel"
PLAIN["q_dim_txn_type"] = "SELECT txn_type_key, txn_type_name FROM d_txn_type"
PLAIN["q_fact_transactions"] = "SELECT * REPLACE (cast(amount AS double) AS amount) FROM f_t"
PLAIN["q_fact_daily_balances"] = """
    SELECT * REPLACE (cast(snapshot_date AS varchar) AS snapshot_date, cast(end_of_day_balance AS double) AS end_of_day_balance)
    FROM f_b
"""
PLAIN["q_fact_loans"] = f"SELECT * REPLACE ({LOAN_MONEY}) FROM f_l"
PLAIN["q_fact_loan_payments"] = "SELECT * EXCLUDE (pay_cents), cast(pay_cents AS double) / 100 AS payment_amount FROM f_p"
PLAIN["q_payment_schedule"] = """
    SELECT * EXCLUDE (pay_cents) REPLACE (cast(payment_date AS varchar) AS payment_date),
           cast(pay_cents AS double) / 100 AS payment_amount FROM sv_payments
"""
PLAIN["q_payment_profile"] = """
    SELECT cast(min(payment_date) AS varchar) AS min_date, cast(max(payment_date) AS varchar) AS max_date,
           count(*) AS row_count, count(DISTINCT payment_date) AS distinct_dates,
           count(*) FILTER (WHERE payment_date IS NULL) AS null_dates FROM sv_payments
"""
PLAIN["q_payment_distribution"] = """
    SELECT cast(payment_date AS varchar) AS payment_dt, count(*) AS row_count,
           cast(sum(pay_cents) AS double) / 100 AS total_payment
    FROM sv_payments GROUP BY payment_date ORDER BY payment_date LIMIT 100
"""
PLAIN["q_branch_daily"] = """
    SELECT date_key, branch_key, cast(sum(end_of_day_balance) AS double) AS total_balance,
           count(DISTINCT account_key) AS total_accounts, count(DISTINCT customer_key) AS total_customers
    FROM f_b GROUP BY date_key, branch_key
"""
# the rate's average has eight decimals, rounded half up
PLAIN["q_customer_daily"] = """
    SELECT customer_key, date_key, count(DISTINCT loan_key) AS loan_count,
           cast(sum(principal_amount) AS double) AS total_principal_amount,
           cast((2 * sum(cast(interest_rate_apr * 10000 AS bigint)) * 10000 + count(*)) // (2 * count(*)) AS double)
               / 100000000 AS avg_interest_rate_apr,
           round(avg(tenure_months), 6) AS avg_tenure_months
    FROM f_l GROUP BY customer_key, date_key
"""
PLAIN["q_branch_daily_wide"] = """
    SELECT date_key, branch_key, coalesce(max(tn), 0) AS transaction_count, coalesce(max(ta), 0) AS transaction_amount,
           coalesce(max(tf), 0) AS fraud_txn_count, coalesce(max(bb), 0) AS total_balance, coalesce(max(ln), 0) AS loan_count,
           coalesce(max(lp), 0) AS total_principal_amount, coalesce(max(pa), 0) AS total_payment_amount
    FROM (
        SELECT date_key, branch_key, count(*) AS tn, cast(sum(amount) AS double) AS ta,
               count(*) FILTER (WHERE is_fraud_label = 1) AS tf, NULL AS bb, NULL AS ln, NULL AS lp, NULL AS pa
        FROM f_t GROUP BY ALL
        UNION ALL SELECT date_key, branch_key, NULL, NULL, NULL, cast(sum(end_of_day_balance) AS double), NULL, NULL, NULL
        FROM f_b GROUP BY ALL
        UNION ALL SELECT date_key, branch_key, NULL, NULL, NULL, NULL, count(*), cast(sum(principal_amount) AS double), NULL
        FROM f_l GROUP BY ALL
        UNION ALL SELECT date_key, branch_key, NULL, NULL, NULL, NULL, NULL, NULL, cast(sum(pay_cents) AS double) / 100
        FROM f_p GROUP BY ALL)
    GROUP BY date_key, branch_key
"""
PLAIN["q_customer_daily_wide"] = """
    SELECT * REPLACE (cast(transaction_amount AS double) AS transaction_amount, cast(total_balance AS double) AS total_balance,
                      cast(total_principal_amount AS double) AS total_principal_amount) FROM c_wide
"""
KEYS = {
    "fact_transactions": ("f_t", ("date_key", "customer_key", "account_key", "branch_key", "channel_key", "txn_type_key")),
    "fact_daily_balances": ("f_b", ("date_key", "customer_key", "account_key", "branch_key")),
    "fact_loans": ("f_l", ("date_key", "customer_key", "branch_key", "loan_key")),
    "fact_loan_payments": ("f_p", ("date_key", "customer_key", "branch_key", "loan_key")),
}
PLAIN["q_key_coverage"] = " UNION ALL ".join(
    f"SELECT '{fact}' AS table_name, '{k}' AS key_name, count(*) AS row_count, count({k}) AS known FROM {cte}"
    for fact, (cte, keys) in KEYS.items() for k in keys
)
PLAIN["q_duplicate_keys"] = "SELECT loan_id, count(*) AS row_count FROM raw_loans GROUP BY loan_id HAVING count(*) > 1"
COUNTED = {"dim_customer": "d_customer", "dim_account": "d_account", "dim_loan": "d_loan",
           **{fact: cte for fact, (cte, _) in KEYS.items()}}
PLAIN["q_row_counts"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {cte}" for t, cte in COUNTED.items())
SERVED = {**COUNTED, "dim_branch": "d_branch", "dim_card": "d_card", "dim_channel": "d_channel",
          "dim_txn_type": "d_txn_type", "dim_date": "d_date"}
PLAIN["q_warehouse"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {cte}" for t, cte in SERVED.items())
CHECKS = {
    ("branches", "null_branch_id"): "SELECT count(*) AS n FROM cl_branches WHERE branch_id IS NULL",
    ("cards", "orphan_parent"): "SELECT count(*) AS n FROM rj_cards",
    ("dim_loan", "duplicate_loan_id"): "SELECT count(*) AS n FROM (SELECT loan_id FROM d_loan GROUP BY loan_id HAVING count(*) > 1)",
    ("loan_payments", "null_payment_date"): "SELECT count(*) AS n FROM sv_payments WHERE payment_date IS NULL",
    **{(fact, f"unknown_{k}"): f"SELECT count(*) - count({k}) AS n FROM {cte}" for fact, (cte, keys) in KEYS.items() for k in keys},
}
PLAIN["q_dq_results"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{rule}' AS rule_name, n AS row_count, 'batch-1' AS batch_id, {LOAD} AS execution_ts FROM ({sql})"
    for (t, rule), sql in CHECKS.items())
PLAIN["q_balances_append"] = """
    SELECT * REPLACE (cast(snapshot_date AS varchar) AS snapshot_date,
                      CASE WHEN day(snapshot_date) < 10 THEN 0 ELSE end_of_day_balance END AS end_of_day_balance)
    FROM raw_balances_daily
"""
PLAIN["q_daily_load"] = PLAIN["q_fact_daily_balances"]
PLAIN |= {f"q_load_{name}": PLAIN[f"q_{name}"] for name in ("branch_daily", "branch_daily_wide", "customer_daily_wide")}
PLAIN["q_dq_history"] = f"""
    SELECT * FROM ({PLAIN["q_dq_results"]})
    UNION ALL SELECT * REPLACE ('batch-2' AS batch_id) FROM ({PLAIN["q_dq_results"]})
"""
PLAIN["q_balances_evolve"] = """
    SELECT account_id, customer_id, branch_id, cast(snapshot_date AS varchar) AS snapshot_date, end_of_day_balance,
           cast(NULL AS varchar) AS currency FROM raw_balances_daily
    UNION ALL SELECT account_id, customer_id, branch_id, cast(snapshot_date AS varchar), end_of_day_balance, currency
    FROM raw_balances_daily
"""
ALL_TABLES = ("benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels", "lineitem", "nation",
              "orders", "pages", "part", "region", "supplier")
PLAIN["q_ingest_all"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ALL_TABLES)
PLAIN["q_copy_changes"] = " UNION ALL ".join(
    f"SELECT {run} AS run, 'dbo.{t}' AS table_name, '{action}' AS action, {run % 2} AS files"
    for run, action in ((1, "copied"), (2, "kept")) for t in ALL_TABLES)
PLAIN |= {f"q_copied_{t}": f"SELECT * FROM {t}" for t in ALL_TABLES}
PLAIN["q_copied_events"] = "SELECT * REPLACE (round(value, 6) AS value) FROM events"
PLAIN["q_copied_embeddings"] = """
    SELECT vec_id, label, unnest(range(0, len(embedding))) AS place, round(cast(unnest(embedding) AS double), 6) AS x FROM embeddings
"""
PLAIN |= {f"q_served_{t}": PLAIN[f"q_{t}"] for t in SERVED}
PLAIN["q_first_word"] = "SELECT p_partkey, p_name, split_part(trim(p_name), ' ', 1) AS word FROM part"
CTES["spending"] = """
    SELECT c_mktsegment, o_custkey, sum(cast(o_totalprice AS decimal(18,2))) AS spent
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment, o_custkey
"""
RANKED = """
    SELECT c_mktsegment, o_custkey, cast(spent AS double) AS spent, dense_rank() OVER w AS rank,
           cast(sum(spent) OVER w AS double) AS running
    FROM spending WINDOW w AS ({part} ORDER BY spent DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""
PLAIN["q_rank_running"] = RANKED.format(part="")
PLAIN["q_rank_running_within"] = RANKED.format(part="PARTITION BY c_mktsegment")
PLAIN["q_rank_running_double"] = """
    SELECT o_custkey, spent, dense_rank() OVER w AS rank, sum(spent) OVER w AS running
    FROM (SELECT o_custkey, cast(spent * 100 AS double) / 8 AS spent FROM spending)
    WINDOW w AS (ORDER BY spent DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""
PLAIN["q_top_with_ties"] = """
    SELECT c_mktsegment, o_custkey, cast(spent AS double) AS spent FROM spending
    QUALIFY rank() OVER (PARTITION BY c_mktsegment ORDER BY spent DESC) <= 10
"""
PLAIN["q_latest_order"] = """
    SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
"""



# -- measure packs -----------------------------------------------------------------------
# A pack is: aggregates per group (the columns of g), then expressions over them.

F = "is_fraud_label = 1"
HV = "amount >= 100000"
TXN_AGG = {
    "n": dc("transaction_id"), "amt": "sum(amount)", "cust": dc("customer_key"), "acc": dc("account_key"),
    "br": dc("branch_key"), "cr_n": dc("transaction_id", "direction = 'CREDIT'"), "de_n": dc("transaction_id", "direction = 'DEBIT'"),
    "cr_a": "sum(amount) FILTER (WHERE direction = 'CREDIT')", "de_a": "sum(amount) FILTER (WHERE direction = 'DEBIT')",
    "fr_n": rows(F), "fr_a": f"sum(amount) FILTER (WHERE {F})", "hv_n": dc("transaction_id", HV),
    "hv_a": f"sum(amount) FILTER (WHERE {HV})", "hvf_n": dc("transaction_id", f"{HV} AND {F}"),
    "cp": dc("counterparty"), "mc": dc("merchant_category"), "cnt": "nullif(count(transaction_id), 0)",
    "risky": f"nullif(count(DISTINCT customer_key) FILTER (WHERE {F}), 0)",
}
TXN_OUT = {
    "total_transactions": "n", "total_transaction_amount": "amt", "average_transaction_amount": div0("amt", "n"),
    "transacting_customers": "cust", "transacting_accounts": "acc", "active_transaction_branches": "br",
    "transactions_per_customer": div0("n", "cust"), "transactions_per_branch": div0("n", "br"),
    "credit_transactions": "cr_n", "debit_transactions": "de_n", "credit_amount": "cr_a", "debit_amount": "de_a",
    "net_transaction_flow": minus("cr_a", "de_a"), "credit_share_pct": div0("cr_a", "amt"),
    "fraud_transaction_count": "fr_n", "non_fraud_transactions": minus("n", "fr_n"), "fraud_amount": "fr_a",
    "fraud_rate_pct": div0("fr_n", "n"), "fraud_amount_pct": div0("fr_a", "amt"), "average_fraud_amount": div0("fr_a", "fr_n"),
    "high_value_transactions": "hv_n", "high_value_transaction_amount": "hv_a", "high_value_fraud_transactions": "hvf_n",
    "unique_counterparties": "cp", "unique_merchant_categories": "mc", "average_amount_per_counterparty": div0("amt", "cp"),
    "fraud_rate_pct_by_channel": div("fr_n", "cnt"), "high_risk_customers_count": "risky", "fraud_loss_amount": "fr_a",
}
WHOLE = ("n", "cust", "acc", "br", "cr_n", "de_n", "fr_n", "hv_n", "hvf_n", "cp", "mc", "cnt", "risky")


def shown(out: dict[str, str], counts: set[str] = frozenset(), texts: set[str] = frozenset()) -> str:
    """Output columns: counts and texts as they are, all else as doubles to six places
    (sums have two decimals, so rounding leaves them alone)."""
    listed = []
    for name, sql in out.items():
        if name in counts:
            listed.append(f"cast({sql} AS bigint) AS {name}")
        elif name in texts:
            listed.append(f"{sql} AS {name}")
        else:
            listed.append(f"round(cast({sql} AS double), 6) AS {name}")
    return ", ".join(listed)


def aggregates(agg: dict[str, str]) -> str:
    return ", ".join(f"{sql} AS {name}" for name, sql in agg.items())


TXN_COUNTS = {name for name, sql in TXN_OUT.items() if sql in WHOLE} | {"non_fraud_transactions"}
TXN_COLS = shown(TXN_OUT, TXN_COUNTS)
PLAIN["m_txn"] = f"""
    SELECT branch_name, {TXN_COLS}
    FROM d_branch LEFT JOIN (SELECT branch_key, {aggregates(TXN_AGG)} FROM f_t GROUP BY branch_key) USING (branch_key)
"""
PLAIN["m_txn_total"] = f"SELECT {TXN_COLS} FROM (SELECT {aggregates(TXN_AGG)} FROM f_t)"
PLAIN["m_txn_by_channel"] = f"""
    SELECT channel_name, {TXN_COLS}
    FROM d_channel LEFT JOIN (SELECT channel_key, {aggregates(TXN_AGG)} FROM f_t GROUP BY channel_key) USING (channel_key)
"""
# measures of their own direction ignore the direction they are grouped by
OWN = ("cr_n", "de_n", "cr_a", "de_a")
PLAIN["m_txn_by_direction"] = f"""
    SELECT direction, {TXN_COLS}
    FROM (SELECT direction, {aggregates({k: v for k, v in TXN_AGG.items() if k not in OWN})} FROM f_t GROUP BY direction),
         (SELECT {aggregates({k: TXN_AGG[k] for k in OWN})} FROM f_t)
"""
PLAIN["m_txn_filtered"] = f"""
    SELECT region, {TXN_COLS}
    FROM (SELECT DISTINCT region FROM d_branch) LEFT JOIN (
        SELECT region, {aggregates(TXN_AGG)} FROM f_t JOIN d_branch USING (branch_key)
        WHERE customer_key IN (SELECT customer_key FROM d_customer WHERE segment IN ('BUILDING', 'PREMIUM'))
          AND date_key // 10000 BETWEEN 1996 AND 1998
        GROUP BY region) USING (region)
"""

LOAN_AGG = {
    "n": "nullif(count(*), 0)", "cust": dc("customer_key"), "br": dc("branch_key"), "pr": "sum(principal_amount)",
    "ten": "avg(tenure_months)", "apr": "avg(cast(interest_rate_apr AS double))",
    "wsum": "sum(principal_amount * interest_rate_apr)", "act": rows("status = 'ACTIVE'"), "clo": rows("status = 'CLOSED'"),
    "npa": rows("status = 'NPA'"),
}
LOAN_OUT = {
    "total_loans": "n", "loan_customers": "cust", "loan_branches": "br", "total_principal_disbursed": "pr",
    "average_loan_size": div0("pr", "n"), "average_loan_tenure": "ten", "average_interest_rate": "apr / 100",
    "weighted_avg_apr": div0("wsum", "pr"), "active_loans": "act", "closed_loans": "clo",
    "active_loan_pct": div0("act", "n"), "closed_loan_pct": div0("clo", "n"), "loans_per_loan_customer": div0("n", "cust"),
    "principal_per_loan_customer": div0("pr", "cust"), "npa_pct": div0("npa", "n"),
}
PLAIN["m_loan"] = f"""
    SELECT "Year", {shown(LOAN_OUT, {"total_loans", "loan_customers", "loan_branches", "active_loans", "closed_loans"})}
    FROM (SELECT DISTINCT "Year" FROM d_date)
    LEFT JOIN (SELECT date_key // 10000 AS "Year", {aggregates(LOAN_AGG)} FROM f_l GROUP BY 1) USING ("Year")
"""

PAY_AGG = {
    "pn": dc("payment_id"), "pa": "cast(sum(pay_cents) AS double) / 100", "pc": dc("customer_key"), "pl": dc("loan_key"),
    "pb": dc("branch_key"), "good": dc("payment_id", "status IN ('SUCCESS', 'PAID')"), "bad": dc("payment_id", "status = 'FAILED'"),
}
PAY_OUT = {
    "total_payments": "pn", "total_payment_amount": "pa", "average_payment_amount": div0("pa", "pn"),
    "paying_customers": "pc", "loans_with_payments": "pl", "payment_branches": "pb", "payments_per_loan": div0("pn", "pl"),
    "payment_amount_per_loan": div0("pa", "pl"), "successful_payments": "good", "failed_payments": "bad",
    "payment_success_rate_pct": div0("good", "pn"), "payment_failure_rate_pct": div0("bad", "pn"),
    "repayment_to_disbursement_pct": div0("pa", "pr"), "loans_with_no_payments": minus("ln", "pl"),
    "loan_payment_penetration_pct": div0("pl", "ln"), "distinct_paid_loans": "pl",
}
PAY_COUNTS = {"total_payments", "paying_customers", "loans_with_payments", "payment_branches", "successful_payments",
              "failed_payments", "loans_with_no_payments", "distinct_paid_loans"}
PLAIN["m_pay"] = f"""
    SELECT region, {shown(PAY_OUT, PAY_COUNTS)}
    FROM (SELECT DISTINCT region FROM d_branch)
    LEFT JOIN (SELECT region, {aggregates(PAY_AGG)} FROM f_p JOIN d_branch USING (branch_key) GROUP BY region) USING (region)
    LEFT JOIN (SELECT region, count(*) AS ln, sum(principal_amount) AS pr FROM f_l JOIN d_branch USING (branch_key)
               GROUP BY region) USING (region)
"""

CTES["per_branch"] = f"""
    SELECT branch_key, branch_name, region, is_active, tn, ta, tf, tc, ln, lc, la, pa, bal, both_n FROM d_branch
    LEFT JOIN (SELECT branch_key, {dc("transaction_id")} AS tn, sum(amount) AS ta, {rows(F)} AS tf, {dc("customer_key")} AS tc
               FROM f_t GROUP BY branch_key) USING (branch_key)
    LEFT JOIN (SELECT branch_key, count(*) AS ln, {dc("customer_key")} AS lc, sum(principal_amount) AS la
               FROM f_l GROUP BY branch_key) USING (branch_key)
    LEFT JOIN (SELECT branch_key, cast(sum(pay_cents) AS double) / 100 AS pa FROM f_p GROUP BY branch_key) USING (branch_key)
    LEFT JOIN (SELECT branch_key, sum(end_of_day_balance) AS bal FROM f_b GROUP BY branch_key) USING (branch_key)
    LEFT JOIN (SELECT branch_key, count(*) AS both_n FROM (SELECT branch_key, customer_key FROM f_l
               INTERSECT SELECT branch_key, customer_key FROM f_t) GROUP BY branch_key) USING (branch_key)
"""
OVERLAP_OUT = {
    "customers_with_both_loans_and_transactions": "both_n", "loan_customers_doing_transactions_pct": div0("both_n", "lc"),
    "transaction_customers_with_loans_pct": div0("both_n", "tc"), "transaction_only_customers": minus("tc", "both_n"),
    "loan_only_customers": minus("lc", "both_n"),
}
PLAIN["m_overlap"] = f"""
    SELECT branch_name, {shown(OVERLAP_OUT, {"customers_with_both_loans_and_transactions", "transaction_only_customers", "loan_only_customers"})}
    FROM per_branch
"""
ACTIVE = "CASE WHEN is_active = 1 THEN tc END"
BRANCH_OUT = {
    "branch_balance": "bal", "branch_loan_amount": "la", "branch_payment_amount": "pa",
    "avg_transactions_per_branch": div("tn", "1"), "payment_to_loan_principal_pct": div0("pa", "la"),
    "avg_loan_disbursement_per_branch": div("la", "1"), "active_customers": ACTIVE,
    "branch_efficiency_score": div("tn", ACTIVE), "loan_to_deposit_ratio": div("la", "bal"),
    "loan_to_avg_balance_ratio": div("la", "bal"),
}
PLAIN["m_branch"] = f"SELECT branch_name, {shown(BRANCH_OUT, {'active_customers'})} FROM per_branch"


def exec_pack(name: str, group: str, of_key: str, fixed: str) -> str:
    amounts = f"""
        SELECT {of_key} AS {group}, ta, tf, fa, NULL AS la, NULL AS ln, NULL AS pa, NULL AS bal FROM (
            SELECT date_key, sum(amount) AS ta, count(*) FILTER (WHERE {F}) AS tf, sum(amount) FILTER (WHERE {F}) AS fa
            FROM f_t GROUP BY date_key)
        UNION ALL SELECT {of_key}, NULL, NULL, NULL, la, ln, NULL, NULL
        FROM (SELECT date_key, sum(principal_amount) AS la, count(*) AS ln FROM f_l GROUP BY date_key)
        UNION ALL SELECT {of_key}, NULL, NULL, NULL, NULL, NULL, pa, NULL
        FROM (SELECT date_key, sum(pay_cents) AS pa FROM f_p GROUP BY date_key)
        UNION ALL SELECT {of_key}, NULL, NULL, NULL, NULL, NULL, NULL, bal
        FROM (SELECT date_key, sum(end_of_day_balance) AS bal FROM f_b GROUP BY date_key)
    """
    out = {
        "total_loan_amount": "la", "loan_rows_by_date": "ln", "loan_rows": "ln", "total_loan_amount_fixed": fixed,
        "loan_to_payment_ratio": div0("pa", "la"), "loan_to_balance_ratio": div0("la", "bal"), "total_balance": "bal",
        "branch_fraud_count": "tf", "loan_vs_payment_gap": minus("la", "pa"), "repayment_coverage_pct": div0("pa", "la"),
        "loan_to_balance_ratio_pct": div0("la", "bal"), "net_contribution": minus(plus("ta", "pa"), "la"),
        "segment_risk_score": plus(minus("(la * 0.5)", "(pa * 0.3)"), "(fa * 0.2)"),
    }
    return f"""
    SELECT {name}, {shown(out, {"loan_rows_by_date", "loan_rows", "branch_fraud_count"})}
    FROM (SELECT DISTINCT {group} FROM (SELECT *, cast("Date" AS varchar) AS day_text FROM d_date)) LEFT JOIN (
        SELECT {group}, sum(ta) AS ta, nullif(sum(tf), 0) AS tf, sum(fa) AS fa, sum(la) AS la, sum(ln) AS ln,
               cast(sum(pa) AS decimal(28,0)) * 0.01 AS pa, sum(bal) AS bal
        FROM ({amounts}) GROUP BY 1) USING ({group})
    """


PLAIN["m_exec"] = exec_pack('"Year"', '"Year"', "date_key // 10000", "cast(NULL AS double)")
PLAIN["m_exec_day"] = exec_pack(
    'day_text AS "Date"', "day_text",
    "cast(strptime(cast(date_key AS varchar), '%Y%m%d') AS date)::varchar", "la")


def segment_pack(group: str, customers: str, loans: str, all_borrowers: str) -> str:
    """Loans reach the group only through the customers in context; ``loans`` are the
    loans the date filter leaves. Exposure and loan customers ignore customers."""
    return f"""
    SELECT {group}, cast(bor AS bigint) AS distinct_borrowers_by_bucket, cast(tot AS double) AS total_loan_exposure,
           round({div0("tot", "bor")}, 6) AS loan_per_customer, round({div0("bor", f"({all_borrowers})")}, 6) AS borrower_share_pct,
           cast(exposure AS double) AS total_loan_exposure_by_segment, n AS total_loans_by_segment,
           round({div0("top10", "tot")}, 6) AS top_10_customers_pct,
           CASE WHEN coalesce(exposure, 0) < 7500000 THEN 'Small' WHEN exposure < 9900000 THEN 'Medium'
                WHEN exposure < 15000000 THEN 'Large' ELSE 'High Value' END AS loan_bucket,
           cust AS customers_per_bucket, cast(exposure AS double) AS total_loan_exposure_by_segment_and_bucket,
           cast(bor AS bigint) AS distinct_borrowers_by_segment_and_bucket, round({div0("exposure", "tot")}, 6) AS exposure_pct,
           round({div0("bor", "cust")}, 6) AS borrower_pct
    FROM (SELECT DISTINCT {group} FROM d_customer WHERE {customers}) members
    LEFT JOIN (SELECT {group}, {dc("customer_key")} AS bor, sum(principal_amount) AS exposure, count(*) AS n
               FROM ({loans}) JOIN d_customer USING (customer_key) WHERE {customers} GROUP BY {group}) USING ({group})
    LEFT JOIN (SELECT {group}, sum(x) AS top10 FROM (
                   SELECT {group}, customer_id, sum(principal_amount) AS x FROM ({loans}) JOIN d_customer USING (customer_key)
                   WHERE {customers} GROUP BY {group}, customer_id
                   QUALIFY rank() OVER (PARTITION BY {group} ORDER BY sum(principal_amount) DESC) <= 10)
               GROUP BY {group}) USING ({group}),
         (SELECT sum(principal_amount) AS tot, {dc("customer_key")} AS cust FROM ({loans}))
    """


PLAIN["m_segment"] = segment_pack("segment", "TRUE", "SELECT * FROM f_l", "SELECT count(DISTINCT customer_key) FROM f_l")
# lifting the segment filter leaves the other filters and the grouping
PLAIN["m_segment_filtered"] = segment_pack(
    "risk_rating", "segment = 'BUILDING'", "SELECT * FROM f_l WHERE date_key >= 19980000",
    """SELECT count(DISTINCT customer_key) FROM f_l JOIN d_customer c USING (customer_key)
       WHERE date_key >= 19980000 AND c.risk_rating = members.risk_rating""")

SHARE_OUT = {
    "transaction_share_pct": div0("tn", "(SELECT count(DISTINCT transaction_id) FROM f_t)"),
    "transaction_amount_share_pct": div0("ta", "(SELECT sum(amount) FROM f_t)"),
    "loan_share_pct": div0("ln", "(SELECT count(*) FROM f_l)"),
    "principal_share_pct": div0("la", "(SELECT sum(principal_amount) FROM f_l)"),
    "payment_share_pct": div0("pa", "(SELECT cast(sum(pay_cents) AS double) / 100 FROM f_p)"),
    "fraud_rate_by_branch_pct": div0("tf", "tn"),
    "branch_deposit_share_pct": div0("bal", "(SELECT sum(end_of_day_balance) FROM f_b)"),
    "branch_transaction_share_pct": div0("ta", "(SELECT sum(amount) FROM f_t)"),
    "branch_loan_share_pct": div0("la", "(SELECT sum(principal_amount) FROM f_l)"),
    "loan_contribution_pct": div("la", "sum(la) OVER (PARTITION BY region)"),
    "transaction_contribution_pct": div("ta", "sum(ta) OVER (PARTITION BY region)"),
}
PLAIN["m_share"] = f"SELECT region, branch_name, {shown(SHARE_OUT)} FROM per_branch"

CTES["months"] = """
    SELECT Year_Month, max(Date_Key) AS last_key, min(Date_Key) AS first_key, "Year" * 12 + Month_Number AS idx, "Year" AS yr
    FROM d_date GROUP BY ALL
"""


def last_filled(fact: str, group: str = "Year_Month") -> str:
    """Last day of each month on which the fact has rows."""
    return f"SELECT Year_Month, max(Date_Key) AS day FROM d_date WHERE Date_Key IN (SELECT date_key FROM {fact}) GROUP BY Year_Month"


LAST_DAY = "SELECT Year_Month, last_key AS day FROM months"


def deposit(closing: str) -> str:
    out = {
        "total_deposit_balance": "bal", "deposit_customers": "cu", "deposit_accounts": "ac",
        "avg_deposit_balance_per_customer": div0("bal", "cu"), "avg_deposit_balance_per_account": div0("bal", "ac"),
        "deposit_branches": "br", "avg_deposit_balance_per_branch": div0("bal", "br"),
    }
    return f"""
    SELECT Year_Month, {shown(out, {"deposit_customers", "deposit_accounts", "deposit_branches"})}
    FROM (SELECT DISTINCT Year_Month FROM d_date) LEFT JOIN (
        SELECT Year_Month, sum(end_of_day_balance) AS bal, {dc("customer_key")} AS cu, {dc("account_key")} AS ac,
               {dc("branch_key")} AS br FROM f_b JOIN ({closing}) ON date_key = day GROUP BY Year_Month) USING (Year_Month)
    """


PLAIN["m_deposit"] = deposit(last_filled("f_b"))
PLAIN["m_deposit_calendar"] = deposit(LAST_DAY)


def portfolio(closing: str) -> str:
    cu = "customer_key"
    agg = {
        "pc": dc(cu), "bal": "sum(total_balance)", "tn": "sum(transaction_count)", "ta": "sum(transaction_amount)",
        "na": "sum(account_count)", "nc": "sum(card_count)", "nl": "sum(loan_count)",
        "wa": dc(cu, "account_count > 0"), "wc": dc(cu, "card_count > 0"), "wl": dc(cu, "loan_count > 0"),
        "multi": rows("cast(account_count > 0 AS int) + cast(card_count > 0 AS int) + cast(loan_count > 0 AS int) >= 2"),
        "fn": "sum(fraud_txn_count)", "wf": dc(cu, "fraud_txn_count > 0"),
    }
    out = {
        "portfolio_customers": "pc", "customer_portfolio_balance": "bal", "avg_portfolio_balance_per_customer": div0("bal", "pc"),
        "customer_transaction_count_snapshot": "tn", "customer_transaction_amount_snapshot": "ta",
        "avg_transactions_per_customer": div0("tn", "pc"), "avg_transaction_amount_per_customer": div0("ta", "pc"),
        "avg_accounts_per_customer_snapshot": div0("na", "pc"), "avg_cards_per_customer_snapshot": div0("nc", "pc"),
        "avg_loans_per_customer_snapshot": div0("nl", "pc"), "avg_products_per_customer": div0("(na + nc + nl)", "pc"),
        "customers_with_account": "wa", "customers_with_card": "wc", "customers_with_loan": "wl",
        "multi_product_customers": "multi", "cross_sell_ratio_pct": div0("multi", "pc"),
        "account_penetration_pct": div0("wa", "pc"), "card_penetration_pct": div0("wc", "pc"),
        "loan_penetration_pct": div0("wl", "pc"), "customer_fraud_txn_count_snapshot": "fn",
        "customers_with_fraud_activity": "wf", "fraud_incidence_pct": div0("wf", "pc"),
        "fraud_txns_per_fraud_customer": div0("fn", "wf"),
    }
    counts = {"portfolio_customers", "customer_transaction_count_snapshot", "customers_with_account", "customers_with_card",
              "customers_with_loan", "multi_product_customers", "customer_fraud_txn_count_snapshot", "customers_with_fraud_activity"}
    return f"""
    SELECT Year_Month, {shown(out, counts)}
    FROM (SELECT DISTINCT Year_Month FROM d_date) LEFT JOIN (
        SELECT Year_Month, {aggregates(agg)} FROM c_wide JOIN ({closing}) ON date_key = day GROUP BY Year_Month) USING (Year_Month)
    """


PLAIN["m_portfolio"] = portfolio(last_filled("c_wide"))
PLAIN["m_portfolio_calendar"] = portfolio(LAST_DAY)

TIME_OUT = {
    "transaction_amount_mtd": "t_mtd", "transaction_amount_ytd": "t_ytd", "previous_month_transaction_amount": "t_pm",
    "mom_transaction_growth_pct": div0(minus("t", "t_pm"), "t_pm"),
    "principal_disbursed_mtd": "l_mtd", "principal_disbursed_ytd": "l_ytd", "previous_month_principal_disbursed": "l_pm",
    "mom_loan_disbursement_growth_pct": div0(minus("l", "l_pm"), "l_pm"),
    "payment_amount_mtd": "p_mtd", "payment_amount_ytd": "p_ytd", "previous_month_payment_amount": "p_pm",
    "mom_payment_growth_pct": div0(minus("p", "p_pm"), "p_pm"),
    "deposit_balance_mtd": "b_mtd", "deposit_balance_ytd": "b_ytd", "previous_month_deposit_balance": "b_pm",
    "mom_deposit_growth_pct": div0(minus("b", "b_pm"), "b_pm"),
    "previous_month_portfolio_balance": "c_pm", "mom_portfolio_growth_pct": div0(minus("c", "c_pm"), "c_pm"),
    "loan_growth_pct": div0(minus("l", "l_pm"), "l_pm"), "previous_period_loan_exposure": "l_pm",
    "loan_amount_pm": "l_pm", "loan_mom_pct": div(minus("l", "l_pm"), "l_pm"),
}
CTES["by_day"] = """
    SELECT "Date", Date_Key, Year_Month, "Year" AS yr, "Year" * 12 + Month_Number AS idx, t, l, p, b, c FROM d_date
    LEFT JOIN (SELECT date_key AS Date_Key, sum(amount) AS t FROM f_t GROUP BY 1) USING (Date_Key)
    LEFT JOIN (SELECT date_key AS Date_Key, sum(principal_amount) AS l FROM f_l GROUP BY 1) USING (Date_Key)
    LEFT JOIN (SELECT date_key AS Date_Key, cast(sum(pay_cents) AS decimal(28,0)) * 0.01 AS p FROM f_p GROUP BY 1) USING (Date_Key)
    LEFT JOIN (SELECT date_key AS Date_Key, sum(end_of_day_balance) AS b FROM f_b GROUP BY 1) USING (Date_Key)
    LEFT JOIN (SELECT date_key AS Date_Key, sum(total_balance) AS c FROM c_wide GROUP BY 1) USING (Date_Key)
"""
# closing values: the last day that has any, in the month and in the year so far
CTES["by_month"] = """
    SELECT Year_Month, idx, yr, sum(t) AS t, sum(l) AS l, sum(p) AS p, arg_max(b, "Date") FILTER (WHERE b IS NOT NULL) AS b,
           arg_max(c, "Date") FILTER (WHERE c IS NOT NULL) AS c
    FROM by_day GROUP BY ALL
"""
PLAIN["m_time_month"] = f"""
    SELECT Year_Month, {shown(TIME_OUT)} FROM (
        SELECT m.Year_Month, m.t, m.l, m.p, m.b, m.c, m.t AS t_mtd, m.l AS l_mtd, m.p AS p_mtd, m.b AS b_mtd,
               sum(m.t) OVER y AS t_ytd, sum(m.l) OVER y AS l_ytd, sum(m.p) OVER y AS p_ytd,
               last_value(m.b IGNORE NULLS) OVER y AS b_ytd,
               q.t AS t_pm, q.l AS l_pm, q.p AS p_pm, q.b AS b_pm, q.c AS c_pm
        FROM by_month m LEFT JOIN by_month q ON q.idx = m.idx - 1
        WINDOW y AS (PARTITION BY m.yr ORDER BY m.idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""
PLAIN["m_time_day"] = f"""
    SELECT cast("Date" AS varchar) AS "Date", {shown(TIME_OUT)} FROM (
        SELECT m."Date", m.t, m.l, m.p, m.b, m.c, sum(m.t) OVER mo AS t_mtd, sum(m.l) OVER mo AS l_mtd,
               sum(m.p) OVER mo AS p_mtd, last_value(m.b IGNORE NULLS) OVER mo AS b_mtd,
               sum(m.t) OVER y AS t_ytd, sum(m.l) OVER y AS l_ytd, sum(m.p) OVER y AS p_ytd,
               last_value(m.b IGNORE NULLS) OVER y AS b_ytd,
               q.t AS t_pm, q.l AS l_pm, q.p AS p_pm, q.b AS b_pm, q.c AS c_pm
        FROM by_day m LEFT JOIN by_day q ON q."Date" = cast(m."Date" - INTERVAL 1 MONTH AS date)
        WINDOW mo AS (PARTITION BY m.idx ORDER BY m."Date" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
               y AS (PARTITION BY m.yr ORDER BY m."Date" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""
PLAIN["m_time_filtered"] = f"SELECT * FROM ({PLAIN['m_time_month']}) WHERE Year_Month LIKE '1998%'"
PLAIN["m_deposit_filtered"] = f"SELECT * FROM ({PLAIN['m_deposit']}) WHERE Year_Month LIKE '2024%'"
CTES["customer_buckets"] = """
    SELECT customer_key, CASE WHEN coalesce(x, 0) < 7500000 THEN 'Small' WHEN x < 9900000 THEN 'Medium'
                              WHEN x < 15000000 THEN 'Large' ELSE 'High Value' END AS Loan_Bucket
    FROM d_customer LEFT JOIN (SELECT customer_key, sum(principal_amount) AS x FROM f_l GROUP BY 1) USING (customer_key)
"""
PLAIN["m_bucket"] = f"""
    SELECT Loan_Bucket, cust AS customers_per_bucket, cast(bor AS bigint) AS distinct_borrowers_by_bucket,
           round({div0("exposure", "tot")}, 6) AS exposure_pct
    FROM (SELECT DISTINCT Loan_Bucket FROM customer_buckets)
    LEFT JOIN (SELECT Loan_Bucket, {dc("customer_key")} AS bor, sum(principal_amount) AS exposure
               FROM f_l JOIN customer_buckets USING (customer_key) GROUP BY Loan_Bucket) USING (Loan_Bucket),
         (SELECT sum(principal_amount) AS tot, {dc("customer_key")} AS cust FROM f_l)
"""
REGION_MONTH = {
    "total_transactions": "n", "total_transaction_amount": "t", "transaction_amount_mtd": "t",
    "transaction_amount_ytd": "t_ytd", "previous_month_transaction_amount": "t_pm",
    "mom_transaction_growth_pct": div0(minus("t", "t_pm"), "t_pm"),
}
CTES["region_months"] = """
    SELECT region, Year_Month, idx, yr, n, t
    FROM (SELECT DISTINCT region FROM d_branch) CROSS JOIN (SELECT Year_Month, idx, yr FROM months)
    LEFT JOIN (SELECT region, Year_Month, count(DISTINCT transaction_id) AS n, sum(amount) AS t
               FROM f_t JOIN d_branch USING (branch_key) JOIN d_date d ON f_t.date_key = d.Date_Key
               GROUP BY region, Year_Month) USING (region, Year_Month)
"""
# combinations are shown where any of the sums exists
PLAIN["m_txn_region_month"] = f"""
    SELECT region, Year_Month, {shown(REGION_MONTH, {"total_transactions"})} FROM (
        SELECT m.region, m.Year_Month, m.n, m.t, sum(m.t) OVER y AS t_ytd, q.t AS t_pm
        FROM region_months m LEFT JOIN region_months q ON q.region = m.region AND q.idx = m.idx - 1
        WINDOW y AS (PARTITION BY m.region, m.yr ORDER BY m.idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    WHERE n IS NOT NULL OR t_ytd IS NOT NULL OR t_pm IS NOT NULL
"""
PARETO_OUT = {
    "customer_rank_by_exposure": "place", "cumulative_loan_exposure": "run", "total_loan_exposure_overall": "whole",
    "cumulative_exposure_pct": div("run", "whole"),
    "top_80_pct_flag": f"CASE WHEN coalesce({div('run', 'whole')}, 0) <= 0.8 THEN 'Top Contributors' ELSE 'Others' END",
    "color_flag": f"CASE WHEN coalesce({div('run', 'whole')}, 0) <= 0.8 THEN '#2ECC71' ELSE '#D3D3D3' END",
}
PLAIN["m_pareto"] = f"""
    SELECT full_name, {shown(PARETO_OUT, {"customer_rank_by_exposure"}, {"top_80_pct_flag", "color_flag"})} FROM (
        SELECT full_name, dense_rank() OVER w AS place, sum(x) OVER w AS run, sum(x) OVER () AS whole FROM (
            SELECT full_name, coalesce(sum(principal_amount), 0) AS x
            FROM d_customer LEFT JOIN f_l USING (customer_key) GROUP BY full_name)
        WINDOW w AS (ORDER BY x DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""
CTES["name_exposure"] = """
    SELECT branch_name, full_name, sum(principal_amount) AS x
    FROM f_l JOIN d_branch USING (branch_key) LEFT JOIN d_customer USING (customer_key) GROUP BY ALL
"""
PLAIN["m_pareto_branch"] = f"""
    SELECT branch_name, {shown(PARETO_OUT, {"customer_rank_by_exposure"}, {"top_80_pct_flag", "color_flag"})} FROM (
        SELECT branch_name, 1 + count(DISTINCT CASE WHEN e.x > own THEN e.x END) AS place,
               sum(CASE WHEN e.x >= own THEN e.x END) AS run, sum(e.x) AS whole
        FROM (SELECT branch_name, coalesce(sum(x) FILTER (WHERE full_name LIKE '%7'), 0) AS own
              FROM (SELECT DISTINCT branch_name FROM d_branch) LEFT JOIN name_exposure USING (branch_name) GROUP BY branch_name)
        LEFT JOIN name_exposure e USING (branch_name) GROUP BY branch_name)
"""
PLAIN["m_apart"] = f"""
    SELECT region, channel_name, {shown({"total_loans": "ln", "total_principal_disbursed": "la", "total_payment_amount": "pa"}, {"total_loans"})}
    FROM (SELECT region, sum(ln) AS ln, sum(la) AS la, sum(pa) AS pa FROM per_branch GROUP BY region)
    CROSS JOIN (SELECT DISTINCT channel_name FROM d_channel) WHERE ln IS NOT NULL OR la IS NOT NULL OR pa IS NOT NULL
"""

ORACLES: dict[str, str] = {name: with_ctes(sql) for name, sql in PLAIN.items()}
