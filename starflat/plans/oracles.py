"""The registered queries as SQL for DuckDB, written from the definitions.

Nothing here is shared with the Spark code but names, so a wrong expression does
not confirm itself.
"""

from __future__ import annotations

_ZONE = "AT TIME ZONE 'America/Sao_Paulo' AT TIME ZONE 'UTC'"

_BANK = """
WITH member AS (
  SELECT c_custkey AS member_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         CAST(18 + c_custkey % 63 AS INTEGER) AS age,
         replace(lower(c_name), '#', '.') || '@mail.example' AS email
  FROM customer),
account AS (
  SELECT o_custkey * 10 + CAST(left(o_orderpriority, 1) AS INTEGER) AS account_id,
         o_custkey AS owner_id, o_orderpriority AS account_type, min(o_orderdate) AS created
  FROM orders GROUP BY o_custkey, o_orderpriority),
card AS (
  SELECT o_orderkey AS card_id, '4' || lpad(CAST(o_orderkey AS VARCHAR), 15, '0') AS number,
         'HOLDER ' || o_custkey AS printed_name, o_orderdate AS created,
         o_custkey * 10 + CAST(left(o_orderpriority, 1) AS INTEGER) AS account_id,
         o_custkey AS holder_id
  FROM orders),
txn AS (
  SELECT l_orderkey * 10 + l_linenumber AS txn_id,
         CAST(l_extendedprice AS DECIMAL(20,2)) AS amount,
         'Purchase ' || l_returnflag || '/' || l_linestatus AS description,
         l_shipdate AS txn_time, l_orderkey AS card_id,
         CASE l_returnflag WHEN 'R' THEN 'refund' WHEN 'A' THEN 'credit' ELSE 'debit' END
           AS txn_type,
         l_partkey AS category_id, l_suppkey AS merchant_id
  FROM lineitem)
"""

_FLAT = (
    _BANK
    + f""", flat AS (
  SELECT m.first_name AS member_first_name, m.last_name AS member_last_name,
         m.age AS member_age,
         left(m.email, 3) || '****@mail.example' AS email_masked,
         sha256(m.email || 'demo-salt') AS email_hash,
         t.txn_id, t.amount AS txn_amount, t.description AS txn_description,
         t.txn_time {_ZONE} AS txn_time,
         left(c.number, 6) || '******' || right(c.number, 4) AS card_masked,
         sha256(c.number || 'demo-salt') AS card_hash,
         c.printed_name AS card_printed_name,
         c.created {_ZONE} AS card_created,
         a.account_type, a.created {_ZONE} AS account_created,
         CAST(t.txn_time {_ZONE} AS DATE) AS event_date
  FROM txn t JOIN card c ON t.card_id = c.card_id
  JOIN account a ON c.account_id = a.account_id
  JOIN member m ON c.holder_id = m.member_id)
"""
)

_VIEW = (
    _BANK
    + """, star AS (
  SELECT t.txn_id, t.amount, t.description, t.txn_time, t.txn_type, t.category_id,
         t.merchant_id, c.number AS card_number, c.printed_name AS card_printed_name,
         c.created AS card_created, a.account_type, a.created AS account_created,
         m.first_name AS member_first_name, m.last_name AS member_last_name,
         m.age AS member_age, m.email AS member_email
  FROM txn t, card c, account a, member m
  WHERE t.card_id = c.card_id AND c.account_id = a.account_id AND c.holder_id = m.member_id)
"""
)

_ACTIVITY = f"""
WITH flat AS (
  SELECT e.event_id, e.event_type, CAST(e.value AS DECIMAL(20,2)) AS amount,
         e.ts {_ZONE} AS event_time, c.c_name AS member_name,
         'cus****@mail.example' AS email_masked,
         sha256(replace(lower(c.c_name), '#', '.') || '@mail.example' || 'demo-salt')
           AS email_hash,
         n.n_name AS nation, CAST(e.ts {_ZONE} AS DATE) AS event_date
  FROM events e JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)
"""

# The end of the first fifth of the days of the events, on which the drift lies.
_EARLY = """(SELECT min(ts)::DATE + CAST((max(ts)::DATE - min(ts)::DATE) // 5 AS INTEGER) FROM events)"""

_GAPS = """
WITH gaps AS (
  SELECT event_id, ts, user_id,
         CASE event_type WHEN 'error' THEN NULL WHEN 'signup' THEN '' ELSE event_type END
           AS event_type,
         value, props
  FROM events)
"""

# n rows of which bad break the check; above the threshold the status is the level.
_CHECK = """
SELECT table_name, check_name, column_name,
       CASE WHEN n > 0 AND bad * 1.0 / n > threshold THEN level ELSE 'PASS' END AS status,
       round(CASE WHEN n = 0 THEN 0.0 ELSE CAST(bad AS DOUBLE) / n END, 6) AS value,
       CAST(bad AS BIGINT) AS bad_rows, CAST(n AS BIGINT) AS total_rows
FROM counted
"""

_ARRIVED = "CAST(ts AS DATE) + CAST(event_id % {delay} AS INTEGER) <= {day}"


def _load_day(tenths: int) -> str:
    """The day after which so many tenths of the days of all events are over."""
    days = "(CAST(max(ts) AS DATE) - CAST(min(ts) AS DATE))"
    return (
        f"(SELECT CAST(min(ts) AS DATE) + CAST({days} * {tenths} // 10 AS INTEGER) FROM events)"
    )


_FIRST_DAY, _SECOND_DAY = _load_day(4), _load_day(7)


def _counted(prelude: str, *selects: str) -> str:
    start = prelude + ", " if prelude else "WITH "
    columns = "(table_name, check_name, column_name, level, threshold, bad, n)"
    return f"{start}counted{columns} AS ({' UNION ALL '.join(selects)}) {_CHECK}"


def _profile(table: str, column: str, number: str | None, text: bool) -> str:
    stats = "CAST(NULL AS DOUBLE)"
    numeric = (
        [f"min({number})", f"max({number})", f"round(avg({number}), 4)"]
        + [f"round(stddev_samp({number}), 4)"]
        if number
        else [stats] * 4
    )
    length = f"round(avg(length({column})), 6)" if text else stats
    empty = f"count(*) FILTER (WHERE {column} = '')" if text else "CAST(0 AS BIGINT)"
    return f"""
    SELECT '{column}' AS column_name, count(*) AS total_count,
           count(*) - count({column}) AS null_count, count({column}) AS not_null_count,
           round(1.0 - CAST(count({column}) AS DOUBLE) / count(*), 6) AS null_ratio,
           round(CAST(count({column}) AS DOUBLE) / count(*), 6) AS completeness,
           {empty} AS empty_strings, {numeric[0]} AS min_value, {numeric[1]} AS max_value,
           {numeric[2]} AS avg_value, {numeric[3]} AS std_value, {length} AS avg_length
    FROM {table}"""


# NULL where the histogram's odd column is NaN or infinite.
_ODD = "CASE WHEN l_linenumber > 2 THEN l_quantity END"


def _histogram(name: str, column: str = "") -> str:
    column = column or name
    return f"""
    SELECT '{name}' AS column_name, CAST(b AS INTEGER) AS bucket,
           round(lo + (b - 1) * ((hi - lo) / 10), 4) AS lo,
           round(CASE WHEN b = 10 THEN hi ELSE lo + b * ((hi - lo) / 10) END, 4) AS hi,
           count(*) AS n
    FROM (SELECT least(floor(10.0 * (CAST({column} AS DOUBLE) - lo) / (hi - lo)) + 1, 10) AS b,
                 lo, hi
          FROM lineitem,
               (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi
                FROM lineitem)
          WHERE {column} IS NOT NULL)
    GROUP BY b, lo, hi"""


def _reported(column: str, data_type: str, numeric: bool) -> str:
    buckets, rows = "0", "CAST(0 AS BIGINT)"
    if numeric:
        lo, hi = f"(SELECT min({column}) FROM orders)", f"(SELECT max({column}) FROM orders)"
        place = f"least(floor(10.0 * ({column} - {lo}) / ({hi} - {lo})), 9)"
        buckets, rows = f"count(DISTINCT {place})", f"count({column})"
    return f"""
    SELECT '{column}' AS column_name, '{data_type}' AS data_type, count(*) AS total_count,
           count(*) - count({column}) AS null_count, CAST({buckets} AS INTEGER) AS buckets,
           {rows} AS bucket_rows
    FROM orders"""


def _partitions(role: str, table: str, key: str, low: int, high: int, small: int) -> str:
    return f"""
    SELECT '{role}' AS role, lo AS lower_bound, hi AS upper_bound,
           CAST(least(10, CASE WHEN hi - lo < p THEN greatest(1, n) ELSE p END) AS INTEGER)
             AS partitions
    FROM (SELECT lo, hi, n,
                 CASE WHEN n < {small} THEN greatest(1, least({low}, n // 1000 + 1))
                      ELSE greatest({low}, least({high}, n // 25000 + 1)) END AS p
          FROM (SELECT min({key}) AS lo, max({key}) AS hi, max({key}) - min({key}) + 1 AS n
                FROM {table}))"""


def _digest_part(part: int) -> str:
    return f"CAST('0x' || substr(h, {part * 8 + 1}, 8) AS BIGINT)"


def _children(table: str, key: str, count: str, factor: int, child: str, purpose: str) -> str:
    return f"""
    SELECT *, {key} * {factor} + k AS {child}
    FROM (SELECT *, unnest(generate_series(1, {count})) AS k
          FROM (SELECT *, md5('7|{purpose}|' || {key}) AS h FROM {table}))"""


_SYNTHETIC = f"""
WITH account AS (
  SELECT account_id, member_id,
         list_extract(['everyday', 'joint', 'reserve', 'youth'],
                      CAST({_digest_part(0)} % 4 + 1 AS INTEGER)) AS account_type,
         CAST(DATE '2024-12-31' - CAST({_digest_part(1)} % 2500 + 540 AS INTEGER) AS DATE)
           AS created,
         CAST(({_digest_part(2)} % 750000) / 100 AS DECIMAL(15,2)) AS balance,
         {_digest_part(3)} % 100 < 88 AS active
  FROM (SELECT account_id, member_id, md5('7|account|' || account_id) AS h FROM (
    {_children(
        "(SELECT c_custkey AS member_id FROM customer)",
        "member_id",
        f"CASE WHEN {_digest_part(0)} % 100 < 45 THEN 1 WHEN {_digest_part(0)} % 100 < 75 THEN 2 "
        f"WHEN {_digest_part(0)} % 100 < 90 THEN 3 ELSE 4 END",
        5,
        "account_id",
        "member",
    )}))),
card AS (
  SELECT card_id,
         CASE WHEN {_digest_part(0)} % 2 = 0 THEN '2' ELSE '6' END
           || lpad(CAST((card_id * 7919 + 104729) % 1000000000000000 AS VARCHAR), 15, '0')
           AS number,
         CAST(opened + CAST({_digest_part(1)} % 45 + 3 AS INTEGER) AS DATE) AS created,
         CAST(opened + CAST({_digest_part(1)} % 45 + 3 AS INTEGER) + 1461 AS DATE) AS expires,
         account_id, member_id,
         list_extract(['debit', 'credit', 'prepaid'],
                      CAST({_digest_part(2)} % 3 + 1 AS INTEGER)) AS card_type,
         CAST(CASE WHEN {_digest_part(2)} % 3 = 0 THEN 0
                   ELSE {_digest_part(3)} % 8000 + 250 END AS DECIMAL(10,2)) AS credit_limit
  FROM (SELECT card_id, account_id, member_id, created AS opened,
               md5('7|card|' || card_id) AS h
        FROM ({_children(
            "(SELECT account_id, member_id, created FROM account)",
            "account_id",
            f"CASE WHEN {_digest_part(0)} % 100 < 55 THEN 1 "
            f"WHEN {_digest_part(0)} % 100 < 85 THEN 2 ELSE 3 END",
            4,
            "card_id",
            "cards",
        )}))),
category(c, name, lo, hi) AS (
  VALUES (1, 'books', 4, 120), (2, 'fuel', 15, 110), (3, 'groceries', 8, 260),
         (4, 'insurance', 60, 900), (5, 'rent', 420, 2600), (6, 'sports', 12, 350),
         (7, 'travel', 75, 4200)),
drawn AS (
  SELECT txn_id, card_id, {_digest_part(0)} % 7 + 1 AS c, {_digest_part(1)} % 1000001 AS level,
         {_digest_part(2)} % 100 AS weight, CAST({_digest_part(3)} % 540 AS INTEGER) AS days
  FROM (SELECT txn_id, card_id, md5('7|txn|' || txn_id) AS h FROM ({_children(
      "(SELECT card_id FROM card)",
      "card_id",
      f"{_digest_part(0)} % 10 + 3",
      13,
      "txn_id",
      "transactions",
  )}))),
txn AS (
  SELECT txn_id, card_id,
         CAST(CASE WHEN weight >= 92 THEN -1 ELSE 1 END
              * ((lo * 100 + floor((hi - lo) * 100 * level / 1000000)) / 100)
              AS DECIMAL(10,2)) AS amount,
         CAST(DATE '2024-12-31' - days AS TIMESTAMP)
           + to_hours(CAST({_digest_part(0)} % 24 AS INTEGER))
           + to_minutes(CAST({_digest_part(1)} % 60 AS INTEGER))
           + to_seconds(CAST({_digest_part(2)} % 60 AS INTEGER)) AS txn_time,
         CASE WHEN weight < 78 THEN 'debit' WHEN weight < 92 THEN 'credit' ELSE 'refund' END
           AS txn_type,
         name AS category
  FROM (SELECT *, md5('7|clock|' || txn_id) AS h FROM drawn JOIN category USING (c)))
"""

_ISO = "strftime({c}, '%Y-%m-%dT%H:%M:%SZ')"

_MEMBER_STATS = """
SELECT m.member_id, m.first_name, m.last_name,
       coalesce(a.n, 0) AS total_accounts, coalesce(c.n, 0) AS total_cards,
       CAST(coalesce(t.n, 0) AS BIGINT) AS total_transactions,
       CAST(coalesce(t.debits, 0) AS DECIMAL(20,2)) AS total_debits,
       CAST(coalesce(t.credits, 0) AS DECIMAL(20,2)) AS total_credits
FROM member m
LEFT JOIN (SELECT owner_id, count(*) AS n FROM account GROUP BY owner_id) a
  ON m.member_id = a.owner_id
LEFT JOIN (SELECT holder_id, count(*) AS n FROM card GROUP BY holder_id) c
  ON m.member_id = c.holder_id
LEFT JOIN (SELECT holder_id, count(*) AS n,
                  sum(CASE WHEN txn_type = 'debit' THEN amount ELSE 0 END) AS debits,
                  sum(CASE WHEN txn_type = 'credit' THEN amount ELSE 0 END) AS credits
           FROM card JOIN txn USING (card_id) GROUP BY holder_id) t
  ON m.member_id = t.holder_id
"""

_MEMBER_STATS_RAW = """
SELECT m.member_id, m.first_name, m.last_name,
       count(DISTINCT a.account_id) AS total_accounts,
       count(DISTINCT c.card_id) AS total_cards,
       count(t.txn_id) AS total_transactions,
       CAST(coalesce(sum(CASE WHEN t.txn_type = 'debit' THEN t.amount ELSE 0 END), 0)
            AS DECIMAL(20,2)) AS total_debits,
       CAST(coalesce(sum(CASE WHEN t.txn_type = 'credit' THEN t.amount ELSE 0 END), 0)
            AS DECIMAL(20,2)) AS total_credits
FROM member m
LEFT JOIN account a ON m.member_id = a.owner_id
LEFT JOIN card c ON m.member_id = c.holder_id
LEFT JOIN txn t ON c.card_id = t.card_id
GROUP BY m.member_id, m.first_name, m.last_name
"""

_SUITES = (
    """SELECT 'card', 'completeness', 'card_id,number,account_id,holder_id', 'FAIL', 1.0, 0,
              count(*) FROM card""",
    """SELECT 'card', 'null', 'number', 'FAIL', 0.01, count(*) - count(number), count(*)
       FROM card""",
    """SELECT 'card', 'duplicate', 'number', 'FAIL', 0.0,
              count(*) - count(DISTINCT number), count(*) FROM card""",
    """SELECT 'card', 'format', 'number', 'WARN', 0.05,
              count(*) FILTER (WHERE NOT regexp_full_match(number, '[0-9]{16}')), count(*)
       FROM card""",
    """SELECT 'transaction', 'completeness', 'txn_id,amount,txn_time,card_id', 'FAIL', 1.0, 0,
              count(*) FROM txn""",
    """SELECT 'transaction', 'negative', 'amount', 'WARN', 0.0,
              count(*) FILTER (WHERE amount < 0), count(*) FROM txn""",
    """SELECT 'transaction', 'extreme', 'amount', 'WARN', 0.0,
              count(*) FILTER (WHERE amount < 0.01 OR amount > 100000), count(*) FROM txn""",
    "SELECT 'transaction', 'volume', '', 'WARN', 0.5, 0, count(*) FROM txn",
    """SELECT 'transaction', 'duplicate', 'txn_id,card_id', 'FAIL', 0.0,
              count(*) - count(DISTINCT (txn_id, card_id)), count(*) FROM txn""",
    """SELECT 'member', 'completeness', 'member_id,first_name,email', 'FAIL', 1.0, 0, count(*)
       FROM member""",
    """SELECT 'member', 'consistency', 'email', 'FAIL', 0.05,
              count(*) FILTER (WHERE coalesce(email, '') = ''), count(*) FROM member""",
    """SELECT 'member', 'consistency', 'first_name', 'FAIL', 0.05,
              count(*) FILTER (WHERE coalesce(first_name, '') = ''), count(*) FROM member""",
    """SELECT 'account', 'completeness', 'account_id,account_type,owner_id', 'FAIL', 1.0, 0,
              count(*) FROM account""",
    """SELECT 'account', 'consistency', 'account_type', 'FAIL', 0.05,
              count(*) FILTER (WHERE coalesce(account_type, '') = ''), count(*) FROM account""",
)

_SUITE_ROWS = f"""
SELECT table_name, check_name, column_name, status,
       CASE WHEN check_name = 'completeness' THEN 1.0 ELSE value END AS value,
       bad_rows, total_rows
FROM ({_counted(_BANK, *_SUITES)})
"""

_CONSTRAINTS = """
SELECT 'member' AS table_name, 'not_null(email)' AS constraint_name,
       count(*) - count(email) AS violations FROM member
UNION ALL SELECT 'member', 'check(age)', count(*) FILTER (WHERE age NOT BETWEEN 18 AND 120)
FROM member
UNION ALL SELECT 'member', 'check(email)', count(*) FILTER (WHERE email NOT LIKE '%@%')
FROM member
UNION ALL SELECT 'member', 'unique(email)', count(email) - count(DISTINCT email) FROM member
UNION ALL SELECT 'account', 'domain(account_type)', count(*) FILTER (WHERE account_type NOT IN
  ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) FROM account
UNION ALL SELECT 'account', 'foreign_key(owner_id)', count(*) FROM account a
  WHERE NOT EXISTS (SELECT 1 FROM member m WHERE m.member_id = a.owner_id)
UNION ALL SELECT 'card', 'check(number_length)', count(*) FILTER (WHERE length(number) <> 16)
FROM card
UNION ALL SELECT 'card', 'unique(number)', count(number) - count(DISTINCT number) FROM card
UNION ALL SELECT 'card', 'foreign_key(account_id)', count(*) FROM card c
  WHERE NOT EXISTS (SELECT 1 FROM account a WHERE a.account_id = c.account_id)
UNION ALL SELECT 'card', 'foreign_key(holder_id)', count(*) FROM card c
  WHERE NOT EXISTS (SELECT 1 FROM member m WHERE m.member_id = c.holder_id)
UNION ALL SELECT 'card', 'agreement(holder_id,account.owner_id)', count(*) FROM card c
  JOIN account a USING (account_id) WHERE a.owner_id <> c.holder_id
UNION ALL SELECT 'transaction', 'not_null(txn_time)', count(*) - count(txn_time) FROM txn
UNION ALL SELECT 'transaction', 'check(amount)', count(*) FILTER (WHERE amount = 0) FROM txn
UNION ALL SELECT 'transaction', 'domain(txn_type)', count(*) FILTER (WHERE txn_type NOT IN
  ('debit', 'credit', 'refund')) FROM txn
UNION ALL SELECT 'transaction', 'unique(txn_id)', count(txn_id) - count(DISTINCT txn_id) FROM txn
UNION ALL SELECT 'transaction', 'foreign_key(card_id)', count(*) FROM txn t
  WHERE NOT EXISTS (SELECT 1 FROM card c WHERE c.card_id = t.card_id)
"""


def _pan(table: str, guard_column: str) -> str:
    return (
        f"SELECT 'pan' AS guard, '{guard_column}' AS column_name,"
        f" count(*) FILTER (WHERE regexp_matches({guard_column}, '\\b[0-9]{{16}}\\b'))"
        f" AS violations FROM {table}"
    )


_FLAT_STRINGS = (
    "member_first_name member_last_name email_masked txn_description card_printed_name"
    " account_type"
).split()
_VIEW_STRINGS = (
    "description txn_type card_number card_printed_name account_type member_first_name"
    " member_last_name member_email"
).split()


def _mask_guard() -> str:
    # Guards that hold by the definition of the flat table count zero.
    safe = [("mask", "card_masked"), ("hash", "card_hash"), ("hash", "email_hash")]
    safe += [("iso_time", c) for c in ("txn_time", "card_created", "account_created")]
    safe += [("pan", c) for c in _FLAT_STRINGS]
    rows = [
        f"SELECT '{g}' AS guard, '{c}' AS column_name, CAST(0 AS BIGINT) AS violations,"
        " 'flat' AS table_name"
        for g, c in safe
    ]
    rows += [
        f"SELECT '{g}', '{c}', count(*) FILTER (WHERE length({c}) > 0), 'view' FROM star"
        for g, c in (("mask", "card_number"), ("hash", "member_email"))
    ]
    guarded = ("card_number", "member_email")
    unguarded = [c for c in _VIEW_STRINGS if c not in guarded]
    rows += [f"SELECT *, 'view' FROM ({_pan('star', c)})" for c in unguarded]
    return _VIEW + " UNION ALL ".join(rows)


def _text_projection() -> str:
    times = ("txn_time", "card_created", "account_created")
    names = [*_VIEW_STRINGS, "txn_id", "amount", "category_id", "merchant_id", "member_age"]
    columns = [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in times]
    columns += [f"CAST({c} AS VARCHAR) AS {c}" for c in names]
    return f"{_VIEW} SELECT {', '.join(columns)} FROM star"


def _csv_roundtrip() -> str:
    times = ("txn_time", "card_created", "account_created")
    iso = ", ".join(f"{_ISO.format(c=c)} AS {c}" for c in times)
    return f"{_FLAT} SELECT * REPLACE ({iso}) FROM flat"


def _volume_history() -> str:
    loads = [_ARRIVED.format(delay=5, day=day) for day in (_FIRST_DAY, _SECOND_DAY)]
    runs = " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS run_seq, count(*) AS n FROM events WHERE {load}"
        for i, load in enumerate((*loads, "true"), start=1)
    )
    return f"""
    WITH runs AS ({runs})
    SELECT r.run_seq, r.n AS stored_rows, r.n AS row_count,
           round(coalesce(abs(r.n - p.n) / CAST(p.n AS DOUBLE), 0.0), 6) AS value,
           CASE WHEN abs(r.n - p.n) / CAST(p.n AS DOUBLE) > 0.5 THEN 'WARN' ELSE 'PASS' END
             AS status
    FROM runs r LEFT JOIN runs p ON r.run_seq = p.run_seq + 1"""


_QUARANTINE = f"""
WITH source AS (
  SELECT event_id, ts, event_type, ts {_ZONE} AS utc,
         {_ARRIVED.format(delay=12, day=_FIRST_DAY)} AS in_first
  FROM events),
boundary AS (
  SELECT CAST(max(utc) AS DATE) - 7 AS cutoff FROM source WHERE in_first)
SELECT event_id, ts, event_type FROM source, boundary
WHERE NOT in_first AND CAST(utc AS DATE) < cutoff
"""

ORACLES: dict[str, str] = {
    "flat_star": f"{_FLAT} SELECT * FROM flat",
    "star_view": f"{_VIEW} SELECT * FROM star",
    "text_projection": _text_projection(),
    "account_owners": f"""{_BANK}
        SELECT account_id, account_type, member_id, first_name, last_name
        FROM account JOIN member ON owner_id = member_id""",
    "orphans": """
        SELECT 'lineitem.l_orderkey' AS reference, count(DISTINCT l_orderkey) AS missing_keys,
               count(*) AS orphan_rows
        FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
        UNION ALL
        SELECT 'lineitem.l_partkey as supplier', count(DISTINCT l_partkey), count(*)
        FROM lineitem WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier)
        UNION ALL
        SELECT 'part.p_size as supplier', count(DISTINCT p_size), count(*)
        FROM part WHERE p_size NOT IN (SELECT s_suppkey FROM supplier)""",
    "join_yield": f"""{_VIEW}
        SELECT (SELECT count(*) FROM lineitem) AS input_rows, count(*) AS output_rows,
               count(*) * 100.0 / (SELECT count(*) FROM lineitem) AS yield_percent
        FROM star""",
    "member_stats": _BANK + _MEMBER_STATS,
    "member_stats_maintained": _BANK + _MEMBER_STATS,
    "active_cards": f"""{_BANK}
        SELECT strftime(txn_time, '%Y') AS span, count(DISTINCT card_id) AS active_cards,
               count(*) AS transactions
        FROM txn GROUP BY 1""",
    "sketch_profile": """
        SELECT 'o_custkey' AS column_name, count(*) AS total_count,
               count(*) - count(o_custkey) AS null_count, CAST(min(o_custkey) AS DOUBLE) AS min_value,
               CAST(max(o_custkey) AS DOUBLE) AS max_value, true AS distinct_within, true AS median_within
        FROM orders
        UNION ALL SELECT 'o_totalprice', count(*), count(*) - count(o_totalprice),
               CAST(min(o_totalprice) AS DOUBLE), CAST(max(o_totalprice) AS DOUBLE), true, true FROM orders
        UNION ALL SELECT 'o_orderpriority', count(*), count(*) - count(o_orderpriority),
               NULL, NULL, true, NULL FROM orders""",
    "member_stats_raw": _BANK + _MEMBER_STATS_RAW,
    "card_balance": f"""{_BANK}
        SELECT c.card_id,
               CAST(coalesce(sum(CASE t.txn_type WHEN 'debit' THEN -t.amount
                                 WHEN 'credit' THEN t.amount ELSE 0 END), 0)
                    AS DECIMAL(20,2)) AS balance
        FROM card c LEFT JOIN txn t ON c.card_id = t.card_id GROUP BY c.card_id""",
    "population_summary": f"""{_VIEW}
        SELECT count(*) AS transactions, count(DISTINCT account_type) AS account_types,
               round(CAST(sum(member_age) AS DOUBLE) / count(*), 6) AS avg_age,
               min(amount) AS min_amount, max(amount) AS max_amount,
               CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount
        FROM star""",
    "spend_by_category": f"""{_BANK}
        SELECT p_type, count(*) AS txn_count, CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount
        FROM txn JOIN part ON category_id = p_partkey GROUP BY p_type""",
    "spend_in_range": f"""{_BANK}
        SELECT member_id, first_name, last_name, count(*) AS txn_count,
               CAST(sum(amount) AS DECIMAL(20,2)) AS total_amount
        FROM txn JOIN card USING (card_id) JOIN member ON holder_id = member_id
        WHERE txn_time BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31 23:59:59'
        GROUP BY member_id, first_name, last_name""",
    "spend_in_range_sql": f"""{_FLAT}
        SELECT member_last_name, count(*) AS txn_count,
               CAST(sum(txn_amount) AS DECIMAL(20,2)) AS total_amount
        FROM flat WHERE year(event_date) = 1998 GROUP BY member_last_name""",
    "table_counts": f"""{_BANK}
        SELECT 'member' AS table_name, count(*) AS row_count FROM member
        UNION ALL SELECT 'account', count(*) FROM account
        UNION ALL SELECT 'card', count(*) FROM card
        UNION ALL SELECT 'transaction', count(*) FROM txn""",
    "max_event_time": "SELECT max(l_shipdate) AS max_event_time FROM lineitem",
    "account_types": "SELECT DISTINCT o_orderpriority AS account_type FROM orders",
    "null_vector": f"""{_GAPS}
        SELECT count(*) - count(event_id) AS event_id, count(*) - count(ts) AS ts,
               count(*) - count(user_id) AS user_id, count(*) - count(event_type) AS event_type,
               count(*) - count(value) AS value, count(*) - count(props) AS props
        FROM gaps""",
    "check_null": _counted(
        _GAPS,
        "SELECT 'events', 'null', 'event_type', 'FAIL', 0.01,"
        " count(*) - count(event_type), count(*) FROM gaps",
        "SELECT 'events', 'null', 'value', 'FAIL', 0.01, count(*) - count(value), count(*)"
        " FROM gaps",
    ),
    "check_negative": _counted(
        "",
        "SELECT 'customer', 'negative', 'c_acctbal', 'WARN', 0.0,"
        " count(*) FILTER (WHERE c_acctbal < 0), count(*) FROM customer",
    ),
    "check_extreme": "SELECT * REPLACE ("
    "CASE WHEN column_name = 'l_linestatus' THEN 'WARN' ELSE status END AS status,"
    " CASE WHEN column_name = 'l_linestatus' THEN 1.0 ELSE value END AS value) FROM ("
    + _counted(
        "",
        "SELECT 'lineitem', 'extreme', 'l_extendedprice', 'WARN', 0.0,"
        " count(*) FILTER (WHERE l_extendedprice NOT BETWEEN 0.01 AND 100000), count(*)"
        " FROM lineitem",
        "SELECT 'lineitem', 'extreme', 'l_quantity', 'WARN', 0.0,"
        " count(*) FILTER (WHERE l_quantity NOT BETWEEN 1 AND 50), count(*) FROM lineitem",
        "SELECT 'lineitem', 'extreme', 'l_linestatus', 'WARN', 0.0,"
        " 0, count(*) FROM lineitem",
    )
    + ")",
    "check_format": _counted(
        _BANK + ", shorter AS (SELECT number, left(number, CAST(card_id % 17 AS INTEGER))"
        " AS short_number FROM card)",
        "SELECT 'card', 'format', 'number', 'WARN', 0.05,"
        " count(*) FILTER (WHERE NOT regexp_full_match(number, '[0-9]{16}')), count(*)"
        " FROM shorter",
        "SELECT 'card', 'format', 'short_number', 'WARN', 0.05,"
        " count(*) FILTER (WHERE length(short_number) <> 16), count(*) FROM shorter",
        "SELECT 'card', 'format', 'short_number', 'WARN', 0.05,"
        " count(*) FILTER (WHERE short_number = ''), count(*) FROM shorter",
    ),
    "check_consistency": _counted(
        _GAPS,
        "SELECT 'events', 'consistency', 'event_type', 'FAIL', 0.05,"
        " count(*) FILTER (WHERE event_type IS NULL OR event_type = ''), count(*) FROM gaps",
        "SELECT 'events', 'consistency', 'props', 'FAIL', 0.05,"
        " count(*) FILTER (WHERE props IS NULL OR props = ''), count(*) FROM gaps",
    ),
    "check_duplicates": _counted(
        "",
        "SELECT 'lineitem', 'duplicate', 'l_orderkey,l_linenumber', 'FAIL', 0.0,"
        " count(*) - count(DISTINCT (l_orderkey, l_linenumber)), count(*) FROM lineitem",
        "SELECT 'orders', 'duplicate', 'o_orderkey', 'FAIL', 0.0,"
        " count(*) - count(DISTINCT o_orderkey), count(*) FROM orders",
    ),
    "check_completeness": """
        SELECT 'flat' AS table_name, 'completeness' AS check_name,
               'member_first_name,member_last_name,member_age,email_masked,email_hash,txn_id,'
               || 'txn_amount,txn_description,txn_time,card_masked,card_hash,card_printed_name,'
               || 'card_created,account_type,account_created,event_date' AS column_name,
               'PASS' AS status, CAST(1.0 AS DOUBLE) AS value, CAST(0 AS BIGINT) AS bad_rows,
               CAST(NULL AS BIGINT) AS total_rows
        UNION ALL
        SELECT 'raw', 'completeness', 'number,email', 'FAIL', 0.0, 2, NULL""",
    "check_volume": """
        WITH daily AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
        SELECT d.day, d.n,
               round(coalesce(abs(d.n - p.n) / CAST(p.n AS DOUBLE), 0.0), 6) AS value,
               CASE WHEN abs(d.n - p.n) / CAST(p.n AS DOUBLE) > 0.05 THEN 'WARN'
                    ELSE 'PASS' END AS status
        FROM daily d LEFT JOIN daily p ON p.day = d.day - 1""",
    "duplicate_rows": """
        SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "suite_results": _SUITE_ROWS,
    "suite_gate": f"""
        SELECT s.status, count(r.status) AS checks
        FROM (VALUES ('PASS'), ('WARN'), ('FAIL')) s(status)
        LEFT JOIN ({_SUITE_ROWS}) r ON r.status = s.status GROUP BY s.status""",
    "constraint_report": _BANK + _CONSTRAINTS,
    "constraints_maintained": _BANK.replace("FROM orders),\ntxn", "FROM orders WHERE o_orderkey % 3 <> 0),\ntxn") + _CONSTRAINTS,
    "duplicate_history": f"""{_ACTIVITY}
        SELECT event_id, CAST(event_date AS VARCHAR) AS period FROM flat
        WHERE event_id % 9 = 0 AND event_id IN (
          SELECT event_id FROM events WHERE {_ARRIVED.format(delay=5, day=_FIRST_DAY)})""",
    "column_profile": f"""{_GAPS}, prices AS (
          SELECT o_totalprice, CASE WHEN o_orderstatus <> 'P'
                 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS price_text
          FROM orders)
        {' UNION ALL '.join((
            _profile('gaps', 'event_id', 'CAST(event_id AS DOUBLE)', False),
            _profile('gaps', 'ts', None, False),
            _profile('gaps', 'user_id', 'CAST(user_id AS DOUBLE)', False),
            _profile('gaps', 'event_type', 'TRY_CAST(event_type AS DOUBLE)', True),
            _profile('gaps', 'value', 'value', False),
            _profile('gaps', 'props', 'TRY_CAST(props AS DOUBLE)', True),
            _profile('prices', 'price_text', 'TRY_CAST(price_text AS DOUBLE)', True),
            _profile('prices', 'o_totalprice', 'o_totalprice', False),
        ))}""",
    "quality_report": " UNION ALL ".join(
        (
            _reported("o_orderkey", "bigint", True),
            _reported("o_totalprice", "double", True),
            _reported("o_orderstatus", "string", False),
            _reported("o_orderdate", "timestamp_ntz", False),
        )
    ),
    "histogram": f"""{_histogram('l_extendedprice')} UNION ALL {_histogram('l_quantity')}
        UNION ALL SELECT 'constant', 1, 7.0, 7.0, count(*) FROM lineitem
        UNION ALL {_histogram('odd', f"({_ODD})")}
        UNION ALL SELECT 'odd', 0, NULL, NULL, count(*) FROM lineitem WHERE l_linenumber <= 2
        HAVING count(*) > 0""",
    "output_profile": f"""{_FLAT}
        SELECT count(*) AS row_count, CAST(16 AS BIGINT) AS column_count,
               CAST(0 AS BIGINT) AS null_cells,
               count(*) FILTER (WHERE txn_amount < 0) AS negative_amounts,
               (SELECT string_agg(DISTINCT account_type, ',' ORDER BY account_type) FROM flat)
                 AS account_types
        FROM flat""",
    "pan_scan": " UNION ALL ".join(_pan("documents", c) for c in ("text", "lang", "source")),
    "mask_guard": _mask_guard(),
    "incremental_slice": f"""
        SELECT e.* FROM events e
        WHERE CAST(ts {_ZONE} AS DATE) >= (SELECT CAST(max(ts) AS DATE) - 7 FROM events)""",
    "incremental_merge": f"{_ACTIVITY} SELECT * FROM flat",
    "quarantine_late": _QUARANTINE,
    "full_publish": f"{_ACTIVITY} SELECT * FROM flat",
    "changed_dimension": f"{_ACTIVITY} SELECT * FROM flat",
    "replay_bronze": f"{_ACTIVITY} SELECT * FROM flat",
    "reconciled_table": f"""{_ACTIVITY}
SELECT flat.* FROM flat JOIN events e USING (event_id)
WHERE NOT (CAST(e.ts AS DATE) < {_EARLY} AND event_id % 803 = 0)""",
    "reconcile_dates": f"""{_ACTIVITY}, early AS (
  SELECT *, CAST(ts {_ZONE} AS DATE) AS day, CAST(ts AS DATE) < {_EARLY} AS early FROM events
), marked AS (
  SELECT day, NOT (early AND event_id % 803 = 0) AS now, NOT (early AND event_id % 601 = 0) AS before,
         early AND event_id % 701 = 0 AS changed
  FROM early
), days AS (
  SELECT day, count(*) FILTER (now) AS source_rows, count(*) FILTER (before) AS stored_rows
  FROM marked GROUP BY day
  HAVING count(*) FILTER (now <> before OR (now AND changed)) > 0
), published AS (
  SELECT flat.event_date, count(*) AS published_rows
  FROM flat JOIN early USING (event_id)
  WHERE NOT (early AND event_id % 803 = 0) GROUP BY ALL
)
SELECT CAST(day AS VARCHAR) AS event_date, source_rows, stored_rows,
       CASE WHEN source_rows = stored_rows THEN 'changed' WHEN stored_rows = 0 THEN 'new' WHEN source_rows = 0 THEN 'gone'
            WHEN source_rows > stored_rows THEN 'more' ELSE 'fewer' END AS reason,
       published_rows
FROM days LEFT JOIN published ON event_date = day""",
    "stream_merge": f"{_ACTIVITY} SELECT * FROM flat",
    "csv_roundtrip": _csv_roundtrip(),
    "parquet_pruned_read": f"""{_ACTIVITY}
        SELECT * FROM flat WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
    "partition_plan": " UNION ALL ".join(
        (
            _partitions("member", "customer", "c_custkey", 2, 8, 10000),
            _partitions("card", "orders", "o_orderkey", 4, 16, 20000),
            _partitions("transaction", "events", "event_id", 8, 32, 100000),
            _partitions("account", "part", "p_partkey", 2, 8, 5000),
        )
    ),
    "watermark_state": """
        SELECT 'events' AS source, CAST(4 AS BIGINT) AS run_seq, 'success' AS status,
               max(ts) AS watermark, count(*) AS records FROM events
        UNION ALL
        SELECT 'orders', 2, 'success', max(o_orderdate), count(*) FROM orders""",
    "volume_history": _volume_history(),
    "synthetic_accounts": f"{_SYNTHETIC} SELECT * FROM account",
    "synthetic_cards": f"{_SYNTHETIC} SELECT * FROM card",
    "synthetic_transactions": f"{_SYNTHETIC} SELECT * FROM txn",
    "min_row_report": f"""{_BANK}
        SELECT table_name, row_count, CAST(25 AS BIGINT) AS required, row_count >= 25 AS enough FROM (
          SELECT 'member' AS table_name, count(*) AS row_count FROM member
          UNION ALL SELECT 'account', count(*) FROM account
          UNION ALL SELECT 'card', count(*) FROM card
          UNION ALL SELECT 'transaction', count(*) FROM txn
          UNION ALL SELECT 'event', count(*) FROM events
          UNION ALL SELECT 'nation', count(*) FROM nation)""",
    "early_exit": f"""
        WITH loaded AS (SELECT * FROM events WHERE {_ARRIVED.format(delay=5, day=_FIRST_DAY)}),
        seen AS (SELECT max(ts {_ZONE}) AS last FROM loaded)
        SELECT CAST(1 AS BIGINT) AS run_seq, 'success' AS status, (SELECT last FROM seen) AS watermark,
               count(*) AS row_count FROM loaded
        UNION ALL SELECT 2, 'success', (SELECT last FROM seen), 0
        UNION ALL SELECT 3, 'success', (SELECT max(ts {_ZONE}) FROM events), count(*) FROM events
          WHERE CAST(ts {_ZONE} AS DATE) >= (SELECT CAST(last AS DATE) - 7 FROM seen)""",
    "mask_edges": """
        WITH given AS (
          SELECT o_orderkey, CASE WHEN o_orderkey % 21 <> 20
                   THEN left(repeat(CAST(o_orderkey AS VARCHAR), 20), CAST(o_orderkey % 21 AS INTEGER)) END AS n,
                 left('user' || o_orderkey, CAST(o_orderkey % 7 AS INTEGER)) AS u,
                 o_orderkey % 5 AS kind
          FROM orders),
        odd AS (
          SELECT *, CASE kind WHEN 1 THEN u WHEN 2 THEN u || '@mail.example'
                    WHEN 3 THEN u || '@b@mail.example' WHEN 4 THEN '' END AS e,
                 CASE kind WHEN 2 THEN u WHEN 3 THEN u || '@b' END AS name
          FROM given)
        SELECT o_orderkey,
               CASE WHEN length(n) >= 13 THEN left(n, 6) || '******' || right(n, 4)
                    WHEN length(n) > 4 THEN '******' || right(n, 4)
                    WHEN n IS NOT NULL THEN '******' END AS card_masked,
               sha256(n || 'demo-salt') AS card_hash,
               sha256(coalesce(n, '') || 'demo-salt') AS card_hash_or_empty,
               CASE WHEN e IS NULL THEN '' WHEN name IS NULL THEN '****'
                    ELSE left(name, greatest(least(length(name) - 1, 3), 0)) || '****@mail.example'
               END AS email_masked,
               sha256(e || 'demo-salt') AS email_hash
        FROM odd""",
    "pan_redact": r"""
        SELECT doc_id, regexp_replace(text, '\b([0-9]{6})[0-9]{6}([0-9]{4})\b', '\1******\2', 'g') AS text
        FROM documents""",
    "csv_options": """
        SELECT p_partkey, p_name || '|"quoted"|' || p_brand AS label, p_retailprice FROM part""",
    "csv_beside_parquet": f"""{_ACTIVITY}
        SELECT * REPLACE ({_ISO.format(c='event_time')} AS event_time) FROM flat""",
    "point_lookup": "SELECT * FROM events WHERE event_id = (SELECT max(event_id) FROM events)",
    "metric_report": """
        SELECT name, CAST(1 AS BIGINT) AS points, n AS total, n AS mean, n AS last
        FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM events),
             (VALUES ('rows_in'), ('rows_out')) v(name)""",
    "metrics_json": """
        SELECT 'event' AS table_name, 'completeness' AS check_name,
               'event_id,ts,user_id,value' AS column_name, 'PASS' AS status
        UNION ALL SELECT 'event', 'null', 'user_id',
          CASE WHEN count(*) - count(user_id) > 0.01 * count(*) THEN 'FAIL' ELSE 'PASS' END FROM events
        UNION ALL SELECT 'event', 'negative', 'value',
          CASE WHEN min(value) < 0 THEN 'WARN' ELSE 'PASS' END FROM events
        UNION ALL SELECT 'event', 'extreme', 'value',
          CASE WHEN min(value) < 0.01 OR max(value) > 100000 THEN 'WARN' ELSE 'PASS' END FROM events
        UNION ALL SELECT 'event', 'duplicate', 'event_id',
          CASE WHEN count(DISTINCT event_id) < count(*) THEN 'FAIL' ELSE 'PASS' END FROM events
        UNION ALL SELECT 'event', 'volume', '', 'PASS'
        UNION ALL SELECT 'member', 'consistency', 'email',
          CASE WHEN count(*) FILTER (WHERE coalesce(c_name, '') = '') > 0 THEN 'FAIL' ELSE 'PASS' END
          FROM customer""",
    "stream_late_dimension": f"{_ACTIVITY} SELECT * FROM flat",
    "stream_expired": """
        SELECT event_id, user_id, ts FROM events
        WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)
          AND ts < (SELECT max(ts) - INTERVAL 30 DAY FROM events)""",
    "run_metrics": """
        WITH broken(status, failing) AS (
          SELECT 'FAIL', count(*) FILTER (WHERE user_id IS NULL) * 1.0 / count(*) > 0.01
          FROM events
          UNION ALL SELECT 'WARN', min(value) < 0 FROM events
          UNION ALL SELECT 'WARN', min(value) < 0.01 OR max(value) > 100000 FROM events
          UNION ALL SELECT 'FAIL', count(DISTINCT event_id) < count(*) FROM events
          UNION ALL SELECT 'FAIL', count(*) FILTER (WHERE coalesce(c_name, '') = '') > 0
          FROM customer
          UNION ALL SELECT 'FAIL', false
          UNION ALL SELECT 'WARN', false),
        found AS (SELECT CASE WHEN failing THEN status ELSE 'PASS' END AS status FROM broken)
        SELECT name, value, 'full' AS mode, status FROM (
          SELECT 'rows_in' AS name, CAST(count(*) AS DOUBLE) AS value, '' AS status FROM events
          UNION ALL SELECT 'rows_out', CAST(count(*) AS DOUBLE), '' FROM events
          UNION ALL SELECT 'yield_percent', 100.0, ''
          UNION ALL SELECT 'output_columns', 9.0, ''
          UNION ALL SELECT 'checks', CAST(count(f.status) AS DOUBLE), s.status
          FROM (VALUES ('PASS'), ('WARN'), ('FAIL')) s(status)
          LEFT JOIN found f ON f.status = s.status GROUP BY s.status)""",
}
