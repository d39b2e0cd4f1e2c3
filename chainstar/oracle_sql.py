"""DuckDB formulations of the registered queries (the correctness oracle).

Written independently of the Spark code paths, in plain SQL over the
driver's views (``events``, ``supplier``, ``nation``, ``region``,
``lineitem`` ...):

* decimal divisions are exact integer arithmetic on HUGEINT with rounding
  half away from zero (DuckDB's own ``decimal / decimal`` is a DOUBLE);
* the time-weighted difficulty uses a ``lead()`` window over each day's
  adjustment blocks;
* the canonical chain walks every branch by recursion (Spark doubles pointers
  over the contested heights only);
* first / last values use ``arg_min_null`` / ``arg_max_null``.
"""

from __future__ import annotations

from decimal import Decimal

# -- exact arithmetic helpers -----------------------------------------------------


def rdiv(n: str, d: str) -> str:
    """round(n / d) half away from zero; n, d integral (HUGEINT)."""
    n, d = f"CAST(({n}) AS HUGEINT)", f"CAST(({d}) AS HUGEINT)"
    return (f"((CASE WHEN ({n} < 0) = ({d} < 0) THEN 1 ELSE -1 END) * "
            f"((2 * abs({n}) + abs({d})) // (2 * abs({d}))))")


def units(x: str, k: int) -> str:
    """x * 10^k as HUGEINT (x has at most k decimals)."""
    if k == 0:
        return f"CAST(({x}) AS HUGEINT)"
    return f"CAST(CAST(({x}) AS DECIMAL(38,{k})) * {10 ** k} AS HUGEINT)"


def dec(u: str, p: int, s: int) -> str:
    """Integral u * 10^-s as DECIMAL(p,s), exactly."""
    if s == 0:
        return f"CAST(({u}) AS DECIMAL({p},0))"
    lit = format(Decimal(1).scaleb(-s), "f")
    return f"CAST(CAST(({u}) AS DECIMAL(38,0)) * CAST('{lit}' AS DECIMAL({s + 1},{s})) AS DECIMAL({p},{s}))"


def xratio(nu: str, du: str, p: int, s: int, ns: int = 0, ds: int = 0) -> str:
    """(nu / 10^ns) / (du / 10^ds) rounded once at scale s, as DECIMAL(p,s)."""
    shift = s - ns + ds
    if shift >= 0:
        q = rdiv(f"CAST(({nu}) AS HUGEINT) * {10 ** shift}", du)
    else:
        q = rdiv(nu, f"CAST(({du}) AS HUGEINT) * {10 ** (-shift)}")
    return dec(q, p, s)


def safe_xratio(nu: str, du: str, p: int, s: int, ns: int = 0, ds: int = 0) -> str:
    return f"(CASE WHEN ({du}) = 0 THEN NULL ELSE {xratio(nu, du, p, s, ns, ds)} END)"


def btc(x: str) -> str:
    return dec(x, 16, 8)


def dedupe(table: str, keys: list[str], order: list[str]) -> str:
    o = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return (f"SELECT * EXCLUDE (__rn) FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"{', '.join(keys)} ORDER BY {o}) AS __rn FROM {table}) WHERE __rn = 1")


# -- calendar ----------------------------------------------------------------------

def calendar_select(d: str) -> str:
    return f"""
      strftime({d}, '%Y%m%d') AS date_id,
      {d} AS date,
      CAST(({d} - DATE '1970-01-01') AS BIGINT) * 86400 AS epoch_timestamp,
      CAST(isodow({d}) AS INTEGER) AS day_of_week,
      rpad(strftime({d}, '%A'), 9, ' ') AS day_of_week_name,
      strftime({d}, '%a') AS day_of_week_name_abbr,
      CAST(day({d}) AS INTEGER) AS day_of_month,
      CAST(day({d}) AS VARCHAR) || CASE WHEN day({d}) BETWEEN 11 AND 13 THEN 'th'
           WHEN day({d}) % 10 = 1 THEN 'st' WHEN day({d}) % 10 = 2 THEN 'nd'
           WHEN day({d}) % 10 = 3 THEN 'rd' ELSE 'th' END AS day_of_month_suffix,
      CAST({d} - CAST(date_trunc('quarter', {d}) AS DATE) + 1 AS INTEGER) AS day_of_quarter,
      CAST(dayofyear({d}) AS INTEGER) AS day_of_year,
      CAST((day({d}) - 1) // 7 + 1 AS INTEGER) AS week_of_month,
      CAST(week({d}) AS INTEGER) AS week_of_year,
      CAST(isoyear({d}) AS VARCHAR) || '-w' || lpad(CAST(week({d}) AS VARCHAR), 2, '0') || '-'
           || CAST(isodow({d}) AS VARCHAR) AS week_of_year_iso,
      CAST(month({d}) AS INTEGER) AS month,
      rpad(strftime({d}, '%B'), 9, ' ') AS month_name,
      strftime({d}, '%b') AS month_name_abbr,
      CAST(quarter({d}) AS INTEGER) AS quarter,
      'Q' || CAST(quarter({d}) AS VARCHAR) AS quarter_name,
      CAST(isoyear({d}) AS INTEGER) AS year,
      CAST({d} - CAST(isodow({d}) - 1 AS INTEGER) AS DATE) AS first_day_of_week,
      CAST({d} + CAST(7 - isodow({d}) AS INTEGER) AS DATE) AS last_day_of_week,
      CAST(date_trunc('month', {d}) AS DATE) AS first_day_of_month,
      last_day({d}) AS last_day_of_month,
      CAST(date_trunc('quarter', {d}) AS DATE) AS first_day_of_quarter,
      CAST(date_trunc('quarter', {d}) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS last_day_of_quarter,
      CAST(date_trunc('year', {d}) AS DATE) AS first_day_of_year,
      make_date(CAST(year({d}) AS INTEGER), 12, 31) AS last_day_of_year,
      isodow({d}) IN (6, 7) AS is_weekend"""


CALENDAR = f"""calendar AS (
  SELECT {calendar_select('d')}
  FROM (SELECT CAST(DATE '1970-01-01' + CAST(i AS INTEGER) AS DATE) AS d
        FROM range(0, 29220) t(i)))"""

# -- stand-in sources ------------------------------------------------------------------

SRC_BLOCK = """src_block_base AS (
  SELECT CAST(event_id % 2147483647 AS INTEGER) AS blockheight,
         'blk' || CAST(event_id AS VARCHAR) AS block_hash,
         'blk' || CAST(event_id - 1 AS VARCHAR) AS prev_block_hash,
         ts AS "timestamp",
         'pool-' || CAST(user_id AS VARCHAR) AS pool_key,
         CAST(CAST(1000 + 37 * (event_id // 2016) AS DECIMAL(20,0)) * 1000000000 AS DECIMAL(30,7)) AS difficulty,
         CASE WHEN event_id // 4000 >= 64 THEN CAST(0 AS BIGINT)
              ELSE CAST(5000000000 AS BIGINT) >> CAST(event_id // 4000 AS INTEGER) END AS reward_subsidy,
         CAST(round(value * 100) AS BIGINT) AS reward_tx_fee_sum,
         CAST(((user_id % 7) + 7) % 7 + 1 AS INTEGER) AS tx_count,
         ts AS loaded_at,
         event_type
  FROM events),
src_block AS (
  SELECT * EXCLUDE (event_type) FROM src_block_base
  UNION ALL BY NAME
  SELECT * EXCLUDE (event_type, tx_count, loaded_at), CAST(tx_count + 1 AS INTEGER) AS tx_count,
         loaded_at + INTERVAL 1 HOUR AS loaded_at
  FROM src_block_base WHERE event_type = 'error'
  UNION ALL BY NAME
  SELECT * EXCLUDE (event_type) FROM src_block_base WHERE event_type = 'signup')"""

_BLOCK_OF = """CAST(event_id % 2147483647 AS INTEGER) AS blockheight, ts AS "timestamp",
         'pool-' || CAST(user_id AS VARCHAR) AS pool_key,
         CAST(CAST(1000 + 37 * (event_id // 2016) AS DECIMAL(20,0)) * 1000000000 AS DECIMAL(30,7)) AS difficulty,
         CASE WHEN event_id // 4000 >= 64 THEN CAST(0 AS BIGINT)
              ELSE CAST(5000000000 AS BIGINT) >> CAST(event_id // 4000 AS INTEGER) END AS reward_subsidy,
         CAST(round(value * 100) AS BIGINT) AS reward_tx_fee_sum,
         CAST(((user_id % 7) + 7) % 7 + 1 AS INTEGER) AS tx_count, ts AS loaded_at, event_type"""

# Competing and missing blocks: the types of the two events before say what an event's blocks are.
SRC_BLOCK_FORKED = f"""typed AS (
  SELECT e.*, coalesce(e.event_type = 'error', false) AS f0, coalesce(a.event_type = 'error', false) AS f1,
         coalesce(b.event_type = 'error', false) AS f2,
         coalesce(e.event_type = 'signup' AND a.event_type = 'signup' AND b.event_type = 'signup', false) AS lost
  FROM events e LEFT JOIN events a ON a.event_id = e.event_id - 1 LEFT JOIN events b ON b.event_id = e.event_id - 2),
src_block_base AS (
  SELECT 'blk' || event_id AS block_hash,
         (CASE WHEN f1 AND f2 AND NOT f0 THEN 'riv' ELSE 'blk' END) || (event_id - 1) AS prev_block_hash, {_BLOCK_OF}
  FROM typed WHERE NOT lost
  UNION ALL BY NAME
  SELECT 'riv' || event_id AS block_hash, (CASE WHEN f1 THEN 'riv' ELSE 'blk' END) || (event_id - 1) AS prev_block_hash,
         {_BLOCK_OF}
  FROM (SELECT * REPLACE (ts + INTERVAL 1 MINUTE AS ts) FROM typed WHERE f0)),
src_block AS (
  SELECT * EXCLUDE (event_type) FROM src_block_base
  UNION ALL BY NAME
  SELECT * EXCLUDE (event_type, tx_count, loaded_at), CAST(tx_count + 1 AS INTEGER) AS tx_count,
         loaded_at + INTERVAL 1 HOUR AS loaded_at
  FROM src_block_base WHERE event_type = 'error'
  UNION ALL BY NAME
  SELECT * EXCLUDE (event_type) FROM src_block_base WHERE event_type = 'signup')"""

SRC_POOL = """src_pool AS (
  SELECT 'pool-' || CAST(s.s_suppkey AS VARCHAR) AS pool_key,
         CASE WHEN s.s_acctbal < 0 THEN ' ' || s.s_name ELSE s.s_name END AS pool_name,
         CASE WHEN g.r_name = 'AFRICA' THEN NULL
              ELSE 'https://' || lower(g.n_name) || '.pool/' || CAST(s.s_suppkey AS VARCHAR) END AS pool_url,
         g.r_name = 'AMERICA' AS is_antpool_friend_custodian,
         CASE WHEN g.r_name = 'MIDDLE EAST' THEN NULL ELSE s.s_acctbal > 5000 END AS is_antpool_friend_template,
         TIMESTAMP '2024-01-01 00:00:00' AS loaded_at
  FROM supplier s
  LEFT JOIN (SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n
             LEFT JOIN region r ON n.n_regionkey = r.r_regionkey) g
    ON s.s_nationkey = g.n_nationkey)"""

SRC_PRICE = """src_price AS (
  SELECT CAST(ts AS DATE) AS date,
         CASE WHEN event_type = 'purchase' THEN 'BTC-USD' ELSE upper(event_type) || '-USD' END AS ticker,
         arg_min(CAST(value AS DECIMAL(21,2)), event_id) AS price_open,
         arg_max(CAST(value AS DECIMAL(21,2)), event_id) AS price_close,
         min(CAST(value AS DECIMAL(21,2))) AS price_low,
         max(CAST(value AS DECIMAL(21,2))) AS price_high,
         max(ts) AS loaded_at
  FROM events GROUP BY 1, 2)"""

SRC_HASHRATE = """src_hashrate AS (
  SELECT CAST(ts AS DATE) AS date, 'pool-' || CAST(user_id AS VARCHAR) AS pool_key,
         CAST(CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DECIMAL(20,0)) * 10000000000000
              AS DECIMAL(30,0)) AS hashrate,
         max(ts) AS loaded_at
  FROM events
  WHERE 'pool-' || CAST(user_id AS VARCHAR) IN (SELECT 'pool-' || CAST(s_suppkey AS VARCHAR) FROM supplier)
  GROUP BY 1, 2)"""

# -- staged and deduped inputs ---------------------------------------------------------

BLOCK_ORDER = ["audit_created_timestamp", "prev_block_hash", "blockheight", "event_date",
               "event_timestamp", "pool_key", "difficulty", "reward_subsidy", "reward_tx_fee_sum",
               "tx_count"]

STAGED_BLOCK = """staged_block AS (
  SELECT trim(block_hash) AS block_key, trim(prev_block_hash) AS prev_block_hash,
         CAST(blockheight AS INTEGER) AS blockheight, CAST("timestamp" AS DATE) AS event_date,
         "timestamp" AS event_timestamp, trim(pool_key) AS pool_key,
         CAST(difficulty AS DECIMAL(30,9)) AS difficulty, reward_subsidy, reward_tx_fee_sum, tx_count,
         loaded_at AS audit_created_timestamp
  FROM src_block WHERE trim(block_hash) IS NOT NULL)"""

BLOCKS = f"""blocks AS ({dedupe('staged_block', ['block_key'], BLOCK_ORDER)})"""

DIM_POOL = f"""pool_staged AS (
  SELECT trim(pool_key) AS pool_key, trim(pool_name) AS pool_name, trim(pool_url) AS pool_url,
         is_antpool_friend_custodian, is_antpool_friend_template, loaded_at AS audit_created_timestamp
  FROM src_pool WHERE trim(pool_key) IS NOT NULL),
pool_latest AS ({dedupe('pool_staged', ['pool_key'], ['audit_created_timestamp', 'pool_name', 'pool_url', 'is_antpool_friend_custodian', 'is_antpool_friend_template'])}),
dim_pool AS (
  SELECT substr(md5('surrogate' || pool_key), 1, 512) AS pool_id,
         substr(pool_key, 1, 256) AS pool_key,
         substr(coalesce(pool_name, '[Unknown]'), 1, 256) AS pool_name,
         substr(coalesce(pool_url, '[Unknown]'), 1, 512) AS pool_url,
         coalesce(is_antpool_friend_custodian = true, false)
           OR coalesce(is_antpool_friend_template = true, false) AS is_antpool_friend,
         is_antpool_friend_custodian, is_antpool_friend_template, audit_created_timestamp
  FROM pool_latest
  UNION ALL
  SELECT '0', '[Unknown]', '[Unknown]', '[Unknown]', NULL, NULL, NULL, NULL),
pool_lookup AS (SELECT pool_key, pool_id FROM dim_pool WHERE pool_id <> '0')"""

DIM_BLOCK = """dim_block AS (
  SELECT substr(md5('surrogate' || block_key), 1, 512) AS block_id,
         substr(block_key, 1, 256) AS block_key, substr(block_key, 1, 256) AS block_hash,
         substr(prev_block_hash, 1, 256) AS prev_block_hash,
         coalesce(blockheight % 210000 = 0, false) AS is_subsidy_halving,
         coalesce(blockheight % 2016 = 0, false) AS is_difficulty_adjustment,
         audit_created_timestamp
  FROM blocks
  UNION ALL
  SELECT '0', '[Unknown]', '[Unknown]', '[Unknown]', NULL, NULL, NULL)"""

FACT_PRICE = f"""price_staged AS (
  SELECT CAST(date AS DATE) AS event_date, trim(ticker) AS ticker, price_open, price_close,
         price_low, price_high, loaded_at AS audit_created_timestamp
  FROM src_price WHERE trim(ticker) = 'BTC-USD'),
price_latest AS ({dedupe('price_staged', ['event_date'], ['audit_created_timestamp', 'ticker', 'price_open', 'price_close', 'price_low', 'price_high'])}),
fact_price AS (
  SELECT substr(dd.date_id, 1, 512) AS date_id, substr(p.ticker, 1, 10) AS ticker,
         p.price_open, p.price_close,
         CAST(p.price_close - p.price_open AS DECIMAL(21,2)) AS price_change,
         {safe_xratio(f"100 * ({units('p.price_close', 2)} - {units('p.price_open', 2)})", units('p.price_open', 2), 18, 9)} AS price_change_pct,
         p.price_low, p.price_high,
         CAST(p.price_high - p.price_low AS DECIMAL(21,2)) AS price_spread
  FROM price_latest p JOIN calendar dd ON dd.date = p.event_date)"""


def _halving_level(epoch_minus_one: str) -> str:
    return (f"(CASE WHEN {epoch_minus_one} >= 64 THEN CAST(0 AS BIGINT) "
            f"ELSE CAST(5000000000 AS BIGINT) >> CAST({epoch_minus_one} AS INTEGER) END)")


def reward_columns(s: str = "reward_subsidy_sum", f: str = "reward_tx_fee_sum",
                   t: str = "tx_count", suffix: str = "_sum") -> str:
    mining = f"CAST({s} + {f} AS BIGINT)"
    return f"""
         {mining} AS reward_mining{suffix},
         CAST({s} AS BIGINT) AS {'reward_subsidy' + suffix},
         CAST({f} AS BIGINT) AS reward_tx_fee_sum,
         CAST({t} AS INTEGER) AS tx_count,
         {safe_xratio(f'100 * {f}', f'{s} + {f}', 12, 9)} AS reward_tx_fee_pct,
         {btc(mining)} AS reward_mining{suffix}_btc,
         {btc(s)} AS {'reward_subsidy' + suffix}_btc,
         {btc(f)} AS reward_tx_fee_sum_btc,
         {safe_xratio(f, t, 16, 3)} AS tx_fee_avg,
         {safe_xratio(f, t, 19, 11, 0, -8)} AS tx_fee_avg_btc"""


FACT_BLOCK = f"""fact_block AS (
  SELECT substr(dd.date_id, 1, 8) AS date_id,
         substr(coalesce(substr(md5('surrogate' || b.block_key), 1, 512), '0'), 1, 512) AS block_id,
         substr(coalesce(pl.pool_id, '0'), 1, 512) AS pool_id,
         b.blockheight, b.event_timestamp,
         CAST(b.blockheight // 210000 + 1 AS INTEGER) AS subsidy_epoch,
         {_halving_level('(b.blockheight // 210000)')} AS subsidy_level,
         {btc(_halving_level('(b.blockheight // 210000)'))} AS subsidy_level_btc,
         CAST(b.blockheight // 2016 + 1 AS INTEGER) AS difficulty_epoch,
         b.difficulty,
         CAST(b.reward_subsidy + b.reward_tx_fee_sum AS BIGINT) AS reward_mining,
         b.reward_subsidy, b.reward_tx_fee_sum,
         {safe_xratio('100 * b.reward_tx_fee_sum', 'b.reward_subsidy + b.reward_tx_fee_sum', 12, 9)} AS reward_tx_fee_pct,
         {btc('b.reward_subsidy + b.reward_tx_fee_sum')} AS reward_mining_btc,
         {btc('b.reward_subsidy')} AS reward_subsidy_btc,
         {btc('b.reward_tx_fee_sum')} AS reward_tx_fee_sum_btc,
         b.tx_count,
         {safe_xratio('b.reward_tx_fee_sum', 'b.tx_count', 16, 3)} AS tx_fee_avg,
         {safe_xratio('b.reward_tx_fee_sum', 'b.tx_count', 19, 11, 0, -8)} AS tx_fee_avg_btc,
         b.audit_created_timestamp
  FROM blocks b
  JOIN calendar dd ON dd.date = b.event_date
  LEFT JOIN pool_lookup pl ON pl.pool_key = b.pool_key)"""

NET_AGG = """net_agg AS (
  SELECT event_date,
         bool_or(coalesce(blockheight % 210000 = 0, false)) AS has_subsidy_halving,
         bool_or(coalesce(blockheight % 2016 = 0, false)) AS has_difficulty_adjustment,
         count(block_key) AS block_count,
         min(blockheight) AS blockheight_first, max(blockheight) AS blockheight_last,
         count(DISTINCT pool_key) AS pool_count,
         sum(reward_subsidy) AS reward_subsidy_sum, sum(reward_tx_fee_sum) AS reward_tx_fee_sum,
         sum(tx_count) AS tx_count, max(audit_created_timestamp) AS audit_created_timestamp,
         arg_min_null(difficulty, blockheight) AS difficulty_first,
         arg_max_null(difficulty, blockheight) AS difficulty_last
  FROM blocks GROUP BY event_date)"""

# The day's adjustment blocks and the time each level holds (window form).
CHANGES = """chg AS (
  SELECT event_date, blockheight, CAST(difficulty * 1000000000 AS HUGEINT) AS lvl,
         epoch_us(event_timestamp) - epoch_us(CAST(event_date AS TIMESTAMP)) AS t
  FROM blocks WHERE blockheight % 2016 = 0
  QUALIFY row_number() OVER (PARTITION BY event_date, blockheight ORDER BY event_timestamp, difficulty) = 1),
chg_day AS (
  SELECT event_date, sum(lvl * (coalesce(t_next, 86400000000) - t)) AS area,
         arg_min(t, blockheight) AS t_first
  FROM (SELECT *, lead(t) OVER (PARTITION BY event_date ORDER BY blockheight) AS t_next FROM chg)
  GROUP BY event_date)"""


def weighted(first: str, area: str, t_first: str) -> str:
    blend = dec(rdiv(f"{units(first, 9)} * {t_first} + {area}", "86400000000"), 30, 9)
    return f"(CASE WHEN {area} IS NULL THEN CAST({first} AS DECIMAL(30,9)) ELSE {blend} END)"


def hashrate_units(n: str, w: str) -> str:
    return (f"(CASE WHEN {n} = 0 THEN CAST(0 AS HUGEINT) ELSE "
            f"{rdiv(f'CAST({n} AS HUGEINT) * {units(w, 9)} * 33554432', '675000000000')} END)")


def hashrate_cols(e: str, prefix: str) -> str:
    return ",\n         ".join([f"{dec(e, 30, 0)} AS {prefix}"] + [
        f"{dec(e, 30, k)} AS {prefix}_{sfx}" for sfx, k in (("th", 12), ("ph", 15), ("eh", 18))])


FACT_NETWORK = f"""net_w AS (
  SELECT a.*, {weighted('a.difficulty_first', 'c.area', 'c.t_first')} AS difficulty_weighted_avg
  FROM net_agg a LEFT JOIN chg_day c USING (event_date)),
fact_network AS (
  SELECT substr(dd.date_id, 1, 512) AS date_id, has_subsidy_halving, has_difficulty_adjustment,
         CAST(difficulty_first AS DECIMAL(30,9)) AS difficulty_first,
         CAST(difficulty_last AS DECIMAL(30,9)) AS difficulty_last,
         difficulty_weighted_avg,
         CAST(block_count AS INTEGER) AS block_count,
         CAST(blockheight_first AS INTEGER) AS blockheight_first,
         CAST(blockheight_last AS INTEGER) AS blockheight_last,
         CAST(pool_count AS INTEGER) AS pool_count,
         {hashrate_cols(hashrate_units('block_count', 'difficulty_weighted_avg'), 'estimated_hashrate')},
         {reward_columns()},
         audit_created_timestamp
  FROM net_w JOIN calendar dd ON dd.date = net_w.event_date)"""

POOL_AGG = """pool_agg AS (
  SELECT event_date, pool_key,
         bool_or(coalesce(blockheight % 2016 = 0, false)) AS has_difficulty_adjustment,
         count(block_key) AS block_count,
         min(blockheight) AS blockheight_first, max(blockheight) AS blockheight_last,
         sum(reward_subsidy) AS reward_subsidy_sum, sum(reward_tx_fee_sum) AS reward_tx_fee_sum,
         sum(tx_count) AS tx_count, max(audit_created_timestamp) AS audit_created_timestamp,
         arg_min_null(difficulty, blockheight) AS difficulty_first
  FROM blocks GROUP BY event_date, pool_key)"""

POOL_NET = """pool_net AS (
  SELECT event_date, bool_or(has_difficulty_adjustment) AS has_difficulty_adjustment,
         min(blockheight_first) AS blockheight_first, max(blockheight_last) AS blockheight_last,
         arg_min_null(difficulty_first, blockheight_first) AS difficulty_first
  FROM pool_agg GROUP BY event_date)"""

HASHRATE = f"""hr_staged AS (
  SELECT CAST(date AS DATE) AS event_date, trim(pool_key) AS pool_key,
         CAST(hashrate AS DECIMAL(30,0)) AS reported_hashrate, loaded_at AS audit_created_timestamp
  FROM src_hashrate WHERE trim(pool_key) IS NOT NULL),
hr_latest AS ({dedupe('hr_staged', ['event_date', 'pool_key'], ['audit_created_timestamp', 'reported_hashrate'])})"""


def reported_cols() -> str:
    r = "CAST(h.reported_hashrate AS DECIMAL(30,9))"
    out = [f"{r} AS reported_hashrate"]
    for sfx, k in (("th", 12), ("ph", 15), ("eh", 18)):
        out.append(f"{xratio(units(r, 9), '1', 30, k, 9 + k)} AS reported_hashrate_{sfx}")
    return ",\n         ".join(out)


FACT_POOL = f"""pool_net_w AS (
  SELECT a.event_date, {weighted('a.difficulty_first', 'c.area', 'c.t_first')} AS difficulty_weighted_avg
  FROM pool_net a LEFT JOIN chg_day c USING (event_date)),
fact_pool AS (
  SELECT substr(dd.date_id, 1, 512) AS date_id, substr(coalesce(pl.pool_id, '0'), 1, 512) AS pool_id,
         {reported_cols()},
         {hashrate_cols(hashrate_units('a.block_count', 'w.difficulty_weighted_avg'), 'estimated_hashrate')},
         CAST(a.block_count AS INTEGER) AS block_count,
         CAST(a.blockheight_first AS INTEGER) AS blockheight_first,
         CAST(a.blockheight_last AS INTEGER) AS blockheight_last,
         {reward_columns('a.reward_subsidy_sum', 'a.reward_tx_fee_sum', 'a.tx_count')},
         a.audit_created_timestamp
  FROM pool_agg a
  JOIN pool_net_w w ON w.event_date = a.event_date
  JOIN calendar dd ON dd.date = a.event_date
  LEFT JOIN hr_latest h ON h.event_date = a.event_date AND h.pool_key = a.pool_key
  LEFT JOIN pool_lookup pl ON pl.pool_key = a.pool_key)"""

OBT_BLOCK = """obt_block AS (
  SELECT db.block_id, db.block_key, db.block_hash, fb.blockheight, db.is_subsidy_halving,
         fb.subsidy_epoch, fb.subsidy_level, fb.subsidy_level_btc, db.is_difficulty_adjustment,
         fb.difficulty_epoch, fb.difficulty, dd.date_id, dd.date AS event_date, fb.event_timestamp,
         dd.day_of_week, dd.day_of_month, dd.day_of_year, dp.pool_id, dp.pool_key, dp.pool_name,
         dp.pool_url, dp.is_antpool_friend, dp.is_antpool_friend_custodian,
         dp.is_antpool_friend_template, fb.reward_mining, fb.reward_subsidy, fb.reward_tx_fee_sum,
         fb.reward_tx_fee_pct, fb.reward_mining_btc, fb.reward_subsidy_btc, fb.reward_tx_fee_sum_btc,
         fb.tx_count, fb.tx_fee_avg, fb.tx_fee_avg_btc
  FROM fact_block fb
  JOIN dim_block db ON db.block_id = fb.block_id
  JOIN calendar dd ON dd.date_id = fb.date_id
  JOIN dim_pool dp ON dp.pool_id = fb.pool_id)"""

NET_COLS = ["has_subsidy_halving", "has_difficulty_adjustment", "difficulty_first", "difficulty_last",
            "difficulty_weighted_avg", "block_count", "blockheight_first", "blockheight_last",
            "pool_count", "estimated_hashrate", "estimated_hashrate_th", "estimated_hashrate_ph",
            "estimated_hashrate_eh", "reward_mining_sum", "reward_subsidy_sum", "reward_tx_fee_sum",
            "tx_count", "reward_tx_fee_pct", "reward_mining_sum_btc", "reward_subsidy_sum_btc",
            "reward_tx_fee_sum_btc"]


def usd(p: str, b: str) -> str:
    """DuckDB multiplies decimals exactly; the cast rounds once."""
    return f"CAST({p} * {b} AS DECIMAL(21,6))"


OBT_NETWORK = f"""obt_network_1 AS (
  SELECT ns.date_id, dd.date AS event_date, dd.day_of_week, dd.day_of_month, dd.day_of_year,
         p.ticker, p.price_close, {', '.join('ns.' + c for c in NET_COLS)},
         {usd('p.price_close', 'ns.reward_mining_sum_btc')} AS reward_mining_sum_usd,
         {usd('p.price_close', 'ns.reward_subsidy_sum_btc')} AS reward_subsidy_sum_usd,
         {usd('p.price_close', 'ns.reward_tx_fee_sum_btc')} AS reward_tx_fee_sum_usd,
         ns.tx_fee_avg, ns.tx_fee_avg_btc,
         {usd('p.price_close', 'ns.tx_fee_avg_btc')} AS tx_fee_avg_usd,
         {xratio('ns.reward_mining_sum', units('ns.estimated_hashrate_th', 12), 30, 9, 0, 12)} AS hashvalue_sat_th,
         {xratio('ns.reward_mining_sum', units('ns.estimated_hashrate_ph', 15), 30, 9, 0, 15)} AS hashvalue_sat_ph
  FROM fact_network ns
  JOIN fact_price p ON p.date_id = ns.date_id
  JOIN calendar dd ON dd.date_id = ns.date_id),
obt_network AS (
  SELECT *,
         {xratio(f"{units('price_close', 2)} * {units('hashvalue_sat_th', 9)}", '1', 30, 9, 19)} AS hashprice_usd_th,
         {xratio(f"{units('price_close', 2)} * {units('hashvalue_sat_ph', 9)}", '1', 30, 9, 19)} AS hashprice_usd_ph
  FROM obt_network_1)"""

POOL_REWARD = ["reward_mining_sum", "reward_subsidy_sum", "reward_tx_fee_sum", "tx_count",
               "reward_tx_fee_pct", "reward_mining_sum_btc", "reward_subsidy_sum_btc",
               "reward_tx_fee_sum_btc"]


def obt_pool(strict: bool = False) -> str:
    p_expected, p_diff, p_luck = (12, 12, 12) if strict else (21, 22, 30)
    e = "expected_block_count"
    eu = units(e, 9)
    pct = xratio(f"CAST(100 AS HUGEINT) * block_count * 1000000000 - {eu}", eu, 30, 9, 9, 9)
    luck = xratio("CAST(100 AS HUGEINT) * block_count", eu, 30, 9, 0, 9)
    if not strict:
        pct = f"(CASE WHEN {eu} = 0 THEN NULL ELSE {pct} END)"
        luck = f"(CASE WHEN {eu} = 0 THEN NULL ELSE {luck} END)"
    return f"""obt_pool_1 AS (
  SELECT ps.date_id, dd.date AS event_date, dd.day_of_week, dd.day_of_month, dd.day_of_year,
         dp.pool_id, dp.pool_key, dp.pool_name, dp.pool_url, dp.is_antpool_friend,
         dp.is_antpool_friend_custodian, dp.is_antpool_friend_template,
         ps.reported_hashrate, ps.reported_hashrate_th, ps.reported_hashrate_ph, ps.reported_hashrate_eh,
         ps.estimated_hashrate, ps.estimated_hashrate_th, ps.estimated_hashrate_ph, ps.estimated_hashrate_eh,
         CAST(CAST(CAST(ps.reported_hashrate AS DECIMAL(30,9)) * 86400 AS DECIMAL(36,9))
               / CAST(ns.difficulty_weighted_avg AS DECIMAL(30,9)) / 4294967296.0 AS DECIMAL({p_expected},9))
           AS expected_block_count,
         ps.block_count, ps.blockheight_first, ps.blockheight_last,
         {', '.join('ps.' + c for c in POOL_REWARD)},
         {usd('p.price_close', 'ps.reward_mining_sum_btc')} AS reward_mining_sum_usd,
         {usd('p.price_close', 'ps.reward_subsidy_sum_btc')} AS reward_subsidy_sum_usd,
         {usd('p.price_close', 'ps.reward_tx_fee_sum_btc')} AS reward_tx_fee_sum_usd,
         ps.tx_fee_avg, ps.tx_fee_avg_btc,
         {usd('p.price_close', 'ps.tx_fee_avg_btc')} AS tx_fee_avg_usd
  FROM fact_pool ps
  JOIN fact_network ns ON ns.date_id = ps.date_id
  JOIN fact_price p ON p.date_id = ps.date_id
  JOIN calendar dd ON dd.date_id = ps.date_id
  JOIN dim_pool dp ON dp.pool_id = ps.pool_id),
obt_pool AS (
  SELECT * EXCLUDE (blockheight_first, blockheight_last, reward_mining_sum, reward_subsidy_sum,
                    reward_tx_fee_sum, tx_count, reward_tx_fee_pct, reward_mining_sum_btc,
                    reward_subsidy_sum_btc, reward_tx_fee_sum_btc, reward_mining_sum_usd,
                    reward_subsidy_sum_usd, reward_tx_fee_sum_usd, tx_fee_avg, tx_fee_avg_btc,
                    tx_fee_avg_usd),
         CAST(CAST(block_count AS DECIMAL(10,0)) - {e} AS DECIMAL({p_diff},9)) AS block_count_diff,
         CAST({pct} AS DECIMAL({p_luck},9)) AS block_count_diff_pct,
         CAST({luck} AS DECIMAL({p_luck},9)) AS mining_luck,
         blockheight_first, blockheight_last, {', '.join(POOL_REWARD)},
         reward_mining_sum_usd, reward_subsidy_sum_usd, reward_tx_fee_sum_usd,
         tx_fee_avg, tx_fee_avg_btc, tx_fee_avg_usd
  FROM obt_pool_1)"""


# -- assembling queries --------------------------------------------------------------

# Which CTE blocks each final relation needs, in dependency order.
_DEPS = {
    "src_block": [SRC_BLOCK],
    "src_pool": [SRC_POOL],
    "src_price": [SRC_PRICE],
    "src_hashrate": [SRC_HASHRATE],
    "calendar": [CALENDAR],
    "staged_block": ["src_block", STAGED_BLOCK],
    "blocks": ["staged_block", BLOCKS],
    "dim_pool": ["src_pool", DIM_POOL],
    "dim_block": ["blocks", DIM_BLOCK],
    "fact_price": ["src_price", "calendar", FACT_PRICE],
    "fact_block": ["blocks", "calendar", "dim_pool", FACT_BLOCK],
    "net_agg": ["blocks", NET_AGG],
    "changes": ["blocks", CHANGES],
    "pool_agg": ["blocks", POOL_AGG],
    "pool_net": ["pool_agg", POOL_NET],
    "hashrate": ["src_hashrate", HASHRATE],
    "fact_network": ["net_agg", "changes", "calendar", FACT_NETWORK],
    "fact_pool": ["pool_net", "changes", "calendar", "dim_pool", "hashrate", FACT_POOL],
    "obt_block": ["fact_block", "dim_block", OBT_BLOCK],
    "obt_network": ["fact_network", "fact_price", OBT_NETWORK],
    "obt_pool": ["fact_pool", "fact_network", "fact_price", obt_pool(strict=False)],
}


def with_ctes(*needs: str) -> str:
    """``WITH`` clause holding every CTE the named relations need, once each."""
    seen: list[str] = []

    def visit(item: str) -> None:
        if item in _DEPS:
            for dep in _DEPS[item]:
                visit(dep)
        elif item not in seen:
            seen.append(item)

    for n in needs:
        visit(n)
    return "WITH " + ",\n".join(seen) + "\n"


def select_from(rel: str, extra_ctes: str = "", body: str | None = None) -> str:
    head = with_ctes(rel)
    if extra_ctes:
        head = head.rstrip("\n") + ",\n" + extra_ctes + "\n"
    return head + (body or f"SELECT * FROM {rel}")


def forked(sql: str) -> str:
    """The same query over the blocks with forks and gaps."""
    return sql.replace(SRC_BLOCK, SRC_BLOCK_FORKED)


# Every branch is walked from each of its blocks down to its root.
CHAIN = BLOCKS.replace("blocks AS", "all_blocks AS", 1) + """,
linked AS (
  SELECT b.block_key, b.blockheight, epoch_us(b.event_timestamp) AS t, p.block_key AS parent
  FROM all_blocks b LEFT JOIN all_blocks p ON p.block_key = b.prev_block_hash AND p.blockheight = b.blockheight - 1),
walk AS (
  SELECT block_key AS node, parent AS below, blockheight AS h, t, block_key AS last FROM linked
  UNION ALL
  SELECT l.block_key, l.parent, w.h, w.t, w.last FROM walk w JOIN linked l ON l.block_key = w.below),
ends AS (
  SELECT node AS block_key, h, t, last FROM walk
  QUALIFY row_number() OVER (PARTITION BY node ORDER BY h DESC, t, last) = 1),
ranked AS (
  SELECT l.block_key, l.parent, row_number() OVER (
           PARTITION BY l.parent, CASE WHEN l.parent IS NULL THEN l.block_key END ORDER BY e.h DESC, e.t, e.last) AS place
  FROM linked l JOIN ends e USING (block_key)),
chain AS (
  SELECT block_key FROM ranked WHERE parent IS NULL
  UNION ALL
  SELECT r.block_key FROM chain c JOIN ranked r ON r.parent = c.block_key AND r.place = 1),
blocks AS (SELECT * FROM all_blocks WHERE block_key IN (SELECT block_key FROM chain))"""


def on_chain(sql: str) -> str:
    """The same query over the canonical chain of the blocks with forks and gaps."""
    return forked(sql).replace(BLOCKS, CHAIN).replace("WITH ", "WITH RECURSIVE ", 1)


# -- extensions (E3, E4, E5) ----------------------------------------------------------

def checked_writes(grain: dict, rules: dict) -> str:
    """Rows of each model, keys beyond the first of their kind, null keys, and rows that break a rule."""
    tables = {m: "dim_" + m[4:] if m.startswith("dim.") else m.replace(".", "_").replace("_stats_1d", "").replace("_1d", "")
              for m in grain if m != "dim.date"}
    parts = []
    for model, t in tables.items():
        keys = ", ".join(grain[model])
        found = {"rows": "count(*)", "grain": f"count(*) - count(DISTINCT ({keys}))"}
        found |= {f"null:{k}": f"count(*) FILTER ({k} IS NULL)" for k in grain[model]}
        found |= {name: f"count(*) FILTER (NOT ({ok}))" for name, ok in rules.get(model, {}).items()}
        parts += [f"SELECT '{model}' AS model, '{rule}' AS rule, {n} AS row_count FROM {t}" for rule, n in found.items()]
    return with_ctes(*tables.values()) + "\nUNION ALL\n".join(parts)


# Blocks first dated a day early where they come again later; the second delivery has those again.
FINAL_DAYS = with_ctes("src_block") + """SELECT event_date, any_value(block_count) AS block_count,
  any_value(reward_subsidy_sum) AS reward_subsidy_sum, any_value(reward_tx_fee_sum) AS reward_tx_fee_sum,
  any_value(tx_count) AS tx_count, any_value(blockheight_first) AS blockheight_first,
  any_value(blockheight_last) AS blockheight_last, CAST(coalesce(any_value(late_rows), 0) AS BIGINT) AS late_rows
FROM (
  WITH late AS (SELECT * FROM src_block WHERE loaded_at <> "timestamp"),
  early AS (SELECT DISTINCT * REPLACE ("timestamp" - CASE WHEN block_hash IN (SELECT block_hash FROM late)
      THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS "timestamp") FROM src_block WHERE loaded_at = "timestamp"),
  bound AS (SELECT max("timestamp") - INTERVAL 1 DAY AS first_mark FROM early),
  last_bound AS (SELECT max(t) - INTERVAL 1 DAY AS mark
    FROM (SELECT "timestamp" AS t FROM early UNION ALL SELECT "timestamp" FROM late))
  SELECT CAST("timestamp" AS DATE) AS event_date, count(*) AS block_count,
    CAST(sum(reward_subsidy) AS BIGINT) AS reward_subsidy_sum, CAST(sum(reward_tx_fee_sum) AS BIGINT) AS reward_tx_fee_sum,
    CAST(sum(tx_count) AS BIGINT) AS tx_count, min(blockheight) AS blockheight_first, max(blockheight) AS blockheight_last,
    CAST(NULL AS BIGINT) AS late_rows
  FROM early GROUP BY 1 HAVING CAST("timestamp" AS DATE) + INTERVAL 1 DAY <= (SELECT mark FROM last_bound)
  UNION ALL BY NAME
  SELECT CAST("timestamp" AS DATE) AS event_date, count(*) AS late_rows
  FROM late WHERE "timestamp" <= (SELECT first_mark FROM bound) GROUP BY 1)
GROUP BY event_date"""


def _reward_tail(s="reward_subsidy_sum", f="reward_tx_fee_sum", m="reward_mining_sum", t="tx_count"):
    return (f"{safe_xratio(f'100 * {f}', f'{s} + {f}', 12, 9)} AS reward_tx_fee_pct, "
            f"{btc(m)} AS reward_mining_sum_btc, {safe_xratio(f, t, 16, 3)} AS tx_fee_avg")


def epoch_summary(epoch: str) -> str:
    return select_from("obt_block", body=f"""
SELECT {epoch}, block_count, blockheight_first, blockheight_last, first_block_timestamp,
       last_block_timestamp, epoch_us(last_block_timestamp) - epoch_us(first_block_timestamp) AS epoch_span_us,
       difficulty_min, difficulty_max, pool_count, reward_mining_sum, reward_subsidy_sum,
       reward_tx_fee_sum, tx_count, {_reward_tail()}
FROM (SELECT {epoch}, count(block_id) AS block_count, min(blockheight) AS blockheight_first,
             max(blockheight) AS blockheight_last, min(event_timestamp) AS first_block_timestamp,
             max(event_timestamp) AS last_block_timestamp, min(difficulty) AS difficulty_min,
             max(difficulty) AS difficulty_max, count(DISTINCT pool_id) AS pool_count,
             CAST(sum(reward_mining) AS BIGINT) AS reward_mining_sum,
             CAST(sum(reward_subsidy) AS BIGINT) AS reward_subsidy_sum,
             CAST(sum(reward_tx_fee_sum) AS BIGINT) AS reward_tx_fee_sum,
             CAST(sum(tx_count) AS BIGINT) AS tx_count
      FROM obt_block GROUP BY {epoch})""")


POOL_SUMMARY = select_from("obt_block", body=f"""
SELECT *, {_reward_tail()}
FROM (SELECT pool_id, pool_key, pool_name, count(block_id) AS block_count,
             min(blockheight) AS blockheight_first, max(blockheight) AS blockheight_last,
             min(event_timestamp) AS first_block_timestamp, max(event_timestamp) AS last_block_timestamp,
             count(DISTINCT date_id) AS active_days,
             CAST(sum(reward_mining) AS BIGINT) AS reward_mining_sum,
             CAST(sum(reward_subsidy) AS BIGINT) AS reward_subsidy_sum,
             CAST(sum(reward_tx_fee_sum) AS BIGINT) AS reward_tx_fee_sum,
             CAST(sum(tx_count) AS BIGINT) AS tx_count
      FROM obt_block GROUP BY pool_id, pool_key, pool_name)""")


def luck_model(days: int = 7) -> str:
    e = "trailing_expected"
    luck = xratio("trailing_block_count * 100", units(e, 9), 30, 9, 0, 9)
    return select_from("obt_pool", extra_ctes=f"""luck_daily AS (
  SELECT pool_id, date_id, sum(block_count) AS block_count,
         sum(block_count) FILTER (WHERE expected_block_count IS NOT NULL) AS counted,
         sum(expected_block_count) AS expected_block_count
  FROM obt_pool GROUP BY pool_id, date_id),
luck_trailing AS (
  SELECT *, coalesce(sum(counted) OVER w, 0) AS trailing_block_count,
         CAST(sum(expected_block_count) OVER w AS DECIMAL(22,9)) AS trailing_expected,
         count(date_id) OVER w AS trailing_days
  FROM luck_daily
  WINDOW w AS (PARTITION BY pool_id ORDER BY date_id ROWS BETWEEN {days - 1} PRECEDING AND CURRENT ROW))""",
        body=f"""SELECT pool_id, date_id, CAST(block_count AS BIGINT) AS block_count,
       CAST(expected_block_count AS DECIMAL(22,9)) AS expected_block_count, trailing_days,
       CAST(trailing_block_count AS BIGINT) AS trailing_block_count, {e},
       CASE WHEN {e} > 0 THEN {luck} END AS trailing_luck,
       CASE WHEN {e} > 0 THEN round((CAST(trailing_block_count AS DOUBLE) - CAST({e} AS DOUBLE))
            / sqrt(CAST({e} AS DOUBLE)), 6) END AS luck_z_score,
       CASE WHEN {e} > 0 THEN round(1 - coalesce(list_sum(list_transform(range(CAST(trailing_block_count AS BIGINT)),
            lambda i: exp(i * ln(CAST({e} AS DOUBLE)) - CAST({e} AS DOUBLE) - lgamma(i + 1)))), 0), 9) END AS luck_p_value
FROM luck_trailing""")


# -- second star: order lines --------------------------------------------------------------

ORDERS_STAR = f"""part_staged AS (
  SELECT CAST(p_partkey AS VARCHAR) AS part_key, trim(p_name) AS part_name, trim(p_brand) AS brand,
         trim(p_type) AS part_type, CAST(p_size AS INTEGER) AS size,
         CAST(p_retailprice AS DECIMAL(12,2)) AS retail_price
  FROM part WHERE p_partkey IS NOT NULL),
dim_part AS (
  SELECT md5('surrogate' || part_key) AS part_id, *
  FROM ({dedupe('part_staged', ['part_key'], ['part_name', 'brand', 'part_type', 'size', 'retail_price'])})
  UNION ALL BY NAME SELECT '0' AS part_id, '[Unknown]' AS part_key, '[Unknown]' AS part_name),
supplier_staged AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS supplier_key, trim(s_name) AS supplier_name,
         CAST(s_nationkey AS INTEGER) AS nation_key, CAST(s_acctbal AS DECIMAL(12,2)) AS account_balance
  FROM supplier WHERE s_suppkey IS NOT NULL),
dim_supplier AS (
  SELECT md5('surrogate' || supplier_key) AS supplier_id, *
  FROM ({dedupe('supplier_staged', ['supplier_key'], ['supplier_name', 'nation_key', 'account_balance'])})
  UNION ALL BY NAME SELECT '0' AS supplier_id, '[Unknown]' AS supplier_key, '[Unknown]' AS supplier_name),
li_staged AS (
  SELECT CAST(l_orderkey AS BIGINT) AS order_key, CAST(l_linenumber AS INTEGER) AS line_number,
         CAST(l_shipdate AS DATE) AS ship_date, CAST(l_partkey AS VARCHAR) AS part_key,
         CAST(l_suppkey AS VARCHAR) AS supplier_key, CAST(l_quantity AS DECIMAL(12,2)) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS extended_price,
         CAST(l_discount AS DECIMAL(4,2)) AS discount, CAST(l_tax AS DECIMAL(4,2)) AS tax,
         trim(l_returnflag) AS return_flag, trim(l_linestatus) AS line_status
  FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL),
li_latest AS ({dedupe('li_staged', ['order_key', 'line_number'], ['ship_date', 'part_key', 'supplier_key', 'quantity', 'extended_price', 'discount', 'tax', 'return_flag', 'line_status'])}),
fact_li AS (
  SELECT dd.date_id, l.order_key, l.line_number, coalesce(p.part_id, '0') AS part_id,
         coalesce(s.supplier_id, '0') AS supplier_id, l.return_flag, l.line_status, l.quantity,
         l.extended_price, l.discount,
         CAST(l.extended_price * (1 - l.discount) AS DECIMAL(24,4)) AS revenue,
         CAST(l.extended_price * (1 - l.discount) * (1 + l.tax) AS DECIMAL(28,6)) AS charge
  FROM li_latest l
  JOIN calendar dd ON dd.date = l.ship_date
  LEFT JOIN (SELECT part_key, part_id FROM dim_part WHERE part_id <> '0') p ON p.part_key = l.part_key
  LEFT JOIN (SELECT supplier_key, supplier_id FROM dim_supplier WHERE supplier_id <> '0') s
    ON s.supplier_key = l.supplier_key)"""

_DEPS["orders_star"] = ["calendar", ORDERS_STAR]

SALES_DAILY = with_ctes("orders_star") + f"""SELECT date_id, return_flag, line_count, part_count,
       quantity_sum, extended_price_sum, revenue_sum,
       {xratio(units('extended_price_sum', 2), 'line_count', 18, 4, 2)} AS avg_extended_price
FROM (SELECT date_id, return_flag, count(order_key) AS line_count, count(DISTINCT part_id) AS part_count,
             CAST(sum(quantity) AS DECIMAL(22,2)) AS quantity_sum,
             CAST(sum(extended_price) AS DECIMAL(28,2)) AS extended_price_sum,
             CAST(sum(revenue) AS DECIMAL(34,4)) AS revenue_sum
      FROM fact_li GROUP BY date_id, return_flag)"""
