"""DuckDB oracle SQL for every registered query.

Written independently of the Spark code, from the model definitions and
FIXTURES.md (DuckDB spellings: ``arg_min/arg_max``, ``epoch_ms``, quoted
"interval", ``//``; whole-hour differences via ``date_sub('hour', a, b)``,
Sunday = 1 via ``dayofweek + 1``, ``strftime('%A')``). Derived doubles are
rounded to 6 decimals, as on the Spark side.
"""

from __future__ import annotations

STG_NOT_NULL = [
    "source", "source_dataset", "symbol", "bar_interval", "open_time_ms", "open_time_utc",
    "open_date", "open", "high", "low", "close", "volume", "loaded_at", "batch_id",
]
SYMBOLS = ["BTCUSDT", "ETHUSDT", "SOLUSDT", "BNBUSDT", "XRPUSDT"]

RAW_DOUBLES = [
    "open", "high", "low", "close", "volume", "quote_asset_volume",
    "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume",
]
FEATURE_DOUBLES = RAW_DOUBLES + [
    "previous_close", "previous_volume", "return_1h", "log_return_1h", "price_range",
    "price_range_pct", "body_size_pct", "volume_change_1h", "rolling_mean_close_24h",
    "rolling_volatility_24h", "rolling_volume_mean_24h",
]
TIMESERIES_DOUBLES = [c for c in FEATURE_DOUBLES if c not in ("previous_close", "previous_volume")]


def _bars(where: str, batch: str, loaded_at: str) -> str:
    return f"""
    select 'binance_spot' as source, 'klines' as dataset, symbol, '1h' as "interval",
           epoch_ms(open_time_utc) as open_time_ms, open_time_utc,
           arg_min(price, event_id) as open, max(price) as high, min(price) as low,
           arg_max(price, event_id) as close, sum(qty) as volume,
           epoch_ms(open_time_utc) + 3599999 as close_time_ms,
           epoch_ms(epoch_ms(open_time_utc) + 3599999) as close_time_utc,
           round(sum(price * qty), 6) as quote_asset_volume, count(*) as number_of_trades,
           sum(case when is_buy then qty else 0.0 end) as taker_buy_base_asset_volume,
           round(sum(case when is_buy then price * qty else 0.0 end), 6) as taker_buy_quote_asset_volume,
           timestamp '{loaded_at}' as loaded_at, '{batch}' as batch_id
    from ticks where {where} group by symbol, open_time_utc"""


_W = "partition by symbol, bar_interval order by open_time_utc"
_R = f"{_W} rows between 23 preceding and current row"

CTES = f"""
with ticks as (
    select event_id,
           case event_type when 'purchase' then 'BTCUSDT' when 'click' then 'ETHUSDT'
                when 'view' then 'SOLUSDT' when 'signup' then 'BNBUSDT' else 'XRPUSDT' end as symbol,
           date_trunc('hour', ts) as open_time_utc,
           value as price, cast(1 + event_id % 10 as double) as qty, user_id % 2 = 0 as is_buy
    from events),
raw_klines as (
    {_bars("(event_id % 3 <> 0 or open_time_utc < timestamp '2024-01-15 00:00:00')", "batch-001", "2024-02-01 00:00:00")}
    union all
    {_bars("open_time_utc >= timestamp '2024-01-15 00:00:00'", "batch-002", "2024-02-02 00:00:00")}),
stg_klines as (
    select source, dataset as source_dataset, symbol, "interval" as bar_interval,
           open_time_ms, open_time_utc, cast(open_time_utc as date) as open_date,
           open, high, low, close, volume, close_time_ms, close_time_utc,
           quote_asset_volume, number_of_trades, taker_buy_base_asset_volume,
           taker_buy_quote_asset_volume, loaded_at, batch_id
    from raw_klines where open_time_utc is not null),
int_klines_normalized as (
    select * from stg_klines
    qualify row_number() over (partition by symbol, bar_interval, open_time_utc
                               order by loaded_at desc, batch_id desc) = 1),
fact_prices as (
    select symbol, bar_interval, open_time_utc, open_date, open, high, low, close, volume,
           quote_asset_volume, number_of_trades, taker_buy_base_asset_volume,
           taker_buy_quote_asset_volume, loaded_at, batch_id
    from int_klines_normalized),
f_lag as (
    select *, lag(close) over ({_W}) as previous_close, lag(volume) over ({_W}) as previous_volume
    from fact_prices),
f_derived as (
    select *,
           (close - previous_close) / nullif(previous_close, 0) as return_1h,
           case when close > 0 and previous_close > 0 then ln(close / previous_close) end as log_return_1h,
           high - low as price_range,
           (high - low) / nullif(open, 0) as price_range_pct,
           abs(close - open) / nullif(open, 0) as body_size_pct,
           (volume - previous_volume) / nullif(previous_volume, 0) as volume_change_1h
    from f_lag),
fact_price_features as (
    select symbol, bar_interval, open_time_utc, open_date, open, high, low, close, volume,
           quote_asset_volume, number_of_trades, taker_buy_base_asset_volume,
           taker_buy_quote_asset_volume, previous_close, previous_volume, return_1h,
           log_return_1h, price_range, price_range_pct, body_size_pct, volume_change_1h,
           avg(close) over ({_R}) as rolling_mean_close_24h,
           stddev_samp(return_1h) over ({_R}) as rolling_volatility_24h,
           avg(volume) over ({_R}) as rolling_volume_mean_24h,
           count(*) over ({_R}) as rolling_window_observations_24h,
           loaded_at, batch_id
    from f_derived),
fact_price_hourly as (
    select symbol, bar_interval, open_time_utc, open_date, open, high, low, close, volume,
           quote_asset_volume, number_of_trades,
           (close - lag(close) over (partition by symbol, bar_interval order by open_time_utc, loaded_at, batch_id))
             / nullif(lag(close) over (partition by symbol, bar_interval order by open_time_utc, loaded_at, batch_id), 0)
             as return_1h,
           loaded_at, batch_id
    from stg_klines),
dim_symbol as (
    select symbol, 'crypto' as asset_class, 'Binance Spot' as exchange, 'USDT' as quote_currency,
           min(open_time_utc) as first_seen_at, max(open_time_utc) as last_seen_at,
           count(*) as observed_bars
    from int_klines_normalized group by symbol),
cal_bounds as (select min(open_date) as lo, max(open_date) as hi from int_klines_normalized),
cal_days as (
    select cast(unnest(generate_series(cast(lo as timestamp), cast(hi as timestamp), interval 1 day)) as date)
           as calendar_date
    from cal_bounds where lo is not null),
dim_calendar as (
    select calendar_date,
           cast(year(calendar_date) as bigint) as calendar_year,
           cast(quarter(calendar_date) as bigint) as calendar_quarter,
           cast(month(calendar_date) as bigint) as calendar_month,
           cast(day(calendar_date) as bigint) as calendar_day,
           cast(dayofweek(calendar_date) + 1 as bigint) as day_of_week,
           strftime(calendar_date, '%A') as day_name,
           calendar_date = date '2024-01-15' as is_current_date
    from cal_days),
dashboard_price_timeseries as (
    select symbol, bar_interval, open_time_utc, open_date, open, high, low, close, volume,
           quote_asset_volume, number_of_trades, taker_buy_base_asset_volume,
           taker_buy_quote_asset_volume, return_1h, log_return_1h, price_range, price_range_pct,
           body_size_pct, volume_change_1h, rolling_mean_close_24h, rolling_volatility_24h,
           rolling_volume_mean_24h, rolling_window_observations_24h, loaded_at
    from fact_price_features where symbol = 'BTCUSDT' and bar_interval = '1h'),
daily as (
    select symbol, bar_interval, open_date,
           arg_min(open, open_time_utc) as daily_open, max(high) as daily_high, min(low) as daily_low,
           arg_max(close, open_time_utc) as daily_close, sum(volume) as daily_volume,
           count(*) as bars_count, avg(return_1h) as average_hourly_return,
           avg(rolling_volatility_24h) as average_rolling_volatility_24h,
           min(open_time_utc) as first_bar_utc, max(open_time_utc) as last_bar_utc,
           max(loaded_at) as latest_loaded_at
    from fact_price_features where symbol = 'BTCUSDT' and bar_interval = '1h'
    group by symbol, bar_interval, open_date),
dashboard_daily_summary as (
    select symbol, bar_interval, open_date, daily_open, daily_high, daily_low, daily_close,
           daily_volume, bars_count, (daily_close - daily_open) / nullif(daily_open, 0) as daily_return,
           average_hourly_return, average_rolling_volatility_24h, first_bar_utc, last_bar_utc,
           latest_loaded_at
    from daily),
dashboard_data_status as (
    select symbol, bar_interval, count(*) as total_bars,
           count(distinct open_date) as total_market_days,
           min(open_time_utc) as first_market_bar_utc, max(open_time_utc) as latest_market_bar_utc,
           max(loaded_at) as latest_loaded_at,
           date_sub('hour', max(open_time_utc), timestamp '2024-02-03 00:00:00') as hours_since_latest_market_bar,
           date_sub('hour', max(loaded_at), timestamp '2024-02-03 00:00:00') as hours_since_latest_load,
           count(*) filter (where rolling_window_observations_24h = 24) as bars_with_full_24h_window,
           (count(*) filter (where rolling_window_observations_24h = 24)) / nullif(count(*), 0)
             as full_24h_window_ratio
    from fact_price_features group by symbol, bar_interval),
klines_dirty as (
    select * replace (
        case when (open_time_ms // 3600000) % 79 = 0 then 'UNKNOWN' else symbol end as symbol,
        case when (open_time_ms // 3600000) % 97 = 0 then low * 0.5 else high end as high,
        case when (open_time_ms // 3600000) % 83 = 0 then cast(null as double) else close end as close,
        case when (open_time_ms // 3600000) % 89 = 0 then cast(-1 as double) else volume end as volume)
    from int_klines_normalized),
features_tampered as (
    select * replace (
        coalesce(return_1h, 0) as return_1h,
        case when hour(open_time_utc) % 2 = 0 then log_return_1h + 0.1 else log_return_1h end as log_return_1h,
        price_range - 5 as price_range)
    from fact_price_features),
jobs as (
    select ts as creation_time,
           concat('user', cast(user_id % 5 as varchar), '@example.com') as user_email,
           case when event_type in ('click', 'view', 'purchase') then 'QUERY' else 'LOAD' end as job_type,
           event_id * 1000 as total_bytes_processed,
           (event_id % 7 + 1) * 10485760 as total_bytes_billed
    from events),
batch1 as (
    select * replace (timestamp '2024-02-01 00:00:00' as loaded_at, 'batch-001' as batch_id)
    from raw_klines
    where batch_id = case when open_time_utc >= timestamp '2024-01-15 00:00:00' then 'batch-002' else 'batch-001' end),
landed as (
    select *, case when batch_id = 'batch-002'
                   then cast(open_time_utc - interval 1 hour as date)
                   else cast(open_time_utc as date) end as date
    from raw_klines),
merge_target as (
    select symbol, bar_interval, open_time_utc, open_date, open, high, low, close, volume,
           quote_asset_volume, number_of_trades, taker_buy_base_asset_volume,
           taker_buy_quote_asset_volume, loaded_at, batch_id
    from stg_klines
    where batch_id = 'batch-001' and open_time_utc < timestamp '2024-01-20 00:00:00'),
merge_source as (
    select * from fact_prices
    where open_time_utc >= (select coalesce(max(open_time_utc), timestamp '1900-01-01') from merge_target))
"""


# The same models over the fact after an incremental merge: what the target held
# that the source doesn't replace, and the source from the target's newest bar on.
_HEAD, _REST = CTES.split("fact_prices as (", 1)
_FACT_BODY, _REST = _REST.split("f_lag as (", 1)
_MODELS, _MERGE = _REST.split("merge_target as (", 1)
MERGED_CTES = f"""{_HEAD}all_prices as ({_FACT_BODY}merge_target as ({_MERGE.replace("from fact_prices", "from all_prices").rstrip()},
fact_prices as (
    select * from merge_target t where not exists (
        select 1 from merge_source s where s.symbol = t.symbol and s.bar_interval = t.bar_interval
        and s.open_time_utc = t.open_time_utc)
    union all select * from merge_source),
f_lag as ({_MODELS.rstrip().rstrip(",")}
"""


def _q(body: str, doubles: list[str] | None = None, ctes: str = CTES) -> str:
    if not doubles:
        return f"{ctes}\n{body}"
    rep = ", ".join(f"round({c}, 6) as {c}" for c in doubles)
    return f"{ctes}\nselect * replace ({rep}) from ({body}) as _t"


_ARRAY_FIELDS = [
    "open_time_ms", "open", "high", "low", "close", "volume", "close_time_ms",
    "quote_asset_volume", "number_of_trades", "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume",
]
_RAW_COLS = [
    "source", "dataset", "symbol", '"interval"', "open_time_ms", "open_time_utc", "open", "high",
    "low", "close", "volume", "close_time_ms", "close_time_utc", "quote_asset_volume",
    "number_of_trades", "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume",
    "loaded_at", "batch_id",
]
_DIRTY_DOUBLES = RAW_DOUBLES


def _validate_rows_sql(table: str = "klines_dirty", keys: str = "symbol, bar_interval, open_time_ms") -> str:
    parts = []
    for f in _ARRAY_FIELDS:
        nan = f" or isnan({f})" if f not in ("open_time_ms", "close_time_ms", "number_of_trades") else ""
        parts.append(f"select {keys}, '{f} is missing or not a number' as reason "
                     f"from {table} where {f} is null{nan}")
    for f in ["open", "high", "low", "close"]:
        parts.append(f"select {keys}, '{f} must be > 0' as reason "
                     f"from {table} where {f} <= 0")
    for f in ["open_time_ms", "volume", "close_time_ms", "quote_asset_volume", "number_of_trades",
              "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume"]:
        parts.append(f"select {keys}, '{f} must be >= 0' as reason "
                     f"from {table} where {f} < 0")
    full = ("open is not null and high is not null and low is not null and close is not null "
            "and open_time_ms is not null and close_time_ms is not null")
    parts.append(f"select {keys}, 'high is below open or close' as reason "
                 f"from {table} where {full} and (high < open or high < close)")
    parts.append(f"select {keys}, 'low is above open or close' as reason "
                 f"from {table} where {full} and (low > open or low > close)")
    parts.append(f"select {keys}, 'bar closes before it opens' as reason "
                 f"from {table} where {full} and close_time_ms <= open_time_ms")
    return "\nunion all\n".join(parts)


def _required_sql() -> str:
    cols = [c.strip('"') for c in _RAW_COLS]
    return "\nunion all\n".join(
        f"select '{c}' as column_name, true as type_ok, "
        f"count(*) filter (where \"{c}\" is null) as null_count from raw_klines"
        for c in cols
    )


def _not_null_sql(model: str, cols: list[str]) -> str:
    return "\nunion all\n".join(
        f"select '{c}' as column_name, count(*) filter (where \"{c}\" is null) as violations from {model}"
        for c in cols
    )


# --- the check suite (same 87 entries as the Spark suite) -----------------

_NOT_NULL = {
    "stg_klines": STG_NOT_NULL,
    "int_klines_normalized": ["symbol", "bar_interval", "open_time_utc", "open_date", "close", "volume"],
    "dim_symbol": ["symbol", "asset_class", "exchange", "quote_currency"],
    "dim_calendar": ["calendar_date", "calendar_year", "calendar_month", "calendar_day"],
    "fact_prices": ["symbol", "bar_interval", "open_time_utc", "open_date", "close", "volume"],
    "fact_price_features": [
        "symbol", "bar_interval", "open_time_utc", "open_date", "close", "volume",
        "price_range", "price_range_pct", "body_size_pct", "rolling_window_observations_24h",
    ],
    "fact_price_hourly": ["symbol", "bar_interval", "open_time_utc", "close", "volume"],
    "dashboard_price_timeseries": ["symbol", "bar_interval", "open_time_utc", "close", "volume"],
    "dashboard_daily_summary": ["symbol", "bar_interval", "open_date", "daily_close", "daily_volume"],
    "dashboard_data_status": ["symbol", "bar_interval", "total_bars", "latest_market_bar_utc", "latest_loaded_at"],
}


def _in(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _dup(model: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    nn = " and ".join(f"{c} is not null" for c in keys)
    return f"select 1 from {model} where {nn} group by {k} having count(*) > 1"


def _suite_counts() -> list[tuple[str, str, str, str]]:
    nk = ["symbol", "bar_interval", "open_time_utc"]
    out: list[tuple[str, str, str, str]] = []
    for model, cols in _NOT_NULL.items():
        for c in cols:
            out.append((model, "not_null", c, f"select 1 from {model} where {c} is null"))
    out += [
        ("stg_klines", "unique", "open_time_ms", _dup("stg_klines", ["symbol", "bar_interval", "open_time_ms"])),
        ("stg_klines", "unique", "open_time_utc", _dup("stg_klines", nk)),
        ("int_klines_normalized", "unique", "open_time_utc", _dup("int_klines_normalized", nk)),
        ("dim_symbol", "unique", "symbol", _dup("dim_symbol", ["symbol"])),
        ("dim_calendar", "unique", "calendar_date", _dup("dim_calendar", ["calendar_date"])),
    ]
    acc = [
        ("stg_klines", "source", ["binance_spot"]),
        ("stg_klines", "source_dataset", ["klines"]),
        ("stg_klines", "symbol", SYMBOLS),
        ("stg_klines", "bar_interval", ["1h"]),
        ("dim_symbol", "asset_class", ["crypto"]),
    ]
    for model, col, vals in acc:
        out.append((model, "accepted_values", col,
                    f"select {col} from {model} where {col} not in ({_in(vals)}) group by {col}"))
    rels = [
        ("fact_prices", "symbol", "dim_symbol", "symbol"),
        ("fact_prices", "open_date", "dim_calendar", "calendar_date"),
        ("fact_price_features", "symbol", "dim_symbol", "symbol"),
        ("fact_price_features", "open_date", "dim_calendar", "calendar_date"),
    ]
    for child, col, parent, field in rels:
        out.append((child, "relationships", col,
                    f"select 1 from {child} c where c.{col} is not null "
                    f"and not exists (select 1 from {parent} p where p.{field} = c.{col})"))
    key = "symbol,bar_interval,open_time_utc"
    out += [
        ("stg_klines", "unique_natural_key", key, _dup("stg_klines", nk)),
        ("stg_klines", "no_negative_volume", "volume",
         "select 1 from stg_klines where volume < 0 or quote_asset_volume < 0"),
        ("stg_klines", "ohlc_consistency", "high,low",
         "select 1 from stg_klines where open is not null and close is not null "
         "and (high < greatest(open, close) or low > least(open, close))"),
        ("fact_prices", "unique_natural_key", key, _dup("fact_prices", nk)),
        ("fact_prices", "no_hourly_gaps", "open_time_utc", _GAPS_BODY),
        ("fact_price_features", "unique_natural_key", key, _dup("fact_price_features", nk)),
        ("fact_price_features", "first_return_null", "return_1h",
         f"select 1 from (select return_1h, row_number() over ({_W}) as rn from fact_price_features) "
         "where rn = 1 and return_1h is not null"),
        ("fact_price_features", "log_return_consistency", "log_return_1h",
         "select 1 from fact_price_features where return_1h is not null "
         "and abs(log_return_1h - ln(1 + return_1h)) > 0.000000001"),
        ("fact_price_features", "valid_ranges", "price_range,rolling_window_observations_24h",
         "select 1 from fact_price_features where price_range < 0 or price_range_pct < 0 "
         "or body_size_pct < 0 or rolling_window_observations_24h < 1 or rolling_window_observations_24h > 24"),
    ]
    return out


_GAPS_BODY = f"""
select symbol, bar_interval, open_time_utc, previous_open_time_utc from (
    select symbol, bar_interval, open_time_utc,
           lag(open_time_utc) over ({_W}) as previous_open_time_utc
    from fact_prices)
where previous_open_time_utc is not null
  and date_sub('hour', previous_open_time_utc, open_time_utc) != 1"""


_COVERAGE_BODY = (
    "select symbol, bar_interval, open_date, count(*) as bars_count, min(open_time_utc) as first_bar_utc, "
    "max(open_time_utc) as last_bar_utc, "
    "case when count(*) = 24 then 'complete' else 'incomplete' end as coverage_status "
    "from fact_prices group by symbol, bar_interval, open_date "
    "order by open_date desc, symbol, bar_interval"
)

# Landed bars with damage, as loaded by a backfill to 10 January and an incremental
# run to the 20th.
_DAMAGED_CTES = f"""{CTES.rstrip()},
damaged as (
    select * replace (
        case when (open_time_ms // 3600000) % 97 = 0 then low * 0.5 else high end as high,
        case when (open_time_ms // 3600000) % 83 = 0 then cast(null as double) else close end as close,
        case when (open_time_ms // 3600000) % 89 = 0 then cast(-1 as double) else volume end as volume),
        case when open_time_utc < timestamp '2024-01-11 00:00:00' then 'backfill' else 'incremental' end as run
    from batch1
    where open_time_utc >= timestamp '2024-01-01 00:00:00' and open_time_utc < timestamp '2024-01-21 00:00:00')
"""


def _summary_sql() -> str:
    parts = [
        f"select '{m}' as model, '{c}' as check_name, '{col}' as column_name, "
        f"(select count(*) from ({sql}) as _v) as violations"
        for m, c, col, sql in _suite_counts()
    ]
    body = "\nunion all\n".join(parts)
    return (f"select model, check_name, column_name, violations, "
            f"case when violations = 0 then 'pass' else 'fail' end as status from ({body}) as _s")


def oracle_sql() -> dict[str, str]:
    b1_date = "cast(open_time_utc as date)"
    parsed = (
        f"select source, dataset, symbol, \"interval\", {b1_date} as date, "
        f"row_number() over (partition by symbol, \"interval\", {b1_date} order by open_time_ms) - 1 as row_index, "
        + ", ".join(_ARRAY_FIELDS)
        + " from batch1"
    )
    raw_cols = ", ".join(_RAW_COLS)
    ts_cols = (
        "symbol, bar_interval, open_time_utc, open_date, open, high, low, close, volume, "
        "quote_asset_volume, number_of_trades, taker_buy_base_asset_volume, taker_buy_quote_asset_volume, "
        "return_1h, log_return_1h, price_range, price_range_pct, body_size_pct, volume_change_1h, "
        "rolling_mean_close_24h, rolling_volatility_24h, rolling_volume_mean_24h, "
        "rolling_window_observations_24h, loaded_at"
    )
    mib, tib = "pow(1024, 2)", "pow(1024, 4)"
    usage_where = ("creation_time >= timestamp '2024-01-31 00:00:00' - interval 7 day "
                   "and job_type = 'QUERY'")
    q = {
        "parse_kline_payload": _q(parsed, [c for c in RAW_DOUBLES]),
        "enrich_raw": _q(f"select {raw_cols} from batch1", RAW_DOUBLES),
        "scan_raw": _q(f"select {raw_cols}, cast(open_time_utc as date) as date from batch1", RAW_DOUBLES),
        "ingest_summary": _q(
            "select source, dataset, symbol, \"interval\", date, count(*) as row_count, "
            "min(open_time_ms) as min_open_time_ms, max(open_time_ms) as max_open_time_ms, "
            "'source=' || source || '/dataset=' || dataset || '/symbol=' || symbol || '/interval=' || "
            "\"interval\" || '/date=' || cast(date as varchar) as partition_path "
            "from (select *, cast(open_time_utc as date) as date from batch1) "
            "group by source, dataset, symbol, \"interval\", date"
        ),
        "backfill_range": _q(
            f"select {raw_cols} from batch1 where open_time_ms between "
            "epoch_ms(timestamp '2024-01-05 00:00:00') and epoch_ms(timestamp '2024-01-11 00:00:00') - 1",
            RAW_DOUBLES,
        ),
        "incremental_range": _q(
            "select " + ", ".join(f"r.{c}" for c in _RAW_COLS) + " from batch1 r left join ("
            "  select symbol, cast(epoch_ms(max(open_time_ms)) as date) + 1 as start_date from batch1"
            "  where symbol in ('BTCUSDT', 'ETHUSDT') and open_time_utc < timestamp '2024-01-10 12:00:00'"
            "  group by symbol) s on r.symbol = s.symbol "
            "where r.open_time_ms <= epoch_ms(timestamp '2024-01-21 00:00:00') - 1 "
            "and r.open_time_ms >= epoch_ms(cast(coalesce(s.start_date, date '2024-01-01') as timestamp))",
            RAW_DOUBLES,
        ),
        "high_water_mark": _q(
            "select source, dataset, symbol, \"interval\", max(open_time_ms) as last_open_time_ms, "
            "timestamp '2024-02-01 00:00:00' as updated_at from batch1 "
            "group by source, dataset, symbol, \"interval\""
        ),
        "run_incremental_marks": _q(
            "select source, dataset, symbol, \"interval\", max(open_time_ms) as last_open_time_ms from batch1 "
            "where open_time_utc < timestamp '2024-01-21 00:00:00' group by source, dataset, symbol, \"interval\""
        ),
        "marks_read_back": _q(
            "select source, dataset, symbol, \"interval\", max(open_time_ms) as last_open_time_ms, "
            "timestamp '2024-02-01 00:00:00' as updated_at from batch1 "
            "group by source, dataset, symbol, \"interval\""
        ),
        "ingest_rejects": _q(_validate_rows_sql("damaged", "symbol, \"interval\", open_time_ms, run"), ctes=_DAMAGED_CTES),
        "ingest_accepted": _q(
            "select symbol, \"interval\", open_time_ms, open, high, low, close, volume, cast(open_time_utc as date) as date "
            f"from damaged where (symbol, open_time_ms) not in (select (symbol, open_time_ms) from ({_validate_rows_sql('damaged', 'symbol, open_time_ms')}))",
            ["open", "high", "low", "close", "volume"], _DAMAGED_CTES,
        ),
        "incremental_features": _q("select * from fact_price_features", FEATURE_DOUBLES, MERGED_CTES),
        "incremental_gaps": _q(_GAPS_BODY, ctes=MERGED_CTES),
        "incremental_coverage": _q(_COVERAGE_BODY, ctes=MERGED_CTES),
        "gaps_from_day_islands": _q(_GAPS_BODY),
        "stream_two_batches": _q(
            "select symbol, \"interval\", open_time_ms, open, high, low, close, volume, number_of_trades, "
            "cast(open_time_utc as date) as date from batch1",
            ["open", "high", "low", "close", "volume"],
        ),
        "merge_empty_target": _q("select * from fact_prices", RAW_DOUBLES),
        "coverage_report_order": _q(
            "select row_number() over (order by open_date desc, symbol, bar_interval) as position, "
            "symbol, bar_interval, open_date, count(*) as bars_count from fact_prices "
            "group by symbol, bar_interval, open_date"
        ),
        "validate_rows": _q(_validate_rows_sql()),
        "validate_partition_duplicates": _q(
            "select source, dataset, symbol, \"interval\", date, open_time_ms, count(*) as row_count "
            "from landed group by source, dataset, symbol, \"interval\", date, open_time_ms having count(*) > 1"
        ),
        "validate_partition_date": _q(
            "select symbol, \"interval\", date, open_time_ms, batch_id, "
            "cast(epoch_ms(open_time_ms) as date) as row_date from landed "
            "where cast(epoch_ms(open_time_ms) as date) <> date"
        ),
        "validate_required": _q(_required_sql()),
        "stg_klines": _q("select * from stg_klines", RAW_DOUBLES),
        "int_klines_normalized": _q("select * from int_klines_normalized", RAW_DOUBLES),
        "fact_prices": _q("select * from fact_prices", RAW_DOUBLES),
        "fact_price_features": _q("select * from fact_price_features", FEATURE_DOUBLES),
        "fact_price_hourly": _q(
            "select * from fact_price_hourly", ["open", "high", "low", "close", "volume", "quote_asset_volume", "return_1h"]
        ),
        "dim_symbol": _q("select * from dim_symbol"),
        "dim_calendar": _q("select * from dim_calendar"),
        "dashboard_price_timeseries": _q("select * from dashboard_price_timeseries", TIMESERIES_DOUBLES),
        "feature_extract": _q(
            f"select {ts_cols} from dashboard_price_timeseries "
            "where symbol = 'BTCUSDT' and bar_interval = '1h' order by open_time_utc",
            TIMESERIES_DOUBLES,
        ),
        "dashboard_daily_summary": _q(
            "select * from dashboard_daily_summary",
            ["daily_open", "daily_high", "daily_low", "daily_close", "daily_volume", "daily_return",
             "average_hourly_return", "average_rolling_volatility_24h"],
        ),
        "dashboard_data_status": _q("select * from dashboard_data_status", ["full_24h_window_ratio"]),
        "latest_status": _q(
            "select symbol, bar_interval, total_bars, total_market_days, first_market_bar_utc, "
            "latest_market_bar_utc, latest_loaded_at, hours_since_latest_market_bar, hours_since_latest_load, "
            "full_24h_window_ratio from dashboard_data_status order by symbol, bar_interval",
            ["full_24h_window_ratio"],
        ),
        "data_coverage_by_day": _q(_COVERAGE_BODY),
        "data_contract_check": _q(
            "select symbol, bar_interval, count(*) as rows_count, min(open_time_utc) as first_open_time_utc, "
            "max(open_time_utc) as latest_open_time_utc, "
            "count(*) filter (where close is null) as null_close_count, "
            "count(*) filter (where volume is null) as null_volume_count, "
            "count(*) filter (where return_1h is null) as null_return_1h_count, "
            "count(*) filter (where rolling_window_observations_24h = 24) as full_rolling_window_rows, "
            "(count(*) filter (where rolling_window_observations_24h = 24)) / nullif(count(*), 0) "
            "as full_rolling_window_ratio "
            "from dashboard_price_timeseries group by symbol, bar_interval",
            ["full_rolling_window_ratio"],
        ),
        "validate_raw": _q(
            "select symbol, \"interval\", count(*) as rows_count, min(open_time_utc) as min_open_time, "
            "max(open_time_utc) as max_open_time from raw_klines group by symbol, \"interval\""
        ),
        "validate_marts": _q(
            "select symbol, bar_interval, count(*) as rows_count, "
            "count(*) filter (where return_1h is not null) as non_null_return_1h, "
            "count(*) filter (where log_return_1h is not null) as non_null_log_return_1h, "
            "count(*) filter (where rolling_window_observations_24h = 24) as full_24h_windows, "
            "min(open_time_utc) as min_open_time, max(open_time_utc) as max_open_time "
            "from fact_price_features group by symbol, bar_interval"
        ),
        "usage_last_7_days": _q(
            "select cast(creation_time as date) as usage_date, user_email, count(*) as query_jobs, "
            f"round(sum(total_bytes_processed) / {mib}, 2) as processed_mib, "
            f"round(sum(total_bytes_billed) / {mib}, 2) as billed_mib, "
            f"round(sum(total_bytes_billed) / {tib}, 6) as billed_tib "
            f"from jobs where {usage_where} group by usage_date, user_email "
            "order by usage_date desc, billed_mib desc"
        ),
        "usage_by_day": _q(
            "select cast(creation_time as date) as usage_date, count(*) as query_jobs, "
            f"round(sum(total_bytes_processed) / {mib}, 2) as processed_mib, "
            f"round(sum(total_bytes_billed) / {mib}, 2) as billed_mib, "
            f"round(sum(total_bytes_billed) / {tib}, 6) as billed_tib "
            f"from jobs where {usage_where} group by usage_date order by usage_date desc"
        ),
        "source_freshness": _q(
            "select max(loaded_at) as max_loaded_at, timestamp '2024-02-03 00:00:00' as snapshotted_at, "
            "(epoch_us(timestamp '2024-02-03 00:00:00') - epoch_us(max(loaded_at))) / 1e6 "
            "as max_loaded_at_time_ago_in_s, "
            "date_sub('hour', max(loaded_at), timestamp '2024-02-03 00:00:00') as hours_since_load, "
            "case when max(loaded_at) is null then 'error' "
            "when (epoch_us(timestamp '2024-02-03 00:00:00') - epoch_us(max(loaded_at))) / 1e6 > 30 * 86400 "
            "then 'error' "
            "when (epoch_us(timestamp '2024-02-03 00:00:00') - epoch_us(max(loaded_at))) / 1e6 > 7 * 86400 "
            "then 'warn' else 'pass' end as status from raw_klines",
            ["max_loaded_at_time_ago_in_s"],
        ),
        "check_not_null": _q(
            f"select column_name, violations from ({_not_null_sql('klines_dirty', STG_NOT_NULL)}) "
            "where violations > 0"
        ),
        "check_unique": _q(
            "select open_time_utc, count(*) as row_count from stg_klines where open_time_utc is not null "
            "group by open_time_utc having count(*) > 1"
        ),
        "check_accepted_values": _q(
            "select symbol as value_field, count(*) as n_records from klines_dirty "
            f"where symbol not in ({_in(SYMBOLS)}) group by symbol"
        ),
        "check_relationships_symbol": _q(
            "select c.symbol as from_field from klines_dirty c where c.symbol is not null "
            "and not exists (select 1 from dim_symbol p where p.symbol = c.symbol)"
        ),
        "check_relationships_calendar": _q(
            "select c.open_date as from_field from fact_price_features c where c.open_date is not null "
            "and not exists (select 1 from dim_calendar p where p.calendar_date = c.open_date "
            "and p.calendar_date <= date '2024-01-25')"
        ),
        "check_unique_natural_key": _q(
            "select symbol, bar_interval, open_time_utc, count(*) as row_count from stg_klines "
            "group by symbol, bar_interval, open_time_utc having count(*) > 1"
        ),
        "check_no_negative_volume": _q(
            "select * from klines_dirty where volume < 0 or quote_asset_volume < 0", _DIRTY_DOUBLES
        ),
        "check_ohlc_consistency": _q(
            "select * from klines_dirty where open is not null and close is not null "
            "and (high < greatest(open, close) or low > least(open, close))",
            _DIRTY_DOUBLES,
        ),
        "check_no_hourly_gaps": _q(_GAPS_BODY),
        "check_first_return_null": _q(
            f"select * exclude (rn), cast(rn as bigint) as row_number_ascending from ("
            f"select *, row_number() over ({_W}) as rn from features_tampered) "
            "where rn = 1 and return_1h is not null",
            FEATURE_DOUBLES,
        ),
        "check_log_return_consistency": _q(
            "select * from features_tampered where return_1h is not null "
            "and abs(log_return_1h - ln(1 + return_1h)) > 0.000000001",
            FEATURE_DOUBLES,
        ),
        "check_valid_ranges": _q(
            "select * from features_tampered where price_range < 0 or price_range_pct < 0 "
            "or body_size_pct < 0 or rolling_window_observations_24h < 1 "
            "or rolling_window_observations_24h > 24",
            FEATURE_DOUBLES,
        ),
        "check_summary": _q(_summary_sql()),
        "merge_fact_prices": _q(
            "select * from merge_target t where not exists (select 1 from merge_source s "
            "where s.symbol = t.symbol and s.bar_interval = t.bar_interval and s.open_time_utc = t.open_time_utc) "
            "union all select * from merge_source",
            RAW_DOUBLES,
        ),
        "merge_full_refresh": _q("select * from fact_prices", RAW_DOUBLES),
    }
    return q
