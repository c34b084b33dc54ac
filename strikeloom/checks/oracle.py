"""The registered queries as SQL over the same tables, to compare results with."""

# Every query starts from the quotes and silver rows derived here.
QUOTES = r"""
WITH base AS (
    SELECT *, date '2025-01-01' + cast(l_orderkey % 40 AS int) AS d FROM lineitem
),
dated AS (
    SELECT *, d + CASE l_orderkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 7 ELSE 30 END AS e FROM base
),
quotes AS (
    SELECT
        cast((d - date '1970-01-01') * 86400 + 52260 + l_partkey % 390 * 60 AS bigint)
            AS ts_recv_epoch,
        cast(l_orderkey AS varchar) AS instrument_id,
        CASE WHEN l_tax = 0.08 THEN 0.0::double ELSE l_quantity END AS bid_px_00,
        l_quantity + l_discount AS ask_px_00,
        cast(l_quantity AS int) AS bid_sz_00,
        cast(l_linenumber AS int) AS ask_sz_00,
        cast(NULL AS bigint) AS ts_event_epoch, 193 AS rtype, 30 AS publisher_id, 'N' AS side,
        cast(NULL AS double) AS price, 0 AS size, 200 AS flags, 0 AS bid_pb_00, 0 AS ask_pb_00,
        'opra-pillar-' || strftime(d, '%Y%m%d') AS file_stem,
        rpad(CASE WHEN l_quantity = 50 AND l_discount = 0.1 THEN 'VIX'
                  WHEN l_suppkey % 6 = 0 THEN 'SPX' WHEN l_suppkey % 6 = 1 THEN 'SPXW'
                  WHEN l_suppkey % 6 = 2 THEN 'NDX' WHEN l_suppkey % 6 = 3 THEN 'RUT'
                  WHEN l_suppkey % 6 = 4 THEN 'AAPL' ELSE 'MSFT' END, 6, ' ')
            || strftime(e, '%y%m%d')
            || CASE WHEN l_linenumber % 2 = 0 THEN 'C' ELSE 'P' END
            || lpad(cast((1000 + (l_partkey % 20) * 25) * 100 AS varchar), 8, '0') AS symbol,
        'opra-pillar-' || strftime(d, '%Y%m%d') || '.cbbo-1m.csv' AS file_name
    FROM dated
),
parsed AS (
    SELECT
        *,
        trim(substr(symbol, 1, 6)) AS root,
        try_strptime(regexp_extract(file_name, '(\d{8})', 1), '%Y%m%d')::date AS trade_date,
        try_strptime('20' || substr(symbol, 7, 6), '%Y%m%d')::date AS expiry_date,
        CASE WHEN substr(symbol, 13, 1) = 'C' THEN 'CALL' ELSE 'PUT' END AS option_type,
        cast(try_cast(substr(symbol, 14, 8) AS decimal(10, 2)) AS double) / 1000 AS strike_price,
        cast(cast(bid_px_00 AS decimal(10, 2)) + cast(ask_px_00 AS decimal(10, 2))
            AS decimal(12, 2)) AS two_mid
    FROM quotes
),
silver AS (
    SELECT
        *,
        CASE root WHEN 'SPX' THEN 'SPY' WHEN 'SPXW' THEN 'SPY' WHEN 'NDX' THEN 'QQQ'
                  WHEN 'NDXP' THEN 'QQQ' WHEN 'RUT' THEN 'IWM' WHEN 'RUTW' THEN 'IWM'
                  WHEN 'DJX' THEN 'DIA' WHEN 'VIX' THEN 'VXX' ELSE root END AS underlying,
        cast(two_mid AS double) / 2 AS mid_price
    FROM parsed
)
"""

WINDOWED = """,
recent AS (
    SELECT * FROM silver
    WHERE trade_date >= (SELECT max(trade_date) FROM silver) - {days}
)
"""

CONDOR = """,
strikes AS (
    SELECT underlying, trade_date, expiry_date, option_type, strike_price,
           cast(sum(two_mid) AS double) / 2 / count(two_mid) AS mid_price
    FROM {rows}
    WHERE two_mid IS NOT NULL AND strike_price IS NOT NULL
    GROUP BY ALL
),
ranked AS (
    SELECT *, cast(dense_rank() OVER (
        PARTITION BY underlying, trade_date, expiry_date, option_type
        ORDER BY CASE WHEN option_type = 'CALL' THEN -strike_price ELSE strike_price END
    ) AS int) AS strike_rank
    FROM strikes
),
leg AS (SELECT * FROM ranked WHERE strike_rank <= 2),
condor AS (
    SELECT
        sc.underlying, sc.trade_date, sc.expiry_date AS expiration,
        sc.strike_price AS strike_short_call, sc.mid_price AS price_short_call,
        lc.strike_price AS strike_long_call, lc.mid_price AS price_long_call,
        sp.strike_price AS strike_short_put, sp.mid_price AS price_short_put,
        lp.strike_price AS strike_long_put, lp.mid_price AS price_long_put,
        round_even(((sp.mid_price + sc.mid_price) - (lp.mid_price + lc.mid_price)) * 100, 0) / 100
            AS net_credit,
        'IRON_CONDOR' AS strategy_name
    FROM (SELECT * FROM leg WHERE option_type = 'CALL' AND strike_rank = 1) sc
    JOIN (SELECT * FROM leg WHERE option_type = 'CALL' AND strike_rank = 2) lc
        USING (underlying, trade_date, expiry_date)
    JOIN (SELECT * FROM leg WHERE option_type = 'PUT' AND strike_rank = 1) sp
        USING (underlying, trade_date, expiry_date)
    JOIN (SELECT * FROM leg WHERE option_type = 'PUT' AND strike_rank = 2) lp
        USING (underlying, trade_date, expiry_date)
)
"""

SIGNALS = """,
signals AS (
    SELECT
        symbol, trade_date, expiry_date, strike_price, mid_price, option_type,
        CASE WHEN option_type = 'CALL' AND mid_price < 5 THEN 'BUY_CALL'
             WHEN option_type = 'PUT' AND mid_price < 5 THEN 'BUY_PUT' ELSE 'HOLD' END AS signal,
        'LAYMAN_SPY' AS strategy_name,
        underlying AS own_underlying
    FROM recent
)
"""

COUNTS = """,
counts AS (
    SELECT underlying, trade_date, expiry_date,
           count(DISTINCT strike_price) FILTER (option_type = 'CALL') AS num_calls,
           count(DISTINCT strike_price) FILTER (option_type = 'PUT') AS num_puts
    FROM silver
    GROUP BY underlying, trade_date, expiry_date
)
"""

BARS = """
WITH bars AS (
    SELECT
        cast((cast(l_shipdate AS date) - date '1970-01-01') * 86400000::bigint AS varchar)
            AS timestamp,
        'O:S' || l_suppkey AS symbol,
        max(l_extendedprice) AS close,
        sum(l_quantity) AS volume
    FROM lineitem
    WHERE l_suppkey % 10 <> 0
    GROUP BY cast(l_shipdate AS date), l_suppkey
)
"""

ALL_CONDORS = QUOTES + CONDOR.format(rows="silver")
RECENT_CONDORS = QUOTES + WINDOWED.format(days=30) + CONDOR.format(rows="recent")
RECENT_SIGNALS = QUOTES + WINDOWED.format(days=3) + SIGNALS

UNTOUCHED = """
    ts_recv_epoch, ts_event_epoch, rtype, publisher_id, instrument_id, side, price, size, flags,
    bid_px_00, ask_px_00, bid_sz_00, ask_sz_00, bid_pb_00, ask_pb_00, file_stem
"""
QUOTE_ROWS = f"SELECT {UNTOUCHED}, symbol, trade_date FROM parsed"
SILVER_ROWS = f"""
SELECT symbol, underlying, trade_date, expiry_date, option_type, strike_price, mid_price,
       {UNTOUCHED}
FROM silver
"""
CONTRACT_ROWS = """
SELECT symbol, underlying, trade_date, expiry_date, bid_px_00, ask_px_00, mid_price FROM {rows}
"""
STRIKE_ROWS = "SELECT underlying, trade_date, expiry_date, option_type, strike_price, mid_price"
COVERAGE = "SELECT trade_date, count(*) AS row_count FROM silver GROUP BY trade_date"
SIGNAL_COLUMNS = (
    "symbol, trade_date, expiry_date, strike_price, mid_price, option_type, signal, strategy_name"
)

# A quote's text, hashed once; both layers hold the same quotes.
DIGESTS = """, hashed AS (
    SELECT trade_date, md5(concat_ws(chr(31),
        {texts})) AS h
    FROM parsed
), halves AS (
    SELECT trade_date, cast('0x' || substr(h, 1, 15) AS bigint) AS a,
           cast('0x' || substr(h, 16, 15) AS bigint) AS b
    FROM hashed
), kept AS (
    SELECT trade_date, count(*) AS row_count, bit_xor(a) AS hash_xor,
           cast(sum(a) AS varchar) AS hash_sum, cast(sum(b) AS varchar) AS other_sum
    FROM halves GROUP BY trade_date
)
SELECT 'bronze' AS layer, * FROM kept UNION ALL SELECT 'silver', * FROM kept
""".format(
    texts=",\n        ".join(
        f"coalesce(cast({value} AS varchar), chr(30))"
        for value in (
            "ts_recv_epoch * 1000000", "ts_event_epoch * 1000000", "rtype", "publisher_id",
            "instrument_id", "side", "cast(price AS decimal(20,6))", "size", "flags",
            "cast(bid_px_00 AS decimal(20,6))", "cast(ask_px_00 AS decimal(20,6))", "bid_sz_00",
            "ask_sz_00", "bid_pb_00", "ask_pb_00", "symbol",
        )
    )
)

SQL = {
    "iron_condor": RECENT_CONDORS + "SELECT * FROM condor",
    "iron_condor_all": ALL_CONDORS + "SELECT * FROM condor",
    "iron_condor_joins": ALL_CONDORS + "SELECT * FROM condor",
    "silver_enriched": QUOTES + SILVER_ROWS,
    "osi_decompose": QUOTES
    + "SELECT symbol, root, expiry_date, option_type, strike_price FROM parsed",
    "trade_date_from_file": QUOTES
    + "SELECT file_name, trade_date, count(*) AS row_count FROM parsed GROUP BY ALL",
    "mid_price": QUOTES + "SELECT bid_px_00, ask_px_00, mid_price FROM silver",
    "underlying_map": QUOTES + "SELECT symbol, underlying FROM silver",
    "underlying_map_join": QUOTES
    + """, map(root, mapped) AS (
        VALUES ('SPX', 'SPY'), ('SPXW', 'SPY'), ('NDX', 'QQQ'), ('NDXP', 'QQQ'),
               ('RUT', 'IWM'), ('RUTW', 'IWM'), ('DJX', 'DIA'), ('VIX', 'VXX')
    )
    SELECT symbol, coalesce(mapped, root) AS underlying FROM parsed LEFT JOIN map USING (root)""",
    "strategy_projection": QUOTES + STRIKE_ROWS + " FROM silver",
    "filter_zero_dte": QUOTES + CONTRACT_ROWS.format(rows="silver WHERE trade_date = expiry_date"),
    "filter_liquidity": QUOTES
    + CONTRACT_ROWS.format(rows="silver WHERE bid_px_00 > 0 AND ask_px_00 > 0"),
    "filter_chain": QUOTES
    + CONTRACT_ROWS.format(
        rows="silver WHERE trade_date = expiry_date AND bid_px_00 > 0 AND ask_px_00 > 0"
    ),
    "lookback_3d": QUOTES + WINDOWED.format(days=3) + CONTRACT_ROWS.format(rows="recent"),
    "lookback_30d": QUOTES + WINDOWED.format(days=30) + CONTRACT_ROWS.format(rows="recent"),
    "max_trade_date": QUOTES + "SELECT max(trade_date) AS max_trade_date FROM silver",
    "newest_stored_date": QUOTES + COVERAGE + " ORDER BY trade_date DESC LIMIT 1",
    "threshold_signals": RECENT_SIGNALS
    + f"SELECT {SIGNAL_COLUMNS}, 'SPY' AS underlying FROM signals",
    "threshold_signals_own": RECENT_SIGNALS
    + f"SELECT {SIGNAL_COLUMNS}, 'QQQ' AS underlying FROM signals WHERE own_underlying = 'QQQ'",
    "condor_dedup": ALL_CONDORS + STRIKE_ROWS + " FROM strikes",
    "condor_strike_rank": ALL_CONDORS + STRIKE_ROWS + ", strike_rank FROM ranked",
    "condor_legs": ALL_CONDORS + STRIKE_ROWS + ", strike_rank FROM leg",
    "condor_valid_groups": QUOTES
    + COUNTS
    + "SELECT * FROM counts WHERE num_calls >= 2 AND num_puts >= 2",
    "condor_valid_rows": QUOTES
    + COUNTS
    + CONDOR.format(rows="silver")
    + STRIKE_ROWS
    + """ FROM strikes WHERE (underlying, trade_date, expiry_date) IN (
        SELECT (underlying, trade_date, expiry_date) FROM counts
        WHERE num_calls >= 2 AND num_puts >= 2
    )""",
    "custom_strategy_pandas": ALL_CONDORS
    + """SELECT underlying, trade_date, expiry_date, count(*) AS strikes,
                max(strike_price) - min(strike_price) AS width
         FROM strikes GROUP BY underlying, trade_date, expiry_date""",
    "custom_strategy_batches": QUOTES
    + "SELECT symbol, trade_date, ask_px_00 - bid_px_00 > 1 AS wide FROM silver",
    "custom_strategy_columns": QUOTES
    + WINDOWED.format(days=30)
    + """, strike_rows AS (
        SELECT underlying, trade_date, expiry_date, option_type, strike_price,
               min(bid_px_00) AS low_bid, max(ask_px_00) AS high_ask,
               max_by(bid_px_00, {t: ts_recv_epoch, v: bid_px_00}) AS last_bid,
               sum(ask_sz_00) AS asked
        FROM recent WHERE two_mid IS NOT NULL GROUP BY ALL
    )
    SELECT underlying, trade_date, expiry_date, min(low_bid) AS lowest_bid,
           max(high_ask) AS highest_ask, sum(last_bid) AS closing_bids,
           cast(sum(asked) AS bigint) AS asked
    FROM strike_rows GROUP BY underlying, trade_date, expiry_date""",
    "strategies_run": RECENT_CONDORS
    + """, cheap AS (
        SELECT * FROM silver WHERE trade_date >= (SELECT max(trade_date) FROM silver) - 3
    )
    SELECT 'LaymanSPYStrategy' AS layer, true AS succeeded, count(*) AS row_count FROM cheap
    UNION ALL SELECT 'LaymanQQQStrategy', true, count(*) FROM cheap
    UNION ALL SELECT 'IronCondorStrategy', true, count(*) FROM condor
    UNION ALL SELECT 'FailingStrategy', false, NULL""",
    "coverage_maintained": QUOTES + COVERAGE + " ORDER BY trade_date DESC",
    "layer_digests": QUOTES + DIGESTS,
    "option_type_counts": QUOTES
    + "SELECT option_type, count(*) AS row_count FROM silver GROUP BY option_type",
    "distinct_underlying": QUOTES + "SELECT DISTINCT underlying FROM silver",
    "signal_distribution": RECENT_SIGNALS
    + """SELECT trade_date, signal, count(*) AS row_count FROM signals
         GROUP BY trade_date, signal ORDER BY trade_date DESC, signal""",
    "date_coverage": QUOTES + COVERAGE + " ORDER BY trade_date DESC",
    "latest_dates": QUOTES
    + "SELECT DISTINCT trade_date FROM silver ORDER BY trade_date DESC LIMIT 5",
    "layer_counts": QUOTES
    + """SELECT 'bronze' AS layer, count(*) AS row_count FROM quotes
         UNION ALL SELECT 'silver', count(*) FROM silver
         UNION ALL SELECT 'silver_liquid', count(*) FROM silver
                   WHERE bid_px_00 > 0 AND ask_px_00 > 0""",
    "range_profile": QUOTES
    + """SELECT count(*) AS row_count,
                min(ts_recv_epoch) AS ts_recv_epoch_min, max(ts_recv_epoch) AS ts_recv_epoch_max,
                count(ts_recv_epoch) AS ts_recv_epoch_count,
                count(*) - count(ts_recv_epoch) AS ts_recv_epoch_nulls,
                min(bid_px_00) AS bid_px_00_min, max(bid_px_00) AS bid_px_00_max,
                count(bid_px_00) AS bid_px_00_count,
                count(*) - count(bid_px_00) AS bid_px_00_nulls,
                min(ask_px_00) AS ask_px_00_min, max(ask_px_00) AS ask_px_00_max,
                count(ask_px_00) AS ask_px_00_count,
                count(*) - count(ask_px_00) AS ask_px_00_nulls,
                cast(NULL AS double) AS price_min, cast(NULL AS double) AS price_max,
                0::bigint AS price_count, count(*) AS price_nulls
         FROM quotes""",
    "range_profile_sketched": QUOTES
    + """, month AS (
        SELECT * FROM silver WHERE trade_date BETWEEN date '2025-01-05' AND date '2025-02-03'
    ), types AS (SELECT option_type, count(*) AS n FROM month GROUP BY option_type)
    SELECT count(*) AS row_count, count(bid_px_00) AS bid_px_00_count, 0::bigint AS price_count,
           min(bid_px_00) AS bid_px_00_min, max(ask_px_00) AS ask_px_00_max,
           """
    + ", ".join(
        f"true AS {name}_q{share}_near"
        for name in ("bid_px_00", "ask_px_00", "mid_price")
        for share in (25, 50, 95)
    )
    + """, true AS symbols_near,
           (SELECT option_type FROM types ORDER BY n DESC LIMIT 1) AS top_type,
           (SELECT max(n) FROM types) AS top_type_count, true AS price_unknown
    FROM month""",
    "gold_head": ALL_CONDORS
    + "SELECT * FROM condor ORDER BY trade_date, underlying, expiration LIMIT 10",
    "src_csv": QUOTES + QUOTE_ROWS,
    "src_csv_rejects": QUOTES
    + f"""SELECT {UNTOUCHED}, symbol, trade_date, false AS rejected
          FROM parsed WHERE bid_sz_00 <> 7
          UNION ALL BY NAME
          SELECT instrument_id, symbol, trade_date, true AS rejected
          FROM parsed WHERE bid_sz_00 = 7""",
    "src_file_name": QUOTES
    + """SELECT split_part(file_name, '.', 1) AS file_stem, count(*) AS row_count,
                min(symbol) AS first_symbol
         FROM quotes GROUP BY ALL""",
    "src_parquet": QUOTES + QUOTE_ROWS,
    "bars_normalised": BARS + "SELECT * FROM bars",
    "bars_range": BARS
    + """SELECT * FROM bars WHERE symbol = 'O:S3'
         AND cast(timestamp AS bigint)
             BETWEEN (date '1995-01-01' - date '1970-01-01') * 86400000::bigint
             AND (date '1996-12-31' - date '1970-01-01') * 86400000::bigint""",
    "bars_requests": BARS
    + """, asked AS (
        SELECT 'own' || s_suppkey AS request_id, 'O:S' || s_suppkey AS symbol,
               CASE WHEN s_suppkey % 7 <> 0
                    THEN date '1992-01-01' + cast(s_suppkey * 37 % 2000 AS int) END AS start_date,
               CASE WHEN s_suppkey % 5 <> 0
                    THEN date '1992-01-01' + cast(s_suppkey * 37 % 2000 AS int)
                         + cast(s_suppkey * 53 % 400 - 20 AS int) END AS end_date
        FROM supplier
        UNION ALL
        SELECT 'hot' || s_suppkey, 'O:S3', date '1992-01-01' + cast(s_suppkey * 37 % 2000 AS int),
               date '1992-01-01' + cast(s_suppkey * 37 % 2000 AS int) + 365
        FROM supplier
    )
    SELECT request_id, bars.* FROM bars JOIN asked USING (symbol)
    WHERE (start_date IS NULL
           OR cast(timestamp AS bigint) >= (start_date - date '1970-01-01') * 86400000::bigint)
      AND (end_date IS NULL
           OR cast(timestamp AS bigint) <= (end_date - date '1970-01-01') * 86400000::bigint)""",
    "bronze_bootstrap": QUOTES + QUOTE_ROWS,
    "bronze_incremental": QUOTES + QUOTE_ROWS,
    "silver_incremental": QUOTES + SILVER_ROWS,
    "reprocess_idempotent": QUOTES + SILVER_ROWS,
    "same_name_files": QUOTES + SILVER_ROWS,
    "parquet_reordered": QUOTES + SILVER_ROWS,
    "bootstrap_twice": QUOTES + SILVER_ROWS,
    "stream_intake": QUOTES + SILVER_ROWS,
    "stream_many_files_per_date": QUOTES + SILVER_ROWS,
    "load_resumed": QUOTES + SILVER_ROWS,
    "gold_roundtrip": ALL_CONDORS + "SELECT * FROM condor",
    "materialized_slice": QUOTES
    + CONTRACT_ROWS.format(
        rows="silver WHERE underlying = 'SPY' AND option_type = 'CALL' AND mid_price < 5"
    ),
    "clustered_slice": QUOTES
    + CONTRACT_ROWS.format(
        rows="silver WHERE mid_price >= 5 AND strike_price BETWEEN 110 AND 125"
    ),
    "compact_preserves_rows": QUOTES + SILVER_ROWS,
    "compact_stored_silver": QUOTES + SILVER_ROWS,
    "ddl_roundtrip": QUOTES + COVERAGE,
}
SQL["strategies_shared_scan"] = SQL["strategies_run"]
SQL["strategy_from_sql"] = SQL["iron_condor"]
SQL["strategy_chain_function"] = SQL["custom_strategy_pandas"]
SQL["bars_loaded"] = SQL["bars_normalised"]
