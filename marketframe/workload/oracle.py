"""Equivalent SQL for every registered query, in the dialect of the checking database."""

from __future__ import annotations

from marketframe import constants as C
from marketframe import schemas as S


def rnd(expr: str, digits: int) -> str:
    """One half-up rounding; what lies below a tie by the noise of a sum of doubles counts as the tie. No negative zero."""
    return f"(round(CAST({expr} AS DOUBLE) * (1 + 1e-13), {digits}) + 0.0)"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(dict.fromkeys(p.strip() for p in parts)) + "\n"


def _groups(*numbers: int) -> str:
    return ", ".join(f"'Brand#{n}'" for n in numbers)


LEFT, RIGHT = _groups(1, 6, 11, 16, 21), _groups(2, 7, 12, 17, 22)
STAMP = "'2024-02-01T00:00:00'"

PRICES = """
prices AS (
  SELECT p_brand AS symbol, last_day(CAST(l_shipdate AS DATE)) AS date,
         sum(l_extendedprice) / sum(l_quantity) AS close, CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)"""
PART_PRICES = """
part_prices AS (
  SELECT 'P' || l_partkey AS symbol, last_day(CAST(l_shipdate AS DATE)) AS date,
         sum(l_extendedprice) / sum(l_quantity) AS close
  FROM lineitem GROUP BY 1, 2)"""
MARKET = """
market AS (
  SELECT last_day(CAST(l_shipdate AS DATE)) AS date, sum(l_extendedprice) / sum(l_quantity) AS close
  FROM lineitem GROUP BY 1)"""
RETURNS = """
returns AS (
  SELECT * FROM (
    SELECT symbol, date, close, close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1.0 AS ret FROM prices)
  WHERE ret IS NOT NULL)"""
PART_RETURNS = """
part_returns AS (
  SELECT * FROM (
    SELECT symbol, date AS month, close / lag(close) OVER (PARTITION BY symbol ORDER BY date) - 1.0 AS ret
    FROM part_prices)
  WHERE ret IS NOT NULL)"""
SECURITY = """
security AS (
  SELECT symbol, ['Infrastructure', 'AI Builder', 'AI Integrator', 'Control', 'Legacy Tech'][pos % 5 + 1] AS category,
         'strategy ' || pos AS ai_strategy, pos
  FROM (SELECT DISTINCT p_brand AS symbol, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS pos FROM part))"""
SPEND = f"""
all_spend AS (
  SELECT p_brand AS symbol, {rnd('sum(p_retailprice) / 1e4', 1)} AS capex_2025_B,
         {rnd('sum(p_retailprice) * 1.5::DOUBLE / 1e4', 1)} AS capex_2026_B,
         CAST(sum(p_size) % 90 + 10 AS INTEGER) AS ai_pct,
         {rnd('sum(p_retailprice) * 4 / 1e4', 1)} AS revenue_2025_B
  FROM part GROUP BY 1),
spend AS (
  SELECT * FROM all_spend WHERE symbol IN (SELECT p_brand FROM part GROUP BY 1 HAVING sum(p_size) % 2 = 1))"""
MACRO = """
macro_lines AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, avg(l_extendedprice) / 200 AS cpi,
         avg(l_discount) * 100 AS unrate, avg(l_tax) * 100 AS fedfunds
  FROM lineitem GROUP BY 1),
macro AS (
  SELECT *, 'about ' || series_id AS description,
         CASE WHEN series_id = 'CPIAUCSL' THEN 'index_1982' ELSE 'percent' END AS units,
         CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month
  FROM (
    SELECT 'GS10' AS series_id, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
           avg(o_totalprice) / 50000 AS value FROM orders GROUP BY 2
    UNION ALL SELECT 'CPIAUCSL', date, cpi FROM macro_lines
    UNION ALL SELECT 'UNRATE', date, unrate FROM macro_lines
    UNION ALL SELECT 'FEDFUNDS', date, fedfunds FROM macro_lines))"""
RATE = """
rate AS (
  SELECT coalesce(avg(value) / 100, 0.045::DOUBLE) AS rf FROM macro
  WHERE series_id = 'FEDFUNDS' AND year BETWEEN 1996 AND 2000)"""
METRICS = f"""
peaks AS (
  SELECT *, close / lag(close) OVER w - 1.0 AS ret, max(close) OVER w AS peak FROM prices
  WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
raw_metrics AS (
  SELECT symbol, power(1.0::DOUBLE + avg(ret), 12) - 1 AS ann_return, stddev_samp(ret) * sqrt(12::DOUBLE) AS ann_vol,
         CASE WHEN count(close) < 2 THEN 0.0 ELSE min((close - peak) / peak) END AS dd,
         count(ret) AS months_analyzed, min(date) AS first_date, max(date) AS last_date
  FROM peaks GROUP BY 1 HAVING count(ret) >= 12),
metrics AS (
  SELECT m.symbol, s.category, s.ai_strategy,
         {rnd('ann_return * 100', 2)} AS annualized_return, {rnd('ann_vol * 100', 2)} AS annualized_volatility,
         {rnd('CASE WHEN ann_vol > 0 THEN (ann_return - rf) / ann_vol ELSE 0.0 END', 3)} AS sharpe_ratio,
         {rnd('dd * 100', 2)} AS max_drawdown, months_analyzed,
         strftime(first_date, '%Y-%m-%d') AS start_date, strftime(last_date, '%Y-%m-%d') AS end_date,
         p.capex_2025_B, p.capex_2026_B, p.ai_pct AS ai_pct_of_capex,
         {rnd('p.capex_2026_B * p.ai_pct / 100', 1)} AS est_ai_spend_2026_B
  FROM raw_metrics m CROSS JOIN rate LEFT JOIN security s ON s.symbol = m.symbol
  LEFT JOIN spend p ON p.symbol = m.symbol)"""
METRIC_PARTS = (PRICES, MACRO, RATE, SECURITY, SPEND, METRICS)
EXCESS = "CASE WHEN sd > 0 THEN (mean - {rf} / 12) / sd * sqrt(12::DOUBLE) ELSE 0.0 END"


def _moments(source: str, order: str) -> str:
    return f"""
      SELECT *, count(ret) OVER w AS n_obs, avg(ret) OVER w AS mean, stddev_samp(ret) OVER w AS sd FROM {source}
      WINDOW w AS (PARTITION BY symbol ORDER BY {order} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"""


ROLLING = f"""
rolling AS (
  SELECT symbol, date, {rnd(EXCESS.format(rf='rf'), 3)} AS rolling_sharpe_12m
  FROM ({_moments('returns', 'date')}) CROSS JOIN rate WHERE n_obs = 12)"""
ROLLING_PARTS = (PRICES, MACRO, RATE, RETURNS, ROLLING)

EFFICIENCY = f"""
efficiency AS (
  SELECT m.symbol, m.category, m.sharpe_ratio AS sharpe, p.capex_2026_B AS total_capex_2026, p.ai_pct,
         {rnd('p.capex_2026_B * p.ai_pct / 100', 1)} AS ai_spend_2026,
         {rnd('p.capex_2026_B / p.revenue_2025_B * 100', 1)} AS capex_to_revenue_pct,
         CASE WHEN p.capex_2026_B * p.ai_pct > 0
              THEN m.sharpe_ratio / (p.capex_2026_B * p.ai_pct / 100) * 100 ELSE 0.0 END AS eff
  FROM metrics m JOIN all_spend p ON p.symbol = m.symbol)"""
EFFICIENCY_PARTS = (*METRIC_PARTS, EFFICIENCY)

PREMIUM = f"""
sides AS (
  SELECT avg(sharpe_ratio) FILTER (category = 'AI Builder') AS ls, avg(sharpe_ratio) FILTER (category = 'AI Integrator') AS rs,
         avg(annualized_return) FILTER (category = 'AI Builder') AS lr,
         avg(annualized_return) FILTER (category = 'AI Integrator') AS rr,
         avg(annualized_volatility) FILTER (category = 'AI Builder') AS lv,
         avg(annualized_volatility) FILTER (category = 'AI Integrator') AS rv
  FROM metrics),
premium AS (
  SELECT {rnd('ls', 6)} AS left_sharpe, {rnd('rs', 6)} AS right_sharpe,
         {rnd('CASE WHEN rs <> 0 THEN (ls - rs) / abs(rs) * 100 ELSE 0.0 END', 1)} AS premium_pct,
         {rnd('lr', 6)} AS left_return, {rnd('rr', 6)} AS right_return, {rnd('lr - rr', 6)} AS return_gap,
         {rnd('lv', 6)} AS left_vol, {rnd('rv', 6)} AS right_vol, {rnd('lv - rv', 6)} AS vol_gap
  FROM sides WHERE ls IS NOT NULL AND rs IS NOT NULL)"""

PIVOT = """
wide AS (
  SELECT date, max(value) FILTER (series_id = 'GS10') AS GS10, max(value) FILTER (series_id = 'CPIAUCSL') AS CPIAUCSL,
         max(value) FILTER (series_id = 'UNRATE') AS UNRATE, max(value) FILTER (series_id = 'FEDFUNDS') AS FEDFUNDS
  FROM macro GROUP BY 1)"""
REGIMES = """
labelled AS (
  SELECT date, last_day(date) AS month,
         CASE WHEN GS10 > CASE WHEN count(GS10) OVER r >= 6 THEN avg(GS10) OVER r END THEN 'rising' ELSE 'falling' END AS rate_regime,
         CASE WHEN (CPIAUCSL / lag(CPIAUCSL, 12) OVER (ORDER BY date) - 1.0) * 100 > 0.5 THEN 'high' ELSE 'normal' END AS inflation_regime,
         CASE WHEN UNRATE > 5.0 THEN 'elevated' ELSE 'normal' END AS unemployment_regime,
         FEDFUNDS AS fedfunds
  FROM wide WINDOW r AS (ORDER BY date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)),
regimes AS (SELECT *, rate_regime || '_' || inflation_regime || '_' || unemployment_regime AS combined_regime FROM labelled)"""


def _asof(returns: str, name: str) -> str:
    """The latest full window at or before each spine month, by an as-of join."""
    value = EXCESS.format(rf="(fedfunds / 100)")
    return f"""
{name}_spine AS (SELECT * FROM regimes WHERE month IN (SELECT month FROM {returns})),
{name}_moments AS ({_moments(returns, 'month')}),
{name} AS (
  SELECT g.symbol, g.month, CASE WHEN n_obs = 12 THEN CASE WHEN fedfunds IS NULL THEN 0.0 ELSE {value} END END AS sharpe
  FROM (SELECT symbol, month, fedfunds FROM (SELECT DISTINCT symbol FROM {returns}) CROSS JOIN {name}_spine) g
  ASOF LEFT JOIN {name}_moments m ON m.symbol = g.symbol AND m.month <= g.month)"""


GROUP_RETURNS = f"""
group_returns AS (
  SELECT symbol, date AS month, ret FROM returns WHERE symbol IN ({LEFT}, {RIGHT}))"""
PANEL = f"""
averages AS (
  SELECT month, avg(sharpe) FILTER (symbol IN ({LEFT})) AS b, avg(sharpe) FILTER (symbol IN ({RIGHT})) AS i
  FROM group_sharpe GROUP BY 1),
panel AS (
  SELECT s.month, rate_regime, inflation_regime, unemployment_regime, fedfunds, combined_regime,
         b AS avg_builder_sharpe, i AS avg_integrator_sharpe, b - i AS builder_premium
  FROM group_sharpe_spine s JOIN averages a ON a.month = s.month)"""
PANEL_PARTS = (
    PRICES, RETURNS, MACRO, PIVOT, REGIMES, GROUP_RETURNS, _asof("group_returns", "group_sharpe"), PANEL,
)
SUMMARY = f"""
summary AS (
  SELECT combined_regime, {rnd('avg(avg_builder_sharpe)', 3)} AS avg_builder_sharpe,
         {rnd('avg(avg_integrator_sharpe)', 3)} AS avg_integrator_sharpe,
         {rnd('avg(builder_premium)', 3)} AS builder_premium, count(month) AS n_months
  FROM panel WHERE avg_builder_sharpe IS NOT NULL AND avg_integrator_sharpe IS NOT NULL GROUP BY 1)"""
SUMMARY_PARTS = (*PANEL_PARTS, SUMMARY)

QUOTES = f"""
quotes0 AS (
  SELECT event_id AS quote_id, upper(event_type) || '-' || (user_id % 4) AS symbol, upper(event_type) AS kind,
         value AS price, value * 0.5::DOUBLE + CAST(props->>'$.k' AS INTEGER) / 10 AS previous_close,
         CAST(user_id * 1000 + CAST(props->>'$.k' AS INTEGER) AS BIGINT) AS volume,
         strftime(ts, '%Y-%m-%d') AS trading_day, ts
  FROM events),
quotes AS (
  SELECT *, price - previous_close AS change,
         CASE WHEN previous_close > 0 THEN {rnd('(price - previous_close) / previous_close * 100', 2)} ELSE 0.0 END AS change_percent
  FROM quotes0)"""
NEWEST = """
newest AS (
  SELECT * FROM quotes
  QUALIFY row_number() OVER (PARTITION BY symbol, trading_day ORDER BY ts DESC, quote_id DESC) = 1)"""
QUOTE_CATEGORY = """CASE split_part(symbol, '-', 1) WHEN 'CLICK' THEN 'Infrastructure' WHEN 'VIEW' THEN 'AI Builder'
  WHEN 'ERROR' THEN 'AI Integrator' WHEN 'PURCHASE' THEN 'Legacy Tech' ELSE 'Control' END"""

FILINGS = """
filings AS (
  SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, 'C' || o_custkey AS symbol, o_orderpriority AS tag, o_orderkey AS pos,
         CASE WHEN o_orderstatus = 'F' THEN 'Q3' ELSE 'FY' END AS fp, CASE WHEN o_orderstatus = 'P' THEN '10-Q' ELSE '10-K' END AS form,
         CAST(year(o_orderdate) AS INTEGER) AS fy, CAST(round(o_totalprice * 100) AS BIGINT) AS val,
         strftime(o_orderdate, '%Y-%m-%d') AS "end", strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%d') AS filed
  FROM orders),
annual AS (SELECT * FROM filings WHERE fp = 'FY' AND form = '10-K')"""
FUNDAMENTALS = """
tagged AS (SELECT *, CASE tag WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '5-LOW' THEN 3 END AS priority FROM annual),
chosen AS (
  SELECT * FROM tagged t WHERE priority = (SELECT min(priority) FROM tagged u WHERE u.cik = t.cik)),
revenue AS (SELECT cik, fy, arg_max(val, pos) AS revenue_usd FROM chosen GROUP BY 1, 2),
company_tag AS (SELECT cik, min(tag) AS revenue_tag FROM chosen GROUP BY 1),
records AS (
  SELECT a.cik, a.symbol, CAST(a.fy AS BIGINT) AS year, a.val AS capex_usd, r.revenue_usd, c.revenue_tag,
         a."end" AS period_end, a.filed
  FROM annual a LEFT JOIN revenue r ON r.cik = a.cik AND r.fy = a.fy LEFT JOIN company_tag c ON c.cik = a.cik
  WHERE a.tag = '1-URGENT' AND a.fy >= 1996)"""

COMPLETE = """
quote_files AS (
  SELECT CAST(ts AS DATE) AS day, 'part-' || (hour(ts) // 3) AS path, ts AS modified, symbol, price FROM newest),
per_file AS (SELECT day, path, max(modified) AS modified, count(*) AS n FROM quote_files GROUP BY 1, 2),
latest AS (SELECT * FROM per_file QUALIFY row_number() OVER (PARTITION BY day ORDER BY modified DESC, path DESC) = 1),
days AS (
  SELECT DISTINCT CAST(ts AS DATE) AS day FROM events
  UNION SELECT DISTINCT CAST(ts AS DATE) + 5 FROM events),
graded AS (
  SELECT d.day, isodow(d.day) <= 5 AS trading, l.n, l.path,
         CASE WHEN isodow(d.day) > 5 THEN 'OK' WHEN n IS NULL THEN 'WARNING' WHEN n = 18 THEN 'OK' ELSE 'ERROR' END AS status,
         CASE WHEN isodow(d.day) > 5 THEN dayname(d.day) || ' - non-trading day'
              WHEN n IS NULL THEN 'No data for ' || strftime(d.day, '%Y-%m-%d')
              WHEN n <> 18 THEN 'Expected 18 stocks, got ' || n END AS message
  FROM days d LEFT JOIN latest l ON l.day = d.day)"""
STALE = """
feeds AS (
  SELECT 'events' AS feed, 35 AS max_days, (SELECT max(ts) FROM events) AS newest,
         (SELECT count(DISTINCT CAST(ts AS DATE)) FROM events) AS partitions
  UNION ALL SELECT 'orders', 120, (SELECT max(o_orderdate) FROM orders), (SELECT count(DISTINCT CAST(o_orderdate AS DATE)) FROM orders)
  UNION ALL SELECT 'lineitem', 120, (SELECT max(l_shipdate) FROM lineitem), (SELECT count(DISTINCT CAST(l_shipdate AS DATE)) FROM lineitem)
  UNION ALL SELECT 'filings', 120, NULL, NULL),
aged AS (
  SELECT *, CAST(floor(date_diff('second', date_trunc('second', newest), TIMESTAMP '2024-02-15 12:00:00') / 86400) AS BIGINT) AS days_old FROM feeds),
stale AS (
  SELECT feed, CASE WHEN newest IS NULL OR days_old > max_days THEN 'WARNING' ELSE 'OK' END AS status,
         CASE WHEN newest IS NULL THEN 'No ' || feed || ' data found'
              WHEN days_old > max_days THEN 'Data is ' || days_old || ' days old (expected <=' || max_days || ')' END AS message,
         partitions, days_old AS days_since_update
  FROM aged)"""

ORACLES: dict[str, str] = {}


def _add(name: str, parts: tuple[str, ...], select: str) -> None:
    ORACLES[name] = (_with(*parts) if parts else "") + select.strip()


# --- landed documents ---------------------------------------------------------------------------

_add("quote_normalise", (QUOTES,), f"""
SELECT quote_id, symbol, price, CASE WHEN prev > 0 THEN {rnd('change / prev * 100', 2)} ELSE 0.0 END AS change_percent,
       volume, trading_day, {STAMP} AS timestamp, {rnd('prev', 6)} AS previous_close, {rnd('change', 6)} AS change
FROM (SELECT *, CASE WHEN volume % 10 > 0 THEN previous_close ELSE 0.0 END AS prev FROM quotes WHERE price >= 0.5)""")
_add("macro_parse", (MACRO,), f"""
SELECT series_id, description, units, strftime(date, '%Y-%m-%d') AS date, year, month, {rnd('value', 6)} AS value,
       {STAMP} AS extracted_at
FROM macro WHERE NOT (series_id = 'UNRATE' AND value < 5.0)""")
_add("macro_missing_counts", (MACRO,), """
SELECT series_id, count(*) FILTER (NOT (series_id = 'UNRATE' AND value < 5.0)) AS kept,
       count(*) FILTER (series_id = 'UNRATE' AND value < 5.0) AS dropped
FROM macro GROUP BY 1""")
_add("xbrl_annual", (FILINGS,), """
SELECT pos AS doc_pos, symbol, cik, tag, fp, form, fy, val, "end", filed FROM annual
WHERE fy >= 1996 AND tag IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')""")
_add("fundamentals", (FILINGS, FUNDAMENTALS), f"SELECT *, {STAMP} AS extracted_at FROM records")
_add("prices_clean", (PRICES,), f"""
SELECT symbol, strftime(date, '%Y-%m-%d') AS date, {rnd('close', 6)} AS close, volume, {STAMP} AS extracted_at
FROM prices WHERE date BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'""")
_add("prices_from", (PRICES,), f"SELECT symbol, date, {rnd('close', 6)} AS close FROM prices WHERE date >= DATE '1997-06-30'")

# --- stored tables ------------------------------------------------------------------------------

_STORED = "series_id AS series, CAST(year AS VARCHAR) AS year, strftime(date, '%Y-%m-%d') AS date"
_add("series_scan", (MACRO,), f"""
SELECT {_STORED}, {rnd('value', 6)} AS value FROM macro
WHERE series_id IN ('GS10', 'UNRATE') AND year BETWEEN 1997 AND 1999""")
for _name, _first in (("partition_roundtrip", 2000), ("skip_existing", 1999)):
    _add(_name, (MACRO,), f"""
SELECT {_STORED}, month, {rnd(f'value + CASE WHEN year >= {_first} THEN 1 ELSE 0 END', 6)} AS value FROM macro""")
_TOTALS = f"trading_day AS date, symbol, count(*) AS n, CAST(sum(volume) AS BIGINT) AS volume, {rnd('sum(price)', 4)} AS price"
# Streamed and appended once more, but for the last day, which is replaced.
_add("incremental_load", (QUOTES,), f"""
SELECT {_TOTALS} FROM (
  SELECT * FROM quotes UNION ALL SELECT * FROM quotes WHERE trading_day < (SELECT max(trading_day) FROM quotes)) GROUP BY 1, 2""")
_add("load_quotes_run", (QUOTES,), f"""
SELECT {_TOTALS} FROM quotes WHERE price > 0 AND volume >= 0 AND abs(change_percent) <= 50 GROUP BY 1, 2""")
ORACLES["load_macro_run"], ORACLES["load_fundamentals_run"] = ORACLES["macro_parse"], ORACLES["fundamentals"]
ORACLES["backfill_run"] = ORACLES["prices_clean"]
_METRIC_COLUMNS = """symbol, category, ai_strategy, annualized_return, annualized_volatility, sharpe_ratio, max_drawdown,
       months_analyzed, start_date, end_date, capex_2025_B, capex_2026_B, ai_pct_of_capex, est_ai_spend_2026_B"""
_add("csv_roundtrip", METRIC_PARTS, f"SELECT {_METRIC_COLUMNS} FROM metrics")
_add("results_roundtrip", ROLLING_PARTS, "SELECT symbol, strftime(date, '%Y-%m-%d') AS date, rolling_sharpe_12m FROM rolling")
_add("catalog_partitions", (MACRO,), "SELECT series_id AS series, CAST(year AS VARCHAR) AS year, count(*) AS n FROM macro GROUP BY 1, 2")
# The second file of a partition holds its even months; a year without any keeps its first file as the newest.
_add("file_inventory", (MACRO,), f"""
SELECT series_id AS series, CAST(year AS VARCHAR) AS year,
       CASE WHEN count(*) FILTER (month % 2 = 0) > 0 THEN count(*) FILTER (month % 2 = 0) ELSE count(*) END AS n,
       {rnd('CASE WHEN count(*) FILTER (month % 2 = 0) > 0 THEN sum(value + 1) FILTER (month % 2 = 0) ELSE sum(value) END', 4)} AS total
FROM macro GROUP BY 1, 2""")

# --- returns and risk ---------------------------------------------------------------------------

_add("monthly_returns", (PRICES, RETURNS), f"SELECT symbol, date, {rnd('ret', 8)} AS ret FROM returns")
_add("returns_by_month_end", (PART_PRICES, PART_RETURNS), f"SELECT symbol, month, {rnd('ret', 8)} AS ret FROM part_returns")
_add("yoy_change", (MACRO,), f"""
SELECT series_id, date, {rnd('(value / lag(value, 12) OVER (PARTITION BY series_id ORDER BY date) - 1.0) * 100', 6)} AS yoy FROM macro""")
_add("rolling_mean_min_obs", (PART_PRICES,), f"""
SELECT symbol, date, {rnd('CASE WHEN count(close) OVER w >= 6 THEN avg(close) OVER w END', 6)} AS rolling_mean
FROM part_prices WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""")
_add("max_drawdown", (PART_PRICES,), f"""
SELECT symbol, {rnd('CASE WHEN count(close) < 2 THEN 0.0 ELSE min((close - peak) / peak) END', 8)} AS max_drawdown
FROM (SELECT *, max(close) OVER (PARTITION BY symbol ORDER BY date ROWS UNBOUNDED PRECEDING) AS peak FROM part_prices)
GROUP BY 1""")
_add("risk_metrics", METRIC_PARTS, f"SELECT {_METRIC_COLUMNS} FROM metrics")
_add("rolling_sharpe", ROLLING_PARTS, "SELECT * FROM rolling")
_add("rolling_sharpe_parts", (PART_PRICES, PART_RETURNS), f"""
SELECT symbol, month AS date, {rnd(EXCESS.format(rf='0.045::DOUBLE'), 3)} AS rolling_sharpe_12m
FROM ({_moments('part_returns', 'month')}) WHERE n_obs = 12""")
_add("trailing_sharpe_nulls", (PRICES, RETURNS), f"""
SELECT symbol, date AS month, {rnd(f"CASE WHEN n_obs = 12 THEN {EXCESS.format(rf='0.045::DOUBLE')} END", 6)} AS trailing_sharpe
FROM ({_moments('returns', 'date')})""")
_add("trailing_sharpe_asof", (PART_PRICES, PART_RETURNS, MACRO, PIVOT, REGIMES, _asof("part_returns", "part_sharpe")),
     f"SELECT symbol, month, {rnd('sharpe', 6)} AS sharpe FROM part_sharpe")
_add("beta", (PRICES, RETURNS, MARKET), f"""
, market_returns AS (
  SELECT * FROM (SELECT date, close / lag(close) OVER (ORDER BY date) - 1.0 AS mret FROM market) WHERE mret IS NOT NULL),
stats AS (
  SELECT symbol, count(*) AS n_stock, count(mret) AS n_pairs, covar_samp(ret, mret) / var_samp(mret) AS b
  FROM returns LEFT JOIN market_returns USING (date) GROUP BY 1)
SELECT symbol, n_pairs, {rnd('''CASE WHEN n_pairs >= 12 AND n_stock = n_pairs
  AND n_pairs = (SELECT count(*) FROM market_returns) THEN b END''', 6)} AS beta FROM stats""")
_add("risk_free_rate", (MACRO, RATE), f"SELECT {rnd('rf', 8)} AS rf FROM rate")

# --- comparisons --------------------------------------------------------------------------------

_add("category_stats", METRIC_PARTS, f"""
SELECT category, {rnd('avg(annualized_return)', 3)} AS avg_return, {rnd('avg(annualized_volatility)', 3)} AS avg_volatility,
       {rnd('avg(sharpe_ratio)', 3)} AS avg_sharpe, count(symbol) AS stock_count
FROM metrics GROUP BY 1""")
_add("value_chain_summary", METRIC_PARTS, f"""
SELECT category, string_agg(m.symbol, ', ' ORDER BY pos) AS stocks, {rnd('avg(annualized_return)', 2)} AS avg_return,
       {rnd('avg(annualized_volatility)', 2)} AS avg_volatility, {rnd('avg(sharpe_ratio)', 3)} AS avg_sharpe,
       count(m.symbol) AS stock_count,
       CAST(list_position(['Infrastructure', 'AI Builder', 'AI Integrator', 'Control', 'Legacy Tech'], category) AS INTEGER) AS rank
FROM metrics m JOIN (SELECT symbol, pos FROM security) s ON s.symbol = m.symbol GROUP BY category""")
_add("group_premium", (*METRIC_PARTS, PREMIUM), "SELECT * FROM premium")
_add("comparison_table", (*METRIC_PARTS, PREMIUM), """
SELECT 'Sharpe Ratio' AS metric, left_sharpe AS left_value, right_sharpe AS right_value, '+' || premium_pct || '%' AS premium FROM premium
UNION ALL SELECT 'Annualized Return %', left_return, right_return, '' FROM premium
UNION ALL SELECT 'Volatility %', left_vol, right_vol, '' FROM premium""")
_add("premium_text", (*METRIC_PARTS, PREMIUM), """
SELECT CASE WHEN premium_pct < 0 THEN '-' ELSE '+' END || printf('%.1f%%', abs(premium_pct)) AS premium FROM premium""")
_add("chain_members", METRIC_PARTS, """
SELECT CAST(list_position(['Infrastructure', 'AI Builder', 'AI Integrator', 'Control', 'Legacy Tech'], m.category) AS INTEGER) AS rank,
       m.category, pos, m.symbol FROM metrics m JOIN security s ON s.symbol = m.symbol""")
_add("spend_efficiency", EFFICIENCY_PARTS, f"SELECT * EXCLUDE (eff), {rnd('eff', 4)} AS sharpe_per_B FROM efficiency")
_add("efficiency_gap", EFFICIENCY_PARTS, f"""
, best AS (SELECT symbol, eff FROM efficiency ORDER BY eff DESC, symbol LIMIT 1),
worst AS (SELECT symbol, eff FROM efficiency ORDER BY eff, symbol LIMIT 1)
SELECT b.symbol AS most_efficient, {rnd('b.eff', 4)} AS most_value, w.symbol AS least_efficient, {rnd('w.eff', 4)} AS least_value,
       {rnd('CASE WHEN w.eff > 0 THEN b.eff / w.eff ELSE 0.0 END', 2)} AS efficiency_ratio
FROM best b CROSS JOIN worst w""")
_RHO = "CASE WHEN count(*) > 1 THEN 1.0 - 6.0::DOUBLE * sum(power(rx - ry, 2)) / (count(*)::DOUBLE * (count(*)::DOUBLE * count(*) - 1)) ELSE 0.0 END"
_add("spearman", EFFICIENCY_PARTS, f"""
SELECT count(*) AS n, {rnd(_RHO, 6)} AS rho
FROM (SELECT row_number() OVER (ORDER BY ai_pct, symbol) AS rx, row_number() OVER (ORDER BY sharpe, symbol) AS ry FROM efficiency)""")
_add("spearman_by_segment", (), f"""
WITH counts AS (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT c_mktsegment, count(*) AS n, {rnd(_RHO, 8)} AS rho
FROM (SELECT c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) AS rx,
             row_number() OVER (PARTITION BY c_mktsegment ORDER BY n_orders, c_custkey) AS ry
      FROM customer JOIN counts ON c_custkey = o_custkey) GROUP BY 1""")
_add("ranked_listing", METRIC_PARTS, """
SELECT symbol, sharpe_ratio, row_number() OVER (ORDER BY sharpe_ratio DESC, symbol) AS rank FROM metrics""")
_add("listing_text", EFFICIENCY_PARTS, "SELECT string_agg(symbol, ' > ' ORDER BY ai_pct DESC, symbol) AS listing FROM efficiency")
_add("export_master", METRIC_PARTS, """
SELECT * EXCLUDE (months_analyzed, start_date, end_date),
       CASE category WHEN 'AI Builder' THEN 'Build' WHEN 'AI Integrator' THEN 'Rent' ELSE 'N/A' END AS build_or_rent,
       CAST(list_position(['Infrastructure', 'AI Builder', 'AI Integrator', 'Control', 'Legacy Tech'], category) AS INTEGER) AS value_chain_rank
FROM metrics""")
ORACLES["backtest_run"] = ORACLES["export_master"]
_add("nest_flatten", ROLLING_PARTS, "SELECT * FROM rolling")

# --- macro regimes ------------------------------------------------------------------------------

_add("macro_pivot", (MACRO, PIVOT), "SELECT date, " + ", ".join(
    f"{rnd(c, 6)} AS {c}" for c in ("GS10", "CPIAUCSL", "UNRATE", "FEDFUNDS")) + " FROM wide")
_add("macro_pivot_reloads", (MACRO, PIVOT), "SELECT date, " + ", ".join(
    f"{rnd(f'{c} * (1 - 3 / 10)', 6)} AS {c}" for c in ("GS10", "CPIAUCSL", "UNRATE", "FEDFUNDS")) + " FROM wide")
_add("regimes", (MACRO, PIVOT, REGIMES), f"SELECT * REPLACE ({rnd('fedfunds', 6)} AS fedfunds) FROM regimes")
_BRANDS = [f"Brand#{n}" for n in (1, 6, 11, 16, 21, 2, 7, 12, 17, 22)]
_PER_SYMBOL = ", ".join(f"max(sharpe) FILTER (symbol = '{b}') AS \"{b}_sharpe\"" for b in _BRANDS)
_add("monthly_panel", PANEL_PARTS, f"""
SELECT p.* REPLACE ({rnd('fedfunds', 6)} AS fedfunds, {rnd('avg_builder_sharpe', 6)} AS avg_builder_sharpe,
         {rnd('avg_integrator_sharpe', 6)} AS avg_integrator_sharpe, {rnd('builder_premium', 6)} AS builder_premium),
       {', '.join(f'{rnd(chr(34) + b + "_sharpe" + chr(34), 6)} AS "{b}_sharpe"' for b in _BRANDS)}
FROM panel p JOIN (SELECT month AS m, {_PER_SYMBOL} FROM group_sharpe GROUP BY 1) ON m = p.month""")
_add("premium_by_regime", SUMMARY_PARTS, "SELECT * FROM summary")
ORACLES["regime_run"] = ORACLES["premium_by_regime"]
_add("regime_parts", SUMMARY_PARTS, """
SELECT combined_regime, avg_builder_sharpe, avg_integrator_sharpe, builder_premium AS avg_builder_premium, n_months AS month_count,
       split_part(combined_regime, '_', 1) AS rate_regime, split_part(combined_regime, '_', 2) AS inflation_regime FROM summary""")
_add("overall_premium", PANEL_PARTS, f"""
SELECT {rnd('avg(builder_premium)', 6)} AS overall_premium, count(builder_premium) AS n_months FROM panel""")
_add("regime_crosstab", SUMMARY_PARTS, f"""
SELECT r AS rate_regime, i AS inflation_regime, {rnd('avg(builder_premium)', 6)} AS avg_builder_premium,
       CAST(sum(n_months) AS BIGINT) AS month_count
FROM (SELECT unnest(['falling', 'rising', 'high']) AS r) CROSS JOIN (SELECT unnest(['normal', 'elevated', 'high']) AS i)
LEFT JOIN summary ON split_part(combined_regime, '_', 1) = r AND split_part(combined_regime, '_', 2) = i GROUP BY 1, 2""")
_add("regime_runs", PANEL_PARTS, """
, marked AS (
  SELECT month, combined_regime,
         CASE WHEN combined_regime = lag(combined_regime) OVER (ORDER BY month) THEN 0 ELSE 1 END AS starts FROM panel),
numbered AS (SELECT *, CAST(sum(starts) OVER (ORDER BY month) AS BIGINT) AS run_id FROM marked),
runs AS (
  SELECT run_id, combined_regime, min(month) AS start_month, max(month) AS last_month, count(*) AS n_months
  FROM numbered GROUP BY 1, 2)
SELECT run_id, combined_regime, start_month,
       coalesce(lead(start_month) OVER (ORDER BY run_id), last_month) AS end_month, n_months FROM runs""")
_add("stance", SUMMARY_PARTS, """
SELECT split_part(combined_regime, '_', 1) || ' / ' || split_part(combined_regime, '_', 2) AS regime, combined_regime,
       builder_premium AS avg_builder_premium,
       CASE WHEN builder_premium < 0 THEN '-' ELSE '+' END
         || printf('%.1f%%', CAST(round(CAST(abs(builder_premium) AS DECIMAL(18,6)), 1) AS DOUBLE)) AS premium_fmt, n_months AS month_count,
       CASE WHEN builder_premium > 0.05 THEN 'Strong Builders' WHEN builder_premium > 0.01 THEN 'Lean Builders'
            WHEN builder_premium > -0.01 THEN 'Neutral' ELSE 'Lean Integrators' END AS stance
FROM summary""")

# --- quality and freshness ----------------------------------------------------------------------

_add("dq_quotes", (QUOTES,), """
, checked AS (
  SELECT quote_id, symbol, CASE WHEN price >= 0.1 THEN price END AS price, volume - 5000 AS volume, change_percent FROM quotes)
SELECT quote_id, symbol, symbol || ': Missing required field: price' AS error FROM checked WHERE price IS NULL
UNION ALL SELECT quote_id, symbol, symbol || ': Invalid price: $0' FROM checked WHERE price IS NULL
UNION ALL SELECT quote_id, symbol, symbol || ': Invalid volume: ' || volume FROM checked WHERE volume < 0
UNION ALL SELECT quote_id, symbol, symbol || ': Suspicious change: ' || change_percent || '%' FROM checked
WHERE change_percent < -50 OR change_percent > 50""")
ORACLES["dq_quote_errors_stored"] = ORACLES["dq_quotes"]
_add("dq_macro", (MACRO,), """
, ranges(sid, low, high) AS (VALUES ('GS10', 0, 15), ('CPIAUCSL', 100, 400), ('UNRATE', 0, 20), ('FEDFUNDS', 0, 25)),
stats AS (
  SELECT series_id, low, high, count(*) AS row_count, count(*) FILTER (month = 3) AS null_dates,
         count(*) FILTER (value < low OR value > high) AS out_of_range
  FROM macro LEFT JOIN ranges ON sid = series_id GROUP BY 1, 2, 3)
SELECT series_id, row_count, null_dates, out_of_range,
       array_to_string(list_filter([
         CASE WHEN null_dates > 0 THEN 'Null values in date column' END,
         CASE WHEN out_of_range > 0 THEN series_id || ' value out of range [' || low || ', ' || high || ']: ' || out_of_range || ' rows' END
       ], lambda e: e IS NOT NULL), '; ') AS errors,
       null_dates = 0 AND out_of_range = 0 AS valid
FROM stats""")
_add("dq_fundamentals", (FILINGS, FUNDAMENTALS), """
, stats AS (
  SELECT count(*) AS row_count, count(*) FILTER (symbol IS NULL) AS null_symbols, count(*) FILTER (year IS NULL) AS null_years,
         count(*) FILTER (capex_usd < 0) AS negative_capex, count(*) FILTER (revenue_usd <= 0) AS non_positive_revenue,
         count(*) FILTER (capex_usd >= revenue_usd) AS capex_exceeds_revenue
  FROM records WHERE revenue_usd IS NOT NULL)
SELECT *, CASE WHEN capex_exceeds_revenue > 0 THEN 'capex >= revenue: ' || capex_exceeds_revenue || ' rows' ELSE '' END AS errors,
       capex_exceeds_revenue = 0 AS valid FROM stats""")
_add("missing_series", (SECURITY, SPEND), "SELECT symbol FROM security WHERE symbol NOT IN (SELECT symbol FROM spend)")
_SECURITIES = ", ".join(f"({i}, '{s}', '{c}', '{a}')" for i, (s, c, a) in enumerate(C.SECURITIES))
_add("dimension_join", (), f"""
SELECT symbol, category, ai_strategy, count(*) AS parts, CAST(sum(p_size) AS BIGINT) AS size
FROM part JOIN (VALUES {_SECURITIES}) AS v(pos, symbol, category, ai_strategy) ON p_partkey % {len(C.SECURITIES)} = pos
GROUP BY 1, 2, 3""")
_add("record_counts", (QUOTES,), "SELECT kind, trading_day, count(*) AS records FROM quotes GROUP BY 1, 2")
_add("load_report", (SECURITY, SPEND), """
SELECT symbol, CASE WHEN symbol IN (SELECT symbol FROM spend) THEN 'loaded' ELSE 'failed' END AS status FROM security""")
_add("completeness", (QUOTES, NEWEST, COMPLETE), f"""
SELECT g.day, status, message, CASE WHEN trading THEN g.n END AS records,
       CASE WHEN trading AND g.n = 18 THEN count(DISTINCT q.symbol) END AS n_prices,
       CASE WHEN trading AND g.n = 18 THEN {rnd('sum(q.price)', 4)} END AS price_sum
FROM graded g LEFT JOIN quote_files q ON q.day = g.day AND q.path = g.path GROUP BY g.day, status, message, trading, g.n""")
_add("staleness", (STALE,), "SELECT * FROM stale")
_add("health", (QUOTES, NEWEST, COMPLETE, STALE), """
, reports AS (
  SELECT day, 'quotes' AS feed, status, message FROM graded
  UNION ALL SELECT day, feed, stale.status, stale.message FROM stale, graded)
SELECT day, CASE WHEN count(*) FILTER (status <> 'OK') = 0 THEN 'HEALTHY' ELSE 'NEEDS_ATTENTION' END AS health,
       count(*) FILTER (status <> 'OK') AS n_issues,
       string_agg(feed || ': ' || message, '; ' ORDER BY feed || ': ' || message) FILTER (status <> 'OK') AS issues
FROM reports GROUP BY day""")

# --- SQL catalogue ------------------------------------------------------------------------------

_SEVEN = [
    ("stocks", "quotes", "trading_day", S.STOCKS), ("macro_indicators", "macro", "(series_id, year)", S.MACRO),
    ("fundamentals", "facts", "year", S.FUNDAMENTALS_BY_YEAR), ("historical_prices", "prices", "symbol", S.PRICES),
    ("crypto", "orders", "date_trunc('month', o_orderdate::DATE)", S.CRYPTO), ("weather", "customer", "c_nationkey", S.WEATHER),
    ("forecast", "customer", "c_nationkey", S.FORECAST),
]
_add("catalog_tables", (QUOTES, MACRO, PRICES, f"facts AS ({ORACLES['fundamentals']})"), " UNION ALL ".join(
    f"SELECT '{name}' AS name, count(*) AS records, count(DISTINCT {key}) AS stored, '{', '.join(table.schema.names)}' AS columns FROM {source}"
    for name, source, key, table in _SEVEN))
_EXPORTED = {
    "backtest_results": "csv_roundtrip", "export_master": "export_master", "category_summary": "value_chain_summary", "build_vs_rent": "comparison_table",
    "capex_efficiency": None, "value_chain_summary": "value_chain_summary", "rolling_sharpe": None,
}
_COUNTED = {
    "capex_efficiency": "SELECT 1 FROM metrics WHERE symbol IN (SELECT symbol FROM spend)", "rolling_sharpe": "SELECT 1 FROM rolling WHERE symbol IN (SELECT symbol FROM metrics)",
}
_add("exports_roundtrip", (*METRIC_PARTS, RETURNS, ROLLING), " UNION ALL ".join(
    f"SELECT '{name}' AS name, '{', '.join(list(S.EXPORTS[name].values()) if isinstance(S.EXPORTS[name], dict) else S.EXPORTS[name])}' AS headings, "
    f"(SELECT count(*) FROM ({_COUNTED[name] if same is None else ORACLES[same]})) AS records" for name, same in _EXPORTED.items()))
_add("load_rejects", (MACRO,), """
, docs AS (SELECT series_id, year, CASE WHEN series_id = 'UNRATE' AND year % 2 = 0 THEN 'not JSON' WHEN series_id = 'GS10' AND year % 3 = 0 THEN 'empty document'
    WHEN series_id = 'CPIAUCSL' AND year % 3 = 1 THEN 'no records of this feed' END AS reason FROM (SELECT DISTINCT series_id, year FROM macro))
SELECT reason AS state, count(*) AS n FROM docs WHERE reason IS NOT NULL GROUP BY 1
UNION ALL SELECT 'loaded ' || series_id, count(*) FROM macro JOIN docs USING (series_id, year)
WHERE reason IS NULL AND NOT (series_id = 'UNRATE' AND value < 5.0) GROUP BY 1""")
_add("scan_absent", (), """
SELECT unnest(['NOT_THERE', 'NOR_THIS']) AS series,
       'no data under the table for series [''NOT_THERE'', ''NOR_THIS''] in 1990-2030' AS message""")
_add("dq_missing_columns", (QUOTES, MACRO, f"facts AS ({ORACLES['fundamentals']})"), """
SELECT 'macro' AS "table", count(*) AS row_count, 'Missing columns: [''date'']' AS errors, false AS valid FROM macro
UNION ALL SELECT 'fundamentals', count(*), 'Missing columns: [''revenue'']', false FROM facts
UNION ALL SELECT 'quotes', count(*), 'Missing required field: price', false FROM quotes
UNION ALL SELECT 'quotes', count(*), 'Invalid price: $0', false FROM quotes""")
_add("completeness_stored", (QUOTES,), """
, stored AS (SELECT CAST(trading_day AS DATE) AS day, count(DISTINCT symbol) AS n FROM quotes GROUP BY 1),
days AS (SELECT day FROM stored UNION SELECT CAST(day + INTERVAL 40 DAY AS DATE) FROM stored),
state AS (SELECT d.day, n, dayofweek(d.day) BETWEEN 1 AND 5 AS trading FROM days d LEFT JOIN stored s ON s.day = d.day)
SELECT day, CASE WHEN NOT trading THEN 'OK' WHEN n IS NULL THEN 'WARNING' WHEN n = 18 THEN 'OK' ELSE 'ERROR' END AS status,
  CASE WHEN NOT trading THEN dayname(day) || ' - non-trading day' WHEN n IS NULL THEN 'No data for ' || strftime(day, '%Y-%m-%d')
    WHEN n <> 18 THEN 'Expected 18 stocks, got ' || n END AS message,
  CASE WHEN trading THEN n END AS records, CASE WHEN trading AND n = 18 THEN n END AS n_prices FROM state""")
_add("staleness_stored", (MACRO, PRICES), """
SELECT 'macro_indicators' AS feed, 'WARNING' AS status, 'Data is 40 days old (expected <=35)' AS message,
       count(DISTINCT (series_id, year)) AS partitions, 40::BIGINT AS days_since_update FROM macro
UNION ALL SELECT 'historical_prices', 'OK', NULL, count(DISTINCT symbol), 40 FROM prices
UNION ALL SELECT 'fundamentals', 'WARNING', 'No fundamentals data found', NULL, NULL""")

_add("sql1_daily_leader", (QUOTES,), """
SELECT symbol, trading_day, change_percent FROM quotes
QUALIFY row_number() OVER (PARTITION BY trading_day ORDER BY change_percent DESC, symbol, quote_id) = 1""")
_add("sql2_asset_summary", (QUOTES,), f"""
SELECT 'Stocks' AS asset_class, count(DISTINCT symbol) AS assets, {rnd('avg(price)', 2)} AS avg_price FROM quotes
UNION ALL SELECT 'Crypto', count(DISTINCT o_orderpriority), {rnd('avg(o_totalprice)', 2)} FROM orders
UNION ALL SELECT 'Weather', 1::BIGINT, {rnd('avg(c_acctbal)', 2)} FROM customer""")
_add("sql3_change_spread", (QUOTES,), f"""
SELECT symbol, count(*) AS data_points, {rnd('min(change_percent)', 2)} AS worst_day, {rnd('max(change_percent)', 2)} AS best_day,
       {rnd('max(change_percent) - min(change_percent)', 2)} AS spread
FROM quotes GROUP BY 1 HAVING count(*) > 1""")
_add("sql4_moving_average", (QUOTES,), f"""
SELECT quote_id, symbol, trading_day, price, {rnd('''avg(price) OVER (
  PARTITION BY symbol ORDER BY ts, quote_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)''', 2)} AS moving_avg_3d FROM quotes""")
_add("sql5_high_volume", (QUOTES,), f"""
SELECT quote_id, q.symbol, trading_day, price, volume, change_percent, {rnd('mean_volume', 0)} AS avg_volume,
       {rnd('CAST(volume AS DOUBLE) / mean_volume', 2)} AS volume_ratio
FROM quotes q JOIN (SELECT symbol, avg(volume) AS mean_volume FROM quotes GROUP BY 1) a ON a.symbol = q.symbol
WHERE volume > mean_volume * 1.5::DOUBLE""")
_add("sql6_price_range", (), f"""
SELECT o_orderpriority AS symbol, min(o_totalprice) AS low, max(o_totalprice) AS high,
       {rnd('max(o_totalprice) - min(o_totalprice)', 2)} AS range,
       {rnd('(max(o_totalprice) - min(o_totalprice)) / min(o_totalprice) * 100', 2)} AS range_pct
FROM orders GROUP BY 1""")
_add("sql7_category_performance", (QUOTES, NEWEST), f"""
SELECT {QUOTE_CATEGORY} AS category, {rnd('avg(change_percent)', 2)} AS avg_daily_change, {rnd('avg(volume)', 0)} AS avg_volume,
       count(DISTINCT symbol) AS stocks FROM newest GROUP BY 1""")
_add("sql8_dollar_volume", (QUOTES, NEWEST), f"""
SELECT quote_id, symbol, price, volume, {rnd('price * volume / 1e9', 2)} AS dollar_volume_B, change_percent FROM newest""")
