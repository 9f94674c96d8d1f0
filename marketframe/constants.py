"""Dimension rows, label sets, thresholds and limits.

Everything here is data that results depend on; logic lives elsewhere.
"""

# Security dimension (symbol, category, ai_strategy) in input order.
SECURITIES = [
    ("NVDA", "Infrastructure", "Sells AI hardware"),
    ("META", "AI Builder", "Proprietary (Llama, MTIA chips)"),
    ("GOOGL", "AI Builder", "Proprietary (Gemini, TPUs)"),
    ("MSFT", "AI Integrator", "Partnership (OpenAI)"),
    ("AMZN", "AI Integrator", "Partnership (Anthropic)"),
    ("CRM", "Legacy Tech", "AI features (Einstein)"),
    ("ORCL", "Legacy Tech", "Cloud/AI pivot"),
    ("ADBE", "Legacy Tech", "AI-disrupted (Firefly)"),
    ("AAPL", "Control", "Late mover (Apple Intelligence)"),
    ("TSLA", "Control", "Autonomous driving / robotics"),
]

# Company identifiers (symbol, cik); the leading zeros are significant.
ENTITIES = [
    ("META", "0001326801"),
    ("GOOGL", "0001652044"),
    ("MSFT", "0000789019"),
    ("AMZN", "0001018724"),
]

# Fixed values: (symbol, capex_2025_B, capex_2026_B, ai_pct, revenue_2025_B), in billions and percent.
SPEND = [
    ("META", 72.2, 125.0, 95, 188.0),
    ("GOOGL", 75.0, 180.0, 80, 350.0),
    ("MSFT", 80.0, 145.0, 60, 262.0),
    ("AMZN", 124.5, 200.0, 40, 638.0),
]

# Macro series (series_id, description, units).
SERIES = [
    ("GS10", "10-Year Treasury Constant Maturity Rate", "percent"),
    ("CPIAUCSL", "Consumer Price Index: All Urban Consumers", "index_1982"),
    ("UNRATE", "Unemployment Rate", "percent"),
    ("FEDFUNDS", "Federal Funds Effective Rate", "percent"),
]

# Inclusive plausible range per macro series (series_id, low, high).
MACRO_RANGES = [
    ("GS10", 0, 15),
    ("CPIAUCSL", 100, 400),
    ("UNRATE", 0, 20),
    ("FEDFUNDS", 0, 25),
]

# Category order of the value-chain report (position = rank) and of the console report.
CHAIN_ORDER = ["Infrastructure", "AI Builder", "AI Integrator", "Control", "Legacy Tech"]
REPORT_ORDER = ["Infrastructure", "AI Builder", "AI Integrator", "Legacy Tech", "Control"]
UNRANKED = 99
LEFT_GROUP, RIGHT_GROUP = "AI Builder", "AI Integrator"
GROUP_LABELS = {"AI Builder": "Build", "AI Integrator": "Rent"}
NO_GROUP_LABEL = "N/A"

# XBRL tags; revenue tags in priority order.
CAPEX_TAG = "PaymentsToAcquirePropertyPlantAndEquipment"
REVENUE_TAGS = [
    "RevenueFromContractWithCustomerExcludingAssessedTax",
    "Revenues",
    "SalesRevenueNet",
]
MIN_FISCAL_YEAR = 2020

# Periods, windows, rates and regime thresholds.
MONTHS_PER_YEAR = 12
MIN_RETURNS = 12
ROLLING_WINDOW = 12
RISK_FREE_RATE = 0.045
RATE_MEAN_WINDOW, RATE_MEAN_MIN_OBS = 12, 6
INFLATION_HIGH_PCT = 4.0
UNEMPLOYMENT_HIGH_PCT = 5.5
PRICE_START = "2022-12-01"
REGIME_START_YEAR = 2020
RATE_YEARS = (2022, 2026)

# Regime label grid of the crosstab, stance names and cut points.
RATE_LABELS = ["falling", "rising", "high"]
INFLATION_LABELS = ["normal", "elevated", "high"]
STANCE_CUTS = (50.0, 10.0, -10.0)
STANCE_LABELS = ("Strong Builders", "Lean Builders", "Neutral", "Lean Integrators")

# Freshness rules.
EXPECTED_QUOTES = 10
STALENESS_LIMITS = [("fundamentals", 120), ("macro_indicators", 35)]

# Field names of landed quotes and what an absent field stands for (None: the requested symbol).
QUOTE_FIELDS = [
    ("symbol", "01. symbol", None),
    ("price", "05. price", "0"),
    ("volume", "06. volume", "0"),
    ("trading_day", "07. latest trading day", ""),
    ("previous_close", "08. previous close", "0"),
    ("change", "09. change", "0"),
    ("change_percent", "10. change percent", "0%"),
]

# Reasons for which a landed document is set aside.
EMPTY_DOCUMENT, NOT_JSON, NO_RECORDS = "empty document", "not JSON", "no records of this feed"

# Texts of quality and freshness reports.
UNKNOWN_SYMBOL = "UNKNOWN"
MISSING_FIELD = "Missing required field"
INVALID_PRICE = "Invalid price"
INVALID_VOLUME = "Invalid volume"
SUSPICIOUS_CHANGE = "Suspicious change"
NO_STOCKS = "No stock data to validate"
MISSING_COLUMNS = "Missing columns: "
NULL_VALUES = "Null values in {} column"
OUT_OF_RANGE = " value out of range "
NON_TRADING = " - non-trading day"
NO_DAY = "No data for "
WRONG_COUNT = "Expected {} stocks, got "
NO_FEED = "No %s data found"
TOO_OLD = "Data is %d days old (expected <=%d)"
