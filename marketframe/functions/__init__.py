from marketframe.functions.metrics import (
    annualised_return,
    annualised_volatility,
    excess_sharpe,
    headline_sharpe,
    relative_premium,
)
from marketframe.functions.scalars import (
    Stamp,
    build_or_rent,
    case_label,
    chain_rank,
    change_percent,
    dollar_volume_billions,
    is_weekday,
    iso_date,
    iso_stamp,
    month_end,
    parse_date,
    signed_percent,
    simple_return,
    stable_round,
    stance_label,
)

__all__ = [
    "Stamp",
    "annualised_return",
    "annualised_volatility",
    "build_or_rent",
    "case_label",
    "chain_rank",
    "change_percent",
    "dollar_volume_billions",
    "excess_sharpe",
    "headline_sharpe",
    "is_weekday",
    "iso_date",
    "iso_stamp",
    "month_end",
    "parse_date",
    "relative_premium",
    "signed_percent",
    "simple_return",
    "stable_round",
    "stance_label",
]
