from datetime import date

from dateutil.relativedelta import relativedelta


def months(n, start=date(2023, 1, 1)):
    return [start + relativedelta(months=i) for i in range(n)]


def price_rows(symbol, closes, start=date(2023, 1, 1)):
    return [(symbol, d, float(c)) for d, c in zip(months(len(closes), start), closes)]


PRICE = "symbol string, date date, close double"
RETURN = "symbol string, month date, ret double"


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
