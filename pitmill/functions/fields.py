"""Column functions over raw fields, labels and prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Symbols that are exchange-traded funds without saying so.
ETF_SYMBOLS = ("AXISGOLD", "GOLDSHARE", "IDBIGOLD", "IIFLNIFTY", "KOTAKGOLD", "MGOLD", "QGOLDHALF", "RELGOLD")


def parse_number(col: Column | str) -> Column:
    """Double of a text with thousands commas; null for blanks, ``-``, ``NA`` and ``null``."""
    text = F.trim(F.col(col) if isinstance(col, str) else col)
    return F.when(~text.isin("", "-", "NA", "null"), F.regexp_replace(text, ",", "").try_cast("double"))


def parse_int(col: Column | str) -> Column:
    return parse_number(col).cast("bigint")


def first_present(df: DataFrame, names: list[str], kind: str = "string") -> Column:
    """The first of ``names`` that is a column, whatever it holds; a typed null if none is."""
    return next((F.col(n) for n in names if n in df.columns), F.lit(None)).cast(kind)


def identity_series(series: Column) -> Column:
    """BE rows count as EQ for identity."""
    return F.when(series == "BE", "EQ").otherwise(series)


def classify_instrument(symbol: Column, name: Column) -> Column:
    """ETF, REIT or INVIT by unmistakable marks; else an ordinary share."""
    text = F.upper(F.concat_ws(" ", F.coalesce(symbol, F.lit("")), F.coalesce(name, F.lit(""))))
    etf = F.upper(symbol).isin(*ETF_SYMBOLS) | text.rlike(r"ETF|BEES|LIQUID") | text.rlike(r"AMC\s*[-–]")
    return F.when(etf, "ETF").when(text.rlike(r"\bREIT\b"), "REIT").when(text.rlike(r"\bINVIT\b"), "INVIT").otherwise("ORDINARY_EQUITY")


def stable_id(prefix: str, *parts: Column) -> Column:
    """Prefix and 16 hex digits of the SHA-256 of the trimmed upper-case parts, joined by a pipe."""
    key = F.concat_ws("|", *[F.upper(F.trim(F.coalesce(p, F.lit("")))) for p in parts])
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha2(key.cast("binary"), 256), 1, 16))


def observation_status(volume: Column) -> Column:
    return F.when(F.coalesce(volume, F.lit(0)) > 0, "TRADED").otherwise("NO_TRADE")


def ohlc_findings(open_: Column, high: Column, low: Column, close: Column, volume: Column) -> Column:
    """Array of the codes of the price and volume rules that a row breaks; nulls break none."""
    rules = (
        ("NON_POSITIVE_PRICE", F.exists(F.array(open_, high, low, close), lambda x: x <= 0)),
        ("NEGATIVE_VOLUME", volume < 0), ("LOW_ABOVE_HIGH", low > high), ("OPEN_ABOVE_HIGH", open_ > high),
        ("OPEN_BELOW_LOW", open_ < low), ("CLOSE_ABOVE_HIGH", close > high), ("CLOSE_BELOW_LOW", close < low),
    )
    return F.array_compact(F.array(*[F.when(broken, code) for code, broken in rules]))


def quality_findings(obs: DataFrame, key: tuple[str, ...] = ("date", "exchange", "symbol", "series"), order: tuple[str, ...] = ("source_row", "source_line")) -> DataFrame:
    """``(key, check)``: every row after the first of its key, and every broken price rule."""
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    codes = ohlc_findings(*[F.col(c) for c in ("open", "high", "low", "close", "volume")])
    checks = F.concat(F.when(F.col("nth_") > 1, F.array(F.lit("DUPLICATE_OBSERVATION"))).otherwise(F.array().cast("array<string>")), codes)
    return obs.withColumn("nth_", nth).select(*key, *order, F.explode(checks).alias("check"))


#: What marks a symbol or name as a product's, and a symbol as no ordinary share's.
PRODUCT_MARKS = ("ETF", "BEES", "LIQUID", "GILT", "GOLD", "SILVER", "FUND", "MUTUAL", "NIFTY", "SENSEX", "BANKBEES", "JUNIORBEES", "PSUBNKBEES", "SHARIAHBEES", "PREF", "PREFERENCE", "WARRANT", "RIGHTS", "REIT", "INVIT")
NON_ORDINARY_MARKS = ("GOLD", "NIFTY", "ETF", "BEES", "HANGSENG", "LIQUID", "MOM", "NV20", "PSUBNK", "BANKETF")


def product_marker(symbol: Column, name: Column) -> Column:
    """Whether a row's symbol or name looks like a product's."""
    text = F.upper(F.concat(F.coalesce(symbol, F.lit("")), F.lit(" "), F.coalesce(name, F.lit(""))))
    return text.rlike("|".join(PRODUCT_MARKS))


def known_product(symbol: Column) -> Column:
    """Whether a symbol is one of the products that do not say so."""
    return F.upper(F.coalesce(symbol, F.lit(""))).isin(*ETF_SYMBOLS)


def has_marker(symbol: Column, marks: tuple[str, ...] = NON_ORDINARY_MARKS) -> Column:
    return F.upper(symbol).rlike("|".join(marks))
