"""Read access to a release: every method returns a DataFrame."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitmill.operators import actions, audit, calendar, intervals, universe
from pitmill.spec import ProfileSpec


class CoverageError(ValueError):
    """A date outside the verified range, in strict mode."""


class LookupFailed(LookupError):
    """A dated lookup that doesn't have exactly one answer."""


class PanelStore:
    """Tables of a release at ``root``, read lazily; ``start`` and ``end`` bound the dates in strict mode."""

    def __init__(self, spark: SparkSession, root: str = "", tables: dict[str, DataFrame] | None = None, spec: ProfileSpec | None = None, start=None, end=None, strict: bool = True):
        self.spark, self.root, self.tables = spark, root, tables or {}
        self.spec, self.start, self.end, self.strict = spec or ProfileSpec(), start, end, strict

    def table(self, name: str) -> DataFrame:
        return self.tables[name] if name in self.tables else self.spark.read.parquet(f"{self.root}/{name}.parquet")

    def _on(self, at) -> date:
        at = date.fromisoformat(str(at))
        if self.strict and ((self.start and at < date.fromisoformat(str(self.start))) or (self.end and at > date.fromisoformat(str(self.end)))):
            raise CoverageError(f"{at} is outside {self.start}..{self.end}")
        return at

    def active_on(self, at) -> DataFrame:
        at = self._on(at)
        return universe.active_on(self.table("daily_prices_raw"), at)

    def eligible_on(self, at, **thresholds) -> DataFrame:
        at = self._on(at)
        return universe.eligible_on(self.table("liquidity_features"), at, **thresholds)

    def ranked_liquid_on(self, at, n: int) -> DataFrame:
        at = self._on(at)
        return universe.top_n(self.table("liquidity_features"), at, n)

    def profile_on(self, at, profile: str | None = None) -> DataFrame:
        if profile not in (None, self.spec.profile_id):
            raise ValueError(f"unknown profile {profile}")
        at = self._on(at)
        return universe.profile_on(self.table("research_universe_monthly"), self.spec, at)

    get_active_universe, get_investable_universe = active_on, profile_on

    def status_on(self, at) -> DataFrame:
        return intervals.history_between(self.table("trading_status_intervals"), self._on(at), at, "status_start", "status_end")

    def observation_status(self, requests: DataFrame) -> DataFrame:
        return universe.observation_status_on(requests, self.table("trading_calendar"), self.table("security_master"), self.table("trading_status_intervals"), self.table("daily_prices_raw"))

    def _only(self, df: DataFrame, what: str):
        rows = df.distinct().limit(2).collect()
        if len(rows) != 1:
            raise LookupFailed(f"{what}: {'none' if not rows else 'several'}")
        return rows[0][0]

    def resolve_symbol(self, symbol: str, at, exchange: str = "NSE", series: str = "EQ") -> str:
        m = intervals.history_between(self.table("security_master"), self._on(at), at).where((F.col("symbol") == symbol) & (F.col("exchange") == exchange) & (F.col("series") == series))
        return self._only(m.select("security_id"), f"{symbol} on {at}")

    def name_at(self, issuer_id: str, at) -> str:
        return self._only(intervals.history_between(self.table("company_name_history"), self._on(at), at).where(F.col("issuer_id") == issuer_id).select("company_name"), f"{issuer_id} on {at}")

    def isin_at(self, security_id: str, at) -> str:
        return self._only(intervals.history_between(self.table("isin_history"), self._on(at), at).where(F.col("security_id") == security_id).select("isin"), f"{security_id} on {at}")

    def history(self, security_id: str, begin, end) -> DataFrame:
        return self.table("daily_prices_raw").where((F.col("security_id") == security_id) & F.col("date").between(F.lit(self._on(begin)), F.lit(self._on(end)))).orderBy("date")

    def adjusted_history(self, security_id: str, begin, end, series: str = "PRICE_RETURN") -> DataFrame:
        rows = self.table("daily_prices_adjusted").where((F.col("security_id") == security_id) & F.col("date").between(F.lit(self._on(begin)), F.lit(self._on(end))))
        return actions.adjusted_history(rows, series).orderBy("date")

    def sessions_between(self, begin, end) -> DataFrame:
        return self.table("trading_calendar").where(F.col("date").between(F.lit(self._on(begin)), F.lit(self._on(end)))).orderBy("date")

    def feature_readiness(self, at) -> DataFrame:
        return calendar.feature_readiness(self.spark.createDataFrame([(self._on(at),)], "date date"), self.table("trading_calendar"))

    def terminal_recovery_scenarios(self, holdings: DataFrame) -> DataFrame:
        return audit.resolution_queue(self.table("terminal_events"), self.table("daily_prices_raw"), holdings)
