"""Identities of observed exchange keys over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitmill.functions.fields import classify_instrument, identity_series, stable_id
from pitmill.operators.graph import connected_components
from pitmill.operators.intervals import open_end, overlay_intervals


def discover_securities(obs: DataFrame) -> DataFrame:
    """One row for each (exchange, symbol, series, isin): first and last date, name, type (a fund mark on any row wins)."""
    kind = classify_instrument(F.col("symbol"), F.col("company_name"))
    rows = obs.withColumns({"series": identity_series(F.col("series")), "kind": kind})
    odd = F.min(F.when(F.col("kind") != "ORDINARY_EQUITY", F.col("kind")))
    return rows.groupBy("exchange", "symbol", "series", F.coalesce("isin", F.lit("")).alias("isin")).agg(
        F.min("date").alias("first_seen"), F.max("date").alias("last_seen"), F.min("company_name").alias("company_name"), F.coalesce(odd, F.lit("ORDINARY_EQUITY")).alias("instrument_type"),
    ).withColumn("candidate_isin", F.nullif("isin", F.lit(""))).drop("isin")


def continuity_chains(discovered: DataFrame, calendar: DataFrame | None = None, max_gap_sessions: int = 1, max_gap_days: int = 7) -> DataFrame:
    """``discovered`` with ``chain``: rows joined by adjacency within a symbol, then within an ISIN.

    Adjacent: the next row begins after the last one ends, within ``max_gap_sessions`` sessions, or
    ``max_gap_days`` days without a calendar. A chain is named by the smallest key of its rows.
    """
    from pitmill.operators.calendar import number_sessions

    rows = discovered.withColumn("node_", F.concat_ws("|", "exchange", "series", "symbol", F.coalesce("candidate_isin", F.lit("")), F.col("first_seen").cast("string"), F.col("last_seen").cast("string")))
    lo, hi = F.col("first_seen"), F.col("last_seen")
    if calendar is not None:
        s = number_sessions(calendar)
        rows = rows.join(F.broadcast(s.select(F.col("date").alias("first_seen"), F.col("session_number").alias("lo_"))), "first_seen", "left").join(F.broadcast(s.select(F.col("date").alias("last_seen"), F.col("session_number").alias("hi_"))), "last_seen", "left")
        lo, hi, most = F.col("lo_"), F.col("hi_"), max_gap_sessions
    else:
        lo, hi, most = F.unix_date(lo), F.unix_date(hi), max_gap_days

    def edges(rows: DataFrame, *key: str, then: str) -> DataFrame:
        w = Window.partitionBy(*key).orderBy("first_seen", "last_seen", then)
        gap = lo - F.lag(hi).over(w)
        return rows.select(F.col("node_").alias("a"), F.when((gap > 0) & (gap <= most), F.lag("node_").over(w)).alias("b")).where("b is not null")

    isin = rows.where("candidate_isin is not null").withColumn("isin_", F.upper("candidate_isin"))
    links = edges(rows.withColumn("isin_", F.coalesce("candidate_isin", F.lit(""))), "exchange", "symbol", "series", then="isin_").unionByName(edges(isin, "exchange", "series", "isin_", then="symbol"))
    found = connected_components(links)
    return rows.join(found, F.col("node_") == F.col("node"), "left").withColumn("chain", F.coalesce("component", "node_")).select(*discovered.columns, "chain")


def build_identity_rows(discovered: DataFrame, version: str = "identity-v2", calendar: DataFrame | None = None) -> DataFrame:
    """Provisional ids, quality and source labels. Version 1 takes every row for itself, others take chains.

    Ids come from the chain's first ISIN, else its first symbol; a row that begins on the earliest
    date of all is left-censored.
    """
    if version == "identity-v1":
        rows = discovered.withColumn("chain", F.concat_ws("|", "exchange", "series", "symbol", F.coalesce("candidate_isin", F.lit("")), F.col("first_seen").cast("string"), F.col("last_seen").cast("string")))
    else:
        rows = continuity_chains(discovered, calendar)
    w = Window.partitionBy("chain")
    ordered = w.orderBy("first_seen", "last_seen", F.coalesce("candidate_isin", F.lit("")), "symbol").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    start = discovered.agg(F.min("first_seen").alias("start_"))
    rows = rows.withColumns({"n_": F.count(F.lit(1)).over(w), "with_": F.count("candidate_isin").over(w), "basis_": F.coalesce(F.first("candidate_isin", ignorenulls=True).over(ordered), F.first("symbol").over(ordered))}).crossJoin(F.broadcast(start))
    joined, has, censored = F.col("n_") > 1, F.col("candidate_isin").isNotNull(), F.col("first_seen") == F.col("start_")
    return rows.select(
        *discovered.columns, "chain",
        stable_id("SEC", F.col("exchange"), F.col("basis_"), F.col("series")).alias("security_id"), stable_id("EP", F.col("exchange"), F.col("basis_"), F.col("series")).alias("listing_episode_id"), stable_id("ISSUER", F.col("exchange"), F.col("basis_")).alias("issuer_id"),
        F.col("candidate_isin").alias("isin"), F.col("first_seen").alias("effective_from"), F.col("last_seen").alias("effective_to"),
        F.when(joined, "RECONSTRUCTED_HIGH_CONFIDENCE").when(has, "SINGLE_OFFICIAL_SOURCE").otherwise("PARTIAL").alias("identity_quality"),
        F.when(joined & (F.col("with_") > 0) & (F.col("with_") < F.col("n_")), "RECONSTRUCTED_PRE_ISIN_CONTINUITY").when(joined, "RECONSTRUCTED_ADJACENT_SYMBOL_ISIN_CONTINUITY").when(has, "NSE_OFFICIAL_BHAVCOPY_ISIN").alias("identity_source"),
        F.when(F.col("instrument_type") == "ORDINARY_EQUITY", "HEURISTIC_HIGH_CONFIDENCE").otherwise("EXPLICIT_EXCHANGE_MARKER").alias("instrument_type_quality"),
        censored.alias("listing_history_left_censored"), F.when(censored, "LISTING_HISTORY_LEFT_CENSORED").otherwise("FIRST_OBSERVED_TRADE_DATE").alias("listing_age_sessions_quality"),
        F.when(~has & ~joined, "REVIEW_REQUIRED").otherwise("UNREVIEWED").alias("review_status"),
    )


def validate_overrides(overrides: DataFrame) -> DataFrame:
    """``overrides`` that may not be applied, with the ``reason``: MISSING_FIELD, BAD_TARGET, BAD_RANGE, NOT_APPROVED, NO_EVIDENCE or OVERLAP."""
    earlier = Window.partitionBy("exchange", F.upper("symbol"), "series").orderBy("effective_from", "effective_to").rowsBetween(Window.unboundedPreceding, -1)
    missing = F.lit(False)
    for c in ("exchange", "symbol", "series", "effective_from", "effective_to", "security_id", "review_status"):
        missing = missing | F.col(c).isNull()
    reason = (
        F.when(missing, "MISSING_FIELD").when((F.col("exchange") != "NSE") | (F.col("series") != "EQ") | (F.trim("symbol") == ""), "BAD_TARGET")
        .when(F.col("effective_to") < F.col("effective_from"), "BAD_RANGE").when(F.col("review_status") != "APPROVED", "NOT_APPROVED")
        .when((F.size(F.coalesce("evidence_references", F.array().cast("array<string>"))) <= 0) | (F.trim(F.coalesce("rationale", F.lit(""))) == ""), "NO_EVIDENCE")
        .when(F.col("effective_from") <= F.max("effective_to").over(earlier), "OVERLAP")
    )
    return overrides.withColumn("reason", reason).where("reason is not null")


def apply_overrides(identities: DataFrame, overrides: DataFrame) -> DataFrame:
    """Identity spans cut at approved overrides; inside one the symbol and labels are the reviewed ones."""
    patches = overrides.select(
        "security_id", "effective_from", "effective_to", F.lit(1).alias("priority"), F.upper("symbol").alias("symbol"), F.lit("MULTI_SOURCE_VERIFIED").alias("identity_quality"),
        F.lit("MANUAL_APPROVED_OVERRIDE").alias("identity_source"), F.lit("APPROVED").alias("review_status"))
    return overlay_intervals(identities, patches, ["symbol", "identity_quality", "identity_source", "review_status"], start="effective_from", end="effective_to")


def resolve_observations(obs: DataFrame, identities: DataFrame, overrides: DataFrame | None = None, dated: bool = True) -> DataFrame:
    """Observations with ``candidate_ids``, the ``tier`` they come from and, where there is exactly one candidate, ``security_id``.

    The first tier that has something decides. OVERRIDE: the identity that an approved override names for the symbol and series on the date,
    whatever the ISIN; two overrides on one date leave no candidate. EXACT: identities of the symbol, series and ISIN, where no
    ISIN is a value of its own. SYMBOL: for an observation without ISIN, all identities of the symbol and series. With ``dated``
    an identity of the last two tiers must hold the date, as one of the first always must.

    What is known of a symbol, a few identities and overrides, is one row, so every observation meets one row at most: one join
    on the symbol, whatever the number of candidates, in which a symbol of very many observations may be split.
    """
    key = ["exchange", "symbol", "series"]
    span = F.struct(F.coalesce("isin", F.lit("")).alias("isin"), "security_id", "effective_from", open_end("effective_to").alias("effective_to"))
    known = identities.groupBy(*key).agg(F.collect_list(span).alias("ids_"))
    if overrides is None:
        known = known.withColumn("overrides_", F.lit(None))
    else:
        spans = identities.groupBy("security_id").agg(F.collect_list(F.struct("security_id", "effective_from", open_end("effective_to").alias("effective_to"))).alias("target_"))
        named = overrides.select(*key, "security_id", F.col("effective_from").alias("from_"), open_end("effective_to").alias("to_")).join(spans, "security_id", "left")
        ours = named.groupBy(*key).agg(F.collect_list(F.struct("from_", "to_", F.coalesce("target_", F.array()).alias("target_"))).alias("overrides_"))
        known = known.join(ours, key, "full")
    known = known.withColumnsRenamed({k: f"{k}_k" for k in key})
    on = (F.col("exchange") == F.col("exchange_k")) & (F.col("symbol") == F.col("symbol_k")) & (identity_series(F.col("series")) == F.col("series_k"))
    date, isin = F.col("date"), F.coalesce("isin", F.lit(""))
    holds = lambda x: (date >= x.effective_from) & (date <= x.effective_to)
    ids = F.filter("ids_", holds) if dated else F.col("ids_")
    exact = F.filter("ids_", lambda x: x["isin"] == isin)
    mine = F.lit(None) if overrides is None else F.filter("overrides_", lambda x: (date >= x.from_) & (date <= x.to_))
    found = obs.join(known, on, "left").withColumn("mine_", mine).withColumn("exact_", exact)
    n = F.lit(0) if overrides is None else F.coalesce(F.size("mine_"), F.lit(0))
    tier = F.when(n > 0, "OVERRIDE").when(F.size("exact_") > 0, "EXACT").when((isin == "") & (F.size("ids_") > 0), "SYMBOL")
    of = lambda c: F.transform(c, lambda x: x.security_id)
    within = F.filter("exact_", holds) if dated else F.col("exact_")
    pick = F.when(F.col("tier") == "EXACT", of(within)).when(F.col("tier") == "SYMBOL", of(ids))
    if overrides is not None:
        one = F.get("mine_", F.lit(0)).target_
        pick = F.when((F.col("tier") == "OVERRIDE") & (F.size("mine_") == 1), of(F.filter(one, holds))).when(F.col("tier") == "OVERRIDE", F.array().cast("array<string>")).otherwise(pick)
    rows = found.withColumn("tier", tier).withColumn("rows_", F.coalesce(pick, F.array().cast("array<string>")))
    only = F.when(F.size("rows_") == 1, F.get("rows_", F.lit(0)))
    return rows.select(*[found[c] for c in obs.columns], "tier", F.array_sort(F.array_distinct("rows_")).alias("candidate_ids"), only.alias("security_id"))


def unresolved_observations(resolved: DataFrame) -> DataFrame:
    return resolved.where("security_id is null").withColumn("finding", F.when(F.size("candidate_ids") > 0, "IDENTITY_AMBIGUOUS").otherwise("IDENTITY_MISSING"))


def id_migration(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new ids by the full source key, with the reason."""
    key = ["exchange", "symbol", "series", "first_seen", "last_seen"]
    a = old.select(*key, F.coalesce("candidate_isin", F.lit("")).alias("isin_"), F.col("security_id").alias("old_security_id"))
    b = new.select(*key, F.coalesce("candidate_isin", F.lit("")).alias("isin_"), F.col("security_id").alias("new_security_id"))
    same = F.col("old_security_id") == F.col("new_security_id")
    return a.join(b, [*key, "isin_"]).select("symbol", "series", "first_seen", "last_seen", "old_security_id", "new_security_id", F.when(same, "UNCHANGED").otherwise("ADJACENT_SOURCE_IDENTITY_CONTINUITY").alias("reason"))


def name_history(master: DataFrame) -> DataFrame:
    return master.where("company_name is not null").select("issuer_id", "company_name", "effective_from", "effective_to").distinct()


def isin_history(master: DataFrame) -> DataFrame:
    return master.where("isin is not null").select("security_id", "isin", "effective_from", "effective_to").distinct()


def issuer_master(master: DataFrame) -> DataFrame:
    return master.groupBy("issuer_id").agg(F.array_sort(F.collect_set("company_name")).alias("company_names"), F.min("first_seen").alias("first_observed_date"), F.max("last_seen").alias("last_observed_date"), F.when(F.count("isin") > 0, "SINGLE_OFFICIAL_SOURCE").otherwise("PARTIAL").alias("identity_quality"))


def listing_episodes(master: DataFrame) -> DataFrame:
    first = master.agg(F.min("first_seen").alias("start_"))
    e = master.groupBy("listing_episode_id").agg(F.min_by("security_id", F.struct("first_seen", "security_id")).alias("security_id"), F.min("first_seen").alias("start_date"), F.max("last_seen").alias("end_date"))
    return e.crossJoin(F.broadcast(first)).withColumn("listing_history_left_censored", F.col("start_date") == F.col("start_")).withColumn("start_reason", F.when(F.col("listing_history_left_censored"), "LISTING_HISTORY_LEFT_CENSORED").otherwise("FIRST_OBSERVED_TRADE")).drop("start_")


def reclassify(master: DataFrame, prices: DataFrame) -> DataFrame:
    """``(security_id, instrument_type)``: a single type other than ordinary wins, several are UNKNOWN."""
    kinds = master.select("security_id", "instrument_type").unionByName(prices.select("security_id", "instrument_type"))
    odd = F.collect_set(F.when(F.col("instrument_type") != "ORDINARY_EQUITY", F.col("instrument_type")))
    return kinds.groupBy("security_id").agg(odd.alias("k")).select("security_id", F.when(F.size("k") == 0, "ORDINARY_EQUITY").when(F.size("k") == 1, F.get("k", F.lit(0))).otherwise("UNKNOWN").alias("instrument_type"))


def symbol_history(identities: DataFrame) -> DataFrame:
    return identities.select("security_id", "symbol", "series", "effective_from", "effective_to")
