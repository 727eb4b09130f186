"""Corporate actions: subjects to factors, factors to adjusted prices, and boundary validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitmill.operators.calendar import number_sessions
from pitmill.operators.intervals import last_and_next

_NUM = r"(\d+(?:\.\d+)?)"
#: The ways in which a subject states an old and a new face value, in order of trust.
FACE_PATTERNS = (
    rf"FROM(?:\s+FACE\s+VALUE)?\s*(?:R[SE]\.?)?\s*{_NUM}\s*/?-?\D+TO(?:\s+FACE\s+VALUE)?\s*(?:R[SE]\.?)?\s*{_NUM}",
    rf"CONSOLIDATION.*?R[SE]\.?\s*{_NUM}\D+TO\s+R[SE]\.?\s*{_NUM}",
    rf"SPL(?:IT)?\s*[-:/ ]+\s*R[SE]\.?\s*{_NUM}\s*/?\s*TO\s*{_NUM}\s*/?",
    rf"FV\s+SPL\s*[-:/ ]+\s*{_NUM}\s*/?\s*TO\s*{_NUM}\s*/?",
)
#: Fixed values: (marks, label) of the plain subject classes, first fit wins.
SUBJECT_CLASSES = (
    (("SPLIT", "SUB-DIVISION"), "SPLIT"), (("CONSOLID",), "REVERSE_SPLIT"), (("RIGHT",), "RIGHTS"), (("DEMERGER",), "DEMERGER"),
    (("MERGER", "AMALGAM"), "MERGER"), (("SCHEME",), "SCHEME"), (("BUYBACK", "BUY BACK"), "BUYBACK"), (("DIV",), "DIVIDEND"), (("NAME",), "NAME_CHANGE"),
)


def classify_event(subject: Column) -> Column:
    """Event type of a subject line."""
    text = F.upper(subject)
    bonus = text.contains("BONUS") | text.rlike(r"\bBON\s*\d+\s*:\s*\d+")
    out = F.when(bonus & text.rlike("PREFERENCE|NCRPS"), "BONUS_PREFERENCE_SECURITY").when(bonus & ~text.contains("DEBENTURE"), "BONUS")
    for marks, label in SUBJECT_CLASSES:
        out = out.when(text.rlike("|".join(marks)), label)
    return out.otherwise("OTHER_OFFICIAL_ACTION")


def extract_ratio(subject: Column) -> Column:
    """Struct of ``raw``, ``numerator`` and ``denominator`` of the first ``a:b``, or of a bonus with words between; null without one."""
    text = F.upper(subject)
    plain, wordy = r"(\d+)\s*:\s*(\d+)", r"BONUS\s+(\d+)\s+(?:DVR\s+)?[^:]*:\s*(\d+)"
    of = lambda c, p: F.struct(F.regexp_extract(c, p, 0).alias("raw"), F.regexp_extract(c, p, 1).cast("long").alias("numerator"), F.regexp_extract(c, p, 2).cast("long").alias("denominator"))
    return F.when(subject.rlike(plain), of(subject, plain)).when(text.rlike(wordy), of(text, wordy))


def face_value_transition(subject: Column, event_type: Column) -> Column:
    """Array of the old and the new face value of a split, consolidation or bonus; null unless both are plain."""
    text = F.upper(subject)
    pair = F.coalesce(*[F.when(text.rlike(p), F.array(F.regexp_extract(text, p, 1), F.regexp_extract(text, p, 2))) for p in FACE_PATTERNS], F.regexp_extract_all(text, F.lit(rf"R[SE]\.?\s*{_NUM}"), F.lit(1)))
    values = F.transform(pair, lambda x: x.cast("double"))
    fits = event_type.isin("SPLIT", "REVERSE_SPLIT", "BONUS") & (F.size(values) == 2) & F.forall(values, lambda x: x > 0)
    return F.when(fits, values)


def dividend(subject: Column, face_value: Column, event_type: Column) -> Column:
    """Struct of ``amount`` and ``quality``: rupee amounts summed, else percentages of the face value; null without either."""
    text = F.upper(subject)
    numbers = lambda p: F.transform(F.regexp_extract_all(text, F.lit(p), F.lit(1)), lambda x: x.cast("double"))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    rupees, percents, face = numbers(rf"RS\.?\s*{_NUM}"), numbers(rf"{_NUM}\s*%"), face_value.try_cast("double")
    made = F.when(F.size(rupees) > 0, F.struct(total(rupees).alias("amount"), F.lit("OFFICIAL_SUBJECT_RUPEE_AMOUNT").alias("quality")))
    made = made.when((F.size(percents) > 0) & (face > 0), F.struct((face * total(percents) / 100.0).alias("amount"), F.lit("OFFICIAL_FACE_VALUE_PERCENT").alias("quality")))
    return F.when(event_type == "DIVIDEND", made)


def composite_rights_factor(cum_price: Column, bonus: Column, rights: Column, subscription: Column) -> Column:
    """Price factor of a bonus with rights; null for a price that isn't positive."""
    return F.when(cum_price > 0, (cum_price + rights * subscription) / (1.0 + bonus + rights) / cum_price)


def selective_bonus_factor(before: Column, after: Column) -> Column:
    return F.when((before > 0) & (after > 0), before / after)


def normalize_actions(raw: DataFrame, master: DataFrame, resolutions: DataFrame | None = None, prefix: str = "CA_") -> DataFrame:
    """Typed events with factors, linked to entities by ISIN and overlaid with reviewed resolutions.

    ``raw``: ordinal, series, symbol, isin, ex_date, record_date, face_value, subject. EQ rows with a
    date only. Of several entities under one ISIN the smallest id counts.
    """
    isin = master.where("isin is not null and series = 'EQ'").groupBy("isin").agg(F.min("security_id").alias("security_id"))
    rows = raw.where("series = 'EQ'").withColumn("subject", F.trim(F.coalesce("subject", F.lit("")))).withColumn("event_date", F.coalesce("ex_date", "record_date")).where("event_date is not null")
    rows = rows.withColumn("event_type", classify_event(F.col("subject"))).withColumns({"r_": extract_ratio(F.col("subject")), "f_": face_value_transition(F.col("subject"), F.col("event_type")), "d_": dividend(F.col("subject"), F.col("face_value"), F.col("event_type"))})
    kind, face = F.col("event_type"), F.get("f_", F.lit(1)) / F.get("f_", F.lit(0))
    mixed = kind.isin("BONUS", "SPLIT", "REVERSE_SPLIT") & F.upper("subject").contains("RIGHT")
    bonus = (F.col("r_.numerator") + F.col("r_.denominator")) / F.col("r_.denominator")
    share = F.when(mixed, None).when((kind == "BONUS") & (F.col("r_.denominator") != 0), bonus / F.coalesce(face, F.lit(1.0))).when(kind.isin("SPLIT", "REVERSE_SPLIT"), 1.0 / face)
    price = F.when(mixed, None).when((kind == "BONUS") & (F.col("r_.denominator") != 0), 1.0 / bonus * F.coalesce(face, F.lit(1.0))).when(kind.isin("SPLIT", "REVERSE_SPLIT"), face)
    out = rows.join(isin, "isin", "left").select(
        F.concat(F.lit(prefix), F.col("ordinal").cast("string")).alias("event_id"), "security_id", "symbol", "isin", "event_type", "event_date", "ex_date", "record_date", "subject", "face_value",
        F.get("f_", F.lit(0)).alias("old_face_value"), F.get("f_", F.lit(1)).alias("new_face_value"),
        F.col("d_.amount").alias("cash_dividend_per_share"), F.col("d_.quality").alias("dividend_amount_quality"),
        F.col("r_.raw").alias("ratio_raw"), F.col("r_.numerator").alias("ratio_numerator"), F.col("r_.denominator").alias("ratio_denominator"),
        price.alias("price_factor"), share.alias("share_factor"),
        F.when(mixed, "FACTOR_REVIEW_REQUIRED").when(F.col("security_id").isNotNull(), "RESOLVED_BY_ISIN").otherwise("IDENTITY_REVIEW_REQUIRED").alias("review_status"),
        F.when(mixed, "UNSUPPORTED_COMPOSITE_RIGHTS_COMPONENT").alias("notes"),
    )
    return apply_resolutions(out, resolutions)


#: What a review states of an event beside its type and factors.
REVIEWED = {
    "classification_confidence": "string", "factor_quality": "string", "resolution_type": "string", "evidence_references": "array<string>", "rationale": "string",
    "bonus_ratio": "double", "rights_ratio": "double", "rights_subscription_price": "double", "post_share_count_per_old_share": "double", "cash_contribution_per_old_share": "double",
    "rights_entitlement_basis": "string", "bonus_ratio_numerator": "double", "bonus_ratio_denominator": "double", "eligibility_scope": "string", "pre_event_total_shares": "double",
    "post_event_total_shares": "double", "public_holder_share_factor": "double", "promoter_holder_share_factor": "double",
}


def invalid_resolutions(resolutions: DataFrame) -> DataFrame:
    """Resolutions that may not be applied, with the ``reason``: MISSING_EVENT_ID, NOT_APPROVED, NO_EVIDENCE, NO_RATIONALE or REPEATED (all but the last by ``ordinal``, where there is one)."""
    r = _with_reviewed(resolutions)
    status = F.col("review_status") if "review_status" in resolutions.columns else F.lit(None)
    times = F.count(F.lit(1)).over(Window.partitionBy("event_id"))
    if "ordinal" in resolutions.columns:
        times = F.row_number().over(Window.partitionBy("event_id").orderBy(F.desc("ordinal")))
    reason = (
        F.when(F.coalesce("event_id", F.lit("")) == "", "MISSING_EVENT_ID").when(F.coalesce(status != "APPROVED", F.lit(True)), "NOT_APPROVED")
        .when(F.size(F.coalesce("evidence_references", F.array().cast("array<string>"))) <= 0, "NO_EVIDENCE").when(F.trim(F.coalesce("rationale", F.lit(""))) == "", "NO_RATIONALE").when(times > 1, "REPEATED")
    )
    return r.withColumn("reason", reason).where("reason is not null").select(*resolutions.columns, "reason")


def _with_reviewed(resolutions: DataFrame) -> DataFrame:
    """``resolutions`` with every reviewed column, null where it states none."""
    return resolutions.withColumns({k: F.lit(None).cast(kind) for k, kind in REVIEWED.items() if k not in resolutions.columns})


def apply_resolutions(events: DataFrame, resolutions: DataFrame | None) -> DataFrame:
    """Reviewed types and factors replace derived ones where they are given, notes are joined, and the reviewed columns are added (null for events without a review).

    ``resolutions`` are approved ones, one an event (``invalid_resolutions`` tells the others).
    """
    if resolutions is None:
        return events.withColumns({k: F.lit(None).cast(kind) for k, kind in ({"review_classification": "string"} | _named(REVIEWED)).items()})
    r = _with_reviewed(resolutions).select("event_id", "resolved_event_type", "resolved_price_factor", "resolved_share_factor", "review_classification", F.lit(True).alias("found_"), *[F.col(k).cast(kind).alias(f"r_{k}") for k, kind in REVIEWED.items()])
    both = events.join(r, "event_id", "left")
    return both.withColumns({
        "event_type": F.coalesce("resolved_event_type", "event_type"), "price_factor": F.coalesce("resolved_price_factor", "price_factor"), "share_factor": F.coalesce("resolved_share_factor", "share_factor"),
        "review_status": F.when(F.col("found_"), F.coalesce("review_classification", "review_status")).otherwise(F.col("review_status")),
        "notes": F.nullif(F.concat_ws(";", "notes", "r_resolution_type"), F.lit("")),
    } | {name: F.col(f"r_{k}") for k, name in zip(REVIEWED, _named(REVIEWED), strict=True)}).drop("resolved_event_type", "resolved_price_factor", "resolved_share_factor", "found_", *[f"r_{k}" for k in REVIEWED])


def _named(columns: dict[str, str]) -> dict[str, str]:
    """The columns under the names that events have for them."""
    return {"review_rationale" if k == "rationale" else k: kind for k, kind in columns.items()}


def _scaled(x: Column, power: Column) -> Column:
    """``x`` times two to the ``power``, rounded once: in two steps, as the power itself may lie beyond the doubles."""
    p = F.greatest(F.least(power, F.lit(2040)), F.lit(-2140))
    half = F.floor(p / 2)
    return x * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), p - half)


def _factors_from(events: DataFrame, name: str) -> DataFrame:
    """``(security_id, date, {name}_factor_, {name}_count_)`` for each date of an entity's events: the product of the factors dated then or later, and how many there are.

    The running product is kept between 0.5 and 4 and its power of two apart, and rounded once where it is asked for: a product of many factors that passed
    the range of doubles on its way, or moved on within the denormal numbers, lost its digits.
    """
    order = Window.partitionBy("security_id").orderBy(F.desc("event_date"), "factor")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    size = F.abs("factor")
    e = events.select("security_id", "event_date", F.col("factor").cast("double").alias("factor"))
    e = e.withColumn("power_", F.floor(F.sum(F.when((size > 0) & (size < float("inf")), F.log2(size)).otherwise(0.0)).over(so_far)))
    e = e.withColumn("step_", F.col("power_") - F.lag("power_", 1, 0).over(order))
    e = e.withColumns({"held_": F.product(_scaled(F.col("factor"), -F.col("step_"))).over(so_far), "count_": F.row_number().over(order).cast("long"), "next_": F.lead(F.struct("event_date")).over(order)})
    last = e.where("next_ is null or not (next_.event_date <=> event_date)")
    return last.select("security_id", F.col("event_date").alias("date"), F.coalesce(_scaled(F.col("held_"), F.col("power_")), F.lit(1.0)).alias(f"{name}_factor_"), F.col("count_").alias(f"{name}_count_"))


def suffix_factors(rows: DataFrame, events: dict[str, DataFrame]) -> DataFrame:
    """``rows`` with, for each name in ``events``, ``{name}_factor``, the product of the factors of all events of the entity dated after the row, and ``{name}_count``, how many there are.

    The product runs along an entity's events ``(security_id, event_date, factor)`` once, from the end; then rows and the events' dates are laid together and sorted by
    entity and date, and a row takes what the next date has. The count points into the entity's list of events (``event_ids``): the last so many.
    """
    both = rows.withColumn("later_", F.lit(0))
    for name, e in events.items():
        both = both.unionByName(_factors_from(e, name).withColumn("later_", F.lit(1)), allowMissingColumns=True)
    # a row comes before the events of its own date, which don't count for it
    down = Window.partitionBy("security_id").orderBy(F.desc("date"), "later_").rowsBetween(Window.unboundedPreceding, 0)
    made = {f"{k}_{what}": F.coalesce(F.last(f"{k}_{what}_", ignorenulls=True).over(down), F.lit(none)) for k in events for what, none in (("factor", 1.0), ("count", 0))}
    return both.select(*rows.columns, "later_", *[c.alias(k) for k, c in made.items()]).where("later_ = 0").drop("later_")


def event_ids(rows: DataFrame, events: dict[str, DataFrame], separator: str | None = None) -> DataFrame:
    """``rows`` with ``{name}_ids`` for each name in ``events``: of the entity's events, by date, factor and id, the last ``{name}_count`` ones; with a ``separator`` as one text of those that are not null.

    Ids are put together by dates first, so that a task never holds the single events of an entity. What an entity has is kept once and meets its rows in one join; only then each row takes
    its end, of a text a stretch of bytes, so no ids of a row are sorted or sent. Ask for it only where ids are wanted.
    """
    parts = [e.select("security_id", F.lit(k).alias("name_"), "event_date", "factor", "event_id") for k, e in events.items()]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    own = {k: F.array_sort(F.collect_list(F.when(F.col("name_") == k, F.struct("factor", "event_id")))) for k in events}  # nulls are not collected
    if separator is None:
        day = {k: F.transform(x, lambda e: e.event_id) for k, x in own.items()}
    else:
        day = {k: F.array_join(F.transform(x, lambda e: F.concat(e.event_id, F.lit(separator))), "") for k, x in own.items()}
    days = both.groupBy("security_id", "event_date").agg(*[x.alias(f"{k}_day_") for k, x in day.items()], *[F.count_if(F.col("name_") == k).alias(f"{k}_n_") for k in events])
    if separator is None:
        lists = days.groupBy("security_id").agg(F.array_sort(F.collect_list(F.struct("event_date", *[f"{k}_day_" for k in events]))).alias("days_"))
        held = {f"{k}_list_": F.flatten(F.col(f"days_.{k}_day_")) for k in events}
    else:
        # with each date how many events and bytes there are from it on
        back = Window.partitionBy("security_id").orderBy(F.desc("event_date")).rowsBetween(Window.unboundedPreceding, 0)
        days = days.withColumns({f"{k}_n_": F.sum(f"{k}_n_").over(back) for k in events} | {f"{k}_b_": F.sum(F.octet_length(f"{k}_day_")).over(back) for k in events})
        lists = days.groupBy("security_id").agg(F.array_sort(F.collect_list(F.struct("event_date", *[f"{k}_{x}_" for k in events for x in ("day", "n", "b")]))).alias("days_"))
        held = {f"{k}_list_": F.array_join(F.col(f"days_.{k}_day_"), "").cast("binary") for k in events} | {f"{k}_{x}s_": F.col(f"days_.{k}_{x}_") for k in events for x in ("n", "b")}
    listed = lists.select(F.col("security_id").alias("k_"), *[x.alias(name) for name, x in held.items()])
    met = rows.join(listed, F.col("security_id") == F.col("k_"), "left")

    def end(k: str) -> Column:
        n = F.col(f"{k}_count")
        if separator is None:
            return F.when(n > 0, F.slice(f"{k}_list_", -n.cast("int"), n.cast("int"))).otherwise(F.array().cast("array<string>"))
        many = F.get(f"{k}_bs_", (F.array_position(f"{k}_ns_", n) - 1).cast("int")).cast("int")
        taken = F.substring(f"{k}_list_", F.octet_length(f"{k}_list_") - many + 1, many - len(separator.encode()))
        return F.when(n > 0, taken.cast("string")).otherwise("")

    return met.select(*rows.columns, *[end(k).alias(f"{k}_ids") for k in events])


def price_events(events: DataFrame) -> DataFrame:
    """``(security_id, event_date, event_id, factor)`` of the events that adjust prices."""
    return events.where("security_id is not null and price_factor > 0").select("security_id", "event_date", "event_id", F.col("price_factor").alias("factor"))


def _quality(count: str) -> Column:
    return F.when(F.col(count) > 0, "PRICE_ACTION_ADJUSTED_VERIFIED").otherwise("NO_ADJUSTMENT_REQUIRED").alias("adjustment_quality")


def price_adjustments(prices: DataFrame, events: DataFrame) -> DataFrame:
    """The price-return columns of ``adjust_prices`` without ids. Each row's depend on the events alone, so ``prices`` may be cut to the rows wanted; dividends, for which closes must be looked up, are left out."""
    made = suffix_factors(prices, {"price": price_events(events)})
    price = F.col("price_factor")
    return made.select(*prices.columns, price.alias("price_return_adjustment_factor"), (F.col("raw_close") * price).alias("price_return_adjusted_close"), _quality("price_count"), F.col("price_count").alias("source_event_count"))


def adjust_prices(prices: DataFrame, events: DataFrame, ids: bool = True, separator: str | None = None) -> DataFrame:
    """Prices with the factors of all later events, and of all later dividends with a positive close on their date.

    A dividend's factor is (close + amount) / close, which raises earlier prices; total-return
    quality is always partial. Events: security_id, event_date, event_id, event_type, price_factor,
    cash_dividend_per_share. The published schema has the ids of the events with each row, with a ``separator`` as texts; without ``ids`` it has how many they are.
    """
    priced = price_events(events)
    paid = events.where("security_id is not null and event_type = 'DIVIDEND' and cash_dividend_per_share >= 0")
    closes = prices.where("raw_close > 0").join(paid.select("security_id", F.col("event_date").alias("date")).distinct(), ["security_id", "date"], "left_semi")
    closes = closes.groupBy("security_id", F.col("date").alias("event_date")).agg(F.max("raw_close").alias("close"))
    paid = paid.join(closes, ["security_id", "event_date"]).select("security_id", "event_date", "event_id", ((F.col("close") + F.col("cash_dividend_per_share")) / F.col("close")).alias("factor"))
    both = suffix_factors(prices, {"price": priced, "total": paid})
    sources = ("price_count", "total_count")
    if ids:
        both = event_ids(both, {"price": priced, "total": paid}, separator)
        sources = ("price_ids", "total_ids")
    names = ("source_event_ids", "total_return_event_ids") if ids else ("source_event_count", "total_return_event_count")
    price, total = F.col("price_factor"), F.col("total_factor")
    return both.select(
        *prices.columns,
        price.alias("price_return_adjustment_factor"), (F.col("raw_close") * price).alias("price_return_adjusted_close"),
        _quality("price_count"),
        F.col(sources[0]).alias(names[0]),
        (price * total).alias("total_return_factor"), (F.col("raw_close") * price * total).alias("total_return_adjusted_close"),
        F.lit("TOTAL_RETURN_PARTIAL").alias("total_return_quality"), F.col(sources[1]).alias(names[1]),
    )


def adjust_as_of(prices: DataFrame, events: DataFrame, at, ids: bool = True) -> DataFrame:
    """As ``adjust_prices``, knowing only events up to ``at``."""
    return adjust_prices(prices, events.where(F.col("event_date") <= F.lit(at).cast("date")), ids)


def adjusted_history(adjusted: DataFrame, series: str) -> DataFrame:
    """``(security_id, date, adjusted_close)`` of the PRICE_RETURN or the TOTAL_RETURN series."""
    names = {"PRICE_RETURN": ["price_return_adjusted_close", "research_adjusted_close"], "TOTAL_RETURN": ["total_return_adjusted_close", "research_adjusted_close_total_return"]}
    if series not in names:
        raise ValueError(f"unknown series {series}")
    from pitmill.functions.fields import first_present

    return adjusted.select("security_id", "date", first_present(adjusted, names[series], "double").alias("adjusted_close"))


def validate_boundaries(events: DataFrame, prices: DataFrame, calendar: DataFrame, advisory: float = 0.15, hard: float = 0.25, max_sessions: int = 5) -> DataFrame:
    """For each priced event the last close before and the first price on or after its ex-date, their ratio and a status.

    Same-day events count together (product of factors). The prices of entities that have events are read once
    and sorted with the ex-dates: each takes the row before it and the row from it on.
    """
    sessions = number_sessions(calendar)
    e = events.withColumn("ex_date", F.coalesce("ex_date", "event_date")).where("security_id is not null and event_type in ('SPLIT', 'REVERSE_SPLIT', 'BONUS', 'BONUS_RIGHTS_COMPOSITE', 'SELECTIVE_BONUS') and price_factor is not null and share_factor is not null and ex_date is not null")
    days = e.groupBy("security_id", "ex_date").agg(
        F.product("price_factor").alias("boundary_price_factor"), F.product("share_factor").alias("boundary_share_factor"),
        F.count("*").alias("boundary_event_count"), F.array_join(F.array_sort(F.collect_list("event_id")), ", ").alias("boundary_event_ids"),
    )
    p = prices.select("security_id", "date", "raw_open", "raw_close").join(F.broadcast(sessions), "date", "left")
    sides = last_and_next(days.select("security_id", "ex_date"), p, "security_id", "ex_date", ["raw_open", "raw_close", "session_number"]).withColumnsRenamed({"before": "pre", "next": "post"})
    own = sessions.select(F.col("date").alias("ex_date"), F.col("session_number").alias("ex_session"))
    x = e.join(days, ["security_id", "ex_date"]).join(sides, ["security_id", "ex_date"], "left").join(F.broadcast(own), "ex_date", "left")
    x = x.withColumns({"pre_close": F.col("pre.raw_close"), "post_price": F.coalesce("post.raw_open", "post.raw_close"), "pre_gap": F.col("ex_session") - F.col("pre.session_number"), "post_gap": F.col("post.session_number") - F.col("ex_session")})
    x = x.withColumn("plain", F.when(F.col("pre_close") > 0, F.col("post_price") * F.col("boundary_share_factor") / F.col("pre_close")))
    drift = F.abs(F.col("plain") - 1.0)
    status = (
        F.when(F.col("pre_close").isNull() & F.col("post_price").isNull(), "NO_BOUNDARY_OBSERVATIONS").when(F.col("pre_close").isNull(), "NO_PRE_EVENT_OBSERVATION")
        .when(F.col("post_price").isNull(), "NO_POST_EVENT_OBSERVATION").when(F.col("pre_close") <= 0, "INVALID_PRE_EVENT_PRICE")
        .when((F.coalesce("pre_gap", F.lit(0)) > max_sessions) | (F.coalesce("post_gap", F.lit(0)) > max_sessions), "NO_LOCAL_BOUNDARY_OBSERVATION")
        .when(drift <= advisory, "PASS").when(drift <= hard, "ADVISORY_BOUNDARY_DRIFT").otherwise("WARNING_LARGE_BOUNDARY_MOVE")
    )
    x = x.withColumn("status", status).withColumn("cash", F.when(F.col("pre_close") > 0, (F.col("post_share_count_per_old_share") * F.col("post_price") - F.col("cash_contribution_per_old_share")) / F.col("pre_close")))
    x = x.withColumn("status", F.when(F.abs(F.col("cash") - 1.0) <= advisory, "PASS").otherwise(F.col("status")))
    large, review = F.col("status") == "WARNING_LARGE_BOUNDARY_MOVE", F.col("review_classification")
    return x.select(
        "event_id", "security_id", "event_type", "ex_date", F.col("pre.date").alias("pre_event_date"), F.col("pre_close").alias("pre_event_close"),
        F.col("post.date").alias("post_event_date"), F.col("post.raw_open").alias("post_event_open"), F.col("post.raw_close").alias("post_event_close"),
        F.coalesce("cash", "plain").alias("holder_value_ratio"), F.col("cash").alias("cash_aware_holder_value_ratio"),
        F.when((F.col("pre_close") > 0) & (F.col("price_factor") > 0), F.col("post_price") / (F.col("pre_close") * F.col("price_factor")) - 1.0).alias("residual_adjusted_return"),
        "boundary_price_factor", "boundary_share_factor", "boundary_event_count", "boundary_event_ids", F.col("pre_gap").alias("pre_event_session_gap"), F.col("post_gap").alias("post_event_session_gap"),
        F.when(large & (review == "VERIFIED_FACTOR_GENUINE_MARKET_MOVE"), "PASS_VERIFIED_GENUINE_MARKET_MOVE").when(large & review.isin("RESOLVED_COMPOSITE_ACTION", "RESOLVED_SELECTIVE_BONUS"), "PASS_REVIEWED_ECONOMIC_ACTION").otherwise(F.col("status")).alias("validation_status"),
    )


def return_outliers(adjusted: DataFrame, events: DataFrame, least: float = 0.4, extreme: float = 0.6) -> DataFrame:
    """Rows whose adjusted return from the entity's previous row exceeds ``least``: next to a material event, or for review by size.

    After an adjusted close of zero (factors of many events round to it) a return is infinite, or NaN if this row's is zero too; both exceed every bound.
    """
    by = Window.partitionBy("security_id").orderBy("date")
    now, before = F.col("price_return_adjusted_close"), F.lag("price_return_adjusted_close").over(by)
    from_zero = F.when(now > 0, float("inf")).when(now < 0, float("-inf")).otherwise(F.when(now.isNotNull(), float("nan")))
    ratio = F.when(before == 0, from_zero).otherwise(F.try_divide(now, before))
    r = adjusted.withColumns({"previous_date": F.lag("date").over(by), "adjusted_return": ratio - 1.0}).where(F.abs("adjusted_return") > least)
    material = events.where("security_id is not null and event_type in ('SPLIT', 'REVERSE_SPLIT', 'BONUS', 'BONUS_RIGHTS_COMPOSITE', 'SELECTIVE_BONUS')")
    near = material.select("security_id", F.explode(F.array(F.date_sub("event_date", 1), F.col("event_date"), F.date_add("event_date", 1))).alias("date")).distinct().withColumn("near", F.lit(True))
    label = F.when(F.col("near"), "CORPORATE_ACTION_ADJACENT").when(F.abs("adjusted_return") > extreme, "EXTREME_RETURN_GT_60_PCT_REVIEW").otherwise("EXTREME_RETURN_GT_40_PCT_REVIEW")
    return r.join(near, ["security_id", "date"], "left").select("security_id", "date", "previous_date", "adjusted_return", label.alias("classification"))
