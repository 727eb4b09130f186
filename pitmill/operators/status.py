"""Trading status as non-overlapping intervals, terminal events and suspension notices."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitmill.functions.text import compact_name
from pitmill.operators.intervals import holders, last_and_next, overlay_intervals
from pitmill.operators.matching import names_within
from pitmill.plans.numbering import numbered
from pitmill.plans.staging import stage

_ATTRS = ["trading_status", "status_quality", "source_reference"]


def latest_row(master: DataFrame, key: str = "security_id", order: str = "last_seen") -> DataFrame:
    """The row of each key that was seen last; ties go to the later start, then the greater symbol."""
    rest = [c for c in master.columns if c != key]
    return master.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(order, "first_seen", "symbol")).alias("r")).select(key, *[F.col(f"r.{c}").alias(c) for c in rest])


def status_intervals(master: DataFrame, terminal_events: DataFrame, coverage_end=None, full_history: bool = False) -> DataFrame:
    """ACTIVE_TRADING until the last observation or the day before an official delisting, then DELISTED, UNKNOWN_STATUS or nothing.

    Intervals begin at the latest row's first date; with ``full_history`` at the entity's earliest.
    """
    last = latest_row(master)
    if full_history:
        last = last.drop("first_seen").join(master.groupBy("security_id").agg(F.min("first_seen").alias("first_seen")), "security_id")
    end = master.agg(F.max("last_seen").alias("end_")) if coverage_end is None else master.sparkSession.range(1).select(F.lit(coverage_end).cast("date").alias("end_"))
    official = terminal_events.where("security_id is not null and terminal_event_type = 'COMPULSORY_DELISTING' and event_quality = 'OFFICIAL_NSE_NOTICE' and terminal_event_date is not null")
    first = official.groupBy("security_id").agg(F.min(F.struct("terminal_event_date", "event_id")).alias("e"))
    rows = last.join(first, "security_id", "left").crossJoin(F.broadcast(end))
    start = F.greatest("e.terminal_event_date", F.date_add("last_seen", 1))
    gone, gap = F.col("e").isNotNull(), F.col("last_seen") < F.col("end_")
    piece = lambda s, e, status, quality, ref: F.struct(s.alias("status_start"), e.alias("status_end"), F.lit(status).alias("trading_status"), F.lit(quality).alias("status_quality"), ref.alias("source_reference"))
    none = F.lit(None).cast("string")
    pieces = F.array_compact(F.array(
        piece(F.col("first_seen"), F.when(gone, F.date_sub(start, 1)).otherwise(F.col("last_seen")), "ACTIVE_TRADING", "OBSERVED_TRADING_RECORD", none),
        F.when(gone & (start <= F.col("end_")), piece(start, F.lit(None).cast("date"), "DELISTED", "OFFICIAL_NSE_NOTICE", F.col("e.event_id"))),
        F.when(~gone & gap, piece(F.date_add("last_seen", 1), F.col("end_"), "UNKNOWN_STATUS", "OBSERVATION_GAP_ONLY", none)),
    ))
    return rows.select("security_id", "listing_episode_id", "symbol", F.explode(pieces).alias("p")).select("security_id", "listing_episode_id", "symbol", "p.*")


def suspension_overlay(base: DataFrame, notices: DataFrame, prices: DataFrame) -> DataFrame:
    """SUSPENDED from each start notice to the day before the entity's next trade, laid over ``base``.

    A notice without a later trade changes nothing. Of overlapping notices the later one holds.
    """
    starts = notices.where("event_type = 'SUSPENSION_START' and security_id is not null and effective_date is not null")
    days = last_and_next(starts.select("security_id", "effective_date").distinct(), prices.select("security_id", "date"), "security_id", "effective_date", [])
    trade = starts.select("evidence_id", "security_id", "effective_date").distinct().join(days.select("security_id", "effective_date", F.col("next.date").alias("next_")), ["security_id", "effective_date"]).where("next_ is not null")
    patches = trade.where("next_ > effective_date").select(
        "security_id", F.col("effective_date").alias("status_start"), F.date_sub("next_", 1).alias("status_end"), F.struct("effective_date", "evidence_id").alias("priority"),
        F.lit("SUSPENDED").alias("trading_status"), F.lit("OFFICIAL_NSE_SUSPENSION_NOTICE_EXACT_IDENTITY").alias("status_quality"), F.col("evidence_id").alias("source_reference"))
    return overlay_intervals(base, patches, _ATTRS)


def unknown_terminal_events(master: DataFrame, coverage_end=None) -> DataFrame:
    """An unresolved event for every entity last seen before the end of coverage; ids count all entities in order."""
    last = master.groupBy("security_id").agg(F.max(F.struct("last_seen", "symbol", "issuer_id")).alias("m")).select("security_id", "m.*")
    # numbered within ranges of entities, whose sizes give the numbers before; staged, so that the ranges stay
    ranged = stage(last.repartitionByRange("security_id").withColumn("p_", F.spark_partition_id()), "entities")
    sizes = ranged.groupBy("p_").agg(F.count("*").alias("k_"))
    before = sizes.withColumn("before_", F.sum("k_").over(Window.orderBy("p_")) - F.col("k_")).drop("k_")  # one row a range
    end = ranged.agg(F.max("last_seen").alias("end_")) if coverage_end is None else master.sparkSession.range(1).select(F.lit(coverage_end).cast("date").alias("end_"))
    numbered = ranged.withColumn("n_", F.row_number().over(Window.partitionBy("p_").orderBy("security_id")) - 1)
    numbered = numbered.join(F.broadcast(before), "p_").withColumn("n_", F.col("n_") + F.col("before_")).crossJoin(F.broadcast(end))
    return numbered.where("last_seen < end_").select(F.format_string("OBS_GAP_%06d", "n_").alias("event_id"), "security_id", "issuer_id", F.col("last_seen").alias("terminal_event_date"), F.col("symbol").alias("historical_symbol"), F.lit("UNKNOWN_TERMINAL_EVENT").alias("terminal_event_type"), F.lit("UNRESOLVED").alias("event_quality"))


def resolve_by_symbol(events: DataFrame, master: DataFrame, symbol: str = "historical_symbol", date: str = "terminal_event_date") -> DataFrame:
    """Events with the only entity whose symbol span holds the date, else the only one that ever had the symbol."""
    spans = master.select(F.col("symbol").alias(symbol), "security_id", "effective_from", "effective_to")
    valid = holders(events, spans, symbol, date, "security_id").withColumnsRenamed({"least": "valid_id", "most": "valid_most_"})
    ever = spans.groupBy(symbol).agg(F.min("security_id").alias("any_id"), F.max("security_id").alias("any_most_"))
    found = events.join(valid, [symbol, date], "left").join(ever, symbol, "left")
    one, only = F.col("valid_id") == F.col("valid_most_"), F.col("valid_id").isNull() & (F.col("any_id") == F.col("any_most_"))
    how = F.when(one, "DATE_VALID_SYMBOL").when(only, "UNIQUE_SYMBOL").otherwise("UNRESOLVED")
    return found.select(*events.columns, F.when(one, F.col("valid_id")).when(only, F.col("any_id")).alias("resolved_id"), how.alias("identity_match"))


@dataclass(frozen=True)
class NoticeSource:
    """A table of companies that left the exchange, with the names of its columns; ``order`` says in what order its rows are numbered."""

    rows: DataFrame
    symbol: str
    company_name: str
    event_type: str
    source: str
    order: tuple[str, ...]
    date: str | None = None
    notes: str | None = None


#: Fixed value: the prefix of running event ids.
TERM_ID = "NSE_TERM_"


def _letters(c: str | Column) -> Column:
    return F.regexp_replace(F.upper(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))), "[^A-Z0-9]", "")


def normalize_terminal_events(sources: list[NoticeSource], master: DataFrame, earlier: DataFrame | None = None) -> DataFrame:
    """One event table of sources of several shapes, with running ids, linked to the only entity of the symbol (letters and digits) on the date.

    Where no span of the symbol holds the date, or there is none, all its entities are candidates. Ids continue after the last one in ``earlier``, whose
    rows keep theirs and come first; the new rows are numbered source by source, each in its order, by ranges that tasks number side by side.
    """
    parts = []
    for k, s in enumerate(sources):
        day = F.col(s.date).cast("date") if s.date else F.lit(None).cast("date")
        made = s.rows.select(
            F.struct(*s.order).alias("order_"), day.alias("terminal_event_date"), F.col(s.symbol).alias("historical_symbol"), F.col(s.company_name).alias("company_name"),
            F.lit(s.event_type).alias("terminal_event_type"), F.lit(s.source).alias("source"), F.lit(s.notes).cast("string").alias("notes"))
        parts.append(numbered(made.repartitionByRange("order_").sortWithinPartitions("order_"), f"source-{k}", "n_").drop("order_").withColumn("k_", F.lit(k)))
    rows = reduce(DataFrame.unionByName, parts)
    first = 0
    if earlier is not None:
        first = (earlier.agg(F.max(F.regexp_extract("event_id", f"^{TERM_ID}([0-9]+)$", 1).try_cast("long")).alias("m")).first()["m"] + 1) if not earlier.isEmpty() else 0
    starts = []
    for r in sorted(rows.groupBy("k_").agg(F.count("*").alias("n")).collect()):  # a row a source
        starts.append((r["k_"], first))
        first += r["n"]
    start = F.broadcast(master.sparkSession.createDataFrame(starts, "k_ int, start_ long"))
    spans = master.select(_letters("symbol").alias("s_"), "security_id", "effective_from", "effective_to")
    rows = rows.join(start, "k_").withColumn("s_", _letters("historical_symbol"))
    valid = holders(rows, spans, "s_", "terminal_event_date", "security_id")
    ever = spans.groupBy("s_").agg(F.min("security_id").alias("any_"), F.max("security_id").alias("any_most_"))
    found = rows.join(valid, ["s_", "terminal_event_date"], "left").join(ever, "s_", "left")
    least, most = F.coalesce("least", "any_"), F.coalesce("most", "any_most_")
    one = F.coalesce(least == most, F.lit(False))
    number = F.col("start_") + F.col("n_")
    out = found.select(
        F.concat(F.lit(TERM_ID), F.lpad(number.cast("string"), F.greatest(F.lit(6), F.length(number.cast("string"))), F.lit("0"))).alias("event_id"), F.when(one, least).alias("security_id"), F.lit(None).cast("string").alias("issuer_id"),
        "terminal_event_date", "historical_symbol", "company_name", "terminal_event_type", F.lit(None).cast("double").alias("terminal_value"), F.lit(None).cast("string").alias("terminal_value_basis"), F.lit("UNKNOWN").alias("terminal_value_quality"),
        F.when(one, "OFFICIAL_NSE_NOTICE").otherwise("IDENTITY_REVIEW_REQUIRED").alias("event_quality"), F.when(one, "SYMBOL_DATE_MATCH").otherwise("IDENTITY_REVIEW_REQUIRED").alias("identity_match_quality"), "source", "notes")
    return out if earlier is None else earlier.select(*out.columns).unionByName(out)


def enrich_terminal_events(events: DataFrame, master: DataFrame) -> DataFrame:
    """Unlinked terminal events take the only ordinary entity of their symbol, if it was last seen before them."""
    ids = master.where("exchange = 'NSE' and instrument_type = 'ORDINARY_EQUITY'").groupBy(F.col("symbol").alias("s_")).agg(F.count_distinct("security_id").alias("n_"), F.min("security_id").alias("i_"), F.max("last_seen").alias("l_"))
    both = events.join(ids, F.col("historical_symbol") == F.col("s_"), "left")
    hit = F.coalesce(F.col("security_id").isNull() & F.col("terminal_event_type").isin("COMPULSORY_DELISTING", "VOLUNTARY_DELISTING", "UNKNOWN_TERMINAL_EVENT") & (F.col("n_") == 1) & (F.col("l_") < F.col("terminal_event_date")), F.lit(False))
    return both.withColumns({"identity_match_quality": F.when(hit, "EXACT_SYMBOL_AFTER_OBSERVED_COVERAGE"), "event_quality": F.when(hit, "OFFICIAL_NSE_NOTICE").otherwise(F.col("event_quality")), "security_id": F.when(hit, F.col("i_")).otherwise(F.col("security_id"))}).drop("s_", "n_", "i_", "l_")


def delisting_overlay(base: DataFrame, events: DataFrame) -> DataFrame:
    """The interval that holds a delisting is cut there; its rest is DELISTED."""
    e = events.where("security_id is not null and terminal_event_date is not null").select("security_id", "terminal_event_date", "event_id")
    on = (F.col("security_id") == F.col("k_")) & (F.col("terminal_event_date") >= F.col("status_start")) & (F.col("status_end").isNull() | (F.col("terminal_event_date") <= F.col("status_end")))
    held = e.withColumnRenamed("security_id", "k_").join(base.select("security_id", "status_start", "status_end"), on)
    patches = held.select("security_id", F.col("terminal_event_date").alias("status_start"), "status_end", F.struct("terminal_event_date", "event_id").alias("priority"), F.lit("DELISTED").alias("trading_status"), F.lit("OFFICIAL_NSE_DELISTING_NOTICE_EXACT_SYMBOL").alias("status_quality"), F.col("event_id").alias("source_reference"))
    return overlay_intervals(base, patches, _ATTRS)


def names_in_texts(texts: DataFrame, names: DataFrame, id_col: str, text_col: str, name_col: str, least: int = 8) -> DataFrame:
    """``(id, name)`` of every normalised name of at least ``least`` characters in a text, on word bounds."""
    from pitmill.functions.text import normalize_name

    n = names.select(normalize_name(F.col(name_col)).alias("name")).where(F.length("name") >= least)
    return names_within(texts.select(id_col, normalize_name(F.col(text_col)).alias("t_")), id_col, "t_", n)


def resolve_notices(notices: DataFrame, master: DataFrame, id_col: str = "doc_id", text_col: str = "body") -> DataFrame:
    """Suspension notices linked to the only issuer whose whole name they hold; null where there is none or several."""
    from pitmill.functions.text import effective_date, normalize_name, suspension_type

    hit = names_in_texts(notices, master, id_col, text_col, "company_name")
    ids = master.select(normalize_name(F.col("company_name")).alias("name"), "security_id").distinct()
    one = hit.join(ids, "name").groupBy(id_col).agg(F.count_distinct("security_id").alias("n_"), F.min("security_id").alias("security_id"))
    body = F.col(text_col)
    return notices.select(id_col, suspension_type(body).alias("event_type"), effective_date(body).alias("effective_date"), text_col).join(one, id_col, "left").withColumn("security_id", F.when(F.col("n_") == 1, F.col("security_id"))).drop("n_", text_col)


def suspension_event_blocks(notices: DataFrame, master: DataFrame, id_col: str = "doc_id", text_col: str = "body", published_col: str | None = None, focus: int = 1400, least: int = 8) -> DataFrame:
    """Event table of the press releases that change a status: type, effective date, and the only entity whose name their first ``focus`` characters hold.

    Names and releases are compared as letters and digits only; the entity must have been seen on the effective date (or the page's date,
    where the release names none). Names shorter than ``least`` don't count.
    """
    from pitmill.functions.text import block_type, effective_date, explode_blocks

    blocks = explode_blocks(notices, id_col, text_col).withColumn("evidence_id", F.concat(F.col(id_col).cast("string"), F.lit("_BLOCK_"), F.lpad(F.col("block_no").cast("string"), F.greatest(F.lit(2), F.length(F.col("block_no").cast("string"))), F.lit("0"))))
    if published_col:
        blocks = blocks.join(notices.select(id_col, F.col(published_col).cast("date").alias("published_date")), id_col)
    else:
        blocks = blocks.withColumn("published_date", F.lit(None).cast("date"))
    events = blocks.select("evidence_id", id_col, "block_no", block_type(F.col("block")).alias("event_type"), effective_date(F.col("block")).alias("effective_date"), "published_date", compact_name(F.substring("block", 1, focus)).alias("focus"))
    names = master.select(compact_name(F.col("company_name")).alias("name"), "security_id", "first_seen", "last_seen").where(F.length("name") >= least).distinct()
    hits = names_within(events, "evidence_id", "focus", names, least=least)
    points = hits.join(events.select("evidence_id", F.coalesce("effective_date", "published_date").alias("point")), "evidence_id")
    # a name may be many entities': only the ends of those seen on a date meet the releases, however many there are
    seen = holders(points, names, "name", "point", "security_id", "first_seen", "last_seen")
    one = points.join(seen, ["name", "point"]).groupBy("evidence_id").agg(F.min("least").alias("security_id"), F.max("most").alias("most_"))
    unique = F.coalesce(F.col("security_id") == F.col("most_"), F.lit(False))
    return events.join(one, "evidence_id", "left").select(
        "evidence_id", id_col, "block_no", "event_type", "effective_date", F.when(unique, F.col("security_id")).alias("security_id"),
        F.when(unique, "EXACT_NAME_BLOCK_DATE_MATCH").otherwise("EVENT_LEVEL_IDENTITY_REVIEW_REQUIRED").alias("identity_match_quality"))
