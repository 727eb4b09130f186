"""Point-in-time audits by scenarios: a result up to a date must not change with what comes after it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitmill.plans.staging import mark, release, stage

Tables = dict[str, DataFrame]
Operator = Callable[[Tables], DataFrame]


def _cut(at):
    return F.lit(at).cast("date")


def future_listing(t: Tables, at) -> Tables:
    """After the date every entity has a twin that was never seen before."""
    p = t["prices"].where(F.col("date") > _cut(at))
    twin = p.withColumns({"security_id": F.concat(F.lit("NEW_"), "security_id"), "symbol_at_date": F.concat(F.lit("NEW_"), "symbol_at_date")})
    return t | {"prices": t["prices"].unionByName(twin)}


def changed_values(t: Tables, at) -> Tables:
    """After the date prices, volumes and traded values are other ones."""
    later = F.col("date") > _cut(at)
    values = {c: F.when(later, F.col(c) * 7 + 1).otherwise(F.col(c)).cast(t["prices"].schema[c].dataType) for c in ("raw_close", "volume", "traded_value") if c in t["prices"].columns}
    return t | {"prices": t["prices"].withColumns(values)}


def rename(t: Tables, at) -> Tables:
    """The day after the date every entity goes on under another symbol: spells that hold the date end with it, and others begin."""
    s = t["symbols"]
    holds = (F.col("effective_from") <= _cut(at)) & (F.col("effective_to").isNull() | (F.col("effective_to") > _cut(at)))
    old = s.withColumn("effective_to", F.when(holds, _cut(at)).otherwise(F.col("effective_to")))
    new = s.where(holds).withColumns({"symbol": F.concat("symbol", F.lit("_RENAMED")), "effective_from": F.date_add(_cut(at), 1)})
    prices = t["prices"].withColumn("symbol_at_date", F.when(F.col("date") > _cut(at), F.concat("symbol_at_date", F.lit("_RENAMED"))).otherwise(F.col("symbol_at_date")))
    return t | {"symbols": old.unionByName(new), "prices": prices}


def symbol_reuse(t: Tables, at) -> Tables:
    """The day after the date every symbol that is in use goes to an entity that was never seen before."""
    s = t["symbols"]
    holds = (F.col("effective_from") <= _cut(at)) & (F.col("effective_to").isNull() | (F.col("effective_to") > _cut(at)))
    old = s.withColumn("effective_to", F.when(holds, _cut(at)).otherwise(F.col("effective_to")))
    new = s.where(holds).withColumns({"security_id": F.concat(F.lit("REUSE_"), "security_id"), "effective_from": F.date_add(_cut(at), 1)})
    return t | {"symbols": old.unionByName(new)}


def dead_entity(t: Tables, at) -> Tables:
    """Every entity stops trading with the date: no row, no event and no spell after it."""
    s = t["symbols"]
    ended = s.where(F.col("effective_from") <= _cut(at)).withColumn("effective_to", F.when(F.col("effective_to").isNull() | (F.col("effective_to") > _cut(at)), _cut(at)).otherwise(F.col("effective_to")))
    return t | {"prices": t["prices"].where(F.col("date") <= _cut(at)), "events": t["events"].where(F.col("event_date") <= _cut(at)), "symbols": ended}


def future_action(t: Tables, at) -> Tables:
    """After the date every event has a second one of half the factor."""
    later = t["events"].where(F.col("event_date") > _cut(at))
    again = later.withColumns({"event_id": F.concat("event_id", F.lit("_AGAIN")), "price_factor": F.col("price_factor") / 2})
    return t | {"events": t["events"].unionByName(again)}


SCENARIOS: dict[str, Callable[[Tables, object], Tables]] = {f.__name__: f for f in (future_listing, changed_values, rename, symbol_reuse, dead_entity, future_action)}


def _row_hash(x: DataFrame):
    names = sorted(x.columns)
    return F.xxhash64(*[F.coalesce(x[c].cast("string"), F.lit("\0")) for c in names], *[x[c].isNull() for c in names])


def _hashes(x: DataFrame) -> DataFrame:
    return x.select(_row_hash(x).alias("h"))


def _differing(a: DataFrame, b: DataFrame) -> DataFrame:
    both = a.withColumn("n", F.lit(1)).unionByName(b.withColumn("n", F.lit(-1)))
    return both.groupBy("h").agg(F.abs(F.sum("n")).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("leaking_rows"))


def differing_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One number, ``leaking_rows``: rows of ``a`` and ``b`` that the other lacks, as often as it lacks them. Only hashes of rows are shuffled."""
    return _differing(_hashes(a), _hashes(b))


def _summed(hashes: DataFrame) -> tuple:
    return tuple(hashes.agg(F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(20,0)"))).first())


def digest(rows: DataFrame) -> tuple:
    """How many rows there are and the sum of their hashes: alike for tables of the same rows in any order. No row is shuffled."""
    return _summed(_hashes(rows))


class _Reads(dict):
    """Tables that remember which of them an operator asked for."""

    def __init__(self, tables: Tables):
        super().__init__(tables)
        self.seen: set[str] = set()

    def __getitem__(self, name):
        self.seen.add(name)
        return super().__getitem__(name)

    def __iter__(self):
        self.seen.update(super().keys())
        return super().__iter__()

    def get(self, name, default=None):
        return self[name] if name in self else default

    def items(self):
        self.seen.update(super().keys())
        return super().items()

    def values(self):
        self.seen.update(super().keys())
        return super().values()


def _plan(df: DataFrame):
    return df._jdf.queryExecution().optimizedPlan()


def _plain(df: DataFrame) -> bool:
    """Whether ``df`` only picks and renames rows of files, so that reading it costs what a copy would."""
    def walk(p) -> bool:
        kids = p.children()
        return p.nodeName() in ("Project", "Filter", "Union", "LogicalRelation", "LocalRelation") and all(walk(kids.apply(k)) for k in range(kids.size()))

    plan = _plan(df)
    return plan.deterministic() and walk(plan)


def leakage_report(operators: dict[str, Operator], tables: Tables, at, scenarios: dict[str, Callable[[Tables, object], Tables]] = SCENARIOS, date: str = "date") -> DataFrame:
    """``(operator, scenario, leaking_rows)``: for each operator and scenario how many rows of its result up to ``at`` differ between the tables and the changed ones.

    ``tables``: ``prices``, ``symbols`` (effective-dated) and ``events``. Tables, and each scenario's changes to them, are written once unless they only pick
    rows and columns of files; of a result up to the date the hashes of its rows are written once an operator. An operator that asks for none of the tables that a scenario
    changes has the same inputs and is not run again, nor is one whose optimised plan over the changed tables is the plan over the tables, as it reads no changed column (it must be deterministic). Results are compared by their
    digests, and rows are counted only where these differ, at once for an operator that was found to leak before. Scenarios run one after the other, and what one has written is deleted when its numbers are known.
    """
    spark = next(iter(tables.values())).sparkSession
    begun = mark()
    held = {k: v if _plain(v) else stage(v, f"audit-{k}") for k, v in tables.items()}
    upto = lambda df: df.where(F.col(date) <= _cut(at))
    before = {}
    for name, op in operators.items():
        asked = _Reads(held)
        result = upto(op(asked))
        hashes = stage(_hashes(result), f"before-{name}")
        before[name] = (_plan(result), hashes, _summed(hashes), asked.seen)
    rows, leaked = [], set()
    for scenario, change in scenarios.items():
        own = mark()
        changed = change(held, at)
        other = {k for k, v in changed.items() if v is not held.get(k)}
        pair = {k: stage(v, f"{scenario}-{k}") if k in other and not _plain(v) else v for k, v in changed.items()}
        for name, op in operators.items():
            plan, hashes, known, seen = before[name]
            leaking = 0
            if seen & other:
                after = upto(op(pair))
                if not _plan(after).sameResult(plan) and (name in leaked or digest(after) != known):
                    leaking = _differing(hashes, _hashes(after)).first()["leaking_rows"]
                    leaked.add(name)
            rows.append((name, scenario, leaking))
        release(spark, own)
    release(spark, begun)
    return spark.createDataFrame(rows, "operator string, scenario string, leaking_rows long")
