"""Secret scans over an incremental ledger of blobs, in DataFrame operations only.

Every version of a text is addressed by the SHA-256 of its bytes. The ledger holds one row for each
blob and scan: the rules (``kind@version``) it was scanned with and the spans they found. A call
scans only the pairs of blob and rule version that the ledger lacks, each blob once however many
paths hold it, appends them, and joins the findings back to all paths.

Spans are code points, end exclusive, leftmost and not overlapping within a kind. They come from
the pieces between matches: a match begins where the pieces and matches before it end.

Defined results: null text is the empty blob; repeated paths each get their findings; a pair that two
calls at once have put in the ledger twice counts once; an empty
table gives an empty result; columns other than the paths and the text are ignored by ``find_secrets`` and
kept, whatever their names, by ``mask_secrets``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pitmill.plans.staging import maybe_broadcast, stage, staged_path


@dataclass(frozen=True)
class Rule:
    """``group``: the group (0: the match) that must be at least ``least`` code points long.

    ``guard``: a literal that every match holds, to skip texts early; ``hint``: a pattern that
    every match that counts holds.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    guard: str = ""
    hint: str = ""
    base: bool = False
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either, ("password", "passwd", "secret", "token"))) + f"|{_either('api')}_?{_either('key')}"
#: The contract's three kinds, in its order, then the added ones. No group is repeated (the JVM's matcher would recurse), and what may be
#: tried anew at every place of a run of its own letters has a bound (the header of a web token, the type of a key).
RULES = (
    Rule("assign", f"({_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12, base=True),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18, "AKIA", base=True),
    Rule("hex", "[0-9a-f]+", 0, 16, hint="[0-9a-f]{16}", base=True),
    Rule("pem", "-----BEGIN [A-Z0-9 ]{0,64}PRIVATE KEY-----", guard="PRIVATE KEY-----", version=2),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", guard="_"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", guard="xox"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}", guard="AIza"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,512}[.]eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}", guard="eyJ", version=2),
)
LEDGER = "blob binary, scanned array<string>, spans array<struct<start: long, ord: int, kind: string, rule: string, end: long>>"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger at ``path``; empty where nothing has been written yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LEDGER)


def _hits(rules: tuple[Rule, ...], seen: Column) -> Column:
    """Array of (ord, kind, rule, pieces, matches, groups) of the rules not in ``seen`` that match ``text``."""
    text, out = F.col("text"), []
    for i, rule in enumerate(rules):
        may = ~F.array_contains(seen, rule.key)
        if rule.guard:
            may = may & F.contains(text, F.lit(rule.guard))
        may = may & F.rlike(text, F.lit(rule.hint or rule.pattern))
        found = F.struct(
            F.lit(i).alias("ord"), F.lit(rule.kind).alias("kind"), F.lit(rule.key).alias("rule"), F.lit(rule.least).alias("least"),
            F.split(text, rule.pattern, -1).alias("pieces"),
            F.regexp_extract_all(text, F.lit(f"(?:{rule.pattern})"), F.lit(0)).alias("matches"),
            F.regexp_extract_all(text, F.lit(f"(?:{rule.pattern})"), F.lit(rule.group)).alias("groups"),
        )
        out.append(F.when(may, found))
    return F.array_compact(F.array(*out))


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Ledger rows for ``(blob, text, seen)``, distinct blobs with the rule keys they need no scan for."""
    keys = F.array(*[F.lit(r.key) for r in rules])
    hits = blobs.select("blob", F.explode(_hits(rules, F.col("seen"))).alias("h"))
    each = hits.select("blob", "h.ord", "h.kind", "h.rule", "h.least", F.posexplode(F.arrays_zip(
        F.transform("h.matches", F.length).alias("n"),
        F.transform("h.groups", F.length).alias("g"),
        F.transform("h.pieces", F.length).alias("gap"),
    ).alias("m"))).select("blob", "ord", "kind", "rule", "least", "pos", F.col("col.n").cast("long").alias("n"), "col.g", F.col("col.gap").cast("long").alias("gap"))
    so_far = Window.partitionBy("blob", "ord").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("start", F.sum("gap").over(so_far) + F.sum(F.coalesce("n", F.lit(0))).over(so_far) - F.coalesce("n", F.lit(0)))
    span = F.struct("start", "ord", "kind", "rule", (F.col("start") + F.col("n")).alias("end"))
    spans = placed.where("n is not null and g >= least").groupBy("blob").agg(F.collect_list(span).alias("spans"))
    return (
        blobs.select("blob", F.array_except(keys, "seen").alias("scanned"))
        .join(spans, "blob", "left")
        .select("blob", "scanned", F.coalesce("spans", F.expr("cast(array() as array<struct<start: long, ord: int, kind: string, rule: string, end: long>>)")).alias("spans"))
    )


def _blob(text_col: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))


def _of(ledger: DataFrame, versions: DataFrame, text_col: str) -> DataFrame:
    """The ledger's rows of the blobs in ``versions``."""
    return ledger.join(versions.select(_blob(text_col).alias("blob")).distinct(), "blob", "left_semi")


def _spans(ledger: DataFrame, keys: list[str]) -> DataFrame:
    """``(blob, spans)`` of the blobs with findings of the rules ``keys``; a pair that the ledger holds twice counts once."""
    ours = ledger.withColumn("spans", F.filter("spans", lambda s: s.rule.isin(keys))).where(F.size("spans") > 0)
    return ours.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("spans"))).alias("spans"))


def update_ledger(versions: DataFrame, path: str, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
    """Scan the pairs of blob and rule version in ``versions`` that the ledger at ``path`` lacks, and append them.

    What the ledger lacks is decided by blobs alone. Where that is little, only the texts of those blobs are taken to be sent
    by blob, so a call over what is known sends no text.
    """
    spark = versions.sparkSession
    text, keys = F.coalesce(F.col(text_col), F.lit("")), [r.key for r in rules]
    every = versions.select(_blob(text_col).alias("blob"), text.alias("text"))
    none = F.array().cast("array<string>")
    ledger = read_ledger(spark, path)
    if ledger.isEmpty():
        lacking = None
    else:
        blobs = every.select("blob").distinct()
        seen = ledger.join(blobs, "blob", "left_semi").select("blob", F.explode("scanned").alias("rule")).where(F.col("rule").isin(keys))
        seen = seen.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        lacking = blobs.join(seen, "blob", "left").select("blob", F.coalesce("seen", none).alias("seen")).where(F.size("seen") < len(keys))
        lacking = maybe_broadcast(stage(lacking, "lacking"), F.size("seen") * 24 + 64)
        every = every.join(lacking.select("blob"), "blob", "left_semi")
    # a limit within each group before and after the shuffle: a blob that many paths hold is sent once a task
    once = every.withColumn("k", F.row_number().over(Window.partitionBy("blob").orderBy("blob"))).where("k = 1").drop("k")
    unseen = once.withColumn("seen", none) if lacking is None else once.join(lacking, "blob")
    scan_blobs(unseen, rules).write.mode("append").parquet(path)


def find_secrets(versions: DataFrame, path_cols: tuple[str, ...] = ("doc_id",), text_col: str = "text", ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The path columns and ``spans`` (ordered by start, then rule) of every row of ``versions``.

    ``ledger``: folder of the ledger, kept from call to call; by default a new one.
    """
    path = ledger or staged_path(versions.sparkSession, "ledger")
    update_ledger(versions, path, text_col, rules)
    keys = [r.key for r in rules]
    order = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.key), F.lit(i))])
    held = read_ledger(versions.sparkSession, path)
    found = (
        _spans(_of(held, versions, text_col) if ledger else held, keys)
        .select("blob", F.array_sort(F.transform("spans", lambda s: F.struct(s.start.alias("start"), order[s.rule].alias("ord"), s.kind.alias("kind"), s.rule.alias("rule"), s.end.alias("end")))).alias("spans"))
    )
    found = stage(found, "findings")  # read as a table, so that the join may split a blob that many paths hold
    paths = versions.select(F.struct(*path_cols).alias("path"), _blob(text_col).alias("blob"))
    none = F.expr("cast(array() as array<struct<start: long, ord: int, kind: string, rule: string, end: long>>)")
    return paths.join(found, "blob", "left").select("path.*", F.coalesce("spans", none).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def mask_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ledger: str | None = None, mask: str = "[SECRET]") -> DataFrame:
    """Pipeline stage: the rows and columns of ``docs`` with every span of the text replaced by ``mask``.

    Overlapping spans of several kinds are masked as one. Rows without spans stay as they are.
    ``n_chars``, where there is one, follows the text.
    """
    path = ledger or staged_path(docs.sparkSession, "ledger")
    update_ledger(docs, path, text_col)
    held = read_ledger(docs.sparkSession, path)
    found = _spans(_of(held, docs, text_col) if ledger else held, [r.key for r in RULES])
    found = stage(found.select("blob", F.array_sort("spans").alias("spans")), "findings")
    both = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"), _blob(text_col).alias("blob")).join(maybe_broadcast(found, F.size("spans") * 60 + 60), "blob", "left")
    # the text is built left to right: (end of what is done, parts)
    built = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("done"), F.array().cast("array<string>").alias("parts")),
        lambda a, s: F.when(s.end <= a.done, a).otherwise(F.struct(
            s.end.alias("done"),
            F.concat(a.parts, F.when(s.start < a.done, F.array().cast("array<string>")).otherwise(F.array(F.substring(F.col("text"), a.done.cast("int") + 1, (s.start - a.done).cast("int")), F.lit(mask)))).alias("parts"),
        )),
        lambda a: F.concat(F.array_join(a.parts, ""), F.substring(F.col("text"), a.done.cast("int") + 1, F.lit(2147483647))),
    )
    hit = F.size("spans") > 0
    masked = both.select("row", hit.alias("hit"), F.when(hit, built).otherwise(F.col("text")).alias("text"))
    row = F.col("row").withField(f"`{text_col}`", F.col("text"))
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.col("hit"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars")))
    return masked.select(row.alias("row")).select("row.*")
