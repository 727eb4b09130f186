"""Column functions over notice texts."""

from __future__ import annotations

import unicodedata
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The patterns and terms of the exchange's notices.
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
DATE = rf"(?:{MONTHS})\s+\d{{1,2}},\s+\d{{4}}"
FROM_MARK = r"(?:w\s*\.\s*e\s*\.\s*f\s*\.?|effective(?:ly)?\s+from|with\s+effect\s+from)\s+(?:the\s+)?"
STATUS_SIGNAL = r"suspension|suspended|revocation|recommencement|available\s+for\s+trading"
#: A word ends where an ASCII letter, digit or underscore does: spelled out, as ``\\b`` takes other letters for parts of a word on some Java versions.
NAME = r"(?<![A-Za-z0-9_])[A-Z][A-Za-z0-9&.'’()/-]*(?:\s+[A-Z][A-Za-z0-9&.'’()/-]*){0,8}\s+(?:Limited(?![A-Za-z0-9_])|Ltd(?:\.(?=[A-Za-z0-9_])|(?![A-Za-z0-9_])))"
NAME_STOPS = ("NATIONAL STOCK EXCHANGE", "PRESS RELEASE", "CAPITAL MARKET", "LISTING AGREEMENT", "TRADING IN", "SECURITIES OF")
RELEASE_HEAD = r"(?i)press\s+release\s+no\.\s*\d+"
STATUS_ACTION = r"revocation\s+of\s+(?:the\s+)?suspension|recommencement\s+of\s+trading|(?:will|shall|would|are|be)\s+suspended\s+from\s+trading|proposed suspension"
NOTICE_TERMS = ("compulsory delisting", "public notice for compulsory delisting", "delisting committee", "delisting regulations", "national stock exchange of india")


def _date(text: Column) -> Column:
    """``Month d, yyyy`` as a date; null for a day that is none."""
    return F.try_to_timestamp(F.initcap(F.lower(F.regexp_replace(text, r"\s+", " "))), F.lit("MMMM d, yyyy")).cast("date")


def effective_date(text: Column) -> Column:
    """The date after ``w.e.f.``, ``effective from`` or ``with effect from``."""
    return _date(F.regexp_extract(text, f"(?i){FROM_MARK}({DATE})", 1))


def article_date(text: Column) -> Column:
    """The first date written out."""
    return _date(F.regexp_extract(text, rf"(?i)(?<![A-Za-z0-9_])({DATE})(?![A-Za-z0-9_])", 1))


def suspension_type(text: Column) -> Column:
    """Whether a document ends a suspension or begins one."""
    return F.when(F.lower(text).rlike("revocation|recommencement|available for trading"), "SUSPENSION_REVOKED").otherwise("SUSPENSION_START")


def block_type(text: Column) -> Column:
    """The same for a block of a page, which tells a recommencement from a revocation."""
    low = F.lower(text)
    return F.when(low.rlike("recommencement|available for trading"), "TRADING_RECOMMENCEMENT").when(low.rlike("revocation"), "SUSPENSION_REVOKED").otherwise("SUSPENSION_START")


def is_status_action(text: Column) -> Column:
    return F.lower(text).rlike(STATUS_ACTION)


@cache
def _plain() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility decomposition leaves one ASCII character, these, and those that leave several."""
    one, to, more = [], [], {}
    for point in (*range(0x80, 0xD800), *range(0xE000, 0x10000)):
        left = unicodedata.normalize("NFKD", chr(point)).encode("ascii", "ignore").decode()
        if len(left) == 1:
            one.append(chr(point))
            to.append(left)
        elif left:
            more[chr(point)] = left
    return "".join(one), "".join(to), more


def _ranges(points: list[int], gap: int = 64) -> list[tuple[int, int]]:
    """Ranges that hold the points; two no further apart than ``gap`` share one beyond Latin, where few texts go."""
    out: list[tuple[int, int]] = []
    for p in points:
        if out and p - out[-1][1] <= (1 if p < 0x2000 else gap):
            out[-1] = (out[-1][0], p)
        else:
            out.append((p, p))
    return out


def fold_accents(text: Column) -> Column:
    """What a compatibility decomposition (NFKD) leaves of a text in ASCII; characters beyond the basic plane go."""
    one, to, more = _plain()
    long = F.create_map(*[F.lit(x) for pair in more.items() for x in pair])
    spelled = F.array_join(F.transform(F.split(text, ""), lambda c: F.coalesce(F.try_element_at(long, c), c)), "")
    has_long = text.rlike("[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in _ranges(sorted(map(ord, more)))) + "]")
    plain = lambda x: F.regexp_replace(F.translate(x, one, to), r"[^\x00-\x7f]", "")
    return F.when(~text.rlike(r"[^\x00-\x7f]"), text).when(has_long, plain(spelled)).otherwise(plain(text))


def normalize_name(name: Column) -> Column:
    """Upper case, accents folded, other characters as spaces, LIMITED as LTD, COMPANY as CO."""
    plain = F.trim(F.regexp_replace(F.upper(fold_accents(name)), "[^A-Z0-9]+", " "))
    return F.regexp_replace(F.regexp_replace(plain, r"\bLIMITED\b", "LTD"), r"\bCOMPANY\b", "CO")


def compact_name(name: Column) -> Column:
    """Letters and digits only, LIMITED as LTD and CORPORATION as CORP."""
    return F.replace(F.replace(F.regexp_replace(F.upper(name), "[^A-Z0-9]", ""), F.lit("LIMITED"), F.lit("LTD")), F.lit("CORPORATION"), F.lit("CORP"))


def _places(text: Column, pattern: str) -> Column:
    """Where each match begins, from 0: what pieces and matches before it hold."""
    lengths = F.zip_with(F.transform(F.split(text, pattern, -1), F.length), F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length), lambda a, b: F.struct(a.alias("gap"), b.alias("n")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("found"))
    step = lambda s, x: F.when(x.n.isNull(), s).otherwise(F.struct((s.at + x.gap + x.n).alias("at"), F.concat(s.found, F.array(s.at + x.gap)).alias("found")))
    return F.aggregate(lengths, start, step, lambda s: s.found)


def candidate_names(text: Column, most: int = 100) -> Column:
    """Distinct company names near the signals of a change of status, in order, at most ``most``.

    A signal's stretch begins 120 characters before it and ends 1,000 after its begin.
    """
    near = F.transform(_places(text, f"(?i){STATUS_SIGNAL}"), lambda s: F.substring(text, F.greatest(s - 120, F.lit(0)) + 1, s + 1000 - F.greatest(s - 120, F.lit(0))))
    found = F.flatten(F.transform(near, lambda w: F.regexp_extract_all(w, F.lit(NAME), F.lit(0))))
    clean = F.transform(found, lambda c: F.btrim(F.regexp_replace(c, r"\s+", " "), F.lit(" .,-")))
    stops = lambda c: reduce(lambda a, t: a | F.contains(F.upper(c), F.lit(t)), NAME_STOPS, F.lit(False))
    return F.slice(F.array_distinct(F.filter(clean, lambda c: ~stops(c) & F.length(c).between(3, 140))), 1, most)


def strip_html(html: Column) -> Column:
    """Text without scripts, styles and tags, the usual entities resolved and spaces squeezed."""
    out = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    out = F.regexp_replace(out, r"(?s)<[^>]+>", " ")
    for entity, plain in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def _squeezed(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def notice_terms(text: Column) -> Column:
    """The terms that the text holds, in upper case."""
    return F.transform(F.filter(F.array(*[F.lit(t) for t in NOTICE_TERMS]), lambda t: F.contains(_squeezed(text), t)), F.upper)


def notice_relevance(text: Column) -> Column:
    """How far a notice speaks of a delisting at the exchange; a text without words must be read by other means."""
    low = _squeezed(F.coalesce(text, F.lit("")))
    here = F.contains(low, F.lit("national stock exchange"))
    return (
        F.when(low == "", "SCANNED_DOCUMENT_REVIEW_REQUIRED").when(here & F.contains(low, F.lit("compulsory delist")), "RELEVANT_TEXT_EVIDENCE")
        .when(here & F.contains(low, F.lit("delist")), "POSSIBLE_TEXT_EVIDENCE_REVIEW_REQUIRED").otherwise("NOT_RELEVANT_TEXT")
    )


def explode_blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, block_no, block)``: the press releases of each page that change a status, numbered from 1."""
    parts = docs.select(id_col, F.posexplode(F.split(text_col, RELEASE_HEAD, -1)).alias("pos", "block")).where(is_status_action(F.col("block")))
    return parts.withColumn("block_no", F.row_number().over(Window.partitionBy(id_col).orderBy("pos")).cast("long")).select(id_col, "block_no", "block")
