"""URL filters and secret scans against plain Python."""

import hashlib
import re
import tempfile

from pitmill.llm import secrets, urlfilter

DOCS = "doc_id long, text string, lang string, blob_ string, spans string"


def _urls(spark, urls, rules=urlfilter.RULES):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    return {r.page_id: r for r in urlfilter.judge_urls(pages, spark.createDataFrame(list(rules), "host string, path string, verdict string")).collect()}


def test_longest_rule_wins(spark):
    urls = ["http://a.example.com/en/1?x", "https://WWW.example.com/en/", "http://m.www.example.com/en/x#t", "http://notexample.com/en/", "http://x.net/es/1", "http://x.net/es", "ftp://x.org/", None, "no scheme", "http://", "http://com", "http://com/", "http://u@x.net:80/fr/", "http://x.net/fr/1://example.com/en/", ""]
    rules = sorted(urlfilter.RULES, key=lambda r: -len(r[0] + r[1]))
    got = _urls(spark, urls)
    for i, u in enumerate(urls):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = next(((h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)), (None, "allow"))
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, *fit), u


def test_deeply_nested_rules_and_bounds(spark):
    rules = [("a.com", "/", "allow"), ("a.com", "/x", "block"), ("a.com", "/x/y", "allow"), ("a.com", "/x/y/z", "block"), ("com", "/x/y/z/w", "allow")]
    urls = ["http://a.com/w", "http://a.com/x", "http://a.com/x/y", "http://a.com/x/y/z", "http://b.a.com/x/y/z/w/long", "http://a.com/x\U0010ffff", "http://a.com/y", "http://a.com/x/z"] * 3
    got = _urls(spark, urls, rules)
    assert [got[i].rule for i in range(8)] == ["a.com/", "a.com/x", "a.com/x/y", "a.com/x/y/z", "a.com/x/y/z", "a.com/x", "a.com/", "a.com/x"] and len(got) == 24


def test_no_rules_or_no_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert urlfilter.judge_urls(pages, none).first().verdict == "allow"
    assert urlfilter.judge_urls(pages.limit(0), spark.createDataFrame(list(urlfilter.RULES), "host string, path string, verdict string")).count() == 0


def _brute(text):
    out = []
    for i, r in enumerate(secrets.RULES):
        for m in re.finditer(r.pattern, text or "", re.ASCII):
            if len(m[r.group]) >= r.least:
                out.append((m.start(), i, r.kind, m.end()))
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


TEXTS = [
    'é token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" x', None, "", "token=token:abcdefghijklmnop", "PassWord: hunter2 then API_KEY='abcd1234efgh5678'", "AKIA" + "A" * 14 + " AKIAX",
    "🎈 0123456789abcdef0 0123456789abcde", "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 40, "secret==abcdefghijklmnopqrst==", "xoxb-1234567890abc AIza" + "x" * 35, "x" * 70_000 + " passwd:" + "Z" * 12, "ſecret=abcdefghijklmnop",
]


def test_spans_are_those_of_a_plain_search(spark):
    docs = spark.createDataFrame([(i, t, "en", "b", "s") for i, t in enumerate(TEXTS * 2)], DOCS)
    got = {r.doc_id: r.s for r in secrets.find_secrets(docs).select("doc_id", secrets.joined(secrets.F.col("spans")).alias("s")).collect()}
    assert got == {i: _brute(t) for i, t in enumerate(TEXTS * 2)}


#: Of each rule's letters, what may make a matcher begin again and again.
SAME = {
    "assign": ["password ", "token=", "api_key'  ", "secret:\" "], "access": ["AKIA", "AKI"], "hex": ["0", "0123456789abcde "], "pem": ["-----BEGIN ", "A ", "RSA PRIVATE KEY-----"], "github": ["ghp_", "ghp_a "],
    "slack": ["xoxb-", "xox"], "google": ["AIza", "AIza-_ "], "jwt": ["eyJ", "eyJaaaaaaaa.", "eyJ-eyJ_"],
}


def test_megabytes_of_a_rules_own_letters(spark):
    ends = {"pem": ("-----BEGIN ", " PRIVATE KEY-----"), "jwt": ("eyJaaaaaaaa.", ".eyJ")}
    texts = [x.join(ends.get(kind, ("", ""))) if not n else x * n + ends.get(kind, ("", ""))[1] for kind, xs in SAME.items() for x in xs for n in (0, 1_000_000 // len(x))]
    assert set(SAME) == {r.kind for r in secrets.RULES}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(12)
    got = {r.doc_id: r.s for r in secrets.find_secrets(docs).select("doc_id", secrets.joined(secrets.F.col("spans")).alias("s")).collect()}
    assert got == {i: _brute(t) for i, t in enumerate(texts)}


def test_a_call_over_what_is_known_writes_and_sends_no_text(spark):
    path = f"{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}/ledger"
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    secrets.update_ledger(docs, path)
    held = secrets.read_ledger(spark, path).count()
    secrets.update_ledger(docs.union(docs), path)
    assert secrets.read_ledger(spark, path).count() == held == len(set(t or "" for t in TEXTS))
    again = {r.doc_id: r.s for r in secrets.find_secrets(docs, ledger=path).select("doc_id", secrets.joined(secrets.F.col("spans")).alias("s")).collect()}
    assert again == {i: _brute(t) for i, t in enumerate(TEXTS)}


def test_ledger_scans_new_pairs_only(spark):
    path = f"{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}/ledger"
    docs = spark.createDataFrame([(1, TEXTS[0]), (2, TEXTS[0]), (3, TEXTS[5])], "doc_id long, text string")
    secrets.update_ledger(docs, path, rules=secrets.RULES[:2])
    assert secrets.read_ledger(spark, path).count() == 2
    secrets.update_ledger(docs, path, rules=secrets.RULES[:2])
    assert secrets.read_ledger(spark, path).count() == 2
    more = docs.union(spark.createDataFrame([(4, "new")], docs.schema))
    found = secrets.find_secrets(more, ledger=path)
    rows = {bytes(r.blob): [] for r in secrets.read_ledger(spark, path).collect()}
    for r in secrets.read_ledger(spark, path).collect():
        rows[bytes(r.blob)].append(len(r.scanned))
    assert sorted(rows[hashlib.sha256(TEXTS[0].encode()).digest()]) == [2, len(secrets.RULES) - 2] and rows[hashlib.sha256(b"new").digest()] == [len(secrets.RULES)]
    assert {r.doc_id: len(r.spans) for r in found.collect()} == {1: 2, 2: 2, 3: 1, 4: 0}


def test_masking_keeps_the_rest(spark):
    docs = spark.createDataFrame([(1, TEXTS[0], 99), (2, None, 0), (3, "plain", 5)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in secrets.mask_secrets(docs).collect()}
    assert got == {1: ('é [SECRET]" x', 13), 2: (None, 0), 3: ("plain", 5)}
    assert secrets.mask_secrets(docs.limit(0)).columns == docs.columns


def test_a_pair_that_is_in_the_ledger_twice_counts_once(spark):
    path = f"{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}/ledger"
    docs = spark.createDataFrame([(1, TEXTS[5]), (2, TEXTS[0])], "doc_id long, text string")
    secrets.update_ledger(docs, path)
    secrets.scan_blobs(docs.select(secrets._blob("text").alias("blob"), "text", secrets.F.array().cast("array<string>").alias("seen"))).write.mode("append").parquet(path)
    assert secrets.read_ledger(spark, path).count() == 4
    got = {r.doc_id: r.s for r in secrets.find_secrets(docs.where("doc_id = 1"), ledger=path).select("doc_id", secrets.joined(secrets.F.col("spans")).alias("s")).collect()}
    assert got == {1: _brute(TEXTS[5])}
    assert secrets.mask_secrets(docs.where("doc_id = 1"), ledger=path).first().text.count("[SECRET]") == 1
    assert secrets.find_secrets(docs.limit(0)).count() == 0


def test_masking_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, TEXTS[0], "s", "b", "h")], "doc_id long, text string, spans string, blob string, hit string")
    got = secrets.mask_secrets(docs).collect()
    assert [tuple(r) for r in got] == [(1, 'é [SECRET]" x', "s", "b", "h")] and secrets.mask_secrets(docs).columns == docs.columns


def test_hot_places_are_swept_in_slices(spark):
    urls = [f"http://h{k % 7}.com/{'en/' if k % 3 else ''}{k}" for k in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = spark.createDataFrame([*urlfilter.RULES, ("h1.com", "/en/", "block")], "host string, path string, verdict string")
    whole = sorted(map(tuple, urlfilter.judge_urls(pages, rules).collect()))
    assert whole == sorted(map(tuple, urlfilter.judge_urls(pages, rules, slice_urls=4).collect())) and {r[4] for r in whole} == {"allow", "block"}
