"""Whitening, quality rules and importance resampling against brute force."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from pitmill.llm import quality, resample, whitening

VECTORS = "vec_id long, embedding array<float>, x string, index int"


def _rows(spark, rows):
    return spark.createDataFrame([(i, v and [c if c is None else float(c) for c in v], "clash", 7) for i, v in rows], VECTORS)


def test_whitening_against_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 8 * 6 * 7)  # blocks of 7 rows, so that many are multiplied
    monkeypatch.setattr(whitening, "TASK_BLOCKS", 2)
    rng = np.random.default_rng(1)
    v = (rng.standard_normal((90, 6)) @ np.diag([5, 4, 3, 2, 1, 0.5]) + 3).astype(np.float32)
    rows = [(i, v[i].tolist()) for i in range(90)] + [(200 + i, v[0].tolist()) for i in range(60)] + [(3, v[3].tolist()), (None, v[5].tolist())]
    dropped = [(900, None), (901, [1.0, float("nan"), 1, 1, 1, 1]), (902, [float("inf")] * 6), (903, [1.0, None, 1, 1, 1, 1])]
    xs = whitening.whole_numbers(_rows(spark, rows + dropped))
    model = whitening.fit_whitening(xs)
    got = whitening.whiten(xs, model).toPandas()
    x = np.floor(256 * np.array([r[1] for r in rows], np.float32).astype(float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    e, u = np.linalg.eigh(np.cov(fit.T.astype(float), bias=True))
    e, u = e[::-1], u[:, ::-1]
    want = (x - s / n) @ u[:, :4] / np.sqrt(e[:4])
    sign = np.sign((u[:, :4] * model.vectors[:, :4]).sum(axis=0))
    key = lambda i: -1 if i is None or i != i else int(i)
    mine = sorted((key(r.vec_id), r.component, round(r.whitened, 9), r.deviation) for r in got.itertuples())
    due = sorted((key(rows[i][0]), c + 1, round(float(want[i, c] * sign[c]), 9), int(((n * x[i] - s) ** 2).sum())) for i in range(len(rows)) for c in range(4))
    assert len(mine) == len(due) and all(a[:2] == b[:2] and a[3] == b[3] and abs(a[2] - b[2]) < 1e-8 for a, b in zip(mine, due, strict=True))
    assert set(got.n) == {n} and np.allclose(sorted(set(got.explained)), sorted(e[:4] / e.sum()), rtol=1e-9) and got.identity_error.max() < 1e-9


def test_whitening_of_odd_tables(spark):
    empty = whitening.whole_numbers(_rows(spark, []))
    assert whitening.whiten(empty, whitening.fit_whitening(empty)).count() == 0
    flat = whitening.whole_numbers(_rows(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]))
    got = whitening.whiten(flat, whitening.fit_whitening(flat)).collect()
    assert len(got) == 4 and {(r.whitened, r.explained, r.n, r.deviation, r.identity_error) for r in got} == {(0.0, 0.0, 1, 0, 1.0)}
    huge = whitening.whole_numbers(_rows(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0])]))
    got = whitening.whiten(huge, whitening.fit_whitening(huge)).collect()
    assert len(got) == 6 and all(math.isfinite(r.whitened) for r in got) and {r.deviation for r in got if r.vec_id < 3} == {None}
    assert whitening._deviation(np.array([1 << 40, 3]), np.array([0, 1, 2]), 3, [5]) == [None, 16]


def _counts(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text) if w]
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, len(hit)


def test_quality_counts_against_brute_force(monkeypatch):
    rng = np.random.default_rng(3)
    for size in (1 << 20, 7, 64):
        monkeypatch.setattr(quality, "SLICE", size)
        for n in (0, 1, 5, 40, 300):
            for sep in (" ", "\n", "\t \n", "  "):
                text = "".join(w + str(rng.choice([sep, " ", "\n"])) for w in rng.choice(["a", "é|", "##", "b,", "Éa", "语言"], n))
                got = quality.read_text(text.encode())
                assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == _counts(text)
                assert got.chars.sum() == got.word_chars and len(got.bins) == text.count("\n") + 1
                whole = got.bins.copy()
                monkeypatch.setattr(quality, "SLICE", 1 << 20)
                assert (quality.read_text(text.encode()).bins == whole).all()
                monkeypatch.setattr(quality, "SLICE", size)


def _field(rng, n):
    return quality.Field(rng.standard_normal((n, 2)), rng.standard_normal((2, 2)), rng.standard_normal(2))


def _score(field, bins, labels):
    return field.start[labels[0]] + sum((bins[i] @ field.emission)[k] for i, k in enumerate(labels)) + sum(field.transition[a, b] for a, b in itertools.pairwise(labels))


def test_field_against_enumeration():
    rng = np.random.default_rng(4)
    field, length = _field(rng, 5), np.array([6, 4, 1])
    bins = [rng.integers(0, 2, (k, 5)).astype(float) for k in length]
    labels = rng.integers(0, 2, (3, 6))
    want = 0.0
    for b, y, k in zip(bins, labels, length, strict=True):
        every = {p: _score(field, b, p) for p in itertools.product((0, 1), repeat=int(k))}
        assert tuple(quality.viterbi(field, b)) == max(every, key=every.get)
        want += every[tuple(y[:k].tolist())] - math.log(sum(map(math.exp, every.values())))
    flat = np.concatenate(bins)
    value, grad = quality.gradient(field, flat, labels, length)
    assert abs(value - want) < 1e-9
    for name in ("emission", "transition", "start"):
        own = getattr(field, name)
        for at in np.ndindex(own.shape):
            held = own[at]
            own[at] = held + 1e-5
            up = quality.gradient(field, flat, labels, length)[0]
            own[at] = held - 1e-5
            down = quality.gradient(field, flat, labels, length)[0]
            own[at] = held
            assert abs((up - down) / 2e-5 - getattr(grad, name)[at]) < 1e-5


def _prose(rng, n):
    return "\n".join(" ".join("".join(rng.choice(["la", "mi", "to", "ren"], rng.integers(1, 5))) for _ in range(15)).capitalize() + "." for _ in range(n))


def test_quality_of_held_out_texts(spark):
    rng = np.random.default_rng(6)
    menu = lambda n: "\n".join(" | ".join("".join(rng.choice(["HO", "ME", "LOG", "IN", "UP", "TER"], 5)) for _ in range(9)) for _ in range(n))
    rows = [(i, _prose(rng, 6) if i % 2 else _prose(rng, 1) + "\n" + menu(9), i % 2) for i in range(120)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t, _ in rows], "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i % 3] + [(None, 1), (5000, 0), (7, None)], "doc_id long, quality int")
    field = quality.fit_lines(docs, labels)
    got = {r.doc_id: r for r in quality.judge(docs, field).collect()}
    assert all(got[i].kept == bool(q) for i, _, q in rows if i % 3 == 0 and not got[i].base_failed)
    marked = {(r.doc_id, r.line): r.content for r in quality.line_labels(docs.where("doc_id < 9"), field).collect()}
    assert marked[0, 0] and not marked[0, 5] and all(marked[1, k] for k in range(6))
    long = "\n".join(" ".join("".join(rng.choice(list("abdeilmnorstu"), 6)) for _ in range(12)).capitalize() + "." for _ in range(10_000))
    odd = spark.createDataFrame([(1, None), (2, ""), (3, " \n\n"), (None, rows[1][1]), (5, rows[1][1]), (5, rows[1][1]), (6, long), (7, "word " * 300_000), (8, "\n" * 10_000)], "doc_id long, text string")
    out = sorted(((r.doc_id or 0, r.n_words, r.base_failed, r.kept) for r in quality.judge(odd, field).collect()))
    n = len(rows[1][1].split())
    assert out == [(0, n, False, True), (1, 0, True, False), (2, 0, True, False), (3, 0, True, False), (5, n, False, True), (5, n, False, True), (6, len(long.split()), False, True), (7, 300_000, True, False), (8, 0, True, False)]
    assert quality.fit_lines(docs, labels.where("quality = 1")) is None and quality.judge(docs.where("doc_id = 1"), None).first().kept
    assert quality.fit_lines(docs.limit(0), labels) is None and quality.judge(docs.limit(0), field).count() == 0


def _by_hand(docs, target, n, buckets, least, percent):
    words = lambda t: [w for w in re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if w]
    feats = lambda t: [zlib.crc32(" ".join(w[i : i + k]).encode()) % buckets for w in [words(t)] for k in range(1, n + 1) for i in range(len(w) - k + 1)]
    s, t = (collections.Counter(b for x in rows for b in feats(x)) for rows in ([d[1] for d in docs], target))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in s}
    out = []
    for i, text in docs:
        f = feats(text)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words(text))])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = collections.defaultdict(list)
    for k, r in enumerate(able[: percent * len(able) // 100], 1):
        rank[tuple(r)].append(k)
    return collections.Counter((*r[:4], rank[tuple(r)].pop() if rank.get(tuple(r)) else None) for r in out)


def test_resampling_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(8)
    pool = ["Alpha", "beta", "γάμμα", "délta", "7", "E", "zeta9"]
    text = lambda k: "".join(str(w) + str(rng.choice([" ", ", ", "\n", "--"])) for w in rng.choice(pool, k))
    docs = [(i, text(int(rng.integers(0, 40)))) for i in range(150)] + [(900, None), (901, ""), (902, "--"), (None, text(30)), (None, text(30)), (903, text(3000))]
    docs += [(904, docs[7][1])] + [(905, "beta " * 25)] * 40
    target = [text(9), "beta beta", None]
    rows = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, rank string")
    items = spark.createDataFrame([(t,) for t in target], "text string")
    for n, size in ((1, 1 << 20), (3, 1 << 20), (3, 16), (1, 5)):
        monkeypatch.setattr(resample, "SLICE", size)
        monkeypatch.setattr(resample.word_slices, "__defaults__", (size,))
        got = resample.resample(rows, items, n=n, buckets=50, least=10, percent=40)
        assert collections.Counter(map(tuple, got.collect())) == _by_hand(docs, target, n, 50, 10, 40)
    assert resample.resample(rows.limit(0), items).count() == 0
    alone = resample.resample(rows, items.limit(0))
    assert alone.count() == len(docs) and alone.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert alone.where(F.col("rank").isNotNull()).count() == 10 * sum(len(re.findall("[A-Za-z0-9\x80-\U0010ffff]+", t or "")) >= 20 for _, t in docs) // 100
