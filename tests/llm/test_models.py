"""Trained models: held-out accuracy, exact sums, round trips and edge cases."""

import collections
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitmill.llm import langid, licenses, lmscore, pieces, toxicity, wordvec

SYLLABLES = {"aa": ["thi", "er", "and", "wh"], "bb": ["été", "ou", "qu", "eau"], "cc": ["ung", "sch", "ü", "keit"]}


def _corpus(n, seed=0):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        lang = list(SYLLABLES)[i % 3]
        words = ["".join(rng.choice(SYLLABLES[lang], rng.integers(1, 4))) for _ in range(rng.integers(5, 60))]
        bad = i % 4 == 0
        if bad:
            words[:2] = ["idiotlike", "moronic"]
        out.append((i, " ".join(words), lang, int(bad)))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_corpus(240), "doc_id long, text string, lang string, toxic int").cache()


def test_language_of_held_out_texts(spark, docs):
    model = langid.fit_languages(docs, learn=F.col("doc_id") % 2 == 0, texts=60)
    odd = spark.createDataFrame([(900, None, "aa"), (901, "", "aa"), (902, "12 345 !", "aa"), (903, "été " * 40_000, None), (904, "E", None), (None, "and", None)], "doc_id long, text string, score string")
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    acc = np.mean([got[i].lang_pred == lang for i, _, lang, _ in _corpus(240) if i % 2])
    assert acc > 0.95 and all(0 <= r.score <= 1 for r in got.values())
    edge = {r.doc_id: r for r in langid.identify(odd, model).collect()}
    assert [edge[k].lang_pred for k in (900, 901, 902, 903)] == ["und", "und", "und", "bb"] and edge[900].score == 0 and len(edge) == 6
    assert {r.lang_pred for r in langid.identify(docs.limit(4), langid.fit_languages(docs.limit(0))).collect()} == {"und"}


def test_text_probability_is_the_mean_over_letters():
    rng = np.random.default_rng(0)
    m = langid.train([b"abc def", b"xyz uvw"] * 20, np.array([0, 1] * 20), ["l", "r"], epochs=2)
    text = bytes(rng.choice(list(b"abc xyz12"), 200).astype(np.uint8))
    want, n = np.zeros(2), 0
    for lo in range(0, 200, langid.SPAN):
        part = text[lo : lo + langid.SPAN].ljust(langid.SPAN, b"\0")
        p = langid.label_bytes(m, np.frombuffer(part, np.uint8)[:, None])
        for t, c in enumerate(part):
            if chr(c).isalpha():
                want, n = want + p[:, t, 0], n + 1
    assert np.allclose(langid.text_probabilities(m, [b"", text])[1], want / n, atol=1e-5)


def _plain_states(table, loop, data):
    """One direction of the recurrent network over one window, a step and a unit at a time."""
    n = langid.HIDDEN
    h, out = [0.0] * n, []
    for x in data:
        given = table[:, x].astype(float)
        gate = [1 / (1 + np.exp(-2 * (given[i] + sum(loop[i, j] * h[j] for j in range(n))))) for i in range(2 * n)]
        z, r = gate[:n], gate[n:]
        new = [np.tanh(given[2 * n + i] + sum(loop[2 * n + i, j] * r[j] * h[j] for j in range(n))) for i in range(n)]
        h = [(1 - z[i]) * new[i] + z[i] * h[i] for i in range(n)]
        out.append(h)
    return np.array(out)


def test_recurrent_steps_against_a_plain_loop():
    rng = np.random.default_rng(1)
    m = langid.train([b"abc def", b"xyz uvw", "éè ç".encode()] * 14, np.array([0, 1, 2] * 14), ["l", "m", "r"], epochs=3)
    data = rng.choice(list("abc xyz é".encode()), (langid.SPAN, 3)).astype(np.uint8)
    got = langid.label_bytes(m, data)
    for w in range(3):
        f, b = _plain_states(m.table[0], m.loop[0], data[:, w]), _plain_states(m.table[1], m.loop[1], data[::-1, w])[::-1]
        logit = np.concatenate((f, b), axis=1) @ m.out.T.astype(float) + m.bias
        p = np.exp(logit - logit.max(axis=1, keepdims=True))
        assert np.allclose(got[:, :, w].T, p / p.sum(axis=1, keepdims=True), atol=1e-4)


def test_languages_of_repeated_rows_and_clashing_names(spark, docs):
    model = langid.fit_languages(docs, texts=40)
    rows = docs.limit(6).select("doc_id", "text", F.lit("x").alias("has_letter_"), F.lit(1).alias("score"), F.lit("y").alias("lang_pred"))
    got = [tuple(r) for r in langid.identify(rows.union(rows), model).collect()]
    assert len(got) == 12 and len(set(got)) == 6
    kept = langid.keep_identified(docs.withColumns({"has_letter_": F.lit("x"), "score": F.lit(1)}))
    assert {"has_letter_", "score"} <= set(kept.columns) and kept.count() > 0


def test_words_of_one_class_are_told_apart(spark, docs):
    rng = np.random.default_rng(4)
    by: dict[int, list[str]] = {}
    while True:
        word = "".join(rng.choice(list("bcdfgh"), 6)) + "ing"
        one = by.setdefault(int(lmscore.buckets([word.encode()])[0][0]), [])
        one.append(word)
        if len(one) == 4 and len(set(one)) == 4:
            break
    often, seldom, rare, never = one
    rows = [(1, f"{often} " * 9), (2, f"{seldom} " * 3), (3, rare), (4, never), (5, None), (6, f"{often} {never} {rare}")]
    corpus = spark.createDataFrame(rows[:3] + [(9, "other words of the text")], "doc_id long, text string")
    net = lmscore.untrained(lmscore.count_buckets(corpus))
    ask = spark.createDataFrame(rows, "doc_id long, text string")
    plain = {r.doc_id: r.log_likelihood for r in lmscore.score(ask, net).collect()}

    def within(vocab):
        lexicon = lmscore.fit_lexicon(corpus, vocab=vocab)
        return {r.doc_id: r.log_likelihood - plain[r.doc_id] for r in lmscore.score(ask, net, lexicon).collect()}

    # 13 words of the class, one place kept for what was never seen
    full = within(100)
    assert np.allclose([full[k] for k in (1, 2, 3, 4, 5)], [9 * np.log(9 / 14), 3 * np.log(3 / 14), np.log(1 / 14), np.log(1 / 14), 0], atol=1e-6)
    assert np.isclose(full[6], np.log(9 / 14) + 2 * np.log(1 / 14))
    two = within(2)  # the word of one occurrence and one never seen share what is left
    assert np.allclose([two[k] for k in (1, 2, 3, 4)], [9 * np.log(9 / 14), 3 * np.log(3 / 14), np.log(2 / 14 / 2), np.log(2 / 14 / 2)], atol=1e-6)
    assert len(lmscore.fit_lexicon(corpus.limit(0)).word) == 0 and lmscore.score(docs, net, lmscore.fit_lexicon(corpus.limit(0))).count() == 240


def test_rejected_documents_go(spark, docs):
    extra = spark.createDataFrame([(900, None, "aa", 0), (901, "123", "bb", 0)], docs.schema)
    kept = langid.keep_identified(docs.unionByName(extra))
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns and not ids & {900, 901} and len(ids) > 230


def test_toxicity_of_held_out_texts(spark, docs):
    model = toxicity.fit_toxicity(docs, docs.select("doc_id", "toxic"), learn=F.col("doc_id") % 3 != 0)
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(t) for i, _, _, t in _corpus(240) if i % 3 == 0]) > 0.95
    edge = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "word " * 300_000, "x"), (3, "word " * 300_000, "x")], "doc_id long, text string, score string")
    rows = toxicity.score_toxicity(edge, model).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows) and rows[0].score == rows[1].score and rows[2].score == rows[3].score
    none = toxicity.fit_toxicity(docs, docs.select("doc_id", F.lit(0).alias("toxic")))
    assert {r.score for r in toxicity.score_toxicity(docs, none).collect()} == {0.0}


def test_scores_don_t_depend_on_cuts(spark, docs, monkeypatch):
    model = toxicity.fit_toxicity(docs, docs.select("doc_id", "toxic"))
    texts = [" ".join(t for _, t, _, _ in _corpus(40)[k : k + 12]).encode() for k in range(20)] + [b"", b"one"]
    whole = toxicity.score_texts(model, texts)
    for size in (64, 300):
        with monkeypatch.context() as m:
            m.setattr(toxicity.wordvec, "PIECE", size)
            assert np.allclose(whole, toxicity.score_texts(model, texts), atol=1e-5)


def test_training_rows_are_bounded(spark, docs):
    again = docs.unionByName(docs.where("doc_id < 8")).unionByName(docs.where("doc_id < 8"))
    one = toxicity.fit_toxicity(docs, docs.select("doc_id", "toxic"), rows=40, size=4000)
    two = toxicity.fit_toxicity(again, docs.select("doc_id", "toxic"), rows=40, size=4000)
    assert np.array_equal(one.word, two.word) and one.constant is None
    empty = toxicity.fit_toxicity(docs.limit(0), docs.select("doc_id", "toxic"))
    assert toxicity.score_toxicity(docs.limit(0), empty).count() == 0


def test_pooling_equals_a_plain_loop():
    rng = np.random.default_rng(1)
    words = [rng.integers(0, toxicity.WORDS, n).astype(np.int32) for n in (5, 0, 1, 9)]
    starts = [w % toxicity.STARTS for w in words]
    m = toxicity.train(words, starts, np.array([0, 1, 1, 0]), ["a", "a", None, "b"], np.array([False] * 4), epochs=1)
    own = np.repeat(np.arange(4), [len(w) for w in words])
    got = toxicity._pooled(m, np.concatenate(words), np.concatenate(starts), own, 4)[0]
    for i, (w, s) in enumerate(zip(words, starts, strict=True)):
        emb = np.concatenate([m.word[w] + m.start[s], np.zeros((2, toxicity.DIM))])
        want = []
        for (width, n), f, b in zip(toxicity.FILTERS, m.filters, m.bias, strict=True):
            v = [np.maximum(emb[t : t + width].ravel() @ f + b, 0) for t in range(len(w))]
            want.append(np.max(v, axis=0) if v else np.zeros(n))
        assert np.allclose(got[i], np.concatenate(want), atol=1e-5)


def test_pseudo_likelihood_is_a_distribution_and_learns(spark, docs):
    counts = lmscore.count_buckets(docs)
    assert counts.sum() == sum(len(t.split()) for _, t, _, _ in _corpus(240))
    net = lmscore.fit(docs)
    every = np.arange(lmscore.BUCKETS)
    near, far = np.array([[7], [lmscore.BUCKETS]]), np.array([[lmscore.ENDINGS], [3]])
    p = np.exp(lmscore.log_p(net, every, np.repeat(near, len(every), axis=1), np.repeat(far, len(every), axis=1)))
    assert abs(p.sum() - 1) < 1e-4
    rows = {r.doc_id: r for r in lmscore.score(docs, net).collect()}
    bucket, count = lmscore.buckets([_corpus(240)[7][1].encode()])
    b, want, n = bucket.astype(int), 0.0, net
    for t in range(len(b)):
        at = lambda o: b[t + o] if 0 <= t + o < len(b) else None  # noqa: B023, E731
        h = n.bias.astype(np.float64).copy()
        for side, o in enumerate((-1, 1)):
            h += n.near[side, lmscore.BUCKETS if at(o) is None else at(o)]
        for side, o in enumerate((-2, 2)):
            h += n.far[side, lmscore.ENDINGS if at(o) is None else at(o) // lmscore.SLOTS]
        h = np.tanh(h)
        e, s = divmod(b[t], lmscore.SLOTS)
        for y, k in ((h @ n.ending + n.ending_bias, e), (h * n.gate[e] @ n.slot + n.slot_bias[e], s)):
            want += y[k] - np.log(np.exp(y).sum())
    assert abs(rows[7].log_likelihood - want) < 1e-2 and rows[7].n_words == count[0]
    flat = {r.doc_id: r.log_likelihood for r in lmscore.score(docs, lmscore.untrained(counts)).collect()}
    assert sum(r.log_likelihood for r in rows.values()) > sum(flat.values())


def test_scores_don_t_depend_on_partitions(spark, docs):
    one = {r.doc_id: r.mean_log_likelihood for r in lmscore.score(docs, lmscore.fit(docs.coalesce(1), stream=1500)).collect()}
    many = {r.doc_id: r.mean_log_likelihood for r in lmscore.score(docs, lmscore.fit(docs.repartition(8), stream=1500)).collect()}
    assert max(abs(one[k] - many[k]) for k in one) < 1e-3


def test_scores_of_odd_texts(spark, docs):
    net = lmscore.fit(docs)
    long = "word and " * 400_000
    rows = [(1, None, "x"), (2, "...", "x"), (3, long, "x"), (3, long, "x"), (None, "and er", "x")]
    got = lmscore.score(spark.createDataFrame(rows, "doc_id long, text string, n_words string"), net).collect()
    assert [(r.n_words, r.log_likelihood, r.mean_log_likelihood) for r in got[:2]] == [(0, 0.0, None)] * 2
    assert got[2] == got[3] and got[2].n_words == 800_000 and got[4].doc_id is None and got[4].log_likelihood < 0
    empty = docs.limit(0)
    assert lmscore.score(empty, lmscore.fit(empty)).count() == 0
    same = lmscore.fit(spark.createDataFrame([(1, "and er")] * 6 + [(2, None)], "doc_id long, text string"))
    assert len(lmscore.score(docs, same).collect()) == 240


GPL = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version."
BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:"


@pytest.fixture(scope="module")
def licence_model(docs):
    return licenses.fit_licenses(docs)


def test_licences(spark, docs, licence_model):
    rows = [(1, "intro\nReleased under the MIT License.\nmore"), (2, "Licensed under the Apache License, Version 2.0."), (3, None), (4, " \n\n ..."), (5, "This work is licensed under the GNU General Public License, version 3.\n\n" * 2), (6, "Licensed under CC BY-NC 4.0."), (7, "thi er and wh"), (8, "Licensed under the Frobnicate Public License of Atlantis, revision 9."), (8, "All rights reserved."), (None, "All rights reserved.")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, family string")
    got = sorted((str(r.doc_id), r.paragraph, r.line, r.family, r.status) for r in licenses.find_licenses(df, licence_model).collect())
    sure = [g[:4] for g in got if g[4] == "confirmed"]
    assert sure == [("1", 1, 2, "MIT"), ("2", 1, 1, "Apache"), ("5", 1, 1, "GPL"), ("5", 2, 3, "GPL"), ("6", 1, 1, "CC-BY-NC"), ("8", 1, 1, "reserved"), ("None", 1, 1, "reserved")]
    assert [g for g in got if g[4] != "confirmed"] == [("8", 1, 1, "unknown", "unconfirmed")]
    assert licenses.find_licenses(docs, licence_model).count() == 0
    assert licenses.find_licenses(df.limit(0), licence_model).count() == 0


def test_wrapped_and_embedded_notices(spark, docs, licence_model):
    prose = " ".join(t for _, t, _, _ in _corpus(60))
    one_line = prose + " Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files. " + prose
    rows = [(1, f"er thi\n\n{GPL}\n\nand wh"), (2, f"{prose} {BSD} {prose}"), (3, one_line), (4, (prose + "\n") * 120 + "Licensed under the MIT license." + ("\n" + prose) * 120), (5, f"{GPL}\n\n{BSD}"), (5, f"{GPL}\n\n{BSD}")]
    got = licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string"), licence_model).collect()
    found = collections.Counter((r.doc_id, r.family) for r in got if r.status == "confirmed")
    assert found == {(1, "GPL"): 1, (2, "BSD"): 1, (3, "MIT"): 1, (4, "MIT"): 1, (5, "GPL"): 2, (5, "BSD"): 2}
    assert not [r for r in got if r.status != "confirmed"]


def test_windows_are_judged_like_a_plain_loop(licence_model):
    m, templates = licence_model, [t for ts in licenses.TEMPLATES.values() for t in ts]
    rng = np.random.default_rng(4)
    words = [w for _, t, _, _ in _corpus(30) for w in t.split()]
    for k in range(12):
        lines = [" ".join(rng.choice(words, int(rng.integers(0, 90)))) for _ in range(8)] + [templates[k], GPL, ""]
        text = "\n".join(np.array(lines, object)[rng.permutation(len(lines))]).encode()
        (_, word, begin, end), = licenses._text_words([text])
        a, b, paragraph, line = licenses.windows(text, begin)
        # windows: by words of each paragraph, and lines
        want, seen, n_line, n_par = set(), 0, 0, 0
        for par in text.decode().split("\n\n"):
            own = licenses.words_of(par)
            starts = [0] + [s for s in range(licenses.STEP, len(own), licenses.STEP) if s + licenses.WINDOW - licenses.STEP < len(own)] if own else []
            want |= {(seen + s, seen + min(s + licenses.WINDOW, len(own))) for s in starts}
            at = seen
            for ln in par.split("\n"):
                n = len(licenses.words_of(ln))
                if 0 < n <= licenses.WINDOW:
                    want.add((at, at + n))
                at += n
            seen += len(own)
        assert set(zip(a.tolist(), b.tolist(), strict=True)) == want
        p = licenses._soft(licenses.window_logits(m, word, a, b))
        for i in range(len(a)):
            part = licenses.words_of(text[begin[a[i]] : end[b[i] - 1]].decode())
            feats = [wordvec.word_hash(w) for w in part]
            feats += [int(licenses._pairs(np.array([x, y], np.uint64))[0]) for x, y in zip(feats, feats[1:], strict=False)]
            z = m.bias.astype(float).copy()
            for f in feats:
                slot = f % licenses.SLOTS
                z += (m.weight[m.features[1][slot]] if m.features[0][slot] == f >> 32 else 0) / np.sqrt(len(feats))
            q = np.exp(z - z.max())
            assert np.allclose(p[i], q / q.sum(), atol=1e-6)


def test_pieces_come_back_and_follow_the_lattice(spark):
    v = pieces.load()
    texts = ["Hello  world\n\ttest  ", "", " ", "▁x ▁▁", "é日本語🎈 done", "a" * 500, None, "\x00\x01"]
    df = spark.createDataFrame([(i if i else None, t, "x") for i, t in enumerate(texts * 2)], "doc_id long, text string, pieces string")
    back = pieces.decode(pieces.encode(df)).collect()
    assert collections.Counter(r.text for r in back) == collections.Counter(texts * 2)
    got = collections.Counter(tuple(x.tolist()) for x in pieces.encode_texts(v, [b"therein"] * 8000, list(range(8000))))
    ids = {v.raw[i].decode("utf-8", "ignore").replace(" ", "▁"): i for i in range(v.first_byte + 256, len(v.raw))}

    def cuts(s):
        if not s:
            yield (), 0.0
        for k in range(1, len(s) + 1):
            if s[:k] in ids:
                for rest, w in cuts(s[k:]):
                    yield (ids[s[:k]], *rest), w + v.weight[ids[s[:k]]]

    every = dict(cuts("▁therein"))
    z = sum(np.exp(w) for w in every.values())
    assert set(got) <= set(every) and sum(abs(got[s] / 8000 - np.exp(w) / z) for s, w in every.items()) / 2 < 0.03


def test_pieces_don_t_depend_on_batches():
    v = pieces.load()
    texts = [f"The cat {k} sat  on the mat\n".encode() * 9 for k in range(40)]
    whole = pieces.encode_texts(v, texts, list(range(40)), seed=3)
    held = pieces.CHARS
    pieces.CHARS = 64
    try:
        again = pieces.encode_texts(v, texts, list(range(40)), seed=3)
    finally:
        pieces.CHARS = held
    assert all(np.array_equal(a, b) for a, b in zip(whole, again, strict=True))
    assert np.array_equal(pieces.encode_texts(v, texts[7:8], [7], seed=3)[0], whole[7])
    assert any(not np.array_equal(a, b) for a, b in zip(whole, pieces.encode_texts(v, texts, list(range(40)), seed=4), strict=True))


def test_long_words_are_sampled_like_short_ones(spark, monkeypatch):
    v = pieces.load()
    rng = np.random.default_rng(0)
    text = bytes(rng.choice(list(b"abcdefghijklmnopqrstuvwxyz"), 3000).astype(np.uint8)) + "é日".encode() * 700
    by_stretches = pieces.encode_texts(v, [b"x y", text], [1, 2])[1]
    with monkeypatch.context() as m:
        m.setattr(pieces, "STRETCH", 24), m.setattr(pieces, "STRETCHES", 7)
        assert np.array_equal(by_stretches, pieces.encode_texts(v, [text], [2])[0])
    with monkeypatch.context() as m:
        m.setattr(pieces, "LONG", 10**9)
        assert np.array_equal(by_stretches, pieces.encode_texts(v, [text], [2])[0])
    assert pieces.decode_ids(v, by_stretches) == text


def test_a_million_letters_without_a_space(spark):
    text = "".join(np.random.default_rng(1).choice(list("abcdefghijklmnopqrstuvwxyz"), 1_000_000))
    df = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    start = time.time()
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(df)).collect()}
    assert back == {1: text, 2: "short"} and time.time() - start < 60
    assert pieces.decode(pieces.encode(df.limit(0))).count() == 0


def test_pipeline_decisions(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, t, lang, "s", len(t)) for i, t, lang, _ in _corpus(60)]
    item = " ".join(f"bench{k}" for k in range(30))
    rows += [(100, rows[4][1], "aa", "s", 1), (101, "12 34", "aa", "s", 5), (102, rows[7][1] + " " + item + " " + rows[10][1], "bb", "s", 1), (103, rows[8][1] + ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ' + rows[11][1] + rows[14][1], "cc", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r.pieces for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert not {100, 101, 102} & set(got) and 103 in got and len(got) >= 58
    v = pieces.load()
    masked = pieces.decode_ids(v, np.array(got[103])).decode()
    assert "[SECRET]" in masked and "24be64439e3e" not in masked
    assert pieces.decode_ids(v, np.array(got[5])).decode() == rows[5][1]


def test_pipeline_with_odd_rows(spark, tmp_path):
    import corpus_pipeline

    cols = "doc_id long, text string, lang string, source string, n_chars long, sha string, blob string, row string, spans string, fp_ long"
    rows = [(i, t, lang, "s", len(t), "a", "b", "c", "d", 1) for i, t, lang, _ in _corpus(30)]
    rows += [rows[3], (3, "another text with the same id er and thi wh er and", "aa", None, None, None, None, None, None, None), (None, rows[4][1], "aa", "s", 1, "a", "b", "c", "d", 1), (None, None, None, None, None, None, None, None, None, None), (70, "", "aa", "s", 0, "a", "b", "c", "d", 1)]
    docs = spark.createDataFrame(rows, cols)
    (tmp_path / "full").mkdir()
    spark.createDataFrame([(1, None), (2, ""), (None, "thi er")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for given in (docs, docs.limit(0)):
        out = given
        for _, step in corpus_pipeline.STAGES:
            before, out = out, step(spark, out, str(tmp_path)).cache()
            assert out.columns == (before.columns if step is not corpus_pipeline.STAGES[-1][1] else ["doc_id", "pieces"])
        got = collections.Counter(r.doc_id for r in out.collect())
        # repeated rows are one, two texts with one id are two, rows without an id stay, null and empty texts go
        assert got == ({**{i: 1 for i in range(30)}, 3: 2, None: 1} if given is docs else {})


def test_every_word_is_a_training_target(spark):
    count = np.array([0, 1, 5, 0, 8, 2, 33])
    taken = np.concatenate([lmscore.targets(count, t) for t in range(lmscore.ROUNDS)])
    assert sorted(taken) == list(range(count.sum()))
    # eight words a text: a stride of eight or more would learn some of the places only
    docs = spark.createDataFrame([(i, "ka le mi no pu ra se ti") for i in range(8000)], "doc_id long, text string").coalesce(1)
    row = lmscore.score(docs.limit(1), lmscore.fit(docs)).first()
    assert row.mean_log_likelihood > -1
