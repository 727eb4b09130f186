"""Near duplicates, decontamination and nearest neighbours against brute force."""

import numpy as np
import xxhash

from pitmill.llm import decontaminate, hnsw, simhash, wordvec


def _fp(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _classes(fps):
    p = list(range(len(fps)))

    def top(i):
        while p[i] != i:
            i = p[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = top(i), top(j)
                p[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


def _similar_classes(texts):
    sets = [decontaminate.shingles_of((t or "").lower()) for t in texts]
    own = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = own[i], own[j]
                own = [min(a, b) if x in (a, b) else x for x in own]
    return own


def test_components_of_documents(spark):
    rng = np.random.default_rng(1)
    base = [" ".join(rng.choice(["aa", "bb", "cc", "dd", "ee", "É"], 60)) for _ in range(12)]
    texts = [*base, *base[:4], None, "", "  \n", "one", "One two", "one two three"]
    for b in base[:6]:
        w = b.split()
        for k in range(8):
            texts.append(" ".join([*w, *w, *w, str(k)]))
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, fp string, component_id long")
    fps = [_fp(t) for t in texts]
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert [got[i].fp & (2**64 - 1) for i in range(len(texts))] == fps
    assert [got[i].component_id for i in range(len(texts))] == _classes(fps)
    kept = {r.doc_id for r in simhash.keep_first(docs.union(docs)).collect()}
    assert kept == set(_similar_classes(texts))
    assert simhash.keep_first(docs.limit(0)).count() == 0 and simhash.keep_first(docs).columns == docs.columns
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_similar_texts_are_grouped_like_all_pairs(spark):
    rng = np.random.default_rng(8)
    words = [f"w{k}" for k in range(3000)]
    texts = []
    for _ in range(60):
        base = list(rng.choice(words, int(rng.integers(60, 400))))
        texts.append(" ".join(base))
        for share in (0.004, 0.01, 0.03, 0.1):
            changed = [str(rng.choice(words)) if rng.random() < share else w for w in base]
            texts.append(" ".join(changed))
    docs = spark.createDataFrame([(len(texts) - i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, sha string")
    kept = {r.doc_id for r in simhash.keep_first(docs).collect()}
    want = {len(texts) - i for i in range(len(texts))}
    classes = _similar_classes(texts)
    first = {c: min(len(texts) - i for i in range(len(texts)) if classes[i] == c) for c in set(classes)}
    assert set(first.values()) <= kept <= want  # no group is lost
    assert len(kept) <= 1.03 * len(first)  # few pairs near the threshold stay apart
    many = {r.doc_id for r in simhash.keep_first(docs.repartition(7)).collect()}
    assert many == kept


def test_a_large_family_is_split_into_blocks(spark, monkeypatch):
    rng = np.random.default_rng(9)
    base = [f"w{k}" for k in rng.integers(0, 999, 300)]
    texts = []
    for k in range(120):
        own = list(base)
        own[int(rng.integers(0, 300))] = f"x{k}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + ["another text of a few words more"])], "doc_id long, text string")
    whole = simhash.similar_links
    with monkeypatch.context() as m:
        m.setattr(simhash, "similar_links", lambda fps: whole(fps, 20))
        assert {r.doc_id for r in simhash.keep_first(docs).collect()} == {0, 120}


def _families(rng, n, size):
    """Texts of families whose members are near the threshold of each other."""
    words, texts = [f"w{k}" for k in range(5000)], []
    for _ in range(n):
        base = list(rng.choice(words, 120))
        for _ in range(size):
            texts.append(" ".join(str(rng.choice(words)) if rng.random() < 0.018 else w for w in base))
    return texts


def _near_classes(texts):
    """Classes of pairs that are similar and within ``MOST`` bits, and the number of such pairs."""
    sets = [decontaminate.shingles_of(t) for t in texts]
    prints = [simhash.wide_fingerprint(np.unique(simhash.shingle_hashes(next(w for _, w in wordvec.text_words([t.encode()])), 5))) for t in texts]
    own, pairs = list(range(len(texts))), 0
    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and sum(int(a ^ b).bit_count() for a, b in zip(prints[i].tolist(), prints[j].tolist(), strict=True)) <= simhash.MOST:
                pairs += 1
                a, b = own[i], own[j]
                own = [min(a, b) if x in (a, b) else x for x in own]
    return own, pairs


def test_links_that_fail_hide_none(spark, monkeypatch):
    texts = _families(np.random.default_rng(12), 40, 14)
    classes, pairs = _near_classes(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(simhash, "plan_tries", lambda n: (0, 1))  # one node holds all, so only pruning can lose a pair
    assert pairs > 200 and 40 < len(set(classes)) < 400
    assert {r.doc_id for r in simhash.keep_first(docs).collect()} == set(classes)
    whole = simhash.decide_clusters
    monkeypatch.setattr(simhash, "decide_clusters", lambda rows: whole(rows, 300))  # clusters are dealt into blocks of a few texts
    assert {r.doc_id for r in simhash.keep_first(docs).collect()} == set(classes)


def test_blocks_of_large_nodes_lose_nothing(spark, monkeypatch):
    rng = np.random.default_rng(13)
    base = rng.integers(0, 2**63, (6, simhash.WORDS), dtype=np.uint64)
    rows = np.array([b ^ np.array([sum(1 << int(x) for x in set(rng.integers(0, 64, rng.integers(0, 12)).tolist())) for _ in range(4)], np.uint64) for b in base for _ in range(30)])
    df = spark.createDataFrame([(*[int(x) for x in r.view(np.int64)], i) for i, r in enumerate(rows)], "w0 long, w1 long, w2 long, w3 long, rep long")
    monkeypatch.setattr(simhash, "plan_tries", lambda n: (0, 1))

    def classes(links):
        own = list(range(len(rows)))
        for a, b in links:
            a, b = own[a], own[b]
            own = [min(a, b) if x in (a, b) else x for x in own]
        return own

    due = classes([(i, j) for i in range(len(rows)) for j in range(i) if np.bitwise_count(rows[i] ^ rows[j]).sum() <= simhash.MOST])
    for most in (7, 10_000):
        assert classes([(r.a, r.b) for r in simhash.similar_links(df, most).collect()]) == due


def test_null_ids_stay(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, "e f g h"), (3, "a b c d")], "doc_id long, text string")
    assert sorted(str(r.component_id) for r in simhash.near_duplicates(docs).collect()) == ["3", "3", "None"]
    assert simhash.keep_first(docs).count() == 3


def test_trie_equals_all_pairs_with_hot_nodes(spark):
    rng = np.random.default_rng(2)
    fps = set()
    for b in rng.integers(0, 2**63, 25, dtype=np.uint64).tolist():
        for _ in range(30):
            x = b
            for k in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                x ^= 1 << k
            fps.add(x)
    fps = sorted(fps)
    want = _classes(fps)
    df = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in enumerate(fps)], "rep long, fp long")
    from pitmill.operators.graph import connected_components

    for hot in (simhash.MAX_NODE, 5):  # the second splits nodes by the shuffle
        got = {r.node: r.component for r in connected_components(simhash.trie_self_join(df, 3, hot)).collect()}
        assert [got.get(i, i) for i in range(len(fps))] == want


def test_containment_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(400)]
    text = lambda n: " ".join(rng.choice(words, n))
    items = [(k, text(n)) for k, n in enumerate((3, 5, 12, 20, 33, 57, 140, 0))] + [(8, None)]
    docs = []
    for k, t in items[:7]:
        w = t.split()
        docs += [text(int(rng.integers(50, 3000))) + " " + t.upper().replace(" ", ", ") + "! " + text(500), text(90) + " " + " ".join(w[: len(w) // 2]) + " " + text(40), " ".join([*w[:-1], "zzz"]) + " " + text(30)]
    docs += [None, "", items[0][1], items[3][1]] + docs[:3]
    d = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(docs)], "doc_id long, text string, item_id string")
    b = spark.createDataFrame(items + items[:2], "item_id long, text string")
    want = set()
    for i, t in enumerate(docs):
        for k, q in items:
            s, h = decontaminate.shingles_of((q or "").lower()), decontaminate.shingles_of((t or "").lower())
            if s and len(s & h) >= 0.8 * len(s) - 1e-9:
                want.add((i, k, len(s & h)))
    got = [(r.doc_id, r.item_id, r.shared) for r in decontaminate.contaminated(d, b).collect()]
    assert set(got) == want and len(got) == len(want) and len(want) > 8
    clean = {r.doc_id for r in decontaminate.drop_contaminated(d, b).collect()}
    assert clean == set(range(len(docs))) - {i for i, *_ in want}
    assert decontaminate.contaminated(d, b.limit(0)).count() == 0 and decontaminate.contaminated(d.limit(0), b).count() == 0


def test_word_hashes_don_t_depend_on_batches():
    texts = [("The cat, the  CAT é" * k).encode() for k in range(60)] + [b"", b"x" * 3000]
    whole = dict(wordvec.text_words(texts))
    held = wordvec.PIECE
    wordvec.PIECE = 100
    try:
        assert all(np.array_equal(whole[i], w) for i, w in wordvec.text_words(texts))
    finally:
        wordvec.PIECE = held
    assert whole[1][0] == whole[1][2] == wordvec.word_hash("the")


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((900, 16)) * rng.uniform(0.5, 2, (900, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[5][1]) for i in range(60)]  # a group of copies
    rows += [(2000, None), (2020, [0.0] * 16), (2040, [float("nan")] * 16), (2060, [None] * 16), (None, rows[1][1]), (2080, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, score string")
    good = [(i, np.array(v)) for i, v in rows if i is not None and i < 2000]
    ids, mat = np.array([g[0] for g in good]), np.stack([g[1] for g in good])
    index = hnsw.build_index(df, k=20, spread=6)
    assert index.count() >= 6  # five cells of one length, one vector of another
    got = hnsw.search_index(index, df.where("vec_id % 20 = 0"), k=20).collect()
    hit = total = 0
    for q in ids[ids % 20 == 0]:
        s = (mat * mat[ids == q][0]).sum(axis=1)
        s[ids == q] = -np.inf
        want = [ids[k] for k in np.lexsort((ids, -s))[:20]]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 21)) and all(abs(m[2] - s[ids == m[1]][0]) < 1e-12 for m in mine)
        hit += len(set(want) & {m[1] for m in mine})
        total += 20
    assert hit / total >= 0.95
    assert {r.query_id for r in got} == set(ids[ids % 20 == 0].tolist()) | {2080} - {2080}
    assert hnsw.build_index(df.limit(0)).count() == 0


def test_neighbours_over_many_shards(spark):
    rng = np.random.default_rng(5)
    mid = rng.standard_normal((40, 12)) * 3
    x = mid[rng.integers(0, 40, 4000)] + rng.standard_normal((4000, 12))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    index = hnsw.build_index(df, k=20, spread=2)
    assert index.count() >= 32
    got = hnsw.search_index(index, df.where("vec_id % 20 = 0"), k=20, probes=12).collect()
    want = set()
    for q in range(0, 4000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        want |= {(q, int(k)) for k in np.argsort(-s)[:20]}
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want) and len(got) == len(want)


def test_probes_follow_the_data(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((3000, 16))  # isotropic: neighbours lie in many cells
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    index = hnsw.build_index(df, k=20, spread=1)
    assert index.select("cell").distinct().count() >= 50
    monkeypatch.setattr(hnsw, "PART_QUERIES", 40)  # several copies of a graph
    got = hnsw.search_index(index, df.where("vec_id % 20 = 0"), k=20).collect()
    want = set()
    for q in range(0, 3000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        want |= {(q, int(k)) for k in np.argsort(-s)[:20]}
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want) and len(got) == len(want)


def test_queries_of_one_id_have_lists_of_their_own(spark):
    rows = [(k, [float(k == j) + 0.1 for j in range(4)]) for k in range(4)] + [(20, [1.0, 0.0, 0.0, 0.0]), (20, [0.0, 0.0, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = hnsw.search_index(hnsw.build_index(df), df.where("vec_id = 20"), k=3).collect()
    assert sorted((r.rank, r.vec_id) for r in got if r.score > 1) == [(1, 0), (1, 3)] and len(got) == 6
    index = hnsw.build_index(df.limit(0))
    assert hnsw.search_index(index, df).count() == 0


def test_short_items_in_long_documents_are_all_found(spark):
    rng = np.random.default_rng(6)
    words = [f"w{k}" for k in range(5000)]
    text = lambda n: " ".join(rng.choice(words, n))
    items = [(k, text(5 + k % 8)) for k in range(400)]
    docs = [(k, f"{text(300)} {t} {text(300)}" if k % 2 else f"{t} {text(300)}") for k, t in items]
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(k, k) for k, _ in items} <= {(r.doc_id, r.item_id) for r in got}


def test_rows_without_ids_link_and_repeated_ids_keep_their_texts(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c"), (None, "d e f"), (2, "g h i"), (None, "j k l"), (7, "x"), (7, "y")], "doc_id long, text string")
    rows = [(1, 0b11), (None, 0), (2, 0b11000), (None, -1), (7, 0xFFFF << 20), (7, 0xFFFF << 40)]
    prints = spark.createDataFrame(rows, "doc_id long, fp long")
    with monkeypatch.context() as m:
        m.setattr(simhash, "fingerprints", lambda *_: prints)
        got = sorted((str(r.doc_id), r.fp, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert [g[2] for g in got if g[1] in (0b11, 0, 0b11000)] == [1, 1, 1]
    assert [g[2] for g in got if g[1] == -1] == [None]
    assert sorted(r.text for r in simhash.keep_first(docs.where("doc_id = 7")).collect()) == ["x", "y"]


def test_decontamination_keeps_clashing_columns(spark):
    item = " ".join(f"b{k}" for k in range(20))
    docs = spark.createDataFrame([(1, f"x {item} y", "s", "t"), (2, "clean text", "s", None)], "doc_id long, text string, sha string, sha_ string")
    got = decontaminate.drop_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert [tuple(r) for r in got.collect()] == [(2, "clean text", "s", None)] and got.columns == docs.columns


def test_links_of_a_large_group_do_not_grow_with_the_tries(spark, monkeypatch):
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(3000)]
    base = list(rng.choice(words, 200))
    rows = []
    for k in range(240):  # near copies: pairs at a similarity of 0.9
        own = list(base)
        own[int(rng.integers(200))] = f"own{k}"
        rows.append((k, " ".join(own)))
    rows += [(1000 + k, " ".join(rng.choice(words, 80))) for k in range(30)]
    edges, whole = [], simhash.connected_components

    def counted(links, *rest):
        edges.append(links.count())
        return whole(links, *rest)

    monkeypatch.setattr(simhash, "connected_components", counted)
    kept = {r.doc_id for r in simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {0, *range(1000, 1030)}
    assert max(edges) <= 6 * 240  # a few tries' links; each of the 53 tries has a forest of its own


def test_components_of_few_edges_leave_few_files(spark, monkeypatch):
    """Few edges stay in a few partitions from round to round, however many shuffle partitions are set; the way of many edges gives the same."""
    from pitmill.operators import graph

    held = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    parts, cut = [], graph.cut

    def counted(df):
        out = cut(df)
        parts.append(out.rdd.getNumPartitions())
        return out

    monkeypatch.setattr(graph, "cut", counted)
    chain = [(k, k + 1) for k in range(1, 6)] + [(100, k) for k in range(101, 105)] + [(200, 200), (None, 7), (300, 299)]
    edges = spark.createDataFrame(chain, "a long, b long")
    want = {k: 1 for k in range(1, 7)} | {k: 100 for k in range(100, 105)} | {299: 299, 300: 299}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = graph.connected_components(edges)
        assert dict(found.collect()) == want and found.count() == len(want)
        assert max(parts[1:]) <= 4
        monkeypatch.setattr(graph, "SMALL", 0)
        assert dict(graph.connected_components(edges).collect()) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
