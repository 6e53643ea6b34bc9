import random
import re
import time

import numpy as np
import pytest

from strata.llm import jaccard_join as jj
from strata.llm import store
from strata.llm.components import connected_components
from tests.llm.conftest import WORDS, lowered


def brute(docs: dict, k=5, percent=75):
    sets = {}
    for d, t in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(t))
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
    root = {d: d for d in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    names = sorted(docs)
    for i, a in enumerate(names):
        for b in names[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in docs}


def corpus(rng, n):
    """Families of copies with more and more words changed, shared passages, short texts."""
    passages = [[rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(20)] for _ in range(4)]
    docs, base = {}, None
    for i in range(n):
        kind = rng.random()
        if base is None or kind < 0.3:
            base = [rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(rng.randrange(1, 60))]
            if rng.random() < 0.4:
                base = base + rng.choice(passages)
        words = list(base)
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(len(words))] = rng.choice(WORDS)
        docs[i] = " ".join(words)
    return docs


@pytest.mark.parametrize("options", [{}, {"width": 64, "range_tokens": 64, "block_tokens": 60, "block_members": 3}])
def test_components_equal_brute_force(spark, options):
    docs = corpus(random.Random(5), 220)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_components(frame, **options).collect()}
    assert got == brute(docs)


def test_edge_rows(spark, edge_docs, no_docs):
    rows = jj.jaccard_components(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id}
    assert [by_id[i].n_shingles for i in (1, 2, 3, 8, 9)] == [0, 0, 0, 1, 0]
    assert [by_id[i].component_id for i in (1, 2, 3, 5, 6, 7, 8, 12)] == [1, 2, 3, 5, 5, 5, 8, 8]
    null = [r for r in rows if r.doc_id is None]
    assert {(r.n_shingles, r.component_id) for r in null} == {(by_id[5].n_shingles, 5), (0, None)}
    assert jj.jaccard_components(no_docs).count() == 0


def test_threshold_is_met_exactly():
    a = np.arange(100, dtype=np.uint64)
    for shared, linked in ((85, False), (86, True)):  # 85/115 < 0.75 <= 86/114
        b = np.concatenate([a[:shared], np.arange(1000, 1100 - shared, dtype=np.uint64)])
        assert bool(jj.tree_links([1, 2], [100, 100], [a, b], 75)[0]) == linked


@pytest.mark.parametrize("sides", [False, True])
def test_tree_equals_all_pairs(sides):
    rng = random.Random(9)
    base = [rng.sample(range(60), 25) for _ in range(4)]
    sets = [np.array(sorted(set(rng.choice(base)) ^ set(rng.sample(range(60), rng.randrange(0, 5)))), np.uint64)
            for _ in range(120)]
    sizes = [len(s) + rng.randrange(3) for s in sets]
    side = [rng.randrange(2) for _ in sets] if sides else None
    a, b = jj.tree_links(list(range(120)), sizes, sets, 75, side)
    root = dict(zip(a, b))
    forest = jj._Forest()
    for i in range(120):
        for j in range(i):
            both = len(set(sets[i].tolist()) & set(sets[j].tolist()))
            if (not sides or side[i] != side[j]) and 100 * both >= 75 * (sizes[i] + sizes[j] - both):
                forest.join(i, j)
    assert [root.get(i, i) for i in range(120)] == [forest.find(i) for i in range(120)]


def test_packed_tokens_return():
    rng = np.random.default_rng(1)
    for values in (np.array([0], np.uint64), np.array([2 ** 64 - 1], np.uint64),
                   np.sort(rng.integers(0, 2 ** 64, 1000, dtype=np.uint64)), np.arange(300, dtype=np.uint64)):
        assert jj._unpack(jj._pack(values)).tolist() == values.tolist()


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300) * 7, rng.randrange(300) * 7) for _ in range(220)] + [(x, x + 1) for x in range(5000, 5080)]
    got = {r.node: r.component for r in
           connected_components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()}
    forest = jj._Forest()
    for a, b in edges:
        forest.join(a, b)
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert got == {x: forest.find(x) for x in nodes}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_large_block_is_dealt_in_proportion(spark, monkeypatch):
    """Near copies of one text with a few odd ones among them: one block of many parts."""
    across, dealt = jj._across, []
    monkeypatch.setattr(jj, "_across", lambda *a: dealt.append(across(*a)) or dealt[-1])

    def block(n):
        rng = random.Random(n)
        base = [f"w{i}" for i in range(60)]
        docs = {}
        for i in range(n):
            words = list(base)
            words[rng.randrange(60)] = f"x{rng.randrange(40)}"
            if i % 500 == 7:  # near none, but sharing rare shingles with some
                words[10] = words[30] = words[50] = f"x{i // 500}"
            docs[i] = " ".join(words)
        frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)
        got = jj.jaccard_components(frame, block_members=100).collect()
        near = {r.doc_id for r in got if r.doc_id % 500 != 7}
        assert {r.component_id for r in got if r.doc_id in near} == {min(near)}
        assert all(r.component_id == r.doc_id for r in got if r.doc_id not in near)
        return dealt[-1].count()

    small, large = block(2_000), block(20_000)
    assert 0 < large < 12 * small


def test_a_rest_that_links_across_parts(spark, monkeypatch):
    """Chains of texts, each near the next only: links that no part of a cut has are found."""
    rng = random.Random(4)
    words, docs = [f"w{i}" for i in range(70)], {}
    for i in range(150):
        words[(i * 3) % 70] = f"v{rng.randrange(10_000)}"
        docs[i] = " ".join(words)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jj.jaccard_components(frame, block_members=5).collect()}
    assert got == brute(docs)


def kept_tables(monkeypatch):
    """The tables that the join writes, by name."""
    tables, written = {}, jj.written
    monkeypatch.setattr(jj, "written", lambda df, name: tables.setdefault(name, written(df, name)))
    return tables


def test_copies_of_a_set_travel_once(spark, monkeypatch):
    """Every text six times, in other tasks: the exchange carries each set once, others not at all."""
    tables = kept_tables(monkeypatch)
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10_000)}" for _ in range(40)) for _ in range(30)]
    texts += [t.replace(t.split()[20], "other") for t in texts[:10]]
    docs = {i: texts[i % 40] for i in range(240)}
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartitionByRange(6, "doc_id")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_components(frame).collect()}
    assert got == brute(docs)
    assert tables["jaccard-sets"].count() == 20  # the ten texts with a near copy, and these


def test_near_copies_of_many_texts_stay_in_blocks_of_their_own(spark, monkeypatch):
    """Groups of near copies whose shingles, but for a few, many texts have: a small count
    array (now: sieve) must not put rare and common shingles on a level."""
    tables = kept_tables(monkeypatch)
    rng = random.Random(9)
    common = [[rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(30)] for _ in range(8)]
    docs = {}
    for i in range(200):
        own = [f"o{i}x{j}" for j in range(45)]
        for j in range(4):
            words = own + rng.choice(common)
            words[10 * j] = f"z{i}x{j}"
            docs[4 * i + j] = " ".join(words)
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.jaccard_components(frame, width=64).collect()}
    assert got == brute(docs)
    assert max(r["count"] for r in tables["jaccard-blocks"].groupBy("block").count().collect()) <= 20


def test_sieve_never_misses(spark):
    rng = np.random.default_rng(2)
    names = rng.integers(-2 ** 63, 2 ** 63, 4000)
    frame = spark.createDataFrame([(int(x),) for x in names], "row long").repartition(5)
    for width, most in ((1 << 20, 0.02), (64, 1)):
        sieve = jj._sieve(frame, 4000, width).value
        assert sieve.has(names).all() and sieve.slices.nbytes <= 16 * width
        assert sieve.has(rng.integers(-2 ** 63, 2 ** 63, 4000)).mean() <= most
    assert not jj._sieve(frame.limit(0), 0, 64).value.has(names).any()
    assert jj._sieve(frame.limit(0), 0, 64).value.has(names[:0]).tolist() == []


def test_written_leaves_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {str(f) for f in list(disk.getAllFiles().mkString("\n").split("\n")) if "shuffle_" in f}

    before = files()
    option = spark.conf.get(store._CLEANUP, None) if hasattr(store, "_CLEANUP") else None
    frame = store.written(spark.range(1000).repartition(3, "id"), "test-shuffle")
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert frame.count() == 1000
    assert spark.conf.get(store._CLEANUP, None) == option
