"""Licences, line dedup, pieces, token counts, decontamination: brute force and edge rows."""

import hashlib
import os
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.llm import decontaminate, langid, phrases, pieces, quality_fm, queries, token_counts
from strata.llm import licences as lic
from strata.llm.line_dedup import dedup_lines
from tests.llm.conftest import lowered, prose

needs_model = pytest.mark.skipif(not os.path.exists(queries.PIECE_MODEL), reason="no vocabulary files here")


# --- licences ------------------------------------------------------------------------

def dice(a: str, b: str) -> float:
    def pairs(t):
        w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", lowered(t))
        return set(zip(w, w[1:])) if len(w) > 1 else set(w)

    x, y = pairs(a), pairs(b)
    return 2 * len(x & y) / (len(x) + len(y)) if x and y else 0.0


def test_licence_units_equal_brute_force(spark):
    rng = random.Random(4)
    notices = [t for ts in lic.TEMPLATES.values() for t in ts]
    texts = []
    for i in range(60):
        lines = [prose(rng, rng.randrange(1, 12)).replace("\n", " ") for _ in range(rng.randrange(0, 5))]
        if i % 2:
            words = rng.choice(notices).split()
            for _ in range(rng.randrange(0, 3)):
                words[rng.randrange(len(words))] = "word"
            if rng.random() < 0.5:
                words.insert(len(words) // 2, "\n")
            lines.insert(rng.randrange(len(lines) + 1), " ".join(words))
        texts.append(rng.choice(["\n", "\n\n"]).join(lines))
    rows = lic.licence_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {(r.doc_id, r.unit, texts[r.doc_id][r.start:r.end]): (r.licence, round(r.dice, 9)) for r in rows}
    want = {}
    for i, t in enumerate(texts):
        lines = [x for x in t.split("\n") if x]
        paragraphs = [p for p in re.split(r"\n{2,}", t) if p.strip("\n")]
        units = ([("line", x) for x in lines] + [("paragraph", p) for p in paragraphs if len([x for x in p.split("\n") if x]) > 1]
                 + ([("document", t)] if len(paragraphs) > 1 else []))
        for kind, u in units:
            best = min((-dice(u, x), name) for name, ts in lic.TEMPLATES.items() for x in ts)
            if -best[0] >= 0.8:
                core = re.search(r"[0-9A-Za-z\x80-\U0010ffff](.*[0-9A-Za-z\x80-\U0010ffff])?", u, re.S)[0]
                want[(i, kind, core)] = (best[1], round(-best[0], 9))
    assert got == want and len(got) > 15


def test_licence_edge_rows(edge_docs, no_docs):
    assert lic.licence_scan(edge_docs).count() == 0
    assert lic.licence_scan(no_docs).count() == 0


# --- line dedup ----------------------------------------------------------------------

def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(6)
    pool = [prose(rng, rng.randrange(3, 15)).replace("\n", " ") for _ in range(12)]
    docs = {i: "\n".join(rng.choice(["", rng.choice(pool), rng.choice(pool).upper() + "  ", prose(rng, 9)])
                         for _ in range(rng.randrange(0, 8))) for i in range(60)}
    frame, spans, text = dedup_lines(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3))
    got = {r.doc_id: (r.t, [tuple(s) for s in r.s or []]) for r in frame.select("doc_id", text.alias("t"), spans.alias("s")).collect()}
    seen, want = set(), {}
    for i in sorted(docs):
        kept, cut, at = [], [], 0
        for line in docs[i].split("\n"):
            key = tuple(re.findall(r"[^\x20\x09-\x0D]+", lowered(line)))
            if len(key) >= 8 and key in seen:
                cut.append((at, at + len(line)))
            else:
                kept.append(line)
            if len(key) >= 8:
                seen.add(key)
            at += len(line) + 1
        want[i] = ("\n".join(kept), cut)
    assert got == want and any(c for _, c in want.values())


def test_line_dedup_edge_rows(edge_docs, no_docs):
    frame, spans, text = dedup_lines(edge_docs)
    rows = frame.select("doc_id", "text", text.alias("new"), F.size(spans).alias("k")).collect()
    assert len(rows) == edge_docs.count()
    assert {(r.doc_id, r.new) for r in rows if r.doc_id in (1, 2, 3, 9)} == {(1, None), (2, ""), (3, " \n\t\r "), (9, "\n\n")}
    assert all(r.new == r.text for r in rows if r.doc_id in (4, 5, 8, 10, 11))  # both rows of 5 are one document
    lines = [x for x in next(r.text for r in rows if r.doc_id == 6).split("\n") if len(x.split()) >= 8]
    assert lines and all(x not in r.new.split("\n") for r in rows if r.doc_id == 6 for x in lines)
    frame, _, text = dedup_lines(no_docs)
    assert frame.select(text).count() == 0


# --- pieces --------------------------------------------------------------------------

def best_score(model, text):
    """Plain dynamic programme over all pieces."""
    table = {}
    for p, s, _ in model.pieces:
        table[p] = max(s, table.get(p, s))
    longest = max(map(len, table))
    text = " " + text
    score = [0.0]
    for e in range(1, len(text) + 1):
        options = [score[a] + table[text[a:e]] for a in range(max(0, e - longest), e) if text[a:e] in table]
        if text[e - 1] not in table:
            options.append(score[e - 1] + model.penalty)
        score.append(max(options, default=float("-inf")))
    return score[-1]


@needs_model
def test_pieces_are_optimal_and_return(spark):
    model = pieces.load_model(queries.PIECE_MODEL)
    rng = random.Random(8)
    texts = [prose(rng, 30) for _ in range(10)] + ["", " ", "  a  b\n\n c ", "é▁ü 漢字  z😀\t", "▁▁", "x" * 300, " lead", "trail  "]
    rows = pieces.encode_decode(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    scores = {i: s for _, s, i in model.pieces}
    spelled = set(model.spell)
    for r in rows:
        t = texts[r.doc_id]
        assert r.decoded == t and r.n_tokens == len(r.ids)
        if t:
            single = {p for p, _, _ in model.pieces if len(p) == 1}
            odd = sum(c not in single for c in " " + t)
            value = sum(scores[i] for i in r.ids if i not in spelled) + odd * model.penalty
            assert value == pytest.approx(best_score(model, t))
    uncut = pieces.Encoder(model, cut=False)
    cut = pieces.Encoder(model)
    assert all(uncut.encode(t) == cut.encode(t) for t in texts)


@needs_model
def test_pieces_edge_rows(edge_docs, no_docs):
    model = pieces.load_model(queries.PIECE_MODEL)
    rows = pieces.encode_decode(edge_docs, model).collect()
    texts = [r.text for r in edge_docs.select("text").collect()]
    assert sorted(str(r.decoded) for r in rows) == sorted(map(str, texts))
    assert {(r.ids is None, r.n_tokens) for r in rows if r.doc_id == 1} == {(True, 0)}
    assert pieces.encode_decode(no_docs, model).count() == 0
    assert pieces.decode_bytes(model.bytes_of, [-5, 10 ** 9, 1]) == ""


# --- token counts --------------------------------------------------------------------

@needs_model
def test_lengths_and_suffix_sums(spark, edge_docs, no_docs):
    import tiktoken

    ranks = token_counts.load_ranks(queries.BPE_RANKS)
    coder = tiktoken.Encoding("t", pat_str=queries.BPE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    odd = ["a   b  c　 d", "x  \n\n y\t\tz ", "é à\u0085 b", "don't  we'll", "…  — x", "a\x1f b\x1c c"]
    texts = odd + [prose(rng, rng.randrange(200)) for _ in range(40)] + [r.text for r in edge_docs.select("text").collect()]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    lengths = frame.select("text", token_counts.length_column(spark, F.col("text"), ranks, queries.BPE_PATTERN).alias("n_tokens"))
    rows = lengths.collect()
    assert all(r.n_tokens == len(coder.encode_ordinary(r.text or "")) for r in rows)
    n = sorted(r.n_tokens for r in rows)
    sums = token_counts.suffix_sums(token_counts.length_histogram(lengths), block=16)
    for r in sums.collect():
        limit = r.n_tokens
        assert (r.n_docs, r.tokens) == (n.count(limit), n.count(limit) * limit)
        assert (r.docs_over, r.tokens_over) == (sum(x > limit for x in n), sum(x for x in n if x > limit))
        assert r.truncated_tokens == sum(min(x, limit) for x in n) and r.kept_tokens == sum(x for x in n if x <= limit)
        assert r.quantile == pytest.approx(sum(x <= limit for x in n) / len(n))
    for r in token_counts.at_limits(sums, [0, 3, 17, 10 ** 9]).collect():
        assert (r.docs_over, r.truncated_tokens) == (sum(x > r.context_limit for x in n), sum(min(x, r.context_limit) for x in n))
    got = {r.share: r.n_tokens for r in token_counts.quantiles(sums, [0.1, 0.5, 1.0]).collect()}
    assert got == {q: min(x for x in n if sum(y <= x for y in n) / len(n) >= q - 1e-12) for q in got}
    empty = no_docs.select(token_counts.length_column(spark, F.col("text"), ranks, queries.BPE_PATTERN).alias("n_tokens"))
    assert token_counts.suffix_sums(token_counts.length_histogram(empty)).count() == 0


# --- decontamination -----------------------------------------------------------------

def leaks_by_hand(docs, items, window=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))

    patterns = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - window + 1)) if w else ():
            patterns.setdefault(tuple(w[k:k + window]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w, hit, names = words(t), set(), set()
        for p, ids in patterns.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k:k + len(p)]) == p:
                    hit.update(range(k, k + len(p)))
                    names |= ids
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("limit", [32 << 20, 60])
def test_leaks_equal_brute_force(spark, edge_docs, no_docs, limit):
    rng = random.Random(7)
    items = [(i, prose(rng, rng.randrange(1, 16))) for i in range(12)] + [(3, "ONE"), (None, "mila mila"), (20, None), (21, "--")]
    docs = [(i + 1000, " ".join([prose(rng, 12), rng.choice(items)[1] or "", prose(rng, 5)])) for i in range(60)]
    docs += [(r.doc_id, r.text) for r in edge_docs.filter("doc_id <> 4").select("doc_id", "text").collect()]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    table = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    rows = decontaminate.contamination(frame, table, automaton_bytes=limit).collect()
    assert sorted(tuple(r)[:6] for r in rows) == sorted(leaks_by_hand(docs, items))
    texts = dict(docs)
    for r in rows:
        for s in r.spans if (r.doc_id or 0) >= 1000 else ():  # offsets of the original text
            part = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(texts[r.doc_id][s.start:s.end]))
            assert len(part) == s.last_word - s.first_word + 1
    assert decontaminate.contamination(no_docs, table).count() == 0
    none = decontaminate.contamination(frame, table.limit(0)).collect()
    assert not any(r.contaminated for r in none) and len(none) == len(docs)


# --- SQL twins -----------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    got = queries.QUERIES[name](spark, folder)
    want = con.execute(queries.ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(repr, want.fetchall()))


# --- fingerprints --------------------------------------------------------------------

def test_names_do_not_depend_on_the_offset():
    import numpy as np

    rng = random.Random(3)
    shared, levels = prose(rng, 400).encode(), []
    for lead in ("", "z", "some other start of it "):
        data = np.frombuffer(lead.encode() + shared, np.uint8)
        levels.append([set(n.tolist()) for _, _, n in phrases.names_by_level(data, np.array([0, len(data)]))][:4])
    for level in range(4):
        first = levels[0][level]
        for other in levels[1:]:
            assert len(first - other[level]) <= 6  # only next to the edge


def test_phrases_are_short_and_cover_runs():
    import numpy as np

    data = np.frombuffer(("a" * 5000 + "bc" * 500 + prose(random.Random(1), 300)).encode(), np.uint8)
    counts = [len(n) for _, _, n in phrases.names_by_level(data, np.array([0, len(data)]))]
    assert all(2 * b <= a + 1 for a, b in zip(counts, counts[1:])) and counts[-1] == 1


def test_fingerprints_and_edited_texts(spark, edge_docs, no_docs):
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(0, 200)) for _ in range(40)]
    texts[7] = texts[3]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for parts in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        rows = sorted(phrases.fingerprints(frame).collect())
        spark.conf.set("spark.sql.shuffle.partitions", 8)
        for i, r in enumerate(rows):
            new = texts[i][:len(texts[i]) - len(texts[i]) // 2] + texts[(i + 1) % 40][:len(texts[i]) // 2]
            assert (r.doc_id, r.n_chars, r.edited_sha256) == (i, len(texts[i]), hashlib.sha256(new.encode()).hexdigest())
            own, edit, after = phrases.sketch_texts([texts[i], new, texts[(i + 1) % 40]])
            assert (r.fingerprint, r.edited_fingerprint) == (phrases.fingerprint(own), phrases.fingerprint(edit))
            assert r.near_edited == phrases.likeness(own, edit) and r.near_next == phrases.likeness(own, after)
        assert rows[3].fingerprint == rows[7].fingerprint
    rows = phrases.fingerprints(edge_docs).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.near_edited <= 1 for r in rows)
    same = {r.fingerprint for r in rows if r.doc_id in (5, 6)}
    assert len(same) == 1 and {r.n_chars for r in rows if r.doc_id in (1, 2)} == {0}
    assert phrases.fingerprints(no_docs).count() == 0
    alone = phrases.fingerprints(frame.filter("doc_id = 1")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_likeness_follows_the_overlap():
    rng = random.Random(9)
    a, b = prose(rng, 3000), prose(random.Random(10), 3000)
    s = phrases.sketch_texts([a, a[:len(a) // 2] + b[:len(b) // 2], b, a + "!", ""])
    near = [float(phrases.likeness(s[0], x)) for x in s]
    assert near[0] == 1 and 0.15 < near[1] < 0.6 and near[2] < near[1] and near[3] > 0.9 and near[4] == 0
    assert float(phrases.likeness(s[4], s[4])) == 1


# --- classifiers ---------------------------------------------------------------------

def test_gru_gradients():
    import numpy as np

    rng = np.random.default_rng(0)
    net = langid.BiGru.fresh(["a", "b", "c"], 4, 1)
    net.params = {k: v.astype(np.float64) for k, v in net.params.items()}
    x, y = rng.integers(97, 120, (5, 6)), rng.integers(0, 3, 6)

    def loss():
        return -np.log(net.probabilities(x)[:, np.arange(6), y]).mean()

    net.probabilities = lambda x: langid._softmax(np.concatenate(
        [net._pass("f", x)[0], net._pass("b", x[::-1])[0][::-1]], 2) @ net.params["w"] + net.params["b"])
    grads = net.step(x, y)
    for k, v in net.params.items():
        flat = np.flatnonzero(np.abs(grads[k]) > 1e-4)[:3]
        for i in flat:
            at = np.unravel_index(i, v.shape)
            keep = v[at]
            v[at] = keep + 1e-2
            up = loss()
            v[at] = keep - 1e-2
            down = loss()
            v[at] = keep
            assert grads[k][at] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=2e-4)


def test_languages_held_out(spark, edge_docs, no_docs):
    rows = queries.op7_language_id(spark, "/root/testdata/sf0.001").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert len(rows) == len(truth) and len(held) > 40 and sum(held) / len(held) > 0.95
    model = langid.fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    rows = langid.identify(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {(r.lang_pred, r.score) for r in rows if r.doc_id in (1, 2, 3, 9, 13)} == {("und", 0.0)}
    assert all(r.lang_pred != "und" for r in rows if r.doc_id in (4, 8, 10, 11))
    assert all(r.held_out for r in rows if r.doc_id is None)
    assert langid.fit(no_docs) is None and langid.identify(no_docs, None).count() == 0
    assert {r.lang_pred for r in langid.identify(edge_docs, None).collect()} == {"und"}
    labels = langid.position_labels(model, "la casa y the house")
    assert len(labels) == 19 and labels[2] == "und" and set(labels) <= {*model.langs, "und"}


def test_factorisation_equals_pair_sum():
    import numpy as np

    rng = np.random.default_rng(2)
    m = quality_fm.Machine(0.3, rng.standard_normal(50), rng.standard_normal((50, 3)))
    rows, slots, x = np.repeat([0, 1], 6), np.concatenate([rng.permutation(50)[:6], rng.permutation(50)[:6]]), rng.random(12)
    got = m.margins(rows, slots, x, 3)
    for r in range(2):
        s, v = slots[rows == r], x[rows == r]
        want = 0.3 + m.w[s] @ v + sum((m.v[s[i]] @ m.v[s[j]]) * v[i] * v[j] for i in range(6) for j in range(i))
        assert got[r] == pytest.approx(want)
    assert got[2] == pytest.approx(0.3)


def test_quality_held_out(spark, edge_docs, no_docs):
    folder = "/root/testdata/sf0.01"
    rows = queries.op5_quality_fm(spark, folder).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(r.predicted, labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]
    good = [s for _, y, s in held if y == 1]
    bad = [s for _, y, s in held if y == 0]
    assert sum(p == y for p, y, _ in held) / len(held) > 0.9
    assert sum(a > b for a in good for b in bad) / len(good) / len(bad) > 0.9
    table = spark.createDataFrame([(5, 1, 0), (4, 0, 0), (7, None, 1), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    machine = quality_fm.fit(edge_docs, table)
    rows = quality_fm.score_quality(edge_docs, machine).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert quality_fm.fit(no_docs, table) is None
    assert {r.score for r in quality_fm.score_quality(edge_docs, None).collect()} == {0.5}


def test_windows_label_every_byte_once_between_characters():
    import numpy as np

    rng = random.Random(3)
    texts = ["", "a", "é" * 400, "漢字ภาษา😀" * 90, prose(rng, 900), "x" * langid.WINDOW, "😀" * 71]
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    flat = np.frombuffer(b"".join(data), np.uint8)
    row, a, z, first, last = langid.windows(flat, offsets)
    covered = np.zeros(len(flat), int)
    for r, s, e, f, l in zip(row, a, z, first, last):
        assert offsets[r] <= s <= f <= l <= e <= offsets[r + 1] and e - s <= langid.WINDOW + 3
        flat[s:e].tobytes().decode()
        flat[f:l].tobytes().decode()
        assert s == offsets[r] or f - s >= langid.CONTEXT - 3
        assert e == offsets[r + 1] or e - l >= langid.CONTEXT - 3
        covered[f:l] += 1
    assert (covered == 1).all()


def test_score_is_the_mean_over_all_positions(spark):
    """And the state runs on over words: the same word has other probabilities elsewhere."""
    import numpy as np

    rng = random.Random(4)
    texts = [prose(rng, 300), "short é", "漢字かな " * 120, "one two " * 5]
    model = langid.train([prose(rng, 400), "漢字かな " * 300, "ab cd. " * 200], ["x", "y", "z"], windows_per_lang=40, epochs=1, least_steps=5)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    for i, t in enumerate(texts):
        letters = langid.LETTER[langid.tx.LOWER[np.frombuffer(t.encode(), np.uint8)]]
        mean = langid.position_probabilities(model, t)[letters].mean(0)
        assert got[i].lang_pred == model.langs[mean.argmax()] and abs(got[i].score - mean.max()) < 1e-4
    p = langid.position_probabilities(model, "one two " * 5)
    assert abs(p[0] - p[8]).max() > 1e-6


def test_training_samples_are_bounded_where_ids_repeat(spark, monkeypatch):
    rng = random.Random(5)
    docs = spark.createDataFrame([(i % 2 * 4, prose(rng, 12), "ab"[i % 2]) for i in range(300)],
                                 "doc_id long, text string, lang string")
    seen = []
    monkeypatch.setattr(langid, "train", lambda texts, langs: seen.append(langs))
    monkeypatch.setattr(langid, "is_held_out", lambda c: langid.F.lit(False))
    langid.fit(docs)
    assert seen == [["a", "b"]]
    monkeypatch.setattr(quality_fm, "is_held_out", lambda c: langid.F.lit(False))
    monkeypatch.setattr(quality_fm, "train", lambda which, i, v, y: seen.append(y.tolist()))
    quality_fm.fit(docs, spark.createDataFrame([(0, 1), (0, 1), (4, 0)], "doc_id long, quality int"))
    assert sorted(seen[1]) == [0, 1]


def test_several_runs_of_benchmark_patterns(spark):
    """More runs than a worker holds automata: same result."""
    rng = random.Random(6)
    items = [(f"i{k}", prose(rng, 25)) for k in range(30)]
    docs = [(k, f"{prose(rng, 40)} {items[k][1] if k % 2 else ''} {prose(rng, 9)}") for k in range(30)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    one, many = (sorted(tuple(r) for r in decontaminate.contamination(frame, bench, **o).collect())
                 for o in ({}, {"automaton_bytes": 1500}))
    assert one == many and sum(r[5] for r in one) >= 15
    assert len(list(decontaminate._patterns(bench, "item_id", "text", 10, 1500))) > decontaminate.HELD


def test_components_of_hubs_and_chains(spark):
    """A star, a chain and a clique; repeated edges and loops."""
    from strata.llm.components import connected_components
    edges = ([(0, i) for i in range(1, 400)] + [(1000 + i, 1001 + i) for i in range(60)]
             + [(2000 + i, 2000 + j) for i in range(12) for j in range(i)] + [(3000, 3000), (1, 0), (0, 1)])
    random.Random(1).shuffle(edges)
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()}
    want = {**{i: 0 for i in range(400)}, **{1000 + i: 1000 for i in range(61)}, **{2000 + i: 2000 for i in range(12)}}
    assert got == want


def test_lengths_are_encoded_once(spark):
    out = queries.op6_token_counts(spark, "/root/testdata/sf0.001")
    assert "ArrowEvalPython" not in out._jdf.queryExecution().executedPlan().toString()
