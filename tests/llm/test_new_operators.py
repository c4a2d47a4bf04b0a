"""The n-gram join, the whitening and the prefix trie against brute force, with edge cases."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from test_llm_operators import EDGE, brute_groups, make

from sparkinfer.llm import components as components_module
from sparkinfer.llm import ngram_join, prefix_trie, queries, whitening
from sparkinfer.llm.components import components


def edited(rng, words, share):
    return " ".join(f"x{rng.randrange(10**9)}" if rng.random() < share else w for w in words)


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (2, 60)])
def test_join_equals_brute_force_on_copies_and_shared_passages(spark, k, percent):
    rng = random.Random(k)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(5):
        base = rng.choices(words, k=rng.randrange(15, 300))
        rows += [edited(rng, base, rng.uniform(0, (100 - percent) / 250)) for _ in range(30)]
    passage = rng.choices(words, k=50)  # in many documents that are no copies
    rows += [" ".join(rng.choices(words, k=rng.randrange(1, 30)) + passage + rng.choices(words, k=9)) for _ in range(90)]
    rows += [" ".join(rng.choices(words[:4], k=rng.randrange(0, 5))) for _ in range(40)]
    rows = list(enumerate(rows)) + [(1000 + i, t) for i, (_, t) in enumerate(EDGE)]
    got = ngram_join.similar_groups(make(spark, rows), "doc_id", "text", k, percent).collect()
    assert sorted(map(tuple, got)) == sorted(brute_groups(rows, k, percent))


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (1, 51), (2, 99)])
def test_join_by_differences_from_pivots_loses_no_link(spark, monkeypatch, k, percent):
    monkeypatch.setattr(ngram_join, "FEW", 0)  # every open bucket is divided
    rng = random.Random(percent)
    words, rows = [f"w{i}" for i in range(400)], []
    for size in (12, 40, 60, 150):
        base = rng.choices(words, k=size)
        for _ in range(4):  # copies of copies
            copy = edited(rng, base, rng.uniform(0, 0.1)).split()
            rows += [edited(rng, copy[:rng.randrange(size - size // 12, size + 1)], rng.uniform(0, (100 - percent) / 100 / k)) for _ in range(15)]
    rows = list(enumerate(rows))
    got = ngram_join.similar_groups(make(spark, rows), "doc_id", "text", k, percent).collect()
    assert sorted(map(tuple, got)) == sorted(brute_groups(rows, k, percent))


@pytest.mark.parametrize("copies", [150, 600])
def test_join_compares_near_copies_in_proportion(spark, monkeypatch, copies):
    """Copies with one edit each, of which only those with close edits are similar."""
    rng = random.Random(5)
    base, rows, pairs = [f"w{i}" for i in range(100)], [], []
    for i in range(copies):
        at = rng.randrange(5) * 20 + rng.randrange(4)
        rows.append((i, " ".join([*base[:at], f"x{i}", *base[at + 1:]])))
    stored = ngram_join.stored

    def counted(df, label):
        out = stored(df, label)
        if label in ("join-pairs", "join-met"):
            pairs.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stored", counted)
    got = ngram_join.similar_groups(make(spark, rows), "doc_id", "text", 3, 90).collect()
    assert sorted(map(tuple, got)) == sorted(brute_groups(rows, 3, 90))
    assert sum(pairs) <= 20 * copies


@pytest.mark.parametrize("few", [2, 10**9])
def test_join_in_rounds_loses_no_link(spark, monkeypatch, few):
    for name, value in (("FEW", few), ("PAIRS", 1), ("PAIRS_A_MEMBER", 1)):
        monkeypatch.setattr(ngram_join, name, value)
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = list(enumerate(edited(rng, base, rng.choice([0.02, 0.05])) for _ in range(120)))
    got = ngram_join.similar_groups(make(spark, rows), "doc_id", "text", 3, 80).collect()
    assert sorted(map(tuple, got)) == sorted(brute_groups(rows, 3, 80))


def test_join_sends_a_text_once_for_its_partners(spark):
    join = object.__new__(ngram_join.NgramJoin)
    join.texts = spark.createDataFrame([(0, "a" * 50_000), *((i, "b") for i in range(1, 101))], "node long, text string")
    pairs = spark.createDataFrame([(0, i, 1) for i in range(1, 101)], "a long, b long, ways long")
    sent = join._with_texts(pairs).collect()
    assert sum(len(x) for r in sent for x in r if isinstance(x, str)) == 50_100
    assert sent[0]["b"] is None and sorted(r["b"] for r in sent[1:]) == list(range(1, 101))


def test_join_of_unlike_texts_keeps_prefixes_of_differences(spark, monkeypatch):
    """Texts made of sentences of one pool meet often and are not similar: all they differ in is ten times what can link them."""
    monkeypatch.setattr(ngram_join, "FEW", 0)
    rng, apart = random.Random(8), []
    pool = [" ".join(f"w{rng.randrange(10**9)}" for _ in range(30)) for _ in range(40)]
    rows = [(i, " ".join(rng.sample(pool, 8))) for i in range(40)]
    stored = ngram_join.stored

    def counted(df, label):
        out = stored(df, label)
        if label == "join-apart":
            apart.extend(r[0] for r in out.selectExpr("size(apart)").collect())
        return out

    monkeypatch.setattr(ngram_join, "stored", counted)
    got = ngram_join.similar_groups(make(spark, rows), "doc_id", "text", 3, 90).collect()
    assert sorted(map(tuple, got)) == sorted(brute_groups(rows, 3, 90))
    assert apart and max(apart) <= 238 * 10 // 90 + 1


def test_join_finds_frequent_shingles_among_many_others(spark, monkeypatch):
    """What other shingles bring into a cell does not hide one that 80 texts hold."""
    monkeypatch.setattr(ngram_join, "MOST_BITS", 12)
    rng = np.random.default_rng(3)
    texts = [(" ".join(f"w{x}" for x in rng.integers(0, 10**9, 202)) + " a b c" * (i < 80),) for i in range(2000)]
    counts = ngram_join.Counts(spark.createDataFrame(texts, "text string"), 3, 400_000)
    cell = int(ngram_join.shingle_hashes([b"a", b"b", b"c"], 3)[0] >> np.uint64(64 - counts.bits))
    assert counts.cells.value[cell] > counts.limit


def test_join_edge_cases(spark):
    got = ngram_join.similar_groups(make(spark, EDGE), "doc_id", "text", 3, 90)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    rows = {(r[0], r[1]): r[2] for r in got.collect()}
    assert got.count() == len(EDGE)
    assert rows[(None, 0)] is None and rows[(2, 0)] == 2 and rows[(5, max(n for _, n in rows))] == 4
    assert rows[(None, 1)] == 6 and {i: c for (i, n), c in rows.items()}[8] == -9
    assert ngram_join.similar_groups(make(spark, []), "doc_id", "text").count() == 0
    with pytest.raises(ValueError, match="cannot be named"):
        ngram_join.similar_groups(make(spark, EDGE).withColumnRenamed("doc_id", "n_shingles"), "n_shingles", "text")
    with pytest.raises(ValueError, match="percent"):
        ngram_join.similar_groups(make(spark, EDGE), "doc_id", "text", percent=50)


def test_signatures_of_similar_sets_meet():
    """Any two sets at the threshold share a key, whatever shingles are frequent."""
    rng = np.random.default_rng(1)
    for _ in range(400):
        n, percent = int(rng.integers(1, 300)), int(rng.choice([60, 80, 90]))
        pool = np.unique(rng.integers(0, 2**63, 2 * n + 5).astype(np.uint64))
        a = np.sort(rng.choice(pool, n, replace=False))
        drop = int(rng.integers(0, n + 1))
        b = np.unique(np.concatenate([a[drop:], rng.choice(pool, int(rng.integers(0, drop + 1)), replace=False)]))
        common = len(np.intersect1d(a, b))
        if not len(b) or 100 * common < percent * (len(a) + len(b) - common):
            continue
        counts = {int(h): int(c) for h, c in zip(pool, rng.integers(0, 40, len(pool)), strict=True)}
        keys = []
        for s, other in ((a, b), (b, a)):
            needed = -(-percent * (len(s) + len(other)) // (100 + percent))
            key, slack = ngram_join.signatures(s, np.array([counts[int(h)] for h in s]), 10, percent)
            keys.append(set(key[slack <= len(s) - needed].tolist()))
        assert keys[0] & keys[1]


@pytest.mark.parametrize("one_task", [0, 10**6])
def test_components_of_a_hub_and_a_chain(spark, monkeypatch, one_task):
    monkeypatch.setattr(components_module, "ONE_TASK", one_task)
    links = [(0, i) for i in range(1, 3000)] + [(10_000 + i, 10_001 + i) for i in range(300)]
    got = components(spark.createDataFrame(links, "a long, b long").repartition(7), "a", "b").toPandas()
    assert len(got) == 3301
    assert set(got.root[got.node < 3000]) == {0} and set(got.root[got.node >= 10_000]) == {10_000}


VECTORS = "vec_id long, embedding array<float>, component int, x string"


def whitened(spark, rows, k=16):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS).repartition(3)
    model = whitening.fit_whitening(df, "embedding", k)
    return model, whitening.whiten(df, "vec_id", "embedding", model).toPandas()


def test_whitening_equals_a_dense_solution(spark):
    rng = np.random.default_rng(2)
    data = rng.standard_normal((300, 24)) @ np.diag(np.linspace(0.2, 2, 24)) + 3
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(data)]
    rows += [(400 + i, rows[0][1]) for i in range(200)]  # one vector holds two fifths of the rows
    rows += [(900, None), (901, []), (902, [None] * 24), (903, [math.nan] * 24), (904, [math.inf] * 24), (905, [1.0] * 7), (None, rows[1][1])]
    model, got = whitened(spark, rows)
    x = np.array([np.floor(64 * np.array(v, np.float64)) + 1_000_000 for _, v in rows[:300]]).astype(np.int64)
    fit = np.unique(x, axis=0)
    centred = fit - fit.mean(axis=0)
    cov = centred.T @ centred / len(fit)
    values, vectors = (a[..., ::-1][..., :16] for a in np.linalg.eigh(cov))
    assert model.n == len(fit) and model.sums == fit.sum(axis=0).tolist()
    assert np.allclose(model.values, values, rtol=1e-12) and model.identity_error < 1e-10
    assert np.linalg.norm(cov @ model.vectors - model.vectors * model.values, axis=0).max() < 1e-14 * np.trace(cov)
    assert len(got) == 16 * 501 and set(got.vec_id[got.vec_id >= 900]) == set()
    one = got[got.vec_id == 5].sort_values("component")
    n, s = len(fit), fit.sum(axis=0)
    assert set(one.deviation) == {int(((n * x[5] - s).astype(object) ** 2).sum())} and set(one.n) == {n}
    assert np.allclose(np.abs(one.whitened), np.abs((x[5] - s / n) @ vectors) / np.sqrt(values), atol=1e-9)
    assert np.allclose(one.explained, values / np.trace(cov), rtol=1e-10)


def test_whitening_without_variance_in_some_directions(spark):
    rng = np.random.default_rng(3)
    flat = rng.standard_normal((60, 2)) @ rng.standard_normal((2, 2))
    rows = [(i, [float(a), float(b), 1.0, 1.0]) for i, (a, b) in enumerate(flat)]
    model, got = whitened(spark, rows)
    assert len(model.values) == 2 and sorted(set(got.component)) == [1, 2] and model.identity_error < 1e-9
    for few in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        model, got = whitened(spark, few)
        assert len(got) == 0 and len(model.values) == 0
    with pytest.raises(ValueError, match="cannot be named"):
        whitening.whiten(spark.createDataFrame([(1, [1.0])], "n long, e array<double>"), "n", "e", model)


def test_jacobi_davidson_on_close_and_repeated_values():
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.standard_normal((150, 150)))
    spectrum = np.concatenate([[9, 9, 9, 8.9999], np.linspace(5, 4.9, 30), np.linspace(2, 0, 116)])
    matrix = q @ np.diag(spectrum) @ q.T
    values, vectors = whitening.jacobi_davidson(lambda b: matrix @ b, 150, 12)
    assert np.allclose(values, np.sort(spectrum)[::-1][:12], atol=1e-11)
    assert np.abs(vectors.T @ vectors - np.eye(12)).max() < 1e-12
    assert np.linalg.norm(matrix @ vectors - vectors * values, axis=0).max() < 1e-11


TURNS = "conv_id long, turn long, role string, text string, depth int, a string"


def brute_trie(rows, openings=None):
    said = {}
    for c, t, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            said.setdefault(c, []).append((t is not None, t or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in said.items()}
    built = own
    if openings:
        built = {}
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % 6
            built[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def below(p):
        leaves, saved = 0, (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        for q in children.get(p, []):
            more = below(q)
            leaves, saved = leaves + more[0], saved + more[1]
        return max(leaves, 1), saved

    out = []
    for p, cs in members.items():
        leaves, saved = below(p)
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(p))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(children.get(p, [])), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows, openings=None):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS).repartition(4)
    return sorted(map(tuple, prefix_trie.prefix_trie(df, "conv_id", "turn", "role", "text", openings).collect()), key=str)


def opening(conv):
    return queries.F.crc32(conv.cast("string").cast("binary")) % 6


@pytest.mark.parametrize("rebuilt", [False, True])
def test_trie_equals_brute_force(spark, rebuilt):
    rng = random.Random(7)
    rows = []
    for c in itertools.chain(range(-30, 260), [10_007]):
        for t in range(rng.randrange(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "Ünï"]) if rng.random() < .9 else f"own {rng.random()}"))
    rows += [(5, None, None, None), (5, None, None, None), (5, 3, "user", ""), (None, 1, "user", "lost"), (9, 2, None, "x"), (9, 2, "y", None)]
    rows += [(c, t, "user", f"turn {t}") for c in (7000, 7101, 7202) for t in range(60)]  # deep, shared to the end
    assert trie(spark, rows, (100, opening, 5) if rebuilt else None) == brute_trie(rows, rebuilt)


def test_trie_with_blocks_and_a_crowded_sketch(spark, monkeypatch):
    """Small blocks and a sketch of few cells: conversations span blocks and most prefixes look shared."""
    monkeypatch.setattr(prefix_trie, "BLOCK", 5)
    monkeypatch.setattr(prefix_trie, "MOST_BITS", 6)
    monkeypatch.setattr(prefix_trie, "PART_BITS", 4)
    monkeypatch.setattr(prefix_trie, "IDS", 3)
    monkeypatch.setattr(prefix_trie, "LOT", 50)
    rows = [(c, t, "user", f"{t if t < 20 else (t, c % 3)}") for c in range(12) for t in range(37)]
    rows += [(100 + c, 0, "user", "same") for c in range(40)] + [(1, 1000 + t, "user", "long") for t in range(300)]
    assert trie(spark, rows) == brute_trie(rows)
    assert trie(spark, rows, (100, opening, 5)) == brute_trie(rows, True)


def test_trie_where_some_single_prefixes_look_shared(spark, monkeypatch):
    """A sketch with about as many cells as prefixes: tails are broken by prefixes that are grouped after all."""
    monkeypatch.setattr(prefix_trie, "MOST_BITS", 11)
    monkeypatch.setattr(prefix_trie, "PART_BITS", 6)
    rng = random.Random(9)
    rows = [(c, t, "user", f"{c} {t}" if t > 1 else rng.choice("ab")) for c in range(300) for t in range(rng.randrange(1, 12))]
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "user", "x")]) == []
    # crc32 of these ids takes more turns than there are, and no conversation opens their hundred
    ids = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 1]
    rows = [(c, 1, "user", "x") for c in ids]
    assert trie(spark, rows, (100, opening, 5)) == brute_trie(rows, True)
    assert len(trie(spark, rows, (100, opening, 5))) == 1


def test_op12_covers_all_rows(spark):
    embeddings = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = queries.op12_jacobi_davidson(spark, "/root/testdata/sf0.001").toPandas()
    assert len(got) == 16 * embeddings.count() and got.identity_error.max() < 1e-9


def test_tasks_let_go_of_what_a_worker_keeps_for_others():
    from sparkinfer.llm import common, components

    built = []
    for _ in range(2):
        common.per_worker("kept for a test", lambda: built.append(1) or [0])
    assert len(built) == 1
    assert list(components._forest(iter([]))) == []
    common.per_worker("kept for a test", lambda: built.append(1) or [0])
    assert len(built) == 2
    common.let_go()
