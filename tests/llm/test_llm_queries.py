"""Registered queries against their SQL, their contracts, and the pipeline against brute force."""

import os
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from check_oracle import connect, differences
from test_llm_operators import EDGE, brute_groups, brute_items, make, plain_ids

import corpus_pipeline
from sparkinfer.llm import oracle, queries
from sparkinfer.llm.common import scratch_path

SF = "/root/testdata/sf0.001"
SQL = oracle.build()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.REGISTRY))
def test_query_matches_sql(spark, duck, name):
    ours = queries.REGISTRY[name](spark, SF).toPandas()
    assert len(ours) > 0
    if name in SQL:
        assert not differences(ours, duck.execute(SQL[name]).fetchdf())


def coded():
    rows = sorted(pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist(), key=lambda r: r["doc_id"])
    return {r["doc_id"]: ids for r, ids in zip(rows, plain_ids([r["text"] for r in rows]), strict=True)}


def test_pieces_have_the_ids_of_their_documents(spark):
    ids, pieces = coded(), queries.op2_tier_packing(spark, SF).toPandas()
    for r in pieces.itertuples():
        whole = ids[r.doc_id] + (2).to_bytes(4, "little")
        assert r.doc_tokens == len(whole) // 4
        assert r.ids_crc32 == zlib.crc32(whole[4 * r.start:4 * (r.start + r.length)])
    assert pieces.length.sum() == sum(len(c) // 4 + 1 for c in ids.values())
    sizes = pieces.groupby("sequence_id").length.sum()
    assert ((sizes & (sizes - 1)) == 0).all() and sizes.max() <= 4096


def test_token_files_have_the_ids_in_order(spark):
    ids, got = coded(), queries.op5_token_files(spark, SF).toPandas().sort_values("doc_id")
    start = 0
    for r in got.itertuples():
        whole = ids[r.doc_id] + (1).to_bytes(4, "little")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(whole) // 4, zlib.crc32(whole))
        start += r.n_tokens
    assert len(got) == len(ids)


def test_pipeline_stages_equal_brute_force(spark):
    """Stage by stage on planted copies, near copies, passages and texts without letters."""
    rng = np.random.default_rng(5)
    vocabulary = {"en": "the of and that with from which this have were people about".split(),
                  "de": "der die und nicht eine werden durch schon haben wurde gegen immer".split()}
    rows, langs = [], {}
    for i in range(240):
        lang = "en" if i % 2 else "de"
        rows.append((i, " ".join(f"{rng.choice(vocabulary[lang])} {rng.choice(vocabulary[lang])}{rng.integers(999)}" for _ in range(80))))
        langs[i] = lang
    item = " ".join(f"benchmark item {i}" for i in range(20))
    rows[7] = (7, rows[7][1] + " " + item + " " + rows[8][1])
    rows += [(300, rows[3][1]), (301, rows[3][1]), (302, rows[4][1] + " more"), (303, rows[5][1].replace(" ", " x ", 1)), (304, "12 34 !!")]
    rows += [(400 + n, t) for n, (_, t) in enumerate(EDGE)]
    docs = make(spark, rows).drop("lang").withColumn("lang", queries.F.when(queries.F.col("doc_id") < 240, queries.F.when(
        queries.F.col("doc_id") % 2 == 1, "en").otherwise("de")))
    sf = scratch_path(spark, "test-sf")
    spark.createDataFrame([(0, item), (1, ""), (2, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs.write.parquet(f"{sf}/documents.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out, kept = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "test-stage")
        stage(spark, kept, sf).write.parquet(path)
        kept = spark.read.parquet(path)
        out[name] = [(r["doc_id"], r["text"]) for r in kept.collect()] if name != "packing" else kept.collect()
        if name != "packing":
            assert kept.columns == docs.columns
    # rejected: no letter; a language model of two languages may also refuse the Japanese text
    lettered = {(d, t) for d, t in rows if any(c.isalpha() for c in t or "")}
    assert {x for x in lettered if x[0] < 400} <= set(out["language"]) <= lettered
    last = {}
    for d, t in out["language"]:
        last[t] = max(d, last.get(t, d))
    assert sorted(out["exact"]) == sorted((d, t) for t, d in last.items())
    groups = brute_groups(out["exact"], 5)
    assert sorted(d for d, _ in out["near"]) == sorted({c for _, _, c in groups})
    found = {d for d, _ in brute_items(out["near"], [(0, item)])}
    assert found == {7}
    assert sorted(out["benchmark"]) == sorted(x for x in out["near"] if x[0] not in found)
    tokens = {d: len(c) // 4 + 1 for (d, _), c in zip(out["benchmark"], plain_ids([t for _, t in out["benchmark"]]), strict=True)}
    packed = {}
    for r in out["packing"]:
        packed[r["doc_id"]] = packed.get(r["doc_id"], 0) + r["length"]
    assert packed == tokens
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()} == set(tokens)


def test_pipeline_of_an_empty_table(spark):
    sf = scratch_path(spark, "test-sf")
    make(spark, []).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_entry_registers_the_queries():
    import __spark_entry__ as entry

    assert set(queries.REGISTRY) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.REGISTRY) == list(range(1, 14))
    assert os.path.exists(corpus_pipeline.__file__)
