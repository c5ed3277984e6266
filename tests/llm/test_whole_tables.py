"""Every query with SQL agrees with it; the rest is held against brute force over the small tables."""

import collections
import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__
from lakeloom.llm import queries
from workloads.verify import compare, oracle

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.fixture(scope="module")
def texts():
    return duckdb.sql(f"SELECT doc_id, text FROM read_parquet('{SF}/documents.parquet') ORDER BY doc_id").fetchall()


def test_registered():
    named = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in queries.QUERIES}
    assert "pipeline" in named and set(queries.QUERIES) <= set(named)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, con, name):
    assert not compare(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name])[0]


@pytest.mark.parametrize("name", ["op2_url_filters", "op6_quality"])
def test_native(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoop") if x in plan]


def test_token_counts(spark, texts, byte_tokenizer):
    library = Tokenizer.from_file(byte_tokenizer)
    want = {i: (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in texts}
    got = queries.QUERIES["op1_token_counts"](spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)


def test_suffix_dedup(spark, texts):
    want = {i: r for (i, _), r in zip(texts, repeated([t for _, t in texts], 400))}
    got = queries.QUERIES["op4_suffix_dedup"](spark, SF).collect()
    assert {r.doc_id: tuple(r)[1:5] for r in got} == want
    whole = dict(texts)
    assert all(r.text == (whole[r.doc_id] or "") for r in got if not r.n_removed)
    assert all(len(r.text) < len(whole[r.doc_id]) for r in got if r.n_removed)


def test_suffix_dedup_tells_what_is_left(spark, texts):
    """n_bytes is the input's size; n_kept and text tell what a repeated passage leaves."""
    want = {i: n - gone for (i, _), (n, gone, _, _) in zip(texts, repeated([t for _, t in texts], 400))}
    got = queries.QUERIES["op4_suffix_dedup"](spark, SF).collect()
    assert {r.doc_id: r.n_kept for r in got} == want
    assert any(r.n_kept < r.n_bytes for r in got) and any(r.n_kept == r.n_bytes for r in got)


def repeated(texts, width):
    """Brute force: count every string of that many bytes, cover those that occur twice."""
    bodies = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i:i + width] for b in bodies for i in range(len(b) - width + 1))
    for b in bodies:
        covered = np.zeros(len(b) + 1, dtype=bool)
        for i in range(len(b) - width + 1):
            if seen[b[i:i + width]] > 1:
                covered[i:i + width] = True
        kept = bytes(x for x, c in zip(b, covered) if not c)
        runs = int((np.diff(np.concatenate([[False], covered]).astype(int)) == 1).sum())
        yield len(b), int(covered.sum()), runs, hashlib.sha256(kept).hexdigest()


def test_sharding(spark, texts):
    import xxhash

    def score(key, shard):
        h = xxhash.xxh64_intdigest((key % (1 << 64)).to_bytes(8, "little"), 42)
        return xxhash.xxh64_intdigest(shard.to_bytes(4, "little"), h) >> 11

    def key(i):
        h = xxhash.xxh64_intdigest(i.to_bytes(8, "little"), 42)
        return xxhash.xxh64_intdigest(b"key", h)

    got = queries.QUERIES["op7_sharding"](spark, SF).collect()
    text = dict(texts)
    for r in got:
        scores = [score(key(r.doc_id), s) for s in range(9)]
        assert r.shard == max(range(8), key=scores.__getitem__)
        assert r.grown_shard == max(range(9), key=scores.__getitem__)
        assert (r.size, r.text_crc32) == (len((text[r.doc_id] or "").encode()) + 1, zlib.crc32((text[r.doc_id] or "").encode()))
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))


def test_token_files(spark, texts, word_tokenizer):
    library = Tokenizer.from_file(word_tokenizer)
    want, start = [], 0
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.QUERIES["op8_token_files"](spark, SF).collect())) == want


def test_decontamination(spark, con, texts):
    got = queries.QUERIES["op9_decontamination"](spark, SF).collect()
    want = con.execute("SELECT doc_id, item_id FROM documents d, benchmark b WHERE contains(d.text, b.text)").fetchall()
    assert {(r.doc_id, r.item_id) for r in got} >= set(want)
    items = dict(con.execute("SELECT item_id, text FROM benchmark").fetchall())
    text = dict(texts)
    for r in got:  # nothing but true overlap
        words = [x.strip(".,").lower() for x in items[r.item_id].split()]
        own = {x.strip(".,").lower() for x in text[r.doc_id].split()}
        assert np.mean([w in own for w in words]) >= 0.75


def test_mixing(spark, con):
    got = queries.QUERIES["op5_mixing"](spark, SF).toPandas()
    tokens = got.drop_duplicates("doc_id").set_index("doc_id")["tokens"]
    rows = con.execute("""SELECT doc_id, CASE WHEN CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) % 2 = 0 THEN 'even' ELSE 'odd' END AS domain,
        lang, source, len(list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS n FROM documents""").df()
    assert (tokens == rows.set_index("doc_id")["n"].loc[tokens.index]).all()
    room = rows.groupby(["domain", "lang", "source"])["n"].sum() * 4
    taken = got.groupby(["domain", "lang", "source"])["take"].sum().reindex(room.index, fill_value=0)
    want = poured(room[room > 0], float(rows["n"].sum()))
    assert (taken.loc[want.index] - want).abs().max() <= 1
    # every epoch but a leaf's last one holds every document once, in full
    for _, leaf in got.groupby(["domain", "lang", "source"]):
        for epoch in range(leaf["epoch"].max()):
            part = leaf[leaf["epoch"] == epoch]
            assert part["doc_id"].is_unique and (part["take"] == part["tokens"]).all()
        assert (leaf["take"] < leaf["tokens"]).sum() <= 1


def poured(room, total):
    """Brute force: tokens trickle down the tree until all are placed; full leaves take no more."""
    import pandas as pd

    weight = pd.Series({k: (2.0 if k[0] == "even" else 1.0) * (0.5 if k[1] == "en" else 1.0) for k in room.index})
    weight.index = room.index

    def share(prefix, amount):
        """What each leaf below the node gets of an amount that fits the node's room."""
        depth = len(prefix)
        own = [k for k in room.index if k[:depth] == prefix]
        if depth == 3:
            return {prefix: min(amount, room[prefix])}
        kids = sorted({k[:depth + 1] for k in own})
        space = {c: sum(room[k] for k in own if k[:depth + 1] == c) for c in kids}
        weights = {c: sum(weight[k] for k in own if k[:depth + 1] == c) for c in kids}
        given, open_ = dict.fromkeys(kids, 0.0), set(kids)
        while amount > 1e-9 and open_:
            part = amount / sum(weights[c] for c in open_)
            amount = 0.0
            for c in sorted(open_):
                given[c] += part * weights[c]
                if given[c] >= space[c]:
                    amount += given[c] - space[c]
                    given[c] = space[c]
                    open_.discard(c)
        return {k: v for c in kids for k, v in share(c, given[c]).items()}

    found = pd.Series(share((), total))
    found.index = pd.MultiIndex.from_tuples(found.index)
    return found.loc[room.index]


def test_pipeline(spark, con, texts):
    import corpus_pipeline
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    step = []
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).toArrow())
        step.append(docs)
    ids = [{r.doc_id for r in x.select("doc_id").collect()} for x in step]
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.ORACLES['op6_quality']}) WHERE kept").fetchall()}
    assert ids[0] == kept
    con.execute("CREATE OR REPLACE TEMP TABLE first_stage AS SELECT * FROM documents WHERE doc_id IN (SELECT unnest(?))", [sorted(kept)])
    sql = queries.ORACLES["op3_ngram_join"].replace("FROM documents", "FROM first_stage")
    assert ids[1] == {r[0] for r in con.execute(f"SELECT DISTINCT component_id FROM ({sql})").fetchall()}
    leaked = {r[0] for r in con.execute("SELECT doc_id FROM documents d, benchmark b WHERE contains(d.text, b.text)").fetchall()}
    assert ids[2] == ids[1] - leaked
    assert ids[3] <= ids[2] and all(x.columns == step[0].columns for x in step[:4])
    assert step[4].count() == step[3].count() and ids[4] == ids[3]
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, whole.collect())) == sorted(map(str, step[4].collect()))
    assert whole.agg(F.max("shard")).first()[0] <= 7
