"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, operator by operator."""

import hashlib
import random
import re
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeloom.llm import (
    components, decontaminate, mixing, ngram_join, quality, range_coder, sharding, suffix_dedup, token_counts, token_files,
    url_filters, warc,
)
from lakeloom.session import scratch

from test_whole_tables import repeated

LONG = "thanedble onre was " * 20_000
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (None, "no id at all"), (5, LONG), (5, LONG), (6, "a\x00b \x85 é 中文 😀"), (7, "one two"), (7, "other text")]


# 1 token counts

def test_prefix_counts(byte_tokenizer):
    library, own = Tokenizer.from_file(byte_tokenizer), token_counts.Counter(byte_tokenizer)
    rng = random.Random(1)
    parts = ["a", "the", " ", "  ", "\n", "\t", "'", "'s", "'re", "'l", "'ll", "e", "!", "...", "12", "é", "中", "　", "\x85", "\x1c",
             "<|endoftext|>", "<|end", "|>", "😀", "İ", "=" * 70, "ing", " 's", "\r\n", "​"]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        counts = np.cumsum(np.frombuffer(own.changes(text), "<i2").astype(int)).tolist()
        assert counts == [len(library.encode(text[:i + 1], add_special_tokens=False).ids) for i in range(len(text))], text


def test_token_counts_edges(spark, docs, byte_tokenizer, monkeypatch):
    found = token_counts.prefix_counts(docs(ODD), byte_tokenizer, limit=1000)
    rows = found.collect()
    library = Tokenizer.from_file(byte_tokenizer)
    size = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in rows) == sorted(
        (i or -1, len((t or "").encode()), size(t or "")) for i, t in ODD)
    long = next(r for r in rows if r.doc_id == 5)
    assert size(LONG[:long.limit_chars]) <= 1000 < size(LONG[:long.limit_chars + 1])
    at = found.filter("doc_id = 5").select(token_counts.count_at(F.col("changes"), F.lit(777)).alias("n")).first().n
    assert at == size(LONG[:777])
    assert token_counts.prefix_counts(docs(ODD).limit(0), byte_tokenizer).count() == 0


def test_memo_forgets(byte_tokenizer):
    own = token_counts.Counter(byte_tokenizer)
    own.units.most = own.pieces.most = own.adjacent.most = 5
    text = "many different words stand here, and they do not fit the memo"
    assert own.changes(text) == token_counts.Counter(byte_tokenizer).changes(text)


# 2 URL filters

def test_url_keys(spark):
    def run(url):
        return [tuple(x)[:2] for x in spark.range(1).select(url_filters.keys(F.lit(url)).alias("k")).first().k or []]
    assert run("HTTP://u@WWW.a.Org:80/p/q.html?x#y") == [
        ("domain", "org"), ("domain", "a.org"), ("domain", "www.a.org"), ("prefix", "www.a.org/p/"), ("url", "www.a.org/p/q.html")]
    assert run("a.org") == [("domain", "org"), ("domain", "a.org"), ("url", "a.org/")]
    assert run("") == [] and run("http://") == []


def test_url_filters(spark):
    day = lambda m, d: date(2024, m, d)
    entries = spark.createDataFrame([
        ("l", "block", "domain", "a.org", day(1, 1), True), ("l", "block", "domain", "a.org", day(3, 1), False),
        ("l", "block", "domain", "a.org", day(3, 1), True), ("l", "block", "domain", "a.org", day(6, 1), True),
        ("m", "allow", "prefix", "a.org/ok/", date(2023, 5, 1), True), ("m", "block", "prefix", "a.org/ok/bad/", day(2, 1), True),
        ("n", "allow", "domain", "b.org", day(1, 1), True), ("k", "block", "domain", "b.org", day(1, 1), True),
        (None, "block", "domain", None, day(1, 1), True), ("l", "block", "domain", "c.org", None, True),
    ], "list string, action string, scope string, key string, day date, present boolean")
    spans = [(r.key, r.since, r.until) for r in url_filters.validity(entries).collect()]
    assert ("a.org", day(1, 1), day(3, 1)) in spans and ("a.org", day(6, 1), None) in spans and len(spans) == 6
    rows = [(1, "http://x.a.org/", day(2, 1)), (2, "http://a.org/ok/1", day(2, 1)), (3, "http://a.org/ok/bad/1", day(2, 1)),
            (4, "http://a.org/ok/bad/1", day(1, 31)), (5, "http://a.org/", day(3, 1)), (6, "http://a.org/", date(2025, 9, 9)),
            (7, "https://b.org", day(1, 1)), (8, None, day(1, 1)), (9, "http://a.org/", None), (10, "http://za.org/", day(2, 1)),
            (1, "http://x.a.org/", day(2, 1))]
    captures = spark.createDataFrame(rows, "n int, url string, fetched date").withColumn("key", F.lit("clash")).withColumn("year", F.lit(1))
    judged = url_filters.judge(captures, entries)
    got = sorted((r.n, r.url_allowed, r.url_list) for r in judged.collect())
    assert got == [(1, False, "l"), (1, False, "l"), (2, True, "m"), (3, False, "m"), (4, True, "m"), (5, True, None), (6, False, "l"),
                   (7, False, "k"), (8, True, None), (9, True, None), (10, True, None)]
    assert judged.columns[:5] == captures.columns
    assert url_filters.judge(captures.limit(0), entries).count() == 0
    assert url_filters.judge(captures, entries.limit(0)).filter("url_allowed").count() == len(rows)


# 3 n-gram Jaccard join

def _components(texts, percent=75):
    sets = []
    for t in texts:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\n", " ").split(" ")
        words = [w for w in words if w]
        sets.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    low = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= percent * len(a | b):
                    low[i] = low[j] = min(low[i], low[j])
    return [len(s) for s in sets], low


@pytest.mark.parametrize("seed", range(3))
def test_ngram_join_random(spark, docs, seed):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(60)]
    texts = []
    common = [rng.choice(words) for _ in range(30)]
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if rng.random() < 0.3:
                copy += common
            texts.append(" ".join(copy[:rng.randint(len(copy) // 2, len(copy))] if rng.random() < 0.3 else copy))
    sizes, low = _components(texts)
    got = sorted(map(tuple, ngram_join.join(docs(list(enumerate(texts)))).collect()))
    assert got == [(i, sizes[i], low[i]) for i in range(len(texts))]


def test_ngram_join_edges(spark, docs):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(docs(ODD)).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (None, 1, None), (5, 3, 5), (5, 3, 5), (6, 1, 6), (7, 1, 4), (7, 1, 7)], key=str)
    assert ngram_join.join(docs([(1, "a")]).limit(0)).count() == 0
    kept = ngram_join.keep_first(docs(ODD))
    assert kept.columns == docs(ODD).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "5", "5", "6", "7", "7", "None"]


def test_every_link_is_counted(spark, docs):
    """A chain of near copies: the join needs some links only, the counts and pairs hold all, also across blocks."""
    rng = random.Random(4)
    words = ["v%d" % i for i in range(90)]
    rows = []
    for g in range(3):
        base = [rng.choice(words) for _ in range(80)]
        for k in range(7):
            rows.append((100 * g + k, " ".join(base[k:] + ["x%d" % k])))
        rows.append((100 * g + 50, rows[-1][1]))
    rows += [(900, None), (901, " "), (902, "alone here")]
    sets = {i: {tuple(w[j:j + 5]) for j in range(max(len(w) - 4, 1))} for i, t in rows if (w := (t or "").split())}
    link = lambda x, y: 100 * len(x & y) >= 75 * len(x | y)
    want = {i: sum(j != i and link(sets[i], sets[j]) for j in sets) if i in sets else 0 for i, _ in rows}
    low = _components([t for _, t in rows])[1]
    got = {r.doc_id: r for r in ngram_join.join_counts(docs(rows), block=150).collect()}
    assert {i: r.n_links for i, r in got.items()} == want
    assert [got[i].component_id for i, _ in rows] == [rows[k][0] for k in low]
    members, edges = ngram_join.pairs(docs(rows))
    name = {r.doc_id: r.node for r in members.collect()}
    found = [tuple(r) for r in edges.collect()]
    assert len(found) == len(set(found)) and set(found) == {
        tuple(sorted((name[i], name[j]))) for i in sets for j in sets if name[i] != name[j] and link(sets[i], sets[j])}


def test_keep_first_without_ids(spark, docs):
    """Rows without id go with the component they are in, whatever other rows without id do."""
    rows = [(None, None), (None, "has an id elsewhere"), (3, "has an id elsewhere"), (None, "no id"), (None, "no  id"), (None, "no  id"),
            (8, "left alone"), (9, "left  alone")]
    got = [(r.doc_id, r.text) for r in ngram_join.keep_first(docs(rows)).collect()]
    first = min(("no id", "no  id"), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    assert sorted(got, key=str) == sorted([(None, None), (3, "has an id elsewhere"), (8, "left alone")]
                                          + [x for x in rows if x == (None, first)], key=str)


def test_copies_do_not_gather(spark):
    """A token's rows are not put into one task; copies of a set count once, tokens of one set go."""
    front = spark.createDataFrame([(1, 10, 5, 1)] * 500 + [(1, 11, 6, 2), (2, 10, 5, 1), (2, 10, 5, 1), (3, 12, 4, 1)],
                                  "token long, node long, n int, m int")
    found = ngram_join._shared(front)
    assert "Window" not in found._jdf.queryExecution().toString()
    assert sorted(map(tuple, found.collect())) == [(1, 10, 5, 1), (1, 11, 6, 2)]


def test_unlinked_texts_meet_once(spark, docs, monkeypatch):
    """Two texts that share much and do not link enter the last join with a row each, not with one for every token they share."""
    rng = random.Random(6)
    common = ["c%d" % i for i in range(450)]
    texts = [" ".join(common + ["%s%d" % (x, rng.randrange(10**6)) for _ in range(90)]) for x in "ab"]
    held, cut = [], ngram_join.cut

    def kept(df):
        held.append(cut(df))
        return held[-1]

    monkeypatch.setattr(ngram_join, "cut", kept)
    got = ngram_join.join(docs(list(enumerate(texts)))).collect()
    assert sorted(r.component_id for r in got) == [0, 1]
    last = [df for df in held if ngram_join.BITS[0] in df.columns and "label" in df.columns]
    assert [df.count() for df in last] == [2]


def test_prefix_keeps_links():
    """Whatever two linked sets ask for, their prefixes share."""
    rng = np.random.default_rng(5)
    cells = rng.integers(0, 900, 1 << ngram_join.CELL_BITS)
    for _ in range(200):
        n = int(rng.integers(1, 200))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.93], rng.integers(0, 1 << 63, int(rng.integers(0, 20)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both < 75 * (len(a) + len(b) - both):
            continue
        (p, m), (q, k) = (ngram_join.prefix(x, cells, float(cells.mean())) for x in (a, b))
        shared = len(np.intersect1d(p, q))
        over = -(-75 * (len(a) + len(b)) // 175)
        left = max(-(-len(a) * 75 // 100) - m, -(-len(b) * 75 // 100) - k)
        assert shared >= max(min(m, k), over - left)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (102, 102), (100, 101)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# 4 suffix order

@pytest.mark.parametrize("group_bytes", [12_000_000, 2000, 300])
def test_suffix_dedup_random(spark, docs, group_bytes):
    rng = random.Random(3)
    base = "".join(rng.choice("abc ") for _ in range(300))
    texts = [base] + [base[:rng.randint(0, 300)] + "".join(rng.choice("abcd") for _ in range(rng.randint(0, 80))) + base[rng.randint(0, 300):]
                      for _ in range(60)] + ["a" * 300, "a" * 39, "a" * 40, "ab" * 100, "", "é" * 60, None, base]
    found = suffix_dedup.dedup(docs(list(enumerate(texts))), width=40, anchor=8, symbol=10, group_bytes=group_bytes)
    got = [(r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in sorted(found.collect())]
    assert got == list(repeated(texts, 40))


def test_suffix_dedup_edges(spark, docs):
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed) for r in suffix_dedup.dedup(docs(ODD)).collect()), key=str)
    n = len(LONG)
    assert got == sorted([(i, len((t or "").encode()), n if t == LONG else 0) for i, t in ODD], key=str)
    assert suffix_dedup.dedup(docs(ODD).limit(0)).count() == 0


def test_runs_of_a_large_group_meet_in_several_tasks(spark, docs, monkeypatch):
    """One passage that stands some 40 000 times, in tables too large to be broadcast: no task gathers its group's runs."""
    wrote, cut = [], suffix_dedup.cut
    monkeypatch.setattr(suffix_dedup, "cut", lambda df: wrote.append(cut(df)) or wrote[-1])
    rng = random.Random(4)
    texts = ["0123456789" * 2000 + f"{i:03}" * 20 for i in range(20)] + 2 * ["".join(rng.choice("abcdefgh") for _ in range(200)) for _ in range(1000)]
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "20000"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        found = suffix_dedup.dedup(docs(list(enumerate(texts))), width=40, anchor=8, symbol=10)
        got = [(r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in sorted(found.collect())]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == list(repeated(texts, 40))
    groups = next(x for x in wrote if "mixed" in x.columns and "turn" in x.columns)
    tasks = [r["count"] for r in groups.groupBy(F.input_file_name().alias("file")).count().collect()]
    assert sum(tasks) > 50_000 and max(tasks) < 0.25 * sum(tasks)


def test_copies_of_a_text_are_dealt_out(spark, docs, monkeypatch):
    """Whatever the deals, every copy, null id and text without a span comes out once."""
    monkeypatch.setattr(suffix_dedup, "DEAL_BYTES", 1000)
    monkeypatch.setattr(suffix_dedup, "DEAL_ROWS", 3)
    rng = random.Random(8)
    base = ["".join(rng.choice("abcd ") for _ in range(n)) for n in (300, 90, 41, 39)]
    texts = [(None if i % 7 == 0 else i // 2, base[i % 4] if i % 5 else base[i % 4][:60] + str(i)) for i in range(200)] + [(1, None), (None, None), (2, "")]
    found = suffix_dedup.dedup(docs(texts), width=40, anchor=8, symbol=10)
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in found.collect()), key=str)
    assert got == sorted(((i, *r) for (i, _), r in zip(texts, repeated([t for _, t in texts], 40))), key=str)


def test_long_texts_are_scanned_in_parts(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SCAN_BYTES", 50)
    data = np.random.default_rng(2).integers(0, 3, 2000).astype(np.uint8)
    whole = {(g, a + k): 0 for g, a, z, _ in suffix_dedup.anchored(data, 40, 8) for k in range(z - a + 1)}
    parts = {(g, low + a + k): 0 for low in range(0, len(data) - 39, 50)
             for g, a, z, _ in suffix_dedup.anchored(data[low:low + 89], 40, 8) for k in range(z - a + 1)}
    assert whole == parts


# 5 mixing

def test_mixing_edges(spark, docs):
    even = dict(domain=F.lit("d"), seed=3)
    got = mixing.mix(docs(ODD), F.lit(1.0), **even).collect()
    assert sum(r["take"] for r in got) == sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in ODD)
    assert mixing.mix(docs(ODD).limit(0), F.lit(1.0), **even).count() == 0
    assert mixing.mix(docs(ODD), F.lit(0.0), **even).count() == 0
    rows = mixing.apply(docs(ODD), F.lit(1.0), total=1e9, max_epochs=2, **even)
    assert rows.columns == docs(ODD).columns and rows.filter("doc_id = 4").count() == 2
    none = docs([(1, "a b c", None), (2, "d e", None), (3, "f g h i", "s")])
    got = mixing.mix(none, F.lit(1.0), total=8.0, max_epochs=2, **even).groupBy("source").agg(F.sum("take")).collect()
    assert {tuple(r) for r in got} == {(None, 4), ("s", 4)}


def test_siblings_make_up_before_ancestors(spark):
    leaves = spark.createDataFrame([("a", "x", "1", 10, 1.0), ("a", "x", "2", 1000, 1.0), ("a", "y", "3", 1000, 2.0), ("b", "x", "4", 1000, 4.0)],
                                   "domain string, lang string, source string, tokens long, weight double")
    got = {r.source: r.budget for r in mixing.budgets(leaves, 800.0, 1).collect()}
    assert got == {"1": 10, "2": 190, "3": 200, "4": 400}
    assert {r.source: r.budget for r in mixing.budgets(leaves, 9000.0, 1).collect()} == {"1": 10, "2": 1000, "3": 1000, "4": 1000}


# 6 quality rules

def test_quality_edges(spark, docs):
    got = {(r.doc_id, r.n_words): r for r in quality.judge(docs(ODD)).collect()}
    assert got[1, 0].kept is False and got[None, 4].word_chars == 9 and got[3, 0].n_dup_lines == 0
    long = got[5, 60_000]
    assert long.n_repeat_words == 60_000 and long.base_failed and not long.kept
    assert quality.judge(docs(ODD)).count() == len(ODD) and quality.judge(docs(ODD).limit(0)).count() == 0
    few = quality.judge(docs([(1, "a b a b a"), (2, "x y z x y z"), (3, "l\nl\n\nl"), (4, "p q")])).collect()
    assert {r.doc_id: (r.n_repeat_words, r.n_dup_lines) for r in few} == {1: (5, 0), 2: (6, 0), 3: (0, 2), 4: (0, 0)}


def test_frequent_lines(spark, docs):
    rng = random.Random(1)
    body = lambda: "\n".join(" ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 9) for _ in range(12)) for _ in range(6))
    menu = "Menu 7 items\nmenu  8 ITEMS"
    rows = [(i, menu + "\n" + body(), "h") for i in range(12)] + [(50, "\n".join([menu] * 30) + "\n" + " ".join(body().split()[:20]), "h")]
    rows += [(100 + i, menu + "\n" + body(), "other%d" % i) for i in range(5)] + [(200 + i, rows[0][1], None) for i in range(12)]
    limits = dict(line_docs=5, repeat_percent=100)
    got = {r.doc_id: r for r in quality.judge(docs(rows), **limits).collect()}
    assert all(got[i].kept and got[i].left_words == 72 for i in range(12)) and not got[50].kept
    assert all(got[i].left_words == got[i].n_words for i in [*range(100, 105), *range(200, 212)])
    texts = {r.doc_id: r.text for r in quality.clean(docs(rows), **limits).collect()}
    assert 50 not in texts and "enu" not in texts[3] and texts[100] == rows[13][1] and len(texts) == len(rows) - 1
    # a host's further documents do not change what is cut from the first ones
    more = rows + [(1000 + i, body(), "h") for i in range(200)]
    large = {r.doc_id: r for r in quality.judge(docs(more), **limits).collect()}
    assert all(large[i].left_words == got[i].left_words and large[i].kept == got[i].kept for i in got)


# 7 sharding

def test_sharding_edges(spark, docs):
    got = sharding.shard(docs(ODD), [1.0] * 4, [1.0] * 5, slot_buckets=4).collect()
    assert len(got) == len(ODD) and len({r.shard for r in got if r.doc_id == 5}) == 1
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert all(r.grown_shard in (r.shard, 4) for r in got)
    assert next(r for r in got if r.doc_id == 1)["size"] == 1
    assert sharding.shard(docs(ODD).limit(0), [1.0] * 4).count() == 0


def test_weighted_shards(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    counts = {r.shard: r["count"] for r in sharding.shard(rows, [1.0, 3.0, 0.0]).groupBy("shard").count().collect()}
    assert set(counts) == {0, 1} and abs(counts[1] / 20_000 - 0.75) < 0.02
    with pytest.raises(ValueError):
        sharding.rendezvous(F.lit(1), [0.0])


# 8 token files

def test_range_coder():
    rng = np.random.default_rng(1)
    blocks = [rng.integers(0, 50 if i % 2 else 65_536, rng.integers(0, 300)).astype("<u2") for i in range(60)]
    blocks += [np.zeros(0, "<u2"), np.zeros(2048, "<u2"), np.tile(np.arange(7, dtype="<u2"), 290), np.full(5, 65_535, "<u2")]
    coded = range_coder.encode(blocks)
    found = range_coder.decode(range_coder.split(b"".join(coded)))
    assert all(np.array_equal(a, b) for a, b in zip(blocks, found))
    alone = range_coder.decode(range_coder.split(coded[7]))  # a block needs no other
    assert np.array_equal(alone[0], blocks[7]) and len(coded[-3]) < 100
    damaged = bytearray(coded[-2])
    damaged[-1] ^= 1
    with pytest.raises(ValueError):
        range_coder.split(bytes(damaged))


def test_words_stand_alone(word_tokenizer):
    library, own = Tokenizer.from_file(word_tokenizer), token_files.Encoder(word_tokenizer)
    rng = random.Random(4)
    parts = ["a", "É", "İ", "Σ", "ς", " ", "\n", "\x85", "\xa0", "\x1c", "　", "<|endoftext|>", "'s", "don't", "́", "12", "²", "!", "\t"]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(own.ids([text])[0], "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_latin_texts_are_cut_here(word_tokenizer):
    """Texts of ASCII and Latin-1 letters need the library for merging only; others still give its ids."""
    library, own = Tokenizer.from_file(word_tokenizer), token_files.Encoder(word_tokenizer)
    ids = lambda t: library.encode(t, add_special_tokens=False).ids
    rng = random.Random(8)
    parts = ["Ñandú", "ÜBER", "straße", "çà,", "été", "ÿ÷×", "it'S", "we'll", "!'re", "12", " ", "\n", "\t", "..", "a"]
    plain = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(300)]
    plain = [t for t in plain if not set(t) & set("÷×")] + ["Ñandú's ÜBER straße"]
    others = [t + x for t, x in zip(plain, ["e\u0301", "÷", "\xa0", "İ", "<|endoftext|>", "\x0b", "中"] * 50)]
    want = [ids(t) for t in plain + others]
    assert [np.frombuffer(x, "<u2").tolist() for x in own.ids(plain + others)] == want
    bare = token_files.Encoder(word_tokenizer)
    bare.tokenizer = None
    assert [np.frombuffer(x, "<u2").tolist() for x in bare.ids(plain)] == want[:len(plain)]


def test_new_pieces_are_merged_in_one_call(word_tokenizer, monkeypatch):
    """Plain texts need one call of the library for all their pieces, texts that stand side by side apart."""
    monkeypatch.setattr(token_files, "MEMO", 20)
    library, own = Tokenizer.from_file(word_tokenizer), token_files.Encoder(word_tokenizer)
    texts = ["don'", "t it's", "", "we'LL'RE '", "re ''s 5's'st", "\n", "ÇÀ ßÿ\tà\xed", "'", "ll", "[a]{Z}@~"]
    rng = random.Random(9)
    texts += ["".join(rng.choice("aeST'l  é9!") for _ in range(rng.randint(0, 30))) for _ in range(200)]
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    own.tokenizer = own.merge = None
    for size in (len(texts), 7, 1):  # remembered, forgotten and merged anew
        found = [x for i in range(0, len(texts), size) for x in own.ids(texts[i:i + size])]
        assert [np.frombuffer(x, "<u2").tolist() for x in found] == want
    bare = token_files.Encoder(word_tokenizer)
    bare.last[:] = False  # as for a tokenizer whose tokens do not show where a piece ends
    assert bare.ids(texts) == found


def test_token_files_edges(spark, docs, word_tokenizer, monkeypatch):
    path = scratch(spark, "tokens")
    token_files.write(docs(ODD), path, word_tokenizer, end_id=2)
    library = Tokenizer.from_file(word_tokenizer)
    rows = token_files.read(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 5, 6, 7, 7]
    ids = lambda t: library.encode(t or "", add_special_tokens=False).ids + [2]
    assert sorted((str(r.doc_id), r.ids) for r in rows) == sorted((str(i), ids(t)) for i, t in ODD)
    assert [r.start for r in rows] == np.cumsum([0] + [r.n_tokens for r in rows])[:-1].tolist()
    empty = scratch(spark, "tokens")
    token_files.write(docs(ODD).limit(0), empty, word_tokenizer, end_id=2)
    assert token_files.read(spark, empty).count() == 0


# 9 decontamination

def test_wand_finds_all():
    rng = np.random.default_rng(7)
    terms, pieces, impacts = [], [], []
    for item in range(40):
        own = rng.choice(120, 15, replace=False)
        share = rng.random(15)
        terms += own.tolist()
        pieces += [item] * 15
        impacts += (share / share.sum()).tolist()
    index = decontaminate.Index(np.array(terms, np.uint64), np.array(pieces), np.array(impacts), list(range(40)), [""] * 40)
    for _ in range(60):
        rows = np.sort(rng.choice(len(index.terms), 50, replace=False))
        score = np.zeros(40)
        for t, p, x in zip(terms, pieces, impacts):
            score[p] += x * (index.terms[rows] == t).any()
        blocks = [b for _, b in index.promising(np.zeros(len(rows), dtype=np.int64), rows, 0.5)]
        found = index.search(rows.tolist(), blocks, 0.5) if blocks else {}
        assert set(found) == set(np.flatnonzero(score >= 0.5 - 1e-9)) and all(abs(found[k] - score[k]) < 1e-9 for k in found)


def test_decontamination_edges(spark, docs):
    question = "Which of the four old rivers near Alder runs through seven towns before it meets the sea? It is the slow brown Merrow."
    items = spark.createDataFrame([(1, question), (2, None), (3, ""), (4, "Short one. Yes."), (1, question)], "item_id long, text string")
    noise = " ".join("word%d" % i for i in range(400))
    rows = [*ODD, (10, noise + " " + question.upper() + " " + noise), (11, question), (12, question.split("?")[0]), (13, noise),
            (14, " ".join(sorted(question.split()))), (None, question), (11, question)]
    got = decontaminate.matches(docs(rows), items)
    assert {(r.doc_id, r.item_id) for r in got.filter("leaked").collect()} == {(10, 1), (11, 1), (None, 1)}
    cleaned = decontaminate.clean(docs(rows), items)
    assert cleaned.columns == docs(rows).columns and cleaned.count() == len(rows) - 4
    assert decontaminate.matches(docs(rows).limit(0), items).count() == 0
    assert decontaminate.matches(docs(rows), items.limit(0)).count() == 0
    parts = decontaminate.matches(docs(rows), items, part_words=3).filter("leaked")
    assert {(r.doc_id, r.item_id) for r in parts.collect()} == {(10, 1), (11, 1), (None, 1)}


# 10 WARC

def test_warc_magic_and_splits(spark):
    inner = warc.MAGIC + "WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" + warc.MAGIC + "Content-Length: 9999999\r\n\r\n"
    body = "<p>" + "é中" * 60 + "</p>"
    rows = [(i, "http://a.org/%d\r\nX: y" % i, h) for i, h in enumerate([
        body, body, "", None, inner, "x" + inner + "y" * 200, "x" + inner + "y" * 200, warc.MAGIC, "\r\n\r\n", "q" * 99, "q" * 99, body] + ["z%d" % i * 40 for i in range(60)])]
    pages = spark.createDataFrame([*rows, (None, None, body), (0, "again", body)], "page_id long, url string, html string").coalesce(2)
    path = scratch(spark, "warc")
    warc.write(pages.withColumn("digest", F.lit("clash")), path)
    for split in ("128m", "300b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            found = warc.read(spark, path).collect()
            got = warc.pages_of(warc.read(spark, path)).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert len(found) == len(rows) + 2
        assert sorted(r.payload for r in found if r.record_type == "response" and r.record_id == "<urn:page:5>") == [rows[5][2]]
        assert all(r.verified for r in got) and len(got) == len(rows) + 2
        want = {}
        for i, _, h in rows:
            same = [j for j, _, g in rows if (g or "") == (h or "")]
            again = len((h or "").encode()) >= 100 and min(same) < i
            want[i] = (len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(), "revisit" if again else "response", min(same) if again else None)
        assert {r.page_id: tuple(r)[1:5] for r in got if r.page_id} == {k: v for k, v in want.items() if k}
    assert sorted(r.record_type for r in got if not r.page_id) == ["response"] * 3
    empty = scratch(spark, "warc")
    warc.write(pages.limit(0), empty)
    assert warc.read(spark, empty).count() == 0


def test_mix_reads_whole_documents_as_often_as_it_takes_them(spark, docs):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), f"s{i % 3}") for i in range(60)] + [(5, "twice the same text", "s0")] * 4 + [(None, "no id", "s1"), (9, " ", "s1"), (8, None, "s2")]
    for total in (1.0, 150.0, 1e6):
        how = {"domain": F.lit("d"), "total": total, "max_epochs": 3}
        weight = F.when(F.col("source") == "s1", 3.0).otherwise(1.0)
        taken = mixing.mix(docs(rows), weight, **how)
        assert taken.agg(F.sum("take")).first()[0] == min(total, 3 * sum(len(x[1].split()) for x in rows if x[1]))
        want = sorted((str(r.doc_id), r.tokens) for r in taken.collect())
        for ranges in (2, 4096) if total == 150 else (4096,):
            made = mixing.apply(docs(rows), weight, ranges=ranges, **how)
            assert made.columns == docs(rows).columns
            assert sorted((str(r.doc_id), len(r.text.split())) for r in made.collect()) == want


def test_items_of_any_number(spark, docs):
    body = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    items = spark.createDataFrame([(k, body(k)) for k in (1 << 43, (1 << 63) - 1, -(1 << 63), -1, 0, 1 << 44)], "item_id long, text string")
    found = decontaminate.matches(docs([(1, body(1 << 43)), (2, "x " + body(-1) + " y"), (3, body((1 << 63) - 1) + " " + body(1 << 44)), (4, body(7))]), items).filter("leaked").collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 1 << 43), (2, -1), (3, (1 << 63) - 1), (3, 1 << 44)}


def test_archives_of_both_versions(spark, tmp_path):
    record = lambda v, id, body: f"WARC/1.{v}\r\nWARC-Type: response\r\nWARC-Record-ID: {id}\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r\n"
    inner = record(0, "<urn:page:99>", "never")
    (tmp_path / "a.warc").write_bytes((record(1, "<urn:page:1>", "one") + record(0, "<urn:page:2>", f"WARC/1.2\r\n{inner}") + record(1, "<urn:page:3>", "")).encode())
    got = {r.record_id: r.payload for r in warc.read(spark, str(tmp_path)).collect()}
    assert got == {"<urn:page:1>": "one", "<urn:page:2>": f"WARC/1.2\r\n{inner}", "<urn:page:3>": ""}
