"""Chat formatting, fill-in-middle and the Merkle manifest on edge cases and against plain Python."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import chat, fill_middle, merkle

SAID = "conv_id long, turn long, role string, text string, chunk int, p string, n_turns int"


def said(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SAID)


def formatted(messages, tmp_path, content=None, **how):
    path = str(tmp_path / "chat")
    chat.format_turns(messages, chat.text_parts(F.col("text")) if content is None else content, **how).write.parquet(path)
    return path


@pytest.mark.parametrize("chunk", [1, 1 << 20])
def test_chat_rows(spark, tmp_path, chunk):
    nasty = ["", None, "\\", "\\\\<turn>", "<says></turn>\n<image:1>", "plain", "é 𝄞<", "</turn", "x" * 30000, "\\### Assistant: </turn> ok"]
    rows = [(c, t, r, x) for c in (1, None) for t, (r, x) in enumerate([(r, x) for x in nasty for r in ("user", "assistant", None, "</turn>\\")])]
    rows += [(2, None, "assistant", "first"), (2, 1, "assistant", "same"), (2, 1, "assistant", "same"), (3, 0, "user", None)]
    random.Random(1).shuffle(rows)
    path = formatted(said(spark, rows), tmp_path, chunk=chunk)
    turns = chat.read_turns(spark, path)
    got = {}
    for r in turns.orderBy("conv_id", "chunk", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
        assert r.loss == (r.text if r.role == "assistant" else "")
    want = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    assert got == want
    for r in chat.digests(turns).collect():
        own = want[r.conv_id]
        assert r.n_turns == len(own)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in own).encode()).hexdigest()
        learned = "".join(b for a, b in own if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
        assert r.formatted_chars == sum(20 + len(chat.escape(a)) + len(chat.escape(b)) for a, b in own)
    files = spark.read.parquet(path)
    assert files.agg(F.sum("n_turns")).first()[0] == len(rows)
    # without a tokenizer a token is a byte, so counts add up to the text's bytes
    assert files.filter(F.col("n_tokens") != F.octet_length("text")).count() == 0


def test_chat_parts(spark, tmp_path):
    part = lambda kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None: (kind, text, ref, width, height, seconds, pages)
    rows = [
        (1, 0, "user", [part("text", "look <image:1> "), part("image", "[pic]", "a.png", 57, 28), None, part("image", None, "b.png"), part("text", " and")]),
        (1, 1, "assistant", [part("text", "a\\"), part("audio", "[song]", "c.wav", seconds=2.01), part("text", ""), part("text", "b"), part("text", "c")]),
        (1, 2, "user", [part("document", "[paper]", "d.pdf", pages=3), part("hologram", "[?]", "e"), part(None, "[none]")]),
        (1, 3, "user", None), (1, 4, "assistant", []),
    ]
    messages = spark.createDataFrame(rows, f"conv_id long, turn long, role string, content array<{chat.PART}>")
    path = formatted(messages, tmp_path, F.col("content"))
    row = spark.read.parquet(path).first()
    assert row.text == ("<turn>user<says>look \\<image:1> <image:1><image:2> and</turn>\n<turn>assistant<says>a\\\\<audio:1>bc</turn>\n"
                        "<turn>user<says><document:1><other:2><other:3></turn>\n<turn>user<says></turn>\n<turn>assistant<says></turn>\n")
    assert [(a.turn, a.number, a.kind, a.ref, a.tokens) for a in row.attachments] == [
        (0, 1, "image", "a.png", 3), (0, 2, "image", "b.png", 256), (1, 1, "audio", "c.wav", 51), (2, 1, "document", "d.pdf", 1536),
        (2, 2, "other", "e", 256), (2, 3, "other", None, 256)]
    holders = [row.text[a.at:].startswith(f"<{a.kind}:{a.number}>") for a in row.attachments]
    assert all(holders)
    assert [row.text[s.start:s.end] for s in row.loss] == ["a\\\\", "bc"]
    spelled = sum(len(f"<{a.kind}:{a.number}>") for a in row.attachments)
    assert row.n_tokens == len(row.text) - spelled + sum(a.tokens for a in row.attachments)
    turns = chat.read_turns(spark, path).orderBy("chunk", "turn").collect()
    assert [(t.text, t.loss, t.n_attachments) for t in turns] == [
        ("look <image:1> [pic] and", "", 2), ("a\\[song]bc", "a\\bc", 1), ("[paper][?][none]", "", 3), ("", "", 0), ("", "", 0)]


def test_chat_links(spark):
    texts = ["", None, "none", "see ![a b](x/y.PNG) and [talk](t.mp3)[cv](cv.pdf) [page](http://a.b/c)", "![](i.webp)"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", chat.linked_parts(F.col("text")).alias("p"))
    got = {r.i: [(p.kind, p.text, p.ref) for p in r.p] for r in rows.collect()}
    assert got == {0: [("text", "", None)], 1: [("text", "", None)], 2: [("text", "none", None)], 4: [("image", "![](i.webp)", "i.webp")],
                   3: [("text", "see ", None), ("image", "![a b](x/y.PNG)", "x/y.PNG"), ("text", " and ", None), ("audio", "[talk](t.mp3)", "t.mp3"),
                       ("document", "[cv](cv.pdf)", "cv.pdf"), ("text", " [page](http://a.b/c)", None)]}


def test_chat_faults():
    for text in ("<turn>a<says>b", "x<turn>a<says></turn>\n", "<turn>a</turn>\n", "<turn>a<says><turn></turn>\n", "<turn>a<says></turn>\nb"):
        with pytest.raises(ValueError):
            list(chat.turns_of(text, [], []))


def test_chat_empty(spark, tmp_path):
    path = formatted(said(spark, []), tmp_path)
    assert chat.digests(chat.read_turns(spark, path)).collect() == []


def test_chat_tokens(spark, tmp_path, byte_tokenizer):
    from tokenizers import Tokenizer

    rows = [(1, i, r, x) for i, (r, x) in enumerate([("user", "Hello <|endoftext|> there"), ("assistant", "a " * 500), ("user", "")])]
    path = formatted(said(spark, rows), tmp_path, tokenizer=byte_tokenizer)
    library = Tokenizer.from_file(byte_tokenizer)
    library.encode_special_tokens = True
    row = spark.read.parquet(path).first()
    turns = [x + "</turn>\n" for x in row.text.split("</turn>\n")[:-1]]
    assert row.n_tokens == sum(len(library.encode(x, add_special_tokens=False).ids) for x in turns)


def test_fill_middle(spark):
    rng = random.Random(2)
    texts = [None, "", "a", "é", "<P>", "x<S>y", "<M", "áb𝄞c", "\x00\n", "ab" * 40000, "𝄞" * 9000]
    texts += ["".join(rng.choice("aé𝄞<PSM> \n") for _ in range(rng.randrange(60))) for _ in range(300)]
    rows = [(i, t, "n", 1) for i, t in enumerate(texts)] + [(None, "no id", "n", 1), (7, "again", "n", 1), (7, "again", "n", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, output int")

    def one(i, t):
        t = t or ""
        h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
        a, b = sorted((h1 % (len(t) + 1), h2 % (len(t) + 1)))
        if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
            return (i, len(t), "plain", None, None, t)
        if h4 % 100 < 20:
            return (i, len(t), "spm", a, b - a, f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}")
        return (i, len(t), "psm", a, b - a, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}")

    want = sorted([one(i, t) for i, t, *_ in rows], key=str)
    for window in (16, 1 << 20):
        made = fill_middle.transform(docs, window=window)
        assert sorted(map(tuple, made.collect()), key=str) == want
    back = made.select("doc_id", fill_middle.restored(F.col("output"), F.col("form")))
    assert sorted(map(tuple, back.collect()), key=str) == sorted([(i, t or "") for i, t, *_ in rows], key=str)
    assert {x[2] for x in want} == {"plain", "psm", "spm"}
    assert fill_middle.transform(docs.limit(0)).collect() == []


def test_fill_middle_cut():
    """Every place of a cut in texts that windows part in every way, in a slice of an array."""
    texts = ["skipped", "", "aé𝄞b", "", "ü", "xyz" * 5, ""]
    array = pa.array(texts, pa.string()).slice(1)
    for window in (1, 2, 3, 5, 7, 100):
        for seed in range(8):
            places = np.random.default_rng(seed).integers(0, 20, (2, len(array)))
            sizes = [len(t) for t in texts[1:]]
            first, last = (np.minimum(x, sizes) for x in np.sort(places, axis=0))
            got = fill_middle.cut(array, pa.array(first), pa.array(last), window)
            assert list(zip(*(x.to_pylist() for x in got))) == [(t[:a], t[a:b], t[b:]) for t, a, b in zip(texts[1:], first, last)]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(digests, fanout):
    """Root of a list of digests, and each one's siblings level by level, as (before, after)."""
    groups, steps = [[i] for i in range(len(digests))], [[] for _ in digests]
    while len(digests) > 1:
        above, merged = [], []
        for at in range(0, len(digests), fanout):
            run = digests[at:at + fanout]
            for j, own in enumerate(groups[at:at + fanout]):
                for i in own:
                    steps[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            above.append(h(*run))
            merged.append([i for own in groups[at:at + fanout] for i in own])
        digests, groups = above, merged
    return digests[0], steps


@pytest.mark.parametrize("fanout,n", [(8, 1), (8, 75), (3, 28)])
def test_merkle(spark, fanout, n):
    rng = random.Random(n)
    rows = [(i, rng.choice(["é", "a", "𝄞", None]), rng.choice(["en", "en", "en", "de", None, "", "zz"]), rng.choice([None, 5]), rng.choice([None, "", "Text É", "low"]), 1, b"x")
            for i in range(n)]
    rows += [(3, "a", "fr", 1, "TIED", 2, b""), (3, "a", "fr", 1, "TIED", 2, b""), (3, "a", "fr", 1, "other", 2, b""), (None, "a", "fr", 1, "X", 2, b""), (None, None, None, None, None, 0, b"")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string, lo int, path binary")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    made = merkle.manifest(docs, fields, tampered=F.lower("text"), fanout=fanout)
    got = made.select("doc_id", "tree", "lo", "leaf", "claimed", "subroot", "root", merkle.proof_digest(F.col("path")),
                      merkle.fold(F.col("claimed"), F.col("path"))).collect()

    def leaf(r, text):
        return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (*r[:4], text)))

    langs, want = {}, []
    for r in rows:
        langs.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[4]), leaf(r, r[4] and r[4].lower()), r[0]))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: tree([r[2] for r in sorted(langs[x])], fanout) for x in order}
    root, over = tree([trees[x][0] for x in order], fanout)
    for x, top in zip(order, over):
        for at, (r, steps) in enumerate(zip(sorted(langs[x]), trees[x][1])):
            folded = r[3]
            for before, after in steps + top:
                folded = h(before, folded, after)
            want.append((r[4], "" if x is None else f"={x}", at, r[2], r[3], trees[x][0], root, h(*(b + a for b, a in steps + top)), folded))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert all((r.claimed == r.leaf) == (r[8] == root) for r in got)


def test_merkle_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert merkle.manifest(docs, [F.col("doc_id"), F.col("text")]).collect() == []
