"""Benchmark items found in training texts: BM25 over an index of the items, block-max WAND, then overlap."""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import cached_property
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm import shingles
from lakeloom.session import cut

K1, B = 1.2, 0.75
#: Passages have 2 * STRIDE words and start every STRIDE words, so any run of STRIDE words lies in one of them.
#: Longer items are indexed in pieces of STRIDE words.
STRIDE = 64
#: A passage retrieves an item from this share of the score that the item itself would reach.
THRESHOLD = 0.5
#: Shares of the question's and the answer's shingles that must stand in the text around a passage that retrieved the item.
OVERLAP = 0.75
#: Items of a posting block, and words of an index part: the index of one part is what is sent to the tasks.
BLOCK, PART_WORDS = 2, 1_000_000
#: Bounds of (window, block) held at once.
CELLS = 1 << 20

_TERM = np.zeros(256, dtype=bool)
_TERM[48:58] = _TERM[97:123] = _TERM[128:] = True
_SENTENCE = re.compile(r"(?<=[.!?])\s+(?=\S)")


def _terms(text: str) -> np.ndarray:
    return shingles.word_hashes(pa.array([text], pa.string()), _TERM)[0]


def halves(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Question and answer of an item: its last sentence answers, or its last quarter where there is but one."""
    parts = [x for x in _SENTENCE.split(text.strip()) if len(_terms(x))]
    if len(parts) > 1:
        return _terms(" ".join(parts[:-1])), _terms(parts[-1])
    words = _terms(text)
    at = len(words) - max(1, len(words) // 4)
    return words[:at], words[at:]


def _shared(part: np.ndarray, around: np.ndarray) -> float:
    """The share of a part's distinct shingles in the words around; shorter parts count as one shingle of their length."""
    if not len(part):
        return 1.0
    n = min(len(part), shingles.N)
    wanted = np.unique(shingles.grams(part, n))
    return float(np.isin(wanted, shingles.grams(around, n)).mean())


class Index:
    """Postings of one part: terms, and per term items in ascending order with their share of the item's own score."""

    def __init__(self, terms: np.ndarray, pieces: np.ndarray, impacts: np.ndarray, items: list[int], texts: list[str]):
        order = np.lexsort((pieces, terms))
        terms, self.pieces, self.impacts = terms[order], pieces[order], impacts[order]
        self.terms, self.first = np.unique(terms, return_index=True)
        self.last = np.append(self.first[1:], len(terms))
        self.items, self.texts = items, texts
        row = np.repeat(np.arange(len(self.terms)), self.last - self.first)
        cell = row * (self._blocks() + 1) + self.pieces // BLOCK
        at, where = np.unique(cell, return_index=True)
        self.block_of, self.block_row = at % (self._blocks() + 1), at // (self._blocks() + 1)
        self.block_max = np.maximum.reduceat(self.impacts, where) if len(where) else np.empty(0)
        self.block_first = np.searchsorted(self.block_row, np.arange(len(self.terms)))
        self.block_last = np.searchsorted(self.block_row, np.arange(len(self.terms)), "right")
        self.best = np.maximum.reduceat(self.impacts, self.first) if len(self.terms) else np.empty(0)

    def _blocks(self) -> int:
        return int(self.pieces.max()) // BLOCK if len(self.pieces) else 0

    def promising(self, window: np.ndarray, row: np.ndarray, threshold: float) -> list[tuple[int, int]]:
        """(window, block) wherever the block's upper bound, the sum of its terms' block maxima, reaches the threshold.

        ``window`` and ``row`` list each window's distinct known terms, by window; no other block can hold a
        hit. So many windows are bounded at once that all their blocks fit a table of CELLS.
        """
        width = self._blocks() + 1
        step, out = max(1, CELLS // width), []
        for low in range(0, int(window[-1]) + 1, step):
            a, z = np.searchsorted(window, (low, low + step))
            mine = row[a:z]
            size = self.block_last[mine] - self.block_first[mine]
            ahead = self.block_first[mine] - (np.cumsum(size) - size)
            place = np.arange(int(size.sum())) + np.repeat(ahead, size)
            cell = np.repeat((window[a:z] - low) * width, size) + self.block_of[place]
            bound = np.bincount(cell, self.block_max[place], minlength=step * width)
            hit = np.flatnonzero(bound >= threshold - 1e-9)
            out += zip((low + hit // width).tolist(), (hit % width).tolist())
        return out

    def search(self, rows: list[int], blocks: list[int], threshold: float) -> dict[int, float]:
        """All pieces whose score for these terms reaches the threshold, by block-max WAND.

        Lists are kept in order of their next piece. The first lists whose best impacts together reach the
        threshold name the pivot. Where the pivot's block is not among the ``blocks`` whose maxima
        reach it, the lists leap to the next one that is; else the pivot is scored. Both bounds are safe, so
        nothing is missed.
        """
        pieces, impacts, last, best = self.lists
        at = {r: bisect_left(pieces, blocks[0] * BLOCK, int(self.first[r]), last[r]) for r in rows}
        found, ahead = {}, iter(blocks)
        block = next(ahead)
        while True:
            live = sorted((pieces[p], r) for r, p in at.items() if p < last[r])
            total, pivot = 0.0, None
            for piece, r in live:
                total += best[r]
                if total >= threshold - 1e-9:
                    pivot = piece
                    break
            while pivot is not None and block < pivot // BLOCK:
                block = next(ahead, None)
                if block is None:
                    return found
            if pivot is None:
                return found
            if block > pivot // BLOCK:
                for piece, r in live:
                    if piece < block * BLOCK:
                        at[r] = bisect_left(pieces, block * BLOCK, at[r], last[r])
                continue
            score = 0.0
            for piece, r in live:
                if piece > pivot:
                    break
                p = bisect_left(pieces, pivot, at[r], last[r])
                if p < last[r] and pieces[p] == pivot:
                    score += impacts[p]
                    p += 1
                at[r] = p
            if score >= threshold - 1e-9:
                found[pivot] = score

    @cached_property
    def lists(self) -> tuple[list, list, list, list]:
        """The postings as Python lists, which the search walks one by one."""
        return self.pieces.tolist(), self.impacts.tolist(), self.last.tolist(), self.best.tolist()


def _postings(stride: int):
    def run(batches):
        for batch in batches:
            out = {"item": [], "piece": [], "term": [], "tf": [], "length": []}
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _terms(text)
                pieces = max(1, -(-len(words) // stride))
                for k in range(pieces):
                    part = words[k * len(words) // pieces:(k + 1) * len(words) // pieces]
                    terms, tf = np.unique(part, return_counts=True)
                    n = len(terms)
                    for name, values in zip(out, ([item] * n, [k] * n, terms.view(np.int64).tolist(), tf.tolist(), [len(part)] * n)):
                        out[name] += values
            yield pa.RecordBatch.from_pydict(out)
    return run


def index_parts(items: DataFrame, part_words: int = PART_WORDS, stride: int = STRIDE):
    """The Index of every part of the items (item, text). Statistics cover all items, each part holds about ``part_words`` words."""
    posts = cut(items.mapInArrow(_postings(stride), "item long, piece long, term long, tf long, length long"))
    count, mean, words = posts.select("item", "piece", "length").distinct().agg(
        F.count(F.lit(1)), F.avg("length"), F.sum("length")).first()
    if not count:
        return
    seen = posts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log1p((F.lit(count) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    norm = F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(mean))
    scored = posts.join(seen, "term").withColumn("impact", idf * F.col("tf") * (K1 + 1) / norm)
    whole = Window.partitionBy("item", "piece")
    scored = cut(scored.withColumn("impact", F.col("impact") / F.sum("impact").over(whole)).select("item", "piece", "term", "impact"))
    parts = -(-words // part_words)
    for k in range(parts):
        mine = F.pmod(F.xxhash64("item"), F.lit(parts)) == k
        rows = scored.filter(mine).toArrow()
        if not rows.num_rows:
            continue
        texts = {x["item"]: x["text"] for x in items.filter(mine).toArrow().to_pylist()}
        ids, pieces = rows.column("item").to_numpy(), rows.column("piece").to_numpy()
        names, number = np.unique(np.stack([ids, pieces], axis=1), axis=0, return_inverse=True)
        number, owners = number.reshape(-1), names[:, 0].tolist()
        yield Index(rows.column("term").to_numpy().view(np.uint64), number, rows.column("impact").to_numpy(), owners,
                    [texts[x] for x in owners])


def _finder(sent, threshold: float, overlap: float, stride: int):
    def run(batches):
        index: Index = sent.value
        parts = {}
        for batch in batches:
            for low in range(0, batch.num_rows, 128):
                part = batch.slice(low, 128)
                yield _found(index, parts, part, threshold, overlap, stride)
    return run


def _found(index: Index, parts: dict, batch: pa.RecordBatch, threshold: float, overlap: float, stride: int) -> pa.RecordBatch:
    hashes, upto = shingles.word_hashes(batch.column(2), _TERM)
    begin = np.concatenate([[0], upto[:-1]])
    count = np.maximum(1, -(-(upto - begin - stride) // stride))
    base = np.cumsum(count) - count
    row = np.searchsorted(index.terms, hashes)
    known = np.flatnonzero(index.terms[np.minimum(row, len(index.terms) - 1)] == hashes)
    doc = np.searchsorted(upto, known, "right")
    k = (known - begin[doc]) // stride
    window = np.concatenate([base[doc] + np.minimum(k, count[doc] - 1), (base[doc] + k - 1)[k > 0]])
    both = np.unique(window * len(index.terms) + np.concatenate([row[known], row[known][k > 0]]))
    window, row = both // len(index.terms), both % len(index.terms)
    out = {"doc_id": [], "key": [], "item_id": [], "passage": [], "score": [], "question": [], "answer": []}
    if len(window):
        ids, keys = batch.column(0), batch.column(1)
        for w, blocks in groupby(index.promising(window, row, threshold), key=lambda x: x[0]):
            mine = row[np.searchsorted(window, w):np.searchsorted(window, w, "right")].tolist()
            hits = index.search(mine, [b for _, b in blocks], threshold)
            if not hits:
                continue
            d = int(np.searchsorted(base, w, "right")) - 1
            start = begin[d] + (w - base[d]) * stride
            for piece, score in hits.items():
                item, text = index.items[piece], index.texts[piece]
                if item not in parts:
                    parts[item] = halves(text)
                question, answer = parts[item]
                reach = len(question) + len(answer)
                around = hashes[max(begin[d], start - reach):min(upto[d], start + 2 * stride + reach)]
                for name, value in zip(out, (ids[d].as_py(), keys[d].as_py(), item, int(w - base[d]), score,
                                             _shared(question, around), _shared(answer, around))):
                    out[name].append(value)
    return pa.RecordBatch.from_arrays([
        pa.array(out["doc_id"], pa.int64()), pa.array(out["key"], pa.int64()), pa.array(out["item_id"], pa.int64()),
        pa.array(out["passage"], pa.int64()), *(pa.array(out[x], pa.float64()) for x in ("score", "question", "answer"))], names=list(out))


def matches(docs: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", text: str = "text", item: str = "item_id",
            item_text: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP, stride: int = STRIDE,
            part_words: int = PART_WORDS) -> DataFrame:
    """Rows (doc_id, key, item_id, passages, score, question, answer, leaked) of every text and item retrieved.

    Every passage of every text queries the index; ``passages`` of them retrieve the item, ``score`` is the
    largest share of the item's own score, ``question`` and ``answer`` the largest shares of their
    shingles found around such a passage. ``leaked`` asks for ``overlap`` of both around one passage. ``key``
    hashes the text, so that rows without id or with a repeated id can be told apart; repeated rows count once.
    Null or wordless texts and items match nothing, and an empty table on either side gives an empty result. Items
    that share an id are one item, with the text that sorts first. Each index part is one more pass over
    the texts; a part's size is bounded, whatever the number of items.
    """
    items = benchmark.select(F.col(item).cast("long").alias("item"), F.col(item_text).alias("text"))
    items = items.filter("item IS NOT NULL AND text IS NOT NULL").groupBy("item").agg(F.min("text").alias("text"))
    asked = docs.select(F.col(id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("key"), F.col(text).alias("text"))
    schema = "doc_id long, key long, item_id long, passage long, score double, question double, answer double"
    found = docs.sparkSession.createDataFrame([], schema)
    for index in index_parts(items, part_words, stride):
        sent = docs.sparkSession.sparkContext.broadcast(index)
        found = found.unionAll(asked.mapInArrow(_finder(sent, threshold, overlap, stride), schema))
    leaked = (F.col("question") >= overlap) & (F.col("answer") >= overlap)
    return found.groupBy("doc_id", "key", "item_id").agg(
        F.countDistinct("passage").alias("passages"), F.round(F.max("score"), 6).alias("score"),
        F.max("question").alias("question"), F.max("answer").alias("answer"), F.max(leaked).alias("leaked"))


def clean(docs: DataFrame, benchmark: DataFrame, *, id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """The rows without a leaked item, with all their columns."""
    bad = cut(matches(docs, benchmark, id=id, text=text, **limits).filter("leaked").select(
        F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct())
    same = docs[id].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(docs[text]) == F.col("__key"))
    return docs.join(bad, same, "left_anti")
