"""Exact token counts at every prefix of a text, by dynamic programming over byte-pair encodings."""

from __future__ import annotations

import json
import operator
import re
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Unicode's white space, the tokenizer's split pattern and its contractions.
SPACE = "\t\n\x0b\f\r \x85\xa0  -     　"
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
#: A unit is a run of white space with the run of other characters after it. No token reaches across its end.
UNITS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
GAP = re.compile(f"[{SPACE}]")
LIMIT = 1024
#: Characters split at once, and entries each memo may hold twice over.
STEP, MEMO = 1 << 20, 300_000


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if it prints, else the next free one from 256 on."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(printing)]
    return {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Memo(dict):
    """A dictionary that works out what it lacks. When it is full, it starts anew but still looks into what it held."""

    def __init__(self, work, most: int = MEMO):
        super().__init__()
        self.work, self.most, self.old = work, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        value = self[key] = self.work(key) if value is None else value
        return value


class Counter:
    """Counts of one byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        byte = _byte_letters()
        merges = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in said["model"]["merges"]]
        raw = lambda t: bytes(byte[c] for c in t)
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        special = [x["content"] for x in said["added_tokens"]]
        self.tokens = {a + b for a, b in self.rank} | {bytes([b]) for b in range(256)}
        self.longest = max(map(len, self.tokens))
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.whole = Memo(lambda t: self.encode(t) == [t])
        # two tokens that a rule merges never stay side by side
        self.adjacent = Memo(lambda st: st not in self.rank and self.encode(st[0] + st[1]) == [st[0], st[1]])
        self.pieces = Memo(self.piece)
        self.units = Memo(self.steps)

    def encode(self, text: bytes) -> list[bytes]:
        """The tokens of a short piece, by merging the pair of lowest rank until none is left."""
        parts = [text[i:i + 1] for i in range(len(text))]
        while len(parts) > 1:
            ranks = [self.rank.get(x, len(self.rank)) for x in zip(parts, parts[1:])]
            best = min(ranks)
            if best == len(self.rank):
                break
            pair = parts[ranks.index(best):][:2]
            merged, i = [], 0
            while i < len(parts):
                if parts[i:i + 2] == pair:
                    merged.append(pair[0] + pair[1])
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts

    def piece(self, text: str) -> tuple[int, ...]:
        """Token counts of every prefix of a piece.

        The encoding of a prefix is that of a shorter one plus its last token, and a token may follow
        another exactly if both together encode to just the two. One ending token fits at every place.
        """
        data = text.encode("utf-8", "surrogatepass")
        last: list[bytes] = [b""]
        count = [0]
        for i in range(1, len(data) + 1):
            for n in range(min(i, self.longest), 0, -1):
                token = data[i - n:i]
                if token in self.tokens and (self.whole[token] if n == i else self.adjacent[last[i - n], token]):
                    last.append(token)
                    count.append(count[i - n] + 1)
                    break
        return tuple(count[i] for i in range(1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80)

    def unit(self, text: str) -> list[int]:
        """Token counts of every prefix of a unit.

        White space at the end of a text is one piece; before a word its last character is a piece of its
        own, or the word's first if it is a blank. A contraction's prefixes are an apostrophe and a letter.
        """
        word = text.lstrip(_STRIP)
        space = text[:len(text) - len(word)]
        out = list(self.pieces[space]) if space else []
        if not word:
            return out
        base = self.pieces[space[:-1]][-1] if len(space) > 1 else 0
        if space.endswith(" "):
            word, skip = " " + word, 1
        else:
            base, skip = base + (self.pieces[space[-1]][-1] if space else 0), 0
        for part in PIECES.findall(word):
            counts = self.pieces[part]
            if part in CONTRACTIONS:
                counts = (*range(1, len(part)), counts[-1])
            out += [base + c for c in counts[skip:]]
            base, skip = base + counts[-1], 0
        return out

    def steps(self, text: str) -> bytes:
        counts = self.unit(text)
        return struct.pack(f"<{len(counts)}h", counts[0], *map(operator.sub, counts[1:], counts))

    def plain(self, text: str) -> bytes:
        """Changes of the count from prefix to prefix, two bytes a character, for a text without special strings."""
        out, at = [], 0
        while at < len(text):
            gap = GAP.search(text, at + STEP) if len(text) - at > STEP else None
            # leave a unit whole: the next one starts with the white space
            end = gap.start() if gap else len(text)
            out.append(b"".join(map(self.units.__getitem__, UNITS.findall(text, at, end))))
            at = end
        return b"".join(out)

    def changes(self, text: str) -> bytes:
        """As ``plain``; a special string counts as one token from its last character on."""
        found = self.special.search(text) if self.special else None
        if not found:
            return self.plain(text)
        out, at = [], 0
        for found in self.special.finditer(text):
            start, end = found.span()
            ahead = self.plain(text[at:end - 1])
            counts = np.frombuffer(ahead, "<i2").astype(np.int64)
            step = int(counts[:start - at].sum()) + 1 - int(counts.sum())
            out += [ahead, np.array([step], "<i2").tobytes()]
            at = end
        return b"".join(out) + self.plain(text[at:])


_STRIP = "".join(chr(c) for c in range(0x3001) if GAP.match(chr(c)))
_COUNTERS: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def prefix_counts(docs: DataFrame, tokenizer: str, *, id: str = "doc_id", text: str = "text", limit: int = LIMIT, changes: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens, limit_chars, changes.

    ``tokenizer`` is the path of a byte-level tokenizer file, at the same place on all machines. ``changes``
    holds the difference of the token count from each prefix to the next, one little-endian 16-bit integer a
    character: their running sum is the exact count of every prefix. ``limit_chars`` is the longest
    prefix of at most ``limit`` tokens. Null texts count as empty; other columns are ignored. Without ``changes``
    the column is null, where the prefixes' counts are not wanted afterwards.
    """
    def run(batches):
        counter = _counter(tokenizer)
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                sizes, totals, chars, held = [], [], [], []
                for value in part.column(1).to_pylist():
                    value = value or ""
                    own = counter.changes(value)
                    counts = np.frombuffer(own, "<i2")
                    total = int(counts.sum(dtype=np.int64))
                    fits = len(value)
                    if len(value) > limit or total > limit:
                        within = np.flatnonzero(np.cumsum(counts, dtype=np.int64) <= limit)
                        fits = int(within[-1]) + 1 if len(within) else 0
                    sizes.append(len(value.encode("utf-8", "surrogatepass")))
                    totals.append(total)
                    chars.append(fits)
                    held.append(own if changes else None)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()),
                                                  pa.array(chars, pa.int64()), pa.array(held, pa.binary())],
                                                 names=["doc_id", "n_bytes", "n_tokens", "limit_chars", "changes"])

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, limit_chars long, changes binary")


def count_at(changes: Column, chars: Column) -> Column:
    """The token count of the prefix of so many characters, read from ``changes``."""
    @F.pandas_udf("long")
    def run(held, at):
        return held.combine(at, lambda h, n: int(np.frombuffer(h, "<i2")[:int(n)].sum(dtype=np.int64)))

    return run(changes, chars)
