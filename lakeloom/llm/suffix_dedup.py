"""Long strings that occur more than once, removed: multi-document suffix order, built column by column."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.session import cut

#: Bytes of a string that may stand only once, of the substring that anchors it, and of a symbol.
WIDTH, ANCHOR, SYMBOL = 400, 128, 100
#: Bytes of different strings that one group may hold; larger groups are split by narrower keys.
GROUP_BYTES = 12_000_000
#: Bytes of groups built at once, and of a text scanned at once.
BATCH_BYTES, SCAN_BYTES = 3_000_000, 1 << 22
#: Window starts that one key of a split group covers, level by level; at 1 equal keys mean equal strings.
SPLITS = (32, 1)
#: Occurrences of one key, and bytes of one text's copies, that one task joins; what is more is dealt out over several.
DEAL_ROWS, DEAL_BYTES = 2_500, 1 << 20

_BYTE = np.random.default_rng(20240301).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_STEP = np.random.default_rng(20240302).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(27))


def hashes(data: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of the n bytes from every place on, put together from powers of two."""
    out, done, power, level = None, 0, _BYTE[data], 0
    size = 1
    while True:
        if n & size:
            length = len(data) - n + 1
            if length <= 0:
                return np.empty(0, dtype=np.uint64)
            part = power[done:done + length]
            out = part if out is None else _mixed(out * _STEP[level + 32] + part)
            done += size
        if size * 2 > n:
            return out
        power = _mixed(power[:len(power) - size] * _STEP[level] + power[size:])
        size, level = size * 2, level + 1


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row: running minima from block starts and ends."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchored(data: np.ndarray, width: int = WIDTH, anchor: int = ANCHOR):
    """(group, first window, last window, anchor's place) of every run of windows with one anchor.

    A window's anchor is its substring of least hash, the leftmost of equals. It depends on the window's bytes
    alone, so equal windows have equal anchors at equal places within.
    """
    n = len(data) - width + 1
    if n <= 0:
        return []
    own = hashes(data, anchor)
    low = np.uint64(23)
    least = _sliding_least((own >> low << low) | np.arange(len(own), dtype=np.uint64), width - anchor + 1)
    place = (least & np.uint64((1 << 23) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([first[1:] - 1, [n - 1]])
    at = place[first]
    return list(zip(own[at].view(np.int64).tolist(), first.tolist(), last.tolist(), at.tolist()))


def _short(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


_OCCURRENCE = "group long, piece long, key long, bytes long, start long, size int, turn int"


def _occurrences(width: int, anchor: int):
    """Rows of every run of windows in a text: its group, a hash of its bytes, where it stands; turn: the anchor's place in it."""
    def run(batches):
        for batch in batches:
            out = [[] for _ in range(7)]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_buffer()
                if raw is None or raw.size < width:
                    continue
                data, body = np.frombuffer(raw, np.uint8), raw.to_pybytes()
                for begin in range(0, len(data) - width + 1, SCAN_BYTES):
                    for group, first, last, at in anchored(data[begin:begin + SCAN_BYTES + width - 1], width, anchor):
                        a, z = begin + first, begin + last + width
                        for column, value in zip(out, (group, _short(body[a:z]), key, len(data), a, z - a, at - first)):
                            column.append(value)
                if len(out[0]) > 50_000:
                    yield _batch(out)
                    out = [[] for _ in range(7)]
            yield _batch(out)
    return run


def _batch(columns) -> pa.RecordBatch:
    kinds = [pa.int64()] * 5 + [pa.int32()] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["group", "piece", "key", "bytes", "start", "size", "turn"])


def _split(width: int, span: int):
    """Occurrences cut into runs of windows of the same ``span`` of places before the anchor, keyed by the bytes all of them share."""
    def run(batches):
        for batch in batches:
            out = [[] for _ in range(7)]
            for text, key, size, wanted in zip(*(batch.column(i).to_pylist() for i in range(4))):
                body = text.encode("utf-8", "surrogatepass")
                for x in wanted:
                    low, high = x["turn"] - (x["size"] - width), x["turn"]  # places of the anchor in its last and first window
                    for block in range(low // span, high // span + 1):
                        one, two = max(low, block * span), min(high, block * span + span - 1)
                        a, z = x["start"] + x["turn"] - two, x["start"] + x["turn"] - one + width
                        # whatever windows of the block are there, all hold the bytes from its latest start to its earliest end
                        core = x["start"] + x["turn"] - block * span
                        name = _short(b"%d %d " % (x["group"], block) + body[core:core - span + 1 + width])
                        for column, value in zip(out, (name, _short(body[a:z]), key, size, a, z - a, x["start"] + x["turn"] - a)):
                            column.append(value)
            yield _batch(out)
    return run


def repeats(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, width: int = WIDTH, symbol: int = SYMBOL) -> np.ndarray:
    """For every place of the strings data[start:end]: whether the ``width`` bytes from it on also start elsewhere.

    Every string is read as ``symbol`` sequences, one for each phase, of symbols of so many bytes. The
    collection starts with the sequences' empty suffixes. Each round puts one symbol in front of the suffixes: the
    symbols before them, in the order of the collection, are its Burrows-Wheeler transform; sorting them
    stably gives the next order. Two neighbours share one symbol more than the least that their
    remainders' neighbours between them shared, which running counts of small values tell. Common prefixes are kept
    up to width / symbol symbols, and that many rounds settle them.
    """
    goal = width // symbol
    if width % symbol or not len(starts):
        raise ValueError("the width must be a multiple of the symbol, and strings must be given")
    own = hashes(data, symbol)
    names = np.zeros(len(data), dtype=np.int64)
    names[:len(own)] = np.unique(own, return_inverse=True)[1]
    begin = np.repeat(starts, ends - starts)  # of the string that holds a place; strings stand side by side
    begin = np.append(begin, begin[-1:])
    order = (ends[:, None] - np.arange(symbol)[None, :]).ravel()
    owner = np.repeat(starts, symbol)
    order, owner = order[order >= owner], owner[order >= owner]
    common = np.zeros(len(order), dtype=np.int8)
    empty, empty_owner = order, owner
    rounds = int((ends - starts).max()) // symbol
    for _ in range(rounds):
        ahead = order - symbol
        live = np.flatnonzero(ahead >= owner)
        turned = np.sort((names[ahead[live]] << 32) | live)
        pick = turned & 0xFFFFFFFF
        letter = turned >> 32
        shared = np.ones(max(0, len(pick) - 1), dtype=np.int8)
        for t in range(1, goal):
            small = np.cumsum(common < t, dtype=np.int32)
            shared += small[pick[1:]] == small[pick[:-1]]
        shared[letter[1:] != letter[:-1]] = 0
        common = np.concatenate([np.zeros(len(empty) + min(1, len(pick)), dtype=np.int8), shared])
        order, owner = np.concatenate([empty, ahead[pick]]), np.concatenate([empty_owner, owner[pick]])
    twice = common >= goal
    twice[:-1] |= common[1:] >= goal
    found = np.zeros(len(data), dtype=bool)
    found[order[twice]] = True
    return found


def spans(found: np.ndarray, width: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes that the windows starting at the marked places cover."""
    at = np.flatnonzero(found)
    if not len(at):
        return []
    gap = np.flatnonzero(at[1:] > at[:-1] + width)
    return list(zip(at[np.concatenate([[0], gap + 1])].tolist(), (at[np.concatenate([gap, [len(at) - 1]])] + width).tolist()))


def _built(width: int, symbol: int):
    """Strings of whole groups, group after group, to the runs of bytes that repeat in each."""
    def run(batches):
        held: dict[tuple[int, int], bytes] = {}
        size, group = 0, None

        def done():
            data = np.frombuffer(b"".join(held.values()), dtype=np.uint8)
            ends = np.cumsum([len(x) for x in held.values()])
            starts = ends - [len(x) for x in held.values()]
            found = repeats(data, starts, ends, width, symbol)
            out = [[], [], [], []]
            for (g, p), a, z in zip(held, starts, ends):
                for x, y in spans(found[a:z], width):
                    for column, value in zip(out, (g, p, x, y)):
                        column.append(value)
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32())],
                                              names=["group", "piece", "from", "to"])

        for batch in batches:
            for g, p, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if g != group and size > BATCH_BYTES:
                    yield done()
                    held, size = {}, 0
                group = g
                if (g, p) not in held:
                    held[g, p] = text
                    size += len(text)
        if held:
            yield done()
    return run


def _cutter(batches):
    for batch in batches:
        out = [[], [], []]
        for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            body = text.encode("utf-8", "surrogatepass")
            for x in wanted:
                for column, value in zip(out, (x["group"], x["piece"], body[x["start"]:x["start"] + x["size"]])):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], names=["group", "piece", "body"])


def _dealt(many: DataFrame, few: DataFrame, on: list[str], deals: DataFrame, place, how: str = "inner") -> DataFrame:
    """``many`` joined with ``few``, the keys that ``deals`` (on, deals) names by so many tasks each: ``place`` tells a row's.

    ``few`` is repeated for every deal. ``deals`` is a table of its own, so the optimizer knows that it is small.
    """
    count = F.coalesce("deals", F.lit(1))
    many = many.withColumn("deal", F.xxhash64(place)).join(deals, on, "left").withColumn("deal", F.pmod("deal", count)).drop("deals")
    few = few.join(deals, on, "left").withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), count - 1))).drop("deals")
    return many.join(few, [*on, "deal"], how).drop("deal")


def _deals(counted: DataFrame, on: list[str], size, most: int) -> DataFrame:
    """Keys whose ``n`` rows are more than ``most`` together, with the number of tasks that join them."""
    return cut(counted.filter(F.col("n") > 1).filter(size > most).select(*on, F.least(F.col("n"), F.ceil(size / most)).alias("deals")))


def _texts(docs: DataFrame, wanted: DataFrame, fields: list[str]) -> DataFrame:
    """Each text that the wanted rows name, once, with those rows of it."""
    asked = wanted.groupBy("key", "bytes").agg(F.collect_list(F.struct(*fields)).alias("wanted"))
    return docs.groupBy("key", "bytes").agg(F.first("text").alias("text")).join(asked, ["key", "bytes"])


def repeated_spans(docs: DataFrame, *, width: int = WIDTH, anchor: int = ANCHOR, symbol: int = SYMBOL, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Rows (key, bytes, from, to) of the bytes of texts (key, bytes, text) that repeated strings cover.

    Runs of windows are grouped by their anchor. A group of one run holds nothing twice. Where all runs of a group are
    equal strings, all of them repeat. Of the other groups each different string is read once and
    enters the construction, a string that occurs several times repeating as a whole. The runs of a large group, and the
    occurrences of a frequent string, are dealt out over several tasks. Groups whose different strings exceed
    ``group_bytes`` are split by keys that fewer windows share, at last by single windows; so no task holds more.
    """
    level = cut(docs.select("key", "text").mapInArrow(_occurrences(width, anchor), _OCCURRENCE))
    out = None
    for span in (*SPLITS, None):
        # counted before the shuffle and joined back by several tasks, so that none gathers a large group's runs
        sizes = level.groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.min("piece").alias("lo"), F.max("piece").alias("hi"))
        sizes = cut(sizes.filter("n > 1").select("group", "n", (F.col("lo") != F.col("hi")).alias("mixed")))
        row = F.monotonically_increasing_id()  # of a table, whose rows stay where they are
        groups = cut(_dealt(level, sizes.drop("n"), ["group"], _deals(sizes, ["group"], F.col("n"), DEAL_ROWS), row))
        plain = groups.filter("NOT mixed").select("key", "bytes", F.col("start").alias("from"), (F.col("start") + F.col("size")).alias("to"))
        first = F.min(F.struct("key", "bytes", "start", "size")).alias("x")
        pieces = groups.filter("mixed").groupBy("group", "piece").agg(F.count(F.lit(1)).alias("n"), first)
        pieces = cut(pieces.select("group", "piece", "n", "x.*"))
        large = cut(pieces.groupBy("group").agg(F.sum("size").alias("all")).filter(F.col("all") > group_bytes).select("group"))
        any_large = span is not None and not large.isEmpty()
        small = pieces.join(large, "group", "left_anti") if any_large else pieces
        several = small.filter("n > 1").select("group", "piece", F.lit(0).alias("from"), F.col("size").alias("to"))
        bodies = _texts(docs, small.select("group", "piece", "key", "bytes", "start", "size"), ["group", "piece", "start", "size"])
        bodies = bodies.select("text", "wanted").mapInArrow(_cutter, "group long, piece long, body binary")
        built = bodies.repartition("group").sortWithinPartitions("group", "piece").mapInArrow(
            _built(width, symbol), "group long, piece long, from int, to int")
        found = cut(built.unionAll(several))
        often = _deals(pieces, ["group", "piece"], F.col("n"), DEAL_ROWS)
        hits = _dealt(groups.filter("mixed"), found, ["group", "piece"], often, row).select(
            "key", "bytes", (F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("to")).alias("to"))
        out = plain.unionAll(hits) if out is None else out.unionAll(plain).unionAll(hits)
        if not any_large:
            return out.distinct()
        rest = groups.filter("mixed").join(large, "group", "left_semi")
        asked = _texts(docs, rest.select("key", "bytes", "group", "start", "size", "turn").distinct(), ["group", "start", "size", "turn"])
        copies = docs.groupBy("key", "bytes").agg(F.count(F.lit(1)).alias("copies"))
        parts = asked.select("text", "key", "bytes", "wanted").mapInArrow(_split(width, span), _OCCURRENCE)
        # a text that several rows hold occurs as often
        level = cut(parts.join(copies, ["key", "bytes"]).withColumn("copies", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(2).cast("long"))))).drop("copies"))
    return out.distinct()


def _removed(batches):
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            yield _left(batch.slice(low, 256))


def _left(batch: pa.RecordBatch) -> pa.RecordBatch:
    out = [[] for _ in range(4)]
    for text, wanted in zip(batch.column(1), batch.column(2).to_pylist()):
        body = text.as_buffer().to_pybytes()
        kept, at, runs = [], 0, 0
        for x in sorted(wanted or [], key=lambda x: (x["from"], x["to"])):
            if x["from"] > at or not runs:
                kept.append(body[at:x["from"]])
                runs += 1
            at = max(at, x["to"])
        kept = b"".join([*kept, body[at:]])
        for column, value in zip(out, (len(body), len(body) - len(kept), runs, kept)):
            column.append(value)
    return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in out[:3]), pa.array(out[3], pa.binary())],
                                      names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def dedup(docs: DataFrame, *, id: str = "doc_id", text: str = "text", width: int = WIDTH, **sizes) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept (binary) and kept as ``text``, a character that was cut being U+FFFD.

    Texts are UTF-8 bytes, null texts empty. A byte goes if a string of ``width`` bytes that covers it also
    starts anywhere else, in the same text too; judged on the input. Spans are maximal runs of removed bytes. Equal texts,
    with one id or several, hold each other's strings. Null ids are kept; other columns are ignored.
    """
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumns({"key": F.xxhash64("text"), "bytes": F.octet_length("text").cast("long")})
    found = repeated_spans(rows.select("key", "bytes", "text"), width=width, **sizes)
    held = found.groupBy("key", "bytes").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    copies = rows.filter(F.col("bytes") >= width).groupBy("key", "bytes").agg(F.count(F.lit(1)).alias("n"))
    copies = _deals(copies, ["key", "bytes"], F.col("n") * F.col("bytes"), DEAL_BYTES)
    placed = _dealt(rows, held, ["key", "bytes"], copies, F.col("doc_id"), "left").select("doc_id", "text", "spans")
    return placed.mapInArrow(_removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary").withColumn(
        "text", F.make_valid_utf8(F.col("kept").cast("string")))
