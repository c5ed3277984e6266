"""Token ids of whole texts in range-coded files, in order of document id, and their reading."""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.llm import range_coder
from lakeloom.llm.token_counts import Memo, _byte_letters

#: Ids of a run: documents are put together until there are so many, and a run's blocks are one row of a file.
RUN = 1 << 16
#: Words, and pieces of words, whose ids a task remembers, twice over.
MEMO = 400_000
_GAP = re.compile("[\n\t\r]")
#: Texts of blanks, printing ASCII and Latin-1's letters beyond it, which no normal form changes.
_PLAIN = re.compile("[\n\t\r -~À-ÖØ-öø-ÿ]*")
#: Contractions, letters, single digits and runs of other characters: the tokenizer's own cut for such texts in lower case.
_CUT = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[^\n\t\r a-z0-9ß-öø-ÿ]+")
_LETTER = {b: c for c, b in _byte_letters().items()}
#: The letters that stand for the bytes of the letters beyond ASCII.
_BYTES = {ord(c): "".join(_LETTER[b] for b in c.encode()) for c in map(chr, range(0xDF, 0x100)) if c != "÷"}
#: Bytes of texts that are cut together.
STEP = 1 << 22
#: What a byte of such words is: blank, letter (as is every byte of one beyond ASCII), digit or other.
_BLANK, _ALPHA, _DIGIT, _OTHER = range(4)
_KINDS = bytes(_BLANK if b <= 32 else _DIGIT if 48 <= b < 58 else _ALPHA if b > 127 or chr(b).isalpha() else _OTHER for b in range(256))
#: The first byte of a Latin-1 letter beyond ASCII; the second of the one that is no upper-case letter below the lower-case ones.
_LEAD, _SHARP = 0xC3, 0x9F
#: The letters of contractions.
_SHORT, _LONG = list(b"stmd"), [a * 256 + b for a, b in (b"re", b"ve", b"ll")]
#: Bytes beyond ASCII that stand for themselves as Latin-1, but for these.
_HIDDEN = {chr(b): c for b, c in _LETTER.items() if b > 127 and chr(b) != c}
_SCHEMA = "part int, run long, tokens long, docs array<long>, lengths array<long>, blocks binary"


class Encoder:
    """Ids of texts for a tokenizer whose tokens never reach across blanks, remembered piece by piece and word by word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.words, self.pieces = Memo(self._word, MEMO), Memo(self._piece, MEMO)
        # the same model for many pieces at once; the last token of a piece shows that it is the last
        self.merger = Tokenizer(self.tokenizer.model)
        self.merger.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocabulary, mark = self.tokenizer.get_vocab(), self.tokenizer.model.end_of_word_suffix
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.last[[i for token, i in vocabulary.items() if mark and token.endswith(mark)]] = True

    def _piece(self, piece: str) -> bytes:
        return _packed([x.id for x in self.merge(piece if piece.isascii() else piece.translate(_BYTES))])

    def _word(self, word: str) -> bytes:
        return self._plain(word) if _is_plain(word) else _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, _CUT.findall(text.lower())))

    def _merged(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece by one call of the library."""
        text = " ".join(pieces)
        if not text.isascii():
            text = text.encode().decode("latin-1")
            for byte, letter in _HIDDEN.items():
                text = text.replace(byte, letter)
        ids = np.array(self.merger.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u2")
        data, ends = ids.tobytes(), (2 * np.flatnonzero(self.last[ids]) + 2).tolist()
        if len(ends) != len(pieces):  # a tokenizer without that mark
            return list(map(self._piece, pieces))
        return list(map(data.__getitem__, map(slice, [0, *ends], ends)))

    def _known(self, pieces: list[str]) -> list[bytes]:
        """The ids of each of some different pieces; those that are not remembered are merged together."""
        memo = self.pieces
        found = list(map(memo.get, pieces))
        if memo.old:
            found = [memo.old.get(x) if y is None else y for x, y in zip(pieces, found)]
        new = [x for x, y in zip(pieces, found) if y is None]
        if new:
            merged = self._merged(new)
            if len(memo) >= MEMO:
                memo.old = dict(memo)
                memo.clear()
            memo.update(zip(new, merged))
            rest = iter(merged)
            found = [next(rest) if y is None else y for y in found]
        return found

    def _side_by_side(self, texts: list[str]) -> list[bytes]:
        """The ids of plain texts, which are cut together."""
        parts = [x.encode() for x in texts]
        body = b"\n%b\n\n\n" % b"\n".join(parts)
        raw, kinds = np.frombuffer(body, np.uint8), np.frombuffer(body.translate(_KINDS), np.uint8)
        lower = np.frombuffer(bytearray(body.lower()), np.uint8)
        second = np.flatnonzero(raw == _LEAD) + 1
        letter = raw.take(second)
        lower[second] = np.where(letter == _SHARP, letter, letter | 32)
        begin = kinds == _DIGIT
        begin[1:] |= kinds[1:] != kinds[:-1]
        # an apostrophe that begins a piece takes the letters of a contraction with it
        quote = np.flatnonzero((raw == ord("'")) & begin)
        quote = quote[kinds.take(quote + 1) == _ALPHA]
        one, two = lower.take(quote + 1), lower.take(quote + 1) * np.int64(256) + lower.take(quote + 2)
        short, long = quote[np.isin(one, _SHORT)], quote[np.isin(two, _LONG)]
        begin[short + 1] = begin[long + 1] = False
        begin[short + 2] = begin[long + 3] = True
        full = kinds != _BLANK
        begin &= full
        # without the blanks, a piece ends where the next one begins
        offsets = np.flatnonzero(np.append(begin[full], True)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(lower.tobytes().translate(None, b"\n\t\r "))).dictionary_encode()
        known = self._known(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids, sizes = np.frombuffer(b"".join(known), "<u2"), np.array([len(x) // 2 for x in known], dtype=np.int64)
        number = pieces.indices.to_numpy()
        n = sizes.take(number)
        ends = np.append(0, np.cumsum(n))
        place = np.repeat((np.cumsum(sizes) - sizes).take(number) - ends[:-1], n) + np.arange(ends[-1])
        data = ids.take(place).tobytes()
        text = np.cumsum([1] + [len(x) + 1 for x in parts])  # where each begins
        bounds = (2 * ends.take(np.searchsorted(np.flatnonzero(begin), text))).tolist()
        return [data[a:b] for a, b in zip(bounds, bounds[1:])]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Little-endian 16-bit ids of each text, without added special tokens.

        Plain texts, and the plain words of others, are cut here and only merged by the library; it gets all other words whole.
        """
        known = self.words.__getitem__
        plain = [_is_plain(x) for x in texts]
        cut = iter(self._side_by_side([x for x, own in zip(texts, plain) if own]) if any(plain) else [])
        return [next(cut) if own else b"".join(map(known, _GAP.sub(" ", x).split(" "))) for x, own in zip(texts, plain)]


def _is_plain(text: str) -> bool:
    return "<|" not in text and _PLAIN.fullmatch(text) is not None


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}H", *ids)


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _writer(tokenizer: str, end_id: int | None):
    end = b"" if end_id is None else np.array([end_id], dtype="<u2").tobytes()

    def run(batches):
        encoder = _encoder(tokenizer)
        runs, docs, parts, size, waiting, number, part = [], [], [], 0, 0, 0, None

        def close():
            nonlocal docs, parts, size, waiting
            if docs:
                runs.append((docs, [len(x) // 2 for x in parts], np.frombuffer(b"".join(parts), "<u2")))
                waiting += -(-len(runs[-1][2]) // range_coder.BLOCK)
            docs, parts, size = [], [], 0

        def coded():
            nonlocal runs, waiting, number
            blocks = [[x[i:i + range_coder.BLOCK] for i in range(0, len(x), range_coder.BLOCK)] for _, _, x in runs]
            done = iter(range_coder.encode([b for own in blocks for b in own]))
            for (ids, lengths, tokens), own in zip(runs, blocks):
                data = b"".join(next(done) for _ in own)
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([len(tokens)], pa.int64()),
                                                  pa.array([ids], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                                                 names=["part", "run", "tokens", "docs", "lengths", "blocks"])
                number += 1
            runs, waiting = [], 0

        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(2)).fill_null(0).to_numpy().astype(np.int64))
            begins = [0, *(np.flatnonzero(np.diff(sizes // STEP)) + 1).tolist(), batch.num_rows]
            for low, high in zip(begins, begins[1:]):
                rows = batch.slice(low, high - low)
                part = rows.column(0)[0].as_py()
                for doc, ids in zip(rows.column(1).to_pylist(), encoder.ids([x or "" for x in rows.column(2).to_pylist()])):
                    docs.append(doc)
                    parts.append(ids + end)
                    size += len(ids) // 2 + 1
                    if size >= RUN:
                        close()
                        if waiting >= range_coder.LANES:
                            yield from coded()
        close()
        yield from coded()
    return run


def write(docs: DataFrame, path: str, tokenizer: str, *, id: str = "doc_id", text: str = "text", end_id: int | None = None) -> None:
    """The ids of all texts, each text's followed by ``end_id``, as coded runs in Parquet files below path.

    Documents stand in ascending order of id (null first, then by text hash): files are parts of a
    range partitioning, numbered by ``part`` and, inside, by ``run``. A run holds whole documents, their ids
    in blocks that are coded from a fresh model and carry their own checksum. Null texts are empty.
    """
    if end_id is not None and not 0 <= end_id <= range_coder.MAX_ID:
        raise ValueError("ids must fit 16 bits")
    rows = docs.select(F.col(id).cast("long").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc", "h").sortWithinPartitions("doc", "h")
    rows.select(F.spark_partition_id().alias("part"), "doc", "text").mapInArrow(_writer(tokenizer, end_id), _SCHEMA).write.parquet(path)


def each_document(use: Callable[[np.ndarray], tuple], fields: pa.Schema):
    """A task's function from rows (docs, lengths, blocks, base) to a row per document: doc_id, start, n_tokens and what ``use`` makes of its ids."""
    def run(batches):
        held, waiting = [], 0

        def decoded():
            tokens = iter(range_coder.decode([b for x in held for b in x[3]]))
            out = [[] for _ in range(3 + len(fields))]
            for docs, lengths, base, blocks in held:
                ids = np.concatenate([next(tokens) for _ in blocks]) if blocks else np.empty(0, "<u2")
                at = 0
                for doc, n in zip(docs, lengths):
                    for column, value in zip(out, (doc, base + at, n, *use(ids[at:at + n]))):
                        column.append(value)
                    at += n
            kinds = [pa.int64()] * 3 + fields.types
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "start", "n_tokens", *fields.names])

        for batch in batches:
            for docs, lengths, base, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                held.append((docs, lengths, base, range_coder.split(data)))
                waiting += len(held[-1][3])
                if waiting >= range_coder.LANES:
                    yield decoded()
                    held, waiting = [], 0
        if held:
            yield decoded()
    return run


def read(spark: SparkSession, path: str, use: Callable[[np.ndarray], tuple] | None = None, fields: pa.Schema | None = None) -> DataFrame:
    """One row per written document: doc_id, start (ids of all documents before it), n_tokens, and ``use`` of its ids.

    Without ``use`` the ids themselves, as ``ids``. A run's start follows from the sizes of the parts and runs ahead,
    which are read without the blocks.
    """
    files = spark.read.schema(_SCHEMA).parquet(path)
    parts = files.groupBy("part").agg(F.sum("tokens").alias("n"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0).cast("long")).alias("first"))
    inside = Window.partitionBy("part").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = files.select("part", "run", F.coalesce(F.sum("tokens").over(inside), F.lit(0).cast("long")).alias("before"))
    bases = runs.join(parts, "part").select("part", "run", (F.col("first") + F.col("before")).alias("base"))
    rows = files.join(bases, ["part", "run"]).select("docs", "lengths", "base", "blocks")
    if use is None:
        use, fields = lambda ids: (ids.tolist(),), pa.schema([("ids", pa.list_(pa.int32()))])
    kinds = ", ".join(f"{f.name} {'array<int>' if pa.types.is_list(f.type) else 'long'}" for f in fields)
    return rows.mapInArrow(each_document(use, fields), f"doc_id long, start long, n_tokens long, {kinds}")


def checksum(ids: np.ndarray) -> tuple[int]:
    """The crc32 of the ids as little-endian 32-bit numbers."""
    return (zlib.crc32(ids.astype("<u4").tobytes()),)
