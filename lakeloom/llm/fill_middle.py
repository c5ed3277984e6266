"""Fill-in-middle texts: prefix, middle and suffix of every text, put in another order, by pyarrow.compute."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What stands before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts so many stay plain, and so many of the others put the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
#: Bytes of text whose units are held as rows at once; longer texts are cut and put together again.
WINDOW = 1 << 20

_OUT = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                  ("output", pa.string())])
OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(id: Column, seed: str) -> list[Column]:
    """Four numbers below 2^32 that seed and id decide: the first 8-digit groups of a digest of both."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def transform(docs: DataFrame, *, id: str = "doc_id", text: str = "text", seed: str = "1", plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST,
              window: int = WINDOW) -> DataFrame:
    """Rows (doc_id, n, form, prefix_chars, middle_chars, output), one per document, its units being code points.

    Two draws place the cuts among the n + 1 places there are, a third decides whether the text stays plain, a fourth the form:
    ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle). Null texts are empty; empty texts and texts that hold a
    marker are plain, without lengths. Rows with one id draw alike, a null id as the empty one. Other columns are
    ignored, whatever their names; no rows give no rows. One pass without shuffle; a task holds one Arrow batch and the units of
    ``window`` bytes, however long a text is.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    h1, h2, h3, h4 = draws(F.col(id).cast("long"), seed)
    held = (body == "") | F.contains(body, F.lit(PREFIX)) | F.contains(body, F.lit(SUFFIX)) | F.contains(body, F.lit(MIDDLE))
    form = F.when(held | (h3 % 100 >= 100 - plain), "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), body.alias("text"), h1.alias("h1"), h2.alias("h2"), form.alias("form"))
    return rows.mapInArrow(_transformer(window), OUT)


def _transformer(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, text, h1, h2, form = (batch.column(i) for i in range(5))
            text = text.cast(pa.string())
            n = pc.cast(pc.utf8_length(text), pa.int64())
            places = pc.add(n, 1)
            one, two = (pc.subtract(h, pc.multiply(pc.divide(h, places), places)) for h in (h1, h2))
            is_plain = pc.equal(form, "plain")
            first = pc.if_else(is_plain, n, pc.min_element_wise(one, two))
            last = pc.if_else(is_plain, n, pc.max_element_wise(one, two))
            prefix, middle, suffix = cut(text, first, last, window)
            psm = pc.binary_join_element_wise(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle, "")
            spm = pc.binary_join_element_wise(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle, "")
            output = pc.if_else(is_plain, text, pc.if_else(pc.equal(form, "spm"), spm, psm))
            none = pa.scalar(None, pa.int64())
            yield pa.RecordBatch.from_arrays([doc, n, form, pc.if_else(is_plain, none, first), pc.if_else(is_plain, none, pc.subtract(last, first)),
                                              output], schema=_OUT)
    return run


def cut(text: pa.StringArray, first: pa.Int64Array, last: pa.Int64Array, window: int = WINDOW) -> tuple[pa.StringArray, ...]:
    """Prefix, middle and suffix of every text: its units before ``first``, between both, and from ``last`` on.

    The texts' units become list arrays, a window of bytes at a time; flattened with the index of the list they stood in they get
    their ordinals, are filtered by role, put back into lists and joined. A window may hold many texts, or a part of one: a
    text's parts in several windows are joined at last.
    """
    offsets, data = _buffers(text)
    first, last = first.to_numpy(zero_copy_only=False), last.to_numpy(zero_copy_only=False)
    rows: list[np.ndarray] = []
    pieces: list[list[pa.Array]] = [[], [], []]
    at, row, done = int(offsets[0]), 0, 0  # done: units of the row at hand in the windows before
    while at < offsets[-1]:
        end = min(at + window, int(offsets[-1]))
        while end < offsets[-1] and data[end] & 0xC0 == 0x80:
            end += 1
        # the texts with bytes in this window, and where each of their parts starts
        row = int(np.searchsorted(offsets, at, side="right")) - 1
        stop = int(np.searchsorted(offsets, end, side="left"))
        here = np.arange(row, stop)[offsets[row + 1:stop + 1] > np.maximum(offsets[row:stop], at)]
        starts = np.maximum(offsets[here], at)
        units, lists = _lists(data[at:end], starts - at)
        counts = np.diff(lists.offsets.to_numpy())
        base = np.zeros(len(here), dtype=np.int64)
        base[0] = done if offsets[here[0]] < at else 0
        flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
        begun = pa.array(base - lists.offsets.to_numpy()[:-1])
        ordinals = pc.add(pa.array(np.arange(len(units))), pc.take(begun, parents))
        in_prefix = pc.less(ordinals, pc.take(pa.array(first[here]), parents))
        in_suffix = pc.greater_equal(ordinals, pc.take(pa.array(last[here]), parents))
        for role, mask in enumerate((in_prefix, pc.invert(pc.or_(in_prefix, in_suffix)), in_suffix)):
            kept = pc.filter(parents, mask)
            sizes = np.bincount(kept.to_numpy(), minlength=len(here))
            rebuilt = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pc.filter(flat, mask))
            pieces[role].append(pc.binary_join(rebuilt, ""))
        rows.append(here)
        done = int(base[-1] + counts[-1])
        at = end
    owner = np.concatenate(rows) if rows else np.empty(0, dtype=np.int64)
    joints = pa.array(np.searchsorted(owner, np.arange(len(text) + 1)).astype(np.int32))
    return tuple(pc.binary_join(pa.ListArray.from_arrays(joints, pa.concat_arrays(x) if x else pa.array([], pa.string())), "") for x in pieces)


def _buffers(text: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Where each text starts in the array's bytes, with the end of the last, and these bytes."""
    if not len(text):
        return np.zeros(1, dtype=np.int64), np.empty(0, dtype=np.uint8)
    _, offsets, data = text.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int32)[text.offset:text.offset + len(text) + 1].astype(np.int64)
    return offsets, np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)


def _lists(data: np.ndarray, starts: np.ndarray) -> tuple[pa.StringArray, pa.ListArray]:
    """The code points of some bytes, one a row, and lists of them that begin at ``starts``."""
    begins = (data & 0xC0) != 0x80
    begins[starts] = True
    heads = np.flatnonzero(begins)
    ends = np.append(heads, len(data)).astype(np.int32)
    units = pa.StringArray.from_buffers(len(heads), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data)))
    bounds = np.append(np.searchsorted(heads, starts), len(heads)).astype(np.int32)
    return units, pa.ListArray.from_arrays(pa.array(bounds), units)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of ``transform`` was made from.

    The markers are in no text that is cut, and no piece can make one up at its edge, so they tell the pieces apart.
    """
    pieces = F.split(output, "<[PSM]>", -1)
    return F.when(form == "psm", F.concat(F.get(pieces, F.lit(1)), F.get(pieces, F.lit(3)), F.get(pieces, F.lit(2)))).when(
        form == "spm", F.concat(F.get(pieces, F.lit(2)), F.get(pieces, F.lit(3)), F.get(pieces, F.lit(1)))).otherwise(output)
