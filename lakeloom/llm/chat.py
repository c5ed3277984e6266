"""Chat turns of typed parts as training text: ordered placeholders, loss spans, reversible escapes."""

from __future__ import annotations

import hashlib
import math
import os
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A turn's content: text, or an attachment with its reference, its measures and the text that stood in its place.
PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"
ATTACHMENTS = ("image", "audio", "document", "other")
#: The template: a turn is its role and its content between these, a placeholder is an attachment's kind and its number in the turn.
TURN, SAYS, END = "<turn>", "<says>", "</turn>\n"
CONTROL = re.compile(r"\\|<turn>|<says>|</turn>|<(?:image|audio|document|other):")
MARKS = re.compile(rf"\\.|<turn>|<says>|</turn>\n|<({'|'.join(ATTACHMENTS)}):[0-9]+>", re.S)
ESCAPED = re.compile(r"\\(.)", re.S)
#: Links to files in Markdown, by the file's ending.
LINK = r"!?\[[^\]\n]*\]\([^()\s]+\.(?i:png|jpe?g|gif|webp|wav|mp3|flac|ogg|pdf|docx?|odt)\)"
ENDINGS = {"image": "png|jpe?g|gif|webp", "audio": "wav|mp3|flac|ogg", "document": "pdf|docx?|odt"}
#: Code points after which a row of the output is closed; a turn is never cut.
CHUNK = 1 << 20

_ATTACHMENT = pa.struct([("turn", pa.int32()), ("number", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("text", pa.string()),
                         ("at", pa.int32()), ("tokens", pa.int64())])
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_CHUNKS = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("text", pa.string()), ("loss", pa.list_(_SPAN)),
                     ("attachments", pa.list_(_ATTACHMENT)), ("n_turns", pa.int32()), ("n_tokens", pa.int64())])
CHUNKS = ("conv_id long, chunk long, text string, loss array<struct<start: int, end: int>>, attachments array<struct<turn: int, number: int, "
          "kind: string, ref: string, text: string, at: int, tokens: long>>, n_turns int, n_tokens long")
_TURNS = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("turn", pa.int32()), ("role", pa.string()), ("text", pa.string()),
                    ("loss", pa.string()), ("formatted_chars", pa.int64()), ("n_attachments", pa.int32())])
TURNS = "conv_id long, chunk long, turn int, role string, text string, loss string, formatted_chars long, n_attachments int"
_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                      ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_attachments", pa.int64())])
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_attachments long")


@dataclass(frozen=True)
class Expansion:
    """Tokens that a placeholder stands for once a model's encoders have run; ``unknown`` where a measure is missing."""

    patch: int = 28
    audio_rate: float = 25.0
    page: int = 512
    unknown: int = 256

    def image(self, width: int | None, height: int | None) -> int:
        return self.unknown if width is None or height is None else math.ceil(max(width, 0) / self.patch) * math.ceil(max(height, 0) / self.patch)

    def audio(self, seconds: float | None) -> int:
        return self.unknown if seconds is None or not math.isfinite(seconds) else math.ceil(max(seconds, 0) * self.audio_rate)

    def document(self, pages: int | None) -> int:
        return self.unknown if pages is None else max(pages, 0) * self.page


def escape(text: str) -> str:
    """A backslash before every backslash and control string, so that no control string is left unmarked."""
    return CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


class Flattener:
    """Visitor of one turn's parts: formatted pieces, loss spans (in the turn), attachments and their tokens, in order."""

    def __init__(self, expansion: Expansion, learned: bool):
        self.expansion, self.learned = expansion, learned
        self.pieces: list[str] = []
        self.loss: list[list[int]] = []
        self.attachments: list[dict] = []
        self.size = 0

    def visit(self, part: dict) -> None:
        kind = part["kind"]
        {"text": self.visit_text, "image": self.visit_image, "audio": self.visit_audio, "document": self.visit_document}.get(kind, self.visit_other)(part)

    def add(self, piece: str) -> None:
        self.pieces.append(piece)
        self.size += len(piece)

    def visit_text(self, part: dict) -> None:
        start = self.size
        self.add(escape(part["text"] or ""))
        if self.learned and self.size > start:
            if self.loss and self.loss[-1][1] == start:
                self.loss[-1][1] = self.size
            else:
                self.loss.append([start, self.size])

    def visit_image(self, part: dict) -> None:
        self.attach("image", part, self.expansion.image(part["width"], part["height"]))

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, self.expansion.audio(part["seconds"]))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, self.expansion.document(part["pages"]))

    def visit_other(self, part: dict) -> None:
        self.attach("other", part, self.expansion.unknown)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        number = len(self.attachments) + 1
        self.attachments.append({"number": number, "kind": kind, "ref": part["ref"], "text": part["text"] or "", "at": self.size, "tokens": tokens})
        self.add(f"<{kind}:{number}>")


def text_parts(text: Column) -> Column:
    """Content that is one text; a null text is empty."""
    return F.array(_part(F.lit("text"), F.coalesce(text, F.lit(""))))


def linked_parts(text: Column) -> Column:
    """Content of a text whose Markdown links to image, audio and document files become parts; the rest stays text.

    An attachment keeps its link as it stood, so the text can be put together again; measures are unknown.
    """
    text = F.coalesce(text, F.lit(""))
    between, links = F.split(text, LINK, -1), F.regexp_extract_all(text, F.lit(LINK), F.lit(0))

    def of(link: Column) -> Column:
        ref = F.regexp_extract(link, r"\(([^()]*)\)$", 1)
        kind = F.lit("other")
        for name, endings in ENDINGS.items():
            kind = F.when(F.lower(ref).rlike(rf"\.({endings})$"), name).otherwise(kind)
        return _part(kind, link, ref)

    both = F.flatten(F.transform(between, lambda piece, i: F.array(
        F.when((piece != "") | (F.size(between) == 1), _part(F.lit("text"), piece)), F.when(i < F.size(links), of(F.get(links, i))))))
    return F.filter(both, lambda part: part.isNotNull())


def _part(kind: Column, text: Column, ref: Column | None = None) -> Column:
    none = lambda t: F.lit(None).cast(t)
    return F.struct(kind.alias("kind"), text.alias("text"), (none("string") if ref is None else ref).alias("ref"), none("int").alias("width"),
                    none("int").alias("height"), none("double").alias("seconds"), none("int").alias("pages")).cast(PART)


def format_turns(messages: DataFrame, content: Column, *, id: str = "conv_id", turn: str = "turn", role: str = "role",
                 loss_roles: Sequence[str] = ("assistant",), tokenizer: str | None = None, expansion: Expansion = Expansion(), chunk: int = CHUNK) -> DataFrame:
    """Rows (conv_id, chunk, text, loss, attachments, n_turns, n_tokens): conversations as text, in chunks of whole turns.

    ``content`` is an array of PART; parts of an unknown kind become ``other``, null parts and null content
    nothing. ``loss`` holds the code points of the text of turns whose role is learned, without marks and placeholders;
    ``attachments`` the references in order, each with its turn in the chunk, the place of its placeholder and its
    expanded tokens. ``n_tokens`` counts the chunk with every placeholder at its expanded size; without a tokenizer file
    text counts a token a UTF-8 byte.

    Turns stand in the order of (turn, role, content), nulls first; repeated rows are turns of their own. A null role is
    empty, a null id a conversation of its own; other columns are ignored, whatever their names; no rows give no rows. Rows are
    dealt out by ranges of that order, so a conversation of any size is spread over tasks, and tasks hold one chunk at a time;
    ``chunk`` numbers ascend along a conversation.
    """
    rows = messages.select(F.col(id).cast("long").alias("c"), F.col(turn).cast("long").alias("t"), F.coalesce(F.col(role), F.lit("")).alias("r"),
                           F.coalesce(content.cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>")).alias("p"))
    rows = rows.repartitionByRange("c", "t", "r", F.hash("p")).sortWithinPartitions("c", "t", "r", F.hash("p"), "p")
    return rows.select("c", "r", "p").mapInArrow(_writer(frozenset(loss_roles), tokenizer, expansion, chunk), CHUNKS)


def _counter(tokenizer: str | None):
    """Tokens of each of several texts, special strings in them being ordinary text."""
    if tokenizer is None:
        return lambda texts: [len(x.encode("utf-8", "surrogatepass")) for x in texts]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer)
    library.encode_special_tokens = True
    return lambda texts: [len(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


def _writer(learned: frozenset[str], tokenizer: str | None, expansion: Expansion, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer)
        number = TaskContext.get().partitionId() << 33
        open_: dict | None = None

        def closed():
            nonlocal open_, number
            row, open_ = open_, None
            row["text"] = "".join(row["text"])
            row["chunk"] = number
            number += 1
            del row["size"]
            return row

        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                rows, turns = batch.slice(low, 256), []
                for conv, role, parts in zip(*(rows.column(i).to_pylist() for i in range(3))):
                    flat = Flattener(expansion, role in learned)
                    for part in parts:
                        if part is not None:
                            flat.visit(part)
                    turns.append((conv, TURN + escape(role) + SAYS, flat))
                # text between placeholders is counted as it stands, all of these turns' at once
                runs: list[list[str]] = [[]]
                ends = []
                for _, head, flat in turns:
                    runs[-1].append(head)
                    holders = {x["at"] for x in flat.attachments}
                    at = 0
                    for piece in flat.pieces:
                        if at in holders and piece[:1] == "<":
                            runs.append([])
                        else:
                            runs[-1].append(piece)
                        at += len(piece)
                    runs[-1].append(END)
                    ends.append(len(runs))
                    runs.append([])
                sizes = count(["".join(x) for x in runs])
                out, first = [], 0
                for (conv, head, flat), end in zip(turns, ends):
                    if open_ is not None and (open_["conv_id"] != conv or open_["size"] >= most):
                        out.append(closed())
                    if open_ is None:
                        open_ = {"conv_id": conv, "text": [], "loss": [], "attachments": [], "n_turns": 0, "n_tokens": 0, "size": 0}
                    base = open_["size"] + len(head)
                    open_["text"] += [head, *flat.pieces, END]
                    open_["loss"] += [{"start": base + a, "end": base + b} for a, b in flat.loss]
                    open_["attachments"] += [{**x, "turn": open_["n_turns"], "at": base + x["at"]} for x in flat.attachments]
                    open_["n_turns"] += 1
                    open_["n_tokens"] += sum(sizes[first:end]) + sum(x["tokens"] for x in flat.attachments)
                    open_["size"] = base + flat.size + len(END)
                    first = end
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_CHUNKS)
        if open_ is not None:
            yield pa.RecordBatch.from_pylist([closed()], schema=_CHUNKS)
    return run


def read_turns(spark: SparkSession, path: str) -> DataFrame:
    """Rows (conv_id, chunk, turn, role, text, loss, formatted_chars, n_attachments) of every turn in the files below path.

    ``turn`` counts inside the chunk. ``text`` is the content with the attachments' own texts in their places, ``loss`` what the
    spans cover, both without escapes; ``formatted_chars`` the code points that the turn takes. A chunk that does not follow the
    template is an error.
    """
    return spark.read.schema(CHUNKS).parquet(path).select("conv_id", "chunk", "text", "loss", "attachments").mapInArrow(_parsed, TURNS)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, batch.num_rows, 16):
            out = []
            for conv, chunk, text, loss, attachments in zip(*(batch.slice(low, 16).column(i).to_pylist() for i in range(5))):
                for i, (role, body, span, start, end, n) in enumerate(turns_of(text, loss or [], attachments or [])):
                    out.append({"conv_id": conv, "chunk": chunk, "turn": i, "role": role, "text": body, "loss": span,
                                "formatted_chars": end - start, "n_attachments": n})
            yield pa.RecordBatch.from_pylist(out, schema=_TURNS)


def turns_of(text: str, loss: Sequence[dict], attachments: Sequence[dict]) -> Iterator[tuple[str, str, str, int, int, int]]:
    """Role, content, learned text, start, end and number of attachments of each turn of a formatted text."""
    spans, held = iter([*loss, None]), iter(attachments)
    span = next(spans)
    at = said = start = 0
    role, pieces, n, inside = None, [], 0, False
    for mark in MARKS.finditer(text):
        if mark[0][0] == "\\":
            continue
        if mark[0] == TURN and role is None and mark.start() == start:
            role, said = "", mark.end()
        elif mark[0] == SAYS and role is not None and not inside:
            role, at, inside = unescape(text[said:mark.start()]), mark.end(), True
        elif mark[1] and inside:
            pieces += [unescape(text[at:mark.start()]), next(held)["text"]]
            at, n = mark.end(), n + 1
        elif mark[0] == END and inside:
            pieces.append(unescape(text[at:mark.start()]))
            learned = []
            while span is not None and span["end"] <= mark.start():
                learned.append(unescape(text[span["start"]:span["end"]]))
                span = next(spans)
            yield role, "".join(pieces), "".join(learned), start, mark.end(), n
            role, pieces, n, inside, start = None, [], 0, False, mark.end()
        else:
            raise ValueError(f"{mark[0]!r} at {mark.start()} does not follow the template")
    if start != len(text):
        raise ValueError(f"the turn at {start} does not end")


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation of read turns: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_attachments.

    ``turns_sha256`` digests role, line break, text, line break of every turn, ``loss_sha256`` all learned text, both in order. A
    digest needs a conversation's bytes one after the other: they stream through one task, which holds a turn at a time.
    """
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "chunk", "turn")
    return ordered.select("conv_id", "role", "text", "loss", "formatted_chars", "n_attachments").mapInArrow(_digested, DIGESTS)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, begun = None, False
    turns = loss = sums = None
    done: list[dict] = []

    def closed() -> dict:
        return {"conv_id": now, "n_turns": sums[0], "turns_sha256": turns.hexdigest(), "loss_chars": sums[1], "loss_sha256": loss.hexdigest(),
                "formatted_chars": sums[2], "n_attachments": sums[3]}

    for batch in batches:
        for conv, role, text, learned, size, n in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if not begun or conv != now:
                if begun:
                    done.append(closed())
                now, begun, turns, loss, sums = conv, True, hashlib.sha256(), hashlib.sha256(), [0, 0, 0, 0]
            turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            loss.update(learned.encode("utf-8", "surrogatepass"))
            sums = [sums[0] + 1, sums[1] + len(learned), sums[2] + size, sums[3] + n]
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_DIGESTS)
            done = []
    if begun:
        yield pa.RecordBatch.from_pylist([closed()], schema=_DIGESTS)
