"""WARC archives: written by tasks, read back by chains of record boundaries."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.session import cut

#: Fixed values of the format: what opens a record, the version that is written, those that are read, and what ends a header line, a header and a record.
MAGIC, CRLF = "WARC/1.", "\r\n"
VERSION, VERSIONS = "0" + CRLF, r"\A[01]\r\n"
RECORD_END = CRLF + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads of fewer bytes are stored every time.
SHARED_BYTES = 100


def records(pages: DataFrame, *, id: str = "page_id", url: str = "url", html: str = "html", date: str = "2024-01-01T00:00:00Z",
            shared_bytes: int = SHARED_BYTES) -> DataFrame:
    """One row (record) per page: a response with its payload, or a revisit without, header and body.

    Of equal payloads of at least ``shared_bytes`` the page with the smallest id is the response. Null html is
    an empty payload; pages without id, and further pages with the response's id, are responses of their own.
    Line breaks in URLs are taken out of the header.
    """
    body = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(id).cast("long").alias("id"), F.regexp_replace(F.coalesce(F.col(url), F.lit("")), "[\r\n]", "").alias("url"),
                        body.alias("html"), F.octet_length(body).cast("long").alias("bytes"), F.sha2(body, 256).alias("digest"))
    # only payloads that several pages share, as a table of known size: where it is small, the pages need no shuffle
    first = rows.filter(F.col("bytes") >= shared_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = cut(first.filter("n > 1").drop("n"))
    rows = rows.join(first, "digest", "left")
    again = (F.col("bytes") >= shared_bytes) & (F.col("id") > F.col("first"))
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(">"))

    def line(key: str, value: Column) -> Column:
        return F.concat(F.lit(key + ": "), value, F.lit(CRLF))

    head = [F.lit(MAGIC + VERSION), line("WARC-Type", F.when(again, "revisit").otherwise("response")), line("WARC-Record-ID", name),
            line("WARC-Date", F.lit(date)), line("WARC-Target-URI", F.col("url")),
            line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            F.when(again, F.concat(line("WARC-Profile", F.lit(PROFILE)),
                                   line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))))).otherwise(""),
            line("Content-Type", F.lit("text/html; charset=utf-8")),
            line("Content-Length", F.when(again, F.lit(0)).otherwise(F.col("bytes")).cast("string")), F.lit(CRLF)]
    return rows.select(F.concat(*head, F.when(again, "").otherwise(F.col("html"))).alias("record"))


def write(pages: DataFrame, path: str, **names) -> None:
    """Archives below path, one a task: records one after the other, each ended by two line breaks."""
    records(pages, **names).write.option("lineSep", RECORD_END).option("compression", "none").text(path)


def chunks(spark: SparkSession, path: str) -> DataFrame:
    """The archives' bytes cut before every magic, in rows (file, block, at, size, chunk); block: the split's start.

    Spark's reader cuts the files at the magic, whatever splits they are read in; a first pass adds
    up each split's bytes, which gives every split the place at which it starts. ``at`` is where the magic
    stands. Bytes before a file's first magic make up a chunk at -1 place or less, which no chain reaches.
    """
    read = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value"))
    sizes = read.groupBy("file", "block").agg((F.sum(F.octet_length("value")) + F.count(F.lit(1)) * len(MAGIC)).alias("n"))
    upto = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut(sizes.select("file", "block", F.coalesce(F.sum("n").over(upto), F.lit(0).cast("long")).alias("start")))
    placed = read.mapInArrow(_placed, "file string, block long, ahead long, chunk string")
    # the reader drops the magic, so a chunk's own one stands right before it: at the end of the chunk ahead
    return placed.join(starts, ["file", "block"]).select(
        "file", "block", (F.col("start") + F.col("ahead") - len(MAGIC)).alias("at"), F.octet_length("chunk").cast("long").alias("size"), "chunk")


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes of the split ahead of each of its rows."""
    where, ahead = None, 0
    for batch in batches:
        out = []
        sizes = pa.compute.binary_length(batch.column(2).cast(pa.binary())).to_pylist()
        for file, block, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), sizes):
            if (file, block) != where:
                where, ahead = (file, block), 0
            out.append(ahead)
            ahead += size + len(MAGIC)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.int64()), batch.column(2)],
                                         names=["file", "block", "ahead", "chunk"])


def candidates(parts: DataFrame) -> DataFrame:
    """Rows (file, block, at, next) of every magic: where its record's successor would stand, if its header says so.

    A magic of an unknown version, without a whole header, or with a length that is no number, has no successor.
    """
    head = F.substring_index("chunk", RECORD_END, 1)
    length = F.regexp_extract(head, r"(?i)(?:^|\r\n)Content-Length:[ \t]*([0-9]{1,18})[ \t]*(?:\r\n|$)", 1)
    size = F.when(F.col("chunk").rlike(VERSIONS) & F.contains("chunk", F.lit(RECORD_END)) & (length != ""), length.cast("long"))
    after = F.col("at") + len(MAGIC) + F.octet_length(head) + len(RECORD_END) + size + len(RECORD_END)
    return parts.filter("at >= 0").select("file", "block", "at", after.alias("next"))


def _exits(rows):
    """For every candidate of one split the first place outside the split's candidates that its chain leads to."""
    rows = rows.sort_values("at", ascending=False)
    known = set(rows["at"])
    exits: dict[int, int | None] = {}
    for at, after in zip(rows["at"], rows["next"]):
        after = None if after is None or after != after else int(after)
        exits[at] = exits[after] if after in known and after > at else after
    out = rows[["file", "at"]].copy()
    out["next"] = [exits[x] for x in rows["at"]]
    return out.astype({"next": "Int64"})


def _walked(rows):
    """The candidates of one split that its marked ones reach."""
    after = dict(zip(rows["at"], rows["next"]))
    found: set[int] = set()
    for at in rows.loc[rows["entered"].fillna(False).astype(bool), "at"]:
        while at in after and at not in found:
            found.add(at)
            at = after[at]
    return rows.loc[rows["at"].isin(found), ["file", "at"]]


def reachable(marks: DataFrame) -> DataFrame:
    """Rows (file, at) of the candidates that a file's start reaches, by pointer jumping.

    Every task first follows the chains inside its split, so that a candidate points behind the split. Between
    splits pointers double their reach round by round, and what is reached hands the mark on to
    where its pointer leads; so the rounds are the logarithm of a file's splits. At last every task walks its
    split from the marked candidates. Candidates inside payloads are never reached, for true records step over them.
    """
    exits = cut(marks.groupBy("file", "block").applyInPandas(_exits, "file string, at long, next long"))
    entries = exits.select("file", F.col("next").alias("at")).filter("at IS NOT NULL").unionAll(exits.filter("at = 0").select("file", "at")).distinct()
    jump = cut(exits.join(entries, ["file", "at"], "left_semi"))
    known = jump.filter("at = 0").select("file", "at")
    while True:
        ahead = known.join(jump, ["file", "at"]).select("file", F.col("next").alias("at")).join(jump.select("file", "at"), ["file", "at"])
        fresh = cut(ahead.join(known, ["file", "at"], "left_anti").distinct())
        if fresh.isEmpty():
            break
        known = known.unionAll(fresh)
        far = jump.select("file", F.col("at").alias("next"), F.col("next").alias("to"))
        jump = cut(jump.join(far, ["file", "next"], "left").select("file", "at", F.coalesce("to", "next").alias("next")))
    entered = marks.join(known.withColumn("entered", F.lit(True)), ["file", "at"], "left")
    return entered.groupBy("file", "block").applyInPandas(_walked, "file string, at long")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, at, record_type, record_id, refers_to, url, digest, payload) of every true record.

    A record whose payload holds the magic spans several chunks; they are put together by place.
    Records of versions 1.0 and 1.1 are read. Empty archives give an empty result.
    """
    parts = chunks(spark, path)
    marks = cut(candidates(parts))
    true = reachable(marks)
    order = Window.partitionBy("file").orderBy("at")
    spans = marks.join(true.withColumn("reached", F.lit(True)), ["file", "at"], "left")
    spans = cut(spans.select("file", "at", "reached", F.last(F.when(F.col("reached"), F.col("at")), ignorenulls=True).over(order).alias("owner")))
    # the exceptions: chunks that are no record of their own, and the records they belong to
    inner = spans.filter("reached IS NULL")
    owners = inner.filter("owner IS NOT NULL").select("file", "owner").distinct()
    odd = cut(inner.select("file", "at", "owner").unionAll(owners.select("file", F.col("owner").alias("at"), "owner")))
    rows = parts.filter("at >= 0")
    single = rows.join(odd, ["file", "at"], "left_anti").select("file", "at", "chunk")
    several = rows.join(odd.filter("owner IS NOT NULL"), ["file", "at"]).groupBy("file", F.col("owner").alias("at")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "chunk"))), lambda x: x["chunk"]), MAGIC).alias("chunk"))
    whole = single.unionAll(several)
    head = F.substring_index("chunk", RECORD_END, 1)

    def field(name: str) -> Column:
        found = F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*?)[ \t]*(?:\r\n|$)", 1)
        return F.when(found != "", found)

    # cut by bytes: from behind the header to before the record's end
    body = F.expr(f"decode(substring(encode(chunk, 'utf-8'), octet_length(substring_index(chunk, '{CRLF}{CRLF}', 1)) + 5, "
                  f"octet_length(chunk) - octet_length(substring_index(chunk, '{CRLF}{CRLF}', 1)) - 8), 'utf-8')")
    return whole.select("file", "at", field("WARC-Type").alias("record_type"), field("WARC-Record-ID").alias("record_id"),
                        field("WARC-Refers-To").alias("refers_to"), field("WARC-Target-URI").alias("url"),
                        field("WARC-Payload-Digest").alias("digest"), body.alias("payload"))


def pages_of(found: DataFrame) -> DataFrame:
    """Rows page_id, payload_bytes, payload_digest, record_type, refers_to, verified of read records.

    A response's bytes and digest are taken from its payload, a revisit's from the response it names; ``verified``
    says that the digest in the header agrees.
    """
    def page(name: str) -> Column:
        return F.regexp_extract(name, "^<urn:page:(-?[0-9]+)>$", 1)

    rows = found.select(F.when(page("record_id") != "", page("record_id")).cast("long").alias("page_id"), "record_type",
                        F.when(page("refers_to") != "", page("refers_to")).cast("long").alias("refers_to"),
                        F.regexp_replace("digest", "^sha256:", "").alias("said"),
                        F.octet_length("payload").cast("long").alias("bytes"), F.sha2("payload", 256).alias("own"))
    rows = cut(rows)
    sources = rows.filter("record_type = 'response' AND page_id IS NOT NULL").groupBy(F.col("page_id").alias("refers_to"), F.col("own").alias("said")).agg(F.max("bytes").alias("source_bytes"))
    direct = rows.filter("record_type = 'response'").select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("own").alias("payload_digest"), "record_type", "refers_to",
        (F.col("own") == F.col("said")).alias("verified"))
    again = rows.filter("record_type = 'revisit'").join(sources, ["refers_to", "said"], "left").select(
        "page_id", F.col("source_bytes").alias("payload_bytes"), F.col("said").alias("payload_digest"), "record_type", "refers_to",
        F.col("source_bytes").isNotNull().alias("verified"))
    return direct.unionAll(again)
