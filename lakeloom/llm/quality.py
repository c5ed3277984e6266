"""Quality rules: measures of each text, and lines that too many documents of one host share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.session import cut

#: What separates words, and the characters counted as symbols.
BLANKS = " \t\n\x0b\f\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MIN_WORDS = 50
REPEAT_PERCENT = 50
#: A line goes where more documents of its host hold it than this, whatever the host's size.
LINE_DOCS = 20
#: A document is depleted when less than this share of its words is left.
LEFT_SHARE = 0.5


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def _repeat_words(words: Column, n: Column) -> Column:
    """Words inside three-word windows that occur twice or more, each word counted once.

    Every window becomes one long: its hash above, its place below in as many bits as the text needs.
    The sorted longs put equal windows side by side; equal hashes are confirmed on the words.
    """
    low = F.coalesce(F.pow(F.lit(2.0), F.ceil(F.log2(n + F.lit(1)))).cast("long"), F.lit(1).cast("long")) - 1

    def window(i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    packed = F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), lambda i: window(i).bitwiseAND(
        F.bitwise_not(low)).bitwiseOR(i.cast("long"))))

    def place(x: Column) -> Column:
        return x.bitwiseAND(low).cast("int")

    def same(x: Column, y: Column) -> Column:
        a, b = place(x), place(y)
        texts = [F.get(words, a + k) == F.get(words, b + k) for k in range(3)]
        return F.coalesce((x.bitwiseXOR(y) <= low) & (x.bitwiseXOR(y) >= 0) & texts[0] & texts[1] & texts[2], F.lit(False))

    def repeated(sorted_: Column) -> Column:
        return F.filter(sorted_, lambda x, j: same(x, F.get(sorted_, j + 1)) | same(x, F.get(sorted_, j - 1)))

    def covered(x: Column) -> Column:
        return F.array(place(x), place(x) + 1, place(x) + 2)

    # held as a one-element array, so that the sorted longs are built once a row
    hits = F.flatten(F.transform(F.array(packed), repeated))
    return F.when(n < 4, F.lit(0)).otherwise(F.size(F.array_distinct(F.flatten(F.transform(hits, covered)))))


def normalised_lines(text: Column) -> Column:
    """Lines with A-Z lowered, digit runs as 0, blank runs as one blank, trimmed; empty ones stay as ''."""
    plain = F.regexp_replace(F.regexp_replace(F.translate(text, UPPER, LOWER), "[0-9]+", "0"), r"[\x20\x09\x0B-\x0D]+", " ")
    return F.transform(F.split(plain, "\n"), lambda x: F.trim(x))


def measures(docs: DataFrame, *, id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per input row: its measures, its host, a hash of its text, and its lines as (hash, words).

    Null text counts as empty, a null host as the host ''.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
                       body.alias("text"))
    rows = rows.select("doc_id", "host", "text", _words(F.col("text")).alias("words"),
                       F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("lines"),
                       F.filter(normalised_lines(F.col("text")), lambda x: x != "").alias("plain"))
    n = F.size("words")
    return rows.select(
        "doc_id", "host", F.xxhash64("text", F.lit("text")).alias("text_hash"),
        n.cast("long").alias("n_words"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words"), n).cast("long").alias("n_repeat_words"),
        F.transform("plain", lambda x: F.struct(
            F.xxhash64(x).alias("h"), (F.length(x) - F.length(F.translate(x, " ", "")) + 1).alias("w"))).alias("lines"))


def frequent_lines(measured: DataFrame, line_docs: int = LINE_DOCS) -> DataFrame:
    """Rows (host, text_hash, frequent): the hashes of a text's lines that more than ``line_docs`` texts of its host hold.

    Documents with equal text count once, so copies do not make a line frequent.
    """
    texts = measured.select("host", "text_hash", F.explode(F.array_distinct(F.transform("lines", lambda x: x["h"]))).alias("h"))
    texts = texts.distinct()
    above = texts.groupBy("host", "h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > line_docs).select("host", "h")
    return texts.join(above, ["host", "h"]).groupBy("host", "text_hash").agg(F.collect_set("h").alias("frequent"))


def judge(docs: DataFrame, *, id: str = "doc_id", text: str = "text", host: str = "source", min_words: int = MIN_WORDS,
          repeat_percent: int = REPEAT_PERCENT, line_docs: int = LINE_DOCS,
          left_share: float = LEFT_SHARE) -> DataFrame:
    """One row per input row: id, measures, base_failed, left_words (words outside frequent lines), kept,
    and for the rewriting of texts host, text_hash and frequent (hashes of the lines that go, or null).

    A document is dropped if it has under ``min_words`` words, if more than ``repeat_percent`` of its words
    lie in repeated three-word windows, or if less than ``left_share`` of its words is left without frequent
    lines. Repeated rows are judged alike; an empty table gives an empty result; other columns are ignored.
    """
    measured = cut(measures(docs, id=id, text=text, host=host))
    found = frequent_lines(measured, line_docs)
    gone = F.coalesce(F.aggregate(
        F.filter("lines", lambda x: F.array_contains("frequent", x["h"])), F.lit(0), lambda s, x: s + x["w"]), F.lit(0))
    rows = measured.join(found, ["host", "text_hash"], "left").withColumn("left_words", F.col("n_words") - gone)
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * repeat_percent)
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & (F.col("left_words") >= F.col("n_words") * left_share)).alias("kept"),
        "left_words", "host", "text_hash", "frequent")


def clean(docs: DataFrame, *, text: str = "text", host: str = "source", id: str = "doc_id", **limits) -> DataFrame:
    """The kept rows with all their columns, frequent lines cut from the text."""
    verdicts = judge(docs, id=id, text=text, host=host, **limits).filter("kept")
    verdicts = verdicts.groupBy("host", "text_hash").agg(F.first("frequent").alias("__frequent")).select(
        F.col("host").alias("__host"), F.col("text_hash").alias("__hash"), "__frequent")
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumns({"__host": F.coalesce(F.col(host).cast("string"), F.lit("")),
                             "__hash": F.xxhash64(body, F.lit("text"))}).join(verdicts, ["__host", "__hash"])
    pairs = F.arrays_zip(F.split(body, "\n").alias("line"), normalised_lines(body).alias("plain"))
    left = F.filter(pairs, lambda x: ~F.array_contains("__frequent", F.xxhash64(x["plain"])))
    rewritten = F.when(F.col("__frequent").isNull(), F.col(text)).otherwise(
        F.array_join(F.transform(left, lambda x: x["line"]), "\n"))
    return rows.select(*[rewritten.alias(c) if c == text else F.col(c) for c in docs.columns])
