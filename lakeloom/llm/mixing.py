"""Sources mixed to target weights down a domain-language-source tree, with seeded epochs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.operators.ordered import attach
from lakeloom.session import cut

LEVELS = ("domain", "lang", "source")
#: A leaf may be read this often at most.
MAX_EPOCHS = 4
#: Documents of a leaf are ordered by hash; sums are first made for this many hash ranges of each leaf and epoch.
RANGES = 4096


def poured(children: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Children with (weight, room) and their parent's ``given``, plus ``budget``.

    A parent's tokens go to its children by weight; a child gets no more than its room, and what it cannot
    take goes to its siblings by their weights, until all rooms are full. In closed form: in order of
    room / weight, a child is full if its share of what the children before it left is more than its room.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("room") / F.col("weight"), *[c for c in LEVELS if c in children.columns])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    left = F.col("given") - F.coalesce(F.sum("room").over(before), F.lit(0.0))
    weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = children.withColumn("level", F.greatest(F.lit(0.0), left) / weight)
    full = level.withColumn("full", F.col("level") * F.col("weight") >= F.col("room"))
    # the first child that is not full sets the level of all that follow
    set_ = F.min(F.when(~F.col("full"), F.struct((F.col("room") / F.col("weight")).alias("r"), "level"))).over(whole)["level"]
    full = full.withColumn("set", set_).withColumn("exact", F.when(F.col("set").isNull(), F.col("room")).otherwise(
        F.least("room", F.col("set") * F.col("weight"))))
    # whole tokens: what rounding down leaves goes to the largest remainders, so the children's budgets add up to the parent's
    down = F.floor(F.col("exact") + 1e-6)
    rank = F.row_number().over(whole.orderBy((F.col("exact") - F.floor(F.col("exact") + 1e-6)).desc(), *[c for c in LEVELS if c in children.columns]))
    spare = F.least(F.col("given"), F.sum("room").over(whole)) - F.sum(down).over(whole)
    return full.withColumns({"rank": rank, "spare": spare, "down": down}).withColumn(
        "budget", (F.col("down") + F.when(F.col("rank") <= F.round("spare"), 1).otherwise(0)).cast("double")).drop(
        "level", "full", "set", "exact", "rank", "spare", "down")


def budgets(leaves: DataFrame, total: float | None = None, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Leaves (domain, lang, source, tokens, weight) plus ``budget``, a whole number of tokens.

    ``weight`` counts among siblings: a node's weight is the sum of its leaves' weights. The total (all
    tokens there are, if not given) is poured down the tree. Every node's room is ``max_epochs`` times the
    tokens below it, so a shortage is made up by siblings first, and by the parent's siblings only where
    those are full as well. If the whole tree cannot take the total, every leaf gets its room.
    Leaves without tokens or weight get nothing.
    """
    live = leaves.filter("tokens > 0 AND weight > 0").select(
        *LEVELS, "tokens", F.col("weight").cast("double").alias("weight"), (F.col("tokens") * float(max_epochs)).alias("room"))
    if total is None:
        total = live.agg(F.sum("tokens")).first()[0] or 0
    total = int(round(total))
    given = None
    for depth in range(1, len(LEVELS) + 1):
        here = LEVELS[:depth]
        nodes = live.groupBy(*here).agg(F.sum("weight").alias("weight"), F.sum("room").alias("room"))
        if given is None:
            nodes = nodes.withColumn("given", F.lit(float(total)))
            given = poured(nodes.withColumn("root", F.lit(0)), ["root"])
        else:
            above = given.select(*[F.col(c).alias(f"up_{c}") for c in here[:-1]], F.col("budget").alias("given"))
            same = [nodes[c].eqNullSafe(above[f"up_{c}"]) for c in here[:-1]]
            given = poured(nodes.join(above, same).select(*here, "weight", "room", "given"), here[:-1])
        given = given.select(*here, "budget")
    return live.select(*LEVELS, "tokens").join(
        given.select(*[F.col(c).alias(f"up_{c}") for c in LEVELS], F.round("budget").cast("long").alias("budget")),
        [F.col(c).eqNullSafe(F.col(f"up_{c}")) for c in LEVELS]).select(*LEVELS, "tokens", "budget")


def _last_epoch(docs: DataFrame, allotted: DataFrame, seed: int, tokens: Column, order: Column, ranges: int) -> tuple[DataFrame, DataFrame]:
    """Rows of docs that a budget reaches with how they stand in it, and what the hash ranges of each leaf's last epoch hold.

    Rows: ``docs.*`` (with __n tokens, __key), the leaf, whole epochs, tokens left for the last one, hash and range. Ranges: of_* leaf, of_range,
    the tokens before it and in it.
    """
    leaf = allotted.select(*[F.col(c).alias(f"up_{c}") for c in LEVELS], F.col("tokens").alias("held"), "budget")
    same = [F.col(f"docs.{c}").eqNullSafe(F.col(f"up_{c}")) for c in LEVELS]
    row = docs.withColumns({"__n": tokens.cast("long"), "__key": order}).filter("__n > 0").alias("docs").join(leaf, same)
    row = row.withColumns({"whole": F.floor(F.col("budget") / F.col("held")), "rest": F.col("budget") % F.col("held")})
    last = row.filter("rest > 0").withColumn("h", _hash(seed, F.col("whole"), F.col("__key"))).withColumn("range", _range(F.col("h"), ranges))
    ups = [f"up_{c}" for c in LEVELS]
    sums = last.groupBy(*ups, "range").agg(F.sum("docs.__n").alias("n"))
    upto = Window.partitionBy(*ups).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*[F.col(c).alias(f"of_{c}") for c in ups], F.col("range").alias("of_range"),
                       F.coalesce(F.sum("n").over(upto), F.lit(0).cast("long")).alias("base"), F.col("n").alias("range_n"))
    return row, cut(sums)


def _hash(seed: int, epoch: Column, key: Column) -> Column:
    return F.xxhash64(F.lit(seed), epoch.cast("long"), key)


def _range(h: Column, ranges: int) -> Column:
    return F.shiftrightunsigned(h, 64 - (ranges - 1).bit_length()).cast("int") if ranges > 1 else F.lit(0)


def _met(rows: DataFrame, sums: DataFrame, seed: int, ranges: int) -> DataFrame:
    """The last epoch's rows beside the sums of their range."""
    last = rows.filter("rest > 0").withColumn("h", _hash(seed, F.col("whole"), F.col("__key"))).withColumn("range", _range(F.col("h"), ranges))
    ups = [f"up_{c}" for c in LEVELS]
    return last.join(sums, [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in ups] + [F.col("range") == F.col("of_range")])


def chosen(docs: DataFrame, allotted: DataFrame, *, seed: int, tokens: Column, order: Column, ranges: int = RANGES) -> DataFrame:
    """The rows of docs (with the LEVELS) that the budgets pay for, plus ``epoch`` and ``take``.

    A leaf's tokens are read in epochs, each in an order of its own that seed and epoch decide, and the
    budget buys a prefix of that sequence: ``take`` tokens of a row, all but the last row's in full. Whole
    epochs need no order. In the last one, sums over hash ranges say which range holds the end; only rows
    of that range are ordered.
    """
    body = [F.col(f"docs.{c}") for c in docs.columns]
    row, sums = _last_epoch(docs, allotted, seed, tokens, order, ranges)
    full = row.filter("whole > 0").select(*body, F.explode(F.sequence(F.lit(0), (F.col("whole") - 1).cast("int"))).alias("epoch"),
                                          F.col("docs.__n").alias("take"))
    ups = [f"up_{c}" for c in LEVELS]
    placed = _met(row, sums, seed, ranges).filter("base < rest")
    keep = [*body, F.col("whole").cast("int").alias("epoch")]
    inside = placed.filter("base + range_n <= rest").select(*keep, F.col("docs.__n").alias("take"))
    within = Window.partitionBy(*ups, "range").orderBy("h", "__key").rowsBetween(Window.unboundedPreceding, -1)
    end = placed.filter("base + range_n > rest").withColumn("at", F.col("base") + F.coalesce(F.sum("docs.__n").over(within), F.lit(0)))
    end = end.filter("at < rest").select(*keep, F.least(F.col("docs.__n"), F.col("rest") - F.col("at")).alias("take"))
    return full.unionAll(inside).unionAll(end)


def ends(docs: DataFrame, allotted: DataFrame, *, seed: int, tokens: Column, order: Column, ranges: int = RANGES) -> DataFrame:
    """A row per leaf: the LEVELS, whole epochs, and where the last one ends: its first range not taken whole, the hash and key of the last row
    taken there, how many rows with both are taken (``ties``) and how many there are (``tied``).
    """
    row, sums = _last_epoch(docs, allotted, seed, tokens, order, ranges)
    ups = [f"up_{c}" for c in LEVELS]
    leaves = allotted.filter("tokens > 0").select(*LEVELS, F.floor(F.col("budget") / F.col("tokens")).cast("int").alias("whole"), (F.col("budget") % F.col("tokens")).alias("rest"))
    same = [F.col(c).eqNullSafe(F.col(f"of_up_{c}")) for c in LEVELS]
    open_ = leaves.join(sums, same).filter("base + range_n > rest").groupBy(*LEVELS).agg(F.min("of_range").alias("range_end"))
    placed = _met(row, sums, seed, ranges).filter("base < rest AND base + range_n > rest")
    within = Window.partitionBy(*ups, "range").orderBy("h", "__key").rowsBetween(Window.unboundedPreceding, -1)
    end = placed.withColumn("at", F.col("base") + F.coalesce(F.sum("docs.__n").over(within), F.lit(0)))
    tied = end.groupBy(*ups, "h", "__key").agg(F.count_if(F.col("at") < F.col("rest")).alias("ties"), F.count(F.lit(1)).alias("tied")).filter("ties > 0")
    tied = tied.groupBy(*ups).agg(F.max(F.struct("h", F.col("__key").alias("key"), "ties", "tied")).alias("end")).select(*[F.col(c).alias(f"at_{c}") for c in ups], "end.*")
    found = attach(attach(leaves, open_, LEVELS), tied.toDF(*LEVELS, "h_end", "key_end", "ties", "tied"), LEVELS)
    return found.select(*LEVELS, "whole", "rest", "range_end", "h_end", "key_end", "ties", "tied")


def mix(docs: DataFrame, weight: Column, *, domain: Column, lang: str = "lang", source: str = "source", id: str = "doc_id",
        text: str = "text", total: float | None = None, max_epochs: int = MAX_EPOCHS, seed: int = 17) -> DataFrame:
    """Rows doc_id, domain, lang, source, tokens, epoch, take: what a mix to target weights reads.

    ``weight`` is an expression over domain, lang and source, ``domain`` one over the documents. Tokens are
    the words of the text. Null levels are nodes of their own; texts that are null or without a word have
    no tokens and are never taken; repeated rows are rows of their own, with one hash order, so their
    sequence is the same whichever comes first. A budget is met to the token unless the tree is full. Other columns are
    ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id).alias("doc_id"), domain.alias("domain"), F.col(lang).alias("lang"), F.col(source).alias("source"),
                       word_count(F.col(text)).alias("tokens"), F.xxhash64(text).alias("text_hash"))
    rows = cut(rows)  # words are counted once
    leaves = cut(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")).withColumn("weight", weight))
    allotted = cut(budgets(leaves, total, max_epochs))
    taken = chosen(rows, allotted, seed=seed, tokens=F.col("tokens"), order=F.xxhash64("doc_id", "text_hash"))
    return taken.drop("text_hash")


def word_count(text: Column) -> Column:
    """Words of a text, as runs without ASCII blanks; null has none."""
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.coalesce(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+")), F.lit(0))).cast("long")


def apply(docs: DataFrame, weight: Column, *, domain: Column, lang: str = "lang", source: str = "source", id: str = "doc_id",
          text: str = "text", total: float | None = None, max_epochs: int = MAX_EPOCHS, seed: int = 17, ranges: int = RANGES) -> DataFrame:
    """The documents' own rows, each as often as the mix reads it, with all their columns and whole texts.

    The last row a leaf's budget reaches is kept whole too. What is read is worked out on keys and word counts; the documents then meet one
    row per leaf, which says how often each is read, so their texts move only where the leaves are too many to be sent to all tasks.
    """
    key = F.xxhash64(F.col(id), F.xxhash64(text))
    rows = cut(docs.select(domain.alias("domain"), F.col(lang).alias("lang"), F.col(source).alias("source"), word_count(F.col(text)).alias("tokens"), key.alias("key")))
    leaves = cut(rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")).withColumn("weight", weight))
    allotted = cut(budgets(leaves, total, max_epochs))
    found = cut(ends(rows, allotted, seed=seed, tokens=F.col("tokens"), order=F.col("key"), ranges=ranges))
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), domain.alias("domain"), F.col(lang).alias("lang"),
                      F.col(source).alias("source"), key.alias("key")).filter(F.btrim(F.col(f"row.{text}"), F.lit(" \t\n\x0b\f\r")) != "")
    met = attach(own, found, LEVELS).filter("whole IS NOT NULL").withColumn("h", _hash(seed, F.col("whole"), F.col("key")))
    met = met.withColumn("range", _range(F.col("h"), ranges))
    at_end = (F.col("range") == F.col("range_end")) & (F.col("h") == F.col("h_end")) & (F.col("key") == F.col("key_end"))
    before = (F.col("range") < F.col("range_end")) | (F.col("range") == F.col("range_end")) & (
        (F.col("h") < F.col("h_end")) | (F.col("h") == F.col("h_end")) & (F.col("key") < F.col("key_end")))
    more = (F.col("rest") > 0) & F.coalesce(before | at_end, F.lit(False))
    if not found.filter("ties < tied").isEmpty():
        # rows that are equal in id and text at the very end of a leaf, not all of which are read
        split = F.coalesce(at_end & (F.col("rest") > 0) & (F.col("ties") < F.col("tied")), F.lit(False))
        nth = F.row_number().over(Window.partitionBy(*LEVELS).orderBy("h"))
        some = met.filter(split).withColumn("times", F.col("whole") + F.when(nth <= F.col("ties"), 1).otherwise(0))
        met = met.filter(~split).withColumn("times", F.col("whole") + more.cast("int")).unionByName(some)
    else:
        met = met.withColumn("times", F.col("whole") + more.cast("int"))
    return met.filter("times > 0").select("row", F.explode(F.sequence(F.lit(1), "times"))).select("row.*")
