"""Merkle manifest of a dataset: nodes labelled by the interval of leaf ranks they cover, proofs by containment joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.session import cut

#: Nodes that become one node of the next level.
FANOUT = 8
#: A step of a proof: the digests that stand before and after a node in its parent, as bytes one after the other.
STEP = "struct<before: binary, after: binary>"


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of texts, one after the other."""
    return F.sha2(F.concat(*[x.cast("binary") for x in parts]), 256)


def field(value: Column) -> Column:
    """A value that cannot run into its neighbours: its UTF-8 byte count, a colon and itself, or ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return digest(*[field(x) for x in fields])


def ranked(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """Rows plus ``lo``, their place in their tree from 0 along the order, and ``size``, the tree's number of rows.

    Rows are dealt out by ranges of (tree, order), so a tree of any size is spread over tasks; a place is the rows of the same tree
    in the ranges before plus those before it in its own. Rows that tie in the whole order may get their places either way
    round, but are written once, so every later step sees the same places.
    """
    sorted_ = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    placed = cut(sorted_.select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("seen")))
    counts = cut(placed.groupBy("range", tree).agg(F.count(F.lit(1)).alias("n"), F.min("seen").alias("first")))
    of = Window.partitionBy(tree)
    upto = of.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("range", tree, (F.coalesce(F.sum("n").over(upto), F.lit(0).cast("long")) - F.col("first")).alias("shift"),
                           F.sum("n").over(of).alias("size"))
    return placed.join(starts, ["range", tree]).select(*rows.columns, (F.col("seen") + F.col("shift")).alias("lo"), "size")


def bucket(level: int, lo: Column, fanout: int = FANOUT) -> Column:
    """The place among a level's nodes of the one that covers a rank."""
    return F.floor(lo / F.lit(fanout ** level)).cast("long") if level else lo


def node_levels(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """The leaves (tree, size, lo, hi, leaf, ...) and the tables of each higher level's nodes: tree, size, lo, hi, digest, children (lo, hi, digest).

    A node covers the ranks from lo to before hi. While a tree has several nodes on a level, every ``fanout`` neighbours (the last run: fewer)
    make one of the next; its digest is that of theirs in order. Each level is a table of an eighth of the rows below.
    """
    levels, below = [leaves], leaves.withColumn("digest", F.unhex("leaf"))
    most = leaves.agg(F.max("size")).first()[0] or 0
    level = 0
    while fanout ** level < most:
        runs = below.filter(F.col("size") > fanout ** level).groupBy("tree", "size", bucket(level + 1, F.col("lo"), fanout).alias("bucket"))
        nodes = runs.agg(F.array_sort(F.collect_list(F.struct("lo", "hi", "digest"))).alias("children"))
        texts = F.transform("children", lambda x: F.lower(F.hex(x["digest"])))
        levels.append(cut(nodes.select(
            "tree", "size", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"),
            F.unhex(digest(F.array_join(texts, ""))).alias("digest"), "children")))
        below = levels[-1]
        level += 1
    return levels


def roots(levels: Sequence[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """Rows (tree, digest) of the node that covers all of its tree, as lower-case hex."""
    found = None
    for level, nodes in enumerate(levels):
        own = nodes.filter(_is_root(level, fanout)).select("tree", (F.lower(F.hex("digest")) if level else F.col("leaf")).alias("digest"))
        found = own if found is None else found.unionAll(own)
    return found


def _is_root(level: int, fanout: int) -> Column:
    whole = F.col("size") <= fanout ** level
    return whole & (F.col("size") > fanout ** (level - 1)) if level else whole


def step(children: Column, lo: Column, hi: Column) -> Column:
    """The siblings of a node in its parent: what is left of the parent's children without the node's interval, before and after it."""
    nothing = F.lit(b"")
    joined = lambda part: F.aggregate(part, nothing, lambda done, x: F.concat(done, x["digest"]))
    return F.struct(joined(F.filter(children, lambda x: x["hi"] <= lo)).alias("before"), joined(F.filter(children, lambda x: x["lo"] >= hi)).alias("after"))


def attach_paths(levels: Sequence[DataFrame], tops: DataFrame, carried: Sequence[str], fanout: int = FANOUT) -> DataFrame:
    """The leaves with all their columns, what tops carry, and ``path``, which has a step per ancestor, from its parent upwards.

    ``tops`` has a row (tree, path, ...) per tree: the steps above its root, and columns handed down. From the top level down, nodes are joined
    with the one node of the level above whose interval contains theirs. Both sides name the bucket of that level their
    interval lies in, so only that node is met; its path, one step longer, becomes theirs. No join's key is a whole tree.
    """
    above, named = None, tops.withColumnRenamed("tree", "of")
    for level in range(len(levels) - 1, -1, -1):
        nodes = levels[level]
        keep = [*nodes.columns, "path", *carried]
        below = nodes.filter(_is_root(level, fanout)).join(named, F.col("tree") == F.col("of")).select(*keep)
        if above is not None:
            node = nodes.filter(F.col("size") > fanout ** level).withColumn("bucket", bucket(level + 1, F.col("lo"), fanout))
            up = above.select(F.col("tree").alias("of"), bucket(level + 1, F.col("lo"), fanout).alias("above"), F.col("lo").alias("from"),
                              F.col("hi").alias("to"), F.col("children").alias("kin"), F.col("path").alias("rest"), *carried)
            met = node.join(up, (F.col("tree") == F.col("of")) & (F.col("bucket") == F.col("above"))
                            & (F.col("lo") >= F.col("from")) & (F.col("hi") <= F.col("to")))
            path = F.concat(F.array(step(F.col("kin"), F.col("lo"), F.col("hi")).cast(STEP)), F.col("rest"))
            below = below.unionAll(met.withColumn("path", path).select(*keep))
        above = below
    return above


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and the siblings along its path give."""
    hex_ = lambda x: F.lower(F.hex(x))
    return F.aggregate(path, leaf, lambda done, x: digest(hex_(x["before"]), done, hex_(x["after"])))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings along a path, upwards and, inside a level, left to right."""
    return digest(F.array_join(F.transform(path, lambda x: F.concat(F.lower(F.hex(x["before"])), F.lower(F.hex(x["after"])))), ""))


def manifest(docs: DataFrame, fields: Sequence[Column], *, id: str = "doc_id", tree: str = "lang", tampered: Column | None = None,
             fanout: int = FANOUT) -> DataFrame:
    """Rows (doc_id, tree, lo, size, leaf, claimed, subroot, root, path), one per document.

    ``fields`` make up the leaf's digest. Leaves of a value of ``tree`` (null being a value of its own) ascend by id, nulls first, equal ids by
    digest; their trees' roots, in the order of the values' bytes, null first, are the leaves of one more tree, whose root is ``root``. ``path``
    holds the siblings from the leaf up to it. ``claimed`` is the digest with ``tampered`` in place of the last field, where
    that is not null, else the leaf. Repeated rows are leaves of their own; other columns are ignored; no rows give no rows.

    Texts are read once: what follows works on digests. Trees of any size are spread by ranges and buckets of ranks.
    """
    claimed = F.lit(None).cast("string") if tampered is None else F.when(tampered.isNotNull(), leaf_digest([*fields[:-1], tampered]))
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit("")).alias("tree"),
                       leaf_digest(fields).alias("leaf"), claimed.alias("claimed"))
    # as its own table: ranges are sampled without hashing texts again, and the place in it parts rows that are equal in all else
    rows = cut(rows.withColumn("at", F.monotonically_increasing_id()))
    leaves = ranked(rows, "tree", ["doc_id", "leaf", "at"])
    leaves = cut(leaves.select("tree", "size", "lo", (F.col("lo") + 1).alias("hi"), "doc_id", "leaf", F.coalesce("claimed", "leaf").alias("claimed")))
    levels = node_levels(leaves, fanout)
    crown = cut(roots(levels, fanout))
    crown = ranked(crown.select(F.lit("").alias("tree"), F.col("tree").alias("value"), F.col("digest").alias("leaf")), "tree", ["value"])
    crown = cut(crown.withColumn("hi", F.col("lo") + 1))
    alone = crown.select("tree").distinct().withColumn("path", F.array().cast(f"array<{STEP}>"))
    over = attach_paths(node_levels(crown, fanout), alone, [], fanout)
    tops = cut(over.select(F.col("value").alias("tree"), "path", F.col("leaf").alias("subroot"), fold(F.col("leaf"), F.col("path")).alias("root")))
    return attach_paths(levels, tops, ["subroot", "root"], fanout).select("doc_id", "tree", "lo", "size", "leaf", "claimed", "subroot", "root", "path")
