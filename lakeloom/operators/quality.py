"""Profiles, rule checks, orphans, column relations, lineage depth and log parsing."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.operators.aggregate import long_values
from lakeloom.operators.joins import anti
from lakeloom.session import cut, scratch


def _as_text(c: str, kind: T.DataType) -> Column:
    """Text of a value; fractional numbers as fixed decimals, times as seconds."""
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.col(c).cast("decimal(38,6)").cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return F.col(c).cast("string")


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """One row per column: type, rows, distinct values, nulls, extremes and text lengths.

    Extremes and null counts come from one aggregate pass. Distinct values are counted over
    (column, value) pairs made distinct before the count, or by sketches in the same pass when
    approximate counts are enough.
    """
    fields = [(f.name, f.dataType) for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.StructType))]
    stats = []
    for name, kind in fields:
        c = F.col(name)
        text = _as_text(name, kind)
        lowest, highest = F.min(c), F.max(c)
        number = isinstance(kind, T.NumericType)
        show = lambda v, k=kind: _as_value(v, k)
        length = (lambda f, v: F.length(show(v)) if number else f(F.length(text)))
        stats.append(F.struct(
            F.lit(name).alias("column"), F.lit(kind.simpleString()).alias("type"),
            F.count(F.lit(1)).alias("n_rows"), F.count_if(c.isNull()).alias("n_null"),
            show(lowest).alias("min_value"), show(highest).alias("max_value"),
            length(F.min, lowest).alias("min_length"), length(F.max, highest).alias("max_length"),
            (F.approx_count_distinct(c) if approximate else F.lit(None).cast("long")).alias("n_distinct"),
        ))
    wide = df.agg(F.array(*stats).alias("_s"))
    rows = wide.select(F.explode("_s").alias("_s")).select("_s.*")
    if not approximate:
        rows = rows.drop("n_distinct").join(distinct_counts(df, [n for n, _ in fields]), "column", "left")
    return rows.select(
        "column", "type", "n_rows", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
        (F.col("n_null") > 0).alias("has_null"), (F.col("n_null") == F.col("n_rows")).alias("all_null"),
        "n_null", "min_value", "max_value", "min_length", "max_length",
    )


def _as_value(c: Column, kind: T.DataType) -> Column:
    """Whole part of numbers, text of anything else."""
    if isinstance(kind, T.NumericType):
        return c.cast("long").cast("string")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return c.cast("string")


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact number of distinct non-null values per column."""
    pairs = long_values(df, cols).where("value is not null").distinct()
    return pairs.groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))


def check(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows checked and failed per rule, with one failing example; an unknown outcome fails."""
    text = F.to_json(F.struct(*df.columns))
    parts = []
    for name, rule in rules.items():
        bad = ~F.coalesce(rule, F.lit(False))
        parts.append(F.struct(
            F.lit(name).alias("rule"), F.count(F.lit(1)).alias("checked"), F.count_if(bad).alias("failed"),
            F.min(F.when(bad, text)).alias("sample"),
        ))
    rows = df.agg(F.array(*parts).alias("_r")).select(F.explode("_r").alias("_r")).select("_r.*")
    return rows.withColumn("passed", F.col("failed") == 0)


def no_edge_blanks(c: Column) -> Column:
    return ~c.rlike(r"^\s|\s$") | c.isNull()


def has_length(c: Column, n: int) -> Column:
    return F.length(c) == n


def orphans(fact: DataFrame, ref: DataFrame, key: str, ref_key: str) -> DataFrame:
    """Fact keys without reference row, and how many rows carry each."""
    per_key = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return anti(per_key, ref, {key: ref_key})


def name_similarity(a: Column, b: Column) -> Column:
    """1 for equal names, falling with the edit distance relative to the longer name."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))


def _stem(name: str) -> str:
    return name.split("_", 1)[-1].lower()


def column_sets(columns: Sequence[tuple[int, DataFrame, str]]) -> DataFrame:
    """For each set of columns that some value stands in, and in no other column: its bits, and how many values have it.

    ``columns`` are (number, table, name); columns of one table must come as the same frame, which is read once. A value's text
    gets one bit per column that holds it, in as many longs as the numbers need; equal sets of bits are then counted, so what is
    left has a row per set that occurs. A value that fills a column is merged in the tasks before it moves. Nulls count nowhere.
    """
    tables: dict[int, tuple[DataFrame, list]] = {}
    for number, df, name in columns:
        tables.setdefault(id(df), (df, []))[1].append(F.struct(F.lit(number).alias("_id"), F.col(f"`{name}`").cast("string").alias("_v")))
    cells = [df.select(F.explode(F.array(*parts)).alias("_c")).select("_c.*") for df, parts in tables.values()]
    words = range(max((number for number, *_ in columns), default=0) // 64 + 1)
    bit = lambda w: F.when(F.floor(F.col("_id") / 64) == w, F.expr("shiftleft(1L, _id % 64)"))
    held = reduce(DataFrame.unionByName, cells).where("_v is not null").groupBy("_v").agg(
        *[F.coalesce(F.bit_or(bit(w)), F.lit(0).cast("long")).alias(f"_{w}") for w in words])
    counted = held.groupBy(*[f"_{w}" for w in words]).agg(F.count(F.lit(1)).alias("n_values"))
    return counted.select(F.array(*[f"_{w}" for w in words]).alias("bits"), "n_values")


def _has_bit(bits: str, number: Column) -> Column:
    word = F.get(F.col(bits), F.floor(number / 64).cast("int"))
    return F.call_function("getbit", word, (number % 64).cast("int")) == 1


def related_columns(tables: Mapping[str, DataFrame], name_at_least: float = 0.7,
                    coverage_at_least: float = 0.7) -> DataFrame:
    """Likely foreign keys: similar names, and values mostly contained in the other column.

    Every table is read once, in the columns that have a column of the same type and a name of a similar length in another table. Each
    value gets the set of columns that hold it; coverage is summed over the different sets, of which there are few, however
    many values there are. Columns without a value are in no relation.
    """
    spark = next(iter(tables.values())).sparkSession
    fields = [(t, f.name, f.dataType.simpleString(), _stem(f.name)) for t, df in tables.items() for f in df.schema.fields]
    # names whose lengths differ more cannot be similar enough
    near = lambda x, y: min(len(x), len(y)) >= name_at_least * max(len(x), len(y))
    listed = [(i, *f) for i, f in enumerate(f for f in fields if any(f[0] != g[0] and f[2] == g[2] and near(f[3], g[3]) for g in fields))]
    child = spark.createDataFrame(listed, "_i int, child string, child_column string, type string, s1 string")
    parent = child.toDF("_j", "parent", "parent_column", "type", "s2")
    similar = child.join(parent, "type").where("child <> parent").withColumn(
        "similarity", F.round(name_similarity(F.col("s1"), F.col("s2")), 4)).where(F.col("similarity") >= name_at_least).drop("type", "s1", "s2")
    if not listed:
        none = F.lit(0).cast("long")
        return similar.drop("_i", "_j").withColumns({"n_values": none, "n_shared": none, "coverage": F.lit(0.0)})
    sets = cut(column_sets([(i, tables[t], name) for i, t, name, *_ in listed]))
    held = sets.withColumn("_i", F.explode(F.filter(F.sequence(F.lit(0), F.lit(len(listed) - 1)), lambda x: _has_bit("bits", x))))
    size = held.groupBy("_i").agg(F.sum("n_values").alias("n_values"))
    shared = held.join(similar, "_i").where(_has_bit("bits", F.col("_j"))).groupBy(
        "_i", "child", "child_column", "parent", "parent_column", "similarity").agg(F.sum("n_values").alias("n_shared"))
    found = shared.join(size, "_i").drop("_i")
    return found.withColumn("coverage", F.col("n_shared") / F.col("n_values")).where(F.col("coverage") >= coverage_at_least)


def lineage_depth(edges: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """Longest path from a root to each node of an acyclic edge list.

    Nodes are released once all their inputs have a depth. A round meets only the edges of the nodes that the round before released;
    released nodes are written once and not read again before the end. What is carried on are the nodes that were reached
    and still wait for an input. Nodes on or behind a cycle are never released, which raises an error.
    """
    e = edges.select(F.col(source).alias("s"), F.col(target).alias("t")).where("s is not null and t is not null")
    e = cut(e.distinct())
    inputs = cut(e.groupBy(F.col("t").alias("node")).agg(F.count(F.lit(1)).alias("open")))
    roots = e.select(F.col("s").alias("node")).distinct().join(inputs, "node", "left_anti")
    fresh, waiting = cut(roots.withColumn("depth", F.lit(0).cast("long"))), None
    done = scratch(e.sparkSession, "depths")
    while True:
        fresh.write.mode("append").parquet(done)
        if fresh.isEmpty():
            break
        reach = fresh.join(e, F.col("node") == F.col("s")).groupBy(F.col("t").alias("node")).agg(
            F.count(F.lit(1)).alias("closed"), F.max(F.col("depth") + 1).alias("depth"))
        if waiting is not None:
            reach = reach.unionByName(waiting).groupBy("node").agg(F.sum("closed").alias("closed"), F.max("depth").alias("depth"))
        state = cut(reach.join(inputs, "node"))
        fresh, waiting = state.where("closed = open").select("node", "depth"), state.where("closed < open").drop("open")
    found = e.sparkSession.read.schema(fresh.schema).parquet(done)
    if found.count() < e.select(F.col("s").alias("node")).union(e.select("t")).distinct().count():
        raise ValueError("the edge list has a cycle")
    return found.select("node", F.col("depth").cast("int").alias("depth"))


def neighbours(edges: DataFrame, source: str = "source", target: str = "target") -> DataFrame:
    """Direct inputs and outputs per node, counted."""
    ends = edges.select(F.col(source).alias("node"), F.lit(0).alias("_in"), F.lit(1).alias("_out")).unionByName(
        edges.select(F.col(target).alias("node"), F.lit(1).alias("_in"), F.lit(0).alias("_out")))
    return ends.groupBy("node").agg(F.sum("_in").alias("n_inputs"), F.sum("_out").alias("n_outputs"))


def parse_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """Time, level and message of lines shaped 'time - level - message'; other lines drop out."""
    shaped = lines.where(F.col(line).rlike(r"^.+? - [A-Z]+ - ")).withColumn("_p", F.split(line, " - ", 3))
    kept = [c for c in lines.columns if c != line]
    return shaped.select(
        *kept, F.try_to_timestamp(F.col("_p")[0], F.lit("yyyy-MM-dd HH:mm:ss")).alias("logged_at"),
        F.col("_p")[1].alias("level"), F.col("_p")[2].alias("message"),
    )


def coerce_by_name(df: DataFrame) -> DataFrame:
    """Types by the last part of column names: dates, ids as text, ages as integers, amounts as numbers.

    Parts are what underscores, blanks and case changes divide. A date or amount column with a value that does
    not parse stays as it is; one pass over those columns finds out. Ages that do not parse are 0.
    """
    out, strict = {}, {}
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = re.split(r"[^a-z0-9]+", re.sub("([a-z0-9])([A-Z])", r"\1_\2", f.name).lower())[-1]
        if kind == "date":
            strict[f.name] = c.try_cast("date")
        elif kind == "id":
            out[f.name] = c.cast("string")
        elif kind == "age":
            out[f.name] = F.coalesce(c.try_cast("int"), F.lit(0))
        elif kind == "amount":
            strict[f.name] = F.regexp_replace(c.cast("string"), ",", "").try_cast("double")
    if strict:
        lost = [F.count_if(F.col(f"`{n}`").isNotNull() & x.isNull()).alias(str(i)) for i, (n, x) in enumerate(strict.items())]
        kept = df.agg(*lost).first()
        out |= {n: x for i, (n, x) in enumerate(strict.items()) if not kept[i]}
    return df.withColumns(out) if out else df


def lexicon(inventory: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Columns found in files against a dictionary of columns: documented, missing or unused."""
    from lakeloom.operators.joins import outer_with_origin

    both = outer_with_origin(inventory, dictionary, ["table_name", "column_name"], ("", "_dict"))
    status = (
        F.when(F.col("origin") == "both", F.lit("documented"))
        .when(F.col("origin") == "left_only", F.lit("not in dictionary")).otherwise(F.lit("not in files"))
    )
    return both.withColumn("status", status).drop("origin")
