"""Similarity join on word shingles with adaptive prefixes that must match several times."""

from __future__ import annotations

from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm import shingles
from lakeloom.llm.components import components
from lakeloom.session import cut

#: Two sets link when 100 * shared >= PERCENT * union.
PERCENT = 75
#: Cells of the sketch that estimates in how many documents a shingle occurs: 2 ** CELL_BITS of them.
CELL_BITS, BUFFER = 18, 1 << 20
#: Costs of the prefix choice, in units of one candidate found once: a verification, a prefix token moved.
VERIFY_COST, TOKEN_COST = 50.0, 20.0
MOST_MATCHES = 32
#: A set's bits say which of so many longs' places an odd number of its shingles falls on.
BIT_LONGS = 32
BITS = [f"bits{i}" for i in range(BIT_LONGS)]
#: Shingles of a block; two blocks of a component are held against each other in one task.
BLOCK_SHINGLES = 500_000


def _cell(own: np.ndarray) -> np.ndarray:
    return (own >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _bits(own: np.ndarray) -> np.ndarray:
    """For each place whether an odd number of a set's shingles falls on it, 64 places a long.

    Two sets differ in no fewer shingles than in places, which bounds what they share from above.
    """
    odd = np.bincount((own & np.uint64(64 * BIT_LONGS - 1)).astype(np.int64), minlength=64 * BIT_LONGS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _scan(batches):
    """Set size, name and bits of every row, and at the end the task's sketch of shingle frequencies."""
    cells = np.zeros(1 << CELL_BITS, dtype=np.int64)
    waiting: list[np.ndarray] = []

    def count() -> None:
        if waiting:
            cells[:] += np.bincount(np.concatenate(waiting), minlength=len(cells))
            waiting.clear()

    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), *[(b, pa.int64()) for b in BITS], ("sketch", pa.list_(pa.int64()))])
    for batch in batches:
        nodes, sizes, bits, held = [], [], [], 0
        for own in shingles.sets(batch.column(1)):
            nodes.append(shingles.node(own))
            sizes.append(len(own))
            bits.append(_bits(own))
            waiting.append(_cell(own))
            held += len(own)
            if held > BUFFER:
                count()
                held = 0
        count()
        places = np.array(bits, dtype=np.int64).reshape(-1, BIT_LONGS)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), *[pa.array(x) for x in places.T],
                                          pa.nulls(len(nodes), pa.list_(pa.int64()))], schema=schema)
    if cells.any():
        none = pa.nulls(1, pa.int64())
        yield pa.RecordBatch.from_arrays([none] * (3 + BIT_LONGS) + [pa.array([cells], pa.list_(pa.int64()))], schema=schema)


def _combined(batches):
    """The sketches of a partition added up, a row for each cell."""
    cells = np.zeros(1 << CELL_BITS, dtype=np.int64)
    for batch in batches:
        for x in batch.column(0):
            cells += x.values.to_numpy()
    for i in range(0, len(cells), 1 << 16):
        part = cells[i:i + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(i, i + len(part)).astype(np.int32)), pa.array(part)], names=["cell", "n"])


def scan(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Rows (doc_id, node, n, and BITS) of (doc_id, text), and the summed sketch, whose size is fixed."""
    found = cut(docs.mapInArrow(_scan, f"doc_id long, node long, n long, {', '.join(f'{b} long' for b in BITS)}, sketch array<long>"))
    rows = found.filter("sketch IS NULL").select("doc_id", "node", "n", *BITS)
    parts = found.filter("sketch IS NOT NULL").select("sketch").mapInArrow(_combined, "cell int, n long")
    sums = parts.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    cells = np.zeros(1 << CELL_BITS, dtype=np.int64)
    cells[sums.column("cell").to_numpy()] = sums.column("n").to_numpy()
    return rows, cells


def prefix(own: np.ndarray, cells: np.ndarray, usual: float, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """A set's prefix in the global order (estimated frequency, hash), and the matches it asks for.

    A linked pair shares at least ``need`` = percent of the larger set, so of any two linked sets the
    prefixes of n - need + m tokens share m tokens or more. At most S(m) / m sets can match m times, where
    S(m) adds up the prefix tokens' estimated frequencies above the ``usual`` one: m is chosen where
    tokens moved, candidates found and candidates verified cost least together.
    """
    n = len(own)
    need = -(-n * percent // 100)
    count = cells[_cell(own)]
    order = np.argsort(count, kind="stable")
    short, most = n - need, min(need, MOST_MATCHES)
    cost = np.cumsum(np.maximum(0.0, count[order[:short + most]] - usual))[short:]
    m = np.arange(1, most + 1)
    best = int(np.argmin(cost * (1 + VERIFY_COST / m) + TOKEN_COST * m)) + 1
    return own[order[:short + best]], best


def prefixes(docs: DataFrame, cells: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """Rows (token, node, n, m) of every text's prefix."""
    sent = docs.sparkSession.sparkContext.broadcast(cells.astype(np.int64))  # 2 ** CELL_BITS numbers, whatever the input
    mean = float(cells.mean())
    usual = mean + 2 * float(np.sqrt(mean))

    def run(batches):
        table = sent.value
        for batch in batches:
            tokens, nodes, sizes, matches = [], [], [], []
            for own in shingles.sets(batch.column(0)):
                if len(own):
                    front, m = prefix(own, table, usual, percent)
                    tokens.append(front.view(np.int64))
                    nodes.append(np.full(len(front), shingles.node(own)))
                    sizes.append(np.full(len(front), len(own), dtype=np.int32))
                    matches.append(np.full(len(front), m, dtype=np.int32))
            if tokens:
                out = pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, nodes, sizes, matches)], names=["token", "node", "n", "m"])
                for i in range(0, out.num_rows, 100_000):
                    yield out.slice(i, 100_000)

    return docs.select("text").mapInArrow(run, "token long, node long, n int, m int")


def _verifier(percent: int):
    def run(batches):
        kept: OrderedDict[int, np.ndarray] = OrderedDict()

        def known(name: int, text: pa.Scalar) -> np.ndarray:
            if name not in kept:
                kept[name] = next(shingles.sets(pa.array([text.as_py()], pa.string())))
                if len(kept) > 64:
                    kept.popitem(last=False)
            kept.move_to_end(name)
            return kept[name]

        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for i, (x, y) in enumerate(zip(a, b)):
                one, two = known(x, batch.column(2)[i]), known(y, batch.column(3)[i])
                shared = len(one) + len(two) - len(np.union1d(one, two))
                keep.append(100 * shared >= percent * (len(one) + len(two) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def verified(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Those of the pairs (a, b) whose sets link, held against each other in full."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    full = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return full.mapInArrow(_verifier(percent), "a long, b long")


def asked_matches(n, m, o, p, percent: int = PERCENT):
    """How many prefix tokens two sets of n and o shingles must share, their prefixes made for m and p matches.

    They must share the lesser of m and p. And all tokens in the global order up to the end of the prefix that ends first
    are known, so what is left of that set bounds what else they may share: a pair links only if the
    shared prefix tokens and the larger of the two remainders reach the overlap that the sizes ask for.
    """
    overlap = F.ceil((n + o) * percent / F.lit(100.0 + percent) - 1e-9)
    left = [F.ceil(size * percent / F.lit(100.0) - 1e-9) - more for size, more in ((n, m), (o, p))]
    return F.greatest(F.least(m, p), overlap - F.greatest(*left))


def may_link(n, o, bits, others, percent: int = PERCENT):
    """Whether sets of n and o shingles can link, as far as their bits tell: they share no more than (n + o - places they differ in) / 2."""
    apart = sum((F.bit_count(F.col(a).bitwiseXOR(F.col(b))) for a, b in zip(bits, others)), F.lit(0))
    return n + o - apart >= 2 * F.ceil((n + o) * percent / F.lit(100.0 + percent) - 1e-9)


def same_sets():
    """A name ``list`` of the sets that hold a token: the same for tokens of the same sets, whatever their order.

    Should two lists of sets get one name, their tokens are only counted together: two sets share no more tokens under
    a name than the lesser of the numbers they hold, so the count stays a bound from above.
    """
    return F.xxhash64(F.count(F.lit(1)), F.bit_xor(F.xxhash64("node")), F.bit_xor(F.xxhash64("node", F.lit(1)))).alias("list")


def _shared(front: DataFrame) -> DataFrame:
    """Rows (token, node, n, m), each once, of the tokens that several sets have in their prefixes.

    Tokens are told first, copies of a text meeting before that shuffle; prefixes are made once more for the rows, which costs
    time but no table of all of them. No task gathers a token's rows: the join splits a hot one.
    """
    several = cut(front.groupBy("token").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi").select("token"))
    return front.join(several, "token").select("token", "node", "n", "m").dropDuplicates(["token", "node"])


def links(docs: DataFrame, rows: DataFrame, cells: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """(node, label): the components of the sets that link to another one.

    Tokens that only one set has in its prefix are dropped first; ``held`` counts what a set has left, and no pair
    shares more. A token's centre is its set that holds most: of a group of copies the one least changed.
    Every set is held against one centre, the one it shares most tokens with, if these are at least half
    of what a link asks for; a token whose sets all came together asks for nothing more. Every pair that is left,
    in different components, of fitting sizes, whose bits allow a link, holding and sharing enough tokens, is verified in the last round.
    There, tokens that the same sets hold are one list with a weight, so a pair meets once a list and not once a token.
    So no link is missed: two sets that link end in one component, by their own link or by a chain of links.
    """
    shared = cut(_shared(prefixes(docs, cells, percent)))
    names = cut(shared.groupBy("node").agg(F.count(F.lit(1)).cast("int").alias("held")))
    label = names.select("node", "held", F.col("node").alias("label"))
    edges = tried = None
    open_ = shared
    fits = F.least("n", "o") * 100 >= F.greatest("n", "o") * percent
    need = asked_matches(F.col("n"), F.col("m"), F.col("o"), F.col("p"), percent)
    holds = F.least("held", "has") >= need
    for last in (False, True):
        marked = open_.join(label, "node")
        hub = F.max(F.struct("held", "label", "node", F.col("n").alias("o"), F.col("m").alias("p"))).alias("hub")
        spread = marked.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), same_sets() if last else hub).filter("lo <> hi")
        marked = marked.join(spread.drop("lo", "hi"), "token")
        if not last:
            marked = cut(marked)
            asked = marked.filter(F.col("label") != F.col("hub.label")).select(
                "node", "n", "m", "held", F.col("hub.node").alias("other"), "hub.o", "hub.p", F.col("hub.held").alias("has")).filter(fits & holds)
            asked = asked.groupBy("node", "n", "m", "other", "o", "p").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") * 2 >= need)
            pairs = asked.groupBy("node").agg(F.max_by("other", F.struct("c", "other")).alias("other"))
        else:
            bits = rows.filter("node IS NOT NULL").groupBy("node").agg(*[F.first(b).alias(b) for b in BITS])
            lists = marked.groupBy("list", "node", "n", "m", "held", "label").agg(F.count(F.lit(1)).alias("weight"))
            one = cut(lists.join(bits, "node").select("list", "node", "n", "m", "held", "label", "weight", *BITS))
            theirs = [f"other_{b}" for b in BITS]
            two = one.toDF("list", "other", "o", "p", "has", "rival", "its_weight", *theirs)
            met = one.join(two, "list").filter("node < other AND label <> rival").filter(fits & holds & may_link(F.col("n"), F.col("o"), BITS, theirs, percent))
            pairs = met.groupBy("node", "n", "m", "other", "o", "p").agg(F.sum(F.least("weight", "its_weight")).alias("c")).filter(F.col("c") >= need)
        pairs = pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        tried = cut(pairs)
        asked = tried.select(F.col("a").alias("node")).unionAll(tried.select(F.col("b").alias("node"))).distinct()
        texts = cut(_texts(docs, rows.join(asked, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))))
        good = cut(verified(tried, texts, percent))
        edges = good if edges is None else edges.unionAll(good)
        joined = components(edges)
        label = cut(names.join(joined, "node", "left").select("node", "held", F.coalesce("label", "node").alias("label")))
        if not last:
            open_ = marked.select("token", "node", "n", "m")
    return label


def _named(batches):
    for batch in batches:
        names = [shingles.node(x) for x in shingles.sets(batch.column(0))]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), batch.column(0)], names=["node", "text"])


def _texts(docs: DataFrame, owners: DataFrame) -> DataFrame:
    """One text (node, text) for each of the owners (node, doc_id), read from the documents by id.

    An id may stand for several texts, and rows without id can only be told by their text; so the
    rows found are named again.
    """
    by_id = docs.join(owners.filter("doc_id IS NOT NULL").select("doc_id").distinct(), "doc_id").select("text")
    found = by_id.unionAll(docs.filter("doc_id IS NULL").select("text")).mapInArrow(_named, "node long, text string")
    return found.join(owners.select("node"), "node").groupBy("node").agg(F.first("text").alias("text"))


def _matched(batches, percent: int):
    """The links of each cell, set after set: the cell's nodes and copies, the place of a set, those of the sets it links to.

    Batches hold (label, i, j, node, block, copies, text), cells one after the other. A cell holds two blocks of a component,
    or one whose sets are held against each other.
    """
    def linked(cell, nodes, blocks, copies, own):
        order = np.argsort([len(x) for x in own], kind="stable")
        sets = [own[k] for k in order]
        nodes, blocks, copies = (np.array(x, dtype=np.int64)[order] for x in (nodes, blocks, copies))
        sizes = np.array([len(x) for x in sets], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        tokens = np.unique(np.concatenate(sets), return_inverse=True)[1]
        mark = np.zeros(int(tokens.max()) + 1, dtype=np.int64)
        for a in range(len(sets) - 1):
            # sizes ascend: only the next sets up to the largest that can link
            end = int(np.searchsorted(sizes, sizes[a] * 100 // percent, "right"))
            if end <= a + 1:
                continue
            mine = tokens[starts[a]:starts[a + 1]]
            mark[mine] = 1
            met = np.add.reduceat(mark[tokens[starts[a + 1]:starts[end]]], starts[a + 1:end] - starts[a + 1])
            mark[mine] = 0
            good = 100 * met >= percent * (sizes[a] + sizes[a + 1:end] - met)
            if cell[1] != cell[2]:
                good &= blocks[a + 1:end] != blocks[a]
            if good.any():
                yield nodes, copies, a, np.flatnonzero(good) + a + 1

    cell, held = None, ([], [], [], [])
    for batch in batches:
        keys = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
        rest = zip(*(batch.column(k).to_pylist() for k in range(3, 6)), shingles.sets(batch.column(6)))
        for key, row in zip(keys, rest):
            if key != cell:
                if held[0]:
                    yield from linked(cell, *held)
                cell, held = key, ([], [], [], [])
            for column, value in zip(held, row):
                column.append(value)
    if held[0]:
        yield from linked(cell, *held)


def _pairs_of(percent: int):
    def run(batches):
        out = []
        for nodes, _, a, bs in _matched(batches, percent):
            one, two = np.full(len(bs), nodes[a]), nodes[bs]
            out.append((np.minimum(one, two), np.maximum(one, two)))
            if sum(len(x) for x, _ in out) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["a", "b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["a", "b"])
    return run


def _counts_of(percent: int):
    def run(batches):
        now, counts = None, None
        for nodes, copies, a, bs in _matched(batches, percent):
            if nodes is not now:
                if now is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(now), pa.array(counts)], names=["node", "met"])
                now, counts = nodes, np.zeros(len(nodes), dtype=np.int64)
            counts[a] += copies[bs].sum()
            counts[bs] += copies[a]
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array(now), pa.array(counts)], names=["node", "met"])
    return run


def _cells(docs: DataFrame, placed: DataFrame, block: int) -> DataFrame:
    """Rows (label, i, j, node, block, copies, text), cell by cell: every two blocks of a component that has several sets.

    A link lies inside one component, so any two sets that link meet in one cell; ``block`` bounds the shingles of a
    block, so that a task holds two blocks, whatever the component's size.
    """
    nodes = cut(placed.filter("node IS NOT NULL").groupBy("node", "label", "n").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("doc_id")))
    sizes = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("sets"), F.ceil(F.sum("n") / F.lit(block)).cast("int").alias("blocks"))
    several = cut(nodes.join(sizes.filter("sets > 1"), "label"))
    texts = cut(_texts(docs, several.select("node", "doc_id")))
    rows = several.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "block", "copies")
    cells = rows.join(texts, "node").select("label", "i", "j", "node", "block", "copies", "text")
    return cells.repartition("label", "i", "j").sortWithinPartitions("label", "i", "j")


def _placed(docs: DataFrame, percent: int) -> DataFrame:
    """Rows (node, doc_id, n, label) of (doc_id, text): label names the component, null for texts without shingles."""
    rows, cells = scan(docs)
    label = links(docs, rows, cells, percent).select("node", "label")
    return rows.drop(*BITS).join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _component(placed: DataFrame) -> DataFrame:
    """The same rows with component_id."""
    first = placed.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("first"))
    return placed.join(first, "label", "left").withColumn(
        "component_id", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("first")))


def _own(docs: DataFrame, id: str, text: str) -> DataFrame:
    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))


def join(docs: DataFrame, *, id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable by links).

    Null and blank texts have no shingles and stand alone. Equal sets are one node, so exact copies, repeated
    rows and rows that share an id need no pairs. Null ids take part; a component of null ids only has none.
    Other columns are ignored.
    """
    return _component(_placed(_own(docs, id, text), percent)).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def pairs(docs: DataFrame, *, id: str = "doc_id", text: str = "text", percent: int = PERCENT,
          block: int = BLOCK_SHINGLES) -> tuple[DataFrame, DataFrame]:
    """(members, edges): rows (doc_id, node) of every input row, and every link (a, b) of two different sets once, a < b.

    Rows with the same node have equal sets; a node is null without shingles. A group of k sets can hold k * (k - 1) / 2 links.
    """
    docs = _own(docs, id, text)
    placed = cut(_placed(docs, percent))
    return placed.select("doc_id", "node"), _cells(docs, placed, block).mapInArrow(_pairs_of(percent), "a long, b long")


def join_counts(docs: DataFrame, *, id: str = "doc_id", text: str = "text", percent: int = PERCENT, block: int = BLOCK_SHINGLES) -> DataFrame:
    """The rows of ``join`` with n_links: how many other rows link to the row, copies counted one by one.

    Links are counted where they are found, so rows grow with sets and blocks, not with links.
    """
    docs = _own(docs, id, text)
    placed = cut(_placed(docs, percent))
    met = _cells(docs, placed, block).mapInArrow(_counts_of(percent), "node long, met long").groupBy("node").agg(F.sum("met").alias("met"))
    copies = placed.filter("node IS NOT NULL").groupBy("node").agg(F.count(F.lit(1)).alias("copies"))
    counts = copies.join(met, "node", "left").select("node", (F.col("copies") - 1 + F.coalesce("met", F.lit(0))).alias("n_links"))
    return _component(placed).join(counts, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def keep_first(docs: DataFrame, *, id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of the smallest id of every component, with all their columns; of rows that share that id and text, all stay.

    A row without id stays if its text has no shingles, or if its component holds no id and no smaller text hash.
    Rows with an id are told by it alone: a row that shares its id with the kept row of another component stays too.
    """
    own = _own(docs, id, text)
    placed = cut(_placed(own, percent))
    firsts = _component(placed).filter("doc_id = component_id").select(F.col("doc_id").alias("__id")).distinct()
    with_id = docs.join(firsts, docs[id].cast("long") == F.col("__id")).select(*[docs[c] for c in docs.columns])

    bare = docs.filter(docs[id].cast("long").isNull()).withColumn("__hash", F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    named = bare.select(F.col(text).alias("text")).distinct().mapInArrow(_named, "node long, text string")
    named = named.select("node", F.sha2(F.coalesce("text", F.lit("")), 256).alias("hash")).distinct()
    label = placed.filter("node IS NOT NULL").groupBy("node").agg(F.first("label").alias("label"))
    headed = placed.filter("doc_id IS NOT NULL AND label IS NOT NULL").select("label").distinct()
    found = named.join(label, "node").join(headed, "label", "left_anti").groupBy("label").agg(F.min("hash").alias("hash")).select("hash")
    kept = found.unionAll(named.filter("node IS NULL").select("hash")).distinct()
    without = bare.join(kept, F.col("__hash") == F.col("hash")).select(*[bare[c] for c in docs.columns])
    return with_id.unionAll(without)
