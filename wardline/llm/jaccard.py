"""Operator 4, n-gram Jaccard join: prefix-filtered index lists with skipping by set relations, and the groups they link.

A text's set holds its distinct word shingles. Exact copies of a set are one node. The rest is an exact join:

1. Shingles are put in one total order: by class of a frequency sketch (one bounded table, whatever the input), then by
   hash. Any order is exact; this one puts passages that many documents share last, so they seldom reach a prefix.
2. A set enters the index lists of its first n - ceil(t n) + 1 shingles with its size and position. Lists fall into blocks
   of sizes that may match; a block without a posting early enough in its set to be the smaller of a pair is skipped whole,
   a probe stops at the first set that is too large, and the positions of both bound the overlap that is left.
3. First round: every set of a block is compared with the block's leader only. Second round: pairs of a list that are not
   yet in one group are compared, but first derived from answers already known: with a leader c of a at known distance,
   the overlap of (a, b) differs from that of their leaders by at most the two distances, so most pairs need no look.
4. Before sets are read, histograms of n/8 counters bound the overlap; what passes is counted exactly.

Groups are found by label propagation over staged tables. Nothing that grows with the input reaches the driver or is
broadcast: Bloom filters and the sketch have fixed largest sizes. Large blocks of a list are cut into parts that meet in
twos, so a task holds the postings of two parts, whatever the list.

Defined results: empty texts (and texts without words) have n_shingles 0 and link with nothing, whatever rows share their
id; a text with fewer words than a shingle is one shingle; rows with a null id link with nothing and have a null component;
other rows that share an id are one document that links as any of them does; an empty table gives no rows. keep_one() does
link rows with a null id: all of one text are one document, which comes after all ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import hashing as H
from wardline.llm.common import map_arrow, partitions, row_of, staged, table
from wardline.llm.exact_dedup import BITS_PER_ROW, maybe_repeated, repeated_filter
from wardline.llm.tokens import in_parts

#: Counters of the frequency sketch (one byte each once it is broadcast) and of each row of it.
SKETCH, ROW = 1 << 22, 1 << 13
#: Filters have at most so many bits; fuller ones let more rows through but lose none.
FILTER_BITS = 1 << 26
#: Postings of a part of a block (a cell holds two parts), and pairs that leave a task at once.
CELL, PAIRS = 2048, 1 << 17


class Rule(NamedTuple):
    """Shingle length in words; link where 100 * intersection >= percent * union."""

    words: int = 4
    percent: int = 85


def shingle_sets(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    """The sorted set of each text."""
    data, starts = H.join_texts(texts)
    first, stop = H.words(data)
    hashes = H.spans(H.prefix(H.LOWER_VALUES[data]), first, stop)
    edges = np.searchsorted(first, starts).tolist()
    grams = H.combine(hashes, n)
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        else:
            yield H.combine(hashes[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def set_id(values: np.ndarray) -> int:
    """Signed 64-bit identity of a set; sizes are compared with it."""
    return int(H.mix(np.array([H.mix(values).sum()], np.uint64)).view(np.int64)[0]) if len(values) else 0


def histogram(values: np.ndarray) -> bytes:
    """Counts by the low bits of the hash, about 8 to 16 a counter, capped at 255."""
    bits = max(0, (len(values) // 8).bit_length() - 1)
    return np.minimum(np.bincount((values & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8).tobytes()


def most_overlap(n1: int, h1: bytes, n2: int, h2: bytes) -> int:
    """Upper bound of the intersection of two sets by their histograms."""
    a, b = np.frombuffer(h1, np.uint8).astype(np.int64), np.frombuffer(h2, np.uint8).astype(np.int64)
    if max(a.max(initial=0), b.max(initial=0)) == 255:
        return min(n1, n2)
    while len(a) > len(b):
        a = a[: len(a) // 2] + a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] + b[len(b) // 2 :]
    return (n1 + n2 - int(np.abs(a - b).sum())) // 2


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))


def profile(texts: DataFrame, rule: Rule) -> tuple[DataFrame, np.ndarray]:
    """One pass: a row per document (doc_id, n, sid, hist), and the class of every counter of the sketch."""
    schema = "doc_id long, n int, sid long, hist binary, block int, counts binary"
    empty = lambda k, kind: pa.nulls(k, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.uint32)
        for batch in batches:
            for a, b, values in in_parts(batch.column(1)):
                sets = list(shingle_sets(values, rule.words))
                np.add.at(sketch, (np.concatenate(sets) % np.uint64(SKETCH)).astype(np.int64), 1)
                cols = [batch.column(0).slice(a, b - a), pa.array([len(s) for s in sets], pa.int32()), pa.array([set_id(s) for s in sets], pa.int64()), pa.array([histogram(s) for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays([*cols, empty(b - a, pa.int32()), empty(b - a, pa.binary())], names=["doc_id", "n", "sid", "hist", "block", "counts"])
        if sketch.any():
            yield blocks(sketch.reshape(-1, ROW))

    def blocks(counts: np.ndarray) -> pa.RecordBatch:
        import zstandard

        pack, used = zstandard.ZstdCompressor(level=1).compress, np.flatnonzero(counts.any(axis=1))
        cols = [empty(len(used), k) for k in (pa.int64(), pa.int32(), pa.int64(), pa.binary())]
        return pa.RecordBatch.from_arrays([*cols, pa.array(used.astype(np.int32)), pa.array([pack(counts[k].astype(np.uint64).tobytes()) for k in used], pa.binary())], names=["doc_id", "n", "sid", "hist", "block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack, pack, total = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(level=1).compress, {}
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[k] = total.get(k, 0) + np.frombuffer(unpack(x), np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([pack(x.tobytes()) for x in total.values()], pa.binary())], names=["block", "counts"])

    rows = staged(map_arrow(texts, run, schema), "profile")
    parts = min(partitions(texts.sparkSession), SKETCH // ROW)
    # Two levels, so that no task adds up the rows of every other task.
    salted = rows.where("block IS NOT NULL").select("block", "counts", F.floor(F.rand(7) * 16).alias("salt")).repartition(parts, "block", "salt")
    partial = map_arrow(salted.select("block", "counts"), add, "block int, counts binary")
    summed = map_arrow(partial.repartition(parts, "block"), add, "block int, counts binary").collect()
    counts = np.zeros((SKETCH // ROW, ROW), np.uint64)
    if summed:
        import zstandard

        for r in summed:
            counts[r.block] += np.frombuffer(zstandard.ZstdDecompressor().decompress(r.counts), np.uint64)
    # Tokens that stand out from what others add to a counter by chance, in half octaves.
    mean = float(counts.mean())
    above = (counts.ravel() - mean) / (2 * (1 + np.sqrt(mean)))
    classes = np.clip(np.ceil(2 * np.log2(np.maximum(above, 0.5))), 0, 120).astype(np.uint8)
    return rows.where("block IS NULL").select("doc_id", "n", "sid", "hist"), classes


def _grow(first: np.ndarray, *more: np.ndarray) -> np.ndarray:
    return np.concatenate([first, *more])


def index_lists(texts: DataFrame, classes: np.ndarray, rule: Rule) -> DataFrame:
    """Staged postings (token, n, sid, pos) that have another set of matching size next to them in their list."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(classes)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order_of, seen = shared.value, set()
        for batch in batches:
            for a, b, values in in_parts(batch.column(1)):
                token, n, sid, pos = [], [], [], []
                for s in shingle_sets(values, rule.words):
                    key = set_id(s)
                    if not len(s) or key in seen:
                        continue  # copies in this task share their postings
                    if len(seen) < 1 << 17:
                        seen.add(key)
                    keep = len(s) - -(-rule.percent * len(s) // 100) + 1
                    found = s[np.argsort(order_of[(s % np.uint64(SKETCH)).astype(np.int64)], kind="stable")[:keep]]
                    token.append(found.view(np.int64))
                    n.append(np.full(keep, len(s), np.int32))
                    sid.append(np.full(keep, key, np.int64))
                    pos.append(np.arange(keep, dtype=np.int32))
                if token:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (token, n, sid, pos)], names=["token", "n", "sid", "pos"])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, k) for k in (np.int64, np.int32, np.int64, np.int32)]
        before = False  # whether the held row matches the one before it

        def cut(cols, last: bool):
            nonlocal held, before
            token, n, sid, _ = cols
            if len(token) > 1:
                new = _grow(np.array([True]), (token[1:] != token[:-1]) | (sid[1:] != sid[:-1]) | (n[1:] != n[:-1]))
                cols = [c[new] for c in cols]
                token, n, sid, _ = cols
            meets = (token[1:] == token[:-1]) & (rule.percent * n[1:].astype(np.int64) <= 100 * n[:-1].astype(np.int64))
            keep = _grow(np.array([before]), meets) | _grow(meets, np.array([False]))
            if not last:
                held, before = [c[-1:] for c in cols], bool(meets[-1]) if len(meets) else before
                keep = keep[:-1]
            out = [c[: len(keep)][keep] for c in cols]
            if len(out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["token", "n", "sid", "pos"])

        for batch in batches:
            if batch.num_rows:
                yield from cut([_grow(h, batch.column(k).to_numpy()) for k, h in enumerate(held)], False)
        if len(held[0]):
            yield from cut(held, True)

    schema = "token long, n int, sid long, pos int"
    rows = map_arrow(texts.where("doc_id IS NOT NULL"), post, schema).repartition(partitions(spark), "token")
    return staged(map_arrow(rows.sortWithinPartitions("token", "n", "sid"), near, schema), "lists")


def _may_match(rule: Rule, n1, p1, n2, p2):
    """Whether a token at these positions can be the first that two sets share, n1 <= n2: only what follows it can be shared too.

    Sets that link do meet at their first shared token, so a pair that passes nowhere is no link."""
    n1, n2, p1, p2 = (x.astype(np.int64) for x in (n1, n2, p1, p2))
    most = np.minimum(n1 - p1, n2 - p2)
    return (rule.percent * n2 <= 100 * n1) & ((100 + rule.percent) * most >= rule.percent * (n1 + n2))


def _pair_batch(a, b) -> pa.RecordBatch:
    low, high = np.minimum(a, b), np.maximum(a, b)
    pairs = np.unique(np.stack([low, high], 1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, k])) for k in (0, 1)], names=["a", "b"])


def leader_pairs(lists: DataFrame, rule: Rule) -> DataFrame:
    """First round: (a, b) of each set of a block (token, size class) and the block's leader.

    The leader is the set that meets the token first: of near copies, the one with the fewest shingles of its own. Leaders
    are found map-side and joined back, so a block that holds a third of all sets is split like any skewed join."""
    sized = lists.select("token", F.floor(F.log(F.col("n").cast("double")) * 8).cast("int").alias("size"), "sid", "n", "pos")
    lead = staged(sized.groupBy("token", "size").agg(F.min(F.struct("pos", "sid", "n")).alias("lead")), "leads")
    met = sized.join(lead, ["token", "size"]).where("sid <> lead.sid")
    small, large = F.least("n", "lead.n"), F.greatest("n", "lead.n")
    room = F.least(F.col("n") - F.col("pos"), F.col("lead.n") - F.col("lead.pos"))
    good = (rule.percent * large <= 100 * small) & ((100 + rule.percent) * room >= rule.percent * (small + large))
    return met.where(good).select(F.least("sid", "lead.sid").alias("a"), F.greatest("sid", "lead.sid").alias("b")).distinct()


def size_block(n: Column, rule: Rule) -> Column:
    """Block of a size: sets that may link are in one block or in two that follow each other."""
    return F.floor(F.log(n.cast("double")) / max(math.log(100 / rule.percent) * 1.0001, 1e-9))


def list_cells(lists: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """Postings dealt to cells (cell, n, sid, pos, label, part, own) such that every pair that may link meets in one.

    A list falls into blocks of sizes; a posting goes to its own block and, as a guest, to the next. A whole block is skipped
    if it holds one group only, or no posting early enough in its set to be the smaller of a pair. Blocks of over CELL
    postings are cut into parts by a hash, and every two parts are a cell, so no list is one task's."""
    marked = lists.join(labels, "sid", "left").select("token", "n", "sid", "pos", F.coalesce("label", "sid").alias("label"), F.col("label").isNotNull().alias("grouped"))
    marked = marked.withColumn("label", F.xxhash64("grouped", "label")).drop("grouped").withColumn("block", size_block(F.col("n"), rule))
    places = F.array(F.struct("block", F.lit(True).alias("own")), F.struct((F.col("block") + 1).alias("block"), F.lit(False).alias("own")))
    placed = staged(marked.select("token", F.explode(places).alias("place"), "n", "sid", "pos", "label").select("token", "place.*", "n", "sid", "pos", "label"), "placed")
    early = F.expr(f"{100 + rule.percent} * (n - pos) >= {2 * rule.percent} * n")
    blocks = placed.groupBy("token", "block").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("x"), F.max("label").alias("y"), F.max("own").alias("owned"), F.max(early).alias("early"))
    blocks = staged(blocks.where("owned AND early AND x <> y").select("token", "block", F.ceil(F.col("size") / CELL).alias("parts")), "blocks")
    met = placed.join(blocks, ["token", "block"]).withColumn("part", F.pmod(F.xxhash64("sid"), F.col("parts")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    return met.withColumn("other", other).select(F.xxhash64("token", "block", F.least("part", "other"), F.greatest("part", "other")).alias("cell"), "n", "sid", "pos", "label", "part", "own", (F.col("part") == F.col("other")).alias("inner"))


def list_pairs(lists: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """Second round: pairs of a list whose sets are in different groups. ``labels`` has sid and label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None

        def pairs(cols):
            cell, n, sid, pos, label, part, own, inner = cols
            i, step, found, size = np.arange(len(cell)), 0, [], 0
            while len(i):
                step += 1
                i = i[i + step < len(cell)]
                j = i + step
                # Sizes ascend within a cell: past the first that is too large, the whole rest is skipped.
                i = i[(cell[i] == cell[j]) & (rule.percent * n[j].astype(np.int64) <= 100 * n[i].astype(np.int64))]
                j = i + step
                good = (label[i] != label[j]) & (own[i] | own[j]) & (inner[i] | (part[i] != part[j])) & _may_match(rule, n[i], pos[i], n[j], pos[j])
                found.append((sid[i][good], sid[j][good]))
                size += int(good.sum())
                if size > PAIRS:
                    yield _pair_batch(*(np.concatenate(x) for x in zip(*found, strict=True)))
                    found, size = [], 0
            if size:
                yield _pair_batch(*(np.concatenate(x) for x in zip(*found, strict=True)))

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(8)]
            if held is not None:
                cols = [_grow(h, c) for h, c in zip(held, cols, strict=True)]
            edge = int(np.searchsorted(cols[0], cols[0][-1]))  # the last cell may go on
            yield from pairs([c[:edge] for c in cols])
            held = [c[edge:] for c in cols]
        if held is not None:
            yield from pairs(held)

    dealt = list_cells(lists, labels, rule).repartition(partitions(lists.sparkSession), "cell").sortWithinPartitions("cell", "n", "sid")
    return map_arrow(dealt, run, "a long, b long").distinct()


def plausible(pairs: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Pairs whose histograms leave room for the overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.to_pydict()
            good = [(100 + rule.percent) * most_overlap(*x) >= rule.percent * (x[0] + x[2]) for x in zip(d["n1"], d["h1"], d["n2"], d["h2"], strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    side = nodes.select("sid", "n", "hist")
    met = pairs.join(side.toDF("a", "n1", "h1"), "a").join(side.toDF("b", "n2", "h2"), "b")
    return staged(map_arrow(met.select("a", "b", "n1", "h1", "n2", "h2"), run, "a long, b long"), "plausible")


def fetch_sets(texts: DataFrame, nodes: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """Sets (sid, shingles) of the wanted set ids, read from one document each; a filter of bounded size keeps other texts from moving."""
    reps = staged(nodes.join(wanted.distinct(), "sid", "left_semi").select("sid", "rep"), "wanted")
    hashes = reps.select(F.xxhash64("rep").alias("_h"))
    bits = min(FILTER_BITS, max(1024, BITS_PER_ROW * reps.count()))
    words = staged(repeated_filter(hashes.unionAll(hashes), bits), "bloom")
    near = maybe_repeated(texts.withColumn("_h", F.xxhash64("doc_id")), words, bits).where("_maybe AND doc_id IS NOT NULL").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, values in in_parts(batch.column(1)):
                sets = list(shingle_sets(values, rule.words))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([set_id(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["rep", "sid", "shingles"])

    found = map_arrow(near, run, "rep long, sid long, shingles binary")
    return staged(found.join(reps, ["sid", "rep"], "left_semi").dropDuplicates(["sid"]).select("sid", "shingles"), "sets")


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, both: exact intersection sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                both = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in zip(part.column("x").to_pylist(), part.column("y").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(both, pa.int64())], names=["a", "b", "both"])

    met = pairs.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b")
    return staged(map_arrow(met.select("a", "b", "x", "y"), run, "a long, b long, both long"), "overlaps")


def _sized(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    side = nodes.select("sid", "n", "rep")
    return pairs.join(side.toDF("a", "n1", "r1"), "a").join(side.toDF("b", "n2", "r2"), "b")


def _links(rule: Rule, both="both"):
    return F.expr(f"100 * ({both}) >= {rule.percent} * (n1 + n2 - ({both}))")


def components(edges: DataFrame) -> DataFrame:
    """v, label: the smallest node each node reaches, by label propagation with pointer jumping. ``edges`` has u and v."""
    both = staged(edges.select("u", "v").unionAll(edges.select("v", "u")).distinct().toDF("u", "v"), "edges")
    labels = staged(both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("label")), "labels")
    while True:
        heard = both.join(labels.toDF("u", "label"), "u").select("v", "label").unionAll(labels.select("v", "label"))
        spread = staged(heard.groupBy("v").agg(F.min("label").alias("label")), "labels")
        jumped = spread.join(spread.toDF("label", "far"), "label", "left").select("v", F.least("label", "far").alias("label"))
        new = staged(jumped, "labels")
        moved = new.join(labels.toDF("v", "old"), "v").where("label <> old").limit(1).count()
        labels = new
        if not moved:
            return labels


def link(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n, sid) and set groups (sid, n, component): the smallest id reachable by links."""
    texts = _texts(docs, id_col, text_col)
    rows, classes = profile(texts, rule)
    nodes = staged(rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("sid", "n").agg(F.min("doc_id").alias("rep"), F.min("hist").alias("hist")), "nodes")
    lists = index_lists(texts, classes, rule)
    first = plausible(leader_pairs(lists, rule), nodes, rule)
    sets = fetch_sets(texts, nodes, first.select(F.col("a").alias("sid")).unionAll(first.select(F.col("b").alias("sid"))), rule)
    near = staged(_sized(overlaps(first, sets), nodes).where(_links(rule)), "near")
    labels = components(near.select(F.col("r1").alias("u"), F.col("r2").alias("v")))
    by_set = staged(nodes.join(labels.toDF("rep", "label"), "rep").select("sid", "label"), "by_set")
    # A set's leader is the smallest set id it links with; its distances to and from the leader are known.
    led = near.groupBy(F.col("b").alias("sid")).agg(F.min(F.struct("a", (F.col("n2") - F.col("both")).alias("own"), (F.col("n1") - F.col("both")).alias("other"))).alias("l"))
    led = staged(led.select("sid", F.col("l.a").alias("lead"), F.col("l.own").alias("own"), F.col("l.other").alias("other")), "leaders")
    second = plausible(list_pairs(lists, by_set, rule), nodes, rule)
    for side in "ab":
        own = [F.coalesce(x, y).alias(f"{k}_{side}") for k, x, y in (("lead", F.col("lead"), F.col(side)), ("own", F.col("own"), F.lit(0)), ("other", F.col("other"), F.lit(0)))]
        second = second.join(led.withColumnRenamed("sid", side), side, "left").select(*[c for c in second.columns], *own)
    second = staged(second, "second")
    low, high = F.least("lead_a", "lead_b"), F.greatest("lead_a", "lead_b")
    leads = second.where("lead_a <> lead_b").select(low.alias("a"), high.alias("b")).distinct()
    wanted = second.select(F.explode(F.array("a", "b", "lead_a", "lead_b")).alias("sid"))
    sets = fetch_sets(texts, nodes, wanted, rule)
    known = overlaps(leads, sets).toDF("low", "high", "both")
    met = _sized(second.withColumn("low", low).withColumn("high", high).join(known, ["low", "high"], "left"), nodes)
    met = staged(met.withColumn("most", F.expr("both + own_a + own_b")).withColumn("least", F.expr("both - other_a - other_b")), "derived")
    sure = met.where(_links(rule, "least"))
    open_ = met.where(F.col("both").isNull() | (_links(rule, "most") & ~_links(rule, "least"))).select("a", "b")
    exact = _sized(overlaps(open_, sets), nodes).where(_links(rule))
    # Sets of rows that share an id are one document's.
    own = rows.where("n > 0 AND doc_id IS NOT NULL")
    many = own.groupBy("doc_id").agg(F.min("sid").alias("x"), F.max("sid").alias("y")).where("x <> y").select("doc_id")
    same = own.join(many, "doc_id", "left_semi").join(nodes.select("sid", "n", "rep"), ["sid", "n"]).select("rep", "doc_id").distinct()
    edges = near.select("r1", "r2").unionAll(sure.select("r1", "r2")).unionAll(exact.select("r1", "r2")).unionAll(same).toDF("u", "v")
    groups = components(edges)
    found = nodes.join(groups.toDF("rep", "label"), "rep", "left").select("sid", "n", F.coalesce("label", "rep").alias("component"))
    return rows, staged(found, "found")


def near_duplicates(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    rows, found = link(docs, rule, id_col, text_col)
    met = rows.select("doc_id", "n", "sid").join(found, ["sid", "n"], "left")
    return met.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, rule: Rule = Rule(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without those of a group whose id is not the group's smallest; only texts that may go move."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = F.coalesce(F.col(id_col).cast("long"), F.lit(1 << 62) + F.pmod(F.xxhash64(text), F.lit(1 << 61)))  # null ids come last
    keyed = docs.select(own.alias("doc_id"), text.alias("text"))
    gone = near_duplicates(keyed, rule).where("component_id <> doc_id").select("doc_id").distinct()
    gone = staged(gone.select(F.xxhash64("doc_id").alias("_h"), "doc_id"), "gone")
    bits = min(FILTER_BITS, max(1024, BITS_PER_ROW * gone.count()))
    words = staged(repeated_filter(gone.select("_h").unionAll(gone.select("_h")), bits), "bloom")
    held = docs.select(row_of(docs).alias("_doc"), own.alias("_key")).withColumn("_h", F.xxhash64("_key"))
    tested = maybe_repeated(held, words, bits)
    met = tested.where("_maybe").join(gone.select("doc_id"), F.col("_key") == F.col("doc_id"), "left_anti")
    return tested.where("NOT _maybe").select("_doc.*").unionByName(met.select("_doc.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
