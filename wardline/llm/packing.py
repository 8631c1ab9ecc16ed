"""Operator 1, packing: deficit round-robin over source queues fills windows to target token proportions.

Each source is a queue of units (whole documents, longer ones in units of ``UNIT`` tokens). In each round every queue gains
a quantum of window x its target share and sends the units that its credit covers; what is left is carried to the next
round. A unit is thus sent in round ceil(tokens queued up to its end / quantum), so the schedule needs no loop: two
distributed prefix sums over small rows give every unit its place in the stream, deficits carried across windows and
partitions. The stream is cut every ``window`` tokens; what is over is cut into powers of two, so nothing is padded.

No task gathers a source: prefix sums run within range partitions, and only one sum per partition and source is joined.
Texts do not shuffle; ids do once, as compressed bytes, to meet their pieces.

Defined results: null and empty texts are documents of just the end id; a null source is a queue of its own, first in
order; repeated rows and ids are packed each; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.common import map_arrow, partitions, staged, table
from wardline.llm.tokens import in_parts, word_encoder

TOKENIZER, END_ID, WINDOW, UNIT = "word_bpe_49k.json", 2, 4096, 1024


def queue(source: Column) -> Column:
    """Name of a source's queue; that of a null source is empty, and no other is."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """_row, doc_id, source, n, ids: a staged row per document; ids are compressed little-endian integers."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder, pack = word_encoder(tokenizer), zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for a, b, texts in in_parts(batch.column(3), 1 << 20):
                ids, count = encoder.encode(texts)
                parts = [np.append(x, encoder.dtype(end_id)) for x in np.split(ids, np.cumsum(count)[:-1])]
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(a, b - a) for k in range(3)), pa.array(count + 1, pa.int64()), pa.array([pack(x.tobytes()) for x in parts], pa.binary())], names=["_row", "doc_id", "source", "n", "ids"])

    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).cast("long").alias("doc_id"), queue(F.col(source_col)).alias("source"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    return staged(map_arrow(rows, encode, "_row long, doc_id long, source string, n long, ids binary"), "ids")


def running(df: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """Adds ``_end``, the sum of value up to and with each row in its group, and ``_total`` of the group; no task holds a group."""
    parts = partitions(df.sparkSession)
    ranged = staged(df.repartitionByRange(parts, *group, *order).withColumn("_part", F.spark_partition_id()), "ranged")
    key = [*group, "_part"]
    sums = ranged.groupBy(*key).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_part")
    whole = Window.partitionBy(*group)
    sums = sums.select(*key, F.coalesce(F.sum("_sum").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_sum").over(whole).alias("_total"))
    inside = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.withColumn("_in", F.sum(value).over(inside)).join(staged(sums, "sums"), key).withColumn("_end", F.col("_in") + F.col("_before")).drop("_in", "_before", "_part")


def schedule(docs: DataFrame, window: int = WINDOW, unit: int = UNIT, weights: dict[str, float] | None = None) -> DataFrame:
    """Place of every piece: _row, start, length, sequence_id, offset. ``docs`` has _row, source (a queue's name) and n; weights, by source, defaults to each source's share of the tokens."""
    units = docs.select("_row", "source", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(unit).cast("long"))).alias("start"))
    units = units.withColumn("size", F.least(F.lit(unit).cast("long"), F.col("n") - F.col("start"))).drop("n")
    tokens = docs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    queued = running(units, ["source"], ["_row", "start"], "size")
    if weights:
        whole = sum(weights.values())
        share = F.coalesce(F.create_map(*(F.lit(x) for k, w in weights.items() for x in (f"={k}", w / whole)))[F.col("source")], F.lit(1e-9))
    else:
        share = F.col("_total") / F.lit(float(max(tokens, 1)))
    rounds = queued.select("_row", "start", "size", "source", F.ceil(F.col("_end") / (share * window)).alias("round"))
    rounds = rounds.withColumn("_all", F.lit(0))
    placed = running(rounds, ["_all"], ["round", "source", "_row", "start"], "size").select("_row", "start", "size", (F.col("_end") - F.col("size")).alias("at"))
    full = tokens // window
    edges = [full * window]  # the rest is cut into powers of two
    for k in range(window.bit_length(), -1, -1):
        if (tokens % window) >> k & 1:
            edges.append(edges[-1] + (1 << k))
    tail = F.array(*(F.lit(e).cast("long") for e in edges))
    first, stop = F.col("at"), F.col("at") + F.col("size")
    # A unit that is longer than a window meets several of its edges.
    inner = F.filter(F.sequence(F.floor(first / window) + 1, F.floor((stop - 1) / window) + 1), lambda k: k <= full)
    cuts = F.concat(F.array(first), F.filter(F.array_sort(F.array_distinct(F.concat(F.transform(inner, lambda k: k * window), tail))), lambda c: (c > first) & (c < stop)))
    pieces = placed.withColumn("cuts", cuts).select("_row", "start", "at", "size", "cuts", F.posexplode("cuts").alias("k", "cut"))
    end = F.coalesce(F.get("cuts", F.col("k") + 1), F.col("at") + F.col("size"))
    seq = F.when(F.col("cut") < full * window, F.floor(F.col("cut") / window)).otherwise(full - 1 + F.size(F.filter(tail, lambda e: e <= F.col("cut"))))
    begin = F.when(F.col("cut") < full * window, F.floor(F.col("cut") / window) * window).otherwise(F.array_max(F.filter(tail, lambda e: e <= F.col("cut"))))
    return pieces.select("_row", (F.col("start") + F.col("cut") - F.col("at")).alias("start"), (end - F.col("cut")).alias("length"), seq.cast("long").alias("sequence_id"), (F.col("cut") - begin).alias("offset"))


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, window: int = WINDOW, unit: int = UNIT, weights: dict[str, float] | None = None, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` ids: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, and the ids themselves (unsigned 32-bit, little-endian) if with_ids."""
    rows = tokenized(docs, tokenizer, end_id, id_col, text_col, source_col)
    pieces = schedule(rows.select("_row", "source", "n"), window, unit, weights)
    by_doc = pieces.groupBy("_row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    named = F.expr("if(source <> '', substring(source, 2), null)").alias("source")
    met = rows.join(by_doc, "_row").select("doc_id", named, "n", "ids", "pieces")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack, dtype = zstandard.ZstdDecompressor().decompress, word_encoder(tokenizer).dtype
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"] + ["ids"] * with_ids
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                lists, flat = part.column("pieces"), part.column("pieces").flatten()
                own = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy(zero_copy_only=False))
                start, length = flat.field("start").to_numpy(), flat.field("length").to_numpy()
                bytes_of = [np.frombuffer(unpack(x), dtype).astype("<u4").tobytes() for x in part.column("ids").to_pylist()]
                found = [bytes_of[d][4 * a : 4 * (a + n)] for d, a, n in zip(own.tolist(), start.tolist(), length.tolist(), strict=True)]
                take = pa.array(own)
                cols = [part.column("doc_id").take(take), flat.field("start"), flat.field("length"), pa.array([zlib.crc32(x) for x in found], pa.int64()), part.column("n").take(take), flat.field("sequence_id"), flat.field("offset"), part.column("source").take(take)]
                yield pa.RecordBatch.from_arrays(cols + [pa.array(found, pa.binary())] * with_ids, names=names)

    return map_arrow(met, cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string" + ", ids binary" * with_ids)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
