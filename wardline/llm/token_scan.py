"""Operator 6, token counts: a separator scan over flat, unindexed token files.

A token file is nothing but ids, each document ended by one end-of-document id. Files are read in blocks of fixed size,
wherever documents begin; in each block a vectorised search finds the separators. What a block holds before its first and
after its last separator belongs to documents that cross its edges: a prefix scan over one small row per block carries the
open length on, and the start and number of documents. A block is any task's work, so neither a file nor a document of any
length is one task's.

write_token_files() makes such files of a table (one a task, with the ids of the documents in file order beside them);
scan_token_files() needs just the files. Files live in the shared folder and are opened through pyarrow's file systems.

Defined results: null and empty texts are documents of 0 tokens; repeated rows and null ids count each; ids after the last
separator of a file are an unended document, reported with ended false; empty files and tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.common import fresh_path, map_arrow, staged, table
from wardline.llm.tokens import in_parts, word_encoder

TOKENIZER, END_ID = "word_bpe_49k.json", 49407
#: Tokens in a block: 1 MB of 16-bit ids.
BLOCK = 1 << 19


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri.removeprefix('file:')}")


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Staged rows of files (path, n_tokens) and of documents (path, ordinal, doc_id). The strings of special tokens in a text are ordinary text, so no id within one is the end id."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        encoder = word_encoder(tokenizer, True)
        system, base = _open(folder)
        system.create_dir(base, recursive=True)
        path, done, ordinal = f"{base}/{uuid.uuid4().hex}.tokens", 0, 0  # a task that runs again writes another file
        with system.open_output_stream(path) as out:
            for batch in batches:
                for a, b, values in in_parts(batch.column(1), 1 << 20):
                    ids, count = encoder.encode(values)
                    ids = np.insert(ids, np.cumsum(count), end_id)
                    out.write(ids.astype(encoder.dtype).tobytes())
                    done += len(ids)
                    yield pa.RecordBatch.from_arrays([pa.array([path] * (b - a)), pa.array(np.arange(ordinal, ordinal + b - a)), batch.column(0).slice(a, b - a), pa.nulls(b - a, pa.int64())], names=["path", "ordinal", "doc_id", "n_tokens"])
                    ordinal += b - a
        if ordinal:
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([done])], names=["path", "ordinal", "doc_id", "n_tokens"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    rows = staged(map_arrow(texts, write, "path string, ordinal long, doc_id long, n_tokens long"), "token-files")
    return rows.where("n_tokens IS NOT NULL").select("path", "n_tokens"), rows.where("n_tokens IS NULL").select("path", "ordinal", "doc_id")


def scan_token_files(files: DataFrame, folder: str, end_id: int = END_ID, dtype: str = "uint16", block: int = BLOCK) -> DataFrame:
    """path, ordinal, start, n_tokens, ended: a row per document; ``files`` has path and n_tokens."""
    width = np.dtype(dtype).itemsize
    blocks = files.where("n_tokens > 0").select("path", "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tokens") - 1, F.lit(block).cast("long"))).alias("at"))
    blocks = blocks.select("path", "at", F.least(F.lit(block).cast("long"), F.col("n_tokens") - F.col("at")).alias("size"), (F.col("at") + block >= F.col("n_tokens")).alias("last"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = _open(folder)
        for batch in batches:
            for path, at, size, last in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                with system.open_input_file(path) as f:
                    ids = np.frombuffer(f.read_at(size * width, at * width), dtype)
                ends = np.flatnonzero(ids == end_id).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([at]), pa.array([size]), pa.array([last]), pa.array([ends.tolist()], pa.list_(pa.int64()))], names=["path", "at", "size", "last", "ends"])

    found = staged(map_arrow(blocks.repartition(max(1, blocks.count() // 4), "path", "at"), search, "path string, at long, size long, last boolean, ends array<long>"), "blocks")
    small = found.select("path", "at", "size", F.size("ends").alias("n"), F.element_at("ends", -1).alias("final"))
    # Prefix scan over one row per block: documents ended before it, and where the open one starts.
    before = Window.partitionBy("path").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    carried = small.select("path", "at", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("done"), F.coalesce(F.max(F.when(F.col("n") > 0, F.col("at") + F.col("final") + 1)).over(before), F.lit(0)).alias("open"))
    met = found.join(carried, ["path", "at"])
    stops = F.when(F.col("last") & ((F.size("ends") == 0) | (F.element_at("ends", -1) < F.col("size") - 1)), F.concat("ends", F.array("size"))).otherwise(F.col("ends"))
    rows = met.select("path", "at", "done", "open", "ends", F.posexplode(stops).alias("k", "stop"))
    start = F.when(F.col("k") == 0, F.col("open")).otherwise(F.col("at") + F.get("ends", F.col("k") - 1) + 1)
    return rows.select("path", (F.col("done") + F.col("k")).cast("long").alias("ordinal"), start.cast("long").alias("start"), (F.col("at") + F.col("stop") - start).cast("long").alias("n_tokens"), (F.col("k") < F.size("ends")).alias("ended"))


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens of every document, by way of flat token files."""
    folder = fresh_path(docs.sparkSession, "flat")
    files, owners = write_token_files(docs, folder, tokenizer, end_id, id_col, text_col)
    return owners.join(scan_token_files(files, folder, end_id, np.dtype(word_encoder(tokenizer, True).dtype).name, block).where("ended"), ["path", "ordinal"]).select("doc_id", "n_tokens")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
