"""Helpers that several of these operators share."""

from __future__ import annotations

import posixpath
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import stage

#: Words of a text: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator works on, under fixed names; all others stay behind."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def slices(batch: pa.RecordBatch, text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of each part hold about ``limit`` bytes, one text at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_pylist()
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def per_slice(
    f: Callable[[pa.RecordBatch], pa.RecordBatch], text: str = "text", limit: int = 4 << 20
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function that applies ``f`` to parts of bounded size."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, limit):
                yield f(part)

    return run


def small_sample(df: DataFrame, digest: Column, rows: int) -> DataFrame:
    """The ``rows`` rows with the smallest hashes; only a share of the hash range is ever looked at.

    Hashes are uniform, so that a range with several times the rows wanted holds them. Rows that
    repeat a digest can make it hold more; at most ``rows`` are returned.
    """
    place = F.pmod(digest, F.lit(1 << 40))
    share = min(1.0, (4 * rows + 100) / max(1, df.count()))
    return df.where(place < int(share * (1 << 40))).orderBy(place).limit(rows)


def shared_dictionary(samples: list[bytes], limit: int) -> bytes:
    """A Zstandard dictionary of at most ``limit`` bytes; the samples themselves where they cannot train one."""
    if not (whole := b"".join(samples)):
        return b""
    try:
        return zstandard.train_dictionary(min(limit, max(256, len(whole) // 10)), samples).as_bytes()
    except zstandard.ZstdError:  # too few, too small or too alike
        return whole[-limit:]


def space_pieces(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts cut at each space: the distinct pieces, the piece numbers of all texts, and each text's first place."""
    import pyarrow.compute as pc

    pieces = pc.split_pattern(pa.array(texts, pa.string()), " ")
    coded = pieces.values.dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), pieces.offsets.to_numpy()


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a shared folder that tasks write plain files to."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else uri.replace("file:", "file://", 1))


def write_file(folder: str, name: str, attempt: str, blocks: Iterable[bytes]) -> tuple[str, int]:
    """Write a file under a name that only this task attempt uses; its path and size.

    A repeated or speculative task writes another file. Readers go by the manifest, which
    holds the files of the attempts that Spark committed.
    """
    fs, path = open_folder(folder)
    fs.create_dir(path, recursive=True)
    target, size = posixpath.join(path, f"{attempt}-{name}"), 0
    with fs.open_output_stream(target, compression=None) as out:  # the name does not say how to pack
        for block in blocks:
            out.write(block)
            size += len(block)
    return posixpath.join(folder, f"{attempt}-{name}"), size


def union(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Join the sets of the given pairs, in place; ``label`` holds the smallest place of each one's set."""
    while True:
        a, b = label[left], label[right]
        if not (apart := a != b).any():
            return
        left, right = left[apart], right[apart]
        np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not np.array_equal(up := label[label], label):
            label[:] = up


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """Connected components of the undirected graph of ``edges`` (a, b): rows (node, component).

    ``component`` is the smallest node reachable. Alternates large-star and small-star rounds,
    each a join on the node; a written table cuts the lineage after each of them, and the joins are
    sorted ones, so that the driver holds a small plan and no table, however many partitions there are.
    The number of rounds grows with the logarithm of the component size. No edges give no rows.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b").union(e.select(e.b, e.a)) if large else e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        near = both.join(least.hint("merge"), "a")
        if large:
            return near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        hooked = near.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return hooked.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), purpose)
    seen = mark(now)
    while seen[0]:
        now = stage(star(stage(star(now, True), purpose), False), purpose)
        if (new := mark(now)) == seen:
            break
        seen = new
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return members.union(now.select("b", "b")).distinct()
