"""Token ids in binary shards: one Zstandard frame per document, a shared dictionary, an offset index.

A shard is ``MAGIC``, the frames in ascending doc_id order, the index, the length of the index
(4 bytes) and ``MAGIC``. The index is JSON packed by Zstandard: the SHA-256 of the dictionary, the bytes of an
id, and per document its id, number of tokens and frame offset. The dictionary lies beside the
shards as ``dictionary-<hash>``.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.common import id_and_text, open_folder, per_slice, shared_dictionary, small_sample, space_pieces, write_file
from tidewell.session import stage

MAGIC = b"TOKSTOR1"
SHARD_BYTES = 32 << 20
#: The dictionary is trained on slices of so many characters of so many documents at most, those with the smallest hashes.
SAMPLE_DOCS, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 8_000, 64 << 10
#: Bytes of shards that one task reads back.
READ_BYTES = 64 << 20
MANIFEST = "shard int, part int, path string, docs long, tokens long, bytes long"
INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: How the byte-level alphabet shows a space.
SPACE = "\u0120"
#: White space other than space and newline, in ASCII and beyond.
RARE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
RARE_WIDE = RARE + "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))


class Encoder:
    """Encodes texts with a tokenizer file, each distinct piece of text once.

    The pre-tokenizer always starts a token at a single space between other characters, so a text
    is cut there; equal pieces have equal ids. Texts with a special token are encoded whole.
    At most two generations of about ``memory`` pieces are remembered (some 400 bytes each); pieces
    that are used again move to the newer one, so that only rare ones are encoded anew.
    """

    def __init__(self, tokenizer: str, end_id: int, memory: int = 250_000) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        spec = json.loads(self.tokenizer.to_str())
        rule = spec.get("pre_tokenizer") or {}
        self.cut = (
            rule.get("type") == "ByteLevel" and rule.get("use_regex") and not rule.get("add_prefix_space")
            and not spec.get("normalizer") and not any(t["normalized"] or t["single_word"] for t in spec["added_tokens"])
        )
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.width = 2 if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.code = "H" if self.width == 2 else "I"
        self.end = np.array([end_id], self.dtype).tobytes()
        self.memory, self.known, self.former = memory, {}, {}
        self.spaced = np.zeros(1 << 8 * self.width if self.width == 2 else self.tokenizer.get_vocab_size(), bool)
        self.spaced[[i for t, i in self.tokenizer.get_vocab().items() if t.startswith(SPACE)]] = True

    def _ids(self, texts: list[str]) -> list[bytes]:
        found: list[bytes] = []
        for i in range(0, len(texts), 4096):
            done = self.tokenizer.encode_batch_fast(texts[i : i + 4096], add_special_tokens=False)
            found += [array(self.code, e.ids).tobytes() for e in done]
        return found

    def _learn(self, new: list[str]) -> None:
        """Ids of new pieces, many to a call: joined by spaces, each starts at a token that has its space."""
        alone = new if not self.cut else [t for t in new if " " in t]
        self.known.update(zip(alone, self._ids([" " + t for t in alone])))
        joined = [] if not self.cut else [t for t in new if " " not in t]
        for i in range(0, len(joined), 1 << 16):
            part = joined[i : i + (1 << 16)]
            raw = b"".join(self._ids([" " + " ".join(part[k : k + 512]) for k in range(0, len(part), 512)]))
            first = (np.flatnonzero(self.spaced[np.frombuffer(raw, self.dtype)]) * self.width).tolist()
            if len(first) == len(part):
                self.known.update(zip(part, map(raw.__getitem__, map(slice, first, [*first[1:], len(raw)]))))
            else:  # a vocabulary with spaces inside tokens
                self.known.update(zip(part, self._ids([" " + t for t in part])))

    def _plain(self, text: str) -> bool:
        """Whether a token starts at each space of the text, all of which stand between other characters."""
        if not self.cut or any(s in text for s in self.special):
            return False
        if "  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " ":
            return False
        return not any(c in text for c in (RARE if text.isascii() else RARE_WIDE))

    def _recall(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, each given without the space before it."""
        if len(self.known) > self.memory:
            self.former, self.known = self.known, {}
        known, former = self.known, self.former
        self._learn([t for t in pieces if t not in known and t not in former])
        known.update((t, former[t]) for t in pieces if t not in known)
        return list(map(known.__getitem__, pieces))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text and the end id, as little-endian bytes of ``width``."""
        found = [self.end] * len(texts)
        plain, odd = [], []
        for i, t in enumerate(texts):
            if t:
                (plain if self._plain(t) else odd).append(i)
        if plain:
            pieces, code, first = space_pieces([texts[i] for i in plain])
            heads = self._ids([texts[i].split(" ", 1)[0] for i in plain])
            cells = self._recall(pieces) + heads
            code = code.astype(np.int64)
            code[first[:-1]] = len(pieces) + np.arange(len(plain))
            size = np.fromiter(map(len, cells), np.int64, len(cells)) // self.width
            start = np.cumsum(size) - size
            ids = np.frombuffer(b"".join(cells), self.dtype)
            sizes = size[code]
            ends = np.cumsum(sizes)
            out = ids[np.repeat(start[code] - (ends - sizes), sizes) + np.arange(ends[-1])]
            stops = ends[first[1:] - 1].tolist()
            for i, a, b in zip(plain, [0, *stops], stops):
                found[i] = out[a:b].tobytes() + self.end
        for i in odd:
            if self.cut and not any(s in texts[i] for s in self.special):
                head, *rest = INNER_SPACE.split(texts[i])
                distinct = list(set(rest))
                known = dict(zip(distinct, self._recall(distinct)))
                found[i] = self._ids([head])[0] + b"".join(map(known.__getitem__, rest)) + self.end
            else:
                found[i] = self._ids([texts[i]])[0] + self.end
        return found


@lru_cache(maxsize=1)
def encoder(tokenizer: str, end_id: int) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per Spark task
    return Encoder(tokenizer, end_id)


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int) -> bytes:
    """A dictionary from the ids of slices of a bounded sample of documents; empty only where no text is.

    Documents of any length are eligible. Where there are too few samples to train on, or they are
    too alike, the samples themselves are the dictionary's content. One task encodes the sample and
    trains: the driver gets the dictionary and needs no encoder.
    """

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if texts := [t for batch in batches for t in batch.column("text").to_pylist()]:
            found = shared_dictionary(encoder(tokenizer, end_id).encode(texts), DICTIONARY_BYTES)
            yield pa.RecordBatch.from_arrays([pa.array([found], pa.binary())], ["dictionary"])

    some = small_sample(docs.where("text <> ''").select("doc_id", "text"), F.xxhash64("doc_id", "text"), SAMPLE_DOCS)
    first = F.pmod(F.xxhash64("text"), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0)) + 1) + 1
    # The sample is in one partition, in the order of its hashes.
    texts = some.select(F.col("text").substr(first.cast("int"), F.lit(SAMPLE_CHARS)).alias("text")).coalesce(1)
    return b"".join(bytes(r["dictionary"]) for r in texts.mapInArrow(train, "dictionary binary").collect())


def pack_shard(dictionary: bytes, width: int, docs: list[int | None], tokens: list[int], frames: list[bytes]) -> list[bytes]:
    offsets = [len(MAGIC)]
    for f in frames:
        offsets.append(offsets[-1] + len(f))
    index = {"dictionary": hashlib.sha256(dictionary).hexdigest(), "width": width, "docs": docs, "tokens": tokens, "offsets": offsets}
    packed = zstandard.compress(json.dumps(index).encode())
    return [MAGIC, *frames, packed, len(packed).to_bytes(4, "little"), MAGIC]


class Shard:
    """Random access to one shard: reads the index, then only the frames asked for."""

    def __init__(self, path: str, dictionary: bytes) -> None:
        fs, place = open_folder(path)
        self.file = fs.open_input_file(place)
        size = self.file.size()
        tail = self.file.read_at(12, size - 12)
        if tail[4:] != MAGIC or self.file.read_at(8, 0) != MAGIC:
            raise ValueError(f"{path} is not a token shard")
        n = int.from_bytes(tail[:4], "little")
        index = json.loads(zstandard.decompress(self.file.read_at(n, size - 12 - n)))
        if index["dictionary"] != hashlib.sha256(dictionary).hexdigest():
            raise ValueError(f"{path} needs another dictionary")
        self.docs, self.tokens, self.offsets, self.width = (index[k] for k in ("docs", "tokens", "offsets", "width"))
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.reader = zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor()

    def ids(self, i: int) -> np.ndarray:
        """The ids of the document at place ``i``, with the end id."""
        frame = self.file.read_at(self.offsets[i + 1] - self.offsets[i], self.offsets[i])
        return np.frombuffer(self.reader.decompress(frame), f"<u{self.width}")

    def close(self) -> None:
        self.file.close()


def write_token_store(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
) -> tuple[DataFrame, bytes]:
    """Encode all texts and write shards to ``folder``; the manifest and the dictionary.

    Documents are in ascending doc_id order over the shards (null first; rows of one id in the
    order of their ids' bytes). A null text counts as empty: its document has the end id alone.
    An empty table gives no shard. ``base`` of the manifest is the number of ids in all shards before.
    A text of any length is encoded whole, in one task; columns other than these two are not read.
    """
    spark = docs.sparkSession
    docs = id_and_text(docs, id_col, text_col)
    dictionary = train_dictionary(docs, tokenizer, end_id)
    write_file(folder, hashlib.sha256(dictionary).hexdigest(), "dictionary", [dictionary])

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=3, dict_data=shared) if shared else zstandard.ZstdCompressor(level=3)
        ids = encoder(tokenizer, end_id)
        raw = ids.encode(batch.column("text").to_pylist())
        cells = [pa.array([len(r) // ids.width for r in raw], pa.int64()), pa.array([pack.compress(r) for r in raw], pa.binary())]
        width = pa.array([ids.width] * len(raw), pa.int32())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *cells, width], ["doc_id", "n", "frame", "width"])

    encoded = stage(
        docs.mapInArrow(per_slice(encode), "doc_id long, n long, frame binary, width int").withColumn("tie", F.xxhash64("frame")),
        "token-frames",
    )
    size = encoded.agg(F.sum(F.length("frame"))).first()[0] or 0
    # The row's place in the staged table only splits rows that agree in all else.
    ordered = encoded.withColumn("row", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(1 + size // max(1, shard_bytes), "doc_id", "tie", "row").sortWithinPartitions("doc_id", "tie")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        attempt, part, held, width, ids, tokens, frames = f"{task.partitionId():07d}-{task.taskAttemptId()}", 0, 0, 0, [], [], []

        def flush() -> pa.RecordBatch:
            path, n = write_file(folder, f"{part:05d}.tok", attempt, pack_shard(dictionary, width, ids, tokens, frames))
            row = [task.partitionId(), part, path, len(ids), sum(tokens), n]
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64())
            names = ["shard", "part", "path", "docs", "tokens", "bytes"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

        for batch in batches:
            for doc, n, frame, width in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "frame", "width"))):
                ids.append(doc), tokens.append(n), frames.append(frame)
                held += len(frame)
                if held >= shard_bytes:
                    yield flush()
                    part, held, ids, tokens, frames = part + 1, 0, [], [], []
        if ids:
            yield flush()

    manifest = stage(ordered.select("doc_id", "n", "frame", "width").mapInArrow(write, MANIFEST), "token-manifest")
    # One row per shard: a running sum over file sizes, not over documents.
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))), dictionary


def read_token_store(manifest: DataFrame, dictionary: bytes) -> DataFrame:
    """One row per stored document: doc_id, start (ids of all documents before it), n_tokens, ids (binary, 32 bits each)."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(batch.column("path").to_pylist(), batch.column("base").to_pylist()):
                shard = Shard(path, dictionary)
                starts = base + np.concatenate(([0], np.cumsum(shard.tokens)))[:-1].astype(np.int64)
                at = 0
                while at < len(shard.docs):
                    end, cells, held = at, [], 0
                    while end < len(shard.docs) and held < 4 << 20:
                        cells.append(shard.ids(end).astype("<u4").tobytes())
                        held += len(cells[-1])
                        end += 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.docs[at:end], pa.int64()), pa.array(starts[at:end]),
                            pa.array([len(c) // 4 for c in cells], pa.int64()), pa.array(cells, pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )
                    at = end
                shard.close()

    files = manifest.select("path", "base")
    size = manifest.agg(F.sum("bytes")).first()[0] or 0
    tasks = max(manifest.sparkSession.sparkContext.defaultParallelism, size // READ_BYTES)
    return files.repartition(tasks).mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def read_document(manifest_rows: Iterable, dictionary: bytes, doc_id: int) -> list[np.ndarray]:
    """The ids of one document, by the index of the shards given."""
    found = []
    for row in manifest_rows:
        shard = Shard(row["path"], dictionary)
        found += [shard.ids(i) for i, d in enumerate(shard.docs) if d == doc_id]
        shard.close()
    return found


def id_checksums(stored: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the unsigned CRC-32 of the 32-bit ids."""
    return stored.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
