"""Token counts by rank-synchronous merging of batched pre-tokens, held as ragged numpy arrays."""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import id_and_text, per_slice, space_pieces

SPACE = "▁"
RUNS = re.compile(f"{SPACE}+[^{SPACE}]*")
NONE = np.int64(1 << 40)


class PieceCounter:
    """Counts the pieces of a BPE model with byte fallback.

    No piece holds a space mark behind another character, so that no merge crosses the start of
    a space run: a text falls into pre-tokens that are merged apart from each other, and equal
    pre-tokens have equal counts. Pre-tokens are cut further at character pairs that occur in no
    piece. Each round merges, in all sequences at once, every occurrence of the sequence's best
    pair. That equals one merge at a time, because a piece always ranks behind its parts.

    ``memory``: how many pre-tokens keep their count between batches; as many again are kept from
    the generation before, and those still in use move over.
    """

    def __init__(self, model: str, memory: int = 500_000) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(SentencePieceProcessor(model_file=model).serialized_model_proto())
        norm, kind = proto.normalizer_spec, proto.trainer_spec
        if kind.model_type != kind.BPE or not kind.byte_fallback or norm.precompiled_charsmap:
            raise ValueError("only BPE models with byte fallback and without normalization are supported")
        if norm.remove_extra_whitespaces or not norm.add_dummy_prefix or not norm.escape_whitespaces:
            raise ValueError("the model must keep white space and add a leading space")
        pieces = [(p.piece, p.score) for p in proto.pieces if p.type == p.NORMAL]
        if any(p.type in (p.USER_DEFINED, p.UNUSED) for p in proto.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        if any(SPACE in p.lstrip(SPACE) for p, _ in pieces):
            raise ValueError("a piece goes across words")
        self.memory, self.known, self.former = memory, {}, {}
        chars = sorted({c for p, _ in pieces for c in p})
        names = {p: i for i, (p, _) in enumerate(pieces)}
        weight = [1] * len(pieces)
        for c in chars:  # characters that are no piece of their own can still be merged
            if c not in names:
                names[c] = len(names)
                weight.append(len(c.encode()))
        order = {p: r for r, (p, _) in enumerate(sorted(pieces, key=lambda x: -x[1]))}
        self.size = len(names) + 5  # the last four stand for other characters of 1 to 4 bytes
        self.weight = np.array(weight + [0, 1, 2, 3, 4])
        self.code = np.full(0x110000, self.size - 1, np.int64)
        self.code[:0x80], self.code[0x80:0x800] = self.size - 4, self.size - 3
        self.code[0x800:0x10000] = self.size - 2
        for c in chars:
            self.code[ord(c)] = names[c]
        pairs = sorted(
            (names[p[:i]] * self.size + names[p[i:]], order[p], names[p])
            for p, _ in pieces for i in range(1, len(p)) if p[:i] in names and p[i:] in names
        )
        self.pair, self.rank, self.made = (np.array(x, np.int64) for x in zip(*pairs))
        place = np.full(self.size, -1, np.int64)
        for p, r in order.items():
            if len(p) > 1:
                place[names[p]] = r
        left, right = self.pair // self.size, self.pair % self.size
        self.together = bool((self.rank > np.maximum(place[left], place[right])).all())
        near = {self.code[ord(a)] * self.size + self.code[ord(b)] for p, _ in pieces for a, b in zip(p, p[1:])}
        self.near = np.array(sorted(near), np.int64)

    def _find(self, table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(table, keys)
        at[at == len(table)] = 0
        return at, table[at] == keys

    def merge_counts(self, tokens: list[str]) -> np.ndarray:
        """Surviving symbols of each pre-token (space marks in place)."""
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        chars = np.frombuffer("".join(tokens).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym, owner = self.code[chars], np.repeat(np.arange(len(tokens)), lengths)
        counts = np.zeros(len(tokens), np.int64)
        if not len(sym):
            return counts
        _, joined = self._find(self.near, sym[:-1] * self.size + sym[1:])
        joined &= owner[1:] == owner[:-1]
        seq = np.concatenate(([0], np.cumsum(~joined)))
        while len(sym):
            inside = seq[1:] == seq[:-1]
            at, hit = self._find(self.pair, sym[:-1] * self.size + sym[1:])
            hit &= inside
            rank = np.append(np.where(hit, self.rank[at], NONE), NONE)
            first = np.flatnonzero(np.concatenate(([True], ~inside)))
            span = np.diff(np.append(first, len(sym)))
            best = np.repeat(np.minimum.reduceat(rank, first), span)
            live = best < NONE
            counts += np.bincount(owner[~live], self.weight[sym[~live]], len(tokens)).astype(np.int64)
            pick = np.flatnonzero((rank == best) & live)
            if not len(pick):
                break
            if self.together:  # of occurrences that overlap, every other one from the left
                start = np.concatenate(([True], (np.diff(pick) > 1) | (seq[pick[1:]] != seq[pick[:-1]])))
                run = np.maximum.accumulate(np.where(start, np.arange(len(pick)), 0))
                pick = pick[(np.arange(len(pick)) - run) % 2 == 0]
            else:
                pick = pick[np.concatenate(([True], seq[pick[1:]] != seq[pick[:-1]]))]
            sym[pick] = self.made[at[pick]]
            live[pick + 1] = False
            sym, seq, owner = sym[live], seq[live], owner[live]
        return counts

    def _recall(self, pieces: list[str]) -> list[int]:
        """Counts of distinct pre-tokens, each given without its first space mark."""
        if len(self.known) > self.memory:
            self.former, self.known = self.known, {}
        known, former = self.known, self.former
        new = [t for t in pieces if t not in known and t not in former]
        known.update(zip(new, self.merge_counts([SPACE + t for t in new]).tolist()))
        known.update((t, former[t]) for t in pieces if t not in known)
        return list(map(known.__getitem__, pieces))

    def count(self, texts: list[str | None]) -> list[int]:
        counts = [0] * len(texts)
        plain, odd = [], []
        for i, t in enumerate(texts):
            if t:
                (odd if SPACE in t or "  " in t or t[0] == " " or t[-1] == " " else plain).append(i)
        if plain:
            pieces, code, first = space_pieces([texts[i] for i in plain])
            sizes = np.array(self._recall(pieces), np.int64)[code]
            for i, n in zip(plain, np.add.reduceat(sizes, first[:-1]).tolist()):
                counts[i] = n
        for i in odd:  # runs of spaces belong to one pre-token
            runs = [x[1:] for x in RUNS.findall(SPACE + texts[i].replace(" ", SPACE))]
            distinct = list(set(runs))
            found = dict(zip(distinct, self._recall(distinct)))
            counts[i] = sum(map(found.__getitem__, runs))
        return counts


@lru_cache(maxsize=1)
def counter(model: str) -> PieceCounter:
    return PieceCounter(model)


def count_tokens(
    docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    ``model`` is the path of the model file on every machine. Counts are those of the model's
    library without added tokens. A null or empty text has no bytes and no tokens; repeated rows
    give repeated rows, an empty table none. Texts of any length are counted whole, and columns other
    than the two are not read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = pa.array(counter(model).count(batch.column("text").to_pylist()), pa.int64())
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_bytes")), n], ["doc_id", "n_bytes", "n_tokens"])

    sized = id_and_text(docs, id_col, text_col).select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text"
    )
    counted = sized.mapInArrow(per_slice(run), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
