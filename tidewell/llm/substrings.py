"""Removal of word windows that occur before, by suffix trees over prefix-partitioned suffixes.

Every suffix starts with a window of words, and only tree nodes at window depth or below matter.
Three passes over blocks of documents, each with a small exchange between:

1. Prefixes. The smallest fingerprint of a short prefix within a window is the window's anchor. Equal
   windows have equal anchors, so suffixes whose anchor occurs once in the corpus are in no repeat.
   All anchors are counted; one with many suffixes in the corpus has its prefix lengthened to the window.
2. Subtrees. The other suffixes go, as words, to the group of their prefix: neighbouring suffixes of one
   anchor together, those of lengthened prefixes one by one. A task packs prefixes by their counted
   suffixes into groups that fit its memory. A group's sorted suffixes with the lengths of their common
   prefixes are its subtree: the nodes at window depth or deeper are its repeats, and a node's first
   suffix in document order is the one that stays. Words are compared, fingerprints only deal them out.
3. Removal. The blocks get back the suffixes that are not the first, and drop the words they cover;
   neighbouring ones are put together to whole repeats, of any length.

A block sends equal neighbourhoods once, so a passage in a third of all documents is no hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import id_and_text
from tidewell.session import delete_path, scratch_path, stage

WINDOW, PREFIX = 20, 8
#: Bytes of text in a block, which bounds a worker's memory (one document at least).
BLOCK = 8 << 20
#: Places of one prefix, different within their block, beyond which the prefix is lengthened.
LENGTHEN = 4096
#: Suffixes in a group whose tree is held at once (one prefix at least).
GROUP = 1 << 17
#: A longer word (bytes) travels as its digest.
LONG_WORD = 64
LOWEST = -(1 << 63)
BASE, BASE2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Neighbouring suffixes: the prefix that deals them out, where they start, their row in the block, and
#: which of the row's suffixes they are.
RUN = np.dtype([("prefix", "<u8"), ("doc", "<i8"), ("start", "<u4"), ("row", "<u4"), ("first", "u1"), ("n", "u1")])

REPLY = "block long, kind int, a binary"
TREES = "kind int, block long, bucket long, a binary, b binary, c binary"
RESULT = "doc_id long, n_words long, n_removed long, kept string, n_repeats long, longest_repeat long"
BLOCKS = "kind int, block long, bucket long, ord int, doc long, hash string, a binary, b binary, c binary"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def _rolled(h: np.ndarray, words: int, base: np.uint64) -> np.ndarray:
    """Fingerprints of all runs of ``words`` entries, by doubling."""
    out, have, unit, size = None, 0, h, 1
    while True:
        if words & size:
            n = len(h) - have - size + 1
            out = unit if out is None else out[:n] * _power(base, size) + unit[have : have + n]
            have += size
        if have == words:
            return out
        unit = unit[:-size] * _power(base, size) + unit[size:]
        size *= 2


class Words:
    """The words of a block of texts as hashes, with each document's first place."""

    def __init__(self, texts: list[bytes]) -> None:
        import xxhash

        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))
        coded = split.values.dictionary_encode()
        names = coded.dictionary.to_pylist()
        code, first = coded.indices.to_numpy(), split.offsets.to_numpy().astype(np.int64)
        real = np.fromiter((bool(w) for w in names), bool, len(names))[code] if len(code) else np.zeros(0, bool)
        self.first = np.concatenate(([0], np.cumsum(real)))[first]
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in names), np.uint64, len(names))
        self.names, self.code = names, code[real]
        self.hash = hashes[self.code]

    def windows(self, window: int, prefix: int) -> tuple[np.ndarray, ...]:
        """Document, start, prefix and window fingerprints, and anchor place and value of every window."""
        n = len(self.hash) - window + 1
        if n < 1:
            return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.uint64, np.uint64, np.int64, np.uint64))
        doc = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        inside = doc[:n] == doc[window - 1 :]
        short, whole = _mix(_rolled(self.hash, prefix, BASE)), _mix(_rolled(self.hash, window, BASE2))
        value, place, width, need = short, np.arange(len(short)), 1, window - prefix + 1
        while width < need:
            step = min(width, need - width)
            left = value[:-step] <= value[step:]
            value, place = np.where(left, value[:-step], value[step:]), np.where(left, place[:-step], place[step:])
            width += step
        at = np.flatnonzero(inside)
        return doc[at], at - self.first[doc[at]], short[at], whole[at], place[at], value[at]


def _pack_texts(texts: list[bytes]) -> bytes:
    return zstandard.compress(b"".join(texts), 3)


def _unpack_texts(blob: bytes, sizes: np.ndarray) -> list[bytes]:
    raw, ends = zstandard.decompress(blob), np.cumsum(sizes).tolist()
    return [raw[s:e] for s, e in zip([0, *ends], ends)]


def _spelled(word: str) -> str:
    """A word as it travels; a long one as a tab, which no word holds, and its digest."""
    raw = word.encode("utf-8", "surrogatepass") if len(word) > LONG_WORD // 4 else b""
    return word if len(raw) <= LONG_WORD else "\t" + hashlib.blake2b(raw, digest_size=32).hexdigest()


def _planes(x: np.ndarray) -> bytes:
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def _unplaned(raw: np.ndarray, n: int, kind: np.dtype | str) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(-1, n).T).view(kind)[:, 0] if n else np.zeros(0, kind)


def _pack(runs: np.ndarray, symbols: np.ndarray, names: list[str]) -> dict[str, bytes]:
    """Runs by field and byte place, so that sorted and small numbers compress; their words as codes and spellings."""
    used, code = np.unique(symbols, return_inverse=True)
    fields = b"".join(_planes(np.ascontiguousarray(runs[f])) for f in RUN.names)
    words = " ".join([_spelled(names[i]) for i in used.tolist()]).encode("utf-8", "surrogatepass")
    return {
        "a": len(runs).to_bytes(4, "little") + zstandard.compress(fields, 1),
        "b": len(code).to_bytes(4, "little") + zstandard.compress(_planes(code.ravel().astype("<u4")), 1),
        "c": zstandard.compress(words, 1),
    }


def _unpack_runs(blob: bytes) -> np.ndarray:
    n, raw, at = int.from_bytes(blob[:4], "little"), np.frombuffer(zstandard.decompress(blob[4:]), np.uint8), 0
    x = np.zeros(n, RUN)
    for f in RUN.names:
        size = n * RUN[f].itemsize
        x[f], at = _unplaned(raw[at : at + size], n, RUN[f]), at + size
    return x


def _unpack_codes(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:4], "little")
    return _unplaned(np.frombuffer(zstandard.decompress(blob[4:]), np.uint8), n, "<u4")


def _places(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the intervals, one interval after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _rows(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """Intervals of the symbols as rows that sort by symbol; 0 stands behind the end."""
    out = np.zeros((len(starts), width), ">u4")
    ends = np.cumsum(sizes)
    column = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    out[np.repeat(np.arange(len(starts)), sizes), column] = symbols[_places(starts, sizes)] + 1
    return out


def _sorted(rows: np.ndarray) -> np.ndarray:
    return np.argsort(rows.view(f"S{4 * rows.shape[1]}")[:, 0], kind="stable") if len(rows) else np.zeros(0, np.int64)


def _alike(rows: np.ndarray) -> np.ndarray:
    """The number of each row's class of equal rows, from 0."""
    order, number = _sorted(rows), np.zeros(len(rows), np.int64)
    number[order[1:]] = np.cumsum((rows[order[1:]] != rows[order[:-1]]).any(1))
    return number


def _anchored(place: np.ndarray) -> np.ndarray:
    """The first window of each run of neighbouring windows with one anchor."""
    return np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1]))) if len(place) else np.zeros(0, np.int64)


def _table(rows: list[dict], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split(" ") for f in schema.split(", ")]
    return pa.table({name: pa.array([r.get(name) for r in rows], kinds[kind]) for name, kind in fields})


def _by_bucket(values: np.ndarray, keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    at = (keys % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(at, kind="stable")
    cut = np.flatnonzero(np.diff(at[order])) + 1
    for part in np.split(order, cut) if len(order) else []:
        yield int(at[part[0]]), values[part]


def _blocks(docs: DataFrame, window: int, prefix: int, buckets: int, block_bytes: int) -> DataFrame:
    """Blocks of documents (kind 0), their anchors by bucket (kind 1), and a text hash per document (kind 2)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids, texts, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            block = part << 24 | number
            _, _, _, whole, place, value = Words(texts).windows(window, prefix)
            at = _anchored(place)
            n = np.diff(np.append(at, len(place)))
            look = _mix(whole[at] * BASE + whole[at + n - 1] + n.astype(np.uint64))
            order = np.lexsort((look, value[at]))
            mine, look = value[at][order], look[order]
            values, head, counts = np.unique(mine, return_index=True, return_counts=True)
            fresh = np.concatenate(([True], (mine[1:] != mine[:-1]) | (look[1:] != look[:-1]))) if len(mine) else np.zeros(0, bool)
            loads = np.add.reduceat(fresh, head, dtype=np.int64) if len(head) else head
            cells = np.stack((np.arange(len(values)), loads, counts > 1), 1)
            sizes = np.fromiter(map(len, texts), "<u4", len(texts))
            rows = [{"kind": 0, "block": block, "a": np.array(ids, "<i8").tobytes(), "b": sizes.tobytes(), "c": _pack_texts(texts)}]
            rows += [
                {"kind": 2, "block": block, "ord": i, "doc": d, "hash": hashlib.blake2b(t, digest_size=16).hexdigest()}
                for i, (d, t) in enumerate(zip(ids, texts)) if t
            ]
            for b, x in _by_bucket(cells, values, buckets):
                load = zstandard.compress((x[:, 1] << 1 | x[:, 2]).astype("<u4").tobytes(), 1)
                rows.append({"kind": 1, "block": block, "bucket": b, "a": values[x[:, 0]].tobytes(), "b": load})
            yield from _table(rows, BLOCKS).to_batches()

        for batch in batches:
            for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                t = (t or "").encode("utf-8", "surrogatepass")
                if texts and held + len(t) > block_bytes:
                    yield from flush()
                    number, ids, texts, held = number + 1, [], [], 0
                ids.append(LOWEST if d is None else d), texts.append(t)
                held += len(t)
        if texts:
            yield from flush()

    return docs.mapInArrow(run, BLOCKS)


def _counted_anchors(lengthen: int):
    """To each block its anchors, alone there, that other blocks have too (kind 0), and those to lengthen (kind 4)."""

    def run(group: pa.Table) -> pa.Table:
        blocks = group["block"].to_pylist()
        mine = [np.frombuffer(x, "<u8") for x in group["a"].to_pylist()]
        cells = [np.frombuffer(zstandard.decompress(x), "<u4") for x in group["b"].to_pylist()]
        values, at, counts = np.unique(np.concatenate(mine), return_inverse=True, return_counts=True)
        load = np.bincount(at, np.concatenate(cells) >> 1, len(values))
        rows, end = [], 0
        for b, x, cell in zip(blocks, mine, cells):
            here, end = at[end : end + len(x)], end + len(x)
            for k, found in ((0, (counts[here] > 1) & (cell & 1 == 0)), (4, load[here] > lengthen)):
                if found.any():
                    rows.append({"block": b, "kind": k, "a": x[found].tobytes()})
        return _table(rows, REPLY)

    return run


def _joined(replies: list[dict], kind: int, dtype: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *(np.frombuffer(r["a"], dtype) for r in replies if r["kind"] == kind)])


def _suffixes(window: int, prefix: int, buckets: int):
    """Per block its runs of suffixes that may repeat (kind 0), and those that differ, with words, by bucket (kind 1)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[dict] = []
        for row in left.to_pylist():
            ids, words = np.frombuffer(row["a"], "<i8"), Words(_unpack_texts(row["c"], np.frombuffer(row["b"], "<u4")))
            replies = right.to_pylist()
            doc, start, _, whole, place, value = words.windows(window, prefix)
            at = _anchored(place)
            n = np.diff(np.append(at, len(place)))
            values, counts = np.unique(value[at], return_counts=True)
            known = np.union1d(values[counts > 1], _joined(replies, 0, "<u8"))
            kept = np.ones(len(ids), bool)
            kept[_joined(replies, 1, "<i4")] = False
            may = np.isin(value[at], known) & kept[doc[at]]
            at, n = at[may], n[may]
            if not len(at):
                continue
            doc, start, value, place = doc[at], start[at], value[at], place[at]
            size, origin = n + window - 1, words.first[doc] + start
            text = _rows(words.code, origin, size, 2 * window)
            # Runs are alike if their words are and as many of them stand before the anchor.
            number = _alike(text)
            order = np.lexsort((start, ids[doc], place - origin, number))
            number, before = number[order], (place - origin)[order]
            new = np.concatenate(([True], (number[1:] != number[:-1]) | (before[1:] != before[:-1])))
            doc, start, value, n, size, origin, at = doc[order], start[order], value[order], n[order], size[order], origin[order], at[order]
            node, head = np.cumsum(new) - 1, np.flatnonzero(new)
            # Rows that repeat a document's id and text agree with the first suffix and share its fate.
            first = (ids[doc] == ids[doc[head]][node]) & (start == start[head][node])
            cells = np.stack((doc, start, n, np.where(first, node, 0xFFFFFFFF)), 1).astype("<u4")
            rows.append({"kind": 0, "block": row["block"], "a": zstandard.compress(cells.T.tobytes(), 3)})
            hot = np.isin(value[head], _joined(replies, 4, "<u8"))
            whole_runs, single = head[~hot], np.repeat(head[hot], n[head[hot]])
            step = _places(np.zeros(hot.sum(), np.int64), n[head[hot]])
            # Of equal suffixes of lengthened prefixes only the first leaves the block; the fate of the others is known.
            number = _alike(_rows(words.code, origin[single] + step, np.full(len(single), window), window))
            rank = np.lexsort((start[single] + step, ids[doc[single]], number))
            top = rank[np.flatnonzero(np.diff(number[rank], prepend=-1))][number]
            later = (ids[doc[single]] != ids[doc[single[top]]]) | (start[single] + step != start[single[top]] + step[top])
            if later.any():
                told = np.stack((node[single[later]], 1 << step[later])).astype("<u4")
                rows.append({"kind": 2, "block": row["block"], "a": zstandard.compress(told.tobytes(), 1)})
            single, step = single[~later], step[~later]
            sent = np.zeros(len(whole_runs) + len(single), RUN)
            chosen, step = np.concatenate((whole_runs, single)), np.concatenate((np.zeros(len(whole_runs), np.int64), step))
            alone = np.arange(len(sent)) >= len(whole_runs)
            sent["prefix"] = np.where(alone, whole[at[chosen] + step], value[chosen])
            sent["doc"], sent["start"], sent["row"] = ids[doc[chosen]], start[chosen] + step, node[chosen]
            sent["first"], sent["n"] = step, np.where(alone, 1, n[chosen])
            begin = origin[chosen] + step
            for b, mine in _by_bucket(np.arange(len(sent)), sent["prefix"], buckets):
                mine = mine[np.lexsort((sent["start"][mine], sent["doc"][mine]))]
                symbols = words.code[_places(begin[mine], sent["n"][mine].astype(np.int64) + window - 1)]
                rows.append({"kind": 1, "block": row["block"], "bucket": b, **_pack(sent[mine], symbols, words.names)})
        return _table(rows, TREES)

    return run


def subtree(symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes (intervals of at most ``width`` symbols) in tree order, and each one's common prefix with the one before.

    Both together are the tree: a stretch of suffixes with common prefixes of at least some length is
    the node of that depth above them. The first has 0. No suffixes give empty arrays.
    """
    rows = _rows(symbols, starts, sizes, width)
    order = _sorted(rows)
    rows, sizes = rows[order], sizes[order]
    differ = rows[1:] != rows[:-1]
    common = np.where(differ.any(1), differ.argmax(1), width)
    depth = np.zeros(len(order), np.int64)
    depth[1:] = np.minimum(common, np.minimum(sizes[1:], sizes[:-1]))
    return order, depth


def _subtrees(window: int, most: int):
    """One bucket of prefixes: per block the runs with suffixes that are not the first of their deep node."""

    def run(group: pa.Table) -> pa.Table:
        parts = [_unpack_runs(x) for x in group["a"].to_pylist()]
        runs, block = np.concatenate(parts), np.repeat(np.array(group["block"].to_pylist(), np.int64), [len(p) for p in parts])
        codes = [_unpack_codes(x) for x in group["b"].to_pylist()]
        words = pc.split_pattern(pa.array([zstandard.decompress(x) for x in group["c"].to_pylist()], pa.large_binary()).cast(pa.large_string()), " ")
        spelled = words.values.dictionary_encode().indices.to_numpy()
        symbols = spelled[np.concatenate([c + np.int64(o) for c, o in zip(codes, words.offsets.to_numpy())])]
        del parts, codes, words, spelled
        size = runs["n"].astype(np.int64) + window - 1
        begin = np.cumsum(size) - size
        order = np.argsort(runs["prefix"], kind="stable")
        prefix, total = runs["prefix"][order], np.cumsum(runs["n"][order], dtype=np.int64)
        edges = np.append(np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1]))), len(order))
        rows, low = [], 0
        late = np.zeros(len(runs), np.uint32)
        while low < len(order):
            # As many whole prefixes as fit, one at least.
            reach = np.searchsorted(total, (total[low - 1] if low else 0) + most, "right")
            high = int(edges[max(np.searchsorted(edges, reach, "right") - 1, np.searchsorted(edges, low, "right"))])
            mine, low = order[low:high], high
            n = runs["n"][mine].astype(np.int64)
            owner, step = np.repeat(mine, n), _places(np.zeros(len(mine), np.int64), n)
            tree, depth = subtree(symbols, begin[owner] + step, size[owner] - step, 2 * window)
            node = np.cumsum(depth < window)
            owner, step = owner[tree], step[tree]
            doc, start = runs["doc"][owner], runs["start"][owner] + step
            rank = np.lexsort((start, doc, node))
            top = rank[np.flatnonzero(np.concatenate(([True], node[rank][1:] != node[rank][:-1])))][node - 1]
            later = (doc != doc[top]) | (start != start[top])
            bit = (runs["first"][owner] + step)[later].astype(np.uint32)
            np.bitwise_or.at(late, owner[later], np.uint32(1) << bit)
        found = np.flatnonzero(late)
        found = found[np.argsort(block[found], kind="stable")]
        for part in np.split(found, np.flatnonzero(np.diff(block[found])) + 1) if len(found) else []:
            told = np.stack((runs["row"][part], late[part])).astype("<u4")
            rows.append({"block": int(block[part[0]]), "kind": 3, "a": zstandard.compress(told.tobytes(), 1)})
        return _table(rows, REPLY)

    return run


def _removal(window: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list[dict] = []
        for row in left.to_pylist():
            ids, texts = np.frombuffer(row["a"], "<i8"), _unpack_texts(row["c"], np.frombuffer(row["b"], "<u4"))
            replies = right.to_pylist()
            copies = {int(i) for r in replies if r["kind"] == 1 for i in np.frombuffer(r["a"], "<i4")}
            cells, told = (
                np.concatenate([np.zeros((k, 0), "<u4"), *(np.frombuffer(zstandard.decompress(r["a"]), "<u4").reshape(k, -1) for r in replies if r["kind"] == kind)], 1)
                for kind, k in ((2, 4), (3, 2))
            )
            late = np.zeros(len(cells[0]) + 1, np.uint32)
            np.bitwise_or.at(late, told[0], told[1])
            again = cells[3] == 0xFFFFFFFF
            bits = np.where(again, np.uint32(0xFFFFFFFF), late[np.where(again, len(late) - 1, cells[3])])
            owner, step = np.repeat(np.arange(len(bits)), cells[2]), _places(np.zeros(len(bits), np.int64), cells[2].astype(np.int64))
            gone = (bits[owner] >> step.astype(np.uint32)) & 1 == 1
            doc, start = cells[0][owner][gone], (cells[1][owner] + step)[gone]
            order = np.lexsort((start, doc))
            doc, start = doc[order], start[order]
            edge = np.searchsorted(doc, np.arange(len(texts) + 1)).tolist()
            for i, (d, t) in enumerate(zip(ids.tolist(), texts)):
                words = t.split()
                n = len(words)
                repeats = longest = 0
                if i in copies and n >= window:
                    removed, kept, repeats, longest = n, b"", 1, n
                elif edge[i] == edge[i + 1]:
                    removed, kept = 0, b" ".join(words)
                else:
                    cover = np.zeros(n + 1, np.int64)
                    s = start[edge[i] : edge[i + 1]].astype(np.int64)
                    ends = np.append(np.flatnonzero(np.diff(s) > 1) + 1, len(s))
                    repeats, longest = len(ends), int(np.diff(ends, prepend=0).max()) + window - 1
                    np.add.at(cover, s, 1), np.add.at(cover, s + window, -1)
                    stay = np.cumsum(cover[:-1]) == 0
                    removed, kept = int(n - stay.sum()), b" ".join(compress(words, stay.tolist()))
                rows.append({"doc_id": None if d == LOWEST else d, "n_words": n, "n_removed": removed, "kept": kept.decode("utf-8", "surrogatepass"), "n_repeats": repeats, "longest_repeat": longest})
        return _table(rows, RESULT)

    return run


def drop_repeats(
    docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, id_col: str = "doc_id", text_col: str = "text",
    block_bytes: int = BLOCK,
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept, its remaining words joined by a space,
    n_repeats and longest_repeat (words), its longest stretches of which every window starts earlier too.

    A word goes if a window of ``window`` consecutive words covers it whose words also start earlier:
    in a document with a smaller doc_id, or in the same one further ahead. Windows are judged on the
    input. A null text has no words; a null doc_id is smaller than all others (it is kept as the
    smallest long inside). Rows that repeat an id count as one document: a window is earlier only by
    id and start. Of equal texts only those with the smallest id take part in the search; the others
    repeat it in full. Window equality is that of words (of 256-bit digests for words of more than 64
    bytes); equality of texts is that of a 128-bit digest. An empty table gives no rows. Texts of any
    length are searched whole, a text longer than a block as a block of its own. Other columns,
    whatever their names, are not read. A window may have at most 31 words more than the prefix.
    """
    if not 0 < prefix <= window < prefix + 32:
        raise ValueError("a window needs as many words as the prefix, and at most 31 more")
    spark, docs = docs.sparkSession, id_and_text(docs, id_col, text_col)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // (32 << 20))

    def saved(df: DataFrame, purpose: str) -> str:
        path = scratch_path(spark, purpose)
        df.write.partitionBy("kind").parquet(path)
        return path

    def kind(path: str, k: int, schema: str) -> DataFrame:
        """Rows of one kind; none where no row has it."""
        return spark.read.schema(schema).parquet(path).where(F.col("kind") == k).drop("kind")

    blocks = saved(_blocks(docs, window, prefix, buckets, block_bytes), "repeat-blocks")
    texts = kind(blocks, 0, BLOCKS).select("block", "a", "b", "c")
    hashed = kind(blocks, 2, BLOCKS).select("block", "ord", "doc", "hash")
    classes = hashed.groupBy("hash").agg(F.min("doc").alias("smallest"), F.count("*").alias("n")).where("n > 1")
    copies = hashed.join(classes, "hash").where("doc > smallest").groupBy("block").agg(F.collect_list("ord").alias("ords"))

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [np.array(o, "<i4").tobytes() for o in batch.column("ords").to_pylist()]
            yield from _table([{"block": b, "kind": 1, "a": c} for b, c in zip(batch.column("block").to_pylist(), cells)], REPLY).to_batches()

    copies = stage(copies.mapInArrow(packed, REPLY), "repeat-copies")
    anchors = kind(blocks, 1, BLOCKS).select("block", "bucket", "a", "b")
    shared = stage(anchors.groupBy("bucket").applyInArrow(_counted_anchors(LENGTHEN), REPLY), "repeat-anchors")
    delete_path(spark, f"{blocks}/kind=1")
    told = shared.unionByName(copies)
    trees = saved(texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_suffixes(window, prefix, buckets), TREES), "repeat-trees")
    runs = kind(trees, 1, TREES).select("block", "bucket", "a", "b", "c")
    late = stage(runs.groupBy("bucket").applyInArrow(_subtrees(window, GROUP), REPLY), "repeat-later")
    delete_path(spark, f"{trees}/kind=1")
    told = copies.unionByName(kind(trees, 0, TREES).select("block", F.lit(2).alias("kind"), "a")).unionByName(late)
    told = told.unionByName(kind(trees, 2, TREES).select("block", F.lit(3).alias("kind"), "a"))
    return texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_removal(window), RESULT)
