"""Byte-level BPE as a finite-state transducer, and streaming decoding by a UTF-8 state machine.

Two facts make merges a finite-state relation. Tokens ``t1 … tn`` are what merging gives for their
bytes exactly when each neighbouring pair is what merging gives for its own bytes; and every string
has one such sequence. So the nondeterministic machine reads a byte along the trie of the
vocabulary and may end a token wherever the pair rule holds; at each place at most one token can
end. A state of the determinised machine is, for every place at which an unfinished token may have
begun, the trie node reached and the kind of the token before it. A transition gives the next state
and the token that may end there; what all branches have in common is certain. At most one token
length of bytes is ever undecided. States are made when a text first needs them.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice, takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewell.llm.common import id_and_text, slices

#: Transitions and pair verdicts a worker remembers; beyond that it forgets and starts anew.
MOVES, PAIRS = 1_000_000, 500_000
#: Matches that are held at a time, and the bytes beyond which a match is read by itself.
RUN, LONG = 500_000, 64
END = float("inf")
#: The kind of token before the first one, and the bytes after which a stream looks for certain tokens.
FIRST, LOOK = 1 << 30, 32
#: Bits of a trie node or a token; a vocabulary of more does not fit.
NODE = 24
DEEP = (1 << NODE) - 1
#: Branches are tried against the tokens behind them where there are at most so many.
FEW = 8


class Moves:
    """Transitions by (state, byte), looked up for many at once: open addressing in two arrays."""

    def __init__(self, bits: int = 16) -> None:
        self.count, self.bits = 0, bits
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The moves of the keys, -1 where there is none."""
        out, todo, at = np.full(len(keys), -1, np.int64), np.arange(len(keys)), self._home(keys)
        while len(todo):
            there = self.keys[at]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[at[hit]]
            on = ~hit & (there >= 0)
            todo, at = todo[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Store moves of distinct keys that are not there yet."""
        if 2 * (self.count + len(keys)) > len(self.keys):
            old = self.keys >= 0
            before = self.keys[old], self.values[old]
            self.__init__(max(self.bits + 1, int(4 * (self.count + len(keys))).bit_length()))
            self.add(*before)
        self.count += len(keys)
        at = self._home(keys)
        while len(keys):
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]  # of several that want a place the last one gets it
            placed = self.keys[at] == keys
            self.values[at[placed]] = values[placed]
            keys, values, at = keys[~placed], values[~placed], (at[~placed] + 1) & ((1 << self.bits) - 1)


class Transducer:
    """Encodes byte strings by a merge list given as ranks (token bytes: id).

    Each token must be a single byte or be made by merges of lower rank; a token that no merge
    makes stands only for a whole string, as in the library. All 256 bytes must be tokens.
    """

    def __init__(self, ranks: dict[bytes, int], moves: int = MOVES) -> None:
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"{len(missing)} of 256 bytes are not in the vocabulary")
        if max(map(len, ranks)) * len(ranks) >> NODE or max(ranks.values()) >> NODE:
            raise ValueError("the vocabulary is too large")
        self.ranks, self.spelling, self.limit = ranks, {i: t for t, i in ranks.items()}, moves
        self.child: dict[int, int] = {}
        self.token, self.depth = [-1], [0]
        for spelled, i in ranks.items():
            node = 0
            for b in spelled:
                key = node << 8 | b
                node = self.child.setdefault(key, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
                    self.depth.append(self.depth[key >> 8] + 1)
            self.token[node] = i
        parent = {node: key >> 8 for key, node in self.child.items()}
        below: dict[int, list[int]] = {}
        for end, token in enumerate(self.token):
            node = parent.get(end, 0) if token >= 0 else 0
            while node and len(tokens := below.setdefault(node, [])) <= FEW:
                tokens.append(token)
                node = parent[node]
        self.below = {node: tokens for node, tokens in below.items() if len(tokens) <= FEW}
        self.inner = {key >> 8 for key in self.child}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.longer: dict[int, list[int]] = {}  # per token, the merges that take it as their left part
        for spelled, i in sorted(ranks.items(), key=lambda t: t[1]):
            for cut in range(1, len(spelled)):
                if (left := ranks.get(spelled[:cut])) is not None and spelled[cut:] in ranks:
                    self.longer.setdefault(left, []).append(i)
        self.kinds: dict[tuple, int] = {}
        self.kind_of: dict[int, int] = {}
        self.example: list[int] = []
        self.size = {i: len(t) for t, i in ranks.items()}
        self.lengths = np.zeros(max(self.spelling) + 1, np.int64)
        self.lengths[list(self.size)] = list(self.size.values())
        self.unmade = any(self._split(i) == () for i in self.spelling)
        self.forget()

    def forget(self) -> None:
        """Drop all states but the first: nothing read, one branch at the root."""
        self.states: list[tuple[int, ...]] = [(FIRST << NODE,)]
        self.number = {self.states[0]: 0}
        self.branches: dict[int, int] = {}  # one object for equal branches
        self.moves, self.own = Moves(), {}  # for many strings at once, and for one
        self.verdicts: dict[int, bool] = {}
        self.open: dict[int, bool] = {}

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte, ValueError where no merge does."""
        if token in self.halves:
            return self.halves[token]
        spelled, ranks = self.spelling[token], self.ranks
        parts = [spelled[i : i + 1] for i in range(len(spelled))]
        while len(parts) > 2:
            found = [(ranks.get(a + b, END), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(found)
            if rank == END:
                break
            if rank > token:
                raise ValueError(f"token {token} is made by a merge of higher rank")
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        if len(parts) > 2:
            made = ()  # no merge makes it
        elif len(parts) == 2:
            made = (ranks[parts[0]], ranks[parts[1]])
        else:
            made = None
        self.halves[token] = made
        return made

    def neighbours(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both gives just these two tokens.

        Goes back in time from the finished pair. At each moment the two symbols that touch must not
        have merged with each other: that would need a token of both whose rank comes before the
        merge that takes either of them, where the left one of equal merges is done first.
        """
        x, y, x_until, y_until = left, right, END, END
        while True:
            across = self.ranks.get(self.spelling[x] + self.spelling[y])
            if across is not None and across < x_until and across <= y_until:
                return False
            x_halves, y_halves = self._split(x), self._split(y)
            if x_halves and (not y_halves or x > y):
                x, x_until = x_halves[1], x
            elif y_halves:
                y, y_until = y_halves[0], y
            else:
                return True

    def kind(self, token: int) -> int:
        """Tokens of one kind admit the same tokens behind them.

        What can go wrong at a token's right end depends on the symbols that were ever its last one
        and, for each, on the merges to the right that come before the one that took it.
        """
        if token not in self.kind_of:
            seen, x, until = [], token, END
            while True:
                if n := bisect_left(self.longer.get(x, ()), until):
                    seen.append((x, n))
                if not (halves := self._split(x)):
                    break
                x, until = halves[1], x
            self.kind_of[token] = self.kinds.setdefault(tuple(seen), len(self.kinds))
            if len(self.kinds) > len(self.example):
                self.example.append(token)
        return self.kind_of[token]

    def _may_follow(self, kind: int, token: int) -> bool:
        """Whether a token may come behind one of the given kind."""
        key = kind << 32 | token
        if key not in self.verdicts:
            if len(self.verdicts) > PAIRS:
                self.verdicts.clear()
            self.verdicts[key] = self._split(token) != () and (kind == FIRST or self.neighbours(self.example[kind], token))
        return self.verdicts[key]

    def _alive(self, kind: int, node: int) -> bool:
        """Whether some token that passes through the node may follow; not looked up where many do."""
        below = self.below.get(node)
        if below is None:
            return True
        key = kind << 32 | node
        if key not in self.open:
            if len(self.open) > PAIRS:
                self.open.clear()
            self.open[key] = any(self._may_follow(kind, token) for token in below)
        return self.open[key]

    def _step(self, state: int, byte: int) -> int:
        """Make the transition of a state on a byte: the next state and, in the low bits, the token that may end here."""
        grown, ended, same = [], -1, self.branches.setdefault
        for branch in self.states[state]:
            kind, node = branch >> NODE, self.child.get((branch & DEEP) << 8 | byte)
            if node is None:
                continue
            token = self.token[node]
            if token >= 0 and ended < 0 and self._may_follow(kind, token):
                ended = token
            if node in self.inner and self._alive(kind, node):
                branch = kind << NODE | node
                grown.append(same(branch, branch))
        branch = self.kind(ended) << NODE
        grown.append(same(branch, branch))
        key = tuple(grown)
        number = self.number.setdefault(key, len(self.states))
        if number == len(self.states):
            self.states.append(key)
        return number << NODE | ended

    def _move(self, key: int) -> int:
        move = self.own[key] = self._step(key >> 8, key & 255)
        return move

    def _path(self, ended: list[int], at: int) -> list[int]:
        """The tokens up to a place, last one first."""
        out, size = [], self.size
        while at:
            token = ended[at - 1] & DEEP
            out.append(token)
            at -= size[token]
        return out

    def stream(self, chunks: Iterable[bytes]) -> Iterator[list[int]]:
        """Tokens of one string given in chunks, as soon as they are certain; the last ones at its end.

        Certain is what all branches have in common: each began where some token ended. No branch is
        older than the longest token, so no more than that is held back.
        """
        state, ended = 0, []
        for chunk in chunks:
            for at in range(0, len(chunk), LOOK):
                for byte in chunk[at : at + LOOK]:
                    key = state << 8 | byte
                    ended.append(self.own.get(key) or self._move(key))
                    state = ended[-1] >> NODE
                paths = [self._path(ended, len(ended) - self.depth[branch & DEEP])[::-1] for branch in self.states[state]]
                agreed = [a for a, *_ in takewhile(lambda t: len(set(t)) == 1, zip(*paths))]
                if agreed:
                    del ended[: sum(self.size[t] for t in agreed)]
                    yield agreed
        if last := self._path(ended, len(ended))[::-1]:
            yield last

    def encode(self, piece: bytes) -> list[int]:
        """The tokens of one string."""
        if len(self.own) > self.limit:
            self.forget()
        state, ended, moves = 0, [], self.own
        for byte in piece:
            key = state << 8 | byte
            move = moves.get(key) or self._move(key)
            ended.append(move)
            state = move >> NODE
        out = self._path(ended, len(ended))
        if len(out) > 1 and piece in self.ranks:  # a token that no merge makes
            return [self.ranks[piece]]
        out.reverse()
        return out

    def encode_many(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of strings laid end to end, and the number of tokens of each; all strings move on together."""
        if self.moves.count > self.limit:
            self.forget()
        size = np.diff(offsets)
        order = np.argsort(-size, kind="stable")
        order = order[np.searchsorted(-size[order], -LONG) :]  # the long ones are read by themselves
        first, left = offsets[order], size[order]
        state, ended = np.zeros(len(order), np.int64), np.zeros(len(data), np.int64)
        for k in range(int(left[0]) if len(left) else 0):
            n = np.searchsorted(-left, -k)  # longer than k
            keys = state[:n] << 8 | data[first[:n] + k]
            moves = self.moves.find(keys)
            if len(new := np.unique(keys[moves < 0])):
                self.moves.add(new, np.array([self._step(key >> 8, key & 255) for key in new.tolist()], np.int64))
                moves[moves < 0] = self.moves.find(keys[moves < 0])
            ended[first[:n] + k], state[:n] = moves & DEEP, moves >> NODE
        # Back from each end: the token that ends there, then the place where it began.
        at, of, taken, owner = first + left, order, [], []
        while len(of := of[(on := at > offsets[of])]):
            at = at[on]
            taken.append(ended[at - 1])
            owner.append(of)
            at = at - self.lengths[taken[-1]]
        ids, of = (np.concatenate(x)[::-1] if x else np.zeros(0, np.int64) for x in (taken, owner))
        counts = np.bincount(of, minlength=len(size))
        odd = {int(i): self.encode(data[offsets[i] : offsets[i + 1]].tobytes()) for i in np.flatnonzero(size >= LONG)}
        if self.unmade:
            for i in np.flatnonzero((counts > 1) & (size < LONG)):
                if (piece := data[offsets[i] : offsets[i + 1]].tobytes()) in self.ranks:
                    odd[int(i)] = [self.ranks[piece]]
        if odd:
            keep = ~np.isin(of, list(odd))
            of = np.concatenate((of[keep], np.repeat(list(odd), [len(x) for x in odd.values()])))
            ids = np.concatenate((ids[keep], np.array([t for x in odd.values() for t in x], np.int64)))
            counts = np.bincount(of, minlength=len(size))
        return ids[np.argsort(of, kind="stable")].astype(np.int32), counts


class TextEncoder:
    """Token ids of texts: each match of a pattern is encoded by the transducer, distinct ones once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import regex

        self.transducer, self.pattern = Transducer(ranks), regex.compile(pattern)

    def _runs(self, texts: list[str]) -> Iterator[tuple[int, list[str]]]:
        """Matches of each text in lists of bounded length: (text number, matches)."""
        for i, text in enumerate(texts):
            if len(text) <= RUN and not self.pattern.groups:
                yield i, self.pattern.findall(text)
            else:
                matches = (m.group() for m in self.pattern.finditer(text))
                while some := list(islice(matches, RUN)):
                    yield i, some

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text."""
        counts, out = np.zeros(len(texts), np.int64), [np.zeros(0, np.int32)]
        held: list[str] = []
        of: list[tuple[int, int]] = []

        def flush() -> None:
            coded = pa.array(held, pa.large_string()).dictionary_encode()
            distinct, code = coded.dictionary, coded.indices.to_numpy()
            offsets = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
            total, size = self.transducer.encode_many(np.frombuffer(distinct.buffers()[2] or b"", np.uint8), offsets)
            start, sizes = np.cumsum(size) - size, size[code]
            ends = np.cumsum(sizes)
            out.append(total[np.repeat(start[code] - (ends - sizes), sizes) + np.arange(ends[-1])])
            stops = np.concatenate(([0], ends))[np.cumsum([0] + [n for _, n in of])]
            np.add.at(counts, [i for i, _ in of], np.diff(stops))
            held.clear()
            of.clear()

        for i, some in self._runs(texts):
            if some:
                held += some
                of.append((i, len(some)))
            if len(held) >= RUN:
                flush()
        if held:
            flush()
        return np.concatenate(out), counts


def _utf8_table() -> np.ndarray:
    """Next state by state and byte: 0 between characters, -1 an error.

    1, 2 and 3 wait for so many continuation bytes; 4 to 7 are the second byte after E0, ED, F0 and
    F4, whose range is narrower (no overlong forms, surrogates or code points beyond U+10FFFF).
    """
    table = np.full((8, 256), -1, np.int8)
    table[0, :0x80] = 0
    for lead, state in ((range(0xC2, 0xE0), 1), (range(0xE1, 0xF0), 2), (range(0xF1, 0xF4), 3), ([0xE0], 4), ([0xED], 5), ([0xF0], 6), ([0xF4], 7)):
        table[0, list(lead)] = state
    for state, after, low, high in ((1, 0, 0x80, 0xC0), (2, 1, 0x80, 0xC0), (3, 2, 0x80, 0xC0), (4, 1, 0xA0, 0xC0), (5, 1, 0x80, 0xA0), (6, 2, 0x90, 0xC0), (7, 2, 0x80, 0x90)):
        table[state, low:high] = after
    return table


UTF8 = _utf8_table().tolist()


class Vocabulary:
    """Spellings of ids laid end to end, and what each does to the UTF-8 machine between characters."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        spelled = [b""] * (max(ranks.values(), default=-1) + 1)
        for t, i in ranks.items():
            spelled[i] = t
        self.spelled = spelled
        self.size = np.fromiter(map(len, spelled), np.int64, len(spelled))
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.whole = np.array([len(t) > 0 and _walk(t, 0)[1:] == (0, True) for t in spelled])

    def spell(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of a sequence of ids, and where each id's bytes end."""
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.size) and self.size[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        sizes = self.size[ids]
        ends = np.cumsum(sizes)
        return self.bytes[np.repeat(self.start[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ids) else 0)].tobytes(), ends


def _walk(data: bytes, state: int) -> tuple[int, int, bool]:
    """Run the machine: bytes since the last character's end, state, and whether no byte was wrong."""
    open_bytes, intact = 0, True
    for b in data:
        after = UTF8[state][b]
        if after < 0:
            intact = False
            after = max(0, UTF8[0][b]) if state else 0
            open_bytes = 0
        state = after
        open_bytes = open_bytes + 1 if state else 0
    return open_bytes, state, intact


class StreamDecoder:
    """Text of ids that arrive in parts; a character is given out when its last byte has come.

    Wrong byte sequences become U+FFFD, one for each longest start of a character, and clear ``intact``.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary, self.state, self.pending, self.intact = vocabulary, 0, b"", True

    def feed(self, ids: np.ndarray) -> str:
        data, ends = self.vocabulary.spell(ids)
        begun = len(self.pending)
        parted = np.flatnonzero(~self.vocabulary.whole[ids]) if len(ids) else np.zeros(0, np.int64)
        at, state, open_bytes = 0, self.state, begun
        while at < len(ids):
            if not state:  # jump over the ids that hold whole characters only
                n = np.searchsorted(parted, at)
                at = int(parted[n]) if n < len(parted) else len(ids)
                if at == len(ids):
                    break
            spelled = self.vocabulary.spelled[ids[at]]
            since, after, right = _walk(spelled, state)
            self.intact &= right
            within = right and state and after and since == len(spelled)  # still the same character
            open_bytes, state, at = open_bytes * bool(within) + since if after else 0, after, at + 1
        data, self.state = self.pending + data, state
        cut = len(data) - (open_bytes if state else 0)
        self.pending = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def finish(self) -> str:
        """What is left when no more ids come."""
        last, self.intact = self.pending.decode("utf-8", "replace"), self.intact and not self.pending
        self.pending, self.state = b"", 0
        return last


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(i) for t, i in map(bytes.split, filter(None, map(bytes.strip, lines)))}


@lru_cache(maxsize=1)
def text_encoder(path: str, pattern: str) -> TextEncoder:
    return TextEncoder(read_ranks(path), pattern)


@lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(read_ranks(path))


def encode_texts(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """Rows (doc_id long, ids array<int>) of every text, each match of ``pattern`` encoded by itself.

    ``ranks`` is a file of Base64 tokens and ranks that all executors can read. With ``decode`` the ids
    are also decoded again, as by ``decode_ids``, to the columns ``decoded`` and ``intact``. A null text counts
    as empty and has no ids. Rows that repeat an id or a text each have a row; a null id stays null. Other columns,
    whatever their names, stay behind. An empty table gives none. Long texts are matched in runs of a
    bounded number of matches; a single long match is read byte by byte, in time that grows with its length.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(ranks, pattern)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                ids, counts = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                offsets = pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids))
                columns = [part.column("doc_id"), lists, *(_decoded(lists, vocabulary(ranks)) if decode else ())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "decoded", "intact"][: len(columns)])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>" + (", decoded string, intact boolean" if decode else ""))


def _decoded(lists: pa.ListArray, words: Vocabulary, block: int = 1 << 16) -> list[pa.Array]:
    texts, intact = [], []
    for row in lists:
        ids = row.values.drop_null().to_numpy() if row.is_valid else np.zeros(0, np.int32)
        decoder = StreamDecoder(words)
        parts = [decoder.feed(ids[i : i + block]) for i in range(0, len(ids), block)]
        texts.append("".join([*parts, decoder.finish()]))
        intact.append(decoder.intact)
    return [pa.array(texts, pa.string()), pa.array(intact, pa.bool_())]


def decode_ids(encoded: DataFrame, ranks: str, id_col: str = "doc_id", ids_col: str = "ids", block: int = 1 << 16) -> DataFrame:
    """Rows (doc_id, text, intact): ids turned back to text, ``block`` of them at a time.

    ``intact`` is false where the bytes were not UTF-8; the text then holds U+FFFD. Null ids or a null
    list give an empty text; an id outside the vocabulary fails the job. Repeated rows stay, an
    empty table gives none, and other columns stay behind.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                columns = [batch.column("doc_id").slice(at, 256), *_decoded(batch.column("ids").slice(at, 256), words, block)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "intact"])

    cells = encoded.select(encoded[id_col].cast("long").alias("doc_id"), encoded[ids_col].cast("array<int>").alias("ids"))
    return cells.mapInArrow(run, "doc_id long, text string, intact boolean")
