"""Language identification by cross-parsing: how few phrases of a language's text make up a document."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tidewell.llm.common import id_and_text, per_slice
from tidewell.session import stage

#: The classifier is fitted on so many slices per language, of so many characters, those with the smallest hashes.
SAMPLE_DOCS, SAMPLE_CHARS = 48, 500
#: Characters of training text over all languages together, which bounds the tables in a worker.
TRAINING_CHARS = 160_000
#: Letters whose transitions are in a dense table, the most frequent ones; those of all other letters are searched for.
ALPHABET = 60
#: Texts are parsed in parallel lanes of this many characters, each from the start state; where the lane before
#: ends in another state, the lane is parsed again from there until both parses are in one state.
LANE = 1024
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from: CRC-32 of the id as text, modulo 3, is 1 (a null id: no)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: whether it is a letter, and its lower case (itself if that is more than one)."""
    chars = [chr(i) for i in range(0x110000)]
    letter = np.fromiter((c.isalpha() for c in chars), bool, len(chars))
    lower = np.arange(len(chars), dtype=np.uint32)
    for i in np.flatnonzero(letter):
        if len(small := chars[i].lower()) == 1:
            lower[i] = ord(small)
    return letter, lower


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def suffix_automaton(codes: list[int], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Transitions (states x width, 0: none; state 1 is the start) of all substrings of a code sequence.

    Those by codes from ``width`` on come second, as rows (state, code, next state).
    """
    step, link, length, last = [None, {}], [0, 0], [0, 0], 1
    for c in codes:
        new = len(step)
        step.append({}), link.append(0), length.append(length[last] + 1)
        p = last
        while p and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if not p:
            link[new] = 1
        elif length[q := step[p][c]] == length[p] + 1:
            link[new] = q
        else:
            twin = len(step)
            step.append(dict(step[q])), link.append(link[q]), length.append(length[p] + 1)
            while p and step[p].get(c) == q:
                step[p][c] = twin
                p = link[p]
            link[q] = link[new] = twin
        last = new
    table, others = np.zeros((len(step), width), np.int32), []
    for s, moves in enumerate(step[1:], 1):
        for c, t in moves.items():
            if c < width:
                table[s, c] = t
            else:
                others.append((s, c, t))
    return table, np.array(others, np.int64).reshape(-1, 3)


class Parser:
    """Cross-parses texts against the training text of each language.

    Codes: 0 padding, 1 anything but letters, 2 a letter that no training text has, 3 and up letters,
    the most frequent first.
    A parse takes the longest match with the training text again and again; a character without any
    match is a phrase. The move table of a language holds, per state and code, the next state and
    the phrases that end there, so that one step of all lanes and languages is one lookup; codes
    beyond its width are looked up in a sorted list of (state, code).
    """

    def __init__(self, training: tuple[tuple[str, tuple[str, ...]], ...]) -> None:
        self.names = [name for name, _ in training]
        self.letter, lower = _letters()
        points = np.concatenate([_points(t) for _, texts in training for t in texts] or [np.zeros(0, np.uint32)])
        seen, counts = np.unique(lower[points[self.letter[points]]], return_counts=True)
        kept = seen[np.argsort(-counts, kind="stable")]
        self.codes = 3 + len(kept)
        kind = np.min_scalar_type(self.codes)
        code = np.full(0x110000, 2, kind)
        code[kept] = np.arange(3, self.codes)
        self.code = np.where(self.letter, code[lower], 1).astype(kind)
        self.width = min(self.codes, 3 + ALPHABET)
        tables, starts, base, keys, targets, roots = [], [], 0, [], [], []
        for _, texts in training:
            codes: list[int] = []
            for t in texts:
                codes += [*self._clean(t).tolist(), 2]  # the code without transitions keeps slices apart
            table, others = suffix_automaton(codes, self.width)
            root = np.zeros(self.codes, np.int32)
            state, by, to = others.T
            root[by[state == 1]] = to[state == 1] + base
            keys.append((state + base) * self.codes + by), targets.append(to + base), roots.append(root)
            table[:, :1] = table[:, 2:3] = 0
            again = np.broadcast_to(table[1], table.shape)
            closed = (np.arange(len(table)) != 1)[:, None].astype(np.int32)
            following = np.where(table > 0, table, np.where(again > 0, again, 1))
            ended = np.where(table > 0, 0, closed + (again == 0))
            following[:, 0], ended[:, 0] = np.arange(len(table)), 0
            tables.append(((following + base) << 2 | ended).astype(np.int32))
            starts.append(base + 1)
            base += len(table)
        self.moves = np.concatenate([t.ravel() for t in tables]) if tables else np.zeros(0, np.int32)
        self.starts = np.array(starts, np.int32)
        # The last key is beyond all others, so that each search ends at one.
        self.keys = np.concatenate([*keys, np.array([np.iinfo(np.int64).max])])
        order = np.argsort(self.keys)
        self.keys, self.targets = self.keys[order], np.concatenate([*targets, np.zeros(1, np.int64)])[order].astype(np.int32)
        self.roots = np.array(roots, np.int32).reshape(-1, self.codes)

    def _step(self, state: np.ndarray, codes: np.ndarray, lang: np.ndarray, wide: bool) -> np.ndarray:
        """Next states, times four, and the phrases that end there, for states of the languages ``lang``."""
        if not wide:
            return self.moves[state * np.int32(self.width) + codes]
        move = self.moves[state * np.int32(self.width) + np.where(codes < self.width, codes, 2)]
        if not (rare := codes >= self.width).any():
            return move
        # Codes beyond the table: the transition, or the end of a phrase and the start of the next.
        codes, wanted = codes.astype(np.int64), state.astype(np.int64) * self.codes + codes
        at = np.searchsorted(self.keys, wanted)
        again, start = self.roots[lang, codes], self.starts[lang]
        failed = np.where(again > 0, again, start) << 2 | ((state != start).astype(np.int32) + (again == 0))
        return np.where(rare, np.where(self.keys[at] == wanted, self.targets[at] << 2, failed), move)

    def _clean(self, text: str) -> np.ndarray:
        codes = self.code[_points(text)]
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 1) | (codes[:-1] != 1)
        return codes[keep]

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases per text and language, over its characters; and whether the text has a letter."""
        clean = [self._clean(t) if t else np.zeros(0, self.code.dtype) for t in texts]
        sizes = np.fromiter(map(len, clean), np.int64, len(clean))
        lanes = -(-sizes // LANE)
        owner = np.repeat(np.arange(len(clean)), lanes)
        grid = np.zeros((int(lanes.sum()), LANE), self.code.dtype)
        flat, at = grid.ravel(), 0
        for c, n in zip(clean, lanes):
            flat[at : at + len(c)] = c
            at += int(n) * LANE
        filled = np.full(len(owner), LANE)
        ends = np.cumsum(lanes) - 1
        filled[ends[lanes > 0]] = (sizes - (lanes - 1) * LANE)[lanes > 0]
        order = np.argsort(-filled, kind="stable")
        columns, filled = np.ascontiguousarray(grid[order].T), filled[order]
        lang = np.arange(len(self.names))[:, None]
        state = np.repeat(self.starts[:, None], len(order), 1)
        count = np.zeros(state.shape, np.int32)
        live = np.searchsorted(-filled, -np.arange(1, LANE + 1), side="right")  # lanes that reach each column
        wide = self.codes > self.width and bool((grid >= self.width).any())
        for j in range(int(filled[0]) if len(filled) else 0):
            n = live[j]
            move = self._step(state[:, :n], columns[j, :n], lang, wide)
            count[:, :n] += move & 3
            state[:, :n] = move >> 2
        back = np.argsort(order)
        state, count, filled = state[:, back], count[:, back], filled[back]
        self._carry(grid, filled, owner, state, count, wide)
        last = np.append(owner[1:] != owner[:-1], True)[: len(owner)]
        count += (state != self.starts[:, None]) & last
        total = np.zeros((len(self.names), len(clean)))
        for k in range(len(self.names)):
            total[k] = np.bincount(owner, count[k], len(clean))
        lettered = np.fromiter((bool((c > 1).any()) for c in clean), bool, len(clean))
        return total / np.maximum(sizes, 1), lettered

    def _carry(self, grid: np.ndarray, filled: np.ndarray, owner: np.ndarray, state: np.ndarray, count: np.ndarray, wide: bool) -> None:
        """Correct end states and counts of lanes, in place, for the state that the lane before ends in.

        Both parses of a lane go on side by side and stop where they meet, mostly within some
        phrases; from there on they agree. A lane in which they do not meet passes its new end on.
        """
        used = np.repeat(self.starts[:, None], len(filled), 1)
        inner = np.flatnonzero(owner[1:] == owner[:-1]) + 1  # lanes that go on with a text
        while True:
            lang, at = np.nonzero(used[:, inner] != state[:, inner - 1])
            if not len(lang):
                return
            lane = inner[at]
            old, new = used[lang, lane], state[lang, lane - 1]
            used[lang, lane] = new
            for j in range(LANE):
                open_ = filled[lane] > j
                if not open_.all():  # ended apart
                    state[lang[~open_], lane[~open_]] = new[~open_]
                    lang, lane, old, new = lang[open_], lane[open_], old[open_], new[open_]
                if not len(lane):
                    break
                codes = grid[lane, j]
                a, b = self._step(old, codes, lang, wide), self._step(new, codes, lang, wide)
                np.add.at(count, (lang, lane), (b & 3) - (a & 3))
                apart = (a >> 2) != (b >> 2)
                lang, lane, old, new = lang[apart], lane[apart], a[apart] >> 2, b[apart] >> 2
            state[lang, lane] = new


@lru_cache(maxsize=1)
def parser(training: tuple[tuple[str, tuple[str, ...]], ...]) -> Parser:
    return Parser(training)


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[tuple[str, tuple[str, ...]], ...]:
    """Training text per language: bounded slices of the distinct labelled texts with the smallest hashes.

    Rows with a null label or text, or without a letter, are left out. The number of labels is
    taken to be that of a set of languages; the more there are, the less text each one keeps.
    """
    rows = labelled.select(labelled[lang_col].cast("string").alias("lang"), labelled[text_col].cast("string").alias("text"))
    rows = rows.where("lang is not null and text rlike '\\\\p{L}'").withColumn("hash", F.xxhash64("text"))
    texts = stage(rows.select("lang", "hash").distinct(), "language-hashes")
    names = texts.select("lang").distinct().count()
    if not names:
        return ()
    docs = max(1, min(SAMPLE_DOCS, TRAINING_CHARS // (SAMPLE_CHARS * names)))
    place = F.pmod("hash", F.lit(1 << 30))
    # The smallest of each part of a language, then those of the language: no language is one task.
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("hash"), F.lit(64))).orderBy(place, "hash")
    few = texts.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= docs)
    whole = Window.partitionBy("lang").orderBy(place, "hash")
    chosen = few.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= docs).select("lang", "hash")
    near = rows.join(F.broadcast(chosen), ["lang", "hash"])  # so many slices as learned from at most
    first = F.greatest(F.lit(0), F.pmod(F.xxhash64("hash"), F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(1)))) + 1
    ranked = near.select("lang", "hash", F.col("text").substr(first.cast("int"), F.lit(SAMPLE_CHARS)).alias("slice")).distinct()
    best = ranked.groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(F.struct(place.alias("h"), "slice"))), 1, docs).alias("s"))
    return tuple(sorted((r["lang"], tuple(x["slice"] for x in r["s"])) for r in best.collect()))


def identify(
    docs: DataFrame, training: tuple[tuple[str, tuple[str, ...]], ...], id_col: str = "doc_id", text_col: str = "text",
    keep: bool = False,
) -> DataFrame:
    """One row per document: doc_id, lang_pred, score; with ``keep`` also ``row``, the whole input row.

    The language whose text parses the document into the fewest phrases per character wins; of
    equal ones the first by name. ``score`` is by how much the second-best needs more phrases, as a
    share of its own. A null text, or one without a letter, is ``und`` with score 0; so is every
    text where nothing was learned. Repeated rows give repeated rows, an empty table none. Phrases of a
    text of any length are those of one parse from its start. With ``keep`` the row keeps all its
    columns, also those that are named like results; otherwise only the two are read.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, p = batch.column("text").to_pylist(), parser(training)
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if p.names and texts:
            rate, lettered = p.phrases(texts)
            best = rate.argmin(0)
            ranked = np.sort(rate, 0)
            if len(p.names) > 1:
                scores = np.where(lettered, 1 - ranked[0] / np.maximum(ranked[1], 1e-12), 0.0).clip(0, 1)
            else:
                scores = lettered.astype(float)
            langs = [p.names[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
        cells, names = [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"]
        if keep:
            cells, names = [*cells, batch.column("text"), batch.column("row")], [*names, "text", "row"]
        return pa.RecordBatch.from_arrays(cells, names)

    if not keep:
        return id_and_text(docs, id_col, text_col).mapInArrow(per_slice(run, limit=2 << 20), "doc_id long, lang_pred string, score double")
    # The text travels once; the other columns go beside it and the row is put together again after.
    others = F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != text_col]) if len(docs.columns) > 1 else F.lit(None).cast("int")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"), others.alias("row"))
    kinds = [("doc_id", LongType()), ("lang_pred", StringType()), ("score", DoubleType()), ("text", StringType())]
    found = rows.mapInArrow(per_slice(run, limit=2 << 20), StructType([*(StructField(n, t) for n, t in kinds), rows.schema["row"]]))
    text = F.col("text").cast(docs.schema[text_col].dataType).alias(text_col)
    whole = F.struct(*[text if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
    return found.select("doc_id", "lang_pred", "score", whole.alias("row"))
