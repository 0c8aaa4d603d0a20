"""Language identification by cross-parsing entropy.

A text is cut greedily into the longest phrases that occur in a language's labelled text. The
suffix automaton of that text recognises exactly its substrings, so following transitions from
the root gives the longest match. The language whose phrases, times the bits to name one,
are fewest wins.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.llm.common import bound_batches, free_name
from lavra.runtime import materialize

UNDETERMINED = "und"
# Bounds of the labelled sample that an automaton is built from, per language: whole texts, and
# characters of all of them. Texts of up to the first of these lengths are preferred.
SAMPLE_TEXTS = 64
SAMPLE_CHARS = 1 << 15
SHORT_CHARS, LONGEST_CHARS = 1 << 10, 1 << 16
# Bound of the automata of all languages, which every task gets.
MODEL_BYTES = 256 << 20

# Bytes of a text that are parsed side by side with others of it.
BLOCK = 512
# Texts parsed side by side: about so many bytes.
_GROUP_BYTES = 2 << 20

_DRAWS = (1 << 63) - 1
_PAD, _UNKNOWN = 0, 1
_LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Model:
    """Languages in ascending order, the class of each byte, and a parser per language.

    `parsers[i][state * classes + class]` holds the next state times `classes`, shifted left
    by two, plus the number of phrases that end there. `bits[i]` is the cost of a phrase.
    """

    languages: tuple[str, ...]
    classes: int
    class_of: np.ndarray
    parsers: tuple[np.ndarray, ...]
    bits: tuple[float, ...]


def normalised(text: str) -> bytes:
    """Lower case, with every run of other ASCII characters than letters as one space."""
    return regex.sub(rb"[^a-z\x80-\xff]+", b" ", text.lower().encode())


def train(samples: dict[str, list[str]]) -> Model:
    """Build the automata from a bounded sample: texts per language."""
    cleaned = {
        language: [part for part in map(normalised, texts) if part.strip()]
        for language, texts in sorted(samples.items())
    }
    cleaned = {language: parts for language, parts in cleaned.items() if parts}
    used = sorted({byte for parts in cleaned.values() for part in parts for byte in part})
    class_of = np.full(256, _UNKNOWN, np.uint8)
    class_of[used] = np.arange(2, 2 + len(used))
    classes = 2 + len(used)
    parsers, bits = [], []
    for parts in cleaned.values():
        coded = [class_of[np.frombuffer(part, np.uint8)].tolist() for part in parts]
        parsers.append(_parser(_suffix_automaton(coded), classes))
        bits.append(float(np.log2(1 + sum(map(len, coded)))))
    return Model(tuple(cleaned), classes, class_of, tuple(parsers), tuple(bits))


def _suffix_automaton(words: list[list[int]]) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts every substring of every word; state 0 is
    the root. Between words stands a symbol that no text has (-1)."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for word in words:
        for symbol in (*word, -1):
            new = len(moves)
            moves.append({})
            link.append(0)
            length.append(length[last] + 1)
            at = last
            while at >= 0 and symbol not in moves[at]:
                moves[at][symbol] = new
                at = link[at]
            if at >= 0:
                old = moves[at][symbol]
                if length[old] == length[at] + 1:
                    link[new] = old
                else:
                    copy = len(moves)
                    moves.append(dict(moves[old]))
                    link.append(link[old])
                    length.append(length[at] + 1)
                    while at >= 0 and moves[at].get(symbol) == old:
                        moves[at][symbol] = copy
                        at = link[at]
                    link[old] = link[new] = copy
            last = new
    return moves


def _parser(moves: list[dict[int, int]], classes: int) -> np.ndarray:
    """The automaton with restarts: where a match cannot grow, the phrase ends and the next
    one starts with the same symbol. A symbol the root does not know is a phrase itself."""
    first = np.array([moves[0].get(symbol, 0) for symbol in range(classes)])
    alone = (first == 0).astype(int)
    narrow = len(moves) * classes << 2 < 1 << 31
    table = np.empty((len(moves), classes), np.int32 if narrow else np.int64)
    table[0] = first * classes << 2 | alone
    table[1:] = first * classes << 2 | (1 + alone)
    for state, row in enumerate(moves):
        for symbol, target in row.items():
            if symbol >= 0:
                table[state, symbol] = target * classes << 2
        table[state, _PAD] = state * classes << 2
    return table.ravel()


def phrases(texts: list[bytes], model: Model) -> np.ndarray:
    """Number of phrases of every normalised text in every language.

    Blocks of all texts are parsed side by side. A block after another one is first parsed as if
    a phrase began with it, and its states are kept. Then, round by round, blocks whose
    predecessor ended in another state are parsed again from that state, until they meet a
    state that was kept: from there on both parses are the same, usually after some bytes. At
    the end every block has begun where its predecessor ended, as in one pass over the text.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    coded = model.class_of[np.frombuffer(b"".join(texts), np.uint8)]
    blocks = -(-lengths // BLOCK)
    owner = np.repeat(np.arange(len(texts)), blocks)
    first = np.cumsum(blocks) - blocks
    within = np.arange(len(owner)) - first[owner]
    starts = (np.cumsum(lengths) - lengths)[owner] + within * BLOCK
    sizes = np.minimum(lengths[owner] - within * BLOCK, BLOCK)
    # One column per block, longest first: each step follows one symbol of all that go on.
    order = np.argsort(-sizes, kind="stable")
    column = np.empty_like(order)
    column[order] = np.arange(len(order))
    later = np.flatnonzero(within > 0)
    follows = np.full(len(order), -1)
    follows[column[later]] = column[later - 1]
    last = column[(first + blocks - 1)[blocks > 0]]
    starts, sizes, owner = starts[order], sizes[order], owner[order]
    found = np.zeros((len(texts), len(model.languages)), np.int64)
    for i, parser in enumerate(model.parsers):
        parse = _Parse(parser, coded, starts, sizes)
        parse.settle(follows)
        found[:, i] = np.bincount(owner, weights=parse.counts, minlength=len(texts))
        # What has begun at a text's end is a phrase too.
        found[owner[last], i] += parse.ends[last] != 0
    return found


class _Parse:
    """Blocks in one language: the state after each byte, and counts of ended phrases."""

    def __init__(self, parser: np.ndarray, coded: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        self.parser, self.coded, self.starts, self.sizes = parser, coded, starts, sizes
        steps = int(sizes.max(initial=0))
        self.states = np.zeros((steps, len(starts)), parser.dtype)
        # Ended phrases up to each byte, less what later parses have added to the block's count.
        self.ended = np.zeros((steps, len(starts)), np.int32)
        self.begins = np.zeros(len(starts), np.int64)
        self.ends = np.zeros(len(starts), np.int64)
        state, count = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        for step, n in enumerate(self._going(steps, sizes)):
            move = parser[state[:n] + coded[starts[:n] + step]]
            count[:n] += move & 3
            state[:n] = move >> 2
            self.states[step, :n], self.ended[step, :n] = state[:n], count[:n]
        self.ends[:], self.counts = state, count

    @staticmethod
    def _going(steps: int, sizes: np.ndarray) -> np.ndarray:
        """How many columns, longest first, have a byte at each step."""
        return np.searchsorted(-sizes, -np.arange(steps), side="left")

    def settle(self, follows: np.ndarray) -> None:
        """Parse blocks again until each begins in the state in which the one that it follows
        (-1: none) has ended."""
        while True:
            wanted = np.where(follows >= 0, self.ends[follows], 0)
            again = np.flatnonzero(wanted != self.begins)
            if not len(again):
                return
            self.begins[again] = wanted[again]
            self._repeat(again)

    def _repeat(self, again: np.ndarray) -> None:
        """Parse the blocks `again` (columns, ascending) from where they now begin."""
        count = np.zeros(len(again), np.int64)
        state = self.begins[again]
        # The step at which each meets its former states; its size if it never does.
        met = self.sizes[again].copy()
        former = self.counts[again]
        left = np.arange(len(again))
        for step in range(int(self.sizes[again].max())):
            left = left[self.sizes[again[left]] > step]
            if not len(left):
                break
            at = again[left]
            move = self.parser[state[left] + self.coded[self.starts[at] + step]]
            count[left] += move & 3
            state[left] = move >> 2
            same = self.states[step, at] == state[left]
            joined = left[same]
            met[joined] = step
            # What follows is as before: only the count up to here may differ.
            count[joined] += self.counts[again[joined]] - self.ended[step, again[joined]]
            left, at = left[~same], at[~same]
            self.states[step, at], self.ended[step, at] = state[left], count[left]
        ran_out = met == self.sizes[again]
        self.ends[again[ran_out]] = state[ran_out]
        self.counts[again] = count
        # Kept counts are relative to the block's count: those of the new part follow it.
        added = count - former
        upto = int(met.max(initial=0))
        new = np.arange(upto)[:, None] < met[None, :]
        self.ended[:upto, again] += np.where(new, 0, added[None, :]).astype(np.int32)
        rest = self.ended[upto:]
        rest[:, again] += added[None, :].astype(np.int32)


def predict(texts: list[str | None], model: Model) -> pd.DataFrame:
    """`lang_pred` and `score` of every text; see `identify`."""
    languages, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    known = [i for i, text in enumerate(texts) if text and _LETTER.search(text)]
    at = 0 if model.languages else len(known)
    while at < len(known):
        group, size = [], 0
        while at + len(group) < len(known) and size < _GROUP_BYTES:
            group.append(normalised(texts[known[at + len(group)]]))
            size += len(group[-1])
        costs = phrases(group, model) * np.array(model.bits)
        best = costs.argmin(axis=1)
        lowest = np.partition(costs, min(1, costs.shape[1] - 1), axis=1)
        for i, winner, row in zip(known[at : at + len(group)], best, lowest, strict=True):
            languages[i] = model.languages[winner]
            scores[i] = 1.0 - row[0] / row[1] if len(row) > 1 else 1.0
        at += len(group)
    return pd.DataFrame({"lang_pred": languages, "score": scores})


def labelled_sample(docs: DataFrame, texts: int = SAMPLE_TEXTS) -> DataFrame:
    """Up to `texts` whole texts per `lang` from `docs` (`text`, `lang`), numbered by `place` in
    the order of their hashes; copies of a text count once. Rows without a language or a letter
    do not count.

    They are the ones of smallest hash among the texts of at most 1,024 characters, or, where
    a language has fewer than `texts` of these, twice that, and so on up to `LONGEST_CHARS`; a
    language with longer texts only is not learned. Rows are first cut to a multiple of what
    is needed by a threshold of the hash, so no task gets many rows of a frequent language.
    """
    size, draw = F.char_length("text"), F.shiftrightunsigned(F.xxhash64("text"), 1)
    usable = docs.where("lang is not null").where(F.col("text").rlike(r"\p{L}"))
    hashed = usable.select("lang", "text", size.alias("size"), draw.alias("draw"))
    limits = [SHORT_CHARS]
    while limits[-1] < LONGEST_CHARS:
        limits.append(2 * limits[-1])
    counts = hashed.groupBy("lang").agg(
        *[
            F.approx_count_distinct(F.when(F.col("size") <= limit, F.col("draw"))).alias(f"n{limit}")
            for limit in limits
        ]
    )
    # A row per language.
    longest, below = {}, {}
    for row in counts.collect():
        enough = [limit for limit in limits if row[f"n{limit}"] >= 2 * texts] or limits[-1:]
        longest[row["lang"]] = enough[0]
        below[row["lang"]] = row[f"n{enough[0]}"]
    if not longest:
        return hashed.select("lang", "text", F.lit(0).alias("place")).limit(0)
    times = 8
    while True:
        cut = {
            lang: min(_DRAWS, _DRAWS * times * texts // max(n, 1)) for lang, n in below.items()
        }
        within = F.col("size") <= F.try_element_at(_literal_map(longest), "lang")
        within &= F.col("draw") <= F.try_element_at(_literal_map(cut), "lang")
        alike = hashed.where(within).groupBy("lang", "draw").agg(F.min("text").alias("text"))
        order = Window.partitionBy("lang").orderBy("draw")
        placed = alike.withColumn("place", F.row_number().over(order))
        placed = materialize(placed.where(F.col("place") <= texts).drop("draw"), "sample")
        found = {r["lang"]: r["count"] for r in placed.groupBy("lang").count().collect()}
        if all(found.get(lang, 0) == texts or cut[lang] == _DRAWS for lang in cut):
            return placed.select("lang", "text", "place")
        times *= 16


def _literal_map(values: dict[str, int]) -> Column:
    entries = [F.lit(part) for lang, n in values.items() for part in (lang, n)]
    return F.create_map(*entries).cast("map<string,bigint>")


def fit(docs: DataFrame, texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) -> Model:
    """Learn from the labelled rows of `docs`; the driver gets the bounded sample only.

    A language's texts are taken in their order as long as they have no more than `chars`
    characters together, and the first one anyway. Every task gets the model, so its size is
    checked: with many languages each learns from fewer texts, until it is within MODEL_BYTES.
    """
    sample: dict[str, list[str]] = {}
    for row in labelled_sample(docs, texts).orderBy("lang", "place").toLocalIterator():
        sample.setdefault(row["lang"], []).append(row["text"])
    while True:
        model = train({lang: _first(of, texts, chars) for lang, of in sample.items()})
        if sum(parser.nbytes for parser in model.parsers) <= MODEL_BYTES or texts == 1:
            return model
        texts, chars = texts // 2, chars // 2


def _first(texts: list[str], most: int, chars: int) -> list[str]:
    totals = itertools.accumulate(map(len, texts))
    return [
        text
        for i, (text, total) in enumerate(zip(texts, totals, strict=True))
        if i == 0 or (i < most and total <= chars)
    ]


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with `lang_pred` and `score`, from the whole `text` alone.

    Null texts, texts without a letter, and all texts if nothing was learned get `und` and
    score 0. The score is the share by which the winner's cost is below the runner-up's: 0
    is a tie (the smaller language name wins), 1 means that there is no other language.
    Columns of the same names are replaced in place.
    """
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.pandas_udf("lang_pred string, score double")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parsers = Model(**shared.value)
        for batch in batches:
            yield predict(batch.tolist(), parsers)

    found = free_name(docs, "found")
    parsed = docs.withColumn(found, parse(F.col(text)))
    return parsed.withColumns(
        {name: F.col(f"{found}.{name}") for name in ("lang_pred", "score")}
    ).drop(found)


def is_held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: remainder 2 of the id's checksum; null ids are not."""
    remainder = F.crc32(doc_id.cast("string")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of `docs` whose language was found; `und` rows go. All columns stay."""
    model = fit(docs.where(~is_held_out(F.col("doc_id"))))
    bare = docs.withColumnsRenamed(
        {c: f"{free_name(docs, 'own')}_{c}" for c in docs.columns if c in ("lang_pred", "score")}
    )
    kept = identify(bare, model).where(F.col("lang_pred") != UNDETERMINED)
    return kept.drop("lang_pred", "score").toDF(*docs.columns)
