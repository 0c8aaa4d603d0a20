"""Fill-in-middle transformation, with texts measured chunk by chunk.

A rolling hash cuts the bytes of a text into chunks where their content says so, so equal
passages give equal chunks wherever they stand. What a cut needs to know of a chunk (its code
points, and what could make or hold a control string) is worked out once per content and
remembered under the content itself. Adding up the chunks' counts tells which chunk holds a cut,
and only that chunk is searched.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lavra.llm.common import bound_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
CONTROLS = (PREFIX, SUFFIX, MIDDLE)
SEED = 1
TRANSFORMED_PERCENT = 90
SUFFIX_FIRST_PERCENT = 20

# Bytes of a chunk: a cut is allowed from the first, expected after the second, made at the third.
SHORTEST, MEAN_BITS, LONGEST = 64, 9, 4096
# Bytes of chunks that a Python worker remembers at most.
MEMORY_BYTES = 32 << 20

_WINDOW = 32
# Bytes that are hashed at once, so that a text of any length needs the same memory.
_BLOCK = 1 << 20
_NEW = ("n", "form", "prefix_chars", "middle_chars", "output")


class Summary(NamedTuple):
    """What the cuts need to know of a chunk's bytes."""

    # Code points that begin in the chunk; the first bytes may end one that began before.
    points: int
    ascii: bool
    control: bool
    head: bytes
    tail: bytes


def _control_in(content: bytes) -> bool:
    return any(control.encode() in content for control in CONTROLS)


def _begins(content: bytes) -> np.ndarray:
    """Whether a code point begins at each byte."""
    return (np.frombuffer(content, np.uint8) & 0xC0) != 0x80


def summarize(content: bytes) -> Summary:
    plain = content.isascii()
    points = len(content) if plain else int(np.count_nonzero(_begins(content)))
    return Summary(points, plain, _control_in(content), content[:2], content[-2:])


class Memory:
    """Summaries by content. Equal content is told by comparing bytes, never by a hash alone.

    Two generations bound the bytes: the older one goes when the newer one is half the bound,
    and what is used again moves to the newer one.
    """

    def __init__(self, most: int = MEMORY_BYTES):
        self.most, self.size, self.worked_out = most // 2, 0, 0
        self.new: dict[bytes, Summary] = {}
        self.old: dict[bytes, Summary] = {}

    def summary(self, content: bytes) -> Summary:
        found = self.new.get(content)
        if found is None:
            found = self.old.get(content)
            if found is None:
                found = summarize(content)
                self.worked_out += 1
            if self.size + len(content) > self.most:
                self.old, self.new, self.size = self.new, {}, 0
            self.new[content] = found
            self.size += len(content)
        return found


def _byte_weights() -> np.ndarray:
    """A fixed 32-bit weight per byte value, from a multiplicative hash."""
    mixed = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(29)
    return (mixed ^ (mixed >> np.uint64(15))).astype(np.uint32)


def _hash_cuts(text: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Ends of possible chunks: where the rolling hash of the last 32 bytes is small.

    Each byte's weight moves left by a bit per later byte, so it has left the 32 bits when it
    leaves the window; the sum is built by doubling the window five times.
    """
    found = []
    for start in range(0, len(text), _BLOCK):
        before = max(0, start - _WINDOW + 1)
        rolling = weights[text[before : start + _BLOCK]]
        for step in (1, 2, 4, 8, 16):
            shifted = rolling[:-step] << np.uint32(step)
            rolling[step:] += shifted
        small = np.flatnonzero(rolling[start - before :] >> np.uint32(32 - MEAN_BITS) == 0)
        found.append(small + start + 1)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def chunk_ends(text: np.ndarray, weights: np.ndarray) -> list[int]:
    """Ends of the chunks of a text (bytes as numbers). Only the bytes up to an end decide it,
    at most the longest chunk's, so equal passages fall into step after a chunk or two."""
    size = len(text)
    if size <= SHORTEST:
        return [size] if size else []
    ends, start = [], 0
    for cut in _hash_cuts(text, weights).tolist():
        while cut - start > LONGEST:
            start += LONGEST
            ends.append(start)
        if cut - start >= SHORTEST:
            start = cut
            ends.append(cut)
    while size - start > LONGEST:
        start += LONGEST
        ends.append(start)
    if start < size:
        ends.append(size)
    return ends


class Measured:
    """A text as chunks: code points, control strings, and where a code point begins."""

    def __init__(self, text: bytes, weights: np.ndarray, memory: Memory):
        self.text = text
        self.ends = chunk_ends(np.frombuffer(text, np.uint8), weights)
        starts = [0, *self.ends[:-1]]
        self.chunks = [
            memory.summary(text[a:b]) for a, b in zip(starts, self.ends, strict=False)
        ]
        self.totals = np.cumsum([chunk.points for chunk in self.chunks])
        self.points = int(self.totals[-1]) if self.chunks else 0

    def has_control(self) -> bool:
        """Inside a chunk, or across the ends of neighbours: control strings have three bytes
        and all chunks but the last have more than that."""
        if any(chunk.control for chunk in self.chunks):
            return True
        return any(
            _control_in(a.tail + b.head)
            for a, b in zip(self.chunks, self.chunks[1:], strict=False)
            if a.tail.endswith((b"<", b"<P", b"<S", b"<M"))
        )

    def byte_of(self, point: int) -> int:
        """The byte at which code point `point` begins; the text's end for their number."""
        if point >= self.points:
            return len(self.text)
        at = int(np.searchsorted(self.totals, point, side="right"))
        start = self.ends[at - 1] if at else 0
        inside = point - (int(self.totals[at - 1]) if at else 0)
        if self.chunks[at].ascii:
            return start + inside
        return start + int(np.flatnonzero(_begins(self.text[start : self.ends[at]]))[inside])


def transform_text(text: bytes, h: tuple, weights: np.ndarray, memory: Memory) -> tuple:
    """Code points, form, prefix and middle length (code points) and output of one text, by
    four hashes `h`: two for the cuts, one for plain or not, one for the order."""
    measured = Measured(text, weights, memory)
    n = measured.points
    if not n or h[2] % 100 >= TRANSFORMED_PERCENT or measured.has_control():
        return n, "plain", None, None, text
    first, last = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b = measured.byte_of(first), measured.byte_of(last)
    p, s, m = (control.encode() for control in CONTROLS)
    if h[3] % 100 < SUFFIX_FIRST_PERCENT:
        return n, "spm", first, last - first, b"".join((s, text[b:], p, text[:a], m, text[a:b]))
    return n, "psm", first, last - first, b"".join((p, text[:a], s, text[b:], m, text[a:b]))


def draws(id: Column, seed: int = SEED) -> Column:
    """Four unsigned 32-bit numbers (array<bigint>): the first four groups of eight digits of
    the SHA-256 of `seed:id`; a null id counts as empty text."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))), 256)
    groups = [F.substring(digits, 8 * i + 1, 8) for i in range(4)]
    return F.array(*[F.conv(group, 16, 10).cast("bigint") for group in groups])


def transform(
    docs: DataFrame, id: str = "doc_id", text: str = "text", seed: int = SEED
) -> DataFrame:
    """`docs` with `n` (code points), `form`, `prefix_chars`, `middle_chars` and `output`.

    The text is cut at two places drawn by its id into prefix, middle and suffix. `form` is
    plain (output is the text; lengths are null) for empty texts, texts that hold a control
    string and a tenth of the others; else spm (suffix first) for a fifth and psm for the rest.
    Null text counts as empty, a null id as empty text; rows with the same id and text are
    alike. A column of `docs` named like a new one, in either case, is replaced.
    """
    bound_batches(docs.sparkSession)

    @F.arrow_udf(
        "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    )
    def forms(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        weights, memory = _byte_weights(), Memory()
        for texts, hashes in batches:
            drawn = hashes.flatten().to_numpy(zero_copy_only=False).reshape(-1, 4).tolist()
            rows = [
                transform_text(one.as_buffer().to_pybytes(), h, weights, memory)
                for one, h in zip(texts, drawn, strict=True)
            ]
            n, form, prefix, middle, output = zip(*rows, strict=True) if rows else ([],) * 5
            yield pa.StructArray.from_arrays(
                [
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    # Bytes as they came, also where they are no valid UTF-8.
                    pa.array(output, pa.binary()).view(pa.string()),
                ],
                names=list(_NEW),
            )

    made = forms(F.coalesce(docs[text], F.lit("")), draws(docs[id], seed))
    kept = [docs[name] for name in docs.columns if name.lower() not in _NEW]
    # One name that no kept column has; the struct is computed once and then taken apart.
    whole = "_" * max((len(name) for name in docs.columns), default=0) + "_made"
    return docs.select(*kept, made.alias(whole)).select(
        *[F.col(f"`{name}`") for name in docs.columns if name.lower() not in _NEW],
        *[F.col(whole)[name].alias(name) for name in _NEW],
    )


def restore(output: Column, form: Column) -> Column:
    """The text that `output` was made of. Control strings stand only where they were put, so
    the first of each ends the part before it."""

    def after(whole: Column, part: Column) -> Column:
        return F.substr(whole, F.length(part) + F.lit(4))

    def parts(second: str) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.lit(4))
        one = F.substring_index(body, second, 1)
        rest = after(body, one)
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, after(rest, two)

    prefix, suffix, middle = parts(SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
