"""Secret scans: fixed rules, and character Markov models for random strings without a rule.

Everything is made of SQL functions; positions count code points and ends are exclusive.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lavra.llm.common import free_name

# The kinds in the order of the report, with pattern and least length. The
# length of `assign` is that of its value, group 2. Runs are matched whole, so asking for
# the least length in the pattern of `access` and `hex` finds the same matches.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
    r"([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
# Strings that the models judge; only those with a letter, since numbers are no secrets.
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
CANDIDATE_LENGTH = 16

# A candidate, or a stretch of one, is random from this log-likelihood ratio on (natural logarithm).
MIN_RATIO = 10.0
# Bounds of the labelled sample: documents, and identifiers of each.
SAMPLE_DOCS = 2000
SAMPLE_IDENTIFIERS = 100

_CODES = 128
_SMOOTHING = 0.5
# Share of a pair's likelihood that comes from the kinds of its characters (lower case, upper case,
# digit, other) alone: words that no sample has are still ordinary, a digit inside one is not.
BACKOFF = 0.2
_KINDS = (("a", "z"), ("A", "Z"), ("0", "9"))
_REDACTED = "[SECRET]"


def _matches(text: Column, pattern: str) -> Column:
    """Start, end and text of every match, from the texts between and in the matches."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    nothing = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def grow(state: Column, step: Column) -> Column:
        start = state["at"] + F.char_length(step["gap"])
        end = start + F.char_length(step["value"])
        span = F.struct(start.alias("start"), end.alias("end"), step["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    steps = F.zip_with(
        F.slice(gaps, 1, F.size(found)),
        found,
        lambda gap, value: F.struct(gap.alias("gap"), value.alias("value")),
    )
    start = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))
    spans = F.aggregate(steps, start, grow, lambda state: state["spans"])
    return F.when(text.rlike(pattern), spans).otherwise(nothing)


def _spans(matches: Column, kind: str) -> Column:
    rank = F.lit(KINDS.index(kind))
    return F.transform(
        matches, lambda m: F.struct(m["start"].alias("start"), rank.alias("rank"), m["end"])
    )


def _codes(text: Column) -> Column:
    """ASCII codes of the characters; others count as 0."""
    return F.transform(
        F.split(text, ""),
        lambda c: F.when(F.ascii(c) < _CODES, F.ascii(c)).otherwise(F.lit(0)),
    )


def _ratio(value: Column, weights: Column) -> Column:
    """Sum of the weights of all neighbouring characters."""
    return F.aggregate(
        F.transform(
            F.array(_codes(value)),
            lambda codes: F.zip_with(
                F.slice(codes, 1, F.size(codes) - 1),
                F.slice(codes, 2, F.size(codes) - 1),
                lambda a, b: F.get(weights, a * _CODES + b),
            ),
        )[0],
        F.lit(0.0),
        lambda total, weight: total + weight,
    )


def _let(value: Column, body) -> Column:
    """`body(value)`, with `value` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _stretches(value: Column, weights: Column, least: float) -> Column:
    """`all`, the sum over the whole `value`, and `found`: start and end of its stretches whose
    sum reaches `least`, by the maximum running sum.

    A stretch ends at its highest sum, once the sum is used up or has fallen by `least`, so
    what lies between stretches has none. `=` before anything but `=` ends a name. Ordinary
    samples have hardly a separator, so a pair with one adds nothing to a stretch.
    """
    equals, marks = ord("="), [ord(c) for c in "+/_=-"]
    pairs = _let(
        _codes(value),
        lambda codes: F.zip_with(
            F.slice(codes, 1, F.size(codes) - 1),
            F.slice(codes, 2, F.size(codes) - 1),
            lambda a, b: F.struct(
                F.get(weights, a * _CODES + b).alias("weight"),
                ((a == equals) & (b != equals)).alias("cut"),
                (a.isin(marks) | b.isin(marks)).alias("mark"),
            ),
        ),
    )

    def emitted(found: Column, start: Column, end: Column, best: Column) -> Column:
        span = F.struct(start.alias("start"), end.alias("end"))
        return F.when(best >= least, F.concat(found, F.array(span))).otherwise(found)

    def step(state: Column, pair: Column) -> Column:
        gain = F.when(pair["mark"], F.least(pair["weight"], F.lit(0.0))).otherwise(pair["weight"])
        total = state["sum"] + gain
        higher = ~pair["cut"] & (total > state["best"])
        best = F.when(higher, total).otherwise(state["best"])
        end = F.when(higher, state["at"] + 2).otherwise(state["end"])
        closed = pair["cut"] | (total <= 0) | (best - total >= least)
        found = emitted(state["found"], state["start"], end, best)
        return F.struct(
            (state["at"] + 1).alias("at"),
            (state["all"] + pair["weight"]).alias("all"),
            F.when(closed, F.lit(0.0)).otherwise(total).alias("sum"),
            F.when(closed, F.lit(0.0)).otherwise(best).alias("best"),
            F.when(closed, state["at"] + 1).otherwise(state["start"]).alias("start"),
            end.alias("end"),
            F.when(closed, found).otherwise(state["found"]).alias("found"),
        )

    zero, none = F.lit(0), F.array().cast("array<struct<start:int,end:int>>")
    first = F.struct(
        zero.alias("at"),
        F.lit(0.0).alias("all"),
        F.lit(0.0).alias("sum"),
        F.lit(0.0).alias("best"),
        zero.alias("start"),
        zero.alias("end"),
        none.alias("found"),
    )
    return F.aggregate(
        pairs,
        first,
        step,
        lambda state: F.struct(
            state["all"].alias("all"),
            emitted(state["found"], state["start"], state["end"], state["best"]).alias("found"),
        ),
    )


def _random_spans(match: Column, weights: Column, least: float) -> Column:
    """Start and end in the text of what is random in a candidate.

    A stretch grows to the letters and digits it is glued to, and counts if it has a letter
    and the least length, or if all of the candidate is random. If that is so without any
    such stretch, the candidate counts as a whole.
    """
    value = match["value"]

    def grown(span: Column) -> Column:
        before = F.reverse(F.substr(value, F.lit(1), span["start"]))
        after = F.substr(value, span["end"] + 1)
        left, right = (
            F.char_length(F.regexp_extract(side, "^[A-Za-z0-9]*", 0)) for side in (before, after)
        )
        return F.struct(
            (span["start"] - left).alias("start"),
            (span["end"] + right).alias("end"),
            (span["end"] - span["start"]).alias("scored"),
        )

    def text(span: Column) -> Column:
        return F.substr(value, span["start"] + 1, span["end"] - span["start"])

    def counts(judged: Column):
        def check(span: Column) -> Column:
            alone = (span["end"] - span["start"] >= CANDIDATE_LENGTH) & (
                _ratio(text(span), weights) >= least
            )
            return text(span).rlike("[A-Za-z]") & (
                (judged["all"] >= least) | (span["scored"] >= CANDIDATE_LENGTH) | alone
            )

        return check

    def placed(start: Column, end: Column) -> Column:
        return F.struct(
            (match["start"] + start).cast("int").alias("start"),
            (match["start"] + end).cast("int").alias("end"),
        )

    def join(spans: Column, span: Column) -> Column:
        last = F.get(spans, F.size(spans) - 1)
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        merged = F.concat(F.slice(spans, 1, F.size(spans) - 1), F.array(longer))
        apart = F.concat(spans, F.array(span))
        touching = F.coalesce(span["start"] < last["end"], F.lit(False))
        return F.when(touching, merged).otherwise(apart)

    def spans(judged: Column) -> Column:
        kept = F.filter(F.transform(judged["found"], grown), counts(judged))
        joined = F.aggregate(
            F.transform(kept, lambda span: placed(span["start"], span["end"])),
            F.array().cast("array<struct<start:int,end:int>>"),
            join,
        )
        whole = F.when(
            judged["all"] >= least, F.array(placed(F.lit(0), F.char_length(value)))
        ).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
        return _let(joined, lambda found: F.when(F.size(found) > 0, found).otherwise(whole))

    return _let(_stretches(value, weights, least), spans)


def labelled_sample(
    docs: DataFrame, documents: int = SAMPLE_DOCS, identifiers: int = SAMPLE_IDENTIFIERS
) -> DataFrame:
    """Strings (`value`) with `is_random`, from the documents whose texts have the smallest hashes.

    Random: what the fixed rules find, and digests of the texts in Base64, in hexadecimal, and
    in letters of one case with digits.
    Ordinary: identifiers of documents without a secret, alone and joined in the usual ways.
    """
    # Hashes first, so that no task ever gets more than the sample's texts.
    hashed = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "draw", F.xxhash64("text")
    )
    lowest = hashed.select("draw").distinct().orderBy("draw").limit(documents)
    drawn = hashed.where(F.col("draw") <= lowest.select(F.max("draw")).scalar())
    drawn = drawn.select("text").distinct()
    ruled = F.concat(
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)),
        F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )
    digest = F.sha2("text", 256)
    parts = [F.conv(F.substring(digest, at, 12), 16, 36) for at in (1, 13, 25)]
    random = F.concat(
        F.array(F.regexp_replace(F.base64(F.unhex(digest)), "=", ""), digest),
        F.array(F.concat(*parts), F.lower(F.concat(*parts))),
        F.filter(ruled, lambda value: F.char_length(value) >= ASSIGN_VALUE),
    )
    found = F.array_distinct(
        F.regexp_extract_all("text", F.lit(r"\b[A-Za-z][A-Za-z0-9]{2,23}\b"), F.lit(0))
    )
    # Those of smallest hash: they stand anywhere in the text.
    drawn_names = F.sort_array(
        F.transform(found, lambda v: F.struct(F.xxhash64(v).alias("h"), v.alias("v")))
    )
    names = F.transform(F.slice(drawn_names, 1, identifiers), lambda s: s["v"])
    following = F.concat(F.slice(F.col("names"), 2, identifiers), F.slice(F.col("names"), 1, 1))
    joined = F.zip_with(
        "names",
        following,
        lambda a, b: F.array(
            a,
            F.concat_ws("_", a, b),
            F.upper(F.concat_ws("_", a, b)),
            F.concat(a, F.initcap(b)),
        ),
    )
    plain = F.when(F.size(ruled) == 0, F.flatten(joined)).otherwise(F.array())
    sample = drawn.withColumn("names", names).select(
        F.explode(
            F.concat(
                F.transform(random, lambda v: F.struct(v.alias("value"), F.lit(True).alias("r"))),
                F.transform(plain, lambda v: F.struct(v.alias("value"), F.lit(False).alias("r"))),
            )
        ).alias("s")
    )
    return sample.select("s.value", F.col("s.r").alias("is_random"))


def train(sample: DataFrame) -> list[float]:
    """Log-likelihood ratios of every pair of ASCII codes, random against ordinary.

    A class's likelihood of a second character mixes its count after the first one with the
    count of its kind after the first one's kind, spread over the kind. Counts of both classes
    get the same smoothing, so a class without samples is a uniform model. Null and
    one-character values teach nothing.
    """
    codes = sample.where("char_length(value) > 1").select(
        "is_random", _codes(F.col("value")).alias("c")
    )
    pairs = F.zip_with(
        F.slice("c", 1, F.size("c") - 1),
        F.slice("c", 2, F.size("c") - 1),
        lambda a, b: (a * _CODES + b).cast("bigint"),
    )
    counted = (
        codes.select("is_random", F.explode(pairs).alias("pair"))
        .groupBy("pair")
        .agg(
            F.count_if("is_random").alias("random"),
            F.count_if(~F.col("is_random")).alias("plain"),
        )
    )
    sizes = [ord(last) - ord(first) + 1 for first, last in _KINDS]
    sizes.append(_CODES - sum(sizes))
    first, second = (F.col("pair") / _CODES).cast("int"), (F.col("pair") % _CODES).cast("int")
    cells = (
        codes.sparkSession.range(_CODES * _CODES)
        .withColumnRenamed("id", "pair")
        .join(counted, "pair", "left")
        .na.fill(0)
        .withColumns({"first": first, "kind": _kind(first), "next_kind": _kind(second)})
        .withColumn("size", F.get(F.array(*map(F.lit, sizes)), F.col("next_kind")))
    )

    def likelihood(count: str) -> Column:
        def total(*by: str) -> Column:
            # The table has a row per pair of codes.
            return F.sum(count).over(Window.partitionBy(*by))

        own = (F.col(count) + _SMOOTHING) / (total("first") + _SMOOTHING * _CODES)
        kinds = (total("kind", "next_kind") + _SMOOTHING) / (
            total("kind") + _SMOOTHING * len(sizes)
        )
        return F.log((1 - BACKOFF) * own + BACKOFF * kinds / F.col("size"))

    ratio = likelihood("random") - likelihood("plain")
    rows = cells.select("pair", F.round(ratio, 5).alias("weight")).orderBy("pair").collect()
    return [row["weight"] for row in rows]


def _kind(code: Column) -> Column:
    """The place of a code's kind in `_KINDS`; behind all for other codes."""
    kind = F.lit(len(_KINDS))
    for i, (low, high) in enumerate(_KINDS):
        kind = F.when(code.between(ord(low), ord(high)), i).otherwise(kind)
    return kind


def scan(
    docs: DataFrame, weights: list[float], name: str = "secrets", min_ratio: float = MIN_RATIO
) -> DataFrame:
    """`docs` with `name`: an array of (start, rank, end), sorted, rank being the place in `KINDS`.

    Rules look for leftmost non-overlapping matches per kind. Candidates that share a
    character with a rule's span are left to the rule; of the others the stretches whose
    log-likelihood ratio by the models reaches `min_ratio` become spans of kind `random`,
    whatever name or path they are glued to. Null text is empty.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    base, guess = free_name(docs, "base"), free_name(docs, "guess")
    assign = F.when(
        text.rlike(ASSIGN),
        F.transform(
            F.filter(
                F.arrays_zip(
                    _matches(text, ASSIGN).alias("m"),
                    F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)).alias("v"),
                ),
                lambda x: F.char_length(x["v"]) >= ASSIGN_VALUE,
            ),
            lambda x: x["m"],
        ),
    ).otherwise(F.array().cast("array<struct<start:int,end:int,value:string>>"))
    rules = F.concat(
        _spans(assign, "assign"),
        _spans(_matches(text, ACCESS), "access"),
        _spans(_matches(text, HEX), "hex"),
    )
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")

    def is_apart(match: Column) -> Column:
        apart = ~F.exists(
            F.col(base), lambda b: (b["start"] < match["end"]) & (match["start"] < b["end"])
        )
        return match["value"].rlike("[A-Za-z]") & apart

    random = F.flatten(
        F.transform(
            F.filter(_matches(text, CANDIDATE), is_apart),
            lambda match: _random_spans(match, table, min_ratio),
        )
    )
    return (
        docs.withColumn(base, F.sort_array(rules))
        .withColumn(guess, _spans(random, "random"))
        .withColumn(name, F.sort_array(F.concat(base, guess)))
        .drop(base, guess)
    )


def report(spans: Column) -> Column:
    """`kind:start:end` of the spans, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])
        ),
        ",",
    )


def redact(docs: DataFrame, weights: list[float]) -> DataFrame:
    """`docs` with every secret in `text` replaced by a mark; spans that overlap share one.

    Other columns stay, but `n_chars`, where there is one, counts the new text. Texts
    without a secret, null ones among them, stay as they are.
    """
    name = free_name(docs, "secrets")

    def cover(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["at"]
        before = F.substr(F.col("text"), state["at"] + 1, span["start"] - state["at"])
        added = F.array(before, F.lit(_REDACTED))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(fresh, F.concat(state["parts"], added)).otherwise(state["parts"]).alias("parts"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    redacted = F.aggregate(
        name,
        start,
        cover,
        lambda state: F.concat(
            F.array_join(state["parts"], ""), F.substr(F.col("text"), state["at"] + 1)
        ),
    )
    scanned = scan(docs, weights, name)
    done = scanned.withColumn("text", F.when(F.size(name) > 0, redacted).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        known = F.when(F.size(name) > 0, length).otherwise(F.col("n_chars"))
        done = done.withColumn("n_chars", known)
    return done.drop(name)
