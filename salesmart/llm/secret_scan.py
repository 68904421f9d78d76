"""Secret scans: patterns, and a battery of randomness tests on other suspicious strings.

Candidates are all runs of 20 or more of the letters ``A-Za-z0-9+/_-`` that share no letter with a
pattern's match. Their encoding is inferred (digits, hexadecimal, letters of one or both cases,
base32, base64), which fixes an alphabet, and three tests ask whether the letters are uniform and independent: chi-squared over eight parts
of the alphabet, the number of runs above and below its middle, and the correlation of neighbours.
Fisher's method combines the three: strings that fail are not random and have p = 1.

For the rest the battery alone cannot tell secrets of usual length from words (at 20 to 48 letters
ordinary strings pass its tests too often for any false-discovery control). So p is a quotient: the
chance of the string under *ordinary text* by the chance that the battery gives to randomness. The
first comes from the likelihood ratio of independent uniform letters to a chain of letter pairs
that is counted over the corpus's ordinary strings; such text exceeds a ratio of x with a probability
of at most 1 / x. Ordinary are the strings of `SHORTEST` to 19 letters and the candidates that are
not random. The p-values of all candidates of the corpus go through the Benjamini-Hochberg procedure
at rate `RATE`, apart for each group of lengths, by a histogram of at most `LENGTHS` * `BINS` rows.

Everything is built-in expressions inside the row; texts are never moved. Positions come from the
pieces between the matches of a pattern: their lengths add up to the offsets, in code points, in a time
that grows with the text. Matches of several patterns are compared in the order of their starts.

Defined results: a NULL text is empty; repeated rows are scanned each for itself and their
candidates count each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import let, or_empty, with_columns
from salesmart.workspace import Workspace

# Kind, pattern, group whose length counts, shortest length.
BASE = [
    ("assign",
     r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
     1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # the matches of [0-9a-f]+ that are long enough
]
ADDED = "random"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
KINDS = [kind for kind, *_ in BASE] + [ADDED]

# An encoding's letters in order, and a pattern of its strings.
ENCODINGS = [
    ("^[0-9]+$", "0123456789"),
    ("^[0-9a-f]+$", "0123456789abcdef"),
    ("^[0-9A-F]+$", "0123456789ABCDEF"),
    ("^[a-z]+$", "abcdefghijklmnopqrstuvwxyz"),
    ("^[A-Z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("^[A-Za-z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
]
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

#: Parts of the alphabet that the chi-squared test counts.
PARTS = 8

#: Letters of a candidate, in the order of the table of letter pairs; its last row is the start.
SYMBOLS = BASE64 + "-_"

#: Shortest strings that the letter pairs of ordinary text are counted on.
SHORTEST = 8

#: Weight of the less specific letter frequencies in the chain, as a number of occurrences.
SMOOTHING = 20.0

#: A string is taken as random unless the combined tests reject it at this level.
REJECT = 0.001

#: False-discovery rate among the strings that are reported.
RATE = 0.05

#: Histogram of -log10(p) in steps of 1 / STEPS; all p-values below 10**-20 share the last bin.
STEPS, BINS = 20, 401

#: Candidates are judged among those of a like length: from 20 letters, 40, 80, and 160 on.
LENGTHS = 4

#: Matches whose places are added up at a time.
CHUNK = 64

SPAN = "array<struct<start:int,kind_no:int,end:int,value:string>>"


def spans(text: Column, pattern: str, kind_no: int, group: int = 0, shortest: int = 1) -> Column:
    """Leftmost matches, one after the other, as (start, kind_no, end, value), ends exclusive."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    pieces = F.split(text, pattern)  # one piece more than there are matches
    zipped = F.arrays_zip(
        F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))).alias("before"),
        whole.alias("value"), counted.alias("counted"),
    )

    def of_matches(matches: Column) -> Column:
        lengths = F.transform(matches, lambda m: F.length(m["before"]) + F.length(m["value"]))
        placed = F.zip_with(matches, running(lengths, lambda a, b: a + b), lambda m, end: F.struct(
            (end - F.length(m["value"])).alias("start"), F.lit(kind_no).alias("kind_no"),
            end.alias("end"), m["value"].alias("value"), m["counted"].alias("counted"),
        ))
        long_enough = F.filter(placed, lambda m: F.length(m["counted"]) >= shortest)
        return F.transform(long_enough, lambda m: F.struct(
            *[m[name].alias(name) for name in ("start", "kind_no", "end", "value")]))

    return F.when(text.rlike(pattern), let(zipped, of_matches)).otherwise(F.array().cast(SPAN))


def running(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array of ints that is not empty.

    The totals are taken in chunks, then over the chunks, so that little is copied at each step.
    """
    nothing = F.array().cast("array<int>")

    def last(x: Column) -> Column:
        return F.get(x, F.size(x) - 1)

    def totals(x: Column) -> Column:
        return F.aggregate(x, nothing, lambda done, v: F.concat(
            done, F.array(F.when(F.size(done) > 0, add(last(done), v)).otherwise(v))))

    def chunked(x: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / CHUNK).cast("int"))
        return F.transform(numbers, lambda k: totals(F.slice(x, k * CHUNK + 1, F.lit(CHUNK))))

    def shifted(chunks: Column) -> Column:
        ends = totals(F.transform(chunks, last))
        before = F.concat(F.array(F.lit(None).cast("int")), F.slice(ends, 1, F.size(ends) - 1))
        return F.flatten(F.zip_with(chunks, before, lambda chunk, b: F.transform(
            chunk, lambda v: F.when(b.isNull(), v).otherwise(add(b, v)))))

    return let(let(values, chunked), shifted)


def apart_from(spans: Column, base: Column) -> Column:
    """The spans that share no letter with a base span, in order of their starts.

    In the order of all starts a span is apart if every base span before it has ended, and the
    next base span begins after it.
    """
    none = 2**31 - 1

    def plain(array: Column, added: bool) -> Column:
        return F.transform(array, lambda s: F.struct(
            s["start"].alias("start"), F.lit(added).alias("added"), s["end"].alias("end"),
            s["kind_no"].alias("kind_no"), s["value"].alias("value")))

    def checked(every: Column) -> Column:
        ended = running(F.transform(
            every, lambda s: F.when(s["added"], 0).otherwise(s["end"])), F.greatest)
        begins = F.reverse(running(F.reverse(F.transform(
            every, lambda s: F.when(s["added"], none).otherwise(s["start"]))), F.least))
        kept = F.filter(F.arrays_zip(every.alias("s"), ended.alias("ended"), begins.alias("begins")),
                        lambda z: z["s"]["added"] & (z["ended"] <= z["s"]["start"])
                        & (z["begins"] >= z["s"]["end"]))
        return F.transform(kept, lambda z: F.struct(
            *[z["s"][name].alias(name) for name in ("start", "kind_no", "end", "value")]))

    every = F.sort_array(F.concat(plain(base, False), plain(spans, True)))
    return F.when((F.size(base) == 0) | (F.size(spans) == 0), spans).otherwise(let(every, checked))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, to seven digits (Abramowitz and Stegun 26.2.17)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    series = t * (0.319381530 + t * (-0.356563782 + t * (
        1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-x * x / 2) / 2.5066282746310002 * series
    return F.when(z >= 0, tail).otherwise(1 - tail)


def battery(value: Column) -> Column:
    """(p_random, uniform) of a string: the combined tests, and the logarithm of its probability
    as independent uniform letters of its encoding."""
    alphabet = F.lit(BASE64)
    for pattern, letters in reversed(ENCODINGS):
        alphabet = F.when(value.rlike(pattern), F.lit(letters)).otherwise(alphabet)
    letters = F.split(F.translate(value, "-_", "+/"), "")

    def tests(alphabet: Column) -> Column:
        size = F.length(alphabet)
        numbers = F.transform(letters, lambda c: (F.position(c, alphabet) - 1).cast("double"))

        def of_numbers(x: Column) -> Column:
            n = F.size(x).cast("double")
            total = F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
            mean = total / n
            squares = F.aggregate(x, F.lit(0.0), lambda s, v: s + (v - mean) * (v - mean))
            last = F.size(x) - 2
            steps = F.sequence(F.lit(0), last)
            products = F.aggregate(steps, F.lit(0.0), lambda s, i: s
                                   + (F.get(x, i) - mean) * (F.get(x, i + 1) - mean))
            high = F.aggregate(x, F.lit(0.0), lambda s, v: s + (2 * v >= size).cast("double"))
            changes = F.aggregate(steps, F.lit(0.0), lambda s, i: s + (
                (2 * F.get(x, i) >= size) != (2 * F.get(x, i + 1) >= size)).cast("double"))
            chi = F.aggregate(
                F.sequence(F.lit(0), F.lit(PARTS - 1)), F.lit(0.0),
                lambda s, part: s + F.pow(
                    F.size(F.filter(x, lambda v: F.floor(v * PARTS / size) == part)) - n / PARTS, 2
                ) / (n / PARTS),
            )
            return F.struct(
                n.alias("n"), size.alias("letters"), squares.alias("squares"), products.alias("products"),
                high.alias("high"), changes.alias("changes"), chi.alias("chi"),
            )

        return let(numbers, of_numbers)

    def p_values(m: Column) -> Column:
        n, degrees = m["n"], PARTS - 1
        third = 2 / (9 * degrees)
        p_chi = _upper_tail((F.pow(m["chi"] / degrees, 1 / 3) - (1 - third)) / third ** 0.5)
        runs = 2 * m["high"] * (n - m["high"]) / n + 1
        variance = (runs - 1) * (runs - 2) / (n - 1)
        p_runs = F.when(
            variance > 0, 2 * _upper_tail(F.abs(m["changes"] + 1 - runs) / F.sqrt(variance))
        ).otherwise(0.0)
        r = F.when(m["squares"] > 0, m["products"] / m["squares"]).otherwise(1.0)
        p_serial = 2 * _upper_tail(F.abs(r + 1 / n) * F.sqrt(n))
        fisher = -sum((F.ln(F.greatest(p, F.lit(1e-300))) for p in (p_chi, p_runs, p_serial)))
        p_random = F.exp(-fisher) * (1 + fisher + fisher * fisher / 2)
        return F.struct(
            p_random.alias("p_random"), (-n * F.ln(m["letters"])).alias("uniform")
        )

    return let(let(alphabet, tests), p_values)


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, base, candidates): spans of the patterns, and the other strings, tested."""
    text = or_empty(F.col("text"))
    base = F.concat(*[
        spans(text, pattern, number, group, shortest)
        for number, (_, pattern, group, shortest) in enumerate(BASE)
    ])
    strings = spans(text, CANDIDATE, KINDS.index(ADDED))
    tested = F.transform(apart_from(F.col("others"), F.col("base")), lambda c: F.struct(
        c["start"].alias("start"), c["kind_no"].alias("kind_no"), c["end"].alias("end"),
        c["value"].alias("value"), battery(c["value"]).alias("p"),
    ))
    rows = with_columns(docs, {"doc_id": "bigint", "text": "string"})
    rows = rows.withColumn("base", base).withColumn("others", strings)
    rows = rows.withColumn("candidates", tested)
    return rows.select("doc_id", F.sort_array("base").alias("base"), "candidates")


def _places(value: Column) -> Column:
    """Place of each letter of a string among the symbols."""
    return F.transform(F.split(value, ""), lambda c: F.position(c, F.lit(SYMBOLS)) - 1)


def _mixed(value: Column) -> Column:
    """Whether a string has both a digit and a letter."""
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def ordinary_pairs(docs: DataFrame, rows: DataFrame) -> np.ndarray:
    """Logarithms of the chains of letter pairs of the ordinary strings, a row per letter before;
    first the chain of strings without a digit or without a letter, then that of the others.

    Pairs are smoothed by the letters of their kind of strings, and those by the letters of all
    strings. At most 2 * 67 * 66 counts.
    """
    letter = CANDIDATE[:CANDIDATE.index("{")]
    short = f"(?<!{letter}){letter}{{{SHORTEST},19}}(?!{letter})"
    text = or_empty(F.col("text"))
    strings = with_columns(docs, {"text": "string"}).where(text.rlike(short)).select(
        F.explode(F.regexp_extract_all(text, F.lit(short), F.lit(0))).alias("value")
    )
    long = F.filter("candidates", lambda c: c["p"]["p_random"] < REJECT)
    strings = strings.unionByName(rows.select(F.explode(long["value"]).alias("value")))
    placed = strings.select(_mixed(F.col("value")).alias("mixed"), _places(F.col("value")).alias("at"))
    width = len(SYMBOLS)
    pairs = F.transform("at", lambda x, i: x + width * F.when(
        i > 0, F.get(F.col("at"), i - 1)).otherwise(width))
    counted = placed.select("mixed", F.explode(pairs).alias("pair")).groupBy("mixed", "pair").count()
    counts = np.zeros((2, (width + 1) * width))
    for has_both, pair, n in counted.collect():
        counts[int(has_both), pair] = n
    own = counts.reshape(2, width + 1, width)
    every, letters = own.sum(axis=(0, 1)), own.sum(axis=1, keepdims=True)
    usual = (every + 1) / (every.sum() + width)
    usual = (letters + SMOOTHING * usual) / (letters.sum(axis=2, keepdims=True) + SMOOTHING)
    return np.log((own + SMOOTHING * usual) / (own.sum(axis=2, keepdims=True) + SMOOTHING))


def judged(rows: DataFrame, chain: np.ndarray) -> DataFrame:
    """``rows`` with the p-value of each candidate in place of its tests."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in chain.ravel())), ",").cast("array<double>")
    width = len(SYMBOLS)

    def ordinary(value: Column) -> Column:
        first = F.when(_mixed(value), width * (width + 1)).otherwise(0)
        start = F.struct(F.lit(0.0).alias("sum"), (first + width * width).alias("row"))
        return F.aggregate(_places(value), start, lambda s, x: F.struct(
            (s["sum"] + F.get(table, s["row"] + x)).alias("sum"), (first + x * width).alias("row")
        ))["sum"]

    def with_p(c: Column) -> Column:
        # The encoding is inferred, so the ratio is the largest of several.
        several = F.ln(F.lit(len(ENCODINGS) + 1.0))
        p = F.exp(F.least(let(c["value"], ordinary) - c["p"]["uniform"] + several, F.lit(0.0)))
        return F.struct(
            c["start"].alias("start"), c["kind_no"].alias("kind_no"), c["end"].alias("end"),
            c["value"].alias("value"),
            F.when(c["p"]["p_random"] < REJECT, 1.0)
            .otherwise(F.least(p / c["p"]["p_random"], F.lit(1.0))).alias("p"),
        )

    return rows.withColumn("candidates", F.transform("candidates", with_p))


def _length_no(value: Column) -> Column:
    """Number of the group of lengths that a candidate is in."""
    return F.least(F.floor(F.log2(F.length(value) / 20)), F.lit(LENGTHS - 1)).cast("int")


def discovery_thresholds(rows: DataFrame, rate: float = RATE) -> list[float]:
    """Largest p-value that is reported in each group of lengths: Benjamini and Hochberg's, rounded
    down to a histogram bin."""
    tested = rows.select(F.explode("candidates").alias("c")).select("c.*")
    step = F.floor(-F.log10(F.greatest("p", F.lit(1e-30))) * STEPS)
    step = F.least(step, F.lit(BINS - 1)).cast("int")
    histogram = tested.groupBy(_length_no(F.col("value")).alias("group"), step.alias("step")).agg(
        F.count(F.lit(1)).alias("n")).collect()
    return [
        _threshold({step: n for group, step, n in histogram if group == number}, rate)
        for number in range(LENGTHS)
    ]


def _threshold(counts: dict[int, int], rate: float) -> float:
    tests, below, threshold = sum(counts.values()), 0, 0.0
    for number in range(BINS - 1, -1, -1):
        below += counts.get(number, 0)
        highest = 10 ** (-number / STEPS)  # of the p-values from this bin on
        if below and tests * highest <= rate * below:
            threshold = highest
    return threshold


def secrets(docs: DataFrame, workspace: Workspace, rate: float = RATE) -> DataFrame:
    """(doc_id, base, found): spans of the patterns, and all spans, sorted by start, then kind."""
    rows = workspace.store("scanned", scanned(docs))
    rows = workspace.store("judged", judged(rows, ordinary_pairs(docs, rows)))
    thresholds = F.array(*map(F.lit, discovery_thresholds(rows, rate)))
    added = F.filter("candidates", lambda c: c["p"] <= F.get(thresholds, _length_no(c["value"])))
    added = F.transform(added, lambda c: F.struct(*[
        c[name].alias(name) for name in ("start", "kind_no", "end", "value")
    ]))
    return rows.select("doc_id", "base", F.sort_array(F.concat("base", added)).alias("found"))


def written(found: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda span: F.concat_ws(
        ":", F.get(names, span["kind_no"]), span["start"].cast("string"), span["end"].cast("string")
    )), ",")


def of_kind(number: int):
    return lambda span: span["kind_no"] == number


def op8_secrets(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    counts = [
        F.size(F.filter("base", of_kind(number)))
        .cast("bigint").alias(f"n_{kind}")
        for number, (kind, *_) in enumerate(BASE)
    ]
    return secrets(docs, Workspace(spark)).select(
        "doc_id", *counts,
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
    )
