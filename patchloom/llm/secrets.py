"""Secret scans: fixed patterns, and character Markov models compared by log-likelihood ratio (DataFrame functions only)."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.llm.common import text_of

# What the patterns find, in the order in which kinds are listed. A
# hex or access match is as long as it can be, so its least length is part of its pattern.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6

# What the models look at: runs of these characters, at least CANDIDATE_LEAST long.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE_LEAST = 16
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{CANDIDATE_LEAST},}}"
IDENTIFIER = r"[A-Za-z_][A-Za-z0-9_]{7,}"
STATES = len(ALPHABET) + 1  # 0 stands for the start and for any other character

# Labelled samples come from at most so many documents of either kind, chosen by hash.
SAMPLE_DOCUMENTS = 2000
BACKOFF = 8.0
# Evidence asked for before a string counts as random, in nats.
LEAST_EVIDENCE = 12.0
_BLOCK = 256
_FOUND = "array<struct<start:bigint,end:bigint,value:string>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once; an expression that a lambda mentions is computed at every mention."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _scan_array(items: Column, state: Column, step: Callable, emit: Callable, emitted: str) -> Column:
    """What ``emit(state, item)``, an array of type ``emitted``, gives along an array; ``step(state, item)`` is the next state.

    Work is linear: what has been given out is copied in blocks of 256 only.
    """
    none = F.array().cast(emitted)

    def one(acc: Column, item: Column) -> Column:
        return F.struct(
            step(acc["state"], item).alias("state"), F.concat(acc["out"], emit(acc["state"], item)).alias("out")
        )

    def scan(array: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(array) - 1) / _BLOCK).cast("int"))

        def block(acc: Column, b: Column) -> Column:
            start = F.struct(acc["state"].alias("state"), none.alias("out"))
            done = F.aggregate(F.slice(array, b * _BLOCK + 1, F.lit(_BLOCK)), start, one)
            return _let(done, lambda d: F.struct(d["state"].alias("state"), F.concat(acc["out"], F.array(d["out"])).alias("out")))

        zero = F.struct(state.alias("state"), F.array().cast(f"array<{emitted}>").alias("out"))
        return F.when(F.size(array) > 0, F.flatten(F.aggregate(blocks, zero, block, lambda acc: acc["out"]))).otherwise(none)

    return _let(items, scan)


def matches(text: Column, pattern: str) -> Column:
    """All leftmost, non-overlapping matches: array of (start, end, value), in code points, end exclusive.

    The pieces between matches give the places; texts without a match stop at the
    first look. Work is linear in the text and in the number of matches.
    """
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(values, F.split(text, pattern, -1), lambda v, p: F.struct(v.alias("value"), p.alias("before")))
    # The piece after the last match has no value beside it.
    pairs = F.filter(pairs, lambda x: x["value"].isNotNull())
    begin = lambda end, x: end + F.length(x["before"])
    close = lambda end, x: (begin(end, x) + F.length(x["value"])).cast("bigint")
    found = _scan_array(
        pairs,
        F.lit(0).cast("bigint"),
        close,
        lambda end, x: F.array(F.struct(begin(end, x).alias("start"), close(end, x).alias("end"), x["value"].alias("value"))),
        _FOUND,
    )
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(_FOUND))


def apart_from(found: Column, spans: Column) -> Column:
    """The matches, in order, that overlap none of the spans (arrays of structs with start and end); linear after sorting.

    Of the spans that begin before a match's end, all must have ended by its start: one walk
    over the sorted ends of both counts them.
    """
    none = F.lit(None).cast(_FOUND.removeprefix("array<").removesuffix(">"))
    event = lambda at, order, match: F.struct(at.alias("at"), F.lit(order).alias("order"), match.alias("match"))
    # At one place: spans and matches end before any begins; a span's end is counted before a match begins.
    events = F.concat(
        F.transform(found, lambda m: event(m["end"], 0, m)),
        F.transform(spans, lambda s: event(s["end"], 1, none)),
        F.transform(found, lambda m: event(m["start"], 2, none)),
        F.transform(spans, lambda s: event(s["start"], 3, none)),
    )

    def step(state: Column, e: Column) -> Column:
        ended = state["ended"] + F.when(e["order"] == 1, 1).otherwise(0)
        return F.struct(
            (state["begun"] + F.when(e["order"] == 3, 1).otherwise(0)).alias("begun"),
            ended.alias("ended"),
            F.when(e["order"] == 2, ended).otherwise(state["before"]).alias("before"),
        )

    return _scan_array(
        F.array_sort(events),
        F.struct(*[F.lit(0).alias(n) for n in ("begun", "ended", "before")]),
        step,
        lambda state, e: F.when((e["order"] == 0) & (state["begun"] == state["before"]), F.array(e["match"])).otherwise(F.array().cast(_FOUND)),
        _FOUND,
    )


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns: array of (start, kind number, end, value)."""
    assigned = F.filter(
        matches(text, ASSIGN), lambda m: F.length(F.regexp_extract(m["value"], ASSIGN, 1)) >= ASSIGN_LEAST
    )
    kinds = (assigned, matches(text, ACCESS), matches(text, HEX))
    return F.concat(*[_as_kind(found, kind) for kind, found in enumerate(kinds)])


def _as_kind(found: Column, kind: int) -> Column:
    return F.transform(
        found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"), m["value"].alias("value"))
    )


def transitions(value: Column) -> Column:
    """Numbers of the character pairs of a string, its start included."""
    states = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c))
    pairs = _let(states, lambda s: F.zip_with(F.concat(F.array(F.lit(0)), F.slice(s, F.lit(1), F.size(s) - 1)), s, lambda a, b: a * STATES + b))
    return F.when(F.length(value) > 0, pairs)


def fit(samples: DataFrame, value: str = "value", random: str = "random") -> list[float]:
    """Log-likelihood ratios (random over ordinary) of every character pair, from labelled strings.

    One count per class and pair, combined before the shuffle; what comes back is
    at most 2 * STATES^2 counts. A pair's share leans on its second character's
    share with the weight of BACKOFF observations, so a character that one
    class hardly has speaks against it after any other. Without samples the model is even.
    Null strings and labels count nothing.
    """
    pairs = samples.filter(F.col(random).isNotNull()).select(
        F.col(random).cast("int").alias("r"), F.explode(transitions(F.col(value))).alias("pair")
    )
    counts = [[0.0] * (STATES * STATES) for _ in range(2)]
    for row in pairs.groupBy("r", "pair").count().collect():
        counts[row["r"]][row["pair"]] = float(row["count"])
    singles = []
    for c in counts:
        each = [sum(c[after::STATES]) + 0.5 for after in range(STATES)]
        singles.append([x / sum(each) for x in each])
    ratios = []
    for pair in range(STATES * STATES):
        before, after = divmod(pair, STATES)
        shares = [
            (c[pair] + BACKOFF * single[after]) / (sum(c[before * STATES : (before + 1) * STATES]) + BACKOFF)
            for c, single in zip(counts, singles, strict=True)
        ]
        ratios.append(math.log(shares[1]) - math.log(shares[0]))
    return ratios


def evidence(value: Column, ratios: list[float]) -> Column:
    """Sum of the ratios over the character pairs of a string: above 0 speaks for a random string."""
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    return F.aggregate(transitions(value), F.lit(0.0), lambda total, pair: total + F.get(table, pair))


def labelled_samples(docs: DataFrame, id_column: str, text_column: str, most: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """Strings with their kind: values of the fixed patterns are random, other identifiers ordinary.

    They come from at most ``most`` documents with a fixed pattern and ``most``
    others, those with the smallest hashes, so a rerun takes the same.
    """
    text = text_of(text_column)
    rows = docs.filter(F.col(id_column).isNotNull()).select(F.col(id_column).alias("id"), text.alias("text"))
    hit = F.col("text").rlike(ASSIGN) | F.col("text").rlike(ACCESS) | F.col("text").rlike(HEX)
    ranked = rows.select("id", hit.alias("hit"))
    chosen = [ranked.filter(c).select("id").orderBy(F.xxhash64("id"), "id").limit(most) for c in ("hit", "NOT hit")]
    picked = rows.join(F.broadcast(chosen[0].unionAll(chosen[1]).distinct()), "id", "left_semi")
    spans = base_spans(F.col("text"))
    strip = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    secret = F.transform(spans, lambda s: F.struct(F.regexp_replace(s["value"], strip, "").alias("value"), F.lit(True).alias("random")))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    plain = F.transform(
        F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0)),
        lambda v: F.struct(v.alias("value"), F.lit(False).alias("random")),
    )
    return picked.select(F.explode(F.concat(secret, plain)).alias("s")).select("s.value", "s.random")


def scan(
    docs: DataFrame,
    ratios: list[float],
    id_column: str = "doc_id",
    text_column: str = "text",
    least_evidence: float = LEAST_EVIDENCE,
) -> DataFrame:
    """Secrets of every whole text: (id, spans), spans an array of (start, kind, end, value, evidence) by start and kind.

    Candidates of the models are runs of 16 or more key characters that touch no
    span of a fixed pattern; they count from ``least_evidence`` nats on. Null
    text is empty and has no spans; rows are independent of each other, so
    repeated rows and null ids each give a row; an empty table gives none. However many
    matches a text has, its work grows with its length and with n log n of them.
    """
    rows = docs.select(F.col(id_column).alias("id"), text_of(text_column).alias("text"))
    with_base = rows.withColumn("base", base_spans(F.col("text")))
    scored = F.transform(
        _let(matches(F.col("text"), CANDIDATE), lambda found: apart_from(found, F.col("base"))),
        lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value"), evidence(m["value"], ratios).alias("evidence")),
    )
    full = lambda kind, level: lambda m: F.struct(
        m["start"].alias("start"), kind(m).alias("kind"), m["end"].alias("end"), m["value"].alias("value"), level(m).alias("evidence")
    )
    base = F.transform("base", full(lambda m: m["kind"], lambda m: F.lit(None).cast("double")))
    added = F.transform(
        F.filter("scored", lambda m: m["evidence"] >= least_evidence),
        full(lambda m: F.lit(KINDS.index("markov")), lambda m: m["evidence"]),
    )
    return with_base.withColumn("scored", scored).select(
        F.col("id").alias(id_column), F.array_sort(F.concat(base, added)).alias("spans")
    )


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
