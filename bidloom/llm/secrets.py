"""Secret scans: three patterns and sliding-window entropy, all in DataFrame expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom.llm.common import bound_to

# Fixed patterns of the base kinds. `access` and `hex` state their least length in the pattern: a run that is too
# short has no longer run inside. The value of `assign` is measured after matching, as a short match uses its text up.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex")

# Candidate strings of the entropy scan, its window, and the least bits for each character class; the first class that
# fits counts. Limits go by the alphabet: letters whose case changes inside are 52 signs and no prose, capitals alone are
# 26 signs and rarely prose, other letters have to be more varied than long natural words.
CANDIDATE = r"[A-Za-z0-9+/=_-]{20,}"
WINDOW = 20
CLASSES = (("entropy_hex", r"^[0-9a-fA-F]+$", 2.9), ("entropy_cased", r"^[A-Za-z]*[a-z][A-Z][A-Za-z]*$", 3.7),
           ("entropy_upper", r"^[A-Z]+$", 3.5), ("entropy_alpha", r"^[A-Za-z]+$", 3.75), ("entropy_mixed", r"^", 3.7))
# Matches whose positions are summed in one step.
CHUNK = 256
# Candidates that match one of these are known to be harmless: documentation samples, runs of one sign, identifiers.
ALLOWED = (r"(?i)example", r"(?i)^(.)\1+$", r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$",
           r"(?i)(0123456789|abcdefghijkl)", r"^[=_+/-]+$")


def _positions(pairs: Column) -> Column:
    """start, end and value from the text before each match and the match itself.

    Chunks of matches are measured first, so that no array grows by more than CHUNK matches or one entry a chunk.
    """
    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    zero = F.lit(0).cast("bigint")

    def chunk(k: Column) -> Column:
        return F.slice(pairs, k * CHUNK + 1, F.lit(CHUNK))

    def measured(k: Column) -> Column:
        return F.aggregate(chunk(k), zero, lambda n, p: n + F.length(p["piece"]) + F.length(p["value"]))

    def begun(state, size):
        return F.struct((state["at"] + size).alias("at"), F.concat(state["starts"], F.array(state["at"])).alias("starts"))

    def step(state, pair):
        start = state["at"] + F.length(pair["piece"])
        end = start + F.length(pair["value"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    chunks = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / CHUNK).cast("int"))
    first = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("starts"))
    starts = F.aggregate(F.transform(chunks, measured), first, begun)["starts"]
    return F.flatten(F.zip_with(chunks, starts, lambda k, at: F.aggregate(
        chunk(k), F.struct(at.alias("at"), empty.alias("spans")), step)["spans"]))


def matches(text: Column, pattern: str) -> Column:
    """start, end and value of the leftmost non-overlapping matches, in code points; the end is exclusive.

    The pieces between the matches have known lengths, so the positions add up.
    """
    def located(found: Column) -> Column:
        between = F.split(text, pattern, -1)
        pairs = F.zip_with(F.slice(between, 1, F.size(found)), found,
                           lambda a, b: F.struct(a.alias("piece"), b.alias("value")))
        return bound_to(pairs, _positions)

    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return bound_to(found, lambda v: F.when(F.size(v) == 0, none).otherwise(located(v)))


def _entropy_sum(count: Column) -> Column:
    """count * log2(count), 0 for no count."""
    return F.when(count > 0, count * F.log2(count)).otherwise(F.lit(0.0))


def best_entropy(value: Column, window: int = WINDOW) -> Column:
    """The largest Shannon entropy, in bits, of any `window` neighbouring characters.

    One pass over the characters' codes: a step takes the leaving character's count away, once the window is full, and
    adds the entering one's, so only two terms of the sum change; both counts are taken within the window.
    """
    return bound_to(F.transform(F.split(value, ""), lambda c: F.ascii(c)), lambda codes: _best_of(codes, window))


def _best_of(codes: Column, window: int) -> Column:
    def count(code: Column, first: Column, last: Column) -> Column:
        """How often `code` stands at the places from `first` to `last`."""
        return F.size(F.filter(F.slice(codes, first, last - first + 1), lambda c: c == code))

    def step(state, i):
        left = F.greatest(i - window, F.lit(1))
        full = i > window

        def without(leaving: Column) -> Column:
            gone = count(leaving, left, i - 1)
            return state["sum"] - F.when(full, _entropy_sum(gone) - _entropy_sum(gone - 1)).otherwise(F.lit(0.0))

        def entered(entering: Column) -> Column:
            return bound_to(count(entering, F.when(full, left + 1).otherwise(left), i - 1), lambda had: bound_to(
                bound_to(F.element_at(codes, left), without) - _entropy_sum(had) + _entropy_sum(had + 1),
                lambda total: F.struct(total.alias("sum"), F.when(i >= window, F.least(state["least"], total)).otherwise(
                    state["least"]).alias("least"))))

        return bound_to(F.element_at(codes, i), entered)

    zero = F.struct(F.lit(0.0).alias("sum"), F.lit(float("inf")).alias("least"))
    least = F.aggregate(F.sequence(F.lit(1), F.size(codes)), zero, step)["least"]
    # H = log2(w) - sum(c log2 c) / w: the smallest sum is the largest entropy.
    return F.log2(F.lit(float(window))) - least / window


def entropy_spans(text: Column, allowed: Sequence[str] = ALLOWED) -> Column:
    """start, end, kind of the candidates that pass their class's limit and that no allowed pattern suppresses."""
    def kind(value: Column) -> Column:
        chosen = F
        for name, shape, least in CLASSES:
            chosen = chosen.when(value.rlike(shape), F.when(best_entropy(value) >= least, F.lit(name)))
        return chosen

    def harmless(value: Column) -> Column:
        out = F.lit(False)
        for pattern in allowed:
            out = out | value.rlike(pattern)
        return out

    spans = F.transform(matches(text, CANDIDATE), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"),
        F.when(~harmless(s["value"]), kind(s["value"])).alias("kind")))
    return F.filter(spans, lambda s: s["kind"].isNotNull())


def base_spans(text: Column) -> dict[str, Column]:
    assign = F.filter(matches(text, ASSIGN), lambda s: F.length(
        F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_LEAST)
    return {"assign": assign, "access": matches(text, ACCESS), "hex": matches(text, HEX)}


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, then end."""
    order = F.sort_array(spans)
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def with_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds `base` and `found`: arrays of (start, rank, end, kind), of the base kinds and of the entropy scan.

    Null text is read as empty. Everything happens within the row; no shuffle, whole texts.
    """
    clean = F.coalesce(F.col(text), F.lit(""))
    ranks = {name: i for i, name in enumerate([*KINDS, *[c[0] for c in CLASSES]])}

    def tagged(spans: Column, kind) -> Column:
        def rank(name: Column) -> Column:
            return F.element_at(F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair]), name)

        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), rank(kind(s)).alias("rank"), s["end"].alias("end"), kind(s).alias("kind")))

    def constant(name: str):
        return lambda s: F.lit(name)

    base = [tagged(spans, constant(name)) for name, spans in base_spans(clean).items()]
    found = tagged(entropy_spans(clean), lambda s: s["kind"])
    return docs.withColumns({"base": F.concat(*base), "found": found})


def secret_table(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans.

    Null and empty texts have no spans. Repeated rows are scanned each, other columns are ignored, an empty table gives
    no rows. Cost grows with the length of a text, whatever candidates and matches it has.
    """
    rows = with_spans(docs.select("doc_id", "text")).select("doc_id", "base", "found")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")

    counts = {f"n_{name}": count(name) for name in KINDS}
    return rows.select(
        "doc_id", *[c.alias(n) for n, c in counts.items()],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "found")).alias("spans"))
