"""Quality rules: text statistics and a hashed n-gram log-likelihood ratio, all in DataFrame expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom.llm.common import bound_to, fresh, words_of

# Fixed limits of the base rules.
LEAST_WORDS = 20
WINDOW = 8
MOST_REPEATED_PERCENT = 30
# The model: hash buckets of words and word pairs, what is added to every bucket's raw count, how many n-grams of the raw
# corpus the trusted counts are mixed with, and trusted rows that are learned from.
BUCKETS = 1 << 14
SMOOTHING = 1.0
PRIOR = 10_000.0
TRUSTED_ROWS = 20_000
# Documents whose mean log-likelihood ratio for each n-gram is lower go.
THRESHOLD = -0.1

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return bound_to(lines, lambda v: F.size(v) - F.size(F.array_distinct(v))).cast("bigint")


def _covered(starts: Column, width: int) -> Column:
    """Positions that windows of `width` cover, from their starts in ascending order."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))

    def step(state, start):
        end = start + width
        return F.struct(end.alias("end"), (state["total"] + end - F.greatest(start, state["end"])).alias("total"))

    return F.aggregate(starts, zero, step)["total"]


def _repeated(windows: Column, width: int) -> Column:
    """Words in windows whose hash occurs twice or more; sorting is left to texts that have such a window."""

    def sorted_case(keyed: Column) -> Column:
        def start(pair: Column, i: Column) -> Column:
            before, after = F.get(keyed, i - 1)["h"], F.get(keyed, i + 1)["h"]
            return F.when((pair["h"] == before) | (pair["h"] == after), pair["i"])

        return _covered(F.sort_array(F.filter(F.transform(keyed, start), lambda s: s.isNotNull())), width)

    def of(hashes: Column) -> Column:
        keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        distinct = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(distinct, F.lit(0)).otherwise(bound_to(keyed, sorted_case))

    return bound_to(windows, of).cast("bigint")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def statistics(words: Column, hashes: Column, text: Column, window: int = WINDOW) -> dict[str, Column]:
    """The base statistics, from the words, their hashes and the text without nulls.

    `hashes` has to be bound (`bound_to`): a filter that is pushed below its projection would else compute all of
    them anew for every window.
    """
    spans = F.when(F.size(hashes) < window, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(1), F.size(hashes) - (window - 1)), lambda i: F.xxhash64(F.slice(hashes, i, window))))
    return {
        "n_words": F.size(words).cast("bigint"),
        "word_chars": F.length(F.array_join(words, "")).cast("bigint"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).cast("bigint"),
        "n_dup_lines": _duplicate_lines(text),
        "n_repeat_words": _repeated(spans, window),
    }


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words)


def ngram_buckets(hashes: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all words and of all pairs of neighbours."""
    single = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    pair = F.transform(hashes, lambda h, i: F.pmod(
        F.xxhash64(h, F.get(hashes, i + 1)), F.lit(buckets)).cast("int"))
    return F.concat(single, F.slice(pair, 1, F.greatest(F.size(hashes) - 1, F.lit(0))))


def trusted_sample(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """doc_id of the labelled rows of quality 1; of more than `rows`, those of the smallest hash. Bounded by `rows`."""
    good = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id")
    return good.groupBy("doc_id").agg(F.xxhash64("doc_id").alias("_rank")).orderBy("_rank", "doc_id").limit(rows).select(
        F.col("doc_id").alias("_trusted_id"))


def likelihood_ratios(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING,
                      prior: float = PRIOR) -> list[float]:
    """ln of the trusted multinomial over the raw one, for every bucket.

    The raw counts take all n-grams of all documents. Both are summed in the map tasks, so a task sends one row per
    bucket at most, and the result has `buckets` numbers whatever the corpus. The trusted multinomial starts from the
    raw one, so little trusted text says little, and none gives ratios of 0.
    """
    trusted = F.broadcast(trusted_sample(labels))
    slim = docs.select("doc_id", "text")
    marked = slim.join(trusted, slim["doc_id"] == trusted["_trusted_id"], "left")
    grams = bound_to(hashes_of(words_of(F.col("text"))), lambda h: ngram_buckets(h, buckets))
    counts = marked.select(F.col("_trusted_id").isNotNull().cast("bigint").alias("good"), F.explode(grams).alias("bucket"))
    rows = counts.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("good"))
    counts = {r["bucket"]: (r["raw"], r["good"]) for r in rows.collect()}
    raw = [counts.get(b, (0, 0))[0] + smoothing for b in range(buckets)]
    every = sum(raw)
    shares = [n / every for n in raw]
    total = sum(good for _, good in counts.values())
    if not total:
        return [0.0] * buckets
    return [math.log((counts.get(b, (0, 0))[1] + prior * share) / (total + prior) / share)
            for b, share in enumerate(shares)]


def mean_ratio(hashes: Column, ratios: list[float]) -> Column:
    """Mean ratio of a text's n-grams; 0 for a text without words."""
    # One literal, folded into an array of doubles when the plan is made.
    table = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    parts = ngram_buckets(hashes, len(ratios))
    total = F.aggregate(parts, F.lit(0.0), lambda acc, b: acc + F.get(table, b))
    count = 2 * F.size(hashes) - 1
    return F.when(F.size(hashes) == 0, F.lit(0.0)).otherwise(total / count)


def scored(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with the statistics, base_failed, llr and kept, all computed in the row.

    Null and empty texts have no words, fail the base rules and are not kept. Repeated rows are judged alike. Columns
    of these names are replaced; others, whatever their names, stay.
    """
    ratios = likelihood_ratios(docs, labels)
    text = F.coalesce(F.col("text"), F.lit(""))

    def judge(words: Column, hashes: Column) -> Column:
        found = statistics(words, hashes, text) | {"llr": mean_ratio(hashes, ratios)}
        return F.struct(*[c.alias(n) for n, c in found.items()])

    judged = bound_to(words_of(F.col("text")), lambda w: bound_to(hashes_of(w), lambda h: judge(w, h)))
    name = fresh(docs.columns, "_judged")
    out = docs.withColumn(name, judged)
    out = out.withColumns({n: F.col(f"{name}.{n}") for n in (*STATISTICS, "llr")}).drop(name)
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def quality_table(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, the statistics, base_failed, kept, llr."""
    rows = scored(docs.select("doc_id", "text"), labels, threshold)
    return rows.select("doc_id", *STATISTICS, "base_failed", "kept", "llr")


def kept_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, with their own columns only."""
    key = fresh(docs.columns, "_row")
    slots = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    # The document's own columns travel in a struct, so that they cannot clash with the computed ones.
    packed = docs.select("doc_id", "text", F.struct(*[F.col(c).alias(a) for c, a in slots.items()]).alias(key))
    rows = scored(packed, labels, threshold).filter("kept")
    return rows.select(*[F.col(f"{key}.{a}").alias(c) for c, a in slots.items()])
