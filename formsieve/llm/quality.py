"""Operator 5: quality rules as a short-circuit cascade, native.

The base rule and the rules' measures come from one projection per document: arrays of words and
lines, no explode and no shuffle, so a document of any length is one row's work and
the time grows as n log n in its words.

Words in repeated 5-word windows.  Each window is a hash of its five words' hashes with
its position in the low bits, so one sort of primitive longs puts equal windows side by
side.  Neighbours that agree are candidates; they alone are compared by their words.

Cascade.  Each rule's cost (time over a baseline) and selectivity (share of rows it
rejects) are estimated on a sample of at most ``SAMPLE_ROWS`` documents of at most ``SAMPLE_CHARS``; the rules are then
ordered by rejection per cost, highest first, and evaluated as nested conditions: a row
that a rule rejects never reaches the next one.  The order changes the time, never
the verdict, since a row is kept only if it passes every rule.

Edge cases: a null or empty text has no words, fails the base rule and isn't kept; equal
rows get equal results; an empty table gives an empty result (rules stay in their given order);
other columns are not read.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, saved, strip_space

SAMPLE_ROWS = 1000
#: Longer texts are judged like any other, but the sample that orders the rules leaves them out: it passes the driver.
SAMPLE_CHARS = 100_000
WINDOW = 5
#: Bits for a window's position; longer texts (over 16 million words) take the exact path for all windows.
POSITION_BITS = 24

#: Rejection conditions over the measures and the text; the measures are columns by then.
RULES = {
    "symbols": "2 * n_symbols > n_words",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 25 * n_words",
    "letters": r"2 * length(regexp_replace(text, '[^\\p{L}]+', '')) < word_chars",
    "bullets": r"10 * regexp_count(text, '(?m)^[\\x20\\x09]*[-*•]') > 9 * n_lines",
    "ellipses": r"10 * regexp_count(text, '(?m)(\\.\\.\\.|…)[\\x20\\x09]*$') > 3 * n_lines",
}


def _repeat_words(words: str) -> str:
    """SQL: number of words in windows of ``WINDOW`` words found twice or more in the array ``words``."""
    n = "size(v)"
    hashes = "transform(v, w -> xxhash64(w))"
    mask = (1 << POSITION_BITS) - 1
    packed = (f"transform(sequence(0, size(h) - {WINDOW}), i -> "
              f"(xxhash64({', '.join(f'h[i + {k}]' for k in range(WINDOW))}) & {~mask}) | (i & {mask}))")
    near = (f"filter(transform(s, (x, i) -> CASE WHEN (i > 0 AND (x & {~mask}) = (s[greatest(i - 1, 0)] & {~mask})) "
            f"OR (i + 1 < size(s) AND (x & {~mask}) = (s[least(i + 1, size(s) - 1)] & {~mask})) THEN cast(x & {mask} AS int) END), x -> x IS NOT NULL)")
    text_of = f"concat_ws(' ', slice(v, p + 1, {WINDOW}))"
    pairs = f"array_sort(transform(c, p -> named_struct('t', {text_of}, 'p', p)))"
    same = ("array_sort(filter(transform(e, (x, i) -> CASE WHEN (i > 0 AND x.t = e[greatest(i - 1, 0)].t) "
            "OR (i + 1 < size(e) AND x.t = e[least(i + 1, size(e) - 1)].t) THEN x.p END), x -> x IS NOT NULL))")
    covered = (f"aggregate(r, named_struct('n', 0L, 'end', 0L), (a, p) -> named_struct("
               f"'n', a.n + (p + {WINDOW}) - greatest(a.end, cast(p AS bigint)), 'end', cast(p AS bigint) + {WINDOW}), a -> a.n)")

    def let(name: str, value: str, body: str) -> str:
        """``body`` with ``name`` bound to ``value``, evaluated once."""
        return f"element_at(transform(array({value}), {name} -> {body}), 1)"

    candidates = f"CASE WHEN {n} <= {mask} THEN {let('s', f'sort_array({packed})', near)} ELSE sequence(0, {n} - {WINDOW}) END"
    exact = f"CASE WHEN size(c) = 0 THEN 0L ELSE {let('e', pairs, let('r', same, covered))} END"
    # bound to v, the words are split once, wherever the optimizer puts this expression
    return let("v", words, f"CASE WHEN {n} < {WINDOW + 1} THEN 0L ELSE {let('h', hashes, let('c', candidates, exact))} END")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    even = strip_space(F.translate(text, SPACE, " " * len(SPACE)))
    # white space runs become one space, so the split needs no pattern
    words = F.when(F.length("even") > 0, F.split("even", " ")).otherwise(F.array().cast("array<string>"))
    return (docs.select(F.col(id_col), text.alias("text"))
            .withColumn("even", F.regexp_replace(strip_space(F.translate("text", SPACE, " " * len(SPACE))), " {2,}", " "))
            .withColumn("words", words)
            .withColumn("lines", F.expr("filter(transform(split(text, '\\n'), x -> x), x -> length(btrim(x, ' \\t\\u000b\\f\\r')) > 0)"))
            .select(id_col, "text", F.size("words").cast("long").alias("n_words"),
                    F.length(F.replace("even", F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
                    (F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
                    (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                    F.expr(_repeat_words("words")).alias("n_repeat_words"), F.size("lines").cast("long").alias("n_lines")))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def rule_order(docs: DataFrame, rules: dict[str, str] | None = None, sample_rows: int = SAMPLE_ROWS,
               id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """Rules by rejection per cost on a sample (bounded; it decides the order only)."""
    rules = rules or RULES
    # a collected limit reads as few partitions as it needs; one inside a plan would start them all
    short = docs.select(id_col, text_col).where(F.coalesce(F.length(text_col), F.lit(0)) <= SAMPLE_CHARS)
    few = docs.sparkSession.createDataFrame(short.limit(sample_rows).collect(), short.schema)
    sample = saved(measures(few, id_col, text_col), "sample").where(~base_failed())

    def timed(condition: str) -> tuple[float, int]:
        best, n = float("inf"), 0
        for _ in range(2):
            began = time.perf_counter()
            n = sample.agg(F.count_if(F.expr(condition))).first()[0]
            best = min(best, time.perf_counter() - began)
        return best, n

    floor, n = timed("length(text) >= 0")
    gain = {}
    for name, condition in rules.items():
        cost, rejected = timed(condition)
        # half a rejected row more, so that among rules that reject none the cheaper goes first
        gain[name] = (rejected + 0.5) / (n + 1) / max(cost - floor, 1e-3)
    return sorted(rules, key=lambda r: -gain[r])


def judge(docs: DataFrame, rules: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the measures, base_failed, kept) of every row."""
    rules = rules or RULES
    measured = measures(docs, id_col, text_col)
    verdict = F.lit(True)
    for name in reversed(rule_order(docs, rules, id_col=id_col, text_col=text_col)):
        verdict = F.when(F.expr(rules[name]), False).otherwise(verdict)
    return measured.select(id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           base_failed().alias("base_failed"), F.when(base_failed(), False).otherwise(verdict).alias("kept"))
