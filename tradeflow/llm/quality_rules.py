"""Operator 1, quality rules [native]: a threshold table compiled into one projection.

``RULES`` states, for every metric, the range a document must lie in.
``compile_rules`` turns such a table into boolean columns and
``quality_rules`` adds the metrics, one flag per rule and the verdict to a
table of documents with Spark's own functions only.  No row leaves its task:
there is no shuffle, so no key can be hot.

Defined cases: a null text counts as empty (0 words, rejected by
``base_failed``); ratios of an empty text are 0; repeated rows are judged
alike, each on its own; all other columns are passed through, and columns
whose names clash with the metrics are kept (metrics live in one struct).
Memory is bounded by one document: about 30 bytes a word.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import SPACES, let, text_or_empty, word_array

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Common function words of the corpus languages (en, de, fr, es).
STOP_WORDS = tuple(
    "the of and to in is that a for on with as was it be by this from or are "
    "der die das und den von zu mit ist im für auf nicht ein eine als auch des dem "
    "le la les de et en un une du que qui dans est pour par sur au avec ne pas "
    "el los las del y por con para se es no al lo".split()
)


@dataclass(frozen=True)
class Rule:
    """``minimum <= metric <= maximum``; a bound of None is open."""

    name: str
    metric: str
    minimum: float | None = None
    maximum: float | None = None


RULES: tuple[Rule, ...] = (
    Rule("word_length", "mean_word_chars", 2.0, 15.0),
    Rule("symbols", "symbol_ratio", None, 0.1),
    Rule("stop_words", "stop_ratio", 0.03, None),
    Rule("shouting", "exclamation_ratio", None, 0.5),
    Rule("word_variety", "distinct_ratio", 0.1, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.4),
    Rule("ellipsis_lines", "ellipsis_line_ratio", None, 0.3),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _windows(hashes: Column, width: int, *salt: Column) -> Column:
    """One 64-bit hash for each run of ``width`` words (none if there are fewer words)."""
    at = F.when(F.size(hashes) >= width, F.sequence(F.lit(0), F.size(hashes) - F.lit(width)))
    return F.transform(F.coalesce(at, F.array().cast("array<int>")),
                       lambda i: F.xxhash64(*salt, *[F.get(hashes, i + F.lit(j)) for j in range(width)]))


def _surplus(keys: Column) -> Column:
    return F.size(keys) - F.size(F.array_distinct(keys))


def _covered_words(hashes: Column, window: int) -> Column:
    """Words inside windows that occur twice or more; windows are compared by 128 bits."""

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]), F.lit(False))

    def count(rows: Column) -> Column:
        twice = F.filter(rows, lambda x, k: same(x, F.get(rows, k - 1)) | same(x, F.get(rows, k + 1)))
        starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
        return F.aggregate(
            starts, F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n")),
            lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(window), p - acc["last"])).alias("n")),
            lambda acc: acc["n"])

    def counted(first: Column) -> Column:
        return let(_windows(hashes, window, F.lit(window)), lambda second: let(F.array_sort(F.transform(
            first, lambda a, i: F.struct(a.alias("a"), F.get(second, i).alias("b"), i.alias("i")))), count))

    return let(_windows(hashes, window), lambda first: F.when(_surplus(first) == 0, F.lit(0)).otherwise(counted(first)))


def with_metrics(docs: DataFrame, text: str = "text", name: str = "quality") -> DataFrame:
    """``docs`` with a struct ``name`` of all metrics: counts as longs, ratios as doubles.

    Word and line arrays are columns of their own projection, so that they are
    computed once and the rest is generated code.  A repeated window holds
    ``WINDOW / 2 + 1`` repeated half windows, which few texts have: only those
    texts compare whole windows.
    """
    words, lines, hashes, halves = (F.col(f"__{name}_{part}") for part in ("words", "lines", "hashes", "halves"))
    value, n = text_or_empty(text), F.size(words)
    stop = sorted({form for w in STOP_WORDS for form in (w, w.capitalize())})
    split = docs.withColumns({
        f"__{name}_words": word_array(value),
        f"__{name}_lines": F.filter(F.split(value, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""),
    })
    hashed = split.withColumn(f"__{name}_hashes", F.transform(words, lambda w: F.xxhash64(w)))
    hashed = hashed.withColumn(f"__{name}_halves", _windows(hashes, WINDOW // 2))
    chars = F.length(F.array_join(words, ""))
    symbols = F.length(value) - F.length(F.regexp_replace(value, "[#*$%&|<>]+", ""))
    repeats = F.when(_surplus(halves) <= WINDOW // 2, F.lit(0)).otherwise(let(hashes, lambda h: _covered_words(h, WINDOW)))
    return hashed.withColumn(name, F.struct(
        n.cast("long").alias("n_words"),
        chars.cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        _surplus(lines).cast("long").alias("n_dup_lines"),
        repeats.cast("long").alias("n_repeat_words"),
        _ratio(chars, n).alias("mean_word_chars"),
        _ratio(symbols, n).alias("symbol_ratio"),
        _ratio(F.size(F.filter(words, lambda w: w.isin(stop))), n).alias("stop_ratio"),
        _ratio(F.length(value) - F.length(F.replace(value, F.lit("!"), F.lit(""))), n).alias("exclamation_ratio"),
        _ratio(F.size(F.array_distinct(hashes)), n).alias("distinct_ratio"),
        _ratio(_surplus(lines), F.size(lines)).alias("dup_line_ratio"),
        _ratio(F.size(F.filter(lines, lambda x: F.endswith(F.rtrim(x), F.lit("...")))), F.size(lines))
        .alias("ellipsis_line_ratio"),
    )).drop(*[f"__{name}_{part}" for part in ("words", "lines", "hashes", "halves")])


def compile_rules(metrics: Column, rules: Sequence[Rule] = RULES) -> dict[str, Column]:
    """One boolean column per rule of the threshold table (true: passed)."""
    out = {}
    for rule in rules:
        value, passed = metrics[rule.metric], F.lit(True)
        if rule.minimum is not None:
            passed = passed & (value >= F.lit(rule.minimum))
        if rule.maximum is not None:
            passed = passed & (value <= F.lit(rule.maximum))
        out[rule.name] = passed
    return out


def quality_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
                  name: str = "quality") -> DataFrame:
    """``docs`` with a struct ``name``: metrics, ``base_failed``, ``failed_rules`` and ``kept``."""
    m = F.col(name)
    base_failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
    failed = F.array_compact(F.array(*[F.when(~ok, F.lit(rule)) for rule, ok in compile_rules(m, rules).items()]))
    # Spark moves filters on plain columns below the projections and would repeat every
    # metric there; a row number in the verdict (always true) keeps them above
    here = F.monotonically_increasing_id() >= 0
    return with_metrics(docs, text, name).withColumn(name, F.struct(
        f"{name}.*", base_failed.alias("base_failed"), failed.alias("failed_rules"),
        (~base_failed & (F.size(failed) == 0) & here).alias("kept")))
