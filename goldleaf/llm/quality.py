"""Quality rules as a short-circuit cascade whose order is learned from a sample.

Each rule has a rejection predicate over a text's features. On a bounded sample the operator measures
what each rule costs and what share of rows it rejects, and then asks them in the order of rejections
per cost: a row that an early rule rejects never pays for the later ones. The order changes the work and
which rule is named first, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.text import words
from goldleaf.session import scratch_path

#: Rows, on average, on which costs and selectivities are estimated; the verdicts do not depend on them.
SAMPLE_ROWS = 1_000
#: Files in which the sample is stored, and so tasks that measure it.
SAMPLE_FILES = 8
SYMBOLS = "[#*$%&|<>]"


def _n_words():
    return F.size("words").cast("long")


def _word_chars():
    return F.length(F.array_join("words", "")).cast("long")


def _n_symbols():
    return (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long")


def _worded_lines():
    return F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))


def _n_upper():
    return (F.length("text") - F.length(F.regexp_replace("text", "[A-Z]", ""))).cast("long")


def _n_lower():
    return (F.length("text") - F.length(F.regexp_replace("text", "[a-z]", ""))).cast("long")


def _n_marks():
    return (F.length("text") - F.length(F.regexp_replace("text", "[!?]", ""))).cast("long")


#: Features in the order in which they build on each other: name -> expression over text, words and earlier features.
FEATURES: dict[str, Callable[[], Column]] = {
    "n_words": _n_words,
    "word_chars": _word_chars,
    "n_symbols": _n_symbols,
    "n_upper": _n_upper,
    "n_lower": _n_lower,
    "n_marks": _n_marks,
    "worded_lines": _worded_lines,
    "n_lines": lambda: F.size("worded_lines").cast("long"),
    "n_dup_lines": lambda: (F.size("worded_lines") - F.size(F.array_distinct("worded_lines"))).cast("long"),
    # Hashes of 3-word windows; only texts that repeat one sort them to find where.
    "grams": lambda: F.when(F.size("words") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("words") - 3),
        lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))),
    "sorted_grams": lambda: F.when(F.size(F.array_distinct("grams")) < F.size("grams"), F.sort_array(
        F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    "repeats_at": lambda: F.sort_array(F.transform(
        F.filter("sorted_grams", lambda x, k: (F.get("sorted_grams", k - 1)["h"] == x["h"])
                 | (F.get("sorted_grams", k + 1)["h"] == x["h"])), lambda x: x["i"])),
    # A repeated window covers three words, less what the next one covers too.
    "n_repeat_words": lambda: F.coalesce(F.aggregate(F.transform(
        "repeats_at", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("repeats_at", k + 1) - x, F.lit(3)))),
        F.lit(0), lambda acc, x: acc + x), F.lit(0)).cast("long"),
}
_NEEDS = {"n_lines": ("worded_lines",), "n_dup_lines": ("worded_lines",), "sorted_grams": ("grams",),
          "repeats_at": ("sorted_grams",), "n_repeat_words": ("repeats_at",)}


@dataclass(frozen=True)
class Rule:
    """A rule rejects a row where its SQL predicate over the named features is true."""

    name: str
    reject: str
    needs: tuple[str, ...] = field(default=())


#: Limits follow published web-corpus filters; all tests are in whole numbers, so every engine agrees.
RULES = (
    Rule("too_few_words", "n_words < 50", ("n_words",)),
    Rule("word_length", "word_chars < 2 * n_words or word_chars > 14 * n_words", ("n_words", "word_chars")),
    Rule("symbols", "10 * n_symbols > n_words", ("n_words", "n_symbols")),
    Rule("shouting", "n_upper > n_lower", ("n_upper", "n_lower")),
    Rule("marks", "3 * n_marks > n_words", ("n_words", "n_marks")),
    Rule("dup_lines", "n_dup_lines > 2 and 100 * n_dup_lines > 30 * n_lines", ("n_lines", "n_dup_lines")),
    Rule("repeat_words", "100 * n_repeat_words > 50 * n_words", ("n_words", "n_repeat_words")),
)
BASE_RULES = ("too_few_words", "repeat_words")


def _closure(names) -> list[str]:
    need = set()

    def add(n):
        for x in _NEEDS.get(n, ()):
            add(x)
        need.add(n)

    for n in names:
        add(n)
    return [f for f in FEATURES if f in need]


def with_features(df: DataFrame, names, only_if: Column | None = None) -> DataFrame:
    """Add features (and what they need) to a frame with text and words; where only_if is false they stay NULL."""
    for f in _closure(names):
        if f not in df.columns:
            df = df.withColumn(f, FEATURES[f]() if only_if is None else F.when(only_if, FEATURES[f]()))
    return df


def prepared(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return df.withColumn("words", words(F.col("text")))


def measure(docs: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text",
            sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Cost (seconds on the sample, beyond that of reading it) and share of rejected sample rows per rule.

    The sample is drawn from all partitions and texts of every length, each row with the same chance, and stored; none of it
    passes through the driver. Costs are times, so the order of rules of like rate can change between runs.
    """
    spark = docs.sparkSession
    share = min(1.0, sample_rows / max(docs.count(), 1))
    picked = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    path = scratch_path(spark, "rule-sample")
    (picked if share == 1 else picked.sample(share, seed=7)).repartition(SAMPLE_FILES).write.parquet(path)
    sample = spark.read.schema("doc_id string, text string").parquet(path)
    n = sample.count()
    base = prepared(sample, "doc_id", "text")

    def timed(df):
        best, row = float("inf"), None
        for _ in range(2):  # the first run also compiles
            t0 = time.perf_counter()
            row = df.first()
            best = min(best, time.perf_counter() - t0)
        return best, row

    floor, _ = timed(base.agg(F.sum(F.size("words")).alias("x")))
    out = []
    for r in rules:
        secs, row = timed(with_features(base, r.needs).agg(F.count_if(F.expr(r.reject)).alias("x")))
        out.append({"rule": r.name, "cost": max(secs - floor, 1e-4), "rejects": (row["x"] / n) if n else 0.0})
    return out


def learned_order(stats: list[dict]) -> list[str]:
    """Rules by rejections per cost, greatest first; ties (rules that rejected nothing) by cost and name."""
    return [s["rule"] for s in sorted(stats, key=lambda s: (-s["rejects"] / s["cost"], s["cost"], s["rule"]))]


def cascade(docs: DataFrame, rules=RULES, order: list[str] | None = None, id_col: str = "doc_id",
            text_col: str = "text", features: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """Judge every row by every rule until one rejects it.

    Returns one row per input row: ``doc_id``, the asked ``features`` (computed for all rows),
    ``rejected_by`` (the first rejecting rule in the learned order, else NULL), ``kept``, and the input columns
    named in ``keep``. ``order`` overrides the learned order (any order gives the same ``kept``).

    NULL text counts as empty and fails the word count. Repeated rows are judged one by one and all returned; NULL
    ids are passed on. An empty table gives no rows (its sample too is empty; the order is then by name). Other input
    columns, clashing names included, are ignored. Rows are judged one by one without a shuffle, so a hot source or
    a long text stays in its own task.
    """
    order = order or learned_order(measure(docs, rules, id_col, text_col))
    by_name = {r.name: r for r in rules}
    extra = [F.col(c).alias(f"in_{c}") for c in keep]
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *extra)
    df = df.withColumn("words", words(F.col("text")))
    if features:
        df = with_features(df, features)
    df = df.withColumn("rejected_by", F.lit(None).cast("string"))
    for name in order:
        r, open_row = by_name[name], F.col("rejected_by").isNull()
        df = with_features(df, r.needs, open_row)
        df = df.withColumn("rejected_by", F.when(open_row & F.expr(r.reject), F.lit(name)).otherwise(F.col("rejected_by")))
    return df.select("doc_id", *features, "rejected_by", F.col("rejected_by").isNull().alias("kept"),
                     *[F.col(f"in_{c}").alias(c) for c in keep])


def kept_rows(docs: DataFrame, columns: tuple[str, ...], rules=RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that no rule rejects, with the named columns (the id first).

    The judged rows are written before they are filtered: in one plan, Spark would derive constraints from the filter through every
    projection of the cascade, which takes it longer than the work.
    """
    path = scratch_path(docs.sparkSession, "judged")
    judged = cascade(docs, rules, id_col=id_col, text_col=text_col, keep=columns[1:])
    judged.drop("rejected_by").write.parquet(path)
    return docs.sparkSession.read.parquet(path).where("kept").select(F.col("doc_id").alias(columns[0]), *columns[1:])
