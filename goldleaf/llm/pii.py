"""Personal data: pattern matches, and contextual extraction bootstrapped from them.

Emails, IP addresses, card and phone numbers are found by their form. They (and long hexadecimal secrets) seed
a graph of instances, the strings found, and lexical patterns, the words around them. In a few rounds a pattern is
trusted as far as its distinct instances are, and an unseen identifier as far as the patterns that hold it.
Unseen identifiers that end above a limit are added as spans of their own kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.text import blocks, let, running
from goldleaf.session import scratch_path

KINDS = ("email", "ip", "card", "phone", "identifier")
#: The forms, written so that no engine backtracks over a long run: a form starts where a run of its characters does (or
#: where the last match ended), and what cannot help by giving back is possessive. The matches are those of the plain forms.
FORMS = {
    "email": "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:\\G|(?<![0-9]))[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
#: Runs of letters, digits, _ and - that hold a digit may be identifiers; the mark stands for a seed's characters.
MARK = ""
CANDIDATE = f"{MARK}++|(?<![0-9A-Za-z_-])[A-Za-z_-]*+[0-9][0-9A-Za-z_-]*+"
SECRET = "^[0-9a-f]{32,}$"
#: Shortest unseen identifier, distinct trusted instances a pattern needs, rounds, and the limits of trust.
LEAST_LENGTH, LEAST_SUPPORT, ROUNDS, TRUST_PATTERN, TRUST_INSTANCE = 6, 3, 3, 0.7, 0.7
#: Characters around a mention that are searched for its context words.
CONTEXT_CHARS = 80
_SPACE = "[\\x20\\x09-\\x0D]"


def _luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    doubled = lambda v: F.when(v > 4, 2 * v - 9).otherwise(2 * v)
    values = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(c == "", 0).otherwise(
        F.when(i % 2 == 1, doubled(F.try_to_number(c, F.lit("9")).cast("int"))).otherwise(F.try_to_number(c, F.lit("9")).cast("int"))))
    return F.aggregate(values, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(m, "\\."), lambda p: p.rlike("^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return F.length(digits).between(13, 19) & _luhn(digits)
    return F.length(digits).between(9, 15) if kind == "phone" else F.lit(True)


def _places(text: Column, form: str) -> Column:
    """Array of (m, start, end) of all matches of a form; places are code points."""
    found = F.regexp_extract_all(text, F.lit(form), F.lit(0))
    kind = "array<struct<m:string,start:int,end:int>>"
    pairs = F.filter(F.zip_with(F.split(text, form, -1), found, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("m"))), lambda x: x["m"].isNotNull())

    def placed(ps: Column) -> Column:
        ends = running(F.transform(ps, lambda x: x["gap"] + F.length(x["m"])), lambda a, b: a + b)
        return F.zip_with(ps, ends, lambda x, end: F.struct(x["m"].alias("m"), (end - F.length(x["m"])).alias("start"), end.alias("end")))

    return F.when(F.size(found) > 0, let(pairs, placed)).otherwise(F.array().cast(kind))


def _replaced(text: Column, spans: Column, by) -> Column:
    """The text with every span (sorted by start, not overlapping) replaced by by(span).

    A block of spans is cut from the text once, with what lies between it and the next block, so no span searches the whole text.
    """

    def filled(piece: Column, first: Column, block: Column) -> Column:
        parts = F.transform(block, lambda x, i: F.concat(
            by(x), F.substring(piece, x["end"] - first + 1, F.coalesce(F.get(block, i + 1)["start"], first + F.length(piece)) - x["end"])))
        return F.array_join(parts, "")

    def whole(bs: Column) -> Column:
        begin = lambda b: F.get(F.get(bs, b), F.lit(0))["start"]
        return F.concat(F.substring(text, F.lit(1), begin(F.lit(0))), F.array_join(F.transform(bs, lambda block, b: let(
            F.substring(text, begin(b) + 1, F.coalesce(begin(b + 1), F.length(text)) - begin(b)), lambda piece: filled(piece, begin(b), block))), ""))

    return let(blocks(spans), lambda bs: F.when(F.size(bs) > 0, whole(bs)).otherwise(text))


def _masked(text: Column, spans: Column) -> Column:
    """The text with every character of the spans (sorted by start, not overlapping) replaced by the mark."""
    return _replaced(text, spans, lambda x: F.repeat(F.lit(MARK), x["end"] - x["start"]))


def _context(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), _SPACE + "+"), lambda w: w != "")


def base_spans(text: Column) -> Column:
    """Array of (kind number, start, end) of the forms' valid matches, by kind and start."""

    def of(i: int, kind: str) -> Column:
        ok = F.filter(_places(text, FORMS[kind]), lambda x: _valid(kind, x["m"]))
        return F.transform(ok, lambda x: F.struct(F.lit(i).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    return F.concat(*[of(i, kind) for i, kind in enumerate(FORMS)])


def count_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _disjoint(spans: Column) -> Column:
    """(start, end) of overlapping spans joined, in order."""
    ordered = F.sort_array(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))

    def joined(o: Column) -> Column:
        return let(running(F.transform(o, lambda x: x["end"]), F.greatest), lambda far: F.zip_with(
            F.filter(o, lambda x, i: (i == 0) | (x["start"] >= F.get(far, i - 1))),
            F.filter(far, lambda end, i: (i == F.size(far) - 1) | (F.get(o, i + 1)["start"] >= end)),
            lambda x, end: F.struct(x["start"].alias("start"), end.alias("end"))))

    return F.when(F.size(spans) > 0, let(ordered, joined)).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


def _mentions(text: Column, masked: Column, at: Column) -> Column:
    """Mentions at the places of the masked text: their own text and the words around them, cut from one piece per block."""

    def of(block: Column) -> Column:
        first = F.greatest(F.get(block, F.lit(0))["start"] - CONTEXT_CHARS, F.lit(0))
        size = F.element_at(block, -1)["end"] + CONTEXT_CHARS - first
        here = lambda piece, a, n: F.substring(piece, a - first + 1, n)
        mention = lambda t, m, x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), F.startswith(x["m"], F.lit(MARK)).alias("marked"),
            here(t, x["start"], x["end"] - x["start"]).alias("instance"),
            _context(here(m, F.greatest(x["start"] - CONTEXT_CHARS, F.lit(0)), F.least(x["start"], F.lit(CONTEXT_CHARS)))).alias("left"),
            _context(here(m, x["end"], F.lit(CONTEXT_CHARS))).alias("right"))
        return let(F.substring(text, first + 1, size), lambda t: let(F.substring(masked, first + 1, size), lambda m: F.transform(
            block, lambda x: mention(t, m, x))))

    return F.flatten(F.transform(blocks(at), of))


def _trusted(edges: DataFrame) -> DataFrame:
    """Instances with their trust after the rounds; edges are distinct (pattern, instance, seed)."""
    spark = edges.sparkSession
    trust = edges.where("seed").select("instance").distinct().withColumn("trust", F.lit(1.0))
    for _ in range(ROUNDS):
        known = edges.join(trust, "instance", "left").groupBy("pattern").agg(
            F.count("*").alias("n"), F.count_if(F.col("trust") >= TRUST_INSTANCE).alias("support"),
            F.sum(F.coalesce("trust", F.lit(0.0))).alias("sum"))
        patterns = known.where(F.col("support") >= LEAST_SUPPORT).withColumn("conf", F.col("sum") / (F.col("n") + 1.0)).where(
            F.col("conf") >= TRUST_PATTERN).select("pattern", "conf")
        scored = edges.join(patterns, "pattern").groupBy("instance").agg(
            F.max("seed").alias("seed"), (1 - F.exp(F.sum(F.log1p(-F.least("conf", F.lit(0.999)))))).alias("t"))
        seeds = edges.where("seed").select("instance").distinct()
        trust = scored.where(~F.col("seed")).select("instance", F.col("t").alias("trust")).unionByName(seeds.withColumn("trust", F.lit(1.0)))
        path = scratch_path(spark, "pii-trust")
        trust.write.parquet(path)
        trust = spark.read.schema("instance string, trust double").parquet(path)
    return trust


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of personal data per distinct (id, text): ``doc_id, text_key, copies, base, spans``.

    ``base`` and ``spans`` are arrays of (kind number in KINDS, start, end) in code points, by kind and start;
    ``spans`` adds the identifiers that the bootstrapping found. ``text_key`` is xxhash64 of the text and ``copies`` the
    number of input rows. NULL and empty texts have no span. Repeated rows are one result with ``copies``, and count
    once as instances. NULL ids are ids like any other. An empty table gives no rows; other columns are ignored.
    A long text is one row; its spans and mentions are cut in blocks, so its cost is not that of every match times its length.

    Texts are read once, where they lie; mentions with their few context words travel, as distinct (pattern, instance)
    edges, reduced before the shuffle, so a name or pattern in a third of all rows is one edge per task.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    based = rows.withColumn("base", base_spans(F.col("text")))
    masked = based.withColumn("masked", _masked(F.translate("text", MARK, " "), _disjoint(F.col("base"))))
    placed = masked.withColumn("at", _places(F.col("masked"), CANDIDATE))
    mention = _mentions(F.col("text"), F.col("masked"), F.col("at"))
    path = scratch_path(spark, "pii-mentions")
    placed.select("doc_id", F.xxhash64("text").alias("text_key"), "base", mention.alias("mentions")).write.parquet(path)
    stored = spark.read.parquet(path)
    texts = stored.groupBy("doc_id", "text_key").agg(F.count("*").alias("copies"), F.first("base").alias("base"))
    m = stored.select("doc_id", "text_key", F.explode("mentions").alias("m")).select("doc_id", "text_key", "m.*")
    left = lambda n: F.array_join(F.slice("left", -n, n), " ")
    m = m.withColumn("seed", F.col("marked") | F.col("instance").rlike(SECRET)).where(F.col("seed") | (F.length("instance") >= LEAST_LENGTH))
    patterns = F.array(F.when(F.size("left") >= 2, F.concat(F.lit("L "), left(2))),
                       F.when((F.size("left") >= 1) & (F.size("right") >= 1), F.concat(F.lit("B "), left(1), F.lit(" _ "), F.get("right", F.lit(0)))))
    edges = m.select(F.explode(patterns).alias("pattern"), "instance", "seed").where(
        ~F.contains("pattern", F.lit(MARK)) & F.col("pattern").isNotNull()).groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    path = scratch_path(spark, "pii-edges")
    edges.write.parquet(path)
    trust = _trusted(spark.read.parquet(path)).where(F.col("trust") >= TRUST_INSTANCE).select("instance")
    added = m.where("not marked").join(trust, "instance").select("doc_id", "text_key", F.struct(F.lit(len(KINDS) - 1).alias("kind"), "start", "end").alias("s"))
    per_text = added.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).agg(F.sort_array(F.collect_set("s")).alias("more"))
    both = texts.join(per_text, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t")), "left")
    return both.select("doc_id", "text_key", "copies", "base", F.when(F.col("more").isNotNull(), F.concat("base", "more")).otherwise(F.col("base")).alias("spans"))


def shown(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span (overlapping ones as one) replaced by [PII]."""
    return F.when(F.size(spans) > 0, let(_disjoint(spans), lambda j: _replaced(text, j, lambda x: F.lit("[PII]")))).otherwise(text)
