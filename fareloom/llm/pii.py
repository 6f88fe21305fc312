"""Personal data by bootstrapped contextual extraction, with DataFrame functions only.

Four regular expressions give the base spans. Every stretch of words that looks like an identifier (words that hold a
digit or ``@``) is a candidate, base span or not, and each place of a candidate gives three lexical patterns: the word
before it, the two words before it, and the words on both sides. Patterns and candidates are the two sides of a graph.

The base spans are the seeds. In each round a pattern is scored by the share of seeds among the different candidates it
stands around, kind by kind, and the patterns above a confidence pass it on to the other candidates around which they
stand, if these have the shape of the kind. What was found so counts as a seed in the next round. At the end each place
at which an accepted pattern stands around an accepted candidate is a span, beside the base spans, which all stay.

A document is read once. Spark holds the graph as a table of different (pattern, candidate) pairs; patterns with fewer
candidates than could ever be accepted are left out before the rounds. Scores are whole numbers in thousandths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.llm.common import stored

# The four kinds and their patterns are fixed values. Quantifiers are possessive and starts are held to the first place
# at which a match can begin, so that long texts take linear time; the matches are those of the plain patterns.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What the text must hold at least; a plain search spares most texts the pattern.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}

_WORD, _MARK = r"[^\x20\x09-\x0D]", r"[^\x20\x09-\x0D0-9@]"
#: Up to six neighbouring words that hold a digit or @.
CANDIDATE = rf"(?<!{_WORD}){_MARK}*+[0-9@]{_WORD}*+(?:\x20{_MARK}*+[0-9@]{_WORD}*+){{0,5}}+"
#: A name and a sign in front of the identifier itself, as in ``mail:`` or ``id=``, and signs before it: part of the words before.
KEY = r"^(?:[^0-9@:=]*+[:=])?[^0-9A-Za-z@+(]*+"
TAIL = r"(?<![^0-9A-Za-z])[^0-9A-Za-z]*+$"
#: Shape that a candidate must have to be found as a kind; weaker than the base.
SHAPES = {
    "email": r"^[^\x20@]++@[^\x20]++$",
    "ip": r"^(?=(?:[^0-9]*[0-9]){4})[0-9A-Fa-f]*[.:][0-9A-Fa-f.:]*$",
    "card": r"^(?=(?:[^0-9]*[0-9]){12})[0-9][0-9\x20.-]*$",
    "phone": r"^(?=(?:[^0-9]*[0-9]){7})[0-9+(][0-9\x20().+/-]*$",
}
#: Code points on each side in which the words of a pattern are looked for.
CONTEXT = 80
ROUNDS = 3
LEAST_SEEDS = 3
CONFIDENCE = 700
#: Elements summed in one go.
CHUNK = 64


def _starts(lengths: Column) -> Column:
    """For each element the sum of those before it, by chunks, so that long arrays are not copied for each element."""
    empty = F.array().cast("array<long>")
    fields = lambda total, sums: F.struct(total.cast("long").alias("total"), sums.alias("sums"))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / CHUNK).cast("int")), lambda i: F.slice(lengths, i * CHUNK + 1, CHUNK))
    within = lambda chunk, first: F.aggregate(
        chunk, fields(first, empty), lambda a, x: fields(a["total"] + x, F.concat(a["sums"], F.array(a["total"])))
    )
    done = F.aggregate(chunks, F.array(fields(F.lit(0), empty)), lambda a, chunk: F.concat(a, F.array(within(chunk, F.element_at(a, -1)["total"]))))
    return F.flatten(F.transform(done, lambda a: a["sums"]))


def located(df: DataFrame, text: str, found: str, pattern: str) -> Column:
    """The matches of ``pattern`` in column ``text``, which column ``found`` holds, with start, end and the text on both sides.

    Offsets are code points, the end exclusive. Null where there is no match.
    """
    gaps = F.split(F.col(text), pattern, -1)
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), F.col(found), lambda gap, match: F.struct(F.length(gap).alias("gap"), F.length(match).alias("match")))
    begins = _starts(F.transform(steps, lambda s: s["gap"] + s["match"]))
    parts = F.arrays_zip(
        begins.alias("at"), F.slice(gaps, F.lit(1), F.size(found)).alias("before"), F.slice(gaps, F.lit(2), F.size(found)).alias("after"), F.col(found).alias("value")
    )
    spans = F.transform(
        parts,
        lambda x: F.struct(
            (x["at"] + F.length(x["before"])).alias("start"),
            (x["at"] + F.length(x["before"]) + F.length(x["value"])).alias("end"),
            x["value"].alias("value"),
            F.right(x["before"], F.lit(CONTEXT)).alias("before"),
            F.left(x["after"], F.lit(CONTEXT)).alias("after"),
        ),
    )
    return F.when(F.size(found) > 0, spans)


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = "0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.when(F.length(digits).between(14, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def first_pass(docs: DataFrame) -> DataFrame:
    """Each row's base spans and candidates; texts themselves are not kept."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    patterns = {**PATTERNS, "candidate": CANDIDATE}
    none = F.array().cast("array<string>")
    for kind, pattern in patterns.items():
        seen = F.col("text").rlike(HINTS.get(kind, "[0-9@]"))
        rows = rows.withColumn(f"{kind}_found", F.when(seen, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    for kind, pattern in patterns.items():
        rows = rows.withColumn(kind, located(rows, "text", f"{kind}_found", pattern))
    spans = []
    for order, kind in enumerate(KINDS):
        right = F.filter(kind, lambda s: _valid(kind, s["value"]))  # noqa: B023
        spans.append(F.coalesce(F.transform(right, lambda s: F.struct(s["start"], F.lit(order).alias("kind"), s["end"])), F.array().cast("array<struct<start:long,kind:int,end:long>>")))  # noqa: B023
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.array_sort(F.concat(*spans)).alias("base"), "candidate")


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(_lower(text), "123456789", "000000000"), F.lit(f"{_WORD}++"), F.lit(0))


def occurrences(found: DataFrame) -> DataFrame:
    """One row for each place of a candidate: row, start, end, value, its patterns, and the kind of the base span it overlaps."""
    at = found.select("row", F.explode("candidate").alias("c"))
    key, tail = F.regexp_extract("c.value", KEY, 0), F.regexp_extract("c.value", TAIL, 0)
    at = at.select("row", "c.*", key.alias("key"), tail.alias("tail")).where(F.length("key") + F.length("tail") < F.length("value"))
    inner = F.expr("substring(value, length(key) + 1, length(value) - length(key) - length(tail))")
    at = at.select(
        "row",
        (F.col("start") + F.length("key")).alias("start"),
        (F.col("end") - F.length("tail")).alias("end"),
        _lower(inner).alias("value"),
        _words(F.concat("before", "key")).alias("left"),
        _words(F.concat("tail", "after")).alias("right"),
    )
    one = F.coalesce(F.try_element_at("left", F.lit(-1)), F.lit("^"))
    two = F.coalesce(F.try_element_at("left", F.lit(-2)), F.lit("^"))
    after = F.coalesce(F.try_element_at("right", F.lit(1)), F.lit("$"))
    patterns = F.array(F.concat_ws(" ", one, F.lit("_")), F.concat_ws(" ", two, one, F.lit("_")), F.concat_ws(" ", one, F.lit("_"), after))
    places = at.select("row", "start", "end", "value", patterns.alias("patterns"))
    # a base span overlaps a candidate if it starts before the candidate's end and ends after its start
    base = found.select("row", F.explode("base").alias("b")).select("row", F.col("b.start").alias("order"), F.lit(1).alias("later"), F.struct("b.end", "b.kind").alias("base"))
    mixed = places.select("*", F.col("end").alias("order"), F.lit(0).alias("later")).unionByName(base, allowMissingColumns=True)
    last = F.max("base").over(Window.partitionBy("row").orderBy("order", "later").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    mixed = mixed.withColumn("last", last).where(F.col("value").isNotNull())
    return mixed.select("row", "start", "end", "value", "patterns", F.when(F.col("last.end") > F.col("start"), F.col("last.kind")).alias("kind"))


def _shaped(value: Column, kind: Column) -> Column:
    shape = F.lit(False)
    for order, name in enumerate(KINDS):
        shape = F.when(kind == order, value.rlike(SHAPES[name])).otherwise(shape)
    return shape


def bootstrapped(places: DataFrame, rounds: int = ROUNDS, least_seeds: int = LEAST_SEEDS, confidence: int = CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """Accepted patterns (pattern, kind, score) and accepted candidates (value, kind, score), seeds among them.

    A pattern's score is 1000 times its seeds, each counted by its own score, over its different candidates and one; with
    ``least_seeds`` seeds of the kind and ``confidence`` it is accepted. A candidate's score is that of its best pattern.
    """
    edges = places.select("value", F.explode("patterns").alias("pattern")).distinct()
    many = edges.groupBy("pattern").agg(F.count("*").alias("candidates")).where(F.col("candidates") >= least_seeds)
    edges = stored(edges.join(many, "pattern"), "pattern_graph")
    known = stored(places.where(F.col("kind").isNotNull()).select("value", "kind", F.lit(1000).cast("long").alias("score")).distinct(), "seeds")
    accepted = None
    for turn in range(rounds):
        scored = edges.join(known, "value").groupBy("pattern", "kind", "candidates").agg(F.sum("score").alias("sum"), F.count("*").alias("seeds"))
        scored = scored.select("pattern", "kind", F.expr("sum div (candidates + 1)").alias("score"), "seeds")
        accepted = stored(scored.where((F.col("seeds") >= least_seeds) & (F.col("score") >= confidence)).drop("seeds"), f"patterns_{turn}")
        found = edges.join(accepted, "pattern").where(_shaped(F.col("value"), F.col("kind"))).select("value", "kind", "score")
        known = stored(known.unionByName(found).groupBy("value", "kind").agg(F.max("score").alias("score")), f"known_{turn}")
    return accepted, known


def personal_data(docs: DataFrame, rounds: int = ROUNDS, least_seeds: int = LEAST_SEEDS, confidence: int = CONFIDENCE) -> DataFrame:
    """Each row's doc_id, base spans and added spans, both arrays of (start, kind, end) in order; ``kind`` numbers ``KINDS``.

    Added spans lie where no base span does. Null and empty texts have no spans; repeated rows are found alike and weigh
    once in the graph, which holds different candidates; a null id stays null; an empty table gives an empty result; other
    columns are not read. Texts of any length take time in proportion. One document's candidates meet in one task.
    """
    found = stored(first_pass(docs), "spans")
    places = stored(occurrences(found), "candidates")
    accepted, known = bootstrapped(places, rounds, least_seeds, confidence)
    open_places = places.where(F.col("kind").isNull()).drop("kind").join(known.select("value", "kind"), "value")
    around = open_places.select("row", "start", "end", "kind", F.explode("patterns").alias("pattern")).join(accepted.select("pattern", "kind"), ["pattern", "kind"], "left_semi")
    added = around.select("row", F.struct("start", "kind", "end").alias("span")).distinct()
    added = added.groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("added"))
    none = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    return found.join(added, "row", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))


def listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """Numbers of base spans by kind, a checksum of the base spans, all spans as text, and the number of added ones."""
    counts = [F.size(F.filter("base", lambda s: s["kind"] == order)).cast("long").alias(f"n_{kind}") for order, kind in enumerate(KINDS)]  # noqa: B023
    every = F.array_sort(F.concat("base", "added"))
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(every).alias("spans"), F.size("added").cast("long").alias("n_added"))
