"""Personal data by fixed formats, and by contexts learned from them.

Base spans come from four formats with their own checks. They seed a bootstrap: the words around a seed and the make-up of its
characters are patterns, and patterns and identifiers form a graph. In each round a pattern is rated by the rated
identifiers it occurs with, and an identifier by its patterns. Identifiers in no base format that stand in
patterns of high confidence become spans as well. Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfline.plans.staging import Stage, WrittenTables

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
#: The formats, written so that a search never goes back over what it has read. A run of address characters is entered at
#: its beginning or where the last match ended: a match from inside it would also begin further left.
FORMATS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: what a text must hold for the format to be searched at all
HINTS = {"email": r"@[A-Za-z0-9-]++\.[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
         "card": r"[0-9](?:[ -]?+[0-9]){12}", "phone": r"\+[0-9][ ().0-9-]"}
#: runs that may be an identifier of unknown format: a digit or @ within the first 65 characters, six characters at least
CANDIDATE = r"(?<![A-Za-z0-9_%+@/.-])(?=[A-Za-z_%+/.-]{0,64}[0-9@])[A-Za-z0-9_%+@/.-]{6,}+"
#: groups of digits joined by blanks, parentheses, dots and hyphens that may be one too, of six digits at least; tried first
GROUPS = r"(?<![A-Za-z0-9_%+@/.-])[+(]{0,2}+[0-9]++(?:[ ().-]{1,3}+[0-9]++){1,18}+(?![A-Za-z0-9_%@/])"
CONTEXT = 48
ROUNDS, MIN_SUPPORT, TRUSTED, CONFIDENT = 3, 3, 0.7, 0.8
SPAN = "struct<s:int,e:int,m:string>"


def _found(text: Column, pattern: str, hint: str) -> Column:
    """Matches from left to right with their places in characters, the end exclusive; the text between gives the places."""
    matches, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    nothing = F.array().cast(f"array<{SPAN}>")
    spans = F.aggregate(
        F.arrays_zip(F.slice(between, 1, F.size(matches)).alias("gap"), matches.alias("m")), nothing,
        lambda done, x: F.concat(done, F.array(_span(F.coalesce(F.get(done, F.size(done) - 1)["e"], F.lit(0)) + F.length(x["gap"]), x["m"]))))
    return F.when(text.rlike(hint), spans).otherwise(nothing)


def _span(start: Column, text: Column) -> Column:
    return F.struct(start.alias("s"), (start + F.length(text)).alias("e"), text.alias("m"))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    """True if the digits pass the check: every second from the right doubled, digits of the products summed."""
    digits = F.reverse(_digits(text))
    parts = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substring(digits, i, F.lit(1)).cast("int") * (2 - i % 2))
    return F.aggregate(parts, F.lit(0), lambda total, x: total + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _valid(kind: str, text: Column) -> Column:
    length = F.length(_digits(text))
    if kind == "ip":
        return F.forall(F.split(text, r"\."), lambda part: part.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})$"))
    if kind == "card":
        return length.between(13, 19) & _luhn(text)
    if kind == "phone":
        return length.between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Spans (s, e, m) of one kind: leftmost matches that do not overlap, less those that fail the check."""
    return F.filter(_found(text, FORMATS[kind], HINTS[kind]), lambda x: _valid(kind, x["m"]))


def _made_of(text: Column) -> Column:
    """Kinds of characters in an identifier, each once: 9 for digits, a for letters, others as they are."""
    plain = F.regexp_replace(F.regexp_replace(text, "[0-9]+", "9"), "[A-Za-z]+", "a")
    return F.array_join(F.array_sort(F.array_distinct(F.split(plain, ""))), "")


def _soft(text: Column) -> Column:
    """What an identifier is like, whatever signs join its parts: an address, digits only, or letters with or without digits."""
    return (F.when(text.contains("@"), "address").when(~text.rlike("[A-Za-z]"), "number")
            .when(text.rlike("[0-9]"), "mixed").otherwise("letters"))


def _told(spans: Column, kind: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(kind.alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m")))


def _apart(spans: str, others: str) -> Column:
    """The spans of a column that touch none of another's."""
    return F.filter(spans, lambda c: ~F.exists(others, lambda x: (x["s"] < c["e"]) & (c["s"] < x["e"])))


def _scan(docs: DataFrame) -> DataFrame:
    """doc_id, row, the base spans, and each seed or candidate with the text around it; the texts stay behind.

    Candidates that touch a base span are left out, and runs that touch a candidate made of groups.
    """
    found = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("row"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    for kind in KINDS:
        found = found.withColumn(kind, base_spans(F.col("_text"), kind))
    found = found.withColumn("_seeds", F.concat(*[_told(F.col(kind), F.lit(kind)) for kind in KINDS]))
    found = found.withColumn("_groups", F.filter(_found(F.col("_text"), GROUPS, r"[0-9][ ().-]{1,3}[0-9]"), lambda x: F.length(_digits(x["m"])) >= 6))
    found = found.withColumn("_runs", _found(F.col("_text"), CANDIDATE, "[0-9@]"))
    for name, others in (("_groups", "_seeds"), ("_runs", "_seeds"), ("_runs", "_groups")):
        found = found.withColumn(name, _apart(name, others))
    found = found.withColumn("_all", F.concat("_seeds", _told(F.concat("_groups", "_runs"), F.lit(None).cast("string"))))
    around = F.transform("_all", lambda x: F.struct(
        x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("instance"),
        F.lower(F.substring(F.col("_text"), F.greatest(x["s"] - CONTEXT, F.lit(0)) + 1, F.least(x["s"], F.lit(CONTEXT)))).alias("before"),
        F.lower(F.substring(F.col("_text"), x["e"] + 1, F.lit(CONTEXT))).alias("after")))
    return found.select("doc_id", "row", F.transform("_seeds", lambda x: x.dropFields("m")).alias("base"), around.alias("found"))


def _patterns() -> Column:
    """Two words before, one before, and one before and after, each with the make-up of the identifier; the first and the
    last also with what it is like, so that identifiers made of other signs than the seeds are found in their contexts."""
    def word(text: str, pattern: str, group: int = 1) -> Column:
        return F.nullif(F.regexp_replace(F.regexp_extract(text, pattern, group), "[0-9]+", "9"), F.lit(""))

    second, first, after = word("before", r"(\S+)\s+\S+\s*$"), word("before", r"(\S+)\s*$"), word("after", r"^\s*(\S+)")
    make, like = _made_of(F.col("instance")), _soft(F.col("instance"))
    built = [F.concat(F.lit("two "), second, F.lit(" "), first, F.lit(" "), make), F.concat(F.lit("one "), first, F.lit(" "), make),
             F.concat(F.lit("around "), first, F.lit(" "), after, F.lit(" "), make),
             F.concat(F.lit("soft two "), second, F.lit(" "), first, F.lit(" "), like),
             F.concat(F.lit("soft around "), first, F.lit(" "), after, F.lit(" "), like)]
    return F.array_compact(F.array(*built))


def _bootstrap(edges: DataFrame, stage: Stage) -> DataFrame:
    """(pattern, kind, confidence) of the patterns of high confidence after ROUNDS rounds over the graph."""
    totals = edges.groupBy("pattern").agg(F.sum("n").alias("total"))
    seeds = edges.where("kind is not null").select("instance", "kind").distinct().withColumn("score", F.lit(1.0))
    trusted, patterns = seeds, None
    for turn in range(ROUNDS):
        rated = (edges.drop("kind").join(trusted, "instance").groupBy("pattern", "kind")
                 .agg(F.sum(F.col("n") * F.col("score")).alias("w"), F.count(F.lit(1)).alias("support")))
        patterns = stage(rated.where(F.col("support") >= MIN_SUPPORT).join(totals, "pattern")
                         .groupBy("pattern").agg(F.max(F.struct((F.col("w") / (F.col("total") + 1)).alias("confidence"), "kind")).alias("best"))
                         .select("pattern", "best.kind", "best.confidence").where(F.col("confidence") >= TRUSTED), f"patterns_{turn}")
        if turn + 1 < ROUNDS:
            rest = F.sum(F.log(1 - F.least(F.col("confidence"), F.lit(0.999))))
            new = (edges.where("kind is null").drop("kind").join(patterns, "pattern").groupBy("instance", "kind")
                   .agg((1 - F.exp(rest)).alias("score")).where(F.col("score") >= CONFIDENT))
            trusted = seeds.union(new.select("instance", "kind", "score"))
    return patterns.where(F.col("confidence") >= CONFIDENT)


def _ordered(spans: Column) -> Column:
    """By kind as in KINDS, then start."""
    place = F.array(*map(F.lit, KINDS))
    keyed = F.transform(spans, lambda x: F.struct(F.array_position(place, x["kind"]).alias("k"), x["s"].alias("s"),
                                                  x["e"].alias("e"), x["kind"].alias("kind")))
    return F.transform(F.array_sort(keyed), lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))


def find(docs: DataFrame, stage: Stage | None = None) -> DataFrame:
    """doc_id, row (a hash of the text), ``base`` and ``spans``: arrays of (kind, s, e) by kind and start.

    ``base`` has the spans of the fixed formats, ``spans`` those and the learned ones. Only doc_id and text of ``docs``
    are read; other columns do not matter. Places count characters, the end exclusive. Base spans of one kind never
    overlap; learned ones never touch a base span. Null and empty texts have no spans. Rows that repeat a doc_id
    and a text get the same spans each; a null doc_id is a doc_id like others. The corpus table of contexts is
    written once; the rounds run over distinct pairs of pattern and identifier.
    """
    stage = stage or WrittenTables(docs.sparkSession)
    scanned = stage(_scan(docs), "scanned")
    seen = stage(scanned.select("doc_id", "row", F.explode("found").alias("x")).select("doc_id", "row", "x.*")
                 .select("doc_id", "row", "s", "e", "instance", "kind", _patterns().alias("patterns")), "occurrences")
    edges = stage(seen.select("instance", "kind", F.explode("patterns").alias("pattern"))
                  .groupBy("pattern", "instance", "kind").agg(F.count(F.lit(1)).alias("n")), "edges")
    learned = (seen.where("kind is null").select("doc_id", "row", "s", "e", F.explode("patterns").alias("pattern"))
               .join(_bootstrap(edges, stage), "pattern").groupBy("doc_id", "row", "s", "e")
               .agg(F.max(F.struct("confidence", "kind"))["kind"].alias("kind")))
    more = (learned.groupBy(F.col("doc_id").alias("_d"), F.col("row").alias("_r"))
            .agg(F.collect_set(F.struct("kind", "s", "e")).alias("more")))
    joined = scanned.drop("found").join(more, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("row").eqNullSafe(F.col("_r")), "left")
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.concat("base", "more"))
    return joined.select("doc_id", "row", _ordered(F.col("base")).alias("base"), _ordered(spans).alias("spans"))


def told(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def mask(docs: DataFrame, stage: Stage | None = None) -> DataFrame:
    """``docs`` with each span of ``text`` replaced by its kind in angle brackets; spans that overlap become one.

    Other columns, their order and the rows stay; a null text stays null.
    """
    found = (find(docs, stage).where(F.size("spans") > 0).select(F.col("doc_id").alias("_d"), F.col("row").alias("_r"), "spans")
             .dropDuplicates(["_d", "_r"]))
    by_start = F.array_sort(F.transform("spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))
    found = found.select("_d", "_r", by_start.alias("_spans"))
    text = F.col("text").cast("string")
    joined = docs.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & F.xxhash64(text).eqNullSafe(F.col("_r")), "left")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(done, x):
        new = x["s"] >= done["at"]
        gap = F.substring(text, done["at"] + 1, x["s"] - done["at"])
        return F.struct(F.when(new, F.concat(done["out"], gap, F.lit("<"), F.upper(x["kind"]), F.lit(">"))).otherwise(done["out"]).alias("out"),
                        F.greatest(done["at"], x["e"]).alias("at"))

    masked = F.aggregate("_spans", start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
    return joined.withColumn("text", F.when(F.col("_spans").isNull(), text).otherwise(masked)).select(docs.columns)
