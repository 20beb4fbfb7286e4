"""PII (operator 4): contextual extraction, bootstrapped from pattern matches.

1. Seed entities: emails, IP addresses, card numbers (Luhn) and phone numbers are
   found by regular expressions, leftmost and non-overlapping per kind.
2. Every identifier-like word (at least ``MIN_LENGTH`` characters, in any script,
   with a digit or an at sign) and every seed is an instance; the two words before
   it are its pattern, however far apart.
3. Spark scores the pattern-instance graph in ``ROUNDS`` rounds: a pattern's
   confidence is the mean score of its distinct instances (0 for unknown ones),
   an instance's score the noisy-or of its patterns of enough support.
4. Patterns with at least ``MIN_SUPPORT`` known instances and ``MIN_CONFIDENCE``
   add their identifier-like words as spans of kind ``id``.  Seeds stay.

Everything is built-in SQL functions.  The text is scanned once; only spans and
contexts are kept after that, and edges are pre-aggregated before each shuffle.

Defined results: null text counts as empty; spans are code points, end exclusive;
spans of one start are ordered by kind (email, ip, card, phone, id); repeated rows
are judged alike and each returned; an empty table gives no rows; extra columns
are ignored.  The patterns are possessive and anchored to run starts so that long
runs of one character class cost linear time; the matches are those of the plain
patterns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, larger, let, once, running, stage

#: kind -> (equivalent linear-time pattern, a string every match needs or None)
PATTERNS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "."),
    "card": (r"[0-9]++(?:[\x20-][0-9]++)*+", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
KINDS = (*PATTERNS, "id")
ROUNDS, MIN_SUPPORT, MIN_CONFIDENCE, MIN_LENGTH = 3, 3.0, 0.8, 6
#: Identifier-like words: maximal runs of these characters with a digit or an at sign.
WORD = r"[\p{L}\p{N}][\p{L}\p{N}._:/@+-]*+"
IDENTIFIER = rf"(?=[\p{{L}}._:/+-]*+[\p{{N}}@]){WORD}"
SPAN = "array<struct<start:int,stop:int,value:string,left:string>>"


def find_all(text: Column, pattern: str) -> Column:
    """array<struct<start, stop, value, left>>: the matches of ``pattern`` with their code-point offsets.

    ``left`` is the text before a match, back to the third match of the pattern before it.  The text is gap 0,
    match 0, gap 1, match 1, ...: offsets are running sums of their lengths, in time that grows with the text.
    """
    def spans(gaps: Column, found: Column) -> Column:
        def piece(i: Column) -> Column:
            return F.when(i >= 0, F.concat(F.get(gaps, F.greatest(i, F.lit(0))), F.get(found, F.greatest(i, F.lit(0))))).otherwise(F.lit(""))

        lengths = F.transform(found, lambda v, i: F.char_length(F.get(gaps, i)) + F.char_length(v))
        return let(running(lengths), lambda before: F.transform(found, lambda v, i: let(
            F.get(before, i) + F.char_length(F.get(gaps, i)), lambda start: F.struct(
                start.alias("start"), (start + F.char_length(v)).alias("stop"), v.alias("value"),
                F.concat(piece(i - 2), piece(i - 1), F.get(gaps, i)).alias("left")))))

    return let(F.split(text, pattern, -1), lambda gaps: let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                                                            lambda found: spans(gaps, found)))


def _luhn(digits: Column) -> Column:
    n = F.char_length(digits)

    def add(total: Column, i: Column) -> Column:
        d = digits.substr(n - i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.when(F.char_length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    pattern, needs = PATTERNS[kind]
    maybe = text.contains(needs) if needs and needs != "." else text.rlike("[0-9]")
    found = F.filter(find_all(text, pattern), lambda x: _valid(kind, x["value"]))
    return F.when(maybe, found).otherwise(F.array().cast(SPAN))


def _context(left: Column) -> Column:
    """The two words before a match, lower-cased, digits as 0; the second may be the beginning of the match's own word."""
    def last_two(parts: Column) -> Column:
        words = F.filter(parts, lambda w: w != "")
        ending = F.when(F.element_at(parts, -1) == "", F.lit(" ")).otherwise(F.lit(""))
        return F.when(F.size(words) == 0, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice(words, F.greatest(F.size(words) - 1, F.lit(1)), F.lit(2)), " "), ending))

    return F.regexp_replace(F.lower(let(F.split(left, SPACE + "++", -1), last_two)), "[0-9]", "0")


def _tagged(kind: str) -> Column:
    return F.transform(kind, lambda x: F.struct(
        x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), x["stop"].alias("stop"),
        F.lit(kind).alias("kind"), x["value"].alias("value"), x["left"].alias("left")))


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _outside(words: Column, spans: Column) -> Column:
    """The words that no span overlaps.  Both are in order; words are disjoint, spans may overlap.

    In the order of their starts, a word is overlapped by a span before it that reaches beyond its start, or else by
    the very next one, as nothing between a word and the next word starts later than the spans inside it.
    """
    def item(x: Column, word: bool) -> Column:
        text = [x[c] if word else F.lit("") for c in ("value", "left")]
        return F.struct(x["start"].alias("start"), F.lit(int(word)).alias("word"), x["stop"].alias("stop"),
                        text[0].alias("value"), text[1].alias("left"))

    def free(items: Column, reach: Column) -> Column:
        def alone(x: Column, i: Column) -> Column:
            following = F.get(items, i + 1)
            inside = F.coalesce((following["word"] == 0) & (following["start"] < x["stop"]), F.lit(False))
            return (x["word"] == 1) & (F.get(reach, i) <= x["start"]) & ~inside

        return F.filter(items, alone)

    merged = F.array_sort(F.concat(F.transform(spans, lambda x: item(x, False)), F.transform(words, lambda x: item(x, True))))
    return let(merged, lambda items: let(
        running(F.transform(items, lambda x: F.when(x["word"] == 0, x["stop"]).otherwise(F.lit(0))), larger),
        lambda reach: free(items, reach)))


def scan(docs: DataFrame) -> DataFrame:
    """row_id, doc_id, base (spans with kind), words (identifier-like words outside of base spans, with pattern)."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    likely = F.when(F.col("text").rlike(r"[\p{N}@]"), F.filter(
        find_all(F.col("text"), IDENTIFIER),
        lambda x: F.char_length(x["value"]) >= MIN_LENGTH)).otherwise(F.array().cast(SPAN))
    d = once(d, "doc_id", "text", likely=likely, **{kind: base_spans(F.col("text"), kind) for kind in PATTERNS})
    d = once(d, "doc_id", "text", "likely", base=F.array_sort(F.concat(*map(_tagged, PATTERNS))))
    free = _outside(F.col("likely"), F.col("base"))
    instance = lambda x, seed: F.struct(
        x["start"].alias("start"), x["stop"].alias("stop"), F.lower(x["value"]).alias("value"),
        _context(x["left"]).alias("pattern"), F.lit(seed).alias("seed"))
    return d.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id",
        F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"),
                                               x["stop"].alias("stop"), x["kind"].alias("kind"))).alias("base"),
        F.concat(F.transform("base", lambda x: instance(x, True)), F.transform(free, lambda x: instance(x, False))).alias("instances"))


def score_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern, confidence, support from distinct (pattern, value, seed) edges.

    A value that isn't a seed is scored for a pattern by its other patterns only.
    """
    edges = edges.groupBy("pattern", "value").agg(F.max("seed").alias("seed")).where("pattern <> ''")
    known = edges.groupBy("value").agg(F.max("seed").alias("known"))
    edges = stage(edges.join(known, "value"), "pii-edges")
    scored, patterns = edges.withColumn("score", F.col("known").cast("double")), None
    for i in range(rounds):
        patterns = scored.groupBy("pattern").agg(F.avg("score").alias("confidence"), F.sum("score").alias("support"))
        patterns = stage(patterns.where(F.col("support") >= MIN_SUPPORT), f"pii-patterns-{i}")
        if i + 1 < rounds:
            doubt = F.log1p(-F.least(F.coalesce("confidence", F.lit(0.0)), F.lit(0.999999)))
            own = edges.join(patterns, "pattern", "left").select("pattern", "value", "known", doubt.alias("doubt"))
            total = own.groupBy("value").agg(F.sum("doubt").alias("total"))
            others = F.greatest(F.lit(0.0), 1.0 - F.exp(F.col("total") - F.col("doubt")))
            scored = stage(own.join(total, "value").select(
                "pattern", "value", F.when(F.col("known"), 1.0).otherwise(others).alias("score")), f"pii-known-{i}")
    return patterns


def _listing(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"),
                                                                 x["stop"].cast("string"))), ",")


def find_pii(docs: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """row_id, doc_id, base, added: arrays of struct<start, rank, stop, kind>, by start then kind."""
    scanned = stage(scan(docs), "pii-scan")
    rows = scanned.select("row_id", F.explode("instances").alias("x")).select("row_id", "x.*")
    trusted = score_patterns(rows.select("pattern", "value", "seed")).where(F.col("confidence") >= min_confidence)
    added = rows.where("not seed").join(trusted.select("pattern"), "pattern").groupBy("row_id").agg(
        F.sort_array(F.collect_list(F.struct("start", F.lit(KINDS.index("id")).alias("rank"), "stop", F.lit("id").alias("kind")))).alias("added"))
    return scanned.drop("instances").join(added, "row_id", "left").withColumn(
        "added", F.coalesce("added", F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string>>")))


def digest_spans(found: DataFrame) -> DataFrame:
    """The columns of the registered query from ``find_pii`` output."""
    return found.select("doc_id", *(_count("base", kind) for kind in PATTERNS), F.sha2(_listing(F.col("base")), 256).alias("base_sha256"),
                        _listing(F.array_sort(F.concat("base", "added"))).alias("spans"),
                        F.size("added").cast("long").alias("n_id"))
