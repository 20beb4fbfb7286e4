"""Benchmark decontamination (operator 1): spaced-seed hashing.

A mask such as ``1100001011`` looks at a run of tokens and ignores those at its
zeros, so a substituted token there doesn't hide a copied passage.  The masked
hashes of every position of every training document are joined with those of the
benchmark; around each hit the aligned tokens are compared, and the pair counts as
contaminated when some window of ``WINDOW`` aligned tokens around the hit has at
least ``MIN_SHARE`` of them equal, in place (substitutions, no shifts).

Nothing is missed: wherever at most three of the thirteen tokens of a window differ,
one of the three masks has a place in it that looks at equal tokens only (of all
``MASKS`` with five looked-at tokens these are three that do; a test tries every set
of three).  An item of fewer than ``WINDOW`` tokens is one window of its own length;
its seeds are its tokens in one more block than may differ, one of which is equal then.

Built-in SQL functions only.  Two bit maps (of the benchmark's tokens and of its
seeds, sized by their counts) let a document drop, inside its own row, the positions
that cannot hit; they have false positives and no misses, and no effect on the
result.  The seeds are broadcast only if counted to be at most ``MAX_BROADCAST``
rows (of about 300 bytes); beyond that the join is a shuffled one.

Defined results: tokens are runs of letters and digits, lower-cased, and single
characters of scripts that are written without spaces; null and empty texts have
none; an item of fewer than ``WINDOW`` tokens needs the same share of all its tokens
(so one of a single word is found wherever the word stands); repeated items and
documents each count; a null id is returned as null; a very long text is one row,
whose time grows with its length; empty tables give no rows; extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import once, stage
from .exact_dedup import keeping_names, located

WINDOW, MIN_SHARE = 13, 0.75
#: Of windows of 13 with 3 differing tokens at most, none escapes all three.
MASKS = ("111011", "1100001011", "110111")
#: Blocks of short items, by length.
BLOCKS = ("1", "11", "111", "1111")
LOOKS = MASKS + BLOCKS
#: Bits of the two maps: at least, and at most for many tokens or seeds.
MAP_BITS = (1 << 17, 1 << 22)
MAX_BROADCAST = 100_000
#: Scripts without spaces between words, as a Java character class.
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
TOKEN = rf"[\p{{L}}\p{{N}}&&[^{UNSPACED}]]++|[\p{{L}}\p{{N}}&&[{UNSPACED}]]"


def tokens(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits, and of single characters of unspaced scripts."""
    return F.transform(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0)),
                       lambda w: F.xxhash64(w))


def _seed(h: Column, at: Column, mask: int) -> Column:
    """The masked hash at a 0-based position; null where the mask reaches beyond the end."""
    looked = [i for i, c in enumerate(LOOKS[mask]) if c == "1"]
    return F.when(at + len(LOOKS[mask]) <= F.size(h), F.xxhash64(F.lit(mask), *(F.get(h, at + i) for i in looked)))


def _map_bits(n: int) -> int:
    return min(MAP_BITS[1], max(MAP_BITS[0], 1 << (16 * n).bit_length()))


def _blocks(n: int) -> list[tuple[int, int]]:
    """(mask, position) of the blocks of an item of n < WINDOW tokens: one more than tokens that may differ."""
    parts = n - -(-3 * n // 4) + 1
    ends = [p * n // parts for p in range(parts + 1)]
    return [(len(MASKS) + b - a - 1, a) for a, b in zip(ends, ends[1:])]


def _around(h: Column, at: Column) -> Column:
    """The tokens around a position, for all windows that touch it; null beyond either end."""
    reach = max(map(len, LOOKS)) + WINDOW - 1
    return F.transform(F.sequence(F.lit(1 - WINDOW), F.lit(reach - 1)),
                       lambda k: F.when(at + k >= 0, F.get(h, F.greatest(at + k, F.lit(0)))))


def _bit_map(values: DataFrame, bits: int) -> Column:
    """A literal array of bits/64 longs with the bits of a column ``v`` set."""
    rows = values.groupBy(F.shiftright(F.col("v").bitwiseAND(bits - 1), 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("v").bitwiseAND(63).cast("int"))).alias("b")).collect()
    words = [0] * (bits // 64)
    for r in rows:
        words[r["w"]] = r["b"]
    return F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")


def _has_bit(bit_map: Column, v: Column, bits: int) -> Column:
    word = F.get(bit_map, F.shiftright(v.bitwiseAND(bits - 1), 6).cast("int"))
    return F.getbit(word, v.bitwiseAND(63).cast("int")) == 1


def benchmark_seeds(benchmark: DataFrame) -> DataFrame:
    """item_id, n_tokens, mask, seed, item_at, item_around: every masked position of every item, or its blocks."""
    items = benchmark.select("item_id", tokens(F.col("text")).alias("h")).where(F.size("h") > 0)
    at = F.sequence(F.lit(0), F.size("h") - 1)

    def seeded(i: Column, m: int) -> Column:
        return F.struct(i.alias("at"), F.lit(m).alias("mask"), _seed(F.col("h"), i, m).alias("seed"))

    seeds = F.flatten(F.transform(at, lambda i: F.array(*(seeded(i, m) for m in range(len(MASKS))))))
    for n in range(1, WINDOW):
        seeds = F.when(F.size("h") == n, F.array(*(seeded(F.lit(p), m) for m, p in _blocks(n)))).otherwise(seeds)
    return items.select("item_id", "h", F.explode(F.filter(seeds, lambda s: s["seed"].isNotNull())).alias("s")).select(
        "item_id", F.size("h").alias("n_tokens"), "s.mask", "s.seed", F.col("s.at").alias("item_at"),
        _around(F.col("h"), F.col("s.at")).alias("item_around"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, by: tuple = ("doc_id",)) -> DataFrame:
    """One row per contaminated pair: ``by``, item_id, n_tokens, best (equal tokens of the best window), window, hits."""
    seeds = stage(benchmark_seeds(benchmark), "leak-seeds")
    masks = sorted(r[0] for r in seeds.select("mask").distinct().collect()) or [0]  # the few that some item needs
    item_tokens = benchmark.select(F.explode(tokens(F.col("text"))).alias("v")).distinct()
    n_seeds, token_bits = seeds.count(), _map_bits(item_tokens.count())
    seed_bits = _map_bits(n_seeds)
    token_map = _bit_map(item_tokens, token_bits)
    seed_map = _bit_map(seeds.select(F.col("seed").alias("v")), seed_bits)
    seeds = seeds.drop("mask")
    shortest = min(len(LOOKS[m]) for m in masks)
    pairs = all(LOOKS[m].startswith("11") for m in masks)  # then the first two tokens must both be the benchmark's

    d = once(docs, *by, h=tokens(F.col("text"))).where(F.size("h") >= shortest)

    def possible(i: Column) -> Column:
        first = _has_bit(token_map, F.get("h", i), token_bits)
        return first & _has_bit(token_map, F.get("h", i + 1), token_bits) if pairs else first

    d = once(d, *by, "h", starts=F.filter(F.sequence(F.lit(0), F.size("h") - shortest), possible))
    found = F.flatten(F.transform("starts", lambda i: F.array(*(
        F.struct(i.alias("at"), _seed(F.col("h"), i, m).alias("seed")) for m in masks))))
    found = F.filter(found, lambda s: s["seed"].isNotNull() & _has_bit(seed_map, s["seed"], seed_bits))
    found = F.transform(found, lambda s: F.struct(s["at"].alias("at"), s["seed"].alias("seed"),
                                                  _around(F.col("h"), s["at"]).alias("around")))
    d = d.select(*by, F.explode(found).alias("s")).select(*by, "s.*")
    hits = d.join(F.broadcast(seeds) if n_seeds <= MAX_BROADCAST else seeds, "seed")

    width = F.least(F.lit(WINDOW), F.col("n_tokens"))
    same = F.zip_with("around", "item_around", lambda a, b: F.when(a == b, 1).otherwise(0))
    best = F.array_max(F.transform(F.sequence(F.lit(1), F.size("same") - F.col("width") + 1),
                                   lambda i: F.aggregate(F.slice("same", i, F.col("width")), F.lit(0), lambda t, x: t + x)))
    return (
        hits.withColumn("same", same).withColumn("width", width).withColumn("best", best)
        .where(F.col("best") >= F.ceil(F.col("width") * MIN_SHARE))
        .groupBy(*by, "item_id")
        .agg(F.max("n_tokens").cast("long").alias("n_tokens"), F.max("best").cast("long").alias("best"),
             F.max("width").cast("long").alias("window"), F.count_distinct("at").alias("hits"), F.min("at").cast("long").alias("first_at"))
    )


@keeping_names
def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any contaminated pair, with their own columns; each row is judged by itself, whatever its id."""
    rows, place = located(docs), ("__file", "__row")
    leaked = find_leaks(rows, benchmark, place).select(*place).distinct()
    return rows.join(leaked, [*place], "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
