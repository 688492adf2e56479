"""Order MinHash: fingerprints of texts whose likeness follows their edit distance, not only their words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from revlens.llm.text import SPACES, let

HASH_BITS, PLACE_BITS = 34, 29  # a k-mer and its place in one positive bigint; 2^29 words a text
PART_ROWS = 20_000


def text_words(text: Column) -> Column:
    whole = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(whole == "", F.expr("array()").cast("array<string>")).otherwise(F.split(whole, r"[\x20\x09-\x0D]+"))


def _packed(hashed: Column, place: Column) -> Column:
    """The top bits of a 64-bit hash above a place in the text."""
    return F.shiftleft(F.shiftrightunsigned(hashed, 64 - HASH_BITS), PLACE_BITS).bitwiseOR(place.cast("bigint"))


def _hash(x: Column) -> Column:
    return F.shiftright(x, PLACE_BITS)


def _place(x: Column) -> Column:
    return x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def _indices(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("array()").cast("array<int>"))


def _starts(ordered: Column, group: Callable[[Column], Column]) -> Column:
    """Where another group begins in a sorted array."""
    return F.filter(_indices(F.size(ordered)), lambda i: (i == 0) | (group(F.get(ordered, i)) != group(F.get(ordered, i - 1))))


def kmers(words: Column, k: int) -> Column:
    """Sorted packed k-mers; a text of fewer words is one k-mer."""
    def hashed(w: Column) -> Column:
        run = F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0))),
                          lambda i: _packed(F.xxhash64(*[F.get(w, i + j) for j in range(k)]), i))
        return F.when(F.size(w) == 0, F.expr("array()").cast("array<bigint>")).otherwise(run)

    return F.sort_array(let(words, hashed))


def numbered(ordered: Column) -> Column:
    """Sorted packed k-mers in which a k-mer's second, third, ... occurrence has a hash of its own."""
    def again(s: Column, at: Column, end: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), end - at - 1), lambda o: _packed(
            F.xxhash64(_hash(F.get(s, at + o)), o), _place(F.get(s, at + o))))

    def with_starts(s: Column, starts: Column) -> Column:
        runs = F.transform(starts, lambda at, j: F.struct(at.alias("at"), F.coalesce(F.get(starts, j + 1), F.size(s)).alias("end")))
        repeated = F.filter(runs, lambda r: r["end"] - r["at"] > 1)
        more = F.flatten(F.transform(repeated, lambda r: again(s, r["at"], r["end"])))
        return F.when(F.size(starts) == F.size(s), s).otherwise(
            F.sort_array(F.concat(F.transform(starts, lambda at: F.get(s, at)), more)))

    return let(ordered, lambda s: let(_starts(s, _hash), lambda starts: with_starts(s, starts)))


def whole_signature(text: Column, k: int = 3, functions_log2: int = 6, chosen: int = 2, few: int = 4) -> Column:
    """array<bigint>: for each of 2^`functions_log2` hash functions its number above a 32-bit hash of its tuple.

    Function j is the k-mers' hash less j / 2^`functions_log2` of its range, modulo the range: a uniform hash of its
    own, whose order is that of the one sorted array begun at another place. Its `chosen` smallest k-mers
    of the whole text, in the order in which the text has them, make its tuple, also where a
    text has few. A text of at most `k` words gives k-mers of `few` characters; one without words has no tuple.
    """
    bins = 1 << functions_log2

    def bin_of(x: Column) -> Column:
        return F.shiftright(x, HASH_BITS + PLACE_BITS - functions_log2)

    def tuple_at(s: Column, at: Column) -> Column:
        n = F.size(s)
        least = F.transform(F.sequence(F.lit(0), F.least(n, F.lit(chosen)) - 1), lambda i: F.get(s, (at + i) % n))
        in_text = F.sort_array(F.transform(least, lambda x: F.shiftleft(_place(x), HASH_BITS).bitwiseOR(_hash(x))))
        hashes = F.transform(in_text, lambda x: x.bitwiseAND(F.lit((1 << HASH_BITS) - 1)))
        return F.xxhash64(hashes).bitwiseAND(F.lit(0xFFFFFFFF))

    def tuples(s: Column, starts: Column) -> Column:
        last = bin_of(F.element_at(s, -1))
        ranges = F.transform(starts, lambda at, j: F.struct(
            at.alias("at"), F.when(j == 0, F.lit(0).cast("bigint")).otherwise(bin_of(F.get(s, at - 1)) + 1).alias("low"), bin_of(F.get(s, at)).alias("high")))
        rest = F.struct(F.lit(0).alias("at"), (last + 1).alias("low"), F.lit(bins - 1).cast("bigint").alias("high"))
        ranges = F.filter(F.concat(ranges, F.array(rest)), lambda r: r["low"] <= r["high"])
        return F.flatten(F.transform(ranges, lambda r: let(tuple_at(s, r["at"]), lambda h: F.transform(
            F.sequence(r["low"], r["high"]), lambda b: F.shiftleft(b, 32).bitwiseOR(h)))))

    def of(s: Column) -> Column:
        return F.when(F.size(s) == 0, F.expr("array()").cast("array<bigint>")).otherwise(let(_starts(s, bin_of), lambda starts: tuples(s, starts)))

    characters = F.split(F.btrim(text, F.lit(SPACES)), "")
    parts = let(text_words(text), lambda w: F.when((F.size(w) > 0) & (F.size(w) <= k), numbered(kmers(characters, few))).otherwise(numbered(kmers(w, k))))
    return let(parts, of)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples among the bins that either has; 1.0 for two texts without words."""
    def bins(x: Column) -> Column:
        return F.transform(x, lambda t: F.shiftright(t, 32))

    either = F.size(F.array_union(bins(a), bins(b)))
    return F.when(either == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / either)


def as_text(sig: Column) -> Column:
    return F.array_join(F.transform(sig, lambda t: F.lpad(F.lower(F.hex(t)), 10, "0")), "")


def with_next(rows: DataFrame, order: str, tie: str, follow: list[str]) -> DataFrame:
    """`rows` with `next_...` columns of the row that follows in the order of the bigint `order`, after the last the first.

    Rows with equal `order` follow each other by `tie`; a missing one counts as smallest. The
    values' quantiles cut the table into parts of some thousand rows, and each part also gets the
    next part's first row, so that every row finds its successor within its part and wide rows are
    shuffled once. Only the parts' bounds, one number for many rows, come to the driver.
    """
    spark = rows.sparkSession
    n = rows.count()
    n_parts = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), n // PART_ROWS)
    shares = [i / n_parts for i in range(1, n_parts)]
    bounds = sorted(set(rows.select(order).agg(F.percentile_approx(order, shares, 20 * n_parts)).first()[0] or []))
    width = max(1, int(len(bounds) ** 0.5))
    fine = [bounds[i:i + width] for i in range(0, len(bounds), width)]

    def longs(values: list) -> Column:
        return F.from_json(F.lit(str(values)), "array<array<bigint>>" if values and isinstance(values[0], list) else "array<bigint>")

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= F.col(order)))

    if bounds:  # the coarse piece first, then inside it
        coarse = F.greatest(below(longs([f[0] for f in fine])), F.lit(0))
        part = F.when(coarse < 1, F.lit(0)).otherwise((coarse - 1) * width + below(F.get(longs(fine), coarse - 1)))
    else:
        part = F.lit(0)
    parted = rows.withColumns({"_part": F.when(F.col(order).isNull(), F.lit(0)).otherwise(part).cast("int"), "_extra": F.lit(False)})
    firsts = parted.groupBy("_part").agg(F.min(F.struct(F.col(order).isNotNull().alias("known"), F.col(order).alias("first"))).alias("f"))
    over = W.orderBy("_part")  # one row for each part
    before = F.coalesce(F.lag("_part").over(over), F.max("_part").over(W.partitionBy()))
    firsts = firsts.select(before.alias("_to"), F.col("f.first").alias("_first"), F.col("_part").alias("_from"))
    extra = parted.join(F.broadcast(firsts), (F.col("_part") == F.col("_from")) & F.col(order).eqNullSafe(F.col("_first")))
    extra = extra.select(*rows.columns, F.col("_to").alias("_part"), F.lit(True).alias("_extra"))
    in_part = W.partitionBy("_part").orderBy("_extra", F.col(order).asc_nulls_first(), tie)
    return parted.unionByName(extra).withColumns(
        {f"next_{c}": F.lead(c).over(in_part) for c in follow}).where(~F.col("_extra")).drop("_part", "_extra")


def half_replaced(text: Column, follower: Column) -> Column:
    """The last floor(n/2) characters replaced by the follower's first as many, or all it has."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, n - half), F.left(follower, half))


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, n_chars, edited, signature, edited_signature, near_edited, near_next) for every text.

    Each text's signature is computed where it is read and travels with it to the text before;
    texts are shuffled once, by ranges of the id. Null texts are empty. Rows that repeat an id
    follow each other by the hash of their text; rows without id come first. The only row of a
    table follows itself; an empty table gives no rows.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    marked = rows.withColumn("signature", whole_signature(F.col("text")))
    both = with_next(marked, "doc", "tie", ["text", "signature"])
    edited = both.withColumn("edited", half_replaced(F.col("text"), F.col("next_text")))
    edited = edited.withColumn("edited_signature", whole_signature(F.col("edited")))
    return edited.select(
        "doc", F.length("text").cast("bigint").alias("n_chars"), "edited", "signature", "edited_signature",
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"))
