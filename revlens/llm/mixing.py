"""Training positions for documents of weighted sources whose weights change over the run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from revlens.llm.text import n_words, row_hash
from revlens.session import staged

BUCKET_ROWS = 50_000


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """doc, source, size in words, and the document's place in its source's fixed random order.

    The order is that of the id's MD5 digits; rows that repeat an id follow in order of size, then of
    their `row_hash`.
    """
    named = {"doc": id_col, "text": text_col, "source": source_col}
    rows = docs.select(row_hash(docs).alias("row"), *[F.col(f"`{c}`").alias(name) for name, c in named.items()])
    return rows.select("row", "doc", "source", n_words(F.col("text")).alias("size"),
                       F.md5(F.coalesce(F.col("doc").cast("string"), F.lit(""))).alias("place"))


def rotating_weights(sources: DataFrame) -> DataFrame:
    """Weights 1, 2, 3, 1, ... for the sources by code point, the missing source last.

    One row per source in one window: the table of sources, never that of documents.
    """
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    return sources.withColumn("weight", ((F.row_number().over(order) - 1) % 3 + 1).cast("double"))


def rotating_schedules(sources: DataFrame) -> DataFrame:
    """Adds `knots`: demand that rises to three times its start, falls to a third, is constant, rises, ... in the order of `rotating_weights`."""
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    rank = (F.row_number().over(order) - 1) % 3
    return sources.withColumn("knots", F.when(rank == 0, _knots([(0.0, 0.5), (1.0, 1.5)])).when(
        rank == 1, _knots([(0.0, 1.5), (1.0, 0.5)])).otherwise(_knots([(0.0, 1.0), (1.0, 1.0)])))


def _knots(points: list[tuple[float, float]]) -> Column:
    return F.array(*[F.struct(F.lit(float(t)).alias("at"), F.lit(float(w)).alias("weight")) for t, w in points])


def named_schedules(schedule: dict) -> Callable[[DataFrame], DataFrame]:
    """Adds `knots` by the source's name; the key "" holds for all others, constant demand where it is missing."""
    def add(sources: DataFrame) -> DataFrame:
        knots = _knots(schedule.get("", [(0.0, 1.0), (1.0, 1.0)]))
        for source, points in schedule.items():
            if source != "":
                knots = F.when(F.col("source") == source, _knots(points)).otherwise(knots)
        return sources.withColumn("knots", knots)

    return add


def capped_targets(sources: DataFrame, max_repeats: int = 3) -> DataFrame:
    """Adds `target`: all words shared by weight, none above `max_repeats` times the source's size.

    What a source can't take goes to the others by weight until none is above. That ends in one
    level per unit of weight, found from sums over the sources in order of cap / weight.
    """
    cap = F.col("source_size") * max_repeats
    order = W.orderBy(F.col("fill"), F.col("source").isNull(), F.col("source"))
    up_to = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    s = sources.withColumns({"cap": cap.cast("double"), "fill": cap / F.col("weight")})
    s = s.withColumns({
        "total": F.sum("source_size").over(W.partitionBy()).cast("double"),
        "cap_before": F.sum("cap").over(up_to) - F.col("cap"),
        "weight_left": F.sum("weight").over(W.partitionBy()) - F.sum("weight").over(up_to) + F.col("weight"),
    })
    s = s.withColumn("level", (F.col("total") - F.col("cap_before")) / F.col("weight_left"))
    # The first source that isn't filled has the level of all after it.
    everywhere = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    open_level = F.when(F.col("fill") >= F.col("level"), F.col("level"))
    s = s.withColumn("level", F.first(open_level, ignorenulls=True).over(everywhere))
    target = F.when(F.col("level").isNull() | (F.col("fill") < F.col("level")), F.col("cap")).otherwise(
        F.col("level") * F.col("weight"))
    return s.withColumn("target", target).select(*sources.columns, "target")


def offsets(rows: DataFrame, n_rows: int) -> DataFrame:
    """Adds `before`: the words of the earlier documents of the same source.

    The leading digits of the uniform `place` cut every source into even buckets, however many
    documents it has; buckets are summed first and a running sum inside one bucket follows.
    Their number follows the rows and doesn't change the result.
    """
    digits = max(1, (max(1, n_rows // BUCKET_ROWS) - 1).bit_length() // 4 + 1)
    rows = rows.withColumn("bucket", F.substring("place", 1, digits))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    earlier = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"),
                       (F.sum("in_bucket").over(earlier) - F.col("in_bucket")).alias("start"))
    inside = W.partitionBy("source", "bucket").orderBy("place", "size", "row").rowsBetween(W.unboundedPreceding, W.currentRow)
    joined = rows.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return joined.withColumn("before", F.col("start") + F.sum("size").over(inside) - F.col("size")).drop("s", "b", "start", "bucket")


def integrated(knots: Column) -> Column:
    """Running integral of a piecewise linear schedule array<struct<at, weight>>, 0 at the first knot."""
    pieces = F.transform(F.slice(knots, F.lit(2), F.size(knots) - 1), lambda k, i: (
        (k["at"] - F.get(knots, i)["at"]) * (k["weight"] + F.get(knots, i)["weight"]) / 2))
    sums = F.aggregate(pieces, F.array(F.lit(0.0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    return sums


def time_of(demand: Column, knots: Column, area: Column) -> Column:
    """The time at which the integral `area` of the schedule reaches `demand`.

    Inside a piece the integral is a quadratic of the time; the root is taken in the form that
    also holds for a constant weight.
    """
    piece = F.greatest(F.size(F.filter(area, lambda a: a <= demand)), F.lit(1))
    piece = F.least(piece, F.size(knots) - 1)
    left, right, past = F.get(knots, piece - 1), F.get(knots, piece), demand - F.get(area, piece - 1)
    slope = (right["weight"] - left["weight"]) / (right["at"] - left["at"])
    root = F.sqrt(F.greatest(left["weight"] * left["weight"] + 2 * slope * past, F.lit(0.0)))
    step = F.try_divide(2 * past, left["weight"] + root)
    return F.least(F.coalesce(left["at"] + step, left["at"]), right["at"])


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=rotating_weights, schedule: dict | Callable | None = None, max_repeats: int = 3) -> DataFrame:
    """One row per document: row (its hash), doc, source, size, source_size, target, taken, copies, positions.

    A source's target words follow from its weight (`capped_targets`). Its documents lie end to
    end in a fixed random order, and the mix reads that line from its start, round again after
    the last one, until the target is met: `taken` words of a document in `copies` readings, the
    last of which may end inside a document. `max_repeats` readings at most.

    `schedule` gives a source's relative demand over the run as knots [(time 0..1, weight), ...],
    linear between them; sources without one keep a constant demand (the schedule of the key ""
    if there is one). It may also be a function that adds `knots` to the table of sources. Its integral, scaled to the target, is the words that a source has handed
    out by some time; inverting it gives the times, 0 to 1, at which each reading's first word is
    due: `positions`, empty for what isn't taken. A schedule shapes when words come; how many
    come is the target's.

    Null texts have size 0 and are never taken; the missing source is a source. Rows that repeat
    an id are mixed each for itself. An empty table gives no rows. Sources are one row each,
    documents' sizes are staged once, and running sums are cut into even buckets.
    """
    rows = staged(sized(docs, id_col, text_col, source_col), "mix")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    n_rows = rows.count()
    targets = capped_targets(weights(sources.select("source", "source_size")), max_repeats)
    scheduled = schedule if callable(schedule) else named_schedules(schedule or {})
    targets = scheduled(targets).withColumn("area", integrated(F.col("knots")))
    joined = offsets(rows, n_rows).join(
        targets.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    goal = F.floor(F.col("target") + 0.5).cast("bigint")
    full = F.coalesce(F.floor(F.try_divide(goal, F.col("source_size"))), F.lit(0)).cast("bigint")
    rest = goal - full * F.col("source_size")
    extra = F.greatest(F.least(rest - F.col("before"), F.col("size")), F.lit(0))
    joined = joined.withColumn("taken", (full * F.col("size") + extra).cast("bigint"))
    copies = F.coalesce(F.ceil(F.try_divide(F.col("taken"), F.col("size"))), F.lit(0)).cast("int")
    joined = joined.withColumn("copies", copies)
    readings = F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies") - 1)).otherwise(F.expr("array()").cast("array<int>"))
    scale = F.try_divide(F.element_at("area", -1), F.col("target"))
    positions = F.transform(readings, lambda k: time_of(
        (F.col("before") + k * F.col("source_size")) * scale, F.col("knots"), F.col("area")))
    return joined.select(
        "row", "doc", "source", "size", "source_size", "target", "taken", "copies", positions.alias("positions"))


def in_order(mixed: DataFrame) -> DataFrame:
    """The rows of `mix`, range-sorted by the position of their first reading; those not taken come last."""
    return mixed.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc")


def training_rows(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents as the run reads them: one row per reading, range-sorted by `position`.

    Consecutive parts of the result are consecutive parts of the run. Adds `reading` (0, 1, ...),
    `taken` (words of this reading; fewer than the document's only in a source's last one) and
    `position`; an added column whose name `docs` has already gets an underscore in front.

    `mixed` comes from the same `docs`; rows find theirs by hash and id, so that rows without id
    and rows that repeat one keep what each was allotted. Rows equal in every column are one row
    with the readings of all of them.
    """
    added = {n: n if n not in docs.columns else f"_{n}" for n in ("reading", "taken", "position")}
    rows = mixed.where("copies > 0").select("row", "doc", "size", "taken", F.posexplode("positions"))
    words = F.least(F.col("size"), F.col("taken") - F.col("pos") * F.col("size"))
    due = rows.select(F.col("row").alias("of"), "doc", F.struct(
        F.col("pos").alias("reading"), words.alias("taken"), F.col("col").alias("position")).alias("due"))
    whole = docs.select(row_hash(docs).alias("hash"), F.col(f"`{id_col}`").alias("key"), F.struct("*").alias("row"))
    whole = whole.dropDuplicates(["hash", "key"])
    same = (F.col("hash") == F.col("of")) & F.col("key").eqNullSafe(F.col("doc"))
    joined = whole.join(due, same).orderBy("due.position", "key", "hash", "due.reading")
    return joined.select("row.*", *[F.col(f"due.{n}").alias(added[n]) for n in added])
