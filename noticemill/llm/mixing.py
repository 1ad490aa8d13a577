"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Each source gets a target number of words.  Each of its documents gets the same expected number of copies, target / size of
the source: a whole part that all documents take, and a fraction.  Fractions are made whole in pairs: words move from one
document of a pair to the other, in a random direction that keeps both expectations, until one of the two fractions is 0 or 1.
The pair's words stay the same, so the source's sum does.  Groups of a few dozen documents are folded like this side by side;
each leaves at most one fraction over, and these residuals are grouped again, level by level, until a source has one left.
That one, often a long document, is drawn by its fraction; the words this adds or removes are given back by changing decisions
of as many other documents of the source as it takes, until less than half a usual document is missing or too much.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

WEIGHTS = (5, 2, 1)
#: Words that all targets share, and the most words of a target, in sizes of the input and of the source.
TOTAL_SHARE, MOST_SHARE = 1.5, 2.0
#: Documents that are folded together.
GROUP = 32
#: Parts into which each source's rows are dealt where they meet the source's target.
SALTS = 64
SEED = 17
_TINY = 1e-9
_WORDS = r"[^\x20\x09-\x0D]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """source, source_size, target: shares by weight of ``total`` times all sizes, none above ``most`` times its source.

    The excess of sources at their limit is shared by weight again until none is above.  With the sources sorted by
    limit / weight those at their limit come first, so that running sums give the level of the others at once.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((nth - 1) % len(weights) + 1).cast("int"))
    each = each.withColumn("weight", weight).withColumn("most", most * F.col("source_size"))
    by_limit = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    left = total * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    levelled = each.withColumn("level", left / F.sum("weight").over(onward)).withColumn("ratio", F.col("most") / F.col("weight"))
    free = F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "level"))
    found = levelled.withColumn("free", F.min(free).over(everything))
    target = F.least("most", F.coalesce(F.col("free.level") * F.col("weight"), F.col("most")))
    return found.select("source", "source_size", target.alias("target"))


def _whole(p: Column) -> Column:
    return F.when(p < _TINY, 0.0).when(p > 1 - _TINY, 1.0).otherwise(p)


def _fold(units: Column, level: int) -> Column:
    """Fold a group's units into (rest: at most one unit with a fraction, done: units whose fraction became 0 or 1)."""
    draw = lambda u: (F.pmod(F.xxhash64(u["tag"], u["size"], F.lit(level), F.lit(SEED)), F.lit(1 << 40)) + 0.5) / float(1 << 40)

    def pair(acc: Column, new: Column) -> Column:
        old = acc["rest"][0]
        a, b = old["size"].cast("double"), new["size"].cast("double")
        gain = F.least((1 - old["p"]) * a, new["p"] * b)  # words that could move to the old one
        loss = F.least(old["p"] * a, (1 - new["p"]) * b)
        moved = F.when(draw(new) * (gain + loss) < loss, gain).otherwise(-loss)

        def settled(words: Column) -> Column:
            two = F.array(old.withField("p", _whole(old["p"] + words / a)), new.withField("p", _whole(new["p"] - words / b)))
            is_done = lambda u: (u["p"] == 0) | (u["p"] == 1)
            return _let(
                two,
                lambda t: F.struct(F.filter(t, lambda u: ~is_done(u)).alias("rest"), F.concat(acc["done"], F.filter(t, is_done)).alias("done")),
            )

        return _let(moved, settled)

    def step(acc: Column, new: Column) -> Column:
        first = F.struct(F.array(new).alias("rest"), acc["done"].alias("done"))
        return F.when(F.size(acc["rest"]) == 0, first).otherwise(pair(acc, new))

    none = F.filter(units, lambda u: F.lit(False))
    return F.aggregate(units, F.struct(none.alias("rest"), none.alias("done")), step)


def _settle(units: Column, gap: Column) -> Column:
    """Change 0 to 1 (1 to 0) in a group's units while words are missing (too many): longest first, if it fits into the gap."""
    start = F.struct(gap.cast("double").alias("gap"), F.filter(units, lambda u: F.lit(False)).alias("done"))

    def step(acc: Column, u: Column) -> Column:
        words = F.when(u["p"] == 0, u["size"]).otherwise(-u["size"]).cast("double")
        narrows = (words * acc["gap"] > 0) & (F.abs(words) <= F.abs(acc["gap"]))
        changed = F.struct((acc["gap"] - words).alias("gap"), F.concat(acc["done"], F.array(u.withField("p", 1.0 - u["p"]))).alias("done"))
        same = F.struct(acc["gap"].alias("gap"), F.concat(acc["done"], F.array(u)).alias("done"))
        return F.when(narrows, changed).otherwise(same)

    return F.aggregate(units, start, step)["done"]


def _with_source(units: DataFrame, infos: DataFrame) -> DataFrame:
    """``units`` beside the columns of ``infos``, which has one row a source; dealt by salts, so that no source is one task."""
    salted = infos.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = salted.withColumnsRenamed({"source": "_source", "salt": "_salt"})
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.pmod("tag", F.lit(SALTS)).cast("int") == F.col("_salt"))
    return units.join(salted, same).drop("_source", "_salt")


def _give_back(units: DataFrame, gaps: DataFrame) -> DataFrame:
    """``units`` after changing decisions, until each source's gap is at most half its usual document or nothing narrows it.

    ``gaps`` has source, gap and usual.  A unit narrows a gap if it goes the right way and is no longer than the gap.  Such units
    are dealt into groups.  Groups change as a whole while their running sum stays within the gap; the group that passes
    it is settled unit by unit.  What is left then goes to a next round, dealt anew.
    """
    narrows = (F.col("p") == F.when(F.col("gap") > 0, 0.0).otherwise(1.0)) & (F.col("size") <= F.abs("gap"))
    columns, turn = units.columns, 0
    while True:
        gaps = gaps.where(F.abs("gap") > F.col("usual") / 2)
        able = _with_source(units, gaps).where(narrows).groupBy("source", "gap", "usual")
        able = cut(able.agg(F.ceil(F.count("*") / GROUP).alias("groups"), F.sum("size").alias("words")))
        if able.isEmpty():
            return units
        # about twice the groups that it takes; where they fall short, the next round goes on
        able = able.withColumn("reach", F.ceil(2 * F.abs("gap") * F.col("groups") / F.col("words")) + 2)
        dealt = _with_source(units, able.drop("words")).where(narrows)
        dealt = dealt.withColumn("part", F.pmod(F.xxhash64("tag", "size", F.lit(-2 - turn)), F.col("groups"))).where(F.col("part") < F.col("reach"))
        before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        rooms = dealt.groupBy("source", "part", "gap").agg(F.sum("size").alias("words"))
        rooms = rooms.withColumn("room", F.abs("gap") - F.coalesce(F.sum("words").over(before), F.lit(0))).where(F.col("room") > 0)
        rooms = rooms.select(F.col("source").alias("_source"), F.col("part").alias("_part"), "room", "words")
        met = dealt.join(rooms, F.col("source").eqNullSafe(F.col("_source")) & (F.col("part") == F.col("_part")))
        whole = met.where(F.col("room") >= F.col("words")).withColumn("p", 1.0 - F.col("p")).select(*columns)
        unit = F.struct(F.col("size").alias("size"), "tag", *[c for c in columns if c not in ("size", "tag", "source")])
        passing = met.where(F.col("room") < F.col("words")).groupBy("source", "part", (F.signum("gap") * F.col("room")).alias("room"))
        passing = passing.agg(F.reverse(F.array_sort(F.collect_list(unit))).alias("units"), F.first("gap").alias("gap"))
        settled = passing.select("source", F.inline(_settle(F.col("units"), F.col("room"))), "gap")
        settled = settled.where(F.col("p") == F.when(F.col("gap") > 0, 1.0).otherwise(0.0)).select(*columns)
        changed = cut(whole.unionByName(settled))
        names = changed.select(F.col("source").alias("_source"), F.col("doc_id").alias("_doc"), F.col("size").alias("_size"))
        same = F.col("source").eqNullSafe(F.col("_source")) & F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("size") == F.col("_size"))
        units = cut(units.join(names, same, "left_anti").unionByName(changed))
        moved = changed.groupBy(F.col("source").alias("_source")).agg(F.sum(F.col("size") * (2 * F.col("p") - 1)).alias("moved"))
        left = able.join(moved, F.col("source").eqNullSafe(F.col("_source")), "left")
        gaps = cut(left.select("source", (F.col("gap") - F.coalesce("moved", F.lit(0.0))).alias("gap"), "usual"))
        turn += 1


def plan_copies(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, total: float = TOTAL_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """Copies of each distinct (doc_id, source, size): ``rows`` it has, ``base`` copies of each row, ``sure`` rows that take one
    more, and ``extra`` (0 or 1) for one further row; beside source_size and target.

    ``sizes`` has doc_id, source and size.  Rows that agree in all three are alike, so that one unit stands for them.
    """
    targets = source_targets(sizes, weights, total, most)
    rows = sizes.groupBy("source", "doc_id", "size").agg(F.count("*").alias("rows"))
    salted = targets.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALTS)).cast("int"))
    same = rows["salt"].eqNullSafe(salted["salt"]) & rows["source"].eqNullSafe(salted["source"])
    met = rows.join(salted, same).select(rows["source"], "doc_id", "size", "rows", "source_size", "target")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    base = F.floor(copies + _TINY)
    met = met.withColumn("base", base).withColumn("share", F.greatest(copies - base, F.lit(0.0)) * F.col("rows"))
    sure = F.floor(F.col("share") + _TINY)
    met = met.withColumn("sure", sure).withColumn("p", _whole(F.greatest(F.col("share") - sure, F.lit(0.0))))
    met = met.withColumn("p", F.when(F.col("size") > 0, F.col("p")).otherwise(0.0))
    met = met.withColumn("tag", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "source"))
    carried = ["doc_id", "size", "p", "tag", "rows", "base", "sure", "source_size", "target"]

    open_units = cut(met.select("source", *carried))
    is_done = (F.col("p") == 0) | (F.col("p") == 1)
    done = [open_units.where(is_done)]
    rest, level = open_units.where(~is_done), 0
    while True:
        per_source = rest.groupBy("source").agg(F.count("*").alias("n"))
        most_units = per_source.agg(F.max("n")).first()[0] or 0
        if most_units <= 1:
            break
        groups = per_source.select("source", F.ceil(F.col("n") / GROUP).alias("groups"))
        salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        keyed = rest.withColumn("salt", F.pmod("tag", F.lit(SALTS)).cast("int"))
        same = keyed["salt"].eqNullSafe(salted["salt"]) & keyed["source"].eqNullSafe(salted["source"])
        keyed = keyed.join(salted, same).select(keyed["source"], *carried, "groups")
        keyed = keyed.withColumn("part", F.pmod(F.xxhash64("tag", "size", F.lit(level)), F.col("groups")))
        unit = F.struct(F.col("size").alias("size"), "tag", *[c for c in carried if c not in ("size", "tag")])
        # largest first: what is left over at the end is small then
        units = F.reverse(F.array_sort(F.collect_list(unit)))
        folded = keyed.groupBy("source", "part").agg(units.alias("units")).select("source", "part", _fold(F.col("units"), level).alias("x"))
        folded = cut(folded.select("source", "part", F.col("x.done").alias("done"), F.col("x.rest").alias("rest")))
        done.append(folded.select("source", F.inline("done")).select("source", *carried))
        rest, level = folded.select("source", F.inline("rest")).select("source", *carried), level + 1
    draw = (F.pmod(F.xxhash64("tag", "size", F.lit(-1), F.lit(SEED)), F.lit(1 << 40)) + 0.5) / float(1 << 40) < F.col("p")
    if not level:
        return _planned(done[0].unionByName(rest.withColumn("p", draw.cast("double")).select("source", *carried)))
    units = done[1]
    for part in done[2:]:
        units = units.unionByName(part)
    able = units.groupBy("source").agg(
        F.sum(F.when(F.col("p") == 0, F.col("size")).otherwise(0)).alias("more"),
        F.sum(F.when(F.col("p") == 1, F.col("size")).otherwise(0)).alias("less"),
        F.percentile_approx("size", 0.5).alias("usual"),
    )
    able = able.withColumnRenamed("source", "_source")
    met = rest.join(able, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    # what the others cannot give back, so that the source would miss its target
    short = F.greatest(F.col("p") * F.col("size") - F.coalesce("more", F.lit(0)), F.lit(0.0))
    over = F.greatest((1 - F.col("p")) * F.col("size") - F.coalesce("less", F.lit(0)), F.lit(0.0))
    last = F.when((over > _TINY) & (short <= _TINY), 0.0).when((short > _TINY) & (over <= _TINY), 1.0).otherwise(draw.cast("double"))
    drawn = cut(met.withColumn("last", last).withColumn("gap", (F.col("p") - F.col("last")) * F.col("size")).withColumn("p", F.col("last")))
    units = _give_back(units, drawn.where(F.col("usual").isNotNull()).select("source", "gap", "usual"))
    return _planned(done[0].unionByName(drawn.select("source", *carried)).unionByName(units))


def _planned(units: DataFrame) -> DataFrame:
    return units.select("doc_id", "source", "size", "rows", "base", "sure", F.col("p").cast("long").alias("extra"), "source_size", "target")


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and the number of words of the whole text."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(_WORDS)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"))


def mix(docs: DataFrame) -> DataFrame:
    """Words that the mix takes of each row of ``docs``: doc_id, size, source_size, target, taken and copies.

    Null sources are one source, after all others; null texts have size 0 and are never taken; null ids are ids like any
    other.  Rows that agree in id, source and size are alike, and each still is a row of the result.  Reruns agree, whatever
    the partitioning.  Words of whole texts are counted, whatever their length.  An empty table gives an empty result; other columns
    are not read.  Targets are found from one row a source.
    """
    planned = plan_copies(cut(document_sizes(docs)))
    each = planned.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return each.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies_of(F.col("nth"))).alias("taken"), copies_of(F.col("nth")).alias("copies")
    )


def copies_of(nth: Column) -> Column:
    """Copies of the nth of a unit's rows."""
    more = F.when(nth <= F.col("sure"), 1).when(nth == F.col("sure") + 1, F.col("extra")).otherwise(0)
    return (F.col("base") + more).cast("long")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; those that it does not take are left out.

    Documents of no words carry nothing to mix and are left out as well.  All columns of ``docs`` come back as they are, whatever
    their names.  Of rows that agree in id, source and size those whose texts hash low are taken first.
    """
    planned = plan_copies(cut(document_sizes(docs))).where(F.col("size") > 0)
    units = planned.groupBy("doc_id", "source").agg(F.collect_list(F.struct("size", "rows", "base", "sure", "extra")).alias("units"))
    units = units.select(F.xxhash64("doc_id", "source").alias("place"), F.struct("doc_id", "source").alias("key"), "units")
    rows = docs.select(F.xxhash64("doc_id", "source").alias("place"), F.struct("doc_id", "source").alias("own"), "text", F.struct("*").alias("row"))
    met = rows.join(units, "place").where(F.col("own").eqNullSafe(F.col("key")))
    # only ids that are repeated with texts of several sizes are counted again
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(_WORDS)), F.lit(0)).cast("long")
    unit = F.when(F.size("units") == 1, F.col("units")[0]).otherwise(_let(size, lambda n: F.get(F.filter("units", lambda u: u["size"] == n), 0)))
    met = met.withColumn("unit", unit).where(F.col("text").rlike(_WORDS) & F.col("unit").isNotNull())
    order = Window.partitionBy("place", "key", "unit.size").orderBy(F.xxhash64("text"))  # of the join's own partitioning
    unit_of = {c: F.col(f"unit.{c}") for c in ("base", "sure", "extra")}
    met = met.withColumn("nth", F.row_number().over(order)).withColumns(unit_of)
    copies = met.withColumn("copies", copies_of(F.col("nth"))).where(F.col("copies") > 0)
    return copies.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
