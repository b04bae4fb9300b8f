"""Mixing sources to target weights by pivotal dependent rounding, in SQL alone.

Each document of a source should appear ``target / source_size`` times; the
whole part is certain and the fraction is rounded to 0 or 1. Pairs of fractions
swap mass: one rises and the other falls, by amounts in the inverse ratio of
their sizes, so the pair's expected words stay exactly as they were, until one
of the two is 0 or 1; the direction is random with the odds that keep both
expectations. The one left open meets the next document.

The pairs form a reduction tree. Leaves are buckets of about ``fan`` documents of
one source and one size class (a hash of the id deals them, their number comes
from exact counts, so a hot source simply has more buckets); each leaves at most
one open document, ``fan`` buckets meet in the next level, until a class has one.
At the root a source's open documents, with about ``fan`` of all sizes held back
for it, are drawn largest first, each with its fraction plus the words the ones
before it left over or short: what remains is the error of the smallest ones.
Every level is a written table with a ``fan``-th of the rows before it; randomness
is a hash of the pair and the seed, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesq.llm.common import word_count, written

WEIGHTS, SHARE, MOST, FAN, SEED = (3.0, 1.0, 2.0), 1.5, 2.0, 64, 42


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sizes(source, source_size)`` -> the same with ``weight`` and ``target``.

    Sources by code point, NULL last, take the weights in turn. The targets share
    ``share`` of all sizes by weight; none passes ``most`` times its size and the
    excess goes to the others by weight. That is a water level L with target
    ``min(most * size, L * weight)``: sources fill up in the order of
    ``most * size / weight``, so running sums give L without iterating. Works on
    the table of sources only (one row each). Sources without words get 0."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    top = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(most))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before, whole = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(whole) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # a source is full where the level that the fuller ones leave still passes its cap
    marked = top.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= F.col("cap"))
    # full sources come first in this order, so the first open one has everyone's level
    first_open = F.min(F.when(~F.col("full"), F.struct((F.col("cap") / F.col("weight")).alias("r"), "level"))).over(whole)["level"]
    return marked.withColumn("open", first_open).select(
        "source", "source_size", "weight",
        F.when(F.col("full") | F.col("open").isNull(), F.col("cap")).otherwise(F.col("open") * F.col("weight")).alias("target"))


_DOC = "struct<source:string,doc_id:bigint,dup:int,size:bigint,base:int,p:double,key:bigint>"
_DONE = f"cast(array() as array<struct<d:{_DOC},up:int>>)"


def _uniform(*keys):
    return F.shiftrightunsigned(F.xxhash64(*keys, F.lit(SEED)), 11) / F.lit(float(2 ** 53))


def _meet(items):
    """SQL fold of an array of open documents -> struct(rest, done): pairs swap
    mass, at most one document stays in ``rest``, the others have their ``up``."""
    def step(acc, b):
        a = acc["rest"]
        ratio = b["size"] / a["size"]
        rise = F.least(1 - a["p"], b["p"] * ratio)         # a up, b down, in a's fraction
        sink = F.least(a["p"], (1 - b["p"]) * ratio)       # a down, b up
        up = _uniform(a["key"], b["key"]) * (rise + sink) < sink
        a_ends = F.when(up, 1 - a["p"] <= b["p"] * ratio).otherwise(a["p"] <= (1 - b["p"]) * ratio)
        b_left = F.when(up, b["p"] - (1 - a["p"]) / ratio).otherwise(b["p"] + a["p"] / ratio)
        a_left = F.when(up, a["p"] + b["p"] * ratio).otherwise(a["p"] - (1 - b["p"]) * ratio)
        within = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
        ended = F.when(a_ends, F.struct(a.alias("d"), F.when(up, 1).otherwise(0).alias("up"))).otherwise(
            F.struct(b.alias("d"), F.when(up, 0).otherwise(1).alias("up")))
        rest = F.when(a_ends, b.withField("p", within(b_left))).otherwise(a.withField("p", within(a_left)))
        return F.when(a.isNull(), F.struct(b.alias("rest"), acc["done"].alias("done"))).otherwise(
            F.struct(rest.alias("rest"), F.concat(acc["done"], F.array(ended)).alias("done")))

    start = F.expr(f"named_struct('rest', cast(null as {_DOC}), 'done', {_DONE})")
    return F.aggregate(items, start, step)


def _draw(items):
    """SQL fold, largest document first -> struct(rest, done): each is drawn with
    its fraction plus the words still owed; ``rest`` is what stays owed."""
    def step(acc, b):
        up = (_uniform(b["key"]) < b["p"] + acc["rest"] / b["size"]).cast("int")
        owed = acc["rest"] + (b["p"] - up) * b["size"]
        return F.struct(owed.alias("rest"), F.concat(acc["done"], F.array(F.struct(b.alias("d"), up.alias("up")))).alias("done"))

    return F.aggregate(F.reverse(items), F.expr(f"named_struct('rest', 0d, 'done', {_DONE})"), step)


def pivotal_copies(docs: DataFrame, fan: int = FAN) -> DataFrame:
    """``docs(source, doc_id, size, rate)`` -> ``source, doc_id, dup, size, copies``,
    one row per row (``dup`` numbers rows alike in the other three). Documents
    without words, or of a whole rate, need no rounding."""
    base = F.floor("rate").cast("int")
    repeats = Window.partitionBy("doc_id", "source", "size").orderBy("rate")
    rows = docs.select("source", "doc_id", F.row_number().over(repeats).alias("dup"), "size", base.alias("base"),
                       (F.col("rate") - base).alias("p"))
    rows = written(rows.withColumn("key", F.xxhash64("source", "doc_id", "dup", "size")), "mix-docs")
    plain = F.coalesce((F.col("p") <= 0) | (F.col("size") == 0), F.lit(True))
    copies = rows.filter(plain).select("source", "doc_id", "dup", "size", F.col("base").alias("copies"))
    # size classes a quarter octave wide: partners are of like size
    todo = rows.filter(~plain).select(F.struct("source", "doc_id", "dup", "size", "base", "p", "key").alias("d"),
                                      "source", F.floor(F.log2("size") * 4).cast("int").alias("class"))
    per_class = todo.groupBy("source", "class").agg(F.count("d").alias("n"))
    of_source = F.sum("n").over(Window.partitionBy("source"))
    counts = written(per_class.select("source", "class", F.ceil(F.col("n") / fan).alias("buckets"),
                                      F.ceil(of_source / fan).alias("slices")), "mix-counts")
    level = todo.alias("t").join(counts.alias("c"), F.expr("t.source <=> c.source and t.class = c.class")).select(
        "d", "t.source", "t.class", F.expr("pmod(d.key, buckets)").alias("bucket"),
        F.expr("pmod(xxhash64(d.key), slices) = 0").alias("held"))
    held = level.filter("held").select("d", "source")
    level = level.filter("not held").drop("held")
    most = counts.agg(F.max("buckets")).first()[0]
    if most is None:
        return copies
    while True:
        folded = written(_fold(level, ["source", "class", "bucket"], _meet), "mix-level")
        copies = copies.unionByName(_decided(folded))
        if most == 1:
            break
        level = folded.select(F.col("rest").alias("d"), "source", "class", F.floor(F.col("bucket") / fan).alias("bucket"))
        most = -(-most // fan)
    root = folded.select(F.col("rest").alias("d"), "source").unionByName(held)  # a few hundred rows a source at most
    return copies.unionByName(_decided(written(_fold(root, ["source"], _draw), "mix-root")))


def _fold(level: DataFrame, keys: list[str], how) -> DataFrame:
    items = F.array_sort(F.collect_list(F.struct("d.size", "d.key", "d")))
    return (level.groupBy(*keys).agg(items.alias("items"))
            .select(*keys, how(F.transform("items", lambda x: x["d"])).alias("f"))
            .select(*keys, "f.rest", "f.done"))


def _decided(folded: DataFrame) -> DataFrame:
    d = folded.select(F.explode("done").alias("x"))
    return d.select("x.d.source", "x.d.doc_id", "x.d.dup", "x.d.size", (F.col("x.d.base") + F.col("x.up")).alias("copies"))


def _sized(docs: DataFrame, weights: tuple, share: float, most: float) -> tuple[DataFrame, DataFrame]:
    sized = written(docs, "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return sized, written(source_targets(sizes, weights, share, most), "mix-targets")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, fan: int = FAN,
        doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, source, dup, size, source_size, target, copies, taken`` of every row.

    ``size`` is the text's words (NULL or blank: 0, taken 0), ``taken`` is
    ``copies * size``; copies are at most ``ceil(most)``. A source's taken words
    come near its target (README: figures); the last documents of a source are
    drawn largest first by the words still owed, not by their own fractions alone. NULL sources form one
    source, last in order; repeated rows and NULL ids are rounded one by one; an
    empty table gives an empty result; other columns are not read."""
    sized, targets = _sized(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                                        word_count(F.col(text)).alias("size")), weights, share, most)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = (sized.alias("s").join(targets.alias("t"), F.expr("s.source <=> t.source"))
             .select("s.source", "s.doc_id", "s.size", rate.alias("rate")))
    rounded = pivotal_copies(rated, fan)
    return (rounded.alias("r").join(targets.alias("t"), F.expr("r.source <=> t.source"))
            .select("doc_id", "r.source", "dup", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The mix itself: each document as many times as ``mix`` gives it copies;
    documents without words stay once. Columns are as given."""
    size, key = word_count(F.col(text)), ["doc_id", "source", "size"]
    chosen = (mix(docs, doc_id=doc_id, text=text, source=source, **how).withColumn("key", F.xxhash64(*key))
              .groupBy("key", *key).agg(F.array_sort(F.collect_list(F.struct("dup", "copies"))).alias("copies")))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("d"), F.col(doc_id).alias("doc_id"),
                       F.col(source).alias("source"), size.alias("size")).withColumn("key", F.xxhash64(*key))
    both = rows.alias("r").join(chosen.alias("m"), F.expr(
        "r.key = m.key and r.doc_id <=> m.doc_id and r.source <=> m.source and r.size = m.size"))
    # rows alike in id, source and size take the copies in turn; grouped by the join's own key, so not shuffled again
    turn = F.row_number().over(Window.partitionBy("r.key", "r.doc_id", "r.source").orderBy("r.size"))
    both = both.select("d", F.col("r.size").alias("size"), "copies", turn.alias("turn"))
    times = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.expr("copies[turn - 1].copies"))
    return both.select("d", F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).select("d.*")
