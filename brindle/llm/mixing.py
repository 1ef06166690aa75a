"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Sources share all words by weight; a source's target stops at MAX_COPIES times its size, and what
it can't take is shared again by weight among the others (the sums are exact integers). Inside a source the expected copies
of a document grow slowly with its length: they are c * (LENGTH_BASE + number of binary digits of its size), but MAX_COPIES
at most, with the c that makes the expected words the source's target. Of the expected copies r, floor(r) are certain whole
copies. The rest, pi = r - floor(r), is the document's inclusion probability: documents are ranked by random odds over inclusion
odds, Q = (U / (1 - U)) / (pi / (1 - pi)), and taken in this order up to a fixed size, counted in words: what
the whole copies left of the target. A document that does not fit is stepped over and the order goes on, ROUNDS times.

U comes from a digest of seed, id and text, so reruns agree and nothing depends on how rows are
dealt out. No source is sorted in one task: sums over CLASSES classes of Q find that with the cut, and only the documents of this class,
about one in CLASSES of a source, are ranked exactly.

Cases: a null text has size 0 and nothing is taken of it. A null source is a source of its own, the
last. Rows that are equal in source, id and text are numbered, and each has a random number of its own, so that the cut takes as many of them as fit;
which of them it takes is left open. An
empty table gives an empty result. Extra columns pass through ``mix`` and are ignored by ``plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import configure, stage

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
SEED = 20
#: Classes of the order, at least, and documents of a class.
CLASSES = 4096
CLASS_ROWS = 2000
#: A document with twice the words is expected 1 / (LENGTH_BASE + digits) more often.
LENGTH_BASE = 20
#: How often a cut is sought: once, and again in the rest of the order after documents that don't fit are stepped over.
ROUNDS = 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def digest(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """Hex digest of the seed, the id and the text; its first 13 digits are the document's random number."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.coalesce(text, F.lit(""))))


def uniform(digest: Column) -> Column:
    """In (0, 1), exact in a double."""
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """Adds n, 0 and up in this order (total), without bringing all rows to one task."""
    cut = df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id())
    cut = stage(cut.withColumn("_k", F.row_number().over(Window.partitionBy("_p").orderBy(*order))), "ranges")
    before = F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))  # one row a partition
    base = cut.groupBy("_p").agg(F.count("*").alias("_c")).select(F.col("_p").alias("_q"), F.coalesce(before, F.lit(0)).alias("_b"))
    return cut.join(base, F.col("_p") == F.col("_q")).withColumn("n", F.col("_b") + F.col("_k") - 1).drop("_p", "_k", "_c", "_q", "_b")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """sources: (source, source_size long), one row each. Adds weight and target."""
    ranked = numbered(sources, F.col("source").isNull(), F.col("source"))
    by_place = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("n") % len(weights) + 1).cast("int"))
    s = stage(ranked.select("source", "source_size", by_place.alias("weight")), "sources")
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    total = int(s.agg(F.sum(exact("source_size"))).first()[0] or 0)
    left, share, n = total, 0, -1
    above = F.lit(False)
    while True:
        t = s.agg(F.sum(F.when(above, exact("source_size"))), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)).first()
        left, share = total - max_copies * int(t[0] or 0), int(t[1] or 0)
        if t[2] == n or not share:
            break
        n = t[2]
        above = exact("source_size") * F.lit(max_copies * share) < exact("weight") * F.lit(left).cast("decimal(38,0)")
    even = F.col("weight").cast("double") * F.lit(float(left)) / F.lit(float(share or 1))
    return s.withColumn("target", F.when(above, F.col("source_size").cast("double") * float(max_copies)).otherwise(even))


def digits(size: Column) -> Column:
    """Binary digits of a size, 1 for 0."""
    return F.length(F.bin(size))


def expected(n: Column, max_copies: int) -> Column:
    """Expected copies of a document with n binary digits in its size, in a source whose row has c (null: all are capped)."""
    return F.when(F.col("c").isNull(), float(max_copies)).otherwise(F.least(F.lit(float(max_copies)), F.col("c") * (LENGTH_BASE + n)))


def rates(by_length: DataFrame, max_copies: int) -> DataFrame:
    """by_length: (source, target, n, w): words w of a source's documents with n digits. Adds c and left, the words that whole copies leave of the target.

    The longest classes are capped first; c is that of the first class, from the longest, that needs no cap."""
    down = Window.partitionBy("source").orderBy(F.desc("n"))
    weighed = F.col("w") * (LENGTH_BASE + F.col("n"))
    capped = F.coalesce(F.sum("w").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum(weighed).over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    c = F.when(rest > 0, (F.col("target") - float(max_copies) * capped) / rest).otherwise(0.0)
    x = by_length.withColumn("c", c)
    per = x.groupBy("source").agg(
        F.first("target").alias("target"), F.sum("w").alias("source_size"), F.collect_list(F.struct("n", "w")).alias("lengths"),  # one entry a number of digits
        F.max_by("c", F.when(F.col("c") * (LENGTH_BASE + F.col("n")) <= max_copies, F.col("n"))).alias("c"),
    )
    whole = F.aggregate("lengths", F.lit(0).cast("long"), lambda acc, x: acc + F.floor(expected(x["n"], max_copies)).cast("long") * x["w"])
    return per.withColumn("left", F.col("target") - whole).drop("lengths")


def plan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = SEED, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(one row per document: doc_id, source, size, digest; one row per source: what decides the copies of its documents)."""
    return decided(docs, doc_id, text, source, weights, max_copies, seed, rounds)[:2]


def decided(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES, seed: int = SEED, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The two tables of ``plan``, and the repeated (source, digest)."""
    configure(docs.sparkSession)
    sized = docs.select(docs[doc_id].alias("doc_id"), docs[source].alias("source"), words(docs[text]).alias("size"), digest(docs[doc_id], docs[text], seed).alias("digest"))
    rows = stage(sized, "rows")
    again = stage(repeated(rows), "again")
    sized = stage(spread(rows, again), "sized")
    lengths = stage(sized.groupBy("source", digits(F.col("size")).alias("n")).agg(F.sum("size").alias("w")), "lengths")
    shares = targets(lengths.groupBy("source").agg(F.sum("w").alias("source_size")), weights, max_copies)
    by_length = lengths.alias("l").join(shares.alias("s"), same_source("l", "s")).select("l.source", "s.target", "l.n", "l.w")
    # As many classes as leave a class of the largest source CLASS_ROWS documents, on average.
    most = max(CLASSES, 1 << (sized.count() // CLASS_ROWS).bit_length())
    state = rates(by_length, max_copies).withColumn("cuts", F.array().cast(CUTS)).withColumn("classes", F.lit(most).cast("long"))
    state = stage(state, "rates")
    for _ in range(rounds):
        state = stage(cut_once(sized, state, max_copies), "cuts")
    return sized, state, again


#: What a round took: of the documents with at most ``room`` words, those up to (class, q, digest) in the order (all, without a class).
CUTS = "array<struct<room:double,class:long,q:double,digest:string>>"


def order_key(pi: Column) -> Column:
    """Null where nothing is drawn (pi is 0)."""
    u = uniform(F.col("digest"))
    return F.when(pi > 0, (u / (1 - u)) / (pi / (1 - pi)))


def classes(q: Column) -> Column:
    """Of the whole range of Q, which of its parts (column ``classes`` of the source's row)."""
    return F.floor(q / (1 + q) * F.col("classes")).cast("long")


def same_source(a: str, b: str) -> Column:
    return F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))


def drawn(size: Column, q: Column, digest: Column) -> Column:
    """Whether one of the rounds so far took the document."""
    c = classes(q)
    upto = lambda x: (q < x["q"]) | ((q == x["q"]) & (digest <= x["digest"]))
    last = lambda x: x["class"].isNull() | (c < x["class"]) | ((c == x["class"]) & F.coalesce(upto(x), F.lit(False)))
    return q.isNotNull() & F.exists("cuts", lambda x: (size <= x["room"]) & last(x))


def part(max_copies: int) -> Column:
    """The fractional part of the expected copies."""
    r = expected(digits(F.col("size")), max_copies)
    return r - F.floor(r)


def cut_once(sized: DataFrame, state: DataFrame, max_copies: int) -> DataFrame:
    """One more cut per source, among the documents not yet drawn that fit in what is left: the longest run of the order that fits as a whole."""
    rows = sized.alias("d").join(state.alias("s"), same_source("d", "s")).select("s.source", "s.left", "s.cuts", "s.c", "s.classes", "d.size", "d.digest")
    rows = rows.withColumn("q", order_key(part(max_copies))).where(F.col("q").isNotNull() & (F.col("size") <= F.col("left")))
    rows = rows.where(~drawn(F.col("size"), F.col("q"), F.col("digest"))).select("source", "left", "size", "digest", "q", classes(F.col("q")).alias("class"))
    sums = rows.groupBy("source", "class").agg(F.sum("size").alias("w"), F.first("left").alias("left"))
    sums = sums.withColumn("upto", F.sum("w").over(Window.partitionBy("source").orderBy("class").rowsBetween(Window.unboundedPreceding, 0)))
    # The first class that goes beyond what is left, and the words before it.
    beyond = F.min(F.when(F.col("upto") > F.col("left"), F.struct("class", (F.col("upto") - F.col("w")).alias("base"))))
    first = sums.groupBy("source").agg(beyond.alias("x"), F.max("upto").alias("all"))
    rows = rows.alias("r").join(first.where("x is not null").alias("k"), same_source("r", "k") & (F.col("r.class") == F.col("k.x.class"))).select("r.*", "k.x.base")
    upto = F.col("base") + F.sum("size").over(Window.partitionBy("source").orderBy("q", "digest"))
    last = rows.withColumn("upto", upto).groupBy("source").agg(
        F.first("class").alias("class"), F.first("base").alias("base"), F.max(F.when(F.col("upto") <= F.col("left"), F.struct("upto", "q", "digest"))).alias("x")
    )
    found = first.alias("t").join(last.alias("l"), same_source("t", "l"), "left").select(
        F.col("t.source").alias("source"), F.coalesce("l.x.upto", "l.base", "t.all").alias("took"), "l.class", F.col("l.x.q").alias("q"), F.col("l.x.digest").alias("digest")
    )
    met = state.alias("s").join(found.alias("f"), same_source("s", "f"), "left")
    new = F.array(F.struct(F.col("s.left").alias("room"), F.col("f.class").alias("class"), F.col("f.q").alias("q"), F.col("f.digest").alias("digest")))
    own = [c for c in state.columns if c not in ("left", "cuts")]
    return met.select(*[F.col(f"s.{c}") for c in own], (F.col("s.left") - F.coalesce("f.took", F.lit(0))).alias("left"), F.when(F.col("f.took").isNull(), F.col("s.cuts")).otherwise(F.concat("s.cuts", new.cast(CUTS))).alias("cuts"))


def copies(max_copies: int = MAX_COPIES) -> Column:
    """Of a document (size, digest) joined with its source's row."""
    whole = F.floor(expected(digits(F.col("size")), max_copies)).cast("long")
    q = order_key(part(max_copies))
    return whole + F.when(drawn(F.col("size"), q, F.col("digest")), 1).otherwise(0)


def spread(rows: DataFrame, again: DataFrame) -> DataFrame:
    """rows: with source and digest; again: the repeated ones. Of rows with the same two, all but one get digests of their own: by their number, which counts inside the tasks' parts first and adds
    what lies in the parts before, so that no task meets them all. Only repeated rows are written."""
    if again.isEmpty():
        return rows
    same = lambda a, b: same_source(a, b) & (F.col(f"{a}.digest") == F.col(f"{b}.digest"))
    own = rows.columns
    alone = rows.alias("r").join(again.alias("a"), same("r", "a"), "left_anti")
    met = rows.alias("r").join(again.alias("a"), same("r", "a"), "left_semi").withColumn("_m", F.monotonically_increasing_id())
    met = stage(met, "repeated").withColumn("_p", F.shiftright("_m", 33))
    runs = met.groupBy("source", "digest", "_p").agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy("source", "digest").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("before", F.coalesce(before, F.lit(0)))
    inside = met.withColumn("_k", F.row_number().over(Window.partitionBy("source", "digest", "_p").orderBy("_m")) - 1)
    at = inside.alias("r").join(runs.alias("a"), same("r", "a") & (F.col("r._p") == F.col("a._p"))).withColumn("_n", F.col("r._k") + F.col("a.before"))
    fresh = F.when(F.col("_n") > 0, F.md5(F.concat(F.col("r.digest"), F.lit(":"), F.col("_n").cast("string")))).otherwise(F.col("r.digest"))
    return alone.unionByName(at.select(*[(fresh if c == "digest" else F.col(f"r.{c}")).alias(c) for c in own]))


def repeated(rows: DataFrame) -> DataFrame:
    return rows.groupBy("source", "digest").agg(F.count("*").alias("n")).where("n > 1").drop("n")


def report(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) of every document."""
    sized, shares = plan(docs, **options)
    out = sized.alias("d").join(shares.alias("s"), same_source("d", "s"), "left")
    n = copies(options.get("max_copies", MAX_COPIES))
    return out.select("doc_id", "size", "source_size", "target", (n * F.col("size")).alias("taken"), n.alias("copies"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED, **options) -> DataFrame:
    """Each document as often as the mix takes it, with its columns as they were. Only the sources' rows are joined, so no text is shuffled
    but for those of repeated rows."""
    own = docs.columns
    _, shares, again = decided(docs, doc_id, text, source, seed=seed, **options)
    plain = docs.select(*[docs[c].alias(f"_{i}") for i, c in enumerate(own)])
    at = lambda c: F.col(f"_{own.index(c)}")
    keyed = plain.withColumn("digest", digest(at(doc_id), at(text), seed)).withColumn("source", at(source)).withColumn("size", words(at(text)))
    out = spread(keyed, again).alias("d").join(shares.alias("s"), same_source("d", "s"), "left").withColumn("n", copies(options.get("max_copies", MAX_COPIES)).cast("int")).where("n > 0")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n")))).select(*[F.col(f"d._{i}").alias(c) for i, c in enumerate(own)])
