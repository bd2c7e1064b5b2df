"""SimHash fingerprints and a Hamming-radius search, with DataFrame functions only.

Every run of two words (a shorter text: its words as one) is a term, weighted
by its length in characters; common short words so count little.  Each bit of
a term's 64-bit hash votes with the term's weight for or against that bit of
the fingerprint.  Two bits' votes are summed in one long (32 bits each), so a
text needs 33 sums whatever its length.

The search splits fingerprints into blocks.  Two fingerprints within radius r
agree on at least ``blocks - r`` blocks, so tables keyed by every choice of
that many blocks hold each such pair in some bucket.

Cases: a null text is empty; a text without words has fingerprint 0; equal
texts have equal fingerprints; a tied bit is 0; texts that repeat an id are
ordered by their hash; rows that repeat id and text count once in the order
and get equal results; the last document's next one is the first (of one
document, itself); a null id comes last; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import documents, id_key, stored, text_hash

BITS = 64
LANE = 0x0000000100000001          # two counters of 32 bits in a long


def terms(text: str) -> str:
    """SQL for an array of (hash, weight) of all word pairs of a column."""
    return f"""transform(array(filter(split({text}, '[ \\\\t-\\\\r]+', -1), w -> w <> '')), ws ->
        CASE WHEN size(ws) < 2 THEN transform(ws, w -> named_struct('h', xxhash64(w), 'w', length(w)))
             ELSE zip_with(slice(ws, 1, size(ws) - 1), slice(ws, 2, size(ws) - 1),
                           (a, b) -> named_struct('h', xxhash64(a, b), 'w', length(a) + length(b))) END)[0]"""


def votes() -> list[Column]:
    """33 sums over exploded terms: weight, and bits k and k + 32 weighted."""
    h, w = F.col("__t.h"), F.col("__t.w").cast("long")
    lanes = [F.sum(F.shiftrightunsigned(h, k).bitwiseAND(F.lit(LANE)) * w).alias(f"__v{k}") for k in range(32)]
    return [F.sum(w).alias("__all"), *lanes]


def signed_bits() -> Column:
    """The fingerprint: a bit is set where over half of the weight voted for it."""
    sql = []
    for k in range(32):
        sql.append(f"CASE WHEN 2 * (__v{k} & 4294967295L) > __all THEN {1 << k}L ELSE 0L END")
        high = f"{1 << (k + 32)}L" if k < 31 else "(-9223372036854775807L - 1L)"
        sql.append(f"CASE WHEN 2 * shiftrightunsigned(__v{k}, 32) > __all THEN {high} ELSE 0L END")
    return F.coalesce(F.expr(" | ".join(sql)), F.lit(0).cast("long"))


def fingerprints(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """The ``fingerprint`` of each row's text; ``keys`` must name one row each.

    Only one row of sums for each text can be shuffled, never its terms.
    """
    exploded = rows.select(*keys, F.explode_outer(F.expr(terms(text))).alias("__t"))
    return exploded.groupBy(*keys).agg(*votes()).select(*keys, signed_bits().alias("fingerprint"))


def likeness(a: Column | str, b: Column | str) -> Column:
    """Share of equal bits."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def as_text(fingerprint: str) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def near_search(queries: DataFrame, base: DataFrame, radius: int = 3, blocks: int | None = None) -> DataFrame:
    """All (``query``, ``found``) pairs of different fingerprints within ``radius``.

    Both inputs have a ``fingerprint``; equal ones count once (documents with
    equal fingerprints are a class, which their own rows name).  A pair is
    given by the first table whose blocks agree, so none is given twice.
    """
    blocks = blocks or radius + 2
    edges = [BITS * i // blocks for i in range(blocks + 1)]

    def part(col: str, i: int) -> Column:
        width = edges[i + 1] - edges[i]
        return F.shiftrightunsigned(F.col(col), edges[i]).bitwiseAND(F.lit((1 << width) - 1))

    choices = list(combinations(range(blocks), blocks - radius))

    def tables(df: DataFrame, name: str) -> DataFrame:
        own = df.select(F.col("fingerprint").alias(name)).filter(F.col(name).isNotNull()).distinct()
        keys = [F.struct(F.lit(n).alias("n"), F.xxhash64(*[part(name, i) for i in c]).alias("k"))
                for n, c in enumerate(choices)]
        return own.select(name, F.explode(F.array(*keys)).alias("__key")).select(name, "__key.n", "__key.k")

    first = F.least(*[F.when(reduce(Column.__and__, [part("query", i) == part("found", i) for i in c]), F.lit(n))
                      .otherwise(F.lit(len(choices))) for n, c in enumerate(choices)])
    pairs = tables(queries, "query").join(tables(base, "found"), ["n", "k"])
    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("found")))
    return (pairs.filter((F.col("query") != F.col("found")) & (distance <= radius) & (F.col("n") == first))
            .select("query", "found", distance.alias("distance")))


def neighbours(light: DataFrame) -> DataFrame:
    """(``__id``, ``__th``, ``__n``) rows in descending order of id, each with
    the structs ``__next`` and ``__prev`` of the rows beside it (as a ring).

    Ids, hashes and lengths only, dealt by ranges of the id.  A window within
    each range gives the neighbours; the ranges' two ends, one row for each
    range, are joined among themselves.
    """
    dealt = light.repartitionByRange(F.col("__id").desc(), "__th").withColumn("__range", F.spark_partition_id())
    # written: a range keeps its number when it is read again
    dealt = stored(dealt.withColumn("__at", F.struct(F.bitwise_not("__id").alias("o"), "__th", "__n")), "ranges")
    w = Window.partitionBy("__range").orderBy("__at")
    near = dealt.withColumns({"__next": F.lead("__at").over(w), "__prev": F.lag("__at").over(w)})
    ends = dealt.groupBy("__range").agg(F.min("__at").alias("__a"), F.max("__at").alias("__z"))
    ring = Window.orderBy("__range")            # over as many rows as there are ranges
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("__range", F.coalesce(F.lead("__a").over(ring), F.first("__a").over(whole)).alias("__after"),
                       F.coalesce(F.lag("__z").over(ring), F.last("__z").over(whole)).alias("__before"))
    return near.join(F.broadcast(ends), "__range").select(
        "__id", "__th", "__n", F.coalesce("__next", "__after").alias("__next"),
        F.coalesce("__prev", "__before").alias("__prev"))


def edited(docs: DataFrame) -> DataFrame:
    """Each distinct (id, text) with its text and its edited text: the last
    third replaced by as much of the start of the next one's text.

    Whole texts are shuffled once, to meet their neighbours' keys; from there
    only the start of each goes on to the row before it.
    """
    rows = (docs.select(id_key().alias("__id"), text_hash().alias("__th"),
                        F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["__id", "__th"]))
    light = (docs.select(id_key().alias("__id"), text_hash().alias("__th"),
                         F.char_length(F.coalesce("text", F.lit(""))).alias("__n")).distinct())
    met = rows.join(stored(neighbours(light), "neighbours"), ["__id", "__th"])
    starts = met.select(F.bitwise_not("__prev.o").alias("__id"), F.col("__prev.__th").alias("__th"),
                        F.expr("left(text, CAST(floor(__prev.__n / 3) AS int))").alias("__start"))
    return met.join(starts, ["__id", "__th"]).select(
        "__id", "__th", F.bitwise_not("__next.o").alias("__nid"), F.col("__next.__th").alias("__nth"),
        F.col("__n").alias("n_chars"), "text",
        F.expr("concat(left(text, __n - CAST(floor(__n / 3) AS int)), __start)").alias("edited"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts, their likeness to
    the edited and the next text's, and, for every id divisible by 50,
    ``n_near``: how many other documents lie within 3 bits."""
    docs = documents(spark, sf_dir)
    both = edited(docs).select("__id", "__th", "__nid", "__nth", "n_chars", F.explode(F.array(
        *[F.struct(F.lit(i).alias("which"), F.col(c).alias("body")) for i, c in enumerate(("text", "edited"))])))
    both = both.select("__id", "__th", "__nid", "__nth", "n_chars", "col.which", "col.body",
                       F.sha2("col.body", 256).alias("sha"))
    made = stored(fingerprints(both, ["__id", "__th", "__nid", "__nth", "n_chars", "which", "sha"], "body"), "prints")
    own = made.filter("which = 0").drop("which", "sha")
    other = made.filter("which = 1").select("__id", "__th", F.col("sha").alias("edited_sha256"),
                                            F.col("fingerprint").alias("__edited"))
    after = own.select(F.col("__id").alias("__nid"), F.col("__th").alias("__nth"),
                       F.col("fingerprint").alias("__after"))
    rows = docs.select("doc_id", id_key().alias("__id"), text_hash().alias("__th"))
    found = rows.join(own.join(other, ["__id", "__th"]).join(after, ["__nid", "__nth"]), ["__id", "__th"])
    # classes of equal fingerprints; pairs only between different ones
    classes = (rows.join(own.select("__id", "__th", "fingerprint"), ["__id", "__th"])
               .groupBy("fingerprint").agg(F.count("*").alias("__members")))
    asked = own.filter("__id % 50 = 0").select("fingerprint").distinct()
    pairs = near_search(asked, own).join(classes.withColumnRenamed("fingerprint", "found"), "found")
    around = pairs.groupBy(F.col("query").alias("fingerprint")).agg(F.sum("__members").alias("__others"))
    counts = asked.join(classes, "fingerprint").join(around, "fingerprint", "left").select(
        "fingerprint", (F.col("__members") - 1 + F.coalesce("__others", F.lit(0))).alias("__near"))
    return found.join(counts, "fingerprint", "left").select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        as_text("fingerprint").alias("fingerprint"), as_text("__edited").alias("edited_fingerprint"),
        likeness("fingerprint", "__edited").alias("near_edited"),
        likeness("fingerprint", "__after").alias("near_next"),
        F.when(F.col("doc_id") % 50 == 0, F.col("__near")).alias("n_near"))
