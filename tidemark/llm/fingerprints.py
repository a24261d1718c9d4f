"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame functions alone.

A document's paragraphs (lines; long lines in pieces of 20 words) are hashed to keys; equal paragraphs count as one key with their
number. A sketch adds each key to three cells, which hold a count, the XOR of keys and the XOR of their checksums.
Subtracting two sketches leaves the keys on one side only; peeling takes cells that hold a single key, removes
it from its other cells, and so on. If cells are left over, the next larger size is tried. Only cells in use are stored, so work
grows with the number of paragraphs and not with the size of the sketch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import dealt_by_id, materialize, partitions

#: Cells in each third of a sketch, tried in turn. The first is the size of the stored fingerprint.
SIZES = (16, 128, 1024, 8192, 65_536, 524_288)
ROUNDS = 40
#: A paragraph: at most 20 words of a line.
PIECE = r"\S++(?:[^\S\n]++\S++){0,19}+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluates value once for all its uses in body."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def paragraph_keys(text: Column) -> Column:
    """Sorted distinct keys of a text's paragraphs; a key also depends on how often its paragraph occurs."""
    hashes = F.sort_array(F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), lambda p: F.xxhash64(p)))

    def counted(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(starts, lambda at: F.transform(at, lambda b, j: F.xxhash64(F.get(s, b), F.coalesce(F.get(at, j + 1), F.size(s)) - b)))

    return let(hashes, lambda s: F.when(F.size(s) == 0, F.array().cast("array<bigint>")).otherwise(F.sort_array(counted(s))))


def cell(place: Column, count: Column, key: Column, check: Column) -> Column:
    return F.struct(place.cast("int").alias("p"), count.cast("int").alias("c"), key.alias("k"), check.alias("h"))


CELLS = "array<struct<p:int,c:int,k:bigint,h:bigint>>"


def gather(cells: Column) -> Column:
    """Sums the entries of each cell and leaves out cells that hold nothing."""

    def grouped(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i)["p"] != F.get(s, i - 1)["p"]))

        def added(at: Column, b: Column, j: Column) -> Column:
            first = F.get(s, b)
            more = F.slice(s, b + 2, F.coalesce(F.get(at, j + 1), F.size(s)) - b - 1)
            return F.aggregate(more, first, lambda a, x: cell(first["p"], a["c"] + x["c"], a["k"].bitwiseXOR(x["k"]), a["h"].bitwiseXOR(x["h"])))

        summed = let(starts, lambda at: F.transform(at, lambda b, j: added(at, b, j)))
        return F.filter(summed, lambda x: (x["c"] != 0) | (x["k"] != 0) | (x["h"] != 0))

    return let(F.sort_array(cells), lambda s: F.when(F.size(s) == 0, s).otherwise(grouped(s)))


def entries(keys: Column, size: Column, sign: int) -> Column:
    """The three cell entries of each key."""

    def three(k: Column) -> Column:
        return F.transform(F.array(F.xxhash64(k, F.lit(1))), lambda h: F.array(*[cell(F.lit(j) * size + F.shiftrightunsigned(k, 20 * j).bitwiseAND((size - 1).cast("long")), F.lit(sign), k, h) for j in range(3)]))

    return F.flatten(F.flatten(F.transform(keys, three)))


def sketch(keys: Column, size: Column) -> Column:
    return gather(entries(keys, size, 1))


def subtract(a: Column, b: Column) -> Column:
    return gather(F.concat(a, F.transform(b, lambda x: cell(x["p"], -x["c"], x["k"], x["h"]))))


def peel(cells: Column, size: Column) -> Column:
    """Number of keys on either side, or -1 if the sketch is too small for them."""

    def step(state: Column, _: Column) -> Column:
        def single(count: int) -> Column:
            pure = F.filter(state["cells"], lambda x: (x["c"] == count) & (x["h"] == F.xxhash64(x["k"], F.lit(1))))
            return F.array_distinct(F.transform(pure, lambda x: x["k"]))

        def removed(found: Column) -> Column:
            rest = gather(F.concat(state["cells"], entries(found["a"], size, -1), entries(found["b"], size, 1)))
            n = F.size(found["a"]) + F.size(found["b"])
            return F.when(n == 0, F.struct(state["cells"].alias("cells"), state["n"].alias("n"), F.lit(True).alias("stuck"))).otherwise(F.struct(rest.alias("cells"), (state["n"] + n).alias("n"), F.lit(False).alias("stuck")))

        again = let(F.struct(single(1).alias("a"), single(-1).alias("b")), removed)
        return F.when(state["stuck"] | (F.size(state["cells"]) == 0), state).otherwise(again)

    start = F.struct(cells.alias("cells"), F.lit(0).alias("n"), F.lit(False).alias("stuck"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.when(F.size(s["cells"]) == 0, s["n"]).otherwise(-1))


def likeness(a: Column, b: Column, a0: Column, b0: Column) -> Column:
    """Jaccard likeness of two key sets from the difference their sketches give up, and the cells of the sketch that did.

    a0, b0: their sketches of the first size. A sketch with fewer cells than the sets differ in size can't give the difference up and isn't
    tried. Two texts without paragraphs are alike (1.0), one without and one with aren't (0.0). cells 0: no sketch was
    large enough, and the keys themselves were compared.
    """
    gap = F.abs(F.size(a) - F.size(b))

    def state(found: Column, cells: Column) -> Column:
        return F.struct(found.cast("int").alias("found"), cells.cast("int").alias("cells"))

    def attempt(s: Column, size: Column) -> Column:
        built = F.when(size == SIZES[0], subtract(a0, b0)).otherwise(subtract(sketch(a, size), sketch(b, size)))
        return F.when((s["found"] >= 0) | (gap > 3 * size), s).otherwise(let(let(built, lambda cells: peel(cells, size)), lambda n: state(n, F.when(n >= 0, 3 * size).otherwise(0))))

    peeled = F.aggregate(F.array(*[F.lit(s) for s in SIZES]), state(F.lit(-1), F.lit(0)), attempt)
    exact = F.size(F.array_except(a, b)) + F.size(F.array_except(b, a))  # beyond the largest sketch

    def ratio(s: Column) -> Column:
        return let(F.when(s["found"] >= 0, s["found"]).otherwise(exact), lambda d: F.struct(share(d).alias("near"), s["cells"].alias("cells")))

    def share(d: Column) -> Column:
        common = (F.size(a) + F.size(b) - d) / 2
        return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(common / (common + d))

    return let(peeled, ratio)


def text_of(cells: Column) -> Column:
    """A sketch as text: place, count, key and checksum of each cell in hexadecimal."""
    return F.array_join(F.transform(cells, lambda x: F.concat(F.lower(F.hex(x["p"])), F.lit(":"), F.lower(F.hex(x["c"])), F.lit(":"), F.lower(F.hex(x["k"])), F.lit(":"), F.lower(F.hex(x["h"])))), " ")


def with_next(docs: DataFrame, rows_per_range: int = 1024) -> DataFrame:
    """doc_id, text, keys, next_text, next_keys: each document beside the next by ascending doc_id, the first after the last.

    Null texts are empty, null doc_ids come first, documents of one id are ordered by a hash of their text; one document alone follows
    itself. Documents are dealt by ranges of few rows, also where one id has very many, and each range also gets
    the first document of the range after it.
    """
    spark = docs.sparkSession
    dealt, ranges = dealt_by_id(docs, rows_per_range)
    heads = dealt.groupBy("at").agg(F.min(F.struct("o", "h")).alias("f"))
    heads, _ = materialize(heads.select("at", "f.o", "f.h"), "range-heads")
    by_range = Window.orderBy("at")  # a row for each range
    everything = Window.partitionBy()
    linked = heads.select("at", "o", "h", F.coalesce(F.lag("at").over(by_range), F.max("at").over(everything)).alias("before"))
    placed = dealt.withColumn("keys", paragraph_keys(F.col("text")))
    # copies of a range's first document are all the same: one of them goes to the range before
    firsts = dealt.join(linked, ["at", "o", "h"]).select("before", "o", "h", "text").groupBy("before").agg(F.min(F.struct("o", "h", "text")).alias("x"))
    extra = firsts.select(F.lit(None).cast("long").alias("doc_id"), "x.text", "x.o", "x.h", F.col("before").alias("at"), paragraph_keys(F.col("x.text")).alias("keys"), F.lit(1).alias("extra"))
    spread = partitions(spark)
    # more tasks than usual, since ranges fall on them by hash and peeling is the costly part
    rows = placed.withColumn("extra", F.lit(0)).select(*extra.columns).unionByName(extra).repartition(max(spread, min(ranges, 4 * spread)), "at")
    follow = Window.partitionBy("at").orderBy("extra", "o", "h", "text")
    return rows.select("doc_id", "text", "keys", "extra", F.lead("text").over(follow).alias("next_text"), F.lead("keys").over(follow).alias("next_keys")).filter("extra = 0").drop("extra")


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text (last quarter replaced by the start of the next document).

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and the cells of the sketches
    that the two likenesses came from (near_edited_cells, near_next_cells): the fingerprint is the sketch of 48 cells, which holds the whole
    difference of texts that differ in few paragraphs; others were subtracted and peeled at a larger size. Equal texts have
    equal fingerprints; null and empty texts have an empty one; very long texts count whole; repeated rows are each
    returned; an empty table gives an empty result; further columns of any name play no part.
    """
    size = F.lit(SIZES[0])
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter))
    pairs = with_next(docs).withColumn("edited", edited).withColumn("edited_keys", paragraph_keys(F.col("edited")))
    sketched = pairs.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "keys", "edited_keys", "next_keys",
        sketch(F.col("keys"), size).alias("own"), sketch(F.col("edited_keys"), size).alias("changed"), sketch(F.col("next_keys"), size).alias("following"),
    )
    likened = sketched.select(
        "doc_id", "n_chars", "edited_sha256", text_of(F.col("own")).alias("fingerprint"), text_of(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("keys"), F.col("edited_keys"), F.col("own"), F.col("changed")).alias("e"),
        likeness(F.col("keys"), F.col("next_keys"), F.col("own"), F.col("following")).alias("x"),
    )
    return likened.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", F.col("e.near").alias("near_edited"), F.col("x.near").alias("near_next"), F.col("e.cells").alias("near_edited_cells"), F.col("x.cells").alias("near_next_cells"))
