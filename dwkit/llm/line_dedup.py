"""Line deduplication by a deletion-neighbourhood join.

A line is dropped if an earlier line is equal to it, or lies within one word
edit (a word replaced, put in or left out) and both have at least ``min_words``
words.  Earlier means a smaller (document id, line number); lines compare by
their words in lower case, so layout does not matter.  Blank lines stay.

Near lines meet through their deletion neighbourhoods: every line enters itself
and all lines that arise by leaving out one word, as 64-bit keys.  The key of a line
without word i is the exclusive or of ``hash(word, place)`` with all places after i
moved by one; two running windows give all of a line's keys in linear time.
Equal keys are joined with the earliest line of their group (links to the earliest
decide as much as all pairs would), and the edit distance is verified on the words.

Lines without any neighbour need no variants: two lines within one edit have the
same first or the same last words (nearly half of them), so only lines sharing
such an end with another line go into the join.  Their words are fetched in a second scan.  Where few rows of a large table are
needed, a bitmap of ``SLOTS`` 64-bit words (a fixed size, whatever the input) lets
them through before the exact join by key.

Only DataFrame functions are used.  Equal lines are grouped by two 64-bit hashes.

Edge cases: null texts stay null; rows with the same id and text are alike, and
lines tied on the earliest place stay in each; null ids come last; documents are
never dropped, one without remaining lines gets an empty text; other columns are
kept; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwkit.llm.common import SPACE, staged

MIN_WORDS = 10
SLOTS = 1 << 17
_LAST = "99999999999999999999"   # place of null ids: beyond every 64-bit id


def _doc_key(text_col: str) -> Column:
    return F.xxhash64(F.col(text_col))


def normal(line: Column) -> Column:
    """A line's words in lower case with one blank between them."""
    odd = F.contains(line, F.lit("  "))
    for blank in "\t\r\v\f":
        odd = odd | F.contains(line, F.lit(blank))
    return F.lower(F.trim(F.when(odd, F.regexp_replace(line, SPACE, " ")).otherwise(line)))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per non-blank line with its place, normal form and two hashes."""
    place = (F.coalesce(F.col("id").cast("decimal(20,0)"), F.lit(_LAST).cast("decimal(20,0)"))
             * F.lit("10000000000").cast("decimal(11,0)") + F.col("pos"))
    return (docs.select(F.col(id_col).alias("id"), _doc_key(text_col).alias("doc"),
                        F.posexplode(F.split(F.col(text_col), "\n")).alias("pos", "line"))
            .withColumn("norm", normal(F.col("line"))).where("norm != ''")
            .select("id", "doc", "pos", place.alias("place"), "norm", F.xxhash64("norm").alias("h1")))


def _second_hash() -> Column:
    return F.xxhash64(F.lit("2"), F.col("norm")).alias("h2")


def _end_size(n: Column) -> Column:
    """Words of a line's first and last end: half of them at most, in steps of two."""
    return (F.floor(n / 4) * 2).cast("int")


def _ends(min_words: int) -> list[Column]:
    """Number of words, and hashes of the first and last ends, one of which a line shares
    with any line one edit away.  Lines of n - 1 and n words have the same size of
    end but where n is a multiple of four: those lines also enter the smaller size."""
    n = F.octet_length("norm") - F.octet_length(F.replace(F.col("norm"), F.lit(" "), F.lit(""))) + 1
    size = _end_size(F.col("n"))
    enough, also = F.col("n") >= min_words, F.col("n") % 4 == 0

    def end(size: Column, last: bool) -> Column:
        return F.xxhash64(F.lit(last), size, F.call_function(
            "substring_index", F.col("norm"), F.lit(" "), -size if last else size))
    return [n, F.when(enough, end(size, False)), F.when(enough, end(size, True)),
            F.when(enough & also, end(size - 2, False)), F.when(enough & also, end(size - 2, True))]


_ENDS = ["first1", "last1", "first2", "last2"]


class _Bitmap:
    """Filter for 64-bit hashes that some set may hold: ``SLOTS`` 64-bit words, whatever
    the set's size, so it may be broadcast.  Passes all of the set and few others."""

    def __init__(self, values: DataFrame, col: str) -> None:
        self.bits = values.groupBy(self._slot(col).alias("__slot")).agg(F.bit_or(self._bit(col)).alias("__bits"))

    @staticmethod
    def _slot(col: str) -> Column:
        return F.col(col).bitwiseAND(F.lit(SLOTS - 1))

    @staticmethod
    def _bit(col: str) -> Column:
        return F.expr(f"shiftleft(1L, cast(shiftrightunsigned({col}, 32) & 63 as int))")

    def keep(self, rows: DataFrame, col: str) -> DataFrame:
        return (rows.withColumn("__slot", self._slot(col)).join(F.broadcast(self.bits), "__slot")
                .where(F.col("__bits").bitwiseAND(self._bit(col)) != 0).drop("__slot", "__bits"))


def _repeated(rows: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` occurs more than once."""
    many = staged(rows.groupBy(col).agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(col), "repeated")
    return _Bitmap(many, col).keep(rows, col).join(many, col, "left_semi")


def _near(lines: DataFrame, firsts: DataFrame) -> DataFrame:
    """Keys ``(h1, h2)`` of the distinct lines with an earlier one within one word edit."""
    key = ["h1", "h2"]
    ends = firsts.where("first1 IS NOT NULL").select(*key, "first", F.explode(F.array(*[
        F.struct(F.col(c).alias("end"), F.lit(c.startswith("last")).alias("last")) for c in _ENDS])).alias("x"))
    ends = ends.select(*key, "first", F.col("x.end").alias("shared"), "x.last").where("shared IS NOT NULL")
    some = staged(_repeated(ends, "shared").groupBy(*key, "first").agg(
        F.bool_or(~F.col("last")).alias("by_first"), F.bool_or("last").alias("by_last")), "near")
    found = (_Bitmap(some, "h1").keep(lines.select("h1", "place", "norm"), "h1").withColumn("h2", _second_hash()).join(some, key).where("place = first")
             .select(*key, "place", "by_first", "by_last", F.split("norm", " ").alias("w")).dropDuplicates(key))
    texts = staged(found, "near")

    # A shared first end leaves the edit to the rest, a shared last end to what is before.
    each = (texts.repartition(*key).select(*key, "place", "by_first", "by_last", F.size("w").alias("n"), F.posexplode("w").alias("gap", "word"))
            .withColumns({"here": F.xxhash64("word", "gap"), "moved": F.xxhash64("word", F.col("gap") - 1)}))
    line = Window.partitionBy(*key)
    run = line.orderBy("gap")
    before = F.coalesce(F.bit_xor("here").over(run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    after = F.bit_xor("moved").over(line).bitwiseXOR(
        F.bit_xor("moved").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    size = _end_size(F.col("n")) - 2
    fits = (F.col("by_first") & (F.col("gap") >= size)) | (F.col("by_last") & (F.col("gap") <= F.col("n") - size))
    left_out = (each.withColumn("v", before.bitwiseXOR(after)).where(fits)
                .select("place", "gap", F.col("v").bitwiseXOR(F.xxhash64(F.col("n") - 1)).alias("key")))
    whole = each.groupBy(*key, "place", "n").agg(F.bit_xor("here").alias("v")).select(
        "place", F.lit(-1).alias("gap"), F.col("v").bitwiseXOR(F.xxhash64("n")).alias("key"))
    variants = staged(left_out.unionByName(whole), "variants")

    # The earliest line of every group of equal variants with the same gap, or with
    # a gap for the line itself and the other way round.
    live = staged(_repeated(variants, "key"), "variants")
    best = staged(live.groupBy("key", "gap").agg(F.min("place").alias("other")), "variants")
    base = best.where("gap = -1").select("key", "other")
    gaps = best.where("gap >= 0").groupBy("key").agg(F.min("other").alias("other"))
    gapped, plain = live.where("gap >= 0"), live.where("gap = -1")
    pairs = (gapped.join(best, ["key", "gap"]).select("place", "other")
             .unionByName(gapped.join(base, "key").select("place", "other"))
             .unionByName(plain.join(gaps, "key").select("place", "other"))
             .where("other < place").distinct())

    mine = texts.select(*key, "place", F.col("w").alias("a"))
    theirs = texts.select(F.col("place").alias("other"), F.col("w").alias("b"))
    checked = pairs.join(mine, "place").join(theirs, "other").where(_one_edit(F.col("a"), F.col("b")))
    return checked.select(*key).distinct()


def _one_edit(a: Column, b: Column) -> Column:
    """Whether two word arrays are at most one word edit apart."""
    na, nb = F.size(a), F.size(b)
    long, short = F.when(na >= nb, a).otherwise(b), F.when(na >= nb, b).otherwise(a)
    n, m = F.greatest(na, nb), F.least(na, nb)
    spots = F.sequence(F.lit(0), m - 1)
    # Words equal from the front, and from the back.
    front = F.coalesce(F.array_min(F.filter(spots, lambda i: F.get(long, i) != F.get(short, i))), m)
    back = F.coalesce(F.array_min(F.filter(spots, lambda i: F.get(long, n - 1 - i) != F.get(short, m - 1 - i))), m)
    return (n - m <= 1) & (front + back >= n - 1)


def drops(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``(id, doc, gone)``: per document (by id and text hash) the numbers of its dropped lines."""
    lines = _lines(docs, id_col, text_col)
    n, *ends = _ends(min_words)
    narrow = staged(lines.withColumn("n", n).select("id", "doc", "pos", "place", "h1", _second_hash(), *[
        h.alias(c) for h, c in zip(ends, _ENDS, strict=True)]), "lines")
    key = ["h1", "h2"]
    firsts = staged(narrow.groupBy(*key).agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("k"),
                                             *[F.min(c).alias(c) for c in _ENDS]), "firsts")
    near = _near(lines, firsts).withColumn("near", F.lit(True))
    doubtful = staged(firsts.join(near, key, "left").where("k > 1 OR near")
                      .select(*key, "first", F.coalesce("near", F.lit(False)).alias("near")), "firsts")
    return (narrow.select("id", "doc", "pos", "place", *key).join(doubtful, key).where("near OR place != first")
            .groupBy("id", "doc").agg(F.collect_set("pos").alias("gone")))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
          counts: bool = False) -> DataFrame:
    """``docs`` without the dropped lines; ``counts`` adds ``n_lines`` and ``n_dropped``."""
    gone = drops(docs, id_col, text_col, min_words).select(F.col("id").alias("__id"), F.col("doc").alias("__doc"),
                                                           F.col("gone").alias("__gone"))
    rows = F.col("__rows")
    rest = F.array_except(F.sequence(F.lit(0), F.size(rows) - 1), F.col("__gone"))
    text = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(
        F.array_join(F.transform(rest, lambda i: F.get(rows, i)), "\n"))
    # The lines are a column of their own: inside the lambda they would be split again for each.
    joined = (docs.join(gone, docs[id_col].eqNullSafe(F.col("__id")) & (_doc_key(text_col) == F.col("__doc")), "left")
              .withColumn("__rows", F.split(F.col(text_col), "\n")))
    cols = [text.alias(text_col) if c == text_col else F.col(c) for c in docs.columns]
    if counts:
        cols += [F.coalesce(F.size(rows), F.lit(0)).alias("n_lines"), F.coalesce(F.size("__gone"), F.lit(0)).alias("n_dropped")]
    return joined.select(*cols)
