"""Line deduplication within an edit of one character. DataFrame functions only.

A line is compared by its trimmed, lower-cased form. Equal lines fall together first. Two different lines within one edit
share a variant: both lose the character at the same place (a replacement), or one loses a character and is the other
(an insertion). Each variant is hashed and equal variants meet in a group-by, which keeps the earliest line of each; so
no pairs are formed however many lines share a variant. A line's variants are hashed by cells of 64 characters, the rest
of the line entering as two hashes, so long lines cost little more than their length.

Most lines have no neighbour. Of two lines cut into pieces, one edit touches one piece, and the rest agrees: only lines
that agree with another one in one of two halves, then in three of four quarters, give variants, and only for places in
the piece that may differ. That loses no pair. Shared half keys go back to the scan as a bitmap of fixed size, so the
texts of lines without a neighbour are never moved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import query, table
from quayside.session import run_dir, stage

#: By default, lines with fewer characters are only compared whole: one edit would change too much of them.
SHORT = 12
CELL = 64
#: Bits of the bitmap of shared half keys.
BITS = 1 << 20


def trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r\x0b\x0c"))


def split_lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per line that is not blank: where it stands, the form that lines are compared by, and 128 bits for it."""
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("twin"), F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    formed = rows.where(trimmed(F.col("line")) != "").select(F.struct("id", "twin", "line_no").alias("place"), F.lower(trimmed(F.col("line"))).alias("form"))
    return formed.select("place", "form", F.xxhash64("form").alias("h1"), F.xxhash64(F.lit(7), "form").alias("h2"))


def cut_at(size: Column, piece: int | Column, power: int) -> Column:
    """Where a piece of a line of ``size`` characters begins, of ``2 ** power`` pieces."""
    return F.shiftright(size * piece, power).cast("int")


def piece_key(less: int, piece: int, power: int) -> Column:
    """Hash of ``form`` without one piece, as a line shorter by ``less`` is cut."""
    size = F.length("form") - less
    return F.xxhash64(F.lit(power * 10 + piece), size, F.left("form", cut_at(size, piece, power)), F.right("form", size - cut_at(size, piece + 1, power)))


def half_keys(shortest: int) -> Column:
    """Both half keys for both lengths; null for a line of fewer than ``shortest`` characters."""
    keys = F.array(*[piece_key(less, piece, 1) for less in (0, 1) for piece in (0, 1)])
    return F.when(F.length("form") >= shortest, keys)


def quarter_keys() -> Column:
    """Keys by the quarter left out (``piece``), with ``less`` as in ``piece_key``."""
    entries = [(piece_key(less, piece, 2), less, piece) for less in (0, 1) for piece in range(4)]
    return F.array(*[F.struct(k.alias("key"), F.lit(less).alias("less"), F.lit(piece).alias("piece")) for k, less, piece in entries])


def shared_keys(keyed: DataFrame) -> DataFrame:
    """Keys of ``keyed`` (``key``, ``h1``) that different lines have."""
    return keyed.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low != high").select("key")


def bitmap(keys: DataFrame) -> bytearray:
    """The slots of ``key`` as ``BITS`` bits, whatever their number."""
    slot = F.pmod("key", F.lit(BITS))
    bit = F.call_function("shiftleft", F.lit(1), (slot % 8).cast("int"))
    out = bytearray(BITS // 8)
    for r in keys.groupBy(F.shiftright(slot, 3).cast("int").alias("byte")).agg(F.bit_or(bit).alias("bits")).collect():
        out[r["byte"]] = r["bits"]
    return out


def in_bitmap(bits: bytearray, key: Column) -> Column:
    slot = F.pmod(key, F.lit(BITS))
    byte = F.conv(F.hex(F.substring(F.lit(bits), (F.shiftright(slot, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (slot % 8).cast("int")).bitwiseAND(1) == 1


def candidates(lines: DataFrame, shortest: int) -> tuple[DataFrame, DataFrame]:
    """``h1``, ``h2``, ``place`` (the first), ``form``, ``less``, ``piece``: lines that agree with a different one in all but
    one quarter; and ``h1``, ``h2``, ``place``, ``form`` of these lines and some more, once each."""
    spark = lines.sparkSession
    shared = stage(shared_keys(lines.select("h1", F.explode(half_keys(shortest)).alias("key"))), run_dir(spark, "half-keys"))
    bits = bitmap(shared)
    maybe = lines.select("*", F.explode(half_keys(shortest)).alias("key")).where(in_bitmap(bits, F.col("key")))
    kept = maybe.join(shared, "key").groupBy("h1", "h2").agg(F.min("place").alias("place"), F.first("form").alias("form"))
    quarters = stage(kept.withColumn("k", F.explode(quarter_keys())).select("h1", "h2", "place", "form", "k.*"), run_dir(spark, "quarter-keys"))
    once = quarters.where("less = 0 and piece = 0").select("h1", "h2", "place", "form")
    return quarters.join(shared_keys(quarters), "key").drop("key"), once


def variants(lines: DataFrame) -> DataFrame:
    """Hashed variants of candidates: ``v``, ``role``, ``place``, ``h1``, ``h2``; a row of role 0 is near rows of
    role 0 with its variant, one of role 1 (lost a character) those of role 2 (whole), and the other way round.

    Replacements meet by length, position and both sides; a line that loses a character meets the line that it becomes,
    which stands in for a line longer by one.
    """
    size = F.length("form") - F.col("less")
    bound = lambda k: cut_at(size, F.col("piece") + k, 2)
    ranged = lines.withColumns({"n": F.length("form"), "first": bound(0), "last": F.when(F.col("less") == 0, bound(1) - 1).otherwise(bound(1))})
    at = F.col("cell") * CELL
    over = lambda last: F.explode(F.sequence(F.floor(F.col("first") / CELL).cast("int"), F.floor(last / CELL).cast("int")))
    outer = ranged.where("first <= last").withColumn("cell", over(F.col("last"))).select(
        "h1", "h2", "place", "n", "cell", "first", "last", "less",
        F.xxhash64(F.substring("form", F.lit(1), at)).alias("before"),
        F.substring("form", at + 1, F.lit(CELL)).alias("inside"),
        F.xxhash64(F.substring("form", at + CELL + 1, F.col("n"))).alias("behind"),
    )
    low, high = F.greatest(F.col("first") - at, F.lit(0)), F.least(F.col("last") - at, F.length("inside") - 1)
    lost = outer.withColumn("i", F.explode(F.when(low <= high, F.sequence(low, high)))).withColumn(
        "left", F.concat(F.substring("inside", F.lit(1), F.col("i")), F.substring("inside", F.col("i") + 2, F.lit(CELL)))
    )
    side = ["n", "cell", "before", "left", "behind"]
    met = F.when(F.col("less") == 0, F.xxhash64(F.lit("same"), "i", *side)).otherwise(F.xxhash64(F.lit("less"), *side))
    # A whole line as one longer by one looks after it has lost a character in a given cell.
    whole = ranged.where("less = 0").withColumn("cell", over(F.col("last") + 1))
    inner = F.substring("form", at + 1, F.least(F.lit(CELL), F.col("n") + 1 - at) - 1)
    rest = F.xxhash64(F.substring("form", at + CELL, F.col("n")))
    stands = F.xxhash64(F.lit("less"), F.col("n") + 1, "cell", F.xxhash64(F.substring("form", F.lit(1), at)), inner, rest)
    whole = whole.where(at <= F.col("n")).select(stands.alias("v"), F.lit(2).alias("role"), "place", "h1", "h2")
    return lost.select(met.alias("v"), F.col("less").alias("role"), "place", "h1", "h2").unionByName(whole)


def verified(late: DataFrame, forms: DataFrame) -> DataFrame:
    """``h1``, ``h2`` of those rows of ``late`` (``h1``, ``h2``, ``before``: the place of an earlier line) whose line is within
    one edit of that at ``before``; ``forms`` has both."""
    own = late.join(forms.select("h1", "h2", "form"), ["h1", "h2"])
    both = own.join(forms.select(F.col("place").alias("before"), F.col("form").alias("other")), "before")
    return both.where(F.levenshtein("form", "other", 1) >= 0).select("h1", "h2").distinct()


def kept_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = 1, shortest: int = SHORT) -> DataFrame:
    """Places (``id``, ``twin``, ``line_no``) of the lines that stay, blank ones left aside: the first of equal lines,
    unless an earlier line of the corpus lies within one edit (``edits`` 0: only equal lines). Order is by key, text hash
    and line number. Lines of fewer than ``shortest`` characters are within no edit of others. A line whose variant has the
    hash of an unrelated one is held against the earliest line with that hash, and stays when they differ by more."""
    if edits not in (0, 1):
        raise ValueError("lines are compared at a distance of 0 or 1 only")
    lines = split_lines(docs, key, text)
    equal = lines.groupBy("h1", "h2").agg(F.min("place").alias("place"))
    if not edits:
        return equal.select("place.*")
    near, forms = candidates(lines, shortest)
    met = variants(near)
    first = [F.min(F.when(F.col("role") == role, F.col("place"))).alias(f"first{role}") for role in (0, 1, 2)]
    earliest = met.groupBy("v").agg(*first, F.min("place").alias("low"), F.max("place").alias("high")).where("low < high").drop("low", "high")
    before = F.when(F.col("role") == 0, F.col("first0")).when(F.col("role") == 1, F.col("first2")).otherwise(F.col("first1"))
    late = met.join(earliest, "v").where(before < F.col("place")).select("h1", "h2", before.alias("before")).distinct()
    gone = stage(verified(late, forms), run_dir(docs.sparkSession, "late-lines"))
    return equal.join(gone, ["h1", "h2"], "left_anti").select("place.*")


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = 1, count: str | None = None, shortest: int = SHORT
) -> DataFrame:
    """``docs`` with ``text`` cut down to the lines that stay, in order, joined by line ends; see ``kept_lines``. Texts and
    lines of any length are taken whole.

    A null text stays null, an empty one empty; a document of which no line stays gets an empty text. Rows that agree in
    key and text count as one place, so both keep its lines; a null key comes first in order. Further columns pass through
    and may have any name; ``count`` names one to add, the number of lines that stay. Empty tables stay empty.
    """
    kept = kept_lines(docs, key, text, edits, shortest).groupBy("id", "twin").agg(F.array_sort(F.collect_list("line_no")).alias("kept"))
    rest = [c for c in docs.columns if c != text]
    row = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(0)
    # Split before the join: inside a lambda the text would be split again for each of its lines.
    packed = docs.select(row.alias("row"), F.split(text, "\n").alias("parts"), F.col(key).alias("id"), F.xxhash64(text).alias("twin"))
    joined = packed.join(kept, packed["id"].eqNullSafe(kept["id"]) & (packed["twin"] == kept["twin"]), "left")
    blank = F.filter(F.sequence(F.lit(0), F.size("parts") - 1), lambda i: trimmed(F.element_at("parts", i + 1)) == "")
    stays = F.array_sort(F.concat(F.coalesce("kept", F.array().cast("array<int>")), blank))
    joined = joined.withColumn("stays", F.when(F.col("parts").isNotNull(), stays))
    new = F.array_join(F.transform("stays", lambda i: F.element_at("parts", i + 1)), "\n")
    out = [new.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns]
    if count:
        out.append(F.coalesce(F.size("stays"), F.lit(0)).cast("long").alias(count))
    return joined.select(*out)


SQL = r"""
WITH split AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM documents
), lines AS (
  SELECT doc_id, line_no, nullif(lower(trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12))), '') AS form FROM split
), firsts AS (
  SELECT form, min((doc_id, line_no)) AS place, length(form) AS n FROM lines WHERE form IS NOT NULL GROUP BY form
), halves AS (
  SELECT form, place, n, n - less AS size, left(form, ((n - less) // 2)::BIGINT) AS l, right(form, (n - less - (n - less) // 2)::BIGINT) AS r
  FROM firsts, (VALUES (0), (1)) v(less) WHERE n >= 12
), pairs AS (
  SELECT a.form, b.form AS other FROM halves a JOIN halves b ON a.size = b.size AND a.l = b.l AND b.place < a.place AND abs(a.n - b.n) <= 1
  UNION SELECT a.form, b.form FROM halves a JOIN halves b ON a.size = b.size AND a.r = b.r AND b.place < a.place AND abs(a.n - b.n) <= 1
), gone AS (
  SELECT DISTINCT form FROM pairs WHERE form <> other AND CASE WHEN length(form) = length(other)
    THEN len(list_filter(range(1, length(form) + 1), lambda i: form[i] <> other[i])) = 1
    ELSE levenshtein(form, other) <= 2 AND EXISTS (SELECT 1 FROM (SELECT unnest(range(1, greatest(length(form), length(other)) + 1)) AS i) p
      WHERE CASE WHEN length(form) > length(other) THEN left(form, i - 1) || substr(form, i + 1) = other ELSE left(other, i - 1) || substr(other, i + 1) = form END) END
), kept AS (
  SELECT l.doc_id, l.line_no FROM lines l LEFT JOIN firsts f ON l.form = f.form
  WHERE l.form IS NULL OR (f.place = (l.doc_id, l.line_no) AND l.form NOT IN (SELECT form FROM gone))
), texts AS (
  SELECT s.doc_id, count(*) AS n_kept, string_agg(s.line, chr(10) ORDER BY s.line_no) AS text
  FROM split s JOIN kept k ON s.doc_id = k.doc_id AND s.line_no = k.line_no GROUP BY s.doc_id
)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE len(string_split(d.text, chr(10))) END::BIGINT AS n_lines,
  coalesce(t.n_kept, 0)::BIGINT AS n_kept, CASE WHEN d.text IS NOT NULL THEN coalesce(t.text, '') END AS text
FROM documents d LEFT JOIN texts t ON d.doc_id = t.doc_id
"""


@query("op10_line_dedup", SQL)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that an earlier line of the corpus equals but for one character."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    return dedup_lines(docs.withColumn("n_lines", n_lines), count="n_kept")
