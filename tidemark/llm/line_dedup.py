"""Line dedup by a segment-partition edit join.

A line within ``k`` edits of another leaves one of the other's ``k + 1`` segments untouched,
so each line is indexed by its segments, and probes, for each shorter length in reach, only
the substrings that can line up with a segment when the edits left and right of it are
counted. What meets is verified by a banded bit-parallel edit distance. DataFrame functions
only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import table, written

#: Characters whose counts are compared before two lines meet; an edit changes two at most, by one each.
COUNTED = "abcdehilmorstun."


def segment(length: Column, i: Column, k: int) -> tuple[Column, Column]:
    """Start (from 0) and size of segment ``i`` of ``k + 1``; the last ones take the remainder."""
    n = k + 1
    more = F.pmod(length, F.lit(n))
    small = ((length - more) / n).cast("int")
    return small * i + F.greatest(F.lit(0), i - n + more), small + (i >= F.lit(n) - more).cast("int")


def probes(k: int) -> list[tuple[int, int, int]]:
    """``(shorter by, segment, shift)``: where a substring of the longer line can match."""
    out = []
    for less in range(k + 1):
        for i in range(k + 1):
            low, high = max(-i, less - (k - i)), min(i, less + (k - i))
            out += [(less, i, shift) for shift in range(low, high + 1)]
    return out


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once, however often ``then`` uses it."""
    return F.transform(F.array(value), then)[0]


def edit_distance(long: Column, short: Column, k: int) -> Column:
    """Edits between two texts, ``short`` at most ``k`` characters shorter than ``long`` and not
    longer: exact up to ``k``, more than ``k`` beyond it. ``long`` has more than ``2 k`` characters.

    Column by column of the table of distances, ``2 k + 1`` bits keep which vertical steps
    around the diagonal rise or fall, the highest bit for the lowest row. While the band moves
    down, the distance follows that row; once it has met the end of ``a``, it follows the
    last row as that climbs through the band.
    """
    return let(F.split(long, ""), lambda a: let(F.split(short, ""), lambda b: _banded(a, b, k)))


def _banded(a: Column, b: Column, k: int) -> Column:
    """``edit_distance`` of two arrays of characters."""
    width = 2 * k + 1
    full = (1 << width) - 1
    met = F.size(a) - k  # from this column on the band holds the last row

    def no(value: Column) -> Column:
        return value.bitwiseXOR(F.lit(full))

    def step(s: Column, j: Column) -> Column:
        up, fall = s["up"], s["fall"]
        same = sum((F.when(F.get(a, j + (k - d)) == F.get(b, j), 1 << (width - 1 - d)).otherwise(0)
                    for d in range(width)), F.lit(0))
        last = F.greatest(F.lit(width - 2) - (j - met), F.lit(0))

        def bit(value: Column) -> Column:
            return F.call_function("shiftright", value, last).bitwiseAND(F.lit(1))

        def result(flat: Column, right: Column, left: Column, below: Column) -> Column:
            moved = F.when(j < met, 1 - F.shiftright(flat, width - 1)).otherwise(bit(right) - bit(left))
            return F.struct(left.bitwiseOR(no(below.bitwiseOR(right))).alias("up"),
                            below.bitwiseAND(right).alias("fall"), (s["d"] + moved).alias("d"))

        return let(same, lambda x: let(
            (x.bitwiseAND(up) + up).bitwiseXOR(up).bitwiseAND(F.lit(full)).bitwiseOR(x).bitwiseOR(fall), lambda flat: let(
                fall.bitwiseOR(no(flat.bitwiseOR(up))),
                lambda right: result(flat, right, flat.bitwiseAND(up), F.shiftright(flat, 1)))))

    begin = F.struct(F.lit(full - (1 << k) + 1).alias("up"), F.lit(0).alias("fall"), F.lit(k).alias("d"))
    return F.aggregate(F.sequence(F.lit(0), F.size(b) - 1), begin, step, lambda s: s["d"])


def count_of(line: Column, letter: str) -> Column:
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))


def letter_counts(line: Column) -> Column:
    """Counts of sixteen characters, modulo 16, in one 64-bit integer."""
    nibbles = [F.shiftleft(F.pmod(count_of(line, c), F.lit(16)).cast("long"), 4 * i) for i, c in enumerate(COUNTED)]
    return reduce(lambda a, b: a.bitwiseOR(b), nibbles)


def count_difference(a: Column, b: Column) -> Column:
    """The summed difference of two ``letter_counts``; no edit changes it by more than 2."""
    def one(i: int) -> Column:
        d = F.abs(F.shiftrightunsigned(a, 4 * i).bitwiseAND(F.lit(15)) - F.shiftrightunsigned(b, 4 * i).bitwiseAND(F.lit(15)))
        return F.least(d, 16 - d)
    return sum((one(i) for i in range(1, len(COUNTED))), one(0))


def keys(units: Column, length: Column, k: int, least: int) -> Column:
    """Hashes of the ``k + 1`` segments of a line, then of the substrings that may meet a segment of a
    line not longer than it; null where that line would have less than ``least`` characters.

    ``units`` is the line in UTF-32, four bytes a character, and ``length`` its characters, both columns
    of their own: a substring is then found without walking over all that is before it.
    """
    where = [(0, i, 0) for i in range(k + 1)] + probes(k)
    places = F.array(*[F.struct(F.lit(less).alias("less"), F.lit(i).alias("i"), F.lit(shift).alias("shift"))
                       for less, i, shift in where])

    def one(p: Column) -> Column:
        size = length - p["less"]
        start, width = segment(size, p["i"], k)
        return F.when(size >= least, F.xxhash64(
            p["i"], size, F.substring(units, (start + p["shift"]) * 4 + 1, width * 4)))

    return F.when(length >= least, F.transform(places, one))


def candidates(lines: DataFrame, k: int) -> DataFrame:
    """Distinct ``a, b``, ``a < b``: identifiers of lines that share a segment in a place where
    ``k`` edits allow it, and whose letter counts ``k`` edits can bring together. ``lines`` has
    ``id, counts, keys``."""
    def keyed(name: str, first: int, n: int) -> DataFrame:
        return lines.select(F.col("id").alias(name), F.col("counts").alias(f"{name}_counts"),
                            F.explode(F.slice("keys", first, n)).alias("key")).where(F.col("key").isNotNull())

    held, asked = keyed("a", 1, k + 1), keyed("b", k + 2, len(probes(k)))
    met = held.join(asked, "key").where((F.col("a") != F.col("b")) & (
        count_difference(F.col("a_counts"), F.col("b_counts")) <= 2 * k))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_repeats(every: DataFrame, lines: DataFrame, k: int, broadcast_rows: int = 500_000) -> DataFrame:
    """``id`` of each line that lies within ``k`` edits of a line that comes before it.

    ``every`` has each line as often as it stands, ``digest, line, place``; ``lines`` each once, with
    ``id, digest, place, counts, keys``. Few lines are candidates, and only their texts are fetched;
    what names them is broadcast if there are at most ``broadcast_rows``, and else joined by a shuffle.
    """
    pairs = written(candidates(lines, k), "line-pairs")
    needed = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "lines-needed")
    few = needed.count() <= broadcast_rows

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    first = written(lines.select("id", "digest", "place").join(small(needed), "id"), "lines-first")
    found = every.join(small(first), ["digest", "place"])
    some = written(found.select("id", F.length("line").alias("size"), "line", "place").dropDuplicates(["id"]), "lines-met")

    def side(name: str) -> DataFrame:
        return some.select(F.col("id").alias(name), F.struct("size", "line", "place", "id").alias(f"{name}_line"))

    both = pairs.join(side("a"), "a").join(side("b"), "b").select(
        F.greatest("a_line", "b_line").alias("long"), F.least("a_line", "b_line").alias("short"))
    near = both.where(edit_distance(F.col("long.line"), F.col("short.line"), k) <= k)
    later = F.struct("long.place", "long.line") > F.struct("short.place", "short.line")
    return near.select(F.when(later, F.col("long.id")).otherwise(F.col("short.id")).alias("id")).distinct()


SPAN = 1 << 31  # more than the lines of any text
LAST = (1 << 63) - 1


def kept_lines(docs: DataFrame, k: int = 2, least: int = 30) -> DataFrame:
    """``doc_key, kept``: numbers (from 0) of the lines of a document that stay, blank ones aside.

    Of equal lines the one in the smallest ``doc_id`` stays, the first one there. A line of
    ``least`` characters or more also goes if a line of as many, within ``k`` edits of it,
    stands before it in that order, whether or not that one stays. Documents none of whose
    lines stay have no row. Rows with one ``doc_id``, or without any (they come last), count
    as versions of one document, and a number kept for one is kept for all.
    """
    numbered = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc_key"), F.posexplode(
        F.split(F.coalesce("text", F.lit("")), "\n")).alias("pos", "line")).where(F.trim("line") != "")
    place = F.col("doc_key").cast("decimal(20,0)") * F.lit(SPAN).cast("decimal(11,0)") + F.col("pos").cast("decimal(10,0)")
    every = numbered.select("line", F.unhex(F.substring(F.sha2("line", 256), 1, 32)).alias("digest"),
                            place.cast("decimal(38,0)").alias("place"))
    # lines are equal if 128 bits of their SHA-256 are; keys and counts move in place of the texts
    counts = F.when(F.col("length") >= least, letter_counts(F.col("line")))
    lines = every.withColumn("units", F.encode("line", "UTF-32")).withColumn(
        "length", F.shiftright(F.octet_length("units"), 2))
    lines = lines.select("digest", "place", counts.alias("counts"), keys(
        F.col("units"), F.col("length"), k, least).alias("keys")).groupBy("digest", "counts", "keys").agg(
            F.min("place").alias("place"))
    lines = written(lines.select(F.monotonically_increasing_id().alias("id"), "*"), "lines")
    gone = written(near_repeats(every, lines, k), "near-lines")
    stay = lines.select("id", "place").join(gone, "id", "left_anti")
    pos = F.pmod(F.col("place"), F.lit(SPAN).cast("decimal(11,0)")).cast("int")
    key = ((F.col("place") - pos) / F.lit(SPAN).cast("decimal(11,0)")).cast("long")
    return stay.select(key.alias("doc_key"), pos.alias("pos")).groupBy("doc_key").agg(
        F.sort_array(F.collect_set("pos")).alias("kept"))


def line_dedup(docs: DataFrame, k: int = 2, least: int = 30) -> DataFrame:
    """``docs`` with ``text`` rebuilt from the lines that ``kept_lines`` keeps and its blank lines,
    plus ``kept``, their numbers, and ``n_lines``.

    All rows and other columns come back; a document whose lines all stand elsewhere has an
    empty text, and so has a null one. ``docs`` has no columns ``kept``, ``n_lines``,
    ``lines``, ``blank`` or ``doc_key``.
    """
    stay = written(kept_lines(docs, k, least), "kept-lines")
    rows = docs.withColumn("doc_key", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))).withColumn(
        "lines", F.split(F.coalesce("text", F.lit("")), "\n"))
    blank = F.filter(F.sequence(F.lit(0), F.size("lines") - 1), lambda i: F.trim(F.get("lines", i)) == "")
    # before the join, so that texts do not take part in it where only the numbers are asked for; one kind of
    # join whatever the size, so that what small tables take on disk tells what large ones do
    rows = rows.withColumn("n_lines", F.size("lines")).withColumn("blank", blank).join(
        stay.hint("merge"), "doc_key", "left")
    some = F.filter(F.coalesce("kept", F.array().cast("array<int>")), lambda i: i < F.col("n_lines"))
    rows = rows.withColumn("kept", F.sort_array(F.concat(some, "blank"))).drop("blank")
    text = F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n")
    return rows.withColumn("text", text).select(*docs.columns, "kept", "n_lines")


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Which lines stay; ``line_dedup`` itself rebuilds the texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select(
        "doc_id", F.col("n_lines").cast("long").alias("n_lines"),
        (F.col("n_lines") - F.size("kept")).cast("long").alias("n_removed"),
        F.array_join(F.col("kept").cast("array<string>"), ",").alias("kept_lines"))


SQL = """
WITH doc AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
     every AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM doc),
     line AS (SELECT line, min(doc_id::HUGEINT * 2147483648 + pos) AS place, length(line) AS size
              FROM every WHERE trim(line) <> '' GROUP BY line),
     cut AS (SELECT * FROM line WHERE size >= 30),
     near AS (SELECT DISTINCT b.line
              FROM cut a JOIN cut b ON a.place < b.place AND abs(a.size - b.size) <= 2
              WHERE levenshtein(a.line[:12], b.line[:12]) <= 4 AND levenshtein(a.line, b.line) <= 2),
     stay AS (SELECT place FROM line WHERE line NOT IN (SELECT line FROM near)),
     kept AS (SELECT doc_id, string_agg(pos::VARCHAR, ',' ORDER BY pos) AS kept_lines, count(*) AS n
              FROM every WHERE trim(line) = '' OR doc_id::HUGEINT * 2147483648 + pos IN (SELECT place FROM stay)
              GROUP BY doc_id)
SELECT doc_id, len(ls) AS n_lines, len(ls) - coalesce(n, 0) AS n_removed, coalesce(kept_lines, '') AS kept_lines
FROM doc LEFT JOIN kept USING (doc_id)
"""
