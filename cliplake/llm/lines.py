"""Line dedup by a deletion-neighbourhood join.

Lines are compared in lower case without blanks at the ends. Every later
occurrence of a line goes, and every line for which an earlier line lies within
one edit (insertion, deletion or substitution of a character), whatever its
length. Two lines are within one edit if a line and a deletion variant of the
other are equal, or if both, without the character at the same place, are equal;
so lines emit hashed keys for all their deletion variants and meet on equal keys.
Only the earliest member of a key is compared with the others, so a key with many
lines makes as many pairs as it has lines. The edit distance of each pair is then
verified.

Most lines are alone, and two exact filters spare them the variants. A line
within one edit of another shares with it the first or the last 2^k characters,
the most that fit in half of the shorter one. And both are the same outside one
of up to PARTS equal parts, in which the edit lies: variants are made of that
part only, and the rest goes into the key as it is. Nothing is lost by either;
lines too short for them have one half and one part, of the whole line.

Scale: DataFrame functions only. Shuffled are hashes and positions of all lines,
the text of lines that passed the filter, and the documents once. Sums per key
are combined before each shuffle, and joins against them are plain exchanges
that adaptive execution splits where a key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, keyed, mark, maybe_in, same_row, spread, sweep

#: Most parts of a line; a part has at least PART characters.
PARTS = 16
PART = 8
#: Lines of so many characters or more are looked up by their halves first.
HALVED = 16
_POS = "decimal(34,0)"


def normal(line: Column) -> Column:
    return F.lower(F.btrim(line, F.lit(" \t\x0b\x0c\r")))


def _pos() -> Column:
    """Orders lines by doc_id (null last) and line."""
    doc = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(str(1 << 63)).cast("decimal(20,0)"))
    return (doc * F.lit(1 << 31).cast("decimal(11,0)") + F.col("line")).cast(_POS)


def positions(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, line (number from 0), norm, h, g (two hashes): one row per line that isn't blank."""
    rows = keyed(docs)
    rows = rows.select("doc_id", "row_hash", F.posexplode(F.split("text", "\n", -1)).alias("line", "norm")).withColumn("norm", normal(F.col("norm"))).where("norm <> ''")
    return rows.select("doc_id", "row_hash", "line", "norm", F.xxhash64("norm").alias("h"), F.xxhash64(F.lit(1), "norm").alias("g"))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _wide(norm: Column) -> Column:
    """Four bytes a character, so that parts are found without counting."""
    return F.encode(norm, "UTF-32")


def _slice(wide: Column, begin: Column | int, count: Column) -> Column:
    return F.substring(wide, F.lit(4 * begin + 1) if isinstance(begin, int) else 4 * begin + 1, 4 * count)


def _halves(norm: Column) -> Column:
    """Keys that a line shares with every line within one edit: for m, the shorter length of the pair, the first and the last 2^k <= m / 2 characters."""

    def keys(w: Column) -> Column:
        size = F.floor(F.length(w) / 4).cast("int")
        power = lambda m: F.pow(F.lit(2.0), F.floor(F.log2(F.floor(m / 2).cast("double")) + 1e-9)).cast("int")
        both = lambda n: F.array(F.xxhash64(F.lit(2), n, _slice(w, 0, n)), F.xxhash64(F.lit(3), n, _slice(w, size - n, n)))
        here, less = power(size), power(size - 1)
        return F.when(here == less, both(here)).otherwise(F.concat(both(here), both(less)))

    return F.when(F.length(norm) >= HALVED - 1, _let(_wide(norm), keys))


def _frames(wide: Column) -> Column:
    """(frame, longer, begin, count) of a line of four-byte characters: for m, the shorter length of a pair, and each equal part of m characters, a hash of all before and after the part, and where the part lies.

    A pair within one edit has the same frame where the edit lies in the part.
    longer: this line would be the longer one of the pair."""
    size = F.floor(F.length(wide) / 4).cast("int")

    def part(more: int, i: Column) -> Column:
        m = size - more
        parts = F.greatest(F.lit(1), F.least(F.lit(PARTS), F.floor(m / PART))).cast("int")
        begin, end = F.floor(i * m / parts).cast("int"), F.floor((i + 1) * m / parts).cast("int")
        frame = F.xxhash64(m, i, _slice(wide, 0, begin), _slice(wide, end + more, m - end))
        return F.when(i < parts, F.struct(frame.alias("frame"), F.lit(more == 1).alias("longer"), begin.alias("begin"), (end - begin + more).alias("count")))

    most = F.sequence(F.lit(0), F.least(F.lit(PARTS - 1), F.floor(size / PART).cast("int")))
    every = F.concat(F.transform(most, lambda i: part(0, i)), F.transform(most, lambda i: part(1, i)))
    return F.filter(every, lambda f: f.isNotNull())


def _variants(frame: Column, longer: Column, mid: Column) -> Column:
    """(key, role) of a line in a frame. The shorter line of a pair has role 0, the longer without one character role 1, which meets role 0; lines of equal length without the character at the same place meet in role 2."""
    n = F.floor(F.length(mid) / 4).cast("int")
    rest = lambda i: F.concat(_slice(mid, 0, i - 1), _slice(mid, i, n - i))
    some = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    cut_out = F.transform(some, lambda i: F.struct(F.xxhash64(frame, rest(i)).alias("key"), F.lit(1).alias("role")))
    replaced = F.transform(some, lambda i: F.struct(F.xxhash64(frame, rest(i), i).alias("key"), F.lit(2).alias("role")))
    return F.when(longer, cut_out).otherwise(F.concat(F.array(F.struct(F.xxhash64(frame, mid).alias("key"), F.lit(0).alias("role"))), replaced))


def near(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """h, g of the distinct lines that have an earlier one within one edit. lines: from removed()."""
    halves = lines.where("halves IS NOT NULL").select("h", F.explode("halves").alias("half"))
    shared = cut(halves.groupBy("half").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").select("half"), "halves")
    few = halves.join(shared, "half", "left_semi").select("h").unionByName(lines.where("short").select("h")).distinct()
    few = cut(few.select(F.col("h").alias("few")), "few")
    # the earliest occurrence of each stands for it: its text is read there
    least = lines.join(few, F.col("h") == F.col("few")).groupBy("h", "g").agg(F.min(_pos()).alias("least"))
    least = cut(least.select(F.col("h").alias("of"), F.col("g").alias("og"), "least"), "first")
    text = maybe_in(positions(docs), "h", least, "of")
    left = text.join(least, (F.col("h") == F.col("of")) & (F.col("g") == F.col("og")) & (_pos() == F.col("least")))
    left = cut(spread(left.select("h", "g", F.col("least").alias("pos"), _wide(F.col("norm")).alias("wide")), "h"), "fuzzy")
    frames = cut(left.select("h", F.explode(_frames(F.col("wide"))).alias("f")).select("h", "f.*"), "frames")
    alike = frames.groupBy("frame").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b")
    alike = cut(alike.select(F.col("frame").alias("of")), "alike")
    frames = frames.join(alike, F.col("frame") == F.col("of"), "left_semi").groupBy("h").agg(F.collect_set(F.struct("frame", "longer", "begin", "count")).alias("frames"))
    frames = frames.select(F.col("h").alias("fh"), "frames")  # at most 2 PARTS a line
    parts = left.join(frames, F.col("h") == F.col("fh")).select("h", "pos", "wide", F.explode("frames").alias("f"))
    parts = parts.select("h", "pos", "f.frame", "f.longer", _slice(F.col("wide"), F.col("f.begin"), F.col("f.count")).alias("mid"))
    keys = cut(parts.select("h", "pos", F.explode(_variants(F.col("frame"), F.col("longer"), F.col("mid"))).alias("v")).select("h", "pos", "v.key", "v.role"), "variants")
    first = lambda role: F.min(F.when(F.col("role") == role, F.col("pos"))).alias(f"r{role}")
    met = keys.groupBy("key").agg(first(0), first(1), first(2), F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b")
    met = cut(met.select(F.col("key").alias("k"), "r0", "r1", "r2"), "met")
    other = F.when(F.col("role") == 0, F.col("r1")).when(F.col("role") == 1, F.col("r0")).otherwise(F.col("r2"))
    pairs = keys.join(met, F.col("key") == F.col("k")).withColumn("early", other)
    pairs = pairs.where("early < pos").select(F.col("h").alias("late"), "early").distinct()
    text = left.select("h", "g", "pos", F.decode("wide", "UTF-32").alias("norm"))
    pairs = pairs.join(text.select("h", "g", F.col("norm").alias("late_text")), F.col("late") == F.col("h"))
    pairs = pairs.join(text.select(F.col("pos").alias("p"), F.col("norm").alias("early_text")), F.col("early") == F.col("p"))
    return pairs.where(F.levenshtein("late_text", "early_text", 1) >= 0).select("h", "g").distinct()


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, lines (array of line numbers that go): only documents that lose lines."""
    since = mark()
    lines = cut(positions(docs).select("doc_id", "row_hash", "line", "h", "g", (F.length("norm") < HALVED).alias("short"), _halves(F.col("norm")).alias("halves")), "lines")
    again = lines.groupBy("h", "g").agg(F.min(_pos()).alias("first"), F.max(_pos()).alias("last")).where("first < last").select("h", "g", "first")
    every = near(docs, lines).select("h", "g", F.lit(str(-1 << 100)).cast(_POS).alias("first"))
    out = again.unionByName(every).groupBy("h", "g").agg(F.min("first").alias("first"))
    out = cut(out.select(F.col("h").alias("oh"), F.col("g").alias("og"), "first"), "repeated")
    hit = lines.select("doc_id", "row_hash", "line", "h", "g").join(out, (F.col("h") == F.col("oh")) & (F.col("g") == F.col("og")))
    gone = cut(hit.where(_pos() > F.col("first")).groupBy("doc_id", "row_hash").agg(F.collect_set("line").alias("lines")), "removed")
    sweep(docs.sparkSession, since, gone)
    return gone


def _apply(docs: DataFrame) -> DataFrame:
    """row (struct of all columns of docs), text (what stays of it), lines (sorted numbers of those that go), total (number of lines)."""
    gone = removed(docs)
    key = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    key = key.select("row", F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("row.doc_id").cast("long"), F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("row_hash"))
    got = key.join(gone, same_row(key, gone), "left").select("row", F.coalesce(F.array_sort("lines"), F.array().cast("array<int>")).alias("lines"))
    parts = F.split("row.text", "\n", -1)
    kept = F.array_join(F.filter(parts, lambda x, i: ~F.array_contains("lines", i)), "\n")
    total = F.when(F.col("row.text").isNotNull(), F.size(parts)).otherwise(0)
    return got.select("row", F.when(F.size("lines") > 0, kept).otherwise(F.col("row.text")).alias("text"), "lines", total.alias("total"))


def dedup(docs: DataFrame) -> DataFrame:
    """All columns of docs with text less its repeated lines, and `removed_lines`, `total_lines`.

    The earliest line by (doc_id, line number) stays; null doc_ids come last. A
    blank line is never removed. A null text stays null, an empty one empty;
    neither has lines to lose. Rows that share a doc_id count as one document:
    equal lines at the same line number are the same line. Line breaks are \\n;
    the lines that stay are unchanged. Columns of docs may have any name; of
    those named as the two that are added, the added ones stay. Lines of any length
    are compared whole; an empty table gives no rows."""
    names = [c for c in docs.columns if c not in ("removed_lines", "total_lines")]
    cells = [F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in names]
    return _apply(docs).select(*cells, F.col("lines").alias("removed_lines"), F.col("total").alias("total_lines"))


def keep(docs: DataFrame, size: str = "n_chars") -> DataFrame:
    """docs with its columns and text less its repeated lines; `size`, if it is a column, follows the text.

    A document that loses lines and has no word left goes. The rest is as in dedup()."""
    got = _apply(docs)
    lost = F.size("lines") > 0
    blank = F.trim(F.regexp_replace("text", r"[\t-\r]+", " ")) == ""
    cell = {"text": F.col("text"), size: F.when(lost, F.length("text").cast("long")).otherwise(F.col(f"row.`{size}`"))}
    return got.where(~(lost & blank)).select(*[cell[c].alias(c) if c in cell else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
