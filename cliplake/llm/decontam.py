"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, units after numbers and capitalised names turn
into typed slots, the rest into lower-case words without punctuation. Windows of
WINDOW template words are hashed and joined with those of the benchmark. For
each occurrence of an item in a document the values that the slots hold on both
sides must map consistently, as they do when a question is asked again with other
numbers or names; windows with the item's own values count whatever else the
document holds. Items without a window of enough plain words are looked for whole,
with their own values. DataFrame functions only.

Scale: a window with a match holds its anchor, three neighbouring plain words (a
pair where no three stand together); one pass over the words looks them up among
the anchors (broadcast if counted to be few, else joined by hash), and only
documents with an anchor, a few in a hundred, become templates. Text is not
shuffled unless those are many. Items of equal text are one item until the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, keyed, mark, maybe_in, same_row, sweep, text_of

WINDOW = 8
#: Words in a window that must not be slots.
PLAIN = 5
#: Distinct windows of an item (all if it has fewer) that make a document contaminated.
HITS = 4
#: Share of the slot values of an item that must map to one value in the document, if any differs.
CONSISTENT = 0.8
#: Unit words that count as a slot after a number.
UNITS = ("km", "m", "cm", "mm", "kg", "g", "mg", "lb", "lbs", "oz", "l", "ml", "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "mile", "miles", "feet", "foot", "inch", "inches", "metre", "metres", "meter", "meters", "gram", "grams", "litre", "litres", "liter", "liters", "dollar", "dollars", "euro", "euros", "cent", "cents", "percent", "usd", "eur", "mph")


#: Signs that part words; those in NUMERIC stay between digits.
SIGNS = "\n\t\r\x0b\x0c;!?\"'()[]{}*#$%&+|<>=\\~^_`-–—…“”‘’«»€£¿¡\x01\x02"
NUMERIC = ".,:/"
#: Up to so many anchors, of eight bytes, are broadcast.
ANCHORS = 1_000_000


def template(rows: DataFrame) -> DataFrame:
    """Turns `text` into `words`: plain ones, or \x01, a letter for the type (n number, u unit, c name) and the value.

    A number begins with a digit or has a sign between digits; a unit stands
    after a number and is in UNITS; a name has a capital and a small letter and
    does not begin a sentence. Plain words have no signs and are in lower case."""
    t = F.regexp_replace("text", r"(?<=[.!?][\"')\]]{0,2}\s{1,3})(?=\p{Lu})", "\x03")
    t = F.regexp_replace(F.translate(t, SIGNS, " " * len(SIGNS)), r"(?<![0-9])[.,:/]|[.,:/](?![0-9])", " ")
    rows = rows.withColumn("raw", F.split(t, " ")).withColumn("raw", F.filter("raw", lambda w: ~w.isin("", "\x03")))

    def word(w: Column, i: Column) -> Column:
        number = (w >= "0") & (w < ":") | w.rlike("[0-9][.,:/]")
        before = F.coalesce(F.get("raw", i - 1), F.lit(""))
        unit = (before >= "0") & (before < ":") & w.isin(*UNITS)
        plain = F.ltrim(F.lower(w), F.lit("\x03"))
        return F.when(number, F.concat(F.lit("\x01n"), w)).when(unit, F.concat(F.lit("\x01u"), w)).when((plain == w) | (F.upper(w) == w) | w.startswith("\x03") | (i == 0), plain).otherwise(F.concat(F.lit("\x01c"), plain))

    return rows.withColumn("words", F.transform("raw", word)).drop("raw", "text")


def _anchor(words: Column, plain) -> Column:
    """struct(width, anchor): the three neighbours for which plain() holds, with most characters; else two; else one."""
    n = F.size(words)

    def best(width: int) -> Column:
        group = lambda i: [F.get(words, i + k) for k in range(width)]
        size = lambda i: sum((F.length(w) for w in group(i)), F.lit(0))
        ok = lambda i: F.forall(F.array(*group(i)), plain)
        at = F.when(n >= width, F.filter(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))), ok))
        found = F.array_max(F.transform(at, lambda i: F.struct(size(i).alias("n"), F.xxhash64(*group(i)).alias("anchor"))))
        return F.when(found.isNotNull(), F.struct(F.lit(width).alias("width"), found["anchor"].alias("anchor")))

    return F.coalesce(best(3), best(2), best(1))


def _items(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(item_id, text) of one item for each text, and (item_id, alias) of all items."""
    every = benchmark.where("item_id IS NOT NULL").select(F.col("item_id").cast("long").alias("alias"), text_of(benchmark).alias("text"))
    every = every.select("alias", "text", F.sha2("text", 256).alias("of"))
    one = every.groupBy("of").agg(F.min("alias").alias("item_id"))
    items = every.join(one, "of")
    return items.where("alias = item_id").select("item_id", "text").distinct(), items.select("item_id", "alias").distinct()


def codes(words: Column) -> Column:
    """A number per word: a hash of at least 0, or below 0 the type of a slot."""
    kind = lambda w: F.when(w.startswith("\x01n"), -1).when(w.startswith("\x01c"), -2).otherwise(-3)
    return F.transform(words, lambda w: F.when(w < "\x02", kind(w).cast("long")).otherwise(F.xxhash64(w).bitwiseAND(F.lit((1 << 63) - 1))))


def _bench(items: DataFrame, window: int, plain: int) -> DataFrame:
    """A row per window of an item: k (its hash), width and anchor, item_id, item_place, item_windows, item_words.

    Plain neighbours exist where more than half of the words are plain."""
    rows = template(items)
    rows = rows.where(F.size("words") >= window).select("item_id", "words", F.explode(F.sequence(F.lit(0), F.size("words") - window)).alias("item_place"))
    rows = rows.withColumn("item_words", F.slice("words", F.col("item_place") + 1, F.lit(window))).drop("words")
    rows = rows.withColumn("code", codes(F.col("item_words"))).where(F.size(F.filter("code", lambda c: c >= 0)) >= plain)
    rows = rows.withColumn("a", _anchor(F.col("item_words"), lambda w: w >= "\x02")).withColumn("item_windows", F.count("*").over(W.partitionBy("item_id")))
    return rows.select(F.xxhash64("code").alias("k"), "a.width", "a.anchor", "item_id", "item_place", "item_windows", "item_words")


def _bare(words: Column) -> Column:
    """The words in lower case without types: alike wherever a sentence begins."""
    return F.transform(words, lambda w: F.lower(F.regexp_replace(w, "^\x01.|\x03", "")))


def _whole(items: DataFrame, window: int, plain: int) -> DataFrame:
    """A row per item without a usable window: whole (hash of its words), n (their number), width and anchor, item_id. Signs in numbers part the words of an anchor."""
    rows = template(items).where(F.size("words") > 0)
    few = lambda i: F.size(F.filter(F.slice("codes", i + 1, F.lit(window)), lambda c: c >= 0)) < plain
    places = F.sequence(F.lit(0), F.greatest(F.size("codes") - window, F.lit(0)))
    rows = rows.withColumn("codes", codes(F.col("words"))).where((F.size("codes") < window) | F.forall(places, few))
    rows = rows.select("item_id", _bare(F.col("words")).alias("bare"))
    tokens = F.filter(F.split(F.translate(F.array_join("bare", " "), NUMERIC, " " * len(NUMERIC)), " "), lambda w: w != "")
    rows = rows.withColumn("a", _anchor(tokens, lambda w: w != ""))
    return rows.select(F.xxhash64("bare").alias("whole"), F.size("bare").alias("n"), "a.width", "a.anchor", "item_id")


def candidates(docs: DataFrame, bench: DataFrame, most: int = ANCHORS) -> DataFrame:
    """doc_id, row_hash of the documents in which an anchor of `bench` (width, anchor) occurs; all that hold a window do.

    If bench has n, so has the result."""
    keys = [c for c in ("n",) if c in bench.columns]
    widths = sorted(r[0] for r in bench.select("width").distinct().collect()) or [3]  # 1, 2, 3
    anchors = bench.select("anchor", *keys).distinct()
    few = anchors.limit(most + 1).count() <= most
    rows = keyed(docs)
    signs = SIGNS + NUMERIC
    raw = rows.select("doc_id", "row_hash", F.split(F.regexp_replace(F.translate(F.lower("text"), signs, " " * len(signs)), "  +", " "), " ").alias("raw"))
    shifted = [F.col("raw") if k == 0 else F.slice("raw", F.lit(k + 1), F.size("raw")) for k in range(widths[-1])]
    near = raw.select("doc_id", "row_hash", F.explode(F.arrays_zip(*[c.alias(f"w{k}") for k, c in enumerate(shifted)])).alias("p"))
    hashes = [F.xxhash64(*[F.col(f"p.w{k}") for k in range(width)]) for width in widths]
    if len(hashes) == 1:
        near = near.select("doc_id", "row_hash", hashes[0].alias("of"))
    else:
        near = near.select("doc_id", "row_hash", F.explode(F.array(*hashes)).alias("of"))
    if few:
        anchors = F.broadcast(anchors)
    else:  # words that are in no anchor stay where they are
        near = maybe_in(near, "of", anchors, "anchor")
    met = near.join(anchors, F.col("of") == F.col("anchor"), "inner" if keys else "left_semi")
    return met.select("doc_id", "row_hash", *keys).distinct()


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, plain: int = PLAIN, anchors: int = ANCHORS) -> DataFrame:
    """doc_id, row_hash, item_id, part, windows (distinct places of the item that match), item_windows, same_slots, slots (values of the item in matched windows), mapped (those with one value in the part).

    Parts of a document are the whole, the windows with the item's own values, and
    occurrences: windows at one shift against the item, and at shifts less than a
    window apart in order, as values of more or fewer words move what follows.

    plain must be more than half of window. Only documents with an anchor are
    turned into templates."""
    if 2 * plain <= window:
        raise ValueError("more than half of a window's words must be plain")
    bench = cut(_bench(items, window, plain), "bench")
    whole = cut(_whole(items, window, plain), "whole")
    short = bool(whole.limit(1).count())
    if short:
        both = bench.select("width", "anchor", F.lit(None).cast("int").alias("n")).union(whole.select("width", "anchor", "n"))
        some = candidates(docs, both, anchors).groupBy("doc_id", "row_hash").agg(F.collect_set("n").alias("lengths"))
    else:
        some = candidates(docs, bench, anchors)
    some = cut(some.withColumnsRenamed({"doc_id": "d", "row_hash": "r"}), "candidates")
    rows = maybe_in(keyed(docs), "row_hash", some, "r")
    rows = rows.join(some, rows["doc_id"].eqNullSafe(some["d"]) & (rows["row_hash"] == some["r"])).drop("d", "r")  # some is distinct; a semi join would be moved below the bitmap
    rows = template(rows.dropDuplicates(["doc_id", "row_hash"]))
    texts = cut(rows.withColumn("bare", _bare(F.col("words"))) if short else rows, "templates")
    rows = texts.where(F.size("words") >= window).select("doc_id", "row_hash", codes(F.col("words")).alias("codes"))
    every = F.transform(F.sequence(F.lit(0), F.size("codes") - window), lambda i: F.struct(i.alias("place"), F.xxhash64(F.slice("codes", i + 1, F.lit(window))).alias("key")))
    found = rows.select("doc_id", "row_hash", F.explode(every).alias("w")).select("doc_id", "row_hash", "w.place", "w.key")
    hits = found.join(bench.select("k").distinct(), F.col("key") == F.col("k")).groupBy("doc_id", "row_hash").agg(F.collect_list(F.struct("place", "key")).alias("hits"))
    hits = cut(hits.withColumnsRenamed({"doc_id": "d", "row_hash": "r"}), "hits")  # at most the windows of a document
    rows = texts.join(hits, texts["doc_id"].eqNullSafe(hits["d"]) & (texts["row_hash"] == hits["r"]))
    values = F.transform("hits", lambda w: F.struct(w["place"].alias("place"), w["key"].alias("key"), F.slice("words", w["place"] + 1, F.lit(window)).alias("doc_words")))
    met = rows.select("doc_id", "row_hash", F.explode(values).alias("w")).select("doc_id", "row_hash", "w.*").join(bench.drop("width", "anchor"), F.col("key") == F.col("k"))
    pair = F.arrays_zip(F.col("item_words").alias("a"), F.col("doc_words").alias("b"))
    value = F.filter(pair, lambda p: p["a"] < "\x02")
    met = met.select("doc_id", "row_hash", "item_id", "item_place", "item_windows", (F.col("place") - F.col("item_place")).alias("shift"), value.alias("slots")).distinct()
    item = ["doc_id", "row_hash", "item_id"]
    by_shift = W.partitionBy(*item).orderBy("shift")
    met = met.withColumn("jump", (F.col("shift") - F.lag("shift").over(by_shift) >= window).cast("int"))
    met = met.withColumn("near", F.coalesce(F.sum("jump").over(by_shift), F.lit(0)))
    name = lambda kind, n: F.struct(F.lit(kind).alias("kind"), n.cast("long").alias("n"))
    parts = [name("whole", F.lit(0)), name("shift", F.col("shift")), name("near", F.col("near"))]
    own = F.forall("slots", lambda p: p["a"] == p["b"])
    met = met.withColumn("part", F.explode(F.when(own, F.array(*parts, name("own", F.lit(0)))).otherwise(F.array(*parts))))
    met = cut(met.drop("shift", "jump", "near"), "met")
    item.append("part")
    sums = met.groupBy(*item, "item_place").agg(F.first("item_windows").alias("item_windows"))
    sums = sums.groupBy(*item).agg(F.count("*").alias("windows"), F.first("item_windows").alias("item_windows"))
    held = met.select(*item, F.explode("slots").alias("s")).groupBy(*item, "s.a").agg(F.min("s.b").alias("least"), F.max("s.b").alias("most"))
    same = (F.col("least") == F.col("a")) & (F.col("most") == F.col("a"))
    held = held.groupBy(*item).agg(F.count("*").alias("slots"), F.count_if(F.col("least") == F.col("most")).alias("mapped"), F.count_if(same).alias("same_slots"))
    out = sums.alias("x").join(held.alias("y"), F.expr("x.doc_id <=> y.doc_id AND x.row_hash = y.row_hash AND x.item_id = y.item_id AND x.part = y.part"), "left")
    out = out.select("x.*", *[F.coalesce(f"y.{c}", F.lit(0)).alias(c) for c in ("slots", "mapped", "same_slots")])
    if not short:
        return out
    fit = F.filter("lengths", lambda n: n <= F.size("bare"))
    every = F.flatten(F.transform(fit, lambda n: F.transform(F.sequence(F.lit(0), F.size("bare") - n), lambda i: F.xxhash64(F.slice("bare", i + 1, n)))))
    found = texts.select("doc_id", "row_hash", F.explode(F.array_distinct(every)).alias("key")).join(whole.select("whole", "item_id"), F.col("key") == F.col("whole"))
    found = found.select("doc_id", "row_hash", "item_id", name("whole", F.lit(0)).alias("part")).distinct()
    return out.unionByName(found.withColumns({"windows": F.lit(1), "item_windows": F.lit(1), "slots": F.lit(0), "mapped": F.lit(0), "same_slots": F.lit(0)}))


def contaminated(docs: DataFrame, benchmark: DataFrame, hits: int = HITS, consistent: float = CONSISTENT) -> DataFrame:
    """doc_id, row_hash, items (ids), reparameterised, best (largest share of an item's windows): only contaminated documents.

    An item counts if in a part of the document `hits` of its windows (all if it
    has fewer) match and either all its slot values are the item's own or at least the share
    `consistent` of them maps to one value each."""
    items, aliases = _items(benchmark)
    got = matches(docs, cut(items, "items"))
    # windows without slots say nothing of an occurrence whose slots do not map
    fine = (F.col("slots") > 0) | F.col("part.kind").isin("whole", "near")
    fine &= (F.col("same_slots") == F.col("slots")) | (F.col("mapped") >= consistent * F.col("slots"))
    got = got.where((F.col("windows") >= F.least(F.lit(hits), F.col("item_windows"))) & fine)
    got = got.join(aliases, "item_id")
    return got.groupBy("doc_id", "row_hash").agg(F.array_sort(F.collect_set("alias")).alias("items"), F.bool_or(F.col("same_slots") < F.col("slots")).alias("reparameterised"), F.max(F.col("windows") / F.col("item_windows")).alias("best"))


def check(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, items (ids joined by commas), n_items, reparameterised, best: one row per row of docs.

    Null and empty texts, on either side, match nothing; items of fewer than WINDOW
    template words, or of too few plain ones, match only as they are; an empty benchmark or one with null ids leaves all
    clean. Repeated rows get the same verdict; other columns are not read. Texts of
    any length are read whole; an empty table gives no rows."""
    since, rows = mark(), keyed(docs).drop("text")
    bad = cut(contaminated(docs, benchmark), "contaminated")
    sweep(docs.sparkSession, since, bad)
    got = rows.join(bad, same_row(rows, bad), "left").drop(bad["doc_id"]).drop(bad["row_hash"])
    items = F.coalesce("items", F.array().cast("array<bigint>"))
    return got.select("doc_id", F.col("items").isNotNull().alias("contaminated"), F.array_join(F.transform(items, lambda x: x.cast("string")), ",").alias("items"), F.size(items).alias("n_items"), F.coalesce("reparameterised", F.lit(False)).alias("reparameterised"), F.coalesce("best", F.lit(0.0)).alias("best"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that are not contaminated."""
    since = mark()
    bad = cut(contaminated(docs, benchmark).select("doc_id", "row_hash"), "contaminated")
    sweep(docs.sparkSession, since, bad)
    key = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    key = key.select("row", F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("row.doc_id").cast("long"), F.coalesce(F.col("row.text").cast("string"), F.lit(""))).alias("row_hash"))
    return key.join(bad, same_row(key, bad), "left_anti").select("row.*")
