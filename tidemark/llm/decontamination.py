"""Benchmark decontamination: questions found in documents, also where their numbers, names or units were changed.

Built from DataFrame functions only. Texts and items become templates: numbers, names (capitalised words within a
sentence) and units after numbers turn into typed placeholders, other words lose punctuation and case. Where a sentence
may start, a capitalised word is read both as a word and as a name, so what is before an item does not matter. Windows of
``window`` template words, taken at every word of every document, meet the items' windows in a hash join. Hits of a document
and an item are lined up by their shift, and the values in the slots are compared without case and
punctuation: a value of the item must stand for one value of the document throughout. Windows with a slot in dispute are left
out, unless all their slots are as in the item. A document is reported with an item if lined-up, consistent windows cover
at least ``least_words`` words, or the whole item if that is shorter.

Windows with fewer than ``literal`` ordinary words would match any table of numbers by their template; they are joined
by their words as they are, without case and punctuation, so they match verbatim only. At least one matched
word must have a letter: items of numbers and signs alone are found nowhere. Items shorter than a window are one window of
their own length.

Texts are first cut into pieces of ``PIECE`` words, which overlap by a window and one word before it, as far as a template looks
back. A piece is only looked at further if it holds an anchor: every key of an item's window has one, two neighbouring words that are
ordinary in the key's reading (or one word, where no two are neighbours), which a document must have as they are to get that key. So
this leaves out no hit; it spares most of the text the templates. There are at most as many anchors as windows of items; they depend
on the benchmark alone and go with the query.

Spark chooses how to join by the size of the items' windows; nothing is broadcast by hint.

Defined cases: a very long text is worked on in pieces like any other; null, empty and blank texts and items match nothing; repeated rows of a document are reported once;
documents of one doc_id with different texts are judged one by one and reported with the best match; a null doc_id
or item_id is kept as it is; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved, texts

WINDOW, LEAST_WORDS, LITERAL, PIECE = 8, 13, 3, 64
# Placeholders, the marks around what may be a name, and the unit words that follow a number.
NUMBER, NAME, UNIT = "\x01", "\x02", "\x03"
OPEN, CLOSE = "\x04", "\x05"
UNITS = (
    "mm|cm|m|km|mi|miles?|ft|feet|inch(?:es)?|yards?|mg|g|kg|lbs?|pounds?|ounces?|tons?|ml|l|lit(?:er|re)s?|gallons?|ms|s|sec(?:onds?)?|"
    "min(?:utes?)?|h|hours?|days?|weeks?|months?|years?|met(?:er|re)s?|grams?|kmh|mph|dollars?|euros?|cents?|percent|degrees?"
)
HITS = "doc_id long, t long, item_id long, item_size int, n int, item_at int, shift int"
_SPACE = "[\\x20\\x09-\\x0D]+"


def one_line(text: Column) -> Column:
    """A text with single blanks between its words."""
    return F.trim(F.regexp_replace(text, _SPACE, " "))


def template(line: Column) -> Column:
    """The words of a line as a template, one for each word between blanks. A capitalised word where a sentence may
    start is a word or a name, and stands between marks. A word depends on the one before it, and on no others."""
    out = F.regexp_replace(line, "(?<=[\\p{L}\\p{N},;]\\x20)\\p{Lu}\\p{Ll}+", NAME)
    out = F.regexp_replace(out, "(?<![\\p{L}\\p{N}\\x02])(\\p{Lu}\\p{Ll}+)", f"{OPEN}$1{CLOSE}")
    out = F.regexp_replace(out, "[0-9]+(?:[.,:/][0-9]+)*", NUMBER)
    mark = "[^\\p{L}\\p{N}\\x02\\x04\\x05\\x20]{0,4}"
    out = F.regexp_replace(out, f"(?i)(\\x01{mark}\\x20?{mark})(?:{UNITS})(?![\\p{{L}}\\p{{N}}])", f"$1{UNIT}")
    return F.lower(F.regexp_replace(out, "[^\\p{L}\\p{N}\\x01-\\x05\\x20]+", ""))


def as_words(marked: Column) -> Column:
    """The reading of a template, or of a word of it, with words where a sentence may start."""
    return F.translate(marked, OPEN + CLOSE, "")


def as_names(marked: Column) -> Column:
    """The reading with names where a sentence may start; it does not depend on what is before a word."""
    return F.regexp_replace(marked, f"{OPEN}[^{CLOSE}]*{CLOSE}", NAME)


def split(line: Column) -> Column:
    return F.split(line, " ", -1)


def is_slot(word: Column) -> Column:
    return word.rlike("[\\x01-\\x03]")


def plain(line: Column) -> Column:
    """The words of a line as they are, without case and punctuation (but for that between two digits), one for each word
    between blanks."""
    out = F.regexp_replace(line, "[^\\p{L}\\p{N}\\x20]+(?![0-9])|(?<![0-9])[^\\p{L}\\p{N}\\x20]+", "")
    return F.split(F.lower(out), " ", -1)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _windows(each: Column, n: int, both: Callable[[Column, Column], Column]) -> Column:
    """For every window of n elements what ``both`` makes of them, from windows of half the size."""

    def ahead(a: Column, b: Column, k: int) -> Column:
        return F.zip_with(a, F.slice(b, F.lit(k + 1), F.size(b)), both)

    def grown(one: Column, k: int) -> Column:
        if k == 1:
            return one
        even = _let(grown(one, k // 2), lambda half: ahead(half, half, k // 2))
        return ahead(even, one, k - 1) if k % 2 else even

    whole = _let(each, lambda one: grown(one, n))
    return F.slice(whole, F.lit(1), F.greatest(F.size(each) - (n - 1), F.lit(0)))


def window_hashes(words: Column, n: int) -> Column:
    """A hash of every window of n words."""
    return _windows(F.transform(words, lambda w: F.xxhash64(w)), n, lambda a, b: F.xxhash64(a, b))


def ordinary_words(words: Column, n: int) -> Column:
    """How many ordinary words are in every window of n words."""
    return _windows(F.transform(words, lambda w: F.when(is_ordinary(w), 1).otherwise(0)), n, lambda a, b: a + b)


def is_ordinary(word: Column) -> Column:
    return ~is_slot(word) & (word != "")


def pieces_of(rows: DataFrame, n: int) -> DataFrame:
    """(doc_id, t, first, before, line): the windows of n words that start in each PIECE words of a text. ``first`` is the place
    of the line's first word, and ``before`` is 1 if that is only there for what it tells of the next one."""
    # strings of PIECE words with a blank behind each word, so a long text is never an array of its words
    cut = F.regexp_extract_all(F.concat(one_line(F.col("text")), F.lit(" ")), F.lit(f"(?:[^ ]+ ){{1,{PIECE}}}"), F.lit(0))
    last = lambda piece: F.substring_index(F.rtrim(piece), " ", -1)
    ahead = lambda piece: F.coalesce(F.substring_index(piece, " ", n - 1), F.lit(""))
    grown = lambda own, p, k: F.rtrim(F.concat(
        F.when(k > 0, F.concat(last(F.get(own, k - 1)), F.lit(" "))).otherwise(""), p, ahead(F.get(own, k + 1))))
    lines = _let(cut, lambda own: F.transform(own, lambda p, k: grown(own, p, k)))
    rows = rows.select("doc_id", F.xxhash64("text").alias("t"), F.posexplode(lines).alias("k", "line"))
    before = F.when(F.col("k") > 0, 1).otherwise(0)
    return rows.select("doc_id", "t", (F.col("k") * PIECE - before).alias("first"), before.alias("before"), "line")


def anchored(pieces: DataFrame, anchors: DataFrame) -> DataFrame:
    """The pieces with an anchor, and their plain words ``e``."""
    known = anchors.select("pair", "anchor").distinct().collect()
    pairs, singles = ([r["anchor"] for r in known if r["pair"] == kind] for kind in (True, False))
    neighbours = lambda e: F.zip_with(e, F.slice(e, F.lit(2), F.size(e)), lambda a, b: F.xxhash64(a, b))
    found = _let(F.col("e"), lambda e: F.exists(neighbours(e), lambda h: h.isin(pairs))) if pairs else F.lit(False)
    if singles:
        found = found | F.exists("e", lambda w: F.xxhash64(w).isin(singles))
    return pieces.withColumn("e", plain(F.col("line"))).filter(found)


def document_keys(pieces: DataFrame, n: int, literal: int) -> DataFrame:
    """(doc_id, t, at, h): the keys of every window of n words of the pieces. The reading with names counts; it gives way
    to the words as they are where it has fewer than ``literal`` ordinary words. The reading with words comes on top."""
    lines = pieces.withColumn("m", template(F.col("line")))
    lines = lines.select("doc_id", "t", "first", "before", split(as_words(F.col("m"))).alias("w"), split(as_names(F.col("m"))).alias("v"), "e")
    hashed = lines.select(
        "doc_id", "t", "first", "before", window_hashes(F.col("w"), n).alias("hw"), window_hashes(F.col("v"), n).alias("hv"),
        ordinary_words(F.col("v"), n).alias("count"), "e",
    )
    few = lambda count: count < min(literal, n)
    hashed = hashed.withColumn("he", F.when(F.exists("count", few), window_hashes(F.col("e"), n)))
    key = lambda i, h: F.struct(i.alias("at"), h.alias("h"))
    # bound outside the lambda, in which it would be worked out for every window
    exact = lambda he: F.transform("hv", lambda h, i: key(i, F.when(few(F.get("count", i)), F.get(he, i)).otherwise(h)))
    names = _let(F.col("he"), exact)
    words = F.filter(F.transform("hw", lambda h, i: F.when(h != F.get("hv", i), key(i, h))), lambda k: k.isNotNull())
    keys = hashed.select("doc_id", "t", "first", "before", F.inline(F.concat(names, words))).filter("at >= before")
    return keys.select("doc_id", "t", (F.col("first") + F.col("at")).alias("at"), "h")


def item_keys(read: DataFrame, n: int, literal: int) -> DataFrame:
    """(item_id, item_size, n, item_at, h, pair, anchor): the keys of the windows of the items of this window size, for each reading
    of a window that has enough ordinary words, and for its words as they are if the one with names has not; and the anchor of each
    key, the longest two neighbouring words that are no slots, or the longest one."""
    rows = read.filter(F.col("n") == n).withColumn("item_at", F.explode(F.sequence(F.lit(0), F.col("item_size") - n)))
    own = lambda c: F.slice(c, F.col("item_at") + 1, F.lit(n))
    rows = rows.select("item_id", "item_size", "n", "item_at", own("m").alias("m"), own("e").alias("e"))
    longer = lambda all_, word: F.transform(all_, lambda one: F.concat(one, F.array(word)))
    readings = F.aggregate(
        "m", F.array(F.array().cast("array<string>")),
        lambda all_, m: F.when(m.contains(OPEN), F.concat(longer(all_, as_words(m)), longer(all_, as_names(m)))).otherwise(longer(all_, m)),
    )
    enough = lambda one: F.size(F.filter(one, is_ordinary)) >= min(literal, n)
    key = lambda words, verbatim: F.struct(words.alias("words"), F.lit(verbatim).alias("verbatim"))
    exact = F.filter(F.array(F.when(~enough(F.element_at("r", -1)), key(F.col("e"), True))), lambda k: k.isNotNull())
    keys = F.concat(F.transform(F.filter("r", enough), lambda words: key(words, False)), exact)
    rows = rows.withColumn("r", readings).select("item_id", "item_size", "n", "item_at", F.inline(keys))
    fixed = lambda w: (F.length(w) > 0) & (~is_slot(w) | F.col("verbatim"))
    both = F.zip_with("words", F.slice("words", F.lit(2), F.lit(n)), lambda a, b: F.when(
        fixed(a) & fixed(b), F.struct((F.length(a) + F.length(b)).alias("size"), F.xxhash64(a, b).alias("hash"))))
    one = F.transform("words", lambda w: F.when(fixed(w) | F.col("verbatim"), F.struct(F.length(w).alias("size"), F.xxhash64(w).alias("hash"))))
    rows = rows.withColumn("both", F.array_max(F.array_compact(both))).withColumn("one", F.array_max(F.array_compact(one)))
    return rows.select(
        "item_id", "item_size", "n", "item_at", F.get(window_hashes(F.col("words"), n), F.lit(0)).alias("h"),
        F.col("both").isNotNull().alias("pair"), F.coalesce("both", "one")["hash"].alias("anchor"),
    )


def cover(places: str, n: Column) -> Column:
    """How many words windows of n words at the sorted places cover."""
    to_next = F.zip_with(places, F.slice(places, F.lit(2), F.size(places)), lambda p, q: F.least(n, q - p))  # least skips null
    return F.aggregate(to_next, F.lit(0), lambda a, b: a + b)


def judged_slots(lined: DataFrame, window: int) -> DataFrame:
    """Alignments with the places whose windows are consistent, the item's words ``inside`` them and the ``pairs`` of
    values in their slots. A value is in dispute if it stands for several values; windows that hold a slot of such a
    value go, but for windows without any changed slot. What may be a name is a word where it is as in the item, and always in
    an item shorter than a window: 'What is the capital?' is not 'Paris is the capital.'"""
    n, shift = F.col("n"), F.col("shift")
    holds = lambda p, i: (p <= i) & (i < p + n)
    inside = F.filter(F.sequence(F.lit(0), F.col("item_size") - 1), lambda i: F.exists("places", lambda p: holds(p, i)))
    there = lambda i: F.get("dw", i + shift - F.greatest(shift, F.lit(0)))  # noqa: E731 dw begins where the item does, or the text
    value = lambda i: F.struct(F.get("iw", i).alias("asked"), there(i).alias("found"))
    slots = F.filter("inside", lambda i: F.get("im", i).rlike("[\\x01-\\x04]"))
    pairs = F.array_distinct(F.transform("at", value))
    asked = F.array_distinct(F.transform("pairs", lambda p: p["asked"]))
    disputed = F.filter(asked, lambda v: F.size(F.filter("pairs", lambda p: p["asked"] == v)) > 1)
    differs = lambda i: F.get("iw", i) != there(i)
    maybe = lambda i: F.get("im", i).contains(OPEN)
    changed = F.filter("at", differs)
    in_dispute = lambda i, values: F.array_contains(values, F.get("iw", i)) & (differs(i) | ~maybe(i))
    renamed = lambda i: differs(i) & maybe(i) & (F.col("item_size") < window)
    doubtful = _let(disputed, lambda values: F.filter("at", lambda i: in_dispute(i, values) | renamed(i)))
    any_in = lambda p, places: F.exists(places, lambda i: holds(p, i))
    kept = _let(changed, lambda c: _let(doubtful, lambda d: F.filter("places", lambda p: ~(any_in(p, c) & any_in(p, d)))))
    out = lined.withColumn("inside", inside).withColumn("at", slots).withColumn("pairs", pairs).withColumn("places", kept)
    at = F.filter(slots, lambda i: differs(i) | ~maybe(i))
    return out.withColumn("inside", inside).withColumn("at", at).withColumn("pairs", pairs)


def contaminated(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, least_words: int = LEAST_WORDS, literal: int = LITERAL,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, item_words, matched_words, slots, changed_slots) of each document that holds an item."""
    named = items.select(items[item_col].alias("item_id"), items[item_text_col].cast("string").alias("item_text")).distinct()
    line = one_line(F.col("item_text"))
    read = named.withColumns({"m": split(template(line)), "e": plain(line)})
    read = read.filter(F.exists("e", lambda w: w.rlike("\\p{L}")))
    read = saved(read.select("item_id", F.size("m").alias("item_size"), F.least(F.size("m"), F.lit(window)).alias("n"), "m", "e"), "item-words")
    sizes = sorted(r[0] for r in read.select("n").distinct().collect())  # window sizes, at most ``window``
    rows = texts(docs, id_col, text_col).filter("text is not null")
    hits = None
    for n in sizes:
        own = saved(item_keys(read, n, literal), "item-keys")
        probed = document_keys(anchored(pieces_of(rows, n), own), n, literal)
        found = probed.join(own.drop("pair", "anchor"), "h").select("doc_id", "t", "item_id", "item_size", "n", "item_at", (F.col("at") - F.col("item_at")).alias("shift"))
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = docs.sparkSession.createDataFrame([], HITS)
    # One row for each alignment; the places in an item are no more than its words.
    lined = hits.groupBy("doc_id", "t", "item_id", "item_size", "n", "shift").agg(F.sort_array(F.collect_set("item_at")).alias("places"))
    lined = saved(lined.filter(cover("places", F.col("n")) >= F.least(F.lit(least_words), F.col("item_size"))), "lined-up")
    raw = rows.select(F.col("doc_id").alias("raw_id"), F.xxhash64("text").alias("raw_t"), "text")
    same = F.col("raw_id").eqNullSafe(F.col("doc_id")) & (F.col("raw_t") == F.col("t"))
    raw = raw.join(lined.select("doc_id", "t").distinct(), same, "left_semi").distinct()
    both = lined.join(raw, same)
    asked = named.select(F.col("item_id").alias("named_id"), "item_text")
    both = both.join(asked, F.col("item_id").eqNullSafe(F.col("named_id")))
    both = both.withColumns({
        "dw": F.slice(plain(one_line(F.col("text"))), F.greatest("shift", F.lit(0)) + 1, F.col("item_size")), "iw": plain(line), "im": split(template(line)),
    })
    # Written, so filters are not pushed below and the columns not worked out once more for them.
    both = saved(judged_slots(both, window).select("doc_id", "item_id", "item_size", "n", "places", "inside", "pairs", "iw"), "judged")
    both = both.filter(cover("places", F.col("n")) >= F.least(F.lit(least_words), F.col("item_size")))
    # windows of numbers alone are a table of numbers
    judged = both.filter(F.exists("inside", lambda i: F.get("iw", i).rlike("\\p{L}")))
    changed = F.size(F.filter("pairs", lambda p: p["asked"] != p["found"]))
    best = judged.groupBy("doc_id", "item_id").agg(
        F.max(F.struct(F.size("inside").alias("matched_words"), "item_size", F.size("pairs").alias("slots"), (-changed).alias("changed"))).alias("b")
    )
    return best.select(
        "doc_id", "item_id", F.col("b.item_size").alias("item_words"), "b.matched_words", "b.slots", (-F.col("b.changed")).alias("changed_slots")
    )


def op4_decontamination(spark, sf: str) -> DataFrame:
    """Every document that holds a benchmark item, and which."""
    return contaminated(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))
