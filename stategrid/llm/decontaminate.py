"""Benchmark decontamination by template canonicalisation.

Texts become sequences of template tokens: numbers, units after a number and
names (capitalised words inside a sentence, each word of a name by itself, also
with capitals inside or after an opening quote or bracket) are replaced by
typed placeholders; a number keeps its thousands and decimals. Other words that begin with a capital or a letter beyond ASCII
are lower-cased, punctuation goes. Windows of
``window`` template tokens are hash-joined with the windows of the benchmark
items that hold at least ``literals`` literal tokens. A second form of items
and texts, folded to one case, has names as words: copies in another case
match there. Items and windows below ``literals`` match by their exact tokens
in that form, numbers and units with their values. Matched windows of one alignment are then held against the slots: in a window an
item's value must stand for one value of the document, and a value that the
document keeps in one place and changes in another is not the same question
with other values, so windows that touch it go; equal values that are all
changed may be parameters of their own. A document leaks an item if the
windows left cover at least ``least`` of the item's windows.

Rules: null texts are empty. An item shorter than ``window`` is
one window of all its tokens. Items of fewer than ``shortest`` words and numbers
(one word tells no question from a text that uses it) never match. Rows
that repeat an item_id are windows of one item. A row is a document; leaks are
told by doc_id, so rows that share an id share the verdict. Empty tables give
an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stategrid.llm.common import key128, let
from stategrid.session import materialize

#: Units that may follow a number.
UNITS = ["mm", "cm", "m", "km", "in", "ft", "yd", "mi", "mg", "g", "kg", "t", "oz", "lb", "lbs",
         "ml", "l", "s", "sec", "min", "h", "hr", "hrs", "day", "days", "week", "weeks", "month",
         "months", "year", "years", "hour", "hours", "minute", "minutes", "second", "seconds",
         "meter", "meters", "mile", "miles", "gram", "grams", "liter", "liters", "dollar",
         "dollars", "euro", "euros", "cent", "cents", "percent", "degree", "degrees", "k", "c", "f",
         "w", "kw", "v", "a", "hz", "khz", "mhz", "ghz", "b", "kb", "mb", "gb", "tb"]
#: Placeholders begin with this character; n number, u unit, p name.
MARK = "\x01"
_NAME = r"(?=\p{Lu})(?<=[^.!?:\s]\s[\"'“‘«(\[]{0,2})(\p{Lu}\p{Ll}+(?:\p{Lu}\p{Ll}+)*)(?!\p{L})"
_NUMBER = r"[0-9]+(?:,[0-9]{3}(?![0-9])|\.[0-9]+)*"
_UNIT = rf"([0-9{MARK}]*)\s*((?i:" + "|".join(sorted(UNITS, key=lambda x: (-len(x), x))) + r"))(?!\p{L})"
_CUT = r"[^\p{L}\p{M}\p{N}\x01]+"
#: Windows of the benchmark up to which they are broadcast (64 MB at most); beyond, a shuffled join.
MAX_BROADCAST = 1_000_000


def tokens(text: Column, values: bool, names: bool = True) -> Column:
    """The words and numbers of a text, typed ones as placeholders; with
    ``values`` a placeholder is followed by what it stands for. Without
    ``names`` the text is folded to lower case and names are words."""
    c = F.replace(F.coalesce(text, F.lit("")), F.lit(MARK), F.lit(" "))
    if names:
        c = F.regexp_replace(c, _NAME, f"{MARK}p" + ("$1" if values else ""))
    else:
        c = F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))      # as it stands in capitals
    if values:              # the value is one token: thousands together, a mark for the point
        c = F.regexp_replace(c, r"(?<=[0-9]),(?=[0-9]{3}(?![0-9]))", "")
        c = F.regexp_replace(c, r"(?<=[0-9])\.(?=[0-9])", MARK)
        c = F.regexp_replace(c, f"([0-9]+(?:{MARK}[0-9]+)*)", f" {MARK}n$1")
    else:
        c = F.regexp_replace(c, _NUMBER, f" {MARK}n")
    c = F.regexp_replace(c, f"{MARK}n" + _UNIT, f"{MARK}n$1 {MARK}u" + ("$2" if values else ""))
    return F.array_remove(F.split(c, _CUT, -1), "")


def bare(tk: Column) -> Column:
    """Tokens with values as tokens without."""
    return F.transform(tk, lambda t: F.when(F.startswith(t, F.lit(MARK)), F.substring(t, 1, 2))
                       .otherwise(t))


def token_hashes(tk: Column) -> Column:
    def one(t):
        first = F.substring(t, 1, 1)
        return F.xxhash64(F.when(first.between("a", "z"), t).otherwise(F.lower(t)))
    return F.transform(tk, one)


def window_hashes(th: Column, size: int) -> Column:
    """The hash of every ``size`` neighbouring token hashes, from hashes of 1,
    2, 4 ... neighbours."""
    def joined(a, b, gap):          # of the a-window at i and the b-window at i + gap
        return F.zip_with(a, F.slice(b, gap + 1, F.greatest(F.size(b), F.lit(1))),
                          lambda x, y: F.xxhash64(x, y))

    def build(done, have, power, width, rest):
        if rest & 1:
            done, have = (power if done is None else joined(done, power, have)), have + width
        if rest >> 1:
            return let(joined(power, power, width),
                       lambda p: build(done, have, p, 2 * width, rest >> 1))
        return F.slice(done, 1, F.greatest(F.size(th) - (size - 1), F.lit(0)))
    return build(None, 0, th, 1, size)


#: Forms of a window: names as placeholders, names as words, and the exact tokens.
NAMED, WORDS, EXACT = 0, 1, 2


def windows(tk: Column, form: int, sizes: list[int]) -> Column:
    """array<struct<form, size, hs>>: of each of ``sizes`` the hashes of all
    windows of so many tokens, in order."""
    return let(token_hashes(tk), lambda th: F.array(*[
        F.struct(F.lit(form).alias("form"), F.lit(s).alias("size"),
                 window_hashes(th, s).alias("hs")) for s in sizes]))


def all_windows(text: Column, sizes: dict[int, list[int]]) -> Column:
    """The windows of a text in every form that has sizes."""
    named, words, exact = (sizes.get(f, []) for f in (NAMED, WORDS, EXACT))
    parts = [windows(tokens(text, False), NAMED, named)] if named else []
    if exact:
        parts.append(let(tokens(text, True, False), lambda v: F.concat(
            *([windows(bare(v), WORDS, words)] if words else []), windows(v, EXACT, exact))))
    elif words:
        parts.append(windows(tokens(text, False, False), WORDS, words))
    return F.concat(*parts)


def one_to_one(slots: Column) -> Column:
    """Whether every item value among slots (place, item, doc) has one document value."""
    pairs = F.transform(slots, lambda s: F.struct(s["item"], s["doc"]))
    return F.size(F.array_distinct(pairs)) == F.size(F.array_distinct(slots["item"]))


def consistent(ats: Column, slots: Column, size: Column) -> Column:
    """The windows (their starts) of an alignment that hold no item value with
    two document values and none that the document keeps in one place and
    changes in another."""
    torn = F.array_distinct(F.transform(F.filter(slots, lambda s: (s["item"] == s["doc"]) & F.exists(
        slots, lambda o: (o["item"] == s["item"]) & (o["doc"] != s["item"]))), lambda s: s["item"]))

    def fits(at: Column, torn: Column) -> Column:
        inside = F.filter(slots, lambda s: (s["place"] >= at) & (s["place"] < at + size))
        return let(inside, lambda w: one_to_one(w) & ~F.arrays_overlap(w["item"], torn))
    return let(torn, lambda t: F.filter(ats, lambda at: fits(at, t)))


def leaks(docs: DataFrame, benchmark: DataFrame, window: int = 8, literals: int = 4,
          least: float = 0.5, shortest: int = 2) -> DataFrame:
    """(doc_id, item_id, n_windows, n_matched): the documents that hold an
    item, a row for each such document id and item."""
    return (leaking_rows(docs, benchmark, window, literals, least, shortest).groupBy("doc_id", "item_id")
            .agg(F.max("n_windows").cast("long").alias("n_windows"),
                 F.max("n_matched").cast("long").alias("n_matched")))


def leaking_rows(docs: DataFrame, benchmark: DataFrame, window: int = 8, literals: int = 4,
                 least: float = 0.5, shortest: int = 2) -> DataFrame:
    """(doc_id, t1, t2, item_id, item_row, n_windows, n_matched): the different
    rows, told by id and 128-bit text key, that hold an item."""
    own_items = benchmark.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    # an item also stands inside sentences, where its first word looks like a name
    def tokenised(inside: bool, values: bool) -> Column:
        if not inside:
            return tokens(F.col("text"), values)
        return let(tokens(F.concat(F.lit("a "), "text"), values),
                   lambda t: F.slice(t, 2, F.greatest(F.size(t) - 1, F.lit(0))))
    kinds = [F.struct(F.lit(i).alias("kind"), F.lit(NAMED).alias("own_form"),
                      tokenised(i == 1, False).alias("tpl"),
                      tokenised(i == 1, True).alias("item_values")) for i in (0, 1)]
    # and in another case, where names do not show
    kinds.append(F.struct(F.lit(2).alias("kind"), F.lit(WORDS).alias("own_form"),
                          tokens(F.col("text"), False, False).alias("tpl"),
                          tokens(F.col("text"), True, False).alias("item_values")))
    both = own_items.select("item_id", F.explode(F.array(*kinds)).alias("x"), "text")
    items = materialize(both.select(
        "item_id", F.xxhash64("item_id", "text", "x.kind").alias("item_row"), "x.own_form", "x.tpl",
        "x.item_values", F.least(F.lit(window), F.size("x.tpl")).alias("size"))
        .where((F.col("size") >= 1) & (F.size("tpl") >= shortest)), "items")
    own_sizes = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most ``window``
    # windows with too few literals match as they are, with their values
    part = F.slice("tpl", F.col("item_at") + 1, F.col("size"))
    few = F.size(F.filter(part, lambda t: ~F.startswith(t, F.lit(MARK)))) < literals
    form = F.when(~few, F.col("own_form")).when(F.col("own_form") == WORDS, F.lit(EXACT))
    both_forms = F.concat(windows(F.col("tpl"), 0, own_sizes or [window]),
                          windows(F.col("item_values"), EXACT, own_sizes or [window]))
    flat = materialize(
        items.select("item_id", "item_row", "own_form", "tpl", F.col("size").alias("own_size"),
                     F.inline(both_forms))
        .where(F.col("size") == F.col("own_size"))
        .select("item_id", "item_row", "own_form", F.col("form").alias("hashed"), "tpl", "size",
                F.posexplode("hs").alias("item_at", "h"))
        .withColumn("form", form)
        .where((F.col("hashed") == EXACT) == (F.col("form") == EXACT))   # null: not usable
        .drop("tpl", "own_form", "hashed"), "windows")
    sizes = {f: [] for f in (NAMED, WORDS, EXACT)}
    for r in sorted(flat.select("form", "size").distinct().collect()):   # at most 3 x ``window``
        sizes[r["form"]].append(r["size"])
    n = flat.count()
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    t1, t2 = key128(F.coalesce("text", F.lit("")))
    found = own.select("doc_id", t1.alias("t1"), t2.alias("t2"),
                       F.inline(all_windows(F.col("text"), sizes if n else {NAMED: [window]}))
                       ).select("doc_id", "t1", "t2", "form", "size",
                                F.posexplode("hs").alias("at", "h"))
    small = n <= MAX_BROADCAST
    hits = materialize(
        found.join(F.broadcast(flat) if small else flat, ["form", "size", "h"])
        .withColumn("shift", F.col("at") - F.col("item_at"))
        .groupBy("doc_id", "t1", "t2", "item_id", "item_row", "size", "shift")
        .agg(F.array_sort(F.collect_set("item_at")).alias("ats")), "hits")
    # the values in the slots, of the different texts that have a match
    texts = hits.groupBy("t1", "t2").agg(F.min("doc_id").alias("rep"))
    raw = (own.select("doc_id", "text", t1.alias("t1"), t2.alias("t2"))
           .join(texts, ["t1", "t2"]).where(F.col("doc_id").eqNullSafe(F.col("rep")))
           .groupBy(F.col("t1").alias("x1"), F.col("t2").alias("x2"))
           .agg(F.max("text").alias("raw"))
           .select("x1", "x2", tokens(F.col("raw"), True).alias("named_values"),
                   tokens(F.col("raw"), True, False).alias("word_values")))
    told = items.select(F.col("item_row").alias("r"), "own_form", "item_values")
    total = flat.groupBy("item_row").agg(F.count("*").alias("n_windows")).withColumnRenamed(
        "item_row", "w")
    full = (hits.join(raw, (F.col("t1") == F.col("x1")) & (F.col("t2") == F.col("x2")))
            .join(F.broadcast(told) if small else told, F.col("item_row") == F.col("r"))
            .join(F.broadcast(total) if small else total, F.col("item_row") == F.col("w"))
            .withColumn("values", F.when(F.col("own_form") == NAMED, F.col("named_values"))
                        .otherwise(F.col("word_values"))))
    places = F.array_distinct(F.flatten(F.transform("ats", lambda a: F.sequence(
        a, a + F.col("size") - 1))))
    slots = F.filter(F.transform(places, lambda p: F.struct(
        p.alias("place"), F.element_at("item_values", p + 1).alias("item"),
        F.element_at("values", p + F.col("shift") + 1).alias("doc"))),
        lambda s: F.startswith(s["item"], F.lit(MARK)))
    good = (full.withColumn("ats", let(slots, lambda s: F.when(one_to_one(s), F.col("ats"))
                                       .otherwise(consistent(F.col("ats"), s, F.col("size")))))
            .where(F.size("ats") > 0))
    return (good.groupBy("doc_id", "t1", "t2", "item_id", "item_row")
            .agg(F.size(F.array_distinct(F.flatten(F.collect_set("ats")))).alias("n_matched"),
                 F.max("n_windows").alias("n_windows"))
            .where(F.col("n_matched") >= least * F.col("n_windows")))
