"""Benchmark decontamination (8): template canonicalisation.

Numbers, names and units of a text become typed placeholders, the other words
lower case; the rest is not looked at.  The template's windows of ``WINDOW``
tokens are hash-joined with those of the benchmark items, so a question is
found again with other numbers, names or units in it.  Where a word stands and
its case do not tell names for certain, so each text, document or item, is
looked up three times: with no word as a name, with the capitalised words
inside sentences, and with all capitalised words.

1. *Seeds.*  Documents' windows are looked up at every token: a copy with words
   put in may consist of runs of one window each.  Only documents that share a
   gram with an item are looked at so closely: every window holds one of the
   grams that start at each ``stride`` tokens of the document (see _gram), and
   the items' grams are taken at every token, so no window is lost.
2. *Runs.*  All windows of documents with a seed are joined; windows that follow
   each other on one diagonal (difference of positions) are a run.
3. *Chains.*  A token put in or left out moves the rest of a copy to another
   diagonal, so runs within ``BAND`` diagonals that come in the same order in
   both texts are chained, the longest first.  Where the diagonal changes, the
   windows between two runs count as well, less one for each token left out (if
   these are fewer than a window has).  A chain has to hold ``COVERAGE`` of the
   item's windows; the runs of a single diagonal are a chain as well.
4. *Slots.*  Along a chain, the placeholders' values are compared: a copy
   may rename them, but one to one.  Where one value of the item stands for
   two of the document, or the other way round, it is no copy.  Placeholders
   next to a change of diagonal are not compared.  Where values are changed, at
   least ``MIN_LITERAL_SHARE`` of the tokens must be words; copies with the
   item's own values are found whatever they consist of.

Limits: between two such changes at least ``WINDOW`` tokens must be as in the
item, and a word replaced by another costs the windows around it.  Names that
are other ones and in lower case too cost theirs.  A word in capitals throughout
is not the name or word in other case, except where no name is: a whole copy in
capitals is lost if names break too many of its windows.

Items with fewer than ``WINDOW`` tokens are one window of their own length,
which is looked up at every token.  ``matches`` reports all of them;
``drop_contaminated`` goes by items of ``MIN_TOKENS`` tokens or more, and
``short_items`` lists the others.

Only DataFrame functions are used.  The benchmark's windows are broadcast if
they are ``BROADCAST_WINDOWS`` at most, and merge-joined otherwise.

Defined results: null and empty texts, of documents or items, match nothing;
rows that repeat a doc_id with the same text are one document, with another
text they are judged apart; a null id is an id like others; items that repeat
an item_id are one item if their texts are equal, and judged apart if not.  The
documents' other columns may have any names.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.llm.columns import shielded
from folio.session import scratch_path

WINDOW = 8
COVERAGE = 0.4
BAND = 16
MIN_LITERAL_SHARE = 0.5
BROADCAST_WINDOWS = 1_000_000
#: Answers of a word, as those of multiple choice, are in texts of any kind: no reason to drop a document.
MIN_TOKENS = 2

# Units that are replaced where they follow a number.
UNITS = ("km/h", "m/s", "kwh", "km", "cm", "mm", "kg", "mg", "ml", "mph", "kw", "hz", "ghz", "mhz", "gb", "mb", "kb",
         "tb", "lb", "lbs", "oz", "ft", "in", "mi", "m", "g", "l", "s", "h", "min", "miles", "mile", "meters", "metres",
         "kilometers", "kilometres", "grams", "kilograms", "liters", "litres", "hours", "hour", "minutes", "minute",
         "seconds", "second", "days", "day", "weeks", "week", "months", "month", "years", "year", "dollars", "euros",
         "pounds", "cents", "degrees", "percent", "%", "°", "€", "$", "£")

_NUMBER = r"\p{N}+(?:[.,:/]\p{N}+)*"
_UNIT = (r"(?i)(?<=\p{N}\x20?)(?:" + "|".join(u.replace("$", r"\$") for u in sorted(UNITS, key=len, reverse=True))
         + r")(?![\p{L}\p{N}])")
#: A capitalised word inside a sentence (not one in capitals throughout).
_NAME = r"(?=\p{Lu})(?<=[\p{L}\p{N},;)]\s{1,3})\p{Lu}\p{Ll}[\p{L}\p{M}]*"
#: Of tokens that are not the same in lower case: a capitalised word, and one in capitals throughout.
_CAPITALISED = r"^\p{Lu}\p{Ll}"
_CAPITALS = r"^\p{Lu}{2,}$"
_MARKS = "[\u0001\u0002\u0003]"


def _clean(text: Column) -> Column:
    return F.when(text.rlike(_MARKS), F.regexp_replace(text, _MARKS, " ")).otherwise(text)


def marked_tokens(text: Column) -> Column:
    """Tokens of the template: 0 for numbers, U+0002 for units, words, U+0001 before capitalised ones inside a sentence."""
    out = F.regexp_replace(F.regexp_replace(_clean(text), _UNIT, "\u0002"), _NUMBER, "0")
    out = F.regexp_replace(out, _NAME, "\u0001$0")
    return F.coalesce(F.regexp_extract_all(out, F.lit("\u0001?[\\p{L}\\p{M}]+|[0\u0002]"), F.lit(0)), F.array())


def _plain(token: Column) -> Column:
    """A marked token where no word is a name: lower case, U+0003 before words in capitals throughout."""
    word = F.lower(token)
    return (F.when(token.startswith("\u0001"), F.substr(word, F.lit(2))).when(token == word, token)
            .when(token.rlike(_CAPITALS), F.concat(F.lit("\u0003"), word)).otherwise(word))


def _names_inside(token: Column) -> Column:
    """... with U+0001 for the capitalised words inside a sentence."""
    return F.when(token.startswith("\u0001"), "\u0001").otherwise(F.lower(token))


def _names_anywhere(token: Column) -> Column:
    """... with U+0001 for capitalised words wherever they stand."""
    word = F.lower(token)
    return (F.when(token.startswith("\u0001"), "\u0001").when(token == word, token)
            .when(token.rlike(_CAPITALISED), "\u0001").otherwise(word))


VARIANTS = (_plain, _names_inside, _names_anywhere)


def template_tokens(tokens: str) -> Column:
    """Marked tokens three times: without names, with those inside sentences, with all of them."""
    return F.array(*[F.transform(tokens, variant) for variant in VARIANTS])


def _hashed(variant: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda token: F.xxhash64(variant(token))


def template_hashes(tokens: str) -> Column:
    """The same with a hash for each token."""
    return F.array(*[F.transform(tokens, _hashed(variant)) for variant in VARIANTS])


def slot_tokens(text: Column) -> Column:
    """The same tokens with the values: marked units, numbers and words as they are."""
    out = F.regexp_replace(_clean(text), _UNIT, "\u0002$0\u0003")
    pattern = "\u0002[^\u0003]*\u0003|" + _NUMBER + "|[\\p{L}\\p{M}]+"
    return F.coalesce(F.regexp_extract_all(out, F.lit(pattern), F.lit(0)), F.array())


def _joined(array: Column, offset: int, *more: Column) -> Column:
    """Hashes of each element of an array together with that ``offset`` places on."""
    firsts = F.slice(array, 1, F.greatest(F.size(array) - offset, F.lit(0)))
    return F.transform(firsts, lambda h, i: F.xxhash64(h, F.get(array, i + offset), *more))


def _windows(hashes: str, width: int) -> Column:
    """The variants' arrays of the tokens' hashes as arrays of the hashes of the windows at each token.

    A window is hashed as two halves, which share tokens if its width is no power of two.
    Windows of the variant without names are windows of their own.
    """
    half, out = 1, F.col(hashes)
    while 2 * half < width:
        out = F.transform(out, lambda a: _joined(a, half))
        half *= 2
    return F.transform(out, lambda a, variant: _joined(a, width - half, variant == 0))


def _gram(width: int) -> tuple[int, int]:
    """(stride, size) of the grams: any window of ``width`` tokens holds a whole one of those at each ``stride`` tokens."""
    stride = max(1, width // 2)
    return stride, width - stride + 1


def _grams(hashes: str, width: int, step: int) -> Column:
    """The variants' arrays of the tokens' hashes as arrays of the hashes of the grams at each ``step`` tokens."""
    size = _gram(width)[1]

    def own(array: Column, variant: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(array) - size, F.lit(step))
        return F.when(F.size(array) >= size, F.transform(
            starts, lambda i: F.xxhash64(*[F.get(array, i + k) for k in range(size)], variant == 0)))

    return F.transform(F.col(hashes), own)


def _items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, variants, hashes, width): the items with tokens; item numbers unlike texts apart."""
    return (benchmark.select("item_id", F.xxhash64("text").alias("item"), "text").distinct()
            .select("item_id", "item", "text", marked_tokens(F.col("text")).alias("tokens"))
            .select("item_id", "item", "text", template_tokens("tokens").alias("variants"),
                    template_hashes("tokens").alias("hashes"), F.size("tokens").alias("size"))
            .where(F.col("size") > 0).withColumn("width", F.least(F.lit(WINDOW), F.col("size"))))


def _small(frame: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(frame) if rows <= BROADCAST_WINDOWS else frame.hint("merge")


def _keyed(docs: DataFrame) -> DataFrame:
    """One row for each document: id, a key of its text, and the text."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")


def _different(hashed: DataFrame, arrays: Column) -> DataFrame:
    """(doc_id, text_key, hash): the different hashes in a document's arrays, and a null for one without any.

    For a plain explode Spark filters out empty arrays first, for which it computes
    everything from the text on a second time.
    """
    return hashed.select("doc_id", "text_key", F.explode_outer(F.array_distinct(F.flatten(arrays))).alias("hash"))


def _document_windows(hashed: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_key, hash): the different windows of each document."""
    return _different(hashed, _windows("hashes", width))


def _document_grams(hashed: DataFrame, width: int) -> DataFrame:
    """(doc_id, text_key, hash): the different grams of each document, at each stride."""
    return _different(hashed, _grams("hashes", width, _gram(width)[0]))


def _chains(found: DataFrame, key: list[str]) -> DataFrame:
    """(key, width, chain, n_windows): runs of windows on one diagonal or on several near ones.

    A chain's runs are (first, last, diagonal) by item position, where ``first`` is
    the first token that no earlier run covers and ``last`` the last token.
    """
    line = Window.partitionBy(*key, "diagonal").orderBy("item_pos")
    runs = (found.withColumn("diagonal", F.col("at") - F.col("item_pos")).select(*key, "width", "diagonal", "item_pos").distinct()
            .withColumn("island", F.col("item_pos") - F.row_number().over(line))
            .groupBy(*key, "width", "diagonal", "island")
            .agg(F.min("item_pos").alias("first"), F.max("item_pos").alias("last")))
    run = F.struct((F.col("first") - F.col("last")).alias("by_length"), "first", "last", "diagonal")
    near = Window.partitionBy(*key).orderBy("diagonal").rangeBetween(-BAND, BAND)

    def before(a: Column, b: Column) -> Column:
        return (a["last"] < b["first"]) & (a["last"] + a["diagonal"] < b["first"] + b["diagonal"])

    def longest_first(taken: Column, r: Column) -> Column:
        return F.when(F.forall(taken, lambda t: before(t, r) | before(r, t)), F.concat(taken, F.array(r))).otherwise(taken)

    def in_order(chain: Column) -> Column:
        return F.array_sort(F.transform(chain, lambda r: F.struct(r["first"], r["last"], r["diagonal"])))

    own = F.filter("near", lambda r: r["diagonal"] == F.col("diagonal"))
    several = F.aggregate(F.array_sort("near"), F.array("run"), longest_first)
    chains = (runs.withColumn("run", run).withColumn("near", F.collect_list("run").over(near))
              .select(*key, "width", F.explode(F.array_distinct(F.array(in_order(own), in_order(several)))).alias("chain"))
              .distinct())
    # where the diagonal changes, the windows between two runs count, less the tokens left out
    start = F.struct(F.lit(0).alias("n"), F.lit(-(1 << 30)).alias("last"), F.lit(0).alias("diagonal"),
                     F.expr("CAST(array() AS ARRAY<STRUCT<first: INT, last: INT, diagonal: INT>>)").alias("tokens"))

    def add(acc: Column, r: Column) -> Column:
        between = r["first"] - acc["last"]
        left_out = F.greatest(between - F.col("width"), F.lit(0))
        joint = F.when((left_out < F.col("width")) & (r["diagonal"] != acc["diagonal"]), between - 1 - left_out).otherwise(0)
        return F.struct(
            (acc["n"] + r["last"] - r["first"] + 1 + joint).alias("n"),
            r["last"].alias("last"), r["diagonal"].alias("diagonal"),
            F.concat(acc["tokens"], F.array(F.struct(
                F.greatest(r["first"], acc["last"] + F.col("width")).alias("first"),
                (r["last"] + F.col("width") - 1).alias("last"), r["diagonal"].alias("diagonal")))).alias("tokens"))

    return (chains.withColumn("sum", F.aggregate("chain", start, add))
            .select(*key, "width", F.col("sum.tokens").alias("chain"), F.col("sum.n").cast("long").alias("n_windows")))


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, n_windows, coverage, n_slots, exact) of every copy found."""
    items = _items(benchmark)
    widths = [r["width"] for r in items.select("width").distinct().collect()]  # WINDOW values at most
    item_windows = item_grams = None
    for width in widths:
        own = (items.where(F.col("width") == width)
               .select("item_id", "item", F.explode(_windows("hashes", width)).alias("windows"))
               .select("item_id", "item", F.posexplode("windows").alias("item_pos", "hash"))
               .distinct().withColumn("width", F.lit(width)))
        item_windows = own if item_windows is None else item_windows.union(own)
        own = (items.where(F.col("width") == width)
               .select(F.explode(F.flatten(_grams("hashes", width, 1))).alias("hash"))
               .distinct().withColumn("width", F.lit(width)))
        item_grams = own if item_grams is None else item_grams.union(own)
    if item_windows is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, text_key long, item_id long, n_windows long, coverage double, n_slots long, exact boolean")
    n_hashes = max(item_windows.count(), item_grams.count())
    per_item = items.select("item_id", "item", (F.col("size") - F.col("width") + 1).alias("n_item"))

    keyed = _keyed(docs)

    def hashed(frame: DataFrame) -> DataFrame:
        return (frame.select("doc_id", "text_key", marked_tokens(F.col("text")).alias("tokens"))
                .select("doc_id", "text_key", template_hashes("tokens").alias("hashes")))

    def joined(windows: Callable[[int], DataFrame], items: DataFrame, columns: list[str]) -> DataFrame:
        parts = []
        for width in widths:
            found = windows(width).join(
                _small(items.where(F.col("width") == width).select("hash", *columns).distinct(), n_hashes), "hash")
            parts.append(found.drop("hash"))
        return reduce(DataFrame.union, parts)

    def among(frame: DataFrame, found: DataFrame) -> DataFrame:
        found = found.select(F.col("doc_id").alias("s_id"), F.col("text_key").alias("s_key")).distinct()
        return frame.join(found, F.col("doc_id").eqNullSafe(F.col("s_id")) & F.col("text_key").eqNullSafe(F.col("s_key")), "left_semi")

    def kept(frame: DataFrame) -> DataFrame:
        frame.write.parquet(path := scratch_path(docs.sparkSession, "decontaminate"))
        return docs.sparkSession.read.parquet(path)

    tokened = hashed(keyed)
    near = kept(among(keyed, joined(lambda width: _document_grams(tokened, width), item_grams, []))
                .dropDuplicates(["doc_id", "text_key"]))
    near_tokened = hashed(near)
    seeded = joined(lambda width: _document_windows(near_tokened, width), item_windows, [])
    chosen = kept(among(near, seeded)
                  .select("doc_id", "text_key", marked_tokens(F.col("text")).alias("tokens"), slot_tokens(F.col("text")).alias("values"))
                  .select("doc_id", "text_key", template_hashes("tokens").alias("hashes"),
                          F.get(template_tokens("tokens"), F.lit(2)).alias("names"), "values"))

    def placed(width: int) -> DataFrame:
        return (chosen.select("doc_id", "text_key", F.explode_outer(_windows("hashes", width)).alias("windows"))
                .select("doc_id", "text_key", F.posexplode_outer("windows").alias("at", "hash")))

    key = ["doc_id", "text_key", "item_id", "item"]
    chains = (_chains(joined(placed, item_windows, ["item_id", "item", "item_pos", "width"]), key)
              .join(per_item, ["item_id", "item"])
              .withColumn("coverage", F.col("n_windows") / F.col("n_item"))
              .where(F.col("coverage") >= COVERAGE)
              .withColumn("shifted", F.size(F.array_distinct(F.col("chain.diagonal"))) > 1))
    # the tokens that the matched windows cover, with both sides' values
    covered = F.explode(F.flatten(F.transform("chain", lambda r, i: F.transform(
        F.sequence(r["first"], r["last"]), lambda p: F.struct(
            p.alias("theirs"), (p + r["diagonal"]).alias("mine"),
            (F.col("shifted") & (((p == r["first"]) & (i > 0)) | ((p == r["last"]) & (i < F.size("chain") - 1)))).alias("edge"))))))
    values = items.select("item_id", "item", slot_tokens(F.col("text")).alias("item_values"),
                          F.get("variants", F.lit(1)).alias("item_tokens"), F.get("variants", F.lit(2)).alias("item_names"))
    doc_side = chosen.select(F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key"), "values", "names")
    group = [*key, "chain", "shifted", "n_windows", "coverage"]

    def slot(tokens: str, at: str) -> Column:
        return F.get(tokens, F.col(at)).isin("0", "\u0001", "\u0002") & ~F.col("at.edge")

    # capitalised words may be names on either side; as slots count those inside a sentence, and changed ones
    spots = (chains.join(doc_side, F.col("doc_id").eqNullSafe(F.col("c_id")) & F.col("text_key").eqNullSafe(F.col("c_key")))
             .join(values, ["item_id", "item"])
             .select(*group, "values", "names", "item_values", "item_tokens", "item_names", covered.alias("at"))
             .select(*group, slot("item_tokens", "at.theirs").alias("inside"),
                     (slot("item_names", "at.theirs") | slot("names", "at.mine")).alias("slot"),
                     F.lower(F.get("values", F.col("at.mine"))).alias("mine"),
                     F.lower(F.get("item_values", F.col("at.theirs"))).alias("theirs")))
    share = (spots.withColumn("counts", F.col("inside") | (F.col("slot") & (F.col("mine") != F.col("theirs"))))
             .groupBy(*group, "slot", "theirs", "mine").agg(F.count("*").alias("n"), F.count_if("counts").alias("n_counts")))
    one_way = (share.groupBy(*group)
               .agg(F.sum("n_counts").alias("n_slots"), F.sum("n").alias("n_tokens"),
                    F.count_distinct(F.when(F.col("slot"), F.col("theirs"))).alias("n_theirs"),
                    F.count_distinct(F.when(F.col("slot"), F.col("mine"))).alias("n_mine"),
                    F.count(F.when(F.col("slot"), 1)).alias("n_pairs"),
                    F.count(F.when(F.col("slot") & (F.col("mine") != F.col("theirs")), 1)).alias("n_changed")))
    # one to one: as many pairs of values as values on either side
    copies = one_way.where("n_pairs = n_theirs AND n_pairs = n_mine").where(
        (F.col("n_changed") == 0) | (F.col("n_tokens") - F.col("n_slots") >= MIN_LITERAL_SHARE * F.col("n_tokens")))
    exact = (F.col("n_changed") == 0) & ~F.col("shifted")
    best = F.struct("n_windows", exact, -F.col("n_slots"))
    return (copies.groupBy("doc_id", "text_key", "item_id")
            .agg(F.max("n_windows").alias("n_windows"), F.max("coverage").alias("coverage"),
                 F.max_by("n_slots", best).alias("n_slots"), F.max(exact).alias("exact")))


def short_items(benchmark: DataFrame, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(item_id, text, size): the items with some tokens, but fewer than ``min_tokens``, which drop no document."""
    items = benchmark.select("item_id", "text", F.size(marked_tokens(F.col("text"))).alias("size")).distinct()
    return items.where((F.col("size") > 0) & (F.col("size") < min_tokens))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """The documents that hold no copy of a benchmark item of ``min_tokens`` tokens or more (see short_items)."""
    plain_items, _ = shielded(benchmark, "item_id", "text")
    benchmark = plain_items.where(F.size(marked_tokens(F.col("text"))) >= min_tokens)
    found = matches(docs, benchmark).select(F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key")).distinct()
    plain, restored = shielded(docs, "doc_id", "text")
    same = F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.xxhash64("text") == F.col("m_key"))
    return restored(plain.join(found, same, "left_anti"))
