"""Quality rules by distribution divergence, in column functions only.

A document fails the base rules when it has under ``min_words`` words or when more
than half of its words lie in repeated three-word windows. Beyond that its
character-class and common-word histograms are compared with the references of the
languages, by Jensen-Shannon distance (base 2, 0 to 1): it goes when its smallest
distance to any reference exceeds the threshold.

References are learned from all documents of a language that have enough words. A
language needs ``min_share`` of all those words, so there are at most
``1 / min_share`` references. Documents whose language has none are not compared.

Edge cases: a null text counts as empty and fails the base rules; a null language
is a language of its own; repeated rows are judged each; other columns, whatever
their names, are carried along untouched; no rows give no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise

# Frequent function words of the languages compared, six each.
COMMON_WORDS = {
    "en": "the of and to in is",
    "de": "der die und den das ist",
    "fr": "le la les et des en",
    "es": "el los las y del con",
}
BINS = " ".join(COMMON_WORDS.values()).split()

SPACE, SYMBOL = r"[\x20\x09-\x0D]", r"[#*$%&|<>]"
#: Digits and sentence marks share a class, as a number is nothing odd in a clean text.
MARK = r"[0-9.,;:!?'\"()-]"
#: Character classes in histogram order; lower holds all letters without capitals.
CLASSES = ["lower", "upper", "space", "mark", "symbol", "other"]

MIN_WORDS, MIN_CHARS, MIN_COMMON_WORDS, MIN_SHARE = 50, 200, 100, 0.001
#: Short texts stray further: the first limit is loosened by ``CHAR_SLACK / n_words``.
MAX_CHAR_DISTANCE, CHAR_SLACK, MAX_WORD_DISTANCE = 0.15, 4.0, 0.33


def _removed(text: str, characters: str) -> Column:
    return F.regexp_replace(text, characters + "+", "")


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _repeat_words(windows: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    Equal windows are neighbours once sorted; the sorted places of repeated windows
    then tell how many new words each covers.
    """
    def same(e: Column, i: Column) -> Column:
        return F.coalesce(e["h"] == F.get(windows, i)["h"], F.lit(False))

    places = F.sort_array(F.transform(
        F.filter(windows, lambda e, i: same(e, i - 1) | same(e, i + 1)), lambda e: e["i"]))
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda done, at: F.struct((done["n"] + F.least(F.lit(3), at - done["last"])).alias("n"),
                                  at.alias("last")))
    return covered["n"].cast("long")


def measured(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
             carried: list[str] | None = None) -> DataFrame:
    """``row`` (the input row, or its ``carried`` columns) with counts and histograms."""
    rows = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in carried or docs.columns]).alias("row"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
        F.coalesce(docs[lang_col].cast("string"), F.lit("")).alias("lang"))
    rows = rows.withColumns({
        "words": _words(F.col("text")),
        "lines": F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        # What is left of the text without small letters is short.
        "rest": F.regexp_replace("text", r"[\p{Ll}\p{Lo}\p{M}]+", ""),
    })
    rows = rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "hashes": F.when(F.size("words") >= 3, F.transform(
            F.slice("words", F.lit(1), F.size("words") - 2),
            lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))),
        "common": F.concat(F.lit(" "), F.array_join(F.filter(
            "words", lambda w: w.isin(BINS)), "  "), F.lit(" ")),
    })
    # Most texts repeat no window and need no sorting.
    rows = rows.withColumn("windows", F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"),
        F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    size = F.length("rest")
    upper, space, mark, symbol = (
        size - F.length(_removed("rest", c)) for c in (r"[\p{Lu}\p{Lt}]", SPACE, MARK, SYMBOL))
    rows = rows.withColumns({"upper": upper, "space": space, "mark": mark, "symbol": symbol})
    counts = [F.length("text") - size, "upper", "space", "mark", "symbol",
              F.expr("length(rest) - upper - space - mark - symbol")]
    per_word = [F.expr(f"(length(common) - length(replace(common, ' {w} ', ''))) div {len(w) + 2}")
                for w in BINS]
    listed = F.aggregate(F.array(*per_word), F.lit(0).cast("long"), lambda a, b: a + b)
    rows = rows.select(
        "row", "lang", "n_words",
        (F.length("text") - F.col("space")).cast("long").alias("word_chars"),
        F.col("symbol").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(_repeat_words(F.col("windows")), F.lit(0).cast("long")).alias("n_repeat_words"),
        F.array(*[F.col(c).cast("long") if isinstance(c, str) else c.cast("long") for c in counts]).alias("chars"),
        F.array(*per_word, F.col("n_words") - listed).alias("common"))
    return rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def references(rows: DataFrame) -> list[dict]:
    """Per language with enough text: shares per character class and per common word.

    Junk would widen what counts as usual, so a first reference of all texts only
    chooses the texts, by distance, from which the second is learned.
    """
    light = rows.where(F.col("n_words") >= MIN_WORDS)
    first = _sums(light)
    if not first:
        return []
    usual = light.where((_nearest("chars", first, "chars") <= MAX_CHAR_DISTANCE)
                        & (_nearest("common", first, "common") <= MAX_WORD_DISTANCE))
    return _sums(usual)


def _sums(light: DataFrame) -> list[dict]:
    sums = materialise(light.groupBy("lang").agg(
        F.sum("n_words").alias("words"),
        *[F.sum(F.col("chars")[i]).alias(f"c{i}") for i in range(len(CLASSES))],
        *[F.sum(F.col("common")[i]).alias(f"w{i}") for i in range(len(BINS) + 1)]), "language-sums")
    total = sums.agg(F.sum("words")).first()[0] or 0
    found = sums.where(F.col("words") >= MIN_SHARE * total).orderBy("lang").collect()

    def shares(row, letter, n):
        values = [row[f"{letter}{i}"] for i in range(n)]
        whole = sum(values)
        return [v / whole if whole else 0.0 for v in values]
    return [{"lang": r["lang"], "chars": shares(r, "c", len(CLASSES)),
             "common": shares(r, "w", len(BINS) + 1)} for r in found]


def _distance(shares: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two arrays of shares."""
    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(2 * p / (p + q))).otherwise(F.lit(0.0))
    parts = F.zip_with(shares, reference, lambda p, q: part(p, q) + part(q, p))
    total = F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def _nearest(counts: str, found: list[dict], key: str) -> Column:
    whole = F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b)
    shares = F.transform(counts, lambda n: n / F.greatest(whole, F.lit(1).cast("long")))
    known = F.array(*[F.array(*[F.lit(v) for v in r[key]]) for r in found])
    return F.array_min(F.transform(known, lambda r: _distance(shares, r)))


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
           carried: list[str] | None = None) -> DataFrame:
    """``row`` (see ``measured``), its counts, ``base_failed``, both distances (null where a guard holds
    the comparison back) and ``kept``."""
    rows = measured(docs, text_col, lang_col, carried)
    if carried and text_col not in carried:
        # Small rows are written once and the texts gone through a single time. Whole
        # rows are measured twice instead of copied.
        rows = materialise(rows, "measured")
        found = references(rows)
    else:
        # Filters are not pushed below a generator; pushed into the measures they would
        # repeat them inside one another, and planning would not end.
        rows = rows.select(F.inline(F.array(F.struct(*rows.columns))))
        found = references(materialise(rows.where(F.col("n_words") >= MIN_WORDS).select(
            "lang", "n_words", "chars", "common"), "histograms"))
    if found:
        compared = F.col("lang").isin([r["lang"] for r in found])
        char_distance = F.when(compared & (F.col("word_chars") >= MIN_CHARS),
                               _nearest("chars", found, "chars"))
        word_distance = F.when(compared & (F.col("n_words") >= MIN_COMMON_WORDS),
                               _nearest("common", found, "common"))
    else:
        char_distance = word_distance = F.lit(None).cast("double")
    rows = rows.withColumns({"char_distance": char_distance, "word_distance": word_distance})
    fits = ((F.coalesce("char_distance", F.lit(0.0))
             <= MAX_CHAR_DISTANCE + CHAR_SLACK / F.greatest("n_words", F.lit(1)))
            & (F.coalesce("word_distance", F.lit(0.0)) <= MAX_WORD_DISTANCE))
    return rows.withColumn("kept", ~F.col("base_failed") & fits)


def keep(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns."""
    return judged(docs, text_col, lang_col).where("kept").select("row.*")
