"""Operator 8, quality rules: distribution divergence from language references (DataFrame functions only).

Every document is described by two histograms, one of character classes and one of the common words of its
language.  The references are the mean histograms of all documents of a language: of character classes for every
language of the table (the ``Limits.languages`` with the most documents, one bounded aggregate), of common words for
the four languages whose words are listed.  A document whose Jensen-Shannon distance to the reference exceeds a limit
is rejected; a document too short for a histogram is not judged by it.

Defined results: null or empty text has no words and fails the base rule; a document of null language is held against
the nearest reference of characters, and of words if that one's language has them; a language without a reference is judged by the base rules alone, one without listed words by
its characters; without any reference (empty table) only the base rules decide; repeated rows are judged alike, row by
row.  Other columns of the input are carried along untouched, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Common function words of the four languages, in natural order.
COMMON_WORDS = {
    "en": "the of and to in is that it for was on are as with be at".split(),
    "fr": "de la le et les des un une que en du pour qui dans par sur".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im nicht".split(),
    "es": "de la que el en y a los del se las por un para con no".split(),
}
# Character classes as Java regular expression classes; what is in none of them is the last bin.
CHAR_CLASSES = {
    "lower": "a-z",
    "upper": "A-Z",
    "digit": "0-9",
    "space": r"\x20\x09-\x0D",
    "mark": r".,;:!?'\"()\-",
    "symbol": "#*$%&|<>",
}
SYMBOLS = "#*$%&|<>"
SPACE = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Limits:
    """Limits of the verdict; distances are square roots of the Jensen-Shannon divergence in bits (0 to 1)."""

    min_words: int = 10          # base rule
    max_repeat_percent: int = 20  # base rule
    chars_guard: int = 200       # characters a document needs before its character histogram counts
    words_guard: int = 50        # words a document needs before its common-word histogram counts
    max_char_distance: float = 0.35
    max_word_distance: float = 0.45
    max_distance_sum: float = 0.47
    languages: int = 200         # references at most; further languages are judged by the base rules alone


def _packed(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Every input column inside ``row`` (no name can clash), the text, its language, words and leftovers.

    ``rest`` is the text without lower-case letters, ``tight`` that without white space: the smaller classes are
    counted on what is left instead of on the whole text again.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    split = docs.select(
        F.struct(*columns).alias("row"), F.col(f"`{lang}`").alias("lang"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    ).select(
        "row", "lang", "text",
        F.expr(rf"filter(split(text, '{_sql(SPACE)}'), w -> w != '')").alias("words"),
        F.regexp_replace("text", f"[{CHAR_CLASSES['lower']}]+", "").alias("rest"))
    return split.withColumn("tight", F.regexp_replace("rest", SPACE, ""))


def _sql(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _counted(packed: DataFrame, *keep: str) -> DataFrame:
    """``keep`` plus numbers of words and characters and the bins of the character histogram."""
    def of(name: str, source: str) -> Column:
        return F.length(F.regexp_replace(source, f"[^{CHAR_CLASSES[name]}]+", ""))

    named = packed.select(
        *keep, "words", F.size("words").cast("long").alias("n_words"), F.length("text").alias("n_chars"),
        (F.length("text") - F.length("rest")).alias("lower"), (F.length("rest") - F.length("tight")).alias("space"),
        *[of(c, "tight").alias(c) for c in ("upper", "digit", "mark", "symbol")])
    names = list(CHAR_CLASSES)
    other = F.col("n_chars") - sum((F.col(c) for c in names[1:]), F.col(names[0]))
    return named.select(*keep, "words", "n_words", "n_chars", "space", "symbol",
                        F.array(*names, other).alias("char_bins"))


def _word_bins(lang: str) -> str:
    """SQL for the occurrences of each common word of ``lang`` as listed, the last bin holding all other words."""
    listed = ", ".join(f"'{w}'" for w in COMMON_WORDS[lang])
    return (f"transform(array(filter(words, w -> w in ({listed}))), found -> "
            f"concat(transform(array({listed}), c -> size(filter(found, x -> x = c))), "
            f"array(size(words) - size(found))))[0]")


def _numbers(reference: list[float]) -> str:
    return f"array({', '.join(f'{x!r}D' for x in reference)})"


def _distance(bins: str, total: str, reference: list[float] | str) -> str:
    """SQL for the square root of the Jensen-Shannon divergence (bits) of a histogram from a reference."""
    ref = reference if isinstance(reference, str) else _numbers(reference)
    term = (f"if(n > 0, n / {total} * log2(2 * n / {total} / (n / {total} + q)), 0D) / 2"
            f" + if(q > 0, q * log2(2 * q / (n / {total} + q)), 0D) / 2")
    return (f"transform(array({bins}), b -> sqrt(greatest(0D, aggregate(zip_with(b, {ref}, (n, q) -> {term}), "
            f"0D, (a, x) -> a + x))))[0]")


def references(docs: DataFrame, lang: str = "lang", text: str = "text", limits: Limits = Limits()) -> dict:
    """Mean character and common-word histograms of all documents of each language: {lang: (chars, words or None)}.

    One aggregate over the whole table; at most ``limits.languages`` rows of 25 numbers come to the driver.
    """
    rows = _counted(_packed(docs, text, lang).where(F.col("lang").isNotNull()), "lang")
    n_char, n_word = len(CHAR_CLASSES) + 1, 1 + len(COMMON_WORDS["en"])
    bins = "case lang " + " ".join(f"when '{k}' then {_word_bins(k)}" for k in COMMON_WORDS) + " end"
    rows = (rows.where((F.col("n_words") >= limits.words_guard) & (F.col("n_chars") >= limits.chars_guard))
            .select("lang", "n_chars", "n_words", "char_bins", F.expr(bins).alias("word_bins")))
    means = rows.groupBy("lang").agg(
        F.count("*").alias("n"), *[F.avg(F.col("char_bins")[i] / F.col("n_chars")).alias(f"c{i}") for i in range(n_char)],
        *[F.avg(F.col("word_bins")[i] / F.col("n_words")).alias(f"w{i}") for i in range(n_word)])
    means = means.orderBy(F.desc("n"), "lang").limit(limits.languages).collect()
    return {r["lang"]: ([r[f"c{i}"] for i in range(n_char)],
                        [r[f"w{i}"] for i in range(n_word)] if r["lang"] in COMMON_WORDS else None)
            for r in sorted(means, key=lambda r: r["lang"])}


# Words inside five-word windows that occur at least twice.  Without a repeated window hash the answer is 0;
# otherwise windows are sorted by hash, those equal to a neighbour give their positions, and every position covers
# its words up to the next covered position.  `transform(array(x), v -> ...)[0]` evaluates x once.
_REPEATED_WORDS = """
case when size(windows) = 0 or size(array_distinct(windows)) = size(windows) then 0L else
  transform(array(sort_array(transform(windows, (h, i) -> struct(h as h, i as p)))), s ->
    transform(array(sort_array(transform(
        filter(s, (x, i) -> (i > 0 and s[i - 1].h = x.h) or (i + 1 < size(s) and s[i + 1].h = x.h)),
        x -> x.p))), p ->
      aggregate(transform(p, (v, i) -> case when i + 1 < size(p) then least(5, p[i + 1] - v) else 5 end),
                0L, (a, x) -> a + x))[0])[0]
end"""


def judged(docs: DataFrame, refs: dict, lang: str = "lang", text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """Row, base counts, distances (null where a guard holds), ``base_failed`` and ``kept`` of every document."""
    lines = F.expr(rf"filter(split(text, '\n'), l -> l rlike '{_sql(r'[^\x20\x09-\x0D]')}')")
    windows = F.expr("""case when size(words) >= 5 then transform(sequence(0, size(words) - 5), i ->
                          xxhash64(words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4]))
                        else array() end""")
    counted = _counted(_packed(docs, text, lang).withColumn("lines", lines).withColumn("windows", windows),
                       "row", "lang", "lines", "windows")
    char_d = word_d = "cast(null as double)"
    if refs:
        every = "map(" + ", ".join(f"'{_sql(k)}', {_numbers(c)}" for k, (c, _) in refs.items()) + ")"
        # of a null language: the nearest one, and its words only if that one has listed words
        near = (f"array_min(transform(map_entries({every}), r -> struct("
                f"{_distance('char_bins', 'n_chars', 'r.value')} as d, r.key as lang)))")
        char_d = f"if(lang is null, {near}.d, {_distance('char_bins', 'n_chars', f'element_at({every}, lang)')})"
        word_of = {k: _distance(_word_bins(k), "n_words", w) for k, (_, w) in refs.items() if w}
        if word_of:
            word_d = ("case " + " ".join(f"when lang = '{k}' then {e}" for k, e in word_of.items())
                      + f" when lang is null and {near}.lang in ({', '.join(repr(k) for k in word_of)})"
                      + f" then array_min(array({', '.join(word_of.values())})) end")
    out = counted.select(
        "row", "n_words", (F.col("n_chars") - F.col("space")).cast("long").alias("word_chars"),
        F.col("symbol").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(_REPEATED_WORDS).alias("n_repeat_words"),
        F.expr(f"case when n_chars >= {limits.chars_guard} then {char_d} end").alias("char_distance"),
        F.expr(f"case when n_words >= {limits.words_guard} then {word_d} end").alias("word_distance"))
    out = out.withColumn("base_failed", (F.col("n_words") < limits.min_words)
                         | (100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed")
                          & (F.coalesce(F.col("char_distance"), F.lit(0.0)) <= limits.max_char_distance)
                          & (F.coalesce(F.col("word_distance"), F.lit(0.0)) <= limits.max_word_distance)
                          & (F.coalesce(F.col("char_distance") + F.col("word_distance"), F.lit(0.0))
                             <= limits.max_distance_sum))


def quality_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The operator: references from all documents, then the verdict of each."""
    return judged(docs, references(docs, limits=limits), limits=limits)


def quality_filter(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The documents that pass, with their own columns.

    The rows leave through an outer generator: the optimizer would push any plain filter below the measuring and
    evaluate it there once more, for every use of every intermediate column.
    """
    passed = F.expr("if(kept, array(struct(true as passed, row)), array())")
    return (quality_rules(docs, limits).select(passed.alias("out")).select(F.inline_outer("out"))
            .where("passed").select("row.*"))
