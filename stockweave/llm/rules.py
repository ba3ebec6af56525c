"""Quality rules: counts per document, and its divergence from its language.

Built-in expressions only. Everything about one document is computed inside its
row, without exploding words, so no text is shuffled and a hot source or a very
long text stays where it was read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import SPACE
from stockweave.session import materialize

MIN_WORDS = 20
MAX_REPEAT_PCT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
# Jensen-Shannon distances (base 2, 0 to 1) beyond which a document is rejected,
# and the least words (for common words: common words found) to judge it by them.
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.65
MIN_JUDGED_WORDS = 50
MIN_COMMON_WORDS = 20
# Histogram shares are summed as integers of this unit: exact in any order.
UNIT = 1_000_000_000

# Frequent function words by language.
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "en": "the of and to in a is that for it as was with be by on not he his this",
    "es": "de la que el en y a los se del las un por con no una su para es al",
    "fr": "de la le et les des en un du une que est pour qui dans par sur au il ne",
}

# Character classes, each removed from what the ones before it left.
CLASSES = (
    ("lower", r"\p{Ll}+"),
    ("space", rf"[{SPACE}]+"),
    ("upper", r"\p{Lu}+"),
    ("digit", r"\p{Nd}+"),
    ("point", r"[.,;:?'\"()’-]+"),
)


def _with_repeated_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words covered by windows whose hash occurs again.

    ``windows`` has the hash of every window. Each step that a later one reads
    twice is a column of its own, NULL for texts without a repeated window.
    """
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("placed", F.when(repeats, F.array_sort(placed)))
    none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    pairs = F.zip_with(
        F.concat("placed", none),
        F.concat(none, "placed"),
        lambda a, b: F.struct(
            a["i"].alias("i"), F.coalesce(a["h"] == b["h"], F.lit(False)).alias("same")
        ),
    )  # element k: window k, whether it equals window k - 1; one more at the end
    df = df.withColumn("pairs", pairs)
    marked = F.zip_with(
        "pairs",
        F.slice("pairs", 2, F.size("pairs")),
        lambda a, b: F.when(a["same"] | F.coalesce(b["same"], F.lit(False)), a["i"]),
    )
    df = df.withColumn("starts", F.array_sort(F.filter(marked, lambda i: i.isNotNull())))
    steps = F.zip_with(
        "starts",
        F.slice("starts", 2, F.size("starts")),
        lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda acc, x: acc + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop(
        "windows", "placed", "pairs", "starts"
    )


def counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The id of every row of ``docs``, with its counts and histograms.

    A NULL text counts as empty. ``lang_key`` is the language if it has a list
    of common words, else ``other``.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    lang = F.col(f"`{lang_col}`")
    blanks = F.lit(" \t\n\x0b\x0c\r")
    parts = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        text.alias("text"),
        F.btrim(text, blanks).alias("inner"),
        F.when(lang.isin(*COMMON_WORDS), lang).otherwise(F.lit("other")).alias("lang_key"),
    )
    parts = parts.withColumns(
        {
            "words": F.when(F.col("inner") != "", F.split("inner", f"[{SPACE}]+")).otherwise(
                F.array().cast("array<string>")
            ),
            "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(f"[^{SPACE}]")),
            "left0": F.col("text"),
        }
    )
    # What is left of the text after each class; a column of its own each, read twice.
    for k, (_, pattern) in enumerate(CLASSES):
        parts = parts.withColumn(f"left{k + 1}", F.regexp_replace(f"left{k}", pattern, ""))
    sizes = [F.char_length(f"left{k}").cast("long") for k in range(len(CLASSES) + 1)]
    n = F.size("words")
    windows = F.when(
        n > WINDOW,
        F.transform(
            F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))
        ),
    ).otherwise(F.array().cast("array<long>"))
    rest = f"left{len(CLASSES)}"
    parts = parts.withColumns(
        {
            "windows": windows,
            "line": F.lower(F.concat(F.lit(" "), F.array_join("words", "  "), F.lit(" "))),
            "classes": F.array(*[a - b for a, b in zip(sizes, sizes[1:])], sizes[-1]),
            "n_symbols": (
                F.char_length(rest) - F.char_length(F.translate(rest, SYMBOLS, ""))
            ).cast("long"),
        }
    )
    parts = _with_repeated_words(parts)
    lists = F.create_map(
        *[x for k, v in COMMON_WORDS.items() for x in (F.lit(k), F.lit(v.split()))]
    )
    line = F.col("line")

    def occurrences(word: Column) -> Column:
        spaced = F.concat(F.lit(" "), word, F.lit(" "))
        without = F.replace(line, spaced, F.lit(""))
        return (
            (F.octet_length(line) - F.octet_length(without)) / F.octet_length(spaced)
        ).cast("long")

    common = F.transform(lists[F.col("lang_key")], occurrences)
    space = [name for name, _ in CLASSES].index("space")
    return parts.select(
        "id",
        "lang_key",
        n.cast("long").alias("n_words"),
        (F.char_length("text") - F.get("classes", F.lit(space))).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        "classes",
        F.coalesce(common, F.array().cast("array<long>")).alias("common"),
    )


def _total(counted: Column) -> Column:
    return F.aggregate(counted, F.lit(0).cast("long"), lambda acc, x: acc + x)


def _shares(counted: str, total: str) -> Column:
    """The histogram as integers of 1 / ``UNIT``; zeros for an empty one."""
    return F.transform(
        counted, lambda x: F.when(F.col(total) > 0, F.round(x * UNIT / F.col(total))).otherwise(0).cast("long")
    )


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, 0 to 1, of two arrays of shares that each sum to 1 (or 0)."""

    def half(a: Column, m: Column) -> Column:
        return F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: half(a, (a + b) / 2) + half(b, (a + b) / 2))
    total = F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + F.coalesce(x, F.lit(0.0)))
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def references(counted: DataFrame) -> DataFrame:
    """(lang_key, class_ref, word_ref): mean shares over the documents that pass the base rules.

    At most one row for each language with a list of words and one for the rest.
    """
    sound = counted.where(~F.col("base_failed"))

    def mean(column: str, size: int) -> list[Column]:
        return [F.sum(F.coalesce(F.get(column, F.lit(i)), F.lit(0))).alias(f"{column}{i}") for i in range(size)]

    n_classes, n_words = len(CLASSES) + 1, max(len(v.split()) for v in COMMON_WORDS.values())
    sums = sound.groupBy("lang_key").agg(*mean("class_share", n_classes), *mean("word_share", n_words))

    def row(column: str, size: int) -> Column:
        parts = [F.col(f"{column}{i}").cast("double") for i in range(size)]
        return F.array(*[x / F.nullif(sum(parts[1:], parts[0]), F.lit(0.0)) for x in parts])

    return sums.select(
        "lang_key",
        row("class_share", n_classes).alias("class_ref"),
        row("word_share", n_words).alias("word_ref"),
    )


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """The ``id`` of every document with its counts, distances and ``kept``.

    ``base_failed``: under 20 words, or more than 30 % of them in repeated
    8-word windows. Otherwise a document is kept unless it has at least
    ``MIN_JUDGED_WORDS`` words and its character classes, or (with enough common
    words) its common words, lie too far from the mean of its language. NULL and
    blank texts fail the base rule. Repeated rows are judged alike. An empty
    table gives an empty one. The counts are written once to the shared folder:
    the references need all of them before any document is judged.
    """
    counted = counts(docs, id_col, text_col, lang_col).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")),
    )
    counted = materialize(
        counted.withColumn("n_classed", _total(F.col("classes"))).withColumn(
            "n_common", _total(F.col("common"))
        )
    )
    counted = counted.withColumn("class_share", _shares("classes", "n_classed")).withColumn(
        "word_share", _shares("common", "n_common")
    )
    met = counted.join(F.broadcast(references(counted)), "lang_key", "left")

    def distance(shares: str, reference: str) -> Column:
        return js_distance(F.transform(shares, lambda x: x / F.lit(float(UNIT))), F.col(reference))

    met = met.withColumn(
        "class_distance", F.coalesce(distance("class_share", "class_ref"), F.lit(0.0))
    ).withColumn(
        "word_distance",
        F.when(F.col("n_common") >= MIN_COMMON_WORDS, distance("word_share", "word_ref"))
        .otherwise(F.lit(0.0)),
    )
    far = (F.col("n_words") >= MIN_JUDGED_WORDS) & (
        (F.col("class_distance") > max_class_distance)
        | (F.coalesce("word_distance", F.lit(0.0)) > max_word_distance)
    )
    return met.withColumn("kept", ~F.col("base_failed") & ~far)
