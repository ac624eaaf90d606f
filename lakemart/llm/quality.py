"""Quality rules: base counts, then divergence from the language's usual distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, pick, store, whole

# Some of the most common words of each language.
COMMON_WORDS: dict[str, list[str]] = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for", "it", "as", "was", "with", "be", "by", "on", "are"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est", "pour", "qui", "dans", "au"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "des", "auf", "für", "ist", "im", "nicht", "ein"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "se", "del", "las", "un", "por", "con", "no", "una", "su"],
}
#: Texts with fewer words or characters are not compared.
MIN_WORDS, MIN_CHARS = 100, 200
#: Jensen-Shannon distances (base 2, 0 to 1) beyond which a text is not usual for its language.
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.3, 0.28
_CLASSES = 7


def _left(text: Column, others: str) -> Column:
    """How many characters are not in the class ``others``."""
    return F.length(F.regexp_replace(text, others, ""))


def _among(words: Sequence[str]) -> Column:
    """How many of a text's common words are among these."""
    return F.size(F.filter("hits", lambda h: h.isin(list(words))))


def counted(docs: DataFrame, words: Mapping[str, Sequence[str]], id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Base counts and histograms of each text."""
    text = F.col("text")
    rows = pick(docs, id_col, text_col, lang_col).select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), whole(text_col).alias("text")
    )
    first = rows.withColumns({
        "words": F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        "lines": F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD)),
    })
    # windows side by side, so that no function looks an array up by place
    apart = [F.slice("words", k + 1, F.size("words") + 1) for k in range(3)]
    windows = F.filter(
        F.transform(
            F.arrays_zip(*(a.alias(f"w{k}") for k, a in enumerate(apart))),
            lambda z, i: F.struct(F.concat(z["w0"], F.lit(" "), z["w1"], F.lit(" "), z["w2"]).alias("window"), i.alias("at")),
        ),
        lambda w: w["window"].isNotNull(),
    )
    union = sorted({w for some in words.values() for w in some})
    second = first.select(
        "doc_id", "lang", "text", "words",
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.sort_array(windows).alias("windows"),
        F.filter(F.transform("words", lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?")))), lambda w: w.isin(union)).alias("hits"),
    )
    neighbours = F.arrays_zip(F.col("windows").alias("a"), F.slice("windows", 2, F.size("windows") + 1).alias("b"))
    twice = F.filter(neighbours, lambda z: z["a"]["window"] == z["b"]["window"])
    places = F.flatten(F.transform(twice, lambda z: F.array(*(z[s]["at"] + k for s in "ab" for k in range(3)))))
    n = F.size("words")
    third = second.select(
        "doc_id", "lang", n.cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _left(text, r"[^#*$%&|<>]+").cast("long").alias("n_symbols"), F.col("n_dup_lines").cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(places)).cast("long").alias("n_repeat_words"), F.length("text").cast("long").alias("n_chars"),
        _left(text, "[^A-Z]+").cast("long").alias("upper"), _left(text, "[^0-9]+").cast("long").alias("digits"),
        _left(text, r"""[^.,;:!?'"()-]+""").cast("long").alias("points"), _left(text, r"[\x00-\x7F]+").cast("long").alias("wide"),
        "hits",
    )
    # a text of no listed language is compared with the one whose words it has most of
    most = F.array_max(F.array(*(
        F.struct(_among(words[name]).alias("n"), F.lit(-i).alias("order"), F.lit(name).alias("lang"))
        for i, name in enumerate(words)
    )))["lang"]
    named = third.withColumn("spoken", F.when(F.col("lang").isin(list(words)), F.col("lang")).otherwise(most))
    spaces = F.col("n_chars") - F.col("word_chars")
    known = [F.col(c) for c in ("upper", "digits", "points", "n_symbols", "wide")]
    classes = F.array(*known, spaces, F.col("n_chars") - sum(known[1:], known[0]) - spaces)
    histogram = F.lit(None).cast("array<long>")
    for name, some in words.items():
        own = F.array(*(_among([w]).cast("long") for w in some))
        histogram = F.when(F.col("spoken") == name, own).otherwise(histogram)
    total = F.aggregate("common", F.lit(0).cast("long"), lambda a, x: a + x)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        named.select("*", classes.alias("classes"), histogram.alias("common"))
        .withColumn("common", F.concat("common", F.array(F.col("n_words") - total)))
        .select("doc_id", "spoken", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars",
                failed.alias("base_failed"), "classes", "common")
    )


def references(rows: DataFrame, words: Mapping[str, Sequence[str]]) -> dict[str, tuple[list[int], list[int]]]:
    """Per listed language, the summed histograms of all texts that pass the base rules:
    one small row for each language comes to the driver."""
    width = max(len(some) for some in words.values()) + 1
    sums = [F.sum(F.get("classes", F.lit(i))) for i in range(_CLASSES)] + [F.sum(F.get("common", F.lit(i))) for i in range(width)]
    found = rows.where(~F.col("base_failed")).groupBy("spoken").agg(*(s.alias(f"s{i}") for i, s in enumerate(sums))).collect()
    return {r["spoken"]: (list(r[1 : 1 + _CLASSES]), list(r[1 + _CLASSES : 2 + _CLASSES + len(words[r["spoken"]])])) for r in found}


def distance(counts: Column, reference: Sequence[int]) -> Column:
    """Jensen-Shannon distance of a histogram from a reference; 0 where either is empty."""
    whole_reference = sum(reference)
    if not whole_reference:
        return F.lit(0.0)
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda a, x: a + x)
    q = F.array(*(F.lit(x / whole_reference) for x in reference))

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def both(x: Column, y: Column) -> Column:
        return (part(x, (x + y) / 2) + part(y, (x + y) / 2)) / 2

    p = F.transform(counts, lambda x: x / F.greatest(total, F.lit(1)))
    return F.when(total > 0, F.sqrt(F.greatest(F.aggregate(F.zip_with(p, q, both), F.lit(0.0), lambda a, x: a + x), F.lit(0.0)))).otherwise(0.0)


def judged(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    words: Mapping[str, Sequence[str]] = COMMON_WORDS,
    max_class: float = MAX_CLASS_DISTANCE, max_word: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """Each row's base counts, ``base_failed``, the two distances and ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated 3-word
    windows. Null and empty texts have no words and so fail. A text is compared with the
    reference of its language (one that is null or not listed: the language whose
    common words it has most of); below the least lengths, or without a reference, the
    distances are 0. Rows are judged one by one, so repeated rows and null ids stay.
    """
    rows = store(counted(docs, words, id_col, text_col, lang_col), "counted")
    # what is unusual against all texts has no say in what is usual
    first = _measured(rows, references(rows, words))
    measured = _measured(rows, references(first.where(_usual(max_class, max_word)), words))
    return measured.withColumn("kept", ~F.col("base_failed") & _usual(max_class, max_word)).drop("classes", "common")


def _measured(rows: DataFrame, known: Mapping[str, tuple[list[int], list[int]]]) -> DataFrame:
    class_distance, word_distance = F.lit(0.0), F.lit(0.0)
    for name, (classes, common) in known.items():
        here = F.col("spoken") == name
        class_distance = F.when(here & (F.col("n_chars") >= MIN_CHARS), distance(F.col("classes"), classes)).otherwise(class_distance)
        word_distance = F.when(here & (F.col("n_words") >= MIN_WORDS), distance(F.col("common"), common)).otherwise(word_distance)
    return rows.select("*", class_distance.alias("class_distance"), word_distance.alias("word_distance"))


def _usual(max_class: float, max_word: float) -> Column:
    return (F.col("class_distance") <= max_class) & (F.col("word_distance") <= max_word)
