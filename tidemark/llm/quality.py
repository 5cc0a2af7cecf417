"""Quality rules, line first, in DataFrame functions only.

Every line is judged by itself: punctuation, navigation, symbols, shouting, repetition and boilerplate. Failing lines are
removed; a document that loses too much of its text that way, is too short or repeats itself too much is rejected.

Nulls and ties: a null or empty text has no word and no line, counts nothing and is rejected as too short. Lines that hold
no word are neither judged nor kept. Rows are judged each on its own, so repeated rows get equal results. Very long texts
stay within one row's arrays. Other columns pass through; those named like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Least share of a document's line characters that its good lines must hold.
MIN_KEPT = 0.5
#: Phrases of boilerplate lines, in the languages of the corpus.
BOILERPLATE = (
    "licensed under", "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "accept cookies", "enable javascript", "sign up for our newsletter", "subscribe to our",
    "alle rechte vorbehalten", "nutzungsbedingungen", "datenschutzerklärung", "cookies akzeptieren", "newsletter abonnieren",
    "tous droits réservés", "conditions d'utilisation", "politique de confidentialité", "accepter les cookies", "abonnez-vous à notre",
    "todos los derechos reservados", "términos de uso", "política de privacidad", "aceptar cookies", "suscríbete a nuestro",
)


def _count(text: Column, chars: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{chars}]"))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def judged_lines(lines: str, any_symbols: Column, any_shouts: Column) -> Column:
    """The lines of an array column that pass every rule.

    any_symbols, any_shouts: how many the whole text has; lines are searched for them only where that can matter.
    """
    zero = F.lit(0)

    def measured(line: Column) -> Column:
        return F.struct(
            line.alias("line"),
            (F.regexp_count(line, F.lit("[ \t]+")) + 1).alias("n"),
            F.when(F.contains(line, F.lit(" | ")), F.regexp_count(line, F.lit(" [|] "))).otherwise(zero).alias("bars"),
            F.when(any_symbols >= 3, _count(line, SYMBOLS)).otherwise(zero).alias("symbols"),
            F.when(any_shouts >= 3, _count(line, "!?")).otherwise(zero).alias("shouts"),
            F.lower(line).alias("low"),
        )

    def good(m: Column) -> Column:
        n = m["n"]
        boiler = F.lit(False)
        for phrase in BOILERPLATE:
            boiler = boiler | F.contains(m["low"], F.lit(phrase))
        return (
            ((m["bars"] < 3) | (m["bars"] * 4 < n))  # navigation: cells in a bar
            & ((m["symbols"] < 3) | (m["symbols"] * 10 <= n * 3))  # symbols instead of words
            & ((m["shouts"] < 3) | (m["shouts"] * 10 <= n * 3))  # shouting
            & ((n >= 4) | F.rlike(m["line"], F.lit(r"[.!?:;…)\"'»”]\s*$")))  # a few words without an end: a menu entry
            & ~boiler
        )

    return F.transform(F.filter(F.transform(lines, measured), good), lambda m: m["line"])


def repeat_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """out = words covered by 3-word windows that come twice or more in the row's array of words.

    Windows are hashed to 64 bits and packed with their places, hash bits first, so that one sort of a primitive array puts
    equal windows together; neighbours are then compared by the whole 64-bit hash. Where neighbours share the packed bits only
    (which is rare), the row's whole hashes are sorted instead.
    """
    df = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    df = df.withColumn("_m", F.greatest(F.size("_h") - 2, F.lit(0)))
    pair = F.zip_with(F.slice("_h", F.lit(1), F.col("_m")), F.slice("_h", F.lit(2), F.col("_m")), lambda a, b: F.xxhash64(a, b))
    df = df.withColumn("_t", F.zip_with(pair, F.slice("_h", F.lit(3), F.col("_m")), lambda a, b: F.xxhash64(a, b)))
    df = df.withColumn("_mask", F.expr("shiftleft(-1L, length(bin(_m)))"))
    df = df.withColumn("_s", F.expr("sort_array(transform(_t, (x, i) -> (x & _mask) | i))"))
    # pairs of neighbours: -1 marks two different windows that look alike
    df = df.withColumn("_dup", F.expr("""
        flatten(filter(zip_with(slice(_s, 1, greatest(_m - 1, 0)), slice(_s, 2, greatest(_m - 1, 0)),
            (a, b) -> if((a & _mask) = (b & _mask), if(get(_t, int(a & ~_mask)) = get(_t, int(b & ~_mask)), array(int(a & ~_mask), int(b & ~_mask)), array(-1)), null)),
            x -> x is not null))"""))  # fmt: skip
    exact = """
        flatten(transform(filter(sequence(2, greatest(_m, 2)), k -> get(q, k - 2).x = get(q, k - 1).x), k -> array(get(q, k - 2).i, get(q, k - 1).i)))"""
    exact = f"get(transform(array(sort_array(transform(_t, (x, i) -> named_struct('x', x, 'i', i)))), q -> {exact}), 0)"
    df = df.withColumn("_dup", F.expr(f"if(array_contains(_dup, -1), {exact}, _dup)"))
    df = df.withColumn("_p", F.sort_array(F.array_distinct("_dup")))
    covered = F.expr("""
        if(size(_p) = 0, 0L, 3L + aggregate(zip_with(slice(_p, 1, size(_p) - 1), slice(_p, 2, size(_p) - 1), (a, b) -> least(3, b - a)), 0L, (s, x) -> s + x))""")
    return df.withColumn(out, F.when(F.col("_m") < 2, F.lit(0).cast("long")).otherwise(covered)).drop("_h", "_m", "_t", "_mask", "_s", "_dup", "_p")


ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "clean_text", "kept_share")


def _judged(docs: DataFrame, text_col: str, min_kept: float) -> DataFrame:
    """The packed rows of docs with the columns ADDED."""
    df = packed(docs, _text=F.coalesce(F.col(text_col), F.lit("")))
    df = df.withColumn("_words", words_of(F.col("_text")))
    df = df.withColumn("n_words", F.size("_words").cast("long"))
    df = df.withColumn("word_chars", F.length(F.array_join("_words", "")).cast("long"))
    df = repeat_words(df, "_words", "n_repeat_words").drop("_words")
    df = df.withColumn("_lines", F.filter(F.split("_text", "\n", -1), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))))
    df = df.withColumn("n_symbols", _count(F.col("_text"), SYMBOLS).cast("long")).withColumn("_shouts", _count(F.col("_text"), "!?"))
    df = df.withColumn("_good", judged_lines("_lines", F.col("n_symbols"), F.col("_shouts")))
    df = df.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    df = df.withColumn("clean_text", F.array_join("_good", "\n"))
    whole = F.length(F.array_join("_lines", "\n"))
    df = df.withColumn("kept_share", F.when(whole > 0, F.length("clean_text") / whole).otherwise(0.0))
    df = df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return df.withColumn("kept", ~F.col("base_failed") & (F.col("kept_share") >= min_kept)).select("row", *ADDED)


def quality_columns(docs: DataFrame, text_col: str = "text", min_kept: float = MIN_KEPT) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, clean_text, kept_share."""
    return unpacked(_judged(docs, text_col, min_kept), docs.columns, **{c: F.col(c) for c in ADDED})


def accepted(docs: DataFrame, text_col: str = "text", min_kept: float = MIN_KEPT) -> DataFrame:
    """The documents that are kept, with the text that is left of them; docs' columns, whatever their names.

    The rows pass through a generator, so that the optimiser doesn't copy the whole computation into the filter.
    """
    one = F.struct("row", F.col("clean_text").alias("clean"), F.col("kept").alias("is_kept"))
    rows = _judged(docs, text_col, min_kept).select(F.inline(F.array(one))).where("is_kept")
    return unpacked(rows, docs.columns, **{text_col: F.col("clean")})
