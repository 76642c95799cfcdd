"""Text columns: cleaning, tokens, string similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def words(text: Column) -> Column:
    """Tokens between runs of blanks, without empty ones."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda t: t != "")


def letters_only_words(text: Column) -> Column:
    """Lower-case tokens after every sign but ASCII letters, digits and blanks is dropped."""
    return F.filter(F.split(F.regexp_replace(F.lower(text), r"[^a-z0-9\s]", ""), r"\s+"), lambda t: t != "")


def word_matches(text: Column) -> Column:
    """Lower-case runs of word characters in any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(?U)(\w+)"), F.lit(1))


def clean_text(text: Column) -> Column:
    """Lower case, punctuation to blanks, blank runs collapsed, ends trimmed."""
    spaced = F.translate(F.lower(text), PUNCTUATION, " " * len(PUNCTUATION))
    return F.trim(F.regexp_replace(spaced, r"\s+", " "))


def clean_tokens(text: Column) -> Column:
    """Tokens of the cleaned text without pure number tokens."""
    return F.filter(F.split(clean_text(text), " "), lambda t: (t != "") & ~t.rlike(r"^[0-9]+$"))


def ngrams(tokens: Column, n: int) -> Column:
    """n-grams of one document, as blank-joined strings."""
    return F.when(
        F.size(tokens) >= n,
        F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)), lambda i: F.array_join(F.slice(tokens, i, n), " ")),
    ).otherwise(F.array().cast("array<string>"))


def match_form(text: Column) -> Column:
    """The form in which two texts are compared: lower case, only word characters and blanks."""
    return F.regexp_replace(F.trim(F.lower(text)), r"(?U)[^\w\s]", "")


def sound_code(text: Column) -> Column:
    """Four-sign sound code.

    The first letter is kept, all letters (also the first) become digits, digit
    runs collapse, the first sign is cut, vowels go and the rest is padded.
    """
    up = F.regexp_replace(F.upper(text), "[^A-Z]", "")
    digits = F.translate(up, "BFPVCGJKQSXZDTLMNR", "111122222222334556")
    runs = F.regexp_replace(digits, r"([0-9])\1+", "$1")
    tail = F.regexp_replace(F.substring(runs, 2, 1 << 30), "[AEIOUY]", "")
    return F.when(up == "", F.lit("0000")).otherwise(
        F.concat(F.substring(up, 1, 1), F.rpad(F.substring(tail, 1, 3), 3, "0"))
    )


def jaccard(a: Column, b: Column) -> Column:
    """Overlap of two token arrays as sets; nothing on both sides gives 0."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def term_counts(tokens: Column) -> Column:
    """token -> count as a map, from the run starts of the sorted tokens."""

    def runs(t: Column) -> Column:
        n = F.size(t)
        starts = F.filter(
            F.sequence(F.lit(1), n), lambda i: (i == 1) | (F.element_at(t, i) != F.element_at(t, F.greatest(i - 1, F.lit(1))))
        )
        return F.transform(
            F.array(starts),
            lambda s: F.map_from_arrays(
                F.transform(s, lambda i: F.element_at(t, i)),
                F.zip_with(s, F.concat(F.slice(s, F.lit(2), F.size(s)), F.array(n + 1)), lambda a, b: (b - a).cast("double")),
            ),
        )[0]

    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>"))
    # the one-element array binds the sorted tokens to a name, so that they are sorted once
    return F.when(F.size(tokens) == 0, empty).otherwise(F.transform(F.array(F.array_sort(tokens)), runs)[0])


def count_cosine(a: Column, b: Column) -> Column:
    """Cosine of two token -> count maps; an empty side gives 0."""
    zero = F.lit(0.0)
    dot = F.aggregate(
        F.map_entries(a), zero, lambda s, e: s + e["value"] * F.coalesce(F.try_element_at(b, e["key"]), F.lit(0.0))
    )
    norm = lambda m: F.sqrt(F.aggregate(F.map_values(m), F.lit(0.0), lambda s, v: s + v * v))
    size = norm(a) * norm(b)
    return F.when(size > 0, dot / size).otherwise(zero)


def edit_similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length."""
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.char_length(a), F.char_length(b))


def blend(j: Column, c: Column, e: Column, s: Column) -> Column:
    """Weighted mean of overlap, cosine, edit and sound similarity, added in this order."""
    return j * F.lit(0.3) + c * F.lit(0.3) + e * F.lit(0.3) + s * F.lit(0.1)


def combined_similarity(a: Column, b: Column) -> Column:
    """The blended similarity of two texts; an empty side gives 0."""
    ca, cb = match_form(a), match_form(b)
    wa, wb = words(ca), words(cb)
    sound = F.when(sound_code(ca) == sound_code(cb), 1.0).otherwise(0.0)
    mixed = blend(jaccard(wa, wb), count_cosine(term_counts(wa), term_counts(wb)), edit_similarity(ca, cb), sound)
    return F.when((ca == "") | (cb == ""), F.lit(0.0)).otherwise(mixed)


def match_fraction(a: Column, b: Column) -> Column:
    """Share of positions where two arrays of the same length agree; other lengths give 0."""
    hits = F.aggregate(
        F.zip_with(a, b, lambda x, y: F.when(x.eqNullSafe(y), 1).otherwise(0)), F.lit(0), lambda s, x: s + x
    )
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0), hits / F.size(a)).otherwise(F.lit(0.0))
