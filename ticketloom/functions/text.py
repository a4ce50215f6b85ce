"""Text expressions shared by all operators. Everything stays in the JVM."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ticketloom import policy

# Fixed value: the characters a strip removes (all Unicode white space).
WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020\u0085\u00a0\u1680\u2000"
    "\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same as [^\p{L}\p{N}_]+; plain letters are found first, without a look at their category.
NOT_WORD = r"[^a-z0-9_[\p{L}\p{N}]]+"
WORD_PATTERN = r"(?<![\p{L}\p{N}_])[a-z]{4,}+(?![\p{L}\p{N}_])"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``.

    A column used inside a lambda is otherwise inlined into it by the optimizer
    and evaluated again for every array element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def string_array(values: Sequence[str]) -> Column:
    if not values:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(v) for v in values])


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    return F.coalesce(F.length(strip(col)) == 0, F.lit(True))


def normalise(col: Column) -> Column:
    """Lower-cased word tokens, one space between and at both ends."""
    words = F.btrim(F.regexp_replace(F.lower(col), NOT_WORD, " "))
    return F.concat(F.lit(" "), words, F.lit(" "))


def padded(phrase: str) -> str:
    """A policy phrase in the same form as ``normalise``."""
    kept = "".join(c if c.isalnum() or c == "_" else " " for c in phrase.lower())
    return f" {' '.join(kept.split())} "


def preview(col: Column, n: int, ellipsis: str = "longer") -> Column:
    """First ``n`` characters; "..." is added ``always``, if ``longer``, or ``never``."""
    head = F.substring(col, 1, n)
    if ellipsis == "always":
        return F.concat(head, F.lit("..."))
    if ellipsis == "never":
        return head
    if ellipsis == "longer":
        return F.when(F.length(col) > n, F.concat(head, F.lit("..."))).otherwise(col)
    raise ValueError(f"ellipsis must be always, longer or never, not {ellipsis!r}")


def words(col: Column) -> Column:
    """Lower-case ASCII words of four letters or more that are not stop words."""
    found = F.regexp_extract_all(F.lower(col), F.lit(WORD_PATTERN), F.lit(0))
    stop = [w for w in policy.STOP_WORDS if len(w) >= 4]
    return F.filter(found, lambda w: ~w.isin(stop))


def search_words(col: Column) -> Column:
    """All lower-case words of letters, digits and underscores, of any length and language."""
    return F.filter(F.split(normalise(col), " "), lambda w: w != "")


def word_counts(tokens: Column) -> Column:
    """array<struct<word, n>> of an array of words, ordered by word.

    Sorting makes equal words neighbours and a back-reference takes each run in one
    piece: n log n within the row, no shuffle of tokens and no lambda per token.
    """
    ordered = F.concat(F.array_join(F.sort_array(tokens), " "), F.lit(" "))
    runs = F.regexp_extract_all(ordered, F.lit(r"([^ ]+ )\1*"), F.lit(0))

    def counted(run: Column) -> Column:
        word = F.substring_index(run, " ", 1)
        n = (F.length(run) / (F.length(word) + 1)).cast("int")
        return F.struct(word.alias("word"), n.alias("n"))

    return F.transform(runs, counted)


def keywords(col: Column, k: int = 10) -> Column:
    """The ``k`` most frequent words, ties by first occurrence.

    Words of the k largest counts above one are ordered by count and first position;
    words that occur once follow in text order.
    """

    def ranked(tokens: Column) -> Column:
        repeated = F.filter(word_counts(tokens), lambda x: x["n"] > 1)
        return let(repeated, lambda r: let(cut_off(r), lambda at: pick(tokens, r, at)))

    def cut_off(repeated: Column) -> Column:
        counts = F.sort_array(F.transform(repeated, lambda x: x["n"]), asc=False)
        return F.coalesce(F.get(counts, F.lit(k - 1)), F.lit(0))

    def pick(tokens: Column, repeated: Column, at: Column) -> Column:
        leading = F.sort_array(
            F.transform(
                F.filter(repeated, lambda x: x["n"] >= at),
                lambda x: F.struct(
                    (-x["n"]).alias("neg"),
                    F.array_position(tokens, x["word"]).alias("first"),
                    x["word"].alias("word"),
                ),
            )
        )
        top = F.transform(F.slice(leading, 1, k), lambda x: x["word"])
        once = F.array_except(tokens, F.transform(repeated, lambda x: x["word"]))
        return F.when(at > 0, top).otherwise(F.slice(F.concat(top, once), 1, k))

    return let(words(col), ranked)


def first_match(col: Column, patterns: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """Value of the first pattern group with a substring in ``col``."""
    out = None
    for value, needles in patterns:
        hit = F.lit(False)
        for needle in needles:
            hit = hit | F.contains(col, F.lit(needle))
        out = F.when(hit, value) if out is None else out.when(hit, value)
    return out.otherwise(default)
