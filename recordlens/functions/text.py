"""Column expressions for free text and token lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop words of Spark ML's StopWordsRemover.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
    herself it its itself they them their theirs themselves what which who whom this that these those am is are
    was were be been being have has had having do does did doing a an the and but if or because as until while
    of at by for with about against between into through during before after above below to from up down in out
    on off over under again further then once here there when where why how all any both each few more most
    other some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll
    she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
    you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
    shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's
    who's why's would
    """.split()
)


def folded(col: Column) -> Column:
    """Lower case."""
    return F.lower(col)


def joined_text(*cols: Column, sep: str = " ") -> Column:
    """The columns' text in order, separated; nulls are skipped, all-null gives ``''``."""
    return F.concat_ws(sep, *cols)


def split_words(col: Column) -> Column:
    """Words between single spaces. Doubled, leading and trailing spaces give empty words."""
    return F.split(col, " ")


def java_split_words(col: Column) -> Column:
    """Like ``split_words`` without the trailing empty words, as ``String.split`` on the JVM does it.

    Trailing empty words come from trailing spaces only. The empty text is one empty word, and text
    of nothing but spaces has no words.
    """
    kept = F.rtrim(col)
    return F.when((kept == "") & (col != ""), F.array().cast("array<string>")).otherwise(split_words(kept))


def tokens(col: Column, *, unicode: bool = False, min_length: int = 1) -> Column:
    """Lower-cased runs of word characters; null text has no tokens.

    Word characters are ASCII letters, digits and ``_``, so ``café`` gives ``caf``; with ``unicode``
    they are the letters and digits of all scripts.
    """
    pattern = r"(?U)\W+" if unicode else r"\W+"
    parts = F.array_remove(F.split(F.lower(F.coalesce(col, F.lit(""))), pattern), "")
    if min_length > 1:
        parts = F.filter(parts, lambda part: F.length(part) >= min_length)
    return parts


def without_stop_words(
    col: Column, stop_words: Iterable[str] = STOP_WORDS, *, case_sensitive: bool = False
) -> Column:
    """Tokens that are not stop words; order and repeats stay."""
    words = list(stop_words)
    if not case_sensitive:
        words = [word.lower() for word in words]
    return F.filter(col, lambda token: ~(token if case_sensitive else F.lower(token)).isin(words))


def term_counts(col: Column) -> Column:
    """Token list to ``array<struct<term STRING, tf INT>>``, one element per distinct token.

    The counting happens inside the row: the sorted tokens are cut where the term changes. Counting
    by ``groupBy(document, term)`` would shuffle about one row per token of the whole corpus.
    Each single-element ``transform`` names an intermediate list so that it is computed once.
    """

    def runs(ordered: Column) -> Column:
        size = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(0), size - 1),
            lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
        )
        return F.element_at(
            F.transform(
                F.array(starts),
                lambda cuts: F.transform(
                    cuts,
                    lambda start, i: F.struct(
                        F.get(ordered, start).alias("term"),
                        (F.coalesce(F.get(cuts, i + 1), size) - start).alias("tf"),
                    ),
                ),
            ),
            1,
        )

    counted = F.element_at(F.transform(F.array(F.sort_array(col)), runs), 1)
    return F.when(F.size(col) > 0, counted).otherwise(F.array().cast("array<struct<term:string,tf:int>>"))
