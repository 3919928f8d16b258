"""Quality rules: a threshold table compiled into one Spark projection.

A row of the table names a count, what it is divided by, and the least and the
greatest share allowed. ``compile_counts`` turns the counts that a table asks for
into one struct expression of built-in functions, ``compile_rules`` turns the rows
into conditions on it. No user function runs: words and lines are arrays, bound
once by a lambda (``_let``) so that no expression is evaluated twice.

Words are maximal runs of characters other than space and 9-13, lines the pieces
between line feeds that hold a word. A word repeats if it lies in a window of
``WINDOW_WORDS`` words that occurs at least twice in the text, its first place
included. Windows are told apart by 64-bit hashes; if all differ nothing repeats.
Otherwise hashes are sorted with their places and every pair of neighbours with
equal hashes is compared word by word; should one pair differ, the text's windows
are sorted as strings instead. So counts are exact, in O(n log n) of one text.

Shares are compared as integers (``count * denominator`` with ``numerator * per``),
so no rounding decides.

Defined results: null, empty and blank texts have no words and fail the base rules;
texts of any length are read whole; rows with null or repeated ids are judged one
by one; counts of a text without words or lines are zero, and a share of nothing
passes; an empty table gives no rows; all columns are passed through but those
that have a name of the output's (``COUNTS``' names, ``base_failed``, ``failed``,
``kept``), which are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_WORDS = 5
SPACE = r"\x20\x09-\x0D"
SYMBOLS = "#*$%&|<>"
MARKS = ".,;:!?"

#: fixed values: frequent function words of English, German, French and Spanish
STOP_WORDS = (
    "a and are as at be but by for from had has have he her his i in is it not of on or she that the this to was were which with you "
    "als am auch auf aus bei das dem den der des die ein eine einer für hat ich im ist mit nach nicht sich sie sind und von war wie zu "
    "au aux avec ce ces dans de du elle en est et il la le les leur mais ne nous ou par pas pour qui se sur un une "
    "al como con del el ella es esta los las lo más no para pero por que su sus una y ya"
).split()


class Rule(NamedTuple):
    name: str
    count: str
    per: str | None  # None: the count itself
    at_least: str | None
    at_most: str | None
    base: bool = False


TABLE = (
    Rule("words", "n_words", None, "10", None, True),
    Rule("repeated words", "n_repeat_words", "n_words", None, "0.20", True),
    Rule("word length", "word_chars", "n_words", "2", "15"),
    Rule("symbols", "n_symbols", "n_words", None, "0.15"),
    Rule("exclamations", "n_exclamations", "n_words", None, "0.4"),
    Rule("letters", "n_letter_words", "n_words", "0.7", None),
    Rule("capitals", "n_capital_words", "n_words", None, "0.6"),
    Rule("stop words", "n_stop_words", "n_words", "0.02", None),
    Rule("repeated lines", "n_dup_lines", "n_lines", None, "0.50"),
    Rule("bullets", "n_bullet_lines", "n_lines", None, "0.90"),
    Rule("ellipses", "n_ellipsis_lines", "n_lines", None, "0.30"),
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _only(text: Column, chars: str) -> Column:
    return F.char_length(F.regexp_replace(text, f"[^{chars}]+", ""))


def _having(items: Column, test: Callable[[Column], Column]) -> Column:
    return F.size(F.filter(items, test))


def _is_stop(word: Column) -> Column:
    return F.rtrim(F.lower(word), F.lit(MARKS)).isin(STOP_WORDS)


def _window(words: Column, i: Column) -> Column:
    return F.slice(words, i + 1, WINDOW_WORDS)


def _covered(marked: Column) -> Column:
    """Words under the windows of sorted ``(mark, place)`` whose mark recurs."""
    def again(x: Column, k: Column) -> Column:
        return F.coalesce(x["mark"] == F.get(marked, k - 1)["mark"], F.lit(False)) | F.coalesce(x["mark"] == F.get(marked, k + 1)["mark"], F.lit(False))

    places = F.sort_array(F.transform(F.filter(marked, again), lambda x: x["at"]))
    nothing = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    return F.aggregate(places, nothing, lambda a, i: F.struct(
        (i + WINDOW_WORDS).alias("end"), (a["n"] + i + WINDOW_WORDS - F.greatest(a["end"], i)).alias("n")), lambda a: a["n"])


def repeat_words(words: Column, mark: Callable[..., Column] = F.xxhash64) -> Column:
    """Words that lie in recurring windows."""
    def placed(marks: Column) -> Column:
        return F.sort_array(F.transform(marks, lambda m, i: F.struct(m.alias("mark"), i.alias("at"))))

    def mismatch(marked: Column) -> Column:
        def apart(x: Column, k: Column) -> Column:
            before = F.get(marked, k - 1)
            return (x["mark"] == before["mark"]) & (_window(words, x["at"]) != _window(words, before["at"]))

        return F.size(F.filter(marked, apart)) > 0

    firsts = F.sequence(F.lit(0), F.size(words) - WINDOW_WORDS)
    strings = F.transform(firsts, lambda i: F.array_join(_window(words, i), " "))
    hashes = F.transform(firsts, lambda i: mark(*[F.get(words, i + k) for k in range(WINDOW_WORDS)]))
    exact = lambda: _let(placed(strings), _covered)
    found = _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
        _let(placed(h), lambda s: F.when(mismatch(s), exact()).otherwise(_covered(s)))))
    return F.when(F.size(words) <= WINDOW_WORDS, F.lit(0)).otherwise(found)


#: counts by name: of the text ``t``, its words ``w`` and its lines ``l``
COUNTS: dict[str, Callable[[Column, Column, Column], Column]] = {
    "n_words": lambda t, w, l: F.size(w),
    "word_chars": lambda t, w, l: F.char_length(F.array_join(w, "")),
    "n_symbols": lambda t, w, l: _only(t, SYMBOLS),
    "n_exclamations": lambda t, w, l: _only(t, "!?"),
    "n_letter_words": lambda t, w, l: _having(w, lambda x: x.rlike(r"\p{L}")),
    "n_capital_words": lambda t, w, l: _having(w, lambda x: (x == F.upper(x)) & (x != F.lower(x))),
    "n_stop_words": lambda t, w, l: _having(w, _is_stop),
    "n_repeat_words": lambda t, w, l: repeat_words(w),
    "n_lines": lambda t, w, l: F.size(l),
    "n_dup_lines": lambda t, w, l: F.size(l) - F.size(F.array_distinct(l)),
    "n_bullet_lines": lambda t, w, l: _having(l, lambda x: x.rlike(f"^[{SPACE}]*[-*•]")),
    "n_ellipsis_lines": lambda t, w, l: _having(l, lambda x: x.rlike(f"(\\.\\.\\.|…)[{SPACE}]*$")),
}


def asked(table: tuple[Rule, ...]) -> list[str]:
    """The counts that a table asks for, each once."""
    return list(dict.fromkeys(n for r in table for n in (r.count, r.per) if n))


def compile_counts(text: Column, names: list[str]) -> Column:
    """One struct of bigint counts."""
    unknown = set(names) - set(COUNTS)
    if unknown:
        raise ValueError(f"unknown counts: {sorted(unknown)}")

    def of(t: Column) -> Column:
        words = F.array_remove(F.split(t, f"[{SPACE}]+"), "")
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
        return _let(words, lambda w: _let(lines, lambda l: F.struct(*[COUNTS[n](t, w, l).cast("bigint").alias(n) for n in names])))

    return _let(F.coalesce(text, F.lit("")), of)


def _compare(rule: Rule, counts: Callable[[str], Column], bound: str, sign: int) -> Column:
    """Whether the share misses ``bound`` (``sign`` 1: it is greater)."""
    limit = Fraction(bound)
    share = counts(rule.count) * limit.denominator
    limit = (counts(rule.per) if rule.per else F.lit(1)) * limit.numerator
    return share > limit if sign > 0 else share < limit


def compile_rules(table: tuple[Rule, ...], counts: Callable[[str], Column]) -> list[tuple[Rule, Column]]:
    """Each row of the table with the condition that fails it."""
    out = []
    for r in table:
        fails = [_compare(r, counts, b, s) for b, s in ((r.at_least, -1), (r.at_most, 1)) if b is not None]
        if not fails:
            raise ValueError(f"rule {r.name!r} has no bound")
        out.append((r, fails[0] if len(fails) == 1 else fails[0] | fails[1]))
    return out


def judge(docs: DataFrame, table: tuple[Rule, ...] = TABLE, text_col: str = "text") -> DataFrame:
    """``docs`` with the table's counts, ``base_failed`` (a base rule fails),
    ``failed`` (names of the rules that fail, in table order) and ``kept``."""
    names = asked(table)
    new = {*names, "base_failed", "failed", "kept"}
    others = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns if c not in new]
    text = F.col("`" + text_col.replace("`", "``") + "`")
    held = "__quality_counts"
    counted = docs.select(*others, compile_counts(text, names).alias(held))
    fails = compile_rules(table, lambda n: F.col(f"{held}.{n}"))
    base = F.lit(False)
    for r, f in fails:
        base = base | f if r.base else base
    failed = F.array_compact(F.array(*[F.when(f, F.lit(r.name)) for r, f in fails]))
    out = counted.select(*others, f"{held}.*", base.alias("base_failed"), failed.alias("failed"))
    return out.withColumn("kept", F.size("failed") == 0)
