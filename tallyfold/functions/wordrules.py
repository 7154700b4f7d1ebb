"""Rules on the order and distance of words in folded text.

A rule is a list of steps (class of words, distance): a word of the first
class, then within that many words one of the next, and so on, all in one
sentence.  Classes are plain vocabularies; ``ferm*`` stands for all words with
that beginning, ``#`` for any number and ``##`` for one of at least two.

A text is brought to words with a space around each and a bar for a sentence's
end; a set of rules is then one expression over it, so that plans stay small
and rules are evaluated in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Rule = list[tuple[str, int]]
Classes = dict[str, list[str]]
#: What ends a sentence, and what parts words, in folded text.
MARKS, GAPS = "[.!?|\\n]+", "[^a-z0-9@|]+"
WORD = "[a-z0-9@]+"
NUMBERS = {"#": "[0-9]+", "##": "(?:[2-9]|[1-9][0-9]+)"}


def one_of(vocabulary: list[str]) -> str:
    return "|".join(NUMBERS.get(w) or (w[:-1] + WORD[:-1] + "*" if w.endswith("*") else w) for w in vocabulary)


def pattern(rule: Rule, classes: Classes) -> str:
    """A rule as an expression over :func:`words`; its last word is the group."""
    out = ""
    for k, (name, most) in enumerate(rule):
        between = f"(?: {WORD}){{0,{most - 1}}}?" if k else ""
        out += f"{between} ({'' if k == len(rule) - 1 else '?:'}{one_of(classes[name])})"
    return out + " "


def words(c: Column) -> Column:
    """Folded text as its words, a space around each, with a bar for a sentence's end."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.regexp_replace(c, MARKS, " | "), GAPS, " ")), F.lit(" "))


def says(c: Column, rules: list[Rule], classes: Classes) -> Column:
    """Folded text holds what one of the rules tells of."""
    return words_say(words(c), rules, classes)


def words_say(w: Column, rules: list[Rule], classes: Classes) -> Column:
    """As :func:`says`, of text that is brought to words."""
    return F.coalesce(w.rlike("|".join(pattern(r, classes) for r in rules)), F.lit(False))


def last_word(c: Column, rule: Rule, classes: Classes) -> Column:
    """The word that ends the rule where it is first met, empty if it is not."""
    return F.coalesce(F.regexp_extract(words(c), pattern(rule, classes), 1), F.lit(""))


def put(c: Column, name: Column, mark: str) -> Column:
    """Folded text as :func:`words`, with each run of the words of ``name`` replaced by one word, ``mark``."""
    run = F.concat(F.lit(" "), F.trim(F.regexp_replace(name, GAPS, " ")), F.lit(" "))
    return F.when(F.trim(run) == "", words(c)).otherwise(F.replace(words(c), run, F.lit(f" {mark} ")))
