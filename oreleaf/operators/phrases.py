"""Near-identical phrases within a group.

A phrase stands for the set of its content words. Phrases with equal sets are one
from the start, by a grouping; other pairs link at a Jaccard similarity of ``similar`` or more, and
linked phrases, directly or over others, are one.

The distinct sets of a group are one row, which is the size of the group's result, and are compared within it: no
self-join. Two sets can only be that similar if their sizes are and if they share a word among the first few of each in one
common order (prefix filter; by length, then alphabet: long words are the rare ones). Only such pairs are compared
in full.
"""

from __future__ import annotations

from oreleaf.functions import sqltext as Q

# Words that do not tell phrases apart.
FILLERS = ("a", "an", "and", "as", "at", "by", "for", "from", "in", "into", "of", "on", "or", "the", "to", "using", "via", "with")
SIMILAR = 0.8


def content_words(phrase: str) -> str:
    """SQL: the distinct content words of a normalised phrase in comparison order; all its words if it has no others."""
    words = f"array_distinct(filter(split({phrase}, ' '), w -> w <> ''))"
    fillers = "array({})".format(", ".join(f"'{w}'" for w in FILLERS))
    content = Q.let(words, lambda w: Q.let(f"array_except({w}, {fillers})", lambda c: f"if(size({c}) > 0, {c}, {w})"))
    return f"array_sort({content}, (a, b) -> CASE WHEN length(a) <> length(b) THEN length(b) - length(a) WHEN a < b THEN -1 WHEN a > b THEN 1 ELSE 0 END)"


def _links(sets: str, similar: float) -> str:
    """SQL: pairs (u, v) of places, u before v, of similar sets."""
    prefix = lambda w: f"slice({w}, 1, greatest(size({w}) - cast(ceil({similar} * size({w})) AS int) + 1, 1))"
    common = "size(array_intersect(a.words, b.words))"
    numbered = Q.each_indexed(sets, lambda w, i: Q.named_struct({"at": i, "n": f"size({w})", "words": w, "prefix": prefix(w)}))
    fits = (f"b.at > a.at AND a.n > 0 AND b.n > 0 AND least(a.n, b.n) >= {similar} * greatest(a.n, b.n) AND arrays_overlap(a.prefix, b.prefix)"
            f" AND {common} >= {similar} * (a.n + b.n - {common})")
    return Q.let(numbered, lambda each: (
        f"flatten(transform({each}, a -> transform(filter({each}, b -> {fits}), b -> named_struct('u', a.at, 'v', b.at))))"))


def first_of_each(firsts: str, similar: float = SIMILAR) -> str:
    """SQL: items of firsts(first STRUCT<row_idx, pos, item>, words) that are the first of their class, in order of mention."""
    def kept(found: str) -> str:
        # Each link moves the class of its later end, wherever it stands, to that of the earlier one.
        start = f"transform({found}, (x, i) -> i)"
        classes = f"aggregate({_links(f'transform({found}, x -> x.words)', similar)}, {start}, (now, e) -> transform(now, x -> if(x = get(now, e.v), get(now, e.u), x)))"
        return Q.let(classes, lambda c: f"transform(filter({found}, (x, i) -> array_position({c}, get({c}, i)) = i + 1), x -> x.first.item)")

    return Q.let(f"array_sort({firsts})", lambda found: f"if(size({found}) > 0, {Q.let(found, kept)}, cast(array() AS array<string>))")
