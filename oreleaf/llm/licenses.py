"""Licence scan: phrases and identifier tags by Aho-Corasick, expressions by shunting-yard.

Texts are lower-cased (A-Z) and cut into words; one automaton over the words of all
phrases finds every notice in one pass over the text. Lines that hold an SPDX tag are
also read as they stand: the expression behind the tag is turned to postfix order by a
shunting-yard parser (with binds before and, and before or) and evaluated.

Each licence has a freedom between 0 and 1 (how little it asks of who redistributes the
text). In an expression, `and` takes the smaller one, `or` the larger one (the choice is
ours), and `with` lifts the licence half-way to 1. What stands behind a tag is read up to where
it stops being an expression: at a quote, a full stop, a word of prose, a second operand; `/` is
`or`, as in package files. The score of a text is the smallest
value of its notices and expressions, 0.5 where it has none; an identifier that is not
known counts 0.25, an expression that cannot be parsed 0.

Defined results: a null text is the empty one, with no words and null places; repeated
rows are scanned each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreleaf.llm.common import slices, text_or_empty

# The base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
NOTICES = {
    "apache license": "apache",
    "mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "cc by nc": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0": "cc0",
    "creative commons": "creative-commons",
    "public domain": "public-domain",
}
FREEDOM = {
    "cc-by": 0.9, "gpl": 0.4, "reserved": 0.0, "apache": 0.95, "mit": 1.0, "bsd": 1.0, "mpl": 0.6, "lgpl": 0.5, "agpl": 0.3,
    "cc-by-nc": 0.2, "cc-by-sa": 0.5, "cc-by-nd": 0.2, "cc0": 1.0, "creative-commons": 0.5, "public-domain": 1.0, "isc": 1.0,
    "0bsd": 1.0, "afl": 0.95, "apsl": 0.6, "artistic": 0.8, "beerware": 1.0, "blueoak": 1.0, "bsl": 1.0, "busl": 0.1, "cddl": 0.6, "cecill": 0.4,
    "cpal": 0.5, "curl": 1.0, "ecl": 0.95, "elastic": 0.1, "epl": 0.6, "eupl": 0.5, "fsfap": 1.0, "ftl": 0.95, "gfdl": 0.4, "hpnd": 1.0,
    "icu": 1.0, "ijg": 0.95, "ipl": 0.6, "libpng": 1.0, "lppl": 0.8, "ms-pl": 0.8, "ms-rl": 0.6, "mulanpsl": 0.95, "ncsa": 1.0, "odbl": 0.5,
    "odc-by": 0.9, "ofl": 0.7, "openssl": 0.9, "osl": 0.4, "php": 0.9, "postgresql": 1.0, "psf": 0.95, "python": 0.95, "qpl": 0.5, "ruby": 0.8,
    "sissl": 0.6, "sspl": 0.1, "unicode": 1.0, "unlicense": 1.0, "upl": 1.0, "vim": 0.8, "w3c": 0.95, "wtfpl": 1.0, "x11": 1.0, "zlib": 1.0, "zpl": 0.95,
}
TAG = "spdx license identifier"
UNKNOWN, NOTHING, MALFORMED = 0.25, 0.5, 0.0

_SEPARATORS = bytes(set(range(0x00, 0x30)) | set(range(0x3A, 0x41)) | set(range(0x5B, 0x61)) | set(range(0x7B, 0x80)))
_TO_WORDS = bytes.maketrans(_SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B)))
_TAG_LINE = re.compile(r"spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)", re.IGNORECASE | re.ASCII)
_LEXEME = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
_OPENING = re.compile(r"[\s\"'`*<#!-]*")
_PART = re.compile(r"\s*([()/]|[A-Za-z0-9.+:-]+)")
_STRENGTH = {"or": 1, "and": 2, "with": 3}


def family(identifier: str) -> str | None:
    """The label of a licence identifier: the longest known name that its parts begin with."""
    name = identifier.lower().rstrip("+")
    known = [label for label in FREEDOM if name == label or name.startswith(label + "-")]
    return max(known, key=len, default=None)


def leading(line: str) -> str:
    """The longest beginning of the rest of a line that is an expression, without opening quotes; all of it if there is none."""
    first = at = _OPENING.match(line).end()
    end, depth, operand_next, exception = first, 0, True, False
    while part := _PART.match(line, at):
        shown = part[1].rstrip(".:")
        word = shown.lower()
        if not word or operand_next == (word in (")", "/", *_STRENGTH)):
            break
        if word == "(":
            depth += 1
        elif word == ")":
            depth -= 1
        elif operand_next:
            if not (exception or family(shown) or set(shown) & set("0123456789-+")):
                break
            operand_next = False
        else:
            operand_next = True
        exception = word == "with"
        at = part.end()
        if depth < 0:
            break
        if not operand_next and not depth:
            end = part.start(1) + len(shown)
        if len(shown) < len(part[1]):
            break
    return line[first:end].replace("/", " or ") or line.strip().strip("*/#<>-! ")


def postfix(expression: str) -> list[str]:
    """Operands and operators in postfix order (shunting-yard); raises ValueError if it is no expression."""
    if _LEXEME.sub("", expression).strip():
        raise ValueError(expression)
    out, waiting, operand_next = [], [], True
    for lexeme in _LEXEME.findall(expression):
        word = lexeme.lower()
        if word == "(":
            if not operand_next:
                raise ValueError(expression)
            waiting.append(word)
        elif word == ")":
            if operand_next:
                raise ValueError(expression)
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                raise ValueError(expression)
            waiting.pop()
        elif word in _STRENGTH:
            if operand_next:
                raise ValueError(expression)
            while waiting and waiting[-1] != "(" and _STRENGTH[waiting[-1]] >= _STRENGTH[word]:
                out.append(waiting.pop())
            waiting.append(word)
            operand_next = True
        else:
            if not operand_next:
                raise ValueError(expression)
            out.append(lexeme)
            operand_next = False
    if operand_next or "(" in waiting:
        raise ValueError(expression)
    return out + waiting[::-1]


def evaluated(expression: str) -> tuple[float, set[str]]:
    """Freedom of an expression and the labels of the licences in it."""
    values: list[float] = []
    labels: set[str] = set()
    try:
        steps = postfix(expression)
    except ValueError:
        return MALFORMED, {"malformed"}
    named: list[str | None] = []  # identifiers still waiting as operands: an exception behind `with` is no licence
    for step in steps:
        if step.lower() in _STRENGTH:
            right, left = values.pop(), values.pop()
            right_name, left_name = named.pop(), named.pop()
            if step.lower() == "with":
                values.append((1 + left) / 2)
                labels.update({family(left_name) or "other"} if left_name else ())
            else:
                values.append(min(left, right) if step.lower() == "and" else max(left, right))
                labels.update(family(name) or "other" for name in (left_name, right_name) if name)
            named.append(None)
        else:
            values.append(FREEDOM.get(family(step) or "", UNKNOWN))
            named.append(step)
    labels.update(family(name) or "other" for name in named if name)
    return values[0], labels


_automata: dict[tuple, ahocorasick.Automaton] = {}


def _automaton(phrases: dict[str, str]) -> ahocorasick.Automaton:
    key = tuple(sorted(phrases))
    if key not in _automata:
        found = ahocorasick.Automaton()
        for phrase in phrases:
            found.add_word(f" {phrase} ", phrase)
        found.make_automaton()
        _automata[key] = found
    return _automata[key]


def scanned(text: bytes) -> tuple[int, list[tuple[int, str]], list[str]]:
    """Words of a text, the places of phrases (word number, phrase), and the expressions behind tags."""
    words = text.translate(_TO_WORDS).split()
    joined = f" {b' '.join(words).decode('latin-1')} "
    places, counted, at, tagged = [], 0, 0, False
    for end, phrase in _automaton(BASE | NOTICES | {TAG: ""}).iter(joined):
        start = end - len(phrase) - 1
        if start >= at:
            counted, at = counted + joined.count(" ", at, start), start
            place = counted
        else:  # a longer phrase began before one that was already counted
            place = counted - joined.count(" ", start, at)
        tagged |= phrase == TAG
        if phrase != TAG:
            places.append((place, phrase))
    expressions = _TAG_LINE.findall(text.decode("utf-8", "replace")) if tagged else []
    return len(words), places, [leading(e) for e in expressions]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each of `docs`: words, places and labels of licence notices, expressions, score."""
    names = [id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "_text"):
                rows: list[tuple] = []
                for text in batch.column("_text").cast(pa.binary()).to_pylist():
                    n_words, places, expressions = scanned(text)
                    base = [place for place, phrase in places if phrase in BASE]
                    base_labels = {BASE[phrase] for _, phrase in places if phrase in BASE}
                    labels = base_labels | {NOTICES[phrase] for _, phrase in places if phrase in NOTICES}
                    score = min((FREEDOM[label] for label in labels), default=NOTHING if not expressions else 1.0)
                    for expression in expressions:
                        value, more = evaluated(expression)
                        score, labels = min(score, value), labels | more
                    rows.append((n_words, len(base), min(base, default=None), max(base, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, expressions))
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, kind) for x, kind in zip(zip(*rows), kinds))], names)

    given = docs.select(F.col(id_col), text_or_empty(text_col).alias("_text"))
    kind = given.schema[id_col].dataType.simpleString()
    return given.mapInArrow(run, f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, expressions array<string>")
