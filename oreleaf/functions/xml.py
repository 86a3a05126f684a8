"""XML fragments: cutting elements out of a document and reading their text.

SQL text in, SQL text out (see :mod:`oreleaf.functions.sqltext`).
"""

from __future__ import annotations

from oreleaf.functions import sqltext as Q

TEI_NAMESPACE = "http://www.tei-c.org/ns/1.0"

# Stand-ins (private-use characters) for the five predefined XML entities while
# a fragment is being cut and parsed: a literal "<" in the text must survive
# several passes of from_xml without turning into a tag.
_STAND_INS = [
    ("&", "\ue000", r"&(?:amp|#0*38|#[xX]0*26);"),
    ("<", "\ue001", r"&(?:lt|#0*60|#[xX]0*3[cC]);"),
    (">", "\ue002", r"&(?:gt|#0*62|#[xX]0*3[eE]);"),
    ('"', "\ue003", r"&(?:quot|#0*34|#[xX]0*22);"),
    ("'", "\ue004", r"&(?:apos|#0*39|#[xX]0*27);"),
]
_STAND_IN_CHARS = "".join(s for _, s, _ in _STAND_INS)
_LITERAL_CHARS = "".join(c for c, _, _ in _STAND_INS)
_STAND_IN_BYTES = "X'EE80'"  # all stand-ins, and no character but U+E000 to U+E03F, begin with these in UTF-8
_BOUND_PREFIX = r"xmlns:([\w.-]+)\s*=\s*[\x22\x27]" + TEI_NAMESPACE.replace(".", r"\.")


def from_xml(xml: str, fields: str) -> str:
    # Blanks around values are kept; stripping is always explicit.
    return f"from_xml({xml}, '{fields}', map('ignoreSurroundingSpaces', 'false'))"


def _escape_cdata(xml: str) -> str:
    def piece(part: str, i: str) -> str:
        escape = lambda s: f"replace(replace(replace({s}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
        inside = Q.let(f"substring_index({part}, ']]>', 1)",
                       lambda s: f"concat({escape(s)}, substring({part}, length({s}) + 4))")
        return f"if({i} = 0, {part}, {inside})"

    sections = f"split({xml}, {Q.literal(r'<!\[CDATA\[')})"
    return f"array_join({Q.each_indexed(sections, piece)}, '')"


def _drop_prolog(xml: str) -> str:
    return Q.replace_all(xml, r"(?s)^(?:\s|\x{FEFF}|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^>\[]*>)+", "")


def _mark_comments(xml: str) -> str:
    return Q.replace_all(Q.replace_all(xml, r"(?s)<!--.*?-->|<\?.*?\?>", "<_/>"), r"(?:<_/>|\s)+$", "")


def _drop_prefix(xml: str) -> str:
    drop = lambda p: f"replace(replace({xml}, concat('<', {p}, ':'), '<'), concat('</', {p}, ':'), '</')"
    return Q.let(Q.extract(xml, _BOUND_PREFIX, 1), lambda p: f"if({p} = '', {xml}, {drop(p)})")


def _protect_entities(xml: str) -> str:
    for _, stand_in, pattern in _STAND_INS:
        xml = Q.replace_all(xml, pattern, stand_in)
    return xml


def normalise_tei(xml: str) -> str:
    """Bring a well-formed TEI string into the form the fragment helpers expect.

    CDATA becomes escaped text; comments and processing instructions become an
    empty marker element (they end a text node but hold no text); a prefix bound
    to the TEI namespace is dropped; the predefined entities become stand-ins.
    A step runs only on the documents that contain what it replaces.
    """
    steps = [
        (("<![CDATA[",), _escape_cdata),
        ((), _drop_prolog),
        (("<!--", "<?"), _mark_comments),
        (("xmlns:",), _drop_prefix),
        (("&",), _protect_entities),
    ]

    def guarded(needles, step):
        return lambda x: f"if({' OR '.join(f'contains({x}, {Q.literal(n)})' for n in needles)}, {step(x)}, {x})"

    for needles, step in steps:
        xml = Q.let(xml, guarded(needles, step)) if needles else step(xml)
    return xml


def restore_entities(value: str) -> str:
    # Both kinds of quotes occur here, so they are written as escapes.
    chars = _LITERAL_CHARS.replace("'", "\\'")
    # translate makes a string of every character, so it is kept to the few texts with a stand-in.
    return Q.bind(value, lambda v: f"if(contains(cast({v} AS binary), {_STAND_IN_BYTES}), "
                                   f"translate({v}, '{_STAND_IN_CHARS}', '{chars}'), {v})")


def element_text(inner_xml: str) -> str:
    """All descendant text nodes of an element joined by one space, stripped.

    ``inner_xml`` is the element's content as from_xml returns it for a STRING
    field. Adjacent tags form a single text-node boundary.
    """
    spaced = lambda x: f"if(contains({x}, '<'), {Q.replace_all(x, r'(?:<[^>]*>)+', ' ')}, {x})"
    return f"coalesce({restore_entities(Q.strip(Q.bind(inner_xml, spaced)))}, '')"


def leading_text(inner_xml: str) -> str:
    """The text before an element's first child, unstripped."""
    return restore_entities(f"substring_index({inner_xml}, '<', 1)")


def _depths(pieces: str) -> str:
    """Nesting depth after each piece's own tag."""
    step = lambda s: f"if(startswith({s}, '</'), -1, if(startswith({s}, '<'), 1, 0))"
    return Q.fold(pieces, Q.empty("array<int>"), lambda acc, s:
                  f"array_append({acc}, coalesce(get({acc}, size({acc}) - 1), 0) + {step(s)})")


def _elements(xml: str, tag: str, body) -> str:
    """Apply ``body(pieces, depths)`` to the span of every ``tag`` element in document order.

    A span runs from the element's opening tag up to the piece before its
    closing tag.
    """
    def build(pieces: str, depth: str) -> str:
        def one(piece: str, i: str) -> str:
            close = f"cast(array_position(slice({depth}, {i} + 2, size({depth})), get({depth}, {i}) - 1) AS int)"
            span = Q.let(f"if({close} > 0, {close}, size({depth}))", lambda n: body(
                f"slice({pieces}, {i} + 1, {n})", f"slice({depth}, {i} + 1, {n})"))
            return f"if(startswith({piece}, '<') AND NOT startswith({piece}, '</'), {span}, NULL)"

        return Q.keep(Q.each_indexed(pieces, one), lambda s: f"{s} IS NOT NULL")

    # Pieces start at an opening or a closing tag of this element; the leading
    # blank keeps the text before the first tag from looking like one.
    def found(x: str) -> str:
        paired = f"if(contains({x}, '/>'), {Q.replace_all(x, rf'<{tag}((?:\s[^<>]*)?)/>', rf'<{tag}$1></{tag}>')}, {x})"
        # The tags are marked and cut at the marks: a split at a lookahead would try it at every character. U+0001 is in no XML.
        marked = rf"regexp_replace(concat(' ', {paired}), {Q.literal(rf'</?{tag}[\s>]')}, '\u0001$0')"
        pieces = rf"split({marked}, '\u0001')"
        cut = Q.bind(pieces, lambda p: Q.bind(_depths(p), lambda d: build(p, d)))
        return f"if(contains({x}, '<{tag}'), {cut}, {Q.empty('array<string>')})"

    return Q.bind(xml, found)


def elements(xml: str, tag: str) -> str:
    """Every ``tag`` element at any depth, in document order, with its full content."""
    return _elements(xml, tag, lambda pieces, depth: f"concat(array_join({pieces}, ''), '</{tag}>')")


def own_content(xml: str, tag: str) -> str:
    """As :func:`elements`, but without the nested elements of the same tag."""
    def body(pieces: str, depth: str) -> str:
        own = Q.keep_indexed(pieces, lambda s, k: f"get({depth}, {k}) = get({depth}, 0)")
        texts = Q.each(own, lambda s: f"if(startswith({s}, '</'), {Q.replace_all(s, rf'^</{tag}\s*>', '')}, {s})")
        return f"concat(array_join({texts}, ''), '</{tag}>')"

    return _elements(xml, tag, body)


def child_fields(xml: str, tag: str, fields: str) -> str:
    """Every ``tag`` element at any depth, parsed into ``fields``."""
    return Q.each(elements(xml, tag), lambda e: from_xml(e, fields))


def first_child(xml: str, tag: str, child: str, child_type: str = "STRING") -> str:
    """The first direct ``child`` of a ``tag`` element, in document order."""
    found = Q.each(child_fields(xml, tag, f"{child} ARRAY<{child_type}>"),
                   lambda e: Q.or_empty(f"{e}.{child}", f"ARRAY<{child_type}>"))
    return f"get(flatten({found}), 0)"


def content(element: str, tag: str) -> str:
    """The content of an element that was cut out."""
    return f"{from_xml(f'''concat('<r>', {element}, '</r>')''', f'{tag} STRING')}.{tag}"
