"""Prompt wording per schema. ``{document_text}``, ``{row_json}`` and ``{batch_json}`` are slots."""

from __future__ import annotations

_SUBJECT = {
    "catalyst": "layered double hydroxide (LDH) catalysts",
    "adsorption": "layered double hydroxide (LDH) adsorbents",
    "usecase": "layered double hydroxide (LDH) materials and their applications",
}
_ONE_ROW = {
    "catalyst": "one material under one reaction condition with the performance measured there; give every "
                "distinct temperature, pressure and feed its own row",
    "adsorption": "one material under one adsorption condition with the uptake measured there; give every "
                  "distinct temperature, pressure, gas and humidity its own row",
    "usecase": "one distinct material; collect all its applications as short role and target phrases in `use_cases`",
}
_SAME = {
    "catalyst": "material, composition, reaction condition and measured performance",
    "adsorption": "material, composition, adsorption condition and measured capacity",
    "usecase": "material and composition",
}
_EXTRA_VERIFY = {
    "catalyst": "", "adsorption": "",
    "usecase": " Add applications that the paper reports and `use_cases` lacks.",
}
_EXTRA_BATCH = {
    "catalyst": "", "adsorption": "",
    "usecase": " Unite their `use_cases` and keep one wording of each.",
}


def _extract(name: str) -> str:
    return (
        f"The paper below reports on {_SUBJECT[name]}. Answer with a JSON object whose `rows` list holds "
        f"{_ONE_ROW[name]}. Go through every line of every table. Use null for a value and [] for a list "
        "that the paper does not give, and add nothing of your own.\n\n<paper>\n{document_text}\n</paper>"
    )


def _verify(name: str) -> str:
    return (
        f"Check one extracted row on {_SUBJECT[name]} against its paper. Answer with that single row, for the "
        "same material and condition. Change a value only where the paper states another one."
        f"{_EXTRA_VERIFY[name]}\n\n<row>\n{{row_json}}\n</row>\n\n<paper>\n{{document_text}}\n</paper>"
    )


def _batch(name: str) -> str:
    return (
        f"These rows on {_SUBJECT[name]} come from one paper. Rows equal in {_SAME[name]} are repeats: merge "
        f"each set of repeats into its most complete row.{_EXTRA_BATCH[name]} Keep all other rows as they are "
        "and answer with a JSON object with the list `rows`.\n\n<rows>\n{batch_json}\n</rows>"
    )


EXTRACT = {name: _extract(name) for name in _SUBJECT}
VERIFY = {name: _verify(name) for name in _SUBJECT}
BATCH = {name: _batch(name) for name in _SUBJECT}
