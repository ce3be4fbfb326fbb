"""Turns the text of one framework document into rows, inside a task."""

from __future__ import annotations

from itertools import batched

import pandas as pd
import yaml

Loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
FIELDS = ("label", "desc", "prefix")
COLUMNS = [
    "framework", "path", "section_ord", "section", "node_nums", "node_titles", "node_prefixes",
    "n", "label", "desc", "prefix", "pos",
]
#: Rows that leave a task at a time.
ROWS_AT_ONCE = 4096


def _value(node: dict, key: str) -> str:
    found = node.get(key)
    return "" if found is None else str(found)


def item_numbers(node: dict) -> list[int]:
    """Numbers of the items that a node holds itself."""
    pieces = (key.split("_") for key in node if isinstance(key, str))
    return sorted({int(p[0]) for p in pieces if len(p) > 1 and p[0].isdecimal() and p[1] in FIELDS})


def section_items(section: dict):
    """Yields (numbers, titles, prefixes, n, label, desc, prefix) of a section."""
    open_nodes = [(section, [], [_value(section, "title").strip()], [_value(section, "prefix").strip()])]
    while open_nodes:
        node, nums, titles, prefixes = open_nodes.pop()
        for n in item_numbers(node):
            yield (nums, titles, prefixes, n, *(_value(node, f"{n}_{field}") for field in FIELDS))
        for num, child in node.items():
            if isinstance(num, int) and isinstance(child, dict):
                title, prefix = _value(child, "title").strip(), _value(child, "prefix").strip()
                open_nodes.append((child, [*nums, num], [*titles, title], [*prefixes, prefix]))


def document_rows(framework: str, path: str, content: str):
    """Item rows in document order; `pos` numbers those that have a label or a description."""
    sections, pos = yaml.load(content, Loader) or {}, 0
    for place, (key, section) in enumerate(sections.items()):
        if not isinstance(section, dict):
            continue
        for item in sorted(section_items(section), key=lambda x: (x[0], x[3])):
            filled = bool(item[4].strip() or item[5].strip())
            yield (framework, path, place, str(key), *item, pos if filled else -1)
            pos += filled


def decode_batches(batches):
    for batch in batches:
        for document in batch.itertuples(index=False):
            for rows in batched(document_rows(*document), ROWS_AT_ONCE):
                yield pd.DataFrame(list(rows), columns=COLUMNS)
