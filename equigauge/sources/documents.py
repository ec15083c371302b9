"""Reading one policy document. These functions run in tasks and are shipped with them, so they import nothing of ours."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd

#: What a property of a control is about; catalogues also list controls that only have labels.
MEASURED = ("metric_key", "operator", "threshold")
NESTED = ("implemented-requirements", "include-controls", "controls")
COLUMNS = ["policy_id", "kind", "requirement_id", "control_id", "title", "description", "props", "href", "warnings", "shape"]


def _as_props(entries: Iterable[dict]) -> tuple[dict[str, str], list[str]]:
    """Name/value pairs as a map. A repeated name keeps its last value and leaves a warning."""
    props: dict[str, str] = {}
    warnings: list[str] = []
    for entry in entries or []:
        name, value = str(entry["name"]), str(entry["value"])
        if name in props:
            warnings.append(f"duplicate_prop:{name}")
        props[name] = value
    return props, warnings


def _walk(node: object, policy: str, path: str) -> Iterator[tuple]:
    """Raw rows of a document: requirements, inline controls and inventory items, wherever they sit.

    The shape is the way of keys that leads there. Everything with a link or properties is a requirement, but for groups of others and catalogue entries that say nothing
    about a measure.
    """
    if isinstance(node, list):
        for i, item in enumerate(node):
            yield from _walk(item, policy, f"{path}/{i}")
        return
    if not isinstance(node, dict):
        return
    shape = re.sub(r"/\d+(?=/|$)", "", path).strip("/")
    name = shape.rsplit("/", 1)[-1]
    if name == "inventory-items":
        props, warnings = _as_props(node.get("props"))
        yield (policy, "item", node.get("uuid"), None, None, node.get("description"), props, None, warnings, shape)
        return
    if name in NESTED:
        props, warnings = _as_props(node.get("props"))
        hrefs = [str(link["href"]) for link in node.get("links") or [] if link.get("href")]
        control = node.get("control-id") or node.get("control_id") or node.get("id")
        measured = any(key.replace("-", "_") in MEASURED for key in props)
        group = name == "controls" or any(key in node for key in NESTED)
        if hrefs or measured or (props and not group):
            base = node.get("uuid") or f"{control}@{path.strip('/')}"
            for k, href in enumerate(hrefs or [None]):
                key = base if k == 0 else f"{base}#{k}"
                yield (policy, "requirement", key, control, node.get("title"), node.get("description"), props, href, warnings, shape)
    for key, child in node.items():
        if isinstance(child, (dict, list)) and key not in ("props", "links", "metadata", "risks"):
            yield from _walk(child, policy, f"{path}/{key}")


def _rows_of(text: str, policy: str) -> list[tuple]:
    try:
        import yaml
    except ImportError as error:  # pragma: no cover
        raise RuntimeError("reading policy documents needs PyYAML") from error
    return list(_walk(yaml.safe_load(text) or {}, policy, ""))


def parse_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [r for text, policy in zip(batch["value"], batch["policy_id"]) for r in _rows_of(text, policy)]
        yield pd.DataFrame(rows, columns=COLUMNS)
