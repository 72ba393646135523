"""Fields of one Avro schema document (a small JSON text)."""

from __future__ import annotations

import json


def schema_field_rows(document: str | None) -> list[tuple[str, str, str | None]]:
    """(dotted name, type, description) of a schema's leaf fields, in order.

    A field's union stands for its first branch that is not null; records are
    descended into to any depth, whether written in place or named earlier;
    arrays, maps, enums, fixed and primitive types are leaves, and so is a
    record inside itself. A root that is no record is one row ``value``. A
    null document has no fields.
    """
    if document is None:
        return []
    named: dict[str, tuple[dict, str]] = {}

    def resolve(t, space: str) -> tuple[object, str]:
        """Definition of a type and the namespace names in it are read in."""
        while isinstance(t, dict) and isinstance(t.get("type"), (dict, list)):
            t = t["type"]
        if isinstance(t, str):
            return named.get(t if "." in t else f"{space}.{t}" if space else t, (named.get(t, (t, space))[0], space))
        if isinstance(t, dict) and "name" in t and t.get("type") in ("record", "error", "enum", "fixed"):
            name = t["name"]
            space = name.rpartition(".")[0] or t.get("namespace", space)
            full = name if "." in name else f"{space}.{name}" if space else name
            named.setdefault(full, (t, space))
        return t, space

    def name_of(t) -> str:
        return "union" if isinstance(t, list) else t["type"] if isinstance(t, dict) else t

    root = json.loads(document) if document.lstrip()[:1] in ("{", "[", '"') else document.strip()
    root, space = resolve(root, "")
    if name_of(root) not in ("record", "error"):
        return [("value", name_of(root), None)]
    out: list[tuple[str, str, str | None]] = []
    todo = [(f, "", space, (id(root),)) for f in reversed(root["fields"])]
    while todo:
        field, prefix, space, inside = todo.pop()
        t, own = resolve(field["type"], space)
        if isinstance(t, list):
            t, own = resolve(next((x for x in t if x != "null"), t), space)
        name = prefix + field["name"]
        if name_of(t) in ("record", "error") and id(t) not in inside:
            todo += [(f, name + ".", own, (*inside, id(t))) for f in reversed(t["fields"])]
        else:
            out.append((name, name_of(t), field.get("doc") or ""))
    return out
