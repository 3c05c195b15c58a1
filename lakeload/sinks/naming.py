"""Names of load targets: by default a table is named like its source object, in a namespace like its source schema."""

from __future__ import annotations

NAMINGS = ("keep", "lower")


def target_parts(source: str, table: str | None = None, namespace: str | None = None, naming: str = "keep",
                 need_namespace: bool = False) -> list[str]:
    """The parts of a target's name.  ``source`` is ``object`` or ``schema.object``; ``table`` and ``namespace``
    (dots separate its levels) replace what follows from it.  ``naming='lower'`` puts all in lower case, for catalogs that
    know no other; ``need_namespace`` refuses a name without one."""
    if naming not in NAMINGS:
        raise ValueError(f"naming is one of {NAMINGS}")
    schema, _, name = source.strip().rpartition(".")
    levels = [p.strip() for p in (namespace if namespace is not None else schema).split(".") if p.strip()]
    last = (table or name).strip()
    if not last:
        raise ValueError(f"no object name in {source!r}")
    if need_namespace and not levels:
        raise ValueError("this catalog needs a namespace: pass namespace= or a source with its schema")
    parts = [*levels, last]
    return [p.lower() for p in parts] if naming == "lower" else parts


def target_name(source: str, base: str | None = None, **options) -> str:
    """The target of a load: a folder under ``base`` when that is a path, else a catalog identifier (under the catalog
    ``base``, when given); parts that are no plain identifiers are quoted."""
    parts = target_parts(source, **options)
    if base is not None and "/" in base:
        return "/".join([base.rstrip("/"), *parts])
    quoted = [p if p.replace("_", "a").isalnum() and p.isascii() else "`" + p.replace("`", "``") + "`" for p in parts]
    return ".".join([base, *quoted] if base else quoted)
