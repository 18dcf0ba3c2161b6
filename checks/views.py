"""The ``fx_*`` views as DuckDB common table expressions, written as FIXTURES.md states them."""

import re
from pathlib import Path

_DOC = Path(__file__).resolve().parent.parent / "FIXTURES.md"


def _from_document() -> dict[str, str]:
    """FIXTURES.md is the definition of the views: take each SQL block under its heading."""
    found = re.findall(r"^### `(fx_\w+)`\n\n```sql\n(.*?)```", _DOC.read_text(), re.S | re.M)
    return {name: re.sub(r"EPOCH\((\w+)\)", r"CAST(floor(epoch(\1)) AS BIGINT)", sql.strip()) for name, sql in found}


VIEWS = _from_document()


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it mentions."""
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", sql)]
    if not used:
        return sql.strip()
    ctes = ",\n".join(f"{v} AS (\n{VIEWS[v]}\n)" for v in used)
    body = sql.strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(start):
            return f"{start}{ctes},\n{body[len(start):]}"
    return f"WITH {ctes}\n{body}"
