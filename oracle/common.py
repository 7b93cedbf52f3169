"""SQL snippets shared by the oracle texts (DuckDB dialect)."""


def errors(*rules: tuple[str, str]) -> str:
    """nullif(trim(CASE WHEN cond THEN 'CODE; ' ELSE '' END || ...), '')"""
    parts = " || ".join(f"CASE WHEN {cond} THEN '{code}; ' ELSE '' END" for code, cond in rules)
    return f"nullif(trim({parts}), '')"


def req(c: str, blank: bool = False) -> tuple[str, str]:
    cond = f"({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')" if blank else f"{c} IS NULL"
    return (f"ERR_REQUIRED_{c}", cond)


def clip(expr: str, n: int) -> str:
    return f"nullif(substr(trim(CAST({expr} AS VARCHAR)), 1, {n}), '')"


def first_text(*texts: str) -> str:
    """The first that is not blank."""
    return "coalesce(" + ", ".join(f"nullif(trim({t}), '')" for t in texts) + ")"


def final(src: str, cols: list[str], rules: list[tuple[str, str]], marker: dict | None = None,
          marker_probe: str | None = None, col_types: dict | None = None) -> str:
    """SELECT row_type, cols..., validation_errors FROM src  [+ marker row when empty]."""
    col_list = ", ".join(cols)
    body = (f"v AS (SELECT {col_list}, {errors(*rules) if rules else 'CAST(NULL AS VARCHAR)'} AS validation_errors FROM {src}),\n"
            f"f AS (SELECT CASE WHEN validation_errors IS NULL THEN 'CLEAN' ELSE 'ERROR' END AS row_type, "
            f"{col_list}, validation_errors FROM v)")
    out = body + "\nSELECT * FROM f"
    if marker is not None:
        col_types = col_types or {}
        vals = []
        for c in ["row_type", *cols, "validation_errors"]:
            v = marker.get(c)
            ty = col_types.get(c, "VARCHAR")
            vals.append(f"CAST({('NULL' if v is None else repr(v))} AS {ty}) AS {c}")
        probe = marker_probe or "f"
        out += f"\nUNION ALL SELECT {', '.join(vals)} WHERE NOT EXISTS (SELECT 1 FROM {probe})"
    return out


ACTIVE_YEARID = """
ay AS (
  SELECT coalesce(max(y) FILTER (WHERE y = {req}), max(y)) AS yearid FROM (SELECT floor(termid / 100) AS y FROM cc WHERE termid IS NOT NULL)
)"""

SECTION_YEAR = """
sy AS (SELECT max(t.yearid) AS active_yearid FROM sections sec JOIN terms t ON t.id = sec.termid)"""
