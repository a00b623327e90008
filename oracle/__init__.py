"""DuckDB oracle for the registered queries.

Each query has a core SELECT in ``oracle/sql/<name>.sql``, written
independently of the Spark builders from the reference's rules, over the
ERP table names. ``sql(name)`` puts in front of it the stand-in tables it
reads (the same SQL text the Spark side runs, ``tidewater.sources.standins``)
and wraps it with the value normalisation of ``tidewater.plans.queries``,
driven by the declared kinds of ``tidewater.plans.kinds``. A core may include
another core as ``{{q:name}}``.
"""

from __future__ import annotations

import re
from pathlib import Path

from tidewater.plans.kinds import KINDS
from tidewater.plans.queries import AS_OF
from tidewater.sources.catalog import standin_sql
from tidewater.sources.standins import STANDINS

SQL_DIR = Path(__file__).parent / "sql"

_CONVERT = {
    "t": "strftime({c}, '%Y-%m-%d %H:%M:%S')",
    "D": "strftime({c}, '%Y-%m-%d')",
    "d": "floor(CAST({c} AS DOUBLE) * 10000 + 0.5) / 10000",
    "i": "CAST({c} AS BIGINT)",
    "b": "CAST({c} AS BOOLEAN)",
    "s": "CAST({c} AS VARCHAR)",
}


def core(name: str) -> str:
    text = (SQL_DIR / f"{name}.sql").read_text()
    return re.sub(r"\{\{q:(\w+)\}\}", lambda m: core(m.group(1)), text)


def names() -> list[str]:
    return sorted(p.stem for p in SQL_DIR.glob("*.sql") if p.stem in KINDS)


def sql(name: str) -> str:
    body = core(name)
    needed = [t for t in STANDINS if re.search(rf"\b{t}\b", body)]
    ctes = ",\n".join(f"{t} AS ({standin_sql(t, AS_OF)[0]})" for t in needed)
    cols = ", ".join(_CONVERT[k].format(c=f'q."{col}"') + f' AS "{col}"' for col, k in KINDS[name])
    return f"WITH {ctes}\nSELECT {cols}\nFROM (\n{body}\n) AS q"
