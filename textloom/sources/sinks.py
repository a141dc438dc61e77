"""Report and metadata sinks: small results as JSON, a trend page, text with a sidecar."""

from __future__ import annotations

import html
import json
import math
import os
from typing import Any

from pyspark.sql import DataFrame, Row

from ..runtime import local_path


def _plain(x: Any) -> Any:
    if isinstance(x, float) and math.isnan(x):
        return "NA"
    return x.asDict(recursive=True) if hasattr(x, "asDict") else x


def _dictionary(row: Row) -> dict:
    return {k: _plain(v) for k, v in row.asDict(recursive=True).items()}


def rows(df: DataFrame) -> list[dict]:
    """The rows of a result of bounded size (a summary, a top-k list) as dictionaries."""
    return [_dictionary(r) for r in df.collect()]


def write_json(report: dict, path: str, overwrite: bool = True) -> None:
    """The report as a JSON object, through a temporary name. A value may be a DataFrame of any length: its rows become a list, in order, and
    pass the driver a partition at a time."""
    if not overwrite and os.path.exists(path):
        raise FileExistsError(path)
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    part = f"{path}.incomplete"
    with open(part, "w", encoding="utf-8") as f:
        f.write("{")
        for i, (key, value) in enumerate(report.items()):
            f.write(f"{',' * (i > 0)}\n  {json.dumps(key)}: ")
            if isinstance(value, DataFrame):
                f.write("[")
                for n, row in enumerate(value.toLocalIterator()):
                    f.write(f"{',' * (n > 0)}\n    {json.dumps(_dictionary(row))}")
                f.write("\n  ]")
            else:
                f.write(json.dumps(value, indent=2).replace("\n", "\n  "))
        f.write("\n}\n")
    os.replace(part, path)


def write_trend_page(trend: DataFrame, columns: list[str], page: str, summary: str, last: int = 200) -> dict:
    """An HTML table of the last rows by step, and a JSON summary of the newest."""
    shown = rows(trend.orderBy("step", ascending=False).limit(last).select(*columns))[::-1]
    cells = "".join("<tr>" + "".join(f"<td>{html.escape(str(r[c]))}</td>" for c in columns) + "</tr>" for r in shown)
    head = "".join(f"<th>{html.escape(c)}</th>" for c in columns)
    os.makedirs(os.path.dirname(page) or ".", exist_ok=True)
    with open(page, "w", encoding="utf-8") as f:
        f.write(f"<!doctype html><meta charset=utf-8><table><tr>{head}</tr>{cells}</table>")
    out = {"rows": len(shown), "latest_step": shown[-1]["step"] if shown else None, "latest": shown[-1] if shown else None}
    write_json(out, summary)
    return out


def write_text(df: DataFrame, folder: str, text: str, meta: dict, append: bool = False) -> None:
    """Text lines with a ``.meta.json`` beside them; an existing folder is refused unless ``append``."""
    df.select(df[text].alias("value")).write.mode("append" if append else "errorifexists").text(folder)
    write_json(meta, local_path(folder).rstrip("/") + ".meta.json")
