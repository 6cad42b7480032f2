"""Replies of a judge: fences, the first JSON object, and why a reply is malformed.

Brace matching that knows strings is not regular, so it runs as an Arrow-batched pandas function.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_FENCE = re.compile(r"^```(?:json)?\s*(.*?)\s*```$", re.DOTALL)
_STEP = re.compile(r'[{}"]|\\.|\\$', re.DOTALL)


def first_object(text: str) -> str | None:
    """The first balanced {...}; braces within strings do not count."""
    begin = text.find("{")
    depth, quoted = 0, False
    if begin < 0:
        return None
    for step in _STEP.finditer(text, begin):
        sign = step.group()
        if sign[0] == "\\":
            if not quoted and len(sign) > 1 and sign[1] in '{}"':
                # outside a string a backslash means nothing: its follower counts
                quoted ^= sign[1] == '"'
                depth += (sign[1] == "{") - (sign[1] == "}")
        elif sign == '"':
            quoted = not quoted
        elif not quoted:
            depth += 1 if sign == "{" else -1
        if depth == 0 and not quoted and sign[-1] == "}":
            return text[begin : step.end()]
    return None


def parsed(reply: str | None) -> tuple[str | None, str | None]:
    """(object as JSON, None) or (None, reason)."""
    text = (reply or "").strip()
    if fence := _FENCE.match(text):
        text = fence.group(1).strip()
    found = first_object(text)
    if found is None:
        return None, "no_json_object_found"
    try:
        json.loads(found)
    except json.JSONDecodeError as error:
        return None, f"json_parse_error: {error}"
    return found, None


def parse_response(reply: Column | str) -> Column:
    """struct of object (JSON text) and reason; one of them is null."""


    def run(replies: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parsed(r) for r in replies], columns=["object", "reason"])

    return F.pandas_udf(run, "object string, reason string")(reply)
