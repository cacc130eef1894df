"""Tool calls in a model's text: tagged blocks and bare JSON objects."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from . import canonical

#: How a call is tagged.
BLOCK = re.compile(r"<tool_call>(.*?)</tool_call>", re.S)
_DECODER = json.JSONDecoder()


def _objects(text: str) -> Iterator[dict]:
    """JSON objects in tagged blocks, then those that start outside of any block, in order of their starts."""
    tagged = list(BLOCK.finditer(text))
    for block in tagged:
        try:
            yield json.loads(block[1])
        except (ValueError, RecursionError):
            continue
    bare = iter(m.start() for m in re.finditer(r"\{", BLOCK.sub(lambda m: " " * len(m[0]), text)))
    for start in bare:
        try:
            yield _DECODER.raw_decode(text, start)[0]
        except (ValueError, RecursionError):
            continue


def tool_calls(text: Column, allowed: tuple[str, ...]) -> Column:
    """array(name, arguments as JSON without blanks): calls of allowed tools whose arguments are an object that is not
    empty; what is malformed gives no call."""

    @F.pandas_udf("array<struct<name:string,arguments:string>>")
    def found(texts: pd.Series) -> pd.Series:
        def one(said: str | None) -> list[tuple[str, str]]:
            calls = []
            for x in _objects(said or ""):
                if isinstance(x, dict) and x.get("name") in allowed and isinstance(x.get("arguments", {}), dict) and x.get("arguments"):
                    calls.append((x["name"], canonical.whole(json.dumps(x["arguments"], ensure_ascii=False, separators=(",", ":")))))
            return calls

        return texts.map(one)

    return found(text)
