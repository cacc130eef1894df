"""Canonical JSON, digests and redaction; Python where byte-exact JSON needs it, in Arrow batches."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys whose values are never kept, in lower case with underscores.
SECRET_KEYS = frozenset(
    "authorization api_key apikey cookie password proxy_authorization secret token access_token refresh_token thinking_signature text_signature thinkingsignature textsignature thinking".split()
)
#: What a path of the host begins with; a text that has the workspace's name is taken as cleaned.
HOST_MARKERS = ("/home/", "/homePLUS", "/Users/", "/root/", "/tmp/")
WORKSPACE = "$WORKSPACE"
REDACTED = "[REDACTED]"


_LONE = re.compile("[\ud800-\udfff]")


def whole(text: str) -> str:
    """JSON text with halves of surrogate pairs, which no UTF-8 has, escaped."""
    return _LONE.sub(lambda m: f"\\u{ord(m[0]):04x}", text)


def dumped(value: object) -> str:
    """Sorted keys, no blanks."""
    return whole(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False))


def _canonical(text: str | None) -> str | None:
    # Nesting beyond what the reader takes counts as no JSON.
    try:
        return None if text is None else dumped(json.loads(text))
    except (ValueError, RecursionError):
        return None


@F.pandas_udf(T.StringType())
def canonical_json(texts: pd.Series) -> pd.Series:
    """Sorted keys, no blanks, no NaN; null for what is no JSON."""
    return texts.map(_canonical)


def sha256_json(text: Column) -> Column:
    return F.sha2(canonical_json(text), 256)


def _redacted(text: str) -> str:
    """JSON with the values of secret keys replaced at any depth; an explicit stack, as logs may nest deeply."""
    top = [json.loads(text)]
    open_ = [top]
    while open_:
        held = open_.pop()
        for key in list(held) if isinstance(held, dict) else range(len(held)):
            if isinstance(key, str) and key.lower().replace("-", "_") in SECRET_KEYS:
                held[key] = REDACTED
            elif isinstance(held[key], (dict, list)):
                open_.append(held[key])
    return dumped(top[0])


@F.pandas_udf(T.StringType())
def redacted_json(texts: pd.Series) -> pd.Series:
    """Canonical JSON with the values of secret keys replaced; null for what is no JSON."""

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else _redacted(text)
        except (ValueError, RecursionError):
            return None

    return texts.map(one)


def host_markers(text: Column, markers: tuple[str, ...] = HOST_MARKERS) -> Column:
    """The host markers that a text has, each after a blank; none if it has the workspace's name. A site names its own addresses and
    folders beside the general ones."""
    found = F.concat(*[F.when(text.contains(m), F.lit(f" {m}")).otherwise("") for m in markers])
    return F.when(text.contains(WORKSPACE), "").otherwise(found)


def token_count(text: Column) -> Column:
    """Runs of non-blank characters."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != ""))


def cap_text(text: Column, most: int = 2000) -> Column:
    """Long texts keep their first and last characters and say between these how many more there were."""
    marker = F.concat(F.lit("\n...[+"), (F.length(text) - most).cast("string"), F.lit(" chars truncated]...\n"))
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most // 2)), marker, F.right(text, F.lit(most // 2)))).otherwise(text)
