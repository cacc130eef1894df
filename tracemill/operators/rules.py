"""Decision rules as columns: fail-closed, three-valued."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def certification(integrity: Column, attested: Column, task: Column, validity: Column, scored: Column) -> Column:
    """REJECTED dominates INSUFFICIENT_EVIDENCE, which dominates CERTIFIED."""
    reject = (
        (integrity == "CORRUPT")
        | ((attested == "PASSED") & ((task != "SUCCESS") | (validity != "VALID")))
        | ((attested == "FAILED") & ((task == "SUCCESS") | (validity != "VALID")))
        | (attested.isin("ERROR", "TIMEOUT") & ((task == "SUCCESS") | scored))
    )
    lacks = (integrity == "PARTIAL") | (attested.isNull() & (task == "SUCCESS") & (validity == "VALID"))
    no = F.lit(False)
    return F.when(F.coalesce(reject, no), "REJECTED").when(F.coalesce(lacks, no), "INSUFFICIENT_EVIDENCE").otherwise("CERTIFIED")


def sft_eligible(certified: Column, attested: Column, task: Column, validity: Column, acted: Column) -> Column:
    ok = (certified == "CERTIFIED") & (attested == "PASSED") & (task == "SUCCESS") & (validity == "VALID") & acted
    return F.coalesce(ok, F.lit(False))


def recovery_action(code: Column, path: Column, cached: Column, candidates: Column, budget: Column) -> Column:
    """What to do about a failed read: leave it, stop, look for the file, read the one found, or stop."""
    return (
        F.when(~code.eqNullSafe(F.lit("FILE_NOT_FOUND")), "NO_ACTION")
        .when(path.isNull(), "TERMINATE")
        .when(~cached & (budget <= 0), "TERMINATE")
        .when(~cached, "DISCOVER")
        .when(candidates == 1, "READ")
        .otherwise("TERMINATE")
    )
