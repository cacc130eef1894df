"""Paths and commands with the workspace's place taken out, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORKSPACE = "$WORKSPACE"
#: A harness's tools and what they are called in the canonical form.
TOOLS = {
    "read": "read_file", "grep": "search_code", "find": "search_code", "ls": "list_directory", "bash": "run_command", "edit": "edit_file", "write": "write_file",
    "glob": "search_code", "finish": "finish",
}


def normal(path: Column) -> Column:
    """A path without empty, . and resolvable .. parts; . if nothing is left."""
    absolute = path.startswith("/")
    parts = F.filter(F.split(path, "/"), lambda x: (x != "") & (x != "."))

    def step(done: Column, part: Column) -> Column:
        stuck = (done == "") | done.rlike(r"(^|/)\.\.$")
        up = F.when(~stuck, F.regexp_replace(done, r"/?[^/]+$", "")).when(absolute, done).otherwise(F.concat(done, F.when(done == "", "..").otherwise("/..")))
        return F.when(part == "..", up).otherwise(F.concat(done, F.when(done == "", part).otherwise(F.concat(F.lit("/"), part))))

    whole = F.aggregate(parts, F.lit(""), step)
    return F.when(absolute, F.concat(F.lit("/"), whole)).when(whole == "", ".").otherwise(whole)


def relative(path: Column, root: str) -> Column:
    """struct(path, lossy): relative to the workspace where it lies in it, as it is and lossy where not."""
    root = root.rstrip("/")
    home = path.startswith("~/") | (path == "~")
    clean = normal(path)
    inside = F.substring(clean, len(root) + 2, 1 << 30)
    told = (
        F.when(path == "", F.struct(path.alias("path"), F.lit(False).alias("lossy")))
        .when(home, F.struct(path.alias("path"), F.lit(True).alias("lossy"))).when(~path.startswith("/"), F.struct(clean.alias("path"), F.lit(False).alias("lossy")))
        .when(clean == root, F.struct(F.lit(".").alias("path"), F.lit(False).alias("lossy"))).when(clean.startswith(root + "/"), F.struct(inside.alias("path"), F.lit(False).alias("lossy")))
    )
    return told.otherwise(F.struct(path.alias("path"), F.lit(True).alias("lossy")))


def command(text: Column, root: str) -> Column:
    """struct(command, lossy): from the workspace's first occurrence on with a neutral name for it; lossy if other
    absolute paths are named."""
    root = root.rstrip("/")
    words = F.filter(F.split(F.translate(text, "=\n", "  "), r"\s+"), lambda w: w.startswith("/"))
    tail = text.substr(F.instr(text, root) + len(root), F.lit(1 << 30))
    rest = F.when(tail.startswith("/"), F.concat(F.when(F.ltrim(tail, F.lit("/")) == "", "").otherwise("/"), F.ltrim(tail, F.lit("/")))).otherwise(tail)
    found = F.struct(F.concat(F.lit(WORKSPACE), rest).alias("command"), F.exists(words, lambda w: ~w.startswith(root)).alias("lossy"))
    return F.when(text.contains(root), found).otherwise(F.struct(text.alias("command"), F.exists(words, lambda w: ~w.startswith("/dev/")).alias("lossy")))


def tool(name: Column) -> Column:
    """The canonical name of a tool; null for one that is not known."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in TOOLS.items() for x in kv]), name)
