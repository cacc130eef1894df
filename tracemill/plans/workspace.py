"""Queries on workspaces, drawn from pages: a page is a file of the workspace of its number's last digit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import workspace
from ..sources import tables
from .catalog import query

#: A budget that some files of every workspace exceed.
MOST_FILES, MOST_BYTES = 600, 150_000


@query(f"""with recursive f as (select page_id % 5 as workspace, 'd' || page_id % 7 || '/' || page_id as path, octet_length(encode(coalesce(html, ''))) as size, sha256(coalesce(html, '')) as sha256 from pages),
 n as (select *, row_number() over (partition by workspace order by path) as i, count(*) over (partition by workspace) as files from f),
 fold as (select workspace, 0::bigint as i, {MOST_BYTES}::bigint as rest, false as retained from n where i = 1
  union all select n.workspace, n.i, case when n.size <= rest then rest - n.size else rest end, n.size <= rest from fold join n on n.workspace = fold.workspace and n.i = fold.i + 1 where n.i <= {MOST_FILES})
select n.workspace, path, size, sha256, retained, case when retained then sha256 end as content_sha256, files <= {MOST_FILES} and bool_and(retained) over (partition by n.workspace) as complete from n join fold on fold.workspace = n.workspace and fold.i = n.i""")
def workspace_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's digest, and its content as far as its workspace's budget goes."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    number = F.col("page_id")
    files = tables.read(spark, sf_dir, "pages").select(
        (number % 5).alias("workspace"), F.concat(F.lit("d"), (number % 7).cast("string"), F.lit("/"), number.cast("string")).alias("path"), F.length(html).cast("long").alias("size"), F.sha2(html, 256).alias("sha256"), html.alias("content")
    )
    kept, _, workspaces = workspace.snapshot(files, MOST_FILES, MOST_BYTES)
    return kept.join(workspaces, "workspace").select("workspace", "path", "size", "sha256", "retained", F.sha2("content", 256).alias("content_sha256"), "complete")
