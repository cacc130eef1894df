"""The registered queries of this subpackage, with their SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontamination, divergence, fingerprints, host_rules, html_text, licenses, mixing, neardup, quality, runs, substrings, warc
from .sql import ORACLE_SQL  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to source weights 1, 2, 3, repeating."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to WARC archives, normalised and read back."""
    return warc.read_archives(warc.archive(table(spark, sf_dir, "pages")))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of all documents and of their edited texts, and their likeness."""
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 50-byte strings that start in a document of smaller doc_id."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the trick conversation, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.read_back(chat.format_conversations(rows.unionByName(chat.trick_conversation(spark)))))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored for quality."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against all benchmark items, in windows of ten words."""
    found = decontamination.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("items")


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' near-duplicate components at 85 in 100 of five-word shingles."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), 85)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licenses of all documents, stated or inherited from a license file of their directory."""
    return licenses.scan(licenses.placed(table(spark, sf_dir, "documents")), "doc_id")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by rules of their own and by those of their source."""
    found = host_rules.judge(table(spark, sf_dir, "documents"), "source")
    return found.drop("n_lines").withColumn("host_rate", F.round("host_rate", 6))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source of every language against the others, and its most telling terms."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of words of all documents."""
    return runs.periodic_runs(table(spark, sf_dir, "documents"))


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op1_mixing is not drawn: sizes and targets."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 4).alias("target"))


def fingerprint_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op3_fingerprints is no sketch: lengths and digests of the edited texts."""
    return fingerprints.edits(table(spark, sf_dir, "documents")).select("doc_id", "n_chars", "edited_sha256")


QUERIES = {
    "mixing_targets": mixing_targets,
    "fingerprint_edits": fingerprint_edits,
    "op1_mixing": op1_mixing,
    "op2_warc": op2_warc,
    "op3_fingerprints": op3_fingerprints,
    "op4_substrings": op4_substrings,
    "op5_chat": op5_chat,
    "op6_quality": op6_quality,
    "op7_decontamination": op7_decontamination,
    "op8_neardup": op8_neardup,
    "op9_licenses": op9_licenses,
    "op10_html": op10_html,
    "op11_host_rules": op11_host_rules,
    "op12_divergence": op12_divergence,
    "op13_runs": op13_runs,
}
