"""Views of records for people and models: snippets, safe payloads, embedding text, prompts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions import text as tx

# --- fixed values: metadata that may be shown, in order; fields of the summary; prefixes of embedding lines ---
SAFE_FIELDS = ("service_object_type", "area_code_city", "area_code_area", "area_code_street", "type1", "type2", "type3", "call_month")
SUMMARY_FIELDS = ("area_code_area", "area_code_street", "type1", "type2", "type3", "call_month")
EMBEDDING_PREFIXES = ("诉求内容：", "诉求目标：")
CURRENT_MARKERS = ("其不认可", "现服务对象表示", "现再次反映", "仍未解决", "再次要求", "希望部门", "现要求")


def squeeze_blanks(c: Column) -> Column:
    """White space runs to one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def snippet(df: DataFrame, text: str, out: str = "snippet", most: int = 220) -> DataFrame:
    """A redacted single line of at most ``most`` characters."""
    work = tx.redact(df, text, out=out)
    line = squeeze_blanks(F.col(out))
    return work.withColumn(out, F.when(F.length(line) <= most, line).otherwise(F.concat(F.substring(line, 1, most - 3), F.lit("..."))))


def metadata_summary(metadata: str = "metadata") -> Column:
    return tx.join_present(" | ", *(F.coalesce(F.col(f"{metadata}.{f}"), F.lit("")) for f in SUMMARY_FIELDS))


def safe_metadata(metadata: str = "metadata") -> Column:
    """Map of the fields that may be shown, empty ones left out."""
    pairs = F.create_map(*(x for f in SAFE_FIELDS for x in (F.lit(f), F.coalesce(F.col(f"{metadata}.{f}"), F.lit("")))))
    return F.map_filter(pairs, lambda _, v: v != "")


def safe_payload(results: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, score, metadata, snippet) of ranked results."""
    return snippet(results, text).select("doc_id", "score", safe_metadata().alias("metadata"), "snippet")


def embedding_text(explicit: Column, text: Column) -> Column:
    """The explicit text, else the lines with known labels, else all of it."""
    given = tx.strip(F.coalesce(explicit, F.lit("")))
    whole = F.coalesce(text, F.lit(""))
    lines = F.transform(F.split(whole, r"\r\n|[\n\r\x0B\x0C\x{85}\x{2028}\x{2029}]"), tx.strip)
    starts = lambda x: x.startswith(EMBEDDING_PREFIXES[0]) | x.startswith(EMBEDDING_PREFIXES[1])
    labelled = F.array_join(F.filter(lines, starts), "\n")
    return F.when(given != "", given).when(labelled != "", labelled).otherwise(tx.strip(whole))


def prompt(instruction: str, payload: dict[str, Column | dict]) -> Column:
    """Instruction and the canonical JSON of the payload."""
    return F.concat(F.lit(instruction + "\n"), tx.canonical_json(payload))
