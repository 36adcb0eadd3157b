"""Secret scan with an incremental blob ledger.

Every version of every path is content-addressed (SHA-256 of its text).  The
ledger records the (blob, rule version) pairs that have been scanned and their
findings; a run scans only the pairs that the ledger does not hold, one blob
once however many versions share it, and joins the findings back to all paths.

Offsets count code points, the end is exclusive.  Kinds are listed in KINDS;
the base kinds are matched leftmost and without overlap per kind, then matches
that are too short are dropped.

Defined results: a null text counts as empty; equal texts share one scan;
rows with equal or null ids are separate versions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from incidentlab.llm.textops import fresh
from incidentlab.session import checkpoint

#: Fixed patterns of the base rules, and the further rules of rule version 1.
#: kind: (pattern, group whose length counts, least length)
KINDS = {
    "assign": (re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]{16,}"), 0, 16),  # maximal runs, so the same as [0-9a-f]+ of 16 or more
    "pem": (re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----"), 0, 1),
    "jwt": (re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0, 1),
    "hosttoken": (re.compile(r"(?a)\b(?:gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35})"), 0, 1),
    "urlcred": (re.compile(r"(?a)[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,64}:[^\s:/@]{6,64}@"), 0, 1),
}
BASE_KINDS = ("assign", "access", "hex")
RULE_VERSION = "1"
#: A text without any of these (A-Z folded) has no match of the kind.
NEEDLES = {
    "assign": ("passw", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "pem": ("-----begin ",),
    "jwt": ("eyj",),
    "hosttoken": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xox", "aiza"),
    "urlcred": ("://",),
}

FINDINGS = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob string, rule_version string, findings {FINDINGS}"
_ORDER = {k: i for i, k in enumerate(KINDS)}


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans of a text by start, then kind as listed."""
    found = []
    folded = text.lower()
    for kind, (pattern, group, least) in KINDS.items():
        if kind in NEEDLES and not any(n in folded for n in NEEDLES[kind]):
            continue
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((kind, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], _ORDER[s[0]]))


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame(
            {
                "blob": pdf["blob"],
                "rule_version": pdf["rule_version"],
                "findings": [[{"kind": k, "start": a, "end": b} for k, a, b in find_spans(t)] for t in pdf["text"]],
            }
        )


def address(versions: DataFrame, text_col: str = "text") -> DataFrame:
    """``versions`` with ``blob``, the hex SHA-256 of the whole text."""
    return versions.withColumn("blob", F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))


def scan_unseen(
    versions: DataFrame, ledger: DataFrame | None = None, rule_version: str = RULE_VERSION, text_col: str = "text"
) -> DataFrame:
    """New ledger rows ``blob, rule_version, findings`` for the blobs that the
    ledger does not hold under this rule version.  Copies collapse before the
    shuffle, so a blob held by a third of all versions is one row per task."""
    blobs = address(versions.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")))
    if ledger is not None:
        seen = ledger.filter(F.col("rule_version") == rule_version).select("blob")
        blobs = blobs.join(seen, "blob", "left_anti")
    unseen = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    return unseen.withColumn("rule_version", F.lit(rule_version)).mapInPandas(
        _scan, LEDGER
    )


def update_ledger(
    versions: DataFrame, path: str, rule_version: str = RULE_VERSION, text_col: str = "text"
) -> DataFrame:
    """The ledger table at ``path`` after the blobs of ``versions`` that it does
    not hold yet have been scanned and appended; a new table if there is none."""
    spark = versions.sparkSession
    try:
        ledger = spark.read.schema(LEDGER).parquet(path)
    except AnalysisException:  # no such path yet
        ledger = None
    scan_unseen(versions, ledger, rule_version, text_col).write.mode("append").parquet(path)
    return spark.read.schema(LEDGER).parquet(path)


def findings_by_path(
    versions: DataFrame, ledger: DataFrame, rule_version: str = RULE_VERSION, text_col: str = "text"
) -> DataFrame:
    """Every version (without its text) with ``blob`` and ``findings``, which
    replace columns of those names.

    Only blobs with findings are joined; a blob shared by very many versions
    meets its findings once per (blob, partition)."""
    part = fresh("__part", versions.columns)
    # The partition numbers are written with the rows, so both readings agree.
    rows = checkpoint(address(versions.drop("findings"), text_col).drop(text_col).withColumn(part, F.spark_partition_id()))
    hits = ledger.filter((F.col("rule_version") == rule_version) & (F.size("findings") > 0)).select("blob", "findings")
    here = rows.select("blob", part).distinct().join(hits, "blob")
    out = rows.join(here, ["blob", part], "left").drop(part)
    return out.withColumn("findings", F.coalesce("findings", F.array().cast(FINDINGS)))


def spans_text(findings, kinds: tuple | None = None):
    """``kind:start:end`` of the findings, comma-joined in their order."""
    own = findings if kinds is None else F.filter(findings, lambda s: s["kind"].isin(*kinds))
    return F.concat_ws(",", F.transform(own, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def count_kind(findings, kind: str):
    return F.size(F.filter(findings, lambda s: s["kind"] == kind)).cast("long")
