"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its bytes. A blob is scanned once
per version of the rules: blobs the ledger already holds under the current rule version are
left out, the others are scanned once however many paths and versions carry them, and the
findings are appended to the ledger. Findings reach all paths by a join on the address.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, columns_of, in_pieces, text_or_empty, work_folder

# Kinds in the order in which equal starts are listed: (kind, pattern, group that is measured, least length).
RULES = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
# A text without any of these (in lower case) has no match of ``assign``.
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")

LEDGER = "blob string, rule_version string, n_assign long, n_access long, n_hex long, spans string"
_FOUND = pa.schema(
    [("blob", pa.string()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("spans", pa.string())]
)


def rule_version(rules: Sequence[tuple] = RULES) -> str:
    """Name of a set of rules: any change in them makes every blob unseen again."""
    return hashlib.sha256(repr((tuple(rules), ASSIGN_HINTS)).encode()).hexdigest()[:16]


def find_spans(text: str, rules: Sequence[tuple] = RULES) -> list[tuple[int, int, str, int]]:
    """(start, place of the kind, kind, end) of every finding, in order; code points, end exclusive."""
    found = []
    for k, (kind, pattern, group, least) in enumerate(rules):
        if kind == "assign" and not any(h in text.lower() for h in ASSIGN_HINTS):
            continue
        flags = re.ASCII | (re.IGNORECASE if kind == "assign" else 0)
        for m in re.compile(pattern, flags).finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), k, kind, m.end()))
    return sorted(found)


def _scan(batches: Iterator[pa.RecordBatch], rules: Sequence[tuple] = RULES) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for blob, text in zip(*columns_of(batch, "blob", "text"), strict=True):
                spans = find_spans(text, rules)
                kinds = [s[2] for s in spans]
                joined = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)
                yield blob, kinds.count("assign"), kinds.count("access"), kinds.count("hex"), joined

    return in_pieces(rows(), _FOUND)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows; one that was never written is empty."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def scan_new_blobs(versions: DataFrame, ledger: str, rules: Sequence[tuple] = RULES) -> None:
    """Scan the blobs of ``versions`` (column text) that ``ledger`` lacks under the current rules.

    The append is one Spark commit: a run that breaks off leaves the ledger as it was, and its
    blobs are unseen in the next run.
    """
    spark = versions.sparkSession
    bounded_batches(spark)
    now = rule_version(rules)
    seen = read_ledger(spark, ledger).where(F.col("rule_version") == now).select("blob")
    text = text_or_empty()
    # equal texts collapse before the exchange, so copies of one text never meet in one task
    blobs = versions.select(F.sha2(text.cast("binary"), 256).alias("blob"), text.alias("text")).dropDuplicates(["blob"])
    found = blobs.join(seen, "blob", "left_anti").mapInArrow(lambda b: _scan(b, rules), "blob string, n_assign long, n_access long, n_hex long, spans string")
    found = found.select("blob", F.lit(now).alias("rule_version"), "n_assign", "n_access", "n_hex", "spans")
    found.write.mode("append").parquet(ledger)


def findings(versions: DataFrame, ledger: str, keep: Sequence[str] = ("doc_id",), rules: Sequence[tuple] = RULES) -> DataFrame:
    """Scan what is new, then give every row of ``versions`` its blob and the blob's findings.

    ``versions`` has ``text`` and the columns ``keep`` (path, version, ...); other columns are
    ignored. A null text is empty; repeated rows stay; an empty table gives no rows. Two runs at
    a time may both scan a blob; it counts once. Returns keep, blob, n_assign, n_access, n_hex,
    spans; a kept column of one of these names is called ``own_<name>``.
    """
    scan_new_blobs(versions, ledger, rules)
    known = read_ledger(versions.sparkSession, ledger).where(F.col("rule_version") == rule_version(rules))
    own = ["blob", "n_assign", "n_access", "n_hex", "spans"]
    known = known.dropDuplicates(["blob"]).select(F.col("blob").alias("_blob"), *own)
    names = [f"own_{c}" if c in own else c for c in keep]
    kept = [F.col(c).alias(n) for c, n in zip(keep, names, strict=True)]
    at = versions.select(*kept, F.sha2(text_or_empty().cast("binary"), 256).alias("_blob"))
    return at.join(known, "_blob").select(*names, *own)


def op10_secrets(spark, sf_dir: str) -> DataFrame:
    """The contract's digest: the findings of all ``documents``, scanned into a fresh ledger."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = findings(docs, f"{work_folder(spark, 'secrets')}/ledger")
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.col("spans").cast("binary"), 256).alias("base_sha256"), "spans", "blob"
    )
