"""Secret scans over an incremental blob ledger.

Every version of a file is addressed by the SHA-256 of its text. The ledger holds what was found
for (blob, rules): one row per blob that was ever scanned with a version of the rules, also when
it was clean. A scan

1. reduces the paths to distinct blobs (one candidate path each, combined in every task before
   the shuffle, so a blob with a third of all paths is one row),
2. drops the blobs that the ledger holds for this version of the rules,
3. scans the texts of the others, each once, and adds them to the ledger,
4. joins the findings back to all paths; the rows of this join are digests, and a hot blob is
   split by Spark's skew join.

Kinds (fixed values of the rules are in RULES): the base kinds assign, access and hex; the method
adds pem (private key blocks). Matches are leftmost and non-overlapping per kind; offsets are
code points, end exclusive.

Defined cases: a null text is an empty one; rows with equal doc_id are separate paths and get the
findings of their own text; null doc_ids are kept; a text in the ledger with other rules is
scanned again.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.scratch import materialize
from .common import arrow_rows

RULES_VERSION = "1"
KINDS = ("assign", "access", "hex", "pem")
BASE = 3
# The patterns of the kinds. A-Z and a-z only are folded in ``assign``.
ASSIGN = re.compile(
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]+-----END [A-Z ]*PRIVATE KEY-----")
#: Hex digits to "x" and the rest to a space: a long run is found faster than by the pattern.
_HEX_MAP = bytes(0x78 if chr(b) in "0123456789abcdef" else 0x20 for b in range(256))


def find(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every secret, in this order."""
    found: list[tuple[int, int, int]] = []
    if not text:
        return found
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    if b"x" * 24 in text.encode("utf-8", "surrogatepass").translate(_HEX_MAP):
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "-----BEGIN " in text:
        found += [(m.start(), 3, m.end()) for m in PEM.finditer(text)]
    return sorted(found)


_FINDING = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
_FINDING_SQL = "array<struct<start:int,kind:int,end:int>>"


def _scan(blobs: DataFrame) -> DataFrame:
    """(blob, findings) of the rows (blob, text)."""

    def run(batches):
        for batch in batches:
            found = [
                [{"start": a, "kind": k, "end": b} for a, k, b in find(text)] for (text,) in arrow_rows(batch, "text")
            ]
            yield pa.RecordBatch.from_pydict({"blob": batch.column(0), "findings": pa.array(found, _FINDING)})

    return blobs.select("blob", "text").mapInArrow(run, f"blob string, findings {_FINDING_SQL}")


def _paths(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.sha2(text, 256).alias("blob"))


def update_ledger(docs: DataFrame, ledger: DataFrame | None = None, rules: str = RULES_VERSION) -> DataFrame:
    """New rows (blob, rules, findings) for the blobs that the ledger lacks under these rules."""
    paths = _paths(docs)
    first = paths.groupBy("blob").agg(F.min("doc_id").alias("doc_id"))
    if ledger is not None:
        seen = ledger.where(F.col("rules") == rules).select("blob")
        first = first.join(seen, "blob", "left_anti")
    first = first.select(F.col("blob").alias("first_blob"), F.col("doc_id").alias("first_id"))
    same = paths["doc_id"].eqNullSafe(first["first_id"]) & (paths["blob"] == first["first_blob"])
    # Repeated rows (same doc_id and text) would give a ledger row each.
    found = _scan(paths.join(first, same, "left_semi")).dropDuplicates(["blob"])
    return found.select("blob", F.lit(rules).alias("rules"), "findings")


def scan(
    docs: DataFrame, ledger: DataFrame | None = None, rules: str = RULES_VERSION
) -> tuple[DataFrame, DataFrame]:
    """(findings of every path, the ledger with the new blobs).

    The findings have doc_id, blob and findings, an array of (start, kind, end). The ledger's
    new rows are written once, to shared storage, and read by both results.
    """
    new = materialize(update_ledger(docs, ledger, rules), "ledger")
    known = new if ledger is None else ledger.select("blob", "rules", "findings").unionByName(new)
    found = known.where((F.col("rules") == rules) & (F.size("findings") > 0)).select("blob", "findings")
    paths = _paths(docs).select("doc_id", "blob").join(found, "blob", "left")
    return paths.select("doc_id", "blob", F.coalesce("findings", F.array().cast(_FINDING_SQL)).alias("findings")), known


def _joined(findings, base_only: bool):
    names = F.array(*[F.lit(k) for k in KINDS])
    kept = F.filter(findings, lambda x: x["kind"] < BASE) if base_only else findings
    return F.array_join(
        F.transform(kept, lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))),
        ",",
    )


def digest(found: DataFrame) -> DataFrame:
    def count(kind: int):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:BASE])]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_joined(F.col("findings"), True), 256).alias("base_sha256"),
        _joined(F.col("findings"), False).alias("spans"),
    )


def _masked(text: str, mask: str) -> str:
    """The text with every secret, overlapping ones merged, replaced by the mask."""
    out, at = [], 0
    end = -1
    for a, _, b in find(text):
        if a >= end:
            if end >= 0:
                out.append(mask)
                at = end
            out.append(text[at:a])
        end = max(end, b)
    return "".join(out) + mask + text[end:] if end >= 0 else text


def redact(docs: DataFrame, ledger: DataFrame | None = None, mask: str = "[SECRET]") -> DataFrame:
    """docs with the secrets in ``text`` replaced, all other columns as they came.

    The decisions come from the ledger: only the texts of paths with findings are changed.
    """
    key = F.sha2(F.coalesce("text", F.lit("")), 256)
    _, known = scan(docs, ledger)
    dirty = known.where((F.col("rules") == RULES_VERSION) & (F.size("findings") > 0)).select("blob")
    columns = docs.columns
    rows = docs.select(F.struct("*").alias("row"), F.col("text"), key.alias("key"))
    marked = rows.join(dirty.withColumn("dirty", F.lit(True)), rows["key"] == dirty["blob"], "left").select(
        "row", "text", F.coalesce("dirty", F.lit(False)).alias("dirty")
    )

    def run(batches):
        for batch in batches:
            texts = [_masked(t, mask) if bad else t for t, bad in arrow_rows(batch, "text", "dirty")]
            parts = dict(zip(batch.schema.names, batch.columns, strict=True))
            yield pa.RecordBatch.from_pydict(parts | {"text": pa.array(texts, batch.schema.field("text").type)})

    done = marked.mapInArrow(run, marked.schema)
    return done.select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in columns])
