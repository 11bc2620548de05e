"""Secrets by an incremental ledger of blobs.

Every version of every path is addressed by its content, a SHA-256 of the text. The ledger is a folder of
Parquet tables, one per update, with a row for each blob that the update scanned: the rules, by name and
version, that it was scanned with, and what they found. An update scans only pairs of blob and rule version
that no earlier update has, each blob once however many versions hold it, and adds a table; findings are then
joined back to all versions. A rule that changes gets a new version number, and only it is scanned again.

Narrow rows of digests tell what is unseen. Texts are shuffled as distinct blobs, combined inside each task
first; when few blobs are unseen (by their counted size) the others' texts aren't shuffled at all.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeledger.llm.common import documents, free_name, land, shared_root, small_batches

#: Bytes of unseen digests, 48 a row, up to which they are sent to every task.
SENT_BYTES = 8 << 20
DIGEST_BYTES = 48


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a text that holds none of ``needs`` (lower case) is passed over; ``keep`` drops matches."""

    kind: str
    version: int
    pattern: str
    needs: tuple[str, ...] = ()
    keep: Callable[[re.Match], bool] | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base patterns, then public formats of credentials.
RULES = (
    Rule(
        "assign", 1,
        r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        lambda m: len(m[2]) >= 8,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", ("akia",), lambda m: len(m[0]) >= 16),
    Rule("hex", 1, r"[0-9a-f]{32,}"),
    Rule("private_key", 1, r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----(?:[^-]*-----END (?:[A-Z]+ )*PRIVATE KEY-----)?", ("private key-----",)),
    Rule("code_host", 1, r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36,255}|github_pat_[A-Za-z0-9_]{60,255}|glpat-[A-Za-z0-9_-]{20,255})", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "glpat-")),
    Rule("chat", 1, r"(?<![A-Za-z0-9])xox[abeoprs]-[A-Za-z0-9-]{10,255}", ("xox",)),
    Rule("cloud_key", 1, r"(?<![A-Za-z0-9_])AIza[A-Za-z0-9_-]{35}(?![A-Za-z0-9_-])", ("aiza",)),
    Rule("payment", 1, r"(?<![A-Za-z0-9])[rs]k_(?:live|test)_[A-Za-z0-9]{16,255}", ("k_live_", "k_test_")),
    Rule("web_token", 1, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]*", ("eyj",)),
    Rule("login_url", 1, r"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s/:@]{1,128}:[^\s/:@]{3,128}@", ("://",)),
    Rule("bearer", 1, r"(?ai:(?<![a-z])bearer)\x20+([A-Za-z0-9+/_.=~-]{20,})", ("bearer",)),
)
#: Kinds of the base; their spans always stay.
BASE = ("assign", "access", "hex")

SCAN = pa.schema([
    ("blob", pa.binary()), ("rules", pa.list_(pa.string())),
    ("found", pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))),
])
SPANS_SQL = "array<struct<start:int,kind:int,end:int>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
FOUND = pa.schema([("blob", pa.binary()), ("base", _SPANS), ("spans", _SPANS)])
SCAN_SQL = "blob binary, rules array<string>, found array<struct<kind:string,start:int,end:int>>"


def spans_of(text: str, rules: list[Rule]) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each rule; places count code points, the end is exclusive."""
    out, low = [], text.lower()
    for rule in rules:
        if rule.needs and not any(n in low for n in rule.needs):
            continue
        for m in re.finditer(rule.pattern, text):
            if rule.keep is None or rule.keep(m):
                out.append((rule.kind, m.start(), m.end()))
    return out


class Ledger:
    """A folder of scans; every update adds one table, whose name is unique, and changes none."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _tables(self) -> list[str]:
        """Folders of finished updates: a write that was cut short has no mark of success."""
        jvm = self.spark.sparkContext._jvm
        pattern = jvm.org.apache.hadoop.fs.Path(f"{self.path}/update-*/_SUCCESS")
        files = pattern.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
        return sorted(f.getPath().getParent().toString() for f in files or [])

    def scans(self) -> DataFrame:
        """``blob, rules, found`` of all updates; none yet: no rows."""
        tables = self._tables()
        if not tables:
            return self.spark.createDataFrame([], SCAN_SQL)
        return self.spark.read.schema(SCAN_SQL).parquet(*tables)

    def unseen(self, blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
        """``blob, todo``: distinct blobs of ``blobs`` with the rule versions they haven't been scanned with."""
        names = F.array(*(F.lit(r.name) for r in rules)).cast("array<string>")
        distinct = blobs.select("blob").distinct()
        seen = self.scans().groupBy("blob").agg(F.flatten(F.collect_set("rules")).alias("seen"))
        left = F.array_except(names, F.coalesce("seen", F.array().cast("array<string>")))
        return distinct.join(land(seen, "seen"), "blob", "left").select("blob", left.alias("todo")).where(F.size("todo") > 0)

    def update(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES, blobs: DataFrame | None = None) -> int:
        """Scans what is unseen of ``versions`` (``blob, text``) and returns how many blobs that were.

        ``blobs`` has the digests of ``versions`` if they are stored already. A repeated update finds nothing
        unseen and adds nothing; if two updates run at once, a blob may be scanned by both, which ``findings``
        takes as one.
        """
        distinct = lambda df: df.groupBy("blob").agg(F.any_value("text").alias("text"))
        if not self._tables():  # all is unseen
            texts = distinct(versions).withColumn("todo", F.array(*(F.lit(r.name) for r in rules)).cast("array<string>"))
        else:
            unseen = land(self.unseen(versions if blobs is None else blobs, rules), "unseen")
            count = unseen.count()
            if not count:
                return 0
            if count * DIGEST_BYTES <= SENT_BYTES:
                versions = versions.join(F.broadcast(unseen.select("blob")), "blob", "left_semi")
            texts = distinct(versions).join(unseen, "blob")
        by_name = {r.name: r for r in rules}

        def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in frames:
                todo = batch.column("todo").to_pylist()
                found = [
                    [{"kind": k, "start": a, "end": b} for k, a, b in spans_of(text, [by_name[n] for n in names])]
                    for text, names in zip(batch.column("text").to_pylist(), todo)
                ]
                yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(todo, SCAN.types[1]), pa.array(found, SCAN.types[2])], schema=SCAN)

        small_batches(self.spark)
        path = f"{self.path}/update-{uuid.uuid4().hex}"
        texts.select("blob", "text", "todo").mapInArrow(run, SCAN_SQL).write.parquet(path)
        return self.spark.read.schema(SCAN_SQL).parquet(path).count()

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """``blob, base, spans``: ordered arrays of ``start, kind, end`` of the blobs in which the rules found something.

        Spans of rule versions other than the given ones don't count. A span that isn't of the base and
        overlaps one that is, or an earlier of its own sort, is left out as part of it.
        """
        names = F.array(*(F.lit(r.name) for r in rules)).cast("array<string>")
        kinds = [r.kind for r in rules]
        base = {k for k, kind in enumerate(kinds) if kind in BASE}
        # a row's rules all ran on its blob, so its spans hold for those of the given rules
        ran = F.transform(F.array_intersect("rules", names), lambda n: F.substring_index(n, "@", 1))
        places = F.array(*(F.lit(k) for k in kinds)).cast("array<string>")
        span = lambda s: F.struct(s["start"].alias("start"), F.array_position(places, s["kind"]).cast("int").alias("kind"), s["end"].alias("end"))
        found = F.transform(F.filter("found", lambda s: F.array_contains(ran, s["kind"])), span)
        per_row = self.scans().where(F.size("found") > 0).select("blob", found.alias("found")).where(F.size("found") > 0)
        per_blob = per_row.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("all"))

        def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in frames:
                spans = [sorted((s["start"], s["kind"] - 1, s["end"]) for s in row) for row in batch.column("all").to_pylist()]
                columns = [[s for s in row if s[1] in base] for row in spans], [settled(row, base) for row in spans]
                as_rows = [pa.array([[dict(zip(("start", "kind", "end"), s)) for s in row] for row in c], FOUND.types[1]) for c in columns]
                yield pa.RecordBatch.from_arrays([batch.column("blob"), *as_rows], schema=FOUND)

        small_batches(self.spark)
        return per_blob.mapInArrow(run, f"blob binary, base {SPANS_SQL}, spans {SPANS_SQL}")


def settled(spans: list[tuple[int, int, int]], base: set[int]) -> list[tuple[int, int, int]]:
    """Of spans in order: those of the base, and others that overlap neither these nor an earlier of their own sort."""
    firm = [s for s in spans if s[1] in base]
    starts, reach = [s[0] for s in firm], [0, *accumulate((s[2] for s in firm), max)]
    free, end = [], 0
    for s in spans:
        if s[1] not in base and max(end, reach[bisect_left(starts, s[2])]) <= s[0]:
            free.append(s)
            end = s[2]
    return sorted(firm + free)


def addressed(versions: DataFrame) -> DataFrame:
    """``versions`` with ``blob``, the digest of its text (null: empty), and the text not null."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return versions.withColumn("text", text).withColumn("blob", F.unhex(F.sha2(text.cast("binary"), 256)))


def secrets(versions: DataFrame, ledger: Ledger, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Every row of ``versions`` without its text, with ``base`` and ``spans`` of its text, whatever else it holds.

    Both are arrays of ``start, kind, end`` in order, ``kind`` as the place among ``rules``; texts without secrets,
    empty and null ones have empty arrays. Repeated rows each appear. A column named like one of the results goes
    under a longer name. An empty table gives no rows. The ledger is updated first.
    """
    names = {c: c for c in versions.columns if c != "text"}
    for taken in ("blob", "base", "spans"):
        for c in list(names):
            if c.lower() == taken:
                names[c] = free_name(versions, c)
    kept = versions.select("text", *(F.col(c).alias(n) for c, n in names.items()))
    paths = land(addressed(kept).drop("text"), "paths")
    ledger.update(addressed(versions.select("text")), rules, paths)
    found = land(ledger.findings(rules), "findings")
    none = F.array().cast(SPANS_SQL)
    return paths.join(found, "blob", "left").select(
        *names.values(), F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans")
    )


def _written(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op11_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Base counts and the spans of every document, through a ledger that starts empty."""
    ledger = Ledger(spark, f"{shared_root(spark)}/llm/ledger-{uuid.uuid4().hex}")
    found = secrets(documents(spark, sf_dir).select("doc_id", "text"), ledger)

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{BASE[kind]}")

    return found.select(
        "doc_id", *(count(k) for k in range(len(BASE))),
        F.sha2(_written(F.col("base"), RULES).cast("binary"), 256).alias("base_sha256"), _written(F.col("spans"), RULES).alias("spans"),
    )
