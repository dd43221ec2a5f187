"""Secret scan: spans of credentials, judged by how many repositories and owners hold them.

Every text is searched for credentials of known form (base kinds) and for bare tokens.
The value of each find is hashed; per hash the distinct repositories and owners are counted
over the whole corpus. A value that many owners hold, or that one owner has in many repositories,
is a copied example; one that few hold and that looks random is live. Bare tokens count as
finds only if they are live.

NULL text has no finds. NULL repositories or owners count as one repository or owner. Repeated
rows are judged one by one; they do not add repositories or owners. An empty table gives
an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame, functions as F

from ..session import materialize
from .common import counted_join, map_rows, pick
from .registry import query

# Kinds, patterns and least lengths of the base.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "bare")
LEAST = {"assign": 8, "access": 16, "hex": 32}

# A run of the class that is long enough equals the filtered match of the plain pattern,
# since the plain pattern takes whole runs as well.
_PATTERNS = (
    re.compile(ASSIGN, re.A),
    re.compile(r"AKIA[A-Z0-9]{12,}"),
    re.compile(r"[0-9a-f]{32,}"),
    re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])"),
)


def entropy(value: str) -> float:
    """Bits per character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def looks_random(value: str, least_bits: float) -> bool:
    """Digits among letters, and no character that dominates."""
    return (
        any(c.isdigit() for c in value)
        and any(c.isalpha() for c in value)
        and entropy(value) >= least_bits
    )


def find_spans(text: str | None) -> list[tuple[int, int, int, str]]:
    """(start, end, kind number, value) by start, then kind. Bare tokens touch no other find."""
    if not text:
        return []
    found = []
    for m in _PATTERNS[0].finditer(text):
        if len(m[2]) >= LEAST["assign"]:
            found.append((m.start(), m.end(), 0, m[2]))
    for kind in (1, 2):
        found += [(m.start(), m.end(), kind, m[0]) for m in _PATTERNS[kind].finditer(text)]
    taken, at, reach = sorted((s, e) for s, e, _, _ in found), 0, 0
    for m in _PATTERNS[3].finditer(text):
        # How far the finds reach that start before this token ends; tokens come in order.
        while at < len(taken) and taken[at][0] < m.end():
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= m.start():
            found.append((m.start(), m.end(), 3, m[0]))
    return sorted(found)


def _digest(spans: list[str]) -> str:
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def _scan_row(least_bits: float):
    def scan(doc_id, repo, owner, text):
        found = find_spans(text)
        base = [f for f in found if f[2] < 3]
        counts = Counter(f[2] for f in base)
        return (
            doc_id,
            repo,
            owner,
            *[counts[k] for k in range(3)],
            _digest([f"{KINDS[k]}:{s}:{e}" for s, e, k, _ in base]),
            [s for s, *_ in found],
            [e for _, e, *_ in found],
            [k for _, _, k, _ in found],
            [hashlib.sha256(v.encode()).hexdigest() for *_, v in found],
            [int(looks_random(v, least_bits)) for *_, v in found],
        )

    return scan


def scan(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    repo_column: str = "doc_id",
    owner_column: str = "source",
    example_owners: int = 3,
    example_repos: int = 10,
    least_bits: float = 3.0,
) -> tuple[DataFrame, DataFrame]:
    """(one row per document, one row per find).

    A find has its span, kind, value_sha256, n_repos, n_owners and verdict: ``example`` if
    at least ``example_owners`` owners or ``example_repos`` repositories hold the value, else
    ``live`` if it has at least ``least_bits`` bits per character, letters and digits; else
    ``unclear``. So a value that two owners share is still reported. Counts are exact: distinct places are taken before places are counted.
    """
    rows = pick(docs, doc_id=id_column, text=text_column, repo=repo_column, owner=owner_column)
    kind = dict(rows.dtypes)["doc_id"]
    scanned = map_rows(
        rows.select(
            F.col("doc_id").cast("string"),
            F.col("repo").cast("string"),
            F.col("owner").cast("string"),
            "text",
        ),
        _scan_row(least_bits),
        "doc_id string, repo string, owner string, n_assign bigint, n_access bigint, "
        "n_hex bigint, base_sha256 string, starts array<bigint>, ends array<bigint>, "
        "kinds array<bigint>, hashes array<string>, random array<bigint>",
    )
    # The row number is written down, so it stays as it is from then on.
    scanned = scanned.withColumn("doc_id", F.col("doc_id").cast(kind))
    scanned = materialize(
        scanned.withColumn("key", F.monotonically_increasing_id()), "secret-scan"
    )
    finds = scanned.where(F.size("starts") > 0).select(
        "key",
        "doc_id",
        "repo",
        "owner",
        F.inline(F.arrays_zip("starts", "ends", "kinds", "hashes", "random")),
    ).toDF("key", "doc_id", "repo", "owner", "start", "end", "kind", "value_sha256", "random")
    # Copies of a value in one repository are combined first, then repositories of an owner.
    per_owner = (
        finds.groupBy("value_sha256", "owner", "repo")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("value_sha256", "owner")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_repos"))
    )
    stats = per_owner.groupBy("value_sha256").agg(
        F.sum("n").alias("n"),
        F.sum("n_repos").alias("n_repos"),
        F.count(F.lit(1)).alias("n_owners"),
    )
    stats = materialize(stats, "secret-owners")
    verdict = (
        F.when((F.col("n_owners") >= example_owners) | (F.col("n_repos") >= example_repos), "example")
        .when(F.col("random") == 1, "live")
        .otherwise("unclear")
    )
    names = F.array(*[F.lit(k) for k in KINDS])
    finds = (
        counted_join(finds, stats, "value_sha256", "n", F.col("key"))
        .withColumn("verdict", verdict)
        .withColumn("kind_name", F.element_at(names, (F.col("kind") + 1).cast("int")))
    )
    reported = finds.where("kind < 3 or verdict = 'live'")
    span = F.struct(
        "start", "kind", "end", F.concat_ws(":", "kind_name", "start", "end").alias("name"), "verdict"
    )
    by_doc = reported.groupBy("key").agg(F.array_sort(F.collect_list(span)).alias("found"))
    by_doc = by_doc.select(
        "key",
        F.array_join(F.col("found.name"), ",").alias("spans"),
        F.size(F.filter("found", lambda x: x["verdict"] == "live")).cast("long").alias("n_live"),
        F.size(F.filter("found", lambda x: x["verdict"] == "example")).cast("long").alias("n_example"),
    )
    digest = (
        scanned.drop("starts", "ends", "kinds", "hashes", "random", "repo", "owner")
        .join(by_doc, "key", "left")
        .na.fill("", ["spans"])
        .na.fill(0, ["n_live", "n_example"])
        .drop("key")
    )
    finds = finds.select(
        "doc_id", "repo", "owner", F.col("kind_name").alias("kind"), "start", "end",
        "value_sha256", "n_repos", "n_owners", "verdict",
    )
    return digest, finds


@query("op1_secret_scan")
def op1_secret_scan(load) -> DataFrame:
    """Every document; documents are repositories, sources are owners."""
    return scan(load("documents"))[0]
