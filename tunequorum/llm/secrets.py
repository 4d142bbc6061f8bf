"""Secret scans with corpus-wide ownership frequency.

A scan finds candidates in every text. The digests of their values are counted over the corpus by distinct owners and
repositories: values that many owners have are widely copied examples, a random-looking value of few owners is a
credential in use. The base patterns always give spans; the method adds the other credentials in use.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tunequorum.runtime import durable

#: Kinds in the order in which spans of one start are listed. The first three are the base patterns.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: What else may be a credential: a long run that mixes digits and letters.
BARE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Values of at least so many owners are examples; bits a character of a value that looks random.
EXAMPLE_OWNERS = 5
MIN_ENTROPY = 3.0

_CANDIDATE = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("digest", pa.binary()), ("random", pa.bool_())])
_FOUND = pa.list_(_CANDIDATE)
FOUND_TYPE = "array<struct<kind:int,start:long,end:long,digest:binary,random:boolean>>"


def entropy(value: str) -> float:
    """Bits a character."""
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in Counter(value).values())


def looks_random(value: str) -> bool:
    return any(c.isdigit() for c in value) and any(c.isalpha() for c in value) and entropy(value) >= MIN_ENTROPY


def candidates(text: str | None) -> list[dict]:
    """Candidates by start, then kind; positions count code points. Base matches are leftmost and do not overlap
    within a kind; a bare run counts only where it touches no base match and looks random."""
    text = text or ""
    found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    taken = sorted((a, b) for a, _, b, _ in found)
    at = reach = 0
    for m in BARE.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= m.start() and looks_random(m[0]):
            found.append((m.start(), 3, m.end(), m[0]))
    return [
        {"kind": kind, "start": start, "end": end, "random": looks_random(value),
         "digest": hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=16).digest()}
        for start, kind, end, value in sorted(found)
    ]


def _scan(text: Column) -> Column:
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([candidates(t.as_py()) for t in texts], _FOUND)

    return F.arrow_udf(scan, FOUND_TYPE)(text)


def redact(text: str, spans: list[dict]) -> str:
    """``text`` with each span, overlapping ones as one, replaced by [REDACTED]."""
    parts, at = [], 0
    for span in spans:
        if span["start"] >= at:
            parts += [text[at : span["start"]], "[REDACTED]"]
        at = max(at, span["end"])
    return "".join([*parts, text[at:]])


def _redact(text: Column, spans: Column) -> Column:
    def clean(texts: pa.Array, found: pa.Array) -> pa.Array:
        return pa.array([t.as_py() and redact(t.as_py(), s.as_py()) for t, s in zip(texts, found)], pa.string())

    return F.arrow_udf(clean, "string")(text, spans)


def ownership(found: DataFrame) -> DataFrame:
    """(digest, n_owners, n_repositories): distinct ones, null being one of them, for (digest, owner, repository)."""
    by_owner = found.select("digest", "owner", "repository").distinct().groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("digest").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))


def _name(x: Column) -> Column:
    return F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1), x["start"], x["end"])


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, _name), ",")


def _scanned(docs: DataFrame, text_col: str, owner: Column, repository: Column, carried: list[str]) -> tuple[DataFrame, DataFrame]:
    """(row, doc, found) of every row, and (row, spans) of those with candidates: base ones and credentials in use.

    A span also has ``live``: it looks random and fewer than EXAMPLE_OWNERS owners have its value.
    """
    doc = F.struct(*[F.col(f"`{c}`") for c in carried]).alias("doc")
    rows = durable(docs.select(
        F.monotonically_increasing_id().alias("row"), doc, owner.alias("owner"), repository.alias("repository"),
        _scan(F.col(text_col)).alias("found"),
    ))
    each = rows.where(F.size("found") > 0).select("row", "owner", "repository", F.explode("found").alias("x")).select(
        "row", "owner", "repository", "x.*"
    )
    counted = durable(ownership(each.select("digest", "owner", "repository")))
    live = F.col("random") & (F.col("n_owners") < EXAMPLE_OWNERS)
    judged = durable(each.join(counted, "digest").withColumn("live", live).where((F.col("kind") < 3) | F.col("live")).select(
        "row", F.struct("start", "kind", "end", "live", "n_owners", "n_repositories").alias("span")
    ))
    return rows, judged.groupBy("row").agg(F.sort_array(F.collect_list("span")).alias("spans"))


def secret_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    owner: Column | None = None, repository: Column | None = None,
) -> DataFrame:
    """(id_col, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_owned): one row for each row of ``docs``.

    The owner is the column ``source`` and the repository the pair of source and language unless given; null is
    one owner of its own. Null and empty texts have no spans. Repeated rows count once in the frequencies.
    """
    owner, repository = _places(owner, repository)
    rows, spans = _scanned(docs, text_col, owner, repository, [id_col])
    listed = F.coalesce("spans", F.array().cast("array<struct<start:long,kind:int,end:long,live:boolean,n_owners:long,n_repositories:long>>"))
    base = F.filter("found", lambda x: x["kind"] < 3)

    def n(kind: int) -> Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")

    return rows.join(spans, "row", "left").select(
        F.col("doc")[id_col].alias(id_col), n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(listed).alias("spans"),
        F.size(F.filter(listed, lambda x: x["live"])).cast("long").alias("n_live"),
        F.size(F.filter(listed, lambda x: x["kind"] == 3)).cast("long").alias("n_owned"),
    )


def _places(owner: Column | None, repository: Column | None) -> tuple[Column, Column]:
    return (F.col("source") if owner is None else owner), (F.struct("source", "lang") if repository is None else repository)


def redact_secrets(
    docs: DataFrame, text_col: str = "text", owner: Column | None = None, repository: Column | None = None
) -> DataFrame:
    """``docs`` with every span of secret_spans() replaced by [REDACTED]; a null text stays null."""
    rows, spans = _scanned(docs, text_col, *_places(owner, repository), docs.columns)
    joined = rows.join(spans, "row", "left")
    clean = joined.where(F.col("spans").isNull()).select("doc.*")
    doc = F.col("doc")
    dirty = joined.where(F.col("spans").isNotNull()).withColumn("text", _redact(doc[text_col], F.col("spans"))).select(
        *[F.col("text").alias(c) if c == text_col else doc[c].alias(c) for c in docs.columns]
    )
    return clean.unionByName(dirty)
