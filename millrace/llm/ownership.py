"""Secret scans with corpus-wide ownership frequency.

Every text is scanned for three base kinds (assign, access, hex) and for random-looking tokens. Each candidate's value
is hashed; the hashes are aggregated over the corpus by distinct owners and repositories. A value that several owners
hold, or that EXAMPLE_REPOS repositories of one owner hold, is a widely copied example; another value of one owner, with the entropy of
a random string, looks live; what is neither is weak. Random-looking tokens outside the base spans are reported as spans of kind `live`
only if they are owner-specific. Base spans stay, whatever their verdict; `verdicts` has it for each span.

Counts are taken per (value, owner, repository) before the shuffle; the few rows of a value that very many documents hold are split by
Spark's skew join. Defined results: a null or empty text has no spans; a null owner or repository counts as one of its own; repeated
doc_ids keep a row each, a missing one is null; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialise, shared_dir

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}")
#: Bits per character from which a value looks random, and the fewest characters of a random-looking token.
MIN_ENTROPY = 3.0
TOKEN_ENTROPY = 3.8
#: Owners from which a value is a widely copied example.
EXAMPLE_OWNERS = 2
#: Repositories from which a value is one, even of a single owner; in two an owner may share its own secret.
EXAMPLE_REPOS = 3


def entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values()) if n else 0.0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, value), by start, then kind."""
    found = [(m.start(), 0, m.end(), m[1]) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(found)


def token_spans(text: str, taken: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """Random-looking tokens that overlap no base span."""
    out, i, reached = [], 0, 0  # reached: the furthest end of the base spans that begin before the token's end
    for m in _TOKEN.finditer(text):
        v = m[0]
        while i < len(taken) and taken[i][0] < m.end():
            reached, i = max(reached, taken[i][2]), i + 1
        if reached <= m.start() and any(c.isdigit() for c in v) and any(c.isupper() for c in v) and any(c.islower() for c in v) and entropy(v) >= TOKEN_ENTROPY:
            out.append((m.start(), m.end(), v))
    return out


_SCHEMA = "doc_id long, owner string, repo string, n_assign long, n_access long, n_hex long, base_sha256 string, base string, cands array<struct<kind:int,start:int,end:int,h:long,random:boolean>>"


def _hash(value: str) -> int:
    return int.from_bytes(hashlib.sha256(value.encode()).digest()[:8], "little", signed=True)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cols: list[list] = [[] for _ in range(6)]
        for text in b.column(b.schema.get_field_index("text")).to_pylist():
            text = text or ""
            spans = base_spans(text)
            n = Counter(k for _, k, _, _ in spans)
            base = ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z, _ in spans)
            cands = [{"kind": k, "start": a, "end": z, "h": _hash(v), "random": entropy(v) >= MIN_ENTROPY} for a, k, z, v in spans]
            cands += [{"kind": 3, "start": a, "end": z, "h": _hash(v), "random": True} for a, z, v in token_spans(text, spans)]
            for c, v in zip(cols, (n[0], n[1], n[2], hashlib.sha256(base.encode()).hexdigest(), base, cands), strict=True):
                c.append(v)
        kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("h", pa.int64()), ("random", pa.bool_())]))
        types = [pa.int64()] * 3 + [pa.string()] * 2 + [kind]
        names = ["n_assign", "n_access", "n_hex", "base_sha256", "base", "cands"]
        keep = ["doc_id", "owner", "repo"]
        yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(k)) for k in keep), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], [*keep, *names])


def ownership(cands: DataFrame) -> DataFrame:
    """Per candidate hash: owners, repos, uses. Duplicates of (hash, owner, repository) go before the second shuffle."""
    return cands.groupBy("h", "owner", "repo").agg(F.count(F.lit(1)).alias("n")).groupBy("h").agg(F.countDistinct("owner").alias("owners"), F.countDistinct("owner", "repo").alias("repos"), F.sum("n").alias("uses"))


def scan(docs: DataFrame, owner: str = "source", repo: str = "lang", example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> DataFrame:
    """Per document: base counts and digest, spans, verdicts (live, example or weak, of each span in the same order), n_live
    (owner-specific, random-looking) and n_example; max_owners, max_repos and max_uses: the most owners, repositories and uses of one of
    its values, 0 without any.

    owner: the column that names the owner; a repository is an owner's value of `repo`."""
    where = shared_dir(docs.sparkSession)
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in docs.columns else F.lit("")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", name(owner).alias("owner"), name(repo).alias("repo")).mapInArrow(_scan, _SCHEMA)
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), where, "scanned")
    flat = rows.where("size(cands) > 0").select("row", "owner", "repo", F.explode("cands").alias("c")).select("row", "owner", "repo", "c.*")
    seen = ownership(flat.select("h", "owner", "repo"))
    judged = flat.join(seen, "h").withColumn("example", (F.col("owners") >= example_owners) | (F.col("repos") >= example_repos))
    judged = judged.withColumn("live", F.col("random") & ~F.col("example"))
    per_row = judged.groupBy("row").agg(
        F.sum(F.col("live").cast("long")).alias("n_live"),
        F.sum(F.col("example").cast("long")).alias("n_example"),
        F.collect_list(F.when((F.col("kind") < 3) | F.col("live"), F.struct("start", "kind", "end", F.expr("case when live then 'live' when example then 'example' else 'weak' end").alias("verdict")))).alias("s"),
        *(F.max(c).alias(f"max_{c}") for c in ("owners", "repos", "uses")),
    )
    text = F.expr("array_join(transform(array_sort(s), x -> concat_ws(':', element_at(array('assign', 'access', 'hex', 'live'), x.kind + 1), x.start, x.end)), ',')")
    return rows.join(per_row, "row", "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce(text, F.lit("")).alias("spans"), F.coalesce(F.expr("array_join(transform(array_sort(s), x -> x.verdict), ',')"), F.lit("")).alias("verdicts"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("max_owners", "max_repos", "max_uses")),
    )
