"""Secret scans with corpus-wide ownership frequency, in DataFrame and SQL expressions alone.

Base kinds (leftmost, non-overlapping for each kind): ``assign``, ``access``, ``hex``. A further kind, ``token``,
proposes long mixed strings and well-known credential formats. The SHA-256 of each candidate's value is counted
over the corpus by distinct repositories (documents, by doc_id) and distinct owners (sources). A value looks live if it
looks random (no placeholder word or run, enough different characters) and belongs to at most ``OWNERS`` owners and
``REPOSITORIES`` repositories; others are widely copied examples or placeholders. Base spans always stay; ``token``
spans are added where they look live and do not touch a base span of the document.

Each pattern runs once over a text: matches are put between marks, at which the text is split. Positions add up the
lengths of the parts in blocks of ``BLOCK``, so many spans in one text cost little more than few. The most frequent
values meet their counts by broadcast.

Positions count code points, the end is exclusive. Defined results: null text is empty; no span gives the
SHA-256 of the empty string and an empty ``spans``; a row with a null source is an owner of its own; rows with one doc_id
are one repository (those with a null doc_id each their own); repeated rows are scanned each; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import most_frequent, split_join
from .store import materialize, table

OWNERS = 1
REPOSITORIES = 5
BLOCK = 256

#: Fixed patterns of the base kinds. Letters of ``assign`` keywords count in either case. Runs that would
#: fail by length cannot hold a longer match for access and hex, so their least lengths are in the pattern.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
    r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"(?:gh[pousr]_[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{30,}|[A-Za-z0-9+/_-]{24,})"
KINDS = [("assign", ASSIGN, 2), ("access", ACCESS, 0), ("hex", HEX, 0), ("token", TOKEN, 0)]

#: What examples are made of. Values that hold one, in either case, are placeholders.
PLACEHOLDER = "example|sample|dummy|placeholder|changeme|change_me|yourkey|your_|your-|xxxx|0000|1111|12345|abcdef|qwerty|password|secret"
VARIED = 8

SPAN = "struct<start:int,ord:int,kind:string,stop:int,value:string>"


def literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans_of(order: int, kind: str, pattern: str, group: int) -> str:
    """SQL for the array of spans of one kind in ``t``, a text without the mark chr(1)."""
    p = literal(pattern)
    parts = f"split(regexp_replace(t, {p}, '\u0001$0\u0001'), '\u0001', -1)"  # gap, match, gap, match, ..., gap
    value = "x.hit" if group == 0 else f"regexp_extract(x.hit, {p}, {group})"
    nothing = f"cast(array() AS array<{SPAN}>)"
    pairs = "transform(sequence(0, size(p) div 2 - 1), i -> struct(length(p[2 * i]) AS gap, length(p[2 * i + 1]) AS size, p[2 * i + 1] AS hit))"
    blocks = f"transform(sequence(0, (size(q) - 1) div {BLOCK}), i -> slice(q, i * {BLOCK} + 1, {BLOCK}))"
    begun = f"""aggregate({blocks}, struct(0 AS pos, cast(array() AS array<struct<pos:int,rows:array<struct<gap:int,size:int,hit:string>>>>) AS got),
        (a, b) -> struct(a.pos + aggregate(b, 0, (n, x) -> n + x.gap + x.size) AS pos, concat(a.got, array(struct(a.pos AS pos, b AS rows))) AS got), a -> a.got)"""
    placed = f"""flatten(transform({begun}, z -> aggregate(z.rows, struct(z.pos AS pos, {nothing} AS got),
        (a, x) -> struct(a.pos + x.gap + x.size AS pos, concat(a.got, array(struct(
            a.pos + x.gap AS start, {order} AS ord, '{kind}' AS kind, a.pos + x.gap + x.size AS stop, {value} AS value))) AS got), a -> a.got)))"""
    inner = f"transform(array({pairs}), q -> {placed})[0]"
    return f"transform(array({parts}), p -> CASE WHEN size(p) > 1 THEN {inner} ELSE {nothing} END)[0]"


def looks_random(value: str) -> str:
    return f"(NOT lower({value}) RLIKE '{PLACEHOLDER}' AND size(array_distinct(split({value}, ''))) >= {VARIED})"


def text_of(spans: str) -> str:
    """kind:start:end of sorted spans, comma-joined."""
    return f"array_join(transform({spans}, x -> concat_ws(':', x.kind, x.start, x.stop)), ',')"


def scan(docs: DataFrame, owner: str = "source") -> DataFrame:
    """row, doc_id, owner (null without one), base and extra candidate spans of each document."""
    arrays = [f"{spans_of(k, kind, p, g)} AS s_{kind}" for k, (kind, p, g) in enumerate(KINDS)]
    found = docs.selectExpr("doc_id", f"cast({owner} AS string) AS owner", "translate(coalesce(text, ''), '\u0001', '\u0002') AS t").selectExpr(
        "monotonically_increasing_id() AS row", "doc_id", "owner", *arrays
    )
    base = "array_sort(concat(filter(s_assign, x -> length(x.value) >= 6), s_access, s_hex))"
    mixed = "filter(s_token, x -> x.value RLIKE '[0-9]' AND x.value RLIKE '[A-Za-z]' AND length(regexp_replace(x.value, '[^0-9]', '')) >= 3)"
    return found.selectExpr("row", "doc_id", "owner", f"{base} AS base", f"{mixed} AS mixed").selectExpr(
        "row", "doc_id", "owner", "base", "filter(mixed, x -> NOT exists(base, b -> b.start < x.stop AND x.start < b.stop)) AS extra"
    )


def ownership(found: DataFrame) -> DataFrame:
    """hash, repositories, owners, size of each candidate value."""
    rows = found.where("size(base) + size(extra) > 0").selectExpr(
        "coalesce(cast(doc_id AS string), concat('row ', row)) AS repository", "coalesce(owner, concat('row ', row)) AS owner", "owner IS NULL AS apart",
        "explode(array_distinct(transform(concat(base, extra), x -> sha2(x.value, 256)))) AS hash",
    )
    by = lambda key: rows.groupBy("hash", *key).agg(F.count(F.lit(1)).alias("n")).groupBy("hash").agg(F.count(F.lit(1)).alias(key[0]), F.sum("n").alias("size"))
    owners = by(["owner", "apart"]).withColumnRenamed("owner", "owners")
    return owners.join(by(["repository"]).select("hash", F.col("repository").alias("repositories")), "hash")


def find_secrets(docs: DataFrame, owner: str = "source", owners: int = OWNERS, repositories: int = REPOSITORIES) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, live_spans, copied_spans."""
    found = materialize(scan(docs, owner), "secrets")
    stats = materialize(ownership(found), "owners")
    each = found.where("size(base) + size(extra) > 0").selectExpr("row", "explode(concat(base, extra)) AS x").selectExpr(
        "row", "x", "sha2(x.value, 256) AS hash"
    )
    live = f"owners <= {owners} AND repositories <= {repositories} AND {looks_random('x.value')}"
    judged = split_join(each, stats, "hash", most_frequent(stats, "hash", "size")).selectExpr("row", "x", f"{live} AS live").groupBy("row").agg(
        *[_collect(c, n) for c, n in (("live", "live"), ("NOT live", "copied"))]
    )
    out = found.join(judged, "row", "left")
    none = f"cast(array() AS array<{SPAN}>)"
    out = out.selectExpr("doc_id", "base", f"coalesce(live, {none}) AS live", f"coalesce(copied, {none}) AS copied")
    count = "cast(size(filter(base, x -> x.kind = '{0}')) AS bigint) AS n_{0}"
    return out.selectExpr("*", "array_sort(concat(base, filter(live, x -> x.kind = 'token'))) AS shown").selectExpr(
        "doc_id",
        *[count.format(k) for k in ("assign", "access", "hex")],
        f"sha2({text_of('base')}, 256) AS base_sha256",
        f"{text_of('shown')} AS spans",
        "cast(size(live) AS bigint) AS n_live",
        "cast(size(copied) AS bigint) AS n_copied",
        f"{text_of('live')} AS live_spans",
        f"{text_of('copied')} AS copied_spans",
    )


def _collect(condition: str, name: str) -> Column:
    return F.array_sort(F.collect_list(F.when(F.expr(condition), F.col("x")))).alias(name)


def op4_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def _sql() -> str:
    quote = lambda p: "'" + p.replace("'", "''") + "'"
    kinds = " UNION ALL ".join(
        f"SELECT rid, {k} AS ord, '{kind}' AS kind, regexp_extract_all(t, {quote(p)}) AS m, regexp_extract_all(t, {quote(p)}, {g}) AS v, string_split_regex(t, {quote(p)}) AS gaps FROM d WHERE regexp_matches(t, {quote(p)})"
        for k, (kind, p, g) in enumerate(KINDS)
    )
    joined = "coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, ord)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source AS owner, coalesce(text, '') AS t FROM documents),
k AS ({kinds}),
i AS (SELECT rid, ord, kind, m, v, gaps, unnest(range(1, len(m) + 1)) AS n FROM k),
s AS (SELECT rid, ord, kind, v[n] AS value, length(m[n]) AS size,
  length(array_to_string(list_slice(gaps, 1, n), '')) + length(array_to_string(list_slice(m, 1, n - 1), '')) AS start FROM i),
c AS (SELECT rid, ord, kind, value, start, start + size AS stop, sha256(value) AS hash FROM s
  WHERE CASE WHEN kind = 'assign' THEN length(value) >= 6 WHEN kind = 'token'
    THEN regexp_matches(value, '[A-Za-z]') AND length(regexp_replace(value, '[^0-9]', '', 'g')) >= 3 ELSE true END),
a AS (SELECT * FROM c WHERE kind <> 'token' OR NOT EXISTS (
  SELECT 1 FROM c b WHERE b.rid = c.rid AND b.kind <> 'token' AND b.start < c.stop AND c.start < b.stop)),
o AS (SELECT hash, count(DISTINCT coalesce('o' || owner, 'row ' || rid)) AS owners, count(DISTINCT coalesce('d' || doc_id, 'row ' || rid)) AS repositories
  FROM a JOIN d USING (rid) GROUP BY hash),
j AS (SELECT a.*, owners <= {OWNERS} AND repositories <= {REPOSITORIES} AND NOT regexp_matches(lower(value), '{PLACEHOLDER}')
  AND len(list_distinct(string_split(value, ''))) >= {VARIED} AS live FROM a JOIN o USING (hash)),
g AS (SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied,
  {joined} FILTER (kind <> 'token'), '') AS base, {joined} FILTER (kind <> 'token' OR live), '') AS spans,
  {joined} FILTER (live), '') AS live_spans, {joined} FILTER (NOT live), '') AS copied_spans FROM j GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
  coalesce(n_copied, 0) AS n_copied, coalesce(live_spans, '') AS live_spans, coalesce(copied_spans, '') AS copied_spans
FROM d LEFT JOIN g USING (rid)
"""


SQL = _sql()
