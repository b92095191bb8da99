"""Secret scan with corpus-wide ownership frequency.

* *Candidates* per whole text, by expressions only: three base kinds (assignments, access key
  ids, hex strings) whose spans always stay, and wider shapes (vendor tokens, signed web tokens,
  private key headers, long mixed-case tokens), taken where no kind before them matched.
* *Ownership*: a candidate's hash is counted over the distinct repositories and owners that
  hold it, over all documents. Distinct (hash, owner, repository) rows come first, with
  partial results in the map stage, so a string copied into a third of all documents is one
  row per owner and repository before it meets others.
* *Verdict*: a candidate is *live* when it looks random (enough different characters, no
  placeholder in it) and neither owners nor repositories hold it widely: at most ``MAX_OWNERS``
  owners, and at most ``MAX_REPOS`` repositories in all, so that what one owner spreads over many
  repositories is an example as well as what many owners copy. Only live candidates of the wider
  shapes are added to the spans; base spans are counted as live or example. ``n_owners`` and
  ``n_repos`` are those of a document's most widely held candidate.

In the ``documents`` table the owner is ``source`` and the repository ``source/lang``.

Defined cases: a null or empty text has no spans; a null owner or repository counts as one more
of its kind; null ids and repeated rows are rows of their own; further columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import let, materialise, table
from fleetlens.llm.spans import joined, matches, or_empty, swapped

BASE = ("assign", "access", "hex")
ADDED = ("vendor", "jwt", "private_key", "opaque")
KINDS = BASE + ADDED
MAX_OWNERS = 2
MAX_REPOS = 4
MIN_DISTINCT = 10

# fixed values: the shapes as RE2 and Java both read them
SHAPES = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
    "vendor": r"(?:gh[opsur]_[A-Za-z0-9]{30,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,})",
    "jwt": r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}",
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "opaque": r"[A-Za-z0-9+/_-]{32,}",
}
PLACEHOLDER = r"(?i)(?:example|sample|dummy|changeme|placeholder|x{4}|0{6}|123456)"

SPAN = "struct<start: bigint, rank: int, kind: string, end: bigint"
CANDIDATES = f"array<{SPAN}, hash: string, looks: boolean>>"
SPANS = f"array<{SPAN}>>"


def _kept(kind: str, value: Column) -> Column:
    if kind == "assign":
        return F.length(F.regexp_extract(value, SHAPES["assign"], 2)) >= 6
    if kind == "opaque":
        return value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")
    return F.lit(True)


def _secret(kind: str, value: Column) -> Column:
    return F.regexp_extract(value, SHAPES["assign"], 2) if kind == "assign" else value


def _looks_random(secret: Column) -> Column:
    different = F.size(F.array_distinct(F.split(secret, "")))
    return (different >= MIN_DISTINCT) & ~secret.rlike(PLACEHOLDER)


def _candidates_of(kind: str, text: Column) -> Column:
    only_if = {
        "assign": text.contains("=") | text.contains(":"),
        "access": text.contains("AKIA"),
        "jwt": text.contains("eyJ"),
        "private_key": text.contains("PRIVATE KEY"),
    }.get(kind)
    found = matches(text, SHAPES[kind], lambda v: _kept(kind, v), only_if)

    def full(s: Column) -> Column:
        return let(
            _secret(kind, s["value"]),
            lambda secret: F.struct(
                s["start"].alias("start"),
                F.lit(KINDS.index(kind)).alias("rank"),
                F.lit(kind).alias("kind"),
                s["end"].alias("end"),
                F.sha2(secret, 256).alias("hash"),
                _looks_random(secret).alias("looks"),
            ),
        )

    return or_empty(F.transform(found, full), CANDIDATES)


def candidates(text: Column) -> Column:
    """All candidates of a text; one of the wider shapes only where no kind before it matched."""
    last_base = len(BASE) - 1

    def alone(all_: Column) -> Column:
        return F.filter(
            all_,
            lambda s: (s["rank"] <= last_base)
            | ~F.exists(
                all_,
                lambda b: (b["rank"] < s["rank"]) & (b["start"] < s["end"]) & (s["start"] < b["end"]),
            ),
        )

    return let(
        swapped(text), lambda t: let(F.concat(*[_candidates_of(k, t) for k in KINDS]), alone)
    ).cast(CANDIDATES)


def ownership(found: DataFrame) -> DataFrame:
    """``hash``, ``n_owners``, ``n_repos`` from rows (hash, owner, repo)."""
    return (
        found.select("hash", "owner", "repo")
        .distinct()
        .groupBy("hash", "owner")
        .agg(F.count("*").alias("repos"))
        .groupBy("hash")
        .agg(F.count("*").alias("n_owners"), F.sum("repos").alias("n_repos"))
    )


def find(docs: DataFrame, owner: Column, repo: Column) -> DataFrame:
    """Per document: ``found`` (all spans), ``n_live`` and ``n_example`` among its candidates, and
    the most owners and repositories that one of them has."""
    scanned = materialise(
        docs.select(
            F.monotonically_increasing_id().alias("row"),  # fixed by being written
            F.col("doc_id").cast("long").alias("doc_id"),
            owner.cast("string").alias("owner"),
            repo.cast("string").alias("repo"),
            candidates(F.col("text")).alias("cands"),
        ),
        "secrets-scan",
    )
    each = scanned.filter(F.size("cands") > 0).select(
        "row", "owner", "repo", F.explode("cands").alias("c")
    )
    each = each.select("row", "owner", "repo", F.col("c.hash").alias("hash"), "c")
    last_base = len(BASE) - 1
    live = F.col("c.looks") & (F.col("n_owners") <= MAX_OWNERS) & (F.col("n_repos") <= MAX_REPOS)
    judged = each.join(ownership(each), "hash").select(
        "row", "c", live.alias("live"), "n_owners", "n_repos"
    )
    span = F.struct("c.start", "c.rank", "c.kind", "c.end")
    per_row = judged.groupBy("row").agg(
        F.collect_list(F.when(F.col("live") | (F.col("c.rank") <= last_base), span)).alias("found"),
        F.sum(F.col("live").cast("long")).alias("n_live"),
        F.sum((~F.col("live")).cast("long")).alias("n_example"),
        F.max("n_owners").alias("n_owners"),
        F.max("n_repos").alias("n_repos"),
    )
    none = F.array().cast(SPANS)
    zero = F.lit(0).cast("long")
    return scanned.select("row", "doc_id").join(per_row, "row", "left").select(
        "doc_id",
        F.array_sort(F.coalesce(F.col("found").cast(SPANS), none)).alias("found"),
        F.coalesce("n_live", zero).alias("n_live"),
        *[F.coalesce(c, zero).alias(c) for c in ("n_example", "n_owners", "n_repos")],
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: every document's secrets."""
    docs = table(spark, sf_dir, "documents")
    repo = F.concat(F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce("lang", F.lit("")))
    rows = find(docs, F.col("source"), repo)
    last_base = len(BASE) - 1

    def n(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return rows.select(
        "doc_id",
        *[n(k).alias(f"n_{k}") for k in BASE],
        F.sha2(joined(F.filter("found", lambda s: s["rank"] <= last_base)), 256).alias(
            "base_sha256"
        ),
        joined(F.col("found")).alias("spans"),
        "n_live",
        "n_example",
        "n_owners",
        "n_repos",
    )


def _oracle() -> str:
    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    parts = "\nUNION ALL\n".join(
        f"SELECT rid, {i} AS rank, '{k}' AS kind, string_split(regexp_replace(t, "
        f"{quoted(SHAPES[k])}, chr(1) || '\\0' || chr(1), 'g'), chr(1)) AS segs FROM d"
        for i, k in enumerate(KINDS)
    )
    assign = quoted(SHAPES["assign"])
    last_base = len(BASE) - 1
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS owner,
         coalesce(source, '') || '/' || coalesce(lang, '') AS repo,
         replace(coalesce(text, ''), chr(1), chr(2)) AS t
  FROM documents
), m AS (
{parts}
), s AS (
  SELECT rid, rank, kind, unnest(segs) AS v, generate_subscripts(segs, 1) AS i
  FROM m WHERE len(segs) > 1
), c AS (
  SELECT rid, rank, kind, v, i,
         sum(length(v)) OVER (PARTITION BY rid, rank ORDER BY i) AS stop
  FROM s
), f AS (
  SELECT rid, rank, kind, (stop - length(v))::BIGINT AS start, stop::BIGINT AS stop,
         CASE WHEN kind = 'assign' THEN regexp_extract(v, {assign}, 2) ELSE v END AS secret
  FROM c
  WHERE i % 2 = 0
    AND (kind <> 'assign' OR length(regexp_extract(v, {assign}, 2)) >= 6)
    AND (kind <> 'opaque' OR (regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Z]')
                              AND regexp_matches(v, '[a-z]')))
), a AS (
  SELECT rid, rank, kind, start, stop, sha256(secret) AS hash,
         (len(list_distinct(string_split(secret, ''))) >= {MIN_DISTINCT}
          AND NOT regexp_matches(secret, {quoted(PLACEHOLDER)})) AS looks
  FROM f
  WHERE rank <= {last_base} OR NOT EXISTS (
    SELECT 1 FROM f AS b WHERE b.rid = f.rid AND b.rank < f.rank
      AND b.start < f.stop AND f.start < b.stop)
), o AS (
  SELECT hash, count(DISTINCT coalesce('+' || owner, '')) AS n_owners,
         count(DISTINCT coalesce('+' || owner, '') || chr(1) || repo) AS n_repos
  FROM a JOIN d USING (rid) GROUP BY hash
), j AS (
  SELECT a.*, n_owners, n_repos,
         looks AND n_owners <= {MAX_OWNERS} AND n_repos <= {MAX_REPOS} AS live
  FROM a JOIN o USING (hash)
), k AS (
  SELECT rid, kind, rank, start, live, kind || ':' || start || ':' || stop AS span
  FROM j WHERE live OR rank <= {last_base}
), g AS (
  SELECT rid,
         sum((kind = 'assign')::INT)::BIGINT AS n_assign,
         sum((kind = 'access')::INT)::BIGINT AS n_access,
         sum((kind = 'hex')::INT)::BIGINT AS n_hex,
         string_agg(span, ',' ORDER BY start, rank) FILTER (rank <= {last_base}) AS base,
         string_agg(span, ',' ORDER BY start, rank) AS spans
  FROM k GROUP BY rid
), n AS (
  SELECT rid, sum(live::INT)::BIGINT AS n_live, sum((NOT live)::INT)::BIGINT AS n_example,
         max(n_owners) AS n_owners, max(n_repos) AS n_repos
  FROM j GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
       coalesce(n_example, 0) AS n_example, coalesce(n_owners, 0) AS n_owners,
       coalesce(n_repos, 0) AS n_repos
FROM d LEFT JOIN g USING (rid) LEFT JOIN n USING (rid)
"""


ORACLE = _oracle()
