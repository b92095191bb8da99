"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The *ledger* holds, per document, the
measurements and one long whose bit b is set when rule b fails. A *policy* is a versioned set
of rules (a bit mask); applying one, or asking what each of its rules does, works on the stored
bits only and never on the text again:

* ``apply_policy``: a document is kept when ``fail_bits & mask = 0``;
* ``ablate``: documents are counted per distinct ``fail_bits & mask`` (partial counts in the
  map stage, at most 2^rules groups), and each rule's figures are bitwise sums over those
  groups: documents it fails, documents only it fails, documents kept without it.

Everything is DataFrame functions; one row is measured inside one expression, so a document
is never exploded and a hot source or a group of copies needs no shuffle at all.

Defined cases: a null or empty text has no words and zero measurements (it fails ``short``);
repeated rows give repeated results; a null ``doc_id`` stays null; further columns of the
input are ignored by ``measure`` and carried through by ``filter_documents``; an empty
table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import NOT_WS, let, materialise, table, words_of

SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``fails`` is a predicate over a struct of the measurements."""

    bit: int
    name: str
    fails: Callable[[Column], Column]


@dataclass(frozen=True)
class Policy:
    version: str
    rules: tuple[str, ...]


RULES = (
    Rule(0, "short", lambda m: m["n_words"] < 50),
    Rule(1, "repeats", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
    Rule(2, "symbols", lambda m: 100 * m["n_symbols"] > 30 * m["n_words"]),
    Rule(3, "shouting", lambda m: m["n_upper"] > m["n_lower"]),
    Rule(4, "dup_lines", lambda m: 100 * m["n_dup_lines"] > 50 * m["n_lines"]),
    Rule(
        5,
        "word_length",
        lambda m: (m["word_chars"] > 15 * m["n_words"]) | (m["word_chars"] < 2 * m["n_words"]),
    ),
)
POLICIES = {
    p.version: p
    for p in (
        Policy("v1", ("short", "repeats")),
        Policy("v2", ("short", "repeats", "symbols", "shouting", "dup_lines", "word_length")),
    )
}
BASE, CURRENT = "v1", "v2"


def mask(policy: Policy, rules: tuple[Rule, ...] = RULES) -> int:
    by_name = {r.name: r.bit for r in rules}
    return sum(1 << by_name[name] for name in policy.rules)


def _repeat_words(words: Column) -> Column:
    """Word positions inside 3-word windows that occur at least twice in the text.

    The windows are sorted with their positions; a window equal to a neighbour repeats. The
    sorted positions of those then cover min(3, gap to the previous one) words each.
    """
    n = F.size(words)

    def covered(positions: Column) -> Column:
        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            F.array_sort(positions),
            start,
            lambda acc, p: F.struct(
                p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    def same(a: Column, b: Column) -> Column:
        # the third word differs most often between neighbours of the sorted order
        return (a["c"] == b["c"]) & (a["b"] == b["b"]) & (a["a"] == b["a"])

    def repeated(windows: Column) -> Column:
        return F.filter(
            windows,
            lambda x, i: (
                F.coalesce(same(x, F.get(windows, i - 1)), F.lit(False))
                | F.coalesce(same(x, F.get(windows, i + 1)), F.lit(False))
            ),
        )

    zipped = F.arrays_zip(
        F.slice(words, 1, n - 2).alias("a"),
        F.slice(words, 2, n - 2).alias("b"),
        F.slice(words, 3, n - 2).alias("c"),
        F.sequence(F.lit(0), n - 3).alias("p"),
    )
    return F.when(
        n >= 3,
        let(
            F.array_sort(zipped),
            lambda w: covered(F.transform(repeated(w), lambda x: x["p"])),
        ),
    ).otherwise(F.lit(0).cast("long"))


def _measures(text: Column) -> Column:
    def of_words(w: Column, t: Column, lines: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            (F.size(F.split(t, SYMBOLS)) - 1).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeat_words(w).alias("n_repeat_words"),
            F.length(F.regexp_replace(t, "[^A-Z]+", "")).cast("long").alias("n_upper"),
            F.length(F.regexp_replace(t, "[^a-z]+", "")).cast("long").alias("n_lower"),
        )

    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_WS))
    return let(words_of(text), lambda w: let(lines, lambda ls: of_words(w, t, ls)))


def _fail_bits(measures: Column, rules: tuple[Rule, ...]) -> Column:
    out = F.lit(0).cast("long")
    for r in rules:
        bit = F.when(r.fails(measures), F.lit(1 << r.bit)).otherwise(F.lit(0))
        out = out.bitwiseOR(bit.cast("long"))
    return out


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id``, the measurements, and ``fail_bits`` (bit b set: rule b fails)."""
    measured = docs.select("doc_id", _measures(F.col("text")).alias("m"))
    return measured.select("doc_id", "m.*", _fail_bits(F.col("m"), rules).alias("fail_bits"))


def kept_by(policy: Policy, fail_bits: Column) -> Column:
    return fail_bits.bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def apply_policy(led: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``policy`` (its version) and ``kept``."""
    return led.withColumns(
        {"policy": F.lit(policy.version), "kept": kept_by(policy, F.col("fail_bits"))}
    )


def ablate(led: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: ``n_failed``, ``n_only`` (fails no other), ``n_kept_without``."""
    m = mask(policy)
    groups = led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(m).cast("long")).alias("bits")).agg(
        F.count("*").alias("n")
    )
    members = [r for r in rules if r.name in policy.rules]
    rule = F.explode(
        F.array(
            *[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).alias("b")) for r in members]
        )
    )
    bit = F.col("r.b").cast("long")
    rest = F.lit(m).cast("long").bitwiseXOR(bit)
    n = F.col("n")
    zero = F.lit(0).cast("long")
    return (
        groups.select("bits", "n", rule.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(bit) != 0, n).otherwise(zero)).alias("n_failed"),
            F.sum(F.when(F.col("bits") == bit, n).otherwise(zero)).alias("n_only"),
            F.sum(F.when(F.col("bits").bitwiseAND(rest) == 0, n).otherwise(zero)).alias(
                "n_kept_without"
            ),
        )
    )


def filter_documents(
    docs: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """The documents that the policy keeps, with all of their columns."""
    measured = docs.withColumn("__measures", _measures(F.col("text")))
    bits = _fail_bits(F.col("__measures"), rules)
    return measured.filter(kept_by(policy, bits)).drop("__measures")


def sole_rule(fail_bits: Column, policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """The policy's only rule that fails, NULL if none or several do: without that rule the
    document would be kept."""
    own = fail_bits.bitwiseAND(F.lit(mask(policy, rules)).cast("long"))
    out = F.lit(None).cast("string")
    for r in rules:
        out = F.when(own == (1 << r.bit), F.lit(r.name)).otherwise(out)
    return out


def judged(docs: DataFrame, base: Policy, policy: Policy) -> DataFrame:
    """The ledger with both policies' verdicts and the policy's ablations.

    The texts are read once: the ledger is written, and the verdicts, ``sole_rule`` and the
    ablation table (a row per rule) that gives ``n_sole``, the documents that this rule alone
    removes, all come from its bits.
    """
    led = materialise(ledger(docs), "rules-ledger")
    ablations = ablate(led, policy).select(F.col("rule").alias("sole_rule"), F.col("n_only").alias("n_sole"))
    verdicts = apply_policy(led, policy).withColumns(
        {
            "base_failed": ~kept_by(base, F.col("fail_bits")),
            "sole_rule": sole_rule(F.col("fail_bits"), policy),
        }
    )
    return verdicts.join(F.broadcast(ablations), "sole_rule", "left")  # a row per rule


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: every document's measurements, the verdicts of the base and current policy, and what
    the rules it fails do alone."""
    docs = table(spark, sf_dir, "documents")
    return judged(docs, POLICIES[BASE], POLICIES[CURRENT]).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "fail_bits",
        "sole_rule",
        "n_sole",
    )


# n_repeat_words by brute force: all windows of a row, counted, and the words they cover.
ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t,
         [x FOR x IN string_split_regex(t, '[\x20\x09-\x0D]+') IF x <> ''] AS ws,
         [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls
  FROM d
), p AS (
  SELECT rid, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c, i
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
), r AS (
  SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM p
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n
  FROM r, (SELECT unnest([0, 1, 2]) AS k) WHERE n >= 2 GROUP BY rid
), m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
         length(array_to_string(ws, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         len(ls)::BIGINT AS n_lines,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_upper,
         length(regexp_replace(t, '[^a-z]', '', 'g'))::BIGINT AS n_lower
  FROM w LEFT JOIN covered USING (rid)
), f AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END
    + CASE WHEN n_upper > n_lower THEN 8 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 16 ELSE 0 END
    + CASE WHEN word_chars > 15 * n_words OR word_chars < 2 * n_words THEN 32 ELSE 0 END
    )::BIGINT AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       fail_bits = 0 AS kept, fail_bits,
       CASE fail_bits WHEN 1 THEN 'short' WHEN 2 THEN 'repeats' WHEN 4 THEN 'symbols'
         WHEN 8 THEN 'shouting' WHEN 16 THEN 'dup_lines' WHEN 32 THEN 'word_length' END AS sole_rule,
       CASE WHEN fail_bits IN (1, 2, 4, 8, 16, 32)
         THEN count(*) OVER (PARTITION BY fail_bits) END AS n_sole
FROM f
"""
