"""Personal data by weak supervision.

* *Candidates*: four base kinds (email, ip, card, phone) by fixed rules, which always stay, and
  wider shapes (account and dialling numbers, social security numbers, IBANs, titled names).
* *Labelers*: regex (does the strict rule hold), gazetteer (issuer and country prefixes, known
  endings, words such as "tel" in four languages before it), context (stands alone, or inside a
  longer token), layout (the usual grouping), company (other kinds of candidates in the text)
  and code (follows an assignment or a version mark) vote 1, -1 or 0 on every candidate.
* *Aggregation*: votes are counted per (kind, vote pattern), at most kinds * 3^6 rows whatever
  the corpus. Expectation-maximisation on these counts estimates each labeler's reliabilities
  (how often it votes what, for personal data and for other text) and each kind's share.
* *Span classifier*: a logistic model over the kind, the votes and the length class of a
  candidate, trained on the estimated probabilities, decides which candidates are added.

Texts are scanned by DataFrame expressions only; the driver sees the counts. A row is scanned
and classified inside expressions, without a shuffle, so hot sources and groups of copies cost
no more than other rows.

Defined cases: a null or empty text has no spans; null ids and repeated rows are rows like any
other; a corpus without candidates adds nothing; other columns are ignored by ``find`` and
carried by ``mask``, which leaves null texts null; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import let, materialise, table
from fleetlens.llm.spans import digits_of, joined, luhn, matches, or_empty, swapped

BASE = ("email", "ip", "card", "phone")
ADDED = ("account", "dial", "ssn", "iban", "name")
KINDS = BASE + ADDED
LABELERS = ("regex", "gazetteer", "context", "layout", "company", "code")
SIZES = 4  # classes of a candidate's length

# (?:(?<!X)|\G)X+ starts a run of X at its first character or where the last match ended, which
# is where the leftmost match starts; plain X+ would try every character of a long run. The
# possessive ++ on groups keeps Java's matcher from recursing once per repetition.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "dial": r"(?:(?<![0-9+(])|\G)\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "ssn": r"(?:(?<![0-9-])|\G)[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?:(?<![A-Z0-9])|\G)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}+(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": r"(?:(?<![A-Za-z])|\G)(?:Mrs|Mr|Ms|Dr|Prof)\.? [A-Z][a-z]+(?: [A-Z][a-z]+)?",
}
WORDS = {
    "email": r"(?i)(?:mail|correo|courriel|contact|kontakt)",
    "ip": r"(?i)(?:\bip\b|host|server|adres)",
    "card": r"(?i)(?:card|karte|carte|tarjeta|visa|master)",
    "phone": r"(?i)(?:phone|\btel|call|llam|appel|rufnummer|mobil|fax)",
    "account": r"(?i)(?:card|karte|carte|tarjeta|visa|master|account|konto|compte|cuenta|number)",
    "dial": r"(?i)(?:phone|\btel|call|llam|appel|rufnummer|mobil|fax)",
    "ssn": r"(?i)(?:ssn|social|security|tax)",
    "iban": r"(?i)(?:iban|account|konto|compte|cuenta|bank)",
    "name": r"(?i)(?:dear|liebe|cher|estimad|\bby|from|von)",
}
PREFIXES = {
    "email": r"\.(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|us)$",
    "ip": r"^(?!0|127\.|255\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": r"^\+(?:1|33|34|44|49)(?![0-9])",
    "account": r"^(?:4|5[1-5]|2[2-7]|3[47]|6)",
    "dial": r"^\(?[2-9]",
    "ssn": r"^(?!000|666|9)",
    "iban": r"^(?:DE|FR|ES|GB|IT|NL|AT|BE|CH|PT|PL)",
    "name": r"^(?:Mrs|Mr|Ms|Dr)",
}
LAYOUTS = {
    "email": r"^[A-Za-z0-9][^@]*@.*\.[A-Za-z]{2,}$",
    "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^(?:[0-9]{14,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$",
    "phone": r"^\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}$",
    "account": r"^(?:[0-9]{14,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$",
    "dial": r"^(?:\([0-9]{3}\) [0-9]{3}-[0-9]{4}|[0-9]{3}([.-])[0-9]{3}\1[0-9]{4})$",
    "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
    "iban": r"^[A-Z]{2}[0-9]{2}(?:[A-Z0-9]+|(?: [A-Z0-9]{4})+(?: [A-Z0-9]{1,3})?)$",
    "name": r"^(?:Mrs|Mr|Ms|Dr|Prof)\.? [A-Z][a-z]+ [A-Z][a-z]+$",
}

SPAN = "struct<start: bigint, rank: int, kind: string, end: bigint"
CANDIDATE = f"array<{SPAN}, size: int, " + ", ".join(f"{v}: int" for v in LABELERS) + ">>"
SPANS = f"array<{SPAN}>>"


def _parts_in_range(value: Column) -> Column:
    # doubles hold digit runs of any length
    return F.forall(F.split(value, r"\."), lambda p: p.cast("double") <= 255)


def _n_digits(value: Column) -> Column:
    return F.length(digits_of(value))


def _rules(kind: str, value: Column) -> Column:
    """What a match of ``PATTERNS`` has to meet besides."""
    if kind == "ip":
        return _parts_in_range(value)
    if kind == "card":
        return _n_digits(value).between(14, 19) & luhn(value)
    if kind == "phone":
        return _n_digits(value).between(10, 15)
    if kind == "account":
        return _n_digits(value).between(12, 19) & ~(_n_digits(value).between(14, 19) & luhn(value))
    return F.lit(True)


def _vote(kind: str, s: Column) -> list[Column]:
    value, before, after = s["value"], s["before"], s["after"]
    one, no, none = F.lit(1), F.lit(-1), F.lit(0)
    if kind in BASE:
        strict = one
    elif kind == "account":
        strict = no
    elif kind == "iban":
        strict = F.when(F.length(F.replace(value, F.lit(" "))).between(15, 32), one).otherwise(no)
    else:
        strict = none
    return [
        strict.alias("regex"),
        F.when(before.rlike(WORDS[kind]) | value.rlike(PREFIXES[kind]), one)
        .otherwise(none)
        .alias("gazetteer"),
        F.when(before.rlike(r"[\p{L}0-9_.-]$") | after.rlike(r"^[\p{L}0-9_%]"), no)
        .otherwise(one)
        .alias("context"),
        F.when(value.rlike(LAYOUTS[kind]), one).otherwise(no).alias("layout"),
        none.alias("company"),
        F.when(before.rlike(r"(?i)(?:[=:#/\"']|\bv|version|token|rev) ?$"), no)
        .otherwise(none)
        .alias("code"),
    ]


def _candidates_of(kind: str, text: Column) -> Column:
    pattern = PATTERNS["card" if kind == "account" else kind]
    only_if = {
        "email": text.contains("@"),
        "phone": text.contains("+"),
        "name": F.lit(True),
        "ip": text.rlike(r"[0-9]\.[0-9]"),
        "card": text.rlike("[0-9][ -]?[0-9]"),
        "account": text.rlike("[0-9][ -]?[0-9]"),
    }.get(kind, text.rlike("[0-9]{2}"))
    found = matches(text, pattern, lambda v: _rules(kind, v), only_if)
    size = {"name": 12, "email": 16, "ip": 11, "iban": 20}.get(kind)

    def full(s: Column) -> Column:
        n = F.length(s["value"]) / size if size else _n_digits(s["value"]) / 8
        return F.struct(
            s["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            F.lit(kind).alias("kind"),
            s["end"].alias("end"),
            F.least(F.floor(n), F.lit(SIZES - 1)).cast("int").alias("size"),
            *_vote(kind, s),
        )

    return or_empty(F.transform(found, full), CANDIDATE)


def candidates(text: Column) -> Column:
    """All candidates of a text with their votes, as an array of ``CANDIDATE`` structs."""

    def company(all_: Column) -> Column:
        kinds = F.size(F.array_distinct(F.transform(all_, lambda s: s["kind"])))
        return let(
            kinds,
            lambda n: F.transform(
                all_,
                lambda s: s.withField("company", F.when(n > 1, F.lit(1)).otherwise(F.lit(0))),
            ),
        )

    def not_inside_base(all_: Column) -> Column:
        """Added candidates that overlap a base span are that span."""
        last_base = len(BASE) - 1
        return let(
            F.filter(all_, lambda s: s["rank"] <= last_base),
            lambda base: F.filter(
                all_,
                lambda s: (s["rank"] <= last_base)
                | ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
            ),
        )

    def scan(t: Column) -> Column:
        return let(F.concat(*[_candidates_of(k, t) for k in KINDS]), not_inside_base)

    return let(let(swapped(text), scan), company).cast(CANDIDATE)


# ---- aggregation --------------------------------------------------------------------------


@dataclass(frozen=True)
class Model:
    """Logistic weights: per kind, per (labeler, vote), per size class; and what EM found."""

    kind: dict[str, float]
    vote: dict[str, tuple[float, float, float]]  # for -1, 0, 1
    size: tuple[float, ...]
    reliability: dict[str, tuple[tuple[float, ...], tuple[float, ...]]]

    def adds(self, s: Column) -> Column:
        total = F.lit(0.0)
        for k, w in self.kind.items():
            total = total + F.when(s["kind"] == k, F.lit(w)).otherwise(F.lit(0.0))
        for name, (low, mid, high) in self.vote.items():
            total = total + F.when(s[name] == 1, F.lit(high)).when(
                s[name] == 0, F.lit(mid)
            ).otherwise(F.lit(low))
        for i, w in enumerate(self.size):
            total = total + F.when(s["size"] == i, F.lit(w)).otherwise(F.lit(0.0))
        return total > 0


def estimate(kind: np.ndarray, votes: np.ndarray, n: np.ndarray, rounds: int = 100):
    """EM over vote patterns: ``votes`` in 0, 1, 2 for -1, 0, 1; ``n`` rows of each.

    Returns each pattern's probability of being personal data, and per labeler the distributions
    of its votes for other text and for personal data. Starts from labelers that are right more
    often than not; one weak vote of each kind is added, so rare patterns stay moderate.
    """
    k, labelers = len(KINDS), votes.shape[1]
    start = np.array([[0.5, 0.3, 0.2], [0.2, 0.3, 0.5]])  # class x vote
    theta = np.repeat(start[:, None, :], labelers, axis=1)  # class x labeler x vote
    prior = np.full(k, 0.5)
    p = np.full(len(n), 0.5)
    for _ in range(rounds):
        at = np.arange(labelers)
        like = np.log(theta[:, at, votes]).sum(axis=2)  # class x pattern
        odds = like[1] - like[0] + np.log(prior[kind] / (1 - prior[kind]))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        for c, weight in ((0, n * (1 - new)), (1, n * new)):
            for j in range(labelers):
                seen = np.bincount(votes[:, j], weights=weight, minlength=3) + 3 * start[c]
                theta[c, j] = seen / seen.sum()
        of_kind = np.bincount(kind, weights=n, minlength=k)
        prior = (np.bincount(kind, weights=n * new, minlength=k) + 1) / (of_kind + 2)
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return new, theta


def fit(counts: list[tuple[str, int, tuple[int, ...], int]]) -> Model:
    """The model from rows (kind, size, votes, how many)."""
    counts = sorted(counts)
    if counts:
        kind = np.array([KINDS.index(c[0]) for c in counts])
        votes = np.array([c[2] for c in counts]) + 1
        n = np.array([c[3] for c in counts], dtype=np.float64)
        truth, theta = estimate(kind, votes, n)
    else:
        kind, n = np.zeros(0, dtype=int), np.zeros(0)
        votes, truth = np.ones((0, len(LABELERS)), dtype=int), np.zeros(0)
        theta = np.full((2, len(LABELERS), 3), 1 / 3)
    width = len(KINDS) + 3 * len(LABELERS) + SIZES
    x = np.zeros((len(counts), width))
    rows = np.arange(len(counts))
    x[rows, kind] = 1
    for j in range(len(LABELERS)):
        x[rows, len(KINDS) + 3 * j + votes[:, j]] = 1
    x[rows, [width - SIZES + c[1] for c in counts]] = 1
    # Newton steps on the cross-entropy against the probabilities, with a ridge; a kind that
    # was never seen keeps a slightly negative weight, so it adds nothing by itself
    beta = np.zeros(width)
    ridge = np.full(width, 0.1)
    rest = np.where(np.arange(width) < len(KINDS), -0.01, 0.0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (n * (p - truth)) + ridge * (beta - rest)
        hess = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(hess, grad)
        beta -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    v = beta[len(KINDS) : width - SIZES].reshape(-1, 3)
    return Model(
        kind={k: float(beta[i]) for i, k in enumerate(KINDS)},
        vote={name: tuple(map(float, v[j])) for j, name in enumerate(LABELERS)},
        size=tuple(map(float, beta[width - SIZES :])),
        reliability={
            name: (tuple(map(float, theta[0, j])), tuple(map(float, theta[1, j])))
            for j, name in enumerate(LABELERS)
        },
    )


def learn(scanned: DataFrame) -> Model:
    """The model from a frame with a ``candidates`` column."""
    votes = [F.col(f"c.{v}") for v in LABELERS]
    patterns = (
        scanned.select(F.explode("candidates").alias("c"))
        .groupBy(F.col("c.kind"), F.col("c.size"), *votes)
        .agg(F.count("*").alias("n"))
        .collect()
    )  # at most kinds * sizes * 3^6 rows
    return fit([(r["kind"], r["size"], tuple(r[2 : 2 + len(LABELERS)]), r["n"]) for r in patterns])


def _chosen(model: Model, cands: Column) -> Column:
    last_base = len(BASE) - 1
    return F.array_sort(
        F.transform(
            F.filter(cands, lambda s: (s["rank"] <= last_base) | model.adds(s)),
            lambda s: F.struct(s["start"], s["rank"], s["kind"], s["end"]),
        ).cast(SPANS)
    )


# ---- results ------------------------------------------------------------------------------


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``candidates`` of every document, written once."""
    return materialise(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), candidates(F.col("text")).alias("candidates")
        ),
        "pii-scan",
    )


def find(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``found``: the spans of every document, base and added."""
    scanned = scan(docs)
    return scanned.select("doc_id", _chosen(learn(scanned), F.col("candidates")).alias("found"))


def masked(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first
    (longer, if both start at one place) counts, and what another has beyond it goes with it."""

    def mark(kind: Column) -> Column:
        return F.concat(F.lit("["), F.upper(kind), F.lit("]"))

    start = F.struct(
        F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts")
    )

    def add(acc: Column, s: Column) -> Column:
        parts = F.when(
            s["start"] >= acc["at"],
            F.concat(
                acc["parts"],
                F.array(
                    F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
                    mark(s["kind"]),
                ),
            ),
        ).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("parts"))

    ordered = F.array_sort(
        F.transform(
            found,
            lambda s: F.struct(
                s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"),
                s["end"].alias("end"),
            ),
        )
    )
    whole = F.aggregate(
        ordered,
        start,
        add,
        lambda acc: F.concat(
            F.array_join(acc["parts"], ""),
            F.substr(text, (acc["at"] + 1).cast("int"), F.length(text)),
        ),
    )
    return F.when(F.size(found) > 0, whole).otherwise(text)


def mask(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked in ``text``; columns as given."""
    model = learn(scan(docs))
    found = let(
        _chosen(model, candidates(F.col("text"))), lambda f: masked(F.col("text"), f)
    )
    return docs.select(*[found.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: every document's personal data."""
    rows = find(table(spark, sf_dir, "documents"))
    last_base = len(BASE) - 1
    base = F.filter("found", lambda s: s["rank"] <= last_base)

    def n(kind: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    return rows.select(
        "doc_id",
        *[n(k).alias(f"n_{k}") for k in BASE],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )
