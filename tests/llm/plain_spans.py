"""The fixed rules of the span operators, in plain Python."""

import hashlib
import re


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c)
        if i % 2:
            x = 2 * x - 9 if x > 4 else 2 * x
        total += x
    return total % 10 == 0


def n_digits(v):
    return re.sub(r"[^0-9]", "", v)


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    (
        "ip",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        lambda m: all(int(p) <= 255 for p in m.group().split(".")),
    ),
    (
        "card",
        r"[0-9]([\x20-]?[0-9])+",
        lambda m: 14 <= len(n_digits(m.group())) <= 19 and luhn(n_digits(m.group())),
    ),
    (
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda m: 10 <= len(n_digits(m.group())) <= 15,
    ),
]
SECRETS = [
    (
        "assign",
        r"(?i:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+))",
        lambda m: len(m.group(2)) >= 6,
    ),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 24),
]


def base_spans(text, rules):
    out = []
    for rank, (kind, pattern, ok) in enumerate(rules):
        for m in re.finditer(pattern, text or "", re.ASCII):
            if ok(m):
                out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))


def digest(text, rules):
    spans = base_spans(text, rules)
    counts = [sum(k == kind for _, _, k, _ in spans) for kind, _, _ in rules]
    return counts, hashlib.sha256(joined(spans).encode()).hexdigest(), joined(spans)
