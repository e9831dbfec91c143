"""Plain Python versions that the operators are held against."""

from __future__ import annotations

import hashlib
import re

ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)


def joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def base_secrets(text: str):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return out + [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_personal(text: str):
    out = [
        (m.start(), 0, "email", m.end())
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)
    ]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return out
