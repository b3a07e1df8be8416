"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import math
import re
from collections import Counter

from tidelane.llm import secret_scan


def secrets(text: str | None) -> tuple[str, str]:
    """(base spans, all spans)."""
    text = text or ""
    spans = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 12:
            spans.append((m.start(), 0, m.end()))
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    base = sorted(spans)
    for order, kind in enumerate(secret_scan.CLASSES, 3):
        for m in re.finditer(f"[{re.escape(kind.alphabet)}]+", text):
            if len(m[0]) < kind.window or any(re.search(p, m[0]) for p in secret_scan.ALLOWED):
                continue
            high = []
            for i in range(len(m[0]) - kind.window + 1):
                counts = Counter(m[0][i : i + kind.window]).values()
                if -sum(c / kind.window * math.log2(c / kind.window) for c in counts) >= kind.bits:
                    high.append(i)
            if high:
                spans.append((m.start() + high[0], order, m.start() + high[-1] + kind.window))
    kinds = [*secret_scan.BASE_KINDS, *(c.kind for c in secret_scan.CLASSES)]
    join = lambda s: ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in s)
    return join(base), join(sorted(spans))
