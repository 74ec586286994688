"""Plain versions of the operators' contracts."""

import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = r"[^\x20\x09-\x0D]+"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def private(text):
    out = {"email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]}
    out["ip"] = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    card = [(m, re.sub("[ -]", "", m[0])) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)]
    out["card"] = [m.span() for m, d in card if 13 <= len(d) <= 19 and luhn(d)]
    out["phone"] = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return [(k, a, b) for k in ("email", "ip", "card", "phone") for a, b in out[k]]


def secret(text):
    assign = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(assign, text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(k, a, b) for a, _, b, k in sorted(out)]


def measures(text):
    words = re.findall(WORD, text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def fingerprint(text):
    words = re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(number, links, names):
    parent = list(range(number))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    least = defaultdict(list)
    for i in range(number):
        least[root(i)].append(names[i])
    return [min((n for n in least[root(i)] if n is not None), default=None) for i in range(number)]


def near(prints, radius=4):
    f = np.array(prints, dtype=np.uint64)
    return [(i, int(j) + i + 1) for i in range(len(f)) for j in np.flatnonzero(np.bitwise_count(f[i] ^ f[i + 1:]) <= radius)]
