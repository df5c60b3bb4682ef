"""Plain sequential versions of the text operators, to check against on small inputs."""

from __future__ import annotations

import re
import string

SPACE = r"[\x20\x09-\x0D]"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def text_stats(text):
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def dedup_lines(rows, min_chars=40, min_docs=5):
    """``rows``: (id, text); results in the same order: kept text, number of lines, number dropped."""
    key = lambda line: re.sub(f"^{SPACE}+|{SPACE}+$", "", line).translate(LOWER)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(i)
    shared = {k: max(x for x in ids if x is not None) for k, ids in holders.items() if len(ids - {None}) >= min_docs}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (key(x) in shared and (i is None or i < shared[key(x)]))]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def shingles(text, k):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < k:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


class Groups:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.find(a)] = self.find(b)


def jaccard_components(rows, k=3, percent=90):
    """(id, set size, component) of every row, sorted."""
    sets = [shingles(t, k) for _, t in rows]
    groups = Groups(len(rows))
    first = {}
    for i, (key, _) in enumerate(rows):
        if key is not None and sets[i]:
            groups.join(i, first.setdefault(key, i))
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                groups.join(i, j)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None and sets[i]:
            low[groups.find(i)] = min(low.get(groups.find(i), key), key)
    out = [(key, len(sets[i]), low.get(groups.find(i)) if sets[i] else key) for i, (key, _) in enumerate(rows)]
    return sorted(out, key=str)


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_secrets(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def linked_secrets(text, parts, scope):
    found = []
    for k, pattern in enumerate(parts.values()):
        found += [(m.start(), k + 3, m.end()) for m in re.finditer(pattern.replace(r"[^\s", r"[^ \t\n\x0b\f\r"), text, re.A)]
    need = {3: {4}, 4: {3, 5}, 5: {4}}
    return [x for x in found if any(y[1] in need[x[1]] and max(x[0], y[0]) - min(x[2], y[2]) <= scope for y in found)]
