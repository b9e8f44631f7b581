"""Plain versions of the contracts, for small inputs."""

import hashlib
import re
import zlib

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KINDS = ("email", "ip", "card", "phone")
PII = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(text):
    return zlib.crc32(("" if text is None else text).encode())


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return (all(int(x) <= 255 for x in found.split(".")) if kind == "ip"
            else 12 <= len(digits) <= 19 and luhn(digits) if kind == "card"
            else 9 <= len(digits) <= 15 if kind == "phone" else True)


def base_spans(text):
    """[(start, kind number, end)] sorted."""
    return sorted((m.start(), at, m.end()) for at, kind in enumerate(KINDS)
                  for m in PII[kind].finditer(text or "") if _valid(kind, m.group()))


def written(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def bench_words(text):
    return BENCH_WORD.findall((text or "").translate(LOWER))


def contaminated(docs, items, span=10):
    """docs: [text]; items: [(id, text)]. [(n_words, n_hit, sorted item ids)] by place."""
    windows = {}
    for item, text in items:
        w = bench_words(text)
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for text in docs:
        w, hit, found = bench_words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i:i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= {str(x) for x in got if x is not None}
        out.append((len(w), len(hit), sorted(found)))
    return out


def words(text):
    return (text or "").encode().translate(bytes.maketrans(
        b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")).split()


def shingles(text, n=5):
    w = words(text)
    return ({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n
            else {tuple(w)} if w else set())


def components(docs):
    """docs: [(id, text)] with ids unique. {id: (set size, smallest id reachable)}."""
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in by.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def chat(rows):
    """rows: [(conv, turn, role, text)]. {conv: (n, digest, loss chars, loss digest)}."""
    by = {}
    for c, turn, role, text in rows:
        by.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for *_, r, t in turns)), len(loss),
                  sha(loss))
    return out
