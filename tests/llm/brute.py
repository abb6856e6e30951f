"""Plain definitions of what the operators return."""

import collections
import hashlib
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def quality_base(text):
    text = text or ""
    words = SPACED.findall(text)
    windows = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered))


def shingle_set(text):
    words = SPACED.findall(lower(text))
    if len(words) >= 5:
        return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    return frozenset([tuple(words)] if words else [])


def components(texts: dict):
    sets = {k: shingle_set(t) for k, t in texts.items()}
    parent = {k: k for k in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in texts}


def removed(texts: dict, length=100):
    """Per id, a mark for each byte of the text."""
    seen, out = set(), {}
    for k in sorted(texts):
        data = (texts[k] or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            piece = data[i:i + length]
            if piece in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(piece)
        out[k] = bytes(gone)
    return out


def repeat_row(text, gone):
    data = (text or "").encode()
    spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
    return len(data), sum(gone), spans, sha(bytes(b for b, x in zip(data, gone) if not x))


def phrases(items):
    found = collections.defaultdict(set)
    for item, text in items:
        words = ALNUM.findall(lower(text))
        for i in range(max(1, len(words) - 9) if words else 0):
            found[tuple(words[i:i + 10])].add("" if item is None else str(item))
    return found


def contaminated(text, found):
    words = ALNUM.findall(lower(text))
    hit, items = set(), set()
    for size in {len(p) for p in found}:
        for i in range(len(words) - size + 1):
            ids = found.get(tuple(words[i:i + size]))
            if ids:
                hit.update(range(i, i + size))
                items |= ids
    return len(words), hit, sorted(items)
