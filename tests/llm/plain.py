"""The contracts in plain Python, for small tables."""

import collections
import functools
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower_words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, size):
    words = lower_words(text)
    return {tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def components(texts, size, percent=80):
    """{id: smallest linked id} of (id, text) pairs, all pairs compared."""
    sets = [(i, shingles(t, size)) for i, t in texts]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i, _ in sets}


def removed(texts, window):
    """[(id, words, flags)] of (id, text) pairs in order of id."""
    seen, out = set(), []
    for i, text in texts:
        words = WORD.findall(text or "")
        flags = [False] * len(words)
        for k in range(len(words) - window + 1):
            own = tuple(words[k:k + window])
            if own in seen:
                flags[k:k + window] = [True] * window
            seen.add(own)
        out.append((i, words, flags))
    return out


@functools.cache
def item_windows(items, window):
    """{windows of an item: its items}, and their sizes; an item of fewer words is one window."""
    found = collections.defaultdict(set)
    for item, phrase in items:
        words = ALNUM.findall((phrase or "").translate(LOWER))
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            found[tuple(words[k:k + size])].add(str(item))
    return found, {len(w) for w in found}


def hits(text, items, window):
    """Flags of the words that a window of an item covers, and the items."""
    words = ALNUM.findall((text or "").translate(LOWER))
    windows, sizes = item_windows(tuple(items), window)
    flags, found = [False] * len(words), set()
    for size in sizes:
        for at in range(len(words) - size + 1):
            if (own := tuple(words[at:at + size])) in windows:
                flags[at:at + size] = [True] * size
                found |= windows[own]
    return flags, sorted(found)


def repeat_words(words, window=5):
    counts = collections.Counter(tuple(words[k:k + window]) for k in range(len(words) - window + 1))
    flags = [False] * len(words)
    for k in range(len(words) - window + 1):
        if counts[tuple(words[k:k + window])] > 1:
            flags[k:k + window] = [True] * window
    return sum(flags)


FORMATS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in FORMATS.items():
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match[0])
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in match[0].split(".")),
                    "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, match.start(), match.end()))
    return out
