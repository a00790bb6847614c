"""Plain versions of the text operators, for comparison."""

import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


def shingles(text):
    words = WORD.findall(lower(text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def near_components(texts):
    """Smallest id linked to each id, by comparing all pairs."""
    sets = {d: shingles(t) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(texts)
    holders = defaultdict(list)
    for b in ids:
        for a in {a for s in sets[b] for a in holders[s]}:
            shared = len(sets[a] & sets[b])
            if 100 * shared >= 85 * (len(sets[a]) + len(sets[b]) - shared):
                low, high = sorted((find(a), find(b)))
                root[high] = low
        for s in sets[b]:
            holders[s].append(b)
    return {d: find(d) for d in ids}, {d: len(s) for d, s in sets.items()}


SECRETS = (
    ("assign", re.compile(
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    ), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def base_spans(text):
    found = [
        (m.start(), order, m.end(), kind)
        for order, (kind, pattern, good) in enumerate(SECRETS)
        for m in pattern.finditer(text or "")
        if good(m)
    ]
    return [f"{kind}:{first}:{last}" for first, _, last, kind in sorted(found)]


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = defaultdict(list)
    for i, w in enumerate(windows):
        seen[w].append(i)
    covered = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for w in words for c in w),
        len(lines) - len(set(lines)), len(covered),
    )
