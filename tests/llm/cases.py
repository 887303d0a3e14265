"""Small hard tables, and brute-force versions of the operators."""

import random
import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[ \t-\r]+")
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, c int, u string, rank int, `_row` int, key1 long"


def space_words(text):
    return [w for w in SPACE.split(text or "") if w]


def ascii_lower(text):
    return "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in text or "")


def term_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))


def invented(seed=1, n=60):
    """Rows with copies, near copies, shared passages, nulls, blanks, a very long
    text, repeated rows and columns whose names clash with working names."""
    rng = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(400)] + ["É%d" % i for i in range(20)] + ["the", "of", "a"] * 30

    def text(k):
        return " ".join(rng.choice(vocabulary) for _ in range(k))

    passage = text(70)
    texts = [text(rng.randrange(1, 160)) for _ in range(n)]
    texts += [texts[0], texts[0], texts[1]]
    near = text(150).split()
    for _ in range(6):
        x = list(near)
        x[rng.randrange(150)] = "changed%d" % rng.randrange(9)
        texts.append("\n".join([" ".join(x[:40]), " ".join(x[40:])]))
    texts += [text(20) + " " + passage + "  " + text(15), passage, text(5) + "\t" + passage, passage + " " + passage]
    texts += [None, "", " \n\t ", "one", "ONE", "two words", "!!! ???", "é", text(6000) + " " + passage]
    rows = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["s0", "s0", "s1", None]), len(t or "")) for i, t in enumerate(texts)]
    rows.append((None, texts[2], "en", "s1", 5))
    rows.append((None, None, None, None, None))
    rows.append(rows[3])
    rng.shuffle(rows)
    return [(*r, "x", 1, "y", 2, 3, 4) for r in rows]


def brute_contamination(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        w = term_words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i:i + 13])].add(item)
    out = []
    for doc, text in rows:
        w = term_words(text)
        hit, found = set(), set()
        for i in range(len(w)):
            for n in {len(x) for x in windows}:
                got = windows.get(tuple(w[i:i + n])) if i + n <= len(w) else None
                if got:
                    found |= got
                    hit |= set(range(i, i + n))
        out.append((doc, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def brute_repeats(rows):
    rank = lambda d: float("inf") if d is None else d
    least = {}
    for doc, text in rows:
        w = space_words(text)
        for i in range(len(w) - 49):
            k = tuple(w[i:i + 50])
            least[k] = min(least.get(k, float("inf")), rank(doc))
    out = []
    for doc, text in rows:
        w = space_words(text)
        gone = set()
        for i in range(len(w) - 49):
            if least[tuple(w[i:i + 50])] < rank(doc):
                gone |= set(range(i, i + 50))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def brute_components(rows):
    sets = defaultdict(set)
    for doc, text in rows:
        w = space_words(ascii_lower(text))
        sets[doc].add(frozenset(tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset())
    docs = [(d, s) for d, ss in sets.items() for s in ss]
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(docs):
        for b, t in docs[:i]:
            if s and t and 100 * len(s & t) >= 90 * len(s | t):
                x, y = find(a), find(b)
                if x != y:
                    root[x] = y
    groups = defaultdict(list)
    for d in sets:
        groups[find(d)].append(d)
    name = {}
    for members in groups.values():
        known = [d for d in members if d is not None]
        for d in members:
            name[d] = min(known) if known else None
    out = []
    for doc, text in rows:
        w = space_words(ascii_lower(text))
        n = len({tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))}) if w else 0
        out.append((doc, n, name[doc] if n else doc))
    return out


def brute_quality(text):
    w = space_words(text)
    text = text or ""
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    count = Counter(grams)
    twice = {j for i, g in enumerate(grams) if count[g] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if space_words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text), dup, len(twice)


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)
